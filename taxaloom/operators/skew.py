"""Per-key results where a handful of keys hold most records: multi-level tree aggregation.

Every aggregate is a mergeable state. Input is cut into chunks of a fixed number of rows; each chunk's states are made
where the chunk is read. The states are then merged in rounds, each of which brings at most ``fan_in`` states of a key
to one group, until one is left, so that no reducer ever receives all partials of a large key. The number of rounds
is the logarithm of the number of chunks.

Defined cases: a null key is a key of its own; null values are skipped by sums, minima and maxima; an empty table gives
no rows; repeated rows count as often as they occur.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK_ROWS, FAN_IN = 1 << 17, 16

#: How states of one kind are merged.
MERGE: dict[str, Callable[[str], Column]] = {"sum": F.sum, "min": F.min, "max": F.max}


def rounds_for(rows: int, chunk_rows: int = CHUNK_ROWS, fan_in: int = FAN_IN) -> int:
    """Fan-in rounds that bring the chunks of ``rows`` rows down to one state."""
    return max(1, math.ceil(math.log(max(2, rows / chunk_rows), fan_in)))


def tree_aggregate(df: DataFrame, keys: Sequence[str], states: dict[str, tuple[str, Column]], chunk_rows: int = CHUNK_ROWS, fan_in: int = FAN_IN, rows: int | None = None) -> DataFrame:
    """``states`` maps a result column to (``sum``, ``min`` or ``max``; the value of one row). One row per key comes out."""
    levels = rounds_for(df.count() if rows is None else rows, chunk_rows, fan_in)  # of Parquet files this only reads the footers
    merge = [MERGE[kind](name).alias(name) for name, (kind, _) in states.items()]
    run = F.floor(F.monotonically_increasing_id() / chunk_rows)  # rows of one partition in runs of chunk_rows
    leaf = F.pmod(F.xxhash64(run), F.lit(fan_in**levels)).alias("_node")
    made = df.select(*keys, leaf, *(value.alias(name) for name, (_, value) in states.items())).groupBy(*keys, "_node").agg(*merge)
    for level in range(levels - 1, -1, -1):
        node = F.pmod(F.col("_node"), F.lit(fan_in**level)).alias("_node")
        made = made.select(*keys, node, *states).groupBy(*keys, "_node").agg(*merge)
    return made.select(*keys, *states)


def distinct_counts(df: DataFrame, keys: Sequence[str], of: str, name: str, **sizes: int) -> DataFrame:
    """Exact number of different values of ``of`` per key. Values are made distinct by key *and* value, which spreads a large key."""
    pairs = df.where(F.col(of).isNotNull()).select(*keys, of).distinct()
    return tree_aggregate(pairs, keys, {name: ("sum", F.lit(1).cast("long"))}, rows=df.count(), **sizes)


def heavy_keys(df: DataFrame, key: str, share: float, **sizes: int) -> DataFrame:
    """Keys which hold at least ``share`` of all rows, with their number of rows ``n_rows``."""
    total = df.count()
    return tree_aggregate(df, [key], {"n_rows": ("sum", F.lit(1).cast("long"))}, rows=total, **sizes).where(F.col("n_rows") >= share * total)
