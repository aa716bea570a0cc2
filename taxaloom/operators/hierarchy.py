"""Parent-child links to full hierarchies.

Links of one data source form trees of unknown depth. They are resolved by weighted disjoint-set forests:

1. the links of a source are dealt into chunks of bounded size, and each chunk builds its own forest, in which
   every node knows its local top and its offset below it (path compression over arrays);
2. only nodes which another chunk points at remain of interest; the chunks' forests are merged by joining such
   nodes to their tops in rounds, each round doubling the reach of a merged forest, so that the number of rounds
   is the logarithm of the number of chunk borders on a path; nodes which never meet a root are on or below a circle;
3. paths are put together from the chunks' own traversals through an index of parents.

A source of any size takes part with chunks of the same size; nothing is gathered whole.

Defined cases (all functions): rows with a null or blank id are no nodes and are left out; of several rows of an id
that with the latest ``loaded_at`` holds (null is earliest), of ties the one with the greatest parent; a null or blank
parent, a parent equal to the node and a parent that does not exist make a root; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaloom.functions.ids import clean_id
from taxaloom.session import cut

CHUNK_ROWS = 100_000
ROOTED, CYCLE, BELOW = "rooted", "cycle", "below_cycle"


def links(df: DataFrame, key: str = "data_source_id", node: str = "col__id", parent: str = "col__parent_id", at: str = "loaded_at") -> DataFrame:
    """The holding link of each node: ``grp, id, parent`` (null for a root by its own row)."""
    rows = df.select(F.col(key).alias("grp"), clean_id(F.col(node)).alias("id"), clean_id(F.col(parent)).alias("parent"), F.col(at).alias("at"))
    held = rows.where("id is not null").groupBy("grp", "id").agg(F.max(F.struct("at", "parent")).alias("held"))
    return held.select("grp", "id", F.when(F.col("held.parent") != F.col("id"), F.col("held.parent")).alias("parent"))


def in_chunks(held: DataFrame, sizes: DataFrame) -> DataFrame:
    """Deals each group's links into its number of chunks, by a hash of the id; adds ``chunks`` and ``chunk``."""
    dealt = held.join(sizes, F.expr("grp <=> g")).select("grp", "id", "parent", "chunks")
    return dealt.withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int"))


def chunk_counts(df: DataFrame, key: str, chunk_rows: int) -> DataFrame:
    """Chunks of each group, from its number of rows: one column is read, the links themselves aren't made twice."""
    return df.groupBy(F.col(key).alias("g")).agg(F.ceil(F.count(F.lit(1)) / chunk_rows).alias("chunks"))


def compressed(parent: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Weighted find over parent positions (-1: none in this chunk): top, offset below it, is on a circle, leads to one."""
    n = len(parent)
    top, offset = np.where(parent >= 0, parent, np.arange(n)), (parent >= 0).astype(np.int64)
    for _ in range(max(1, int(n).bit_length())):  # afterwards every node has gone at least n steps
        further = top[top]
        if np.array_equal(further, top):
            break
        offset, top = np.minimum(offset + offset[top], 2 * n), further
    lost = parent[top] >= 0
    circle = np.zeros(n, bool)
    circle[top[lost]] = True  # whoever has gone n steps and still has a parent stands on the circle, and all its links are reached
    return top, offset, circle, lost & ~circle


def _forest(pdf: pd.DataFrame) -> pd.DataFrame:
    at = pd.Index(pdf["id"]).get_indexer(pdf["parent"])
    top, offset, circle, below = compressed(at)
    outside = pdf["parent"].to_numpy()[top]
    state = np.where(circle, CYCLE, np.where(below, BELOW, ROOTED))
    ids = pdf["id"].to_numpy()
    ends = (circle | below) | (pdf["chunks"].to_numpy() == 1)  # with one chunk a parent outside does not exist
    return pd.DataFrame(
        {"grp": pdf["grp"], "chunks": pdf["chunks"], "chunk": pdf["chunk"], "id": ids, "parent": pdf["parent"], "top": ids[top], "off": offset, "outside": np.where(ends, None, outside), "state": state}
    )


def forests(df: DataFrame, chunk_rows: int = CHUNK_ROWS, key: str = "data_source_id", **columns: str) -> DataFrame:
    """Each chunk's forest: for every node its local ``top``, offset ``off``, the parent ``outside`` the chunk, ``state``."""
    dealt = in_chunks(links(df, key, **columns), chunk_counts(df, key, chunk_rows))
    kind = dict(dealt.dtypes)["grp"]
    schema = f"grp {kind}, chunks long, chunk int, id string, parent string, top string, off long, outside string, state string"
    return dealt.groupBy("grp", "chunk").applyInPandas(_forest, schema)


def _merged(local: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Merges the chunks' forests. Gives border nodes with ``root, depth, state``, and those that are on circles across chunks."""
    out = local.where("outside is not null")
    wanted = out.select(F.col("grp").alias("g"), F.col("outside").alias("o")).distinct()
    border = local.join(wanted, F.expr("grp <=> g and id = o"), "left_semi")
    border = border.select("grp", "chunk", "id", F.col("top").alias("root"), F.col("off").alias("depth"), F.col("outside").alias("ptr"), "state")
    known = border.select(F.col("grp").alias("g"), F.col("id").alias("i"))
    border = border.join(known, F.expr("grp <=> g and ptr = i"), "left")
    border = cut(border.select("grp", "chunk", "id", "root", "depth", F.col("i").alias("ptr"), "state"))  # a pointer to a missing parent ends
    open_before, images = None, None
    while True:
        now = border.where("ptr is not null").agg(F.count(F.lit(1)), F.count_distinct("grp", "ptr")).first()
        if not now[0]:
            return border, None
        if open_before == now[0] and images == now[1]:  # nobody met a root, and the pointers' targets are stable: these are circles
            break
        open_before, images = now[0], now[1]
        up = border.select(F.col("grp").alias("g"), F.col("id").alias("i"), F.col("root").alias("r"), F.col("depth").alias("d"), F.col("ptr").alias("p"), F.col("state").alias("s"))
        jumped = border.join(up, F.expr("grp <=> g and ptr = i"), "left")
        border = cut(
            jumped.select(
                "grp", "chunk", "id", F.coalesce("r", "root").alias("root"), F.when(F.col("i").isNull(), F.col("depth")).otherwise(F.least(F.col("depth") + 1 + F.col("d"), F.lit(1 << 60))).alias("depth"), F.col("p").alias("ptr"),
                F.when(F.col("s").isin(CYCLE, BELOW), F.lit(BELOW)).otherwise(F.col("state")).alias("state"),
            )
        )
    circle = border.where("ptr is not null").select(F.col("grp").alias("g"), F.col("ptr").alias("o")).distinct()
    circle = border.join(circle, F.expr("grp <=> g and id = o"), "left_semi").select("grp", "chunk", "id")
    border = border.withColumn("state", F.when(F.col("ptr").isNotNull(), F.lit(BELOW)).otherwise(F.col("state")))
    return border, cut(circle)


def _climb(nodes: pd.DataFrame, starts: pd.DataFrame) -> pd.DataFrame:
    """From each start up to its chunk's top."""
    up = dict(zip(nodes["id"], nodes["parent"], strict=True))
    seen: set[str] = set()
    for x in starts["i"]:
        while x in up and x not in seen:
            seen.add(x)
            x = up[x]
    one = nodes[["grp"]].head(1).loc[:, "grp"].tolist() or [None]
    return pd.DataFrame({"grp": one * len(seen), "id": sorted(seen)})


def resolved(df: DataFrame, chunk_rows: int = CHUNK_ROWS, **columns: str) -> DataFrame:
    """Every node: ``grp, id, parent, root, depth, state``.

    ``depth`` counts steps below the root. ``state`` is ``rooted``, ``cycle`` (a link of a circle) or ``below_cycle``;
    the latter two have neither root nor depth. See the module for the defined cases.
    """
    local = cut(forests(df, chunk_rows, **columns))
    border, circle = _merged(local)
    up = border.select(F.col("grp").alias("g"), F.col("id").alias("i"), F.col("root").alias("r"), F.col("depth").alias("d"), F.col("state").alias("s"))
    whole = local.where("outside is null").select("grp", "id", "parent", "top", "off", "state", F.lit(None).cast("string").alias("r"), F.lit(None).cast("long").alias("d"), F.lit(None).cast("string").alias("s"))
    out = local.where("outside is not null")
    out = out.join(up, F.expr("grp <=> g and outside = i"), "left").select("grp", "id", "parent", "top", "off", "state", "r", "d", "s")
    state = F.when(F.col("s").isin(CYCLE, BELOW), F.lit(BELOW)).otherwise(F.col("state"))
    every = whole.unionByName(out).select("grp", "id", "parent", F.coalesce("r", "top").alias("root"), F.when(F.col("r").isNull(), F.col("off")).otherwise(F.col("off") + 1 + F.col("d")).alias("depth"), state.alias("state"))
    if circle is not None:
        kind = dict(local.dtypes)["grp"]
        starts = circle.select(F.col("grp").alias("g"), F.col("chunk").alias("c"), F.col("id").alias("i"))
        places = starts.select("g", "c").distinct()
        there = local.join(places, F.expr("grp <=> g and chunk = c"), "left_semi").select("grp", "chunk", "id", "parent")
        walked = there.groupBy("grp", "chunk").cogroup(starts.groupBy("g", "c")).applyInPandas(_climb, f"grp {kind}, id string")
        walked = walked.select(F.col("grp").alias("g"), F.col("id").alias("i"))
        every = every.join(walked, F.expr("grp <=> g and id = i"), "left")
        every = every.select("grp", "id", "parent", "root", "depth", F.when(F.col("i").isNotNull(), F.lit(CYCLE)).otherwise(F.col("state")).alias("state"))
    fine = F.col("state") == ROOTED
    return every.select("grp", "id", "parent", F.when(fine, F.col("root")).alias("root"), F.when(fine, F.col("depth")).alias("depth"), "state")


def _segments(pdf: pd.DataFrame) -> pd.DataFrame:
    """Each rooted node's path inside its chunk, by traversal through an index of parents."""
    at = pd.Index(pdf["id"]).get_indexer(pdf["parent"]).tolist()
    ids = pdf["id"].tolist()
    made: list[list[str] | None] = [None] * len(ids)
    for k in range(len(ids)):
        stack, x = [], k
        while x >= 0 and made[x] is None:
            stack.append(x)
            x = at[x]
        base = made[x] if x >= 0 else []
        for x in reversed(stack):
            made[x] = base = [*base, ids[x]]
    return pd.DataFrame({"grp": pdf["grp"], "id": ids, "seg": made, "outside": pdf["outside"]})


def paths(df: DataFrame, chunk_rows: int = CHUNK_ROWS, **columns: str) -> DataFrame:
    """Every rooted node's ``path`` of ids from its root down to itself: ``grp, id, path``. Nodes on or below circles have none."""
    local = cut(forests(df, chunk_rows, **columns))
    kind = dict(local.dtypes)["grp"]
    segs = local.where(F.col("state") == ROOTED).select("grp", "chunk", "id", "parent", "outside").groupBy("grp", "chunk").applyInPandas(_segments, f"grp {kind}, id string, seg array<string>, outside string")
    segs = cut(segs)
    out = segs.where("outside is not null")
    wanted = out.select(F.col("grp").alias("g"), F.col("outside").alias("o")).distinct()
    state = local.select(F.col("grp").alias("g"), F.col("id").alias("i")).join(wanted.withColumnRenamed("g", "h"), F.expr("g <=> h and i = o"), "left_semi")
    border = segs.join(wanted, F.expr("grp <=> g and id = o"), "left_semi")
    border = border.join(state, F.expr("grp <=> g and outside = i"), "left")
    border = cut(border.select("grp", "id", "seg", F.col("i").alias("ptr")))
    left = None
    while True:
        now = border.where("ptr is not null").count()
        if now in (0, left):  # what stays open hangs on a circle
            break
        left = now
        up = border.select(F.col("grp").alias("g"), F.col("id").alias("i"), F.col("seg").alias("above"), F.col("ptr").alias("p"))
        jumped = border.join(up, F.expr("grp <=> g and ptr = i"), "left")
        gone = F.col("ptr").isNotNull() & F.col("i").isNull()  # its parent is on or below a circle of one chunk
        seg = F.when(F.col("i").isNull(), F.col("seg")).otherwise(F.concat("above", "seg"))
        border = cut(jumped.where(~gone).select("grp", "id", seg.alias("seg"), F.col("p").alias("ptr")))
    ready = border.where("ptr is null").select(F.col("grp").alias("g"), F.col("id").alias("i"), F.col("seg").alias("above"))
    out = out.join(ready, F.expr("grp <=> g and outside = i"), "left")
    known = out.join(state.select(F.col("g").alias("h"), F.col("i").alias("j")), F.expr("grp <=> h and outside = j"), "left")
    known = known.where("above is not null or j is null").select("grp", "id", F.concat(F.coalesce("above", F.array().cast("array<string>")), "seg").alias("path"))
    return segs.where("outside is null").select("grp", "id", F.col("seg").alias("path")).unionByName(known)


def descendants(path_rows: DataFrame) -> DataFrame:
    """All pairs ``grp, ancestor, descendant, distance`` (distance 0 excluded), straight from the paths without a shuffle."""
    n = F.size("path")
    return path_rows.select("grp", F.col("id").alias("descendant"), F.posexplode(F.slice("path", 1, n - 1)).alias("at", "ancestor"), n.alias("n")).select(
        "grp", "ancestor", "descendant", (F.col("n") - 1 - F.col("at")).alias("distance")
    )
