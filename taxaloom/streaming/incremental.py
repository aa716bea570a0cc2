"""Incremental loading as a stream: each micro-batch adds the names that aren't there yet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from taxaloom.operators.names import absent


def adds_absent(folder: str, key: str = "id", make: Callable[[DataFrame], DataFrame] | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that appends rows with new keys to the table in ``folder``; ``make`` makes them of a batch.

    The stream itself keeps no state: what is there is read from the table, of which only the key's column is needed.
    Each batch goes to a folder of its own, so that a batch that is tried again overwrites what it wrote before.
    """

    def run(batch: DataFrame, number: int) -> None:
        spark, batch = batch.sparkSession, make(batch) if make else batch
        try:
            have = spark.read.parquet(folder).where(f"batch <> {number}").select(key)
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            have = batch.select(key).limit(0)  # nothing written yet
        absent(batch, have, [key]).write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return run


def load(stream: DataFrame, folder: str, checkpoint: str, key: str = "id", make: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Starts loading all that is available, then stops."""
    return stream.writeStream.foreachBatch(adds_absent(folder, key, make)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
