"""Upkeep of stored tables: orphans, updates, replacement and removal of data sources, schemas.

Parquet tables are immutable: every operator gives the new state, and ``swap`` writes it to a new folder and then names it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def orphans(rows: DataFrame, key: str, used: DataFrame, by: str) -> DataFrame:
    """Rows that no row of ``used`` names; rows with a null key are orphans."""
    return rows.join(used.select(F.col(by).alias("_by")).where("_by is not null").distinct(), F.col(key) == F.col("_by"), "left_anti")


def kept(rows: DataFrame, key: str, used: DataFrame, by: str) -> DataFrame:
    """The other rows."""
    return rows.join(used.select(F.col(by).alias("_by")).where("_by is not null").distinct(), F.col(key) == F.col("_by"), "left_semi")


def cascade(names: DataFrame, indices: DataFrame, canonicals: dict[str, DataFrame]) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Names with an index row, then canonical forms (by the column that names them) which such names use."""
    left = kept(names, "id", indices, "name_string_id")
    return left, {column: kept(table, "id", left, column) for column, table in canonicals.items()}


def updated(rows: DataFrame, changes: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """``rows`` where a row of ``changes`` (one for each key) has that row's ``columns``."""
    new = changes.select(F.col(key).alias("_key"), *(F.col(c).alias(f"_{c}") for c in columns), F.lit(True).alias("_new"))
    joined = rows.join(new, F.col(key) == F.col("_key"), "left")
    pick = lambda c: F.when(F.col("_new"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
    return joined.select(*(pick(c) for c in rows.columns))


def without_sources(rows: DataFrame, sources: DataFrame | Sequence[int], column: str = "data_source_id") -> DataFrame:
    """``rows`` without those of some sources."""
    if isinstance(sources, DataFrame):
        return rows.join(sources.select(F.col(column).alias("_s")).distinct(), F.col(column) == F.col("_s"), "left_anti")
    return rows.where(~F.col(column).isin(*sources)) if sources else rows


def removed(tables: dict[str, tuple[DataFrame, str]], sources: DataFrame | Sequence[int], column: str = "data_source_id") -> dict[str, DataFrame]:
    """Every table (with its column of the source) without some sources: index rows, vernaculars, the list of sources."""
    if isinstance(sources, DataFrame):
        return {name: without_sources(df, sources.select(F.col(column).alias(c)), c) for name, (df, c) in tables.items()}
    return {name: without_sources(df, sources, c) for name, (df, c) in tables.items()}


def replaced(rows: DataFrame, new: DataFrame, column: str = "data_source_id") -> DataFrame:
    """``rows`` with all rows of the sources in ``new`` replaced by ``new``."""
    return without_sources(rows, new, column).unionByName(new)


def absent_keys(wanted: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Wanted keys that are not there."""
    return wanted.select(key).distinct().join(found.select(key).distinct(), key, "left_anti")


def schema_changes(current: StructType, desired: StructType) -> list[str]:
    """What brings one schema to another: columns to add, to drop, to change."""
    now, then = {f.name: f.dataType.simpleString() for f in current}, {f.name: f.dataType.simpleString() for f in desired}
    add = [f"add {c} {t}" for c, t in then.items() if c not in now]
    drop = [f"drop {c}" for c in now if c not in then]
    return add + drop + [f"change {c} {now[c]} to {t}" for c, t in then.items() if c in now and now[c] != t]


def migrated(df: DataFrame, desired: StructType) -> DataFrame:
    """``df`` in the desired schema: new columns null, others cast, surplus ones gone."""
    have = set(df.columns)
    one = lambda f: (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
    return df.select(*(one(f) for f in desired))


def swap(df: DataFrame, folder: str, partition_by: Sequence[str] = ()) -> str:
    """Writes a new version under ``folder`` and makes it the current one; readers of the old version aren't disturbed.

    Nothing is overwritten: a small file with the next number names the new version, and readers take the greatest number.
    """
    spark = df.sparkSession
    version = f"{folder}/v-{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(version)
    last = _pointer(spark, folder)
    pointer = spark.createDataFrame([(json.dumps({"number": (last or {"number": 0})["number"] + 1, "path": version}),)], "value string")
    pointer.coalesce(1).write.mode("append").text(f"{folder}/current")
    return version


def _pointer(spark: SparkSession, folder: str) -> dict | None:
    """The pointer of the greatest number."""
    try:
        rows = spark.read.schema("value string").text(f"{folder}/current").collect()  # one short line for each version
    except AnalysisException:  # no version yet
        return None
    return max((json.loads(r[0]) for r in rows), key=lambda p: (p["number"], p["path"]), default=None)


def current(spark: SparkSession, folder: str) -> DataFrame:
    """The current version."""
    return spark.read.parquet(_pointer(spark, folder)["path"])


def statistics(spark: SparkSession, table: str) -> None:
    """Table and column statistics for the optimiser."""
    spark.sql(f"analyze table {table} compute statistics for all columns")


def after(key: Sequence[str], cursor: Sequence[object]) -> Column:
    """Rows beyond a cursor of one or several key columns, compared from left to right."""
    return F.struct(*key) > F.struct(*(F.lit(v) for v in cursor))


def page(df: DataFrame, key: Sequence[str], cursor: Sequence[object] | None, size: int) -> DataFrame:
    """The next ``size`` rows in order of ``key``."""
    return (df.where(after(key, cursor)) if cursor is not None else df).orderBy(*key).limit(size)
