"""The denormalised lookup table and its three lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COLUMNS = [
    "data_source_id", "record_id", "name_string_id", "name", "name_id", "code_id", "year", "cardinality", "canonical_id", "virus", "bacteria", "parse_quality", "local_id",
    "outlink_id", "taxonomic_status", "accepted_record_id", "accepted_name_id", "accepted_name", "classification", "classification_ranks", "classification_ids",
]
#: Names fit for lookup: parsed, not a surrogate, not a doubtful bacterium; or a virus. Null flags count as SQL counts them.
FIT = "(canonical_id is not null and surrogate != true and (bacteria != true or parse_quality < 3)) or virus = true"


def verification(indices: DataFrame, names: DataFrame) -> DataFrame:
    """Index rows with their name and their accepted record's name.

    Rows whose name is unknown or unfit are left out; an accepted record of several rows gives several rows; an accepted
    record that is missing gives nulls. Both joins shuffle by key; a hot accepted record is split by AQE's skew join.
    """
    n = names.select(F.col("id").alias("_id"), "name", "year", "cardinality", "canonical_id", "virus", "bacteria", "surrogate", "parse_quality")
    rows = indices.join(n, F.col("name_string_id") == F.col("_id"))
    accepted = rows.select(F.col("data_source_id").alias("_s"), F.col("record_id").alias("_r"), F.col("name_string_id").alias("accepted_name_id"), F.col("name").alias("accepted_name"))
    joined = rows.where(FIT).join(accepted, F.expr("data_source_id = _s and accepted_record_id = _r"), "left")
    return joined.select(*COLUMNS)


def write_verification(view: DataFrame, table: str, buckets: int = 256) -> None:
    """Stores the view bucketed and sorted by its main lookup key, for lookups and joins without a shuffle."""
    view.write.mode("overwrite").format("parquet").bucketBy(buckets, "canonical_id").sortBy("canonical_id").saveAsTable(table)


def lookup(view: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """Rows of the view for a set of ``canonical_id``, ``name_string_id`` or ``year`` keys."""
    return view.join(keys.select(F.col(column)).where(f"{column} is not null").distinct(), column, "left_semi")
