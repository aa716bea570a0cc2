"""Loading names and building the index of records.

Defined cases, all functions: rows without any name are left out; ids are trimmed, blank ones are null; repeated rows
give one row where a key is loaded and stay where records are listed; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaloom.functions.ids import clean_id, uuid5
from taxaloom.functions.text import name_text, outlink_value

INDEX = ["data_source_id", "record_id", "name_string_id", "outlink_id", "global_id", "local_id", "rank", "taxonomic_status", "accepted_record_id"]


def loaded_names(rows: DataFrame, plain: str = "col__scientific_name", checked: str | None = None) -> DataFrame:
    """Distinct ``id, name`` of a checklist's names; ids follow from the text."""
    text = name_text(F.col(checked) if checked else F.lit(None).cast("string"), F.col(plain)).alias("name")
    return rows.select(text).where("trim(name) <> ''").distinct().select(uuid5(F.col("name")).alias("id"), "name")


def absent(new: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new``, of each key the least one, whose key ``existing`` doesn't hold. Writing them twice changes nothing."""
    rest = [c for c in new.columns if c not in keys]
    one = new.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_r")).select(*(c if c in keys else F.col(f"_r.{c}").alias(c) for c in new.columns)) if rest else new.distinct()
    return one.join(existing.select(*keys).distinct(), list(keys), "left_anti")


def not_in(left: DataFrame, key: str, right: DataFrame, other: str) -> DataFrame:
    """SQL's NOT IN at any size: nothing if the right side holds a null; null keys go unless it is empty.

    A left anti join by key, guarded by two one-row aggregates; the right side is never broadcast whole.
    """
    facts = right.agg(F.count(F.lit(1)).alias("_n"), F.count_if(F.col(other).isNull()).alias("_nulls"))
    kept = left.join(right.select(F.col(other).alias("_other")).where("_other is not null").distinct(), F.col(key) == F.col("_other"), "left_anti")
    return kept.join(F.broadcast(facts)).where((F.col("_n") == 0) | ((F.col("_nulls") == 0) & F.col(key).isNotNull())).drop("_n", "_nulls")


def bare(names: DataFrame, key: str, used: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Names that no row of any of the ``used`` tables (taxa, synonyms) names, as SQL's NOT IN over their union has it."""
    every = [df.select(F.col(c).alias("_used")) for df, c in used]
    return not_in(names, key, reduce(DataFrame.unionByName, every), "_used")


def blank_names(rows: DataFrame, plain: str = "col__scientific_name", checked: str | None = None, by: str = "data_source_id") -> DataFrame:
    """Rows and rows without any name of each source."""
    text = name_text(F.col(checked) if checked else F.lit(None).cast("string"), F.col(plain))
    return rows.groupBy(by).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.coalesce(F.trim(text), F.lit("")) == "").alias("n_blank"))


def taxa_index(taxa: DataFrame, outlink: str = "col__alternative_id") -> DataFrame:
    """Index rows of accepted taxa; a taxon's accepted record is itself."""
    record = clean_id(F.col("col__id"))
    return taxa.where("col__scientific_name is not null").select(
        "data_source_id", record.alias("record_id"), uuid5(F.col("col__scientific_name")).alias("name_string_id"),
        outlink_value(F.lit(outlink), F.col(outlink)).alias("outlink_id"), F.col("gn__global_id").alias("global_id"), F.col("gn__local_id").alias("local_id"),
        F.lower("col__rank_id").alias("rank"), F.lower("col__status_id").alias("taxonomic_status"), record.alias("accepted_record_id"),
    )


def synonym_index(synonyms: DataFrame, taxa: DataFrame) -> DataFrame:
    """Index rows of synonyms (``data_source_id, col__id, col__taxon_id, col__name_id, name, col__status_id``).

    Those of unknown taxa are dropped, and those that are their own taxon, whose name the taxon already has.
    """
    known = taxa.select(F.col("data_source_id").alias("_s"), clean_id(F.col("col__id")).alias("_t")).where("_t is not null").distinct()
    rows = synonyms.withColumn("_taxon", clean_id(F.col("col__taxon_id")))
    rows = rows.where(~clean_id(F.col("col__id")).eqNullSafe(F.col("_taxon"))).join(known, F.expr("data_source_id = _s and _taxon = _t"), "left_semi")
    status = F.when(F.coalesce("col__status_id", F.lit("")) == "", F.lit("SYNONYM")).otherwise(F.col("col__status_id"))
    nothing = F.lit(None).cast("string")
    return rows.select(
        "data_source_id", F.concat(F.coalesce("col__id", F.lit("")), F.lit("|"), F.coalesce("_taxon", F.lit("")), F.lit("|"), F.coalesce("col__name_id", F.lit(""))).alias("record_id"),
        uuid5(F.col("name")).alias("name_string_id"), nothing.alias("outlink_id"), nothing.alias("global_id"), nothing.alias("local_id"),
        F.lit("").alias("rank"), F.lower(status).alias("taxonomic_status"), F.col("_taxon").alias("accepted_record_id"),
    )


def bare_index(names: DataFrame, source: int) -> DataFrame:
    """Index rows of names (``id, name``) that no taxon and no synonym uses."""
    record = F.concat(F.lit("bare-name-"), F.col("id"))
    empty = F.lit("")
    return names.select(
        F.lit(source).alias("data_source_id"), record.alias("record_id"), uuid5(F.col("name")).alias("name_string_id"), empty.alias("outlink_id"), empty.alias("global_id"), empty.alias("local_id"),
        empty.alias("rank"), F.lit("bare name").alias("taxonomic_status"), record.alias("accepted_record_id"),
    )


def repeated_keys(index: DataFrame, keys: Sequence[str] = ("data_source_id", "record_id", "accepted_record_id")) -> DataFrame:
    """Keys held by several rows, with their number."""
    return index.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")
