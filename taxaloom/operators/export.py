"""Tables of an export: names, taxa, synonyms, vernaculars, and the names of its files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaloom.functions.text import slug

# States of records that are synonyms.
SYNONYMS = ("synonym", "ambiguous synonym", "misapplied")


def is_synonym() -> Column:
    return F.col("taxonomic_status").isin(*SYNONYMS)


def export_names(indices: DataFrame, names: DataFrame) -> DataFrame:
    """One row for each name of a source: the first by outlink (nulls last), then by record; with its text."""
    order = F.struct(F.col("outlink_id").isNull(), "outlink_id", "record_id", "accepted_record_id")
    first = indices.groupBy("data_source_id", "name_string_id").agg(F.min_by(F.struct("record_id", "outlink_id", "code_id", "rank"), order).alias("r"))
    text = names.groupBy(F.col("id").alias("_id")).agg(F.min("name").alias("name"))
    link = F.when(F.coalesce("r.outlink_id", F.lit("")) != "", F.concat(F.lit("gnoutlink:"), "r.outlink_id"))
    rows = first.join(text, F.col("name_string_id") == F.col("_id"))
    return rows.select("data_source_id", "name_string_id", "name", "r.record_id", link.alias("alternative_id"), F.lower("r.rank").alias("rank"))


def export_taxa(indices: DataFrame) -> DataFrame:
    """Records that are no synonyms; those without a state are taxa."""
    return indices.where(~is_synonym() | F.col("taxonomic_status").isNull()).select("data_source_id", "record_id", "name_string_id", "taxonomic_status", "rank")


def export_synonyms(indices: DataFrame) -> DataFrame:
    """Records that are synonyms, with their accepted record."""
    return indices.where(is_synonym()).select("data_source_id", "record_id", "accepted_record_id", "name_string_id", "taxonomic_status")


def export_vernaculars(rows: DataFrame, strings: DataFrame) -> DataFrame:
    """Vernacular names of records, by code where there is one, else by language."""
    text = strings.groupBy(F.col("id").alias("_id")).agg(F.min("name").alias("name"))
    language = F.coalesce(F.nullif("lang_code", F.lit("")), F.col("language"))
    return rows.join(text, F.col("vernacular_string_id") == F.col("_id")).select("data_source_id", "record_id", "name", language.alias("language"), "locality", "country_code")


def base_name(source: Column, title: Column, revision: Column, updated: Column) -> Column:
    """``0001-short-title-2024-01-31``: the revision date, else that of the last update."""
    text = F.coalesce(F.nullif(slug(title), F.lit("")), F.lit("source"))
    date = F.coalesce(F.nullif(revision, F.lit("")), F.date_format(updated, "yyyy-MM-dd"))
    return F.concat_ws("-", F.lpad(source.cast("string"), 4, "0"), text, date)


def written(tables: dict[str, DataFrame], folder: str, by: str = "data_source_id") -> DataFrame:
    """Writes each table of an export as Parquet under ``folder``, a partition for each source; gives the rows written per table and source.

    Rows are gathered by source, small sources together and large ones split over several tasks and files by their size.
    A second run replaces the first.
    """
    done = []
    for name, df in tables.items():
        df.hint("rebalance", by).write.mode("overwrite").partitionBy(by).parquet(f"{folder}/{name}")
        back = df.sparkSession.read.parquet(f"{folder}/{name}")
        done.append(back.groupBy(F.col(by).cast("int").alias(by)).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("tab"), by, "n_rows"))
    return reduce(DataFrame.unionByName, done)
