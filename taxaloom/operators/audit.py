"""Comparison of two copies by counts, states and samples, and the dictionary of ranks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from taxaloom.functions.codes import FLAT_RANKS
from taxaloom.operators.export import SYNONYMS


def counts(df: DataFrame, key: str = "data_source_id") -> DataFrame:
    """Rows, names and synonyms of each source, all in one pass."""
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("name_string_id").alias("n_names"),
        F.count_if(F.col("taxonomic_status").isin(*SYNONYMS)).alias("n_synonyms"), F.count_if(F.coalesce("classification", F.lit("")) != "").alias("n_classified"),
    )


def compared_counts(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of each key combination on either side, 0 where missing, and whether they agree (null keys are keys)."""
    x, y = a.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_a")).alias("x"), b.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_b")).alias("y")
    joined = x.join(y, F.expr(" and ".join(f"x.{k} <=> y.{k}" for k in keys)), "full")
    n_a, n_b = F.coalesce("n_a", F.lit(0)), F.coalesce("n_b", F.lit(0))
    return joined.select(*(F.coalesce(f"x.{k}", f"y.{k}").alias(k) for k in keys), n_a.alias("n_a"), n_b.alias("n_b"), (n_a == n_b).alias("same"))


def compared_metadata(a: DataFrame, b: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """For each key of two one-row-a-key tables whether each field agrees (null agrees with null, also of a missing key)."""
    x, y = a.alias("x"), b.alias("y")
    joined = x.join(y, F.expr(f"x.{key} <=> y.{key}"), "full")
    return joined.select(F.coalesce(f"x.{key}", f"y.{key}").alias(key), *(F.expr(f"x.{f} <=> y.{f}").alias(f) for f in fields))


def compared_samples(a: DataFrame, b: DataFrame, group: str, order: Sequence[str], fields: Sequence[str], size: int) -> DataFrame:
    """The first ``size`` rows of each group on either side, paired by place: ``group, place, same``.

    The sample is the feature; ``row_number() <= size`` is applied before the shuffle by the window's group limit.
    """

    def first(df: DataFrame, p: str) -> DataFrame:
        w = Window.partitionBy(group).orderBy(*order, *fields)
        top = df.withColumn("place", F.row_number().over(w)).where(F.col("place") <= size)
        return top.select(F.col(group).alias(f"{p}_g"), F.col("place").alias(f"{p}_p"), F.struct(*order, *fields).alias(f"{p}_v"))

    joined = first(a, "a").join(first(b, "b"), F.expr("a_g <=> b_g and a_p = b_p"), "full")
    return joined.select(F.coalesce("a_g", "b_g").alias(group), F.coalesce("a_p", "b_p").cast("long").alias("place"), F.expr("a_v <=> b_v").alias("same"))


def summary(checks: DataFrame, group: str) -> DataFrame:
    """Whether all checks of a group agree."""
    return checks.groupBy(group).agg(F.every("same").alias("same"), F.count_if(~F.col("same")).alias("n_unlike"))


def rank_dictionary(indices: DataFrame, names: DataFrame, canonicals: DataFrame, sources: Sequence[int], codes: dict[str, str], ranks: Sequence[str] = FLAT_RANKS) -> DataFrame:
    """``name, rank, code`` of one-word names of higher ranks in trusted sources, the first source in ``sources`` deciding.

    ``codes`` maps the first name of a classification to a code; names under other roots are left out.
    """
    root = F.split("classification", r"\|")[0]
    code = F.lit(None).cast("string")
    for name, value in codes.items():
        code = F.when((root == name) | (F.col("name") == name), F.lit(value)).otherwise(code)
    priority = F.array_position(F.array(*(F.lit(s) for s in sources)), F.col("data_source_id"))
    rows = indices.where(F.col("data_source_id").isin(*sources) & F.lower("rank").isin(*ranks) & ~F.col("taxonomic_status").isin(*SYNONYMS))
    ns = names.select(F.col("id").alias("_n"), F.col("canonical_id").alias("_c"))
    cs = canonicals.select(F.col("id").alias("_i"), "name").where("name <> '' and not contains(name, ' ')")
    joined = rows.join(ns, F.col("name_string_id") == F.col("_n")).join(cs, F.col("_c") == F.col("_i")).withColumn("code", code).where("code is not null")
    best = joined.groupBy("name").agg(F.min(F.struct(priority.alias("p"), F.lower("rank").alias("rank"), "code")).alias("best"))
    return best.select("name", "best.rank", "best.code")
