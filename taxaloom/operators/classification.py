"""Paths of names and ranks, flat classifications, and their columns.

Defined cases: null names and ranks are ``''`` in a path; flat ranks without a name are skipped; taxa on or below a circle
have no path of parents and fall back on their flat ranks; a name that can't be parsed is ``''`` in a path; empty
classifications unfold to nulls; ids without a name are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaloom.functions.codes import EXPORT_RANKS, FLAT_RANKS, GIVEN_RANKS, ballot, rank_by_suffix, winner
from taxaloom.functions.ids import clean_id
from taxaloom.operators.hierarchy import paths
from taxaloom.operators.parse import parsed

_NODE = "array<struct<name:string,rank:string,id:string>>"


def holding_rows(taxa: DataFrame) -> DataFrame:
    """The latest row of each taxon, with its id trimmed as ``id``; ties go to the greatest values."""
    cols = ["loaded_at", "col__scientific_name", "col__rank_id", *(c for r in GIVEN_RANKS for c in (f"col__{r}", f"sf__{r}_id"))]
    rows = taxa.select("data_source_id", clean_id(F.col("col__id")).alias("id"), F.struct(*cols).alias("row")).where("id is not null")
    return rows.groupBy("data_source_id", "id").agg(F.max("row").alias("row")).select("data_source_id", "id", "row.*")


def flat_nodes() -> Column:
    """Nodes of the flat ranks that have a name, in order of rank."""
    nodes = [F.struct(F.col(f"col__{r}").alias("name"), F.lit(r).alias("rank"), F.coalesce(f"sf__{r}_id", F.lit("")).alias("id")) for r in FLAT_RANKS if r in GIVEN_RANKS]
    return F.filter(F.array(*nodes), lambda n: F.coalesce(n["name"], F.lit("")) != "")


def breadcrumbs(taxa: DataFrame, prefer_flat: bool | Column = False) -> DataFrame:
    """``data_source_id, id, names, ranks, ids``: the path joined by ``|``, of canonical names; below two nodes the flat ranks come first.

    Where ``prefer_flat`` holds (for all, or by a condition on ``data_source_id``) only the flat ranks count.
    """
    rows = holding_rows(taxa)
    named = parsed(rows, "col__scientific_name")
    own = named.select(F.col("data_source_id").alias("_s"), F.col("id").alias("_i"), F.struct(F.coalesce("parsed_simple", F.lit("")).alias("name"), F.coalesce(F.lower("col__rank_id"), F.lit("")).alias("rank"), F.col("id").alias("id")).alias("_node"))
    steps = paths(taxa).select("grp", "id", F.posexplode("path").alias("at", "step"))
    walked = steps.join(own, F.expr("grp <=> _s and step = _i")).groupBy("grp", "id").agg(F.sort_array(F.collect_list(F.struct("at", "_node"))).alias("p"))
    walked = walked.select(F.col("grp").alias("_s"), F.col("id").alias("_i"), F.transform("p", lambda x: x["_node"]).alias("path"))
    joined = rows.join(walked, F.expr("data_source_id <=> _s and id = _i"), "left")
    nothing = F.array().cast(_NODE)
    path = F.when(F.lit(prefer_flat), nothing).otherwise(F.coalesce("path", nothing))
    chosen = F.when(F.size(path) < 2, F.concat(flat_nodes().cast(_NODE), path)).otherwise(path)
    nodes = joined.select("data_source_id", "id", chosen.alias("n"))
    return nodes.select("data_source_id", "id", *(F.array_join(F.col(f"n.{k}"), "|").alias(f"{k}s") for k in ("name", "rank", "id")))


def _told(names: DataFrame, name: str, dictionary: DataFrame) -> DataFrame:
    """``names`` with the dictionary's ``_known, _rank, _code`` of each."""
    d = dictionary.select(F.col("name").alias("_known"), F.col("rank").alias("_rank"), F.col("code").alias("_code"))
    return names.join(d, F.col(name) == F.col("_known"), "left")


def inferred_rank(name: Column, code: Column, rank: Column) -> Column:
    """The rank of a name without one: the dictionary's ``rank`` if an export has it, else that of the suffix, else ``''``."""
    return F.when(F.lower(rank).isin(*EXPORT_RANKS), rank).otherwise(rank_by_suffix(name, code))


def inferred_ranks(names: DataFrame, name: str, dictionary: DataFrame, codes: dict[str, Column]) -> DataFrame:
    """``names`` with one column of ranks for each code of ``codes``, by dictionary and suffix."""
    told = _told(names, name, dictionary)
    return told.select(*names.columns, *(inferred_rank(F.col(name), code, F.col("_rank")).alias(c) for c, code in codes.items()))


def votes(index: DataFrame, dictionary: DataFrame, classification: str = "classification") -> DataFrame:
    """Per different classification: ``classification, code, nodes`` (code 1, 2 or 0 by majority; nodes in order, with the dictionary's ranks)."""
    texts = index.select(F.col(classification).alias("classification")).where("classification <> ''").distinct()
    told = _told(texts.select("classification", F.posexplode(F.split("classification", r"\|")).alias("at", "name")), "name", dictionary)
    per = told.groupBy("classification").agg(
        F.sum(ballot(F.col("name"), F.col("_known").isNotNull(), F.col("_code"))).alias("n"), F.sort_array(F.collect_list(F.struct("at", "name", F.col("_rank").alias("rank")))).alias("nodes")
    )
    return per.select("classification", winner(F.col("n")).alias("code"), "nodes")


def unfolded(index: DataFrame, dictionary: DataFrame, code: str = "code_id") -> DataFrame:
    """Names and ids by rank and the parent's id from packed classifications: ``name_…``, ``id_…`` of each of ``EXPORT_RANKS``, ``parent_id``.

    Names and ranks are paired as far as both go; of a rank given twice the last holds. Where no ranks are given they are
    inferred under the record's code, else under the code its names vote for.
    """
    told = votes(index.where("coalesce(classification_ranks, '') = ''"), dictionary).select(F.col("classification").alias("_c"), F.col("code").alias("_voted"), "nodes")
    rows = index.where("classification <> ''").select("data_source_id", "record_id", F.col(code).cast("int").alias("code_id"), "classification", "classification_ranks", "classification_ids")
    bare = F.coalesce("classification_ranks", F.lit("")) == ""
    joined = rows.where(bare).join(told, F.col("classification") == F.col("_c"), "left")
    own = F.when(F.coalesce("code_id", F.lit(0)) != 0, F.col("code_id")).otherwise(F.col("_voted").cast("int"))
    lone = joined.withColumn("_code", own).withColumn("r", F.transform("nodes", lambda n: inferred_rank(n["name"], F.col("_code"), n["rank"])))
    given = rows.where(~bare).withColumn("r", F.split(F.lower("classification_ranks"), r"\|"))
    columns = ["data_source_id", "record_id", "classification", "classification_ids", "r"]
    every = lone.select(*columns).unionByName(given.select(*columns))
    every = every.withColumns({"n": F.split("classification", r"\|"), "i": F.split(F.coalesce("classification_ids", F.lit("")), r"\|")})
    every = every.withColumn("r", F.reverse(F.slice(F.transform("r", lambda x: F.lower(x)), F.lit(1), F.greatest(F.size("n"), F.lit(1)))))

    def at(rank: str, values: str) -> Column:
        place = F.array_position("r", F.lit(rank))  # from the end: the last name holds
        return F.when(place > 0, F.nullif(F.get(values, (F.size("r") - place).cast("int")), F.lit("")))

    parent = F.nullif(F.try_element_at("i", F.lit(-2)), F.lit(""))
    made = every.select("data_source_id", "record_id", *(at(r, "n").alias(f"name_{r}") for r in EXPORT_RANKS), *(at(r, "i").alias(f"id_{r}") for r in EXPORT_RANKS), parent.alias("parent_id"))
    empty = index.where("coalesce(classification, '') = ''").select("data_source_id", "record_id", *(F.lit(None).cast("string").alias(c) for c in made.columns[2:]))
    return made.unionByName(empty)
