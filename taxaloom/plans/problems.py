"""Queries over the core's data-processing problems, each over its whole tables, and the SQL that must agree."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaloom.functions.ids import BLANKS, clean_id, uuid_text
from taxaloom.operators import diff, hierarchy, orphans, packed, skew
from taxaloom.session import table

PACKED = ["classification", "classification_ranks", "classification_ids"]
UUIDS = ["name_string_id", "canonical_id", "accepted_name_id"]
COMPARED = ["name_string_id", "name", "canonical_id", "taxonomic_status", "accepted_name_id", "accepted_name"]
Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Taxa that are links of a circle."""
    rows = hierarchy.resolved(table(spark, d, "sfga_taxon"))
    return rows.where(F.col("state") == hierarchy.CYCLE).select(F.col("grp").alias("data_source_id"), F.col("id").alias("taxon_id"))


def p1_taxa(spark: SparkSession, d: str) -> DataFrame:
    """Root, depth and state of every taxon."""
    rows = hierarchy.resolved(table(spark, d, "sfga_taxon"))
    return rows.select(F.col("grp").alias("data_source_id"), F.col("id").alias("taxon_id"), F.col("root").alias("root_id"), "depth", "state")


def p1_paths(spark: SparkSession, d: str) -> DataFrame:
    """Path from the root of every rooted taxon."""
    rows = hierarchy.paths(table(spark, d, "sfga_taxon"))
    return rows.select(F.col("grp").alias("data_source_id"), F.col("id").alias("taxon_id"), F.array_join("path", "|").alias("path"))


def p1_descendants(spark: SparkSession, d: str) -> DataFrame:
    """All descendants of every taxon, with their distance."""
    rows = hierarchy.descendants(hierarchy.paths(table(spark, d, "sfga_taxon")))
    return rows.select(F.col("grp").alias("data_source_id"), F.col("ancestor").alias("taxon_id"), F.col("descendant").alias("descendant_id"), F.col("distance").cast("long").alias("distance"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Data sources that hold at least a twentieth of all rows."""
    return skew.heavy_keys(table(spark, d, "name_string_indices"), "data_source_id", 0.05).select("data_source_id")


def p2_profile(spark: SparkSession, d: str) -> DataFrame:
    """Rows, deleted rows, synonyms, classified rows and load times of every data source."""
    one = lambda c: F.coalesce(c, F.lit(False)).cast("long")
    return skew.tree_aggregate(
        table(spark, d, "name_string_indices"),
        ["data_source_id"],
        {
            "n_rows": ("sum", F.lit(1).cast("long")),
            "n_deleted": ("sum", one(F.col("deleted_at").isNotNull())),
            "n_synonyms": ("sum", one(F.lower("taxonomic_status").contains("synonym"))),
            "n_classified": ("sum", one(F.col("classification") != "")),
            "first_loaded": ("min", F.col("loaded_at")),
            "last_loaded": ("max", F.col("loaded_at")),
        },
    )


def p2_records(spark: SparkSession, d: str) -> DataFrame:
    """Number of different records of every data source."""
    return skew.distinct_counts(table(spark, d, "name_string_indices"), ["data_source_id"], "record_id", "n_records")


def _packed(spark: SparkSession, d: str, only_untidy: bool) -> DataFrame:
    rows = table(spark, d, "name_string_indices").withColumn("record_id", F.coalesce(clean_id(F.col("record_id")), F.lit("")))
    return packed.values(rows, ["data_source_id", "record_id"], PACKED, only_untidy)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """All values of the packed fields that are not their values joined by single bars."""
    return _packed(spark, d, True).distinct()


def p3_values(spark: SparkSession, d: str) -> DataFrame:
    """All values of all packed fields."""
    return _packed(spark, d, False)


def _orphans(spark: SparkSession, d: str) -> DataFrame:
    return orphans.catalogue_orphans(*(table(spark, d, t) for t in ("name_string_indices", "name_strings", "canonicals")))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """References to records that are missing, deleted or loaded later."""
    return _orphans(spark, d).select("tab", "field", "row_key", "ref_id").distinct()


def p4_report(spark: SparkSession, d: str) -> DataFrame:
    """Such references per table, field and month."""
    return _orphans(spark, d).groupBy("tab", "field", "month").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("ref_id").alias("n_refs"))


def _copies(spark: SparkSession, d: str) -> DataFrame:
    key = F.coalesce(clean_id(F.col("record_id")), F.lit("")).alias("record_id")
    as_uuid = lambda c: F.coalesce(uuid_text(c), F.when(c.isNotNull(), F.lit("")))  # noqa: E731  null equals only null
    fields = [as_uuid(F.col(c)).alias(c) if c in UUIDS else F.col(c) for c in COMPARED]
    a, b = (table(spark, d, f"verification_{x}").select("data_source_id", key, *fields, "loaded_at") for x in ("gndb", "togn"))
    return diff.differences(a, b, ["data_source_id", "record_id"], COMPARED, only=("only_gndb", "only_togn"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Records in one copy only and fields that differ."""
    return _copies(spark, d).select("data_source_id", "record_id", "diff")


def p6_values(spark: SparkSession, d: str) -> DataFrame:
    """The same with the values on either side."""
    return _copies(spark, d).select("data_source_id", "record_id", "diff", F.col("value_a").alias("gndb"), F.col("value_b").alias("togn"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (p1_found, p1_taxa, p1_paths, p1_descendants, p2_found, p2_profile, p2_records, p3_found, p3_values, p4_found, p4_report, p6_found, p6_values)}

_CHARS = " || ".join(f"chr({ord(c)})" for c in BLANKS)


def sql_trim(c: str) -> str:
    return f"trim({c}, {_CHARS})"


def sql_id(c: str) -> str:
    return f"nullif({sql_trim(c)}, '')"


def sql_uuid(c: str) -> str:
    bare = f"replace(translate(regexp_replace(lower({sql_trim(c)}), '^urn:uuid:', ''), '{{}}', ''), '-', '')"
    return (
        f"case when regexp_full_match({bare}, '[0-9a-f]{{32}}') then {bare}[1:8] || '-' || {bare}[9:12] || '-' || {bare}[13:16] || '-' || {bare}[17:20] || '-' || {bare}[21:32] else {sql_id(c)} end"
    )


_LINKS = f"""
raw as (select data_source_id, {sql_id("col__id")} id, coalesce({sql_id("col__parent_id")}, '') parent, loaded_at from sfga_taxon),
held as (select data_source_id, id, nullif(parent, id) parent from (
    select *, row_number() over (partition by data_source_id, id order by loaded_at desc nulls last, parent desc) k from raw where id is not null) where k = 1),
node as (select h.data_source_id, h.id, p.id up from held h left join held p on p.data_source_id = h.data_source_id and p.id = h.parent),
walk as (select data_source_id, id start, up cur, 1 n from node where up is not null
    union all select w.data_source_id, w.start, n.up, w.n + 1 from walk w join node n on n.data_source_id = w.data_source_id and n.id = w.cur
    where n.up is not null and w.n <= 400 and w.cur <> w.start)
"""
_CYCLE = "cyc as (select distinct data_source_id, start id from walk where cur = start)"
_BELOW = "low as (select distinct w.data_source_id, w.start id from walk w join cyc c on c.data_source_id = w.data_source_id and c.id = w.cur)"
ROOTED_SQL = f"with recursive {_LINKS}, {_CYCLE}, {_BELOW}, ok as (select n.* from node n anti join low l on l.data_source_id = n.data_source_id and l.id = n.id)"



def _orphan_sql() -> str:
    rec = f"cast(data_source_id as varchar) || '/' || coalesce({sql_id('record_id')}, '')"
    return f"""
refs as (
  select 'name_string_indices' tab, 'name_string_id' field, {rec} row_key, {sql_uuid("name_string_id")} ref_id, loaded_at, 'n' target from name_string_indices
  union all select 'name_string_indices', 'accepted_record_id', {rec}, {sql_id("accepted_record_id")}, loaded_at, 'r' || data_source_id from name_string_indices
    where {sql_id("accepted_record_id")} is distinct from {sql_id("record_id")}
  union all select 'name_strings', 'canonical_id', {sql_uuid("id")}, {sql_uuid("canonical_id")}, loaded_at, 'c' from name_strings),
asked as (select * from refs where ref_id is not null and not regexp_full_match(ref_id, '[0-]*')),
parents as (
  select target, key, min(loaded_at) since from (
    select 'n' target, {sql_uuid("id")} key, loaded_at from name_strings where deleted_at is null
    union all select 'c', {sql_uuid("id")}, loaded_at from canonicals where deleted_at is null
    union all select 'r' || data_source_id, {sql_id("record_id")}, loaded_at from name_string_indices where deleted_at is null) group by 1, 2),
bad as (select a.* from asked a left join parents p on p.target = a.target and p.key = a.ref_id where p.since is null or p.since > a.loaded_at)
"""


def _copy_sql(t: str) -> str:
    fields = ", ".join(f"coalesce({sql_uuid(c)}, left({c}, 0)) {c}" if c in UUIDS else c for c in COMPARED)
    return f"""(select * from (select *, row_number() over (partition by data_source_id, record_id order by loaded_at desc nulls last, {", ".join(f"{c} desc nulls last" for c in COMPARED)}) k
      from (select data_source_id, coalesce({sql_id("record_id")}, '') record_id, {fields}, loaded_at from verification_{t})) where k = 1)"""


def _diff_sql(values: bool) -> str:
    fields = "\n".join(
        f"  union all select a.data_source_id, a.record_id, '{c}' diff{f', a.{c} gndb, b.{c} togn' if values else ''} from a join b on a.data_source_id is not distinct from b.data_source_id and a.record_id = b.record_id where a.{c} is distinct from b.{c}"
        for c in COMPARED
    )
    more = ", cast(null as varchar) gndb, cast(null as varchar) togn" if values else ""
    return f"""with a as {_copy_sql("gndb")}, b as {_copy_sql("togn")}
  select a.data_source_id, a.record_id, 'only_gndb' diff{more} from a anti join b on a.data_source_id is not distinct from b.data_source_id and a.record_id = b.record_id
  union all select b.data_source_id, b.record_id, 'only_togn' diff{more} from b anti join a on a.data_source_id is not distinct from b.data_source_id and a.record_id = b.record_id
{fields}"""


SQL: dict[str, str] = {
    "p1_found": f"with recursive {_LINKS}, {_CYCLE} select data_source_id, id taxon_id from cyc",
    "p1_taxa": f"""with recursive {_LINKS}, {_CYCLE}, {_BELOW},
depth as (select data_source_id, start, max(n) n, arg_max(cur, n) root from walk group by 1, 2)
select n.data_source_id, n.id taxon_id, case when l.id is null then coalesce(d.root, n.id) end root_id, case when l.id is null then coalesce(d.n, 0) end depth,
  case when c.id is not null then 'cycle' when l.id is not null then 'below_cycle' else 'rooted' end state
from node n left join depth d on d.data_source_id = n.data_source_id and d.start = n.id left join cyc c on c.data_source_id = n.data_source_id and c.id = n.id
left join low l on l.data_source_id = n.data_source_id and l.id = n.id""",
    "p1_paths": f"""{ROOTED_SQL}
select o.data_source_id, o.id taxon_id, coalesce(string_agg(w.cur, '|' order by w.n desc) || '|', '') || o.id path
from ok o left join walk w on w.data_source_id = o.data_source_id and w.start = o.id group by o.data_source_id, o.id""",
    "p1_descendants": f"{ROOTED_SQL} select w.data_source_id, w.cur taxon_id, w.start descendant_id, w.n distance from walk w join ok o on o.data_source_id = w.data_source_id and o.id = w.start",
    "p2_found": "select data_source_id from name_string_indices group by 1 having count(*) >= 0.05 * (select count(*) from name_string_indices)",
    "p2_profile": """select data_source_id, count(*) n_rows, count(deleted_at) n_deleted, count(*) filter (where lower(taxonomic_status) like '%synonym%') n_synonyms,
  count(*) filter (where classification <> '') n_classified, min(loaded_at) first_loaded, max(loaded_at) last_loaded from name_string_indices group by 1""",
    "p2_records": "select data_source_id, count(distinct record_id) n_records from name_string_indices group by 1",
    "p4_found": f"with {_orphan_sql()} select distinct tab, field, row_key, ref_id from bad",
    "p4_report": f"with {_orphan_sql()} select tab, field, strftime(loaded_at, '%Y-%m') as month, count(*) n_rows, count(distinct ref_id) n_refs from bad group by 1, 2, 3",
    "p6_found": _diff_sql(False),
    "p6_values": _diff_sql(True),
}
