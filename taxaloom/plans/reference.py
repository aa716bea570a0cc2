"""Queries over the catalogue's operators, each over its whole tables, and the SQL that must agree.

Operators of the catalogue are applied to the given tables: ``sfga_taxon`` holds taxa with their names,
``name_string_indices`` synonyms and bare names by state, the two ``verification`` tables two copies for comparison.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaloom.functions import codes, text
from taxaloom.functions.ids import uuid5
from taxaloom.operators import audit, classification, export, maintain, names, parse, verification, vernacular
from taxaloom.plans.problems import ROOTED_SQL, sql_uuid
from taxaloom.session import shared_folder, table
from taxaloom.sources import archives
from taxaloom.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query, with its SQL if there is one."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


_SHA = "sha1(unhex('90181196fecf5082a4c1411d4f314cda') || encode({c}))"


def sql_uuid5(c: str) -> str:
    h = _SHA.format(c=c)
    variant = f"""substr('89ab', ((instr('0123456789abcdef', substr({h}, 17, 1)) - 1) % 4) + 1, 1)"""
    return f"(substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-' || {variant} || substr({h}, 18, 3) || '-' || substr({h}, 21, 12))"


def _t(spark: SparkSession, d: str, *tables: str) -> list[DataFrame]:
    return [table(spark, d, t) for t in tables]


_TRIM = "trim({c}, ' ' || chr(9) || chr(10) || chr(13) || chr(160) || chr(12288) || chr(8203) || chr(8239) || chr(65279))"


def sql_clean(c: str) -> str:
    return f"nullif({_TRIM.format(c=c)}, '')"


@query(f"select id, {sql_uuid5('name')} made from name_strings")
def uuid5_names(spark: SparkSession, d: str) -> DataFrame:
    """Identity of every name from its text."""
    return table(spark, d, "name_strings").select("id", uuid5(F.col("name")).alias("made"))


@query(f"select distinct {sql_uuid5('col__scientific_name')} id, col__scientific_name name from sfga_taxon where trim(col__scientific_name) <> ''")
def names_loaded(spark: SparkSession, d: str) -> DataFrame:
    """Distinct names of the checklists."""
    return names.loaded_names(table(spark, d, "sfga_taxon"))


@query(
    f"""with new as (select distinct {sql_uuid5("col__scientific_name")} id, col__scientific_name name from sfga_taxon where trim(col__scientific_name) <> '')
select * from new where not exists (select 1 from name_strings n where n.id = new.id)"""
)
def names_inserted(spark: SparkSession, d: str) -> DataFrame:
    """Names of the checklists that aren't stored yet."""
    taxa, strings = _t(spark, d, "sfga_taxon", "name_strings")
    return names.absent(names.loaded_names(taxa), strings, ["id"])


@query(f"select distinct {sql_uuid5('col__scientific_name')} id, col__scientific_name name from sfga_taxon where trim(col__scientific_name) <> ''")
def names_streamed(spark: SparkSession, d: str) -> DataFrame:
    """The same names loaded as a stream in micro-batches, each adding what isn't there yet."""
    folder = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    rows = spark.readStream.schema(table(spark, d, "sfga_taxon").schema).option("maxFilesPerTrigger", 4).parquet(f"{d}/sfga_taxon.parque[t]")  # a pattern, as a stream reads no single file
    incremental.load(rows, f"{folder}/names", f"{folder}/progress", make=names.loaded_names).awaitTermination()
    return spark.read.parquet(f"{folder}/names").select("id", "name")


@query("select data_source_id, count(*) n_rows, count(*) filter (where coalesce(trim(coalesce(nullif(trim(gn__local_id), ''), col__scientific_name)), '') = '') n_blank from sfga_taxon group by 1")
def blank_names(spark: SparkSession, d: str) -> DataFrame:
    """Rows without any name, the local id standing for the checked spelling."""
    return names.blank_names(table(spark, d, "sfga_taxon"), checked="gn__local_id")


_LINK = "coalesce(substr(list_filter(list_transform(string_split(col__alternative_id, ','), lambda v: trim(v)), lambda v: starts_with(v, 'gnoutlink:'))[1], 11), '')"
_TAXA = f"""select data_source_id, {sql_clean("col__id")} record_id, {sql_uuid5("col__scientific_name")} name_string_id, case when col__alternative_id is not null then {_LINK} end outlink_id,
 gn__global_id global_id, gn__local_id local_id, lower(col__rank_id) as rank, lower(col__status_id) taxonomic_status, {sql_clean("col__id")} accepted_record_id
 from sfga_taxon where col__scientific_name is not null"""


@query(_TAXA)
def taxa_index(spark: SparkSession, d: str) -> DataFrame:
    """Index rows of all taxa."""
    return names.taxa_index(table(spark, d, "sfga_taxon"))


def _synonyms(spark: SparkSession, d: str) -> DataFrame:
    indices, strings = _t(spark, d, "name_string_indices", "name_strings")
    named = strings.groupBy(F.col("id").alias("_id")).agg(F.min("name").alias("name"))
    rows = indices.where(F.lower("taxonomic_status").contains("synonym")).join(named, F.col("name_string_id") == F.col("_id"))
    rows = rows.select("data_source_id", F.col("record_id").alias("col__id"), F.col("accepted_record_id").alias("col__taxon_id"), F.col("name_id").alias("col__name_id"), "name", F.col("taxonomic_status").alias("col__status_id"))
    return names.synonym_index(rows, indices.select("data_source_id", F.col("record_id").alias("col__id")))


_SYNONYMS = f"""select i.data_source_id, i.record_id || '|' || coalesce({sql_clean("i.accepted_record_id")}, '') || '|' || coalesce(i.name_id, '') record_id,
 {sql_uuid5("n.name")} name_string_id, cast(null as varchar) outlink_id, cast(null as varchar) global_id, cast(null as varchar) local_id, '' as rank,
 lower(i.taxonomic_status) taxonomic_status, {sql_clean("i.accepted_record_id")} accepted_record_id
 from name_string_indices i join (select id, min(name) name from name_strings group by 1) n on n.id = i.name_string_id
 where lower(i.taxonomic_status) like '%synonym%' and {sql_clean("i.record_id")} is distinct from {sql_clean("i.accepted_record_id")} and exists (select 1 from name_string_indices t where t.data_source_id = i.data_source_id and {sql_clean("t.record_id")} = {sql_clean("i.accepted_record_id")})"""


@query(_SYNONYMS)
def synonym_index(spark: SparkSession, d: str) -> DataFrame:
    """Index rows of synonyms whose taxon is known."""
    return _synonyms(spark, d)


_FREE = "select id, name from canonicals where id not in (select canonical_id from name_strings where canonical_id is not null)"


def _free(spark: SparkSession, d: str) -> DataFrame:
    strings, canonicals = _t(spark, d, "name_strings", "canonicals")
    return names.not_in(canonicals.select("id", "name"), "id", strings.where("canonical_id is not null"), "canonical_id")


@query(_FREE)
def bare_names(spark: SparkSession, d: str) -> DataFrame:
    """Canonical names that no name uses."""
    return _free(spark, d)


@query("select id, name from canonicals where id not in (select canonical_id from name_strings)")
def bare_names_null_aware(spark: SparkSession, d: str) -> DataFrame:
    """The same as SQL's NOT IN has it: a null among the used ids leaves nothing."""
    strings, canonicals = _t(spark, d, "name_strings", "canonicals")
    return names.not_in(canonicals.select("id", "name"), "id", strings, "canonical_id")


_SYNONYM = "taxonomic_status in ('synonym', 'ambiguous synonym', 'misapplied')"


@query(
    f"""select id, name from name_strings where id not in (select name_string_id from name_string_indices where name_string_id is not null and {_SYNONYM} is not true
 union select name_string_id from name_string_indices where name_string_id is not null and {_SYNONYM})"""
)
def bare_names_union(spark: SparkSession, d: str) -> DataFrame:
    """Names that neither a taxon nor a synonym uses."""
    indices, strings = _t(spark, d, "name_string_indices", "name_strings")
    used = indices.where("name_string_id is not null")
    return names.bare(strings.select("id", "name"), "id", [(export.export_taxa(used), "name_string_id"), (export.export_synonyms(used), "name_string_id")])


_BARE = f"""select 0 data_source_id, 'bare-name-' || id record_id, {sql_uuid5("name")} name_string_id, '' outlink_id, '' global_id, '' local_id, '' as rank, 'bare name' taxonomic_status,
 'bare-name-' || id accepted_record_id from ({_FREE})"""


@query(f"{_TAXA} union all {_SYNONYMS} union all {_BARE}")
def all_indices(spark: SparkSession, d: str) -> DataFrame:
    """Taxa, synonyms and bare names in one index."""
    return names.taxa_index(table(spark, d, "sfga_taxon")).unionByName(_synonyms(spark, d)).unionByName(names.bare_index(_free(spark, d), 0))


@query("select data_source_id, record_id, accepted_record_id, count(*) n_rows from name_string_indices group by all having count(*) > 1")
def repeated_keys(spark: SparkSession, d: str) -> DataFrame:
    """Index keys of several rows."""
    return names.repeated_keys(table(spark, d, "name_string_indices"))


_VIEW = """with rows as (select i.*, n.name, n.year, n.cardinality, n.canonical_id, n.virus, n.bacteria, n.surrogate, n.parse_quality
   from name_string_indices i join name_strings n on n.id = i.name_string_id),
 view as (select r.data_source_id, r.record_id, r.name_string_id, r.name, r.name_id, r.code_id, r.year, r.cardinality, r.canonical_id, r.virus, r.bacteria, r.parse_quality, r.local_id,
   r.outlink_id, r.taxonomic_status, r.accepted_record_id, a.name_string_id accepted_name_id, a.name accepted_name, r.classification, r.classification_ranks, r.classification_ids
   from rows r left join rows a on a.data_source_id = r.data_source_id and a.record_id = r.accepted_record_id
   where (r.canonical_id is not null and r.surrogate <> true and (r.bacteria <> true or r.parse_quality < 3)) or r.virus = true)"""


def _view(spark: SparkSession, d: str) -> DataFrame:
    return verification.verification(*_t(spark, d, "name_string_indices", "name_strings"))


@query(f"{_VIEW} select * from view")
def verification_view(spark: SparkSession, d: str) -> DataFrame:
    """The lookup table."""
    return _view(spark, d)


@query(f"{_VIEW} select * from view where name_string_id in (select name_string_id from verification_gndb)")
def lookup_by_name(spark: SparkSession, d: str) -> DataFrame:
    """Lookup of the names of a copy."""
    return verification.lookup(_view(spark, d), table(spark, d, "verification_gndb"), "name_string_id")


@query(f"{_VIEW} select * from view where canonical_id in (select canonical_id from verification_gndb)")
def lookup_by_canonical(spark: SparkSession, d: str) -> DataFrame:
    """Lookup of its canonical names."""
    return verification.lookup(_view(spark, d), table(spark, d, "verification_gndb"), "canonical_id")


@query(f"{_VIEW} select year, count(*) n_rows, count(distinct name_string_id) n_names from view where year is not null group by 1")
def lookup_by_year(spark: SparkSession, d: str) -> DataFrame:
    """Rows and names of each year."""
    return _view(spark, d).where("year is not null").groupBy("year").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("name_string_id").alias("n_names"))


@query("select id, name from name_strings n where not exists (select 1 from name_string_indices i where i.name_string_id = n.id)")
def orphan_names(spark: SparkSession, d: str) -> DataFrame:
    """Names without an index row."""
    indices, strings = _t(spark, d, "name_string_indices", "name_strings")
    return maintain.orphans(strings, "id", indices, "name_string_id").select("id", "name")


@query(
    """select id, name from canonicals c where not exists (select 1 from name_strings n where n.canonical_id = c.id
 and exists (select 1 from name_string_indices i where i.name_string_id = n.id))"""
)
def orphan_canonicals(spark: SparkSession, d: str) -> DataFrame:
    """Canonical names that no name with an index row uses."""
    indices, strings, canonicals = _t(spark, d, "name_string_indices", "name_strings", "canonicals")
    left, _ = maintain.cascade(strings, indices, {})
    return maintain.orphans(canonicals, "id", left, "canonical_id").select("id", "name")


_EPITHET = r"[a-z\xDF-\xF6\xF8-\xFF][a-z\xDF-\xF6\xF8-\xFF-]+"
_GENUS = r"^(?:[x\xD7]\s*)?([A-Z\xC0-\xD6\xD8-\xDE][a-z\xDF-\xF6\xF8-\xFF-]+)"
_SUB = r"(?: \([A-Z][a-z-]+\))?"
_MARKERS = r"subsp\.|ssp\.|var\.|subvar\.|f\.|fo\.|forma|subf\.|cv\.|nothosubsp\.|nothovar\.|morph|ab\."
_TAKEN = "in|ex|et|and|de|von|van|da|del|der|du|le|la|bis|filius"
_SPECIES = rf"{_GENUS}{_SUB}(?: [x\xD7])? ({_EPITHET})(?: |,|$)"


def _sql_stem(w: str) -> str:
    return f"regexp_replace({w}, '^(.{{2,}}?)(?:ibus|arum|orum|ius|ium|us|um|is|os|on|as|es|ae|am|ei|ii|a|e|i|o|u)$', '\\1')"


def _joined(*parts: str) -> str:
    return f"array_to_string(list_filter([{', '.join(parts)}], lambda x: x <> ''), ' ')"


def parsed_sql(rows: str, code: str = "0") -> str:
    """Tables ``w0`` to ``parsed``: the rows of a query with ``name``, and the parts of their names under a code."""
    return rf"""w0 as (select *, trim(regexp_replace(name, '\s+', ' ', 'g')) tx, coalesce({code}, 0) cd from ({rows})),
 w1 as (select *, coalesce(regexp_extract(tx, '{_GENUS}', 1), '') genus, coalesce(regexp_extract(tx, '{_SPECIES}', 2), '') ep,
   coalesce(regexp_matches(tx, '(?i)\b(?:[a-z-]*virus(?:es)?|[a-z-]*viroids?|[a-z-]*phages?|prions?)\b'), false) or cd = 4 p_virus,
   coalesce(regexp_matches(tx, '\b(?:sp|spp|cf|aff|nr)\.|\bindet\b'), false) p_surrogate from w0),
 w2 as (select *, genus <> '' and not p_virus ok, case when ep <> '' then regexp_extract(tx, '{_GENUS}{_SUB} {_EPITHET} (?:[^|]*? )?(?:{_MARKERS}) ({_EPITHET})(?: |,|$)', 2) else '' end marked,
   case when ep <> '' then regexp_extract(tx, '{_GENUS}{_SUB} {_EPITHET} ({_EPITHET})(?: |,|$)', 2) else '' end third from w1),
 w3 as (select *, case when marked <> '' then marked when regexp_matches(third, '^(?:{_TAKEN})(?:[^A-Za-z0-9_]|$)') then '' else third end infra,
   case when marked <> '' then regexp_extract(tx, ' ({_MARKERS}) {_EPITHET}(?: |,|$)', 1) else '' end marker from w2),
 parsed as (select * exclude (tx, cd, genus, ep, ok, marked, third, infra, marker), case when ok and not p_surrogate then {_joined('genus', 'ep', 'infra')} when ok then genus end p_simple,
   case when ok and not p_surrogate and marker <> '' then {_joined('genus', 'ep', 'marker', 'infra')} end p_full,
   case when ok and not p_surrogate and ep <> '' then {_joined('genus', _sql_stem('ep'), _sql_stem('infra'))} end p_stem,
   case when ok and not p_surrogate then 1 + (ep <> '')::int + (infra <> '')::int end p_cardinality,
   case when ok then try_cast(regexp_extract(tx, '\b(1[5-9]\d\d|20\d\d)[a-z]?\)?$', 1) as smallint) end p_year, cd = 3 p_bacteria,
   case when not ok and not p_virus then 0 when p_surrogate then 3 when name is null then 0 when regexp_matches(tx, '[^\p{{L}}0-9 .,&()\x27-]') or tx <> name then 2 else 1 end p_quality,
   case when ep <> '' then regexp_replace(tx, '{_SPECIES}', ' ') when cd = 2 then regexp_replace(tx, '{_GENUS}', '') else regexp_replace(tx, '{_GENUS}{_SUB}', '') end p_tail from w3)"""


_PARTS = ("simple", "full", "stem", "cardinality", "year", "virus", "bacteria", "surrogate", "quality")
_PARSED = ", ".join([*(f"p_{x} parsed_{x}" for x in _PARTS), *(f"{sql_uuid5(f'p_{x}')} parsed_{x}_id" for x in ("simple", "full", "stem"))])


@query(f"with {parsed_sql('select id, name from name_strings')} select id, name, {_PARSED} from parsed")
def parse_names(spark: SparkSession, d: str) -> DataFrame:
    """Canonical forms, year, cardinality, flags and quality of every name."""
    return parse.parse(table(spark, d, "name_strings").select("id", "name"))


_CODED = "select i.data_source_id, i.record_id, i.code_id, n.name from name_string_indices i join (select id, min(name) name from name_strings group by 1) n on n.id = i.name_string_id"


@query(f"with {parsed_sql(_CODED, 'code_id')} select data_source_id, record_id, code_id, name, {_PARSED} from parsed")
def parse_by_code(spark: SparkSession, d: str) -> DataFrame:
    """The same of every record's name under the record's code."""
    indices, strings = _t(spark, d, "name_string_indices", "name_strings")
    text = strings.groupBy(F.col("id").alias("_id")).agg(F.min("name").alias("name"))
    rows = indices.select("data_source_id", "record_id", "code_id", "name_string_id").join(text, F.col("name_string_id") == F.col("_id"))
    return parse.parse(rows.select("data_source_id", "record_id", "code_id", "name"), code=F.col("code_id"))


def _reparsed(spark: SparkSession, d: str) -> DataFrame:
    strings = table(spark, d, "name_strings")
    return parse.changed(parse.with_bacteria(parse.parse(strings), parse.bacterial_genera(strings)))


_STORED = "canonical_id, surrogate, virus, bacteria, parse_quality"
_CHANGED = f"""{parsed_sql('select * from name_strings')},
 genera as (select split_part(p_simple, ' ', 1) g from parsed where p_simple is not null group by 1 having sum(case bacteria when true then 1 when false then -1 else 0 end) > 0),
 told as (select * exclude (p_bacteria), p_bacteria or coalesce(split_part(p_simple, ' ', 1) in (select g from genera), false) p_bacteria, {sql_uuid5('p_simple')} p_id from parsed),
 changed as (select *, {sql_uuid5('p_full')} f_id, {sql_uuid5('p_stem')} s_id from told where not (coalesce(parse_quality, 0) + p_quality = 0 and not p_virus)
   and case when p_simple is null then coalesce(virus, false) <> p_virus else {sql_uuid('canonical_id')} is distinct from p_id or coalesce(surrogate, false) <> p_surrogate
     or coalesce(bacteria, false) <> p_bacteria or coalesce(virus, false) <> p_virus end)"""


@query(f"with {_CHANGED} select id, name, canonical_id, p_id parsed_simple_id, p_virus parsed_virus, p_bacteria parsed_bacteria, p_surrogate parsed_surrogate from changed")
def reparse_changes(spark: SparkSession, d: str) -> DataFrame:
    """Names whose stored canonical id or flags differ from the parsed ones."""
    return _reparsed(spark, d).select("id", "name", "canonical_id", "parsed_simple_id", "parsed_virus", "parsed_bacteria", "parsed_surrogate")


_WRITTEN = {"canonical_id": "simple_id", "canonical_full_id": "full_id", "canonical_stem_id": "stem_id", "virus": "virus", "bacteria": "bacteria", "surrogate": "surrogate", "parse_quality": "quality"}
_NEW = {"canonical_id": "p_id", "canonical_full_id": "f_id", "canonical_stem_id": "s_id", "virus": "p_virus", "bacteria": "p_bacteria", "surrogate": "p_surrogate", "parse_quality": "p_quality"}


@query(
    f"""with {_CHANGED}, new as (select id i, min({{{', '.join(f"'{k}': {v}" for k, v in _NEW.items())}}}) v from changed group by 1)
 select {', '.join(f"case when i is null then {c} else v.{c} end {c}" if c in _NEW else c for c in ('id', 'name', 'year', 'cardinality', *_NEW, 'loaded_at', 'deleted_at'))} from name_strings left join new on i = id"""
)
def reparse_update(spark: SparkSession, d: str) -> DataFrame:
    """The names after the update; of rows of one id that parse differently the least holds."""
    changes = _reparsed(spark, d).groupBy("id").agg(F.min(F.struct(*(F.col(f"parsed_{v}").alias(k) for k, v in _WRITTEN.items()))).alias("v"))
    return maintain.updated(table(spark, d, "name_strings"), changes.select("id", "v.*"), "id", list(_WRITTEN))


def _forms(spark: SparkSession, d: str, part: str) -> DataFrame:
    """Canonical forms of one kind of all names."""
    rows = parse.parse(table(spark, d, "name_strings").select("name"))
    return rows.where(f"parsed_{part} <> ''").select(F.col(f"parsed_{part}_id").alias("id"), F.col(f"parsed_{part}").alias("name")).distinct()


@query(
    f"""with {parsed_sql('select name from name_strings')} select distinct {sql_uuid5('p_simple')} id, p_simple name from parsed
 where p_simple <> '' and {sql_uuid5('p_simple')} not in (select id from canonicals)"""
)
def canonicals_inserted(spark: SparkSession, d: str) -> DataFrame:
    """Canonical names of parsed names that aren't stored yet."""
    return names.absent(_forms(spark, d, "simple"), table(spark, d, "canonicals"), ["id"])


@query(f"with {parsed_sql('select name from name_strings')} select distinct {sql_uuid5('p_full')} id, p_full name from parsed where p_full <> ''")
def full_canonicals_loaded(spark: SparkSession, d: str) -> DataFrame:
    """Full canonical forms, of names where they differ from the simple ones."""
    return _forms(spark, d, "full")


@query(f"with {parsed_sql('select name from name_strings')} select distinct {sql_uuid5('p_stem')} id, p_stem name from parsed where p_stem <> ''")
def stem_canonicals_loaded(spark: SparkSession, d: str) -> DataFrame:
    """Stemmed canonical forms."""
    return _forms(spark, d, "stem")


_USED = f"""with {parsed_sql('select id, name from name_strings')},
 left_over as (select * from parsed p where exists (select 1 from name_string_indices i where i.name_string_id = p.id))"""


@query(
    f"""{_USED} select 'full' form, f.* from (select distinct {sql_uuid5('p_full')} id, p_full name from parsed where p_full <> '') f where id not in (select {sql_uuid5('p_full')} from left_over where p_full is not null)
 union all select 'stem', s.* from (select distinct {sql_uuid5('p_stem')} id, p_stem name from parsed where p_stem <> '') s where id not in (select {sql_uuid5('p_stem')} from left_over where p_stem is not null)"""
)
def orphan_forms(spark: SparkSession, d: str) -> DataFrame:
    """Full and stemmed canonical forms that no name with an index row uses."""
    indices, strings = _t(spark, d, "name_string_indices", "name_strings")
    rows = parse.parse(strings.select("id", "name"))
    left, _ = maintain.cascade(rows, indices, {})
    of = lambda part: maintain.orphans(_forms(spark, d, part), "id", left, f"parsed_{part}_id").select(F.lit(part).alias("form"), "id", "name")
    return of("full").unionByName(of("stem"))


_WORDS = rf"""{parsed_sql('select distinct id, name from name_strings')},
 fine as (select id, name, p_simple, string_split(p_simple, ' ') p, regexp_extract_all(regexp_replace(p_tail, '\b(?:subgen|subg|sect|subsect|ser|subser)\. \p{{Lu}}[\p{{L}}-]+', '', 'g'), '(?:^|[ (.])(\p{{Lu}}[\p{{L}}''-]+)', 1) a
   from parsed where p_simple is not null and not p_surrogate and not regexp_matches(name, '(?:^|\s)[x\xD7]\s')),
 one as (select id, p_simple, unnest(list_distinct(list_concat(list_transform(range(2, len(p) + 1), lambda k: {{'w': p[k], 'm': {_sql_stem('p[k]')}, 't': case when k = 2 then 2 else 3 end}}),
   list_transform(a, lambda x: {{'w': x, 'm': lower(x), 't': 4}})))) e from fine),
 word as (select id, {sql_uuid5('p_simple')} canonical_id, {sql_uuid5("(e.m || '|' || e.t)")} word_id, e.w normalized, e.m modified, e.t type_id from one)"""


def _words(spark: SparkSession, d: str) -> DataFrame:
    return parse.words(table(spark, d, "name_strings").select("id", "name").distinct())


@query(f"with {_WORDS} select distinct word_id, id name_string_id, canonical_id from word")
def word_links(spark: SparkSession, d: str) -> DataFrame:
    """Words of names, linked to the names and their canonical forms."""
    return _words(spark, d).select("word_id", F.col("id").alias("name_string_id"), "canonical_id").distinct()


@query(f"with {_WORDS} select distinct word_id, normalized, modified, type_id from word")
def words(spark: SparkSession, d: str) -> DataFrame:
    """Distinct words."""
    return _words(spark, d).select("word_id", "normalized", "modified", "type_id").distinct()


_FLAT = "list_filter([{}], lambda n: coalesce(n.name, '') <> '')".format(", ".join(f"{{'name': col__{r}, 'rank': '{r}', 'id': coalesce(sf__{r}_id, '')}}" for r in codes.GIVEN_RANKS))


_HELD = f"""own as (select *, {_FLAT} f from (select *, {sql_clean("col__id")} id, row_number() over (partition by data_source_id, {sql_clean("col__id")} order by loaded_at desc nulls last,
   col__scientific_name desc nulls last, col__rank_id desc nulls last{"".join(f", col__{r} desc nulls last, sf__{r}_id desc nulls last" for r in codes.GIVEN_RANKS)}) k from sfga_taxon) where k = 1 and id is not null)"""
_JOINED = ", ".join(f"coalesce(array_to_string(list_transform(f, lambda n: n.{k}), '|'), '') {k}s" for k in ("name", "rank", "id"))


@query(f"with {_HELD} select data_source_id, id, {_JOINED} from own")
def flat_classification(spark: SparkSession, d: str) -> DataFrame:
    """Path from the flat ranks alone."""
    return classification.breadcrumbs(table(spark, d, "sfga_taxon"), prefer_flat=True)


@query(
    f"""{ROOTED_SQL}, {_HELD},
 step as (select w.data_source_id, w.start id, w.cur, w.n from walk w join ok o on o.data_source_id = w.data_source_id and o.id = w.start union all select data_source_id, id, id, 0 from ok),
 {parsed_sql('select distinct col__scientific_name as name from sfga_taxon')},
 path as (select s.data_source_id, s.id, list({{'name': coalesce(c.p_simple, ''), 'rank': coalesce(lower(w.col__rank_id), ''), 'id': w.id}} order by s.n desc) p
   from step s join own w on w.data_source_id = s.data_source_id and w.id = s.cur left join parsed c on c.name = w.col__scientific_name group by 1, 2)
 select data_source_id, id, {_JOINED} from (select w.data_source_id, w.id, case when coalesce(len(p), 0) < 2 then list_concat(w.f, coalesce(p, [])) else p end f
   from own w left join path on path.data_source_id = w.data_source_id and path.id = w.id)"""
)
def breadcrumbs(spark: SparkSession, d: str) -> DataFrame:
    """Path of names, ranks and ids of every taxon."""
    return classification.breadcrumbs(table(spark, d, "sfga_taxon"))


# The ranks of an export, written out here to be independent of the code.
_RANKS = "kingdom phylum subphylum class subclass order suborder superfamily family subfamily tribe subtribe genus subgenus species".split()
_RANKED = "(" + ", ".join(f"'{r}'" for r in _RANKS) + ")"
_DICT = """r as (select c.name, lower(i.rank) as rank, case when split_part(i.classification, '|', 1) = 'Monalia' then 'iczn' when split_part(i.classification, '|', 1) = 'Phytalia' then 'icn' end code,
  list_position([1, 3, 9], i.data_source_id) p from name_string_indices i join name_strings n on n.id = i.name_string_id join canonicals c on c.id = n.canonical_id
  where i.data_source_id in (1, 3, 9) and lower(i.rank) in ('kingdom', 'phylum', 'subphylum', 'class', 'order', 'suborder', 'superfamily', 'family', 'subfamily', 'tribe', 'subtribe', 'genus', 'subgenus', 'section', 'species')
   and i.taxonomic_status not in ('synonym', 'ambiguous synonym', 'misapplied') and c.name <> '' and c.name not like '% %'),
 dict as (select name, min({'p': p, 'rank': rank, 'code': code}).rank as rank, min({'p': p, 'rank': rank, 'code': code}).code code from r where code is not null group by 1)"""


def _dictionary(spark: SparkSession, d: str) -> DataFrame:
    return audit.rank_dictionary(*_t(spark, d, "name_string_indices", "name_strings", "canonicals"), [1, 3, 9], {"Monalia": "iczn", "Phytalia": "icn"})


@query(f"with {_DICT} select * from dict")
def rank_dictionary(spark: SparkSession, d: str) -> DataFrame:
    """Ranks and codes of one-word names in trusted sources."""
    return _dictionary(spark, d)


def _sql_rank(name: str, code: str, rank: str) -> str:
    low = f"lower({name})"
    return f"""case when lower({rank}) in {_RANKED} then {rank} when {low} like '%aceae' then 'family' when {low} like '%oideae' then 'subfamily' when {low} like '%eae' then 'tribe' when {low} like '%ales' then 'order'
 when {low} like '%ineae' then 'suborder' when {low} like '%idae' then 'family' when {low} like '%ini' then 'tribe' when {low} like '%oidea' then 'superfamily'
 when {low} like '%opsida' or {low} like '%mycetes' or {low} like '%phyceae' then 'class' when {low} like '%phyta' or {low} like '%mycota' then 'phylum'
 when {low} like '%inae' and {code} = 2 then 'subtribe' when {low} like '%inae' then 'subfamily' when {low} like '%ina' and {code} = 1 then 'subtribe' else '' end"""


_VOTED = """texts as (select distinct classification c from name_string_indices where classification <> ''),
 node as (select c, unnest(string_split(c, '|')) nm, generate_subscripts(string_split(c, '|'), 1) k from texts),
 voted as (select c, case when sum(b) > 0 then 1 when sum(b) < 0 then 2 else 0 end v, list(nm order by k) ns, list(rank order by k) rs from (select c, nm, k, d.rank, case when d.name is not null then
   case d.code when 'iczn' then 1 when 'icn' then -1 else 0 end when regexp_matches(lower(nm), '(idae|ini)$') then 1 when regexp_matches(lower(nm), '(aceae|oideae|eae)$') then -1 else 0 end b
   from node left join dict d on d.name = nm) group by 1)"""
_PAIRED_UP = f"""given as (select i.*, ns, rs, case when coalesce(code_id, 0) <> 0 then code_id else coalesce(v, 0) end cd from name_string_indices i left join voted on c = classification),
 ranked as (select *, case when coalesce(classification_ranks, '') <> '' then string_split(lower(classification_ranks), '|')
   else list_transform(range(1, len(ns) + 1), lambda k: lower({_sql_rank('ns[k]', 'cd', 'rs[k]')})) end rr, string_split(classification, '|') nn, string_split(coalesce(classification_ids, ''), '|') ii from given),
 z as (select *, list_transform(range(1, least(len(rr), len(nn)) + 1), lambda k: {{'r': rr[k], 'n': nn[k], 'i': ii[k]}}) zz from ranked)"""
_UNFOLD = ", ".join(f"nullif(list_filter(zz, lambda x: x.r = '{r}')[-1].{k}, '') {n}_{r}" for n, k in (("name", "n"), ("id", "i")) for r in _RANKS)


@query(f"with {_DICT}, {_VOTED}, {_PAIRED_UP} select data_source_id, record_id, {_UNFOLD}, case when coalesce(classification, '') <> '' and len(ii) >= 2 then nullif(ii[-2], '') end parent_id from z")
def unfolded_classification(spark: SparkSession, d: str) -> DataFrame:
    """Names and ids by rank and the parent's id from packed classifications."""
    return classification.unfolded(table(spark, d, "name_string_indices"), _dictionary(spark, d))


_BARE_RANKS = "select * replace (null as classification_ranks) from name_string_indices"


@query(f"with {_DICT}, {_VOTED}, {_PAIRED_UP.replace('name_string_indices', f'({_BARE_RANKS})')} select data_source_id, record_id, {_UNFOLD}, case when coalesce(classification, '') <> '' and len(ii) >= 2 then nullif(ii[-2], '') end parent_id from z")
def unfolded_without_ranks(spark: SparkSession, d: str) -> DataFrame:
    """The same if no record gave ranks: all are inferred from the dictionary, the code and the suffixes."""
    rows = table(spark, d, "name_string_indices").withColumn("classification_ranks", F.lit(None).cast("string"))
    return classification.unfolded(rows, _dictionary(spark, d))


@query(
    f"""with {_DICT} select data_source_id, col__id, col__scientific_name as name, {_sql_rank('col__scientific_name', '1', 'd.rank')} rank_zoo, {_sql_rank('col__scientific_name', '2', 'd.rank')} rank_bot
 from sfga_taxon left join dict d on d.name = col__scientific_name"""
)
def rank_inference(spark: SparkSession, d: str) -> DataFrame:
    """Ranks that the dictionary or suffixes tell under either code."""
    rows = table(spark, d, "sfga_taxon").select("data_source_id", "col__id", F.col("col__scientific_name").alias("name"))
    return classification.inferred_ranks(rows, "name", _dictionary(spark, d), {"rank_zoo": F.lit(1), "rank_bot": F.lit(2)})


@query(f"with {_DICT}, {_VOTED} select data_source_id, record_id, cast(coalesce(v, 0) as smallint) code from name_string_indices left join voted on c = classification")
def code_vote(spark: SparkSession, d: str) -> DataFrame:
    """Code that the names of each classification vote for."""
    rows = table(spark, d, "name_string_indices").select("data_source_id", "record_id", "classification")
    told = classification.votes(rows, _dictionary(spark, d)).select(F.col("classification").alias("_c"), "code")
    return rows.join(told, F.col("classification") == F.col("_c"), "left").select("data_source_id", "record_id", F.coalesce("code", F.lit(0)).cast("smallint").alias("code"))


@query(
    """select data_source_id, lower(rank) as rank, lower(taxonomic_status) status, count(*) n_rows, cast(case code_id when 1 then 1 when 2 then 2 when 3 then 3 else 0 end as smallint) code from name_string_indices group by all"""
)
def codes_and_ranks(spark: SparkSession, d: str) -> DataFrame:
    """Records by rank, state and code number, the number read from the code's word in any case."""
    word = F.element_at(F.array(*map(F.lit, ("none", "Zoological", "BOTANICAL", "bacterial"))), F.coalesce("code_id", F.lit(0)).cast("int") + 1)
    rows = table(spark, d, "name_string_indices").select("data_source_id", F.lower("rank").alias("rank"), F.lower("taxonomic_status").alias("status"), codes.code_number(word).alias("code"))
    return rows.groupBy("data_source_id", "rank", "status", "code").agg(F.count(F.lit(1)).alias("n_rows"))


@query(f"select distinct {sql_uuid5('name')} id, name from vernacular_strings where name is not null and octet_length(encode(name)) <= 500")
def vernacular_strings_loaded(spark: SparkSession, d: str) -> DataFrame:
    """Distinct vernacular names with their ids."""
    return vernacular.strings(table(spark, d, "vernacular_strings"))


_LONG = "repeat(name || '; ', 40)"


@query(
    f"""with long as (select distinct {_LONG} t from vernacular_strings where name is not null),
 fit as (select case when octet_length(encode(t)) <= 500 then t else t[1:list_max(list_filter(range(1, length(t) + 1), lambda k: octet_length(encode(t[1:k])) <= 500))] end name from long)
 select distinct {sql_uuid5('name')} id, name from fit"""
)
def vernacular_strings_cut(spark: SparkSession, d: str) -> DataFrame:
    """Names repeated forty times, most of which are longer than their column."""
    rows = table(spark, d, "vernacular_strings").select(F.repeat(F.concat("name", F.lit("; ")), F.lit(40)).alias("name"))
    return vernacular.strings(rows)


@query(
    """select distinct data_source_id, record_id, vernacular_string_id, language, locality, country_code, '' language_orig, '' lang_code, false preferred from vernacular_string_indices"""
)
def vernacular_indices_loaded(spark: SparkSession, d: str) -> DataFrame:
    """Distinct vernacular index rows."""
    return vernacular.indices(table(spark, d, "vernacular_string_indices"))


@query(
    """with two as (select lang_code2 k, min({'c': lang_code, 'l': language}) v from languages where lang_code2 is not null group by 1), three as (select lang_code k, min(language) v from languages group by 1),
 named as (select language k, min(lang_code) v from languages group by 1),
 r as (select v.data_source_id, v.record_id, v.vernacular_string_id, v.locality, v.country_code, v.preferred, v.language_orig o, v.language l, v.lang_code c, two.v v2, three.v v3, named.v vn,
   octet_length(encode(coalesce(v.language, ''))) n, octet_length(encode(coalesce(v.lang_code, ''))) = 3 coded
   from vernacular_string_indices v left join two on two.k = v.language left join three on three.k = v.language left join named on named.k = v.language)
 select data_source_id, record_id, vernacular_string_id, locality, country_code, preferred, coalesce(nullif(o, ''), l) language_orig,
   case when n = 2 then coalesce(v2.l, l) when n = 3 then coalesce(v3, l) else l end as language,
   lower(case when n = 2 and v2 is not null and not coded then v2.c when n = 3 and v3 is not null and not coded then l when n not in (2, 3) and not coded then coalesce(vn, c) else c end) lang_code from r"""
)
def language_normalised(spark: SparkSession, d: str) -> DataFrame:
    """Vernaculars with languages and codes in the reference list's spelling."""
    return vernacular.normalised(*_t(spark, d, "vernacular_string_indices", "languages"))


@query("select data_source_id, lower(language) as language, count(*) n_rows, count(distinct vernacular_string_id) n_names from vernacular_string_indices group by all")
def vernacular_counts(spark: SparkSession, d: str) -> DataFrame:
    """Vernaculars by source and language."""
    return table(spark, d, "vernacular_string_indices").groupBy("data_source_id", F.lower("language").alias("language")).agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("vernacular_string_id").alias("n_names"))


@query(f"select data_source_id, col__id, case when col__alternative_id is not null then {_LINK} end outlink from sfga_taxon")
def outlink_values(spark: SparkSession, d: str) -> DataFrame:
    """Ids for links, from alternative ids."""
    return table(spark, d, "sfga_taxon").select("data_source_id", "col__id", text.outlink_value(F.lit("name.col__alternative_id"), F.col("col__alternative_id")).alias("outlink"))


@query(
    r"""select data_source_id, col__id, try_cast(nullif(regexp_extract(col__id, '^\s*([+-]?\d+)', 1), '') as smallint) number, coalesce(regexp_matches(gn__global_id, '^https?://'), false) is_url from sfga_taxon"""
)
def id_kinds(spark: SparkSession, d: str) -> DataFrame:
    """The number an id starts with, if it is small, and whether the global id is a link."""
    return table(spark, d, "sfga_taxon").select("data_source_id", "col__id", text.leading_int(F.col("col__id")).alias("number"), text.is_url(F.col("gn__global_id")).alias("is_url"))


_SLUG = "trim(regexp_replace(regexp_replace(replace(lower({c}), ' ', '-'), '[^a-z0-9-]', '', 'g'), '-{{2,}}', '-', 'g'), '-')"


@query(f"select doc_id, {_SLUG.format(c='agenda_item')} slug from documents")
def slugs(spark: SparkSession, d: str) -> DataFrame:
    """Slugs of titles."""
    return table(spark, d, "documents").select("doc_id", text.slug(F.col("agenda_item")).alias("slug"))


def _files(spark: SparkSession, d: str) -> DataFrame:
    """One archive's name for each source and day of loading."""
    day, number = F.date_format("loaded_at", "yyyy-MM-dd"), F.col("data_source_id")
    ending = F.element_at(F.array(*map(F.lit, text.ENDINGS)), (F.dayofmonth("loaded_at") % 4 + 1).cast("int"))
    rows = table(spark, d, "name_string_indices").select(F.concat(F.lpad(number.cast("string"), 4, "0"), F.lit("_list_"), day, F.when(F.month("loaded_at") % 2 == 0, F.concat(F.lit("_v"), F.month("loaded_at").cast("string"))).otherwise(F.lit("")), ending).alias("file"))
    return rows.distinct()


_FILES = """files as (select distinct lpad(cast(data_source_id as varchar), 4, '0') || '_list_' || strftime(loaded_at, '%Y-%m-%d') || case when month(loaded_at) % 2 = 0 then '_v' || month(loaded_at) else '' end
 || (['.sqlite.zip', '.sql.zip', '.sqlite', '.sql'])[day(loaded_at) % 4 + 1] file from name_string_indices),
 told as (select file, cast(regexp_extract(file, '^0{0,3}([1-9][0-9]{0,3})[-_.]', 1) as int) source, regexp_extract(file, '([0-9]{4}-[0-9]{2}-[0-9]{2})', 1) date,
   regexp_extract(regexp_replace(file, '[.]zip$', ''), '^.*?[0-9]{4}-[0-9]{2}-[0-9]{2}_(.+)[.](?:sql|sqlite)$', 1) version,
   case when file like '%.sqlite.zip' then 4 when file like '%.sql.zip' then 3 when file like '%.sqlite' then 2 else 1 end priority from files)"""


@query(f"with {_FILES} select * from told")
def file_metadata(spark: SparkSession, d: str) -> DataFrame:
    """What archives' names tell."""
    return archives.described(_files(spark, d))


@query(f"with {_FILES} select source, arg_max(file, date || priority || file) file, max(date) date, count(*) n_files from told group by 1")
def latest_files(spark: SparkSession, d: str) -> DataFrame:
    """The archive to take for each source."""
    return archives.latest(_files(spark, d))


_STATES = "('synonym', 'ambiguous synonym', 'misapplied')"


@query(
    f"""select data_source_id, count(*) n_rows, count(distinct name_string_id) n_names, count(*) filter (where taxonomic_status in {_STATES}) n_synonyms,
 count(*) filter (where coalesce(classification, '') <> '') n_classified from name_string_indices group by 1"""
)
def source_counts(spark: SparkSession, d: str) -> DataFrame:
    """Rows, names, synonyms and classified rows of each source."""
    return audit.counts(table(spark, d, "name_string_indices"))


@query("select data_source_id, taxonomic_status, count(*) n_rows from name_string_indices group by all")
def status_histogram(spark: SparkSession, d: str) -> DataFrame:
    """Rows of each state."""
    return table(spark, d, "name_string_indices").groupBy("data_source_id", "taxonomic_status").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    """with first as (select *, row_number() over (partition by data_source_id, name_string_id order by outlink_id nulls last, record_id, accepted_record_id nulls first) k from name_string_indices)
 select f.data_source_id, f.name_string_id, n.name, f.record_id, case when coalesce(f.outlink_id, '') <> '' then 'gnoutlink:' || f.outlink_id end alternative_id, lower(f.rank) as rank
 from first f join (select id, min(name) name from name_strings group by 1) n on n.id = f.name_string_id where k = 1"""
)
def export_names(spark: SparkSession, d: str) -> DataFrame:
    """One row for each name of a source."""
    indices, strings = _t(spark, d, "name_string_indices", "name_strings")
    return export.export_names(indices, strings).select("data_source_id", "name_string_id", "name", "record_id", "alternative_id", "rank")


@query(f"select data_source_id, record_id, name_string_id, taxonomic_status, rank from name_string_indices where taxonomic_status not in {_STATES} or taxonomic_status is null")
def export_taxa(spark: SparkSession, d: str) -> DataFrame:
    """Records that are no synonyms."""
    return export.export_taxa(table(spark, d, "name_string_indices"))


@query(f"select data_source_id, record_id, accepted_record_id, name_string_id, taxonomic_status from name_string_indices where taxonomic_status in {_STATES}")
def export_synonyms(spark: SparkSession, d: str) -> DataFrame:
    """Records that are synonyms."""
    return export.export_synonyms(table(spark, d, "name_string_indices"))


@query(
    """select v.data_source_id, v.record_id, s.name, coalesce(nullif(v.lang_code, ''), v.language) as language, v.locality, v.country_code
 from vernacular_string_indices v join (select id, min(name) name from vernacular_strings group by 1) s on s.id = v.vernacular_string_id"""
)
def export_vernaculars(spark: SparkSession, d: str) -> DataFrame:
    """Vernacular names of records."""
    return export.export_vernaculars(*_t(spark, d, "vernacular_string_indices", "vernacular_strings"))


@query(
    f"""select data_source_id, lpad(cast(data_source_id as varchar), 4, '0') || '-' || coalesce(nullif({_SLUG.format(c="min(rank)")}, ''), 'source') || '-' || strftime(max(loaded_at), '%Y-%m-%d') base
 from name_string_indices group by 1"""
)
def export_base_names(spark: SparkSession, d: str) -> DataFrame:
    """Names of the files of an export."""
    rows = table(spark, d, "name_string_indices").groupBy("data_source_id").agg(F.min("rank").alias("title"), F.max("loaded_at").alias("at"))
    return rows.select("data_source_id", export.base_name(F.col("data_source_id"), F.col("title"), F.lit(""), F.col("at")).alias("base"))


@query("select data_source_id, record_id, name_string_id from name_string_indices where (data_source_id, record_id) > (11, 'tx:5') order by data_source_id, record_id, name_string_id limit 500")
def keyset_page(spark: SparkSession, d: str) -> DataFrame:
    """A page of rows beyond a cursor."""
    rows = table(spark, d, "name_string_indices").select("data_source_id", "record_id", "name_string_id")
    return rows.where(maintain.after(["data_source_id", "record_id"], [11, "tx:5"])).orderBy("data_source_id", "record_id", F.asc_nulls_last("name_string_id")).limit(500)


@query(
    """select coalesce(a.s, b.s) data_source_id, coalesce(a.t, b.t) taxonomic_status, coalesce(a.n, 0) n_a, coalesce(b.n, 0) n_b, coalesce(a.n, 0) = coalesce(b.n, 0) same
 from (select data_source_id s, taxonomic_status t, count(*) n from verification_gndb group by all) a full join (select data_source_id s, taxonomic_status t, count(*) n from verification_togn group by all) b
 on a.s is not distinct from b.s and a.t is not distinct from b.t"""
)
def compared_states(spark: SparkSession, d: str) -> DataFrame:
    """Rows by state in two copies."""
    return audit.compared_counts(*_t(spark, d, "verification_gndb", "verification_togn"), ["data_source_id", "taxonomic_status"])


_SAMPLED = ["record_id", "name_string_id", "name", "taxonomic_status", "accepted_name"]


def _samples(spark: SparkSession, d: str) -> DataFrame:
    return audit.compared_samples(*_t(spark, d, "verification_gndb", "verification_togn"), "data_source_id", ["record_id"], _SAMPLED[1:], 20)


def _sample_sql(t: str) -> str:
    order = ", ".join(f"{c} nulls first" for c in _SAMPLED)
    return f"select data_source_id g, {{{', '.join(f'{c!r}: {c}' for c in _SAMPLED)}}} v, row_number() over (partition by data_source_id order by {order}) k from verification_{t} qualify k <= 20"


_PAIRED = f"""with a as ({_sample_sql("gndb")}), b as ({_sample_sql("togn")}),
 paired as (select coalesce(a.g, b.g) data_source_id, coalesce(a.k, b.k) place, a.v is not distinct from b.v same from a full join b on a.g is not distinct from b.g and a.k = b.k)"""


@query(f"{_PAIRED} select * from paired")
def compared_samples(spark: SparkSession, d: str) -> DataFrame:
    """First rows of each source in two copies, paired by place."""
    return _samples(spark, d)


@query(f"{_PAIRED} select data_source_id, bool_and(same) same, count(*) filter (where not same) n_unlike from paired group by 1")
def compared_summary(spark: SparkSession, d: str) -> DataFrame:
    """Whether all of a source's pairs agree."""
    return audit.summary(_samples(spark, d), "data_source_id")


@query("select data_source_id, count(*) n_rows from name_string_indices where data_source_id not in (select data_source_id from sfga_taxon) group by 1")
def sources_deleted(spark: SparkSession, d: str) -> DataFrame:
    """What is left once all sources with a checklist are removed."""
    indices, gone = _t(spark, d, "name_string_indices", "sfga_taxon")
    return maintain.without_sources(indices, gone).groupBy("data_source_id").agg(F.count(F.lit(1)).alias("n_rows"))


_BOTH = "data_source_id, record_id, name_string_id, taxonomic_status"


@query(f"select {_BOTH} from name_string_indices where data_source_id not in (select data_source_id from verification_gndb where data_source_id is not null) union all select {_BOTH} from verification_gndb")
def sources_replaced(spark: SparkSession, d: str) -> DataFrame:
    """The index once all sources of a copy are replaced by it."""
    indices, new = (t.select(*_BOTH.split(", ")) for t in _t(spark, d, "name_string_indices", "verification_gndb"))
    return maintain.replaced(indices, new)


@query("select distinct data_source_id from name_string_indices where data_source_id not in (select data_source_id from sfga_taxon)")
def absent_sources(spark: SparkSession, d: str) -> DataFrame:
    """Sources of the index without a checklist."""
    return maintain.absent_keys(*_t(spark, d, "name_string_indices", "sfga_taxon"), "data_source_id")


_GONE = "(select distinct data_source_id from sfga_taxon)"


@query(
    f"""select 'name_string_indices' tab, data_source_id, count(*) n_rows from name_string_indices where data_source_id not in {_GONE} group by 2
 union all select 'vernacular_string_indices', data_source_id, count(*) from vernacular_string_indices where data_source_id not in {_GONE} group by 2
 union all select 'data_sources', id, count(*) from (select distinct data_source_id id from name_string_indices) where id not in {_GONE} group by 2"""
)
def sources_removed(spark: SparkSession, d: str) -> DataFrame:
    """What is left in all three tables once all sources with a checklist are removed."""
    indices, vernaculars, gone = _t(spark, d, "name_string_indices", "vernacular_string_indices", "sfga_taxon")
    tables = {"name_string_indices": (indices, "data_source_id"), "vernacular_string_indices": (vernaculars, "data_source_id"), "data_sources": (indices.select(F.col("data_source_id").alias("id")).distinct(), "id")}
    left = maintain.removed(tables, gone)
    per = [df.groupBy(F.col(tables[t][1]).alias("data_source_id")).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(t).alias("tab"), "data_source_id", "n_rows") for t, df in left.items()]
    return per[0].unionByName(per[1]).unionByName(per[2])


_VERN = ["record_id", "vernacular_string_id", "language", "language_orig", "lang_code", "locality", "country_code"]


def _vern_sql(copy: str) -> str:
    order = ", ".join(f"{c} nulls first" for c in _VERN)
    return f"select data_source_id g, {{{', '.join(f'{c!r}: {c}' for c in _VERN)}}} v, row_number() over (partition by data_source_id order by {order}) k from {copy} qualify k <= 50"


_TIDIED = "(select * replace (lower(trim(language)) as language) from vernacular_string_indices)"


@query(
    f"""with a as ({_vern_sql("vernacular_string_indices")}), b as ({_vern_sql(_TIDIED)}),
 paired as (select coalesce(a.g, b.g) data_source_id, coalesce(a.k, b.k) place, a.v is not distinct from b.v same from a full join b on a.g is not distinct from b.g and a.k = b.k)
 select data_source_id, bool_and(same) same, count(*) filter (where not same) n_unlike from paired group by 1"""
)
def compared_vernaculars(spark: SparkSession, d: str) -> DataFrame:
    """First vernacular rows of each source as stored against those with tidied languages, paired by place."""
    rows = table(spark, d, "vernacular_string_indices").select("data_source_id", *_VERN)
    pairs = audit.compared_samples(rows, rows.withColumn("language", F.lower(F.trim("language"))), "data_source_id", _VERN[:2], _VERN[2:], 50)
    return audit.summary(pairs, "data_source_id")


@query(
    """with a as (select data_source_id s, count(*) n, count(distinct name) m, max(loaded_at) t from verification_gndb group by 1), b as (select data_source_id s, count(*) n, count(distinct name) m, max(loaded_at) t from verification_togn group by 1)
 select coalesce(a.s, b.s) data_source_id, a.n is not distinct from b.n n_rows, a.m is not distinct from b.m n_names, a.t is not distinct from b.t last_loaded from a full join b on a.s is not distinct from b.s"""
)
def compared_metadata(spark: SparkSession, d: str) -> DataFrame:
    """Whether what is told about each source (rows, names, last load) agrees in two copies."""
    told = lambda df: df.groupBy("data_source_id").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("name").alias("n_names"), F.max("loaded_at").alias("last_loaded"))
    a, b = _t(spark, d, "verification_gndb", "verification_togn")
    return audit.compared_metadata(told(a), told(b), "data_source_id", ["n_rows", "n_names", "last_loaded"])


@query(
    f"""select 'names' tab, data_source_id, count(*) n_rows from (select distinct i.data_source_id, i.name_string_id from name_string_indices i where i.name_string_id in (select id from name_strings)) group by 2
 union all select 'taxa', data_source_id, count(*) from name_string_indices where taxonomic_status not in {_STATES} or taxonomic_status is null group by 2
 union all select 'synonyms', data_source_id, count(*) from name_string_indices where taxonomic_status in {_STATES} group by 2
 union all select 'vernaculars', data_source_id, count(*) from vernacular_string_indices where vernacular_string_id in (select id from vernacular_strings) group by 2
 union all select 'classifications', data_source_id, count(*) from name_string_indices group by 2"""
)
def export_written(spark: SparkSession, d: str) -> DataFrame:
    """The five tables of an export written by source; rows read back."""
    indices, strings, vernaculars, texts = _t(spark, d, "name_string_indices", "name_strings", "vernacular_string_indices", "vernacular_strings")
    tables = {
        "names": export.export_names(indices, strings), "taxa": export.export_taxa(indices), "synonyms": export.export_synonyms(indices),
        "vernaculars": export.export_vernaculars(vernaculars, texts), "classifications": classification.unfolded(indices, _dictionary(spark, d)),
    }
    return export.written(tables, f"{shared_folder(spark)}/export-{uuid.uuid4().hex}")
