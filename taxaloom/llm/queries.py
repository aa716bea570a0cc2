"""Queries of the operators on text, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaloom.functions.ids import BLANKS, clean_id, uuid_text
from taxaloom.llm import abuse, bpe, langmap, lookalike, mixing
from taxaloom.session import cut, table

Query = Callable[[SparkSession, str], DataFrame]


def _vernaculars(spark: SparkSession, d: str) -> DataFrame:
    typed = table(spark, d, "vernacular_string_indices").select("data_source_id", "record_id", "vernacular_string_id", "language", "lang_code")
    return langmap.mapped(typed, table(spark, d, "languages"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """The language meant by each vernacular whose language is not an entry's own."""
    rows = _vernaculars(spark, d).where("not exact").where("trim(language) <> '' or trim(lang_code) <> ''")
    record = F.coalesce(clean_id(F.col("record_id")), F.lit(""))
    return rows.select("data_source_id", record.alias("record_id"), uuid_text(F.col("vernacular_string_id")).alias("vernacular_string_id"), F.col("means").alias("lang_code")).distinct()


def p5_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """Typed languages and codes that mean no entry, with their numbers of rows."""
    rows = _vernaculars(spark, d).where("means = ''").where("trim(language) <> '' or trim(lang_code) <> ''")
    return rows.groupBy("language", "lang_code").agg(F.count(F.lit(1)).alias("n_rows"))


def _forms(spark: SparkSession, d: str) -> DataFrame:
    both = [table(spark, d, t).select(F.lit(t).alias("tab"), uuid_text(F.col("id")).alias("id"), "name") for t in ("name_strings", "vernacular_strings")]
    return lookalike.same_look(both[0].unionByName(both[1]), "name")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of names that look the same."""
    return lookalike.pairs(_forms(spark, d))


def p7_forms(spark: SparkSession, d: str) -> DataFrame:
    """Every name in its one form."""
    return _forms(spark, d)


def p7_classes(spark: SparkSession, d: str) -> DataFrame:
    """Classes of names that look the same: one row for each name that has others alike."""
    return lookalike.classes(_forms(spark, d))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    """Token ids of every document."""
    return bpe.encoded(table(spark, d, "documents"))


def _mix(spark: SparkSession, d: str, by_temperature: bool = False) -> tuple[DataFrame, dict, dict]:
    sizes = bpe.encoded(table(spark, d, "documents"), keep=("doc_id", "source")).select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"))
    sizes = cut(sizes)  # tokens are counted once
    targets = {r.source: (r.target_share, r.max_repeats) for r in table(spark, d, "mixture_targets").collect()}  # a fixed, small table
    tokens = {r.source: r.n for r in sizes.where(F.col("source").isin(*targets)).groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()}  # one row for each target
    quotas = mixing.tempered_plan(tokens, targets, float(sum(tokens.values()))) if by_temperature else mixing.plan(tokens, targets)
    return mixing.realised(sizes, quotas, {s: t[1] for s, t in targets.items()}), quotas, targets


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    """The selection: how often each document is used."""
    used, _, _ = _mix(spark, d)
    return used.where("uses > 0")


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    """Shares reached by the selection."""
    used, quotas, targets = _mix(spark, d)
    return mixing.shares_reached(used, quotas, targets)


def p9_tempered(spark: SparkSession, d: str) -> DataFrame:
    """Shares reached by a temperature mixture as large as all sources with a target together, as even as the targets and within the caps."""
    used, quotas, targets = _mix(spark, d, by_temperature=True)
    return mixing.shares_reached(used, quotas, targets)


def _scores(spark: SparkSession, d: str) -> DataFrame:
    return abuse.scored(table(spark, d, "documents"), table(spark, d, "speech_labels"), keep=("doc_id", "source"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents with abusive, hateful or sexual language."""
    return _scores(spark, d).where("offensive").select("doc_id")


def p10_scores(spark: SparkSession, d: str) -> DataFrame:
    """Score of every document."""
    return _scores(spark, d)


def p10_rates(spark: SparkSession, d: str) -> DataFrame:
    """Rate of such documents for each source."""
    return abuse.rates(_scores(spark, d))


QUERIES: dict[str, Query] = {f.__name__: f for f in (p5_found, p5_unmatched, p7_found, p7_forms, p7_classes, p8_ids, p9_mix, p9_shares, p9_tempered, p10_found, p10_scores, p10_rates)}
_TIDY = "trim(regexp_replace(trim(lower(nfc_normalize({c})), ' ' || chr(9) || chr(10) || '.?!:;*'), '[[:space:]' || chr(160) || ']+', ' ', 'g'))"
_CHARS = " || ".join(f"chr({ord(c)})" for c in BLANKS)


def _sql_tidy(c: str) -> str:
    return _TIDY.format(c=c)


# Damerau-Levenshtein in DuckDB is the unrestricted distance. A value's forms: 0 whole, 1 without label, 2 without remarks.
_LANGUAGES = f"""with entry as (select distinct {_sql_tidy("way")} as name, lang_code code from (select lang_code, unnest(list_concat([language, lang_code, lang_code2], coalesce(alt_names, []))) way from languages)
   where way is not null and lang_code is not null),
 typed as (select distinct unnest([language, lang_code]) as value from vernacular_string_indices),
 whole as (select value, {_sql_tidy("value")} f0 from typed where trim(value) <> ''),
 bare as (select value, f0, regexp_replace(f0, '^(?:[^\\p{{L}}\\p{{N}}_]*(?:in|lang|language|langue|lingua|idioma|sprache|code)[^\\p{{L}}\\p{{N}}_]+)+([\\p{{L}}\\p{{N}}_])', '\\1') f1 from whole),
 head as (select value, f0, f1, case when trim(regexp_extract(f1, '^[^(\\[,]*')) <> '' then {_sql_tidy("regexp_extract(f1, '^[^(\\[,]*')")} else f1 end f2 from bare),
 form as (select distinct value, f, min(k) over (partition by value, f) k from (select value, f0 f, 0 k from head union all select value, {_sql_tidy("f1")}, 1 from head union all select value, f2, 2 from head) where f <> ''),
 hit as (select value, k, f, name, code, damerau_levenshtein(f, name) d from form, entry where abs(length(f) - length(name)) <= 2),
 fit as (select value, d > 0 miss, k, d, code from hit where d = 0 or (length(name) > 3 and d <= case when length(f) <= 3 then 0 when length(f) <= 5 then 1 else 2 end)),
 best as (select value, min({{'m': miss, 'k': k, 'd': d}}) b from fit group by 1),
 meant as (select f.value, min(f.code) code from fit f join best b on b.value = f.value and {{'m': f.miss, 'k': f.k, 'd': f.d}} = b.b group by f.value having any_value(f.k) < 2 or count(distinct f.code) = 1),
 told as (select v.*, coalesce(n.code, c.code, '') means, exists (select 1 from languages l where l.language = v.language and l.lang_code = v.lang_code) is_exact
   from vernacular_string_indices v left join meant n on n.value = v.language left join meant c on c.value = v.lang_code
   where trim(v.language) <> '' or trim(v.lang_code) <> '')"""
_UUID = f"lower(trim(vernacular_string_id, {_CHARS}))"

SQL: dict[str, str] = {
    "p5_found": f"{_LANGUAGES} select distinct data_source_id, coalesce(trim(record_id, {_CHARS}), '') record_id, {_UUID} vernacular_string_id, means lang_code from told where not is_exact",
    "p5_unmatched": f"{_LANGUAGES} select language, lang_code, count(*) n_rows from told where means = '' group by all",
}
