"""Scientific names taken apart by built-in regular expressions: canonical forms, year, flags, words.

The grammar covers uninomials, binomials with subgenus, infraspecific names with or without rank marker, authorship with
year, hybrid signs, names of viruses and unfinished names. Stems cut Latin endings; they are an approximation.

A nomenclatural code may be given: a name under the code of viruses is a virus and stays unparsed, one under the code of
bacteria is flagged so, and under the botanical code a single word in brackets behind the genus is an author, not a
subgenus. Genera of bacteria can't be told from their form; ``bacterial_genera`` learns them from stored flags.

Defined cases: null, empty and blank names are unparsed: no canonical form, quality 0, cardinality null; a null or
unknown code is no code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaloom.functions.ids import uuid5, uuid_text

# Rank markers between epithets, marks of unfinished names, words of virus names, Latin endings.
MARKERS = ("subsp.", "ssp.", "var.", "subvar.", "f.", "fo.", "forma", "subf.", "cv.", "nothosubsp.", "nothovar.", "morph", "ab.")
UNFINISHED = r"\b(?:sp|spp|cf|aff|nr)\.|\bindet\b"
VIRUS = r"(?i)\b(?:[a-z-]*virus(?:es)?|[a-z-]*viroids?|[a-z-]*phages?|prions?)\b"
ENDINGS = "ibus|arum|orum|ius|ium|us|um|is|os|on|as|es|ae|am|ei|ii|a|e|i|o|u"
_EPITHET = r"[a-z\xDF-\xF6\xF8-\xFF][a-z\xDF-\xF6\xF8-\xFF-]+"
_MARK = "|".join(m.replace(".", r"\.") for m in MARKERS)
GENUS = r"^(?:[x\xD7]\s*)?([A-Z\xC0-\xD6\xD8-\xDE][a-z\xDF-\xF6\xF8-\xFF-]+)"
SPECIES = GENUS + r"(?: \([A-Z][a-z-]+\))?(?: [x\xD7])? (" + _EPITHET + r")(?: |,|$)"
# Words that start an authorship rather than an epithet.
NOT_EPITHETS = ("in", "ex", "et", "and", "de", "von", "van", "da", "del", "der", "du", "le", "la", "bis", "filius")
_NOT_AUTHOR = r"(?!(?:" + "|".join(NOT_EPITHETS) + r")\b)"
THIRD = GENUS + r"(?: \([A-Z][a-z-]+\))? " + _EPITHET + r" (?:[^|]*? )?(?:" + _MARK + r") (" + _EPITHET + r")(?: |,|$)"
BARE_THIRD = GENUS + r"(?: \([A-Z][a-z-]+\))? " + _EPITHET + r" " + _NOT_AUTHOR + r"(" + _EPITHET + r")(?: |,|$)"
SUBGENUS = r" \([A-Z][a-z-]+\)"
# Ranks named before a name between genus and species.
SECTION = r"\b(?:subgen|subg|sect|subsect|ser|subser)\. \p{Lu}[\p{L}-]+"
AUTHOR = r"(?:^|[ (.])(\p{Lu}[\p{L}'-]+)"
HYBRID = r"(?:^|\s)[x\xD7]\s"
BOTANICAL, BACTERIAL, VIRAL = 2, 3, 4
YEAR = r"\b(1[5-9]\d\d|20\d\d)[a-z]?\)?$"


def stem(word: Column) -> Column:
    """A word without its Latin ending; at least two letters stay."""
    return F.regexp_replace(word, f"^(.{{2,}}?)(?:{ENDINGS})$", "$1")


PARTS = ("simple", "full", "stem", "cardinality", "year", "virus", "bacteria", "surrogate", "quality", "tail")


def parsed(df: DataFrame, name: str, prefix: str = "parsed_", code: Column | None = None) -> DataFrame:
    """``df`` with the parts of a name under its code. Done in steps, so that each expression is evaluated once.

    ``tail`` is what stands behind the genus (and a subgenus) of a uninomial, or behind the first epithet of other names.
    """
    columns, p = df.columns, lambda part: F.col(f"_p_{part}")
    code = F.lit(0) if code is None else F.coalesce(code.cast("int"), F.lit(0))
    text = F.btrim(F.regexp_replace(F.col(name), r"\s+", " "))
    step = df.withColumns({"_p_text": text, "_p_code": code})
    step = step.withColumns({
        "_p_genus": F.regexp_extract("_p_text", GENUS, 1), "_p_epithet": F.regexp_extract("_p_text", SPECIES, 2),
        "_p_virus": F.coalesce(p("text").rlike(VIRUS), F.lit(False)) | (p("code") == VIRAL), "_p_surrogate": F.coalesce(p("text").rlike(UNFINISHED), F.lit(False)),
    })
    many = p("epithet") != ""
    step = step.withColumns({"_p_marked": F.when(many, F.regexp_extract("_p_text", THIRD, 2)).otherwise(""), "_p_ok": F.coalesce((p("genus") != "") & ~p("virus"), F.lit(False))})
    step = step.withColumns({
        "_p_infra": F.when(p("marked") != "", p("marked")).when(many, F.regexp_extract("_p_text", BARE_THIRD, 2)).otherwise(""),
        "_p_marker": F.when(p("marked") != "", F.regexp_extract("_p_text", r" (" + _MARK + r") " + _EPITHET + r"(?: |,|$)", 1)).otherwise(""),
    })
    join = lambda *parts: F.array_join(F.array_compact(F.array(*(F.nullif(x, F.lit("")) for x in parts))), " ")
    ok, finished = p("ok"), p("ok") & ~p("surrogate")
    odd = p("text").rlike(r"[^\p{L}0-9 .,&()\x27-]") | (p("text") != F.col(name))
    made = {
        "simple": F.when(finished, join(p("genus"), p("epithet"), p("infra"))).when(ok, p("genus")),
        "full": F.when(finished & (p("marker") != ""), join(p("genus"), p("epithet"), p("marker"), p("infra"))),
        "stem": F.when(finished & many, join(p("genus"), stem(p("epithet")), stem(p("infra")))),
        "cardinality": F.when(finished, F.lit(1) + many.cast("int") + (p("infra") != "").cast("int")),
        "year": F.when(ok, F.regexp_extract("_p_text", YEAR, 1).try_cast("smallint")),
        "virus": p("virus"), "bacteria": p("code") == BACTERIAL, "surrogate": p("surrogate"),
        "tail": F.when(many, F.regexp_replace("_p_text", SPECIES, " ")).when(p("code") == BOTANICAL, F.regexp_replace("_p_text", GENUS, "")).otherwise(F.regexp_replace("_p_text", f"{GENUS}(?:{SUBGENUS})?", "")),
        "quality": F.coalesce(F.when(~ok & ~p("virus"), F.lit(0)).when(p("surrogate"), F.lit(3)).when(odd, F.lit(2)).otherwise(F.lit(1)), F.lit(0)),
    }
    return step.select(*columns, *(made[k].alias(f"{prefix}{k}") for k in PARTS))


def parse(df: DataFrame, name: str = "name", code: Column | None = None) -> DataFrame:
    """``df`` with ``parsed_…`` columns and the ids of the canonical forms."""
    return parsed(df, name, code=code).drop("parsed_tail").withColumns({f"parsed_{k}_id": uuid5(F.col(f"parsed_{k}")) for k in ("simple", "full", "stem")})


def bacterial_genera(names: DataFrame, name: str = "name", flag: str = "bacteria") -> DataFrame:
    """``genus`` of which more stored names are flagged as bacteria than not."""
    votes = F.sum(F.when(F.col(flag), 1).when(~F.col(flag), -1).otherwise(0))
    return parsed(names.select(name, flag), name).select(F.split("parsed_simple", " ")[0].alias("genus"), flag).where("genus is not null").groupBy("genus").agg(votes.alias("n")).where("n > 0").select("genus")


def with_bacteria(parsed_rows: DataFrame, genera: DataFrame) -> DataFrame:
    """Parsed rows whose ``parsed_bacteria`` also follows from their genus."""
    known = genera.select(F.col("genus").alias("_genus")).distinct()
    joined = parsed_rows.join(known, F.split("parsed_simple", " ")[0] == F.col("_genus"), "left")
    return joined.withColumn("parsed_bacteria", F.col("parsed_bacteria") | F.col("_genus").isNotNull()).drop("_genus")


def changed(df: DataFrame) -> DataFrame:
    """Parsed rows to be written: the canonical id or a flag differs from the stored one (a null flag is false).

    Names that are and were unparsed are left alone, unless they are viruses; an unparsed name only counts if its virus flag differs.
    """
    stored = uuid_text(F.col("canonical_id"))
    unlike = lambda flag: F.coalesce(F.col(flag), F.lit(False)) != F.col(f"parsed_{flag}")
    differs = ~stored.eqNullSafe(F.col("parsed_simple_id")) | unlike("surrogate") | unlike("bacteria") | unlike("virus")
    unparsed = (F.coalesce("parse_quality", F.lit(0)) + F.col("parsed_quality") == 0) & ~F.col("parsed_virus")
    return df.where(~unparsed & F.when(F.col("parsed_simple").isNull(), unlike("virus")).otherwise(differs))


def words(df: DataFrame, key: str = "id", name: str = "name", code: Column | None = None) -> DataFrame:
    """Epithets and author words of finished names: ``key, canonical_id, normalized, modified, type, word_id``, one row for each.

    Author words stand behind the genus and subgenus of a uninomial, or behind the first epithet of other names.
    """
    named = parsed(df, name, "_", code)
    parts = F.split("_simple", " ")
    of = lambda word, kind, mod: F.struct(word.alias("normalized"), mod.alias("modified"), F.lit(kind).alias("type"))
    rest = F.slice(parts, F.lit(2), F.greatest(F.size(parts), F.lit(0)))
    epithets = F.transform(rest, lambda w, k: of(w, 0, stem(w)).withField("type", F.when(k == 0, F.lit(2)).otherwise(F.lit(3))))
    authors = F.transform(F.regexp_extract_all(F.regexp_replace("_tail", SECTION, ""), F.lit(AUTHOR), F.lit(1)), lambda w: of(w, 4, F.lower(w)))
    fine = F.col("_simple").isNotNull() & ~F.col("_surrogate") & ~F.col(name).rlike(HYBRID)
    rows = named.where(fine).select(key, uuid5(F.col("_simple")).alias("canonical_id"), F.explode(F.array_distinct(F.concat(epithets, authors))).alias("w"))
    made = rows.select(key, "canonical_id", "w.normalized", "w.modified", F.col("w.type").alias("type_id"))
    return made.withColumn("word_id", uuid5(F.concat_ws("|", "modified", F.col("type_id").cast("string"))))
