"""Vernacular names: strings, index rows, languages.

Defined cases: null names make no strings; lengths are counted in bytes; a value of two or three bytes is only ever read as
a code, so that unknown codes stay as they are; repeated index rows stay, as they have no key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaloom.functions.ids import uuid5
from taxaloom.functions.text import fit_bytes


def strings(rows: DataFrame, name: str = "name") -> DataFrame:
    """Distinct ``id, name`` of at most 500 bytes."""
    text = fit_bytes(F.col(name), 500, "").alias("name")
    return rows.where(f"{name} is not null").select(text).distinct().select(uuid5(F.col("name")).alias("id"), "name")


def indices(rows: DataFrame) -> DataFrame:
    """Distinct index rows, then fitted to their columns' widths; two that only differ beyond a width stay two."""
    keep = ["data_source_id", "record_id", "vernacular_string_id", "language", "locality", "country_code"]
    one = rows.select(*keep).distinct()
    fitted = one.withColumns({"language": fit_bytes(F.col("language"), 255), "locality": fit_bytes(F.col("locality"), 255), "country_code": fit_bytes(F.col("country_code"), 50)})
    return fitted.withColumns({"language_orig": F.lit(""), "lang_code": F.lit(""), "preferred": F.lit(False)})


def normalised(rows: DataFrame, languages: DataFrame) -> DataFrame:
    """``rows`` with ``language_orig``, ``language`` and ``lang_code`` brought to the reference list's spelling.

    The language as typed is kept in ``language_orig``. A two-letter code gives code and name, a three-letter code its
    name, and a name without code its code; codes end up in lower case.
    """
    two = languages.where("lang_code2 is not null").groupBy(F.col("lang_code2").alias("_two")).agg(F.min(F.struct("lang_code", "language")).alias("_by2"))
    three = languages.where("lang_code is not null").groupBy(F.col("lang_code").alias("_three")).agg(F.min("language").alias("_by3"))
    named = languages.where("language is not null").groupBy(F.col("language").alias("_name")).agg(F.min("lang_code").alias("_byname"))
    size, coded = F.octet_length(F.coalesce("language", F.lit(""))), F.octet_length(F.coalesce("lang_code", F.lit(""))) == 3
    columns = rows.columns
    out = rows.join(two, F.col("language") == F.col("_two"), "left").join(three, F.col("language") == F.col("_three"), "left").join(named, F.col("language") == F.col("_name"), "left")
    language = F.when(size == 2, F.coalesce("_by2.language", "language")).when(size == 3, F.coalesce("_by3", "language")).otherwise(F.col("language"))
    code = (
        F.when((size == 2) & F.col("_by2").isNotNull() & ~coded, F.col("_by2.lang_code"))
        .when((size == 3) & F.col("_by3").isNotNull() & ~coded, F.col("language"))
        .when(~size.isin(2, 3) & ~coded, F.coalesce("_byname", "lang_code"))
        .otherwise(F.col("lang_code"))
    )
    kept = [c for c in columns if c not in ("language", "lang_code", "language_orig")]
    orig = F.coalesce(F.nullif("language_orig", F.lit("")), F.col("language"))
    return out.select(*kept, orig.alias("language_orig"), language.alias("language"), F.lower(code).alias("lang_code"))
