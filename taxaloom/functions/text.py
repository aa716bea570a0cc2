"""Text expressions of the catalogue, all by built-in functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from taxaloom.functions.ids import blank_trim


def name_text(gn: Column, plain: Column) -> Column:
    """The name of a record: the checked spelling if it isn't blank (trimmed), else the plain one as it stands."""
    return F.coalesce(F.nullif(blank_trim(gn), F.lit("")), plain)


def slug(c: Column) -> Column:
    """Lower case, blanks to hyphens, other signs gone, single hyphens, none at the ends."""
    kept = F.regexp_replace(F.replace(F.lower(c), F.lit(" "), F.lit("-")), "[^a-z0-9-]", "")
    return F.btrim(F.regexp_replace(kept, "-{2,}", "-"), F.lit("-"))


def fit_bytes(c: Column, limit: int, mark: str = "…") -> Column:
    """Text of at most ``limit`` bytes; longer text is cut between characters and ends in ``mark``."""
    cut = F.make_valid_utf8(F.substring(F.encode(c, "UTF-8"), 1, limit - len(mark.encode())).cast("string"))
    return F.when(F.octet_length(c) > limit, F.concat(F.regexp_replace(cut, "�+$", ""), F.lit(mark))).otherwise(c)


def leading_int(c: Column) -> Column:
    """The integer a text starts with, as a short; null if there is none or it is too large."""
    return F.regexp_extract(c, r"^\s*([+-]?\d+)", 1).try_cast("smallint")


# Fixed values in the next two: the forms of date and version in an archive's file name.
def file_date(c: Column) -> Column:
    """The first ``yyyy-mm-dd`` in a file name, or ``''``."""
    return F.regexp_extract(c, r"(\d{4}-\d{2}-\d{2})", 1)


def file_version(c: Column) -> Column:
    """What stands between the date with an underscore and the ending of an archive's name, or ``''``."""
    return F.regexp_extract(F.regexp_replace(c, r"\.zip$", ""), r"^.*?\d{4}-\d{2}-\d{2}_(.+)\.(?:sql|sqlite)$", 1)


# Endings of archives, the preferred one first.
ENDINGS = (".sqlite.zip", ".sql.zip", ".sqlite", ".sql")


def file_priority(c: Column) -> Column:
    """4 to 1 for the endings of archives, 0 for other files."""
    out = F.lit(0)
    for k, ending in reversed(list(enumerate(ENDINGS))):
        out = F.when(F.lower(c).endswith(ending), F.lit(len(ENDINGS) - k)).otherwise(out)
    return out


def outlink_value(column: Column, value: Column) -> Column:
    """The id for a link: of a list of alternative ids the one labelled ``gnoutlink:``, else the value itself."""
    labelled = F.filter(F.transform(F.split(value, ","), lambda v: F.trim(v)), lambda v: v.startswith("gnoutlink:"))
    first = F.coalesce(F.substr(F.get(labelled, F.lit(0)), F.lit(11)), F.lit(""))
    return F.when(column.endswith("col__alternative_id"), F.when(value.isNotNull(), first)).otherwise(value)


def is_url(c: Column) -> Column:
    return F.coalesce(c.rlike(r"^https?://"), F.lit(False))
