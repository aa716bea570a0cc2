"""Nomenclatural codes, ranks by suffix, votes on the code of a classification."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Nomenclatural codes and their numbers.
CODES = {"ZOOLOGICAL": 1, "BOTANICAL": 2, "BACTERIAL": 3, "VIRUS": 4}
# Suffixes of names of higher ranks, in order of precedence; the code a rule needs, if any.
SUFFIXES = (
    ("aceae", "family", None), ("oideae", "subfamily", None), ("eae", "tribe", None), ("ales", "order", None), ("ineae", "suborder", None),
    ("idae", "family", None), ("ini", "tribe", None), ("oidea", "superfamily", None),
    ("opsida", "class", None), ("mycetes", "class", None), ("phyceae", "class", None), ("phyta", "phylum", None), ("mycota", "phylum", None),
    ("inae", "subtribe", 2), ("inae", "subfamily", None), ("ina", "subtribe", 1),
)
# Suffixes that speak for zoology (1) or botany (2).
VOTES = {"idae": 1, "ini": 1, "aceae": 2, "oideae": 2, "eae": 2}
# Ranks that an import reads from a flat classification, from the root.
FLAT_RANKS = ("kingdom", "phylum", "subphylum", "class", "order", "suborder", "superfamily", "family", "subfamily", "tribe", "subtribe", "genus", "subgenus", "section", "species")
# Ranks with a column of their own in an export, from the root.
EXPORT_RANKS = ("kingdom", "phylum", "subphylum", "class", "subclass", "order", "suborder", "superfamily", "family", "subfamily", "tribe", "subtribe", "genus", "subgenus", "species")
#: Of the import ranks a checklist can fill.
GIVEN_RANKS = ("kingdom", "phylum", "subphylum", "class", "order", "family", "genus", "species")


def code_number(c: Column) -> Column:
    """The number of a code in any case, 0 for others."""
    out = F.lit(0)
    for word, number in CODES.items():
        out = F.when(F.upper(c) == word, F.lit(number)).otherwise(out)
    return out.cast("smallint")


def rank_by_suffix(name: Column, code: Column) -> Column:
    """The rank a name's suffix tells under a code (0 unknown), or ``''``; the first rule that fits holds."""
    low, out = F.lower(name), F.lit("")
    for suffix, rank, needs in reversed(SUFFIXES):
        fits = low.endswith(suffix) if needs is None else low.endswith(suffix) & (code == needs)
        out = F.when(fits, F.lit(rank)).otherwise(out)
    return out


def ballot(name: Column, known: Column | None = None, code: Column | None = None) -> Column:
    """A name's vote on the code: 1 zoology, -1 botany, 0 neither. A name ``known`` to the dictionary votes by its ``code`` there, others by their suffix."""
    low, out = F.lower(name), F.lit(0)
    for suffix, number in reversed(list(VOTES.items())):
        out = F.when(low.endswith(suffix), F.lit(1 if number == 1 else -1)).otherwise(out)
    if known is None:
        return out
    return F.when(known, F.when(code == "iczn", F.lit(1)).when(code == "icn", F.lit(-1)).otherwise(F.lit(0))).otherwise(out)


def winner(votes: Column) -> Column:
    """The code of a sum of votes: 1, 2, or 0 for a tie."""
    return F.when(votes > 0, F.lit(1)).when(votes < 0, F.lit(2)).otherwise(F.lit(0)).cast("smallint")


def code_vote(classification: Column) -> Column:
    """The code for which the suffixes of a ``|``-joined classification's names vote, without a dictionary."""
    return winner(F.aggregate(F.split(F.coalesce(classification, F.lit("")), r"\|"), F.lit(0), lambda acc, n: acc + ballot(n)))
