"""Identifiers: name-based UUIDs, UUID spelling, ids with stray blanks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as blank around an id or a value (white space, no-break and zero-width marks).
BLANKS = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u180e\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u200b\u200c\u200d\u200e\u200f\u2028\u2029\u202f\u205f\u2060\u3000\ufeff"
)
# Fixed value: the UUID namespace of the catalogue, UUIDv5(DNS, domain of the catalogue).
NAMESPACE = "90181196fecf5082a4c1411d4f314cda"


def blank_trim(c: Column) -> Column:
    """``c`` without blanks of any kind around it."""
    return F.btrim(c, F.lit(BLANKS))


def clean_id(c: Column) -> Column:
    """The id without blanks around it; null where nothing is left."""
    return F.nullif(blank_trim(c.cast("string")), F.lit(""))


def dashed(hex32: Column) -> Column:
    """32 hex digits as a dashed UUID."""
    whole = F.concat_ws("-", *(F.substring(hex32, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))
    return F.when(hex32.isNotNull(), whole)


def bare_uuid(c: Column) -> Column:
    """The 32 lower-case hex digits of a UUID however written (case, dashes, braces, ``urn:uuid:``); null if it is none."""
    digits = F.translate(F.regexp_replace(F.lower(blank_trim(c)), r"^urn:uuid:", ""), "{}-" + BLANKS, "")
    return F.when(digits.rlike(r"\A[0-9a-f]{32}\z"), digits)


def uuid_text(c: Column) -> Column:
    """A UUID in lower case with dashes; other text is only trimmed, blank text is null."""
    plain = c.rlike(r"\A[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\z")  # the usual spelling needs no work
    return F.when(plain, c).otherwise(F.coalesce(dashed(bare_uuid(c)), clean_id(c)))


def uuid5(text: Column) -> Column:
    """UUIDv5 of ``text`` in the catalogue's namespace, by built-in functions only; null for null."""
    digest = F.sha1(F.concat(F.unhex(F.lit(NAMESPACE)), F.encode(text, "UTF-8")))
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab" * 4)
    return F.regexp_replace(F.overlay(digest, variant, 17, 1), "^(.{8})(.{4}).(.{3})(.{4})(.{12}).*$", "$1-$2-5$3-$4-$5")
