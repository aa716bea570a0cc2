"""Differences between two copies of a table, by a column-by-bucket checksum matrix.

Each copy gives, per key bucket and column, an additive wide checksum (the sum of 128-bit hashes of key and value). Only
rows of buckets with an unequal checksum are read on: a bitmap with one bit for each bucket, of at most ``MOST_BITS``
(8 MB), goes to the scan, so that rows of equal buckets are dropped before anything is shuffled; with more buckets than
that the unequal ones are joined by their number. Only columns unequal somewhere in a bucket are compared there. Which of
tied rows with different values holds can't be told from hashes: a bucket with such a tie counts as unequal in all columns.

Defined cases: of several rows of a key the one with the latest ``loaded_at`` holds (null is earliest), of ties the one
with the greatest values; null equals only null; null keys are keys like any other; a blank id is the id ``''``; repeated
rows don't matter; if one copy is empty all keys are only in the other; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaloom.session import cut

ROWS_PER_BUCKET, MOST_BITS = 8, 1 << 26
WORDS = (0, 1)  # seeds of the two 64-bit words of a hash


def _wide(key: Sequence[Column], value: Column) -> list[Column]:
    return [F.xxhash64(F.lit(seed), *key, value.isNull(), value) for seed in WORDS]


def digests(df: DataFrame, keys: Sequence[str], columns: Sequence[str], at: str, buckets: int) -> DataFrame:
    """Of the latest row of each key: its bucket and, per column, the hash of key and value. Texts stay where they are.

    ``_tied`` tells that the latest rows differ in values: then the least hash of a whole row isn't the greatest.
    """
    key = [F.col(k) for k in keys]
    names = [f"{c}_{s}" for c in columns for s in range(len(WORDS))]
    hashed = df.select(*keys, at, *(h.alias(f"{c}_{s}") for c in columns for s, h in enumerate(_wide(key, F.col(c)))))
    whole = [f"_whole_{s}" for s in WORDS]
    hashed = hashed.select("*", *(F.xxhash64(F.lit(s), *names).alias(w) for s, w in zip(WORDS, whole, strict=True)))
    held = hashed.groupBy(*keys).agg(F.max(F.struct(at, *whole, *names)).alias("_most"), F.max(F.struct(at, *(F.bitwise_not(w).alias(w) for w in whole))).alias("_least"))
    tied = F.lit(False)
    for w in whole:
        tied = tied | (F.col(f"_most.{w}") != F.bitwise_not(F.col(f"_least.{w}")))
    return held.select(F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias("_bucket"), tied.alias("_tied"), *(F.col(f"_most.{n}").alias(n) for n in names))


def matrix(digest: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per bucket: number of keys, whether any is tied, and each column's checksum, as sums of 32-bit halves, which can't overflow."""
    sums = []
    for c in columns:
        for s in range(len(WORDS)):
            word = F.col(f"{c}_{s}")
            sums += [F.sum(word.bitwiseAND(0xFFFFFFFF)).alias(f"{c}_{s}_low"), F.sum(F.shiftrightunsigned(word, 32)).alias(f"{c}_{s}_high")]
    return digest.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n"), F.max("_tied").alias("_tied"), *sums)


def unequal(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Buckets whose checksums differ, with a flag for each column; a bucket in one copy only, or with a tie, differs in all."""
    names = [f"{c}_{s}_{half}" for c in columns for s in range(len(WORDS)) for half in ("low", "high")]
    both = a.alias("a").join(b.alias("b"), F.col("a._bucket") == F.col("b._bucket"), "full")
    tied = F.coalesce("a._tied", F.lit(False)) | F.coalesce("b._tied", F.lit(False))
    differs = {c: tied | ~F.expr(" and ".join(f"(a.{n} <=> b.{n})" for n in names if n.startswith(f"{c}_") and n[len(c) + 1] in "01")) for c in columns}
    marked = both.select(F.coalesce("a._bucket", "b._bucket").alias("_bucket"), (~F.expr("a.n <=> b.n")).alias("_n"), *(d.alias(c) for c, d in differs.items()))
    return marked.where(" or ".join(["_n", *columns]))


def bucket_count(rows: int) -> int:
    """A power of two, for about ``ROWS_PER_BUCKET`` keys in a bucket at any size."""
    return 1 << max(6, (rows // ROWS_PER_BUCKET).bit_length())


def _bit(bucket: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), bucket.bitwiseAND(63).cast("int"))


def bitmap(bad: DataFrame, buckets: int) -> DataFrame:
    """One row ``_bits``: an array of ``buckets`` / 64 words, in which the unequal buckets' bits are set."""
    words = bad.groupBy(F.shiftright("_bucket", 6).alias("_w")).agg(F.bit_or(_bit(F.col("_bucket"))).alias("_b"))
    every = bad.sparkSession.range(buckets // 64).join(words, F.col("id") == F.col("_w"), "left").select("id", F.coalesce("_b", F.lit(0)).alias("_b"))
    return every.agg(F.transform(F.sort_array(F.collect_list(F.struct("id", "_b"))), lambda x: x["_b"]).alias("_bits"))


def in_buckets(rows: DataFrame, bad: DataFrame, buckets: int, most_bits: int = MOST_BITS) -> DataFrame:
    """``rows`` (with ``_bucket``) of the buckets of ``bad``, dropped where they are read if the bitmap is within its bound."""
    if buckets > most_bits:
        return rows
    columns = rows.columns
    here = F.get("_bits", F.shiftright("_bucket", 6).cast("int")).bitwiseAND(_bit(F.col("_bucket"))) != 0
    return rows.join(F.broadcast(bitmap(bad, buckets)), here).select(*columns)


def differences(
    a: DataFrame, b: DataFrame, keys: Sequence[str], columns: Sequence[str], at: str = "loaded_at", only: tuple[str, str] = ("only_a", "only_b"), most_bits: int = MOST_BITS
) -> DataFrame:
    """``keys, diff, value_a, value_b``: one row for each key held on one side only and for each differing column."""
    need = [*keys, *columns, at]
    a, b = a.select(*need), b.select(*need)
    buckets = bucket_count(a.count())  # footers only
    bad = cut(unequal(matrix(digests(a, keys, columns, at, buckets), columns), matrix(digests(b, keys, columns, at, buckets), columns), columns))
    here = bad.select("_bucket", *(F.col(c).alias(f"_{c}") for c in columns))

    def again(df: DataFrame) -> DataFrame:
        """The holding rows of unequal buckets, with the values of the columns that are unequal there; all columns decide which row holds."""
        rows = in_buckets(df.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets))), bad, buckets, most_bits).join(here, "_bucket")
        held = rows.groupBy("_bucket", *keys).agg(F.max(F.struct(at, *columns)).alias("_held"), *(F.max(f"_{c}").alias(f"_{c}") for c in columns))
        return held.select("_bucket", *keys, *(F.when(F.col(f"_{c}"), F.col(f"_held.{c}")).alias(c) for c in columns))

    x, y = again(a).alias("x"), again(b).alias("y")
    same = F.expr(" and ".join(f"(x.{k} <=> y.{k})" for k in ["_bucket", *keys]))
    both = x.withColumn("_x", F.lit(1)).alias("x").join(y.withColumn("_y", F.lit(1)).alias("y"), same, "full")
    text = lambda side, c: F.col(f"{side}.{c}").cast("string")
    one_side = F.when(F.col("_y").isNull(), F.lit(only[0])).otherwise(F.lit(only[1]))
    nothing = F.lit(None).cast("string")
    alone = F.array(F.struct(one_side.alias("diff"), nothing.alias("value_a"), nothing.alias("value_b")))
    fields = F.array(*(F.when(~F.expr(f"x.{c} <=> y.{c}"), F.struct(F.lit(c).alias("diff"), text("x", c).alias("value_a"), text("y", c).alias("value_b"))) for c in columns))
    found = F.when(F.col("_x").isNull() | F.col("_y").isNull(), alone).otherwise(F.filter(fields, lambda f: f.isNotNull()))
    return both.select(*(F.coalesce(F.col(f"x.{k}"), F.col(f"y.{k}")).alias(k) for k in keys), F.inline(found))
