"""One consistent form for text that looks the same.

Texts are exploded to positioned code points; a broadcast join brings each code point's decomposition and look-alike; the
marks behind a base letter are ordered by combining class; the pieces are put together again and recomposed. Texts of
plain ASCII are already in that form.

Look-alikes come from two places. For letters of the Latin, Greek, Cyrillic, Armenian and East Asian scripts, in which names
are written, they are listed below: the published table of confusable characters joins letters there that a reader tells
apart (``г`` and ``r``, large and small ``з``, digits and letters). For the letters of all other scripts the published table
is taken, as the ICU library beside Spark has it, where it gives one Latin letter (of the same case, if the script has cases).

Full-width, half-width and ligature forms, presentation forms and mathematical letters become plain; blanks of all kinds
become a space; invisible characters go; letters of other scripts that look like Latin ones, and Japanese characters that
look like others, become these. Accents, case, punctuation and spacing stay. Superscripts, fractions and circled forms
look different and stay. The form serves comparison: a Cyrillic word may come out with Latin letters in it.

Defined cases: null has the form null; the form of empty or blank text is ``''``; repeated rows are all kept; texts of any
length are treated whole; extra columns stay unless named like the result.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taxaloom.session import cut

# Characters and the plain ones they look like, by script.
ALIKE = {
    # Cyrillic
    "А": "A", "В": "B", "Е": "E", "Ѕ": "S", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "Ү": "Y", "Ԍ": "G", "Ԛ": "Q", "Ԝ": "W", "Ӏ": "I",
    "а": "a", "е": "e", "ѕ": "s", "і": "i", "ј": "j", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "l", "ѵ": "v", "ү": "y", "ԍ": "g", "г": "r",
    # Greek
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ϲ": "C", "Ϳ": "J",
    "α": "a", "ι": "i", "ν": "v", "ο": "o", "ρ": "p", "υ": "u", "ϲ": "c", "ϳ": "j", "σ": "o", "γ": "y", "κ": "k",
    # Armenian
    "ո": "n", "ս": "u", "օ": "o", "հ": "h", "ց": "g", "զ": "q", "յ": "j", "ք": "p", "ՙ": "'", "Օ": "O", "Տ": "S", "Լ": "L", "Ս": "U",
    # Latin letters and letter-like signs
    "ɑ": "a", "ɡ": "g", "ı": "i", "ɩ": "i", "ʋ": "v", "ᴄ": "c", "ᴏ": "o", "ᴠ": "v", "ᴡ": "w", "ᴢ": "z", "ꜱ": "s", "ƽ": "s", "ǀ": "l",
    # Cherokee
    "Ꭺ": "A", "Ᏼ": "B", "Ꮯ": "C", "Ꭰ": "D", "Ꭼ": "E", "Ꮋ": "H", "Ꭻ": "J", "Ꮶ": "K", "Ꮮ": "L", "Ꮇ": "M", "Ꮲ": "P", "Ꮢ": "R", "Ꮪ": "S", "Ꭲ": "T", "Ꮩ": "V", "Ꮃ": "W", "Ꮓ": "Z",
    # hyphens and marks
    "‐": "-", "‑": "-", "˗": "-", "−": "-", "․": ".", ";": ";", "։": ":", "∶": ":",
    # Japanese and Chinese
    "二": "ニ", "口": "ロ", "力": "カ", "八": "ハ", "夕": "タ", "卜": "ト", "工": "エ", "千": "チ", "へ": "ヘ", "べ": "ベ", "ぺ": "ペ", "一": "ー",
}
del ALIKE["г"], ALIKE["σ"], ALIKE["γ"], ALIKE["κ"], ALIKE["α"]  # alike in some typefaces only
#: Kinds of compatibility decomposition that look like what they decompose to.
SAME_LOOK = ("<wide>", "<narrow>", "<noBreak>", "<compat>", "<font>", "<initial>", "<medial>", "<final>", "<isolated>", "<vertical>")
# Fixed values: <compat> decompositions that look different from their parts.
DIFFERENT = "ſµ·…‥ºª΄´¨¯¸˘˙˚˛˜˝℀℁℅℆№℡™"
# Invisible characters besides those of category Cf.
INVISIBLE = "͏ᅟᅠ឴឵᠋᠌᠍᠎᠏ㅤﾠ" + "".join(map(chr, range(0xFE00, 0xFE10)))


@cache
def mapping() -> dict[str, str]:
    """Every character whose form differs from itself: decomposed, plain, invisible ones gone."""
    out: dict[str, str] = {}

    def form(ch: str) -> str:
        kind, _, rest = unicodedata.decomposition(ch).rpartition("> ")
        if ch in INVISIBLE or unicodedata.category(ch) == "Cf":
            return ""
        if ch in ALIKE:
            return ALIKE[ch]
        if unicodedata.category(ch) in ("Zs", "Zl", "Zp") or ch in "\t\n\r\x0b\x0c\x85":
            return " "
        if rest and ch not in DIFFERENT and (not kind or kind + ">" in SAME_LOOK) and not (0xAC00 <= ord(ch) <= 0xD7A3):
            return "".join(form(chr(int(x, 16))) for x in rest.split())
        return ch

    for cp in (*range(0xD800), *range(0xE000, 0x30000), *range(0xE0000, 0xE1000)):  # the planes in use
        if (new := form(chr(cp))) != chr(cp):
            out[chr(cp)] = new
    return out


def mapping_table(spark: SparkSession) -> DataFrame:
    """``ch, parts`` (character and combining class): code points that change, and combining marks. Its size is bounded by Unicode's tables."""
    changed = published(spark) | mapping()
    marks = {chr(cp): chr(cp) for cp in range(0x300, 0x20000) if unicodedata.combining(chr(cp)) and chr(cp) not in changed}
    rows = pd.DataFrame([(ch, new) for ch, new in (changed | marks).items()], columns=["ch", "new"])
    parts = lambda new: [{"c": c, "cls": unicodedata.combining(c)} for c in new]
    rows["parts"] = [parts(new) for new in rows.pop("new")]
    return spark.createDataFrame(list(rows.itertuples(index=False, name=None)), "ch string, parts array<struct<c:string,cls:int>>")


#: Scripts whose look-alikes are listed above, and kinds of characters that decompose or are no letters of words.
LISTED = ("LATIN", "GREEK", "CYRILLIC", "ARMENIAN", "CJK", "KATAKANA", "HIRAGANA", "HALFWIDTH", "FULLWIDTH", "MODIFIER")


def published(spark: SparkSession) -> dict[str, str]:
    """Letters of the scripts that aren't listed, with the Latin letter the published table of confusables gives; one call into the JVM."""
    letters = [chr(cp) for cp in (*range(0x80, 0xD800), *range(0xE000, 0x20000)) if unicodedata.category(chr(cp)) in ("Lu", "Ll", "Lo") and not unicodedata.name(chr(cp), "").startswith(LISTED)]
    checker = spark._jvm.com.ibm.icu.text.SpoofChecker.Builder().build()
    alike = checker.getSkeleton("\n".join(letters)).split("\n")
    fits = lambda c, x: len(x) == 1 and x.isascii() and x.isalpha() and unicodedata.category(c) in ("Lo", unicodedata.category(x))
    return {c: x for c, x in zip(letters, alike, strict=True) if fits(c, x)}


@F.pandas_udf(T.StringType())
def _recomposed(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for t in texts:
        yield t.map(lambda x: unicodedata.normalize("NFC", x), na_action="ignore")


def same_look(df: DataFrame, text: str, name: str = "form") -> DataFrame:
    """``df`` with ``name``, the one form of ``text``.

    Plain texts need no shuffle. Of the others each different text is treated once; where combining marks stand in it,
    marks are ordered by a window over its points, numbered by the base letter before them.
    """
    plain = F.coalesce(F.col(text).rlike(r"\A[ -~]*\z"), F.lit(True))
    keep = [c for c in df.columns if c != name]
    done = df.where(plain).select(*keep, F.btrim(F.col(text)).alias(name))
    rows = df.where(~plain).withColumn("_key", F.struct(F.xxhash64(F.lit(1), text), F.xxhash64(F.lit(2), text), F.length(text)))
    texts = rows.select("_key", F.col(text).alias("_text")).groupBy("_key").agg(F.min("_text").alias("_text"))
    points = texts.select("_key", F.col("_text").rlike(r"\p{M}").alias("_marked"), F.posexplode(F.split("_text", "")).alias("at", "ch"))
    joined = points.join(F.broadcast(mapping_table(df.sparkSession)), "ch", "left")
    parts = F.coalesce("parts", F.array(F.struct(F.col("ch").alias("c"), F.lit(0).alias("cls"))))
    pieces = joined.select("_key", "_marked", "at", parts.alias("parts"))
    whole = pieces.where("not _marked").groupBy("_key").agg(F.sort_array(F.collect_list(F.struct("at", "parts"))).alias("p"))
    whole = whole.select("_key", F.array_join(F.transform(F.flatten(F.transform("p", lambda x: x["parts"])), lambda x: x["c"]), "").alias("_made"))
    single = pieces.where("_marked").select("_key", "at", F.posexplode("parts").alias("sub", "part")).select("_key", "at", "sub", "part.c", "part.cls")
    base = F.sum((F.col("cls") == 0).cast("int")).over(Window.partitionBy("_key").orderBy("at", "sub"))  # one text each
    ordered = single.withColumn("base", base).groupBy("_key").agg(F.sort_array(F.collect_list(F.struct("base", "cls", "at", "sub", "c"))).alias("p"))
    made = whole.unionByName(ordered.select("_key", F.array_join(F.transform("p", lambda x: x["c"]), "").alias("_made")))
    made = made.select(F.col("_key").alias("_k"), F.btrim(_recomposed("_made")).alias("_form"))
    return done.unionByName(rows.join(made, F.col("_key") == F.col("_k"), "left").select(*keep, F.coalesce("_form", F.lit("")).alias(name)))


def pairs(forms: DataFrame, group: str = "tab", key: str = "id", form: str = "form") -> DataFrame:
    """Pairs of different keys of one group with the same form: ``group, id_a, id_b``, ``id_a < id_b``.

    Forms are compared by a 128-bit hash, so that texts needn't be shuffled; only forms of at least two keys are joined. The
    number of pairs grows with the square of a form's keys; ``classes`` has one row for each key instead.
    """
    rows = forms.where(F.col(form).isNotNull() & F.col(key).isNotNull())
    hashed = cut(rows.select(group, key, F.xxhash64(F.lit(1), form).alias("_h1"), F.xxhash64(F.lit(2), form).alias("_h2")))  # forms are made once
    on = [group, "_h1", "_h2"]
    groups = hashed.groupBy(*on).agg(F.min(key).alias("_least"), F.max(key).alias("_most")).where("_least < _most").select(*on)
    shared = hashed.join(groups, on, "left_semi").distinct()
    a, b = shared.withColumnRenamed(key, "id_a"), shared.withColumnRenamed(key, "id_b")
    return a.join(b, on).where("id_a < id_b").select(group, "id_a", "id_b")


def classes(forms: DataFrame, group: str = "tab", key: str = "id", form: str = "form") -> DataFrame:
    """The keys that share their form with others: ``group, key, class_id`` (the least key of the form) and ``n_alike``, how many others there are."""
    rows = forms.where(F.col(form).isNotNull() & F.col(key).isNotNull()).select(group, key, F.xxhash64(F.lit(1), form).alias("_h1"), F.xxhash64(F.lit(2), form).alias("_h2")).distinct()
    on = [group, "_h1", "_h2"]
    of = rows.groupBy(*on).agg(F.min(key).alias("class_id"), (F.count(F.lit(1)) - 1).alias("n_alike")).where("n_alike > 0")
    return rows.join(of, on).select(group, key, "class_id", "n_alike")
