"""Several values packed in one field: dictionary-guided segmentation.

Fields that are their values joined by single ``|`` are split by built-in functions. The others are cut in tasks:

* every mark outside quotes is a possible border;
* whole values that contain marks are known from the fields that are well formed (the dictionary). Each untidy record gets
  those of them whose first two segments stand next to each other in it, by a join, so that what a record gets is bounded
  by what it holds, not by how usual its words are; an automaton over the patterns of a batch of records finds their
  occurrences;
* dynamic programming picks the cheapest cover of the segments by known whole values, single segments and, where a field
  uses other marks too, segments joined at commas or slashes; so marks inside legitimate values are protected;
* the nth values of a record's fields belong together: of two covers that differ in whether commas and slashes are
  borders, the one is taken whose number of values the record's other fields have.

Defined cases: null and empty fields hold no value, nor does a field of blanks; a delimiter at the end opens no value; an
empty value between two delimiters is ``''``; quotes which don't enclose a whole value belong to the value; a doubled
quote inside quotes stands for one; records that repeat give repeated rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Collection, Iterable, Iterator, Sequence

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaloom.functions.ids import BLANKS
from taxaloom.session import cut

# Marks used as delimiters. Commas and slashes also occur inside values of fields that are delimited otherwise.
HARD, SOFT = ("::", "|", ";", ">", "¦", "｜", "\t"), (",", "/")
QUOTES = "\"'"
MARK = r"::|[|;>\x{a6}\x{ff5c}\t,/]"
_BLANK = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in BLANKS) + "]"
#: Fields that may be other than their values joined by single "|": quotes around a value, other hard marks, blanks around a value, a mark at the end.
#: Marks and ends are looked for before blanks, as they are few.
UNTIDY = (
    f"::|[;>\\x{{a6}}\\x{{ff5c}}\\t]|\\A{_BLANK}|\\z(?<={_BLANK})|\\|(?:{_BLANK}|\\z|(?<={_BLANK}\\|))"
    f"|(?:\\A|[|,/]){_BLANK}*[\"']|\\A[^|]*[,/][^|]*\\z"
)
#: Fields of plain words with single blanks and bars between them, which are tidy and need no closer look.
PLAIN = r"\A[A-Za-z0-9._()-]++(?:[ |][A-Za-z0-9._()-]++)*+\z"
KNOWN, SINGLE, JOINED = 10, 20, 21  # costs of a cover's parts
MARKS = re.compile(MARK.replace("x{a6}", "xa6").replace("x{ff5c}", "uff5c"))
Cut = tuple[list[tuple[int, int, str | None]], list[str]]


def _segments(text: str) -> Cut:
    """Segments (start, end, value if quoted) and the marks between them."""
    out, marks, at, n = [], [], 0, len(text)
    quotes = any(q in text for q in QUOTES)
    while True:
        start = at
        while quotes and start < n and text[start] in BLANKS and text[start] != "\t":
            start += 1
        if quotes and start < n and text[start] in QUOTES and (end := _closing(text, start)):
            stop = end
            while stop < n and text[stop] in BLANKS and text[stop] != "\t":
                stop += 1
            mark = MARKS.match(text, stop)
            if stop == n or mark:
                q = text[start]
                out.append((start, end, text[start + 1 : end - 1].replace(q + q, q)))
                if stop == n:
                    return out, marks
                marks.append(mark[0])
                at = mark.end()
                continue
        mark = MARKS.search(text, start)
        out.append((at, mark.start() if mark else n, None))
        if not mark:
            return out, marks
        marks.append(mark[0])
        at = mark.end()


def _closing(text: str, start: int) -> int:
    """Behind the quote that closes the one at ``start``; 0 if there is none."""
    q, at = text[start], start + 1
    while (at := text.find(q, at)) >= 0:
        if text[at : at + 2] != q + q:
            return at + 1
        at += 2
    return 0


def _spans(text: str, segments: list[tuple[int, int, str | None]], known: ahocorasick.Automaton | None) -> dict[int, list[int]]:
    """Where known whole values of several segments lie: last segment to first segments."""
    if known is None:
        return {}
    begins, ends, spans = {}, {}, {}
    for k, (a, b, _) in enumerate(segments):
        inner = text[a:b]
        begins[a + len(inner) - len(inner.lstrip(BLANKS))] = k
        ends[a + len(inner.rstrip(BLANKS))] = k
    for last, pattern in known.iter(text):
        i, j = begins.get(last + 1 - len(pattern)), ends.get(last + 1)
        if i is not None and j is not None and j > i:
            spans.setdefault(j, []).append(i)
    return spans


def _cover(text: str, parts: Cut, spans: dict[int, list[int]], joints: Collection[str]) -> list[str]:
    """The values of the cheapest cover of the field's segments, where marks among ``joints`` may lie inside values."""
    segments, marks = parts
    if len(marks) == len(segments) - 1 and segments and segments[-1][0] == len(text) and marks:
        segments, marks = segments[:-1], marks[:-1]  # a delimiter that ends the field opens no value
    n = len(segments)
    best: list[tuple[int, int]] = [(0, 0)]  # cost, start of the last part, for the first k segments
    for j in range(n):
        options = [(best[j][0] + SINGLE, -j), *((best[i][0] + KNOWN, -i) for i in spans.get(j, []))]
        i = j
        while i > 0 and marks[i - 1] in joints and segments[i][2] is None and segments[i - 1][2] is None:
            i -= 1
            options.append((best[i][0] + JOINED, -i))
        cost, start = min(options)
        best.append((cost, -start))
    out, j = [], n
    while j:
        i = best[j][1]
        a, b, quoted = segments[i]
        out.append(quoted if j - i == 1 and quoted is not None else text[a : segments[j - 1][1]])
        j = i
    return [v.strip(BLANKS) for v in reversed(out)]


def automaton(patterns: Iterable[str]) -> ahocorasick.Automaton | None:
    """An automaton over whole values; none if there are none."""
    known = ahocorasick.Automaton()
    for p in patterns:
        known.add_word(p, p)
    if not len(known):
        return None
    known.make_automaton()
    return known


def split_values(fields: Sequence[str | None], patterns: Iterable[str] | ahocorasick.Automaton | None = ()) -> list[list[str]]:
    """The values of each of one record's packed fields; ``patterns`` are known whole values, or the automaton made of them."""
    known = patterns if patterns is None or isinstance(patterns, ahocorasick.Automaton) else automaton(patterns)
    covers: list[list[list[str]]] = []
    for text in fields:
        if text is None or not text.strip(BLANKS):
            covers.append([[]])
            continue
        parts = _segments(text)
        spans = _spans(text, parts[0], known)
        marks = Counter(parts[1])
        soft = [m for m, _ in sorted(((m, marks[m]) for m in SOFT if m in marks), key=lambda x: -x[1])]
        ways = [soft[k:] for k in range(len(soft), -1, -1)] + [[m] for m in soft[:-1]]  # from no joints to all
        if any(m in marks for m in HARD):
            ways = [soft, *(w for w in ways if w != soft)]
        elif len(soft) == 2:
            ways = [soft[1:], *(w for w in ways if w != soft[1:])]
        covers.append([_cover(text, parts, spans, w) for w in ways])
    counts = Counter(len(c[0]) for c in covers if len(c) == 1 and c[0])
    if counts:
        usual = counts.most_common(1)[0][0]
        return [next((v for v in c if len(v) == usual), c[0]) for c in covers]
    return [c[0] for c in covers]


def untidy(c: Column) -> Column:
    """Whether a field may be other than its values joined by single ``|``."""
    return F.when(c.rlike(PLAIN), F.lit(False)).otherwise(F.coalesce(c.rlike(UNTIDY), F.lit(False)))


def protected_values(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """The dictionary: distinct whole values with marks, from well-formed fields and from quotes; with their first two segments, ``head`` and ``next``."""
    soft = F.array(*(F.when(~untidy(F.col(f)) & F.col(f).rlike("[,/]"), F.split(f, r"\|")) for f in fields))
    quoted = F.array(*(F.when(F.col(f).contains('"'), F.transform(F.regexp_extract_all(f, F.lit(r'"((?:[^"]|"")*)"'), F.lit(1)), lambda v: F.replace(v, F.lit('""'), F.lit('"')))) for f in fields))
    one = df.where(" or ".join(f"{f} rlike '[,/\"]'" for f in fields)).select(F.explode(F.filter(F.flatten(F.filter(F.concat(soft, quoted), lambda a: a.isNotNull())), lambda v: v.rlike(MARK))).alias("value"))
    parts = F.split("value", MARK)
    return one.distinct().select("value", *(F.btrim(F.get(parts, F.lit(k)), F.lit(BLANKS)).alias(c) for k, c in enumerate(("head", "next"))))


def _cut(fields: Sequence[str], keys: Sequence[str]):  # noqa: ANN202
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            known = automaton({v for patterns in pdf["_patterns"] if patterns is not None for v in patterns})
            made = [split_values(row, known) for row in zip(*(pdf[f] for f in fields), strict=True)]
            yield pdf[list(keys)].assign(**{f: [m[k] for m in made] for k, f in enumerate(fields)})

    return run


def values(df: DataFrame, keys: Sequence[str], fields: Sequence[str], only_untidy: bool = False) -> DataFrame:
    """One row for each value: ``keys, field, pos, value``, ``pos`` from 1.

    ``only_untidy`` leaves out the fields that are exactly their values joined by single ``|``.
    """
    rows = df.select(*keys, *fields)
    bars = [F.when(F.col(f) != "", F.size(F.split(f, r"\|"))) for f in fields]
    unlike = F.coalesce((F.greatest(*bars) != F.least(*bars)) & F.exists(F.array(*fields), lambda x: x.rlike("[,/]")), F.lit(False))  # null beside a null field
    odd = F.exists(F.array(*(untidy(F.col(f)) for f in fields)), lambda x: x) | unlike
    marked = rows.withColumn("_odd", odd)
    hard = cut(marked.where("_odd").withColumn("_row", F.xxhash64(*fields)))  # found once

    split = hard.select("_row", *(F.transform(F.split(f, MARK), lambda x: F.btrim(x, F.lit(BLANKS))).alias(f"_s{k}") for k, f in enumerate(fields)))
    beside = []  # segments of a field that stand next to each other
    for k in range(len(fields)):
        s, n = F.col(f"_s{k}"), F.greatest(F.size(f"_s{k}") - 1, F.lit(0))
        beside.append(F.arrays_zip(F.slice(s, F.lit(1), n), F.slice(s, F.lit(2), n)).cast("array<struct<head:string,next:string>>"))
    heads = split.select("_row", F.explode(F.array_distinct(F.flatten(F.array_compact(F.array(*beside))))).alias("p")).select("_row", "p.head", "p.next").distinct()
    patterns = heads.join(protected_values(df, fields), ["head", "next"]).groupBy("_row").agg(F.collect_set("value").alias("_patterns"))
    given = hard.join(patterns, "_row", "left").select(*keys, *fields, "_patterns")
    raw = [F.col(f).alias(f"_raw_{f}") for f in fields]
    given = given.select(*keys, *raw, *fields, "_patterns")
    kept = [*keys, *(f"_raw_{f}" for f in fields)]
    schema = ", ".join([*(f"`{k}` {dict(given.dtypes)[k]}" for k in kept), *(f"`{f}` array<string>" for f in fields)])
    made = given.mapInPandas(_cut(fields, kept), schema)

    def long(frame: DataFrame, arrays: Sequence[Column]) -> DataFrame:
        each = F.array(*(F.struct(F.lit(f).alias("field"), a.alias("values")) for f, a in zip(fields, arrays, strict=True) if a is not None))
        packs = frame.select(*keys, F.explode(each).alias("_p")).select(*keys, F.col("_p.field").alias("field"), F.posexplode("_p.values").alias("pos", "value"))
        return packs.select(*keys, "field", (F.col("pos") + 1).alias("pos"), "value")

    def changed(f: str) -> Column:
        return F.when(F.array_join(f, "|") != F.col(f"_raw_{f}"), F.col(f))

    if only_untidy:
        return long(made, [changed(f) for f in fields])
    plain = marked.where("not _odd")
    return long(made, [F.col(f) for f in fields]).unionByName(long(plain, [F.when(F.col(f) != "", F.split(f, r"\|")) for f in fields]))
