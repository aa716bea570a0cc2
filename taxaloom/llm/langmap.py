"""Mapping freely typed values to the entries of a reference list.

The names and codes of the entries are held in BK-trees under the unrestricted Damerau-Levenshtein distance, a true
metric, so that the triangle inequality prunes branches without losing an entry within the threshold. The reference list
is sharded (``SHARD_ROWS`` names a shard); every distinct typed value is looked up in every shard, and the shards'
winners are merged. Only distinct values are looked up, whatever the number of rows.

Entries are compared whole, as they are written. A typed value is compared in up to three forms: whole; without a label
before it (``in``, ``language:``); and without what stands in brackets or behind a comma as well. The first form that is an
entry is meant; only if none is, the first form with an entry within the threshold.

Defined cases: null and blank values mean nothing; equal distances are decided by the smaller entry code, but a value that
had to be cut at a bracket or comma and then is equally near to several entries means none; repeated rows are all kept;
with an empty reference list nothing is matched; values are compared without case and closing marks, accents kept.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaloom.session import cut

SHARD_ROWS, VALUES_PER_TASK, MOST_TASKS, FEW_PAIRS = 20_000, 500, 1_000, 200_000
WHOLE, BARE, HEAD = 0, 1, 2  # the forms of a typed value


def distance(a: str, b: str) -> int:
    """Unrestricted Damerau-Levenshtein distance: insertions, deletions, substitutions and transpositions of neighbours, all of cost 1."""
    top = len(a) + len(b)
    rows = [[top] * (len(b) + 2)] + [[top, *range(len(b) + 1)]]
    seen: dict[str, int] = {}
    for i, x in enumerate(a, 1):
        row, match = [top, i], 0
        for j, y in enumerate(b, 1):
            i0, j0 = seen.get(y, 0), match
            if x == y:
                cost, match = 0, j
            else:
                cost = 1
            row.append(min(rows[i][j] + cost, row[j] + 1, rows[i][j + 1] + 1, rows[i0][j0] + (i - i0 - 1) + 1 + (j - j0 - 1)))
        rows.append(row)
        seen[x] = i
    return rows[-1][-1]


class BKTree:
    """Entries (text, code) by the distance of their texts."""

    def __init__(self, entries: list[tuple[str, str]]) -> None:
        self.root: tuple[str, set[str], dict] | None = None
        for text, code in sorted(set(entries)):
            self._add(text, code)

    def _add(self, text: str, code: str) -> None:
        if self.root is None:
            self.root = (text, {code}, {})
            return
        node = self.root
        while d := distance(text, node[0]):
            if d not in node[2]:
                node[2][d] = (text, {code}, {})
                return
            node = node[2][d]
        node[1].add(code)

    def within(self, text: str, radius: int) -> list[tuple[int, str, str]]:
        """Every (distance, code, entry text) at most ``radius`` away."""
        found, stack = [], [self.root] if self.root else []
        while stack:
            name, codes, below = stack.pop()
            d = distance(text, name)
            if d <= radius:
                found += [(d, c, name) for c in codes]
            stack += [child for k, child in below.items() if d - radius <= k <= d + radius]
        return found


def threshold(length: int) -> int:
    """Edits allowed for a value of so many characters; codes must be exact."""
    return 0 if length <= 3 else 1 if length <= 5 else 2


# Fixed value: words that may stand before a value as its label.
LABEL = re.compile(r"(?:\W*\b(?:in|lang|language|langue|lingua|idioma|sprache|code)\b\W*)+(?=\w)")


def plain(text: str | None) -> str:
    """A text as compared, whole."""
    return " ".join(unicodedata.normalize("NFKC", text or "").casefold().strip(" \t\n.?!:;*").split())


def forms(text: str | None) -> list[tuple[int, str]]:
    """The different forms in which a typed value is compared, in order."""
    whole = plain(text)
    bare = LABEL.sub("", whole, count=1) if LABEL.match(whole) else whole
    head = bare
    for mark in "([,":
        before = head.partition(mark)[0]
        head = before if before.strip() else head
    out: list[tuple[int, str]] = []
    for k, form in ((WHOLE, whole), (BARE, bare), (HEAD, head)):
        form = plain(form)
        if form and form not in {f for _, f in out}:
            out.append((k, form))
    return out


_trees: dict[int, BKTree] = {}


def _tree(entries: pd.DataFrame) -> BKTree:
    """The tree of a shard, made once in each worker."""
    pairs = list(zip(entries["name"], entries["code"], strict=True))
    key = hash(tuple(sorted(pairs)))
    if key not in _trees:
        if len(_trees) >= 4:
            _trees.clear()
        _trees[key] = BKTree(pairs)
    return _trees[key]


def _look_up(values: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
    tree, rows = _tree(entries), []
    for value in values["value"]:
        asked = forms(value)
        hits = [(False, k, 0, code) for k, form in asked for _, code, _ in tree.within(form, 0)]
        if not hits:  # a code is never misspelt into
            hits = [(True, k, d, code) for k, form in asked for d, code, name in tree.within(form, threshold(len(form))) if len(name) > 3]
        best = min((h[:3] for h in hits), default=None)
        rows += [(value, *h) for h in set(hits) if h[:3] == best]
    return pd.DataFrame(rows, columns=["value", "misspelt", "form", "edits", "code"])


def reference_names(languages: DataFrame) -> DataFrame:
    """``name, code`` of every way to write an entry, as compared."""
    ways = F.concat(F.array("language", "lang_code", "lang_code2"), F.coalesce("alt_names", F.array().cast("array<string>")))
    names = languages.where("lang_code is not null").select(F.explode(ways).alias("way"), F.col("lang_code").alias("code")).where("way is not null")
    kind = "name string, code string"
    return names.mapInPandas(lambda it: (pd.DataFrame({"name": [plain(w) for w in p["way"]], "code": p["code"]}) for p in it), kind).where("name <> ''").distinct()


def matches(values: DataFrame, names: DataFrame, shard_rows: int = SHARD_ROWS, values_per_task: int = VALUES_PER_TASK) -> DataFrame:
    """For distinct ``value`` rows: ``value, code, edits`` of the closest entry within the threshold; others are absent."""
    shards = max(1, -(-names.count() // shard_rows))
    tasks = max(1, -(-values.count() // values_per_task))
    parts = min(shards * tasks, MOST_TASKS)  # given, so that few values aren't put into one task
    asked = values.select("value", F.pmod(F.xxhash64("value"), F.lit(tasks)).alias("task"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    kept = names.select("name", "code", F.pmod(F.xxhash64("name"), F.lit(shards)).cast("int").alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(tasks - 1)).cast("array<bigint>")).alias("task"))
    asked, kept = (df.repartition(parts, "shard", "task").groupBy("shard", "task") for df in (asked, kept))
    found = asked.cogroup(kept).applyInPandas(_look_up, "value string, misspelt boolean, form int, edits int, code string")
    ties = found.groupBy("value", "misspelt", "form", "edits").agg(F.min("code").alias("code"), F.count_distinct("code").alias("n"))
    best = ties.groupBy("value").agg(F.min(F.struct("misspelt", "form", "edits", "code", "n")).alias("best"))
    return best.where((F.col("best.form") < HEAD) | (F.col("best.n") == 1)).select("value", "best.code", "best.edits")


def mapped(rows: DataFrame, languages: DataFrame) -> DataFrame:
    """``rows`` with ``means``: the entry code meant by ``language``, else by ``lang_code``, else ``''``; and ``exact``, whether both are an entry's own.

    A few languages hold most rows, so the different pairs of language and code are resolved first. Up to ``FEW_PAIRS``
    of them are broadcast to the rows; more are joined by their key.
    """
    columns = rows.columns
    pairs = cut(rows.select(F.col("language").alias("_l"), F.col("lang_code").alias("_c")).distinct())
    values = pairs.select(F.explode(F.array("_l", "_c")).alias("value")).where("trim(value) <> ''").distinct()
    best = cut(matches(values, reference_names(languages)))
    own = languages.select(F.col("language").alias("_own"), F.col("lang_code").alias("_code")).distinct().withColumn("_exact", F.lit(True))
    by_name = best.select(F.col("value").alias("_v1"), F.col("code").alias("_c1"))
    by_code = best.select(F.col("value").alias("_v2"), F.col("code").alias("_c2"))
    told = pairs.join(by_name, F.col("_l") == F.col("_v1"), "left").join(by_code, F.col("_c") == F.col("_v2"), "left").join(own, F.expr("_l = _own and _c = _code"), "left")
    told = told.select("_l", "_c", F.coalesce("_c1", "_c2", F.lit("")).alias("means"), F.coalesce("_exact", F.lit(False)).alias("exact"))
    told = F.broadcast(told) if pairs.count() <= FEW_PAIRS else told
    return rows.drop("means", "exact").join(told, F.expr("language <=> _l and lang_code <=> _c"), "left").select(*(c for c in columns if c not in ("means", "exact")), "means", "exact")
