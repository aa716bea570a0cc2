"""Scores for abusive, hateful or sexual content: a string-kernel support vector machine.

Words are compared by the gap-weighted subsequence kernel over their characters, so that an insult with left-out,
replaced or inserted characters stays close to itself. Nyström landmarks (words of the labelled sentences) turn it into
vectors of words; the sum over the words of a sentence (here: what stands between two punctuation marks) is the
convolution kernel of sentences, normalised and put under a Gaussian; landmark sentences turn that into features of a
linear machine with squared hinge loss. A document's score is the greatest decision value of its sentences,
interruptions included.

Labels are given to whole documents by annotators who err. Which sentences carry a label follows from their surroundings
in the space of sentences: one is taken for offensive if most of what lies near it, each sentence weighted by the
documents that hold it, comes from other documents labelled offensive; a document without such a sentence gives the one
farthest from all harmless ones, if there is any. Sentences of harmless documents that lie among offensive ones are left
out as errors. What stands before a colon only says who speaks and is never taken. The rest of the harmless sentences
count by the documents that hold them, so that usual phrases stay far below the cut.

The cut is a constant a little below the machine's own boundary, not fitted to the noisy labels: over resampled fits,
values from -0.4 to 0 gave nearly the same documents.

The machine is fitted on the driver on at most ``MAX_DOCS`` labelled documents, chosen by a hash of their id. All their
sentences are looked at; of the harmless ones at most ``NEGATIVES`` are trained on (the most frequent, the
highest-scored and random ones, a third each). These are bounds of the training sample. Scoring runs over all documents
and whole texts, in tasks, without a shuffle.

Defined cases: null, empty and blank texts score ``NO_SENTENCE``; labels that are null or undecided are left out;
without labels of both kinds every text scores ``NO_SENTENCE``; repeated documents are scored alike.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaloom.llm.lookalike import mapping

MAX_DOCS, WORD_LANDMARKS, SENTENCE_LANDMARKS, NEGATIVES, WORD_DIMS = 6_000, 400, 800, 12_000, 128
LENGTH, DECAY, WIDTH, COST, TURNS, SEED, UNKNOWN, CUT_AT = 3, 0.5, 2.0, 30.0, 3, 7, 0.7, -0.3
# Surroundings: how near counts, weight and value of the prior, least weight of others, most harmless weight of a lone sentence.
REACH, PRIOR_WEIGHT, PRIOR, LEAST, LONE = 0.7, 0.5, 0.35, 0.2, 0.3
NO_SENTENCE = -9.0
MEMO, EACH = 300_000, 64

# Digits and signs written for letters.
LEET = str.maketrans("013457@$", "oieastas")
SINGLES = re.compile(r"[\W_][^\W_][\W_]{1,2}[^\W_](?![^\W_])")
SPACED = re.compile(r"(?<![^\W_])[^\W_](?:[\W_]{1,2}[^\W_](?![^\W_])){2,}")
GLUED = re.compile(r"[A-Z](?<=[a-z]{3}[A-Z])(?=[a-z\s])")
MARKS = re.compile("[\u0300-\u036f]+")
CUT = re.compile(r"[.!?;…,]+(?:[\s*]+|$)|(?<=:)\s+|[\n\r]+|\s[—–-]+\s|[\[\](){}«»“”„\"¡¿]")
WORD = re.compile(r"[\w*#@$]*[^\W\d_][\w*#@$]*")
LONG = re.compile(r"([^\W\d_])\1{2,}")
NUMBER = re.compile(r"\d(?<![\w*#@$]\d)(?:[\d.,]*\d)?(?![\w*#@$])")


def _joined(m: re.Match[str]) -> str:
    return "".join(c for c in m[0] if c.isalnum())


def folded(text: str) -> str:
    """Look-alikes and invisible characters resolved, lower case, without accents and numbers, spaced-out words joined, glued sentences parted."""
    if not text.isascii():
        text = _plain(text)
    text = GLUED.sub(". \\g<0>", text)
    out = text.replace("'", "").lower() if text.isascii() else MARKS.sub("", unicodedata.normalize("NFD", text.casefold()))
    return NUMBER.sub("", SPACED.sub(_joined, out) if SINGLES.search(f" {out}") else out)


@cache
def _mapped() -> dict[str, str]:
    return {k: v for k, v in mapping().items() if k != "\n"} | {"'": "", "’": ""}


def _plain(text: str) -> str:
    """``text`` with its different characters, of which there are few, replaced one by one."""
    table = _mapped()
    for c in set(text) & table.keys():
        text = text.replace(c, table[c])
    return text


def parts(text: str | None) -> list[str]:
    """The sentences of a text, folded: what stands between two punctuation marks."""
    return [p for x in CUT.split(folded(text)) if (p := x.strip())] if text else []


def _word(w: str) -> str:
    """A word with digits and signs written for letters, underscores and long repeats resolved."""
    return LONG.sub(r"\1", w.translate(LEET).replace("_", ""))


def tokens(part: str, known: dict[str, str] | None = None) -> list[str]:
    """The words of a folded sentence; ``known`` keeps words made before."""
    known = {} if known is None else known
    words = WORD.findall(part)
    try:
        return [known[w] for w in words]
    except KeyError:
        known.update((w, _word(w)) for w in words if w not in known)
        return [known[w] for w in words]


def sentences(text: str | None) -> list[list[str]]:
    """The words of each sentence that has any."""
    return [words for p in parts(text) if (words := tokens(p))]


def subsequence_kernel(left: Sequence[str], right: Sequence[str], length: int = LENGTH, decay: float = DECAY) -> np.ndarray:
    """Gap-weighted subsequence kernel of every left with every right string."""

    def codes(strings: Sequence[str], pad: int) -> np.ndarray:
        out = np.full((len(strings), max(map(len, strings), default=0)), pad, np.int64)
        for k, s in enumerate(strings):
            out[k, : len(s)] = [ord(c) for c in s]
        return out

    a, b = codes(left, -1), codes(right, -2)
    n, m, lb = len(left), len(right), b.shape[1]
    total, nothing = np.zeros((n, m), np.float64), np.zeros((n, m), np.float32)
    # above[l][j]: weight of common subsequences of length l that lie in left[:i] and right[:j], as decayed at i and j
    above = [[nothing] * (lb + 1) for _ in range(length)]
    for i in range(a.shape[1]):
        here = [[nothing] * (lb + 1) for _ in range(length)]
        equal = [e if (e := a[:, i, None] == b[None, :, j]).any() else None for j in range(lb)]
        for j, e in enumerate(equal):
            if e is not None:
                total += decay**2 * (e if length == 1 else e * above[length - 1][j])
        for step in range(1, length):
            run = nothing
            for j, e in enumerate(equal):
                run = decay * run if e is None else decay * (run + decay * (e if step == 1 else e * above[step - 1][j]))
                here[step][j + 1] = decay * above[step][j + 1] + run
        above = here
    return total


def marked(word: str) -> str:
    return f"^{word}$"


@dataclass
class WordSpace:
    """Vectors of words by Nyström landmarks."""

    landmarks: list[str]
    norms: np.ndarray = field(init=False)
    root: np.ndarray = field(init=False)
    memo: dict[str, int] = field(default_factory=dict)  # words by their row in table
    table: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        strings = [marked(w) for w in self.landmarks]
        k = subsequence_kernel(strings, strings)
        self.norms = np.sqrt(np.diag(k))
        values, vectors = np.linalg.eigh(k / self.norms[:, None] / self.norms[None, :])
        top = np.argsort(-values)[:WORD_DIMS]
        top = top[values[top] > 1e-3]
        self.root = vectors[:, top] / np.sqrt(values[top])
        self.table = np.zeros((0, len(top)), np.float32)

    def learn(self, words: Iterable[str]) -> None:
        """Vectors of new words, in batches of similar length. The table doubles when it is full and is begun anew at ``MEMO`` words."""
        every = set(words)
        new = [w for w in every if w not in self.memo]
        if len(self.memo) + len(new) > MEMO:
            self.memo.clear()
            new = list(every)
        new.sort(key=lambda w: (len(w), w))
        if len(self.memo) + len(new) > len(self.table):
            larger = np.zeros((2 * (len(self.memo) + len(new)), self.table.shape[1]), np.float32)
            larger[: len(self.memo)] = self.table[: len(self.memo)]
            self.table = larger
        strings = [marked(w) for w in self.landmarks]
        for at in range(0, len(new), 128):
            part = new[at : at + 128]
            k = subsequence_kernel([marked(w) for w in part], strings)
            own = np.sqrt(np.maximum(_self_norms(part), 1e-12))
            self.table[len(self.memo) : len(self.memo) + len(part)] = (k / own[:, None] / self.norms[None, :]) @ self.root
            for w in part:
                self.memo[w] = len(self.memo)

    def embed(self, rows: Sequence[Sequence[str]]) -> np.ndarray:
        """Unit vectors of sentences: sums over their words."""
        self.learn(w for r in rows for w in r)
        out = np.full((len(rows), self.width), UNKNOWN, np.float32)  # the last place stands for words unlike all landmarks
        order = sorted(range(len(rows)), key=lambda k: -len(rows[k]))
        for at in range(0, len(rows), 2048):
            part = order[at : at + 2048]
            lengths = np.array([len(rows[k]) for k in part])
            ids = np.array([self.memo[w] for k in part for w in rows[k]])
            starts = np.cumsum(lengths) - lengths
            sums = np.zeros((len(part), self.table.shape[1]), np.float32)
            for place in range(min(lengths[0], EACH)):  # word by word over all sentences that have so many
                n = np.searchsorted(-lengths, -place)
                sums[:n] += self.table[ids[starts[:n] + place]]
            for k in np.where(lengths > EACH)[0]:
                for first in range(EACH, lengths[k], 4096):
                    sums[k] += self.table[ids[starts[k] + first : starts[k] + min(first + 4096, lengths[k])]].sum(axis=0)
            out[part, :-1] = sums
        return out / np.linalg.norm(out, axis=1, keepdims=True)

    @property
    def width(self) -> int:
        return self.root.shape[1] + 1


def _self_norms(words: Sequence[str]) -> np.ndarray:
    """The kernel of each word with itself, for words of one length at a time as one array program."""
    out = np.zeros(len(words))
    for size in {len(w) for w in words}:
        at = [k for k, w in enumerate(words) if len(w) == size]
        out[at] = _diagonal([marked(words[k]) for k in at])
    return out


def _diagonal(strings: Sequence[str], length: int = LENGTH, decay: float = DECAY) -> np.ndarray:
    """The kernel of strings of one length with themselves, row by row: memory grows with the length, not with its square."""
    codes = np.array([[ord(c) for c in s] for s in strings])
    n, size = codes.shape
    total = np.zeros(n)
    # above[l][:, j]: weight of common subsequences of length l that lie in the first i and j characters, as decayed there
    above = [np.ones((n, size)), *(np.zeros((n, size)) for _ in range(length - 1))]
    for i in range(size):
        same = codes[:, i, None] == codes
        total += (same * above[-1]).sum(axis=1)
        here = [above[0]]
        for step in range(1, length):
            run = decay**2 * same * above[step - 1]
            width = 1
            while width < size:  # sums decayed along the row, over twice as many places each time
                run[:, width:] += decay**width * run[:, :-width]
                width *= 2
            row = decay * above[step]
            row[:, 1:] += run[:, :-1]
            here.append(row)
        above = here
    return decay**2 * total


def svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 25) -> np.ndarray:
    """Linear machine (last weight: offset) with squared hinge loss, by Newton steps."""
    n, dims = x.shape
    w, ridge = np.zeros(dims + 1), np.ones(dims + 1)
    ridge[-1] = 1e-3
    for _ in range(rounds):
        gram, side = np.diag(ridge), np.zeros(dims + 1)
        for at in range(0, n, 1024):
            xa, ya, ca = np.hstack([x[at : at + 1024], np.ones((len(x[at : at + 1024]), 1))]), y[at : at + 1024], weight[at : at + 1024]
            on = ya * (xa @ w) < 1
            gram += 2 * (xa[on] * ca[on, None]).T @ xa[on]
            side += 2 * xa[on].T @ (ca[on] * ya[on])
        new = np.linalg.solve(gram, side)
        if np.allclose(new, w, atol=1e-6):
            break
        w = new
    return w


@dataclass
class Machine:
    """Word space, landmark sentences, and the linear weights."""

    space: WordSpace
    points: np.ndarray
    root: np.ndarray
    w: np.ndarray
    cut: float = CUT_AT
    seen: dict[str, float] = field(default_factory=dict)
    words: dict[str, str] = field(default_factory=dict)

    def features(self, e: np.ndarray) -> np.ndarray:
        return np.concatenate([np.zeros((0, self.root.shape[1]), np.float32), *((np.exp(WIDTH * (e[k : k + 1024] @ self.points.T - 1)) @ self.root).astype(np.float32) for k in range(0, len(e), 1024))])

    def values(self, e: np.ndarray) -> np.ndarray:
        """Decision values of vectors of sentences, block by block."""
        beta = (self.root @ self.w[:-1]).astype(np.float32)
        return np.concatenate([np.zeros(0), *(np.exp(WIDTH * (e[k : k + 2048] @ self.points.T - 1)) @ beta + self.w[-1] for k in range(0, len(e), 2048))])

    def decide(self, rows: Sequence[Sequence[str]]) -> np.ndarray:
        return self.values(self.space.embed(rows))

    def score(self, texts: Sequence[str | None]) -> np.ndarray:
        """The greatest decision value of each text's sentences; a sentence seen before isn't evaluated again."""
        out = np.full(len(texts), NO_SENTENCE)
        for first in range(0, len(texts), 500):
            cut = [parts(t) for t in texts[first : first + 500]]
            if len(self.seen) > MEMO:
                self.seen.clear()
            if len(self.words) > MEMO:
                self.words.clear()
            new = {p: w for p in {p for d in cut for p in d} - self.seen.keys() if (w := tokens(p, self.words))}
            if new:
                self.seen.update(zip(new, self.decide(list(new.values())).tolist(), strict=True))
            out[first : first + 500] = [max((self.seen.get(p, NO_SENTENCE) for p in d), default=NO_SENTENCE) for d in cut]
        return out


def _landmark_words(docs: Sequence[list[list[str]]], y: np.ndarray) -> list[str]:
    seen, bad = Counter(), Counter()
    for d, label in zip(docs, y, strict=True):
        words = {w for s in d for w in s}
        seen.update(words)
        bad.update(words if label > 0 else ())
    base = max(1, (y > 0).sum()) / max(1, len(y))
    lift = {w: (bad[w] - seen[w] * base) / math.sqrt(seen[w] * base + 0.5) for w in seen}
    best = sorted(lift, key=lambda w: (-lift[w], w))[: WORD_LANDMARKS * 3 // 4]
    usual = [w for w, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0])) if w not in set(best)]
    return best + usual[: WORD_LANDMARKS - len(best)]


def _near(e: np.ndarray, others: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The weights around each vector: of every row of ``others`` nearer than ``REACH``, the more the nearer; one column for each of ``weights``."""
    out = np.zeros((len(e), weights.shape[1]))
    for at in range(0, len(e), 256):
        k = e[at : at + 256] @ others.T
        np.maximum((k - REACH) / (1 - REACH), 0, out=k)
        out[at : at + 256] = k**2 @ weights
    return out


@dataclass
class Sample:
    """The distinct sentences of labelled documents: words, vectors, numbers of offensive and harmless documents, and those only announcing a speaker."""

    rows: list[tuple[str, ...]]
    e: np.ndarray
    held: np.ndarray
    announced: np.ndarray
    bad: list[np.ndarray]  # the sentences of each offensive document


def _sample(space: WordSpace, docs: Sequence[list[tuple[list[str], bool]]], y: np.ndarray) -> Sample:
    index: dict[tuple[str, ...], int] = {}
    counts: list[list[float]] = []
    announced: set[int] = set()
    bad = []
    for d, label in zip(docs, y, strict=True):
        here = {index.setdefault(tuple(words), len(index)) for words, _ in d}
        announced.update(index[tuple(words)] for words, told in d if told)
        counts += [[0.0, 0.0] for _ in range(len(index) - len(counts))]
        for k in here:
            counts[k][int(label < 0)] += 1
        if label > 0 and here:
            bad.append(np.array(sorted(here)))
    rows = list(index)
    told = np.zeros(len(rows), bool)
    told[list(announced)] = True
    return Sample(rows, space.embed(rows), np.array(counts, np.float32), told, bad)


def _fit(space: WordSpace, s: Sample) -> Machine:
    rng = np.random.default_rng(SEED)
    harmless = s.held[:, 1]
    usual = (harmless >= 3) & (harmless > s.held[:, 0])
    asked = np.unique(np.concatenate(s.bad))
    asked = asked[~usual[asked] & ~s.announced[asked]]
    around = _near(s.e[asked], s.e, s.held)
    others, calm = around[:, 0] - 1, around[:, 1]  # without its own document
    share, lone = np.zeros(len(s.rows)), np.full(len(s.rows), np.inf)
    share[asked] = (others + PRIOR_WEIGHT * PRIOR) / (others + calm + PRIOR_WEIGHT)
    lone[asked] = calm
    sure = np.zeros(len(s.rows), bool)
    sure[asked] = (share[asked] >= 0.5) & (others >= LEAST)
    alone = [k[np.argmin(lone[k])] for k in s.bad if not sure[k].any() and lone[k].min() < LONE]
    plus = np.union1d(np.where(sure)[0], alone).astype(int)
    if not len(plus):  # nothing stands out: the sentence of each document that is farthest from harmless ones
        plus = np.unique([k[np.argmin(np.where(s.announced[k], np.inf, (s.e[k] @ s.e[harmless > 0].T).max(axis=1)))] for k in s.bad])
    quiet = np.where((harmless > 0) & ~sure)[0]
    quiet = quiet if len(quiet) else np.where(harmless > 0)[0]
    third = NEGATIVES // 3
    machine = None
    for _ in range(TURNS):
        often = quiet[np.argsort(-harmless[quiet], kind="stable")[:third]]
        chosen = np.union1d(often, quiet[rng.permutation(len(quiet))[:third]])
        if machine is not None:
            score = machine.values(s.e[quiet])
            high = quiet[score > 0]
            around = _near(s.e[high], s.e, s.held)
            errors = high[around[:, 0] > around[:, 1] - 1]  # among offensive sentences: an annotator's error
            hard = quiet[np.argsort(-score, kind="stable")[:third]]
            left = np.setdiff1d(np.union1d(chosen, hard), errors)
            if len(left):
                quiet, chosen = np.setdiff1d(quiet, errors), left
        some, at = SENTENCE_LANDMARKS // 4, rng.permutation(len(chosen))
        points = s.e[np.concatenate([plus[rng.permutation(len(plus))[: 2 * some]], np.union1d(np.intersect1d(often[:some], chosen), chosen[at[:some]])])]
        values, vectors = np.linalg.eigh(np.exp(WIDTH * (points @ points.T - 1)).astype(np.float64))
        root = vectors[:, values > 1e-4] / np.sqrt(values[values > 1e-4])
        machine = Machine(space, points, root, np.zeros(0))
        x = np.vstack([machine.features(s.e[plus]), machine.features(s.e[chosen])])
        labels = np.concatenate([np.ones(len(plus)), -np.ones(len(chosen))])
        weight = np.concatenate([np.full(len(plus), COST / 4 * math.sqrt(len(chosen) / len(plus))), COST / 4 * harmless[chosen] ** 0.8])
        machine.w = svm(x, labels, weight)
        every = np.unique(np.concatenate(s.bad))
        value = np.full(len(s.rows), NO_SENTENCE)
        value[every] = np.where(s.announced[every], NO_SENTENCE, machine.values(s.e[every]))
        found = np.array([k[np.argmax(value[k])] for k in s.bad])
        found = found[(value[found] > 0) & (share[found] >= 0.3)]
        plus = np.union1d(np.where(sure)[0], found).astype(int) if sure.any() or len(found) else plus
    return machine


def fit(texts: Sequence[str | None], labels: Sequence[int]) -> Machine | None:
    """The machine of labelled texts (1 offensive, 0 not); none without sentences of both kinds."""
    known: dict[str, str] = {}
    docs = [[(words, p.endswith(":")) for p in parts(t) if (words := tokens(p, known))] for t in texts]
    y = np.where(np.array(labels, int) > 0, 1, -1)
    if not any(any(not told for _, told in d) for d, label in zip(docs, y, strict=True) if label > 0) or not any(d for d, label in zip(docs, y, strict=True) if label < 0):
        return None
    space = WordSpace(_landmark_words([[words for words, _ in d] for d in docs], y))
    return _fit(space, _sample(space, docs, y))


def labelled(documents: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """At most ``max_docs`` documents with a majority label: ``doc_id, text, label``."""
    votes = labels.where("offensive is not null").groupBy("doc_id").agg(F.avg(F.col("offensive").cast("double")).alias("share")).where("share <> 0.5")
    kept = votes.orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id").limit(max_docs)
    return documents.select("doc_id", "text").join(kept, "doc_id").select("doc_id", "text", (F.col("share") > 0.5).cast("int").alias("label"))


_machines: dict[int, Machine] = {}


def scored(documents: DataFrame, labels: DataFrame, keep: Sequence[str] = ("doc_id",), max_docs: int = MAX_DOCS) -> DataFrame:
    """``keep`` columns, ``score`` and ``offensive`` (score at or above the machine's cut) of every document."""
    sample = sorted(labelled(documents, labels, max_docs).collect(), key=lambda r: r.doc_id)  # bounded by max_docs
    machine = fit([r.text for r in sample], [r.label for r in sample])
    shared = documents.sparkSession.sparkContext.broadcast(machine)  # bounded by the numbers of landmarks
    number = shared._jbroadcast.id()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if number not in _machines:
            _machines.clear()
            _machines[number] = shared.value
        m = _machines[number]
        for pdf in batches:
            score = m.score(list(pdf["text"])) if m is not None else np.full(len(pdf), NO_SENTENCE)
            yield pdf[list(keep)].assign(score=score, offensive=score >= (m.cut if m is not None else math.inf))

    rows = documents.select(*keep, *(["text"] if "text" not in keep else []))
    kinds = dict(rows.dtypes)
    return rows.mapInPandas(run, ", ".join([*(f"`{k}` {kinds[k]}" for k in keep), "score double, offensive boolean"]))


def rates(scores: DataFrame) -> DataFrame:
    """Documents, offensive documents and their rate for each source."""
    per = scores.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("offensive").cast("long")).alias("n_offensive"))
    return per.withColumn("rate", F.col("n_offensive") / F.col("n_docs"))
