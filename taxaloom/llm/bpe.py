"""Encoding of a corpus with a public byte-level BPE by prefix dynamic programming.

A text is cut into pieces by the tokenizer's pattern (built-in regular expressions). For each prefix of a piece's bytes
there is exactly one last token with which an encoding by merges can end; it is the token whose predecessor, the last
token of the shorter prefix, it may stand beside: the two stay apart when their joined bytes are encoded. Storing these
last tokens gives the encoding by walking back, allows to append bytes exactly, and to encode anew only near an edit.

Defined cases: null and empty texts have the ids ``[]``; repeated texts are encoded alike; special tokens in a text are
ordinary text; texts of any length are encoded whole.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the pattern that cuts texts into pieces, as published with the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
MEMO = 400_000


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks, which are the ids, of a vocabulary file."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class PrefixEncoder:
    """Encodes pieces; remembers the pieces and pairs it has seen."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.token = {r: t for t, r in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self.beside: dict[tuple[int, int], bool] = {}
        self.whole: dict[bytes, bool] = {}
        self.memo: dict[str, list[int]] = {}

    def merged(self, data: bytes) -> list[bytes]:
        """Encoding of a few bytes by merges, lowest rank first."""
        parts = [data[k : k + 1] for k in range(len(data))]
        while len(parts) > 1:
            ranked = [(self.ranks.get(a + b), k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False))]
            rank, at = min((x for x in ranked if x[0] is not None), default=(None, 0))
            if rank is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def stands(self, token: bytes) -> bool:
        """Whether merges ever make this token."""
        if (known := self.whole.get(token)) is None:
            known = self.whole[token] = token in self.ranks and self.merged(token) == [token]
        return known

    def fits(self, left: int, right: int) -> bool:
        """Whether the two tokens stay apart when their bytes are encoded together."""
        if (known := self.beside.get((left, right))) is None:
            a, b = self.token[left], self.token[right]
            known = self.beside[left, right] = self.merged(a + b) == [a, b]
        return known

    def extend(self, data: bytes, last: list[int]) -> list[int]:
        """The last token of each prefix of ``data``, of which ``last`` already holds those of the shorter prefixes."""
        last = list(last)
        for end in range(len(last) + 1, len(data) + 1):
            for start in range(max(0, end - self.longest), end):
                token = data[start:end]
                if self.stands(token) and (start == 0 or self.fits(last[start - 1], self.ranks[token])):
                    last.append(self.ranks[token])
                    break
            else:
                raise ValueError("a byte is missing in the vocabulary")
        return last

    def walk(self, last: list[int]) -> list[int]:
        """The encoding of the longest prefix in ``last``."""
        out, end = [], len(last)
        while end:
            out.append(last[end - 1])
            end -= len(self.token[last[end - 1]])
        return out[::-1]

    def piece(self, text: str) -> list[int]:
        """Encoding of one piece."""
        if (ids := self.memo.get(text)) is None:
            data = text.encode()
            ids = [self.ranks[data]] if self.stands(data) else self.walk(self.extend(data, []))
            if len(self.memo) < MEMO:
                self.memo[text] = ids
        return ids

    def edited(self, old: bytes, last: list[int], new: bytes) -> list[int]:
        """``last`` for ``new``, keeping what it shares with ``old`` before the first edit."""
        same = next((k for k, (a, b) in enumerate(zip(old, new, strict=False)) if a != b), min(len(old), len(new)))
        return self.extend(new, last[:same])


_encoders: dict[int, PrefixEncoder] = {}


def _encoder(shared) -> PrefixEncoder:  # noqa: ANN001
    if shared.id not in _encoders:
        _encoders.clear()
        _encoders[shared.id] = PrefixEncoder(shared.value)
    return _encoders[shared.id]


class _Shared:
    """A broadcast vocabulary with an id, so that a worker makes one encoder for all its batches."""

    def __init__(self, broadcast) -> None:  # noqa: ANN001
        self.broadcast, self.id = broadcast, broadcast._jbroadcast.id()

    def __getstate__(self) -> dict:
        return {"broadcast": self.broadcast, "id": self.id}

    @property
    def value(self) -> dict[bytes, int]:
        return self.broadcast.value


def _encode(shared: _Shared, kept: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared)
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("_pieces"))
            coded = lists.flatten().dictionary_encode()
            each = [encoder.piece(p) for p in coded.dictionary.to_pylist()]
            sizes = np.fromiter(map(len, each), np.int64, len(each))
            flat = np.fromiter((x for ids in each for x in ids), np.int32, int(sizes.sum()))
            begins = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(each) else np.zeros(0, np.int64)
            which = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            n = sizes[which] if len(which) else np.zeros(0, np.int64)
            upto = np.concatenate([[0], np.cumsum(n)])
            place = np.arange(upto[-1]) - np.repeat(upto[:-1], n) + np.repeat(begins[which] if len(which) else n, n)
            pieces = lists.value_lengths().to_numpy(zero_copy_only=False)
            offsets = upto[np.concatenate([[0], np.cumsum(pieces)]).astype(np.int64)]
            ids = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat[place], pa.int32()))
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(k)) for k in kept), ids], names=[*kept, "ids"])

    return run


def encoded(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), vocabulary: str = VOCABULARY) -> DataFrame:
    """``keep`` columns and ``ids``, the token ids of ``text``; no shuffle."""
    shared = _Shared(df.sparkSession.sparkContext.broadcast(read_ranks(vocabulary)))  # its size is that of the vocabulary file
    pieces = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(f"(?U){PATTERN}"), F.lit(0)).alias("_pieces")
    rows = df.select(*keep, pieces)
    kinds = dict(rows.dtypes)
    return rows.mapInArrow(_encode(shared, list(keep)), ", ".join([*(f"`{k}` {kinds[k]}" for k in keep), "ids array<int>"]))
