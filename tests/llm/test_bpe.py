import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from taxaloom.llm import bpe

pytestmark = pytest.mark.skipif(not os.path.exists(bpe.VOCABULARY), reason="the vocabulary is absent")
LIBRARY = "/opt/tokenizers/byte_bpe_50k.json"


@pytest.fixture(scope="module")
def public():
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(LIBRARY)
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def encoder():
    return bpe.PrefixEncoder(bpe.read_ranks(bpe.VOCABULARY))


TEXTS = ["", None, " ", "\n\n  x\t", "don't we'll I'M", "Straße Ñandú 日本語 ｱ 🙂👩‍👩‍👧 \xa0　x", "a" * 3000, "<|endoftext|> x", "1234567 1,000.50", "x" + " " * 50 + "y", "naïvé é", "﻿​zero", "=" * 200]


def test_documents(spark, public):
    rows = [(k, t) for k, t in enumerate(TEXTS)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' ids", "'y' _pieces")
    got = bpe.encoded(df).collect()
    assert len(got) == len(rows) and all(r.ids == (public(TEXTS[r.doc_id]) if TEXTS[r.doc_id] else []) for r in got)
    assert bpe.encoded(df.limit(0)).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abcdeghinorst ehistoric the 'ing  éñß日🙂0129.,-")), max_size=40))
def test_pieces_by_prefixes_equal_merges(text):
    encoder = _cached()
    data = text.encode()
    assert [encoder.token[t] for t in encoder.walk(encoder.extend(data, []))] == encoder.merged(data)


_made = []


def _cached():
    if not _made:
        _made.append(bpe.PrefixEncoder(bpe.read_ranks(bpe.VOCABULARY)))
    return _made[0]


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=25), st.binary(max_size=25), st.binary(max_size=25))
def test_appends_and_edits_are_exact(a, b, c):
    encoder = _cached()
    last = encoder.extend(a, [])
    assert encoder.extend(a + b, last) == encoder.extend(a + b, [])
    assert encoder.edited(a + b, encoder.extend(a + b, []), a + c + b) == encoder.extend(a + c + b, [])
