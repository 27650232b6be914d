import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from pipewright.llm import bpe

from .helpers import ODD, docs_of

TOKENS = bpe.read_ranks(bpe.vocabulary_path())
CODEC = bpe.Codec(TOKENS)


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=CODEC.ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("abstmdrevl'' \n\t  　éß中9٣!#|.­\U0001F600！'"), max_size=40), max_size=5))
def test_as_tiktoken(texts):
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=CODEC.ranks, special_tokens={})
    ids, at = CODEC.encode(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [reference.encode_ordinary(t) for t in texts]
    assert CODEC.decode(ids, at) == [t.encode() for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="abcdeé", min_size=1, max_size=120))
def test_both_folds_agree(word):
    raw = word.encode()
    assert bpe._fold_long(raw, CODEC.ranks) == bpe._fold_short(raw, CODEC.ranks)


def test_digests_and_odd_rows(spark, reference):
    got = sorted((tuple(r) for r in bpe.digests(docs_of(spark, ODD)).collect()), key=str)
    want = []
    for i, text in ODD:
        ids = reference.encode_ordinary(text or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)


def test_encode_then_decode(spark):
    encoded = bpe.encode(docs_of(spark, ODD))
    got = {(r.id, bytes(r.raw)) for r in encoded.withColumn("raw", bpe.decode(encoded)).collect()}
    assert got == {(i, (t or "").encode()) for i, t in ODD}


def test_empty_table(spark):
    assert bpe.digests(docs_of(spark, [])).collect() == []


def test_ranks_without_gaps(tmp_path):
    path = tmp_path / "ranks"
    path.write_bytes(b"YQ== 0\nYg== 2\n")
    with pytest.raises(ValueError):
        bpe.read_ranks(str(path))
    assert np.array_equal(bpe._classes()[[32, 65, 48, 33, 0xE000, 0x1F600]], [0, 1, 2, 3, 3, 3])
