"""Byte-level BPE against the tiktoken library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from fusekit.llm import byte_bpe, queries

from .test_operators import DOCS, SF, docs, edge_texts

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def coder():
    return byte_bpe.ByteBpe(byte_bpe.read_ranks(RANKS), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})


def long_words():
    rng = random.Random(3)
    return ["ー" * 500, "xyz" + "ー" * 3001, "a" * 5000, "ab" * 3000, "abc" * 700, "=" * 500 + "-" * 333, "ñ" * 301, " " * 300 + "x", "\n" * 400 + " \n x",
            "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(20000)), "".join(rng.choice("aab") for _ in range(3000)),
            "".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(1500)), "你好世界" * 200, "0123456789" * 150, "💡" * 400]


@pytest.mark.parametrize("text", long_words())
def test_long_words(coder, library, text):
    ids = coder.encode(pa.array([text.encode()]))
    assert ids.to_pylist() == [library.encode_ordinary(text)]
    assert coder.decode(ids).to_pylist() == [text.encode()]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab' \n\t\x1c\x85　éß中💡1².,sS'<|>")), max_size=4))
def test_any_text(coder, library, texts):
    ids = coder.encode(pa.array([t.encode() for t in texts], pa.binary()))
    assert ids.to_pylist() == [library.encode_ordinary(t) for t in texts]
    assert coder.decode(ids).to_pylist() == [t.encode() for t in texts]


def test_a_full_memo_changes_nothing(library):
    small = byte_bpe.ByteBpe(byte_bpe.read_ranks(RANKS), public_tokenizers.PATTERN, memo_words=3)
    texts = [f"one two w{i % 7} three w{i % 5}. \n four" for i in range(40)]
    for _ in range(2):
        ids = small.encode(pa.array([t.encode() for t in texts], pa.binary()))
        assert ids.to_pylist() == [library.encode_ordinary(t) for t in texts]
        assert small.decode(ids).to_pylist() == [t.encode() for t in texts]


def test_new_stretches_are_cut_into_words_together(library):
    """The pattern is asked once for all new stretches, not stretch by stretch."""
    own = byte_bpe.ByteBpe(byte_bpe.read_ranks(RANKS), public_tokenizers.PATTERN)
    findall, asked = own.words, []
    own.words = lambda text: asked.append(text) or findall(text)
    texts = ["It's a new (line)\nhere, 3x4 " + f"w{i}ord. l'été\u0085 end" for i in range(50)] + ["", " a", "two  spaces", "x\x1c y\u3000 z"]
    for part in (texts, ["", ""], texts[::-1]):
        ids = own.encode(pa.array([t.encode() for t in part], pa.binary()))
        assert ids.to_pylist() == [library.encode_ordinary(t) for t in part]
    assert len(asked) <= 2 * len(texts) + 5  # each text's head, and each call's new stretches


def test_words_come_back_in_order(coder, library, monkeypatch):
    """Words of several queries, with tokens and long words between them."""
    monkeypatch.setattr(byte_bpe, "QUERY_BYTES", 40)
    words = [f"w{i}ordqx" for i in range(30)] + ["the", "a", "z" * 400, "ñq" * 90] + [f"zq{i}jk" for i in range(30)]
    assert [np.frombuffer(x, np.int32).tolist() for x in coder.encode_words([w.encode() for w in words])] == [library._encode_single_piece(w) for w in words]


def test_unknown_ids_fail(coder):
    for wrong in (-1, 60_000):
        with pytest.raises(ValueError):
            coder.decode(pa.array([[5, wrong]]))


def want(library, text):
    ids = library.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_query_equals_the_library(spark, library):
    got = {r.doc_id: tuple(r)[1:] for r in queries.op11_byte_bpe(spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert got == {r.doc_id: want(library, r.text) for r in rows}


def test_edge_rows(spark, library):
    texts = edge_texts()
    df = docs(spark, texts).withColumn("ids", F.lit("x"))
    df = df.unionByName(df.filter("doc_id = 3")).unionByName(df.filter("doc_id = 5").withColumn("doc_id", F.lit(None).cast("long")))
    out = byte_bpe.digests(byte_bpe.decode(byte_bpe.encode(df, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN))
    got = sorted([tuple(r) for r in out.collect()], key=str)
    rows = list(enumerate(texts)) + [(3, texts[3]), (None, texts[5])]
    assert got == sorted([(i, *want(library, t)) for i, t in rows], key=str)
    both = byte_bpe.digests(byte_bpe.round_trip(df, RANKS, public_tokenizers.PATTERN))
    assert got == sorted([tuple(r) for r in both.collect()], key=str)
    empty = spark.createDataFrame([], DOCS)
    assert byte_bpe.decode(byte_bpe.encode(empty, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN).count() == 0
    nulls = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [bytes(r.decoded) for r in byte_bpe.decode(nulls, RANKS, public_tokenizers.PATTERN).collect()] == [b"", b""]
