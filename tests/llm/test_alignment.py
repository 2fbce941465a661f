"""Cross-tokenizer alignment against a plain version of the rule."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from fusekit.llm import alignment, queries

from .test_operators import DOCS, SF, docs, edge_texts

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def library():
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    byte = alignment._letters()
    vocab = {i: bytes(byte[c] for c in t) for t, i in a.get_vocab(with_added_tokens=False).items()}
    b = sentencepiece.SentencePieceProcessor(model_file=B_PATH)

    def groups(text):
        """[(A ids, B ids)] of a text, by the definition."""
        if not text:
            return []
        a_ids, b_ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        a_bytes = [vocab.get(i, b"") for i in a_ids]
        b_bytes = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in b_ids]
        if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            return []
        a_ends, b_ends = np.cumsum([len(x) for x in a_bytes]), np.cumsum([len(x) for x in b_bytes])
        out, i, j = [], 0, 0
        for end in np.intersect1d(a_ends, b_ends):
            p, q = int(np.searchsorted(a_ends, end)) + 1, int(np.searchsorted(b_ends, end)) + 1
            out.append((a_ids[i:p], b_ids[j:q]))
            i, j = p, q
        return out

    return groups


def brute(groups_of, rows):
    held = [(doc, groups_of(text)) for doc, text in rows]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for _, g in held]
    count = Counter(pair for c in links for pair in c)
    most = defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    out = []
    for (doc, g), c in zip(held, links):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out.append((doc, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(c.values()),
                    sum(n for p, n in c.items() if count[p] == most[p[0]]), sum(n * count[p] for p, n in c.items()),
                    hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return sorted(out, key=str)


def got(df):
    return sorted([tuple(r) for r in df.select(*COLUMNS).collect()], key=str)


def stats(df):
    return alignment.link_statistics(df, A_PATH, B_PATH)


def odd_texts():
    rng = random.Random(2)
    return edge_texts() + ["<|endoftext|> </s><s>[INST] x", "▁a b", " a", "a ", "a  b\tc\n\nd \n e", "日本語のテキスト。" * 30, "💡" * 50, "ﬁ ½ Å Å", "　x y z",
                           "".join(rng.choice("abcdefghij") for _ in range(3000)), "ー" * 999, "=" * 2000, "\r\n a\r\nb", "x" * 40_000]


def test_odd_texts(spark, library):
    texts = odd_texts()
    df = docs(spark, texts)
    more = df.unionByName(df.filter("doc_id in (5, 9)")).unionByName(df.filter("doc_id = 9").selectExpr("CAST(NULL AS LONG) doc_id", *[c for c in df.columns if c != "doc_id"]))
    more = more.selectExpr("*", "1 AS pair", "2 AS n_a", "3 AS links")
    rows = list(enumerate(texts)) + [(5, texts[5]), (9, texts[9]), (None, texts[9])]
    assert got(stats(more)) == brute(library, rows)
    assert got(stats(more.repartition(3))) == brute(library, rows)


def test_long_groups_and_small_slices(spark, library, monkeypatch):
    """Links of long groups by distinct ids, documents of many slices."""
    texts = odd_texts() + [f"Some words {i} over, and.\nmore {i % 3}" for i in range(40)]
    monkeypatch.setattr(alignment, "LINK_ROWS", 256)
    tokens = alignment.Tokens(A_PATH, B_PATH, memo_stretches=3)
    for lo in range(0, len(texts), 7):
        part = alignment.Slice(tokens, pa.array(texts[lo:lo + 7], pa.string()))
        seen = defaultdict(Counter)
        for d, a, b, n in part.links():
            for x in zip(d.tolist(), a.tolist(), b.tolist(), n.tolist()):
                seen[x[0]][x[1:3]] += x[3]
        for d, t in enumerate(texts[lo:lo + 7]):
            assert seen[d] == Counter((x, y) for a, b in library(t) for x in a for y in b)
        doc, place, times, pairs = alignment._linked(part)
        assert {(d, p >> 32, p & 0xFFFFFFFF): n for d, p, n in zip(doc.tolist(), pairs[place].tolist(), times.tolist())} == {(d, *k): n for d, c in seen.items() for k, n in c.items()}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(1, 4)), st.lists(st.integers(1, 4))), max_size=6))
def test_lockstep_equals_intersection(rows):
    a_ends, b_ends = [], []
    for a, b in rows:
        a, b = (np.cumsum(a), np.cumsum(b)) if a and b else ([], [])
        if len(a):
            end = max(a[-1], b[-1])
            a, b = (x if x[-1] == end else np.append(x, end) for x in (a, b))
        a_ends.append(np.array(a, np.int64))
        b_ends.append(np.array(b, np.int64))
    flat = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a_ends, b_ends)]
    doc, left, right = alignment.lockstep(flat[0], np.cumsum([0] + [len(x) for x in a_ends]), flat[1], np.cumsum([0] + [len(x) for x in b_ends]))
    want = [(d, int(np.searchsorted(a, e)) + 1, int(np.searchsorted(b, e)) + 1) for d, (a, b) in enumerate(zip(a_ends, b_ends)) for e in np.intersect1d(a, b)]
    assert list(zip(doc.tolist(), left.tolist(), right.tolist())) == want


def test_align_returns_the_groups(spark, library):
    texts = odd_texts()
    for r in alignment.align(docs(spark, texts), A_PATH, B_PATH).collect():
        ends = list(zip([0] + r.a_cuts, [0] + r.b_cuts, r.a_cuts, r.b_cuts))
        assert [(r.a_ids[i:p], r.b_ids[j:q]) for i, j, p, q in ends] == library(texts[r.doc_id])


def test_empty_table(spark):
    assert got(stats(spark.createDataFrame([], DOCS))) == []


def test_query_equals_brute_force(spark, library):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert got(queries.op12_token_alignment(spark, SF)) == brute(library, rows)


def test_spelling_is_checked_text_by_text():
    """Bytes that are the same only put together do not count, and an id that
    spells nothing stands nowhere."""
    from fusekit.llm.alignment import _spell
    spelt = [b"a", b"b", b"ab", b""]
    length = np.array([1, 1, 2, 0])
    assert _spell([[0, 1], [], [2, 3]], spelt, length, [b"ab", b"", b"ab"])
    assert not _spell([[0], [1, 2]], spelt, length, [b"ab", b"ab"])
    assert not _spell([[0, 1], [3]], spelt, length, [b"ab", b"a"])
    assert not _spell([[1, 0]], spelt, length, [b"ab"])


def test_a_long_document_is_merged_in_parts(library, monkeypatch):
    """No part of the lockstep merge is as long as a document of many words,
    so that its steps do not grow with the longest document."""
    seen, plain = [], alignment.lockstep

    def recorded(a_ends, a_at, b_ends, b_at):
        seen.append(max(np.diff(a_at).max(), np.diff(b_at).max()))
        return plain(a_ends, a_at, b_ends, b_at)

    monkeypatch.setattr(alignment, "lockstep", recorded)
    tokens = alignment.Tokens(A_PATH, B_PATH)
    texts = ["", " ".join(f"word{i % 50}ing, über" for i in range(3000)), None, "a", " ".join("ab" for _ in range(64)), " ".join("½" for _ in range(130)), " ".join("c" for _ in range(65))]
    part = alignment.Slice(tokens, pa.array(texts, pa.string()))
    assert seen[0] <= 10 * alignment.PART_STRETCHES
    for d, t in enumerate(texts):
        a_cut, b_cut = (cuts[part.doc == d] for cuts in part.cuts())
        cuts = list(zip([0, *a_cut], [0, *b_cut], a_cut, b_cut))
        a, b = part.a[part.a_at[d]:part.a_at[d + 1]].tolist(), part.b[part.b_at[d]:part.b_at[d + 1]].tolist()
        assert [(a[i:p], b[j:q]) for i, j, p, q in cuts] == library(t)


def test_stretches_read_as_one_text_are_told_apart():
    """One stretch whose A bytes differ takes no other's tokens along."""
    tokens = alignment.Tokens(A_PATH, B_PATH)
    texts = [f"w{i}x" for i in range(150)] + ["zebra"] + [f"ü{i}, y." for i in range(150)]
    apart = tokens._both(texts)
    assert tokens._both(texts, alignment.JOINED) == apart and alignment.DIFFERS not in apart
    wrong = tokens.a.encode(" zebra", add_special_tokens=False).ids[0]
    tokens.a_spelt[wrong] = b"?" * len(tokens.a_spelt[wrong])
    assert tokens._both(texts, alignment.JOINED) == [alignment.DIFFERS if t == "zebra" else x for t, x in zip(texts, apart)]


def test_decimal_numbers():
    numbers = [0, 9, 10, 99, 100, 7, 49_999, 50_000, 99_999]
    for some in (numbers, numbers[:1], numbers[:3], []):
        text, begins = alignment._decimal(np.array(some, np.int64), np.full(len(some), ord(","), np.uint8))
        assert text.decode() == "".join(f"{n}," for n in some)
        assert [int(text[x:y - 1]) for x, y in zip(begins, begins[1:])] == some
