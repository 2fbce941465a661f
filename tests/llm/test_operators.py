"""The training-data operators against brute force, round trips and edge rows."""

import functools
import hashlib
import os
import random
import textwrap
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from fusekit.llm import (chat_format, components, decontaminate, language_id, licenses, line_dedup, packing,
                         quality_rules, simhash_trie, token_counts, url_filter)
from fusekit.llm.memo import Memo

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, rows string, chunk long"


def docs(spark, texts, lang="en", source="s"):
    """Documents with columns whose names operators use themselves."""
    rows = [(i, t, lang, source, len(t or ""), "r", 5) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def edge_texts():
    return ["", None, " \t\n", "x", "\n\n", "Zażółć 💡 gęślą \x00 jaźń", "word " * 30000, "a b c\n" * 500, "same line of text\nend", " Same LINE of text \nother", "same line of text\nend"]


# ------------------------------------------------------------- SimHash
def brute_components(fps):
    n = len(fps)
    label = list(range(n))
    changed = True
    while changed:
        changed = False
        for i in range(n):
            for j in np.flatnonzero(np.bitwise_count(fps[i] ^ fps) <= 3):
                if label[j] != label[i]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    return label


@pytest.mark.parametrize("node_rows", [None, 4])
def test_trie_links_equal_brute_force(spark, node_rows):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**64, 12, dtype=np.uint64)
    near = [int(b) ^ sum(1 << int(k) for k in rng.choice(64, rng.integers(0, 5), replace=False)) for b in base for _ in range(9)]
    # a crowd under one prefix, and a chain of links
    crowd = [0xABCD << 48 | int(x) for x in rng.integers(0, 2**14, 60)]
    chain = [(1 << 3 * i) - 1 for i in range(1, 12)]
    fps = np.array(sorted(set(near + crowd + chain + [0, 1, 2**64 - 1])), np.uint64)
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    links = simhash_trie.trie_links(df, 3, node_rows)
    root = {r.node: r.root for r in components.connected_components(links).collect()}
    want = brute_components(fps)
    got = [root.get(int(x), int(x)) for x in fps.view(np.int64)]
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_link_walks_every_near_pair():
    rng = np.random.default_rng(1)
    fps = np.unique(np.concatenate([rng.integers(0, 2**64, 300, dtype=np.uint64), np.uint64(7) << rng.integers(0, 60, 200, dtype=np.uint64)]))
    got = simhash_trie.link(fps, [(0, len(fps), 0, len(fps), 0)], 0, 3)
    want = brute_components(fps)
    assert len(set(zip(got.tolist(), want))) == len(set(got.tolist())) == len(set(want))


def test_simhash_edge_rows(spark):
    texts = edge_texts() + ["one two three four"] * 3
    rows = simhash_trie.simhash_groups(docs(spark, texts)).select("doc_id", simhash_trie.fingerprint_hex().alias("f"), "component_id").collect()
    got = {r.doc_id: r for r in rows}
    assert len(rows) == len(texts) and all(got[i].f == "0" * 16 for i in (0, 1, 2, 4))
    fps = simhash_trie.fingerprints([(t or "").encode() for t in texts])
    assert all(got[i].f == f"{int(x):016x}" for i, x in enumerate(fps))
    assert [got[i].component_id for i in range(len(texts))] == brute_components(fps)
    assert simhash_trie.simhash_groups(docs(spark, [])).count() == 0


# ------------------------------------------------------------- lines
def test_line_dedup_equals_reference(spark, monkeypatch):
    rng = random.Random(3)
    lines = [f"Common line number {i}" for i in range(8)] + ["short", "", "  Common LINE number 1\t", "ééééééééé", "éééééééééé"]
    texts = ["\n".join(rng.choice(lines) for _ in range(rng.randint(0, 9))) for _ in range(60)] + edge_texts()
    monkeypatch.setattr(line_dedup, "CHUNK_BYTES", 300)
    monkeypatch.setattr(line_dedup, "SHARD_BYTES", 1000)
    got = line_dedup.line_dedup(docs(spark, texts))
    assert got.columns[:7] == docs(spark, []).columns
    rows = {r.doc_id: (r.doc_id, r.n_lines, r.n_dropped, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in got.collect()}
    assert rows == {r[0]: r for r in line_dedup.reference_line_dedup(list(enumerate(texts)))}
    assert line_dedup.line_dedup(docs(spark, [])).count() == 0


def test_line_dedup_repeated_and_null_ids(spark):
    line = "a line that is long enough"
    df = spark.createDataFrame([(1, line), (1, line), (None, line), (2, line + "\nx")], "doc_id long, text string")
    assert sorted(((r.doc_id or -1), r.kept_text) for r in line_dedup.line_dedup(df).collect()) == [(-1, ""), (1, line), (1, line), (2, "x")]


# ------------------------------------------------------------- quality
def brute_quality(text):
    import re
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    wins = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    covered = {i + k for i, w in enumerate(wins) if wins.count(w) > 1 for k in range(8)} if len(wins) < 3000 else None
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), covered if covered is None else len(covered)


def test_quality_counts_equal_brute_force(spark):
    rng = random.Random(1)
    texts = [" ".join(rng.choice("ab") + rng.choice(["", "#", "|é"]) for _ in range(rng.randint(0, 60))) for _ in range(40)] + edge_texts()
    rows = quality_rules.with_counts(docs(spark, texts)).collect()
    for r in rows:
        want = brute_quality(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines) == want[:4]
        if want[4] is not None:
            assert r.n_repeat_words == want[4], r.doc_id
    long = next(r for r in rows if r.doc_id == 40 + 6)
    assert long.n_repeat_words == 30000


def test_quality_rejects_bad_hosts_only(spark):
    good = " ".join(f"word{i}" for i in range(40))
    rows = [(i, good, "bad" if i < 30 else "good") for i in range(60)] + [(100 + i, "few words", "bad") for i in range(200)] + [(900, "few", None), (901, good, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r.doc_id for r in quality_rules.quality_verdicts(df).filter("kept").collect()}
    assert kept == {*range(30, 60), 901}
    assert {r.doc_id for r in quality_rules.filter_documents(df).collect()} == kept
    assert quality_rules.filter_documents(df.limit(0)).columns == df.columns and quality_rules.quality_verdicts(df.limit(0)).count() == 0


def test_quality_sql_on_hosts_that_pass_and_fail_each_rule(spark):
    import duckdb
    rng = random.Random(7)
    good = lambda: " ".join(f"word{rng.randrange(10**6)}" for _ in range(30))
    bad = {"base": lambda: "short", "symbols": lambda: good() + " " + "#" * 40, "lines": lambda: "\n".join([good()] * 2 + ["a b"] * 9),
           "words": lambda: " ".join("a" for _ in range(9)) + " " + " ".join(rng.choice("bcdefgh") for _ in range(30))}
    rows = []
    for kind, make in bad.items():
        for share in (0.45, 0.6, 0.9, 1.0):
            rows += [(len(rows) + i, make() if i < 120 * share else good(), "en", f"{kind}{share}", 0, "r", 5) for i in range(120)]
    rows += [(len(rows) + i, good(), "en", f"s{i % 30}", 0, "r", 5) for i in range(900)] + [(9999, good(), "en", None, 0, "r", 5)]
    documents = spark.createDataFrame(rows, DOCS).toPandas()  # noqa: F841 (DuckDB reads it)
    want = {(r[0], r[1]) for r in duckdb.sql(f"SELECT doc_id, kept FROM ({quality_rules.ORACLE})").fetchall()}
    got = {(r.doc_id, r.kept) for r in quality_rules.quality_verdicts(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == want and len(got) == len(rows)
    kept = {i for i, k in got if k}
    hosts = {r[3] for r in rows if r[0] in kept}
    assert {"base0.45", "base0.6", "symbols0.6", "lines0.6", "words0.6"} <= hosts and not {"symbols1.0", "lines1.0", "words1.0", "base1.0"} & hosts


# ------------------------------------------------------------- leaks
def edit_find(pattern, text):
    """Least edits of ``pattern`` over all substrings of ``text``."""
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for ch in text:
        new = [0]
        for i, p in enumerate(pattern, 1):
            new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (p != ch)))
        row, best = new, min(best, new[-1])
    return best


def test_matcher_equals_brute_force():
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abc") for _ in range(rng.randint(1, 5)))
    items = [(i, " ".join(word() for _ in range(rng.randint(8, 20)))) for i in range(12)]
    matcher = decontaminate.Matcher(items, rate=0.1)
    for _ in range(60):
        _, text = rng.choice(items)
        chars = list(text)
        for _ in range(rng.randint(0, 8)):
            k = rng.randrange(len(chars))
            chars[k] = rng.choice(["", "a", "bb", chars[k]])
        whole = decontaminate.normalise(" ".join(word() for _ in range(10)) + " " + "".join(chars) + " " + word())
        found = {i: (e, a, b) for i, e, a, b in matcher.find(whole)}
        for i, t in items:
            t = decontaminate.normalise(t)
            edits = edit_find(t, whole)
            assert (i in found) == (edits <= int(len(t) * 0.1)), (i, edits)
            if i in found:
                assert found[i][0] == edits


def brute_leaks(items, text, rate=0.1, min_chars=20):
    """{item id: (edits, end)} of the best, then first, occurrences."""
    text, out = decontaminate.normalise(text), {}
    for i, t in items:
        t = decontaminate.normalise(t)
        row, best = list(range(len(t) + 1)), None
        for j, ch in enumerate(text):
            new = [0]
            for k, p in enumerate(t, 1):
                new.append(min(row[k] + 1, new[-1] + 1, row[k - 1] + (p != ch)))
            row = new
            if row[-1] <= int(len(t) * rate) and (best is None or row[-1] < best[0]):
                best = (row[-1], j + 1)
        if best and len(t) >= min_chars:
            out[i] = best
    return out


def test_repetitive_items_equal_brute_force():
    rng = random.Random(8)
    items = [(0, "ab " * 20), (1, "-" * 40), (2, "abc" * 12), (3, "a" * 25 + "b" * 25)]
    matcher = decontaminate.Matcher(items)
    for _ in range(80):
        unit, n = rng.choice(["ab ", "-", "abc", "a", "b", "-|", "ab"]), rng.randint(1, 60)
        text = "".join(rng.choice("ab-c") if rng.random() < 0.06 else c for c in unit * n + rng.choice(["", "b" * 30, "zz " + "ab " * 21]))
        found = matcher.find(text)
        assert {i: (e, b) for i, e, a, b in found} == brute_leaks(items, text), text
        for i, e, a, b in found:
            assert edit_find(decontaminate.normalise(items[i][1]), decontaminate.normalise(text)[a:b]) == e


def test_long_repetitive_texts_take_seconds():
    import time
    items = [(0, "ab " * 200), (1, "-" * 200), (2, "la " * 150 + "end")]
    matcher = decontaminate.Matcher(items)
    begin = time.time()
    for text in ("ab " * 43_000, "ab x" * 32_000, "-" * 128_000, ("-" * 9 + "|") * 12_800, "la " * 43_000, "la la lo " * 14_000):
        matcher.find(text)
    assert time.time() - begin < 60


def test_short_items_are_found_unchanged_between_word_ends(spark):
    bench = spark.createDataFrame([(1, "Pi is 3.14"), (2, "cat"), (3, " "), (4, "¿?")], "item_id long, text string")
    texts = ["So pi  IS 3.14, he said", "pi is 3.141", "concatenate", "a cat.", "pi ls 3.14", "what ¿? x"]
    got = sorted((r.doc_id, r.item_id, r.edits, r.start, r.end) for r in decontaminate.find_leaks(docs(spark, texts), bench, short_items=True).collect())
    assert decontaminate.find_leaks(docs(spark, texts), bench).count() == 0
    assert got == [(0, 1, 0, 3, 13), (3, 2, 0, 2, 5), (5, 4, 0, 5, 7)]


def test_leaks_edge_rows(spark):
    item = "The quick brown fox jumps over the lazy dog near the river"
    bench = spark.createDataFrame([(1, item), (2, item), (3, None), (4, ""), (5, "the")], "item_id long, text string")
    texts = edge_texts() + ["x " * 5000 + item.upper().replace(" ", "\n  ") + " y", item.replace("quick", "quack")]
    got = {(r.doc_id, r.item_id, r.edits) for r in decontaminate.find_leaks(docs(spark, texts), bench).collect()}
    n = len(edge_texts())
    assert got == {(n, 1, 0), (n, 2, 0), (n + 1, 1, 1), (n + 1, 2, 1)}
    kept = decontaminate.drop_contaminated(docs(spark, texts), bench)
    assert kept.columns == docs(spark, []).columns and sorted(r.doc_id for r in kept.collect()) == list(range(n))
    assert decontaminate.find_leaks(docs(spark, texts), bench.limit(0)).count() == 0 == decontaminate.find_leaks(docs(spark, []), bench).count()


# ------------------------------------------------------------- tokens
TRICKY = ["", "<s> </s>", "a  b", " a", "a ", "a\nb", "a\n\nb ", "\n", "a \nb", "\ta\tb", "é́ é", "▁x ▁", "don't I'LL it's", "<|endoftext|> x<|startoftext|>y", "x y z",
          "İı ǅ ſ ß ẞ Σας ΟΔΟΣ", "日本語 テスト", "💡💡 1234 ½ ²", "__a_b__ a-b.c", "ŉ ĳ ŀ × ÷", "\x1c\x1f a\x85b", "Zażółć GĘŚLĄ jaźń!!"]


def test_word_tokenizer_equals_library(spark):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    lib, own = Tokenizer.from_file(path), packing.WordTokenizer(path, memo_words=7)
    texts = TRICKY + [r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    for t in texts:
        assert np.frombuffer(own.encode(t.encode()), "<u4").tolist() == lib.encode(t, add_special_tokens=False).ids, t[:60]


def test_piece_counter_equals_library(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    counter = token_counts.PieceCounter(path, memo_words=7)
    texts = TRICKY + [r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    for t in texts:
        assert counter.count(t.encode()) == len(counter.model.encode(t)), t[:60]


def test_digest_cache_encodes_misses_once(spark, tmp_dir):
    path, cache = public_tokenizers.path("piece_bpe_32k.model"), os.path.join(tmp_dir, "cache")
    texts = edge_texts()
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.count_tokens(docs(spark, texts), path, cache).collect()}
    model = token_counts.PieceCounter(path).model
    assert got == {i: (len((t or "").encode()), len(model.encode(t or "")), len(model.encode(t or "")) > 4096) for i, t in enumerate(texts)}
    distinct = len({t or "" for t in texts})
    assert token_counts.read_cache(spark, cache).count() == distinct
    token_counts.count_tokens(docs(spark, texts + ["new"]), path, cache)
    assert token_counts.read_cache(spark, cache).count() == distinct + 1
    assert token_counts.count_tokens(docs(spark, []), path, cache).count() == 0


def test_memo_keeps_frequent_keys():
    made = []
    memo = Memo(lambda k: made.append(k) or k * 2, 3)
    assert memo.many([1, 2, 1, 3, 4, 1, 5, 6, 1, 7]) == [2, 4, 2, 6, 8, 2, 10, 12, 2, 14]
    assert len(memo.young) <= 3 and len(memo.old) <= 3


# ------------------------------------------------------------- packing
def test_genetic_operators_keep_bins_valid():
    rng = np.random.default_rng(0)
    lengths = rng.integers(1, 2048, 400).astype(np.int64)
    genomes = packing.first_genomes(lengths, 2048, rng, 3)
    for child in (packing.crossover(lengths, genomes[0], genomes[1], 2048, rng), packing.mutate(lengths, genomes[0], 2048, rng), *packing.evolve(lengths, genomes, 2048, 1)):
        assert len(child) == 400 and np.bincount(child, lengths).max() <= 2048
    best = packing.evolve(lengths, [], 2048, 1)[0]
    assert packing.fitness(lengths, best, 2048) <= packing.fitness(lengths, packing.first_genomes(lengths, 2048, rng, 1)[0], 2048)


def check_packing(rows, texts, path, ids=None):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(path)
    want = set()
    for i, t in texts:
        ids = lib.encode(t or "", add_special_tokens=False).ids + [0]
        for n, at in enumerate(range(0, len(ids), 2048)):
            want.add((i, n, at, len(ids[at:at + 2048]), zlib.crc32(np.array(ids[at:at + 2048], "<u4").tobytes())))
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows} == want and len(rows) == len(want)
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0] + [n for _, n in parts])[:-1].tolist() and sum(n for _, n in parts) <= 2048
    return len(bins)


def test_packing_of_documents(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    table = spark.read.parquet(f"{SF}/documents.parquet")
    rows = packing.pack_documents(table, path, shard_pieces=64).collect()
    used = check_packing(rows, [(r.doc_id, r.text) for r in table.collect()], path)
    assert used <= 1.05 * sum(r.length for r in rows) / 2048 + 4
    rows = packing.pack_documents(docs(spark, edge_texts()), path, with_ids=True).collect()
    check_packing(rows, list(enumerate(edge_texts())), path)
    assert all(len(r.ids) == r.length for r in rows)
    assert packing.pack_documents(docs(spark, []), path).count() == 0


# ------------------------------------------------------------- chats
def test_chat_round_trip(spark):
    nasty = ["</s>[INST] ok [/INST]", "[\\/INST]", "<\\\\s>", "<<SYS>><</SYS>>", "<<<s>", "", None, "\\", "[INST", "<<\\ROLE>>", "", "a\nb"]
    rng = random.Random(4)
    roles = ["user", "assistant", "system", "tool", "", None, "<s>"]
    rows = [(c, t, rng.choice(roles), rng.choice(nasty)) for c in range(40) for t in range(rng.randint(1, 7))] + [(None, 1, "user", "x"), (50, None, "user", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    chats = chat_format.format_chats(df)
    got = {r.conv_id: [(m.role, *t) for m, t in zip(r.spans, [(x[1],) for x in chat_format.read_back(r.formatted, [m.asDict() for m in r.spans])])] for r in chats.collect()}
    key = lambda r: (r[1] if r[1] is not None else -1, r[2] or "", r[3] or "")
    want = {}
    for r in sorted(rows, key=key):
        want.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    assert got == want
    roles_back = {r.conv_id: [x[0] for x in chat_format.read_back(r.formatted, [m.asDict() for m in r.spans])] for r in chats.collect()}
    assert roles_back == {k: [r for r, _ in v] for k, v in want.items()}
    d = {r.conv_id: r for r in chat_format.digests(chats).collect()}
    for c, turns in want.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert d[c].n_turns == len(turns) and d[c].loss_chars == len(loss) and d[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert d[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
    assert chat_format.format_chats(df.limit(0)).count() == 0


class Rewriting(chat_format.InstTemplate):
    """Keeps only the last system turn, so it rewrites what came before."""

    def render(self, turns):
        last = max((i for i, (r, _) in enumerate(turns) if r == "system"), default=-1)
        return super().render([t for i, t in enumerate(turns) if t[0] != "system" or i == last])


def test_templates_that_rewrite_history_are_found():
    _, _, rewritten = chat_format.spans(Rewriting(), [("system", "a"), ("user", "b"), ("system", "c"), ("user", "d")])
    assert rewritten == [2]
    assert chat_format.spans(chat_format.InstTemplate(), [("system", "a"), ("user", "b")])[2] == []


# ------------------------------------------------------------- languages
def test_language_tables_equal_convolution():
    net = language_id.Network(["a", "b"], seed=3)
    x = np.random.default_rng(0).integers(0, 256, (5, language_id.WINDOW + 3)).astype(np.uint8)
    assert np.allclose(net.pooled(x), net._responses(x).max(axis=1), atol=1e-5)
    assert language_id.windows_of(b"x" * 600).shape == (3, language_id.WINDOW + 3)


def test_language_held_out_accuracy(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_id.identify(table, language_id.train(table)).join(table.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == table.count() and np.mean([r.lang == r.lang_pred for r in held]) > 0.95
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)


def test_language_edge_rows(spark):
    df = docs(spark, ["", None, "123 !", "the word is here " * 3, "é"])
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(df, language_id.train(df)).collect()}
    assert got[0] == got[1] == got[2] == ("und", 0.0) and got[3][0] == got[4][0] == "en"
    none = df.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id.identify(none, language_id.train(none)).collect()} == {"und"}
    assert language_id.identify(df.limit(0), language_id.train(df.limit(0))).count() == 0


def test_signs_that_are_no_letters_have_no_language(spark):
    df = docs(spark, ["½ ²", "Ⅷ", "１２３ ٣", "①", "the word is here " * 3])
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(df, language_id.train(df)).collect()}
    assert [got[i] for i in range(4)] == [("und", 0.0)] * 4 and got[4][0] == "en"


def test_null_and_hot_ids_leave_every_language_learned(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("text is not null").select("doc_id", "text", "lang")
    hot = table.orderBy("doc_id").limit(1)
    copies = functools.reduce(lambda a, b: a.unionByName(b), [hot] * 500)
    for df in (table.withColumn("doc_id", F.lit(None).cast("long")), table.withColumn("doc_id", F.lit(1).cast("long")), table.unionByName(copies)):
        rows = language_id.training_windows(df, "doc_id", "text", "lang")
        counts = {}
        for r in rows:
            counts[r["lang"]] = counts.get(r["lang"], 0) + 1
        assert len(counts) == 4 and min(counts.values()) > 100 and max(counts.values()) <= language_id.SAMPLE_DOCS * language_id.SAMPLE_WINDOWS
        net = language_id.train(df)
        assert net.langs == sorted(counts)


def test_language_equals_a_plain_network(spark):
    """The query's rows from the trained weights: every window of every text,
    convolved, pooled and averaged one by one."""
    table = spark.read.parquet(f"{SF}/documents.parquet")
    net = language_id.train(table)
    df = table.limit(25).select("doc_id", "text").unionByName(table.limit(1).select("doc_id", "text")).unionByName(
        spark.createDataFrame([(None, "A long text that repeats. " * 900), (-1, "été"), (-2, "42")], "doc_id long, text string"))
    got = sorted(((r.doc_id, r.held_out, r.lang_pred, round(r.score, 4)) for r in language_id.identify(df, net).collect()), key=str)
    want = []
    for r in df.collect():
        held = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2
        if not r.text or not any(c.isalpha() for c in r.text):
            want.append((r.doc_id, held, "und", 0.0))
            continue
        total = np.zeros(len(net.langs))
        cut = language_id.windows_of(r.text.encode())
        for window in cut:
            places = window.shape[0] - max(language_id.WIDTHS) + 1
            pooled = np.array([max(sum(t[k][window[at + k]][f] for k in range(w)) for at in range(places))
                               for w, t in net.weights.items() for f in range(language_id.FILTERS)]) if len(cut) < 4 else net._responses(window[None]).max(axis=1)[0]
            hidden = np.maximum(pooled + net.bias, 0)
            scores = hidden @ net.out + net.out_bias
            e = np.exp(scores - scores.max())
            total += e / e.sum()
        best = int(total.argmax())
        want.append((r.doc_id, held, net.langs[best], round(float(total[best] / len(cut)), 4)))
    assert [w[:3] for w in sorted(want, key=str)] == [g[:3] for g in got]
    assert np.allclose([w[3] for w in sorted(want, key=str)], [g[3] for g in got], atol=2e-3)


def test_repeated_benchmark_rows_do_not_fill_a_block(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 2000)
    rows = [(7, "one item that holds a third of the benchmark table")] * 50 + [(i, f"item number {i} of the benchmark, which stands here once") for i in range(100, 200)] + [(None, None)]
    bench = spark.createDataFrame(rows, "item_id long, text string")
    blocks = list(decontaminate._blocks(bench, "item_id", "text"))
    assert len(blocks) > 1 and max(sum(len(row[-1]) for row in block) for block in blocks) <= 2000
    texts = ["x " + rows[0][1] + " y", "z " + rows[60][1], "nothing of it"]
    got = sorted((r.doc_id, r.item_id, r.edits, r.start) for r in decontaminate.find_leaks(docs(spark, texts), bench).collect() if r.edits == 0)
    assert got == [(0, 7, 0, 2)] * 50 + [(1, 110, 0, 2)]
    assert [r.doc_id for r in decontaminate.drop_contaminated(docs(spark, texts), bench).collect()] == [2]


def test_host_with_half_its_documents_failing_keeps_the_others(spark):
    good = " ".join(f"word{i}" for i in range(30))
    rows = [(i, "short" if i % 100 < 51 else good, "en", "hot", 0, "r", 5) for i in range(300)]
    rows += [(i, "short" if i % 100 < 95 else good, "en", "bad", 0, "r", 5) for i in range(300, 500)] + [(i, good, "en", f"s{i % 5}", 0, "r", 5) for i in range(500, 900)]
    df = spark.createDataFrame(rows, DOCS)
    kept = {r.doc_id for r in quality_rules.quality_verdicts(df).filter("kept").collect()}
    assert kept == {r[0] for r in rows if r[1] == good and r[3] != "bad"}
    assert {r.doc_id for r in quality_rules.filter_documents(df).collect()} == kept


# ------------------------------------------------------------- licences
def test_license_scan(spark):
    mit = licenses.TEMPLATES["MIT"][2]
    texts = edge_texts() + ["x\n" + mit.upper().replace(",", ";") + "\nend", "Released under the MIT License.\nReleased under the MIT License!", "Released somewhere", mit[:200]]
    got = {(r.doc_id, r.license): (r.n_units, r.dice) for r in licenses.scan(docs(spark, texts)).collect()}
    n = len(edge_texts())
    # two lines, and the text as a whole
    assert got[(n, "MIT")][0] >= 1 and got[(n, "MIT")][1] == 1.0 and got[(n + 1, "MIT")][0] == 3 and not [k for k in got if k[0] in (*range(n), n + 2, n + 3)]
    assert licenses.scan(docs(spark, [])).count() == 0


def test_license_passages(spark):
    wrap = lambda x, width=78: "\n".join(textwrap.wrap(x, width))
    apache, full = licenses.TEMPLATES["Apache-2.0"], licenses.FULL_TEXTS
    texts = [
        "The article ends here. " + apache[0] + " All other rights stay with the authors.",
        "#!/bin/sh\n" + "\n".join("# " + x for x in textwrap.wrap(apache[2], 60)) + "\n\n" + "\n".join(f"echo line {i}" for i in range(40)),
        "MIT License\n\nCopyright (c) 2020 Jane Doe\n\n" + wrap(full["MIT"]),
        "Notes.\n" + wrap(full["GPL-3.0"], 72) + "\nMore notes",
        "first. " + "Licensed under CC BY 4.0. and then some more words, " * 5 + "last",
        "The licence stands elsewhere; this software has a copyright notice and no warranty of any kind.",
    ]
    got = {(r.doc_id, r.license): (r.n_units, r.dice) for r in licenses.scan(docs(spark, texts)).collect()}
    assert got[(0, "Apache-2.0")] == got[(1, "Apache-2.0")] == got[(2, "MIT")] == got[(3, "GPL-3.0")] == (1, 1.0)
    assert got[(4, "CC-BY-4.0")] == (5, 1.0) and len(got) == 5


def test_license_passages_equal_brute_force(spark):
    rng = random.Random(3)
    notices = {"A": ("alpha beta gamma delta alpha beta epsilon zeta",), "B": ("gamma delta eta theta iota kappa lambda mu alpha beta",)}
    words = sorted({w for t in notices.values() for w in t[0].split()}) + ["x", "y"]
    texts = []
    for _ in range(80):
        text = [rng.choice(words) for _ in range(8)]
        for _ in range(2):
            notice = notices[rng.choice("AB")][0].split()
            if rng.random() < 0.6:
                notice[rng.randrange(len(notice))] = rng.choice(words)
            text += notice + [rng.choice(words) for _ in range(6)]
        texts.append(" ".join(text))
    want = {}
    for d, text in enumerate(texts):
        seen = list(zip(text.split(), text.split()[1:]))
        for name, (notice,) in notices.items():
            own = set(zip(notice.split(), notice.split()[1:]))
            most = int(1.5 * (len(notice.split()) - 1)) - 2
            best = 0.0
            for a in range(len(seen)):
                for b in range(a + 1, min(a + most, len(seen)) + 1):
                    k, other = len(own & set(seen[a:b])), sum(x not in own for x in seen[a:b])
                    best = max(best, 2 * k / (k + other + len(own)))
            if best >= 0.8:
                want[(d, name)] = round(best, 9)
    got = {(r.doc_id, r.license): round(r.dice, 9) for r in licenses.scan(docs(spark, texts), templates=notices).collect()}
    assert got == want and len(want) > 40


# ------------------------------------------------------------- URLs
def test_url_rules_and_trees(spark):
    urls = ["https://A.Example.org/es/x?y=1", "http://example.org/en/12", "http://b.org/", "http://b.org", "ftp://x.com/fr/1", "http://y.com/de/#z", "http://z.net/a", None, "", "no scheme", "http://org/x"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    got = {r.page_id: r for r in url_filter.judge(df).collect()}
    assert [got[i].rule for i in range(11)] == ["example.org/es/", "example.org/en/1", "org/", None, "com/fr/", "com/de/", None, None, None, None, "org/"]
    assert [got[i].verdict for i in (0, 1, 2, 4, 5, 10)] == ["block", "block", "allow", "allow", "block", "allow"]
    assert got[0].host == "a.example.org" and got[0].path == "/es/x" and got[3].path == "" and (got[7].host, got[7].path) == ("", "")
    assert {got[i].verdict for i in (3, 6, 7, 8, 9)} <= {"allow", "block"}
    assert url_filter.judge(df.limit(0)).count() == 0
    one = df.filter("page_id in (0, 6)")
    assert {r.verdict for r in url_filter.judge(one).collect()} == {"block"}


def test_url_trees_learn_labels(spark):
    rng = random.Random(0)
    rows = [(i, f"http://h{rng.randrange(9)}.net/" + ("9" * rng.randint(8, 20) if i % 3 == 0 else "word/" * rng.randint(1, 3))) for i in range(400)]
    df = spark.createDataFrame(rows, "page_id long, url string")
    labels = df.filter("page_id < 200").select("url", (F.col("page_id") % 3 == 0).alias("blocked"))
    got = url_filter.judge(df, labels=labels).filter("page_id >= 200").collect()
    assert np.mean([(r.verdict == "block") == (r.page_id % 3 == 0) for r in got]) > 0.95


def test_line_filters_miss_no_repeat(monkeypatch):
    """One shard: every hash that two chunks hold, or one chunk holds in
    several documents, is answered to all its chunks, and nothing foreign is."""
    import pyarrow as pa
    rng = np.random.default_rng(0)
    for trial in range(60):
        monkeypatch.setattr(line_dedup, "_ADDED", int(rng.integers(1, 30)))
        rows, count = [], {}
        for chunk in range(int(rng.integers(0, 30))):
            h = np.unique(rng.integers(0, 200, rng.integers(0, 12)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            many = rng.random(len(h)) < 0.2
            rows.append((chunk, h[~many].tobytes(), h[many].tobytes(), set(h.tolist())))
            for x, m in zip(h.tolist(), many):
                count[x] = count.get(x, 0) + 1 + m
        table = pa.table({"team": pa.array([r[0] for r in rows], pa.int64()), "single": pa.array([r[1] for r in rows], pa.binary()),
                          "several": pa.array([r[2] for r in rows], pa.binary())})
        table = pa.concat_tables([table.slice(0, 2), table.slice(2)])
        got = {}
        for r in line_dedup._suspects(table).to_pylist():
            got.setdefault(r["team"], set()).update(np.frombuffer(r["hashes"], np.uint64).tolist())
        for chunk, _, _, held in rows:
            assert {x for x in held if count[x] > 1} <= got.get(chunk, set()) <= held


def test_url_statistics_count_all_labelled_urls(spark):
    rows = [("a.x.com", 1.0)] * 30 + [("b.x.com", 0.0)] * 10 + [("y.org", 0.0)] * 60 + [("", 0.0)]
    known = url_filter.with_suffixes(spark.createDataFrame(rows, "__host string, label double"))
    got = {r[0]: (r[1], r[2]) for r in url_filter._statistics(known, "__domain", "domain", 101, 0.25).collect()}
    assert set(got) == {"x.com", "y.org", ""}
    assert got["x.com"] == pytest.approx((40 / 101, (30 + 20 * 0.25) / 60))
    assert got["y.org"] == pytest.approx((60 / 101, 20 * 0.25 / 80))


def test_copies_of_a_url_do_not_fill_the_sample(spark):
    # digits decide; the copied URL, which blocks, is the one that hashes lowest
    urls = [f"http://site.org/{'x7' if i % 2 else 'xy'}{'abcdefgh'[i % 8] * (i // 8 % 9)}/{'qrstuvw'[i % 7]}{'lmnop'[i // 56 % 5]}" for i in range(560)]
    hashed = spark.createDataFrame([(u,) for u in sorted(set(urls))], "url string").orderBy(F.xxhash64("url", F.lit("sample"))).collect()
    blocked = lambda u: "7" in u
    hot = next(r.url for r in hashed if blocked(r.url))
    labels = spark.createDataFrame([(u, blocked(u)) for u in urls] + [(hot, True)] * 280, "url string, blocked boolean")
    pages = spark.createDataFrame([(f"http://site.org/{a}{b}/z",) for a in ("x7", "xy") for b in ("ij", "jk", "kkk")], "url string")
    got = {r.url: r.verdict for r in url_filter.judge(pages, rules=(("allow", "nowhere.net/"),), labels=labels, sample_rows=84).collect()}
    assert got == {u: "block" if blocked(u) else "allow" for u in got} and len(got) == 6
    known = labels.select(F.col("url").alias("__url"), F.lit("h").alias("__host"), F.lit("p").alias("__path"), F.col("blocked").cast("double").alias("label"))
    sample = [r["__url"] for r in url_filter._sample(known, 840, 84).collect()]
    assert 50 < len(sample) < 120 and 20 < sample.count(hot) < 40


def test_memo_gaps_are_looked_up_once():
    """A list with held, old, missing and repeated keys: values in order, each
    missing key made once while it is held."""
    from fusekit.llm.memo import Memo
    made = []

    def make(key):
        made.append(key)
        return key * 2

    memo = Memo(make, 3)
    for keys in ([1, 2, 3], [4, 1, 4, 5, 1], [], [5, 9, 9, 4]):
        assert memo.many(keys) == [2 * k for k in keys]
    assert made[:5] == [1, 2, 3, 4, 5] and made.count(9) == 1
    assert Memo(None, 2).all([7, 8, 9], lambda keys: [-k for k in keys]) == [-7, -8, -9]


def test_a_memo_asked_for_many_keys_stays_bounded():
    """Look-ups of distinct keys at once: each key is made once while it is
    held, old keys that are asked for stay, and no half passes its size."""
    from fusekit.llm.memo import Memo
    asked = []

    def make(keys):
        asked.extend(keys)
        return [-k for k in keys]

    memo = Memo(None, 4)
    for keys, new in (([1, 2, 3], [1, 2, 3]), ([3, 4, 5], [4, 5]), ([1, 6], [6]), ([], []), (range(10, 20), range(10, 20)), ([19, 18, 1], [1])):
        asked.clear()
        assert memo.all(list(keys), make) == [-k for k in keys]
        assert asked == list(new) and len(memo.young) <= 4 and len(memo.old) <= 4
