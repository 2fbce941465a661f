"""The Merkle manifest against its SQL and a plain version."""

import hashlib
import zlib

import duckdb
import pytest

from fusekit.llm import merkle, queries

from .test_operators import DOCS, SF, docs, edge_texts

COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute(rows):
    """Rows of (doc_id, source, lang, n_chars, text) by the rule, one by one."""
    def leaf(r, text):
        return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*r[:4], text)))

    def climb(nodes, found):
        """The top, and for each node its siblings (left, right) level by level."""
        own, paths = list(range(len(nodes))), [[] for _ in nodes]
        while len(nodes) > 1:
            for i, at in enumerate(own):
                run = nodes[at // 8 * 8:at // 8 * 8 + 8]
                paths[i].append((run[:at % 8], run[at % 8 + 1:]))
            nodes, own = [sha(*nodes[i:i + 8]) for i in range(0, len(nodes), 8)], [at // 8 for at in own]
        found += paths
        return nodes[0]

    trees = {}
    for r in rows:
        text = r[4]
        if text is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
            text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        trees.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r, r[4]), leaf(r, text), r[0]))
    names = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    tops, paths = [], []
    for t in names:
        trees[t].sort(key=lambda x: x[:3])
        tops.append(climb([x[2] for x in trees[t]], paths))
    upper = []
    root = climb(tops, upper)
    out, paths = [], iter(paths)
    for t, top, above in zip(names, tops, upper):
        for _, _, own, claim, doc_id in trees[t]:
            path, acc = next(paths) + above, claim
            for left, right in path:
                acc = sha(*left, acc, *right)
            out.append((doc_id, own, top, root, sha(*(x for p in path for side in p for x in side)), acc, acc == root))
    return out


def got(df):
    return sorted([tuple(r) for r in df.select(*COLUMNS).collect()], key=str)


def table(spark, rows):
    return spark.createDataFrame([(r[0], r[4], r[2], r[1], r[3], "r", 5) for r in rows], DOCS)


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 8}, {"en": 9}, {"en": 65, "fr": 1, "de": 8}, {None: 2, "": 3, "é": 70, "z": 1, **{f"l{i}": 2 for i in range(9)}}])
def test_any_shape(spark, sizes):
    rows = [(1000 * k + 7 * i % 997, "s", lang, i, f"Text {i}") for k, (lang, n) in enumerate(sizes.items()) for i in range(n)]
    assert got(merkle.verified_manifest(table(spark, rows))) == sorted(brute(rows), key=str)


def test_edge_rows(spark):
    rows = [(i, None if i % 3 else "S:1", ("en", None, "é")[i % 3], None if i == 4 else i, t) for i, t in enumerate(edge_texts())]
    rows += [rows[5], rows[5], (None, None, None, None, None), (None, "s", "en", 1, "A"), (5, "other", "é", 1, "B")]
    df = table(spark, rows).selectExpr("*", "1 AS tree", "2 AS place", "3 AS h0", "4 AS path", "5 AS leaf", "6 AS digest")
    assert got(merkle.verified_manifest(df)) == sorted(brute(rows), key=str)


def test_empty_table(spark):
    assert got(merkle.verified_manifest(docs(spark, []))) == []


def test_query_equals_sql_and_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    mine = got(queries.op13_merkle_manifest(spark, SF))
    assert mine == sorted(brute(rows), key=str)
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
        assert sorted(db.execute(f"SELECT {', '.join(COLUMNS)} FROM ({merkle.ORACLE})").fetchall(), key=str) == mine
    assert 0 < sum(not r[-1] for r in mine) < len(mine)
