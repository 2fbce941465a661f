"""The pipeline against a brute-force version, and the queries against SQL."""

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from fusekit.llm import decontaminate, line_dedup, simhash_trie

from .test_operators import SF, brute_components, brute_quality, check_packing


def test_pipeline_equals_brute_force(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet").collect()
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = []
    for r in sorted(table, key=lambda r: r.doc_id):
        n, _, _, _, again = brute_quality(r.text)
        if n >= 20 and 100 * (again or 0) <= 30 * n:
            kept.append((r.doc_id, r.text))
    holders = {}
    for d, t in kept:
        for x in t.split("\n"):
            holders.setdefault(line_dedup.line_key(x.encode()), []).append(d)
    first = {k: min(v) for k, v in holders.items() if len(set(v)) > 1 and len(k.decode()) >= 10}
    kept = [(d, "\n".join(x for x in t.split("\n") if first.get(line_dedup.line_key(x.encode()), d) == d)) for d, t in kept]
    group = brute_components(simhash_trie.fingerprints([t.encode() for _, t in kept]))
    kept = [row for i, row in enumerate(kept) if group[i] == i]
    matcher = decontaminate.Matcher(bench)
    kept = [(d, t) for d, t in kept if not matcher.find(t)]
    rows = corpus_pipeline.run(spark, SF).collect()
    check_packing(rows, kept, public_tokenizers.path("word_bpe_49k.json"))


def prose(seed, n=60):
    import random
    rng = random.Random(seed)
    return " ".join(f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.randrange(10**5)}" for _ in range(n))


def test_near_duplicates_go_by_row(spark):
    """Repeated and null ids, equal rows, null texts and clashing columns."""
    a, b, c = prose(1), prose(2), prose(3)
    near = a.replace(" b", " b", 1) + "."
    rows = [(2, b), (5, b), (5, a), (None, a), (7, a), (7, a), (None, c), (None, c), (9, None), (9, ""), (10, None), (3, near)]
    df = spark.createDataFrame([(i, t, "en", "s", n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    df = df.selectExpr("*", "1 AS id", "2 AS fp", "'x' AS component_id", "3 AS __hash", "4 AS root")
    out = corpus_pipeline.simhash_stage(spark, df, SF)
    assert out.columns == df.columns
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    fps = simhash_trie.fingerprints([(t or "").encode() for _, t in rows])
    group = brute_components(fps)
    want = set()
    for g in set(group):
        members = [rows[i] for i in range(len(rows)) if group[i] == g]
        want.add(min(members, key=lambda m: (m[0] is None, m[0] or 0))[0])
    assert len(got) == len(set(group)) and {d for d, _ in got} == want
    assert (2, b) in got and (None, c) in got and not [1 for d, t in got if d is None and t == a]


def test_whole_pipeline_on_odd_rows(spark, tmp_dir):
    a, b = prose(4), prose(5)
    rows = [(1, a), (1, a), (None, a), (None, b), (None, b), (4, None), (5, ""), (1, b), (6, prose(6) + "\nshared line of the corpus"), (7, prose(7) + "\nshared line of the corpus")]
    df = spark.createDataFrame([(i, t, "en", None, None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").withColumn("piece", F.lit("p"))
    df.write.parquet(f"{tmp_dir}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmp_dir}/benchmark.parquet")
    got = corpus_pipeline.run(spark, tmp_dir).collect()
    # the rows without an id lose their lines to document 1; of the empty texts left one stays
    want = [(1, a), (1, b), (6, rows[8][1]), (7, prose(7)), (None, "")]
    check_packing(got, want, public_tokenizers.path("word_bpe_49k.json"))


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns


def test_registered_queries():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)] and "pipeline" in entry.queries()


@pytest.mark.parametrize("name", ["op3_chat_format", "op5_quality_rules", "op6_line_dedup", "op7_license_scan", "op13_merkle_manifest"])
def test_query_equals_sql(spark, name):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = entry.queries()[name](spark, SF)
    columns = sorted(got.columns)
    want = con.sql(f"SELECT {', '.join(columns)} FROM ({entry.oracle_sql()[name]})").fetchall()
    rounded = lambda rows: sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in rows)
    assert rounded([tuple(r[c] for c in columns) for r in got.collect()]) == rounded(want)
    assert np.unique([len(r) for r in want]).tolist() in ([len(columns)], [])
