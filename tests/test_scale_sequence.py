import os

import numpy as np
from pyspark.ml.feature import StandardScalerModel
from pyspark.sql import functions as F

from fusekit.functions.arrays import to_array, to_vector
from fusekit.operators.scale import covariance, fit_pca, fit_scaler
from fusekit.operators.sequence import lookup_tokens, prune_vectors, request_chunks, sequence_embed, vector_replies, vocabulary


def feature_df(spark, n=60, d=5, seed=0):
    rng = np.random.default_rng(seed)
    X = rng.normal(0, 3, (n, d))
    X[:, 2] = 7.0  # zero-variance dimension
    rows = [(f"f{i}", "train" if i < n - 10 else "dev", [float(v) for v in X[i]]) for i in range(n)]
    df = spark.createDataFrame(rows, "filename string, split string, x array<double>")
    return X, df.withColumn("features_vector", to_vector(F.col("x")))


def test_scaler_train_stats_zero_variance_and_roundtrip(spark, tmp_dir):
    X, df = feature_df(spark)
    train = df.where(F.col("split") == "train")
    model = fit_scaler(train)
    Xt = X[:50]
    assert np.allclose(model.mean.toArray(), Xt.mean(0))
    assert np.allclose(model.std.toArray(), Xt.std(0, ddof=1))
    out = np.array([r[0] for r in model.transform(train).select(to_array(F.col("scaled_features"))).collect()])
    assert np.allclose(out[:, [0, 1, 3, 4]].mean(0), 0, atol=1e-9)
    assert np.allclose(out[:, [0, 1, 3, 4]].std(0, ddof=1), 1)
    assert np.all(out[:, 2] == 0.0)
    # dev is scaled with the train statistics (values may leave the train range)
    dev = np.array([r[0] for r in model.transform(df.where(F.col("split") == "dev"))
                    .select(to_array(F.col("scaled_features"))).collect()])
    sd = Xt.std(0, ddof=1)
    sd[2] = 1.0
    expect = (X[50:] - Xt.mean(0)) / sd
    expect[:, 2] = 0.0
    assert np.allclose(dev, expect)
    p = os.path.join(tmp_dir, "scaler")
    model.write().overwrite().save(p)
    again = StandardScalerModel.load(p)
    assert np.allclose(again.mean.toArray(), model.mean.toArray())


def test_covariance_matches_numpy(spark):
    X, df = feature_df(spark, n=80, d=6, seed=2)
    cov = {(r.i, r.j): r.cov for r in covariance(df.repartition(3), "x").collect()}
    ref = np.cov(X, rowvar=False)
    assert len(cov) == 21
    for (i, j), v in cov.items():
        assert abs(v - ref[i, j]) < 1e-9


def test_pca_properties(spark):
    X, df = feature_df(spark, n=120, d=6, seed=4)
    train = df.where(F.col("split") == "train")
    scaled = fit_scaler(train).transform(train)
    pca = fit_pca(scaled, 3)
    pc = pca.pc.toArray()
    assert np.allclose(pc.T @ pc, np.eye(3), atol=1e-8)
    ev = pca.explainedVariance.toArray()
    assert np.all(np.diff(ev) <= 1e-12)
    Z = np.array([r[0] for r in scaled.select(to_array(F.col("scaled_features"))).collect()])
    w, v = np.linalg.eigh(np.cov(Z, rowvar=False))
    order = np.argsort(w)[::-1][:3]
    assert np.allclose(ev, w[order] / w.sum(), atol=1e-8)
    for c in range(3):
        assert min(np.abs(pc[:, c] - v[:, order[c]]).max(), np.abs(pc[:, c] + v[:, order[c]]).max()) < 1e-6
    # transform projects without centring
    proj = np.array([r[0] for r in pca.transform(scaled).select(to_array(F.col("pca_features"))).collect()])
    assert np.allclose(proj, Z @ pc)


def seq_posts(spark):
    rows = [
        (1, "img/00001.png", ["a", "b", "zz"], 1, "train"),
        (2, "img/00002.png", None, 0, "train"),
        (3, "img/00003.png", [], 0, "dev"),
        (4, "img/00004.png", ["a"] * 81, 1, "train"),
        (5, "img/00005.png", ["a", "devonly"], 0, "dev"),
    ]
    return spark.createDataFrame(rows, "id long, img string, text_tokens array<string>, label int, split string")


def seq_vectors(spark):
    return spark.createDataFrame([("a", [1.0, 2.0]), ("b", [3.0, 4.0]), ("devonly", [9.0, 9.0]),
                                  ("A", [5.0, 5.0])], "token string, vector array<float>")


def test_sequence_edge_cases_and_paths(spark):
    posts = seq_posts(spark)
    vocab = vocabulary(posts, split="train")
    assert sorted(r.token for r in vocab.collect()) == ["a", "b", "zz"]
    pruned = prune_vectors(seq_vectors(spark), vocab)
    assert sorted(r.token for r in pruned.collect()) == ["a", "b"]
    for chunk in (2048, 2):
        out = {r.id: r.text_embedding_seq for r in
               sequence_embed(posts, pruned, dim=2, chunk_posts=chunk).collect()}
        assert set(out) == {1, 2, 3, 4, 5}
        assert all(len(s) == 80 and all(len(v) == 2 for v in s) for s in out.values())
        assert out[1][:3] == [[1.0, 2.0], [3.0, 4.0], [0.0, 0.0]]
        assert all(v == [0.0, 0.0] for v in out[2]) and all(v == [0.0, 0.0] for v in out[3])
        assert out[4] == [[1.0, 2.0]] * 80
        assert out[5][:2] == [[1.0, 2.0], [0.0, 0.0]]  # word seen only in dev -> zeros


def test_sequence_repeated_ids_stay_separate(spark):
    posts = spark.createDataFrame([(7, "img/7.png", ["a"], 0, "train"), (7, "img/7.png", ["b", "a"], 0, "train")],
                                  "id long, img string, text_tokens array<string>, label int, split string")
    vec = spark.createDataFrame([("a", [1.0]), ("b", [2.0])], "token string, vector array<float>")
    out = sorted(r.text_embedding_seq[:2] for r in sequence_embed(posts, vec, dim=1, max_tokens=3).collect())
    assert out == [[[1.0], [0.0]], [[2.0], [1.0]]]


def test_lookup_equals_a_plain_join(spark):
    """Rows, misses, absent tokens and lists; a hot token on most posts; 300 wide."""
    import random
    rng = random.Random(6)
    words = [f"w{i}" for i in range(40)]
    lists = [None if i % 50 == 0 else [None if rng.random() < 0.02 else "hot" if rng.random() < 0.5 else rng.choice(words) for _ in range(rng.randint(0, 90))] for i in range(300)]
    posts = spark.createDataFrame([(i % 100, lists[i], {"a": [i]}) for i in range(300)], "id long, text_tokens array<string>, extra map<string, array<int>>").repartition(3)
    known = {w: np.arange(300, dtype=np.float32) + i for i, w in enumerate(["hot"] + words[::2])}
    vectors = spark.createDataFrame([(w, v.tolist()) for w, v in known.items()], "token string, vector array<float>")
    got = lookup_tokens(posts, vectors, 300, chunk_posts=16).collect()
    want = [(i % 100, k, w, (known[w][0] if w in known else 0.0), w in known, i) for i, ws in enumerate(lists) for k, w in enumerate((ws or [])[:80])]
    assert sorted(((r.id, r.pos, r.token, r.vector[0], r.hit, r.extra["a"][0]) for r in got), key=str) == sorted(want, key=str)
    assert all(np.allclose(r.vector, known.get(r.token, np.zeros(300))) for r in got)


def test_a_vector_moves_once_for_each_chunk(spark):
    posts = spark.createDataFrame([(i, ["hot"] * 50 + [f"w{i % 7}"]) for i in range(400)], "id long, text_tokens array<string>").repartition(2)
    vectors = spark.createDataFrame([(w, [1.0] * 300) for w in ["hot"] + [f"w{i}" for i in range(7)]], "token string, vector array<float>")
    chunks = request_chunks(posts, "text_tokens", 80, 100)
    assert chunks.count() <= 6 and vector_replies(chunks, vectors).count() == chunks.agg(F.sum(F.size("tokens"))).first()[0] <= 6 * 8
    shape = sequence_embed(posts, vectors, 300, carry=()).select(F.size("text_embedding_seq"), F.size(F.col("text_embedding_seq")[50]))
    assert {tuple(r) for r in shape.collect()} == {(80, 300)}


def test_lookup_of_an_empty_table(spark):
    posts, vectors = seq_posts(spark).limit(0), seq_vectors(spark)
    assert sequence_embed(posts, vectors, 2).count() == 0 == lookup_tokens(posts, vectors, 2).count()
    assert sequence_embed(seq_posts(spark), vectors.limit(0), 2).count() == 5


def test_hot_vectors_are_broadcast_and_not_asked_for(spark):
    """Tokens of most chunks: no reply rows; the rows equal a plain look-up."""
    from fusekit.operators.sequence import HOT_CHUNKS, hot_tokens
    posts = spark.createDataFrame([(i, ["hot", "lost", f"w{i}", None]) for i in range(2 * HOT_CHUNKS)], "id long, text_tokens array<string>").repartition(1)
    vectors = spark.createDataFrame([("hot", [1.0, 2.0])] + [(f"w{i}", [float(i), 0.5]) for i in range(0, 40, 2)], "token string, vector array<float>")
    chunks = request_chunks(posts, "text_tokens", 80, 2)
    hot = hot_tokens(chunks)
    assert sorted(r.token for r in hot.collect()) == ["hot", "lost"] and hot_tokens(chunks, most=1) is None
    assert vector_replies(chunks, vectors, hot).count() == HOT_CHUNKS
    got = {(r.id, r.pos): (r.token, r.hit, r.vector) for r in lookup_tokens(posts, vectors, 2, chunk_posts=2).collect()}
    for i in range(2 * HOT_CHUNKS):
        own = (f"w{i}", i % 2 == 0, [float(i), 0.5] if i % 2 == 0 else [0.0, 0.0])
        assert [got[i, p] for p in range(4)] == [("hot", True, [1.0, 2.0]), ("lost", False, [0.0, 0.0]), own, (None, False, [0.0, 0.0])]
