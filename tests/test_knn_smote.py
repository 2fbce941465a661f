import numpy as np
import pytest
from pyspark.sql import functions as F

from fusekit.operators.knn import knn_self_join
from fusekit.operators.ordering import global_index
from fusekit.operators.smote import TooFewMinority, smote_balanced, smote_synthetic


def brute_knn(ids, X, k):
    out = {}
    for a in range(len(ids)):
        d = np.sqrt(((X - X[a]) ** 2).sum(1))
        cand = sorted((d[b], ids[b]) for b in range(len(ids)) if b != a)[:k]
        out[ids[a]] = [(q, round(float(dd), 9)) for dd, q in cand]
    return out


def points_df(spark, ids, X):
    return spark.createDataFrame([(int(i), [float(v) for v in x]) for i, x in zip(ids, X)], "id long, x array<double>")


def knn_dict(df):
    got = {}
    for r in df.orderBy("id", "rank").collect():
        got.setdefault(r.id, []).append((r.nbr_id, round(r.dist, 9)))
    return got


@pytest.mark.parametrize("cell_size,block", [(1024, 2048), (16, 2048), (16, 7)])
def test_knn_matches_brute_force(spark, cell_size, block):
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 10, (5, 4))
    X = np.vstack([c + rng.normal(0, 1, (40, 4)) for c in centres])
    ids = np.arange(len(X)) * 7 + 3
    got = knn_dict(knn_self_join(points_df(spark, ids, X), k=3, cell_size=cell_size, block=block))
    assert got == brute_knn(ids, X, 3)


def test_knn_hot_duplicate_group_ties_by_id(spark):
    # a third of the rows are copies of one vector: distance 0, ties by id
    rng = np.random.default_rng(5)
    X = np.vstack([np.tile([1.0, 2.0, 3.0], (30, 1)), rng.normal(0, 5, (60, 3))])
    ids = np.arange(len(X))
    got = knn_dict(knn_self_join(points_df(spark, ids, X), k=3, cell_size=8, block=16))
    assert got == brute_knn(ids, X, 3)
    assert got[0] == [(1, 0.0), (2, 0.0), (3, 0.0)]


def test_knn_fewer_points_than_k(spark):
    X = np.array([[0.0], [1.0], [3.0]])
    got = knn_dict(knn_self_join(points_df(spark, [1, 2, 3], X), k=3))
    assert got[1] == [(2, 1.0), (3, 3.0)]


def test_global_index_dense_and_ordered(spark):
    df = spark.range(0, 1000).select((F.col("id") * 37 % 1000).alias("k"))
    idx = global_index(df, ["k"], num_partitions=7).collect()
    assert sorted((r.idx, r.k) for r in idx) == [(i, i) for i in range(1000)]


def smote_input(spark, n_min=12, n_maj=30, dim=3, seed=0):
    rng = np.random.default_rng(seed)
    rows = [(f"m{i:03d}", 1, [float(v) for v in rng.normal(2, 1, dim)]) for i in range(n_min)]
    rows += [(f"M{i:03d}", 0, [float(v) for v in rng.normal(-2, 1, dim)]) for i in range(n_maj)]
    return spark.createDataFrame(rows, "filename string, label int, x array<double>")


def test_smote_properties(spark):
    df = smote_input(spark)
    syn = smote_synthetic(df, id_col="filename", vec_col="x").collect()
    assert len(syn) == 30 - 12
    pts = {r.filename: np.array(r.x) for r in df.collect()}
    mins = [f for f in pts if f.startswith("m")]
    X = np.array([pts[f] for f in mins])
    nn = brute_knn(mins, X, 3)
    for r in syn:
        assert r.label == 1 and 0.0 <= r.step < 1.0
        assert nn[r.base_filename][r.rank - 1][0] == r.nbr_filename
        expect = pts[r.base_filename] + r.step * (pts[r.nbr_filename] - pts[r.base_filename])
        assert np.allclose(r.x, expect)
    bal = smote_balanced(df, smote_synthetic(df, id_col="filename", vec_col="x"))
    counts = {r.label: r["count"] for r in bal.groupBy("label").count().collect()}
    assert counts == {0: 30, 1: 30}
    # originals unchanged
    orig = bal.where(~F.col("is_synthetic")).collect()
    assert sorted(tuple(r.features) for r in orig) == sorted(tuple(v) for v in pts.values())


def test_smote_repeatable_across_partitioning(spark):
    df = smote_input(spark, seed=1)
    a = sorted(tuple(r) for r in smote_synthetic(df, id_col="filename", vec_col="x")
               .select("s", "base_filename", "nbr_filename", "step").collect())
    b = sorted(tuple(r) for r in smote_synthetic(df.repartition(5), id_col="filename", vec_col="x")
               .select("s", "base_filename", "nbr_filename", "step").collect())
    assert a == b


def test_smote_needs_more_than_k_minority(spark):
    df = smote_input(spark, n_min=3, n_maj=10)
    with pytest.raises(TooFewMinority):
        smote_synthetic(df, id_col="filename", vec_col="x")


def test_smote_already_balanced_adds_nothing(spark):
    df = smote_input(spark, n_min=10, n_maj=10)
    assert smote_synthetic(df, id_col="filename", vec_col="x").count() == 0


def test_smote_with_repeated_ids(spark):
    rng = np.random.default_rng(9)
    rows = [("dup", 1, [float(v) for v in rng.normal(2, 1, 3)]) for _ in range(8)]
    rows += [(f"M{i}", 0, [float(v) for v in rng.normal(-2, 1, 3)]) for i in range(20)]
    df = spark.createDataFrame(rows, "filename string, label int, x array<double>")
    syn = smote_synthetic(df, id_col="filename", vec_col="x").collect()
    assert len(syn) == 12 and all(r.base_filename == "dup" == r.nbr_filename for r in syn)
    pts = np.array([r[2] for r in rows[:8]])
    for r in syn:  # each synthetic lies inside the minority's bounding box
        assert np.all(np.array(r.x) >= pts.min(0) - 1e-12) and np.all(np.array(r.x) <= pts.max(0) + 1e-12)


def test_knn_blocks_smaller_than_k(spark):
    # chunks of 2 rows per side: many blocks hold fewer than k other points
    rng = np.random.default_rng(11)
    X = rng.normal(0, 1, (23, 2))
    ids = np.arange(23)
    got = knn_dict(knn_self_join(points_df(spark, ids, X), k=3, cell_size=4, block=2))
    assert got == brute_knn(ids, X, 3)


def test_global_index_hot_key_spread(spark):
    # a third of the rows share one key: indices stay dense and the hot key
    # is split over several range partitions
    df = spark.range(0, 900).select(F.when(F.col("id") < 300, F.lit(-1)).otherwise(F.col("id")).alias("k"))
    idx = global_index(df, ["k"], num_partitions=6)
    rows = idx.collect()
    assert sorted(r.idx for r in rows) == list(range(900))
    assert all(r.idx < 300 for r in rows if r.k == -1)
    parts = idx.where("k = -1").select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts > 1


def test_knn_copies_shortcut_matches_brute_force(spark):
    # 40 of 100 rows are copies of one vector, another 12 copies of a second
    rng = np.random.default_rng(13)
    X = np.vstack([np.tile([5.0, 5.0], (40, 1)), np.tile([-3.0, 1.0], (12, 1)), rng.normal(0, 3, (48, 2))])
    ids = rng.permutation(1000)[:100]
    got = knn_dict(knn_self_join(points_df(spark, ids, X), k=3, cell_size=10, block=8))
    assert got == brute_knn(ids, X, 3)
    # near-copies (not bit-identical) must not be treated as copies
    Y = X.copy()
    Y[:20] += 1e-12
    got = knn_dict(knn_self_join(points_df(spark, ids, Y), k=3, cell_size=10, block=8))
    assert got == brute_knn(ids, Y, 3)


def test_knn_repeated_ids_are_an_error(spark):
    with pytest.raises(ValueError):
        knn_self_join(points_df(spark, [1, 1, 2], np.eye(3)), k=1)
    with pytest.raises(ValueError):
        knn_self_join(points_df(spark, [1, 2], np.eye(2)), k=1, method="other")


def test_knn_projections_recall_and_hot_copies(spark):
    # clustered points in 16 dimensions, and a third of the rows copies of one
    rng = np.random.default_rng(8)
    centres = rng.normal(0, 5, (30, 16))
    X = np.vstack([*[c + rng.normal(0, 0.5, (20, 16)) for c in centres], np.tile(rng.normal(0, 1, 16), (300, 1))])
    ids = np.arange(len(X))
    want = brute_knn(ids, X, 3)
    got = knn_dict(knn_self_join(points_df(spark, ids, X), k=3, method="projections", block=128, tables=8))
    assert set(got) == set(want) and all(len(v) == 3 for v in got.values())
    dists = {(a, q): d for a, v in got.items() for q, d in v}
    assert all(abs(d - np.sqrt(((X[a] - X[q]) ** 2).sum())) < 1e-6 for (a, q), d in dists.items())
    # copies: any copy at distance 0 is a neighbour
    assert all(d == 0 for a in ids[600:] for _, d in got[a])
    hits = sum(len({q for q, _ in got[a]} & {q for q, _ in want[a]}) for a in ids[:600])
    assert hits / (3 * 600) >= 0.9


def test_knn_projections_empty(spark):
    empty = points_df(spark, [1], np.eye(1)).where("id < 0")
    assert knn_self_join(empty, k=3, method="projections").count() == 0


# ------------------------------------------------------------- graph refinement
def recall(got, X, k):
    """Share of the true k nearest distances that were found (ties count)."""
    found = {}
    for r in got:
        found.setdefault(r.id, []).append(r.dist)
    hits = 0
    for i, x in enumerate(X):
        d = np.sort(np.sqrt(((X - x) ** 2).sum(1)))[1:k + 1]
        mine = np.sort(found.get(i, []))
        hits += sum(1 for t in d if np.any(np.abs(mine - t) < 1e-9))
    return hits / (k * len(X))


def numbered(spark, X):
    return points_df(spark, range(len(X)), X).repartition(4)


def test_descent_recall_on_uniform_points(spark):
    from fusekit.operators.knn_graph import Report
    for n, d in ((3000, 8), (1500, 32)):
        X = np.random.default_rng(n).uniform(size=(n, d))
        report = Report()
        got = knn_self_join(numbered(spark, X), k=3, method="descent", report=report).collect()
        assert len(got) == 3 * n and recall(got, X, 3) >= 0.9, recall(got, X, 3)
        assert report.points == n and 1 <= report.rounds < 15
        assert max(report.compared[1:]) <= n * (2 * 32) ** 2 / 2


def test_descent_recall_on_embeddings(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").orderBy("vec_id").collect()
    X = np.array([r.embedding for r in rows], np.float64)
    got = knn_self_join(numbered(spark, X), k=3, method="descent").collect()
    assert recall(got, X, 3) >= 0.9, recall(got, X, 3)


def test_descent_work_grows_with_the_rows(spark):
    from fusekit.operators.knn_graph import Report
    work = []
    for n in (1000, 4000):
        report = Report()
        X = np.random.default_rng(n).normal(size=(n, 8))
        knn_self_join(numbered(spark, X), k=3, method="descent", report=report).collect()
        work.append(sum(report.compared))
    assert work[1] <= 1.5 * 4 * work[0]


def test_descent_copies_and_small_tables(spark):
    """A vector that a third of the rows share, ties by id, fewer points than k."""
    rng = np.random.default_rng(4)
    X = np.vstack([np.repeat(rng.normal(size=(1, 6)), 100, axis=0), rng.normal(size=(190, 6)), np.repeat(rng.normal(size=(5, 6)), 2, axis=0)])
    X = X[rng.permutation(len(X))]
    got = {(r.id, r["rank"]): (r.nbr_id, r.dist) for r in knn_self_join(numbered(spark, X), k=3, method="descent").collect()}
    for i, x in enumerate(X):
        d = np.sqrt(((X - x) ** 2).sum(1))
        order = [j for j in np.lexsort((np.arange(len(X)), d)) if j != i][:3]
        if d[order[-1]] == 0:
            assert [got[(i, r)][0] for r in (1, 2, 3)] == order
    exact = {(r.id, r["rank"]): (r.nbr_id, r.dist) for r in knn_self_join(numbered(spark, X), k=3).collect()}
    assert np.mean([got[key][0] == exact[key][0] for key in exact]) >= 0.95 and set(got) == set(exact)
    for n in (0, 1, 2, 5):
        small = rng.normal(size=(n, 3))
        got = sorted((r.id, r["rank"], r.nbr_id) for r in knn_self_join(numbered(spark, small) if n else numbered(spark, X).limit(0), k=3, method="descent").collect())
        want = sorted((i, r + 1, int(j)) for i in range(n) for r, j in enumerate([j for j in np.argsort(((small - small[i]) ** 2).sum(1)) if j != i][:3]))
        assert got == want


def test_descent_string_ids(spark):
    X = np.random.default_rng(0).normal(size=(60, 4))
    df = spark.createDataFrame([(f"p{i:02}", x.tolist()) for i, x in enumerate(X)], "id string, x array<double>")
    exact = knn_self_join(df, k=3).collect()
    assert sorted((r.id, r["rank"], r.nbr_id) for r in knn_self_join(df, k=3, method="descent").collect()) == sorted((r.id, r["rank"], r.nbr_id) for r in exact)


def test_descent_vectors_move_once_a_chunk(spark):
    """Whatever the chunks, the graph is the same; a chunk gets a vector once a
    round, where a circle (up to 64 members) got its own before."""
    from fusekit.operators.knn_graph import Report
    rng = np.random.default_rng(12)
    X = np.vstack([rng.normal(size=(700, 6)), rng.normal(size=(700, 1)) + 1e-9 * rng.normal(size=(700, 6))])
    results = []
    for rows in (100, 500, 10_000):
        report = Report()
        got = knn_self_join(numbered(spark, X), k=3, method="descent", report=report, chunk_rows=rows).collect()
        assert recall(got, X, 3) >= 0.95
        results.append((sorted((r.id, r["rank"], r.nbr_id, r.dist) for r in got), report.compared, report.changed))
        assert len(report.moved) == report.rounds >= 1
        # (each cell of pivots and each cut of one may make a chunk)
        assert max(report.moved) <= len(X) * (1 if rows == 10_000 else 25 if rows == 100 else 8)
    assert results[0] == results[1] == results[2]


def test_descent_start_finds_near_copies(spark):
    """Groups of near copies far apart: the first graph has nearly all their
    neighbours, so few rounds follow."""
    from fusekit.operators.knn_graph import Report
    rng = np.random.default_rng(13)
    X = np.repeat(rng.normal(size=(60, 24)), 50, axis=0) + 0.01 * rng.normal(size=(3000, 24))
    report = Report()
    got = knn_self_join(numbered(spark, X[rng.permutation(len(X))]), k=3, method="descent", report=report).collect()
    assert len(got) == 9000 and report.changed[0] <= 0.05 * 3000 * 32


# ------------------------------------------------------------- exact method: groups of cells
def test_small_cells_are_packed_into_few_groups():
    from fusekit.operators.knn import _packed
    counts = np.full(2048, 64)
    counts[5] = 40_000
    place, cells, groups = _packed(counts, np.arange(2048), 8192)
    assert len(place) == 2048 and place[5][1] == 5 and sorted(set(cells)) == list(range(2048))
    # groups x groups tasks: not cells x cells
    assert list(groups) == sorted(groups) and len(set(groups)) <= 2 + 5 + 2048 * 64 // 8192


def test_knn_over_several_groups_matches_brute_force(spark, monkeypatch):
    """Cut cells, packed cells, several steps a group; text ids, no clusters."""
    from fusekit.operators import knn
    monkeypatch.setattr(knn, "GROUP_ROWS", 40)
    rng = np.random.default_rng(21)
    X = np.vstack([rng.uniform(size=(150, 24)), rng.normal(5, 0.01, size=(110, 24))])
    ids = [f"{i:03}.png" for i in rng.permutation(len(X))]
    df = spark.createDataFrame([(i, x.tolist()) for i, x in zip(ids, X)], "id string, x array<double>")
    got = knn_dict(knn.knn_self_join(df, k=3, cell_size=100, block=16))
    assert got == brute_knn(ids, X, 3)
