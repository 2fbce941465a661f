"""Plan-shape regression tests for the scale properties claimed in the README."""

from fusekit.operators.fuse import fuse, fuse_bucketed
from fusekit.operators.sequence import sequence_embed
from fusekit.plans import stages
from tests.conftest import SMOKE


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_expanded_vectors_never_move(spark):
    """Exchanges of the look-up: tokens and vectors by token, replies by chunk,
    chunks by number; none above the expansion."""
    posts = spark.createDataFrame([(i, f"img/{i}.png", ["a", "b"], 0, "train") for i in range(50)],
                                  "id long, img string, text_tokens array<string>, label int, split string")
    vec = spark.createDataFrame([("a", [1.0]), ("b", [2.0])], "token string, vector array<float>")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = physical(sequence_embed(posts, vec, dim=1, max_tokens=4))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan[:plan.index("MapInArrow") + 10] and "Broadcast" not in plan
    assert plan.count("Exchange hashpartitioning") <= 4


def test_colocated_fuse_has_no_exchange(spark):
    img = spark.createDataFrame([(f"{i}.png", 1, [float(i)]) for i in range(200)], "filename string, label int, resnet_features array<float>")
    txt = spark.createDataFrame([(f"{i}.png", [float(-i)]) for i in range(100, 300)], "filename string, text_embedding array<float>")
    fused = fuse_bucketed(img, txt, buckets=4)
    plan = physical(fused)
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Bucketed: true" in plan.replace("bucketed: true", "Bucketed: true")
    want = fuse(img, txt).collect()
    assert sorted(fused.collect()) == sorted(want) and len(want) == 100
    # no table stays behind
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]


def test_colocated_fuse_keeps_repeated_keys(spark):
    img = spark.createDataFrame([("a.png", 1, [1.0]), ("a.png", 0, [2.0]), (None, 1, [9.0])], "filename string, label int, resnet_features array<float>")
    txt = spark.createDataFrame([("a.png", [3.0])] * 2 + [(None, [4.0])], "filename string, text_embedding array<float>")
    assert sorted(fuse_bucketed(img, txt, 3).collect()) == sorted(fuse(img, txt).collect())
    assert fuse_bucketed(img.limit(0), txt, 3).count() == 0


def test_scans_read_only_needed_columns(spark):
    plan = physical(stages.manifest(spark, SMOKE).select("id", "split"))
    assert "ReadSchema: struct<doc_id:bigint>" in plan or "struct<doc_id:bigint>" in plan
    # keys and labels only: the 64-wide vectors are not read at all
    plan = physical(stages.fused(spark, SMOKE).select("filename", "label"))
    assert "embedding:array" not in plan and "struct<vec_id:bigint" in plan


def test_word_vector_numbers_are_parsed_once(spark, tmp_dir):
    from fusekit.sources.wordvec import read_word_vectors
    path = f"{tmp_dir}/v"
    lines = ["2 3", "a 1.5 -2 3e1  ", "b 1 x 3", "c 1 2", "a 4 5 6", "d NaN 1 2", "e", ""]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    vectors = read_word_vectors(spark, path, 3)
    got = {r.token: [str(x) for x in r.vector] for r in vectors.collect()}
    assert got == {"a": ["4.0", "5.0", "6.0"], "d": ["nan", "1.0", "2.0"]}
    plan = vectors._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("slice(") == 1 and "lambdafunction(try_cast" not in plan


def test_training_input_is_spread_by_its_rows(spark):
    from fusekit.operators.classify import training_input
    df = spark.range(40_000).toDF("a")
    assert training_input(df).rdd.getNumPartitions() == 5 and training_input(df.limit(100)).rdd.getNumPartitions() == 1
