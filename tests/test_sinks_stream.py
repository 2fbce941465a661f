import glob
import json
import os

import numpy as np
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.sql import functions as F

from fusekit.functions.arrays import to_vector
from fusekit.operators.encode import encode_images, prepare_images
from fusekit.sinks.models import load_model, publish_model, save_model
from fusekit.sinks.files import write_files
from fusekit.sinks.writers import (batch_numbers, manifest_json_col, write_batched, write_csv_single,
                                   write_manifest, write_split)
from fusekit.sources.images import read_images
from fusekit.streaming.ingest import run_ingest
from fusekit.streaming.scoring import score_stream
from tests.test_sources import png_bytes, write


def manifest_rows(spark):
    return spark.createDataFrame([(1, "img/00001.png", 0, "a", "train"), (2, "img/00002.png", None, "b", "dev"),
                                  (3, "img/00003.png", 1, "c\n\"q\"", "train")],
                                 "id long, img string, label int, text string, split string")


def test_write_split_replaces_only_its_splits(spark, tmp_dir):
    p = os.path.join(tmp_dir, "t")
    counts = write_split(manifest_rows(spark), p, observe=True)
    assert counts["rows"] == 3 and counts["rows_train"] == 2 and counts["rows_dev"] == 1
    write_split(spark.createDataFrame([(9, "img/9.png", 1, "z", "dev")], manifest_rows(spark).schema), p)
    got = sorted((r.id, r.split) for r in spark.read.parquet(p).collect())
    assert got == [(1, "train"), (3, "train"), (9, "dev")]


def test_manifest_json_keeps_null_label(spark, tmp_dir):
    m = manifest_rows(spark)
    js = [json.loads(r[0]) for r in m.select(manifest_json_col()).collect()]
    assert list(js[0]) == ["id", "img", "label", "text"] and js[1]["label"] is None
    p = os.path.join(tmp_dir, "raw")
    write_manifest(m, p)
    assert sorted(os.path.basename(d) for d in glob.glob(f"{p}/split=*")) == ["split=dev", "split=train"]


def test_batches_and_single_csv(spark, tmp_dir):
    df = spark.range(0, 1030).select(F.format_string("f%05d", "id").alias("filename"),
                                     F.when(F.col("id") < 1000, "train").otherwise("dev").alias("split"))
    b = batch_numbers(df, "filename", 256).collect()
    per = {}
    for r in b:
        per.setdefault((r.split, r.batch), 0)
        per[(r.split, r.batch)] += 1
    assert per == {("train", 0): 256, ("train", 1): 256, ("train", 2): 256, ("train", 3): 232, ("dev", 0): 30}
    assert {r.n_batches for r in b if r.split == "train"} == {4}
    p = os.path.join(tmp_dir, "batches")
    write_batched(df, p, "filename", 256)
    assert spark.read.parquet(p).where("split = 'train' AND batch = 3").count() == 232
    write_batched(df.where("filename < 'f00250'"), p, "filename", 256)
    assert spark.read.parquet(p).where("split = 'train'").count() == 250
    c = os.path.join(tmp_dir, "csv")
    write_csv_single(df.limit(5), c)
    files = glob.glob(f"{c}/part-*.csv")
    assert len(files) == 1 and open(files[0]).readline().strip() == "filename,split"


def test_model_store_roundtrip(spark, tmp_dir):
    df = spark.createDataFrame([(0, [0.0, 1.0]), (1, [1.0, 0.0])] * 5, "label int, x array<double>") \
        .withColumn("features", to_vector(F.col("x")))
    m = LogisticRegression(maxIter=5).fit(df)
    path, size = publish_model(spark, m, os.path.join(tmp_dir, "best"))
    assert path and size > 0
    got = load_model(LogisticRegressionModel.load, [os.path.join(tmp_dir, "missing"), path])
    assert np.allclose(got.coefficients.toArray(), m.coefficients.toArray())
    assert load_model(LogisticRegressionModel.load, [os.path.join(tmp_dir, "x")], default=lambda: "d") == "d"
    save_model(m, os.path.join(tmp_dir, "final"))


def test_stream_ingest_equals_batch_and_dedups(spark, tmp_dir):
    m = manifest_rows(spark)
    land = os.path.join(tmp_dir, "landing")
    m.write.mode("overwrite").option("ignoreNullFields", "false").json(land)
    m.where("id = 1").write.mode("append").json(land)  # re-delivered record
    out = run_ingest(spark, land, os.path.join(tmp_dir, "table"), os.path.join(tmp_dir, "ckpt"))
    got = sorted(tuple(r) for r in out.select("id", "img", "label", "text", "split").collect())
    assert got == sorted(tuple(r) for r in m.collect())


def test_stream_ingest_bounded_memory_of_ids(spark, tmp_dir):
    m = manifest_rows(spark)
    land = os.path.join(tmp_dir, "landing")
    m.write.mode("overwrite").option("ignoreNullFields", "false").json(land)
    m.where("id = 1").write.mode("append").json(land)
    out = run_ingest(spark, land, os.path.join(tmp_dir, "table"), os.path.join(tmp_dir, "ckpt"), keep_for="1 hour")
    got = sorted(tuple(r) for r in out.select("id", "img", "label", "text", "split").collect())
    assert got == sorted(tuple(r) for r in m.collect())


def test_stream_scoring_equals_batch(spark, tmp_dir):
    df = spark.createDataFrame([(f"f{i}", i % 2, [float(i % 2), float(i % 3)]) for i in range(20)],
                               "filename string, label int, x array<double>").withColumn("features", to_vector(F.col("x")))
    model = LogisticRegression(maxIter=10).fit(df)
    src = os.path.join(tmp_dir, "src")
    df.select("filename", "features").write.parquet(src)
    schema = spark.read.parquet(src).schema
    mpath = os.path.join(tmp_dir, "model")
    save_model(model, mpath)
    model = LogisticRegressionModel.load(mpath)
    q = score_stream(spark, src, schema, mpath, LogisticRegressionModel.load,
                     os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck"))
    q.awaitTermination()
    streamed = sorted(tuple(r) for r in spark.read.parquet(os.path.join(tmp_dir, "out")).select("filename", "predicted_label").collect())
    batch = sorted(tuple(r) for r in model.transform(df).select("filename", F.col("prediction").cast("int")).collect())
    assert streamed == batch


def test_image_tensors_and_encoder(spark, tmp_dir):
    d = os.path.join(tmp_dir, "image_test")
    write(f"{d}/hateful/a.png", png_bytes(10, 7))
    write(f"{d}/non_hateful/b.png", png_bytes(6, 6, channels=1))
    write(f"{d}/non_hateful/c.png", png_bytes(6, 6, channels=4))
    px = prepare_images(read_images(spark, d), size=4)
    rows = {os.path.basename(r.path): r.pixels for r in px.collect()}
    assert set(rows) == {"a.png", "b.png", "c.png"} and all(len(v) == 4 * 4 * 3 for v in rows.values())

    def make():
        def f(x):
            return x.reshape(len(x), -1).mean(axis=1, keepdims=True).repeat(3, axis=1)
        return f

    enc = encode_images(px, make, size=4, dim=5).collect()
    assert all(len(r.resnet_features) == 5 and r.resnet_features[3:] == [0.0, 0.0] for r in enc)


def test_persisted_and_require_rows(spark):
    from fusekit.operators.fuse import EmptyJoin, require_rows
    from fusekit.session import persisted
    df = spark.range(10)
    with persisted(df) as d:
        assert d.is_cached and d.count() == 10
    assert not df.is_cached
    assert require_rows(df).count() == 10
    import pytest
    with pytest.raises(EmptyJoin):
        require_rows(df.where("id < 0"))


def test_bilinear_resize_properties():
    from fusekit.operators.encode import _resize_bilinear
    flat = np.full((5, 7, 3), 9.0, dtype=np.float32)
    assert np.allclose(_resize_bilinear(flat, 4), 9.0)            # constants stay constant
    ramp = np.tile(np.arange(8, dtype=np.float32)[None, :, None], (2, 1, 3))
    out = _resize_bilinear(ramp, 4)[0, :, 0]
    assert np.all(np.diff(out) > 0) and out[0] >= 0 and out[-1] <= 7  # monotone, in range
    same = np.random.default_rng(0).random((6, 6, 3)).astype(np.float32)
    assert np.allclose(_resize_bilinear(same, 6), same)           # identity size


def test_write_files_rewrites_the_same_paths(spark, tmp_dir):
    files = spark.createDataFrame([("a/x.bin", b"1"), ("a/y.bin", b""), ("b/x.bin", b"22")], "path string, content binary")
    assert write_files(files, tmp_dir) == 3
    assert write_files(files.limit(1), "file:" + tmp_dir) == 1
    assert write_files(files.limit(0), tmp_dir) == 0
    got = {p: open(os.path.join(tmp_dir, p), "rb").read() for p in ("a/x.bin", "a/y.bin", "b/x.bin")}
    assert got == {"a/x.bin": b"1", "a/y.bin": b"", "b/x.bin": b"22"}


def test_prepared_images_keep_file_and_label(spark, tmp_dir):
    write(f"{tmp_dir}/hateful/a.png", png_bytes(5, 4))
    write(f"{tmp_dir}/non_hateful/b.png", png_bytes(4, 4, channels=1))
    write(f"{tmp_dir}/hateful/cut.png", png_bytes(8, 8)[:40])
    got = {(r.filename, r.label, len(r.pixels)) for r in prepare_images(read_images(spark, tmp_dir), size=3).collect()}
    assert got == {("a.png", 1, 27), ("b.png", 0, 27)}
