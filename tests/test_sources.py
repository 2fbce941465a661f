import io
import json
import os
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fusekit.schemas import IMAGE_FEATURES
from fusekit.sources.images import (image_read_report, index_images, label_from_path, read_image_bytes,
                                   read_images)
from fusekit.sources.manifest import land_images, read_manifest, read_or_empty, read_split
from fusekit.sources.npy import read_npy_batches, read_report, write_npy_batches
from fusekit.sources.wordvec import read_word_vectors, word_vector_report


def png_bytes(w, h, channels=3, seed=0):
    """A valid PNG (colour type 2 = RGB, 0 = grey, 6 = RGBA) built with zlib."""
    rng = np.random.default_rng(seed)
    ctype = {1: 0, 3: 2, 4: 6}[channels]
    raw = b"".join(b"\x00" + rng.integers(0, 255, w * channels, dtype=np.uint8).tobytes() for _ in range(h))

    def chunk(tag, data):
        return struct.pack(">I", len(data)) + tag + data + struct.pack(">I", zlib.crc32(tag + data) & 0xFFFFFFFF)

    ihdr = struct.pack(">IIBBBBB", w, h, 8, ctype, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", ihdr) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def write(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


def test_read_manifest_schema_and_alias(spark, tmp_dir):
    recs = [{"id": 1, "img": "img/00001.png", "label": 0, "text": 'say "hi"\nthere'},
            {"id": 2, "img": "00002.png", "label": None, "text": "ünïcode"},
            {"id": 3, "img": "img/00003.png", "label": 1, "text": None}]
    p = os.path.join(tmp_dir, "validation.jsonl")
    with open(p, "w") as f:
        f.write("\n".join(json.dumps(r, ensure_ascii=False) for r in recs))
    df = read_manifest(spark, p, split="validation")
    assert df.schema.simpleString() == "struct<id:bigint,img:string,label:int,text:string,split:string>"
    rows = {r.id: r for r in df.collect()}
    assert rows[1].text == 'say "hi"\nthere' and rows[2].label is None and rows[3].split == "dev"


def test_land_images_keeps_and_rejects(spark):
    m = spark.createDataFrame([(1, "img/a.png"), (2, "img/b.png"), (3, "c.png")], "id long, img string")
    files = spark.createDataFrame([("a.png",), ("c.png",)], "filename string")
    landed, rejected = land_images(m, files)
    assert sorted(r.id for r in landed.collect()) == [1, 3]
    assert [r.id for r in rejected.collect()] == [2]


def test_folder_labels_with_quirks(spark):
    df = spark.createDataFrame([(p,) for p in [
        "x/image_train/hateful/a.png", "x/image_train/Hateful/a.png", "x/image_train/non_hateful/a.png",
        "x/image_train/non-hateful/a.png", "x/image_train/other/a.png"]], "p string")
    assert [r[0] for r in df.select(label_from_path(F.col("p"))).collect()] == [1, 1, 0, 1, 0]


def test_index_and_read_images(spark, tmp_dir):
    split_dir = os.path.join(tmp_dir, "image_train")
    write(f"{split_dir}/hateful/a.png", png_bytes(8, 6))
    write(f"{split_dir}/non_hateful/b.png", png_bytes(5, 5, channels=1, seed=1))
    write(f"{split_dir}/non_hateful/c.png", png_bytes(4, 4, channels=4, seed=2))
    write(f"{split_dir}/non_hateful/d.PNG", png_bytes(4, 4))          # wrong case: not listed
    write(f"{split_dir}/non_hateful/e.jpg", b"not an image")            # wrong extension
    write(f"{split_dir}/hateful/broken.png", png_bytes(8, 8)[:40])      # truncated
    write(f"{split_dir}/empty_class/.keep", b"")
    idx = index_images(spark, split_dir)
    got = {r.filename: r.label for r in idx.collect()}
    assert got == {"a.png": 1, "b.png": 0, "c.png": 0, "broken.png": 1}
    assert read_image_bytes(spark, split_dir).where(F.col("filename") == "a.png").first().content[:4] == b"\x89PNG"
    decoded = read_images(spark, split_dir)
    names = sorted(os.path.basename(r.image.origin) for r in decoded.collect())
    assert "broken.png" not in names and set(names) == {"a.png", "b.png", "c.png"}
    rep = {r.decoded: r["count"] for r in image_read_report(spark, split_dir).groupBy("decoded").count().collect()}
    assert rep == {True: 3, False: 1}


def test_word_vectors_reader(spark, tmp_dir):
    p = os.path.join(tmp_dir, "vec.txt")
    with open(p, "w") as f:
        f.write("4 3\n")                 # header: width 1 -> dropped
        f.write("the 1 2 3\n")
        f.write("The 4 5 6\n")           # differs by case: separate token
        f.write("bad 1 x 3\n")           # bad number -> dropped
        f.write("short 1 2\n")           # wrong width -> dropped
        f.write("the 7 8 9\n")           # duplicate: last wins
    got = {r.token: r.vector for r in read_word_vectors(spark, p, 3).collect()}
    assert got == {"the": [7.0, 8.0, 9.0], "The": [4.0, 5.0, 6.0]}
    with pytest.raises(Exception):
        read_word_vectors(spark, p, 3, mode="FAILFAST").collect()
    assert {r.kind: r.n_lines for r in word_vector_report(spark, p, 3).collect()} == {"vector": 3, "header": 1, "bad": 2}


def test_word_vectors_trailing_space_and_failfast_width(spark, tmp_dir):
    p = os.path.join(tmp_dir, "vec.txt")
    with open(p, "w") as f:
        f.write("2 3\nthe 1 2 3 \nof 4 5 6  \n")
    want = {"the": [1.0, 2.0, 3.0], "of": [4.0, 5.0, 6.0]}
    for mode in ("DROP", "FAILFAST"):
        assert {r.token: r.vector for r in read_word_vectors(spark, p, 3, mode=mode).collect()} == want
    with open(p, "a") as f:
        f.write("short 1 2\n")
    with pytest.raises(Exception):
        read_word_vectors(spark, p, 3, mode="FAILFAST").collect()


def test_npy_batches_of_two_splits_stay_apart(spark, tmp_dir):
    for split, value in (("train", 1.0), ("dev", 2.0)):
        save_batch(os.path.join(tmp_dir, split), "batch_0000", np.full((2, 4), value, np.float32), np.array([0, 1], np.int32),
                   np.array([f"{split}_{i}.png" for i in range(2)]))
    rows = read_npy_batches(spark, tmp_dir, "resnet_features", "x").collect()
    assert {(r.filename, r.split, r.x[0]) for r in rows} == {(f"{s}_{i}.png", s, v) for s, v in (("train", 1.0), ("dev", 2.0)) for i in range(2)}


def save_batch(base, name, feats, labels, names, feature_file="resnet_features"):
    d = os.path.join(base, name)
    os.makedirs(d, exist_ok=True)
    for fn, arr in ((feature_file, feats), ("labels", labels), ("filenames", names)):
        with open(os.path.join(d, fn + ".npy"), "wb") as f:
            np.save(f, arr)


def test_npy_batches(spark, tmp_dir):
    base = os.path.join(tmp_dir, "train")
    save_batch(base, "batch_2", np.ones((2, 4), np.float32), np.array([0, 1], np.int32), np.array(["a.png", "b.png"]))
    save_batch(base, "batch_10", np.zeros((1, 4), np.float32), np.array([1], np.int32), np.array(["c.png"]))
    save_batch(base, "batch_3", np.zeros((3, 4), np.float32), np.array([1], np.int32), np.array(["d.png"]))  # mismatch
    save_batch(base, "batch_4", np.zeros((1, 4), np.float32), np.array([1], np.int32), np.array(["e.png"]))
    with open(os.path.join(base, "batch_4", "labels.npy"), "wb") as f:
        f.write(b"\x93NUMPY truncated")                                                                   # unreadable
    os.makedirs(os.path.join(base, "batch_5"))
    np.save(os.path.join(base, "batch_5", "resnet_features.npy"), np.zeros((1, 4), np.float32))           # missing parts
    df = read_npy_batches(spark, base, "resnet_features", "resnet_features")
    rows = {r.filename: r for r in df.collect()}
    assert set(rows) == {"a.png", "b.png", "c.png"}
    assert rows["b.png"].label == 1 and rows["c.png"].batch == "batch_10" and rows["a.png"].resnet_features == [1.0] * 4
    assert read_report(spark, base, "resnet_features").where("bad").count() == 3
    with pytest.raises(Exception):
        read_npy_batches(spark, base, "resnet_features", "resnet_features", mode="FAILFAST").collect()


def npy_rows(spark, n, split="train", size=4):
    rows = [(split, i // size, f"{i:03}.png", i % 2, [float(i), float(-i)]) for i in range(n)]
    return spark.createDataFrame(rows, "split string, batch long, filename string, label int, x array<float>")


def test_npy_write_and_read(spark, tmp_dir):
    base = os.path.join(tmp_dir, "npy")
    write_npy_batches(npy_rows(spark, 10).unionByName(npy_rows(spark, 3, "dev")), base, "x", "feats")
    assert sorted(os.listdir(os.path.join(base, "train"))) == ["batch_0", "batch_1", "batch_2"]
    assert np.load(os.path.join(base, "train", "batch_2", "feats.npy")).tolist() == [[8.0, -8.0], [9.0, -9.0]]
    df = read_npy_batches(spark, base, "feats", "y", mode="FAILFAST")
    assert sorted((r.split, r.batch, r.filename, r.label, r.y[0]) for r in df.collect()) == sorted(
        (s, f"batch_{i // 4}", f"{i:03}.png", i % 2, float(i)) for s, n in (("train", 10), ("dev", 3)) for i in range(n))
    # one partition a folder, nothing is shuffled
    assert df.rdd.getNumPartitions() == 4 and "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    # a rewrite replaces the splits that it holds, whole
    write_npy_batches(npy_rows(spark, 2), base, "x", "feats")
    assert sorted(os.listdir(os.path.join(base, "train"))) == ["batch_0"] and os.path.exists(os.path.join(base, "dev", "batch_0"))
    assert not [d for d, _, files in os.walk(base) if "_staging" in d and files]
    assert read_npy_batches(spark, os.path.join(tmp_dir, "nothing"), "feats", "y").count() == 0


def test_npy_split_pruning(spark, tmp_dir):
    base = os.path.join(tmp_dir, "npy")
    write_npy_batches(npy_rows(spark, 10).unionByName(npy_rows(spark, 3, "dev")), base, "x", "feats")
    one = read_npy_batches(spark, base, "feats", "y", split="dev")
    assert one.rdd.getNumPartitions() == 1 and one.count() == 3
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        pushed = read_npy_batches(spark, base, "feats", "y").where("split = 'dev'")
        assert pushed.rdd.getNumPartitions() == 1 and pushed.count() == 3
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_npy_failed_write_leaves_nothing(spark, tmp_dir):
    base = os.path.join(tmp_dir, "npy")
    write_npy_batches(npy_rows(spark, 4), base, "x", "feats")
    before = read_npy_batches(spark, base, "feats", "y").collect()
    fails = F.udf(lambda x, i: x if i != "017.png" else 1 / 0, "array<float>")
    broken = npy_rows(spark, 20).repartition(4).withColumn("x", fails("x", "filename"))
    with pytest.raises(Exception):
        write_npy_batches(broken, base, "x", "feats")
    assert read_npy_batches(spark, base, "feats", "y").collect() == before
    assert [f for _, _, files in os.walk(base) for f in files if "staging" in f] == []


def test_missing_input_is_empty_split(spark, tmp_dir):
    df = read_or_empty(spark, os.path.join(tmp_dir, "nope"), IMAGE_FEATURES)
    assert df.count() == 0 and df.schema == IMAGE_FEATURES


def test_read_split_prunes_partitions(spark, tmp_dir):
    p = os.path.join(tmp_dir, "t")
    spark.createDataFrame([(1, "train"), (2, "dev")], "id long, split string").write.partitionBy("split").parquet(p)
    df = read_split(spark, p, "dev")
    assert [r.id for r in df.collect()] == [2]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "split" in plan
