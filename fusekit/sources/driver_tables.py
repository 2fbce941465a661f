"""Stage inputs derived from the driver's Parquet tables.

The reference dataset (image+text posts) is not shipped, so each stage
input is derived from the given tables by a fixed rule:

* manifest (D0)      = documents LEFT JOIN labels; id = doc_id,
                       img = 'img/' + zero-padded id + '.png', label = toxic
* split              = seeded md5 draw on the id: train < 0.85 <= dev < 0.90 <= test
* image features (D8)= embeddings; filename from vec_id by the same rule;
                       binary label = (label < 3)
* word vectors (D5)  = for every distinct token of the corpus whose md5 does
                       not start with '0' (so some words are out of
                       vocabulary), ``dim`` numbers drawn from its md5

Every read selects only the columns it needs, so scans are pruned.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.arrays import image_name
from ..functions.hashing import unit_draw
from ..functions.text import tokenize

# Split proportions (8500 / 500 / 1000 posts in the reference).
TRAIN_UPPER = 0.85
DEV_UPPER = 0.90
# Fixed value: an image-side class is "positive" when the source label < 3.
IMAGE_POSITIVE_BELOW = 3
# Derived image files: pixels a side.
IMAGE_SIDE = 8
# Fixed value: the width of the reference's word vectors.
WORD_VECTOR_DIM = 300
# Derived word vectors that a task holds at a time.
VECTORS_DRAWN = 2048


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Session option: deal scanned texts out over so many partitions.  For inputs
# whose files a scan cannot split (one row group); unset, nothing is moved.
SCAN_PARTITIONS_CONF = "fusekit.scan.partitions"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, text) of the documents."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    n = spark.conf.get(SCAN_PARTITIONS_CONF, None)
    return docs.repartition(int(n)) if n else docs


def split_of(id_col: Column) -> Column:
    u = unit_draw("split", id_col)
    return (F.when(u < F.lit(TRAIN_UPPER), F.lit("train"))
            .when(u < F.lit(DEV_UPPER), F.lit("dev"))
            .otherwise(F.lit("test")))


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The posts without their labels: id, img, text, split.  Nothing that
    needs no label joins the labels."""
    return documents(spark, sf_dir).select(
        "id", F.concat(F.lit("img/"), image_name(F.col("id"))).alias("img"), "text",
        split_of(F.col("id")).alias("split"))


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D0 with a split column: id, img, label, text, split.

    ``labels`` covers only part of ``documents``; unlabelled posts keep a
    null label, and a document labelled twice keeps its larger label.  The
    join is a plain equi-join: AQE turns it into a broadcast only when the
    measured size of ``labels`` is small."""
    labels = (table(spark, sf_dir, "labels").groupBy(F.col("doc_id").alias("id"))
              .agg(F.max("toxic").cast("int").alias("label")))
    return posts(spark, sf_dir).join(labels, "id", "left").select("id", "img", "label", "text", "split")


def image_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D8 with a split column: filename, label, resnet_features, split."""
    emb = table(spark, sf_dir, "embeddings")
    return emb.select(
        image_name(F.col("vec_id")).alias("filename"),
        (F.col("label") < F.lit(IMAGE_POSITIVE_BELOW)).cast("int").alias("label"),
        F.col("embedding").alias("resnet_features"),
        split_of(F.col("vec_id")).alias("split"),
    )


def image_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The set of landed image files (one row per file name)."""
    return table(spark, sf_dir, "embeddings").select(image_name(F.col("vec_id")).alias("filename"))


def image_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 as files (path, content): ``<class>/<filename>``, an 8 x 8 grey PNG
    with the value 128 + 256 * x (rounded down, 0..255) of each image feature.
    Of every ten ids one file is cut short (3) and one is named .PNG (4)."""
    from ..sinks.files import grey_png
    from .images import NEGATIVE_FOLDER, POSITIVE_FOLDER
    rows = image_features(spark, sf_dir)
    rest = F.regexp_extract("filename", r"\d+", 0).cast("long") % 10
    folder = F.when(F.col("label") == 1, POSITIVE_FOLDER).otherwise(NEGATIVE_FOLDER)
    name = F.when(rest == 4, F.regexp_replace("filename", "png$", "PNG")).otherwise(F.col("filename"))
    rows = rows.select(F.concat(folder, F.lit("/"), name).alias("path"), (rest == 3).alias("cut"),
                       F.slice("resnet_features", 1, IMAGE_SIDE ** 2).alias("x"))

    def draw(batches):
        for batch in batches:
            x = np.array(batch.column("x").to_pylist(), np.float64).reshape(-1, IMAGE_SIDE, IMAGE_SIDE)
            grey = np.clip(np.floor(128 + 256 * x), 0, 255).astype(np.uint8)
            files = [grey_png(g)[:40] if cut else grey_png(g) for g, cut in zip(grey, batch.column("cut").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(files, pa.binary())], names=["path", "content"])

    return rows.mapInArrow(draw, "path string, content binary")


def word_vectors(spark: SparkSession, sf_dir: str, dim: int = WORD_VECTOR_DIM,
                 tokens: DataFrame | None = None, tokens_col: str = "text_tokens",
                 distinct_tokens: DataFrame | None = None) -> DataFrame:
    """D5 as a table (token, vector array<float>), derived from the corpus.
    ``tokens`` may pass an already tokenised copy of ``documents``, or
    ``distinct_tokens`` its distinct tokens (column ``token``).

    Distinct tokens are found with a partial (map-side) aggregate, so a
    very frequent word costs one row per partition, not one per use."""
    if distinct_tokens is not None:
        tokens = distinct_tokens.select("token")
    else:
        if tokens is None:
            tokens = documents(spark, sf_dir).select(tokenize(F.col("text")).alias(tokens_col))
        tokens = tokens.select(F.explode(F.col(tokens_col)).alias("token")).distinct()
    kept = tokens.where(F.substring(F.md5(F.col("token")), 1, 1) != F.lit("0"))
    digest = F.md5(F.col("token"))
    kept = kept.select("token", *[F.conv(F.substring(digest, at, 8), 16, 10).cast("long").alias(c) for c, at in (("a", 1), ("b", 9))])
    i = np.arange(dim, dtype=np.int64)

    def draw(batches):
        # number i is (a * (i + 1) + b * i * i) mod 2^32 as a share, less a half
        for batch in batches:
            for lo in range(0, batch.num_rows, VECTORS_DRAWN):
                part = batch.slice(lo, VECTORS_DRAWN)
                ab = [part.column(c).to_numpy()[:, None] for c in ("a", "b")]
                x = ((ab[0] * (i + 1) + ab[1] * i * i) % 2**32 / 2**32 - 0.5).astype(np.float32)
                ends = pa.array(np.arange(len(x) + 1) * dim, pa.int32())
                yield pa.RecordBatch.from_arrays([part.column("token"), pa.ListArray.from_arrays(ends, pa.array(x.ravel()))], names=["token", "vector"])

    return kept.mapInArrow(draw, "token string, vector array<float>")
