"""SMOTE oversampling (OP-M3, OP-U2, OP-F5), distributed and repeatable.

SMOTE (Chawla et al., 2002): each synthetic row lies on the segment
between a minority row and one of its k nearest minority neighbours.
The reference collects the whole training matrix to the driver and runs a
single-machine resampler with no partition-independent order.  Here:

* minority rows are numbered 0..m-1 by (id, vector digest) with
  ``global_index`` (no single-task window); the number is the row key, so
  repeated ids (even one id on a third of the rows) stay distinct rows;
* synthetic row s (0 <= s < n_major - n_minor) draws, from md5 of
  (seed, s), a base row index (60 bits, so any row can be drawn), a
  neighbour rank in 1..k and a step in [0, 1) -- the same numbers at any partitioning, retry or engine;
* neighbour and vectors are attached by equi-joins on (index, rank)
  against the kNN table (OP-J5) and on the index;
* x_new = x + step * (nbr - x) with ``zip_with`` (JVM side);
* the balanced set is originals UNION synthetic (OP-U2), each row keeping
  its features and label together (OP-F5 fix).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import order_key, unit_draw
from .knn import knn_self_join
from .ordering import global_index

# Fixed values from the reference configuration.
K_NEIGHBORS = 3
SEED = 42


class TooFewMinority(ValueError):
    pass


def class_sizes(df: DataFrame, label_col: str = "label") -> dict:
    return {r[label_col]: r["n"] for r in
            df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n")).collect()}


def minority_label(sizes: dict) -> int:
    """The smaller of two classes (a tie picks the larger label)."""
    return sorted(sizes.items(), key=lambda kv: (kv[1], -kv[0]))[0][0]


def smote_synthetic(df: DataFrame, id_col: str = "filename", vec_col: str = "x",
                    label_col: str = "label", k: int = K_NEIGHBORS, seed: int = SEED,
                    knn: DataFrame | None = None, knn_options: dict | None = None) -> DataFrame:
    """Synthetic rows: s, base id, neighbour id, rank, step, label, x (array<double>).
    ``knn_options`` go to ``knn_self_join`` (``method``, ``cell_size``, ...).

    ``df`` has two classes; the minority is oversampled to the majority
    count.  Raises when the minority has k rows or fewer."""
    sizes = class_sizes(df, label_col)
    if len(sizes) != 2:
        raise ValueError(f"SMOTE needs exactly two classes, got {sorted(sizes)}")
    minor = minority_label(sizes)
    m = sizes[minor]
    n_syn = max(sizes.values()) - m
    if m <= k:
        raise TooFewMinority(f"minority class has {m} rows; need more than k={k}")
    spark = df.sparkSession
    # number the minority rows 0..m-1 by (id, vector digest): a dense unique
    # row key even when ids repeat; exact duplicate rows are interchangeable
    raw = df.where(F.col(label_col) == F.lit(minor)).select(
        F.col(id_col).alias("key"), F.col(vec_col).cast("array<double>").alias("x"))
    # exact duplicates are interchangeable, so global_index's row tie-breaker
    # may order them freely (and spread a hot group of copies)
    raw = raw.withColumn("_xd", F.xxhash64("x"))
    mino = global_index(raw, ["key", "_xd"], out_col="pid").drop("_xd")
    if knn is None:
        knn = knn_self_join(mino.select("pid", "x"), k=k, id_col="pid", vec_col="x", ids_unique=True, **(knn_options or {}))
    # the drawn row index is the row key, so three equi-joins attach the
    # neighbour and both vectors
    draws = spark.range(0, n_syn).select(
        F.col("id").alias("s"),
        F.pmod(order_key("smote", seed, F.col("id"), "base"), F.lit(m)).alias("pid"),
        (F.floor(unit_draw("smote", seed, F.col("id"), "nbr") * F.lit(k)) + 1).cast("int").alias("rank"),
        unit_draw("smote", seed, F.col("id"), "step").alias("step"))
    with_nbr = draws.join(knn.select("pid", "rank", F.col("nbr_pid")), ["pid", "rank"])
    xb = mino.select("pid", "key", F.col("x").alias("xb"))
    xn = mino.select(F.col("pid").alias("nbr_pid"), F.col("key").alias("nbr_key"), F.col("x").alias("xn"))
    full = with_nbr.join(xb, "pid").join(xn, "nbr_pid")
    new = F.zip_with(F.col("xb"), F.col("xn"), lambda a, b: a + F.col("step") * (b - a))
    return full.select("s", F.col("key").alias(f"base_{id_col}"), F.col("nbr_key").alias(f"nbr_{id_col}"),
                       "rank", "step", F.lit(minor).cast("int").alias(label_col), new.alias(vec_col))


def smote_balanced(df: DataFrame, synthetic: DataFrame, vec_col: str = "x",
                   label_col: str = "label") -> DataFrame:
    """OP-U2: originals plus synthetic rows (features, label, is_synthetic)."""
    orig = df.select(F.col(vec_col).cast("array<double>").alias("features"),
                     F.col(label_col).cast("int").alias("label"), F.lit(False).alias("is_synthetic"))
    syn = synthetic.select(F.col(vec_col).alias("features"), F.col(label_col).alias("label"),
                           F.lit(True).alias("is_synthetic"))
    return orig.unionByName(syn)
