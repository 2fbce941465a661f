"""Standardisation, covariance and PCA (OP-A5, OP-M1, OP-M2).

Fit on train only, apply the same model to every split.  The scaler fit
is MLlib's ``Summarizer`` (a tree aggregate: only d means and variances
reach the driver).  The covariance is computed per partition with one
BLAS matrix product (X^T X on an Arrow batch) of which a task emits d row
vectors; they are summed by row number, so no d x d matrix per row is ever
materialised and no single task merges all partials.  PCA uses
Spark ML (its covariance is a JVM tree aggregate; the d x d eigen
decomposition runs on the driver, fine for d up to a few thousand).
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.ml.feature import PCA, PCAModel, StandardScaler, StandardScalerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import to_array, vector_width


def fit_scaler(train: DataFrame, input_col: str = "features_vector",
               output_col: str = "scaled_features") -> StandardScalerModel:
    """OP-A5: per-dimension mean and sample std (n - 1) on the train rows."""
    return StandardScaler(inputCol=input_col, outputCol=output_col,
                          withMean=True, withStd=True).fit(train)


def scale(model: StandardScalerModel, df: DataFrame) -> DataFrame:
    """OP-M1: (x - mean) / std; a zero-variance dimension gives 0."""
    return model.transform(df)


def scaler_stats(model: StandardScalerModel) -> DataFrame:
    """The fitted statistics as a table (dim, mean, std): d rows."""
    spark = model.sparkSession if hasattr(model, "sparkSession") else None
    from pyspark.sql import SparkSession
    spark = spark or SparkSession.getActiveSession()
    mean, std = model.mean.toArray(), model.std.toArray()
    rows = [(int(i), float(m), float(s)) for i, (m, s) in enumerate(zip(mean, std))]
    return spark.createDataFrame(rows, "dim bigint, mean double, std double")


def covariance(df: DataFrame, col: str) -> DataFrame:
    """Sample covariance in long form (i, j, cov) for i <= j.

    Each task reduces its Arrow batches to one Gram matrix X^T X with the
    sums as its last row and column (BLAS), and emits the d + 1 rows, each
    with the count at its end, as vectors, which are summed by row number on
    the JVM; then cov = (G_ij - s_i s_j / n) / (n - 1).  Input should be centred
    (e.g. standardised) for numerical accuracy, as for PCA."""
    arr = df.select(to_array(F.col(col)).alias("x")) if _is_vector(df, col) else \
        df.select(F.col(col).cast("array<double>").alias("x"))
    dim = vector_width(arr, "x")

    def gram(batches):
        import pandas as pd
        g, seen = np.zeros((dim + 1, dim + 1)), False
        for pdf in batches:
            if len(pdf):
                x = np.hstack([np.stack(pdf["x"].to_numpy()).astype(np.float64), np.ones((len(pdf), 1))])
                g += x.T @ x
                seen = True
        if seen:
            rows = np.hstack([g, np.full((dim + 1, 1), g[dim, dim])])
            yield pd.DataFrame({"i": np.arange(dim + 1, dtype=np.int64), "row": list(rows)})

    parts = arr.mapInPandas(gram, schema="i bigint, row array<double>")
    tot = (parts.groupBy("i").agg(Summarizer.sum(array_to_vector("row")).alias("row"))
           .select("i", to_array(F.col("row")).alias("row")))
    cells = tot.select("i", F.element_at("row", -2).alias("si"), F.element_at("row", -1).alias("n"),
                       F.posexplode(F.slice("row", 1, max(dim, 1))).alias("j", "g"))
    # the last row is the sums, by position: d rows
    sums = cells.where(F.col("i") == dim).select("j", F.col("g").alias("sj"))
    cov = (F.col("g") - F.col("si") * F.col("sj") / F.col("n")) / (F.col("n") - 1)
    return (cells.where(F.col("i") <= F.col("j")).join(sums, "j")
            .select("i", F.col("j").cast("bigint").alias("j"), cov.alias("cov")))


def _is_vector(df: DataFrame, col: str) -> bool:
    from pyspark.ml.linalg import VectorUDT
    return isinstance(df.schema[col].dataType, VectorUDT)


def fit_pca(train: DataFrame, k: int, input_col: str = "scaled_features",
            output_col: str = "pca_features") -> PCAModel:
    """OP-M2: principal components of the (already scaled) train rows.
    ``PCAModel.transform`` projects without centring, so scale first."""
    return PCA(k=k, inputCol=input_col, outputCol=output_col).fit(train)
