"""Label checks, counts and class weights (OP-P4..P6, OP-A1..A4).

All are one aggregate over the table with a ``split`` column -- one job
for every split instead of one per split.  Results are a handful of rows;
only the gate (``enforce_labels``) brings them to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

VALID_CLASSES = (0, 1)


def split_counts(df: DataFrame) -> DataFrame:
    """OP-A1: rows per split."""
    return df.groupBy("split").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def class_counts(df: DataFrame, by=("split",)) -> DataFrame:
    """OP-A2: rows per (split, label); a null label is its own group."""
    return df.groupBy(*by, "label").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def validate_labels(df: DataFrame) -> DataFrame:
    """OP-P4: per split, labels outside 0..1 and (added) null labels.
    Three-valued logic: the range test alone never counts a null."""
    bad = (F.col("label") < 0) | (F.col("label") > 1)
    return df.groupBy("split").agg(
        F.count(F.when(bad, F.lit(1))).cast("bigint").alias("n_invalid"),
        F.count(F.when(F.col("label").isNull(), F.lit(1))).cast("bigint").alias("n_null"),
        F.count(F.lit(1)).cast("bigint").alias("n_rows"))


class InvalidLabels(RuntimeError):
    pass


def enforce_labels(report: DataFrame, stop_on=("dev",), warn_on=("test",)) -> list[str]:
    """OP-P5: gate on the OP-P4 report (a few rows).  Invalid labels in a
    ``stop_on`` split raise; in a ``warn_on`` split they give a warning
    (an unlabelled test split is legal).  Returns the warnings."""
    warnings = []
    for row in report.where(F.col("n_invalid") > 0).collect():
        if row["split"] in stop_on:
            raise InvalidLabels(f"{row['split']} has {row['n_invalid']} rows with labels outside 0..1")
        if row["split"] in warn_on:
            warnings.append(f"{row['split']} has {row['n_invalid']} rows with labels outside 0..1")
    return warnings


def class_weights(df: DataFrame) -> DataFrame:
    """OP-A3/A4: balanced weights total / (n_classes * count) over the
    known classes (OP-P6); if fewer than two classes are present every
    known class gets 1.0.  Output: label, n, weight -- one row per class
    in ``VALID_CLASSES``.  The window runs over the <= 2 aggregated rows."""
    counts = (df.where(F.col("label").isin(*VALID_CLASSES))
              .groupBy("label").agg(F.count(F.lit(1)).cast("bigint").alias("n")))
    classes = df.sparkSession.createDataFrame([(c,) for c in VALID_CLASSES], "label int")
    whole = Window.partitionBy()
    per = classes.join(counts, "label", "left").withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))
    total = F.sum("n").over(whole)
    present = F.sum(F.when(F.col("n") > 0, 1).otherwise(0)).over(whole)
    weight = F.when(present < 2, F.lit(1.0)).otherwise(total / (present * F.col("n")))
    return per.select("label", "n", weight.cast("double").alias("weight"))


def attach_weights(df: DataFrame, weights: DataFrame, weight_col: str = "weight") -> DataFrame:
    """Attach class weights as a ``weightCol`` (small side: <= 2 rows)."""
    return df.join(F.broadcast(weights.select("label", F.col("weight").alias(weight_col))),
                   "label", "left")
