"""Feature fusion (OP-J1, OP-J2, OP-P3, OP-F1, OP-F3, OP-F4, OP-P8).

One inner equi-join on the image base name, then ``concat`` and
``array_to_vector`` -- all built-ins, so the join output, the concat and
the vector build stay in one codegen stage.  The join is a shuffle join on
``filename`` unless AQE measures one side small enough to broadcast.  Feature
tables that are fused more than once are written bucketed by ``filename``
(``sinks.writers.write_bucketed``), and ``fuse_bucketed`` joins them without a
shuffle: bucket meets bucket, and the rows come sorted from their files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import basename, concat_features, to_vector
from ..session import scratch_path


class EmptyJoin(RuntimeError):
    """Raised by ``require_rows`` when a fused split matched nothing."""


def text_side(text_df: DataFrame, feature_col: str = "text_embedding",
              path_col: str = "img") -> DataFrame:
    """Keyed text features: (filename, feature).  The text-side label is
    dropped (OP-P3): the image-side (folder) label wins."""
    return text_df.select(basename(F.col(path_col)).alias("filename"), F.col(feature_col))


def fuse(image_df: DataFrame, other_df: DataFrame, image_col: str = "resnet_features",
         other_col: str = "text_embedding", out_col: str = "multimodal_features",
         key: str = "filename", with_vector: bool = True) -> DataFrame:
    """OP-J1/J2: inner join on ``key``; unmatched rows drop on both sides,
    duplicate keys multiply (as in the reference).  The image vector comes
    first in the fused vector.  Extra image-side columns (e.g. ``split``)
    are carried through."""
    other = other_df.select(key, other_col)
    joined = image_df.join(other, key, "inner")
    carry = [c for c in image_df.columns if c not in (key, image_col, other_col)]
    cols = [F.col(key)] + [F.col(c) for c in carry] + [
        concat_features(F.col(image_col), F.col(other_col)).alias(out_col)]
    out = joined.select(*cols)
    if with_vector:
        out = out.withColumn("features_vector", to_vector(F.col(out_col)))
    return out


def fuse_bucketed(image_df: DataFrame, other_df: DataFrame, buckets: int, image_col: str = "resnet_features",
                  other_col: str = "text_embedding", key: str = "filename", **options) -> DataFrame:
    """OP-J1/J2, co-located: both sides are written once, in ``buckets`` buckets
    by ``key``, and joined bucket by bucket.  ``buckets`` is the number of tasks
    of the join: choose it so that a bucket of both sides fits one."""
    from ..sinks.writers import write_bucketed
    spark = image_df.sparkSession
    image = write_bucketed(image_df, scratch_path(spark, "fuse-image"), key, buckets)
    other = write_bucketed(other_df.select(key, other_col), scratch_path(spark, "fuse-other"), key, buckets)
    # without the hint Spark would send a side that it measures as small to all tasks
    return fuse(image, other.hint("merge"), image_col, other_col, key=key, **options)


def require_rows(df: DataFrame) -> DataFrame:
    """OP-P8: stop a split whose join matched nothing (``isEmpty`` reads at
    most one row, no full count)."""
    if df.isEmpty():
        raise EmptyJoin("join matched no rows")
    return df
