"""Model store (OP-W5, OP-W6, OP-W7): Spark ML writers and readers on the
shared file system."""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import SparkSession


def save_model(model, path: str) -> str:
    """OP-W5: save (overwrite) any MLWritable model or pipeline."""
    model.write().overwrite().save(path)
    return path


def content_size(spark: SparkSession, path: str) -> int:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(hpath).getLength())


def publish_model(spark: SparkSession, model, path: str):
    """OP-W6: replace the stored model, verify it exists, report its size.
    Returns (path, size in bytes), or (None, 0) when the write failed."""
    try:
        save_model(model, path)
        return path, content_size(spark, path)
    except Exception:  # noqa: BLE001 - the reference reports failure as None
        return None, 0


def load_model(loader: Callable, paths: Sequence[str], default: Callable | None = None):
    """OP-W7: the first path that loads (e.g. best, then final), else
    ``default()``.  ``loader`` is e.g. ``PipelineModel.load``."""
    for p in paths:
        try:
            return loader(p)
        except Exception:  # noqa: BLE001 - try the next candidate
            continue
    if default is None:
        raise FileNotFoundError(f"no model could be loaded from {list(paths)}")
    return default()
