"""Writers (OP-W1..W4).

Every write is a distributed Spark write; a re-run replaces only the
splits it produces (dynamic partition overwrite).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import global_index

# Rows per batch folder (image features / sequence features).
IMAGE_SAVE_BATCH = 500
SEQUENCE_SAVE_BATCH = 256


def observed(df: DataFrame, name: str = "progress"):
    """OP-A10: attach row counters (total and per-split when present) that
    are filled in by the job that consumes ``df`` -- no second pass, unlike
    a count followed by a write.  Returns (df, Observation); read the
    numbers with ``observation.get`` after the action."""
    from pyspark.sql import Observation
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows")]
    if "split" in df.columns:
        for s in ("train", "dev", "test"):
            metrics.append(F.count(F.when(F.col("split") == s, 1)).alias(f"rows_{s}"))
    return df.observe(obs, *metrics), obs


def write_split(df: DataFrame, path: str, partition_cols=("split",), mode: str = "overwrite",
                observe: bool = False) -> dict | None:
    """OP-W1: Parquet (snappy), partitioned by split; with
    ``partitionOverwriteMode=dynamic`` only the written splits are replaced.
    With ``observe=True`` returns the row counters observed during the
    write (OP-A10).  Caveat (Spark): after a session has used an
    ``Observation``, score with saved-and-loaded models rather than freshly
    fitted ones (their training summary references the session)."""
    obs = None
    if observe:
        df, obs = observed(df)
    (df.write.mode(mode)
     .option("partitionOverwriteMode", "dynamic")
     .option("compression", "snappy")
     .partitionBy(*partition_cols).parquet(path))
    return obs.get if obs is not None else None


def write_bucketed(df: DataFrame, path: str, key: str = "filename", buckets: int = 64) -> DataFrame:
    """Feature tables bucketed and sorted by the join key, so that a fuse join on
    the same key and bucket count needs no shuffle.  Returns the written table.

    Rows are dealt by the key first, so a bucket is one file.  The buckets are
    known to the catalog only while the table is read; its files stay."""
    import uuid
    name = f"bucketed_{uuid.uuid4().hex}"
    spark = df.sparkSession
    (df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
     .option("path", path).format("parquet").saveAsTable(name))
    table = spark.table(name)  # resolved here; the name is not needed again
    spark.sql(f"DROP TABLE {name}")
    return table


def manifest_json_col():
    """OP-F11: JSON text of a record, fields in the order id, img, label,
    text; a null label is written as null (not omitted)."""
    return F.to_json(F.struct("id", "img", "label", "text"), {"ignoreNullFields": "false"})


def write_manifest(df: DataFrame, path: str) -> None:
    """OP-W2: JSON lines, one folder per split, nulls kept."""
    (df.select("id", "img", "label", "text", "split").write.mode("overwrite")
     .option("ignoreNullFields", "false").partitionBy("split").json(path))


def batch_numbers(df: DataFrame, order_col: str, batch_size: int,
                  split_col: str = "split") -> DataFrame:
    """OP-W3/A9: batch number = floor(position / batch_size), position
    counted per split in ``order_col`` order; plus the number of batches of
    the split (ceil(rows / batch_size)).  A pure function of the data, so a
    re-run never continues numbering from stale folders."""
    idx = global_index(df, [split_col, order_col], out_col="_g")
    per = idx.groupBy(split_col).agg(F.min("_g").alias("_g0"), F.count(F.lit(1)).alias("_n"))
    out = idx.join(F.broadcast(per), split_col)
    return (out.withColumn("batch", F.floor((F.col("_g") - F.col("_g0")) / F.lit(batch_size)).cast("bigint"))
            .withColumn("n_batches", F.ceil(F.col("_n") / F.lit(batch_size)).cast("bigint"))
            .drop("_g", "_g0", "_n"))


def write_batched(df: DataFrame, path: str, order_col: str, batch_size: int) -> None:
    """OP-W3: bounded batches on disk: files of at most ``batch_size`` rows
    with their batch number as a column, one folder per split.  A rewrite
    replaces a split whole, so no batch of a longer earlier run stays."""
    b = batch_numbers(df, order_col, batch_size).drop("n_batches")
    (b.repartition("split", "batch").sortWithinPartitions("split", "batch").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .option("maxRecordsPerFile", batch_size)
     .partitionBy("split").parquet(path))


def write_csv_single(df: DataFrame, path: str) -> None:
    """OP-W4: one CSV file with a header.  For small outputs only (e.g. a
    predictions report); large outputs use ``write_split``."""
    # a shuffle, so that what is upstream keeps its tasks
    df.repartition(1).write.mode("overwrite").option("header", True).csv(path)
