"""Manifest records and split datasets (OP-S1, OP-S2, OP-S3, OP-S11)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.arrays import basename
from ..schemas import MANIFEST

# Fixed value: the source names its dev split "validation"; every later
# stage reads "dev".
SPLIT_ALIASES = {"validation": "dev"}


def canonical_split(split: str) -> str:
    return SPLIT_ALIASES.get(split, split)


def read_manifest(spark: SparkSession, path: str, split: str | None = None,
                  schema: T.StructType = MANIFEST) -> DataFrame:
    """OP-S1: JSON-lines records with a declared schema (never inferred).
    With ``split`` given, a ``split`` column is added (aliases mapped)."""
    df = spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)
    if split is not None:
        df = df.withColumn("split", F.lit(canonical_split(split)))
    return df


def land_images(manifest: DataFrame, images: DataFrame, image_key: str = "filename"):
    """OP-S2: a record is kept only if its image landed (the reference drops
    a record whose image upload failed); the rejects are returned too.
    ``images`` holds one row per landed file name.  Returns (landed,
    rejected): a left-semi and a left-anti join on the base name."""
    keyed = manifest.withColumn("_key", basename(F.col("img")))
    files = images.select(F.col(image_key).alias("_key"))
    landed = keyed.join(files, "_key", "left_semi").drop("_key")
    rejected = keyed.join(files, "_key", "left_anti").drop("_key")
    return landed, rejected


def read_split(spark: SparkSession, base: str, split: str | None = None,
               schema: T.StructType | None = None) -> DataFrame:
    """OP-S3: a dataset written ``partitionBy("split")``; filtering on the
    split prunes partitions (only that folder is listed and read)."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(base)
    return df if split is None else df.where(F.col("split") == F.lit(split))


def exists(spark: SparkSession, path: str) -> bool:
    """Hadoop FileSystem existence check (driver side, metadata only)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType,
                  fmt: str = "parquet") -> DataFrame:
    """OP-S11: a missing input is "no split" -- an empty DataFrame with the
    declared schema instead of an error or ``None``."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).format(fmt).load(path)
