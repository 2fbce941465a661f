"""Image files: layout, listing, reading and labels from folders
(OP-S4, OP-S5, OP-S8, OP-S9, OP-P7).

The reference lists folders on the driver through Py4J and reads one file
at a time; here the listing and the reads are Spark file scans
(``binaryFile`` / ``image``), so they are split across executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.arrays import basename

# The class folder names written by the layout, and the
# substring tests that read a label back (lower-cased first).  A folder
# named "non-hateful" (hyphen) reads as 1 -- the reference's quirk, kept.
POSITIVE_FOLDER = "hateful"
NEGATIVE_FOLDER = "non_hateful"
UNLABELLED_FOLDER = "unlabelled"
POSITIVE_MARK = "hateful"
NEGATIVE_MARK = "non_hateful"


def layout_images(manifest: DataFrame) -> DataFrame:
    """OP-S8: target layout image_{split}/{class}/{file} for each post.
    Adds ``class`` and ``path``; write the files with
    ``write.partitionBy("split", "class")``."""
    cls = (F.when(F.col("label") == 1, F.lit(POSITIVE_FOLDER))
           .when(F.col("label") == 0, F.lit(NEGATIVE_FOLDER))
           .otherwise(F.lit(UNLABELLED_FOLDER)))
    return (manifest.withColumn("class", cls)
            .withColumn("path", F.concat(F.lit("image_"), F.col("split"), F.lit("/"),
                                         F.col("class"), F.lit("/"), basename(F.col("img")))))


def label_from_path(path: Column, positive: str = POSITIVE_MARK,
                    negative: str = NEGATIVE_MARK) -> Column:
    """OP-S9: 1 if the parent folder name (lower-cased) contains
    ``positive`` and not ``negative``, else 0."""
    folder = F.lower(F.element_at(F.split(path, "/"), -2))
    return F.when(folder.contains(positive) & ~folder.contains(negative), 1).otherwise(0).cast("int")


def index_images(spark: SparkSession, split_dir: str, glob: str = "*.png") -> DataFrame:
    """OP-S4/P7: (path, filename, label) of every file matching ``glob``
    (case-sensitive) exactly one folder level below ``split_dir``.  Only
    the path is read (the content column is pruned from the scan)."""
    files = (spark.read.format("binaryFile")
             .option("pathGlobFilter", glob)
             .load(f"{split_dir.rstrip('/')}/*/"))
    return files.select("path", basename(F.col("path")).alias("filename"),
                        label_from_path(F.col("path")).alias("label"))


def read_image_bytes(spark: SparkSession, split_dir: str, glob: str = "*.png") -> DataFrame:
    """OP-S5 (bytes): path, filename, label, content."""
    files = (spark.read.format("binaryFile")
             .option("pathGlobFilter", glob)
             .load(f"{split_dir.rstrip('/')}/*/"))
    return files.select("path", basename(F.col("path")).alias("filename"),
                        label_from_path(F.col("path")).alias("label"), "content")


def read_images(spark: SparkSession, split_dir: str, glob: str = "*.png") -> DataFrame:
    """OP-S5 (decoded): the ``image`` source with ``dropInvalid`` --
    undecodable files are skipped, and so are other extensions (OP-P7).
    Pixels are stored BGR."""
    return (spark.read.format("image").option("dropInvalid", True).option("pathGlobFilter", glob)
            .load(f"{split_dir.rstrip('/')}/*/"))


def image_read_report(spark: SparkSession, split_dir: str, glob: str = "*.png") -> DataFrame:
    """OP-S5 (count what was skipped): every listed file with ``decoded``
    true/false -- a left join of the file index with the decoded origins
    (no driver-side loop).  ``groupBy("decoded").count()`` gives the
    numbers the reference only printed."""
    def norm(c):  # the two sources spell the URI differently (file:/ vs file:///)
        return F.regexp_replace(c, r"^[A-Za-z][A-Za-z0-9+.-]*:/*", "/")

    listed = index_images(spark, split_dir, glob).withColumn("_k", norm(F.col("path")))
    ok = read_images(spark, split_dir, glob).select(norm(F.col("image.origin")).alias("_k"),
                                              F.lit(True).alias("decoded"))
    return (listed.join(ok, "_k", "left").drop("_k")
            .withColumn("decoded", F.coalesce(F.col("decoded"), F.lit(False))))
