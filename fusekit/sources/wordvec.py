"""Word-vector text files (OP-S6, OP-F9).

Format: one token per line followed by its numbers, space separated; an
optional header line "count dim".  Read as a distributed text scan, not a
driver iterator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _parsed(spark: SparkSession, path: str, dim: int) -> DataFrame:
    """Every line with its kind: vector, header or bad."""
    lines = spark.read.text(path).withColumn("_line", F.monotonically_increasing_id())
    parts = F.split(F.rtrim(F.col("value")), " ")
    # the whole array is cast at once, in compiled code, and exploded from an array
    # of one: what follows reads the numbers and does not parse them again
    nums = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))).try_cast("array<float>")
    lines = lines.select("value", "_line", F.element_at(parts, 1).alias("token"), F.explode_outer(F.array(nums)).alias("vector"))
    good = (F.size("vector") == dim) & F.forall("vector", lambda x: x.isNotNull())
    header = F.rtrim(F.col("value")).rlike(r"^\d+ \d+$")
    return lines.withColumn("kind", F.when(good, "vector").when(header, "header").otherwise("bad"))


def word_vector_report(spark: SparkSession, path: str, dim: int) -> DataFrame:
    """Lines of each kind (vector, header, bad): what DROP mode leaves out."""
    return _parsed(spark, path, dim).groupBy("kind").agg(F.count(F.lit(1)).alias("n_lines"))


def read_word_vectors(spark: SparkSession, path: str, dim: int,
                      mode: str = "DROP") -> DataFrame:
    """OP-S6: (token, vector array<float>).

    * spaces at the end of a line are ignored, and so is a header line;
    * a wrong width or a bad number: ``mode="DROP"`` drops the line
      (``word_vector_report`` counts those), ``mode="FAILFAST"`` raises;
    * a duplicate token: the last line wins, as in the reference's map
      build.  Line order is kept by ``monotonically_increasing_id``, which
      increases with the file offset inside a file.
    """
    rows = _parsed(spark, path, dim).where(F.col("kind") != "header")
    if mode.upper() == "FAILFAST":
        rows = rows.withColumn("vector", F.when(F.col("kind") == "vector", F.col("vector")).otherwise(
            F.raise_error(F.concat(F.lit("not a word vector: "), F.substring("value", 1, 80)))))
    else:
        rows = rows.where(F.col("kind") == "vector")
    return (rows.groupBy("token")
            .agg(F.max_by(F.col("vector"), F.col("_line")).alias("vector")))


def format_word_vectors(vectors: DataFrame) -> DataFrame:
    """Inverse of the reader: one text line per token."""
    return vectors.select(F.concat_ws(" ", F.col("token"),
                                      F.array_join(F.col("vector").cast("array<string>"), " "))
                          .alias("value"))
