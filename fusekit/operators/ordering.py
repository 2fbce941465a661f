"""Global ordering helpers without a single-partition window.

``row_number() OVER (ORDER BY ...)`` without PARTITION BY moves every row
into one task.  ``global_index`` gives the same dense 0-based index with
the zipWithIndex pattern: range-partition and sort (distributed), cut the
lineage so the range boundaries are fixed, count rows per partition (one
small row per partition to the driver), then add each partition's offset
to the row's position inside its partition (read from
``monotonically_increasing_id``, which is partition-index << 33 plus the
row's position).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def global_index(df: DataFrame, order_cols: list[str | Column], out_col: str = "idx",
                 num_partitions: int | None = None) -> DataFrame:
    """Dense 0-based index of every row in the order of ``order_cols``.
    Rows with equal keys get consecutive indices in an arbitrary order, so
    pass unique keys when the assignment must be repeatable."""
    spark = df.sparkSession
    # written first: range sampling reads it twice, and the tie-breaker below
    # must not change when a lost task runs again
    df = cut_lineage(df, spark)
    # a row tie-breaker after the order columns: rows with equal keys (even a
    # third of the table under one key) can then be split across range
    # partitions; it only orders rows the caller's keys cannot tell apart
    df = df.withColumn("_tie", F.monotonically_increasing_id())
    order_cols = list(order_cols) + ["_tie"]
    # without an explicit count AQE sizes the range partitions from the data
    ranged = (df.repartitionByRange(num_partitions, *order_cols) if num_partitions
              else df.repartitionByRange(*order_cols)).sortWithinPartitions(*order_cols)
    ranged = cut_lineage(ranged.drop("_tie"), spark)
    tagged = (ranged.withColumn("_p", F.spark_partition_id())
              .withColumn("_m", F.monotonically_increasing_id()))
    counts = sorted((r["_p"], r["count"]) for r in tagged.groupBy("_p").count().collect())
    offsets, acc = {}, 0
    for p, c in counts:
        offsets[p] = acc
        acc += c
    if not offsets:
        return tagged.drop("_p", "_m").withColumn(out_col, F.lit(None).cast("bigint"))
    # one small row per partition, joined rather than pasted into the plan
    table = spark.createDataFrame(list(offsets.items()), "_q int, _o bigint")
    local = F.col("_m") - F.shiftleft(F.col("_p").cast("bigint"), 33)
    return (tagged.join(F.broadcast(table), F.col("_p") == F.col("_q"))
            .withColumn(out_col, (F.col("_o") + local).cast("bigint")).drop("_p", "_m", "_q", "_o"))
