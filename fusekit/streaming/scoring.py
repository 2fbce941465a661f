"""Continuous scoring of arriving posts (OP-K2).

Stateless: each micro-batch of arriving feature rows is scored by a saved
Spark ML model and appended, keyed, to the predictions table.
``foreachBatch`` gives the batch DataFrame API inside the stream, so the
result equals batch scoring of the same rows.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def score_stream(spark: SparkSession, source_dir: str, schema: T.StructType, model_path: str,
                 loader, sink_dir: str, checkpoint_dir: str, key: str = "filename",
                 available_now: bool = True):
    """Start the scoring query; returns the StreamingQuery.

    The model is loaded from storage (``loader(model_path)``, e.g.
    ``PipelineModel.load``) once on the driver: a restarted query scores
    with the same stored model, and a loaded model carries no training
    summary (a fresh one references the session, which cannot be shipped
    to tasks once the session has used an ``Observation``)."""
    model = loader(model_path)
    src = spark.readStream.schema(schema).parquet(source_dir)

    def score(batch, epoch_id):
        out = model.transform(batch).select(key, F.col("prediction").cast("int").alias("predicted_label"))
        # idempotent per epoch: a retried epoch rewrites its own folder
        out.write.mode("overwrite").parquet(f"{sink_dir}/epoch={epoch_id}")

    writer = src.writeStream.foreachBatch(score).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
