"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint_root, scratch_path, ship_package

#: ASCII white space, as a Java regular expression class body.
WS = r"\x20\x09-\x0D"

#: Stand-in for a null doc_id where ids are compared: sorts after all others.
NULL_ID = 2**63 - 1


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet into the shared folder and read back: a
    lineage cut that survives lost executors and fixes the rows' content."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def prepare(spark: SparkSession) -> None:
    """Ship the package to the Python workers and set the checkpoint folder."""
    ship_package(spark)
    checkpoint_root(spark)


def task_rows(start: int = 0):
    """Row numbers that differ between the tasks of one job: the partition in
    the high bits, a running number below."""
    n = (TaskContext.get().partitionId() << 33) + start
    while True:
        yield n
        n += 1


def slices(batch: pa.RecordBatch, column: str, most_bytes: int):
    """Consecutive parts of ``batch`` whose ``column`` (binary or string) holds
    at most ``most_bytes`` each; a longer single row makes a part of its own."""
    import pyarrow.compute as pc
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    at, held = 0, 0
    for i, n in enumerate(sizes):
        if i > at and held + n > most_bytes:
            yield batch.slice(at, i - at)
            at, held = i, 0
        held += n
    yield batch.slice(at)


def python_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string or binary column, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def ship_file(spark: SparkSession, path: str) -> str:
    """Send the driver's file ``path`` to every executor; returns the name that
    ``shipped`` finds it by inside a task (its content's digest is part of the
    application's files, so one name is sent once)."""
    import os
    name = os.path.basename(path)
    spark.sparkContext.addFile(path)
    return name


def shipped(name: str) -> str:
    """The place of a shipped file on this executor."""
    from pyspark import SparkFiles
    return SparkFiles.get(name)


def open_ended(part: bytes) -> bool:
    """Whether white space, or nothing, stands at an end."""
    first, last = part[:1], part[-1:]
    if first <= b"\x7f" and last <= b"\x7f":
        return first in _SPACES or last in _SPACES
    return part[:3].decode("utf-8", "ignore")[:1].isspace() or part[-3:].decode("utf-8", "ignore")[-1:].isspace()


_SPACES = frozenset([b""] + [bytes([i]) for i in range(128) if chr(i).isspace()])
