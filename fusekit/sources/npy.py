"""NumPy batch directories (OP-S10, OP-W3, OP-O2) as a Python data source.

Layout: ``base/<split>/<batch dir>/<feature file>.npy``, ``labels.npy``,
``filenames.npy`` -- parallel arrays sharing one index.  The reference lists the
directories on the driver, reads every file through Py4J into one driver-side
list, and writes batches from the driver, so that a failed run leaves parts.

``format("npy_batches")`` reads and writes them:

* reading: one input partition is one batch folder, whose task reads the three
  files and hands on Arrow batches; nothing is shuffled, and the driver lists
  folders only.  Filters on ``split`` (the option ``split``, or a pushed
  ``split = ...`` where ``spark.sql.python.filterPushdown.enabled`` is set)
  leave the other folders out;
* writing: rows come sorted by split and batch; a task writes each of its
  batches into a folder of its own attempt and tells the driver which; only the
  job's commit moves folders to their place.  A task that is killed, or runs
  twice, leaves nothing there.  In ``overwrite`` mode the commit replaces the
  splits that it holds whole.

A batch whose arrays are missing, unreadable or of unequal length is dropped
(``mode="DROP"``, the reference's behaviour; ``read_report`` has a marker row
with ``bad`` for each) or fails the job (``mode="FAILFAST"``).  Rows carry their
batch name, so no driver-side ordering of folders is needed (string order puts
``batch_10`` before ``batch_2``; report with ``orderBy("batch")`` if wanted).
"""

from __future__ import annotations

import io
import re
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, InputPartition, WriterCommitMessage

LABELS_FILE = "labels"
FILENAMES_FILE = "filenames"
SCHEMA = "split string, batch string, filename string, label int, features array<float>, bad boolean"
#: Rows that a task hands on at a time.
OUT_ROWS = 1024
#: Folder of batches that no commit has moved yet.
STAGING = "_staging"


def _store(base: str):
    """The file system and path of ``base`` (a plain path or a URI)."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", base).rstrip("/"))


def _folders(base: str, feature_file: str) -> list[str]:
    """Folders below ``base`` that hold an .npy file, by name."""
    from pyarrow import fs
    store, root = _store(base)
    found = store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
    return sorted({f.path.rpartition("/")[0] for f in found if f.path.endswith(".npy") and f"/{STAGING}/" not in f.path})


@dataclass
class BatchFolder(InputPartition):
    """One batch folder."""

    path: str


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.base, self.feature = options["path"], options["feature"]
        self.failfast = options.get("mode", "DROP").upper() == "FAILFAST"
        self.split = options.get("split")

    def partitions(self):
        folders = [BatchFolder(f) for f in _folders(self.base, self.feature) if self.split is None or f.split("/")[-2] == self.split]
        return folders or [BatchFolder("")]

    def _load(self, folder: str):
        store, _ = _store(self.base)

        def array(name):
            with store.open_input_stream(f"{folder}/{name}.npy") as f:
                return np.load(io.BytesIO(f.read()), allow_pickle=False)

        feats, labels, names = array(self.feature), array(LABELS_FILE), array(FILENAMES_FILE)
        if not len(feats) == len(labels) == len(names):
            raise ValueError(f"{folder}: array length mismatch")
        return feats.reshape(len(feats), -1).astype(np.float32) if len(feats) else feats.reshape(0, 0).astype(np.float32), labels.astype(np.int32), names.astype(str)

    def read(self, partition):
        if not partition.path:
            return
        split, batch = partition.path.split("/")[-2:]
        try:
            feats, labels, names = self._load(partition.path)
        except Exception:
            if self.failfast:
                raise
            yield _rows(split, batch, [None], [None], pa.array([None], pa.list_(pa.float32())), True)
            return
        for lo in range(0, len(names), OUT_ROWS):
            x = feats[lo:lo + OUT_ROWS]
            ends = pa.array(np.arange(len(x) + 1) * feats.shape[1], pa.int32())
            yield _rows(split, batch, names[lo:lo + OUT_ROWS].tolist(), labels[lo:lo + OUT_ROWS], pa.ListArray.from_arrays(ends, pa.array(x.ravel())), False)


class _PushingReader(_Reader):
    """The reader of sessions that push filters to Python data sources (Spark
    refuses ``pushFilters`` in others)."""

    def pushFilters(self, filters):
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("split",) and self.split is None:
                self.split = f.value
            else:
                yield f


def _rows(split, batch, names, labels, features, bad) -> pa.RecordBatch:
    n = len(features)
    return pa.RecordBatch.from_arrays([pa.array([split] * n, pa.string()), pa.array([batch] * n, pa.string()), pa.array(names, pa.string()),
                                       pa.array(labels, pa.int32()), features, pa.array([bad] * n)], names=["split", "batch", "filename", "label", "features", "bad"])


@dataclass
class Written(WriterCommitMessage):
    """The batches (split, batch) that a task wrote below its own folder."""

    folder: str
    batches: list


class _Writer(DataSourceArrowWriter):
    def __init__(self, options, overwrite: bool):
        self.base, self.feature, self.overwrite = options["path"], options["feature"], overwrite
        self.job = uuid.uuid4().hex

    def write(self, iterator):
        from pyspark import TaskContext
        store, root = _store(self.base)
        own = f"{root}/{STAGING}/{self.job}/{TaskContext.get().taskAttemptId()}"
        done, held, key = [], [], None

        def flush():
            if held:
                table = pa.Table.from_batches(held).sort_by("filename")
                folder = f"{own}/{key[0]}/batch_{key[1]}"
                store.create_dir(folder, recursive=True)
                x = table.column("features").combine_chunks()
                x = x.chunk(0) if isinstance(x, pa.ChunkedArray) else x
                arrays = {self.feature: x.flatten().to_numpy().astype(np.float32).reshape(len(x), -1),
                          LABELS_FILE: table.column("label").to_numpy(), FILENAMES_FILE: np.array(table.column("filename").to_pylist(), str)}
                for name, array in arrays.items():
                    out = io.BytesIO()
                    np.save(out, array, allow_pickle=False)
                    with store.open_output_stream(f"{folder}/{name}.npy") as f:
                        f.write(out.getvalue())
                done.append(key)
                held.clear()

        for batch in iterator:
            keys = list(zip(batch.column("split").to_pylist(), batch.column("batch").to_pylist()))
            cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            for lo, hi in zip(cuts, cuts[1:]):
                if hi > lo:
                    if keys[lo] != key:
                        flush()
                        key = keys[lo]
                    held.append(batch.slice(lo, hi - lo))
        flush()
        return Written(own, done)

    def commit(self, messages):
        from pyarrow import fs
        store, root = _store(self.base)
        messages = [m for m in messages if m]
        if self.overwrite:
            for split in {b[0] for m in messages for b in m.batches}:
                if store.get_file_info(f"{root}/{split}").type != fs.FileType.NotFound:
                    store.delete_dir(f"{root}/{split}")
        for m in messages:
            for split, batch in m.batches:
                store.create_dir(f"{root}/{split}", recursive=True)
                store.move(f"{m.folder}/{split}/batch_{batch}", f"{root}/{split}/batch_{batch}")
        self._clear(store, root)

    def abort(self, messages):
        self._clear(*_store(self.base))

    def _clear(self, store, root):
        from pyarrow import fs
        own = f"{root}/{STAGING}/{self.job}"
        if store.get_file_info(own).type != fs.FileType.NotFound:
            store.delete_dir(own)


class NpyBatchSource(DataSource):
    """The format ``npy_batches``; options: path, feature (file name without
    .npy), mode (DROP or FAILFAST), split."""

    @classmethod
    def name(cls):
        return "npy_batches"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return (_PushingReader if self.options.get("pushdown") == "true" else _Reader)(self.options)

    def writer(self, schema, overwrite):
        return _Writer(self.options, overwrite)


def read_report(spark: SparkSession, base: str, feature_file: str, mode: str = "DROP", split: str | None = None) -> DataFrame:
    """All decoded rows plus one marker row (bad = true) per dropped batch."""
    spark.dataSource.register(NpyBatchSource)
    pushdown = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false").lower()
    reader = spark.read.format("npy_batches").option("feature", feature_file).option("mode", mode).option("pushdown", pushdown)
    return (reader.option("split", split) if split is not None else reader).load(base)


def read_npy_batches(spark: SparkSession, base: str, feature_file: str, feature_col: str,
                     mode: str = "DROP", split: str | None = None) -> DataFrame:
    """(filename, label, <feature_col> array<float>, batch, split) for every
    good batch under ``base`` (of one split, if named); split is the folder that
    holds the batch."""
    rep = read_report(spark, base, feature_file, mode, split)
    return rep.where(~F.col("bad")).select("filename", "label", F.col("features").alias(feature_col), "batch", "split")


def write_npy_batches(batched: DataFrame, base: str, feature_col: str, feature_file: str, mode: str = "overwrite") -> None:
    """The folders ``<split>/batch_<n>`` of rows with filename, label, split and
    a bounded batch number (``sinks.writers.batch_numbers``)."""
    batched.sparkSession.dataSource.register(NpyBatchSource)
    rows = batched.select("split", "batch", "filename", F.col("label").cast("int").alias("label"), F.col(feature_col).cast("array<float>").alias("features"))
    (rows.repartition("split", "batch").sortWithinPartitions("split", "batch")
     .write.format("npy_batches").option("feature", feature_file).mode(mode).save(base))
