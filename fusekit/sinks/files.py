"""Plain files written by tasks, each row one file.

A file is written beside its place, under a name of the task's own attempt, and
then moved there whole: a killed task leaves no cut file, and of two attempts
that write the same file the last one's stays.
"""

from __future__ import annotations

import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_files(files: DataFrame, base: str) -> int:
    """Write (path, content) rows below the shared folder ``base``; returns
    the number of files."""
    base = re.sub(r"^file:/+", "/", base).rstrip("/")

    def put(batches):
        from pyarrow import fs
        store, root = fs.FileSystem.from_uri(base)
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                folder, _, name = f"{root}/{path}".rpartition("/")
                store.create_dir(folder, recursive=True)
                beside = f"{folder}/.{name}.{TaskContext.get().taskAttemptId()}"
                with store.open_output_stream(beside) as out:
                    out.write(content)
                store.move(beside, f"{folder}/{name}")
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    done = files.select("path", F.col("content").cast("binary").alias("content")).mapInArrow(put, "n long")
    return done.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def grey_png(pixels: np.ndarray) -> bytes:
    """A PNG file of a (height, width) array of uint8 grey values."""
    def part(tag, data):
        return struct.pack(">I", len(data)) + tag + data + struct.pack(">I", zlib.crc32(tag + data))

    h, w = pixels.shape
    lines = b"".join(b"\0" + row.tobytes() for row in np.ascontiguousarray(pixels))
    return (b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0))
            + part(b"IDAT", zlib.compress(lines)) + part(b"IEND", b""))
