"""Line dedup with two Bloom filters.

A line's key is the line stripped of ASCII white space at both ends, with A-Z
in lower case.  A key of at least ``min_chars`` code points that at least two
documents hold keeps its lines in the smallest doc_id only.

1. Documents are packed into chunks of a few MB (one compressed Arrow batch
   each) and written to the shared folder: every later step deals with chunks,
   so a line that a third of all documents hold is one row per chunk.
2. Each group of ``GROUP_CHUNKS`` neighbouring chunks sends the hashes of its
   distinct keys, by hash range, to shards of bounded size, so a line that all
   chunks hold is one hash per group in its shard.  A shard keeps a filter of
   hashes seen once and one of hashes seen twice; it answers each group with
   the hashes that the second filter holds.
3. Only those suspected keys shuffle as text: the exact key is grouped for its
   smallest and largest document; two different documents confirm it.
4. Each chunk gets the confirmed keys with their first document back and drops
   the other lines.

Defined cases: a null or empty text is one empty line; rows that share a
doc_id are one document; a null doc_id is a document of its own that comes
last; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import NULL_ID, prepare, python_bytes, slices, task_rows, written

#: UTF-8 bytes of text in a chunk (a longer document is a chunk of its own).
CHUNK_BYTES = 4 << 20
#: zstd level of a chunk, which is written once and shuffled twice.
PACKING = 5
#: Chunks (a power of two) of one task that speak to the shards together.
GROUP_CHUNKS = 16
#: UTF-8 bytes of text whose lines' hashes one shard holds.
SHARD_BYTES = 16 << 20
#: Bits of each filter for every hash of a shard, and bits set for a hash.
FILTER_BITS, FILTER_HASHES = 12, 4

_CHUNKS = "chunk long, text_bytes long, rows binary"


def line_key(line: bytes) -> bytes:
    """The key of a line: ASCII white space stripped, A-Z lower-cased."""
    return line.strip().lower()


def _long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= 4 * min_chars or len(key) >= min_chars and len(key.decode("utf-8", "replace")) >= min_chars


def _pack(batch: pa.RecordBatch) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=PACKING))) as w:
        w.write_batch(batch)
    return out.getvalue().to_pybytes()


def _unpack(rows: bytes) -> pa.Table:
    return pa.ipc.open_stream(rows).read_all()


def _chunk_maker(text_col: str):
    def make(batches):
        numbers = task_rows()
        for batch in batches:
            for part in slices(batch, text_col, CHUNK_BYTES):
                size = sum(map(len, python_bytes(part.column(text_col))))
                yield pa.RecordBatch.from_pydict(
                    {"chunk": [next(numbers)], "text_bytes": [size], "rows": [_pack(part)]},
                    schema=pa.schema([("chunk", pa.int64()), ("text_bytes", pa.int64()), ("rows", pa.binary())]))
    return make


def _documents(rows: bytes, id_col: str, text_col: str):
    table = _unpack(rows)
    ids = [NULL_ID if i is None else i for i in table.column(id_col).to_pylist()]
    texts = [x or b"" for x in table.column(text_col).cast(pa.binary()).to_pylist()]
    return table, ids, texts


def _chunk_keys(ids, texts, min_chars):
    """key -> [smallest doc, largest doc, number of the line that first holds
    it] of a chunk, in the order of the lines."""
    keys: dict[bytes, list[int]] = {}
    n = 0
    for doc, text in zip(ids, texts):
        for line in text.split(b"\n"):
            key = line.strip().lower()
            if len(key) >= min_chars:
                seen = keys.get(key)
                if seen is None:
                    if _long_enough(key, min_chars):
                        keys[key] = [doc, doc, n]
                elif doc != seen[1]:
                    seen[0], seen[1] = min(seen[0], doc), max(seen[1], doc)
            n += 1
    return keys


_hash = xxhash.xxh3_64_intdigest


def _hashes(keys) -> np.ndarray:
    return np.fromiter(map(_hash, keys), np.uint64, len(keys))


def _to_shards(id_col, text_col, min_chars, shards):
    schema = pa.schema([("shard", pa.int64()), ("team", pa.int64()), ("single", pa.binary()), ("several", pa.binary())])

    def message(team, parts):
        """What a group sends: a hash that several of its chunks hold, or
        several documents of a chunk, has been seen twice already."""
        h, first, count = np.unique(np.concatenate([p[0] for p in parts]), return_index=True, return_counts=True)
        several = (count > 1) | np.concatenate([p[1] for p in parts])[first]
        shard = (h % np.uint64(shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        h, several, shard = h[order], several[order], shard[order]
        at = np.flatnonzero(np.diff(shard, prepend=-1))
        out = {"shard": shard[at].tolist(), "team": [team] * len(at), "single": [], "several": []}
        for lo, hi in zip(at, np.append(at[1:], len(h))):
            out["single"].append(h[lo:hi][~several[lo:hi]].tobytes())
            out["several"].append(h[lo:hi][several[lo:hi]].tobytes())
        return pa.RecordBatch.from_pydict(out, schema=schema)

    def send(batches):
        team, parts = None, []
        for batch in batches:
            for now, rows in zip(batch.column("team").to_pylist(), batch.column("rows")):
                if parts and now != team:
                    yield message(team, parts)
                    parts = []
                team = now
                _, ids, texts = _documents(rows.as_py(), id_col, text_col)
                keys = _chunk_keys(ids, texts, min_chars)
                parts.append((_hashes(keys), np.fromiter((v[0] != v[1] for v in keys.values()), bool, len(keys))))
        if parts:
            yield message(team, parts)
    return send


class Bloom:
    """A Bloom filter over 64-bit hashes; one byte for each bit."""

    def __init__(self, entries: int):
        self.size = np.uint64(max(64, FILTER_BITS * entries))
        self.bits = np.zeros(int(self.size), bool)

    def places(self, h: np.ndarray) -> np.ndarray:
        step = (h >> np.uint64(32)) | np.uint64(1)
        mixed = h * np.uint64(0x9E3779B97F4A7C15)
        return np.stack([((mixed + np.uint64(i) * step) >> np.uint64(7)) % self.size for i in range(FILTER_HASHES)]).astype(np.int64)

    def holds(self, places: np.ndarray) -> np.ndarray:
        return self.bits[places].all(axis=0)

    def add(self, places: np.ndarray) -> None:
        self.bits[places] = True


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all rows one after another, how many each row has)."""
    counts, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for part in column.cast(pa.binary()).chunks:
        counts.append(pc.binary_length(part).to_numpy(zero_copy_only=False).astype(np.int64) // 8)
        if n := int(counts[-1].sum()):
            first = np.frombuffer(part.buffers()[1], np.int32)[part.offset]
            hashes.append(np.frombuffer(part.buffers()[2], np.uint64, n, int(first)))
    return np.concatenate(hashes), np.concatenate(counts)


def _answer(teams: pa.ChunkedArray, hashes: np.ndarray, counts: np.ndarray, hit: np.ndarray) -> pa.Table:
    """(team, hashes): those of ``hashes`` that ``hit`` marks, row by row."""
    before = np.concatenate([[0], np.cumsum(hit)])
    ends = np.cumsum(counts)
    offsets = 8 * before[np.concatenate([[0], ends])]
    kept = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(hashes[hit])])
    table = pa.table({"team": teams, "hashes": kept})
    return table.filter(pc.greater(pc.binary_length(table.column("hashes")), 0)).cast(_ANSWER)


_ANSWER = pa.schema([("team", pa.int64()), ("hashes", pa.binary())])
#: Hashes that a shard adds to its filters at a time.
_ADDED = 1 << 18


def _suspects(table: pa.Table) -> pa.Table:
    """The answer of one shard: for each group the hashes that the filter of
    hashes seen twice holds.  The filters are filled by slices: what repeats
    inside a slice, or was seen before it, has been seen twice."""
    single, n_single = _flat(table.column("single"))
    several, n_several = _flat(table.column("several"))
    once, twice = Bloom(len(single) + len(several)), Bloom(len(single) + len(several))
    for at in range(0, len(several), _ADDED):
        places = once.places(several[at:at + _ADDED])
        once.add(places)
        twice.add(places)
    for at in range(0, len(single), _ADDED):
        h, n = np.unique(single[at:at + _ADDED], return_counts=True)
        places = once.places(h)
        twice.add(places[:, once.holds(places) | (n > 1)])
        once.add(places)
    hit = np.zeros(len(single), bool)
    for at in range(0, len(single), _ADDED):
        hit[at:at + _ADDED] = twice.holds(twice.places(single[at:at + _ADDED]))
    teams = table.column("team")
    return pa.concat_tables([_answer(teams, single, n_single, hit),
                             _answer(teams, several, n_several, np.ones(len(several), bool))])


def _suspected_keys(id_col, text_col, min_chars):
    schema = pa.schema([("key", pa.binary()), ("chunk", pa.int64()), ("line", pa.int64()), ("first_doc", pa.int64()), ("last_doc", pa.int64())])

    def keys_of(batches):
        for batch in batches:
            for chunk, rows, hashes in zip(batch.column("chunk").to_pylist(), batch.column("rows"), batch.column("hashes").to_pylist()):
                _, ids, texts = _documents(rows.as_py(), id_col, text_col)
                keys = _chunk_keys(ids, texts, min_chars)
                asked = np.isin(_hashes(keys), np.frombuffer(b"".join(hashes), np.uint64))
                out = [(k, chunk, v[2], v[0], v[1]) for (k, v), hit in zip(keys.items(), asked.tolist()) if hit]
                yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(zip(*out), schema)], schema=schema) if out else pa.RecordBatch.from_pylist([], schema=schema)
    return keys_of


def _drop_lines(id_col, text_col, schema: pa.Schema):
    def drop(batches):
        for batch in batches:
            for rows, lines, firsts in zip(batch.column("rows"), batch.column("lines").to_pylist(), batch.column("firsts").to_pylist()):
                table, ids, texts = _documents(rows.as_py(), id_col, text_col)
                first_at, n, first_doc = dict(zip(lines or [], firsts or [])), 0, {}
                kept_texts, n_lines, n_dropped = [], [], []
                for doc, text in zip(ids, texts):
                    kept = []
                    split = text.split(b"\n")
                    for line in split:
                        if first_at:
                            key = line.strip().lower()
                            if n in first_at:
                                first_doc[key] = first_at[n]
                            if first_doc.get(key, doc) == doc:
                                kept.append(line)
                        n += 1
                    if not first_at:
                        kept = split
                    kept_texts.append(b"\n".join(kept) if len(kept) < len(split) else text)
                    n_lines.append(len(split))
                    n_dropped.append(len(split) - len(kept))
                columns = [table.column(i).combine_chunks() for i in range(table.num_columns)]
                columns += [pa.array(kept_texts, pa.binary()).cast(pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())]
                yield from pa.Table.from_arrays(columns, names=schema.names).cast(schema).to_batches()
    return drop


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10,
               kept: str = "kept_text", n_lines: str = "n_lines", n_dropped: str = "n_dropped") -> DataFrame:
    """``docs`` with the columns ``kept`` (the text without its dropped lines),
    ``n_lines`` (before) and ``n_dropped`` (long).  The added names must not
    be columns of ``docs``; id values must be integers."""
    from pyspark.sql.pandas.types import to_arrow_schema
    spark = docs.sparkSession
    prepare(spark)
    if clash := {kept, n_lines, n_dropped} & set(docs.columns):
        raise ValueError(f"columns exist already: {sorted(clash)}")
    source = docs.withColumn(id_col, F.col(id_col).cast("long"))
    chunks = written(source.mapInArrow(_chunk_maker(text_col), _CHUNKS), "line-chunks")
    size = chunks.agg(F.sum("text_bytes")).first()[0] or 0
    shards = max(1, math.ceil(size / SHARD_BYTES))
    # chunks of a task are numbered in a row
    chunks = chunks.withColumn("team", F.shiftright("chunk", GROUP_CHUNKS.bit_length() - 1))
    hashes = chunks.select("team", "rows").mapInArrow(
        _to_shards(id_col, text_col, min_chars, shards), "shard long, team long, single binary, several binary")
    suspects = (hashes.groupBy("shard").applyInArrow(_suspects, "team long, hashes binary")
                .groupBy("team").agg(F.collect_list("hashes").alias("hashes")))
    keys = written(chunks.select("chunk", "rows", "team").join(suspects, "team").select("chunk", "rows", "hashes").mapInArrow(
        _suspected_keys(id_col, text_col, min_chars),
        "key binary, chunk long, line long, first_doc long, last_doc long"), "line-keys")
    shared = (keys.groupBy("key").agg(F.min("first_doc").alias("first"), F.max("last_doc").alias("last"))
              .filter("first != last").select("key", "first"))
    drops = (keys.join(shared, "key").groupBy("chunk")
             .agg(F.collect_list(F.struct("line", "first")).alias("d"))
             .select("chunk", F.col("d.line").alias("lines"), F.col("d.first").alias("firsts")))
    out = T.StructType(source.schema.fields + [
        T.StructField(kept, T.StringType()), T.StructField(n_lines, T.LongType()), T.StructField(n_dropped, T.LongType())])
    return (chunks.select("chunk", "rows").join(drops, "chunk", "left").select("rows", "lines", "firsts")
            .mapInArrow(_drop_lines(id_col, text_col, to_arrow_schema(out)), out))


def reference_line_dedup(rows: list[tuple], min_chars: int = 10) -> list[tuple]:
    """Plain Python form for tests: (doc_id, text) -> (doc_id, n_lines,
    n_dropped, sha256 of the kept text)."""
    holders: dict[bytes, set] = {}
    for doc, text in rows:
        for line in (text or "").encode().split(b"\n"):
            key = line_key(line)
            if len(key.decode()) >= min_chars:
                holders.setdefault(key, set()).add(NULL_ID if doc is None else doc)
    out = []
    for doc, text in rows:
        lines = (text or "").encode().split(b"\n")
        me = NULL_ID if doc is None else doc
        kept = [x for x in lines if line_key(x) not in holders or min(holders[line_key(x)]) == me]
        out.append((doc, len(lines), len(lines) - len(kept), hashlib.sha256(b"\n".join(kept)).hexdigest()))
    return out


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM d),
k AS (SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
m AS (SELECT k.doc_id, k.line, k.n, f.first IS NOT NULL AND f.first <> k.doc_id AS dropped FROM k LEFT JOIN f ON f.key = k.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
