"""Byte-level BPE encoding and decoding with recursive DuckDB queries.

A rank file gives each token's bytes and rank; two neighbouring tokens merge
if their joined bytes are a token, lowest rank first, leftmost first.  Each
task reads its partition in slices and keeps one in-memory DuckDB database:

* texts are cut into the words that ``pattern`` matches; words that a bounded
  memo does not hold become rows (word, place, token);
* a recursive query joins each word's neighbouring tokens with the merge
  table, contracts the word's leftmost pair of minimum rank and numbers its
  places anew, until no word has a pair left;
* decoding joins (run, place, token) rows with the vocabulary and puts each
  run's bytes together by an ordered aggregation.  A run is a stretch of ids
  from a token that starts with a space up to the next one, so that runs that
  repeat are decoded once while the memo holds them.

A word of more than ``WINDOW`` bytes would need as many rounds as merges.  Its
overlapping windows are encoded side by side instead and joined at a token that
both have at the same place.  That is exact: if every two neighbouring tokens
of a tiling are neighbours in the encoding of some stretch of the word, the
tiling is the word's encoding, since a merge across their boundary would have
happened in that stretch too.  Where two windows share no token, the windows
after the seam start anew at a token's end with another stride, then wider.

Defined cases: a null or empty text has no ids; repeated rows and null ids keep
a row each; an empty table gives an empty result; other columns of the input
are not read; an id that the vocabulary lacks fails the job.
"""

from __future__ import annotations

import base64
import functools
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import open_ended, prepare, ship_file, shipped, slices
from .memo import Memo

#: Longest word, in bytes, that is encoded in one piece at first; a window of longer ones.
WINDOW = 128
#: Steps between windows, tried in turn (as shares of the window).
STRIDES = (1 / 2, 15 / 32, 63 / 128, 11 / 32)
#: Bytes of words that one recursive query works on.
QUERY_BYTES = 512 << 10
#: Bytes of text (or ids) that are worked on at a time.
SLICE_BYTES = 8 << 20
#: Words that a memo's young half holds.
MEMO_WORDS = 220_000

CONTRACT = """
WITH RECURSIVE state(word, place, token, next_token, done) AS (
  SELECT word, place, token, next_token, false FROM letters
  UNION ALL
  SELECT * FROM (
    WITH picked AS (
      SELECT word, min((rank << 32) | place) AS pick
      FROM state JOIN merges ON pair = (token::BIGINT << 32) | next_token
      WHERE NOT done GROUP BY word)
    SELECT state.word,
           CASE WHEN place > pick & 4294967295 THEN place - 1 ELSE place END,
           CASE WHEN place = (pick & 4294967295) + 1 THEN (pick >> 32)::INTEGER ELSE token END,
           CASE WHEN place + 1 = pick & 4294967295 THEN (pick >> 32)::INTEGER ELSE next_token END,
           pick IS NULL
    FROM state LEFT JOIN picked ON picked.word = state.word
    WHERE NOT done AND (pick IS NULL OR place <> pick & 4294967295)))
SELECT word, place, token FROM state WHERE done
"""

DECODE = """
SELECT run, list(bytes ORDER BY place) AS parts
FROM runs JOIN vocabulary USING (token)
GROUP BY run
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """Rank of each token's bytes, from lines of base64 bytes and rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class ByteBpe:
    """Encoder and decoder of one vocabulary, with its own DuckDB database."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, memo_words: int = MEMO_WORDS):
        import duckdb
        import regex
        self.ranks, self.words = ranks, regex.compile(pattern).findall
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        merges = [(ranks[t[:i]] << 32 | ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        self._table("merges", pair=pa.array([p for p, _ in merges], pa.int64()), rank=pa.array([r for _, r in merges], pa.int64()))
        self._table("vocabulary", token=pa.array(list(ranks.values()), pa.int32()), bytes=pa.array(list(ranks), pa.binary()))
        self.letters = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        self.alone = {token: rank.to_bytes(4, "little") for token, rank in ranks.items()}
        self.length = np.zeros(max(ranks.values()) + 1, np.int64)
        self.spaced = np.zeros(len(self.length), bool)
        for token, rank in ranks.items():
            self.length[rank], self.spaced[rank] = len(token), token[:1] == b" "
        self.word_ids = Memo(None, memo_words)    # word -> ids
        self.spaced_ids = Memo(None, memo_words)  # stretch after a space -> ids of both
        self.run_bytes = Memo(None, memo_words)   # ids -> bytes

    def _table(self, name: str, **columns) -> None:
        arrow = pa.table(columns)
        self.db.register("incoming", arrow)
        self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM incoming")
        self.db.unregister("incoming")

    # ------------------------------------------------------------ encoding
    def _contract(self, words: list[bytes]) -> list[bytes]:
        """The ids (int32 bytes) of each word, by the recursive query; nothing is looked up whole."""
        out, at = [], 0
        while at < len(words):
            stop, held = at, 0
            while stop < len(words) and (stop == at or held + len(words[stop]) <= QUERY_BYTES):
                held += len(words[stop])
                stop += 1
            out += self._contract_part(words[at:stop])
            at = stop
        return out

    def _contract_part(self, words: list[bytes]) -> list[bytes]:
        sizes = np.array([len(w) for w in words], np.int64)
        text = np.frombuffer(b"".join(words), np.uint8)
        word, place = _numbered(sizes)
        token = self.letters[text]
        after = np.append(token[1:], np.int32(-1))
        after[np.cumsum(sizes) - 1] = -1
        self.db.register("letters", pa.table({"word": word, "place": place, "token": token, "next_token": after}))
        done = self.db.sql(CONTRACT).to_arrow_table()
        self.db.unregister("letters")
        word, place, token = (done.column(c).to_numpy() for c in ("word", "place", "token"))
        # a word's places are numbered without gaps, so each row's place in the output is known
        ends = np.append(0, np.cumsum(np.bincount(word, minlength=len(words))))
        ids = np.empty(len(token), np.int32)
        ids[ends[word] + place] = token
        return _cut(ids.tobytes(), 4 * ends)

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """The ids (int32 bytes) of words of any length; a word that is a token is that token."""
        out = list(map(self.alone.get, words))
        short, long = [], []
        for i, ids in enumerate(out):
            if ids is None:
                (short if len(words[i]) <= WINDOW else long).append(i)
        for i, ids in zip(short, self._contract([words[i] for i in short])):
            out[i] = ids
        for i, ids in zip(long, self._encode_long([words[i] for i in long])):
            out[i] = ids
        return out

    def _encode_long(self, words: list[bytes]) -> list[bytes]:
        work = {i: _Long(len(w)) for i, w in enumerate(words)}
        while todo := [i for i, w in work.items() if not w.done]:
            begins = [work[i].begins() for i in todo]
            pieces = iter(self._contract([words[i][b:b + work[i].window] for i, at in zip(todo, begins) for b in at]))
            for i, at in zip(todo, begins):
                tiles = [np.frombuffer(next(pieces), np.int32) for _ in at]
                work[i].join([(ids, b + np.cumsum(self.length[ids])) for ids, b in zip(tiles, at)], self.length)
        return [np.concatenate(work[i].settled).tobytes() for i in range(len(words))]

    def _ids(self, words: list[str], at: np.ndarray) -> list[bytes]:
        """The ids (int32 bytes) of each stretch: the words from ``at`` to the next ``at``."""
        if not words:
            return [b""] * (len(at) - 1)
        coded = pa.array(words, pa.large_string()).dictionary_encode()
        ids = self.word_ids.all(coded.dictionary.to_pylist(), lambda new: self.encode_words([w.encode() for w in new]))
        ids = pa.array(ids, pa.large_binary()).take(coded.indices)
        ends = np.frombuffer(ids.buffers()[1], np.int64)[:len(words) + 1]
        return _cut(ids.buffers()[2].to_pybytes(), ends[at])

    def _heads(self, stretches: list[bytes]) -> list[bytes]:
        """The ids of stretches that no word reaches out of."""
        cut = [self.words(s.decode("utf-8", "replace")) for s in stretches]
        return self._ids([*itertools.chain.from_iterable(cut)], np.append(0, np.cumsum([len(words) for words in cut], dtype=np.int64)))

    def _after_space(self, stretches: list[bytes]) -> list[bytes]:
        """The ids of stretches with a space before each; ``OPEN`` where white
        space stands at an end, so that words may reach over it."""
        closed = [s for s in stretches if not open_ended(s)]
        # no closed stretch holds a space, so the words that start with one begin the stretches
        words = self.words(b"".join([b" " + s for s in closed]).decode("utf-8", "replace"))
        begins = [i for i, w in enumerate(words) if w[0] == " "]
        found = self._ids(words, np.array(begins + [len(words)]))
        if len(closed) == len(stretches):
            return found
        found = iter(found)
        return [OPEN if open_ended(s) else next(found) for s in stretches]

    def encode(self, texts: pa.Array) -> pa.ListArray:
        """The ids (list of int32) of each text (binary)."""
        import pyarrow.compute as pc
        # No word of the pattern holds a space after another sign, so a text can
        # be cut before each space that stands alone between two other signs.
        texts = pc.fill_null(texts.cast(pa.binary()), b"")
        if not len(texts):
            return pa.ListArray.from_arrays(pa.array([0], pa.int32()), pa.array([], pa.int32()))
        parts = pc.split_pattern(texts, pattern=b" ")
        at = parts.offsets.to_numpy()
        pieces = parts.values.slice(at[0], at[-1] - at[0]).dictionary_encode()
        at = at - at[0]
        which, distinct = pieces.indices.to_numpy().astype(np.int64), pieces.dictionary.to_pylist()
        values = self.spaced_ids.all(distinct, self._after_space)
        opened = np.array([v is OPEN for v in values], bool)
        heads = [distinct[k] for k in which[at[:-1]]]
        # a text's first part has no space before it
        which[at[:-1]] = len(values) + np.arange(len(texts))
        opened = np.append(opened, [open_ended(h) for h in heads])
        whole = np.logical_or.reduceat(opened[which], at[:-1])
        if whole.any():
            empty = len(values) + len(heads)
            rest = np.repeat(whole, np.diff(at))
            rest[at[:-1]] = False
            which[rest] = empty
            for i in np.flatnonzero(whole):
                heads[i] = texts[i].as_py()
        values = pa.array(values + self._heads(heads) + [b""], pa.large_binary())
        ids = values.take(pa.array(which))
        ends = np.frombuffer(ids.buffers()[1], np.int64)[:len(which) + 1][at] // 4
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(ids.buffers()[2], np.int32)[:ends[-1]]))

    # ------------------------------------------------------------ decoding
    def _decode_runs(self, runs: list[bytes]) -> list[bytes]:
        sizes = np.array([len(r) // 4 for r in runs], np.int64)
        token = np.frombuffer(b"".join(runs), np.int32)
        run, place = _numbered(sizes)
        self.db.register("runs", pa.table({"run": run, "place": place, "token": token}))
        done = self.db.sql(DECODE).to_arrow_table().combine_chunks()
        self.db.unregister("runs")
        if not done.num_rows:
            return []
        parts = done.column("parts").chunk(0)
        if not np.array_equal(np.diff(parts.offsets), sizes[done.column("run")]):
            raise ValueError("an id is not in the vocabulary")
        # the parts of a run lie one behind the other
        tokens = parts.values
        ends = np.frombuffer(tokens.buffers()[1], np.int32)[parts.offsets.to_numpy() + tokens.offset].tolist()
        data = tokens.buffers()[2].to_pybytes()
        out = [b""] * len(runs)
        for i, lo, hi in zip(done.column("run").to_pylist(), ends, ends[1:]):
            out[i] = data[lo:hi]
        return out

    def decode(self, rows: pa.ListArray) -> pa.BinaryArray:
        """The bytes of each row of ids (list of int32)."""
        at = rows.offsets.to_numpy()
        ids = rows.values.slice(at[0], at[-1] - at[0]).cast(pa.int32())
        if ids.null_count:
            raise ValueError("an id is null")
        ids, at = ids.to_numpy(), at - at[0]
        if not len(ids):
            return pa.array([b""] * len(rows), pa.binary())
        if ids.min() < 0 or ids.max() >= len(self.spaced):
            raise ValueError("an id is not in the vocabulary")
        begins = self.spaced[ids]
        begins[at[:-1][np.diff(at) > 0]] = True
        begins = np.flatnonzero(begins)
        offsets = pa.py_buffer((4 * np.append(begins, len(ids))).astype(np.int32).tobytes())
        runs = pa.BinaryArray.from_buffers(pa.binary(), len(begins), [None, offsets, pa.py_buffer(ids.tobytes())]).dictionary_encode()
        values = pa.array(self.run_bytes.all(runs.dictionary.to_pylist(), self._decode_runs), pa.large_binary())
        text = values.take(runs.indices)
        ends = np.frombuffer(text.buffers()[1], np.int64)[:len(begins) + 1][np.searchsorted(begins, at)]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(rows), [None, pa.py_buffer(ends.tobytes()), text.buffers()[2]]).cast(pa.binary())


class _Long:
    """Encoding a long word by windows: what is settled, and the open tiling
    (ids, ends) that the next windows must share a token with."""

    def __init__(self, size: int):
        self.size, self.window, self.turn = size, WINDOW, 0
        self.settled: list[np.ndarray] = []
        self.open: tuple[np.ndarray, np.ndarray] | None = None
        self.done = False

    def begins(self) -> list[int]:
        step = max(1, int(self.window * STRIDES[self.turn]))
        if self.open is None:
            at = [0]
        else:  # at a token's end, so that a run of one sign goes on in step
            ends = self.open[1]
            at = [int(ends[len(ends) * (self.turn + 1) // (len(STRIDES) + 2)])]
        while at[-1] + self.window < self.size:
            at.append(at[-1] + step)
        return at

    def join(self, tilings: list[tuple[np.ndarray, np.ndarray]], length: np.ndarray) -> None:
        moved = False
        for ids, ends in tilings:
            if self.open is not None:
                mine, stops = self.open
                same = np.intersect1d(stops * len(length) + length[mine], ends * len(length) + length[ids])
                if not len(same):
                    return self._again(moved)
                at = same[0] // len(length)
                self.settled.append(mine[:np.searchsorted(stops, at) + 1])
                after = np.searchsorted(ends, at) + 1
                ids, ends = ids[after:], ends[after:]
                moved = True
            self.open = (ids, ends)
        self.settled.append(self.open[0])
        self.done = True

    def _again(self, moved: bool) -> None:
        self.turn = 1 if moved and self.turn == 0 else self.turn if moved else self.turn + 1
        if self.turn == len(STRIDES):
            self.turn, self.window = 0, 2 * self.window
        if self.window >= self.size or self.open[1][-1] >= self.size or len(self.open[0]) < 2:
            # the whole word at once
            self.settled, self.open, self.turn, self.window = [], None, 0, self.size


def _numbered(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each member of groups of these sizes: its group and its place there (int32)."""
    place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return np.repeat(np.arange(len(sizes), dtype=np.int32), sizes), place.astype(np.int32)


def _cut(data: bytes, ends: np.ndarray) -> list[bytes]:
    """The parts of ``data`` between neighbouring ``ends``."""
    ends = ends.tolist()
    return [data[lo:hi] for lo, hi in zip(ends, ends[1:])]


#: Stands for ids that depend on what is beside a stretch.
OPEN = b"open"


@functools.lru_cache(maxsize=2)
def coder(name: str, pattern: str) -> ByteBpe:
    """The coder of a shipped rank file, kept by the Python worker."""
    return ByteBpe(read_ranks(shipped(name)), pattern)


# ------------------------------------------------------------------ Spark
def _encoded(batches, name: str, pattern: str):
    """(doc_id, ids) of batches of (doc_id, text)."""
    for batch in batches:
        for part in slices(batch, "text", SLICE_BYTES):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), coder(name, pattern).encode(part.column("text"))], names=["doc_id", "ids"])


def _decoded(batches, name: str, pattern: str):
    """(doc_id, ids, decoded) of batches of (doc_id, ids)."""
    for batch in batches:
        ends = batch.column("ids").offsets.to_numpy()
        at = 0
        while at < batch.num_rows:
            stop = max(at + 1, int(np.searchsorted(ends, ends[at] + SLICE_BYTES // 4, "right")) - 1)
            part = batch.slice(at, stop - at)
            yield pa.RecordBatch.from_arrays([*part.columns, coder(name, pattern).decode(part.column("ids"))], names=["doc_id", "ids", "decoded"])
            at = stop


def _mapped(rows: DataFrame, value: str, rank_path: str, more: str, work) -> DataFrame:
    """``work(batches, name of the shipped rank file)`` over (doc_id, value)."""
    spark = rows.sparkSession
    prepare(spark)
    name = ship_file(spark, rank_path)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", value).mapInArrow(lambda batches: work(batches, name), f"doc_id {kind}, {more}")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def encode(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (array of int) of every row's whole text."""
    return _mapped(_texts(docs, id_col, text_col), "text", rank_path, "ids array<int>", lambda batches, name: _encoded(batches, name, pattern))


def decode(encoded: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, ids and decoded (binary) of every row; null ids decode to nothing."""
    rows = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return _mapped(rows, "ids", rank_path, "ids array<int>, decoded binary", lambda batches, name: _decoded(batches, name, pattern))


def round_trip(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``decode`` of ``encode`` in one pass: one Python worker and one
    vocabulary a task."""
    return _mapped(_texts(docs, id_col, text_col), "text", rank_path, "ids array<int>, decoded binary",
                   lambda batches, name: _decoded(_encoded(batches, name, pattern), name, pattern))


def digests(decoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of ``decode``'s rows."""
    ids = F.coalesce(F.col("ids"), F.array().cast("array<int>"))
    return decoded.select("doc_id", F.size(ids).cast("long").alias("n_tokens"),
                          F.sha2(F.array_join(ids.cast("array<string>"), ","), 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))
