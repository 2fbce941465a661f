"""Best-fit packing of tokenised documents by a grouping genetic algorithm.

Documents are tokenised, ended with a separator id and cut into pieces only if
they are longer than a sequence.  Pieces are dealt at random over packing
shards of bounded size; each shard is evolved by several islands, a Spark task
each.  A genome is the bin of every piece.  Crossover injects whole well-filled
bins of one parent into the other, removes the bins that hold a second copy of
an injected piece, and puts the displaced pieces back by best fit, longest
first.  After each epoch an island sends its best genome to the next one.

Defined cases: a null or empty text is the separator alone; repeated rows are
packed each; ties go to the lower bin; an empty table gives an empty result.
Nothing depends on the order in which Spark returns rows once the pieces are
written.
"""

from __future__ import annotations

import math
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, python_bytes, slices, task_rows, written
from .memo import Memo

CAPACITY = 2048
#: Pieces in a packing shard, islands of a shard, epochs, genomes of an island
#: and children bred in an epoch.
SHARD_PIECES, ISLANDS, EPOCHS, GENOMES, CHILDREN = 4096, 2, 2, 4, 6
#: Fill from which a bin counts as well filled, and the share of those bins
#: that a crossover injects.
WELL_FILLED, INJECTED = 0.995, 0.5

#: Characters that normalise, lower-case and split alike in Python and in the
#: tokenizer library: printable ASCII and precomposed Latin letters.
_PLAIN = re.compile(r"[!-;=-~À-ÖØ-öø-įı-ňŊ-ž]+")
#: How this tokenizer splits such characters: contractions, letters, single
#: digits, other signs.
_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|[0-9]|(?:[^\w]|_)+")


class WordTokenizer:
    """Ids (little-endian uint32 bytes) of texts under a tokenizer that drops
    white space: the ids of a text are those of its words one after another,
    so each distinct word is encoded once while it stays in a bounded memo."""

    def __init__(self, path: str, memo_words: int = 300_000):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.parts = Memo(self._encode_part, memo_words)
        self.words = Memo(self._encode_word, memo_words)
        self.byte_level = {}

    def _encode_word(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        if _PLAIN.fullmatch(text):
            return b"".join([self.parts[p] for p in _SPLIT.findall(text.lower())])
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _encode_part(self, part: str) -> bytes:
        if not part.isascii():
            part = "".join([self._shown(ch) for ch in part])
        ids = [t.id for t in self.tokenize(part)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _shown(self, ch: str) -> str:
        """A character as the tokenizer's byte level shows it."""
        if ch not in self.byte_level:
            from tokenizers.pre_tokenizers import ByteLevel
            self.byte_level[ch] = "".join(s for s, _ in ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(ch))
        return self.byte_level[ch]

    def encode(self, text: bytes) -> bytes:
        return b"".join(self.words.many(text.split()))


_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, row long"


def cut_pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
               capacity: int = CAPACITY, separator: int = 0, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and row (a
    number of its own); ids (array<int>) too if asked for."""
    end = np.array([separator], "<u4").tobytes()
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("row", pa.int64())]
    schema = pa.schema(fields + [("ids", pa.list_(pa.int32()))] * with_ids)

    def cut(batches):
        tokenizer, numbers = WordTokenizer(tokenizer_path), task_rows()
        for batch in batches:
            for part in slices(batch, "text", 8 << 20):
                out: list[list] = [[] for _ in schema]
                for doc, text in zip(part.column("doc_id").to_pylist(), python_bytes(part.column("text"))):
                    ids = tokenizer.encode(text) + end
                    for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                        piece = ids[at:at + 4 * capacity]
                        row = [doc, n, at // 4, len(piece) // 4, zlib.crc32(piece), next(numbers)]
                        if with_ids:
                            row.append(np.frombuffer(piece, "<u4").astype(np.int32))
                        for column, value in zip(out, row):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return source.mapInArrow(cut, _PIECES + (", ids array<int>" if with_ids else ""))


class Free:
    """Bins by their free space; finds the tightest one that fits."""

    def __init__(self, capacity: int, loads: np.ndarray):
        self.at: dict[int, list[int]] = {}
        self.mask = 0
        self.capacity = capacity
        for b in np.flatnonzero((loads > 0) & (loads < capacity))[::-1].tolist():
            self._put(b, capacity - int(loads[b]))
        self.next = len(loads)

    def _put(self, b: int, free: int) -> None:
        if free:
            self.at.setdefault(free, []).append(b)
            self.mask |= 1 << free

    def place(self, length: int) -> int:
        fits = self.mask >> length
        if not fits:
            b, free = self.next, self.capacity
            self.next += 1
        else:
            free = length + (fits & -fits).bit_length() - 1
            bins = self.at[free]
            b = bins.pop()
            if not bins:
                self.mask ^= 1 << free
        self._put(b, free - length)
        return b


def best_fit(lengths: np.ndarray, bins: np.ndarray, items: np.ndarray, capacity: int) -> np.ndarray:
    """``bins`` with ``items`` (in this order) put where they fit best."""
    bins = bins.copy()
    placed = np.ones(len(lengths), bool)
    placed[items] = False
    loads = np.bincount(bins[placed], lengths[placed], minlength=1 + int(bins.max(initial=-1))).astype(np.int64)
    free = Free(capacity, loads)
    bins[items] = [free.place(n) for n in lengths[items].tolist()]
    return bins


def renumber(bins: np.ndarray) -> np.ndarray:
    return np.unique(bins, return_inverse=True)[1].astype(np.int32)


def fitness(lengths: np.ndarray, bins: np.ndarray, capacity: int) -> tuple[int, float]:
    """Lower is better: bins, then the evenness of their fill."""
    loads = np.bincount(bins, lengths)
    loads = loads[loads > 0]
    return len(loads), -float(np.square(loads / capacity).sum())


def crossover(lengths, first, second, capacity, rng) -> np.ndarray:
    """A child of ``first`` with whole well-filled bins of ``second``."""
    loads = np.bincount(second, lengths)
    good = np.flatnonzero(loads >= WELL_FILLED * capacity)
    if not len(good):
        good = np.flatnonzero(loads == loads.max(initial=0))
    good = rng.permutation(good)[:max(1, int(len(good) * INJECTED))]
    injected = np.isin(second, good)
    # bins of the first parent that hold an injected piece go
    broken = np.isin(first, np.unique(first[injected]))
    child = np.where(injected, second + 1 + first.max(initial=0), first)
    displaced = np.flatnonzero(broken & ~injected)
    order = np.lexsort((rng.random(len(displaced)), -lengths[displaced]))
    return renumber(best_fit(lengths, child, displaced[order], capacity))


def mutate(lengths, bins, capacity, rng) -> np.ndarray:
    """Empties the worst filled bins and a few others, and packs them again."""
    loads = np.bincount(bins, lengths)
    worst = np.argsort(loads, kind="stable")[:max(2, len(loads) // 50)]
    gone = np.concatenate([worst, rng.integers(0, len(loads), max(1, len(loads) // 50))])
    items = np.flatnonzero(np.isin(bins, gone))
    order = np.lexsort((rng.random(len(items)), -lengths[items]))
    return renumber(best_fit(lengths, bins, items[order], capacity))


def first_genomes(lengths: np.ndarray, capacity: int, rng, count: int) -> list[np.ndarray]:
    """Best fit by falling length, then with lengths blurred a little."""
    out = []
    for i in range(count):
        blurred = lengths * (1 + 0.1 * rng.random(len(lengths)) * (i > 0))
        order = np.argsort(-blurred, kind="stable")
        out.append(renumber(best_fit(lengths, np.zeros(len(lengths), np.int64), order, capacity)))
    return out


def evolve(lengths: np.ndarray, genomes: list[np.ndarray], capacity: int, seed: int, children: int = CHILDREN) -> list[np.ndarray]:
    """The genomes after breeding, best first."""
    rng = np.random.default_rng(seed)
    pool = genomes + first_genomes(lengths, capacity, rng, max(0, GENOMES - len(genomes)))
    pool = sorted(((fitness(lengths, g, capacity), n, g) for n, g in enumerate(pool)), key=lambda x: x[:2])
    least = math.ceil(lengths.sum() / capacity)
    for n in range(children):
        if pool[0][0][0] <= least:
            break
        a, b = rng.permutation(len(pool))[:2]
        child = crossover(lengths, pool[min(a, b)][2], pool[max(a, b)][2], capacity, rng)
        child = mutate(lengths, child, capacity, rng)
        pool.append((fitness(lengths, child, capacity), GENOMES + n, child))
        pool = sorted(pool, key=lambda x: x[:2])[:GENOMES]
    return [g for _, _, g in pool]


_STATE = "shard long, island int, bins long, fill double, genome binary"


def _island(capacity: int, children: int, epoch: int):
    schema = pa.schema([("shard", pa.int64()), ("island", pa.int32()), ("bins", pa.int64()), ("fill", pa.float64()), ("genome", pa.binary())])

    def step(key, items: pa.Table, states: pa.Table) -> pa.Table:
        shard, island = key[0].as_py(), key[1].as_py()
        items = items.sort_by("row")
        lengths = items.column("length").to_numpy().astype(np.int64)
        if not len(lengths):
            return schema.empty_table()
        states = states.sort_by([("bins", "ascending"), ("fill", "ascending"), ("genome", "ascending")])
        genomes = [np.frombuffer(g, np.int32) for g in states.column("genome").to_pylist()][:GENOMES]
        pool = evolve(lengths, genomes, capacity, shard * 7919 + island * 31 + epoch, children)
        # its best stays and also goes to the next island; the second best stays
        out = []
        for to, g in [(island, pool[0]), ((island + 1) % ISLANDS, pool[0]), *[(island, g) for g in pool[1:2]]]:
            bins, fill = fitness(lengths, g, capacity)
            out.append((shard, to, bins, fill, g.astype(np.int32).tobytes()))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return step


def _place(capacity: int):
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                        ("row", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def place(key, items: pa.Table, states: pa.Table) -> pa.Table:
        items = items.sort_by("row")
        if not items.num_rows:
            return schema.empty_table()
        best = states.sort_by([("bins", "ascending"), ("fill", "ascending"), ("genome", "ascending")]).column("genome")[0].as_py()
        bins = np.frombuffer(best, np.int32).astype(np.int64)
        lengths = items.column("length").to_numpy()
        order = np.argsort(bins, kind="stable")
        before = np.cumsum(lengths[order]) - lengths[order]
        new = np.diff(bins[order], prepend=-1) != 0
        offset = np.empty(len(bins), np.int64)
        offset[order] = before - np.maximum.accumulate(np.where(new, before, 0))
        items = items.select(schema.names[:6])
        return items.append_column("sequence_id", pa.array((key[0].as_py() << 32) + bins)).append_column("offset", pa.array(offset)).cast(schema)

    return place


def pack(pieces: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES, epochs: int = EPOCHS, children: int = CHILDREN) -> DataFrame:
    """``pieces`` (written rows of ``cut_pieces``) with sequence_id and offset."""
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "row"]
    full = pieces.filter(F.col("length") >= capacity).select(*columns, (-F.col("row") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = pieces.filter(F.col("length") < capacity).select(*columns)
    shards = max(1, math.ceil(rest.count() / shard_pieces))
    rest = written(rest.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards))), "pack-pieces")
    island = F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island")
    items = rest.select("shard", "row", "length", island)
    state = rest.sparkSession.createDataFrame([], _STATE)
    for epoch in range(epochs):
        state = written(items.groupBy("shard", "island").cogroup(state.groupBy("shard", "island"))
                        .applyInArrow(_island(capacity, children, epoch), _STATE), "pack-state")
    best = state.groupBy("shard").agg(F.min(F.struct("bins", "fill", "genome")).alias("s")).select("shard", "s.*")
    placed = rest.groupBy("shard").cogroup(best.groupBy("shard")).applyInArrow(
        _place(capacity), _PIECES + ", sequence_id long, offset long")
    return placed.unionByName(full)


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY, with_ids: bool = False, **options) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id
    and offset; with ``with_ids`` also ids, the piece's token ids."""
    prepare(docs.sparkSession)
    pieces = written(cut_pieces(docs, tokenizer_path, id_col, text_col, capacity, with_ids=with_ids), "pieces")
    placed = pack(pieces, capacity, **options)
    if with_ids:
        placed = placed.join(pieces.select("row", "ids"), "row")
    return placed.drop("row")
