"""Cross-tokenizer alignment by lockstep vectorised merging.

Tokenizer A (byte-level BPE, ``tokenizers``) reads a space and the text,
tokenizer B (``sentencepiece``) the text, before which it puts a space itself.
Where the bytes of both add up to the same, byte offsets at which an A token and
a B token both end are cuts; the tokens between two cuts are a group, and every
A token of a group is linked with every B token of it.

``lockstep`` merges the token ends of all documents of a slice at once: one
NumPy state vector holds each open document's place in A and in B, one step
advances the one whose token ends first (both where they end together, which is
a cut), and finished documents are taken out of the vector as it empties.  A
long document goes in as several parts, cut where A and B are known to end
together, so that few steps pass all of them.

Link statistics need corpus-wide counts of the linked id pairs.  Documents are
packed into chunks, a chunk's distinct pairs (not its links) are sent out and
counted, and each chunk gets the counts of its pairs back once; a pair that all
documents hold is one row a chunk.

Defined cases: a text that is null, empty, or whose A or B bytes differ from a
space and the text has no tokens, no groups and no links; repeated rows and
null ids keep a row each, and count as a document each; an empty table gives an
empty result; other columns of the input are not read.
"""

from __future__ import annotations

import functools
import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import open_ended, prepare, ship_file, shipped, slices, task_rows, written
from .memo import Memo

#: Bytes of text whose documents are merged in lockstep at a time, and make a chunk.
SLICE_BYTES = 4 << 20
#: Distinct stretches of text that a memo's young half holds.
MEMO_STRETCHES = 120_000
#: Texts that the tokenizers' libraries get at a time.
ENCODED = 2048
#: Stretches that A's library gets as one text.
JOINED = 64
#: Stretches of a document that make a part in the lockstep merge.
PART_STRETCHES = 64
#: Links that are expanded at a time.
LINK_ROWS = 512 << 10


# ---------------------------------------------------------------- tokens
def _letters() -> dict[str, int]:
    """The byte that each sign of a byte-level vocabulary stands for."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


def _spell(ids: list[list[int]], spelt: list[bytes], length: np.ndarray, wants: list[bytes]) -> bool:
    """Whether the bytes of each of the id lists are the wanted ones."""
    flat = [*itertools.chain.from_iterable(ids)]
    ends = np.append(0, np.cumsum(length[np.array(flat, np.int64)]))[np.cumsum([len(x) for x in ids])]
    return np.array_equal(ends, np.cumsum([len(w) for w in wants])) and b"".join(map(spelt.__getitem__, flat)) == b"".join(wants)


def _spelt_alike(ids: list[list[int]], spelt: list[bytes], length: np.ndarray, wants: list[bytes]) -> np.ndarray:
    """For each id list, whether its bytes are the wanted ones."""
    if _spell(ids, spelt, length, wants):
        return np.ones(len(ids), bool)
    return np.array([b"".join([spelt[i] for i in x]) == want for x, want in zip(ids, wants)], bool)


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all lists, and how many each has."""
    return np.fromiter(itertools.chain.from_iterable(ids), np.int32), np.array([len(x) for x in ids], np.int64)


class Tokens:
    """Both tokenizers: ids and byte ends of texts, with a memo of stretches."""

    def __init__(self, a_path: str, b_path: str, memo_stretches: int = MEMO_STRETCHES):
        import os
        import re
        import sentencepiece
        from tokenizers import Tokenizer
        # a task has one core; the library's own threads would only wait
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte = _letters()
        vocab = self.a.get_vocab(with_added_tokens=False)
        self.a_bytes = {i: bytes(byte[c] for c in t) for t, i in vocab.items()}
        names = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.b_bytes = {i: bytes([int(n[3:5], 16)]) if self.b.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)}
        # by id; an added token, which is no entry, spells nothing
        self.a_spelt = [self.a_bytes.get(i, b"") for i in range(max(self.a.get_vocab(with_added_tokens=True).values()) + 1)]
        self.b_spelt = [self.b_bytes[i] for i in range(len(names))]
        self.a_length, self.b_length = (np.array([len(x) for x in spelt], np.int64) for spelt in (self.a_spelt, self.b_spelt))
        # no piece reaches from a word into the space after it, or over a line's end
        self.by_word = not any(re.search("[^▁]▁|.\n|\n.", n) for n in names)
        self.memo = Memo(None, memo_stretches)

    def _a_ids(self, texts: list[str], wants: list[bytes], step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Flat A ids, how many each text has, and whether their bytes are the
        wanted ones; the library gets ``step`` texts as one."""
        joined = range(0, len(texts), step)
        ids = self._encode_a([" ".join(texts[k:k + step]) for k in joined])
        if step == 1:
            return *_flat(ids), _spelt_alike(ids, self.a_spelt, self.a_length, wants)
        if _spell(ids, self.a_spelt, self.a_length, [b"".join(wants[k:k + step]) for k in joined]):
            flat, _ = _flat(ids)
            sizes, stops = self.a_length[flat], np.cumsum([len(w) for w in wants])
            ends = np.cumsum(sizes)
            last = np.searchsorted(ends, stops)
            if sizes.all() and np.array_equal(ends[last], stops):
                return flat, np.diff(last, prepend=-1), np.ones(len(texts), bool)
        return self._a_ids(texts, wants, 1)

    def _encode_a(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]

    def _both(self, texts: list[str], step: int = 1) -> list[bytes]:
        """A and B ids of whole texts, packed as int32 bytes; ``DIFFERS`` where
        their bytes are not a space and the text.  ``step`` texts that stand
        alone are one text for A."""
        out = []
        # (an encoding holds far more than its ids, so only some are kept at a time)
        for lo in range(0, len(texts), ENCODED):
            some = texts[lo:lo + ENCODED]
            wants = [b" " + t.encode() for t in some]
            a, n_a, same = self._a_ids(some, wants, step)
            b_all = self.b.encode(some, num_threads=1)
            same &= _spelt_alike(b_all, self.b_spelt, self.b_length, wants)
            b, n_b = _flat(b_all)
            # the number of A ids, A ids, B ids
            ends = np.append(0, np.cumsum(1 + n_a + n_b))
            ids = np.empty(ends[-1], np.int32)
            ids[ends[:-1]] = n_a
            ids[np.arange(len(a)) + np.repeat(ends[:-1] + 1 - (np.cumsum(n_a) - n_a), n_a)] = a
            ids[np.arange(len(b)) + np.repeat(ends[1:] - np.cumsum(n_b), n_b)] = b
            data, ends = ids.tobytes(), (4 * ends).tolist()
            out += [data[x:y] if ok else DIFFERS for x, y, ok in zip(ends, ends[1:], same.tolist())]
        return out

    def _stretches(self, parts: list[bytes]) -> list[bytes]:
        """The ids of stretches of a text that stand alone between spaces; no
        token of A or B reaches over such a place, and both see a space before
        what follows.  ``OPEN`` where that does not hold."""
        sign = "▁".encode()
        closed = [self.by_word and not open_ended(p) and sign not in p for p in parts]
        found = iter(self._both([p.decode("utf-8", "replace") for p, ok in zip(parts, closed) if ok], JOINED))
        return [next(found) if ok else OPEN for ok in closed]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, ...]:
        """Flat A ids with the offsets of parts of texts, flat B ids with
        theirs, and each text's first part.  A and B end together at a part's
        end.  Texts are UTF-8; null, empty ones and those that differ have no
        tokens."""
        import pyarrow.compute as pc
        texts = pc.fill_null(texts.cast(pa.binary()), b"")
        if not len(texts):
            return (np.zeros(0, np.int32), np.zeros(1, np.int64)) * 2 + (np.zeros(1, np.int64),)
        parts = pc.split_pattern(texts, pattern=b" ")
        at = parts.offsets.to_numpy()
        pieces = parts.values.slice(at[0], at[-1] - at[0]).dictionary_encode()
        at = at - at[0]
        which = pieces.indices.to_numpy().astype(np.int64)
        values = self.memo.all(pieces.dictionary.to_pylist(), self._stretches)
        opened, differs = (np.logical_or.reduceat(np.array([v is mark for v in values], bool)[which], at[:-1]) for mark in (OPEN, DIFFERS))
        # texts that are seen whole; a place with no tokens stands before theirs
        whole = np.flatnonzero(opened & (pc.binary_length(texts).to_numpy() > 0))
        none = len(values)
        which[np.repeat(opened | differs, np.diff(at))] = none
        which[at[whole]] = none + 1 + np.arange(len(whole))
        values += [DIFFERS] + self._both([texts[i].as_py().decode("utf-8", "replace") for i in whole])
        del pieces, parts
        # the number of A ids, A ids and B ids of each value lie one behind the other
        ends = np.append(0, np.cumsum(np.fromiter(map(len, values), np.int64)))
        data = b"".join(values)
        begins = np.empty(3 * len(values) + 1, np.int64)
        begins[::3] = ends
        begins[1::3] = ends[:-1] + 4
        begins[2::3] = begins[1::3] + 4 * np.maximum(0, np.frombuffer(data, np.int32)[ends[:-1] // 4])
        values = pa.LargeBinaryArray.from_buffers(pa.large_binary(), 3 * (len(ends) - 1), [None, pa.py_buffer(begins), pa.py_buffer(data)])
        n_parts = -(-np.diff(at) // PART_STRETCHES)
        first = np.append(0, np.cumsum(n_parts))
        begin = np.repeat(at[:-1], n_parts) + PART_STRETCHES * (np.arange(first[-1]) - np.repeat(first[:-1], n_parts))
        begin = np.append(begin, len(which))
        out = []
        for side in (1, 2):
            ids = values.take(pa.array(3 * which + side))
            ends = np.frombuffer(ids.buffers()[1], np.int64)[:len(which) + 1][begin] // 4
            out += [np.frombuffer(ids.buffers()[2] or b"", np.int32)[:ends[-1]], ends]
        return *out, first


#: Stand for a stretch that cannot be seen alone, and for one whose bytes differ
#: (instead of a number of A ids).
OPEN, DIFFERS = (mark.to_bytes(4, "little", signed=True) for mark in (-1, -2))


# -------------------------------------------------------------- lockstep
def lockstep(a_ends: np.ndarray, a_at: np.ndarray, b_ends: np.ndarray, b_at: np.ndarray) -> tuple[np.ndarray, ...]:
    """Cuts of many documents at once.  Document d's token ends are
    ``a_ends[a_at[d]:a_at[d + 1]]`` and ``b_ends[b_at[d]:b_at[d + 1]]``; both
    lists are empty or end at the same offset.

    Returns arrays (document, A tokens, B tokens) in document order, then in
    order of place: each cut with the number of the document's tokens up to it."""
    doc = np.flatnonzero(np.diff(a_at) > 0)
    i, j = a_at[doc].copy(), b_at[doc].copy()
    stop = a_at[doc + 1]
    docs, lefts, rights = [], [], []
    left, right = (a_ends[i], b_ends[j]) if len(doc) else (a_ends[:0], b_ends[:0])
    while len(doc):
        cut = left == right
        # the token that ends first is passed; both where they end together
        i = i + (left <= right)
        j = j + (left >= right)
        if cut.any():
            docs.append(doc[cut])
            lefts.append(i[cut])
            rights.append(j[cut])
            over = i == stop
            if over.any():
                # a document's last tokens end together: take it out
                doc, i, j, stop = (x[~over] for x in (doc, i, j, stop))
        left, right = a_ends[i], b_ends[j]
    if not docs:
        none = np.zeros(0, np.int64)
        return none, none, none
    d, left, right = np.concatenate(docs), np.concatenate(lefts), np.concatenate(rights)
    # steps come in order, so a stable sort by document will do
    order = np.argsort(d.astype(np.uint16) if d.max() < 1 << 16 else d, kind="stable")
    d = d[order]
    return d, left[order] - a_at[d], right[order] - b_at[d]


class Slice:
    """The alignment of some documents: flat ids with offsets, and cuts."""

    def __init__(self, tokens: Tokens, texts: pa.Array):
        self.a, a_at, self.b, b_at, first = tokens.encode(texts)
        # (a part's tokens add up to the same in A and B, so running sums will do)
        part, a_cut, b_cut = lockstep(np.cumsum(tokens.a_length[self.a]), a_at, np.cumsum(tokens.b_length[self.b]), b_at)
        self.size = len(texts)
        self.a_at, self.b_at = a_at[first], b_at[first]
        # groups: flat positions where each begins and ends; a group begins where the one before it ends
        a_cut += a_at[part]
        b_cut += b_at[part]
        self.doc = np.repeat(np.arange(self.size), np.diff(first))[part]
        del part
        bounds = np.append(0, a_cut)
        self.a_begin, self.a_stop = bounds[:-1], bounds[1:]
        bounds = np.append(0, b_cut)
        self.b_begin, self.b_stop = bounds[:-1], bounds[1:]

    def cuts(self) -> tuple[np.ndarray, np.ndarray]:
        """Each group's end as a number of A and of B tokens of its document."""
        return self.a_stop - self.a_at[self.doc], self.b_stop - self.b_at[self.doc]

    def per_doc(self, weights: np.ndarray | None = None) -> np.ndarray:
        """Groups of each document, or the sum of a weight of its groups."""
        out = np.bincount(self.doc, weights, self.size)
        return out.astype(np.int64)

    def links(self):
        """(document, A id, B id, times) in parts of about LINK_ROWS rows:
        every link, equal ones of a group together."""
        p, q = self.a_stop - self.a_begin, self.b_stop - self.b_begin
        n = p * q
        plain = np.flatnonzero(n <= LINK_ROWS // 64)
        bounds = np.searchsorted(np.cumsum(n[plain]), np.arange(LINK_ROWS, int(n[plain].sum()) + LINK_ROWS, LINK_ROWS), "right")
        for lo, hi in zip(np.append(0, bounds[:-1]), bounds):
            g = plain[lo:hi]
            if len(g):
                which = np.repeat(g, n[g])
                k = np.arange(len(which)) - np.repeat(np.cumsum(n[g]) - n[g], n[g])
                yield self.doc[which], self.a[self.a_begin[which] + k // q[which]], self.b[self.b_begin[which] + k % q[which]], np.ones(len(which), np.int64)
        for g in np.flatnonzero(n > LINK_ROWS // 64):
            # a long group repeats its ids: pairs of distinct ids, with their number
            a, na = np.unique(self.a[self.a_begin[g]:self.a_stop[g]], return_counts=True)
            b, nb = np.unique(self.b[self.b_begin[g]:self.b_stop[g]], return_counts=True)
            step = max(1, LINK_ROWS // len(b))
            for lo in range(0, len(a), step):
                x, nx = a[lo:lo + step], na[lo:lo + step]
                times = np.outer(nx, nb).ravel()
                yield np.full(len(times), self.doc[g]), np.repeat(x, len(b)), np.tile(b, len(x)), times

    def groups_sha256(self) -> list[str]:
        """Hex SHA-256 of each document's groups as `a1,a2|b1;a3|b2,b3`, empty
        for a document without tokens."""
        na, nb = self.a_stop - self.a_begin, self.b_stop - self.b_begin
        # the tokens in written order, each with the sign after it
        begin = np.cumsum(na + nb) - (na + nb)
        ids = np.zeros(len(self.a) + len(self.b), np.int64)
        sign = np.full(len(ids), ord(","), np.uint8)
        ids[np.arange(len(self.a)) + np.repeat(begin - self.a_begin, na)] = self.a
        ids[np.arange(len(self.b)) + np.repeat(begin + na - self.b_begin, nb)] = self.b
        sign[begin + na - 1] = ord("|")
        sign[begin + na + nb - 1] = ord(";")
        at = self.a_at + self.b_at
        out = []
        lo = 0
        while lo < self.size:
            hi = max(lo + 1, int(np.searchsorted(at, at[lo] + (1 << 20), "right")) - 1)
            text, ends = _decimal(ids[at[lo]:at[hi]], sign[at[lo]:at[hi]])
            ends = ends[at[lo:hi + 1] - at[lo]]
            out += [hashlib.sha256(text[x:y - 1]).hexdigest() if y > x else "" for x, y in zip(ends, ends[1:])]
            lo = hi
        return out


def _decimal(ids: np.ndarray, sign: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The decimal numbers, each with its sign, and where each begins."""
    digits, sizes = _digits(len(str(int(ids.max()))) if len(ids) else 1)
    signs = digits[ids]
    signs[:, -1] = sign
    flat = signs.ravel()
    return flat[flat > 0].tobytes(), np.append(0, np.cumsum(sizes[ids]))


@functools.lru_cache(maxsize=8)
def _digits(width: int) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of at most ``width`` digits (ids of a vocabulary) in decimal,
    zeros before them and a place for a sign after them; their sizes with it."""
    rest, more = np.arange(10 ** width), np.ones(10 ** width, bool)
    signs = np.ones((len(rest), width + 1), np.uint8)
    for k in range(width - 1, -1, -1):
        signs[:, k] = np.where(more, 48 + rest % 10, 0)
        rest //= 10
        more = rest > 0
    return signs, (signs > 0).sum(1)


@functools.lru_cache(maxsize=1)
def _tokens(a_name: str, b_name: str) -> Tokens:
    """The tokenizers of shipped files, kept by the Python worker."""
    return Tokens(shipped(a_name), shipped(b_name))


def _slices(batches, a_name: str, b_name: str):
    """(ids, Slice) of parts of about SLICE_BYTES of text; parts of several
    batches are put together, so that many documents go in step."""
    held, size = [], 0

    def done():
        ids, texts = (pa.concat_arrays([p.column(c) for p in held]) for c in (0, 1))
        return ids, Slice(_tokens(a_name, b_name), texts)

    for batch in batches:
        for part in slices(batch, "text", SLICE_BYTES):
            if not part.num_rows:
                continue
            n = part.column(1).nbytes
            if held and size + n > SLICE_BYTES:
                yield done()
                held, size = [], 0
            held.append(part)
            size += n
    if held:
        yield done()


# ----------------------------------------------------------------- Spark
def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def _lists(flat: np.ndarray, at: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat, pa.int32()))


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, a_ids, b_ids, a_cuts, b_cuts (arrays of
    int).  Cut k lies after the first a_cuts[k] A tokens and b_cuts[k] B tokens."""
    spark = docs.sparkSession
    prepare(spark)
    names = ship_file(spark, a_path), ship_file(spark, b_path)

    def run(batches):
        for ids, part in _slices(batches, *names):
            cut_at = np.append(0, np.cumsum(part.per_doc()))
            arrays = [ids, _lists(part.a, part.a_at), _lists(part.b, part.b_at), *[_lists(cuts, cut_at) for cuts in part.cuts()]]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "a_ids", "b_ids", "a_cuts", "b_cuts"])

    return _source(docs, id_col, text_col).mapInArrow(run, "doc_id long, " + ", ".join(f"{c} array<int>" for c in ("a_ids", "b_ids", "a_cuts", "b_cuts")))


_CHUNK = "chunk long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups_sha256 array<string>, pairs array<long>, n_docs array<long>, links binary"


def _linked(part: Slice):
    """Distinct (document, pair) with the number of links: (document, place of
    the pair in ``pairs``, times), and ``pairs``, ascending A id << 32 | B id."""
    doc, pair, times = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for d, a, b, n in part.links():
        coded = pa.array(a.astype(np.int64) << 32 | b).dictionary_encode()
        size = len(coded.dictionary)
        key, n = _summed(d * size + coded.indices.to_numpy(), n)
        doc.append(key // size)
        pair.append(coded.dictionary.to_numpy()[key % size])
        times.append(n)
    doc, pair, times = map(np.concatenate, (doc, pair, times))
    pairs, place = np.unique(pair, return_inverse=True)
    # a document may lie in two parts of the links
    key, times = _summed(doc * max(1, len(pairs)) + place, times)
    return key // max(1, len(pairs)), key % max(1, len(pairs)), times, pairs


def _summed(key: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, with the sum of their times."""
    if (times == 1).all():
        key = np.sort(key)
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])[:len(key)])
        return key[first], np.diff(np.append(first, len(key)))
    order = np.argsort(key, kind="stable")
    key, times = key[order], times[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])[:len(key)])
    return key[first], np.add.reduceat(times, first) if len(first) else times[:0]


def link_statistics(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256.  A pair's count is the number of documents that
    hold it linked; n_best counts the links whose pair has its A id's highest."""
    spark = docs.sparkSession
    prepare(spark)
    names = ship_file(spark, a_path), ship_file(spark, b_path)

    def chunks(batches):
        import zstandard
        number = task_rows()
        for ids, part in _slices(batches, *names):
            doc, place, times, pairs = _linked(part)
            per_doc = np.bincount(doc, minlength=part.size).astype(np.int64)
            # unlike its other numbers, a link's number of times is mostly one
            data = np.concatenate([[len(pairs), len(place)], per_doc, place, times]).astype(np.int32 if max(times, default=0) < 2**31 else np.int64)
            n_links = part.per_doc((part.a_stop - part.a_begin) * (part.b_stop - part.b_begin))
            columns = [ids.to_pylist(), np.diff(part.a_at), np.diff(part.b_at), part.per_doc(), n_links, part.groups_sha256(), pairs,
                       np.bincount(place, minlength=len(pairs)), bytes([data.itemsize]) + zstandard.compress(data.tobytes(), 3)]
            yield pa.RecordBatch.from_pydict({c.split()[0]: pa.array([v], _ARROW[c.split()[1]]) for c, v in zip(_CHUNK.split(", "), [next(number), *columns])})

    table = written(_source(docs, id_col, text_col).mapInArrow(chunks, _CHUNK), "alignment-chunks")
    asked = table.select("chunk", F.explode(F.arrays_zip("pairs", "n_docs")).alias("p")).select("chunk", F.col("p.pairs").alias("pair"), F.col("p.n_docs").alias("n"))
    counts = asked.groupBy("pair").agg(F.sum("n").alias("n"))
    a_id = F.shiftright("pair", 32)
    most = counts.groupBy(a_id.alias("a")).agg(F.max("n").alias("most"))
    counts = written(counts.join(most, a_id == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "alignment-counts")
    replies = asked.select(F.col("chunk").alias("of"), "pair").join(counts, "pair")

    def answer(key, left, right):
        import zstandard
        right = right.sort_by("pair")
        n, best = right.column("n").to_numpy(), right.column("best").to_numpy().astype(np.int64)
        row = left.to_pylist()[0]
        blob = row["links"]
        data = np.frombuffer(zstandard.decompress(blob[1:]), {4: np.int32, 8: np.int64}[blob[0]]).astype(np.int64)
        size, links = len(row["doc_id"]), int(data[1])
        per_doc, place, times = data[2:2 + size], data[2 + size:2 + size + links], data[2 + size + links:]

        def total(weight):  # exact in integers
            sums = np.append(0, np.cumsum(weight[place] * times))
            ends = np.append(0, np.cumsum(per_doc))
            return sums[ends[1:]] - sums[ends[:-1]]

        out = {c: row[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
        out |= {"n_best": total(best), "count_sum": total(n), "groups_sha256": row["groups_sha256"]}
        return pa.table({c: pa.array(v, pa.string() if c == "groups_sha256" else pa.int64()) for c, v in out.items()})

    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return table.drop("pairs", "n_docs").groupBy("chunk").cogroup(replies.groupBy("of")).applyInArrow(answer, schema)


_ARROW = {"long": pa.int64(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string()), "binary": pa.binary()}
