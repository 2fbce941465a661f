"""Benchmark decontamination by pigeonhole edit matching.

Texts and benchmark items are compared lower-cased with white space collapsed.
An item of m characters may be found with up to ``rate * m`` edits (insert,
delete, replace).  It is split into one piece more than that budget, so at
least one piece occurs unchanged in every occurrence.  All pieces of all items
are found in one pass over a text (Aho-Corasick).  A piece hit whose neighbour
piece may be near names an interval of the text; an item's intervals are merged
where they meet, and each merged one is verified once with Myers' bit-parallel
edit distance, so that an item costs at most one pass over a text however often
its pieces occur.  Items of fewer than ``min_chars`` characters, where one edit
may make another word, are found with ``short_items`` only, and then only
unchanged and between word ends.

The items are broadcast only in blocks of at most ``BLOCK_CHARS`` characters;
a larger benchmark is matched block by block against all documents.

Defined cases: a null or empty text holds nothing; null items, items of white
space and, without ``short_items``, short items match nothing; equal items are
reported under each id; of several occurrences of an item in a text the one
with the fewest edits, then the first, is reported; an empty table on either
side gives no match; other columns pass through ``drop_contaminated``.
"""

from __future__ import annotations

import math
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, written

RATE = 0.1
MIN_CHARS = 20
#: Characters of benchmark items that one task holds at a time.
BLOCK_CHARS = 8 << 20
#: Output rows that one array stands for at most.
COPIES = 10_000


def normalise(text: str) -> str:
    return " ".join(text.lower().split())


def pieces(item: str, budget: int) -> list[tuple[int, int]]:
    """(start, end) of ``budget + 1`` pieces that cover ``item``."""
    ends = [len(item) * i // (budget + 1) for i in range(budget + 2)]
    return list(zip(ends, ends[1:]))


def myers(pattern: str, text: str, budget: int, masks: dict | None = None) -> tuple[int, int] | None:
    """(edits, end) of the best, then first, occurrence of ``pattern`` in
    ``text`` with at most ``budget`` edits: Myers' bit-parallel algorithm on
    whole-pattern integers."""
    m = len(pattern)
    masks = masks if masks is not None else char_masks(pattern)
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best = full, 0, m, None
    for j, ch in enumerate(text):
        eq = masks.get(ch, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (~(xh | pv) & full)
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = (ph << 1) & full
        mh = (mh << 1) & full
        pv = mh | (~(xv | ph) & full)
        mv = ph & xv
        if score <= budget and (best is None or score < best[0]):
            best = (score, j + 1)
            if not score:
                break
    return best


def char_masks(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, ch in enumerate(pattern):
        masks[ch] = masks.get(ch, 0) | 1 << i
    return masks


class Matcher:
    """Finds the occurrences of a block of items in texts."""

    def __init__(self, items: list[tuple[int, str]], rate: float = RATE, min_chars: int = MIN_CHARS, short_items: bool = False):
        import ahocorasick
        by_text: dict[str, list[int]] = defaultdict(list)
        for i, text in items:
            if text is not None and (n := normalise(text)) and (short_items or len(n) >= min_chars):
                by_text[n].append(i)
        self.items = [(t, ids, int(len(t) * rate) if len(t) >= min_chars else 0) for t, ids in by_text.items()]
        self.short = [len(t) < min_chars for t in by_text]
        self.masks = [(char_masks(t), char_masks(t[::-1])) for t, _, _ in self.items]
        self.pieces = [pieces(t, k) for t, _, k in self.items]
        where: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for n, (t, _, _) in enumerate(self.items):
            for p, (a, b) in enumerate(self.pieces[n]):
                where[t[a:b]].append((n, p))
        self.automaton = ahocorasick.Automaton()
        for piece, at in where.items():
            if piece:
                self.automaton.add_word(piece, (len(piece), at))
        self.empty = not len(self.automaton)
        if not self.empty:
            self.automaton.make_automaton()

    def _parent_holds(self, text: str, n: int, p: int, at: int) -> bool:
        """A group of pieces occurs with fewer edits than it has pieces if any
        path from a piece up to the whole item is to hold.  For the pair of
        pieces that holds ``p``: one edit in the other piece, so one half of it
        is unchanged, at most one place off."""
        all_pieces, item = self.pieces[n], self.items[n][0]
        q = p ^ 1
        if q >= len(all_pieces):
            return True
        a, b = all_pieces[q]
        half = (a + b) // 2
        begin = at + a - all_pieces[p][0]
        near = text[max(0, begin - 1):begin + b - a + 1]
        return item[a:half] in near or item[half:b] in near

    def find(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item id, edits, start, end) of the items that ``text`` holds;
        start and end count characters of the normalised text."""
        if not text or self.empty:
            return []
        text = normalise(text)
        best: dict[int, tuple[int, int, int]] = {}
        spans: dict[int, list[list[int]]] = {}
        for end, (size, at) in self.automaton.iter(text):
            begin = end - size + 1
            for n, p in at:
                if n in best:
                    continue
                item, _, budget = self.items[n]
                expect = begin - self.pieces[n][p][0]
                lo, hi = expect - budget, expect + len(item) + budget
                known = spans.get(n)
                if known and known[-1][0] <= lo and hi <= known[-1][1]:
                    continue
                if expect >= 0 and text.startswith(item, expect):
                    # the first unchanged occurrence sends the first such hit
                    if not self.short[n] or _word_ends(text, expect, expect + len(item)):
                        best[n] = (0, expect, expect + len(item))
                elif budget and self._parent_holds(text, n, p, begin):
                    if known and lo <= known[-1][1] and known[-1][0] <= hi:
                        known[-1] = [min(lo, known[-1][0]), max(hi, known[-1][1])]
                    else:
                        spans.setdefault(n, []).append([lo, hi])
        for n, found in spans.items():
            if n not in best and (got := self._verify(text, n, found)):
                best[n] = got
        return [(i, *got) for n, got in best.items() for i in self.items[n][1]]

    def _verify(self, text: str, n: int, spans: list[list[int]]) -> tuple[int, int, int] | None:
        """(edits, start, end) of the best, then first, occurrence of item ``n``
        in the parts of ``text`` that ``spans`` name."""
        item, _, budget = self.items[n]
        forward, backward = self.masks[n]
        merged: list[list[int]] = []
        for lo, hi in sorted(spans):
            if merged and lo <= merged[-1][1]:
                merged[-1][1] = max(hi, merged[-1][1])
            else:
                merged.append([lo, hi])
        best = None
        for lo, hi in merged:
            lo = max(0, lo)
            if (hit := myers(item, text[lo:hi], budget, forward)) and (best is None or hit[0] < best[0]):
                edits, stop = hit
                # the first end with so few edits, so a backward match begins at it
                near = text[max(lo, lo + stop - len(item) - edits):lo + stop]
                back = myers(item[::-1], near[::-1], edits, backward)
                best = (edits, lo + stop - back[1], lo + stop)
        return best


def _word_ends(text: str, start: int, end: int) -> bool:
    """Whether no letter or digit goes on at either side of a match."""
    return not (start and text[start - 1].isalnum() and text[start].isalnum() or end < len(text) and text[end].isalnum() and text[end - 1].isalnum())


def _blocks(bench: DataFrame, item_col: str, text_col: str):
    """The benchmark in parts of at most about BLOCK_CHARS characters each:
    ((item id, rows that are equal), text).  Equal rows are counted before
    blocks are dealt, so that an item's copies do not fill one."""
    items = bench.select(F.col(item_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text")).filter("text is not null")
    items = written(items.groupBy("item_id", "text").agg(F.count("*").alias("n")), "benchmark-items")
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(1, math.ceil(2 * size / BLOCK_CHARS))
    for part in range(parts):
        block = items if parts == 1 else items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        yield [((r["item_id"], r["n"]), r["text"]) for r in block.collect()]


def _matcher(block, *options):
    """The block's matcher, built once in each task."""
    made = []

    def get():
        if not made:
            made.append(Matcher(block.value, *options))
        return made[0]
    return get


def find_leaks(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", rate: float = RATE, min_chars: int = MIN_CHARS,
               short_items: bool = False) -> DataFrame:
    """One row per document and benchmark item that it holds: doc_id, item_id,
    edits, start, end (long)."""
    spark = docs.sparkSession
    prepare(spark)
    names = ("doc_id", "item_id", "rows", "edits", "start", "end")
    schema = ", ".join(f"{c} long" for c in names)
    arrow = pa.schema([(c, pa.int64()) for c in names])
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = None
    for items in _blocks(bench, item_col, item_text_col):
        matcher = _matcher(spark.sparkContext.broadcast(items), rate, min_chars, short_items)

        def match(batches, matcher=matcher):
            for batch in batches:
                rows = [(i.as_py(), *item, *hit) for i, t in zip(batch.column(0), batch.column(1)) for item, *hit in matcher().find(t.as_py())]
                columns = zip(*rows) if rows else [[]] * len(arrow)
                yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], schema=arrow)

        one = source.mapInArrow(match, schema)
        found = one if found is None else found.unionByName(one)
    # equal benchmark rows are a match each; long sequences are dealt in parts
    found = found.withColumn("part", F.explode(F.expr(f"sequence(0L, rows - 1, {COPIES}L)")))
    found = found.withColumn("part", F.explode(F.expr(f"sequence(part, least(part + {COPIES}, rows) - 1)")))
    return found.drop("rows", "part")


def drop_contaminated(docs: DataFrame, bench: DataFrame, text_col: str = "text", item_col: str = "item_id",
                      item_text_col: str = "text", rate: float = RATE, min_chars: int = MIN_CHARS, short_items: bool = False) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with their columns.
    Documents are filtered where they are; nothing is shuffled."""
    spark = docs.sparkSession
    prepare(spark)
    at = docs.columns.index(text_col)
    clean = docs
    for items in _blocks(bench, item_col, item_text_col):
        matcher = _matcher(spark.sparkContext.broadcast(items), rate, min_chars, short_items)

        def keep(batches, matcher=matcher):
            for batch in batches:
                yield batch.filter(pa.array([not matcher().find(t.as_py()) for t in batch.column(at)], pa.bool_()))

        clean = clean.mapInArrow(keep, docs.schema)
    return clean
