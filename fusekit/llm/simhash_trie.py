"""SimHash near-duplicates by a self-join over binary tries.

Fingerprints are the bitwise majority of the XXH64 hashes of word shingles.
Two distinct fingerprints are linked if they differ in at most ``budget``
bits; a group is a connected component, named by its smallest doc_id.

The join walks pairs of trie nodes together, adds up the bits in which their
paths differ and leaves a pair as soon as the sum exceeds the budget.  It is
dealt out as follows: of ``budget + 1`` blocks of bits at least one is equal
in two linked fingerprints, so the fingerprints are put into one trie for each
block, rotated to start with it, and only pairs inside a node below that first
block need to be walked.  A node of more than ``NODE_ROWS`` fingerprints is
expanded further on Spark (pairs of children within the budget) until each
pair of nodes is small enough for one task.

Exact copies share a fingerprint and are one entry, and a task returns a
spanning forest of the links it finds, so a group of n texts costs at most
O(n) rows however many of its pairs are linked.

Defined cases: a text without words (null, empty, white space) has the
fingerprint zero and is linked like any other; a null doc_id is never a
component's name unless all its members have none; repeated rows keep a row
each; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, python_bytes, slices, written
from .components import connected_components

SEED = 42
#: Fingerprints below a trie node that one task walks.
NODE_ROWS = 1 << 15
#: Bits by which a larger node is expanded at a time.
STEP = 8
#: Node pairs that a task holds at a time.
PAIRS = 1 << 19
#: Hashes whose bits are counted at a time.
_COUNTED = 1 << 16


def text_hashes(text: bytes, words: int = 3) -> list[int]:
    """XXH64 of every shingle of ``words`` words, repeats included."""
    w = text.lower().split()
    if not w:
        return []
    joined = b" ".join(w)
    if len(w) <= words:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED) for a, b in zip(starts, ends[words - 1:].tolist())]


def fingerprints(texts: list[bytes], words: int = 3) -> np.ndarray:
    """The fingerprint of each text as uint64."""
    out = np.zeros(len(texts), np.uint64)
    for i, text in enumerate(texts):
        h = np.array(text_hashes(text, words), ">u8")
        if not len(h):
            continue
        ones = np.zeros(64, np.int64)
        for at in range(0, len(h), _COUNTED):
            bits = np.unpackbits(h[at:at + _COUNTED].view(np.uint8).reshape(-1, 8), axis=1)
            ones += bits.sum(axis=0, dtype=np.int64 if len(bits) > 65535 else np.uint16)
        out[i] = np.packbits(2 * ones > len(h)).view(">u8")[0]
    return out


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """One row per document: id (long) and fp, the fingerprint as a signed long."""
    return _signed(docs, id_col, text_col, words).select("id", "fp")


def _signed(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """id, fp and content (a hash of the text, null for a null one)."""
    schema = pa.schema([("id", pa.int64()), ("fp", pa.int64()), ("content", pa.int64())])

    def sign(batches):
        for batch in batches:
            for part in slices(batch, "text", 8 << 20):
                fp = fingerprints(python_bytes(part.column("text")), words)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(fp.view(np.int64)), part.column("content")], schema=schema)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"), content_hash(text_col).alias("content"))
    return rows.select("id", "content", "text").mapInArrow(sign, "id long, fp long, content long")


def content_hash(text_col: str):
    text = F.col(text_col).cast("string")
    return F.when(text.isNotNull(), F.xxhash64(text))


def blocks(budget: int) -> list[tuple[int, int]]:
    """(first bit, width) of ``budget + 1`` blocks that cover 64 bits."""
    ends = [64 * i // (budget + 1) for i in range(budget + 2)]
    return [(a, b - a) for a, b in zip(ends, ends[1:])]


class _Forest:
    """Component labels over 0..n-1 with links added in bulk."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self._changes()

    def _changes(self) -> None:
        self.steps = np.concatenate([[0], np.cumsum(self.label[1:] != self.label[:-1])]) if len(self.label) else np.zeros(0, int)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.label[a], self.label[b]
            apart = x != y
            if not apart.any():
                break
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            to = np.arange(len(self.label))
            np.minimum.at(to, np.maximum(x, y), np.minimum(x, y))
            while (to[to] != to).any():
                to = to[to]
            self.label = to[self.label]
        self._changes()

    def joined(self, alo, ahi, blo, bhi) -> np.ndarray:
        """Whether all leaves of both nodes are in one component already."""
        one = (self.steps[ahi - 1] == self.steps[alo]) & (self.steps[bhi - 1] == self.steps[blo])
        return one & (self.label[alo] == self.label[blo])


def link(fps: np.ndarray, pairs: list[tuple[int, int, int, int, int]], depth: int, budget: int) -> np.ndarray:
    """Component labels (index of a representative) of ``fps`` under the links
    inside the given pairs of trie nodes.

    ``fps``: uint64; each node is a range in which they are sorted and share
    their first ``depth`` bits.  pairs: (lo, hi, lo, hi, bits differing so
    far); a node is paired with itself by naming its range twice."""
    forest = _Forest(len(fps))
    stack = [(depth, np.array(pairs, np.int64).reshape(-1, 5).T)]
    while stack:
        d, p = stack.pop()
        if p.shape[1] > PAIRS:
            stack.append((d, p[:, PAIRS:]))
            p = p[:, :PAIRS]
        alo, ahi, blo, bhi, diff = p
        single = (ahi - alo == 1) & (bhi - blo == 1)
        if single.any():
            a, b = alo[single], blo[single]
            near = np.bitwise_count(fps[a] ^ fps[b]) <= budget
            forest.add(a[near], b[near])
        open_ = ~single
        # all leaves of both nodes are within the budget: one component
        if (sure := open_ & (diff + 64 - d <= budget)).any():
            for x0, x1, y0, y1 in p[:4, sure].T:
                members = np.concatenate([np.arange(x0, x1), np.arange(y0, y1)])
                forest.add(np.full(len(members), members[0]), members)
            open_ &= ~sure
        open_[open_] = ~forest.joined(alo[open_], ahi[open_], blo[open_], bhi[open_])
        if d == 64 or not open_.any():
            continue
        alo, ahi, blo, bhi, diff = p[:, open_]
        ones = np.concatenate([[0], np.cumsum((fps >> np.uint64(63 - d)) & np.uint64(1), dtype=np.int64)])
        amid, bmid = ahi - (ones[ahi] - ones[alo]), bhi - (ones[bhi] - ones[blo])
        same = alo == blo
        children = [np.stack([alo, amid, blo, bmid, diff]), np.stack([amid, ahi, bmid, bhi, diff])]
        across = np.stack([alo, amid, bmid, bhi, diff + 1])
        back = np.stack([amid, ahi, blo, bmid, diff + 1])[:, ~same]
        out = np.concatenate([across, back, *children], axis=1)
        full = (out[0] < out[1]) & (out[2] < out[3]) & (out[4] <= budget)
        full &= ~((out[0] == out[2]) & (out[1] - out[0] == 1))
        if full.any():
            out = out[:, full]
            # nearer pairs are walked first: they join what farther ones need not visit
            far = out[4] > out[4].min()
            if far.any():
                stack.append((d + 1, out[:, far]))
            stack.append((d + 1, out[:, ~far]))
    return forest.label


def _stars(fps: np.ndarray, label: np.ndarray, schema: pa.Schema) -> pa.RecordBatch:
    linked = label != np.arange(len(fps))
    return pa.RecordBatch.from_arrays([pa.array(fps[linked].view(np.int64)), pa.array(fps[label[linked]].view(np.int64))], schema=schema)


def _walk_tasks(budget: int):
    """Rows (task, side, depth, diff, rot, fp) come sorted by task, side and
    rotated fingerprint (unsigned order); whole tasks are walked at a time."""
    schema = pa.schema([("src", pa.int64()), ("dst", pa.int64())])

    def walk(batches):
        held = None
        for batch in _with_end(batches):
            if batch is not None:
                new = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("task", "side", "depth", "diff", "rot", "fp")}
                held = new if held is None else {c: np.concatenate([held[c], new[c]]) for c in new}
                if len(held["task"]) < NODE_ROWS or held["task"][0] == held["task"][-1]:
                    continue
                cut = np.flatnonzero(held["task"] != held["task"][-1])[-1] + 1
            else:
                cut = 0 if held is None else len(held["task"])
            if not cut:
                continue
            ready, held = {c: v[:cut] for c, v in held.items()}, {c: v[cut:] for c, v in held.items()}
            yield from tasks(ready)

    def tasks(r):
        for depth in np.unique(r["depth"]):
            at = r["depth"] == depth
            task, side = r["task"][at], r["side"][at]
            rot, fp, diff = r["rot"][at].view(np.uint64), r["fp"][at].view(np.uint64), r["diff"][at]
            lo = np.flatnonzero(np.diff(task, prepend=task[0] - 1))
            hi = np.append(lo[1:], len(task))
            mid = lo + np.add.reduceat(side == 0, lo)
            own = mid == hi
            pairs = [(a, b, a, b, 0) for a, b in zip(lo[own], hi[own]) if b - a > 1]
            pairs += [(a, m, m, b, d) for a, m, b, d in zip(lo[~own], mid[~own], hi[~own], diff[lo[~own]]) if a < m]
            if pairs:
                yield _stars(fp, link(rot, pairs, int(depth), budget), schema)

    return walk


def _with_end(batches):
    yield from batches
    yield None


def _prefix(depth: int):
    return F.shiftrightunsigned("rot", 64 - depth) if depth < 64 else F.col("rot")


def _near_masks(bits: int, most: int) -> list[tuple[int, int]]:
    return [(m, m.bit_count()) for m in range(1 << bits) if m.bit_count() <= most]


def trie_links(fps: DataFrame, budget: int = 3, node_rows: int | None = None) -> DataFrame:
    """Links (src, dst) whose connected components are those of all pairs of
    distinct values of ``fps.fp`` that differ in at most ``budget`` bits."""
    node_rows = node_rows or NODE_ROWS
    tries = None
    for k, (first, width) in enumerate(blocks(budget)):
        rot = F.col("fp") if not first else F.shiftleft("fp", first).bitwiseOR(F.shiftrightunsigned("fp", 64 - first))
        one = fps.select("fp", F.lit(k).alias("trie"), rot.alias("rot")).withColumn("node", F.shiftrightunsigned("rot", 64 - width))
        tries = one if tries is None else tries.unionByName(one)
    widths = F.element_at(F.array(*[F.lit(w) for _, w in blocks(budget)]), F.col("trie") + 1)
    nodes = tries.groupBy("trie", "node").agg(F.count("*").alias("n")).filter("n > 1")
    large = written(nodes.filter(F.col("n") > node_rows), "trie-large")
    # the usual case: one task walks a whole node below the first block
    small = tries.join(nodes.filter(F.col("n") <= node_rows), ["trie", "node"])
    rows = [small.select(F.xxhash64("trie", "node").alias("task"), F.lit(0).alias("side"), widths.alias("depth"), F.lit(0).alias("diff"), "rot", "fp")]
    for k, (_, width) in enumerate(blocks(budget)):
        pairs = large.filter(F.col("trie") == k).select(F.col("node").alias("a"), F.col("node").alias("b"), F.lit(0).alias("diff"))
        depth = width
        while not pairs.isEmpty():
            # rows below the nodes that are still too large, and their children
            wide = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
            below = tries.filter(F.col("trie") == k).select("fp", "rot", _prefix(depth).alias("node")).join(wide, "node", "left_semi")
            step = min(STEP, 64 - depth)
            depth += step
            sizes = written(below.groupBy(_prefix(depth).alias("child")).agg(F.count("*").alias("n")), "trie-sizes")
            masks = F.array(*[F.struct(F.lit(m).cast("long").alias("mask"), F.lit(c).alias("bits")) for m, c in _near_masks(step, budget)])
            a = sizes.select(F.col("child").alias("ca"), F.col("n").alias("na"), F.shiftrightunsigned("child", step).alias("a"))
            cand = (pairs.join(a, "a").withColumn("m", F.explode(masks))
                    .filter(F.col("diff") + F.col("m.bits") <= budget)
                    .select("ca", "na", F.shiftleft("b", step).bitwiseOR(F.expr(f"ca & {(1 << step) - 1}L").bitwiseXOR(F.col("m.mask"))).alias("cb"),
                            (F.col("diff") + F.col("m.bits")).alias("diff"), (F.col("a") == F.col("b")).alias("own")))
            cand = cand.join(sizes.select(F.col("child").alias("cb"), F.col("n").alias("nb")), "cb")
            # a node paired with itself makes each pair of children once
            cand = cand.filter("not own or ca <= cb").filter("ca != cb or na > 1")
            cand = written(cand.select("ca", "cb", "diff", F.when(F.col("ca") == F.col("cb"), F.col("na")).otherwise(F.col("na") + F.col("nb")).alias("n")), "trie-pairs")
            fit = cand.filter(F.col("n") <= node_rows) if depth < 64 else cand
            task = F.xxhash64(F.lit(k), F.lit(depth), "ca", "cb")
            leaf = tries.filter(F.col("trie") == k).select("fp", "rot", _prefix(depth).alias("child"))
            for side, end in enumerate(("ca", "cb")):
                part = fit if side == 0 else fit.filter("ca != cb")
                rows.append(part.join(leaf, F.col(end) == F.col("child")).select(task.alias("task"), F.lit(side).alias("side"), F.lit(depth).alias("depth"), "diff", "rot", "fp"))
            if depth == 64:
                break
            pairs = written(cand.filter(F.col("n") > node_rows).select(F.col("ca").alias("a"), F.col("cb").alias("b"), "diff"), "trie-next")
    todo = rows[0]
    for r in rows[1:]:
        todo = todo.unionByName(r)
    unsigned = F.col("rot").bitwiseXOR(F.lit(-(2**63)))
    return (todo.repartition("task").sortWithinPartitions("task", "side", unsigned)
            .select("task", "side", "depth", "diff", "rot", "fp").mapInArrow(_walk_tasks(budget), "src long, dst long"))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
                   budget: int = 3, node_rows: int | None = None) -> DataFrame:
    """One row per document: doc_id, fp (signed long) and component_id (the
    smallest doc_id reachable over links of at most ``budget`` bits)."""
    return _components(docs, id_col, text_col, words, budget, node_rows).select(F.col("id").alias("doc_id"), "fp", "component_id")


def _components(docs: DataFrame, id_col: str, text_col: str, words: int, budget: int, node_rows: int | None) -> DataFrame:
    """id, fp, content, component_id and root (the component's own number)."""
    prepare(docs.sparkSession)
    signed = written(_signed(docs, id_col, text_col, words), "simhash")
    fps = written(signed.groupBy("fp").agg(F.min("id").alias("least")), "simhash-fps")
    links = written(trie_links(fps.select("fp"), budget, node_rows).distinct(), "simhash-links")
    member = connected_components(links)
    roots = fps.join(member.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    roots = written(roots, "simhash-roots")
    named = roots.join(roots.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "component_id", "root")
    return signed.join(named, "fp").select("id", "fp", "content", "component_id", "root")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, budget: int = 3,
               node_rows: int | None = None) -> DataFrame:
    """One row of ``docs`` for each component: the smallest id (null last), of
    rows that share it the text that hashes lowest, of equal rows any one."""
    order = F.struct(F.col("id").isNull().alias("unnamed"), "id", F.col("content").isNull().alias("empty"), "content")
    groups = _components(docs, id_col, text_col, words, budget, node_rows)
    first = written(groups.groupBy("root").agg(F.min(order).alias("f")).select(F.col("f.id").alias("__id"), F.col("f.content").alias("__content")), "first-of-group")
    # the rows travel as one column, so that no name can clash
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col(id_col).cast("long").alias("__key"), content_hash(text_col).alias("__hash"))
    own = F.col("__key").eqNullSafe(F.col("__id")) & F.col("__hash").eqNullSafe(F.col("__content"))
    kept = rows.join(first, own, "left_semi")
    equal = groups.join(first, F.col("id").eqNullSafe(F.col("__id")) & F.col("content").eqNullSafe(F.col("__content")), "left_semi")
    if not equal.groupBy("id", "content").count().filter("count > 1").isEmpty():
        # rows that repeat a kept id and its text
        kept = kept.dropDuplicates(["__key", "__hash"])
    return kept.select("__row.*")


def fingerprint_hex(fp="fp"):
    """16 lower-case hex digits of a fingerprint column."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
