"""Nearest neighbours in linear work: refinement of a neighbour graph (OP-J5).

NN-descent (Dong, Charikar, Li, 2011): a neighbour of a neighbour is likely a
neighbour.  The graph starts from blocks of rows in the cells of a few sets of
pivots, and every round joins, around each point, the points that
its edges lead to: their distances are offered to both ends, each point keeps
its nearest ``graph_k``, and the rounds end when few edges change.

Points are dealt to chunks of bounded size that lie together (cells of pivots).
A chunk's vectors and its edges are one row each, and so is what it sends to
another chunk.  One round, as grouped Spark jobs over chunks:

* a point's circle is its nearest ``graph_k`` and the ``graph_k`` nearest points
  that hold it (each chunk sends at most ``graph_k`` of those);
* a chunk asks for the members of its circles with an edge of the last round, and
  gets each one's vector once, not once a circle: what moves is chunks x the
  points that a chunk meets, and at most what circles hold;
* a NumPy kernel compares the pairs of a circle of which one edge is new, and
  offers a pair to an end whose farthest edge it beats and that does not have it;
  a chunk sends each point its nearest ``graph_k`` offers;
* old edges and offers are reduced to the nearest ``graph_k`` of each point.

A round compares at most rows x (2 x graph_k)^2 / 2 pairs, whatever the data
look like; there is no cap on anything that grows with them.  The result is
approximate (the tests measure recall against the exact method); distances are
exact and ties go by id.

Equal vectors are one point of the graph.  A copy's neighbours are the other
copies with the smallest ids, then the copies of the graph's neighbours, so a
vector that a third of the rows share costs no comparison at all.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import order_key
from ..session import cut_lineage
from .knn import MAX_PIVOTS, _chain, _packed, _step_topk
from .ordering import global_index

#: Edges that a point keeps at least; more find more of the true neighbours.
GRAPH_K = 32
#: The first graph: times that the rows are dealt to cells, pivots of those at
#: most, rows of a task, and of a block; a row is compared with three blocks.
START_TABLES = 6
START_PIVOTS = 512
START_ROWS = 8192
START_BLOCK = 1024
#: Rounds at most, and the share of edges whose change starts another round.
MAX_ROUNDS = 15
MIN_CHANGE = 0.001
#: Points of a chunk at most, and about the numbers of their vectors.
CHUNK_ROWS = 16384
CHUNK_VALUES = 1 << 20
#: Numbers that one NumPy step holds, and pairs whose vectors it holds.
STEP_VALUES = 1 << 22
EXACT = 1 << 15


@dataclass
class Report:
    """What a run did: points of the graph, and for the start and each round the
    pairs compared and the edges that changed; for each round also the vectors
    that chunks sent to chunks."""

    points: int = 0
    compared: list[int] = field(default_factory=list)
    changed: list[int] = field(default_factory=list)
    moved: list[int] = field(default_factory=list)

    @property
    def rounds(self) -> int:
        return len(self.changed)


def _chunked(points: DataFrame, chunk_rows: int, seed: int):
    """Points as rows (idx, x, chunk), written: idx numbers them by id, a chunk
    holds about ``chunk_rows`` points that lie together (cells of pivots).  Also
    (idx, pid)."""
    spark = points.sparkSession
    ids = cut_lineage(global_index(points.select("pid"), ["pid"]), spark)
    n = ids.count()
    # half the bytes where nothing is lost
    as_float = F.col("x").cast("array<float>")
    kind = "float" if points.where(as_float.cast("array<double>") != F.col("x")).isEmpty() else "double"
    pivots = _pivots(points, "pid", max(1, min(MAX_PIVOTS, math.ceil(4 * n / chunk_rows))), "chunk", seed)
    shared = spark.sparkContext.broadcast(pivots)

    def assign(batches):
        for batch in batches:
            if batch.num_rows:
                cell = _cells(batch.column("x"), shared.value)
                yield pa.RecordBatch.from_arrays([batch.column("idx"), batch.column("x"), pa.array(cell, pa.int64())], names=["idx", "x", "cell"])

    held = points.join(ids, "pid").select("idx", F.col("x").cast(f"array<{kind}>").alias("x"))
    celled = cut_lineage(held.mapInArrow(assign, f"idx bigint, x array<{kind}>, cell bigint"), spark)
    counts = np.zeros(len(pivots))
    for r in celled.groupBy("cell").count().collect():
        counts[r["cell"]] = r["count"]
    place = _packed(counts, _chain(pivots), chunk_rows)[0] if n else {}
    plan = spark.createDataFrame([(c, *at) for c, at in place.items()], "cell bigint, g0 int, parts int")
    part = F.pmod(F.xxhash64(F.col("idx"), F.lit(11)), F.col("parts")).cast("int")
    return celled.join(F.broadcast(plan), "cell").select("idx", "x", (F.col("g0") + part).alias("chunk")), ids, kind


def _pivots(points: DataFrame, id_col: str, wanted: int, name: str, seed: int) -> np.ndarray:
    """The vectors of the rows with the smallest hash."""
    drawn = points.withColumn("_h", order_key(name, seed, F.col(id_col))).orderBy("_h", id_col).limit(wanted).collect()
    return np.asarray([r["x"] for r in drawn], np.float64).reshape(len(drawn), len(drawn[0]["x"]) if drawn else 1)


def _cells(x, pivots: np.ndarray) -> np.ndarray:
    """The nearest pivot of each vector."""
    return ((pivots * pivots).sum(1)[None, :] - 2.0 * (_matrix(x).astype(np.float64) @ pivots.T)).argmin(1)


def _matrix(lists) -> np.ndarray:
    """Arrow lists of one length as rows."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


# ------------------------------------------------------- messages of chunks
#: A point's code: its chunk, and its number in the order of ids.
IDX_BITS = 40
MASK = (1 << IDX_BITS) - 1
#: What a chunk holds or sends to another one, as one row: its vectors, edges
#: (p, q, dist, fresh), edges for the points that they lead to, circles (of p,
#: with members q), requests (of p's vectors, for chunk ``of``), replies (vectors
#: of p, how far they reach, and the numbers of the ``size`` points that each
#: ``knows``) and offers (p, q, dist).
VECTORS, GRAPH, HELD, CIRCLES, REQUEST, REPLY, OFFERS = range(7)
_FIELDS = [("kind", pa.int32()), ("chunk", pa.int32()), ("of", pa.int32()), ("p", pa.list_(pa.int64())), ("q", pa.list_(pa.int64())),
           ("dist", pa.list_(pa.float64())), ("fresh", pa.list_(pa.bool_())), ("size", pa.list_(pa.int32())), ("n", pa.int64()), ("f", pa.int64())]


def _message_types(kind: str, points: int):
    """Arrow and Spark schema of messages of so many points whose vectors hold ``kind``."""
    fields = _FIELDS + [("x", pa.list_(pa.float32() if kind == "float" else pa.float64())),
                        ("knows", pa.list_(pa.int32() if points < 1 << 31 else pa.int64()))]
    names = {pa.int32(): "int", pa.int64(): "bigint", pa.list_(pa.int64()): "array<bigint>", pa.list_(pa.float64()): "array<double>",
             pa.list_(pa.bool_()): "array<boolean>", pa.list_(pa.int32()): "array<int>", pa.list_(pa.float32()): "array<float>"}
    return pa.schema(fields), ", ".join(f"{c} {names[t]}" for c, t in fields)


def _table(rows: list[dict], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_arrays([pa.array([r.get(f.name) for r in rows], f.type) for f in schema], schema=schema)


def _flat(table: pa.Table, kind: int, *columns: str) -> list[np.ndarray]:
    """The lists of the messages of one kind, each column put together."""
    some = table.filter(pa.compute.equal(table.column("kind"), kind))
    return [some.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False) for c in columns]


def _by_chunk(code: np.ndarray):
    """(chunk, places) of codes, ascending."""
    chunk = code >> IDX_BITS
    order = np.argsort(chunk, kind="stable")
    cuts = np.flatnonzero(np.diff(chunk[order], prepend=-1))
    for lo, hi in zip(cuts, np.append(cuts[1:], len(order))):
        yield int(chunk[order[lo]]), order[lo:hi]


def _nearest(p, q, dist, k: int) -> np.ndarray:
    """Places of the nearest ``k`` of each p, ties by id; by p, nearest first."""
    order = np.lexsort((q & MASK, dist, p))
    first = np.flatnonzero(np.diff(p[order], prepend=-1))
    rank = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
    return order[rank < k]


def _merged(k: int, schema: pa.Schema):
    """Edges and offers of a chunk's points to their nearest ``k``, and to those
    that each is held by (nearest ``k`` of this chunk)."""

    def run(table: pa.Table) -> pa.Table:
        chunk = table.column("chunk")[0].as_py()
        (gp, gq, gd), (op, oq, od) = (_flat(table, kind, "p", "q", "dist") for kind in (GRAPH, OFFERS))
        p, q, dist = np.concatenate([gp, op]), np.concatenate([gq, oq]), np.concatenate([gd, od])
        fresh = np.arange(len(p)) >= len(gp)
        # a pair once, an old edge before an offer
        order = np.lexsort((fresh, q, p))
        order = order[(np.diff(p[order], prepend=-1) != 0) | (np.diff(q[order], prepend=-1) != 0)]
        keep = order[_nearest(p[order], q[order], dist[order], k)]
        p, q, dist, fresh = p[keep], q[keep], dist[keep], fresh[keep]
        out = [{"kind": GRAPH, "chunk": chunk, "p": p, "q": q, "dist": dist, "fresh": fresh, "n": len(p), "f": int(fresh.sum())}]
        back = _nearest(q, p, dist, k)
        for to, at in _by_chunk(q[back]):
            at = back[at]
            out.append({"kind": HELD, "chunk": to, "p": q[at], "q": p[at], "dist": dist[at], "fresh": fresh[at]})
        return _table(out, schema)

    return run


def _circles(k: int, schema: pa.Schema):
    """The open circles of a chunk's points, and requests of their members."""

    def run(table: pa.Table) -> pa.Table:
        chunk = table.column("chunk")[0].as_py()
        (gp, gq, gf), (hp, hq, hd, hf) = _flat(table, GRAPH, "p", "q", "fresh"), _flat(table, HELD, "p", "q", "dist", "fresh")
        keep = _nearest(hp, hq, hd, k)
        p, q, fresh = np.concatenate([gp, hp[keep]]), np.concatenate([gq, hq[keep]]), np.concatenate([gf, hf[keep]]).astype(bool)
        order = np.lexsort((~fresh, q, p))
        p, q, fresh = p[order], q[order], fresh[order]
        once = (np.diff(p, prepend=-1) != 0) | (np.diff(q, prepend=-1) != 0)
        p, q, fresh = p[once], q[once], fresh[once]
        first = np.flatnonzero(np.diff(p, prepend=-1))
        m = np.diff(np.append(first, len(p)))
        f = np.add.reduceat(fresh, first, dtype=np.int64) if len(first) else m
        is_open = np.repeat(f > 0, m)
        p, q, fresh = p[is_open], q[is_open], fresh[is_open]
        if not len(p):
            return schema.empty_table()
        pairs = int((f * (f - 1) // 2 + f * (m - f)).sum())
        out = [{"kind": CIRCLES, "chunk": chunk, "p": p, "q": q, "fresh": fresh, "n": pairs}]
        members = np.unique(q)
        out += [{"kind": REQUEST, "chunk": to, "of": chunk, "p": members[at]} for to, at in _by_chunk(members)]
        return _table(out, schema)

    return run


def _replies(k: int, schema: pa.Schema):
    """A chunk's vectors, each once to a chunk that asks for it, with the
    distance of its farthest edge and the points that it has edges to."""

    def run(table: pa.Table) -> pa.Table:
        codes, x = _flat(table, VECTORS, "p", "x")
        x = x.reshape(len(codes), -1)
        p, q, dist = _flat(table, GRAPH, "p", "q", "dist")
        begin, end = np.searchsorted(p, codes), np.searchsorted(p, codes, "right")
        size = end - begin
        # a point with fewer edges than it may have takes any
        far = np.where(size >= k, np.append(dist, 0.0)[np.maximum(end, 1) - 1], np.inf)
        out = []
        asked = table.filter(pa.compute.equal(table.column("kind"), REQUEST)).select(["of", "p"]).combine_chunks()
        for of, wanted in zip(asked.column("of").to_pylist(), asked.column("p")):
            at = np.searchsorted(codes, wanted.values.to_numpy())
            which = np.repeat(begin[at] - np.cumsum(size[at]) + size[at], size[at]) + np.arange(size[at].sum())
            out.append({"kind": REPLY, "chunk": of, "p": codes[at], "x": x[at].ravel(), "dist": far[at], "size": size[at], "knows": q[which] & MASK})
        return _table(out, schema)

    return run


def _joined(k: int, schema: pa.Schema):
    """Compares the pairs of a chunk's circles of which one edge is new, and
    offers a pair to an end whose farthest edge it beats and that does not hold
    it: to each point the nearest ``k`` that this chunk found."""

    def run(table: pa.Table) -> pa.Table:
        center, member, fresh = _flat(table, CIRCLES, "p", "q", "fresh")
        codes, far, size, x = _flat(table, REPLY, "p", "dist", "size", "x")
        if not len(center):
            return schema.empty_table()
        n, far = len(codes), far.copy()
        x = x.reshape(n, -1)
        # pairs are told by the places of their points; only those matter that may meet here
        number = codes & MASK
        order = np.argsort(number)
        knows, = _flat(table, REPLY, "knows")
        there = order[np.minimum(np.searchsorted(number, knows, sorter=order), n - 1)]
        here = number[there] == knows
        known = np.sort(np.repeat(np.arange(n), size)[here] * n + there[here])
        del knows, there, here
        at = order[np.searchsorted(number, member & MASK, sorter=order)]
        first = np.append(np.flatnonzero(np.diff(center, prepend=-1)), len(center))
        key, dist = np.zeros(0, np.int64), np.zeros(0)
        step = max(1, STEP_VALUES // (4 * k * x.shape[1] or 1))
        for lo in range(0, len(first) - 1, step):
            hi = min(lo + step, len(first) - 1)
            begin, m = first[lo:hi], np.diff(first[lo:hi + 1])
            # places of each circle's members, padded
            place = np.arange(m.max())
            real = place < m[:, None]
            grid = np.where(real, begin[:, None] + place, begin[:, None])
            new, grid = fresh[grid] & real, at[grid]
            v = x[grid].astype(np.float64)
            near = (v * v).sum(2)
            d2 = near[:, :, None] + near[:, None, :] - 2.0 * (v @ v.transpose(0, 2, 1))
            asked = (new[:, :, None] | new[:, None, :]) & real[:, :, None] & real[:, None, :] & (place[:, None] < place)
            # the expanded form rounds; what it may be off by is allowed for
            slack = 4e-9 * (1.0 + near[:, :, None] + near[:, None, :])
            reach = far[grid] ** 2
            asked &= d2 <= np.maximum(reach[:, :, None], reach[:, None, :]) + slack
            c, i, j = np.nonzero(asked)
            a, b = grid[c, i], grid[c, j]
            pair = np.unique(np.minimum(a, b) * n + np.maximum(a, b))
            a, b = pair // n, pair % n
            d = np.concatenate([np.sqrt(((x[a[s:s + EXACT]].astype(np.float64) - x[b[s:s + EXACT]]) ** 2).sum(1)) for s in range(0, len(a), EXACT)] or [np.zeros(0)])
            found, d = np.concatenate([pair, b * n + a]), np.concatenate([d, d])
            better = d <= far[found // n]
            found, d = found[better], d[better]
            if len(known):
                new = known[np.minimum(np.searchsorted(known, found), len(known) - 1)] != found
                found, d = found[new], d[new]
            if not len(found):
                continue
            key, once = np.unique(np.concatenate([key, found]), return_index=True)
            dist = np.concatenate([dist, d])[once]
            keep = _nearest(codes[key // n], codes[key % n], dist, k)
            key, dist = key[keep], dist[keep]
            # k offers of a point: what is farther than they cannot stay
            p, begin, m = np.unique(key // n, return_index=True, return_counts=True)
            far[p] = np.where(m == k, np.minimum(far[p], dist[begin + m - 1]), far[p])
        p, q = codes[key // n], codes[key % n]
        return _table([{"kind": OFFERS, "chunk": to, "p": p[s], "q": q[s], "dist": dist[s]} for to, s in _by_chunk(p)], schema)

    return run


def _blocks(k: int, block: int, schema: pa.Schema):
    """Each row of a group of cells with the rows of its block and of the two
    beside it, in the order of the cells: the nearest ``k``, as offers."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("at", "ascending"), ("code", "ascending")])
        code, x = table.column("code").to_numpy(), _matrix(table.column("x")).astype(np.float64)
        number, norm = code & MASK, (x * x).sum(1)
        parts = []
        for lo in range(0, len(x), block):
            mine, others = slice(lo, lo + block), slice(max(0, lo - block), lo + 2 * block)
            own = np.arange(lo, min(lo + block, len(x))) - others.start
            r, c, dist = _step_topk(x[mine], x[others], norm[others], number[others], own, k)
            parts.append((code[mine][r], code[others][c], dist))
        p, q, dist = map(np.concatenate, zip(*parts))
        return _table([{"kind": OFFERS, "chunk": to, "p": p[s], "q": q[s], "dist": dist[s]} for to, s in _by_chunk(p)], schema)

    return run


def _start(coded: DataFrame, k: int, seed: int, messages) -> DataFrame:
    """Offers of the first graph: ``START_TABLES`` times the rows (code, x) are
    dealt to cells of other pivots, and compared inside groups of cells."""
    spark = coded.sparkSession
    schema, spark_schema = messages
    kind = coded.schema["x"].dataType.simpleString()
    wanted = max(1, min(START_PIVOTS, math.ceil(4 * coded.count() / START_ROWS)))
    pivots = [_pivots(coded, "code", wanted, f"start-{t}", seed) for t in range(START_TABLES)]
    shared = spark.sparkContext.broadcast(pivots)

    def count(batches):
        for batch in batches:
            if batch.num_rows:
                found = [np.unique(_cells(batch.column("x"), p), return_counts=True) for p in shared.value]
                t = np.repeat(np.arange(len(found)), [len(c) for c, _ in found])
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in (t, *map(np.concatenate, zip(*found)))], names=["t", "cell", "n"])

    counts = np.zeros((START_TABLES, wanted))
    for r in coded.select("x").mapInArrow(count, "t bigint, cell bigint, n bigint").groupBy("t", "cell").agg(F.sum("n").alias("n")).collect():
        counts[r["t"], r["cell"]] = r["n"]
    # a cell's place in the order of cells, its first group and number of groups
    plan = []
    for t, p in enumerate(pivots):
        order = _chain(p) if len(p) else []
        place = _packed(counts[t], order, START_ROWS)[0]
        at = np.array([place.get(c, (0, 1)) for c in range(len(p))]).reshape(-1, 2)
        plan.append((np.argsort(order), at[:, 0], at[:, 1]))
    plan = spark.sparkContext.broadcast(plan)

    def deal(batches):
        for batch in batches:
            for t, (p, (place, group, parts)) in enumerate(zip(shared.value, plan.value)):
                if batch.num_rows:
                    cell, number = _cells(batch.column("x"), p), batch.column("code").to_numpy() & MASK
                    out = [np.full(len(cell), t), group[cell] + number % parts[cell], place[cell]]
                    yield pa.RecordBatch.from_arrays([*(pa.array(v, pa.int64()) for v in out), batch.column("code"), batch.column("x")],
                                                     names=["t", "group", "at", "code", "x"])

    rows = coded.select("code", "x").mapInArrow(deal, f"t bigint, group bigint, at bigint, code bigint, x {kind}")
    return rows.groupBy("t", "group").applyInArrow(_blocks(k, START_BLOCK, schema), spark_schema)


def _refine(points: DataFrame, k: int, graph_k: int, seed: int, max_rounds: int, min_change: float, report: Report,
            chunk_rows: int | None = None) -> DataFrame:
    """(pid, qid, dist): each point's nearest ``k`` of the ``graph_k`` edges that
    the rounds find.  ``points`` (pid, x) have distinct vectors and are already
    written."""
    spark = points.sparkSession
    width = max(1, points.agg(F.max(F.size("x"))).first()[0] or 0)
    chunk_rows = chunk_rows or max(256, min(CHUNK_ROWS, CHUNK_VALUES // width))
    homes, ids, kind = _chunked(points, chunk_rows, seed)
    report.points = ids.count()
    messages = schema, spark_schema = _message_types(kind, report.points)
    coded = cut_lineage(homes.select(F.shiftleft(F.col("chunk").cast("bigint"), IDX_BITS).bitwiseOR(F.col("idx")).alias("code"), "x", "chunk"), spark)

    def each(rows: DataFrame, fn) -> DataFrame:
        return rows.groupBy("chunk").applyInArrow(fn, spark_schema)

    def packed(table: pa.Table) -> pa.Table:
        table = table.sort_by("code")
        x = table.column("x").combine_chunks().flatten()
        return _table([{"kind": VECTORS, "chunk": table.column("chunk")[0].as_py(), "p": table.column("code").to_numpy(), "x": x.to_numpy()}], schema)

    vectors = cut_lineage(each(coded, packed), spark)
    offers = _start(coded, graph_k, seed, messages)
    # at most
    report.compared.append(3 * START_TABLES * START_BLOCK * report.points)
    state = cut_lineage(each(offers, _merged(graph_k, schema)), spark)
    edges = state.agg(F.sum("n")).first()[0] or 0
    while report.rounds < max_rounds:
        circles = cut_lineage(each(state, _circles(graph_k, schema)), spark)
        sent = F.when(F.col("kind") == REQUEST, F.size("p"))
        pairs, moved = (v or 0 for v in circles.agg(F.sum("n"), F.sum(sent)).first())
        if not pairs:
            break
        graph, asked = state.where(F.col("kind") == GRAPH), circles.where(F.col("kind") == REQUEST)
        # only chunks whose vectors are asked for need be there
        replies = each(vectors.unionByName(graph).unionByName(asked), _replies(graph_k, schema))
        offers = each(circles.where(F.col("kind") == CIRCLES).unionByName(replies), _joined(graph_k, schema))
        state = cut_lineage(each(graph.unionByName(offers), _merged(graph_k, schema)), spark)
        tally = state.agg(F.sum("n").alias("n"), F.sum("f").alias("f")).first()
        report.compared.append(pairs)
        report.moved.append(moved)
        report.changed.append(tally["f"])
        if tally["f"] <= min_change * max(edges, tally["n"]):
            break
        edges = tally["n"]

    def best(batches):
        for batch in batches:
            p, q, dist = (c.to_numpy() for c in (batch.column(c).flatten() for c in ("p", "q", "dist")))
            keep = _nearest(p, q, dist, k)
            yield pa.RecordBatch.from_arrays([pa.array(p[keep] & MASK), pa.array(q[keep] & MASK), pa.array(dist[keep])], names=["p", "q", "dist"])

    found = state.where(F.col("kind") == GRAPH).select("p", "q", "dist").mapInArrow(best, "p bigint, q bigint, dist double")
    left, right = (ids.select(F.col("idx").alias(a), F.col("pid").alias(b)) for a, b in (("p", "pid"), ("q", "qid")))
    return found.join(left, "p").join(right, "q").select("pid", "qid", "dist")


def descent_pairs(pts: DataFrame, k: int, graph_k: int = GRAPH_K, seed: int = 42, max_rounds: int = MAX_ROUNDS,
                  min_change: float = MIN_CHANGE, report: Report | None = None, chunk_rows: int | None = None) -> DataFrame:
    """(pid, qid, dist) with at least the nearest ``k`` of each row of ``pts``
    (pid unique, x array<double>) that the graph finds."""
    spark = pts.sparkSession
    report = report if report is not None else Report()
    kind = pts.schema["pid"].dataType.simpleString()
    pts = cut_lineage(pts, spark)
    # the k + 1 smallest ids of each distinct vector; the smallest stands for it
    w = Window.partitionBy("x").orderBy("pid")
    first = pts.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k + 1)
    first = cut_lineage(first.withColumn("of", F.first("pid").over(w)), spark)
    points = first.where("_r = 1").select("pid", "x")
    # k edges of a point are k other vectors, each with at least one row
    near = _refine(points, k, max(k, graph_k), seed, max_rounds, min_change, report, chunk_rows)
    near = near.select(F.col("pid").alias("of"), F.col("qid").alias("to"), "dist")
    copies = cut_lineage(first.select("of", F.col("pid").alias("qid")), spark)
    others = near.join(copies.withColumnRenamed("of", "to"), "to").select("of", "qid", "dist")
    own = copies.select("of", "qid", F.lit(0.0).alias("dist"))
    # at most (k + 1)^2 rows a point, and k + 1 are enough for any of its copies
    w = Window.partitionBy("of").orderBy("dist", "qid")
    kept = own.unionByName(others).withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k + 1).drop("_r")
    # rows find their vector's point by the vector; a hot one is split by Spark
    home = pts.join(points.select(F.col("pid").alias("of"), "x"), "x").select("pid", "of")
    found = home.join(kept, "of").where(F.col("pid") != F.col("qid"))
    return found.select("pid", "qid", "dist").selectExpr(f"CAST(pid AS {kind}) AS pid", f"CAST(qid AS {kind}) AS qid", "dist")
