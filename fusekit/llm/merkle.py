"""Merkle manifest of a dataset, by slot pivots.

A row's leaf is the SHA-256 of its columns.  The leaves of a tree (rows that
share ``tree_col``), in order, are numbered; ``FANOUT`` neighbours have one
parent.  A level is one aggregate: conditional maxima spread the children of
each parent into ``FANOUT`` slot columns, and the concatenated columns hashed
are the parent.  The trees' tops, in order of their trees, are the leaves of
one tree more, whose top is the root.

A proof goes down again: a parent's slot columns without one of them are that
child's siblings, so each level unpacks its parents' slots beside the path that
the parent has already, and only parents (an eighth of the level) are joined.

Everything is a DataFrame expression.  Levels are written to the shared folder,
so a lost executor costs no level twice.  A tree of any share of the rows is
spread over all tasks: numbering is by range, and aggregates are by parent.

Defined cases: rows ascend by ``tree_col`` (null first, UTF-8 bytewise), then by
``order_col`` (null first), then by leaf, so that repeated ids have a place and
repeated rows are interchangeable; a tree of one row has its leaf as top, and a
table with one tree that tree's top as root; an empty table gives an empty
result; columns that are not named are not read, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import global_index
from .common import prepare, written

FANOUT = 8


def field(column: str, value: Column | None = None) -> Column:
    """A column's part of the leaf: ``-`` if null, else the UTF-8 byte count,
    a colon and the value."""
    text = (F.col(column) if value is None else value).cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(parts: list[Column]) -> Column:
    """H: lowercase hex SHA-256 of the concatenated parts."""
    return F.sha2(F.concat(*parts), 256)


def _slots(prefix: str) -> list[str]:
    return [f"{prefix}{s}" for s in range(FANOUT)]


def _parents(nodes: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """(tree, place, n, digest, h0.., carried0..) of the parents of ``nodes``
    (tree, place, n, digest, carry...): the slot pivot.  n is the number of
    nodes that the tree has at the level."""
    slot = F.pmod("place", F.lit(FANOUT))
    spread = [F.max(F.when(slot == s, F.col(c))).alias(f"{p}{s}") for p, c in [("h", "digest"), *((c, c) for c in carry)] for s in range(FANOUT)]
    out = nodes.groupBy("tree", "n", F.floor(F.col("place") / FANOUT).cast("long").alias("up")).agg(*spread)
    hashed = F.sha2(F.concat_ws("", *_slots("h")), 256)
    return out.select("tree", F.col("up").alias("place"), F.ceil(F.col("n") / FANOUT).cast("long").alias("n"), hashed.alias("digest"),
                      *(f"{p}{s}" for p in ("h", *carry) for s in range(FANOUT)))


def _children(parents: DataFrame, path: Column, keep: tuple[str, ...], carry: tuple[str, ...] = ()) -> DataFrame:
    """One row for each child of ``parents``: tree, place, digest, path (the
    siblings left and right of it, then the parent's path) and carried columns."""
    hashes = _slots("h")
    child = [F.when(F.col(own).isNotNull(), F.struct(
        (F.col("place") * FANOUT + s).alias("place"), F.col(own).alias("digest"),
        F.concat_ws("", *hashes[:s]).alias("left"), F.concat_ws("", *hashes[s + 1:]).alias("right"),
        *(F.col(f"{c}{s}").alias(c) for c in carry))) for s, own in enumerate(hashes)]
    out = parents.select("tree", *keep, path.alias("__path"), F.explode(F.array_compact(F.array(*child))).alias("__c"))
    step = F.array(F.struct(F.col("__c.left").alias("left"), F.col("__c.right").alias("right")))
    return out.select("tree", *keep, "__c.place", "__c.digest", F.concat(step, "__path").alias("path"), *(F.col(f"__c.{c}").alias(c) for c in carry))


def _no_path() -> Column:
    return F.array().cast("array<struct<left:string,right:string>>")


class _Forest:
    """The levels of many trees, built upwards and kept for the way down."""

    def __init__(self, leaves: DataFrame, carry: tuple[str, ...], name: str):
        """``leaves``: tree, place, n, digest, carry... (tables already written)."""
        self.leaves, self.carry, self.levels = leaves, carry, []
        n = leaves.agg(F.max("n")).first()[0] or 0
        nodes = leaves
        while n > 1:
            level = written(_parents(nodes.filter("n > 1"), carry if not self.levels else ()), f"{name}-level")
            self.levels.append(level)
            nodes, n = level, -(-n // FANOUT)

    def tops(self) -> DataFrame:
        """(tree, digest) of each tree's top."""
        tops = self.leaves.filter("n = 1").select("tree", "digest")
        for level in self.levels:
            tops = tops.unionByName(level.filter("n = 1").select("tree", "digest"))
        return tops

    def paths(self, above: DataFrame, keep: tuple[str, ...]) -> DataFrame:
        """Leaves with their path to the very top: tree, digest, path, keep...,
        carry...; ``above`` has tree, path and ``keep`` for each tree."""
        down = None
        for height in range(len(self.levels) - 1, -1, -1):
            level = self.levels[height]
            begin = level.filter("n = 1").join(above, "tree")
            if down is not None:
                inner = level.join(down.select("tree", "place", "path", *keep), ["tree", "place"])
                begin = begin.unionByName(inner)
            down = _children(begin, F.col("path"), keep, () if height else self.carry)
        single = self.leaves.filter("n = 1").join(above, "tree").select("tree", "digest", "path", *keep, *self.carry)
        return single if down is None else down.select(*single.columns).unionByName(single)


def fold(leaf: Column, path: Column) -> Column:
    """The digest that ``leaf`` gives at the end of ``path``."""
    return F.aggregate(path, leaf, lambda acc, at: F.sha2(F.concat(at["left"], acc, at["right"]), 256))


def manifest(docs: DataFrame, leaf: Column, tree_col: str = "lang", order_col: str = "doc_id", claim: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: the order column, leaf, claim (a leaf to be
    verified: ``leaf`` unless given), subroot, root and path (array of the
    siblings left and right, from the leaf upwards)."""
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col(tree_col).alias("__tree"), F.col(order_col).alias("__order"), leaf.alias("digest"),
                       (leaf if claim is None else claim).alias("claim"))
    # written once numbered: every level reads it
    rows = global_index(rows, ["__tree", "__order", "digest"], out_col="__g")
    trees = rows.groupBy("__tree").agg(F.min("__g").alias("first"), F.count("*").alias("n"))
    # a tree's number is its place among the trees, since rows stand in that order
    trees = written(global_index(trees, ["first"], out_col="tree"), "merkle-trees")
    own = F.struct(F.col("__order").alias("id"), F.col("claim")).alias("own")
    leaves = (rows.join(trees.withColumnRenamed("__tree", "__of"), F.col("__tree").eqNullSafe(F.col("__of")))
              .select("tree", (F.col("__g") - F.col("first")).alias("place"), "n", "digest", own))
    forest = _Forest(written(leaves, "merkle-leaves"), ("own",), "merkle-tree")
    count = trees.count()
    tops = forest.tops().select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("place"), F.lit(count).cast("long").alias("n"), "digest",
                                F.struct(F.col("tree").alias("of")).alias("of"))
    upper = _Forest(written(tops, "merkle-tops"), ("of",), "merkle-root")
    root = upper.tops().select("tree", F.col("digest").alias("root"), _no_path().alias("path"))
    above = upper.paths(root, ("root",)).select(F.col("of.of").alias("tree"), F.col("digest").alias("subroot"), "root", "path")
    out = forest.paths(above, ("subroot", "root"))
    return out.select(F.col("own.id").alias(order_col), F.col("digest").alias("leaf"), F.col("own.claim").alias("claim"), "subroot", "root", "path")


def verified_manifest(docs: DataFrame) -> DataFrame:
    """The manifest of ``documents`` by language, and for each row whether a
    copy passes: in every third row (by CRC-32 of its id) the copy's text has
    its A-Z lower-cased, which the proof must notice."""
    fields = [field(c) for c in ("doc_id", "source", "lang", "n_chars")]
    leaf = digest([*fields, field("text")])
    lower = F.translate(F.col("text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    claim = F.when(tampered, digest([*fields, field("text", lower)])).otherwise(leaf)
    out = manifest(docs, leaf, "lang", "doc_id", claim)
    siblings = F.array_join(F.transform("path", lambda at: F.concat(at["left"], at["right"])), "")
    folded = fold(F.col("claim"), F.col("path"))
    return (out.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), folded.alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


#: CRC-32 of an id's digits, bit by bit (DuckDB has no function for it).
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
  lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
    lambda x, bit: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""

ORACLE = f"""
WITH RECURSIVE base AS (
  SELECT *, coalesce({_CRC} % 3 = 0, false) AS tampered,
    {" || ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}, '-')" for c in ("doc_id", "source", "lang", "n_chars"))} AS head
  FROM documents),
leaves AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN tampered THEN sha256(head || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-'))
         ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS claim
  FROM base),
numbered AS (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY lang) AS n
  FROM leaves),
tree_nodes(tree, level, place, n, digest) AS (
  SELECT tree, 0, place, n, leaf FROM numbered
  UNION ALL
  SELECT tree, level + 1, place // {FANOUT}, (n + {FANOUT - 1}) // {FANOUT}, sha256(string_agg(digest, '' ORDER BY place))
  FROM tree_nodes WHERE n > 1 GROUP BY tree, level, place // {FANOUT}, n),
subroots AS (SELECT tree, digest, count(*) OVER () AS n FROM tree_nodes WHERE n = 1),
root_nodes(level, place, n, digest) AS (
  SELECT 0, tree, n, digest FROM subroots
  UNION ALL
  SELECT level + 1, place // {FANOUT}, (n + {FANOUT - 1}) // {FANOUT}, sha256(string_agg(digest, '' ORDER BY place))
  FROM root_nodes WHERE n > 1 GROUP BY level, place // {FANOUT}, n),
tree_sides AS (
  SELECT a.tree, a.level, a.place, coalesce(string_agg(b.digest, '' ORDER BY b.place) FILTER (b.place < a.place), '') AS before,
    coalesce(string_agg(b.digest, '' ORDER BY b.place) FILTER (b.place > a.place), '') AS after
  FROM tree_nodes a JOIN tree_nodes b ON a.tree = b.tree AND a.level = b.level AND a.place // {FANOUT} = b.place // {FANOUT} AND a.n > 1
  GROUP BY a.tree, a.level, a.place),
root_sides AS (
  SELECT a.level, a.place, coalesce(string_agg(b.digest, '' ORDER BY b.place) FILTER (b.place < a.place), '') AS before,
    coalesce(string_agg(b.digest, '' ORDER BY b.place) FILTER (b.place > a.place), '') AS after
  FROM root_nodes a JOIN root_nodes b ON a.level = b.level AND a.place // {FANOUT} = b.place // {FANOUT} AND a.n > 1
  GROUP BY a.level, a.place),
lower_walk(row, tree, level, place, acc, proof) AS (
  SELECT row_number() OVER (), tree, 0, place, claim, '' FROM numbered
  UNION ALL
  SELECT w.row, w.tree, w.level + 1, w.place // {FANOUT}, sha256(s.before || w.acc || s.after), w.proof || s.before || s.after
  FROM lower_walk w JOIN tree_sides s USING (tree, level, place)),
lower_end AS (SELECT row, tree, acc, proof FROM lower_walk QUALIFY row_number() OVER (PARTITION BY row ORDER BY level DESC) = 1),
upper_walk(row, level, place, acc, proof) AS (
  SELECT row, 0, tree, acc, proof FROM lower_end
  UNION ALL
  SELECT w.row, w.level + 1, w.place // {FANOUT}, sha256(s.before || w.acc || s.after), w.proof || s.before || s.after
  FROM upper_walk w JOIN root_sides s USING (level, place)),
upper_end AS (SELECT row, acc, proof FROM upper_walk QUALIFY row_number() OVER (PARTITION BY row ORDER BY level DESC) = 1)
SELECT d.doc_id, d.leaf, t.digest AS subroot, r.digest AS root, sha256(e.proof) AS proof_sha256, e.acc AS folded_root, e.acc = r.digest AS verified
FROM (SELECT *, row_number() OVER () AS row FROM numbered) d JOIN upper_end e USING (row) JOIN subroots t ON t.tree = d.tree, (SELECT digest FROM root_nodes WHERE n = 1) r
"""
