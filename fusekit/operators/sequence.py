"""Word-vector sequence encoding (OP-A6, OP-S7, OP-J3, OP-J4, OP-F7, OP-F8,
OP-E3, OP-O1, OP-R3).

The reference collects the training vocabulary to the driver, streams the
whole vector file through one driver thread into a map, broadcasts it and
looks tokens up in a Scala UDF.  Here the look-up is request and reply, one
plan at every size of posts and of vectors:

    train tokens --explode/distinct--> vocabulary
    vectors --left_semi vocabulary--> pruned vectors              (OP-S7/J4)
    posts --chunks of CHUNK_POSTS rows, tokens as numbers in the chunk's own
            list of distinct tokens, written once-->
    chunk tokens --one row for each distinct token of a chunk--> join with
            the pruned vectors on token                           (OP-J3)
    replies --one row for each chunk--> beside the chunk's posts, expanded
            in the task: zeros for misses, padded to 80           (OP-F7/F8)

A vector moves once for each chunk that holds its token, however often the
token occurs there; what is expanded (80 x 300 floats a post) never moves.
The vectors of the tokens that most chunks hold, ``HOT_TOKENS`` at most, are
broadcast and not asked for.  Spark sends the vectors to all tasks instead of
shuffling them if it measures them as small (its own
``autoBroadcastJoinThreshold``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import MAX_TOKENS
from ..session import cut_lineage

#: Posts of a chunk; a chunk's distinct tokens, at most 80 times as many, get
#: their vectors together.
CHUNK_POSTS = 2048
#: Tokens whose vectors are broadcast at most, and the chunks that each is in at
#: least: a broadcast reaches a few executors, a reply one chunk.
HOT_TOKENS = 1 << 16
HOT_CHUNKS = 12
#: Bytes of expanded vectors that a task hands on at a time.
OUT_BYTES = 16 << 20


def vocabulary(tokens: DataFrame, split: str | None = "train",
               tokens_col: str = "text_tokens") -> DataFrame:
    """OP-A6/U1/Q1: distinct tokens of one split (train: no leakage).
    The distinct is a partial (map-side) aggregate, so a very frequent
    token costs one row per partition before the shuffle."""
    src = tokens if split is None else tokens.where(F.col("split") == F.lit(split))
    return src.select(F.explode(F.col(tokens_col)).alias("token")).distinct()


def prune_vectors(vectors: DataFrame, vocab: DataFrame) -> DataFrame:
    """OP-S7/J4: keep vectors whose token is in the vocabulary (exact,
    case-sensitive).  A semi join: AQE broadcasts the smaller side when its
    measured size allows, otherwise both are shuffled on token."""
    return vectors.join(vocab.select("token"), "token", "left_semi")


def _to_chunks(tokens_at: int, max_tokens: int, chunk_posts: int):
    """Posts to chunk rows: the posts with token numbers (Arrow bytes), and the
    distinct tokens in the order of their numbers."""

    def run(batches):
        import pyarrow.compute as pc
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for lo in range(0, batch.num_rows, chunk_posts):
                part = batch.slice(lo, chunk_posts)
                lists = part.column(tokens_at)
                # an absent list is an empty one: its post must not vanish
                sizes = np.minimum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(), max_tokens)
                coded = pc.list_slice(lists, 0, max_tokens).flatten().dictionary_encode()
                ends = pa.array(np.append(0, np.cumsum(sizes)), pa.int32())
                index = pa.ListArray.from_arrays(ends, pc.fill_null(coded.indices, -1))
                kept = [c for i, c in enumerate(part.columns) if i != tokens_at]
                rows = pa.RecordBatch.from_arrays([*kept, index], names=[str(i) for i in range(part.num_columns)])
                out = pa.BufferOutputStream()
                with pa.ipc.new_stream(out, rows.schema) as stream:
                    stream.write_batch(rows)
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([out.getvalue().to_pybytes()], pa.binary()),
                                                  pa.array([coded.dictionary.to_pylist()], pa.list_(pa.string()))], names=["chunk", "posts", "tokens"])
                number += 1

    return run


def request_chunks(posts: DataFrame, tokens_col: str, max_tokens: int, chunk_posts: int = CHUNK_POSTS) -> DataFrame:
    """chunk, posts (binary), tokens (the chunk's distinct tokens); written, so
    that a chunk keeps its number when a task runs again."""
    at = posts.columns.index(tokens_col)
    posts = posts.withColumn(tokens_col, F.slice(tokens_col, 1, max_tokens))
    chunks = posts.mapInArrow(_to_chunks(at, max_tokens, chunk_posts), "chunk long, posts binary, tokens array<string>")
    return cut_lineage(chunks, posts.sparkSession)


def hot_tokens(chunks: DataFrame, most: int = HOT_TOKENS, least: int = HOT_CHUNKS) -> DataFrame | None:
    """Tokens that most chunks hold: all with more chunks than a bound that at
    most ``most`` tokens pass; None if there are none."""
    if chunks.count() < least:
        return None
    held = (chunks.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
            .where(F.col("n") >= least))
    held = cut_lineage(held, chunks.sparkSession)
    # tokens by number of chunks: as many rows as there are chunks at most
    sizes = sorted(((r["n"], r["tokens"]) for r in held.groupBy("n").agg(F.count("*").alias("tokens")).collect()), reverse=True)
    bound, sent = None, 0
    for n, tokens in sizes:
        sent += tokens
        if sent > most:
            break
        bound = n
    return None if bound is None else held.where(F.col("n") >= bound).select("token")


def vector_replies(chunks: DataFrame, vectors: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """(chunk, at, vector): the vector of each distinct token of each chunk that
    has one and is not ``hot``.  ``vectors`` has one row a token."""
    asked = chunks.select("chunk", F.posexplode("tokens").alias("at", "token"))
    if hot is not None:
        asked = asked.join(F.broadcast(hot), "token", "left_anti")
    return asked.join(vectors.select("token", "vector"), "token").select("chunk", "at", "vector")


def _answered(posts: DataFrame, vectors: DataFrame, tokens_col: str, max_tokens: int, chunk_posts: int, dim: int, vectors_of):
    """posts (binary), replies and tokens, one row a chunk; and the broadcast hot
    tokens with their vectors (None: there are none)."""
    if vectors_of is None:
        def vectors_of(tokens):
            return vectors.join(F.broadcast(tokens), "token", "left_semi")
    chunks = request_chunks(posts, tokens_col, max_tokens, chunk_posts)
    hot, sent = hot_tokens(chunks), None
    if hot is not None:
        found = vectors_of(hot).select("token", "vector").toArrow().combine_chunks()
        table = np.asarray(found["vector"].combine_chunks().flatten(), np.float32).reshape(-1, dim)
        sent = posts.sparkSession.sparkContext.broadcast((found["token"].to_pylist(), table))
    replies = vector_replies(chunks, vectors, hot).groupBy("chunk").agg(F.collect_list(F.struct("at", "vector")).alias("replies"))
    return chunks.join(replies, "chunk", "left").select("posts", "replies", "tokens"), sent


def _opened(batch: pa.RecordBatch, i: int, dim: int, hot=None):
    """The posts of a chunk row, token numbers, distinct tokens, vectors (a last
    row of zeros stands for misses) and which tokens have one."""
    with pa.ipc.open_stream(batch.column("posts")[i].as_py()) as stream:
        posts = stream.read_next_batch()
    tokens = batch.column("tokens")[i].values
    vectors = np.zeros((len(tokens) + 1, dim), np.float32)
    hit = np.zeros(len(tokens) + 1, bool)
    replies = batch.column("replies")[i].values
    if replies is not None and len(replies):
        at = replies.field("at").to_numpy()
        vectors[at] = replies.field("vector").flatten().to_numpy().reshape(len(at), dim)
        hit[at] = True
    if hot is not None:
        import pyarrow.compute as pc
        names, table = hot.value
        place = pc.fill_null(pc.index_in(tokens, pa.array(names, pa.string())), -1).to_numpy(zero_copy_only=False)
        at = np.flatnonzero(place >= 0)
        vectors[at], hit[at] = table[place[at]], True
    return posts, posts.column(posts.num_columns - 1), tokens, vectors, hit


def lookup_tokens(posts: DataFrame, vectors: DataFrame, dim: int, tokens_col: str = "text_tokens",
                  max_tokens: int = MAX_TOKENS, chunk_posts: int = CHUNK_POSTS, vectors_of=None) -> DataFrame:
    """OP-J3: one row for each of a post's first ``max_tokens`` tokens: the other
    columns, pos, token, vector (zeros for a miss) and hit.  ``vectors_of`` may
    give the rows of ``vectors`` for a few tokens (a table with column ``token``)
    at less cost than a join with all of them."""
    carry = [f for f in posts.schema.fields if f.name != tokens_col]
    answered, hot = _answered(posts, vectors, tokens_col, max_tokens, chunk_posts, dim, vectors_of)
    out_type = T.StructType(carry + [T.StructField("pos", T.IntegerType()), T.StructField("token", T.StringType()),
                                     T.StructField("vector", T.ArrayType(T.FloatType())), T.StructField("hit", T.BooleanType())])
    step = max(1, OUT_BYTES // (4 * dim))

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                rows, index, tokens, table, hit = _opened(batch, i, dim, hot)
                sizes = np.diff(index.offsets)
                post = np.repeat(np.arange(rows.num_rows), sizes)
                pos = np.arange(len(post)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                token = index.values.to_numpy()
                for lo in range(0, len(post), step):
                    t = token[lo:lo + step]
                    kept = rows.take(pa.array(post[lo:lo + step])).columns[:-1]
                    ends = pa.array(np.arange(0, (len(t) + 1) * dim, dim), pa.int32())
                    more = [pa.array(pos[lo:lo + step], pa.int32()), tokens.take(pa.array(t, mask=t < 0)),
                            pa.ListArray.from_arrays(ends, pa.array(table[t].ravel())), pa.array(hit[t])]
                    yield pa.RecordBatch.from_arrays([*kept, *more], names=out_type.names)

    return answered.mapInArrow(run, out_type)


def sequence_embed(posts: DataFrame, vectors: DataFrame, dim: int,
                   max_tokens: int = MAX_TOKENS, key: str = "id",
                   tokens_col: str = "text_tokens", carry=("img", "label", "split"),
                   out_col: str = "text_embedding_seq", chunk_posts: int = CHUNK_POSTS, vectors_of=None) -> DataFrame:
    """OP-E3: posts (key, tokens, carry...) -> key, carry..., a
    ``max_tokens`` x ``dim`` sequence (array<array<float>>).  ``vectors`` must
    already be pruned to the vocabulary, one row a token; posts that share an id
    keep a row each.  ``vectors_of``: see ``lookup_tokens``."""
    posts = posts.select(key, *[c for c in carry if c in posts.columns], tokens_col)
    answered, hot = _answered(posts, vectors, tokens_col, max_tokens, chunk_posts, dim, vectors_of)
    out_type = T.StructType(posts.schema.fields[:-1] + [T.StructField(out_col, T.ArrayType(T.ArrayType(T.FloatType())))])
    step = max(1, OUT_BYTES // (4 * dim * max_tokens))

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                rows, index, tokens, table, _ = _opened(batch, i, dim, hot)
                sizes = np.diff(index.offsets)
                grid = np.full((rows.num_rows, max_tokens), -1)
                grid[np.arange(max_tokens) < sizes[:, None]] = index.values.to_numpy()
                for lo in range(0, rows.num_rows, step):
                    part = grid[lo:lo + step]
                    inner = pa.array(np.arange(0, (part.size + 1) * dim, dim), pa.int32())
                    outer = pa.array(np.arange(0, part.size + 1, max_tokens), pa.int32())
                    seq = pa.ListArray.from_arrays(outer, pa.ListArray.from_arrays(inner, pa.array(table[part].ravel())))
                    yield pa.RecordBatch.from_arrays([*rows.slice(lo, len(part)).columns[:-1], seq], names=out_type.names)

    return answered.mapInArrow(run, out_type)


def mean_pool_encoder(rows: int, dim: int):
    """A stand-in sequence encoder for ``encode_sequences``: mean of the
    ``rows`` position vectors (float64 accumulate, float32 out)."""

    def make_predict_fn():
        import numpy as np

        def predict(x):
            return (x.astype(np.float64).sum(axis=1) / rows).astype(np.float32)

        return predict

    return make_predict_fn
