"""Stage tables of the pipeline built from the driver tables.

These are the shared building blocks of the named queries: each returns a
lazy DataFrame; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import normalize_text, tokenize
from ..operators.encode import encode_text, hash_text_encoder, text_encoder_input
from ..operators.fuse import fuse, text_side
from ..sources import driver_tables as dt

# Width of the stand-in text encoder's output on the driver tables.
TEXT_DIM = 32


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dt.manifest(spark, sf_dir)


def processed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D2 (OP-T1): id, img, text (normalised), label, split."""
    m = manifest(spark, sf_dir)
    return m.select("id", "img", normalize_text(F.col("text")).alias("text"), "label", "split")


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dt.posts(spark, sf_dir)


def token_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3 (OP-T2) without the text-side label, which nothing on the driver
    tables reads: id, img, text_tokens, split."""
    return posts(spark, sf_dir).select("id", "img", tokenize(F.col("text")).alias("text_tokens"), "split")


def text_embeddings(spark: SparkSession, sf_dir: str, dim: int = TEXT_DIM) -> DataFrame:
    """D9 (OP-E1): img, text_embedding, split -- the batch text
    encoder job run with the stand-in hashing encoder."""
    toks = token_table(spark, sf_dir).select(
        "img", "split", text_encoder_input(F.col("text_tokens")).alias("encoder_input"))
    return (encode_text(toks, hash_text_encoder(dim), text_col="encoder_input")
            .select("img", "text_embedding", "split"))


def text_embeddings_for(spark: SparkSession, sf_dir: str, keys: DataFrame,
                        dim: int = TEXT_DIM) -> DataFrame:
    """D9 restricted to posts whose image key is in ``keys`` (filename):
    the semi join runs before the encoder, so only posts that can fuse
    are encoded."""
    from ..functions.arrays import basename
    m = posts(spark, sf_dir).withColumn("filename", basename(F.col("img")))
    m = m.join(keys.select("filename"), "filename", "left_semi")
    toks = m.select("img", "split",
                    text_encoder_input(tokenize(F.col("text"))).alias("encoder_input"))
    return (encode_text(toks, hash_text_encoder(dim), text_col="encoder_input")
            .select("img", "text_embedding", "split"))


def fused(spark: SparkSession, sf_dir: str, dim: int = TEXT_DIM) -> DataFrame:
    """D10 (OP-J1): filename, split, label, multimodal_features, features_vector."""
    img = dt.image_features(spark, sf_dir).select("filename", "split", "label", "resnet_features")
    txt = text_side(text_embeddings_for(spark, sf_dir, img, dim))
    return fuse(img, txt)


# Buckets of the co-located fuse on the driver tables.
FUSE_BUCKETS = 8


def fused_colocated(spark: SparkSession, sf_dir: str, dim: int = TEXT_DIM) -> DataFrame:
    """D10 from bucketed feature tables (OP-J1 without a shuffle)."""
    from ..operators.fuse import fuse_bucketed
    img = dt.image_features(spark, sf_dir).select("filename", "split", "label", "resnet_features")
    return fuse_bucketed(img, text_side(text_embeddings_for(spark, sf_dir, img, dim)), FUSE_BUCKETS)


def fused_table(spark: SparkSession, sf_dir: str, dim: int = TEXT_DIM) -> DataFrame:
    """D10 materialised (lineage cut into the shared checkpoint folder), for
    stages that read it several times (fit, then transform)."""
    from ..session import cut_lineage
    return cut_lineage(fused(spark, sf_dir, dim), spark)


def corpus_tokens(spark: SparkSession, sf_dir: str, tokens: DataFrame | None = None) -> DataFrame:
    """Distinct corpus tokens with a train-membership flag, from one pass
    over the tokenised text (a partial aggregate: a frequent word costs one
    row per partition).  Materialised -- it is bounded by the vocabulary
    size and read by both the vector table and the train vocabulary."""
    from ..session import cut_lineage
    tokens = tokens if tokens is not None else token_table(spark, sf_dir)
    flags = (tokens.select(F.explode("text_tokens").alias("token"),
                           (F.col("split") == "train").alias("in_train"))
             .groupBy("token").agg(F.max("in_train").alias("in_train")))
    return cut_lineage(flags, spark)


def train_vocabulary(spark: SparkSession, sf_dir: str, tokens: DataFrame | None = None) -> DataFrame:
    """OP-A6: distinct train tokens."""
    from ..operators.sequence import vocabulary
    return vocabulary(tokens if tokens is not None else token_table(spark, sf_dir), split="train")


def pruned_vectors(spark: SparkSession, sf_dir: str, tokens: DataFrame | None = None) -> DataFrame:
    """Word vectors pruned to the train vocabulary (OP-S7 semi join)."""
    return vector_source(spark, sf_dir, tokens)()


def vector_source(spark: SparkSession, sf_dir: str, tokens: DataFrame | None = None):
    """A function that gives the pruned word vectors: all, or those of a few
    tokens (broadcast, before anything moves).  Not
    materialised: the look-up joins them by token as they come out of the semi
    join, so each moves once.  Nor are the token lists (re-tokenising columnar
    text is cheaper than writing a corpus-sized copy); vectors and vocabulary
    share one pass instead."""
    from ..operators.sequence import prune_vectors
    flags = corpus_tokens(spark, sf_dir, tokens)
    vec = dt.word_vectors(spark, sf_dir, distinct_tokens=flags)
    vocab = flags.where(F.col("in_train")).select("token")

    def pruned(only: DataFrame | None = None) -> DataFrame:
        return prune_vectors(vec if only is None else vec.join(F.broadcast(only), "token", "left_semi"), vocab)

    return pruned


def sequences(spark: SparkSession, sf_dir: str, keys: DataFrame | None = None) -> DataFrame:
    """D6 (OP-E3): id, img, split, text_embedding_seq (80 x dim).
    With ``keys`` (filename), only posts whose image key is present are
    embedded (semi join first); the vocabulary still comes from every train
    post."""
    from ..functions.arrays import basename
    from ..functions.text import truncate_tokens
    from ..operators.sequence import sequence_embed
    tokens = token_table(spark, sf_dir)
    vectors = vector_source(spark, sf_dir, tokens)
    posts = tokens
    if keys is not None:
        # cut first: the join moves no token that the sequence has no place for
        posts = (tokens.withColumn("text_tokens", truncate_tokens(F.col("text_tokens"))).withColumn("filename", basename(F.col("img")))
                 .join(keys.select("filename"), "filename", "left_semi").drop("filename"))
    return sequence_embed(posts, vectors(), dim=dt.WORD_VECTOR_DIM, vectors_of=vectors)


def sequence_features(spark: SparkSession, sf_dir: str, keys: DataFrame | None = None) -> DataFrame:
    """D7 (OP-E4): filename, lstm_features, split -- the batch
    sequence-encoder job run with the stand-in mean-pooling encoder."""
    from ..functions.arrays import basename
    from ..functions.text import MAX_TOKENS
    from ..operators.encode import encode_sequences
    from ..operators.sequence import mean_pool_encoder
    seq = sequences(spark, sf_dir, keys)
    enc = encode_sequences(seq, mean_pool_encoder(MAX_TOKENS, dt.WORD_VECTOR_DIM),
                           rows=MAX_TOKENS, dim=dt.WORD_VECTOR_DIM)
    return enc.select(basename(F.col("img")).alias("filename"), "lstm_features", "split")


def fused_seq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D10 on the sequence route (OP-J2)."""
    img = dt.image_features(spark, sf_dir).select("filename", "split", "label", "resnet_features")
    seq = sequence_features(spark, sf_dir, keys=img).select("filename", "lstm_features")
    return fuse(img, seq, other_col="lstm_features")


# Width of the reduced features on the driver tables (the reference reduces
# a much wider input to 512).
PCA_K = 32


def scaled(spark: SparkSession, sf_dir: str):
    """D11 (OP-A5/M1): scaler fitted on train, applied to every split.
    Returns (model, scaled DataFrame)."""
    from ..operators.scale import fit_scaler, scale
    f = fused_table(spark, sf_dir)
    model = fit_scaler(f.where(F.col("split") == "train"))
    return model, scale(model, f)


def reduced(spark: SparkSession, sf_dir: str, k: int = PCA_K):
    """D12 (OP-M2): PCA fitted on scaled train rows.  Returns (model, df)."""
    from ..operators.scale import fit_pca
    _, s = scaled(spark, sf_dir)
    model = fit_pca(s.where(F.col("split") == "train"), k)
    return model, model.transform(s)


def balance_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train rows of the fused table as (filename, label, x array<double>)."""
    f = fused_table(spark, sf_dir).where(F.col("split") == "train")
    return f.select("filename", "label", F.col("multimodal_features").cast("array<double>").alias("x"))


def scored_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fused rows as (filename, split, label, x array<double>)."""
    f = fused_table(spark, sf_dir)
    return f.select("filename", "split", "label",
                    F.col("multimodal_features").cast("array<double>").alias("x"))


ROUNDS = 8
EPOCHS = 3
