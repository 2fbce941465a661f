"""The named queries (one per operator family of the inventory).

Rules shared with the oracle SQL: every computed column is aliased,
integers are BIGINT (labels INT), doubles are rounded to 6 places, and
vectors are reported as scalars (width, sums) or exploded by position.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.arrays import array_sum, basename, vector_width, weighted_sum
from ..operators import labels as lab
from ..sources import driver_tables as dt
from . import stages
from .registry import QUERIES, query


def r6(c):
    return F.round(c, 6)


# ---------------------------------------------------------------- step 0
@query("ingest_manifest")
def ingest_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """OP-S1/F2: the manifest of posts, one row per post, with its split."""
    return stages.manifest(spark, sf).select("id", "img", "label", "text", "split")


@query("split_counts")
def split_counts(spark: SparkSession, sf: str) -> DataFrame:
    """OP-A1/U3: rows per split, one job for all splits."""
    return lab.split_counts(stages.posts(spark, sf))


@query("basename_key")
def basename_key(spark: SparkSession, sf: str) -> DataFrame:
    """OP-F1: the join key (image base name) of every post."""
    return stages.posts(spark, sf).select("id", basename(F.col("img")).alias("filename"))


@query("image_layout")
def image_layout(spark: SparkSession, sf: str) -> DataFrame:
    """OP-S8: target path image_{split}/{class}/{file} of every post."""
    from ..sources.images import layout_images
    return layout_images(stages.manifest(spark, sf)).select("id", "split", "class", "path")


@query("folder_label")
def folder_label(spark: SparkSession, sf: str) -> DataFrame:
    """OP-S9/F10: class label read back out of the folder name."""
    from ..sources.images import layout_images, label_from_path
    lay = layout_images(stages.manifest(spark, sf))
    return lay.select("id", F.col("class").alias("folder"),
                      label_from_path(F.col("path")).alias("label"))


# ---------------------------------------------------------------- step 1
@query("fuse_concat")
def fuse_concat(spark: SparkSession, sf: str) -> DataFrame:
    """OP-J1/F3/F4: posts with both modalities, fused width and sum."""
    f = stages.fused(spark, sf)
    mm = F.col("multimodal_features")
    return f.select("filename", "split", "label",
                    F.size(mm).cast("bigint").alias("width"),
                    r6(weighted_sum(mm)).alias("feat_sum"))


# ---------------------------------------------------------------- step 2
@query("processed_text")
def processed_text(spark: SparkSession, sf: str) -> DataFrame:
    """OP-T1: normalised text table."""
    return stages.processed_text(spark, sf)


@query("text_tokens")
def text_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """OP-T2: token count and a digest of the token list per post."""
    t = stages.token_table(spark, sf)
    return t.select("id", "split", F.size("text_tokens").cast("bigint").alias("n_tokens"),
                    F.md5(F.array_join("text_tokens", " ")).alias("tokens_md5"))


@query("tokens_truncated")
def tokens_truncated(spark: SparkSession, sf: str) -> DataFrame:
    """OP-O1: the first 80 tokens."""
    from ..functions.text import truncate_tokens
    t = stages.token_table(spark, sf).select("id", truncate_tokens(F.col("text_tokens")).alias("k"))
    return t.select("id", F.size("k").cast("bigint").alias("n_kept"),
                    F.md5(F.array_join("k", " ")).alias("kept_md5"))


@query("vocabulary")
def vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    """OP-A6/U1: distinct train tokens."""
    return stages.train_vocabulary(spark, sf)


@query("wordvec_pruned")
def wordvec_pruned(spark: SparkSession, sf: str) -> DataFrame:
    """OP-S7/J4: word vectors kept by the train vocabulary."""
    v = stages.pruned_vectors(spark, sf)
    return v.select("token", F.size("vector").cast("bigint").alias("dim"),
                    r6(array_sum(F.col("vector"))).alias("vsum"))


@query("token_lookup")
def token_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """OP-J3/R3: one row per kept token with its looked-up vector (300 numbers)."""
    from ..operators.sequence import lookup_tokens
    toks = stages.token_table(spark, sf)
    vec = stages.vector_source(spark, sf, toks)
    lk = lookup_tokens(toks.select("id", "text_tokens"), vec(), dt.WORD_VECTOR_DIM, vectors_of=vec)
    return lk.select("id", F.col("pos").cast("bigint").alias("pos"), "token",
                     F.col("hit").cast("int").alias("hit"), r6(array_sum(F.col("vector"))).alias("vsum"))


@query("oov_rate")
def oov_rate(spark: SparkSession, sf: str) -> DataFrame:
    """OP-J4/Q1: share of kept tokens with no vector, per split (train
    vocabulary only, so dev/test words are out of vocabulary even when the
    vector file has them)."""
    from ..operators.sequence import lookup_tokens
    toks = stages.token_table(spark, sf)
    vec = stages.vector_source(spark, sf, toks)
    lk = lookup_tokens(toks.select("split", "text_tokens"), vec(), dt.WORD_VECTOR_DIM, vectors_of=vec)
    return lk.groupBy("split").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_tokens"),
        F.count(F.when(~F.col("hit"), 1)).cast("bigint").alias("n_oov"),
        r6(F.avg((~F.col("hit")).cast("double"))).alias("oov_rate"))


@query("sequence_shape")
def sequence_shape(spark: SparkSession, sf: str) -> DataFrame:
    """OP-E3/F7/F8: every sequence is 80 rows x dim, zero rows for padding
    and out-of-vocabulary tokens."""
    s = stages.sequences(spark, sf)
    seq = F.col("text_embedding_seq")
    widths = F.transform(seq, lambda r: F.size(r))
    nonzero = F.filter(seq, lambda r: F.exists(r, lambda x: x != F.lit(0.0)))
    return s.select("id", F.size(seq).cast("bigint").alias("n_rows"),
                    F.array_min(widths).cast("bigint").alias("min_cols"),
                    F.array_max(widths).cast("bigint").alias("max_cols"),
                    F.size(nonzero).cast("bigint").alias("n_nonzero_rows"))


@query("sequence_checksum")
def sequence_checksum(spark: SparkSession, sf: str) -> DataFrame:
    """OP-E3: positional checksum sum_pos (pos+1) * sum(vector[pos])."""
    s = stages.sequences(spark, sf)
    seq = F.col("text_embedding_seq")
    chk = F.aggregate(F.sequence(F.lit(0), F.size(seq) - 1), F.lit(0.0).cast("double"),
                      lambda acc, i: acc + (i + 1).cast("double") * array_sum(F.element_at(seq, i + 1)))
    return s.select("id", "split", r6(chk).alias("checksum"))


@query("fuse_concat_seq")
def fuse_concat_seq(spark: SparkSession, sf: str) -> DataFrame:
    """OP-J2: image features x sequence-encoder features."""
    f = stages.fused_seq(spark, sf)
    mm = F.col("multimodal_features")
    return f.select("filename", "split", "label",
                    F.size(mm).cast("bigint").alias("width"),
                    r6(weighted_sum(mm)).alias("feat_sum"))


# ---------------------------------------------------------------- step 3
@query("label_validation")
def label_validation(spark: SparkSession, sf: str) -> DataFrame:
    """OP-P4: labels outside 0..1 and null labels per split."""
    return lab.validate_labels(stages.manifest(spark, sf))


@query("class_counts")
def class_counts(spark: SparkSession, sf: str) -> DataFrame:
    """OP-A2: rows per (split, label)."""
    return lab.class_counts(stages.manifest(spark, sf))


@query("class_weights")
def class_weights(spark: SparkSession, sf: str) -> DataFrame:
    """OP-A3/A4/P6: balanced class weights over the whole train split."""
    m = stages.manifest(spark, sf)
    return lab.class_weights(m.where(F.col("split") == "train")).withColumn("weight", r6(F.col("weight")))


# ---------------------------------------------------------------- step 4
@query("scaler_stats")
def scaler_stats(spark: SparkSession, sf: str) -> DataFrame:
    """OP-A5: fitted per-dimension mean and sample std (train only)."""
    from ..operators.scale import scaler_stats as stats
    model, _ = stages.scaled(spark, sf)
    st = stats(model)
    return st.select("dim", r6(F.col("mean")).alias("mean"), r6(F.col("std")).alias("std"))


@query("scaled_features")
def scaled_features(spark: SparkSession, sf: str) -> DataFrame:
    """OP-M1/F4: every split scaled by the train statistics, by position."""
    from ..functions.arrays import to_array
    _, s = stages.scaled(spark, sf)
    return s.select("filename", "split", F.posexplode(to_array(F.col("scaled_features"))).alias("dim", "value")) \
        .select("filename", "split", F.col("dim").cast("bigint").alias("dim"), r6(F.col("value")).alias("value"))


@query("fixed_width")
def fixed_width(spark: SparkSession, sf: str) -> DataFrame:
    """OP-F6: image vectors cut to 48 and zero-padded to 80."""
    from ..functions.arrays import fix_width
    img = dt.image_features(spark, sf)
    cut, pad = fix_width(F.col("resnet_features"), 48), fix_width(F.col("resnet_features"), 80)
    return img.select("filename", F.size(cut).cast("bigint").alias("w_cut"), r6(array_sum(cut)).alias("sum_cut"),
                      F.size(pad).cast("bigint").alias("w_pad"), r6(array_sum(pad)).alias("sum_pad"))


@query("covariance")
def covariance(spark: SparkSession, sf: str) -> DataFrame:
    """OP-M2 input: sample covariance of the scaled train features (i <= j)."""
    from ..operators.scale import covariance as cov
    _, s = stages.scaled(spark, sf)
    c = cov(s.where(F.col("split") == "train"), "scaled_features")
    return c.select("i", "j", r6(F.col("cov")).alias("cov"))


@query("pca_features")
def pca_features(spark: SparkSession, sf: str) -> DataFrame:
    """OP-M2: PCA to k dims (sign-free summary: width and squared norm)."""
    from ..functions.arrays import array_sumsq, to_array
    _, r = stages.reduced(spark, sf)
    p = to_array(F.col("pca_features"))
    return r.select("filename", "split", "label", F.size(p).cast("bigint").alias("k"),
                    r6(array_sumsq(p)).alias("sq_norm"))


# ---------------------------------------------------------------- step 5
# Small cells, so that the given tables span several.
KNN_OPTIONS = {"cell_size": 64, "block": 128}


def _minority(spark, sf):
    from ..operators.smote import class_sizes, minority_label
    bi = stages.balance_input(spark, sf)
    return bi, minority_label(class_sizes(bi))


@query("minority_knn")
def minority_knn(spark: SparkSession, sf: str) -> DataFrame:
    """OP-J5/O5: exact 3 nearest neighbours inside the train minority class."""
    from ..operators.knn import knn_self_join
    bi, minor = _minority(spark, sf)
    kn = knn_self_join(bi.where(F.col("label") == minor), k=3, id_col="filename", vec_col="x", **KNN_OPTIONS)
    return kn.select("filename", "rank", "nbr_filename", r6(F.col("dist")).alias("dist"))


@query("smote_synthetic")
def smote_synthetic(spark: SparkSession, sf: str) -> DataFrame:
    """OP-M3: seeded synthetic minority rows (k=3, seed=42)."""
    from ..operators.smote import smote_synthetic as syn
    bi = stages.balance_input(spark, sf)
    s = syn(bi, id_col="filename", vec_col="x", knn_options=KNN_OPTIONS)
    return s.select("s", "base_filename", "nbr_filename", "rank", r6(F.col("step")).alias("step"),
                    r6(weighted_sum(F.col("x"))).alias("feat_sum"))


@query("smote_balanced")
def smote_balanced(spark: SparkSession, sf: str) -> DataFrame:
    """OP-U2: class counts after balancing (originals + synthetic)."""
    from ..operators.smote import smote_balanced as bal, smote_synthetic as syn
    bi = stages.balance_input(spark, sf)
    b = bal(bi, syn(bi, id_col="filename", vec_col="x", knn_options=KNN_OPTIONS))
    return b.groupBy("label").agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                                  F.sum(F.col("is_synthetic").cast("bigint")).cast("bigint").alias("n_synthetic"),
                                  F.round(F.sum(weighted_sum(F.col("features"))), 3).alias("feat_sum"))


# ---------------------------------------------------------------- step 6
def _rule_scored(spark, sf, split):
    from ..operators.classify import rule_weights, score_rule
    d = stages.scored_input(spark, sf)
    return score_rule(d.where(F.col("split") == split), "x", rule_weights(vector_width(d, "x"), 1))


@query("argmax_predictions")
def argmax_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """OP-O4/M9: keyed test predictions from class scores (fixed rule)."""
    return _rule_scored(spark, sf, "test").select("filename", "predicted_label")


@query("dev_accuracy")
def dev_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    """OP-A7: accuracy on dev (percent)."""
    from ..operators.classify import evaluate
    ev = evaluate(_rule_scored(spark, sf, "dev"))
    return ev.select("n", "n_correct", r6(F.col("accuracy")).alias("accuracy"))


@query("dev_log_loss")
def dev_log_loss(spark: SparkSession, sf: str) -> DataFrame:
    """OP-A8: mean cross-entropy on dev."""
    from ..operators.classify import evaluate
    ev = evaluate(_rule_scored(spark, sf, "dev"))
    return ev.select("n", r6(F.col("log_loss")).alias("log_loss"))


@query("split_metrics")
def split_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """OP-A7/A8, Q7 fix: accuracy and log-loss of every labelled split in
    one aggregate (the reference scores dev only)."""
    from ..operators.classify import evaluate, rule_weights, score_rule
    d = stages.scored_input(spark, sf)
    ev = evaluate(score_rule(d, "x", rule_weights(vector_width(d, "x"), 1)), by=["split"])
    return ev.select("split", "n", "n_correct", r6(F.col("accuracy")).alias("accuracy"),
                     r6(F.col("log_loss")).alias("log_loss"))


def _round_metrics(spark, sf):
    from ..operators.classify import round_metrics
    d = stages.scored_input(spark, sf)
    return round_metrics(d.where(F.col("split") == "dev"), "x", vector_width(d, "x"), stages.ROUNDS)


@query("best_round")
def best_round(spark: SparkSession, sf: str) -> DataFrame:
    """OP-M6: per-round dev metrics and the selected round (first best)."""
    from ..operators.classify import select_best_round
    b = select_best_round(_round_metrics(spark, sf))
    return b.select("round", r6(F.col("dev_accuracy")).alias("dev_accuracy"),
                    r6(F.col("dev_log_loss")).alias("dev_log_loss"), "is_best")


@query("early_stop")
def early_stop(spark: SparkSession, sf: str) -> DataFrame:
    """OP-M7: stop round (patience 3 on dev loss) and restored round."""
    from ..operators.classify import early_stop as es
    e = es(_round_metrics(spark, sf))
    return e.select("stopped_round", "restored_round", r6(F.col("best_loss")).alias("best_loss"))


@query("epoch_shuffle")
def epoch_shuffle(spark: SparkSession, sf: str) -> DataFrame:
    """OP-O3: seeded repeatable per-epoch order of the train rows: one numbering,
    a keyed permutation of it for each epoch, no sort per epoch."""
    from ..operators.permute import epoch_positions
    t = stages.scored_input(spark, sf).where(F.col("split") == "train")
    return epoch_positions(t, "filename", stages.EPOCHS, seed=42).select(
        F.col("epoch").cast("int").alias("epoch"), "filename", "position")


@query("mlp_predictions")
def mlp_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """OP-M4/M9/M10: the whole chain -> keyed test predictions (trained
    model: rows-only check)."""
    from .flagship import run
    return run(spark, sf)


@query("route_l_predictions")
def route_l_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """OP-M10 on the sequence route: fuse with the sequence encoder's output,
    scale, PCA, SMOTE, rounds selected on dev -> keyed test predictions."""
    from .flagship import run
    return run(spark, sf, route="sequence")


@query("linear_predictions")
def linear_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """OP-M5: class-weighted logistic regression -> keyed test predictions."""
    from .flagship import run_linear
    return run_linear(spark, sf)


# ---------------------------------------------------------------- step 7
@query("text_embedding")
def text_embedding(spark: SparkSession, sf: str) -> DataFrame:
    """OP-E1: the batch text-encoder job (predict_batch_udf, 32 rows per
    call) with the stand-in hashing encoder."""
    from ..functions.arrays import array_sumsq
    t = stages.text_embeddings(spark, sf)
    e = F.col("text_embedding")
    return t.select("img", F.size(e).cast("bigint").alias("width"),
                    F.size(F.filter(e, lambda x: x > F.lit(0.0))).cast("bigint").alias("nnz"),
                    r6(array_sumsq(e)).alias("sumsq"), r6(weighted_sum(e)).alias("wsum"))


# ---------------------------------------------------------------- step 8
@query("landed_manifest")
def landed_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """OP-S2: records whose image landed (left semi join)."""
    from ..sources.manifest import land_images
    landed, _ = land_images(stages.manifest(spark, sf), dt.image_files(spark, sf))
    return landed.select("id", "img", "label", "split")


@query("rejected_manifest")
def rejected_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """OP-S2 fix: records dropped because their image is missing (left anti)."""
    from ..sources.manifest import land_images
    _, rejected = land_images(stages.manifest(spark, sf), dt.image_files(spark, sf))
    return rejected.select("id", "img", "label", "split")


@query("manifest_json")
def manifest_json(spark: SparkSession, sf: str) -> DataFrame:
    """OP-W2/F11: JSON text of every record (null label kept)."""
    from ..sinks.writers import manifest_json_col
    return stages.manifest(spark, sf).select("id", manifest_json_col().alias("json"))


@query("feature_batches")
def feature_batches(spark: SparkSession, sf: str) -> DataFrame:
    """OP-W3/A9: batch number (256 rows per batch, by image name, per split)
    and batches per split."""
    from ..sinks.writers import SEQUENCE_SAVE_BATCH, batch_numbers
    m = stages.posts(spark, sf).select("id", "img", "split")
    return batch_numbers(m, "img", SEQUENCE_SAVE_BATCH).select("id", "split", "batch", "n_batches")


@query("stream_ingest")
def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """OP-K1: the manifest lands as JSON files, a Structured Streaming query
    (availableNow, de-dup by id) ingests them to Parquet; equals the batch
    ingest."""
    from ..session import scratch_path
    from ..streaming.ingest import run_ingest
    root = scratch_path(spark, "stream-ingest")
    m = stages.manifest(spark, sf).select("id", "img", "label", "text", "split")
    m.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{root}/landing")
    out = run_ingest(spark, f"{root}/landing", f"{root}/table", f"{root}/checkpoint")
    return out.select("id", "img", "label", "text", "split")


@query("batch_rewrite")
def batch_rewrite(spark: SparkSession, sf: str) -> DataFrame:
    """OP-W3: batches written for twice the posts (each under a second name),
    then again for the posts; only the second run's rows are left."""
    from ..session import scratch_path
    from ..sinks.writers import SEQUENCE_SAVE_BATCH, write_batched
    path = scratch_path(spark, "batches")
    m = stages.posts(spark, sf).select("id", "img", "split")
    longer = m.unionByName(m.select("id", F.concat(F.lit("copy/"), "img").alias("img"), "split"))
    write_batched(longer, path, "img", SEQUENCE_SAVE_BATCH)
    write_batched(m, path, "img", SEQUENCE_SAVE_BATCH)
    return spark.read.parquet(path).select("id", "img", "split", "batch")


@query("wordvec_parse")
def wordvec_parse(spark: SparkSession, sf: str) -> DataFrame:
    """OP-S6/F9: the corpus word vectors as a text file with trailing spaces
    and a bad line for each, read back by the real reader."""
    from ..session import scratch_path
    from ..sources.wordvec import format_word_vectors, read_word_vectors
    path = scratch_path(spark, "wordvec")
    lines = format_word_vectors(dt.word_vectors(spark, sf))
    # a line and its bad line from one pass
    both = F.array(F.concat("value", F.lit("  ")), F.concat(F.substring_index("value", " ", 2), F.lit(" x")))
    lines.select(F.explode(both).alias("value")).write.text(path)
    v = read_word_vectors(spark, path, dt.WORD_VECTOR_DIM)
    return v.select("token", F.size("vector").cast("bigint").alias("dim"), r6(array_sum(F.col("vector"))).alias("vsum"))


@query("split_roundtrip")
def split_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """OP-W1/S3: the posts written by split and the dev split read back."""
    from ..session import scratch_path
    from ..sinks.writers import write_split
    from ..sources.manifest import read_split
    path = scratch_path(spark, "splits")
    write_split(stages.manifest(spark, sf).select("id", "img", "label", "split"), path)
    return read_split(spark, path, "dev").select("id", "img", "label", "split")


@query("manifest_roundtrip")
def manifest_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """OP-W2/S1: the JSON manifest written and read back, nulls kept."""
    from ..session import scratch_path
    from ..sinks.writers import write_manifest
    from ..sources.manifest import read_manifest
    path = scratch_path(spark, "manifest")
    write_manifest(stages.manifest(spark, sf), path)
    # (the folders carry this library's split names)
    parts = [read_manifest(spark, f"{path}/split={name}", split=name) for name in ("train", "dev", "test")]
    m = functools.reduce(DataFrame.unionByName, parts)
    return m.select("id", "img", "label", "text", "split")


@query("weighted_log_loss")
def weighted_log_loss(spark: SparkSession, sf: str) -> DataFrame:
    """OP-A8: class-weighted mean cross-entropy of every split, weights from
    the train rows."""
    from ..operators.classify import rule_weights, score_rule, weighted_loss
    d = stages.scored_input(spark, sf)
    scored = score_rule(d, "x", rule_weights(vector_width(d, "x"), 1))
    ev = weighted_loss(scored, lab.class_weights(d.where(F.col("split") == "train")), by=["split"])
    return ev.select("split", "n", r6(F.col("log_loss")).alias("log_loss"))


@query("label_gate")
def label_gate(spark: SparkSession, sf: str) -> DataFrame:
    """OP-P5: the gate over the posts' labels (nulls warn, values outside 0..1
    stop): the validation rows that it lets through."""
    m = stages.manifest(spark, sf)
    report = lab.validate_labels(m)
    lab.enforce_labels(report)
    return report.select("split", "n_invalid", "n_rows")


@query("text_limit")
def text_limit(spark: SparkSession, sf: str) -> DataFrame:
    """OP-T3: the text encoder job reads at most 128 tokens of a post."""
    from ..operators.encode import TEXT_MAX_LENGTH, encode_text, hash_text_encoder, text_encoder_input
    toks = stages.token_table(spark, sf).select("img", text_encoder_input(F.col("text_tokens")).alias("encoder_input"))
    e = encode_text(toks, hash_text_encoder(stages.TEXT_DIM, max_length=TEXT_MAX_LENGTH), text_col="encoder_input")
    return e.select("img", r6(weighted_sum(F.col("text_embedding"))).alias("wsum"))


@query("scaler_reload")
def scaler_reload(spark: SparkSession, sf: str) -> DataFrame:
    """OP-W5/W7: the fitted scaler saved by the model store, loaded again (no
    "best" model is stored, so the final one loads) and applied."""
    from pyspark.ml.feature import StandardScalerModel
    from ..functions.arrays import to_array
    from ..operators.scale import scale
    from ..session import scratch_path
    from ..sinks.models import load_model, save_model
    model, s = stages.scaled(spark, sf)
    root = scratch_path(spark, "scaler")
    save_model(model, f"{root}/final")
    again = scale(load_model(StandardScalerModel.load, [f"{root}/best", f"{root}/final"]), s.drop("scaled_features"))
    return again.select("filename", "split", r6(weighted_sum(to_array(F.col("scaled_features")))).alias("wsum"))


@query("published_scores")
def published_scores(spark: SparkSession, sf: str) -> DataFrame:
    """OP-W6/W7/M9: a pipeline published twice (the second replaces the first),
    its stored size checked, loaded as the best model and applied to the test
    split."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import SQLTransformer
    from ..operators.classify import predict
    from ..session import scratch_path
    from ..sinks.models import load_model, publish_model
    path = scratch_path(spark, "published")
    rule = "SELECT *, CAST(aggregate(resnet_features, 0D, (s, x) -> s + x) {} 0 AS DOUBLE) AS prediction FROM __THIS__"
    for sign in ("<=", ">"):
        stored, size = publish_model(spark, PipelineModel([SQLTransformer(statement=rule.format(sign))]), path)
        if stored != path or size <= 0:
            raise RuntimeError("the model was not stored")
    model = load_model(PipelineModel.load, [path])
    return predict(model, dt.image_features(spark, sf).where(F.col("split") == "test"))


@query("csv_predictions")
def csv_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """OP-W4/M9: test predictions of a fixed rule as one CSV file with a
    header, read back."""
    from ..session import scratch_path
    from ..sinks.writers import write_csv_single
    path = scratch_path(spark, "csv")
    write_csv_single(_rule_scored(spark, sf, "test").select("filename", "predicted_label"), path)
    return spark.read.option("header", True).schema("filename string, predicted_label int").csv(path)


@query("split_presence")
def split_presence(spark: SparkSession, sf: str) -> DataFrame:
    """OP-S11/P8: the landed posts of each split and of one that was never
    written, read as typed tables, and whether the guard lets them through."""
    from ..operators.fuse import EmptyJoin, require_rows
    from ..schemas import MANIFEST
    from ..session import scratch_path
    from ..sinks.writers import write_split
    from ..sources.manifest import read_or_empty
    path = scratch_path(spark, "presence")
    write_split(stages.manifest(spark, sf).select("id", "img", "label", "text", "split"), path)

    def passes(df):
        try:
            require_rows(df)
        except EmptyJoin:
            return False
        return True

    found = None
    for split in ("train", "dev", "test", "holdout"):
        df = read_or_empty(spark, f"{path}/split={split}", MANIFEST)
        one = df.agg(F.count("*").alias("n_rows"), F.count("label").alias("n_labelled")).select(
            F.lit(split).alias("split"), F.lit(passes(df)).alias("passes"), "n_rows", "n_labelled")
        found = one if found is None else found.unionByName(one)
    return found


@query("fuse_colocated")
def fuse_colocated(spark: SparkSession, sf: str) -> DataFrame:
    """OP-J1, co-located: both feature tables written in buckets and joined
    bucket by bucket; the result of ``fuse_concat``."""
    f = stages.fused_colocated(spark, sf)
    mm = F.col("multimodal_features")
    return f.select("filename", "split", "label", F.size(mm).cast("bigint").alias("width"), r6(weighted_sum(mm)).alias("feat_sum"))


@query("descent_neighbours")
def descent_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    """OP-J5/O5: 3 nearest neighbours of every image feature by graph
    refinement, in linear work (approximate: rows-only check; the tests measure
    recall)."""
    from ..operators.knn import knn_self_join
    img = dt.image_features(spark, sf).select("filename", F.col("resnet_features").cast("array<double>").alias("x"))
    kn = knn_self_join(img, k=3, id_col="filename", vec_col="x", method="descent")
    return kn.select("filename", "rank", "nbr_filename", r6(F.col("dist")).alias("dist"))


@query("smote_descent")
def smote_descent(spark: SparkSession, sf: str) -> DataFrame:
    """OP-M3/U2 through the graph: class counts after balancing."""
    from ..operators.smote import smote_balanced as bal, smote_synthetic as syn
    bi = stages.balance_input(spark, sf)
    b = bal(bi, syn(bi, id_col="filename", vec_col="x", knn_options={"method": "descent"}))
    return b.groupBy("label").agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                                  F.sum(F.col("is_synthetic").cast("bigint")).cast("bigint").alias("n_synthetic"))


@query("npy_roundtrip")
def npy_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """OP-S10/W3/O2: the image features written as NumPy batch folders (500 rows
    each) through the data source's commit, and read back folder by folder."""
    from ..session import scratch_path
    from ..sinks.writers import IMAGE_SAVE_BATCH, batch_numbers
    from ..sources.npy import read_npy_batches, write_npy_batches
    path = scratch_path(spark, "npy")
    b = batch_numbers(dt.image_features(spark, sf), "filename", IMAGE_SAVE_BATCH)
    write_npy_batches(b, path, "resnet_features", "resnet_features")
    x = F.col("resnet_features")
    return read_npy_batches(spark, path, "resnet_features", "resnet_features", mode="FAILFAST").select(
        "filename", "label", "split", "batch", F.size(x).cast("bigint").alias("width"), r6(weighted_sum(x)).alias("wsum"))


def _image_folder(spark, sf):
    """The image files of the driver tables, written to a scratch folder."""
    from ..session import scratch_path
    from ..sinks.files import write_files
    path = scratch_path(spark, "images")
    write_files(dt.image_bytes(spark, sf), path)
    return path


@query("image_read")
def image_read(spark: SparkSession, sf: str) -> DataFrame:
    """OP-S4/S5/P7: the .png files of a folder with their labels, and whether
    they could be decoded."""
    from ..sources.images import image_read_report
    return image_read_report(spark, _image_folder(spark, sf)).select("filename", "label", "decoded")


@query("image_encode")
def image_encode(spark: SparkSession, sf: str) -> DataFrame:
    """OP-F13/E2: image files -> tensors -> the batch image-encoder job, keyed
    by file with the folder's label (stand-in encoder: rounded grey values)."""
    from ..operators.encode import encode_images, grey_image_encoder, prepare_images
    from ..sources.images import read_images
    px = prepare_images(read_images(spark, _image_folder(spark, sf)), size=dt.IMAGE_SIDE)
    e = encode_images(px, grey_image_encoder(), size=dt.IMAGE_SIDE, dim=dt.IMAGE_SIDE ** 2)
    return e.select("filename", "label", r6(weighted_sum(F.col("resnet_features"))).alias("wsum"))


@query("score_stream")
def scored_stream(spark: SparkSession, sf: str) -> DataFrame:
    """OP-K2: arriving image features scored by a stored model (a fixed rule)."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import SQLTransformer
    from ..session import scratch_path
    from ..streaming.scoring import score_stream
    root = scratch_path(spark, "score-stream")
    rows = dt.image_features(spark, sf).select("filename", "resnet_features")
    rows.write.parquet(f"{root}/arriving")
    rule = SQLTransformer(statement="SELECT *, CAST(aggregate(resnet_features, 0D, (s, x) -> s + x) > 0 AS DOUBLE) AS prediction FROM __THIS__")
    PipelineModel([rule]).write().save(f"{root}/model")
    score_stream(spark, f"{root}/arriving", rows.schema, f"{root}/model", PipelineModel.load, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema("filename string, predicted_label int").parquet(f"{root}/out/epoch=*")


def all_queries():
    return dict(QUERIES)
