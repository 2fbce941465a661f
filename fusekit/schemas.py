"""Every table contract between stages, declared once (never inferred)."""

from __future__ import annotations

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import types as T

FLOATS = T.ArrayType(T.FloatType())
DOUBLES = T.ArrayType(T.DoubleType())

SPLITS = ("train", "dev", "test")

# One JSON record per post.
MANIFEST = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("img", T.StringType()),
    T.StructField("label", T.IntegerType()),
    T.StructField("text", T.StringType()),
])

# Normalised text.
PROCESSED_TEXT = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("img", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("label", T.IntegerType()),
])

# D3: token lists.
TOKENS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("img", T.StringType()),
    T.StructField("text_tokens", T.ArrayType(T.StringType())),
    T.StructField("label", T.IntegerType()),
])

# Word vectors, one row per token.
WORD_VECTORS = T.StructType([
    T.StructField("token", T.StringType()),
    T.StructField("vector", FLOATS),
])

# Padded sequence matrices.
SEQUENCES = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("img", T.StringType()),
    T.StructField("text_embedding_seq", T.ArrayType(FLOATS)),
    T.StructField("label", T.IntegerType()),
])

# Image features.
IMAGE_FEATURES = T.StructType([
    T.StructField("filename", T.StringType()),
    T.StructField("label", T.IntegerType()),
    T.StructField("resnet_features", FLOATS),
])

# Sequence-encoder features.
SEQUENCE_FEATURES = T.StructType([
    T.StructField("filename", T.StringType()),
    T.StructField("label", T.IntegerType()),
    T.StructField("lstm_features", FLOATS),
])

# Text features.
TEXT_EMBEDDINGS = T.StructType([
    T.StructField("img", T.StringType()),
    T.StructField("label", T.IntegerType()),
    T.StructField("text_embedding", FLOATS),
])

# Fused features.
FUSED = T.StructType([
    T.StructField("filename", T.StringType()),
    T.StructField("label", T.IntegerType()),
    T.StructField("multimodal_features", FLOATS),
    T.StructField("features_vector", VectorUDT()),
])

# Scaled and reduced features.
SCALED = T.StructType([
    T.StructField("filename", T.StringType()),
    T.StructField("label", T.IntegerType()),
    T.StructField("scaled_features", VectorUDT()),
])
REDUCED = T.StructType([
    T.StructField("filename", T.StringType()),
    T.StructField("label", T.IntegerType()),
    T.StructField("pca_features", VectorUDT()),
])

# Balanced training set.
BALANCED = T.StructType([
    T.StructField("features", VectorUDT()),
    T.StructField("label", T.IntegerType()),
])

# Predictions.
PREDICTIONS = T.StructType([
    T.StructField("filename", T.StringType()),
    T.StructField("predicted_label", T.IntegerType()),
])

# Raw image files (binaryFile source).
BINARY_FILE = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
])


def with_split(schema: T.StructType) -> T.StructType:
    """The same contract plus the ``split`` partition column."""
    return T.StructType(list(schema.fields) + [T.StructField("split", T.StringType())])
