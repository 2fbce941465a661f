"""Batch encoder jobs (OP-E1, OP-E2, OP-E4, OP-F13).

The reference loads a network once per partition and feeds it 32 rows at
a time from a row iterator (text), or runs the network on the driver one
file at a time (images, sequences).  Here each is one Spark job: the
caller supplies ``make_predict_fn`` (a factory that loads the model and
returns a function of NumPy batches), and ``predict_batch_udf`` ships
Arrow batches to executor Python workers, caches the model per worker and
cuts the batches to ``batch_size``.  Errors fail the task (kept from the
reference).  The result is independent of partitioning and batch size.
"""

from __future__ import annotations

from typing import Callable

import numpy as np
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.arrays import basename, fix_width
from ..sources.images import label_from_path

# Fixed values from the reference configuration.
TEXT_BATCH = 32
TEXT_MAX_LENGTH = 128
IMAGE_BATCH = 32
IMAGE_SIZE = 224
IMAGE_DIM = 2048
SEQUENCE_BATCH = 256
SEQUENCE_HIDDEN = 150
# Per-channel means subtracted after RGB->BGR (the image model's
# "caffe" preprocessing), in B, G, R order.
BGR_MEANS = (103.939, 116.779, 123.68)


def _spread_for_inference(df: DataFrame, partitions: int | None) -> DataFrame:
    """OP-R1: inference parallelism is a parameter (the reference fixes 4
    partitions); ``None`` keeps the input partitioning."""
    return df.repartition(partitions) if partitions else df


def encode_text(df: DataFrame, make_predict_fn: Callable, text_col: str = "text",
                out_col: str = "text_embedding", batch_size: int = TEXT_BATCH,
                partitions: int | None = None) -> DataFrame:
    """OP-E1: one embedding per row from a caller-supplied text encoder.
    Null text is fed as ''.  The sub-word limit (OP-T3, 128 in the
    reference) belongs to the caller's encoder (its tokenizer's
    ``max_length``)."""
    udf = predict_batch_udf(make_predict_fn, return_type=T.ArrayType(T.FloatType()),
                            batch_size=batch_size)
    df = _spread_for_inference(df, partitions)
    return df.withColumn(out_col, udf(F.coalesce(F.col(text_col), F.lit(""))))


def hash_text_encoder(dim: int, max_length: int | None = None) -> Callable:
    """A deterministic stand-in text encoder (feature hashing): input is the
    space-joined token list; output[b] = share of tokens whose md5 bucket is
    b, as float32.  ``max_length`` truncates like a transformer tokenizer
    (OP-T3); the default ``None`` encodes the whole text.  SQL twin: see
    plans.oracle."""

    def make_predict_fn():
        import hashlib

        def predict(texts: np.ndarray) -> np.ndarray:
            out = np.zeros((len(texts), dim), dtype=np.float32)
            for r, text in enumerate(texts):
                toks = [t for t in str(text).split(" ") if t]
                if max_length is not None:
                    toks = toks[:max_length]
                if not toks:
                    continue
                buckets = np.fromiter(
                    (int(hashlib.md5(t.encode("utf-8")).hexdigest()[:8], 16) % dim for t in toks),
                    dtype=np.int64, count=len(toks))
                out[r] = (np.bincount(buckets, minlength=dim) / len(toks)).astype(np.float32)
            return out

        return predict

    return make_predict_fn


def encode_images(df: DataFrame, make_predict_fn: Callable, pixels_col: str = "pixels",
                  out_col: str = "resnet_features", batch_size: int = IMAGE_BATCH,
                  size: int = IMAGE_SIZE, dim: int = IMAGE_DIM,
                  partitions: int | None = None) -> DataFrame:
    """OP-E2: image tensors (flattened size*size*3 float32, see
    ``prepare_images``) -> features fixed to ``dim`` wide (OP-F6)."""
    udf = predict_batch_udf(make_predict_fn, return_type=T.ArrayType(T.FloatType()),
                            batch_size=batch_size, input_tensor_shapes=[[size, size, 3]])
    df = _spread_for_inference(df, partitions)
    return df.withColumn(out_col, fix_width(udf(F.col(pixels_col)), dim))


def grey_image_encoder() -> Callable:
    """A stand-in image encoder: the weighted sum 1, 2, 3 of the channels'
    values of each pixel, whole numbers again after the mean shift."""
    means = np.asarray(BGR_MEANS, dtype=np.float32)

    def make_predict_fn():
        def predict(x: np.ndarray) -> np.ndarray:
            return (np.rint(x + means) @ np.array([1, 2, 3], np.float32)).reshape(len(x), -1)

        return predict

    return make_predict_fn


def encode_sequences(df: DataFrame, make_predict_fn: Callable, seq_col: str = "text_embedding_seq",
                     out_col: str = "lstm_features", rows: int = 80, dim: int = 300,
                     batch_size: int = SEQUENCE_BATCH) -> DataFrame:
    """OP-E4: (rows x dim) sequence -> hidden state.  The nested array is
    flattened (predict_batch_udf takes flat tensors) and reshaped inside."""
    udf = predict_batch_udf(make_predict_fn, return_type=T.ArrayType(T.FloatType()),
                            batch_size=batch_size, input_tensor_shapes=[[rows, dim]])
    return df.withColumn(out_col, udf(F.flatten(F.col(seq_col))))


def lstm_encoder(weights: dict) -> Callable:
    """Forward pass of a one-layer LSTM in NumPy returning the last hidden
    state.  ``weights``: W (dim, 4h), U (h, 4h), b (4h), gate order
    i, f, c, o.  Weights are small and shipped in the closure."""
    W = np.asarray(weights["W"], dtype=np.float32)
    U = np.asarray(weights["U"], dtype=np.float32)
    b = np.asarray(weights["b"], dtype=np.float32)
    h_dim = U.shape[0]

    def make_predict_fn():
        def sigmoid(x):
            return 1.0 / (1.0 + np.exp(-x))

        def predict(x: np.ndarray) -> np.ndarray:
            n, steps, _ = x.shape
            h = np.zeros((n, h_dim), dtype=np.float32)
            c = np.zeros((n, h_dim), dtype=np.float32)
            for s in range(steps):
                z = x[:, s, :] @ W + h @ U + b
                i = sigmoid(z[:, :h_dim])
                f = sigmoid(z[:, h_dim:2 * h_dim])
                g = np.tanh(z[:, 2 * h_dim:3 * h_dim])
                o = sigmoid(z[:, 3 * h_dim:])
                c = f * c + i * g
                h = o * np.tanh(c)
            return h.astype(np.float32)

        return predict

    return make_predict_fn


def _axis_weights(n_in: int, n_out: int):
    """Source indices and weights of a bilinear resize along one axis
    (half-pixel centres, edges clamped)."""
    src = (np.arange(n_out) + 0.5) * (n_in / n_out) - 0.5
    src = np.clip(src, 0.0, n_in - 1)
    lo = np.floor(src).astype(np.int64)
    hi = np.minimum(lo + 1, n_in - 1)
    return lo, hi, (src - lo).astype(np.float32)


def _resize_bilinear(arr: np.ndarray, size: int) -> np.ndarray:
    """(h, w, c) float32 -> (size, size, c), separable bilinear."""
    r0, r1, wr = _axis_weights(arr.shape[0], size)
    arr = arr[r0] * (1 - wr)[:, None, None] + arr[r1] * wr[:, None, None]
    c0, c1, wc = _axis_weights(arr.shape[1], size)
    return arr[:, c0] * (1 - wc)[None, :, None] + arr[:, c1] * wc[None, :, None]


def _tensor(h, w, nch, data, size: int) -> np.ndarray | None:
    """One decoded image as a flat float32 tensor; None if it has no shape."""
    if data is None or h is None or h <= 0 or w <= 0:
        return None
    arr = np.frombuffer(bytes(data), dtype=np.uint8)
    if arr.size != h * w * nch:
        return None
    arr = arr.reshape(h, w, nch).astype(np.float32)
    if nch == 1:
        arr = np.repeat(arr, 3, axis=2)
    elif nch == 4:
        arr = arr[:, :, :3]
    arr = _resize_bilinear(arr, size)  # image source stores BGR already
    return (arr - np.asarray(BGR_MEANS, dtype=np.float32)).reshape(-1)


def prepare_images(images: DataFrame, size: int = IMAGE_SIZE, image_col: str = "image") -> DataFrame:
    """OP-F13: decoded ``image`` source rows -> path, filename, label (from
    the folder) and pixels, the float32 tensor for the image model: 3
    channels (grey and alpha fixed), bilinear resize to size x size, BGR
    channel means subtracted.  A row that cannot be shaped is dropped; the
    filename tells which (``image_read_report`` lists all files)."""

    def prep(batches):
        import pandas as pd
        for pdf in batches:
            # a tensor is far larger than its file: few of them at a time
            for at in range(0, len(pdf), IMAGE_BATCH):
                part = pdf.iloc[at:at + IMAGE_BATCH]
                pixels = [_tensor(h, w, nch, data, size) for h, w, nch, data in
                          zip(part["height"], part["width"], part["nChannels"], part["data"])]
                ok = [x is not None for x in pixels]
                yield pd.DataFrame({"path": part["origin"][ok], "pixels": [x for x in pixels if x is not None]})

    flat = images.select(*[F.col(f"{image_col}.{c}").alias(c) for c in ("origin", "height", "width", "nChannels", "data")])
    done = flat.mapInPandas(prep, schema="path string, pixels array<float>")
    return done.select("path", basename(F.col("path")).alias("filename"), label_from_path(F.col("path")).alias("label"), "pixels")


def text_encoder_input(tokens: Column) -> Column:
    """Space-joined tokens, the input of ``hash_text_encoder``."""
    return F.array_join(F.coalesce(tokens, F.array().cast("array<string>")), " ")
