"""Language identification with a byte convolutional network.

The network reads a window of ``WINDOW`` bytes: filters of several widths run
over its one-hot bytes, each keeps its largest response, and a softmax layer
turns them into languages.  It is trained in numpy on the driver, on a bounded
sample of labelled documents, and applied in the tasks to batches of windows
that cover every whole text.  A document's language is the one with the
largest mean probability over its windows.

A filter's response to a byte pair is a row of a table, so the convolution is
applied as two table look-ups and an addition per byte.

Defined cases: a text that is null or has no letter is ``und`` with score 0;
so is every text if no labelled row can be learned from; documents without a
label, and held-out ones, are never learned from; repeated rows keep a row
each; an empty table gives an empty result; a tie goes to the first language
in alphabetical order; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, python_bytes, slices, written

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
#: Bound of the training sample: documents of each language, windows of each.
SAMPLE_DOCS, SAMPLE_WINDOWS = 600, 3
EPOCHS, BATCH, RATE = 6, 64, 0.02
#: Windows that are scored at a time.
SCORED = 256

UNKNOWN = "und"


def has_letter(text: bytes) -> bool:
    """Whether a letter stands in a text (digits, number and other signs are none)."""
    return any(map(str.isalpha, text.decode("utf-8", "replace")))


class Network:
    """weights[width]: (width, 256, FILTERS); bias; out: (filters, languages)."""

    def __init__(self, langs: list[str], seed: int = 0):
        rng = np.random.default_rng(seed)
        self.langs = langs
        self.weights = {w: rng.normal(0, 0.3 / w, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS}
        for table in self.weights.values():
            table[:, 0] = 0  # padding says nothing
        n = FILTERS * len(WIDTHS)
        self.bias = np.zeros(n, np.float32)
        self.out = rng.normal(0, 0.3, (n, len(langs))).astype(np.float32)
        self.out_bias = np.zeros(len(langs), np.float32)
        self._tables = None

    def _responses(self, windows: np.ndarray) -> np.ndarray:
        """(windows, places, filters): windows are padded by 3 zero bytes."""
        n = windows.shape[1] - max(WIDTHS) + 1
        return np.concatenate([sum(t[k][windows[:, k:k + n]] for k in range(w)) for w, t in self.weights.items()], axis=2)

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Responses to the first two bytes of a place, and to the next two."""
        if self._tables is None:
            first, then = [], []
            for w, t in self.weights.items():
                first.append((t[0][:, None] + t[1][None]).reshape(65536, FILTERS))
                if w > 2:
                    then.append((t[2][:, None] + (t[3] if w > 3 else np.zeros_like(t[2]))[None]).reshape(65536, FILTERS))
            self._tables = np.concatenate(first, axis=1), np.concatenate(then, axis=1)
        return self._tables

    def pooled(self, windows: np.ndarray) -> np.ndarray:
        """The largest response of each filter, by the tables."""
        first, then = self.tables()
        pair = (windows[:, :-1].astype(np.int32) << 8) | windows[:, 1:]
        both = first[pair[:, :-2]]
        both[:, :, FILTERS:] += then[pair[:, 2:]]
        return both.max(axis=1)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        return softmax(np.maximum(self.pooled(windows) + self.bias, 0) @ self.out + self.out_bias)

    def train(self, windows: np.ndarray, labels: np.ndarray, seed: int = 0) -> None:
        """Cross-entropy by Adam over shuffled batches."""
        rng = np.random.default_rng(seed)
        params = [*self.weights.values(), self.bias, self.out, self.out_bias]
        first, second, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(windows))
            for at in range(0, len(order), BATCH):
                grads = self._gradients(windows[order[at:at + BATCH]], labels[order[at:at + BATCH]])
                t += 1
                for p, g, m, v in zip(params, grads, first, second):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        self._tables = None

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        conv = self._responses(x)
        where = conv.argmax(axis=1)
        top = np.take_along_axis(conv, where[:, None], axis=1)[:, 0] + self.bias
        hidden = np.maximum(top, 0)
        d = softmax(hidden @ self.out + self.out_bias)
        d[np.arange(len(y)), y] -= 1
        d /= len(y)
        back = (d @ self.out.T) * (top > 0)
        grads, rows = [], np.arange(len(x))[:, None]
        for n, w in enumerate(self.weights):
            cols = slice(n * FILTERS, (n + 1) * FILTERS)
            g = np.zeros((w, 256, FILTERS), np.float32)
            for k in range(w):
                np.add.at(g[k], (x[rows, where[:, cols] + k], np.arange(FILTERS)[None]), back[:, cols])
            g[:, 0] = 0
            grads.append(g)
        return [*grads, back.sum(axis=0), hidden.T @ d, d.sum(axis=0)]


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=-1, keepdims=True))
    return x / x.sum(axis=-1, keepdims=True)


def windows_of(text: bytes) -> np.ndarray:
    """Windows that cover ``text`` (WINDOW bytes each, the next three bytes
    after them so that every place is seen, zeros after the end)."""
    n = max(1, -(-len(text) // WINDOW))
    flat = np.zeros(n * WINDOW + 3, np.uint8)
    flat[:len(text)] = np.frombuffer(text, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(flat, WINDOW + 3)[::WINDOW]


def held_out(id_col: Column) -> Column:
    """Documents that are never learned from: crc32 of the id as text."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_windows(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> list:
    """(lang, window) rows: at most SAMPLE_DOCS distinct texts of each language,
    the ones whose hash is lowest, and SAMPLE_WINDOWS windows of each, at hashed
    places of the whole text.  Texts are drawn, not ids, so neither rows without
    an id nor an id or a text that many rows share crowd out others."""
    rows = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~held_out(F.col(id_col)))
    rows = rows.select(F.col(lang_col).alias("lang"), F.col(text_col).cast("binary").alias("b")).withColumn("o", F.xxhash64("b"))
    ranked = rows.select("lang", "o").distinct().withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("o")))
    # written, so that Spark knows its size and sends it to the texts while it is small
    chosen = written(ranked.filter(F.col("r") <= SAMPLE_DOCS).drop("r"), "language-sample")
    places = F.explode(F.sequence(F.lit(1), F.lit(SAMPLE_WINDOWS)))
    picked = (rows.join(chosen, ["lang", "o"]).select("o", "lang", "b", places.alias("k"))
              .withColumn("at", F.expr(f"1 + pmod(xxhash64(o, k), greatest(octet_length(b) - {WINDOW} + 1, 1))"))
              .select("o", "lang", "k", F.expr(f"substring(b, cast(at as int), {WINDOW} + 3)").alias("window")))
    # copies of a text have the same windows
    return picked.groupBy("o", "lang", "k").agg(F.first("window").alias("window")).orderBy("o", "lang", "k").collect()


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Network | None:
    """The network learned from labelled rows that are not held out."""
    rows = training_windows(docs, id_col, text_col, lang_col)
    if not rows:
        return None
    langs = sorted({r["lang"] for r in rows})
    net = Network(langs)
    x = np.zeros((len(rows), WINDOW + 3), np.uint8)
    rng = np.random.default_rng(1)
    for i, r in enumerate(rows):
        # short windows too: most short texts fill one only in part
        n = len(r["window"]) if i % 2 else int(rng.integers(min(8, len(r["window"])), len(r["window"]) + 1))
        x[i, :n] = np.frombuffer(r["window"][:n], np.uint8)
    y = np.array([langs.index(r["lang"]) for r in rows])
    # languages weigh the same however many windows they have
    share = np.bincount(y)
    again = np.concatenate([np.flatnonzero(y == k)[np.arange(share.max()) % share[k]] for k in range(len(langs))])
    net.train(x[again], y[again])
    return net


def classify(net: Network, texts: list[bytes]) -> tuple[list[str], list[float]]:
    """Language and score of each text."""
    alive = [i for i, t in enumerate(texts) if t and has_letter(t)]
    cut = [windows_of(texts[i]) for i in alive]
    owner = np.repeat(np.arange(len(alive)), [len(c) for c in cut])
    total = np.zeros((len(alive), len(net.langs)))
    if alive:
        flat = np.concatenate(cut)
        for at in range(0, len(flat), SCORED):
            np.add.at(total, owner[at:at + SCORED], net.probabilities(flat[at:at + SCORED]))
    langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    for i, p in zip(alive, total / np.maximum(np.bincount(owner, minlength=len(alive)), 1)[:, None]):
        best = int(p.argmax())
        langs[i], scores[i] = net.langs[best], min(1.0, float(p[best]))
    return langs, scores


def identify(docs: DataFrame, net: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred and score."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).cast("binary").alias("text"))
    if net is None:
        return rows.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    net._tables = None
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def score(batches):
        model = shared.value
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                langs, scores = classify(model, python_bytes(part.column("text")))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                                 names=["doc_id", "held_out", "lang_pred", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(score, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
