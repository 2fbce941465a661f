"""Seeded orders without a sort (OP-O3).

A permutation of 0..n-1 is drawn as a keyed Feistel network over the smallest
even number of bits that holds n, with cycle walking: a number that leaves the
range is sent through the network again until it is back.  Both halves of the
network are invertible steps, so it permutes its whole domain, and walking along
its cycles permutes the range; no row looks at another one.

A row's number is all that an epoch's order needs, so the rows are numbered once
and every epoch is a pass over them that moves nothing.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordering import global_index

#: Steps of the network, and the prime (2^31 - 1) that they reckon by.
STEPS = 6
PRIME = 2147483647


def step_keys(seed: int, epoch: int) -> list[tuple[int, int]]:
    """(factor, term) of each step: from md5 of seed, epoch and step."""
    def number(step, tag):
        return int(hashlib.md5(f"feistel|{seed}|{epoch}|{step}|{tag}".encode()).hexdigest()[:8], 16) % (PRIME - 1) + 1
    return [(number(s, "a"), number(s, "b")) for s in range(STEPS)]


def half_bits(n: int) -> int:
    """Bits of one half: two halves hold 0..n-1."""
    return max(1, ((n - 1).bit_length() + 1) // 2)


def network(x: np.ndarray, keys: list[tuple[int, int]], half: int) -> np.ndarray:
    """The Feistel network over 2 * half bits."""
    mask = (1 << half) - 1
    left, right = x >> half, x & mask
    for a, b in keys:
        y = (right * a + b) % PRIME
        left, right = right, left ^ (y * y % PRIME & mask)
    return left << half | right


def permuted(x: np.ndarray, n: int, seed: int, epoch: int) -> np.ndarray:
    """The place of each number of 0..n-1 in the order of ``epoch``."""
    keys, half = step_keys(seed, epoch), half_bits(n)
    out = network(x.astype(np.int64), keys, half)
    while len(away := np.flatnonzero(out >= n)):
        out[away] = network(out[away], keys, half)
    return out


def epoch_positions(df: DataFrame, key_col: str, epochs: int, seed: int = 42) -> DataFrame:
    """OP-O3: (epoch, key, position): the place of every row in each epoch's
    order.  Rows are numbered by ``key_col``; equal keys get different numbers in
    an arbitrary order, so keys should be unique.  At most 2^62 rows."""
    numbered = global_index(df.select(key_col), [key_col], out_col="_g")
    n = numbered.count()
    kind = df.schema[key_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            at = batch.column("_g").to_numpy()
            for epoch in range(1, epochs + 1):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), epoch, np.int32)), batch.column(key_col), pa.array(permuted(at, n, seed, epoch))],
                                                 names=["epoch", key_col, "position"])

    return numbered.select(key_col, F.col("_g").cast("long").alias("_g")).mapInArrow(run, f"epoch int, `{key_col}` {kind}, position long")
