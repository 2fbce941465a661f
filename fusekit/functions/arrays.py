"""Array, vector and path expressions (replacing the reference's Python UDFs
with JVM-side built-ins so whole-stage codegen is not broken up)."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def basename(path: Column) -> Column:
    """OP-F1: last path component; a trailing slash gives ''."""
    return F.regexp_extract(path, r"[^/]*$", 0)


def image_name(id_col: Column) -> Column:
    """File name of a post's image: id zero-padded to at least 5 digits
    (never truncated, unlike lpad) plus '.png'."""
    return F.format_string("%05d.png", id_col)


def concat_features(first: Column, second: Column) -> Column:
    """OP-F3: image vector first, then the text/sequence vector.  A null
    side gives null (the caller asserts on it)."""
    return F.concat(first, second)


def to_vector(arr: Column) -> Column:
    """OP-F4: array<float|double> -> ML dense vector (float widened)."""
    return array_to_vector(arr)


def to_array(vec: Column) -> Column:
    """OP-F5: ML vector -> array<double>, kept in the same row as its key."""
    return vector_to_array(vec, "float64")


def fix_width(arr: Column, width: int, element_type: str = "float") -> Column:
    """OP-F6: cut or zero-pad to exactly ``width`` elements."""
    zero = F.lit(0.0).cast(element_type)
    return F.slice(F.concat(arr, F.array_repeat(zero, width)), 1, width)


def pad_rows(seq: Column, rows: int, dim: int) -> Column:
    """OP-F7: pad a list of vectors with zero vectors to exactly ``rows``."""
    zero_row = F.array_repeat(F.lit(0.0).cast("float"), dim)
    return F.slice(F.concat(seq, F.array_repeat(zero_row, rows)), 1, rows)


def array_sum(arr: Column) -> Column:
    """Sum of an array's elements as double, left to right."""
    return F.aggregate(arr, F.lit(0.0).cast("double"), lambda acc, x: acc + x.cast("double"))


def array_sumsq(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0).cast("double"),
                       lambda acc, x: acc + x.cast("double") * x.cast("double"))


def argmax_label(scores: Column) -> Column:
    """OP-O4: index of the largest score; ties go to the lowest class."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def weighted_sum(x: Column) -> Column:
    """Sum of position (from 1) x value: a checksum that order changes."""
    return F.aggregate(F.zip_with(x, F.sequence(F.lit(1), F.greatest(F.size(x), F.lit(1))),
                                  lambda v, i: v.cast("double") * i),
                       F.lit(0.0).cast("double"), lambda acc, v: acc + F.coalesce(v, F.lit(0.0)))


def vector_width(df: DataFrame, col: str) -> int:
    """The width of the arrays in ``col`` (0 without rows); rows of different
    widths are an error."""
    low, high = df.agg(F.min(F.size(col)), F.max(F.size(col))).first()
    if low != high:
        raise ValueError(f"{col} holds vectors of {low} to {high} numbers")
    return high or 0
