"""Seeded, engine-independent draws.

Every "random" choice in the library (split assignment, SMOTE draws, epoch
shuffles, derived test vectors) is a pure function of a text key, so any
partitioning, any retry and any engine gives the same numbers.  The rule
is: first 8 hex digits of md5(key) read as an unsigned 32-bit integer,
divided by 2^32, giving a double in [0, 1).  The same rule in DuckDB is
``('0x' || substr(md5(key), 1, 8))::BIGINT / 4294967296.0``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32 = 4294967296.0


def _as_str(c) -> Column:
    if isinstance(c, Column):
        return c.cast("string")
    return F.lit(str(c))


def hash_key(*parts) -> Column:
    """``parts`` joined with '|' (columns cast to string)."""
    return F.concat_ws("|", *[_as_str(p) for p in parts])


def hash_u32(key: Column) -> Column:
    """Unsigned 32-bit integer from the first 8 hex digits of md5(key)."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")


def unit_draw(*parts) -> Column:
    """Uniform double in [0, 1) keyed by ``parts``."""
    return hash_u32(hash_key(*parts)) / F.lit(TWO_POW_32)


def order_key(*parts) -> Column:
    """A 60-bit sort key keyed by ``parts`` (first 15 hex digits of md5)."""
    return F.conv(F.substring(F.md5(hash_key(*parts)), 1, 15), 16, 10).cast("bigint")
