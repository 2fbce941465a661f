"""Quality rules per document and per host, in DataFrame functions only.

Word and line counts of every whole text give a base rule per document.
Rule failures are then aggregated by host (the domain that a document came
from), each host's failure rates are shrunk with a beta prior estimated from
all hosts, and a host whose shrunk rate passes a rule's limit is rejected with
all its documents.

Defined cases: a null text has no words (it fails the base rule); a document
with a null host is judged by the base rule alone; repeated rows count once
each; an empty table gives an empty result; other columns pass through
``filter_documents`` untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WS, prepare, written

#: Words in a window, and the base rule's limits.
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

#: Rules counted per host: (name, condition that a document fails it, highest
#: shrunk failure rate that a host may have).
HOST_RULES = (
    ("base", "base_failed", 0.8),
    ("symbols", "n_symbols > 0.1 * n_words", 0.8),
    ("dup_lines", "n_dup_lines > 0.3 * n_lines", 0.8),
    ("word_length", "n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 20 * n_words)", 0.8),
)
#: Bounds of the prior's strength (pseudo-documents a host starts with).
STRENGTH = (2.0, 1000.0)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def _clean_names(df: DataFrame, text: Column) -> DataFrame:
    return df.withColumn("__text", F.coalesce(text.cast("string"), F.lit("")))


def with_counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` plus the counts of its texts as long columns (see ``COUNTS``).
    Working columns start with ``__``; the counts must not be columns yet."""
    if clash := {*COUNTS, "base_failed"} & set(df.columns):
        raise ValueError(f"columns exist already: {sorted(clash)}")
    d = _clean_names(df, F.col(text_col))
    d = d.withColumn("__words", F.expr(rf"filter(split(__text, '[{_sql(WS)}]+'), w -> w != '')"))
    d = d.withColumn("__lines", F.expr(rf"filter(split(__text, '\n'), l -> l rlike '[^{_sql(WS)}]')"))
    # the hash of each window of words, at its first word's place
    d = d.withColumn("__hashes", F.expr(
        f"if(size(__words) < {WINDOW}, array(), transform(sequence(1, size(__words) - {WINDOW - 1}), i -> xxhash64(slice(__words, i, {WINDOW}))))"))
    # where no window repeats, nothing is sorted
    d = d.withColumn("__sorted", F.expr(
        "if(size(array_distinct(__hashes)) = size(__hashes), array(), array_sort(transform(__hashes, (h, i) -> struct(h, i))))"))
    d = d.withColumn("__starts", F.expr(
        "array_sort(array_distinct(flatten(zip_with(__sorted, slice(__sorted, 2, greatest(size(__sorted), 1)), "
        "(a, b) -> if(a.h = b.h, array(a.i, b.i), array())))))"))
    d = d.withColumn("n_repeat_words", F.expr(
        f"aggregate(__starts, named_struct('n', 0L, 'to', 0), (s, p) -> named_struct('n', s.n + p + {WINDOW} - greatest(s.to, p), 'to', p + {WINDOW}), s -> s.n)"))
    d = d.withColumns({
        "n_words": F.expr("cast(size(__words) as long)"),
        "word_chars": F.expr("aggregate(__words, 0L, (n, w) -> n + length(w))"),
        "n_symbols": F.expr("cast(length(__text) - length(translate(__text, '#*$%&|<>', '')) as long)"),
        "n_lines": F.expr("cast(size(__lines) as long)"),
        "n_dup_lines": F.expr("cast(size(__lines) - size(array_distinct(__lines)) as long)"),
    })
    d = d.withColumn("base_failed", F.expr(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"))
    return d.select(*df.columns, *COUNTS, "base_failed")


def _sql(regex: str) -> str:
    """A regular expression inside an SQL string literal."""
    return regex.replace("\\", "\\\\")


def rejected_hosts(counted: DataFrame, host_col: str = "source") -> DataFrame:
    """Hosts whose shrunk failure rate passes a rule's limit: one column,
    ``host_col``.  ``counted`` has the columns of ``with_counts``.

    The prior of a rule is Beta(m * s, (1 - m) * s): m is the failure rate of
    all documents, and s matches the variance of the hosts' rates."""
    fails = [F.sum(F.expr(cond).cast("long")).alias(f"k_{name}") for name, cond, _ in HOST_RULES]
    hosts = written(counted.filter(F.col(host_col).isNotNull()).groupBy(host_col).agg(F.count("*").alias("n"), *fails), "hosts")
    moments = []
    for name, _, _ in HOST_RULES:
        moments += [F.sum(f"k_{name}").alias(f"k_{name}"), F.var_pop(F.col(f"k_{name}") / F.col("n")).alias(f"v_{name}")]
    all_hosts = hosts.agg(F.sum("n").alias("n"), *moments).first()
    bad = F.lit(False)
    for name, _, limit in HOST_RULES:
        mean = (all_hosts[f"k_{name}"] or 0) / (all_hosts["n"] or 1)
        var = all_hosts[f"v_{name}"] or 0.0
        strength = min(max(mean * (1 - mean) / var - 1, STRENGTH[0]), STRENGTH[1]) if var > 0 else STRENGTH[1]
        rate = (F.col(f"k_{name}") + F.lit(mean * strength)) / (F.col("n") + F.lit(strength))
        bad = bad | (rate > limit)
    return hosts.filter(bad).select(host_col)


def quality_verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """One row per document: its id, the counts, base_failed and kept."""
    prepare(docs.sparkSession)
    counted = written(with_counts(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(host_col).alias("source"))).drop("text"), "quality")
    bad = rejected_hosts(counted).withColumn("host_rejected", F.lit(True))
    return (counted.join(bad, "source", "left")
            .withColumn("kept", ~F.col("base_failed") & F.col("host_rejected").isNull())
            .select("doc_id", *COUNTS, "base_failed", "kept"))


def filter_documents(docs: DataFrame, text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that pass, with their columns.  The counts are
    made once for the hosts and once while filtering, so that no text moves."""
    prepare(docs.sparkSession)
    hosts = rejected_hosts(with_counts(docs.select(F.col(text_col).alias("text"), F.col(host_col).alias("source"))).drop("text"))
    probe = with_counts(docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("__row"), F.col(text_col).alias("text"), F.col(host_col).alias("source")))
    # the row number keeps the filter above the counts: pushed down, it would
    # be a copy of all their expressions inside each other
    probe = probe.withColumn("__at", F.monotonically_increasing_id())
    return probe.filter(~F.col("base_failed") & (F.col("__at") >= 0)).join(hosts, "source", "left_anti").select("__row.*")


ORACLE = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS win FROM w, unnest(range(1, len(words) - 6)) AS t(i)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM g) WHERE n > 1),
c AS (SELECT doc_id, sum(least(8, coalesce(nxt - i, 8))) AS n FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM r) GROUP BY 1),
k AS (SELECT w.doc_id, source, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
  len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
  (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN c ON c.doc_id = w.doc_id),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM k),
h AS (SELECT source, count(*) AS n, sum(base_failed::INT) AS k1, sum((n_symbols > 0.1 * n_words)::INT) AS k2,
  sum((n_dup_lines > 0.3 * n_lines)::INT) AS k3, sum((n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 20 * n_words))::INT) AS k4
  FROM b WHERE source IS NOT NULL GROUP BY 1),
u AS (SELECT source, n, unnest([k1, k2, k3, k4]) AS k, unnest([1, 2, 3, 4]) AS rule, unnest([0.8, 0.8, 0.8, 0.8]) AS lim FROM h),
p AS (SELECT rule, sum(k)::DOUBLE / sum(n) AS m, var_pop(k::DOUBLE / n) AS v FROM u GROUP BY 1),
s AS (SELECT rule, m, CASE WHEN v > 0 THEN least(greatest(m * (1 - m) / v - 1, 2), 1000) ELSE 1000 END AS s FROM p),
bad AS (SELECT DISTINCT u.source FROM u JOIN s USING (rule) WHERE (k + m * s) / (n + s) > lim)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(source NOT IN (SELECT source FROM bad), TRUE) AS kept FROM b
"""
