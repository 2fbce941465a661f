"""URL filters: rules first, then gradient-boosted trees on lexical features,
in DataFrame functions and Spark ML (JVM) only.

A rule names a host (it holds for all subdomains) and a path prefix; the
longest rule that fits a URL decides.  URLs that no rule fits are judged by
boosted trees over lexical features of the whole URL: lengths, depth, digit
ratio, character entropy, parameter counts and statistics of the host's
suffixes.  The trees are trained on labelled URLs: those that a rule decides,
unless labels are given.

Defined cases: a URL that is null or has no ``://`` has an empty host and path,
fits no rule and is judged by its features like any other; if the labelled
URLs name one verdict only, that verdict is given to the rest, and ``allow``
if there are none; rules of equal length go by their text; repeated rows keep a
row each; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare, written

#: (verdict, host/path prefix)
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))

#: Bound of the training sample, and the trees.
SAMPLE_ROWS, TREES, DEPTH, STEP = 20_000, 12, 4, 0.2
#: Pseudo-observations that a suffix's block rate starts with.
SUFFIX_PRIOR = 20.0

_FOLD = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
FEATURES = ("f_length", "f_host_length", "f_labels", "f_depth", "f_path_length", "f_digits", "f_entropy", "f_params", "f_query_length",
            "f_hyphens", "f_longest_part", "f_fragment", "f_secure", "f_suffix_share", "f_suffix_block", "f_domain_share", "f_domain_block")


def _after(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, url.substr(at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    raw = F.regexp_extract(_after(url), r"^[^/?#]*", 0)
    return F.coalesce(F.translate(raw, *_FOLD), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        at = text.index("/")
        fits = ((host == text[:at]) | host.endswith("." + text[:at])) & path.startswith(text[at:])
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def _entropy(text: str) -> str:
    """SQL for the entropy of the characters of the string column ``text``."""
    return (f"aggregate(transform(array_distinct(split({text}, '')), c -> (length({text}) - length(replace({text}, c, ''))) / length({text})), "
            "0D, (s, p) -> s - if(p > 0, p * log2(p), 0D))")


def with_suffixes(df: DataFrame) -> DataFrame:
    """``df`` (__host) plus the host's last label and its last two."""
    labels = F.split("__host", r"\.")
    return df.withColumns({
        "__suffix": F.element_at(labels, -1),
        "__domain": F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), "."),
    })


def with_lexical(df: DataFrame) -> DataFrame:
    """``df`` (__url, __host, __path) plus the features that one URL gives."""
    d = with_suffixes(df).withColumn("__u", F.coalesce("__url", F.lit("")))
    n = F.length("__u")
    query = F.regexp_extract("__u", r"\?([^#]*)", 1)
    labels = F.split("__host", r"\.")
    return d.withColumns({
        "f_length": n.cast("double"),
        "f_host_length": F.length("__host").cast("double"),
        "f_labels": F.when(F.col("__host") == "", 0).otherwise(F.size(labels)).cast("double"),
        "f_depth": F.size(F.filter(F.split("__path", "/"), lambda p: p != "")).cast("double"),
        "f_path_length": F.length("__path").cast("double"),
        "f_digits": F.when(n > 0, (n - F.length(F.translate("__u", "0123456789", ""))) / n).otherwise(0.0),
        "f_entropy": F.when(n > 0, F.expr(_entropy("__u"))).otherwise(0.0),
        "f_params": F.size(F.filter(F.split(query, "&"), lambda p: p != "")).cast("double"),
        "f_query_length": F.length(query).cast("double"),
        "f_hyphens": (n - F.length(F.translate("__u", "-_", ""))).cast("double"),
        "f_longest_part": F.coalesce(F.array_max(F.transform(F.split("__u", "[/.?&=#-]"), lambda p: F.length(p))), F.lit(0)).cast("double"),
        "f_fragment": F.col("__u").contains("#").cast("double"),
        "f_secure": F.col("__u").startswith("https:").cast("double"),
    }).drop("__u")


def _statistics(known: DataFrame, key: str, name: str, n: int, rate: float) -> DataFrame:
    """For each value of ``key``: its share of all ``n`` labelled URLs, and the
    rate at which they are blocked, shrunk to the overall rate.  All labelled
    URLs count; tasks pre-aggregate theirs, so a hot host is a row of each."""
    counts = known.groupBy(key).agg(F.count("*").alias("n"), F.sum("label").alias("k"))
    return counts.select(key, (F.col("n") / F.lit(float(n))).alias(f"f_{name}_share"),
                         ((F.col("k") + SUFFIX_PRIOR * rate) / (F.col("n") + SUFFIX_PRIOR)).alias(f"f_{name}_block"))


def _sample(known: DataFrame, n: int, rows: int) -> DataFrame:
    """About ``rows`` of the ``n`` labelled rows.  A URL in c rows stays in
    c * rows / n of them, rounded up or down by its hash: copies neither go in
    nor stay out together."""
    share = min(1.0, rows / n)
    urls = known.groupBy("__url", "__host", "__path", "label").agg(F.count("*").alias("__c"))
    # for a URL in one row: those whose text hashes lowest
    low = (F.lit(float(2**63)) - F.xxhash64("__url", F.lit("sample")).cast("double")) / F.lit(float(2**64))
    urls = urls.withColumn("__c", F.floor(F.col("__c") * F.lit(share) + F.least(low, F.lit(1.0 - 2**-53))).cast("int")).filter("__c > 0")
    picked = urls.orderBy(F.xxhash64("__url", F.lit("sample")), "__url", "label").limit(2 * rows)
    return picked.withColumn("__c", F.explode(F.array_repeat(F.lit(0), F.col("__c")))).drop("__c")


def _with_statistics(df: DataFrame, stats: dict[str, tuple[DataFrame, float]]) -> DataFrame:
    for name, (table, rate) in stats.items():
        df = df.join(table, f"__{name}", "left").fillna({f"f_{name}_share": 0.0, f"f_{name}_block": rate})
    return df


def judge(pages: DataFrame, url_col: str = "url", rules=RULES, labels: DataFrame | None = None, label_url_col: str = "url",
          sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``pages`` plus host, path, rule and verdict.  ``labels`` (url, blocked
    boolean) trains the trees in place of the URLs that a rule decides."""
    spark = pages.sparkSession
    prepare(spark)
    if clash := {"host", "path", "rule", "verdict"} & set(pages.columns):
        raise ValueError(f"columns exist already: {sorted(clash)}")
    url = F.col(url_col).cast("string")
    rule, verdict = rule_of(host_of(url), path_of(url), rules)
    judged = pages.withColumns({"host": host_of(url), "path": path_of(url), "rule": rule, "__by_rule": verdict})
    if labels is None:
        known = judged.filter("__by_rule is not null").select(url.alias("__url"), F.col("host").alias("__host"), F.col("path").alias("__path"),
                                                             (F.col("__by_rule") == "block").cast("double").alias("label"))
    else:
        given = F.col(label_url_col).cast("string")
        known = labels.filter(F.col("blocked").isNotNull()).select(given.alias("__url"), host_of(given).alias("__host"), path_of(given).alias("__path"), F.col("blocked").cast("double").alias("label"))
    counts = known.agg(F.count("*"), F.sum("label")).first()
    n, blocked = counts[0], counts[1] or 0.0
    if blocked in (0.0, float(n)):
        rest = F.lit("block" if n and blocked else "allow")
        return judged.withColumn("verdict", F.coalesce("__by_rule", rest)).drop("__by_rule")
    sample = written(with_lexical(_sample(known, n, sample_rows)), "url-sample")
    rate = blocked / n
    stats = {}
    for name in ("suffix", "domain"):
        stats[name] = (written(_statistics(with_suffixes(known), f"__{name}", name, n, rate), f"url-{name}"), rate)
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="__features")
    trees = GBTClassifier(featuresCol="__features", labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=7, predictionCol="__prediction", maxBins=64)
    train = written(assembler.transform(_with_statistics(sample, stats)).select("__features", "label").coalesce(4), "url-train")
    model = trees.fit(train)
    # only URLs that no rule decides need the trees
    packed = judged.select(F.struct(*judged.columns).alias("__row"), url.alias("__url"), F.col("host").alias("__host"), F.col("path").alias("__path"))
    open_ = _with_statistics(with_lexical(packed.filter("__row.__by_rule is null")), stats)
    scored = model.transform(assembler.transform(open_)).withColumn("verdict", F.when(F.col("__prediction") == 1.0, "block").otherwise("allow"))
    decided = judged.filter("__by_rule is not null").withColumn("verdict", F.col("__by_rule"))
    return scored.select("__row.*", "verdict").unionByName(decided).drop("__by_rule")
