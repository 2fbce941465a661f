"""Classifier training, selection, scoring and evaluation
(OP-M4..M9, OP-A7, OP-A8, OP-O3, OP-O4).

The reference pulls all three splits to the driver and trains a network
there.  Here training is Spark ML (data-parallel gradients over the
executors), scoring is ``model.transform`` (the key travels with the
row, no positional pairing), and every metric is one aggregate.

Round selection (OP-M6) and early stopping (OP-M7) work on a small table
of per-round dev metrics, so the same logic serves Spark ML rounds
(``fit_rounds``) and any externally produced round scores.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrays import argmax_label, to_array
from .permute import epoch_positions  # noqa: F401 (OP-O3 is part of training)

# Fixed values from the reference configuration: hidden layer widths,
# classes, patience on dev loss, plateau halving and the step floor.
HIDDEN = (256, 128)
N_CLASSES = 2
PATIENCE = 3
PLATEAU_ROUNDS = 2
PLATEAU_FACTOR = 0.5
MIN_STEP = 1e-6


# ------------------------------------------------------------ scoring
def dot(x: Column, w: Column) -> Column:
    return F.aggregate(F.zip_with(x, w, lambda a, b: a.cast("double") * b),
                       F.lit(0.0).cast("double"), lambda acc, v: acc + v)


def two_class_scores(margin: Column) -> Column:
    """Scores [0, margin] for classes 0 and 1."""
    return F.array(F.lit(0.0).cast("double"), margin)


def predicted_label(scores: Column) -> Column:
    """OP-O4: argmax of the class scores, ties to the lowest class."""
    return argmax_label(scores)


def log_loss_of(margin: Column, label: Column) -> Column:
    """-log softmax([0, margin])[label], numerically stable."""
    softplus = F.log1p(F.exp(-F.abs(margin))) + F.greatest(margin, F.lit(0.0))
    return softplus - label.cast("double") * margin


def evaluate(scored: DataFrame, label_col: str = "label", pred_col: str = "predicted_label",
             loss_col: str | None = "loss", by: list[str] | None = None) -> DataFrame:
    """OP-A7/A8: rows, correct, accuracy (percent) and mean loss, as one
    aggregate (optionally per group, e.g. per split or round).  Rows with a
    null label are not scored."""
    lab = scored.where(F.col(label_col).isNotNull())
    aggs = [F.count(F.lit(1)).cast("bigint").alias("n"),
            F.sum((F.col(pred_col) == F.col(label_col)).cast("bigint")).cast("bigint").alias("n_correct"),
            (F.avg((F.col(pred_col) == F.col(label_col)).cast("double")) * 100.0).alias("accuracy")]
    if loss_col:
        aggs.append(F.avg(F.col(loss_col)).alias("log_loss"))
    return lab.groupBy(*(by or [])).agg(*aggs)


def weighted_loss(scored: DataFrame, weights: DataFrame, label_col: str = "label",
                  loss_col: str = "loss", by: list[str] | None = None) -> DataFrame:
    """OP-A8, class-weighted: n and log_loss = sum(w * loss) / sum(w) over the
    labelled rows; ``weights`` is a ``class_weights`` table.  Rows of a class
    without a weight are not scored."""
    w = weights.select(F.col("label").alias(label_col), F.col("weight").alias("_w"))
    lab = scored.join(F.broadcast(w), label_col)  # one row per class
    return lab.groupBy(*(by or [])).agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                                        (F.sum(F.col(loss_col) * F.col("_w")) / F.sum("_w")).alias("log_loss"))


def model_log_loss(predictions: DataFrame, label_col: str = "label",
                   prob_col: str = "probability") -> Column:
    """Per-row loss of a Spark ML model: -log p[label] (clipped)."""
    p = F.element_at(to_array(F.col(prob_col)), F.col(label_col) + 1)
    return -F.log(F.greatest(p, F.lit(1e-15)))


# ------------------------------------------------------------ training
# Rows per task for iterative training input: every optimiser iteration is
# one pass over all partitions, so the training set is materialised once
# with partitions sized by its row count alone.
TRAIN_ROWS_PER_TASK = 8_000


def training_input(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Materialise an iterative-training input (lineage cut into the shared
    checkpoint folder) with ceil(rows / TRAIN_ROWS_PER_TASK) partitions,
    whatever the cluster's cores."""
    import math
    from ..session import cut_lineage
    spark = df.sparkSession
    rows = df.count() if rows is None else rows
    n = max(1, math.ceil(rows / TRAIN_ROWS_PER_TASK))
    return cut_lineage(df.repartition(n), spark)


def fit_mlp(train: DataFrame, input_dim: int, features_col: str = "features",
            label_col: str = "label", max_iter: int = 100, step: float = 0.03,
            seed: int = 42, solver: str = "l-bfgs", initial_weights=None):
    """OP-M4: feed-forward classifier input-256-128-2 (softmax output).
    Re-aimed: Spark's MLP has sigmoid hidden units and no dropout/decay."""
    mlp = MultilayerPerceptronClassifier(
        layers=[input_dim, *HIDDEN, N_CLASSES], featuresCol=features_col, labelCol=label_col,
        maxIter=max_iter, stepSize=step, seed=seed, solver=solver, blockSize=128)
    if initial_weights is not None:
        mlp.setInitialWeights(initial_weights)
    return mlp.fit(train)


def fit_linear(train: DataFrame, features_col: str = "features", label_col: str = "label",
               weight_col: str | None = "weight", reg: float = 0.1, max_iter: int = 100):
    """OP-M5: logistic regression with class weights and L2 (covers the
    reference's class_weight and weight decay, which the MLP lacks)."""
    lr = LogisticRegression(featuresCol=features_col, labelCol=label_col, regParam=reg,
                            elasticNetParam=0.0, maxIter=max_iter)
    if weight_col:
        lr.setWeightCol(weight_col)
    return lr.fit(train)


def predict(model, df: DataFrame, key: str = "filename") -> DataFrame:
    """OP-M9: (key, predicted_label) -- distributed, keyed."""
    return model.transform(df).select(key, F.col("prediction").cast("int").alias("predicted_label"))


def fit_rounds(train: DataFrame, dev: DataFrame, input_dim: int, rounds: int,
               iters_per_round: int = 10, step: float = 0.03, seed: int = 42,
               features_col: str = "features", label_col: str = "label",
               patience: int = PATIENCE, solver: str = "gd"):
    """OP-M6/M7/M8 with Spark ML: each round continues from the previous
    weights (``initialWeights``), is scored on dev, and the best round by
    accuracy (strictly greater, so the first wins; round 1 is always kept)
    is returned, together with the per-round metrics table.  The step
    size halves after ``PLATEAU_ROUNDS`` rounds without a dev-loss
    improvement (floor ``MIN_STEP``; the gradient-descent solver uses it) and
    training stops after ``patience`` such rounds.  Every round uses the same
    solver.  A dev split without labelled rows is an error."""
    spark = train.sparkSession
    best, best_acc, best_loss, since = None, -1.0, float("inf"), 0
    weights, rows = None, []
    for r in range(1, rounds + 1):
        model = fit_mlp(train, input_dim, features_col, label_col, max_iter=iters_per_round,
                        step=step, seed=seed, initial_weights=weights,
                        solver=solver)
        weights = model.weights
        pred = model.transform(dev)
        m = (pred.select((F.col("prediction") == F.col(label_col)).cast("double").alias("ok"),
                         model_log_loss(pred, label_col).alias("loss"))
             .agg(F.avg("ok").alias("acc"), F.avg("loss").alias("loss")).first())
        if m["acc"] is None or m["loss"] is None:
            raise ValueError("the dev split has no labelled rows to select a round on")
        acc, loss = float(m["acc"] * 100.0), float(m["loss"])
        rows.append((r, acc, loss, step))
        if best is None or acc > best_acc:
            best, best_acc = model, acc
        if loss < best_loss:
            best_loss, since = loss, 0
        else:
            since += 1
            if since % PLATEAU_ROUNDS == 0:
                step = max(step * PLATEAU_FACTOR, MIN_STEP)
            if since >= patience:
                break
    metrics = spark.createDataFrame(rows, "round int, dev_accuracy double, dev_log_loss double, step double")
    return best, metrics


# ------------------------------------------------------------ selection
def select_best_round(metrics: DataFrame, acc_col: str = "dev_accuracy") -> DataFrame:
    """OP-M6: mark the round with the highest dev accuracy; the first such
    round wins (strictly greater replaces).  Window over the few rounds."""
    w = Window.orderBy(F.desc(acc_col), F.asc("round"))
    return metrics.withColumn("is_best", (F.row_number().over(w) == 1).cast("int"))


def early_stop(metrics: DataFrame, patience: int = PATIENCE,
               loss_col: str = "dev_log_loss") -> DataFrame:
    """OP-M7: the round training stops at (first round with ``patience``
    rounds since the last strict dev-loss improvement; else the last round)
    and the restored round (lowest loss up to the stop, first on ties).
    Output: one row (stopped_round, restored_round, best_loss)."""
    order = Window.orderBy("round")
    run = order.rowsBetween(Window.unboundedPreceding, -1)
    m = metrics.withColumn("prev_best", F.min(loss_col).over(run))
    m = m.withColumn("improved", F.col("prev_best").isNull() | (F.col(loss_col) < F.col("prev_best")))
    m = m.withColumn("last_improved", F.max(F.when(F.col("improved"), F.col("round")))
                     .over(order.rowsBetween(Window.unboundedPreceding, 0)))
    m = m.withColumn("wait", F.col("round") - F.col("last_improved"))
    whole = Window.partitionBy()
    m = m.withColumn("stopped_round", F.coalesce(
        F.min(F.when(F.col("wait") >= patience, F.col("round"))).over(whole),
        F.max("round").over(whole)))
    upto = m.where(F.col("round") <= F.col("stopped_round"))
    best = Window.orderBy(F.asc(loss_col), F.asc("round"))
    return (upto.withColumn("_r", F.row_number().over(best)).where(F.col("_r") == 1)
            .select(F.col("stopped_round").cast("int").alias("stopped_round"),
                    F.col("round").cast("int").alias("restored_round"),
                    F.col(loss_col).alias("best_loss")))


def rule_weights(dim: int, seed) -> list[float]:
    """Weights of a fixed linear scoring rule, md5(w|seed|i) - 0.5: d numbers."""
    import hashlib
    out = []
    for i in range(dim):
        h = hashlib.md5(f"w|{seed}|{i}".encode()).hexdigest()[:8]
        out.append(int(h, 16) / 4294967296.0 - 0.5)
    return out


def weights_literal(weights) -> Column:
    return F.array(*[F.lit(float(w)).cast("double") for w in weights])


def score_rule(df: DataFrame, x_col: str, weights) -> DataFrame:
    """Apply a fixed linear rule: adds margin, scores, predicted_label, loss."""
    margin = dot(F.col(x_col), weights_literal(weights))
    out = df.withColumn("margin", margin)
    out = out.withColumn("scores", two_class_scores(F.col("margin")))
    out = out.withColumn("predicted_label", predicted_label(F.col("scores")))
    if "label" in df.columns:
        out = out.withColumn("loss", log_loss_of(F.col("margin"), F.col("label")))
    return out


def round_metrics(dev: DataFrame, x_col: str, dim: int, rounds: int) -> DataFrame:
    """Per-round dev metrics of rounds 1..R (round r = rule with seed r):
    the dev rows are expanded by round (a generator, not a join) and
    scored against a literal R x d weight table."""
    table = F.array(*[weights_literal(rule_weights(dim, r)) for r in range(1, rounds + 1)])
    ex = dev.withColumn("round", F.explode(F.sequence(F.lit(1), F.lit(rounds))))
    margin = dot(F.col(x_col), F.element_at(table, F.col("round")))
    ex = (ex.withColumn("margin", margin)
          .withColumn("predicted_label", predicted_label(two_class_scores(F.col("margin"))))
          .withColumn("loss", log_loss_of(F.col("margin"), F.col("label"))))
    ev = evaluate(ex, by=["round"])
    return ev.select(F.col("round").cast("int").alias("round"),
                     F.col("accuracy").alias("dev_accuracy"), F.col("log_loss").alias("dev_log_loss"))
