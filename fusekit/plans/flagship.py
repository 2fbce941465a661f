"""The end-to-end chain (OP-M10) on either route:

    manifest -> tokens -> text encoder job  ("text" route)  \\
                       -> word-vector sequences -> sequence
                          encoder job       ("sequence" route) fuse (join on image name)
    image features ----------------------------------------/
      -> standardise (fit on train) -> PCA (fit on train)
      -> SMOTE on train (kNN, seeded) -> MLP rounds, each scored on dev,
         the best one kept (OP-M6..M8)
      -> keyed predictions for the test split + dev metrics

Two lineage cuts: after fusion (the encoder job runs once) and after
reduction (SMOTE and training read it many times).  Both go to the shared
folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.arrays import to_array, to_vector
from ..operators.classify import evaluate, fit_rounds, model_log_loss, predict, training_input
from ..operators.scale import fit_pca, fit_scaler
from ..operators.smote import class_sizes, smote_balanced, smote_synthetic
from ..session import cut_lineage
from . import stages

# Rounds of the chain and optimiser iterations in each.  L-BFGS in every
# round, so that rounds are comparable; the step only matters to "gd".
ROUNDS = 6
ITERS_PER_ROUND = 15

ROUTES = {"text": stages.fused, "sequence": stages.fused_seq}


def run_chain(spark: SparkSession, sf_dir: str, k: int = stages.PCA_K, route: str = "text",
              rounds: int = ROUNDS, iters_per_round: int = ITERS_PER_ROUND, solver: str = "l-bfgs",
              knn_options: dict | None = None) -> dict:
    fused = cut_lineage(ROUTES[route](spark, sf_dir).select("filename", "split", "label", "features_vector"), spark)
    train = fused.where(F.col("split") == "train")
    scaler = fit_scaler(train)
    scaled = scaler.transform(fused)
    pca = fit_pca(scaled.where(F.col("split") == "train"), k)
    reduced = cut_lineage(pca.transform(scaled).select(
        "filename", "split", "label", F.col("pca_features").alias("features")), spark)

    tr = reduced.where(F.col("split") == "train").select(
        "filename", "label", to_array(F.col("features")).alias("x"))
    balanced = smote_balanced(tr, smote_synthetic(tr, id_col="filename", vec_col="x", knn_options=knn_options))
    # balanced classes: the row count is known, so nothing is computed to count it
    balanced = training_input(balanced.select(to_vector(F.col("features")).alias("features"), "label"),
                              rows=2 * max(class_sizes(tr).values()))

    dev = reduced.where((F.col("split") == "dev") & F.col("label").isNotNull())
    model, metrics = fit_rounds(balanced, dev, k, rounds, iters_per_round, solver=solver)
    preds = predict(model, reduced.where(F.col("split") == "test"))
    scored = model.transform(dev)
    dev_metrics = evaluate(scored.withColumn("predicted_label", F.col("prediction").cast("int"))
                           .withColumn("loss", model_log_loss(scored)))
    return {"predictions": preds, "dev_metrics": dev_metrics, "round_metrics": metrics, "scaler": scaler, "pca": pca,
            "model": model, "balanced": balanced}


def run(spark: SparkSession, sf_dir: str, route: str = "text") -> DataFrame:
    """Flagship: keyed test predictions of the whole chain."""
    return run_chain(spark, sf_dir, route=route)["predictions"]


def run_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linear baseline on the text route: class-weighted, L2-regularised logistic
    regression on the standardised features, no oversampling."""
    from ..operators.classify import fit_linear
    from ..operators.labels import attach_weights, class_weights
    fused = stages.fused_table(spark, sf_dir).select("filename", "split", "label", "features_vector")
    train = fused.where(F.col("split") == "train")
    scaler = fit_scaler(train, output_col="features")
    tr = training_input(attach_weights(scaler.transform(train), class_weights(train))
                        .select("features", "label", "weight"))
    model = fit_linear(tr, weight_col="weight")
    test = scaler.transform(fused.where(F.col("split") == "test"))
    return predict(model, test)
