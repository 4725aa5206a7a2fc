"""MLlib estimators, epoch loops and parameter search.

The reference trains with single-machine tensor and linear-model libraries.
Here MLlib fits the models on distributed feature rows; the driver only runs
the outer loop (epochs, trials), each step being a distributed fit or
evaluation.  Loss and accuracy of an epoch are Spark aggregates.
"""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.ml.classification import (LinearSVC, LogisticRegression,
                                       MultilayerPerceptronClassifier,
                                       OneVsRest)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def vector_rows(df: DataFrame, array_col: str, label: str = "label",
                features: str = "features") -> DataFrame:
    """Array features to ``VectorUDT`` and string labels to indices
    (``label_idx``, classes ordered alphabetically)."""
    return label_indices(df, label).withColumn(features,
                                               array_to_vector(array_col))


def label_indices(df: DataFrame, label: str = "label") -> DataFrame:
    idx = StringIndexer(inputCol=label, outputCol="label_idx",
                        stringOrderType="alphabetAsc").fit(df)
    return idx.transform(df)


def linear_svm(train: DataFrame, reg: float | None = None,
               max_iter: int = 100):
    """M2: one-vs-rest linear SVM (hinge loss, L2 with C = 1: ``reg`` = 1 / n
    by default, features as they are)."""
    reg = 1.0 / train.count() if reg is None else reg
    svc = LinearSVC(regParam=reg, maxIter=max_iter, labelCol="label_idx",
                    standardization=False)
    return OneVsRest(classifier=svc, labelCol="label_idx",
                     parallelism=4).fit(train)


def logreg(train: DataFrame, reg: float | None = None, max_iter: int = 100,
           weight_col: str | None = None):
    """M3: multinomial logistic regression (L2 with C = 1: ``reg`` = 1 / n by
    default, features as they are)."""
    reg = 1.0 / train.count() if reg is None else reg
    lr = LogisticRegression(family="multinomial", labelCol="label_idx",
                            regParam=reg, maxIter=max_iter,
                            standardization=False)
    if weight_col:
        lr.setWeightCol(weight_col)
    return lr.fit(train)


def mlp(train: DataFrame, layers: Sequence[int], max_iter: int = 100,
        seed: int = 42, solver: str = "l-bfgs", step: float = 0.03,
        initial_weights=None):
    """M5: feed-forward net (sigmoid hidden layers, softmax output)."""
    m = MultilayerPerceptronClassifier(layers=list(layers), maxIter=max_iter,
                                       seed=seed, solver=solver,
                                       stepSize=step, labelCol="label_idx")
    if initial_weights is not None:
        m.setInitialWeights(initial_weights)
    return m.fit(train)


def scored(model, df: DataFrame) -> DataFrame:
    """M8: ``prediction`` and ``p_label`` (probability of the true class)."""
    out = model.transform(df)
    if "probability" in out.columns:
        out = out.withColumn("p_label", F.get(
            vector_to_array("probability"), F.col("label_idx").cast("int")))
    return out


def epoch_metrics(model, df: DataFrame, split: str = "split"
                  ) -> dict[str, tuple[float, float]]:
    """Cross-entropy and accuracy of every split as one aggregation."""
    s = scored(model, df).groupBy(split).agg(
        F.avg(-F.log(F.greatest(F.col("p_label"), F.lit(1e-15)))).alias("l"),
        F.avg((F.col("prediction") == F.col("label_idx")).cast("double"))
        .alias("a"))
    return {r[split]: (float(r["l"]), float(r["a"])) for r in s.collect()}


def training_curves(rows: DataFrame, layers: Sequence[int],
                    max_epochs: int = 100, patience: int = 20,
                    step: float = 0.5, plateau_factor: float = 0.5,
                    plateau_wait: int = 5, seed: int = 42):
    """Warm-started epochs of the feed-forward net.

    ``rows`` has ``split`` (train / val / test).  Each epoch is one
    distributed gradient-descent pass continuing from the previous weights.
    Training stops after ``patience`` epochs without a lower validation loss;
    the step size is lowered when the validation score (accuracy) stalls.
    Returns the curves ``(epoch, split, loss, accuracy, step, best)`` and the
    model of the best epoch.
    """
    train = rows.filter(F.col("split") == "train")
    out, weights, best_model = [], None, None
    best_loss, best_score, best_epoch = float("inf"), -1.0, 0
    since_gain = stall = 0
    for epoch in range(1, max_epochs + 1):
        model = mlp(train, layers, max_iter=1, seed=seed, solver="gd",
                    step=step, initial_weights=weights)
        weights = model.weights
        metrics = epoch_metrics(model, rows)
        out += [(epoch, n, loss, acc, step)
                for n, (loss, acc) in sorted(metrics.items())]
        val_loss, val_score = metrics["val"]
        if val_loss < best_loss:
            best_loss, best_epoch, best_model = val_loss, epoch, model
            since_gain = 0
        else:
            since_gain += 1
        if val_score > best_score:
            best_score, stall = val_score, 0
        else:
            stall += 1
            if stall >= plateau_wait:
                step *= plateau_factor
                stall = 0
        if since_gain >= patience:
            break
    curves = rows.sparkSession.createDataFrame(
        out, "epoch int, split string, loss double, accuracy double, "
             "step double")
    return (curves.withColumn("best", F.col("epoch") == F.lit(best_epoch)),
            best_model)


def search_params(trials: int = 30, seed: int = 42
                  ) -> list[tuple[float, float, int]]:
    """M9: seeded draws of (regularisation, elastic net, iterations)."""
    rnd = random.Random(seed)
    return [(10 ** rnd.uniform(-5, 0), rnd.uniform(0, 1),
             rnd.choice([25, 50, 100])) for _ in range(trials)]


def param_search(train: DataFrame, val: DataFrame, trials: int = 30,
                 seed: int = 42) -> DataFrame:
    """M9: random search of logistic-regression settings, F1 on the given
    validation rows; ``(trial, reg_param, elastic_net, max_iter, f1, best)``.
    """
    ev = MulticlassClassificationEvaluator(labelCol="label_idx",
                                           metricName="f1")
    res = []
    for i, (reg, enet, it) in enumerate(search_params(trials, seed), 1):
        lr = LogisticRegression(family="multinomial", labelCol="label_idx",
                                regParam=reg, elasticNetParam=enet,
                                maxIter=it, standardization=False)
        res.append((i, reg, enet, it,
                    float(ev.evaluate(lr.fit(train).transform(val)))))
    out = train.sparkSession.createDataFrame(
        res, "trial int, reg_param double, elastic_net double, max_iter int, "
             "f1 double")
    best = max(res, key=lambda r: (r[4], -r[0]))[0]
    return out.withColumn("best", F.col("trial") == best)
