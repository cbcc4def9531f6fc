"""Models on Spark ML, with splits and folds fixed by hash so that reruns agree."""

from __future__ import annotations

import math
from collections.abc import Callable
from multiprocessing.pool import ThreadPool
from typing import Any

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.operators.clustering import best_centres, nearest_of
from gridloom.operators.metrics import running
from gridloom.operators.refits import refit_scores
from gridloom.operators.validation import cluster_scores, hash_number
from gridloom.plans.lineage import cut, dropped, stored


#: Fits that run at a time.
AT_ONCE = 4


def assembled(df: DataFrame, columns: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="skip").transform(df)


def balanced(df: DataFrame, label: str) -> DataFrame:
    """A weight per row that makes labels count alike."""
    n = df.groupBy(label).agg(F.count("*").alias("__n"))
    share = F.sum("__n").over(Window.partitionBy()) / (F.col("__n") * F.count("*").over(Window.partitionBy()))
    return df.join(F.broadcast(n.select(label, share.alias("weight"))), label)


def checked_parameters(**given: float) -> None:
    """Numbers of trees, depths, folds, members and repeats are 1 or more; shares are above 0 and up to 1."""
    for name, value in given.items():
        if name.endswith("share") and not 0 < value <= 1:
            raise ValueError(f"{name} must be above 0 and at most 1")
        if not name.endswith("share") and value < 1:
            raise ValueError(f"{name} must be 1 or more")


def random_forest(df: DataFrame, columns: list[str], label: str, trees: int = 100, depth: int = 10, seed: int = 42) -> DataFrame:
    """``probability`` of label 1 and ``predicted`` of a forest in which labels count alike; a missing column is an error."""
    checked_parameters(trees=trees, depth=depth)
    data = assembled(balanced(df, label), columns)
    model = RandomForestClassifier(labelCol=label, weightCol="weight", numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt").fit(data)
    out = model.transform(data)
    return out.withColumn("probability", vector_to_array("probability")[1]).withColumn("predicted", F.col("prediction").cast("int"))


def forest_importances(df: DataFrame, columns: list[str], label: str, trees: int = 100, depth: int = 10, seed: int = 42) -> DataFrame:
    """(feature, importance, rank, cumulative) of the forest of ``random_forest``; importances sum to one."""
    checked_parameters(trees=trees, depth=depth)
    data = assembled(balanced(df, label), columns)
    model = RandomForestClassifier(labelCol=label, weightCol="weight", numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt").fit(data)
    found = sorted(zip(model.featureImportances.toArray().tolist(), columns), key=lambda x: (-x[0], x[1]))  # a row for each feature
    upto = np.cumsum([x for x, _ in found]).tolist()
    return df.sparkSession.createDataFrame(
        [(name, x, k + 1, total) for k, ((x, name), total) in enumerate(zip(found, upto))], "feature string, importance double, rank int, cumulative double"
    )


def save_forest(df: DataFrame, columns: list[str], label: str, path: str, trees: int = 100, depth: int = 10, seed: int = 42) -> None:
    """Fits a forest with its columns as one pipeline and writes it to a folder that executors share."""
    checked_parameters(trees=trees, depth=depth)
    forest = RandomForestClassifier(labelCol=label, weightCol="weight", numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt")
    steps = [VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="skip"), forest]
    Pipeline(stages=steps).fit(balanced(df, label)).write().overwrite().save(path)


def apply_saved(df: DataFrame, path: str) -> DataFrame:
    """Rows with ``probability`` of label 1 and ``predicted`` by a saved model; a missing column is an error."""
    out = PipelineModel.load(path).transform(df)
    return out.withColumn("probability", vector_to_array("probability")[1]).withColumn("predicted", F.col("prediction").cast("int")).drop("features", "rawPrediction", "prediction")


def random_forest_regression(df: DataFrame, columns: list[str], target: str, trees: int = 100, depth: int = 10, seed: int = 42) -> DataFrame:
    checked_parameters(trees=trees, depth=depth)
    data = assembled(df.dropna(subset=[target]), columns)
    model = RandomForestRegressor(labelCol=target, numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt").fit(data)
    return model.transform(data).withColumnRenamed("prediction", "predicted")


def logistic(label: str, rows: int, penalty: str = "l2", c: float = 1.0, l1_ratio: float = 0.5, **more: str) -> LogisticRegression:
    """A logistic regression with the strength of regularisation ``c`` over so many rows."""
    mixed = {"l2": 0.0, "l1": 1.0, "elasticnet": l1_ratio, "none": 0.0}[penalty]
    strength = 0.0 if penalty == "none" else 1 / (c * max(1, rows))
    return LogisticRegression(labelCol=label, regParam=strength, elasticNetParam=mixed, standardization=False, **more)


def logistic_table(df: DataFrame, columns: list[str], label: str, penalty: str = "l2", c: float = 1.0) -> DataFrame:
    """Coefficients with odds ratio, standard error, z and p, of a model in which labels count alike. The information
    matrix is one aggregate over the rows; only its few numbers reach the driver."""
    data = assembled(balanced(df, label), columns)
    model = logistic(label, data.count(), penalty, c, weightCol="weight").fit(data)
    fitted = model.transform(data).withColumn("w", vector_to_array("probability")[1]).withColumn("w", F.col("w") * (1 - F.col("w")))
    k = len(columns)
    sums = fitted.agg(*[F.sum(F.col("w") * F.col(a) * F.col(b)).alias(f"s{i}_{j}") for i, a in enumerate(columns) for j, b in enumerate(columns)]).first()
    information = np.array([[sums[f"s{i}_{j}"] for j in range(k)] for i in range(k)])
    errors = np.sqrt(np.maximum(np.diag(np.linalg.pinv(information)), 0))
    rows = []
    for name, c, e in zip(columns, model.coefficients, errors):
        z = c / e if e else math.nan
        rows.append((name, float(c), math.exp(min(700.0, c)), float(e), float(z), math.erfc(abs(z) / math.sqrt(2))))
    return df.sparkSession.createDataFrame(rows, "feature string, coefficient double, odds_ratio double, std_error double, z double, p_value double")


def kmeans(df: DataFrame, columns: list[str], k: int, seed: int = 42) -> DataFrame:
    data = assembled(df, columns)
    return KMeans(k=k, seed=seed).fit(data).transform(data).withColumnRenamed("prediction", "cluster")


def choose_k(df: DataFrame, columns: list[str], ks: range, seed: int = 42) -> DataFrame:
    """Per k the inertia, the scores of its clusters and whether it is the best: the k of the highest silhouette if it
    is within 2 of the elbow, else the elbow. Clusters are the best of many starts: a single one may end with two groups
    in one cluster, as its first centres hang on how rows are dealt."""
    data = cut(df.select(*columns).dropna())
    v = F.array(*[F.col(c).cast("double") for c in columns])
    rows = []
    for k in ks:
        centres, _, _ = best_centres(data.select(v.alias("v")), k, seed=seed)
        one = cluster_scores(data.withColumn("cluster", nearest_of(v, centres)), "cluster", columns).first()
        rows.append((k, *one))
    bend = elbow([(r[0], r[1]) for r in rows])
    widest = max(rows, key=lambda r: r[4])[0]
    best = widest if abs(bend - widest) <= 2 else bend
    return df.sparkSession.createDataFrame([(*r, r[0] == best) for r in rows], "k int, inertia double, calinski_harabasz double, davies_bouldin double, silhouette double, chosen boolean")


def elbow_differences(curve: DataFrame) -> DataFrame:
    """(k, inertia) with the fall of inertia from the k before, and how it compares with the fall before."""
    order = Window.orderBy("k")
    falls = curve.withColumn("fall", F.lag("inertia").over(order) - F.col("inertia"))
    return falls.withColumn("ratio", F.try_divide("fall", F.lag("fall").over(order)))


def elbow(curve: list[tuple[int, float]]) -> int:
    """The k farthest below the line from the first to the last point."""
    (k0, c0), (k1, c1) = curve[0], curve[-1]
    return max(curve, key=lambda x: c0 + (c1 - c0) * (x[0] - k0) / max(1, k1 - k0) - x[1])[0]


def pca(df: DataFrame, columns: list[str], k: int | None = None, variance: float = 0.95) -> DataFrame:
    """``k`` components, or as many as hold the share of the variance."""
    data = assembled(df, columns)
    fitted = PCA(k=k or len(columns), inputCol="features", outputCol="projected").fit(data)
    shares = np.cumsum(fitted.explainedVariance.toArray())
    n = k or int(np.searchsorted(shares, variance - 1e-12) + 1)
    return fitted.transform(data).withColumns({f"component_{i + 1}": vector_to_array("projected")[i] for i in range(min(n, len(columns)))})


def cluster_profile(df: DataFrame, cluster: str, columns: list[str]) -> DataFrame:
    stats = (("mean", F.avg), ("std", F.stddev_pop), ("min", F.min), ("max", F.max))
    per = df.groupBy(cluster).agg(F.count("*").alias("n"), *[f(c).alias(f"{c}_{n}") for c in columns for n, f in stats])
    return per.withColumn("pct", F.col("n") * 100 / F.sum("n").over(Window.partitionBy()))


def variance_ratio(df: DataFrame, cluster: str, columns: list[str]) -> DataFrame:
    """Between-cluster over within-cluster variation per feature, from per-cluster sums."""
    long = df.select(F.col(cluster).alias("c"), F.expr(f"stack({len(columns)}, {', '.join(f"'{c}', `{c}`" for c in columns)}) AS (feature, v)"))
    per = long.groupBy("feature", "c").agg(F.count("v").alias("n"), F.avg("v").alias("m"), F.var_pop("v").alias("s"))
    w = Window.partitionBy("feature")
    centred = per.withColumn("g", F.sum(F.col("n") * F.col("m")).over(w) / F.sum("n").over(w))
    between = F.sum(F.col("n") * (F.col("m") - F.col("g")) * (F.col("m") - F.col("g")))
    return centred.groupBy("feature").agg(F.try_divide(between, F.sum(F.col("n") * F.col("s"))).alias("ratio"))


def stratified_folds(df: DataFrame, label: str, key: str, folds: int, seed: int = 42) -> DataFrame:
    """Rows with ``fold``: within each label, rank in an order by hash, modulo the folds. Ranks are running sums over
    ranges, so no task orders a label's rows. Labels are few; a row without a label has no fold."""
    checked_parameters(folds=folds)
    table = stored(df)
    labels = sorted(r[0] for r in table.select(label).distinct().collect() if r[0] is not None)
    if not labels:
        return df.withColumn("fold", F.lit(None).cast("int")).limit(0)
    is_one = {f"__is{k}": (F.col(label) == y).cast("int") for k, y in enumerate(labels)}
    hashed = table.filter(F.col(label).isin(labels)).withColumns({"__hash": hash_number(F.lit(seed), F.col(key).cast("string")), **is_one})
    own = F.coalesce(*[F.when(F.col(c) == 1, F.col(f"upto_{c}")) for c in is_one])
    ranks = running(hashed, "__hash", list(is_one))  # of tables of its own
    dropped(table)
    return ranks.withColumn("fold", F.pmod(own - 1, F.lit(folds)).cast("int")).select(*df.columns, "fold")


#: A test, a training set and a strength of regularisation.
Split = tuple[Column, Column, float]


def scores_of(data: DataFrame, label: str, splits: list[Split]) -> list[tuple[float, float]]:
    """Accuracies of logistic regressions on the training rows and on the test rows of each split. Rows are counted in one
    pass and scored by all models in another; fits are independent, and some run at a time."""
    counts = data.agg(*[F.count_if(train) for _, train, _ in splits]).first()

    def fitted(k: int) -> LogisticRegressionModel:
        _, train, c = splits[k]
        return logistic(label, counts[k], c=c).fit(data.filter(train))

    with ThreadPool(AT_ONCE) as pool:
        models = pool.map(inheritable_thread_target(data.sparkSession)(fitted), range(len(splits)))
    scored, parts = data, []
    for k, (model, (test, train, _)) in enumerate(zip(models, splits)):
        scored = model.setPredictionCol(f"__z{k}").setProbabilityCol("").setRawPredictionCol("").transform(scored)
        hit = (F.col(f"__z{k}") == F.col(label)).cast("double")
        parts += [F.avg(F.when(train, hit)), F.avg(F.when(test, hit))]
    found = scored.agg(*parts).first()
    return [(found[2 * k], found[2 * k + 1]) for k in range(len(splits))]


def folded(df: DataFrame, columns: list[str], label: str, key: str, folds: int) -> DataFrame:
    """What the loops of fits read: written once, as they must all see the same folds."""
    kept = stratified_folds(df.select(*dict.fromkeys([*columns, label, key])).dropna(), label, key, folds)
    return assembled(stored(kept.withColumn("__order", hash_number(F.lit(7), F.col(key).cast("string")) / float(1 << 52))), columns)


def fold_splits(folds: int, share: float | None = None, c: float = 1.0) -> list[Split]:
    """Each fold against the others, or against the share of their rows that is first by hash."""
    fold = F.col("fold")
    return [(fold == k, (fold != k) if share is None else (fold != k) & (F.col("__order") <= share), c) for k in range(folds)]


def means_by(groups: list, folds: int, found: list[tuple[float, float]]) -> list[tuple]:
    """The mean scores of as many folds for each group."""
    return [(g, *(float(np.mean(x)) for x in zip(*found[i * folds : (i + 1) * folds]))) for i, g in enumerate(groups)]


def cross_validate(df: DataFrame, columns: list[str], label: str, key: str, folds: int = 5, c: float = 1.0) -> DataFrame:
    """Accuracy on training and test rows of each of the stratified folds, and the gap."""
    found = scores_of(folded(df, columns, label, key, folds), label, fold_splits(folds, c=c))
    rows = [(k, train, test, train - test) for k, (train, test) in enumerate(found)]
    return df.sparkSession.createDataFrame(rows, "fold int, train double, test double, gap double")


def learning_curve(df: DataFrame, columns: list[str], label: str, key: str, shares: list[float], folds: int = 5) -> DataFrame:
    """Mean accuracies over the folds by the share of the training rows, those first by hash."""
    for share in shares:
        checked_parameters(train_share=share)
    found = scores_of(folded(df, columns, label, key, folds), label, [s for share in shares for s in fold_splits(folds, share)])
    return df.sparkSession.createDataFrame(means_by(shares, folds, found), "share double, train double, test double")


def validation_curve(df: DataFrame, columns: list[str], label: str, key: str, strengths: list[float], folds: int = 5) -> DataFrame:
    """Mean accuracies over the folds by the strength of regularisation."""
    found = scores_of(folded(df, columns, label, key, folds), label, [s for c in strengths for s in fold_splits(folds, c=c)])
    return df.sparkSession.createDataFrame(means_by(strengths, folds, found), "c double, train double, test double")


def permutation_refits(df: DataFrame, columns: list[str], label: str, key: str, permutations: int = 100, folds: int = 5) -> DataFrame:
    """(score, p_value): mean test accuracy over the folds, and how often models fitted on labels dealt anew reach it. All
    models are fitted together; no row without rows."""
    checked_parameters(permutations=permutations)
    found = refit_scores(df, columns, label, key, permutations, folds)
    p = [(float(own), (sum(x >= own for x in found[1:]) + 1) / (permutations + 1)) for own in found[:1]]
    return df.sparkSession.createDataFrame(p, "score double, p_value double")


def resampled(df: DataFrame, key: str, seed: int) -> DataFrame:
    """A bootstrap sample as weights: each row as often as a Poisson draw from its hash, the same however rows are dealt."""
    u = hash_number(F.lit(f"b{seed}"), F.col(key).cast("string")) / float(1 << 52)
    upto, steps = 0.0, []
    for k in range(8):
        upto += math.exp(-1) / math.factorial(k)
        steps.append(F.when(u >= upto, 1.0).otherwise(0.0))
    return df.withColumn("__times", sum(steps, F.lit(0.0)))


def spread_of(df: DataFrame, parts: list[str], confidence: float = 0.95) -> DataFrame:
    """Mean, deviation, variance and percentile interval over some columns of a row."""
    each = F.sort_array(F.array(*parts))
    n = len(parts)
    mean = F.aggregate(each, F.lit(0.0), lambda a, x: a + x) / n

    def percentile(q: float) -> Column:
        at = q * (n - 1)
        low = min(int(at), n - 1)
        high = min(low + 1, n - 1)
        return each[low] + (each[high] - each[low]) * (at - low)

    d = df.withColumns({"mean": mean, "lower": percentile((1 - confidence) / 2), "upper": percentile((1 + confidence) / 2)})
    variance = F.aggregate(each, F.lit(0.0), lambda a, x: a + (x - F.col("mean")) * (x - F.col("mean"))) / n
    return d.withColumn("variance", variance).withColumn("std", F.sqrt("variance"))


def members_of(df: DataFrame, columns: list[str], label: str, key: str, members: int, fit: Callable[[int, DataFrame], Any]) -> DataFrame:
    """Rows with the mean and spread of the probabilities of models fitted on bootstrap samples."""
    checked_parameters(members=members)
    data = assembled(cut(df), columns)
    out, names = data, []
    for k in range(members):
        sample = resampled(data, key, k).filter("__times > 0")
        model = fit(k, sample)
        scored = model.transform(out).withColumn(f"__p{k}", vector_to_array("probability")[1])
        out = scored.drop("probability", "prediction", "rawPrediction")
        names.append(f"__p{k}")
    return spread_of(out, names).drop(*names)


def ensemble(df: DataFrame, columns: list[str], label: str, key: str, members: int = 10, trees: int = 50, depth: int = 10) -> DataFrame:
    """Forests on bootstrap samples."""
    checked_parameters(trees=trees, depth=depth)

    def fit(k: int, sample: DataFrame) -> Any:
        return RandomForestClassifier(labelCol=label, weightCol="__times", numTrees=trees, maxDepth=depth, seed=k, featureSubsetStrategy="sqrt").fit(sample)

    return members_of(df, columns, label, key, members, fit)


def bootstrap(df: DataFrame, columns: list[str], label: str, key: str, members: int = 100) -> DataFrame:
    """Logistic regressions on bootstrap samples."""
    return members_of(df, columns, label, key, members, lambda _, sample: logistic(label, sample.count(), weightCol="__times").fit(sample))
