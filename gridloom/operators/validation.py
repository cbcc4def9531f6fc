"""How far a model is to be trusted: likelihoods, intervals, permutations, cluster quality, summaries."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.naming import first_of
from gridloom.operators.metrics import running
from gridloom.plans.lineage import cut, dropped, stored


def gamma_tail(a: float, x: float) -> float:
    """The upper regularised incomplete gamma function."""
    if x <= 0:
        return 1.0
    if x < a + 1:  # series of the lower function
        term = total = 1 / a
        n = a
        while abs(term) > 1e-17 * abs(total):
            n += 1
            term *= x / n
            total += term
        return 1 - total * math.exp(a * math.log(x) - x - math.lgamma(a))
    # Continued fraction, from far out to its head.
    tail = 0.0
    for k in range(2000, 0, -1):
        tail = k * (k - a) / (x + 2 * k + 1 - a - tail)
    return math.exp(a * math.log(x) - x - math.lgamma(a)) / (x + 1 - a - tail)


def chi2_tail(x: float, df: int) -> float:
    return gamma_tail(df / 2, x / 2)


def t_tail(t: float, df: int) -> float:
    """The chance that Student's t lies beyond t, on one side; by Simpson's rule over the bounded angle of t."""
    if math.isinf(t):
        return 0.0 if t > 0 else 1.0
    low, high, n = math.atan(t / math.sqrt(df)), math.pi / 2, 4000
    f = lambda x: max(math.cos(x), 0.0) ** (df - 1)
    h = (high - low) / n
    area = sum(f(low + k * h) * (1 if k in (0, n) else 4 if k % 2 else 2) for k in range(n + 1)) * h / 3
    return area * math.exp(math.lgamma((df + 1) / 2) - math.lgamma(df / 2)) / math.sqrt(math.pi)


def t_quantile(p: float, df: int) -> float:
    low, high = -1e4, 1e4
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if 1 - t_tail(mid, df) < p else (low, mid)
    return (low + high) / 2


def normal_p(z: float) -> float:
    """Both sides."""
    return math.erfc(abs(z) / math.sqrt(2))


def logistic_diagnostics(df: DataFrame, label: str, score: str, features: int) -> DataFrame:
    """Log-likelihoods, likelihood ratio test, McFadden's R2, AIC and BIC of probabilities of a model with so many features."""
    s, y = F.greatest(F.least(F.col(score), F.lit(1 - 1e-15)), F.lit(1e-15)), F.col(label)
    one = df.agg(F.sum(y * F.ln(s) + (1 - y) * F.ln(1 - s)).alias("ll"), F.avg(y).alias("share"), F.count("*").alias("n")).first()
    if not one["n"] or one["ll"] is None:
        return df.sparkSession.createDataFrame([], DIAGNOSTICS)
    p, n, ll = min(max(one["share"], 1e-15), 1 - 1e-15), one["n"], one["ll"]
    null = n * (p * math.log(p) + (1 - p) * math.log(1 - p))
    ratio, k = -2 * (null - ll), features + 1
    row = (ll, null, ratio, chi2_tail(ratio, features), 1 - ll / null if null else 0.0, 2 * k - 2 * ll, math.log(n) * k - 2 * ll)
    return df.sparkSession.createDataFrame([tuple(map(float, row))], DIAGNOSTICS)


DIAGNOSTICS = "log_likelihood double, null_log_likelihood double, ratio double, p_value double, mcfadden double, aic double, bic double"


def fold_interval(scores: list[float], confidence: float = 0.95, chance: float = 0.5) -> dict[str, float]:
    """Mean of the folds' scores, its interval by Student's t, and the test against chance."""
    n = len(scores)
    mean = sum(scores) / n
    spread = math.sqrt(sum((x - mean) ** 2 for x in scores) / max(1, n - 1))
    error = spread / math.sqrt(n)
    reach = t_quantile((1 + confidence) / 2, n - 1) * error if n > 1 else math.nan
    t = (mean - chance) / error if error else math.copysign(math.inf, mean - chance) if mean != chance else 0.0
    return {"mean": mean, "std": spread, "lower": mean - reach, "upper": mean + reach, "t": t, "p_value": 2 * t_tail(abs(t), n - 1) if n > 1 else math.nan}


def fold_scores(df: DataFrame, fold: Column, hit: Column) -> DataFrame:
    return df.groupBy(fold.alias("fold")).agg(F.avg(hit.cast("double")).alias("score"), F.count("*").alias("n"))


def hash_number(*parts: Column | str) -> Column:
    """52 bits of a digest as a whole double: an order that no engine decides."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("long").cast("double")


def ranked(df: DataFrame, by: Column, columns: list[str]) -> DataFrame:
    """Some columns with ``__rank``, the place in an order. Ranks are running sums over ranges, so no task orders all rows."""
    one = df.select(by.alias("__by"), F.lit(1).alias("__one"), *columns)
    return running(one, "__by", ["__one"]).withColumnRenamed("upto___one", "__rank").drop("__by", "__one")


def by_key(df: DataFrame, key: str) -> DataFrame:
    """A table of the rows with their ranks by key, which all shuffles of it share; keys are distinct."""
    return stored(ranked(df, F.col(key).cast("double"), df.columns))


def dealt(rows: DataFrame, columns: list[str], key: str, seed: int) -> DataFrame:
    """The rows of ``by_key``, beside them (as ``__`` and the name) columns dealt anew: the values of the k-th row by a hash
    go to the k-th row by key."""
    out_of = ranked(rows, hash_number(F.lit(seed), F.col(key)), columns)
    return rows.join(out_of.withColumnsRenamed({c: f"__{c}" for c in columns}), "__rank")


def shuffled(df: DataFrame, column: str, key: str, seed: int) -> DataFrame:
    """The rows with ``column`` dealt anew over them."""
    return dealt(by_key(df, key), [column], key, seed).withColumn(column, F.col(f"__{column}")).select(*df.columns)


def permutation_importance(df: DataFrame, features: list[str], label: str, predict: Column, key: str, repeats: int = 3) -> DataFrame:
    """(feature, importance_mean, importance_std, p_value): by how much the accuracy of ``predict`` falls when a
    feature's values are dealt anew. All features of a repeat are dealt in one pass."""
    hit = (predict == F.col(label)).cast("double")
    rows = by_key(df, key)
    base = rows.agg(F.avg(hit).alias("a")).first()["a"]
    falls: dict[str, list[float]] = {f: [] for f in features}
    for seed in range(repeats):
        found = dealt(rows, features, key, seed)
        for k, f in enumerate(features):
            swap = {f: F.col(f"__{f}"), f"__{f}": F.col(f)}
            found = found.withColumns(swap).withColumn(f"__hit{k}", hit).withColumns(swap)
        means = found.agg(*[F.avg(f"__hit{k}") for k in range(len(features))]).first()
        for f, a in zip(features, means):
            falls[f].append(base - a)
    dropped(rows)
    out = []
    for f, found in falls.items():
        mean = sum(found) / repeats
        std = math.sqrt(sum((x - mean) ** 2 for x in found) / repeats)
        out.append((f, mean, std, normal_p(mean / std) if std else 1.0))
    return df.sparkSession.createDataFrame(out, "feature string, importance_mean double, importance_std double, p_value double")


def permutation_test(df: DataFrame, label: str, predict: Column, key: str, permutations: int = 5) -> DataFrame:
    """(score, p_value): how often labels dealt anew fit the predictions as well."""
    rows = by_key(df, key)
    score = rows.agg(F.avg((predict == F.col(label)).cast("double")).alias("a")).first()["a"]
    hit = (predict == F.col(f"__{label}")).cast("double")
    others = [dealt(rows, [label], key, seed).agg(F.avg(hit).alias("a")).first()["a"] for seed in range(permutations)]
    dropped(rows)
    p = (sum(x >= score for x in others) + 1) / (permutations + 1)
    return df.sparkSession.createDataFrame([(score, p)], "score double, p_value double")


def validation_summary(accuracy: Column, gap: Column) -> dict[str, Column]:
    """Grades of a score and of the gap between training and test."""
    level = first_of([(accuracy > 0.9, "Excellent"), (accuracy > 0.8, "Good"), (accuracy > 0.7, "Fair")], "Poor")
    fit = first_of([(F.abs(gap) > 0.1, "high"), (F.abs(gap) > 0.05, "moderate")], "low")
    strong = level.isin("Excellent", "Good")
    return {
        "level": level, "overfitting": fit,
        "assessment": first_of([(strong & (F.abs(gap) < 0.1), "strong"), (strong, "may be overfitting"), (level == "Fair", "moderate")], "poor"),
    }


def cluster_scores(df: DataFrame, cluster: str, columns: list[str]) -> DataFrame:
    """Inertia, Calinski-Harabasz, Davies-Bouldin and the simplified silhouette (by distances to centres).

    Centres are one row that holds them all, which is broadcast; rows stream past it into sums.
    """
    centres = cut(df.groupBy(F.col(cluster).alias("c")).agg(F.count("*").alias("n"), *[F.avg(x).alias(f"m_{x}") for x in columns]))
    distance = lambda a, b: F.sqrt(sum(((F.col(x) - F.col(y)) * (F.col(x) - F.col(y)) for x, y in zip(a, b)), F.lit(0.0)))
    middles = [f"m_{x}" for x in columns]
    # A row meets all centres as one array: nothing is exploded, and no row is shuffled to find its own again.
    listed = centres.agg(F.collect_list(F.struct("c", *middles)).alias("__centres"))
    far = lambda c: F.sqrt(sum(((F.col(x) - c[m]) * (F.col(x) - c[m]) for x, m in zip(columns, middles)), F.lit(0.0)))
    distances = lambda own: F.transform(F.filter("__centres", lambda c: (c["c"] == F.col(cluster)) if own else (c["c"] != F.col(cluster))), far)
    per_row = df.crossJoin(F.broadcast(listed)).select(F.array_max(distances(True)).alias("a"), F.array_min(distances(False)).alias("b"), F.col(cluster).alias("own"))
    spread = per_row.groupBy("own").agg(F.avg("a").alias("s"), F.sum(F.col("a") * F.col("a")).alias("w"), F.sum(F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0))).alias("q"), F.count("*").alias("rows"))
    sides = cut(spread.join(centres, F.col("own") == F.col("c")))
    a, b = (sides.select(F.col("c").alias(f"c_{k}"), F.col("s").alias(f"s_{k}"), *[F.col(m).alias(f"{m}_{k}") for m in middles]) for k in "ab")
    worst = a.crossJoin(b).filter("c_a <> c_b").withColumn("r", F.try_divide(F.col("s_a") + F.col("s_b"), distance([f"{m}_a" for m in middles], [f"{m}_b" for m in middles]))).groupBy("c_a").agg(F.max("r").alias("r"))
    grand = df.agg(*[F.avg(x).alias(f"g_{x}") for x in columns])
    between = sides.crossJoin(F.broadcast(grand)).agg(F.sum(F.col("n") * sum(((F.col(f"m_{x}") - F.col(f"g_{x}")) * (F.col(f"m_{x}") - F.col(f"g_{x}")) for x in columns), F.lit(0.0))).alias("between"))
    totals = sides.agg(F.sum("w").alias("inertia"), F.sum("q").alias("q"), F.sum("rows").alias("rows"), F.count("*").alias("k"))
    mean_worst = worst.agg(F.avg("r").alias("davies_bouldin"))
    return totals.crossJoin(between).crossJoin(mean_worst).select(
        "inertia", F.try_divide(F.col("between") / (F.col("k") - 1), F.col("inertia") / (F.col("rows") - F.col("k"))).alias("calinski_harabasz"),
        "davies_bouldin", (F.col("q") / F.col("rows")).alias("silhouette"),
    )
