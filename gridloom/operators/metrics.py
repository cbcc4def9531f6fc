"""Model metrics as aggregates over (label, prediction, probability)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.plans.lineage import stored


def confusion(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Counts, and each label's row normalised."""
    n = df.groupBy(F.col(label).alias("label"), F.col(predicted).alias("predicted")).count()
    return n.withColumn("row_share", F.col("count") / F.sum("count").over(Window.partitionBy("label")))


def binary_metrics(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Accuracy, weighted precision, recall and F1, MCC and kappa of 0/1 labels."""
    cell = lambda a, b: F.sum(F.when((F.col(label) == a) & (F.col(predicted) == b), 1).otherwise(0)).cast("double")
    c = df.agg(cell(1, 1).alias("tp"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(0, 0).alias("tn"))
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    zero = lambda x: F.coalesce(x, F.lit(0.0))
    ratio = lambda a, b: zero(F.try_divide(a, b))
    p1, p0, r1, r0 = ratio(tp, tp + fp), ratio(tn, tn + fn), ratio(tp, tp + fn), ratio(tn, tn + fp)
    f = lambda p, r: ratio(2 * p * r, p + r)
    w1, w0 = (tp + fn) / n, (tn + fp) / n
    chance = ((tp + fp) * (tp + fn) + (tn + fn) * (tn + fp)) / (n * n)
    return c.select(
        ((tp + tn) / n).alias("accuracy"), (w1 * p1 + w0 * p0).alias("precision"), (w1 * r1 + w0 * r0).alias("recall"),
        (w1 * f(p1, r1) + w0 * f(p0, r0)).alias("f1"),
        ratio(tp * tn - fp * fn, F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))).alias("mcc"),
        ratio((tp + tn) / n - chance, 1 - chance).alias("kappa"),
    )


def running(per: DataFrame, by: str, sums: list[str]) -> DataFrame:
    """Running sums, the row's own included, over rows of rising ``by``, as ``upto_`` columns.

    Rows are dealt by ranges of ``by`` with about equal counts, as many as shuffle partitions; a
    row's sum is that of the ranges before it and of the rows before it in its own range. The
    ranges are written, as their sums and the windows must see the same rows in the same ranges.
    """
    n = int(per.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stored(per.repartitionByRange(n, by).withColumn("__range", F.spark_partition_id()))
    # One row for each range.
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy("__range").agg(*[F.sum(c).alias(f"__{c}") for c in sums])
    offsets = totals.select(F.col("__range").alias("__at"), *[F.coalesce(F.sum(f"__{c}").over(before), F.lit(0)).alias(f"__{c}") for c in sums])
    own = Window.partitionBy("__range").orderBy(by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = dealt.withColumns({f"upto_{c}": F.sum(c).over(own) for c in sums})
    joined = inside.join(F.broadcast(offsets), F.col("__range") == F.col("__at"))
    return joined.select(*per.columns, *[(F.col(f"upto_{c}") + F.col(f"__{c}")).alias(f"upto_{c}") for c in sums])


def curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """Per distinct score: true and false positives of it and all higher ones. Counts are summed
    per score first, so the running sums are over distinct scores."""
    per = df.groupBy((-F.col(score)).alias("falling")).agg(F.sum(label).alias("p"), F.sum(1 - F.col(label)).alias("n"))
    return running(per, "falling", ["p", "n"]).select((-F.col("falling")).alias("threshold"), F.col("upto_p").alias("tp"), F.col("upto_n").alias("fp"))


def roc_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """(threshold, fpr, tpr) of every distinct score, and the beginning, where nothing is taken and the threshold infinite."""
    c = curve(df, label, score)
    every = c.agg(F.max("tp").alias("p"), F.max("fp").alias("n"))
    points = c.crossJoin(F.broadcast(every)).select("threshold", F.try_divide("fp", "n").alias("fpr"), F.try_divide("tp", "p").alias("tpr"))
    begin = df.sparkSession.range(1).select(F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return begin.unionByName(points)


def precision_recall(df: DataFrame, label: str, score: str) -> DataFrame:
    c = curve(df, label, score)
    every = c.agg(F.max("tp").alias("every"))
    return c.crossJoin(F.broadcast(every)).select("threshold", (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"), F.try_divide("tp", "every").alias("recall"))


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area by rank sums; tied scores share their average rank."""
    per = df.groupBy(F.col(score).alias("s")).agg(F.sum(label).alias("p"), F.count("*").alias("c"))
    ranked = running(per, "s", ["c"]).withColumn("rank", F.col("upto_c") - (F.col("c") - 1) / 2)
    sums = ranked.agg(F.sum(F.col("p") * F.col("rank")).alias("r"), F.sum("p").alias("p"), F.sum("c").alias("c"))
    p, n = F.col("p"), F.col("c") - F.col("p")
    return sums.select(F.try_divide(F.col("r") - p * (p + 1) / 2, p * n).alias("auc"))


def probability_scores(df: DataFrame, label: str, score: str) -> DataFrame:
    s = F.greatest(F.least(F.col(score), F.lit(1 - 1e-15)), F.lit(1e-15))
    y = F.col(label)
    return df.agg(F.avg(-(y * F.ln(s) + (1 - y) * F.ln(1 - s))).alias("log_loss"), F.avg((F.col(score) - y) * (F.col(score) - y)).alias("brier"))


def calibration(df: DataFrame, label: str, score: str, bins: int = 10) -> DataFrame:
    b = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    return df.groupBy(b.alias("bin")).agg(F.count("*").alias("n"), F.avg(score).alias("mean_predicted"), F.avg(label).alias("observed"))


def regression(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    e = F.col(truth) - F.col(predicted)
    one = df.agg(
        F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"), F.avg(F.abs(F.try_divide(e, F.col(truth)))).alias("mape"),
        F.avg(e).alias("residual_mean"), F.stddev_pop(e).alias("residual_std"), F.var_pop(truth).alias("v"), F.var_pop(e).alias("ve"),
    )
    return one.select(
        "mse", F.sqrt("mse").alias("rmse"), "mae", "mape", "residual_mean", "residual_std",
        (1 - F.try_divide("mse", "v")).alias("r2"), (1 - F.try_divide("ve", "v")).alias("explained_variance"),
    )
