"""Feature stacking, imputation, scaling, selection and quality."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.plans.quantiles import exact_quantiles


def stack(grids: dict[str, DataFrame]) -> DataFrame:
    """Aligned grids (row, col, value) side by side: inner equi-joins on the cell."""
    out = None
    for name, grid in grids.items():
        named = grid.select("row", "col", F.col("value").alias(name))
        out = named if out is None else out.join(named, ["row", "col"])
    return out


def aligned(reference: DataFrame, coarse: DataFrame, factor: int) -> DataFrame:
    """A coarse grid's values on the cells of the reference grid: each cell takes that of the block it lies in."""
    block = [F.floor(F.col(c) / factor).cast("int").alias(f"__{c}") for c in ("row", "col")]
    held = coarse.select(F.col("row").alias("__row"), F.col("col").alias("__col"), "value")
    return reference.select("row", "col", *block).join(held, ["__row", "__col"]).select("row", "col", "value")


def prefixed(files: list[DataFrame]) -> DataFrame:
    """Aligned grids side by side, the bands of file k named F<k>_<band>."""
    out = None
    for k, grid in enumerate(files):
        named = grid.select("row", "col", *[F.col(c).alias(f"F{k}_{c}") for c in grid.columns if c not in ("row", "col")])
        out = named if out is None else out.join(named, ["row", "col"])
    return out


def complete_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows without a missing value; NaN is missing."""
    return df.dropna(subset=columns)


def fill_missing(df: DataFrame, columns: list[str], policy: str, constant: float = 0.0) -> DataFrame:
    """By a constant, each column's mean or median, or (invalidate) missing in all columns where it is in one."""
    if policy == "median":
        return impute_median(df, columns)
    if policy == "constant":
        return df.withColumns({c: F.coalesce(c, F.lit(constant)) for c in columns})
    if policy == "mean":
        means = df.agg(*[F.avg(c).alias(f"__{c}") for c in columns])
        return df.crossJoin(F.broadcast(means)).withColumns({c: F.coalesce(c, f"__{c}") for c in columns}).drop(*[f"__{c}" for c in columns])
    if policy == "invalidate":
        whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
        return df.withColumns({c: F.when(whole, F.col(c)) for c in columns})
    raise ValueError(f"unknown policy {policy}")


def dem_check(df: DataFrame, value: str) -> DataFrame:
    """Cells, valid ones, their share and range, and warnings about heights that can't be."""
    v = F.col(value)
    return df.agg(
        F.count("*").alias("cells"), F.count(v).alias("valid"), (F.count(v) * 100 / F.count("*")).alias("completeness"), F.min(v).alias("min"), F.max(v).alias("max"),
        F.concat_ws(";", F.when(F.min(v) < -500, "low"), F.when(F.max(v) > 10000, "high")).alias("warnings"),
    )


def k_best(df: DataFrame, columns: list[str], k: int) -> DataFrame:
    """The k features of the greatest variance."""
    return variance_select(df, columns, 0.0).orderBy(F.col("variance").desc(), "feature").limit(k).select("feature", "variance")


def impute_median(df: DataFrame, columns: list[str]) -> DataFrame:
    medians = exact_quantiles(df, {c: (c, 0.5) for c in columns})
    return df.withColumns({c: F.coalesce(c, F.lit(medians[c])) for c in columns})


def scale(df: DataFrame, columns: list[str], method: str) -> DataFrame:
    """standard (population deviation), robust (median and quartiles) or minmax, fitted on complete rows."""
    complete = df.dropna(subset=columns)
    if method == "robust":
        q = exact_quantiles(complete, {f"{c}:{p}": (c, p) for c in columns for p in (0.25, 0.5, 0.75)})
        zero = lambda x: 0.0 if x is None else x
        fitted = {c: (q[f"{c}:0.5"], zero(q[f"{c}:0.75"]) - zero(q[f"{c}:0.25"])) for c in columns}
        return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s or 1.0) for c, (m, s) in fitted.items()})
    centre, spread = {"standard": (F.avg, F.stddev_pop), "minmax": (F.min, lambda c: F.max(c) - F.min(c))}[method]
    one = complete.agg(*[x for c in columns for x in (centre(c).alias(f"__c_{c}"), spread(c).alias(f"__s_{c}"))])
    # A constant column keeps its centred values.
    scaled = {c: (F.col(c) - F.col(f"__c_{c}")) / F.when(F.col(f"__s_{c}") != 0, F.col(f"__s_{c}")).otherwise(1.0) for c in columns}
    return df.crossJoin(F.broadcast(one)).withColumns(scaled).drop(*[x for c in columns for x in (f"__c_{c}", f"__s_{c}")])


def unpivot(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(F.expr(f"stack({len(columns)}, {', '.join(f"'{c}', `{c}`" for c in columns)}) AS (feature, value)"))


def feature_quality(df: DataFrame, columns: list[str]) -> DataFrame:
    medians = exact_quantiles(df, {c: (c, 0.5) for c in columns})
    middle = F.create_map(*[x for c in columns for x in (F.lit(c), F.lit(medians[c]).cast("double"))])
    return unpivot(df, columns).groupBy("feature").agg(
        F.count("value").alias("n_valid"), (F.count("value") * 100 / F.count("*")).alias("coverage_pct"), F.avg("value").alias("mean"),
        F.stddev_pop("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"),
    ).withColumn("median", middle[F.col("feature")])


def variance_select(df: DataFrame, columns: list[str], threshold: float) -> DataFrame:
    """Population variance per feature, and whether it is kept; all are where none passes."""
    v = unpivot(df, columns).groupBy("feature").agg(F.var_pop("value").alias("variance"))
    passes = F.col("variance") > threshold
    return v.withColumn("kept", passes | ~F.max(passes).over(Window.partitionBy()))


def correlation_pairs(df: DataFrame, columns: list[str]) -> DataFrame:
    """(a, b, r) of every two features, in one aggregate."""
    pairs = list(combinations(columns, 2))
    one = df.agg(*[F.corr(a, b).alias(f"r{k}") for k, (a, b) in enumerate(pairs)])
    return one.select(F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r{k}").alias("r")) for k, (a, b) in enumerate(pairs)])).alias("x")).select("x.*")


def correlation_prune(df: DataFrame, columns: list[str], limit: float) -> DataFrame:
    """Features that no earlier feature is correlated with beyond the limit."""
    late = correlation_pairs(df, columns).filter(F.abs("r") > limit).select(F.col("b").alias("feature")).distinct()
    names = df.sparkSession.createDataFrame([(k, c) for k, c in enumerate(columns)], "position int, feature string")
    return names.join(late, "feature", "left_anti")


def rank_importance(df: DataFrame) -> DataFrame:
    """(feature, importance) with rank, share and running share."""
    order = Window.orderBy(F.col("importance").desc(), "feature")
    total = F.sum("importance").over(Window.partitionBy())
    upto = F.sum("importance").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumns({"rank": F.row_number().over(order), "share": F.col("importance") / total, "cumulative": upto / total})


def stratified_split(df: DataFrame, label: str, key: str, test_share: float, seed: int = 42) -> DataFrame:
    """Marks a fixed share of each label's rows as test, those first in an order by hash.

    Rows are counted by label and the hash's first four digits; running sums over these at most
    65,536 ranges name the one where a label's share ends, and only its rows are put in order.
    """
    hashed = df.withColumn("__hash", F.md5(F.concat_ws(":", F.lit(seed), key))).withColumn("__range", F.substring("__hash", 1, 4))
    ranges = hashed.groupBy(F.col(label).alias("__label"), F.col("__range").alias("__at")).agg(F.count("*").alias("__n"))
    by_label = Window.partitionBy("__label")
    counted = ranges.withColumns({
        "__upto": F.sum("__n").over(by_label.orderBy("__at").rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "__take": F.floor(F.sum("__n").over(by_label) * test_share),
    })
    same = F.col(label).eqNullSafe(F.col("__label")) & (F.col("__range") == F.col("__at"))
    joined = hashed.join(counted, same)
    whole = joined.filter((F.col("__upto") <= F.col("__take")) | (F.col("__upto") - F.col("__n") >= F.col("__take"))).withColumn("is_test", F.col("__upto") <= F.col("__take"))
    split = joined.filter((F.col("__upto") > F.col("__take")) & (F.col("__upto") - F.col("__n") < F.col("__take")))
    place = F.row_number().over(Window.partitionBy("__label").orderBy("__hash"))
    part = split.withColumn("is_test", F.col("__upto") - F.col("__n") + place <= F.col("__take"))
    return whole.select(*df.columns, "is_test").unionByName(part.select(*df.columns, "is_test"))
