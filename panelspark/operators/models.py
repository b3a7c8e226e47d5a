"""Per-series forecasting models (M01-M04) on long tables.

Input: rows (key..., month, value, role) where role is 'train' for rows the
model may see and anything else for rows to predict. Each series (key) is
fitted on its own train rows: the month index t counts from the series'
first train month, and the first 12 train months are excluded from the fit
(they have no lag-12 value in the reference's feature set). Predictions are
clipped at 0.

All are closed forms in SQL aggregates: linear trend = regr_slope /
regr_intercept; quadratic = 3x3 normal equations on a centred index solved
by Cramer's rule; the 13-parameter ridge by elimination of its month effects.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelspark.functions import month_index
from panelspark.session import cut_lineage, side_by_side

SERIES_MODELS = ("seasonal_naive", "linear", "polynomial_2", "seasonal_ridge")
RIDGE_ALPHA = 100.0


def _with_index(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    w = Window.partitionBy(*keys)
    origin = F.min(F.when(F.col("role") == "train", F.col("month"))).over(w)
    return df.withColumn("t", month_index("month", origin).cast("double"))


def seasonal_naive(df: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Value of the same month one year earlier from the train rows, >= 0
    (M01, J12): a self join on `month - 12 months`."""
    train = df.where(F.col("role") == "train").select(*keys, F.add_months("month", 12).alias("month"),
                                                       F.col(value).alias("_ly"))
    target = df.where(F.col("role") != "train")
    return target.join(train, [*keys, "month"], "left").withColumn(
        "prediction", F.greatest(F.lit(0.0), F.col("_ly").cast("double"))).drop("_ly")


def linear_trend(df: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """OLS of value on t over train rows with t >= 12."""
    d = _with_index(df, keys)
    fit_rows = d.where((F.col("role") == "train") & (F.col("t") >= 12))
    coef = fit_rows.groupBy(*keys).agg(F.regr_slope(value, "t").alias("_b"), F.regr_intercept(value, "t").alias("_a"))
    target = d.where(F.col("role") != "train").join(coef, list(keys), "left")
    return target.withColumn("prediction", F.greatest(F.lit(0.0), F.col("_a") + F.col("_b") * F.col("t"))).drop("_a", "_b", "t")


def polynomial_2(df: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """OLS of value on t and t^2 (M03): normal equations on u = t - c,
    c = the mean train index of the series, solved by Cramer's rule."""
    d = _with_index(df, keys)
    fit_rows = d.where((F.col("role") == "train") & (F.col("t") >= 12))
    centre = fit_rows.groupBy(*keys).agg(F.avg("t").alias("_c"))
    u = (F.col("t") - F.col("_c"))
    y = F.col(value).cast("double")
    s = fit_rows.join(centre, list(keys)).groupBy(*keys, "_c").agg(
        F.count(F.lit(1)).cast("double").alias("s0"), F.sum(u).alias("s1"), F.sum(u * u).alias("s2"),
        F.sum(u * u * u).alias("s3"), F.sum(u * u * u * u).alias("s4"),
        F.sum(y).alias("r0"), F.sum(u * y).alias("r1"), F.sum(u * u * y).alias("r2"))
    c = {k: F.col(k) for k in ("s0", "s1", "s2", "s3", "s4", "r0", "r1", "r2")}

    def det3(a, b, cc, d_, e, f, g, h, i):
        return a * (e * i - f * h) - b * (d_ * i - f * g) + cc * (d_ * h - e * g)
    S0, S1, S2, S3, S4, R0, R1, R2 = (c[k] for k in ("s0", "s1", "s2", "s3", "s4", "r0", "r1", "r2"))
    D = det3(S0, S1, S2, S1, S2, S3, S2, S3, S4)
    b0 = det3(R0, S1, S2, R1, S2, S3, R2, S3, S4) / D
    b1 = det3(S0, R0, S2, S1, R1, S3, S2, R2, S4) / D
    b2 = det3(S0, S1, R0, S1, S2, R1, S2, S3, R2) / D
    coef = s.select(*keys, "_c", b0.alias("_b0"), b1.alias("_b1"), b2.alias("_b2"))
    target = d.where(F.col("role") != "train").join(coef, list(keys), "left")
    uu = F.col("t") - F.col("_c")
    pred = F.col("_b0") + F.col("_b1") * uu + F.col("_b2") * uu * uu
    return target.withColumn("prediction", F.greatest(F.lit(0.0), pred)).drop("_c", "_b0", "_b1", "_b2", "t")


def seasonal_ridge(df: DataFrame, keys: Sequence[str], value: str = "value", alpha: float = RIDGE_ALPHA) -> DataFrame:
    """Ridge (alpha=100, intercept unpenalised) on t + 12 month dummies per series.

    The dummies' block of the normal equations is diagonal, so each month's effect is (its sum of y - n * intercept -
    its sum of t * slope) / (n + alpha). Put into the equations of intercept and slope that leaves a 2 x 2 system of
    sums over a series' months, solved by Cramer's rule. A month of the year without train rows has no effect; a
    series without train rows gets null; null values are not fitted."""
    d = _with_index(df, keys).withColumn("_m", F.month("month"))
    y, t = F.col(value).cast("double"), F.col("t")
    months = d.where((F.col("role") == "train") & (t >= 12) & y.isNotNull()).groupBy(*keys, "_m").agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum(t).alias("st"), F.sum(y).alias("sy"),
        F.sum(t * t).alias("stt"), F.sum(t * y).alias("sty"))
    n, st, sy = (F.col(c) for c in ("n", "st", "sy"))
    left = n + alpha
    sums = months.groupBy(*keys).agg(
        F.sum(n - n * n / left).alias("a11"), F.sum(st - n * st / left).alias("a12"),
        (F.sum(F.col("stt") - st * st / left) + alpha).alias("a22"),
        F.sum(sy - n * sy / left).alias("b1"), F.sum(F.col("sty") - st * sy / left).alias("b2"),
        F.map_from_entries(F.collect_list(F.struct("_m", F.struct("n", "st", "sy")))).alias("_months"))  # 12 at most
    a11, a12, a22, b1, b2 = (F.col(c) for c in ("a11", "a12", "a22", "b1", "b2"))
    det = a11 * a22 - a12 * a12
    coef = sums.select(*keys, "_months", ((b1 * a22 - b2 * a12) / det).alias("_a"), ((a11 * b2 - a12 * b1) / det).alias("_b"))
    target = d.where(F.col("role") != "train").join(coef, list(keys), "left").withColumn("_s", F.col("_months")[F.col("_m")])
    effect = (F.col("_s.sy") - F.col("_s.n") * F.col("_a") - F.col("_s.st") * F.col("_b")) / (F.col("_s.n") + alpha)
    pred = F.col("_a") + F.col("_b") * t + F.coalesce(effect, F.lit(0.0))
    return target.select(*keys, "month", "role", y.alias(value), F.when(F.col("_a").isNotNull(), F.greatest(F.lit(0.0), pred)).alias("prediction"))


SERIES_FITTERS = {"seasonal_naive": seasonal_naive, "linear": linear_trend, "polynomial_2": polynomial_2,
                  "seasonal_ridge": seasonal_ridge}


def future_rows(series: DataFrame, keys: Sequence[str], horizon: int = 12, value: str = "value") -> DataFrame:
    """The series' rows as 'train' plus `horizon` months after each series'
    last month as 'future' (value NULL)."""
    last = series.groupBy(*keys).agg(F.max("month").alias("_last"))
    fut = last.select(*keys, F.explode(F.sequence(F.add_months("_last", 1), F.add_months("_last", horizon),
                                                  F.expr("INTERVAL 1 MONTH"))).alias("month"))
    fut = fut.withColumn(value, F.lit(None).cast("double")).withColumn("role", F.lit("future"))
    return series.select(*keys, "month", F.col(value).cast("double").alias(value)).withColumn("role", F.lit("train")) \
        .unionByName(fut)


# The per-series tree models' hyper-parameters. Depth is not limited but by Spark's own bound of 30.
SERIES_RF = dict(numTrees=100, minInstancesPerNode=3, featureSubsetStrategy="0.9", seed=42, maxDepth=30)
SERIES_GBT = dict(maxIter=80, maxDepth=3, minInstancesPerNode=8, stepSize=0.1, seed=42)
SERIES_ALL = ("seasonal_naive", "linear", "polynomial_2", "seasonal_ridge", "random_forest", "gradient_boosting")
TOTAL_SERIES = "statewide"


def pooled_trees(df: DataFrame, keys: Sequence[str], kind: str, value: str = "value", series: str = "series",
                 fold: str | None = None, apart: str | None = TOTAL_SERIES) -> DataFrame:
    """Tree forecasts (M05, M06) from one model per fold over all series, for any number of them.

    Features are t, the month's sine and cosine and the value 12 months earlier; value and lag are divided by the
    series' own mean over its train rows, so that no series rules the squared loss and no label is needed. The series
    named `apart`, the total of the others, has its own fit. A series whose train rows are all 0 is predicted 0."""
    import math

    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor, RandomForestRegressor

    d = _with_index(df, keys)
    own = Window.partitionBy(*keys)
    y = F.col(value).cast("double")
    mean = F.avg(F.when(F.col("role") == "train", y)).over(own)
    angle = F.lit(2 * math.pi) * F.month("month") / F.lit(12.0)
    d = d.withColumn("_mean", mean).withColumns({
        "_scale": F.when(F.col("_mean") > 0, F.col("_mean")), "_sin": F.sin(angle), "_cos": F.cos(angle),
        "_lag12": F.lag(y, 12).over(own.orderBy("month"))})
    d = d.withColumns({"_lag12": F.col("_lag12") / F.col("_scale"), "_y": y / F.col("_scale")})
    inputs = ["t", "_sin", "_cos", "_lag12"]
    d = cut_lineage(VectorAssembler(inputCols=inputs, outputCol="_x", handleInvalid="keep").transform(d))
    tree = RandomForestRegressor(**SERIES_RF) if kind == "random_forest" else GBTRegressor(**SERIES_GBT)
    tree = tree.setFeaturesCol("_x").setLabelCol("_y").setPredictionCol("_p")
    folds = [None] if fold is None else [r[0] for r in d.select(fold).distinct().orderBy(fold).collect()]  # <= n_folds
    groups = [None] if apart is None else [F.col(series) != apart, F.col(series) == apart]
    def predicted(f, group):
        part = d if f is None else d.where(F.col(fold) == f)
        part = part if group is None else part.where(group)
        train = part.where((F.col("role") == "train") & (F.col("t") >= 12) & F.col("_lag12").isNotNull() & F.col("_y").isNotNull())
        target = part.where(F.col("role") != "train")
        if train.isEmpty():
            pred = target.withColumn("_p", F.lit(None).cast("double"))
        else:
            pred = tree.copy().fit(train).transform(target)
        pred = pred.withColumn("prediction", F.when(F.col("_mean") <= 0, 0.0).otherwise(
            F.greatest(F.lit(0.0), F.col("_p") * F.col("_scale"))))
        return pred.drop("_p", "_x", "_y", "_mean", "_scale", "_lag12", "_sin", "_cos", "t")

    out = None
    for pred in side_by_side(df.sparkSession, [partial(predicted, f, group) for f in folds for group in groups]):
        out = pred if out is None else out.unionByName(pred)
    return out


def holdout_rows(series: DataFrame, keys: Sequence[str], holdout: int = 12) -> DataFrame:
    """All but the last `holdout` months as train, the rest as 'test'."""
    last = Window.partitionBy(*keys)
    s = series.withColumn("_back", F.months_between(F.max("month").over(last), "month").cast("int"))
    return s.withColumn("role", F.when(F.col("_back") >= holdout, "train").otherwise("test")).drop("_back")


def fit_any(df: DataFrame, keys: Sequence[str], model: str, value: str = "value") -> DataFrame:
    """Predictions of one of the six series models for the non-train rows."""
    if model in ("random_forest", "gradient_boosting"):
        fold = "fold" if "fold" in keys else None
        return pooled_trees(df, keys, model, value, fold=fold)
    return SERIES_FITTERS[model](df, keys, value)
