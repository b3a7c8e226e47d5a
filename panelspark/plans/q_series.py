"""Per-series forecasting queries."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.operators import evaluate, metrics, models, panel
from panelspark.plans.catalog import register
from panelspark.plans.memo import remember
from panelspark.plans.oracle_sql import flow_sql
from panelspark.plans.q_flow import flow_of
from panelspark.session import cut_lineage, side_by_side

MIN_HISTORY = 72  # the binding's series span 80 months; the library default is 84
CLOSED_FORM = ("seasonal_naive", "linear", "polynomial_2")


def series_of(spark: SparkSession, sf: str, min_history: int = MIN_HISTORY, flow: DataFrame | None = None) -> DataFrame:
    """Entity series (each over its own first..last month, gaps = 0) plus the
    statewide total series; series shorter than `min_history` are left out."""
    flow = flow_of(spark, sf) if flow is None else flow
    ent = panel.densify_panel(flow, per_entity_bounds=True).select(
        F.col("entity").alias("series"), "month", F.col("ev_transactions").alias("value"))
    state = flow.groupBy("month").agg(F.sum("ev_transactions").alias("ev_transactions")).withColumn("entity", F.lit("statewide"))
    state = panel.densify_panel(state, per_entity_bounds=True).select(
        F.col("entity").alias("series"), "month", F.col("ev_transactions").alias("value"))
    both = ent.unionByName(state)
    lengths = both.groupBy("series").agg(F.count(F.lit(1)).alias("_len")).where(F.col("_len") >= min_history)
    # read by every model (and by several branches of each fit): write once
    return cut_lineage(both.join(lengths.select("series"), "series", "left_semi"))


def forecast(spark, sf, model: str) -> DataFrame:
    rows = models.future_rows(series_of(spark, sf), ["series"])
    pred = models.SERIES_FITTERS[model](rows, ["series"])
    return pred.select("series", "month", F.bround("prediction", 0).cast("bigint").alias("prediction"))


def fold_rows(spark, sf) -> DataFrame:
    return cut_lineage(panel.rolling_folds(series_of(spark, sf), series_key="series"))


def fold_predictions(spark, sf, model: str, folds: DataFrame | None = None) -> DataFrame:
    folds = fold_rows(spark, sf) if folds is None else folds
    pred = models.SERIES_FITTERS[model](folds, ["series", "fold"])
    return pred.withColumn("model", F.lit(model))


SERIES_SQL = """ent_bounds AS (SELECT entity, min(month) AS lo, max(month) AS hi FROM flow GROUP BY entity),
ent_grid AS (SELECT entity, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month FROM ent_bounds),
state AS (SELECT month, sum(ev_transactions) AS v FROM flow GROUP BY month),
state_grid AS (SELECT CAST(unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS DATE) AS month FROM state),
all_series AS (
    SELECT g.entity AS series, g.month, COALESCE(f.ev_transactions, 0.0) AS value
    FROM ent_grid g LEFT JOIN flow f ON f.entity = g.entity AND f.month = g.month
    UNION ALL
    SELECT 'statewide', g.month, COALESCE(s.v, 0.0) FROM state_grid g LEFT JOIN state s ON s.month = g.month),
series AS (SELECT * FROM all_series WHERE series IN (SELECT series FROM all_series GROUP BY series HAVING count(*) >= 72))"""


def fit_sql(src: str, keys: str, model: str) -> str:
    """Oracle fit of one closed-form model: `src` has (keys, month, value,
    role, t); output (keys, month, value, role, prediction) for non-train rows."""
    if model == "seasonal_naive":
        return f"""SELECT s.{keys.replace(', ', ', s.')}, s.month, s.value, s.role, greatest(0.0, tr.value) AS prediction
            FROM {src} s LEFT JOIN {src} tr ON {' AND '.join(f'tr.{k} = s.{k}' for k in keys.split(', '))}
                 AND tr.role = 'train' AND tr.month = CAST(s.month - INTERVAL 12 MONTH AS DATE)
            WHERE s.role <> 'train'"""
    if model == "linear":
        return f"""SELECT s.{keys.replace(', ', ', s.')}, s.month, s.value, s.role, greatest(0.0, c.a + c.b * s.t) AS prediction
            FROM {src} s JOIN (SELECT {keys}, regr_slope(value, t) AS b, regr_intercept(value, t) AS a FROM {src}
                               WHERE role = 'train' AND t >= 12 GROUP BY {keys}) c USING ({keys})
            WHERE s.role <> 'train'"""
    if model == "polynomial_2":
        d = lambda a, b, c, d_, e, f, g, h, i: f"(({a}) * (({e}) * ({i}) - ({f}) * ({h})) - ({b}) * (({d_}) * ({i}) - ({f}) * ({g})) + ({c}) * (({d_}) * ({h}) - ({e}) * ({g})))"  # noqa: E731,E501
        D = d("s0", "s1", "s2", "s1", "s2", "s3", "s2", "s3", "s4")
        b0 = d("r0", "s1", "s2", "r1", "s2", "s3", "r2", "s3", "s4")
        b1 = d("s0", "r0", "s2", "s1", "r1", "s3", "s2", "r2", "s4")
        b2 = d("s0", "s1", "r0", "s1", "s2", "r1", "s2", "s3", "r2")
        return f"""SELECT s.{keys.replace(', ', ', s.')}, s.month, s.value, s.role,
                   greatest(0.0, q.b0 + q.b1 * (s.t - q.c) + q.b2 * (s.t - q.c) * (s.t - q.c)) AS prediction
            FROM {src} s JOIN (
                SELECT {keys}, c, {b0} / {D} AS b0, {b1} / {D} AS b1, {b2} / {D} AS b2 FROM (
                    SELECT {keys}, c, CAST(count(*) AS DOUBLE) AS s0, sum(u) AS s1, sum(u * u) AS s2, sum(u * u * u) AS s3,
                           sum(u * u * u * u) AS s4, sum(value) AS r0, sum(u * value) AS r1, sum(u * u * value) AS r2
                    FROM (SELECT *, t - avg(t) OVER (PARTITION BY {keys}) AS u, avg(t) OVER (PARTITION BY {keys}) AS c
                          FROM {src} WHERE role = 'train' AND t >= 12)
                    GROUP BY {keys}, c)) q USING ({keys})
            WHERE s.role <> 'train'"""
    raise KeyError(model)


FUTURE_SQL = """fut AS (
    SELECT series, month, value, role, CAST(datediff('month', min(month) OVER (PARTITION BY series), month) AS DOUBLE) AS t FROM (
        SELECT series, month, value, 'train' AS role FROM series
        UNION ALL
        SELECT series, CAST(unnest(generate_series(max(month) + INTERVAL 1 MONTH, max(month) + INTERVAL 12 MONTH,
                                                   INTERVAL 1 MONTH)) AS DATE), NULL, 'future' FROM series GROUP BY series))"""

FOLDS_SQL = """sl AS (SELECT *, max(month) OVER (PARTITION BY series) AS last FROM series),
folds_raw AS (
    SELECT s.series, f.fold, s.month, s.value,
           CASE WHEN datediff('month', s.month, s.last) > 12 + (3 - f.fold) * 12 + 11 THEN 'train'
                WHEN datediff('month', s.month, s.last) >= 12 + (3 - f.fold) * 12 THEN 'validation' END AS role
    FROM sl s, (VALUES (1), (2), (3)) f(fold)),
folds AS (
    SELECT series, fold, month, value, role,
           CAST(datediff('month', min(CASE WHEN role = 'train' THEN month END) OVER (PARTITION BY series, fold), month) AS DOUBLE) AS t
    FROM folds_raw WHERE role IS NOT NULL)"""


def series_sql(body, *extra):
    return flow_sql(body, SERIES_SQL, *extra)


@register("c07_rolling_folds", series_sql("SELECT series, fold, month, value, role FROM folds", FOLDS_SQL))
def c07_rolling_folds(spark, sf):
    return panel.rolling_folds(series_of(spark, sf), series_key="series")


for _id, _m in (("m01", "seasonal_naive"), ("m02", "linear"), ("m03", "polynomial_2")):
    def _mk(m):
        return lambda spark, sf: forecast(spark, sf, m)
    _name = {"seasonal_naive": "m01_seasonal_naive", "linear": "m02_linear_trend", "polynomial_2": "m03_polynomial_2"}[_m]
    register(_name, series_sql(
        f"SELECT series, month, CAST(round_even(prediction, 0) AS BIGINT) AS prediction FROM ({fit_sql('fut', 'series', _m)})",
        FUTURE_SQL))(_mk(_m))


#: The ridge by rounds: month effects from intercept and slope, then these from the effects, on a centred index.
RIDGE_SQL = """fr AS (SELECT series, month(month) AS m, value, avg(t) OVER (PARTITION BY series) AS c,
                     t - avg(t) OVER (PARTITION BY series) AS u FROM fut WHERE role = 'train' AND t >= 12),
mon AS (SELECT series, m, CAST(count(*) AS DOUBLE) AS n, sum(u) AS su, sum(value) AS sy FROM fr GROUP BY series, m),
tot AS (SELECT series, any_value(c) AS c, CAST(count(*) AS DOUBLE) AS n, sum(u * u) AS suu, sum(u * value) AS suy, sum(value) AS sy
        FROM fr GROUP BY series),
packed AS (SELECT tot.*, l FROM tot JOIN (SELECT series, list({'n': n, 'su': su, 'sy': sy}) AS l FROM mon GROUP BY series) USING (series)),
rounds(series, k, a, b) AS (
    SELECT series, 0, CAST(0 AS DOUBLE), CAST(0 AS DOUBLE) FROM packed
    UNION ALL
    SELECT r.series, k + 1,
           (sy - list_sum(list_transform(l, lambda x: x.n * (x.sy - x.n * a - x.su * b) / (x.n + 100)))) / n,
           (suy - list_sum(list_transform(l, lambda x: x.su * (x.sy - x.n * a - x.su * b) / (x.n + 100)))) / (suu + 100)
    FROM rounds r JOIN packed p ON p.series = r.series WHERE k < 60),
ridge AS (SELECT f.series, f.month, greatest(0.0, a + b * (f.t - c) + (mon.sy - mon.n * a - mon.su * b) / (mon.n + 100)) AS prediction
          FROM fut f JOIN rounds r ON r.series = f.series AND r.k = 60 JOIN tot ON tot.series = f.series
               JOIN mon ON mon.series = f.series AND mon.m = month(f.month) WHERE f.role <> 'train')"""


@register("m04_seasonal_ridge", series_sql("SELECT series, month, CAST(round_even(prediction, 0) AS BIGINT) AS prediction FROM ridge",
                                           FUTURE_SQL, RIDGE_SQL).replace("WITH ", "WITH RECURSIVE ", 1))
def m04_seasonal_ridge(spark, sf):
    """Ridge on t + month dummies per series, in closed form; the SQL finds the same fit by rounds."""
    return forecast(spark, sf, "seasonal_ridge")


FOLD_RMSE_SQL = "fold_rmse AS (" + " UNION ALL ".join(
    f"SELECT series, fold, '{m}' AS model, round(sqrt(avg((value - prediction) ^ 2)), 2) AS rmse "
    f"FROM ({fit_sql('folds', 'series, fold', m)}) GROUP BY series, fold" for m in CLOSED_FORM) + ")"


@register("m13_fold_scores", series_sql("SELECT * FROM fold_rmse", FOLDS_SQL, FOLD_RMSE_SQL))
def m13_fold_scores(spark, sf):
    """RMSE per series, model and fold of the closed-form models."""
    folds = fold_rows(spark, sf)  # one fold table for all three models
    parts = [fold_predictions(spark, sf, m, folds) for m in CLOSED_FORM]
    pred = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return pred.groupBy("series", "fold", "model").agg(
        F.round(F.sqrt(F.avg((F.col("value") - F.col("prediction")) ** 2)), 2).alias("rmse"))


@register("m13_model_selection", series_sql("""
    SELECT series, model AS best_model, mean_rmse AS best_mean_rmse
    FROM (SELECT series, model, round(avg(rmse), 2) AS mean_rmse FROM fold_rmse GROUP BY series, model)
    QUALIFY row_number() OVER (PARTITION BY series ORDER BY mean_rmse,
                               CASE model WHEN 'seasonal_naive' THEN 1 WHEN 'linear' THEN 2 ELSE 3 END) = 1""", FOLDS_SQL, FOLD_RMSE_SQL))
def m13_model_selection(spark, sf):
    """Winner per series: mean of the rounded fold RMSEs, ties to the earlier model."""
    folds = cut_lineage(m13_fold_scores(spark, sf))  # series x model x fold scores, read twice below
    means = folds.groupBy("series", "model").agg(F.round(F.avg("rmse"), 2).alias("mean_rmse"))
    best = evaluate.best_by(means, "mean_rmse", CLOSED_FORM, by=["series"])
    return best.join(means.groupBy("series").agg(F.min("mean_rmse").alias("best_mean_rmse")), "series")


def _all_models(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Predictions of the six models, one below the other."""
    fits = side_by_side(rows.sparkSession, [partial(models.fit_any, rows, keys, m) for m in models.SERIES_ALL])
    out = None
    for m, p in zip(models.SERIES_ALL, fits):
        p = p.withColumn("model", F.lit(m))
        out = p if out is None else out.unionByName(p)
    return cut_lineage(out)


def cv_all(spark, sf) -> DataFrame:
    """Fold RMSEs of the six models and their mean."""
    def build():
        p = _all_models(fold_rows(spark, sf), ["series", "fold"])
        fold_rmse = p.groupBy("series", "model", "fold").agg(
            F.round(F.sqrt(F.avg((F.col("value") - F.col("prediction")) ** 2)), 2).alias("rmse"))
        return cut_lineage(fold_rmse.groupBy("series", "model").agg(
            F.round(F.avg("rmse"), 2).alias("mean_rmse"), F.sort_array(F.collect_list(F.struct("fold", "rmse"))).alias("fold_rmse")))
    return remember(spark, sf, "series_cv", build)


def winners_all(spark, sf) -> DataFrame:
    return evaluate.best_by(cv_all(spark, sf), "mean_rmse", models.SERIES_ALL, by=["series"])


def holdout_all(spark, sf) -> DataFrame:
    def build():
        return _all_models(cut_lineage(models.holdout_rows(series_of(spark, sf), ["series"])), ["series"])
    return remember(spark, sf, "series_holdout", build)


@register("m13_cv_scores_all_models")
def m13_cv_scores_all_models(spark, sf):
    return cv_all(spark, sf)


@register("m13_model_selection_all")
def m13_model_selection_all(spark, sf):
    """Winner per series: mean of the rounded fold RMSEs, ties to the earlier model."""
    return winners_all(spark, sf)


@register("m13_holdout_predictions")
def m13_holdout_predictions(spark, sf):
    """Each model's prediction of each series' last 12 months, beside the value."""
    return holdout_all(spark, sf).select("series", "month", "model", "value", "prediction")


@register("m13_holdout_scores")
def m13_holdout_scores(spark, sf):
    wide = holdout_all(spark, sf).groupBy("series", "month", "value").pivot("model", list(models.SERIES_ALL)).agg(F.first("prediction"))
    return metrics.score_models(wide, "value", models.SERIES_ALL, by=["series"])


@register("m14_forecast_all_series")
def m14_forecast_all_series(spark, sf):
    """12-month forecasts of the six models and the CV-selected one for the
    statewide series and every entity series with enough history."""
    def ahead():
        return _all_models(cut_lineage(models.future_rows(series_of(spark, sf), ["series"])), ["series"])

    future, winners = side_by_side(spark, [ahead, partial(winners_all, spark, sf)])
    long = future.select("series", "month", "model", F.bround("prediction", 0).cast("bigint").alias("prediction"))
    selected = long.join(winners, "series").where(F.col("model") == F.col("best_model"))
    return long.unionByName(selected.select("series", "month", F.lit("selected").alias("model"), "prediction"))
