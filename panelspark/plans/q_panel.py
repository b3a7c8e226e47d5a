"""Evaluation queries over the feature panel with closed-form predictors
(A14, A16-A19, A22, A24, C08, K03-K05, K07, M17-M21, W08-W10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.operators import evaluate, metrics, panel
from panelspark.plans.catalog import register
from panelspark.plans.oracle_sql import CONFORMAL, PREDS, features_sql, splits_sql
from panelspark.plans.q_flow import features_of

PREDICTORS = ("lag_12_baseline", "trailing_mean_12", "last_value")


def preds_of(spark: SparkSession, sf: str, split: str | None = "test") -> DataFrame:
    s = panel.time_splits(features_of(spark, sf))
    if split:
        s = s.where(F.col("split") == split)
    return s.select("entity", "month", "split", F.col("ev_transactions").alias("actual"),
                    F.col("lag_12").alias("lag_12_baseline"), F.col("lag_12_mean").alias("trailing_mean_12"),
                    F.col("lag_1").alias("last_value"))


def errors_of(spark, sf):
    return evaluate.entity_errors(preds_of(spark, sf), *PREDICTORS)


def conformal_of(spark, sf):
    return evaluate.conformal_intervals(features_of(spark, sf), "lag_12")


def r(df, cols, d=6):
    return df.withColumns({c: F.round(c, d) for c in cols})


ERR_SQL = """errs AS (
    SELECT entity, CAST(sum(actual) AS BIGINT) AS total_transactions, round(avg(actual), 2) AS mean_monthly_transactions,
      {cols}
    FROM preds WHERE split = 'test' GROUP BY entity),
errors AS (
    SELECT *, lag_12_baseline_rmse AS baseline_rmse, trailing_mean_12_rmse AS statistical_rmse, last_value_rmse AS ml_rmse,
           round(CASE WHEN lag_12_baseline_rmse > 0 THEN (lag_12_baseline_rmse - last_value_rmse) / lag_12_baseline_rmse * 100.0 END, 2)
             AS ml_improvement_vs_baseline_pct,
           round(CASE WHEN lag_12_baseline_rmse > 0 THEN (lag_12_baseline_rmse - trailing_mean_12_rmse) / lag_12_baseline_rmse * 100.0 END, 2)
             AS statistical_improvement_vs_baseline_pct
    FROM errs)""".format(cols=",\n      ".join(
    f"round(sqrt(avg((actual - {m}) ^ 2)), 2) AS {m}_rmse, round(avg(abs(actual - {m})), 2) AS {m}_mae, "
    f"round(CASE WHEN sum(actual) > 0 THEN sum(abs(actual - {m})) / sum(actual) * 100.0 END, 2) AS {m}_wape_pct"
    for m in PREDICTORS))


@register("a14_dispersion_report", splits_sql("""
    SELECT round(avg(ev_transactions), 2) AS training_mean_count, round(var_samp(ev_transactions), 2) AS training_variance,
           round(var_samp(ev_transactions) / greatest(avg(ev_transactions), 1e-9), 2) AS pooled_variance_to_mean,
           (SELECT round(quantile_cont(ratio, 0.5), 2) FROM r) AS median_within_entity_variance_to_mean,
           (SELECT count(*) FROM r WHERE ratio > 1) AS entities_with_variance_above_mean,
           (SELECT count(*) FROM r) AS entities_with_defined_ratio
    FROM splits WHERE split = 'train'""", """r AS (
    SELECT v / NULLIF(m, 0.0) AS ratio FROM (
        SELECT entity, avg(ev_transactions) AS m, var_samp(ev_transactions) AS v FROM splits WHERE split = 'train' GROUP BY entity)
    WHERE v / NULLIF(m, 0.0) IS NOT NULL)"""))
def a14_dispersion_report(spark, sf):
    """A14 / M21 on the training split."""
    train = panel.time_splits(features_of(spark, sf)).where(F.col("split") == "train")
    return evaluate.dispersion_report(train)


@register("a16_entity_errors", splits_sql("SELECT * FROM errors", PREDS, ERR_SQL))
def a16_entity_errors(spark, sf):
    return errors_of(spark, sf)


@register("a17_macro_summary", splits_sql("""
    SELECT model, round(avg(mae), 2) AS mean_entity_mae, round(quantile_cont(mae, 0.5), 2) AS median_entity_mae,
           round(quantile_cont(mae, 0.25), 2) AS mae_p25, round(quantile_cont(mae, 0.75), 2) AS mae_p75,
           round(avg(wape), 2) AS mean_entity_wape_pct, round(quantile_cont(wape, 0.5), 2) AS median_entity_wape_pct,
           round(quantile_cont(wape, 0.25), 2) AS wape_p25, round(quantile_cont(wape, 0.75), 2) AS wape_p75
    FROM (SELECT 'lag_12_baseline' AS model, lag_12_baseline_mae AS mae, lag_12_baseline_wape_pct AS wape FROM errors
          UNION ALL SELECT 'trailing_mean_12', trailing_mean_12_mae, trailing_mean_12_wape_pct FROM errors
          UNION ALL SELECT 'last_value', last_value_mae, last_value_wape_pct FROM errors)
    GROUP BY model""", PREDS, ERR_SQL))
def a17_macro_summary(spark, sf):
    return evaluate.macro_summary(errors_of(spark, sf), PREDICTORS)


@register("a18_win_counts", splits_sql("""
    SELECT count_if(ml_rmse < baseline_rmse) AS ml_better_entities,
           count_if(ml_rmse >= baseline_rmse) AS baseline_better_or_tied_entities,
           count_if(statistical_rmse < baseline_rmse) AS statistical_better_entities FROM errors""", PREDS, ERR_SQL))
def a18_win_counts(spark, sf):
    return evaluate.win_counts(errors_of(spark, sf))


def spearman_sql(x: str, y: str, source: str) -> str:
    """rho by window ranks; p by the midpoint rule over 20,000 strips and the engine's own log gamma."""
    def ranks(c):
        return f"(rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0) / count(*) OVER ()"
    return f"""
    SELECT round(exact, 3) AS rho, n,
           round(greatest(0, 1 - 2 / sqrt(pi()) * exp(lgamma((n - 1) / 2.0) - lgamma((n - 2) / 2.0))
                 * sum(power(cos((i + 0.5) * asin(abs(exact)) / 20000), n - 3)) * asin(abs(exact)) / 20000), 4) AS p
    FROM (SELECT corr(rx, ry) AS exact, count(*) AS n
          FROM (SELECT {ranks(x)} AS rx, {ranks(y)} AS ry FROM {source} WHERE {x} IS NOT NULL AND {y} IS NOT NULL)), range(20000) strips(i)
    GROUP BY exact, n"""


@register("m19_size_vs_improvement", splits_sql("""
    SELECT round(corr(rx, ry), 3) AS rho, count(*) AS n FROM (
        SELECT (rank() OVER (ORDER BY mean_monthly_transactions)
                + (count(*) OVER (PARTITION BY mean_monthly_transactions) - 1) / 2.0) / count(*) OVER () AS rx,
               (rank() OVER (ORDER BY ml_improvement_vs_baseline_pct)
                + (count(*) OVER (PARTITION BY ml_improvement_vs_baseline_pct) - 1) / 2.0) / count(*) OVER () AS ry
        FROM errors WHERE ml_improvement_vs_baseline_pct IS NOT NULL)""", PREDS, ERR_SQL))
def m19_size_vs_improvement(spark, sf):
    """Spearman(entity size, ML gain) (M19); the p-value is in m19_spearman_p."""
    return evaluate.spearman(errors_of(spark, sf), "mean_monthly_transactions", "ml_improvement_vs_baseline_pct",
                             "entity").select("rho", "n")


@register("m19_spearman_p", splits_sql(spearman_sql("mean_monthly_transactions", "ml_improvement_vs_baseline_pct", "errors"),
                                       PREDS, ERR_SQL))
def m19_spearman_p(spark, sf):
    return evaluate.spearman(errors_of(spark, sf), "mean_monthly_transactions", "ml_improvement_vs_baseline_pct", "entity")


DRIVERS_SQL = """drivers AS (
    SELECT p.entity, p.month, p.actual, p.lag_12_baseline AS baseline, p.last_value AS ml,
           abs(p.actual - p.lag_12_baseline) AS baseline_absolute_error, abs(p.actual - p.last_value) AS ml_absolute_error,
           abs(p.actual - p.lag_12_baseline) - abs(p.actual - p.last_value) AS ml_error_reduction,
           abs(p.actual - p.lag_12_baseline) / (p.lag_12_baseline + 1.0) * 100.0 AS absolute_yoy_change_pct,
           CAST(month(p.month) AS BIGINT) AS month_of_year, s.volume_group AS market_segment
    FROM preds p LEFT JOIN strata s USING (entity) WHERE p.split = 'test')"""


def drivers_of(spark, sf):
    seg = evaluate.volume_strata(evaluate.conformal_periods(features_of(spark, sf))
                                 .where(F.col("period").isin("train", "selection")))
    return evaluate.error_drivers(preds_of(spark, sf), seg.select("entity", F.col("volume_group").alias("market_segment")),
                                  "lag_12_baseline", "last_value")


@register("m20_error_drivers", splits_sql("""
    SELECT entity, month, actual, baseline, ml, baseline_absolute_error, ml_absolute_error, ml_error_reduction,
           round(absolute_yoy_change_pct, 6) AS absolute_yoy_change_pct, month_of_year, market_segment FROM drivers""",
                                          PREDS, CONFORMAL, DRIVERS_SQL))
def m20_error_drivers(spark, sf):
    """Row-level drivers; the volume tercile plays the market segment."""
    return r(drivers_of(spark, sf), ["absolute_yoy_change_pct"])


@register("m20_spearman", splits_sql(spearman_sql("absolute_yoy_change_pct", "ml_error_reduction", "drivers"),
                                     PREDS, CONFORMAL, DRIVERS_SQL))
def m20_spearman(spark, sf):
    """Size of the yearly change against the ML gain, over (entity, month) rows."""
    return evaluate.spearman(drivers_of(spark, sf), "absolute_yoy_change_pct", "ml_error_reduction", ["entity", "month"])


@register("q08_improvement_sides", splits_sql("""
    SELECT CASE WHEN ml_improvement_vs_baseline_pct > 0 THEN 'above_zero' ELSE 'not_above_zero' END AS side, count(*) AS entities,
           round(count(*) * 100.0 / (SELECT count(*) FROM errors), 2) AS share_pct
    FROM errors GROUP BY 1""", PREDS, ERR_SQL))
def q08_improvement_sides(spark, sf):
    return evaluate.improvement_sides(errors_of(spark, sf))


@register("a19_mean_reduction", splits_sql("""
    SELECT 'month' AS dimension, CAST(month_of_year AS VARCHAR) AS value, round(avg(ml_error_reduction), 2) AS mean_ml_error_reduction
    FROM drivers GROUP BY month_of_year
    UNION ALL SELECT 'segment', market_segment, round(avg(ml_error_reduction), 2) FROM drivers GROUP BY market_segment""",
                                           PREDS, CONFORMAL, DRIVERS_SQL))
def a19_mean_reduction(spark, sf):
    return evaluate.mean_reduction(drivers_of(spark, sf))


@register("w08_volume_strata", features_sql(
    "SELECT entity, round(mean_volume, 6) AS mean_volume, position, entities, volume_group, representative FROM strata",
    CONFORMAL))
def w08_volume_strata(spark, sf):
    fitting = evaluate.conformal_periods(features_of(spark, sf)).where(F.col("period").isin("train", "selection"))
    return r(evaluate.volume_strata(fitting), ["mean_volume"])


@register("w09_median_entity", features_sql("SELECT entity, position, entities FROM strata WHERE representative", CONFORMAL))
def w09_median_entity(spark, sf):
    fitting = evaluate.conformal_periods(features_of(spark, sf)).where(F.col("period").isin("train", "selection"))
    return evaluate.volume_strata(fitting).where("representative").select("entity", "position", "entities")


@register("w10_conformal_quantile", features_sql("SELECT volume_group, level, q, n FROM cq", CONFORMAL))
def w10_conformal_quantile(spark, sf):
    data = evaluate.conformal_periods(features_of(spark, sf))
    strata = evaluate.volume_strata(data.where(F.col("period").isin("train", "selection"))).select("entity", "volume_group")
    cal = data.where(F.col("period") == "calibration").join(strata, "entity") \
        .withColumn("absolute_error", F.abs(F.col("ev_transactions") - F.col("lag_12")))
    return evaluate.conformal_quantiles(cal).select("volume_group", "level", "q", "n")


@register("m17_conformal_intervals", features_sql("SELECT * FROM intervals", CONFORMAL))
def m17_conformal_intervals(spark, sf):
    """Split-conformal intervals around the lag-12 predictor (the model
    choice on the selection block is in the R-class m17 query)."""
    return conformal_of(spark, sf)[0]


@register("a22_interval_coverage", features_sql("""
    SELECT lv.tag AS interval, COALESCE(volume_group, 'all') AS volume_group, lv.p AS target_coverage,
           round(avg(CASE WHEN lv.tag = '80%' THEN CAST(actual >= lower_80 AND actual <= upper_80 AS DOUBLE)
                          ELSE CAST(actual >= lower_95 AND actual <= upper_95 AS DOUBLE) END), 4) AS observed_coverage,
           round(avg(CASE WHEN lv.tag = '80%' THEN upper_80 - lower_80 ELSE upper_95 - lower_95 END), 2) AS mean_width,
           count(*) AS rows
    FROM intervals, (VALUES ('80%', 0.8::DOUBLE), ('95%', 0.95::DOUBLE)) lv(tag, p)
    GROUP BY GROUPING SETS ((lv.tag, lv.p, volume_group), (lv.tag, lv.p))""", CONFORMAL))
def a22_interval_coverage(spark, sf):
    return conformal_of(spark, sf)[1]


@register("a24_prediction_rollups", splits_sql("""
    SELECT 'month' AS level, CAST(month AS VARCHAR) AS key, sum(actual) AS actual, sum(lag_12_baseline) AS predicted,
           round(avg(abs(actual - lag_12_baseline)), 6) AS mae FROM preds WHERE split = 'test' GROUP BY month
    UNION ALL SELECT 'entity', entity, sum(actual), sum(lag_12_baseline), round(avg(abs(actual - lag_12_baseline)), 6)
    FROM preds WHERE split = 'test' GROUP BY entity""", PREDS))
def a24_prediction_rollups(spark, sf):
    p = preds_of(spark, sf).withColumn("_e", F.abs(F.col("actual") - F.col("lag_12_baseline")))
    g = p.groupingSets([["month"], ["entity"]], "month", "entity").agg(
        F.sum("actual").alias("actual"), F.sum("lag_12_baseline").alias("predicted"), F.round(F.avg("_e"), 6).alias("mae"),
        F.grouping("month").alias("_gm"))
    return g.select(F.when(F.col("_gm") == 0, "month").otherwise("entity").alias("level"),
                    F.when(F.col("_gm") == 0, F.col("month").cast("string")).otherwise(F.col("entity")).alias("key"),
                    "actual", "predicted", "mae")


SCORES_SQL = """val_scores AS (
    SELECT model, round(sqrt(avg((actual - p) ^ 2)), 2) AS rmse FROM (
        SELECT actual, 'lag_12_baseline' AS model, lag_12_baseline AS p FROM preds WHERE split = 'validation'
        UNION ALL SELECT actual, 'trailing_mean_12', trailing_mean_12 FROM preds WHERE split = 'validation'
        UNION ALL SELECT actual, 'last_value', last_value FROM preds WHERE split = 'validation') GROUP BY model)"""


@register("k04_best_by", splits_sql("""
    SELECT model AS best_model FROM val_scores
    QUALIFY row_number() OVER (ORDER BY rmse, CASE model WHEN 'lag_12_baseline' THEN 1 WHEN 'trailing_mean_12' THEN 2 ELSE 3 END) = 1""", PREDS, SCORES_SQL))
def k04_best_by(spark, sf):
    """Model selected on the validation split (ties: earlier candidate)."""
    scores = metrics.score_models(preds_of(spark, sf, "validation"), "actual", PREDICTORS)
    return evaluate.best_by(scores, "rmse", PREDICTORS)


@register("k05_rank_by", splits_sql("""
    SELECT entity, last_value_rmse AS metric, rank() OVER (ORDER BY last_value_rmse DESC) AS position
    FROM errors WHERE last_value_rmse IS NOT NULL QUALIFY position <= 10""", PREDS, ERR_SQL))
def k05_rank_by(spark, sf):
    """Leaderboard of entities by a chosen metric and direction, top 10
    (the limit is the feature), NULL metrics dropped."""
    from panelspark.operators.order_stats import rank_min
    e = errors_of(spark, sf).select("entity", F.col("last_value_rmse").alias("metric")).where(F.col("metric").isNotNull())
    return rank_min(e, "metric", "position").where(F.col("position") <= 10)


@register("k03_top_bottom", splits_sql("""
    SELECT DISTINCT entity FROM (
        SELECT entity FROM errors WHERE ml_improvement_vs_baseline_pct IS NOT NULL
        QUALIFY row_number() OVER (ORDER BY ml_improvement_vs_baseline_pct, entity) <= 10
        UNION ALL
        SELECT entity FROM errors WHERE ml_improvement_vs_baseline_pct IS NOT NULL
        QUALIFY row_number() OVER (ORDER BY ml_improvement_vs_baseline_pct DESC, entity) <= 10)""", PREDS, ERR_SQL))
def k03_top_bottom(spark, sf):
    """Bottom-10 and top-10 entities by ML improvement, de-duplicated."""
    from panelspark.operators.order_stats import row_number
    e = errors_of(spark, sf).where(F.col("ml_improvement_vs_baseline_pct").isNotNull()).select("entity", "ml_improvement_vs_baseline_pct")
    lo = row_number(e, [F.col("ml_improvement_vs_baseline_pct").asc(), F.col("entity").asc()], "rn").where("rn <= 10")
    hi = row_number(e, [F.col("ml_improvement_vs_baseline_pct").desc(), F.col("entity").asc()], "rn").where("rn <= 10")
    return lo.select("entity").unionByName(hi.select("entity")).distinct()
