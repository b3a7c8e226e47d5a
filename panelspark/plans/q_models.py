"""Pooled panel model queries (M05-M09, M15-M18, K07, C08). Rows-only class:
tree ensembles and iterative GLM fits are checked by properties in tests."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.operators import evaluate, metrics, panel
from panelspark.operators import panel_models as pm
from panelspark.plans.catalog import register
from panelspark.plans.memo import remember as _memo
from panelspark.plans.oracle_sql import features_sql
from panelspark.plans.q_flow import features_of
from panelspark.session import cut_lineage, side_by_side

MODEL_NAMES = ("lag_12_baseline", "poisson_glm", "negative_binomial", "random_forest", "gradient_boosting")
STATISTICAL = ("poisson_glm", "negative_binomial")
ML = ("random_forest", "gradient_boosting")

# The cumulative feature sets of the ablation study.
FEATURE_SETS = {
    "A: calendar": ["month_sin", "month_cos", "month_index"],
    "B: + prior year": ["month_sin", "month_cos", "month_index", "lag_12"],
    "C: + prior month": ["month_sin", "month_cos", "month_index", "lag_12", "lag_1"],
    "D: + trailing averages": ["month_sin", "month_cos", "month_index", "lag_12", "lag_1", "lag_3_mean", "lag_12_mean"],
    "E: + entity scale": ["month_sin", "month_cos", "month_index", "lag_12", "lag_1", "lag_3_mean", "lag_12_mean", "entity_scale"],
    "F: full history": list(panel.FEATURES),
}

def predict_one(train: DataFrame, target: DataFrame, name: str, fitted=None) -> DataFrame:
    """`target` with a column `name`: the predictions of that model alone, fitted on `train` unless given `fitted`, the count
    models for a statistical name, the trees for another."""
    if name == "lag_12_baseline":
        return target.withColumn(name, F.col("lag_12"))
    if name in STATISTICAL:
        return pm.predict_count(fitted or pm.fit_count_models(train, with_nb=name == "negative_binomial"), target, name, out=name)
    return pm.predict_tree(fitted or pm.fit_tree(train, name), target, out=name)


def predict_all(train: DataFrame, target: DataFrame, names=MODEL_NAMES) -> tuple[DataFrame, float]:
    """Fit every model on `train`, add one prediction column per model to
    `target` (entity, month, actual, features...)."""
    trees = [n for n in ML if n in names]
    tasks = [partial(pm.fit_tree, train, n) for n in trees]
    if set(names) & set(STATISTICAL):
        tasks.append(partial(pm.fit_count_models, train, with_nb="negative_binomial" in names))
    fits = side_by_side(target.sparkSession, tasks)
    cm = fits[-1] if len(fits) > len(trees) else None
    fitted = {**dict(zip(trees, fits)), **{n: cm for n in STATISTICAL}}
    out = target
    for n in MODEL_NAMES:
        if n in names or n == "lag_12_baseline":
            out = predict_one(train, out, n, fitted.get(n))
    return out, cm.alpha if cm else None


def splits_of(spark: SparkSession, sf: str) -> DataFrame:
    """Feature panel with split labels and `actual`, materialised once per session."""
    def build():
        s = panel.time_splits(features_of(spark, sf)).withColumn("actual", F.col("ev_transactions"))
        return cut_lineage(s)
    return _memo(spark, sf, "splits", build)


PERIODS = {"validation": ("train", "validation"), "historical_final": ("development", "test")}  # fitted on, scored on


def _period(spark: SparkSession, sf: str, period: str) -> tuple[DataFrame, DataFrame]:
    s = splits_of(spark, sf)
    fitted_on, scored_on = PERIODS[period]
    return s.where(F.col("development") if fitted_on == "development" else F.col("split") == fitted_on), s.where(F.col("split") == scored_on)


def count_models_of(spark: SparkSession, sf: str, period: str, with_nb: bool) -> pm.CountModels:
    """The count models of one period, fitted side by side with the other's; the negative binomial only where asked for."""
    def build():
        train = None
        for k, p in enumerate(PERIODS):
            rows = _period(spark, sf, p)[0].withColumn("_fit", F.lit(k))
            train = rows if train is None else train.unionByName(rows)
        return pm.fit_count_models_by(train, "_fit", len(PERIODS), with_nb=with_nb)
    return _memo(spark, sf, f"count_models:{with_nb}", build)[list(PERIODS).index(period)]


def predictions_of(spark: SparkSession, sf: str, period: str, name: str) -> DataFrame:
    """(entity, month, actual, <name>) of one model in one period: nothing else is fitted for it."""
    def build():
        train, target = _period(spark, sf, period)
        cm = count_models_of(spark, sf, period, name == "negative_binomial") if name in STATISTICAL else None
        return cut_lineage(predict_one(train, target, name, cm).select("entity", "month", "actual", name))
    return _memo(spark, sf, f"predictions:{period}:{name}", build)


def _wide(spark: SparkSession, sf: str, period: str) -> DataFrame:
    count_models_of(spark, sf, period, True)  # one fit serves both count models
    out = predictions_of(spark, sf, period, MODEL_NAMES[0])
    for name in MODEL_NAMES[1:]:
        out = out.join(predictions_of(spark, sf, period, name).drop("actual"), ["entity", "month"])
    return out


def panel_evaluation(spark: SparkSession, sf: str) -> dict:
    """Fit on train, score on validation, select; refit on development,
    score on test. Prediction tables are checkpointed once per session."""
    def build():
        splits_of(spark, sf)
        # one fit serves both count models of both periods; the trees' fits need nothing from it or from each other
        side_by_side(spark, [partial(count_models_of, spark, sf, "validation", True),
                             *(partial(predictions_of, spark, sf, period, name) for name in ML for period in PERIODS)])
        vp, tp = (cut_lineage(_wide(spark, sf, period)) for period in PERIODS)
        vs = metrics.score_models(vp, "actual", MODEL_NAMES).withColumn("period", F.lit("validation"))
        ts = metrics.score_models(tp, "actual", MODEL_NAMES).withColumn("period", F.lit("historical_final"))
        scores = cut_lineage(vs.unionByName(ts))
        pick = lambda period, cands: evaluate.best_by(scores.where(F.col("period") == period), "rmse", cands)
        sel = spark.range(1).select(
            pick("validation", MODEL_NAMES).select("best_model").scalar().alias("selected_on_validation"),
            pick("validation", STATISTICAL).select("best_model").scalar().alias("selected_statistical"),
            pick("validation", ML).select("best_model").scalar().alias("selected_ml"),
            pick("historical_final", MODEL_NAMES).select("best_model").scalar().alias("best_on_test"),
            F.round(F.lit(count_models_of(spark, sf, "validation", True).alpha), 5).alias("negative_binomial_alpha_train"),
            F.round(F.lit(count_models_of(spark, sf, "historical_final", True).alpha), 5).alias("negative_binomial_alpha_development"))
        sel = cut_lineage(sel)
        chosen = sel.first()["selected_on_validation"]  # one name: a score-table scalar
        tp = tp.withColumn("selected", F.col(chosen))
        return {"scores": scores, "selection": sel, "test": tp, "validation": vp, "splits": splits_of(spark, sf)}
    return _memo(spark, sf, "panel_evaluation", build)


@register("m15_panel_scores")
def m15_panel_scores(spark, sf):
    return panel_evaluation(spark, sf)["scores"]


@register("m15_panel_selection")
def m15_panel_selection(spark, sf):
    """Selected on validation (overall / statistical / ML) and best on test."""
    return panel_evaluation(spark, sf)["selection"]


@register("m15_test_predictions")
def m15_test_predictions(spark, sf):
    return panel_evaluation(spark, sf)["test"]


@register("m15_state_monthly_score")
def m15_state_monthly_score(spark, sf):
    """Score of the selected model on statewide monthly totals."""
    tp = panel_evaluation(spark, sf)["test"]
    monthly = tp.groupBy("month").agg(F.sum("actual").alias("actual"), F.sum("selected").alias("selected"))
    return metrics.score(monthly, "actual", "selected")


def _model_rows(spark, sf, name):
    return predictions_of(spark, sf, "historical_final", name).withColumnRenamed(name, "prediction")


@register("m05_random_forest")
def m05_random_forest(spark, sf):
    return _model_rows(spark, sf, "random_forest")


@register("m06_gradient_boosting")
def m06_gradient_boosting(spark, sf):
    return _model_rows(spark, sf, "gradient_boosting")


@register("m07_poisson_glm")
def m07_poisson_glm(spark, sf):
    return _model_rows(spark, sf, "poisson_glm")


@register("m09_negative_binomial")
def m09_negative_binomial(spark, sf):
    return _model_rows(spark, sf, "negative_binomial")


@register("m08_nb_alpha")
def m08_nb_alpha(spark, sf):
    """The moment estimates alone: they need the Poisson fits of the two periods, no other model."""
    train, dev = (count_models_of(spark, sf, period, False).alpha for period in PERIODS)
    return spark.range(1).select(F.round(F.lit(train), 5).alias("negative_binomial_alpha_train"),
                                 F.round(F.lit(dev), 5).alias("negative_binomial_alpha_development"))


@register("m16_ablation")
def m16_ablation(spark, sf):
    """Random forest on cumulative feature sets: validation scores and the
    RMSE drop relative to the calendar-only set."""
    def build():
        s = splits_of(spark, sf)
        train, val = s.where(F.col("split") == "train"), s.where(F.col("split") == "validation")
        forests = side_by_side(spark, [partial(pm.fit_tree, train, "random_forest", features=cols) for cols in FEATURE_SETS.values()])
        parts = []
        for (name, cols), forest in zip(FEATURE_SETS.items(), forests):
            p = pm.predict_tree(forest, val, out="prediction")
            sc = metrics.score(p, "actual", "prediction")
            parts.append(sc.select(F.lit(name).alias("feature_set"), F.lit("|".join(cols)).alias("features"), "*"))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        out = cut_lineage(out)
        base = out.where(F.col("feature_set") == "A: calendar").select("rmse").scalar()
        return out.withColumn("improvement_vs_calendar_rmse", F.round(base - F.col("rmse"), 2))
    return _memo(spark, sf, "ablation", build)


ROBUST = ("lag_12_baseline", "poisson_glm", "random_forest")
MIN_TRAIN_MONTHS = 20  # the binding's features begin 12 months after its 80 months do


@register("c08_annual_windows", features_sql("""
    SELECT window_start, role, reason, count(*) AS rows
    FROM memb JOIN (SELECT window_start, CASE WHEN tr < 20 THEN 'few_training_months'
                                              WHEN ev <> 12 * (SELECT count(DISTINCT entity) FROM features) THEN 'incomplete_evaluation'
                                              ELSE 'kept' END AS reason FROM sizes) USING (window_start)
    GROUP BY 1, 2, 3""", """cands AS (
    SELECT DISTINCT month AS window_start FROM features
    WHERE datediff('month', month, (SELECT CAST(max(month) - INTERVAL 11 MONTH AS DATE) FROM features)) % 12 = 0
      AND month > (SELECT min(month) FROM features)
      AND month <= (SELECT CAST(max(month) - INTERVAL 11 MONTH AS DATE) FROM features)),
memb AS (
    SELECT c.window_start, f.month, CASE WHEN f.month < c.window_start THEN 'train' ELSE 'evaluation' END AS role
    FROM features f JOIN cands c ON f.month <= CAST(c.window_start + INTERVAL 11 MONTH AS DATE)),
sizes AS (SELECT window_start, count(DISTINCT CASE WHEN role = 'train' THEN month END) AS tr, count_if(role = 'evaluation') AS ev FROM memb GROUP BY 1)"""))
def c08_annual_windows(spark, sf):
    """Window membership counts per role, skipped windows with their reason (the kept rows feed M18)."""
    w = panel.annual_windows(features_of(spark, sf), min_train_months=MIN_TRAIN_MONTHS, skipped=True)
    return w.groupBy("window_start", "role", "reason").agg(F.count(F.lit(1)).alias("rows"))


@register("m18_temporal_robustness")
def m18_temporal_robustness(spark, sf):
    """Baseline, Poisson and random forest per yearly window (fit on all
    earlier months): RMSE, WAPE, volume and year-over-year change."""
    def build():
        w = cut_lineage(panel.annual_windows(features_of(spark, sf), min_train_months=MIN_TRAIN_MONTHS))
        starts = [r[0] for r in w.select("window_start").distinct().orderBy("window_start").collect()]  # <= #years
        number = F.array_position(F.array(*[F.lit(s) for s in starts]), F.col("window_start")) - 1
        earlier = w.where(F.col("role") == "train")
        poisson, *forests = side_by_side(spark, [
            partial(pm.fit_count_models_by, earlier.withColumn("_fit", number), "_fit", len(starts), with_nb=False),
            *(partial(pm.fit_tree, earlier.where(F.col("window_start") == start), "random_forest") for start in starts)])
        parts = []
        for start, cm, forest in zip(starts, poisson, forests):
            rows = w.where(F.col("window_start") == start)
            train, period = rows.where(F.col("role") == "train"), rows.where(F.col("role") == "evaluation")
            pred = period.withColumn("actual", F.col("ev_transactions"))
            for name in ROBUST:
                pred = predict_one(train, pred, name, forest if name == "random_forest" else cm)
            pred = cut_lineage(pred)
            sc = metrics.score_models(pred, "actual", ROBUST)
            def scalar(c):
                return pred.select(c).scalar()
            parts.append(sc.select(
                "model", "rmse", "wape_pct",
                scalar(F.round(F.avg("actual"), 2)).alias("mean_monthly_entity_transactions"),
                scalar(F.sum("actual").cast("bigint")).alias("actual_total_transactions"),
                scalar(F.round((F.sum("actual") / F.greatest(F.sum("lag_12"), F.lit(1.0)) - 1) * 100, 2)).alias("yoy_change_pct"),
                F.lit(start).cast("date").alias("evaluation_start")))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return cut_lineage(out.withColumn("evaluation_end", F.add_months("evaluation_start", 11)))
    return _memo(spark, sf, "robustness", build)


@register("k07_winner_per_window")
def k07_winner_per_window(spark, sf):
    """Lowest-RMSE model per window, then wins per model."""
    return evaluate.winners_per_window(m18_temporal_robustness(spark, sf), "evaluation_start", "rmse", ROBUST)


def conformal_selected(spark, sf) -> dict:
    """Full split-conformal procedure: the model is chosen on the selection
    block (fit on earlier months), refitted on the fitting period, and its
    calibration residuals give the intervals on the final block."""
    def build():
        data = cut_lineage(evaluate.conformal_periods(features_of(spark, sf)).withColumn("actual", F.col("ev_transactions")))
        train = data.where(F.col("period") == "train")
        sel = data.where(F.col("period") == "selection")
        fitting = data.where(F.col("period").isin("train", "selection"))
        sp, _ = predict_all(train, sel)
        scores = metrics.score_models(cut_lineage(sp), "actual", MODEL_NAMES)
        winner = evaluate.best_by(scores, "rmse", MODEL_NAMES).first()["best_model"]
        target = data.where(F.col("period").isin("calibration", "test"))
        tp, _ = predict_all(fitting, target, (winner,) if winner != "lag_12_baseline" else ("lag_12_baseline",))
        tp = cut_lineage(tp.withColumn("_pred", F.col(winner)))
        iv, cov = evaluate.conformal_intervals(tp.unionByName(fitting.withColumn("_pred", F.lit(None).cast("double")),
                                                              allowMissingColumns=True).drop("period"), "_pred")
        return {"intervals": iv.withColumn("model", F.lit(winner)), "coverage": cov.withColumn("model", F.lit(winner))}
    return _memo(spark, sf, "conformal", build)


@register("m17_conformal_selected")
def m17_conformal_selected(spark, sf):
    return conformal_selected(spark, sf)["intervals"]


@register("a22_coverage_selected")
def a22_coverage_selected(spark, sf):
    return conformal_selected(spark, sf)["coverage"]


@register("m19_entity_error_analysis_models")
def m19_entity_error_analysis_models(spark, sf):
    """Entity error table of the baseline and the statistical / ML models
    selected on validation (A16 with fitted models)."""
    ev = panel_evaluation(spark, sf)
    sel = ev["selection"].first()
    return evaluate.entity_errors(ev["test"], "lag_12_baseline", sel["selected_statistical"], sel["selected_ml"])


@register("m19_spearman_models")
def m19_spearman_models(spark, sf):
    """Spearman(entity size, ML gain over the baseline) with its p-value."""
    return evaluate.spearman(m19_entity_error_analysis_models(spark, sf), "mean_monthly_transactions",
                             "ml_improvement_vs_baseline_pct", "entity")


@register("a17_macro_summary_models")
def a17_macro_summary_models(spark, sf):
    ev = panel_evaluation(spark, sf)
    sel = ev["selection"].first()
    names = ["lag_12_baseline", sel["selected_statistical"], sel["selected_ml"]]
    return evaluate.macro_summary(m19_entity_error_analysis_models(spark, sf), names)


@register("m20_error_drivers_models")
def m20_error_drivers_models(spark, sf):
    """Row-level drivers of the selected ML model's gain, with K-Means segments;
    mean reduction by month and segment (A19)."""
    from panelspark.plans.q_segments import segmented
    ev = panel_evaluation(spark, sf)
    ml = ev["selection"].first()["selected_ml"]
    seg = segmented(spark, sf)[0].select("entity", "market_segment")
    return evaluate.mean_reduction(evaluate.error_drivers(ev["test"], seg, "lag_12_baseline", ml))


@register("a26_headline_insights")
def a26_headline_insights(spark, sf):
    """One row: best test model, ablation RMSE drop from adding the prior
    year, the latest two robustness windows' winners, 80 % coverage."""
    ev = panel_evaluation(spark, sf)
    ab = m16_ablation(spark, sf)
    rob = m18_temporal_robustness(spark, sf)
    cov = a22_coverage_selected(spark, sf)
    winners = evaluate.best_by(rob, "rmse", ROBUST, by=["evaluation_start"])
    last_two = winners.orderBy(F.desc("evaluation_start")).limit(2)  # the report shows the latest two windows
    return spark.range(1).select(
        ev["selection"].select("best_on_test").scalar().alias("best_model_on_test"),
        ev["scores"].where("period = 'historical_final'").select(F.min("rmse")).scalar().alias("best_test_rmse"),
        ab.where(F.col("feature_set").startswith("B")).select("improvement_vs_calendar_rmse").scalar()
          .alias("prior_year_rmse_drop"),
        last_two.select(F.sort_array(F.collect_list(F.concat_ws(":", F.col("evaluation_start").cast("string"),
                                                                 "best_model")))).scalar().alias("latest_window_winners"),
        cov.where("interval = '80%' AND volume_group = 'all'").select("observed_coverage").scalar().alias("coverage_80"))


@register("q03_evaluation_summary")
def q03_evaluation_summary(spark, sf):
    """The evaluation report without row-level predictions: score rows,
    the selection row and interval coverage as one long table."""
    ev = panel_evaluation(spark, sf)
    scores = ev["scores"].select(F.lit("scores").alias("section"), F.to_json(F.struct("*")).alias("record"))
    sel = ev["selection"].select(F.lit("selection").alias("section"), F.to_json(F.struct("*")).alias("record"))
    cov = a22_coverage_selected(spark, sf).select(F.lit("interval_coverage").alias("section"),
                                                  F.to_json(F.struct("*")).alias("record"))
    return scores.unionByName(sel).unionByName(cov)
