"""Evaluation operators.

They take prediction tables (entity, month, actual, <model columns>) and
return small result tables. Everything per entity or per group is an
aggregate; everything ordered over all entities goes through
`order_stats`, so no step collects a whole table into one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.operators import metrics
from panelspark.operators.order_stats import (conformal_rank, ntile_of, quantiles, rank_pct_many, row_number,
                                              value_positions)


# --- dispersion (A14 / M21) -------------------------------------------------------

def dispersion_report(train: DataFrame, value: str = "ev_transactions", entity: str = "entity") -> DataFrame:
    """Pooled and within-entity variance-to-mean ratios (A14, M21), one row."""
    per = train.groupBy(entity).agg(F.avg(value).alias("m"), F.var_samp(value).alias("v"))
    ratios = per.select((F.col("v") / F.nullif(F.col("m"), F.lit(0.0))).alias("ratio")).where(F.col("ratio").isNotNull())
    med = quantiles(ratios, "ratio", {"med": 0.5}).select("med").scalar()
    return train.agg(F.avg(value).alias("_mean"), F.var_samp(value).alias("_var")).select(
        F.round("_mean", 2).alias("training_mean_count"),
        F.round("_var", 2).alias("training_variance"),
        F.round(F.col("_var") / F.greatest(F.col("_mean"), F.lit(1e-9)), 2).alias("pooled_variance_to_mean"),
        F.round(med, 2).alias("median_within_entity_variance_to_mean"),
        ratios.select(F.count_if(F.col("ratio") > 1)).scalar().alias("entities_with_variance_above_mean"),
        ratios.select(F.count(F.lit(1))).scalar().alias("entities_with_defined_ratio"))


# --- best model (K04 / K07) --------------------------------------------------------

def best_by(scores: DataFrame, metric: str, candidates: Sequence[str], by: Sequence[str] = (),
            model: str = "model") -> DataFrame:
    """Arg-min model by `metric`, ties to the earlier candidate in list order
    (K04, K07): `min_by(model, struct(metric, position))` per group."""
    pos = F.array_position(F.array(*[F.lit(c) for c in candidates]), F.col(model))
    s = scores.where(F.col(model).isin(list(candidates)))
    return s.groupBy(*by).agg(F.min_by(model, F.struct(F.col(metric), pos)).alias("best_model"))


def winners_per_window(scores: DataFrame, window: str, metric: str = "rmse", candidates: Sequence[str] = ()) -> DataFrame:
    """Lowest-metric model per window, then wins per model."""
    best = best_by(scores, metric, candidates, by=[window])
    return best.groupBy("best_model").agg(F.count(F.lit(1)).alias("wins"))


# --- entity error analysis (A16-A18, M19) -------------------------------------------

def entity_errors(pred: DataFrame, baseline: str, statistical: str, ml: str, actual: str = "actual",
                  entity: str = "entity") -> DataFrame:
    """Per-entity RMSE/MAE/WAPE for three models and the improvement of the
    statistical and ML model over the baseline in % (A16); WAPE and
    improvement are NULL when sum(actual) or the baseline RMSE is 0."""
    names = [baseline, statistical, ml]
    aggs = [F.sum(actual).alias("_sy"), F.avg(actual).alias("_my"), F.count(F.lit(1)).alias("_n")]
    for m in names:
        e = F.col(actual) - F.col(m)
        aggs += [F.sum(e * e).alias(f"_sse_{m}"), F.sum(F.abs(e)).alias(f"_sae_{m}")]
    g = pred.groupBy(entity).agg(*aggs)
    cols = [entity, F.col("_sy").cast("bigint").alias("total_transactions"), F.round("_my", 2).alias("mean_monthly_transactions")]
    for m in names:
        cols += [F.round(F.sqrt(F.col(f"_sse_{m}") / F.col("_n")), 2).alias(f"{m}_rmse"),
                 F.round(F.col(f"_sae_{m}") / F.col("_n"), 2).alias(f"{m}_mae"),
                 F.round(F.when(F.col("_sy") > 0, F.col(f"_sae_{m}") / F.col("_sy") * 100.0), 2).alias(f"{m}_wape_pct")]
    out = g.select(*cols)
    b, s, ml_c = F.col(f"{baseline}_rmse"), F.col(f"{statistical}_rmse"), F.col(f"{ml}_rmse")
    return out.withColumns({
        "baseline_rmse": b, "statistical_rmse": s, "ml_rmse": ml_c,
        "ml_improvement_vs_baseline_pct": F.round(F.when(b > 0, (b - ml_c) / b * 100.0), 2),
        "statistical_improvement_vs_baseline_pct": F.round(F.when(b > 0, (b - s) / b * 100.0), 2),
    })


def macro_summary(errors: DataFrame, models: Sequence[str]) -> DataFrame:
    """Mean, median, p25, p75 of entity MAE and WAPE per model (A17), with
    exact distributed quantiles (linear interpolation)."""
    long = errors.select(F.explode(F.array(*[
        F.struct(F.lit(m).alias("model"), F.col(f"{m}_mae").alias("mae"), F.col(f"{m}_wape_pct").alias("wape"))
        for m in models])).alias("r")).select("r.*")
    means = long.groupBy("model").agg(F.round(F.avg("mae"), 2).alias("mean_entity_mae"),
                                      F.round(F.avg("wape"), 2).alias("mean_entity_wape_pct"))
    qm = quantiles(long, "mae", {"median_entity_mae": 0.5, "mae_p25": 0.25, "mae_p75": 0.75}, by=["model"])
    qw = quantiles(long, "wape", {"median_entity_wape_pct": 0.5, "wape_p25": 0.25, "wape_p75": 0.75}, by=["model"])
    out = means.join(qm, "model", "left").join(qw, "model", "left")
    return out.withColumns({c: F.round(c, 2) for c in ("median_entity_mae", "mae_p25", "mae_p75",
                                                      "median_entity_wape_pct", "wape_p25", "wape_p75")})


def win_counts(errors: DataFrame) -> DataFrame:
    """Entities where ML / statistical beat the baseline RMSE (A18), one row."""
    return errors.agg(
        F.count_if(F.col("ml_rmse") < F.col("baseline_rmse")).alias("ml_better_entities"),
        F.count_if(F.col("ml_rmse") >= F.col("baseline_rmse")).alias("baseline_better_or_tied_entities"),
        F.count_if(F.col("statistical_rmse") < F.col("baseline_rmse")).alias("statistical_better_entities"))


def spearman(df: DataFrame, x: str, y: str, key: str | Sequence[str]) -> DataFrame:
    """Spearman rho = Pearson correlation of average-tie ranks, with the
    two-sided p-value of the t approximation (M19, M20). `key` names the
    column or columns that identify a row. Rows with a NULL in either column
    are dropped first. One row: rho, p, n; p is NULL under three rows or
    where rho is undefined (a constant column)."""
    keys = [key] if isinstance(key, str) else list(key)
    d = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(F.struct(*keys).alias("_key"), x, y)
    r = rank_pct_many(d, "_key", {x: "_rx", y: "_ry"})
    # `corr` fails under ANSI on a constant column.
    rho = F.try_divide(F.covar_pop("_rx", "_ry"), F.stddev_pop("_rx") * F.stddev_pop("_ry"))
    # Inside a lambda a name means an alias of the same select before it means a column, so names must not repeat.
    row = r.agg(rho.alias("_rho"), F.count(F.lit(1)).alias("_n"))
    return row.select(F.round("_rho", 3).alias("rho"), _t_pvalue(F.col("_rho"), F.col("_n")).alias("p"), F.col("_n").alias("n"))


P_STEPS = 400  # intervals of Simpson's rule, an even number


def _t_pvalue(rho: Column, n: Column) -> Column:
    """Two-sided p of t = rho sqrt(df/(1-rho^2)), rounded to 4 places. With
    sin(theta) = |rho| the central probability is an integral of
    cos(u)^(df-1) over 0..theta; beyond 12/sqrt(df) the integrand is below
    e^-70. Work and memory don't depend on n."""
    df_ = (n - 2).cast("double")
    upper = F.least(F.asin(F.least(F.abs(rho), F.lit(1.0))), F.lit(12.0) / F.sqrt(df_))
    step = upper / F.lit(float(P_STEPS))

    def term(i: Column) -> Column:
        weight = F.when((i == 0) | (i == P_STEPS), 1.0).when(i % 2 == 1, 4.0).otherwise(2.0)
        sine = F.sin(step * i)
        return weight * F.exp((df_ - 1) / 2 * F.log1p(F.greatest(-sine * sine, F.lit(1e-15 - 1.0))))

    area = F.aggregate(F.sequence(F.lit(0), F.lit(P_STEPS)), F.lit(0.0), lambda acc, i: acc + term(i)) * step / 3
    inside = F.lit(2.0 / math.sqrt(math.pi)) * _half_gamma_ratio(df_ / 2) * area
    return F.when((n > 2) & rho.isNotNull(), F.round(F.greatest(F.lit(0.0), F.lit(1.0) - inside), 4))


def _half_gamma_ratio(x: Column) -> Column:
    """gamma(x + 1/2) / gamma(x) for x > 0: ten steps of the recurrence, then the asymptotic series."""
    shift = F.lit(1.0)
    for k in range(10):
        shift = shift * (x + k) / (x + k + 0.5)
    y = x + 10
    return shift * F.sqrt(y) * (1 - 1 / (8 * y) + 1 / (128 * y * y) + 5 / (1024 * y * y * y) - 21 / (32768 * y * y * y * y))


# --- error drivers (A19 / M20) --------------------------------------------------------

def error_drivers(pred: DataFrame, segments: DataFrame, baseline: str, ml: str, actual: str = "actual") -> DataFrame:
    """Row-level drivers of the ML gain over the baseline."""
    out = pred.select("entity", "month", F.col(actual).alias("actual"), F.col(baseline).alias("baseline"), F.col(ml).alias("ml"))
    out = out.withColumns({
        "baseline_absolute_error": F.abs(F.col("actual") - F.col("baseline")),
        "ml_absolute_error": F.abs(F.col("actual") - F.col("ml")),
    })
    out = out.withColumns({
        "ml_error_reduction": F.col("baseline_absolute_error") - F.col("ml_absolute_error"),
        "absolute_yoy_change_pct": F.abs(F.col("actual") - F.col("baseline")) / (F.col("baseline") + 1.0) * 100.0,
        "month_of_year": F.month("month").cast("bigint"),
    })
    return out.join(segments.select("entity", "market_segment"), "entity", "left")


def improvement_sides(errors: DataFrame, improvement: str = "ml_improvement_vs_baseline_pct") -> DataFrame:
    """Entities, and their share, on each side of zero improvement (Q08); an
    unknown improvement is not above zero."""
    side = F.when(F.col(improvement) > 0, "above_zero").otherwise("not_above_zero")
    counts = errors.groupBy(side.alias("side")).agg(F.count(F.lit(1)).alias("entities"))
    total = errors.agg(F.count(F.lit(1))).scalar()
    return counts.withColumn("share_pct", F.round(F.col("entities") * 100.0 / total, 2))


def mean_reduction(drivers: DataFrame) -> DataFrame:
    """Mean ML error reduction by month of year and by segment (A19), one
    aggregate with GROUPING SETS."""
    g = drivers.groupingSets([["month_of_year"], ["market_segment"]], "month_of_year", "market_segment").agg(
        F.round(F.avg("ml_error_reduction"), 2).alias("mean_ml_error_reduction"),
        F.grouping("month_of_year").alias("_gm"))
    return g.select(F.when(F.col("_gm") == 0, "month").otherwise("segment").alias("dimension"),
                    F.when(F.col("_gm") == 0, F.col("month_of_year").cast("string")).otherwise(F.col("market_segment")).alias("value"),
                    "mean_ml_error_reduction")


# --- split conformal intervals (M17, W08-W10, A22) --------------------------------------

LEVELS = (0.80, 0.95)
STRATA = ("low", "medium", "high")


def conformal_periods(features: DataFrame, month: str = "month") -> DataFrame:
    """Label rows train / selection / calibration / test (12-month blocks
    back from the last month); `fitting` = train + selection."""
    last = features.select(F.max(month)).scalar()
    final_start = F.add_months(last, -11)
    cal_start = F.add_months(final_start, -12)
    sel_start = F.add_months(cal_start, -12)
    period = (F.when(F.col(month) >= final_start, "test").when(F.col(month) >= cal_start, "calibration")
              .when(F.col(month) >= sel_start, "selection").otherwise("train"))
    return features.withColumn("period", period)


def volume_strata(fitting: DataFrame, value: str = "ev_transactions", entity: str = "entity", k: int = 3) -> DataFrame:
    """Entities in `k` volume tiles by mean fitting-period value, ties by
    entity name (W08: `ntile(k)`; equals 13/13/13 at 39 entities). Also the
    1-based position, the count and the median-entity flag (W09)."""
    means = fitting.groupBy(entity).agg(F.avg(value).alias("mean_volume"))
    ranked = row_number(means, [F.col("mean_volume").asc(), F.col(entity).asc()], out="position", total="entities")
    tile = ntile_of(F.col("position"), F.col("entities"), k)
    labels = F.element_at(F.array(*[F.lit(s) for s in STRATA]), tile.cast("int")) if k == 3 else tile.cast("string")
    return ranked.withColumn("volume_group", labels).withColumn(
        "representative", F.col("position") == F.floor(F.col("entities") / 2) + 1)


def conformal_quantiles(calibration: DataFrame, residual: str = "absolute_error", by: Sequence[str] = ("volume_group",),
                        levels: Sequence[float] = LEVELS) -> DataFrame:
    """Finite-sample split-conformal quantile per group and level: the k-th
    smallest residual with k = min(n, ceil((n+1) p)) (W10). All levels come
    from one distributed order-statistics pass."""
    pos = value_positions(calibration, residual, list(by))
    parts = []
    for p in levels:
        k = conformal_rank(p)
        hit = pos.where((F.col("_first") <= k) & (k <= F.col("_last")))
        parts.append(hit.select(*by, F.col(residual).cast("double").alias("q"), F.col("_size").alias("n"),
                                F.lit(int(round(p * 100))).cast("bigint").alias("level")))
    out = parts[0]
    for q in parts[1:]:
        out = out.unionByName(q)
    return out


def conformal_intervals(features: DataFrame, predictor: str, value: str = "ev_transactions") -> tuple[DataFrame, DataFrame]:
    """Intervals on the test block (M17). `predictor` is a column of
    predictions (fitted without the calibration and test blocks). Returns
    (intervals, coverage table A22)."""
    data = conformal_periods(features)
    fitting = data.where(F.col("period").isin("train", "selection"))
    strata = volume_strata(fitting, value).select("entity", "volume_group")
    cal = data.where(F.col("period") == "calibration").join(strata, "entity", "left") \
        .withColumn("absolute_error", F.abs(F.col(value) - F.col(predictor)))
    # both levels side by side in one aggregate: one join to the test block
    q = conformal_quantiles(cal).groupBy("volume_group").agg(
        F.max(F.when(F.col("level") == 80, F.col("q"))).alias("q80"), F.max(F.when(F.col("level") == 95, F.col("q"))).alias("q95"))
    test = data.where(F.col("period") == "test").join(strata, "entity", "left")
    out = test.join(q, "volume_group", "left").select(
        "entity", "month", F.col(value).alias("actual"), F.col(predictor).alias("prediction"), "volume_group",
        F.greatest(F.lit(0.0), F.col(predictor) - F.col("q80")).alias("lower_80"), (F.col(predictor) + F.col("q80")).alias("upper_80"),
        F.greatest(F.lit(0.0), F.col(predictor) - F.col("q95")).alias("lower_95"), (F.col(predictor) + F.col("q95")).alias("upper_95"))
    return out, interval_coverage(out)


def interval_coverage(intervals: DataFrame) -> DataFrame:
    """Observed coverage and mean width per level for all rows and each
    volume group (A22): one ROLLUP-style aggregate per level."""
    parts = []
    for p in LEVELS:
        tag = int(round(p * 100))
        lo, hi = F.col(f"lower_{tag}"), F.col(f"upper_{tag}")
        inside = ((F.col("actual") >= lo) & (F.col("actual") <= hi)).cast("double")
        g = intervals.rollup("volume_group").agg(
            F.avg(inside).alias("_cov"), F.avg(hi - lo).alias("_w"), F.count(F.lit(1)).alias("rows"),
            F.grouping("volume_group").alias("_g"))
        parts.append(g.select(F.lit(f"{tag}%").alias("interval"),
                              F.when(F.col("_g") == 1, "all").otherwise(F.col("volume_group")).alias("volume_group"),
                              F.lit(p).alias("target_coverage"), F.round("_cov", 4).alias("observed_coverage"),
                              F.round("_w", 2).alias("mean_width"), "rows"))
    return parts[0].unionByName(parts[1])


def score_table(pred: DataFrame, models: Sequence[str], actual: str = "actual", by: Sequence[str] = ()) -> DataFrame:
    """Rounded MAE/RMSE/R2/WAPE per model (and group) in one pass."""
    return metrics.score_models(pred, actual, models, by=by)
