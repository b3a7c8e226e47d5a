"""Entity-by-month panels.

After the flow aggregate every entity has at most one row per month, so
per-entity windows are bounded by the number of months, never by how many
raw rows an entity had: a hot entity cannot skew these stages.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.functions import month_index

# The twelve past-only features of the pooled panel model.
FEATURES = ("lag_1", "lag_2", "lag_3_mean", "lag_12", "lag_13", "lag_12_mean", "yoy_gap", "recent_vs_year",
            "month_sin", "month_cos", "entity_scale", "month_index")

def one_month():
    return F.expr("INTERVAL 1 MONTH")


def densify_panel(flow: DataFrame, value: str = "ev_transactions", entity: str = "entity", month: str = "month",
                  fill: float = 0.0, per_entity_bounds: bool = False) -> DataFrame:
    """Complete entity x month grid, absent months = `fill`.

    Default bounds are the global first and last month (scalar subqueries,
    evaluated once); `per_entity_bounds` uses each entity's own span (the
    single-series `asfreq`). The grid is `explode(sequence(...))` per entity,
    so nothing is broadcast and no cartesian product is formed."""
    obs = flow.select(F.col(entity).alias("entity"), F.col(month).alias("month"), F.col(value).alias(value))
    if per_entity_bounds:
        spans = obs.groupBy("entity").agg(F.min("month").alias("_lo"), F.max("month").alias("_hi"))
        grid = spans.select("entity", F.explode(F.sequence("_lo", "_hi", one_month())).alias("month"))
    else:
        lo = obs.select(F.min("month")).scalar()
        hi = obs.select(F.max("month")).scalar()
        grid = obs.select("entity").distinct().select("entity", F.explode(F.sequence(lo, hi, one_month())).alias("month"))
    dense = grid.join(obs, ["entity", "month"], "left")
    return dense.withColumn(value, F.coalesce(F.col(value).cast("double"), F.lit(float(fill))))


def lags(df: DataFrame, value: str, ns=(1, 2, 12, 13), entity: str = "entity", month: str = "month") -> DataFrame:
    """`lag_n` per entity in month order (W01, W12); the grid must be dense."""
    w = Window.partitionBy(entity).orderBy(month)
    return df.withColumns({f"lag_{n}": F.lag(value, n).over(w) for n in ns})


def trailing_mean(value: str, n: int, entity: str = "entity", month: str = "month") -> Column:
    """Mean of the `n` previous rows, NULL until all `n` exist."""
    w = Window.partitionBy(entity).orderBy(month).rowsBetween(-n, -1)
    return F.when(F.count(value).over(w) == n, F.avg(value).over(w))


def expanding_mean(value: str, entity: str = "entity", month: str = "month") -> Column:
    """Mean of all previous rows, NULL for the first."""
    w = Window.partitionBy(entity).orderBy(month).rowsBetween(Window.unboundedPreceding, -1)
    return F.avg(value).over(w)


def panel_features(flow: DataFrame, value: str = "ev_transactions", entity: str = "entity",
                   month: str = "month", drop_incomplete: bool = True) -> DataFrame:
    """Dense panel + the 12 past-only features (C05). Every feature of month
    m reads only months < m of the same entity (plus the calendar), so
    changing a value never changes earlier rows' features. Rows with any NULL
    feature (each entity's first 13 months) are dropped."""
    dense = densify_panel(flow, value, entity, month)
    origin = dense.select(F.min("month")).scalar()
    out = lags(dense, value)
    out = out.withColumns({
        "lag_3_mean": trailing_mean(value, 3),
        "lag_12_mean": trailing_mean(value, 12),
        "entity_scale": expanding_mean(value),
    })
    angle = F.lit(2 * math.pi) * F.month("month") / F.lit(12.0)
    out = out.withColumns({
        "yoy_gap": F.col("lag_1") - F.col("lag_13"),
        "recent_vs_year": F.col("lag_3_mean") / (F.col("lag_12_mean") + F.lit(1.0)),
        "month_sin": F.sin(angle),
        "month_cos": F.cos(angle),
        "month_index": month_index("month", origin),
    })
    if drop_incomplete:
        out = out.na.drop(subset=list(FEATURES))
    return out.select("entity", "month", value, *FEATURES)


def time_splits(features: DataFrame, month: str = "month", test_months: int = 12, validation_months: int = 12) -> DataFrame:
    """Label rows train / validation / test (C06): the last `test_months` are
    test, the `validation_months` before are validation, the rest train;
    `development` = train + validation."""
    last = features.select(F.max(month)).scalar()
    test_start = F.add_months(last, -(test_months - 1))
    val_start = F.add_months(test_start, -validation_months)
    split = (F.when(F.col(month) >= test_start, "test").when(F.col(month) >= val_start, "validation").otherwise("train"))
    return features.withColumn("split", split).withColumn("development", F.col("split") != "test")


def split_checks(split_df: DataFrame, entity: str = "entity", month: str = "month") -> DataFrame:
    """One row of invariants (C06 assertions): ordered disjoint splits and
    unique (entity, month) keys."""
    bounds = split_df.groupBy("split").agg(F.min(month).alias("lo"), F.max(month).alias("hi"))
    get = lambda s, c: bounds.where(F.col("split") == s).select(c).scalar()
    dupes = split_df.groupBy(entity, month).count().where(F.col("count") > 1).select(F.count(F.lit(1))).scalar()
    ordered = (get("train", "hi") < get("validation", "lo")) & (get("validation", "lo") <= get("validation", "hi")) & \
              (get("validation", "hi") < get("test", "lo"))
    return split_df.sparkSession.range(1).select(ordered.alias("ordered"), (dupes == 0).alias("unique_keys"),
                                                 get("test", "lo").alias("test_start"),
                                                 get("validation", "lo").alias("validation_start"))


def assert_splits(split_df: DataFrame) -> None:
    row = split_checks(split_df).first()
    if not (row["ordered"] and row["unique_keys"]):
        raise AssertionError(f"time splits violate ordering or key uniqueness: {row}")


def rolling_folds(series: DataFrame, n_folds: int = 3, horizon: int = 12, holdout: int = 12,
                  series_key: str = "series", month: str = "month") -> DataFrame:
    """Expanding-window folds (C07) per series: after holding out the last
    `holdout` months, fold f validates on a `horizon`-month block ending
    (n_folds - f) * horizon months before the development end, and trains on
    everything earlier. Rows are replicated once per fold (bounded by
    `n_folds`), by `explode`, not by a join."""
    last = Window.partitionBy(series_key)
    s = series.withColumn("_last", F.max(month).over(last))
    s = s.withColumn("_back", F.months_between("_last", month).cast("int"))  # 0 = last month
    s = s.withColumn("fold", F.explode(F.array(*[F.lit(f) for f in range(1, n_folds + 1)])))
    val_hi = F.lit(holdout) + (F.lit(n_folds) - F.col("fold")) * horizon  # months back of the block end
    val_lo = val_hi + horizon - 1
    role = F.when(F.col("_back") > val_lo, "train").when(F.col("_back") >= val_hi, "validation")
    return s.withColumn("role", role).where(F.col("role").isNotNull()).drop("_last", "_back")


def annual_windows(features: DataFrame, min_train_months: int = 21, first_start: str | None = None,
                   month: str = "month", entity: str = "entity", skipped: bool = False) -> DataFrame:
    """Successive 12-month evaluation windows (C08). Window starts step by 12
    months so the last window ends on the last month; the training set is
    every earlier month. A window is kept when its training set spans at
    least `min_train_months` months, whatever the number of entities, and all
    entities have all 12 months. Each row appears once per window it belongs
    to. With `skipped`, all windows are returned and the column `reason` says
    `kept`, `few_training_months` or `incomplete_evaluation`."""
    last = features.select(F.max(month)).scalar()
    first = features.select(F.min(month)).scalar()
    n_entities = features.select(F.countDistinct(entity)).scalar()
    lo = F.lit(first_start).cast("date") if first_start else F.add_months(first, 1)
    last_start = F.add_months(last, -11)
    # window starts going back from the last one, 12 months apart
    n_back = F.floor(F.months_between(last_start, lo) / 12).cast("int")
    rows = features.withColumn("_k", F.explode(F.sequence(F.lit(0), n_back)))
    rows = rows.withColumn("window_start", F.add_months(last_start, -12 * F.col("_k"))).drop("_k")
    rows = rows.withColumn("role", F.when(F.col(month) < F.col("window_start"), "train")
                           .when(F.col(month) <= F.add_months("window_start", 11), "evaluation"))
    rows = rows.where(F.col("role").isNotNull())
    sizes = rows.groupBy("window_start").agg(
        F.countDistinct(F.when(F.col("role") == "train", F.col(month))).alias("_train_months"),
        F.sum(F.when(F.col("role") == "evaluation", 1).otherwise(0)).alias("_eval_rows"))
    reason = F.when(F.col("_train_months") < min_train_months, "few_training_months") \
        .when(F.col("_eval_rows") != n_entities * 12, "incomplete_evaluation").otherwise("kept")
    windows = sizes.select("window_start", reason.alias("reason"))
    if skipped:
        return rows.join(windows, "window_start")
    return rows.join(windows.where(F.col("reason") == "kept"), "window_start", "left_semi")
