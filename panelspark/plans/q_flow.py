"""Flow, gap-filled panel and feature queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.operators import clean, metrics, panel
from panelspark.plans.catalog import register
from panelspark.plans.oracle_sql import FEATURE_ROUND, dense_sql, features_sql, flow_sql, splits_sql
from panelspark.session import cut_lineage
from panelspark.sources import bindings as B


def flow_of(spark: SparkSession, sf: str) -> DataFrame:
    """The monthly flow, written once (reliable checkpoint). Every panel query
    reads it several times -- grid bounds, entity list, grid join, statewide
    totals -- and each read of an unmaterialised flow would be another scan
    and join of the raw transaction tables. It holds one row per
    (entity, month), so it is tiny next to the raw rows."""
    return cut_lineage(clean.load_flow(B.registrations(spark, sf), B.entities(spark, sf), electric=B.ELECTRIC_FUEL))


def features_of(spark: SparkSession, sf: str, drop_incomplete: bool = True) -> DataFrame:
    return panel.panel_features(flow_of(spark, sf), drop_incomplete=drop_incomplete)


def rounded(df: DataFrame, cols, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


FLOAT_FEATURES = [c for c in panel.FEATURES if c != "month_index"]


@register("c02_load_flow", flow_sql("SELECT * FROM flow"))
def c02_load_flow(spark, sf):
    return flow_of(spark, sf)


@register("j01_all_fuel_left_join_electric", flow_sql("""
    SELECT a.entity, a.month, a.all_transactions, COALESCE(e.ev, 0.0) AS ev_transactions
    FROM (SELECT entity, month, all_transactions FROM flow) a
    LEFT JOIN (SELECT entity, CAST(date_trunc('month', txn_date) AS DATE) AS month, CAST(sum(cnt) AS DOUBLE) AS ev
               FROM registrations WHERE fuel = '1-URGENT' AND entity IN (SELECT n_name FROM nation) GROUP BY 1, 2) e
      ON a.entity = e.entity AND a.month = e.month"""))
def j01_all_fuel_left_join_electric(spark, sf):
    # The reference left-joins two aggregates; one conditional aggregate is the same table.
    return flow_of(spark, sf)


@register("a02_monthly_flow_totals", flow_sql("""
    SELECT month, CAST(count(*) AS BIGINT) AS entities, sum(all_transactions) AS all_transactions,
           sum(ev_transactions) AS ev_transactions FROM flow GROUP BY month"""))
def a02_monthly_flow_totals(spark, sf):
    return flow_of(spark, sf).groupBy("month").agg(
        F.count(F.lit(1)).alias("entities"), F.sum("all_transactions").alias("all_transactions"),
        F.sum("ev_transactions").alias("ev_transactions"))


@register("a04_audit_flow", flow_sql("""
    SELECT (SELECT count(*) FROM registrations) AS registration_rows_raw,
           min(month) AS first_month, max(month) AS last_month, sum(ev_transactions) AS electric_transactions_total
    FROM flow"""))
def a04_audit_flow(spark, sf):
    return clean.flow_audit(B.registrations(spark, sf), flow_of(spark, sf))


@register("a05_statewide_monthly", flow_sql("SELECT month, sum(ev_transactions) AS ev_transactions FROM flow GROUP BY month"))
def a05_statewide_monthly(spark, sf):
    return flow_of(spark, sf).groupBy("month").agg(F.sum("ev_transactions").alias("ev_transactions"))


@register("c04_densify_panel", dense_sql("SELECT entity, month, ev_transactions FROM dense"))
def c04_densify_panel(spark, sf):
    return panel.densify_panel(flow_of(spark, sf)).select("entity", "month", "ev_transactions")


@register("j04_cross_grid", dense_sql("SELECT entity, month FROM grid"))
def j04_cross_grid(spark, sf):
    # entity x month grid as explode(sequence) per entity: no cartesian join
    return panel.densify_panel(flow_of(spark, sf)).select("entity", "month")


@register("j03_grid_left_join_observed", dense_sql("""
    SELECT g.entity, g.month, f.ev_transactions AS observed, f.ev_transactions IS NULL AS filled
    FROM grid g LEFT JOIN flow f ON f.entity = g.entity AND f.month = g.month"""))
def j03_grid_left_join_observed(spark, sf):
    flow = flow_of(spark, sf)
    grid = panel.densify_panel(flow).select("entity", "month")
    obs = flow.select("entity", "month", F.col("ev_transactions").alias("observed"))
    return grid.join(obs, ["entity", "month"], "left").withColumn("filled", F.col("observed").isNull())


@register("w01_lags", features_sql("SELECT entity, month, lag_1, lag_2, lag_12, lag_13 FROM feat_all"))
def w01_lags(spark, sf):
    return features_of(spark, sf, drop_incomplete=False).select("entity", "month", "lag_1", "lag_2", "lag_12", "lag_13")


@register("w02_trailing_mean", features_sql(
    "SELECT entity, month, round(lag_3_mean, 6) AS lag_3_mean, round(lag_12_mean, 6) AS lag_12_mean FROM feat_all"))
def w02_trailing_mean(spark, sf):
    return rounded(features_of(spark, sf, drop_incomplete=False).select("entity", "month", "lag_3_mean", "lag_12_mean"),
                   ["lag_3_mean", "lag_12_mean"])


@register("w03_expanding_mean", features_sql("SELECT entity, month, round(entity_scale, 6) AS entity_scale FROM feat_all"))
def w03_expanding_mean(spark, sf):
    return rounded(features_of(spark, sf, drop_incomplete=False).select("entity", "month", "entity_scale"), ["entity_scale"])


@register("w04_derived_lags", features_sql("""
    SELECT entity, month, round(lag_1 - lag_13, 6) AS yoy_gap, round(lag_3_mean / (lag_12_mean + 1.0), 6) AS recent_vs_year
    FROM feat_all"""))
def w04_derived_lags(spark, sf):
    return rounded(features_of(spark, sf, drop_incomplete=False).select("entity", "month", "yoy_gap", "recent_vs_year"),
                   ["yoy_gap", "recent_vs_year"])


@register("c05_panel_features", features_sql(f"SELECT entity, month, ev_transactions, {FEATURE_ROUND} FROM features"))
def c05_panel_features(spark, sf):
    return rounded(features_of(spark, sf), FLOAT_FEATURES)


@register("c06_time_splits", splits_sql("SELECT entity, month, split, split <> 'test' AS development FROM splits"))
def c06_time_splits(spark, sf):
    return panel.time_splits(features_of(spark, sf)).select("entity", "month", "split", "development")


@register("a15_error_metrics", splits_sql("""
    SELECT split, round(avg(abs(ev_transactions - lag_12)), 2) AS mae,
           round(sqrt(avg((ev_transactions - lag_12) ^ 2)), 2) AS rmse,
           round(1 - sum((ev_transactions - lag_12) ^ 2)
                 / (sum(ev_transactions ^ 2) - sum(ev_transactions) ^ 2 / count(*)), 4) AS r2,
           round(sum(abs(ev_transactions - lag_12)) / greatest(sum(ev_transactions), 1.0) * 100, 2) AS wape_pct,
           count(*) AS rows
    FROM splits WHERE split <> 'train' GROUP BY split"""))
def a15_error_metrics(spark, sf):
    """Step-1 slice: raw rows -> flow -> panel -> features -> lag-12 baseline
    -> MAE/RMSE/R2/WAPE on the validation and test splits."""
    split = panel.time_splits(features_of(spark, sf)).where(F.col("split") != "train")
    return metrics.score(split, "ev_transactions", "lag_12", by=["split"])
