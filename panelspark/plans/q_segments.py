"""Segmentation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.operators import clean, segments
from panelspark.plans.catalog import register
from panelspark.plans.memo import remember
from panelspark.plans.oracle_sql import FLOW, STOCK, VEHICLES
from panelspark.plans.q_clean import STOCK_COLS, vehicles_of
from panelspark.plans.q_flow import flow_of
from panelspark.sources.bindings import with_bindings

THRESHOLD = 20.0  # on the bound range column (1..50); plays the 200-mile default


def features_of(spark, sf, threshold=THRESHOLD, veh=None):
    veh = vehicles_of(spark, sf, columns=STOCK_COLS) if veh is None else veh
    return segments.segment_features(clean.entity_stock(veh), clean.low_range_share(veh, threshold), flow_of(spark, sf), threshold)


def segmented(spark, sf):
    return remember(spark, sf, "segments", lambda: segments.assign_segments(features_of(spark, sf)))


SEG_SQL = """low AS (SELECT entity, avg(CAST(rng < 20 AS DOUBLE)) AS observed_low_range_share FROM vehicles
             WHERE range_observed GROUP BY entity),
wins AS (SELECT entity,
                sum(CASE WHEN month > CAST((SELECT max(month) FROM flow) - INTERVAL 12 MONTH AS DATE) THEN ev_transactions ELSE 0 END)
                  AS ev_transactions_12m,
                sum(CASE WHEN month <= CAST((SELECT max(month) FROM flow) - INTERVAL 12 MONTH AS DATE)
                          AND month > CAST((SELECT max(month) FROM flow) - INTERVAL 24 MONTH AS DATE) THEN ev_transactions ELSE 0 END)
                  AS ev_transactions_prior_12m
         FROM flow GROUP BY entity),
seg AS (
    SELECT s.entity, s.total_evs, COALESCE(l.observed_low_range_share, 0.0) AS observed_low_range_share,
           COALESCE(w.ev_transactions_12m, 0.0) AS ev_transactions_12m, COALESCE(w.ev_transactions_prior_12m, 0.0) AS ev_transactions_prior_12m
    FROM stock s LEFT JOIN low l USING (entity) LEFT JOIN wins w USING (entity))"""


@register("c09_segment_features", with_bindings(
    "WITH " + ",\n".join([FLOW, VEHICLES, STOCK, SEG_SQL]) + """
    SELECT entity, total_evs, round(observed_low_range_share, 6) AS observed_low_range_share, ev_transactions_12m,
           ev_transactions_prior_12m,
           round(least(greatest((ev_transactions_12m + 1) / (ev_transactions_prior_12m + 1) - 1, -1.0), 5.0), 6) AS transaction_growth
    FROM seg""", "registrations", "population"))
def c09_segment_features(spark, sf):
    f = features_of(spark, sf)
    return f.select("entity", "total_evs", F.round("observed_low_range_share", 6).alias("observed_low_range_share"),
                    "ev_transactions_12m", "ev_transactions_prior_12m",
                    F.round("transaction_growth", 6).alias("transaction_growth"))


@register("c10_assign_segments")
def c10_assign_segments(spark, sf):
    seg, sil = segmented(spark, sf)
    return seg.select("entity", "cluster", "market_segment", "total_evs", "observed_low_range_share", "ev_transactions_12m",
                      "transaction_growth", "range_threshold_miles", F.lit(round(sil, 3)).alias("silhouette_sq_euclidean"))


@register("m10_kmeans_cluster_sizes")
def m10_kmeans_cluster_sizes(spark, sf):
    seg, _ = segmented(spark, sf)
    return seg.groupBy("cluster", "market_segment").agg(F.count(F.lit(1)).alias("entities"))


@register("m11_silhouette")
def m11_silhouette(spark, sf):
    _, sil = segmented(spark, sf)
    return spark.range(1).select(F.lit(round(sil, 3)).alias("silhouette_sq_euclidean"))


@register("m12_cluster_sensitivity")
def m12_cluster_sensitivity(spark, sf):
    return segments.cluster_sensitivity(features_of(spark, sf))


@register("a25_segment_profile")
def a25_segment_profile(spark, sf):
    return segments.segment_profile(segmented(spark, sf)[0])


@register("c11_range_scenario_shares", with_bindings(
    "WITH " + VEHICLES + """
    SELECT entity, round(sum(CASE WHEN rng < 30 THEN n ELSE 0 END) / sum(n), 6) AS observed_low_range_share
    FROM (SELECT entity, rng, count(*) AS n FROM vehicles WHERE range_observed GROUP BY 1, 2) GROUP BY entity""", "population"))
def c11_range_scenario_shares(spark, sf):
    """Low-range shares for another threshold (30) from the histogram."""
    hist = clean.range_histogram(vehicles_of(spark, sf, columns=["entity", "rng", "range_observed"]))
    return segments.threshold_shares(hist, 30.0).withColumn("observed_low_range_share", F.round("observed_low_range_share", 6))


@register("c11_range_scenario_segments")
def c11_range_scenario_segments(spark, sf):
    """Re-segment with the threshold-30 shares."""
    veh = vehicles_of(spark, sf, columns=STOCK_COLS)
    hist = clean.range_histogram(veh)
    base = features_of(spark, sf, veh=veh).drop("observed_low_range_share")
    feats = base.join(segments.threshold_shares(hist, 30.0), "entity", "left").fillna(0.0, subset=["observed_low_range_share"])
    seg, _ = segments.assign_segments(feats.withColumn("range_threshold_miles", F.lit(30.0)))
    return seg.select("entity", "market_segment", "observed_low_range_share")
