"""Vehicle stock queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.operators import clean
from panelspark.plans.catalog import register
from panelspark.plans.oracle_sql import STOCK, vehicles_sql
from panelspark.session import cut_lineage
from panelspark.sources import bindings as B

AS_CODED_TIERS = (("make", "model"), ("ev_type",), ())


def vehicles_of(spark: SparkSession, sf: str, tiers=clean.DEFAULT_TIERS, columns=None) -> DataFrame:
    return clean.load_vehicles(B.population(spark, sf), B.entities(spark, sf), tiers=tiers, columns=columns or VEHICLE_COLS)


STOCK_COLS = ["entity", "rng", "range_observed", "estimated_range", "is_bev", "longitude", "latitude"]


def stock_of(spark: SparkSession, sf: str) -> DataFrame:
    return clean.entity_stock(vehicles_of(spark, sf, columns=STOCK_COLS))


def r6(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), 6) for c in cols})


VEHICLE_COLS = ["vehicle_id", "entity", "make", "model", "model_year", "rng", "ev_type", "range_observed",
                "estimated_range", "is_bev", "longitude", "latitude"]


@register("p02_dedupe_first", vehicles_sql(
    "SELECT vehicle_id, entity, make, model, model_year, rng, l_partkey, l_suppkey FROM dedup"))
def p02_dedupe_first(spark, sf):
    pop = clean.filter_in(B.population(spark, sf), "entity", B.entities(spark, sf))
    return clean.dedupe_first(pop, "vehicle_id", keep=["entity", "make", "model", "model_year", "rng", "l_partkey", "l_suppkey"])


@register("c01_load_vehicles", vehicles_sql(
    "SELECT vehicle_id, entity, make, model, model_year, rng, ev_type, range_observed, round(estimated_range, 6) AS estimated_range,"
    " is_bev, longitude, latitude FROM vehicles"))
def c01_load_vehicles(spark, sf):
    return r6(vehicles_of(spark, sf).select(*VEHICLE_COLS), ["estimated_range"])


@register("c03_impute_hierarchical", vehicles_sql(
    "SELECT vehicle_id, range_observed, round(estimated_range, 6) AS estimated_range FROM vehicles"))
def c03_impute_hierarchical(spark, sf):
    return r6(vehicles_of(spark, sf, columns=["vehicle_id", "range_observed", "estimated_range"]), ["estimated_range"])


@register("c03_impute_as_coded", vehicles_sql("""
    SELECT v.vehicle_id, round(COALESCE(CASE WHEN v.range_observed THEN v.rng END, b.m, c.m, (SELECT m FROM med_all)), 6)
           AS estimated_range
    FROM veh v LEFT JOIN med_mm b ON b.make = v.make AND b.model = v.model LEFT JOIN med_t c ON c.ev_type = v.ev_type"""))
def c03_impute_as_coded(spark, sf):
    """The make/model -> type -> overall chain (model year unused)."""
    return r6(vehicles_of(spark, sf, AS_CODED_TIERS, ["vehicle_id", "estimated_range"]), ["estimated_range"])


@register("a03_hierarchical_medians", vehicles_sql("""
    SELECT 'make_model_year' AS tier, make, model, model_year, NULL AS ev_type, m AS median_range FROM med_mmy
    UNION ALL SELECT 'make_model', make, model, NULL, NULL, m FROM med_mm
    UNION ALL SELECT 'ev_type', NULL, NULL, NULL, ev_type, m FROM med_t
    UNION ALL SELECT 'overall', NULL, NULL, NULL, NULL, m FROM med_all"""))
def a03_hierarchical_medians(spark, sf):
    pop = clean.filter_in(B.population(spark, sf), "entity", B.entities(spark, sf))
    cols = ["make", "model", "model_year", "ev_type"]
    obs = clean.dedupe_first(pop, "vehicle_id", keep=[*cols, "rng"]).where(F.col("rng") > 0)
    # the raw rows are joined, de-duplicated and counted once; every tier is ranked from the counts
    pairs = cut_lineage(obs.groupBy(*cols, "rng").agg(F.count(F.lit(1)).alias("_n")))
    parts = []
    for tier, keys, q in zip(("make_model_year", "make_model", "ev_type", "overall"), clean.DEFAULT_TIERS,
                             clean.tier_medians(pairs, "rng", clean.DEFAULT_TIERS)):
        if not keys:  # one row, even where nothing was observed
            q = spark.range(1).select(q.select("_med").scalar().alias("_med"))
        parts.append(q.select(F.lit(tier).alias("tier"),
                              *[(F.col(c) if c in keys else F.lit(None).cast(obs.schema[c].dataType)).alias(c) for c in cols],
                              F.col("_med").alias("median_range")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("a01_entity_stock", vehicles_sql("""
    SELECT entity, total_evs, round(avg_range_miles, 6) AS avg_range_miles, round(observed_range_share, 6) AS observed_range_share,
           round(bev_share, 6) AS bev_share, latitude, longitude FROM stock""", STOCK))
def a01_entity_stock(spark, sf):
    return r6(stock_of(spark, sf), ["avg_range_miles", "observed_range_share", "bev_share"])


@register("c01_load_stock", vehicles_sql("""
    SELECT entity, total_evs, round(avg_range_miles, 4) AS avg_range_miles, round(observed_range_share, 4) AS observed_range_share,
           round(bev_share, 4) AS bev_share, latitude, longitude FROM stock ORDER BY total_evs DESC, entity""", STOCK))
def c01_load_stock(spark, sf):
    s = stock_of(spark, sf)
    return s.withColumns({c: F.round(c, 4) for c in ("avg_range_miles", "observed_range_share", "bev_share")}) \
        .orderBy(F.desc("total_evs"), "entity")


@register("a04_audit_stock", vehicles_sql("""
    SELECT (SELECT count(*) FROM population) AS population_rows_raw, count(*) AS unique_vehicles,
           CAST(sum(CASE WHEN NOT range_observed THEN 1 ELSE 0 END) AS BIGINT) AS zero_or_missing_range,
           round(avg(CAST(range_observed AS DOUBLE)), 4) AS observed_range_share, count(DISTINCT entity) AS entities
    FROM vehicles"""))
def a04_audit_stock(spark, sf):
    return clean.stock_audit(B.population(spark, sf), vehicles_of(spark, sf, columns=["entity", "range_observed"]))


@register("a06_range_histogram", vehicles_sql(
    "SELECT entity, rng AS electric_range, count(*) AS vehicles FROM vehicles WHERE range_observed GROUP BY 1, 2"))
def a06_range_histogram(spark, sf):
    return clean.range_histogram(vehicles_of(spark, sf, columns=["entity", "rng", "range_observed"]))


@register("a07_low_range_share", vehicles_sql("""
    SELECT entity, round(avg(CAST(rng < 20 AS DOUBLE)), 6) AS observed_low_range_share
    FROM vehicles WHERE range_observed GROUP BY entity"""))
def a07_low_range_share(spark, sf):
    # threshold 20 on the bound range column (l_quantity 1..50) plays 200 miles
    return r6(clean.low_range_share(vehicles_of(spark, sf, columns=["entity", "rng", "range_observed"]), 20), ["observed_low_range_share"])


@register("a20_range_coverage", vehicles_sql("""
    SELECT 'model_year' AS "group", CAST(model_year AS VARCHAR) AS value, count(*) AS records,
           CAST(sum(CAST(range_observed AS INT)) AS BIGINT) AS positive_observed_range,
           round(sum(CAST(range_observed AS INT)) * 100.0 / count(*), 2) AS coverage_pct FROM vehicles GROUP BY model_year
    UNION ALL SELECT 'ev_type', ev_type, count(*), CAST(sum(CAST(range_observed AS INT)) AS BIGINT),
           round(sum(CAST(range_observed AS INT)) * 100.0 / count(*), 2) FROM vehicles GROUP BY ev_type
    UNION ALL SELECT 'make', make, count(*), CAST(sum(CAST(range_observed AS INT)) AS BIGINT),
           round(sum(CAST(range_observed AS INT)) * 100.0 / count(*), 2) FROM vehicles GROUP BY make
    UNION ALL SELECT 'entity', entity, count(*), CAST(sum(CAST(range_observed AS INT)) AS BIGINT),
           round(sum(CAST(range_observed AS INT)) * 100.0 / count(*), 2) FROM vehicles GROUP BY entity"""))
def a20_range_coverage(spark, sf):
    return clean.range_coverage(vehicles_of(spark, sf, columns=["model_year", "ev_type", "make", "entity", "range_observed"]))


@register("a21_threshold_sensitivity", vehicles_sql("""
    SELECT k.vehicle_type, t.threshold_miles, count(*) AS observed_vehicles,
           CAST(sum(CAST(v.rng < t.threshold_miles AS INT)) AS BIGINT) AS below_threshold,
           round(sum(CAST(v.rng < t.threshold_miles AS INT)) * 100.0 / count(*), 2) AS share_below_pct
    FROM vehicles v, (VALUES (10), (20), (30), (40)) t(threshold_miles),
         (VALUES ('all'), ('BEV'), ('PHEV')) k(vehicle_type)
    WHERE v.range_observed AND (k.vehicle_type = 'all' OR (k.vehicle_type = 'BEV') = v.is_bev)
    GROUP BY 1, 2"""))
def a21_threshold_sensitivity(spark, sf):
    return clean.threshold_sensitivity(vehicles_of(spark, sf, columns=["rng", "is_bev", "range_observed"]), (10, 20, 30, 40))
