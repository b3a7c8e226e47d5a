"""Live supply/score queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.operators import score
from panelspark.operators.order_stats import rank_min, rank_pct
from panelspark.plans.catalog import register
from panelspark.session import cut_lineage
from panelspark.sources import bindings as B


def live_population(spark: SparkSession, sf: str) -> DataFrame:
    """EV count per entity over landed rows (state filter is a no-op in the binding). Written once: scores, totals
    and snapshots read it, and it is one row per entity."""
    return cut_lineage(B.population(spark, sf).where(F.col("entity").isNotNull()).groupBy("entity")
                       .agg(F.count(F.lit(1)).alias("ev_stock")))


def live_monthly(spark: SparkSession, sf: str) -> DataFrame:
    """Electric sum per (entity, month), out-of-state rows excluded.
    Written once: the window bounds (a scalar over it) and the window sums
    both read it, and it is one row per (entity, month)."""
    r = B.live_registrations(spark, sf)
    return cut_lineage(r.where((F.col("fuel") == "Electric") & (F.col("entity") != "Out Of State"))
                       .groupBy("entity", F.col("txn_month").alias("month")).agg(F.sum("cnt").alias("ev_transactions")))


def stations_of(spark: SparkSession, sf: str) -> DataFrame:
    units = B.charging_units(spark, sf)
    return score.station_rollup(units, ordinal=F.col("l_orderkey") * 100 + F.col("l_linenumber"))


def attached_stations(spark: SparkSession, sf: str) -> DataFrame:
    """The stations with their entities, written once for all their readers: one row per station."""
    return cut_lineage(score.attach_entities(stations_of(spark, sf), score.zip_majority(B.zip_rows(spark, sf))))


def metrics_of(spark: SparkSession, sf: str, stations: DataFrame | None = None) -> DataFrame:
    stations = attached_stations(spark, sf) if stations is None else stations
    return score.opportunity_score(live_population(spark, sf), live_monthly(spark, sf), stations)


TITLE = "upper(substr(trim({0}), 1, 1)) || lower(substr(trim({0}), 2))"

LIVE_SQL = f"""
live_pop AS (SELECT entity, count(*) AS ev_stock FROM population WHERE entity IS NOT NULL GROUP BY entity),
live_monthly AS (
    SELECT entity, txn_month AS month, sum(cnt) AS ev_transactions FROM live_registrations
    WHERE fuel = 'Electric' AND entity <> 'Out Of State' GROUP BY 1, 2),
units AS (
    SELECT *, NULLIF(regexp_extract(zip_text, '(\\d{{5}})', 1), '') AS zip, l_orderkey * 100 + l_linenumber AS ord,
           CASE WHEN (ccs_count + chademo_count) > 0 OR (j3400_count > 0 AND j3400_kw >= 50)
                     OR (j3271_count > 0 AND j3271_kw >= 50) THEN 1 ELSE 0 END AS fast
    FROM charging_units),
stations AS (
    SELECT station_id, arg_min(station_name, ord) AS station_name, arg_min(zip, ord) AS zip,
           arg_min(latitude, ord) AS latitude, arg_min(longitude, ord) AS longitude, arg_min(network, ord) AS network,
           count(*) AS ports, least(sum(fast), count(*)) AS dc_fast_ports
    FROM units WHERE zip IS NOT NULL GROUP BY station_id),
zip_lookup AS (
    SELECT zip, entity, records FROM (
        SELECT zip, entity, records, row_number() OVER (PARTITION BY zip ORDER BY records DESC, entity) AS rn
        FROM (SELECT NULLIF(regexp_extract(zip_text, '(\\d{{5}})', 1), '') AS zip, entity, records FROM zip_rows)
        WHERE zip IS NOT NULL AND entity IS NOT NULL) WHERE rn = 1),
attached AS (
    SELECT s.station_id, s.station_name, lpad(s.zip, 5, '0') AS zip, s.latitude, s.longitude, s.network, s.ports,
           s.dc_fast_ports, z.entity
    FROM stations s LEFT JOIN zip_lookup z ON lpad(s.zip, 5, '0') = lpad(z.zip, 5, '0')),
latest AS (SELECT max(month) AS m FROM live_monthly),
windows AS (
    SELECT * FROM (
        SELECT {TITLE.format('entity')} AS entity,
               sum(CASE WHEN month BETWEEN CAST(m - INTERVAL 11 MONTH AS DATE) AND m THEN ev_transactions ELSE 0 END) AS recent_ev_transactions,
               sum(CASE WHEN month BETWEEN CAST(m - INTERVAL 23 MONTH AS DATE) AND CAST(m - INTERVAL 12 MONTH AS DATE)
                        THEN ev_transactions ELSE 0 END) AS prior_ev_transactions,
               max(CASE WHEN month BETWEEN CAST(m - INTERVAL 23 MONTH AS DATE) AND m THEN 1 ELSE 0 END) AS any_row
        FROM live_monthly, latest GROUP BY 1) WHERE any_row = 1),
supply AS (
    SELECT {TITLE.format('entity')} AS entity, count(DISTINCT station_id) AS public_stations, sum(ports) AS public_ports,
           sum(dc_fast_ports) AS dc_fast_ports
    FROM attached WHERE entity IS NOT NULL GROUP BY 1),
m0 AS (
    SELECT b.entity, b.ev_stock,
           CAST(COALESCE(w.recent_ev_transactions, 0) AS BIGINT) AS recent_ev_transactions,
           CAST(COALESCE(w.prior_ev_transactions, 0) AS BIGINT) AS prior_ev_transactions,
           CAST(COALESCE(s.public_stations, 0) AS BIGINT) AS public_stations,
           CAST(COALESCE(s.public_ports, 0) AS BIGINT) AS public_ports,
           CAST(COALESCE(s.dc_fast_ports, 0) AS BIGINT) AS dc_fast_ports
    FROM (SELECT {TITLE.format('entity')} AS entity, ev_stock FROM live_pop) b
    LEFT JOIN windows w ON w.entity = b.entity LEFT JOIN supply s ON s.entity = b.entity),
m1 AS (
    SELECT *, CAST(recent_ev_transactions - prior_ev_transactions AS DOUBLE) / NULLIF(CAST(prior_ev_transactions AS DOUBLE), 0) * 100.0
                AS registration_growth_pct,
           CAST(ev_stock AS DOUBLE) / NULLIF(CAST(public_ports AS DOUBLE), 0) AS evs_per_port,
           CAST(dc_fast_ports AS DOUBLE) / NULLIF(CAST(public_ports AS DOUBLE), 0) * 100.0 AS dc_fast_share_pct
    FROM m0),
gq AS (SELECT quantile_cont(registration_growth_pct, 0.05) AS p05, quantile_cont(registration_growth_pct, 0.95) AS p95 FROM m1),
m2 AS (SELECT m1.*, CASE WHEN registration_growth_pct IS NULL THEN NULL
                         ELSE least(greatest(registration_growth_pct, p05), p95) END AS growth_c FROM m1, gq),
gm AS (SELECT quantile_cont(growth_c, 0.5) AS med FROM m2),
m3 AS (SELECT m2.*, COALESCE(evs_per_port, CAST(ev_stock AS DOUBLE)) AS gap_in, COALESCE(growth_c, med, 0.0) AS mom_in,
              100.0 - COALESCE(dc_fast_share_pct, 0.0) AS low_in FROM m2, gm),
m4 AS (
    SELECT *,
      (rank() OVER (ORDER BY ev_stock) + (count(*) OVER (PARTITION BY ev_stock) - 1) / 2.0) / count(*) OVER () AS r_stock,
      (rank() OVER (ORDER BY recent_ev_transactions) + (count(*) OVER (PARTITION BY recent_ev_transactions) - 1) / 2.0)
          / count(*) OVER () AS r_recent,
      (rank() OVER (ORDER BY gap_in) + (count(*) OVER (PARTITION BY gap_in) - 1) / 2.0) / count(*) OVER () AS gap,
      (rank() OVER (ORDER BY mom_in) + (count(*) OVER (PARTITION BY mom_in) - 1) / 2.0) / count(*) OVER () AS mom,
      (rank() OVER (ORDER BY low_in) + (count(*) OVER (PARTITION BY low_in) - 1) / 2.0) / count(*) OVER () AS low
    FROM m3),
m5 AS (
    SELECT *, round(100.0 * (CAST(0.4 AS DOUBLE) * ((r_stock + r_recent) / 2.0) + CAST(0.3 AS DOUBLE) * gap
                             + CAST(0.2 AS DOUBLE) * mom + CAST(0.1 AS DOUBLE) * low), 1) AS opportunity_score FROM m4),
live_metrics AS (
    SELECT entity, ev_stock, recent_ev_transactions, prior_ev_transactions, registration_growth_pct, public_stations,
           public_ports, dc_fast_ports, evs_per_port, dc_fast_share_pct, opportunity_score,
           rank() OVER (ORDER BY opportunity_score DESC) AS opportunity_rank
    FROM m5)"""


def live_sql(body: str) -> str:
    return B.with_bindings(f"WITH {LIVE_SQL}\n{body}", "population", "live_registrations", "charging_units", "zip_rows")


def r6(df, cols):
    return df.withColumns({c: F.round(F.col(c), 6) for c in cols})


@register("a11_live_stock", live_sql("SELECT * FROM live_pop"))
def a11_live_stock(spark, sf):
    return live_population(spark, sf)


@register("a12_live_monthly_registrations", live_sql("SELECT * FROM live_monthly"))
def a12_live_monthly_registrations(spark, sf):
    return live_monthly(spark, sf)


@register("a13_zip_record_counts", live_sql("SELECT * FROM zip_rows"))
def a13_zip_record_counts(spark, sf):
    return B.zip_rows(spark, sf)


@register("c12_station_rollup", live_sql("SELECT * FROM stations"))
def c12_station_rollup(spark, sf):
    return stations_of(spark, sf)


@register("a09_station_totals", live_sql("""
    SELECT count(*) AS stations, sum(ports) AS ports, sum(dc_fast_ports) AS dc_fast_ports,
           count(DISTINCT network) AS networks FROM stations"""))
def a09_station_totals(spark, sf):
    return stations_of(spark, sf).agg(F.count(F.lit(1)).alias("stations"), F.sum("ports").alias("ports"),
                                      F.sum("dc_fast_ports").alias("dc_fast_ports"),
                                      F.countDistinct("network").alias("networks"))


@register("c13_zip_majority", live_sql("SELECT * FROM zip_lookup"))
def c13_zip_majority(spark, sf):
    return score.zip_majority(B.zip_rows(spark, sf))


@register("c14_attach_entities", live_sql("SELECT * FROM attached"))
def c14_attach_entities(spark, sf):
    return attached_stations(spark, sf)


@register("a10_charger_supply", live_sql("SELECT * FROM supply"))
def a10_charger_supply(spark, sf):
    return score.charger_supply(attached_stations(spark, sf))


@register("c15_registration_windows", live_sql("SELECT entity, recent_ev_transactions, prior_ev_transactions FROM windows"))
def c15_registration_windows(spark, sf):
    return score.registration_windows(live_monthly(spark, sf))


SCORE_ROUND = ["registration_growth_pct", "evs_per_port", "dc_fast_share_pct"]


@register("c16_opportunity_score", live_sql("""
    SELECT entity, ev_stock, recent_ev_transactions, prior_ev_transactions, round(registration_growth_pct, 6) AS registration_growth_pct,
           public_stations, public_ports, dc_fast_ports, round(evs_per_port, 6) AS evs_per_port,
           round(dc_fast_share_pct, 6) AS dc_fast_share_pct, opportunity_score, opportunity_rank
    FROM live_metrics"""))
def c16_opportunity_score(spark, sf):
    return r6(metrics_of(spark, sf), SCORE_ROUND).orderBy("opportunity_rank", "entity")


@register("a23_statewide_totals", live_sql("""
    SELECT (SELECT sum(ev_stock) FROM live_pop) AS ev_stock, CAST(sum(recent_ev_transactions) AS BIGINT) AS recent_ev_transactions,
           (SELECT count(DISTINCT station_id) FROM attached) AS public_stations,
           (SELECT CAST(sum(ports) AS BIGINT) FROM attached) AS public_ports,
           (SELECT CAST(sum(dc_fast_ports) AS BIGINT) FROM attached) AS dc_fast_ports,
           count(*) AS entities_scored, (SELECT strftime(max(month), '%Y-%m') FROM live_monthly) AS latest_registration_month
    FROM live_metrics"""))
def a23_statewide_totals(spark, sf):
    pop, monthly, stations = live_population(spark, sf), live_monthly(spark, sf), attached_stations(spark, sf)
    return score.statewide_totals(pop, monthly, stations, score.opportunity_score(pop, monthly, stations))


@register("w05_rank_pct", live_sql("""
    SELECT entity, ev_stock, (rank() OVER (ORDER BY ev_stock) + (count(*) OVER (PARTITION BY ev_stock) - 1) / 2.0)
           / count(*) OVER () AS stock_pct FROM live_pop"""))
def w05_rank_pct(spark, sf):
    return rank_pct(live_population(spark, sf), "ev_stock", "stock_pct")


@register("w06_rank_min_desc", live_sql("""
    SELECT station_id, ports, rank() OVER (ORDER BY ports DESC) AS ports_rank FROM stations"""))
def w06_rank_min_desc(spark, sf):
    return rank_min(stations_of(spark, sf).select("station_id", "ports"), "ports", "ports_rank")


@register("w07_majority", B.with_bindings("""
    SELECT entity, ev_type, n FROM (
        SELECT entity, ev_type, n, row_number() OVER (PARTITION BY entity ORDER BY n DESC, ev_type) AS rn
        FROM (SELECT entity, ev_type, count(*) AS n FROM population GROUP BY 1, 2)) WHERE rn = 1""", "population"))
def w07_majority(spark, sf):
    """Most frequent vehicle type per entity, ties to the smaller name."""
    counts = B.population(spark, sf).groupBy("entity", "ev_type").agg(F.count(F.lit(1)).alias("records"))
    best = score.zip_majority(counts.select(F.col("entity").alias("zip_text"), F.col("ev_type").alias("entity"), "records")) \
        if False else counts.groupBy("entity").agg(F.min(F.struct((-F.col("records")).alias("nr"), F.col("ev_type").alias("t"))).alias("b"))
    return best.select("entity", F.col("b.t").alias("ev_type"), (-F.col("b.nr")).alias("n"))


@register("k02_list_entities", live_sql("SELECT DISTINCT entity FROM live_metrics ORDER BY entity"))
def k02_list_entities(spark, sf):
    return metrics_of(spark, sf).select("entity").distinct().orderBy("entity")
