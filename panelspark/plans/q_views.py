"""Read-side and scalar-function queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.functions import (clip, label_by, month_index, months_back, norm_key, norm_zip, safe_ratio,
                                  strict_number, to_month, to_number)
from panelspark.operators import clean, views
from panelspark.plans.catalog import register
from panelspark.plans.oracle_sql import STOCK, features_sql, flow_sql, vehicles_sql
from panelspark.plans.q_clean import stock_of, vehicles_of
from panelspark.plans.q_flow import features_of, flow_of
from panelspark.plans.q_quality import RAW_SQL, _num, raw_population, raw_registrations
from panelspark.plans.q_score import LIVE_SQL, attached_stations, live_sql, metrics_of
from panelspark.plans.q_series import FUTURE_SQL, SERIES_SQL, fit_sql, forecast, series_of
from panelspark.plans.q_store import LONG_SQL, WIDE_SQL, s13_load_forecasts
from panelspark.sources import bindings as B


def raw_sql(body):
    return B.with_bindings(f"WITH {RAW_SQL}\n{body}", "registrations", "population")


@register("q01_list_entities", vehicles_sql("SELECT entity FROM stock ORDER BY entity", STOCK))
def q01_list_entities(spark, sf):
    return stock_of(spark, sf).select("entity").orderBy("entity")


@register("q02_forecast_by_entity", flow_sql("""
    SELECT scope, entity, forecast_date, model, predicted_transactions, run_id FROM long
    WHERE scope = 'entity' AND lower(entity) = 'nation_3'""", SERIES_SQL, FUTURE_SQL, WIDE_SQL, LONG_SQL))
def q02_forecast_by_entity(spark, sf):
    """Case-insensitive lookup of one entity's forecasts ('statewide' is a keyword, unknown raises)."""
    return views.forecast_for(s13_load_forecasts(spark, sf), "nation_3")


@register("q02_forecast_statewide", flow_sql("""
    SELECT scope, forecast_date, model, predicted_transactions, run_id FROM long WHERE scope = 'statewide'""",
                                             SERIES_SQL, FUTURE_SQL, WIDE_SQL, LONG_SQL))
def q02_forecast_statewide(spark, sf):
    return views.forecast_for(s13_load_forecasts(spark, sf), "Statewide")


@register("q04_live_entity", live_sql("""
    SELECT entity, ev_stock, recent_ev_transactions, prior_ev_transactions, public_ports, opportunity_score, opportunity_rank
    FROM live_metrics WHERE lower(entity) = 'nation_7'"""))
def q04_live_entity(spark, sf):
    m = views.lookup(metrics_of(spark, sf), "entity", "NATION_7")
    return m.select("entity", "ev_stock", "recent_ev_transactions", "prior_ev_transactions", "public_ports",
                    "opportunity_score", "opportunity_rank")


@register("q05_stations_by_entity", live_sql("""
    SELECT station_id, entity, ports, count(*) OVER () AS count FROM attached WHERE lower(entity) = 'nation_11'"""))
def q05_stations_by_entity(spark, sf):
    return views.stations_for(attached_stations(spark, sf).select("station_id", "entity", "ports"), "nation_11")


@register("q06_history_and_forecast", flow_sql(f"""
    SELECT month, value, 'history' AS kind FROM series WHERE series = 'NATION_5'
    UNION ALL SELECT month, CAST(round_even(prediction, 0) AS DOUBLE), 'forecast' FROM ({fit_sql('fut', 'series', 'seasonal_naive')})
    WHERE series = 'NATION_5'""", SERIES_SQL, FUTURE_SQL))
def q06_history_and_forecast(spark, sf):
    hist = series_of(spark, sf).where(F.col("series") == "NATION_5")
    fc = forecast(spark, sf, "seasonal_naive").where(F.col("series") == "NATION_5")
    return views.history_and_forecast(hist, fc)


@register("q07_map_frame", vehicles_sql("SELECT entity, latitude, longitude FROM stock WHERE latitude IS NOT NULL AND longitude IS NOT NULL", STOCK))
def q07_map_frame(spark, sf):
    return views.map_frame(stock_of(spark, sf).select("entity", "latitude", "longitude"))


@register("q08_coverage_by_model_year", vehicles_sql("""
    SELECT CAST(model_year AS VARCHAR) AS value, count(*) AS records,
           round(sum(CAST(range_observed AS INT)) * 100.0 / count(*), 2) AS coverage_pct
    FROM vehicles GROUP BY model_year HAVING count(*) >= 1000 AND model_year >= 1995"""))
def q08_coverage_by_model_year(spark, sf):
    cov = clean.range_coverage(vehicles_of(spark, sf, columns=["model_year", "ev_type", "make", "entity", "range_observed"]))
    return cov.where((F.col("group") == "model_year") & (F.col("records") >= 1000) & (F.col("value").cast("int") >= 1995)) \
        .select("value", "records", "coverage_pct")


@register("q08_coverage_by_type_code", vehicles_sql("""
    SELECT regexp_extract(ev_type, '\\((BEV|PHEV)\\)', 1) AS type_code, count(*) AS records,
           round(sum(CAST(range_observed AS INT)) * 100.0 / count(*), 2) AS coverage_pct
    FROM vehicles GROUP BY 1"""))
def q08_coverage_by_type_code(spark, sf):
    v = vehicles_of(spark, sf, columns=["ev_type", "range_observed"]).withColumn("type_code", F.regexp_extract("ev_type", r"\((BEV|PHEV)\)", 1))
    return v.groupBy("type_code").agg(F.count(F.lit(1)).alias("records"),
                                      F.round(F.sum(F.col("range_observed").cast("int")) * 100.0 / F.count(F.lit(1)), 2).alias("coverage_pct"))


# --- scalar functions over the bound tables -------------------------------------

@register("p03_to_number", raw_sql(f"""
    SELECT id AS vehicle_id, rng AS raw_range, {_num('rng')} AS range_value FROM pop"""))
def p03_to_number(spark, sf):
    from panelspark.functions import null_tokens
    raw = raw_population(spark, sf)
    return raw.select(null_tokens("DOL Vehicle ID").alias("vehicle_id"), null_tokens("Electric Range").alias("raw_range")) \
        .withColumn("range_value", to_number("raw_range"))


@register("p04_strict_number", vehicles_sql("SELECT vehicle_id, CAST(CAST(model_year AS VARCHAR) AS DOUBLE) AS model_year FROM dedup"))
def p04_strict_number(spark, sf):
    """ANSI cast that raises on a bad value (the bound values are clean)."""
    pop = clean.dedupe_first(clean.filter_in(B.population(spark, sf), "entity", B.entities(spark, sf)), "vehicle_id", keep=["model_year"])
    return pop.select("vehicle_id", strict_number(F.col("model_year").cast("string")).alias("model_year"))


@register("p05_to_month", raw_sql("""
    SELECT d AS raw_date, CAST(date_trunc('month', COALESCE(try_strptime(trim(d), '%m/%d/%Y'), try_strptime(trim(d), '%Y-%m-%d'),
           try_strptime(trim(d), '%Y-%m-%dT%H:%M:%S.%g'), try_strptime(trim(d), '%Y-%m-%dT%H:%M:%S'),
           try_strptime(trim(d), '%Y-%m-%d %H:%M:%S'))) AS DATE) AS month FROM reg"""))
def p05_to_month(spark, sf):
    from panelspark.functions import null_tokens
    raw = raw_registrations(spark, sf).select(null_tokens("Transaction Date").alias("raw_date"))
    return raw.withColumn("month", to_month("raw_date"))


@register("p06_drop_null", raw_sql(f"""
    SELECT count(*) AS kept FROM reg WHERE COALESCE(try_strptime(trim(d), '%m/%d/%Y'), try_strptime(trim(d), '%Y-%m-%d')) IS NOT NULL
      AND ({_num('cnt')}) IS NOT NULL"""))
def p06_drop_null(spark, sf):
    from panelspark.functions import null_tokens
    raw = raw_registrations(spark, sf)
    parsed = raw.select(to_month(null_tokens("Transaction Date")).alias("m"), to_number(null_tokens("Count")).alias("c"))
    return parsed.na.drop(subset=["m", "c"]).agg(F.count(F.lit(1)).alias("kept"))


@register("p07_is_positive", vehicles_sql("""
    SELECT range_observed, count(*) AS vehicles FROM vehicles GROUP BY 1"""))
def p07_is_positive(spark, sf):
    return vehicles_of(spark, sf, columns=["range_observed"]).groupBy("range_observed").agg(F.count(F.lit(1)).alias("vehicles"))


@register("p08_fill", features_sql("""
    SELECT entity, month, COALESCE(lag_12, lag_1, (SELECT quantile_cont(ev_transactions, 0.5) FROM dense), 0.0) AS lag_12_filled
    FROM feat_all"""))
def p08_fill(spark, sf):
    """NULL fill by another column, then the median, then a constant."""
    from panelspark.operators.order_stats import quantiles
    from panelspark.operators import panel
    f = features_of(spark, sf, drop_incomplete=False)
    med = quantiles(panel.densify_panel(flow_of(spark, sf)), "ev_transactions", {"m": 0.5}).select("m").scalar()
    return f.select("entity", "month", F.coalesce("lag_12", "lag_1", med, F.lit(0.0)).alias("lag_12_filled"))


@register("p09_safe_ratio", flow_sql("""
    SELECT entity, month, round(ev_transactions / NULLIF(all_transactions - ev_transactions, 0.0), 6) AS ev_to_other FROM flow"""))
def p09_safe_ratio(spark, sf):
    f = flow_of(spark, sf)
    return f.select("entity", "month", F.round(safe_ratio("ev_transactions", F.col("all_transactions") - F.col("ev_transactions")), 6)
                    .alias("ev_to_other"))


@register("p10_clip", features_sql("SELECT entity, month, CASE WHEN lag_1 - lag_13 IS NOT NULL THEN least(greatest(lag_1 - lag_13, -2.0), 2.0) END AS yoy_gap_clipped FROM feat_all"))
def p10_clip(spark, sf):
    f = features_of(spark, sf, drop_incomplete=False)
    return f.select("entity", "month", clip("yoy_gap", -2.0, 2.0).alias("yoy_gap_clipped"))


@register("p11_label_by", flow_sql("""
    SELECT entity, month, CASE WHEN ev_transactions < 1 THEN 'none' WHEN ev_transactions < 3 THEN 'low' ELSE 'high' END AS level
    FROM flow"""))
def p11_label_by(spark, sf):
    return flow_of(spark, sf).select("entity", "month", label_by("ev_transactions", [1, 3], ["none", "low", "high"]).alias("level"))


@register("p12_month_between", flow_sql("""
    SELECT entity, count(*) AS months_last_year FROM flow
    WHERE month > CAST((SELECT max(month) FROM flow) - INTERVAL 12 MONTH AS DATE) GROUP BY entity"""))
def p12_month_between(spark, sf):
    f = flow_of(spark, sf)
    last = f.select(F.max("month")).scalar()
    return f.where(F.col("month") > months_back(last, 12)).groupBy("entity").agg(F.count(F.lit(1)).alias("months_last_year"))


@register("p14_rename", flow_sql("SELECT entity AS county, month AS date, ev_transactions AS ev, 'flow' AS product FROM flow"))
def p14_rename(spark, sf):
    f = flow_of(spark, sf).withColumnsRenamed({"entity": "county", "month": "date", "ev_transactions": "ev"})
    return f.select("county", "date", "ev", F.lit("flow").alias("product"))


@register("p15_norm_key_zip", live_sql("""
    SELECT station_id, upper(substr(trim(entity), 1, 1)) || lower(substr(trim(entity), 2)) AS entity_key,
           lpad(substr(zip, 2), 5, '0') AS zip_padded FROM attached"""))
def p15_norm_key_zip(spark, sf):
    """Title-cased keys; a 4-digit ZIP form zero-padded back to 5."""
    s = attached_stations(spark, sf)
    return s.select("station_id", norm_key("entity").alias("entity_key"), norm_zip(F.substring("zip", 2, 4)).alias("zip_padded"))


@register("p16_drop_if_present", flow_sql("SELECT entity, month, ev_transactions FROM flow"))
def p16_drop_if_present(spark, sf):
    f = views.drop_if_present(views.drop_if_present(flow_of(spark, sf), "all_transactions"), "entity_county")
    return f
