"""DuckDB SQL fragments shared by oracle queries (independent of the Spark
plans: they restate the semantics in plain SQL over the same tables)."""

from panelspark.sources.bindings import ELECTRIC_FUEL, with_bindings

FLOW = f"""flow AS (
    SELECT entity, CAST(date_trunc('month', txn_date) AS DATE) AS month,
           CAST(sum(cnt) AS DOUBLE) AS all_transactions,
           CAST(sum(CASE WHEN fuel = '{ELECTRIC_FUEL}' THEN cnt ELSE 0 END) AS DOUBLE) AS ev_transactions
    FROM registrations WHERE entity IN (SELECT n_name FROM nation) AND txn_date IS NOT NULL
    GROUP BY 1, 2)"""

DENSE = """bounds AS (SELECT min(month) AS lo, max(month) AS hi FROM flow),
grid AS (
    SELECT e.entity, CAST(unnest(generate_series(b.lo, b.hi, INTERVAL 1 MONTH)) AS DATE) AS month
    FROM (SELECT DISTINCT entity FROM flow) e, bounds b),
dense AS (
    SELECT g.entity, g.month, COALESCE(f.ev_transactions, 0.0) AS ev_transactions
    FROM grid g LEFT JOIN flow f ON f.entity = g.entity AND f.month = g.month)"""

FEATURES = """feat_all AS (
    SELECT entity, month, ev_transactions,
           lag(ev_transactions, 1) OVER w AS lag_1,
           lag(ev_transactions, 2) OVER w AS lag_2,
           CASE WHEN count(ev_transactions) OVER w3 = 3 THEN avg(ev_transactions) OVER w3 END AS lag_3_mean,
           lag(ev_transactions, 12) OVER w AS lag_12,
           lag(ev_transactions, 13) OVER w AS lag_13,
           CASE WHEN count(ev_transactions) OVER w12 = 12 THEN avg(ev_transactions) OVER w12 END AS lag_12_mean,
           avg(ev_transactions) OVER wexp AS entity_scale,
           sin(2 * pi() * month(month) / 12.0) AS month_sin,
           cos(2 * pi() * month(month) / 12.0) AS month_cos,
           CAST((year(month) - (SELECT year(lo) FROM bounds)) * 12 + month(month) - (SELECT month(lo) FROM bounds) AS BIGINT) AS month_index
    FROM dense
    WINDOW w AS (PARTITION BY entity ORDER BY month),
           w3 AS (PARTITION BY entity ORDER BY month ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING),
           w12 AS (PARTITION BY entity ORDER BY month ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING),
           wexp AS (PARTITION BY entity ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
features AS (
    SELECT *, lag_1 - lag_13 AS yoy_gap, lag_3_mean / (lag_12_mean + 1.0) AS recent_vs_year
    FROM feat_all
    WHERE lag_1 IS NOT NULL AND lag_2 IS NOT NULL AND lag_3_mean IS NOT NULL AND lag_12 IS NOT NULL
      AND lag_13 IS NOT NULL AND lag_12_mean IS NOT NULL AND entity_scale IS NOT NULL)"""

SPLITS = """split_bounds AS (
    SELECT CAST(max(month) - INTERVAL 11 MONTH AS DATE) AS test_start,
           CAST(max(month) - INTERVAL 23 MONTH AS DATE) AS val_start FROM features),
splits AS (
    SELECT f.*, CASE WHEN month >= test_start THEN 'test' WHEN month >= val_start THEN 'validation'
                     ELSE 'train' END AS split
    FROM features f, split_bounds)"""


def flow_sql(body: str, *extra: str) -> str:
    return with_bindings("WITH " + ",\n".join([FLOW, *extra]) + "\n" + body, "registrations")


def dense_sql(body: str, *extra: str) -> str:
    return flow_sql(body, DENSE, *extra)


def features_sql(body: str, *extra: str) -> str:
    return flow_sql(body, DENSE, FEATURES, *extra)


def splits_sql(body: str, *extra: str) -> str:
    return flow_sql(body, DENSE, FEATURES, SPLITS, *extra)


FEATURE_ROUND = ", ".join(f"round({c}, 6) AS {c}" for c in (
    "lag_1", "lag_2", "lag_3_mean", "lag_12", "lag_13", "lag_12_mean", "yoy_gap", "recent_vs_year",
    "month_sin", "month_cos", "entity_scale")) + ", month_index"


VEHICLES = """dedup AS (
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY entity, make, model, model_year, rng, ev_type,
                                     location, l_partkey, l_suppkey, l_extendedprice, l_discount, l_tax) AS rn
        FROM population WHERE entity IN (SELECT n_name FROM nation)) WHERE rn = 1),
veh AS (SELECT *, COALESCE(rng > 0, false) AS range_observed FROM dedup),
med_mmy AS (SELECT make, model, model_year, quantile_cont(rng, 0.5) AS m FROM veh WHERE range_observed GROUP BY ALL),
med_mm AS (SELECT make, model, quantile_cont(rng, 0.5) AS m FROM veh WHERE range_observed GROUP BY ALL),
med_t AS (SELECT ev_type, quantile_cont(rng, 0.5) AS m FROM veh WHERE range_observed GROUP BY ALL),
med_all AS (SELECT quantile_cont(rng, 0.5) AS m FROM veh WHERE range_observed),
vehicles AS (
    SELECT v.*, COALESCE(CASE WHEN v.range_observed THEN v.rng END, a.m, b.m, c.m, (SELECT m FROM med_all)) AS estimated_range,
           COALESCE(contains(v.ev_type, 'BEV'), false) AS is_bev,
           TRY_CAST(NULLIF(regexp_extract(v.location, 'POINT \\((-?\\d+\\.?\\d*) (-?\\d+\\.?\\d*)\\)', 1), '') AS DOUBLE) AS longitude,
           TRY_CAST(NULLIF(regexp_extract(v.location, 'POINT \\((-?\\d+\\.?\\d*) (-?\\d+\\.?\\d*)\\)', 2), '') AS DOUBLE) AS latitude
    FROM veh v
    LEFT JOIN med_mmy a ON a.make = v.make AND a.model = v.model AND a.model_year = v.model_year
    LEFT JOIN med_mm b ON b.make = v.make AND b.model = v.model
    LEFT JOIN med_t c ON c.ev_type = v.ev_type)"""

STOCK = """stock AS (
    SELECT entity, count(*) AS total_evs, avg(estimated_range) AS avg_range_miles,
           avg(CAST(range_observed AS DOUBLE)) AS observed_range_share, avg(CAST(is_bev AS DOUBLE)) AS bev_share,
           quantile_cont(latitude, 0.5) AS latitude, quantile_cont(longitude, 0.5) AS longitude
    FROM vehicles GROUP BY entity)"""


def vehicles_sql(body: str, *extra: str) -> str:
    return with_bindings("WITH " + ",\n".join([VEHICLES, *extra]) + "\n" + body, "population")


# closed-form predictions on the test split
PREDS = """preds AS (
    SELECT entity, month, split, ev_transactions AS actual, lag_12 AS lag_12_baseline,
           lag_12_mean AS trailing_mean_12, lag_1 AS last_value FROM splits)"""

CONFORMAL = """cbounds AS (SELECT max(month) AS last FROM features),
periods AS (
    SELECT f.*, CASE WHEN month >= CAST(last - INTERVAL 11 MONTH AS DATE) THEN 'test'
                     WHEN month >= CAST(last - INTERVAL 23 MONTH AS DATE) THEN 'calibration'
                     WHEN month >= CAST(last - INTERVAL 35 MONTH AS DATE) THEN 'selection' ELSE 'train' END AS period
    FROM features f, cbounds),
strata AS (
    SELECT entity, mean_volume, position, entities,
           ['low', 'medium', 'high'][ntile(3) OVER (ORDER BY mean_volume, entity)] AS volume_group,
           position = floor(entities / 2) + 1 AS representative
    FROM (SELECT entity, mean_volume, row_number() OVER (ORDER BY mean_volume, entity) AS position,
                 count(*) OVER () AS entities
          FROM (SELECT entity, avg(ev_transactions) AS mean_volume FROM periods
                WHERE period IN ('train', 'selection') GROUP BY entity))),
cal AS (
    SELECT p.entity, s.volume_group, abs(p.ev_transactions - p.lag_12) AS absolute_error
    FROM periods p JOIN strata s USING (entity) WHERE period = 'calibration'),
cq AS (
    SELECT volume_group, level, absolute_error AS q, n FROM (
        SELECT volume_group, lv.level, absolute_error,
               row_number() OVER (PARTITION BY volume_group, lv.level ORDER BY absolute_error) AS k,
               count(*) OVER (PARTITION BY volume_group, lv.level) AS n
        FROM cal, (VALUES (80), (95)) lv(level))
    WHERE k = least(n, CAST(ceil((n + 1) * (level / 100.0)) AS BIGINT))),
intervals AS (
    SELECT p.entity, p.month, p.ev_transactions AS actual, p.lag_12 AS prediction, s.volume_group,
           greatest(0.0, p.lag_12 - a.q) AS lower_80, p.lag_12 + a.q AS upper_80,
           greatest(0.0, p.lag_12 - b.q) AS lower_95, p.lag_12 + b.q AS upper_95
    FROM periods p JOIN strata s USING (entity)
    LEFT JOIN cq a ON a.volume_group = s.volume_group AND a.level = 80
    LEFT JOIN cq b ON b.volume_group = s.volume_group AND b.level = 95
    WHERE p.period = 'test')"""
