"""Supply roll-ups and the transparent opportunity score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.functions import clip, extract_zip, norm_key, norm_zip, safe_ratio, to_number
from panelspark.operators.order_stats import quantiles, rank_min, rank_pct_many
from panelspark.session import cut_lineage

# Score weights (demand, supply gap, momentum, limited fast
# charging) and the DC-fast power floor in kW.
SCORE_WEIGHTS = (0.40, 0.30, 0.20, 0.10)
FAST_KW = 50.0

METRIC_COLUMNS = ("entity", "ev_stock", "recent_ev_transactions", "prior_ev_transactions", "registration_growth_pct",
                  "public_stations", "public_ports", "dc_fast_ports", "evs_per_port", "dc_fast_share_pct",
                  "opportunity_score", "opportunity_rank")


def _first_non_null(c: str, ordinal: Column) -> Column:
    """First non-null value in `ordinal` order, as an aggregate (no sort of the group)."""
    return F.min_by(F.col(c), F.when(F.col(c).isNotNull(), ordinal))


def _number(df: DataFrame, name: str) -> Column:
    """A column as double; text that is no number, blank text too, is NULL."""
    return to_number(name) if dict(df.dtypes)[name] == "string" else F.col(name).cast("double")


def station_rollup(units: DataFrame, ordinal: Column | None = None) -> DataFrame:
    """Charging units -> stations (C12, A09). A unit is one port; it is fast
    when it has a CCS/CHAdeMO connector, or a J3400/J3271 connector at
    >= 50 kW. Units without a 5-digit ZIP drop. Station attributes are the
    first non-null in unit order; fast ports are capped at ports. Missing
    connector/power columns act as 0."""
    def num(c):
        return F.coalesce(_number(units, c), F.lit(0.0)) if c in units.columns else F.lit(0.0)
    dedicated = (num("ccs_count") + num("chademo_count")) > 0
    shared = ((num("j3400_count") > 0) & (num("j3400_kw") >= FAST_KW)) | ((num("j3271_count") > 0) & (num("j3271_kw") >= FAST_KW))
    ordinal = ordinal if ordinal is not None else F.monotonically_increasing_id()
    u = units.select(
        F.col("station_id").cast("string").alias("station_id"),
        F.coalesce(F.col("station_name"), F.lit("")).alias("station_name"),
        extract_zip("zip_text").alias("zip"),
        _number(units, "latitude").alias("latitude"), _number(units, "longitude").alias("longitude"),
        F.coalesce(F.col("network"), F.lit("")).alias("network"),
        (dedicated | shared).cast("bigint").alias("fast"), ordinal.alias("_ord"),
    ).where(F.col("zip").isNotNull())
    o = F.col("_ord")
    g = u.groupBy("station_id").agg(
        *[_first_non_null(c, o).alias(c) for c in ("station_name", "zip", "latitude", "longitude", "network")],
        F.count(F.lit(1)).alias("ports"), F.sum("fast").alias("_fast"))
    return g.withColumn("dc_fast_ports", F.least(F.col("_fast"), F.col("ports"))).drop("_fast")


def zip_majority(zip_rows: DataFrame) -> DataFrame:
    """ZIP -> entity with the most records, ties to the smaller entity name
    (C13, W07). An arg-min aggregate, so it combines map-side: a ZIP with a
    third of all rows still never lands whole in one task."""
    z = zip_rows.select(extract_zip("zip_text").alias("zip"), F.col("entity"),
                        F.coalesce(_number(zip_rows, "records").cast("bigint"), F.lit(0)).alias("records"))
    z = z.where(F.col("zip").isNotNull() & F.col("entity").isNotNull())
    best = z.groupBy("zip").agg(F.min(F.struct((-F.col("records")).alias("nr"), F.col("entity").alias("e"), )).alias("b"))
    return best.select("zip", F.col("b.e").alias("entity"), (-F.col("b.nr")).alias("records"))


def attach_entities(stations: DataFrame, lookup: DataFrame, check_unique: bool = True) -> DataFrame:
    """Many-to-one left join of stations to the ZIP lookup on the padded ZIP
    (C14, J06). With `check_unique` the right side is asserted unique per
    ZIP inside the same plan: one aggregate per padded ZIP counts its rows
    and `raise_error` fails the query if any ZIP has two -- no separate pass
    over the lookup on the driver."""
    right = lookup.select(norm_zip("zip").alias("zip"), "entity")
    if check_unique:
        right = right.groupBy("zip").agg(F.count(F.lit(1)).alias("_n"), F.min("entity").alias("entity")).select(
            "zip", F.when(F.col("_n") > 1, F.raise_error(F.lit("ZIP lookup is not unique per ZIP")))
            .otherwise(F.col("entity")).alias("entity"))
    return stations.withColumn("zip", norm_zip("zip")).join(right, "zip", "left")


def registration_windows(monthly: DataFrame, entity: str = "entity", month: str = "month",
                         value: str = "ev_transactions") -> DataFrame:
    """Last 12 and previous 12 calendar months relative to the latest month
    (C15, A08, J08). One pass of conditional sums replaces the full outer
    join of two window aggregates; entities with no row in either window
    do not appear, as in the join."""
    latest = monthly.select(F.max(F.trunc(F.col(month).cast("date"), "MM"))).scalar()
    m = F.trunc(F.col(month).cast("date"), "MM")
    recent = (m >= F.add_months(latest, -11)) & (m <= latest)
    prior = (m >= F.add_months(latest, -23)) & (m <= F.add_months(latest, -12))
    g = monthly.withColumn("_e", norm_key(entity)).groupBy("_e").agg(
        F.sum(F.when(recent, F.col(value)).otherwise(0)).alias("recent_ev_transactions"),
        F.sum(F.when(prior, F.col(value)).otherwise(0)).alias("prior_ev_transactions"),
        F.max((recent | prior).cast("int")).alias("_any"))
    return g.where(F.col("_any") == 1).select(F.col("_e").alias("entity"), "recent_ev_transactions", "prior_ev_transactions")


def charger_supply(stations: DataFrame) -> DataFrame:
    """Distinct stations, ports, fast ports per entity (A10)."""
    located = stations.where(F.col("entity").isNotNull()).withColumn("entity", norm_key("entity"))
    return located.groupBy("entity").agg(F.countDistinct("station_id").alias("public_stations"),
                                         F.sum("ports").alias("public_ports"),
                                         F.sum("dc_fast_ports").alias("dc_fast_ports"))


def opportunity_score(population: DataFrame, monthly: DataFrame, stations: DataFrame) -> DataFrame:
    """Entity metrics and the weighted percentile score.

    growth % is winsorised to its 5th-95th percentiles and NULL growth takes
    the median (if every growth is NULL, all tie); EVs-per-port NULL takes the stock; low-fast = 100 - share
    (NULL share = 0). demand = mean of the stock and recent-flow percentile
    ranks; score = 100 * weighted sum, rounded to 1 digit; rank = min rank
    of the rounded score, descending. Counts missing after the joins are 0.
    Percentile ranks and quantiles are exact and distributed."""
    base = population.select(norm_key("entity").alias("entity"), F.col("ev_stock").cast("bigint").alias("ev_stock"))
    m = base.join(registration_windows(monthly), "entity", "left").join(charger_supply(stations), "entity", "left")
    for c in ("recent_ev_transactions", "prior_ev_transactions", "public_stations", "public_ports", "dc_fast_ports"):
        m = m.withColumn(c, F.coalesce(F.col(c), F.lit(0)).cast("bigint"))
    m = m.withColumns({
        "registration_growth_pct": safe_ratio(F.col("recent_ev_transactions") - F.col("prior_ev_transactions"),
                                              "prior_ev_transactions") * 100.0,
        "evs_per_port": safe_ratio("ev_stock", "public_ports"),
        "dc_fast_share_pct": safe_ratio("dc_fast_ports", "public_ports") * 100.0,
    })
    # written once for the ranking passes; ranks belong to rows, as names that differ in case only share their key
    m = cut_lineage(m.withColumn("_row", F.monotonically_increasing_id()))
    # p5, p95 and the median in one ranking pass: clipping is non-decreasing,
    # so the median of the clipped growth comes from the raw order statistics
    q = cut_lineage(quantiles(m, "registration_growth_pct", {"p05": 0.05, "p95": 0.95, "med": 0.5}, parts=("med",)))
    p05, p95 = q.select("p05").scalar(), q.select("p95").scalar()
    m = m.withColumn("_growth", clip("registration_growth_pct", p05, p95))
    lo, hi = clip(q.med_lo, q.p05, q.p95), clip(q.med_hi, q.p05, q.p95)
    med = q.select(lo + (hi - lo) * q.med_fr).scalar()
    m = m.withColumns({
        "_gap_in": F.coalesce(F.col("evs_per_port"), F.col("ev_stock").cast("double")),
        # all-NULL growth (no prior activity anywhere): every entity ties
        "_mom_in": F.coalesce(F.col("_growth"), med, F.lit(0.0)),
        "_low_in": F.lit(100.0) - F.coalesce(F.col("dc_fast_share_pct"), F.lit(0.0)),
    })
    m = rank_pct_many(m, "_row", {"ev_stock": "_r_stock", "recent_ev_transactions": "_r_recent", "_gap_in": "_gap",
                                    "_mom_in": "_mom", "_low_in": "_low"})
    wd, wg, wm, wl = SCORE_WEIGHTS
    demand = (F.col("_r_stock") + F.col("_r_recent")) / 2.0
    raw = F.lit(100.0) * (F.lit(wd) * demand + F.lit(wg) * F.col("_gap") + F.lit(wm) * F.col("_mom") + F.lit(wl) * F.col("_low"))
    m = m.withColumn("opportunity_score", F.round(raw, 1))
    m = rank_min(m, "opportunity_score", "opportunity_rank", descending=True)
    return m.select(*METRIC_COLUMNS)


def statewide_totals(population: DataFrame, monthly: DataFrame, stations: DataFrame, metrics: DataFrame) -> DataFrame:
    """Six statewide totals and the latest month (A23), one row."""
    return metrics.agg(
        F.coalesce(F.sum("recent_ev_transactions"), F.lit(0)).cast("bigint").alias("recent_ev_transactions"),
        F.count(F.lit(1)).alias("entities_scored"),
    ).select(
        population.select(F.coalesce(F.sum("ev_stock"), F.lit(0)).cast("bigint")).scalar().alias("ev_stock"),
        "recent_ev_transactions",
        stations.select(F.countDistinct("station_id")).scalar().alias("public_stations"),
        stations.select(F.coalesce(F.sum("ports"), F.lit(0)).cast("bigint")).scalar().alias("public_ports"),
        stations.select(F.coalesce(F.sum("dc_fast_ports"), F.lit(0)).cast("bigint")).scalar().alias("dc_fast_ports"),
        "entities_scored",
        monthly.select(F.date_format(F.max("month"), "yyyy-MM")).scalar().alias("latest_registration_month"),
    )
