"""Cleaning of the raw fact and inventory tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.functions import is_positive, to_month, to_number, wkt_point
from panelspark.operators.order_stats import quantiles
from panelspark.session import cut_lineage, write_once


def filter_in(df: DataFrame, column: str, allowed: DataFrame | Sequence[str] | None) -> DataFrame:
    """Membership filter (P01). A DataFrame of allowed keys becomes a left
    semi join (the optimizer broadcasts it only when it measures it small);
    a short literal list becomes an `IN` predicate pushed to the scan."""
    if allowed is None:
        return df
    if isinstance(allowed, DataFrame):
        key = allowed.columns[0]
        return df.join(allowed.select(F.col(key).alias(column)).distinct(), column, "left_semi")
    return df.where(F.col(column).isin(list(allowed)))


def dedupe_first(df: DataFrame, key: str, order: Sequence[str] | None = None, keep: Sequence[str] | None = None) -> DataFrame:
    """Keep one row per `key`: the first under the ascending total order of
    `order` (default: every other column) (P02). `keep` names the columns to
    return besides `key`. The order is lexicographic, so columns after the last
    kept one can't change a kept value and are neither read nor exchanged.

    Implemented as `min(struct(order..., rest...))` per key, which combines
    map-side before the shuffle, so a key holding a third of the rows never
    reaches one task whole (unlike `row_number() over (partition by key)`)."""
    rest = [c for c in df.columns if c != key]
    order = list(order) if order else rest
    others = [c for c in rest if c not in order]
    if keep is not None:
        ranked = [*order, *others]
        ranked = ranked[:max((i + 1 for i, c in enumerate(ranked) if c in keep), default=0)]
        if not ranked:
            return df.select(key).distinct()
        order, others = [c for c in order if c in ranked], [c for c in others if c in ranked]
    packed = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                      *[F.col(c).alias(f"_r{i}") for i, c in enumerate(others)])
    best = df.groupBy(key).agg(F.min(packed).alias("_best"))
    cols = [F.col(key)] + [F.col(f"_best._o{i}").alias(c) for i, c in enumerate(order)] + \
           [F.col(f"_best._r{i}").alias(c) for i, c in enumerate(others)]
    return best.select(*cols).select(*[c for c in df.columns if keep is None or c == key or c in keep])


def load_flow(registrations: DataFrame, entities: DataFrame | Sequence[str] | None = None, *,
              date: str = "txn_date", entity: str = "entity", fuel: str = "fuel", count: str = "cnt",
              electric: str = "Electric", parse_thousands: bool = False) -> DataFrame:
    """Monthly flow (C02): one conditional aggregation gives both the
    all-fuel and the electric sums per (entity, month) -- the left join of the
    two (J01) is not needed. Rows with an unparseable date or count drop."""
    date_is_text = dict(registrations.dtypes)[date] == "string"
    rows = filter_in(registrations, entity, entities).select(
        F.col(entity).alias("entity"),
        to_month(date, is_text=date_is_text).alias("month"),
        F.col(fuel).alias("fuel"),
        to_number(count, strip_commas=parse_thousands).alias("cnt"),
    ).where(F.col("month").isNotNull() & F.col("cnt").isNotNull() & F.col("entity").isNotNull())
    return rows.groupBy("entity", "month").agg(
        F.sum("cnt").cast("double").alias("all_transactions"),
        F.sum(F.when(F.col("fuel") == electric, F.col("cnt")).otherwise(F.lit(0.0))).cast("double").alias("ev_transactions"),
    )


def flow_audit(registrations: DataFrame, flow: DataFrame) -> DataFrame:
    """Audit row for the flow (A04): raw rows, first/last month, EV total."""
    return registrations.agg(F.count(F.lit(1)).alias("registration_rows_raw")).select(
        "registration_rows_raw",
        flow.select(F.min("month")).scalar().alias("first_month"),
        flow.select(F.max("month")).scalar().alias("last_month"),
        flow.select(F.sum("ev_transactions")).scalar().alias("electric_transactions_total"),
    )


DEFAULT_TIERS: tuple[tuple[str, ...], ...] = (("make", "model", "model_year"), ("make", "model"), ("ev_type",), ())


#: A tuple dictionary of at most so many rows is broadcast; a larger one is joined by shuffle, heavy tuples salted.
BROADCAST_TUPLES = 100_000
#: Rows of one tuple that a task of the shuffled join takes, about.
ROWS_PER_SALT = 1_000_000


def tier_keys(tiers: Sequence[Sequence[str]]) -> list[str]:
    """The keys of all tiers, those of the first tier first."""
    return sorted({k for t in tiers for k in t}, key=lambda k: [k in t for t in tiers].index(True))


def tier_medians(pairs: DataFrame, value: str, tiers: Sequence[Sequence[str]]) -> list[DataFrame]:
    """The medians of each tier, (tier's keys..., `_med`), null keys a group of their own; no row where no value was seen.
    `pairs` has one row per (tier_keys, value) with its count `_n`; all tiers are ranked in one pass over it."""
    keys = tier_keys(tiers)
    counts = pairs.where(F.col(value).isNotNull()).groupingSets([[*t, value] for t in tiers], *keys, value).agg(
        F.sum("_n").alias("_n"), F.grouping_id().alias("_tier"))
    med = cut_lineage(quantiles(counts, value, {"_med": 0.5}, by=["_tier", *keys], counted=True))
    # grouping_id bit i (from the left) is 1 when keys[i] is aggregated away; the last bit is the value's
    gids = [int("".join("0" if k in t else "1" for k in keys) + "0", 2) for t in tiers]
    return [med.where(F.col("_tier") == gid).select(*t, "_med") for t, gid in zip(tiers, gids)]


def tier_dictionary(df: DataFrame, value: str, observed: str, tiers: Sequence[Sequence[str]]) -> DataFrame:
    """One row per distinct tuple of all tier keys (nulls kept): `_rows`, its number of rows, and `_fill`, the first
    non-null median along `tiers` (J09). `df` is aggregated once, map-side first; the tiers' medians come from the
    (tuple, value) counts, and only dictionary rows are exchanged by a tier's key."""
    tiers = [list(t) for t in tiers]
    keys = tier_keys(tiers)
    seen = F.when(F.col(observed) & F.col(value).isNotNull(), F.col(value))
    pairs = cut_lineage(df.groupBy(*keys, seen.alias(value)).agg(F.count(F.lit(1)).alias("_n")))
    medians = tier_medians(pairs, value, tiers)
    result = pairs.groupBy(*keys).agg(F.sum("_n").alias("_rows"))
    fills: list[Column] = []
    for i, (t, m) in enumerate(zip(tiers, medians)):
        if t:
            result = result.join(m.select(*t, F.col("_med").alias(f"_tier{i}")), t, "left")
            fills.append(F.col(f"_tier{i}"))
        else:
            fills.append(m.select("_med").scalar())  # overall median: scalar subquery
    return result.select(*keys, "_rows", F.coalesce(*fills).alias("_fill"))


def impute_hierarchical(df: DataFrame, value: str, observed: str, out: str,
                        tiers: Sequence[Sequence[str]] = DEFAULT_TIERS, *,
                        broadcast_tuples: int = BROADCAST_TUPLES, rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """First non-null of the observed value and the medians of observed
    values along `tiers` (C03 / A03 / J09). `()` is the overall median.

    Raw rows are never exchanged by a tier's key: each finds its fill in the
    `tier_dictionary` by one join on the whole tuple. The dictionary is
    counted; a small one is broadcast. A larger one is joined by shuffle:
    tuples of more than `rows_per_salt` rows are spread over several salts
    on the raw side and repeated for each on the other. The salts' table is
    broadcast: `rows_per_salt` is raised until it has at most
    `broadcast_tuples` rows."""
    found = cut_lineage(tier_dictionary(df, value, observed, tiers))
    keys = [c for c in found.columns if c not in ("_rows", "_fill")]
    own = F.when(F.col(observed), F.col(value))
    if not keys:
        return df.withColumn(out, F.coalesce(own, found.select("_fill").scalar()))
    found = found.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    n_tuples, n_rows = found.agg(F.count(F.lit(1)), F.coalesce(F.sum("_rows"), F.lit(0))).first()
    if n_tuples <= broadcast_tuples:
        result = df.join(F.broadcast(found), same, "left")
    else:
        rows_per_salt = max(rows_per_salt, n_rows // max(broadcast_tuples, 1))
        salts = F.ceil(F.col("_rows") / rows_per_salt).cast("int")
        heavy = found.where(F.col("_rows") > rows_per_salt).select(*[f"_k_{k}" for k in keys], salts.alias("_salts"))
        # any salt finds the same fill, so rows may be told apart by whatever columns can be hashed
        digest = F.xxhash64(*[F.col(c) for c, t in df.dtypes if "map<" not in t and "variant" not in t])
        salted = df.join(F.broadcast(heavy), same, "left").drop(*[f"_k_{k}" for k in keys]).withColumn(
            "_salt", F.coalesce(F.pmod(digest, F.col("_salts")), F.lit(0)).cast("int"))
        each = found.withColumn("_s", F.explode(F.sequence(F.lit(0), salts - 1)))
        result = salted.join(each, [*same, F.col("_salt") == F.col("_s")], "left")
    return result.withColumn(out, F.coalesce(own, "_fill")).select(*[F.col(c) for c in df.columns if c != out], out)


def load_vehicles(population: DataFrame, entities: DataFrame | Sequence[str] | None = None, *,
                  tiers: Sequence[Sequence[str]] = DEFAULT_TIERS, bev_marker: str = "BEV",
                  states: Sequence[str] | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """Clean vehicle rows (C01 first half): filter, dedupe by id under a total
    order, lenient range, observed flag, imputed range, BEV flag, WKT point.
    `states` keeps rows of those states (needs a `state` column). `columns`
    names the columns to return; others are not carried along."""
    rows = filter_in(population, "entity", entities)
    if states is not None:
        rows = filter_in(rows, "state", states)
    # the de-duplicated rows feed several median passes and aggregates:
    # write them once, by columns, instead of re-running the joins
    keep = None
    if columns is not None:
        needed = {*columns, *tier_keys(tiers), "rng", *(["ev_type"] if "is_bev" in columns else []),
                  *(["location"] if {"longitude", "latitude"} & {*columns} else [])}
        keep = [c for c in rows.columns if c in needed]
    rows = write_once(dedupe_first(rows, "vehicle_id", keep=keep))
    numeric = dict(rows.dtypes)["rng"] != "string"
    rng = F.col("rng").cast("double") if numeric else to_number("rng")
    rows = rows.withColumn("rng", rng).withColumn("range_observed", is_positive("rng"))
    rows = impute_hierarchical(rows, "rng", "range_observed", "estimated_range", tiers)
    lon, lat = wkt_point("location")
    made = {"is_bev": F.coalesce(F.col("ev_type").contains(bev_marker), F.lit(False)), "longitude": lon, "latitude": lat}
    if columns is None:
        return rows.withColumns(made)
    return rows.withColumns({c: x for c, x in made.items() if c in columns}).select(*columns)


def entity_stock(vehicles: DataFrame) -> DataFrame:
    """Per-entity stock (A01): size, mean imputed range, observed and BEV
    shares, median coordinates (exact, distributed medians)."""
    base = vehicles.groupBy("entity").agg(
        F.count(F.lit(1)).alias("total_evs"),
        F.avg("estimated_range").alias("avg_range_miles"),
        F.avg(F.col("range_observed").cast("double")).alias("observed_range_share"),
        F.avg(F.col("is_bev").cast("double")).alias("bev_share"),
    )
    coords = vehicles.unpivot(["entity"], ["latitude", "longitude"], "_coord", "_v")
    med = quantiles(coords, "_v", {"_med": 0.5}, by=["entity", "_coord"])
    med = med.groupBy("entity").pivot("_coord", ["latitude", "longitude"]).agg(F.first("_med"))
    return base.join(med, "entity", "left")


def stock_audit(population: DataFrame, vehicles: DataFrame) -> DataFrame:
    """Audit row for the stock (A04) from the same scans."""
    v = vehicles.agg(
        F.count(F.lit(1)).alias("unique_vehicles"),
        F.sum(F.when(~F.col("range_observed"), 1).otherwise(0)).cast("bigint").alias("zero_or_missing_range"),
        F.round(F.avg(F.col("range_observed").cast("double")), 4).alias("observed_range_share"),
        F.countDistinct("entity").alias("entities"),
    )
    return v.select(population.select(F.count(F.lit(1))).scalar().alias("population_rows_raw"), "*")


def range_histogram(vehicles: DataFrame) -> DataFrame:
    """Observed vehicles per (entity, range)."""
    return (vehicles.where(F.col("range_observed")).groupBy("entity", F.col("rng").alias("electric_range"))
            .agg(F.count(F.lit(1)).alias("vehicles")))


def low_range_share(vehicles: DataFrame, threshold: float = 200) -> DataFrame:
    """Share of observed ranges below `threshold` per entity."""
    return (vehicles.where(F.col("range_observed")).groupBy("entity")
            .agg(F.avg((F.col("rng") < threshold).cast("double")).alias("observed_low_range_share")))


def range_coverage(vehicles: DataFrame, dims=(("model_year", "model_year"), ("ev_type", "ev_type"),
                                              ("make", "make"), ("entity", "entity"))) -> DataFrame:
    """Observed-range coverage by each of several dimensions, NULL kept as
    its own group (A20): one `GROUPING SETS` aggregate over one scan."""
    cols = [c for _, c in dims]
    src = vehicles.select(*[F.col(c).cast("string").alias(c) for c in cols], "range_observed")
    g = src.groupingSets([[c] for c in cols], *cols).agg(
        F.count(F.lit(1)).alias("records"),
        F.sum(F.col("range_observed").cast("bigint")).alias("positive_observed_range"),
        *[F.grouping(c).alias(f"_g_{c}") for c in cols])
    label = value = None
    for name, c in dims:
        hit = F.col(f"_g_{c}") == 0
        label = F.when(hit, F.lit(name)) if label is None else label.when(hit, F.lit(name))
        value = F.when(hit, F.col(c)) if value is None else value.when(hit, F.col(c))
    return g.select(label.alias("group"), value.alias("value"), "records", "positive_observed_range",
                    F.round(F.col("positive_observed_range") * 100.0 / F.col("records"), 2).alias("coverage_pct"))


def threshold_sensitivity(vehicles: DataFrame, thresholds=(150, 200, 250, 300)) -> DataFrame:
    """Share of observed ranges below each threshold for all / BEV / PHEV
    (A21). The thresholds become an array exploded per row (bounded by its
    length), and three kinds come from one aggregate with GROUPING SETS."""
    obs = vehicles.where(F.col("range_observed")).select("rng", "is_bev")
    obs = obs.withColumn("threshold_miles", F.explode(F.array(*[F.lit(int(t)) for t in thresholds])))
    g = obs.cube("threshold_miles", "is_bev").agg(
        F.count(F.lit(1)).alias("observed_vehicles"),
        F.sum((F.col("rng") < F.col("threshold_miles")).cast("bigint")).alias("below_threshold"),
        F.grouping("is_bev").alias("_gb"), F.grouping("threshold_miles").alias("_gt"))
    g = g.where(F.col("_gt") == 0)
    kind = F.when(F.col("_gb") == 1, "all").when(F.col("is_bev"), "BEV").otherwise("PHEV")
    return g.select(kind.alias("vehicle_type"), "threshold_miles", "observed_vehicles", "below_threshold",
                    F.round(F.col("below_threshold") * 100.0 / F.col("observed_vehicles"), 2).alias("share_below_pct"))
