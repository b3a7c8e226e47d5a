"""Composite jobs (C17, C18): compositions of the operators, one Spark job
graph each; they write under the shared checkpoint root and return small
registry / summary rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.operators import clean, evaluate, models, panel, quality, score
from panelspark.session import cut_lineage
from panelspark.sources import files, warehouse
from panelspark.sources.store import Store


def _registry(spark: SparkSession, root: str) -> DataFrame | None:
    """The snapshot registry; None before the first snapshot. Any other failure of the read is raised."""
    try:
        return spark.read.parquet(f"{root}/_registry")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def live_refresh(spark: SparkSession, root: str, population: DataFrame, monthly: DataFrame, stations: DataFrame | None,
                 *, configured: bool = True, published: DataFrame | None = None, last_updated: str | None = None) -> DataFrame:
    """C17: score, version, snapshot and publish the live products.

    `stations` is None when the charging feed failed: the newest snapshot that recorded stations and the time of their
    source is served with status 'stale' (or 'unavailable' if there is none); `configured=False` marks the feed
    'not_configured'. `last_updated` is the feed's own time, that of the refresh if it has none."""
    status = "available"
    last_updated = last_updated or datetime.now(timezone.utc).isoformat(timespec="seconds")
    if not configured:
        stations, status = None, "not_configured"
    elif stations is None:
        reg = _registry(spark, root)
        good = None if reg is None else files.last_good_snapshot(reg).first()
        if good is not None:
            stations, last_updated = files.read_snapshot(spark, root, "charging_stations", good["version"]), good["last_updated"]
            status = "stale"
        else:
            status = "unavailable"
    if stations is None:
        stations, last_updated = spark.createDataFrame(
            [], "station_id string, station_name string, zip string, latitude double, longitude double, network string, "
                "ports bigint, dc_fast_ports bigint, entity string"), None
    # each is one row per entity, entity-month or station, and read by several of the steps below
    population, monthly, stations = cut_lineage(population), cut_lineage(monthly), cut_lineage(stations)
    metrics = cut_lineage(score.opportunity_score(population, monthly, stations))
    totals = cut_lineage(score.statewide_totals(population, monthly, stations, metrics))
    statuses = {"ev_population": "available", "registrations": "available", "charging_inventory": status}
    version = files.source_version(
        {"population": population, "registrations": monthly, "stations": stations},
        {"stock": population.select(F.sum("ev_stock")).scalar(),
         "transactions": monthly.select(F.sum("ev_transactions")).scalar(),
         "ports": stations.select(F.coalesce(F.sum("ports"), F.lit(0))).scalar()}, statuses)
    v = version.select("source_version").first()[0]
    sources = spark.createDataFrame([(k, x, last_updated if k == "charging_inventory" else None) for k, x in statuses.items()],
                                    "source string, status string, last_updated string")
    files.write_snapshot({"entity_live_metrics": metrics, "charging_stations": stations, "snapshot_summary": totals,
                          "source_status": sources}, root, v, has_stations=not stations.isEmpty(), last_updated=last_updated)
    fresh = files.publish_if_changed(published, version.select("source_version"))
    changed = not fresh.isEmpty()
    if changed:
        bundle = metrics.select(F.lit("entity").alias("kind"), F.to_json(F.struct("*")).alias("record")).unionByName(
            stations.where(F.col("entity").isNotNull()).select(
                F.lit("station").alias("kind"),
                F.to_json(F.struct("station_id", "station_name", "entity", "latitude", "longitude", "network", "ports",
                                   "dc_fast_ports")).alias("record")))
        bundle.write.mode("overwrite").json(f"{root}/_bundle/{v}")
        version.select("source_version").write.mode("append").parquet(f"{root}/_published")
    return totals.select(F.lit(v).alias("source_version"), F.lit(status).alias("charging_inventory_status"),
                         F.lit(changed).alias("site_bundle_changed"), "*")


def build_products(spark: SparkSession, out_dir: str, population: DataFrame, registrations: DataFrame,
                   entities: DataFrame | None, electric: str, threshold: float) -> DataFrame:
    """The batch build of the served products that need no model fit
    (stock, flow, features, range histogram, segment features, baseline
    evaluation and intervals); model products come from the M-family jobs."""
    vehicles = clean.load_vehicles(population, entities, columns=[
        "entity", "make", "model_year", "ev_type", "rng", "range_observed", "estimated_range", "is_bev", "longitude", "latitude"])
    # one row per entity and month or per entity: each is written once for the products that read it
    flow = cut_lineage(clean.load_flow(registrations, entities, electric=electric))
    stock = cut_lineage(clean.entity_stock(vehicles))
    feats = cut_lineage(panel.panel_features(flow))
    from panelspark.operators import segments
    seg = segments.segment_features(stock, clean.low_range_share(vehicles, threshold), flow, threshold)
    intervals, coverage = evaluate.conformal_intervals(feats, "lag_12")
    products = {
        "entity_stock": stock, "monthly_transactions": flow, "modeling_features": feats,
        "observed_ranges": clean.range_histogram(vehicles), "segment_features": seg,
        "range_coverage": clean.range_coverage(vehicles), "prediction_intervals": intervals, "interval_coverage": coverage,
        "audit_stock": clean.stock_audit(population, vehicles), "audit_flow": clean.flow_audit(registrations, flow),
    }
    return files.write_products(products, out_dir)


FORECASTERS = ("seasonal_naive", "linear", "polynomial_2")


def wide_forecasts(series: DataFrame) -> DataFrame:
    """(entity, month, a column a model): the next twelve months of every series, half-even rounded."""
    rows = models.future_rows(series, ["series"])
    out = None
    for m in FORECASTERS:
        p = models.SERIES_FITTERS[m](rows, ["series"]).select(
            F.col("series").alias("entity"), "month", F.bround("prediction", 0).cast("double").alias(m))
        out = p if out is None else out.join(p, ["entity", "month"])
    return out


def warehouse_rows(flow: DataFrame, features: DataFrame, forecasts: DataFrame, source_hash: str, run_id: str) -> dict[str, DataFrame]:
    """The facts, features and forecasts of a run in the columns of the warehouse tables."""
    now = F.current_timestamp().alias("loaded_at")
    run = F.lit(run_id).alias("run_id")
    return {
        "entity_month_transactions": flow.select("entity", F.col("month").alias("transaction_month"), "all_transactions", "ev_transactions",
                                                 F.lit(source_hash).alias("source_hash"), now),
        "modeling_features": features.withColumnRenamed("month", "feature_month").withColumns({"run_id": run, "loaded_at": F.current_timestamp()}),
        "forecast_results": warehouse.load_forecasts(forecasts, run_id=run_id).withColumn("loaded_at", F.current_timestamp()),
    }


def batch_flow(spark: SparkSession, root: str, fingerprints: DataFrame, reports: Sequence[DataFrame],
               build: Callable[[str, str], Mapping[str, DataFrame]], force: bool = False) -> dict:
    """The whole batch: gate by source hashes, validation, products and models, keyed load, manifest.

    `build(run_id, folder)` writes the products of the run below `folder`, which is the run's own, and returns the rows of
    the warehouse tables. Everything becomes visible by one commit, the last step: it names the version of each table, the
    manifest rows of the sources and the folder of the products. A run that fails before leaves all of them as they were.
    Returns status (processed or skipped), reason, version and rows a table."""
    store = Store(spark, f"{root.rstrip('/')}/warehouse")
    before = store.state()
    manifest = store.read("ingestion_manifest")
    known = None if manifest is None else manifest.where(F.col("status") == "processed").select("source_id", F.col("source_hash").alias("sha256"))
    gate = files.incremental_gate(fingerprints, known, bool(before["note"].get("products")), force).first()
    if not gate["run"]:
        return {"status": "skipped", "reason": gate["reason"], "version": before["version"], "rows": {}}
    quality.require_valid(*reports)
    run_id = uuid.uuid4().hex
    products = f"{root.rstrip('/')}/products/{run_id}"
    rows = dict(build(run_id, products))
    rows["ingestion_manifest"] = fingerprints.select("source_id", F.col("sha256").alias("source_hash"), "size_bytes", "ingested_at",
                                                     F.lit("processed").alias("status"))
    updates = {}
    for name, df in rows.items():
        u = warehouse.conform(name, df)
        u.rows = cut_lineage(u.rows)
        updates[name] = u
    counts = {name: u.rows.count() for name, u in updates.items()}
    version = store.write(updates, note={"run_id": run_id, "products": products})
    return {"status": "processed", "reason": gate["reason"], "version": version, "rows": counts}
