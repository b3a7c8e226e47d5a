"""Source/sink queries (S01-S18, U01-U05, X01). File-producing jobs write
under the shared checkpoint root and return their registry rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.operators import clean, panel, quality
from panelspark.operators.order_stats import sample_rows
from panelspark.plans import jobs
from panelspark.plans.catalog import ORACLE, register
from panelspark.plans.oracle_sql import DENSE, FEATURES, FLOW, flow_sql
from panelspark.plans.q_flow import flow_of
from panelspark.plans.q_score import LIVE_SQL, live_monthly, live_population, attached_stations, metrics_of
from panelspark.plans.q_series import FUTURE_SQL, SERIES_SQL, fit_sql, series_of
from panelspark.sources import bindings as B
from panelspark.session import cut_lineage
from panelspark.sources import files, warehouse
from panelspark.sources.store import Store
from panelspark.streaming.incremental import incremental_ingest

MODELS3 = ("seasonal_naive", "linear", "polynomial_2")


def _wide_forecasts(spark, sf):
    return jobs.wide_forecasts(series_of(spark, sf))


WIDE_SQL = "wide AS (SELECT a.series AS entity, a.month, " + ", ".join(
    f"CAST(round_even({x}.prediction, 0) AS DOUBLE) AS {m}" for x, m in zip("abc", MODELS3)) + \
    f""" FROM ({fit_sql('fut', 'series', MODELS3[0])}) a
    JOIN ({fit_sql('fut', 'series', MODELS3[1])}) b ON a.series = b.series AND a.month = b.month
    JOIN ({fit_sql('fut', 'series', MODELS3[2])}) c ON a.series = c.series AND a.month = c.month)"""
LONG_SQL = """long AS (
    SELECT CASE WHEN entity = 'statewide' THEN 'statewide' ELSE 'entity' END AS scope, entity, month AS forecast_date,
           model, predicted_transactions, 'run' AS run_id
    FROM wide UNPIVOT (predicted_transactions FOR model IN (seasonal_naive, linear, polynomial_2)))"""


@register("s13_load_forecasts", flow_sql("SELECT * FROM long", SERIES_SQL, FUTURE_SQL, WIDE_SQL, LONG_SQL))
def s13_load_forecasts(spark, sf):
    return warehouse.load_forecasts(_wide_forecasts(spark, sf))


@register("s14_read_forecasts_wide", flow_sql("""
    SELECT entity, forecast_date, max(CASE WHEN model = 'seasonal_naive' THEN predicted_transactions END) AS seasonal_naive,
           max(CASE WHEN model = 'linear' THEN predicted_transactions END) AS linear,
           max(CASE WHEN model = 'polynomial_2' THEN predicted_transactions END) AS polynomial_2
    FROM long WHERE scope = 'entity' GROUP BY 1, 2""", SERIES_SQL, FUTURE_SQL, WIDE_SQL, LONG_SQL))
def s14_read_forecasts_wide(spark, sf):
    return warehouse.read_forecasts_wide(s13_load_forecasts(spark, sf), "entity", MODELS3)


@register("u02_melt", flow_sql("SELECT entity, month, measure, value FROM flow UNPIVOT (value FOR measure IN (all_transactions, ev_transactions))"))
def u02_melt(spark, sf):
    return flow_of(spark, sf).unpivot(["entity", "month"], ["all_transactions", "ev_transactions"], "measure", "value")


@register("u03_pivot_models", flow_sql("""
    SELECT entity, month, max(CASE WHEN measure = 'all_transactions' THEN value END) AS all_transactions,
           max(CASE WHEN measure = 'ev_transactions' THEN value END) AS ev_transactions
    FROM (SELECT entity, month, measure, value FROM flow UNPIVOT (value FOR measure IN (all_transactions, ev_transactions)))
    GROUP BY 1, 2"""))
def u03_pivot_models(spark, sf):
    long = u02_melt(spark, sf)
    return long.groupBy("entity", "month").pivot("measure", ["all_transactions", "ev_transactions"]).agg(F.first("value"))


@register("u04_calendar_pivot", flow_sql("SELECT year, " + ", ".join(
    f"sum(CASE WHEN m = {i} THEN v END) AS m{i:02d}" for i in range(1, 13)) + """
    FROM (SELECT CAST(year(month) AS BIGINT) AS year, month(month) AS m, sum(ev_transactions) AS v FROM flow GROUP BY 1, 2)
    GROUP BY year"""))
def u04_calendar_pivot(spark, sf):
    """Year x month-of-year heat-map table of the statewide flow."""
    f = flow_of(spark, sf).groupBy(F.year("month").cast("bigint").alias("year"), F.month("month").alias("m")) \
        .agg(F.sum("ev_transactions").alias("v"))
    p = f.groupBy("year").pivot("m", list(range(1, 13))).agg(F.sum("v"))
    return p.select("year", *[F.col(str(i)).alias(f"m{i:02d}") for i in range(1, 13)])


@register("u01_union_all", flow_sql("""
    SELECT 'all' AS fuel_scope, entity, month, all_transactions AS transactions FROM flow
    UNION ALL SELECT 'electric', entity, month, ev_transactions FROM flow"""))
def u01_union_all(spark, sf):
    f = flow_of(spark, sf)
    return f.select(F.lit("all").alias("fuel_scope"), "entity", "month", F.col("all_transactions").alias("transactions")) \
        .unionByName(f.select(F.lit("electric").alias("fuel_scope"), "entity", "month", F.col("ev_transactions").alias("transactions")))


@register("u05_sample", B.with_bindings("""
    SELECT vehicle_id, entity, make, model FROM population
    ORDER BY md5(concat_ws(':', '42', CAST(vehicle_id AS VARCHAR))), vehicle_id, entity, make, model LIMIT 300""", "population"))
def u05_sample(spark, sf):
    """Seeded sample of 300 vehicles (the sample is the feature)."""
    return sample_rows(B.population(spark, sf).select("vehicle_id", "entity", "make", "model"), 300, "vehicle_id", 42)


@register("s12_merge_upsert", flow_sql("""
    SELECT * FROM old WHERE (entity, month) NOT IN (SELECT (entity, month) FROM upd)
    UNION ALL SELECT * FROM upd""", """old AS (SELECT * FROM flow WHERE month < CAST((SELECT max(month) FROM flow) - INTERVAL 2 MONTH AS DATE)),
upd AS (SELECT entity, month, all_transactions, ev_transactions * 2 AS ev_transactions FROM flow
        WHERE month >= CAST((SELECT max(month) FROM flow) - INTERVAL 5 MONTH AS DATE))"""))
def s12_merge_upsert(spark, sf):
    """A restatement of the last 6 months (EV doubled) upserted onto a load
    that stopped 3 months before the end: 3 months replace, 3 insert."""
    flow = flow_of(spark, sf)
    last = flow.select(F.max("month")).scalar()
    old = flow.where(F.col("month") < F.add_months(last, -2))
    upd = flow.where(F.col("month") >= F.add_months(last, -5)).withColumn("ev_transactions", F.col("ev_transactions") * 2)
    return warehouse.merge_upsert(old, upd, ["entity", "month"])


@register("s12_upsert_table_idempotent", flow_sql("SELECT * FROM flow"))
def s12_upsert_table_idempotent(spark, sf):
    """The flow upserted twice into a stored table (new version + pointer
    swap each time) reads back once."""
    root = files.shared_dir(spark, "tables", "flow")
    flow = flow_of(spark, sf)
    warehouse.upsert_table(spark, root, flow, ["entity", "month"])
    warehouse.upsert_table(spark, root, flow, ["entity", "month"])
    return warehouse.read_table(spark, root)


@register("x01_incremental_ingest", flow_sql("SELECT * FROM flow"))
def x01_incremental_ingest(spark, sf):
    """Structured Streaming ingest: the registrations land as one file per
    order year, the stream processes them in micro-batches (AvailableNow),
    and the upserted flow table equals the batch-built flow."""
    reg = B.registrations(spark, sf)
    landing = files.shared_dir(spark, "landing")
    reg.withColumn("_y", F.year("txn_date")).repartition("_y").write.partitionBy("_y").parquet(landing)
    store = files.shared_dir(spark, "stream_store")
    flat = f"{landing}/*"
    return incremental_ingest(spark, flat, reg.schema, store, entities=B.entities(spark, sf), electric=B.ELECTRIC_FUEL,
                              max_files_per_trigger=2)


@register("s03_fingerprint_sources")
def s03_fingerprint_sources(spark, sf):
    """sha256, size and mtime of the driver's parquet files (binaryFile)."""
    return files.fingerprint_sources(spark, sf, glob="*.parquet").drop("ingested_at")


@register("s04_incremental_gate")
def s04_incremental_gate(spark, sf):
    """Gate decisions: nothing recorded -> run; all recorded -> skip;
    product missing -> run; forced -> run."""
    fp = files.fingerprint_sources(spark, sf, glob="*.parquet")
    manifest = fp.select("source_id", "sha256")
    cases = [("empty_manifest", files.incremental_gate(fp, None, True)),
             ("same_hashes", files.incremental_gate(fp, manifest, True)),
             ("product_missing", files.incremental_gate(fp, manifest, False)),
             ("forced", files.incremental_gate(fp, manifest, True, force=True))]
    out = None
    for name, df in cases:
        d = df.select(F.lit(name).alias("case"), "*")
        out = d if out is None else out.unionByName(d)
    return out


@register("s05_commit_manifest")
def s05_commit_manifest(spark, sf):
    """Manifest upsert by source id after success: recording the same
    fingerprints twice keeps one row per source."""
    fp = files.fingerprint_sources(spark, sf, glob="*.parquet").select(
        "source_id", F.col("sha256").alias("source_hash"), "size_bytes", "ingested_at", F.lit("processed").alias("status"))
    root = files.shared_dir(spark, "tables", "manifest")
    warehouse.upsert_table(spark, root, fp, ["source_id"])
    warehouse.upsert_table(spark, root, fp, ["source_id"])
    return warehouse.read_table(spark, root)


@register("s01_scan_csv", flow_sql("SELECT count(*) AS rows, count(DISTINCT entity) AS entities FROM registrations"))
def s01_scan_csv(spark, sf):
    """Registrations landed as header CSV, read back as all-text columns."""
    path = files.shared_dir(spark, "csv", "registrations")
    B.registrations(spark, sf).write.option("header", True).csv(path)
    raw = files.scan_csv(spark, path, ["txn_date", "entity", "fuel", "cnt"])
    return raw.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("entity").alias("entities"))


@register("s02_raw_row_count", flow_sql("SELECT (SELECT count(*) FROM registrations) AS registration_rows_raw, count(*) AS flow_rows FROM flow"))
def s02_raw_row_count(spark, sf):
    return flow_of(spark, sf).agg(F.count(F.lit(1)).alias("flow_rows")).select(
        files.raw_row_count(B.registrations(spark, sf)).alias("registration_rows_raw"), "flow_rows")


@register("s06_write_products", B.with_bindings(f"WITH {LIVE_SQL}, {FLOW}\n" + """
    SELECT 'monthly_transactions' AS product, count(*) AS rows FROM flow
    UNION ALL SELECT 'live_metrics', (SELECT count(*) FROM live_pop)""",
    "registrations", "population", "live_registrations", "charging_units", "zip_rows"))
def s06_write_products(spark, sf):
    out = files.shared_dir(spark, "products")
    return files.write_products({"monthly_transactions": flow_of(spark, sf), "live_metrics": metrics_of(spark, sf)}, out).select("product", "rows")


@register("s07_write_snapshot", B.with_bindings(f"WITH {LIVE_SQL}\n" + """
    SELECT snapshot, rows FROM (VALUES ('v1'), ('v2')) t(snapshot), (SELECT count(*) AS rows FROM attached)""",
    "population", "live_registrations", "charging_units", "zip_rows"))
def s07_write_snapshot(spark, sf):
    """Two writes of the same version and one of another: the registry lists
    three writes, the product holds two snapshots."""
    root = files.shared_dir(spark, "live")
    stations = attached_stations(spark, sf)
    prods = {"entity_live_metrics": cut_lineage(metrics_of(spark, sf, stations)), "charging_stations": stations}
    files.write_snapshot(prods, root, "v1")
    files.write_snapshot(prods, root, "v1")
    files.write_snapshot(prods, root, "v2")
    snaps = spark.read.parquet(f"{root}/charging_stations").groupBy("snapshot").agg(F.count(F.lit(1)).alias("rows"))
    return snaps


@register("s08_source_version_totals", B.with_bindings(f"WITH {LIVE_SQL}\n" + """
    SELECT (SELECT count(*) FROM live_pop) AS rows_population, (SELECT count(*) FROM live_monthly) AS rows_registrations,
           (SELECT count(*) FROM attached) AS rows_stations, (SELECT sum(ev_stock) FROM live_pop) AS total_stock,
           (SELECT sum(ev_transactions) FROM live_monthly) AS total_transactions,
           (SELECT sum(ports) FROM attached) AS total_ports""",
    "population", "live_registrations", "charging_units", "zip_rows"))
def s08_source_version_totals(spark, sf):
    v = _version(spark, sf)
    return v.select("rows_population", "rows_registrations", "rows_stations", "total_stock", "total_transactions", "total_ports")


def _version(spark, sf):
    pop, mon, st = live_population(spark, sf), live_monthly(spark, sf), attached_stations(spark, sf)
    return files.source_version(
        {"population": pop, "registrations": mon, "stations": st},
        {"stock": pop.select(F.sum("ev_stock")).scalar(), "transactions": mon.select(F.sum("ev_transactions")).scalar(),
         "ports": st.select(F.sum("ports")).scalar()},
        {"ev_population": "available", "registrations": "available", "charging_inventory": "available"})


@register("s08_source_version")
def s08_source_version(spark, sf):
    return _version(spark, sf).select("source_version")


@register("s09_publish_if_changed")
def s09_publish_if_changed(spark, sf):
    """First publish emits the version; a second with the same version emits nothing."""
    v = _version(spark, sf).select("source_version")
    first = files.publish_if_changed(None, v)
    second = files.publish_if_changed(first, v)
    return first.select("source_version", F.lit("published").alias("action")).unionByName(
        second.select("source_version", F.lit("republished").alias("action")))


@register("s10_last_good_snapshot")
def s10_last_good_snapshot(spark, sf):
    """Fallback after a failed station refresh: the newest good snapshot is served as stale."""
    root = files.shared_dir(spark, "live")
    st = attached_stations(spark, sf)
    files.write_snapshot({"charging_stations": st}, root, "v1", has_stations=not st.isEmpty(), last_updated="2026-10-02")
    reg = files.write_snapshot({"charging_stations": st.where(F.lit(False))}, root, "v2")
    return files.last_good_snapshot(reg, current_version="v2").select("version", "status")


@register("s15_products_available")
def s15_products_available(spark, sf):
    out = files.shared_dir(spark, "products")
    files.write_products({"monthly_transactions": flow_of(spark, sf)}, out)
    return files.products_available(spark, out, ["monthly_transactions", "evaluation", "entity_forecasts"])


@register("s17_export_json_records")
def s17_export_json_records(spark, sf):
    return files.export_json_records(metrics_of(spark, sf))


@register("s18_feature_json")
def s18_feature_json(spark, sf):
    from panelspark.plans.q_flow import features_of
    return files.feature_json(features_of(spark, sf), ["entity", "month"])


@register("s16_save_models")
def s16_save_models(spark, sf):
    """Fitted preprocessing + K-Means models written with Spark ML writers."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler
    from panelspark.plans.q_segments import features_of as seg_features
    d = VectorAssembler(inputCols=["total_evs", "ev_transactions_12m"], outputCol="features").transform(seg_features(spark, sf))
    km = KMeans(k=3, seed=42).fit(d)
    root = files.shared_dir(spark, "models")
    saved = warehouse.save_models({"kmeans": km}, root)
    return spark.createDataFrame(saved, "model string, path string").select("model")


@register("c17_live_refresh", f"""
    SELECT t.*, r.* FROM ({ORACLE["a23_statewide_totals"]}) t,
        (VALUES (1, 'available', true), (2, 'stale', true)) r(run, charging_inventory_status, site_bundle_changed)""")
def c17_live_refresh(spark, sf):
    """Refresh twice: a normal run, then one where the station feed fails
    and the last good snapshot's stations are served as 'stale'."""
    from panelspark.plans.jobs import live_refresh
    root = files.shared_dir(spark, "live_refresh")
    pop, mon = live_population(spark, sf), live_monthly(spark, sf)
    first = live_refresh(spark, root, pop, mon, attached_stations(spark, sf))
    published = spark.read.parquet(f"{root}/_published")
    second = live_refresh(spark, root, pop, mon, None, published=published)
    return first.withColumn("run", F.lit(1)).unionByName(second.withColumn("run", F.lit(2))).drop("source_version")


@register("c18_build_products")
def c18_build_products(spark, sf):
    from panelspark.plans.jobs import build_products
    out = files.shared_dir(spark, "build")
    return build_products(spark, out, B.population(spark, sf), B.registrations(spark, sf), B.entities(spark, sf),
                          B.ELECTRIC_FUEL, 20.0).select("product", "rows")


def _batch(spark, sf, root, force=False):
    """One run of the batch flow over the bound tables: their files are the sources."""
    from panelspark.plans.q_quality import clean_population, clean_registrations
    fp = files.fingerprint_sources(spark, [f"{sf.rstrip('/')}/{t}.parquet" for t in ("lineitem", "orders", "part")])
    reports = [quality.validate_population(clean_population(spark, sf)), quality.validate_registrations(clean_registrations(spark, sf))]

    def build(run_id, folder):
        flow = flow_of(spark, sf)
        features, forecasts = cut_lineage(panel.panel_features(flow)), cut_lineage(jobs.wide_forecasts(series_of(spark, sf, flow=flow)))
        files.write_products({"monthly_transactions": flow, "modeling_features": features, "forecasts": forecasts}, folder)
        # the hash of the registrations' files, as one
        source = fp.select(F.sha2(F.concat_ws(",", F.sort_array(F.collect_list("sha256"))), 256)).first()[0]  # a row a file
        return jobs.warehouse_rows(flow, features, forecasts, source, run_id)

    return jobs.batch_flow(spark, root, fp, reports, build, force)


TABLE_ROWS_SQL = """counts AS (SELECT 'entity_month_transactions' AS "table", count(*) AS rows FROM flow
    UNION ALL SELECT 'modeling_features', count(*) FROM features
    UNION ALL SELECT 'forecast_results', count(*) FROM long
    UNION ALL SELECT 'ingestion_manifest', 3)"""
BATCH_SQL = (DENSE, FEATURES, SERIES_SQL, FUTURE_SQL, WIDE_SQL, LONG_SQL, TABLE_ROWS_SQL)


@register("e2_batch_flow", flow_sql("""
    SELECT run, status, reason, version, "table", CASE WHEN status = 'processed' THEN rows END AS rows
    FROM (VALUES (1, 'processed', 'source_changed', 1), (2, 'skipped', 'source_hashes_unchanged', 1), (3, 'processed', 'forced', 2))
        r(run, status, reason, version), counts""", *BATCH_SQL))
def e2_batch_flow(spark, sf):
    """The batch three times: first run, unchanged sources, forced. A version is published by the runs that load."""
    root = files.shared_dir(spark, "batch")
    rows = []
    for run, force in ((1, False), (2, False), (3, True)):
        got = _batch(spark, sf, root, force)
        rows += [(run, got["status"], got["reason"], got["version"], t, got["rows"].get(t)) for t in warehouse.SCHEMAS]
    return spark.createDataFrame(rows, "run int, status string, reason string, version int, table string, rows bigint")


@register("s11_warehouse_tables", flow_sql("""
    SELECT "table", rows, rows AS keys, total FROM counts JOIN (
        SELECT 'entity_month_transactions' AS "table", round(sum(ev_transactions), 4) AS total FROM flow
        UNION ALL SELECT 'modeling_features', round(sum(ev_transactions), 4) FROM features
        UNION ALL SELECT 'forecast_results', round(sum(predicted_transactions), 4) FROM long
        UNION ALL SELECT 'ingestion_manifest', NULL) USING ("table")""", *BATCH_SQL))
def s11_warehouse_tables(spark, sf):
    """The four keyed tables as loaded by a batch run: rows, distinct keys and a total of each."""
    root = files.shared_dir(spark, "batch")
    _batch(spark, sf, root)
    store = Store(spark, f"{root}/warehouse")
    value = {"entity_month_transactions": "ev_transactions", "modeling_features": "ev_transactions", "forecast_results": "predicted_transactions"}
    out = None
    for name, (_, keys) in warehouse.SCHEMAS.items():
        total = F.round(F.sum(value[name]), 4) if name in value else F.lit(None).cast("double")
        one = store.read(name).agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(*keys).alias("keys"), total.alias("total")) \
            .select(F.lit(name).alias("table"), "*")
        out = one if out is None else out.unionByName(one)
    return out
