"""Station roll-up, opportunity score, upserts and incremental decisions."""

import datetime as dt

import pytest

from pyspark.sql import functions as F

from panelspark.operators import score
from panelspark.sources import files, warehouse


def test_station_rollup_counts_units_as_ports(spark):
    # Alpha x2 (CCS 1, CHAdeMO 0/1), Beta x1 (all 0); power columns absent
    units = spark.createDataFrame([
        ("10", "Alpha", "98101", 47.61, -122.33, "Example", 1, 0, 0, 0, 1),
        ("10", "Alpha", "98101", 47.61, -122.33, "Example", 1, 1, 0, 0, 2),
        ("11", "Beta", "99201", 47.66, -117.42, "Example", 0, 0, 0, 0, 3)],
        "station_id string, station_name string, zip_text string, latitude double, longitude double, network string, "
        "ccs_count int, chademo_count int, j3400_count int, j3271_count int, ord int")
    got = {r.station_id: r for r in score.station_rollup(units, F.col("ord")).collect()}
    assert (got["10"].ports, got["10"].dc_fast_ports) == (2, 2)
    assert (got["11"].ports, got["11"].dc_fast_ports) == (1, 0)


def live_inputs(spark):
    # F15
    pop = spark.createDataFrame([("King", 100), ("Pierce", 50)], "entity string, ev_stock bigint")
    months = [dt.date(2024 + (8 + i) // 12, (8 + i) % 12 + 1, 1) for i in range(24)]
    regs = [("King", m, 10.0 if i < 12 else 14.0) for i, m in enumerate(months)]
    regs += [("Pierce", m, 5.0 if i < 12 else 9.0) for i, m in enumerate(months)]
    monthly = spark.createDataFrame(regs, "entity string, month date, ev_transactions double")
    stations = spark.createDataFrame([("1", "A", "98101", 10, 5), ("2", "B", "98402", 1, 0)],
                                     "station_id string, station_name string, zip string, ports bigint, dc_fast_ports bigint")
    lookup = spark.createDataFrame([("98101", "King", 9), ("98402", "Pierce", 7)], "zip string, entity string, records bigint")
    return pop, monthly, score.attach_entities(stations, lookup)


def test_score_rewards_growth_and_supply_gap(spark):
    pop, monthly, stations = live_inputs(spark)
    m = {r.entity: r for r in score.opportunity_score(pop, monthly, stations).collect()}
    assert m["Pierce"].registration_growth_pct > m["King"].registration_growth_pct
    assert m["Pierce"].evs_per_port > m["King"].evs_per_port
    assert m["Pierce"].opportunity_rank == 1
    tot = score.statewide_totals(pop, monthly, stations, score.opportunity_score(pop, monthly, stations)).first()
    assert (tot.public_stations, tot.public_ports) == (2, 11)


def test_score_ties_share_min_rank(spark):
    # four entities with equal stock, zero ports, null growth
    pop = spark.createDataFrame([(e, 10) for e in "ABCD"], "entity string, ev_stock bigint")
    monthly = spark.createDataFrame([("A", dt.date(2025, 1, 1), 0.0)], "entity string, month date, ev_transactions double")
    stations = spark.createDataFrame([], "station_id string, ports bigint, dc_fast_ports bigint, entity string")
    ranks = sorted(r.opportunity_rank for r in score.opportunity_score(pop, monthly, stations).collect())
    assert ranks[0] == 1 and len(set(ranks)) <= 2


def test_upsert_twice_keeps_newest(spark):
    # King 2026-01 EV 4 then 6 -> one row, 6.0, second hash
    root = files.shared_dir(spark, "test", "upsert")
    schema = "entity string, month date, all_transactions double, ev_transactions double, source_hash string"
    warehouse.upsert_table(spark, root, spark.createDataFrame([("King", dt.date(2026, 1, 1), 10.0, 4.0, "hash-one")], schema),
                           ["entity", "month"])
    warehouse.upsert_table(spark, root, spark.createDataFrame([("King", dt.date(2026, 1, 1), 10.0, 6.0, "hash-two")], schema),
                           ["entity", "month"])
    rows = warehouse.read_table(spark, root).collect()
    assert [(r.entity, r.ev_transactions, r.source_hash) for r in rows] == [("King", 6.0, "hash-two")]


def test_merge_last_duplicate_wins(spark):
    upd = spark.createDataFrame([("k", 1, 1.0), ("k", 2, 2.0)], "key string, ord int, v double")
    out = warehouse.merge_upsert(None, upd, ["key"], order="ord").collect()
    assert [(r.key, r.v) for r in out] == [("k", 2.0)]


def test_incremental_gate_decisions(spark, tmp_path):
    # same hash skips, changed hash runs, missing report runs, force runs
    src = tmp_path / "source.csv"
    src.write_text("value\n1\n")
    fp1 = files.fingerprint_sources(spark, str(src))
    from panelspark.session import cut_lineage
    manifest = cut_lineage(fp1.select("source_id", "sha256"))  # the manifest is a stored table
    assert not files.incremental_gate(fp1, manifest, True).first().run
    assert files.incremental_gate(fp1, manifest, False).first().run
    assert files.incremental_gate(fp1, manifest, True, force=True).first().run
    src.write_text("value\n2\n")
    fp2 = files.fingerprint_sources(spark, str(src))
    assert files.incremental_gate(fp2, manifest, True).first().run


def test_attach_entities_rejects_a_non_unique_zip_lookup(spark):
    # The right side must be unique per padded ZIP ("8101" and "08101" collide)
    stations = spark.createDataFrame([("10", "08101", 2)], "station_id string, zip string, ports bigint")
    lookup = spark.createDataFrame([("8101", "King"), ("08101", "Pierce")], "zip string, entity string")
    with pytest.raises(Exception, match="not unique per ZIP"):
        score.attach_entities(stations, lookup).collect()
    ok = spark.createDataFrame([("8101", "King")], "zip string, entity string")
    assert [r.entity for r in score.attach_entities(stations, ok).collect()] == ["King"]


def test_fingerprint_follows_content_under_equal_size_and_time(spark, tmp_path):
    import hashlib
    import os

    from panelspark.sources.files import fingerprint_sources
    f = tmp_path / "a b.csv"
    seen = []
    for body in (b"value\n1\n", b"value\n2\n"):
        f.write_bytes(body)
        os.utime(f, (1_700_000_000, 1_700_000_000))
        seen.append(fingerprint_sources(spark, str(tmp_path)).first().sha256)
        assert seen[-1] == hashlib.sha256(body).hexdigest()
    assert seen[0] != seen[1]


def test_upsert_replaces_the_pointer_and_refuses_repeated_keys(spark, tmp_path):
    import pytest

    from panelspark.sources.warehouse import merge_upsert, read_table, upsert_table
    root = str(tmp_path / "t")
    upd = lambda *rows: spark.createDataFrame(rows, "k int, v int")
    upsert_table(spark, root, upd((1, 1), (2, 2)), ["k"])
    upsert_table(spark, root, upd((2, 3)), ["k"])
    assert sorted(map(tuple, read_table(spark, root).collect())) == [(1, 1), (2, 3)]
    with pytest.raises(Exception, match="repeat a key"):
        merge_upsert(None, upd((1, 1), (1, 2)), ["k"]).collect()


def test_station_rollup_takes_blank_and_bad_text(spark):
    units = spark.createDataFrame([("10", "A", "98101", "47.6", "", "N", "", "1", " ", "x", 1), ("10", "A", "98101", "", "-122.3", "N", "0", "", "2", "", 2)],
                                  "station_id string, station_name string, zip_text string, latitude string, longitude string, network string, "
                                  "ccs_count string, chademo_count string, j3400_count string, j3400_kw string, ord int")
    r = score.station_rollup(units, F.col("ord")).first()
    assert (r.ports, r.dc_fast_ports, r.latitude, r.longitude) == (2, 1, 47.6, -122.3)


def test_score_ranks_rows_whose_names_differ_in_case(spark):
    pop = spark.createDataFrame([("KING", 10), ("king", 100), ("Pierce", 50)], "entity string, ev_stock bigint")
    monthly = spark.createDataFrame([("Pierce", dt.date(2025, 1, 1), 1.0)], "entity string, month date, ev_transactions double")
    stations = spark.createDataFrame([], "station_id string, ports bigint, dc_fast_ports bigint, entity string")
    got = {r.ev_stock: r.opportunity_score for r in score.opportunity_score(pop, monthly, stations).collect()}
    assert len(got) == 3 and got[100] > got[10]


def test_live_refresh_falls_back_to_the_last_stations(spark, tmp_path):
    from panelspark.plans.jobs import live_refresh
    pop, monthly, stations = live_inputs(spark)
    stations = stations.withColumns({"latitude": F.lit(1.0), "longitude": F.lit(1.0), "network": F.lit("n")})
    root = str(tmp_path / "live")
    assert live_refresh(spark, root, pop, monthly, None).first().charging_inventory_status == "unavailable"
    seen = []
    for given, configured in ((stations, True), (stations, False), (None, True), (None, True)):
        r = live_refresh(spark, root, pop, monthly, given, configured=configured, last_updated="2026-01-01").first()
        seen.append((r.charging_inventory_status, r.public_stations))
    assert seen == [("available", 2), ("not_configured", 0), ("stale", 2), ("stale", 2)]
    last = spark.read.parquet(f"{root}/_registry").where("has_stations").orderBy(F.desc("written_at")).first()
    assert last.products == ["charging_stations", "entity_live_metrics", "snapshot_summary", "source_status"]
    status = {r.source: (r.status, r.last_updated) for r in files.read_snapshot(spark, root, "source_status", last.version).collect()}
    assert status["charging_inventory"] == ("stale", "2026-01-01")


def test_sample_is_the_same_for_any_partitioning(spark):
    from panelspark.operators.order_stats import sample_rows
    df = spark.range(1000)
    a = {r.id for r in sample_rows(df.repartition(3), 50, "id", 7).collect()}
    b = {r.id for r in sample_rows(df.repartition(11, "id"), 50, "id", 7).collect()}
    assert len(a) == 50 and a == b and a != {r.id for r in sample_rows(df, 50, "id", 8).collect()}
