"""Steps over raw rows: each is read, exchanged and written once, in the columns its readers take."""

import datetime as dt

import pytest

from panelspark.operators import clean, order_stats, score
from panelspark.plans import catalog, q_score

catalog.load_all()


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    """Small tables: 40 orders with two lines each, one order and one customer twice."""
    root = str(tmp_path_factory.mktemp("raw"))
    day = lambda i: dt.date(1994 + i % 3, 1 + i % 12, 1 + i % 28)
    orders = [(i, i % 5, day(i), "1-URGENT" if i % 2 else "5-LOW") for i in range(40)]
    lines = [(o, n, (o + n) % 6, o % 4, float(1 + (o * 7 + n) % 50), 100.0 + o, 0.01 * n, 0.02, "A" if o % 3 == 0 else "N",
              "F" if (o + n) % 4 else "O", day(o + n)) for o in range(40) for n in (1, 2)]
    tables = {
        "nation": ([(0, "ALPHA"), (1, "BETA"), (2, "GAMMA")], "n_nationkey long, n_name string"),
        "customer": ([(i, i % 3) for i in range(5)] + [(4, 0)], "c_custkey long, c_nationkey long"),
        "supplier": ([(i, f"S{i}", i % 3) for i in range(4)], "s_suppkey long, s_name string, s_nationkey long"),
        "part": ([(i, f"B{i % 2}", f"T{i % 3}") for i in range(6)], "p_partkey long, p_brand string, p_type string"),
        "orders": (orders + orders[:1], "o_orderkey long, o_custkey long, o_orderdate date, o_orderpriority string"),
        "lineitem": (lines, "l_orderkey long, l_linenumber long, l_partkey long, l_suppkey long, l_quantity double, "
                            "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                            "l_shipdate date"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{root}/{name}.parquet")
    return root


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_dedupe_keeps_the_values_of_the_first_row_without_later_columns(spark):
    rows = [(1, "b", 2, "x", 9), (1, "a", None, "z", 8), (1, "a", 3, "y", 7), (2, None, 1, "q", 6), (2, "a", 0, "p", 5), (None, "c", 1, "r", 4)]
    df = spark.createDataFrame(rows, "id int, a string, b int, c string, late int")
    whole = clean.dedupe_first(df, "id")
    for keep in (["b"], ["a", "c"], ["late"], []):
        part = clean.dedupe_first(df, "id", keep=keep)
        assert part.columns == ["id", *keep]
        assert sorted(map(str, part.collect())) == sorted(map(str, whole.select("id", *keep).collect()))
    assert "late" not in plan(clean.dedupe_first(df.select("*"), "id", keep=["b"])).split("LogicalRDD")[0]
    by_c = clean.dedupe_first(df, "id", order=["c"], keep=["a"])
    assert sorted(map(str, by_c.collect())) == sorted(map(str, clean.dedupe_first(df, "id", order=["c"]).select("id", "a").collect()))


def test_hierarchical_medians_rank_all_tiers_in_one_pass(spark, sf, monkeypatch):
    calls, ranked = [], order_stats.running_total
    monkeypatch.setattr(order_stats, "running_total", lambda *a, **k: calls.append(1) or ranked(*a, **k))
    got = {tuple(r)[:-1]: r["median_range"] for r in catalog.QUERIES["a03_hierarchical_medians"](spark, sf).collect()}
    assert len(calls) == 1
    seen = clean.dedupe_first(q_vehicles(spark, sf), "vehicle_id").where("rng > 0")
    for tier, keys in zip(("make_model_year", "make_model", "ev_type", "overall"), clean.DEFAULT_TIERS):
        want = {tuple(r[k] if k in keys else None for k in ("make", "model", "model_year", "ev_type")): r["m"]
                for r in seen.groupBy(*keys).agg({"rng": "median"}).withColumnRenamed("median(rng)", "m").collect()}
        assert {k[1:]: v for k, v in got.items() if k[0] == tier} == want


def q_vehicles(spark, sf):
    from panelspark.sources import bindings as B
    return B.population(spark, sf)


def test_hierarchical_medians_keep_the_overall_row_when_nothing_was_observed(spark, sf, tmp_path):
    for name in ("nation", "customer", "part", "orders", "lineitem"):
        t = spark.read.parquet(f"{sf}/{name}.parquet")
        (t.where("l_linestatus = 'O'") if name == "lineitem" else t).write.parquet(f"{tmp_path}/{name}.parquet")
    rows = catalog.QUERIES["a03_hierarchical_medians"](spark, str(tmp_path)).collect()
    assert [tuple(r) for r in rows] == [("overall", None, None, None, None, None)]


def test_vehicles_are_written_by_columns_and_only_those_asked_for(spark, sf):
    from panelspark.plans import q_clean
    from panelspark.sources import bindings as B
    whole = clean.load_vehicles(B.population(spark, sf), B.entities(spark, sf))
    some = q_clean.vehicles_of(spark, sf, columns=["vehicle_id", "estimated_range", "is_bev", "latitude"])
    assert some.columns == ["vehicle_id", "estimated_range", "is_bev", "latitude"]
    assert sorted(map(str, some.collect())) == sorted(map(str, whole.select(*some.columns).collect()))
    assert "l_tax" not in plan(q_clean.vehicles_of(spark, sf)) and "l_tax" in whole.columns


def test_stations_are_rolled_up_once_for_all_snapshots(spark, sf, monkeypatch):
    calls, rolled = [], score.station_rollup
    monkeypatch.setattr(score, "station_rollup", lambda *a, **k: calls.append(1) or rolled(*a, **k))
    snaps = catalog.QUERIES["s07_write_snapshot"](spark, sf).collect()
    assert sorted(map(tuple, snaps)) == [("v1", 4), ("v2", 4)] and len(calls) == 1


def test_totals_read_the_stations_and_the_stock_as_written(spark, sf):
    for df in (q_score.attached_stations(spark, sf), q_score.live_population(spark, sf)):
        assert "l_orderkey" not in plan(df) and "l_suppkey" not in plan(df)
