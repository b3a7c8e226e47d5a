"""Independent fits run at the same time: each waits for another before it goes on."""

import threading

import pytest
from pyspark.sql import functions as F

from panelspark.operators import models, quality, segments
from panelspark.operators import panel_models as pm
from panelspark.plans import q_models, q_segments, q_series
from panelspark.session import side_by_side


@pytest.fixture
def meet():
    barrier = threading.Barrier(2)
    return lambda: barrier.wait(timeout=60)


def test_results_keep_the_order_of_the_tasks_and_errors_are_raised(spark):
    assert side_by_side(spark, [lambda k=k: spark.range(k).count() for k in (3, 0, 2)]) == [3, 0, 2]
    with pytest.raises(ZeroDivisionError):
        side_by_side(spark, [lambda: 1, lambda: 1 // 0])


def test_kmeans_restarts_run_side_by_side_and_the_first_of_the_cheapest_wins(spark, meet, monkeypatch):
    class Fake:
        def __init__(self, seed, **_):
            self.seed = seed

        def fit(self, df):
            meet()
            self.summary = type("Summary", (), {"trainingCost": float((self.seed - 42) // 2 % 2 == 0)})
            return self

    monkeypatch.setattr(segments, "KMeans", Fake)
    assert segments.kmeans_best(spark.range(1), 3, n_init=8).seed == 44


def test_trees_of_a_panel_are_fitted_side_by_side(spark, meet, monkeypatch):
    monkeypatch.setattr(pm, "fit_tree", lambda train, kind, **_: meet() * 0 or kind)
    monkeypatch.setattr(pm, "predict_tree", lambda model, df, out: df.withColumn(out, F.lit(model)))
    rows = spark.range(1).withColumn("lag_12", F.lit(2.0))
    out, alpha = q_models.predict_all(rows, rows, q_models.ML)
    assert tuple(out.first()) == (0, 2.0, 2.0, "random_forest", "gradient_boosting") and alpha is None


def test_series_models_are_fitted_side_by_side(spark, meet, monkeypatch):
    monkeypatch.setattr(models, "fit_any", lambda rows, keys, m: meet() * 0 or rows.withColumn("prediction", F.lit(m)))
    out = q_series._all_models(spark.range(1), ["id"]).collect()
    assert [(r["model"], r["prediction"]) for r in out] == [(m, m) for m in models.SERIES_ALL]


def test_scenario_segments_load_the_vehicles_once(spark, monkeypatch):
    calls = []
    veh = spark.createDataFrame([("A", 10.0, True, 10.0, True, -120.0, 47.0), ("B", 40.0, True, 40.0, False, -121.0, 46.0)],
                                "entity string, rng double, range_observed boolean, estimated_range double, is_bev boolean, "
                                "longitude double, latitude double")
    flow = spark.createDataFrame([("A", 1.0), ("B", 2.0)], "entity string, ev_transactions double").withColumn("month", F.lit("2020-01-01").cast("date"))
    monkeypatch.setattr(q_segments, "vehicles_of", lambda *a, **k: calls.append(1) or veh)
    monkeypatch.setattr(q_segments, "flow_of", lambda *a: flow)
    monkeypatch.setattr(segments, "assign_segments", lambda f: (f.withColumn("market_segment", F.lit("x")), 0.0))
    got = q_segments.c11_range_scenario_segments(spark, "")
    assert sorted(map(tuple, got.collect())) == [("A", "x", 1.0), ("B", "x", 0.0)] and len(calls) == 1


def test_quality_checks_read_the_rows_once(spark):
    pop = [("1", "A", "2000", "10"), ("1", None, "x", "-5"), (None, "A", "1800", "y"), (None, " ", "2001", None), ("2", "B", None, "7")]
    raw = spark.createDataFrame(pop, "`DOL Vehicle ID` string, County string, `Model Year` string, `Electric Range` string")
    raw = raw.select("*", *[F.lit("z").alias(c) for c in quality.POPULATION_COLUMNS if c not in raw.columns])
    reg = spark.createDataFrame([("2020-01-01", "A", "E", "5"), ("2020-01-01", "A", "E", "5"), ("bad", None, "E", "1,000"),
                                 ("bad", None, "E", "1,000"), ("2020-01-02", "B", "E", "-1")],
                                ", ".join(f"`{c}` string" for c in quality.REGISTRATION_COLUMNS))
    for report, want in (
            (quality.validate_population(raw), {"missing_vehicle_id": 2, "missing_county": 2, "duplicate_vehicle_id": 4, "malformed_model_year": 1,
                                                "impossible_model_year": 1, "malformed_electric_range": 1, "negative_electric_range": 1}),
            (quality.validate_registrations(reg), {"missing_county": 2, "invalid_date": 2, "thousands_formatted_count": 2, "negative_count": 1,
                                                   "duplicate_row": 4})):
        assert {r["check"]: r["count"] for r in report.collect()} == want
        assert {r["rows"] for r in report.collect()} == {5}
        text = report._jdf.queryExecution().optimizedPlan().toString()
        assert text.count("LogicalRDD") + text.count("LocalRelation") == 1 and "subquery" not in text
    assert quality.validate_population(raw.where("false")).count() == 0
