"""Stock cleaning, tiered imputation and row-quality checks."""

import pytest

from panelspark.operators import clean, quality

POP_SCHEMA = ("vehicle_id bigint, entity string, state string, make string, model string, model_year bigint, "
              "rng double, ev_type string, location string")


def test_stock_filters_state_dedupes_and_imputes(spark):
    # WA/100, WA/0, CA/50 -> 2 vehicles, 1 unobserved, row 2 imputed to 100, stock King = 2
    rows = [(1, "King", "WA", "A", "X", 2020, 100.0, "BEV", "POINT (-122.3 47.5)"),
            (2, "King", "WA", "A", "X", 2020, 0.0, "BEV", "POINT (-122.3 47.5)"),
            (3, "King", "CA", "A", "X", 2020, 50.0, "BEV", "POINT (-122.3 47.5)")]
    pop = spark.createDataFrame(rows, POP_SCHEMA)
    v = clean.load_vehicles(pop, ["King"], states=["WA"])
    got = {r.vehicle_id: r for r in v.collect()}
    assert set(got) == {1, 2}
    assert not got[2].range_observed and got[2].estimated_range == 100.0
    assert (got[1].longitude, got[1].latitude) == (-122.3, 47.5)
    stock = clean.entity_stock(v).first()
    assert stock.total_evs == 2 and stock.observed_range_share == 0.5


def test_imputation_tiers(spark):
    # model/year ranges differ; a model known only in another year; a type-only match; a type with no match
    rows = [(1, "E", "WA", "M", "X", 2020, 100.0, "BEV", None), (2, "E", "WA", "M", "X", 2021, 200.0, "BEV", None),
            (3, "E", "WA", "M", "X", 2020, 0.0, "BEV", None),   # same make/model/year -> 100
            (4, "E", "WA", "M", "X", 2022, 0.0, "BEV", None),   # make/model only -> 150
            (5, "E", "WA", "N", "Y", 2020, 0.0, "BEV", None),   # type only -> median(100, 200, 30) = 100
            (6, "E", "WA", "N", "Z", 2020, 30.0, "BEV", None),
            (7, "E", "WA", "O", "Q", 2020, 0.0, "FCEV", None)]  # no type match -> overall median = 100
    v = clean.load_vehicles(spark.createDataFrame(rows, POP_SCHEMA))
    got = {r.vehicle_id: r.estimated_range for r in v.collect()}
    assert got[3] == 100.0 and got[4] == 150.0 and got[5] == 100.0 and got[7] == 100.0
    as_coded = clean.load_vehicles(spark.createDataFrame(rows, POP_SCHEMA), tiers=(("make", "model"), ("ev_type",), ()))
    assert {r.vehicle_id: r.estimated_range for r in as_coded.collect()}[3] == 150.0  # year ignored


def registrations(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in quality.REGISTRATION_COLUMNS))


def test_valid_registrations_have_no_issues(spark):
    # F03
    rep = quality.validate_registrations(registrations(spark, [("2026-01-31", "King", "Electric", "3")]))
    assert rep.count() == 0
    quality.require_valid(rep)


def test_invalid_registrations_are_reported_and_gated(spark):
    # F04
    rep = quality.validate_registrations(registrations(spark, [
        ("2026-01-31", "King", "Electric", "3"), ("not-a-date", None, "Electric", "not-a-number")]))
    checks = {r.check: r["count"] for r in rep.collect()}
    assert checks["invalid_date"] == 1 and checks["malformed_count"] == 1 and checks["missing_county"] == 1
    with pytest.raises(quality.ValidationError, match="Data validation failed"):
        quality.require_valid(rep)


def test_missing_required_column_stops_checks(spark):
    raw = spark.createDataFrame([("1",)], "`DOL Vehicle ID` string")
    rep = quality.validate_population(raw).collect()
    assert len(rep) == 1 and rep[0].check == "required_columns" and rep[0]["count"] == 8


def test_duplicate_rows_compare_all_columns(spark):
    from panelspark.operators.quality import validate_registrations
    cols = ["Transaction Date", "Residential County", "Fuel Type", "Count", "Note"]
    rows = [("2025-01-01", "King", "Electric", "1", "a"), ("2025-01-01", "King", "Electric", "1", "b"), ("2025-01-02", "King", "Electric", "1", "c"),
            ("2025-01-02", "King", "Electric", "1", "c")]
    got = {r.check: r["count"] for r in validate_registrations(spark.createDataFrame(rows, cols)).collect()}
    assert got["duplicate_row"] == 2


def test_r2_of_large_counts(spark):
    import numpy as np

    from panelspark.operators.metrics import score
    rng = np.random.default_rng(0)
    y = 1e9 + rng.normal(0, 3, 500)
    p = y + rng.normal(0, 0.3, 500)
    want = 1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum()
    row = score(spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, p double"), "y", "p", rounded=False).first()
    assert abs(row.r2 - want) < 1e-6


def test_long_zip_stays_whole(spark):
    from pyspark.sql import functions as F

    from panelspark.functions.scalars import norm_zip
    got = [r[0] for r in spark.createDataFrame([("981",), ("981011",), (None,)], "z string").select(norm_zip(F.col("z"))).collect()]
    assert got == ["00981", "981011", None]
