"""Flow build, gap filling and past-only features."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelspark.operators import clean, panel

D = dt.date


def month_rows(entity, start, values):
    y, m = start
    out = []
    for i, v in enumerate(values):
        mm = m - 1 + i
        out.append((entity, D(y + mm // 12, mm % 12 + 1, 1), float(v)))
    return out


def test_flow_counts_electric_and_all_fuels(spark):
    # King 01/31/2025: Electric 7, Hybrid 11
    raw = spark.createDataFrame([("01/31/2025", "King", "Electric", "7"), ("01/31/2025", "King", "Hybrid", "11")],
                                "txn_date string, entity string, fuel string, cnt string")
    row = clean.load_flow(raw, ["King"]).first()
    assert (row.month, row.ev_transactions, row.all_transactions) == (D(2025, 1, 1), 7.0, 18.0)


def test_flow_drops_thousands_text_unless_asked(spark):
    # F13 counts: "1,234" drops by default (as coded), "12d"/"nan"/null always drop, " 7 " parses
    raw = spark.createDataFrame([("2025-01-05", "King", "Electric", c) for c in ("1,234", "12d", "nan", " 7 ", None)],
                                "txn_date string, entity string, fuel string, cnt string")
    from panelspark.functions import null_tokens
    raw = raw.withColumn("cnt", null_tokens("cnt"))
    assert clean.load_flow(raw).first().ev_transactions == 7.0
    assert clean.load_flow(raw, parse_thousands=True).first().ev_transactions == 1241.0


def test_densify_fills_missing_months_with_zero(spark):
    # an entity missing 5 of 20 months
    vals = list(range(1, 21))
    rows = [r for i, r in enumerate(month_rows("A", (2020, 1), vals)) if i not in (3, 4, 9, 15, 16)]
    rows += month_rows("B", (2020, 1), [1] * 20)
    flow = spark.createDataFrame(rows, "entity string, month date, ev_transactions double")
    dense = panel.densify_panel(flow)
    a = dense.where("entity = 'A'").orderBy("month").collect()
    assert len(a) == 20 and dense.count() == 40
    assert [r.ev_transactions for r in a][3:5] == [0.0, 0.0]


def panel_fixture(spark, months=42):
    rows = month_rows("King", (2020, 1), [100 + i for i in range(months)])
    rows += month_rows("Pierce", (2020, 1), [25 + i for i in range(months)])
    return spark.createDataFrame(rows, "entity string, month date, ev_transactions double")


def test_feature_exact_values(spark):
    # King at 2022-01 (index 24, value 124)
    f = panel.panel_features(panel_fixture(spark)).where("entity = 'King' AND month = DATE'2022-01-01'").first()
    assert f.lag_1 == 123 and f.lag_12 == 112
    assert f.lag_3_mean == pytest.approx(sum(range(121, 124)) / 3)
    assert f.lag_12_mean == pytest.approx(sum(range(112, 124)) / 12)
    assert f.month_index == 24


def test_features_never_read_the_future(spark):
    # changing values from 2022-06 on leaves features up to 2022-06 equal
    base = panel_fixture(spark)
    changed = base.withColumn("ev_transactions", F.when(F.col("month") >= "2022-06-01", F.col("ev_transactions") * 10 + 7)
                              .otherwise(F.col("ev_transactions")))
    cols = ["entity", "month", *panel.FEATURES]
    a = panel.panel_features(base).where("month <= DATE'2022-06-01'").select(*cols)
    b = panel.panel_features(changed).where("month <= DATE'2022-06-01'").select(*cols)
    assert a.count() > 0 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_feature_whitelist():
    allowed = {"lag_1", "lag_2", "lag_3_mean", "lag_12", "lag_13", "lag_12_mean", "yoy_gap", "recent_vs_year",
               "month_sin", "month_cos", "entity_scale", "month_index"}
    assert set(panel.FEATURES) == allowed
    for stock_col in ("total_evs", "avg_range_miles", "observed_low_range_share", "bev_share", "estimated_range"):
        assert stock_col not in panel.FEATURES


def test_time_splits_are_ordered_and_disjoint(spark):
    # King and Pierce, value = i, 115 months from 2017-01
    rows = month_rows("King", (2017, 1), range(115)) + month_rows("Pierce", (2017, 1), range(115))
    flow = spark.createDataFrame(rows, "entity string, month date, ev_transactions double")
    s = panel.time_splits(panel.panel_features(flow))
    panel.assert_splits(s)
    test_months = s.where("split = 'test'").select("month").distinct().count()
    assert test_months == 12
    chk = panel.split_checks(s).first()
    assert chk.ordered and chk.unique_keys


def test_rolling_folds_cover_expected_blocks(spark):
    rows = month_rows("S", (2015, 1), range(96))
    series = spark.createDataFrame(rows, "series string, month date, value double")
    f = panel.rolling_folds(series)
    v = f.where("role = 'validation'").groupBy("fold").agg(F.min("month").alias("lo"), F.max("month").alias("hi"),
                                                          F.count("*").alias("n")).orderBy("fold").collect()
    assert [r.n for r in v] == [12, 12, 12]
    assert v[2].hi == D(2021, 12, 1)  # development ends 12 months before the last month (2022-12)
    train3 = f.where("fold = 3 AND role = 'train'").agg(F.max("month")).first()[0]
    assert train3 < v[2].lo
