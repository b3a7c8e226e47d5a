"""Series models, count models and the streaming ingest."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelspark.operators import models, panel_models


def series_fixture(spark, n=96):
    # 96 months from 2020-01, value 100 + 3i + 2 (i mod 12)
    rows = [("s", dt.date(2020 + i // 12, i % 12 + 1, 1), float(100 + 3 * i + 2 * (i % 12))) for i in range(n)]
    return spark.createDataFrame(rows, "series string, month date, value double")


@pytest.mark.parametrize("name", ["seasonal_naive", "linear", "polynomial_2", "seasonal_ridge"])
def test_forecasts_are_twelve_nonnegative_months(spark, name):
    rows = models.future_rows(series_fixture(spark), ["series"])
    pred = models.SERIES_FITTERS[name](rows, ["series"]).orderBy("month").collect()
    assert len(pred) == 12 and pred[0].month == dt.date(2028, 1, 1)
    assert all(p.prediction >= 0 for p in pred)


def test_linear_and_quadratic_match_numpy(spark):
    s = series_fixture(spark)
    pdf = s.toPandas()
    t = np.arange(len(pdf))[12:]
    y = pdf["value"].to_numpy()[12:]
    rows = models.future_rows(s, ["series"])
    tf = np.arange(96, 108)
    for name, deg in (("linear", 1), ("polynomial_2", 2)):
        got = [r.prediction for r in models.SERIES_FITTERS[name](rows, ["series"]).orderBy("month").collect()]
        want = np.polyval(np.polyfit(t, y, deg), tf)
        assert np.allclose(got, np.maximum(want, 0), rtol=1e-6)


def test_ridge_matches_direct_solve(spark):
    s = series_fixture(spark)
    pdf = s.toPandas()
    t = np.arange(len(pdf))[12:].astype(float)
    months = np.array([d.month for d in pdf["month"]])[12:]
    x = np.column_stack([t, (months[:, None] == np.arange(1, 13)).astype(float)])
    y = pdf["value"].to_numpy()[12:]
    xm, ym = x.mean(0), y.mean()
    beta = np.linalg.solve((x - xm).T @ (x - xm) + 100.0 * np.eye(13), (x - xm).T @ (y - ym))
    tf = np.arange(96, 108).astype(float)
    xf = np.column_stack([tf, (np.arange(1, 13)[:, None] == np.arange(1, 13)).astype(float)])
    want = np.maximum(xf @ beta + ym - xm @ beta, 0)
    got = [r.prediction for r in models.seasonal_ridge(models.future_rows(s, ["series"]), ["series"]).orderBy("month").collect()]
    assert np.allclose(got, want)


def test_ridge_without_some_months_and_without_history(spark):
    """Months of the year never trained have no effect, null values are left out, a series without train rows gets null."""
    rows = [("a", dt.date(2020 + i // 12, i % 12 + 1, 1), None if i == 20 else float(i * i % 37), "train") for i in range(60) if i % 12 not in (3, 7)]
    rows += [("a", dt.date(2025, m, 1), None, "future") for m in range(1, 13)] + [("b", dt.date(2025, 1, 1), None, "future")]
    df = spark.createDataFrame(rows, "series string, month date, value double, role string")
    got = {(r.series, r.month): r.prediction for r in models.seasonal_ridge(df, ["series"]).collect()}
    assert len(got) == 13 and got["b", dt.date(2025, 1, 1)] is None
    fit = [r for r in rows if r[3] == "train" and r[2] is not None and (r[1].year - 2020) * 12 + r[1].month - 1 >= 12]
    x = np.array([[(m.year - 2020) * 12 + m.month - 1, *(m.month == np.arange(1, 13))] for _, m, _, _ in fit], float)
    y = np.array([r[2] for r in fit])
    xm, ym = x.mean(0), y.mean()
    beta = np.linalg.solve((x - xm).T @ (x - xm) + 100.0 * np.eye(13), (x - xm).T @ (y - ym))
    want = [max(0.0, (np.array([60 + m - 1, *(m == np.arange(1, 13))]) - xm) @ beta + ym) for m in range(1, 13)]
    assert np.allclose([got["a", dt.date(2025, m, 1)] for m in range(1, 13)], want)


def overdispersed_panel(spark, zero_entity=False):
    # 6 entities x 60 months, variance >> mean
    rng = np.random.default_rng(3)
    rows = []
    for e in range(6):
        for i in range(60):
            v = 0.0 if (zero_entity and e == 5) else float(rng.negative_binomial(2, 2 / (2 + 20 + 5 * e)))
            rows.append((f"E{e}", dt.date(2020 + i // 12, i % 12 + 1, 1), v))
    return spark.createDataFrame(rows, "entity string, month date, ev_transactions double")


def test_count_models_fit_overdispersed_data(spark):
    from panelspark.operators import panel
    feats = panel.panel_features(overdispersed_panel(spark))
    cm = panel_models.fit_count_models(feats)
    assert cm.alpha > 0.01 and cm.poisson.converged and cm.nb.converged
    pois = panel_models.predict_count(cm, feats, "poisson_glm").toPandas()
    nb = panel_models.predict_count(cm, feats, "negative_binomial").toPandas()
    assert (pois["prediction"] >= 0).all() and (nb["prediction"] >= 0).all()
    assert np.corrcoef(pois["prediction"], nb["prediction"])[0, 1] > 0.9


def _dummy_irls(x, y, alpha=0.0, rounds=100):
    """Reference IRLS with an explicit intercept and dummy columns (numpy)."""
    eta = np.log(y + 0.1)
    for _ in range(rounds):
        mu = np.exp(eta)
        w = mu / (1 + alpha * mu)
        z = eta + (y - mu) / mu
        xw = x * w[:, None]
        beta = np.linalg.lstsq(xw.T @ x, xw.T @ z, rcond=None)[0]
        new = x @ beta
        if np.max(np.abs(new - eta)) < 1e-11:
            break
        eta = new
    return np.exp(x @ beta)


def test_absorbed_entity_effects_equal_the_dummy_variable_glm(spark):
    # the within-transformed IRLS must reproduce the one-hot (entity, month-of-year) GLM exactly
    from panelspark.operators import panel
    feats = panel.panel_features(overdispersed_panel(spark))
    cm = panel_models.fit_count_models(feats)
    pdf = panel_models.count_design(feats).toPandas().sort_values(["entity", "month"]).reset_index(drop=True)
    ent = pd.get_dummies(pdf["entity"], drop_first=True, dtype=float).to_numpy()
    x = np.column_stack([np.ones(len(pdf)), pdf[list(panel_models.DESIGN)].to_numpy(), ent])
    y = pdf["ev_transactions"].to_numpy(dtype=float)
    for which, alpha in (("poisson_glm", 0.0), ("negative_binomial", cm.alpha)):
        got = panel_models.predict_count(cm, feats, which).toPandas().sort_values(["entity", "month"])
        want = _dummy_irls(x, y, alpha)
        assert np.allclose(got["prediction"].to_numpy(), want, rtol=1e-6, atol=1e-8), which


def test_all_zero_entity_is_left_out_and_predicted_zero(spark):
    from panelspark.operators import panel
    feats = panel.panel_features(overdispersed_panel(spark, zero_entity=True))
    cm = panel_models.fit_count_models(feats)
    p = panel_models.predict_count(cm, feats.where("entity = 'E5'"), "negative_binomial")
    assert p.agg(F.max("prediction")).first()[0] == 0.0


def test_streaming_restatement_replaces_month(spark):
    from panelspark.sources import files
    from panelspark.streaming.incremental import incremental_ingest
    schema = "txn_date date, entity string, fuel string, cnt bigint"
    landing = files.shared_dir(spark, "test", "landing")
    spark.createDataFrame([(dt.date(2025, 1, 5), "King", "Electric", 3), (dt.date(2025, 2, 5), "King", "Electric", 4)],
                          schema).coalesce(1).write.parquet(f"{landing}/a")
    store = files.shared_dir(spark, "test", "store")
    first = {r.month: r.ev_transactions for r in incremental_ingest(spark, f"{landing}/*", spark.createDataFrame([], schema).schema,
                                                                   store).collect()}
    assert first == {dt.date(2025, 1, 1): 3.0, dt.date(2025, 2, 1): 4.0}
    # a late file adds rows to January: the month is recomputed from all its raw rows
    spark.createDataFrame([(dt.date(2025, 1, 20), "King", "Electric", 2)], schema).coalesce(1).write.parquet(f"{landing}/b")
    second = {r.month: r.ev_transactions for r in incremental_ingest(spark, f"{landing}/*", spark.createDataFrame([], schema).schema,
                                                                    store).collect()}
    assert second == {dt.date(2025, 1, 1): 5.0, dt.date(2025, 2, 1): 4.0}


def many_series(spark, n):
    rows = [(f"s{k:04d}", dt.date(2020 + i // 12, i % 12 + 1, 1), float((k + 1) * (50 + i + 5 * (i % 12)))) for k in range(n) for i in range(48)]
    total = [("statewide", dt.date(2020 + i // 12, i % 12 + 1, 1), float(1000 * (50 + i))) for i in range(48)]
    zero = [("zero", dt.date(2020 + i // 12, i % 12 + 1, 1), 0.0) for i in range(48)]
    return spark.createDataFrame(rows + total + zero, "series string, month date, value double")


@pytest.mark.parametrize("kind", ["random_forest", "gradient_boosting"])
def test_series_trees_take_any_number_of_series(spark, kind, monkeypatch):
    # 40 series are more than a tree's default number of bins; fewer trees keep the test short
    monkeypatch.setitem(models.SERIES_RF, "numTrees", 10)
    monkeypatch.setitem(models.SERIES_GBT, "maxIter", 10)
    rows = models.holdout_rows(many_series(spark, 40), ["series"])
    got = models.fit_any(rows, ["series"], kind).toPandas().set_index(["series", "month"])
    assert len(got) == 42 * 12 and got["prediction"].notna().all()
    assert (got.loc["zero", "prediction"] == 0).all()
    # series that differ in scale alone get the same forecast in their own scale
    assert np.allclose(got.loc["s0039", "prediction"], 40 * got.loc["s0000", "prediction"])
    assert abs(got.loc["statewide", "prediction"] / got.loc["statewide", "value"] - 1).max() < 0.5


def test_count_models_have_no_cap_on_the_fitted_mean(spark):
    # means beyond exp(30) are fitted and predicted as they are
    from panelspark.operators import panel
    big = overdispersed_panel(spark).withColumn("ev_transactions", F.col("ev_transactions") * 1e14)
    feats = panel.panel_features(big)
    cm = panel_models.fit_count_models(feats, with_nb=False)
    assert cm.nb is None and cm.poisson.converged
    got = panel_models.predict_count(cm, feats, "poisson_glm").agg(F.sum("prediction").alias("p"), F.sum("ev_transactions").alias("y")).first()
    assert abs(got.p / got.y - 1) < 1e-6  # the score equation of the intercepts


def test_fits_side_by_side_equal_separate_fits(spark):
    # yearly windows share one loop: same slopes, effects and alpha as one fit at a time, in as many jobs as the slowest
    from panelspark.operators import panel
    feats = panel.panel_features(overdispersed_panel(spark, zero_entity=True))
    months = sorted(r[0] for r in feats.select("month").distinct().collect())
    ends = [months[24], months[-1]]
    rows = None
    for k, end in enumerate(ends):
        part = feats.where(F.col("month") <= F.lit(end)).withColumn("w", F.lit(k))
        rows = part if rows is None else rows.unionByName(part)
    together = panel_models.fit_count_models_by(rows, "w", 2, with_nb=False)
    for k, end in enumerate(ends):
        alone = panel_models.fit_count_models(feats.where(F.col("month") <= F.lit(end)), with_nb=False)
        assert abs(together[k].alpha - alone.alpha) < 1e-6
        a, b = together[k].poisson, alone.poisson
        assert a.converged and b.converged and np.allclose(a.beta, b.beta, rtol=1e-6, atol=1e-8)
        ea, eb = ({r.entity: r._effect for r in m.effects.collect()} for m in (a, b))
        assert ea.keys() == eb.keys() and all(abs(ea[e] - eb[e]) < 1e-6 for e in ea)
