"""Queries with heavy model fits, at sf0.001: what must hold of their rows."""

import pytest
from pyspark.sql import functions as F

from panelspark.plans import catalog
from test_catalog import HEAVY, SF

catalog.load_all()


@pytest.mark.parametrize("name", sorted(n for n in catalog.QUERIES if n not in catalog.ORACLE and n.startswith(HEAVY)))
def test_model_query_gives_rows(spark, name):
    df = catalog.QUERIES[name](spark, SF)
    rows = df.collect()
    assert rows
    if "prediction" in df.columns:
        assert all(r["prediction"] is not None and r["prediction"] >= 0 for r in rows)


def test_poisson_means_add_up(spark):
    """At the optimum the fitted means of the training rows add up to the counts, for each entity and month of year."""
    from panelspark.operators import panel_models
    from panelspark.plans.q_models import splits_of
    train = splits_of(spark, SF).where("split = 'train'")
    cm = panel_models.fit_count_models(train, with_nb=False)
    p = panel_models.predict_count(cm, train, "poisson_glm")
    for key in ("entity", F.month("month")):
        for r in p.groupBy(key).agg(F.sum("prediction").alias("p"), F.sum("ev_transactions").alias("y")).collect():
            assert abs(r.p - r.y) <= 1e-4 * max(1.0, r.y)
