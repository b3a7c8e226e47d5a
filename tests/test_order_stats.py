"""Distributed ranks and quantiles vs pandas / numpy, including a hot group."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelspark.operators import order_stats as os_


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(7)
    n = 3000
    g = np.where(rng.random(n) < 0.34, "hot", rng.choice(["a", "b", "c", "d"], n))  # a third in one group
    v = rng.integers(0, 40, n).astype(float)  # many ties
    pdf = pd.DataFrame({"id": np.arange(n), "g": g, "v": v})
    return pdf, spark.createDataFrame(pdf)


def test_rank_pct_matches_pandas_average_ties(skewed):
    pdf, df = skewed
    got = os_.rank_pct(df, "v", "pct", by=["g"]).toPandas().set_index("id").sort_index()
    want = pdf.groupby("g")["v"].rank(pct=True)
    assert np.allclose(got["pct"].to_numpy(), want.sort_index().to_numpy())


def test_rank_min_desc_matches_pandas(skewed):
    pdf, df = skewed
    got = os_.rank_min(df, "v", "r").toPandas().set_index("id").sort_index()
    want = pdf["v"].rank(method="min", ascending=False)
    assert (got["r"].to_numpy() == want.to_numpy()).all()


def test_quantiles_match_numpy_linear(skewed):
    pdf, df = skewed
    got = os_.quantiles(df, "v", {"p05": 0.05, "med": 0.5, "p95": 0.95}, by=["g"]).toPandas().set_index("g")
    for g, part in pdf.groupby("g"):
        for name, p in (("p05", 0.05), ("med", 0.5), ("p95", 0.95)):
            assert got.loc[g, name] == pytest.approx(np.quantile(part["v"], p))


def test_row_number_and_ntile_match_sql(spark, skewed):
    pdf, df = skewed
    got = os_.row_number(df, [F.col("v").asc(), F.col("id").asc()], "rn", total="n")
    got = got.withColumn("tile", os_.ntile_of(F.col("rn"), F.col("n"), 3)).toPandas().set_index("id").sort_index()
    df.createOrReplaceTempView("t_rank")
    want = spark.sql("SELECT id, row_number() OVER (ORDER BY v, id) AS rn, ntile(3) OVER (ORDER BY v, id) AS tile FROM t_rank") \
        .toPandas().set_index("id").sort_index()
    assert (got["rn"].to_numpy() == want["rn"].to_numpy()).all()
    assert (got["tile"].to_numpy() == want["tile"].to_numpy()).all()


def test_conformal_quantile_of_one_to_nine(spark):
    # 1..9 -> 8 at 0.8, 9 at 0.95
    df = spark.createDataFrame([("g", float(r)) for r in range(1, 10)], "g string, r double")
    for p, want in ((0.8, 8.0), (0.95, 9.0)):
        got = os_.kth_smallest(df, "r", os_.conformal_rank(p), by=["g"], out="q").first()
        assert got.q == want and got.n == 9
