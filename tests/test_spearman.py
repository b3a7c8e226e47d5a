"""Spearman: p-values against tables of the t distribution, several key columns, ties and undefined cases."""

import math

import pytest
from pyspark.sql import functions as F

from panelspark.operators import evaluate


@pytest.mark.parametrize("t, df, p", [(12.706, 1, 0.05), (4.303, 2, 0.05), (2.228, 10, 0.05), (2.75, 30, 0.01), (1.98, 120, 0.05),
                                      (1.96, 10_000_000_000, 0.05), (0.0, 7, 1.0)])
def test_p_value_equals_the_tables(spark, t, df, p):
    rho = t / math.sqrt(df + t * t)
    got = spark.createDataFrame([(rho, df + 2)], "rho double, n bigint").select(evaluate._t_pvalue(F.col("rho"), F.col("n"))).first()[0]
    assert got == pytest.approx(p, abs=2e-4)


@pytest.mark.parametrize("sign", [1.0, -1.0])
def test_perfect_correlation_has_p_zero(spark, sign):
    rows = [(e, m, float(3 * e + m), sign * (3 * e + m)) for e in range(3) for m in range(3)]
    r = evaluate.spearman(spark.createDataFrame(rows, "e int, m int, x double, y double"), "x", "y", ["e", "m"]).first()
    assert (r["rho"], r["p"], r["n"]) == (sign, 0.0, 9)


def test_ties_nulls_and_several_keys(spark):
    rows = [(1, 1, 1.0, 2.0), (1, 2, 2.0, 1.0), (2, 1, 2.0, 3.0), (2, 2, 4.0, 3.0), (3, 1, None, 9.0), (3, 2, 5.0, None)]
    r = evaluate.spearman(spark.createDataFrame(rows, "e int, m int, x double, y double"), "x", "y", ["e", "m"]).first()
    x, y = (1, 2.5, 2.5, 4), (2, 1, 3.5, 3.5)
    rho = sum((a - 2.5) * (b - 2.5) for a, b in zip(x, y)) / math.sqrt(sum((a - 2.5) ** 2 for a in x) * sum((b - 2.5) ** 2 for b in y))
    assert r["n"] == 4 and r["rho"] == pytest.approx(round(rho, 3))


def test_undefined_cases_are_null(spark):
    schema = "k int, x double, y double"
    two = evaluate.spearman(spark.createDataFrame([(1, 1.0, 2.0), (2, 2.0, 3.0)], schema), "x", "y", "k").first()
    flat = evaluate.spearman(spark.createDataFrame([(i, 1.0, float(i)) for i in range(5)], schema), "x", "y", "k").first()
    none = evaluate.spearman(spark.createDataFrame([], schema), "x", "y", "k").first()
    assert two["p"] is None and flat["p"] is None and none["n"] == 0 and none["p"] is None


def test_sides_of_zero(spark):
    rows = [("a", 1.0), ("b", 0.0), ("c", -2.0), ("d", None)]
    got = evaluate.improvement_sides(spark.createDataFrame(rows, "entity string, ml_improvement_vs_baseline_pct double"))
    assert {tuple(r) for r in got.collect()} == {("above_zero", 1, 25.0), ("not_above_zero", 3, 75.0)}
