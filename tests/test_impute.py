"""Tiered imputation: dictionary join against brute force, in both ways, and its plan."""

import random
import statistics

import pytest

from panelspark.operators import clean

TIERS = (("make", "model", "model_year"), ("make", "model"), ("ev_type",), ())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    pick = lambda xs: rng.choice([*xs, None])
    made = [(i, pick("ab"), pick("xyz"), pick([2019, 2020, 2021]), pick(["B", "P"]), pick([0.0, 100.0, 150.0, 210.0])) for i in range(500)]
    return made + [(1000 + i, "a", "x", 2020, "B", None if i % 3 else 300.0 + i % 7) for i in range(400)]


def brute(rows):
    names = ("make", "model", "model_year", "ev_type")
    recs = [dict(zip(("i", *names, "rng"), r)) for r in rows]
    seen = [r for r in recs if r["rng"]]
    out = {}
    for r in recs:
        out[r["i"]] = r["rng"] or None
        for t in TIERS:
            if out[r["i"]] is None and all(r[k] is not None for k in t):
                vs = [s["rng"] for s in seen if all(s[k] == r[k] for k in t)]
                out[r["i"]] = statistics.median(vs) if vs else None
    return out


@pytest.mark.parametrize("way", [{}, {"broadcast_tuples": 20, "rows_per_salt": 50}])
def test_imputation_equals_brute_force(spark, rows, way):
    df = spark.createDataFrame(rows, "i int, make string, model string, model_year int, ev_type string, rng double")
    df = df.selectExpr("*", "coalesce(rng > 0, false) AS seen")
    got = clean.impute_hierarchical(df, "rng", "seen", "est", TIERS, **way)
    assert got.columns == [*df.columns, "est"]
    assert {r.i: r.est for r in got.collect()} == brute(rows) and got.count() == len(rows)
    assert clean.impute_hierarchical(df.limit(0), "rng", "seen", "est", TIERS, **way).count() == 0
    assert {r.est for r in clean.impute_hierarchical(df, "rng", "seen", "est", ((),), **way).where("not seen").collect()} == \
        {statistics.median(r[5] for r in rows if r[5])}


def test_raw_rows_are_not_exchanged_by_a_tier_key(spark, rows):
    df = spark.createDataFrame(rows, "i int, make string, model string, model_year int, ev_type string, rng double").selectExpr("*", "rng > 0 AS seen")
    plan = lambda **way: clean.impute_hierarchical(df, "rng", "seen", "est", TIERS, **way)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan()
    assert "BroadcastHashJoin" in plan()
    shuffled = plan(broadcast_tuples=20, rows_per_salt=50)
    assert all("_salt" in x or "_s#" in x for x in shuffled.split("hashpartitioning(")[1:])
