"""Every oracle-checked catalogue query vs its DuckDB SQL at sf0.001, and
rows-only queries give rows. Heavy model fits are in `test_catalog_models.py`."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from panelspark.plans import catalog  # noqa: E402

catalog.load_all()
SF = "/root/testdata/sf0.001"
HEAVY = ("m05", "m06", "m07", "m08", "m09", "m10", "m11", "m12", "m15", "m16", "m17_conformal_selected", "m18",
         "k07", "a22_coverage_selected", "c10", "c11_range_scenario_segments", "a25", "s16")


@pytest.fixture(scope="module")
def duck():
    import oracle_check
    return oracle_check.duck(SF)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_matches_oracle(spark, duck, name):
    import oracle_check
    sdf = catalog.QUERIES[name](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    cur = duck.execute(catalog.ORACLE[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert oracle_check.digest(sdf.columns, srows)[0] == oracle_check.digest(dcols, drows)[0]


@pytest.mark.parametrize("name", sorted(n for n in catalog.QUERIES if n not in catalog.ORACLE and not n.startswith(HEAVY)))
def test_rows_only_query_runs(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0 and "rmse" in df.columns
