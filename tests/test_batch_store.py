"""The commit log and the batch flow."""

import pytest
from pyspark.sql import functions as F

from panelspark.operators.quality import ValidationError
from panelspark.plans import jobs
from panelspark.sources.store import Store, Update, merge_upsert


def rows_of(spark, *rows):
    return spark.createDataFrame(rows, "k int, m string, v int")


def test_an_upsert_rewrites_only_the_partitions_it_touches(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.write({"t": Update(rows_of(spark, (1, "a", 1), (2, "b", 2), (3, "c", 3)), ["k"], by="m")})
    first = store.state()["tables"]["t"]
    store.write({"t": Update(rows_of(spark, (2, "b", 9), (4, "b", 4)), ["k"], by="m")})
    second = store.state()["tables"]["t"]
    assert set(first) == {"a", "b", "c"} and {x for x in first if first[x] != second[x]} == {"b"}
    assert sorted(map(tuple, store.read("t").collect())) == [(1, "a", 1), (2, "b", 9), (3, "c", 3), (4, "b", 4)]
    assert sorted(map(tuple, store.read("t", version=1).collect())) == [(1, "a", 1), (2, "b", 2), (3, "c", 3)]
    assert store.expire(1, 0) == 0  # the first folder still holds two partitions
    store.write({"t": Update(rows_of(spark, (1, "a", 5), (3, "c", 5)), ["k"], by="m")})
    assert store.expire(1, 0) == 1 and store.read("t").count() == 4


@pytest.mark.parametrize("key", [2, 1])
def test_two_writers_lose_no_row(spark, tmp_path, key):
    """The second writer publishes while the first one has staged its rows: the first starts again from that version."""
    store = Store(spark, str(tmp_path))
    store.write({"t": Update(rows_of(spark, (1, "a", 1)), ["k"]), "u": Update(rows_of(spark, (1, "a", 1)), ["k"])})
    other = lambda: Store(spark, str(tmp_path)).write({"t": Update(rows_of(spark, (key, "x", 7)), ["k"])})
    version = store.write({"t": Update(rows_of(spark, (1, "a", 2), (3, "c", 3)), ["k"])}, before_publish=other)
    want = {1: ("a", 2), 3: ("c", 3), **({2: ("x", 7)} if key == 2 else {})}
    assert version == 3 and {r.k: (r.m, r.v) for r in store.read("t").collect()} == want
    assert store.read("u").count() == 1


def test_repeated_keys(spark):
    upd = rows_of(spark, (1, "a", 1), (1, "b", 1), (1, "a", 0))
    assert [tuple(r) for r in merge_upsert(None, upd, ["k"], "v").collect()] == [(1, "b", 1)]
    assert merge_upsert(None, upd.select("k"), ["k"]).count() == 1


def test_a_failed_run_leaves_everything_as_it_was(spark, tmp_path):
    fp = lambda h: spark.createDataFrame([("s", h, 1)], "source_id string, sha256 string, size_bytes bigint").withColumn(
        "ingested_at", F.current_timestamp())
    report = lambda n: spark.createDataFrame([("population", 1, "missing_vehicle_id", "error", n, "")],
                                             "dataset string, rows bigint, check string, severity string, count bigint, detail string")
    facts = spark.createDataFrame([("King", "2026-01-01", 10.0, 4.0, "h")], "entity string, transaction_month string, "
                                  "all_transactions double, ev_transactions double, source_hash string").withColumn("loaded_at", F.current_timestamp())
    build = lambda run_id, folder: {"entity_month_transactions": facts}
    root, store = str(tmp_path), Store(spark, f"{tmp_path}/warehouse")
    assert jobs.batch_flow(spark, root, fp("one"), [report(0)], build)["status"] == "processed"
    assert jobs.batch_flow(spark, root, fp("one"), [report(9)], build)["status"] == "skipped"
    with pytest.raises(ValidationError):
        jobs.batch_flow(spark, root, fp("two"), [report(1)], build)
    broken = lambda run_id, folder: {"entity_month_transactions": facts.withColumn("ev_transactions", F.lit(None))}
    with pytest.raises(Exception, match="ev_transactions is null"):
        jobs.batch_flow(spark, root, fp("two"), [report(0)], broken)
    assert store.version() == 1 and store.read("ingestion_manifest").first().source_hash == "one"
    assert jobs.batch_flow(spark, root, fp("two"), [report(0)], build) == {
        "status": "processed", "reason": "source_changed", "version": 2, "rows": {"entity_month_transactions": 1, "ingestion_manifest": 1}}
    assert store.read("ingestion_manifest").first().source_hash == "two" and store.read("entity_month_transactions").count() == 1
