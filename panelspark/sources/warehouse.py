"""Keyed analytical tables and key-based upserts.

Tables live in a `Store`: an upsert rewrites only the partitions that hold
its keys and publishes a new version, which readers see whole or not at all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.session import cut_lineage
from panelspark.sources.store import Store, Update, merge_upsert  # noqa: F401 (merge_upsert is part of this module's interface)

# The four keyed warehouse tables.
SCHEMAS = {
    "ingestion_manifest": (T.StructType([
        T.StructField("source_id", T.StringType(), False), T.StructField("source_hash", T.StringType(), False),
        T.StructField("size_bytes", T.LongType(), False), T.StructField("ingested_at", T.TimestampType(), False),
        T.StructField("status", T.StringType(), False)]), ("source_id",)),
    "entity_month_transactions": (T.StructType([
        T.StructField("entity", T.StringType(), False), T.StructField("transaction_month", T.DateType(), False),
        T.StructField("all_transactions", T.DoubleType(), False), T.StructField("ev_transactions", T.DoubleType(), False),
        T.StructField("source_hash", T.StringType(), False), T.StructField("loaded_at", T.TimestampType(), False)]),
        ("entity", "transaction_month")),
    "modeling_features": (T.StructType(
        [T.StructField("entity", T.StringType(), False), T.StructField("feature_month", T.DateType(), False)]
        + [T.StructField(c, T.DoubleType(), True) for c in (
            "lag_1", "lag_2", "lag_3_mean", "lag_12", "lag_13", "lag_12_mean", "yoy_gap", "recent_vs_year",
            "month_sin", "month_cos", "entity_scale", "month_index", "ev_transactions")]
        + [T.StructField("run_id", T.StringType(), False), T.StructField("loaded_at", T.TimestampType(), False)]),
        ("entity", "feature_month")),
    "forecast_results": (T.StructType([
        T.StructField("scope", T.StringType(), False), T.StructField("entity", T.StringType(), False),
        T.StructField("forecast_date", T.DateType(), False), T.StructField("model", T.StringType(), False),
        T.StructField("predicted_transactions", T.DoubleType(), False), T.StructField("run_id", T.StringType(), False),
        T.StructField("loaded_at", T.TimestampType(), False)]), ("scope", "entity", "forecast_date", "model")),
}


def create_table_sql(name: str, location: str) -> str:
    """`CREATE TABLE ... USING parquet` text for a schema."""
    schema, _ = SCHEMAS[name]
    cols = ", ".join(f"{f.name} {f.dataType.simpleString().upper()}{'' if f.nullable else ' NOT NULL'}" for f in schema.fields)
    return f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet LOCATION '{location}'"


def conform(name: str, rows: DataFrame) -> Update:
    """Rows in the columns and types of a warehouse table (S11), as an upsert by its keys. A null where the table allows
    none is an error, raised when the rows are written."""
    schema, keys = SCHEMAS[name]
    cols = []
    for f in schema.fields:
        c = F.col(f.name).cast(f.dataType)
        cols.append((c if f.nullable else F.coalesce(c, F.raise_error(F.lit(f"{name}.{f.name} is null")).cast(f.dataType))).alias(f.name))
    return Update(rows.select(*cols), keys)


def read_table(spark: SparkSession, root: str) -> DataFrame | None:
    return Store(spark, root).read("table")


def upsert_table(spark: SparkSession, root: str, updates: DataFrame, keys: Sequence[str], order: str | None = None, by: str | None = None) -> int:
    """S12 on a stored table: merges the partitions that hold the updates' keys and publishes the next version. Partitions
    are the values of `by`, or hash buckets of the keys. Returns the rows loaded."""
    rows = cut_lineage(updates)  # read for its partitions, the merge and the count
    Store(spark, root).write({"table": Update(rows, keys, order, by)})
    return rows.select(*keys).distinct().count()


def load_forecasts(wide: DataFrame, id_cols: Sequence[str] = ("entity", "month"), statewide_key: str = "statewide",
                   run_id: str = "run") -> DataFrame:
    """Wide forecasts -> long (scope, entity, forecast_date, model,
    predicted_transactions) (S13, U02). Statewide rows get scope
    'statewide'."""
    models = [c for c in wide.columns if c not in id_cols]
    long = wide.unpivot(list(id_cols), models, "model", "predicted_transactions")
    ent, month = id_cols
    return long.select(
        F.when(F.col(ent) == statewide_key, "statewide").otherwise("entity").alias("scope"),
        F.col(ent).alias("entity"), F.col(month).alias("forecast_date"), "model",
        F.col("predicted_transactions").cast("double").alias("predicted_transactions"), F.lit(run_id).alias("run_id"))


def read_forecasts_wide(long: DataFrame, scope: str, models: Sequence[str]) -> DataFrame:
    """Long -> wide by model (S14, U03); the entity column is dropped for the
    statewide scope. The model list is passed so the pivot needs no extra
    distinct pass."""
    w = long.where(F.col("scope") == scope).groupBy("entity", "forecast_date").pivot("model", list(models)) \
        .agg(F.first("predicted_transactions"))
    return w.drop("entity") if scope == "statewide" else w


def save_models(models: dict, root: str) -> list[tuple[str, str]]:
    """Persist fitted Spark ML models with their own writers."""
    out = []
    for name, m in models.items():
        path = f"{root.rstrip('/')}/{name}"
        m.write().overwrite().save(path)
        out.append((name, path))
    return out
