"""Read-side queries over served products."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class NotFound(LookupError):
    pass


def lookup(df: DataFrame, column: str, text: str) -> DataFrame:
    """Case-insensitive key filter."""
    return df.where(F.lower(F.col(column)) == F.lit(text.lower()))


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Raise NotFound when `df` is empty (one-row probe, `limit(1)`)."""
    if not df.limit(1).collect():
        raise NotFound(f"{what} not found")
    return df


def forecast_for(long_forecasts: DataFrame, name: str) -> DataFrame:
    """Forecast rows for an entity, or the statewide series for the keyword
    'statewide' (Q02); unknown names raise NotFound."""
    if name.lower() == "statewide":
        return long_forecasts.where(F.col("scope") == "statewide").drop("entity")
    return require_rows(lookup(long_forecasts.where(F.col("scope") == "entity"), "entity", name), "entity")


def stations_for(stations: DataFrame, entity: str | None = None) -> DataFrame:
    """Stations, optionally of one entity (case-insensitive), with the count (Q05)."""
    s = stations if entity is None else lookup(stations, "entity", entity)
    # the count is a scalar subquery (partial counts, one value broadcast back),
    # not a window over one partition holding every station
    return s.withColumn("count", s.select(F.count(F.lit(1))).scalar())


def history_and_forecast(history: DataFrame, forecast: DataFrame, value: str = "value") -> DataFrame:
    """History and forecast of one series as one table with a kind column (Q06)."""
    h = history.select("month", F.col(value).cast("double").alias("value"), F.lit("history").alias("kind"))
    f = forecast.select("month", F.col("prediction").cast("double").alias("value"), F.lit("forecast").alias("kind"))
    return h.unionByName(f)


def map_frame(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Rows with both coordinates (Q07)."""
    return df.na.drop(subset=[lat, lon])


def drop_if_present(df: DataFrame, column: str) -> DataFrame:
    """Drop a column when it exists."""
    return df.drop(column) if column in df.columns else df
