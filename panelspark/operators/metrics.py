"""Forecast error metrics as aggregates (A15-A19, M19-M21 helpers).

All metrics come from one pass of sums per group (partial aggregation before
the shuffle): MAE, RMSE, R^2 = 1 - SSE/SST with SST from sum(y) and sum(y^2),
WAPE = sum|e| / max(sum y, 1) (pooled form) or NULL when sum y = 0 (entity form).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def error_sums(actual: str, predicted: str) -> list[Column]:
    e = F.col(actual) - F.col(predicted)
    y = F.col(actual)
    return [F.count(F.lit(1)).alias("_n"), F.sum(F.abs(e)).alias("_sae"), F.sum(e * e).alias("_sse"),
            F.sum(y).alias("_sy"), F.var_pop(y).alias("_vy")]


def from_sums(wape: str = "pooled", digits: bool = True) -> list[Column]:
    n, sae, sse, sy, vy = (F.col(c) for c in ("_n", "_sae", "_sse", "_sy", "_vy"))
    sst = vy * n  # not from raw squares, whose difference cancels for large counts
    r2 = F.when(sst > 0, F.lit(1.0) - sse / sst)
    if wape == "pooled":
        w = sae / F.greatest(sy, F.lit(1.0)) * 100.0
    else:
        w = F.when(sy > 0, sae / sy * 100.0)
    mae, rmse = sae / n, F.sqrt(sse / n)
    if digits:
        return [F.round(mae, 2).alias("mae"), F.round(rmse, 2).alias("rmse"), F.round(r2, 4).alias("r2"),
                F.round(w, 2).alias("wape_pct")]
    return [mae.alias("mae"), rmse.alias("rmse"), r2.alias("r2"), w.alias("wape_pct")]


def score(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = (), wape: str = "pooled",
          rounded: bool = True) -> DataFrame:
    """MAE, RMSE, R^2, WAPE % per group of `by`."""
    sums = df.groupBy(*by).agg(*error_sums(actual, predicted))
    return sums.select(*by, *from_sums(wape, rounded), F.col("_n").alias("rows"))


def score_models(predictions: DataFrame, actual: str, models: Sequence[str], by: Sequence[str] = (),
                 wape: str = "pooled", rounded: bool = True) -> DataFrame:
    """Scores of several prediction columns in one pass: unpivot to
    (model, predicted) then group by (by..., model) (A16)."""
    long = predictions.unpivot([actual, *by], list(models), "model", "_pred")
    return score(long, actual, "_pred", [*by, "model"], wape, rounded)
