"""Entity segmentation.

Features per entity: log1p(stock), observed low-range share, log1p(recent
12-month flow), standardised; K-Means (k=3) keeps the lowest-cost of 20
seeded fits; clusters are named by ascending median stock.

Silhouette: Spark's evaluator offers squared-Euclidean (and cosine)
distances, computed from per-cluster sufficient statistics in one pass; an
exact Euclidean silhouette needs all point pairs, which this library does
not form. The column is named for the distance it uses.
"""

from __future__ import annotations

import json
from functools import partial

from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelspark.functions import clip
from panelspark.operators.order_stats import quantiles
from panelspark.session import cut_lineage, side_by_side

# Segment names from the smallest to the largest median stock.
SEGMENT_NAMES = ("Emerging", "Growth", "Established")
SEGMENT_FEATURES = ("log_total_evs", "observed_low_range_share", "log_ev_transactions_12m")


def segment_features(stock: DataFrame, low_share: DataFrame, flow: DataFrame, threshold: float) -> DataFrame:
    """C09 inputs: stock + low-range share + last/previous 12 months of flow
    (A08, J02) + clipped growth (r+1)/(p+1)-1 in [-1, 5]."""
    latest = flow.select(F.max("month")).scalar()
    recent = F.col("month") > F.add_months(latest, -12)
    prior = (F.col("month") <= F.add_months(latest, -12)) & (F.col("month") > F.add_months(latest, -24))
    windows = flow.groupBy("entity").agg(
        F.sum(F.when(recent, F.col("ev_transactions")).otherwise(0.0)).alias("ev_transactions_12m"),
        F.sum(F.when(prior, F.col("ev_transactions")).otherwise(0.0)).alias("ev_transactions_prior_12m"))
    out = stock.join(low_share, "entity", "left").join(windows, "entity", "left")
    out = out.fillna(0.0, subset=["observed_low_range_share", "ev_transactions_12m", "ev_transactions_prior_12m"])
    growth = (F.col("ev_transactions_12m") + 1) / (F.col("ev_transactions_prior_12m") + 1) - 1
    return out.withColumn("transaction_growth", clip(growth, -1.0, 5.0)).withColumn("range_threshold_miles", F.lit(threshold))


def _scaled(df: DataFrame) -> DataFrame:
    d = df.withColumns({"log_total_evs": F.log1p("total_evs"), "log_ev_transactions_12m": F.log1p("ev_transactions_12m")})
    d = VectorAssembler(inputCols=list(SEGMENT_FEATURES), outputCol="_raw").transform(d)
    return StandardScaler(inputCol="_raw", outputCol="features", withMean=True, withStd=True).fit(d).transform(d)


def kmeans_best(scaled: DataFrame, k: int, n_init: int = 20, seed: int = 42):
    """Lowest-cost of `n_init` seeded K-Means fits (M10), the earliest of equals; the fits run side by side."""
    def fit(i):
        return KMeans(k=k, seed=seed + i, featuresCol="features", predictionCol="cluster", maxIter=300, tol=1e-6).fit(scaled)

    fits = side_by_side(scaled.sparkSession, [partial(fit, i) for i in range(n_init)])
    return min(fits, key=lambda model: model.summary.trainingCost)


def silhouette(clustered: DataFrame) -> float:
    """Mean silhouette with squared-Euclidean distance."""
    return ClusteringEvaluator(featuresCol="features", predictionCol="cluster", metricName="silhouette",
                               distanceMeasure="squaredEuclidean").evaluate(clustered)


def assign_segments(features: DataFrame, k: int = 3, n_init: int = 20) -> tuple[DataFrame, float]:
    """K-Means labels and segment names by ascending median stock."""
    scaled = cut_lineage(_scaled(features))
    model = kmeans_best(scaled, k, n_init)
    clustered = cut_lineage(model.transform(scaled))
    sil = silhouette(clustered)
    med = quantiles(clustered, "total_evs", {"median_stock": 0.5}, by=["cluster"])
    # k rows: an unpartitioned window over the k cluster medians is bounded by k
    order = med.withColumn("_rank", F.row_number().over(Window.orderBy("median_stock", "cluster")))
    names = F.element_at(F.array(*[F.lit(n) for n in SEGMENT_NAMES]), F.col("_rank")) if k == 3 else F.col("_rank").cast("string")
    named = clustered.join(order.select("cluster", names.alias("market_segment")), "cluster", "left")
    return named.drop("features", "_raw", "log_total_evs", "log_ev_transactions_12m"), sil


def cluster_sensitivity(features: DataFrame, ks=range(2, 9), n_init: int = 20) -> DataFrame:
    """Silhouette and cluster sizes for each k (M12); one small row per k."""
    scaled = cut_lineage(_scaled(features))
    rows = []
    for k in ks:
        clustered = kmeans_best(scaled, k, n_init).transform(scaled)
        sizes = [r[1] for r in clustered.groupBy("cluster").count().orderBy("cluster").collect()]  # k numbers
        rows.append((k, round(silhouette(clustered), 3), json.dumps(sizes), min(sizes), max(sizes)))
    return features.sparkSession.createDataFrame(
        rows, "k int, silhouette_sq_euclidean double, cluster_sizes string, smallest_cluster bigint, largest_cluster bigint")


def threshold_shares(histogram: DataFrame, threshold: float) -> DataFrame:
    """Low-range share per entity for any threshold from the (entity, range)
    histogram (C11, J11)."""
    return histogram.groupBy("entity").agg(
        (F.sum(F.when(F.col("electric_range") < threshold, F.col("vehicles")).otherwise(0)) / F.sum("vehicles"))
        .alias("observed_low_range_share"))


def segment_profile(segments: DataFrame) -> DataFrame:
    """Per segment: entities, stock, 12-month flow, median low share."""
    base = segments.groupBy("market_segment").agg(
        F.count(F.lit(1)).alias("entities"), F.sum("total_evs").alias("total_evs"),
        F.sum("ev_transactions_12m").alias("ev_transactions_12m"))
    med = quantiles(segments, "observed_low_range_share", {"median_low_range_share": 0.5}, by=["market_segment"])
    return base.join(med, "market_segment", "left")
