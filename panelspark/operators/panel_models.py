"""Pooled panel models (M05-M09, M15-M16) on Spark.

Count models regress on log1p(lag_1), log1p(lag_12), log1p(lag_3_mean), the
month index, month-of-year effects and one effect per entity, log link:

* Poisson GLM and negative binomial (NB2, alpha fixed by the moment estimate
  clip(mean(((y - mu)^2 - y) / mu^2), .01, 5) on the Poisson fit) share one
  IRLS loop. The entity effects are never one-hot encoded: each weighted
  least-squares round absorbs them by the weighted within-transformation
  (Frisch-Waugh-Lovell). The entity effect is recovered as
  mean(z) - mean(x) . beta per entity, so each round is the exact IRLS step of
  the full dummy-variable model, but its cost and memory do not depend on the
  entity count.
* Any number of fits (yearly windows, evaluation periods) run side by side:
  rows carry the number of their fit, a round aggregates the weighted sums and
  products of all of them by (fit, entity), combined map-side, and one more
  aggregate of that small table gives every fit's 15 x 15 system. Rounds, and so
  jobs, are as many as the slowest fit needs, whatever the number of fits.
* Between rounds only the (fit, entity) effects are kept, by a reliable
  checkpoint; the rows are written once. A fit has converged when no slope
  moves by more than tol * (1 + max |slope|). A step that lowers a fit's
  likelihood or makes it infinite is halved; fitted means are never capped.

Entities whose training counts are all zero have no finite effect: they are
left out of the fit and predicted 0 (deliberate difference, documented), as
are entities never seen in training.

Trees: `RandomForestRegressor` / `GBTRegressor` on log1p(target), expm1,
clipped at 0. They are not bit-equal to other libraries' forests.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.operators.panel import FEATURES
from panelspark.session import cut_lineage

COUNT_NUMERIC = ("log_lag_1", "log_lag_12", "log_lag_3_mean", "month_index")
# Month-of-year effects; January is the reference level (entity effects
# carry the intercept).
MONTH_DUMMIES = tuple(f"moy_{m}" for m in range(2, 13))
DESIGN = (*COUNT_NUMERIC, *MONTH_DUMMIES)
HALVINGS = 20  # of one step, before a fit counts as diverging

# Tree hyper-parameters of the pooled panel models.
RF_PARAMS = dict(numTrees=160, minInstancesPerNode=2, featureSubsetStrategy="0.8", seed=42, maxDepth=30, subsamplingRate=1.0)
GBT_PARAMS = dict(maxIter=160, maxDepth=5, minInstancesPerNode=12, stepSize=0.1, seed=42)


def count_design(df: DataFrame) -> DataFrame:
    cols = {"log_lag_1": F.log1p("lag_1"), "log_lag_12": F.log1p("lag_12"), "log_lag_3_mean": F.log1p("lag_3_mean"),
            "month_index": F.col("month_index").cast("double"), "moy": F.month("month")}
    return df.withColumns(cols).withColumns(_dummies())


def _dummies() -> dict[str, Column]:
    return {f"moy_{m}": (F.col("moy") == m).cast("double") for m in range(2, 13)}


@dataclass
class GlmFit:
    """Slopes over `DESIGN` plus a table (entity, effect) of fitted entities."""
    beta: list[float]
    effects: DataFrame
    rounds: int
    converged: bool


@dataclass
class CountModels:
    poisson: GlmFit
    nb: GlmFit | None
    alpha: float
    zero_entities: DataFrame
    nb_rounds: int


def _linear(beta, cols=DESIGN) -> Column:
    return sum((F.col(c) * F.lit(float(b)) for c, b in zip(cols, beta)), F.lit(0.0))


def _with_params(df: DataFrame, **params) -> DataFrame:
    """Adds the values of the row's fit: a table of a row a fit is joined, so that the plan, and with it the compiled
    code, is the same in every round."""
    rows = [(k, *(list(map(float, v)) if isinstance(v, (list, np.ndarray)) else v for v in vs)) for k, vs in enumerate(zip(*params.values()))]
    kind = lambda v: "array<double>" if isinstance(v, (list, np.ndarray)) else "boolean" if isinstance(v, bool) else "double"
    schema = ", ".join(["fit int", *(f"{name} {kind(v[0])}" for name, v in params.items())])
    return df.join(F.broadcast(df.sparkSession.createDataFrame(rows, schema)), "fit")


def _slopes(at: str) -> Column:
    """x . beta of a row: the numerics, then the effect of its month (January is the reference level)."""
    x = " + ".join(f"{c} * {at}[{i}]" for i, c in enumerate(COUNT_NUMERIC))
    return F.expr(f"{x} + if(moy = 1, 0D, element_at({at}, moy + {len(COUNT_NUMERIC) - 1}))")


def _log_likelihood(alpha: Column) -> Column:
    """A row's log-likelihood of eta, without the terms of y alone; alpha 0 is Poisson."""
    y, eta = F.col("y"), F.col("eta")
    spread = F.log1p(alpha * F.exp(eta))
    return F.when(alpha == 0.0, y * eta - F.exp(eta)).otherwise(y * (eta - spread) - spread / alpha)


def _round_sums(rows: DataFrame) -> DataFrame:
    """rows: (fit, entity, y, *COUNT_NUMERIC, moy, eta, _alpha). By (fit, entity): the likelihood, and weighted sums of the
    design, the working response and their products. Months exclude each other, so their products are sums."""
    alpha, mu = F.col("_alpha"), F.exp("eta")
    d = rows.withColumn("_w", mu / (1.0 + alpha * mu)).withColumn("_z", F.col("eta") + (F.col("y") - mu) / mu) \
        .withColumn("_ll", _log_likelihood(alpha))
    num = list(COUNT_NUMERIC)
    wx = {**{c: f"_w * {c}" for c in num}, **{f"moy_{m}": f"if(moy = {m}, _w, 0D)" for m in range(2, 13)}}
    sums = ["sum(_ll) AS ll", "sum(_w) AS w", "sum(_w * _z) AS z"]
    for c, x in wx.items():
        sums += [f"sum({x}) AS s_{c}", f"sum({x} * _z) AS z_{c}"]
    for i, a in enumerate(num):
        sums += [f"sum({wx[b]} * {a}) AS p_{a}_{b}" for b in [*num[i:], *MONTH_DUMMIES]]
    return d.groupBy("fit", "entity").agg(*map(F.expr, sums))


def _within(t: DataFrame) -> DataFrame:
    """Every fit's likelihood and its normal equations within entities: one row a fit."""
    def product(a, b):
        return f"p_{a}_{b}" if a not in MONTH_DUMMIES else f"s_{a}" if a == b else "0D"

    cells = ["sum(ll) AS ll"]
    for i, a in enumerate(DESIGN):
        cells.append(f"sum(z_{a} - s_{a} * z / w) AS r_{a}")
        cells += [f"sum({product(a, b)} - s_{a} * s_{b} / w) AS n_{a}_{b}" for b in DESIGN[i:]]
    return t.groupBy("fit").agg(*map(F.expr, cells))


def fit_glms(rows: DataFrame, alphas: list[float], starts: list[GlmFit] | None = None, max_iter: int = 100, tol: float = 1e-8) -> list[GlmFit]:
    """Log-link count GLMs over `DESIGN` with one absorbed effect per entity, one for each value 0, 1, ... of `fit`.

    `rows` holds (fit, entity, y, *COUNT_NUMERIC, moy). alphas: a fit's 0 is Poisson, above 0 NB2. Without `starts` the
    first linear predictor is log(y + 0.1). Raises ArithmeticError when no shorter step keeps a fit's likelihood."""
    n, cols = len(alphas), list(DESIGN)
    # A fit stands at share of the way from its last accepted point (b0, e0) to the proposed one (b1, e1).
    b0 = [np.array(s.beta) if s else np.zeros(len(cols)) for s in starts or [None] * n]
    b1, share, best, rounds, done = [b.copy() for b in b0], [1.0] * n, [None] * n, [0] * n, [False] * n
    effects = None
    for i, s in enumerate(starts or []):
        e = s.effects.select(F.lit(i).alias("fit"), "entity", F.col("_effect").alias("e0"), F.col("_effect").alias("e1"))
        effects = e if effects is None else effects.unionAll(e)
    reached = F.col("e0") + F.col("_share") * (F.col("e1") - F.col("e0"))
    for _ in range(max_iter + 1):
        if effects is None:
            now = _with_params(rows, _alpha=alphas).withColumn("eta", F.log(F.col("y") + 0.1))
        else:
            at = [u + s * (v - u) for u, v, s in zip(b0, b1, share)]
            now = _with_params(rows.join(effects, ["fit", "entity"]), _alpha=alphas, _share=share, _at=at).withColumn("eta", reached + _slopes("_at"))
        table = cut_lineage(_round_sums(now))
        moves = [False] * n
        before = list(share)
        for r in _within(table).collect():  # a row a fit
            k = r["fit"]
            if done[k]:
                continue
            if not (math.isfinite(r["ll"]) and (best[k] is None or r["ll"] >= best[k] - 1e-9 * (1.0 + abs(best[k])))):
                share[k] /= 2
                if share[k] < 2.0 ** -HALVINGS:
                    raise ArithmeticError("the count model diverges")
                continue
            m = np.zeros((len(cols), len(cols)))
            for i, a in enumerate(cols):
                for j, b in enumerate(cols[i:], i):
                    m[i, j] = m[j, i] = r[f"n_{a}_{b}"]
            scale = 1.0 / np.sqrt(np.maximum(np.diag(m), 1e-300))
            new = scale * np.linalg.lstsq(m * scale[:, None] * scale[None, :], scale * np.array([r[f"r_{a}"] for a in cols]), rcond=1e-12)[0]
            now_at = b0[k] + share[k] * (b1[k] - b0[k])
            # The start from log(y + 0.1) is not a point of the model: its likelihood is no bound, and it is no slope to compare.
            best[k] = r["ll"] if effects is not None else None
            done[k] = effects is not None and float(np.max(np.abs(new - now_at))) < tol * (1.0 + float(np.max(np.abs(new))))
            b0[k], b1[k], share[k], moves[k], rounds[k] = now_at, new, 1.0, True, rounds[k] + 1
        step = F.expr("(z - (" + " + ".join(f"s_{c} * _to[{i}]" for i, c in enumerate(cols)) + ")) / w")
        if effects is None:
            effects = _with_params(table, _to=b1).select("fit", "entity", step.alias("e0"), step.alias("e1"))
        else:
            both = _with_params(table.join(effects, ["fit", "entity"]), _to=b1, _share=before, _moved=moves)
            effects = both.select("fit", "entity", F.when(F.col("_moved"), reached).otherwise(F.col("e0")).alias("e0"),
                                  F.when(F.col("_moved"), step).otherwise(F.col("e1")).alias("e1"))
        effects = cut_lineage(effects)
        if all(done):
            break
    return [GlmFit([float(b) for b in b1[k]], effects.where(F.col("fit") == k).select("entity", F.col("e1").alias("_effect")), rounds[k], done[k])
            for k in range(n)]


def fit_count_models_by(train: DataFrame, fit: str, n: int, value: str = "ev_transactions", max_iter: int = 100, nb_rounds: int = 100,
                        tol: float = 1e-8, with_nb: bool = True) -> list[CountModels]:
    """The count models of the fits 0 .. n-1 that `fit` names in each training row, all side by side: Poisson, the moment
    estimate of alpha and, `with_nb`, the negative binomial. Every fit says if it converged."""
    d = count_design(train.withColumn("fit", F.col(fit).cast("int")))
    zero = cut_lineage(d.groupBy("fit", "entity").agg(F.max(value).alias("_mx")).where(F.col("_mx") <= 0).select("fit", "entity"))
    rows = cut_lineage(d.join(zero, ["fit", "entity"], "left_anti").select(
        "fit", "entity", F.col(value).cast("double").alias("y"), *COUNT_NUMERIC, "moy"))
    pois = fit_glms(rows, [0.0] * n, None, max_iter, tol)
    effects = None
    for i, p in enumerate(pois):
        e = p.effects.select(F.lit(i).alias("fit"), "entity", "_effect")
        effects = e if effects is None else effects.unionAll(e)
    mu = F.greatest(F.exp(F.col("_effect") + _slopes("_at")), F.lit(1e-6))
    raw = _with_params(rows.join(effects, ["fit", "entity"]), _at=[p.beta for p in pois])
    raw = raw.groupBy("fit").agg(F.avg(((F.col("y") - mu) ** 2 - F.col("y")) / (mu * mu)).alias("a"))
    raw = {r["fit"]: r["a"] for r in raw.collect()}  # a row a fit
    alphas = [float(min(max(raw.get(k) if raw.get(k) is not None else 0.01, 0.01), 5.0)) for k in range(n)]
    nb = fit_glms(rows, alphas, pois, nb_rounds, tol) if with_nb else [None] * n  # starts from the Poisson fit
    return [CountModels(p, b, a, zero.where(F.col("fit") == k).select("entity"), b.rounds if b else 0)
            for k, (p, b, a) in enumerate(zip(pois, nb, alphas))]


def fit_count_models(train: DataFrame, value: str = "ev_transactions", max_iter: int = 100,
                     nb_rounds: int = 100, tol: float = 1e-8, with_nb: bool = True) -> CountModels:
    """One fit of `fit_count_models_by`."""
    return fit_count_models_by(train.withColumn("_fit", F.lit(0)), "_fit", 1, value, max_iter, nb_rounds, tol, with_nb)[0]


def predict_count(models: CountModels, df: DataFrame, which: str, out: str = "prediction") -> DataFrame:
    """Predictions >= 0 for `df` rows (keeps its columns); entities without a
    fitted effect (all-zero or unseen in training) get 0."""
    fit = models.poisson if which == "poisson_glm" else models.nb
    d = count_design(df).join(fit.effects, "entity", "left")
    eta = F.col("_effect") + _linear(fit.beta)
    pred = F.when(F.col("_effect").isNull(), F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.exp(eta)))
    return d.select(*df.columns, pred.alias(out))


ROWS_A_TASK = 50_000  # of a tree fit: each level of the trees is a job over all partitions


def fit_tree(train: DataFrame, kind: str, features=FEATURES, value: str = "ev_transactions", **overrides) -> PipelineModel:
    """Random forest or boosted trees on log1p(value). The narrow training rows are written once and read in as few
    partitions as ROWS_A_TASK allows; deep forests keep node ids with the rows, so that growing trees are not sent along."""
    asm = VectorAssembler(inputCols=list(features), outputCol="features")
    grow = dict(featuresCol="features", labelCol="_y", maxMemoryInMB=1024)
    if kind == "random_forest":
        est = RandomForestRegressor(cacheNodeIds=True, **grow, **{**RF_PARAMS, **overrides})
    elif kind == "gradient_boosting":
        est = GBTRegressor(**grow, **{**GBT_PARAMS, **overrides})
    else:
        raise KeyError(kind)
    rows = cut_lineage(train.select(*features, F.log1p(F.col(value).cast("double")).alias("_y")))
    tasks = -(-rows.count() // ROWS_A_TASK)
    return Pipeline(stages=[asm, est]).fit(rows.coalesce(max(1, min(tasks, rows.rdd.getNumPartitions()))))


def predict_tree(model: PipelineModel, df: DataFrame, out: str = "prediction") -> DataFrame:
    p = model.transform(df).withColumn(out + "_raw", F.greatest(F.lit(0.0), F.expm1("prediction")))
    return p.select(*df.columns, F.col(out + "_raw").alias(out))
