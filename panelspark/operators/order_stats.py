"""Ranks, tiles and exact quantiles without funnelling a group into one task.

A plain `row_number() over (order by v)` (or `partition by g` with one hot
`g`) sends the whole (group of the) table to a single task, and exact
`percentile` keeps every distinct value of a group in one aggregation
buffer. Everything here is built on one primitive instead:

`running_total` range-partitions rows on (group, order) so a hot group is
split across many tasks, computes the running sum inside each block with a
window on (block, group), and adds the totals of earlier blocks of the same
group. The block table holds at most (#blocks + #groups) rows.

Ties are resolved by aggregating to distinct values first (counts become
the weights), which also keeps the ranked table small when values repeat.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.session import cut_lineage

_BLOCK = "_blk"


def _cols(xs: Sequence[str | Column] | str | Column | None) -> list:
    if xs is None:
        return []
    if isinstance(xs, (str, Column)):
        return [xs]
    return list(xs)


def _names(xs) -> list[str]:
    return [x for x in _cols(xs) if isinstance(x, str)]


def running_total(df: DataFrame, by: Sequence[str] | None, order: Sequence[str | Column],
                  weight: str | Column | None = None, out: str = "cum",
                  total: str | None = "total") -> DataFrame:
    """Inclusive running sum of `weight` (1 per row when None) within `by`,
    following `order`, which must be a total order inside each group.
    Adds `out` and, if named, the group total `total`."""
    by = _names(by)
    order = _cols(order)
    spark = df.sparkSession
    n_blocks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    w = F.lit(1).cast("bigint") if weight is None else (F.col(weight) if isinstance(weight, str) else weight)
    base = df.withColumn("_w", w)
    # Range partition on (group, order): contiguous slices of one group's
    # order land in consecutive blocks, so a hot group spreads over many.
    ranged = base.repartitionByRange(n_blocks, *[F.col(b) for b in by], *order).withColumn(_BLOCK, F.spark_partition_id())
    in_block = Window.partitionBy(_BLOCK, *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranged.withColumn("_local", F.sum("_w").over(in_block))
    # Materialise once so block ids are fixed for both uses below (and the
    # result survives executor loss through the shared checkpoint folder).
    local = cut_lineage(local)
    blocks = local.groupBy(*by, _BLOCK).agg(F.sum("_w").alias("_bsum"))
    earlier = Window.partitionBy(*by).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_offset", F.coalesce(F.sum("_bsum").over(earlier), F.lit(0)))
    if total:
        whole = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
        blocks = blocks.withColumn(total, F.sum("_bsum").over(whole))
    keep = [F.col(b).alias(f"_k_{b}") for b in by] + [F.col(_BLOCK).alias("_k_blk"), "_offset"] + ([total] if total else [])
    right = blocks.select(*keep)
    # null-safe on the group keys: grouping-set tables carry NULL keys
    cond = [local[b].eqNullSafe(right[f"_k_{b}"]) for b in by] + [local[_BLOCK] == right["_k_blk"]]
    joined = local.join(right, cond).drop(*[f"_k_{b}" for b in by], "_k_blk")
    return joined.withColumn(out, F.col("_offset") + F.col("_local")).drop("_w", "_local", "_offset", _BLOCK)


def value_counts(df: DataFrame, value: str, by: Sequence[str] | None = None) -> DataFrame:
    """(by..., value, n) for non-null values; partial aggregation before the shuffle."""
    by = _names(by)
    return df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))


def value_positions(df: DataFrame, value: str, by: Sequence[str] | None = None, descending: bool = False,
                    counted: bool = False) -> DataFrame:
    """Distinct values with their 1-based first/last positions in the sorted
    group: columns (by..., value, _n, _first, _last, _size). With `counted`,
    `df` already holds one row per (by, value) with its count in `_n`."""
    by = _names(by)
    counts = df if counted else value_counts(df, value, by)
    order = [F.col(value).desc()] if descending else [F.col(value).asc()]
    ranked = running_total(counts, by, order, weight="_n", out="_last", total="_size")
    return ranked.withColumn("_first", F.col("_last") - F.col("_n") + 1)


def rank_pct(df: DataFrame, value: str, out: str, by: Sequence[str] | None = None) -> DataFrame:
    """Percentile rank with average ties, rank / N (W05); NULL stays NULL and
    is not counted in N. Equals pandas `rank(pct=True)`."""
    by = _names(by)
    pos = value_positions(df, value, by).select(
        *by, value, ((F.col("_first") + F.col("_last")) / 2.0 / F.col("_size")).alias(out))
    return df.join(pos, [*by, value], "left")


def rank_pct_many(df: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    """Several `rank_pct` columns in ONE ranking pass: unpivot the inputs to
    (key, metric, value), rank within metric, pivot back on the unique `key`."""
    srcs = list(columns)
    long = df.select(key, *[F.col(c).cast("double").alias(c) for c in srcs]).unpivot(key, srcs, "_metric", "_value")
    pos = value_positions(long, "_value", ["_metric"]).select(
        "_metric", "_value", ((F.col("_first") + F.col("_last")) / 2.0 / F.col("_size")).alias("_pct"))
    ranked = long.join(pos, ["_metric", "_value"], "left")
    wide = ranked.groupBy(key).pivot("_metric", srcs).agg(F.first("_pct"))
    return df.join(wide.select(key, *[F.col(c).alias(columns[c]) for c in srcs]), key, "left")


def rank_min(df: DataFrame, value: str, out: str, by: Sequence[str] | None = None, descending: bool = True) -> DataFrame:
    """Competition rank (min of ties), descending by default."""
    by = _names(by)
    pos = value_positions(df, value, by, descending=descending).select(*by, value, F.col("_first").cast("bigint").alias(out))
    return df.join(pos, [*by, value], "left")


def row_number(df: DataFrame, order: Sequence[str | Column], out: str = "rn",
               by: Sequence[str] | None = None, total: str | None = None) -> DataFrame:
    """1-based row number over a total order (W08, W09), distributed."""
    res = running_total(df, by, order, weight=None, out=out, total=total)
    res = res.withColumn(out, F.col(out).cast("bigint"))
    return res.withColumn(total, F.col(total).cast("bigint")) if total else res


def sample_rows(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """`n` rows (U05), the same for every plan and partitioning: those first by the md5 of seed and `key`, rows of
    equal keys by their other columns."""
    ordered = df.withColumn("_md5", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))))
    return row_number(ordered, ["_md5", *df.columns], "_rn").where(F.col("_rn") <= n).select(*df.columns)


def ntile_of(rn: Column, n: Column, k: int) -> Column:
    """SQL `ntile(k)` from a 1-based row number and the row count: the first
    (n mod k) tiles hold one extra row."""
    q = F.floor(n / k)
    r = n % k
    big = r * (q + 1)
    return F.when(rn <= big, F.floor((rn - 1) / (q + 1)) + 1).otherwise(r + F.floor((rn - big - 1) / q) + 1).cast("bigint")


def quantiles(df: DataFrame, value: str, probs: dict[str, float], by: Sequence[str] | None = None,
              counted: bool = False, parts: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles with linear interpolation (same as `median` /
    `percentile` / pandas `quantile`), one row per group, NULLs ignored.
    `counted`: `df` is already (by..., value, _n). For names in `parts`,
    the two order statistics and the fraction are kept as `<name>_lo`,
    `<name>_hi`, `<name>_fr`: the same quantile of f(value) for a
    non-decreasing f is then f(lo) + (f(hi) - f(lo)) * fr, with no new pass."""
    by = _names(by)
    pos = value_positions(df, value, by, counted=counted)
    aggs = []
    for name, p in probs.items():
        h = (F.col("_size") - 1) * F.lit(float(p))
        lo = F.floor(h) + 1
        hi = F.ceil(h) + 1
        frac = h - F.floor(h)
        covers_lo = (F.col("_first") <= lo) & (lo <= F.col("_last"))
        covers_hi = (F.col("_first") <= hi) & (hi <= F.col("_last"))
        pos = pos.withColumn(f"_lo_{name}", F.when(covers_lo, F.col(value)))
        pos = pos.withColumn(f"_hi_{name}", F.when(covers_hi, F.col(value)))
        pos = pos.withColumn(f"_fr_{name}", frac)
        aggs += [F.max(f"_lo_{name}").alias(f"_lo_{name}"), F.max(f"_hi_{name}").alias(f"_hi_{name}"),
                 F.max(f"_fr_{name}").alias(f"_fr_{name}")]
    g = pos.groupBy(*by).agg(*aggs)  # NULL group keys stay their own group
    out = [*by]
    for name in probs:
        lo, hi, fr = F.col(f"_lo_{name}"), F.col(f"_hi_{name}"), F.col(f"_fr_{name}")
        out.append((lo + (hi - lo) * fr).cast("double").alias(name))
        if name in parts:
            out += [lo.cast("double").alias(f"{name}_lo"), hi.cast("double").alias(f"{name}_hi"), fr.alias(f"{name}_fr")]
    return g.select(*out)


def kth_smallest(df: DataFrame, value: str, k: Column, by: Sequence[str] | None = None, out: str = "kth") -> DataFrame:
    """k-th smallest value per group where `k` is an expression of `_size`
    (group row count), e.g. the split-conformal rank (W10)."""
    by = _names(by)
    pos = value_positions(df, value, by)
    pos = pos.withColumn("_k", k)
    hit = pos.where((F.col("_first") <= F.col("_k")) & (F.col("_k") <= F.col("_last")))
    return hit.select(*by, F.col(value).cast("double").alias(out), F.col("_size").alias("n"))


def conformal_rank(coverage: float) -> Column:
    """k = min(n, ceil((n + 1) * coverage)) in DOUBLE arithmetic."""
    n = F.col("_size").cast("double")
    return F.least(F.col("_size"), F.ceil((n + 1.0) * F.lit(float(coverage))).cast("bigint"))
