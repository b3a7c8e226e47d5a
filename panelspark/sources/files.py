"""File sources and sinks.

Outputs go under the shared folder the cluster names in
`spark.checkpoint.dir` (never a machine-local temporary folder), in a fresh
sub-folder per run.
"""

from __future__ import annotations

import json
import hashlib
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.functions import null_tokens
from panelspark.session import ensure_checkpoint_dir

HASH_CHUNK_BYTES = 8 << 20  # a file is hashed by the task that owns its path, in chunks of this size


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under the cluster's shared checkpoint root."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    root = root.rsplit("/", 1)[0]  # the session's own checkpoint folder sits one level down
    return "/".join([root, "panelspark", *parts, uuid.uuid4().hex[:12]])


def scan_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Header CSV read (S01): every column as text (no inference), PERMISSIVE,
    the reader's missing-value spellings mapped to NULL, optional column
    subset (the CSV parser only materialises selected columns)."""
    df = spark.read.option("header", True).option("inferSchema", False).option("mode", "PERMISSIVE").csv(path)
    if columns is not None:
        df = df.select(*[F.col(f"`{c}`") for c in columns])
    return df.select(*[null_tokens(F.col(f"`{c}`")).alias(c) for c in df.columns])


def raw_row_count(df: DataFrame) -> Column:
    """Unfiltered row count as a scalar subquery (S02) -- part of the audit
    plan instead of a second driver action."""
    return df.select(F.count(F.lit(1))).scalar()


def _hash_files(batches):
    from pyarrow import fs

    for pdf in batches:
        digests = []
        for path in pdf["path"]:
            scheme, _, rest = path.partition(":")
            uri = f"{scheme}:///{rest.lstrip('/')}" if scheme == "file" else path
            system, name = fs.FileSystem.from_uri(uri.replace(" ", "%20") if scheme == "file" else uri)
            h = hashlib.sha256()
            with system.open_input_stream(name, compression=None) as stream:
                while chunk := stream.read(HASH_CHUNK_BYTES):
                    h.update(chunk)
            digests.append(h.hexdigest())
        yield pdf.assign(digest=digests)[["path", "digest"]]


def fingerprint_sources(spark: SparkSession, paths: str | Sequence[str], glob: str | None = None) -> DataFrame:
    """Per file: source id, scheme, size, sha256 of its content, modification time, ingested_at (S03). Content is
    hashed for files of any size, a chunk at a time in the task that owns the path."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    meta = reader.load(paths).select("path", "length", "modificationTime")
    hashed = meta.select("path").mapInPandas(_hash_files, "path string, digest string")
    out = meta.join(hashed, "path")
    digest = F.col("digest")
    return out.select(F.col("path").alias("source_id"), F.regexp_extract("path", r"^([a-zA-Z0-9]+):", 1).alias("scheme"),
                      F.col("length").alias("size_bytes"), digest.alias("sha256"),
                      F.col("modificationTime").alias("last_modified"), F.current_timestamp().alias("ingested_at"))


def incremental_gate(fingerprints: DataFrame, manifest: DataFrame | None, product_exists: bool, force: bool = False) -> DataFrame:
    """One row: should the job run? (S04) -- forced, or a source whose hash
    is not in the manifest, or the report product is missing."""
    if manifest is None:
        changed = fingerprints.select("source_id")
    else:
        changed = fingerprints.join(manifest.select("source_id", "sha256"), ["source_id", "sha256"], "left_anti")
    n_changed = changed.select(F.count(F.lit(1))).scalar()
    run = F.lit(force) | (n_changed > 0) | F.lit(not product_exists)
    reason = (F.when(F.lit(force), "forced").when(n_changed > 0, "source_changed")
              .when(F.lit(not product_exists), "product_missing").otherwise("source_hashes_unchanged"))
    return fingerprints.sparkSession.range(1).select(run.alias("run"), reason.alias("reason"), n_changed.alias("changed_sources"))


def write_products(products: Mapping[str, DataFrame], out_dir: str, fmt: str = "parquet") -> DataFrame:
    """Write each product (S06); returns the registry (product, path, rows)
    with row counts from the written files."""
    spark = next(iter(products.values())).sparkSession
    rows = []
    for name, df in products.items():
        path = f"{out_dir.rstrip('/')}/{name}"
        df.write.mode("overwrite").format(fmt).save(path)
        rows.append((name, path))
    reg = spark.createDataFrame(rows, "product string, path string")
    counts = [spark.read.format(fmt).load(p).select(F.lit(n).alias("product"), F.count(F.lit(1)).alias("rows")) for n, p in rows]
    allc = counts[0]
    for c in counts[1:]:
        allc = allc.unionByName(c)
    return reg.join(allc, "product")


def write_snapshot(products: Mapping[str, DataFrame], root: str, version: str, *, has_stations: bool = False,
                   last_updated: str | None = None) -> DataFrame:
    """Write products into `snapshot=<version>` partitions (S07): a dynamic
    partition overwrite replaces only that snapshot, so writing the same
    version again is idempotent. `current` is the newest version in the
    registry, not a copy. The registry also records whether the snapshot has
    stations and when their source was last updated."""
    spark = next(iter(products.values())).sparkSession
    for name, df in products.items():
        out = df.withColumn("snapshot", F.lit(version)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        out.partitionBy("snapshot").parquet(f"{root}/{name}")
    reg = spark.createDataFrame([(version, sorted(products), has_stations, last_updated)],
                                "version string, products array<string>, has_stations boolean, last_updated string")
    reg.withColumn("written_at", F.current_timestamp()).write.mode("append").parquet(f"{root}/_registry")
    return spark.read.parquet(f"{root}/_registry")


def read_snapshot(spark: SparkSession, root: str, product: str, version: str) -> DataFrame:
    """Partition-pruned read of one snapshot."""
    return spark.read.parquet(f"{root}/{product}").where(F.col("snapshot") == version).drop("snapshot")


def source_version(parts: Mapping[str, DataFrame], totals: Mapping[str, Column], statuses: Mapping[str, str]) -> DataFrame:
    """First 16 hex of sha256 over the statuses, row counts and totals (S08),
    all computed as one row of scalar subqueries."""
    spark = next(iter(parts.values())).sparkSession
    cols = [F.lit(json.dumps(statuses, sort_keys=True)).alias("statuses")]
    cols += [df.select(F.count(F.lit(1))).scalar().alias(f"rows_{n}") for n, df in parts.items()]
    cols += [c.alias(f"total_{n}") for n, c in totals.items()]
    row = spark.range(1).select(*cols)
    ident = F.to_json(F.struct(*[F.col(c) for c in row.columns]))
    return row.withColumn("source_version", F.substring(F.sha2(ident, 256), 1, 16))


def publish_if_changed(published: DataFrame | None, version: DataFrame, force: bool = False) -> DataFrame:
    """Rows of `version` not yet published (S09): a left anti join on the
    version key; empty = skip (unless forced)."""
    if published is None or force:
        return version
    return version.join(published.select("source_version"), "source_version", "left_anti")


def export_json_records(df: DataFrame) -> DataFrame:
    """One JSON text per row with NULLs kept."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"}).alias("record"))


def feature_json(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys plus the non-key columns packed as sorted-key JSON."""
    rest = sorted(c for c in df.columns if c not in keys)
    return df.select(*keys, F.to_json(F.struct(*[F.col(c) for c in rest]), {"ignoreNullFields": "false"}).alias("feature_json"))


def last_good_snapshot(registry: DataFrame, current_version: str | None = None) -> DataFrame:
    """Newest readable snapshot that has stations and a last-updated value,
    the current one first, marked `stale` (S10)."""
    ok = registry.where(F.col("has_stations") & F.col("last_updated").isNotNull())
    ranked = ok.withColumn("_cur", F.col("version") == F.lit(current_version))
    best = ranked.orderBy(F.desc("_cur"), F.desc("written_at"), F.asc("version")).limit(1)
    return best.drop("_cur").withColumn("status", F.lit("stale"))


def products_available(spark: SparkSession, root: str, names: Sequence[str]) -> DataFrame:
    """(ready, missing) over the product folders present under `root`.
    The listing is of product folders (bounded by the product count)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(root)
    fs = p.getFileSystem(conf)
    present = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    want = spark.createDataFrame([(n,) for n in names], "product string")
    have = spark.createDataFrame([(n,) for n in present] or [("",)], "product string")
    missing = want.join(have, "product", "left_anti")
    return spark.range(1).select((missing.select(F.count(F.lit(1))).scalar() == 0).alias("ready"),
                                 missing.select(F.sort_array(F.collect_list("product"))).scalar().alias("missing"))
