"""Logical tables bound onto the driver's parquet tables.

Each binding exists twice: as a DataFrame plan (what the library runs) and as
SQL text (the independent DuckDB oracle). They must describe the same rows.

| logical table     | parquet tables                                   |
|-------------------|--------------------------------------------------|
| registrations     | orders, customer, nation                         |
| population        | lineitem, orders, customer, nation, part         |
| charging_units    | lineitem, supplier, nation                       |
| zip_rows          | lineitem, orders, customer, nation               |
| live_registrations| lineitem, orders, customer, nation               |
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Fixed values of the binding: which order priority plays the "Electric"
# fuel, and which return flags stand for battery vs plug-in hybrid vehicles.
ELECTRIC_FUEL = "1-URGENT"
BEV_TYPE = "Battery Electric Vehicle (BEV)"
PHEV_TYPE = "Plug-in Hybrid Electric Vehicle (PHEV)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The allowed entity dimension (plays the list of valid counties)."""
    return table(spark, sf_dir, "nation").select(F.col("n_name").alias("entity"))


def _customer_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select("c_custkey", "n_name")


def _order_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, n_name): joined before lineitem, so that its rows are not exchanged by customer."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    ce = _customer_entity(spark, sf_dir)
    return orders.join(ce, F.col("o_custkey") == ce.c_custkey).select("o_orderkey", "n_name")


def registrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transaction log: (txn_date, entity, fuel, cnt)."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderpriority")
    ce = _customer_entity(spark, sf_dir)
    return orders.join(ce, orders.o_custkey == ce.c_custkey).select(
        F.col("o_orderdate").alias("txn_date"),
        F.col("n_name").alias("entity"),
        F.col("o_orderpriority").alias("fuel"),
        F.lit(1).cast("bigint").alias("cnt"),
    )


def population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicle stock snapshot, one row per registration record."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    oe = _order_entity(spark, sf_dir)
    j = li.join(oe, li.l_orderkey == oe.o_orderkey).join(part, li.l_partkey == part.p_partkey)
    return j.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("bigint").alias("vehicle_id"),
        F.col("n_name").alias("entity"),
        F.col("p_brand").alias("make"),
        F.col("p_type").alias("model"),
        F.year("l_shipdate").cast("bigint").alias("model_year"),
        F.when(F.col("l_linestatus") == "F", F.col("l_quantity")).otherwise(F.lit(0.0)).alias("rng"),
        F.when(F.col("l_returnflag") == "A", F.lit(PHEV_TYPE)).otherwise(F.lit(BEV_TYPE)).alias("ev_type"),
        F.concat(F.lit("POINT (-"), (100 + F.col("l_suppkey") % 25).cast("string"), F.lit("."),
                 F.lpad((F.col("l_partkey") % 100).cast("string"), 2, "0"), F.lit(" "),
                 (40 + F.col("l_linenumber")).cast("string"), F.lit(".5)")).alias("location"),
        "l_partkey", "l_suppkey", "l_extendedprice", "l_discount", "l_tax",
    )


def charging_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per charging unit; the station is the supplier."""
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_orderkey")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = li.join(supplier, li.l_suppkey == supplier.s_suppkey).join(nation, F.col("s_nationkey") == nation.n_nationkey)
    return j.select(
        F.col("l_suppkey").cast("string").alias("station_id"),
        F.col("s_name").alias("station_name"),
        (F.lit(98000) + F.col("l_suppkey")).cast("string").alias("zip_text"),
        (F.lit(45.0) + F.col("s_nationkey") / 10.0).alias("latitude"),
        (F.lit(-120.0) - F.col("s_nationkey") / 10.0).alias("longitude"),
        F.concat(F.lit("NET_"), (F.col("s_nationkey") % 3).cast("string")).alias("network"),
        F.when(F.col("l_linenumber") >= 6, 1).otherwise(0).cast("bigint").alias("ccs_count"),
        F.when(F.col("l_discount") >= 0.09, 1).otherwise(0).cast("bigint").alias("chademo_count"),
        (F.col("l_linenumber") % 2).cast("bigint").alias("j3400_count"),
        F.col("l_quantity").alias("j3400_kw"),
        F.when(F.col("l_orderkey") % 7 == 0, 1).otherwise(0).cast("bigint").alias("j3271_count"),
        (F.col("l_quantity") * 2).alias("j3271_kw"),
        F.col("n_name").alias("entity"),
        "l_orderkey", "l_linenumber",
    )


def zip_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Record counts per (zip, entity): the landed ZIP lookup aggregate."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    oe = _order_entity(spark, sf_dir)
    j = li.join(oe, li.l_orderkey == oe.o_orderkey)
    return (j.groupBy((F.lit(98000) + F.col("l_suppkey")).cast("string").alias("zip_text"), F.col("n_name").alias("entity"))
            .agg(F.count(F.lit(1)).alias("records")))


def live_registrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-record monthly feed: (entity, txn_month, fuel, cnt)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate", "l_linestatus", "l_quantity")
    oe = _order_entity(spark, sf_dir)
    j = li.join(oe, li.l_orderkey == oe.o_orderkey)
    return j.select(
        F.col("n_name").alias("entity"),
        F.trunc(F.col("l_shipdate").cast("date"), "MM").alias("txn_month"),
        F.when(F.col("l_linestatus") == "F", F.lit("Electric")).otherwise(F.lit("Other")).alias("fuel"),
        F.col("l_quantity").alias("cnt"),
    )


# --- the same bindings as SQL (DuckDB oracle) ---------------------------------

SQL = {
    "registrations": f"""
        SELECT o_orderdate AS txn_date, n_name AS entity, o_orderpriority AS fuel, CAST(1 AS BIGINT) AS cnt
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "population": f"""
        SELECT CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS vehicle_id, n_name AS entity,
               p_brand AS make, p_type AS model, CAST(year(l_shipdate) AS BIGINT) AS model_year,
               CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0.0 END AS rng,
               CASE WHEN l_returnflag = 'A' THEN '{PHEV_TYPE}' ELSE '{BEV_TYPE}' END AS ev_type,
               'POINT (-' || CAST(100 + l_suppkey % 25 AS VARCHAR) || '.' || lpad(CAST(l_partkey % 100 AS VARCHAR), 2, '0')
                 || ' ' || CAST(40 + l_linenumber AS VARCHAR) || '.5)' AS location,
               l_partkey, l_suppkey, l_extendedprice, l_discount, l_tax
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
             JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey""",
    "charging_units": """
        SELECT CAST(l_suppkey AS VARCHAR) AS station_id, s_name AS station_name,
               CAST(98000 + l_suppkey AS VARCHAR) AS zip_text,
               45.0 + s_nationkey / 10.0 AS latitude, -120.0 - s_nationkey / 10.0 AS longitude,
               'NET_' || CAST(s_nationkey % 3 AS VARCHAR) AS network,
               CAST(CASE WHEN l_linenumber >= 6 THEN 1 ELSE 0 END AS BIGINT) AS ccs_count,
               CAST(CASE WHEN l_discount >= 0.09 THEN 1 ELSE 0 END AS BIGINT) AS chademo_count,
               CAST(l_linenumber % 2 AS BIGINT) AS j3400_count, l_quantity AS j3400_kw,
               CAST(CASE WHEN l_orderkey % 7 = 0 THEN 1 ELSE 0 END AS BIGINT) AS j3271_count,
               l_quantity * 2 AS j3271_kw, n_name AS entity, l_orderkey, l_linenumber
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey""",
    "zip_rows": """
        SELECT CAST(98000 + l_suppkey AS VARCHAR) AS zip_text, n_name AS entity, count(*) AS records
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
             JOIN nation ON c_nationkey = n_nationkey
        GROUP BY 1, 2""",
    "live_registrations": """
        SELECT n_name AS entity, CAST(date_trunc('month', l_shipdate) AS DATE) AS txn_month,
               CASE WHEN l_linestatus = 'F' THEN 'Electric' ELSE 'Other' END AS fuel, l_quantity AS cnt
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
             JOIN nation ON c_nationkey = n_nationkey""",
}


def with_bindings(sql: str, *names: str) -> str:
    """Prefix an oracle query with the binding CTEs it names (in order)."""
    ctes = ",\n".join(f"{n} AS ({SQL[n]})" for n in names)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
