"""Reconciliation of the sample tables with an earlier state of themselves."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricewright.operators import dedup, reconcile
from pricewright.plans.registry import query
from pricewright.plans.sample import read
from pricewright.sources import tables
from pricewright.sources.tables import distinct_columns

LOADED = "1998-07-01"
KEYS = ["l_partkey", "l_suppkey"]
ORDER = ["l_shipdate", "l_linenumber", "l_extendedprice", "l_orderkey"]

QUOTES_SQL = f"""quotes AS (
  SELECT *, CASE WHEN l_discount <> 0 THEN l_extendedprice / l_quantity END AS price,
    nullif(l_returnflag, 'N') AS status FROM lineitem),
stored AS (SELECT * FROM quotes WHERE l_shipdate < TIMESTAMP '{LOADED}'),
batch AS (SELECT * FROM quotes QUALIFY row_number() OVER (PARTITION BY l_partkey, l_suppkey
  ORDER BY l_shipdate DESC, l_linenumber DESC, l_extendedprice DESC, l_orderkey DESC) = 1)"""


def quotes(spark, sf_dir):
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    return read(spark, sf_dir, "lineitem").select(
        "*",
        F.when(F.col("l_discount") != 0, unit).alias("price"),
        F.nullif("l_returnflag", F.lit("N")).alias("status"),
    )


def stored(df):
    return df.where(F.col("l_shipdate") < F.lit(LOADED).cast("timestamp_ntz"))


def batch(df):
    return dedup.keep_last(df, KEYS, ORDER)


NEW_SQL = f"""
WITH {QUOTES_SQL}
SELECT l_partkey, l_suppkey, price, status FROM batch b
WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.l_partkey = b.l_partkey AND s.l_suppkey = b.l_suppkey)"""


@query("new_rows_probed", NEW_SQL)
def new_rows_probed(spark, sf_dir):
    """By way of the Bloom filter, as for a batch that is too large to broadcast."""
    df = quotes(spark, sf_dir)
    return reconcile.new_rows_only(batch(df), stored(df), KEYS, nullable=[], probe=True).select(*KEYS, "price", "status")


@query("new_rows_only", NEW_SQL)
def new_rows_only(spark, sf_dir):
    df = quotes(spark, sf_dir)
    return reconcile.new_rows_only(batch(df), stored(df), KEYS, nullable=[]).select(*KEYS, "price", "status")


@query("new_rows_only_null_keys", f"""
WITH {QUOTES_SQL}, b AS (SELECT DISTINCT status, l_partkey, l_suppkey FROM quotes),
s AS (SELECT DISTINCT status, l_partkey, l_suppkey FROM stored)
SELECT * FROM b EXCEPT SELECT * FROM s""")
def new_rows_only_null_keys(spark, sf_dir):
    df = quotes(spark, sf_dir)
    keys = ["status", "l_partkey", "l_suppkey"]
    return reconcile.new_rows_only(distinct_columns(df, keys), stored(df), keys, nullable=["status"])


@query("skip_loaded_batch", f"""
SELECT 'fresh' AS outcome, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS batch_dt
FROM orders WHERE o_orderdate >= TIMESTAMP '{LOADED}'""")
def skip_loaded_batch(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("batch_dt"))
    day = F.lit(LOADED).cast("date")
    before, after = orders.where(F.col("batch_dt") < day), orders.where(F.col("batch_dt") >= day)
    fresh = reconcile.skip_loaded_batch(after, before, "batch_dt").withColumn("outcome", F.lit("fresh"))
    seen = reconcile.skip_loaded_batch(orders, before, "batch_dt").withColumn("outcome", F.lit("seen"))
    return reconcile.union_all(fresh, seen).select(
        "outcome", "o_orderkey", F.col("batch_dt").cast("string").alias("batch_dt")
    )


def _split_sql(value, guard):
    return f"""
WITH {QUOTES_SQL}
SELECT l_partkey, l_suppkey, {value}, CASE
  WHEN NOT EXISTS (SELECT 1 FROM stored s WHERE s.l_partkey = b.l_partkey AND s.l_suppkey = b.l_suppkey) THEN 'insert'
  WHEN EXISTS (SELECT 1 FROM stored s WHERE s.l_partkey = b.l_partkey AND s.l_suppkey = b.l_suppkey
    AND s.{value} IS DISTINCT FROM b.{value} AND {guard}.{value} IS NOT NULL) THEN 'update'
  ELSE 'unchanged' END AS action
FROM batch b"""


@query("upsert_split_source_guard", _split_sql("price", "b"))
def upsert_split_source_guard(spark, sf_dir):
    df = quotes(spark, sf_dir)
    out = reconcile.upsert_split(batch(df), stored(df), KEYS, "price", "source", nullable=[])
    return out.select(*KEYS, "price", "action")


@query("upsert_split_target_guard", _split_sql("status", "s"))
def upsert_split_target_guard(spark, sf_dir):
    df = quotes(spark, sf_dir)
    out = reconcile.upsert_split(batch(df), stored(df), KEYS, "status", "target", nullable=[])
    return out.select(*KEYS, "status", "action")


MERGE_SQL = f"""
WITH {QUOTES_SQL},
old AS (SELECT * FROM stored QUALIFY row_number() OVER (PARTITION BY l_partkey, l_suppkey
  ORDER BY l_shipdate DESC, l_linenumber DESC, l_extendedprice DESC, l_orderkey DESC) = 1),
joined AS (
  SELECT coalesce(o.l_partkey, b.l_partkey) AS l_partkey, coalesce(o.l_suppkey, b.l_suppkey) AS l_suppkey,
    o.l_partkey IS NULL AS fresh,
    o.l_partkey IS NOT NULL AND b.price IS NOT NULL AND b.price IS DISTINCT FROM o.price AS moved,
    o.price AS old_price, b.price AS new_price, o.l_linestatus AS old_line, b.l_linestatus AS new_line
  FROM old o FULL JOIN batch b ON o.l_partkey = b.l_partkey AND o.l_suppkey = b.l_suppkey)
SELECT l_partkey, l_suppkey, CASE WHEN fresh OR moved THEN new_price ELSE old_price END AS price,
  CASE WHEN fresh THEN new_line ELSE old_line END AS l_linestatus,
  CASE WHEN fresh OR moved THEN '2025-01-02' ELSE '2025-01-01' END AS load_dt
FROM joined"""


def _merged(spark, sf_dir, probe):
    df = quotes(spark, sf_dir)
    columns = [*KEYS, "price", "l_linestatus"]
    table = batch(stored(df)).select(*columns).withColumn("load_dt", F.lit("2025-01-01"))
    actions = reconcile.upsert_split(batch(df).select(*columns), table, KEYS, "price", "source", nullable=[], probe=probe)
    return reconcile.merge_tables(table, actions, KEYS, ["price"], "load_dt", F.lit("2025-01-02"), probe=probe)


@query("merge_tables", MERGE_SQL)
def merge_tables(spark, sf_dir):
    return _merged(spark, sf_dir, None)


@query("merge_tables_probed", MERGE_SQL)
def merge_tables_probed(spark, sf_dir):
    """By way of the Bloom filter; rows that the batch cannot hold pass without an exchange."""
    return _merged(spark, sf_dir, True)


@query("read_table", "SELECT DISTINCT l_partkey, l_suppkey, l_returnflag FROM lineitem")
def read_table(spark, sf_dir):
    read(spark, sf_dir, "lineitem").createOrReplaceTempView("stored_lines")
    return tables.read_table(spark, "stored_lines", ["l_partkey", "l_suppkey", "l_returnflag"], distinct=True)


@query("union_all", """
SELECT c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_name, s_acctbal, NULL FROM supplier""")
def union_all(spark, sf_dir):
    customers = read(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = read(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name")
    )
    return reconcile.union_all(customers, suppliers)


@query("is_member", """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""")
def is_member(spark, sf_dir):
    members = read(spark, sf_dir, "customer").where(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("o_custkey"))
    return reconcile.is_member(read(spark, sf_dir, "orders"), members, "o_custkey").select("o_orderkey", "o_custkey")
