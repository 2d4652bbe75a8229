"""Files and stored tables: sample tables written where the session keeps its files and read back."""

from __future__ import annotations

import time
import uuid
from datetime import datetime, timezone

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pricewright.operators.ranked import shared_folder
from pricewright.plans import jobs
from pricewright.plans.queries_pricing import QUOTE_SQL, loaded, quote_landing
from pricewright.plans.registry import query
from pricewright.plans.sample import ORDER, read, text
from pricewright.schemas import PROMO_BASE, QUOTES
from pricewright.sources import files, sinks, tables

NOTE_SQL = "c_name || chr(10) || '\"' || c_mktsegment || '\", ' || c_nationkey AS note"
NOTES = StructType().add("c_custkey", "long").add("note", "string").add("c_acctbal", "double")


def folder(spark) -> str:
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


def notes(spark, sf_dir):
    """Cells with newlines, quotes and commas."""
    note = F.concat("c_name", F.lit('\n"'), "c_mktsegment", F.lit('", '), text("c_nationkey"))
    return read(spark, sf_dir, "customer").select("c_custkey", note.alias("note"), "c_acctbal")


@query("read_flat", f"SELECT c_custkey, {NOTE_SQL}, c_acctbal FROM customer")
def read_flat(spark, sf_dir):
    path = folder(spark)
    notes(spark, sf_dir).write.option("header", "true").option("escape", '"').csv(path)
    return files.read_flat(spark, path, NOTES).select(*NOTES.names)


@query("read_folder", f"""
SELECT c_custkey, {NOTE_SQL}, c_acctbal, 'part=' || (c_nationkey % 3) AS file FROM customer""")
def read_folder(spark, sf_dir):
    """Files of this month, told apart by their folder."""
    path = folder(spark)
    part = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), (F.col("c_nationkey") % 3).alias("part"))
    rows = notes(spark, sf_dir).join(part, F.col("c_custkey") == F.col("k")).drop("k")
    rows.write.partitionBy("part").option("header", "true").option("escape", '"').csv(path)
    back = files.read_folder(spark, path, NOTES, recursiveFileLookup="true")
    return back.select(*NOTES.names, F.regexp_extract(F.input_file_name(), r"(part=\d+)/", 1).alias("file"))


@query("read_flat_split", f"SELECT c_custkey, {NOTE_SQL}, c_acctbal FROM customer")
def read_flat_split(spark, sf_dir):
    """One file whose cells hold line ends, read by as many tasks as it has blocks."""
    path = folder(spark)
    notes(spark, sf_dir).coalesce(1).write.option("header", "true").option("escape", '"').csv(path)
    return files.read_flat(spark, path, NOTES, split=True).select(*NOTES.names)


@query("freshness_gate", f"SELECT c_custkey, {NOTE_SQL}, c_acctbal FROM customer WHERE c_nationkey % 3 = 0")
def freshness_gate(spark, sf_dir):
    """Of three files only that of this month is read; the others are as old as forty days and a year."""
    path, now = folder(spark), time.time()
    part = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), (F.col("c_nationkey") % 3).alias("part"))
    rows = notes(spark, sf_dir).join(part, F.col("c_custkey") == F.col("k")).drop("k")
    rows.write.partitionBy("part").option("header", "true").option("escape", '"').csv(path)
    age = {"part=0": 0, "part=1": 40, "part=2": 400}
    home = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = home.getFileSystem(spark._jsc.hadoopConfiguration())
    for name, days in age.items():
        for file in store.listStatus(spark._jvm.org.apache.hadoop.fs.Path(home, name)):
            store.setTimes(file.getPath(), int(1000 * (now - days * 86_400)), -1)
    today = datetime.fromtimestamp(now, timezone.utc)
    back = files.read_folder(spark, path, NOTES, level="month", now=today, recursiveFileLookup="true")
    return back.select(*NOTES.names)


@query("append_table", """
SELECT CAST(p_partkey AS VARCHAR) AS sku, p_brand AS color, p_retailprice AS socal, n AS times
FROM part, (VALUES (1), (2)) AS t(n)""")
def append_table(spark, sf_dir):
    """The same sheet appended twice, with two load times."""
    name = f"promo_{uuid.uuid4().hex}"
    blank = F.lit(None).cast("string")
    sheet = read(spark, sf_dir, "part").select(
        text("p_partkey").alias("a"), F.col("p_brand").alias("b"), *[blank.alias(f"x{i}") for i in range(4)],
        F.col("p_retailprice").alias("c"), *[blank.alias(f"y{i}") for i in range(6)],
    )
    for day in (1, 2):
        sinks.append_table(sheet, name, PROMO_BASE, F.lit(f"2025-01-0{day}").cast("timestamp"))
    rows = tables.read_table(spark, name, table=PROMO_BASE)
    return rows.select("sku", "color", "socal", F.dayofmonth("sys_dt").alias("times"))


@query("replace_table", """
SELECT c_custkey, c_acctbal + 2 AS c_acctbal FROM customer""")
def replace_table(spark, sf_dir):
    """A table replaced twice by a state computed from itself."""
    name, root = f"balances_{uuid.uuid4().hex}", folder(spark)
    sinks.replace_table(read(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), name, root)
    for _ in range(2):
        sinks.replace_table(spark.table(name).withColumn("c_acctbal", F.col("c_acctbal") + 1), name, root)
    return spark.table(name)


@query("report_extract", f"SELECT c_custkey, {NOTE_SQL}, c_acctbal FROM customer WHERE c_acctbal < 0")
def report_extract(spark, sf_dir):
    root = folder(spark)
    low = notes(spark, sf_dir).where(F.col("c_acctbal") < 0)
    written = sinks.report_extract({"low": low, "none": low.limit(0)}, root)
    return files.read_flat(spark, f"{root}/{written[0]}", NOTES).select(*NOTES.names)


@query("report_file", f"SELECT c_custkey, {NOTE_SQL}, c_acctbal FROM customer WHERE c_acctbal < 0")
def report_file(spark, sf_dir):
    """A report as one file."""
    root = folder(spark)
    low = notes(spark, sf_dir).where(F.col("c_acctbal") < 0)
    (name,) = sinks.report_extract({"low": low, "none": low.limit(0)}, root, one_file=True)
    return files.read_flat(spark, f"{root}/{name}.csv", NOTES).select(*NOTES.names)


@query("merge_partitions", f"""
WITH {QUOTE_SQL}
SELECT s.model_no, s.quote_num, s.price_model, CASE WHEN u.moved THEN b.row_stat ELSE s.row_stat END AS row_stat,
  strftime(s.l_shipdate, '%Y-%m') AS month
FROM stored s LEFT JOIN batch b USING (quote_num, model_no, price_model),
  LATERAL (SELECT b.row_stat IS DISTINCT FROM s.row_stat AND s.row_stat IS NOT NULL AS moved) u
UNION ALL
SELECT model_no, quote_num, price_model, row_stat, strftime(l_shipdate, '%Y-%m') FROM batch b
WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.quote_num = b.quote_num AND s.model_no = b.model_no
  AND s.price_model = b.price_model)""")
def merge_partitions(spark, sf_dir):
    """Quotes merged into a table parted by month, of which only the touched months are written anew."""
    name, raw = f"quotes_{uuid.uuid4().hex}", quote_landing(spark, sf_dir)
    stamp = F.lit("2025-01-01").cast("timestamp").alias(QUOTES.load_column)
    older = jobs.clean_batch(loaded(raw), QUOTES, ORDER).select(*QUOTES.input_columns, stamp)
    sinks.merge_partitions(older, older, name, QUOTES)
    merged = jobs.quote_job(raw, tables.read_table(spark, name, table=QUOTES), ORDER)
    sinks.merge_partitions(merged.table, merged.actions, name, QUOTES)
    return spark.table(name).select("model_no", "quote_num", "price_model", "row_stat", F.col(sinks.PART).alias("month"))
