"""Cleaning rules, row hygiene and de-duplication over the sample tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from pricewright.functions import cleaning as c
from pricewright.functions.text import exact_tenth_text, float_text
from pricewright.operators import dedup, hygiene
from pricewright.plans.registry import query
from pricewright.plans.sample import NBSP, file_order, read, text


@query("clean_customer", """
SELECT c_custkey,
  CASE c_mktsegment WHEN 'BUILDING' THEN '' WHEN 'MACHINERY' THEN 'Parent ' || c_name ELSE c_name END AS customer
FROM customer""")
def clean_customer(spark, sf_dir):
    raw = read(spark, sf_dir, "customer").withColumn(
        "customer",
        F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("CUST"), text("c_custkey")))
        .when(F.col("c_mktsegment") == "MACHINERY", F.concat(F.lit("CUST Parent "), "c_name"))
        .otherwise(F.concat(F.lit("CUST"), text("c_custkey"), F.lit(" Parent : "), "c_name")),
    )
    return raw.select("c_custkey", c.customer_name(F.col("customer")).alias("customer"))


STATE_TEXT = {0: "Florida", 1: "Utah", 2: "N.Y. upstate", 3: "California", 4: "Fl coast"}


@query("clean_state", """
SELECT c_custkey,
  CASE n_regionkey WHEN 0 THEN 'FL' WHEN 1 THEN 'UT' WHEN 2 THEN 'N.Y. UPSTATE' WHEN 3 THEN 'CALIFORNIA'
    ELSE 'FL COAST' END AS landing_state,
  CASE n_regionkey WHEN 0 THEN 'FL' WHEN 1 THEN 'UT' WHEN 2 THEN 'NY' WHEN 3 THEN 'CA' ELSE 'FL' END AS sales_state
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def clean_state(spark, sf_dir):
    joined = read(spark, sf_dir, "customer").join(
        read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    raw = F.element_at(F.array(*[F.lit(v) for v in STATE_TEXT.values()]), F.col("n_regionkey") + 1)
    return joined.select(
        "c_custkey",
        c.state_code(raw).alias("landing_state"),
        c.state_code(c.state_prefix(raw)).alias("sales_state"),
    )


@query("clean_key_text", """
SELECT p_partkey, replace(p_name, ' ', '') || ' ' || p_brand AS key_text,
  CASE WHEN p_type = 'PROMO' THEN 'R-' || p_size || ': new' ELSE p_brand END AS comp_sku
FROM part""")
def clean_key_text(spark, sf_dir):
    noisy = F.concat(
        F.lit(f" {NBSP}\t"), F.replace("p_name", F.lit(" "), F.lit("\u200b")), F.lit(" \ufeff"), "p_brand", F.lit("\n ")
    )
    sku = F.when(
        F.col("p_type") == "PROMO", F.concat(F.lit("Rival:  R-"), text("p_size"), F.lit(": new"))
    ).otherwise(F.col("p_brand"))
    return read(spark, sf_dir, "part").select(
        "p_partkey", c.clean_key(noisy).alias("key_text"), c.after_colon(sku).alias("comp_sku")
    )


@query("clean_labels", """
SELECT p_partkey,
  upper(p_name[1]) || lower(p_name[2:]) AS mnf,
  CASE WHEN p_type = 'PROMO' THEN 'combo ' || p_brand ELSE 'Single ' || p_brand END AS sku,
  list_aggregate(list_transform(string_split(lower(p_name || '-' || p_type), ' '),
    lambda w: upper(w[1]) || w[2:]), 'string_agg', ' ') AS distr,
  CASE WHEN p_type = 'SMALL' THEN 'Discontinued' ELSE p_type END AS category,
  CASE WHEN p_type = 'LARGE' THEN 'Discontinued' ELSE p_type END AS promo_reason
FROM part""")
def clean_labels(spark, sf_dir):
    raw = read(spark, sf_dir, "part").select(
        "p_partkey",
        F.upper("p_name").alias("mnf"),
        F.concat(F.when(F.col("p_type") == "PROMO", "Combo ").otherwise("Single "), "p_brand").alias("sku"),
        F.upper(F.concat("p_name", F.lit("-"), "p_type")).alias("distr"),
        F.when(F.col("p_type") == "SMALL", "Discontinued item").otherwise(F.col("p_type")).alias("category"),
        F.when(F.col("p_type") == "LARGE", "Disontinued").otherwise(F.col("p_type")).alias("promo_reason"),
    )
    return c.apply_rules(raw, [("sku", c.combo_sku), *c.COLUMN_RULES])


# Every raw category, one without a group and a blank one, dealt over the parts.
RAW_CATEGORIES = [name for names in c.CATEGORY_GROUPS.values() for name in names] + ["Unlisted", None]


def _rollup_sql():
    cases = []
    for i, name in enumerate(RAW_CATEGORIES):
        group = next((g for g, names in c.CATEGORY_GROUPS.items() if name in names), "Other")
        cases.append(f"WHEN {i} THEN '{group}'")
    return " ".join(cases)


@query("category_rollup", f"""
SELECT p_partkey, CASE p_partkey % {len(RAW_CATEGORIES)} {_rollup_sql()} END AS sku_cat FROM part""")
def category_rollup(spark, sf_dir):
    raw = F.element_at(F.array(*[F.lit(x) for x in RAW_CATEGORIES]), (F.col("p_partkey") % len(RAW_CATEGORIES)).cast("int") + 1)
    return read(spark, sf_dir, "part").select("p_partkey", c.category_rollup(raw).alias("sku_cat"))


# Layouts by order, as pattern of the date. None: no date. The last two have the day first.
LAYOUTS = [
    "yyyy-MM-dd HH:mm:ss", "M/d/yyyy", "MMM d, yyyy", "yyyyMMdd", "d-MMM-yyyy", "MMM d yyyy", "d MMMM yyyy",
    "MMMM d, yyyy", "yyyy.MM.dd", "yyyy/M/d", "MM-dd-yyyy", None, "dd/MM/yyyy", "d.M.yyyy",
]


@query("parse_dates", f"""
SELECT o_orderkey, CASE WHEN o_orderkey % {len(LAYOUTS)} = 11 THEN NULL
  WHEN o_orderkey % {len(LAYOUTS)} >= 12 AND day(o_orderdate) <= 12
    THEN strftime(make_date(year(o_orderdate), day(o_orderdate), month(o_orderdate)), '%Y-%m-%d')
  ELSE strftime(o_orderdate, '%Y-%m-%d') END AS quote_dt
FROM orders""")
def parse_dates(spark, sf_dir):
    d, place = F.col("o_orderdate"), F.col("o_orderkey") % len(LAYOUTS)
    raw = F.lit("to be confirmed")
    for i, layout in enumerate(LAYOUTS):
        if layout:
            raw = F.when(place == i, F.date_format(d, layout)).otherwise(raw)
    return read(spark, sf_dir, "orders").select(
        "o_orderkey", c.to_date_lenient(raw).cast("string").alias("quote_dt")
    )


@query("percent_text", """
SELECT l_orderkey, l_linenumber, l_partkey, printf('%.1f', (l_orderkey % 2000) / 40.0 * 1::DOUBLE) || '%' AS share,
  printf('%.1f', l_discount * l_tax * 1000) || '%' AS product FROM lineitem""")
def percent_text(spark, sf_dir):
    """Every fortieth up to 50: ties that are exact, and ties in text only."""
    show = lambda x: F.concat(exact_tenth_text(x), F.lit("%"))
    product = F.col("l_discount") * F.col("l_tax") * 1000
    return read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        show((F.col("l_orderkey") % 2000) / F.lit(40.0)).alias("share"), show(product).alias("product"),
    )


@query("number_text", """
SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_discount / 1000 AS VARCHAR) AS small,
  CAST(l_extendedprice AS VARCHAR) AS plain, CAST(-l_tax AS VARCHAR) AS negative FROM lineitem""")
def number_text(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", float_text(F.col("l_discount") / 1000).alias("small"),
        float_text(F.col("l_extendedprice")).alias("plain"), float_text(-F.col("l_tax")).alias("negative"),
    )


@query("parse_erp_ts", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') || ' 03:05:00' AS as_stored,
  strftime(o_orderdate, '%Y-%m-%d') || CASE WHEN o_orderstatus = 'O' THEN ' 15:05:00' ELSE ' 03:05:00' END AS as_clock
FROM orders""")
def parse_erp_ts(spark, sf_dir):
    raw = F.concat(
        F.date_format("o_orderdate", "M/d/yyyy"), F.lit(" 3:05"), F.when(F.col("o_orderstatus") == "O", " pm").otherwise(" am")
    )
    shown = lambda ts: F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
    return read(spark, sf_dir, "orders").select(
        "o_orderkey",
        shown(c.parse_erp_ts(raw)).alias("as_stored"),
        shown(c.parse_erp_ts(raw, meridiem=True)).alias("as_clock"),
    )


@query("round_quantity", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CAST(round_even(nullif(l_quantity, 7) / 2, 0) AS BIGINT) AS quantity, abs(coalesce(nullif(-l_discount, 0), 0)) AS discount
FROM lineitem""")
def round_quantity(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        c.round_quantity(F.nullif("l_quantity", F.lit(7.0)) / 2).alias("quantity"),
        c.discount(F.nullif(-F.col("l_discount"), F.lit(0.0))).alias("discount"),
    )


@query("row_hygiene", """
SELECT l_orderkey AS bill_num, nullif(l_linestatus, 'O') AS state_cd, nullif(l_returnflag, 'N') AS price_model,
  l_quantity - 10 AS quantity
FROM lineitem
WHERE (l_linestatus <> 'O' OR l_returnflag <> 'N') AND l_quantity <> 10 AND l_tax <> 0""")
def row_hygiene(spark, sf_dir):
    raw = read(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.nullif("l_tax", F.lit(0.0)),
        F.nullif("l_linestatus", F.lit("O")),
        F.nullif("l_returnflag", F.lit("N")),
        F.col("l_quantity") - 10,
    )
    named = hygiene.rename_positional(raw, ["bill", "tax", "state", "model", "quantity"])
    named = hygiene.rename_columns(named, {"bill": "bill_num", "state": "state_cd", "model": "price_model"})
    kept = hygiene.drop_all_null(hygiene.require_keys(named, ["bill_num", "tax"]), ["state_cd", "price_model"])
    return hygiene.select_columns(
        hygiene.drop_zero_quantity(kept), ["bill_num", "state_cd", "price_model", "quantity"]
    )


@query("period_filter", """
SELECT event_id, user_id, event_type, value, 'day' AS level FROM events
WHERE ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-16'
UNION ALL
SELECT event_id, user_id, event_type, value, 'month' FROM events
WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-02-01'""")
def period_filter(spark, sf_dir):
    now = datetime(2024, 1, 15, 12, 30)
    events = read(spark, sf_dir, "events")
    part = lambda level: hygiene.period_filter(events, "ts", level, now).select(
        "event_id", "user_id", "event_type", "value", F.lit(level).alias("level")
    )
    return part("day").unionByName(part("month"))


ROW = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_returnflag"
KEYS = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]


def _dedup_sql(direction):
    order = ", ".join(f"{o} {direction}" for o in LINE_ORDER)
    return f"""
SELECT {ROW} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) AS rn
  FROM lineitem) WHERE rn = 1"""


def _row(df):
    return df.select(*[x.strip() for x in ROW.split(",")])


@query("dedup_keep_last", _dedup_sql("DESC"))
def dedup_keep_last(spark, sf_dir):
    return _row(dedup.keep_last(read(spark, sf_dir, "lineitem"), KEYS, LINE_ORDER))


@query("dedup_keep_first", _dedup_sql("ASC"))
def dedup_keep_first(spark, sf_dir):
    return _row(dedup.keep_first(read(spark, sf_dir, "lineitem"), KEYS, LINE_ORDER))


def _lines(spark, sf_dir):
    # Lines of quantity 0 net a key to zero in one file and leave it to the next.
    sign = F.when(F.col("l_returnflag") == "R", -1).when(F.col("l_returnflag") == "A", 0).otherwise(1)
    return file_order(read(spark, sf_dir, "lineitem")).select(
        F.nullif("l_orderkey", F.lit(0)).alias("bill_num"),
        F.col("l_linenumber").alias("sku"),
        (F.col("l_quantity") * sign).alias("quantity"),
        F.nullif("l_extendedprice", F.lit(0.0)).alias("amt"),
        F.col("l_returnflag").alias("price_model"),
        F.col("l_suppkey").alias("quote_num"),
        F.year("l_shipdate").alias("file"),
        "_o_ship", "_o_part", "_o_supp", "_o_price",
    )


FILE_ORDER = ["_o_ship", "_o_part", "_o_supp", "_o_price"]
LINES_SQL = """lines AS (
  SELECT nullif(l_orderkey, 0) AS bill_num, l_linenumber AS sku,
    CASE l_returnflag WHEN 'R' THEN -l_quantity WHEN 'A' THEN 0 ELSE l_quantity END AS quantity, l_extendedprice AS amt,
    l_returnflag AS price_model, l_suppkey AS quote_num, year(l_shipdate) AS file,
    row_number() OVER (ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) AS pos
  FROM lineitem)"""


@query("consolidate_sales", f"""
WITH {LINES_SQL}
SELECT bill_num, sku, sum(quantity) AS quantity, round(sum(amt), 3) AS amt, arg_min(price_model, pos) AS price_model,
  arg_min(quote_num, pos) AS quote_num
FROM lines WHERE bill_num IS NOT NULL GROUP BY ALL HAVING sum(quantity) <> 0""")
def consolidate_sales(spark, sf_dir):
    lines = _lines(spark, sf_dir).drop("file")
    out = dedup.consolidate_sales(lines, ["bill_num", "sku"], FILE_ORDER)
    return out.withColumn("amt", F.round("amt", 3))


@query("consolidate_sales_files", f"""
WITH {LINES_SQL}, sums AS (
  SELECT bill_num, sku, file, sum(quantity) AS quantity, round(sum(amt), 3) AS amt,
    arg_min(price_model, pos) AS price_model, arg_min(quote_num, pos) AS quote_num
  FROM lines WHERE bill_num IS NOT NULL GROUP BY ALL HAVING sum(quantity) <> 0)
SELECT bill_num, sku, quantity, amt, price_model, quote_num FROM sums
QUALIFY row_number() OVER (PARTITION BY bill_num, sku ORDER BY file) = 1""")
def consolidate_sales_files(spark, sf_dir):
    out = dedup.consolidate_sales(_lines(spark, sf_dir), ["bill_num", "sku"], FILE_ORDER, batch="file")
    return out.withColumn("amt", F.round("amt", 3))
