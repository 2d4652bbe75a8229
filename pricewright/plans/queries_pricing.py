"""Price lists, alerts and the landing jobs over the sample tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricewright.functions.cleaning import parse_erp_ts
from pricewright.operators import pricing
from pricewright.operators.hygiene import sheet_date, snapshot_sheet
from pricewright.operators.ranked import reliable
from pricewright.plans import jobs
from pricewright.plans.registry import query
from pricewright.plans.sample import (
    NBSP,
    ORDER,
    WIDE_PRICES,
    catalog,
    competitor_landing,
    file_order,
    price_list,
    read,
    sales_landing,
    text,
)
from pricewright.schemas import COMPETITOR, INVENTORY, PROMO_HISTORY, QUOTES
from pricewright.sources.files import spread

LOADED = "1998-07-01"
LINE_ORDER_SQL = ", ".join(
    f"{c} DESC" for c in ["l_shipdate", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_quantity"]
)


def loaded(df):
    return df.where(F.col("_o_ship") < F.lit(LOADED).cast("timestamp_ntz"))


# The catalog and its latest row per model.
CATALOG_SQL = """catalog AS (
  SELECT CASE WHEN NOT (l_returnflag = 'N' AND l_linestatus = 'O') THEN CAST(l_shipdate AS DATE) END AS src_updt_dt,
    CAST(l_partkey AS VARCHAR) AS model_no, l_linestatus AS cat, CAST(l_suppkey AS VARCHAR) AS prod_cd,
    l_extendedprice * (1 - l_discount) / l_quantity AS unit_cost,
    l_extendedprice / l_quantity AS unit_price, l_returnflag AS price_model
  FROM lineitem),
latest AS (SELECT * FROM catalog QUALIFY row_number() OVER (PARTITION BY model_no
  ORDER BY coalesce(src_updt_dt, DATE '2000-01-01') DESC, price_model, unit_price, unit_cost, cat, prod_cd) = 1)"""


@query("latest_price", f"""
WITH {CATALOG_SQL}
SELECT strftime(coalesce(src_updt_dt, DATE '2000-01-01'), '%Y-%m-%d') AS src_updt_dt, model_no, cat, prod_cd,
  unit_price, price_model FROM latest""")
def latest_price(spark, sf_dir):
    return pricing.latest_price(catalog(spark, sf_dir)).select(
        F.col("src_updt_dt").cast("string").alias("src_updt_dt"), "model_no", "cat", "prod_cd", "unit_price", "price_model"
    )


# Cleaned competitor rows, one per key, with their action against the rows loaded earlier.
STATE_SQL = """CASE n_regionkey WHEN 0 THEN 'FL' WHEN 1 THEN 'CALIFORNIA' WHEN 2 THEN 'N.Y. STATE'
  WHEN 3 THEN 'OR' ELSE 'TX' END"""
COMPETITOR_SQL = f"""seen AS (
  SELECT CASE WHEN l_returnflag <> 'N' THEN make_date(year(l_shipdate), 1, 1) END AS release_dt,
    {STATE_SQL} AS state_cd,
    nullif(l_extendedprice * (1 - l_discount) / l_quantity, l_extendedprice / l_quantity) AS mnf_stk_price,
    CAST(l_partkey AS VARCHAR) AS en_sku, 'R-' || l_linenumber AS comp_sku,
    CAST(round_even(l_quantity / 2, 0) AS BIGINT) AS quantity,
    upper(s_name[1]) || lower(s_name[2:]) AS mnf, upper(n_name[1]) || lower(n_name[2:]) AS distr,
    l_linestatus AS mnf_desc, CASE l_linestatus WHEN 'O' THEN 'Online' ELSE 'Retail store' END AS distr_typ,
    CAST(l_suppkey AS VARCHAR) AS rep_name, *
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey),
batch AS (SELECT * FROM seen QUALIFY row_number() OVER (
  PARTITION BY release_dt, state_cd, en_sku, comp_sku, distr_typ ORDER BY {LINE_ORDER_SQL}) = 1),
stored AS (SELECT * FROM seen WHERE l_shipdate < TIMESTAMP '{LOADED}' QUALIFY row_number() OVER (
  PARTITION BY release_dt, state_cd, en_sku, comp_sku, distr_typ ORDER BY {LINE_ORDER_SQL}) = 1),
actions AS (
  SELECT b.*, CASE WHEN s.en_sku IS NULL THEN 'insert'
    WHEN b.mnf_stk_price IS NOT NULL AND b.mnf_stk_price IS DISTINCT FROM s.mnf_stk_price THEN 'update'
    ELSE 'unchanged' END AS action, s.mnf_stk_price AS old_price
  FROM batch b LEFT JOIN stored s ON b.release_dt IS NOT DISTINCT FROM s.release_dt AND b.state_cd = s.state_cd
    AND b.en_sku = s.en_sku AND b.comp_sku = s.comp_sku AND b.distr_typ = s.distr_typ)"""
ALERT_SELECT_SQL = """
SELECT price_model AS "Price Model", en_sku AS "EN Model No", comp_sku AS "Competitor Model No", mnf AS "Manufacturer",
  unit_price AS "EN Price", mnf_stk_price AS "Competitor Price",
  printf('%.1f', ratio * 100) || '%' AS "Price Variance Ratio",
  distr_typ AS "Channel", strftime(release_dt, '%Y-%m-%d') AS "Competitor Release Date", state_cd AS "State",
  rep_name AS "Rep Name"
FROM (SELECT *, abs(unit_price - mnf_stk_price) / nullif(unit_price, 0) AS ratio
  FROM {rows} JOIN latest ON model_no = en_sku) WHERE ratio >= 0.1"""


def _stored_competitor(spark, sf_dir):
    rows = jobs.clean_batch(loaded(competitor_landing(spark, sf_dir)), COMPETITOR, ORDER)
    stamp = F.lit("2025-01-01").cast("timestamp").alias(COMPETITOR.load_column)
    return reliable(rows.select(*COMPETITOR.input_columns, stamp))


def competitor_merge(spark, sf_dir):
    return jobs.competitor_price_job(
        competitor_landing(spark, sf_dir),
        _stored_competitor(spark, sf_dir),
        catalog(spark, sf_dir),
        ORDER,
        load_ts=F.lit("2025-02-01").cast("timestamp"),
    )


def _dates_as_text(df, *columns):
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


@query("pricing_alerts", f"WITH {CATALOG_SQL}, {COMPETITOR_SQL}" + ALERT_SELECT_SQL.format(rows="batch"))
def pricing_alerts(spark, sf_dir):
    raw = competitor_landing(spark, sf_dir)
    channel = lambda status: jobs.clean_batch(raw.where(F.col("mnf_desc") == status), COMPETITOR, ORDER)
    alerts = pricing.pricing_alerts(channel("O"), channel("F"), catalog(spark, sf_dir))
    return _dates_as_text(alerts, "Competitor Release Date")


@query(
    "competitor_price_alerts",
    f"WITH {CATALOG_SQL}, {COMPETITOR_SQL}"
    + ALERT_SELECT_SQL.format(rows="(SELECT * FROM actions WHERE action <> 'unchanged')"),
)
def competitor_price_alerts(spark, sf_dir):
    return _dates_as_text(competitor_merge(spark, sf_dir).alerts, "Competitor Release Date")


@query("competitor_price_job", f"""
WITH {COMPETITOR_SQL}
SELECT strftime(s.release_dt, '%Y-%m-%d') AS release_dt, s.state_cd, s.en_sku, s.comp_sku, s.distr_typ,
  CASE WHEN a.en_sku IS NULL THEN s.mnf_stk_price ELSE a.mnf_stk_price END AS mnf_stk_price,
  CASE WHEN a.en_sku IS NULL THEN s.quantity ELSE a.quantity END AS quantity,
  CASE WHEN a.en_sku IS NULL THEN s.mnf ELSE a.mnf END AS mnf, s.distr,
  CASE WHEN a.en_sku IS NULL THEN s.rep_name ELSE a.rep_name END AS rep_name,
  CASE WHEN a.en_sku IS NULL THEN '2025-01-01' ELSE '2025-02-01' END AS sys_dt
FROM stored s LEFT JOIN (SELECT * FROM actions WHERE action = 'update') a ON s.release_dt = a.release_dt
  AND s.state_cd = a.state_cd AND s.en_sku = a.en_sku AND s.comp_sku = a.comp_sku AND s.distr_typ = a.distr_typ
UNION ALL
SELECT strftime(release_dt, '%Y-%m-%d'), state_cd, en_sku, comp_sku, distr_typ, mnf_stk_price, quantity, mnf, distr,
  rep_name, '2025-02-01' FROM actions WHERE action = 'insert'""")
def competitor_price_job(spark, sf_dir):
    table = competitor_merge(spark, sf_dir).table
    return table.select(
        F.col("release_dt").cast("string").alias("release_dt"), "state_cd", "en_sku", "comp_sku", "distr_typ",
        "mnf_stk_price", "quantity", "mnf", "distr", "rep_name",
        F.date_format("sys_dt", "yyyy-MM-dd").alias("sys_dt"),
    )


# The wide list: each sample column with its factor, and the cascade written out by hand.
def _cell(factor):
    return f"round(p_retailprice * {factor}, 4)"


WIDE_SQL = ", ".join(f'{_cell(f)} AS "{c}"' for c, f in WIDE_PRICES.items())
PALLET_SQL = "CASE WHEN p_type <> 'PROMO' THEN p_size END"
PRICE_LIST_SQL = f"""price_list AS (SELECT p_partkey, p_brand || '-' || p_size AS model_no, p_name, p_type, p_brand,
  p_retailprice, {PALLET_SQL} AS q, {WIDE_SQL} FROM part)"""
O1, O2, O3, O4, S1, S2, S3, O5, OP, O6 = list(WIDE_PRICES)[:10]
CASCADE_SQL = {
    O2: f'CASE WHEN q > 0 AND q < 9 THEN "{O1}" ELSE "{O2}" END',
    O3: f'CASE WHEN q > 0 AND q < 9 THEN "{O1}" WHEN q > 10 AND q < 24 THEN "{O2}" ELSE "{O3}" END',
    O4: f"""CASE WHEN q > 0 AND q < 9 THEN "{O1}" WHEN q > 10 AND q < 24 THEN "{O2}"
      WHEN q > 25 AND q < 39 THEN "{O3}" ELSE "{O4}" END""",
    OP: f'CASE WHEN q > 10 AND q < 45 THEN "{O5}" ELSE "{OP}" END',
    O6: f'CASE WHEN q > 10 AND q < 45 THEN "{O5}" WHEN q > 0 AND q < 99999999 THEN "{OP}" ELSE "{O6}" END',
}
SOCAL_SQL = {
    S2: f'CASE WHEN q > 0 AND q < 19 THEN "{S1}" ELSE "{S2}" END',
    S3: f'CASE WHEN q > 0 AND q < 19 THEN "{S1}" WHEN q > 20 AND q < 49 THEN "{S2}" ELSE "{S3}" END',
}


def _cascaded(cells):
    return ", ".join(f'{cells.get(c, chr(34) + c + chr(34))} AS "{c}"' for c in WIDE_PRICES)


def _cascade_sql(cells):
    shown = ", ".join(f'{cells.get(c, chr(34) + c + chr(34))} AS "{c}"' for c in list(WIDE_PRICES)[:10])
    return f"WITH {PRICE_LIST_SQL} SELECT p_partkey, {shown} FROM price_list"


def _cascade_rows(df):
    return df.select(F.col("_o_part").alias("p_partkey"), *[F.col(f"`{c}`") for c in list(WIDE_PRICES)[:10]])


@query("pallet_cascade", _cascade_sql(CASCADE_SQL))
def pallet_cascade(spark, sf_dir):
    return _cascade_rows(pricing.pallet_cascade(price_list(spark, sf_dir)))


@query("pallet_cascade_socal", _cascade_sql({**CASCADE_SQL, **SOCAL_SQL}))
def pallet_cascade_socal(spark, sf_dir):
    return _cascade_rows(pricing.pallet_cascade(price_list(spark, sf_dir), cascade_socal=True))


# What the column names mean, written out by hand.
BUCKETS = {
    "Out-of-state Project1 (0-9)": ("Out-of-state Project", 0, 9),
    "Out-of-state Project2 ( 10 - 24 )": ("Out-of-state Project", 0, 99999999),
    "Out-of-state Project3 (25-39)": ("Out-of-state Project", 25, 39),
    "Out-of-state Project4 1000+": ("Out-of-state Project", 1000, 99999999),
    "SoCal Project 1 (0-19)": ("SoCal Project", 0, 19),
    "SoCal Project 12": ("SoCal Project", 2, 99999999),
    "Out-of-state Project5 (10-45)": ("Out-of-state Project", 10, 45),
    "Out-of-state Project6 (46-99)": ("Out-of-state Project", 46, 99),
    "Standard Price": ("Standard Price", 0, 99999999),
    "Sun Valley Pricing": ("Sun Valley Price", 0, 99999999),
    "South CA SPA": ("SPA South CA Price", 0, 99999999),
    "CED Price": ("CED", 0, 99999999),
    "Wesco Pricing - no rebates": ("Wesco", 0, 99999999),
}
BUCKET_SQL = "buckets(name, price_model, lower_bucket, upper_bucket, ordinal) AS (VALUES " + ", ".join(
    f"('{n}', '{m}', {lo}, {up}, {i})" for i, (n, (m, lo, up)) in enumerate(BUCKETS.items())
) + ")"
ON_COLUMNS = ", ".join(f'"{c}"' for c in BUCKETS)


@query("unpivot_prices", f"""
WITH {PRICE_LIST_SQL}, {BUCKET_SQL},
tall AS (UNPIVOT (SELECT p_partkey, model_no, {ON_COLUMNS} FROM price_list) ON {ON_COLUMNS}
  INTO NAME name VALUE unit_price)
SELECT p_partkey, model_no, price_model, lower_bucket, upper_bucket, unit_price
FROM tall JOIN buckets USING (name)""")
def unpivot_prices(spark, sf_dir):
    tall = pricing.unpivot_prices(price_list(spark, sf_dir), carry=["_o_part"])
    return tall.select(
        F.col("_o_part").alias("p_partkey"),
        F.rtrim(F.col("`Model No`"), F.lit(NBSP)).alias("model_no"),
        F.col("pm").alias("price_model"),
        F.col("lower").alias("lower_bucket"),
        F.col("upper").alias("upper_bucket"),
        "unit_price",
    )


@query("price_master_rows", f"""
WITH {PRICE_LIST_SQL}, {BUCKET_SQL},
cascaded AS (SELECT p_partkey, model_no, p_name, p_type, p_retailprice, {_cascaded(CASCADE_SQL)} FROM price_list),
tall AS (UNPIVOT (SELECT p_partkey, model_no, p_name, p_type, p_retailprice, {ON_COLUMNS} FROM cascaded)
  ON {ON_COLUMNS} INTO NAME name VALUE unit_price)
SELECT CASE p_type WHEN 'SMALL' THEN '2025-03-01' WHEN 'LARGE' THEN NULL ELSE '2025-02-01' END AS src_updt_dt,
  model_no, p_name AS descript, p_type AS cat, p_retailprice AS unit_cost, unit_price, price_model, lower_bucket,
  upper_bucket
FROM tall JOIN buckets USING (name)
QUALIFY row_number() OVER (PARTITION BY model_no, price_model, lower_bucket, upper_bucket
  ORDER BY p_partkey DESC, ordinal DESC) = 1""")
def price_master_rows(spark, sf_dir):
    rows = jobs.price_master_rows(price_list(spark, sf_dir), ["_o_part"])
    return _dates_as_text(rows, "src_updt_dt").select(
        "src_updt_dt", "model_no", "descript", "cat", "unit_cost", "unit_price", "price_model", "lower_bucket",
        "upper_bucket",
    )


PRICE_KEYS = "model_no, price_model, lower_bucket, upper_bucket"


@query("price_master_job", f"""
WITH {PRICE_LIST_SQL}, {BUCKET_SQL},
cascaded AS (SELECT p_partkey, model_no, p_name, p_type, p_retailprice, {_cascaded(CASCADE_SQL)} FROM price_list),
tall AS (UNPIVOT (SELECT p_partkey, model_no, p_name, p_type, p_retailprice, {ON_COLUMNS} FROM cascaded)
  ON {ON_COLUMNS} INTO NAME name VALUE unit_price),
batch AS (
  SELECT CASE p_type WHEN 'SMALL' THEN '2025-03-01' WHEN 'LARGE' THEN NULL ELSE '2025-02-01' END AS src_updt_dt,
    model_no, p_name AS descript, p_type AS cat, p_retailprice AS unit_cost, unit_price, {PRICE_KEYS.replace("model_no, ", "")}
  FROM tall JOIN buckets USING (name)
  QUALIFY row_number() OVER (PARTITION BY {PRICE_KEYS} ORDER BY p_partkey DESC, ordinal DESC) = 1),
stored AS (SELECT * REPLACE (CASE cat WHEN 'PROMO' THEN NULL ELSE '2025-02-01' END AS src_updt_dt,
    unit_price / 2 AS unit_price, 'old' AS cat, descript || ' old' AS descript)
  FROM batch WHERE price_model <> 'CED')
SELECT {PRICE_KEYS}, u.moved, CASE WHEN u.moved THEN b.src_updt_dt ELSE s.src_updt_dt END AS src_updt_dt,
  CASE WHEN u.moved THEN b.descript ELSE s.descript END AS descript, s.cat,
  CASE WHEN u.moved THEN b.unit_price ELSE s.unit_price END AS unit_price
FROM stored s JOIN batch b USING ({PRICE_KEYS}),
  LATERAL (SELECT s.src_updt_dt IS NOT NULL AND b.src_updt_dt IS DISTINCT FROM s.src_updt_dt AS moved) u
UNION ALL
SELECT {PRICE_KEYS}, true, src_updt_dt, descript, cat, unit_price FROM batch WHERE price_model = 'CED'""")
def price_master_job(spark, sf_dir):
    """The list merged with an older state of itself: no CED prices, undated promotions, other prices."""
    raw = price_list(spark, sf_dir)
    rows = jobs.price_master_rows(raw, ["_o_part"])
    older = rows.where(F.col("price_model") != "CED").withColumns(
        {
            "src_updt_dt": F.when(F.col("cat") != "PROMO", F.lit("2025-02-01").cast("date")),
            "unit_price": F.col("unit_price") / 2,
            "cat": F.lit("old"),
            "descript": F.concat("descript", F.lit(" old")),
        }
    )
    table = reliable(older.withColumn("data_dt", F.lit("2025-01-01").cast("timestamp")))
    merged = jobs.price_master_job(raw, table, ["_o_part"], load_ts=F.lit("2025-04-01").cast("timestamp")).table
    moved = (F.col("data_dt") > F.lit("2025-01-01").cast("timestamp")).alias("moved")
    return _dates_as_text(merged, "src_updt_dt").select(
        "model_no", "price_model", "lower_bucket", "upper_bucket", moved, "src_updt_dt", "descript", "cat", "unit_price"
    )


SALES_SQL = """lines AS (
  SELECT *, CASE WHEN p_type = 'PROMO' THEN 'combo ' ELSE 'sKU ' END AS prefix,
    l_quantity * CASE WHEN l_returnflag = 'R' THEN -0.5 ELSE 0.5 END AS half,
    row_number() OVER (ORDER BY l_shipdate, l_partkey, l_suppkey, l_linenumber, l_extendedprice, l_quantity) AS pos
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey),
sales AS (
  SELECT c_name AS customer, 'INV' || l_orderkey AS bill_num, CAST(l_orderkey AS VARCHAR) AS quote_num,
    strftime(o_orderdate, '%Y-%m-%d') || ' 03:05:00' AS sys_dt,
    CASE WHEN p_type = 'PROMO' THEN 'combo ' ELSE 'SKU ' END || p_brand AS sku,
    CAST(round_even(sum(half), 0) AS BIGINT) AS quantity, round(sum(l_extendedprice), 3) AS amt,
    arg_min(CASE p_type WHEN 'STANDARD' THEN 'Electrical Device' WHEN 'PROMO' THEN 'Smart Home'
      WHEN 'MEDIUM' THEN 'Switch' WHEN 'ECONOMY' THEN 'Sensors' WHEN 'SMALL' THEN 'Energy Mangement'
      ELSE 'Other' END, pos) AS sku_cat,
    CASE n_regionkey WHEN 0 THEN 'FL' WHEN 1 THEN 'CA' WHEN 2 THEN 'NY' WHEN 3 THEN 'OR' ELSE 'TX' END AS state_cd,
    arg_min(l_discount, pos) AS discount, o_orderdate
  FROM lines GROUP BY c_name, l_orderkey, o_orderdate, p_type = 'PROMO', p_brand, n_regionkey
  HAVING sum(half) <> 0)"""
SALES_SHOWN = "customer, bill_num, quote_num, sys_dt, sku, quantity, amt, sku_cat, state_cd, discount"


def _sales_shown(df):
    return df.withColumns(
        {"sys_dt": F.date_format("sys_dt", "yyyy-MM-dd HH:mm:ss"), "amt": F.round("amt", 3)}
    ).select(*[c.strip() for c in SALES_SHOWN.split(",")])


@query("sales_rows", f"WITH {SALES_SQL} SELECT {SALES_SHOWN} FROM sales")
def sales_rows(spark, sf_dir):
    return _sales_shown(jobs.sales_rows(sales_landing(spark, sf_dir), ORDER))


@query("sales_history_job", f"""
WITH {SALES_SQL} SELECT {SALES_SHOWN} FROM sales s WHERE NOT EXISTS (
  SELECT 1 FROM orders o WHERE o.o_orderdate < TIMESTAMP '{LOADED}' AND 'INV' || o.o_orderkey = s.bill_num)""")
def sales_history_job(spark, sf_dir):
    raw = reliable(sales_landing(spark, sf_dir))
    before = parse_erp_ts(F.col("sys_dt")) < F.lit(LOADED).cast("timestamp_ntz")  # of a key's rows all or none
    earlier = reliable(jobs.sales_rows(raw.where(before), ORDER))
    return _sales_shown(jobs.sales_history_job(raw, earlier, ORDER))


SALES_FILES_SQL = """lines AS (
  SELECT *, CASE WHEN l_tax = 0 THEN 0 WHEN l_returnflag = 'R' THEN -0.5 * l_quantity ELSE 0.5 * l_quantity END AS half,
    year(l_shipdate) AS file, l_suppkey % 2 AS tail, p_type = 'PROMO' AS promo,
    row_number() OVER (ORDER BY l_shipdate, l_partkey, l_suppkey, l_linenumber, l_extendedprice, l_quantity) AS pos
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey),
netted AS (
  SELECT c_name AS customer, 'INV' || l_orderkey AS bill_num, CAST(l_orderkey AS VARCHAR) AS quote_num,
    strftime(o_orderdate, '%Y-%m-%d') || ' 03:05:00' AS sys_dt,
    CASE WHEN promo THEN 'combo ' ELSE 'SKU ' END || p_brand AS sku, file, tail,
    CAST(round_even(sum(half), 0) AS BIGINT) AS quantity, round(sum(l_extendedprice), 3) AS amt,
    arg_min(CASE p_type WHEN 'STANDARD' THEN 'Electrical Device' WHEN 'PROMO' THEN 'Smart Home'
      WHEN 'MEDIUM' THEN 'Switch' WHEN 'ECONOMY' THEN 'Sensors' WHEN 'SMALL' THEN 'Energy Mangement'
      ELSE 'Other' END, pos) AS sku_cat,
    CASE n_regionkey WHEN 0 THEN 'FL' WHEN 1 THEN 'CA' WHEN 2 THEN 'NY' WHEN 3 THEN 'OR' ELSE 'TX' END AS state_cd,
    arg_min(l_discount, pos) AS discount, o_orderdate
  FROM lines GROUP BY c_name, l_orderkey, o_orderdate, promo, p_brand, n_regionkey, file, tail HAVING sum(half) <> 0),
cleaned AS (SELECT * FROM netted
  QUALIFY row_number() OVER (PARTITION BY bill_num, sys_dt, sku, file ORDER BY tail DESC) = 1),
sales AS (SELECT * FROM cleaned QUALIFY row_number() OVER (PARTITION BY bill_num, sys_dt, sku ORDER BY file) = 1)"""


@query("sales_history_files", f"""
WITH {SALES_FILES_SQL} SELECT {SALES_SHOWN} FROM sales s WHERE NOT EXISTS (
  SELECT 1 FROM sales o WHERE o.o_orderdate < TIMESTAMP '{LOADED}' AND o.bill_num = s.bill_num AND o.sku = s.sku)""")
def sales_history_files(spark, sf_dir):
    raw = sales_landing(spark, sf_dir, files=True)
    earlier = reliable(jobs.sales_rows(raw, ORDER, "file").where(F.col("sys_dt") < F.lit(LOADED).cast("timestamp_ntz")))
    return _sales_shown(jobs.sales_history_job(raw, earlier, ORDER, "file"))


QUOTE_SQL = f"""raw AS (
  SELECT CAST(l_partkey AS VARCHAR) AS model_no, 'Q' || l_linenumber AS quote_num, l_returnflag AS price_model,
    CASE WHEN l_tax <> 0 THEN l_linestatus || CAST(CAST(l_tax * 100 AS INTEGER) AS VARCHAR) END AS row_stat,
    CAST(round_even(l_quantity / 2, 0) AS BIGINT) AS quantity, strftime(l_shipdate, '%Y-%m-%d') AS quote_dt,
    l_shipdate, {LINE_ORDER_SQL.replace(" DESC", "").replace("l_shipdate, ", "")} FROM lineitem),
batch AS (SELECT * FROM raw QUALIFY row_number() OVER (PARTITION BY quote_num, model_no, price_model
  ORDER BY {LINE_ORDER_SQL}) = 1),
stored AS (SELECT * FROM raw WHERE l_shipdate < TIMESTAMP '{LOADED}' QUALIFY row_number() OVER (
  PARTITION BY quote_num, model_no, price_model ORDER BY {LINE_ORDER_SQL}) = 1)"""


def quote_landing(spark, sf_dir):
    raw = file_order(spread(read(spark, sf_dir, "lineitem")))
    stat = F.concat("l_linestatus", F.round(F.col("l_tax") * 100).cast("int").cast("string"))
    return raw.select(
        F.concat(F.lit("\t "), text("l_partkey")).alias("model_no"),
        (F.col("l_quantity") / 2).alias("quantity"),
        F.lit("online").alias("distr_typ"),
        F.concat(F.lit("Q"), text("l_linenumber"), F.lit("\u200b")).alias("quote_num"),
        F.date_format("l_shipdate", "MM/dd/yyyy").alias("quote_dt"),
        F.col("l_linestatus").alias("trans_stat"),
        F.concat(F.lit("C1 Top : "), text("l_suppkey")).alias("customer"),
        F.col("l_extendedprice").alias("amt"),
        F.col("l_returnflag").alias("price_model"),
        F.when(F.col("l_tax") != 0, stat).alias("row_stat"),
        F.lit("Utah").alias("state_cd"),
        *ORDER,
    )


@query("quote_job", f"""
WITH {QUOTE_SQL}
SELECT s.model_no, s.quote_num, s.price_model, s.quote_dt,
  CASE WHEN u.moved THEN b.row_stat ELSE s.row_stat END AS row_stat,
  CASE WHEN u.moved THEN b.quantity ELSE s.quantity END AS quantity,
  CASE WHEN u.moved THEN '2025-02-01' ELSE '2025-01-01' END AS data_dt
FROM stored s LEFT JOIN batch b USING (quote_num, model_no, price_model),
  LATERAL (SELECT b.row_stat IS DISTINCT FROM s.row_stat AND s.row_stat IS NOT NULL AS moved) u
UNION ALL
SELECT model_no, quote_num, price_model, quote_dt, row_stat, quantity, '2025-02-01' FROM batch b
WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.quote_num = b.quote_num AND s.model_no = b.model_no
  AND s.price_model = b.price_model)""")
def quote_job(spark, sf_dir):
    raw = quote_landing(spark, sf_dir)
    stamp = F.lit("2025-01-01").cast("timestamp").alias(QUOTES.load_column)
    table = reliable(jobs.clean_batch(loaded(raw), QUOTES, ORDER).select(*QUOTES.input_columns, stamp))
    merged = jobs.quote_job(raw, table, ORDER, load_ts=F.lit("2025-02-01").cast("timestamp")).table
    return merged.select(
        "model_no", "quote_num", "price_model", F.col("quote_dt").cast("string").alias("quote_dt"), "row_stat",
        "quantity", F.date_format("data_dt", "yyyy-MM-dd").alias("data_dt"),
    )


QUOTE_KEYS = "quote_num, model_no, price_model"


@query("quote_job_files", f"""
WITH RECURSIVE {QUOTE_SQL},
files AS (SELECT * FROM raw QUALIFY row_number() OVER (PARTITION BY {QUOTE_KEYS}, year(l_shipdate)
  ORDER BY {LINE_ORDER_SQL}) = 1),
steps AS (SELECT *, row_number() OVER (PARTITION BY {QUOTE_KEYS} ORDER BY l_shipdate) AS k FROM files),
walk AS (
  SELECT {QUOTE_KEYS}, CAST(0 AS BIGINT) AS k, quote_dt, row_stat, quantity, '2025-01-01' AS data_dt FROM stored
  UNION ALL
  SELECT {QUOTE_KEYS}, k, quote_dt, row_stat, quantity, '2025-02-01' FROM steps ANTI JOIN stored USING ({QUOTE_KEYS})
  WHERE k = 1
  UNION ALL
  SELECT w.quote_num, w.model_no, w.price_model, f.k, w.quote_dt,
    CASE WHEN u.moved THEN f.row_stat ELSE w.row_stat END, CASE WHEN u.moved THEN f.quantity ELSE w.quantity END,
    CASE WHEN u.moved THEN '2025-02-01' ELSE w.data_dt END
  FROM walk w JOIN steps f ON f.quote_num = w.quote_num AND f.model_no = w.model_no
      AND f.price_model = w.price_model AND f.k = w.k + 1,
    LATERAL (SELECT w.row_stat IS NOT NULL AND f.row_stat IS DISTINCT FROM w.row_stat AS moved) u)
SELECT model_no, quote_num, price_model, quote_dt, row_stat, quantity, data_dt FROM walk
QUALIFY row_number() OVER (PARTITION BY {QUOTE_KEYS} ORDER BY k DESC) = 1""")
def quote_job_files(spark, sf_dir):
    raw = quote_landing(spark, sf_dir)
    stamp = F.lit("2025-01-01").cast("timestamp").alias(QUOTES.load_column)
    table = reliable(jobs.clean_batch(loaded(raw), QUOTES, ORDER).select(*QUOTES.input_columns, stamp))
    files = raw.withColumn("file", F.year("_o_ship"))
    merged = jobs.quote_job(files, table, ORDER, F.lit("2025-02-01").cast("timestamp"), "file").table
    return merged.select(
        "model_no", "quote_num", "price_model", F.col("quote_dt").cast("string").alias("quote_dt"), "row_stat",
        "quantity", F.date_format("data_dt", "yyyy-MM-dd").alias("data_dt"),
    )


@query("promo_history_job", """
SELECT strftime(date_trunc('month', l_shipdate), '%Y-%m-%d') AS month_st,
  strftime(last_day(l_shipdate), '%Y-%m-%d') AS month_ed, CAST(l_partkey AS VARCHAR) AS sku,
  CASE l_returnflag WHEN 'N' THEN 'Discontinued' ELSE l_returnflag END AS promo_reason,
  CASE l_linestatus WHEN 'O' THEN 'Discontinued' ELSE l_linestatus END AS category, l_extendedprice AS socal
FROM lineitem QUALIFY row_number() OVER (PARTITION BY date_trunc('month', l_shipdate), l_partkey
  ORDER BY l_shipdate DESC, l_suppkey DESC, l_linenumber DESC, l_extendedprice DESC, l_quantity DESC) = 1""")
def promo_history_job(spark, sf_dir):
    blank = F.lit(None).cast("string")
    raw = file_order(spread(read(spark, sf_dir, "lineitem"))).select(
        F.trunc("l_shipdate", "month").alias("month_st"),
        F.last_day("l_shipdate").alias("month_ed"),
        F.concat(F.lit(NBSP), text("l_partkey")).alias("sku"),
        F.when(F.col("l_returnflag") == "N", "Disontinued").otherwise(F.col("l_returnflag")).alias("promo_reason"),
        F.when(F.col("l_linestatus") == "O", "Discontinued item").otherwise(F.col("l_linestatus")).alias("category"),
        *[blank.alias(c) for c in PROMO_HISTORY.input_columns[5:8]],
        F.col("l_extendedprice").alias("socal"),
        *[blank.alias(c) for c in PROMO_HISTORY.input_columns[9:]],
        *ORDER,
    )
    out = jobs.promo_history_job(raw, ORDER)
    return _dates_as_text(out, "month_st", "month_ed").select(
        "month_st", "month_ed", "sku", "promo_reason", "category", "socal"
    )


@query("promo_base_job", """
SELECT CAST(p_partkey AS VARCHAR) AS sku, p_brand AS color, p_type AS category, p_name AS descrip,
  CAST(p_size AS BIGINT) AS moq, p_retailprice AS socal, '2025-01-01' AS sys_dt FROM part""")
def promo_base_job(spark, sf_dir):
    blank = F.lit(None).cast("string")
    part = read(spark, sf_dir, "part")
    sheet = part.select(
        text("p_partkey").alias("Item"), F.col("p_brand").alias("Color"), F.col("p_type").alias("Cat"), blank.alias("Why"),
        F.col("p_name").alias("Text"), text("p_size").alias("MOQ"), text("p_retailprice").alias("Price"),
        *[blank.alias(f"c{i}") for i in range(6)],
    )
    out = jobs.promo_base_job(sheet, F.lit("2025-01-01").cast("timestamp"))
    return _dates_as_text(out.withColumn("sys_dt", F.col("sys_dt").cast("date")), "sys_dt").select(
        "sku", "color", "category", "descrip", "moq", "socal", "sys_dt"
    )


INVENTORY_SQL = """
SELECT '2024-02-02' AS inv_eval_dt, event_id AS co, event_type AS sku_cat, user_id AS en_last_120_outbound,
  CASE WHEN event_type <> 'view' THEN CAST(floor(value) AS BIGINT) END AS en_last_90_outbound,
  value AS tg_instock_quantity
FROM events WHERE event_type <> 'error' AND event_id NOT IN (SELECT event_id FROM events ORDER BY event_id LIMIT 2)"""


def inventory_sheet(spark, sf_dir):
    """Events as a stock sheet: the measured columns of errors are blank, the first two rows are sub-headers."""
    whole = F.floor("value").cast("string")
    known = F.col("event_type") != "error"
    return read(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("a"),
        F.lit("high").alias("b"),
        F.lit("s").alias("c"),
        F.when(known, "asin").alias("2024-02-02 00:00:00"),
        F.when(known, F.col("event_type")).alias("e"),
        F.when(known, F.col("user_id").cast("string")).alias("f"),
        F.when(known & (F.col("event_type") != "view"), whole).alias("g"),
        *[whole.alias(f"h{i}") for i in range(9)],
        F.col("value").alias("z"),
        F.lit("remark").alias("extra"),
        F.col("event_id").alias("_place"),
    )


def _inventory_shown(df):
    return df.select(
        F.col("inv_eval_dt").cast("string").alias("inv_eval_dt"), F.col("co_cd").cast("long").alias("co"), "sku_cat",
        "en_last_120_outbound", "en_last_90_outbound", "tg_instock_quantity",
    )


@query("inventory_snapshot", INVENTORY_SQL)
def inventory_snapshot(spark, sf_dir):
    sheet = inventory_sheet(spark, sf_dir)
    return _inventory_shown(snapshot_sheet(sheet, sheet_date(sheet.columns[3]), INVENTORY.columns, ["_place"]))


@query("inventory_job", INVENTORY_SQL)
def inventory_job(spark, sf_dir):
    sheet = inventory_sheet(spark, sf_dir)
    stored = read(spark, sf_dir, "events").select(F.col("ts").cast("date").alias("inv_eval_dt"))
    fresh = jobs.inventory_job(sheet, F.lit("2024-02-02"), stored, ["_place"])
    seen = jobs.inventory_job(sheet, F.lit("2024-01-20"), stored, ["_place"])
    return _inventory_shown(fresh.unionByName(seen))
