"""The sample tables shaped like landing files, so that every job can run on them.

Text is made as untidy as real files are: padded keys, mixed date layouts, ids in front of
names. ``SQL`` holds the same shapes for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewright.sources.files import spread

NBSP = "\u00a0"
ORDER = ["_o_ship", "_o_part", "_o_supp", "_o_line", "_o_price", "_o_qty"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def file_order(df: DataFrame) -> DataFrame:
    """Order columns that stand for the position in a file."""
    return df.select(
        "*",
        F.col("l_shipdate").alias("_o_ship"),
        F.col("l_partkey").alias("_o_part"),
        F.col("l_suppkey").alias("_o_supp"),
        F.col("l_linenumber").alias("_o_line"),
        F.col("l_extendedprice").alias("_o_price"),
        F.col("l_quantity").alias("_o_qty"),
    )


def text(c: str):
    return F.col(c).cast("string")


RAW_CATEGORY = {
    "STANDARD": "Wiring Devices",
    "PROMO": "Automation",
    "MEDIUM": "Dimmers",
    "ECONOMY": "Sensors",
    "SMALL": "Timers",
    "LARGE": "Unlisted",
}
RAW_STATE = ["Florida", "California", "N.Y. State", "Oregon", "tx"]


def _case(c, mapping):
    out = None
    for k, v in mapping.items():
        out = F.when(c == k, v) if out is None else out.when(c == k, v)
    return out


def sold_lines(spark: SparkSession, sf_dir: str, customer: DataFrame) -> DataFrame:
    """Lines with their parts, orders and customers. The customers join the orders, of which there are fewer than lines,
    and the orders come last, so that the lines of an order end up side by side."""
    lines, part = spread(read(spark, sf_dir, "lineitem")), read(spark, sf_dir, "part")
    orders = read(spark, sf_dir, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return lines.join(part, F.col("l_partkey") == F.col("p_partkey")).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def sales_landing(spark: SparkSession, sf_dir: str, files: bool = False) -> DataFrame:
    """With ``files``, one file a ship year, bills that are the same only after cleaning, and lines of quantity 0."""
    joined = file_order(
        sold_lines(spark, sf_dir, read(spark, sf_dir, "customer").join(
            read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
        ))
    )
    day = F.concat(
        F.month("o_orderdate"), F.lit("/"), F.dayofmonth("o_orderdate"), F.lit("/"), F.year("o_orderdate")
    )
    marker = F.when(F.col("o_orderstatus") == "O", " pm").otherwise(" am")
    sign = F.when(F.col("l_returnflag") == "R", -0.5).otherwise(0.5)
    tail = F.lit("\t")
    if files:
        sign = F.when(F.col("l_tax") == 0, 0.0).otherwise(sign)
        tail = F.when(F.col("l_suppkey") % 2 == 1, F.lit(f"{NBSP}\t")).otherwise(tail)
    return joined.select(
        F.concat(F.lit("CUST"), text("c_custkey"), F.lit(" "), "n_name", F.lit(" : "), "c_name").alias("customer"),
        F.concat(F.lit(f"{NBSP} INV"), text("l_orderkey"), tail).alias("bill_num"),
        F.concat(F.lit("Sales Order #"), text("l_orderkey")).alias("quote_num"),
        F.concat(day, F.lit(" 3:05"), marker).alias("sys_dt"),
        F.concat(F.when(F.col("p_type") == "PROMO", "Combo ").otherwise("SKU "), "p_brand").alias("sku"),
        (F.col("l_quantity") * sign).alias("quantity"),
        F.col("l_extendedprice").alias("amt"),
        F.col("o_orderpriority").alias("price_model"),
        F.col("p_brand").alias("prod_cd"),
        _case(F.col("p_type"), RAW_CATEGORY).alias("sku_cat"),
        _case(F.col("n_regionkey"), dict(enumerate(RAW_STATE))).alias("state_cd"),
        F.col("o_orderstatus").alias("proj_type"),
        F.concat(day, F.lit(" 9:30 am")).alias("onboard_dt"),
        F.col("c_mktsegment").alias("cust_cat"),
        F.nullif(-F.col("l_discount"), F.lit(0.0)).alias("discount"),
        *ORDER,
        *([F.year("l_shipdate").alias("file")] if files else []),
    )


def competitor_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = file_order(spread(read(spark, sf_dir, "lineitem")))
    supplier, nation = read(spark, sf_dir, "supplier"), read(spark, sf_dir, "nation")
    joined = lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(
        nation, F.col("s_nationkey") == F.col("n_nationkey")
    )
    year = F.year("l_shipdate").cast("string")
    released = (
        F.when(F.col("l_returnflag") == "A", F.concat(year, F.lit("-01-01")))
        .when(F.col("l_returnflag") == "R", F.concat(F.lit("1/1/"), year))
        .otherwise("not released")
    )
    return joined.select(
        released.alias("release_dt"),
        _case(F.col("n_regionkey"), dict(enumerate(RAW_STATE))).alias("state_cd"),
        F.nullif(
            F.col("l_extendedprice") * (1 - F.col("l_discount")) / F.col("l_quantity"),
            F.col("l_extendedprice") / F.col("l_quantity"),
        ).alias("mnf_stk_price"),
        F.concat(F.lit(f" {NBSP}"), text("l_partkey"), F.lit(" ")).alias("en_sku"),
        F.concat(F.lit("Rival: R-"), text("l_linenumber")).alias("comp_sku"),
        (F.col("l_quantity") / 2).alias("quantity"),
        F.col("s_name").alias("mnf"),
        F.lower("n_name").alias("distr"),
        F.col("l_linestatus").alias("mnf_desc"),
        F.when(F.col("l_linestatus") == "O", "oNLINE").otherwise("retail STORE").alias("distr_typ"),
        text("l_suppkey").alias("rep_name"),
        *ORDER,
    )


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price history per model: every sale quotes a unit price on its ship date."""
    undated = (F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O")
    return read(spark, sf_dir, "lineitem").select(
        F.when(~undated, F.col("l_shipdate").cast("date")).alias("src_updt_dt"),
        text("l_partkey").alias("model_no"),
        F.col("l_linestatus").alias("cat"),
        text("l_suppkey").alias("prod_cd"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount")) / F.col("l_quantity")).alias("unit_cost"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        F.col("l_returnflag").alias("price_model"),
    )


# Columns of the wide sample list, with the factor on the retail price.
WIDE_PRICES = {
    "Out-of-state Project1 (0-9)": 1.0,
    "Out-of-state Project2 ( 10 - 24 )": 0.95,
    "Out-of-state Project3 (25-39)": 0.9,
    "Out-of-state Project4 1000+": 0.85,
    "SoCal Project 1 (0-19)": 0.97,
    "SoCal Project2 (20-49)": 0.93,
    "SoCal Project 12": 0.89,
    "Out-of-state Project5 (10-45)": 0.88,
    "Out-of-state Pallet price": 0.8,
    "Out-of-state Project6 (46-99)": 0.78,
    "Standard Price": 1.1,
    "Sun Valley Pricing": 1.05,
    "South CA SPA": 1.04,
    "CED Price": 1.03,
    "Wesco Pricing - no rebates": 1.02,
}


def price_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = spread(read(spark, sf_dir, "part"))
    price = lambda factor: F.round(F.col("p_retailprice") * factor, 4)
    return part.select(
        F.when(F.col("p_type") == "SMALL", "3/1/2025").when(F.col("p_type") == "LARGE", "soon")
        .otherwise("2025-02-01 00:00:00").alias("src_updt_dt"),
        F.concat(F.col("p_brand"), F.lit("-"), text("p_size"), F.lit(f"{NBSP}")).alias("Model No"),
        F.col("p_name").alias("Description"),
        F.col("p_type").alias("Class"),
        F.col("p_brand").alias("Industry"),
        F.col("p_type").alias("Supply Chain Level"),
        F.col("p_brand").alias("Product Level"),
        F.col("p_retailprice").alias("EN-cost"),
        F.col("p_name").alias("Competitor Pricing/Model Number"),
        F.when(F.col("p_type") != "PROMO", F.col("p_size").cast("double")).alias("Pallet Quantity"),
        *[price(f).alias(c) for c, f in WIDE_PRICES.items()],
        F.col("p_partkey").alias("_o_part"),
    )


def customer_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consolidated sales lines as the feature builder reads them."""
    lines, orders = spread(read(spark, sf_dir, "lineitem")), read(spark, sf_dir, "orders")
    customer, part = read(spark, sf_dir, "customer"), read(spark, sf_dir, "part")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("c_name").alias("customer"),
            F.col("l_orderkey").alias("bill_num"),
            F.col("o_orderdate").alias("sys_dt"),
            F.col("l_quantity").alias("quantity"),
            F.col("l_extendedprice").alias("amt"),
            F.col("l_discount").alias("discount"),
            F.col("p_type").alias("sku_cat"),
            F.col("c_mktsegment").alias("cust_cat"),
        )
    )


CATEGORIES = list(RAW_CATEGORY)


def model_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions with the forecast's columns; the SKU is the part."""
    price = F.col("l_extendedprice")
    year = F.year("l_shipdate")
    when_year = lambda y, v: F.when(year == y, v)
    return (
        sold_lines(spark, sf_dir, read(spark, sf_dir, "customer"))
        .select(
            text("l_partkey").alias("sku_pk"),
            F.col("p_type").alias("sku_cat"),
            F.col("p_brand").alias("prod_cd"),
            F.coalesce(F.nullif(F.col("o_orderstatus"), F.lit("P")), F.lit("Other")).alias("proj_type"),
            price.alias("price"),
            F.col("l_quantity").alias("quantity"),
            F.col("c_mktsegment").alias("cust_cat"),
            F.col("o_orderpriority").alias("cust_tier"),
            F.col("p_retailprice").alias("avg_p"),
            F.col("l_quantity").alias("avg_q"),
            F.col("l_discount").alias("p_std"),
            F.col("l_tax").alias("q_std"),
            when_year(1998, price).alias("2023_avg_p"),
            when_year(1998, F.col("l_quantity")).alias("2023_avg_q"),
            when_year(1999, price).alias("2024_avg_p"),
            when_year(1999, F.col("l_quantity")).alias("2024_avg_q"),
            when_year(2000, price).alias("2025_avg_p"),
            when_year(2000, F.col("l_quantity")).alias("2025_avg_q"),
            (F.col("l_discount") - F.col("l_tax")).alias("ped"),
            *[F.col(c) for c in ("l_orderkey", "l_linenumber", "l_shipdate", "l_suppkey", "l_extendedprice")],
        )
    )
