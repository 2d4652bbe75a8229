"""Customer features and their preparation for clustering."""

from __future__ import annotations

import re

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewright.operators.ranked import reliable

CUSTOMER, CATEGORY = "customer", "cust_cat"


def slug(text: str) -> str:
    return re.sub(r"[^a-zA-Z0-9_]+", "_", text.strip()).strip("_").lower()


def customer_features(sales: DataFrame, categories: list[str]) -> DataFrame:
    """One row per customer from consolidated sales lines.

    Loyalty: ``day_tenure`` and ``day_between_purchases`` (mean days between consecutive
    bills, which telescopes to tenure / (bills - 1), so no ordered window is needed).
    Per category: bills that contain it, mean amount on those bills, mean unit discount.
    Two combining aggregates, first per bill and then per customer: a customer with a third
    of all lines reaches the second exchange as partial rows.
    """
    per_bill = [F.min("sys_dt").alias("bought")]
    per_customer = []
    for category in categories:
        s = slug(category)
        here = F.col("sku_cat") == category
        per_bill += [
            F.sum(F.when(here, F.col("amt"))).alias(f"_{s}_amt"),
            F.sum(F.when(here, F.col("quantity"))).alias(f"_{s}_qty"),
            F.sum(F.when(here, F.col("discount"))).alias(f"_{s}_disc"),
            F.max(here).alias(f"_{s}_in"),
        ]
        bills = F.count(F.when(F.col(f"_{s}_in"), True))
        ratio = lambda top, bottom: F.coalesce(F.try_divide(top, bottom.cast("double")), F.lit(0.0))
        per_customer += [
            bills.cast("double").alias(f"{s}_order_freq"),
            ratio(F.sum(f"_{s}_amt"), bills).alias(f"{s}_avg_purchase"),
            ratio(F.sum(f"_{s}_disc"), F.sum(f"_{s}_qty")).alias(f"{s}_discprice"),
        ]
    tenure = F.date_diff(F.max("bought"), F.min("bought")).cast("double")
    gaps = F.count(F.lit(1)) - 1
    return (
        sales.where(F.col(CUSTOMER).isNotNull())
        .groupBy(CUSTOMER, "bill_num")
        .agg(F.min(CATEGORY).alias(CATEGORY), *per_bill)
        .groupBy(CUSTOMER)
        .agg(
            F.min(CATEGORY).alias(CATEGORY),
            tenure.alias("day_tenure"),
            F.coalesce(F.try_divide(tenure, gaps.cast("double")), F.lit(0.0)).alias("day_between_purchases"),
            *per_customer,
        )
    )


def metric_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in (CUSTOMER, CATEGORY)]


def standardize(df: DataFrame, columns: list[str], stored: bool = False) -> DataFrame:
    """Center and scale by the population deviation; a constant column becomes 0.

    The moments are one row, read first and entered as literals. The frame is therefore
    read twice: pass ``stored`` when it is a table.
    """
    df = df if stored else reliable(df)
    moments = []
    for c in columns:
        moments += [F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}")]
    stats = df.agg(*moments).first()
    scaled = {}
    for c in columns:
        mean, spread = stats[f"m_{c}"], stats[f"s_{c}"]
        scaled[c] = (F.col(c) - F.lit(mean)) / F.lit(spread or 1.0)
    return df.select(*[scaled[c].alias(c) if c in scaled else F.col(c) for c in df.columns])


def prepare_features(df: DataFrame, stored: bool = False) -> DataFrame:
    """Add ``features``: standardized metrics and one slot per customer category.

    The indexer's extra slot for unseen categories is the one the encoder drops, so every
    known level is kept and an unknown one is all zeros.
    """
    df = df if stored else reliable(df)
    metrics = metric_columns(df)
    scaled = standardize(df, metrics, stored=True)
    indexer = StringIndexer(inputCol=CATEGORY, outputCol="_level", handleInvalid="keep").fit(df)
    encoder = OneHotEncoder(inputCol="_level", outputCol="_onehot", dropLast=True).fit(indexer.transform(df))
    assembler = VectorAssembler(inputCols=[*metrics, "_onehot"], outputCol="features")
    vectors = PipelineModel([indexer, encoder, assembler]).transform(scaled)
    return vectors.select(CUSTOMER, "features")
