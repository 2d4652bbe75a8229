"""Stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewright.schemas import Table
from pricewright.sources.sinks import PART


def distinct_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*columns).distinct()


def read_table(
    spark: SparkSession,
    name: str,
    columns: list[str] | None = None,
    distinct: bool = False,
    table: Table | None = None,
    parts: tuple[str, str] | None = None,
) -> DataFrame:
    """A catalog table, or an empty frame of the declared schema when it was never written.

    ``parts``: first and last partition to scan.
    """
    if table is not None and not spark.catalog.tableExists(name):
        df = spark.createDataFrame([], table.schema)
    else:
        df = spark.table(name)
        if parts:
            df = df.where(F.col(PART).between(*parts))
        if table is not None:
            df = df.select(*[F.col(f"`{c}`") for c in table.columns])
    if columns is None:
        return df
    return distinct_columns(df, columns) if distinct else df.select(*columns)
