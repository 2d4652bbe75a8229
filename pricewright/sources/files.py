"""Flat landing files."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pricewright.operators.hygiene import period_bounds
from pricewright.sources.quoted import read_quoted

FORMATS = ("csv", "parquet", "json", "orc")

# Position of a row: its file, the block of the file, and the place in the block. Blocks of
# one file may land in any task, but a block is read in order, so the triple is file order.
FILE_ORDER = ["_file", "_block", "_row"]


# Cells may hold quoted newlines and doubled quotes. Such a file is read by one task, unless
# it is read with ``split``; multiLine="false" splits large files whose cells are known to have no
# newlines. A cell that
# is no number where one is declared, or a row of another width, fails the read instead of
# becoming nulls; rows are split whole, so that their width shows whatever is selected.
CSV = {
    "header": "true",
    "escape": '"',
    "multiLine": "true",
    "mode": "FAILFAST",
    "columnPruning": "false",
}


def _empty(spark: SparkSession, schema: StructType) -> DataFrame:
    none = spark.createDataFrame([], schema)
    return none.select("*", F.lit("").alias("_file"), *[F.lit(0).cast("long").alias(c) for c in FILE_ORDER[1:]])


def with_place(df: DataFrame) -> DataFrame:
    """File name and block of every row of a file scan."""
    return df.select(
        "*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.file_block_start").alias("_block")
    )


def with_row_number(df: DataFrame) -> DataFrame:
    """Place of every row in its block."""
    return df.withColumn("_row", F.monotonically_increasing_id())


def freshness_options(level: str | None, now: datetime | None, tz: str = "UTC") -> dict[str, str]:
    """Reader options that keep files modified in the current day or month of ``tz``."""
    if level is None:
        return {}
    start, end = period_bounds(level, now or datetime.now(timezone.utc), tz)
    stamp = lambda t: t.isoformat(timespec="milliseconds")
    return {
        "modifiedAfter": stamp(start - timedelta(milliseconds=1)),
        "modifiedBefore": stamp(end),
        "timeZone": tz,
    }


def read_flat(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    fmt: str = "csv",
    level: str | None = None,
    now: datetime | None = None,
    tz: str = "UTC",
    glob: str | None = None,
    split: bool = False,
    **options,
) -> DataFrame:
    """Rows of a file (or folder) under a declared schema, with their position.

    A missing path, a stale file or an unknown format gives no rows. The freshness gate and
    the glob act on the file listing, before anything is opened. CSV settings: see ``CSV``.
    ``split`` reads a large CSV file in many tasks although its cells hold line ends; quotes
    must then stand around whole cells.
    """
    if fmt not in FORMATS:
        return _empty(spark, schema)
    settings = {**(CSV if fmt == "csv" else {}), **freshness_options(level, now, tz), **options}
    if glob:
        settings["pathGlobFilter"] = glob
    try:
        if split and fmt == "csv":
            return read_quoted(spark, path, schema, settings, settings["header"] == "true")
        df = spark.read.format(fmt).schema(schema).options(**settings).load(path)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return _empty(spark, schema)
        raise
    return with_row_number(with_place(df))


def spread(df: DataFrame, most: int = 128 << 20) -> DataFrame:
    """Share the rows of a small scan among all cores.

    A small file may be one row group, which one task would clean alone. A scan the planner
    takes for more than ``most`` bytes has splits enough and passes through, so what this
    moves is bounded whatever the cluster.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism) if size <= most else df


def read_folder(
    spark: SparkSession, folder: str, schema: StructType, fmt: str = "csv", level: str | None = "month", **kw
) -> DataFrame:
    """All files of a folder in one scan, gated by month unless told otherwise; ``_file`` tells them apart."""
    return read_flat(spark, folder, schema, fmt, level, **kw)
