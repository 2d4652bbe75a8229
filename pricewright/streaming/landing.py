"""Land file drops as they arrive.

Files are taken one per micro-batch in the order they arrived, so a later file meets the rows
an earlier one wrote. The stream's checkpoint replaces the freshness gate: a file is taken
once, whenever the job runs. A batch that is replayed after a failure changes nothing, since
its rows are already stored (anti join, or an upsert to equal values). Micro-batches run in a
session of their own: tables are read through it, and the caller's view is refreshed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from pricewright.operators.ranked import reliable, scratch
from pricewright.operators.reconcile import new_rows_only
from pricewright.plans import jobs
from pricewright.schemas import COMPETITOR, PRICE_MASTER, QUOTES, SALES
from pricewright.sources.files import CSV, FILE_ORDER, with_place, with_row_number
from pricewright.sources.sinks import append_table, merge_partitions, part_of
from pricewright.sources.tables import read_table


def land(
    spark: SparkSession,
    folder: str,
    schema: StructType,
    checkpoint: str,
    on_file: Callable[[DataFrame], None],
    fmt: str = "csv",
    **options,
) -> StreamingQuery:
    """Hand every new file of ``folder`` to ``on_file``, then stop."""
    files = (
        spark.readStream.format(fmt)
        .schema(schema)
        .options(**{**(CSV if fmt == "csv" else {}), "maxFilesPerTrigger": "1", **options})
        .load(folder)
    )
    return (
        with_place(files)
        .writeStream.foreachBatch(lambda batch, _: on_file(with_row_number(batch)))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def land_sales(spark: SparkSession, folder: str, checkpoint: str, name: str, **options) -> StreamingQuery:
    """Append the sales lines the history lacks; of the history only the months of the file are read."""

    def on_file(batch: DataFrame) -> None:
        with scratch(batch.sparkSession):
            rows = reliable(jobs.sales_rows(batch, FILE_ORDER))
            part = part_of(SALES)
            first, last = rows.agg(F.min(part), F.max(part)).first()
            if first is None:
                return
            stored = read_table(batch.sparkSession, name, table=SALES, parts=(first, last))
            append_table(new_rows_only(rows, stored, list(SALES.keys), nullable=[]), name, SALES)
        spark.catalog.refreshTable(name)

    return land(spark, folder, SALES.input_schema, checkpoint, on_file, **options)


def _land_merge(spark, folder, checkpoint, name, table, schema, run, options) -> StreamingQuery:
    def on_file(batch: DataFrame) -> None:
        with scratch(batch.sparkSession):
            merged = run(batch, read_table(batch.sparkSession, name, table=table))
            merge_partitions(merged.table, merged.actions, name, table)
        spark.catalog.refreshTable(name)

    return land(spark, folder, schema, checkpoint, on_file, **options)


def land_quotes(spark: SparkSession, folder: str, checkpoint: str, name: str, **options) -> StreamingQuery:
    run = lambda batch, stored: jobs.quote_job(batch, stored, FILE_ORDER)
    return _land_merge(spark, folder, checkpoint, name, QUOTES, QUOTES.input_schema, run, options)


def land_competitor_prices(
    spark: SparkSession,
    folder: str,
    checkpoint: str,
    name: str,
    catalog: str,
    on_alerts: Callable[[DataFrame], None] = lambda alerts: None,
    **options,
) -> StreamingQuery:
    """Merge competitor prices and hand the alerts of each file on."""

    def run(batch: DataFrame, stored: DataFrame) -> jobs.Merge:
        merged = jobs.competitor_price_job(
            batch, stored, read_table(batch.sparkSession, catalog, table=PRICE_MASTER), FILE_ORDER
        )
        on_alerts(merged.alerts)
        return merged

    return _land_merge(spark, folder, checkpoint, name, COMPETITOR, COMPETITOR.input_schema, run, options)


def land_price_master(
    spark: SparkSession, folder: str, checkpoint: str, name: str, schema: StructType, **options
) -> StreamingQuery:
    """``schema`` is the wide list's: its price columns differ from list to list."""
    run = lambda batch, stored: jobs.price_master_job(batch, stored, FILE_ORDER)
    return _land_merge(spark, folder, checkpoint, name, PRICE_MASTER, schema, run, options)
