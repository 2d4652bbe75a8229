"""Writers: append, merge by partition, replace by version, report extract."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewright.operators.hygiene import rename_positional, with_load_ts
from pricewright.operators.ranked import delete
from pricewright.operators.reconcile import INSERT, UNCHANGED
from pricewright.schemas import Table

PART = "_part"  # the column by which stored files are parted


def part_of(table: Table) -> Column:
    """Partition of a row: the month of its date, or the number of its key's part, as text."""
    if table.dated:
        value = F.date_format(table.dated, "yyyy-MM")
    else:
        value = F.lpad(F.pmod(F.xxhash64(table.parted), F.lit(table.parts)).cast("string"), 5, "0")
    return F.coalesce(value, F.lit("none")).alias(PART)


def append_table(df: DataFrame, name: str, table: Table, load_ts: Column | None = None) -> None:
    """Append rows under the table's column names, stamped with the load time, into their partitions."""
    stamped = with_load_ts(rename_positional(df, table.input_columns), table.load_column, load_ts)
    typed = stamped.select(*[stamped[f"`{f.name}`"].cast(f.dataType).alias(f.name) for f in table.schema.fields])
    if table.dated or table.parted:
        typed.select("*", part_of(table)).write.mode("append").partitionBy(PART).saveAsTable(name)
    else:
        typed.write.mode("append").saveAsTable(name)


def merge_partitions(state: DataFrame, actions: DataFrame, name: str, table: Table) -> list[str]:
    """Rewrite the partitions in which ``actions`` change a row; returns their names.

    ``state`` is the table's new state, ``actions`` the batch with its actions, stored already.
    Only the touched partitions of the state are computed: their filter reaches the scan of the
    table the state comes from. They are written to a folder of their own, and each partition is then pointed at its
    new files, so that a failure leaves it whole, old or new. The old files go last.
    """
    spark = state.sparkSession
    parted = state.select("*", part_of(table))
    if not spark.catalog.tableExists(name):
        parted.write.partitionBy(PART).saveAsTable(name)
        return []
    keys = list(table.keys)
    own = actions.where(F.col("action") == INSERT).select(part_of(table))
    moved = actions.where(~F.col("action").isin(INSERT, UNCHANGED)).select(*[F.col(k).alias(f"_k_{k}") for k in keys])
    same = None
    for k in keys:
        here = F.col(k) == F.col(f"_k_{k}")
        same = here if same is None else same & here
    stored = spark.table(name).join(moved, same, "left_semi").select(PART)
    touched = sorted(r[PART] for r in own.unionAll(stored).distinct().collect())  # names of partitions
    if touched:
        home = _location(spark, name)
        fresh = f"{home}/_merge-{uuid.uuid4().hex}"  # hidden from readers of the table's folder
        parted.where(F.col(PART).isin(touched)).write.partitionBy(PART).parquet(fresh)
        known = {r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
        old = []
        for part in touched:
            spec = f"PARTITION ({PART} = '{part}')"
            if part in known:
                old.append(_location(spark, f"{name} {spec}"))
                spark.sql(f"ALTER TABLE {name} {spec} SET LOCATION '{fresh}/{PART}={part}'")
            else:
                spark.sql(f"ALTER TABLE {name} ADD {spec} LOCATION '{fresh}/{PART}={part}'")
        spark.catalog.refreshTable(name)
        for path in old:
            if path.startswith(f"{home}/") and path.endswith(f"/{PART}={path.rsplit('=', 1)[-1]}"):
                delete(spark, path)
    return touched


def _location(spark: SparkSession, what: str) -> str:
    """Folder of a table, or of one of its partitions, which is told before the table's."""
    about = spark.sql(f"DESCRIBE EXTENDED {what}").where("col_name = 'Location'").collect()
    return about[0]["data_type"].rstrip("/")


def replace_table(df: DataFrame, name: str, root: str, keep: int = 1) -> str:
    """Write a new version beside the old one, then point the table at it.

    The new state may be computed from the table itself, which Spark does not let a job
    overwrite while reading; readers keep the old version until the switch. Of the versions
    before the new one, the last ``keep`` stay, for readers that began before the switch.
    """
    spark = df.sparkSession
    home = f"{root.rstrip('/')}/{name}"
    path = f"{home}/{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    same = False
    if spark.catalog.tableExists(name):
        current = spark.table(name).schema
        same = [(f.name, f.dataType) for f in current] == [(f.name, f.dataType) for f in df.schema]
        if not same:
            spark.sql(f"DROP TABLE {name}")
    if same:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        spark.catalog.refreshTable(name)
    else:
        spark.catalog.createTable(name, path=path, source="parquet")
    for old in _versions(spark, home)[keep + 1 :]:
        delete(spark, old)
    return path


def _versions(spark: SparkSession, home: str) -> list[str]:
    """Folders of a table's versions, the newest first."""
    where = spark._jvm.org.apache.hadoop.fs.Path(home)
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)
    dated = [(f.getModificationTime(), f.getPath().toString()) for f in found if f.isDirectory()]
    return [path for _, path in sorted(dated, reverse=True)]


def report_extract(reports: dict[str, DataFrame], root: str, one_file: bool = False) -> list[str]:
    """One CSV directory per non-empty report, or one file ``<name>.csv``; returns the names written."""
    written = []
    for name, df in reports.items():
        if df.isEmpty():
            continue
        path = f"{root.rstrip('/')}/{name}"
        if one_file:
            write_file(df, f"{path}.csv")
        else:
            df.write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)
        written.append(name)
    return written


def write_file(df: DataFrame, path: str) -> None:
    """One CSV file with a header line. The parts are written by their tasks, in the rows' order, and then joined byte by
    byte under another name, which becomes the file's when it is whole: readers never see a part of it."""
    spark = df.sparkSession
    beside = f"{path}.{uuid.uuid4().hex}"
    df.write.option("header", "false").option("escape", '"').csv(f"{beside}.parts")
    names = spark.createDataFrame([tuple(df.columns)], [f"c{k}" for k in range(len(df.columns))])
    names.coalesce(1).write.option("escape", '"').csv(f"{beside}.head")
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    home = jvm.org.apache.hadoop.fs.Path(path)
    store = home.getFileSystem(conf)
    whole = jvm.org.apache.hadoop.fs.Path(f"{beside}.whole")
    out = store.create(whole)
    try:
        for folder in (f"{beside}.head", f"{beside}.parts"):
            files = [f.getPath() for f in store.listStatus(jvm.org.apache.hadoop.fs.Path(folder))]
            for part in sorted((f for f in files if f.getName().startswith("part-")), key=lambda f: f.getName()):
                source = store.open(part)
                try:
                    jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, 1 << 20, False)
                finally:
                    source.close()
    finally:
        out.close()
    store.delete(home, False)
    if not store.rename(whole, home):
        raise OSError(f"{path} could not be written")
    for folder in (f"{beside}.head", f"{beside}.parts"):
        delete(spark, folder)
