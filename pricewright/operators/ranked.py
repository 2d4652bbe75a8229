"""Order statistics that never gather a group in one task.

A group may hold a third of all rows, so ranking it in one window task does not scale.
``running_total`` ranges the rows over tasks by (group, order), sums each slice, and adds
the slice offsets: every task sees one slice, whatever the group sizes are.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A group with more distinct values than this is ranked in slices instead of one buffer.
MAX_GROUP_VALUES = 1_000_000


_WRITTEN: list[str] = []
_LOCAL: list[str] = []


def reliable(df: DataFrame) -> DataFrame:
    """Write the rows once under the shared folder the session names and go on from there.

    Parquet rather than an RDD checkpoint: it survives lost executors as well, and the
    planner sees its size and can prune its columns. ``scratch`` deletes what a job wrote.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored(df: DataFrame) -> DataFrame:
    """The frame itself if it is rows of files as they lie, filtered at most, else written once by ``reliable``."""
    node = df._jdf.queryExecution().analyzed()
    while node.nodeName() == "Filter":
        node = node.child()
    return df if node.nodeName() == "LogicalRelation" else reliable(df)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end, every intermediate that was written inside; results must be stored by then."""
    before = len(_WRITTEN)
    try:
        yield
    finally:
        for path in _WRITTEN[before:]:
            delete(spark, path)
        del _WRITTEN[before:]


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it lies."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a local master without it gets one of this process."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="run-"))
    return _LOCAL[0]


def running_total(df: DataFrame, group: list[str], order: list[str], weight: str, name: str) -> DataFrame:
    """Add the sum of ``weight`` over the group's rows up to and including this one.

    (group, order) must identify a row. The slices are frozen in storage: a range
    partitioning computed anew after a lost executor could cut elsewhere.
    """
    sliced = reliable(
        df.repartitionByRange(*[F.col(c) for c in [*group, *order]]).withColumn("_slice", F.spark_partition_id())
    )
    key = group or [F.lit(0)]
    before = Window.partitionBy(*key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy(*group, "_slice")
        .agg(F.sum(weight).alias("_in_slice"))
        .withColumn("_before", F.coalesce(F.sum("_in_slice").over(before), F.lit(0)))
        .select(*[F.col(c).alias(f"_g_{c}") for c in group], F.col("_slice").alias("_g_slice"), "_before")
    )
    same = F.col("_slice") == F.col("_g_slice")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    inside = Window.partitionBy(*group, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        sliced.withColumn("_run", F.sum(weight).over(inside))
        .join(offsets, same, "inner")
        .select(*df.columns, (F.col("_run") + F.col("_before")).alias(name))
    )


def numbered(df: DataFrame, group: list[str], order: list[str], name: str, drop: list[str] = ()) -> DataFrame:
    """Add the place of a row, from 1, in its group under ``order``. Columns to ``drop`` serve the order only and are not
    stored.

    One shuffle, in ranges of (group, order): a task numbers the sorted rows as they pass. A range holds the end of a
    group that began in earlier ranges at most once, at its start, so what has to be added comes from a table of one
    row for each range.
    """
    columns, keys = [c for c in df.columns if c not in drop], [f"_k{i}" for i in range(len(group))]
    width = len(keys)
    keyed = df.select("*", *[F.col(f"`{g}`").alias(k) for g, k in zip(group, keys, strict=True)])
    cut = keyed.repartitionByRange(*[F.col(c) for c in [*keys, *order]]).sortWithinPartitions(*keys, *order).drop(*drop)
    schema = cut.drop(*keys).withColumns({"_slice": F.lit(0), "_at": F.lit(0).cast("long"), "_row": F.lit(0).cast("long")}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, last, seen, rows = TaskContext.get().partitionId(), None, 0, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            new = np.zeros(n, bool)
            for c in batch.columns[-width:] if width else ():
                a, b = c.slice(0, n - 1), c.slice(1)
                same = pc.fill_null(pc.equal(a, b), False).to_numpy(zero_copy_only=False)
                new[1:] |= ~(same | (a.is_null().to_numpy(zero_copy_only=False) & b.is_null().to_numpy(zero_copy_only=False)))
            first = [c[0].as_py() for c in batch.columns[-width:]] if width else []
            if first != last:
                seen = 0
            starts = np.flatnonzero(new)
            at = np.arange(1, n + 1) + seen
            if len(starts):
                at -= np.repeat(np.append(0, starts + seen), np.diff(np.append(np.append(0, starts), n)))
            last, seen = [c[-1].as_py() for c in batch.columns[-width:]] if width else [], int(at[-1])
            arrays = [*batch.columns[: len(columns)], pa.array(np.full(n, here), pa.int32()), pa.array(at, pa.int64()), pa.array(np.arange(n) + rows, pa.int64())]
            rows += n
            yield pa.RecordBatch.from_arrays(arrays, [*columns, "_slice", "_at", "_row"])

    sliced = reliable(cut.mapInArrow(run, schema))
    # Of each range its last group, how many rows of it the range has, and whether it is the first group as well.
    ends = sliced.groupBy("_slice").agg(
        F.max_by(F.struct(*[F.col(f"`{g}`").alias(k) for g, k in zip(group, keys, strict=True)], F.col("_at").alias("n")), "_row").alias("last"),
        F.min_by(F.struct(F.lit(True).alias("any"), *[F.col(f"`{g}`").alias(k) for g, k in zip(group, keys, strict=True)]), "_row").alias("first"),
    )
    before, carried, held = {}, 0, None
    for r in ends.orderBy("_slice").collect():  # a row for each range
        own = [r["last"][k] for k in keys]
        begins = [r["first"][k] for k in keys]
        before[r["_slice"]] = (begins, carried if held == begins else 0)
        carried = r["last"]["n"] + (carried if held == begins and own == begins else 0)
        held = own
    rows = [(s, n, *b) for s, (b, n) in before.items() if n]
    kinds = [sliced.schema[g].dataType.simpleString() for g in group]
    carry = df.sparkSession.createDataFrame(rows, ", ".join(["_s int, _n long", *[f"{k} {t}" for k, t in zip(keys, kinds, strict=True)]]))
    same = F.col("_slice") == F.col("_s")
    for g, k in zip(group, keys, strict=True):
        same = same & F.col(f"`{g}`").eqNullSafe(F.col(k))
    found = sliced.join(F.broadcast(carry), same, "left")
    return found.select(*[F.col(f"`{c}`") for c in columns], (F.col("_at") + F.coalesce("_n", F.lit(0))).alias(name))


def group_medians(
    counts: DataFrame, group: list[str], value: str, freq: str, max_values: int = MAX_GROUP_VALUES
) -> DataFrame:
    """Exact median per group from (group, value, frequency) rows.

    Ordinary groups use the built-in exact percentile with frequencies. Groups with more
    than ``max_values`` distinct values (there are at most rows / max_values of them) are
    ranked in slices, so no aggregation buffer grows with the data.
    """
    known = reliable(counts.where(F.col(value).isNotNull()))
    plain = lambda df: df.groupBy(*group).agg(F.percentile(value, F.lit(0.5), F.col(freq)).alias("median"))
    wide = known.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > max_values).drop("_n")
    if wide.isEmpty():
        return plain(known)
    wide = reliable(wide)
    usual = known.join(wide, group, "left_anti")
    ranked = running_total(known.join(wide, group, "left_semi"), group, [value], freq, "_upto")
    totals = ranked.groupBy(*group).agg(F.max("_upto").alias("_total"))
    placed = ranked.join(totals, group)
    low = F.floor((F.col("_total") + 1) / 2)
    high = F.ceil((F.col("_total") + 1) / 2)
    holds = lambda rank: (F.col("_upto") >= rank) & (F.col("_upto") - F.col(freq) < rank)
    sliced = placed.groupBy(*group).agg(
        (
            (F.max(F.when(holds(low), F.col(value))) + F.max(F.when(holds(high), F.col(value)))) / 2
        ).alias("median")
    )
    return plain(usual).unionByName(sliced)
