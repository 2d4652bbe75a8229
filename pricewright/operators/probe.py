"""A Bloom filter of a batch's keys, applied where the stored table is scanned.

A batch that is too large to broadcast would make a join shuffle the whole stored table. Its keys fit a table of 64-bit
words, though: a key sets four bits of one word. The words have a size that is bounded whatever the batch, so they are
broadcast, and the rows of the stored table whose bits are not all set drop out in the task that reads them. What is
left, the matches and few others, goes on to the join, which decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewright.operators.ranked import reliable, stored

WORDS = 1 << 20  # 16 MB at most; a batch of more than 4 million keys lets more rows through
INEXACT = ("float", "double")  # equal values may hash differently


def _spot(columns: list[Column]) -> tuple[Column, Column]:
    """The word of a key, and its bits there."""
    h = F.xxhash64(F.lit(1), *columns)
    bits = None
    for k in range(4):
        place = F.shiftrightunsigned(h, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), place)
        bits = bit if bits is None else bits.bitwiseOR(bit)
    return F.pmod(F.xxhash64(F.lit(2), *columns), F.lit(WORDS)), bits


def _usable(target: DataFrame, batch: DataFrame, keys: list[str]) -> list[str]:
    """Keys that hash alike on both sides."""
    kinds = [{f.name: f.dataType.simpleString() for f in df.schema.fields} for df in (target, batch)]
    return [k for k in keys if kinds[0][k] == kinds[1][k] and kinds[0][k] not in INEXACT]


def planned_size(df: DataFrame) -> int:
    """Bytes, as the planner estimates them."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(spark: SparkSession) -> int:
    """Bytes up to which the planner broadcasts; negative if it never does."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower()
    number = text.rstrip("bkmgtp")
    return int(number) << 10 * "bkmgtp".index((text[len(number) :] or "b")[0])


def needed(batch: DataFrame, target: DataFrame | None = None) -> bool:
    """Whether the planner takes the batch for too large to broadcast, and the target for larger than the batch: what a
    filter can spare is the exchange of the target, at most."""
    size = planned_size(batch)
    return size > broadcast_limit(batch.sparkSession) and (target is None or planned_size(target) > size)


def filter_words(batch: DataFrame, keys: list[str]) -> DataFrame:
    """_word, _bits of the batch's keys: as many rows as there are keys, and no more than WORDS."""
    word, bits = _spot([F.col(f"`{k}`") for k in keys])
    found = batch.select(word.alias("_word"), bits.alias("_bits")).groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))
    return reliable(found)


def flagged(target: DataFrame, batch: DataFrame, keys: list[str], name: str = "_may") -> DataFrame:
    """The target with a flag that is true wherever the batch may hold the row's key; nulls are equal here."""
    usable = _usable(target, batch, keys)
    if not usable:
        return target.withColumn(name, F.lit(True))
    found = filter_words(batch, usable)
    word, bits = _spot([F.col(f"`{k}`") for k in usable])
    probed = target.withColumns({"_spot": word, "_own": bits}).join(F.broadcast(found), F.col("_spot") == F.col("_word"), "left")
    may = F.coalesce(F.col("_bits").bitwiseAND(F.col("_own")) == F.col("_own"), F.lit(False))
    return probed.select(*[F.col(f"`{c}`") for c in target.columns], may.alias(name))


def narrowed(source: DataFrame, target: DataFrame, keys: list[str], probe: bool | None = None) -> tuple[DataFrame, DataFrame]:
    """The source, stored, and the rows of the target whose keys it may hold; both as they are if the source is small
    enough to broadcast. ``probe`` forces or forbids the filter."""
    if not (needed(source, target) if probe is None else probe):
        return source, target
    source = stored(source)
    return source, flagged(target, source, keys).where("_may").drop("_may")
