"""One row per key.

``row_number() = 1`` filters are turned by Catalyst into a WindowGroupLimit on both sides
of the exchange, so a hot key leaves each map task as one row. The aggregates combine
before the exchange for the same reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricewright.operators.hygiene import drop_zero_quantity, require_keys
from pricewright.operators.probe import flagged


def _pick(df: DataFrame, keys: list[str], ordering: list, hashed: bool = False) -> DataFrame:
    """With ``hashed`` rows are sorted by a hash of the key first: most comparisons then end at one number, where keys
    of several texts that begin alike are compared to their ends. The exchange is of no use to a later join on the keys."""
    columns = [F.col(k) for k in keys]
    window = Window.partitionBy(*([F.xxhash64(*columns)] if hashed else []), *columns).orderBy(*ordering)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def keep_last(df: DataFrame, keys: list[str], order: list[str], hashed: bool = False) -> DataFrame:
    """Last row per key in ``order``; null keys count as equal. ``hashed``: for keys of long texts, see ``_pick``."""
    return _pick(df, keys, [F.col(c).desc_nulls_last() for c in order], hashed)


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return _pick(df, keys, [F.col(c).asc_nulls_first() for c in order])


def consolidate(df: DataFrame, keys: list[str], sums: list[str], order: list[str], batch: str | None = None) -> DataFrame:
    """Sum ``sums`` per key; every other column comes from the key's first row in ``order``.

    One aggregate instead of aggregate + self join. Rows with a null key are dropped and a
    sum over nulls only is 0. With ``batch`` (a file name), each file has rows of its own.
    """
    scope = keys + ([batch] if batch else [])
    attrs = [c for c in df.columns if c not in {*scope, *sums, *order}]
    picked = (
        require_keys(df, keys)
        .groupBy(*scope)
        .agg(
            *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums],
            F.min_by(F.struct(*attrs), F.struct(*order)).alias("_row"),
        )
    )
    return picked.select(*scope, *sums, *[F.col(f"_row.{c}").alias(c) for c in attrs])


def lone_rows(df: DataFrame, keys: list[Column]) -> tuple[DataFrame, DataFrame]:
    """Rows of a stored frame whose key no other row has, and the rest, which holds all rows of every key that repeats.

    Only hashes of the keys are exchanged. Those that come twice go back as a Bloom filter, so a few lone rows may be
    among the rest, but none of the rest among the lone ones.
    """
    hashed = df.withColumn("_h", F.xxhash64(*keys))
    twice = hashed.groupBy("_h").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_h")
    parts = flagged(hashed, twice, ["_h"], "_twin").drop("_h")
    return parts.where("not _twin").drop("_twin"), parts.where("_twin").drop("_twin")


def single(df: DataFrame, keys: list[str], sums: list[str], order: list[str]) -> DataFrame:
    """What ``consolidate`` makes of rows whose keys do not repeat: nothing has to be exchanged."""
    whole = consolidate(df, keys, sums, order)
    kinds = {f.name: f.dataType for f in whole.schema.fields}
    zero = lambda c: F.lit(0.0) if kinds[c].simpleString() == "double" else F.lit(0)  # a sum has no negative zero
    added = [(F.coalesce(F.col(c), zero(c)) + zero(c)).cast(kinds[c]).alias(c) for c in sums]
    return require_keys(df, keys).select(*keys, *added, *[F.col(f"`{c}`") for c in whole.columns if c not in {*keys, *sums}])


def first_file(df: DataFrame, keys: list[str], batch: str) -> DataFrame:
    """Of each key the rows of the first file that holds it, for rows that are unique per key and file.

    That is what loading the files in turn against a growing table amounts to, once every
    file's own rules (netting lines, cleaning keys) have been applied.
    """
    return keep_first(df, keys, [batch]).drop(batch)


def last_in_first_file(df: DataFrame, keys: list[str], order: list[str], batch: str) -> DataFrame:
    """Of each key the last row in ``order`` of the first file that holds it: ``keep_last`` per key and file and then
    ``first_file``, with one exchange."""
    ordering = [F.col(batch).asc_nulls_first(), *[F.col(c).desc_nulls_last() for c in order]]
    return _pick(df, keys, ordering, hashed=True).drop(batch)


def consolidate_sales(df: DataFrame, keys: list[str], order: list[str], batch: str | None = None) -> DataFrame:
    """Sales lines of one bill, time and SKU become one line; lines that net to zero go.

    A line that nets to zero in one file leaves the key to a later file.
    """
    lines = drop_zero_quantity(consolidate(df, keys, ["quantity", "amt"], order, batch))
    return first_file(lines, keys, batch) if batch else lines


def group_min_max(df: DataFrame, key: str = "sku_pk", value: str = "price") -> DataFrame:
    """Price floor and ceiling per key with an empty column for the planned price."""
    return (
        require_keys(df, [key])
        .groupBy(key)
        .agg(F.min(value).alias("price_floor"), F.max(value).alias("price_ceil"))
        .withColumn("new price", F.lit(None).cast("double"))
    )
