"""Projection, filters and row hygiene."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Layouts tried for the date in a sheet header.
HEADER_DATE_FORMATS = [
    "%Y-%m-%d %H:%M:%S",
    "%Y-%m-%d",
    "%m/%d/%Y %H:%M:%S",
    "%m/%d/%Y",
    "%m/%d/%y",
    "%b %d, %Y",
    "%B %d, %Y",
]


def rename_positional(df: DataFrame, names: list[str]) -> DataFrame:
    """Apply a target column list by position; a width mismatch is an error."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(df.columns)} columns cannot take {len(names)} names")
    return df.toDF(*names)


def rename_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def select_columns(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(*[F.col(f"`{n}`") for n in names])


def require_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Drop rows with any null key. Plain IS NOT NULL filters, so they reach the scan."""
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    return df


def drop_all_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop rows in which every one of ``columns`` is null."""
    return df.dropna("all", subset=columns)


def drop_zero_quantity(df: DataFrame, column: str = "quantity") -> DataFrame:
    """Zero quantities go; returns (negative) stay, and so does an unknown quantity."""
    return df.where(F.col(column).isNull() | (F.col(column) != 0))


def null_default(df: DataFrame, column: str, value: str = "Other") -> DataFrame:
    return df.fillna({column: value})


def with_load_ts(df: DataFrame, column: str, load_ts: Column | None = None) -> DataFrame:
    """Load timestamp as the last column."""
    stamp = F.current_timestamp() if load_ts is None else load_ts
    return df.select(*[c for c in df.columns if c != column], stamp.alias(column))


def period_bounds(level: str, now: datetime, tz: str = "UTC") -> tuple[datetime, datetime]:
    """Start (inclusive) and end (exclusive) of the day or month that holds ``now``."""
    local = now.astimezone(ZoneInfo(tz)) if now.tzinfo else now
    start = local.replace(hour=0, minute=0, second=0, microsecond=0, tzinfo=None)
    if level == "day":
        return start, start + timedelta(days=1)
    if level == "month":
        start = start.replace(day=1)
        return start, (start + timedelta(days=32)).replace(day=1)
    raise ValueError(f"unknown period level {level!r}")


def period_filter(df: DataFrame, column: str, level: str | None, now: datetime, tz: str = "UTC") -> DataFrame:
    """Rows of the current day or month, as a range on the raw column so it is pushed to the scan."""
    if level is None:
        return df
    start, end = period_bounds(level, now, tz)
    as_type = df.schema[column].dataType.simpleString()
    return df.where(
        (F.col(column) >= F.lit(start.isoformat(" ")).cast(as_type))
        & (F.col(column) < F.lit(end.isoformat(" ")).cast(as_type))
    )


def sheet_date(header: str) -> date:
    """Date written in a sheet's column header."""
    for fmt in HEADER_DATE_FORMATS:
        try:
            return datetime.strptime(header.strip(), fmt).date()
        except ValueError:
            continue
    raise ValueError(f"no date in sheet header {header!r}")


def snapshot_sheet(
    df: DataFrame,
    eval_date: date | Column,
    names: list[str],
    order: list[str] | None = None,
    header_rows: int = 2,
) -> DataFrame:
    """Stock snapshot sheet -> tabular rows.

    ``names`` is the full target list: date first, load timestamp last. The sheet
    supplies the columns between by position. The first ``header_rows`` rows in
    ``order`` are sub-headers; rows whose output columns 4..7 are all null are dropped;
    columns 6 up to the one before last become integers, the last stays as read.
    """
    if order and header_rows:
        first = df.select(F.struct(*order).alias("o")).orderBy("o").limit(header_rows)
        df = df.where(F.struct(*order) > first.agg(F.max("o")).scalar())
    data = df.drop(*(order or []))
    width = len(names) - 2
    data = data.select(*[F.col(f"`{c}`") for c in data.columns[:width]])
    stamp = eval_date if isinstance(eval_date, Column) else F.lit(eval_date)
    out = rename_positional(data.select(stamp.cast("date").alias("_date"), "*"), names[:-1])
    out = drop_all_null(out, out.columns[4:8])
    whole = set(out.columns[6:-1])
    return out.select(*[F.col(c).cast("long").alias(c) if c in whole else F.col(c) for c in out.columns])
