"""The landing jobs: cleaning, de-duplication, reconciliation and reports in one plan each.

Every job takes the raw frame and the stored tables and returns frames; writing is the
caller's (``pricewright.sources.sinks``). ``order`` names the columns that hold the file
order of the raw rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewright.functions.cleaning import (
    COLUMN_RULES,
    SALES_RULES,
    apply_rules,
    clean_key,
    clean_landing,
    round_quantity,
    strip,
    to_date_lenient,
)
from pricewright.functions.price_columns import ID_COLUMNS
from pricewright.operators.dedup import consolidate, keep_last, last_in_first_file, lone_rows, single
from pricewright.operators.hygiene import (
    drop_zero_quantity,
    rename_positional,
    require_keys,
    select_columns,
    snapshot_sheet,
    with_load_ts,
)
from pricewright.operators.pricing import pallet_cascade, pricing_alerts, unpivot_prices
from pricewright.operators.ranked import reliable, stored
from pricewright.operators.reconcile import (
    INSERT,
    UPDATE,
    merge_tables,
    new_rows_only,
    skip_loaded_value,
    upsert_files,
    upsert_split,
)
from pricewright.schemas import COMPETITOR, INVENTORY, PRICE_MASTER, PROMO_BASE, PROMO_HISTORY, QUOTES, SALES, Table


@dataclass(frozen=True)
class Merge:
    """``actions``: the cleaned batch with its action per row; ``table``: the table's new state."""

    actions: DataFrame
    table: DataFrame
    alerts: DataFrame | None = None


def clean_batch(raw: DataFrame, table: Table, order: list[str], batch: str | None = None) -> DataFrame:
    """Cleaned rows of a landing file, the last one per key; with ``batch`` per key and file.

    The rules of the keys, and those that can fail, go first; what else a row holds is cleaned when the replaced rows
    are gone.
    """
    keys = list(table.keys)
    early = [(c, rule) for c, rule in COLUMN_RULES if c in keys or rule is round_quantity]
    last = keep_last(clean_landing(raw, keys, early), [*keys, *([batch] if batch else [])], order, hashed=True)
    return apply_rules(last, [r for r in COLUMN_RULES if r not in early])


def sales_rows(raw: DataFrame, order: list[str], batch: str | None = None) -> DataFrame:
    """Consolidated and cleaned sales lines, one per (bill, time, SKU).

    Cleaning the keys can make two lines collide; then the one with the larger raw key stays
    and sums are not redone. With ``batch`` (the file) all that happens inside a file, and
    the first file with a key wins. Without it, lines whose cleaned key no other line has are taken as they are: they
    are found by hashes of the keys, and whole rows move only where a key may repeat.
    """
    if batch:
        return _settled(consolidate(apply_rules(raw, SALES_RULES), list(SALES.keys), SUMS, order, batch), batch)
    lone, rest = lone_rows(require_keys(stored(raw), list(SALES.keys)), [_cleaned_key(raw, k) for k in SALES.keys])
    one = _cleaned(single(apply_rules(lone, SALES_RULES), list(SALES.keys), SUMS, order))
    return one.unionByName(_settled(consolidate(apply_rules(rest, SALES_RULES), list(SALES.keys), SUMS, order)))


SUMS = ["quantity", "amt"]


def _cleaned_key(raw: DataFrame, key: str) -> Column:
    """A sales key as ``sales_rows`` ends with, of a raw row."""
    out = F.col(key)
    for name, rule in SALES_RULES:
        out = rule(out) if name == key else out
    return clean_key(out) if raw.select(out.alias(key)).schema[key].dataType.simpleString() == "string" else out


def _cleaned(lines: DataFrame, extra: list[Column] = ()) -> DataFrame:
    return clean_landing(drop_zero_quantity(lines).select(*SALES.input_columns, *extra), list(SALES.keys))


def _settled(lines: DataFrame, batch: str | None = None) -> DataFrame:
    """Of consolidated lines that collide once their keys are clean, the one with the larger raw key."""
    keys = list(SALES.keys)
    raw_keys = [f"_raw_{k}" for k in keys]
    rows = _cleaned(lines, [*([F.col(batch)] if batch else []), *[F.col(k).alias(r) for k, r in zip(keys, raw_keys)]])
    found = last_in_first_file(rows, keys, raw_keys, batch) if batch else keep_last(rows, keys, raw_keys, hashed=True)
    return found.drop(*raw_keys)


def sales_history_job(raw: DataFrame, stored: DataFrame, order: list[str], batch: str | None = None) -> DataFrame:
    """Sales lines the history does not hold yet. The cleaned lines are read twice, so they are stored first."""
    return new_rows_only(reliable(sales_rows(raw, order, batch)), stored, list(SALES.keys), nullable=[])


def _merge(batch: DataFrame, stored: DataFrame, table: Table, nullable: list[str], load_ts: Column | None) -> Merge:
    """The split reads the cleaned batch twice, and its result feeds the new state and the alerts: both are stored."""
    keys = list(table.keys)
    actions = reliable(upsert_split(reliable(batch), stored, keys, table.tracked, table.guard, nullable))
    return Merge(actions, merge_tables(stored, actions, keys, list(table.set_columns), table.load_column, load_ts))


def quote_job(
    raw: DataFrame, stored: DataFrame, order: list[str], load_ts: Column | None = None, batch: str | None = None
) -> Merge:
    """New state of the quotes. With ``batch`` (the file), every file sees what the earlier ones stored."""
    if batch is None:
        return _merge(select_columns(clean_batch(raw, QUOTES, order), QUOTES.input_columns), stored, QUOTES, [], load_ts)
    keys = list(QUOTES.keys)
    rows = clean_batch(raw, QUOTES, order, batch).select(*QUOTES.input_columns, batch)
    actions = reliable(upsert_files(rows, stored, keys, QUOTES.tracked, QUOTES.guard, list(QUOTES.set_columns), batch, []))
    return Merge(actions, merge_tables(stored, actions, keys, list(QUOTES.set_columns), QUOTES.load_column, load_ts))


def competitor_price_job(
    raw: DataFrame,
    stored: DataFrame,
    catalog: DataFrame,
    order: list[str],
    threshold: float = 0.1,
    load_ts: Column | None = None,
) -> Merge:
    """New state of the competitor prices and the alerts for new and changed ones.

    The release date is parsed after the key check, so it can be null and compares null-safe.
    """
    batch = select_columns(clean_batch(raw, COMPETITOR, order), COMPETITOR.input_columns)
    merged = _merge(batch, stored, COMPETITOR, ["release_dt"], load_ts)
    of = lambda action: merged.actions.where(F.col("action") == action).drop("action")
    alerts = pricing_alerts(of(INSERT), of(UPDATE), catalog, threshold)
    return Merge(merged.actions, merged.table, alerts)


def price_master_rows(raw: DataFrame, order: list[str], cascade_socal: bool = False) -> DataFrame:
    """Wide price list -> one cleaned row per (model, price model, bucket).

    All rows have the same price columns, so of a model's rows the last one settles every key: the others go while a row
    is still wide, before each becomes as many rows as there are price columns.
    """
    model = ID_COLUMNS[PRICE_MASTER.input_columns.index("model_no")]
    cleaned = raw.where(F.col(f"`{model}`").isNotNull()).withColumn("_model", strip(clean_key(F.col(f"`{model}`").cast("string"))))
    cascaded = pallet_cascade(keep_last(cleaned, ["_model"], order).drop("_model"), cascade_socal)
    dated = cascaded.withColumn("src_updt_dt", to_date_lenient(F.col("src_updt_dt")))
    names = [*PRICE_MASTER.input_columns[:9], *order]
    tall = unpivot_prices(dated, carry=order)
    named = tall.toDF(*names, *PRICE_MASTER.input_columns[9:], "ordinal")
    return select_columns(
        clean_batch(named, PRICE_MASTER, [*order, "ordinal"]), PRICE_MASTER.input_columns
    )


def price_master_job(
    raw: DataFrame, stored: DataFrame, order: list[str], cascade_socal: bool = False, load_ts: Column | None = None
) -> Merge:
    return _merge(price_master_rows(raw, order, cascade_socal), stored, PRICE_MASTER, [], load_ts)


def promo_history_job(raw: DataFrame, order: list[str]) -> DataFrame:
    """Promotion rows to append: cleaned, one per (start, end, SKU)."""
    return select_columns(clean_batch(raw, PROMO_HISTORY, order), PROMO_HISTORY.input_columns)


def promo_base_job(raw: DataFrame, load_ts: Column | None = None) -> DataFrame:
    """Rows of the base promotion sheet to append: named by position, typed and stamped, otherwise as they are."""
    stamped = with_load_ts(rename_positional(raw, PROMO_BASE.input_columns), PROMO_BASE.load_column, load_ts)
    return stamped.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in PROMO_BASE.schema.fields])


def inventory_job(raw: DataFrame, eval_date, stored: DataFrame, order: list[str], header_rows: int = 2) -> DataFrame:
    """Stock snapshot rows to append, none when the snapshot's date is stored already."""
    rows = snapshot_sheet(raw, eval_date, INVENTORY.columns, order, header_rows)
    stamp = eval_date if isinstance(eval_date, Column) else F.lit(eval_date)
    return skip_loaded_value(rows, stored, "inv_eval_dt", stamp.cast("date"))
