"""Reconcile a deduplicated batch with a stored table.

The stored table is assumed to be far larger than the batch. Every operator first narrows
the table to the batch's keys with an inner or semi join in which the batch is the build
side, so a small batch is broadcast (by runtime size) and the table is scanned without a
shuffle of its rows. Only matched keys travel on. A batch that is too large to broadcast goes
ahead as a Bloom filter of its keys, so that the table's other rows drop out at the scan.

``nullable`` names the key columns that can hold nulls: those compare null-safe, the
others with plain equality, which lets the joins share one hash partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewright.operators.hygiene import with_load_ts
from pricewright.operators.probe import flagged, narrowed, needed
from pricewright.operators.ranked import reliable

INSERT, UPDATE, UNCHANGED = "insert", "update", "unchanged"


def _match(keys: list[str], nullable: list[str] | None) -> Column:
    loose = set(keys if nullable is None else nullable)
    cond = None
    for k in keys:
        mine, theirs = F.col(k), F.col(f"_t_{k}")
        part = mine.eqNullSafe(theirs) if k in loose else mine == theirs
        cond = part if cond is None else cond & part
    return cond


def _target_keys(target: DataFrame, keys: list[str], *more: Column) -> DataFrame:
    return target.select(*[F.col(k).alias(f"_t_{k}") for k in keys], *more)


def new_rows_only(
    source: DataFrame, target: DataFrame, keys: list[str], nullable: list[str] | None = None, probe: bool | None = None
) -> DataFrame:
    """Source rows whose key the target does not hold. ``probe``: see ``probe.narrowed``."""
    cond = _match(keys, nullable)
    source, target = narrowed(source, target, keys, probe)
    known = _target_keys(target, keys).join(source.select(*keys), cond, "left_semi").distinct()
    return source.join(known, cond, "left_anti")


def skip_loaded_batch(source: DataFrame, target: DataFrame, batch: str) -> DataFrame:
    """All or nothing: no source row survives when any of its batch values is already stored."""
    loaded = source.select(batch).distinct().join(target.select(batch).distinct(), batch, "left_semi")
    return source.where(~loaded.exists())


def skip_loaded_value(source: DataFrame, target: DataFrame, batch: str, value: Column) -> DataFrame:
    """As ``skip_loaded_batch`` for a source with one known batch value: only the target is probed."""
    return source.where(~target.where(F.col(batch) == value).exists())


def upsert_split(
    source: DataFrame,
    target: DataFrame,
    keys: list[str],
    tracked: str,
    guard: str,
    nullable: list[str] | None = None,
    probe: bool | None = None,
) -> DataFrame:
    """Source rows with an ``action``: insert (new key), update (tracked value moved), unchanged.

    ``guard='source'`` ignores changes to an unknown source value, ``guard='target'`` those
    from an unknown stored value. A key stored with several tracked values is an update when
    any of them differs. ``source`` must hold one row per key.
    """
    if guard not in ("source", "target"):
        raise ValueError(f"guard must be 'source' or 'target', not {guard!r}")
    cond = _match(keys, nullable)
    source, target = narrowed(source, target, keys, probe)
    stored = _target_keys(target, keys, F.col(tracked).alias("_old"))
    batch = source.select(*keys, F.col(tracked).alias("_new"))
    moved = ~F.col("_new").eqNullSafe(F.col("_old")) & F.col("_new" if guard == "source" else "_old").isNotNull()
    flags = (
        stored.join(batch, cond, "inner")
        .groupBy(*[f"_t_{k}" for k in keys])
        .agg(F.max(moved).alias("_moved"))
    )
    action = (
        F.when(F.col("_moved").isNull(), INSERT).when(F.col("_moved"), UPDATE).otherwise(UNCHANGED)
    )
    return source.join(flags, cond, "left").select(*source.columns, action.alias("action"))


def upsert_files(
    source: DataFrame,
    target: DataFrame,
    keys: list[str],
    tracked: str,
    guard: str,
    set_columns: list[str],
    batch: str,
    nullable: list[str] | None = None,
) -> DataFrame:
    """What ``upsert_split`` of one file after the other, in order of ``batch``, amounts to: one row per key.

    ``source`` must hold one row per key and file, so a key's rows are as few as the files.
    Each file meets the values that the target and the earlier files left: a new key is an
    insert whose set columns later files can still change, a moved tracked value an update.
    """
    if guard not in ("source", "target"):
        raise ValueError(f"guard must be 'source' or 'target', not {guard!r}")
    cond = _match(keys, nullable)
    source, target = narrowed(source, target, keys)
    columns = [c for c in source.columns if c not in {*keys, batch}]
    steps = source.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(batch, *columns))).alias("_steps"))
    # A struct keeps a null value, which collect_set alone would skip.
    values = (
        _target_keys(target, keys, F.struct(F.col(tracked).alias("v")).alias("_old"))
        .join(source.select(*keys).distinct(), cond, "inner")
        .groupBy(*[f"_t_{k}" for k in keys])
        .agg(F.collect_set("_old").alias("_olds"))
    )
    kind = {f.name: f.dataType for f in source.schema.fields}
    row_type = ", ".join(f"`{c}`: {kind[c].simpleString()}" for c in columns)
    state = f"struct<action: string, olds: array<struct<v: {kind[tracked].simpleString()}>>, row: struct<{row_type}>>"

    def step(seen: Column, new: Column) -> Column:
        value = new[tracked]
        known = lambda old: (value if guard == "source" else old["v"]).isNotNull()
        moved = F.exists(seen["olds"], lambda old: ~value.eqNullSafe(old["v"]) & known(old))
        now = F.array(F.struct(value.alias("v")))
        whole = F.struct(*[new[c].alias(c) for c in columns])
        changed = F.struct(*[(new[c] if c in set_columns else seen["row"][c]).alias(c) for c in columns])
        later = F.when(seen["action"] == INSERT, INSERT).otherwise(UPDATE)
        first = F.struct(F.lit(INSERT).alias("action"), now.alias("olds"), whole.alias("row"))
        after = F.struct(
            later.alias("action"), now.alias("olds"), F.when(seen["row"].isNull(), whole).otherwise(changed).alias("row")
        )
        rest = F.struct(seen["action"].alias("action"), seen["olds"].alias("olds"), F.coalesce(seen["row"], whole).alias("row"))
        out = F.when(seen["action"].isNull(), first).when(moved, after).otherwise(rest)
        return out.cast(state)

    start = F.struct(
        F.when(F.col("_olds").isNotNull(), F.lit(UNCHANGED)).alias("action"), F.col("_olds").alias("olds"), F.lit(None).alias("row")
    ).cast(state)
    folded = steps.join(values, cond, "left").select(*keys, F.aggregate("_steps", start, step).alias("_end"))
    rows = {c: F.col(c) if c in keys else F.col(f"_end.row.{c}").alias(c) for c in source.columns if c != batch}
    return folded.select(*rows.values(), F.col("_end.action").alias("action"))


def apply_updates(
    target: DataFrame, updates: DataFrame, keys: list[str], set_columns: list[str], probe: bool | None = None
) -> DataFrame:
    """Set columns where the key matches; plain equality, so null keys never match.

    ``updates`` must hold one row per key. Where they are too many to broadcast, only the rows whose
    key they may hold are joined; the others pass as they are, from a scan of their own.
    """
    if needed(updates, target) if probe is None else probe:
        updates = reliable(updates)
        parts = flagged(target, updates, keys)
        joined = apply_updates(parts.where("_may").drop("_may"), updates, keys, set_columns, probe=False)
        return joined.unionByName(parts.where("not _may").drop("_may"))
    new = updates.select(
        *[F.col(k).alias(f"_t_{k}") for k in keys],
        *[F.col(c).alias(f"_n_{c}") for c in set_columns],
        F.lit(True).alias("_hit"),
    )
    types = {f.name: f.dataType for f in target.schema.fields}
    return target.join(new, _match(keys, []), "left").select(
        *[
            F.when(F.col("_hit"), F.col(f"_n_{c}").cast(types[c])).otherwise(F.col(c)).alias(c)
            if c in set_columns
            else F.col(c)
            for c in target.columns
        ]
    )


def merge_tables(
    target: DataFrame,
    actions: DataFrame,
    keys: list[str],
    set_columns: list[str],
    load_column: str,
    load_ts: Column | None = None,
    probe: bool | None = None,
) -> DataFrame:
    """New state of the target: updates applied, inserts added, both stamped."""
    stamped = with_load_ts(actions, load_column, load_ts)
    updates = stamped.where(F.col("action") == UPDATE)
    inserts = stamped.where(F.col("action") == INSERT).drop("action")
    types = {f.name: f.dataType for f in target.schema.fields}
    inserts = inserts.select(*[F.col(c).cast(types[c]).alias(c) for c in inserts.columns if c in types])
    return union_all(apply_updates(target, updates, keys, [*set_columns, load_column], probe), inserts)


def union_all(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of both, matched by column name; a column one side lacks is null there."""
    return a.unionByName(b, allowMissingColumns=True)


def is_member(df: DataFrame, members: DataFrame, key: str) -> DataFrame:
    return df.join(members.select(key), key, "left_semi")
