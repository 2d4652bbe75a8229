import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pricewright.operators import dedup, reconcile as r
from pricewright.plans import jobs
from pricewright.schemas import SALES

KEY = st.sampled_from(["a", "b", "c", None])
VALUE = st.sampled_from([1.0, 2.0, None])
ROWS = st.lists(st.tuples(KEY, st.integers(0, 2), VALUE), max_size=14)
SCHEMA = "k string, j int, v double"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@settings(max_examples=8, deadline=None)
@given(source=ROWS, target=ROWS, guard=st.sampled_from(["source", "target"]))
def test_split_against_brute_force(spark, source, target, guard):
    source = list({(k, j): (k, j, v) for k, j, v in source}.values())
    out = r.upsert_split(frame(spark, source), frame(spark, target), ["k", "j"], "v", guard)
    want = []
    for k, j, v in source:
        known = [w for a, b, w in target if (a, b) == (k, j)]
        moved = [w for w in known if w != v and (v if guard == "source" else w) is not None]
        want.append((k, j, v, "insert" if not known else "update" if moved else "unchanged"))
    key = lambda t: tuple(map(str, t))
    assert sorted(map(tuple, out.collect()), key=key) == sorted(want, key=key)
    fresh = r.new_rows_only(frame(spark, source), frame(spark, target), ["k", "j"])
    assert sorted(map(tuple, fresh.collect()), key=key) == sorted((w[:3] for w in want if w[3] == "insert"), key=key)


def test_split_wants_a_known_guard(spark):
    with pytest.raises(ValueError):
        r.upsert_split(frame(spark, []), frame(spark, []), ["k"], "v", "both")


def test_merge_is_idempotent(spark):
    table = frame(spark, [("a", 1, 1.0), ("b", 1, None), ("d", 1, 4.0)]).withColumn("ts", F.lit("old"))
    batch = frame(spark, [("a", 1, 2.0), ("b", 1, 3.0), ("c", 1, 5.0), ("d", 1, 4.0)])

    def merge(t, ts):
        actions = r.upsert_split(batch, t, ["k", "j"], "v", "source")
        return r.merge_tables(t, actions, ["k", "j"], ["v"], "ts", F.lit(ts))

    once = merge(table, "new")
    rows = sorted(map(tuple, once.collect()))
    assert rows == [("a", 1, 2.0, "new"), ("b", 1, 3.0, "new"), ("c", 1, 5.0, "new"), ("d", 1, 4.0, "old")]
    assert sorted(map(tuple, merge(once, "again").collect())) == rows


def test_updates_ignore_null_keys(spark):
    table = frame(spark, [(None, 1, 1.0), ("a", 1, 1.0)])
    out = r.apply_updates(table, frame(spark, [(None, 1, 9.0), ("a", 1, 9.0)]), ["k", "j"], ["v"])
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(None, 1, 1.0), ("a", 1, 9.0)], key=str)


def test_batch_is_skipped_whole(spark):
    stored = frame(spark, [("a", 1, 1.0)])
    assert r.skip_loaded_batch(frame(spark, [("a", 1, 1.0), ("b", 2, 1.0)]), stored, "k").count() == 0
    assert r.skip_loaded_batch(frame(spark, [("c", 1, 1.0), ("b", 2, 1.0)]), stored, "k").count() == 2


def test_dedup(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), (None, 1, "p"), (None, 3, "q")], "k string, o int, v string")
    assert sorted(x.v for x in dedup.keep_last(df, ["k"], ["o"]).collect()) == ["q", "y"]
    assert sorted(x.v for x in dedup.keep_first(df, ["k"], ["o"]).collect()) == ["p", "x"]


def test_consolidation(spark):
    rows = [("a", 1.0, None, "x", 2), ("a", 2.0, None, "first", 1), ("b", 1.0, 5.0, "x", 1), ("b", -1.0, 5.0, "x", 2),
            (None, 3.0, 1.0, "x", 1), ("c", None, 1.0, "x", 1), ("d", -2.0, 1.0, "back", 1)]
    df = spark.createDataFrame(rows, "k string, quantity double, amt double, who string, o int")
    got = sorted(map(tuple, dedup.consolidate_sales(df, ["k"], ["o"]).collect()))
    assert got == [("a", 3.0, 0.0, "first"), ("d", -2.0, 1.0, "back")]


def test_first_file_wins_a_key(spark):
    rows = [("a", 1.0, 1.0, "f2", 1), ("a", 5.0, 2.0, "f1", 1), ("a", 6.0, 2.0, "f1", 2), ("b", 1.0, 1.0, "f2", 1),
            ("c", 2.0, 1.0, "f1", 1), ("c", -2.0, 1.0, "f1", 2), ("c", 5.0, 3.0, "f2", 1)]
    df = spark.createDataFrame(rows, "k string, quantity double, amt double, file string, o int")
    got = sorted(map(tuple, dedup.consolidate_sales(df, ["k"], ["o"], batch="file").collect()))
    assert got == [("a", 11.0, 4.0), ("b", 1.0, 1.0), ("c", 5.0, 3.0)]


def test_files_meet_what_earlier_files_stored(spark):
    """The same as one upsert after the other."""
    table = spark.createDataFrame([("s", "x", 1, "t"), ("m", "x", 1, "t"), ("n", None, 1, "t"), ("far", "x", 9, "t")], "k string, stat string, q int, who string")
    rows = [("s", "x", 5, "f1", "1"), ("s", "x", 6, "f2", "2"), ("m", "y", 5, "f1", "1"), ("m", "y", 6, "f2", "2"), ("m", None, 7, "f3", "3"),
            ("m", "z", 8, "f4", "4"), ("n", "y", 5, "f1", "1"), ("new", "a", 1, "f2", "2"), ("new", "a", 2, "f3", "3"), ("new", "b", 3, "f4", "4")]
    files = spark.createDataFrame(rows, "k string, stat string, q int, who string, file string")
    for guard in ("target", "source"):
        state = table.withColumn("ts", F.lit("old"))
        for f in "1234":
            one = files.where(F.col("file") == f).drop("file")
            actions = r.upsert_split(one, state, ["k"], "stat", guard, [])
            state = r.merge_tables(state, actions, ["k"], ["stat", "q"], "ts", F.lit("new"))
        actions = r.upsert_files(files, table, ["k"], "stat", guard, ["stat", "q"], "file", [])
        at_once = r.merge_tables(table.withColumn("ts", F.lit("old")), actions, ["k"], ["stat", "q"], "ts", F.lit("new"))
        assert sorted(map(tuple, at_once.collect())) == sorted(map(tuple, state.collect()))


def test_last_row_of_the_first_file_takes_one_exchange(spark):
    rows = [("a", 2, 9, "late"), ("a", 1, 1, "low"), ("a", 1, 5, "kept"), ("b", None, 1, "none"), ("b", 1, 7, "one"), (None, 3, 2, "null")]
    df = spark.createDataFrame(rows, "k string, file int, o int, v string")
    found = dedup.last_in_first_file(df, ["k"], ["o"], "file")
    apart = dedup.first_file(dedup.keep_last(df, ["k", "file"], ["o"]), ["k"], "file")
    assert sorted(r.v for r in found.collect()) == sorted(r.v for r in apart.collect()) == ["kept", "none", "null"]
    assert "file" not in found.columns
    lines = spark.createDataFrame([], ", ".join([*[f"`{c}` {'double' if c in ('quantity', 'amt', 'discount') else 'string'}" for c in SALES.input_columns], "o int, file int"]))
    steps = jobs.sales_rows(lines, ["o"], "file")._jdf.queryExecution().optimizedPlan().toString()
    assert steps.count("Window [") == 1
