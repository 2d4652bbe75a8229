"""What jobs compute and move once a batch is large."""

import math

from pyspark.sql import functions as F

from pricewright.functions import cleaning
from pricewright.operators import dedup, probe, ranked, reconcile
from pricewright.plans import jobs
from pricewright.plans.sample import ORDER, sales_landing
from pricewright.schemas import QUOTES
from tests.test_plans import never_broadcast, plan, shuffled_rows  # noqa: F401


def test_stored_files_are_not_written_again(spark):
    files = ranked.reliable(spark.range(10))
    before = len(ranked._WRITTEN)
    assert ranked.stored(files) is files
    few = files.where("id < 5")
    assert ranked.stored(few) is few and len(ranked._WRITTEN) == before
    assert ranked.stored(files.withColumn("id", F.col("id") + 1)).count() == 10 and len(ranked._WRITTEN) == before + 1


def test_a_table_smaller_than_its_batch_is_not_filtered(spark, never_broadcast):  # noqa: F811
    batch = ranked.reliable(spark.range(5000).select(F.col("id").alias("k"), F.lit(1).alias("v")))
    table = ranked.reliable(spark.range(2500, 2600).select(F.col("id").alias("k"), F.lit(2).alias("v")))
    before = len(ranked._WRITTEN)
    new = reconcile.new_rows_only(batch, table, ["k"], nullable=[])
    assert new.count() == 4900 and len(ranked._WRITTEN) == before and "xxhash64" not in plan(new)
    assert reconcile.apply_updates(table, batch, ["k"], ["v"]).agg(F.sum("v")).first()[0] == 100
    assert len(ranked._WRITTEN) == before and probe.needed(table, batch)


def test_replaced_rows_are_gone_before_their_other_columns_are_cleaned(spark):
    rows = spark.createDataFrame([("Q1", "m", "p", "1/2/2025", k) for k in range(3)], "quote_num string, model_no string, price_model string, quote_dt string, _at int")
    batch = jobs.clean_batch(rows, QUOTES, ["_at"])
    assert [(str(r.quote_dt), r._at) for r in batch.collect()] == [("2025-01-02", 2)]
    lines = plan(batch).splitlines()
    at = lambda text: min(k for k, line in enumerate(lines) if text in line)
    assert at("AS quote_dt") < at("Window [row_number") < at("AS quote_num")
    assert "hashpartitioning(_w" in plan(batch)  # sorted by the hash of the keys first


def test_lone_rows(spark):
    rows = ranked.reliable(spark.createDataFrame([(None if k % 50 == 0 else k % 90, f"s{k % 2}", k) for k in range(100)], "a int, b string, n int"))
    lone, rest = dedup.lone_rows(rows, [F.col("a"), F.col("b")])
    keys = [(r.a, r.b) for r in rows.collect()]
    twice = {k for k in keys if keys.count(k) > 1}
    assert not {(r.a, r.b) for r in lone.collect()} & twice
    assert sorted(r.n for r in lone.unionByName(rest).collect()) == list(range(100)) and lone.count() >= 70


def test_single_lines_are_what_consolidation_makes_of_them(spark):
    rows = spark.createDataFrame([("a", -0.0, 1, "x", 3), ("b", None, None, None, 1), ("c", 2.5, 2, "y", 2), (None, 1.0, 1, "z", 4)], "k string, q double, n int, t string, o int")
    got, want = dedup.single(rows, ["k"], ["q", "n"], ["o"]), dedup.consolidate(rows, ["k"], ["q", "n"], ["o"])
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in want.schema]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert math.copysign(1, got.where("k = 'a'").first().q) == math.copysign(1, want.where("k = 'a'").first().q)


def test_sales_lines_without_a_twin_are_not_exchanged(spark, sf):
    raw = ranked.reliable(sales_landing(spark, sf))
    n = raw.count()
    assert max(shuffled_rows(jobs.sales_rows(raw, ORDER))) < n / 2


def test_sales_keys_that_collide_when_clean_keep_the_larger_raw_key(spark, sf):
    raw = ranked.reliable(sales_landing(spark, sf).limit(50))
    twin = raw.withColumns({"bill_num": F.concat("bill_num", F.lit("\t\t")), "amt": F.col("amt") + 1})
    rows, alone = jobs.sales_rows(raw.unionByName(twin), ORDER), jobs.sales_rows(twin, ORDER)
    assert sorted(map(str, rows.collect())) == sorted(map(str, alone.collect()))


def test_dates_are_put_into_one_of_three_shapes(spark):
    texts = ["1/2/2025", "13.2.2025", "1-2-25", "2025/1/2", "20250102", "Jan 2nd, 2025", "2 january 2025", "none", "", None]
    want = ["2025-1-2", "2025-2-13", "2025-1-2", "2025-1-2", "20250102", "2 Jan 2025", "2 Jan 2025", None, "", None]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    assert [r[1] for r in df.select("k", cleaning.date_order(F.col("t"))).orderBy("k").collect()] == want
