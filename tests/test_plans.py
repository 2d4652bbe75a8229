"""What the physical plans must and must not contain."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pricewright.operators import dedup, hygiene, pricing, probe, reconcile
from pricewright.operators.ranked import reliable
from pricewright.plans.catalog import QUERIES
from pricewright.plans.sample import read
from pricewright.schemas import SALES
from pricewright.sources.files import spread
from pricewright.sources.sinks import append_table
from pricewright.sources.tables import read_table

RELATIONAL = [
    "clean_customer", "clean_state", "parse_dates", "dedup_keep_last", "consolidate_sales", "new_rows_only",
    "upsert_split_source_guard", "merge_tables", "unpivot_prices", "pallet_cascade", "latest_price", "pricing_alerts",
    "competitor_price_job", "sales_history_job", "quote_job", "promo_history_job", "inventory_job", "skip_loaded_batch",
    "customer_features", "standardize", "metric_interval", "tier_rules", "category_share", "price_floor_ceiling",
]


def plan(df, mode="simple"):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


@pytest.mark.parametrize("name", RELATIONAL)
def test_no_cross_join_and_no_python(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in text


def test_period_reaches_the_scan(spark, sf):
    events = read(spark, sf, "events")
    text = plan(hygiene.period_filter(events, "ts", "day", datetime(2024, 1, 15)).select("event_id"), "formatted")
    assert "GreaterThanOrEqual(ts" in text and "LessThan(ts" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text


def test_hot_keys_shrink_before_the_exchange(spark, sf):
    lines = read(spark, sf, "lineitem")
    text = plan(dedup.keep_last(lines, ["l_returnflag"], ["l_shipdate", "l_partkey"]))
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text
    text = plan(dedup.consolidate(lines, ["l_returnflag"], ["l_quantity"], ["l_shipdate"]))
    assert text.count("Exchange") == 1 and "partial_min_by" in text


def test_catalog_lookup_needs_one_column_set(spark, sf):
    text = plan(QUERIES["latest_price"](spark, sf), "formatted")
    assert "l_tax" not in text and "l_orderkey" not in text


def test_hot_sku_is_split_by_the_join(spark):
    """Most competitor rows name one SKU: AQE must split its partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        ids = spark.range(0, 40_000, 1, 8)
        sku = F.when(F.col("id") % 3 != 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 1000).cast("string")))
        text = F.lit("x")
        rows = ids.select(
            F.lit(None).cast("date").alias("release_dt"), text.alias("state_cd"), F.col("id").cast("double").alias("mnf_stk_price"),
            sku.alias("en_sku"), F.sha2(F.col("id").cast("string"), 256).alias("comp_sku"), text.alias("mnf"),
            text.alias("distr_typ"), text.alias("rep_name"),
        )
        models = rows.select("en_sku").distinct()
        catalog = models.select(
            F.lit(None).cast("date").alias("src_updt_dt"), F.col("en_sku").alias("model_no"), text.alias("cat"),
            text.alias("prod_cd"), F.lit(1.0).alias("unit_cost"), F.lit(1.0).alias("unit_price"), text.alias("price_model"),
        )
        alerts = pricing.pricing_alerts(rows.limit(0), rows, catalog)
        assert len(alerts.collect()) == 39_999
        assert "skew=true" in alerts._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in settings:
            spark.conf.unset(k)


def test_scaling_and_scenario_read_a_stored_input(spark, sf):
    """The input is built once; what follows reads its files, without a subquery for each metric."""
    text = plan(QUERIES["standardize"](spark, sf))
    assert text.count("FileScan parquet") == 1 and "Subquery" not in text and "Exchange" not in text
    text = plan(QUERIES["sku_scenario"](spark, sf))
    assert text.count("l_shipdate") == 0 and "Expand" not in text


def test_small_scans_are_spread_and_large_ones_pass(spark, sf):
    lines = read(spark, sf, "lineitem")
    assert "RoundRobinPartitioning" in plan(spread(lines))
    assert "RoundRobinPartitioning" not in plan(spread(lines, most=1000))


def test_a_sales_file_reads_only_its_months(spark):
    rows = spark.createDataFrame([(None, "B1", None, datetime(2024, m, 5), "s", 1, 1.0, *[None] * 8) for m in (1, 2, 3)], StructType(SALES.schema.fields[:-1]))
    append_table(rows, "sales_p", SALES)
    text = plan(read_table(spark, "sales_p", table=SALES, parts=("2024-02", "2024-02")), "formatted")
    assert "PartitionFilters: [isnotnull(_part" in text
    assert read_table(spark, "sales_p", table=SALES, parts=("2024-02", "2024-02")).count() == 1
    spark.sql("DROP TABLE sales_p")


@pytest.fixture
def never_broadcast(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k in settings:
        spark.conf.unset(k)


def shuffled_rows(df):
    """Rows that each exchange of the executed plan wrote, the exchanges of broadcasts left out."""
    df.write.format("noop").mode("overwrite").save()
    found = []

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if name.endswith("QueryStage"):
            return walk(node.plan())
        if name == "Exchange":
            found.append(int(node.metrics().apply("shuffleRecordsWritten").value()))
        for k in range(node.children().size()):
            walk(node.children().apply(k))

    df.collect()
    walk(df._jdf.queryExecution().executedPlan())
    return found


def test_a_large_batch_does_not_shuffle_the_stored_table(spark, never_broadcast):
    stored = reliable(spark.range(100_000).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("s"), F.lit(1).alias("v")))
    batch = reliable(spark.range(0, 200_000, 100).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("s"), F.lit(2).alias("v")))
    split = reconcile.upsert_split(batch, stored, ["k", "s"], "v", "source")
    assert {r.action: r.n for r in split.groupBy("action").agg(F.count(F.lit(1)).alias("n")).collect()} == {"insert": 1000, "update": 1000}
    assert "BroadcastHashJoin" in plan(split) and max(shuffled_rows(split)) < 5_000
    new = reconcile.new_rows_only(batch, stored, ["k", "s"])
    assert new.count() == 1000 and max(shuffled_rows(new)) < 5_000
    state = reconcile.apply_updates(stored, batch, ["k", "s"], ["v"])
    assert state.groupBy().agg(F.count(F.lit(1)), F.sum("v")).first()[:] == (100_000, 101_000)
    assert max(shuffled_rows(state)) < 5_000
    plain = reconcile.apply_updates(stored, batch, ["k", "s"], ["v"], probe=False)
    assert max(shuffled_rows(plain)) >= 100_000


def test_a_small_batch_is_not_probed(spark):
    stored, batch = reliable(spark.range(1000).withColumnRenamed("id", "k")), reliable(spark.range(10).withColumnRenamed("id", "k"))
    assert not probe.needed(batch) and "xxhash64" not in plan(reconcile.new_rows_only(batch, stored, ["k"]))


def test_a_filter_never_loses_a_key(spark):
    rows = [(None if k % 7 == 0 else k, None if k % 5 == 0 else f"s{k}", float(k)) for k in range(3000)]
    df = spark.createDataFrame(rows, "k long, s string, f double")
    batch = df.where("k % 3 = 0 or k is null")
    may = probe.narrowed(batch, df, ["k", "s", "f"], probe=True)[1]
    kept = {tuple(r) for r in may.collect()}
    assert {tuple(r) for r in batch.collect()} <= kept and len(kept) < 1700
    other = batch.withColumn("k", F.col("k").cast("string"))
    assert probe.narrowed(other, df, ["k"], probe=True)[1].count() == 3000
    assert probe.narrowed(batch.limit(0), df, ["k"], probe=True)[1].count() == 0
