import csv
import os
import random
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pricewright.operators import ranked
from pricewright.operators.dedup import keep_last
from pricewright.operators.ranked import reliable, scratch
from pricewright.plans import jobs
from pricewright.schemas import COMPETITOR, PRICE_MASTER, SALES
from pricewright.sources import files, sinks, tables
from pricewright.streaming import landing

SCHEMA = StructType().add("k", "string").add("v", "integer")


def write(path, text, when=None):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    if when:
        os.utime(path, (when.timestamp(), when.timestamp()))


def test_rows_keep_their_file_order(spark, tmp_path):
    write(tmp_path / "in" / "a.csv", "k,v\n" + "".join(f"x,{i}\n" for i in range(5000)))
    write(tmp_path / "in" / "b.csv", "k,v\n" + "".join(f"y,{i}\n" for i in range(50)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = files.read_folder(spark, str(tmp_path / "in"), SCHEMA, level=None, multiLine="false")
        assert df.rdd.getNumPartitions() > 3
        last = {r.k: r.v for r in keep_last(df, ["k"], files.FILE_ORDER).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert last == {"x": 4999, "y": 49} and df.count() == 5050


def test_quoted_newlines_and_doubled_quotes(spark, tmp_path):
    write(tmp_path / "a.csv", 'k,v\n"x\ny",1\n"say ""hi""",2\n"a,b",3\n,4\n')
    rows = [(r.k, r.v) for r in files.read_flat(spark, str(tmp_path / "a.csv"), SCHEMA).collect()]
    assert rows == [("x\ny", 1), ('say "hi"', 2), ("a,b", 3), (None, 4)]


@pytest.fixture
def small_blocks(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def cells(seed, n):
    """Cells with line ends, quotes and commas; some longer than several blocks."""
    rng = random.Random(seed)
    for i in range(n):
        text = "".join(rng.choice(["a", "é", "\n", '"', ",", " ", '""', "\n\n"]) for _ in range(rng.randrange(12)))
        yield (text * (400 if i % 97 == 5 else 1) or None, i)


@pytest.mark.parametrize("seed", range(3))
def test_split_files_give_the_rows_of_whole_ones(spark, tmp_path, small_blocks, seed):
    for name, n in (("a.csv", 400), ("b.csv", 3), ("c.csv", 0)):
        with open(tmp_path / name, "w", newline="") as f:
            out = csv.writer(f, lineterminator="\n")
            out.writerow(["k", "v"])
            out.writerows(cells(seed, n))
            f.write("\n" * (seed == 1))
    whole = files.read_flat(spark, str(tmp_path), SCHEMA)
    split = files.read_flat(spark, str(tmp_path), SCHEMA, split=True)
    show = lambda df: sorted((r._file, r.v, r.k) for r in df.collect())
    assert show(split) == show(whole) and split.count() == 403
    placed = sorted(split.where("_file = 'a.csv'").collect(), key=lambda r: [r[c] for c in files.FILE_ORDER])
    assert [r.v for r in placed] == list(range(400))
    assert len({r._block for r in placed}) > 10
    last = {r.k: r.v for r in keep_last(split.where("_file = 'a.csv'"), ["k"], files.FILE_ORDER).collect()}
    assert last == {k: v for k, v in cells(seed, 400)}


def test_split_files_with_carriage_returns_and_without_a_header(spark, tmp_path, small_blocks):
    (tmp_path / "a.csv").write_bytes(b"".join(b'"x %d ""y""",%d\r\n' % (i, i) for i in range(200)))
    split = files.read_flat(spark, str(tmp_path), SCHEMA, split=True, header="false")
    assert sorted((r.v, r.k) for r in split.collect()) == [(i, f'x {i} "y"') for i in range(200)]


@pytest.mark.parametrize("line", ["x,one", "x", "x,1,2", 'x 12" y,1'])
def test_malformed_rows_fail_a_split_read(spark, tmp_path, line):
    write(tmp_path / "a.csv", f"k,v\ny,1\n{line}\nz,2\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        files.read_flat(spark, str(tmp_path / "a.csv"), SCHEMA, split=True).collect()


@pytest.mark.parametrize("line", ["x,one", "x", "x,1,2"])
def test_malformed_rows_fail_the_read(spark, tmp_path, line):
    write(tmp_path / "a.csv", f"k,v\ny,1\n{line}\n")
    df = files.read_flat(spark, str(tmp_path / "a.csv"), SCHEMA)
    for part in (df, df.select("k")) if "one" not in line else (df,):
        with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
            part.collect()
    assert len(files.read_flat(spark, str(tmp_path / "a.csv"), SCHEMA, mode="DROPMALFORMED").collect()) == 1


def test_nothing_to_read_gives_no_rows(spark, tmp_path):
    write(tmp_path / "a.csv", "k,v\nx,1\n")
    for path, fmt in [(tmp_path / "none", "csv"), (tmp_path / "a.csv", "xlsx")]:
        df = files.read_flat(spark, str(path), SCHEMA, fmt)
        assert df.count() == 0 and df.columns == ["k", "v", *files.FILE_ORDER]
    assert files.read_flat(spark, str(tmp_path), SCHEMA, glob="*.txt").count() == 0


def test_freshness_gate(spark, tmp_path):
    utc = timezone.utc
    write(tmp_path / "today.csv", "k,v\ntoday,1\n", datetime(2025, 3, 15, 0, 0, tzinfo=utc))
    write(tmp_path / "month.csv", "k,v\nmonth,1\n", datetime(2025, 3, 1, 0, 0, tzinfo=utc))
    write(tmp_path / "old.csv", "k,v\nold,1\n", datetime(2025, 2, 28, 23, 59, 59, tzinfo=utc))
    now = datetime(2025, 3, 15, 12, tzinfo=utc)
    read = lambda level, **kw: {
        r.k for r in files.read_flat(spark, str(tmp_path), SCHEMA, level=level, now=now, **kw).collect()
    }
    assert read("day") == {"today"}
    assert read("month") == {"today", "month"}
    assert read(None) == {"today", "month", "old"}
    assert read("month", tz="America/Los_Angeles") == {"today"}


def test_replace_reads_the_table_it_replaces(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    first = sinks.replace_table(df, "repl", str(tmp_path))
    again = sinks.replace_table(spark.table("repl").withColumn("v", F.col("v") + 1), "repl", str(tmp_path))
    assert first != again and spark.table("repl").first().v == 2
    sinks.replace_table(spark.table("repl").withColumn("v", F.col("v") + 1), "repl", str(tmp_path))
    assert spark.table("repl").first().v == 3 and len(os.listdir(tmp_path / "repl")) == 2
    sinks.replace_table(df.withColumn("w", F.lit(True)), "repl", str(tmp_path))
    assert spark.table("repl").columns == ["k", "v", "w"]
    spark.sql("DROP TABLE repl")


def test_append_and_distinct_read(spark):
    rows = spark.createDataFrame([(None,) * len(SALES.input_columns)], SALES.input_schema)
    assert tables.read_table(spark, "sales_a", table=SALES).count() == 0
    for _ in range(2):
        sinks.append_table(rows, "sales_a", SALES, F.lit("2025-01-01").cast("timestamp"))
    assert tables.read_table(spark, "sales_a", table=SALES).schema.names == SALES.columns
    assert tables.read_table(spark, "sales_a", ["bill_num", "sku"], distinct=True).count() == 1
    with pytest.raises(ValueError):
        sinks.append_table(rows.drop("sku"), "sales_a", SALES)
    spark.sql("DROP TABLE sales_a")


def test_reports_skip_empty_frames(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    assert sinks.report_extract({"full": df, "empty": df.limit(0)}, str(tmp_path)) == ["full"]
    assert spark.read.option("header", True).csv(str(tmp_path / "full")).first().k == "a"


def test_a_report_is_one_file_in_the_rows_order(spark, tmp_path):
    rows = [(f'x "{i}"\n,', i) for i in range(500)]
    df = spark.createDataFrame(rows, "`k 1` string, v int").repartitionByRange(7, "v").sortWithinPartitions("v")
    for _ in range(2):  # the second replaces the first
        assert sinks.report_extract({"full": df, "empty": df.limit(0)}, str(tmp_path), one_file=True) == ["full"]
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["full.csv"]
    with open(tmp_path / "full.csv", newline="") as f:
        assert list(csv.reader(f)) == [["k 1", "v"]] + [[k, str(v)] for k, v in rows]


def test_price_parts_follow_the_model(spark):
    models = spark.range(1000).select(F.format_string("m%d", "id").alias("model_no"))
    parts = models.select("model_no", sinks.part_of(PRICE_MASTER))
    assert 200 < parts.select(sinks.PART).distinct().count() <= PRICE_MASTER.parts
    assert parts.where("model_no = 'm5'").first()[sinks.PART] == parts.where("model_no = 'm5'").first()[sinks.PART]


SALES_HEADER = ",".join(SALES.input_columns)


def sale(bill, quantity, status="x"):
    return f"C1 Acme,{bill},Sales Order #9,1/5/2024 3:05 pm,SKU,{quantity},10.0,pm,p,GFCI,Florida,{status},1/1/2020 9:00 am,cat,-0.1"


def test_sales_files_land_one_after_the_other(spark, tmp_path):
    folder, name = tmp_path / "drop", "sales_b"
    run = lambda: landing.land_sales(spark, str(folder), str(tmp_path / "ck"), name).awaitTermination()
    write(folder / "1.csv", "\n".join([SALES_HEADER, sale("B1", 1), sale("B1", 2), sale("B2", 0)]),
          datetime(2025, 1, 1, tzinfo=timezone.utc))
    write(folder / "2.csv", "\n".join([SALES_HEADER, sale("B1", 50), sale("B3", 4)]),
          datetime(2025, 1, 2, tzinfo=timezone.utc))
    run()
    run()
    got = {(r.bill_num, r.quantity, r.customer, r.state_cd, r.sku_cat) for r in spark.table(name).collect()}
    assert got == {("B1", 3, "Acme", "FL", "Electrical Device"), ("B3", 4, "Acme", "FL", "Electrical Device")}
    assert spark.table(name).count() == 2
    spark.sql(f"DROP TABLE {name}")


def test_competitor_files_merge_and_alert(spark, tmp_path):
    folder, name, alerts = tmp_path / "drop", "comp_b", []
    catalog = spark.createDataFrame([], PRICE_MASTER.schema).union(
        spark.sql("select date'2025-01-01','A','d','c','p','s','l',1D,'n',10D,'National',0,9,timestamp'2025-01-01'")
    )
    sinks.replace_table(catalog, "catalog_b", str(tmp_path / "tables"))
    header = ",".join(COMPETITOR.input_columns)
    line = lambda price: f"2025-01-01,Utah,{price},A,R: X,2.5,mAKER,big store,d,ONLINE,rep"
    write(folder / "1.csv", f"{header}\n{line(9.9)}", datetime(2025, 1, 1, tzinfo=timezone.utc))
    write(folder / "2.csv", f"{header}\n{line(8.0)}", datetime(2025, 1, 2, tzinfo=timezone.utc))
    landing.land_competitor_prices(
        spark, str(folder), str(tmp_path / "ck"), name, "catalog_b",
        on_alerts=lambda a: alerts.append([tuple(r) for r in a.collect()]),
    ).awaitTermination()
    row = spark.table(name).collect()
    assert len(row) == 1 and (row[0].mnf_stk_price, row[0].comp_sku, row[0].quantity) == (8.0, "X", 2)
    assert [len(a) for a in alerts] == [0, 1] and alerts[1][0][6] == "20.0%"
    for t in (name, "catalog_b"):
        spark.sql(f"DROP TABLE {t}")


def test_merge_rewrites_only_touched_partitions(spark, tmp_path):
    columns = COMPETITOR.columns
    row = lambda day, sku, price: (date.fromisoformat(day) if day else None, "UT", price, sku, "R", 1, "m", "d", "x", "Online", "r", datetime(2025, 1, 1))
    first = spark.createDataFrame([row("2025-01-01", "a", 1.0), row("2025-02-01", "b", 2.0), row(None, "c", 3.0)], COMPETITOR.schema)
    sinks.merge_partitions(first, first.withColumn("action", F.lit("insert")), "comp_p", COMPETITOR)
    files_of = lambda: {r.f for r in spark.table("comp_p").select(F.input_file_name().alias("f")).collect()}
    before = files_of()
    batch = spark.createDataFrame([row("2025-01-01", "a", 9.0), row("2025-03-01", "n", 4.0), row("2025-02-01", "b", 2.0)], COMPETITOR.schema)
    with scratch(spark):
        merged = jobs._merge(batch.drop("sys_dt"), tables.read_table(spark, "comp_p", table=COMPETITOR), COMPETITOR, ["release_dt"], None)
        assert sinks.merge_partitions(merged.table, merged.actions, "comp_p", COMPETITOR) == ["2025-01", "2025-03"]
    spark.catalog.refreshTable("comp_p")
    got = sorted((r.en_sku, r.mnf_stk_price) for r in spark.table("comp_p").collect())
    assert got == [("a", 9.0), ("b", 2.0), ("c", 3.0), ("n", 4.0)]
    assert len(before & files_of()) == 2 and spark.table("comp_p").columns == [*columns, sinks.PART]
    again = spark.createDataFrame([row("2025-01-01", "a", 8.0)], COMPETITOR.schema)  # a partition that was moved before
    with scratch(spark):
        merged = jobs._merge(again.drop("sys_dt"), tables.read_table(spark, "comp_p", table=COMPETITOR), COMPETITOR, ["release_dt"], None)
        assert sinks.merge_partitions(merged.table, merged.actions, "comp_p", COMPETITOR) == ["2025-01"]
    spark.catalog.refreshTable("comp_p")
    got = sorted((r.en_sku, r.mnf_stk_price) for r in spark.table("comp_p").collect())
    assert got == [("a", 8.0), ("b", 2.0), ("c", 3.0), ("n", 4.0)]
    assert len(tables.read_table(spark, "comp_p", table=COMPETITOR, parts=("2025-01", "2025-01")).collect()) == 1
    spark.sql("DROP TABLE comp_p")


def test_scratch_leaves_nothing_behind(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    with scratch(spark):
        assert reliable(spark.range(5)).count() == 5
        path = ranked._WRITTEN[-1].removeprefix("file:")
        assert os.path.isdir(path)
    assert not os.path.exists(path) and spark.conf.get("spark.checkpoint.dir", None) == shared
