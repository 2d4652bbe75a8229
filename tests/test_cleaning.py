from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from pricewright.functions import cleaning as c
from pricewright.functions.text import exact_tenth_text, fixed_text, float_text
from pricewright.operators.hygiene import period_bounds, rename_positional, sheet_date, snapshot_sheet


def apply(spark, rule, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.select("i", rule(F.col("v")).alias("o")).orderBy("i").select("o").collect()]


CASES = [
    (c.clean_key, ["  a​b\t", "﻿x\n", " a b ", " q　", "plain", None],
     ["ab", "x", "a b", "q", "plain", None]),
    (c.after_colon, ["a: b:c", "none", "x:", ":\t y", "a: l1\nl2", None], ["b:c", "none", "", "y", "l1", None]),
    (c.state_code, ["Florida", "florida", "Costa Rica", "ny", None], ["FL", "FLORIDA", "CR", "NY", None]),
    (c.state_prefix, ["N.Y. state", "fLx", "CA", "Texas", None], ["NY", "FL", "CA", "Texas", None]),
    (c.capitalize, ["aBC dEF", "", None], ["Abc def", "", None]),
    (c.title_words, ["foo-bar BAZ", "a  b"], ["Foo-bar Baz", "A  B"]),
    (c.customer_name, ["C12 Acme", "C12", "C12 Top : Sub : X", "C1  lead", "", None],
     ["Acme", "", "Sub : X", " lead", "", None]),
    (c.combo_sku, ["Combo A", "XCombo", "combo", "Other"], ["combo A", "xCombo", "combo", "Other"]),
    (c.strip_prefix, ["Sales Order #12", "12", None], ["12", "12", None]),
    (c.category_rollup, ["GFCI", "EV", "Timers", "gfci", None],
     ["Electrical Device", "Smart Home", "Energy Mangement", "Other", "Other"]),
    (lambda x: c.label_fix("category", x), ["Discontinued item", "New", None], ["Discontinued", "New", None]),
    (lambda x: c.label_fix("promo_reason", x), ["Disontinued", "Slow"], ["Discontinued", "Slow"]),
    (c.to_date_lenient,
     ["2025-03-01", "2025-03-01 10:30:00", "2025-03-01T10:30:00", "3/1/2025", "3/1/2025 4:05", "03-01-2025",
      "2025/3/1", "3/1/25", "20250301", "Mar 1, 2025", "March 1, 2025", "1 Mar 2025", "2025-02-31", "soon", "", None],
     [date(2025, 3, 1)] * 12 + [None] * 4),
]


@pytest.mark.parametrize("rule,given,want", CASES)
def test_text_rules(spark, rule, given, want):
    assert apply(spark, rule, given) == want


def test_number_rules(spark):
    assert apply(spark, c.round_quantity, [0.5, 1.5, 2.5, -0.5, None], "double") == [0, 2, 2, 0, None]
    assert apply(spark, c.discount, [-0.2, 0.3, None], "double") == [0.2, 0.3, 0.0]


def test_erp_time_keeps_the_stored_reading(spark):
    given = ["1/5/2024 3:05 pm", "12/31/2024 11:00 am"]
    assert apply(spark, c.parse_erp_ts, given) == [datetime(2024, 1, 5, 3, 5), datetime(2024, 12, 31, 11)]
    clock = apply(spark, lambda x: c.parse_erp_ts(x, meridiem=True), given)
    assert clock == [datetime(2024, 1, 5, 15, 5), datetime(2024, 12, 31, 11)]


def test_erp_time_rejects_bad_text(spark):
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP"):
        apply(spark, c.parse_erp_ts, ["yesterday"])


def test_report_text(spark):
    assert apply(spark, lambda x: fixed_text(x, 1), [12.25, 12.0, 1e9], "double") == ["12.2", "12.0", "1000000000.0"]
    values = [12345678.9, 0.0005, 1.0, 0.1 + 0.2, -3.5, 0.0, 5e-05, 1.25e-07, -2e-10, 1e16, 1.5e22, 1e-100]
    assert apply(spark, float_text, values, "double") == [repr(v) for v in values]


def test_percent_rounds_the_binary_value(spark):
    values = [12.35, 10.05, 0.25, 0.75, 0.05, 0.15, 99.95, 12.0, 1234.449999, 1e9 + 0.35, 0.0, 33.65, 7.85]
    values += [k / 40 for k in range(0, 4000, 7)]
    assert apply(spark, exact_tenth_text, values, "double") == [str(round(v, 1)) for v in values]


@pytest.mark.parametrize("text, want", [
    ("1-Feb-2025", date(2025, 2, 1)), ("Feb 1 2025", date(2025, 2, 1)), ("1 February 2025", date(2025, 2, 1)),
    ("25/12/2025", date(2025, 12, 25)), ("2025.02.01", date(2025, 2, 1)), ("Sept 3, 2024", date(2024, 9, 3)),
    ("12/25/2025", date(2025, 12, 25)), ("25.12.25", date(2025, 12, 25)), ("2/1/2025", date(2025, 2, 1)),
    ("soon", None), ("Febber 1 2025", None), ("32/12/2025", None), (None, None), ("2025-02-01T10:00:00", date(2025, 2, 1)),
])
def test_dates_in_many_layouts(spark, text, want):
    assert apply(spark, c.to_date_lenient, [text]) == [want]


def test_rules_chain_and_keys_are_required(spark):
    df = spark.createDataFrame(
        [(" A: b ", "Utah", 2.5), (None, "x", 1.0)], "comp_sku string, state_cd string, quantity double"
    )
    assert [tuple(r) for r in c.clean_landing(df, ["comp_sku"]).collect()] == [("b", "UT", 2)]


def test_positional_names(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert rename_positional(df, ["x", "y"]).columns == ["x", "y"]
    with pytest.raises(ValueError):
        rename_positional(df, ["x"])


def test_periods():
    now = datetime(2024, 12, 31, 23, 30)
    assert period_bounds("day", now) == (datetime(2024, 12, 31), datetime(2025, 1, 1))
    assert period_bounds("month", now) == (datetime(2024, 12, 1), datetime(2025, 1, 1))


def test_snapshot_skips_sub_headers_and_blank_rows(spark):
    names = ["d", "c1", "c2", "c3", "c4", "c5", "c6", "c7", "c8", "ts"]
    rows = [
        ("h", "h", "h", "h", "h", "h", "h", 0.0, "note", 0),
        ("h", "h", "h", "h", "h", "h", "h", 0.0, "note", 1),
        ("1", "b", "c", "s", None, "7", "8", 1.5, "note", 2),
        ("2", "b", "c", None, None, None, None, 2.5, "note", 3),
    ]
    header = "a string, b string, c string, `2025-01-31 00:00:00` string, e string, f string, g string, z double, x string, pos int"
    sheet = spark.createDataFrame(rows, header)
    out = snapshot_sheet(sheet, sheet_date(sheet.columns[3]), names, order=["pos"])
    got = [tuple(r) for r in out.collect()]
    assert got == [(date(2025, 1, 31), "1", "b", "c", "s", None, 7, 8, 1.5)]
    assert dict(out.dtypes)["c6"] == "bigint" and dict(out.dtypes)["c8"] == "double"
