import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pricewright.functions import price_columns as pc
from pricewright.operators import pricing
from pricewright.plans import jobs


@pytest.mark.parametrize(
    "name,model,lower,upper",
    [
        ("Out-of-state Project1 (0-99)", "Out-of-state Project", 0, 99),
        ("Out-of-state Project2 ( 100 - 499 )", "Out-of-state Project", 0, 99999999),
        ("Out-of-state Project2 ( 100-499)", "Out-of-state Project", 100, 499),
        ("Out-of-state Project4 1000+", "Out-of-state Project", 1000, 99999999),
        ("SoCal Project 12", "SoCal Project", 2, 99999999),
        ("Standard Price", "Standard Price", 0, 99999999),
        ("Sun Valley Pricing", "Sun Valley Price", 0, 99999999),
        ("Wesco Pricing - no rebates", "Wesco", 0, 99999999),
    ],
)
def test_names(name, model, lower, upper):
    p = pc.parse_price_column(name)
    assert (p.model, p.lower, p.upper) == (model, lower, upper)


def test_price_columns():
    assert pc.is_price_column("SoCal Project 1 (0-9)") and not pc.is_price_column("SoCal Project1 (0-9)")
    assert not pc.is_price_column("Out-of-state Pallet price") and pc.is_price_column("CED Price")


COLUMNS = [
    "Out-of-state Project1 (0-9)", "Out-of-state Project2 ( 10 - 24 )", "Note", "Out-of-state Project3 25",
    "SoCal Project1 (0-19)", "SoCal Project2 (20-49)", "Out-of-state Project5 (10-45)", "Out-of-state Pallet price",
    "Out-of-state Project6 (46-99)",
]


def fold(prices, quantity, socal):
    """Left to right by hand, one row."""
    out, region, rate = list(prices), None, None
    for i, name in enumerate(COLUMNS):
        p = pc.parse_pallet_column(name)
        if p is None:
            continue
        if p.region != region:
            region, rate = p.region, None
        if region == "socal" and not socal:
            continue
        if rate is not None:
            out[i] = rate
        elif quantity is not None and p.lower < quantity < p.upper:
            rate = prices[i]
    return out


@settings(max_examples=5, deadline=None)
@given(seed=st.integers(0, 10_000), socal=st.booleans())
def test_cascade_equals_a_fold(spark, seed, socal):
    rng = random.Random(seed)
    quantities = [None, 0.0, 9.0, 10.0, 45.0, 46.0] + [float(rng.randint(0, 120)) for _ in range(30)]
    rows = [[round(rng.uniform(1, 9), 2) for _ in COLUMNS] + [q] for q in quantities]
    schema = ", ".join(f"`{c}` double" for c in [*COLUMNS, pc.PALLET_QUANTITY])
    out = pricing.pallet_cascade(spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + schema), socal)
    got = [list(r)[1:-1] for r in out.orderBy("i").collect()]
    assert got == [fold(r[:-1], r[-1], socal) for r in rows]


def test_unpivot_gives_rows_times_columns(spark):
    columns = [*pc.ID_COLUMNS, "Standard Price", "CED Price", "Out-of-state Pallet price"]
    rows = [tuple(f"m{i}" for _ in pc.ID_COLUMNS) + (1.0, None, 3.0) for i in range(4)]
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` {'string' if i < 9 else 'double'}" for i, c in enumerate(columns)))
    assert pricing.unpivot_prices(df).count() == 8


CATALOG = "src_updt_dt date, model_no string, cat string, prod_cd string, unit_cost double, unit_price double, price_model string"
COMPETITOR = (
    "release_dt date, state_cd string, mnf_stk_price double, en_sku string, comp_sku string, mnf string, "
    "distr_typ string, rep_name string"
)


def catalog(spark, rows):
    df = spark.createDataFrame([(d, m, "c", "p", 1.0, u, pm) for d, m, u, pm in rows], CATALOG.replace("date", "string"))
    return df.withColumn("src_updt_dt", F.to_date("src_updt_dt"))


def test_latest_price_prefers_dates_then_breaks_ties(spark):
    rows = [(None, "a", 9.0, "x"), ("2024-01-01", "a", 5.0, "y"), ("2024-01-01", "a", 4.0, "y"),
            ("2024-01-01", "a", 7.0, None), (None, "b", 3.0, "z")]
    got = {r.model_no: (str(r.src_updt_dt), r.unit_price) for r in pricing.latest_price(catalog(spark, rows)).collect()}
    assert got == {"a": ("2024-01-01", 4.0), "b": ("2000-01-01", 3.0)}


def test_alerts_at_the_threshold(spark):
    prices = catalog(spark, [(None, "a", 10.0, "x"), (None, "zero", 0.0, "x"), (None, "null", None, "x")])
    rows = [(None, "s", p, sku, "c", "m", "d", "r") for sku, p in
            [("a", 9.0), ("a", 9.5), ("a", 11.25), ("a", None), ("zero", 5.0), ("null", 5.0), ("other", 1.0)]]
    new = spark.createDataFrame(rows[:2], COMPETITOR)
    updated = spark.createDataFrame(rows[2:], COMPETITOR)
    out = pricing.pricing_alerts(new, updated, prices)
    assert out.columns[2:7] == ["Competitor Model No", "Manufacturer", "EN Price", "Competitor Price", "Price Variance Ratio"]
    got = sorted((r["Competitor Price"], r["Price Variance Ratio"]) for r in out.collect())
    assert got == [(9.0, "10.0%"), (11.25, "12.5%")]


def test_rows_of_a_model_go_before_they_are_unpivoted(spark, monkeypatch):
    """The last row of a model settles all its keys; rows that another one replaces are not multiplied by the price columns."""
    ids = [f"`{c}` string" for c in pc.ID_COLUMNS]
    schema = ", ".join([*ids, "`Pallet Quantity` double", "`Standard Price` double", "`CED Price` double", "_o int"])
    row = lambda model, price, o: ("2025-02-01", model, *["t"] * 5, "1.5", "t", None, price, price and price + 1, o)
    rows = [row("a", 1.0, 1), row("a\u00a0", 2.0, 3), row(" a", 3.0, 2), row("b", None, 4), row(None, 9.0, 5), row("b", 7.0, 1)]
    unpivoted, real = [], jobs.unpivot_prices

    def seen(df, carry):
        unpivoted.append(df)
        return real(df, carry)

    monkeypatch.setattr(jobs, "unpivot_prices", seen)
    out = jobs.price_master_rows(spark.createDataFrame(rows, schema), ["_o"])
    found = {(r.model_no, r.price_model): r.unit_price for r in out.collect()}
    assert found == {("a", "Standard Price"): 2.0, ("a", "CED"): 3.0, ("b", "Standard Price"): None, ("b", "CED"): None}
    assert unpivoted[0].count() == 2
