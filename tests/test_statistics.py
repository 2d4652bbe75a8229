import hashlib
import itertools
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from pricewright.functions import stats
from pricewright.operators import clusters, features, forecast, profile
from pricewright.operators.ranked import group_medians, running_total


def test_t_values_match_printed_tables():
    for df, t in [(9, 2.262157), (10, 2.228139), (30, 2.042272), (98, 1.984467)]:
        assert stats.t_critical(df) == pytest.approx(t, abs=1e-6)


def test_normality_weights_match_published_ones():
    upper = [0.5739, 0.3291, 0.2141, 0.1224, 0.0399]
    assert list(stats.normality_weights(10))[:4:-1] == pytest.approx(upper, abs=5e-4)
    for n in (11, 25, 99):
        a = stats.normality_weights(n)
        assert sum(v * v for v in a) == pytest.approx(1) and a[0] == -a[-1] and len(a) == n


@pytest.mark.parametrize("n", [10, 11, 12, 20, 50, 99])
def test_critical_w_matches_simulation(n):
    import numpy as np

    rng = np.random.default_rng(7)
    x = np.sort(rng.standard_normal((40_000, n)), axis=1)
    w = (x @ np.array(stats.normality_weights(n))) ** 2 / (x.var(axis=1) * n)
    assert stats.normality_critical(n) == pytest.approx(float(np.quantile(w, 0.05)), abs=2.5e-3)


def test_intervals_by_group_size(spark):
    rng = random.Random(3)
    sizes = {"g9": 9, "g10": 10, "g99": 99, "g100": 100}
    rows = [(g, rng.gauss(5, 2), 1.0, math.exp(rng.gauss(0, 2))) for g, n in sizes.items() for _ in range(n)]
    df = spark.createDataFrame(rows, "g string, bell double, flat double, skew double")
    got = {(r.g, r.metric): r for r in profile.metric_interval(df, "g", ["bell", "flat", "skew"]).collect()}
    assert len(got) == 12
    assert {m: got["g9", m].method for m in ("bell", "flat")} == {"bell": "range", "flat": "range"}
    assert got["g99", "skew"].method == "range" and got["g99", "bell"].method == "student"
    assert got["g100", "skew"].method == "normal" and got["g10", "flat"].method == "student"
    values = [r[1] for r in rows if r[0] == "g99"]
    reach = stats.t_critical(98) * statistics.pstdev(values) / math.sqrt(99)
    assert got["g99", "bell"].hi == pytest.approx(statistics.mean(values) + reach)
    values = [r[1] for r in rows if r[0] == "g9"]
    assert (got["g9", "bell"].lo, got["g9", "bell"].hi) == (min(values), max(values))
    wide = profile.tier_profile(profile.metric_interval(df, "g", ["bell"]), "g", ["bell"]).where("CustTier = 'g9'").first()
    assert wide["bell (95% Conf Interval)"] == f"[{min(values)} - {max(values)}]"


def test_fifth_score_stays_in_the_last_tier(spark):
    metrics = ["day_a", "day_b", "x_freq", "x_discprice"]
    rows = [(g, m, float(-g if m == "day_b" else g)) for g in range(5) for m in metrics]
    df = spark.createDataFrame(rows, "g int, metric string, mean double")
    tiers = {r.g: r.tier for r in profile.rule_based_tiers(df, "g", metrics).collect()}
    assert tiers == {4: "Platium", 3: "Gold", 2: "Silver", 1: "Bronze", 0: "Bronze"}
    with pytest.raises(ValueError):
        profile.metric_families(["day_a", "x_freq"])


def test_share_rounds_half_even(spark):
    df = spark.createDataFrame([("g", c) for c in ["a"] * 1 + ["b"] * 15], "g string, c string")
    got = {r.category: r.share for r in profile.category_share(df, "g", "c").collect()}
    assert got == {"a category %": "6.2%", "b category %": "93.8%"}


def test_running_total_crosses_slices(spark):
    rows = [("hot", i) for i in range(500)] + [("cold", i) for i in range(3)] + [(None, 1)]
    df = spark.createDataFrame(rows, "g string, o int").withColumn("one", F.lit(1))
    out = running_total(df, ["g"], ["o"], "one", "upto").collect()
    assert all(r.upto == r.o + (0 if r.g is None else 1) for r in out) and len(out) == len(rows)


def test_medians_of_wide_groups_are_ranked_in_slices(spark):
    rng = random.Random(1)
    rows = [("hot", float(rng.randint(0, 400)), rng.randint(1, 5)) for _ in range(300)]
    rows = list({r[:2]: r for r in rows}.values()) + [("even", 1.0, 1), ("even", 2.0, 1), ("odd", 3.0, 1), ("nul", None, 4)]
    df = spark.createDataFrame(rows, "g string, v double, n int")
    want = {}
    for g in ("hot", "even", "odd"):
        want[g] = statistics.median(itertools.chain(*[[v] * n for k, v, n in rows if k == g]))
    for limit in (50, 10_000):
        got = {r.g: r.median for r in group_medians(df, ["g"], "v", "n", max_values=limit).collect()}
        assert got == want


def test_codes_are_dense_and_sorted(spark):
    df = spark.createDataFrame([(s,) for s in ["b", "a", "b", None, "C"]], "sku_pk string")
    assert {r.sku_pk: r.code for r in forecast.sku_codes(df).collect()} == {"C": 0, "a": 1, "b": 2, None: -1}


def test_frequency_mode_is_smallest(spark):
    df = spark.createDataFrame([(s,) for s in "aabbcde"], "sku_pk string")
    assert tuple(forecast.sku_frequency(df).first()) == (1.4, 1.0, 1)


def test_folds_are_the_same_however_rows_are_cut(spark):
    rows = [("hot" if i < 203 else f"s{i % 7}", i) for i in range(260)] + [(None, 999)]
    df = spark.createDataFrame(rows, "label string, id int")
    deal = lambda d: {r.id: r.fold for r in forecast.stratified_folds(d, "label", ["id"]).collect()}
    out = deal(df.coalesce(1))
    by_hand = {}
    for label in {r[0] for r in rows}:
        members = sorted((i for n, i in rows if n == label), key=lambda i: hashlib.md5(f"{i}|42".encode()).hexdigest())
        by_hand |= {i: k % 5 for k, i in enumerate(members)}
    assert out == by_hand == deal(df.repartition(9))
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        assert deal(df) == out
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_scores(spark):
    df = spark.createDataFrame([(0.0, 0.0), (10.0, 5.0)], "quantity double, prediction double")
    want = 100 * (0 + 5 / 7.5) / 2
    assert forecast.smape(df, "quantity", "prediction").first()[0] == pytest.approx(want)
    assert forecast.ForecastEvaluator().evaluate(df) == pytest.approx(want)
    many = spark.createDataFrame([(float(i), i + 0.5) for i in range(50)], "quantity double, prediction double")
    mean = 24.5
    r2 = 1 - 50 * 0.25 / sum((i - mean) ** 2 for i in range(50))
    got = forecast.adjusted_r2(many, "quantity", "prediction").first()[0]
    assert got == pytest.approx(1 - (1 - r2) * 49 / (50 - 22 - 1))



def test_scenario_of_large_groups_is_the_same(spark):
    rng = random.Random(4)
    rows = []
    for i in range(300):
        sku = "hot" if i % 3 else f"s{i % 12}"
        row = [sku, *[rng.choice(["x", "y", "z", None]) for _ in forecast.CATEGORICAL], rng.random()]
        rows.append(tuple(row + [rng.choice([None, 1.0, 2.5, rng.random()]) for _ in range(11)]))
    names = ["sku_pk", *forecast.CATEGORICAL, "price", *forecast.MEDIAN_COLUMNS, *forecast.MEAN_COLUMNS[1:]]
    kinds = ["string"] * 6 + ["double"] * 12
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` {k}" for n, k in zip(names, kinds)))
    prices = spark.createDataFrame([("hot", 2.0)], "sku_pk string, `new price` double")
    show = lambda d: sorted(
        (tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in d.collect()), key=lambda r: r[0]
    )
    assert show(forecast.sku_scenario(df, prices)) == show(forecast.sku_scenario(df, prices, max_rows=10))


def test_unsettled_clusters_are_reported(spark):
    points = features.prepare_features(blobs(spark, [14, 3]))
    with pytest.warns(UserWarning, match="still move"):
        clusters.kmeans_min_size(points, 3, size_min=5, restarts=1, iterations=1)


def test_standardize_with_a_constant(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    assert sorted(map(tuple, features.standardize(df, ["a", "b"]).collect())) == [(-1.0, 0.0), (1.0, 0.0)]


def blobs(spark, sizes, seed=5):
    rng = random.Random(seed)
    rows = []
    for i, n in enumerate(sizes):
        rows += [(f"c{i}_{j}", "A" if j % 2 else "B", rng.gauss(8 * i, 1), rng.gauss(-6 * i, 1), rng.gauss(i, 1),
                  rng.gauss(i, 0.2)) for j in range(n)]
    return spark.createDataFrame(
        rows, "customer string, cust_cat string, day_tenure double, day_gap double, x_freq double, x_discprice double"
    )


def test_features_keep_every_level(spark):
    vectors = features.prepare_features(blobs(spark, [6, 6])).collect()
    assert {len(r.features) for r in vectors} == {6}
    assert all(sum(r.features.toArray()[4:]) == 1 for r in vectors)


def test_short_clusters_are_filled_at_least_cost(spark):
    points = features.prepare_features(blobs(spark, [14, 3])).persist()
    rows = points.collect()
    centers = [list(rows[0].features.toArray()), list(rows[-1].features.toArray()), list(rows[5].features.toArray())]
    sizes = 4
    out = clusters.assign_min_size(points, centers, sizes).collect()
    dist = {r.customer: [math.dist(r.features.toArray(), c) ** 2 for c in centers] for r in rows}
    counts = [sum(1 for r in out if r[clusters.LABEL] == i) for i in range(3)]
    assert min(counts) >= sizes and sum(counts) == 17
    cost = sum(dist[r.customer][r[clusters.LABEL]] for r in out)
    assert cost == pytest.approx(cheapest(list(dist.values()), sizes), abs=1e-9)
    points.unpersist()


def cheapest(dist, size):
    """Exact optimum by dynamic programming over how full the clusters are."""
    best = {(0, 0, 0): 0.0}
    for d in dist:
        nxt = {}
        for state, cost in best.items():
            for i in range(3):
                s = tuple(min(size, n + (i == j)) for j, n in enumerate(state))
                nxt[s] = min(nxt.get(s, math.inf), cost + d[i])
        best = nxt
    return best[(size,) * 3]


def test_segmentation_names_every_customer(spark):
    from pricewright.plans.segmentation import segment_gmm, segment_kmeans

    inputs = blobs(spark, [40, 30, 20])
    result = segment_kmeans(inputs, ks=[3, 7], restarts=2, size_min=15)
    assert result.k == 3
    named = result.customers.collect()
    assert len(named) == 90 and {r["cust tier"] for r in named} <= set(profile.TIERS)
    assert result.customers.columns == ["customer", "cust tier", *inputs.columns[1:]]
    assert result.profile.count() == 3 and "x_freq (95% Conf Interval)" in result.profile.columns
    assert segment_gmm(inputs, ks=[3], restarts=1).customers.count() == 90


def test_forecast_end_to_end(spark):
    rng = random.Random(2)
    rows = []
    for i in range(200):
        sku = f"s{i % 8}"
        base = [sku, f"cat{i % 2}", "p", "Other", 1.0 + i % 8, float(i % 5 + 10 * (i % 2)), "A", "Gold"]
        rows.append(tuple(base + [rng.random() for _ in range(11)]))
    names = ["sku_pk", "sku_cat", "prod_cd", "proj_type", "price", "quantity", "cust_cat", "cust_tier",
             *forecast.MEDIAN_COLUMNS, *forecast.MEAN_COLUMNS[1:]]
    kinds = ["string"] * 4 + ["double"] * 2 + ["string"] * 2 + ["double"] * 11
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` {k}" for n, k in zip(names, kinds)))
    folded = forecast.stratified_folds(df, "sku_pk", names, n=2)
    model, report = forecast.rf_tune(folded, {"trees": [3], "depth": [2, 3], "leaf": [1]}, folds=2)
    assert len(report) == 2 and all(0 <= r["smape"] <= 200 for r in report)
    prices = spark.createDataFrame([(f"s{i}", 2.0) for i in range(4)], "sku_pk string, `new price` double")
    scenario = forecast.sku_scenario(df, prices)
    out = forecast.forecast(model, scenario).collect()
    assert len(out) == 8 and {r.sku_pk for r in out if r.forecast_quantity is None} == {f"s{i}" for i in range(4, 8)}
    _, alone = forecast.boost_tune(
        folded, {"trees": [2], "depth": [2], "rate": [0.2], "subsample": [1.0]}, folds=2, categorical_only=True
    )
    assert alone[0]["adjusted_r2"] is not None
