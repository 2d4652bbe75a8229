import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricewright.operators import forecast, ranked, search, trees
from pricewright.operators.trees import DEEPEST, Feature

FEATURES = [Feature(4), Feature(3), Feature(6, ordered=True)]


def fixture(seed, n=200):
    rng = random.Random(seed)
    codes = np.array([[rng.randrange(f.codes + 1) for f in FEATURES] for _ in range(n)])
    y = np.array([rng.randrange(20) + 4.0 * (c[0] == 2) + 3.0 * (c[2] > 3) for c in codes])
    w = np.array([float(rng.randrange(4)) for _ in range(n)])
    return codes, y, w


def brute(rows, l2, least, deep, depth=0):
    """Nested (value, split, yes, no) of (codes, weight, gradient) rows, by trying every split."""
    h, g = sum(r[1] for r in rows), sum(r[2] for r in rows)
    value, best = (-g / (h + l2) if h + l2 > 0 else 0.0), (1e-6, None)
    for j, f in enumerate(FEATURES) if depth < deep else ():
        for code in range(0 if f.ordered else 1, f.codes + 1):
            sides = [[], []]
            for r in rows:
                sides[not (r[0][j] <= code if f.ordered else r[0][j] == code)].append(r)
            (hl, gl), (hr, gr) = [(sum(r[1] for r in s), sum(r[2] for r in s)) for s in sides]
            if min(hl, hr) >= least and min(hl, hr) > 0:
                gain = gl * gl / (hl + l2) + gr * gr / (hr + l2) - g * g / (h + l2)
                if gain > best[0] * (1 + 1e-9):
                    best = (gain, (j, code, sides))
    if best[1] is None:
        return value, None, None, None
    j, code, sides = best[1]
    return value, (j, code), brute(sides[0], l2, least, deep, depth + 1), brute(sides[1], l2, least, deep, depth + 1)


def nested(model, node):
    if model.feature[node] < 0:
        return pytest.approx(model.value[node]), None, None, None
    split = (model.feature[node], model.code[node])
    return pytest.approx(model.value[node]), split, nested(model, model.yes[node]), nested(model, model.no[node])


@pytest.mark.parametrize("l2, least, deep", [(0.0, 5.0, DEEPEST), (1.0, 1.0, 3), (1.0, 0.0, DEEPEST), (0.0, 25.0, 2)])
def test_splits_and_leaf_values_are_those_of_all_tries(l2, least, deep):
    for seed in range(3):
        codes, y, w = fixture(seed)
        model = trees.grow(codes, FEATURES, w[None], -(w * y)[None], l2, np.array([least]), np.array([deep]))
        want = brute([(c, a, -a * b) for c, a, b in zip(codes, w, y, strict=True) if a > 0], l2, least, deep)
        assert want == nested(model, 0)


def test_many_trees_grow_as_each_alone():
    codes, y, _ = fixture(7)
    rng = np.random.default_rng(1)
    w = rng.poisson(1.0, (6, len(codes))).astype(float)
    least, deep = np.array([1.0, 2, 5, 1, 2, 5]), np.array([2, 3, 9, DEEPEST, 1, 0])
    together = trees.grow(codes, FEATURES, w, -w * y, 0.0, least, deep)
    for t in range(6):
        alone = trees.grow(codes, FEATURES, w[t : t + 1], -w[t : t + 1] * y, 0.0, least[t : t + 1], deep[t : t + 1])
        assert nested(alone, 0) == nested(together, t)


def test_staged_scores_are_those_of_separate_fits():
    codes, y, _ = fixture(8)
    w = np.random.default_rng(2).poisson(1.0, (4, len(codes))).astype(float)
    fit = lambda d: trees.grow(codes, FEATURES, w, -w * y, 0.0, np.full(4, 2.0), np.full(4, d))
    depths = [1, 2, 4, DEEPEST]
    staged = fit(DEEPEST).staged(codes, FEATURES, depths)
    for k, d in enumerate(depths):
        assert staged[k] == pytest.approx(fit(d).staged(codes, FEATURES, [DEEPEST])[0])


def table(spark, codes, w, y):
    rows = [(c.tolist(), a.tolist(), (-a * b).tolist()) for c, a, b in zip(codes, w.T, y, strict=True)]
    return spark.createDataFrame(rows, "codes array<int>, h array<double>, g array<double>").repartition(5)


def test_trees_grown_on_a_table_are_the_same(spark):
    codes, y, _ = fixture(9)
    w = np.random.default_rng(3).poisson(1.0, (3, len(codes))).astype(float)
    least, deep = np.array([1.0, 4, 2]), np.array([DEEPEST, 3, 5])
    local = trees.grow(codes, FEATURES, w, -w * y, 0.0, least, deep)
    spread = trees.grow_spread(table(spark, codes, w, y), FEATURES, 3, 0.0, least, deep)
    assert all(nested(spread, t) == nested(local, t) for t in range(3))


def test_boosting_goes_down_the_gradient(spark):
    codes, y, w = fixture(10, 120)
    weights, sums = np.broadcast_to(w, (5, 2, len(w))), np.broadcast_to(w * y, (5, 2, len(w)))
    base, rates, deep = (w * y).sum() / w.sum(), np.array([0.3, 1.0]), np.array([2, 3])
    found, rounds = trees.boost(codes, FEATURES, weights, sums, base, rates, 1.0, 1.0, deep, [2, 5])
    p = np.full(len(w), base)
    for r in range(5):  # the first sequence by hand
        rows = [(c, a, a * (q - b)) for c, a, b, q in zip(codes, w, y, p, strict=True) if a > 0]
        model = trees.grow(codes, FEATURES, w[None], (w * (p - y))[None], 1.0, np.array([1.0]), np.array([2]))
        assert brute(rows, 1.0, 1.0, 2) == nested(model, 0)
        p = p + 0.3 * model.staged(codes, FEATURES, [DEEPEST])[0, 0]
        if r + 1 in (2, 5):
            assert found[(2, 5).index(r + 1), 0] == pytest.approx(p)
    error = lambda q: (w * (y - q) ** 2).sum()
    assert error(found[1, 1]) < error(found[0, 1]) < error(np.full(len(w), base))
    rows = [(c.tolist(), [float(a)] * 5, [float(a * b)] * 5) for c, a, b in zip(codes, w, y, strict=True)]
    cells = spark.createDataFrame(rows, "codes array<int>, w array<double>, s array<double>")
    spread = trees.boost_spread(cells, FEATURES, float(base), 0.3, 1.0, 1.0, 2, 3)
    assert all(nested(a, 0) == nested(b, 0) for a, b in zip(spread, rounds, strict=False))


def sales(spark, n=400):
    rng = random.Random(11)
    rows = []
    for i in range(n):
        sku = f"s{i % 9}"
        price = rng.choice([1.0, 2.0, 3.0, None])
        q = float(rng.randrange(10) + 5 * (i % 9 == 4) + (0 if price is None else 2 * price))
        rows.append((sku, f"cat{i % 9 % 2}", rng.choice("pq"), rng.choice(["x", None]), price, q, rng.choice("AB"), rng.choice(["G", "S", "B"]), i % 3))
    kinds = "sku_pk string, sku_cat string, prod_cd string, proj_type string, price double, quantity double, cust_cat string, cust_tier string, fold int"
    empty = {c: F.lit(None).cast("double") for c in [*forecast.MEDIAN_COLUMNS, *forecast.MEAN_COLUMNS[1:]]}
    return spark.createDataFrame(rows, kinds).withColumns(empty)


FOREST = {"trees": [2, 7], "depth": [1, 3, None], "leaf": [2, 9]}
BOOST = {"trees": [2, 4], "depth": [1, 3], "rate": [0.1, 0.5], "subsample": [0.7, 1.0]}


@pytest.mark.parametrize("categorical_only", [True, False])
@pytest.mark.parametrize("tune, grid", [(forecast.rf_tune, FOREST), (forecast.boost_tune, BOOST)])
def test_every_point_scores_as_when_it_is_searched_alone(spark, tune, grid, categorical_only):
    if not categorical_only and tune is forecast.boost_tune:
        grid = grid | {"depth": [2], "rate": [0.5]}
    df = sales(spark)
    _, report = tune(df, grid, folds=3, categorical_only=categorical_only)
    assert len(report) == len(list(itertools.product(*grid.values())))
    for row in report[:: 5]:
        _, (alone,) = tune(df, {k: [row[k]] for k in grid}, folds=3, categorical_only=categorical_only)
        assert alone == pytest.approx(row)


@pytest.mark.parametrize("tune, grid", [(forecast.rf_tune, FOREST | {"leaf": [2]}), (forecast.boost_tune, {"trees": [2, 3], "depth": [2], "rate": [0.5], "subsample": [0.7, 1.0]})])
def test_too_many_cells_for_a_task_give_the_same(spark, monkeypatch, tune, grid):
    df = sales(spark, 150)
    model, report = tune(df, grid, folds=2)
    monkeypatch.setattr(search, "LOCAL_CELLS", 0)
    spread, again = tune(df, grid, folds=2)
    assert all(a == pytest.approx(b) for a, b in zip(report, again, strict=True))
    show = lambda m: sorted(round(r.prediction, 9) for r in m.transform(df).select("prediction").collect())
    assert show(model) == show(spread)


def test_forest_leaves_are_means_of_drawn_rows(spark):
    df = sales(spark)
    encoding = search.Encoding.fit(df, forecast.CATEGORICAL, [])
    rows = search.coded(df, encoding, "quantity", "fold")
    model = search.fit_forest(rows, encoding.features, 3, 2, 5, 17)
    total = sum(m.staged(np.zeros((1, 5), int), encoding.features, [0])[0].sum() for m in model)
    drawn = search.drawn_cells(rows, 3, 17).groupBy("t").agg((F.sum("s") / F.sum("h")).alias("m"), F.sum("h").alias("n")).collect()
    assert total == pytest.approx(sum(r.m for r in drawn) / 3)
    assert all(300 < r.n < 500 for r in drawn)
    seen = search.drawn_cells(rows, 1, 17, 0.7).agg(F.sum("h")).first()[0]
    assert 230 < seen < 330


@pytest.mark.parametrize("share", [None, 0.7])
def test_drawn_cells_are_sums_of_what_each_row_draws(spark, monkeypatch, share):
    """Spark's own hash decides what a tree sees of a row; tasks add that up and send no row for each row and tree."""
    monkeypatch.setattr(search, "DRAWN", 50)
    monkeypatch.setattr(search, "HELD", 100)
    rows = spark.range(-40, 400, 1, 3).select(F.array((F.col("id") % 3).cast("int"), F.lit(7)).alias("codes"), F.when(F.col("id") % 7 > 0, (F.col("id") % 2).cast("int")).alias("fold"), (F.col("id") % 11).cast("double").alias("y"), "id")
    found = search.drawn_cells(rows, 4, 17, share)
    assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()
    each = rows.withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(3))))
    u = F.xxhash64("id", F.lit(17), "t").bitwiseAND(F.lit((1 << 53) - 1)) / F.lit(float(1 << 53))
    w = (u < share).cast("int") if share else sum([(u >= float(p)).cast("int") for p in search.POISSON], F.lit(0))
    want = each.withColumn("w", w).where("w > 0").groupBy("codes", "fold", "t").agg(F.sum("w").cast("double").alias("h"), F.sum(F.col("w") * F.col("y")).alias("s"))
    show = lambda df: sorted((r.codes, r.fold if r.fold is not None else -1, r.t, r.h, r.s) for r in df.collect())
    assert show(found) == show(want)


def test_distinct_codes_of_many_columns():
    codes = np.array([[k % 3 * 2**30, *([k % 5] * 40)] for k in range(60)])
    cells, which = search._distinct(codes)
    assert len(cells) == 15 and np.array_equal(cells[which], codes)


def test_unknown_categories_and_nulls_take_the_other_side(spark):
    df = sales(spark)
    encoding = search.Encoding.fit(df, ["sku_cat", "proj_type"], ["price"])
    assert encoding.values == {"sku_cat": ["cat0", "cat1"], "proj_type": ["x"]}
    rows = spark.createDataFrame([("cat1", "x", 9.0), ("new", None, None), ("cat0", "y", 0.0)], "sku_cat string, proj_type string, price double")
    got = [r.codes for r in rows.select(encoding.codes().alias("codes")).collect()]
    top = len(encoding.edges["price"]) + 1
    assert got[0] == [2, 1, top] and got[1][:2] == [0, 0] and got[2] == [1, 0, 1] and 1 < got[1][2] <= top


def test_folds_without_ids_store_neither_ids_nor_hashes(spark, monkeypatch):
    """Nor do they differ from the folds with them."""
    rows = [(f"s{i % 3}" if i % 7 else None, i, i % 4 or None, float(i)) for i in range(120)]
    df = spark.createDataFrame(rows, "sku string, a long, b long, y double").repartition(5)
    want = {r.y: r.fold for r in forecast.stratified_folds(df, "sku", ["a", "b"]).collect()}
    kept, real = [], ranked.reliable
    monkeypatch.setattr(ranked, "reliable", lambda frame: kept.append(frame.columns) or real(frame))
    found = forecast.stratified_folds(df, "sku", ["a", "b"], keep_ids=False)
    assert found.columns == ["sku", "y", "fold"] and kept == [["sku", "y", "_slice", "_at", "_row"]]
    assert {r.y: r.fold for r in found.collect()} == want


def test_drawn_cells_travel_as_one_row_a_cell(spark):
    """Not as one for each tree: what is exchanged has lists."""
    rows = spark.range(300).select(F.array((F.col("id") % 3).cast("int")).alias("codes"), F.pmod("id", F.lit(2)).cast("int").alias("fold"), F.col("id").cast("double").alias("y"), "id").repartition(2)
    drawn = search.drawn_cells(rows, 10, 1, 0.5)
    cuts = re.findall(r"hashpartitioning\(([^)]*), \d+\)", drawn._jdf.queryExecution().executedPlan().toString())
    assert [re.sub(r"#\d+", "", c) for c in cuts] == ["codes, fold"]
    assert drawn.where("t is null or h <= 0").isEmpty()
    got = {(tuple(r.codes), r.fold, r.t): (r.h, r.s) for r in drawn.collect()}
    want = {}
    ids = np.arange(300)
    for t in range(10):
        on = search.uniform(search.row_hashes(ids, 1), t) < 0.5
        for i in ids[on].tolist():
            h, s = want.get(((i % 3,), i % 2, t), (0.0, 0.0))
            want[((i % 3,), i % 2, t)] = (h + 1, s + i)
    assert got == want


def test_folds_make_the_scores_and_scores_choose_the_model(spark, monkeypatch):
    """No stage of a search is without effect: other folds give other scores, other scores another model."""
    grid, df = {"trees": [1, 2], "depth": [1], "rate": [0.5], "subsample": [1.0]}, sales(spark, 90)
    smape = lambda rows: [r["smape"] for r in forecast.boost_tune(rows, grid, folds=3)[1]]
    assert smape(df) != smape(df.withColumn("fold", (F.col("price") > 1).cast("int")).fillna({"fold": 2}))
    for better in (0, 1):
        monkeypatch.setattr(forecast, "scores", lambda *_, better=better: [[(float(k != better), 0.5) for k in range(2)]])
        assert len(forecast.boost_tune(df, grid, folds=3)[0].trees) == grid["trees"][better]
