"""Demand forecast: SKU codes, folds, tuning, scenarios and scores."""

from __future__ import annotations

import itertools

from pyspark.ml.evaluation import Evaluator
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricewright.operators.ranked import MAX_GROUP_VALUES, group_medians, numbered, reliable, running_total
from pricewright.operators.search import Encoding, TreeModel, boost_predictions, coded, fit_boost, fit_forest, forest_predictions, scores

SKU, LABEL, FOLD = "sku_pk", "quantity", "fold"

# Columns of the model input.
CATEGORICAL = ["sku_cat", "prod_cd", "proj_type", "cust_cat", "cust_tier"]
MEAN_COLUMNS = ["price", "2023_avg_p", "2023_avg_q", "2024_avg_p", "2024_avg_q", "2025_avg_p", "2025_avg_q"]
MEDIAN_COLUMNS = ["avg_p", "avg_q", "p_std", "q_std", "ped"]
NUMERIC = ["price", *MEDIAN_COLUMNS, *MEAN_COLUMNS[1:]]

# Number of predictors in the adjusted R2, folds, seeds and the grids.
PREDICTORS = 22
FOLDS, FOLD_SEED, MODEL_SEED = 5, 42, 17
FOREST_GRID = {"trees": [50, 100], "depth": [10, 20, 35, None], "leaf": [5, 7, 10, 15, 20, 25]}
BOOST_GRID = {"trees": [50, 100], "depth": [10, 20, 35], "rate": [0.01, 0.1, 0.2], "subsample": [0.8, 1.0]}


def sku_codes(df: DataFrame, key: str = SKU) -> DataFrame:
    """(key, code): dense codes from 0 in sorted order, -1 for null.

    The distinct keys are ranked in slices, so neither the driver nor one task holds them all.
    """
    keys = df.select(key).distinct()
    ranked = running_total(
        keys.where(F.col(key).isNotNull()).withColumn("_one", F.lit(1)), [], [key], "_one", "_rank"
    )
    codes = ranked.select(key, (F.col("_rank") - 1).cast("long").alias("code"))
    return codes.unionByName(keys.where(F.col(key).isNull()).withColumn("code", F.lit(-1).cast("long")))


def sku_frequency(df: DataFrame, key: str = SKU) -> DataFrame:
    """Mean, median and mode (smallest on ties) of the rows per key.

    The counts are folded once more into (rows, keys with that many rows): at most about
    sqrt(2 * rows) entries reach the last aggregate.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    folded = counts.groupBy("n").agg(F.count(F.lit(1)).alias("m"))
    return folded.agg(
        (F.sum(F.col("n") * F.col("m")) / F.sum("m")).alias("mean"),
        F.percentile("n", F.lit(0.5), F.col("m")).alias("median"),
        F.min_by("n", F.struct(-F.col("m"), F.col("n"))).alias("mode"),
    )


def stratified_folds(
    df: DataFrame, label: str, ids: list[str], n: int = FOLDS, seed: int = FOLD_SEED, keep_ids: bool = True
) -> DataFrame:
    """Add ``fold``: rows of each label in hash order, dealt round robin, so folds differ by one row at most.

    ``ids`` identify a row; their text and the seed are hashed. Places in a label come from
    slices of the (label, hash) order whose sizes add up, so the deal is the same however the
    rows are cut, and no label meets in one task. Without ``keep_ids`` the ids end with the hash, and do not travel.
    """
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ids], F.lit(str(seed)))
    columns = [c for c in df.columns if keep_ids or c not in ids or c == label]
    hashed = df.select(*[F.col(f"`{c}`") for c in columns], F.unhex(F.md5(text)).alias("_h"))
    placed = numbered(hashed, [label], ["_h", *(ids if keep_ids else [])], "_place", ["_h"])
    return placed.select(*[F.col(f"`{c}`") for c in columns], F.pmod(F.col("_place") - 1, F.lit(n)).cast("int").alias(FOLD))


def smape_expr(actual: str, predicted: str) -> Column:
    half = (F.abs(F.col(actual)) + F.abs(F.col(predicted))) / 2
    return 100 * F.avg(F.when(half == 0, 0.0).otherwise(F.abs(F.col(actual) - F.col(predicted)) / half))


def adjusted_r2_expr(actual: str, predicted: str, predictors: int = PREDICTORS) -> Column:
    y, rows = F.col(actual), F.count(F.lit(1))
    error = F.sum((y - F.col(predicted)) * (y - F.col(predicted)))
    unexplained = F.try_divide(error, F.var_pop(y) * rows)
    return 1 - unexplained * F.try_divide((rows - 1).cast("double"), (rows - predictors - 1).cast("double"))


def smape(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Symmetric mean absolute percentage error; a pair of zeros counts as 0."""
    return df.agg(smape_expr(actual, predicted).alias("smape"))


def adjusted_r2(df: DataFrame, actual: str, predicted: str, predictors: int = PREDICTORS) -> DataFrame:
    return df.agg(adjusted_r2_expr(actual, predicted, predictors).alias("adjusted_r2"))


class ForecastEvaluator(Evaluator):
    """SMAPE (smaller is better) or adjusted R2, for use with Spark's own tuners."""

    def __init__(self, metric: str = "smape", labelCol: str = LABEL, predictionCol: str = "prediction"):
        super().__init__()
        self.metric, self.labelCol, self.predictionCol = metric, labelCol, predictionCol

    def _evaluate(self, dataset: DataFrame) -> float:
        expr = smape_expr if self.metric == "smape" else adjusted_r2_expr
        return dataset.agg(expr(self.labelCol, self.predictionCol)).first()[0]

    def isLargerBetter(self) -> bool:
        return self.metric != "smape"


def _search(df: DataFrame, grid: dict, names: list[str], predictions, refit, folds: int, categorical_only: bool) -> tuple[TreeModel, list[dict]]:
    """(model refitted on all rows with the best SMAPE, mean scores per grid point)."""
    encoding = Encoding.fit(df, CATEGORICAL, [] if categorical_only else NUMERIC)
    rows = coded(df, encoding, LABEL, FOLD)
    predicted = reliable(predictions(rows, encoding.features, grid, folds, MODEL_SEED))
    found = scores(rows, predicted, PREDICTORS)
    report = []
    for k, values in enumerate(itertools.product(*[grid[n] for n in names])):
        smapes, r2 = zip(*[fold[k] for fold in found], strict=True)
        adjusted = sum(r2) / len(r2) if all(v is not None for v in r2) else None
        report.append({**dict(zip(names, values, strict=True)), "smape": sum(smapes) / len(smapes), "adjusted_r2": adjusted})
    best = min(report, key=lambda r: r["smape"])
    base, trees = refit(rows, encoding.features, *[best[n] for n in names], MODEL_SEED)
    return TreeModel(encoding, trees, base), report


def rf_tune(df: DataFrame, grid: dict = FOREST_GRID, folds: int = FOLDS, categorical_only: bool = True) -> tuple[TreeModel, list[dict]]:
    """Forests: bootstrapped rows, all features at every split, the mean of a leaf's rows."""
    fit = lambda *args: (0.0, fit_forest(*args))
    return _search(df, grid, ["trees", "depth", "leaf"], forest_predictions, fit, folds, categorical_only)


def boost_tune(df: DataFrame, grid: dict = BOOST_GRID, folds: int = FOLDS, categorical_only: bool = True) -> tuple[TreeModel, list[dict]]:
    """Second-order boosting from the mean label, with L2 and a least weight of 1 in a leaf."""
    return _search(df, grid, ["trees", "depth", "rate", "subsample"], boost_predictions, fit_boost, folds, categorical_only)


def sku_scenario(df: DataFrame, new_prices: DataFrame, max_rows: int = MAX_GROUP_VALUES, stored: bool = False) -> DataFrame:
    """One row per SKU: modes (smallest on ties), means and medians of its history, at the planned price.

    One wide aggregate; its buffers hold a SKU's different values. SKUs with more than
    ``max_rows`` rows start from value counts instead, an aggregate keyed by value as well, so
    that a SKU with a third of all rows spreads over tasks. The input is read several times:
    pass ``stored`` when it is a table.
    """
    known = df.where(F.col(SKU).isNotNull())
    known = known if stored else reliable(known)
    mean = [F.avg(f"`{c}`").alias(c) for c in MEAN_COLUMNS if c != "price"]
    mode = [F.mode(F.col(c).cast("string"), deterministic=True).alias(c) for c in CATEGORICAL]
    median = [F.percentile(F.col(c).cast("double"), F.lit(0.5)).alias(c) for c in MEDIAN_COLUMNS]
    columns = [*CATEGORICAL, *MEDIAN_COLUMNS, *[c for c in MEAN_COLUMNS if c != "price"]]
    large = known.groupBy(SKU).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > max_rows).select(SKU)
    large = reliable(large)
    if large.isEmpty():
        rows = known.groupBy(SKU).agg(*mode, *median, *mean)
    else:
        rows = known.join(large, SKU, "left_anti").groupBy(SKU).agg(*mode, *median, *mean)
        rows = rows.unionByName(_scenario_by_value(known.join(large, SKU, "left_semi"), mean, max_rows))
    planned = new_prices.select(F.col(SKU), F.col("`new price`").cast("double").alias("price"))
    rows = rows.select(SKU, *[f"`{c}`" for c in columns])
    return rows.join(planned, SKU, "left").select(
        SKU, *CATEGORICAL[:3], "price", *[f"`{c}`" for c in columns[3:]]
    )


def _scenario_by_value(known: DataFrame, mean: list[Column], max_values: int) -> DataFrame:
    def counts(columns: list[str], kind: str) -> DataFrame:
        cells = known.select(SKU, *[F.col(f"`{c}`").cast(kind).alias(c) for c in columns])
        long = cells.unpivot([SKU], columns, "_column", "_value").where(F.col("_value").isNotNull())
        return long.groupBy(SKU, "_column", "_value").agg(F.count(F.lit(1)).alias("_n"))

    def wide(long: DataFrame, value: Column, columns: list[str]) -> DataFrame:
        return long.groupBy(SKU).agg(*[F.max(F.when(F.col("_column") == c, value)).alias(c) for c in columns])

    modes = counts(CATEGORICAL, "string").groupBy(SKU, "_column").agg(
        F.min_by("_value", F.struct(-F.col("_n"), F.col("_value"))).alias("_mode")
    )
    medians = group_medians(counts(MEDIAN_COLUMNS, "double"), [SKU, "_column"], "_value", "_n", max_values)
    return (
        known.groupBy(SKU).agg(*mean)
        .join(wide(modes, F.col("_mode"), CATEGORICAL), SKU, "left")
        .join(wide(medians, F.col("median"), MEDIAN_COLUMNS), SKU, "left")
    )


def forecast(model: TreeModel, scenario: DataFrame) -> DataFrame:
    """Scenario rows with the predicted quantity; null for a SKU without a planned price.

    The price is a predictor, and filling a missing one with the mean price of all SKUs would
    give a forecast that looks real.
    """
    predicted = F.when(F.col("price").isNotNull(), F.col("prediction"))
    return model.transform(scenario).select(*[F.col(f"`{c}`") for c in scenario.columns], predicted.alias("forecast_quantity"))
