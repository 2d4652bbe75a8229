"""Demand forecast operators over the sample tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricewright.operators import dedup, forecast
from pricewright.operators.forecast import CATEGORICAL, MEAN_COLUMNS, MEDIAN_COLUMNS
from pricewright.operators.hygiene import null_default
from pricewright.operators.ranked import reliable
from pricewright.operators.search import Encoding, TreeModel, coded, fit_boost
from pricewright.plans.registry import query
from pricewright.plans.sample import model_input, read, text

INPUT_SQL = """input AS (
  SELECT CAST(l_partkey AS VARCHAR) AS sku_pk, p_type AS sku_cat, p_brand AS prod_cd,
    coalesce(nullif(o_orderstatus, 'P'), 'Other') AS proj_type, l_extendedprice AS price,
    l_quantity AS quantity, c_mktsegment AS cust_cat, o_orderpriority AS cust_tier, p_retailprice AS avg_p,
    l_quantity AS avg_q, l_discount AS p_std, l_tax AS q_std, l_discount - l_tax AS ped,
    CASE WHEN year(l_shipdate) = 1998 THEN l_extendedprice END AS "2023_avg_p",
    CASE WHEN year(l_shipdate) = 1998 THEN l_quantity END AS "2023_avg_q",
    CASE WHEN year(l_shipdate) = 1999 THEN l_extendedprice END AS "2024_avg_p",
    CASE WHEN year(l_shipdate) = 1999 THEN l_quantity END AS "2024_avg_q",
    CASE WHEN year(l_shipdate) = 2000 THEN l_extendedprice END AS "2025_avg_p",
    CASE WHEN year(l_shipdate) = 2000 THEN l_quantity END AS "2025_avg_q"
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN part ON l_partkey = p_partkey)"""


@query("null_default", """
SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'P'), 'Other') AS proj_type FROM orders""")
def null_default_query(spark, sf_dir):
    raw = read(spark, sf_dir, "orders").select(
        "o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("proj_type")
    )
    return null_default(raw, "proj_type")


@query("price_floor_ceiling", f"""
WITH {INPUT_SQL}
SELECT sku_pk, min(price) AS price_floor, max(price) AS price_ceil, NULL::DOUBLE AS "new price" FROM input GROUP BY sku_pk""")
def price_floor_ceiling(spark, sf_dir):
    return dedup.group_min_max(model_input(spark, sf_dir))


@query("sku_frequency", """
WITH f AS (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey), m AS (SELECT n, count(*) AS c FROM f GROUP BY n)
SELECT round(avg(n), 6) AS mean, median(n)::DOUBLE AS median, (SELECT n FROM m ORDER BY c DESC, n LIMIT 1) AS mode FROM f""")
def sku_frequency(spark, sf_dir):
    return forecast.sku_frequency(
        read(spark, sf_dir, "lineitem").select(text("l_partkey").alias("sku_pk"))
    ).withColumn("mean", F.round("mean", 6))


@query("sku_codes", """
WITH skus AS (SELECT DISTINCT nullif(CAST(l_partkey AS VARCHAR), '7') AS sku_pk FROM lineitem)
SELECT sku_pk, CASE WHEN sku_pk IS NULL THEN -1 ELSE dense_rank() OVER (ORDER BY sku_pk NULLS LAST) - 1 END AS code
FROM skus""")
def sku_codes(spark, sf_dir):
    sku = F.nullif(text("l_partkey"), F.lit("7")).alias("sku_pk")
    return forecast.sku_codes(read(spark, sf_dir, "lineitem").select(sku))


IDS = ["l_orderkey", "l_linenumber", "day", "l_suppkey", "cents"]
IDS_SQL = """l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d') AS day, l_suppkey,
    CAST(round(l_extendedprice * 100) AS BIGINT) AS cents"""


def with_ids(df):
    """Columns whose text is the same here and in SQL, and which identify a line."""
    return df.withColumns(
        {"day": F.date_format("l_shipdate", "yyyy-MM-dd"), "cents": F.round(F.col("l_extendedprice") * 100).cast("long")}
    )


def _folds_sql(label, source, ids):
    text = " || '|' || ".join([f"CAST({c} AS VARCHAR)" for c in ids] + ["'42'"])
    return f"""
WITH rows AS (SELECT {label}, {IDS_SQL} FROM {source})
SELECT *, CAST((row_number() OVER (PARTITION BY {label.split()[-1]} ORDER BY md5({text})) - 1) % 5 AS INTEGER) AS fold
FROM rows"""


@query("stratified_folds", _folds_sql(
    "l_partkey, p_type AS sku_cat", "lineitem JOIN part ON l_partkey = p_partkey", ["l_partkey", *IDS]))
def stratified_folds(spark, sf_dir):
    """Every row with its fold, by category: a few labels with very many rows."""
    data = with_ids(model_input(spark, sf_dir)).withColumn("l_partkey", F.col("sku_pk").cast("long"))
    ids = ["l_partkey", *IDS]
    return forecast.stratified_folds(data.select("sku_cat", *ids), "sku_cat", ids)


@query("stratified_folds_sku", _folds_sql("l_partkey", "lineitem", IDS))
def stratified_folds_sku(spark, sf_dir):
    data = with_ids(read(spark, sf_dir, "lineitem")).select("l_partkey", *IDS)
    return forecast.stratified_folds(data, "l_partkey", IDS)


def planned_prices(spark, sf_dir):
    return read(spark, sf_dir, "part").where(F.col("p_type") != "PROMO").select(
        text("p_partkey").alias("sku_pk"), (F.col("p_retailprice") * 1.05).alias("new price")
    )



def _modes_sql():
    parts = []
    for c in CATEGORICAL:
        parts.append(
            f"m_{c} AS (SELECT sku_pk, {c} FROM (SELECT sku_pk, {c}, count(*) AS n FROM input WHERE {c} IS NOT NULL "
            f"GROUP BY sku_pk, {c}) QUALIFY row_number() OVER (PARTITION BY sku_pk ORDER BY n DESC, {c}) = 1)"
        )
    return ", ".join(parts)


SCENARIO_SQL = f"""
WITH {INPUT_SQL}, {_modes_sql()},
nums AS (SELECT sku_pk, {", ".join(f'round(median({c}), 6) AS {c}' for c in MEDIAN_COLUMNS)},
  {", ".join(f'round(avg("{c}"), 6) AS "{c}"' for c in MEAN_COLUMNS if c != "price")} FROM input GROUP BY sku_pk)
SELECT nums.*, {", ".join(CATEGORICAL)}, CASE WHEN p_type <> 'PROMO' THEN p_retailprice * 1.05::DOUBLE END AS price
FROM nums JOIN part ON sku_pk = CAST(p_partkey AS VARCHAR) {" ".join(f"JOIN m_{c} USING (sku_pk)" for c in CATEGORICAL)}"""


def _scenario(spark, sf_dir, **options):
    out = forecast.sku_scenario(model_input(spark, sf_dir), planned_prices(spark, sf_dir), **options)
    numbers = [*MEDIAN_COLUMNS, *[c for c in MEAN_COLUMNS if c != "price"]]
    return out.withColumns({c: F.round(F.col(f"`{c}`"), 6) for c in numbers})


@query("sku_scenario", SCENARIO_SQL)
def sku_scenario(spark, sf_dir):
    return _scenario(spark, sf_dir)


@query("sku_scenario_large_groups", SCENARIO_SQL)
def sku_scenario_large_groups(spark, sf_dir):
    """About half of the SKUs count as large and go by value counts and slices."""
    return _scenario(spark, sf_dir, max_rows=30)


SCORED_SQL = f"""{INPUT_SQL}, scored AS (
  SELECT quantity AS y, avg(quantity) OVER (PARTITION BY prod_cd, proj_type) AS p FROM input)"""


def _scored(spark, sf_dir):
    data = model_input(spark, sf_dir).select("prod_cd", "proj_type", "quantity")
    means = data.groupBy("prod_cd", "proj_type").agg(F.avg("quantity").alias("guess"))
    return data.join(means, ["prod_cd", "proj_type"])


@query("smape", f"""
WITH {SCORED_SQL}
SELECT round(100 * avg(CASE WHEN abs(y) + abs(p) = 0 THEN 0 ELSE abs(y - p) / ((abs(y) + abs(p)) / 2) END), 6) AS smape
FROM scored""")
def smape(spark, sf_dir):
    return forecast.smape(_scored(spark, sf_dir), "quantity", "guess").withColumn("smape", F.round("smape", 6))


@query("adjusted_r2", f"""
WITH {SCORED_SQL}, m AS (SELECT avg(y) AS mean FROM scored)
SELECT round(1 - sum((y - p) ** 2) / sum((y - mean) ** 2) * (count(*) - 1) / (count(*) - 22 - 1), 6) AS adjusted_r2
FROM scored, m""")
def adjusted_r2(spark, sf_dir):
    out = forecast.adjusted_r2(_scored(spark, sf_dir), "quantity", "guess")
    return out.withColumn("adjusted_r2", F.round("adjusted_r2", 6))


CELLS_SQL = f"""{INPUT_SQL}, base AS (SELECT avg(quantity) AS mean FROM input),
cells AS (SELECT {", ".join(CATEGORICAL)}, count(*)::DOUBLE AS h, sum(quantity) AS s FROM input GROUP BY ALL)"""
LONG_CELLS = " UNION ALL ".join(f"SELECT {{keep}}, {k} AS j, {c} AS v, h, g FROM {{cells}}" for k, c in enumerate(CATEGORICAL))
VALUE_OF = "CASE best.j " + " ".join(f"WHEN {k} THEN {c}" for k, c in enumerate(CATEGORICAL)) + " END IS NOT DISTINCT FROM best.v"


def _best_sql(name, cells, keep, least):
    """The best split of every node (column ``keep``) of cells with h and g: the largest gain, then the first column."""
    return f"""{name}_long AS ({LONG_CELLS.format(keep=keep, cells=cells)}),
{name}_all AS (SELECT {keep}, sum(h) AS hh, sum(g) AS gg FROM {cells} GROUP BY {keep}),
{name} AS (SELECT {keep}, j, v FROM (
    SELECT {keep}, j, v, round(gl ** 2 / (hl + 1) + (gg - gl) ** 2 / (hh - hl + 1) - gg ** 2 / (hh + 1), 4) AS gain
    FROM (SELECT {keep}, j, v, sum(h) AS hl, sum(g) AS gl FROM {name}_long WHERE v IS NOT NULL GROUP BY ALL) JOIN {name}_all USING ({keep})
    WHERE hl >= {least} AND hh - hl >= {least})
  WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY {keep} ORDER BY gain DESC, j, v) = 1)"""


def _leaf_sql(sums):
    return f"round(-{sums}.gg / ({sums}.hh + 1), 6)"


def _coded(spark, sf_dir):
    data = reliable(model_input(spark, sf_dir)).withColumn(forecast.FOLD, F.lit(0))
    encoding = Encoding.fit(data, CATEGORICAL, [])
    return data, encoding, coded(data, encoding, forecast.LABEL, forecast.FOLD)


@query("boost_first_round", f"""
WITH {CELLS_SQL}, c0 AS (SELECT cells.*, h * mean - s AS g, 0 AS node FROM cells, base), {_best_sql("best0", "c0", "node", 1)},
c1 AS (SELECT c0.* REPLACE (CASE WHEN {VALUE_OF} THEN 1 ELSE 2 END AS node) FROM c0, best0 AS best), {_best_sql("best1", "c1", "node", 1)},
c2 AS (SELECT c1.* REPLACE (CASE WHEN {VALUE_OF} THEN 1 + 2 * c1.node ELSE 2 + 2 * c1.node END AS node) FROM c1 JOIN best1 AS best USING (node)),
best2_all AS (SELECT node, sum(h) AS hh, sum(g) AS gg FROM c2 GROUP BY node),
nodes AS (SELECT node, j, v, {_leaf_sql("best0_all")} AS value FROM best0_all LEFT JOIN best0 USING (node)
  UNION ALL SELECT node, j, v, {_leaf_sql("best1_all")} FROM best1_all LEFT JOIN best1 USING (node)
  UNION ALL SELECT node, NULL, NULL, {_leaf_sql("best2_all")} FROM best2_all)
SELECT node, {CATEGORICAL!r}[j + 1] AS split, v AS category, value FROM nodes""")
def boost_first_round(spark, sf_dir):
    """The first tree of boosting, two levels deep: what its nodes split on, and their values."""
    _, encoding, rows = _coded(spark, sf_dir)
    _, (tree,) = fit_boost(rows, encoding.features, 1, 2, 1.0, 1.0, forecast.MODEL_SEED)
    nodes = []
    for k, (j, code, value) in enumerate(zip(tree.feature.tolist(), tree.code.tolist(), tree.value.tolist(), strict=True)):
        split = CATEGORICAL[j] if j >= 0 else None
        nodes.append((k, split, encoding.values[split][code - 1] if split else None, value))
    found = spark.createDataFrame(nodes, "node int, split string, category string, value double")
    return found.withColumn("value", F.round("value", 6))


ROUNDS, RATE = 3, 0.5


def _stumps_sql():
    parts = ["c0 AS (SELECT cells.*, mean AS p, 0 AS node FROM cells, base)", "f0 AS (SELECT modes.*, mean AS p FROM modes, base)"]
    for r in range(ROUNDS):
        parts.append(f"g{r} AS (SELECT *, h * p - s AS g FROM c{r})")
        parts.append(_best_sql(f"b{r}", f"g{r}", "node", 1))
        side = f"sum(g) FILTER ({{}}{VALUE_OF}) / (sum(h) FILTER ({{}}{VALUE_OF}) + 1)"
        parts.append(f"w{r} AS (SELECT best.j, best.v, {side.format('', '')} AS yes, {side.format('NOT ', 'NOT ')} AS no FROM g{r}, b{r} AS best GROUP BY best.j, best.v)")
        moved = f"p - {RATE}::DOUBLE * CASE WHEN {VALUE_OF} THEN yes ELSE no END"
        parts.append(f"c{r + 1} AS (SELECT c{r}.* REPLACE ({moved} AS p) FROM c{r}, w{r} AS best)")
        parts.append(f"f{r + 1} AS (SELECT f{r}.* REPLACE ({moved} AS p) FROM f{r}, w{r} AS best)")
    joined = " ".join(f"JOIN m_{c} USING (sku_pk)" for c in CATEGORICAL[1:])
    return f"""
WITH {CELLS_SQL}, {_modes_sql()}, modes AS (SELECT * FROM m_{CATEGORICAL[0]} {joined}), {", ".join(parts)}
SELECT sku_pk, CASE WHEN p_type <> 'PROMO' THEN round(p, 6) END AS forecast_quantity
FROM f{ROUNDS} JOIN part ON sku_pk = CAST(p_partkey AS VARCHAR)"""


@query("boost_stumps", _stumps_sql())
def boost_stumps(spark, sf_dir):
    """The forecast of every SKU at its planned price, from three rounds of one split each."""
    data, encoding, rows = _coded(spark, sf_dir)
    base, trees = fit_boost(rows, encoding.features, ROUNDS, 1, RATE, 1.0, forecast.MODEL_SEED)
    scenario = forecast.sku_scenario(data, planned_prices(spark, sf_dir), stored=True)
    found = forecast.forecast(TreeModel(encoding, trees, base), scenario)
    return found.select("sku_pk", F.round("forecast_quantity", 6).alias("forecast_quantity"))


FOLDED = [forecast.SKU, *CATEGORICAL, forecast.LABEL, *IDS]


def _folded(data):
    """The columns that the search reads, with the fold: the others are not sorted along with them."""
    return forecast.stratified_folds(data.select(*FOLDED), forecast.SKU, IDS, keep_ids=False)


def _forecast(spark, sf_dir, tune):
    """One row per SKU: the planned price and the forecast of the model that the whole search picks."""
    read_on = [*dict.fromkeys([*FOLDED, *MEDIAN_COLUMNS, *MEAN_COLUMNS])]
    data = reliable(with_ids(model_input(spark, sf_dir)).select(*[F.col(f"`{c}`") for c in read_on]))
    model, _ = tune(_folded(data))
    scenario = forecast.sku_scenario(data, planned_prices(spark, sf_dir), stored=True)
    return forecast.forecast(model, scenario).select("sku_pk", "price", "forecast_quantity")


def _report(spark, sf_dir, tune):
    _, report = tune(_folded(reliable(with_ids(model_input(spark, sf_dir)).select(*FOLDED))))
    rows = [{**r, "depth": None if r["depth"] is None else int(r["depth"])} for r in report]
    kinds = {"trees": "int", "depth": "int", "leaf": "int"}
    return spark.createDataFrame([tuple(r.values()) for r in rows], ", ".join(f"{k} {kinds.get(k, 'double')}" for k in rows[0]))


@query("rf_forecast")
def rf_forecast(spark, sf_dir):
    return _forecast(spark, sf_dir, forecast.rf_tune)


@query("boost_forecast")
def boost_forecast(spark, sf_dir):
    return _forecast(spark, sf_dir, forecast.boost_tune)


@query("rf_search")
def rf_search(spark, sf_dir):
    """The scores of all 48 points."""
    return _report(spark, sf_dir, forecast.rf_tune)


@query("boost_search")
def boost_search(spark, sf_dir):
    """The scores of all 36 points."""
    return _report(spark, sf_dir, forecast.boost_tune)
