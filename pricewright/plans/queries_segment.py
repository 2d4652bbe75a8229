"""Customer features, profiles and tiers over the sample tables."""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from pricewright.functions.stats import Z_95, t_rows, weight_rows
from pricewright.operators import batched, features, profile
from pricewright.operators.clusters import LABEL
from pricewright.operators.features import metric_columns, slug
from pricewright.operators.ranked import reliable
from pricewright.plans import segmentation
from pricewright.plans.registry import query
from pricewright.plans.sample import CATEGORIES, customer_sales, read


def customer_inputs(spark, sf_dir):
    return features.customer_features(customer_sales(spark, sf_dir), CATEGORIES)


def rounded(df, digits=6):
    return df.select(
        *[F.round(f.name, digits).alias(f.name) if f.dataType.simpleString() == "double" else F.col(f.name)
          for f in df.schema.fields]
    )


NUDGE = 1e-9  # above the noise of sums in another order, so that exact halves round alike


def nudged(df, digits=6):
    return df.select(
        *[F.round(F.col(f"`{f.name}`") + NUDGE, digits).alias(f.name) if f.dataType.simpleString() == "double" else F.col(f"`{f.name}`")
          for f in df.schema.fields]
    )


def _per_category(template):
    return ", ".join(template.format(c=c, s=slug(c)) for c in CATEGORIES)


# Features per customer, straight from the sales lines.
FEATURES_SQL = f"""lines AS (
  SELECT c_name AS customer, c_mktsegment AS cust_cat, n_name, l_orderkey, o_orderdate, l_quantity, l_extendedprice,
    l_discount, p_type
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey),
feats AS (
  SELECT customer, cust_cat, n_name,
    CAST(date_diff('day', min(o_orderdate), max(o_orderdate)) AS DOUBLE) AS day_tenure,
    coalesce(date_diff('day', min(o_orderdate), max(o_orderdate))
      / nullif(count(DISTINCT l_orderkey) - 1, 0)::DOUBLE, 0.0) AS day_between_purchases,
    {_per_category('''
    count(DISTINCT l_orderkey) FILTER (p_type = '{c}')::DOUBLE AS {s}_order_freq,
    coalesce(sum(l_extendedprice) FILTER (p_type = '{c}')
      / nullif(count(DISTINCT l_orderkey) FILTER (p_type = '{c}'), 0), 0.0) AS {s}_avg_purchase,
    coalesce(sum(l_discount) FILTER (p_type = '{c}') / sum(l_quantity) FILTER (p_type = '{c}'), 0.0)
      AS {s}_discprice''')}
  FROM lines GROUP BY customer, cust_cat, n_name)"""
METRICS = ["day_tenure", "day_between_purchases"] + [
    f"{slug(c)}_{m}" for c in CATEGORIES for m in ("order_freq", "avg_purchase", "discprice")
]


def digits(metric):
    """Decimals kept in a comparison: enough that no exact quotient ends in a half there."""
    return 12 if metric.endswith("_discprice") else 7


@query(
    "customer_features",
    f"WITH {FEATURES_SQL} SELECT customer, cust_cat, "
    + ", ".join(f"round({m}, {digits(m)}) AS {m}" for m in METRICS)
    + " FROM feats",
)
def customer_features(spark, sf_dir):
    inputs = customer_inputs(spark, sf_dir)
    return inputs.withColumns({m: F.round(m, digits(m)) for m in metric_columns(inputs)})


@query(
    "standardize",
    f"WITH {FEATURES_SQL}, stats AS (SELECT "
    + ", ".join(f"avg({m}) AS m_{m}, stddev_pop({m}) AS s_{m}" for m in METRICS)
    + " FROM feats) SELECT customer, cust_cat, "
    + ", ".join(f"round(({m} - m_{m}) / s_{m}, 6) AS {m}" for m in METRICS)
    + " FROM feats, stats",
)
def standardize(spark, sf_dir):
    inputs = customer_inputs(spark, sf_dir)
    return rounded(features.standardize(inputs, metric_columns(inputs)))


SHOWN_METRICS = METRICS
LONG_SQL = (
    "long AS ("
    + " UNION ALL ".join(f"SELECT {{group}} AS grp, '{m}' AS metric, {m} AS v FROM feats" for m in SHOWN_METRICS)
    + ")"
)
T_SQL = "crit(n, t, wcrit) AS (VALUES " + ", ".join(f"({n}, {t!r}::DOUBLE, {w!r}::DOUBLE)" for n, t, w in t_rows()) + ")"
WEIGHT_SQL = "wts(n, pos, a) AS (VALUES " + ", ".join(f"({n}, {i}, {a!r}::DOUBLE)" for n, i, a in weight_rows()) + ")"
W_SQL = """ordered AS (SELECT *, row_number() OVER (PARTITION BY grp, metric ORDER BY v) AS pos,
  count(*) OVER (PARTITION BY grp, metric) AS n FROM long),
shape AS (SELECT grp, metric, o.n, coalesce(sum(a * v) ** 2 / nullif(var_pop(v) * o.n, 0), 1) AS w
  FROM ordered o JOIN wts ON wts.n = o.n AND wts.pos = o.pos GROUP BY grp, metric, o.n),
tested AS (SELECT shape.*, w > wcrit AS normal FROM shape JOIN crit USING (n))"""


def _intervals_sql(group):
    return f"""{LONG_SQL.format(group=group)}, {T_SQL}, {WEIGHT_SQL}, {W_SQL},
stats AS (SELECT grp, metric, count(*) AS n, avg(v) AS mean, stddev_pop(v) / sqrt(count(*)) AS err, min(v) AS least,
  max(v) AS most FROM long GROUP BY grp, metric),
chosen AS (SELECT stats.*, t, CASE WHEN n >= 100 THEN 'normal' WHEN normal THEN 'student' ELSE 'range' END AS method
  FROM stats LEFT JOIN tested USING (grp, metric, n) LEFT JOIN crit USING (n)),
intervals AS (SELECT grp, metric, n, mean, method,
  CASE method WHEN 'range' THEN least WHEN 'normal' THEN mean - {Z_95!r} * err ELSE mean - t * err END AS lo,
  CASE method WHEN 'range' THEN most WHEN 'normal' THEN mean + {Z_95!r} * err ELSE mean + t * err END AS hi
  FROM chosen)"""


INTERVAL_SELECT = """ SELECT grp, metric, n, round(mean + 1e-9, 6) AS mean, round(lo + 1e-9, 6) AS lo,
  round(hi + 1e-9, 6) AS hi, method
FROM intervals"""


def _grouped(spark, sf_dir, small=False):
    inputs = customer_inputs(spark, sf_dir)
    if not small:
        return inputs.withColumn("grp", F.col("cust_cat"))
    customer, nation = read(spark, sf_dir, "customer"), read(spark, sf_dir, "nation")
    places = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_name").alias("customer"), "n_name"
    )
    return inputs.join(places, "customer").withColumn("grp", F.concat_ws("/", "cust_cat", "n_name"))


@query("metric_interval", f"WITH {FEATURES_SQL}, {_intervals_sql('cust_cat')} {INTERVAL_SELECT}")
def metric_interval(spark, sf_dir):
    return nudged(profile.metric_interval(_grouped(spark, sf_dir), "grp", SHOWN_METRICS))


BOTH = "cust_cat || '/' || n_name"


@query("metric_interval_small_groups", f"WITH {FEATURES_SQL}, {_intervals_sql(BOTH)} {INTERVAL_SELECT}")
def metric_interval_small_groups(spark, sf_dir):
    return nudged(profile.metric_interval(_grouped(spark, sf_dir, small=True), "grp", SHOWN_METRICS))


@query("normality_test", f"""
WITH {FEATURES_SQL}, {LONG_SQL.format(group=BOTH)}, {T_SQL}, {WEIGHT_SQL}, {W_SQL}
SELECT grp, metric, n, round(w + 1e-9, 6) AS w, normal FROM tested""")
def normality_test(spark, sf_dir):
    return nudged(profile.normality_test(_grouped(spark, sf_dir, small=True), "grp", SHOWN_METRICS))


def _below_sql(z):
    """Standard normal distribution, by its series."""
    term = f"s.t * {z} * {z} / (2 * k.t + 1)"
    step = f"lambda s, k: {{'t': {term}, 's': s.s + {term}}}"
    terms = "list_transform(range(1, 91), lambda i: {'t': i::DOUBLE, 's': 0::DOUBLE})"
    return f"(0.5 + exp(-({z} * {z}) / 2) / sqrt(2 * pi()) * list_reduce([{{'t': {z}, 's': {z}}}] || {terms}, {step}).s)"


# A quantile of the normal distribution by a rational approximation and one step of Halley's method.
QUANTILE_SQL = f"""sizes AS (SELECT unnest(range(10, 100)) AS n), places AS (SELECT n, unnest(range(1, n + 1)) AS pos FROM sizes),
shares AS (SELECT n, pos, (pos - 0.375::DOUBLE) / (n + 0.25::DOUBLE) AS q FROM places),
sides AS (SELECT *, least(q, 1 - q) AS low FROM shares), roots AS (SELECT *, sqrt(-2 * ln(low)) AS r, low - 0.5 AS c FROM sides),
rough AS (SELECT *, CASE WHEN low < 0.02425 THEN
  (((((-7.784894002430293e-03 * r - 3.223964580411365e-01) * r - 2.400758277161838) * r - 2.549732539343734) * r + 4.374664141464968) * r
    + 2.938163982698783) / ((((7.784695709041462e-03 * r + 3.224671290700398e-01) * r + 2.445134137142996) * r + 3.754408661907416) * r + 1)
  ELSE (((((-3.969683028665376e+01 * c * c + 2.209460984245205e+02) * c * c - 2.759285104469687e+02) * c * c + 1.383577518672690e+02) * c * c
    - 3.066479806614716e+01) * c * c + 2.506628277459239) * c / (((((-5.447609879822406e+01 * c * c + 1.615858368580409e+02) * c * c
    - 1.556989798598866e+02) * c * c + 6.680131188771972e+01) * c * c - 1.328068155288572e+01) * c * c + 1) END AS z FROM roots),
off AS (SELECT *, ({_below_sql("z")} - low) * sqrt(2 * pi()) * exp(z * z / 2) AS e FROM rough),
scores AS (SELECT n, pos, CASE WHEN q > 0.5 THEN -1 ELSE 1 END * (z - e / (1 + z * e / 2)) AS m FROM off),
ends AS (SELECT n, sum(m * m) AS ss, max(m) AS m1, max(m) FILTER (pos = n - 1) AS m2, 1 / sqrt(n) AS u FROM scores GROUP BY n),
outer_weights AS (SELECT *, m1 / sqrt(ss) + 0.221157 * u - 0.147981 * u ** 2 - 2.071190 * u ** 3 + 4.434685 * u ** 4 - 2.706056 * u ** 5 AS a1,
  m2 / sqrt(ss) + 0.042981 * u - 0.293762 * u ** 2 - 1.752461 * u ** 3 + 5.682633 * u ** 4 - 3.582633 * u ** 5 AS a2 FROM ends),
own_weights AS (SELECT n, pos, CASE pos WHEN 1 THEN -a1 WHEN 2 THEN -a2 WHEN n THEN a1 WHEN n - 1 THEN a2
  ELSE m / sqrt((ss - 2 * m1 ** 2 - 2 * m2 ** 2) / (1 - 2 * a1 ** 2 - 2 * a2 ** 2)) END AS a FROM scores JOIN outer_weights USING (n))"""


@query("normality_p_values", f"""
WITH {FEATURES_SQL}, {LONG_SQL.format(group=BOTH)}, {QUANTILE_SQL},
placed AS (SELECT *, row_number() OVER (PARTITION BY grp, metric ORDER BY v) AS pos, count(*) OVER (PARTITION BY grp, metric) AS n FROM long),
shape AS (SELECT grp, metric, n, coalesce(sum(a * v) ** 2 / nullif(var_pop(v) * n, 0), 1) AS w
  FROM placed JOIN own_weights USING (n, pos) GROUP BY grp, metric, n),
scored AS (SELECT *, ln(n) AS x, ln(CASE WHEN w < 1 THEN 1 - w END) AS away FROM shape),
z AS (SELECT *, CASE WHEN n < 12 THEN (-ln(-2.273 + 0.459 * n - away) - (0.5440 - 0.39978 * n + 0.025054 * n ** 2 - 0.0006714 * n ** 3))
    / exp(1.3822 - 0.77857 * n + 0.062767 * n ** 2 - 0.0020322 * n ** 3)
  ELSE (away - (-1.5861 - 0.31082 * x - 0.083751 * x ** 2 + 0.0038915 * x ** 3)) / exp(-0.4803 - 0.082676 * x + 0.0030302 * x ** 2) END AS z
  FROM scored),
near AS (SELECT *, greatest(least(z, 7), -7) AS zz FROM z)
SELECT grp, metric, n, round(w + 1e-9, 6) AS w, round(CASE WHEN w >= 1 THEN 1 ELSE 1 - {_below_sql("zz")} END, 6) AS p FROM near""")
def normality_p_values(spark, sf_dir):
    found = profile.normality_p_values(_grouped(spark, sf_dir, small=True), "grp", SHOWN_METRICS)
    return found.select("grp", "metric", "n", F.round(F.col("w") + NUDGE, 6).alias("w"), F.round("p", 6).alias("p"))


@query("category_share", """
SELECT n_name, coalesce(seg, 'None') || ' category %' AS category,
  CAST(CAST(round_even(count(*) / sum(count(*)) OVER (PARTITION BY n_name) * 100, 1) AS DECIMAL(30, 1)) AS VARCHAR) || '%'
  AS share
FROM (SELECT n_name, nullif(c_mktsegment, 'BUILDING') AS seg FROM customer JOIN nation ON c_nationkey = n_nationkey)
GROUP BY n_name, seg""")
def category_share(spark, sf_dir):
    joined = read(spark, sf_dir, "customer").join(
        read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    seg = joined.select("n_name", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("seg"))
    return profile.category_share(seg, "n_name", "seg")


ALL_LONG_SQL = "long AS (" + " UNION ALL ".join(
    f"SELECT cust_cat AS grp, '{m}' AS metric, avg({m}) AS v FROM feats GROUP BY cust_cat" for m in METRICS
) + ")"


@query("tier_rules", f"""
WITH {FEATURES_SQL}, {ALL_LONG_SQL},
ranked AS (SELECT grp, CASE WHEN metric LIKE '%discprice' THEN 'd' WHEN metric LIKE 'day%' THEN 'l' ELSE 'p' END AS fam,
  rank() OVER (PARTITION BY metric ORDER BY CASE metric WHEN 'day_between_purchases' THEN -v ELSE v END) AS r FROM long),
fams AS (SELECT grp, fam, rank() OVER (PARTITION BY fam ORDER BY sum(r)) AS r FROM ranked GROUP BY grp, fam),
scores AS (SELECT grp, max(r) FILTER (fam = 'p') * 0.7::DOUBLE + max(r) FILTER (fam = 'l') * 0.2::DOUBLE
  + max(r) FILTER (fam = 'd') * 0.1::DOUBLE AS score FROM fams GROUP BY grp)
SELECT grp, round(score, 6) AS score,
  ['Platium', 'Gold', 'Silver', 'Bronze'][least(4, dense_rank() OVER (ORDER BY score DESC))] AS tier FROM scores""")
def tier_rules(spark, sf_dir):
    inputs = _grouped(spark, sf_dir)
    metrics = [m for m in metric_columns(inputs) if m != "grp"]
    intervals = profile.metric_interval(inputs, "grp", metrics)
    return rounded(profile.rule_based_tiers(intervals, "grp", metrics))


@query("tier_profile", f"""
WITH {FEATURES_SQL}
SELECT cust_cat AS "CustTier", {", ".join(f'round(avg({m}) + 1e-9, 6) AS "{m} (mue)"' for m in SHOWN_METRICS)} FROM feats
GROUP BY cust_cat""")
def tier_profile(spark, sf_dir):
    intervals = profile.metric_interval(_grouped(spark, sf_dir), "grp", SHOWN_METRICS)
    wide = profile.tier_profile(intervals, "grp", SHOWN_METRICS)
    return nudged(wide.select("CustTier", *[f"`{m} (mue)`" for m in SHOWN_METRICS]))


@query("tier_profile_text", f"""
WITH {FEATURES_SQL}, {_intervals_sql(BOTH)},
shown AS (SELECT grp, metric, round(mean + 1e-9, 6) AS mean,
  '[' || CAST(round(lo + 1e-9, 6) AS VARCHAR) || ' - ' || CAST(round(hi + 1e-9, 6) AS VARCHAR) || ']' AS span FROM intervals)
SELECT grp AS "CustTier", {", ".join(f"""max(mean) FILTER (metric = '{m}') AS "{m} (mue)",
  max(span) FILTER (metric = '{m}') AS "{m} (95% Conf Interval)\"""" for m in SHOWN_METRICS)}
FROM shown GROUP BY grp""")
def tier_profile_text(spark, sf_dir):
    """Intervals as text. Bounds are rounded first, a little above their value, so that sums in another order and
    exact halves read alike."""
    raw = profile.metric_interval(_grouped(spark, sf_dir, small=True), "grp", SHOWN_METRICS)
    return profile.tier_profile(nudged(raw), "grp", SHOWN_METRICS)


@query("prepare_features", f"""
WITH {FEATURES_SQL}, stats AS (SELECT avg(day_tenure) AS m, stddev_pop(day_tenure) AS s FROM feats)
SELECT customer, {len(METRICS)} + (SELECT count(DISTINCT cust_cat) FROM feats) AS slots, 1 AS levels,
  round((day_tenure - m) / s, 6) AS tenure, rank_of AS level
FROM feats, stats JOIN (SELECT cust_cat AS cat, row_number() OVER (ORDER BY count(*) DESC, cust_cat) - 1 AS rank_of
  FROM feats GROUP BY cust_cat) ON true WHERE cat = cust_cat""")
def prepare_features(spark, sf_dir):
    """Standardized metrics, then one slot per category, the most frequent first."""
    vector = vector_to_array("features")
    hot = F.slice(vector, len(METRICS) + 1, F.size(vector) - len(METRICS))
    return features.prepare_features(customer_inputs(spark, sf_dir)).select(
        "customer",
        F.size(vector).cast("long").alias("slots"),
        F.aggregate(hot, F.lit(0.0), lambda a, b: a + b).cast("int").alias("levels"),
        F.round(F.element_at(vector, 1), 6).alias("tenure"),
        (F.array_position(hot, F.lit(1.0)) - 1).alias("level"),
    )


TIER_OF_SQL = """scores AS (SELECT grp, max(r) FILTER (fam = 'p') * 0.7::DOUBLE + max(r) FILTER (fam = 'l') * 0.2::DOUBLE
  + max(r) FILTER (fam = 'd') * 0.1::DOUBLE AS score FROM fams GROUP BY grp),
tiers AS (SELECT grp, ['Platium', 'Gold', 'Silver', 'Bronze'][least(4, dense_rank() OVER (ORDER BY score DESC))] AS tier
  FROM scores)"""


@query("apply_tier_names", f"""
WITH {FEATURES_SQL}, {ALL_LONG_SQL},
ranked AS (SELECT grp, CASE WHEN metric LIKE '%discprice' THEN 'd' WHEN metric LIKE 'day%' THEN 'l' ELSE 'p' END AS fam,
  rank() OVER (PARTITION BY metric ORDER BY CASE metric WHEN 'day_between_purchases' THEN -v ELSE v END) AS r FROM long),
fams AS (SELECT grp, fam, rank() OVER (PARTITION BY fam ORDER BY sum(r)) AS r FROM ranked GROUP BY grp, fam),
{TIER_OF_SQL}
SELECT customer, tier FROM feats JOIN tiers ON grp = cust_cat""")
def apply_tier_names(spark, sf_dir):
    inputs = _grouped(spark, sf_dir)
    metrics = [m for m in metric_columns(inputs) if m != "grp"]
    tiers = profile.rule_based_tiers(profile.metric_interval(inputs, "grp", metrics), "grp", metrics)
    named = profile.apply_tier_names(inputs, tiers, "grp")
    return named.select("customer", F.col("grp").alias("tier"))


START, ROUNDS = 4, 2  # clusters that begin with the first customers by name, and rounds


def _lloyd_sql():
    """Standardized metrics in long form; centers c0, c1, ... and the labels by each."""
    long = " UNION ALL ".join(f"SELECT customer, {k} AS m, CASE WHEN s_{m} = 0 THEN 0 ELSE ({m} - m_{m}) / s_{m} END AS v FROM feats, stats" for k, m in enumerate(METRICS))
    parts = [
        "stats AS (SELECT " + ", ".join(f"avg({m}) AS m_{m}, stddev_pop({m}) AS s_{m}" for m in METRICS) + " FROM feats)",
        f"pts AS ({long})",
        f"first AS (SELECT customer, row_number() OVER (ORDER BY customer) - 1 AS c FROM feats ORDER BY customer LIMIT {START})",
        "c0 AS (SELECT c, m, v FROM first JOIN pts USING (customer))",
    ]
    for r in range(ROUNDS + 1):
        parts.append(f"d{r} AS (SELECT customer, c, sum((pts.v - c{r}.v) ** 2) AS d FROM pts JOIN c{r} USING (m) GROUP BY customer, c)")
        parts.append(f"l{r} AS (SELECT customer, arg_min(c, (round(d, 9), c)) AS label, min(d) AS d FROM d{r} GROUP BY customer)")
        parts.append(f"c{r + 1} AS (SELECT label AS c, m, avg(v) AS v FROM pts JOIN l{r} USING (customer) GROUP BY label, m)")
    return f"WITH {FEATURES_SQL}, {', '.join(parts)} SELECT customer, label, round(d, 6) AS distance FROM l{ROUNDS}"


def _points(spark, sf_dir):
    """customer, x (standardized metrics), h, cust_cat."""
    scaled = features.standardize(customer_inputs(spark, sf_dir), METRICS)
    return reliable(scaled.select("customer", F.array(*METRICS).alias("x"), F.xxhash64("customer").alias("h"), "cust_cat"))


@query("kmeans_rounds", _lloyd_sql())
def kmeans_rounds(spark, sf_dir):
    """Labels, and squared distances to the centers, after two rounds from stated centers."""
    points = _points(spark, sf_dir)
    centers = np.array([r.x for r in points.orderBy("customer").select("x").limit(START).collect()])
    (fit,) = batched.lloyd(points, [batched.Fit(START, 0, centers)], 0, ROUNDS)
    found = batched.labelled(points, [fit]).withColumn("label", F.col("labels")[0].cast("long"))
    at = F.element_at(F.array(*[F.array(*map(F.lit, c)) for c in fit.centers.tolist()]), F.col("labels")[0] + 1)
    apart = F.aggregate(F.zip_with("x", at, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda a, b: a + b)
    return found.select("customer", "label", F.round(apart, 6).alias("distance"))


@query("silhouettes", f"""
WITH {FEATURES_SQL}, stats AS (SELECT {", ".join(f"avg({m}) AS m_{m}, stddev_pop({m}) AS s_{m}" for m in METRICS)} FROM feats),
pts AS (SELECT customer, [{", ".join(f"({m} - m_{m}) / s_{m}" for m in METRICS)}] AS x, cust_cat, day_tenure > m_day_tenure AS old FROM feats, stats),
pairs AS (SELECT a.customer, a.cust_cat AS cat, b.cust_cat AS other_cat, a.old, b.old AS other_old, list_distance(a.x, b.x) AS d FROM pts a, pts b),
lab AS (SELECT 'category' AS grouping, customer, cat::VARCHAR AS own, other_cat::VARCHAR AS other, sum(d) AS s, count(*) AS n FROM pairs GROUP BY ALL
  UNION ALL SELECT 'tenure', customer, old::VARCHAR, other_old::VARCHAR, sum(d), count(*) FROM pairs GROUP BY ALL),
ab AS (SELECT grouping, customer, max(s / greatest(n - 1, 1)) FILTER (own = other) AS a, max(n) FILTER (own = other) AS size,
  min(s / n) FILTER (own <> other) AS b FROM lab GROUP BY grouping, customer)
SELECT grouping, round(avg(CASE WHEN size > 1 THEN (b - a) / greatest(a, b) ELSE 0 END) + 1e-9, 6) AS score FROM ab GROUP BY grouping""")
def silhouettes(spark, sf_dir):
    """Euclidean silhouettes of two given groupings: by category, and by a tenure above the mean."""
    points = _points(spark, sf_dir)
    rank = F.dense_rank().over(Window.orderBy("cust_cat")) - 1
    places = points.select("cust_cat").distinct().withColumn("rank", rank)
    of = F.array(F.col("rank"), (F.col("x")[0] > 0).cast("int"))
    labelled = reliable(points.join(F.broadcast(places), "cust_cat").select("customer", "x", of.alias("labels")))
    scores = batched.silhouettes(labelled, [places.count(), 2])
    found = spark.createDataFrame(list(zip(["category", "tenure"], scores, strict=True)), "grouping string, score double")
    return found.withColumn("score", F.round(F.col("score") + NUDGE, 6))


def _tiers(result):
    return result.customers.select("customer", F.col(f"`{LABEL}`").alias("tier"), "cust_cat", "day_tenure")


# The documented search: k from 3 to 10, 17 restarts of each.
@query("kmeans_tiers")
def kmeans_tiers(spark, sf_dir):
    return _tiers(segmentation.segment_kmeans(customer_inputs(spark, sf_dir)))


@query("kmeans_profile")
def kmeans_profile(spark, sf_dir):
    """The statistics per cluster."""
    return segmentation.segment_kmeans(customer_inputs(spark, sf_dir)).profile


@query("gmm_tiers")
def gmm_tiers(spark, sf_dir):
    return _tiers(segmentation.segment_gmm(customer_inputs(spark, sf_dir)))


@query("segmentation_job")
def segmentation_job(spark, sf_dir):
    """The customers of both output tables, with their tiers, and the mean of a metric from the profiles beside them."""
    out = segmentation.segmentation_job(customer_inputs(spark, sf_dir))
    rows = None
    for name in ("kMeans", "gmm"):
        people, profiled = out[f"{name}_custTier_output"], out[f"{name}_custTier_profile_statistics"]
        tiers = profiled.groupBy("CustTier").agg(F.count(F.lit(1)).alias("clusters"), F.avg("`day_tenure (mue)`").alias("tenure"))
        one = people.join(F.broadcast(tiers), F.col(f"`{LABEL}`") == F.col("CustTier"))
        one = one.select(F.lit(name).alias("model"), "customer", F.col("CustTier").alias("tier"), "clusters", "tenure")
        rows = one if rows is None else rows.unionByName(one)
    return rows
