"""Merkle manifest of a dataset: a tree per source, a tree over the sources, and a proof for every row.

Every node is labelled with the interval [lo, hi) of the leaf ranks below it, so ancestry is containment: a node of
level l lies in the bucket lo div 16^(l + 1) of the next level, where one join on (tree, bucket) finds the one interval
that contains its own. The parent carries the labels of its run; those that the node's own interval leaves over are its
siblings, before and after it. Paths are attached from the root down, to nodes, so a path is written once for 16 leaves.

Ranks come from ranges of (source, doc_id) whose sizes add up, so a source of any size spreads over the tasks. A
group is a run of at most 16 nodes. Nothing but the size of the largest tree reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricewright.llm.common import stored

FAN = 16
TAMPERED = 5  # rows whose crc32 it divides
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
STEP = "struct<before: string, after: string>"


def _field(value: Column) -> Column:
    """`-` for null, else bytes, colon, value: no two rows are written alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _leaf(text: Column) -> Column:
    return F.sha2(F.concat(*[_field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")], _field(text)), 256)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, source, leaf, shown: the row's digest, and the one its holder shows (of the tampered row, if it is one)."""
    text = F.col("text")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED == 0
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"), F.col("n_chars").cast("long").alias("n_chars"), text.cast("string").alias("text"),
    )
    leaf = _leaf(text)
    shown = F.when(tampered & text.rlike("[A-Z]"), _leaf(F.translate(text, UPPER, LOWER)))
    return rows.select("doc_id", "source", leaf.alias("leaf"), shown.alias("shown")).withColumn("shown", F.coalesce("shown", "leaf"))


def ranked(rows: DataFrame) -> DataFrame:
    """Adds tree (the source's rank, null first), n (rows of the source) and lo (the row's rank in it)."""
    order = ["doc_id", "leaf"]
    # Equal rows may be many: the place of a row keeps them apart when the ranges are cut.
    placed = stored(rows).withColumn("place", F.monotonically_increasing_id())
    cut = placed.repartitionByRange(F.col("source"), *order, "place").withColumn("slice", F.spark_partition_id())
    sliced = stored(cut.drop("place"))
    in_source = Window.partitionBy("source")
    runs = sliced.groupBy("source", "slice").agg(F.count(F.lit(1)).alias("rows"))
    runs = runs.select(
        "source", "slice",
        F.coalesce(F.sum("rows").over(in_source.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.sum("rows").over(in_source).alias("n"),
        F.min("slice").over(in_source).alias("first"),
    )
    runs = stored(runs)
    # Slices are ordered by source, so a source's rank is its rank among those that start in its first slice.
    starts = runs.where(F.col("slice") == F.col("first"))
    per_slice = starts.groupBy("slice").agg(F.count(F.lit(1)).alias("sources"))
    earlier = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)  # a row for each slice
    per_slice = per_slice.select(F.col("slice").alias("first"), F.coalesce(F.sum("sources").over(earlier), F.lit(0)).alias("sources"))
    nth = F.row_number().over(Window.partitionBy("first").orderBy("source")) - 1
    trees = starts.withColumn("nth", nth).join(per_slice, "first").select(F.col("source").alias("name"), (F.col("sources") + F.col("nth")).alias("tree"))
    runs = runs.join(trees, F.col("source").eqNullSafe(F.col("name"))).select(F.col("source").alias("name"), F.col("slice").alias("at"), "before", "n", "tree")
    inside = Window.partitionBy("source", "slice").orderBy(*order)
    numbered = sliced.withColumn("nth", F.row_number().over(inside) - 1)
    joined = numbered.join(runs, F.col("source").eqNullSafe(F.col("name")) & (F.col("slice") == F.col("at")))
    return joined.select("tree", "n", (F.col("before") + F.col("nth")).alias("lo"), *rows.columns)


def grow(leaves: DataFrame) -> list[DataFrame]:
    """Nodes by level. Leaves have tree, n, lo, hi and digest; nodes above have the labels of their run as well."""
    levels, span = [leaves], 1
    largest = leaves.agg(F.max("n")).first()[0] or 0
    while span < largest:
        span *= FAN
        run = F.sort_array(F.collect_list(F.struct("lo", "hi", "digest"))).alias("run")
        runs = levels[-1].where(F.col("n") > span // FAN).groupBy("tree", "n", _bucket("lo", span)).agg(run)
        nodes = runs.select(
            "tree", "n", F.col("run")[0]["lo"].alias("lo"), F.element_at("run", -1)["hi"].alias("hi"),
            F.sha2(F.array_join("run.digest", ""), 256).alias("digest"), "run",
        )
        levels.append(stored(nodes))
    return levels


def _bucket(lo: str, span: int) -> Column:
    return F.expr(f"{lo} div {span}").alias("bucket")


def _done(span: int) -> Column:
    """The one node left of its tree."""
    return F.col("n") <= span


def roots(levels: list[DataFrame]) -> DataFrame:
    """tree, digest of the node that remains."""
    out = None
    for level, nodes in enumerate(levels):
        last = nodes.where(_done(FAN**level)).select("tree", "digest")
        out = last if out is None else out.unionByName(last)
    return out


def descend(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The leaves with their path, the siblings of each level from the leaf up, and the other columns of their tree's
    row in ``tops``, whose path goes on from the tree's root."""
    carried = [c for c in tops.columns if c not in ("tree", "path")]
    above = None
    for level in reversed(range(len(levels))):
        nodes, span = levels[level], FAN ** (level + 1)
        here = nodes.where(_done(FAN**level)).join(tops, "tree")
        if above is not None:
            parents = above.select(
                F.col("tree").alias("p_tree"), F.col("lo").alias("p_lo"), F.col("hi").alias("p_hi"),
                F.col("run").alias("p_run"), F.col("path").alias("p_path"), _bucket("lo", span).alias("p_bucket"), *carried,
            )
            own = nodes.where(~_done(FAN**level)).withColumn("bucket", _bucket("lo", span))
            inside = (F.col("p_lo") <= F.col("lo")) & (F.col("hi") <= F.col("p_hi"))
            found = own.join(parents, (F.col("tree") == F.col("p_tree")) & (F.col("bucket") == F.col("p_bucket")) & inside)
            before = F.filter("p_run", lambda x: x["hi"] <= F.col("lo"))["digest"]
            after = F.filter("p_run", lambda x: x["lo"] >= F.col("hi"))["digest"]
            step = F.struct(F.array_join(before, "").alias("before"), F.array_join(after, "").alias("after"))
            found = found.select(*nodes.columns, F.concat(F.array(step), "p_path").cast(f"array<{STEP}>").alias("path"), *carried)
            here = here.select(*found.columns).unionByName(found)
        above = stored(here) if level else here
    return above


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, source, leaf, shown, subroot, root, path: one row for each row of docs.

    Rows of a source ascend by doc_id, null first, ties by digest; equal rows are leaves of their own. Null values
    are written `-`, a null source is a source. Of a single row leaf, subroot and root are equal and the path is empty;
    an empty table gives no rows. Texts of any length are read once and never exchanged.
    """
    leaves = stored(ranked(digests(docs)).withColumns({"hi": F.col("lo") + 1}).withColumnRenamed("leaf", "digest"))
    levels = grow(leaves)
    subroots = stored(roots(levels))
    heads = subroots.select(
        F.lit(0).cast("long").alias("tree"), F.lit(subroots.count()).cast("long").alias("n"),
        F.col("tree").alias("lo"), (F.col("tree") + 1).alias("hi"), "digest",
    )
    top = grow(stored(heads))
    empty = F.array().cast(f"array<{STEP}>")
    summit = roots(top).select("tree", F.col("digest").alias("root"), empty.alias("path"))
    paths = descend(top, summit).select(F.col("lo").alias("tree"), F.col("digest").alias("subroot"), "root", "path")
    found = descend(levels, stored(paths))
    return found.select("doc_id", "source", F.col("digest").alias("leaf"), "shown", "subroot", "root", "path")


def proofs(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: what a holder of a row and its path computes."""
    def fold(digest: Column, step: Column) -> Column:
        return F.sha2(F.concat(step["before"], digest, step["after"]), 256)

    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["before"], s["after"])), "")
    rows = manifest(docs).select(
        "doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), F.aggregate("path", F.col("shown"), fold).alias("folded_root")
    )
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))
