"""Grid searches over forests and boosted trees that share fits.

A forest of 100 trees contains that of 50, and a tree grown as deep as it goes contains those of every smaller depth, so
a fold needs one fit for each leaf size: trees are scored at every depth on one walk, and the sums over the first
trees are the smaller forests. Boosting shares what it can: 50 rounds are the beginning of 100.

Rows are first coded and folded into cells (codes, fold); what a tree sees of a cell is a weight and a sum of
labels, drawn row by row from a hash of the row and the tree. Blocks of trees, or sequences of rounds, are then tasks of
their own. That takes a checked number of cells: above LOCAL_CELLS the same trees grow on the table of cells, level by
level. Predictions come back by cell and are scored against the labels of the held-out cells by joins.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewright.operators.ranked import reliable
from pricewright.operators.trees import DEEPEST, Feature, Trees, matrix, boost, boost_spread, grow, grow_spread

BINS = 32  # of a numeric column
BLOCK = 5  # trees of a forest in a task
LOCAL_CELLS = 300_000  # that a task may hold
DRAWN, STEP, HELD, SENT = 1 << 18, 1 << 15, 1 << 23, 1 << 16  # rows drawn together and in one go; sums a task holds, and sends in one go
L2, LEAST_WEIGHT = 1.0, 1.0  # of boosting: the usual defaults of second-order trees
# The chance that a Poisson variable of mean 1 is at most 0, 1, 2, ...
POISSON = np.cumsum(np.exp(-1) / np.cumprod([1.0, *range(1, 13)]))


@dataclass(frozen=True)
class Encoding:
    """Codes of the categories (sorted, from 1) and of quantile bins; null and unknown categories have code 0."""

    values: dict[str, list[str]]
    edges: dict[str, list[float]]
    means: dict[str, float]

    @classmethod
    def fit(cls, df: DataFrame, categorical: list[str], numeric: list[str], bins: int = BINS) -> Encoding:
        shares = F.array(*[F.lit(k / bins) for k in range(1, bins)])
        of = {f"v{k}": F.sort_array(F.collect_set(F.col(f"`{c}`").cast("string"))) for k, c in enumerate(categorical)}
        of |= {f"e{k}": F.percentile_approx(F.col(f"`{c}`").cast("double"), shares, 100 * bins) for k, c in enumerate(numeric)}
        of |= {f"m{k}": F.avg(f"`{c}`") for k, c in enumerate(numeric)}
        row = df.agg(*[v.alias(k) for k, v in of.items()]).first()
        return cls(
            {c: list(row[f"v{k}"]) for k, c in enumerate(categorical)},
            {c: sorted(set(row[f"e{k}"] or [])) for k, c in enumerate(numeric)},
            {c: row[f"m{k}"] or 0.0 for k, c in enumerate(numeric)},
        )

    @property
    def features(self) -> list[Feature]:
        return [Feature(len(v)) for v in self.values.values()] + [Feature(len(e) + 1, True) for e in self.edges.values()]

    def codes(self) -> Column:
        out = []
        for c, values in self.values.items():
            known = F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")
            out.append(F.coalesce(F.array_position(known, F.col(f"`{c}`").cast("string")), F.lit(0)).cast("int"))
        for c, edges in self.edges.items():
            value = F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(self.means[c]))
            above = [(value > F.lit(e)).cast("int") for e in edges]
            out.append(sum(above, F.lit(1)))
        return F.array(*out)


@dataclass(frozen=True)
class TreeModel:
    """Trees over coded columns whose values add up; a forest's values are divided by its trees."""

    encoding: Encoding
    trees: list[Trees]
    base: float = 0.0

    def transform(self, df: DataFrame) -> DataFrame:
        """df with ``prediction``. The model goes to the tasks, as large as its nodes."""
        features, base = self.encoding.features, self.base
        trees = df.sparkSession.sparkContext.broadcast(self.trees)
        codes = df.select("*", self.encoding.codes().alias("_codes"))
        schema = codes.drop("_codes").withColumn("prediction", F.lit(0.0)).schema

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = matrix(batch.column("_codes")) if batch.num_rows else np.zeros((0, len(features)), int)
                total = np.full(batch.num_rows, base)
                for t in trees.value:
                    total += t.staged(rows, features, [DEEPEST])[0].sum(axis=0)
                yield batch.drop_columns(["_codes"]).append_column("prediction", pa.array(total, pa.float64()))

        return codes.mapInArrow(run, schema)


def coded(df: DataFrame, encoding: Encoding, label: str, fold: str) -> DataFrame:
    """codes, fold, y, id: stored, so that a row's id and with it what trees see of it stay the same."""
    rows = df.where(F.col(label).isNotNull())
    rows = rows.select(encoding.codes().alias("codes"), F.col(fold).cast("int").alias("fold"), F.col(label).cast("double").alias("y"))
    return reliable(rows.withColumn("id", F.monotonically_increasing_id()))


# The multipliers of XXH64.
_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))


def _settled(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    return h ^ (h >> np.uint64(32))


def _turned(h: np.ndarray, bits: int) -> np.ndarray:
    return (h << np.uint64(bits)) | (h >> np.uint64(64 - bits))


def _with_int(h: np.ndarray, value: int) -> np.ndarray:
    h = (h + _P5 + np.uint64(4)) ^ (np.uint64(value % (1 << 32)) * _P1)
    return _settled(_turned(h, 23) * _P2 + _P3)


def row_hashes(ids: np.ndarray, seed: int) -> np.ndarray:
    """xxhash64(id, seed) as Spark's function of that name gives it, unsigned."""
    with np.errstate(over="ignore"):
        lane = _turned(ids.astype(np.int64).view(np.uint64) * _P2, 31) * _P1
        h = (np.uint64(42) + _P5 + np.uint64(8)) ^ lane
        return _with_int(_settled(_turned(h, 27) * _P1 + _P4), seed)


def uniform(hashes: np.ndarray, t: int) -> np.ndarray:
    """In [0, 1), from the hashes of rows and seed, and the tree: xxhash64(id, seed, t)."""
    with np.errstate(over="ignore"):
        h = _with_int(hashes, t)
    return (h & np.uint64((1 << 53) - 1)).astype(float) / (1 << 53)


def plain_cells(rows: DataFrame) -> DataFrame:
    """codes, fold, t = -1, h, s: rows and label sums of every cell."""
    return rows.groupBy("codes", "fold").agg(F.count(F.lit(1)).cast("double").alias("h"), F.sum("y").alias("s")).select("codes", "fold", F.lit(-1).alias("t"), "h", "s")


def _distinct(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different rows of codes, and which of them each row is."""
    key, size = np.zeros(len(codes), np.int64), 1
    for c in codes.T.astype(np.int64):
        low, span = int(c.min(initial=0)), int(c.max(initial=0)) - int(c.min(initial=0)) + 1
        if size * span > 1 << 62:
            key = np.unique(key, return_inverse=True)[1]
            size = len(codes)
        key, size = key * span + (c - low), size * span
    _, first, which = np.unique(key, return_index=True, return_inverse=True)
    return codes[first], which


NO_FOLD = -(1 << 31)  # stands for a null fold


def _lists(x: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A list for each row."""
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel(), kind))


def drawn_cells(rows: DataFrame, trees: int, seed: int, share: float | None = None) -> DataFrame:
    """codes, fold, t, h, s: what each tree sees of a cell. With ``share`` a row is seen or not, else drawn with
    replacement, so that it counts as often as a Poisson variable of mean 1 says.

    Tasks add up what every tree sees of their cells and send that, a row for each cell with a list over the trees, which
    becomes rows behind the exchange. They hold HELD sums at most and send what they have when there are more.
    """

    def sent(cells: np.ndarray, h: np.ndarray, s: np.ndarray) -> Iterator[pa.RecordBatch]:
        for a in range(0, len(cells), max(1, SENT // trees)):
            part = slice(a, a + max(1, SENT // trees))
            fold = pa.array(cells[part, -1], pa.int32(), mask=cells[part, -1] == NO_FOLD)
            seen = [_lists(x[:, part].T, pa.float64()) for x in (h, s)]
            yield pa.RecordBatch.from_arrays([_lists(cells[part, :-1], pa.int32()), fold, *seen], ["codes", "fold", "h", "s"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = h = s = None
        for table in _together(batches):
            own = np.column_stack([matrix(table.column("codes").combine_chunks()), pc.fill_null(table.column("fold"), NO_FOLD).to_numpy()])
            y, hashes = table.column("y").to_numpy(), row_hashes(table.column("id").to_numpy(), seed)
            known = 0 if cells is None else len(cells)
            both, which = _distinct(own if cells is None else np.concatenate([cells, own]))
            weights, sums = np.zeros((trees, len(both))), np.zeros((trees, len(both)))
            if known:
                weights[:, which[:known]], sums[:, which[:known]] = h, s
            cells, h, s, which = both, weights, sums, which[known:]
            for t in range(trees):
                for a in range(0, len(y), STEP):
                    u = uniform(hashes[a : a + STEP], t)
                    w = (u < share).astype(np.int64) if share is not None else np.searchsorted(POISSON, u, side="right")
                    on = np.flatnonzero(w)
                    to, w = which[a : a + STEP][on], w[on]
                    h[t] += np.bincount(to, w, len(cells))
                    s[t] += np.bincount(to, w * y[a : a + STEP][on], len(cells))
            if h.size > HELD:
                yield from sent(cells, h, s)
                cells = h = s = None
        if cells is not None:
            yield from sent(cells, h, s)

    each = rows.select("codes", "fold", "y", "id").mapInArrow(run, "codes array<int>, fold int, h array<double>, s array<double>")
    dealt = each.repartition("codes", "fold").sortWithinPartitions("codes", "fold")
    return dealt.mapInArrow(_by_tree, "codes array<int>, fold int, t int, h double, s double")


def _by_tree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of cells, with lists h and s over the trees, added up: a row for each cell and tree that sees it."""

    def long(cells: np.ndarray, h: np.ndarray, s: np.ndarray) -> Iterator[pa.RecordBatch]:
        cell, t = np.nonzero(h)
        for a in range(0, len(t), SENT):
            c, u = cell[a : a + SENT], t[a : a + SENT]
            fold = pa.array(cells[c, -1], pa.int32(), mask=cells[c, -1] == NO_FOLD)
            columns = [_lists(cells[c, :-1], pa.int32()), fold, pa.array(u, pa.int32()), pa.array(h[c, u]), pa.array(s[c, u])]
            yield pa.RecordBatch.from_arrays(columns, ["codes", "fold", "t", "h", "s"])

    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cells = np.column_stack([matrix(batch.column("codes")), pc.fill_null(batch.column("fold"), NO_FOLD).to_numpy()])
        parts = (cells, matrix(batch.column("h")), matrix(batch.column("s")))
        cells, h, s = parts if held is None else (np.concatenate(p) for p in zip(held, parts, strict=True))
        first = np.append(0, np.flatnonzero((cells[1:] != cells[:-1]).any(axis=1)) + 1)
        cells, h, s = cells[first], np.add.reduceat(h, first, axis=0), np.add.reduceat(s, first, axis=0)
        yield from long(cells[:-1], h[:-1], s[:-1])
        held = cells[-1:], h[-1:], s[-1:]  # may go on in the next batch
    if held is not None:
        yield from long(*held)


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Successive rows together, DRAWN of them or more."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= DRAWN:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def packed(cells: DataFrame, *more: str) -> DataFrame:
    """A row for each cell, with lists of what the trees see of it, which are as long as there are trees."""
    rows = cells.groupBy("codes", "fold", *more).agg(F.collect_list(F.struct("t", "h", "s")).alias("of"))
    return rows.select("codes", "fold", *more, *[F.col(f"of.{c}").alias(c) for c in ("t", "h", "s")])


class Cells:
    """Cells of a task's rows, as arrays: h and s are [fold, tree, cell], where tree 0 has all rows."""

    def __init__(self, table: pa.Table, folds: int):
        codes = matrix(table.column("codes").combine_chunks()).astype(np.int64)
        self.codes, cell = np.unique(codes, axis=0, return_inverse=True)
        lists = table.column("t").combine_chunks()
        sizes = np.diff(np.asarray(lists.offsets))
        cell, fold = np.repeat(cell.ravel(), sizes), np.repeat(table.column("fold").to_numpy(), sizes)
        t, h, s = (np.asarray(table.column(c).combine_chunks().flatten()) for c in ("t", "h", "s"))
        self.trees, which = np.unique(np.append(t, -1), return_inverse=True)
        which = which[:-1]
        shape = (max(folds, int(fold.max(initial=0)) + 1), len(self.trees), len(self.codes))  # further folds only train
        self.h, self.s = np.zeros(shape), np.zeros(shape)
        self.h[fold, which, cell], self.s[fold, which, cell] = h, s

    def train(self, fold: int) -> tuple[np.ndarray, np.ndarray]:
        """[tree, cell], without the rows of a fold; of all rows for a fold that is none."""
        rest = [f for f in range(len(self.h)) if f != fold]
        return self.h[rest].sum(axis=0), self.s[rest].sum(axis=0)

    def held(self, fold: int) -> np.ndarray:
        """Cells that have rows in the fold."""
        return np.flatnonzero(self.h[fold, 0] > 0)


def _nodes(tree: int, trees: Trees, value: np.ndarray) -> pa.Table:
    n = len(trees)
    columns = {"part": np.full(n, tree), "node": np.arange(n), "tree": trees.tree, "feature": trees.feature, "code": trees.code, "yes": trees.yes, "no": trees.no, "value": value, "depth": trees.depth}
    return pa.table({k: pa.array(v) for k, v in columns.items()})


_NODES = "part long, node long, tree long, feature long, code long, yes long, no long, value double, depth long"


def _collected(nodes: DataFrame) -> list[Trees]:
    """The model on the driver, which is as large as its trees."""
    rows = nodes.orderBy("part", "node").toArrow()
    part = rows.column("part").to_numpy()
    edges = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(part)]])
    names = ("feature", "code", "yes", "no", "value", "tree", "depth")
    return [Trees(*[rows.column(c).to_numpy()[a:b].copy() for c in names]) for a, b in zip(edges, edges[1:], strict=False) if b > a]


def _blocks(counts: list[int]) -> list[tuple[int, int]]:
    """Trees [low, high) of each block: at most BLOCK, and none reaches over a number of trees that is scored."""
    edges = [0, *sorted(counts)]
    return [(a, min(a + BLOCK, high)) for low, high in itertools.pairwise(edges) for a in range(low, high, BLOCK)]


def _dealt(rows: DataFrame, key: str, n: int) -> DataFrame:
    """Dealt to enough partitions that few share one: what a task computes is large, however small its rows are."""
    return rows.repartition(4 * n, key)


def _in_blocks(rows: DataFrame, counts: list[int], seed: int) -> DataFrame:
    """Drawn and plain cells with their block."""
    blocks = _blocks(counts)
    block = F.coalesce(*[F.when(F.col("t") < high, F.lit(k)) for k, (_, high) in enumerate(blocks)])
    drawn = packed(drawn_cells(rows, max(counts), seed).withColumn("block", block), "block")
    plain = packed(plain_cells(rows)).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(len(blocks) - 1))))
    return drawn.unionByName(plain)


def forest_predictions(rows: DataFrame, features: list[Feature], grid: dict, folds: int, seed: int) -> DataFrame:
    """fold, codes, p: of every held-out cell, the predictions of all points in the order trees, depth, leaf."""
    counts, depths, leaves = sorted(grid["trees"]), [d or DEEPEST for d in grid["depth"]], grid["leaf"]
    if not small(rows):
        return _spread_forests(rows, features, grid, folds, seed)
    blocks = _blocks(counts)

    def fit(table: pa.Table) -> pa.Table:
        cells, block = Cells(table, folds), table.column("block")[0].as_py()
        out = []
        for fold in range(folds):
            held = cells.held(fold)
            h, s = (x[cells.trees >= 0] for x in cells.train(fold))
            n, m = len(h), len(leaves)
            deep, least = np.full(n * m, max(depths)), np.tile(np.array(leaves, float), n)
            model = grow(cells.codes, features, np.repeat(h, m, axis=0), -np.repeat(s, m, axis=0), 0.0, least, deep)
            found = model.staged(cells.codes[held], features, depths).reshape(len(depths), n, m, len(held)).sum(axis=1)
            out.append(_rows(fold, cells.codes[held], found.reshape(-1, len(held)), block=block))
        return pa.concat_tables(out)

    kind = "fold int, codes array<int>, block int, p array<double>"
    found = _dealt(_in_blocks(rows, counts, seed), "block", len(blocks)).groupBy("block").applyInArrow(fit, kind)
    parts = found.groupBy("fold", "codes").agg(F.sort_array(F.collect_list(F.struct("block", "p"))).alias("parts"))
    add = lambda a, b: F.zip_with(a, b["p"], lambda x, y: x + y)
    none = F.array_repeat(F.lit(0.0), len(depths) * len(leaves))

    def stage(n: int) -> Column:
        last = max(k for k, (_, high) in enumerate(blocks) if high <= n)
        return F.transform(F.aggregate(F.filter("parts", lambda x: x["block"] <= last), none, add), lambda x: x / n)

    return parts.select("fold", "codes", F.concat(*map(stage, grid["trees"])).alias("p"))


def _spread_forests(rows: DataFrame, features: list[Feature], grid: dict, folds: int, seed: int) -> DataFrame:
    """The same predictions, of trees that grow on the table of cells: a forest for each fold and leaf size."""
    counts, depths, leaves = grid["trees"], [d or DEEPEST for d in grid["depth"]], grid["leaf"]
    most, drawn, out = max(counts), reliable(drawn_cells(rows, max(counts), seed)), None
    for fold in range(folds):
        cells, models = arrays(drawn.where(F.col("fold") != fold), most), []
        for leaf in leaves:
            models.append(grow_spread(cells, features, most, 0.0, np.full(most, float(leaf)), np.full(most, max(depths))))

        def predict(codes: np.ndarray, models: list) -> np.ndarray:
            found = np.array([m.staged(codes, features, depths) for m in models])  # [leaf, depth, tree, row]
            stages = [found[:, :, :n].sum(axis=2) / n for n in counts]
            return np.array(stages).transpose(0, 2, 1, 3).reshape(-1, len(codes))

        part = _held_out(rows, fold, models, predict)
        out = part if out is None else out.unionByName(part)
    return out


def _held_out(rows: DataFrame, fold: int, models: list, predict) -> DataFrame:
    """fold, codes, p for the cells of a fold, predicted in the tasks that hold them."""
    known = rows.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                codes = matrix(batch.column("codes"))
                yield from _rows(fold, codes, predict(codes, known.value)).to_batches()

    cells = rows.where(F.col("fold") == fold).select("codes").distinct()
    return cells.mapInArrow(run, "fold int, codes array<int>, p array<double>")


def _rows(fold: int, codes: np.ndarray, found: np.ndarray, **constant: int) -> pa.Table:
    """A row for each cell, with a list of its predictions ([point, cell])."""
    n = len(codes)
    lists = lambda x, t: pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * x.shape[1], pa.int32()), pa.array(x.ravel(), t))
    columns = {"fold": pa.array([fold] * n, pa.int32()), "codes": lists(codes, pa.int32())}
    columns |= {k: pa.array([v] * n, pa.int32()) for k, v in constant.items()}
    return pa.table(columns | {"p": lists(np.ascontiguousarray(found.T), pa.float64())})


def fit_forest(rows: DataFrame, features: list[Feature], trees: int, depth: int | None, leaf: int, seed: int) -> list[Trees]:
    """The forest on all rows; its values are divided by the number of trees."""
    deep, least = np.array([depth or DEEPEST]), np.array([float(leaf)])

    def fit(table: pa.Table) -> pa.Table:
        cells = Cells(table, 1)
        h, s = (x[cells.trees >= 0] for x in cells.train(-1))
        model = grow(cells.codes, features, h, -s, 0.0, np.repeat(least, len(h)), np.repeat(deep, len(h)))
        return _nodes(table.column("block")[0].as_py(), model, model.value / trees)

    rows = rows.withColumn("fold", F.lit(0))
    if small(rows):
        dealt = _dealt(_in_blocks(rows, [trees], seed), "block", len(_blocks([trees])))
        return _collected(dealt.groupBy("block").applyInArrow(fit, _NODES))
    model = grow_spread(arrays(drawn_cells(rows, trees, seed), trees), features, trees, 0.0, np.repeat(least, trees), np.repeat(deep, trees))
    model.value = model.value / trees
    return [model]


def arrays(drawn: DataFrame, trees: int) -> DataFrame:
    """codes, h, g: of every cell an entry for each tree, zero where the tree does not see it. A cell has one row for
    each tree at most."""
    summed = drawn.groupBy("codes", "t").agg(F.sum("h").alias("h"), F.sum("s").alias("s"))
    by_tree = summed.groupBy("codes").agg(F.map_from_entries(F.collect_list(F.struct("t", F.struct("h", "s")))).alias("of"))
    number = F.sequence(F.lit(0), F.lit(trees - 1))
    entry = lambda name, sign: F.transform(number, lambda t: sign * F.coalesce(F.col("of")[t][name], F.lit(0.0)))
    return reliable(by_tree.select("codes", entry("h", 1).alias("h"), entry("s", -1).alias("g")))


def small(rows: DataFrame, most: int | None = None) -> bool:
    """Whether a task may hold the cells."""
    most = LOCAL_CELLS if most is None else most
    return rows.select("codes", "fold").distinct().limit(most + 1).count() <= most


def boost_predictions(rows: DataFrame, features: list[Feature], grid: dict, folds: int, seed: int) -> DataFrame:
    """fold, codes, p: of every held-out cell, the predictions of all points in the order trees, depth, rate, subsample."""
    stages, depths, shares = sorted(grid["trees"]), [d or DEEPEST for d in grid["depth"]], grid["subsample"]
    if not small(rows):
        return _spread_boosts(rows, features, grid, folds, seed)
    tasks = list(itertools.product(range(folds), range(len(grid["rate"])), range(len(shares))))

    def fit(table: pa.Table) -> pa.Table:
        fold, rate, share = tasks[table.column("task")[0].as_py()]
        cells = Cells(table, folds)
        held = cells.held(fold)
        h, s = cells.train(fold)
        base = s[0].sum() / max(1.0, h[0].sum())
        seen = np.flatnonzero(cells.trees >= 0) if shares[share] < 1 else np.zeros(max(stages), int)
        weights, sums = (np.broadcast_to(x[seen][:, None, :], (len(seen), len(depths), x.shape[1])) for x in (h, s))
        found, _ = boost(cells.codes, features, weights, sums, base, np.full(len(depths), grid["rate"][rate]), L2, LEAST_WEIGHT, np.array(depths), stages)
        order = [stages.index(n) for n in grid["trees"]]
        return _rows(fold, cells.codes[held], found[order][:, :, held].reshape(-1, len(held)), rate=rate, share=share)

    parts = []
    for k, share in enumerate(shares):
        own = [t for t, (_, _, j) in enumerate(tasks) if j == k]
        cells = plain_cells(rows)
        if share < 1:
            cells = cells.unionByName(drawn_cells(rows, max(stages), seed, share))
        parts.append(reliable(packed(cells)).withColumn("task", F.explode(F.array(*map(F.lit, own)))))
    dealt = parts[0]
    for part in parts[1:]:
        dealt = dealt.unionByName(part)
    kind = "fold int, codes array<int>, rate int, share int, p array<double>"
    found = _dealt(dealt, "task", len(tasks)).groupBy("task").applyInArrow(fit, kind)
    of = F.map_from_entries(F.collect_list(F.struct(F.col("rate") * len(shares) + F.col("share"), "p")))
    by_cell = found.groupBy("fold", "codes").agg(of.alias("of"))
    points = itertools.product(range(len(grid["trees"])), range(len(depths)), range(len(grid["rate"])), range(len(shares)))
    p = F.array(*[F.col("of")[r * len(shares) + s][n * len(depths) + d] for n, d, r, s in points])
    return by_cell.select("fold", "codes", p.alias("p"))


def _spread_boosts(rows: DataFrame, features: list[Feature], grid: dict, folds: int, seed: int) -> DataFrame:
    """The same predictions, of rounds on the table of cells: a sequence for each fold, depth, rate and share."""
    counts, most, out = grid["trees"], max(grid["trees"]), None
    for fold in range(folds):
        train, models = rows.where(F.col("fold") != fold), []
        base = train.agg(F.avg("y")).first()[0] or 0.0
        seen = {share: _seen(train, most, share, seed) for share in grid["subsample"]}
        for depth, rate, share in itertools.product(grid["depth"], grid["rate"], grid["subsample"]):
            models.append(boost_spread(seen[share], features, base, rate, L2, LEAST_WEIGHT, depth or DEEPEST, most))

        def predict(codes: np.ndarray, models: list, base: float = base) -> np.ndarray:
            each = np.array([[t.staged(codes, features, [DEEPEST])[0, 0] for t in rounds] for rounds in models])
            return np.concatenate([base + each[:, :n].sum(axis=1) for n in counts])

        part = _held_out(rows, fold, models, predict)
        out = part if out is None else out.unionByName(part)
    return out


def _seen(rows: DataFrame, trees: int, share: float, seed: int) -> DataFrame:
    """codes, w, s: rows and label sums of every cell that each round sees."""
    if share < 1:
        drawn = drawn_cells(rows, trees, seed, share).unionByName(plain_cells(rows).select("codes", "fold", F.lit(0).alias("t"), F.lit(0.0).alias("h"), F.lit(0.0).alias("s")))
        table, pick = arrays(drawn, trees), lambda c: c
    else:
        table, pick = arrays(plain_cells(rows).withColumn("t", F.lit(0)), 1), lambda c: F.array_repeat(c[0], trees)
    return reliable(table.select("codes", pick(F.col("h")).alias("w"), F.transform(pick(F.col("g")), lambda x: -x).alias("s")))


def fit_boost(rows: DataFrame, features: list[Feature], trees: int, depth: int | None, rate: float, share: float, seed: int) -> tuple[float, list[Trees]]:
    """The mean label and the rounds on all rows."""
    rows, deep = rows.withColumn("fold", F.lit(0)), depth or DEEPEST
    base = rows.agg(F.avg("y")).first()[0] or 0.0
    cells = plain_cells(rows)
    if share < 1:
        cells = cells.unionByName(drawn_cells(rows, trees, seed, share))
    if not small(rows):
        return base, boost_spread(_seen(rows, trees, share, seed), features, base, rate, L2, LEAST_WEIGHT, deep, trees)

    def fit(table: pa.Table) -> pa.Table:
        cells = Cells(table, 1)
        h, s = cells.train(-1)
        seen = np.flatnonzero(cells.trees >= 0) if share < 1 else np.zeros(trees, int)
        _, rounds = boost(cells.codes, features, h[seen][:, None], s[seen][:, None], base, np.array([rate]), L2, LEAST_WEIGHT, np.array([deep]), [trees])
        return pa.concat_tables([_nodes(k, t, t.value) for k, t in enumerate(rounds)])

    return base, _collected(packed(cells).groupBy(F.lit(0).alias("all")).applyInArrow(fit, _NODES))


def scores(rows: DataFrame, predicted: DataFrame, predictors: int) -> list[list]:
    """For every fold, the (smape, adjusted R2) of all points."""
    labels = rows.groupBy("fold", "codes", "y").agg(F.count(F.lit(1)).alias("n"))
    each = labels.join(predicted, ["fold", "codes"]).select("fold", "y", "n", F.posexplode("p").alias("point", "q"))
    half = (F.abs("y") + F.abs("q")) / 2
    apart = F.when(half == 0, 0.0).otherwise(F.abs(F.col("y") - F.col("q")) / half)
    n, y, q = F.sum("n"), F.col("y"), F.col("q")
    spread = F.sum(F.col("n") * y * y) - F.sum(F.col("n") * y) * F.sum(F.col("n") * y) / n
    unexplained = F.try_divide(F.sum(F.col("n") * (y - q) * (y - q)), spread)
    adjusted = 1 - unexplained * F.try_divide((n - 1).cast("double"), (n - predictors - 1).cast("double"))
    found = each.groupBy("fold", "point").agg((100 * F.sum(F.col("n") * apart) / n).alias("smape"), adjusted.alias("r2")).collect()
    out: dict[int, dict] = {}
    for r in found:
        out.setdefault(r.fold, {})[r.point] = (r.smape, r.r2)
    return [[points[k] for k in sorted(points)] for _, points in sorted(out.items())]
