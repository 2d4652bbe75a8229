"""Near-duplicate documents: BagMinHash signatures, bands, and verified multiset overlap.

A document is the multiset of its five-word shingles. Each shingle runs Poisson processes over the dyadic pieces of
its weight [0, 1), [1, 2), [2, 4), ...; a point belongs to one of M signature components and counts if it lies
below the shingle's weight. A component keeps its earliest point, so two components agree with the probability of
the weighted Jaccard similarity; points later than all components are never generated. Signatures are banded,
candidates are checked by their exact multisets, and links are joined to classes.

Equal multisets are one node from the start. In a band's bucket every node is compared with one leader, the node
that shares most buckets with others. Nodes of buckets that still hold several classes are paired across classes
where they can be similar at all: they must have one of their rarest shingles in common, with enough behind it, and
signatures that allow it. No bucket is expanded into all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricewright.llm.common import exact, gathered, lowered, mark, mix, one, only, partitions, span_hashes, stored, text_bytes, whole, word_spans

WORDS = 5  # in a shingle
SEEDS = (0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)
M, BANDS = 128, 32  # components; a pair of similarity 0.8 misses all bands of four with probability 5e-8
SIMILAR = 0.8
# Of 128 two-bit components, a pair of similarity 0.8 differs in 19 on average, with a deviation of 4.
DIFFER = 40
CHUNK = 4_000_000
_ODD = np.uint64(0x9E3779B97F4A7C15)


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every shingle. A text of one to four words is one shingle, a text without words has none."""
    data = lowered(data)
    starts, ends, before = word_spans(data, offsets)
    return chained(span_hashes(data, starts, ends), before)[:2]


def chained(words: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash and first word of every shingle, from the words' hashes and the words before each row."""
    sizes = np.diff(before)
    row = np.repeat(np.arange(len(sizes)), sizes)
    with np.errstate(over="ignore"):
        whole = np.zeros(max(0, len(words) - WORDS + 1), np.uint64)
        for k in range(WORDS):
            whole = mix(whole * _ODD + words[k : len(words) - WORDS + 1 + k]) if len(whole) else whole
        inside = row[: len(whole)] == row[WORDS - 1 :] if len(whole) else np.zeros(0, bool)
        short = np.flatnonzero((sizes > 0) & (sizes < WORDS))
        few = np.zeros(len(short), np.uint64)
        for k in range(WORDS - 1):
            on = sizes[short] > k
            few[on] = mix(few[on] * _ODD + words[before[short[on]] + k])
        few = mix(few + np.uint64(1))
    at = np.concatenate([np.flatnonzero(inside), before[short]])
    return np.concatenate([row[: len(whole)][inside], short]), np.concatenate([whole[inside], few]), at


def exact_shingles(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and name of every shingle; names are equal for shingles of the same words, byte for byte, only."""
    data, offsets = text_bytes(column)
    data = lowered(data)
    starts, ends, before = word_spans(data, offsets)
    words = span_hashes(data, starts, ends)
    words = exact(data, starts, ends, words, np.argsort(words))
    row, names, at = chained(words, before)
    order = np.argsort(names)
    a, b = order[:-1], order[1:]
    pair = np.flatnonzero(names[a] == names[b])
    a, b = a[pair], b[pair]
    size = np.minimum(np.diff(before), WORDS)
    padded = np.append(words, np.zeros(WORDS, np.uint64))
    same = size[row[a]] == size[row[b]]
    for k in range(WORDS):
        same &= (padded[at[a] + k] == padded[at[b] + k]) | (k >= size[row[a]])
    if not same.all():
        inside = np.arange(WORDS) < size[row][:, None]
        tuples = np.where(inside, padded[at[:, None] + np.arange(WORDS)], np.uint64(0))
        tuples = np.column_stack([tuples, size[row].astype(np.uint64)])
        names = np.unique(tuples, axis=0, return_inverse=True)[1].ravel().astype(np.uint64)
    return row, names


def bags(row: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash and count of every different shingle of a row."""
    with np.errstate(over="ignore"):
        key = mix(hashes + row.astype(np.uint64) * _ODD)
    order = np.argsort(key)
    first = np.flatnonzero(np.diff(key[order], prepend=key[order][:1] + np.uint64(1)))
    counts = np.diff(np.append(first, len(order)))
    at = order[first]
    return row[at], hashes[at], counts


def signatures(row: np.ndarray, hashes: np.ndarray, counts: np.ndarray, rows: int, m: int = M) -> np.ndarray:
    """M earliest times for each row; infinite for a row without shingles."""
    earliest = np.full(rows * m, np.inf)
    # Pieces of the weight: [0, 1), [1, 2), [2, 4), ... as far as the count reaches.
    parts = [(row, mix(hashes), np.zeros(len(row), np.int64), np.ones(len(row), np.int64), counts)]
    low = 1
    while True:
        more = counts > low
        if not more.any():
            break
        with np.errstate(over="ignore"):
            seed = mix(hashes[more] + np.uint64(low) * np.uint64(0xD6E8FEB86659FD93))
        parts.append((row[more], seed, np.full(int(more.sum()), low), np.full(int(more.sum()), low), counts[more]))
        low *= 2
    row, seed, start, size, count = (np.concatenate(x) for x in zip(*parts, strict=True))
    time, limit, turn = np.zeros(len(row)), np.full(rows, np.inf), 0
    scale = 1.0 / (1 << 53)
    while len(row):
        turn += 1
        with np.errstate(over="ignore"):
            draw = mix(seed + np.uint64(turn) * _ODD)
            spot = mix(draw ^ np.uint64(0xA0761D6478BD642F))
        time = time - np.log(((draw >> np.uint64(11)).astype(float) + 0.5) * scale) / size
        component = (spot & np.uint64(m - 1)).astype(np.int64)
        place = start + ((spot >> np.uint64(20)) % size.astype(np.uint64)).astype(np.int64)
        hit = (place < count) & (time < limit[row])
        np.minimum.at(earliest, row[hit] * m + component[hit], time[hit])
        limit = earliest.reshape(rows, m).max(axis=1)
        on = time < limit[row]
        row, seed, start, size, count, time = (x[on] for x in (row, seed, start, size, count, time))
    return earliest.reshape(rows, m)


def signed(docs: DataFrame) -> DataFrame:
    """row (unique), doc_id, mark, k1 and k2 (of the multiset), size (shingles), bands, and the signature in two bits a component (s0..s3)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = TaskContext.get().partitionId() << 36
        for table in gathered(batches, "text", CHUNK):
            n = table.num_rows
            at, hashes, counts, keys = described(one(table.column("text")))
            times = signatures(at, hashes, counts, n)
            with np.errstate(over="ignore"):
                values = mix(times.view(np.uint64))
                quads = values.reshape(n, BANDS, M // BANDS)
                band = np.zeros((n, BANDS), np.uint64) + np.arange(BANDS, dtype=np.uint64)
                for k in range(M // BANDS):
                    band = mix(band * _ODD + quads[:, :, k])
            bits = (values & np.uint64(3)).reshape(n, 4, 32) << (np.arange(32, dtype=np.uint64) * np.uint64(2))
            packed = np.bitwise_or.reduce(bits, axis=2).view(np.int64)
            some = np.isfinite(times[:, 0])
            lengths = np.where(some, BANDS, 0)
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lengths)), pa.int32()), pa.array(band[some].ravel().view(np.int64)))
            columns = [pa.array(seen + np.arange(n)), one(table.column("doc_id")), one(table.column("mark")), pa.array(keys[0].view(np.int64)), pa.array(keys[1].view(np.int64)), pa.array(np.bincount(at, counts, n).astype(np.int64)), lists, *[pa.array(np.ascontiguousarray(packed[:, k])) for k in range(4)]]
            yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "mark", "k1", "k2", "size", "bands", "s0", "s1", "s2", "s3"])
            seen += n

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), mark(), whole())
    return rows.mapInArrow(run, "row long, doc_id long, mark long, k1 long, k2 long, size long, bands array<long>, s0 long, s1 long, s2 long, s3 long")


def alike(pairs: DataFrame, nodes: DataFrame, differ: int = DIFFER) -> DataFrame:
    """Of pairs a, b those whose signatures differ in at most that many components."""
    for side in ("a", "b"):
        signs = nodes.select(F.col("node").alias(side), *[F.col(f"s{k}").alias(f"{side}{k}") for k in range(4)])
        pairs = pairs.join(signs, side)
    return pairs.where(_differences("a", "b") <= differ).select("a", "b")


def _differences(a: str, b: str):
    count = None
    for k in range(4):
        x = F.col(f"{a}{k}").bitwiseXOR(F.col(f"{b}{k}"))
        one = F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555)))
        count = one if count is None else count + one
    return count


def described(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash and count of every different shingle, and two hashes of each row's multiset, from words hashed with
    two seeds: different multisets have one and the same pair with a probability of 2^-128."""
    data, offsets = text_bytes(column)
    data = lowered(data)
    starts, ends, before = word_spans(data, offsets)
    keys = np.zeros((2, len(column)), np.uint64)
    with np.errstate(over="ignore"):
        for key, seed in zip(keys, SEEDS, strict=True):
            row, hashes, _ = chained(span_hashes(data, starts, ends, seed), before)
            np.add.at(key, row, mix(hashes ^ np.uint64(seed)))
    return *bags(row, hashes), keys


def texts_of(wanted: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """node, text for the nodes in wanted."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), mark(), whole())
    known = wanted.join(nodes.select("node", "doc_id", "mark", "k1", "k2"), "node")
    same = texts["doc_id"].eqNullSafe(known["doc_id"]) & (texts["mark"] == known["mark"])
    found = texts.join(known, same).select("node", "k1", "k2", "text")

    def right(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Drop texts of the same doc_id that are not the node's."""
        for table in gathered(batches, "text", CHUNK):
            *_, keys = described(one(table.column("text")))
            own = [one(table.column(c)).to_numpy(zero_copy_only=False).view(np.uint64) for c in ("k1", "k2")]
            same = (keys[0] == own[0]) & (keys[1] == own[1])
            yield from table.select(["node", "text"]).filter(pa.array(same)).to_batches()

    return found.mapInArrow(right, "node long, text string")


def rare_first(texts: DataFrame, sizes: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """shingle, node, before: the rarest shingles of each node that another node has too.

    A node's shingles are ordered by how many nodes have them; before is its mass in front of the shingle. What two
    nodes share comes in this order too, so a pair as similar as asked has its first common shingle where at most
    1 - similar of either node's mass is in front.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in gathered(batches, "text", CHUNK):
            at, hashes, counts = bags(*shingles(*text_bytes(one(table.column("text")))))
            node = one(table.column("node")).to_numpy(zero_copy_only=False)[at]
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(hashes.view(np.int64)), pa.array(counts)], ["node", "shingle", "n"])

    each = stored(texts.mapInArrow(run, "node long, shingle long, n long").dropDuplicates(["node", "shingle"]))
    common = stored(each.groupBy("shingle").agg(F.count(F.lit(1)).alias("nodes")).where("nodes > 1"))
    order = Window.partitionBy("node").orderBy(F.coalesce("nodes", F.lit(1)), "shingle").rowsBetween(Window.unboundedPreceding, -1)
    ranked = each.join(common, "shingle", "left").withColumn("before", F.coalesce(F.sum("n").over(order), F.lit(0)))
    early = F.col("before") <= F.col("size") * (1 - similar) + 1e-6
    return ranked.where("nodes is not null").join(sizes, "node").where(early).drop("n", "nodes")


def verified(pairs: DataFrame, own: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """Of pairs a, b those whose multisets overlap enough, with their similarity. own: the nodes' texts.

    A node b that very many others are paired with is split by the join.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in gathered(batches, "text", CHUNK // 2):
            a, b = (one(table.column(c)).to_numpy(zero_copy_only=False) for c in ("a", "b"))
            _, first, which = np.unique(b, return_index=True, return_inverse=True)
            others = one(table.column("other").take(pa.array(first)))  # once for each b
            both = _bag_list(pa.concat_arrays([one(table.column("text")), others]))
            mine, others = both[: table.num_rows], both[table.num_rows :]
            shares = np.array([_similarity(x, others[k]) for x, k in zip(mine, which.tolist(), strict=True)])
            ok = shares >= similar
            yield pa.RecordBatch.from_arrays([pa.array(a[ok]), pa.array(b[ok]), pa.array(shares[ok])], ["a", "b", "similarity"])

    met = pairs.join(own.select(F.col("node").alias("a"), "text"), "a")
    met = met.join(own.select(F.col("node").alias("b"), F.col("text").alias("other")), "b")
    return met.select("a", "b", "text", "other").mapInArrow(compare, "a long, b long, similarity double")


def _bag_list(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sorted shingles and counts of each row."""
    row, names = exact_shingles(column)
    order = np.lexsort((names, row))
    row, names = row[order], names[order]
    first = np.flatnonzero(np.append(True, (names[1:] != names[:-1]) | (row[1:] != row[:-1]))) if len(row) else row
    hashes, counts = names[first], np.diff(np.append(first, len(row)))
    edges = np.searchsorted(row[first], np.arange(len(column) + 1)).tolist()
    return [(hashes[a:b], counts[a:b]) for a, b in zip(edges, edges[1:], strict=False)]


def _similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    if not len(a[0]) or not len(b[0]):
        return float(len(a[0]) == len(b[0]))
    place = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
    both = int(np.minimum(b[1][place], a[1])[b[0][place] == a[0]].sum())
    return both / (int(a[1].sum()) + int(b[1].sum()) - both)


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of the edges a, b: the least node it is connected with.

    Alternates two steps until all components are stars: every node's larger neighbours move to its least neighbour,
    then its smaller ones do. The minima are stored, so the joins deal both sides anew and a hub can be split.
    """
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        ends = now.select("a", F.lit(1).alias("out"), F.lit(False).alias("root")).unionAll(now.select("b", F.lit(0), F.lit(True)))
        loose = ends.groupBy("a").agg(F.sum("out").alias("out"), F.max("root").alias("root"))
        if loose.where("out > 1 or (out = 1 and root)").isEmpty():
            break
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m")))
        large = stored(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        least = stored(large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = stored(small.unionAll(least.select("a", F.col("m").alias("b"))).distinct())
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def near_roots(edges: DataFrame, reach: int = 5) -> DataFrame:
    """node, root: the least node within ``reach`` links. Nodes of one root are connected; the reverse need not hold."""
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = stored(both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m")))
    for _ in range(reach - 1):
        next_to = both.join(least.select(F.col("a").alias("b"), "m"), "b")
        least = stored(next_to.groupBy("a").agg(F.min("m").alias("m")))
    return least.select(F.col("a").alias("node"), F.col("m").alias("root"))


def _apart(pairs: DataFrame, roots: DataFrame, a: str, b: str) -> DataFrame:
    """The pairs with their columns a and b replaced by their roots, without those that are then the same."""
    for side in (a, b):
        known = roots.select(F.col("node").alias(side), F.col("root").alias("_root"))
        pairs = pairs.join(known, side, "left").withColumn(side, F.coalesce("_root", side)).drop("_root")
    return pairs.where(F.col(a) != F.col(b))


def across(rest: DataFrame, texts: DataFrame, nodes: DataFrame, tested: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """Pairs a, b of nodes in rest (node, root) that are of different roots, not tested yet, and may be similar.

    They have one of their rare shingles in common, the mass behind it is enough, and their signatures differ in no
    more than ``off`` components.
    """
    sizes = nodes.select("node", "size", *[f"s{k}" for k in range(4)]).join(rest, "node")
    rows = stored(rare_first(texts, sizes, similar))

    def side(name: str) -> DataFrame:
        columns = {"node": "", "root": "root", "size": "size", "before": "before", **{f"s{k}": str(k) for k in range(4)}}
        return rows.select("shingle", *[F.col(c).alias(f"{name}{new}") for c, new in columns.items()])

    # similarity = both / (size a + size b - both), and both is at most what lies behind the first common shingle.
    most = F.least(F.col("asize") - F.col("abefore"), F.col("bsize") - F.col("bbefore")) * (1 + similar)
    may = most >= similar * (F.col("asize") + F.col("bsize")) - 1e-6
    off = _differences("a", "b")
    met = side("a").join(side("b"), "shingle").where((F.col("aroot") < F.col("broot")) & may & (off <= DIFFER))
    met = met.select("a", "b", "aroot", "broot", off.alias("off")).distinct()
    known = tested.unionAll(tested.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return met.join(known, ["a", "b"], "left_anti")


def classes(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """doc_id, class_id, class_size, kept, mark: one row for each row of docs.

    class_id is the least doc_id of the class and the row that has it is kept; null doc_ids come last, and of
    repeated rows one is kept. Texts without a word (null, empty, white space) are one class. An empty table gives
    no rows.
    """
    rows = stored(signed(docs))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "mark")).alias("first")
    same = rows.groupBy("k1", "k2").agg(first, F.count(F.lit(1)).alias("n"), F.first("bands").alias("bands"), F.first("size").alias("size"), *[F.first(f"s{k}").alias(f"s{k}") for k in range(4)])
    nodes = stored(same.withColumn("node", F.col("first.row")).withColumns({"doc_id": F.col("first.doc_id"), "mark": F.col("first.mark")}))
    banded = nodes.select(F.explode("bands").alias("key"), "node")
    sizes = stored(banded.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"))
    shared = stored(banded.join(sizes, "key"))
    # The leader of a bucket: the node that meets others most often.
    degree = shared.groupBy("node").agg(F.sum(F.col("size") - 1).alias("degree"))
    leader = F.max(F.struct("degree", (-F.col("node")).alias("back"))).alias("top")
    leaders = stored(shared.join(degree, "node").groupBy("key").agg(leader).select("key", (-F.col("top.back")).alias("b")))
    pairs = shared.select("key", F.col("node").alias("a")).join(leaders, "key").where("a <> b").select("a", "b").distinct()
    tested = stored(alike(pairs, nodes))
    involved = tested.select(F.col("a").alias("node")).unionAll(tested.select(F.col("b").alias("node"))).distinct()
    links = stored(verified(tested, texts_of(involved, nodes, docs), similar))
    # What shares a bucket, but is not known to be of one class yet.
    found = near_roots(links)
    placed = stored(shared.select("key", "node").join(found, "node", "left").withColumn("root", F.coalesce("root", "node")))
    mixed = stored(placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("key"))
    rest = stored(placed.join(mixed, "key").select("node", "root").distinct())
    if not rest.isEmpty():
        own = stored(texts_of(rest.select("node"), nodes, docs))
        more = stored(across(rest, own, nodes, tested, similar))
        # The likeliest pair of any two classes first; the others only while those are still two.
        best = F.min(F.struct("off", "a", "b")).alias("x")
        likeliest = stored(more.groupBy("aroot", "broot").agg(best).select("x.a", "x.b", "aroot", "broot"))
        new = stored(verified(likeliest.select("a", "b"), own, similar))
        links = links.unionByName(new)
        joined = new.join(likeliest, ["a", "b"]).select(F.col("aroot").alias("a"), F.col("broot").alias("b"))
        left = _apart(more.join(likeliest, ["a", "b"], "left_anti"), near_roots(joined, 2), "aroot", "broot").select("a", "b")
        left = stored(left)
        if not left.isEmpty():
            links = links.unionByName(stored(verified(left, own, similar)))
    ends = stored(_apart(links.select("a", "b"), found, "a", "b").distinct())
    last = stored(components(ends)).select(F.col("node").alias("root"), F.col("root").alias("last"))
    member = nodes.select("k1", "k2", "node", "n", "first").join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    member = stored(member.join(last, "root", "left").withColumn("root", F.coalesce("last", "root")).drop("last"))
    whole_class = member.groupBy("root").agg(F.min("first").alias("kept"), F.sum("n").alias("class_size"))
    member = stored(member.select("k1", "k2", "root").join(stored(whole_class), "root"))
    out = rows.select("row", "doc_id", "mark", "k1", "k2").join(member, ["k1", "k2"])
    return out.select("doc_id", F.col("kept.doc_id").alias("class_id"), "class_size", (F.col("row") == F.col("kept.row")).alias("kept"), "mark")


def deduplicated(docs: DataFrame) -> DataFrame:
    """One row of each class, with its columns."""
    return only(docs, classes(docs).where("kept"))
