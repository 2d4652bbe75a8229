"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint of 64 bits is cut into only two segments of 32. Of three differing bits one segment has at most one, so
two fingerprints to be linked have a segment that is equal but for one bit at a known place. Every different
fingerprint is indexed under the 2 x 32 segments with one bit wiped; an equality join on those brings all candidates
together, and candidates are verified on all 64 bits.

A bucket of many fingerprints, as a large group of near copies makes, is not compared pair by pair: its members
go to a second level, where the other segment is cut and wiped in the same way. What they have in common then
leaves 18 bits, so a bucket of the second level holds at most 2^18 fingerprints whatever the input, and is
probed with all masks of up to three bits. A task sends a spanning forest of the links it found, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewright.llm.common import gathered, lowered, one, partitions, stored, text_bytes, whole, word_spans, xxh64
from pricewright.llm.neardup import components

WORDS = 3  # in a shingle
SEED = 42
NEAR = 3  # differing bits
CHUNK = 4_000_000  # bytes of text
SPANS = 400_000  # hashed at a time
PAIRWISE = 1024  # fingerprints of a bucket that are compared pair by pair
ROWS = 200_000  # variants taken together in a task

_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view(np.uint64).ravel()  # a byte's bits in eight bytes


def shingles(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words joined by single blanks, and row, start and end of each shingle in them. Fewer words are one shingle."""
    starts, ends, before = word_spans(data, offsets)
    sizes = ends - starts
    behind = np.cumsum(sizes + 1)  # place after the word and its blank
    joined = np.full(int(behind[-1]) if len(behind) else 0, 0x20, np.uint8)
    inside = np.ones(len(joined), bool)
    inside[behind - 1] = False
    word = np.zeros(len(data) + 1, np.int8)
    word[starts], last = 1, ends
    np.add.at(word, last, -1)
    joined[inside] = data[np.cumsum(word[:-1]) > 0] if len(starts) else data[:0]
    counts = np.diff(before)
    row = np.repeat(np.arange(len(counts)), counts)
    nth = np.arange(len(starts)) - before[row]
    first = (nth + words <= counts[row]) | (nth == 0)
    at = np.flatnonzero(first)
    final = at + np.minimum(counts[row[at]], words) - 1
    return joined, row[at], behind[at] - sizes[at] - 1, behind[final] - 1


def fingerprints(column: pa.Array) -> np.ndarray:
    """64 bits of each text: set where over half of its shingles' hashes have the bit. Zero without words."""
    data, offsets = text_bytes(column)
    joined, row, starts, ends = shingles(lowered(data), offsets)
    ones = np.zeros((len(column), 64), np.int64)
    for k in range(0, len(row), SPANS):
        rows, hashes = row[k : k + SPANS], xxh64(joined, starts[k : k + SPANS], ends[k : k + SPANS], SEED)
        # Runs of one row and at most 255 hashes, whose bits are counted in bytes.
        begins = np.flatnonzero(np.diff(rows, prepend=-1))
        nth = np.arange(len(rows)) - np.repeat(begins, np.diff(np.append(begins, len(rows))))
        runs = np.flatnonzero(nth % 255 == 0)
        octets = hashes.view(np.uint8).reshape(-1, 8)
        sums = [np.add.reduceat(_SPREAD[octets[:, j]], runs).view(np.uint8).reshape(-1, 8) for j in range(8)]
        np.add.at(ones, rows[runs], np.concatenate(sums, axis=1).astype(np.int64))
    total = np.bincount(row, minlength=len(column))
    return np.packbits(2 * ones > total[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def printed(docs: DataFrame) -> DataFrame:
    """doc_id, print (the fingerprint's 64 bits), a row for each row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in gathered(batches, "text", CHUNK):
            found = fingerprints(one(table.column("text")))
            yield pa.RecordBatch.from_arrays([one(table.column("doc_id")), pa.array(found.view(np.int64))], ["doc_id", "print"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole()).mapInArrow(run, "doc_id long, print long")


def _settle(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the trees of linked nodes: every root that meets a smaller one is put below it, until none does."""
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root != root[root]).any():
            root[:] = root[root]


def _near(a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= most


def forest(prints: np.ndarray, starts: np.ndarray, ends: np.ndarray, most: int = NEAR) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprint and root: a spanning forest of the links within the groups [start, end) of prints."""
    nodes, number = np.unique(prints, return_inverse=True)
    root = np.arange(len(nodes))
    sizes = ends - starts
    small = np.flatnonzero((sizes > 1) & (sizes <= 32))
    for m in np.unique(sizes[small]).tolist():
        grid = starts[small[sizes[small] == m]][:, None] + np.arange(m)
        for j, k in combinations(range(m), 2):
            near = _near(prints[grid[:, j]], prints[grid[:, k]], most)
            _settle(root, number[grid[near, j]], number[grid[near, k]])
    for g in np.flatnonzero(sizes > 32).tolist():
        part, ids = prints[starts[g] : ends[g]], number[starts[g] : ends[g]]
        if len(part) <= PAIRWISE:
            for k in range(0, len(part), 256):
                i, j = np.nonzero(_near(part[k : k + 256, None], part[None, :], most))
                _settle(root, ids[i + k], ids[j])
        else:
            _probed(part, ids, root, most)
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[moved], nodes[root[moved]]


def _probed(part: np.ndarray, ids: np.ndarray, root: np.ndarray, most: int) -> None:
    """Links of a large bucket: look up every member with every mask of the bits in which members differ at all."""
    free = np.bitwise_or.reduce(part ^ part[0])
    bits = [np.uint64(1 << k) for k in range(64) if int(free) >> k & 1]
    order = np.argsort(part)
    part, ids = part[order], ids[order]
    for n in range(1, most + 1):
        for some in combinations(bits, n):
            other = part ^ np.bitwise_or.reduce(np.array(some))
            place = np.minimum(np.searchsorted(part, other), len(part) - 1)
            hit = part[place] == other
            _settle(root, ids[hit], ids[place[hit]])


def _wiped(value: Column, bits: int, place: Column) -> Column:
    """The lowest bits of value without the one at that place, and the place: equal for values that differ there only."""
    low = value.bitwiseAND(F.lit((1 << bits) - 1))
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), place.cast("int"))
    return low.bitwiseAND(F.bitwise_not(mask)).bitwiseOR(F.call_function("shiftleft", place.cast("long"), F.lit(bits)))


def variants(nodes: DataFrame) -> DataFrame:
    """key, print: every fingerprint under its two halves, each with one of 32 bits wiped."""
    each = nodes.select("print", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("v"))
    half = F.when(F.col("v") < 32, F.col("print")).otherwise(F.shiftrightunsigned("print", 32))
    side = F.when(F.col("v") < 32, F.lit(0)).otherwise(F.lit(1 << 40)).cast("long")
    return each.select(_wiped(half, 32, F.col("v") % 32).bitwiseOR(side).alias("key"), "print")


def finer(rows: DataFrame) -> DataFrame:
    """key, sub, print: the members of a bucket under the two quarters of their other half, one of 16 bits wiped."""
    each = rows.select("key", "print", F.explode(F.sequence(F.lit(0), F.lit(31))).alias("v"))
    other = F.when(F.col("key") < (1 << 40), F.shiftrightunsigned("print", 32)).otherwise(F.col("print"))
    quarter = F.when(F.col("v") < 16, other).otherwise(F.shiftrightunsigned(other, 16))
    side = F.when(F.col("v") < 16, F.lit(0)).otherwise(F.lit(1 << 30)).cast("long")
    return each.select("key", _wiped(quarter, 16, F.col("v") % 16).bitwiseOR(side).alias("sub"), "print")


def links(rows: DataFrame, keys: list[str], most: int = NEAR, whole_groups: bool = False) -> DataFrame:
    """a, b, key: links within the groups of rows, as spanning forests, with key null. Members of groups above
    PAIRWISE come back as a = b with their key, unless whole groups are asked for."""

    def settled(table: pa.Table) -> Iterator[pa.RecordBatch]:
        values = [one(table.column(k)).to_numpy(zero_copy_only=False) for k in keys]
        prints = one(table.column("print")).to_numpy(zero_copy_only=False).view(np.uint64)
        cut = np.any([np.diff(v) != 0 for v in values], axis=0)
        starts = np.concatenate([[0], np.flatnonzero(cut) + 1])
        ends = np.append(starts[1:], len(prints))
        large = np.zeros(len(starts), bool) if whole_groups else ends - starts > PAIRWISE
        usual = (ends - starts > 1) & ~large
        inside = np.repeat(usual, ends - starts)
        sizes = (ends - starts)[usual]
        at = np.cumsum(sizes) - sizes
        a, b = forest(prints[inside], at, at + sizes, most)
        yield _links(a, b, None)
        if large.any():
            held = np.repeat(large, ends - starts)
            yield _links(prints[held], prints[held], values[0][held])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail: pa.Table | None = None
        spilled = None  # the large group that goes on
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([tail, table]).combine_chunks() if tail is not None else table
            if table.num_rows < ROWS:
                tail = table
                continue
            values = [one(table.column(k)).to_numpy(zero_copy_only=False) for k in keys]
            if spilled is not None:
                same = int(np.argmin(np.append(values[0] == spilled, False)))
                if same:
                    prints = one(table.column("print")).to_numpy(zero_copy_only=False)[:same]
                    yield _links(prints, prints, values[0][:same])
                table, values = table.slice(same), [v[same:] for v in values]
                if not table.num_rows:
                    tail = None
                    continue
                spilled = None
            changed = np.flatnonzero(np.any([np.diff(v) != 0 for v in values], axis=0))
            last = int(changed[-1]) + 1 if len(changed) else 0
            if last:
                yield from settled(table.slice(0, last))
            tail = table.slice(last)
            if tail.num_rows > PAIRWISE and not whole_groups:
                yield from settled(tail)
                spilled, tail = values[0][-1], None
        if tail is not None and spilled is not None:
            values = one(tail.column(keys[0])).to_numpy(zero_copy_only=False)
            same = int(np.argmin(np.append(values == spilled, False)))
            prints = one(tail.column("print")).to_numpy(zero_copy_only=False)[:same]
            if same:
                yield _links(prints, prints, values[:same])
            tail = tail.slice(same)
        if tail is not None and tail.num_rows:
            yield from settled(tail)

    n = partitions(rows.sparkSession)
    return rows.repartition(n, *keys).sortWithinPartitions(*keys, "print").mapInArrow(run, "a long, b long, key long")


def _links(a: np.ndarray, b: np.ndarray, key: np.ndarray | None) -> pa.RecordBatch:
    columns = [pa.array(np.ascontiguousarray(x).view(np.int64)) for x in (a, b)]
    return pa.RecordBatch.from_arrays([*columns, pa.nulls(len(a), pa.int64()) if key is None else pa.array(key)], ["a", "b", "key"])


def linked(nodes: DataFrame, most: int = NEAR) -> DataFrame:
    """a, b: links between different fingerprints (column print) whose forest connects all that differ in 3 bits or fewer."""
    found = stored(links(variants(nodes), ["key"], most))
    usual = found.where("key is null").select("a", "b")
    large = found.where("key is not null").select("key", F.col("a").alias("print"))
    if large.isEmpty():
        return usual
    return usual.unionAll(stored(links(finer(large), ["key", "sub"], most, whole_groups=True)).select("a", "b"))


def near(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint, component_id, print: one row for each row of docs.

    Equal fingerprints are one node however many rows have it, so links between copies need no comparison. Null
    and empty texts and those without words have fingerprint zero and are linked like others. component_id is the
    least doc_id that is reachable; null doc_ids are passed over unless a component has no other. Very long texts
    are hashed in pieces. An empty table gives no rows.
    """
    rows = stored(printed(docs))
    nodes = stored(rows.groupBy("print").agg(F.min("doc_id").alias("least")))
    found = components(linked(nodes.select("print"))).select(F.col("node").alias("print"), "root")
    member = stored(nodes.join(found, "print", "left").withColumn("root", F.coalesce("root", "print")))
    least = stored(member.groupBy("root").agg(F.min("least").alias("component_id")))
    # Stored, so that the join deals both sides anew and can split the rows of a very common fingerprint.
    member = stored(member.select("print", "root").join(least, "root").select("print", "component_id"))
    joined = rows.join(member, "print")
    return joined.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id", "print")
