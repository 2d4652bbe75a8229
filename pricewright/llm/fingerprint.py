"""Document fingerprints from prefix polynomial hashes.

The prefix array of a text holds the hash of every prefix modulo 2^31 - 1, for two bases. Any span's hash is
the difference of two entries, moved to position zero, so spans compare in constant time wherever they lie, and
the longest common extension of two texts is found by binary search. The fingerprint is the hash of the
whole text plus a sketch: the spans of SPAN code points, dealt to BINS bins by hash, with one byte of the
least hash in each bin. The share of equal bins estimates the share of spans that two texts have in common.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewright.llm.common import gathered, mix, one, partitions, whole

P = np.uint64((1 << 31) - 1)
BASES = (np.uint64(1_000_003_919), np.uint64(911_382_323))
SPAN = 16  # code points
BINS = 128
CHUNK = 2_000_000  # bytes of text hashed at a time, or one document
_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def times(a, b):
    """Product modulo 2^31 - 1."""
    x = a * b
    x = (x & P) + (x >> np.uint64(31))
    x = (x & P) + (x >> np.uint64(31))
    return np.where(x == P, np.uint64(0), x)


def _powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of a base and of its inverse."""
    if which not in _TABLES or len(_TABLES[which][0]) < n:
        size, both = 1 << max(16, int(n).bit_length()), []
        for base in (int(BASES[which]), pow(int(BASES[which]), -1, int(P))):
            out, done, step = np.ones(size, np.uint64), 1, np.uint64(base)
            while done < size:
                out[done : 2 * done] = times(out[:done], step)
                step, done = times(step, step), 2 * done
            both.append(out)
        _TABLES[which] = tuple(both)
    up, down = _TABLES[which]
    return up[:n], down[:n]


class Prefixes:
    """Prefix arrays of several texts, which lie one after the other."""

    def __init__(self, texts: list[str]):
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
        self.total = len(points)
        self.arrays, self.down = [], []
        for which in range(len(BASES)):
            up, down = _powers(which, self.total + 1)
            sums = np.zeros(self.total + 1, np.uint64)
            np.cumsum(times(points, up[: self.total]), out=sums[1:])
            self.arrays.append(sums % P)
            self.down.append(down)

    def span(self, which: int, start, size):
        """Hash of the span of that size at that place, equal for equal spans anywhere."""
        array = self.arrays[which]
        return times((array[start + size] + P - array[start]) % P, self.down[which][start])

    def spans(self, start, size) -> np.ndarray:
        """62 bits."""
        return self.span(0, start, size) << np.uint64(31) | self.span(1, start, size)

    def sketches(self) -> np.ndarray:
        """A row of BINS bytes for each text; 0: no span fell into the bin."""
        n = len(self.sizes)
        least = np.full((n + 1) * BINS, np.iinfo(np.uint64).max, np.uint64)
        short = np.flatnonzero((self.sizes < SPAN) & (self.sizes > 0))
        if self.total >= SPAN:
            last = self.total - SPAN + 1
            at = np.arange(last)
            row = np.repeat(np.arange(n), self.sizes)[:last]
            row = np.where(at + SPAN <= (self.starts + self.sizes)[row], row, n)
            self._least(least, row, self.span(0, at, SPAN))
        self._least(least, short, self.span(0, self.starts[short], self.sizes[short]))
        kept = least.reshape(n + 1, BINS)[:n]
        with np.errstate(over="ignore"):
            signs = (mix(kept) % np.uint64(255)).astype(np.uint8) + np.uint8(1)
        return np.where(kept == np.iinfo(np.uint64).max, np.uint8(0), signs)

    @staticmethod
    def _least(least: np.ndarray, row: np.ndarray, hashes: np.ndarray) -> None:
        with np.errstate(over="ignore"):
            mixed = mix(hashes + np.uint64(1))
        np.minimum.at(least, row * BINS + (mixed & np.uint64(BINS - 1)).astype(np.int64), mixed >> np.uint64(8))


def common_prefix(a: Prefixes, rows_a: np.ndarray, b: Prefixes, rows_b: np.ndarray) -> np.ndarray:
    """Code points that the texts have in common from their start, by binary search for all pairs at once."""
    low, high = np.zeros(len(rows_a), np.int64), np.minimum(a.sizes[rows_a], b.sizes[rows_b])
    while (low < high).any():
        middle = (low + high + 1) // 2
        same = a.spans(a.starts[rows_a], middle) == b.spans(b.starts[rows_b], middle)
        low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
    return low


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal bins among those that either has, less what chance makes equal; two empty ones are equal."""
    used = ((a > 0) | (b > 0)).sum(axis=1)
    equal = ((a == b) & (a > 0)).sum(axis=1)
    share = (equal / np.maximum(used, 1) - 1 / 255) / (1 - 1 / 255)
    return np.where(used == 0, 1.0, np.clip(share, 0.0, 1.0))


def written(whole_hash: np.ndarray, sketch: np.ndarray) -> list[str]:
    return [f"{h:016x}{s.tobytes().hex()}" for h, s in zip(whole_hash.tolist(), sketch, strict=True)]


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next and the code points in
    common with the edited and the next text (edited_from, common_next), one row for each row of docs.

    Null text counts as empty. Rows are ordered by doc_id, then text; null doc_ids come first. After the last
    row comes the first, which for a single row is itself. Texts move once, in ranges of doc_id; each range also
    gets the first rows of the next one, so no text meets more than its neighbour. An empty table gives no rows.
    """
    spark = docs.sparkSession
    n = partitions(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole())
    shares = [k / n for k in range(1, n)] or [0.5]
    cuts = rows.agg(F.percentile_approx("doc_id", F.array(*map(F.lit, shares)), 100 * n)).first()[0] or []
    cuts = np.unique(np.array(cuts, np.int64))

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, ids.fillna(np.iinfo(np.int64).min).astype(np.int64), side="right"))

    # One row for each range: its first doc_id. Null, if any, lies in the first range.
    firsts = rows.select("doc_id", range_of("doc_id").alias("r")).groupBy("r").agg(F.min("doc_id").alias("low"), F.max(F.col("doc_id").isNull()).alias("null")).orderBy("r").collect()
    before = {(None if r["null"] else r["low"]): firsts[k - 1]["r"] for k, r in enumerate(firsts)}

    @F.pandas_udf("array<int>")
    def places(ids: pd.Series) -> pd.Series:
        own = np.searchsorted(cuts, ids.fillna(np.iinfo(np.int64).min).astype(np.int64), side="right")
        known = [None if pd.isna(i) else int(i) for i in ids]
        return pd.Series([[int(r), -1 - before[i]] if i in before else [int(r)] for r, i in zip(own, known, strict=True)])

    dealt = rows.withColumn("place", F.explode(places("doc_id")))
    dealt = dealt.select("doc_id", "text", F.when(F.col("place") < 0, -1 - F.col("place")).otherwise(F.col("place")).alias("r"), (F.col("place") < 0).alias("tail"))
    ordered = dealt.repartitionById(max(n, len(cuts) + 1), F.col("r")).sortWithinPartitions("r", "tail", "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        for table in gathered(batches, "text", CHUNK):
            rows = list(zip(*[one(table.column(c)).to_pylist() for c in ("doc_id", "text", "r", "tail")], strict=True))
            rows = ([held] if held else []) + rows
            held = rows[-1]
            # A row's next one is in the same range; behind the first of the tail only others of it may come.
            own = [k for k, (a, b) in enumerate(zip(rows, rows[1:], strict=False)) if not a[3] and a[2] == b[2]]
            if own:
                yield described(rows, own)

    kind = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, edited_from long, common_next long"
    return ordered.mapInArrow(run, kind)


def described(rows: list[tuple], own: list[int]) -> pa.RecordBatch:
    texts = [r[1] for r in rows]
    edited = [texts[k][: len(texts[k]) - len(texts[k]) // 2] + texts[k + 1][: len(texts[k]) // 2] for k in own]
    a, b, at, here = Prefixes(texts), Prefixes(edited), np.array(own), np.arange(len(own))
    sketch, edits = a.sketches(), b.sketches()
    whole_a, whole_b = a.spans(a.starts, a.sizes), b.spans(b.starts, b.sizes)
    near_edited = np.where(whole_a[at] == whole_b, 1.0, likeness(sketch[at], edits))
    near_next = np.where(whole_a[at] == whole_a[at + 1], 1.0, likeness(sketch[at], sketch[at + 1]))
    columns = {
        "doc_id": pa.array([rows[k][0] for k in own], pa.int64()),
        "n_chars": pa.array(a.sizes[at]),
        "edited_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
        "fingerprint": pa.array(written(whole_a[at], sketch[at]), pa.string()),
        "edited_fingerprint": pa.array(written(whole_b, edits), pa.string()),
        "near_edited": pa.array(near_edited),
        "near_next": pa.array(near_next),
        "edited_from": pa.array(common_prefix(a, at, b, here)),
        "common_next": pa.array(common_prefix(a, at, a, at + 1)),
    }
    return pa.RecordBatch.from_pydict(columns)
