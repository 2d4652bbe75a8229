"""Best-fit decreasing packing of documents into sequences, at any number of documents.

Best-fit decreasing looks only at lengths, and open bins with equal room are alike. So the plan is made for
lengths with counts, not for documents: for each length, from the longest, a segment tree over the room
0..capacity finds the tightest open bins in logarithmic time, and all of them take a document of that length
at once. The plan maps ranges of (length, rank among the documents of that length) to ranges of bins; its
size is bounded by the capacity, whatever the input. Documents get their rank by counts per task, so no
group of equal lengths meets in one task.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricewright.llm import bpe
from pricewright.llm.common import gathered, one, stored, whole

CAPACITY = 1024
END = 2  # the id that ends every document


class Rooms:
    """Segment tree over room: how many open bins have each, and the tightest of at least some room."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.tree = [0] * (2 * self.size)

    def add(self, room: int, n: int) -> None:
        at = room + self.size
        while at:
            self.tree[at] += n
            at >>= 1

    def tightest(self, room: int) -> int:
        """The least room of at least this much that an open bin has, or -1."""
        at = room + self.size
        if self.tree[at]:
            return room
        while at > 1 and (at & 1 or not self.tree[at + 1]):
            at >>= 1
        if at <= 1:
            return -1
        at += 1
        while at < self.size:
            at *= 2
            at += not self.tree[at]
        return at - self.size


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, how many, first bin, offset): that many documents go to that many bins in turn."""
    rooms, runs, out, bins = Rooms(capacity), [deque() for _ in range(capacity + 1)], [], 0
    for length in sorted((n for n in counts if n > 0), reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = rooms.tightest(length)
            if room < 0:  # enough new bins that each takes as many as fit
                need = -(-left // (capacity // length))
                runs[capacity].append([bins, need])
                rooms.add(capacity, need)
                bins += need
                continue
            run = runs[room][0]
            n = min(left, run[1])
            out.append((length, rank, n, run[0], capacity - room))
            rooms.add(room, -n)
            if n == run[1]:
                runs[room].popleft()
            else:
                run[0], run[1] = run[0] + n, run[1] - n
            if room > length:
                runs[room - length].append([out[-1][3], n])
                rooms.add(room - length, n)
            rank, left = rank + n, left - n
    return out


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row per piece of every document.

    A null or empty text is the ending id alone. A document of n > capacity ids has ceil(n / capacity) pieces,
    all full but possibly the first. Repeated rows are packed each; an empty table gives no rows.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, seen, task = bpe.merges(path), np.zeros(capacity + 1, np.int64), TaskContext.get().partitionId()
        end = np.array([END], "<u4").tobytes()
        for table in gathered(batches, "text", bpe.BATCH):
            encoded = bpe.encode(one(table.column("text")), model)
            sizes = np.diff(encoded.offsets) + 1
            parts = -(-sizes // capacity)
            row = np.repeat(np.arange(len(sizes)), parts)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
            first = sizes - (parts - 1) * capacity
            start = np.where(piece == 0, 0, first[row] + (piece - 1) * capacity)
            length = np.where(piece == 0, first[row], capacity)
            raw, low = encoded.ids.astype("<u4").tobytes(), encoded.offsets[:-1][row] + start
            last = piece == parts[row] - 1
            sums = [zlib.crc32(end, zlib.crc32(raw[4 * a : 4 * (a + n - 1)])) if z else zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n, z in zip(low.tolist(), length.tolist(), last.tolist(), strict=True)]
            order = np.argsort(length, kind="stable")
            ordered = length[order]
            rank = np.empty(len(row), np.int64)
            rank[order] = np.arange(len(row)) - np.searchsorted(ordered, ordered) + seen[ordered]
            seen += np.bincount(length, minlength=capacity + 1)
            ids = one(table.column("doc_id")).take(pa.array(row))
            columns = [ids, pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(sums, pa.int64()), pa.array(np.full(len(row), task), pa.int32()), pa.array(rank)]
            yield from pa.Table.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"]).to_batches(20_000)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole())
    kind = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long"
    cut_up = stored(rows.mapInArrow(cut, kind))
    # Rank among all pieces of a length: those of earlier tasks, then its place in its own.
    sizes = cut_up.groupBy("length", "task").agg((F.max("nth") + 1).alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    earlier = sizes.withColumn("earlier", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity rows at most
    steps = np.array(plan(counts, capacity), np.int64).reshape(-1, 5)  # sorted by length descending, then rank
    shift = np.int64(1) << np.int64(48)
    key = (capacity - steps[:, 0]) * shift + steps[:, 1]
    sent = cut_up.sparkSession.sparkContext.broadcast((key, steps))  # bounded by the capacity

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, steps = sent.value
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            at = np.searchsorted(key, (capacity - length) * shift + rank, side="right") - 1
            where = steps[at, 3] + rank - steps[at, 1]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(where), pa.array(steps[at, 4])], [*names, "sequence_id", "offset"])

    ranked = cut_up.join(earlier, ["length", "task"]).withColumn("rank", F.col("earlier") + F.col("nth"))
    kind = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(place, kind)
