"""Exact dedup by an exchange of Golomb-coded fingerprints.

Parts of the table send their distinct fingerprints, sorted and Golomb-coded, to the owners of the value
ranges. An owner merges the lists and returns one bit for each fingerprint: whether another part, or another
row of the same part, has it too. Rows whose bit is set are suspects; only their texts are exchanged, to be compared
byte by byte, and all other rows are answered by their part. A part sends a fingerprint once however many rows
have it, and copies are combined before the exchange, so a group of any size stays small.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewright.llm.common import lowered, mark, only, partitions, pieces, stored, text_bytes, whole
from pricewright.operators.probe import flagged

BITS = 48  # of a fingerprint; more only make fewer false suspects
ROWS = 2_000_000  # in a part, and fingerprints with an owner, at most on average
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def golomb(values: np.ndarray) -> bytes:
    """Sorted non-negative integers as gaps: quotients by 2^k in unary, then remainders in k bits."""
    gaps = np.diff(values, prepend=0)
    k = max(0, int(np.mean(gaps) * 0.69 + 1).bit_length() - 1) if len(gaps) else 0
    high, low = gaps >> k, gaps & ((1 << k) - 1)
    unary = np.zeros(int(high.sum()) + len(gaps), np.uint8)
    unary[np.cumsum(high + 1) - 1] = 1
    rest = ((low[:, None] >> np.arange(k)) & 1).astype(np.uint8).ravel()
    packed = np.packbits(unary)
    return np.array([len(values), k, len(packed)], "<u4").tobytes() + packed.tobytes() + np.packbits(rest).tobytes()


def ungolomb(blob: bytes) -> np.ndarray:
    n, k, size = np.frombuffer(blob, "<u4", 3).tolist()
    ones = np.flatnonzero(np.unpackbits(np.frombuffer(blob, np.uint8, size, 12)))[:n]
    high = np.diff(ones, prepend=-1) - 1
    rest = np.unpackbits(np.frombuffer(blob, np.uint8, -1, 12 + size))[: n * k].reshape(n, k).astype(np.int64) if k else np.zeros((n, 0), np.int64)
    return np.cumsum((high << k) + (rest << np.arange(k)).sum(axis=1))


def prints(column: pa.Array, bits: int) -> np.ndarray:
    """The first bits of each row's sha-256."""
    raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 32)[:, :8]
    return (np.ascontiguousarray(raw).view(">u8").ravel().astype(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)


def hashed_rows(docs: DataFrame) -> DataFrame:
    """doc_id, mark, sha (of the normalised text), task, nth: which row of which task it was."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), 0
        for batch in pieces(batches, "text", 8_000_000):
            data, offsets = text_bytes(batch.column("text"))
            flat, at = lowered(data).tobytes(), offsets.tolist()
            view = memoryview(flat)
            sha = pa.array([hashlib.sha256(view[a:b]).digest() for a, b in zip(at, at[1:], strict=False)], pa.binary())
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("mark"), sha, pa.array(np.full(n, task, np.int64)), pa.array(np.arange(seen, seen + n))], ["doc_id", "mark", "sha", "task", "nth"])
            seen += n

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), mark(), whole())
    return rows.mapInArrow(run, "doc_id long, mark long, sha binary, task long, nth long")


def suspects(rows: DataFrame, bits: int = BITS, fingerprints: int = ROWS) -> DataFrame:
    """The rows with their part's answer: whether another row has their fingerprint too."""
    owners = max(partitions(rows.sparkSession), -(-rows.count() // fingerprints))

    def owned(values: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """owner, from, to: the owners of successive value ranges."""
        owner = values * owners >> bits if bits + owners.bit_length() < 63 else (values >> 16) * owners >> (bits - 16)
        edges = np.concatenate([[0], np.flatnonzero(np.diff(owner)) + 1, [len(owner)]]).tolist() if len(owner) else []
        for a, b in zip(edges, edges[1:], strict=False):
            yield int(owner[a]), a, b

    def send(table: pa.Table) -> pa.Table:
        values, counts = np.unique(prints(table.column("sha").combine_chunks(), bits), return_counts=True)
        out = [(o, golomb(values[a:b]), np.packbits(counts[a:b] > 1).tobytes()) for o, a, b in owned(values)]
        part = table.column("part")[0].as_py()
        return pa.table({"part": pa.array([part] * len(out), pa.int64()), "owner": pa.array([x[0] for x in out], pa.int64()), "codes": pa.array([x[1] for x in out], pa.binary()), "many": pa.array([x[2] for x in out], pa.binary())})

    def answer(table: pa.Table) -> pa.Table:
        lists = [ungolomb(x) for x in table.column("codes").to_pylist()]
        many = [np.unpackbits(np.frombuffer(x, np.uint8))[: len(v)] for x, v in zip(table.column("many").to_pylist(), lists, strict=True)]
        values, at, counts = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
        double = (counts > 1) | (np.bincount(at, np.concatenate(many), len(values)) > 0)
        edges = np.cumsum([len(v) for v in lists])[:-1]
        maps = [np.packbits(x).tobytes() for x in np.split(double[at], edges)]
        return pa.table({"part": table.column("part"), "owner": table.column("owner"), "bitmap": pa.array(maps, pa.binary())})

    def receive(table: pa.Table, maps: pa.Table) -> pa.Table:
        if not table.num_rows:
            return table.append_column("suspect", pa.array([], pa.bool_())).select(columns)
        found = prints(table.column("sha").combine_chunks(), bits)
        values, at = np.unique(found, return_inverse=True)
        bitmap = dict(zip(maps.column("owner").to_pylist(), maps.column("bitmap").to_pylist(), strict=True))
        bit = np.concatenate([np.unpackbits(np.frombuffer(bitmap[o], np.uint8))[: b - a] for o, a, b in owned(values)])
        return table.append_column("suspect", pa.array(bit[at] > 0)).select(columns)

    columns = ["doc_id", "mark", "sha", "task", "nth", "suspect"]
    sent = rows.select("part", "sha").groupBy("part").applyInArrow(send, "part long, owner long, codes binary, many binary")
    maps = sent.groupBy("owner").applyInArrow(answer, "part long, owner long, bitmap binary")
    held = rows.select("part", *columns[:-1]).groupBy("part").cogroup(maps.groupBy("part"))
    return held.applyInArrow(receive, "doc_id long, mark long, sha binary, task long, nth long, suspect boolean")


def groups(docs: DataFrame, bits: int = BITS, rows_per_part: int = ROWS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, mark: one row for each row of docs.

    Texts are equal when identical after lower-casing A-Z; null counts as empty, so null and empty texts are
    one group. The largest doc_id stays (a null one is below all); of repeated rows with that doc_id exactly
    one is kept. An empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = stored(hashed_rows(docs))
    parts = max(partitions(spark), -(-rows.count() // rows_per_part))
    marked = stored(suspects(rows.withColumn("part", F.col("task") % parts), bits, rows_per_part))
    alone = marked.where("not suspect").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"), "mark"
    )
    rows = marked.where("suspect").withColumn("place", F.struct("task", "nth"))
    likely = stored(rows.select("doc_id", "mark").distinct())
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), mark(), F.translate(whole(), UPPER, LOWER).alias("norm"))
    # Texts that are no suspects' drop out where they are read, but for what a filter of bounded size lets through.
    texts = flagged(texts, likely, ["doc_id", "mark"], "may").where("may")
    own = likely.select(F.col("doc_id").alias("id"), F.col("mark").alias("own"))
    # Equal bytes, not equal hashes, make a group. Copies are combined before they are exchanged.
    same = texts.join(own, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("mark") == F.col("own")), "left_semi").groupBy("norm")
    verified = same.agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    verified = verified.select(F.unhex(F.sha2("norm", 256)).alias("sha"), "keep_id", "group_size")
    stays = rows.groupBy("sha").agg(F.max(F.struct("doc_id", "place")).alias("stays"))
    # Stored, so that the join deals both sides anew and can split the rows of a very large group.
    joined = rows.join(stored(stays.join(verified, "sha", "left")), "sha")
    size = F.coalesce("group_size", F.lit(1))
    found = joined.select(
        "doc_id",
        F.when(size > 1, F.col("keep_id")).otherwise(F.col("doc_id")).alias("keep_id"),
        size.cast("long").alias("group_size"),
        (F.col("place") == F.col("stays.place")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        "mark",
    )
    return alone.unionAll(found)


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, with their columns."""
    return only(docs, groups(docs).where("kept"))
