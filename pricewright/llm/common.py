"""What the text operators share: stored intermediates, Arrow text buffers, span hashes.

Every operator reads the columns it names and nothing else, so extra columns never clash.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewright.operators.ranked import shared_folder

_FOLDERS: list[str] = []


def folder(spark: SparkSession) -> str:
    """A new folder under the shared one that the session names; nothing else uses it."""
    _FOLDERS.append(path := f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}")
    return path


def stored(df: DataFrame) -> DataFrame:
    """Write the rows once to shared storage and go on from the files; survives lost executors."""
    path = folder(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete what ``stored`` wrote in this process. Call it when results have been consumed."""
    while _FOLDERS:
        path = spark._jvm.org.apache.hadoop.fs.Path(_FOLDERS.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def whole(text: str = "text"):
    """The text column; null counts as empty."""
    return F.coalesce(F.col(text), F.lit("")).alias(text)


def mark(text: str = "text"):
    """Tells texts with the same doc_id apart."""
    return F.xxhash64(whole(text)).alias("mark")


def fresh(docs: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores as it takes not to clash with a column."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name in taken:
            name += "_"
        taken.add(name)
        out.append(name)
    return out


def only(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, whose doc_id and mark are in kept; of repeated rows one."""
    names = fresh(docs, "none", "id", "mark")

    def keys(df: DataFrame, text_mark) -> list:
        number = F.col("doc_id").cast("long")
        values = (number.isNull(), F.coalesce(number, F.lit(0)), text_mark)
        return [v.alias(n) for v, n in zip(values, names, strict=True)]

    rows = docs.select("*", *keys(docs, mark()))
    # The join has dealt the rows by these keys, so dropping repeated rows moves nothing.
    return rows.join(kept.select(*keys(kept, F.col("mark"))), names, "left_semi").dropDuplicates(names).drop(*names)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows and the row offsets into them."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if offsets else np.zeros(1, np.int64)
    first, last = int(offsets[0]), int(offsets[-1])
    flat = np.frombuffer(data, np.uint8, last - first, first) if data and last > first else np.zeros(0, np.uint8)
    return flat, offsets - first


def pieces(batches: Iterator[pa.RecordBatch], text: str, most: int) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of at most ``most`` bytes of text, or of one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        if sizes.sum() <= most:
            yield batch
            continue
        start, total = 0, 0
        for i, n in enumerate(sizes.tolist()):
            if i > start and total + n > most:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        yield batch.slice(start)


def gathered(batches: Iterator[pa.RecordBatch], text: str, most: int) -> Iterator[pa.Table]:
    """Successive rows together, up to about ``most`` bytes of text."""
    held, total = [], 0
    for batch in pieces(batches, text, most):
        n = int(pc.sum(pc.binary_length(batch.column(text))).as_py() or 0)
        if held and total + n > most:
            yield pa.Table.from_batches(held).combine_chunks()
            held, total = [], 0
        held.append(batch)
        total += n
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def one(column: pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of all spans, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


# The multipliers of XXH64.
_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))
_LONG = 1024  # bytes; longer spans are hashed one by one


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _lanes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The eight and the four bytes from every place on, as numbers; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray(len(data) + 1, "<u8", padded, strides=(1,)), np.ndarray(len(data) + 1, "<u4", padded, strides=(1,))


def _turn(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def _round(lane: np.ndarray) -> np.ndarray:
    return _turn(lane * _P2, 31) * _P1


def xxh64(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """XXH64 of the byte spans [start, end) of data, unsigned; all spans advance together, lane by lane."""
    words, halves = _lanes(data)
    sizes = ends - starts
    with np.errstate(over="ignore"):
        s = np.uint64(seed)
        out = np.full(len(starts), s + _P5, np.uint64)
        at = starts.copy()
        usual = sizes <= _LONG
        striped = np.flatnonzero((sizes >= 32) & usual)
        if len(striped):
            lanes = [np.full(len(striped), v, np.uint64) for v in (s + _P1 + _P2, s + _P2, s, s - _P1)]
            live, n = np.arange(len(striped)), sizes[striped] // 32
            for k in range(int(n.max())):
                live = live[n[live] > k]
                place = starts[striped[live]] + 32 * k
                for j, v in enumerate(lanes):
                    v[live] = _turn(v[live] + words[place + 8 * j] * _P2, 31) * _P1
            h = _turn(lanes[0], 1) + _turn(lanes[1], 7) + _turn(lanes[2], 12) + _turn(lanes[3], 18)
            for v in lanes:
                h = (h ^ _round(v)) * _P1 + _P4
            out[striped] = h
            at[striped] += 32 * n
        out += sizes.astype(np.uint64)
        left = np.where(usual, ends - at, 0)
        live = np.flatnonzero(left >= 8)
        while len(live):
            out[live] = _turn(out[live] ^ _round(words[at[live]]), 27) * _P1 + _P4
            at[live] += 8
            live = live[ends[live] - at[live] >= 8]
        live = np.flatnonzero(usual & (ends - at >= 4))
        out[live] = _turn(out[live] ^ halves[at[live]].astype(np.uint64) * _P1, 23) * _P2 + _P3
        at[live] += 4
        live = np.flatnonzero(usual & (ends > at))
        while len(live):
            out[live] = _turn(out[live] ^ data[at[live]].astype(np.uint64) * _P5, 11) * _P1
            at[live] += 1
            live = live[ends[live] > at[live]]
        out = (out ^ (out >> np.uint64(33))) * _P2
        out = (out ^ (out >> np.uint64(29))) * _P3
        out ^= out >> np.uint64(32)
    for k in np.flatnonzero(~usual).tolist():
        out[k] = xxhash.xxh64_intdigest(data[starts[k] : ends[k]].tobytes(), seed)
    return out


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 20240607) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end) of data."""
    return xxh64(data, starts, ends, seed)


def equal_spans(data: np.ndarray, a: np.ndarray, b: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether the spans of these sizes at a and at b have the same bytes."""
    eight, _ = _lanes(data)
    short = np.minimum(sizes, 8)
    with np.errstate(over="ignore"):
        differ = (eight[a] ^ eight[b]) << (np.uint64(8) * (8 - np.maximum(short, 1)).astype(np.uint64))
    same = (differ == 0) | (sizes == 0)
    more = np.flatnonzero(same & (sizes > 8))
    back = np.minimum(sizes[more], 16) - 8
    same[more] = eight[a[more] + back] == eight[b[more] + back]
    more = np.flatnonzero(same & (sizes > 16))
    for k in range(0, len(more), 100_000):
        part = more[k : k + 100_000]
        equal = data[ragged(a[part] + 16, sizes[part] - 16)] == data[ragged(b[part] + 16, sizes[part] - 16)]
        behind = np.cumsum(sizes[part] - 16)
        same[part] = np.logical_and.reduceat(equal, behind - (sizes[part] - 16))
    return same


def exact(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The hashes, changed where needed so that spans have equal ones only if their bytes are equal.

    order sorts the hashes. If nothing needed a change, which is all but certain, the same array is returned.
    """
    a, b = order[:-1], order[1:]
    at = np.flatnonzero(hashes[a] == hashes[b])
    a, b = a[at], b[at]
    size = (ends - starts)[a]
    same = size == (ends - starts)[b]
    same[same] = equal_spans(data, starts[a[same]], starts[b[same]], size[same])
    if same.all():
        return hashes
    hashes, taken = hashes.copy(), set(hashes.tolist())
    for h in np.unique(hashes[a[~same]]).tolist():
        names: dict[bytes, int] = {}
        for k in np.flatnonzero(hashes == np.uint64(h)).tolist():
            raw = data[starts[k] : ends[k]].tobytes()
            if raw not in names:
                names[raw] = h if not names else next(x % (1 << 64) for x in range(h + 1, h + len(taken) + 2) if x % (1 << 64) not in taken)
                taken.add(names[raw])
            hashes[k] = names[raw]
    return hashes


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word ``[^\\x20\\x09-\\x0D]+``, and words before each row (len rows + 1)."""
    word = ~_SPACE[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    last = word.copy()
    last[:-1] &= ~word[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] |= word[cuts]
    last[cuts - 1] |= word[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case; all other bytes as they are."""
    return _LOWER[data]
