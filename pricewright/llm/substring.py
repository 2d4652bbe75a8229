"""Passages that an earlier document has too, found with FM-indexes over shards of suspect text.

A window is WINDOW consecutive words. Its key is the least hash of its GRAM-word parts, so equal windows have equal
keys, and a document has few. Tasks ask which keys occur in another document; a task asks for a key once and
settles itself what two of its documents share. Under a key that HOT documents or more have, most windows only
reach into a common passage, so there the windows themselves are asked for too. What remains are runs of suspect
windows. Each task indexes its runs and searches them: windows that an earlier document of the task has are
settled. The others go by key to a shard, which is indexed and searched likewise. The index compares the words
themselves, so what is removed never rests on hashes of windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewright.llm.common import exact, fresh, gathered, mark, mix, one, partitions, ragged, span_hashes, stored, text_bytes, whole, word_spans
from pricewright.llm.fmindex import FMIndex

WINDOW, GRAM = 50, 25
CHUNK = 4_000_000
SHARD = 1_500_000  # words in an index, or one key's
HOT = 64  # documents that make a key hot; any number gives the same result
PIECE = 256  # windows of a run that are searched in one go
PACKED, OWNED = 100_000, 500_000  # windows in a row that asks, and with an owner
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of n words in a row, put together from those of 1, 2, 4, ... words."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out, reach, part, size = np.zeros(len(words), np.uint64), 0, words, 1
    with np.errstate(over="ignore"):
        while True:
            if n & size:
                most = len(words) - reach - size + 1
                out = mix(out[:most] * _ODD + part[reach : reach + most])
                reach += size
            if reach == n:
                return out
            part = mix(part[:-size] * _ODD + part[size:])
            size *= 2


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` values in a row."""
    if len(values) < width:
        return values[:0]
    reach = 1
    while reach * 2 <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(values[:-rest], values[rest:]) if rest else values


class Words:
    """The words of several texts: their hashes, where each text's begin, and their windows' keys.

    names are the hashes, but equal only for words of the same bytes.
    """

    def __init__(self, column: pa.Array, named: bool = False):
        self.data, offsets = text_bytes(column)
        self.starts, self.ends, self.before = word_spans(self.data, offsets)
        self.hashes = span_hashes(self.data, self.starts, self.ends)
        self.names = exact(self.data, self.starts, self.ends, self.hashes, np.argsort(self.hashes)) if named else self.hashes
        self.sizes = np.diff(self.before)
        self.row = np.repeat(np.arange(len(self.sizes)), self.sizes)

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """First word and key of every window."""
        keys = _least(_grams(self.hashes, GRAM), WINDOW - GRAM + 1)
        at = np.flatnonzero(self.row[: len(keys)] == self.row[WINDOW - 1 :]) if len(keys) else np.zeros(0, np.int64)
        return at, keys[at]

    def text(self, first: int, last: int) -> bytes:
        """The words from first to before last, as they stand."""
        return self.data[self.starts[first] : self.ends[last - 1]].tobytes()


def _told(keys: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which (key, owner) pairs a task tells; for each whether it asks, and how many owners the task has for the key.

    Every pair of a key that the task has more than once is told, as it needs no answer; and of each key one pair asks.
    """
    order = np.lexsort((owners, keys))
    k, o = keys[order], owners[order]
    new = np.append(True, k[1:] != k[:-1]) if len(k) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(k)))
    other = new.copy()
    other[1:] |= o[1:] != o[:-1]
    number = np.add.reduceat(other.astype(np.int32), first) if len(first) else np.zeros(0, np.int32)
    twice = np.repeat(size > 1, size)
    at = np.concatenate([order[twice], order[first]])
    asks = np.append(np.zeros(int(twice.sum()), bool), np.ones(len(first), bool))
    return at, asks, np.concatenate([np.repeat(number, size)[twice], number])


def _answers(told: DataFrame, hot: int) -> DataFrame:
    """key, owner of everything that occurs more than once, and whether ``hot`` owners have it.

    A key has one asking row for each task.
    """
    asks = told.where("asks").groupBy("key").agg(F.sum("n").alias("n"), F.collect_list("owner").alias("of"))
    many, known = asks.where("n > 1"), told.where("not asks").select("key", "owner")
    many = stored(many.withColumn("hot", F.col("n") >= hot))
    answered = many.select("key", F.explode("of").alias("owner"), "hot")
    flagged = known.join(many.where("hot").select("key", "hot"), "key", "left")
    return answered.unionAll(flagged.select("key", "owner", F.coalesce("hot", F.lit(False)).alias("hot")))


def suspect_keys(rows: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id, keys, hot: the window keys of each document that another document has too, and the hot ones of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for table in gathered(batches, "text", CHUNK):
            words = Words(one(table.column("text")))
            at, key = words.windows()
            row = words.row[at]
            new = _changes(key, row)
            row, key = row[new], key[new]
            order = np.lexsort((key, row))
            row, key = row[order], key[order]
            new = _changes(key, row)
            keys.append(key[new])
            owners.append(one(table.column("doc_id")).to_numpy(zero_copy_only=False)[row[new]])
        keys, owners = np.concatenate(keys), np.concatenate(owners)
        at, asks, n = _told(keys, owners)
        for a in range(0, len(at), 50_000):
            k, z = at[a : a + 50_000], slice(a, a + 50_000)
            yield pa.RecordBatch.from_arrays([pa.array(keys[k].view(np.int64)), pa.array(owners[k]), pa.array(asks[z]), pa.array(n[z].astype(np.int32))], ["key", "owner", "asks", "n"])

    told = stored(rows.select("doc_id", "text").mapInArrow(run, "key long, owner long, asks boolean, n int"))
    found = _answers(told, hot)
    of_hot = F.collect_set(F.when(F.col("hot"), F.col("key"))).alias("hot")
    return found.groupBy(F.col("owner").alias("doc_id")).agg(F.collect_set("key").alias("keys"), of_hot)


def _changes(key: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Where another key or row begins; windows in a row mostly share their key."""
    return np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (row[1:] != row[:-1]))) if len(key) else np.zeros(0, np.int64)


def _among(key: np.ndarray, row: np.ndarray, lists: pa.ListArray) -> np.ndarray:
    """Whether each key is in its row's list."""
    size = np.diff(np.asarray(lists.offsets))
    flat = np.asarray(lists.flatten()).view(np.uint64)
    first = _changes(key, row)
    with np.errstate(over="ignore"):  # (row, key) as one number
        have = mix(flat + np.repeat(np.arange(len(size)), size).astype(np.uint64) * _ODD)
        found = np.isin(mix(key[first] + row[first].astype(np.uint64) * _ODD), have)
    return np.repeat(found, np.diff(np.append(first, len(key))))


def runs(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Runs of windows with a suspect key: run (unique), doc_id, mark, start, windows, text, doubt (where hot keys begin
    and end). And what a task has to say of the windows under hot keys, in few rows: for each run the places of
    windows that the task has twice (sure), and lists of its different windows with run and place (ask)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 36
        asked: list[tuple[np.ndarray, ...]] = []
        for table in gathered(batches, "text", CHUNK):
            words = Words(one(table.column("text")))
            at, key = words.windows()
            row = words.row[at]
            suspect = _among(key, row, one(table.column("keys")))
            at, row, key = at[suspect], row[suspect], key[suspect]
            if not len(at):
                continue
            hot = _among(key, row, one(table.column("hot")))
            cut = np.flatnonzero((np.diff(at) != 1) | (np.diff(row) != 0)) + 1
            first, last = at[np.append(0, cut)], at[np.append(cut - 1, len(at) - 1)]
            windows = last - first + 1
            run = number + np.arange(len(first))
            number += len(first)
            doc, tag = (one(table.column(c)).to_numpy(zero_copy_only=False)[words.row[first]] for c in ("doc_id", "mark"))
            which, place = np.repeat(np.arange(len(first)), windows)[hot], (at - np.repeat(first, windows))[hot]
            if len(which):
                asked.append((_grams(words.hashes, WINDOW)[at[hot]], run[which], place))
            of, low, many = _spans(place, which)
            ends = np.stack([low, low + many], axis=1).ravel().astype(np.int32)
            doubt = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(2 * np.bincount(of, minlength=len(first)))), pa.int32()), pa.array(ends))
            texts = [words.text(a, b + WINDOW) for a, b in zip(first.tolist(), last.tolist(), strict=True)]
            start = first - words.before[words.row[first]]
            columns = {"run": run, "doc_id": doc, "mark": tag, "start": start, "windows": windows}
            yield _row("run", {k: pa.array(v) for k, v in columns.items()} | {"text": pa.array(texts, pa.binary()).cast(pa.string()), "doubt": doubt})
        if asked:
            hashes, run, place = (np.concatenate(x) for x in zip(*asked, strict=True))
            order = np.argsort(hashes, kind="stable")
            hashes, run, place = hashes[order], run[order], place[order]
            first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
            many = np.diff(np.append(first, len(hashes)))
            twice = np.repeat(many > 1, many)
            for part in _by_run(run[twice], place[twice]):
                yield _row("sure", part)
            run = np.where(many > 1, -1, run[first])  # settled here, but others must hear of it
            yield from (_row("ask", part) for part in _packed(hashes[first].view(np.int64), run, place[first]))

    joined = rows.join(keys, "doc_id").select("doc_id", "mark", "text", "keys", "hot")
    return joined.mapInArrow(find, ", ".join(f"{k} {v}" for k, v, _ in _RUN))


_RUN = [
    ("kind", "string", pa.string()), ("run", "long", pa.int64()), ("doc_id", "long", pa.int64()), ("mark", "long", pa.int64()), ("start", "long", pa.int64()),
    ("windows", "long", pa.int64()), ("text", "string", pa.string()), ("doubt", "array<int>", pa.list_(pa.int32())),
    ("keys", "array<long>", pa.list_(pa.int64())), ("runs", "array<long>", pa.list_(pa.int64())), ("places", "array<int>", pa.list_(pa.int32())),
]


def _row(kind: str, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    given = columns | {"kind": pa.array([kind] * n, pa.string())}
    return pa.RecordBatch.from_arrays([given[k] if k in given else pa.nulls(n, t) for k, _, t in _RUN], [k for k, _, _ in _RUN])


def _lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(values, kind))


def _by_run(run: np.ndarray, place: np.ndarray) -> Iterator[dict[str, pa.Array]]:
    """A row for each run, with its places."""
    order = np.argsort(run, kind="stable")
    run, place = run[order], place[order]
    first = np.flatnonzero(np.append(True, run[1:] != run[:-1])) if len(run) else run
    if len(first):
        yield {"run": pa.array(run[first]), "places": _lists(place, np.diff(np.append(first, len(run))), pa.int32())}


def _packed(keys: np.ndarray, runs: np.ndarray, places: np.ndarray) -> Iterator[dict[str, pa.Array]]:
    """Rows of up to PACKED windows."""
    for a in range(0, len(keys), PACKED):
        z, n = slice(a, a + PACKED), np.array([min(PACKED, len(keys) - a)])
        yield {"keys": _lists(keys[z], n, pa.int64()), "runs": _lists(runs[z], n, pa.int64()), "places": _lists(places[z], n, pa.int32())}


def shared_windows(asks: DataFrame, owned: int) -> DataFrame:
    """run, places: the windows, of packed lists in which a task has each different one once, that another task has too.

    The lists are cut by owner, and an owner has about ``owned`` windows, so there are never more rows than windows.
    """
    total = asks.agg(F.sum(F.size("keys"))).first()[0] or 0
    owners = max(1, -(-total // owned))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                keys, runs, places = (batch.column(c)[row].values.to_numpy(zero_copy_only=False) for c in ("keys", "runs", "places"))
                owner = (mix(keys.view(np.uint64)) % np.uint64(owners)).astype(np.int64)
                order = np.argsort(owner, kind="stable")
                sizes = np.bincount(owner, minlength=owners)
                some = np.flatnonzero(sizes)
                lists = [_lists(x[order], sizes[some], t) for x, t in ((keys, pa.int64()), (runs, pa.int64()), (places, pa.int32()))]
                yield pa.RecordBatch.from_arrays([pa.array(some), *lists], ["owner", "keys", "runs", "places"])

    def answer(table: pa.Table) -> pa.Table:
        keys, runs, places = (one(table.column(c)).flatten().to_numpy(zero_copy_only=False) for c in ("keys", "runs", "places"))
        order = np.argsort(keys)
        same = keys[order][1:] == keys[order][:-1]
        shared = np.zeros(len(keys), bool)
        shared[order] = np.append(False, same) | np.append(same, False)
        shared &= runs >= 0
        rows = next(_by_run(runs[shared], places[shared]), {"run": pa.array([], pa.int64()), "places": pa.array([], pa.list_(pa.int32()))})
        return pa.table(rows)

    dealt = asks.select("keys", "runs", "places").mapInArrow(deal, "owner long, keys array<long>, runs array<long>, places array<int>")
    return dealt.groupBy("owner").applyInArrow(answer, "run long, places array<int>")


class Shard:
    """Runs of words that are indexed together and searched for windows of earlier documents."""

    def __init__(self):
        self.parts: list[tuple] = []
        self.size = 0

    def add(self, words: Words, first: np.ndarray, sizes: np.ndarray, docs: np.ndarray, info: list) -> None:
        """Runs of words: the places of their first ones, and how many they are."""
        at = ragged(first, sizes)
        names, some = np.unique(words.names[at], return_index=True)
        some = at[some]
        long = words.ends[some] - words.starts[some]
        different = (names, words.hashes[some], long, words.data[ragged(words.starts[some], long)])
        self.parts.append((words.hashes[at], sizes, docs, info, words.names[at], different))
        self.size += len(at)

    def _named(self) -> np.ndarray:
        """Names of the words, equal in the whole shard for the same bytes only."""
        hashes, long, data = (np.concatenate(x) for x in list(zip(*[p[5] for p in self.parts], strict=True))[1:])
        ends = np.cumsum(long)
        names, out, a = exact(data, ends - long, ends, hashes, np.argsort(hashes)), [], 0
        for *_, given, (known, *_) in self.parts:
            new = names[a : a + len(known)]
            a += len(known)
            out.append(given if np.array_equal(new, known) else new[np.searchsorted(known, given)])
        return np.concatenate(out)

    def search(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
        """Place of every window, its run, whether an earlier document has it; and what was given for the runs."""
        _, sizes, docs, info, _, _ = zip(*self.parts, strict=True)
        sizes, docs, names = np.concatenate(sizes), np.concatenate(docs), self._named()
        info = [x for part in info for x in part]
        index = FMIndex(names, sizes, docs, WINDOW)
        starts = np.cumsum(sizes) - sizes
        windows = np.maximum(sizes - WINDOW + 1, 0)
        pieces = -(-windows // PIECE)
        run = np.repeat(np.arange(len(sizes)), pieces)
        nth = np.arange(len(run)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        size = np.minimum(windows[run] - nth * PIECE, PIECE) + WINDOW - 1
        place, owner = index.earliest(names, starts[run] + nth * PIECE, size)
        order = np.argsort(place)
        place, owner = place[order], owner[order]
        of = np.searchsorted(starts, place, side="right") - 1
        return place - starts[of], of, owner < docs[of], info


def _spans(place: np.ndarray, run: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows in a row, as run, first place and how many."""
    if not len(place):
        return run, place, place
    cut = np.flatnonzero((np.diff(place) != 1) | (np.diff(run) != 0)) + 1
    first = np.append(0, cut)
    return run[first], place[first], np.diff(np.append(first, len(place)))


_OUT = [("doc_id", "long", pa.int64()), ("mark", "long", pa.int64()), ("start", "long", pa.int64()), ("windows", "long", pa.int64()), ("key", "long", pa.int64()), ("text", "string", pa.string())]


def _out(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    for a in range(0, len(rows), 5000):
        part = list(zip(*rows[a : a + 5000], strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, (_, _, t) in zip(part, _OUT, strict=True)], [k for k, _, _ in _OUT])


def repeated(docs: DataFrame, hot: int = HOT, most: int = SHARD) -> DataFrame:
    """doc_id, mark, start, windows: windows in a row, from word ``start``, whose words a document with a smaller doc_id
    has too. mark tells texts with the same doc_id apart. Null doc_ids are neither smaller nor larger than any."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole()).where("doc_id is not null")
    rows = rows.select("doc_id", "text", mark())
    found = stored(runs(rows, suspect_keys(rows, hot)))
    sure = found.where("kind = 'sure'").select("run", "places").unionAll(shared_windows(found.where("kind = 'ask'"), OWNED))
    sure = sure.groupBy("run").agg(F.flatten(F.collect_list("places")).alias("places"))
    sure = found.where("kind = 'run'").select("run", "doc_id", "mark", "start", "windows", "text", "doubt").join(sure, "run", "left")

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Settle what an earlier document of this task has; send the rest to the shards, by key."""
        shard = Shard()
        for table in gathered(batches, "text", CHUNK):
            words = Words(one(table.column("text")), named=True)
            doc, tag, start, windows = (one(table.column(c)).to_numpy(zero_copy_only=False) for c in ("doc_id", "mark", "start", "windows"))
            ok = np.ones(int(windows.sum()), bool)
            before = np.cumsum(windows) - windows
            lists = one(table.column("doubt"))
            size, ends = np.diff(np.asarray(lists.offsets)), np.asarray(lists.flatten()).astype(np.int64)
            base = np.repeat(before, size // 2)
            ok[ragged(base + ends[::2], ends[1::2] - ends[::2])] = False
            lists = one(table.column("places"))
            size = np.diff(np.asarray(lists.offsets))
            ok[np.repeat(before, size) + np.asarray(lists.flatten()).astype(np.int64)] = True
            at = np.flatnonzero(ok)
            run = np.repeat(np.arange(len(windows)), windows)[at]
            run, place, many = _spans(at - before[run], run)
            if not len(run):
                continue
            first = words.before[run] + place
            sizes = many + WINDOW - 1
            info = [(int(doc[r]), int(tag[r]), int(start[r] + p), words.starts[f : f + n], words.ends[f : f + n], words.data) for r, p, f, n in zip(run, place, first, sizes, strict=True)]
            shard.add(words, first, sizes, doc[run], info)
            if shard.size >= most:
                yield from _out(settled(shard))
                shard = Shard()
        if shard.size:
            yield from _out(settled(shard))

    def settled(shard: Shard) -> list[tuple]:
        place, run, earlier, info = shard.search()
        out = []
        for r, p, n in zip(*(x.tolist() for x in _spans(place[earlier], run[earlier])), strict=True):
            doc, tag, start, *_ = info[r]
            out.append((doc, tag, start + p, n, None, None))
        hashes, sizes = np.concatenate([p[0] for p in shard.parts]), np.concatenate([p[1] for p in shard.parts])
        keys = _least(_grams(hashes, GRAM), WINDOW - GRAM + 1)
        begin = np.cumsum(sizes) - sizes
        place, run = place[~earlier], run[~earlier]
        key = keys[begin[run] + place]
        cut = np.flatnonzero((np.diff(place) != 1) | (np.diff(run) != 0) | (np.diff(key) != 0)) + 1 if len(place) else np.zeros(0, np.int64)
        edges = np.concatenate([[0], cut, [len(place)]]).tolist() if len(place) else []
        for a, b in zip(edges, edges[1:], strict=False):
            doc, tag, start, s, e, data = info[run[a]]
            p = int(place[a])
            text = data[s[p] : e[p + b - a + WINDOW - 2]].tobytes().decode("utf-8")
            out.append((doc, tag, start + p, b - a, int(key[a].view(np.int64)), text))
        return out

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All runs of a key meet here; an index holds whole keys."""
        shard, last = Shard(), None
        for table in gathered(batches, "text", CHUNK):
            words = Words(one(table.column("text")), named=True)
            doc, tag, start, key = (one(table.column(c)).to_numpy(zero_copy_only=False) for c in ("doc_id", "mark", "start", "key"))
            edges = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1, [len(key)]]).tolist()
            for a, b in zip(edges, edges[1:], strict=False):
                if shard.size >= most and key[a] != last:
                    yield from _out(searched(shard))
                    shard = Shard()
                last = key[a]
                shard.add(words, words.before[a:b], words.sizes[a:b], doc[a:b], list(zip(doc[a:b].tolist(), tag[a:b].tolist(), start[a:b].tolist(), strict=True)))
        if shard.size:
            yield from _out(searched(shard))

    def searched(shard: Shard) -> list[tuple]:
        place, run, earlier, info = shard.search()
        return [(info[r][0], info[r][1], info[r][2] + p, n, None, None) for r, p, n in zip(*(x.tolist() for x in _spans(place[earlier], run[earlier])), strict=True)]

    kind = ", ".join(f"{k} {v}" for k, v, _ in _OUT)
    first = stored(sure.mapInArrow(local, kind))
    n = partitions(docs.sparkSession)
    meet = first.where("key is not null").repartition(n, "key").sortWithinPartitions("key", "doc_id")
    second = meet.mapInArrow(across, kind)
    return first.where("key is null").unionAll(second).select("doc_id", "mark", "start", "windows")


def without(text: str, spans: list[dict] | None) -> tuple[int, int, bytes]:
    """Words, removed words, and the rest joined by one space."""
    words = text.encode().split()
    n = len(words)
    if spans:
        keep = np.ones(n, bool)
        for s in spans:
            keep[s["start"] : s["start"] + s["windows"] + WINDOW - 1] = False
        words = [words[k] for k in np.flatnonzero(keep).tolist()]
    return n, n - len(words), b" ".join(words)


def marked(docs: DataFrame, hot: int = HOT, most: int = SHARD) -> DataFrame:
    """docs with the spans to remove from each row in the last column, named as no other."""
    (name,) = fresh(docs, "spans")
    spans = repeated(docs, hot, most).groupBy("doc_id", "mark").agg(F.collect_list(F.struct("start", "windows")).alias(name))
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), mark())
    return own.join(spans, ["doc_id", "mark"], "left").select("row.*", name)


def removals(docs: DataFrame, hot: int = HOT, most: int = SHARD) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256: one row for each row of docs.

    Null and empty texts have no words. Texts of fewer than WINDOW words lose nothing, and rows without a doc_id
    neither. Of repeated rows with one doc_id none is smaller, so they do not remove each other. An empty table
    gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in gathered(batches, "text", CHUNK):
            rows = [without(t, s) for t, s in zip(one(table.column("text")).to_pylist(), one(table.column("spans")).to_pylist(), strict=True)]
            columns = {
                "doc_id": one(table.column("doc_id")),
                "n_words": pa.array([n for n, _, _ in rows], pa.int64()),
                "n_removed": pa.array([n for _, n, _ in rows], pa.int64()),
                "kept_sha256": pa.array([hashlib.sha256(raw).hexdigest() for _, _, raw in rows], pa.string()),
            }
            yield pa.RecordBatch.from_pydict(columns)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole())
    return marked(rows, hot, most).mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def cleaned(docs: DataFrame) -> DataFrame:
    """The rows of docs with their columns: text without its repeated passages, n_chars to match. Texts that lose
    nothing stay as they are; texts that lose every word go."""
    found = marked(docs)
    spans = found.columns[-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in gathered(batches, "text", CHUNK):
            lists, texts = one(table.column(spans)).to_pylist(), one(table.column("text")).to_pylist()
            new = [without(t, s)[2].decode() if s else t for t, s in zip(texts, lists, strict=True)]
            table = table.drop_columns([spans])
            table = table.set_column(table.column_names.index("text"), "text", pa.array(new, pa.string()))
            if "n_chars" in table.column_names:
                old = one(table.column("n_chars"))
                sizes = [len(t) if s else n for t, s, n in zip(new, lists, old.to_pylist(), strict=True)]
                table = table.set_column(table.column_names.index("n_chars"), "n_chars", pa.array(sizes, old.type))
            left = pa.array([not s or bool(t) for t, s in zip(new, lists, strict=True)])
            yield from table.filter(left).to_batches()

    return found.mapInArrow(run, docs.schema)
