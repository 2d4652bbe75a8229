"""Language-model scores by prediction by partial matching over bytes.

The model is a trie of byte contexts up to ORDER symbols, trained on all documents that are not held out. A
symbol unseen in a context escapes to the shorter one (method D: each different symbol gives half a count to the
escape), where the symbols of the longer context are excluded. A pretrained model gives every (context, symbol) one probability, so
only the different ones of a share of the documents travel: shares send their words and byte n-grams to owners,
owners sum the counts of all shares and answer with counts and log probabilities, and each share scores its
documents with its own answers. No table of the whole corpus is sent anywhere.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewright.llm.common import gathered, one, stored, whole

ORDER = 5  # symbols of context
EDGE = 256  # the symbol before and after every text
SIGNS = 257
SHARE = 32_000_000  # bytes of text in a share
CHUNK = 2_000_000
FOLDS, HELD = 7, 2


def remainder(doc_id: str, folds: int) -> Column:
    return F.crc32(F.col(doc_id).cast("string")) % folds


def held_out(doc_id: str = "doc_id", folds: int = FOLDS, held: int = HELD) -> Column:
    return F.coalesce(remainder(doc_id, folds) == held, F.lit(False))


def symbols(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all (context, symbol) pairs of the texts, and how many each text has (its bytes and one end)."""
    pad = b"\0" * ORDER
    flat = np.frombuffer(b"".join([pad + t + b"\0" for t in texts]), np.uint8).astype(np.int64)
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    ends = np.cumsum(sizes + ORDER)
    starts = ends - sizes - ORDER
    for k in range(ORDER):
        flat[starts + k] = EDGE
    flat[ends - 1] = EDGE
    keys = np.zeros(max(0, len(flat) - ORDER), np.int64)
    for k in range(ORDER + 1):
        keys *= SIGNS
        keys += flat[k : len(flat) - ORDER + k]
    keep = np.ones(len(keys), bool)
    for k in range(ORDER):  # windows that begin in one text and end in the next
        keep[ends[:-1] - ORDER + k] = False
    return keys[keep], sizes


def packed(values: np.ndarray) -> bytes:
    return zlib.compress(np.diff(values, prepend=0).astype("<i8").tobytes(), 1)


def unpacked(blob: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(blob), "<i8"))


def dense(values: np.ndarray, kind: str) -> bytes:
    return zlib.compress(values.astype(kind).tobytes(), 1)


def undense(blob: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zlib.decompress(blob), kind)


def log_probabilities(keys: np.ndarray, counts: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """log10 of each key's probability. keys: sorted, with their counts in training (0: never seen there); all keys
    that share the last two symbols of the context must be here. pairs: counts of all symbols after one symbol."""
    seen = counts > 0
    gram, n = keys[seen], counts[seen]
    # From the longest context to the empty one: grams with counts, contexts with totals, kinds of symbols
    # and what the next longer context excludes.
    levels = []
    for k in range(ORDER, -1, -1):
        if k >= 2:
            here, at = np.unique(gram % SIGNS ** (k + 1), return_inverse=True)
            number = np.bincount(at, n, len(here)).astype(np.int64)
        else:
            table = pairs if k == 1 else pairs.sum(axis=0, keepdims=True)
            here = np.flatnonzero(table)
            number = table.ravel()[here]
        contexts, at = np.unique(here // SIGNS, return_inverse=True)
        levels.append((k, here, number, contexts, np.bincount(at, number, len(contexts)).astype(np.int64), np.bincount(at, minlength=len(contexts)), at))

    def find(table: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(table):
            return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
        at = np.minimum(np.searchsorted(table, x), len(table) - 1)
        return at, table[at] == x

    excluded = [None]  # for each level but the longest, by context of the level above it
    for (_, above, _, contexts, _, _, at), (k, here, number, _, _, _, _) in zip(levels, levels[1:], strict=False):
        place, hit = find(here, above % SIGNS ** (k + 1))
        excluded.append(np.bincount(at, np.where(hit, number[place], 0), len(contexts)).astype(np.int64))
    mass, out = np.zeros(len(keys)), np.full(len(keys), np.nan)
    open_, longer = np.arange(len(keys)), np.full(len(keys), -1)  # longer: place of the context escaped from
    for level, (k, here, number, contexts, totals, kinds, _) in enumerate(levels):
        x = keys[open_]
        c, known = find(contexts, x % SIGNS ** (k + 1) // SIGNS)
        above = longer[open_]
        less, fewer = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
        if level:
            came = above >= 0
            less[came] = excluded[level][above[came]]
            fewer[came] = levels[level - 1][5][above[came]]
        total = np.where(known, totals[c] - less, 0) if len(totals) else np.zeros(len(x), np.int64)
        kind = np.where(known, kinds[c] - fewer, 0) if len(kinds) else np.zeros(len(x), np.int64)
        place, hit = find(here, x % SIGNS ** (k + 1))
        use = total > 0
        with np.errstate(divide="ignore"):
            under = np.log10(np.maximum(total, 1))
            found = hit & use
            out[open_[found]] = mass[open_[found]] + np.log10(number[place[found]] - 0.5) - under[found]
            leave = ~found
            mass[open_[leave & use]] += (np.log10(np.maximum(kind, 1) / 2) - under)[leave & use]
        longer[open_] = np.where(known, c, -1)
        open_ = open_[leave]
    rest = SIGNS - int((pairs.sum(axis=0) > 0).sum())
    out[open_] = mass[open_] - np.log10(max(rest, 1))
    return out


def scores(docs: DataFrame, share: int = SHARE, folds: int = FOLDS, held: int = HELD) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row for each row of docs.

    Words are lower-cased in A-Z. The text that the model scores is the words joined by one blank and an end, so base
    and model judge the same event. Null and empty texts are the end alone. A null doc_id is in no fold: such rows
    train and are not held out. Without training rows all symbols are equally likely. Repeated rows are scored each
    and train each; an empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole(), held_out("doc_id", folds, held).alias("held"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(spark.sparkContext.defaultParallelism, -(-size // share))
    owners = n
    rows = rows.withColumn("share", F.pmod(F.xxhash64("doc_id"), F.lit(n)).cast("int"))

    def owner_of(keys: np.ndarray) -> np.ndarray:
        """Keys with the same last two symbols of context have the same owner."""
        return ((keys // SIGNS % SIGNS**2) * 40_503 % 65_537 * 2_654_435 >> 8) % owners

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The words and n-grams of a share, by owner, and its symbol pairs."""
        words, trained, me = set(), Counter(), TaskContext.get().partitionId()
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        pairs, docs_in, rows_in = np.zeros(SIGNS * SIGNS, np.int64), 0, 0
        for table in gathered(batches, "text", CHUNK):
            out = np.array(one(table.column("held")).to_pylist(), bool)
            split = [t.encode().lower().split() for t in one(table.column("text")).to_pylist()]
            rows_in += len(split)
            for w, h in zip(split, out.tolist(), strict=True):
                if h:
                    words.update(w)
                else:
                    trained.update(w)
            docs_in += int((~out).sum())
            key, sizes = symbols([b" ".join(w) for w in split])
            apart = np.repeat(out, sizes)
            pairs += np.bincount(key[~apart] % SIGNS**2, minlength=SIGNS**2)
            new, n_new = np.unique(key * 2 + apart, return_counts=True)
            n_new = np.where(new & 1, 0, n_new)
            both = np.concatenate([keys, new >> 1])
            keys, at = np.unique(both, return_inverse=True)
            counts = np.bincount(at, np.concatenate([counts, n_new]), len(keys)).astype(np.int64)
        if not rows_in:
            return
        words.update(trained)
        dealt: list[list[bytes]] = [[] for _ in range(owners)]
        for w in words:
            dealt[zlib.crc32(w) % owners].append(w)
        out_rows = []
        for o, w in enumerate(dealt):
            if w or not o:  # owner 0 also has the end of every text
                w.sort()
                number = np.array([trained[x] for x in w] + ([docs_in] if not o else []), np.int64)
                out_rows.append((me, "word", o, zlib.compress(b" ".join(w), 1), dense(number, "<i8")))
        owner = owner_of(keys)
        order = np.argsort(owner, kind="stable")
        edges = np.flatnonzero(np.diff(owner[order], prepend=-1, append=-1))
        for a, b in zip(edges.tolist(), edges[1:].tolist(), strict=False):
            at = order[a:b]
            out_rows.append((me, "gram", int(owner[order[a]]), packed(keys[at]), dense(counts[at], "<i8")))
        used = np.flatnonzero(pairs)
        out_rows.append((me, "pair", 0, packed(used), dense(pairs[used], "<i8")))
        yield _batch(out_rows)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, values in zip(batch.column("keys").to_pylist(), batch.column("values").to_pylist(), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(unpacked(keys)), pa.array(undense(values, "<i8"))], ["pair", "n"])

    kind = "share int, kind string, owner int, keys binary, values binary"
    told = stored(rows.repartitionById(n, F.col("share")).mapInArrow(tell, kind))
    pairs = np.zeros(SIGNS * SIGNS, np.int64)
    for r in told.where("kind = 'pair'").mapInArrow(spread, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():
        pairs[r["pair"]] = r["n"]  # SIGNS^2 rows at most
    sent = spark.sparkContext.broadcast(pairs.reshape(SIGNS, SIGNS))

    def answer(table: pa.Table) -> pa.Table:
        """To every share its own keys, with what all shares together know of them."""
        share, keys, values = (table.column(c).to_pylist() for c in ("share", "keys", "values"))
        owner, out = table.column("owner")[0].as_py(), []
        if table.column("kind")[0].as_py() == "word":
            total, ends = Counter(), 0
            lists = [zlib.decompress(k).split() for k in keys]
            for x, v in zip(lists, values, strict=True):
                number = undense(v, "<i8")
                for w, c in zip(x, number.tolist(), strict=False):
                    total[w] += c
                ends += int(number[len(x) :].sum())
            tokens, known = sum(total.values()) + ends, sum(c > 0 for c in total.values()) + (ends > 0)
            for s, k, x in zip(share, keys, lists, strict=True):
                out.append((s, "word", owner, tokens, known, ends, k, dense(np.array([total[w] for w in x], np.int64), "<i8")))
        else:
            lists = [unpacked(k) for k in keys]
            both, at = np.unique(np.concatenate(lists), return_inverse=True)
            counts = np.bincount(at, np.concatenate([undense(v, "<i8") for v in values]), len(both)).astype(np.int64)
            logs = log_probabilities(both, counts, sent.value)[at]
            for s, k, x in zip(share, keys, np.split(logs, np.cumsum([len(x) for x in lists])[:-1]), strict=True):
                out.append((s, "gram", owner, 0, 0, 0, k, x.astype("<f4").tobytes()))
        names = ["share", "kind", "owner", "tokens", "known", "ends", "keys", "values"]
        kinds = (pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
        return pa.Table.from_arrays([pa.array(v, t) for v, t in zip(zip(*out, strict=True), kinds, strict=True)], names)

    kind = "share int, kind string, owner int, tokens long, known long, ends long, keys binary, values binary"
    answers = stored(told.where("kind <> 'pair'").groupBy("kind", "owner").applyInArrow(answer, kind))
    # Every share is told the same by an owner, so each owner counts once.
    figures = answers.where("kind = 'word'").groupBy("owner").agg(*[F.max(c).alias(c) for c in ("tokens", "known", "ends")])
    train, different, ends = (x or 0 for x in figures.agg(F.sum("tokens"), F.sum("known"), F.sum("ends")).first())

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: dict[bytes, int] = {}
        counts, keys, logs, ready = [], [], [], None
        for batch in batches:
            told_now = batch.filter(batch.column("kind").is_valid())
            for kind, k, v in zip(*[told_now.column(c).to_pylist() for c in ("kind", "keys", "values")], strict=True):
                if kind == "word":
                    words = zlib.decompress(k).split()
                    index.update(zip(words, range(len(index), len(index) + len(words)), strict=True))
                    counts.append(undense(v, "<i8"))
                else:
                    keys.append(unpacked(k))
                    logs.append(np.frombuffer(v, "<f4").astype(float))
            texts = batch.filter(batch.column("kind").is_null())
            if not texts.num_rows:
                continue
            if ready is None:
                number = np.concatenate([*counts, np.zeros(0, np.int64)])
                key = np.concatenate(keys)
                order = np.argsort(key)
                ready = np.log10(number + 1.0), number > 0, key[order], np.concatenate(logs)[order]
                keys, logs, counts = [], [], []
            for table in gathered(iter([texts]), "text", CHUNK):
                yield _scored(table, index, ready)

    def _scored(table: pa.Table, index: dict[bytes, int], ready: tuple) -> pa.RecordBatch:
        word_log, word_known, key, log = ready
        split = [t.encode().lower().split() for t in one(table.column("text")).to_pylist()]
        sizes = np.array([len(w) for w in split], np.int64)
        at = np.fromiter((index[w] for s in split for w in s), np.int64, int(sizes.sum()))
        row = np.repeat(np.arange(len(split)), sizes)
        base = np.bincount(row, word_log[at], len(split)) + np.log10(ends + 1.0) - (sizes + 1) * np.log10(train + different + 1.0)
        known = np.bincount(row, word_known[at], len(split)).astype(np.int64) + (ends > 0)
        grams, lengths = symbols([b" ".join(w) for w in split])
        order = np.argsort(grams)
        ordered = grams[order]
        new = np.flatnonzero(np.diff(ordered, prepend=-1))
        value = np.empty(len(grams))
        value[order] = np.repeat(log[np.searchsorted(key, ordered[new])], np.diff(np.append(new, len(grams))))
        score = np.bincount(np.repeat(np.arange(len(split)), lengths), value, len(split))
        columns = {
            "doc_id": one(table.column("doc_id")),
            "held_out": one(table.column("held")),
            "n_tokens": pa.array(sizes + 1),
            "n_known": pa.array(known),
            "train_tokens": pa.array(np.full(len(split), train, np.int64)),
            "base_score": pa.array(base),
            "score": pa.array(score),
        }
        return pa.RecordBatch.from_pydict(columns)

    nothing = F.lit(None)
    texts = rows.select("share", nothing.cast("string").alias("kind"), nothing.cast("binary").alias("keys"), nothing.cast("binary").alias("values"), "doc_id", "text", "held")
    known = answers.select("share", "kind", "keys", "values", nothing.cast("long").alias("doc_id"), nothing.cast("string").alias("text"), nothing.cast("boolean").alias("held"))
    together = known.unionAll(texts).repartitionById(n, F.col("share")).sortWithinPartitions(F.col("kind").isNull())
    return together.mapInArrow(score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.string(), pa.int32(), pa.binary(), pa.binary())
    arrays = [pa.array(v, t) for v, t in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, ["share", "kind", "owner", "keys", "values"])
