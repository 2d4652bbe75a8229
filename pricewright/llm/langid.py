"""Language of documents from a linear-chain conditional random field over their words.

Every word has features: its affixes, its character n-grams and, for words frequent in training, itself. Learned
transitions join neighbouring words; forward-backward gives each word a distribution over languages, also in text
that switches between them. A document's language is the one with the largest expected number of words.

Training takes at most ``per_label`` labelled documents of each language, a bounded sample; parts of it are trained
apart and their weights are averaged, ``ROUNDS`` times. Runs of words of different documents are joined, so that
the transitions learn how languages change.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricewright.llm.bpe import LETTER, classes
from pricewright.llm.common import gathered, mix, one, stored, whole

PER_LABEL = 400  # documents of a language to learn from
PARTS, ROUNDS, STEPS = 8, 2, 30
BUCKETS = 1 << 15  # of hashed features
FREQUENT = 5  # occurrences in the sample that make a word a lexicon entry
RUN, LENGTH = 40, 128  # words of one document in a row, and words in a training sequence
SEGMENT = 32  # words whose transitions are multiplied in one go
CHUNK = 2_000_000
WORDS = 200_000  # different words whose scores a worker keeps
FOLDS, HELD = 4, 2
UNKNOWN = "und"


def held_out(doc_id: str = "doc_id", folds: int = FOLDS, held: int = HELD) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds == held, F.lit(False))


def features(words: list[str], lexicon: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature ids of all words in a row, how many each has, and the hash of its letters (0: no letter)."""
    low = "\n".join(words).lower()
    points = np.frombuffer(low.encode("utf-32-le"), np.uint32).astype(np.int64)
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    breaks = points == 10
    keep = breaks | (classes()[points] == LETTER)
    points, breaks = points[keep], breaks[keep]
    # ^word$ for each word, as 1 letters 2
    ends = np.flatnonzero(np.append(breaks, True))
    sizes = np.diff(ends, prepend=-1) - 1
    flat = np.empty(int(sizes.sum()) + 2 * len(sizes), np.int64)
    last = np.cumsum(sizes + 2) - 1
    first = last - sizes - 1
    flat[first], flat[last] = 1, 2
    inner = np.ones(len(flat), bool)
    inner[first] = inner[last] = False
    flat[inner] = points[~breaks]
    row = np.repeat(np.arange(len(sizes)), sizes + 2)
    two = flat[:-1] << 21 | flat[1:]
    three = two[:-1] << 21 | flat[2:]
    with np.errstate(over="ignore"):
        h2, h3 = mix(two.astype(np.uint64)), mix(three.astype(np.uint64) + np.uint64(1 << 63))
        four = mix(h3[:-1] + flat[3:].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) if len(flat) > 3 else h3[:0]
        # A word's hash: the sum of its trigrams, each by its place.
        place = np.arange(len(flat)) - first[row]
        by_place = np.zeros(len(flat), np.uint64)
        by_place[: len(h2)] = mix(h2 + place[: len(h2)].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        by_place[last] = 0
        named = mix(np.add.reduceat(by_place, first)) | np.uint64(1)
    named[sizes == 0] = 0
    take = sizes[row] > 0
    ok2 = take[:-1] & (row[1:] == row[:-1])
    ok3 = take[:-2] & (row[2:] == row[:-2])
    ok4 = (take[:-3] & (row[3:] == row[:-3]) & ((flat[:-3] == 1) | (flat[3:] == 2))) if len(flat) > 3 else np.zeros(0, bool)
    ids, rows = [], []
    for hashed, ok in ((h2, ok2), (h3, ok3), (four, ok4)):
        ids.append((hashed[ok] % np.uint64(BUCKETS)).astype(np.int64))
        rows.append(row[: len(ok)][ok])
    if len(lexicon):
        at = np.minimum(np.searchsorted(lexicon, named), len(lexicon) - 1)
        known = np.flatnonzero((lexicon[at] == named) & (named > 0))
        ids.append(BUCKETS + at[known])
        rows.append(known)
    ids, rows = np.concatenate(ids), np.concatenate(rows)
    order = np.argsort(rows, kind="stable")
    return ids[order], np.bincount(rows, minlength=len(sizes)), named


def emissions(ids: np.ndarray, counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Scores of each word for each language."""
    sums = np.zeros((len(ids) + 1, weights.shape[1]))
    np.cumsum(weights[ids], axis=0, out=sums[1:], dtype=float)
    ends = np.cumsum(counts)
    return sums[ends] - sums[ends - counts]


def train(words: list[list[str]], labels: list[int], n_labels: int, lexicon: np.ndarray, weights: np.ndarray, moves: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and transitions after that many steps of gradient descent on the likelihood of the runs."""
    rng = np.random.default_rng(7)
    runs = [(w[k : k + RUN], y) for w, y in zip(words, labels, strict=True) for k in range(0, len(w), RUN)]
    order = rng.permutation(len(runs))
    flat = [w for k in order for w in runs[k][0]]
    target = np.concatenate([np.full(len(runs[k][0]), runs[k][1]) for k in order] or [np.zeros(0, np.int64)])
    if not flat:
        return weights, moves
    names = sorted(set(flat))
    index = {w: k for k, w in enumerate(names)}
    at = np.fromiter((index[w] for w in flat), np.int64, len(flat))
    ids, counts, _ = features(names, lexicon)
    owner = np.repeat(np.arange(len(names)), counts)
    t = min(LENGTH, len(at))
    b = -(-len(at) // t)
    total = len(at)
    on = (np.arange(b * t) < total).reshape(b, t)  # the last sequence ends where the words end
    at, target = (np.append(x, np.zeros(b * t - total, np.int64)).reshape(b, t) for x in (at, target))
    seen = np.zeros((n_labels, n_labels))
    np.add.at(seen, (target[:, :-1][on[:, 1:]], target[:, 1:][on[:, 1:]]), 1.0)
    gold = np.zeros((len(names), n_labels))
    np.add.at(gold, (at[on], target[on]), 1.0)
    weights, moves = weights.astype(float), moves.astype(float)
    state = [[np.zeros_like(x), np.zeros_like(x)] for x in (weights, moves)]
    for step in range(1, steps + 1):
        score = emissions(ids, counts, weights)
        psi = np.exp(score - score.max(axis=1, keepdims=True))[at]
        jump = np.exp(moves - moves.max())
        f, g = np.empty_like(psi), np.empty_like(psi)
        f[:, 0] = psi[:, 0] / psi[:, 0].sum(axis=1, keepdims=True)
        for k in range(1, t):
            x = (f[:, k - 1] @ jump) * psi[:, k]
            f[:, k] = x / x.sum(axis=1, keepdims=True)
        g[:, -1] = 1.0
        pairs = np.zeros_like(moves)
        for k in range(t - 1, 0, -1):
            x = psi[:, k] * g[:, k]
            both = x / ((f[:, k - 1] @ jump) * x).sum(axis=1, keepdims=True) * on[:, k, None]
            pairs += (f[:, k - 1].T @ both) * jump
            y = np.where(on[:, k, None], x @ jump.T, 1.0)
            g[:, k - 1] = y / y.sum(axis=1, keepdims=True)
        share = f * g
        share *= on[:, :, None] / share.sum(axis=2, keepdims=True)
        over = -gold
        np.add.at(over, at.ravel(), share.reshape(-1, n_labels))
        slope = np.stack([np.bincount(ids, over[owner, y], len(weights)) for y in range(n_labels)], axis=1)
        for value, grad, held in ((weights, slope / total + 1e-6 * weights, state[0]), (moves, (pairs - seen) / total + 1e-4 * moves, state[1])):
            held[0] = 0.9 * held[0] + 0.1 * grad
            held[1] = 0.99 * held[1] + 0.01 * grad**2
            value -= 0.2 * (held[0] / (1 - 0.9**step)) / (np.sqrt(held[1] / (1 - 0.99**step)) + 1e-8)
    return weights, moves


def expected(score: np.ndarray, moves: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Expected words of each language in every text. score: of all words of all texts in a row.

    Words lie in segments of SEGMENT. All segments' transition products come first, then the chain over each
    text's segments, then forward and backward inside all segments at once: the exact marginals, in few steps.
    """
    n_labels, total = score.shape[1], len(score)
    out = np.zeros((len(sizes), n_labels))
    if not total or not n_labels:
        return out
    psi = np.exp(score - score.max(axis=1, keepdims=True))
    jump = np.exp(moves - moves.max())
    parts = -(-sizes // SEGMENT)
    text = np.repeat(np.arange(len(sizes)), parts)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)
    begin = (np.cumsum(sizes) - sizes)[text] + nth * SEGMENT
    length = np.minimum(sizes[text] - nth * SEGMENT, SEGMENT)
    opens = nth == 0
    s = len(text)

    def at(k: int) -> tuple[np.ndarray, np.ndarray]:
        return psi[np.minimum(begin + k, total - 1)], k < length

    product = np.broadcast_to(np.eye(n_labels), (s, n_labels, n_labels)).copy()
    for k in range(SEGMENT):
        p, on = at(k)
        moved = product if k == 0 else product @ jump
        if k == 0:
            moved = np.where(opens[:, None, None], product, product @ jump)
        moved = moved * p[:, None, :]
        moved /= moved.max(axis=(1, 2), keepdims=True)
        product = np.where(on[:, None, None], moved, product)
    # Along each text's segments; texts with more segments go on longer.
    into, after = np.ones((s, n_labels)), np.ones((s, n_labels))
    where = np.argsort(nth, kind="stable")
    edges = np.searchsorted(nth[where], np.arange(int(nth.max()) + 2))
    for k in range(1, len(edges) - 1):
        now = where[edges[k] : edges[k + 1]]
        x = np.einsum("si,sij->sj", into[now - 1], product[now - 1])
        into[now] = x / x.sum(axis=1, keepdims=True)
    for k in range(len(edges) - 2, 0, -1):
        now = where[edges[k] : edges[k + 1]]
        x = np.einsum("sij,sj->si", product[now], after[now])
        after[now - 1] = x / x.sum(axis=1, keepdims=True)
    forward = np.empty((SEGMENT, s, n_labels))
    f = into
    for k in range(SEGMENT):
        p, on = at(k)
        x = (np.where(opens[:, None], 1.0, f @ jump) if k == 0 else f @ jump) * p
        f = np.where(on[:, None], x / x.sum(axis=1, keepdims=True), f)
        forward[k] = f
    sums, g = np.zeros((s, n_labels)), after
    for k in range(SEGMENT - 1, -1, -1):
        p, on = at(k)
        share = forward[k] * g
        sums += np.where(on[:, None], share / share.sum(axis=1, keepdims=True), 0.0)
        x = (p * g) @ jump.T
        g = np.where(on[:, None], x / x.sum(axis=1, keepdims=True), g)
    for y in range(n_labels):
        out[:, y] = np.bincount(text, sums[:, y], len(sizes))
    return out


class Tagger:
    """A trained model, with the scores of words met before."""

    def __init__(self, languages: list[str], lexicon: np.ndarray, weights: np.ndarray, moves: np.ndarray):
        self.languages, self.lexicon, self.weights, self.moves = languages, lexicon, weights, moves
        self.key = uuid.uuid4().hex
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.score, self.letters = np.zeros((0, len(self.languages))), np.zeros(0, bool)

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        split = [t.split() for t in texts]
        different = set().union(*split) if split else set()
        if len(self.index) + len(different) > WORDS:
            self.forget()
        new = list(different.difference(self.index))
        ids, counts, named = features(new, self.lexicon)
        self.index.update(zip(new, range(len(self.index), len(self.index) + len(new)), strict=True))
        self.score = np.concatenate([self.score, emissions(ids, counts, self.weights)])
        self.letters = np.append(self.letters, named > 0)
        sizes = np.array([len(s) for s in split], np.int64)
        at = np.fromiter((self.index[w] for s in split for w in s), np.int64, int(sizes.sum()))
        row = np.repeat(np.arange(len(texts)), sizes)
        lettered = self.letters[at]
        words = np.bincount(row[lettered], minlength=len(texts))
        share = expected(self.score[at[lettered]], self.moves, words)
        best = share.argmax(axis=1) if self.languages else np.zeros(len(texts), np.int64)  # of equal shares the first
        found = (words > 0) & bool(self.languages)
        names = [self.languages[k] if ok else UNKNOWN for k, ok in zip(best.tolist(), found.tolist(), strict=True)]
        top = share[np.arange(len(texts)), best] if self.languages else np.zeros(len(texts))
        return names, np.where(found, np.minimum(top / np.maximum(words, 1), 1.0), 0.0)


_READY: dict[str, Tagger] = {}


def fit(docs: DataFrame, per_label: int = PER_LABEL, folds: int = FOLDS, held: int = HELD) -> Tagger:
    """Learn from doc_id, text, lang of rows that are not held out; at most per_label documents of a language."""
    spark = docs.sparkSession
    may = F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id", folds, held)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), whole()).where(may)
    by = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = rows.select("doc_id", "lang").withColumn("nth", F.row_number().over(by)).where(F.col("nth") <= per_label)
    # per_label rows for each language, so a broadcast of them is bounded. Repeated rows count once.
    chosen = F.broadcast(chosen.select("doc_id", "lang", (F.col("nth") % PARTS).cast("int").alias("part")).dropDuplicates(["doc_id", "lang"]))
    sample = stored(rows.join(chosen, ["doc_id", "lang"]).repartitionById(PARTS, F.col("part")))
    languages = sorted(r["lang"] for r in sample.select("lang").distinct().collect())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for table in gathered(batches, "text", CHUNK):
            for t in one(table.column("text")).to_pylist():
                total.update(t.split())
        words = list(total)
        hashed = features(words, np.zeros(0, np.uint64))[2]
        yield pa.RecordBatch.from_arrays([pa.array(hashed.view(np.int64)), pa.array([total[w] for w in words], pa.int64())], ["word", "n"])

    frequent = sample.select("text").mapInArrow(count, "word long, n long").where("word <> 0").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT)
    lexicon = np.sort(np.array([r["word"] for r in frequent.select("word").collect()], np.int64).view(np.uint64))  # from the sample
    weights, moves = np.zeros((BUCKETS + len(lexicon), len(languages))), np.zeros((len(languages), len(languages)))
    for _ in range(ROUNDS if languages else 0):
        sent = spark.sparkContext.broadcast((weights, moves))

        def learn(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            words, labels, order = [], [], []
            for table in gathered(batches, "text", CHUNK):
                words += [t.split() for t in one(table.column("text")).to_pylist()]
                labels += [languages.index(x) for x in one(table.column("lang")).to_pylist()]
                order += one(table.column("doc_id")).to_pylist()
            if not words:
                return
            rank = sorted(range(len(order)), key=lambda k: (order[k], len(words[k])))
            w, m = train([words[k] for k in rank], [labels[k] for k in rank], len(languages), lexicon, *sent.value, STEPS)
            n = sum(map(len, words))
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([w.astype("<f4").tobytes()], pa.binary()), pa.array([m.tobytes()], pa.binary())], ["n", "weights", "moves"])

        # One row for each of the PARTS parts, each of the model's size.
        parts = sample.repartitionById(PARTS, F.col("part")).mapInArrow(learn, "n long, weights binary, moves binary").where("n > 0").collect()
        if not parts:
            break
        parts.sort(key=lambda r: (r["n"], bytes(r["weights"][:64])))
        total = sum(r["n"] for r in parts)
        weights = sum(np.frombuffer(r["weights"], "<f4").reshape(weights.shape).astype(float) * r["n"] for r in parts) / total
        moves = sum(np.frombuffer(r["moves"]).reshape(moves.shape) * r["n"] for r in parts) / total
        sent.unpersist()
    return Tagger(languages, lexicon, weights.astype(np.float32), moves)


def _sent(docs: DataFrame, model: Tagger):
    return docs.sparkSession.sparkContext.broadcast((model.key, model.languages, model.lexicon, model.weights, model.moves))


def _tagger(sent) -> Tagger:
    """The model, once in a worker."""
    key, *parts = sent.value
    if key not in _READY:
        _READY.clear()
        _READY[key] = Tagger(*parts)
    return _READY[key]


def languages(docs: DataFrame, per_label: int = PER_LABEL) -> DataFrame:
    """doc_id, held_out, lang_pred, score: one row for each row of docs.

    A null text, or one without a letter, is ``und`` with score 0, and so is every text if nothing can be learned.
    A null doc_id is neither learned from nor held out. score: the expected share of the text's words that are in
    the predicted language. Of equal shares the first language by name wins. An empty table gives no rows.
    """
    sent = _sent(docs, fit(docs, per_label))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in gathered(batches, "text", CHUNK):
            names, scores = _tagger(sent).predict(one(table.column("text")).to_pylist())
            arrays = [one(table.column(c)) for c in ("doc_id", "held_out")] + [pa.array(names, pa.string()), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), whole())
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def accepted(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of docs, with their columns, whose text has letters and a language with that share of its words."""
    sent = _sent(docs, fit(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in gathered(batches, "text", CHUNK):
            names, scores = _tagger(sent).predict([t or "" for t in one(table.column("text")).to_pylist()])
            keep = [n != UNKNOWN and s >= least for n, s in zip(names, scores.tolist(), strict=True)]
            yield from table.filter(pa.array(keep)).to_batches()
        _tagger(sent).forget()  # the worker goes on to other work

    return docs.mapInArrow(run, docs.schema)
