"""Byte-level BPE by a pair occurrence index.

All different pieces of a batch of documents lie in one array of symbols with links to the neighbours.
An index maps every mergeable pair to all its positions. Ranks are applied in ascending order, each to
all positions of its pair at once; the pairs that a merge makes enter the index under their own rank.
Every piece occurs once however often the batch repeats it, so the work follows the different pieces.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewright.llm.common import exact, gathered, one, ragged, span_hashes, text_bytes, whole

OTHER, LETTER, NUMBER, SPACE = range(4)
# The white space of Unicode.
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
BATCH = 8_000_000  # bytes of text whose different pieces are merged together
CHUNK = 1_000_000  # bytes of text cut into pieces at a time
NONE = np.int64(1 << 40)


@cache
def classes() -> np.ndarray:
    """Letter, number, white space or other, by code point."""
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.array([kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], np.uint8)
    out[WHITE] = SPACE
    return out


def cut(points: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """True where a piece begins. points: code points of all segments, begins: where a segment begins.

    The rule is the one of the byte-level pattern: contractions, then runs of letters, of numbers and of
    other signs, each with one blank before it, then white space without its last character.
    """
    n = len(points)
    if not n:
        return np.zeros(0, bool)
    kind = classes()[points]
    head = np.zeros(n, bool)
    head[begins[begins < n]] = True
    run = np.empty(n, bool)
    run[0], run[1:] = True, kind[1:] != kind[:-1]
    run |= head
    white = kind == SPACE
    start = run.copy()
    follows = np.zeros(n, bool)  # the next character belongs to the segment and is no white space
    follows[:-1] = ~white[1:] & ~head[1:]
    start |= white & follows
    blank = np.zeros(n, bool)  # a blank before it, which its run takes along
    blank[1:] = (points[:-1] == 0x20) & ~head[1:] & ~white[1:]
    start &= ~blank
    quotes = np.flatnonzero((points == 0x27) & start)
    if len(quotes):
        edge = np.append(np.flatnonzero(head), n)
        room = edge[np.searchsorted(edge, quotes, side="right")] - quotes
        one, two = (points[np.minimum(quotes + k, n - 1)] for k in (1, 2))
        short = (room > 1) & np.isin(one, [ord(c) for c in "stmd"])
        pairs = [(ord(a), ord(b)) for a, b in ("re", "ve", "ll")]
        long = (room > 2) & np.logical_or.reduce([(one == a) & (two == b) for a, b in pairs])
        for hit, size in ((short, 2), (long, 3)):
            start[quotes[hit] + 1] = False
            after = quotes[hit & (room > size)] + size
            start[after] = True
    return start


class Merges:
    """A vocabulary with its merges, read from a tokenizers file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        sign = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(x for x in range(256) if x not in shown)}
        self.byte_ids = np.array([vocab[sign[b]] for b in range(256)], np.int64)
        rows = [m if isinstance(m, list) else m.split(" ") for m in merges]
        left, right, made = (np.array([vocab[x] for x in part], np.int64) for part in ([a for a, _ in rows], [b for _, b in rows], [a + b for a, b in rows]))
        order = np.argsort(key := left << 20 | right)
        self.keys, self.rank_of = key[order], order
        self.left, self.right, self.made = left, right, made
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        back = {c: b for b, c in sign.items()}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.text_of: list[bytes] = [b""] * size
        for word, i in vocab.items():
            self.text_of[i] = bytes(back[c] for c in word)
        for word, i in self.special.items():
            self.text_of[i] = word.encode()
        self.slots, self.slot_rank = self._table()

    def _table(self) -> tuple[np.ndarray, np.ndarray]:
        """Open addressing, so that a rank is found in a few gathers."""
        size = 1 << 19
        keys, ranks = np.full(size, -1, np.int64), np.full(size, NONE, np.int64)
        left = np.arange(len(self.keys))
        at = self._slot(self.keys)
        while len(left):
            free = keys[at[left]] < 0
            now, first = np.unique(at[left[free]], return_index=True)
            put = left[free][first]
            keys[now], ranks[now] = self.keys[put], self.rank_of[put]
            left = np.setdiff1d(left, put)
            at[left] = (at[left] + 1) % size
        return keys, ranks

    @staticmethod
    def _slot(key: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(45)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE where it is no merge."""
        key = left << 20 | right
        at = self._slot(key)
        found = self.slots[at]
        out = self.slot_rank[at]
        miss = np.flatnonzero((found != key) & (found >= 0))
        out[found != key] = NONE
        while len(miss):
            at[miss] = (at[miss] + 1) % len(self.slots)
            found = self.slots[at[miss]]
            hit = found == key[miss]
            out[miss[hit]] = self.slot_rank[at[miss[hit]]]
            miss = miss[~hit & (found >= 0)]
        return out

    def merge(self, data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces one after the other, and how many each has. data: the pieces' bytes."""
        n = len(data)
        if not n:
            return np.zeros(0, np.int64), np.zeros(len(lengths), np.int64)
        symbol = np.append(self.byte_ids[data], -1)  # the last place stands for "no neighbour"
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        ends = np.cumsum(lengths)
        after[ends[lengths > 0] - 1] = n
        before[(ends - lengths)[lengths > 0]] = n
        after[n] = before[n] = n
        alive = np.ones(n + 1, bool)
        at = np.flatnonzero(after[:n] < n)
        late_rank, late_at = [self.ranks(symbol[at], symbol[after[at]])], [at]
        bounds = [0, 16, 64, 256, 1024, 2048, 4096, 8192, 12288, 16384, 24576, 32768, 40960, len(self.left)]
        for low, high in zip(bounds, [*bounds[1:]], strict=False):
            rank, at = np.concatenate(late_rank), np.concatenate(late_at)
            now = rank < high
            late_rank, late_at = [rank[keep := (~now & (rank < NONE))]], [at[keep]]
            order = np.argsort(rank[now], kind="stable")
            rank, at = rank[now][order], at[now][order]
            index: dict[int, list[np.ndarray]] = {}
            if len(rank):
                edges = np.flatnonzero(np.diff(rank)) + 1
                index = {r: [p] for r, p in zip(rank[np.append(0, edges)].tolist(), np.split(at, edges), strict=True)}
            heap = sorted(index)
            while heap:
                r = heapq.heappop(heap)
                held = index.pop(r)
                p = held[0] if len(held) == 1 else np.concatenate(held)
                a, b = self.left[r], self.right[r]
                q = after[p]
                ok = alive[p] & (symbol[p] == a) & (symbol[q] == b)
                p = p[ok]
                if a == b or len(held) > 1:
                    p = np.unique(p)
                if a == b:
                    p = self._apart(p, after)
                if not len(p):
                    continue
                q = after[p]
                symbol[p], alive[q] = self.made[r], False
                nxt = after[q]
                after[p] = nxt
                before[nxt] = p
                before[n] = n
                left = before[p]
                pair_at = np.concatenate([left[left < n], p[nxt < n]])
                new = self.ranks(symbol[pair_at], symbol[after[pair_at]])
                soon = new < high
                late = ~soon & (new < NONE)
                if late.any():
                    late_rank.append(new[late])
                    late_at.append(pair_at[late])
                if soon.any():
                    rank, at = new[soon], pair_at[soon]
                    order = np.argsort(rank, kind="stable")
                    rank, at = rank[order], at[order]
                    edges = np.flatnonzero(np.diff(rank)) + 1
                    for k, part in zip(rank[np.append(0, edges)].tolist(), np.split(at, edges), strict=True):
                        if k in index:
                            index[k].append(part)
                        else:
                            index[k] = [part]
                            heapq.heappush(heap, k)
        ids = symbol[:n][alive[:n]]
        counts = np.add.reduceat(np.append(alive[:n], 0).astype(np.int64), np.minimum(ends - lengths, n))
        return ids, np.where(lengths > 0, counts, 0)

    @staticmethod
    def _apart(p: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Of positions of a pair of equal symbols that overlap, every second, from the left."""
        if len(p) < 2:
            return p
        joined = np.append(False, after[p[:-1]] == p[1:])
        place = np.arange(len(p))
        first = np.maximum.accumulate(np.where(joined, 0, place))
        return p[(place - first) % 2 == 0]


@cache
def merges(path: str) -> Merges:
    return Merges(path)


class Encoded:
    """Ids of a batch: ids of row k are ids[offsets[k]:offsets[k + 1]]."""

    def __init__(self, ids: np.ndarray, offsets: np.ndarray):
        self.ids, self.offsets = ids, offsets


def encode(column: pa.Array, model: Merges) -> Encoded:
    """Ids of every text; a special token's string in a text is that token."""
    data, offsets = text_bytes(column)
    # Segments: what lies between special tokens. Each special token is a segment without text.
    cuts, marks, inside = [], {}, np.zeros(len(data) + 1 if model.special else 0, bool)
    for word, i in model.special.items():
        raw = word.encode()
        flat, at = data.tobytes() if len(data) else b"", 0
        while (at := flat.find(raw, at)) >= 0:
            row_end = offsets[np.searchsorted(offsets, at, side="right")]
            if at + len(raw) <= row_end:
                cuts += [at, at + len(raw)]
                marks[at] = i
                inside[at + 1 : at + len(raw)] = True
                at += len(raw)
            else:
                at += 1
    begins = np.unique(np.concatenate([offsets, np.array(cuts, np.int64)]))
    hashes, starts, lengths = [], [], []
    low = 0
    while low < len(data):
        high = begins[np.searchsorted(begins, low + CHUNK, side="right") - 1] if low + CHUNK < len(data) else len(data)
        if high <= low:
            high = begins[np.searchsorted(begins, low, side="right")]
        part = data[low:high]
        points = np.frombuffer(part.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        place = np.append(np.flatnonzero((part & 0xC0) != 0x80), len(part))
        inner = begins[(begins >= low) & (begins < high)] - low
        first = np.flatnonzero(cut(points, np.searchsorted(place, inner)))
        s = place[first]
        if marks:
            s = s[~inside[s + low]]
        e = np.append(s[1:], len(part))
        hashes.append(span_hashes(part, s, e))
        starts.append(s + low)
        lengths.append(e - s)
        low = int(high)
    if not hashes:
        return Encoded(np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64))
    hashes, starts, lengths = np.concatenate(hashes), np.concatenate(starts), np.concatenate(lengths)
    order = np.argsort(hashes)
    named = exact(data, starts, starts + lengths, hashes, order)  # pieces are merged by their bytes
    if named is not hashes:
        hashes, order = named, np.argsort(named)
    ordered = hashes[order]
    new = np.append(True, ordered[1:] != ordered[:-1])
    which = np.empty(len(hashes), np.int64)
    which[order] = np.cumsum(new) - 1
    shown = order[new]
    special = _marked(starts[shown], marks) if marks else np.full(len(shown), -1)
    plain = np.where(special < 0, lengths[shown], 0)
    ids, counts = model.merge(data[ragged(starts[shown], plain)], plain)
    if (special >= 0).any():
        at = np.cumsum(counts) - counts
        ids = np.insert(ids, at[special >= 0], special[special >= 0])
        counts = counts + (special >= 0)
    at = np.cumsum(counts) - counts
    per = counts[which]
    out = ids[ragged(at[which], per)].astype(np.uint32)
    total = np.append(0, np.cumsum(per))
    return Encoded(out, total[np.searchsorted(starts, offsets)])


def _marked(starts: np.ndarray, marks: dict[int, int]) -> np.ndarray:
    at = np.array(sorted(marks))
    found = np.minimum(np.searchsorted(at, starts), len(at) - 1)
    return np.where(at[found] == starts, np.array([marks[int(x)] for x in at])[found], -1)


def decode(ids: np.ndarray, model: Merges) -> str:
    """The text of the ids, special tokens included; malformed bytes become U+FFFD."""
    return b"".join(map(model.text_of.__getitem__, ids.tolist())).decode("utf-8", "replace")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, ids (binary, little-endian unsigned 32-bit).

    A null or empty text has no tokens; its hashes are those of nothing. Equal rows give equal rows; a null
    doc_id stays null. Any length works: a batch holds about BATCH bytes, or one row. No exchange.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = merges(path)
        for table in gathered(batches, "text", BATCH):
            encoded = encode(one(table.column("text")), model)
            rows: list[list] = [[], [], [], []]
            for a, b in zip(encoded.offsets[:-1].tolist(), encoded.offsets[1:].tolist(), strict=True):
                ids = encoded.ids[a:b]
                raw = ids.astype("<u4").tobytes()
                text = decode(ids, model)
                for column, value in zip(rows, (b - a, hashlib.sha256(raw).hexdigest(), hashlib.sha256(text.encode()).hexdigest(), raw), strict=True):
                    column.append(value)
            kinds = (pa.int64(), pa.string(), pa.string(), pa.binary())
            arrays = [one(table.column("doc_id")), *[pa.array(v, t) for v, t in zip(rows, kinds, strict=True)]]
            for batch in pa.Table.from_arrays(arrays, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]).to_batches(2000):
                yield batch

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole())
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, ids binary")
