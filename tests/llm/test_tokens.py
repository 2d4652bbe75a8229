import hashlib
import json
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pricewright.llm import bpe, packing, unigram
from pricewright.llm.queries import BYTE_BPE, PIECES

LIBRARY = Tokenizer.from_file(BYTE_BPE)
ODD = [
    "", None, "hello", "it's 've'll 's's ''s 'll", "a  b\n\n c \n", "  ", "\t x\xa0 y", "<|endoftext|>a<|endoftext|><|endoftext|> b", "<|endof", "aaaaaaaaa aaaa aaa",
    "日本語 テスト 123 ½ ²", "'re'really 'LL", "é ​ x　y", " ", "\x00\x1c\x85 x", "a" * 100_000, "ab " * 50_000,
]


def same_as_library(texts):
    model = bpe.merges(BYTE_BPE)
    found = bpe.encode(pa.array(texts, pa.string()), model)
    for k, want in enumerate(LIBRARY.encode_batch([t or "" for t in texts], add_special_tokens=False)):
        ids = found.ids[found.offsets[k] : found.offsets[k + 1]]
        assert ids.tolist() == want.ids, texts[k]
        assert bpe.decode(ids, model) == LIBRARY.decode(want.ids, skip_special_tokens=False)


def test_odd_texts():
    same_as_library(ODD)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=8))
def test_any_text(texts):
    same_as_library(texts)


def test_blanks_signs_and_contractions():
    rng = random.Random(1)
    signs = [*"ab's tlrevmd  \n\t'12é日\xa0.!<|>", "<|endoftext|>"]
    same_as_library(["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(1500)])


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    for r in bpe.round_trip(docs, BYTE_BPE).collect():
        ids = LIBRARY.encode(texts[r.doc_id], add_special_tokens=False).ids
        raw = np.array(ids, "<u4").tobytes()
        text = LIBRARY.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, bytes(r.ids)) == (len(ids), hashlib.sha256(raw).hexdigest(), raw)
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert text == texts[r.doc_id]


def test_batches_of_any_size_give_the_same(monkeypatch):
    texts = [t for t in ODD if t and len(t) < 1000] * 3
    whole = bpe.encode(pa.array(texts), bpe.merges(BYTE_BPE))
    monkeypatch.setattr(bpe, "CHUNK", 7)
    parts = bpe.encode(pa.array(texts), bpe.merges(BYTE_BPE))
    assert (whole.ids == parts.ids).all() and (whole.offsets == parts.offsets).all()


def test_rows_without_text(spark):
    df = spark.createDataFrame([(1, None, "x"), (None, "", "y"), (2, "a b", "z"), (2, "a b", "z")], "doc_id long, text string, ids string")
    found = sorted([(str(r.doc_id), r.n_tokens) for r in bpe.round_trip(df, BYTE_BPE).collect()])
    assert found == [("1", 0), ("2", 2), ("2", 2), ("None", 0)]
    assert bpe.round_trip(df.limit(0), BYTE_BPE).count() == 0


# --- packing


def plain_best_fit(lengths, capacity):
    """How many bins; linear search for the tightest."""
    room = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in room if r >= n]
        if fits:
            room[room.index(min(fits))] -= n
        else:
            room.append(capacity - n)
    return len(room)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=120))
def test_plan_is_best_fit_decreasing(lengths):
    steps = packing.plan(Counter(lengths), 32)
    filled = Counter()
    for length, rank, many, first, offset in steps:
        assert rank >= 0 and many > 0
        for b in range(first, first + many):
            assert filled[b] == offset
            filled[b] += length
    assert sum(n * m for n, _, m, _, _ in steps) == sum(lengths)
    assert all(v <= 32 for v in filled.values())
    assert len(filled) == plain_best_fit(lengths, 32)
    assert sorted((n, r + k) for n, r, m, _, _ in steps for k in range(m)) == sorted((n, k) for n, c in Counter(lengths).items() for k in range(c))


def check_packed(rows, found, capacity):
    texts = {}
    for doc, text in rows:
        ids = LIBRARY.encode(text or "", add_special_tokens=False).ids + [2]
        texts.setdefault(doc, []).append(ids)
    pieces = sorted([tuple(r[:5]) for r in found], key=str)
    want = []
    for doc, many in texts.items():
        for ids in many:
            n = -(-len(ids) // capacity)
            cuts = [0, *[len(ids) - (n - 1 - k) * capacity for k in range(n)]]
            for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                want.append((doc, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert pieces == sorted(want, key=str)
    bins = {}
    for r in found:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:], strict=False))
        assert sum(n for _, n in parts) <= capacity
    return len(bins)


def test_packed_documents(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").repartition(3)
    rows, found = [tuple(r) for r in df.collect()], packing.pack(df, BYTE_BPE).collect()
    used = check_packed(rows, found, 1024)
    assert used == plain_best_fit([r.length for r in found], 1024)


def test_packed_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "a b c"), (3, "x y " * 40), (3, "x y " * 40), (4, "same"), (5, "same")]
    df = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], "doc_id long, text string, length int, task int")
    check_packed(rows, packing.pack(df, BYTE_BPE, 16).collect(), 16)
    assert packing.pack(df.limit(0), BYTE_BPE).count() == 0


def test_tightest_room():
    rooms = packing.Rooms(1024)
    for r in (3, 700, 1024):
        rooms.add(r, 1)
    assert [rooms.tightest(n) for n in (1, 3, 4, 700, 701, 1024)] == [3, 3, 700, 700, 1024, 1024]
    rooms.add(1024, -1)
    assert rooms.tightest(701) == -1


# --- unigram counts


@pytest.fixture(scope="module")
def scores():
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    skip = (model.is_byte, model.is_control, model.is_unknown, model.is_unused)
    return {model.id_to_piece(k): model.get_score(k) for k in range(model.get_piece_size()) if not any(f(k) for f in skip)}


def plain_viterbi(text, scores):
    """Pieces and score of the best path over the whole text; of equal scores the piece that begins first wins."""
    if not text:
        return 0, 0.0
    text = ("▁" + text).replace(" ", "▁")
    unknown, best = min(scores.values()) - unigram.PENALTY, [None] * (len(text) + 1)
    best[0] = (0.0, 0)
    for a in range(len(text)):
        for b in range(a + 1, min(len(text), a + 20) + 1):
            if (piece := text[a:b]) in scores:
                new = (best[a][0] + scores[piece], best[a][1] + 1)
            elif b == a + 1:
                new = (best[a][0] + unknown, best[a][1] + len(piece.encode()))
            else:
                continue
            if best[b] is None or new[0] > best[b][0]:
                best[b] = new
    return best[-1][1], best[-1][0]


def test_counts_are_those_of_the_whole_text(scores):
    rng = random.Random(2)
    texts = ["", "a  b   c", " x ", "☃", "▁", "  ", "\n\n a\tb", "日本語", "the the"]
    texts += ["".join(rng.choice("abcdefghijklmnop  the ing é日\n") for _ in range(rng.randint(0, 60))) for _ in range(600)]
    counts, found = unigram.vocabulary(PIECES).totals(texts)
    assert list(zip(counts.tolist(), found.tolist(), strict=True)) == [plain_viterbi(t, scores) for t in texts]


def test_no_path_of_the_library_is_better(scores):
    """The library adds single-precision scores, which lumps close paths together here; nearly all counts agree."""
    raw = bytearray(open(PIECES, "rb").read())
    at = raw.find(b"\x18\x02\x20\x80\xfa\x01")  # the model's kind, before its vocabulary size
    raw[at + 1] = 1  # unigram
    library = sentencepiece.SentencePieceProcessor(model_proto=bytes(raw))
    rng = random.Random(4)
    texts = [" ".join("".join(rng.choice("abcdefghinorst") for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(1, 12))) for _ in range(800)]
    counts, found = unigram.vocabulary(PIECES).totals(texts)
    paths = [library.encode(t, out_type=str) for t in texts]
    assert all(s >= sum(scores[p] for p in path) for s, path in zip(found, paths, strict=True))
    assert np.mean([n == len(path) for n, path in zip(counts, paths, strict=True)]) > 0.99


def test_counts_of_rows(spark, monkeypatch, scores):
    df = spark.createDataFrame([(1, None, 0), (None, "", 0), (2, "a b", 0), (2, "a b", 0), (3, "x" * 50_000, 0)], "doc_id long, text string, score int")
    found = {(r.doc_id, r.n_chars): r.n_tokens for r in unigram.token_counts(df, PIECES).collect()}
    assert found == {(1, 0): 0, (None, 0): 0, (2, 3): plain_viterbi("a b", scores)[0], (3, 50_000): plain_viterbi("x" * 50_000, scores)[0]}
    assert unigram.token_counts(df.limit(0), PIECES).count() == 0
    monkeypatch.setattr(unigram, "WORDS", 2)  # the store of words starts anew again and again
    model = unigram.Vocabulary(PIECES)
    assert [model.totals([t])[0][0] for t in ("one two three", "four", "one two three")] == [unigram.vocabulary(PIECES).totals([t])[0][0] for t in ("one two three", "four", "one two three")]


def test_vocabulary_files_are_read_in_place():
    assert BYTE_BPE == public_tokenizers.path("byte_bpe_50k.json") and json.load(open(BYTE_BPE))["model"]["type"] == "BPE"
