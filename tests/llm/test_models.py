import glob
import gzip
import hashlib
import itertools
import math

import numpy as np
import pytest

from pricewright.llm import langid, ppm, warc
from pricewright.llm.common import folder
from tests.llm import plain

# --- language


def test_marginals_are_exact(monkeypatch):
    monkeypatch.setattr(langid, "SEGMENT", 3)
    rng = np.random.default_rng(0)
    sizes, moves = np.array([0, 5, 0, 1, 7, 6]), rng.normal(size=(3, 3))
    score = rng.normal(size=(int(sizes.sum()), 3))
    found, at = langid.expected(score, moves, sizes), 0
    for k, n in enumerate(sizes):
        want, total = np.zeros(3), 0.0
        for path in itertools.product(range(3), repeat=int(n)) if n else ():
            p = np.exp(sum(score[at + i, y] for i, y in enumerate(path)) + sum(moves[a, b] for a, b in itertools.pairwise(path)))
            total += p
            for y in path:
                want[y] += p
        assert np.allclose(found[k], want / total if n else 0)
        at += n


def test_gradient_steps_raise_the_likelihood():
    words = [["der", "und", "die", "nicht"] * 30, ["the", "and", "of", "not"] * 30]
    none = np.zeros(0, np.uint64)
    weights, moves = langid.train(words, [0, 1], 2, none, np.zeros((langid.BUCKETS, 2)), np.zeros((2, 2)), 30)
    ids, counts, _ = langid.features(["der", "the", "undder", "andof"], none)
    assert langid.emissions(ids, counts, weights).argmax(axis=1).tolist() == [0, 1, 0, 1]
    assert moves[0, 0] > moves[0, 1] and moves[1, 1] > moves[1, 0]


def test_training_follows_the_likelihood_of_all_words(monkeypatch):
    """One step from weights of zero: 0.2 against the sign of the slope, found by trying all labellings of all sequences,
    the short last one included."""
    monkeypatch.setattr(langid, "LENGTH", 4)
    words = [["aa", "bb", "aa", "cc", "aa", "bb", "cc"], ["bb", "dd", "dd", "cc", "tail", "dd", "dd"]]
    none, zero = np.zeros(0, np.uint64), np.zeros((langid.BUCKETS, 2))
    weights, moves = langid.train(words, [0, 1], 2, none, zero, np.zeros((2, 2)), 1)
    runs = [(w[k : k + langid.RUN], y) for w, y in zip(words, [0, 1], strict=True) for k in range(0, len(w), langid.RUN)]
    flat = [(w, y) for k in np.random.default_rng(7).permutation(len(runs)) for w in runs[k][0] for y in [runs[k][1]]]
    parts = [flat[k : k + 4] for k in range(0, len(flat), 4)]
    assert len(parts[-1]) == 2
    names = sorted({w for w, _ in flat})
    ids, counts, _ = langid.features(names, none)
    of = dict(zip(names, np.split(ids, np.cumsum(counts)[:-1]), strict=True))

    def likelihood(w, m):
        total = 0.0
        for part in parts:
            score = lambda path, part=part: sum(w[of[x], y].sum() for (x, _), y in zip(part, path, strict=True)) + sum(m[a, b] for a, b in itertools.pairwise(path))
            total += score([y for _, y in part]) - math.log(sum(math.exp(score(p)) for p in itertools.product(range(2), repeat=len(part))))
        return total / len(flat)

    for a, b in itertools.product(range(2), repeat=2):
        step = np.zeros((2, 2))
        step[a, b] = 1e-4
        slope = (likelihood(zero, step) - likelihood(zero, -step)) / 2e-4
        assert moves[a, b] == pytest.approx(0.2 * np.sign(slope) if abs(slope) > 1e-6 else 0, abs=1e-3)
    for name in names:
        for y in range(2):
            step = np.zeros_like(zero)
            step[of[name][0], y] = 1e-4
            slope = (likelihood(step, np.zeros((2, 2))) - likelihood(-step, np.zeros((2, 2)))) / 2e-4
            if abs(slope) > 1e-5:
                assert weights[of[name][0], y] == pytest.approx(0.2 * np.sign(slope), abs=1e-3)
    assert np.abs(weights[of["tail"]]).max() > 0.1


def test_features_are_letters_only():
    ids, counts, named = langid.features(["Word", "word,", "12", "wo-rd"], np.zeros(0, np.uint64))
    assert counts[0] == counts[1] == counts[3] > counts[2] == 0
    assert named[0] == named[1] == named[3] != 0 and named[2] == 0


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    found = langid.languages(docs).collect()
    assert sorted(r.doc_id for r in found) == sorted(truth)
    assert all(r.held_out == (plain.fold(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in found)
    held = [r.lang_pred == truth[r.doc_id] for r in found if r.held_out and truth[r.doc_id]]
    assert len(held) > 200 and np.mean(held) > 0.98


ROWS = [(1, None, "en"), (2, "123 !!", "en"), (None, "the of", None), (3, "the of and", "en"), (4, "der die und", "de"), (4, "der die und", "de"), (5, "the " * 50_000, "en")]


def test_language_of_odd_rows(spark):
    df = spark.createDataFrame([(*r, "x") for r in ROWS], "doc_id long, text string, lang string, lang_pred string")
    found = {r.doc_id: (r.lang_pred, r.held_out) for r in langid.languages(df).collect()}
    assert found[1][0] == found[2][0] == "und" and found[4][0] == "de" and found[5][0] == "en"
    assert found[None] == ("en", False)
    assert langid.languages(df.limit(0)).count() == 0
    kept = langid.accepted(df)
    assert kept.columns == df.columns and sorted([str(r.doc_id) for r in kept.collect()]) == ["3", "4", "4", "5", "None"]


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "the", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in langid.languages(df).collect()] == [("und", 0.0)]


# --- language-model scores


@pytest.mark.parametrize(
    "rows",
    [
        [(1, "Hello hello world"), (2, None), (3, ""), (None, "x y"), (4, "日本 テ"), (5, "the cat"), (11, "zebra \x00 q"), (11, "zebra \x00 q")],
        [(k, "a" * k) for k in range(30)],
        [(11, "all held out")],
        [(1, "long text " * 3000)],
    ],
)
def test_scores_match_plain(spark, rows):
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, share int, kind int")
    same_scores(ppm.scores(df), rows)


def test_scores_of_documents_in_many_shares(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    same_scores(ppm.scores(df, share=20_000), [tuple(r) for r in df.collect()])


def test_scores_of_nothing(spark):
    assert ppm.scores(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def same_scores(df, rows):
    got, want = (sorted(map(tuple, x), key=str) for x in (df.collect(), plain.ppm(rows)))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-6)


def test_probabilities_add_up_to_one(monkeypatch):
    """Over all symbols after one context, seen or not."""
    keys, _ = ppm.symbols([b"abracadabra", b"abcabc", b"bar"])
    gram, counts = np.unique(keys, return_counts=True)
    pairs = np.bincount(keys % ppm.SIGNS**2, minlength=ppm.SIGNS**2).reshape(ppm.SIGNS, ppm.SIGNS)
    contexts = [gram[0] // ppm.SIGNS, gram[3] // ppm.SIGNS]
    for context in contexts:
        every = np.unique(np.concatenate([gram, context * ppm.SIGNS + np.arange(ppm.SIGNS)]))
        number = np.zeros(len(every), np.int64)
        number[np.searchsorted(every, gram)] = counts
        logs = ppm.log_probabilities(every, number, pairs)
        assert abs((10 ** logs[every // ppm.SIGNS == context]).sum() - 1) < 1e-9


# --- archives

BIG = "x\r\n\r\ny日本" * 200
PAGES = [(1, "http://a", BIG), (2, "http://a", BIG), (None, None, BIG), (3, "u\r\nv", None), (4, "u", ""), (5, "u", "small"), (6, "u", "small"), (2, "http://a", BIG), (7, "u", "z" * 17_000_000)]
KIND = "page_id long, url string, html string"


def test_archives_read_back(spark):
    df = spark.createDataFrame([(*r, "q") for r in PAGES], KIND + ", same string")
    found = sorted([tuple(r) for r in warc.archived(df).collect()], key=str)
    want = []
    for page, _, html in PAGES:
        raw = (html or "").encode()
        revisit = html == BIG and page != 2
        want.append((page, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", 2 if revisit else None, True))
    assert found == sorted(want, key=str)
    assert warc.archived(df.limit(0)).count() == 0


def test_every_record_is_a_member_at_its_place(spark):
    source, target = folder(spark), folder(spark)
    df = spark.createDataFrame(PAGES, KIND).coalesce(2)
    warc.write_streams(warc.with_origin(df), source)
    warc.normalise(spark, source, target)
    index = [tuple(r) for r in warc.read_index(spark, target).collect()]
    assert len(index) == len(PAGES)
    joined = []
    for name, offset, length in index:
        (path,) = glob.glob(f"{target.removeprefix('file:')}/kind=archive/archive={name}/*.txt")
        raw = open(path, "rb").read()
        record = gzip.decompress(raw[offset : offset + length])
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
        joined.append((name, offset, record))
    for name in {n for n, _, _ in joined}:
        (path,) = glob.glob(f"{target.removeprefix('file:')}/kind=archive/archive={name}/*.txt")
        assert gzip.open(path).read() == b"".join(r for n, _, r in sorted(joined) if n == name)
    assert sum(r.count(BIG.encode()) for _, _, r in joined) == 2  # copies are not stored again, but for the repeated row


def test_streams_in_several_members_and_small_pieces():
    records = [b"WARC/1.1\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(b), b) for b in (b"", b"ab\r\n\r\nc" * 900, b"x")]
    stream = gzip.compress(b"".join(records[:1])) + gzip.compress(b"".join(records[1:]))
    assert list(warc.records(stream)) == records
    assert b"".join(warc.inflated(stream, 5)) == b"".join(records)
