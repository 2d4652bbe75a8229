import numpy as np
import pyarrow as pa
import pytest

from pricewright.llm import exact, fmindex, neardup, substring
from pricewright.llm.fmindex import FMIndex
from tests.llm import plain

MIXED = [(1, "A"), (2, "a"), (2, "a"), (None, None), (None, None), (3, ""), (4, "b"), (5, "é"), (6, "É"), (7, "long " * 100_000), (8, "LONG " * 100_000)]


@pytest.mark.parametrize("bits, rows_per_part", [(exact.BITS, exact.ROWS), (2, 3)])
def test_exact_groups(spark, bits, rows_per_part):
    df = spark.createDataFrame(MIXED, "doc_id long, text string").repartition(3)
    found = exact.groups(df, bits, rows_per_part).collect()
    got = [(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found]
    assert sorted(got, key=str) == sorted(plain.equal(MIXED), key=str)
    kept = [(r.keep_id, r.text_sha256) for r in found if r.kept]
    assert len(kept) == len(set(kept)) == len({t for *_, t in got})
    assert all(r.doc_id == r.keep_id for r in found if r.kept)


def test_exact_false_suspects_change_nothing(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    a, b = exact.groups(docs), exact.groups(docs, bits=6, rows_per_part=20)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_exact_rows_stay_whole(spark):
    rows = [(1, "x", 1, "p"), (2, "X", 2, "q"), (2, "X", 2, "q"), (None, "y", 3, "r"), (None, "y", 3, "r")]
    df = spark.createDataFrame(rows, "doc_id long, text string, id int, mark string")
    assert sorted(map(tuple, exact.deduplicated(df).collect()), key=str) == sorted([(2, "X", 2, "q"), (None, "y", 3, "r")], key=str)
    assert exact.deduplicated(df.limit(0)).count() == 0


@pytest.mark.parametrize("n", [0, 1, 7, 5000])
def test_golomb_round_trip(n):
    values = np.unique(np.random.default_rng(n).integers(0, 1 << 48, n))
    assert (exact.ungolomb(exact.golomb(values)) == values).all()
    dense = np.arange(n)
    assert (exact.ungolomb(exact.golomb(dense)) == dense).all()
    assert n < 100 or len(exact.golomb(values)) < 5.5 * n


BASE = " ".join(f"w{k}" for k in range(100))
NEAR = [(k, BASE.replace(f"w{k * 3} ", f"x{k} ")) for k in range(1, 30)] + [
    (50, BASE), (51, BASE.upper()), (None, None), (60, ""), (61, " \n"), (70, "one two"), (71, "One two"), (72, "two one"),
    (80, "a a a a a a a a a a"), (81, "a a a a a a a a a a a"), (82, "a a a a a a a a"), (82, "a a a a a a a a"), (82, "other text"), (None, "zz"),
]


def near_classes(df):
    return sorted([(r.doc_id, r.class_id, r.class_size) for r in neardup.classes(df).collect()], key=str)


def test_near_classes(spark):
    df = spark.createDataFrame(NEAR, "doc_id long, text string").repartition(3)
    assert near_classes(df) == sorted(plain.near(NEAR), key=str)
    assert neardup.classes(df.limit(0)).count() == 0


def test_near_classes_of_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    assert near_classes(df) == sorted(plain.near([tuple(r) for r in df.collect()]), key=str)


def test_near_keeps_one_row_of_each_class(spark):
    df = spark.createDataFrame([(d, t, k, "s") for k, (d, t) in enumerate(NEAR)], "doc_id long, text string, node int, none string")
    kept = neardup.deduplicated(df).collect()
    number = plain.classes(NEAR)
    assert len(kept) == len(set(number))
    for r in kept:
        mates = [NEAR[k][0] for k, c in enumerate(number) if c == number[r.node]]
        assert r.doc_id == min((d for d in mates if d is not None), default=None)


def test_links_that_only_the_second_pass_can_find(spark):
    """A chain: neighbours are alike, ends are not, so no leader is alike to all."""
    parts = [f"v{k}" for k in range(200)]
    rows = []
    for k in range(12):
        parts = parts[:]
        parts[15 * k] = f"y{k}"
        parts[15 * k + 1] = f"z{k}"
        rows.append((k, " ".join(parts)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert near_classes(df) == sorted(plain.near(rows), key=str)


def test_components_of_paths_and_cycles(spark):
    edges = [(k + 1, k) for k in range(40)] + [(100, 101), (101, 102), (102, 100), (200, 201)]
    found = {r.node: r.root for r in neardup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys((100, 101, 102), 100), 200: 200, 201: 200}


def test_signatures_are_unbiased():
    rng = np.random.default_rng(3)
    a = {k: int(rng.integers(1, 9)) for k in range(30)}
    b = {k: max(1, n - k % 3) for k, n in a.items() if k % 4} | {100 + k: 2 for k in range(4)}
    true = sum(min(a.get(k, 0), b.get(k, 0)) for k in a | b) / sum(max(a.get(k, 0), b.get(k, 0)) for k in a | b)
    row, counts = np.repeat([0, 1], [len(a), len(b)]), np.array([*a.values(), *b.values()])
    shares = []
    for turn in range(60):
        hashes = np.array([(k * 1_000_003 + turn * 7919 + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1) for k in [*a, *b]], np.uint64)
        s = neardup.signatures(row, hashes, counts, 2)
        shares.append((s[0] == s[1]).mean())
    assert abs(np.mean(shares) - true) < 0.025


def test_fm_index_finds_the_least_owner():
    rng = np.random.default_rng(5)
    for _ in range(60):
        depth, texts = int(rng.integers(3, 9)), int(rng.integers(1, 12))
        sizes, owners = rng.integers(0, 30, texts), rng.integers(0, 50, texts)
        kinds = int(rng.integers(1, 5))
        words = rng.integers(1, kinds + 1, sizes.sum()).astype(np.uint64)
        index, starts, want = FMIndex(words, sizes, owners, depth), np.cumsum(sizes) - sizes, {}
        for s, n, o in zip(starts, sizes, owners, strict=True):
            for k in range(s, s + n - depth + 1):
                key = tuple(words[k : k + depth])
                want[key] = min(want.get(key, 99), o)
        others = rng.integers(0, 40, 6)
        for text, lengths in ((words, sizes), (rng.integers(1, kinds + 2, others.sum()).astype(np.uint64), others)):
            first = np.cumsum(lengths) - lengths
            place, owner = index.earliest(text, first, lengths)
            windows = {k: tuple(text[k : k + depth]) for s, n in zip(first, lengths, strict=True) for k in range(s, s + n - depth + 1)}
            assert dict(zip(place.tolist(), owner.tolist(), strict=True)) == {k: want[w] for k, w in windows.items() if w in want}


def passages():
    rng = np.random.default_rng(1)
    stock = [f"w{k}é" for k in range(200)]

    def some(n):
        return [stock[k] for k in rng.integers(0, 200, n)]

    shared, rows = [some(60), some(50), some(300)], []
    for d in range(80):
        w = some(int(rng.integers(0, 120)))
        for x in shared:
            if rng.random() < 0.4:
                w += x
            w += some(int(rng.integers(0, 5 if rng.random() < 0.5 else 80)))
        rows.append((int(rng.permutation(200)[0]), ("\n" if d % 3 else "  ").join(w)))
    text = " ".join(shared[2])
    return rows + [(None, text), (None, text), (500, None), (501, ""), (502, "a " * 300), (503, "a " * 200), (502, "a " * 300), (600, f"{text} {text}"), (7, "x " + text)]


@pytest.mark.parametrize("hot, shard", [(substring.HOT, substring.SHARD), (2, 700)])
def test_substring_removals(spark, hot, shard):
    rows = passages()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = [tuple(r) for r in substring.removals(df, hot, shard).collect()]
    assert sorted(got, key=str) == sorted([(d, n, k, plain.sha(t)) for d, n, k, t in plain.cut(rows)], key=str)
    assert substring.removals(df.limit(0)).count() == 0


def test_substring_removals_of_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    got = [tuple(r) for r in substring.removals(df).collect()]
    want = [(d, n, k, plain.sha(t)) for d, n, k, t in plain.cut([tuple(r) for r in df.collect()])]
    assert sorted(got) == sorted(want)


def test_cleaned_rows_keep_their_columns(spark):
    rows = passages()
    df = spark.createDataFrame([(d, t, len(t or ""), 1, "z") for d, t in rows], "doc_id long, text string, n_chars long, spans int, mark string")
    cleaned = substring.cleaned(df)
    assert cleaned.columns == df.columns
    want = []
    for (d, t), (_, _, gone, left) in zip(rows, plain.cut(rows), strict=True):
        if not gone:
            want.append((d, t, len(t or "")))
        elif left:
            want.append((d, left, len(left)))
    assert sorted([tuple(r)[:3] for r in cleaned.collect()], key=str) == sorted(want, key=str)


def test_wavelets_take_four_bits_a_level():
    rng = np.random.default_rng(2)
    for n, symbols in ((0, 1), (1, 1), (300, 2), (1000, 17), (3000, 5000)):
        values = rng.integers(0, symbols, n)
        waves, at, symbol = fmindex.Wavelets(values, symbols), rng.integers(0, n + 1, 200), rng.integers(0, symbols, 200)
        assert len(waves.levels) == max(1, -(-int(symbols - 1).bit_length() // 4))
        assert waves.rank(symbol, at).tolist() == [int((values[:i] == c).sum()) for c, i in zip(symbol, at, strict=True)]


def test_a_key_is_looked_up_once_for_windows_in_a_row(monkeypatch):
    asked, real = [], np.isin
    monkeypatch.setattr(substring.np, "isin", lambda a, b: asked.append(len(a)) or real(a, b))
    key, row = np.repeat(np.array([5, 6, 6, 9], np.uint64), 100), np.repeat([0, 0, 1, 1], 100)
    lists = pa.array([[5, 9], [6]], pa.list_(pa.int64()))
    assert substring._among(key, row, lists).tolist() == np.repeat([True, False, True, False], 100).tolist()
    assert asked == [4]
