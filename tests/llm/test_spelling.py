import random

import pytest

from pricewright.llm import spelling
from tests.llm import plain


def found(spark, rows, more_than=100):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted((tuple(r) for r in spelling.variants(df, more_than).collect()), key=str)


def vocabulary(seed, stems, letters="abcdeé"):
    """Words around a few stems, one to three edits away, with repeats."""
    rng, out = random.Random(seed), []
    for _ in range(stems):
        stem = "".join(rng.choice(letters) for _ in range(rng.randrange(4, 11)))
        for _ in range(rng.randrange(1, 9)):
            word = list(stem)
            for _ in range(rng.randrange(3)):
                k = rng.randrange(len(word) + 1)
                word[k : k + rng.randrange(2)] = [rng.choice(letters)] * rng.randrange(2)
            out += ["".join(word)] * rng.randrange(1, 30)
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("more_than", [0, 3, 1000])
def test_matches_plain(spark, more_than):
    words = vocabulary(1, 80)
    rows = [(k, " ".join(words[k * 20 : k * 20 + 20]) + ", Straße ÀÉ x1y") for k in range(len(words) // 20)]
    rows += [(None, "Hello hello hello hellos hellos Hellos"), (None, None), (3, ""), (3, ""), (8, "1 2 ÷ 3")]
    assert found(spark, rows, more_than) == sorted(plain.spelling(rows), key=str)
    assert sum(r[1] is not None for r in plain.spelling(rows)) > 5


def test_ties_chains_and_long_words(spark):
    long = "ab" * 3000
    rows = [(None, " ".join(["kitten"] * 3 + ["mitten"] * 6 + ["bitten"] * 6 + ["bittene"] * 12 + ["bittenes"] * 24 + [long] * 3 + [long + "c"] * 7))]
    got = {r[0]: r for r in found(spark, rows)}
    assert sorted(got.values(), key=str) == sorted(plain.spelling(rows), key=str)
    assert got["kitten"][1] == "bitten" and got["kitten"][2] == "bittenes" and got[long][1] == long + "c"


def test_spoilt_words(spark):
    rows = [(k, "remember the colours of november") for k in range(400)]
    assert found(spark, rows) == sorted(plain.spelling(rows), key=str)


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "seven seven seven", 1, "w", "g")], "doc_id long, text string, n long, word string, gram string")
    assert spelling.variants(df.limit(0)).count() == 0
    assert [tuple(r) for r in spelling.variants(df).collect()] == [("seven", None, "seven", 3, 0, None)]


@pytest.mark.parametrize("seed", range(4))
def test_no_edit_affects_more_grams_than_the_bound(seed):
    """Of every word and every edit: the grams that survive are at least all less the bound, and one is always left."""
    rng = random.Random(seed)
    letters = "ab" if seed % 2 else "abcd"
    extended = set()
    for n in (2, 3):
        grams = ["".join(rng.choice(letters + "\x02\x03") for _ in range(n)) for _ in range(rng.randrange(1, 30))]
        extended |= {g for g in grams if n == 2 or g[:2] in extended}
    extended = frozenset(extended)
    tails = frozenset(g[k:] for g in extended for k in range(1, len(g)))

    def padded(word):
        return spelling.PAD[0] + word + spelling.PAD[1]

    for _ in range(150):
        word = "".join(rng.choice(letters) for _ in range(rng.randrange(5, 12)))
        s = padded(word)
        grams = spelling.cut(s, extended)
        bound = spelling.affected(s, grams, extended, tails)
        assert bound < len(grams)
        for k in range(len(word) + 1):
            for size, put in [(0, x) for x in letters] + ([(1, x) for x in letters] + [(1, "")] if k < len(word) else []):
                t = padded(word[:k] + put + word[k + size :])
                i, shift = k + 2, len(put) - size
                after = set(spelling.cut(t, extended))
                kept = sum((a, b) in after if b < i else (a >= i + size and (a + shift, b + shift) in after) for a, b in grams)
                assert kept >= len(grams) - bound
