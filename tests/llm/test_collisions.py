"""Texts made to collide under polynomial hashes modulo 2^64, and hashes weakened until everything collides."""

import numpy as np
import pyarrow as pa
import pytest
import tokenizers

from pricewright.llm import bpe, common, neardup, substring
from pricewright.llm.queries import BYTE_BPE
from tests.llm import plain


def thue_morse(n: int) -> tuple[str, str]:
    text = "".join("ab"[k.bit_count() % 2] for k in range(n))
    return text, text.translate(str.maketrans("ab", "ba"))


def weak(data, starts, ends, seed=0):
    return (ends - starts).astype(np.uint64) % np.uint64(3)


TEXTS = [*thue_morse(1024), *thue_morse(4096), "a bc de fgh ijk", "x yz ab cde fgi", "", "ä ö", "one two three " * 30]


@pytest.mark.parametrize("weakened", [False, True])
def test_bpe_ids_are_the_librarys(monkeypatch, weakened):
    if weakened:
        monkeypatch.setattr(bpe, "span_hashes", weak)
    library = tokenizers.Tokenizer.from_file(BYTE_BPE)
    library.no_truncation()
    library.no_padding()
    found = bpe.encode(pa.array(TEXTS), bpe.merges(BYTE_BPE))
    got = [found.ids[a:b].tolist() for a, b in zip(found.offsets, found.offsets[1:], strict=False)]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in TEXTS]


@pytest.mark.parametrize("n", [1024, 4096])
def test_passages_that_differ_in_a_colliding_word_stay(spark, n):
    a, b = thue_morse(n)
    common_words = " ".join(f"w{k}" for k in range(49))
    rows = [(1, f"{common_words} {a}"), (2, f"{common_words} {b}"), (3, f"{common_words} {a}")]
    found = substring.removals(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.n_removed for r in found} == {1: 0, 2: 0, 3: 50}


@pytest.mark.parametrize("weakened", [False, True])
def test_an_index_compares_bytes(monkeypatch, weakened):
    if weakened:
        monkeypatch.setattr(substring, "span_hashes", weak)
    texts = [" ".join(f"{x}{k}" for k in range(10, 10 + substring.WINDOW)) for x in ("a", "b", "a")]
    shard = substring.Shard()
    for doc in (1, 2, 3):  # one batch each: names must agree between batches
        words = substring.Words(pa.array([texts[doc - 1]]), named=True)
        shard.add(words, words.before[:1], words.sizes, np.array([doc]), [doc])
    _, run, earlier, info = shard.search()
    assert [info[r] for r in run[earlier].tolist()] == [3]


@pytest.mark.parametrize("weakened", [False, True])
def test_multisets_are_compared_by_bytes(monkeypatch, weakened):
    if weakened:
        monkeypatch.setattr(neardup, "span_hashes", weak)
    bags = neardup._bag_list(pa.array(TEXTS))
    for i, a in enumerate(TEXTS):
        for j, b in enumerate(TEXTS):
            x, y = plain.bag(a), plain.bag(b)
            both = (x & y).total()
            want = both / ((x | y).total()) if x and y else float(not x and not y)
            assert neardup._similarity(bags[i], bags[j]) == pytest.approx(want)


def test_near_duplicates_keep_colliding_words_apart(spark):
    rows = [(k, " ".join(["same words here and there", word])) for k, word in enumerate([*thue_morse(1024), *thue_morse(4096)])]
    df = spark.createDataFrame([(d, t) for d, t in rows] + [(9, rows[0][1])], "doc_id long, text string")
    found = {r.doc_id: r.class_id for r in neardup.classes(df).collect()}
    assert found == {0: 0, 1: 1, 2: 2, 3: 3, 9: 0}


def test_equal_spans():
    rng = np.random.default_rng(4)
    data = rng.integers(97, 99, 4000).astype(np.uint8)
    a, b, sizes = rng.integers(0, 3900, 3000), rng.integers(0, 3900, 3000), rng.integers(0, 40, 3000)
    a[:500] = b[:500]
    flat = data.tobytes()
    want = [flat[x : x + n] == flat[y : y + n] for x, y, n in zip(a, b, sizes, strict=True)]
    assert common.equal_spans(data, a, b, sizes).tolist() == want
