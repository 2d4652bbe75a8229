import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from pricewright.llm import simhash
from pricewright.llm.queries import op11_simhash
from tests.llm import plain


def near(spark, rows):
    found = simhash.near(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    return sorted([(r.doc_id, r.fingerprint, r.component_id) for r in found], key=str)


@pytest.mark.parametrize(
    "rows",
    [
        [(1, "a b c d"), (2, "A  b\tc\nd"), (3, None), (4, ""), (None, " \t "), (5, "one"), (6, "one two")],
        [(None, "x y z"), (None, "x y z"), (7, "x y z"), (7, "x y z"), (8, "q" * 5000 + " r s")],
        [(1, "w " * 300_000), (2, "ÄÖ ü日本 x"), (3, "Äö ü日本 x")],
    ],
)
def test_matches_plain(spark, rows):
    assert near(spark, rows) == sorted(plain.hamming(rows), key=str)


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a b c", 4, 5)], "doc_id long, text string, print long, root long")
    assert simhash.near(df.limit(0)).count() == 0
    assert simhash.near(df).first().component_id == 1


def test_hashes_match_the_library():
    rng = random.Random(5)
    spans = [bytes(rng.randrange(256) for _ in range(n)) for n in [*range(140), 1023, 1024, 1025, 3000]]
    data = np.frombuffer(b"".join(spans), np.uint8)
    ends = np.cumsum([len(s) for s in spans])
    starts = ends - np.array([len(s) for s in spans])
    got = simhash.xxh64(data, starts, ends, 42)
    assert got.tolist() == [xxhash.xxh64_intdigest(s, 42) for s in spans]


def test_fingerprints_of_many_shingles():
    rng = random.Random(6)
    texts = [" ".join(rng.choice("abcdefgh") * rng.randrange(1, 9) for _ in range(n)) for n in (0, 1, 2, 3, 254, 257, 258, 700)]
    assert simhash.fingerprints(pa.array(texts)).tolist() == [plain.simhash(t) for t in texts]


def families(seed, groups):
    """Fingerprints in balls around centers, in chains of three bits, and alone."""
    rng, out = random.Random(seed), set()
    for n, flips in groups:
        center = rng.getrandbits(64)
        for _ in range(n):
            out.add(center ^ sum({1 << rng.randrange(64) for _ in range(rng.randrange(flips + 1))}))
    chain = rng.getrandbits(64)
    for k in range(20):
        out.add(chain)
        chain ^= 7 << 3 * k
    return sorted(out)


def connected(nodes, edges):
    parent = {x: x for x in nodes}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        parent[root(a)] = root(b)
    groups = {}
    for x in nodes:
        groups.setdefault(root(x), set()).add(x)
    return sorted(map(sorted, groups.values()))


@pytest.mark.parametrize("pairwise", [1024, 8])
def test_links_are_those_of_all_pairs(spark, monkeypatch, pairwise):
    """With 8 every larger bucket goes to the second level, where larger ones are probed with masks."""
    monkeypatch.setattr(simhash, "PAIRWISE", pairwise)
    nodes = families(1, [(300, 6), (80, 3), (50, 9), (200, 64), (5, 2)])
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in nodes], "print long")
    got = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.linked(df).where("a <> b").collect()]
    want = [(a, b) for a in nodes for b in nodes if a < b and (a ^ b).bit_count() <= 3]
    assert connected(nodes, got) == connected(nodes, want)
    assert len(want) > 500


def test_groups_that_span_batches_stay_whole(spark, monkeypatch):
    monkeypatch.setattr(simhash, "ROWS", 16)
    monkeypatch.setattr(simhash, "PAIRWISE", 10)
    nodes = families(2, [(150, 4), (30, 2)])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in nodes], "print long")
        got = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.linked(df).where("a <> b").collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = [(a, b) for a in nodes for b in nodes if a < b and (a ^ b).bit_count() <= 3]
    assert connected(nodes, got) == connected(nodes, want)


def test_two_that_differ_in_three_bits_share_a_variant(spark):
    pairs = [(5, 5 ^ 7), (1, 1 | 1 << 63 >> 1 | 3 << 30), (9, 9 ^ (1 << 31 | 1 << 32 | 1 << 62))]
    for a, b in pairs:
        rows = simhash.variants(spark.createDataFrame([(a,), (b,)], "print long"))
        assert rows.groupBy("key").agg(F.count_distinct("print").alias("n")).where("n = 2").count() >= 1


def test_query_matches_plain(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in op11_simhash(spark, sf).collect()]
    assert sorted(got) == sorted(plain.hamming(rows))


def test_large_buckets_are_probed_as_all_pairs(monkeypatch):
    nodes = families(3, [(250, 5), (60, 3)])
    prints = np.array(nodes, np.uint64)
    want = [(a, b) for a in nodes for b in nodes if a < b and (a ^ b).bit_count() <= 3]
    monkeypatch.setattr(simhash, "_probed", lambda *a: pytest.fail("not probed yet"))
    a, b = simhash.forest(prints, np.array([0]), np.array([len(prints)]))
    assert connected(nodes, zip(a.tolist(), b.tolist(), strict=True)) == connected(nodes, want)
    monkeypatch.undo()
    # Within 12 free bits, as a bucket of the second level is.
    few = np.array(sorted({int(x) & 0x111111111111 for x in nodes}), np.uint64)
    monkeypatch.setattr(simhash, "PAIRWISE", 8)
    a, b = simhash.forest(few, np.array([0]), np.array([len(few)]))
    want = [(x, y) for x in few.tolist() for y in few.tolist() if x < y and (x ^ y).bit_count() <= 3]
    assert connected(few.tolist(), zip(a.tolist(), b.tolist(), strict=True)) == connected(few.tolist(), want)
