import pytest

from pricewright.llm import fingerprint
from tests.llm import plain

CASES = [
    [(1, "abc")],
    [(None, None), (None, "x"), (3, "hello world"), (3, "hello world"), (3, "hello"), (9, ""), (12, "日本語テスト" * 10)],
    [(k, f"t{k}" * k) for k in range(50)],
    [(1, "long " * 200_000), (2, "long " * 200_001), (3, None)],
]


@pytest.mark.parametrize("rows", CASES)
def test_matches_plain(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = fingerprint.fingerprints(df).collect()
    got = [(r.doc_id, r.n_chars, r.edited_sha256, r.edited_from, r.common_next) for r in found]
    assert sorted(got, key=str) == sorted(plain.fingerprints(rows), key=str)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)


def test_equal_texts_have_equal_fingerprints_and_others_do_not(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    by_print = {}
    for r in fingerprint.fingerprints(docs).collect():
        by_print.setdefault(r.fingerprint, set()).add(texts[r.doc_id])
    assert all(len(t) == 1 for t in by_print.values())
    assert len(by_print) == len(set(texts.values()))


def test_likeness_follows_the_shared_spans():
    text = " ".join(f"word{k * k}" for k in range(400))
    near, far = text[: len(text) * 9 // 10], " ".join(f"other{k * 7}" for k in range(400))
    sketch = fingerprint.Prefixes([text, text, near, far]).sketches()
    same, close, apart = fingerprint.likeness(sketch[[0, 0, 0]], sketch[1:])
    assert same == 1.0 and 0.75 < close < 1.0 and apart < 0.1


def test_span_hashes_are_equal_wherever_the_span_lies():
    p = fingerprint.Prefixes(["xxabcabc", "abc"])
    assert p.spans(2, 3) == p.spans(5, 3) == p.spans(8, 3) != p.spans(3, 3)


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a b", 5, "q")], "doc_id long, text string, r int, tail string")
    assert fingerprint.fingerprints(df.limit(0)).count() == 0
    assert fingerprint.fingerprints(df).first().n_chars == 3
