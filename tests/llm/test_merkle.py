import pytest

from pricewright.llm import merkle
from tests.llm import plain

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def rows_of(sizes):
    out, k = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            out.append((k, source, None if k % 7 == 0 else "en", k, f"Text {k} Über" if k % 3 else None))
            k += 1
    return out


CASES = [
    rows_of({"a": 1}),
    rows_of({"a": 16}),
    rows_of({"a": 17, "b": 1}),
    rows_of({None: 3, "": 2, "é": 257, "z": 300, "Z": 5}),
    rows_of({f"s{k}": 1 + k % 3 for k in range(40)}),
    [(None, None, None, None, None)] * 3 + [(5, "a", "x", 1, "Q"), (5, "a", "x", 1, "Q"), (5, "a", "x", 1, "q"), (None, "a", "x", 0, "")] * 9,
    [(5, "a", "x", 1, "Long " * 200_000), (10, "a", "x", 1, "")],
]


@pytest.mark.parametrize("rows", CASES)
def test_matches_plain(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got = [tuple(r) for r in merkle.proofs(df).collect()]
    assert sorted(got, key=str) == sorted(plain.merkle(rows), key=str)


def test_a_changed_row_is_found_and_others_verify(spark):
    rows = rows_of({"a": 100, "b": 30})
    found = {r.doc_id: r.verified for r in merkle.proofs(spark.createDataFrame(rows, SCHEMA)).collect()}
    changed = {r[0] for r in rows if plain.fold(r[0], 5) == 0 and r[4] is not None}
    assert changed and {d for d, ok in found.items() if not ok} == changed


def test_path_holds_the_siblings(spark):
    rows = rows_of({"a": 18, "b": 1})
    found = {r.doc_id: r for r in merkle.manifest(spark.createDataFrame(rows, SCHEMA)).collect()}
    leaves = [found[k].leaf for k in range(18)]
    first, second, _ = found[2].path
    assert (first.before, first.after) == ("".join(leaves[:2]), "".join(leaves[3:16]))
    assert (second.before, second.after) == ("", plain.digest(leaves[16], leaves[17]))
    assert [tuple(s) for s in found[18].path] == [(found[0].subroot, "")]


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a", "en", 3, "abc", 9, 9, "r")], f"{SCHEMA}, tree long, n long, run string")
    assert merkle.proofs(df.limit(0)).count() == 0
    assert merkle.proofs(df).count() == 1
