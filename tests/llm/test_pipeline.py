import corpus_pipeline
from pricewright.llm import langid
from pricewright.llm.queries import BYTE_BPE, ORACLE, QUERIES
from tests.llm import plain
from tests.llm.test_tokens import check_packed
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.01"


def plain_stages(rows, language):
    """Rows after each stage but the last; language has what the first stage predicts."""
    rows = [r for r in rows if language[r[0]][0] != "und" and language[r[0]][1] >= 0.5]
    yield rows
    kept = {(k, s) for _, k, _, s in plain.equal([r[:2] for r in rows])}
    rows = [r for r in rows if (r[0], plain.sha(plain.low(r[1]))) in kept]
    yield rows
    least = {}
    for r, c in zip(rows, number := plain.classes([r[:2] for r in rows]), strict=True):
        least[c] = min(least.get(c, r[0]), r[0])
    rows = [r for r, c in zip(rows, number, strict=True) if r[0] == least[c]]
    yield rows
    out = []
    for r, (_, _, gone, left) in zip(rows, plain.cut([r[:2] for r in rows]), strict=True):
        if not gone:
            out.append(r)
        elif left:
            out.append((r[0], left, *r[2:4], len(left)))
    yield out


def test_stages_match_plain(spark):
    docs = corpus_pipeline.documents(spark, SF)
    language = {r.doc_id: (r.lang_pred, r.score) for r in langid.languages(docs).collect()}
    want = plain_stages([tuple(r) for r in docs.collect()], language)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = corpus_pipeline.stored(stage(spark, docs, SF))
        assert docs.columns == columns
        rows = [tuple(r) for r in docs.collect()]
        assert sorted(rows) == sorted(next(want))
    found = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    check_packed([r[:2] for r in rows], found, 1024)


def test_stages_take_odd_rows(spark):
    rows = [(1, "the of and to in", "en", "s", 1), (1, "the of and to in", "en", "s", 1), (None, "the of in", None, None, None), (2, None, None, None, None), (3, "", "en", "s", 0), (4, "12", "en", "s", 2)]
    kind = "doc_id long, text string, lang string, source string, n_chars long, node int, spans string, id int, mark string"
    docs = spark.createDataFrame([(*r, 1, "x", 2, "y") for r in rows], kind)
    for table in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            table = stage(spark, table, SF)
            assert table.columns == docs.columns
        packed = corpus_pipeline.STAGES[-1][1](spark, table, SF)
        assert packed.columns[0] == "doc_id"
        found = packed.collect()
    assert found == []


def test_queries_with_sql(spark):
    con = connect("/root/testdata/sf0.001")
    for name, sql in ORACLE.items():
        assert compare(spark, con, QUERIES[name], sql, "/root/testdata/sf0.001") is None


def test_all_are_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}
    assert BYTE_BPE
