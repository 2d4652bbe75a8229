"""The operators on the given tables: whole tables, whole texts, production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewright.llm import bpe, exact, fingerprint, langid, merkle, neardup, packing, ppm, simhash, spelling, substring, unigram, warc
from pricewright.llm.common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def query(build):
    QUERIES[build.__name__] = build
    return build


ORACLE["op5_exact_dedup"] = """
with d as (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as norm
           from documents)
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
       doc_id = max(doc_id) over same as kept, sha256(norm) as text_sha256
from d window same as (partition by norm)
"""


@query
def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir), BYTE_BPE).drop("ids")


@query
def op8_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), BYTE_BPE)


@query
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.groups(documents(spark, sf_dir)).drop("mark")


@query
def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(documents(spark, sf_dir))


ORACLE["op10_warc"] = """
with p as (select page_id, coalesce(html, '') as html from pages),
     q as (select *, strlen(html) as n, max(page_id) over (partition by html) as last from p)
select page_id, n as payload_bytes, sha1(html) as payload_digest,
       case when n >= 1000 and page_id is distinct from last and last is not null then 'revisit' else 'response' end as record_type,
       case when n >= 1000 and page_id is distinct from last then last end as refers_to
from q
"""


@query
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.archived(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    lost = F.raise_error(F.lit("the index lacks a record"))
    return found.withColumn("record_type", F.when(F.col("indexed"), F.col("record_type")).otherwise(lost)).drop("indexed")


@query
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unigram.token_counts(documents(spark, sf_dir), PIECES)


@query
def op9_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.scores(documents(spark, sf_dir))


@query
def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.languages(documents(spark, sf_dir))


@query
def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(documents(spark, sf_dir)).drop("mark")


@query
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.removals(documents(spark, sf_dir))


# A table with the crc32 step of each byte, and the unsigned crc32 of a text's UTF-8.
CRC_TABLE = """crc as (select list(c order by n) as t from (select n, list_reduce([n::UBIGINT] || list_transform(range(8), lambda x: x::UBIGINT),
    lambda c, i: case when c & 1 = 1 then xor(c >> 1, 3988292384::UBIGINT) else c >> 1 end) as c from range(256) r(n)))"""


def crc32_sql(text: str) -> str:
    bytes_ = f"""list_transform(string_split(rtrim(regexp_replace(hex(encode({text})), '(..)', '\\1,', 'g'), ','), ','), lambda h: ('0x' || h)::UBIGINT)"""
    step = "lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)::BIGINT])"
    return f"xor(list_reduce([4294967295::UBIGINT] || {bytes_}, {step}), 4294967295::UBIGINT)"


def _merkle_sql(levels: int = 6) -> str:
    """Unrolled for trees of up to 16^levels leaves: nodes n0, n1, ... of the sources, m0, m1, ... above them."""
    def field(value):
        return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"

    head = " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars"))
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = [
        CRC_TABLE,
        f"""leafs as (select doc_id, source, sha256({head} || {field("text")}) as leaf,
            sha256({head} || {field(f"case when {crc32_sql('doc_id::VARCHAR')} % 5 = 0 then {lower} else text end")}) as shown from documents, crc)""",
        """g0 as (select doc_id, leaf, shown as f, '' as proof, dense_rank() over (order by source nulls first) - 1 as tree,
            row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as r, count(*) over (partition by source) as n from leafs)""",
        "n0 as (select tree, r, n, leaf as d from g0)",
    ]
    beside = "string_agg(d, '') over (partition by tree, r // 16 order by r rows between {})"
    for name in "nm":
        if name == "m":
            parts.append(f"m0 as (select 0 as tree, tree as r, count(*) over () as n, d from n{levels})")
        for k in range(levels):
            parts.append(f"""{name}{k + 1} as (select tree, r // 16 as r, n, case when n > {16**k} then sha256(string_agg(d, '' order by r)) else any_value(d) end as d
                from {name}{k} group by tree, r // 16, n)""")
            parts.append(f"""s{name}{k} as (select tree, r, n > {16**k} as more, coalesce({beside.format("unbounded preceding and 1 preceding")}, '') as a,
                coalesce({beside.format("1 following and unbounded following")}, '') as b from {name}{k})""")
    step = """select g.* replace (case when more then sha256(a || f || b) else f end as f, case when more then proof || a || b else proof end as proof,
        g.r // 16 as r) from {} g join {} s on g.tree = s.tree and g.r = s.r"""
    parts += [f"g{k + 1} as ({step.format(f'g{k}', f'sn{k}')})" for k in range(levels)]
    parts.append(f"h0 as (select g.* replace (0 as tree, tree as r), d as subroot from g{levels} g join n{levels} using (tree))")
    parts += [f"h{k + 1} as ({step.format(f'h{k}', f'sm{k}')})" for k in range(levels)]
    return f"""with {", ".join(parts)}
        select doc_id, leaf, subroot, d as root, sha256(proof) as proof_sha256, f as folded_root, f = d as verified from h{levels}, m{levels}"""


ORACLE["op12_merkle"] = _merkle_sql()


@query
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.proofs(documents(spark, sf_dir))


@query
def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near(documents(spark, sf_dir)).drop("print")


ORACLE["op13_spelling"] = f"""
with recursive {CRC_TABLE},
runs as (select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\u00C0-\u00FF]+')) as run
         from documents where text is not null),
each as (select doc_id, run, count(*) as c from runs group by all),
marked as (select run, c, {crc32_sql("coalesce(doc_id::VARCHAR, '') || ':' || run")} as h from each, crc),
spoilt as (select case when h % 97 = 0 then substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) else run end as word, c from marked),
words as (select word, sum(c)::BIGINT as n from spoilt where length(word) >= 5 group by word having sum(c) >= 3),
cuts as (select word, place, substr(word, 1, place - 1) || substr(word, place + 1) as rest
         from (select word, unnest(range(1, length(word) + 1)) as place from words)),
pairs as (select a.word, b.word as other from cuts a join cuts b using (place, rest) where a.word <> b.word
          union select word, rest from cuts where rest in (select word from words)
          union select rest, word from cuts where rest in (select word from words)),
found as (select word, count(*) as n_near, arg_min(other, (-o.n, other)) as best, max(o.n) as best_n
          from pairs join (select word as other, n from words) o using (other) group by word),
forms as (select word, n, coalesce(n_near, 0) as n_near, case when best_n >= 2 * n then best end as form,
          case when best_n >= 2 * n then best_n end as form_n from words left join found using (word)),
way as (select word, word as at, form as next from forms
        union all select way.word, forms.word, forms.form from way join forms on forms.word = way.next)
select word, form, way.at as root, n, n_near, form_n from forms join way using (word) where way.next is null
"""


@query
def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(spark, sf_dir))
