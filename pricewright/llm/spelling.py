"""Spelling variants: words one edit apart, found by an index of variable-length grams.

Grams have two to four code points; a gram is lengthened only where it is frequent, so the dictionary consists of the
frequent grams that may be extended. A word, padded on both sides, is cut into the longest gram from every place,
without those that lie inside an earlier one. From the dictionary follows how many of a word's grams one edit can
affect at most, wherever it falls: those that it touches, those before it that might now be extended over it, and those
behind it that might now be swallowed. All others survive in the edited word, shifted by one place at most.

So two words one edit apart share a gram that is among the rarest of both: with ``affected`` grams affected at most, one
of the ``affected`` + 1 rarest survives. Only these short lists are merged, by gram, place and length; candidates
are verified by their edit distance. The padding is such that words of five code points keep a gram.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricewright.llm.common import lowered, pieces, stored, text_bytes, whole

RUN = re.compile("[A-Za-zÀ-ÿ]+")
SPOILT = 97  # a word of a document whose crc32 it divides loses a code point
LEAST, SEEN = 5, 3  # code points and occurrences of a word
SHORTEST, LONGEST = 2, 4  # code points of a gram
PAD = ("\x02" * 2, "\x03" * 2)
FREQUENT = 100  # words that hold a gram which is extended
CHUNK = 8_000_000  # bytes of text
HELD = 200_000  # different words or grams that a task counts before it sends them
LONG = 4_000_000  # code points; the words of longer texts are never all in memory


def spoilt(doc_id: int | None, word: str) -> str:
    """The word as its document has it in the counts. A null doc_id is written as nothing."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
    return word if h % SPOILT else word[: h % len(word)] + word[h % len(word) + 1 :]


def _sent(counts: Counter, name: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], [name, "n"])


def word_counts(docs: DataFrame) -> DataFrame:
    """word, n: words of at least LEAST code points that occur SEEN times or more in all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in pieces(batches, "text", CHUNK):
            data, offsets = text_bytes(batch.column("text"))
            flat, at = lowered(data).tobytes(), offsets.tolist()
            for doc, a, b in zip(batch.column("doc_id").to_pylist(), at, at[1:], strict=False):
                text = flat[a:b].decode()
                found = RUN.findall(text) if len(text) < LONG else (m[0] for m in RUN.finditer(text))
                head = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for word, n in Counter(found).items():
                    if len(word) < LEAST:
                        continue
                    if zlib.crc32(word.encode(), head) % SPOILT == 0:
                        word = spoilt(doc, word)
                        if len(word) < LEAST:
                            continue
                    counts[word] += n
                if len(counts) > HELD:
                    yield _sent(counts, "word")
                    counts = Counter()
        yield _sent(counts, "word")

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole())
    counted = rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= SEEN)


def frequent_grams(words: DataFrame, more_than: int = FREQUENT) -> frozenset[str]:
    """The grams that are extended. The alphabet has 92 letters, so there are at most 92^2 + 92^3 of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for word in batch.column("word").to_pylist():
                s = PAD[0] + word + PAD[1]
                counts.update({s[a : a + n] for n in range(SHORTEST, LONGEST) for a in range(len(s) - n + 1)})
                if len(counts) > HELD:
                    yield _sent(counts, "gram")
                    counts = Counter()
        yield _sent(counts, "gram")

    counted = words.select("word").mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return frozenset(r.gram for r in counted.where(F.col("n") > more_than).select("gram").collect())


def cut(s: str, extended: frozenset[str]) -> list[tuple[int, int]]:
    """Start and last place of the word's grams: the longest from every place, none inside an earlier one."""
    out, covered = [], -1
    for a in range(len(s) - SHORTEST + 1):
        end = a + SHORTEST
        while end < len(s) and end - a < LONGEST and s[a:end] in extended:
            end += 1
        if end - 1 > covered:
            covered = end - 1
            out.append((a, covered))
    return out


def affected(s: str, grams: list[tuple[int, int]], extended: frozenset[str], tails: frozenset[str]) -> int:
    """How many of the grams one edit can affect at most. tails: proper suffixes of the extended grams.

    change[i]: the code point at i is replaced or deleted; insert[i]: one is put in front of it.
    """
    change, insert = [0] * (len(s) + 1), [0] * (len(s) + 1)
    for a, b in grams:
        for i in range(a, b + 1):
            change[i] += 1
        for i in range(a + 1, b + 1):
            insert[i] += 1
        for i in range(b + 1, min(len(s), a + LONGEST - 1) + 1):  # a gram from here or before may now reach over i
            if any(s[start:i] in extended for start in range(max(0, i - LONGEST + 1), a + 1)):
                change[i] += 1
                insert[i] += 1
        for i in range(max(0, b - LONGEST + 1), a):  # a gram over i may now reach to b
            change[i] += s[i + 1 : b] in tails
        for i in range(max(0, b - LONGEST + 2), a + 1):
            insert[i] += s[i:b] in tails
    first, last = len(PAD[0]), len(s) - len(PAD[1])
    return max(*change[first:last], *insert[first : last + 1])


def gram_index(words: DataFrame, more_than: int = FREQUENT) -> DataFrame:
    """word, n, size, gram, place: the rarest grams of each word, one more than an edit can affect."""
    spark = words.sparkSession
    extended = spark.sparkContext.broadcast(frequent_grams(words, more_than))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = extended.value
        tails = frozenset(g[k:] for g in known for k in range(1, len(g)))
        for batch in batches:
            rows = []
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist(), strict=True):
                s = PAD[0] + word + PAD[1]
                grams = cut(s, known)
                most = affected(s, grams, known, tails) + 1
                rows += [(word, n, len(word), s[a : b + 1], a, most) for a, b in grams]
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["word", "n", "size", "gram", "place", "most"])

    each = stored(words.select("word", "n").mapInArrow(run, "word string, n long, size int, gram string, place int, most int"))
    lists = stored(each.groupBy("gram").agg(F.count(F.lit(1)).alias("entries")))
    order = Window.partitionBy("word").orderBy("entries", "gram", "place")
    ranked = each.join(lists, "gram").withColumn("nth", F.row_number().over(order))
    return ranked.where(F.col("nth") <= F.col("most")).select("word", "n", "size", "gram", "place")


def near_words(words: DataFrame, more_than: int = FREQUENT) -> DataFrame:
    """word, n, other, other_n: every two different words one edit apart, in both directions."""
    index = stored(gram_index(words, more_than))
    # A replaced code point moves no gram. Of two lengths, the longer word has the gram at the same or the next place.
    shifts = F.array(*[F.struct(F.lit(p).alias("place"), F.lit(s).alias("size")) for p, s in ((0, 0), (0, 1), (1, 1))])
    probe = index.withColumn("shift", F.explode(shifts)).select(
        F.col("word").alias("a"), F.col("n").alias("a_n"), F.col("size").alias("a_size"), "gram",
        (F.col("place") + F.col("shift.place")).alias("place"), (F.col("size") + F.col("shift.size")).alias("size"),
    )
    met = probe.join(index.select(F.col("word").alias("b"), F.col("n").alias("b_n"), "gram", "place", "size"), ["gram", "place", "size"])
    once = (F.col("a_size") < F.col("size")) | (F.col("a") < F.col("b"))
    pairs = met.where(once & (F.levenshtein("a", "b", 1) == 1)).select("a", "a_n", "b", "b_n").distinct()
    pairs = stored(pairs)
    both = pairs.unionAll(pairs.select("b", "b_n", "a", "a_n"))
    return both.toDF("word", "n", "other", "other_n")


def ends(forms: DataFrame) -> DataFrame:
    """word, root: the last word that the forms lead to. A form is at least twice as frequent as its word, so none leads
    back, and every round doubles the way that is followed."""
    now = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        further = now.select(F.col("word").alias("at"), F.col("root").alias("next"))
        longer = now.join(further, F.col("root") == F.col("at"), "left")
        longer = stored(longer.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        now = longer.select("word", "root")
        if longer.where("moved").isEmpty():
            return now


def variants(docs: DataFrame, more_than: int = FREQUENT) -> DataFrame:
    """word, form, root, n, n_near, form_n: one row for each word.

    Null and empty texts have no words. form is the most frequent near word, the least on ties, if it occurs at
    least twice as often; root is the word where the forms end. Repeated rows count as often as they occur. Words
    of any length and letters are compared whole; an empty table gives no rows.
    """
    words = stored(word_counts(docs))
    near = near_words(words, more_than)
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form"))).alias("best")
    found = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    rows = words.join(found, "word", "left")
    enough = -F.col("best.less") >= 2 * F.col("n")
    rows = stored(rows.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best.form")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n"),
    ))
    roots = ends(rows.where("form is not null"))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
