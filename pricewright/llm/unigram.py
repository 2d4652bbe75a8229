"""Token counts under a unigram vocabulary, without making the tokens.

An Aho-Corasick automaton yields every vocabulary piece that ends at a character. A dynamic program over the
characters carries the best score and the number of pieces of its path. Of equal scores the piece that begins
first wins, as in the tokenizer's own search; a character without a piece costs ten below the lowest score and
counts one token per byte. No piece has white space behind another character, so a text falls into words that
are scored apart, each different one once. Scores are sums in double precision, exact for whole numbers.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewright.llm.common import one, gathered, whole

MARK = "▁"  # stands for a blank
PENALTY = 10.0
WORDS = 500_000  # different words kept by a worker; beyond that they are scored anew
CHUNK = 4_000_000


class Vocabulary:
    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        skip = (model.is_byte, model.is_control, model.is_unknown, model.is_unused)
        pieces = {model.id_to_piece(i): model.get_score(i) for i in range(model.get_piece_size()) if not any(f(i) for f in skip)}
        self.unknown = min(pieces.values()) - PENALTY
        self.found = ahocorasick.Automaton()
        for piece, score in pieces.items():
            self.found.add_word(piece, (len(piece), score))
        self.found.make_automaton()
        absent = "".join(c for c in "\n\t\r\v\f" if not any(c in p for p in pieces))
        joined = any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces)
        words = f"{MARK}*[^{MARK}{absent}]+|{MARK}+"
        self.words = re.compile("(?s:.+)" if joined else words + (f"|[{absent}]" if absent else ""))
        self.index: dict[str, int] = {}
        self.counts, self.scores = np.zeros(0, np.int64), np.zeros(0)

    def best(self, word: str) -> tuple[int, float]:
        """Number of pieces of the best path, and its score."""
        n = len(word)
        score, count = [0.0] * (n + 1), [0] * (n + 1)
        done = 0  # characters whose best path is known
        single = False
        top, pieces = None, 0

        def close() -> None:
            nonlocal done, single, top, pieces
            if not single:  # the character at done has no piece of its own
                lone = score[done] + self.unknown
                if top is None or lone > top:
                    top, pieces = lone, count[done] + len(word[done].encode())
            done += 1
            score[done], count[done] = top, pieces
            single, top, pieces = False, None, 0

        for end, (size, value) in self.found.iter(word):  # at one end the longest first
            while done < end:
                close()
            start = end + 1 - size
            single |= size == 1
            if top is None or score[start] + value > top:
                top, pieces = score[start] + value, count[start] + 1
        while done < n:
            close()
        return count[n], score[n]

    def totals(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens and score of each text."""
        split = [self.words.findall((MARK + t).replace(" ", MARK)) if t else [] for t in texts]
        different = set().union(*split) if split else set()
        if len(self.index) + len(different) > WORDS:
            self.index, self.counts, self.scores = {}, np.zeros(0, np.int64), np.zeros(0)
        new = sorted(different.difference(self.index))
        made = [self.best(w) for w in new]
        self.index.update(zip(new, range(len(self.index), len(self.index) + len(new)), strict=True))
        self.counts = np.append(self.counts, np.array([c for c, _ in made], np.int64))
        self.scores = np.append(self.scores, np.array([s for _, s in made]))
        sizes = np.array([len(s) for s in split], np.int64)
        at = np.fromiter((self.index[w] for s in split for w in s), np.int64, int(sizes.sum()))
        row = np.repeat(np.arange(len(texts)), sizes)
        counts = np.bincount(row, self.counts[at], len(texts)).astype(np.int64)
        return counts, np.bincount(row, self.scores[at], len(texts)).astype(float)


@cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_chars, n_tokens, score: one row for each row of docs.

    Null and empty texts have no tokens and score 0. Any length works; repeated rows give repeated rows, an
    empty table none. No exchange.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = vocabulary(path)
        for table in gathered(batches, "text", CHUNK):
            texts = one(table.column("text")).to_pylist()
            counts, scores = model.totals(texts)
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([one(table.column("doc_id")), sizes, pa.array(counts), pa.array(scores)], ["doc_id", "n_chars", "n_tokens", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole())
    return rows.mapInArrow(run, "doc_id long, n_chars long, n_tokens long, score double")
