"""Large CSV files with quoted line ends, read by many tasks.

A line end belongs to a cell when the quotes before it are odd in number. The quotes of every block of a file are counted
in one scan; their running parity, a row for each block, says whether a block begins inside a quoted cell. Every block
is then cut into records by itself. What a record leaves at the end of a block is put together with the beginnings of
the blocks that follow, a few rows for each block. Records are parsed one by one, with their place in the file.

Quotes must stand around cells and be doubled inside, as spreadsheets write them: a lone quote in a cell without
quotes shifts the parity, which shows as records of a wrong width and fails the read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pricewright.operators.ranked import reliable

MOST_BLOCKS = 200_000  # whose parities are sent to all tasks; more are joined by a shuffle
_LINES = "text string, part string, _path string, _file string, _block long, _row long"


def _lines(spark: SparkSession, path: str | list[str], settings: dict[str, str]) -> DataFrame:
    lines = spark.read.options(**settings).option("lineSep", "\n").text(path)
    place = F.col("_metadata")
    return lines.select(
        "value", place["file_path"].alias("_path"), place["file_name"].alias("_file"), place["file_block_start"].alias("_block")
    ).withColumn("_row", F.monotonically_increasing_id())


def block_parity(lines: DataFrame) -> DataFrame:
    """_path, _block, open: whether the quotes before the block are odd in number. A row for each block."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counted = lines.groupBy("_path", "_block").agg(F.sum(quotes).alias("quotes"))
    before = Window.partitionBy("_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    return counted.select("_path", "_block", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("open"))


def _marked(lines: DataFrame, parity: DataFrame) -> DataFrame:
    """The lines in file order with ``open``; a block that was not counted fails."""
    many = parity.count() > MOST_BLOCKS
    joined = lines.join(parity if many else F.broadcast(parity), ["_path", "_block"], "left")
    known = F.coalesce("open", F.raise_error(F.lit("the file was split another way than before")).cast("boolean"))
    joined = joined.withColumn("open", known)
    return joined.repartition("_path", "_block").sortWithinPartitions("_path", "_block", "_row") if many else joined


def cut(marked: DataFrame, whole: bool) -> DataFrame:
    """text, part and the place: the records that lie whole in a block (``whole``; part is null), or else what belongs
    to records of several blocks: the head of a block up to the end of such a record, and its unfinished tail."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = _Cutter(whole)
        for batch in batches:
            yield from state.add(pa.Table.from_batches([batch]))
        yield from state.close()

    return marked.mapInArrow(run, _LINES)


class _Cutter:
    """Cuts the lines of successive blocks."""

    def __init__(self, whole: bool):
        self.whole, self.block, self.held, self.odd, self.head = whole, None, [], 0, False

    def add(self, table: pa.Table) -> Iterator[pa.RecordBatch]:
        if not table.num_rows:
            return
        keys = pc.binary_join_element_wise(table.column("_path"), pc.cast(table.column("_block"), pa.string()), "|").combine_chunks()
        codes = pc.dictionary_encode(keys).indices.to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(codes)) + 1).tolist(), table.num_rows]
        for a, b in zip(edges, edges[1:], strict=False):
            part, key = table.slice(a, b - a).combine_chunks(), keys[a].as_py()
            if key != self.block:
                yield from self.close()
                self.block, self.odd = key, int(part.column("open")[0].as_py())
                self.head = bool(self.odd)
            yield from self._lines(part)

    def _lines(self, part: pa.Table) -> Iterator[pa.RecordBatch]:
        quotes = pc.fill_null(pc.count_substring(part.column("value"), '"'), 0).to_numpy()
        after = (self.odd + np.cumsum(quotes)) % 2
        ends = np.flatnonzero(after == 0)  # lines that end a record
        self.odd = int(after[-1])
        if not len(ends):
            self.held.append(part)
            return
        first = int(ends[0]) + 1
        self.held.append(part.slice(0, first))
        if self.head:
            if not self.whole:
                yield _record(self.held, "head")
        elif self.whole:
            yield _record(self.held, None)
        self.held, self.head = [], False
        last = int(ends[-1]) + 1
        if self.whole and last > first:
            starts = ends[:-1] + 1
            if len(starts) == last - first:  # every line is a record
                yield _place(part.slice(first, last - first), part.column("value").slice(first, last - first), None)
            else:
                values = part.column("value").slice(0, last).to_pylist()
                texts = ["\n".join(values[a : b + 1]) for a, b in zip(starts.tolist(), ends[1:].tolist(), strict=True)]
                yield _place(part.take(pa.array(starts)), pa.array(texts, pa.string()), None)
        if last < part.num_rows:
            self.held.append(part.slice(last))

    def close(self) -> Iterator[pa.RecordBatch]:
        if self.held and not self.whole:
            yield _record(self.held, "head" if self.head else "tail")
        self.held = []


def _record(lines: list[pa.Table], part: str | None) -> pa.RecordBatch:
    """One record of these lines, at the place of the first."""
    text = "\n".join(v for t in lines for v in t.column("value").to_pylist())
    return _place(lines[0].slice(0, 1), pa.array([text], pa.string()), part)


def _place(rows: pa.Table, text, part: str | None) -> pa.RecordBatch:
    columns = {"text": text, "part": pa.array([part] * rows.num_rows, pa.string())} | {c: rows.column(c) for c in ("_path", "_file", "_block", "_row")}
    return pa.table(columns).combine_chunks().to_batches()[0]


def joined(parts: DataFrame) -> DataFrame:
    """The records of several blocks: every tail with the heads that follow it, at the tail's place."""
    order = Window.partitionBy("_path").orderBy("_block", "_row")
    chained = parts.withColumn("chain", F.sum((F.col("part") == "tail").cast("int")).over(order))
    each = F.sort_array(F.collect_list(F.struct("_block", "_row", "text")))
    whole = chained.groupBy("_path", "_file", "chain").agg(each.alias("of"))
    return whole.select(
        F.array_join(F.col("of.text"), "\n").alias("text"), "_path", "_file", F.col("of")[0]["_block"].alias("_block"), F.col("of")[0]["_row"].alias("_row")
    )


def read_quoted(spark: SparkSession, path: str | list[str], schema: StructType, settings: dict[str, str], header: bool = True) -> DataFrame:
    """Rows of CSV files under a declared schema, with ``_file``, ``_block`` and ``_row``, which give the file order.

    Blank lines are no rows; a record of another width, or a cell of another kind, fails the read. An empty file gives
    no rows.
    """
    listing = {k: v for k, v in settings.items() if k in ("modifiedAfter", "modifiedBefore", "timeZone", "pathGlobFilter", "recursiveFileLookup")}
    parse = {k: v for k, v in settings.items() if k not in listing and k not in ("header", "multiLine", "columnPruning")}
    lines = _lines(spark, path, listing)
    marked = _marked(lines, reliable(block_parity(lines)))
    broken = joined(reliable(cut(marked, whole=False)))
    records = cut(marked, whole=True).select("text", "_path", "_file", "_block", "_row").unionByName(broken)
    records = records.where(F.trim(F.rtrim("text", F.lit("\r"))) != "")
    if header:
        first = records.where("_block = 0").groupBy("_path").agg(F.min("_row").alias("_first"))
        records = records.join(F.broadcast(reliable(first)), "_path", "left")
        records = records.where((F.col("_block") != 0) | (F.col("_row") != F.col("_first")))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    row = F.from_csv(F.rtrim("text", F.lit("\r")), kinds, parse).alias("row")
    return records.select(row, "_file", "_block", "_row").select("row.*", "_file", "_block", "_row")
