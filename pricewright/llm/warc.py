"""WARC archives: written whole, then normalised to one gzip member per record with an offset index.

Spark's text writer makes the first archives: each file is one gzip stream over all its records. The normaliser
inflates such a stream once, from front to end, and rewrites every record as its own gzip member, so that a reader
can start at any record; the sidecar index names the archive, offset and length of each. Archives and index go
through Spark's writers, and therefore to any store that Spark can reach.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewright.llm.common import folder, stored

LEAST = 1000  # bytes of a payload that another record may refer to
RECORDS = 20_000  # in a file at most
# Fixed values of the archive format.
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
LINE, BLANK = "\r\n", "\r\n\r\n"


def with_origin(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """page_id, url, html, payload_bytes, digest, refers_to: whose payload a page repeats, else null."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("payload_bytes", F.octet_length("html").cast("long")).withColumn("same", F.sha2("html", 256))
    repeated = rows.where(F.col("payload_bytes") >= least).groupBy("same").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    # Stored, so that the join deals both sides anew and can split a payload that very many pages share.
    repeated = stored(repeated.where("n > 1").drop("n"))
    first = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    joined = rows.join(repeated, "same", "left").withColumn("refers_to", first)
    return joined.select("page_id", "url", "html", "payload_bytes", F.sha1("html").alias("digest"), "refers_to")


def record(origin: DataFrame) -> DataFrame:
    """One text column: the record without the blank lines that end it."""
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{LINE}Content-Type: text/html; charset=utf-8{LINE}Content-Length: "), F.col("payload_bytes"), F.lit(BLANK))
    revisit = F.col("refers_to").isNotNull()
    block = F.when(revisit, F.lit("")).otherwise(F.concat(http, "html"))
    named = F.md5(F.concat_ws("|", "page_id", "url", "digest"))
    parts = [F.substring(named, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]

    def field(name: str, value):
        return F.concat(F.lit(f"{name}: "), value)

    head = F.concat_ws(
        LINE,
        F.lit("WARC/1.1"),
        field("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        field("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))),
        field("WARC-Date", F.lit(DATE)),
        field("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]", "")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        F.when(revisit, field("WARC-Profile", F.lit(REVISIT))),
        field("X-Refers-To-Page", F.col("refers_to").cast("string")),
        field("X-Page-Id", F.col("page_id").cast("string")),
        field("X-Payload-Length", F.col("payload_bytes").cast("string")),
        F.when(~revisit, F.lit("Content-Type: application/http; msgtype=response")),
        field("Content-Length", F.octet_length(block).cast("string")),
    )
    return origin.select(F.concat(head, F.lit(BLANK), block).alias("value"))


def write_streams(origin: DataFrame, path: str) -> None:
    """Archives of which each is one gzip stream."""
    writer = record(origin).write.option("compression", "gzip").option("lineSep", BLANK)
    writer.option("maxRecordsPerFile", RECORDS).text(path)


def inflated(content: bytes, step: int = 1 << 18) -> Iterator[bytes]:
    """The content of gzip data of any number of members, piece by piece."""
    stream, at = zlib.decompressobj(31), 0
    while at < len(content):
        fed = content[at : at + step]
        yield stream.decompress(fed)
        at += len(fed) - len(stream.unused_data)
        if stream.eof:
            while at < len(content) and not content[at]:
                at += 1
            stream = zlib.decompressobj(31)


def records(content: bytes) -> Iterator[bytes]:
    """Every record of a whole-file stream, with the blank lines that end it; the stream is inflated once."""
    held, at = bytearray(), 0
    blank = BLANK.encode()
    need = -1
    for fed in inflated(content):
        held += fed
        while True:
            if need < 0:
                end = held.find(blank, at)
                if end < 0:
                    break
                need = end + 4 + int(fields(held[at:end])["content-length"]) + 4
            if len(held) < need:
                break
            yield bytes(held[at:need])
            at, need = need, -1
        if at:
            del held[:at]
            need, at = need - at if need >= 0 else -1, 0


def fields(head: bytes | bytearray) -> dict[str, str]:
    lines = head.decode("utf-8").split(LINE)[1:]
    return {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}


def member(raw: bytes, level: int = 6) -> bytes:
    """A gzip member that ends in a zero byte: it does below 16 MiB, and an empty member behind it always does."""
    made = zlib.compressobj(level, zlib.DEFLATED, 31)
    out = made.compress(raw) + made.flush()
    if out[-1]:
        made = zlib.compressobj(level, zlib.DEFLATED, 31)
        out += made.compress(b"") + made.flush()
    return out


def normalise(spark: SparkSession, source: str, target: str) -> None:
    """Rewrite the streams below source as members below target/kind=archive, with the index below target/kind=index.

    The writer ends every line of its file with one byte. That byte is zero here, the last byte of every member, so
    what it writes is the archive as it must be; the index has one JSON line for each record.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("archive").to_pylist(), batch.column("content"), strict=True):
                offset, out = 0, []
                for n, raw in enumerate(records(content.as_py())):
                    made = member(raw)
                    line = json.dumps({"offset": offset, "length": len(made)}).encode()
                    out += [("archive", name, n, made[:-1]), ("index", name, n, line)]
                    offset += len(made)
                    if len(out) >= 1000:
                        yield rows_of(out)
                        out = []
                if out:
                    yield rows_of(out)

    def rows_of(out: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.string(), pa.int64(), pa.binary())
        arrays = [pa.array(v, t) for v, t in zip(zip(*out, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, ["kind", "archive", "nth", "line"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source)
    files = files.select(F.regexp_extract("path", r"([^/]+?)(\.txt)?\.gz$", 1).alias("archive"), "content")
    lines = files.mapInArrow(run, "kind string, archive string, nth long, line binary")
    lines = lines.sortWithinPartitions("kind", "archive", "nth").select("kind", "archive", F.col("line").cast("string").alias("value"))
    lines.write.partitionBy("kind", "archive").option("lineSep", "\0").text(target)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """archive, offset, length of every record."""
    lines = spark.read.option("lineSep", "\0").schema("value string").text(f"{path}/kind=index")
    parsed = F.from_json("value", "offset long, length long")
    name = F.regexp_extract(F.input_file_name(), r"archive=([^/]+)/", 1)
    return lines.select(name.alias("archive"), parsed.alias("at")).select("archive", "at.offset", "at.length")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives: page_id, payload_bytes, payload_digest, record_type, refers_to, payload, archive, offset, length.

    Of a response, size and digest are those of the payload that was read; of a revisit, those it states.
    """

    def walk(content: bytes, step: int = 1 << 16) -> Iterator[tuple[int, int, bytes]]:
        at, held = 0, None
        while at < len(content):
            stream, parts, start = zlib.decompressobj(31), [], at
            while not stream.eof and at < len(content):
                fed = content[at : at + step]
                parts.append(stream.decompress(fed))
                at += len(fed) - len(stream.unused_data)
            if raw := b"".join(parts):
                if held:
                    yield held
                held = start, at, raw
            elif held:  # the empty member behind a large one
                held = held[0], at, held[2]
        if held:
            yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("archive").to_pylist(), batch.column("content"), strict=True):
                out, size = [], 0
                for start, end, raw in walk(content.as_py()):
                    head, _, rest = raw.partition(BLANK.encode())
                    f = fields(head)
                    block = rest[: int(f["content-length"])]
                    whole = f["warc-type"] == "response"
                    payload = block.partition(BLANK.encode())[2] if whole else None
                    digest = hashlib.sha1(payload).hexdigest() if whole else f["warc-payload-digest"].removeprefix("sha1:")
                    number = [int(f[k]) if k in f else None for k in ("x-page-id", "x-refers-to-page")]
                    out.append((number[0], len(payload) if whole else int(f["x-payload-length"]), digest, f["warc-type"], number[1], payload, name, start, end - start))
                    size += len(raw)
                    if size > 4_000_000:
                        yield rows_of(out)
                        out, size = [], 0
                if out:
                    yield rows_of(out)

    def rows_of(out: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.string(), pa.int64(), pa.int64())
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload", "archive", "offset", "length"]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out, strict=True), kinds, strict=True)], names)

    files = spark.read.format("binaryFile").load(f"{path}/kind=archive")
    files = files.select(F.regexp_extract("path", r"archive=([^/]+)/", 1).alias("archive"), "content")
    kind = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary, archive string, offset long, length long"
    return files.mapInArrow(run, kind)


def archived(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write pages to archives below path (a new folder by default), normalise them and read them back.

    page_id, payload_bytes, payload_digest, record_type, refers_to, and indexed: whether the sidecar index has the
    record at the place where it was found. Null html is an empty payload. Of equal payloads of LEAST bytes or
    more, the rows with the largest page_id are responses (all of them, if repeated), the others, those without a
    page_id too, revisit it. A null url is left out of the record. An empty table gives no rows.
    """
    spark = pages.sparkSession
    source, target = folder(spark), path or folder(spark)
    if pages.isEmpty():
        return spark.createDataFrame([], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, indexed boolean")
    write_streams(with_origin(pages), source)
    normalise(spark, source, target)
    found, index = read_archives(spark, target).drop("payload"), read_index(spark, target).withColumn("indexed", F.lit(True))
    checked = found.join(index, ["archive", "offset", "length"], "left")
    return checked.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", F.coalesce("indexed", F.lit(False)).alias("indexed"))
