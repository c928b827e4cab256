"""WARC archives as a table of chunks.

A record is rows (record_id, chunk_no, chunk): no step holds more of a payload than one chunk besides the input value
itself. Digests travel along the chunk rows. Oversized payloads are written as the format's own segmented records (a
first segment and ``continuation`` records), so an archive is one record per chunk row, and it is read back the same way.

Null and empty payloads are records of no bytes with one empty chunk; a null url is written as ``urn:x-none``; rows that
repeat an id are records of their own; columns other than those named are ignored; an empty table gives empty archives.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirgauge.llm.common import lookup, shared_path, stored

#: Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

CHUNK_BYTES = 256 << 10
#: Ends a record and begins the next. No block holds the version text, so this occurs between records only.
BREAK = f"\r\n\r\n{VERSION}\r\n"
#: Zero-width places inside every occurrence of the version text.
_INSIDE_VERSION = r"(?<=WA)(?=RC/1\.1)"

_STREAM = "record_id long, page_id long, url string, chunk_no int, last boolean, chunk binary"
_DIGESTED = _STREAM + ", bytes_so_far long, sha1 binary, sha256 binary"


def chunk_table(pages: DataFrame, payload: str = "html", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per chunk: record_id, page_id, url, chunk_no, last, chunk; chunks of a record follow one another.

    A payload is cut every ``chunk_bytes``, and also inside every occurrence of the version text that begins a record.
    """
    text = F.coalesce(F.col(payload), F.lit(""))
    parts = pages.select(
        F.monotonically_increasing_id().alias("record_id"),
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        F.when(F.instr(text, VERSION) > 0, F.split(text, _INSIDE_VERSION)).otherwise(F.array(text)).alias("_parts"),
    )
    parts = parts.select("record_id", "page_id", "url", F.size("_parts").alias("_n"), F.posexplode("_parts").alias("_part", "_text"))
    parts = parts.withColumn("_bytes", F.encode("_text", "UTF-8"))
    count = F.greatest(F.lit(1), F.ceil(F.octet_length("_bytes") / F.lit(chunk_bytes)).cast("int"))
    cut = parts.select("*", F.explode(F.sequence(F.lit(0), count - 1)).alias("_cut"), count.alias("_cuts"))
    return cut.select(
        "record_id",
        "page_id",
        "url",
        # a later part starts a new run of numbers; only their order matters
        (F.col("_part").cast("long") * (1 << 32) + F.col("_cut")).alias("chunk_no"),
        ((F.col("_part") == F.col("_n") - 1) & (F.col("_cut") == F.col("_cuts") - 1)).alias("last"),
        F.substring("_bytes", F.col("_cut") * F.lit(chunk_bytes) + 1, F.lit(chunk_bytes)).alias("chunk"),
    )


def _carry_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to each chunk row the digests of its record up to there; the state is one hash object, however long the record."""
    record, sha1, sha256, size, number = None, None, None, 0, 0
    for batch in batches:
        ids = batch.column("record_id").to_pylist()
        sizes, ones, strong, numbers = [], [], [], []
        for record_id, chunk in zip(ids, batch.column("chunk"), strict=True):
            if record_id != record:
                record, sha1, sha256, size, number = record_id, hashlib.sha1(), hashlib.sha256(), 0, 0
            data = chunk.as_buffer()
            if data is not None:
                sha1.update(data)
                sha256.update(data)
                size += data.size
            sizes.append(size)
            ones.append(sha1.digest())
            strong.append(sha256.digest())
            numbers.append(number)
            number += 1
        out = {name: batch.column(name) for name in ("record_id", "page_id", "url", "last", "chunk")}
        out |= {"chunk_no": pa.array(numbers, pa.int32()), "bytes_so_far": pa.array(sizes, pa.int64()), "sha1": pa.array(ones, pa.binary()), "sha256": pa.array(strong, pa.binary())}
        yield pa.RecordBatch.from_pydict({name: out[name] for name in (x.strip().split()[0] for x in _DIGESTED.split(","))})


def digested(chunks: DataFrame) -> DataFrame:
    """The chunk rows, numbered from 0, with running byte count, SHA-1 and SHA-256. Needs a record's rows in a row."""
    return chunks.mapInArrow(_carry_digests, _DIGESTED)


def base32(digest: Column) -> Column:
    """Upper-case base32 of a binary digest of a multiple of five bytes, by built-in functions."""
    hexed = F.lower(F.hex(digest))

    def five(i: Column) -> Column:
        number = F.conv(F.substr(hexed, i * 5 + 1, F.lit(5)), 16, 10).cast("int")
        return F.concat(*(F.substr(F.lit(BASE32), F.shiftright(number, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)))

    return F.array_join(F.transform(F.sequence(F.lit(0), (F.length(hexed) / 5).cast("int") - 1), five), "")


def record_uri(record_id: Column) -> Column:
    return F.concat(F.lit("urn:x-record:"), record_id.cast("string"))


def plan_records(chunks: DataFrame, revisit_from: int = 0) -> DataFrame:
    """One row per record: record_id, page_id, url, payload_bytes, sha1, record_type, refers_to.

    Of the records with equal payloads of at least ``revisit_from`` bytes, that with the smallest page_id (then
    record_id, null page_ids last) is the response. Equal means equal length, SHA-1 and SHA-256.
    """
    whole = chunks.where("last").select("record_id", "page_id", "url", F.col("bytes_so_far").alias("payload_bytes"), "sha1", "sha256")
    first = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "record_id")
    groups = whole.where(F.col("payload_bytes") >= revisit_from).groupBy("sha256", "payload_bytes").agg(F.min(first).alias("head"), F.count("*").alias("size"))
    found = lookup(whole, groups.where("size > 1"), ["sha256", "payload_bytes"], "size", ["record_id"])
    revisit = F.col("head").isNotNull() & (F.col("head.record_id") != F.col("record_id"))
    return found.select(
        "record_id",
        "page_id",
        "url",
        "payload_bytes",
        "sha1",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("head.page_id")).alias("refers_to"),
        F.when(revisit, F.col("head.record_id")).alias("refers_to_record"),
    )


def _field(name: str, value: Column) -> Column:
    """A header line; absent where the value is null, and without control characters that would break the header."""
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), F.regexp_replace(value.cast("string"), r"[\x00-\x1F\x7F]", "%20"), F.lit("\r\n"))).otherwise("")


def archive_lines(chunks: DataFrame, records: DataFrame, date: str) -> DataFrame:
    """The text of each archive record, without the end of record; revisits keep their head only."""
    plan = records.select("record_id", "record_type", "refers_to", "refers_to_record", "payload_bytes", F.col("sha1").alias("payload_sha1"))
    rows = chunks.drop("sha1", "sha256").join(plan, "record_id").where("record_type = 'response' or chunk_no = 0")
    first, revisit = F.col("chunk_no") == 0, F.col("record_type") == "revisit"
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n"))
    http = F.when(first, http).otherwise("")
    body = F.when(revisit, F.lit("").cast("binary")).otherwise(F.col("chunk"))
    segmented = ~revisit & ~(first & F.col("last"))
    own = F.when(first, record_uri(F.col("record_id"))).otherwise(F.concat(record_uri(F.col("record_id")), F.lit(":"), (F.col("chunk_no") + 1).cast("string")))
    head = F.concat(
        F.lit(f"{VERSION}\r\n"),
        _field("WARC-Type", F.when(first, F.col("record_type")).otherwise("continuation")),
        _field("WARC-Record-ID", F.concat(F.lit("<"), own, F.lit(">"))),
        _field("WARC-Date", F.lit(date)),
        _field("WARC-Target-URI", F.when(first, F.coalesce("url", F.lit("urn:x-none")))),
        _field("WARC-Payload-Digest", F.when(first, F.concat(F.lit("sha1:"), base32(F.col("payload_sha1"))))),
        _field("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _field("WARC-Refers-To", F.when(revisit, F.concat(F.lit("<"), record_uri(F.col("refers_to_record")), F.lit(">")))),
        _field("WARC-Segment-Number", F.when(segmented, F.col("chunk_no") + 1)),
        _field("WARC-Segment-Origin-ID", F.when(~first, F.concat(F.lit("<"), record_uri(F.col("record_id")), F.lit(">")))),
        _field("WARC-Segment-Total-Length", F.when(segmented & F.col("last"), F.col("payload_bytes"))),
        # extension fields: the page's number, the response's, and the payload's length
        _field("X-Page-ID", F.when(first, F.col("page_id"))),
        _field("X-Refers-To-Page", F.col("refers_to")),
        _field("X-Payload-Length", F.when(first, F.col("payload_bytes"))),
        _field("Content-Type", F.when(first, F.lit("application/http; msgtype=response"))),
        _field("Content-Length", F.octet_length(http) + F.octet_length(body)),
        F.lit("\r\n"),
        http,
    )
    # the bytes of a chunk may end inside a character: the cast keeps them, and nothing below looks at characters
    return rows.select(F.concat(F.encode(head, "UTF-8"), body).cast("string").alias("value"))


def write_archives(chunks: DataFrame, records: DataFrame, path: str, date: str = "2000-01-01T00:00:00Z", compression: str = "gzip") -> None:
    """WARC files, one per task. Uncompressed ones (``none``) can be split by the reader."""
    archive_lines(chunks, records, date).write.option("lineSep", "\r\n\r\n").option("compression", compression).text(path)


def _header(name: str) -> Column:
    value = F.regexp_extract("head", rf"(?m)^{name}: (.*?)\r?$", 1)
    return F.when(value != "", value)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per archive record: warc_type, origin (record uri), segment, last, page_id, uri, digest, length, refers_to, block.

    ``damaged`` marks a record whose block is shorter than its header says.
    """
    raw = spark.read.option("lineSep", BREAK).text(path)
    end = F.instr("value", "\r\n\r\n")
    parts = raw.select(F.substring("value", F.lit(1), end + 1).alias("head"), end.alias("_end"), F.col("value").cast("binary").alias("_all"))
    parts = parts.where("_end > 0")
    length = _header("Content-Length").cast("int")
    fields = parts.select(
        _header("WARC-Type").alias("warc_type"),
        F.coalesce(_header("WARC-Segment-Origin-ID"), _header("WARC-Record-ID")).alias("origin"),
        F.coalesce(_header("WARC-Segment-Number").cast("int"), F.lit(1)).alias("segment"),
        (_header("WARC-Segment-Number").isNull() | _header("WARC-Segment-Total-Length").isNotNull()).alias("last"),
        _header("X-Page-ID").cast("long").alias("page_id"),
        _header("WARC-Target-URI").alias("uri"),
        F.regexp_replace(_header("WARC-Payload-Digest"), "^sha1:", "").alias("payload_digest"),
        _header("X-Payload-Length").cast("long").alias("payload_bytes"),
        _header("X-Refers-To-Page").cast("long").alias("refers_to"),
        length.alias("_length"),
        F.substring("_all", F.col("_end") + 4, length).alias("block"),
    )
    # the http head of a first segment is ascii and ends at the block's first empty line
    text = F.col("block").cast("string")
    body = F.when(F.col("warc_type") == "continuation", F.col("block")).otherwise(F.substring("block", F.instr(text, "\r\n\r\n") + 4, F.octet_length("block")))
    return fields.withColumn("damaged", F.octet_length("block") < F.col("_length")).withColumn("block", body).drop("_length")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """One row per archived page, digests recomputed from the blocks of responses: page_id, uri, payload_bytes,
    payload_digest, record_type, refers_to, intact (the recomputed digest and length are those of the header)."""
    records = read_archives(spark, path)
    heads = records.where("warc_type in ('response', 'revisit')")
    done = heads.where("last").select(
        "page_id",
        "uri",
        F.when(F.col("warc_type") == "response", F.octet_length("block").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(F.col("warc_type") == "response", base32(F.unhex(F.sha1("block")))).otherwise(F.col("payload_digest")).alias("digest"),
        F.col("warc_type").alias("record_type"),
        "refers_to",
        F.col("payload_digest").alias("stated"),
        "damaged",
    )
    # only the segments of oversized payloads travel: to one task per record, in order, one chunk at a time
    segments = records.where("not last or warc_type = 'continuation'")
    streamed = segments.repartition("origin").sortWithinPartitions("origin", "segment").select(
        F.col("origin").alias("record_id"), "page_id", F.col("uri").alias("url"), F.col("payload_digest").alias("stated"), "last", F.col("block").alias("chunk")
    )
    whole = streamed.mapInArrow(_join_segments, "page_id long, uri string, payload_bytes long, sha1 binary, stated string")
    long_ones = whole.select(
        "page_id", "uri", "payload_bytes", base32(F.col("sha1")).alias("digest"), F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to"), "stated", F.lit(False).alias("damaged")
    )
    both = done.unionByName(long_ones)
    return both.select("page_id", "uri", "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to", (~F.col("damaged") & (F.col("digest") == F.col("stated"))).alias("intact"))


def _join_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest and length of each record from its segments in order; the fields are those of the first segment."""
    schema = pa.schema([("page_id", pa.int64()), ("uri", pa.string()), ("payload_bytes", pa.int64()), ("sha1", pa.binary()), ("stated", pa.string())])
    current, head, sha1, size = None, None, None, 0
    for batch in batches:
        out = []
        fields = [batch.column(c).to_pylist() for c in ("record_id", "page_id", "url", "stated")]
        for (record, *first), chunk in zip(zip(*fields, strict=True), batch.column("chunk"), strict=True):
            if record != current:
                if current is not None:
                    out.append((*head[:2], size, sha1.digest(), head[2]))
                current, head, sha1, size = record, first, hashlib.sha1(), 0
            sha1.update(chunk.as_buffer())
            size += chunk.as_buffer().size
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, row, strict=True)) for row in out], schema)
    if current is not None:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, (*head[:2], size, sha1.digest(), head[2]), strict=True))], schema)


def archive(pages: DataFrame, path: str, payload: str = "html", chunk_bytes: int = CHUNK_BYTES, revisit_from: int = 0, compression: str = "gzip") -> DataFrame:
    """Writes the pages to WARC files under ``path`` and returns one row per record as planned (see plan_records)."""
    chunks = stored(digested(chunk_table(pages, payload, chunk_bytes)), "warc-chunks")
    records = plan_records(chunks, revisit_from)
    write_archives(chunks, records, path, compression=compression)
    return records


def archive_round_trip(pages: DataFrame, chunk_bytes: int = CHUNK_BYTES, compression: str = "gzip") -> DataFrame:
    """Writes the pages to archives in the shared folder and reads them back: see read_pages."""
    path = shared_path(pages.sparkSession, "warc")
    archive(pages, path, chunk_bytes=chunk_bytes, compression=compression)
    return read_pages(pages.sparkSession, path)


def expected_digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1, for tests."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()
