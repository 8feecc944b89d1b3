"""WARC archives: write, normalise a monolithic gzip stream, index, read back.

Pages become WARC records. Spark's text writer stores them as gzip files that are
one stream each, as crawlers leave them: nothing in such a file can be read
without inflating all that stands before it. The normaliser inflates a file once,
from front to back, and rewrites every record as a gzip member of its own. The
result is a valid .warc.gz file that opens at any record, and a sidecar table of
the members' offsets and lengths, taken from the written file.

Files are written by Spark's own writers, so any store that Spark reaches will do.
The text writer ends a row with a separator: for the monolithic files that is the
two line ends after a record. A normalised file is one row whose separator is the
zero byte that ends the length field of its last member.

A payload of ``MIN_SHARED`` bytes or more is stored once: the largest page_id of
equal payloads keeps it, the others become revisit records that name it. Equality
is that of SHA-1 digests and lengths.

Defined cases: a null html is an empty payload; a null or unprintable url is
escaped; a row without page_id is a response and nobody's target; rows that share
page_id and payload are written alike; an empty table gives an empty result; other
columns are not looked at.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from presswork.session import materialize, scratch_path

MIN_SHARED = 1000
# Payload bytes per archive, on average: one task holds an archive's gzip file, twice, at a time.
ARCHIVE_BYTES = 12 << 20
LEVEL = 4
LINE = "\r\n"
BOUNDARY = b"\r\n\r\n"
EMPTY_MEMBER_TAIL = 1 << 24  # lengths below it end in a zero byte


def with_types(pages: DataFrame) -> DataFrame:
    """``(page_id, url, html, payload_bytes, payload_digest, record_type, refers_to)``."""
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        html.alias("html"),
        F.octet_length(html).cast("long").alias("payload_bytes"),
        F.sha1(html.cast("binary")).alias("payload_digest"),
    )
    large = rows.where(F.col("payload_bytes") >= MIN_SHARED).where("page_id is not null")
    copies = (
        large.groupBy("payload_digest", "payload_bytes")
        .agg(F.max("page_id").alias("target"), F.min("page_id").alias("least"))
        .where("least < target")
        .drop("least")
    )
    copies = materialize(copies, "repeated-payloads")
    joined = rows.join(copies, ["payload_digest", "payload_bytes"], "left")
    revisit = F.col("target").isNotNull() & F.coalesce(F.col("page_id") < F.col("target"), F.lit(False))
    return joined.select(
        "page_id", "url", "html", "payload_bytes", "payload_digest",
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
        F.when(revisit, F.col("target")).alias("refers_to"),
    )


def _safe_url(url: Column) -> Column:
    """One printable line."""
    return F.regexp_replace(F.coalesce(url, F.lit("urn:page:none")), "[\\x00-\\x20\\x7F]", "_")


def record_text(rows: DataFrame) -> Column:
    """A record up to its two closing line ends."""
    name = F.coalesce(F.concat(F.lit("<urn:page:"), F.col("page_id").cast("string"), F.lit(">")), F.lit("<urn:page:none>"))
    body = F.when(F.col("record_type") == "response", F.col("html")).otherwise(F.lit(""))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK" + LINE + "Content-Type: text/html; charset=utf-8" + LINE + "Content-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit(LINE + LINE),
    )
    block = F.concat(http, body)
    refers = F.when(
        F.col("refers_to").isNotNull(),
        F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("refers_to").cast("string"), F.lit(">" + LINE)),
    ).otherwise(F.lit(""))
    head = F.concat(
        F.lit("WARC/1.1" + LINE + "WARC-Type: "), F.col("record_type"),
        F.lit(LINE + "WARC-Record-ID: "), name,
        F.lit(LINE + "WARC-Date: 2000-01-01T00:00:00Z" + LINE + "WARC-Target-URI: "), _safe_url(F.col("url")),
        F.lit(LINE + "WARC-Payload-Digest: sha1:"), F.col("payload_digest"),
        F.lit(LINE), refers,
        F.lit("Content-Type: application/http; msgtype=response" + LINE + "Content-Length: "),
        F.octet_length(block).cast("string"), F.lit(LINE + LINE),
    )
    return F.concat(head, block)


def write_monolithic(pages: DataFrame, path: str) -> None:
    """Archives of about ``ARCHIVE_BYTES`` of payload, one gzip stream per file.

    Each task writes what it has read, so payloads are not shuffled.
    """
    rows = with_types(pages)
    sums = pages.agg(F.sum(F.octet_length("html")).alias("bytes"), F.count("*").alias("n")).first()
    per_file = max(1, ARCHIVE_BYTES * sums["n"] // max(1, sums["bytes"] or 0))
    writer = rows.select(record_text(rows).alias("value")).write.option("compression", "gzip")
    writer.option("lineSep", LINE + LINE).option("maxRecordsPerFile", min(per_file, 1 << 30)).text(path)


def inflated(content: bytes, step: int = 1 << 20) -> Iterator[bytes]:
    """A gzip file front to back in pieces, whatever its number of members."""
    data = memoryview(content)
    engine, at = zlib.decompressobj(31), 0
    while at < len(data) or engine.unconsumed_tail:
        feed = engine.unconsumed_tail or data[at : at + step]
        if not engine.unconsumed_tail:
            at += len(feed)
        yield engine.decompress(feed, 4 * step)
        if engine.eof:
            rest = engine.unused_data
            at -= len(rest)
            if at >= len(data):
                return
            engine = zlib.decompressobj(31)


def records(pieces: Iterator[bytes]) -> Iterator[tuple[bytes, int]]:
    """Whole records of a stream, closing line ends included, and the length of each head."""
    held = bytearray()
    pieces = iter(pieces)

    def more() -> bool:
        for piece in pieces:
            if piece:
                held.extend(piece)
                return True
        return False

    while held or more():
        end = held.find(BOUNDARY)
        while end < 0:
            if not more():
                raise ValueError("a record head that does not end")
            end = held.find(BOUNDARY)
        size = end + 4 + int(field(bytes(held[:end]), b"content-length") or 0)
        while len(held) < size + 4:
            if not more():
                raise ValueError("a record that does not end")
        yield bytes(held[: size + 4]), end + 4
        del held[: size + 4]


def field(head: bytes, name: bytes) -> bytes | None:
    for line in head.split(b"\r\n")[1:]:
        key, _, value = line.partition(b":")
        if key.strip().lower() == name:
            return value.strip()
    return None


def member(record: bytes) -> bytes:
    engine = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return engine.compress(record) + engine.flush()


def _normalised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One archive per row, with a member per record."""
    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1)):
            out, last = [], 0
            for record, _ in records(inflated(content.as_py())):
                out.append(member(record))
                last = len(record)
            if last >= EMPTY_MEMBER_TAIL:
                out.append(member(b""))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path.as_py()]), pa.array([b"".join(out)], pa.binary())], names=["source", "content"]
                )


def members_of(content: bytes, step: int = 1 << 14) -> Iterator[tuple[int, int, bytes]]:
    """Offset, length and inflated bytes of each member of a gzip file."""
    data, start = memoryview(content), 0
    while start < len(data):
        engine, at, parts = zlib.decompressobj(31), start, []
        while not engine.eof:
            if at >= len(data):
                raise ValueError("a member that does not end")
            parts.append(engine.decompress(data[at : at + step]))
            at = min(at + step, len(data))
        end = at - len(engine.unused_data)
        yield start, end - start, b"".join(parts)
        start = end


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for archive, content in zip(batch.column(0), batch.column(1)):
            rows = []
            for offset, length, record in members_of(content.as_py()):
                if record:
                    name = field(record[: record.index(BOUNDARY)], b"warc-record-id") or b""
                    rows.append((archive.as_py(), offset, length, name.decode("utf-8", "replace")))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[i] for r in rows], t)
                    for i, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.string()))
                ],
                names=["archive", "offset", "length", "record_id"],
            )


def _archive_files(spark: SparkSession, out: str) -> DataFrame:
    """``(archive, content)`` of the normalised files."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true")
    files = reader.load(f"{out}/archives")
    return files.select(F.regexp_extract("path", "archive=([0-9a-f]+)", 1).alias("archive"), "content")


def normalise(spark: SparkSession, path: str, out: str) -> None:
    """Rewrite the archives below ``path`` to ``out``/archives, with offsets in ``out``/index."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")
    made = files.mapInArrow(_normalised, "source string, content binary")
    archive = F.sha1(F.col("source").cast("binary")).alias("archive")
    bytes_but_last = F.expr("substring(content, 1, octet_length(content) - 1)").cast("string").alias("value")
    writer = made.select(archive, bytes_but_last).write.option("lineSep", "\x00").option("compression", "none")
    writer.partitionBy("archive").text(f"{out}/archives")
    index = "archive string, offset bigint, length bigint, record_id string"
    _archive_files(spark, out).mapInArrow(_indexed, index).write.parquet(f"{out}/index")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each record through its offset alone."""
    for batch in batches:
        for content, members in zip(batch.column(0), batch.column(1)):
            data = memoryview(content.as_py())
            rows = []
            for place in members.as_py():
                record = zlib.decompress(data[place["offset"] : place["offset"] + place["length"]], 31)
                rows.append(_fields(record))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.int64()),
                    pa.array([r[2] for r in rows], pa.string()),
                    pa.array([r[3] for r in rows], pa.string()),
                    pa.array([r[4] for r in rows], pa.int64()),
                    pa.array([r[5] for r in rows], pa.binary()).cast(pa.string()),
                ],
                names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"],
            )


def _page(name: bytes | None) -> int | None:
    value = (name or b"").removeprefix(b"<urn:page:").removesuffix(b">")
    return int(value) if value.lstrip(b"-").isdigit() else None


def _fields(record: bytes) -> tuple:
    end = record.index(BOUNDARY)
    head = record[:end]
    block = record[end + 4 : -4]
    http = block.index(BOUNDARY)
    payload = block[http + 4 :]
    kind = field(head, b"warc-type").decode()
    told = field(head, b"warc-payload-digest").decode().removeprefix("sha1:")
    if kind == "response" and hashlib.sha1(payload).hexdigest() != told:
        raise ValueError("a payload differs from its digest")
    size = int(field(block[:http], b"content-length"))
    target = _page(field(head, b"warc-refers-to"))
    return _page(field(head, b"warc-record-id")), size, told, kind, target, payload if kind == "response" else None


def read_archives(spark: SparkSession, out: str) -> DataFrame:
    """Rows of all records, found through the index. ``payload`` is null for revisits."""
    index = spark.read.parquet(f"{out}/index")
    members = index.groupBy("archive").agg(F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("members"))
    schema = (
        "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, "
        "refers_to bigint, payload string"
    )
    return _archive_files(spark, out).join(members, "archive").select("content", "members").mapInArrow(_read, schema)


def archive_pages(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``pages`` to archives below ``folder``, normalise them, and read them back."""
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    slim = pages.select("page_id", "url", "html")
    if slim.isEmpty():
        return spark.createDataFrame([], read_schema())
    write_monolithic(slim, f"{folder}/monolithic")
    normalise(spark, f"{folder}/monolithic", f"{folder}/normal")
    return read_archives(spark, f"{folder}/normal")


def read_schema() -> str:
    return (
        "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, "
        "refers_to bigint, payload string"
    )
