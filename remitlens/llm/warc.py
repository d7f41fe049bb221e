"""WARC archives: write pages as whole-file gzip streams, normalise them to one gzip member a record, and read them back.

``write_monolithic`` writes one gzip stream per partition with Spark's text writer, so it reaches any file system Spark does.
``normalise`` inflates each such stream once, piece by piece, cuts it into records by their lengths, compresses every record as a
member of its own, and writes the members and a sidecar index (place of each record) in one pass.  A member's last byte, the
top byte of its size, is zero; the text writer puts it there as its separator, which keeps the file byte for byte.  A record
too large for that is followed by an empty member.  ``read_archives`` walks the members; ``look_up`` goes by the index.

Of records with equal payloads of at least ``LEAST_BYTES`` bytes the one with the smallest page_id is a response and the others are
revisits of it.

Defined results: a null html is an empty payload; null page_ids and urls come back as null; of repeated rows with the smallest page_id
each is a response; revisits have no block.  A damaged archive raises an error.  An archive is held in memory compressed, a
record uncompressed.
"""

from __future__ import annotations

import gzip
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlens.llm.support import path_exists, ship

LEAST_BYTES = 100
DATE = "2000-01-01T00:00:00Z"
BREAK = b"\r\n\r\n"
PIECE = 1 << 16
#: Bytes of members handed on at once.
BATCH_BYTES = 4 << 20
IDENTICAL = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
EMPTY_MEMBER = gzip.compress(b"", mtime=0)

RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"
INDEX = "archive string, ordinal long, start long, length long, page_id long, record_type string"


def described(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to of each row of ``pages`` (page_id, url, html)."""
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("payload"), F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha2(payload, 256).alias("payload_digest"))
    large = rows.where(F.col("payload_bytes") >= LEAST_BYTES)
    groups = large.groupBy("payload_digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where((F.col("n") > 1) & F.col("first_id").isNotNull())
    joined = rows.join(groups.select("payload_digest", "first_id"), "payload_digest", "left")
    again = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.select("page_id", "url", "payload", "payload_bytes", "payload_digest", F.when(again, "revisit").otherwise("response").alias("record_type"), F.when(again, F.col("first_id")).alias("refers_to"))


def record_text(rows: DataFrame) -> DataFrame:
    """The WARC records of ``described`` rows as one string column, without the break after the block."""
    line = lambda name, value: F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))).otherwise("")
    uri = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    response = F.col("record_type") == "response"
    target = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return rows.select(
        F.concat(
            F.lit("WARC/1.0\r\nWARC-Type: "), F.col("record_type"), F.lit(f"\r\nWARC-Date: {DATE}\r\n"),
            line("WARC-Record-ID", uri(F.col("page_id"))),
            line("WARC-Target-URI", target),
            line("WARC-Refers-To", uri(F.col("refers_to"))),
            F.when(response, "").otherwise(f"WARC-Profile: {IDENTICAL}\r\n"),
            F.lit("WARC-Payload-Digest: sha256:"), F.col("payload_digest"),
            F.lit("\r\nWARC-Payload-Length: "), F.col("payload_bytes").cast("string"),
            F.lit("\r\nContent-Type: application/http;msgtype=response\r\nContent-Length: "),
            F.when(response, F.col("payload_bytes") + len(HTTP)).otherwise(0).cast("string"),
            F.lit("\r\n\r\n"),
            F.when(response, F.concat(F.lit(HTTP), F.col("payload"))).otherwise(""),
        ).alias("value")
    )


def write_monolithic(pages: DataFrame, path: str) -> None:
    """One gzip stream of records for each partition."""
    record_text(described(pages)).write.option("lineSep", BREAK.decode()).option("compression", "gzip").text(path)


def inflated(content: bytes):
    """Yield the pieces of a gzip file of one member or several."""
    machine, at, begun = zlib.decompressobj(31), 0, False
    while at < len(content) or machine.unconsumed_tail:
        piece = machine.unconsumed_tail
        if not piece:
            piece = content[at : at + PIECE]
            at += len(piece)
        begun = True
        if out := machine.decompress(piece, 8 * PIECE):
            yield out
        if machine.eof:
            at -= len(machine.unused_data)
            machine, begun = zlib.decompressobj(31), False
    if begun:
        raise ValueError("the archive ends within a gzip member")


def headers_of(head: bytes) -> dict[str, str]:
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError(f"no WARC record: {first[:40]!r}")
    return dict(x.split(": ", 1) for x in lines)


def records(pieces):
    """Yield (headers, whole record without its break) of an inflated stream; a record is held at a time."""
    held, need, head = bytearray(), 0, None
    for piece in pieces:
        held += piece
        while True:
            if head is None:
                stop = held.find(BREAK)
                if stop < 0:
                    break
                head = headers_of(bytes(held[:stop]))
                need = stop + len(BREAK) + int(head["Content-Length"]) + len(BREAK)
            if len(held) < need:
                break
            yield head, bytes(held[: need - len(BREAK)])
            if held[need - len(BREAK) : need] != BREAK:
                raise ValueError("a record's length is wrong")
            del held[:need]
            head = None
    if held:
        raise ValueError("the archive ends within a record")


def _page(uri: str | None) -> int | None:
    return int(uri.removeprefix("<urn:page:").removesuffix(">")) if uri else None


def normalise(spark: SparkSession, source: str, target: str) -> None:
    """Rewrite the archives of ``source`` with a member for each record, to ``target``/kind=archive and, beside it, kind=index."""
    ship(spark)

    def run(batches):
        ordinal = offset = size = 0
        rows: list[tuple] = []

        def batch_of(found):
            kinds, numbers, values = zip(*found, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(numbers, pa.int64()), pa.array(values, pa.binary())], ["kind", "ordinal", "value"])

        for batch in batches:
            for content in batch.column(0):
                for head, record in records(inflated(content.as_buffer().to_pybytes())):
                    member = gzip.compress(record + BREAK, mtime=0)
                    if member[-1]:
                        member += EMPTY_MEMBER
                    place = f"{ordinal}\t{offset}\t{len(member)}\t{_page(head.get('WARC-Record-ID')) if head.get('WARC-Record-ID') else ''}\t{head['WARC-Type']}"
                    rows += [("archive", ordinal, member[:-1]), ("index", ordinal, place.encode())]
                    ordinal, offset, size = ordinal + 1, offset + len(member), size + len(member)
                    if size >= BATCH_BYTES:
                        yield batch_of(rows)
                        rows, size = [], 0
        if rows:
            yield batch_of(rows)

    files = spark.read.format("binaryFile").load(source).select("content")
    made = files.mapInArrow(run, "kind string, ordinal long, value binary").sortWithinPartitions("kind", "ordinal")
    made.select(F.col("value").cast("string").alias("value"), "kind").write.option("lineSep", "\0").partitionBy("kind").text(target)


def _part():
    """The part of a file's name that its archive and its index share."""
    return F.regexp_extract(F.col("_metadata.file_name"), r"^(part-\d+-[0-9a-f-]+)", 1)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The sidecar index: archive, ordinal, start, length, page_id, record_type."""
    if not path_exists(spark, f"{path}/kind=index"):
        return spark.createDataFrame([], INDEX)
    lines = spark.read.schema("value string").option("lineSep", "\0").text(f"{path}/kind=index").select(_part().alias("archive"), F.split("value", "\t").alias("v"))
    v = F.col("v")
    return lines.select(
        "archive", v[0].cast("long").alias("ordinal"), v[1].cast("long").alias("start"), v[2].cast("long").alias("length"), F.when(v[3] != "", v[3]).cast("long").alias("page_id"), v[4].alias("record_type")
    )


def _archives(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, f"{path}/kind=archive"):  # no records at all
        return spark.createDataFrame([], "archive string, content binary")
    return spark.read.format("binaryFile").load(f"{path}/kind=archive").select(_part().alias("archive"), "content")


def _parsed(head: dict[str, str], record: bytes, keep_payload: bool) -> tuple:
    payload = record[record.find(BREAK) + len(BREAK) :]
    payload = payload[len(HTTP) :] if head["WARC-Type"] == "response" else None
    n, digest = int(head["WARC-Payload-Length"]), head["WARC-Payload-Digest"].removeprefix("sha256:")
    if payload is not None and len(payload) != n:
        raise ValueError("a payload's length is wrong")
    return (_page(head.get("WARC-Record-ID")), n, digest, head["WARC-Type"], _page(head.get("WARC-Refers-To")), head.get("WARC-Target-URI"), payload if keep_payload else None)


def _rows(found: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)], [f.split(" ")[0] for f in RECORD.split(", ")])


def read_archives(spark: SparkSession, path: str, keep_payload: bool = True) -> DataFrame:
    """All records of normalised archives."""
    ship(spark)

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                found, size = [], 0
                for head, record in records(inflated(content.as_buffer().to_pybytes())):
                    found.append(_parsed(head, record, keep_payload))
                    size += len(record) if keep_payload else 200
                    if size >= BATCH_BYTES:
                        yield _rows(found)
                        found, size = [], 0
                if found:
                    yield _rows(found)

    return _archives(spark, path).select("content").mapInArrow(run, RECORD)


def look_up(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """The records of the pages in ``wanted`` (page_id), fetched by their place in the index."""
    ship(spark)

    def run(batches):
        for batch in batches:
            found = [_parsed(*next(records([zlib.decompress(m.as_py(), 31)])), True) for m in batch.column(0)]
            if found:
                yield _rows(found)

    places = read_index(spark, path).join(wanted.select("page_id").distinct(), "page_id").select("archive", "start", "length")
    members = _archives(spark, path).join(places, "archive").select(F.expr("substring(content, cast(start + 1 as int), cast(length as int))").alias("member"))
    return members.mapInArrow(run, RECORD)


def round_trip(pages: DataFrame, raw: str, target: str) -> DataFrame:
    """Write ``pages`` to ``raw``, normalise to ``target`` and return the records read back, without payloads."""
    spark = pages.sparkSession
    write_monolithic(pages, raw)
    normalise(spark, raw, target)
    return read_archives(spark, target, keep_payload=False)


#: DuckDB's statement of the contract.
SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS n FROM pages),
firsts AS (SELECT body, min(page_id) AS first_id FROM p WHERE n >= 100 GROUP BY body)
SELECT p.page_id, n AS payload_bytes, sha256(p.body) AS payload_digest,
  CASE WHEN first_id <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first_id <> p.page_id THEN first_id END AS refers_to
FROM p LEFT JOIN firsts f ON f.body = p.body
"""
