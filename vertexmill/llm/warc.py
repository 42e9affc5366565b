"""A content-addressed archive of WARC records.

Payload bytes are stored once, under their SHA-256; the exact header bytes of
every record are a table of their own. Records are put together again by a join.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vertexmill.llm.tables import join_by, scratch_path, written

#: Smallest payload whose repeats become revisit records.
LEAST_REVISIT = 0

#: A payload with more than 1/HOT_SHARE of the records (and more than HOT_FLOOR) is copied to several join keys.
HOT_SHARE, HOT_FLOOR = 10_000, 10_000

#: Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
END = "\r\n\r\n"


def base32(hexadecimal: Column) -> Column:
    """Upper-case base32 of a SHA-1 given as 40 hexadecimal digits, 20 bits at a time."""
    digits = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    parts = [
        F.lpad(F.conv(F.substring(hexadecimal, 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)
    ]
    return F.translate(F.upper(F.concat(*parts)), digits, letters)


def to_records(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """``(page_id, digest, header, payload)``: a WARC record per page, in parts.

    ``header`` is all that stands before the payload: WARC and HTTP headers of a
    response, or the whole record of a revisit, which has no payload of its own.
    Of pages with equal payloads of at least ``least`` bytes the smallest page_id
    is a response and the others revisit it. Rows that repeat that page_id and
    payload are responses too. Null ids come last: they revisit a page with an
    id, and are all responses where the group has none. A null url is empty.
    """
    rows = pages.select(
        "page_id",
        F.coalesce("url", F.lit("")).alias("url"),
        F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    owners = written(
        rows.filter(F.length("payload") >= least)
        .groupBy("digest")
        .agg(F.min("page_id").alias("owner"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("digest", "owner"),
        "warc-owners",
    )
    known = join_by(rows, owners, ["digest"], spread="page_id")
    revisit = F.col("owner").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("owner"))
    size = F.length("payload").cast("string")
    sha1 = base32(F.sha1("payload"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        size,
        F.lit(END),
    )

    def record_id(page: str) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(page).cast("string"), F.lit("")), F.lit(">"))

    def lines(kind: str, length: Column, *more: Column) -> Column:
        return F.concat(
            F.lit(f"{VERSION}\r\nWARC-Type: {kind}\r\nWARC-Record-ID: "),
            record_id("page_id"),
            F.lit(f"\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "),
            F.regexp_replace("url", r"[\r\n]", " "),
            F.lit("\r\nWARC-Payload-Digest: sha1:"),
            sha1,
            *more,
            F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
            length.cast("string"),
            F.lit(END),
        )

    whole = lines("response", F.length(F.encode(http, "UTF-8")) + F.length("payload"))
    refers = F.concat(
        F.lit(f"\r\nWARC-Profile: {REVISIT_PROFILE}\r\nWARC-Refers-To: "), record_id("owner")
    )
    again = lines("revisit", F.length(F.encode(http, "UTF-8")), refers)
    header = F.concat(F.when(revisit, again).otherwise(whole), http)
    return known.select("page_id", "digest", F.encode(header, "UTF-8").alias("header"), "payload")


def _first_seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of every digest in a task the first payload only, checked against the digest."""
    seen: set[str] = set()
    for batch in batches:
        keep = []
        for k, digest in enumerate(batch.column("digest").to_pylist()):
            if digest not in seen:
                seen.add(digest)
                if hashlib.sha256(batch.column("payload")[k].as_buffer()).hexdigest() != digest:
                    raise ValueError(f"payload does not have the digest {digest}")
                keep.append(k)
        if keep:
            yield batch.take(pa.array(keep))


@dataclass
class Archive:
    """Folders of an archive: ``headers(page_id, digest, header)``, ``payloads(digest, payload)``."""

    headers: str
    payloads: str


def write_archive(records: DataFrame, folder: str) -> Archive:
    """Store records; every distinct payload once.

    A task sends a payload on only the first time it meets it, so the copies of
    a hot payload that travel are at most one a task; the same rule after the
    shuffle leaves one.
    """
    archive = Archive(f"{folder}/headers", f"{folder}/payloads")
    records.select("page_id", "digest", "header").write.parquet(archive.headers)
    payloads, schema = records.select("digest", "payload"), "digest string, payload binary"
    (
        payloads.mapInArrow(_first_seen, schema)
        .repartition("digest")
        .mapInArrow(_first_seen, schema)
        .write.parquet(archive.payloads)
    )
    return archive


def hot_digests(headers: DataFrame, floor: int = HOT_FLOOR) -> DataFrame:
    """``(digest, copies)`` of payloads with more than ``floor`` records and 1/``HOT_SHARE`` of all.

    So fewer than ``HOT_SHARE`` rows by construction, whatever the archive's size.
    """
    limit = max(floor, -(-headers.count() // HOT_SHARE))
    counts = headers.groupBy("digest").agg(F.count("*").alias("n")).filter(F.col("n") > limit)
    return written(counts.select("digest", F.ceil(F.col("n") / limit).cast("int").alias("copies")), "hot-digests")


def read_archive(spark, archive: Archive, floor: int = HOT_FLOOR) -> DataFrame:
    """One row per record, all fields read from the archive.

    The records of a hot payload are spread over several join keys by their place in the
    archive and the payload is copied to each, so no join task gets all of them.

    ``(page_id, payload_bytes, payload_digest, record_type, refers_to, header,
    payload)``. The payload is held against its key: a store whose bytes don't
    have the digest they stand under fails the read, as do a header without a
    payload and a record whose own digest line differs.
    """
    headers = spark.read.parquet(archive.headers)
    hot = F.broadcast(hot_digests(headers, floor))
    stored = spark.read.parquet(archive.payloads)
    checked = F.when(F.sha2("payload", 256) == F.col("digest"), F.length("payload")).otherwise(
        F.raise_error(F.concat(F.lit("damaged payload "), F.col("digest"))).cast("int")
    )
    payloads = stored.select(
        F.col("digest").alias("stored"),
        checked.cast("bigint").alias("payload_bytes"),
        base32(F.sha1("payload")).alias("payload_digest"),
        "payload",
    )
    each = F.explode(F.sequence(F.lit(0), F.coalesce("copies", F.lit(1)) - 1))
    copied = payloads.join(hot.withColumnRenamed("digest", "stored"), "stored", "left").withColumn("copy", each)
    placed = headers.select("*", F.col("_metadata.row_index").alias("row"))
    place = F.pmod("row", F.coalesce("copies", F.lit(1))).cast("int")
    spread = placed.join(hot, "digest", "left").select("page_id", "digest", "header", place.alias("place"))
    met = (F.col("digest") == F.col("stored")) & (F.col("place") == F.col("copy"))
    joined = spread.join(copied, met, "left")
    text = F.decode("header", "UTF-8")
    field = lambda name: F.regexp_extract(text, rf"\r\n{name}: ([^\r]*)\r\n", 1)
    told = field("WARC-Payload-Digest")
    agrees = told == F.concat(F.lit("sha1:"), F.col("payload_digest"))
    return joined.select(
        "page_id",
        "payload_bytes",
        F.when(agrees, F.col("payload_digest"))
        .otherwise(F.raise_error(F.concat(F.lit("no such payload: "), told)))
        .alias("payload_digest"),
        field("WARC-Type").alias("record_type"),
        F.when(field("WARC-Refers-To") != "", F.regexp_extract(field("WARC-Refers-To"), "page:(-?[0-9]*)", 1))
        .try_cast("bigint")
        .alias("refers_to"),
        "header",
        "payload",
    )


def record_bytes(records: DataFrame) -> DataFrame:
    """``(page_id, record)``: the exact bytes of every record as it stands in a WARC file."""
    body = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return records.select("page_id", F.concat("header", body, F.lit(END.encode())).alias("record"))


def archive_pages(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """Write pages to an archive in the shared folder and read it back.

    Null html is an empty payload; an empty table gives an empty archive; every
    input row gives one record, repeated rows included.
    """
    folder = scratch_path(pages.sparkSession, "warc")
    archive = write_archive(to_records(pages, least), folder)
    return read_archive(pages.sparkSession, archive)
