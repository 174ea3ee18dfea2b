"""WARC records: reading, and resolution of not-modified revisits.

A revisit record of a 304 answer has no body. ``resolve`` gives it the latest earlier full response
of the same canonical URL, if the validators agree, with the response's headers updated by those a 304 may
change. The as-of join is done in slices of time: the last response of each (URL, slice) is a
mergeable maximum, carried over the slices of its URL, and only rows of one slice meet in one
window. So a URL with a third of all captures is spread over its slices. Bodies never move: the
result names the response record.

Definitions: records without URL or date resolve nothing and are resolved by nothing (``no_response``).
Responses of the revisit's own instant are not earlier; of several at the latest instant the largest
record id counts. Validators: ETag if the revisit has one (weak comparison), else Last-Modified,
else the payload digest; a revisit without any is ``unchecked`` and still resolved. Only
status 200 counts as a full response. Null and empty texts parse to records without type.

``read`` splits files at every "WARC/1." on the executors, then one pass per file joins what belongs together:
a record ends where its Content-Length says, so version lines inside a payload don't cut it. A record without
that header ends at the next version line, one that reaches past the end of its file is given as far as it goes,
and what lies between records is left out. A pass holds one record and one batch at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paneloom.session import materialise

MARK = "WARC/1."
VERSION = f"{MARK}0\r\n"
BATCH_BYTES = 4_000_000  # of records that leave a pass at once
_LENGTH = re.compile(rb"^content-length:[ \t]*([0-9]+)", re.IGNORECASE | re.MULTILINE)
SLICE_SECONDS = 3600
# Headers of a 304 answer that update a stored response.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
# Query keys that don't select a resource.
TRACKING = "^(utm_[^=]*|ref|fbclid|gclid)(=|$)"


def canonical_url(url: Column) -> Column:
    """Host and path without scheme, www, default port, fragment, tracking keys and final slash;
    other keys sorted. A URL without "://" stays as it is, null stays null."""
    plain = F.regexp_replace(url, "(?s)#.*$", "")
    name = F.lower(F.regexp_extract(plain, "(?s)^[^:/?#]+://([^/?#]*)", 1))
    name = F.regexp_replace(F.regexp_replace(name, "^www\\.", ""), ":(80|443)$", "")
    place = F.regexp_replace(F.regexp_extract(plain, "(?s)^[^:/?#]+://[^/?#]*([^?]*)", 1), "/+$", "")
    query = F.regexp_extract(plain, "(?s)^[^?]*\\?(.*)$", 1)
    kept = F.array_sort(
        F.filter(F.split(query, "&"), lambda x: (x != "") & ~x.rlike(TRACKING))
    )
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.when(plain.rlike("^[^:/?#]+://"), F.concat(name, place, tail)).otherwise(url)


def _size(record: bytearray) -> int | None:
    """Bytes that a record has by its header; None while the header is open or names no length."""
    head = record.find(b"\r\n\r\n")
    found = _LENGTH.search(record, 0, head) if head >= 0 else None
    return head + 4 + int(found[1]) if found else None


def _records(payloads: bool):
    """Chunks (file, chunk, bytes, leading) in the order of their files to whole records.

    Without payloads a chunk may be cut after its second empty line and a record is given up to its own.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[bytes] = []
        file, record, held, size = None, bytearray(), 0, None

        def close():
            whole = bytes(record if size is None else record[:size])
            if not payloads and (head := whole.find(b"\r\n\r\n")) >= 0:
                end = whole.find(b"\r\n\r\n", head + 4)
                whole = whole[: end + 4] if end >= 0 else whole
            if whole:
                done.append(whole)

        def flushed():
            out = pa.RecordBatch.from_arrays([pa.array(done, pa.binary())], names=["record"])
            done.clear()
            return out

        for batch in batches:
            for own, chunk, length, leading in zip(*(c.to_pylist() for c in batch.columns)):
                if own != file:
                    close()
                    file, record, held, size = own, bytearray(), 0, None
                begins = not leading and chunk[:3] in (b"0\r\n", b"1\r\n")
                if record and size is not None and held < size:
                    begins = False  # inside a payload
                elif record and record[-1:] != b"\n" and b"\r\n\r\n" not in record:
                    begins = False  # inside a header line
                elif begins or size is not None:
                    close()
                    record, held, size = bytearray(), 0, None
                if begins or record:
                    if len(record) == held:  # nothing cut off so far
                        record += MARK.encode() + chunk
                    held += len(MARK) + length
                    if size is None:
                        size = _size(record)
            if sum(map(len, done)) > BATCH_BYTES:
                yield flushed()
        close()
        yield flushed()

    return join


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records of WARC files (versions 1.0 and 1.1), plain or gzipped by record, as texts.

    Without ``payloads`` the texts end with the second empty line, after the headers of the answer, and
    only these leave the scan.
    """
    value = F.col("value")
    # occurrences may overlap there: three line breaks in a row hold the separator twice
    head = F.substring_index(value, "\r\n\r\n", 2)
    head = F.when(head.endswith("\r\n"), F.substring_index(value, "\r\n\r\n", 3)).otherwise(head)
    cut = F.when(F.octet_length(head) < F.octet_length(value), F.concat(head, F.lit("\r\n\r\n")))
    chunks = spark.read.option("lineSep", MARK).text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        (value if payloads else F.coalesce(cut, value)).cast("binary").alias("chunk"),
        F.octet_length(value).alias("bytes"),
    )
    first = Window.partitionBy("file").orderBy("block", "place")
    return (
        chunks.withColumn("leading", F.row_number().over(first) == 1)
        .select("file", "chunk", "bytes", "leading")
        .mapInArrow(_records(payloads), "record binary")
        .select(F.col("record").cast("string").alias("record"))
    )


def record_text(
    kind: str,
    record_id: Column,
    url: Column,
    date: Column,
    status: str,
    http: Column,
    body: Column,
    digest: Column | None = None,
) -> Column:
    """A record as text; ``http``: header lines, each ended by a line break. Headers without a value are left out."""
    block = F.concat(
        F.lit(f"HTTP/1.1 {status}\r\n"), http, F.lit("\r\n"), F.coalesce(body, F.lit(""))
    )

    def line(name, value):
        return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")), F.lit(""))

    return F.concat(
        F.lit(f"{VERSION}WARC-Type: {kind}\r\n"),
        line("WARC-Record-ID", record_id),
        line("WARC-Date", F.date_format(date, "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        line("WARC-Target-URI", url),
        line("WARC-Payload-Digest", F.lit(None) if digest is None else digest),
        line("Content-Length", F.octet_length(block)),
        F.lit("\r\n"),
        block,
    )


def _fields(block: Column) -> Column:
    """Header lines to an array of (name, value), names in lower case."""
    lines = F.filter(F.split(block, "\r\n"), lambda x: x.contains(":"))
    return F.transform(
        lines,
        lambda x: F.struct(
            F.lower(F.trim(F.regexp_extract(x, "^([^:]*):", 1))).alias("name"),
            F.trim(F.regexp_extract(x, "(?s)^[^:]*:(.*)$", 1)).alias("value"),
        ),
    )


def header(fields: Column, name: str) -> Column:
    """Value of the last header of that name, else null."""
    found = F.filter(fields, lambda h: h["name"] == name)
    return F.when(F.size(found) > 0, F.element_at(found, -1)["value"])


def parse(records: DataFrame, column: str = "record") -> DataFrame:
    """record_id, type, url, date, payload_digest, status, headers, body of record texts."""
    parts = F.split(F.coalesce(F.col(column), F.lit("")), "\r\n\r\n", 3)
    cut = records.select(
        _fields(F.get(parts, F.lit(0))).alias("warc"),
        F.get(parts, F.lit(1)).alias("http"),
        F.get(parts, F.lit(2)).alias("body"),
    )
    return cut.select(
        header(F.col("warc"), "warc-record-id").alias("record_id"),
        header(F.col("warc"), "warc-type").alias("type"),
        header(F.col("warc"), "warc-target-uri").alias("url"),
        F.try_to_timestamp(
            header(F.col("warc"), "warc-date"), F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'")
        ).alias("date"),
        header(F.col("warc"), "warc-payload-digest").alias("payload_digest"),
        F.regexp_extract("http", "^HTTP/[0-9.]+ ([0-9]{3})", 1).try_cast("int").alias("status"),
        F.coalesce(_fields(F.col("http")), _fields(F.lit(""))).alias("headers"),
        "body",
    )


def _opaque(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


def merged_headers(old: Column, new: Column) -> Column:
    """``old`` with the permitted headers of ``new`` in place of its own, by name and value."""
    allowed = F.array(*[F.lit(p) for p in PERMITTED])
    fresh = F.filter(new, lambda h: F.array_contains(allowed, h["name"]))
    names = F.transform(fresh, lambda h: h["name"])
    stay = F.filter(old, lambda h: ~F.array_contains(names, h["name"]))
    return F.array_sort(F.concat(stay, fresh))


def resolve(records: DataFrame, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """One row per revisit: its columns, canonical_url, response_id, response_date, outcome, headers.

    ``records``: record_id, type, url, date, status, headers, and optionally payload_digest; bodies
    aren't read. outcome: resolved, unchecked, mismatch (the headers stay the revisit's), no_response.
    """
    digest = F.col("payload_digest") if "payload_digest" in records.columns else F.lit(None)
    events = records.select(
        "record_id",
        "type",
        canonical_url(F.col("url")).alias("canonical_url"),
        "url",
        "date",
        F.unix_micros(F.col("date").cast("timestamp")).alias("at"),
        "headers",
        digest.cast("string").alias("digest"),
        ((F.col("type") == "response") & (F.col("status") == 200)).alias("full"),
    ).where("full or type = 'revisit'")
    events = materialise(events)  # read by three branches, so records are parsed once
    usable = (F.col("canonical_url").isNotNull()) & F.col("at").isNotNull()
    found = F.when(
        F.col("full"), F.struct("at", "record_id", "date", "headers", "digest")
    )
    placed = (
        events.where(usable)
        .withColumn("slice", F.floor(F.col("at") / F.lit(slice_seconds * 1_000_000)))
        .withColumn("own", found)
    )
    by_slice = placed.groupBy("canonical_url", "slice").agg(F.max("own").alias("last"))
    earlier = (
        Window.partitionBy("canonical_url").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = by_slice.select(
        "canonical_url", "slice", F.last("last", ignorenulls=True).over(earlier).alias("carried")
    )
    within = (
        Window.partitionBy("canonical_url", "slice")
        .orderBy("at")
        .rangeBetween(Window.unboundedPreceding, -1)
    )
    met = (
        placed.withColumn("near", F.max("own").over(within))
        .where("type = 'revisit'")
        .join(carried, ["canonical_url", "slice"], "left")
        .withColumn("base", F.coalesce("near", "carried"))
        .drop("slice", "own", "near", "carried")
    )
    missed = events.where(~usable & (F.col("type") == "revisit")).withColumn(
        "base", F.lit(None).cast(met.schema["base"].dataType)
    )
    both = met.unionByName(missed)
    tag, changed = header(F.col("headers"), "etag"), header(F.col("headers"), "last-modified")
    agrees = (
        F.when(tag.isNotNull(), _opaque(tag).eqNullSafe(_opaque(header(F.col("base.headers"), "etag"))))
        .when(changed.isNotNull(), changed.eqNullSafe(header(F.col("base.headers"), "last-modified")))
        .when(F.col("digest").isNotNull(), F.col("digest").eqNullSafe(F.col("base.digest")))
    )
    outcome = (
        F.when(F.col("base").isNull(), "no_response")
        .when(agrees.isNull(), "unchecked")
        .when(agrees, "resolved")
        .otherwise("mismatch")
    )
    held = F.col("outcome").isin("resolved", "unchecked")
    return both.withColumn("outcome", outcome).select(
        "record_id",
        "url",
        "canonical_url",
        "date",
        F.when(held, F.col("base.record_id")).alias("response_id"),
        F.when(held, F.col("base.date")).alias("response_date"),
        "outcome",
        F.when(held, merged_headers(F.col("base.headers"), F.col("headers")))
        .otherwise(F.array_sort("headers"))
        .alias("headers"),
    )
