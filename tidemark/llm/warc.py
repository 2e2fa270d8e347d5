"""WARC archives: captures written as records, records assembled into captures.

A page becomes three records in a row: the request, the response (or a revisit of an
equal payload) and a metadata record with the page's id. Request and metadata name the
response in ``WARC-Concurrent-To``. Spark's text writer puts the records out, with the
two line ends that close every record as its separator, into gzip files.

Reading, the text source cuts archives at blank lines, task by task and never a whole
file at once; a task's parser puts records together again by their Content-Length, in
memory bounded by one record. Records are then joined to captures: for each response or
revisit one row with its nested request and metadata, found by concurrent-to
identifiers on either side. A revisit names the response with its payload digest.

Defined cases. A null payload is empty. A null or empty address leaves the header out;
line ends in an address are percent-encoded. Repeated rows are captures of their own. A
row without an id never stands for others of equal payload unless none has one. Of
several requests or metadata records of a capture the one with the smallest record id is
nested and ``n_requests`` or ``n_metadata`` counts them; :func:`loose_records` has the
rest, and records whose capture is missing. A record cut off by the end of its file has
the type ``truncated``. An archive without records gives no rows. Payloads of any length
are kept whole. Only compressed archives are read: a plain file may be split amid a
record, and the read fails with a message then. Extra columns may have any name.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.rows import col, text_of
from tidemark.workspace import new_folder, write_table

#: Payloads from this size on are stored once; equal ones revisit it.
REVISIT_BYTES = 1000
BREAK = "\r\n\r\n"
CAPTURES = ("response", "revisit", "resource")
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_RECORD = (
    "type string, id string, concurrent_to array<string>, refers_to string, uri string, "
    "date string, digest string, content_type string, fields map<string,string>, "
    "payload_bytes long, payload binary"
)


# -- writing --------------------------------------------------------------------


def _record(headers: list[tuple[str, Column]], block: Column) -> Column:
    """A record without the line ends that close it; null headers are left out."""
    lines = [F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")) for name, value in headers]
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        *[F.coalesce(line, F.lit("")) for line in lines],
        F.lit("Content-Length: "),
        F.octet_length(block).cast("string"),
        F.lit(BREAK),
        block,
    )


def with_types(df: DataFrame, id_column: str, payload_column: str, url_column: str) -> DataFrame:
    """``page_id, url, payload, digest, type``: which pages are responses, which revisits.

    Of equal payloads of ``REVISIT_BYTES`` or more the page with the largest id is the
    response. Equal payloads are told by length and SHA-1.
    """
    pages = df.select(
        col(id_column).alias("page_id"),
        col(url_column).cast("string").alias("url"),
        text_of(col(payload_column)).alias("payload"),
    ).withColumn("digest", F.sha1(F.col("payload").cast("binary"))).withColumn(
        "n", F.octet_length("payload")
    )
    shared, _ = write_table(
        pages.where(F.col("n") >= REVISIT_BYTES)
        .groupBy("digest", "n")
        .agg(F.max("page_id").alias("keep"), F.count("*").alias("rows"))
        .where("rows > 1")
        .select(F.col("digest").alias("s_digest"), F.col("n").alias("s_n"), "keep"),
        "payloads",
    )
    revisit = F.col("keep").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keep"))
    return pages.join(
        shared, (F.col("digest") == F.col("s_digest")) & (F.col("n") == F.col("s_n")), "left"
    ).select(
        "page_id",
        "url",
        "payload",
        "digest",
        F.when(revisit, "revisit").otherwise("response").alias("type"),
    )


def records(typed: DataFrame, date: str) -> DataFrame:
    """``value``: the records of every page, request, capture and metadata in a row."""
    url = F.when(F.length("url") > 0, F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")),
                                                F.lit("\n"), F.lit("%0A")))
    rows = typed.withColumn("uri", url).withColumn("uuid", F.expr("uuid()"))
    capture = F.concat(F.lit("<urn:uuid:"), F.col("uuid"), F.lit(">"))

    def beside(kind: str) -> Column:
        mixed = F.md5(F.concat(F.col("uuid"), F.lit(kind)))
        parts = [F.substring(mixed, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
        return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))

    host = F.coalesce(F.regexp_extract("uri", "^[a-z]+://([^/?#]*)", 1), F.lit(""))
    path = F.coalesce(F.regexp_extract("uri", "^[a-z]+://[^/?#]*([^#]*)", 1), F.lit(""))
    request = F.concat(
        F.lit("GET "), F.when(path == "", "/").otherwise(path), F.lit(" HTTP/1.1\r\nHost: "),
        host, F.lit(BREAK),
    )
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length("payload").cast("string"), F.lit(BREAK),
    )
    whole = F.col("type") == "response"
    shared = [("WARC-Date", F.lit(date)), ("WARC-Target-URI", F.col("uri"))]
    written = F.array(
        _record(
            [("WARC-Type", F.lit("request")), ("WARC-Record-ID", beside("request")), *shared,
             ("WARC-Concurrent-To", capture),
             ("Content-Type", F.lit("application/http; msgtype=request"))],
            request,
        ),
        _record(
            [("WARC-Type", F.col("type")), ("WARC-Record-ID", capture), *shared,
             ("WARC-Profile", F.when(~whole, _PROFILE)),
             ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
             ("Content-Type", F.lit("application/http; msgtype=response"))],
            F.when(whole, F.concat(head, F.col("payload"))).otherwise(head),
        ),
        _record(
            [("WARC-Type", F.lit("metadata")), ("WARC-Record-ID", beside("metadata")), *shared,
             ("WARC-Concurrent-To", capture),
             ("Content-Type", F.lit("application/warc-fields"))],
            F.coalesce(
                F.concat(F.lit("page-id: "), F.col("page_id").cast("string"), F.lit("\r\n")),
                F.lit(""),
            ),
        ),
    )
    return rows.select(F.explode(written).alias("value"))


def write_archives(
    df: DataFrame,
    id_column: str,
    payload_column: str,
    url_column: str,
    path: str | None = None,
    date: str = "2024-01-01T00:00:00Z",
) -> str:
    """Write the pages of ``df`` as gzip archives; the folder they are in."""
    path = path or new_folder(df.sparkSession, "warc")
    typed = with_types(df, id_column, payload_column, url_column)
    records(typed, date).write.option("lineSep", BREAK).option("compression", "gzip").text(path)
    return path


# -- reading --------------------------------------------------------------------


def _header_map(lines: bytes) -> list[tuple[str, str]]:
    found = []
    for line in lines.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if colon:
            found.append((name.decode(errors="replace").strip().lower(),
                          value.decode(errors="replace").strip()))
    return found


def _digest(labelled: str | None) -> str | None:
    """Bare lower-case hex of a labelled SHA-1, given in hex or in base 32."""
    if not labelled:
        return None
    value = labelled.partition(":")[2] or labelled
    if len(value) == 32:
        return base64.b32decode(value.upper()).hex()
    return value.lower()


def _parsed(head: bytes, block: bytes, with_payload: bool) -> dict:
    pairs = _header_map(head)
    headers = dict(pairs)
    payload, fields = block, None
    kind = headers.get("content-type", "")
    if kind.startswith("application/http"):
        payload = block.partition(b"\r\n\r\n")[2]
    elif kind.startswith("application/warc-fields"):
        fields = list(dict(_header_map(block)).items())
    whole = headers.get("warc-type") in ("response", "resource")
    return {
        "type": headers.get("warc-type"),
        "id": headers.get("warc-record-id"),
        "concurrent_to": [v for n, v in pairs if n == "warc-concurrent-to"],
        "refers_to": headers.get("warc-refers-to"),
        "uri": headers.get("warc-target-uri"),
        "date": headers.get("warc-date"),
        # Of a stored payload the digest is computed, whatever the header says.
        "digest": hashlib.sha1(payload).hexdigest()
        if whole
        else _digest(headers.get("warc-payload-digest")),
        "content_type": kind or None,
        "fields": fields,
        "payload_bytes": len(payload),
        "payload": payload if with_payload else None,
    }


class RecordParser:
    """Records out of a stream of bytes, fed in pieces of any size."""

    def __init__(self, with_payload: bool):
        self._buffer, self._with_payload = bytearray(), with_payload
        self._head = self._needed = 0  # of the record begun: its header's and whole length

    def feed(self, piece: bytes) -> Iterator[dict]:
        self._buffer += piece
        while True:
            if not self._needed:
                skipped = len(self._buffer) - len(self._buffer.lstrip(b"\r\n"))
                del self._buffer[:skipped]
                end = self._buffer.find(b"\r\n\r\n")
                if end < 0:
                    return
                length = dict(_header_map(bytes(self._buffer[:end]))).get("content-length", "0")
                self._head, self._needed = end + 4, end + 4 + int(length)
            if len(self._buffer) < self._needed:
                return
            data = bytes(self._buffer[: self._needed])
            del self._buffer[: self._needed]
            yield _parsed(data[: self._head - 4], data[self._head :], self._with_payload)
            self._needed = 0

    def rest(self) -> Iterator[dict]:
        """What the end of the file cut off."""
        if self._needed or self._buffer.strip(b"\r\n"):
            found = _parsed(bytes(self._buffer), b"", False)
            yield found | {"type": "truncated", "digest": None}
        self._buffer, self._needed = bytearray(), 0


def _parse(with_payload: bool, schema: pa.Schema):
    def batches_of(found: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(found, schema=schema)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser, file, found, size = RecordParser(with_payload), None, [], 0
        for batch in batches:
            values = batch.column("value").cast(pa.binary())
            for path, start, value in zip(
                batch.column("path").to_pylist(), batch.column("start").to_pylist(), values
            ):
                if path != file:
                    found.extend(parser.rest())
                    file = path
                if start:
                    raise ValueError(f"{path} was split amid its records: compress it")
                for record in parser.feed(value.as_py() + b"\r\n\r\n"):
                    found.append(record)
                    size += record["payload_bytes"] if with_payload else 0
                if len(found) >= 2000 or size > 16 << 20:
                    yield batches_of(found)
                    found, size = [], 0
        found.extend(parser.rest())
        if found:
            yield batches_of(found)

    return parse


_ARROW = pa.schema(
    [
        ("type", pa.string()),
        ("id", pa.string()),
        ("concurrent_to", pa.list_(pa.string())),
        ("refers_to", pa.string()),
        ("uri", pa.string()),
        ("date", pa.string()),
        ("digest", pa.string()),
        ("content_type", pa.string()),
        ("fields", pa.map_(pa.string(), pa.string())),
        ("payload_bytes", pa.int64()),
        ("payload", pa.binary()),
    ]
)


def read_records(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The records of all archives below ``path``."""
    pieces = spark.read.option("lineSep", BREAK).text(path).select(
        F.col("value").cast("binary").alias("value"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
    )
    return pieces.mapInArrow(_parse(with_payload, _ARROW), _RECORD)


def _beside(found: DataFrame, kind: str) -> DataFrame:
    """Records of a kind, each with the ids it is concurrent to."""
    own = found.where(F.col("type") == kind)
    named = own.select(F.explode("concurrent_to").alias("capture"), "id", "uri", "date", "fields")
    # Some writers name the request in the response instead.
    back = (
        found.where(F.col("type").isin(*CAPTURES))
        .select(F.col("id").alias("capture"), F.explode("concurrent_to").alias("other"))
        .join(own.select("id", "uri", "date", "fields"), F.col("other") == F.col("id"))
        .drop("other")
    )
    return named.unionByName(back)


def _nested(found: DataFrame, kind: str, name: str) -> DataFrame:
    record = F.struct("id", "uri", "date", "fields")
    nested = _beside(found, kind).groupBy("capture").agg(
        F.min_by(record, "id").alias(name), F.count_distinct("id").alias(f"n_{name}")
    )
    # Written out, so that the join below may be split where a capture id is frequent.
    table, _ = write_table(nested.withColumnRenamed("capture", f"{name}_of"), name)
    return table


def assemble(found: DataFrame) -> DataFrame:
    """One row per capture, with ``request`` and ``metadata`` nested.

    A revisit gets the length of the payload it revisits and, as ``original``, the
    response of that digest: its id and metadata fields.
    """
    captures = found.where(F.col("type").isin(*CAPTURES))
    whole = captures
    for kind, name in (("request", "requests"), ("metadata", "metadata")):
        side = _nested(found, kind, name)
        whole = whole.join(side, F.col("id") == F.col(f"{name}_of"), "left").drop(f"{name}_of")
    rows = whole.select(
        "id", "type", "uri", "date", "digest", "payload_bytes", "payload",
        F.col("requests").alias("request"),
        F.coalesce("n_requests", F.lit(0)).alias("n_requests"),
        "metadata",
        F.coalesce("n_metadata", F.lit(0)).alias("n_metadata"),
    )
    originals, _ = write_table(
        rows.where("type = 'response'")
        .groupBy("digest")
        .agg(
            F.min_by(
                F.struct("id", "payload_bytes", F.col("metadata.fields").alias("fields")), "id"
            ).alias("original")
        )
        .withColumnRenamed("digest", "o_digest"),
        "originals",
    )
    revisit = F.col("type") == "revisit"
    return rows.join(originals, revisit & (F.col("digest") == F.col("o_digest")), "left").select(
        "id", "type", "uri", "date", "digest",
        F.when(revisit, F.col("original.payload_bytes"))
        .otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        "payload", "request", "n_requests", "metadata", "n_metadata", "original",
    )


def loose_records(found: DataFrame) -> DataFrame:
    """Requests and metadata that :func:`assemble` nests nowhere, and all other records."""
    captures = found.where(F.col("type").isin(*CAPTURES)).select(F.col("id").alias("c"))
    nested = None
    for kind in ("request", "metadata"):
        beside = _beside(found, kind).join(captures, F.col("capture") == F.col("c"), "left_semi")
        kept = beside.groupBy("capture").agg(F.min("id").alias("nested_id")).select("nested_id")
        nested = kept if nested is None else nested.unionByName(kept)
    rest = found.where(~F.coalesce(F.col("type").isin(*CAPTURES), F.lit(False)))
    return rest.join(nested.distinct(), F.col("id") == F.col("nested_id"), "left_anti")
