"""Web archives: captures written as records, and assembled again from what is read.

A capture is a response (or a revisit of an earlier payload) with the request and the metadata that
name it in ``WARC-Concurrent-To``. Reading parses whatever archives there are; assembly brings
the records of a capture together by these identifiers into one nested row.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import full_text, hot_keys, named_key, python_tasks, skewed_join, written

#: Captures of a file at most, and bytes of their payloads (or one capture), so that a task can hold a file.
FILE_CAPTURES = 1000
FILE_BYTES = 64 << 20
#: Payloads of fewer bytes are never written as revisits.
REVISIT_BYTES = 0
DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = "\r\n"


def base32_sha1(value: Column) -> Column:
    """SHA-1 in base 32: five hexadecimal digits are four of base 32 (0-9A-V, then renamed)."""
    digits = F.sha1(value)
    parts = [F.lpad(F.conv(F.substring(digits, i, 5), 16, 32), 4, "0") for i in range(1, 41, 5)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def record_id(kind: str, *parts: Column) -> Column:
    """A name that depends on the kind and parts only."""
    h = F.md5(F.concat_ws("\x1f", F.lit(kind), *parts))
    groups = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *groups), F.lit(">"))


def _record(headers: list[tuple[str, Column | str | None]], block: Column) -> Column:
    """A record without the two line ends that close it. Headers that are null are left out."""
    lines = [F.lit("WARC/1.1" + _END)]
    for name, value in headers:
        value = F.lit(value) if isinstance(value, str) else value
        lines.append(F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(_END)), F.lit("")))
    length = F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(_END + _END))
    return F.concat(*lines, length, block)


def captures(pages: DataFrame, id_column: str, url_column: str, html_column: str, revisit_bytes: int) -> DataFrame:
    """Pages with their record's name and, for a revisit, that of the response it refers to."""
    html = full_text(html_column)
    own = pages.select(
        F.col(id_column).cast("long").alias("page_id"),
        F.regexp_replace(F.col(url_column), r"[\x00-\x1f\x7f]", "").alias("url"),
        html.alias("html"),
        F.unhex(F.sha2(html, 256)).alias("payload"),
    )
    groups = own.groupBy("payload").agg(
        F.max(F.struct("page_id", "url")).alias("best"), F.count(F.lit(1)).alias("n")
    )
    groups = written(groups.select("payload", "best.page_id", "best.url", "n"), "warc-payloads")
    hot = hot_keys(groups, ["payload"], "n", groups.select(F.sum("n")).first()[0] or 0)
    best = groups.select("payload", F.col("page_id").alias("best_id"), F.col("url").alias("best_url"))
    name = lambda i, u: record_id("capture", named_key(i), named_key(u), F.hex("payload"))
    first = F.col("page_id").eqNullSafe(F.col("best_id")) & F.col("url").eqNullSafe(F.col("best_url"))
    again = ~first & (F.octet_length("html") >= revisit_bytes)
    return skewed_join(own, best, ["payload"], hot).select(
        "page_id", "url", "html", name("page_id", "url").alias("name"),
        F.when(again, name("best_id", "best_url")).alias("refers_to"),
    )


def write_archives(
    captured: DataFrame, path: str, file_captures: int = FILE_CAPTURES, file_bytes: int = FILE_BYTES
) -> None:
    """Write each capture's three records to compressed archives, in folders by size.

    A record is text in UTF-8 and ends with two line ends, which is what a text writer with that
    line separator writes. Captures are parted by their payload's bytes into small ones, of which
    ``file_captures`` fit into ``file_bytes``, middle ones, of which the square root of that many do,
    and large ones, which have a file each.
    """
    middle = max(1, round(file_captures**0.5))
    size, limits = F.octet_length("html"), [0, *[file_bytes // n + 1 for n in (file_captures, middle)]]
    for name, least, beyond, most in zip(("small", "middle", "large"), limits, [*limits[1:], None], (file_captures, middle, 1)):
        some = captured.where(size >= least)
        _write_some(some if beyond is None else some.where(size < beyond), f"{path}/{name}", most)


def _write_some(captured: DataFrame, path: str, file_captures: int) -> None:
    payload, refers = F.col("html"), F.col("refers_to")
    digest = F.concat(F.lit("sha1:"), base32_sha1(payload))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{_END}Content-Type: text/html; charset=utf-8{_END}Content-Length: "),
        F.octet_length(payload).cast("string"),
        F.lit(_END + _END),
    )
    common = [("WARC-Date", DATE), ("WARC-Target-URI", F.col("url"))]
    response = _record(
        [
            ("WARC-Type", F.when(refers.isNull(), "response").otherwise("revisit")),
            ("WARC-Record-ID", F.col("name")),
            *common,
            ("WARC-Payload-Digest", digest),
            ("WARC-Refers-To", refers),
            ("WARC-Profile", F.when(refers.isNotNull(), _PROFILE)),
            ("Content-Type", "application/http; msgtype=response"),
        ],
        F.when(refers.isNull(), F.concat(http, payload)).otherwise(http),
    )
    request = _record(
        [
            ("WARC-Type", "request"),
            ("WARC-Record-ID", record_id("request", F.col("name"))),
            *common,
            ("WARC-Concurrent-To", F.col("name")),
            ("Content-Type", "application/http; msgtype=request"),
        ],
        F.concat(F.lit("GET "), F.coalesce("url", F.lit("")), F.lit(f" HTTP/1.1{_END}{_END}")),
    )
    fields = F.coalesce(F.concat(F.lit("page_id: "), F.col("page_id").cast("string"), F.lit(_END)), F.lit(""))
    metadata = _record(
        [
            ("WARC-Type", "metadata"),
            ("WARC-Record-ID", record_id("metadata", F.col("name"))),
            *common,
            ("WARC-Concurrent-To", F.col("name")),
            ("Content-Type", "application/warc-fields"),
        ],
        fields,
    )
    both = _END + _END
    text = F.concat(request, F.lit(both), response, F.lit(both), metadata)
    captured.select(text.alias("value")).write.option("lineSep", both).option("compression", "gzip").option(
        "maxRecordsPerFile", file_captures
    ).text(path)


class Rejected(Exception):
    """Why a record of an archive can't be read."""


def parse(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers by lower-case name, block) of each record of an archive, by its stated length.

    A header line that begins with a space or tab goes on with the line before. What can't be read is
    handed on as headers without a type, with the reason under ``rejected``, and reading goes on at the
    next line that begins a record; an archive that is cut or damaged ends there.
    """
    try:
        line = stream.readline()
        while line:
            if not line.strip():
                line = stream.readline()
                continue
            try:
                yield _record_after(line, stream)
                line = stream.readline()
            except Rejected as problem:
                yield {"rejected": str(problem)}, b""
                line = stream.readline()
                while line and not line.startswith(b"WARC/"):
                    line = stream.readline()
    except (EOFError, OSError, zlib.error):
        yield {"rejected": "archive is cut or damaged"}, b""


def _record_after(line: bytes, stream) -> tuple[dict[str, str], bytes]:
    if not line.startswith(b"WARC/"):
        raise Rejected("no version line")
    headers, name = {}, None
    while (line := stream.readline()).strip():
        text = line.decode("utf-8", "replace")
        if text[0] in " \t" and name is not None:
            headers[name] = f"{headers[name]} {text.strip()}".strip()
            continue
        name, _, value = text.partition(":")
        name = name.strip().lower()
        headers[name] = value.strip()
    length = headers.get("content-length", "")
    if not (length.isascii() and length.isdigit()):
        raise Rejected("no content length")
    if "warc-type" not in headers:
        raise Rejected("no type")
    block = stream.read(int(length))
    if len(block) < int(length):
        raise Rejected("block is cut")
    headers.pop("rejected", None)
    return headers, block


_RECORDS = pa.schema(
    [("kind", pa.string()), ("name", pa.string()), ("concurrent_to", pa.string()), ("refers_to", pa.string()),
     ("uri", pa.string()), ("digest", pa.string()), ("length", pa.int64()), ("fields", pa.string()), ("payload", pa.string())]
)
_RECORDS_SQL = (
    "kind STRING, name STRING, concurrent_to STRING, refers_to STRING, uri STRING, digest STRING, "
    "length LONG, fields STRING, payload STRING"
)
#: The kind of what can't be read as a record; its reason is in ``fields``.
REJECTED = "rejected"
#: Bytes of blocks after which a batch of records is handed on.
_BATCH_BYTES = 4 << 20


def _parsed(headers: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    if "rejected" in headers:
        return (REJECTED, *[None] * 6, headers["rejected"], None)
    kind = headers["warc-type"]
    digest = headers.get("warc-payload-digest", "").rpartition(":")[2] or None
    length, fields, payload = None, None, None
    if kind == "response":
        body = block.partition(b"\r\n\r\n")[2]
        length, digest = len(body), base64.b32encode(hashlib.sha1(body).digest()).decode()
        payload = body.decode("utf-8", "replace") if with_payload else None
    elif kind == "metadata":
        fields = block.decode("utf-8", "replace")
    elif kind == "request":
        fields = block.partition(b"\r\n")[0].decode("utf-8", "replace")
    names = ("warc-record-id", "warc-concurrent-to", "warc-refers-to", "warc-target-uri")
    return (kind, *(headers.get(n) for n in names), digest, length, fields, payload)


def _read(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows, held = [], 0
                data = io.BytesIO(content.as_py())
                stream = gzip.open(data) if data.getvalue()[:2] == b"\x1f\x8b" else data
                for headers, block in parse(stream):
                    rows.append(_parsed(headers, block, with_payload))
                    held += len(block)
                    if held > _BATCH_BYTES:
                        yield _batch(rows)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows), _RECORDS)], schema=_RECORDS
    )


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The records of all archives under a folder, in any order, and a row of kind ``rejected`` for what is none.

    An archive without records gives no rows.
    """
    python_tasks(spark)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    return files.mapInArrow(_read(with_payload), _RECORDS_SQL)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: name, capture, request, metadata, times.

    Requests and metadata name their capture in concurrent_to; a capture without them has null there,
    and a capture record that the archives hold several times (a page stored again) counts them
    in ``times``. Records that name a capture which is missing give no row.
    """
    main = F.col("kind").isin("response", "revisit")
    whole = F.struct("kind", "name", "refers_to", "uri", "digest", "length", "payload")
    part = F.struct("name", "fields")
    return (
        records.where(main | F.col("concurrent_to").isNotNull())
        .groupBy(F.when(main, F.col("name")).otherwise(F.col("concurrent_to")).alias("name"))
        .agg(
            F.max(F.when(main, whole)).alias("capture"),
            F.max(F.when(F.col("kind") == "request", part)).alias("request"),
            F.max(F.when(F.col("kind") == "metadata", part)).alias("metadata"),
            F.sum(main.cast("int")).alias("times"),
        )
        .where("capture is not null")
    )


def archive_pages(
    pages: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
    revisit_bytes: int = REVISIT_BYTES,
    path: str | None = None,
    with_payload: bool = True,
) -> DataFrame:
    """Write pages to archives (under ``path``, or the shared folder), read them back, one row per page.

    Columns: page_id, payload_bytes, payload_digest, record_type, refers_to and the nested
    capture, request and metadata. Of pages with equal payloads of ``revisit_bytes`` or more the one with
    the largest id is the response (of one id, that with the greatest URL), the others revisit it.

    A null html is an empty payload, a null id the smallest; a null URL is left out of the record and
    control characters out of any; rows that repeat are one capture stored several times and come
    back as often, responses all; an empty table gives no rows.
    """
    path = path or scratch_path(pages.sparkSession, "warc")
    write_archives(captures(pages, id_column, url_column, html_column, revisit_bytes), path)
    found = assemble(read_archives(pages.sparkSession, path, with_payload))
    page_id = F.regexp_extract("metadata.fields", r"(?:^|\n)page_id: (-?\d+)", 1)
    found = written(
        found.select(
            F.when(page_id != "", page_id).try_cast("long").alias("page_id"),
            F.coalesce("capture.refers_to", "capture.name").alias("payload_of"),
            "capture", "request", "metadata", "times",
        ),
        "captures",
    )
    counts = found.groupBy("payload_of").agg(F.count(F.lit(1)).alias("n"))
    hot = written(hot_keys(counts, ["payload_of"], "n", max(1, found.count())), "warc-hot")
    responses = found.where("capture.kind = 'response'").select(
        "payload_of", F.col("page_id").alias("response_id"), F.col("capture.length").alias("payload_bytes")
    )
    out = skewed_join(found, responses, ["payload_of"], hot)
    out = out.withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    return out.select(
        "page_id", "payload_bytes", F.col("capture.digest").alias("payload_digest"),
        F.col("capture.kind").alias("record_type"),
        F.when(F.col("capture.kind") == "revisit", F.col("response_id")).alias("refers_to"),
        "capture", "request", "metadata",
    )
