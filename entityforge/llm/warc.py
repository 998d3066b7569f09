"""WARC archives: writing captures, reading records back, assembling transactions.

Archives are written by Spark's text writer, so they can go to any store that Spark reaches: a row
is a record, and the line separator is the blank lines that end a record. They are gzip files of
WARC/1.1 records. Each capture is three records: the request and a metadata record name the
response (or revisit) in WARC-Concurrent-To, and only together they tell which page was captured.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entityforge.llm.columns import Columns, as_columns, map_columns, names
from entityforge.llm.ranking import ordered_table, with_prefix
from entityforge.llm.scratch import Scratch, small_or_shuffled

END = "\r\n\r\n"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes of an archive file before compression, at the mean size of a page, and records of one at most.
FILE_BYTES, RECORDS_PER_FILE = 256 << 20, 12_000


def base32_of_hex(digest: Column) -> Column:
    """Upper-case base32 of 40 hexadecimal digits, five digits (20 bits) at a time."""
    letters = []
    for g in range(8):
        bits = F.conv(F.substring(digest, 5 * g + 1, 5), 16, 10).cast("int")
        letters += [F.substring(F.lit(ALPHABET), F.shiftright(bits, shift).bitwiseAND(31) + 1, F.lit(1)) for shift in (15, 10, 5, 0)]
    return F.concat(*letters)


def _record_id(kind: str, *parts: Column) -> Column:
    h = F.md5(F.concat_ws("\n", F.lit(kind), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _record(kind: Column | str, uri: Column, date: str, record_id: Column, content_type: str, block: Column, *more: tuple[str, Column]) -> Column:
    """A record without the blank lines after it; headers whose value is null are left out."""
    fields = [
        ("WARC-Type", F.lit(kind) if isinstance(kind, str) else kind),
        ("WARC-Record-ID", record_id),
        ("WARC-Date", F.lit(date)),
        ("WARC-Target-URI", uri),
        *more,
        ("Content-Type", F.lit(content_type)),
        ("Content-Length", F.octet_length(block).cast("string")),
    ]
    lines = [F.concat(F.lit(f"{name}: "), value) for name, value in fields]
    return F.concat(F.concat_ws("\r\n", F.lit("WARC/1.1"), *lines), F.lit(END), block)


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> None:
    """Writes the captures of `pages` (page_id, url, html) as WARC archives under `path`.

    Of pages with equal payloads of at least `min_bytes` bytes, the one with the largest page_id
    (null is smallest; ties: largest url, then one of the rows that are alike in all) is written as
    response, the others as revisits of it, which keep the HTTP headers but not the payload. A null
    html is an empty payload; a null url has no WARC-Target-URI; blanks and controls in urls are
    percent-encoded. Repeated rows are captures of their own, with record ids of their own. Other
    columns are not read; an empty table gives an empty folder.
    """
    spark = pages.sparkSession
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    base = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        F.col("url").isNotNull().alias("has_url"),
        html.alias("html"),
        F.octet_length(html).cast("long").alias("size"),
        F.sha1(html.cast("binary")).alias("sha1"),
    )
    key = ["sha1", "page_id", "url"]
    scratch = Scratch(spark, "warc")
    alike = scratch.write(base.groupBy(*key).agg(F.count("*").alias("n"), F.max("size").alias("size")), "alike")
    groups = alike.filter(F.col("size") >= min_bytes).groupBy("sha1").agg(F.sum("n").alias("n"), F.max(F.struct("page_id", "url")).alias("first"))
    shared = small_or_shuffled(scratch.write(groups.filter("n > 1").select(F.col("sha1").alias("_sha1"), "first"), "shared"))
    repeated = scratch.write(alike.filter("n > 1").select(*[F.col(c).alias(f"_{c}") for c in key]), "repeated")
    turned = base.withColumn("turn", F.lit(1))
    if repeated.limit(1).count():
        # a number for each of the rows that are alike, by their place in a table of them: no task has all rows of a key
        same = F.lit(True)
        for c in key:
            same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
        again = base.join(small_or_shuffled(repeated), same, "left_semi")
        again = scratch.write(with_prefix(ordered_table(scratch, again, key, "again"), {"place": F.lit(1)}).drop("place_all"), "placed")
        first = again.groupBy(*[F.col(c).alias(f"_{c}") for c in key]).agg(F.min("place").alias("_place"))
        again = again.join(small_or_shuffled(scratch.write(first, "first_places")), same).withColumn("turn", (F.col("place") - F.col("_place") + 1).cast("int"))
        again = again.select(*base.columns, "turn")
        turned = turned.join(small_or_shuffled(repeated), same, "left_anti").unionByName(again)
    known = turned.join(shared, (F.col("sha1") == F.col("_sha1")) & (F.col("size") >= min_bytes), "left")
    is_first = F.col("page_id").eqNullSafe(F.col("first.page_id")) & (F.col("url") == F.col("first.url")) & (F.col("turn") == 1)
    known = known.withColumn("revisit", F.col("_sha1").isNotNull() & ~is_first)
    uri = F.col("url")
    for c in "\t\n\x0b\x0c\r ":
        uri = F.replace(uri, F.lit(c), F.lit(f"%{ord(c):02X}"))
    uri = F.when(F.col("has_url"), uri)
    own = [F.col("page_id"), F.col("url"), F.col("sha1"), F.col("turn")]
    main = _record_id("response", *own)
    target = _record_id("response", F.col("first.page_id"), F.col("first.url"), F.col("sha1"), F.lit(1))
    digest = F.concat(F.lit("sha1:"), base32_of_hex(F.col("sha1")))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit(END))
    block = F.concat(http, F.when(F.col("revisit"), F.lit("")).otherwise(F.col("html")))
    fields = F.concat(F.coalesce(F.concat(F.lit("page-id: "), F.col("page_id").cast("string")), F.lit("page-id-missing: 1")), F.lit("\r\n"))
    response = _record(
        F.when(F.col("revisit"), F.lit("revisit")).otherwise(F.lit("response")), uri, date, main, "application/http;msgtype=response", block,
        ("WARC-Payload-Digest", digest), ("WARC-Refers-To", F.when(F.col("revisit"), target)), ("WARC-Profile", F.when(F.col("revisit"), F.lit(PROFILE))),
    )
    request = _record("request", uri, date, _record_id("request", *own), "application/http;msgtype=request", F.lit("GET / HTTP/1.1" + END), ("WARC-Concurrent-To", main))
    metadata = _record("metadata", uri, date, _record_id("metadata", *own), "application/warc-fields", fields, ("WARC-Concurrent-To", main))
    records = known.select(F.explode(F.array(response, request, metadata)).alias("value"))
    mean = alike.agg(F.sum(F.col("n") * F.col("size")) / F.sum("n")).first()[0] or 0
    per_file = min(max(3 * int(FILE_BYTES / (mean + 2000)), 3), RECORDS_PER_FILE)
    records.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", per_file).text(path)


RECORD = (
    "record_id string, type string, concurrent_to string, refers_to string, target_uri string, date string, "
    "payload_digest string, payload_bytes long, page_id long, payload binary"
)
_NAMES = names(RECORD)


def _headers(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8", "surrogateescape").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def parse_records(raw: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record in a stream of decompressed bytes; lengths come from Content-Length alone."""
    buffer = bytearray()

    def fill(n: int) -> bool:
        while len(buffer) < n:
            more = next(raw, None)
            if more is None:
                return False
            buffer.extend(more)
        return True

    while True:
        while buffer[:2] == b"\r\n":  # blank lines that are left between records
            del buffer[:2]
        at, seen = -1, 0
        while (at := buffer.find(b"\r\n\r\n", max(0, seen - 3))) < 0:
            seen = len(buffer)
            if not fill(seen + 1):
                return
        headers = _headers(bytes(buffer[:at]))
        size = int(headers.get("content-length", "0"))
        if not fill(at + 4 + size):
            raise ValueError("archive ends inside a record")
        block = bytes(buffer[at + 4 : at + 4 + size])
        fill(at + 8 + size)
        del buffer[: at + 8 + size]
        yield headers, block


def _row(headers: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    kind = headers.get("warc-type")
    digest, size, payload, page_id = headers.get("warc-payload-digest", "").removeprefix("sha1:") or None, None, None, None
    if kind in ("response", "revisit"):
        top, _, body = block.partition(b"\r\n\r\n")
        size = int(_headers(top).get("content-length", len(body)))
        if kind == "response":
            size, digest = len(body), base64.b32encode(hashlib.sha1(body).digest()).decode()
            payload = body if with_payload else None
    elif kind == "metadata":
        page = _headers(b"\r\n" + block).get("page-id")
        page_id = int(page) if page is not None else None
    get = headers.get
    return get("warc-record-id"), kind, get("warc-concurrent-to"), get("warc-refers-to"), get("warc-target-uri"), get("warc-date"), digest, size, page_id, payload


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record of all archives under `path`.

    Archives are streamed, file after file of a task, cut at blank lines by Spark's text reader and
    put together again here, so that a task holds one record and not a file, however large. The
    digest and size of a response are those of the bytes read; a revisit has those that its headers
    state. `with_payload=False` leaves payloads out. Null values stay null; a folder without archives
    gives no rows.
    """

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        pieces = (piece + END.encode() for batch in batches for piece in batch["value"])
        rows, held = [], 0
        for headers, block in parse_records(pieces):
            rows.append(_row(headers, block, with_payload))
            held += len(block) if with_payload else 256
            if held > 8_000_000:
                yield as_columns(rows, _NAMES)
                rows, held = [], 0
        yield as_columns(rows, _NAMES)

    lines = spark.read.option("lineSep", END).option("pathGlobFilter", "*.gz").text(path)
    return map_columns(lines.select(F.col("value").cast("binary").alias("value")), run, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: main (response or revisit), request and metadata records.

    Records meet by the id that they are or that they name in WARC-Concurrent-To. A capture without
    request or metadata has null there; one whose main record is missing has a null main. Records
    repeated under one id are captures of their own.
    """
    one = F.struct(*_NAMES)
    key = F.coalesce("concurrent_to", "record_id")
    lists = records.groupBy(key.alias("capture_id")).agg(
        F.collect_list(F.when(F.col("type").isin("response", "revisit"), one)).alias("main"),
        F.collect_list(F.when(F.col("type") == "request", one)).alias("request"),
        F.collect_list(F.when(F.col("type") == "metadata", one)).alias("metadata"),
    )
    return lists.select("capture_id", F.explode(F.arrays_zip("main", "request", "metadata")).alias("x")).select("capture_id", "x.*")
