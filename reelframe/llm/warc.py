"""WARC archives: writer with revisit records and a salvage reader.

The writer is Spark's text writer whose line separator is the record separator,
so archives land in any file system that Spark can write.  The reader takes plain
archives and archives of gzip members.  Every record is checked (version line,
content length, separator, block and payload digests); after a failed check it
searches for the next member or version line that passes, recovers the records
behind it, and logs the bytes between as a quarantined gap; inside a gzip member of
several records it does the same over what could be inflated.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelframe.llm.common import join_checked, scratch, stored, table

REVISIT_BYTES = 100  # smaller payloads are always written in full
RECORDS_PER_FILE = 4000
SMALL = 1 << 14  # bytes; a file holds RECORDS_PER_FILE records up to this size, a quarter for each factor of 4
CRLF = "\r\n"
CHUNK = 1 << 16
READ_SCHEMA = ("path string, offset long, length long, kind string, reason string, record_type string, "
               "record_id string, target_uri string, refers_to string, payload_digest string, "
               "payload_bytes long, payload binary")


def with_revisits(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, refers_to (null:
    written in full).  Of equal payloads of at least 100 bytes the smallest
    page_id is the response (all rows that repeat it are), the others revisit it.
    Null ids come last: they are responses only if no row of the payload has an id.
    """
    p = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload"))
    p = p.withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    p = p.withColumn("payload_digest", F.sha2(F.col("payload").cast("binary"), 256))
    keys = p.where(F.col("payload_bytes") >= REVISIT_BYTES).select("page_id", "payload_digest")
    least = keys.groupBy("payload_digest").agg(F.min("page_id").alias("refers_to"),
                                               F.count("*").alias("n")).where("n > 1").drop("n")
    copies = stored(keys.join(least, "payload_digest").where(
        "refers_to IS NOT NULL AND NOT page_id <=> refers_to").distinct().select(
        F.col("page_id").alias("c_id"), F.col("payload_digest").alias("c_digest"), "refers_to"), "revisits")
    on = (p.payload_digest == copies.c_digest) & p.page_id.eqNullSafe(copies.c_id)
    return join_checked(p, copies, on, "left").drop("c_id", "c_digest")


def _header(name: str, value: Column) -> Column:
    """A header line; absent for null; line ends inside a value are escaped."""
    clean = F.regexp_replace(F.regexp_replace(value, "\r", "%0D"), "\n", "%0A")
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit(CRLF)), F.lit(""))


def _page_uri(col: str) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(col).cast("string"), F.lit("null")), F.lit(">"))


def write_warc(pages: DataFrame, path: str) -> None:
    """Write one record per row of ``with_revisits`` into plain WARC files of at most
    64 MB (headers apart), or of one record if that is larger.  Small records come into
    the folder itself, others into its folder ``large``: there each task sorts
    its records by size class and numbers them, and the numbers of a class make volumes."""
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit(CRLF + CRLF))
    body = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    head = F.concat(
        F.lit("WARC/1.1" + CRLF),
        _header("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _header("WARC-Record-ID", _page_uri("page_id")),
        _header("WARC-Date", F.lit("2024-01-01T00:00:00Z")),
        _header("WARC-Target-URI", F.col("url")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        _header("WARC-Block-Digest", F.concat(F.lit("sha256:"), F.sha2(F.col("body").cast("binary"), 256))),
        _header("WARC-Refers-To", F.when(revisit, _page_uri("refers_to"))),
        _header("WARC-Profile", F.when(revisit, F.lit(
            "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        _header("Content-Type", F.lit("application/http; msgtype=response")),
        _header("Content-Length", F.octet_length("body").cast("string")),
        F.lit(CRLF))
    # a line end of the url is written as three characters
    size = F.coalesce(3 * F.octet_length("url"), F.lit(0)) + F.when(revisit, 0).otherwise(F.col("payload_bytes"))
    pages = pages.withColumn("size", size)
    value = F.concat(head, F.col("body")).alias("value")
    (pages.where(F.col("size") <= SMALL).withColumn("body", body).select(value)
     .write.option("lineSep", CRLF + CRLF).option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))
    large = pages.where(F.col("size") > SMALL).withColumn("class", F.ceil(F.log(4.0, F.col("size") / SMALL)))
    row = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)  # inside the task
    each = F.greatest(F.lit(1), F.floor(RECORDS_PER_FILE / F.pow(F.lit(4.0), F.col("class"))))
    (large.sortWithinPartitions("class").withColumn("volume", F.concat_ws("-", "class", F.floor(row / each)))
     .withColumn("body", body).select(value, "volume")
     .write.partitionBy("volume").option("lineSep", CRLF + CRLF).text(f"{path}/large"))


VERSION = re.compile(rb"WARC/1\.[01]\r\n")
HEADER_END = re.compile(rb"\r\n(?:\r\n|WARC/1\.[01]\r\n)")  # or the next version line
START = re.compile(rb"WARC/1\.[01]\r\n|\x1f\x8b\x08")


def _digest_ok(said: str | None, data: bytes) -> bool:
    """Whether a labelled digest fits; unknown algorithms are not held against it."""
    if not said or ":" not in said:
        return True
    name, _, value = said.partition(":")
    if name.lower() != "sha256":
        return True
    return hashlib.sha256(data).hexdigest() == value.lower()


def parse_record(data: bytes, at: int) -> tuple[dict, int]:
    """The record at ``at`` and the offset behind its separator; ValueError names
    the failed check."""
    if not VERSION.match(data, at):
        raise ValueError("no version line")
    behind = HEADER_END.search(data, at)
    if not behind or behind[0] != b"\r\n\r\n":
        raise ValueError("header does not end")
    end = behind.start()
    fields: dict[str, str] = {}
    for line in data[at:end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise ValueError("bad header line")
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    size = fields.get("content-length", "")
    if not re.fullmatch("[0-9]{1,12}", size):
        raise ValueError("bad content length")
    start, stop = end + 4, end + 4 + int(size)
    if data[stop:stop + 4] != b"\r\n\r\n":
        raise ValueError("no separator behind the block")
    block = data[start:stop]
    if not _digest_ok(fields.get("warc-block-digest"), block):
        raise ValueError("block digest differs")
    kind = fields.get("warc-type")
    payload = block
    if kind in ("response", "revisit") and block.startswith(b"HTTP/"):
        http, _, payload = block.partition(b"\r\n\r\n")
        m = re.search(rb"(?i)\r\ncontent-length: *([0-9]+)", http)
        fields["payload-bytes"] = m[1].decode() if m else str(len(payload))
    if kind != "revisit" and not _digest_ok(fields.get("warc-payload-digest"), payload):
        raise ValueError("payload digest differs")
    fields["payload"] = payload
    return fields, stop + 4


def _inflate(data: bytes, at: int) -> tuple[bytes, int, str | None]:
    """What the gzip member at ``at`` holds, the offset behind it, and what is wrong
    with it (then what could be inflated before)."""
    unzip, parts, end = zlib.decompressobj(31), [], at
    while not unzip.eof and end < len(data):
        before = unzip.copy()
        try:
            parts.append(unzip.decompress(data[end:end + CHUNK]))
        except zlib.error as e:
            try:  # byte by byte up to the fault
                for i in range(end, min(end + CHUNK, len(data))):
                    parts.append(before.decompress(data[i:i + 1]))
            except zlib.error:
                pass
            return b"".join(parts), end, f"bad member: {e}"
        end = min(end + CHUNK, len(data))
    if not unzip.eof:
        return b"".join(parts), end, "member is cut off"
    return b"".join(parts), end - len(unzip.unused_data), None


def _member(data: bytes, at: int) -> tuple[list[tuple[str, object]], int | None, str | None]:
    """Records and gaps inside the gzip member at ``at``, the offset behind it (None:
    unknown) and its fault.  The last record of a faulty member may hold the fault and
    is given up.  ValueError if no record is left."""
    plain, end, fault = _inflate(data, at)
    inside = list(salvage(plain, members=False))
    if fault is not None:
        records = [(kind, what) for kind, *_, what in inside if kind == "record"][:-1]
        if not records:
            raise ValueError(fault)
        return records, None, fault
    if plain and not any(kind == "record" for kind, *_ in inside):
        raise ValueError(str(inside[0][3]))
    return [(kind, what if kind == "record" else f"bytes {o} to {o + n} of the member: {what}")
            for kind, o, n, what in inside], end, None


def _sound(data: bytes, at: int, members: bool) -> tuple[list[tuple[str, object]], int | None, str | None]:
    if members and data[at:at + 3] == b"\x1f\x8b\x08":
        return _member(data, at)
    record, end = parse_record(data, at)
    return [("record", record)], end, None


def salvage(data: bytes, members: bool = True) -> Iterator[tuple[str, int, int, object]]:
    """('record', offset, length, fields) and ('gap', offset, length, reason).  Records
    of a member, and gaps between them, have the member's offset and length."""
    at, ready = 0, None
    while at < len(data):
        try:
            found, end, fault = ready or _sound(data, at, members)
        except ValueError as e:
            found, end, fault = [], None, str(e)
        ready = None
        if end is None:  # search for the next member or version line that passes
            end = len(data)
            for m in (START if members else VERSION).finditer(data, at + 1):
                try:
                    ready = _sound(data, m.start(), members)
                except ValueError:
                    continue
                end = m.start()
                break
        for kind, what in found:
            yield kind, at, end - at, what
        if fault is not None:
            yield "gap", at, end - at, fault
        at = end


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in READ_SCHEMA.split(", ")]
    types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(c.split()[0], types[c.split()[1]]) for c in READ_SCHEMA.split(", ")])

    def pack(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], names=names)

    for batch in batches:
        for i in range(batch.num_rows):
            path, rows, size = batch.column(0)[i].as_py(), [], 0
            for kind, offset, length, what in salvage(batch.column(1)[i].as_py()):
                if kind == "gap":
                    rows.append((path, offset, length, kind, what, *[None] * 7))
                else:
                    digest = (what.get("warc-payload-digest") or "").partition(":")[2] or None
                    payload = what["payload"]
                    rows.append((path, offset, length, kind, None, what.get("warc-type"),
                                 what.get("warc-record-id"), what.get("warc-target-uri"),
                                 what.get("warc-refers-to"), digest,
                                 int(what.get("payload-bytes", len(payload))), payload))
                    size += len(payload)
                if size > 8 << 20 or len(rows) >= 2000:
                    yield pack(rows)
                    rows, size = [], 0
            if rows:
                yield pack(rows)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records and gaps of all archives under ``path`` (one row each; ``kind`` is
    record or gap).  A file is read whole by one task; the writer keeps files to
    64 MB.  Empty files give no rows."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
             .select("path", "content"))
    return files.mapInArrow(_read, READ_SCHEMA)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    write_warc(with_revisits(table(spark, sf_dir, "pages")), path)
    records = read_warc(spark, path).where("kind = 'record'")
    page = lambda c: F.expr(f"try_cast(regexp_extract({c}, '<urn:page:(-?[0-9]+)>', 1) AS bigint)")
    return records.select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                          page("refers_to").alias("refers_to"))
