import gzip
import hashlib

from pyspark.sql import functions as F

from reelframe.llm import warc
from reelframe.llm.common import scratch

PAGES = "page_id long, url string, html string, payload string, kind string"


def record(text: str, name="x", digest=None, kind="response") -> bytes:
    block = text.encode()
    digest = digest or hashlib.sha256(block).hexdigest()
    return (f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:page:{name}>\r\n"
            f"WARC-Block-Digest: sha256:{digest}\r\nContent-Length: {len(block)}\r\n\r\n").encode() + block + b"\r\n\r\n"


def kinds(data: bytes):
    return [(k, o, n) for k, o, n, _ in warc.salvage(data)]


def test_salvage_of_plain_archives():
    a, b, c = record("first"), record("second WARC/1.1\r\n inside"), record("third é")
    assert kinds(a + b + c) == [("record", 0, len(a)), ("record", len(a), len(b)), ("record", len(a) + len(b), len(c))]
    broken = bytearray(b)
    broken[-8] ^= 1  # the block no longer fits its digest
    assert kinds(a + bytes(broken) + c) == [("record", 0, len(a)), ("gap", len(a), len(b)),
                                            ("record", len(a) + len(b), len(c))]
    cut = b[:40]
    assert kinds(a + cut + c) == [("record", 0, len(a)), ("gap", len(a), 40), ("record", len(a) + 40, len(c))]
    assert kinds(b"junk" + a) == [("gap", 0, 4), ("record", 4, len(a))]
    assert kinds(a + b"trailing") == [("record", 0, len(a)), ("gap", len(a), 8)]
    assert kinds(b"") == [] and kinds(b"only junk") == [("gap", 0, 9)]
    wrong = record("x").replace(b"Content-Length: 1", b"Content-Length: 7")
    assert [k for k, *_ in kinds(wrong + a)] == ["gap", "record"]


def test_salvage_of_members():
    a, b, c = (gzip.compress(record(t * 50)) for t in ("one", "two", "three"))
    assert kinds(a + b + c) == [("record", 0, len(a)), ("record", len(a), len(b)), ("record", len(a) + len(b), len(c))]
    broken = bytearray(b)
    broken[len(b) // 2] ^= 255
    assert kinds(a + bytes(broken) + c) == [("record", 0, len(a)), ("gap", len(a), len(b)),
                                            ("record", len(a) + len(b), len(c))]
    assert kinds(a + b[:-10]) == [("record", 0, len(a)), ("gap", len(a), len(b) - 10)]
    large = gzip.compress(record("".join(chr(97 + i * i % 26) for i in range(300_000))), 0)  # over several chunks
    assert kinds(large + a) == [("record", 0, len(large)), ("record", len(large), len(a))]
    two = gzip.compress(record("p") + record("q"))
    assert [f["payload"] for _, _, _, f in warc.salvage(two)] == [b"p", b"q"]


def test_salvage_inside_members_of_many_records():
    parts = [record(f"payload {i} " * 40, str(i)) for i in range(100)]
    payloads = [f"payload {i} ".encode() * 40 for i in range(100)]
    broken = bytearray(parts[50])
    broken[-8] ^= 1
    member = gzip.compress(b"".join(parts[:50]) + bytes(broken) + b"".join(parts[51:]))
    after = gzip.compress(record("after"))
    got = list(warc.salvage(member + after))
    assert [f["payload"] for k, _, _, f in got if k == "record"] == payloads[:50] + payloads[51:] + [b"after"]
    gap = [(o, n, r) for k, o, n, r in got if k == "gap"]
    start = sum(map(len, parts[:50]))
    assert gap == [(0, len(member), f"bytes {start} to {start + len(parts[50])} of the member: block digest differs")]
    # a member that is cut off, or damaged in its middle, gives the records before the fault
    whole = gzip.compress(b"".join(parts))
    cut = list(warc.salvage(whole[:len(whole) * 2 // 3] + after))
    kept = [f["payload"] for k, _, _, f in cut if k == "record"]
    assert kept[-1] == b"after" and kept[:-1] == payloads[:len(kept) - 1] and len(kept) > 30
    assert [(k, o, n) for k, o, n, _ in cut if k == "gap"] == [("gap", 0, len(whole) * 2 // 3)]
    bad = bytearray(whole)
    bad[len(whole) // 2] ^= 255
    kept = [f["payload"] for k, _, _, f in warc.salvage(bytes(bad) + after) if k == "record"]
    assert kept[-1] == b"after" and set(kept[:-1]) <= set(payloads) and len(kept) > 20
    stored = gzip.compress(b"".join(parts), 0)  # not packed: the damage stays where it is
    bad = bytearray(stored)
    bad[len(stored) // 2] ^= 1
    kept = [f["payload"] for k, _, _, f in warc.salvage(bytes(bad)) if k == "record"]
    assert len(kept) >= 97 and set(kept) <= set(payloads)


def test_query_over_damaged_copies_of_its_archives(spark, tmp_path):
    from tests.llm.util import SF

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    path = str(tmp_path / "warc")
    warc.write_warc(warc.with_revisits(pages), path)
    lost = 0
    for file in sorted((tmp_path / "warc").glob("part-*")):
        data = bytearray(file.read_bytes())
        starts = [m.start() for m in warc.VERSION.finditer(bytes(data))]
        for at in starts[1::5]:
            data[at + 60] ^= 1  # in a header or block
            lost += 1
        (tmp_path / "damaged").mkdir(exist_ok=True)
        (tmp_path / "damaged" / file.name).write_bytes(bytes(data))
    rows = warc.read_warc(spark, str(tmp_path / "damaged")).collect()
    n = pages.count()
    assert lost > 5 and sum(r.kind == "record" for r in rows) >= n - lost
    whole = {(r.record_id, r.payload_digest) for r in warc.read_warc(spark, path).collect()}
    for r in rows:
        if r.kind == "record" and r.record_type == "response" and (r.record_id, r.payload_digest) in whole:
            assert hashlib.sha256(bytes(r.payload)).hexdigest() == r.payload_digest


def test_every_single_byte_flip_loses_one_record_at_most():
    parts = [record(f"payload {i} " * 3, str(i)) for i in range(3)]
    data = b"".join(parts)
    whole = [f["payload"] for _, _, _, f in warc.salvage(data)]
    for at in range(0, len(data), 7):
        bad = bytearray(data)
        bad[at] ^= 0x15
        got = list(warc.salvage(bytes(bad)))
        assert sum(n for *_, n, _ in got) == len(data)  # records and gaps cover the archive
        kept = [f["payload"] for k, _, _, f in got if k == "record"]
        assert len([p for p in kept if p in whole]) >= 2


def test_written_archives_are_read_back(spark):
    big = "<p>é</p>" * 50
    rows = [(3, "http://a/", big, "x", "y"), (1, "http://b/\r\nX: y", big, "x", "y"), (1, "http://b/\r\nX: y", big, "x", "y"),
            (9, None, big, None, None), (None, "u", big, "x", "y"), (4, "http://c/", None, "x", "y"),
            (5, "http://d/", "", "x", "y"), (6, "http://e/", "short", "x", "y"), (7, "http://f/", "short", "x", "y"),
            (8, "http://g/", "WARC/1.1\r\n\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 9, "x", "y")]
    df = spark.createDataFrame(rows, PAGES)
    path = scratch(spark, "warc-test")
    warc.write_warc(warc.with_revisits(df), path)
    got = warc.read_warc(spark, path).collect()
    assert {r.kind for r in got} == {"record"}
    assert len(got) == len(rows)
    by = sorted((r.record_id, r.record_type, r.refers_to or "") for r in got)
    page = "<urn:page:%s>"
    want = [(page % 1, "response", ""), (page % 1, "response", ""), (page % 3, "revisit", page % 1),
            (page % 9, "revisit", page % 1), (page % "null", "revisit", page % 1)]
    want += [(page % i, "response", "") for i in (4, 5, 6, 7, 8)]
    assert by == sorted(want)
    for r in got:
        html = next(h or "" for i, _, h, *_ in rows if page % ("null" if i is None else i) == r.record_id)
        assert r.payload_bytes == len(html.encode())
        assert r.payload_digest == hashlib.sha256(html.encode()).hexdigest()
        if r.record_type == "response":
            assert bytes(r.payload) == html.encode()
    assert {r.target_uri for r in got if r.record_id == page % 1} == {"http://b/%0D%0AX: y"}


def test_damaged_files_and_empty_tables(spark, tmp_path):
    a, b = record("first"), record("second", "2")
    (tmp_path / "x.warc").write_bytes(a + b"noise" + b)
    (tmp_path / "y.warc.gz").write_bytes(gzip.compress(a)[:-3] + gzip.compress(b))
    (tmp_path / "z.warc").write_bytes(b"")
    rows = warc.read_warc(spark, str(tmp_path)).collect()
    assert sorted((r.path[-6:], r.kind) for r in rows) == [("arc.gz", "gap"), ("arc.gz", "record"), ("x.warc", "gap"),
                                                           ("x.warc", "record"), ("x.warc", "record")]
    assert all(r.reason for r in rows if r.kind == "gap")
    empty = scratch(spark, "warc-empty")
    warc.write_warc(warc.with_revisits(spark.createDataFrame([], PAGES)), empty)
    assert warc.read_warc(spark, empty).count() == 0


def test_header_of_any_length(spark):
    url = "data:text/plain," + "x" * 100_000
    path = scratch(spark, "warc-long-header")
    pages = spark.createDataFrame([(1, url, "text", None, None), (2, "http://a/", "more", None, None)], PAGES)
    warc.write_warc(warc.with_revisits(pages), path)
    assert {r.record_id: r.target_uri for r in warc.read_warc(spark, path).collect()} == {
        "<urn:page:1>": url, "<urn:page:2>": "http://a/"}
    a = record("first")
    assert kinds(b"WARC/1.1\r\nX: y\r\n" + a) == [("gap", 0, 16), ("record", 16, len(a))]


def test_files_are_bounded_by_bytes(spark, tmp_path):
    """Pages of 1 MB in one task, short ones between them and one of 70 MB."""
    sizes = F.when(F.col("id") == 7, 70 << 20).when(F.col("id") % 3 == 0, 100).otherwise(1 << 20)
    pages = spark.range(0, 150, 1, 1).select(
        F.col("id").alias("page_id"), F.lit("http://a/").alias("url"),
        F.rpad(F.col("id").cast("string"), sizes.cast("int"), "x").alias("html"))
    path = tmp_path / "warc"
    warc.write_warc(warc.with_revisits(pages), str(path))
    files = [f.stat().st_size for f in path.rglob("part-*")]
    assert sum(size > (65 << 20) for size in files) == 1
    assert len(files) == 1 + 7 + 1  # 99 records a little above 1 MB, at most 15 to a file
    got = warc.read_warc(spark, str(path)).select("kind", "record_id", "payload_digest", F.sha2("payload", 256).alias("h"))
    rows = got.collect()
    assert {r.kind for r in rows} == {"record"} and all(r.payload_digest == r.h for r in rows)
    assert sorted(r.record_id for r in rows) == sorted(f"<urn:page:{i}>" for i in range(150))
