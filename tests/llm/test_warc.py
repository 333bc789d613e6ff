import base64
import hashlib

import pytest

from keelson.llm import queries as Q
from keelson.llm import warc as W
from tests.conftest import SF_SMALL
from tests.oracle import duck, duck_rows, spark_rows

MARK = b"\r\n\r\nWARC/1.1\r\n"


def record(kind, name, block, extra=b"", version=b"1.0"):
    return (b"WARC/" + version + b"\r\nWARC-Type: " + kind + b"\r\nwarc-record-id: <" + name
            + b">\r\n" + extra + b"content-length: " + str(len(block)).encode() + b"\r\n\r\n"
            + block + b"\r\n\r\n")


def wanted(pages):
    """(page_id, bytes, digest, type, refers_to) of (page_id, payload) rows."""
    newest = {}
    for page, body in pages:
        if page is not None:
            newest[body] = max(newest.get(body, page), page)
    out = []
    for page, body in pages:
        best = newest.get(body)
        older = best is not None and (page is None or page < best)
        data = (body or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page, len(data), digest, "revisit" if older else "response",
                    best if older else None))
    return sorted(out, key=str)


@pytest.fixture()
def small_splits(spark):
    """Splits of a few hundred bytes, so that records and marks cross them."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_query_against_oracle(spark):
    con = duck(SF_SMALL)
    assert [sorted(x) for x in spark_rows(Q.op12_warc(spark, SF_SMALL))] == \
        [sorted(x) for x in duck_rows(con, W.oracle())]


AWKWARD = [
    (1, "plain"), (2, None), (3, ""), (4, "plain"), (4, "plain"), (None, "plain"), (None, "alone"),
    (5, "tail\r\n\r\n"), (6, "\r\n"), (7, "WARC/1.1\r\nWARC-Type: response\r\n\r\n"),
    (8, "Ü漢🙂" * 300),
    (9, "before" + MARK.decode() + "WARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
        + "after" * 200),
    (10, (MARK.decode() + "Content-Length: 0\r\n\r\n") * 60),
    (11, "\r\n\r\nWARC/"), (12, MARK.decode() + "Content-Length: 99999999999999999\r\n\r\nx"),
    (13, "x" * 5000 + MARK.decode() + "y" * 5000 + MARK.decode()),
    (-14, "plain "), (15, "z" * 299), (16, MARK.decode() + "z" * 299),
]


def test_awkward_pages(spark, small_splits, tmp_path):
    rows = [(p, f"http://x/{i}\r\nWARC-Type: hidden\t" if i % 2 else None, b, "kept out")
            for i, (p, b) in enumerate(AWKWARD)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, refers_to string")
    wish = wanted([(p, b or "") for p, b in AWKWARD])
    for parts in (1, 3):
        got = W.archive_round_trip(pages.coalesce(1) if parts == 1 else pages.repartition(parts))
        assert sorted((tuple(r) for r in got.collect()), key=str) == wish
    # the operator gives the payloads themselves
    path = str(tmp_path / "out")
    W.write_warc(pages.coalesce(1), path)
    found = W.read_warc(spark, path)
    by_id = {r["record_id"]: r for r in W.resolved(found).collect()}
    for page, body in AWKWARD:
        data = (body or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        got = by_id[f"<urn:x-page:{'' if page is None else page}:{digest}>"]
        assert bytes(got["payload"]) == data and got["payload_digest"] == digest
    assert any(r["target_uri"] == "http://x/1%0D%0AWARC-Type: hidden%09" for r in found.collect())


def test_payloads_that_hold_records(spark, small_splits, tmp_path):
    """A false record in a payload whose end is a true boundary, one that
    jumps over true records, and one at the very start of a block."""
    true = record(b"resource", b"b", b"body of b" * 50)
    false_to_end = b"xx\r\n\r\n" + record(b"resource", b"no", b"q" * 400)[:-4]
    false_over = b"yy\r\n\r\n" + record(b"resource", b"no", b"q" * 1200)[:-1000]
    at_start = record(b"resource", b"no", b"inner") + b"..."
    data = (record(b"warcinfo", b"a", b"") + record(b"resource", b"c", false_to_end) + true
            + record(b"resource", b"d", false_over) + true + record(b"resource", b"e", at_start)
            + record(b"metadata", b"f", b"\x00\xff\xfe" * 700, b"X-Y: WARC/1.0\r\n", b"1.1"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.warc").write_bytes(data)
    (tmp_path / "in" / "two.warc").write_bytes(data * 3)
    rows = W.read_warc(spark, str(tmp_path / "in")).collect()
    bodies = {"a": b"", "b": b"body of b" * 50, "c": false_to_end, "d": false_over, "e": at_start,
              "f": b"\x00\xff\xfe" * 700}
    assert sorted(r["record_id"] for r in rows) == sorted(f"<{x}>" for x in "abbcdef" * 4)
    for r in rows:
        assert bytes(r["payload"]) == bodies[r["record_id"][1]], r["record_id"]
        assert r["http_head"] is None
    for name, times in (("one", 1), ("two", 3)):
        at = sorted(r["offset"] for r in rows if r["file"].endswith(f"{name}.warc"))
        assert at[0] == 0 and len(at) == 7 * times
        assert all(data[i % len(data):][:5] == b"WARC/" for i in at)


def test_broken_archives(spark, small_splits, tmp_path):
    good = record(b"resource", b"g", b"good" * 100)
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "cut.warc").write_bytes(good * 2 + good[:-30])  # the last record is incomplete
    (folder / "bad.warc").write_bytes(good + b"WARC/1.0\r\nno length\r\n\r\nxx\r\n\r\n" + good)
    (folder / "other.warc").write_bytes(b"not an archive" + MARK + b"content-length: 0\r\n\r\n")
    (folder / "empty.warc").write_bytes(b"")
    (folder / "gap.warc").write_bytes(good + b"junk" + good)
    counts = {}
    for r in W.read_warc(spark, str(folder)).collect():
        name = r["file"].rsplit("/", 1)[1]
        counts[name] = counts.get(name, 0) + 1
        assert bytes(r["payload"]) == b"good" * 100
    assert counts == {"cut.warc": 2, "bad.warc": 1, "gap.warc": 1}


def test_compressed_archives(spark, tmp_path):
    import gzip
    folder = tmp_path / "in"
    folder.mkdir()
    parts = [record(b"resource", b"%d" % i, b"body %d" % i * 300) for i in range(20)]
    (folder / "a.warc.gz").write_bytes(b"".join(map(gzip.compress, parts)))
    rows = W.read_warc(spark, str(folder)).collect()
    assert sorted(int(r["record_id"][1:-1]) for r in rows) == list(range(20))


def test_empty_table_and_least_bytes(spark, tmp_path):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert W.archive_round_trip(none).count() == 0
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "v", "abcd"), (4, "v", "abcd")],
                                  "page_id long, url string, html string")
    path = str(tmp_path / "out")
    W.write_warc(pages, path, least_bytes=3, records_per_file=1)
    kinds = {r["record_id"].split(":")[2]: r["warc_type"] for r in W.read_warc(spark, path).collect()}
    assert kinds == {"1": "response", "2": "response", "3": "revisit", "4": "response"}
