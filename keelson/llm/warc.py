"""WARC archives, written and read by Spark, with boundary-chain verification.

Writing (``write_warc``): a response record for each page, or a revisit
record where the payload equals that of a page with a larger id. Payloads are
compared by SHA-256; those that occur twice are counted first and joined to
the pages (a broadcast join only if that table's size is under the session's
threshold). Records go through Spark's text writer with the records' blank
lines as line separator, so every part file is an archive.

Reading (``read_warc``): archives are split like any text, at
``CRLF CRLF WARC/``, which begins every record but a file's first; it may
also stand inside a payload. Each piece between two such marks is a
candidate record. A task, which holds the pieces of one split in order, emits
for each candidate its offset, the offset of the successor that its
Content-Length promises, and where the chain of successors leaves the split.
Offsets are taken from the start of the split; running totals of the splits'
lengths place them in the file. From the offset 0 of each file pointer
jumping follows the chains from split to split: each round doubles the
jumps, so the rounds are the logarithm of the splits in a file, over one row
for each place where some chain enters a split. Only candidates on the chain
from a file's start are records. A second scan parses them; payloads are not
shuffled, but for the rare pieces of records that hold a mark themselves,
which are joined by record.

A chain ends at the first candidate that is malformed or reaches beyond the
file's end; what follows it is not read. (A ``.gz`` archive is one split.)

Cases: a null payload is empty, and equal to other empty ones; of rows that
share the largest id of a payload, and of rows whose ids are all null, each
is a response; a null id next to others is a revisit; ids may repeat; a null
URL has no header, control characters in a URL are percent-encoded; very long
payloads are one record (up to Spark's 2 GB for a value); an empty table
makes an archive without records; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keelson.llm.text import staged
from keelson.session import scratch_path

BLANK = "\r\n\r\n"
MAGIC = "WARC/"
MARK = BLANK + MAGIC
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"
RECORDS_PER_FILE = 100_000
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"  # fixed values: digits of RFC 4648
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"  # digits of conv()
_LENGTH = re.compile(rb"\r\ncontent-length:[ \t]*(\d{1,18})[ \t]*(?:\r\n|$)", re.IGNORECASE)
_VERSION = re.compile(rb"\d+\.\d+[ \t]*\r\n")


def base32_sha1(payload: Column) -> Column:
    """The SHA-1 of bytes in upper-case base32: twenty bits at a time."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), _DIGITS, _BASE32)


# ---------------------------------------------------------------------------
# writing

def _escaped(url: Column) -> Column:
    escaped = url
    for code in [*range(32), 127]:
        escaped = F.replace(escaped, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return F.when(url.rlike(r"[\x00-\x1F\x7F]"), escaped).otherwise(url)


def _urn(page_id: Column, digest: Column) -> Column:
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(page_id.cast("string"), F.lit("")),
                    F.lit(":"), digest, F.lit(">"))


def with_originals(pages: DataFrame, page_id: str, payload: str, least_bytes: int) -> DataFrame:
    """``pages`` with ``refers_to``: the largest id among the rows of equal
    payload (of ``least_bytes`` or more), null for the rows that have it."""
    rows = pages.withColumn("__key", F.sha2(F.col(f"`{payload}`"), 256))
    counted = rows.filter(F.octet_length(F.col(f"`{payload}`")) >= least_bytes).groupBy("__key").agg(
        F.count(F.lit(1)).alias("__n"), F.max(F.col(f"`{page_id}`")).alias("__newest"))
    repeated = staged(counted.filter("__n > 1 and __newest is not null").drop("__n"), "originals")
    older = F.col(f"`{page_id}`").isNull() | (F.col(f"`{page_id}`") < F.col("__newest"))
    return rows.join(repeated, "__key", "left").withColumn(
        "refers_to", F.when(older, F.col("__newest"))).drop("__key", "__newest")


def write_warc(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url",
               payload: str = "html", least_bytes: int = 0, date: str = DATE,
               records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write a record for each page into the archives of a new folder."""
    rows = pages.select(
        F.col(f"`{page_id}`").cast("long").alias("page_id"), F.col(f"`{url}`").alias("url"),
        F.coalesce(F.col(f"`{payload}`").cast("binary"), F.lit(b"")).alias("payload"))
    rows = with_originals(rows, "page_id", "payload", least_bytes)
    rows = rows.withColumn("digest", base32_sha1(F.col("payload")))
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                          "Content-Length: "),
                    F.octet_length("payload").cast("string"), F.lit(BLANK))
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload").cast("string"))
    uri = F.coalesce(F.concat(F.lit("WARC-Target-URI: "), _escaped(F.col("url")), F.lit("\r\n")),
                     F.lit(""))
    origin = F.when(revisit, F.concat(
        F.lit(f"WARC-Profile: {PROFILE}\r\nWARC-Refers-To: "),
        _urn(F.col("refers_to"), F.col("digest")), F.lit("\r\n"))).otherwise(F.lit(""))
    record = F.concat(
        F.lit(f"{MAGIC}1.1\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), _urn(F.col("page_id"), F.col("digest")),
        F.lit(f"\r\nWARC-Date: {date}\r\n"), uri, origin,
        F.lit("WARC-Payload-Digest: sha1:"), F.col("digest"),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        (F.octet_length(http) + F.octet_length(body)).cast("string"), F.lit(BLANK), http, body)
    rows.select(record.alias("value")).write.option("lineSep", BLANK).option(
        "maxRecordsPerFile", records_per_file).text(path)


# ---------------------------------------------------------------------------
# reading

def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """The text between marks, with the split it begins in, in file order."""
    return spark.read.option("lineSep", MARK).text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.col("_metadata.file_size").alias("file_size"), F.col("value").cast("binary").alias("raw"))


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """For each batch, (file, split, file size, offset in the split, offset
    after the piece and its mark, piece) in order; the piece without the
    mark's ``WARC/``."""
    at, end = None, 0
    for batch in batches:
        out = []
        for file, split, size, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (file, split) != at:
                at, end = (file, split), 0
            start, end = end - len(MAGIC), end + len(raw) + len(MARK)
            if split == 0 and start < 0:  # the first of its file brings its own magic
                start, raw = 0, raw[len(MAGIC):] if raw.startswith(MAGIC.encode()) else b""
            out.append((file, split, size, start, end, raw))
        yield out


def _extent(raw: bytes) -> int | None:
    """The length of the record that begins with a piece, its blank lines
    included, by its header; None if the header is malformed."""
    head, _, _ = raw.partition(b"\r\n\r\n")
    found = _VERSION.match(raw) and _LENGTH.search(head)
    if not found:
        return None
    return len(MAGIC) + len(head) + int(found.group(1)) + 2 * len(BLANK)


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each split: its length and its candidates' offsets, their
    successors and where their chains leave the split (-1: nowhere)."""

    def row(at, total, starts, ends):
        leaves, known = [], {}
        for start, end in zip(reversed(starts), reversed(ends), strict=True):
            known[start] = out = known.get(end, end)
            leaves.append(out)
        leaves.reverse()
        columns = [[at[0]], [at[1]], [at[2]], [total], [starts], [ends], [leaves]]
        longs = pa.list_(pa.int64())
        types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), longs, longs, longs]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
            names=["file", "split", "file_size", "total", "starts", "ends", "leaves"])

    at, total, starts, ends = None, 0, [], []
    for file, split, size, start, after, raw in chain.from_iterable(_placed(batches)):
        if at is None or (file, split) != at[:2]:
            if at is not None:
                yield row(at, total, starts, ends)
            at, starts, ends = (file, split, size), [], []
        extent = _extent(raw)
        starts.append(start)
        # no record is empty, so an end at its own start means none
        ends.append(start if extent is None else start + extent)
        total = after
    if at is not None:
        yield row(at, total, starts, ends)


def _reached(splits: DataFrame) -> DataFrame:
    """file, split, entry: where the chain from the file's start enters each
    split it has records in, by pointer jumping."""
    chains = splits.select("file", "split", "base", F.explode(
        F.arrays_zip("starts", "leaves")).alias("c")).select(
        "file", "split", (F.col("base") + F.col("c.starts")).alias("at"),
        (F.col("base") + F.col("c.leaves")).alias("to"))
    # places where some chain may enter a split: a file's start, or where another chain leaves
    targets = chains.filter("at != to").select("file", F.col("to").alias("at")).distinct()
    places = staged(chains.join(targets, ["file", "at"], "left_semi")
                    .unionByName(chains.filter("at = 0")), "warc-places")
    most = splits.groupBy("file").count().agg(F.max("count")).first()[0] or 1
    reached, jumps = places.filter("at = 0").select("file", "at"), places.select("file", "at", "to")
    for _ in range(math.ceil(math.log2(most))):
        landed = reached.join(jumps, ["file", "at"]).select("file", F.col("to").alias("at"))
        reached = staged(reached.unionByName(landed).distinct(), "warc-reached")
        onward = jumps.select("file", F.col("at").alias("to"), F.col("to").alias("beyond"))
        jumps = staged(jumps.join(onward, ["file", "to"]).select(
            "file", "at", F.col("beyond").alias("to")), "warc-jumps")
    return places.join(reached, ["file", "at"], "left_semi").select(
        "file", "split", F.col("at").alias("entry"))


def verify(spark: SparkSession, path: str) -> DataFrame:
    """A row for each split of the archives: file, split, base (its first
    piece's offset), and ``strays``, a map of the pieces in it that are no
    record (offset in the split) to the offset of the record whose payload
    holds them (null: not reached from the file's start)."""
    splits = staged(_pieces(spark, path).mapInArrow(
        _candidates, "file string, split long, file_size long, total long, starts array<long>, "
                     "ends array<long>, leaves array<long>"), "warc-splits")
    order = Window.partitionBy("file").orderBy("split")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    splits = splits.withColumn("base", F.coalesce(F.sum("total").over(before), F.lit(0)))
    splits = splits.withColumn("limit", F.when(F.col("file").endswith(".gz"), F.sum("total").over(
        whole)).otherwise(F.col("file_size")))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stray = pa.struct([("at", pa.int64()), ("owner", pa.int64())])
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                base, ends = r["base"], dict(zip(r["starts"], r["ends"], strict=True))
                at = None if r["entry"] is None else r["entry"] - base
                kept = []
                while at in ends and ends[at] != at and base + ends[at] <= r["limit"]:
                    kept.append(at)
                    at = ends[at]
                strays, owner, on = [], None, 0
                for start in r["starts"]:
                    if on < len(kept) and kept[on] == start:
                        owner, on = start, on + 1
                    elif owner is None:
                        strays.append({"at": start, "owner": None})
                    elif start < ends[owner]:
                        strays.append({"at": start, "owner": base + owner})
                    else:
                        strays.append({"at": start, "owner": -1})
                out.append((r["file"], r["split"], base, strays,
                            base + kept[-1] if kept else None,
                            base + ends[kept[-1]] if kept else None))
            columns = list(zip(*out, strict=True)) or [[]] * 6
            types = [pa.string(), pa.int64(), pa.int64(), pa.list_(stray), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                names=["file", "split", "base", "found", "last", "last_end"])

    walked = splits.join(_reached(splits), ["file", "split"], "left").select(
        "file", "split", "base", "limit", "starts", "ends", "entry").mapInArrow(
        walk, "file string, split long, base long, found array<struct<at:long,owner:long>>, "
              "last long, last_end long")
    # pieces before a split's first record belong to the last record of the splits before
    walked = walked.withColumn("owner", F.last("last", ignorenulls=True).over(before)) \
        .withColumn("owner_end", F.last("last_end", ignorenulls=True).over(before))
    inside = F.transform("found", lambda s: F.struct(s["at"], F.when(
        s["owner"].isNull(), F.when(F.col("base") + s["at"] < F.col("owner_end"), F.col("owner")))
        .when(s["owner"] >= 0, s["owner"])))
    return staged(walked.select("file", "split", "base",
                                F.map_from_entries(inside).alias("strays")), "warc-verified")


def _offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each piece with its offset in its split."""
    for rows in _placed(batches):
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in
             ((0, pa.string()), (1, pa.int64()), (3, pa.int64()), (5, pa.binary()))],
            names=["file", "split", "at", "raw"])


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives in a folder: file, offset, warc_type,
    record_id, target_uri, warc_date, payload_digest (without ``sha1:``),
    refers_to, http_head (null but for HTTP messages), payload."""
    pieces = _pieces(spark, path).mapInArrow(
        _offsets, "file string, split long, at long, raw binary")
    held = pieces.join(verify(spark, path), ["file", "split"])
    stray = F.map_contains_key("strays", F.col("at"))
    text = F.col("raw").cast("string")
    head = F.substring_index(text, BLANK, 1)
    length = _field(head, "Content-Length").cast("long")
    complete = ~stray & (F.octet_length("raw") >= F.octet_length(head) + len(BLANK) + length)
    held = held.select("file", (F.col("base") + F.col("at")).alias("at"), "raw", F.when(
        stray, F.try_element_at("strays", F.col("at"))).otherwise(F.col("base") + F.col("at"))
        .alias("offset"), complete.alias("complete"))
    held = held.filter("offset is not null")
    joined = held.filter(~F.col("complete")).groupBy("file", "offset").agg(
        F.sort_array(F.collect_list(F.struct("at", "raw"))).alias("parts")).select(
        "file", "offset", F.array_join(F.transform(
            "parts", lambda p: p["raw"].cast("string")), MARK).cast("binary").alias("raw"))
    return _parsed(held.filter("complete").select("file", "offset", "raw").unionByName(joined))


def _field(head: Column, name: str) -> Column:
    """A header field's value, null if there is none."""
    found = F.regexp_extract(head, rf"(?i)\r\n{name}:[ \t]*([^\r\n]*?)[ \t]*(?=\r\n|$)", 1)
    return F.when(found != "", found)


def _parsed(records: DataFrame) -> DataFrame:
    """Fields and payloads of records (bytes after ``WARC/``)."""
    head = F.substring_index(F.col("raw").cast("string"), BLANK, 1)
    rows = records.withColumn("head", head)
    rows = rows.withColumn("block", F.substring(
        "raw", F.octet_length("head") + len(BLANK) + 1,
        _field(F.col("head"), "Content-Length").cast("int")))
    http = F.coalesce(_field(F.col("head"), "Content-Type").startswith("application/http"),
                      F.lit(False))
    rows = rows.withColumn("http_head", F.when(http, F.substring_index(
        F.col("block").cast("string"), BLANK, 1)))
    body = F.substring("block", F.octet_length("http_head") + len(BLANK) + 1,
                       F.octet_length("block"))
    return rows.select(
        "file", "offset", _field(F.col("head"), "WARC-Type").alias("warc_type"),
        _field(F.col("head"), "WARC-Record-ID").alias("record_id"),
        _field(F.col("head"), "WARC-Target-URI").alias("target_uri"),
        _field(F.col("head"), "WARC-Date").alias("warc_date"),
        F.regexp_replace(_field(F.col("head"), "WARC-Payload-Digest"), "^sha1:", "")
        .alias("payload_digest"),
        _field(F.col("head"), "WARC-Refers-To").alias("refers_to"), "http_head",
        F.when(http, body).otherwise(F.col("block")).alias("payload"))


def resolved(records: DataFrame) -> DataFrame:
    """Records with each revisit's payload filled in from the response it
    refers to (null if that isn't among the records). Equal responses count once."""
    originals = records.filter("warc_type = 'response'").groupBy("record_id").agg(
        F.min("payload").alias("__payload"))
    rows = records.join(originals.withColumnRenamed("record_id", "__of"),
                        F.col("refers_to") == F.col("__of"), "left")
    return rows.withColumn("payload", F.when(F.col("warc_type") == "revisit", F.col("__payload"))
                           .otherwise(F.col("payload"))).drop("__of", "__payload")


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of
    each page, from archives written of them and read back. A
    revisit's size is that of the HTTP message it stands for; a response's
    digest is that of the payload read."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_warc(pages, path)
    rows = read_warc(spark, path)
    revisit = F.col("warc_type") == "revisit"

    def page(urn: str) -> Column:
        found = F.regexp_extract(F.col(urn), r"^<urn:x-page:(-?\d+):", 1)
        return F.when(found != "", found.cast("long"))

    return rows.select(
        page("record_id").alias("page_id"),
        F.when(revisit, _field(F.col("http_head"), "Content-Length").cast("long"))
        .otherwise(F.octet_length("payload")).alias("payload_bytes"),
        F.when(revisit, F.col("payload_digest")).otherwise(base32_sha1(F.col("payload")))
        .alias("payload_digest"),
        F.col("warc_type").alias("record_type"), page("refers_to").alias("refers_to"))


def oracle() -> str:
    """What the archives must hold, for DuckDB."""
    digits = " || ".join(
        f"substr('{_BASE32}', (('0x' || substr(h, {5 * (i // 4) + 1}, 5))::bigint"
        f" >> {15 - 5 * (i % 4)}) % 32 + 1, 1)" for i in range(32))
    return f"""
with pages_ as (select page_id, coalesce(html, '') as body from pages),
hashed as (select page_id, body, sha1(body) as h,
                  max(page_id) over (partition by body) as newest from pages_)
select page_id, octet_length(encode(body))::bigint as payload_bytes, {digits} as payload_digest,
       case when page_id < newest then 'revisit' else 'response' end as record_type,
       case when page_id < newest then newest end as refers_to
from hashed"""
