"""WARC archives with a two-level capture index.

Archives are files of gzip members, one WARC/1.1 record each. Of pages with
equal payloads one is stored as a response; the others are revisit records that
name it. The capture index sorts lines by reversed-host key, cuts them into
compressed blocks and keeps, in a sparse directory, the first key of each
block. A lookup searches the directory for its blocks, the blocks for its
lines, and reads only the byte ranges that the lines name.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import even_parts, staged, tidy

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_LINE = "key string, page_id long, file string, offset long, length long, record_type string, digest string, refers_to long"
_BLOCK = "part long, block long, first_key string, first_page long, last_key string, last_page long, data binary"
_LINE_NAMES = [c.split()[0] for c in _LINE.split(", ")]
_LINE_TYPES = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]


def capture_key(url: str | None) -> str:
    """Reversed host, then path and query: ``http://www.a.org:80/x?y#z`` is ``org,a,www)/x?y``."""
    try:
        parts = urlsplit((url or "").strip())
        host, port = (parts.hostname or ""), parts.port
    except ValueError:
        return url or ""
    if not host:
        return url or ""
    port = f":{port}" if port and port != {"http": 80, "https": 443}.get(parts.scheme) else ""
    return ",".join(reversed(host.split("."))) + port + ")" + (parts.path or "/") + (f"?{parts.query}" if parts.query else "")


def target_uri(url: str | None) -> str:
    """The url as a header line holds it: control, blank and non-ASCII characters are escaped."""
    return quote(url or "", safe=":/?#[]@!$&'()*+,;=%~-._")


def _record_id(page_id) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def record(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """One WARC record; a revisit (``refers_to`` is set) has no payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_record_id(page_id)}",
            f"WARC-Date: {date}", f"WARC-Target-URI: {target_uri(url)}", "Content-Type: application/http; msgtype=response",
            f"WARC-Payload-Digest: sha1:{digest}", f"Content-Length: {len(block)}"]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(refers_to)}", f"X-Refers-To-Page-ID: {refers_to}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of a record."""
    end = raw.index(b"\r\n\r\n")
    head = dict(x.split(": ", 1) for x in raw[:end].decode().split("\r\n")[1:])
    block = raw[end + 4:end + 4 + int(head["Content-Length"])]
    return head, block[block.index(b"\r\n\r\n") + 4:]


def gzip_member(data: bytes) -> bytes:
    z = zlib.compressobj(4, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


@dataclass
class Store:
    """Folders of the archives, the index blocks and the block directory."""

    archives: str
    blocks: str
    directory: str

    def files(self, spark: SparkSession) -> DataFrame:
        return spark.read.format("binaryFile").load(self.archives).select(
            F.element_at(F.split("path", "/"), -1).alias("file"), "content")


def write_archives(pages: DataFrame, path: str, *, min_bytes: int = 0, file_bytes: int = 4 << 20,
                   date: str = "2024-01-01T00:00:00Z") -> None:
    """Write a record for each row of ``pages(page_id, url, html)``; a null ``html`` is an empty payload.

    Of the pages with one payload of at least ``min_bytes`` bytes that with the
    largest ``page_id`` is the response, the others revisit it; rows that repeat
    that ``page_id``, smaller payloads and rows with a null ``page_id`` are
    responses. Every file holds about ``file_bytes`` of compressed records.
    """
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    digests = staged(pages.where("page_id is not null").select(
        "page_id", F.sha1("payload").alias("digest"), F.octet_length("payload").alias("n")).where(F.col("n") >= min_bytes), "warc-digests")
    heads = digests.groupBy("digest", "n").agg(F.max("page_id").alias("head"), F.min("page_id").alias("least")).where("head > least")
    revisits = digests.join(heads, ["digest", "n"]).where("page_id <> head").select(
        "page_id", "digest", F.col("head").alias("refers_to")).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for page_id, url, payload, digest, refers_to in zip(*batch.columns):
                payload = payload.as_py()
                b32 = base64.b32encode(bytes.fromhex(digest.as_py())).decode()
                held.append(gzip_member(record(page_id.as_py(), url.as_py(), payload, b32, refers_to.as_py(), date)))
                size += len(held[-1])
                if size >= file_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], names=["value"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], names=["value"])

    typed = pages.withColumn("digest", F.sha1("payload")).hint("merge").join(revisits, ["page_id", "digest"], "left").select(
        "page_id", "url", "payload", "digest", "refers_to")
    # each row is a whole file; the zero byte that ends it is padding to a gzip reader
    typed.mapInArrow(tidy(run), "value binary").select(F.col("value").cast("string")).write.option("maxRecordsPerFile", 1) \
        .option("lineSep", "\u0000").text(path)


def _members(content: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, data) of the gzip members of a file; zero bytes between them are padding."""
    view, at = memoryview(content), 0
    while at < len(content):
        if content[at] == 0:
            at += 1
            continue
        z, data, end = zlib.decompressobj(31), [], at
        while not z.eof:
            data.append(z.decompress(view[end:end + (1 << 15)]))
            end += 1 << 15
        end = min(end, len(content)) - len(z.unused_data)
        yield at, end - at, b"".join(data)
        at = end


def build_index(spark: SparkSession, archives: str, index: str, *, lines_per_block: int = 512) -> Store:
    """Index of all records of ``archives``: blocks and directory under ``index``."""
    store = Store(archives, f"{index}/blocks", f"{index}/directory")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(*batch.columns):
                rows = []
                for offset, length, raw in _members(content.as_py()):
                    head, _ = parse_record(raw)
                    page, refers = head.get("X-Page-ID"), head.get("X-Refers-To-Page-ID")
                    rows.append((capture_key(head["WARC-Target-URI"]), int(page) if page else None, file.as_py(), offset, length,
                                 head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha1:"), int(refers) if refers else None))
                yield _lines(rows)

    lines = staged(store.files(spark).mapInArrow(tidy(read), _LINE), "warc-lines")
    parts = even_parts(lines)

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 32
        held: list[tuple] = []

        def flush():
            nonlocal number
            data = zlib.compress(json.dumps(held, ensure_ascii=False).encode())
            first, last = held[0], held[-1]
            out = pa.RecordBatch.from_pydict({"part": [number >> 32], "block": [number], "first_key": [first[0]], "first_page": [_page(first[1])],
                                              "last_key": [last[0]], "last_page": [_page(last[1])], "data": [data]})
            number += 1
            held.clear()
            return out

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                held.append(row)
                if len(held) == lines_per_block:
                    yield flush()
        if held:
            yield flush()

    # the page id is part of the order, so one url with very many captures spreads over ranges too
    lines.repartitionByRange(parts, "key", "page_id").sortWithinPartitions("key", "page_id", "file", "offset") \
        .mapInArrow(tidy(block), _BLOCK) \
        .write.parquet(store.blocks)
    spark.read.schema(_BLOCK).parquet(store.blocks).drop("data").write.parquet(store.directory)
    return store


def _page(page_id) -> int:
    return -(1 << 63) if page_id is None else page_id


def _lines(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * len(_LINE_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _LINE_TYPES)], names=_LINE_NAMES)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield {n: batch.column(i)[k] for i, n in enumerate(batch.schema.names)}


def lookup(spark: SparkSession, store: Store, keys: DataFrame) -> DataFrame:
    """Index lines of ``keys(key, page_id)``: all captures of a key, or that of one page if ``page_id`` is not null.

    Keys go to the part of the index that can hold them (its parts' first keys
    are the only thing on the driver), find their blocks there by binary search in the
    directory, and their lines by binary search in the block.
    """
    directory = spark.read.schema(_BLOCK).parquet(store.directory).drop("data")
    parts = even_parts(directory)
    # byte order is the order in which the index was sorted
    ranges = sorted(((r["k"]["first_key"] or "").encode(), r["k"]["first_page"], r["part"]) for r in directory.groupBy("part").agg(
        F.min(F.struct("first_key", "first_page")).alias("k")).collect())
    starts = [r[:2] for r in ranges]
    low, high = -(1 << 63), (1 << 63) - 1

    def span(key, page):
        key = (key or "").encode()
        return (key, low if page is None else page), (key, high if page is None else page)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                a, b = span(key, page)
                # a part holds the key if it starts at or before it and the next one starts at or after it
                for i in range(max(bisect_left(starts, a) - 1, 0), bisect_right(starts, b)):
                    out.append((ranges[i][2], 1, key, page, None))
            cols = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                cols, [pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64()])], names=["part", "kind", "key", "page_id", "block"])

    asked = keys.select(F.coalesce("key", F.lit("")).alias("key"), F.col("page_id").cast("long").alias("page_id")).distinct() \
        .mapInArrow(tidy(deal), "part long, kind int, key string, page_id long, block long")
    entries = directory.select("part", F.lit(0).alias("kind"), F.col("first_key").alias("key"),
                               F.col("first_page").alias("page_id"), "block")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in groupby(_rows(batches), key=lambda r: r["part"].as_py()):
            firsts, blocks, out = [], [], []
            for r in rows:
                if r["kind"].as_py() == 0:
                    firsts.append(((r["key"].as_py() or "").encode(), r["page_id"].as_py()))
                    blocks.append(r["block"].as_py())
                    continue
                key, page = r["key"].as_py(), r["page_id"].as_py()
                a, b = span(key, page)
                for i in range(max(bisect_left(firsts, a) - 1, 0), bisect_right(firsts, b)):
                    out.append((blocks[i], key, page))
            cols = list(zip(*out)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int64())],
                                             names=["block", "key", "page_id"])

    hits = entries.unionByName(asked).repartition(parts, "part").sortWithinPartitions("part", "kind", "block") \
        .mapInArrow(tidy(search), "block long, key string, page_id long")
    blocks = spark.read.schema(_BLOCK).parquet(store.blocks).select("block", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("key"),
                                                     F.lit(None).cast("long").alias("page_id"), "data")

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in groupby(_rows(batches), key=lambda r: r["block"].as_py()):
            order, lines, out = [], None, []
            data = None
            for r in rows:
                if r["kind"].as_py() == 0:
                    data = r["data"].as_py()
                    continue
                if lines is None:  # blocks that no key asks for stay compressed
                    lines = json.loads(zlib.decompress(data))
                    order = [((x[0] or "").encode(), _page(x[1])) for x in lines]
                a, b = span(r["key"].as_py(), r["page_id"].as_py())
                out += [tuple(x) for x in lines[bisect_left(order, a):bisect_right(order, b)]]
            yield _lines(out)

    return blocks.unionByName(hits.select("block", F.lit(1).alias("kind"), "key", "page_id", F.lit(None).cast("binary").alias("data"))) \
        .repartition(parts, "block").sortWithinPartitions("block", "kind").mapInArrow(tidy(take), _LINE)


_CAPTURE = pa.schema([("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("named_digest", pa.string()),
                      ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])


def read_captures(spark: SparkSession, store: Store, lines: DataFrame, *, payloads: bool = True) -> DataFrame:
    """The records of index lines, read from their byte ranges: ``page_id``, ``record_type``, ``refers_to``, the
    payload digest that the record names, and length, digest and (on request) bytes of the payload it holds."""
    files = store.files(spark).select("file", F.lit(-1).cast("long").alias("offset"), F.lit(0).cast("long").alias("length"), "content")
    asked = lines.select("file", "offset", "length", F.lit(None).cast("binary").alias("content"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        content, out, size = b"", [], 0

        def flush():
            cols = list(zip(*out)) or [()] * len(_CAPTURE)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _CAPTURE)], schema=_CAPTURE)

        for r in _rows(batches):
            if r["content"].is_valid:
                content = r["content"].as_py()
                continue
            at = r["offset"].as_py()
            head, payload = parse_record(zlib.decompress(content[at:at + r["length"].as_py()], 31))
            page, refers = head.get("X-Page-ID"), head.get("X-Refers-To-Page-ID")
            out.append((int(page) if page else None, head["WARC-Type"], int(refers) if refers else None,
                        head["WARC-Payload-Digest"].removeprefix("sha1:"), len(payload), sha1_base32(payload),
                        payload if payloads else None))
            size += len(payload)
            if size > 1 << 23:
                yield flush()
                out, size = [], 0
        yield flush()

    return files.unionByName(asked).repartition(even_parts(files), "file").sortWithinPartitions("file", "offset").mapInArrow(tidy(run), "page_id long, record_type string, refers_to long, named_digest string, payload_bytes long, payload_digest string, payload binary")


def fetch(spark: SparkSession, store: Store, url: str) -> list[dict]:
    """Captures of one url, each read by its byte range through the file system of the archives."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for r in lookup(spark, store, spark.createDataFrame([(capture_key(url), None)], "key string, page_id long")).collect():
        path = jvm.org.apache.hadoop.fs.Path(f"{store.archives}/{r['file']}")
        stream = path.getFileSystem(conf).open(path)
        try:
            stream.seek(r["offset"])
            raw = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream, r["length"]))
        finally:
            stream.close()
        head, payload = parse_record(zlib.decompress(raw, 31))
        out.append({"page_id": r["page_id"], "record_type": r["record_type"], "headers": head, "payload": payload})
    return out


def round_trip(pages: DataFrame, *, min_bytes: int = 0) -> DataFrame:
    """Archive ``pages``, index the archives, and read every capture back through the index.

    Returns ``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` for each row: length and bare
    base32 SHA-1 of the full payload, which a revisit takes from the response that it names. Rules for nulls, ties
    and repeated rows are those of ``write_archives``; other columns are ignored; an empty table gives no rows.
    """
    spark = pages.sparkSession
    root = scratch_path(spark, "warc")
    write_archives(pages, f"{root}/archives", min_bytes=min_bytes)
    store = build_index(spark, f"{root}/archives", f"{root}/index")

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([capture_key(target_uri(u)) for u in batch.column(1).to_pylist()], pa.string()),
                                              batch.column(0)], names=["key", "page_id"])

    asked = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url")).mapInArrow(tidy(keys), "key string, page_id long")
    # a key without a page id asks for all captures of the key, which other keys may ask for too
    lines = lookup(spark, store, asked).dropDuplicates(["file", "offset"])
    captures = staged(read_captures(spark, store, lines, payloads=False).drop("payload"), "warc-captures")
    responses = captures.where("record_type = 'response'")
    whole = responses.select(F.col("page_id").alias("refers_to"), F.col("named_digest"), F.col("payload_bytes").alias("n"),
                             F.col("payload_digest").alias("d")).distinct()
    revisits = captures.where("record_type = 'revisit'").drop("payload_bytes", "payload_digest").join(
        whole, ["refers_to", "named_digest"], "left").withColumnsRenamed({"n": "payload_bytes", "d": "payload_digest"})
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return responses.select(*columns).unionByName(revisits.select(*columns))


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()
