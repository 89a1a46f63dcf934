"""WARC archives of pages and a two-level capture index over them."""

from __future__ import annotations

import base64
import bisect
import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritab.llm.common import stored
from veritab.session import shared_path

#: Records of an archive, entries of a block of the index, and entries that the directory may have in all.
ARCHIVE_RECORDS, BLOCK_ENTRIES, DIRECTORY_ENTRIES = 10_000, 3000, 65_536
#: What Spark's text writer puts behind each record. Readers of gzip skip zero bytes between members.
PADDING = "\u0000"
DATE = "2024-01-01T00:00:00Z"
_CONTROL = re.compile(r"[\x00-\x20\x7f]")


def clean_url(url: str | None) -> str:
    """The address with control characters and blanks escaped; null counts as empty."""
    return _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url or "")


def reversed_host_key(url: str | None) -> str:
    """``https://www.example.org/a?b`` as ``org,example,www)/a?b``: pages of a host and its subdomains sort together."""
    url = clean_url(url)
    try:
        parts = urlsplit(url)
        host, port = (parts.hostname or ""), parts.port
    except ValueError:
        return f"){url}"
    if not host:
        return f"){url}"
    where = ",".join(reversed(host.split("."))) + (f":{port}" if port and port not in (80, 443) else "")
    return f"{where}){parts.path or '/'}{'?' + parts.query if parts.query else ''}"


def capture_key(url: str | None, page: int | None) -> str:
    """Keys sort by address, then by page; null pages come last."""
    return f"{reversed_host_key(url)} {'null' if page is None else format(page + (1 << 63), '020d')}"


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(page: int | None, row: int, url: str | None, payload: bytes, digest: str, refers: tuple | None) -> bytes:
    """One record as a gzip member of its own. Revisits carry the response's headers but no payload.

    refers: the response's page, in a tuple as it may be null; None for responses.
    """
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers else http + payload
    name = lambda p: f"urn:x-page:{'null' if p is None else p}:{digest}"
    fields = [
        ("WARC-Type", "revisit" if refers else "response"),
        ("WARC-Record-ID", f"<{name(page)}:{row}>"),
        ("WARC-Target-URI", clean_url(url)),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
    ]
    if refers:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", f"<{name(refers[0])}:response>")]
    else:
        fields[1] = ("WARC-Record-ID", f"<{name(page)}:{'response' if row < 0 else row}>")
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    pack = zlib.compressobj(5, zlib.DEFLATED, 31)
    return pack.compress(head.encode() + block + b"\r\n\r\n") + pack.flush()


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "row", "revisit", "to_page")]
        out = [
            _record(page, row, url, payload, base64.b32encode(digest).decode(), (to_page,) if revisit else None)
            for page, url, payload, digest, row, revisit, to_page in zip(*columns, strict=True)
        ]
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["member"])


def write_archives(pages: DataFrame, folder: str, least: int = 0) -> None:
    """Write a record for each page into archives in a folder, one gzip member each.

    Of pages with equal payloads of at least ``least`` bytes, the one with the largest page_id (null is the least) is
    a response, the others are revisits of it; of rows that agree in both, one is taken. Smaller payloads are all
    responses. A null html is an empty payload, a null url an empty address. Only digests are grouped and shuffled;
    payloads go straight from the table to the archives, unless the list of repeated digests is too large to be sent
    to all tasks. Rows that agree in page_id and payload are told apart on a stored copy of them.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.unhex(F.sha1("payload")))
    each = rows.where(F.length("payload") >= least).groupBy("digest", "page_id").agg(F.count(F.lit(1)).alias("n"))
    groups = each.groupBy("digest").agg(F.max(F.struct("page_id", "n")).alias("best"), F.sum("n").alias("n")).where("n > 1")
    groups = stored(groups.select(F.col("digest").alias("of_digest"), F.col("best.page_id").alias("to_page"), (F.col("best.n") > 1).alias("several")), "repeated")
    # row: a number that tells records of a page apart; -1 for the one that revisits refer to.
    joined = rows.join(groups, F.col("digest") == F.col("of_digest"), "left").withColumn("best", F.col("page_id").eqNullSafe(F.col("to_page")) & F.col("several").isNotNull())
    number = F.monotonically_increasing_id()
    columns = ["page_id", "url", "payload", "digest", "row", "revisit", "to_page"]
    plain = joined.where(~(F.col("best") & F.coalesce("several", F.lit(False))))
    plain = plain.withColumn("revisit", F.col("several").isNotNull() & ~F.col("best")).withColumn("row", F.when(F.col("best"), -1).otherwise(number))
    ties = stored(joined.where("best and several").withColumn("row", number), "ties")
    first = ties.groupBy("digest").agg(F.min("row").alias("first")).withColumnRenamed("digest", "of_digest")
    ties = ties.drop("of_digest").join(first, F.col("digest") == F.col("of_digest")).withColumn("revisit", F.col("row") != F.col("first"))
    ties = ties.withColumn("row", F.when(F.col("revisit"), F.col("row")).otherwise(-1))
    members = plain.select(*columns).unionByName(ties.select(*columns)).mapInArrow(_records, "member binary")
    # The writer puts a string's bytes as they are.
    members.select(F.col("member").cast("string")).write.option("lineSep", PADDING).option("maxRecordsPerFile", ARCHIVE_RECORDS).text(folder)


def members(data: bytes) -> Iterator[tuple[int, int, bytes]]:
    """Offset, length and contents of each gzip member of an archive."""
    view, at, step = memoryview(data), 0, 1 << 15
    while at < len(view):
        if view[at] == 0:  # padding
            at += 1
            continue
        unpack, parts, low = zlib.decompressobj(31), [], at
        while not unpack.eof:
            if low >= len(view):
                raise ValueError("archive ends within a record")
            parts.append(unpack.decompress(view[low : low + step]))
            low += step
        end = min(low, len(view)) - len(unpack.unused_data)
        yield at, end - at, b"".join(parts)
        at = end


def parse(record: bytes) -> dict:
    """Fields of a record, its page and the page that it refers to, and its payload."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    page = lambda urn: None if urn is None or (p := urn.split(":")[2]) == "null" else int(p)
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    out = {
        "page_id": page(fields["WARC-Record-ID"]),
        "url": fields["WARC-Target-URI"],
        "record_type": fields["WARC-Type"],
        "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        "payload_bytes": size,
        "refers_to": page(fields.get("WARC-Refers-To")),
        "payload": payload if fields["WARC-Type"] == "response" else None,
    }
    if out["payload"] is not None and _digest(payload) != out["payload_digest"]:
        raise ValueError(f"payload of page {out['page_id']} does not have its digest")
    return out


def _captures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, data in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
            rows = [(capture_key(r["url"], r["page_id"]), path, at, n) for at, n, raw in members(data) for r in [parse(raw)]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _ENTRY.types, strict=True)], schema=_ENTRY)


_ENTRY = pa.schema([("key", pa.string()), ("path", pa.string()), ("at", pa.int64()), ("length", pa.int64())])
_BLOCK = pa.schema([("first_key", pa.string()), ("entries", pa.int64()), ("data", pa.binary())])


def _index_blocks(entries: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines: list[tuple] = []

        def block(part):
            text = "\n".join("\t".join(map(str, x)) for x in part)
            return pa.RecordBatch.from_arrays([pa.array([part[0][0]]), pa.array([len(part)], pa.int64()), pa.array([zlib.compress(text.encode())], pa.binary())], schema=_BLOCK)

        for batch in batches:
            lines += zip(*[c.to_pylist() for c in batch.columns], strict=True)
            while len(lines) >= entries:
                yield block(lines[:entries])
                lines = lines[entries:]
        if lines:
            yield block(lines)

    return run


def _archives(spark, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("path", "content")


def build_index(spark, folder: str) -> DataFrame:
    """The capture index of a folder of archives: blocks of sorted entries, compressed, each with its first key.

    Archives are read as they are, member by member. Entries are sorted by reversed-host key over all archives; keys
    hold the page, so a host or an address of very many captures spreads over blocks and ranges.
    """
    captures = stored(_archives(spark, folder).mapInArrow(_captures, "key string, path string, at long, length long"), "captures")
    per_block = max(BLOCK_ENTRIES, -(-captures.count() // DIRECTORY_ENTRIES))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = captures.repartitionByRange(n, "key", "path", "at").sortWithinPartitions("key", "path", "at")
    blocks = ordered.mapInArrow(_index_blocks(per_block), "first_key string, entries long, data binary")
    return stored(blocks.withColumn("block", F.monotonically_increasing_id()), "index")


def directory(index: DataFrame) -> list[tuple[str, int]]:
    """First key and number of each block, sorted. All blocks are full but the last of each range, so there are at most
    ``DIRECTORY_ENTRIES`` entries and one per range, whatever the archives hold.
    """
    return sorted((r["first_key"], r["block"]) for r in index.select("first_key", "block").collect())


def blocks_of(listing: list[tuple[str, int]], key: str) -> list[int]:
    """Blocks that may hold a key: by binary search, the last that starts before it and all that start with it."""
    low = max(bisect.bisect_left(listing, (key,)) - 1, 0)
    high = bisect.bisect_right(listing, (key, 1 << 62))
    return [b for _, b in listing[low:high]]


def _find(batches_of_key, batches_of_block):
    wanted = {k for b in batches_of_key for k in b.column("key").to_pylist()}
    for batch in batches_of_block:
        for data in batch.column("data").to_pylist():
            lines = [x.split("\t") for x in zlib.decompress(data).decode().split("\n")]
            hits = [(k, p, int(a), int(n)) for k, p, a, n in lines if k in wanted]
            if hits:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*hits), _ENTRY.types, strict=True)], schema=_ENTRY)


def lookup(index: DataFrame, requests: DataFrame) -> DataFrame:
    """Entries (key, path, at, length) of requested pages. Requests: url, page_id; repeated ones are asked once.

    The sparse directory is searched for each request; each block that is hit is unpacked once.
    """
    listing = requests.sparkSession.sparkContext.broadcast(directory(index))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = [(b, k) for u, p in zip(*[c.to_pylist() for c in batch.columns], strict=True) for k in [capture_key(u, p)] for b in blocks_of(listing.value, k)]
            yield pa.RecordBatch.from_arrays([pa.array([h[0] for h in hits], pa.int64()), pa.array([h[1] for h in hits], pa.string())], names=["block", "key"])

    routed = requests.select("url", F.col("page_id").cast("long").alias("page_id")).mapInArrow(route, "block long, key string").distinct()
    return routed.groupBy("block").cogroup(index.groupBy("block")).applyInArrow(_tables(_find, _ENTRY), "key string, path string, at long, length long")


def _tables(find, schema):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return pa.Table.from_batches(list(find(left.to_batches(), right.to_batches())), schema=schema)

    return run


_RECORD = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.int64()), ("payload", pa.binary())])


def read_records(spark, folder: str, entries: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records at entries: of each archive that is asked for, only the ranges of its entries are unpacked."""

    def cut(batches_of_entry, batches_of_archive):
        wanted = [(a, n) for b in batches_of_entry for a, n in zip(b.column("at").to_pylist(), b.column("length").to_pylist(), strict=True)]
        for batch in batches_of_archive:
            for data in batch.column("content").to_pylist():
                rows = [parse(zlib.decompress(memoryview(data)[a : a + n], 31)) for a, n in wanted]
                if not with_payload:
                    for r in rows:
                        r["payload"] = None
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_RECORD)

    archives = _archives(spark, folder)
    kind = "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, payload binary"
    return entries.groupBy("path").cogroup(archives.groupBy("path")).applyInArrow(_tables(cut, _RECORD), kind)


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write archives of all pages, index them, look every page up, and read its record back.

    Returns page_id, payload_bytes, payload_digest, record_type, refers_to, one row per page. An empty table gives
    none. Other columns are ignored.
    """
    spark = pages.sparkSession
    folder = shared_path(spark, "llm-warc")
    narrow = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    write_archives(narrow, folder)
    index = build_index(spark, folder)
    found = lookup(index, narrow.select("url", "page_id"))
    return read_records(spark, folder, found, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
