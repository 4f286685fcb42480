"""WARC archives with a two-level capture index.

**Archives.** Every page becomes a record, each its own gzip member, in files of bounded size written
by the tasks into the shared folder (temporary name, then rename; a repeated task replaces its own
files). Of pages with equal payloads of at least 1000 bytes the one with the largest id is a
``response``, the others are ``revisit`` records without payload that name it. Digests that repeat are
found by a grouped maximum over small rows; only pages that may be revisits are shuffled with
their decision.

**Index.** Captures are range-sorted by the URL with its host reversed (``org,example)/path``). Each
range writes one file of compressed blocks of 512 entries (key, page id, archive, offset, length) and a
row per block goes into the sparse directory. A look-up finds the block by binary search in the
directory, reads that byte range, searches the block, and reads the record's byte range; the query reads all
archives back in this way, asking for the pages' own URLs.

Cases: a null html is an empty payload; a null url has the empty key; a null id is allowed and never
referred to; rows that repeat an id and its payload are all responses if that id is the largest
(a page doesn't revisit itself); an empty table writes no archive and gives no row; other columns are
ignored. Control characters and blanks in URLs are percent-encoded in the header.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineweave.llm.files import Store
from lineweave.llm.tables import cut, prepare, read_table
from lineweave.llm.touched import filtered, key_filter
from lineweave.session import shared_dir

LEAST_BYTES = 1000
ARCHIVE_BYTES = 32 << 20
BLOCK_ENTRIES = 512
DATE = "2000-01-01T00:00:00Z"

_CAPTURES = "url_key string, page_id long, archive string, offset long, length long"
_DIRECTORY = "first_key string, last_key string, file string, offset long, length long, entries int"


def url_key(url: str | None) -> str:
    """The URL with its host reversed and the scheme left out, in lower case up to the path."""
    try:
        parts = urlsplit(url or "")
        host = parts.hostname or ""
        port = f":{parts.port}" if parts.port else ""
    except ValueError:
        return (url or "").lower()
    path = parts.path + (f"?{parts.query}" if parts.query else "")
    return f"{','.join(reversed(host.split('.')))}{port}){path or '/'}" if host else path


def _header(lines: list[tuple[str, object]], first: str = "WARC/1.1") -> bytes:
    return "\r\n".join([first, *(f"{k}: {v}" for k, v in lines), "", ""]).encode()


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = DATE) -> bytes:
    """One WARC record as a gzip member; a revisit if it refers to another page."""
    http = _header([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", len(payload))], "HTTP/1.1 200 OK")
    block = http if refers_to is not None else http + payload
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    lines: list[tuple[str, object]] = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _urn(page_id)),
        ("WARC-Date", date),
        ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()),
    ]
    if refers_to is not None:
        lines += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", _urn(refers_to))]
    lines += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]
    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
    return packer.compress(_header(lines) + block + b"\r\n\r\n") + packer.flush()


def _fields(head: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:] if ": " in line)


def _page(urn: str) -> int | None:
    text = urn.removeprefix("<urn:page:").removesuffix(">")
    return None if text == "null" else int(text)


def parse(member: bytes) -> dict:
    """Fields of a record: page_id, url, record_type, refers_to, payload, payload_bytes, payload_digest.

    The digest of a response is that of its payload as read and must equal the header's.
    """
    raw = zlib.decompress(member, 31)
    head, rest = raw.split(b"\r\n\r\n", 1)
    fields = _fields(head)
    block = rest[: int(fields["Content-Length"])]
    http, payload = block.split(b"\r\n\r\n", 1)
    revisit = fields["WARC-Type"] == "revisit"
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    if not revisit and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} doesn't match its digest")
    return {
        "page_id": _page(fields["WARC-Record-ID"]),
        "url": fields["WARC-Target-URI"],
        "record_type": fields["WARC-Type"],
        "refers_to": _page(fields["WARC-Refers-To"]) if revisit else None,
        "payload": None if revisit else payload,
        "payload_bytes": int(_fields(http)["Content-Length"]),
        "payload_digest": digest,
    }


def _write_archives(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, task, number, held, rows = Store(path), TaskContext.get().partitionId(), 0, bytearray(), []

        def flush() -> pa.RecordBatch:
            name = f"archive-{task:06d}-{number:06d}.warc.gz"
            store.write(name, bytes(held))
            keys, ids, offsets, lengths = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [pa.array(keys), pa.array(ids, pa.int64()), pa.array([name] * len(rows)), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())],
                names=["url_key", "page_id", "archive", "offset", "length"],
            )

        for batch in batches:
            for page_id, url, html, refers_to in zip(*(batch.column(i) for i in range(4))):
                page, address = page_id.as_py(), url.as_py()
                data = record(page, address, (html.as_py() or "").encode(), refers_to.as_py())
                rows.append((url_key(address), page, len(held), len(data)))
                held += data
                if len(held) >= ARCHIVE_BYTES:
                    yield flush()
                    number, held, rows = number + 1, bytearray(), []
        if rows:
            yield flush()

    return run


def write_archives(pages: DataFrame, path: str) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) as WARC files under ``path``; the captures (url_key,
    page_id, archive, offset, length)."""
    prepare(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.unhex(F.sha1(F.encode("html", "UTF-8"))))
    rows = rows.withColumn("key", F.xxhash64("page_id", "digest"))
    long = rows.where(f"octet_length(html) >= {LEAST_BYTES}").select("digest", "page_id", "key")
    chosen = long.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1").drop("n")
    # The id decides, not the row: rows that repeat the largest id are all responses.
    revisits = cut(long.join(chosen, "digest").where("not (page_id <=> refers_to) and refers_to is not null").select("key", "refers_to").distinct(), "warc-revisits")
    maybe = key_filter(revisits, "key")
    rows = rows.select("page_id", "url", "html", "key")
    checked = filtered(rows, "key", maybe, True).join(revisits, "key", "left").select("page_id", "url", "html", "refers_to")
    plain = filtered(rows, "key", maybe, False).select("page_id", "url", "html", F.lit(None).cast("long").alias("refers_to"))
    # The table is cut so that every archive is written once.
    return cut(plain.union(checked).mapInArrow(_write_archives(path), _CAPTURES), "warc-captures")


def _block(entries: list[tuple]) -> bytes:
    return zlib.compress("\n".join(json.dumps(e, ensure_ascii=False) for e in entries).encode(), 6)


def _entries(block: bytes) -> list[list]:
    return [json.loads(line) for line in zlib.decompress(block).decode().split("\n")]


def _write_blocks(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, data, directory, waiting = f"index-{TaskContext.get().partitionId():06d}.blocks", bytearray(), [], []

        def close(entries: list[tuple]) -> None:
            block = _block(entries)
            directory.append((entries[0][0], entries[-1][0], name, len(data), len(block), len(entries)))
            data.extend(block)

        for batch in batches:
            waiting += zip(*(c.to_pylist() for c in batch.columns))
            while len(waiting) >= BLOCK_ENTRIES:
                close(waiting[:BLOCK_ENTRIES])
                waiting = waiting[BLOCK_ENTRIES:]
        if waiting:
            close(waiting)
        if directory:
            Store(path).write(name, bytes(data))
            kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*directory), kinds)], names=["first_key", "last_key", "file", "offset", "length", "entries"])

    return run


def write_index(captures: DataFrame, path: str) -> DataFrame:
    """Writes the blocks of the sorted captures under ``path``; the sparse directory, one row a block."""
    spark = captures.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["url_key", "page_id", "archive", "offset"]
    ranged = captures.select("url_key", "page_id", "archive", "offset", "length").repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return cut(ranged.mapInArrow(_write_blocks(path), _DIRECTORY), "warc-directory")


_RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"


def _records(found: list[dict]) -> pa.RecordBatch:
    kinds = [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
    return pa.RecordBatch.from_arrays([pa.array([f[n] for f in found], k) for n, k in kinds], names=[n for n, _ in kinds])


def read_through_index(directory: DataFrame, path: str) -> DataFrame:
    """Every capture of the index, read from its archive by its byte range and parsed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = Store(path)
        for batch in batches:
            for file, offset, length in zip(*(batch.column(n).to_pylist() for n in ("file", "offset", "length"))):
                entries = _entries(store.read_range(file, offset, length))
                entries.sort(key=lambda e: (e[2], e[3]))
                yield _records([parse(store.read_range(archive, at, size)) for _, _, archive, at, size in entries])

    spread = directory.repartition(int(directory.sparkSession.conf.get("spark.sql.shuffle.partitions")), "file", "offset")
    return spread.mapInArrow(run, _RECORD)


def look_up(urls: DataFrame, directory: DataFrame, path: str, column: str = "url") -> DataFrame:
    """The captures of the given URLs. Index files hold disjoint ranges, so the asked keys are dealt out
    by the files' first and last keys (one row a file reaches the driver) and each file's directory is searched alone."""
    ranges = sorted(tuple(r) for r in directory.groupBy("file").agg(F.min("first_key"), F.max("last_key")).select(F.col("min(first_key)"), F.col("max(last_key)"), "file").collect())
    lows, highs = [r[0] for r in ranges], [r[1] for r in ranges]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = {url_key(u) for u in batch.column(0).to_pylist()}
            found = [(ranges[i][2], k) for k in keys for i in range(bisect_left(highs, k), bisect_right(lows, k))]
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.string()) for i in (0, 1)], names=["file", "asked"])

    met = urls.select(F.col(column).cast("string")).mapInArrow(deal, "file string, asked string").distinct()

    def run(wanted: pa.Table, blocks: pa.Table) -> pa.Table:
        store, out = Store(path), [_records([])]
        lines = sorted(zip(*(blocks.column(n).to_pylist() for n in ("first_key", "last_key", "offset", "length"))), key=lambda b: b[2])
        lasts, asked = [b[1] for b in lines], sorted(wanted.column("asked").to_pylist())
        held, entries, keys = -1, [], []
        for asked_key in asked if lines else []:
            at = bisect_left(lasts, asked_key)
            while at < len(lines) and lines[at][0] <= asked_key:
                if at != held:  # asked keys are in order, so a block is read once
                    entries, held = _entries(store.read_range(blocks.column("file")[0].as_py(), lines[at][2], lines[at][3])), at
                    keys = [e[0] for e in entries]
                met = entries[bisect_left(keys, asked_key) : bisect_right(keys, asked_key)]
                out.append(_records([parse(store.read_range(*e[2:])) for e in sorted(met, key=lambda e: e[2:])]))
                at += 1
        return pa.Table.from_batches(out).combine_chunks()

    return met.groupBy("file").cogroup(directory.groupBy("file")).applyInArrow(run, _RECORD)


def op9_warc(spark, sf_dir: str) -> DataFrame:
    """Every page's record, looked up under the page's own URL. Pages that share a key share a look-up, which finds
    each of their captures once."""
    path, pages = shared_dir(spark, "warc"), read_table(spark, sf_dir, "pages")
    directory = write_index(write_archives(pages, path), path)
    return look_up(pages, directory, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
