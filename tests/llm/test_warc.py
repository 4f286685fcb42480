import hashlib
import random

import pytest

from lineweave.llm import warc
from lineweave.llm.warc import look_up, op9_warc, parse, read_through_index, record, url_key, write_archives, write_index
from lineweave.session import shared_dir
from tests.conftest import SF001


def model(pages):
    top = {}
    for page_id, _, html in pages:
        data = (html or "").encode()
        if len(data) >= 1000 and page_id is not None:
            top[data] = max(top.get(data, page_id), page_id)
    out = []
    for page_id, _, html in pages:
        data = (html or "").encode()
        to = top.get(data) if len(data) >= 1000 else None
        to = None if to == page_id else to
        out.append((page_id, len(data), hashlib.sha1(data).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in df.collect()), key=str)


def test_pages_come_back(spark):
    pages = [(r["page_id"], r["url"], r["html"]) for r in spark.read.parquet(f"{SF001}/pages.parquet").collect()]
    assert rows_of(op9_warc(spark, SF001)) == model(pages)


def test_cases_index_and_look_up(spark):
    big, other = "é" * 600, "x" * 1000
    rows = [(1, "http://A.example.org/p?q=1", big), (2, "http://a.example.org/p?q=1", big), (3, "https://b.example.org:8080/", big), (3, "https://b.example.org:8080/", big), (4, "http://c.net", other[:-1]), (5, "http://d.net/", other[:-1])]
    rows += [(None, "http://e.net/", other), (6, "http://f.net/a b\r\n", other), (7, None, None), (8, "", ""), (9, "not a url", "a\r\n\r\nb"), (10, "http://[bad", "<html>\0")]
    rows += [(100 + i, f"http://host{i % 7}.many.org/{i}", f"page {i}") for i in range(1500)]
    docs = spark.createDataFrame([(*r, 0, 0, "x") for r in rows], "page_id long, url string, html string, key int, offset int, digest string")
    path = shared_dir(spark, "test-warc")
    directory = write_index(write_archives(docs, path), path)
    assert rows_of(read_through_index(directory, path)) == model(rows)
    asked = ["http://a.example.org/p?q=1", "http://host3.many.org/10", "http://nowhere.org/", "http://c.net/", "http://host6.many.org/1497"]
    got = rows_of(look_up(spark.createDataFrame([(u,) for u in asked], "url string"), directory, path))
    wanted = {url_key(u) for u in asked}
    assert got == sorted((m for m in model(rows) if any(url_key(u) in wanted and i == m[0] for i, u, _ in rows)), key=str)
    empty = write_index(write_archives(docs.limit(0), path + "-none"), path + "-none")
    assert read_through_index(empty, path + "-none").count() == 0


def test_long_payloads_several_archives_and_shared_urls(spark, monkeypatch):
    """Archives that roll over, a payload larger than one, and many pages under one URL, all read back by look-ups."""
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 20_000)
    rng = random.Random(1)
    noise = lambda n: "".join(chr(rng.randrange(0x21, 0x7E)) for _ in range(n))
    rows = [(i, f"http://h{i % 5}.org/{i}", noise(rng.randrange(3000))) for i in range(200)]
    rows += [(1000 + i, "http://one.org/", noise(1200)) for i in range(1500)] + [(5000, "http://big.org/", noise(300_000)), (5001, None, noise(10))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = shared_dir(spark, "test-warc-many")
    captures = write_archives(pages, path)
    assert captures.select("archive").distinct().count() > 20
    assert rows_of(look_up(pages, write_index(captures, path), path)) == model(rows)


def test_keys_sort_a_domain_together():
    assert url_key("https://www.Example.org:81/A?b") == "org,example,www:81)/A?b"
    assert url_key("http://example.org") == "org,example)/"


def test_damaged_payload_is_noticed():
    import zlib

    member = zlib.decompress(record(1, "u", b"payload", None), 31).replace(b"payload\r\n", b"paYload\r\n")
    packer = zlib.compressobj(wbits=31)
    with pytest.raises(ValueError):
        parse(packer.compress(member) + packer.flush())
