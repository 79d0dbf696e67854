"""Operator 1: round trips and revisit resolution."""

import gzip
import hashlib

from lodgeflow.llm import warc
from tests.llm.fixtures import prose

SCHEMA = "page_id long, url string, html string, payload string, salt int"


def pages(spark):
    body = prose(9, 60)
    rows = [(3, "http://x/3", body), (1, "http://x/\r\nInjected: 1", body), (2, None, body), (None, "http://x/n", body),
            (4, "http://x/4", "short"), (5, "http://x/5", "short"), (6, None, None), (7, "u", ""),
            (8, "u8", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 20), (9, "u9", "é😀" * 60000),
            (9, "u9", "é😀" * 60000), (10, "u10", "x" * 99), (11, "u11", "x" * 99), (None, None, "y" * 120)]
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)


def expected(rows):
    data = [(r["page_id"], (r["html"] or "").encode()) for r in rows]
    least = {}
    for page, body in data:
        if len(body) >= 100 and page is not None:
            least[body] = min(page, least.get(body, page))
    out = []
    for page, body in data:
        to = least.get(body)
        to = to if to is not None and to != page and len(body) >= 100 else None
        out.append((page, len(body), hashlib.sha256(body).hexdigest(), "revisit" if to is not None else "response", to))
    return sorted(out, key=repr)


def test_round_trip(spark):
    df = pages(spark)
    got = warc.archive_pages(df).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected(df.collect())


def test_archives_hold_each_payload_once(spark, scratch):
    path = f"{scratch}/archives"
    warc.write_archives(pages(spark), path)
    import glob
    raw = b"".join(gzip.open(f).read() for f in glob.glob(f"{path}/part-*"))
    assert raw.count(prose(9, 60).encode()) == 1
    assert raw.count(b"WARC-Type: revisit") == 3
    assert b"\r\nInjected: 1" not in raw


def members(data):
    """Unpacked gzip members, one by one."""
    import zlib

    out = []
    while data:
        unzip = zlib.decompressobj(wbits=31)
        out.append(unzip.decompress(data))
        data = unzip.unused_data
    return out


def test_files_are_bounded_in_bytes_and_records_are_members(spark, scratch):
    import glob
    import os

    rows = [(i, f"http://x/{i}", prose(i, 200)) for i in range(60)] + [(99, "long", prose(99, 9000))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(2)
    warc.write_archives(df, f"{scratch}/a", file_bytes=6000)
    files = glob.glob(f"{scratch}/a/part-*")
    sizes = sorted(os.path.getsize(f) for f in files)
    assert len(files) > 4 and sizes[-2] <= 6000 + len(warc.NOTHING) < sizes[-1]  # the long page's own file
    parts = [m for f in files for m in members(open(f, "rb").read())]
    records = [m for m in parts if m]
    assert len(records) == 61 and len(parts) == 61 + len(files)
    assert all(m.startswith(b"WARC/1.1\r\n") and m.endswith(b"\r\n\r\n") for m in records)
    got = warc.read_archives(spark, f"{scratch}/a").select("page_id", "payload_digest").collect()
    assert {r["page_id"]: r["payload_digest"] for r in got} == {i: hashlib.sha256(t.encode()).hexdigest() for i, _, t in rows}


def test_damage_is_noticed():
    import pytest
    body = b"WARC/1.1\r\nContent-Length: 10\r\n\r\nabc\r\n\r\n"
    with pytest.raises(ValueError):
        list(warc._parse(gzip.compress(body)))


def test_members_are_read_on():
    one = b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert [b for _, b in warc._parse(gzip.compress(one) + gzip.compress(one * 2))] == [b"abc"] * 3


def test_no_pages(spark):
    assert warc.archive_pages(spark.createDataFrame([], SCHEMA)).count() == 0
