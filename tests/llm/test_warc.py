import base64
import hashlib
import zlib
from pathlib import Path

import pytest

from lexigrove.llm import warc as W


def pages(spark):
    rows = [(1, "http://a/", "same"), (0, "http://b/\r\nx y", "same"), (2, None, None), (3, "", ""), (4, "http://é/", "ü" * 9), (5, "u", "long " * 40000), (None, "n", "same"), (0, "again", "same"), (None, None, "alone")]
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, payload string, size int")


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


@pytest.mark.parametrize("least", [0, 3])
def test_round_trip(spark, least):
    df = pages(spark)
    rows = df.collect()
    got = sorted(map(tuple, W.archive_table(df, least).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)
    want = []
    for r in rows:
        html = r.html or ""
        ids = [x.page_id for x in rows if (x.html or "") == html and x.page_id is not None]
        refers = min(ids) if ids and len(html.encode()) >= least and r.page_id != min(ids) else None
        want.append((r.page_id, len(html.encode()), digest(html), "response" if refers is None else "revisit", refers))
    assert got == sorted(want, key=str)


def test_files_are_warc(spark, tmp_path):
    folder = f"file://{tmp_path}/w"
    index = W.write_archives(pages(spark), folder).orderBy("file", "offset").collect()
    data = {p.name: p.read_bytes() for p in Path(tmp_path, "w").glob("*.warc.gz")}
    for r in index:
        record = zlib.decompress(data[r.file][r.offset : r.offset + r.length], wbits=31)
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
        assert W.parse_record(record)["payload_digest"] == r.payload_digest
    assert sum(r.length for r in index) == sum(map(len, data.values()))


def test_selected_records(spark, tmp_path):
    folder = f"file://{tmp_path}/w"
    index = W.write_archives(pages(spark), folder)
    got = W.read_records(index.filter("page_id >= 4"), folder, max_gap=0, max_bytes=10).collect()
    assert sorted((r.page_id, r.payload.decode()) for r in got) == [(4, "ü" * 9), (5, "long " * 40000)]


def test_damage_is_found():
    record = W.build_record(1, "u", b"payload", W.digest_of(b"payload"), None)
    with pytest.raises(ValueError):
        W.parse_record(record.replace(b"\r\n\r\npayload", b"\r\n\r\npaYload"))


def test_empty(spark):
    assert W.archive_table(pages(spark).limit(0)).count() == 0


def test_ranges():
    rows = [("a", 0, 10), ("a", 10, 5), ("a", 40, 5), ("b", 45, 5), ("b", 51, 100)]
    got = list(W.coalesce_ranges(rows, max_gap=30, max_bytes=60))
    assert [(f, b, e, len(r)) for f, b, e, r in got] == [("a", 0, 45, 3), ("b", 45, 50, 1), ("b", 51, 151, 1)]
    assert len(list(W.coalesce_ranges(rows, 0, 60))) == 4
