import base64
import gzip
import hashlib

import pytest

from decisionlake.llm import warc_index
from tests.llm.helpers import with_clashes

SCHEMA = "page_id bigint, url string, html string"
ROWS = [
    (1, "http://a/1", "<p>one</p>"), (2, "http://a/2", "two é\r\n\r\nContent-Length: 9\r\n"), (3, None, "<p>one</p>"), (4, "http://a/4\r\nX: y", None), (5, "http://a/é", ""),
    (0, "http://a/0", "two é\r\n\r\nContent-Length: 9\r\n"), (6, "u", "long " * 200_000), (7, "u", "long " * 200_000), (None, "n", "<p>one</p>"), (None, "n", "alone"), (None, "m", "alone"), (1, "again", "<p>one</p>"),
]


def written(spark, tmp_path, rows=ROWS, **options):
    folder = f"file://{tmp_path}/warc"
    pages = with_clashes(spark.createDataFrame(rows, SCHEMA), "sha1", "digest", "offset", "file", "refers_to")
    return warc_index.write_warc(pages, folder, **options), folder


def brute(rows, least=0):
    first = {}
    for i, _, h in rows:
        h = h or ""
        if i is not None and len(h.encode()) >= least:
            first[h] = min(i, first.get(h, i))
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        refers = first.get(h or "") if len(b) >= least else None
        refers = None if refers == i else refers
        out.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 5])
def test_pages_come_back(spark, tmp_path, least):
    index, folder = written(spark, tmp_path, min_bytes=least)
    found = warc_index.read_records(index, folder, with_payload=True).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found), key=str) == brute(ROWS, least)
    kept = {r.page_id: bytes(r.payload).decode() for r in found if r.record_type == "response"}
    assert all(kept[i] == (h or "") for i, _, h in ROWS if i in kept and i not in (1, None))


def test_archives_are_plain_members_at_the_indexed_places(spark, tmp_path):
    index, folder = written(spark, tmp_path)
    for r in index.collect():
        with open(f"{tmp_path}/warc/archives/{r.file}", "rb") as f:
            f.seek(r.offset)
            text = gzip.decompress(f.read(r.length))
        assert text.startswith(b"WARC/1.1\r\nWARC-Type: " + r.record_type.encode()) and text.endswith(b"\r\n\r\n")
        assert f"sha1:{r.digest}".encode() in text


def test_only_selected_ranges_are_read(spark, tmp_path):
    index, folder = written(spark, tmp_path)
    found = warc_index.read_records(index.filter("url = 'http://a/2'"), folder).collect()
    assert [r.page_id for r in found] == [2]


def test_damage_is_noticed():
    data = bytearray(gzip.decompress(warc_index.record(1, "u", b"payload", base64.b32encode(hashlib.sha1(b"payload").digest()).decode(), None)))
    data[data.index(b"payload")] ^= 1
    with pytest.raises(ValueError):
        warc_index.parse(gzip.compress(bytes(data)))


def test_empty_table(spark, tmp_path):
    index, folder = written(spark, tmp_path, [])
    assert index.count() == 0 and warc_index.read_records(index, folder).count() == 0
