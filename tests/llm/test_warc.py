import base64
import hashlib
import os

import pytest

from asksift.llm import warc as w
from asksift.sources.stages import stage

SCHEMA = "html string, other int, page_id long, url string"
ROWS = [
    (1, "http://a/1", "<p>one</p>" * 50), (2, "http://a/2", "<p>two</p>" * 50), (9, "http://a/9", "<p>one</p>" * 50),
    (4, None, "<p>one</p>" * 50), (5, "http://a\r\nX-Evil: 1", ""), (6, "http://é/6", None), (None, "http://n", "<p>one</p>" * 50),
    (7, "http://a/7", "x" * 300_000), (8, "http://a/8", "é\r\n\r\nWARC/1.1\r\n"), (9, "http://a/9", "<p>one</p>" * 50),
] + [(100 + i, f"http://b/{i}", f"<html><p>page {i} of many</p></html>" * (i % 5 + 1)) for i in range(300)]


def frame(spark, rows):
    return spark.createDataFrame([(h, 0, i, u) for i, u, h in rows], SCHEMA).repartition(3)


def archive(spark, folder, rows, **more):
    pages = frame(spark, rows)
    marked = w.mark_revisits(pages, **more)
    return stage(w.write_archives(marked, f"{folder}/arc", w.build_dictionary(pages)), f"{folder}/files")


def expected(rows, least=0):
    best = {}
    for i, _, h in rows:
        best[h or ""] = max((x for x in (best.get(h or ""), i) if x is not None), default=None)
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        refers = best[h or ""] if len(data) >= least and best[h or ""] != i else None
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((i, len(data), digest, "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 100])
def test_round_trip(spark, folder, least):
    files = archive(spark, folder, ROWS, min_bytes=least)
    records = w.read_archives(files).collect()
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in records), key=str)
    assert got == expected(ROWS, least)
    texts = {i: (h or "").encode() for i, _, h in ROWS}
    for r in records:
        assert r.payload is None if r.record_type == "revisit" else bytes(r.payload) == texts[r.page_id]
    assert sum(f.records for f in files.collect()) == len(ROWS)
    for r in records[::25]:
        again = w.read_record(r.path, r.offset)
        assert (again["page_id"], again["payload_digest"], again["url"]) == (r.page_id, r.payload_digest, r.url)
    urls = {r.page_id: r.url for r in records}
    assert urls[4] is None and urls[5] == "http://a%0D%0AX-Evil: 1" and urls[6] == "http://é/6"


def test_dictionary_leads_the_file_and_helps(spark, folder):
    files = archive(spark, folder, ROWS[10:])
    for f in files.collect():
        with open(f.path, "rb") as source:
            head = source.read(8)
        assert int.from_bytes(head[:4], "little") == w.SKIPPABLE_MAGIC
        assert os.path.getsize(f.path) == f.bytes > int.from_bytes(head[4:], "little") > 0


def test_few_records_and_none(spark, folder):
    files = archive(spark, f"{folder}/a", ROWS[:1])
    assert w.read_archives(files).count() == 1
    empty = archive(spark, f"{folder}/b", [(1, "u", None)])
    assert [r.payload_bytes for r in w.read_archives(empty).collect()] == [0]
    nothing = archive(spark, f"{folder}/c", [])
    assert nothing.count() == 0 and w.read_archives(nothing).count() == 0


def test_files_are_bounded(spark, folder, monkeypatch):
    monkeypatch.setattr(w, "FILE_BYTES", 1000)
    files = archive(spark, folder, ROWS)
    assert files.count() > 3 and w.read_archives(files, payloads=False).count() == len(ROWS)


def test_damage_is_found(spark, folder):
    (path,) = [f.path for f in archive(spark, folder, ROWS[:1]).collect()]
    with open(path, "r+b") as f:
        f.truncate(os.path.getsize(path) - 3)
    with pytest.raises(ValueError, match="cut off"):
        list(w.frames(path))
