import base64
import glob
import hashlib
import io

import pytest
import zstandard

from tallyhouse.llm import warc
from tallyhouse.llm.common import read_table

SCHEMA = "page_id long, url string, html string, row int, key string"


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def plain(rows, least=0):
    first, out = {}, []
    for r in rows:
        if r["page_id"] is not None:
            first[r["html"] or ""] = min(first.get(r["html"] or "", r["page_id"]), r["page_id"])
    used = set()
    for r in sorted(rows, key=lambda r: (r["page_id"] is None, r["page_id"] or 0)):
        html = r["html"] or ""
        holds = html not in used or len(html.encode()) < least
        used.add(html)
        out.append((r["page_id"], len(html.encode()), digest(html), "response" if holds else "revisit", None if holds else first.get(html)))
    return sorted(out, key=repr)


AWKWARD = [
    (3, "http://a/", "same"), (1, "http://b/", "same"), (2, None, "same"), (4, "u\r\nX: y", None), (5, "u", ""), (6, "ü", "é\r\n\r\nWARC/1.1\r\n"),
    (7, "u", "x" * 900_000), (7, "u", "x" * 900_000), (None, "u", "same"), (None, "u", "own"), (8, "u", "a\0b"), (9, "u" * 200_000, "long url"),
]


@pytest.fixture
def awkward(spark):
    return spark.createDataFrame([(*r, 1, "k") for r in AWKWARD], SCHEMA)


def test_awkward(spark, awkward):
    for least in (0, 5):
        found = warc.archive_report(spark, awkward, least=least).collect()
        assert sorted(map(tuple, found), key=repr) == plain(awkward.collect(), least)


def test_empty(spark):
    assert warc.archive_report(spark, spark.createDataFrame([], SCHEMA)).collect() == []


def test_table(spark):
    pages = read_table(spark, "/root/testdata/sf0.01", "pages")
    found = warc.archive_report(spark, pages).collect()
    assert sorted(map(tuple, found), key=repr) == plain(pages.collect())


def test_round_trip_and_seeks(spark, awkward, tmp_path, monkeypatch):
    folder = str(tmp_path / "warc")
    index = warc.write_archive(awkward, folder)
    records = {r.record_id: r for r in warc.read_archive(index, folder).collect()}
    assert len(records) == len(AWKWARD) == index.count()
    payloads = {r.payload for r in records.values() if r.record_type == "response"}
    assert payloads == {(h or "").encode() for _, _, h in AWKWARD}
    for r in records.values():
        if r.refers_to:
            assert records[r.refers_to].payload_digest == r.payload_digest and r.payload == b""
    wanted = spark.createDataFrame([(7,), (6,), (77,), (None,)], "page_id long")
    some = warc.fetch_records(index, wanted, folder).collect()
    assert sorted(r.page_id for r in some) == [6, 7, 7]
    assert {r.payload for r in some if r.record_type == "response"} == {AWKWARD[5][2].encode(), AWKWARD[6][2].encode()}
    # any reader of the format sees the plain records: frames one after another, the table skipped
    for path in glob.glob(f"{folder}/*.zst"):
        with open(path, "rb") as file:
            data = zstandard.ZstdDecompressor().stream_reader(file, read_across_frames=True).read()
        at = 0
        while at < len(data):
            fields, _, at = warc.read_record(data, at)
            assert fields["WARC-Record-ID"] in records


def test_frames_stand_alone():
    stream = io.BytesIO()
    stream.close, held = (lambda: None), [b"a" * 200_000, b"b" * 100_000, b"c" * 900_000, b"d"]
    writer = warc.BundleWriter(stream)
    places = [writer.add(x) for x in held]
    writer.close()
    assert [p[0] for p in places] == [0, 1, 2, 3] and places[0][2] == 0
    reader = warc.BundleReader(stream, len(stream.getvalue()))
    for (frame, at, offset), x in zip(places, held):
        assert reader.places[frame] == at and reader.frame(frame)[offset : offset + len(x)] == x
    broken = stream.getvalue()[:-1] + b"\0"
    with pytest.raises(ValueError):
        warc.BundleReader(io.BytesIO(broken), len(broken))
