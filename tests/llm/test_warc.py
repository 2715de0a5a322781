import gzip
import hashlib
import io

import pytest
import zstandard

from tillroll.llm import warc

SCHEMA = "page_id bigint, url string, html string"
LONG = "<p>same page</p>" * 20


@pytest.fixture
def pages(spark):
    return lambda rows: spark.createDataFrame(rows, SCHEMA).repartition(2)


ROWS = [
    (3, "http://a/", LONG),
    (1, "http://b/x y%20z\r\nInjected: header", LONG),
    (2, None, LONG),
    (4, "http://c/", "short"),
    (5, "http://d/", "short"),
    (6, "http://e/", None),
    (7, "http://f/", ""),
    (8, "http://g/", "é" * 99 + "\r\n\r\nWARC/1.1\r\n"),
    (9, "http://h/", "z" * 3_000_000),
    (10, "", "z" * 3_000_000),
]


def brute_force(rows):
    first = {}
    for page, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 100 and page is not None:
            first[data] = min(page, first.get(data, page))
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        refers = first.get(data) if first.get(data) != page else None
        kind = "response" if refers is None else "revisit"
        out.append((page, len(data), hashlib.sha256(data).hexdigest(), kind, refers))
    return sorted(out, key=str)


def test_against_brute_force(pages):
    got = sorted((tuple(r) for r in warc.archived(pages(ROWS)).collect()), key=str)
    assert got == brute_force(ROWS)


def test_payloads_and_urls_come_back(spark, pages, tmp_path):
    path = str(tmp_path / "w")
    warc.write_warc(pages(ROWS), path, frame_bytes=500, bundle_bytes=2_000)
    rows = {r.page_id: r for r in warc.read_warc(spark, path).collect()}
    for page, url, html in ROWS:
        assert rows[page].url == url
        if rows[page].record_type == "response":
            assert bytes(rows[page].payload).decode() == (html or "")
        else:
            assert rows[page].payload is None


def test_single_records_by_frame_and_offset(spark, pages, tmp_path):
    path = str(tmp_path / "w")
    warc.write_warc(pages(ROWS), path, frame_bytes=500, bundle_bytes=2_000)
    wanted = spark.createDataFrame([(8,), (2,), (8,), (99,)], "page_id bigint")
    got = {r.page_id: r for r in warc.read_records(spark, path, wanted).collect()}
    assert set(got) == {8, 2}
    assert bytes(got[8].payload).decode() == ROWS[7][2]
    places = warc.record_map(spark, path)
    assert places.count() == len(ROWS)
    assert "content" not in places._jdf.queryExecution().executedPlan().toString()


def test_a_bundle_is_a_plain_stream_with_a_seek_table(spark, pages, tmp_path):
    path = str(tmp_path / "w")
    warc.write_warc(pages(ROWS[:8]), path, frame_bytes=300)
    for row in warc.read_bundles(spark, path).collect():
        bundle = bytes(row.content)
        whole = zstandard.ZstdDecompressor().stream_reader(
            io.BytesIO(bundle), read_across_frames=True
        ).read()
        spans = warc.frame_spans(bundle)
        assert len(spans) > 1
        assert b"".join(warc.read_frame(bundle, span) for span in spans) == whole
        assert len(list(warc.parse_records(whole))) == len(row.record_ids)


def test_damage_is_found():
    good = warc.warc_record(1, "u", b"payload", hashlib.sha256(b"payload").hexdigest(), None)
    assert next(warc.parse_records(good))[3] == b"payload"
    with pytest.raises(ValueError, match="damaged"):
        next(warc.parse_records(good.replace(b"payload\r\n\r\n", b"pAyload\r\n\r\n")))
    with pytest.raises(ValueError, match="seek table"):
        warc.frame_spans(gzip.compress(b"no bundle"))


def test_null_and_repeated_page_ids(pages):
    rows = [(None, "u", LONG), (2, "u", LONG), (2, "u", LONG), (None, None, None), (5, "v", LONG)]
    got = sorted((r.page_id, r.record_type, r.refers_to) for r in warc.archived(pages(rows)).where("page_id is not null").collect())
    assert got == [(2, "response", None), (2, "response", None), (5, "revisit", 2)]
    rest = warc.archived(pages(rows)).where("page_id is null").collect()
    assert sorted((r.record_type, r.refers_to is None) for r in rest) == [("response", True), ("revisit", False)]


def test_empty_table(pages):
    assert warc.archived(pages([])).collect() == []
