import gzip
import hashlib
from pathlib import Path

import pytest

from sftframe.llm import warc
from sftframe.session import shared_folder


@pytest.fixture(scope="module")
def pages(spark):
    big, same = "<p>ü" * 600, "é" * 1200
    rows = [(1, "http://a/1", big), (2, "http://a/2", big), (9, None, big), (3, "http://a/3", "short"), (4, "http://a 4\r\n", "short"), (5, "u", None), (6, "u", ""), (7, "u", same), (7, "u", same), (8, "u", "z" * 999), (10, "u", "z" * 999), (None, "u", big), (None, "n", "q" * 1000), (None, "n", "q" * 1000)]
    return spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING")


def test_digest(spark, pages):
    rows = [tuple(r) for r in warc.digest(spark, pages).collect()]
    assert len(rows) == 14
    by_id = {r[0]: r for r in rows if r[0] is not None}
    assert by_id[1][3:] == ("revisit", 9) and by_id[2][3:] == ("revisit", 9) and by_id[9][3:] == ("response", None)
    assert by_id[1][1] == len(("<p>ü" * 600).encode()) and by_id[1][2] == hashlib.sha1(("<p>ü" * 600).encode()).hexdigest()
    assert by_id[5] == by_id[6][:0] + (5, 0, hashlib.sha1(b"").hexdigest(), "response", None)
    assert by_id[7][3] == "response" and by_id[8][3] == by_id[10][3] == "response"
    assert sorted(str(r[3:]) for r in rows if r[0] is None) == ["('response', None)", "('response', None)", "('revisit', 9)"]


def test_selected_records_are_read_back_whole(spark, pages):
    folder = f"{shared_folder(spark)}/warc-test"
    index = warc.write_archive(pages, folder)
    rows = {r["page_id"]: r for r in warc.read_archive(index.where("url = 'http://a/3' or record_type = 'revisit'"), folder).collect()}
    assert set(rows) == {"1", "2", "3", None} and rows["3"]["payload"] == b"short" and rows["1"]["payload"] is None


def test_members_stand_alone(spark, pages, tmp_path):
    index = warc.write_archive(pages, f"file://{tmp_path}/archive").collect()
    for row in index:
        data = Path(tmp_path, "archive", row["file"]).read_bytes()[row["offset"] : row["offset"] + row["length"]]
        assert gzip.decompress(data).startswith(b"WARC/1.1\r\n") and gzip.decompress(data).endswith(b"\r\n\r\n")


def test_ranges_are_joined_up_to_the_limit():
    assert warc.ranges([0, 10, 25, 500], [10, 10, 5, 5], gap=5, limit=100) == [(0, 30, 0, 3), (500, 505, 3, 4)]
    assert warc.ranges([0, 60], [60, 60], gap=5, limit=100) == [(0, 60, 0, 1), (60, 120, 1, 2)]


def test_a_changed_payload_is_noticed():
    data = warc.record("1", "u", b"payload", hashlib.sha1(b"payload").hexdigest(), None)
    assert warc.parse(data)["payload"] == b"payload"
    with pytest.raises(ValueError):
        warc.parse(data.replace(b"payload\r\n", b"pAyload\r\n"))


def test_empty_table(spark, pages):
    assert warc.digest(spark, pages.where("false")).collect() == []


def test_reading_is_dealt_out_by_bytes(spark, pages, monkeypatch):
    monkeypatch.setattr(warc, "TASK_BYTES", 150)
    folder = f"{shared_folder(spark)}/warc-bytes"
    index = warc.write_archive(pages, folder).persist()
    found = warc.read_archive(index, folder)
    size = index.agg({"length": "sum"}).first()[0]
    assert found.rdd.getNumPartitions() >= size / 150 and found.count() == 14
    stretches = index.selectExpr("file", "floor(offset / 150) s", "length").groupBy("file", "s").agg({"length": "sum"}).collect()
    assert max(r[2] for r in stretches) < 150 + max(r["length"] for r in index.collect())
