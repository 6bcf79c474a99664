"""Records with long headers are read back, and lost records are noticed."""

import random

import pytest

from feedloom.llm import warc


def long_urls(spark):
    rnd = random.Random(4)
    url = lambda n: "data:," + "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=n))
    same = "<html>" + "same page " * 30
    rows = [(1, url(300_000), "<p>one</p>"), (2, "http://a/2", same), (3, url(2_000_000), same), (4, " \n" * 200_000 + url(70_000), None)]
    return rows, spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)


def test_records_with_long_urls_are_read_back(spark):
    rows, pages = long_urls(spark)
    got = {r["page_id"]: r for r in warc.archive_pages(spark, pages).collect()}
    assert sorted(got) == [1, 2, 3, 4]
    assert all(got[i]["target_uri"] == u for i, u, _ in rows[:3])
    assert got[4]["target_uri"] == "%20%0A" * 200_000 + rows[3][1].strip()
    assert (got[3]["record_type"], got[3]["refers_page"]) == ("revisit", 2)


def test_lost_records_fail_the_read(spark, monkeypatch):
    _, pages = long_urls(spark)
    read = warc.read_warc
    monkeypatch.setattr(warc, "read_warc", lambda files: read(files).filter("record_id <> 'urn:page:2'"))
    with pytest.raises(ValueError, match="written"):
        warc.archive_pages(spark, pages).collect()


class Bytes:
    def __init__(self, data):
        self.data = data

    def read_at(self, n, at):
        return self.data[at:at + n]


def test_records_are_found_wherever_the_read_buffer_ends(monkeypatch):
    """A record may begin on the last one or two bytes of a buffer: its magic number is still seen whole."""
    members = [warc.record(i, f"http://a/{i}", b"<p>%d</p>" % i, "0" * 64, None) for i in range(3)]
    data = b"".join(members)
    starts = [0, len(members[0]), len(members[0]) + len(members[1])]
    monkeypatch.setattr(warc, "PIECE_BYTES", 16)
    for buffer in range(16, len(members[0]) + 40):
        monkeypatch.setattr(warc, "READ_BYTES", buffer)
        assert [at for at, _, _ in warc.scan(warc.Window(Bytes(data), len(data)), 0, len(data))] == starts, buffer
