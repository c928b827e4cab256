import tempfile

import pytest
from pyspark.sql import functions as F

from weirgauge.llm import warc

SCHEMA = "page_id long, url string, html string, record_id string, chunk string"
SEP = warc.BREAK
CASES = [
    (5, "http://a", "héllo " * 50),
    (3, "http://b\r\nX-Evil: 1", "héllo " * 50),
    (9, None, None),
    (2, "http://c", ""),
    (7, "http://d", f"x{SEP}y{SEP}{SEP}z"),
    (8, "http://e", SEP[4:] * 3 + SEP[:6]),
    (1, "http://f", "\r\n\r\n" * 40),
    (11, "http://g", "\r\n\r\nWARC/1.1\r\n\r\nWARC/1.1\r\n"),
    (None, "http://n", "only"),
    (12, "http://g", "日本語" * 100),
]


@pytest.mark.parametrize(("chunk", "compression"), [(16, "none"), (7, "gzip"), (1 << 18, "none")])
def test_round_trip(spark, chunk, compression):
    pages = spark.createDataFrame([(*row, "x", "y") for row in CASES], SCHEMA)
    got = {r.page_id: r for r in warc.archive_round_trip(pages, chunk, compression).collect()}
    assert len(got) == len(CASES)
    firsts = {}
    for page_id, _, html in sorted(CASES, key=lambda c: (c[0] is None, c[0] or 0)):
        data = (html or "").encode()
        row = got[page_id]
        assert row.intact and row.payload_bytes == len(data) and row.payload_digest == warc.expected_digest(data)
        head = firsts.setdefault(data, page_id)
        assert (row.record_type, row.refers_to) == (("response", None) if head == page_id else ("revisit", head))


def test_small_payloads_are_not_revisits_below_the_limit(spark):
    pages = spark.createDataFrame([(1, "u", "aa"), (2, "u", "aa"), (3, "u", "bbbb"), (4, "u", "bbbb")], "page_id long, url string, html string")
    path = f"file://{tempfile.mkdtemp(prefix='run-')}/w"
    got = {r.page_id: (r.record_type, r.refers_to) for r in warc.archive(pages, path, revisit_from=3).collect()}
    assert got == {1: ("response", None), 2: ("response", None), 3: ("response", None), 4: ("revisit", 3)}


def test_repeated_rows_and_empty_table(spark):
    pages = spark.createDataFrame([(1, "u", "aa"), (1, "u", "aa")], "page_id long, url string, html string")
    got = warc.archive_round_trip(pages).collect()
    assert sorted(r.record_type for r in got) == ["response", "revisit"] and {r.page_id for r in got} == {1}
    assert warc.archive_round_trip(pages.limit(0)).count() == 0


def test_base32_matches_library(spark):
    row = spark.range(1).select(warc.base32(F.unhex(F.sha1(F.lit("abc").cast("binary")))).alias("x")).first()
    assert row.x == warc.expected_digest(b"abc")
