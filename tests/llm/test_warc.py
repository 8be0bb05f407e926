"""Archives are read back from their bytes; the expected records come from the rows themselves."""

import base64
import hashlib

from waitband.llm import warc
from waitband.session import scratch_path

SCHEMA = "page_id long, url string, html string, extra int"
NESTED = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"


def expected(rows):
    best = {}
    for page, _, html in rows:
        if page is not None:
            best[html or ""] = max(page, best.get(html or "", page))
    out = []
    for page, _, html in rows:
        body = (html or "").encode()
        first = best.get(html or "")
        again = first is not None and page != first
        out.append((page, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


def round_trip(spark, rows):
    path = scratch_path(spark, "warc-test")
    warc.write(spark.createDataFrame([(*r, 1) for r in rows], SCHEMA), path)
    return sorted(map(tuple, warc.read(spark, path).collect()), key=str)


def test_plain_copies_nulls_and_repeats(spark):
    rows = [(1, "http://a/", "<p>x</p>"), (2, None, "<p>x</p>"), (3, "http://é/\r\nX: y", "é" * 50), (4, "u", None), (5, "u", ""),
            (6, "u", "z"), (6, "u", "z"), (None, "u", "q"), (7, "u", "\r\n\r\n"), (8, "u", "x" * 100_000), (9, "u", "Content-Length: 5\r\n\r\n")]
    assert round_trip(spark, rows) == expected(rows)


def test_empty_table(spark):
    assert round_trip(spark, []) == []


def test_version_lines_inside_payloads(spark):
    rows = [(i, "u", f"<p>{i}</p>" + (NESTED * (i % 4) if i % 3 else "WARC/1.1\r\n")) for i in range(40)]
    rows += [(100, "u", "WARC/1.1\r\nContent-Length: 99999999\r\n\r\nq"), (101, "u", NESTED + NESTED[:30]), (102, "u", "WARC/1.1\r\n" * 30)]
    assert round_trip(spark, rows) == expected(rows)


def test_files_cut_into_small_ranges(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        rows = [(i, "u", f"{i} " * (i % 90) + (NESTED if i % 5 == 0 else "")) for i in range(60)]
        assert round_trip(spark, rows) == expected(rows)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_records_carry_the_mandatory_fields(spark):
    from waitband.session import scratch_path
    pages = spark.createDataFrame([(1, "http://a", "same"), (2, "http://b", "same"), (3, "http://c", None)], "page_id long, url string, html string")
    path = scratch_path(spark, "warc-fields")
    warc.write(pages, path, taken_at="2026-01-02T03:04:05Z")
    records = [r for f in spark.read.text(path, wholetext=True).collect() for r in f.value.split("WARC/1.1\r\n")[1:]]
    assert len(records) == 3
    for r in records:
        for name in ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length"):
            assert r.count(f"{name}: ") == 1, name
        assert "WARC-Date: 2026-01-02T03:04:05Z" in r
        assert ("WARC-Profile: " in r) == ("WARC-Type: revisit" in r) == ("WARC-Refers-To: <urn:page:2>" in r)
