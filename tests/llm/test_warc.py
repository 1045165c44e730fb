"""Archives: records, round trips, and the merged index against a plain sort."""

from __future__ import annotations

import gzip
import hashlib
import io
import random
from collections import defaultdict
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from curbline.llm import warc

PAGES = "page_id long, url string, html string"


def pages_corpus():
    long_page, other = "<p>" + "same " * 300, "<b>" + "é" * 500
    rows = [(i, f"http://www.Host{i % 4}.example.com:80/p{i}?b=2&a=1#x", long_page) for i in range(40, 70)]
    rows += [(5, "https://a.example.org", other), (9, None, other), (None, "not a url", other)]
    rows += [(1, "http://h/\r\nWARC-Type: x", ""), (2, "", None), (3, "http://u:p@h.example:8080/A?z", "short")]
    rows += [(4, "http://h.example/", "short"), (100, "http://h.example/", "x" * 999), (101, "http://h.example/", "x" * 999)]
    rows += [(110, "ftp://h.example/", "WARC/1.1\r\n\r\n" + "y" * 1000), (110, "ftp://h.example/", "WARC/1.1\r\n\r\n" + "y" * 1000)]
    rows += [(None, "http://n.example/", "z" * 1200), (None, "http://n.example/", "z" * 1200)]
    return rows


def wanted(rows):
    largest = {}
    for page_id, _, html in rows:
        if page_id is not None:
            largest[html] = max(largest.get(html, page_id), page_id)
    out = []
    for page_id, _, html in rows:
        body = (html or "").encode()
        revisit = len(body) >= 1000 and html in largest and largest[html] != page_id
        refers_to = largest[html] if revisit else None
        digest = hashlib.sha1(body).hexdigest()
        out.append((page_id, len(body), digest, "revisit" if revisit else "response", refers_to))
    return sorted(out, key=str)


def found_rows(frame):
    names = "page_id payload_bytes payload_digest record_type refers_to".split()
    return sorted((tuple(r[c] for c in names) for r in frame.collect()), key=str)


def test_captures_round_trip(spark):
    rows = pages_corpus()
    pages = spark.createDataFrame(rows, PAGES).repartition(5)
    pages = pages.selectExpr("*", "7 AS file", "8 AS at", "'x' AS payload", "0 AS refers_to", "1 AS position")
    found = warc.captures(pages)
    assert found_rows(found) == wanted(rows)
    got = sorted(found.collect(), key=lambda r: r.position)
    assert [r.position for r in got] == list(range(len(rows)))
    assert [r.url_key for r in got] == sorted(warc.url_key(url) for _, url, _ in rows)


def test_one_hot_payload_and_one_hot_url(spark):
    html = "<p>" + "hot " * 400
    rows = [(i, "http://hot.example/", html if i % 3 else f"{i} {html}") for i in range(600)]
    found = warc.captures(spark.createDataFrame(rows, PAGES).repartition(6))
    assert found_rows(found) == wanted(rows)
    assert sorted(r.capture_no for r in found.collect()) == list(range(1, 601))


def test_no_pages(spark):
    assert warc.captures(spark.createDataFrame([], PAGES)).collect() == []


def test_capture_times_are_taken_where_given(spark):
    times = [datetime(2020, 1, 1, tzinfo=UTC) + timedelta(days=d) for d in (5, 1, 3)]
    rows = [(i, "http://a.example/", "t", t) for i, t in enumerate(times)] + [(9, "http://a.example/", "t", None)]
    found = warc.captures(spark.createDataFrame(rows, f"{PAGES}, captured timestamp"))
    got = sorted(found.collect(), key=lambda r: r.position)
    assert [r.page_id for r in got] == [1, 2, 0, 9]
    assert [r.since_last for r in got[:3]] == [None, 2 * 86400.0, 2 * 86400.0]


def test_archives_hold_the_texts_and_can_be_searched(spark, tmp_path):
    rows = pages_corpus()
    made = warc.archive(spark.createDataFrame(rows, PAGES).repartition(3), f"file://{tmp_path}/archives")
    held = {r.page_id: r for r in made.records().collect() if r.record_type == "response"}
    assert held[3].html == "short" and held[2].html == "" and held[69].html == rows[29][2]
    one = made.fetch(made.index.where("page_id = 3 OR page_id = 40")).collect()
    assert {(r.page_id, r.record_type, r.html) for r in one} == {(3, "response", "short"), (40, "revisit", None)}
    files = list((tmp_path / "archives").glob("*.warc.gz"))
    whole = b"".join(gzip.decompress(f.read_bytes()) for f in files)
    assert whole.count(b"WARC-Type: revisit\r\n") == sum(r[3] == "revisit" for r in wanted(rows))
    assert b"\r\nWARC-Type: x" not in whole  # a URL can't add a header


def test_files_are_bounded_and_runs_sorted(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://h{i * 7 % 50}.example/", f"{i} " * 300) for i in range(300)], PAGES)
    rows = warc.with_responses(pages.coalesce(2))
    runs = warc.stored(warc.write_archives(rows, str(tmp_path / "a"), file_bytes=3000), "runs").collect()
    by_file = defaultdict(list)
    for r in runs:
        by_file[r.file].append(r)
    assert len(by_file) > 4 and all((tmp_path / "a" / f).stat().st_size < 6000 for f in by_file)
    assert all(own == sorted(own, key=lambda r: (r.url_key, r.captured)) for own in by_file.values())


def test_damaged_archives_are_noticed(spark, tmp_path):
    made = warc.archive(spark.createDataFrame([(1, "u", "text of a page")], PAGES), str(tmp_path / "a"))
    [file] = (tmp_path / "a").glob("*.warc.gz")
    content = gzip.decompress(file.read_bytes())
    file.write_bytes(gzip.compress(content.replace(b"text of", b"test of")))
    with pytest.raises(Exception, match="damaged payload"):
        made.records().collect()
    file.write_bytes(gzip.compress(content)[:-30])
    with pytest.raises(Exception, match="ends within"):
        made.records().collect()


def own_records():
    return b"".join(
        warc.record(i, f"http://h/{i}", warc.FIRST, f"body {i}\r\n\r\nWARC/1.1\r\n".encode() * 9, None, f"<urn:page:{i}>")
        for i in range(20)
    )


@pytest.mark.parametrize("kind", ["plain", "whole", "members", "folded"])
def test_other_archives_can_be_read(kind):
    content = own_records()
    if kind == "whole":
        content = gzip.compress(content)
    elif kind == "members":
        parts = [warc.record(i, "u", warc.FIRST, b"b" * i, None, "<urn:page:1>") for i in range(20)]
        content = b"".join(map(gzip.compress, parts))
    elif kind == "folded":
        content = content.replace(b"WARC-Target-URI: ", b"warc-target-uri:\r\n  ").replace(b"WARC/1.1\r\nWARC", b"\r\nWARC/1.0\r\nWARC")
    found = list(warc.read_records(io.BytesIO(content)))
    assert len(found) == 20
    if kind == "members":
        assert [r.payload for r in found] == [b"b" * i for i in range(20)]
        assert all(found[i].at + found[i].size == found[i + 1].at for i in range(19))
    else:
        assert found[7].headers["warc-target-uri"] == "http://h/7"
        assert found[7].payload == b"body 7\r\n\r\nWARC/1.1\r\n" * 9


def test_url_keys():
    assert warc.url_key("http://www.Example.com:80/A/b?z=1&a=2#f") == "com,example)/a/b?a=2&z=1"
    assert warc.url_key("https://u:p@example.com") == "com,example)/"
    assert warc.url_key("http://example.com:8080/x?") == "com,example:8080)/x"
    assert warc.url_key("no url") == "no url" and warc.url_key(None) == ""


@pytest.mark.parametrize("runs", [0, 1, 2, 3, 5, 8, 33])
def test_loser_tree_merges(runs):
    rng = random.Random(runs)
    parts = [sorted(rng.randrange(50) for _ in range(rng.randrange(12))) for _ in range(runs)]
    merged = warc.LoserTree([iter(p) for p in parts], lambda x: x)
    assert list(merged) == sorted(x for p in parts for x in p)


@pytest.mark.parametrize("range_rows", [7, 37, 5000])
def test_merged_index_equals_a_sort(spark, range_rows):
    """Histories that cross ranges, null ids, equal times, and a run that comes in pieces."""
    start = datetime(2024, 1, 1, tzinfo=UTC)
    rows = [
        (f"k{i % 7 if i % 3 else 0}", start + timedelta(seconds=i % 50), i if i % 11 else None, f"f{i % 5}", i, 5)
        for i in range(700)
    ]
    runs = spark.createDataFrame(rows, warc.RUN_COLUMNS)
    runs = runs.repartition(4)
    found = [r.asDict() for r in warc.merge_runs(runs, range_rows).collect()]
    found.sort(key=lambda r: r["position"])
    assert [r["position"] for r in found] == list(range(700))

    def order(r):
        return r["url_key"], r["captured"], r["page_id"] is not None, r["page_id"] or 0, r["file"], r["at"]

    assert found == sorted(found, key=order)
    seen = {}
    for r in found:
        number, last = seen.get(r["url_key"], (0, None))
        gap = (r["captured"] - last).total_seconds() if last else None
        assert (r["capture_no"], r["since_last"]) == (number + 1, gap)
        seen[r["url_key"]] = number + 1, r["captured"]


def test_duplicate_payloads_that_nobody_may_answer(spark):
    """A revisit without its response has no bytes."""
    rows = [("f", 1, 2, "revisit", 9, "u", warc.FIRST, "aa", None, None), ("f", 5, 9, "response", None, "u", warc.FIRST, "bb", 3, "abc")]
    frame = spark.createDataFrame(rows, warc.RECORD_COLUMNS)
    assert {(r.page_id, r.bytes) for r in warc.resolved(frame).collect()} == {(2, None), (9, 3)}
    assert warc.resolved(frame.where(F.lit(False))).count() == 0
