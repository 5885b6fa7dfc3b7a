"""Operator 7: records round-trip, revisits point at their response, histories come out in order."""

import gzip
import io
import os
from collections import defaultdict
from glob import glob

from hypothesis import given, settings
from hypothesis import strategies as st

from compare import compare, connect
from conftest import SMALL
from wakeline.llm import warc
from wakeline.llm.common import table


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 30)), max_size=9))
def test_loser_tree_merges(runs):
    rows = [[((x,), (x, k)) for x in sorted(run)] for k, run in enumerate(runs)]
    got = [row for _, row in warc.LoserTree(rows)]
    assert got == sorted((x, k) for k, run in enumerate(runs) for x in run)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.text(max_size=30), st.text(max_size=60)), max_size=5))
def test_records_read_back(pages):
    whole = "".join(warc.record(i, u, h, None, False) + warc.BETWEEN for i, (u, h) in enumerate(pages)).encode()
    found = list(warc.read_records(io.BytesIO(whole)))
    assert [c.partition(b"\r\n\r\n")[2].decode() for _, c, _, _ in found] == [h for _, h in pages]
    assert [h["WARC-Target-URI"] for h, _, _, _ in found] == [warc.header_value(u) for u, _ in pages]
    assert sum(n for *_, n in found) == len(whole)


def check(rows, pages, smallest=0):
    holders = defaultdict(list)
    for page_id, _, html in pages:
        holders[html or ""].append(page_id)
    want = []
    for page_id, _, html in pages:
        payload = (html or "").encode()
        low = max((i for i in holders[html or ""] if i is not None), default=None)
        again = len(payload) >= smallest and low is not None and page_id != low
        want.append((page_id, len(payload), warc.digest_of(payload), "revisit" if again else "response", low if again else None))
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    keys = [(r.url_key, r.captured, r.page_id is not None, r.page_id or 0) for r in rows]
    assert keys == sorted(keys)


def test_table(spark):
    frame = table(spark, SMALL, "pages")
    pages = [tuple(r) for r in frame.select("page_id", "url", "html").collect()]
    check(warc.capture_histories(frame).collect(), pages)
    assert compare(spark, connect(SMALL), "op7_web_archives", SMALL).startswith("ok")


ODD_PAGES = [
    (1, "http://a.example/x", "same"), (2, "http://a.example/x", "same"), (2, "http://a.example/x", "same"),
    (9, "https://www.b.example/?q=1", "same"), (3, None, None), (4, "no url\r\nX: y %0A", ""), (None, "http://[bad", "lone"),
    (5, "http://c.example/é", "WARC/1.1\r\n\r\n\r\n\r\nWARC-Type: response\r\n\r\n"), (6, "", "🙂" * 100_000), (None, None, "same"),
]


def test_odd_pages(spark):
    frame = spark.createDataFrame([(*p, "d") for p in ODD_PAGES], "page_id long, url string, html string, digest string").repartition(3)
    for smallest in (0, 5):
        check(warc.capture_histories(frame, smallest=smallest).collect(), ODD_PAGES, smallest)
    assert warc.capture_histories(frame.limit(0)).count() == 0


def test_index_finds_records_in_the_files(spark, tmp_path):
    frame = spark.createDataFrame(ODD_PAGES, "page_id long, url string, html string").repartition(2)
    warc.write_archives(frame, str(tmp_path / "out"))
    files = {os.path.basename(f): gzip.open(f).read() for f in glob(str(tmp_path / "out" / "*.gz"))}
    for r in warc.read_archives(spark, str(tmp_path / "out")).collect():
        part = files[r.archive][r.offset:r.offset + r.length]
        assert part.startswith(b"WARC/1.1\r\n") and part.endswith(b"\r\n\r\n") and r.payload_digest.encode() in part


def test_captures_are_ordered_by_time_not_by_page(spark):
    from datetime import datetime, timedelta

    base = datetime(2023, 6, 1)
    rows = [(i, f"http://a.example/{i % 2}", f"body {i % 3}", base + timedelta(microseconds=(50 - i) * 7) if i % 9 else None) for i in range(50)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, seen timestamp").repartition(6)
    got = warc.capture_histories(df, time="seen").collect()
    at = {i: t.strftime("%Y-%m-%dT%H:%M:%S.%fZ") if t else warc.CAPTURED for i, _, _, t in rows}
    want = sorted((warc.url_key(u), at[i], i) for i, u, _, _ in rows)
    assert [(r.url_key, r.captured, r.page_id) for r in got] == want
    check(got, [r[:3] for r in rows])


def test_one_payload_in_a_third_of_the_rows(spark):
    rows = [(i, f"http://h{i % 7}.example/{i}", "error" if i % 3 == 0 else f"page {i}") for i in range(300)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    check(warc.capture_histories(df).collect(), rows)
