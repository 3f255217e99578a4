import base64
import collections
import hashlib
import random

from mortar.llm.warc import LoserTree, archive, read_archives, record_digest, write_archives
from mortar.session import scratch_path

SCHEMA = "page_id long, url string, html string"


def brute(rows):
    groups = collections.defaultdict(list)
    for i, _, h in rows:
        groups[(h or "").encode()].append(i)
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        first = max((x for x in groups[data] if x is not None), default=None)
        response = first is None or first == i
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "response" if response else "revisit", None if response else first))
    return sorted(out, key=str)


def cases():
    html = "<html><body>é\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n x</body></html>"
    return [(0, "http://a.example.com/x?q=1", html), (1, "https://b.example.org/", None), (2, None, ""), (3, "no url", "\r\n\r\n"),
            (4, "http://a.example.com/x?q=1", html), (5, "http://a.example.com/x?q=1#f", "x" * 200_000), (6, "", "\n"),
            (6, "", "\n"), (7, "http://c.example.com/a\r\nWARC-Type: revisit", "<p>"), (None, "http://n/", "<p>"),
            (8, "http://c.example.com/%0D", "<p>"), *[(20 + i, "http://hot.example.com/", "same") for i in range(60)]]


def test_edges_against_brute_force(spark):
    rows = cases()
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS record_type", "2 AS n", "3 AS same")
    assert sorted([tuple(r)[:5] for r in record_digest(df).collect()], key=str) == brute(rows)
    assert record_digest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_payloads_survive_the_round_trip(spark):
    rows = cases()
    folder, boundary = scratch_path(spark, "warc-test"), "5a0e4f2c-0000-4000-8000-000000000001"
    write_archives(spark.createDataFrame(rows, SCHEMA), folder, boundary)
    back = read_archives(spark, folder, boundary).collect()
    assert len(back) == len(rows)
    responses = {(r.page_id, r.payload) for r in back if r.record_type == "response"}
    assert responses == {(i, h or "") for i, _, h in rows
                         if (i, "response") in {(b[0], b[3]) for b in brute(rows)}}
    assert all(r.payload is None for r in back if r.record_type == "revisit")
    assert {r.url for r in back if r.page_id == 7} == {"http://c.example.com/a%0D%0AWARC-Type: revisit"}


def test_min_bytes_keeps_short_payloads_apart(spark):
    rows = [(i, "http://x/", "ab") for i in range(4)] + [(9, "http://x/", "abcdef"), (10, "http://y/", "abcdef")]
    out = {r.page_id: r.record_type for r in archive(spark.createDataFrame(rows, SCHEMA), min_bytes=3).collect()}
    assert out == {0: "response", 1: "response", 2: "response", 3: "response", 9: "revisit", 10: "response"}


def test_index_is_globally_ordered(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = [(r.page_id, r.url, r.html) for r in pages.collect()]
    out = record_digest(pages).collect()
    assert sorted([tuple(r)[:5] for r in out], key=str) == brute(rows)
    keys = [(r.urlkey, r.page_id) for r in sorted(out, key=lambda r: r.position)]
    assert keys == sorted(keys)


def test_loser_tree_merges_like_sorted():
    made = random.Random(8)
    for k in (0, 1, 2, 3, 5, 8, 13):
        runs = [sorted(made.randint(0, 20) for _ in range(made.randint(0, 9))) for _ in range(k)]
        assert list(LoserTree(runs)) == sorted(x for r in runs for x in r)
