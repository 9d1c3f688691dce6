"""WARC archives and the merged capture index (op 8)."""

import hashlib
import random
import tempfile

from quire.llm import warc as W

SCHEMA = "page_id long, url string, html string"
BOUNDARY = "\r\n\r\nWARC/1.0\r\n"


def test_loser_tree_merges_sorted_runs():
    rng = random.Random(0)
    for k in (0, 1, 2, 3, 5, 8, 13):
        runs = [sorted(rng.randrange(20) for _ in range(rng.randrange(6))) for _ in range(k)]
        merged = list(W.LoserTree([iter([(v, (n, i)) for i, v in enumerate(r)]) for n, r in enumerate(runs)]))
        assert [v for v, _ in merged] == sorted(sum(runs, []))
        assert [x for _, x in merged] == [x for _, x in sorted((v, (n, i)) for n, r in enumerate(runs) for i, v in enumerate(r))]


def test_exact_round_trip_and_order(spark):
    rows = [(1, "http://a.com/x", "é" * 100), (2, "http://www.a.com/x", "é" * 100), (3, None, None), (4, "https://B.org/?q#f", "x" + BOUNDARY + "y" * 200),
            (5, "u\r\nv", "short"), (6, "u", "short"), (None, "z", "é" * 100), (1, "http://a.com/x", "é" * 100), (7, "q", "\r\n\r\n" * 30),
            (8, "q", "ab\n\r\n"), (9, "http://a.com/x", "x" + BOUNDARY + "y" * 200), (10, "q", "\x00\x85 " * 60)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'clash' AS record_type", "1 AS refers_to", "'x' AS value")
    path = tempfile.mkdtemp(prefix="quire-test-") + "/warc"
    W.write_archives(df.repartition(3), path)
    back = W.read_archives(spark, path).collect()
    assert len(back) == len(rows) and not any(r.damaged for r in back)
    payload = {(i, h or "") for i, _, h in rows}
    for r in back:
        if r.record_type == "response":
            assert (r.page_id, bytes(r.payload).decode()) in payload
        text = next(h or "" for i, _, h in rows if i == r.page_id)
        assert r.payload_digest == hashlib.sha256(text.encode()).hexdigest() and r.payload_bytes == len(text.encode())
    refers = {r.page_id: r.refers_to for r in back}
    assert refers == {1: None, 2: 1, 3: None, 4: None, 5: None, 6: None, None: 1, 7: None, 8: None, 9: 4, 10: None}
    index = sorted(W.capture_history(spark, path).collect(), key=lambda r: r.position)
    assert [r.position for r in index] == list(range(1, len(rows) + 1))
    keys = [(r.url_key.encode(), r.captured_at, r.page_id is not None, r.page_id or 0) for r in index]
    assert keys == sorted(keys)
    assert index[1].url_key == index[3].url_key == "com,a)/x"


def test_damaged_foreign_record_is_marked(spark):
    path = tempfile.mkdtemp(prefix="quire-test-") + "/warc"
    spark.createDataFrame([("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nContent-Length: 500\r\n\r\nHTTP/1.1 200 OK\r\n\r\ncut",)],
                          "value string").coalesce(1).write.option("lineSep", "\r\n\r\n").text(path)
    assert [r.damaged for r in W.read_archives(spark, path).collect()] == [True]


def test_empty_table(spark):
    path = tempfile.mkdtemp(prefix="quire-test-") + "/warc"
    W.write_archives(spark.createDataFrame([], SCHEMA), path)
    assert W.capture_history(spark, path).count() == 0


def test_boundaries_across_the_edges_of_a_page(spark):
    rows = [(1, "a", "WARC/1.0\r\nstarts with a version"), (2, "b", "ends with one\r\n\r\nWARC/1.0"), (3, "c", "plain\r\n")]
    path = tempfile.mkdtemp(prefix="quire-test-") + "/warc"
    W.write_archives(spark.createDataFrame(rows, SCHEMA).coalesce(1), path)
    back = W.read_archives(spark, path).collect()
    assert sorted((r.page_id, r.url, bytes(r.payload).decode()) for r in back) == rows and not any(r.damaged for r in back)
