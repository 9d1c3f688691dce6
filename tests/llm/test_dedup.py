"""SimHash near-dedup (op 2) and substring dedup (op 10)."""

import collections
import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quire.llm import simhash as S
from quire.llm import substrings as U
from quire.llm.components import components

from .conftest import SCHEMA, WORD, prose


def brute_simhash(text):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    grams = [" ".join(words[i:i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    ones = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(grams))


def brute_components(fps, d):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= d:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(fps))]


def test_fingerprint_matches_brute_force(spark):
    rng = random.Random(3)
    texts = [None, "", "One", "One TWO", "ÀÉ x Y", *[prose(rng, rng.randrange(1, 60)) for _ in range(50)]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.fp & (2 ** 64 - 1) for r in df.select("doc_id", S.fingerprint("text").alias("fp")).collect()}
    assert got == {i: brute_simhash(t) for i, t in enumerate(texts)}


@pytest.mark.parametrize("distance,bucket", [(0, 32), (1, 3), (2, 3), (2, 32)])
def test_links_give_brute_force_components(spark, distance, bucket):
    """Families of fingerprints a few bits apart, small and large buckets."""
    rng = random.Random(4)
    fps = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(25):
            f = centre
            for _ in range(rng.randrange(4)):
                f ^= 1 << rng.randrange(64)
            fps.add(f)
    fps = sorted(fps | {0, 2 ** 64 - 1})
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    roots = {r.node: r.root for r in components(S.links(df, distance, bucket)).collect()}
    expected = brute_components(fps, distance)
    groups = collections.defaultdict(set)
    for x, e in zip(signed, expected):
        groups[e].add(roots.get(x, x))
    assert all(len(g) == 1 for g in groups.values()) and len({g.copy().pop() for g in groups.values()}) == len(groups)


def test_near_duplicates_odd_rows(odd_docs, no_docs):
    rows = S.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = collections.defaultdict(set)
    for r in rows:
        by_id[r.doc_id].add(r.component_id)
    assert by_id[4] == by_id[5] == {4} and by_id[1] == by_id[2] == by_id[3] == {1}
    assert S.near_duplicates(no_docs).count() == 0
    kept = S.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = sorted((r.doc_id is None, r.doc_id or 0) for r in kept.select("doc_id").collect())
    assert ids == sorted([(False, k) for k in (1, 4, 7, 8, *range(10, 30))] + [(True, 0)])  # the unnamed text is a group of its own


def test_repeated_rows_leave_one(spark):
    text = prose(random.Random(1), 50)
    df = spark.createDataFrame([(1, text, "en", "a", 0)] * 3 + [(2, text, "en", "a", 0)], SCHEMA)
    assert [r.doc_id for r in S.keep_one(df).collect()] == [1]


def test_rows_that_share_an_id_keep_their_texts(spark):
    """Groups are told apart by text: an id with two texts stands for both."""
    rng = random.Random(2)
    a, b, c = (prose(rng, 60) for _ in range(3))
    rows = [(1, a), (1, b), (2, b), (None, c), (None, c), (3, a), (None, a), (4, b)]
    df = spark.createDataFrame([(i, t, "en", "s", k) for k, (i, t) in enumerate(rows)], SCHEMA)
    kept = sorted(((r.doc_id, r.text) for r in S.keep_one(df).collect()), key=str)
    assert kept == sorted([(1, a), (1, b), (None, c)], key=str)


def brute_substrings(rows, width):
    words = [WORD.findall(t or "") for _, t in rows]
    counts = collections.Counter(tuple(w[i:i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for (doc_id, _), w in zip(rows, words):
        gone = {i + j for i in range(len(w) - width + 1) if counts[tuple(w[i:i + width])] > 1 for j in range(width)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("width,gram,chunk", [(35, 8, 1 << 20), (4, 2, 16), (3, 3, 8)])
def test_substrings_match_brute_force(spark, monkeypatch, width, gram, chunk):
    """Shared passages, periodic texts, repeated rows; small chunks meet in the shuffle."""
    monkeypatch.setattr(U, "CHUNK_WINDOWS", chunk)
    rng = random.Random(width)
    shared = [prose(rng, rng.randrange(2, 90)) for _ in range(6)]
    rows = [(k, " ".join(rng.choice(shared) if rng.random() < 0.4 else prose(rng, rng.randrange(20), 6) for _ in range(4)))
            for k in range(120)]
    rows += [(200, None), (201, ""), (202, "a " * 300), (203, "a b " * 100), (None, shared[0]), (5, rows[5][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = U.dedup_substrings(df, width, gram).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256))
    assert sorted(map(tuple, got.collect()), key=str) == brute_substrings(rows, width)


def test_substrings_odd_rows(odd_docs, no_docs):
    rows = U.dedup_substrings(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert all(r.n_removed == r.n_words for r in rows if r.doc_id in (4, 5, 8))
    assert U.dedup_substrings(no_docs).count() == 0


def test_long_component_chain(spark):
    df = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(500, 501)], "u long, v long")
    got = {r.node: r.root for r in components(df).collect()}
    assert got == {**{i: 0 for i in range(1, 301)}, 501: 500}


def test_frequent_minimizers_do_not_meet_in_one_task(spark, monkeypatch):
    """A short phrase in many contexts: its rows are counted window by window, with the same result."""
    monkeypatch.setattr(U, "CHUNK_WINDOWS", 64)
    rng = random.Random(3)
    phrase, shared = "one two three four five six", prose(rng, 30)
    rows = [(k, " ".join([prose(rng, 9), phrase, prose(rng, 9), shared if k % 7 == 0 else "", phrase])) for k in range(150)]
    rows += [(200, None), (None, rows[4][1]), (5, rows[5][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).cache()
    assert U.frequent(df, 8, 3, rows=20).count() > 0
    monkeypatch.setattr(U, "_meet", limited(U._meet, 20))
    got = U.dedup_substrings(df, 8, 3, rows=20).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256))
    assert sorted(map(tuple, got.collect()), key=str) == brute_substrings(rows, 8)
    hot = [r.minimizer for r in U.frequent(df, 8, 3, rows=20).collect()]
    sizes = {(r.hot, r.n) for r in U.occurrences(df, 8, 3, wide=np.sort(np.array(hot))).filter("windows IS NOT NULL").select(
        F.col("minimizer").isin(hot).alias("hot"), F.octet_length("windows").alias("n")).collect()}
    assert {h for h, _ in sizes} == {True, False} and all(n % (8 if h else 6) == 0 for h, n in sizes)
    shuffled = U.remove_spans(df, U.repeated_spans(df, 8, 3, rows=20, max_sent_hot=0))  # too many to be sent to every task
    assert sorted(map(tuple, shuffled.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256)).collect()), key=str) == brute_substrings(rows, 8)


def limited(meet, rows):
    """``meet`` that refuses more than ``rows`` rows of one minimizer."""
    def run(table, *args):
        counts = collections.Counter(table.column("minimizer").to_pylist())
        assert not counts or max(counts.values()) <= rows
        return meet(table, *args)
    return run


def test_keys_of_fingerprints_cross_the_network_once(spark, monkeypatch):
    from quire.llm import simhash
    plans, cut = [], simhash.cut
    monkeypatch.setattr(simhash, "cut", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or cut(df))
    fps = spark.createDataFrame([(0,), (1,), (3,), (1 << 40,), (-1,)], "fp bigint")
    found = {(r["u"], r["v"]) for r in simhash.links(fps).collect()}
    assert found == {(0, 1), (0, 3), (1, 3), (0, 1 << 40), (1, 1 << 40)}
    assert sum(p.count("Exchange hashpartitioning(key") for p in plans) == 1
