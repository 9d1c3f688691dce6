"""Mixing sources to target weights (op 3)."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import mixing as M

from .conftest import SCHEMA, WORD, prose


def test_targets_share_everything_and_respect_caps():
    sizes, weights = np.array([1000, 10, 0, 500]), np.array([1.0, 5.0, 2.0, 1.0])
    t = M.share_out(sizes, weights)
    assert abs(t.sum() - sizes.sum()) < 1e-6 and t[1] == 30 and t[2] == 0 and t[0] == t[3] == 740
    assert (M.share_out(np.array([5, 5]), np.array([2.0, 1.0])) == [20 / 3, 10 / 3]).all()
    assert M.share_out(np.array([0, 0]), np.array([2.0, 1.0])).sum() == 0


def test_permutation_is_a_bijection():
    for n in (1, 2, 3, 5, 16, 17, 1000, 65537):
        for key in (0, 7, 1 << 33):
            x = M.permute(np.arange(n), np.full(n, n), np.full(n, key))
            assert sorted(x) == list(range(n))


def test_shard_counts_are_near_their_expectation():
    share = np.array([0.5, 0.3, 0.15, 0.05])
    for shard in range(20):
        c = M.shard_counts(shard, 101, share)
        assert c.sum() == 101 and (abs(c - 101 * share) <= len(share)).all()


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(9)
    rows = [(k, prose(rng, rng.choice([0, 3, 40, 200, 900])), "en", rng.choice(["a", "a", "a", "b", "c", None]), 0) for k in range(400)]
    rows += [(500, None, "en", "a", 0), (501, "", None, "zz", 0), rows[3], rows[3]]
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(4)


def test_taken_matches_the_mix_itself(corpus, monkeypatch):
    """Brute force over the mixed texts: words taken, near targets, at most three times, blocks whole."""
    monkeypatch.setattr(M, "BUCKET_ROWS", 50)
    rows, docs = corpus
    plan = M.plan_sources(M.with_size(docs), 16)
    assert plan.names == ["a", "b", "c", "zz", None]
    got = M.taken(M.place(M.with_size(docs), plan), plan).collect()
    assert len(got) == len(rows)
    size = {r[0]: len(WORD.findall(r[1] or "")) for r in rows}
    mixed = M.mixed_texts(docs, 16).collect()
    words = {s: 0 for s in plan.names}
    count = {}
    for r in mixed:
        assert len(r.text.split()) == r.n_words <= 16
        words[r.source] += r.n_words
        count[(r.source, r.block)] = count.get((r.source, r.block), 0) + 1
    for name, target in zip(plan.names, plan.targets):
        of = [r for r in got if r.source == name]
        assert sum(r.taken for r in of) == words[name]
        assert abs(words[name] - target) <= 4 * 16 + 0.02 * target
    assert all(r.size == size[r.doc_id] and r.taken <= 3 * r.size for r in got)
    assert max(count.values()) <= 3
    # every block of a source comes once before any comes again
    for name, n in zip(plan.names, plan.n_blocks):
        times = [c for (s, _), c in count.items() if s == name]
        assert not times or max(times) - (min(times) if len(times) == n else 0) <= 1


def test_rerun_gives_the_same_mix(corpus):
    _, docs = corpus
    a, b = (sorted(map(tuple, M.mixed_texts(d, 16).drop("doc_ids").collect()), key=str) for d in (docs, docs.repartition(7)))
    assert a == b


def test_mixing_odd_rows(odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        plan = M.plan_sources(M.with_size(docs))
        got = M.taken(M.place(M.with_size(docs), plan), plan).collect()
        assert len(got) == docs.count() and all(r.taken <= 3 * r.size for r in got)
        assert M.mixed_texts(docs).count() >= 0
    assert M.mixed_texts(no_docs).count() == 0
