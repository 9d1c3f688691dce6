"""Quality rules (op 1) and rule ensemble (op 4)."""

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import quality_rules as Q
from quire.llm import rule_ensemble as R
from quire.llm.textstats import COUNTS, ratios, text_stats, with_stats

from .conftest import SCHEMA, WORD, prose


def brute(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    counts = collections.Counter(grams)
    covered = {i + j for i, g in enumerate(grams) if counts[g] > 1 for j in range(3)}
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered)}


def test_counts_match_brute_force():
    rng = random.Random(1)
    for _ in range(500):
        text = "".join(rng.choice(["a", "b ", "c ", "é", "\n", "#", " ", " ", "\x0b", "😀"]) for _ in range(rng.randrange(60)))
        got = dict(zip(COUNTS, text_stats(text.encode())))
        assert {k: got[k] for k in brute(text)} == brute(text), repr(text)
    assert set(text_stats(None)) == {0}


@pytest.fixture(scope="module")
def labelled(spark):
    """Clean prose, and junk of two kinds: marked words and capitals."""
    rng = random.Random(2)
    rows, labels = [], []
    for k in range(900):
        text = prose(rng, rng.randrange(60, 400))
        junk = k % 7 == 0
        if junk:
            text = text.replace(" ", "### ") if k % 2 else text.upper().replace(" ", "!! ")
        rows.append((k, text, "en", "a", len(text)))
        labels.append((k, int(not junk), 0))
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_forest_rejects_junk_and_keeps_clean(labelled):
    docs, labels = labelled
    got = {r.doc_id: r for r in Q.judge(docs, labels).collect()}
    junk = [k for k in got if k % 7 == 0]
    assert sum(got[k].kept for k in junk) <= 0.02 * len(junk)
    assert sum(not r.kept for k, r in got.items() if k % 7) <= 0.01 * len(got)


def test_path_of_outlier_is_short():
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(0, 1, (500, 2)), [[9, 9]]])
    s = Q.fit_forest(x).score(x)
    assert s.argmax() == 500


def test_quality_rules_odd_rows(odd_docs, no_docs, no_labels):
    got = Q.judge(odd_docs, no_labels).collect()
    assert len(got) == odd_docs.count()
    for r in got:
        assert r.kept == (not r.base_failed)  # nothing learned, base rules only
    assert next(r for r in got if r.doc_id == 8).base_failed and next(r for r in got if r.doc_id == 1).base_failed
    assert Q.judge(no_docs, no_labels).count() == 0


def test_bad_labels_are_ignored(spark, odd_docs):
    labels = spark.createDataFrame([(4, None, 0), (5, 7, 0), (None, 1, 0), (10, 1, 0), (10, 0, 0)], "doc_id long, quality int, toxic int")
    assert [tuple(r) for r in Q.clean_labels(labels, "quality").collect()] == [(10, 0)]
    assert Q.judge(odd_docs, labels).count() == odd_docs.count()


def test_ensemble_held_out_accuracy(labelled):
    docs, labels = labelled
    rows = R.classify(docs, labels).collect()
    held = [r for r in rows if r.held_out]
    assert len(held) > 100
    assert sum(r.predicted == int(r.doc_id % 7 != 0) for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_rules_compile_to_the_same_scores(labelled):
    docs, labels = labelled
    stats = with_stats(docs.select("doc_id", "text")).select("doc_id", "stats")
    model = R.learn(stats, labels)
    assert 0 < len(model.rules) < 100
    r = ratios()
    out = stats.select(*[r[f].alias(f) for f in R.FEATURES], model.column([r[f] for f in R.FEATURES]).alias("s")).toPandas()
    assert np.allclose(model.predict(out[R.FEATURES].to_numpy(float)), out["s"])


def test_ensemble_never_learns_from_held_out(labelled):
    docs, labels = labelled
    flipped = labels.withColumn("quality", F.when(R.is_held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a = {r.doc_id: r.score for r in R.classify(docs, labels).collect()}
    b = {r.doc_id: r.score for r in R.classify(docs, flipped).collect()}
    assert a == b


def test_ensemble_odd_rows(spark, odd_docs, no_docs, no_labels):
    got = R.classify(odd_docs, no_labels).collect()
    assert len(got) == odd_docs.count() and all(r.predicted == 1 for r in got)
    assert R.classify(no_docs, no_labels).count() == 0
    one = spark.createDataFrame([(k, 1, 0) for k in range(30)], "doc_id long, quality int, toxic int")
    assert {r.score for r in R.classify(odd_docs, one).collect()}.__len__() == 1
    kept = R.keep_good(odd_docs, no_labels)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
