"""Exact dedup by merged digest runs (op 12) against a dictionary."""

import collections
import hashlib
import random

import numpy as np
import pytest

from quire.llm import exact_dedup as X

LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, keep):
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(LOWER)].append(i)
    out = []
    for i, t in rows:
        ids = groups[(t or "").translate(LOWER)]
        known = [x for x in ids if x is not None]
        best = (min if keep == "smallest" else max)(known) if known else None
        out.append((i, best, len(ids), hashlib.sha256((t or "").translate(LOWER).encode()).hexdigest()))
    return out


def check(df, rows, keep):
    got = X.duplicates(df, keep=keep).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, bytes(r.digest).hex()) for r in got), key=repr) == sorted(brute(rows, keep), key=repr)
    kept = [r for r in got if r.kept]
    assert sorted(bytes(r.digest) for r in kept) == sorted({bytes(r.digest) for r in got})  # one row of each text
    assert all(r.doc_id == r.keep_id for r in kept)


@pytest.mark.parametrize("keep", ["smallest", "largest"])
@pytest.mark.parametrize("parts,fan_in,piece", [(1, 16, 4096), (5, 2, 3), (9, 3, 2), (7, 16, 4)])
def test_groups_match_brute_force(spark, monkeypatch, keep, parts, fan_in, piece):
    """Hot texts, many rounds, pieces of a few entries."""
    monkeypatch.setattr(X, "FAN_IN", fan_in)
    monkeypatch.setattr(X, "PIECE", piece)
    rng = random.Random(parts)
    rows = [(k, rng.choice(["hot Text", "HOT text", f"t{rng.randrange(90)}", f"T{rng.randrange(90)}", None, "", "É", "é"])) for k in range(400)]
    rng.shuffle(rows)
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts), rows, keep)


def test_odd_rows(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    check(odd_docs, rows, "largest")
    assert X.duplicates(no_docs).collect() == []
    with pytest.raises(ValueError):
        X.duplicates(no_docs, keep="first")


def test_ids_of_all_signs_and_none(spark):
    rows = [(-5, "a"), (3, "A"), (None, "a"), (None, "b"), (None, "b"), (-2 ** 63, "c"), (2 ** 63 - 1, "C"), (7, "d"), (7, "d"), (7, "d")]
    for keep in ("smallest", "largest"):
        check(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), rows, keep)


def test_equal_first_bytes_are_not_equal_texts():
    """Entries that share a prefix of the digest, or the digest but not the length, stay apart."""
    x = np.zeros(4, X._ENTRY)
    x["digest"] = [b"\x01" * 31 + b"\x02", b"\x01" * 32, b"\x01" * 32, b"\x01" * 32]
    x["n_bytes"], x["id"], x["count"] = [5, 5, 5, 6], [4, 3, 2, 1], 1
    out = X.fold(x, True)
    assert out["id"].tolist() == [2, 1, 4] and out["count"].tolist() == [2, 1, 1]


def test_merge_releases_what_is_final(monkeypatch):
    monkeypatch.setattr(X, "FAN_IN", 2)
    monkeypatch.setattr(X, "PIECE", 4)
    rng = random.Random(0)
    runs = []
    for _ in range(5):
        x = np.zeros(60, X._ENTRY)
        x["digest"] = [bytes([rng.randrange(40)]) * 32 for _ in range(60)]
        x["id"], x["count"] = rng.sample(range(1000), 60), 1
        x = X.fold(x, True)
        runs += [(x[i:i + 4].tobytes()[:32], x[i:i + 4]) for i in range(0, len(x), 4)]
    runs.sort(key=lambda r: r[0])
    parts = list(X.merge(iter(runs), True))
    whole = np.concatenate(parts)
    assert len(parts) > 5 and whole["count"].sum() == 300
    digests = [bytes(d).ljust(32, b"\0") for d in whole["digest"]]
    assert digests == sorted(set(digests))
