"""Cross-tokenizer alignment (op 11) against ranges compared pair by pair."""

import collections
import hashlib
import json
import random

import sentencepiece
from tokenizers import Tokenizer

from quire.llm import align as L

from .conftest import SCHEMA, prose

TEXTS = ["a b", "Hello, world", "a  b\n\tc", " lead and trail ", "naïve café — 東京 😀", "<s>hi</s> <|endoftext|> <unk>", "▁x", "ﬁ x",
         "\x00nul", "", None, "﻿bom", "x" * 300, "don't  stop", "1234567890 12,34"]


def models():
    a = Tokenizer.from_file(L.A_PATH)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=L.B_PATH)


def ranges(text, a, b):
    """Brute force: (id, start, stop) of both sides from the vocabularies, [] where a side does not join to the text."""
    if not text:
        return [], []
    want = (" " + text).encode()
    # The byte of a character of the byte-level alphabet, by encoding the bytes as the library does.
    table = {}
    extra = 256
    for x in range(256):
        if 33 <= x <= 126 or 161 <= x <= 172 or 174 <= x <= 255:
            table[chr(x)] = x
        else:
            table[chr(extra)] = x
            extra += 1
    sides = []
    for pieces in ([(i, bytes(table[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids],
                   [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())
                    for i in b.encode(text)]):
        at, out = 0, []
        for i, x in pieces:
            out.append((i, at, at + len(x)))
            at += len(x)
        sides.append(out if b"".join(x for _, x in pieces) == want else None)
    return sides if all(s is not None for s in sides) else ([], [])


def brute(rows):
    a, b = models()
    sides = [ranges(t, a, b) for _, t in rows]
    linked = [[(x[0], y[0]) for x in ra for y in rb if x[2] == y[2]] for ra, rb in sides]
    total = collections.Counter(p for links in linked for p in links)
    most = collections.defaultdict(int)
    for (_, y), n in total.items():
        most[y] = max(most[y], n)
    out = []
    for (i, _), (ra, rb), links in zip(rows, sides, linked):
        cuts = [0, *sorted({x[2] for x in ra} & {y[2] for y in rb})]
        groups = ["|".join(",".join(str(x[0]) for x in side if lo < x[2] <= hi) for side in (ra, rb)) for lo, hi in zip(cuts, cuts[1:])]
        out.append((i, len(ra), len(rb), len(groups), len(links), sum(total[p] == most[p[1]] for p in links),
                    sum(total[p] for p in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if ra else ""))
    return out


def collected(df):
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr)


def test_rows_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(L, "BATCH_BYTES", 400)  # many batches, texts longer than one
    rng = random.Random(11)
    rows = [(k, t) for k, t in enumerate(TEXTS * 2 + [prose(rng, rng.randrange(1, 60)) for _ in range(40)])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert collected(L.alignment(df)) == sorted(brute(rows), key=repr)


def test_overlaps_match_brute_force(spark):
    rows = list(enumerate(TEXTS))
    a, b = models()
    want = []
    for i, t in rows:
        ra, rb = ranges(t, a, b)
        want += [(i, m, x[0], n, y[0], max(x[1], y[1]), min(x[2], y[2]), x[2] == y[2])
                 for m, x in enumerate(ra) for n, y in enumerate(rb) if x[1] < y[2] and y[1] < x[2]]
    got = [tuple(r) for r in L.token_overlaps(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got) == sorted(want)


def test_odd_rows(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect() if not r.text or len(r.text) < 10_000]
    got = collected(L.alignment(odd_docs.filter("text is null or length(text) < 10000")))
    assert got == sorted(brute(rows), key=repr)
    whole = collected(L.alignment(odd_docs))
    assert len(whole) == odd_docs.count() and len({r[7] for r in whole if r[0] in (4, 5)}) == 1
    assert L.alignment(no_docs).collect() == [] and L.token_overlaps(no_docs).collect() == []


def test_invalid_utf8_has_no_tokens(spark):
    df = spark.sql("SELECT 1L AS doc_id, cast(X'61FF62' AS string) AS text")
    assert collected(L.alignment(df)) == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_texts_of_no_tokens_only(spark):
    df = spark.createDataFrame([(1, None, "en", "a", 0), (2, "", "en", "a", 0)], SCHEMA)
    assert [r[1:7] for r in collected(L.alignment(df))] == [(0,) * 6] * 2


def test_ids_are_those_of_the_file_for_every_code_point():
    a = models()[0]
    fast = L.ByteLevel(L.A_PATH)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    for lo in range(0, len(points), 50_000):
        texts = [f"a{c}b {c}{c} 1{c}1 {c}'s.{c}. \n{c} {c}  x" for c in points[lo:lo + 50_000]]
        assert fast.encode(texts) == [e.ids for e in a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]


def test_other_files_use_their_own_library(tmp_path):
    spec = json.load(open(L.A_PATH, encoding="utf-8"))
    spec["model"]["merges"] = spec["model"]["merges"][:300][::-1]  # no longer in the order of the ids
    json.dump(spec, open(tmp_path / "other.json", "w"))
    a = Tokenizer.from_file(str(tmp_path / "other.json"))
    texts = ["the other one", "in the end <|endoftext|>"]
    a.encode_special_tokens = True
    assert L.ByteLevel(str(tmp_path / "other.json")).encode(texts) == [a.encode(" " + t, add_special_tokens=False).ids for t in texts]
