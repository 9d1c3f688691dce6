"""Merkle manifest (op 13) against plain recursion over lists."""

import collections
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from quire.llm import merkle as M

from .conftest import SCHEMA


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i:i + 2])) for i in range(0, len(out[-1]), 2)])
    return out


def proof(tree, i):
    steps = []
    for nodes in tree[:-1]:
        steps.append(("L", nodes[i - 1]) if i & 1 else ("R", nodes[i + 1]) if i + 1 < len(nodes) else ("U", ""))
        i //= 2
    return steps


def brute(rows):
    """rows: (doc_id, text, lang, source, n_chars) -> sorted (doc_id, leaf, subroot, root, path)."""
    trees = collections.defaultdict(list)
    for i, text, lang, source, n in rows:
        trees[lang].append((i is not None, i or 0, sha("".join(map(field, (i, source, lang, n, text)))), i))
    order = sorted(trees, key=lambda k: (k is not None, (k or "").encode()))
    built = {k: levels([leaf for _, _, leaf, _ in sorted(trees[k], key=lambda r: r[:3])]) for k in order}
    top = levels([built[k][-1][0] for k in order])
    out = []
    for t, k in enumerate(order):
        for at, (_, _, leaf, i) in enumerate(sorted(trees[k], key=lambda r: r[:3])):
            path = [a + b for a, b in proof(built[k], at) + proof(top, t)]
            out.append((i, leaf, built[k][-1][0], top[-1][0], path))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bits,parts", [(1, 3), (2, 5), (3, 1), (10, 4)])
def test_proofs_match_brute_force(spark, monkeypatch, bits, parts):
    """One to five tiers, hot and single-leaf trees, ragged right edges."""
    monkeypatch.setattr(M, "BITS", bits)
    rng = random.Random(bits)
    rows = [(k, f"text {k}", rng.choice(["en"] * 20 + ["fr", "é", "z", None, "zz"]), f"s{k % 3}", k) for k in range(70)]
    rows += [(1000, "alone", "only", "s", 5), (1001, None, "", None, None)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    got = M.verified(M.manifest_proofs(docs)).collect()
    assert sorted(((r.doc_id, r.leaf, r.subroot, r.root, list(r.path)) for r in got), key=repr) == brute(rows)
    assert all(r.verified and r.folded_root == r.root for r in got)
    assert all(r.proof_sha256 == sha("".join(p[1:] for p in r.path)) for r in got)


def test_log_is_postorder_and_positions_are_closed_form(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(M, "BITS", 2)
    sizes = [1, 2, 3, 4, 5, 7, 8, 9, 16, 17, 31, 33]
    leaves = spark.createDataFrame([(t, n, i, sha(f"{t}.{i}")) for t, n in enumerate(sizes) for i in range(n)], "tree long, n long, idx long, digest string")
    tiers = M.grow(leaves, str(tmp_path / "log"))
    got = collections.defaultdict(list)
    for t in tiers:
        for r in t.collect():
            got[r.tree].append((r.pos, r.level, r.idx, r.digest))
    for t, n in enumerate(sizes):
        tree = levels([sha(f"{t}.{i}") for i in range(n)])
        order = []

        def visit(level, i):
            if level:
                for child in (2 * i, 2 * i + 1):
                    if child < len(tree[level - 1]):
                        visit(level - 1, child)
            order.append((len(order), level, i, tree[level][i]))

        visit(len(tree) - 1, 0)
        assert sorted(got[t]) == order
    assert {(r.tree, r.root) for r in M.roots(tiers).collect()} == {(t, levels([sha(f"{t}.{i}") for i in range(n)])[-1][0]) for t, n in enumerate(sizes)}


def test_builders_write_in_completion_order():
    nodes = M.append_all([str(k) for k in range(7)], 0, 0, 7)
    assert [M.position(lv, i, 7) for lv, i, _ in nodes] == list(range(len(nodes)))


def test_tampering_is_found(spark):
    rows = [(k, f"t{k}", "en", "a", k if k % 5 else None) for k in range(60)]
    docs = spark.createDataFrame(rows, SCHEMA)

    def other(c):
        return F.when(F.col("doc_id") % 3 == 0, (F.col(c) + 1).cast("string")).otherwise(F.col(c).cast("string")) if c == "n_chars" else F.col(c)

    for r in M.verified(M.manifest_proofs(docs, claimed=other)).collect():
        assert r.verified == (r.doc_id % 3 != 0 or r.doc_id % 5 == 0) == (r.folded_root == r.root)


def test_odd_rows(odd_docs, no_docs):
    names = SCHEMA.replace(" long", "").replace(" string", "").split(", ")
    rows = [tuple(r) for r in odd_docs.select(*names).collect()]
    got = M.verified(M.manifest_proofs(odd_docs)).collect()
    assert sorted(((r.doc_id, r.leaf, r.subroot, r.root, list(r.path)) for r in got), key=repr) == brute(rows)
    assert M.manifest_proofs(no_docs).collect() == []
