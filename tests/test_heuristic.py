"""Heuristic AST: numbering, ranges, equality of the wide and long layouts."""

from pyspark.sql import functions as F

from quire.functions.text import source_hash_of_text
from quire.operators.heuristic import heuristic_nodes_long, heuristic_nodes_wide
from quire.sources.corpus import documents_wide, wide_to_long
from tests.conftest import SF_SMOKE, rows


def pages_df(spark, doc_pages):
    data = [(d, i, t) for d, ps in doc_pages.items() for i, t in enumerate(ps)]
    return spark.createDataFrame(data, "doc_id BIGINT, page_index INT, page_text STRING")


def build_reference(pages, start=None, end=None, delim="\n\n"):
    """Recursive build of the heuristic tree, for comparison."""
    pc = len(pages)
    s = 0 if start is None else max(0, min(start, pc - 1))
    e = pc - 1 if end is None else max(s, min(end, pc - 1))
    seq, out = 0, []
    sections = []
    for p in range(s, e + 1):
        paras = [b.strip() for b in pages[p].split(delim) if b.strip()] if pages[p].strip() else []
        kids = []
        for t in paras:
            seq += 1
            kids.append(("paragraph", p, seq, t, []))
        seq += 1
        sections.append(("section", p, seq, None, kids))
    seq += 1
    root = ("document", 0, seq, None, sections)

    def walk(n, depth):
        out.append((n[0], n[1], n[2], n[3], depth, len(n[4])))
        for k in n[4]:
            walk(k, depth + 1)
    walk(root, 0)
    return out


def test_matches_recursive_reference(spark):
    docs = {1: ["a\n\nb", "", "c\n\n\n\nd\n\ne"], 2: ["only"], 3: ["", "", ""]}
    for start, end in [(None, None), (1, 2), (9, None), (2, 0), (-3, 0)]:
        b = heuristic_nodes_long(pages_df(spark, docs), start=start, end=end)
        got = rows(b.nodes, ["doc_id", "pre"])
        for d, ps in docs.items():
            mine = [(r["node_type"], r["page_index"], int(r["node_id"].split(":")[3]), r["text_content"],
                     r["depth"], r["children_count"]) for r in got if r["doc_id"] == d]
            assert mine == build_reference(ps, start, end), (d, start, end)


def test_blank_pages_range(spark):
    b = heuristic_nodes_long(pages_df(spark, {7: [""] * 5}), start=1, end=2)
    got = rows(b.nodes, ["pre"])
    assert [r["node_type"] for r in got] == ["document", "section", "section"]
    assert [r["page_index"] for r in got] == [0, 1, 2]
    assert rows(b.docs)[0]["page_count"] == 5


def test_clamps(spark):
    p = pages_df(spark, {1: ["x"] * 5})
    last = rows(heuristic_nodes_long(p, start=9).nodes.filter("node_type = 'section'"))
    assert [r["page_index"] for r in last] == [4]
    one = rows(heuristic_nodes_long(p, start=3, end=1).nodes.filter("node_type = 'section'"))
    assert [r["page_index"] for r in one] == [3]
    neg = rows(heuristic_nodes_long(p, start=-2, end=0).nodes.filter("node_type = 'section'"))
    assert [r["page_index"] for r in neg] == [0]


def test_invariants_and_layouts_agree(spark):
    d = spark.read.parquet(f"{SF_SMOKE}/documents.parquet")
    w = documents_wide(d, lines_per_page=3)
    a = heuristic_nodes_wide(w, "\n").nodes
    long = wide_to_long(w).join(w.select("doc_id", source_hash_of_text("source").alias("source_hash")), "doc_id")
    b = heuristic_nodes_long(long, "\n").nodes
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert a.groupBy("doc_id", "node_id").count().filter("count > 1").count() == 0
    dense = a.groupBy("doc_id").agg(F.max("pre").alias("m"), F.count(F.lit(1)).alias("n"))
    assert dense.filter("m + 1 <> n").count() == 0
    assert a.filter("last < pre").count() == 0


def test_padded_paragraph_stripped(spark):
    b = heuristic_nodes_long(pages_df(spark, {1: ["  \tpara one　"]}))
    assert [r["text_content"] for r in rows(b.nodes.filter("node_type = 'paragraph'"))] == ["para one"]


def test_property_random_documents(spark):
    """Random pages (blank lines, padding, empty pages) and ranges: the
    closed-form numbering equals a recursive build."""
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    words = st.sampled_from(["a", "b c", " x ", " y", "\t", "", "z "])
    page = st.lists(words, max_size=6).map(lambda ws: "\n\n".join(ws))
    doc = st.lists(page, min_size=1, max_size=4)
    rng = st.one_of(st.none(), st.integers(-2, 5))

    @settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
    @given(doc, rng, rng)
    def check(pages, start, end):
        b = heuristic_nodes_long(pages_df(spark, {1: pages}), start=start, end=end)
        got = [(r["node_type"], r["page_index"], int(r["node_id"].split(":")[3]), r["text_content"],
                r["depth"], r["children_count"]) for r in rows(b.nodes, ["pre"])]
        assert got == build_reference(pages, start, end)

    check()
