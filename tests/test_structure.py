"""Deep trees, gates, ranges, ranks and evidence: hand cases of the structural operators."""

import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows

PAGES = "doc_id bigint, page_index int, page_text string"


def chain_json(levels):
    """A chain of ``levels`` nodes as text (json.dumps itself would recurse)."""
    node = '{"id": "n%d", "type": "section", "page_index": 0, "children": ['
    return ('{"schemaVersion": "1.0", "sourceHash": "h", "pageCount": 1, "root": ' + "".join(node % k for k in range(levels)) + "]}" * levels + "}")


@pytest.mark.parametrize("levels", [1000, 30_000])
def test_json_import_of_deep_chains(spark, levels):
    from quire.operators.tree import nodes_from_json
    found = nodes_from_json(spark.createDataFrame([(1, chain_json(levels))], "doc_id bigint, json string"))
    got = rows(found.nodes, ["pre"])
    assert [r["depth"] for r in got] == list(range(levels)) and {r["last"] for r in got} == {levels - 1}
    assert [r["parent_pre"] for r in got[1:]] == list(range(levels - 1)) and got[-1]["children_count"] == 0
    plan = found.nodes._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") <= 1


def test_json_import_parses_alike_by_both_ways(spark):
    """A deep list sends the document to the parser with its own stack; its other values are read the same."""
    from quire.operators.tree import nodes_from_json
    node = {"id": "aé\"\\\n", "type": "paragraph", "page_index": 2.0, "text_content": "x", "mcid": "7", "bbox": {"x": 1, "y": 2.5, "width": 3, "height": 4e0},
            "attributes": {"level": 2, "struct_type": "/P", "heuristic": True}, "children": []}
    doc = {"schema_version": "1.0", "sourceHash": "h", "page_count": 3, "root": node, "extra": [None, True, -1.5e3, "", {}, []]}
    plain = json.dumps(doc)
    deep = plain[:-1] + ', "deep": ' + "[" * 50_000 + "]" * 50_000 + "}"
    bad = [deep[:-1], deep + "x", deep.replace('"extra"', "extra"), deep.replace("[null", "[,"), '{"a" 1}', "[1,]", "", None, "NaN", "7", '{"root": 5}',
           json.dumps({**doc, "root": {"id": "a", "type": "p"}})]
    df = spark.createDataFrame([(1, plain), (2, deep), *[(10 + k, b) for k, b in enumerate(bad)]], "doc_id bigint, json string")
    found = nodes_from_json(df)
    one, two = rows(found.nodes, ["doc_id"])
    assert {**one, "doc_id": 0} == {**two, "doc_id": 0}
    assert (one["page_index"], one["mcid"], one["level"], one["heuristic"], one["bbox"]["height"]) == (2, 7, 2, True, 4.0)
    reasons = {r["doc_id"]: r["reason"] for r in rows(found.rejected)}
    expected = ["json", "json", "json", "json", "json", "json", "json", "json", "json", "header", "header", "node"]
    assert [reasons.get(10 + k) for k in range(len(bad))] == expected


def test_deep_element_chain_is_linear(spark):
    from quire.operators.tagged import tagged_nodes
    from quire.schemas import ELEMENTS
    n = 10_000
    el = spark.createDataFrame([(1, k, k - 1 if k else None, 0, "/Document" if k == 0 else "/Sect", None, None, None) for k in range(n)], ELEMENTS)
    docs = spark.createDataFrame([(1, "ab" * 32, 1)], "doc_id bigint, source_hash string, page_count int")
    got = rows(tagged_nodes(el, docs).nodes, ["pre"])
    assert [r["depth"] for r in got] == list(range(n)) and {r["last"] for r in got} == {n - 1}
    assert [r["parent_pre"] for r in got] == [None, *range(n - 1)]


def test_walk_orders_siblings_and_skips_the_unreachable(spark):
    from quire.operators.tagged import _walk
    from quire.schemas import ELEMENTS
    edges = [(0, None, 1), (1, None, 0), (2, 0, 5), (3, 0, 5), (4, 2, 0), (5, 99, 0), (6, 7, 0), (7, 6, 0), (8, 5, 0), (9, 9, 0)]
    el = spark.createDataFrame([(1, e, p, k, "/P", None, None, None) for e, p, k in edges], ELEMENTS)
    got = {r["elem_id"]: (r["seq"], r["last_seq"], r["depth0"], r["n"]) for r in rows(_walk(el))}
    assert got == {1: (0, 0, 0, 5), 0: (1, 4, 0, 5), 2: (2, 3, 1, 5), 4: (3, 3, 2, 5), 3: (4, 4, 1, 5)}
    assert _walk(el.limit(0)).count() == 0


def test_builders_refuse_documents_beyond_the_gate(spark):
    from quire.operators.heuristic import heuristic_nodes_long, heuristic_nodes_wide
    from quire.sources.corpus import documents_wide
    pages = spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (2, 0, "c"), (3, 0, "x" * 50)], PAGES)
    b = heuristic_nodes_long(pages, max_pages=1, max_file_size=20)
    assert [r["doc_id"] for r in rows(b.docs)] == [2] and {r["doc_id"] for r in rows(b.nodes)} == {2}
    assert {r["doc_id"]: (r["n_bytes"], r["page_count"], r["reason"]) for r in rows(b.rejected)} == {1: (3, 2, "too_many_pages"), 3: (50, 1, "size")}
    docs = spark.createDataFrame([(1, "a\nb\nc"), (2, "é" * 10), (3, None)], "doc_id bigint, text string")
    w = heuristic_nodes_wide(documents_wide(docs, lines_per_page=1), max_pages=2, max_file_size=19)
    assert [r["doc_id"] for r in rows(w.docs)] == [3]
    assert {r["doc_id"]: r["reason"] for r in rows(w.rejected)} == {1: "too_many_pages", 2: "size"}


def test_merge_and_split_count_pages_by_rank(spark):
    from quire.operators.docops import merge_docs, split_doc
    pages = spark.createDataFrame([(1, 0, ""), (1, 1, ""), (1, 5, ""), (2, 0, ""), (2, 1, ""), (2, 2, "")], PAGES)
    groups = spark.createDataFrame([(9, 1, 0), (9, 2, 1)], "group_id bigint, doc_id bigint, ord int")
    got = rows(merge_docs(pages, groups), ["merged_page_index"])
    assert [(r["doc_id"], r["page_index"], r["merged_page_index"], r["group_page_count"]) for r in got] == [
        (1, 0, 0, 6), (1, 1, 1, 6), (1, 5, 2, 6), (2, 0, 3, 6), (2, 1, 4, 6), (2, 2, 5, 6)]
    assert [r["chunk_index"] for r in rows(split_doc(pages, [2]), ["doc_id", "page_index"])] == [0, 0, 1, 0, 0, 1]
    assert [r["chunk_page_count"] for r in rows(split_doc(pages, None, 2), ["doc_id", "page_index"])] == [2, 2, 1, 2, 2, 1]


def test_forensic_evidence_and_checks(spark):
    from quire.operators.audit import forensic_evidence, forensic_report, forensic_scan
    html = "é<script >a</script><meta x>" + "b" * 50 + "<SCRIPT\n>javascript:"
    df = spark.createDataFrame([(1, "u", html), (1, "u", html), (2, "u", None), (3, "u", "")], "page_id bigint, url string, html string")
    got = rows(forensic_evidence(df, ["javascript"]))
    assert len(got) == 6
    for r in got:
        assert html[r["start"]:].startswith(r["snippet"][:r["stop"] - r["start"]]) and html[r["start"]:r["start"] + len(r["snippet"])] == r["snippet"]
        assert r["finding_id"] == "1:javascript" and r["severity"] == "high"
    assert sorted(r["match_no"] for r in got) == [0, 0, 1, 1, 2, 2]
    assert {r["category"] for r in rows(forensic_scan(df, ["metadata"]))} == {"metadata"}
    assert rows(forensic_report(df, ["metadata"]))[0]["checks"] == ["metadata"]
    for f in (forensic_evidence, forensic_report, forensic_scan):
        with pytest.raises(ValueError):
            f(df, ["no-such-check"])


def test_conformance_target_selects_rules(spark):
    from quire.operators.audit import accessibility_summary
    f = spark.createDataFrame([(1, "no-headings"), (2, "figure-no-text")], "doc_id bigint, rule_id string")
    d = spark.createDataFrame([(1, 1), (2, 1)], "doc_id bigint, page_count int")
    assert [r["passed"] for r in rows(accessibility_summary(f, d), ["doc_id"])] == [False, False]
    assert [r["passed"] for r in rows(accessibility_summary(f, d, "PDF/A-3b"), ["doc_id"])] == [True, False]
    with pytest.raises(ValueError):
        accessibility_summary(f, d, "NO-SUCH")


def test_tables_of_any_frame(spark):
    from quire.operators.tables import cited_tables, frame_tables, table_cells
    df = spark.sql("SELECT * FROM VALUES (1, 'b', timestamp'2020-01-02 03:04:05', array(1, 2)), (1, null, null, null), (null, 'x', null, null) AS t(k, s, at, list)")
    b = frame_tables(df, "k", ["s"], header=True, parents=spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int"))
    cells = rows(table_cells(b.nodes), ["doc_id", "row", "col"])
    assert [(r["doc_id"], r["row"], r["col"], r["text"]) for r in cells] == [
        (1, 0, 0, "s"), (1, 0, 1, "at"), (1, 0, 2, "list"), (1, 1, 0, None), (1, 1, 1, None), (1, 1, 2, None),
        (1, 2, 0, "b"), (1, 2, 1, "2020-01-02 03:04:05"), (1, 2, 2, "[1,2]"), (2, 0, 0, "s"), (2, 0, 1, "at"), (2, 0, 2, "list")]
    assert [(r["doc_id"], r["row_count"], r["col_count"]) for r in rows(cited_tables(b.nodes), ["doc_id"])] == [(1, 3, 3), (2, 1, 3)]
    assert [r["struct_type"] for r in rows(b.nodes.filter("doc_id = 1 AND depth = 3"), ["pre"])] == ["/TH"] * 3 + ["/TD"] * 6
    assert frame_tables(df.filter("k > 5"), "k", ["s"]).nodes.count() == 0


def test_tables_inside_cells_and_rows_outside_tables(spark):
    from quire.operators.tables import cited_tables, table_cells, table_grid
    from quire.operators.tagged import html_nodes
    html = ("<tr><td>stray</td></tr><table><tr><td>a</td><td>b<table><tr><th>in</th></tr></table></td></tr><tr></tr></table>"
            "<table></table><div><td>lone</td></div>")
    nodes = html_nodes(spark.createDataFrame([(1, "u", html)], "page_id bigint, url string, html string")).nodes
    got = rows(table_cells(nodes), ["table_pre", "row", "col"])
    assert [(r["row"], r["col"], r["text"]) for r in got] == [(0, 0, "a"), (0, 1, None), (0, 0, "in")]
    flat = {r["table_node_id"]: (r["row_count"], r["col_count"]) for r in rows(cited_tables(nodes))}
    assert sorted(flat.values()) == [(0, 0), (1, 1), (2, 2)]
    grid = rows(table_grid(nodes), ["table_ord"])
    assert sorted({r["table_ord"] for r in grid}) == [0, 1, 2] and sum(r["row"] is None for r in grid) == 3


def test_table_page_ranges(spark):
    from quire.operators.tables import cited_tables
    from quire.operators.tagged import tagged_nodes
    from tests.conftest import make_elements
    el = make_elements(spark, {1: [("/Document", [("/Table", [("/TR", [("/TD", [], "x", p)], None, p)], None, p) for p in range(4)])]})
    refs = spark.createDataFrame([(1, p, p) for p in range(4)], "doc_id bigint, page_ref bigint, page_index int")
    docs = spark.createDataFrame([(1, "ab" * 32, 3)], "doc_id bigint, source_hash string, page_count int")
    b = tagged_nodes(el, docs, refs)

    def pages(*a):
        return sorted(r["table_page"] for r in rows(cited_tables(b.nodes, *a)))
    assert pages() == [0, 1, 2, 3] and pages(1, 2) == [1, 2] and pages(None, 0) == [0] and pages(2) == [2, 3]
    assert pages(1, None, b.docs) == [1, 2]  # the document ends at page 2


def test_corpus_search_in_one_scan(spark):
    from quire.operators.cited import search_nodes
    from quire.operators.heuristic import heuristic_nodes_long
    pages = spark.createDataFrame([(d, p, "the x\n\ny the") for d in range(40) for p in range(2)], PAGES)
    nodes = heuristic_nodes_long(pages).nodes
    found = search_nodes(nodes, text_query="the", max_results=5, scope="corpus")
    assert found._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
    got = rows(found, ["doc_id", "pre"])
    assert [(r["doc_id"], r["pre"]) for r in got] == [(0, 2), (0, 3), (0, 5), (0, 6), (1, 2)]
    assert {r["total_matches"] for r in got} == {160} and all(r["truncated"] for r in got)
    assert search_nodes(nodes, text_query="no such", max_results=5, scope="corpus").count() == 0
    assert search_nodes(nodes, text_query="the", max_results=0, scope="corpus").count() == 0
    assert search_nodes(nodes, text_query="the", max_results=500, scope="corpus").filter("truncated").count() == 0


def test_load_files(spark, tmp_path):
    from quire.sources.corpus import load_files
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.txt").write_bytes(b"\x00\xffabc")
    (tmp_path / "y.pdf").write_bytes(b"%PDF")
    got = rows(load_files(spark, str(tmp_path), "*.txt"))
    assert [(r["length"], bytes(r["content"])) for r in got] == [(5, b"\x00\xffabc")]
    assert load_files(spark, str(tmp_path)).count() == 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        load_files(spark, str(tmp_path / "missing"))


def test_counts_without_nodes_equal_counts_of_nodes(spark):
    from quire.operators.cited import document_info
    from quire.operators.heuristic import heuristic_nodes_long, heuristic_nodes_wide, long_info, wide_stats
    from quire.sources.corpus import documents_wide
    pages = spark.createDataFrame([(1, 0, "ab cd ef\n\n\n\n x"), (1, 4, None), (2, 0, " "), (3, 7, "é" * 99)], PAGES).withColumn(
        "page_text", F.coalesce("page_text", F.lit("")))
    b = heuristic_nodes_long(pages)
    assert sorted(rows(long_info(pages)), key=str) == sorted(rows(document_info(b.nodes, b.docs)), key=str)
    wide = documents_wide(spark.createDataFrame([(1, "a b c d\n\nx\n\n"), (2, None), (3, "\n")], "doc_id bigint, text string"), 2)
    nodes = heuristic_nodes_wide(wide).nodes
    want = {r["doc_id"]: r["n"] for r in rows(nodes.filter("node_type = 'paragraph'").groupBy("doc_id").agg(F.count("*").alias("n")))}
    assert {r["doc_id"]: r["n_blocks"] for r in rows(wide_stats(wide)) if r["n_blocks"]} == want


def test_large_frames_get_a_task_per_so_many_nodes(spark, monkeypatch):
    from quire.operators import tables
    lines = spark.createDataFrame([(k % 7, k, f"t{k}", None) for k in range(60)] + [(None, 1, "x", 1.5)], "key bigint, n int, t string, x double")
    parents = spark.createDataFrame([(k,) for k in (3, 3, 9, None)], "key bigint")
    usual = rows(tables.frame_tables(lines, "key", ["n"], parents=parents).nodes.drop("bbox"), ["doc_id", "pre"])
    monkeypatch.setattr(tables, "NODES_A_TASK", 10)
    b = tables.frame_tables(lines, "key", ["n"], parents=parents)
    assert rows(b.nodes.drop("bbox"), ["doc_id", "pre"]) == usual
    assert b.nodes.rdd.getNumPartitions() == 26  # 61 rows of four nodes and four bare documents of two
    assert len(rows(tables.table_cells(b.nodes))) == 180
