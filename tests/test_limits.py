"""No silent caps: gapped pages, deep trees, many headings, unknown standards, bad JSON."""

import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import make_elements, rows


def test_gapped_pages_are_all_numbered(spark):
    from quire.operators.heuristic import heuristic_nodes_long
    pages = spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (1, 5, "c"), (2, 3, "d"), (2, 9, "e")],
                                  "doc_id bigint, page_index int, page_text string")
    b = heuristic_nodes_long(pages)
    assert [(r["doc_id"], r["page_index"]) for r in rows(b.nodes.filter("node_type = 'section'"), ["doc_id", "pre"])] == [
        (1, 0), (1, 1), (1, 5), (2, 3), (2, 9)]
    assert sorted(r["doc_id"] for r in rows(b.docs)) == [1, 2]
    second = heuristic_nodes_long(pages, start=1, end=1)
    assert sorted(r["page_index"] for r in rows(second.nodes.filter("node_type = 'section'"))) == [1, 9]


def test_deep_element_tree(spark):
    from quire.operators.tagged import tagged_nodes
    tree = ("/P", [], "leaf")
    for _ in range(129):
        tree = ("/Sect", [tree])
    el = make_elements(spark, {1: [("/Document", [tree])]})
    docs = spark.createDataFrame([(1, "ab" * 32, 1)], "doc_id bigint, source_hash string, page_count int")
    got = rows(tagged_nodes(el, docs).nodes, ["pre"])
    assert [r["depth"] for r in got] == list(range(131)) and {r["last"] for r in got} == {130}


def test_cycles_and_orphans_drop_out(spark):
    from quire.operators.tagged import tagged_nodes
    from quire.schemas import ELEMENTS
    el = spark.createDataFrame([(1, 0, None, 0, "/Document", None, None, None), (1, 1, 0, 0, "/P", None, None, "x"),
                                (1, 2, 3, 0, "/P", None, None, "y"), (1, 3, 2, 0, "/P", None, None, "z"),
                                (1, 4, 99, 0, "/P", None, None, "w")], ELEMENTS)
    docs = spark.createDataFrame([(1, "ab" * 32, 1)], "doc_id bigint, source_hash string, page_count int")
    assert [r["text_content"] for r in rows(tagged_nodes(el, docs).nodes, ["pre"])] == [None, "x"]


def test_outline_and_search_have_no_default_cap(spark):
    from quire.operators.cited import outline, search_nodes
    from quire.operators.tagged import html_nodes
    html = "".join(f"<h2>t{i}</h2>" for i in range(501))
    nodes = html_nodes(spark.createDataFrame([(1, "u", html)], "page_id bigint, url string, html string")).nodes
    assert outline(nodes).count() == 501
    assert search_nodes(nodes, text_query="t").filter("truncated").count() == 0
    assert search_nodes(nodes, max_results=3).count() == 3


def test_unknown_standard_raises(spark):
    from quire.operators.audit import compliance_check
    f = spark.createDataFrame([], "doc_id bigint, rule_id string")
    d = spark.createDataFrame([(1, 1)], "doc_id bigint, page_count int")
    with pytest.raises(ValueError):
        compliance_check(f, d, ["NO-SUCH-STANDARD"])


def test_page_between_without_bounds(spark):
    from quire.operators.cited import page_between
    df = spark.range(4).select(F.col("id").cast("int").alias("page_index"))
    assert df.filter(page_between(1, None)).count() == 3 and df.filter(page_between(None, 1)).count() == 2


def test_lookup_nodes_is_one_scan(spark):
    """One left join: the nodes are built once and both answers come from it."""
    import __spark_entry__ as E
    plan = E.queries()["get_node"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [page_id") <= 2


def test_json_round_trip_of_deep_tree(spark):
    from quire.operators.tree import nodes_from_json
    tree = {"id": "n40", "type": "paragraph", "page_index": 0, "text_content": "x", "children": []}
    for k in range(39, -1, -1):
        tree = {"id": f"n{k}", "type": "section", "page_index": 0, "children": [tree]}
    doc = json.dumps({"schemaVersion": "1.0", "sourceHash": "h", "pageCount": 1, "root": tree})
    df = spark.createDataFrame([(1, doc), (2, "{broken"), (3, '{"root": {"type": "document"}}')], "doc_id bigint, json string")
    found = nodes_from_json(df)
    assert sorted(r["depth"] for r in rows(found.nodes)) == list(range(41))
    assert [(r["doc_id"], r["page_count"]) for r in rows(found.docs)] == [(1, 1)]
    assert sorted(r["doc_id"] for r in rows(found.rejected)) == [2, 3]


def test_html_text_outside_leaves_is_kept(spark):
    from quire.operators.tagged import html_nodes
    html = "lead<html><head><title>T</title></head><body>intro<p>a <code>x</code> tail1</p><div>own <p>in</p> tail2</div>end<ul> <li>i</li></ul></body>"
    nodes = html_nodes(spark.createDataFrame([(1, "u", html)], "page_id bigint, url string, html string")).nodes
    got = [(r["struct_type"], r["text_content"]) for r in rows(nodes.filter("pre > 0"), ["pre"])]
    assert got == [("#text", "lead"), ("#text", "intro"), ("p", "a"), ("code", "x"), ("#text", "tail1"), ("div", None), ("#text", "own"),
                   ("p", "in"), ("#text", "tail2"), ("#text", "end"), ("ul", None), ("li", "i")]


def test_html_lone_angle_brackets_are_text(spark):
    from quire.operators.tagged import html_nodes
    html = ("<!DOCTYPE html>before<title>name</title><p>if a < b then c <3</p><p>x <<b>y</b> z</p><pre>i<=n; a</ b>c<!x>d</pre>"
            "<my_tag>own</my_tag><p>end <unclosed < x")
    nodes = html_nodes(spark.createDataFrame([(1, "u", html)], "page_id bigint, url string, html string")).nodes
    got = [r.text_content for r in nodes.orderBy("pre").collect() if r.text_content]
    assert got == ["before", "if a < b then c <3", "x <y z", "i<=n; acd", "own", "end <unclosed < x"]


def test_import_holds_one_tree_at_a_time(spark):
    """Nodes leave in batches of bounded size, however many documents or nodes a task has."""
    from quire.operators import tree
    leaf = '{"id":"n%d","type":"paragraph","page_index":0,"text_content":"t","attributes":{},"children":[]}'
    big = ",".join(leaf % k for k in range(25_000))
    text = '{"schemaVersion":"1","sourceHash":"h","pageCount":1,"root":{"id":"r","type":"document","page_index":0,"children":[%s]}}'
    df = spark.createDataFrame([(1, text % big), (2, text % ""), (3, "{"), (4, None), (None, text % (leaf % 0))], "doc_id bigint, json string").coalesce(1)
    found = tree.nodes_from_json(df)
    sizes = found.nodes.mapInPandas(lambda frames: (x[["doc_id"]].assign(doc_id=len(x)) for x in frames), "doc_id bigint")
    assert max(r["doc_id"] for r in rows(sizes)) <= 10_000
    assert {r["doc_id"]: r["count"] for r in rows(found.nodes.groupBy("doc_id").count())} == {1: 25_001, 2: 1, None: 2}
    assert [r["last"] for r in rows(found.nodes.filter("doc_id = 1 AND pre = 0"))] == [25_000]
    assert found.docs.count() == 3 and {r["doc_id"] for r in rows(found.rejected)} == {3, 4}
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 1000
    assert "MapInArrow" in found.nodes._jdf.queryExecution().executedPlan().toString()
