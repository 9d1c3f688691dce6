"""Tables, search, diff, document transforms, audits, validation, lookups."""

from pyspark.sql import functions as F

from quire.operators import audit, cited, diff, docops, tables, tree, validate
from quire.operators.heuristic import heuristic_nodes_long
from quire.operators.tagged import tagged_nodes
from quire.sources import corpus
from tests.conftest import make_elements, rows


def docs_df(spark, ids, pages=1):
    return spark.createDataFrame([(i, f"{i:064x}", pages) for i in ids],
                                 "doc_id BIGINT, source_hash STRING, page_count INT")


def pages_df(spark, doc_pages):
    data = [(d, i, t) for d, ps in doc_pages.items() for i, t in enumerate(ps)]
    return spark.createDataFrame(data, "doc_id BIGINT, page_index INT, page_text STRING")


# -- E -----------------------------------------------------------------------------

def test_table_rows_and_cells(spark):
    tbl = ("/Table", [("/TR", [("/TD", [], "a"), ("/TH", [], "b")]), ("/TR", []), ("/P", [], "between"),
                      ("/TR", [("/TD", [], None)])])
    body = ("/Table", [("/TBody", [("/TR", [("/TD", [], "x")])])])
    el = make_elements(spark, {1: [("/Document", [tbl, body])]})
    nodes = tagged_nodes(el, docs_df(spark, [1])).nodes
    ct = rows(tables.cited_tables(nodes), ["table_node_id"])
    counts = sorted((r["row_count"], r["col_count"]) for r in ct)
    assert counts == [(0, 0), (3, 2)]
    cells = rows(tables.table_cells(nodes), ["row", "col"])
    assert [(r["row"], r["col"], r["text"]) for r in cells] == [(0, 0, "a"), (0, 1, "b"), (2, 0, None)]
    assert all(r["confidence"] == 1.0 and r["row_span"] == 1 for r in cells)


def test_untagged_documents_have_no_tables(spark):
    b = heuristic_nodes_long(pages_df(spark, {1: ["x", "y"]}))
    assert tables.cited_tables(b.nodes).count() == 0
    s = rows(tables.table_summary(b.nodes, b.docs))
    assert s == [{"doc_id": 1, "table_count": 0, "pages_processed": 2}]


def test_csv_lines(spark):
    tbl = ("/Table", [("/TR", [("/TD", [], "a,b"), ("/TD", [], 'c"d')]), ("/TR", [])])
    el = make_elements(spark, {1: [("/Document", [tbl, ("/Table", [])])]})
    from quire.sources.sinks import csv_documents
    g = tables.table_grid(tagged_nodes(el, docs_df(spark, [1])).nodes)
    text = rows(csv_documents(g))[0]["csv"]
    assert text == '# Table 1 (p0)\r\n"a,b","c""d"\r\n\r\n\n# Table 2 (p0)\r\n'


# -- C/D ---------------------------------------------------------------------------

def test_search_caps_and_empty_query(spark):
    b = heuristic_nodes_long(pages_df(spark, {1: ["Alpha\n\nbeta\n\nALPHA two\n\nalpha"]}))
    hits = rows(cited.search_nodes(b.nodes, text_query="alpha", max_results=2), ["pre"])
    assert len(hits) == 2 and hits[0]["total_matches"] == 3 and hits[0]["truncated"]
    every = cited.search_nodes(b.nodes, text_query="", max_results=100)
    assert every.count() == 4
    top = rows(cited.search_nodes(b.nodes, node_type="paragraph", max_results=1, scope="corpus"))
    assert len(top) == 1 and top[0]["total_matches"] == 4
    try:
        cited.search_nodes(b.nodes, max_results=-1)
        raise AssertionError("negative cap accepted")
    except ValueError:
        pass


def test_cited_text_anchor(spark):
    b = heuristic_nodes_long(pages_df(spark, {1: ["p0", "p1"]}))
    out = rows(cited.cited_text(b.nodes, page_index=1))
    assert len(out) == 1 and out[0]["confidence"] == 0.5
    assert out[0]["bbox"] == {"x": 0.0, "y": 0.0, "width": 1.0, "height": 1.0}


def test_token_budget_and_chunks(spark):
    b = heuristic_nodes_long(pages_df(spark, {1: ["x" * 40 + "\n\n" + "y" * 40 + "\n\n" + "z" * 40]}))
    blocks = cited.cited_text(b.nodes)
    assert [r["cum_tokens"] for r in rows(cited.token_budget(blocks, 25), ["pre"])] == [10, 20]
    assert [r["chunk_index"] for r in rows(cited.chunk_index(blocks, 15), ["pre"])] == [0, 0, 1]


def test_gate_limits(spark):
    df = spark.createDataFrame([(1, 10, 1), (2, 11, 1), (3, 5, 0), (4, 5, 3)],
                               "doc_id BIGINT, n_bytes BIGINT, page_count INT")
    g = {r["doc_id"]: r["reason"] for r in rows(corpus.gate(df, max_file_size=10, max_pages=2))}
    assert g == {1: None, 2: "size", 3: "no_pages", 4: "too_many_pages"}


# -- G -----------------------------------------------------------------------------

def _pair_nodes(spark, a_pages, b_pages):
    a = heuristic_nodes_long(pages_df(spark, {1: a_pages})).nodes.withColumn("pair", F.lit(0))
    b = heuristic_nodes_long(pages_df(spark, {2: b_pages})).nodes.withColumn("pair", F.lit(0))
    return a, b


def test_diff_first_occurrence_and_identity(spark):
    a, b = _pair_nodes(spark, ["same\n\nsame"], ["same"])
    assert diff.diff_nodes(a, b).count() == 0
    a, b = _pair_nodes(spark, ["one\n\ntwo"], ["one\n\nthree", "new page"])
    d = rows(diff.diff_nodes(a, b), ["type", "pre"])
    assert [(r["type"], r["text_preview"]) for r in d] == [
        ("added", "three"), ("added", None), ("added", "new page"), ("removed", "two")]
    back = rows(diff.diff_nodes(b, a))
    assert sorted(r["text_preview"] or "" for r in back if r["type"] == "removed") == ["", "new page", "three"]


def test_diff_summary_identical_pair(spark):
    a, b = _pair_nodes(spark, ["x"], ["x"])
    pairs = spark.createDataFrame([(0, 1, 1)], "pair INT, original_page_count INT, modified_page_count INT")
    s = rows(diff.diff_summary(diff.diff_nodes(a, b), pairs))
    assert s == [{"pair": 0, "added_node_count": 0, "removed_node_count": 0, "changed_node_count": 0,
                  "original_page_count": 1, "modified_page_count": 1, "pages_processed": 2}]


def test_compare_text_changed(spark):
    a, b = _pair_nodes(spark, ["one\n\ntwo"], ["one\n\nTWO\n\nextra"])
    pairs = spark.createDataFrame([(0, 1, 1)], "pair INT, original_page_count INT, modified_page_count INT")
    ca = cited.cited_text(a).withColumn("pair", F.lit(0))
    cb = cited.cited_text(b).withColumn("pair", F.lit(0))
    r = rows(diff.compare_text(ca, cb, pairs))[0]
    assert (r["added_text_count"], r["removed_text_count"], r["changed_text_count"]) == (1, 0, 1)


# -- H -----------------------------------------------------------------------------

def test_redact_idempotent_and_literal(spark):
    p = pages_df(spark, {1: ["mail a.b@x.org and 1.2.3.4, price $5 (x)"]})
    pats = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", docops.literal_pattern("$5 (x)")]
    once = rows(docops.redact(p, pats))[0]
    assert once["redaction_count"] == 2 and once["page_text"] == "mail [REDACTED] and 1.2.3.4, price [REDACTED]"
    twice = rows(docops.redact(p.withColumn("page_text", F.lit(once["page_text"])), pats))[0]
    assert twice["redaction_count"] == 0 and twice["page_text"] == once["page_text"]


def test_split_rules(spark):
    p = pages_df(spark, {1: ["p"] * 5})

    def chunks(points, cap):
        return [r["chunk_index"] for r in rows(docops.split_doc(p, points, cap), ["page_index"])]
    assert chunks([], None) == [0, 1, 2, 3, 4]
    assert chunks([2], None) == [0, 0, 1, 1, 1]
    assert chunks([], 2) == [0, 0, 1, 1, 2]
    assert chunks([2], 2) == [0, 0, 1, 1, 2]


def test_merge_of_split_restores_pages(spark):
    p = pages_df(spark, {1: ["a", "b", "c"], 2: ["d"]})
    groups = spark.createDataFrame([(9, 1, 0), (9, 2, 1)], "group_id INT, doc_id BIGINT, ord INT")
    m = rows(docops.merge_docs(p, groups), ["merged_page_index"])
    assert [(r["doc_id"], r["page_index"], r["merged_page_index"]) for r in m] == [
        (1, 0, 0), (1, 1, 1), (1, 2, 2), (2, 0, 3)]
    assert {r["group_page_count"] for r in m} == {4}


def test_merge_hot_group_blocks_match_brute_force(spark):
    import random
    rnd = random.Random(7)
    docs = {i: ["p"] * rnd.randint(1, 4) for i in range(40)}
    p = pages_df(spark, docs)
    order = list(range(40))
    rnd.shuffle(order)
    groups = spark.createDataFrame([(0 if i < 30 else 1, d, i if i < 30 else i - 30) for i, d in enumerate(order)],
                                   "group_id INT, doc_id BIGINT, ord INT")
    got = {(r["doc_id"], r["page_index"]): r["merged_page_index"] for r in rows(docops.merge_docs(p, groups, block=4))}
    want, off = {}, {0: 0, 1: 0}
    for i, d in enumerate(order):
        gid = 0 if i < 30 else 1
        for k in range(len(docs[d])):
            want[(d, k)] = off[gid] + k
        off[gid] += len(docs[d])
    assert got == want


def test_fingerprint_order_free(spark):
    a = heuristic_nodes_long(pages_df(spark, {1: ["x\n\ny"]})).nodes
    f = rows(docops.doc_fingerprint(a))[0]
    assert f["n_nodes"] == 4 and len(f["fingerprint"]) == 64


# -- I/J ---------------------------------------------------------------------------

def test_accessibility_rules(spark):
    el = make_elements(spark, {
        1: [("/Document", [("/H1", [], "t"), ("/H3", [], "skip"), ("/H2", [], None), ("/Figure", [], None),
                           ("/Table", []), ("/L", [])])],
        2: [("/Document", [("/P", [], "no headings")])]})
    nodes = tagged_nodes(el, docs_df(spark, [1, 2])).nodes
    got = sorted((r["doc_id"], r["rule_id"]) for r in rows(audit.check_accessibility(nodes)))
    assert got == [(1, "empty-heading"), (1, "figure-no-text"), (1, "heading-level-skip"), (1, "list-no-items"),
                   (1, "table-no-rows"), (2, "no-headings")]
    comp = {(r["doc_id"], r["standard"]): r["violation_count"] for r in rows(audit.compliance_check(
        audit.check_accessibility(nodes), docs_df(spark, [1, 2]), ["PDF/A-3b", "PDF/UA-1"]))}
    assert comp == {(1, "PDF/A-3b"): 2, (2, "PDF/A-3b"): 0, (1, "PDF/UA-1"): 5, (2, "PDF/UA-1"): 1}


def test_forensic(spark):
    p = spark.createDataFrame([(1, "u", "<script>x</script><iframe src=a>"), (2, "u", "<p>clean</p>")],
                              "page_id BIGINT, url STRING, html STRING")
    risk = {r["doc_id"]: r["risk_score"] for r in rows(audit.forensic_risk(p))}
    assert risk == {1: 0.9, 2: 0.0}
    assert {r["category"] for r in rows(audit.forensic_scan(p))} == {"javascript", "embedded_files"}


def test_validation_one_violation_each(spark):
    b = heuristic_nodes_long(pages_df(spark, {1: ["a\n\nb"]}))
    bad_box = F.struct(F.lit(-0.1).alias("x"), F.lit(0.0).alias("y"), F.lit(1.1).alias("width"),
                       F.lit(0.5).alias("height"))
    n = (b.nodes.withColumn("bbox", F.when(F.col("pre") == 2, bad_box).otherwise(F.col("bbox")))
         .withColumn("page_index", F.when(F.col("pre") == 3, F.lit(-1)).otherwise(F.col("page_index")))
         .withColumn("depth", F.when(F.col("pre") == 1, F.lit(-1)).otherwise(F.col("depth"))))
    v = {r["pre"]: r["violations"] for r in rows(validate.validate_nodes(n))}
    assert v == {0: [], 1: ["depth"], 2: ["bbox-range"], 3: ["page-index"]}
    blocks = cited.cited_text(b.nodes).withColumn("confidence", F.lit(1.5))
    assert {tuple(r["violations"]) for r in rows(validate.validate_blocks(blocks))} == {("confidence-range",)}


# -- F -----------------------------------------------------------------------------

def test_subtree_and_ancestors_match_brute_force(spark):
    b = heuristic_nodes_long(pages_df(spark, {1: ["a\n\nb\n\nc", "", "d\n\ne"], 2: ["x"]}))
    nodes = b.nodes
    keys = nodes.select("doc_id", "node_id")
    for bucket in (1, 2, 3, 1024):
        st = {(r["key_id"], r["node_id"]) for r in rows(tree.subtree(nodes, keys, bucket))}
        an = {(r["key_id"], r["node_id"]) for r in rows(tree.ancestors(nodes, keys, bucket))}
        allr = rows(nodes)
        want = {(a["node_id"], d["node_id"]) for a in allr for d in allr
                if a["doc_id"] == d["doc_id"] and a["pre"] <= d["pre"] <= a["last"]}
        assert st == want
        assert an == {(d, a) for a, d in want if a != d}


def test_get_node_missing(spark):
    b = heuristic_nodes_long(pages_df(spark, {1: ["a"]}))
    ids = [r["node_id"] for r in rows(b.nodes)]
    keys = spark.createDataFrame([(1, ids[0]), (1, "ast:nope:0:0")], "doc_id BIGINT, node_id STRING")
    found, missing = tree.get_node(b.nodes, keys)
    assert found.count() == 1
    assert rows(missing)[0]["error"] == "Node not found: ast:nope:0:0"


def test_json_round_trip(spark):
    b = heuristic_nodes_long(pages_df(spark, {1: ["a\n\nb", "c"]}))
    back = tree.nodes_from_json(tree.nodes_to_json(b.nodes, b.docs)).nodes
    cols = ["node_id", "parent_id", "depth", "child_pos", "node_type", "text_content"]
    assert back.select(*cols).exceptAll(b.nodes.select(*cols)).count() == 0
    assert back.count() == b.nodes.count()
