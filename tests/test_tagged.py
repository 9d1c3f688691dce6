"""Tagged paths: the generic structure-element walk and the HTML builder."""

from quire.operators.tagged import html_nodes, tagged_nodes
from tests.conftest import make_elements, rows


def docs_df(spark, ids, pages=1):
    return spark.createDataFrame([(i, f"{i:064x}", pages) for i in ids],
                                 "doc_id BIGINT, source_hash STRING, page_count INT")


def test_single_document_root_is_not_wrapped(spark):
    el = make_elements(spark, {1: [("/Document", [("/H1", [], "Title"), ("/P", [], "Body")])]})
    got = rows(tagged_nodes(el, docs_df(spark, [1])).nodes, ["pre"])
    assert [(r["node_type"], r["pre"], r["last"], r["depth"]) for r in got] == [
        ("document", 0, 2, 0), ("heading", 1, 1, 1), ("paragraph", 2, 2, 1)]
    assert [r["node_id"].split(":")[3] for r in got] == ["0", "1", "2"]
    assert got[1]["level"] == 1 and got[1]["struct_type"] == "/H1" and got[1]["text_content"] == "Title"
    assert got[0]["text_content"] is None and got[0]["children_count"] == 2


def test_several_top_level_elements_get_wrapper_with_last_seq(spark):
    el = make_elements(spark, {1: [("/P", [], "a"), ("/Sect", [("/P", [], "b")])]})
    got = rows(tagged_nodes(el, docs_df(spark, [1])).nodes, ["pre"])
    assert got[0]["node_type"] == "document" and got[0]["node_id"].endswith(":0:3")
    assert [r["node_id"].split(":")[3] for r in got] == ["3", "0", "1", "2"]
    assert [r["depth"] for r in got] == [0, 1, 1, 2]
    assert got[0]["last"] == 3 and got[2]["last"] == 3
    assert got[1]["parent_id"] == got[0]["node_id"]


def test_empty_tree_is_a_bare_document(spark):
    el = make_elements(spark, {1: [("/P", [], "x")]})
    got = rows(tagged_nodes(el, docs_df(spark, [1, 2])).nodes.filter("doc_id = 2"))
    assert len(got) == 1 and got[0]["node_type"] == "document" and got[0]["children_count"] == 0


def test_unknown_tag_missing_page_and_mcid(spark):
    el = make_elements(spark, {1: [("/Document", [("/Weird", [], "w", 99, "7"), ("/P", [], "p", 5, "x")])]})
    refs = spark.createDataFrame([(1, 5, 3)], "doc_id BIGINT, page_ref BIGINT, page_index INT")
    got = rows(tagged_nodes(el, docs_df(spark, [1], 4), page_refs=refs).nodes, ["pre"])
    assert got[1]["node_type"] == "artifact" and got[1]["page_index"] == 0 and got[1]["mcid"] == 7
    assert got[2]["page_index"] == 3 and got[2]["mcid"] is None
    assert got[2]["node_id"].split(":")[2] == "3"


def test_non_element_kids_are_skipped(spark):
    el = make_elements(spark, {1: [("/Document", [(None, [("/P", [], "lost")]), ("/P", [], "kept")])]})
    got = rows(tagged_nodes(el, docs_df(spark, [1])).nodes, ["pre"])
    assert [r["text_content"] for r in got] == [None, "kept"]
    assert got[1]["child_pos"] == 0


def test_page_level_text(spark):
    el = make_elements(spark, {1: [("/Document", [("/P", [], "own", 10), ("/P", [], "own2", 10)])]})
    refs = spark.createDataFrame([(1, 10, 0)], "doc_id BIGINT, page_ref BIGINT, page_index INT")
    pages = spark.createDataFrame([(1, 0, "  whole page  ")], "doc_id BIGINT, page_index INT, page_text STRING")
    got = rows(tagged_nodes(el, docs_df(spark, [1]), refs, pages, page_level_text=True).nodes, ["pre"])
    assert [r["text_content"] for r in got[1:]] == ["whole page", "whole page"]


def html_df(spark, docs):
    return spark.createDataFrame([(i, "u", h) for i, h in docs.items()], "page_id BIGINT, url STRING, html STRING")


def test_html_script_trap_and_entities(spark):
    h = ('<html><head><title>T</title><script>var t="</p>";</script></head><body><article><h2>A &amp; B</h2>'
         '<p>x &lt;y&gt; <b>bold</b></p><!-- <p>gone</p> --></article></body></html>')
    got = rows(html_nodes(html_df(spark, {1: h})).nodes, ["pre"])
    assert [r["node_type"] for r in got] == ["document", "section", "heading", "paragraph"]
    assert got[2]["text_content"] == "A & B" and got[2]["level"] == 2
    assert got[3]["text_content"] == "x <y> bold"
    assert got[1]["children_count"] == 2 and got[1]["last"] == 3


def test_html_container_rule(spark):
    h = ("<div><table><tr><td>1</td><th>2</th></tr><tr></tr><p>between</p><tr><td>3</td></tr></table></div>"
         "<ul><li>i</li></ul><p>after</p><aside>z</aside>")
    got = rows(html_nodes(html_df(spark, {1: h})).nodes, ["pre"])
    kinds = [(r["node_type"], r["depth"]) for r in got]
    assert kinds == [("document", 0), ("section", 1), ("table", 2), ("table_row", 3), ("table_cell", 4),
                     ("table_cell", 4), ("table_row", 3), ("paragraph", 3), ("table_row", 3), ("table_cell", 4),
                     ("list", 1), ("list_item", 2), ("paragraph", 1), ("artifact", 1)]
    assert [r["text_content"] for r in got[10:]] == [None, "i", "after", "z"]
    by_pre = {r["pre"]: r for r in got}
    assert by_pre[7]["parent_id"] == by_pre[2]["node_id"]          # p between rows -> the table
    assert by_pre[2]["last"] == 9 and by_pre[1]["last"] == 9
    assert by_pre[0]["children_count"] == 4 and by_pre[1]["children_count"] == 1


def outline_of(spark, html):
    """Indented `tag:text` lines of one page."""
    return ["  " * (r["depth"] - 1) + f"{r['struct_type']}:{r['text_content'] or ''}"
            for r in rows(html_nodes(html_df(spark, {1: html})).nodes, ["pre"])[1:]]


def test_html_containers_close_with_their_tags(spark):
    assert outline_of(spark, "<nav><ul><li>a<li>b</ul></nav><h1>T</h1>") == ["nav:", "  ul:", "    li:a", "    li:b", "h1:T"]
    # an inner table does not take the outer row's next cell
    assert outline_of(spark, "<table><tr><td>1<table><tr><td>in</table><td>2</table>tail") == [
        "table:", "  tr:", "    td:", "      #text:1", "      table:", "        tr:", "          td:in", "    td:2", "#text:tail"]
    # rows and cells without end tags, and a closing tag meant for nothing open
    assert outline_of(spark, "<table><tr><td>1<td>2<tr><td>3</div></table></li><p>x") == [
        "table:", "  tr:", "    td:1", "    td:2", "  tr:", "    td:3", "p:x"]
    # a closing tag inside a cell closes nothing outside of it; an outer one closes all within
    assert outline_of(spark, "<div><table><tr><td><div>a</div></div>b</td></tr></table></div>c") == [
        "div:", "  table:", "    tr:", "      td:", "        div:a", "        #text:b", "#text:c"]
    assert outline_of(spark, "<div><ul><li>a</div>b") == ["div:", "  ul:", "    li:a", "#text:b"]
    # nested lists: an item of the inner list does not end the outer one
    assert outline_of(spark, "<ul><li>a<ol><li>b</li><li>c</ol>d</li><li>e</ul>") == [
        "ul:", "  li:", "    #text:a", "    ol:", "      li:b", "      li:c", "    #text:d", "  li:e"]


def test_html_trees_match_the_sql_twin_on_random_tag_soup(spark, tmp_path):
    import random

    import duckdb

    from quire.plans.base import node_rows
    from quire.plans.oracle import ORACLE
    rng = random.Random(8)
    names = ["div", "ul", "ol", "li", "table", "tr", "td", "th", "p", "h2", "section", "code", "b", "title", "body", "BR", "Div"]

    def piece():
        t = rng.choice(names)
        return rng.choice([f"<{t}>", f"<{t}>", f"</{t}>", f"</{t}>", f"<{t} a='1'>", " ", "word", "x &amp;lt; y", "<!-- <p> -->", "<!x>", "</>", "a < b ", "</1>"])

    pages = [(k, "u", "".join(piece() for _ in range(rng.randrange(60)))) for k in range(300)] + [(1000, "u", None), (1001, "u", "")]
    df = spark.createDataFrame(pages, "page_id BIGINT, url STRING, html STRING")
    path = str(tmp_path / "pages.parquet")
    df.write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{path}/*.parquet')")
    want = con.execute(ORACLE["html_nodes"]).fetchdf()
    got = node_rows(html_nodes(spark.read.parquet(path)).nodes).toPandas()
    key = ["doc_id", "pre"]
    for frame in (want, got):
        frame.sort_values(key, inplace=True, ignore_index=True)
    for c in want.columns:
        assert want[c].astype(object).where(want[c].notna(), None).tolist() == got[c].astype(object).where(got[c].notna(), None).tolist(), c


def test_html_deep_page(spark):
    """10,000 levels, linear in the page."""
    got = rows(html_nodes(html_df(spark, {1: "<div>" * 10_000 + "x"})).nodes, ["pre"])
    assert len(got) == 10_001 and got[-1]["depth"] == 10_000 and got[-1]["text_content"] == "x" and got[0]["last"] == 10_000


def test_html_empty_page(spark):
    got = rows(html_nodes(html_df(spark, {5: "<html><body></body></html>"})).nodes)
    assert len(got) == 1 and got[0]["node_type"] == "document" and got[0]["node_id"].endswith(":0:0")


def _random_forest(spark):
    """Trees, several roots, equal places, orphans, cycles, a repeated id, a repeated document and one without elements."""
    import random
    rnd = random.Random(5)
    out = []
    for doc in range(1, 41):
        for e in range(rnd.randint(1, 12)):
            up = None if e == 0 or rnd.random() < 0.15 else rnd.randrange(0, e + 1 if rnd.random() < 0.1 else e)
            out.append((doc, e * 3, None if up is None else up * 3 + (1 if rnd.random() < 0.05 else 0), rnd.randint(0, 2),
                        rnd.choice(["/Document", "/Sect", "/P", "/H2", None]), rnd.choice([None, 0, 1, 7]), rnd.choice([None, "4", "x"]), f" t{e} "))
    out += [(7, 0, None, 0, "/P", 0, None, "again"), (90, 0, None, 0, "/P", 0, None, "of no document"), (None, 0, None, 0, "/P", 0, None, "no id")]
    from quire.schemas import ELEMENTS
    from pyspark.sql import types as T
    el = spark.createDataFrame(out, T.StructType([T.StructField(f.name, f.dataType) for f in ELEMENTS])).repartition(3)
    docs = docs_df(spark, [*range(1, 42), 9])
    refs = spark.createDataFrame([(d, r, 1 - r) for d in range(1, 41) for r in (0, 1)] + [(5, 1, 3)], "doc_id BIGINT, page_ref BIGINT, page_index INT")
    pages = spark.createDataFrame([(d, p, f" page {p} of {d} ") for d in range(1, 41) for p in (0, 1)] + [(11, 0, "other")],
                                  "doc_id BIGINT, page_index INT, page_text STRING")
    return el, docs, refs, pages


def test_numbered_in_tasks_as_by_tours(spark):
    el, docs, refs, pages = _random_forest(spark)
    tied = (5, 7)  # a repeated reference and element: siblings in no order
    got = [rows(tagged_nodes(el, docs, refs, pages, True, most=k).nodes.drop("bbox")) for k in (1000, 5, 0)]
    alike = [sorted(str({**r, "child_pos": None if r["doc_id"] in tied else r["child_pos"]}) for r in g) for g in got]
    assert alike[0] == alike[2] and alike[1] == alike[2] and len(alike[0]) > 100


def test_small_trees_take_no_tour(spark, monkeypatch):
    from quire.operators import tagged
    monkeypatch.setattr(tagged, "_walk", lambda el: 1 / 0)
    el = make_elements(spark, {1: [("/Document", [("/H1", [], "Title"), ("/P", [], "Body")])]})
    pages = spark.createDataFrame([(1, 0, "all")], "doc_id BIGINT, page_index INT, page_text STRING")
    b = tagged_nodes(el, docs_df(spark, [1]), None, pages, page_level_text=True)
    assert [r["text_content"] for r in rows(b.nodes, ["pre"])] == [None, "all", "all"]
    assert "Broadcast" not in b.nodes._jdf.queryExecution().executedPlan().toString()
