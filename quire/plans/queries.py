"""Registered queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Each reads the whole driver tables of ``sf_dir``.  Their SQL twins live in
``quire.plans.oracle`` under the same names and column aliases.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.text import (content_hash, full_hash_of_text, source_hash_of_text,
                                  split_paragraphs)
from quire.operators import cited as C
from quire.operators.heuristic import first_pages_range, heuristic_nodes_wide
from quire.plans import base as B
from quire.sources import corpus as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def reg(fn):
        QUERIES[name] = fn
        return fn
    return reg


# -- A/B: sources, gates, hashing -------------------------------------------------

@query("source_hash")
def q_source_hash(spark, d):
    """B1: 4 KB source hash, full hash and byte length per document."""
    docs = B.table(spark, d, "documents")
    return docs.select("doc_id", source_hash_of_text("text").alias("source_hash"),
                       full_hash_of_text("text").alias("full_hash"),
                       F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_bytes"))


@query("dedupe_by_hash")
def q_dedupe_by_hash(spark, d):
    """H5: one kept document per (source_hash, full_hash); partial aggregation
    absorbs a hash shared by a large share of the corpus."""
    from quire.operators.docops import dedupe_by_hash
    return dedupe_by_hash(q_source_hash(spark, d))


@query("gate_corpus")
def q_gate_corpus(spark, d):
    """A3-A5: documents with a 4096-byte limit, conversations with a 5-page limit."""
    docs = B.table(spark, d, "documents").select(
        "doc_id", F.lit("documents").alias("corpus"),
        F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_bytes"),
        F.lit(1).alias("page_count"))
    g1 = S.gate(docs, max_file_size=4096)
    convs = S.source_bytes_length(B.conv_pages(spark, d)).select(
        "doc_id", F.lit("conversations").alias("corpus"), "n_bytes", "page_count")
    g2 = S.gate(convs, max_pages=5)
    return g1.unionByName(g2)


@query("paragraphs")
def q_paragraphs(spark, d):
    """Paragraphs of every document (delimiter newline)."""
    docs = B.table(spark, d, "documents")
    return docs.select("doc_id", F.posexplode_outer(split_paragraphs("text", B.PARA_DELIM))
                       .alias("para_index", "text")).filter(F.col("para_index").isNotNull()) \
        .select("doc_id", F.lit(0).alias("page_index"), "para_index", "text",
                content_hash("text").alias("content_hash"))


@query("heuristic_nodes_conv")
def q_heuristic_nodes_conv(spark, d):
    """B6 over conversations (turn = page): the long layout, one exchange."""
    return B.node_rows(B.conv_built(spark, d).nodes)


@query("heuristic_nodes_docs")
def q_heuristic_nodes_docs(spark, d):
    """B6 over documents paginated at 8 lines per page: the wide layout, numbered inside the row."""
    return B.node_rows(B.docs_built(spark, d, B.DOC_LINES_PER_PAGE).nodes)


@query("ast_page_range")
def q_ast_page_range(spark, d):
    """D6 with B5: pages 1..2 (clamped per document) numbered before anything else."""
    return B.node_rows(B.conv_built(spark, d, 1, 2).nodes)


@query("ast_first_pages")
def q_ast_first_pages(spark, d):
    """The first 2 pages only."""
    s, e = first_pages_range(2)
    return B.node_rows(B.conv_built(spark, d, s, e).nodes)


# -- D: cited text, search, info --------------------------------------------------

def _cited_flat(nodes, **kw):
    return C.flatten_bbox(C.cited_text(nodes, **kw))


@query("cited_text")
def q_cited_text(spark, d):
    """D1 over conversations."""
    return _cited_flat(B.conv_built(spark, d).nodes)


@query("cited_text_page")
def q_cited_text_page(spark, d):
    """D1 with the page filter (page 1), applied after numbering."""
    return _cited_flat(B.conv_built(spark, d).nodes, page_index=1)


@query("search_nodes")
def q_search_nodes(spark, d):
    """Paragraphs of each conversation, first 3 with total and truncation."""
    return C.search_nodes(B.conv_built(spark, d).nodes, node_type="paragraph", max_results=3)


@query("search_text")
def q_search_text(spark, d):
    """C5 + D2: nodes containing 'the' (any case), first 5 per document."""
    return C.search_nodes(B.docs_built(spark, d).nodes, text_query="the", max_results=5)


@query("document_info")
def q_document_info(spark, d):
    """D3 over conversations."""
    from quire.operators.heuristic import long_info
    return long_info(B.conv_pages(spark, d), B.PARA_DELIM)


@query("document_info_html")
def q_document_info_html(spark, d):
    """D3 over trees that no closed form describes: the HTML pages, from their nodes."""
    b = B.html_built(spark, d)
    return C.document_info(b.nodes, b.docs)


@query("plain_text")
def q_plain_text(spark, d):
    """Conversation text, turns joined by newline."""
    return C.plain_text(B.conv_pages(spark, d))


@query("token_budget")
def q_token_budget(spark, d):
    """The blocks of each document that fit a 200-token budget."""
    blocks = C.cited_text(B.docs_built(spark, d).nodes)
    return C.token_budget(blocks, 200).select("doc_id", "pre", "node_id", "tokens", "cum_tokens")


@query("chunk_index")
def q_chunk_index(spark, d):
    """Chunk number of every conversation block for a 100-token budget."""
    blocks = C.cited_text(B.conv_built(spark, d).nodes)
    return C.chunk_index(blocks, 100).select("doc_id", "pre", "node_id", "tokens", "cum_tokens", "chunk_index")


# -- A8/A9: text sinks ------------------------------------------------------------

@query("markdown")
def q_markdown(spark, d):
    """One Markdown entry per cited block (the sink joins them by newline)."""
    from quire.sources.sinks import markdown_entries
    return markdown_entries(C.cited_text(B.conv_built(spark, d).nodes))


@query("plain_sink")
def q_plain_sink(spark, d):
    """Block texts of each conversation joined by newline in preorder."""
    from quire.sources.sinks import plain_documents
    return plain_documents(C.cited_text(B.conv_built(spark, d).nodes))


# -- K: batch outcome, metering ---------------------------------------------------

@query("batch_outcome")
def q_batch_outcome(spark, d):
    """K1: per-document status under the default limits and the block count of
    accepted documents."""
    from quire.operators.batch import batch_outcome
    return batch_outcome(B.docs_wide(spark, d), B.PARA_DELIM)


@query("metering")
def q_metering(spark, d):
    """K2: documents, pages and blocks processed over the documents corpus."""
    from quire.operators.batch import metering
    from quire.operators.heuristic import wide_stats
    return metering(wide_stats(B.docs_wide(spark, d, B.DOC_LINES_PER_PAGE), B.PARA_DELIM))


# -- B7-B13: tagged HTML corpus ---------------------------------------------------

@query("html_nodes")
def q_html_nodes(spark, d):
    """B7-B13 over HTML pages: tagged nodes with the wrapper document root."""
    return B.node_rows(B.html_built(spark, d).nodes)


@query("tag_histogram")
def q_tag_histogram(spark, d):
    """Kept block-tag counts over all pages."""
    from quire.sources.html import tag_histogram
    return tag_histogram(B.table(spark, d, "pages"))


@query("cited_headings")
def q_cited_headings(spark, d):
    """D1 with headings_only over the tagged corpus (confidence 1.0)."""
    return _cited_flat(B.html_built(spark, d).nodes, headings_only=True)


@query("outline")
def q_outline(spark, d):
    """D4 over the tagged corpus."""
    return C.outline(B.html_built(spark, d).nodes)


# -- F: lookups -------------------------------------------------------------------

@query("get_node")
def q_get_node(spark, d):
    """look up every list node of every page (found) and, per page, the id
    one past its last sequence number (not found)."""
    from quire.operators.tree import lookup_nodes
    nodes = B.html_built(spark, d).nodes
    # both kinds of key in one pass: a list's own id, and for each root the id past its end
    past_end = F.concat(F.substring_index("node_id", ":", 3), F.lit(":"), (F.col("last") + 1).cast("string"))
    keys = nodes.select("doc_id", F.when(F.col("node_type") == "list", F.col("node_id"))
                        .when(F.col("pre") == 0, past_end).alias("node_id")).filter("node_id IS NOT NULL")
    return lookup_nodes(nodes, keys).select("doc_id", "node_id", "found", "node_type", "pre", "children_count", "text_content", "error")


@query("subtree")
def q_subtree(spark, d):
    """every conversation section with its paragraphs (bucketed range join)."""
    from quire.operators.tree import subtree
    nodes = B.conv_built(spark, d).nodes
    return subtree(nodes, F.col("node_type") == "section").select("doc_id", "key_id", "node_id", "pre", "node_type", "depth", "rel_depth",
                                       "text_content")


@query("ancestors")
def q_ancestors(spark, d):
    """root paths of every HTML list item."""
    from quire.operators.tree import ancestors
    nodes = B.html_built(spark, d).nodes
    return ancestors(nodes, F.col("node_type") == "list_item")


@query("ast_json_roundtrip")
def q_ast_json_roundtrip(spark, d):
    """A11 + A12: conversation trees to nested JSON and back to flat rows."""
    from quire.operators.tree import nodes_from_json, nodes_to_json
    b = B.conv_built(spark, d)
    js = nodes_to_json(b.nodes, b.docs)
    return B.node_rows(nodes_from_json(js).nodes)


@query("ast_json_roundtrip_html")
def q_ast_json_roundtrip_html(spark, d):
    """A11 + A12 over the HTML trees, all columns of ``nodes`` numbered anew."""
    from quire.operators.tree import nodes_from_json, nodes_to_json
    b = B.html_built(spark, d)
    return nodes_from_json(nodes_to_json(b.nodes, b.docs)).nodes.select(*B.NODE_OUT, "parent_pre")


# -- E: tables --------------------------------------------------------------------

@query("table_nodes")
def q_table_nodes(spark, d):
    """E5: orders as documents with one table; lines as rows; columns as cells."""
    return B.node_rows(B.tables_built(spark, d).nodes)


@query("table_cells")
def q_table_cells(spark, d):
    """Direct rows and cells of every table, numbered from 0."""
    from quire.operators.tables import table_cells
    return table_cells(B.tables_built(spark, d).nodes)


@query("cited_tables")
def q_cited_tables(spark, d):
    """E2 (flat): row and column counts per table; empty orders give 0 x 0."""
    from quire.operators.tables import cited_tables
    return cited_tables(B.tables_built(spark, d).nodes)


@query("table_summary")
def q_table_summary(spark, d):
    """Tables and pages per document for the tagged order tables and the
    heuristic conversations (which never have tables)."""
    from quire.operators.tables import table_summary
    conv, tabs = B.conv_built(spark, d), B.tables_built(spark, d)
    return table_summary(None, conv.docs).withColumn("corpus", F.lit("conversations")).unionByName(
        table_summary(None, tabs.docs, per_document=1).withColumn("corpus", F.lit("orders")))


@query("table_summary_html")
def q_table_summary_html(spark, d):
    """E4 counted from nodes: the tables of the HTML pages, wherever they stand."""
    from quire.operators.tables import table_summary
    b = B.html_built(spark, d)
    return table_summary(b.nodes, b.docs)


@query("table_nodes_headers")
def q_table_nodes_headers(spark, d):
    """E5 from the frames' own schemas, with header rows: the nations of every region and the
    suppliers of every nation (doubles as they are cast; regions and nations without rows keep their header)."""
    from quire.operators.tables import frame_tables
    nations, suppliers = B.table(spark, d, "nation"), B.table(spark, d, "supplier").drop("s_acctbal")
    a = frame_tables(nations, "n_regionkey", ["n_nationkey"], header=True, parents=B.table(spark, d, "region"), source="region:")
    b = frame_tables(suppliers, "s_nationkey", ["s_suppkey"], header=True, parents=nations, source="nation:")
    return B.node_rows(a.nodes).withColumn("corpus", F.lit("region")).unionByName(
        B.node_rows(b.nodes).withColumn("corpus", F.lit("nation")))


@query("cited_tables_page_range")
def q_cited_tables_page_range(spark, d):
    """C6 over tables on several pages: from page 1 to each document's last page (two lines of an order a page)."""
    from quire.operators.tables import cited_tables
    from quire.operators.tagged import tagged_nodes
    elements, docs, refs = B.paged_table_elements(spark, d)
    b = tagged_nodes(elements, docs, refs)
    return cited_tables(b.nodes, 1, None, b.docs)


@query("load_files")
def q_load_files(spark, d):
    """A1 for raw files: the documents' texts, 64 ids a file, read back as bytes and hashed."""
    from quire.session import checkpoint_dir
    path = f"{checkpoint_dir(spark)}/files-{uuid.uuid4().hex}"
    texts = B.table(spark, d, "documents").select(F.floor(F.col("doc_id") / 64).alias("bucket"), "doc_id", F.coalesce("text", F.lit("")).alias("value"))
    dealt = texts.repartition("bucket").sortWithinPartitions("bucket", "doc_id").select("bucket", "value")
    dealt.write.partitionBy("bucket").text(path)
    files = S.load_files(spark, path, "*.txt")
    return files.select(F.regexp_extract("path", r"bucket=(\d+)", 1).cast("bigint").alias("bucket"), F.col("length").alias("n_bytes"),
                        F.sha2("content", 256).alias("sha256"))


@query("tables_csv")
def q_tables_csv(spark, d):
    """CSV lines of every order's table."""
    from quire.operators.tables import table_grid
    from quire.sources.sinks import csv_table_lines
    return csv_table_lines(table_grid(B.tables_built(spark, d).nodes))


# -- G: diff ----------------------------------------------------------------------

@query("diff_pairs")
def q_diff_pairs(spark, d):
    """G1-G3 over conversation pairs (2k, 2k+1)."""
    from quire.operators.diff import diff_sides
    nodes, _ = B.conv_sides(spark, d)
    return diff_sides(nodes)


@query("diff_summary")
def q_diff_summary(spark, d):
    """Counts per conversation pair, zeros for identical pairs."""
    from quire.operators.diff import diff_sides, diff_summary
    nodes, pairs = B.conv_sides(spark, d)
    return diff_summary(diff_sides(nodes), pairs)


def _docs_and_redacted(spark, d):
    orig = B.docs_built(spark, d)
    red = heuristic_nodes_wide(B.redacted_wide(spark, d), B.PARA_DELIM)
    pairs = orig.docs.select(F.col("doc_id").alias("pair"), F.col("page_count").alias("original_page_count"),
                             F.col("page_count").alias("modified_page_count"))
    return (orig.nodes.withColumn("pair", F.col("doc_id")), red.nodes.withColumn("pair", F.col("doc_id")), pairs)


@query("diff_redacted")
def q_diff_redacted(spark, d):
    """Each document against its redacted version."""
    from quire.operators.diff import diff_nodes
    a, m, _ = _docs_and_redacted(spark, d)
    return diff_nodes(a, m)


@query("compare_text")
def q_compare_text(spark, d):
    """Blocks aligned by position; redacted paragraphs count as changed."""
    from quire.operators.diff import compare_text
    a, m, pairs = _docs_and_redacted(spark, d)
    return compare_text(C.cited_text(a).withColumn("pair", F.col("doc_id")),
                        C.cited_text(m).withColumn("pair", F.col("doc_id")), pairs)


# -- H: document transforms -------------------------------------------------------

@query("redact")
def q_redact(spark, d):
    """H1: every document page with e-mail, number, address and literal patterns redacted."""
    from quire.operators.docops import redact
    return redact(S.wide_to_long(B.docs_wide(spark, d)), B.REDACT_PATTERNS)


@query("redact_summary")
def q_redact_summary(spark, d):
    """H1 response over documents paginated at 8 lines."""
    from quire.operators.docops import redact, redact_summary
    pages = S.wide_to_long(B.docs_wide(spark, d, B.DOC_LINES_PER_PAGE))
    return redact_summary(redact(pages, B.REDACT_PATTERNS))


@query("merge_docs")
def q_merge_docs(spark, d):
    """H2: conversations merged in groups of four consecutive ids."""
    from quire.operators.docops import merge_docs
    pages = B.conv_pages(spark, d)
    groups = pages.groupBy("doc_id").agg(F.count(F.lit(1)).alias("page_count")).select(
        "doc_id", "page_count", F.floor(F.col("doc_id") / 4).alias("group_id"), F.pmod(F.col("doc_id"), F.lit(4)).alias("ord"))
    return merge_docs(pages, groups)


@query("split_doc")
def q_split_doc(spark, d):
    """H3: conversations split before page 2, chunks capped at 2 pages."""
    from quire.operators.docops import split_doc
    return split_doc(B.conv_pages(spark, d), [2], 2)


@query("doc_fingerprint")
def q_doc_fingerprint(spark, d):
    """H4: content fingerprint of every HTML page's tree."""
    from quire.operators.docops import doc_fingerprint
    return doc_fingerprint(B.html_built(spark, d).nodes)


# -- I: audits ---------------------------------------------------------------------

@query("check_accessibility")
def q_check_accessibility(spark, d):
    """I1 over the HTML corpus."""
    from quire.operators.audit import check_accessibility
    return check_accessibility(B.html_built(spark, d).nodes)


@query("check_accessibility_tables")
def q_check_accessibility_tables(spark, d):
    """I1 over the order tables (no headings anywhere; empty tables)."""
    from quire.operators.audit import check_accessibility
    return check_accessibility(B.tables_built(spark, d).nodes)


@query("compliance_check")
def q_compliance_check(spark, d):
    """PDF/UA-1 and PDF/A-3b over the order tables."""
    from quire.operators.audit import check_accessibility, compliance_check
    b = B.tables_built(spark, d)
    return compliance_check(check_accessibility(b.nodes), b.docs, ["PDF/UA-1", "PDF/A-3b"])


@query("forensic_scan")
def q_forensic_scan(spark, d):
    """Script, embed and metadata markers in the raw HTML."""
    from quire.operators.audit import forensic_scan
    return forensic_scan(B.table(spark, d, "pages"))


@query("forensic_risk")
def q_forensic_risk(spark, d):
    """I3 per page: risk score and number of findings."""
    from quire.operators.audit import forensic_risk
    return forensic_risk(B.table(spark, d, "pages"))


# -- J: validation -------------------------------------------------------------------

@query("validate_nodes")
def q_validate_nodes(spark, d):
    """J1-J4 over conversation nodes with faults injected by the last digit of
    doc_id: 1 bbox, 2 depth, 3 page, 4 second root, 5 type, 7 duplicate id,
    9 dangling parent.  All rows are validated; bad rows are returned."""
    from quire.operators.validate import validate_nodes
    n = B.conv_built(spark, d).nodes
    digit, pre = F.pmod(F.col("doc_id"), F.lit(10)), F.col("pre")
    bad_box = F.struct(F.lit(-0.1).alias("x"), F.lit(0.0).alias("y"), F.lit(1.1).alias("width"),
                       F.lit(0.5).alias("height"))
    n = (n.withColumn("node_id", F.when((digit == 7) & (pre == 2), F.col("parent_id")).otherwise(F.col("node_id")))
         .withColumn("parent_id", F.when((digit == 9) & (pre == 2), F.lit("ast:missing"))
                     .when((digit == 4) & (pre == 1), F.lit(None)).otherwise(F.col("parent_id")))
         .withColumn("depth", F.when((digit == 2) & (pre == 3), F.lit(-1)).otherwise(F.col("depth")))
         .withColumn("node_type", F.when((digit == 5) & (pre == 2), F.lit("chapter")).otherwise(F.col("node_type")))
         .withColumn("page_index", F.when((digit == 3) & (pre == 1), F.lit(-1)).otherwise(F.col("page_index")))
         .withColumn("bbox", F.when((digit == 1) & (pre == 0), bad_box).otherwise(F.col("bbox"))))
    v = validate_nodes(n)
    return v.filter(F.size("violations") > 0).select("doc_id", "node_id", "pre",
                                                     F.array_join("violations", ",").alias("violations"))


# -- K3/K4: streams -------------------------------------------------------------------

@query("stream_cited_text")
def q_stream_cited_text(spark, d):
    """K3: the documents file streamed (availableNow) through node building and
    cited text into parquet, read back."""
    from quire.streaming import stream_cited_text
    return stream_cited_text(spark, d, B.PARA_DELIM)


@query("stream_dedupe")
def q_stream_dedupe(spark, d):
    """K4: distinct (source_hash, full_hash) keys kept by the streaming dedupe."""
    from quire.streaming import stream_dedupe
    return stream_dedupe(spark, d)


@query("stream_dedupe_watermark")
def q_stream_dedupe_watermark(spark, d):
    """K4 with a watermark on the arrival time, so the state stays bounded."""
    from quire.streaming.stream import stream_dedupe_watermark
    return stream_dedupe_watermark(spark, d)


# -- A13, C7, D2 corpus scope ------------------------------------------------------

@query("require_tagged")
def q_require_tagged(spark, d):
    """Conversations (no structure tree) are refused, HTML pages pass."""
    conv, html = B.conv_built(spark, d), B.html_built(spark, d)
    return S.require_tagged(conv.docs).withColumn("corpus", F.lit("conversations")).unionByName(
        S.require_tagged(html.docs).withColumn("corpus", F.lit("pages"))).select(
        "doc_id", "corpus", "is_heuristic", "status", "reason")


@query("cited_text_min_confidence")
def q_cited_text_min_confidence(spark, d):
    """Cited blocks of conversations (0.5) and HTML pages (1.0) split at
    confidence 0.75; the kept side and the low-confidence side, labelled."""
    blocks = C.cited_text(B.conv_built(spark, d).nodes).withColumn("corpus", F.lit("conversations")).unionByName(
        C.cited_text(B.html_built(spark, d).nodes).withColumn("corpus", F.lit("pages")))
    kept, low = C.split_by_confidence(blocks, 0.75)
    return kept.withColumn("output", F.lit("kept")).unionByName(low.withColumn("output", F.lit("low_confidence"))) \
        .select("corpus", "doc_id", "pre", "node_id", "confidence", "output")


@query("search_corpus")
def q_search_corpus(spark, d):
    """D2 with corpus scope: the first 10 paragraphs containing 'the' in
    (doc_id, pre) order over all documents, with the corpus-wide total."""
    return C.search_nodes(B.docs_built(spark, d).nodes, node_type="paragraph", text_query="the",
                          max_results=10, scope="corpus")


@query("ast_json_headers")
def q_ast_json_headers(spark, d):
    """Headers of the HTML trees after the round trip, and damaged documents (every
    tenth JSON is cut short) with the reason they are refused for."""
    from quire.operators.tree import nodes_from_json, nodes_to_json
    b = B.html_built(spark, d)
    js = nodes_to_json(b.nodes, b.docs)
    cut_short = F.expr("substring(json, 1, length(json) - 1)")
    back = nodes_from_json(js.withColumn("json", F.when(F.col("doc_id") % 10 == 0, cut_short).otherwise(F.col("json"))))
    return back.docs.withColumn("reason", F.lit(None).cast("string")).unionByName(back.rejected, allowMissingColumns=True)


# -- B9-B14: structure trees --------------------------------------------------------

def _walked(spark, d, **kw):
    from quire.operators.tagged import tagged_nodes
    elements, docs, refs, pages = B.order_elements(spark, d)
    return tagged_nodes(elements, docs, refs, pages, **kw)


@query("tagged_walk")
def q_tagged_walk(spark, d):
    """The element walk with page references, MCIDs, unknown tags and one or two roots."""
    return B.node_rows(_walked(spark, d).nodes)


@query("page_level_text")
def q_page_level_text(spark, d):
    """B11 as in PDFs: a leaf's text is its whole page's text."""
    return _walked(spark, d, page_level_text=True).nodes.filter("text_content IS NOT NULL").select(
        "doc_id", "node_id", "page_index", "text_content")


@query("route_mixed")
def q_route_mixed(spark, d):
    """Conversations (heuristic, pages 1..2) and orders (tagged, where the page
    range does not apply) through one routing, with their confidence."""
    from quire.operators.nodes import confidence
    from quire.operators.tagged import route
    both = route(B.conv_built(spark, d, 1, 2), _walked(spark, d))
    return both.nodes.groupBy(confidence("heuristic").alias("confidence"), "node_type", "page_index").agg(
        F.count(F.lit(1)).alias("n_nodes"), F.count("mcid").alias("n_mcid"))


# -- responses, sinks and validation with faults ------------------------------------

@query("cited_tables_nested")
def q_cited_tables_nested(spark, d):
    """E2 nested (pages 0..0, C6), unfolded again: every cell of every table."""
    from quire.operators.tables import cited_tables_nested
    t = cited_tables_nested(B.tables_built(spark, d).nodes, 0, 0)
    cells = t.select("doc_id", "table_node_id", "row_count", "col_count", F.col("citation_anchor.node_id").alias("anchor"),
                     F.explode(F.flatten("rows")).alias("c"))
    return cells.select("doc_id", "table_node_id", "row_count", "col_count", "anchor", "c.row", "c.col", "c.row_span", "c.col_span",
                        "c.text", "c.confidence")


@query("extract_text")
def q_extract_text(spark, d):
    """D5 response: page 1 of every conversation, all pages counted."""
    return C.text_response(B.conv_pages(spark, d), page_index=1)


def _html_with_faults(spark, d):
    """HTML nodes with a fault by the last digit of doc_id: 1 levels skipped, 2 headings
    without text, 3 and 6 a figure or table without content, 4 no headings, 5 no items."""
    n = B.html_built(spark, d).nodes
    digit, kind, pre = F.pmod(F.col("doc_id"), F.lit(10)), F.col("node_type"), F.col("pre")
    fresh = (F.when((digit == 3) & (pre == 2), "figure").when((digit == 6) & (pre == 2), "table")
             .when((digit == 4) & (kind == "heading"), "paragraph").when((digit == 5) & (kind == "list_item"), "paragraph").otherwise(kind))
    gone = ((digit == 2) & (kind == "heading")) | ((digit == 3) & (pre == 2))
    return n.select(*[(F.when((digit == 1) & (kind == "heading"), F.lit(5)).otherwise(F.col("level")).alias("level") if c == "level"
                       else F.when(~gone, F.col(c)).alias(c) if c == "text_content" else fresh.alias(c) if c == "node_type" else F.col(c))
                      for c in n.columns])


@query("check_accessibility_faults")
def q_check_accessibility_faults(spark, d):
    """Every rule fires on the HTML corpus with injected faults."""
    from quire.operators.audit import check_accessibility
    return check_accessibility(_html_with_faults(spark, d))


@query("accessibility_response")
def q_accessibility_response(spark, d):
    """I1 response per page: conformance target, issue count, passed."""
    from quire.operators.audit import accessibility_summary, check_accessibility
    return accessibility_summary(check_accessibility(_html_with_faults(spark, d)),
                                 B.table(spark, d, "pages").select(F.col("page_id").alias("doc_id")))


@query("compliance_violations")
def q_compliance_violations(spark, d):
    """Violation records of two standards over the pages with injected faults."""
    from quire.operators.audit import check_accessibility, compliance_violations
    return compliance_violations(check_accessibility(_html_with_faults(spark, d)), ["PDF/A-3b", "WCAG-2.1-AA"])


@query("forensic_report")
def q_forensic_report(spark, d):
    """I3 response rows with finding ids, descriptions, evidence and checks."""
    from quire.operators.audit import forensic_report
    r = forensic_report(B.table(spark, d, "pages"))
    return r.withColumn("evidence", F.element_at("evidence", F.lit("count"))).withColumn("checks", F.array_join("checks", ","))


@query("forensic_evidence")
def q_forensic_evidence(spark, d):
    """Every script and embed marker with its place and what follows it."""
    from quire.operators.audit import forensic_evidence
    return forensic_evidence(B.table(spark, d, "pages"), ["javascript", "embedded_files"])


@query("validate_blocks")
def q_validate_blocks(spark, d):
    """J2/J3 over cited blocks with faults by doc_id: confidence 1.5, page -1, depth -1, a box outside the page."""
    from quire.operators.validate import validate_blocks
    b = C.cited_text(B.conv_built(spark, d).nodes)
    digit = F.pmod(F.col("doc_id"), F.lit(10))
    box = F.struct(F.lit(-0.1).alias("x"), F.lit(0.0).alias("y"), F.lit(1.0).alias("width"), F.lit(1.0).alias("height"))
    b = (b.withColumn("confidence", F.when(digit == 1, F.lit(1.5)).otherwise(F.col("confidence")))
         .withColumn("page_index", F.when(digit == 2, F.lit(-1)).otherwise(F.col("page_index")))
         .withColumn("depth", F.when(digit == 3, F.lit(-1)).otherwise(F.col("depth")))
         .withColumn("bbox", F.when(digit == 4, box).otherwise(F.col("bbox"))))
    return validate_blocks(b).filter(F.size("violations") > 0).select("doc_id", "node_id", F.array_join("violations", ",").alias("violations"))


@query("validate_docs")
def q_validate_docs(spark, d):
    """J3 over documents, every tenth with a page count of zero."""
    from quire.operators.validate import validate_docs
    docs = B.conv_built(spark, d).docs
    docs = docs.withColumn("page_count", F.when(F.pmod(F.col("doc_id"), F.lit(10)) == 0, F.lit(0)).otherwise(F.col("page_count")))
    return validate_docs(docs).select("doc_id", F.array_join("violations", ",").alias("violations"))


@query("sink_json_files")
def q_sink_json_files(spark, d):
    """Cited blocks as JSON files in the shared folder, read back."""

    from quire.session import checkpoint_dir
    from quire.sources.sinks import write_json
    blocks = _cited_flat(B.conv_built(spark, d).nodes)
    path = f"{checkpoint_dir(spark).rstrip('/')}/{uuid.uuid4().hex}"
    write_json(blocks, path)
    return spark.read.schema(blocks.schema).json(path)


@query("sink_text_files")
def q_sink_text_files(spark, d):
    """A10: paragraphs as text files in the shared folder, read back and counted by text."""

    from quire.session import checkpoint_dir
    from quire.sources.sinks import write_text
    path = f"{checkpoint_dir(spark).rstrip('/')}/{uuid.uuid4().hex}"
    write_text(q_paragraphs(spark, d), path, "text")
    return spark.read.text(path).groupBy("value").agg(F.count(F.lit(1)).alias("n"))
