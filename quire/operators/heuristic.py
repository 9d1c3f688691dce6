"""The heuristic (untagged) AST, document -> section per page -> paragraphs.

Numbering in closed form.  With n(p) paragraphs on page p and
B(p) = sum over earlier pages q in range of (n(q) + 1):

* id sequence (postorder from 1): paragraph k of page p -> B+k+1, section ->
  B+n+1, document -> sum(n+1)+1;
* preorder: document 0, section 1+B, paragraph 2+B+k;
* subtree end: section 1+B+n, document sum(n+1).

So nodes need only page-level counts: one row per page, never a window over
all nodes.  Pages outside the requested range are removed *before* numbering,
because ids restart at the first page in range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import (PAGE_SEPARATOR, SCHEMA_VERSION, SOURCE_HASH_BYTES, est_tokens, node_id,
                                  source_hash_of_text, split_paragraphs)
from quire.operators.nodes import Built, explode_nodes, node_struct
from quire.sources.corpus import DEFAULT_MAX_FILE_SIZE, DEFAULT_MAX_PAGES, accepted, gate, rejected


def clamp_range(page_count: Column, start: int | None, end: int | None) -> tuple[Column, Column]:
    """``start=max(0,min(start,pc-1))``, ``end=max(start,min(end,pc-1))``."""
    s = F.lit(0) if start is None else F.greatest(F.lit(0), F.least(F.lit(int(start)), page_count - 1))
    e = page_count - 1 if end is None else F.greatest(s, F.least(F.lit(int(end)), page_count - 1))
    return s, e


def first_pages_range(max_pages: int) -> tuple[int, int]:
    """The first-N-pages cap as a page range ``[0, max(0, N-1)]``."""
    return 0, max(0, int(max_pages) - 1)


def _emit(pages: DataFrame) -> DataFrame:
    """Page rows with numbering columns -> node rows.

    Input columns: doc_id, source_hash, page_index, child_pos, paras, b,
    total, n_sections, is_first.  The document node is emitted by the first
    page in range.
    """
    src, page, b = F.col("source_hash"), F.col("page_index"), F.col("b")
    n = F.size("paras")
    doc_nid = node_id(src, F.lit(0), F.col("total") + 1)
    sec_nid = node_id(src, page, b + n + 1)
    doc = node_struct(doc_nid, None, 0, F.col("total"), 0, 0, "document", 0,
                      heuristic=True, children_count=F.col("n_sections"))
    sec = node_struct(sec_nid, doc_nid, b + 1, b + 1 + n, 1, F.col("child_pos"), "section",
                      page, heuristic=True, children_count=n, parent_pre=0)
    paras = F.transform("paras", lambda t, k: node_struct(
        node_id(src, page, b + k + 1), sec_nid, b + k + 2, b + k + 2, 2, k, "paragraph",
        page, text_content=t, heuristic=True, children_count=0, parent_pre=b + 1))
    arr = F.concat(F.filter(F.array(doc), lambda _: F.col("is_first")), F.array(sec), paras)
    return explode_nodes(pages, arr)


def _wide_gate(wide: DataFrame, max_file_size: int, max_pages: int) -> DataFrame:
    sized = wide.withColumn("n_bytes", F.octet_length("source").cast("bigint")).withColumn("page_count", F.size("pages"))
    return gate(sized, max_file_size=max_file_size, max_pages=max_pages)


def _page_counts(paras: Column) -> Column:
    """Struct (blocks, tokens) of an array of paragraphs."""
    none = F.struct(F.lit(0).cast("bigint").alias("blocks"), F.lit(0).cast("bigint").alias("tokens"))
    return F.aggregate(paras, none, lambda a, t: F.struct((a["blocks"] + 1).alias("blocks"), (a["tokens"] + est_tokens(t)).alias("tokens")))


def wide_stats(wide: DataFrame, delim: str = "\n\n", more: list | None = None) -> DataFrame:
    """Per document, without building nodes: page_count, n_blocks (its paragraphs) and estimated_tokens.

    Counted inside the row: no generator, no shuffle.  ``more`` columns are passed on (a page_count
    among them replaces the count).
    """
    paras = F.flatten(F.transform("pages", lambda p: split_paragraphs(p, delim)))
    own = [] if more else [F.size("pages").alias("page_count")]
    return wide.select("doc_id", *(more or []), *own, _page_counts(paras).alias("f")).select(
        "*", F.col("f.blocks").alias("n_blocks"), F.col("f.tokens").alias("estimated_tokens")).drop("f")


def long_info(pages_long: DataFrame, delim: str = "\n\n") -> DataFrame:
    """D3 of the heuristic documents over page rows: what ``document_info`` says, from counts per page.

    The page rows meet once by doc_id (for the source hash); no node is built.
    """
    hp = with_source_hash(pages_long)
    counted = hp.select("doc_id", "source_hash", "page_count", _page_counts(split_paragraphs("page_text", delim)).alias("f"))
    return counted.groupBy("doc_id", "source_hash", "page_count").agg(F.sum("f.tokens").alias("estimated_tokens")).select(
        "doc_id", F.lit(SCHEMA_VERSION).alias("schema_version"), "source_hash", "page_count", "estimated_tokens",
        F.lit("document").alias("root_node_type"), F.col("page_count").alias("root_children_count"))


def heuristic_nodes_wide(wide: DataFrame, delim: str = "\n\n", start: int | None = None, end: int | None = None,
                         max_file_size: int = DEFAULT_MAX_FILE_SIZE, max_pages: int = DEFAULT_MAX_PAGES) -> Built:
    """B6 over one-row documents ``(doc_id, source, pages)``: no shuffle at all.

    Page counts and the running sums B(p) are array expressions inside the row.
    Documents that the admission gate refuses (A3, A4) are in ``rejected`` only.
    """
    gated = _wide_gate(wide, max_file_size, max_pages)
    refused = rejected(gated).select("doc_id", "n_bytes", "page_count", "status", "reason")
    # Refused documents are emptied, not filtered out: a filter would move below the
    # columns it reads and compute the text (a redaction, say) once more.
    ok, pc = F.col("status") == "ok", F.col("page_count")
    s, e = clamp_range(pc, start, end)
    sel = F.when(ok, F.slice("pages", s + 1, e - s + 1)).otherwise(F.array().cast("array<string>"))
    base = gated.select(
        "doc_id", source_hash_of_text("source").alias("source_hash"), "page_count", ok.alias("ok"),
        s.alias("start"),
        F.transform(sel, lambda p: split_paragraphs(p, delim)).alias("paras_by_page"))
    # One pass carries the running offset B(p) and the list of pages with theirs.
    empty = F.struct(F.lit(0).alias("b"), F.array().cast("array<struct<paras:array<string>,b:int>>").alias("pg"))
    run = F.aggregate("paras_by_page", empty, lambda a, x: F.struct(
        (a["b"] + F.size(x) + 1).alias("b"), F.array_append(a["pg"], F.struct(x.alias("paras"), a["b"].alias("b"))).alias("pg")))
    per_doc = base.select("doc_id", "source_hash", "start", F.size("paras_by_page").alias("n_sections"), run.alias("run")).select(
        "doc_id", "source_hash", "start", "n_sections", F.col("run.b").alias("total"), F.col("run.pg").alias("pg"))
    pages = per_doc.select(
        "doc_id", "source_hash", "total", "n_sections", "start",
        F.posexplode_outer("pg").alias("child_pos", "pg")).filter(F.col("child_pos").isNotNull()).select(
        "doc_id", "source_hash", "total", "n_sections",
        (F.col("start") + F.col("child_pos")).alias("page_index"), "child_pos",
        F.col("pg.paras").alias("paras"), F.col("pg.b").alias("b"),
        (F.col("child_pos") == 0).alias("is_first"))
    about = F.struct(F.lit(SCHEMA_VERSION).alias("schema_version"), "source_hash", F.col("page_count").cast("int").alias("page_count"),
                     F.lit(True).alias("is_heuristic"))
    docs = base.select("doc_id", F.inline_outer(F.filter(F.array(about), lambda _: F.col("ok")))).filter(F.col("schema_version").isNotNull())
    return Built(_emit(pages), docs, refused)


def with_source_hash(pages_long: DataFrame) -> DataFrame:
    """Add ``source_hash`` and ``page_count`` to long page rows.

    The document's bytes are its pages joined by a form feed; only the pages
    that start inside the first 4096 bytes contribute, each cut to the bytes
    still needed, so the per-document list is at most 4 KB however long the
    document is.  One exchange on doc_id, shared with the numbering windows.
    A ``source_hash`` column already present (a document whose bytes are
    known) is kept as is.
    """
    if "source_hash" in pages_long.columns:
        return pages_long.withColumn("page_count", F.count(F.lit(1)).over(Window.partitionBy("doc_id")).cast("int"))
    w_ord = Window.partitionBy("doc_id").orderBy("page_index")
    w_prev = w_ord.rowsBetween(Window.unboundedPreceding, -1)
    w_all = Window.partitionBy("doc_id")
    part = F.encode(F.concat(F.when(F.row_number().over(w_ord) > 1, F.lit(PAGE_SEPARATOR)).otherwise(F.lit("")),
                             F.col("page_text")), "UTF-8")
    x = pages_long.withColumn("_part", part)
    x = x.withColumn("_off", F.coalesce(F.sum(F.octet_length("_part")).over(w_prev), F.lit(0)))
    piece = F.when(F.col("_off") < SOURCE_HASH_BYTES,
                   F.struct(F.col("page_index").alias("i"),
                            F.expr(f"substring(_part, 1, greatest({SOURCE_HASH_BYTES} - _off, 0))").alias("b")))
    x = x.withColumn("_pieces", F.collect_list(piece).over(w_all)).withColumn(
        "page_count", F.count(F.lit(1)).over(w_all).cast("int"))
    joined = F.aggregate(F.transform(F.array_sort("_pieces"), lambda t: t["b"]),
                         F.lit(b"").cast("binary"), lambda acc, y: F.concat(acc, y))
    return x.withColumn("source_hash", F.sha2(F.substring(joined, 1, SOURCE_HASH_BYTES), 256)).drop(
        "_part", "_off", "_pieces")


def heuristic_nodes_long(pages_long: DataFrame, delim: str = "\n\n", start: int | None = None, end: int | None = None,
                         max_file_size: int = DEFAULT_MAX_FILE_SIZE, max_pages: int = DEFAULT_MAX_PAGES) -> Built:
    """B6 over page rows ``(doc_id, page_index, page_text)``.

    One exchange on doc_id; every window below partitions by doc_id and reuses
    it.  Documents that the admission gate refuses (A3, A4) are in ``rejected``
    only, so what is numbered has at most ``max_pages`` pages.  A range counts the
    pages that exist, in ``page_index`` order, so indices may have gaps or start
    anywhere.
    """
    hp = with_source_hash(pages_long).withColumn("n_bytes", (
        F.sum(F.octet_length("page_text")).over(Window.partitionBy("doc_id")) + F.col("page_count") - 1).cast("bigint"))
    gated = gate(hp, max_file_size=max_file_size, max_pages=max_pages)
    refused = rejected(gated).select("doc_id", "n_bytes", "page_count", "status", "reason").distinct()
    hp = accepted(gated).drop("n_bytes")
    s, e = clamp_range(F.col("page_count"), start, end)
    hp = hp.withColumn("_nth", F.row_number().over(Window.partitionBy("doc_id").orderBy("page_index")) - 1)
    w_ord = Window.partitionBy("doc_id").orderBy("page_index")
    w_prev = w_ord.rowsBetween(Window.unboundedPreceding, -1)
    w_all = Window.partitionBy("doc_id")
    docs = hp.filter(F.col("_nth") == F.lit(0)).select(
        "doc_id", F.lit(SCHEMA_VERSION).alias("schema_version"), "source_hash", "page_count",
        F.lit(True).alias("is_heuristic"))
    in_range = hp.filter(F.col("_nth").between(s, e)).withColumn(
        "paras", split_paragraphs("page_text", delim)).drop("page_text", "_nth")
    n1 = F.size("paras") + 1
    numbered = (in_range
                .withColumn("b", F.coalesce(F.sum(n1).over(w_prev), F.lit(0)).cast("int"))
                .withColumn("child_pos", (F.row_number().over(w_ord) - 1).cast("int"))
                .withColumn("total", F.sum(n1).over(w_all).cast("int"))
                .withColumn("n_sections", F.count(F.lit(1)).over(w_all).cast("int"))
                .withColumn("is_first", F.col("child_pos") == 0))
    return Built(_emit(numbered), docs, refused)
