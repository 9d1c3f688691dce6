"""Document-level transforms whose outputs are tables (survey §2.H)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import content_hash
from quire.session import checkpoint_dir

DEFAULT_REPLACEMENT = "[REDACTED]"


def literal_pattern(text: str) -> str:
    """A literal string as a regular expression (``\\Q...\\E``)."""
    if "\\E" in text:
        return re.escape(text)
    return "\\Q" + text + "\\E"


def redact_text(text, patterns: list[str], replacement: str = DEFAULT_REPLACEMENT) -> tuple[Column, Column]:
    """(redacted text, number of redactions) for a list of regular expressions.

    Patterns apply in order; each one is counted on the text left by the
    previous replacements, so a later pattern never re-counts a replacement.
    """
    s = F.coalesce(text if isinstance(text, Column) else F.col(text), F.lit(""))
    count = F.lit(0)
    repl = replacement.replace("\\", "\\\\").replace("$", "\\$")
    for p in patterns:
        count = count + F.regexp_count(s, F.lit(p))
        s = F.regexp_replace(s, p, repl)
    return s, count


def redact(pages_long: DataFrame, patterns: list[str], replacement: str = DEFAULT_REPLACEMENT,
           page_start: int | None = None, page_end: int | None = None) -> DataFrame:
    """H1: redact pages in the (inclusive) range; others pass through unchanged.

    Output ``(doc_id, page_index, in_range, redaction_count, page_text)``.  Row
    at a time: no shuffle.
    """
    lo = F.lit(0 if page_start is None else int(page_start))
    in_range = F.col("page_index") >= lo
    if page_end is not None:
        in_range = in_range & (F.col("page_index") <= F.lit(int(page_end)))
    # one projection per pattern: a later pattern reads the earlier result as a
    # column instead of running all earlier replacements again
    repl = replacement.replace("\\", "\\\\").replace("$", "\\$")
    x = pages_long.select("doc_id", "page_index", in_range.alias("in_range"), F.col("page_text").alias("_raw"),
                          F.coalesce("page_text", F.lit("")).alias("_text"), F.lit(0).alias("_n"))
    for p in patterns:
        x = x.select("doc_id", "page_index", "in_range", "_raw", F.regexp_replace("_text", p, repl).alias("_text"),
                     (F.col("_n") + F.regexp_count("_text", F.lit(p))).alias("_n"))
    return x.select(
        "doc_id", "page_index", "in_range",
        F.when(F.col("in_range"), F.col("_n")).otherwise(F.lit(0)).cast("bigint").alias("redaction_count"),
        F.when(F.col("in_range"), F.col("_text")).otherwise(F.col("_raw")).alias("page_text"))


def redact_summary(redacted: DataFrame) -> DataFrame:
    """H1 response: ``redaction_count`` and ``pages_processed`` per document."""
    return redacted.groupBy("doc_id").agg(
        F.sum("redaction_count").cast("bigint").alias("redaction_count"),
        F.count_if(F.col("in_range")).alias("pages_processed"))


def _page_rank() -> Column:
    """0-based place of a page among its document's pages; indices may have gaps or start anywhere."""
    return F.row_number().over(Window.partitionBy("doc_id").orderBy("page_index")) - 1


def merge_docs(pages_long: DataFrame, groups: DataFrame, block: int = 4096) -> DataFrame:
    """H2: ordered lists of documents -> one document per group.

    ``groups(group_id, doc_id, ord[, page_count])``; without page counts they
    are taken from the pages.  The numbered documents (one narrow row each) are
    written to the shared checkpoint folder once, since totals and offsets both
    read them.  A document's page offset is the sum of
    the page counts of the documents before it in its group.  The running sum
    is two-level so that one group holding a large share of the documents is
    not a single task: block totals per ``(group_id, ord // block)`` (a
    partial aggregate), a running sum over the blocks of a group (``1/block``
    of the rows), then a running sum inside each block.  Within a document pages
    count by their rank, so gaps in ``page_index`` leave none.  Output
    ``(group_id, ord, doc_id, page_index, merged_page_index, group_page_count)``.
    """
    b = int(block)
    if "page_count" not in groups.columns:
        groups = groups.join(pages_long.groupBy("doc_id").agg(F.count(F.lit(1)).alias("page_count")), "doc_id")
    checkpoint_dir(groups.sparkSession)
    g = groups.select("group_id", "doc_id", "ord", "page_count", F.floor(F.col("ord") / b).alias("blk")).checkpoint()
    totals = g.groupBy("group_id", "blk").agg(F.sum("page_count").alias("blk_pages"))
    wb = Window.partitionBy("group_id").orderBy("blk")
    totals = totals.withColumn("blk_offset", F.coalesce(F.sum("blk_pages").over(
        wb.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn(
        "group_page_count", F.sum("blk_pages").over(Window.partitionBy("group_id")))
    wi = Window.partitionBy("group_id", "blk").orderBy("ord")
    g = g.withColumn("in_blk", F.coalesce(F.sum("page_count").over(
        wi.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    g = g.join(totals, ["group_id", "blk"]).withColumn("offset", F.col("blk_offset") + F.col("in_blk"))
    ranked = pages_long.withColumn("_rank", _page_rank())
    return ranked.join(g.select("doc_id", "group_id", "ord", "offset", "group_page_count"), "doc_id").select(
        "group_id", "ord", "doc_id", "page_index",
        (F.col("offset") + F.col("_rank")).cast("bigint").alias("merged_page_index"),
        F.col("group_page_count").cast("bigint").alias("group_page_count"))


def split_doc(pages_long: DataFrame, split_at_pages: list[int] | None = None,
              max_pages_per_chunk: int | None = None) -> DataFrame:
    """H3: chunk number of every page.

    Split points are 0-based places of pages (the rank by ``page_index``, which may
    have gaps) that start a new chunk; no split points and no cap means every page is
    its own chunk.  With a cap, each chunk is cut further into runs of at most ``cap``
    pages.  Output
    ``(doc_id, page_index, chunk_index, chunk_page_count)``.
    """
    points = sorted(set(int(p) for p in (split_at_pages or [])))
    if max_pages_per_chunk is not None and max_pages_per_chunk < 1:
        raise ValueError("max_pages_per_chunk must be >= 1")
    page = F.col("_rank")
    if not points and max_pages_per_chunk is None:
        base, start = page, page
    else:
        arr = F.array(*[F.lit(p) for p in points]) if points else F.array().cast("array<int>")
        base = F.size(F.filter(arr, lambda s: s <= page))
        start = F.coalesce(F.array_max(F.filter(arr, lambda s: s <= page)), F.lit(0))
    sub = F.floor((page - start) / F.lit(int(max_pages_per_chunk))) if max_pages_per_chunk else F.lit(0)
    x = pages_long.withColumn("_rank", _page_rank()).select("doc_id", "page_index", base.alias("base"), sub.cast("int").alias("sub"))
    w = Window.partitionBy("doc_id").orderBy("base", "sub")
    x = x.withColumn("chunk_index", (F.dense_rank().over(w) - 1).cast("int"))
    return x.withColumn("chunk_page_count", F.count(F.lit(1)).over(
        Window.partitionBy("doc_id", "chunk_index")).cast("int")).select(
        "doc_id", "page_index", "chunk_index", "chunk_page_count")


def node_hash60(text) -> Column:
    """First 60 bits of a node's content hash (null text hashes as '')."""
    return F.conv(F.left(content_hash(text), F.lit(15)), 16, 10).cast("bigint")


def doc_fingerprint(nodes: DataFrame) -> DataFrame:
    """H4: fingerprint per document of its nodes' order, nesting, types, pages and texts.

    SHA-256 of ``count : xor : sum`` of 60-bit node hashes (the sum exact, as a
    decimal); a node hashes its preorder rank, depth, type and page with its
    text.  All three are partial aggregates, so a document of any size is folded
    per task without collecting its hashes into a list.
    """
    h = node_hash60(F.concat_ws(":", *[F.col(c).cast("string") for c in ("pre", "depth", "node_type", "page_index")],
                                F.coalesce("text_content", F.lit(""))))
    agg = nodes.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_nodes"), F.bit_xor(h).alias("x"),
        F.sum(h.cast("decimal(38,0)")).alias("s"))
    return agg.select("doc_id", F.sha2(F.concat_ws(":", F.col("n_nodes").cast("string"), F.col("x").cast("string"),
                                                   F.col("s").cast("string")), 256).alias("fingerprint"), "n_nodes")


def dedupe_by_hash(hashed: DataFrame) -> DataFrame:
    """H5: one document per (source_hash, full_hash), the smallest doc_id.

    Input needs ``doc_id, source_hash, full_hash``; the full hash guards
    documents sharing only their first 4 KB.  A grouped ``min``/``count`` runs
    as a partial aggregate before the shuffle, so a hash shared by a third of
    the corpus costs one row per task, not a hot partition.
    """
    return hashed.groupBy("source_hash", "full_hash").agg(
        F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies")).select(
        "doc_id", "source_hash", "copies")
