"""Filters and projections over ``nodes``: cited text, search, info, outline,
plain text, token budgets (survey §2.C and §2.D).

Every operator keeps the ``(doc_id, pre)`` preorder so callers can sort on it;
none of them sorts globally unless asked (``scope="corpus"``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.text import content_hash, est_tokens, py_strip  # noqa: F401
from quire.operators.nodes import confidence


def bbox_placeholder() -> Column:
    """The full-page box used in anchors when a node has no bbox."""
    return F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y"),
                    F.lit(1.0).alias("width"), F.lit(1.0).alias("height"))


# -- C: predicates -----------------------------------------------------------------

def has_text() -> Column:
    """Non-null, non-empty text."""
    return F.col("text_content").isNotNull() & (F.length("text_content") > 0)


def page_equals(page_index: int) -> Column:
    """C2."""
    return F.col("page_index") == F.lit(int(page_index))


def type_equals(node_type: str) -> Column:
    """C3/C4."""
    return F.col("node_type") == F.lit(node_type)


def text_contains(query: str) -> Column:
    """Case-insensitive substring; an empty query matches every node with text."""
    return has_text() & F.contains(F.lower("text_content"), F.lower(F.lit(query)))


def page_between(start: int | None, end: int | None, page_count: Column | None = None) -> Column:
    """Inclusive; missing start -> 0, missing end -> page_count-1; no clamp."""
    lo = F.lit(0 if start is None else int(start))
    if end is None and page_count is None:
        return F.col("page_index") >= lo
    return F.col("page_index").between(lo, (page_count - 1) if end is None else F.lit(int(end)))


def split_by_confidence(blocks: DataFrame, min_confidence: float) -> tuple[DataFrame, DataFrame]:
    """(kept, low_confidence) by ``confidence >= c``."""
    keep = F.col("confidence") >= F.lit(float(min_confidence))
    return blocks.filter(keep), blocks.filter(~keep)


# -- D: projections ----------------------------------------------------------------

def cited_text(nodes: DataFrame, page_index: int | None = None, headings_only: bool = False) -> DataFrame:
    """Text blocks with citation anchors, one row per node with text.

    Filters run after numbering (ids do not change with the filter).  The
    confidence comes from the node's own heuristic flag, which is the same for
    every node of a document, so no join with ``docs`` is needed.
    """
    cond = has_text()
    if page_index is not None:
        cond = cond & page_equals(page_index)
    if headings_only:
        cond = cond & type_equals("heading")
    return nodes.filter(cond).select(
        "doc_id", "pre", "node_id", "page_index", "node_type",
        F.col("text_content").alias("text"),
        confidence("heuristic").alias("confidence"),
        content_hash("text_content").alias("content_hash"),
        F.coalesce("bbox", bbox_placeholder()).alias("bbox"),
        "depth")


def flatten_bbox(df: DataFrame, col: str = "bbox") -> DataFrame:
    """STRUCT bbox -> four DOUBLE columns (for flat sinks and oracles)."""
    return df.select(*[c for c in df.columns if c != col],
                     *[F.col(f"{col}.{f}").alias(f"bbox_{f}") for f in ("x", "y", "width", "height")])


def search_nodes(nodes: DataFrame, node_type: str | None = None, page_index: int | None = None,
                 text_query: str | None = None, max_results: int | None = None,
                 scope: str = "document") -> DataFrame:
    """AND of the filters; shallow rows with ``total_matches`` and ``truncated``.

    Without ``max_results`` every match is returned.  ``scope="document"``: the first ``max_results`` matches of every document
    in preorder (window partitioned by doc_id).  ``scope="corpus"``: the first
    matches of the whole corpus in (doc_id, pre) order, from one scan.
    """
    if max_results is not None and max_results < 0:
        raise ValueError("max_results must be >= 0")
    cond = F.lit(True)
    if node_type is not None:
        cond = cond & type_equals(node_type)
    if page_index is not None:
        cond = cond & page_equals(page_index)
    if text_query is not None:
        cond = cond & text_contains(text_query)
    shallow = nodes.filter(cond).select(
        "doc_id", "pre", "node_id", "node_type", "page_index", "text_content", "level",
        "struct_type", "heuristic", "children_count")
    if scope == "corpus":
        if max_results is not None:
            return _corpus_top(shallow, int(max_results))
        # The total is a one-row aggregate attached by a constant key.
        total = shallow.agg(F.count(F.lit(1)).alias("total_matches")).withColumn("_k", F.lit(1))
        return shallow.withColumn("_k", F.lit(1)).join(F.broadcast(total), "_k").drop("_k").withColumn("truncated", F.lit(False))
    w = Window.partitionBy("doc_id")
    ranked = (shallow
              .withColumn("rank", F.row_number().over(w.orderBy("pre")))
              .withColumn("total_matches", F.count(F.lit(1)).over(w)))
    if max_results is None:
        return ranked.withColumn("truncated", F.lit(False))
    return ranked.filter(F.col("rank") <= F.lit(int(max_results))).withColumn(
        "truncated", F.col("total_matches") > F.lit(int(max_results)))


def _corpus_top(shallow: DataFrame, k: int) -> DataFrame:
    """The first ``k`` rows in (doc_id, pre) order with ``total_matches`` and ``truncated``, in one pass.

    Every task keeps its ``k`` first rows while it counts all, so at most ``k`` rows (one
    for the count if ``k`` is 0) leave each task for the merge.
    """
    def keep(batches):
        # Nested, so that executors get it by value and need no package.
        import pyarrow as pa
        best, n = None, 0
        for b in batches:
            n += b.num_rows
            t = pa.Table.from_batches([b])
            best = (t if best is None else pa.concat_tables([best, t])).sort_by([("doc_id", "ascending"), ("pre", "ascending")]).slice(0, max(k, 1))
        if n:
            counts = pa.array([n] + [0] * (best.num_rows - 1), pa.int64())
            yield from best.append_column("_n", counts).combine_chunks().to_batches()

    some = shallow.mapInArrow(keep, T.StructType([*shallow.schema.fields, T.StructField("_n", T.LongType())]))
    every = some.withColumn("total_matches", F.sum("_n").over(Window.partitionBy()))  # at most k rows a task
    return every.orderBy("doc_id", "pre").limit(k).drop("_n").withColumn("truncated", F.col("total_matches") > F.lit(k))


def document_info(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """D3: schema_version, source_hash, page_count, estimated_tokens,
    root_node_type, root_children_count per document.

    The per-node aggregate is partial (map-side) before its shuffle; the
    join is then between two one-row-per-document tables.
    """
    per_doc = nodes.groupBy("doc_id").agg(
        F.sum(est_tokens("text_content")).cast("bigint").alias("estimated_tokens"),
        F.max(F.when(F.col("pre") == 0, F.col("node_type"))).alias("root_node_type"),
        F.max(F.when(F.col("pre") == 0, F.col("children_count"))).alias("root_children_count"))
    return docs.join(per_doc, "doc_id", "left").select(
        "doc_id", "schema_version", "source_hash", "page_count",
        F.coalesce("estimated_tokens", F.lit(0).cast("bigint")).alias("estimated_tokens"),
        "root_node_type", "root_children_count")


def outline(nodes: DataFrame, max_results: int | None = None) -> DataFrame:
    """Headings in preorder with text (or '') and depth = level (default 1);
    per-document ``heading_count`` (after the cap), ``total_matches`` and
    ``truncated``."""
    hits = search_nodes(nodes, node_type="heading", max_results=max_results)
    w = Window.partitionBy("doc_id")
    return hits.select(
        "doc_id", "pre", "node_id", "page_index",
        F.coalesce("text_content", F.lit("")).alias("text"),
        F.coalesce("level", F.lit(1)).alias("depth"),
        F.count(F.lit(1)).over(w).alias("heading_count"),
        "total_matches", "truncated")


def plain_text(pages_long: DataFrame, page_index: int | None = None, sep: str = "\n") -> DataFrame:
    """One text per document, pages joined by ``sep`` in page order.

    The per-document list is bounded by the admission gate (A3/A4), which
    callers apply first.
    """
    src = pages_long if page_index is None else pages_long.filter(page_equals(page_index))
    return src.groupBy("doc_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_index", "page_text"))),
                                 lambda s: s["page_text"]), sep).alias("text"),
        F.count(F.lit(1)).cast("int").alias("pages_processed"))


def text_response(pages_long: DataFrame, page_index: int | None = None, sep: str = "\n") -> DataFrame:
    """D5 response: the text of the selected pages with ``page_count`` (all pages) and
    ``pages_processed`` (selected), in one aggregation."""
    wanted = F.lit(True) if page_index is None else page_equals(page_index)
    picked = F.array_sort(F.collect_list(F.when(wanted, F.struct("page_index", "page_text"))))
    return pages_long.groupBy("doc_id").agg(
        F.array_join(F.transform(picked, lambda s: s["page_text"]), sep).alias("text"),
        F.count(F.lit(1)).cast("int").alias("page_count"), F.count_if(wanted).cast("int").alias("pages_processed"))


def first_pages(pages_long: DataFrame, max_pages: int) -> DataFrame:
    """Keep pages ``< max(1, n)`` before numbering."""
    return pages_long.filter(F.col("page_index") < F.lit(max(1, int(max_pages))))


def with_running_tokens(blocks: DataFrame, text_col: str = "text") -> DataFrame:
    """Per-block tokens and the running sum in preorder within each document."""
    w = Window.partitionBy("doc_id").orderBy("pre").rowsBetween(Window.unboundedPreceding, 0)
    return (blocks.withColumn("tokens", est_tokens(text_col))
            .withColumn("cum_tokens", F.sum("tokens").over(w).cast("bigint")))


def token_budget(blocks: DataFrame, budget: int) -> DataFrame:
    """Keep blocks while the running token sum stays within the budget."""
    if budget <= 0:
        raise ValueError("budget must be > 0")
    return with_running_tokens(blocks).filter(F.col("cum_tokens") <= F.lit(int(budget)))


def chunk_index(blocks: DataFrame, budget: int) -> DataFrame:
    """``chunk_index = floor(tokens before the block / budget)``."""
    if budget <= 0:
        raise ValueError("budget must be > 0")
    return with_running_tokens(blocks).withColumn(
        "chunk_index", F.floor((F.col("cum_tokens") - F.col("tokens")) / F.lit(int(budget))).cast("int"))
