"""Node construction helpers shared by the builders (survey §2.B)."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import col_
from quire.schemas import BBOX, NODE_COLUMNS


class Built(NamedTuple):
    """A node builder's result: the ``nodes`` and ``docs`` tables, and the documents that
    its admission gate refused (doc_id, n_bytes, page_count, status, reason), if it has one."""

    nodes: DataFrame
    docs: DataFrame
    rejected: DataFrame | None = None


def _lit_null(t: str) -> Column:
    return F.lit(None).cast(t)


def node_struct(node_id, parent_id, pre, last, depth, child_pos, node_type, page_index,
                text_content=None, level=None, struct_type=None, heuristic=False, mcid=None,
                children_count=0, parent_pre=None) -> Column:
    """One ``nodes`` row (all but ``doc_id``) as a struct with the schema's
    field names and types."""

    def v(x, t):
        if x is None:
            return _lit_null(t)
        if isinstance(x, (bool, int, str)):
            return F.lit(x).cast(t)
        return col_(x).cast(t)

    return F.struct(
        v(node_id, "string").alias("node_id"),
        v(parent_id, "string").alias("parent_id"),
        v(parent_pre, "int").alias("parent_pre"),
        v(pre, "int").alias("pre"),
        v(last, "int").alias("last"),
        v(depth, "int").alias("depth"),
        v(child_pos, "int").alias("child_pos"),
        v(node_type, "string").alias("node_type"),
        v(page_index, "int").alias("page_index"),
        v(text_content, "string").alias("text_content"),
        v(level, "int").alias("level"),
        v(struct_type, "string").alias("struct_type"),
        v(heuristic, "boolean").alias("heuristic"),
        v(mcid, "int").alias("mcid"),
        F.lit(None).cast(BBOX).alias("bbox"),
        v(children_count, "int").alias("children_count"),
    )


def explode_nodes(df: DataFrame, arr: Column) -> DataFrame:
    """Rows each holding an array of node structs -> ``nodes`` rows.

    ``doc_id`` stays the input's own column (not a struct field), so a hash
    partitioning of the input on doc_id survives the generator and later
    per-document windows and aggregates reuse it without a new exchange.
    """
    # The outer generator avoids the inferred ``size(arr) > 0`` filter, which
    # predicate pushdown would otherwise inline below the projections,
    # evaluating the whole array expression twice.  Arrays here are never
    # empty; the null guard only drops the outer placeholder row.
    return df.select("doc_id", F.inline_outer(arr)).filter(F.col("node_id").isNotNull()).select(*NODE_COLUMNS)


def node_tokens(nodes: DataFrame) -> DataFrame:
    """Per-node token estimate column ``tokens``."""
    from quire.functions.text import est_tokens
    return nodes.withColumn("tokens", est_tokens("text_content"))


def doc_tokens(nodes: DataFrame) -> DataFrame:
    """Estimated tokens per document (sum over its tree).

    A hash aggregate with partial (map-side) sums: a document of any size
    ships one partial row per task.
    """
    from quire.functions.text import est_tokens
    return nodes.groupBy("doc_id").agg(F.sum(est_tokens("text_content")).cast("bigint").alias("estimated_tokens"))


def preorder(nodes: DataFrame) -> DataFrame:
    """Emission order of every query."""
    return nodes.orderBy("doc_id", "pre")


def confidence(is_heuristic) -> Column:
    """0.5 for heuristic documents, 1.0 for tagged ones."""
    return F.when(col_(is_heuristic), F.lit(0.5)).otherwise(F.lit(1.0))
