"""Diff and compare (survey §2.G): set operations between two node sets.

A pair is two documents (original, modified) sharing a ``pair`` key.  Nodes are
compared by signature ``page:type:content_hash(text or '')``; each side keeps
only the first node (in preorder) of every signature, so multiplicity is lost,
and a node is ``removed`` when its signature is missing from the other side,
``added`` the other way round.  This structural diff never reports ``changed``;
``compare_text`` aligns text blocks by position and does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import content_hash, preview


def signature(nodes: DataFrame) -> DataFrame:
    """G1: add ``sig``."""
    return nodes.withColumn("sig", F.concat_ws(":", F.col("page_index").cast("string"), F.col("node_type"),
                                               content_hash("text_content")))


def first_occurrence(nodes: DataFrame) -> DataFrame:
    """One node per (pair, sig), the earliest in preorder.

    A grouped ``min_by`` aggregates partially before the shuffle, so a
    signature repeated many times in one document never builds a hot group.
    """
    return signature(nodes).groupBy("pair", "sig").agg(
        F.min_by(F.struct("node_id", "node_type", "page_index", "text_content", "pre"), F.col("pre")).alias("n")
    ).select("pair", "sig", "n.*")


def diff_sides(nodes: DataFrame) -> DataFrame:
    """G2 + G3 over one table holding both versions (``pair``, ``side`` 0/1).

    Both set differences come from a single aggregation on (pair, sig): which
    sides hold the signature, and each side's first node in preorder
    (``min_by`` over that side's rows only).  One shuffle, combined map-side,
    no anti-joins; a signature shared by a large share of the rows costs one
    partial row per task.
    """
    first = F.struct("node_id", "node_type", "page_index", "text_content", "pre")
    side = F.col("side")
    g = signature(nodes).groupBy("pair", "sig").agg(
        F.count_if(side == 0).alias("n_a"), F.count_if(side == 1).alias("n_b"),
        F.min_by(first, F.when(side == 0, F.col("pre"))).alias("a"),
        F.min_by(first, F.when(side == 1, F.col("pre"))).alias("b"))
    removed = F.when((F.col("n_a") > 0) & (F.col("n_b") == 0), F.col("a"))
    added = F.when((F.col("n_b") > 0) & (F.col("n_a") == 0), F.col("b"))
    out = g.select("pair", F.when(removed.isNotNull(), F.lit("removed")).when(added.isNotNull(), F.lit("added"))
                   .alias("type"), F.coalesce(removed, added).alias("n")).filter(F.col("type").isNotNull())
    return out.select("pair", "type", "n.node_id", "n.node_type", "n.page_index",
                      preview(F.col("n.text_content")).alias("text_preview"), "n.pre")


def diff_nodes(original: DataFrame, modified: DataFrame) -> DataFrame:
    """``removed`` (in original only) and ``added`` (in modified only).

    Inputs are ``nodes`` rows with a ``pair`` column; see ``diff_sides``.
    """
    return diff_sides(original.withColumn("side", F.lit(0)).unionByName(modified.withColumn("side", F.lit(1))))


def diff_summary(diff: DataFrame, pairs: DataFrame) -> DataFrame:
    """Counts per pair; ``pairs(pair, original_page_count, modified_page_count)``.

    Identical pairs appear with zero counts (left join from the pairs).
    """
    c = diff.groupBy("pair").agg(F.count_if(F.col("type") == "added").alias("added_node_count"),
                                 F.count_if(F.col("type") == "removed").alias("removed_node_count"))
    return pairs.join(c, "pair", "left").select(
        "pair", F.coalesce("added_node_count", F.lit(0)).cast("bigint").alias("added_node_count"),
        F.coalesce("removed_node_count", F.lit(0)).cast("bigint").alias("removed_node_count"),
        F.lit(0).cast("bigint").alias("changed_node_count"), "original_page_count", "modified_page_count",
        (F.col("original_page_count") + F.col("modified_page_count")).alias("pages_processed"))


def _positioned(blocks: DataFrame) -> DataFrame:
    w = Window.partitionBy("pair", "side", "page_index").orderBy("pre")
    return blocks.select("pair", "side", "page_index", "pre", content_hash("text").alias("h")).withColumn(
        "block_pos", F.row_number().over(w) - 1)


def compare_text(original_blocks: DataFrame, modified_blocks: DataFrame, pairs: DataFrame) -> DataFrame:
    """Text blocks aligned by (pair, page, position in page).

    Left only -> removed, right only -> added, both with different content
    hashes -> changed.  Inputs are cited-text rows with a ``pair`` column.
    The alignment is an aggregation on (pair, page, position) rather than a
    full outer join: one shuffle, combined map-side.
    """
    both = original_blocks.select("pair", "page_index", "pre", "text", F.lit(0).alias("side")).unionByName(
        modified_blocks.select("pair", "page_index", "pre", "text", F.lit(1).alias("side")))
    p = _positioned(both)
    j = p.groupBy("pair", "page_index", "block_pos").agg(
        F.max(F.when(F.col("side") == 0, F.col("h"))).alias("ha"),
        F.max(F.when(F.col("side") == 1, F.col("h"))).alias("hb"))
    c = j.groupBy("pair").agg(
        F.count_if(F.col("ha").isNull()).alias("added_text_count"),
        F.count_if(F.col("hb").isNull()).alias("removed_text_count"),
        F.count_if(F.col("ha").isNotNull() & F.col("hb").isNotNull() & (F.col("ha") != F.col("hb")))
        .alias("changed_text_count"))
    return pairs.join(c, "pair", "left").select(
        "pair", "original_page_count", "modified_page_count",
        *[F.coalesce(x, F.lit(0)).cast("bigint").alias(x)
          for x in ("added_text_count", "removed_text_count", "changed_text_count")])
