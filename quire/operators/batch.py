"""K1/K2: whole-corpus runs with a per-document outcome, and page metering."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators.heuristic import wide_stats
from quire.sources.corpus import DEFAULT_MAX_FILE_SIZE, DEFAULT_MAX_PAGES, gate


def batch_outcome(wide: DataFrame, delim: str = "\n\n", max_file_size: int = DEFAULT_MAX_FILE_SIZE,
                  max_pages: int = DEFAULT_MAX_PAGES) -> DataFrame:
    """K1: every document gets ``status``/``reason``; accepted ones their block count.

    A rejected document never fails the job (the batch keeps going).  Blocks are
    counted inside the row (``wide_stats``): one scan, no nodes, no shuffle.
    """
    sized = wide.withColumn("n_bytes", F.octet_length("source").cast("bigint")).withColumn("page_count", F.size("pages"))
    gated = gate(sized, max_file_size=max_file_size, max_pages=max_pages)
    # A refused document's text is not parsed.
    ok = F.col("status") == "ok"
    pages = F.when(ok, F.col("pages")).otherwise(F.array().cast("array<string>"))
    return wide_stats(gated.withColumn("pages", pages), delim, ["status", "reason", "n_bytes", "page_count"]).select(
        "doc_id", "status", "reason", "n_bytes", "page_count", F.when(ok, F.col("n_blocks")).alias("n_blocks"))


def metering(stats: DataFrame) -> DataFrame:
    """K2: one row: documents, pages processed (sum of page counts), blocks.

    ``stats`` holds page_count and n_blocks per document (``wide_stats``), so no node
    is built to be counted.
    """
    return stats.agg(F.count(F.lit(1)).alias("documents"), F.sum("page_count").cast("bigint").alias("pages_processed"),
                     F.coalesce(F.sum("n_blocks"), F.lit(0)).cast("bigint").alias("blocks"))
