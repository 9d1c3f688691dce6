"""Corpus scans, page adapters and admission gates (survey §2.A).

Two page layouts feed the node builders:

* **wide**: one row per document, ``(doc_id, source, pages ARRAY<STRING>)``.
  Used for corpora stored one document per row (``documents``): numbering is
  done with array functions inside the row, so building nodes needs no shuffle.
* **long**: one row per page, ``(doc_id, page_index, page_text)``.  Used for
  corpora stored one page per row (``conversations``): numbering needs one
  exchange on ``doc_id``, shared by every later window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.text import col_

# Admission limits of the in-process engine.
DEFAULT_MAX_FILE_SIZE = 200_000_000
DEFAULT_MAX_PAGES = 2000


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A1: read one parquet table of the corpus directory."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_files(spark: SparkSession, path: str, glob: str = "*.pdf") -> DataFrame:
    """A1 for raw files: ``binaryFile`` source -> (path, length, content).

    A missing path is an error at analysis time, as in the reference; files are
    read lazily per task, never through the driver.  Spark's file scan passes over
    files of no bytes.
    """
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", "true").load(path)
            .select("path", "length", "content"))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Deal the rows of an input with fewer splits than cores over all cores, by ``key``.

    An input with enough splits is read where it lies: row-local work needs no
    shuffle of the raw texts.
    """
    if df.isStreaming or df.rdd.getNumPartitions() >= df.sparkSession.sparkContext.defaultParallelism:
        return df
    return df.repartition(key)


def documents_wide(documents: DataFrame, lines_per_page: int | None = None, partition_by_doc: bool = False) -> DataFrame:
    """A2 for one-row documents: ``(doc_id, source, pages)``.

    Without ``lines_per_page`` a document is one page.  With it, page ``p``
    holds lines ``p*N .. p*N+N-1`` joined by newline; the split stays inside the
    row (no explode).

    The pages are made inside the row, without a shuffle; only an input with fewer
    splits than cores is dealt out (``spread``).  ``partition_by_doc`` hash-partitions
    the raw rows by doc_id instead, for many per-document windows that follow.
    """
    x = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                         F.coalesce(F.col("text"), F.lit("")).alias("source"))
    x = x.repartition("doc_id") if partition_by_doc else spread(x, "doc_id")
    if lines_per_page is None:
        return x.select("doc_id", "source", F.array("source").alias("pages"))
    n = int(lines_per_page)
    if n < 1:
        raise ValueError("lines_per_page must be >= 1")
    # `lines` is referenced twice, so it is computed once per row rather than
    # re-split for every page inside the lambda.
    x = x.select("doc_id", "source", F.split("source", "\n").alias("lines"))
    n_pages = F.greatest(F.lit(1), F.ceil(F.size("lines") / n).cast("int"))
    pages = F.transform(F.sequence(F.lit(0), n_pages - 1),
                        lambda p: F.array_join(F.slice(F.col("lines"), p * n + 1, F.lit(n)), "\n"))
    return x.select("doc_id", "source", pages.alias("pages"))


def wide_to_long(wide: DataFrame) -> DataFrame:
    """Wide layout -> long layout (one row per page)."""
    # Outer generator: no inferred size() filter re-evaluating `pages` below.
    return (wide.select("doc_id", F.posexplode_outer("pages").alias("page_index", "page_text"))
            .filter(F.col("page_index").isNotNull())
            .select("doc_id", F.col("page_index").cast("int").alias("page_index"), "page_text"))


def conversation_pages(conversations: DataFrame, partition_by_doc: bool = True) -> DataFrame:
    """A2 for conversations: conversation = document, turn = page.

    Hash-partitioned by doc_id: the numbering windows need exactly this
    exchange, so it costs nothing extra and later per-document operators
    reuse it.
    """
    x = conversations.select(
        F.col("conv_id").cast("bigint").alias("doc_id"),
        F.col("turn").cast("int").alias("page_index"),
        F.coalesce(F.col("text"), F.lit("")).alias("page_text"))
    return x.repartition("doc_id") if partition_by_doc else x


def source_bytes_length(pages_long: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, page_count): byte size of the serialised document.

    A document's bytes are its pages joined by a form feed.  Partial sums
    aggregate map-side, so a hot document costs one row per task, not a shuffle
    of its pages.
    """
    return (pages_long.groupBy("doc_id")
            .agg((F.sum(F.octet_length("page_text")) + F.count(F.lit(1)) - 1).cast("bigint").alias("n_bytes"),
                 F.count(F.lit(1)).cast("int").alias("page_count")))


def gate(df: DataFrame, n_bytes: Column | str = "n_bytes", page_count: Column | str = "page_count",
         max_file_size: int = DEFAULT_MAX_FILE_SIZE, max_pages: int = DEFAULT_MAX_PAGES) -> DataFrame:
    """A3-A5: admission status per document, never failing the job.

    ``size`` when the byte length is strictly greater than the limit; ``no_pages``
    for zero pages; ``too_many_pages`` above ``max_pages``.  The size check runs
    first, as in the reference.
    """
    nb, pc = col_(n_bytes), col_(page_count)
    reason = (F.when(nb > F.lit(max_file_size), F.lit("size"))
              .when(pc == 0, F.lit("no_pages"))
              .when(pc > F.lit(max_pages), F.lit("too_many_pages")))
    return df.withColumn("reason", reason).withColumn(
        "status", F.when(F.col("reason").isNull(), F.lit("ok")).otherwise(F.lit("rejected")))


def accepted(gated: DataFrame) -> DataFrame:
    return gated.filter(F.col("status") == "ok").drop("status", "reason")


def rejected(gated: DataFrame) -> DataFrame:
    return gated.filter(F.col("status") == "rejected")


def require_tagged(docs: DataFrame) -> DataFrame:
    """Documents without a structure tree are refused (``ast/no-struct-tree``).

    Returns the docs table with ``status``/``reason``; heuristic documents are
    rejected, tagged ones pass.
    """
    reason = F.when(F.col("is_heuristic"), F.lit("ast/no-struct-tree"))
    return docs.withColumn("reason", reason).withColumn(
        "status", F.when(F.col("reason").isNull(), F.lit("ok")).otherwise(F.lit("rejected")))

