"""Output formats (survey A6-A10): JSON, CSV tables, Markdown, plain text.

Each format is a column expression over rows that Spark writes with its own
writers; nothing is assembled on the driver.  Per-document strings are built
with an ordered ``collect_list`` over one document's rows, which the
admission gate bounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.text import csv_row, percent


def json_lines(df: DataFrame, col: str = "json") -> DataFrame:
    """One JSON object per row, nulls kept as ``null``, non-ASCII kept."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias(col))


def markdown_entries(blocks: DataFrame) -> DataFrame:
    """``[p{page}] ({type}) {text}  `` / ``  _cite: {id} conf={pct}_`` per block.

    Each entry ends with a newline; joining a document's entries in preorder
    with a newline gives the blank line between blocks.  The percentage rounds
    half to even, like Python's ``.0%``.
    """
    type_label = F.when(F.col("node_type").isNotNull(),
                        F.concat(F.lit(" ("), F.col("node_type"), F.lit(")"))).otherwise(F.lit(""))
    md = F.concat(F.lit("[p"), F.col("page_index").cast("string"), F.lit("]"), type_label, F.lit(" "),
                  F.col("text"), F.lit("  \n  _cite: "), F.col("node_id"), F.lit(" conf="),
                  percent("confidence"), F.lit("_\n"))
    return blocks.select("doc_id", "pre", md.alias("md"))


def _ordered_join(value: str, sep: str):
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pre", value))),
                                    lambda s: s[value]), sep)


def markdown_documents(blocks: DataFrame) -> DataFrame:
    """A8 per document: entries joined by newline in preorder."""
    return markdown_entries(blocks).groupBy("doc_id").agg(_ordered_join("md", "\n").alias("content"))


def plain_documents(blocks: DataFrame) -> DataFrame:
    """Block texts joined by newline in preorder, one row per document."""
    return blocks.groupBy("doc_id").agg(_ordered_join("text", "\n").alias("content"))


def csv_table_lines(grid: DataFrame) -> DataFrame:
    """CSV lines of every table from a table grid.

    The grid has one entry per table (``row`` null) and one per table row, so
    each grid row maps to exactly one output line in a single projection:
    line 0 is the ``# Table N (pM)`` title (``N`` = 1-based table number in the
    document; tables after the first start with a blank line), then one line
    per row, empty rows included.  Null cells print as empty fields.
    Concatenating a document's lines in ``(table_ord, line_no)`` order gives
    the CSV text.
    """
    title = F.concat(F.when(F.col("table_ord") > 0, F.lit("\n")).otherwise(F.lit("")), csv_row(F.array(
        F.concat(F.lit("# Table "), (F.col("table_ord") + 1).cast("string"), F.lit(" (p"),
                 F.col("table_page").cast("string"), F.lit(")")))))
    row_line = csv_row(F.transform("cells", lambda c: c["text"]))
    is_title = F.col("row").isNull()
    return grid.select("doc_id", "table_ord",
                       F.when(is_title, F.lit(0)).otherwise(F.col("row") + 1).cast("int").alias("line_no"),
                       F.when(is_title, title).otherwise(row_line).alias("line"))


def csv_documents(grid: DataFrame) -> DataFrame:
    """A7 per document: the whole CSV text (lines in table and row order)."""
    lines = csv_table_lines(grid)
    return lines.groupBy("doc_id").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("table_ord", "line_no", "line"))), lambda s: s["line"]), "").alias("csv"))


def write_text(df: DataFrame, path: str, col: str, mode: str = "errorifexists") -> None:
    """A10: one text value per row to files under ``path``."""
    df.select(F.col(col).alias("value")).write.mode(mode).text(path)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON lines under ``path``."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)
