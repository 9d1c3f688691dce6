"""Tables (survey §2.E): relational rows as table nodes, and cited tables.

A table's rows are its **direct** ``table_row`` children in preorder, a row's
cells its **direct** ``table_cell`` children; other children are ignored (so
rows under ``/THead`` or ``/TBody`` artifacts are not counted).  Rows and cells
are numbered from 0; spans are 1; cell confidence is 1.0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.text import SCHEMA_VERSION, node_id, source_hash_of_text
from quire.operators.cited import page_between
from quire.operators.nodes import Built
from quire.schemas import BBOX

# Columns of `lineitem` shown as cells of an order's table, in order.
LINE_COLUMNS = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
                "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
# Row order inside an order: (l_orderkey, l_linenumber) alone is not unique.
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey"]


# Nodes of one task: what is sorted by its documents later stays in memory.
NODES_A_TASK = 500_000


def _cell_text(kind: T.DataType, c: str) -> Column:
    """A column's values as cell text, by its type: times to the second, all else as Spark casts it."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(c)
    return F.col(c).cast("string")


def frame_tables(rows: DataFrame, key: str, order: list[str], columns: list[str] | None = None, header: bool = False,
                 parents: DataFrame | None = None, source: str = "table:") -> Built:
    """E5: the rows of any frame as tagged tables, one document per ``key``.

    A document is ``/Document > /Table > /TR* > /TD*``; with ``header`` its first row
    is ``/TR > /TH*`` with the column names.  ``columns`` (default: all but ``key``, in
    schema order) are the cells, their text follows from their types; null values are
    cells without text.  Rows follow ``order``, nulls first; those with a null key
    belong to no document.  ``parents`` (its first column holds the keys) adds
    documents without rows.  The source of a document is ``source`` and its key.

    The single ``/Document`` element is the root (no wrapper), so sequence
    numbers equal preorder ranks: document 0, table 1, row r at
    ``2 + r*(C+1)``, its cell c at ``3 + r*(C+1) + c``.

    Rows travel as they are and become text behind the exchange.  It has a task per
    ``NODES_A_TASK`` nodes (rows are counted first), as a narrow row makes many wide nodes.

    One exchange on the key; the row-number window and the row count run on that
    partitioning, and the document and table nodes are emitted by the document's first
    row.  The nodes come out hash-partitioned by doc_id.  Rows whose key is in no
    parent make documents too.
    """
    names = columns if columns is not None else [c for c in rows.columns if c != key]
    ncol, head = len(names), 1 if header else 0
    kinds = [rows.schema[c].dataType for c in names]
    cells, places = [f"c{k}" for k in range(ncol)], [f"o{k}" for k in range(len(order))]
    li = rows.select(F.col(key).cast("bigint").alias("doc_id"), *(F.col(c).alias(x) for c, x in zip(names, cells)),
                     *(F.col(c).alias(x) for c, x in zip(order, places)), F.lit(True).alias("is_row")).filter(F.col("doc_id").isNotNull())
    j, keys = li, li.select("doc_id")
    n_nodes = rows.count() * (ncol + 1)
    if parents is not None:
        # Parents join the rows as markers behind them: no join, and repeated ones do no harm.
        keys = parents.select(F.col(parents.columns[0]).cast("bigint").alias("doc_id")).filter("doc_id IS NOT NULL")
        j = li.unionByName(keys, allowMissingColumns=True)
        n_nodes += parents.count() * (2 + head * (ncol + 1))
    if n_nodes > NODES_A_TASK * rows.sparkSession.sparkContext.defaultParallelism:
        j = j.repartition(-(-n_nodes // NODES_A_TASK), "doc_id")
    w = Window.partitionBy("doc_id")
    j = j.withColumn("r", F.row_number().over(w.orderBy(F.col("is_row").asc_nulls_last(), *places)) - 1).withColumn(
        "n_rows", F.count("is_row").over(w).cast("int"))
    if parents is not None:
        j = j.filter(F.col("is_row") | (F.col("r") == 0))
    hashed = source_hash_of_text(F.concat(F.lit(source), F.col("doc_id").cast("string")))
    x = j.select("doc_id", "r", "is_row", (F.col("n_rows") + head).alias("total"), *cells,
                 node_id(hashed, F.lit(0), F.lit("")).alias("prefix"))

    # A row generates narrow entries; the nodes' columns are plain expressions over
    # them, compiled into the stage (arrays of whole node structs would be built by
    # interpreted lambdas).
    def entry(depth, at=0, c=0, text=None, tag=None):
        return F.struct(F.lit(depth).alias("depth"), (at if isinstance(at, Column) else F.lit(at)).cast("int").alias("at"),
                        (c if isinstance(c, Column) else F.lit(c)).cast("int").alias("c"),
                        (text if isinstance(text, Column) else F.lit(text)).cast("string").alias("text"), F.lit(tag).alias("tag"))

    top = [entry(0, tag="/Document"), entry(1, tag="/Table")]
    if header:
        top += [entry(2, tag="/TR"), *(entry(3, 0, k, c, "/TH") for k, c in enumerate(names))]
    at = F.col("r") + head
    own = F.array(entry(2, at, tag="/TR"), *(entry(3, at, k, _cell_text(kind, x), "/TD") for k, (kind, x) in enumerate(zip(kinds, cells))))
    none = F.array().cast("array<struct<depth: int, at: int, c: int, text: string, tag: string>>")
    entries = F.concat(F.when(F.col("r") == 0, F.array(*top)).otherwise(none), F.when(F.col("is_row"), own).otherwise(none))
    x = x.select("doc_id", "prefix", "total", F.inline_outer(entries))
    depth, c, row_pre = F.col("depth"), F.col("c"), F.col("at") * (ncol + 1) + 2

    def by_depth(*values):
        out = F.when(depth == 0, values[0])
        for k, v in enumerate(values[1:], 1):
            out = out.when(depth == k, v)
        return out.cast("int")

    end = F.col("total") * (ncol + 1) + 1
    x = x.select("*", by_depth(F.lit(0), F.lit(1), row_pre, row_pre + 1 + c).alias("pre"), by_depth(F.lit(None), F.lit(0), F.lit(1), row_pre).alias("parent_pre"))
    nodes = x.select(
        "doc_id", F.concat("prefix", F.col("pre").cast("string")).alias("node_id"), F.concat("prefix", F.col("parent_pre").cast("string")).alias("parent_id"),
        "parent_pre", "pre", by_depth(end, end, row_pre + ncol, F.col("pre")).alias("last"), "depth",
        by_depth(F.lit(0), F.lit(0), F.col("at"), c).alias("child_pos"),
        F.when(depth == 0, "document").when(depth == 1, "table").when(depth == 2, "table_row").otherwise("table_cell").alias("node_type"),
        F.lit(0).alias("page_index"), F.col("text").alias("text_content"), F.lit(None).cast("int").alias("level"), F.col("tag").alias("struct_type"),
        F.lit(False).alias("heuristic"), F.lit(None).cast("int").alias("mcid"), F.lit(None).cast(BBOX).alias("bbox"),
        by_depth(F.lit(1), F.col("total"), F.lit(ncol), F.lit(0)).alias("children_count"))
    # The document table depends on the keys only, not on another pass over the joined rows.
    docs = keys.distinct().select("doc_id", F.lit(SCHEMA_VERSION).alias("schema_version"), hashed.alias("source_hash"),
                      F.lit(1).alias("page_count"), F.lit(False).alias("is_heuristic"))
    return Built(nodes, docs)


def table_nodes(orders: DataFrame, lineitem: DataFrame) -> Built:
    """E5 over orders: an order is a document, its lines are the rows (orders without
    lines give empty tables); prices show two decimals."""
    priced = lineitem.withColumn("l_extendedprice", F.col("l_extendedprice").cast("decimal(12,2)"))
    return frame_tables(priced, "l_orderkey", LINE_ORDER, LINE_COLUMNS, parents=orders.select("o_orderkey"), source="order:")


def _parts(nodes: DataFrame) -> DataFrame:
    """Tables, rows and cells with the position ``k`` of the row they make up: a row's
    own, a cell's parent's, and for a table one of its own below zero."""
    kind = F.col("node_type")
    x = nodes.filter(~F.col("heuristic") & kind.isin("table", "table_row", "table_cell"))
    k = F.when(kind == "table_cell", F.col("parent_pre")).when(kind == "table_row", F.col("pre")).otherwise(-1 - F.col("pre"))
    return x.withColumn("k", k)


def _page_range(rows: DataFrame, start: int | None, end: int | None, docs: DataFrame | None) -> DataFrame:
    """C6 over tables: pages ``start`` (default 0) to ``end`` (default: the document's last page).

    Without ``docs`` no page counts are known and a missing end is open.
    """
    if start is None and end is None:
        return rows
    if end is None and docs is not None:
        counts = docs.select("doc_id", F.col("page_count").alias("_pages"))
        joined = rows.join(counts, "doc_id").withColumnRenamed("table_page", "page_index")
        return joined.filter(page_between(start, None, F.col("_pages"))).withColumnRenamed("page_index", "table_page").drop("_pages")
    return rows.withColumnRenamed("table_page", "page_index").filter(page_between(start, end)).withColumnRenamed("page_index", "table_page")


def table_grid(nodes: DataFrame, page_start: int | None = None, page_end: int | None = None, docs: DataFrame | None = None) -> DataFrame:
    """E1 core: one row per table row (and one per table, ``row`` null), numbered, with
    its cells ``ARRAY<STRUCT<col, text>>`` in order.

    Output ``(doc_id, table_node_id, table_page, table_pre, table_ord, has_anchor, row,
    cells)``.  Rows and cells that are not direct children of a table / row are dropped
    (a ``/TBody`` in between hides its rows).

    Nodes carry their parent's position, so cells are grouped by the row they name
    (the one sort of all cells; a row's cells are bounded by its width), and only the
    rows, a tenth or less of the nodes, are numbered by a window over their table.  All
    keys start with doc_id: no exchange on nodes partitioned by it, and the node
    table is read once.
    """
    kind, pre = F.col("node_type"), F.col("pre")
    is_table, is_row = kind == "table", kind == "table_row"
    about = F.struct(F.col("node_id").alias("id"), F.col("page_index").alias("page"), F.coalesce(F.length("text_content") > 0, F.lit(False)).alias("anchor"))
    g = _parts(nodes).groupBy("doc_id", "k").agg(
        F.max(F.when(is_table, about)).alias("t"), F.max(F.when(is_table | is_row, pre)).alias("pre"),
        F.max(F.when(is_table, pre).when(is_row, F.col("parent_pre"))).alias("table_pre"),
        F.collect_list(F.when(kind == "table_cell", F.struct("pre", F.col("text_content").alias("text")))).alias("cells"))
    g = g.filter(F.col("table_pre").isNotNull())  # cells outside rows have none
    one = Window.partitionBy("doc_id", "table_pre").orderBy("pre")
    g = g.withColumn("t", F.first("t").over(one)).withColumn("row", F.when(F.col("k") >= 0, F.row_number().over(one) - 2))
    g = g.filter(F.col("t").isNotNull())          # rows outside tables
    g = g.withColumn("table_ord", F.dense_rank().over(Window.partitionBy("doc_id").orderBy("table_pre")) - 1)
    cells = F.transform(F.array_sort("cells"), lambda c, i: F.struct(i.alias("col"), c["text"].alias("text")))
    out = g.select("doc_id", F.col("t.id").alias("table_node_id"), F.col("t.page").alias("table_page"), "table_pre",
                   F.col("table_ord").cast("int").alias("table_ord"), F.col("t.anchor").alias("has_anchor"),
                   F.col("row").cast("int").alias("row"), cells.alias("cells"))
    return _page_range(out, page_start, page_end, docs)


def table_cells(nodes: DataFrame, page_start: int | None = None, page_end: int | None = None, docs: DataFrame | None = None) -> DataFrame:
    """One row per cell: row, col, spans, text, confidence."""
    g = table_grid(nodes, page_start, page_end, docs).filter(F.col("row").isNotNull())
    return g.select("doc_id", "table_node_id", "table_page", "table_pre", "row", F.inline_outer("cells")).filter(F.col("col").isNotNull()).select(
        "doc_id", "table_node_id", "table_page", "table_pre", "row", "col", F.lit(1).alias("row_span"), F.lit(1).alias("col_span"), "text",
        F.lit(1.0).alias("confidence"))


def cited_tables(nodes: DataFrame, page_start: int | None = None, page_end: int | None = None, docs: DataFrame | None = None) -> DataFrame:
    """E2 (flat): per table ``row_count`` (empty rows included), ``col_count``
    (widest row) and whether it carries an anchor (only tables with text).

    Two hash aggregates, cells per row and rows per table, and no sort of the nodes.
    """
    kind, pre = F.col("node_type"), F.col("pre")
    is_table, is_row = kind == "table", kind == "table_row"
    # The table's id is a grouping key (null on rows and cells): hash aggregates hold no strings.
    per_row = _parts(nodes).groupBy("doc_id", "k", F.when(is_table, F.col("node_id")).alias("id")).agg(
        F.count_if(kind == "table_cell").alias("n_cells"), F.max(F.when(is_table, pre).when(is_row, F.col("parent_pre"))).alias("table_pre"),
        F.max(F.when(is_table, F.col("page_index"))).alias("page"), F.max(F.when(is_table, F.length("text_content") > 0)).alias("anchor"))
    per_row = per_row.filter(F.col("table_pre").isNotNull())
    is_table = F.col("id").isNotNull()
    out = per_row.groupBy("doc_id", "table_pre").agg(
        F.max("id").alias("table_node_id"), F.max("page").alias("table_page"), F.count_if(~is_table).cast("int").alias("row_count"),
        F.coalesce(F.max(F.when(~is_table, F.col("n_cells"))), F.lit(0)).cast("int").alias("col_count"),
        F.coalesce(F.max("anchor"), F.lit(False)).alias("has_anchor")).filter(F.col("table_node_id").isNotNull())
    return _page_range(out, page_start, page_end, docs).select("doc_id", "table_node_id", "table_page", "row_count", "col_count", "has_anchor")


def cited_tables_nested(nodes: DataFrame, page_start: int | None = None, page_end: int | None = None, docs: DataFrame | None = None) -> DataFrame:
    """E2 (nested): ``rows ARRAY<ARRAY<STRUCT<row, col, row_span, col_span, text, bbox,
    confidence>>>``, counts and ``citation_anchor`` (a table without own text has none)."""
    g = table_grid(nodes, page_start, page_end, docs)
    no_box = F.lit(None).cast("struct<x:double,y:double,width:double,height:double>")
    r = g.select("doc_id", "table_node_id", "table_page", "row", "has_anchor",
                 F.transform("cells", lambda c: F.struct(
                     F.col("row").alias("row"), c["col"].alias("col"), F.lit(1).alias("row_span"), F.lit(1).alias("col_span"),
                     c["text"].alias("text"), no_box.alias("bbox"), F.lit(1.0).alias("confidence"))).alias("cells"))
    anchor = F.struct(F.col("table_node_id").alias("node_id"), F.col("table_page").alias("page_index"), F.lit(1.0).alias("confidence"))
    return r.groupBy("doc_id", "table_node_id", "table_page").agg(
        F.count("row").cast("int").alias("row_count"),
        F.coalesce(F.max(F.when(F.col("row").isNotNull(), F.size("cells"))), F.lit(0)).cast("int").alias("col_count"),
        F.transform(F.array_sort(F.collect_list(F.when(F.col("row").isNotNull(), F.struct("row", "cells")))),
                    lambda x: x["cells"]).alias("rows"), F.when(F.max("has_anchor"), F.first(anchor)).alias("citation_anchor"))


def table_summary(nodes: DataFrame | None, docs: DataFrame, per_document: int = 0) -> DataFrame:
    """``table_count`` and ``pages_processed`` per document (0 tables for
    documents without any, and always 0 for heuristic documents).

    Without ``nodes`` every document holds ``per_document`` tables, as the builder of a
    corpus knows (``frame_tables``: 1, heuristic documents: 0), and none is built to be
    counted.
    """
    if nodes is None:
        return docs.select("doc_id", F.lit(per_document).cast("bigint").alias("table_count"), F.col("page_count").alias("pages_processed"))
    t = nodes.filter((F.col("node_type") == "table") & ~F.col("heuristic")).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("table_count"))
    return docs.join(t, "doc_id", "left").select(
        "doc_id", F.coalesce("table_count", F.lit(0)).cast("bigint").alias("table_count"),
        F.col("page_count").alias("pages_processed"))
