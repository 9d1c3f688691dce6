"""Corpus builders shared by the registered queries.

Each helper reads the driver tables of ``sf_dir`` and returns a ``Built``
(nodes, docs) or a page table; parameters are fixed here so the Spark query
and its SQL oracle describe the same computation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire.operators.heuristic import heuristic_nodes_long, heuristic_nodes_wide
from quire.operators.nodes import Built
from quire.sources.corpus import conversation_pages, documents_wide, load_table

# Test texts hold single newlines only, so paragraphs split on "\n".
PARA_DELIM = "\n"
# Pagination of the `documents` corpus for the multi-page node query.
DOC_LINES_PER_PAGE = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load_table(spark, sf_dir, name)


def conv_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_pages(table(spark, sf_dir, "conversations"))


def conv_built(spark: SparkSession, sf_dir: str, start: int | None = None, end: int | None = None) -> Built:
    return heuristic_nodes_long(conv_pages(spark, sf_dir), PARA_DELIM, start, end)


def docs_wide(spark: SparkSession, sf_dir: str, lines_per_page: int | None = None, partition_by_doc: bool = False) -> DataFrame:
    return documents_wide(table(spark, sf_dir, "documents"), lines_per_page, partition_by_doc)


def docs_built(spark: SparkSession, sf_dir: str, lines_per_page: int | None = None) -> Built:
    return heuristic_nodes_wide(docs_wide(spark, sf_dir, lines_per_page), PARA_DELIM)


NODE_OUT = ["doc_id", "node_id", "parent_id", "pre", "last", "depth", "child_pos", "node_type",
            "page_index", "text_content", "level", "struct_type", "heuristic", "mcid", "children_count"]


def node_rows(nodes: DataFrame) -> DataFrame:
    """Flat projection of ``nodes`` used as query output (bbox is always null)."""
    return nodes.select(*NODE_OUT)


def html_built(spark: SparkSession, sf_dir: str) -> Built:
    from quire.operators.tagged import html_nodes
    return html_nodes(table(spark, sf_dir, "pages"))


def tables_built(spark: SparkSession, sf_dir: str) -> Built:
    from quire.operators.tables import table_nodes
    return table_nodes(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"))


# Redaction patterns of the test queries (e-mail addresses,
# 16-digit numbers, IPv4 addresses, and one literal).
REDACT_PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    r"\d{16}",
    r"\d{1,3}(?:\.\d{1,3}){3}",
    r"\Qtoken =\E",
]


def redacted_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents corpus after redaction (one page per document)."""
    from pyspark.sql import functions as F
    from quire.operators.docops import redact_text
    text, _ = redact_text("source", REDACT_PATTERNS)
    return docs_wide(spark, sf_dir).select("doc_id", text.alias("source")).withColumn("pages", F.array("source"))


def conv_sides(spark: SparkSession, sf_dir: str):
    """Conversation pairs (2k, 2k+1): every conversation is used, the even one as
    the original (side 0) and the odd one as the modified version (side 1) of
    pair k.  Returns (nodes with pair and side, pairs with page counts)."""
    from pyspark.sql import functions as F
    b = conv_built(spark, sf_dir)
    side = F.pmod(F.col("doc_id"), F.lit(2))
    nodes = b.nodes.withColumn("pair", F.floor(F.col("doc_id") / 2)).withColumn("side", side)
    docs = b.docs.withColumn("pair", F.floor(F.col("doc_id") / 2)).withColumn("side", side)
    a = docs.filter(F.col("side") == 0).select("pair", F.col("page_count").alias("original_page_count"))
    m = docs.filter(F.col("side") == 1).select("pair", F.col("page_count").alias("modified_page_count"))
    pairs = a.join(m, "pair", "full_outer").select(
        "pair", F.coalesce("original_page_count", F.lit(0)).alias("original_page_count"),
        F.coalesce("modified_page_count", F.lit(0)).alias("modified_page_count"))
    return nodes, pairs


def order_elements(spark: SparkSession, sf_dir: str):
    """Structure elements derived from orders and lines, in no particular row order.

    An order is a ``/Document`` root (every seventh: two ``/Sect`` roots
    instead) whose kids are its lines, tagged in turn ``/H2 /P /Span /Note
    /LI`` (``/Note`` is in no map); a line holds one ``/P`` leaf with its ship
    mode flags as text, a marked-content id that is no integer for every third
    line, and a page reference of which the fourth is unknown.  In two-root
    orders odd lines hang under the first root, even ones under the second.
    Returns (elements, docs, page_refs, pages).
    """
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from quire.functions.text import source_hash_of_text
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"))
    w = Window.partitionBy("doc_id").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), "l_linenumber", "l_partkey", "l_suppkey",
                                                 "l_returnflag", "l_linestatus").withColumn("r", F.row_number().over(w))
    none, two = F.lit(None), F.col("doc_id") % 7 == 0
    tags = F.array(*[F.lit(t) for t in ("/H2", "/P", "/Span", "/Note", "/LI")])
    ref = F.pmod("l_partkey", F.lit(4)).cast("bigint")
    cols = ["doc_id", "elem_id", "parent_elem", "kid_pos", "tag", "page_ref", "kid", "text"]
    roots = o.select("doc_id", F.explode(F.when(two, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("k")).select(
        "doc_id", F.col("k").cast("bigint").alias("elem_id"), none.cast("bigint").alias("parent_elem"), F.col("k").alias("kid_pos"),
        F.when(two, "/Sect").otherwise("/Document").alias("tag"), none.cast("bigint").alias("page_ref"),
        none.cast("string").alias("kid"), none.cast("string").alias("text"))
    line_id = (F.col("r") * 2).cast("bigint")
    line = F.struct(line_id.alias("elem_id"), F.when(two, (F.col("r") - 1) % 2).otherwise(0).cast("bigint").alias("parent_elem"),
                    F.col("r").alias("kid_pos"), F.element_at(tags, (F.col("r") % 5 + 1).cast("int")).alias("tag"),
                    ref.alias("page_ref"), none.cast("string").alias("kid"), none.cast("string").alias("text"))
    leaf = F.struct((line_id + 1).alias("elem_id"), line_id.alias("parent_elem"), F.lit(0).alias("kid_pos"), F.lit("/P").alias("tag"),
                    ref.alias("page_ref"), F.when(F.col("r") % 3 == 0, F.concat(F.lit("m"), F.col("r"))).otherwise(F.col("r").cast("string")).alias("kid"),
                    F.concat(F.lit("  "), "l_returnflag", F.lit(" "), "l_linestatus", F.lit("\t")).alias("text"))
    elements = roots.select(*cols).unionByName(li.select("doc_id", F.inline(F.array(line, leaf))))
    docs = o.select("doc_id", source_hash_of_text(F.concat(F.lit("order:"), F.col("doc_id").cast("string"))).alias("source_hash"),
                    F.lit(3).alias("page_count"))
    refs = o.select("doc_id", F.explode(F.array(*[F.lit(k) for k in range(3)])).alias("k")).select(
        "doc_id", F.col("k").cast("bigint").alias("page_ref"), (2 - F.col("k")).alias("page_index"))
    pages = refs.select("doc_id", "page_index", F.concat(F.lit(" page "), F.col("page_index").cast("string"), F.lit(" of "),
                                                         F.col("doc_id").cast("string")).alias("page_text"))
    return elements, docs, refs, pages


def paged_table_elements(spark: SparkSession, sf_dir: str):
    """Structure elements of orders whose every line is a table of its own, two lines a page.

    An order is a ``/Document`` whose kids are ``/Table > /TR > /TD, /TD`` (line number, part), each with its
    page reference; an order without lines has one page.  Returns (elements, docs, page_refs).
    """
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from quire.functions.text import source_hash_of_text
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("bigint").alias("doc_id"))
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("bigint").alias("doc_id"), "l_linenumber", "l_partkey",
                                                 (F.row_number().over(w) - 1).alias("r"))
    first, ref = (F.col("r") * 4 + 1).cast("bigint"), F.floor(F.col("r") / 2)

    def element(elem, parent, pos, tag, text=None):
        return F.struct(elem.alias("elem_id"), parent.alias("parent_elem"), pos.cast("int").alias("kid_pos"), F.lit(tag).alias("tag"), ref.alias("page_ref"),
                        F.lit(None).cast("string").alias("kid"), (F.lit(None) if text is None else F.col(text)).cast("string").alias("text"))

    zero = F.lit(0).cast("bigint")
    lines = li.select("doc_id", F.inline(F.array(
        element(first, zero, F.col("r"), "/Table"), element(first + 1, first, F.lit(0), "/TR"),
        element(first + 2, first + 1, F.lit(0), "/TD", "l_linenumber"), element(first + 3, first + 1, F.lit(1), "/TD", "l_partkey"))))
    none = F.lit(None)
    roots = o.select("doc_id", zero.alias("elem_id"), none.cast("bigint").alias("parent_elem"), F.lit(0).alias("kid_pos"), F.lit("/Document").alias("tag"),
                     none.cast("bigint").alias("page_ref"), none.cast("string").alias("kid"), none.cast("string").alias("text"))
    counts = li.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    docs = o.join(counts, "doc_id", "left").select(
        "doc_id", source_hash_of_text(F.concat(F.lit("order:"), F.col("doc_id").cast("string"))).alias("source_hash"),
        F.greatest(F.lit(1), F.ceil(F.coalesce("n", F.lit(0)) / 2)).cast("int").alias("page_count"))
    refs = counts.select("doc_id", F.explode(F.sequence(zero, F.floor((F.col("n") - 1) / 2))).alias("page_ref"))
    return roots.unionByName(lines), docs, refs.withColumn("page_index", F.col("page_ref").cast("int"))
