"""Explicit schemas of the tables the operators exchange."""

from __future__ import annotations

from pyspark.sql import types as T

BBOX = T.StructType([
    T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType()),
    T.StructField("width", T.DoubleType()), T.StructField("height", T.DoubleType()),
])

# One row per AST node.  (doc_id, node_id) is the key: node ids repeat across
# documents whose first 4 KB are equal.  `pre` is the preorder rank (the order
# every query emits in), `last` the largest `pre` in the subtree, so
# "d is in the subtree of a" is `a.pre <= d.pre <= a.last`.  `parent_pre` is the
# parent's `pre` (null at a root), so operators meet parents by position.
NODES = T.StructType([
    T.StructField("doc_id", T.LongType(), False),
    T.StructField("node_id", T.StringType(), False),
    T.StructField("parent_id", T.StringType(), True),
    T.StructField("parent_pre", T.IntegerType(), True),
    T.StructField("pre", T.IntegerType(), False),
    T.StructField("last", T.IntegerType(), False),
    T.StructField("depth", T.IntegerType(), False),
    T.StructField("child_pos", T.IntegerType(), False),
    T.StructField("node_type", T.StringType(), False),
    T.StructField("page_index", T.IntegerType(), False),
    T.StructField("text_content", T.StringType(), True),
    T.StructField("level", T.IntegerType(), True),
    T.StructField("struct_type", T.StringType(), True),
    T.StructField("heuristic", T.BooleanType(), False),
    T.StructField("mcid", T.IntegerType(), True),
    T.StructField("bbox", BBOX, True),
    T.StructField("children_count", T.IntegerType(), False),
])

NODE_COLUMNS = [f.name for f in NODES.fields]

# One row per document.
DOCS = T.StructType([
    T.StructField("doc_id", T.LongType(), False),
    T.StructField("schema_version", T.StringType(), False),
    T.StructField("source_hash", T.StringType(), False),
    T.StructField("page_count", T.IntegerType(), False),
    T.StructField("is_heuristic", T.BooleanType(), False),
])

PAGES = T.StructType([
    T.StructField("doc_id", T.LongType(), False),
    T.StructField("page_index", T.IntegerType(), False),
    T.StructField("page_text", T.StringType(), True),
])

# Structure elements of tagged documents, the input of the generic tree walk.
ELEMENTS = T.StructType([
    T.StructField("doc_id", T.LongType(), False),
    T.StructField("elem_id", T.LongType(), False),
    T.StructField("parent_elem", T.LongType(), True),
    T.StructField("kid_pos", T.IntegerType(), False),
    T.StructField("tag", T.StringType(), True),
    T.StructField("page_ref", T.LongType(), True),
    T.StructField("kid", T.StringType(), True),
    T.StructField("text", T.StringType(), True),
])

PAGE_REFS = T.StructType([
    T.StructField("doc_id", T.LongType(), False),
    T.StructField("page_ref", T.LongType(), False),
    T.StructField("page_index", T.IntegerType(), False),
])
