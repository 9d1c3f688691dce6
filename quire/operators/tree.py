"""Hierarchical lookups over ``nodes`` (survey §2.F) and the nested JSON form
of the tree (A11, A12).

Subtree and ancestor queries are range conditions on preorder numbers
(``a.pre <= d.pre <= a.last``).  Joined on ``doc_id`` alone, a large document
would compare every key with every node of it.  Instead both sides carry a
*bucket* ``pre // B``: a key's interval is spread over the buckets it covers
and the join is an equi-join on ``(doc_id, bucket)`` with the range as a
residual filter.  Exact, and the work per key is its result size plus at most
two partial buckets.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.schemas import NODES

DEFAULT_BUCKET = 1024


def get_node(nodes: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``keys(doc_id, node_id)`` -> (found nodes, missing keys).

    The first node in preorder wins when ids repeat inside a document.
    """
    looked = lookup_nodes(nodes, keys)
    found = looked.filter("found").drop("found", "error")
    return found, looked.filter("NOT found").select("doc_id", "node_id", "error")


# Fixed value: the message for an unknown node id.
NOT_FOUND = "Node not found: "


def lookup_nodes(nodes: DataFrame, keys: DataFrame) -> DataFrame:
    """F1 in one pass: every distinct key with ``found``, the node's columns
    (null if missing) and ``error``.  One left join, then the first node in
    preorder per key."""
    k = keys.select("doc_id", "node_id").distinct()
    rest = [c for c in nodes.columns if c not in ("doc_id", "node_id")]
    hits = k.join(nodes.select("doc_id", "node_id", F.struct(*rest).alias("n")), ["doc_id", "node_id"], "left")
    one = hits.groupBy("doc_id", "node_id").agg(F.min_by("n", F.col("n.pre")).alias("n"))
    found = F.col("n").isNotNull()
    return one.select("doc_id", "node_id", found.alias("found"), "n.*",
                      F.when(~found, F.concat(F.lit(NOT_FOUND), F.col("node_id"))).alias("error"))


def _key_intervals(nodes: DataFrame, keys) -> DataFrame:
    """Key nodes with their intervals.  ``keys`` is either a ``(doc_id,
    node_id)`` DataFrame (semi-joined) or a boolean Column over ``nodes`` (a
    plain filter: no join, no exchange)."""
    cols = ["doc_id", F.col("node_id").alias("key_id"), F.col("pre").alias("key_pre"),
            F.col("last").alias("key_last"), F.col("depth").alias("key_depth")]
    if isinstance(keys, Column):
        return nodes.filter(keys).select(*cols)
    k = keys.select("doc_id", F.col("node_id").alias("key_id")).distinct()
    return nodes.select(*cols).join(k, ["doc_id", "key_id"], "left_semi")


def subtree(nodes: DataFrame, keys, bucket: int = DEFAULT_BUCKET) -> DataFrame:
    """every key node with all its descendants.

    Output: ``key_id`` plus the node columns and ``rel_depth`` (0 for the key).
    """
    b = int(bucket)
    k = _key_intervals(nodes, keys).withColumn(
        "bucket", F.explode(F.sequence(F.floor(F.col("key_pre") / b), F.floor(F.col("key_last") / b))))
    n = nodes.withColumn("bucket", F.floor(F.col("pre") / b))
    j = k.join(n, ["doc_id", "bucket"]).filter(F.col("pre").between(F.col("key_pre"), F.col("key_last")))
    return j.withColumn("rel_depth", F.col("depth") - F.col("key_depth")).drop(
        "bucket", "key_pre", "key_last", "key_depth")


def ancestors(nodes: DataFrame, keys, bucket: int = DEFAULT_BUCKET) -> DataFrame:
    """the path from each key node to the root (the key excluded).

    Output: ``doc_id, key_id, node_id, node_type, depth, pre, distance``.
    """
    b = int(bucket)
    k = _key_intervals(nodes, keys).withColumn("bucket", F.floor(F.col("key_pre") / b))
    spans = nodes.select("doc_id", "node_id", "node_type", "depth", "pre", "last").withColumn(
        "bucket", F.explode(F.sequence(F.floor(F.col("pre") / b), F.floor(F.col("last") / b))))
    j = k.join(spans, ["doc_id", "bucket"]).filter(
        (F.col("pre") < F.col("key_pre")) & (F.col("last") >= F.col("key_pre")))
    return j.select("doc_id", "key_id", "node_id", "node_type", "depth", "pre",
                    (F.col("key_depth") - F.col("depth")).alias("distance"))


# -- A11/A12: nested JSON -----------------------------------------------------------

def nodes_to_json(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """One nested JSON document ``(doc_id, json)`` per document, in one ordered pass.

    In preorder a node opens its own object and its ``children`` list; after a
    node as many levels close as the depth falls to the next node.  So the
    document is its nodes' pieces joined in order.  A document's JSON is one
    row: the builders' admission gate bounds it.
    """
    after = F.lead("depth").over(Window.partitionBy("doc_id").orderBy("pre"))
    plain = F.to_json(F.struct(F.col("node_id").alias("id"), F.col("node_type").alias("type"), "page_index", "bbox", "text_content",
                               F.lit(None).cast("int").alias("pdf_object_number"), "mcid"), {"ignoreNullFields": "false"})
    attributes = F.to_json(F.struct("level", "struct_type", F.when(F.col("heuristic"), True).alias("heuristic")))
    opened = nodes.select("doc_id", "pre", plain.alias("own"), attributes.alias("attributes"), "child_pos", "depth", after.alias("after"))
    closing = F.when(F.col("after").isNull(), F.col("depth") + 1).otherwise(F.col("depth") - F.col("after") + 1)
    piece = F.concat(F.when((F.col("child_pos") > 0) & (F.col("depth") > 0), ",").otherwise(""),
                     F.expr("substring(own, 1, length(own) - 1)"), F.lit(',"attributes":'), "attributes", F.lit(',"children":['),
                     F.expr("repeat(']}', k)"))
    pieces = opened.withColumn("k", closing).select("doc_id", F.struct("pre", piece.alias("piece")).alias("p"))
    root = pieces.groupBy("doc_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("p")), lambda x: x["piece"]), "").alias("root"))
    header = F.to_json(F.struct(F.col("schema_version").alias("schemaVersion"), F.col("source_hash").alias("sourceHash"),
                                F.col("page_count").alias("pageCount")))
    return docs.join(root, "doc_id").withColumn("_h", header).select(
        "doc_id", F.concat(F.expr("substring(_h, 1, length(_h) - 1)"), F.lit(',"root":'), "root", F.lit("}")).alias("json"))


class Parsed(NamedTuple):
    """Result of ``nodes_from_json``: flat nodes, headers, and documents that are no valid tree."""

    nodes: DataFrame
    docs: DataFrame
    rejected: DataFrame


_NODE_TYPES = T.StructType([f for f in NODES.fields if f.name != "doc_id"])
_HEADER = T.StructType([T.StructField("schema_version", T.StringType()), T.StructField("source_hash", T.StringType()),
                        T.StructField("page_count", T.IntegerType()), T.StructField("reason", T.StringType())])
# JSON documents of an Arrow batch, and nodes of one that goes back.
_DOCS_A_BATCH, _NODES_A_BATCH = 1000, 10_000


def _parse_trees(docs_json: DataFrame, with_nodes: bool) -> DataFrame:
    """The numbered nodes of JSON documents, or their headers with ``reason``.

    Trees nest without limit, which no fixed schema expresses, so this is an Arrow function: one
    pass over the text and one over the tree, both without recursion.  Documents are
    parsed one at a time and leave in batches of nodes, so that a task holds one tree.
    """
    conf, limit = docs_json.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(conf.get(limit))
    if now <= 0 or now > _DOCS_A_BATCH:
        conf.set(limit, _DOCS_A_BATCH)
    most = _NODES_A_BATCH
    names = [f.name for f in _NODE_TYPES.fields]

    def parse_all(batches):
        # Nested, so that executors get it by value and need no package.
        import json
        import re
        from json.decoder import scanstring

        import pyarrow as pa

        blank = re.compile(r"[ \t\n\r]*").match
        scalar = re.compile(r"true|false|null|-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?").match

        def refuse(_):
            raise ValueError("no JSON")

        def name(s, i):
            if s[i:i + 1] != '"':
                raise ValueError("no name")
            key, i = scanstring(s, i + 1, True)
            i = blank(s, i).end()
            if s[i:i + 1] != ":":
                raise ValueError("no value")
            return key, blank(s, i + 1).end()

        def parse_deep(s):
            """JSON of any depth, with a stack of open containers."""
            i, open_ = blank(s, 0).end(), []
            while True:
                c = s[i:i + 1]
                if c in ("{", "["):
                    box = {} if c == "{" else []
                    i = blank(s, i + 1).end()
                    if s[i:i + 1] != ("}" if c == "{" else "]"):
                        key = None
                        if c == "{":
                            key, i = name(s, i)
                        open_.append((box, key))
                        continue
                    value, i = box, i + 1
                elif c == '"':
                    value, i = scanstring(s, i + 1, True)
                else:
                    m = scalar(s, i)
                    if not m:
                        raise ValueError("no value")
                    value, i = json.loads(m.group()), m.end()
                while True:
                    i = blank(s, i).end()
                    if not open_:
                        if i != len(s):
                            raise ValueError("more text")
                        return value
                    box, key = open_[-1]
                    is_list = isinstance(box, list)
                    if is_list:
                        box.append(value)
                    else:
                        box[key] = value
                    c = s[i:i + 1]
                    if c == ",":
                        i = blank(s, i + 1).end()
                        if not is_list:
                            key, i = name(s, i)
                            open_[-1] = (box, key)
                        break
                    if c != ("]" if is_list else "}"):
                        raise ValueError("no end")
                    value, i = box, i + 1
                    open_.pop()

        def text(v):
            return v if v is None or isinstance(v, str) else None if isinstance(v, (dict, list)) else json.dumps(v)

        def whole(v):
            if isinstance(v, str):
                v = int(v) if re.fullmatch(r"\s*[+-]?[0-9]{1,11}\s*", v) else None
            if isinstance(v, bool) or not isinstance(v, (int, float)) or v != v or abs(v) >= 2 ** 31:
                return None
            return int(v) if v == int(v) else None

        def box_of(v):
            sides = [v.get(k) for k in ("x", "y", "width", "height")] if isinstance(v, dict) else []
            if not sides or any(isinstance(x, bool) or not isinstance(x, (int, float)) for x in sides):
                return None
            return dict(zip(("x", "y", "width", "height"), map(float, sides)))

        def first(d, *keys):
            return next((d[k] for k in keys if d.get(k) is not None), None)

        def rows_of(root):
            rows, todo = [], [(root, None, 0, 0)]
            while todo:
                n, parent, depth, at = todo.pop()
                n = n if isinstance(n, dict) else {}
                extra = n.get("attributes") if isinstance(n.get("attributes"), dict) else {}
                kids = n.get("children") if isinstance(n.get("children"), list) else []
                pre = len(rows)
                flag = extra.get("heuristic")
                rows.append({"node_id": text(n.get("id")), "parent_id": rows[parent]["node_id"] if parent is not None else None, "parent_pre": parent,
                             "pre": pre, "last": pre, "depth": depth, "child_pos": at, "node_type": text(n.get("type")),
                             "page_index": whole(n.get("page_index")), "text_content": text(n.get("text_content")), "level": whole(extra.get("level")),
                             "struct_type": text(extra.get("struct_type")), "heuristic": flag is True or flag == "true", "mcid": whole(n.get("mcid")),
                             "bbox": box_of(n.get("bbox")), "children_count": len(kids)})
                todo.extend((kid, pre, depth + 1, k) for k, kid in reversed(list(enumerate(kids))))
            for r in reversed(rows):
                if r["parent_pre"] is not None:
                    up = rows[r["parent_pre"]]
                    up["last"] = max(up["last"], r["last"])
            return rows

        def parse(s):
            out = {"schema_version": None, "source_hash": None, "page_count": None, "reason": "json"}
            if s is None:
                return out, []
            try:
                try:
                    doc = json.loads(s, parse_constant=refuse)
                except RecursionError:
                    doc = parse_deep(s)
            except ValueError:
                return out, []
            doc = doc if isinstance(doc, dict) else {}
            out["schema_version"] = text(first(doc, "schemaVersion", "schema_version"))
            out["source_hash"] = text(first(doc, "sourceHash", "source_hash"))
            out["page_count"] = whole(first(doc, "pageCount", "page_count"))
            nodes = rows_of(doc.get("root"))
            if None in (out["schema_version"], out["source_hash"], out["page_count"]):
                out["reason"] = "header"
            elif any(None in (r["node_id"], r["node_type"], r["page_index"]) for r in nodes):
                out["reason"] = "node"
            else:
                out["reason"] = None
            return out, [] if out["reason"] else nodes

        ints = {"parent_pre", "pre", "last", "depth", "child_pos", "page_index", "level", "mcid", "children_count"}
        box = pa.struct([(k, pa.float64()) for k in ("x", "y", "width", "height")])
        kinds = {k: pa.int32() if k in ints else pa.bool_() if k == "heuristic" else box if k == "bbox" else pa.string() for k in names}
        header = {"schema_version": pa.string(), "source_hash": pa.string(), "page_count": pa.int32(), "reason": pa.string()}
        columns = kinds if with_nodes else header

        def batch_of(ids, rows):
            return pa.RecordBatch.from_arrays([ids, *(pa.array([r[k] for r in rows], kind) for k, kind in columns.items())], ["doc_id", *columns])

        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            at, rows = [], []
            for i in range(len(texts)):
                out, nodes = parse(texts[i].as_py())
                found = nodes if with_nodes else [out]
                for k in range(0, len(found), most):
                    rows += found[k:k + most]
                    at += [i] * (len(rows) - len(at))
                    if len(rows) >= most:
                        yield batch_of(ids.take(pa.array(at)), rows)
                        at, rows = [], []
            if rows:
                yield batch_of(ids.take(pa.array(at)), rows)

    fields = _NODE_TYPES.fields if with_nodes else _HEADER.fields
    schema = T.StructType([T.StructField("doc_id", docs_json.schema["doc_id"].dataType), *(T.StructField(f.name, f.dataType) for f in fields)])
    return docs_json.select("doc_id", "json").mapInArrow(parse_all, schema)


def nodes_from_json(docs_json: DataFrame) -> Parsed:
    """Nested JSON documents -> node rows with all numbering, headers and rejected documents.

    The header is read by alias or field name.  ``pre``, ``last``, ``depth``, ``child_pos``,
    ``children_count`` and the parent links follow from the nesting, in one pass per
    document and in one scan of ``docs_json`` per result, however deep the trees are.  A
    document that does not parse, lacks a header field, or has a node without id, type or
    page index is rejected as a whole, with its ``reason``; of repeated names in one JSON
    object the last counts.
    """
    header, good = _parse_trees(docs_json, False), F.col("reason").isNull()
    return Parsed(_parse_trees(docs_json, True), header.filter(good).drop("reason"), header.filter(~good).select("doc_id", "reason"))
