"""Tagged documents -> nodes.

Two builders with the same output:

* ``html_nodes``: HTML pages, whose trees ``sources/html.py`` numbers inside the
  row (document order is preorder): no exchange.
* ``tagged_nodes``: any structure-element table (PDF-like ``/P``, ``/Table`` …)
  in any row order.  Documents meet their elements in one exchange, and tasks number
  them level by level, many documents at once; larger documents take a tour
  of the tree (pointer doubling) over all tasks.

Numbering (reference semantics): ids take a sequence number in preorder from
0, taken before children; when the tree has several top-level elements (or one
that is not a document) a wrapper document node is added with the *last*
sequence number but preorder rank 0.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.tags import HTML_HEADING_LEVEL, HTML_TAG_MAP, PDF_HEADING_LEVEL, PDF_TAG_MAP, heading_level, map_tag
from quire.functions.text import SCHEMA_VERSION, node_id, py_strip, source_hash_of_text
from quire.operators.nodes import Built, explode_nodes, node_struct
from quire.schemas import BBOX, NODE_COLUMNS
from quire.session import checkpoint_dir
from quire.sources.html import html_trees, unescape


def html_nodes(pages: DataFrame) -> Built:
    """HTML ``pages(page_id, url, html)`` -> tagged ``nodes`` and ``docs``.

    Every page is wrapped in a document node.  Null and empty pages are bare
    documents; repeated page ids give a tree each.
    """
    docs = pages.select(F.col("page_id").cast("bigint").alias("doc_id"), F.lit(SCHEMA_VERSION).alias("schema_version"),
                        source_hash_of_text("html").alias("source_hash"), F.lit(1).alias("page_count"), F.lit(False).alias("is_heuristic"))
    x = html_trees(pages).select("doc_id", "source_hash", F.size("tree").alias("n"), F.posexplode_outer("tree").alias("pre", "t"))
    x = x.select("doc_id", "source_hash", (F.col("n") - 1).alias("n"), "pre", "t.*")
    src, root = F.col("source_hash"), F.col("pre") == 0

    def nid(place):
        """The root has the last sequence number, the others count from 0."""
        return node_id(src, F.lit(0), F.when(place == 0, F.col("n")).otherwise(place - 1))

    no_box = F.lit(None).cast(BBOX)
    nodes = x.select(
        "doc_id", nid(F.col("pre")).alias("node_id"), F.when(~root, nid(F.col("parent"))).alias("parent_id"),
        F.when(~root, F.col("parent")).alias("parent_pre"), "pre", "last", "depth",
        "child_pos", F.when(root, F.lit("document")).otherwise(map_tag("tag", HTML_TAG_MAP)).alias("node_type"),
        F.lit(0).alias("page_index"),
        F.when((F.col("children_count") == 0) & ~root, F.nullif(py_strip(unescape("raw")), F.lit(""))).alias("text_content"),
        heading_level("tag", HTML_HEADING_LEVEL).alias("level"), F.col("tag").alias("struct_type"), F.lit(False).alias("heuristic"),
        F.lit(None).cast("int").alias("mcid"), no_box.alias("bbox"), "children_count")
    return Built(nodes, docs)


def _walk(el: DataFrame, least: int = 0) -> DataFrame:
    """(doc_id, elem_id, seq, last_seq, depth0) of the elements that a walk from the roots meets.

    A tour enters and leaves every element once: enter -> first kid, leave -> next
    sibling or the parent's leave.  Every event points to its successor, and pointer
    doubling sums what lies between it and the end of the tour: elements entered and
    levels gained.  That gives the preorder rank, the end of the subtree and the depth
    with a fixed row width, however deep the tree is, in log2 of the longest tour
    rounds (known beforehand), each written to the shared checkpoint folder.
    Elements that reach no root (a missing parent, a cycle) never reach the last
    root's end and drop out.  Siblings with equal ``kid_pos`` follow their ids.
    """
    checkpoint_dir(el.sparkSession)
    kids = Window.partitionBy("doc_id", "up").orderBy("kid_pos", "elem_id")
    x = el.select("doc_id", F.col("elem_id").cast("bigint").alias("elem_id"), F.col("parent_elem").cast("bigint").alias("up"), "kid_pos")
    x = x.select("doc_id", "elem_id", "up", F.lead("elem_id").over(kids).alias("right"),
                 (F.row_number().over(kids) == 1).alias("is_first")).checkpoint()
    first = x.filter("is_first AND up IS NOT NULL").select("doc_id", F.col("up").alias("elem_id"), F.col("elem_id").alias("kid"))
    x = x.join(first, ["doc_id", "elem_id"], "left")
    enter, leave = F.col("elem_id") * 2, F.col("elem_id") * 2 + 1
    after = F.coalesce(F.col("right") * 2, F.col("up") * 2 + 1)
    events = x.select("doc_id", F.inline(F.array(
        F.struct(enter.alias("event"), F.coalesce(F.col("kid") * 2, leave).alias("next"), F.lit(1).alias("entered"), F.lit(1).alias("gained")),
        F.struct(leave.alias("event"), after.alias("next"), F.lit(0).alias("entered"), F.lit(-1).alias("gained")))))
    state = events.withColumn("end", F.col("event")).checkpoint()
    longest = state.groupBy("doc_id").count().agg(F.max("count")).first()[0] or 0
    for _ in range(max(0, max(longest, least) - 1).bit_length()):
        ahead = state.select("doc_id", F.col("event").alias("next"), F.col("next").alias("next2"), F.col("entered").alias("e2"),
                             F.col("gained").alias("g2"), F.col("end").alias("end2"))
        state = state.join(ahead, ["doc_id", "next"], "left").select(
            "doc_id", "event", F.col("next2").alias("next"), (F.col("entered") + F.coalesce("e2", F.lit(0))).alias("entered"),
            (F.col("gained") + F.coalesce("g2", F.lit(0))).alias("gained"), F.coalesce("end2", "end").alias("end")).checkpoint()
    last_root = x.filter("up IS NULL AND right IS NULL").select("doc_id", leave.alias("end"))
    met = state.filter("next IS NULL").join(last_root, ["doc_id", "end"], "left_semi")
    both = met.groupBy("doc_id", F.shiftright("event", 1).alias("elem_id")).agg(
        F.max(F.when(F.col("event") % 2 == 0, F.col("entered"))).alias("at_enter"),
        F.max(F.when(F.col("event") % 2 != 0, F.col("entered"))).alias("at_leave"),
        F.max(F.when(F.col("event") % 2 == 0, F.col("gained"))).alias("gained"))
    total = both.groupBy("doc_id").agg(F.max("at_enter").alias("n"))
    return both.join(total, "doc_id").select(
        "doc_id", "elem_id", (F.col("n") - F.col("at_enter")).alias("seq"), (F.col("n") - F.col("at_leave") - 1).alias("last_seq"),
        (-F.col("gained")).alias("depth0"), "n")


def _toured_nodes(elements: DataFrame, docs: DataFrame, page_refs: DataFrame | None, pages: DataFrame | None,
                  page_level_text: bool, tag_map: dict, level_map: dict, least: int) -> DataFrame:
    """``tagged_nodes`` for documents of any size, whose numbers come from a tour (``_walk``)."""
    el = elements.filter(F.col("tag").isNotNull())
    if page_refs is not None:
        pr = page_refs.select("doc_id", "page_ref", F.col("page_index").alias("_pidx"))
        el = el.join(pr, ["doc_id", "page_ref"], "left")
    else:
        el = el.withColumn("_pidx", F.lit(None).cast("int"))
    el = el.withColumn("page_index", F.coalesce("_pidx", F.lit(0)).cast("int")).drop("_pidx")
    walk = _walk(el, least)
    x = walk.join(el, ["doc_id", "elem_id"]).withColumn("node_type", map_tag("tag", tag_map))
    # Counts are grouped (combined before the shuffle); of the windows only the
    # one over siblings is left.
    is_top = F.col("depth0") == 0
    tops = x.groupBy("doc_id").agg(F.count_if(is_top).alias("top"), F.count_if(is_top & (F.col("node_type") == "document")).alias("top_doc"))
    single = (F.col("top") == 1) & (F.col("top_doc") == 1)
    shift = F.when(single, 0).otherwise(1)
    x = x.join(tops, "doc_id").withColumn("wrapped", ~single).withColumn("pre", F.col("seq") + shift).withColumn(
        "last", F.col("last_seq") + shift).withColumn("depth", F.col("depth0") + shift)
    kids = x.groupBy("doc_id", F.col("parent_elem").alias("elem_id")).agg(F.count(F.lit(1)).alias("n_kids"))
    sib = Window.partitionBy("doc_id", "parent_elem").orderBy("seq")
    x = (x.join(kids, ["doc_id", "elem_id"], "left").withColumn("children_count", F.coalesce("n_kids", F.lit(0)))
         .withColumn("child_pos", F.row_number().over(sib) - 1))
    d = docs.select("doc_id", "source_hash")
    x = x.join(d, "doc_id")
    if page_level_text:
        x = x.join(pages.select("doc_id", "page_index", F.col("page_text").alias("_ptext")),
                   ["doc_id", "page_index"], "left").withColumn("text", F.col("_ptext"))
    x = x.withColumn("node_id", node_id("source_hash", "page_index", "seq"))
    parents = x.select("doc_id", F.col("elem_id").alias("parent_elem"), F.col("node_id").alias("_pid"), F.col("pre").alias("_ppre"))
    x = x.join(parents, ["doc_id", "parent_elem"], "left")
    wrap_id = node_id("source_hash", F.lit(0), "n")
    text = F.when(F.col("children_count") == 0, F.nullif(py_strip("text"), F.lit("")))
    own = node_struct(F.col("node_id"),
                      F.when(F.col("_pid").isNull() & F.col("wrapped"), wrap_id).otherwise(F.col("_pid")),
                      F.col("pre"), F.col("last"), F.col("depth"), F.col("child_pos"), F.col("node_type"),
                      F.col("page_index"), text_content=text, level=heading_level("tag", level_map),
                      struct_type=F.col("tag"), heuristic=False, mcid=F.col("kid").try_cast("int"),
                      children_count=F.col("children_count"),
                      parent_pre=F.when(F.col("_ppre").isNull() & F.col("wrapped"), 0).otherwise(F.col("_ppre")))
    nodes = explode_nodes(x, F.array(own))
    # Wrapper document nodes: documents with no element at all, or whose top
    # level is not a single document element.
    stats = x.groupBy("doc_id").agg(F.max("n").alias("n"), F.max("top").alias("top"),
                                    F.max(F.col("wrapped").cast("int")).alias("wrapped"))
    wr = docs.select("doc_id", "source_hash").join(stats, "doc_id", "left").filter(
        F.coalesce(F.col("wrapped"), F.lit(1)) == 1)
    n = F.coalesce(F.col("n"), F.lit(0))
    wrapper = node_struct(node_id("source_hash", F.lit(0), n), None, 0, n, 0, 0, "document", 0,
                          heuristic=False, children_count=F.coalesce(F.col("top"), F.lit(0)))
    return nodes.unionByName(explode_nodes(wr, F.array(wrapper)))


# Elements of a document that one task numbers in memory; larger documents take the tour.
MOST_AT_ONCE = 200_000
_ELEMENT = ["doc_id", "elem_id", "parent_elem", "kid_pos", "tag", "page_ref", "kid", "text"]
_PLACE = ["seq", "last_seq", "depth0", "n", "top", "top_doc", "children_count", "child_pos", "up_seq", "up_page"]


def _number_trees(rows: DataFrame) -> DataFrame:
    """Places of the elements of whole documents: ``rows`` come by ``doc_id, kid_pos, elem_id``, a document in one task.

    Elements are numbered for all documents of a batch at once, one step a level: subtree
    sizes upwards, preorder ranks downwards.  Elements that reach no root drop out.
    Documents marked ``odd``, and those with repeated or null element ids, pass unnumbered.
    """
    schema = T.StructType([*(T.StructField(f.name, f.dataType) for f in rows.schema), *(T.StructField(c, T.IntegerType()) for c in _PLACE)])
    names, given = _PLACE, ["elem_id", "parent_elem", "kid_pos", "page_ref"]

    def number(batches):
        # Nested, so that executors get it by value and need no package.
        import numpy as np
        import pyarrow as pa

        def unnumbered(rows):
            rows = rows.set_column(rows.schema.get_field_index("odd"), "odd", pa.array(np.ones(len(rows), bool)))
            for c in names:
                rows = rows.append_column(c, pa.nulls(len(rows), pa.int32()))
            return rows.to_batches()

        def ints(rows, c):
            return rows[c].combine_chunks().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)

        def nulls(rows, c):
            return rows[c].combine_chunks().is_null().to_numpy(zero_copy_only=False)

        def before(sizes, heads):
            """Sum of the sizes before each entry, from the last group's head on; and its position in the group."""
            ahead, place = np.cumsum(sizes) - sizes, np.arange(len(sizes))
            group = np.cumsum(heads) - 1
            return ahead - ahead[heads][group], place - place[heads][group]

        def numbered(rows):
            ids = ints(rows, "doc_id")
            starts = np.concatenate(([True], ids[1:] != ids[:-1]))
            doc, n = np.cumsum(starts) - 1, len(ids)
            known, code = np.unique(ints(rows, "elem_id"), return_inverse=True)
            key = doc * len(known) + code
            order = np.argsort(key, kind="stable")
            in_order = key[order]
            again = order[1:][in_order[1:] == in_order[:-1]]
            odd = np.unique(doc[np.concatenate((again, np.flatnonzero(nulls(rows, "elem_id"))))])
            if len(odd):
                aside = np.isin(doc, odd)
                yield from unnumbered(rows.filter(pa.array(aside)))
                if not aside.all():
                    yield from numbered(rows.filter(pa.array(~aside)))
                return
            up, is_root = ints(rows, "parent_elem"), nulls(rows, "parent_elem")
            at = np.minimum(np.searchsorted(known, up), len(known) - 1)
            wanted = doc * len(known) + at
            found = np.minimum(np.searchsorted(in_order, wanted), n - 1)
            has_up = ~is_root & (known[at] == up) & (in_order[found] == wanted)
            parent = np.where(has_up, order[found], -1)
            kids = np.flatnonzero(has_up)
            kids = kids[np.argsort(parent[kids], kind="stable")]
            counts = np.bincount(parent[kids], minlength=n)
            first = np.cumsum(counts) - counts
            levels, level = [], np.flatnonzero(is_root)
            while len(level):
                levels.append(level)
                c = counts[level]
                level = kids[np.repeat(first[level] - np.cumsum(c) + c, c) + np.arange(c.sum())]
            size = np.ones(n, np.int64)
            for level in reversed(levels[1:]):
                np.add.at(size, parent[level], size[level])
            seq, depth, pos, reached = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, bool)
            for k, level in enumerate(levels):
                group = parent[level] if k else doc[level]
                ahead, pos[level] = before(size[level], np.concatenate(([True], group[1:] != group[:-1])))
                seq[level] = ahead + (seq[group] + 1 if k else 0)
                depth[level], reached[level] = k, True
            roots = levels[0] if levels else np.zeros(0, np.int64)
            is_doc = rows["is_doc"].combine_chunks().fill_null(False).to_numpy(zero_copy_only=False)
            total = np.bincount(doc, reached, doc[-1] + 1).astype(np.int64)
            top, top_doc = (np.bincount(doc[x], minlength=doc[-1] + 1) for x in (roots, roots[is_doc[roots]]))
            has_up &= reached
            page = ints(rows, "page_index")
            places = [seq, seq + size - 1, depth, total[doc], top[doc], top_doc[doc], counts, pos, seq[parent], page[parent]]
            for c in given:  # of use to unnumbered rows only
                rows = rows.set_column(rows.schema.get_field_index(c), c, pa.nulls(n, rows.schema.field(c).type))
            for c, x in zip(names, places):
                rows = rows.append_column(c, pa.array(x.astype(np.int32), mask=~has_up if c in ("up_seq", "up_page") else None))
            yield from rows.filter(pa.array(reached)).to_batches()

        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows.cast(pa.schema([pa.field(f.name, f.type) for f in rows.schema]))
            odd = rows["odd"].combine_chunks().to_numpy(zero_copy_only=False)
            if odd.any():
                yield from unnumbered(rows.filter(pa.array(odd)))
                rows = rows.filter(pa.array(~odd))
            if held is not None:
                rows = pa.concat_tables([held, rows])
            held = rows
            if len(rows) < 10_000:
                continue
            ids = rows["doc_id"].to_numpy()
            end = int(np.searchsorted(ids, ids[-1]))  # the last document may go on
            held = rows.slice(end)
            if end:
                yield from numbered(rows.slice(0, end))
        if held is not None and len(held):
            yield from numbered(held)

    return rows.mapInArrow(number, schema)


def _placed(elements: DataFrame, docs: DataFrame, page_refs: DataFrame | None, pages: DataFrame | None, is_doc: Column, most: int) -> DataFrame:
    """Elements of listed documents with their places, written to the shared folder once.

    What a document needs (source hash, page references) meets its elements as one row, so
    elements cross the network once, by document.  ``odd`` documents (more than ``most`` elements;
    repeated ids of documents, references, pages or elements) have no places yet.
    """
    none = F.lit(None)
    ref, page = none.cast("struct<page_ref: bigint, page_index: int>"), none.cast("int")
    about = docs.select("doc_id", F.lit(True).alias("listed"), F.left("source_hash", F.lit(6)).alias("src"), ref.alias("ref"), page.alias("page"))
    none_listed, no_src = none.cast("boolean").alias("listed"), none.cast("string").alias("src")
    if page_refs is not None:
        found = F.struct(F.col("page_ref").cast("bigint").alias("page_ref"), F.col("page_index").cast("int").alias("page_index"))
        about = about.unionByName(page_refs.filter("page_ref IS NOT NULL").select("doc_id", none_listed, no_src, found.alias("ref"), page.alias("page")))
    if pages is not None:
        about = about.unionByName(pages.filter("page_index IS NOT NULL").select("doc_id", none_listed, no_src, ref.alias("ref"), F.col("page_index").cast("int").alias("page")))
    about = about.groupBy("doc_id").agg(F.count("listed").alias("listed"), F.max("src").alias("src"), F.collect_list("ref").alias("refs"),
                                        F.collect_list("page").alias("pages"))
    twice = F.size("refs") != F.size(F.array_distinct("refs.page_ref"))
    about = about.filter("listed > 0").select(
        "doc_id", "src", F.when(~twice, F.map_from_entries("refs")).alias("refs"),
        (twice | (F.col("listed") > 1) | (F.size("pages") != F.size(F.array_distinct("pages")))).alias("odd"))
    el = elements.filter(F.col("tag").isNotNull()).select(
        *(F.col(c).cast("bigint").alias(c) if c in ("elem_id", "parent_elem") else F.col(c) for c in _ELEMENT))
    # Merged, as sizes of what is made in rows (references, pages) are underestimated.  The window keeps
    # a document in one task, whatever the join does with large partitions.
    x = el.join(about.hint("merge"), "doc_id").withColumn("n_elements", F.count(F.lit(1)).over(Window.partitionBy("doc_id")))
    x = x.select(*_ELEMENT, "n_elements", F.coalesce(F.element_at("refs", F.col("page_ref").cast("bigint")), F.lit(0)).cast("int").alias("page_index"),
                 "src", is_doc.alias("is_doc"), (F.col("odd") | (F.col("n_elements") > most)).alias("odd"))
    path = f"{checkpoint_dir(x.sparkSession).rstrip('/')}/elements-{uuid.uuid4().hex}"
    _number_trees(x.sortWithinPartitions("doc_id", "kid_pos", "elem_id")).write.parquet(path)
    return x.sparkSession.read.parquet(path)


def tagged_nodes(elements: DataFrame, docs: DataFrame, page_refs: DataFrame | None = None,
                 pages: DataFrame | None = None, page_level_text: bool = False,
                 tag_map: dict = PDF_TAG_MAP, level_map: dict = PDF_HEADING_LEVEL, most: int = MOST_AT_ONCE) -> Built:
    """Structure elements -> ``nodes``.

    ``elements(doc_id, elem_id, parent_elem, kid_pos, tag, page_ref, kid, text)``;
    rows with a null tag are non-element kids and are skipped with their
    subtrees.  ``docs(doc_id, source_hash, page_count)`` lists the tagged
    documents (an empty tree still gives a document node).
    ``page_refs(doc_id, page_ref, page_index)`` resolves pages; missing -> 0.
    With ``page_level_text`` a leaf's text is its whole page's text
    (``pages(doc_id, page_index, page_text)``), as the reference does for PDFs.
    Documents of more than ``most`` elements, and those with repeated ids, are
    numbered by tours.
    """
    if page_level_text and pages is None:
        raise ValueError("page_level_text needs pages")
    placed = _placed(elements, docs, page_refs, pages if page_level_text else None, map_tag("tag", tag_map) == "document", most)
    x, is_top = placed.filter("NOT odd"), F.col("depth0") == 0
    wrapped = ~((F.col("top") == 1) & (F.col("top_doc") == 1))
    shift = F.when(wrapped, 1).otherwise(0)
    if page_level_text:
        texts = pages.select("doc_id", "page_index", F.col("page_text").alias("_ptext")).hint("merge")
        x = x.drop("text").join(texts, ["doc_id", "page_index"], "left").withColumnRenamed("_ptext", "text")
    own = node_struct(node_id("src", "page_index", "seq"),
                      F.when(~is_top, node_id("src", "up_page", "up_seq")).when(wrapped, node_id("src", F.lit(0), "n")),
                      F.col("seq") + shift, F.col("last_seq") + shift, F.col("depth0") + shift, F.col("child_pos"), map_tag("tag", tag_map),
                      F.col("page_index"), text_content=F.when(F.col("children_count") == 0, F.nullif(py_strip("text"), F.lit(""))),
                      level=heading_level("tag", level_map), struct_type=F.col("tag"), heuristic=False, mcid=F.col("kid").try_cast("int"),
                      children_count=F.col("children_count"), parent_pre=F.when(~is_top, F.col("up_seq") + shift).when(wrapped, 0))
    # Wrapper document nodes: documents whose top level is not a single document
    # element, known from their first element, and documents with no element at all.
    n = F.coalesce(F.col("n"), F.lit(0))
    wrapper = node_struct(node_id("src", F.lit(0), n), None, 0, n, 0, 0, "document", 0,
                          heuristic=False, children_count=F.coalesce(F.col("top"), F.lit(0)))
    bare = docs.select("doc_id", F.col("source_hash").alias("src")).join(
        placed.filter("odd OR seq = 0").select("doc_id").hint("merge"), "doc_id", "left_anti")
    bare = bare.select("doc_id", "src", F.lit(None).cast("int").alias("n"), F.lit(None).cast("int").alias("top"))
    some = placed.filter(F.expr("NOT odd AND seq = 0") & wrapped).select("doc_id", "src", "n", "top")
    nodes = x.select("doc_id", own.alias("o")).unionByName(some.unionByName(bare).select("doc_id", wrapper.alias("o")))
    nodes = nodes.select("doc_id", "o.*").filter(F.col("node_id").isNotNull()).select(*NODE_COLUMNS)
    odd = placed.filter("odd")
    if not odd.isEmpty():
        ids = odd.select("doc_id").distinct()
        least = 2 * placed.agg(F.max("n_elements")).first()[0]
        some_docs, some_refs, some_pages = (t if t is None else t.join(ids, "doc_id", "left_semi") for t in (docs, page_refs, pages))
        nodes = nodes.unionByName(_toured_nodes(odd.select(*_ELEMENT), some_docs, some_refs, some_pages, page_level_text, tag_map, level_map, least))
    out_docs = docs.select("doc_id", F.lit(SCHEMA_VERSION).alias("schema_version"), "source_hash",
                           F.col("page_count").cast("int").alias("page_count"), F.lit(False).alias("is_heuristic"))
    return Built(nodes, out_docs)


def route(heuristic: Built, tagged: Built) -> Built:
    """Union of both paths; each document appears in exactly one.

    Confidence follows each node's heuristic flag (0.5 / 1.0).
    """
    return Built(heuristic.nodes.unionByName(tagged.nodes), heuristic.docs.unionByName(tagged.docs))
