"""HTML pages -> the ordered tree of their block elements (the tagged corpus).

Rules (ours, since the reference reads PDF structure trees instead):

1. remove ``<script>``, ``<style>`` and comments first (scripts contain a
   literal ``</p>``), then inline tags (b, i, a, br, em, strong, span) and
   other markup without content (``<!...>``, ``<?...>``, ``</`` before no letter);
   a ``<`` that opens no tag, or a tag that never ends, is text;
2. every remaining tag is a token with the run of characters up to the next
   ``<``; scaffolding tags (html, head, body, meta, link, base, title) keep only
   that text, ``<title>`` not even that;
3. sections, lists, items, tables, rows and cells are containers: an element
   opened inside one becomes its child until the container ends.  All other
   elements are leaves and end where the next tag begins;
4. a container ends at its closing tag, at the end of a container around it, and
   by implication: an item at the next item of its list, a row at the next row
   of its table, a cell at the next cell or row.  A closing tag meant for no open
   container is ignored; those inside a table or a cell never close anything
   outside, those of an item never reach past its list;
5. text that belongs to no leaf is a ``#text`` leaf of the container it stands in;
   a container's leading text is its own if nothing else follows inside it;
6. the five basic entities are unescaped, ``&amp;`` last.

Cleaning and cutting are regular-expression and array work inside the row.  The
containers need a stack; one pass over the page's tag names in an Arrow UDF (no
text goes there) numbers the whole tree, so no shuffle or window follows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.tags import HTML_CONTAINERS, HTML_SKIP_TAGS, HTML_TAG_MAP
from quire.functions.text import col_, py_strip, source_hash_of_text
from quire.sources.corpus import spread

# The cleaning and token patterns of the HTML rules above.
RE_DROP_BLOCKS = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->"
RE_INLINE_TAGS = r"(?i)</?(?:b|i|a|br|em|strong|span)\b[^>]*>"
RE_MARKUP = r"<[!?][^>]*>|</(?![A-Za-z])[^>]*>"
RE_LONE = r"<(?![A-Za-z/!?])"
RE_UNDERSCORE = r"(<[A-Za-z][A-Za-z0-9]*)_"  # such names end there, as they do at a hyphen
RE_TOKEN = r"(?:<(/?[A-Za-z][A-Za-z0-9]*)\b[^>]*>|^)([^<]*)"


def clean_html(html) -> Column:
    s = F.regexp_replace(F.coalesce(col_(html), F.lit("")), RE_DROP_BLOCKS, "")
    # lone ones first: what follows them may be an inline tag, and those go
    s = F.regexp_replace(s, RE_LONE, "&lt;")
    s = F.regexp_replace(F.regexp_replace(s, RE_INLINE_TAGS, ""), RE_MARKUP, "")
    s = F.regexp_replace(s, RE_UNDERSCORE, "$1-")
    # behind the last ``>`` no tag ends, so every ``<`` is text there
    tail = F.length(F.substring_index(s, ">", -1))
    return F.concat(F.substr(s, F.lit(1), F.length(s) - tail), F.replace(F.right(s, tail), F.lit("<"), F.lit("&lt;")))


def unescape(c) -> Column:
    """``&lt; &gt; &quot; &#39;`` then ``&amp;``."""
    s = col_(c)
    for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        s = F.replace(s, F.lit(ent), F.lit(ch))
    return s


# The tree of a page in document order: entry 0 is the root, the others are its
# nodes.  ``tok`` is the token whose text a node holds (-1: none), ``is_text``
# marks ``#text``, ``parent`` and ``last`` are places in the same order.
TREE = "array<struct<tok: int, is_text: boolean, parent: int, last: int, depth: int, child_pos: int, children_count: int>>"


def _tree(tags: Column, has_text: Column) -> Column:
    """Column of ``TREE`` from the token tags (``/x`` closes, ``''`` is text only) and whether text follows."""
    kinds = {t: k for t, k in HTML_TAG_MAP.items() if k in HTML_CONTAINERS}

    def build(tag_lists, text_lists):
        # Nested, so that executors get it by value and need no package.
        import numpy as np
        import pyarrow as pa

        barriers = {"section": ("table", "table_cell"), "list": ("table", "table_cell"), "list_item": ("list", "table", "table_cell"),
                    "table_row": ("table",), "table_cell": ("table",), "table": ()}

        def tree(names, texts):
            tok, is_text, parent, own = [-1], [False], [-1], {}
            stack = [(0, "", "")]           # node, tag, kind
            heights = {}                    # tag or (kind,) -> heights in the stack, ascending

            def top(*keys):
                return max((heights[k][-1] for k in keys if heights.get(k)), default=0)

            def cut(height):
                while len(stack) > height:
                    _, tag, kind = stack.pop()
                    heights[tag].pop()
                    heights[(kind,)].pop()

            def add(i, text):
                tok.append(i)
                is_text.append(text)
                parent.append(stack[-1][0])
                return len(tok) - 1

            for i, (tag, text) in enumerate(zip(names, texts)):
                if tag[:1] == "/":
                    kind = kinds.get(tag[1:])
                    if kind:
                        at = top(tag[1:])
                        if at > top(*((b,) for b in barriers[kind])):
                            cut(at)
                elif tag:
                    kind = kinds.get(tag)
                    if kind == "list_item":
                        at = top(("list_item",))
                        if at > top(*((b,) for b in barriers["list_item"])):
                            cut(at)
                    elif kind == "table_row":
                        at = top(("table",))
                        if at:
                            cut(at + 1)
                        elif top(("table_row",), ("table_cell",)):
                            cut(top(("table_row",)) or top(("table_cell",)))
                    elif kind == "table_cell":
                        at = top(("table_row",), ("table",))
                        if at:
                            cut(at + 1)
                        elif top(("table_cell",)):
                            cut(top(("table_cell",)))
                    node = add(i, False)
                    if not kind:
                        continue
                    for key in (tag, (kind,)):
                        heights.setdefault(key, []).append(len(stack))
                    stack.append((node, tag, kind))
                    if text:
                        own[node] = add(i, True)
                    continue
                if text:
                    add(i, True)
            n = len(tok)
            kids = [0] * n
            for p in parent[1:]:
                kids[p] += 1
            lone = {t for node, t in own.items() if kids[node] == 1}  # a container's only text is its own
            place, at = [0] * n, 0
            for k in range(n):
                place[k] = at
                at += k not in lone
            out, child_of = [], [0] * n
            depth, last = [0] * n, list(range(n))
            for k in range(1, n):
                depth[k] = depth[parent[k]] + 1
            for k in range(n - 1, 0, -1):
                if k not in lone and last[k] > last[parent[k]]:
                    last[parent[k]] = last[k]
            for k in range(n):
                if k in lone:
                    continue
                p = parent[k]
                out.append((tok[k], is_text[k], place[p] if k else -1, place[last[k]], depth[k], child_of[p] if k else 0,
                            kids[k] - (own.get(k) in lone)))
                if k:
                    child_of[p] += 1
            return out

        offsets, rows = [0], []
        for names, texts in zip(tag_lists.to_pylist(), text_lists.to_pylist()):
            rows += tree(names, texts)
            offsets.append(len(rows))
        columns = list(zip(*rows)) if rows else [()] * 7
        kinds_ = [pa.int32(), pa.bool_(), *[pa.int32()] * 5]
        names_ = ["tok", "is_text", "parent", "last", "depth", "child_pos", "children_count"]
        values = pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds_)], names=names_)
        return pa.ListArray.from_arrays(pa.array(np.array(offsets), pa.int32()), values)

    return F.arrow_udf(build, TREE)(tags, has_text)


def html_trees(pages: DataFrame) -> DataFrame:
    """``pages(page_id, url, html)`` -> ``(doc_id, source_hash, tree)``, a row per page.

    ``tree`` holds the entries of ``TREE`` with ``tag`` (lower case, ``#text``; null at
    the root) and ``raw`` (text, neither unescaped nor stripped).  Row-local: pages
    are read where they lie (``spread``).
    """
    x = spread(pages, "page_id")
    # `cleaned` is referenced twice below, so the optimizer keeps it as one
    # computed column instead of re-running the cleaning regexes; the two
    # extractions are zipped, never indexed from inside a lambda.
    x = x.select(F.col("page_id").cast("bigint").alias("doc_id"),
                 source_hash_of_text("html").alias("source_hash"), clean_html("html").alias("cleaned"))
    x = x.select("doc_id", "source_hash",
                 F.regexp_extract_all("cleaned", F.lit(RE_TOKEN), 1).alias("tag"),
                 F.regexp_extract_all("cleaned", F.lit(RE_TOKEN), 2).alias("text"))
    skip = F.array(*[F.lit(t) for k in HTML_SKIP_TAGS for t in (k, "/" + k)])
    tokens = F.transform(F.arrays_zip("tag", "text"), lambda z: F.struct(
        F.when(F.array_contains(skip, F.lower(z["tag"])), F.lit("")).otherwise(F.lower(z["tag"])).alias("tag"),
        F.when(F.lower(z["tag"]) == "title", F.lit("")).otherwise(z["text"]).alias("raw")))
    x = x.select("doc_id", "source_hash", tokens.alias("tokens"))
    x = x.select("doc_id", "source_hash", "tokens", _tree(F.col("tokens.tag"), F.transform(
        "tokens", lambda z: py_strip(z["raw"]) != "")).alias("tree"))
    # The UDF's output and `tokens` are attributes here, so indexing is cheap.
    named = F.transform("tree", lambda n: F.struct(
        n["parent"].alias("parent"), n["last"].alias("last"), n["depth"].alias("depth"), n["child_pos"].alias("child_pos"),
        n["children_count"].alias("children_count"),
        F.when(n["is_text"], F.lit("#text")).otherwise(F.get("tokens", n["tok"])["tag"]).alias("tag"),
        F.get("tokens", n["tok"])["raw"].alias("raw")))
    return x.select("doc_id", "source_hash", named.alias("tree"))


def tag_histogram(pages: DataFrame) -> DataFrame:
    """Node count per tag over the corpus (``#text`` included)."""
    nodes = html_trees(pages).select(F.explode_outer("tree.tag").alias("tag")).filter(F.col("tag").isNotNull())
    return nodes.groupBy("tag").agg(F.count(F.lit(1)).alias("n"))
