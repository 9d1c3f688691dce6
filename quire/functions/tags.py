"""Tag -> node-type maps, as literal map expressions (no join needed)."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions.text import col_

# The 14 node types, in their published order.
NODE_TYPES = [
    "document", "section", "heading", "paragraph", "list", "list_item", "table",
    "table_row", "table_cell", "figure", "code", "annotation", "artifact", "form_field",
]

# PDF structure tags -> node type.  Unknown tags are artifacts.
PDF_TAG_MAP = {
    "/Document": "document",
    "/Sect": "section", "/Part": "section", "/Div": "section",
    "/H": "heading", "/H1": "heading", "/H2": "heading", "/H3": "heading",
    "/H4": "heading", "/H5": "heading", "/H6": "heading",
    "/P": "paragraph",
    "/L": "list", "/LI": "list_item",
    "/Table": "table", "/TR": "table_row", "/TD": "table_cell", "/TH": "table_cell",
    "/Figure": "figure", "/Code": "code", "/Annot": "annotation", "/Art": "artifact",
}

# PDF heading tags -> heading level.
PDF_HEADING_LEVEL = {"/H": 1, "/H1": 1, "/H2": 2, "/H3": 3, "/H4": 4, "/H5": 5, "/H6": 6}

# HTML block tags -> node type (our twin of the PDF map).  Unknown -> artifact.
# <title> is head metadata and is dropped in favour of <h1> (see HTML_SKIP_TAGS).
HTML_TAG_MAP = {
    "h1": "heading", "h2": "heading", "h3": "heading",
    "h4": "heading", "h5": "heading", "h6": "heading",
    "p": "paragraph",
    "ul": "list", "ol": "list", "li": "list_item",
    "table": "table", "tr": "table_row", "td": "table_cell", "th": "table_cell",
    "nav": "section", "div": "section", "article": "section", "section": "section",
    "footer": "section",
    "figure": "figure", "pre": "code",
    "#text": "paragraph",
}

# HTML heading levels.
HTML_HEADING_LEVEL = {"h1": 1, "h2": 2, "h3": 3, "h4": 4, "h5": 5, "h6": 6}

# Document scaffolding and head tags that never become nodes.
HTML_SKIP_TAGS = ["html", "head", "body", "meta", "link", "base", "title"]

# HTML node types that hold other nodes; all others are leaves.
HTML_CONTAINERS = ["section", "list", "list_item", "table", "table_row", "table_cell"]


def literal_map(d: dict) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(d.items())])


def map_tag(tag, mapping: dict = PDF_TAG_MAP) -> Column:
    """Tag -> node type; unknown or null tags become ``artifact``."""
    return F.coalesce(F.try_element_at(literal_map(mapping), col_(tag)), F.lit("artifact"))


def heading_level(tag, mapping: dict = PDF_HEADING_LEVEL) -> Column:
    """Tag -> heading level, null for non-heading tags."""
    return F.try_element_at(literal_map(mapping), col_(tag)).cast("int")


def is_valid_node_type(c) -> Column:
    return col_(c).isin(NODE_TYPES)
