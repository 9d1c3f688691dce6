"""Scalar column expressions shared by every operator.

All of these are built-in Spark SQL expressions, so they stay inside
whole-stage codegen; none of them is a Python UDF.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes (str.isspace()),
# which the node text rules use.  Spark's trim() removes only U+0020, so the
# set is passed to btrim() explicitly.
_WS_RANGES = [
    (0x0009, 0x000D), (0x001C, 0x0020), (0x0085, 0x0085), (0x00A0, 0x00A0),
    (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F),
    (0x205F, 0x205F), (0x3000, 0x3000),
]
PY_WS = "".join(chr(c) for lo, hi in _WS_RANGES for c in range(lo, hi + 1))

# Schema version and the number of leading source bytes hashed
# into the document's source hash; content hashes keep 16 hex characters and
# text previews 120 characters.
SCHEMA_VERSION = "1.0"
SOURCE_HASH_BYTES = 4096
CONTENT_HASH_CHARS = 16
PREVIEW_CHARS = 120
# Page separator used when a multi-page document is serialised to bytes.
PAGE_SEPARATOR = "\x0c"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """Strip Unicode whitespace from both ends (Python ``str.strip``)."""
    return F.btrim(col_(c), F.lit(PY_WS))


def split_paragraphs(text, delim: str = "\n\n") -> Column:
    """Text -> ordered array of stripped, non-empty blocks.

    Blank or null text gives an empty array.
    """
    parts = F.split(F.coalesce(col_(text), F.lit("")), re.escape(delim))
    return F.filter(F.transform(parts, lambda x: py_strip(x)), lambda x: x != F.lit(""))


def content_hash(text) -> Column:
    """First 16 hex characters of SHA-256 of the UTF-8 text (null -> '')."""
    return F.left(F.sha2(F.coalesce(col_(text), F.lit("")), 256), F.lit(CONTENT_HASH_CHARS))


def source_hash_of_bytes(b) -> Column:
    """SHA-256 hex of the first 4096 bytes of a BINARY column."""
    return F.sha2(F.substring(col_(b), 1, SOURCE_HASH_BYTES), 256)


def source_hash_of_text(text) -> Column:
    """SHA-256 hex of the first 4096 UTF-8 bytes of a STRING column."""
    return source_hash_of_bytes(F.encode(F.coalesce(col_(text), F.lit("")), "UTF-8"))


def full_hash_of_text(text) -> Column:
    """SHA-256 hex of the whole UTF-8 text; guards the 4 KB prefix collision."""
    return F.sha2(F.coalesce(col_(text), F.lit("")), 256)


def node_id(source_hash, page_index, seq) -> Column:
    """``ast:{first 6 hex of source hash}:{page}:{seq}``."""
    return F.concat(F.lit("ast:"), F.left(col_(source_hash), F.lit(6)), F.lit(":"),
                    col_(page_index).cast("string"), F.lit(":"), col_(seq).cast("string"))


def est_tokens(text) -> Column:
    """0 for null/empty text, else max(1, code points // 4)."""
    n = F.length(col_(text))
    return F.when(col_(text).isNull() | (n == 0), F.lit(0)).otherwise(
        F.greatest(F.lit(1), F.floor(n / 4).cast("int"))).cast("int")


def preview(text) -> Column:
    """First 120 code points; empty or null text -> null."""
    return F.nullif(F.left(F.coalesce(col_(text), F.lit("")), F.lit(PREVIEW_CHARS)), F.lit(""))


def percent(c) -> Column:
    """Python ``format(x, '.0%')``: half-to-even rounding of x*100, then '%'."""
    return F.concat(F.bround(col_(c) * 100, 0).cast("bigint").cast("string"), F.lit("%"))


def csv_field(c) -> Column:
    """One CSV field as Python's csv writer prints it (minimal quoting).

    Null prints as an empty field.  A field is quoted when it holds a comma,
    a double quote, CR or LF; quotes inside are doubled.
    """
    s = F.coalesce(col_(c), F.lit(""))
    needs = s.rlike('[,"\r\n]')
    return F.when(needs, F.concat(F.lit('"'), F.replace(s, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(s)


def csv_row(cells) -> Column:
    """Array of strings -> one CSV line ending in CRLF.

    A row with a single empty field prints ``""`` like Python's writer.
    """
    arr = col_(cells)
    line = F.array_join(F.transform(arr, csv_field), ",")
    single_empty = (F.size(arr) == 1) & (F.coalesce(F.try_element_at(arr, F.lit(1)), F.lit("")) == "")
    return F.concat(F.when(single_empty, F.lit('""')).otherwise(line), F.lit("\r\n"))
