from quire.functions.text import (  # noqa: F401
    PY_WS, SCHEMA_VERSION, PAGE_SEPARATOR, py_strip, split_paragraphs, content_hash,
    source_hash_of_bytes, source_hash_of_text, full_hash_of_text, node_id, est_tokens,
    preview, percent, csv_field, csv_row,
)
from quire.functions.tags import (  # noqa: F401
    NODE_TYPES, PDF_TAG_MAP, PDF_HEADING_LEVEL, HTML_TAG_MAP, HTML_HEADING_LEVEL,
    map_tag, heading_level, is_valid_node_type,
)
