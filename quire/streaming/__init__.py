from quire.streaming.stream import (  # noqa: F401
    cited_text_stream, dedupe_stream, read_documents_stream, run_to_table, stream_cited_text, stream_dedupe,
)
