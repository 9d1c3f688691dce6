"""Driver contract, streaming and sinks."""

import json
import os
import tempfile


from tests.conftest import SF_SMOKE, rows


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert {"doc_id", "node_id", "text", "confidence", "content_hash"} <= set(df.columns)


def test_every_query_has_an_oracle():
    import __spark_entry__ as E
    from quire.plans.oracle import ORACLE
    from quire.plans.queries import QUERIES
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql()) <= set(E.queries())


def test_streaming_matches_batch(spark):
    from quire.operators.cited import cited_text
    from quire.operators.heuristic import heuristic_nodes_wide
    from quire.sources.corpus import documents_wide, load_table
    from quire.streaming import stream_cited_text
    s = stream_cited_text(spark, SF_SMOKE, "\n")
    b = cited_text(heuristic_nodes_wide(documents_wide(load_table(spark, SF_SMOKE, "documents")), "\n").nodes)
    cols = ["doc_id", "pre", "node_id", "text", "content_hash"]
    assert s.select(*cols).exceptAll(b.select(*cols)).count() == 0
    assert s.count() == b.count()


def test_streams_read_a_table_that_is_a_folder_of_parts(spark):
    from quire.streaming import stream_cited_text, stream_dedupe
    from quire.streaming.stream import stream_dedupe_watermark
    d = tempfile.mkdtemp(prefix="quire-test-")
    docs = [(1, "a\nb", "en", "s", 3), (2, "c", "en", "s", 1), (3, "c", "en", None, 1), (4, None, None, None, None)]
    kinds = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
    spark.createDataFrame(docs, kinds).repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.range(3).write.parquet(f"{d}/labels.parquet")
    assert sorted((r["doc_id"], r["text"]) for r in rows(stream_cited_text(spark, d, "\n"))) == [(1, "a"), (1, "b"), (2, "c"), (3, "c")]
    assert stream_dedupe(spark, d).count() == 3
    assert stream_dedupe_watermark(spark, d).count() == 3


def test_json_sink_keeps_nulls_and_unicode(spark):
    from quire.sources.sinks import json_lines, write_json
    df = spark.createDataFrame([(1, None, "é")], "a INT, b STRING, c STRING")
    line = rows(json_lines(df))[0]["json"]
    assert json.loads(line) == {"a": 1, "b": None, "c": "é"}
    out = os.path.join(tempfile.mkdtemp(prefix="quire-test-"), "j")
    write_json(df, out)
    assert spark.read.json(out).count() == 1


def test_markdown_entry(spark):
    from quire.sources.sinks import markdown_documents
    blocks = spark.createDataFrame([(1, 0, 2, "paragraph", "hello", "ast:x:2:1", 0.125)],
                                   "doc_id BIGINT, pre INT, page_index INT, node_type STRING, text STRING, "
                                   "node_id STRING, confidence DOUBLE")
    md = rows(markdown_documents(blocks))[0]["content"]
    assert md == "[p2] (paragraph) hello  \n  _cite: ast:x:2:1 conf=12%_\n"
