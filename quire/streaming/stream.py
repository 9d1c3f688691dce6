"""Structured Streaming forms of the stateless operators (survey K3, K4).

A streamed row is a whole document, so node building (array form, no window)
and cited text need no state and run per micro-batch.  Deduplication keeps
state keyed by content hash.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quire.functions.text import full_hash_of_text, source_hash_of_text
from quire.operators.cited import cited_text, flatten_bbox
from quire.operators.heuristic import heuristic_nodes_wide
from quire.session import checkpoint_dir
from quire.sources.corpus import documents_wide


def read_documents_stream(spark: SparkSession, source_dir: str, glob: str = "documents*.parquet",
                          max_files_per_trigger: int | None = None) -> DataFrame:
    """File-source stream of ``documents`` rows with the table's fixed schema; the
    caller may bound the files of a batch.

    ``glob`` names the table in ``source_dir``: files, or folders of part files under any
    names, as Spark's own writers leave them.
    """
    schema = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(f"{source_dir.rstrip('/')}/{glob}")


def cited_text_stream(docs_stream: DataFrame, delim: str = "\n\n",
                      lines_per_page: int | None = None) -> DataFrame:
    """K3: documents stream -> cited text blocks stream (append, stateless)."""
    nodes = heuristic_nodes_wide(documents_wide(docs_stream, lines_per_page), delim).nodes
    return flatten_bbox(cited_text(nodes))


def dedupe_stream(docs_stream: DataFrame, event_time: str | None = None, delay: str = "1 hour") -> DataFrame:
    """K4: drop documents whose content was already seen.

    Keyed by (source_hash, full_hash).  With an event-time column the state
    is bounded by the watermark (``dropDuplicatesWithinWatermark``); without
    one it holds one key per distinct document.
    """
    x = docs_stream.withColumn("source_hash", source_hash_of_text("text")).withColumn(
        "full_hash", full_hash_of_text("text"))
    if event_time is not None:
        return x.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["source_hash", "full_hash"])
    return x.dropDuplicates(["source_hash", "full_hash"])


def run_to_table(stream: DataFrame, name: str, spark: SparkSession | None = None,
                 output_mode: str = "append") -> tuple[StreamingQuery, str]:
    """Run a stream to completion (``availableNow``) into parquet under the
    shared checkpoint folder; return the query and the output path."""
    spark = spark or stream.sparkSession
    base = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    q = (stream.writeStream.format("parquet").outputMode(output_mode)
         .option("path", f"{base}/out").option("checkpointLocation", f"{base}/chk")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q, f"{base}/out"


def stream_cited_text(spark: SparkSession, source_dir: str, delim: str = "\n\n") -> DataFrame:
    """K3 end to end: stream the documents folder, return the written blocks."""
    _, path = run_to_table(cited_text_stream(read_documents_stream(spark, source_dir), delim),
                           "cited-text", spark)
    return spark.read.parquet(path)


def stream_dedupe(spark: SparkSession, source_dir: str) -> DataFrame:
    """K4 end to end: the distinct content hashes seen by the stream."""
    s = dedupe_stream(read_documents_stream(spark, source_dir)).select("source_hash", "full_hash")
    _, path = run_to_table(s, "dedupe", spark)
    return spark.read.parquet(path)


def stream_dedupe_watermark(spark: SparkSession, source_dir: str, delay: str = "1 day") -> DataFrame:
    """K4 with bounded state: a hash is forgotten once the watermark passes its
    event time plus ``delay``.  The documents carry no time, so the n-th
    document arrives n seconds after the epoch."""
    docs = read_documents_stream(spark, source_dir).withColumn("arrived", F.timestamp_seconds(F.coalesce("doc_id", F.lit(0))))
    s = dedupe_stream(docs, "arrived", delay).select("source_hash", "full_hash")
    _, path = run_to_table(s, "dedupe-watermark", spark)
    return spark.read.parquet(path)


__all__ = ["read_documents_stream", "cited_text_stream", "dedupe_stream", "run_to_table",
           "stream_cited_text", "stream_dedupe", "stream_dedupe_watermark"]
