"""WARC archives of pages, and one globally ordered index over their captures.

Writing: one record per page through Spark's text writer, the record separator
as line separator, so archives go to any store Spark writes to.  Payloads that
equal an earlier page's (same digest and length, at least ``MIN_REVISIT``
bytes) become revisit records that refer to the page with the smallest id.

Reading: Spark's text reader cuts the archives at record boundaries, headers
are parsed with column functions and blocks taken by their Content-Length.  A
payload that itself holds a record boundary is written in base64 (its HTTP
header says so); a foreign record cut short by one is marked damaged.

Index: every task sorts the captures it has read into a run; the key space
(URL key, time, page) is cut into ranges, and for each range one task merges
the runs' pieces with a loser tree.  A URL with very many captures spreads over
ranges, as time and page belong to the key.

Defined results: a null html is an empty payload; a null url is an empty one
with an empty key; rows that repeat the smallest page_id of equal payloads are
all responses; null page_ids count as larger than others and refer to nobody if
all equal payloads lack one; an empty table gives empty archives and an empty
index.  Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import cut

MIN_REVISIT = 100         # bytes from which equal payloads are written once
FIRST_CAPTURE = 1_577_836_800  # 2020-01-01; pages carry no time, so the n-th page was captured n seconds later
# Fixed values of the format.
CRLF = "\r\n"
END = "\r\n\r\n"
VERSION = "WARC/1.0\r\n"
BOUNDARY = END + VERSION
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


def url_key(url: Column) -> Column:
    """Sort-friendly URL: reversed host without ``www.``, then path and query in lower case, no fragment."""
    plain = F.lower(F.regexp_replace(F.coalesce(url, F.lit("")), "#.*$", ""))
    host = F.regexp_replace(F.regexp_extract(plain, r"^[a-z][a-z0-9+.-]*://([^/?:]*)", 1), r"^www\.", "")
    rest = F.regexp_replace(plain, r"^[a-z][a-z0-9+.-]*://[^/?]*", "")
    return F.when(host == "", plain).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest))


def plan_records(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, captured_at, payload_bytes, payload_digest, record_type, refers_to) for every row.

    Digests are grouped without the pages; only pages whose payload occurs more
    than once meet the rest in a join.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    known = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), html.alias("html"),
                         F.octet_length(html).cast("long").alias("payload_bytes"), F.sha2(html, 256).alias("payload_digest"))
    narrow = known.select("page_id", "payload_bytes", "payload_digest").filter(F.col("payload_bytes") >= MIN_REVISIT)
    first = (narrow.groupBy("payload_digest", "payload_bytes").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
             .filter((F.col("n") > 1) & F.col("refers_to").isNotNull()).drop("n"))
    again = (narrow.join(first, ["payload_digest", "payload_bytes"]).filter(~F.col("page_id").eqNullSafe(F.col("refers_to")))
             .select(F.col("page_id").alias("__page"), F.col("payload_digest").alias("__digest"), "refers_to").distinct())
    planned = known.join(again, F.col("page_id").eqNullSafe(F.col("__page")) & (F.col("payload_digest") == F.col("__digest")), "left")
    return planned.select(
        "page_id", "url", "html", F.timestamp_seconds(F.lit(FIRST_CAPTURE) + F.coalesce("page_id", F.lit(0))).alias("captured_at"),
        "payload_bytes", "payload_digest", F.when(F.col("refers_to").isNull(), "response").otherwise("revisit").alias("record_type"),
        "refers_to")


def _uri(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def record(planned: DataFrame) -> DataFrame:
    """One string ``value`` per record: headers, blank line and block (without the final separator)."""
    revisit = F.col("record_type") == "revisit"
    # the blank line before the payload and the separator behind it can be part of a boundary
    coded = ~revisit & F.contains(F.concat(F.lit(END), "html", F.lit(BOUNDARY[:-1])), F.lit(BOUNDARY))
    payload = F.when(revisit, "").when(coded, F.base64(F.col("html").cast("binary"))).otherwise(F.col("html"))
    http = F.concat(F.lit("HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html; charset=utf-8" + CRLF),
                    F.when(coded, "Content-Transfer-Encoding: base64" + CRLF).otherwise(""),
                    F.lit("Content-Length: "), F.col("payload_bytes").cast("string"), F.lit(END))
    url = F.regexp_replace("url", r"[\r\n]+", "%20")
    stamp = F.date_format("captured_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    built = planned.select("record_type", "page_id", "refers_to", "payload_digest", url.alias("url"), stamp.alias("stamp"),
                           F.concat(http, payload).alias("block"))
    return built.select(F.concat(
        F.lit(VERSION + "WARC-Type: "), "record_type", F.lit(CRLF + "WARC-Record-ID: "), _uri(F.col("page_id")),
        F.lit(CRLF + "WARC-Date: "), "stamp", F.lit(CRLF + "WARC-Target-URI: "), "url",
        F.lit(CRLF + "WARC-Payload-Digest: sha256:"), "payload_digest",
        F.when(F.col("refers_to").isNotNull(), F.concat(
            F.lit(CRLF + "WARC-Refers-To: "), _uri(F.col("refers_to")), F.lit(CRLF + "WARC-Profile: " + REVISIT_PROFILE))).otherwise(""),
        F.lit(CRLF + "Content-Type: application/http; msgtype=response" + CRLF + "Content-Length: "),
        F.octet_length("block").cast("string"), F.lit(END), "block").alias("value"))


def write_archives(pages: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write one archive per task under ``path``, compressed as archives usually are."""
    record(plan_records(pages)).write.option("lineSep", END).option("compression", compression).text(path)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, url, captured_at, record_type, refers_to, payload_bytes, payload_digest,
    payload, damaged) for every record of the archives under ``path``.

    The digest of a response is that of the payload read; ``damaged`` says that
    a block is shorter than announced or a digest differs from its header.
    """
    raw = spark.read.option("lineSep", BOUNDARY).text(path)
    cutoff = F.instr("value", END)
    parts = raw.select(F.substr("value", F.lit(1), cutoff - 1).alias("head"),
                       F.substr("value", cutoff + len(END)).cast("binary").alias("rest"))

    def header(name: str, of: str = "head") -> Column:
        return F.regexp_extract(of, rf"(?m)^{name}:[ ]?([^\r\n]*)", 1)

    announced = F.expr("try_cast(block_bytes AS int)")
    parts = parts.select("*", header("Content-Length").alias("block_bytes")).filter(F.col("head") != "")
    parts = parts.select("*", F.substring("rest", F.lit(1), F.coalesce(announced, F.lit(0))).alias("block"))
    split = F.instr(F.col("block").cast("string"), END)  # HTTP headers are ASCII, so characters are bytes here
    parts = parts.select("*", F.substring(F.col("block"), F.lit(1), split).cast("string").alias("http"),
                         F.substring("block", split + len(END), F.octet_length("block")).alias("body"))
    is_revisit = header("WARC-Type") == "revisit"
    body = F.when(header("Content-Transfer-Encoding", "http") == "base64", F.unbase64(F.col("body").cast("string"))).otherwise(F.col("body"))
    parts = parts.select("*", is_revisit.alias("revisit"), body.alias("payload"),
                         F.regexp_replace(header("WARC-Payload-Digest"), "^sha256:", "").alias("noted"))
    digest = F.when(F.col("revisit"), F.col("noted")).otherwise(F.sha2("payload", 256))
    full = parts.select("*", digest.alias("payload_digest"), header("Content-Length", "http").try_cast("long").alias("payload_bytes"))
    page = r"^<urn:page:(-?[0-9]*)>$"

    def number(name: str) -> Column:
        return F.regexp_extract(header(name), page, 1).try_cast("long")

    return full.select(
        number("WARC-Record-ID").alias("page_id"), header("WARC-Target-URI").alias("url"),
        F.try_to_timestamp(header("WARC-Date"), F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("captured_at"),
        header("WARC-Type").alias("record_type"), number("WARC-Refers-To").alias("refers_to"), "payload_bytes", "payload_digest", "payload",
        ((F.octet_length("block") < F.coalesce(announced, F.lit(0))) | (F.col("payload_digest") != F.col("noted"))
         | (~F.col("revisit") & (F.octet_length("payload") != F.col("payload_bytes")))).alias("damaged"))


class LoserTree:
    """Tournament over k sorted iterators: inner nodes keep the losers, so each
    step replays one path of log2 k comparisons."""

    def __init__(self, runs: list[Iterator]):
        self.runs, self.k = runs, len(runs)
        self.heads = [next(r, None) for r in runs]
        self.losers = [-1] * max(self.k, 1)
        for leaf in range(self.k):
            self._replay(leaf)

    def _less(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return x is not None
        return (x[0], a) < (y[0], b)

    def _replay(self, leaf: int) -> None:
        """Carry a leaf up; at an empty node (while building) it waits as the loser."""
        winner, node = leaf, (leaf + self.k) // 2
        while node:
            other = self.losers[node]
            if other < 0:
                self.losers[node] = winner
                return
            if self._less(other, winner):
                self.losers[node], winner = winner, other
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator:
        while self.k and self.heads[self.losers[0]] is not None:
            leaf = self.losers[0]
            yield self.heads[leaf]
            self.heads[leaf] = next(self.runs[leaf], None)
            self._replay(leaf)


ORDER = ["url_key", "captured_at", "page_id"]


RANGE_ROWS = 250_000  # captures that one task merges, about


def capture_index(records: DataFrame) -> DataFrame:
    """``records`` (with url, captured_at and page_id) with ``url_key`` and ``position``,
    the place in the global order by (url_key, captured_at, page_id), nulls first.

    Every task sorts its records into a run.  The key space is cut into ranges of about
    ``RANGE_ROWS`` captures by their number, not by the session's partitions; a task holds
    the pieces of all runs in one range, as Arrow columns, merges them by a loser tree
    that looks at one row of each piece at a time, and numbers them from the range's
    place on.  Only index columns should be passed in.
    """
    columns = records.columns
    runs = cut(records.withColumn("url_key", url_key(F.col("url"))).sortWithinPartitions(*ORDER)
               .withColumn("run", F.spark_partition_id()).withColumn("nth", F.monotonically_increasing_id()))
    n_ranges = max(1, -(-runs.count() // RANGE_ROWS))
    ranged = cut(runs.repartitionByRange(n_ranges, *[F.col(c).asc_nulls_first() for c in ORDER]).sortWithinPartitions("run", "nth")
                 .withColumn("range_no", F.spark_partition_id()))
    before = Window.orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = (ranged.groupBy("range_no").count()
               .select(F.col("range_no").alias("__range"), F.coalesce(F.sum("count").over(before), F.lit(0)).alias("position")))
    placed = ranged.join(F.broadcast(offsets), F.col("range_no") == F.col("__range")).drop("__range", "nth", "range_no")
    schema = placed.drop("run").schema

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        url, page = table.column("url_key").chunk(0), table.column("page_id").chunk(0)
        time = table.column("captured_at").cast(pa.int64()).chunk(0)
        run = table.column("run").to_numpy()
        starts = [0, *(np.flatnonzero(run[1:] != run[:-1]) + 1).tolist(), len(run)]

        def piece(lo: int, hi: int) -> Iterator:
            for i in range(lo, hi):
                t, p = time[i].as_py(), page[i].as_py()
                yield (url[i].as_py().encode(), (t is not None, t or 0), (p is not None, p or 0)), i

        order = np.fromiter((i for _, i in LoserTree([piece(lo, hi) for lo, hi in zip(starts, starts[1:])])), np.int64, len(run))
        first = table.column("position")[0].as_py() + 1
        table = table.drop_columns(["run", "position"])
        for at in range(0, len(order), 10_000):
            part = table.take(pa.array(order[at:at + 10_000])).combine_chunks()
            n = part.num_rows
            yield from part.append_column("position", pa.array(np.arange(first + at, first + at + n))).to_batches()

    names = [c for c in schema.names if c != "position"]
    out = placed.select(*names, "run", "position").mapInArrow(merge, T.StructType([schema[c] for c in names] + [schema["position"]]))
    return out.select(*columns, "url_key", "position")


def capture_history(spark: SparkSession, path: str) -> DataFrame:
    """The ordered index of the archives under ``path``, without payloads."""
    return capture_index(read_archives(spark, path).drop("payload"))
