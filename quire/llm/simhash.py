"""SimHash near-duplicates by deletion-variant signatures.

A text's fingerprint has bit b set if over half of its shingle hashes do.  Two
fingerprints of at most ``d`` differing bits, cut into d // 2 + 1 segments,
have one segment that differs by at most one bit: so every segment is indexed
under its one-wildcard variants (one bit blanked out, for each bit), variants
are equality-joined and the pairs verified on all 64 bits.

A variant shared by more than ``MAX_BUCKET`` fingerprints (a large family of
near copies) is not paired up: its members are linked exactly through all
fingerprints one bit away from them.  Two members are within two bits if and
only if they share such a neighbour, a neighbour has at most 65 members, and
linking each to the smallest one keeps every connection.

Defined results: a null or wordless text has fingerprint zero and is linked
like any other; repeated rows are kept, each with its component; a null id
never names a component unless all ids of it are null; an empty table gives an
empty result.  Extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import as_bytes, byte_words, cut, small_batches
from quire.llm.components import components

SHINGLE = 3
MAX_DISTANCE = 2
MAX_BUCKET = 32      # larger buckets take the exact route for families
HASH_SEED = 42
_CHUNK = 1 << 16     # shingle hashes unpacked into bits at once


def simhash(data: bytes | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint of a UTF-8 text."""
    words = byte_words(data.lower() if data else data)  # bytes.lower changes A-Z only
    if not words:
        return 0
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(g, HASH_SEED) for g in grams], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _CHUNK):
        part = hashes[at:at + _CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprint(text: Column | str, shingle: int = SHINGLE) -> Column:
    """Fingerprint of a text column as a long (the same 64 bits, signed)."""
    @F.arrow_udf("long")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array(np.array([simhash(x, shingle) for x in as_bytes(texts)], np.uint64).view(np.int64))

    return run(F.col(text) if isinstance(text, str) else text)


def _distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def variants(fp: str, max_distance: int) -> Column:
    """Array of the one-wildcard variants of all segments, each tagged with segment and bit:
    one number (tag above the segment) where segments have at most 32 bits."""
    n = max_distance // 2 + 1
    width = 64 // n
    keys = []
    for s in range(n):
        bits = 64 - width * s if s == n - 1 else width  # the last segment takes what is left
        for b in range(bits):
            mask = ((1 << bits) - 1) & ~(1 << b)
            segment = F.shiftrightunsigned(fp, width * s).bitwiseAND(F.lit(mask if mask < 1 << 63 else mask - (1 << 64)))
            slot = s * 64 + b
            keys.append(segment.bitwiseOR(F.lit(slot << 32).cast("long")) if bits <= 32 else
                        F.struct(F.lit(slot).cast("short").alias("slot"), segment.alias("bits")))
    return F.array(*keys)


def links(fps: DataFrame, max_distance: int = MAX_DISTANCE, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """Edges (u, v) between distinct fingerprints ``fp`` whose components are those
    of all pairs within ``max_distance`` (0 to 2) bits."""
    if not 0 <= max_distance <= 2:
        raise ValueError("max_distance must be 0, 1 or 2")
    # AQE leaves few, small partitions of fingerprints, which grow 64-fold here.
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = fps.repartition(parts, "fp").select("fp", F.explode(variants("fp", max_distance)).alias("key"))
    # Keys and fingerprints meet in one exchange; only keys that several share go on.
    more = cut(keyed.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("key"))).filter("n > 1"))
    small = more.filter(F.col("n") <= max_bucket)
    joined = (small.select("key", F.col("fp").alias("u")).join(small.select("key", F.col("fp").alias("v")), "key")
              .filter((F.col("u") < F.col("v")) & (_distance("u", "v") <= max_distance)).select("u", "v"))
    family = more.filter(F.col("n") > max_bucket).select("fp").distinct()
    ball = [F.col("fp")] + [F.col("fp").bitwiseXOR(F.lit(1 << b if b < 63 else -(1 << 63))) for b in range(64)]
    near = (family.select("fp", F.explode(F.array(*ball)).alias("center"))
            .groupBy("center").agg(F.collect_list("fp").alias("members")).filter(F.size("members") > 1))
    if max_distance < 2:  # only a centre that is itself a member is one bit away
        near = near.filter(F.array_contains("members", F.col("center"))).withColumn("u", F.col("center"))
    else:
        near = near.withColumn("u", F.array_min("members"))
    near = near.select("u", F.explode("members").alias("v")).filter((F.col("u") != F.col("v")) & F.lit(max_distance > 0))
    return joined.union(near).distinct()


def _classes(marked: DataFrame, max_distance: int, max_bucket: int) -> DataFrame:
    """(fp, first, root) of every distinct fingerprint of ``marked`` (doc_id, fp): its smallest doc_id and its component."""
    fps = cut(marked.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(links(fps, max_distance, max_bucket)).withColumnRenamed("node", "fp")
    return fps.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE,
                    max_bucket: int = MAX_BUCKET) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``.

    ``component_id`` is the smallest doc_id reachable over links.  Copies share
    a fingerprint, so linking and contraction see distinct fingerprints only.
    """
    marked = cut(small_batches(docs).select("doc_id", fingerprint("text", shingle).alias("fp")))
    classes = _classes(marked, max_distance, max_bucket)
    named = (classes.join(classes.groupBy("root").agg(F.min("first").alias("component_id")), "root")
             .select("fp", "component_id"))
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """``docs`` with one row of each group: that of the smallest doc_id, of those the smallest hash of the text.

    Groups are told apart by their fingerprints, not by ids: rows that repeat an id
    with unrelated texts are in groups of their own, and each group keeps a row.
    A row without id stays if no row of its group has one; of identical rows (id
    and text) one stays.
    """
    text_hash = F.xxhash64("text")
    marked = cut(small_batches(docs).select("doc_id", fingerprint("text", shingle).alias("fp"), text_hash.alias("text_hash")))
    row = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash", "fp")
    # Combined per fingerprint before the groups meet.
    by_fp = marked.groupBy("fp").agg(F.min(row).alias("best"))
    classes = _classes(marked, max_distance, MAX_BUCKET).select("fp", "root")
    best = by_fp.join(classes, "fp").groupBy("root").agg(F.min("best").alias("best")).select("best.doc_id", "best.text_hash")
    chosen = best.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
    copies = marked.groupBy("doc_id", "text_hash").count().filter("count > 1")
    stay = cut(chosen.join(copies, F.col("__id").eqNullSafe(F.col("doc_id")) & (F.col("__hash") == F.col("text_hash")), "left")
               .select("__id", "__hash", F.col("count").isNotNull().alias("__repeated")))
    # columns are named through their frames: ``docs`` may have any others
    same = docs["doc_id"].eqNullSafe(stay["__id"]) & (F.xxhash64(docs["text"]) == stay["__hash"])
    kept = docs.join(stay.filter("NOT __repeated"), same, "left_semi")
    repeated = stay.filter("__repeated")
    if repeated.isEmpty():
        return kept
    again = docs.join(repeated, docs["doc_id"].eqNullSafe(repeated["__id"]) & (F.xxhash64(docs["text"]) == repeated["__hash"]))
    return kept.unionByName(again.dropDuplicates(["__id", "__hash"]).drop("__id", "__hash", "__repeated"))
