"""Mixing sources to target weights in fixed-length blocks.

Every source's documents, in pseudorandom order, form one stream of words cut
into blocks of ``BLOCK_WORDS``.  The mix is a sequence of output shards of
``SHARD_SLOTS`` slots; each shard draws how many slots each source fills (the
whole part of its expected number, and a multinomial draw over what is left).
A source's slots, numbered through all shards, run through one pseudorandom
permutation of its block indices after the other, so a block comes a second
time only after all of its source came once.  Blocks join their slots by
(source, index).

Targets: sources by code point, null last, weigh ``WEIGHTS`` in turn and share
the words of all documents; none gets over ``MAX_REPEATS`` times its own words,
and what it cannot take goes to the others by weight.  Slots that a draw gives a
source beyond ``MAX_REPEATS`` rounds stay empty, so no document is taken more
often.

Defined results: a null or empty text has size zero and is never taken; a null
source is a source of its own; rows that repeat a document are documents of
their own; an empty table gives an empty mix; a rerun gives the same mix.
More than ``MAX_SOURCES`` sources raise an error (one number per source goes to
every task).  Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import as_bytes, byte_words, n_words, small_batches

BLOCK_WORDS = 128
SHARD_SLOTS = 1024
WEIGHTS = (5.0, 2.0, 1.0)
MAX_REPEATS = 3
MAX_SOURCES = 1_000_000
BUCKET_ROWS = 5_000  # documents that one window partition orders
SEED = 20


@dataclass
class Plan:
    """Per source, in code point order (null last): words, documents, target and slots."""

    names: list
    sizes: np.ndarray
    rows: np.ndarray
    targets: np.ndarray
    block_words: int

    @property
    def n_blocks(self) -> np.ndarray:
        return -(-self.sizes // self.block_words)

    @property
    def slots(self) -> np.ndarray:
        """Expected slots: target divided by the mean block length."""
        return np.where(self.sizes > 0, self.targets * self.n_blocks / np.maximum(self.sizes, 1), 0.0)


def share_out(sizes: np.ndarray, weights: np.ndarray, max_repeats: float = MAX_REPEATS) -> np.ndarray:
    """Share sum(sizes) by weight, capped at ``max_repeats`` times each size, the
    excess shared again by weight among those below their cap."""
    caps = max_repeats * sizes.astype(float)
    targets, open_ = np.zeros(len(sizes)), np.ones(len(sizes), bool)
    while open_.any():
        level = (sizes.sum() - targets[~open_].sum()) / weights[open_].sum()
        over = open_ & (level * weights > caps)
        if not over.any():
            targets[open_] = level * weights[open_]
            break
        targets[over] = caps[over]
        open_ &= ~over
    return targets


def plan_sources(sized: DataFrame, block_words: int = BLOCK_WORDS, weights=WEIGHTS, max_repeats: float = MAX_REPEATS) -> Plan:
    """Totals of all documents by source, and what the mix takes from each."""
    totals = (sized.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows"))
              .limit(MAX_SOURCES + 1).collect())
    if len(totals) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    totals.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
    sizes = np.array([r["size"] for r in totals], np.int64)
    w = np.array([weights[i % len(weights)] for i in range(len(totals))])
    return Plan([r["source"] for r in totals], sizes, np.array([r["rows"] for r in totals], np.int64),
                share_out(sizes, w, max_repeats), block_words)


def with_size(docs: DataFrame, keep_text: bool = False) -> DataFrame:
    """(doc_id, source, size, text_hash[, text]) for every row."""
    columns = ["doc_id", F.col("source").cast("string").alias("source"), n_words("text").alias("size"),
               F.xxhash64("text").alias("text_hash")]
    return docs.select(*columns, *(["text"] if keep_text else []))


def _source_table(sized: DataFrame, plan: Plan) -> DataFrame:
    """One row per source; at most MAX_SOURCES rows, so joins may broadcast it."""
    rows = [(i, n, int(s), float(t)) for i, (n, s, t) in enumerate(zip(plan.names, plan.sizes, plan.targets))]
    return sized.sparkSession.createDataFrame(rows, "source_no int, name string, source_size long, target double")


def place(sized: DataFrame, plan: Plan) -> DataFrame:
    """``sized`` with source_no, source_size, target and ``start``: the document's
    first word in its source's stream.

    Streams are ordered by a hash of the id.  A source's rows are spread over
    hash ranges (``BUCKET_ROWS`` rows each), ordered in parallel and offset by
    the totals of the ranges before.
    """
    n_buckets = int(max(1, -(-int(plan.rows.max(initial=1)) // BUCKET_ROWS)))
    known = sized.join(F.broadcast(_source_table(sized, plan)), F.col("source").eqNullSafe(F.col("name"))).drop("name")
    spread = known.withColumn("order", F.xxhash64("doc_id", F.lit(SEED))).withColumn("bucket", F.pmod("order", F.lit(n_buckets)))
    inside = (Window.partitionBy("source_no", "bucket").orderBy("order", "doc_id", "size", "text_hash")
              .rowsBetween(Window.unboundedPreceding, -1))
    before = Window.partitionBy("source_no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (spread.groupBy("source_no", "bucket").agg(F.sum("size").alias("words"))
               .select("source_no", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("offset")))
    return (spread.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
            .join(offsets, ["source_no", "bucket"]).withColumn("start", F.col("offset") + F.col("inside"))
            .drop("order", "bucket", "offset", "inside"))


def blocks(placed: DataFrame, block_words: int = BLOCK_WORDS, keep_text: bool = False) -> DataFrame:
    """(source_no, block, parts): each block's pieces of documents in stream order.

    A part is (at, doc_id, start, from_word, n_words[, text]): its place in the
    block, the document and its place in the stream, and the words it gives.
    A block has at most ``block_words`` parts.
    """
    @F.arrow_udf("array<string>")
    def pieces(texts: pa.Array, starts: pa.Array) -> pa.Array:
        out = []
        for text, start in zip(as_bytes(texts), starts.to_pylist()):
            words = byte_words(text)
            first = block_words - start % block_words
            ends = [0, *range(first, len(words), block_words), len(words)]
            out.append([b" ".join(words[a:b]).decode() for a, b in zip(ends, ends[1:])])
        return pa.array(out, pa.list_(pa.string()))

    some = small_batches(placed).filter("size > 0")
    first, last = F.floor(F.col("start") / block_words), F.floor((F.col("start") + F.col("size") - 1) / block_words)
    keys = ["source_no", "doc_id", "start", "size"]
    if keep_text:
        cut_up = some.select(*keys, first.alias("first"), F.posexplode(pieces("text", "start")).alias("pos", "text"))
        cut_up = cut_up.withColumn("block", F.col("first") + F.col("pos"))
    else:
        cut_up = some.select(*keys, F.explode(F.sequence(first, last)).alias("block"))
    begin = F.col("block") * block_words
    lo = F.greatest(begin, F.col("start"))
    hi = F.least(begin + block_words, F.col("start") + F.col("size"))
    part = F.struct((lo - begin).alias("at"), "doc_id", "start", (lo - F.col("start")).alias("from_word"),
                    (hi - lo).alias("n_words"), *(["text"] if keep_text else []))
    return (cut_up.select("source_no", "block", part.alias("part")).groupBy("source_no", "block")
            .agg(F.sort_array(F.collect_list("part")).alias("parts")))


def shard_counts(shard: int, n_slots: int, share: np.ndarray, seed: int = SEED) -> np.ndarray:
    """Slots per source of one shard: whole parts of the expectation, then a multinomial draw."""
    expected = n_slots * share
    counts = np.floor(expected + 1e-9).astype(np.int64)
    left = n_slots - int(counts.sum())
    if left > 0:
        rest = np.maximum(expected - counts, 0)
        rest = rest if rest.sum() > 0 else share
        counts = counts + np.random.default_rng([seed, shard]).multinomial(left, rest / rest.sum())
    return counts


def permute(index: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A bijection of [0, n) chosen by ``key``: four Feistel rounds on the next even
    number of bits, repeated until the value is below n."""
    half = np.maximum((np.ceil(np.log2(np.maximum(n, 2).astype(float))).astype(np.uint64) + np.uint64(1)) // np.uint64(2),
                      np.uint64(1))
    mask = (np.uint64(1) << half) - np.uint64(1)
    x, todo = index.astype(np.uint64), np.ones(len(index), bool)
    while todo.any():
        v, h, m, k = x[todo], half[todo], mask[todo], key[todo].astype(np.uint64)
        left, right = v >> h, v & m
        for i in range(4):
            f = (right + k + np.uint64(i)) * np.uint64(0x9E3779B97F4A7C15)
            f = (f ^ (f >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((f ^ (f >> np.uint64(32))) & m)
        x[todo] = (left << h) | right
        todo = x >= n.astype(np.uint64)
    return x.astype(np.int64)


def slots(spark, plan: Plan, shard_slots: int = SHARD_SLOTS, max_repeats: int = MAX_REPEATS, seed: int = SEED) -> DataFrame:
    """(shard, slot, source_no, epoch, block) for every slot of the mix."""
    expected = plan.slots
    total = int(np.ceil(expected.sum() - 1e-6))
    share = expected / expected.sum() if total else expected
    n_shards = -(-total // shard_slots)

    def size(shard: int) -> int:
        return min(shard_slots, total - shard * shard_slots)

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                c = shard_counts(shard, size(shard), share, seed)
                used = np.flatnonzero(c)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(used), shard)), pa.array(used.astype(np.int32)),
                                                  pa.array(c[used])], names=["shard", "source_no", "n"])

    def orders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                c = shard_counts(shard, size(shard), share, seed)
                who = np.repeat(np.arange(len(c), dtype=np.int32), c)
                nth = np.arange(len(who)) - np.repeat(c.cumsum() - c, c)
                at = np.random.default_rng([seed, shard, 1]).permutation(len(who))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(who), shard)), pa.array(at.astype(np.int32)),
                                                  pa.array(who), pa.array(nth)], names=["shard", "slot", "source_no", "nth"])

    shards = spark.range(n_shards)
    before = Window.partitionBy("source_no").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (shards.mapInArrow(counts, "shard long, source_no int, n long")
               .select("shard", "source_no", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")))
    n_blocks = plan.n_blocks
    sent = np.maximum(n_blocks, 1)

    @F.arrow_udf("long")
    def block(source_no: pa.Array, k: pa.Array) -> pa.Array:
        s, k = source_no.to_numpy(zero_copy_only=False), k.to_numpy(zero_copy_only=False)
        n = sent[s]
        return pa.array(permute(k % n, n, (s.astype(np.int64) << 32) + (k // n) * 7919 + seed))

    @F.arrow_udf("int")
    def epoch(source_no: pa.Array, k: pa.Array) -> pa.Array:
        return pa.array((k.to_numpy(zero_copy_only=False) // sent[source_no.to_numpy(zero_copy_only=False)]).astype(np.int32))

    # merge joins: a range of shards looks tiny to the planner, but each becomes many slots
    numbered = (shards.mapInArrow(orders, "shard long, slot int, source_no int, nth long")
                .join(offsets.hint("merge"), ["shard", "source_no"])
                .select("shard", "slot", "source_no", (F.col("before") + F.col("nth")).alias("k")))
    return (numbered.select("shard", "slot", "source_no", epoch("source_no", "k").alias("epoch"),
                            block("source_no", "k").alias("block")).filter(F.col("epoch") < max_repeats))


def mix(placed: DataFrame, plan: Plan, keep_text: bool = False) -> DataFrame:
    """(shard, slot, source_no, epoch, block, parts) for every filled slot."""
    packed = blocks(placed, plan.block_words, keep_text)
    return slots(placed.sparkSession, plan).hint("merge").join(packed, ["source_no", "block"])


def taken(placed: DataFrame, plan: Plan) -> DataFrame:
    """Every row of ``placed`` with ``taken``: its words in the mix, repeats counted."""
    part = F.explode("parts").alias("part")
    words = (mix(placed, plan).select("source_no", part).groupBy("source_no", F.col("part.start").alias("start"))
             .agg(F.sum("part.n_words").alias("taken")))
    some = placed.filter("size > 0").join(words, ["source_no", "start"], "left")
    return (some.unionByName(placed.filter("size = 0").withColumn("taken", F.lit(0).cast("long")))
            .withColumn("taken", F.coalesce("taken", F.lit(0))))


def mixed_texts(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix itself: (shard, slot, source, epoch, block, n_words, doc_ids, text) per filled slot."""
    plan = plan_sources(with_size(docs), block_words)
    placed = place(with_size(docs, keep_text=True), plan)
    names = _source_table(placed, plan).select("source_no", F.col("name").alias("source"))
    return mix(placed, plan, keep_text=True).join(F.broadcast(names), "source_no").select(
        "shard", "slot", "source", "epoch", "block",
        F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + p["n_words"]).alias("n_words"),
        F.transform("parts", lambda p: p["doc_id"]).alias("doc_ids"),
        F.array_join(F.transform("parts", lambda p: p["text"]), " ").alias("text"))
