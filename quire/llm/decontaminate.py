"""Benchmark decontamination by greedy string tiling.

Tokens are lower-cased ``\\w+``.  Documents and benchmark items that share a
seed (``MIN_MATCH`` consecutive tokens, by rolling hash) are joined; for each
such pair the longest common token runs are tiled greedily without overlap
(longest first, found by running Karp-Rabin over the seeds), whatever their
order.  The share of the item's tokens under tiles is its coverage: a reordered
passage is covered as much as a verbatim one.  Pairs of at least ``COVERAGE``
are leaks.

Seeds of the benchmark go to the tasks while there are at most
``MAX_SENT_SEEDS`` of them; beyond that, document windows meet them in a
shuffle join, with the same result.

A phrase that many documents and many items share does not pair them up.  The
most frequent seeds of an item are set aside for as long as the tokens that they
span stay below what a leak has to cover: a document that holds none but these
cannot leak the item.  Only documents with one of the other, rarer seeds are
tiled, and they alone are looked up again by (document, seed).

A short item says little: one of fewer than two seeds' tokens (ten) leaks only where
all its tokens are covered, one of fewer tokens than a seed (five: "yes") never does.

Defined results: null and empty texts share nothing; items without tokens never
leak; rows that repeat
a document (id and text) or an item (id and text) give one pair; items that
share an id but not the text are covered separately and the best one counts;
empty tables give an empty result.  Extra columns are not read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import cut, small_batches
from quire.llm.hashing import WordHashes, mix, rolling_hashes

MIN_MATCH = 5                # tokens of a seed and of the shortest tile
COVERAGE = 0.5               # share of an item's tokens under tiles that makes a leak
MAX_SENT_SEEDS = 2_000_000   # 16 MB of hashes in every task at most

_TOKEN = re.compile(r"\w+")
_PRIME = (1 << 61) - 1


def tokens(text: str | None) -> list[str]:
    return _TOKEN.findall(text.lower()) if text else []


def seeds_of(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every ``width`` consecutive tokens; widths never mix."""
    return mix(rolling_hashes(words, width) + np.uint64(width))


def item_seeds(items: DataFrame, min_match: int = MIN_MATCH) -> DataFrame:
    """(item_id, item_key, n_tokens, width, seeds) for every distinct item of at least ``min_match`` tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            rows = []
            for item_id, key, text in zip(*(c.to_pylist() for c in batch.columns)):
                words = tokens(text)
                if len(words) >= min_match:
                    rows.append((item_id, key, len(words), min_match, seeds_of(known.array(words), min_match).view(np.int64)))
            columns = list(zip(*rows)) if rows else [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             names=["item_id", "item_key", "n_tokens", "width", "seeds"])

    return (items.select(F.col("item_id").cast("long").alias("item_id"), F.xxhash64("text").alias("item_key"), "text")
            .dropDuplicates(["item_id", "item_key"])
            .mapInArrow(run, "item_id long, item_key long, n_tokens int, width int, seeds array<long>"))


def _document_seeds(docs: DataFrame, widths: list[int], wanted) -> DataFrame:
    """(doc_id, text_hash, pos, seed): document windows, only those in ``wanted()`` if given."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, only = WordHashes(), wanted() if wanted else None
        for batch in batches:
            ids, keys, positions, found = [], [], [], []
            for doc_id, key, text in zip(*(c.to_pylist() for c in batch.columns)):
                words = known.array(tokens(text))
                for width in widths:
                    seeds = seeds_of(words, width)
                    at = np.arange(len(seeds))
                    if only is not None and len(seeds):
                        at = np.flatnonzero(only[np.minimum(np.searchsorted(only, seeds), len(only) - 1)] == seeds)
                    if len(at):
                        ids += [doc_id] * len(at)
                        keys += [key] * len(at)
                        positions.append(at.astype(np.int32))
                        found.append(seeds[at].view(np.int64))
                if len(ids) >= 1 << 18:
                    yield _seed_batch(ids, keys, positions, found)
                    ids, keys, positions, found = [], [], [], []
            if ids:
                yield _seed_batch(ids, keys, positions, found)

    return (small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
            .mapInArrow(run, "doc_id long, text_hash long, pos int, seed long"))


def _seed_batch(ids, keys, positions, found) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.int64()),
                                       pa.array(np.concatenate(positions)), pa.array(np.concatenate(found))],
                                      names=["doc_id", "text_hash", "pos", "seed"])


def seed_hits(docs: DataFrame, items: DataFrame, max_sent_seeds: int = MAX_SENT_SEEDS) -> DataFrame:
    """Document windows that are a seed of some item; ``items`` is the output of ``item_seeds``."""
    seeds = items.select(F.explode("seeds").alias("seed")).distinct()
    size = items.agg(F.sum(F.size("seeds")), F.collect_set("width")).first()  # widths: 1 to MIN_MATCH
    widths = sorted(size[1])
    if (size[0] or 0) > max_sent_seeds:
        return _document_seeds(docs, widths, None).join(seeds, "seed", "left_semi").select("doc_id", "text_hash", "pos", "seed")
    sent = docs.sparkSession.sparkContext.broadcast(
        np.sort(seeds.toArrow().column("seed").to_numpy().view(np.uint64)))
    return _document_seeds(docs, widths, lambda: sent.value)


def _rarest(held: list[dict], n_tokens: int, width: int, needed: float) -> list[int]:
    """Seeds of an item without which no document covers ``needed`` of its tokens.

    ``held`` lists (rows, seed, pos) of its seeds that any document holds.  Going from the
    most frequent seed down, a seed is set aside if the tokens under all that are set
    aside stay below the share; the others are returned.
    """
    places: dict[tuple[int, int], list[int]] = defaultdict(list)
    for h in held:
        places[-h["rows"], h["seed"]].append(h["pos"])
    spanned, size, kept = bytearray(n_tokens), 0, []
    for (_, seed), at in sorted(places.items()):
        new = {t for p in at for t in range(p, p + width) if not spanned[t]}
        if (size + len(new)) / n_tokens < needed:
            size += len(new)
            for t in new:
                spanned[t] = 1
        else:
            kept.append(seed)
    return kept


@F.arrow_udf(T.ArrayType(T.LongType()))
def _rarest_seeds(held: pa.Array, n_tokens: pa.Array, widths: pa.Array, needed: pa.Array) -> pa.Array:
    return pa.array([_rarest(*item) for item in zip(*(c.to_pylist() for c in (held, n_tokens, widths, needed)))], pa.list_(pa.int64()))


def rare_seeds(index: DataFrame, hits: DataFrame, min_match: int = MIN_MATCH, coverage: float = COVERAGE) -> DataFrame:
    """(item, seed): every document that leaks an item holds one of the item's seeds here."""
    rows = hits.groupBy("seed").agg(F.count(F.lit(1)).alias("rows"))
    held = (index.select("item", F.posexplode("seeds").alias("pos", "seed")).join(rows, "seed")
            .groupBy("item").agg(F.collect_list(F.struct("rows", "seed", "pos")).alias("held")))
    picked = _rarest_seeds("held", "n_tokens", "width", _needed(F.col("n_tokens"), min_match, coverage))
    return held.join(index.select("item", "n_tokens", "width"), "item").select("item", F.explode(picked).alias("seed"))


def _needed(n_tokens: Column, min_match: int, coverage: float) -> Column:
    """Share of an item of ``n_tokens`` tokens that a leak has to cover."""
    return F.when(n_tokens < 2 * min_match, 1.0).otherwise(F.lit(float(coverage)))


def _prefixes(values: list[int]) -> tuple[list[int], list[int]]:
    """Prefix hashes and powers for Karp-Rabin over a sequence."""
    sums, powers = [0], [1]
    for v in values:
        sums.append((sums[-1] * 1_000_003 + v) % _PRIME)
        powers.append(powers[-1] * 1_000_003 % _PRIME)
    return sums, powers


def tile(doc_seeds: dict[int, int], item: list[int], width: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (document token, item token, tokens) of one pair.

    ``doc_seeds`` maps token positions to seeds, ``item`` lists the item's
    seeds.  Matches of s or more seeds are searched for s = all of the item,
    then half, and so on; each time the longest among unmarked tokens is marked,
    ties by document and item position, until none is left.
    """
    positions = sorted(doc_seeds)
    sequence = [doc_seeds[p] for p in positions]
    run_end = [0] * len(positions)  # index after the last of consecutive positions
    for k in range(len(positions) - 1, -1, -1):
        joined = k + 1 < len(positions) and positions[k + 1] == positions[k] + 1
        run_end[k] = run_end[k + 1] if joined else k + 1
    d_sum, powers = _prefixes(sequence if len(sequence) >= len(item) else sequence + [0] * (len(item) - len(sequence)))
    i_sum, _ = _prefixes(item)

    def window(sums: list[int], at: int, size: int) -> int:
        return (sums[at + size] - sums[at] * powers[size]) % _PRIME

    item_marked = bytearray(len(item) + width - 1)
    doc_marked: set[int] = set()
    tiles: list[tuple[int, int, int]] = []

    def free(at: int, k: int) -> bool:
        """Can the seed at item position ``at`` and document index ``k`` lie in a tile?"""
        p = positions[k]
        return not any(item_marked[at:at + width]) and not any(p + x in doc_marked for x in range(width))

    size = min(len(item), len(sequence))
    while size:
        index = defaultdict(list)
        for at in range(len(item) - size + 1):
            if not any(item_marked[at:at + size + width - 1]):
                index[window(i_sum, at, size)].append(at)
        best: list[tuple[int, int, int]] = []  # (seeds, document index, item position)
        k = 0
        while index and k + size <= len(sequence):
            if run_end[k] < k + size:
                k = run_end[k]
                continue
            for at in index.get(window(d_sum, k, size), ()):
                n = 0
                while at + n < len(item) and k + n < run_end[k] and item[at + n] == sequence[k + n] and free(at + n, k + n):
                    n += 1
                if n >= size and (not best or n >= best[0][0]):
                    best = [(n, k, at)] if not best or n > best[0][0] else [*best, (n, k, at)]
            k += 1
        if not best:
            size //= 2
            continue
        for n, k, at in best:
            if free(at, k) and free(at + n - 1, k + n - 1):  # as long as any tile, so no tile lies inside
                length = n + width - 1
                tiles.append((positions[k], at, length))
                item_marked[at:at + length] = b"\x01" * length
                doc_marked.update(range(positions[k], positions[k] + length))
    return tiles


TILING = T.StructType([T.StructField("covered", T.IntegerType()), T.StructField("tiles", T.ArrayType(T.StructType([
    T.StructField("doc_token", T.IntegerType()), T.StructField("item_token", T.IntegerType()),
    T.StructField("n_tokens", T.IntegerType())])))])

_TILING_ARROW = pa.struct([("covered", pa.int32()), ("tiles", pa.list_(pa.struct([
    ("doc_token", pa.int32()), ("item_token", pa.int32()), ("n_tokens", pa.int32())])))])


@F.arrow_udf(TILING)
def _tilings(hits: pa.Array, seeds: pa.Array, widths: pa.Array) -> pa.Array:
    out = []
    for own, item, width in zip(hits.to_pylist(), seeds.to_pylist(), widths.to_pylist()):
        tiles = tile({h["pos"]: h["seed"] for h in own}, item, width)
        out.append({"covered": sum(t[2] for t in tiles),
                    "tiles": [dict(zip(("doc_token", "item_token", "n_tokens"), t)) for t in sorted(tiles)]})
    return pa.array(out, _TILING_ARROW)


def leaks(docs: DataFrame, items: DataFrame, min_match: int = MIN_MATCH, coverage: float = COVERAGE,
          max_sent_seeds: int = MAX_SENT_SEEDS) -> DataFrame:
    """(doc_id, text_hash, item_id, item_tokens, covered, coverage, tiles) for every
    document and item whose tiles cover at least ``coverage`` of the item (all of an
    item of fewer than 2 * ``min_match`` tokens)."""
    # numbers given to written rows do not change when a task runs again
    index = cut(item_seeds(items, min_match)).withColumn("item", F.monotonically_increasing_id())
    hits = cut(seed_hits(docs, index, max_sent_seeds).distinct())
    held = hits.select(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__text"), "pos", "seed")
    candidates = (hits.join(rare_seeds(index, hits, min_match, coverage), "seed").select("doc_id", "text_hash", "item").distinct())
    asked = candidates.join(index.select("item", F.explode(F.array_distinct("seeds")).alias("asked")), "item")
    pairs = (asked.join(held, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("text_hash") == F.col("__text"))
                        & (F.col("asked") == F.col("seed")))
             .groupBy("doc_id", "text_hash", "item").agg(F.collect_list(F.struct("pos", "seed")).alias("hits")))
    tiled = (pairs.join(index, "item")
             .select("doc_id", "text_hash", "item_id", F.col("n_tokens").alias("item_tokens"),
                     _tilings("hits", "seeds", "width").alias("t")))
    found = tiled.select("doc_id", "text_hash", "item_id", "item_tokens", F.col("t.covered").alias("covered"),
                         (F.col("t.covered") / F.col("item_tokens")).alias("coverage"), F.col("t.tiles").alias("tiles"))
    best = F.max_by(F.struct("item_tokens", "covered", "coverage", "tiles"),
                    F.struct("coverage", "item_tokens")).alias("best")
    needed = _needed(F.col("item_tokens"), min_match, coverage)
    return (found.filter(F.col("coverage") >= needed).groupBy("doc_id", "text_hash", "item_id").agg(best)
            .select("doc_id", "text_hash", "item_id", "best.*"))


def drop_leaks(docs: DataFrame, items: DataFrame, min_match: int = MIN_MATCH, coverage: float = COVERAGE) -> DataFrame:
    """The rows of ``docs`` that leak no item, unchanged."""
    found = (leaks(docs, items, min_match, coverage).select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
             .distinct())
    same = docs["doc_id"].cast("long").eqNullSafe(found["__id"]) & (F.xxhash64(docs["text"]) == found["__hash"])
    return docs.join(found, same, "left_anti")
