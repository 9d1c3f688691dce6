"""Substring dedup: repeated fixed-length word windows, cut out of all texts.

Every window of ``WINDOW`` words gets a Rabin-Karp hash (all prefix sums of one
text at once).  Counting them as one row each would shuffle a multiple of the
input, so windows travel in groups: a window's minimizer is the smallest hash
among its ``GRAM``-word subwindows; equal windows have equal minimizers, and
consecutive windows mostly share theirs.  One row per minimizer occurrence
carries the hashes of its windows (about 14), rows meet by minimizer, and
hashes found twice there are the repeated windows.  No window is left out.
A minimizer of more than ``GROUP_ROWS`` rows does not meet in one task: its rows
stay dealt out, and their windows are counted one row each.  Such groups are large,
so their windows carry all eight bytes of their hashes instead of six.

Copies are pre-aggregated: of windows that repeat within one task's chunk one
stands for all, and the chunk already knows they repeat.  So a passage shared
by a third of the corpus reaches its reducer once per chunk.

Overlapping repeated windows merge into maximal removal intervals, which are
joined back to their texts.

Defined results: a null text has no words; texts shorter than a window lose
nothing; a window that repeats inside its own text counts, overlapping or not;
rows that repeat an id are documents of their own (a repeated row of at least
one window loses everything); an empty table gives an empty result.  Extra
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import as_bytes, byte_words, cut, small_batches
from quire.llm.hashing import WordHashes, rolling_hashes

WINDOW = 35
GRAM = 8
HASH_BYTES = 6            # of a window, beside the 8 of its minimizer
WIDE_BYTES = 8            # of a window whose minimizer is frequent
CHUNK_WINDOWS = 1 << 20   # windows that one task compares locally at a time
GROUP_ROWS = 20_000       # rows of one minimizer that meet in one task, some 30 MB
MAX_SENT_HOT = 1_000_000  # frequent minimizers that every task is sent, 8 MB; more meet their rows in a shuffle
_SLICE = 1 << 16

OCCURRENCES = ("minimizer long, doc_id long, text_hash long, start int, stop int, windows binary")
SPANS = "doc_id long, text_hash long, start int, stop int"


def minimizers(grams: np.ndarray, span: int) -> np.ndarray:
    """Position of the leftmost smallest of every ``span`` consecutive values."""
    out = []
    for at in range(0, len(grams) - span + 1, _SLICE):
        view = sliding_window_view(grams[at:at + _SLICE + span - 1], span)
        out.append(view.argmin(axis=1) + np.arange(at, at + len(view)))
    return np.concatenate(out) if out else np.empty(0, np.int64)


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the stretches of True."""
    edge = np.diff(np.concatenate([[0], mask.view(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _binary(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1,
                                 [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])


def _short(hashes: np.ndarray, width: int) -> np.ndarray:
    """The low ``width`` bytes of each hash."""
    return np.ascontiguousarray(hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width])


class _Chunk:
    """Windows of some texts, before they leave their task with ``width`` bytes each,
    those of the minimizers ``wide`` with WIDE_BYTES."""

    def __init__(self, window: int, gram: int, width: int, wide: np.ndarray | None):
        self.window, self.gram, self.width, self.wide, self.parts, self.size = window, gram, width, wide, [], 0

    def add(self, doc_id: int | None, text_hash: int, words: np.ndarray) -> None:
        hashes = rolling_hashes(words, self.window)
        if not len(hashes):
            return
        grams = rolling_hashes(words, self.gram)
        at = minimizers(grams, self.window - self.gram + 1)
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        self.parts.append((doc_id, text_hash, hashes, first, grams[at[first]]))
        self.size += len(hashes)

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.parts:
            return
        parts, self.parts, self.size = self.parts, [], 0
        sizes = np.array([len(p[2]) for p in parts])
        base = np.concatenate([[0], sizes.cumsum()])
        hashes = np.concatenate([p[2] for p in parts])
        order = np.argsort(hashes, kind="stable")
        same = hashes[order][1:] == hashes[order][:-1]
        head = np.empty(len(hashes), bool)       # first of its equals
        head[order] = np.concatenate([[True], ~same])
        twin = np.empty(len(hashes), bool)       # has an equal in this chunk
        twin[order] = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        # occurrences: a run of windows travels if it holds the first of some equals
        first = np.concatenate([p[3] + b for p, b in zip(parts, base)])
        last = np.concatenate([first[1:], [len(hashes)]])
        owner = np.repeat(np.arange(len(parts)), [len(p[3]) for p in parts])
        minimizer = np.concatenate([p[4] for p in parts]).view(np.int64)
        sent = np.add.reduceat(head, first) > 0
        # spans: what is known to repeat already
        lo, hi, who = [], [], []
        for k, b in enumerate(base[:-1]):
            own = twin[b:b + sizes[k]]
            if own.any():
                starts, ends = _runs(own)
                lo.append(starts), hi.append(ends + self.window - 1), who.append(np.full(len(starts), k))
        ids = [p[0] for p in parts]
        text_hashes = np.array([p[1] for p in parts], np.int64)
        hot = np.zeros(len(sent), bool) if self.wide is None else np.isin(minimizer, self.wide)
        for some, width in ((sent & ~hot, self.width), (sent & hot, WIDE_BYTES)):
            if some.any():
                lengths = last[some] - first[some]
                inside = np.zeros(len(hashes) + 1, np.int32)
                np.add.at(inside, first[some], 1)
                np.add.at(inside, last[some], -1)
                data = _short(hashes[np.cumsum(inside[:-1]) > 0], width)
                windows = _binary(data, np.concatenate([[0], lengths.cumsum()]) * width)
                yield self._batch(minimizer[some], owner[some], first[some] - base[owner[some]], None, windows, ids, text_hashes)
        if who:
            who = np.concatenate(who)
            yield self._batch(text_hashes[who], who, np.concatenate(lo), np.concatenate(hi), None, ids, text_hashes)

    @staticmethod
    def _batch(minimizer, owner, start, stop, windows, ids, text_hashes) -> pa.RecordBatch:
        n = len(owner)
        return pa.RecordBatch.from_arrays(
            [pa.array(minimizer, pa.int64()), pa.array([ids[k] for k in owner.tolist()], pa.int64()),
             pa.array(text_hashes[owner], pa.int64()), pa.array(start.astype(np.int32)),
             pa.nulls(n, pa.int32()) if stop is None else pa.array(stop.astype(np.int32)),
             pa.nulls(n, pa.binary()) if windows is None else windows],
            names=["minimizer", "doc_id", "text_hash", "start", "stop", "windows"])


def occurrences(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, width: int = HASH_BYTES,
                wide: np.ndarray | None = None) -> DataFrame:
    """Rows of ``OCCURRENCES``: window hashes by minimizer occurrence (``windows`` set, ``width``
    bytes each, WIDE_BYTES under the minimizers ``wide``), or spans that repeat within their task (``stop`` set)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, chunk = WordHashes(), _Chunk(window, gram, width, wide)
        for batch in batches:
            for doc_id, text_hash, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                               as_bytes(batch.column(2))):
                words = byte_words(text)
                if len(words) >= window:
                    chunk.add(doc_id, text_hash, known.array(words))
                    if chunk.size >= CHUNK_WINDOWS:
                        yield from chunk.flush()
        yield from chunk.flush()

    texts = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return texts.mapInArrow(run, OCCURRENCES)


def frequent(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, rows: int = GROUP_ROWS) -> DataFrame:
    """(minimizer) of more than ``rows`` rows of ``occurrences``."""
    found = occurrences(docs, window, gram, width=0).filter(F.col("stop").isNull())
    return found.groupBy("minimizer").count().filter(F.col("count") > rows).select("minimizer")


def _counted(rows: DataFrame, window: int) -> DataFrame:
    """Spans of the windows that occur twice or more in ``rows`` of ``OCCURRENCES`` (WIDE_BYTES a window), one row for each window."""
    hexed, digits = F.hex("windows"), 2 * WIDE_BYTES
    places = F.sequence(F.lit(0), (F.octet_length("windows") / WIDE_BYTES).cast("int") - 1)
    single = (rows.select("minimizer", "doc_id", "text_hash", "start", hexed.alias("hexed"), F.explode(places).alias("place"))
              .select("minimizer", "doc_id", "text_hash", (F.col("start") + F.col("place")).alias("start"),
                      F.substr("hexed", F.col("place") * digits + 1, F.lit(digits)).alias("hash")))
    repeated = single.groupBy("minimizer", "hash").count().filter("count > 1").select("minimizer", "hash")
    return single.join(repeated, ["minimizer", "hash"]).select("doc_id", "text_hash", "start", (F.col("start") + window).alias("stop"))


def _meet(table: pa.Table, window: int, width: int) -> Iterator[pa.RecordBatch]:
    """Spans of the windows (``width`` bytes each) that occur twice or more among complete minimizer groups."""
    table = table.combine_chunks()
    key = table.column("minimizer").to_numpy()
    near = key[1:] == key[:-1]
    shared = np.concatenate([[False], near]) | np.concatenate([near, [False]])
    if not shared.any():
        return
    table = table.filter(pa.array(shared)).combine_chunks()
    blobs = table.column("windows").combine_chunks()
    blobs = blobs.chunk(0) if isinstance(blobs, pa.ChunkedArray) else blobs
    offsets = np.frombuffer(blobs.buffers()[1], np.int32, len(blobs) + 1, blobs.offset * 4)
    raw = np.frombuffer(blobs.buffers()[2], np.uint8)[offsets[0]:offsets[-1]].reshape(-1, width)
    hashes = np.zeros((len(raw), 8), np.uint8)
    hashes[:, :width] = raw
    hashes = hashes.view("<u8").ravel()
    lengths = np.diff(offsets) // width
    row = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(hashes)) - np.repeat(np.concatenate([[0], lengths.cumsum()[:-1]]), lengths)
    group = table.column("minimizer").to_numpy()[row]
    order = np.lexsort((hashes, group))
    same = (hashes[order][1:] == hashes[order][:-1]) & (group[order][1:] == group[order][:-1])
    twin = np.empty(len(hashes), bool)
    twin[order] = np.concatenate([[False], same]) | np.concatenate([same, [False]])
    if not twin.any():
        return
    # a stretch ends with its row
    begins = twin & ~(np.concatenate([[False], twin[:-1]]) & (place > 0))
    follows = np.concatenate([place[1:], [0]]) > 0
    ends = twin & ~(np.concatenate([twin[1:], [False]]) & follows)
    a, b = np.flatnonzero(begins), np.flatnonzero(ends)
    start = table.column("start").to_numpy()
    picked = pa.array(row[a])
    yield pa.RecordBatch.from_arrays(
        [table.column("doc_id").combine_chunks().take(picked), table.column("text_hash").combine_chunks().take(picked),
         pa.array((start[row[a]] + place[a]).astype(np.int32)),
         pa.array((start[row[b]] + place[b] + window).astype(np.int32))],
        names=["doc_id", "text_hash", "start", "stop"])


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, rows: int = GROUP_ROWS,
                   max_sent_hot: int = MAX_SENT_HOT) -> DataFrame:
    """Word spans (doc_id, text_hash, start, stop) covered by repeated windows; spans may overlap."""
    hot = cut(frequent(docs, window, gram, rows))
    n_hot = hot.count()
    few = n_hot <= max_sent_hot
    width = HASH_BYTES if few else WIDE_BYTES
    found = occurrences(docs, window, gram, width, np.sort(hot.toArrow().column(0).to_numpy()) if n_hot and few else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []  # rows of the last minimizer seen
        for batch in batches:
            known = batch.filter(batch.column("stop").is_valid())
            if known.num_rows:
                yield known.select(["doc_id", "text_hash", "start", "stop"])
            batch = batch.filter(batch.column("windows").is_valid())
            if not batch.num_rows:
                continue
            key = batch.column("minimizer").to_numpy()
            # rows from ``tail`` on hold the last minimizer, which the next batch may continue
            tail = len(key) - int((key[::-1] != key[-1]).argmax()) if key[0] != key[-1] else 0
            if tail or (waiting and waiting[-1].column("minimizer")[0].as_py() != key[0]):
                yield from _meet(pa.Table.from_batches([*waiting, batch.slice(0, tail)]), window, width)
                waiting = []
            waiting.append(batch.slice(tail))
        if waiting:
            yield from _meet(pa.Table.from_batches(waiting), window, width)

    if not n_hot:
        return found.repartition("minimizer").sortWithinPartitions("minimizer").mapInArrow(run, SPANS)
    # spans known from a chunk hold the text hash in place of a minimizer
    apart = F.col("hot").isNotNull() & F.col("stop").isNull()
    flagged = hot.withColumn("hot", F.lit(True))
    marked = found.join(F.broadcast(flagged) if few else flagged, "minimizer", "left").withColumn("apart", apart)
    salt = F.when(F.col("apart"), F.pmod(F.xxhash64("doc_id", "text_hash", "start"), F.lit(1 << 16))).otherwise(0)

    def run_apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The spans of all but the frequent rows, which come last and stay as they are."""
        names, last = ["minimizer", "doc_id", "text_hash", "start", "stop", "windows"], []

        def others() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n = batch.column("apart").false_count
                if n:
                    yield batch.slice(0, n).select(names)
                if n < batch.num_rows:
                    last.append(batch.slice(n).select(names))
                    return

        for spans in run(others()):
            n = spans.num_rows
            yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()), *spans.columns, pa.nulls(n, pa.binary())], names=names)
        yield from last
        for batch in batches:
            yield batch.select(names)

    met = cut(marked.repartition("minimizer", salt).sortWithinPartitions("apart", "minimizer").mapInArrow(run_apart, OCCURRENCES))
    return (met.filter("stop IS NOT NULL").select("doc_id", "text_hash", "start", "stop")
            .unionByName(_counted(met.filter("stop IS NULL"), window)))


CUT = "n_words long, n_removed long, kept string"


def remove_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` for every row of ``docs``: ``kept`` holds
    the words outside the spans, joined by one space."""
    @F.arrow_udf(CUT)
    def cut_out(texts: pa.Array, spans: pa.Array) -> pa.Array:
        total, removed, kept = [], [], []
        for text, own in zip(as_bytes(texts), spans.to_pylist()):
            words = byte_words(text)
            total.append(len(words))
            if own:
                keep, at = [], 0
                for span in sorted(own):
                    lo, hi = span >> 32, span & 0xFFFFFFFF
                    if lo > at:
                        keep += words[at:lo]
                    at = max(at, hi)
                words = keep + words[at:]
            removed.append(total[-1] - len(words))
            kept.append(b" ".join(words).decode())
        return pa.StructArray.from_arrays([pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                                           pa.array(kept, pa.string())], names=["n_words", "n_removed", "kept"])

    by_text = (spans.groupBy(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
               .agg(F.collect_set(F.shiftleft(F.col("start").cast("long"), 32) + F.col("stop")).alias("__spans")))
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("__text_hash"))
    joined = whole.join(by_text, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__text_hash") == F.col("__hash")), "left")
    return joined.select("doc_id", cut_out("text", "__spans").alias("cut")).select("doc_id", "cut.*")


def dedup_substrings(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, rows: int = GROUP_ROWS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) for every row of ``docs``."""
    return remove_spans(docs, repeated_spans(docs, window, gram, rows))
