"""Exact dedup by a tree-merge of sorted digest runs.

Every task digests its texts (SHA-256 after lower-casing A-Z), sorts them into
one run and folds equal ones to an entry: digest, length, retained identifier,
count.  The P input partitions are the nodes of a grid of R digits of at most
``FAN_IN`` values.  In round r the nodes that differ only in digit r exchange
their runs: each keeps the part of the digest range that this digit of the
target names and merges the up to ``FAN_IN`` sorted pieces it gets, folding
equal entries again.  After R = log(P) rounds (binomial, with more than two
partners a round) every node holds the whole of one digest range, folded, and no
task ever holds more than its share of the distinct texts.

Runs travel as packed pieces of at most ``PIECE`` entries, read in the order of
their first digest; an entry is final once a piece starts behind it, so a merge
holds about ``FAN_IN`` pieces, however long the runs are.  A text that a third of
all rows share is one entry per node from the first fold on.  Its rows learn
the outcome in two joins, by digest over one entry per partition and then by
(partition, digest), so that no join key holds the whole group either.

Entries are ordered by the digest's first eight bytes, as runs of short keys
are; two are equal only if all 32 bytes and the length in bytes agree too.

Defined results: a null text counts as empty; of equal texts the row with the
smallest (or largest) id is retained, rows without an id only where no row has
one, ties and repeated rows by their place in the input, so exactly one row of
each group stays; an empty table gives an empty result.  Extra columns are not
read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import as_bytes, cut, small_batches

FAN_IN = 16
PIECE = 4096

_ENTRY = np.dtype([("digest", "S32"), ("n_bytes", "<i8"), ("no_id", "<i8"), ("id", "<i8"), ("row", "<i8"), ("count", "<i8")])
_PIECES = "node int, first binary, entries binary"
_GROUPS = "digest binary, n_bytes long, keep_id long, keep_row long, group_size long"


def normal_digest(text: Column) -> Column:
    """Struct of the SHA-256 (32 bytes) and the length of the UTF-8 text with A-Z in lower case."""
    @F.arrow_udf("digest binary, n_bytes long")
    def digest(texts: pa.Array) -> pa.Array:
        digests, sizes = [], []
        for x in as_bytes(texts):
            digests.append(hashlib.sha256((x or b"").lower()).digest())  # bytes.lower changes A-Z only
            sizes.append(len(x or b""))
        return pa.StructArray.from_arrays([pa.array(digests, pa.binary()), pa.array(sizes, pa.int64())], names=["digest", "n_bytes"])
    return digest(text)


def _raw(x: np.ndarray) -> np.ndarray:
    """Digests as rows of four words in byte order."""
    return np.ascontiguousarray(x["digest"]).view(">u8").reshape(-1, 4).astype(np.uint64)


def fold(x: np.ndarray, smallest: bool) -> np.ndarray:
    """Sort entries and fold those equal in digest and length: one keeps the retained row and the sum of counts."""
    if not len(x):
        return x
    words = _raw(x)
    by_id = x["id"] if smallest else ~x["id"]
    order = np.lexsort((x["row"], by_id, x["no_id"], x["n_bytes"], *words.T[::-1]))
    x, words = x[order], words[order]
    new = np.ones(len(x), bool)
    new[1:] = (words[1:] != words[:-1]).any(axis=1) | (x["n_bytes"][1:] != x["n_bytes"][:-1])
    starts = np.flatnonzero(new)
    out = x[starts]
    out["count"] = np.add.reduceat(x["count"], starts)
    return out


def merge(pieces: Iterator[tuple[bytes, np.ndarray]], smallest: bool) -> Iterator[np.ndarray]:
    """Merge sorted pieces that come in the order of their first digest into folded, sorted parts."""
    waiting, size = [], 0
    for first, entries in pieces:
        if size > FAN_IN * PIECE:
            ready = fold(np.concatenate(waiting), smallest)
            at = np.searchsorted(ready["digest"], np.array(first, "S32"))
            if at:
                yield ready[:at]
            waiting, size = [ready[at:]], len(ready) - at
        waiting.append(entries)
        size += len(entries)
    if size:
        yield fold(np.concatenate(waiting), smallest)


def grid(parts: int) -> tuple[int, int]:
    """(values per digit, number of digits) of the smallest even grid with room for ``parts`` nodes."""
    digits = 1
    while FAN_IN ** digits < parts:
        digits += 1
    side = 1
    while side ** digits < parts:
        side += 1
    return side, digits


def _addressed(parts: Iterator[np.ndarray], node: int, side: int, digits: int, digit: int) -> Iterator[pa.RecordBatch]:
    """Cut sorted entries into pieces for the partners of ``node`` in ``digit``."""
    for x in parts:
        share = np.uint64(((1 << 64) - 1) // side ** digits)
        target = np.minimum(_raw(x)[:, 0] // share, np.uint64(side ** digits - 1)).astype(np.int64) // side ** digit % side
        bounds = np.flatnonzero(np.diff(target)) + 1
        for lo, hi in zip([0, *bounds], [*bounds, len(x)]):
            to = node + (int(target[lo]) - node // side ** digit % side) * side ** digit
            cuts = [x[i:min(i + PIECE, hi)] for i in range(lo, hi, PIECE)]
            raw = [c.tobytes() for c in cuts]
            yield pa.RecordBatch.from_arrays([pa.array([to] * len(cuts), pa.int32()), pa.array([r[:32] for r in raw], pa.binary()),
                                              pa.array(raw, pa.binary())], names=["node", "first", "entries"])


def _entries(batch: pa.RecordBatch) -> np.ndarray:
    x = np.zeros(batch.num_rows, _ENTRY)
    digests = b"".join(batch.column("digest").to_pylist())
    x["digest"] = np.frombuffer(digests, "S32")
    ids = batch.column("id")
    x["no_id"] = np.asarray(ids.is_null()).astype(np.int64)
    x["id"] = np.asarray(ids.fill_null(0))
    x["n_bytes"], x["row"] = np.asarray(batch.column("n_bytes")), np.asarray(batch.column("row"))
    x["count"] = 1
    return x


def _by_node(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[tuple[bytes, np.ndarray]]]]:
    """Rows sorted by (node, first) as one stream of pieces per node."""
    from itertools import groupby
    rows = ((n, f, e) for b in batches for n, f, e in zip(*(b.column(c).to_pylist() for c in ("node", "first", "entries"))))
    for node, group in groupby(rows, key=lambda r: r[0]):
        yield node, ((f, np.frombuffer(e, _ENTRY)) for _, f, e in group)


def merged_groups(digests: DataFrame, smallest: bool = True) -> DataFrame:
    """One row per distinct text of ``digests`` (part, row, id, digest, n_bytes), by rounds of exchanged runs."""
    last = digests.agg(F.max("part")).first()[0]
    side, digits = grid((last or 0) + 1)

    def first_runs(batches):
        from itertools import chain
        batches = (b for b in batches if b.num_rows)
        for head in batches:
            node = head.column("part")[0].as_py()  # the same in the whole partition
            sorted_parts = ((b.column("digest")[0].as_py(), _entries(b)) for b in chain([head], batches))
            yield from _addressed(merge(sorted_parts, smallest), node, side, digits, digits - 1)

    def exchanged(digit):
        def run(batches):
            for node, pieces in _by_node(batches):
                yield from _addressed(merge(pieces, smallest), node, side, digits, digit - 1)
        return run

    def last_merge(batches):
        for _, pieces in _by_node(batches):
            for x in merge(pieces, smallest):
                raw = np.ascontiguousarray(x["digest"]).tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([raw[i:i + 32] for i in range(0, len(raw), 32)], pa.binary()), pa.array(x["n_bytes"]),
                     pa.array(x["id"], mask=x["no_id"] > 0), pa.array(x["row"]), pa.array(x["count"])],
                    names=["digest", "n_bytes", "keep_id", "keep_row", "group_size"])

    runs = digests.select("part", "id", "row", "digest", "n_bytes").sortWithinPartitions("digest").mapInArrow(first_runs, _PIECES)
    for digit in range(digits - 1, -1, -1):
        dealt = runs.repartition(side ** digits, "node").sortWithinPartitions("node", "first")
        runs = dealt.mapInArrow(exchanged(digit), _PIECES) if digit else dealt.mapInArrow(last_merge, _GROUPS)
    return runs


def duplicates(docs: DataFrame, text: str = "text", id: str = "doc_id", keep: str = "smallest") -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, digest (32 bytes).

    ``keep`` names the row that stays of equal texts: that of the "smallest" or "largest" id.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep is 'smallest' or 'largest', not {keep!r}")
    made = docs.select(F.col(id).cast("long").alias("id"), normal_digest(F.col(text)).alias("d"))
    rows = cut(small_batches(made).select("id", "d.digest", "d.n_bytes", F.spark_partition_id().alias("part"),
                                          F.monotonically_increasing_id().alias("row")))
    groups = merged_groups(rows, keep == "smallest").filter("group_size > 1")
    held = rows.select("part", "digest", "n_bytes").distinct()  # combined before the shuffle: one row per partition and text
    outcome = held.join(groups, ["digest", "n_bytes"])
    alone = F.col("group_size").isNull()
    return rows.join(outcome, ["part", "digest", "n_bytes"], "left").select(
        F.col("id").alias(id), F.when(alone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"), "digest")
