"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

Both tokenizers see a blank and the text; a token's range follows from the running
lengths of its bytes.  Texts are taken in batches of about ``BATCH_BYTES``; in a batch
pandas ``merge_asof``, keyed by document, gives each token start the covering token of
the other side (the last one that starts there or before), from A to B and from B to A.
The union of both is all overlaps: of two ranges that overlap, the later start lies in
the other range.  Overlaps whose ranges end together are links; their ends cut both
token sequences into groups.

How often a pair of ids is linked in the whole corpus is counted per batch first, so
that every pair travels once per batch and no pair, however frequent, weighs more than
one row of each; the counts come back to the batch's documents in the same way.

Defined results: null and empty texts, texts that are not valid UTF-8, and texts whose
tokens of A or B do not join to blank + text have no tokens and count in nothing;
repeated rows give repeated rows and each counts; ids may be null or repeat; an empty
table gives an empty result.  Extra columns are not read.  Memory follows the longest
text, which is one batch if it is longer than ``BATCH_BYTES``.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import as_bytes, shared_folder, small_batches

A_PATH = "/opt/tokenizers/byte_bpe_50k.json"
B_PATH = "/opt/tokenizers/piece_bpe_32k.model"
BATCH_BYTES = 1 << 20
_SHIFT = 32  # a pair of ids as one number: A's id above B's

_ALIGNED = "chunk long, id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links array<int>, pairs array<long>, counts array<long>"
_SCORED = "id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
_OVERLAPS = "id long, a_no int, a_id int, b_no int, b_id int, start long, stop long, linked boolean"


# Fixed value: how byte-level BPE files of this kind cut a text before merging.
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class ByteLevel:
    """A byte-level BPE of a ``tokenizers`` file; special tokens' strings are plain text.

    Where the file's merges are in the order of its ids and it cuts texts by ``_PATTERN``, ``tiktoken``
    encodes with the file's vocabulary as ranks: the same ids in a third of the time
    (``tests/llm/test_align.py`` compares both over all code points).
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        # Printable Latin-1 stands for itself, the other bytes for 256 and up, in order.
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
        byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}
        vocab = spec["model"]["vocab"]
        self.bytes = [b""] * (max(vocab.values(), default=-1) + 1)
        for token, i in vocab.items():
            self.bytes[i] = bytes(byte[c] for c in token)
        merged = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in spec["model"]["merges"]]
        cut = spec.get("pre_tokenizer") or {}
        if (merged == sorted(merged) and len(merged) + 256 == len(vocab) and spec.get("normalizer") is None
                and cut.get("type") == "ByteLevel" and cut.get("use_regex") and not cut.get("add_prefix_space")):
            import tiktoken
            ranks = {x: i for i, x in enumerate(self.bytes)}
            fast = tiktoken.Encoding("byte-level", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
            self._ids = lambda texts: [fast.encode_ordinary(t) for t in texts]
        else:
            from tokenizers import Tokenizer
            model = Tokenizer.from_file(path)
            model.encode_special_tokens = True
            self._ids = lambda texts: [e.ids for e in model.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self._ids([" " + t for t in texts])


class Pieces:
    """A ``sentencepiece`` model that adds the blank in front itself."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class Side:
    """One tokenizer with the byte lengths and decimal names of its ids."""

    def __init__(self, path: str):
        self.tokenizer = ByteLevel(path) if path.endswith(".json") else Pieces(path)
        self.bytes = self.tokenizer.bytes
        self.lengths = np.array([len(x) for x in self.bytes], np.int64)
        self.names = {s: np.array([f"{i}{s}" for i in range(len(self.bytes))], "S") for s in ",|;"}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; none where they do not join to blank + text."""
        out = []
        for text, ids in zip(texts, self.tokenizer.encode(texts)):
            whole = b"".join(map(self.bytes.__getitem__, ids)) == b" " + text.encode()
            out.append(np.array(ids if whole else [], np.int64))
        return out


class Tokens:
    """The tokens of one side in a batch: document, number in it, id, byte range (running on over documents)."""

    def __init__(self, ids: list[np.ndarray], side: Side):
        self.sizes = np.array([len(x) for x in ids], np.int64)
        self.id = np.concatenate(ids) if ids else np.empty(0, np.int64)
        self.doc = np.repeat(np.arange(len(ids)), self.sizes)
        self.stop = np.cumsum(side.lengths[self.id])
        self.start = self.stop - side.lengths[self.id]

    def frame(self) -> pd.DataFrame:
        return pd.DataFrame({"start": self.start, "doc": self.doc, "no": np.arange(len(self.id))})


def overlaps(a: Tokens, b: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """All overlapping tokens as two arrays of row numbers, ordered by the later start."""
    fa, fb = a.frame(), b.frame()
    over_a = pd.merge_asof(fa, fb, on="start", by="doc", suffixes=("_a", "_b"))
    over_b = pd.merge_asof(fb, fa, on="start", by="doc", suffixes=("_b", "_a"))
    na, nb = over_a["no_a"].to_numpy(np.int64), over_a["no_b"].to_numpy(np.int64)
    ma, mb = over_b["no_a"].to_numpy(np.int64), over_b["no_b"].to_numpy(np.int64)
    new = a.start[ma] < b.start[mb]  # equal starts were found from A already
    na, nb = np.concatenate([na, ma[new]]), np.concatenate([nb, mb[new]])
    order = np.argsort(np.maximum(a.start[na], b.start[nb]), kind="stable")
    return na[order], nb[order]


def _group_of(is_end: np.ndarray) -> np.ndarray:
    """Group number of every token from the flags of those that end one."""
    return np.cumsum(is_end) - is_end


def group_texts(a: Tokens, b: Tokens, la: np.ndarray, lb: np.ndarray, names_a: dict, names_b: dict) -> Iterator[bytes]:
    """``a1,a2|b1;a3|b2,b3`` of every document, from the links' tokens (``la``, ``lb``)."""
    end_a, end_b = np.zeros(len(a.id), np.int64), np.zeros(len(b.id), np.int64)
    end_a[la], end_b[lb] = 1, 1
    group_a, group_b = _group_of(end_a), _group_of(end_b)
    n = len(la)
    a_until = np.cumsum(np.bincount(group_a, minlength=n)[:n]) if n else np.empty(0, np.int64)
    b_before = np.concatenate([[0], np.cumsum(np.bincount(group_b, minlength=n)[:n])]) if n else np.zeros(1, np.int64)
    width = max(names_a["|"].dtype.itemsize, names_b["|"].dtype.itemsize)
    out = np.empty(len(a.id) + len(b.id), f"S{width}")
    for no, tokens, ends, names, last in ((np.arange(len(a.id)) + b_before[group_a], a, end_a, names_a, "|"),
                                          (np.arange(len(b.id)) + (a_until[group_b] if n else 0), b, end_b, names_b, ";")):
        out[no] = np.where(ends > 0, names[last][tokens.id], names[","][tokens.id])
    at = np.concatenate([[0], np.cumsum(a.sizes + b.sizes)])
    for lo, hi in zip(at[:-1], at[1:]):
        yield out[lo:hi].tobytes().replace(b"\0", b"")[:-1]


def _batches(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
    """(ids, texts) of about ``BATCH_BYTES`` each; null and undecodable texts as empty ones."""
    ids, texts, size = [], [], 0
    for i, data in zip(batch.column("id").to_pylist(), as_bytes(batch.column("text"))):
        if ids and size + len(data or b"") > BATCH_BYTES:
            yield ids, texts
            ids, texts, size = [], [], 0
        try:
            text = (data or b"").decode()
        except UnicodeDecodeError:
            text = ""
        ids.append(i)
        texts.append(text)
        size += len(data or b"")
    if ids:
        yield ids, texts


def _tokens(texts: list[str], a: Side, b: Side) -> tuple[Tokens, Tokens]:
    """Both sides' tokens; a text that either side does not give back, or an empty one, has none."""
    full = [k for k, t in enumerate(texts) if t]
    ids_a, ids_b = ([np.empty(0, np.int64)] * len(texts) for _ in range(2))
    for k, x, y in zip(full, a.encode([texts[k] for k in full]), b.encode([texts[k] for k in full])):
        if len(x) and len(y):
            ids_a[k], ids_b[k] = x, y
    return Tokens(ids_a, a), Tokens(ids_b, b)


def _input(docs: DataFrame, text: str, id: str) -> DataFrame:
    return small_batches(docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text")))


def token_overlaps(docs: DataFrame, text: str = "text", id: str = "doc_id", a_path: str = A_PATH, b_path: str = B_PATH) -> DataFrame:
    """Every pair of overlapping tokens: id, token numbers and ids, the shared byte range in blank + text, linked (they end together)."""
    def run(batches):
        a, b = Side(a_path), Side(b_path)
        for batch in batches:
            for ids, texts in _batches(batch):
                ta, tb = _tokens(texts, a, b)
                na, nb = overlaps(ta, tb)
                doc = ta.doc[na]
                first_a, first_b = (np.concatenate([[0], np.cumsum(t.sizes)])[doc] for t in (ta, tb))
                base = ta.start[first_a] if len(na) else first_a
                start, stop = np.maximum(ta.start[na], tb.start[nb]) - base, np.minimum(ta.stop[na], tb.stop[nb]) - base
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[d] for d in doc], pa.int64()), *(pa.array(x, pa.int32()) for x in (na - first_a, ta.id[na], nb - first_b, tb.id[nb])),
                     pa.array(start), pa.array(stop), pa.array(ta.stop[na] == tb.stop[nb])],
                    names=["id", "a_no", "a_id", "b_no", "b_id", "start", "stop", "linked"])

    return _input(docs, text, id).mapInArrow(run, _OVERLAPS).withColumnRenamed("id", id)


def _aligned(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Rows of ``_ALIGNED``: counts, groups and links per document; a batch's first row holds its pairs and their counts."""
    def run(batches):
        from pyspark import TaskContext
        a, b = Side(a_path), Side(b_path)
        chunk = TaskContext.get().partitionId() << 33
        for batch in batches:
            for ids, texts in _batches(batch):
                ta, tb = _tokens(texts, a, b)
                na, nb = overlaps(ta, tb)
                linked = ta.stop[na] == tb.stop[nb]
                la, lb = na[linked], nb[linked]
                groups = [hashlib.sha256(g).hexdigest() if g else "" for g in group_texts(ta, tb, la, lb, a.names, b.names)]
                pairs, local, counts = np.unique(ta.id[la] << _SHIFT | tb.id[lb], return_inverse=True, return_counts=True)
                n_links = np.bincount(ta.doc[la], minlength=len(ids))
                offsets = pa.array(np.concatenate([[0], np.cumsum(n_links)]), pa.int32())
                rest = [None] * (len(ids) - 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk] * len(ids), pa.int64()), pa.array(ids, pa.int64()), pa.array(ta.sizes), pa.array(tb.sizes),
                     pa.array(n_links), pa.array(n_links), pa.array(groups),
                     pa.ListArray.from_arrays(offsets, pa.array(local, pa.int32())),
                     pa.array([pairs.tolist(), *rest], pa.list_(pa.int64())), pa.array([counts.tolist(), *rest], pa.list_(pa.int64()))],
                    names=["chunk", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links", "pairs", "counts"])
                chunk += 1

    return docs.mapInArrow(run, _ALIGNED)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, total, best) of every linked pair of ids; best: no pair with its B id has more links."""
    each = aligned.filter(F.col("pairs").isNotNull()).select(F.inline(F.arrays_zip("pairs", "counts")))
    total = each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("counts").alias("total"))
    b = F.col("pair").bitwiseAND(F.lit((1 << _SHIFT) - 1))
    most = total.groupBy(b.alias("b")).agg(F.max("total").alias("most"))
    return total.join(most, b == F.col("b")).select("pair", "total", (F.col("total") == F.col("most")).alias("best"))


def alignment(docs: DataFrame, text: str = "text", id: str = "doc_id", a_path: str = A_PATH, b_path: str = B_PATH) -> DataFrame:
    """One row per row of ``docs``: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark = docs.sparkSession
    path = shared_folder(spark)
    _aligned(_input(docs, text, id), a_path, b_path).write.parquet(path)
    aligned = spark.read.parquet(path)
    of_chunk = aligned.filter(F.col("pairs").isNotNull()).select("chunk", F.posexplode("pairs").alias("no", "pair"))
    known = of_chunk.join(pair_counts(aligned), "pair").select("chunk", "no", "total", "best")

    def score(rows: pa.Table, counts: pa.Table) -> pa.Table:
        total, best = np.zeros((2, counts.num_rows), np.int64)
        no = counts.column("no").to_numpy()
        total[no], best[no] = counts.column("total").to_numpy(), counts.column("best").to_numpy().astype(np.int64)
        links = rows.column("links").combine_chunks()
        at, flat = links.offsets.to_numpy(), links.values.to_numpy()
        sums = [np.concatenate([[0], np.cumsum(x[flat])]) for x in (best, total)]
        out = rows.select(["id", "n_a", "n_b", "n_groups", "n_links"])
        for name, s in zip(("n_best", "count_sum"), sums):
            out = out.append_column(name, pa.array(s[at[1:]] - s[at[:-1]]))
        return out.append_column("groups_sha256", rows.column("groups_sha256"))

    rows = spark.read.parquet(path).drop("pairs", "counts")
    return rows.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(score, _SCORED).withColumnRenamed("id", id)
