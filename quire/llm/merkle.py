"""Merkle manifest of a dataset: trees per key as postorder append logs, and proofs.

A leaf is the SHA-256 of a row's fields, each with its length.  The rows of one
tree (one language) are ordered by id; every two consecutive nodes become the
hash of their digests, a last one alone its own hash, until one remains.  The
roots of the trees, in the order of their keys, make the leaves of one more tree
in the same way.

Builders take aligned blocks of 2 ** ``BITS`` leaves, append leaf by leaf and
write every node as soon as it is complete, which is postorder; a next tier of
builders does the same over the roots of the blocks.  Nothing has to be kept about
where a node went: before leaf j of a log there are 2j - popcount(j) nodes (the
sizes of the full subtrees that j's bits name), and a node of level l is complete l
nodes after its last leaf.  So node (l, i) of a tree of n leaves stands at
2j - popcount(j) + l with j = min((i + 1) * 2 ** l, n) - 1, and a proof fetches each
sibling from its position: those below a block's root from the block's part of the
log, those above from the tier over it, once per block and not per leaf.

Ranks come from ranges that tasks sort, so a key with most of the rows is split
like any other; a task holds one block at a time.

Defined results: a null field is ``-``; a null key is a tree of its own, before all
others; rows without id come first in their tree; repeated ids are ordered by leaf,
repeated rows by place (they are equal); the lone leaf of a tree is its root; an
empty table gives an empty log and no proofs.  Extra columns are not hashed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import cut, shared_folder, with_position

BITS = 10  # a builder's block: at most 1024 nodes of its lowest level
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
LOG = "tree long, n long, block long, level int, idx long, pos long, digest string"


def leaf_hash(values: list[Column]) -> Column:
    """Digest of field values: each ``-`` if null, else its length in UTF-8 bytes, a colon and itself."""
    parts = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in (x.cast("string") for x in values)]
    return F.sha2(F.concat(*parts), 256)


def position(level: int, idx: int, n: int) -> int:
    """Place of node (level, idx) in the postorder log of a tree of ``n`` leaves, from 0."""
    j = min((idx + 1) << level, n) - 1
    return 2 * j - j.bit_count() + level


def height(n: int) -> int:
    return (n - 1).bit_length()


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def append_all(digests: list[str], first: int, base: int, n: int) -> list[tuple[int, int, str]]:
    """Nodes (level, idx, digest) over one block, in completion order.

    ``digests`` are the block's nodes of level ``base`` from index ``first`` on.  Nodes
    are completed up to ``BITS`` levels above, or to the root of the ``n`` leaves.
    """
    out: list[tuple[int, int, str]] = []
    top = min(base + BITS, height(n))
    open_: dict[int, str] = {}  # level -> left sibling that waits

    def complete(level: int, idx: int, digest: str) -> None:
        out.append((level, idx, digest))
        while level < top:
            if level not in open_ and not idx & 1:
                open_[level] = digest
                return
            level, idx, digest = level + 1, idx >> 1, _hash(open_.pop(level) + digest)
            out.append((level, idx, digest))

    for k, d in enumerate(digests):
        complete(base, first + k, d)
    last = first + len(digests) - 1
    for level in range(base, top):  # what is still open has no right sibling
        if level in open_:
            complete(level + 1, last >> (level + 1 - base), _hash(open_.pop(level)))
    return out


def _tier(base: DataFrame, tier: int) -> DataFrame:
    """The log rows that the builders of one tier write over its ``base`` nodes (tree, n, idx, digest)."""
    def build(group: pa.Table) -> pa.Table:
        group = group.sort_by("idx")
        tree, n, first = (group.column(c)[0].as_py() for c in ("tree", "n", "idx"))
        low = tier * BITS
        nodes = append_all(group.column("digest").to_pylist(), first, low, n)
        if tier:
            nodes = [x for x in nodes if x[0] > low]  # the lower tier wrote those
        k = len(nodes)
        level, idx, digest = zip(*nodes) if nodes else ((), (), ())
        return pa.table({"tree": pa.array([tree] * k, pa.int64()), "n": pa.array([n] * k, pa.int64()),
                         "block": pa.array([first >> BITS] * k, pa.int64()), "level": pa.array(level, pa.int32()),
                         "idx": pa.array(idx, pa.int64()),
                         "pos": pa.array([position(lv, i, n) for lv, i in zip(level, idx)], pa.int64()),
                         "digest": pa.array(digest, pa.string())})

    return (base.select("tree", "n", "idx", "digest", F.shiftright("idx", BITS).alias("block"))
            .groupBy("tree", "block").applyInArrow(build, LOG))


def grow(leaves: DataFrame, path: str) -> list[DataFrame]:
    """Write the log of all trees over ``leaves`` (tree, n, idx, digest) under ``path``, a folder per tier; the tiers read back."""
    spark = leaves.sparkSession
    most = leaves.agg(F.max("n")).first()[0] or 1
    tiers: list[DataFrame] = []
    base = leaves
    for t in range(max(1, -(-height(most) // BITS))):
        if t:
            base = tiers[-1].filter((F.col("level") == t * BITS) & (F.col("n") > 1 << (t * BITS)))
        _tier(base, t).write.parquet(f"{path}/tier={t}")
        tiers.append(spark.read.parquet(f"{path}/tier={t}"))
    return tiers


def roots(tiers: list[DataFrame]) -> DataFrame:
    """(tree, n, root) of every tree in a log: its last node."""
    level, n = F.col("level"), F.col("n")
    whole = (F.col("idx") == 0) & (n <= F.pow(F.lit(2.0), level)) & ((level == 0) | (n > F.pow(F.lit(2.0), level - 1)))
    out = tiers[0].filter(whole)
    for x in tiers[1:]:
        out = out.unionByName(x.filter(whole))
    return out.select("tree", "n", F.col("digest").alias("root"))


UP = "struct<path: array<string>, subroot: string, root: string>"


def _extract(base: DataFrame, log: DataFrame, above: DataFrame, tier: int) -> DataFrame:
    """``base`` with ``up``: the siblings of each node, from their positions in the block's log, then those of the block."""
    low = tier * BITS
    schema = T.StructType([*base.schema.fields, T.StructField("up", T.StructType.fromDDL(UP[7:-1]))])
    kind = pa.struct([("path", pa.list_(pa.string())), ("subroot", pa.string()), ("root", pa.string())])

    def fetch(nodes: pa.Table, rows: pa.Table) -> pa.Table:
        if not nodes.num_rows:
            return nodes.drop_columns(["block"]).append_column("up", pa.array([], kind))
        n, idx = nodes.column("n")[0].as_py(), nodes.column("idx").to_pylist()
        at = dict(zip(rows.column("pos").to_pylist(), rows.column("digest").to_pylist()))
        at |= {position(low, i, n): d for i, d in zip(idx, nodes.column("digest").to_pylist())}
        up = next(u for u in rows.column("up").to_pylist() if u is not None)
        levels = []
        for level in range(low, min(low + BITS, height(n))):
            width, known = -(-n >> level), {}
            for i in {x >> (level - low) for x in idx}:
                s = i ^ 1
                known[i] = "U" if s >= width else ("L" if s < i else "R") + at[position(level, s, n)]
            levels.append((level - low, known))
        ups = [up | {"path": [known[i >> shift] for shift, known in levels] + up["path"]} for i in idx]
        return nodes.drop_columns(["block"]).append_column("up", pa.array(ups, kind))

    rows = log.select("tree", "block", "pos", "digest", F.lit(None).cast(UP).alias("up")).unionByName(
        above.select("tree", "block", F.lit(-1).cast("long").alias("pos"), F.lit(None).cast("string").alias("digest"), "up"))
    left = base.withColumn("block", F.shiftright("idx", BITS))
    return left.groupBy("tree", "block").cogroup(rows.groupBy("tree", "block")).applyInArrow(fetch, schema)


def climb(leaves: DataFrame, tiers: list[DataFrame], above: DataFrame) -> DataFrame:
    """``leaves`` (tree, n, idx, digest, more columns) with ``up``: path, subroot and root, from the highest tier down.

    An entry of a path is ``L`` or ``R`` (the sibling's side) and a digest, or ``U``: no
    sibling.  ``above`` (tree, n, up) is what holds behind the roots.
    """
    below, n = None, F.col("n")
    for t in range(len(tiers) - 1, -1, -1):
        starts = above.filter((n <= 1 << ((t + 1) * BITS)) & ((n > 1 << (t * BITS)) if t else F.lit(True)))
        up = starts.select("tree", F.lit(0).cast("long").alias("block"), "up")
        if below is not None:
            up = up.unionByName(below.select("tree", F.col("idx").alias("block"), "up"))
        base = tiers[t - 1].filter((F.col("level") == t * BITS) & (n > 1 << (t * BITS))).select("tree", "n", "idx", "digest") if t else leaves
        below = _extract(base, tiers[t], up, t)
        below = cut(below) if t else below
    return below


def ranked(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``rows`` with their tree (the 1-based place of their ``key``), ``idx`` (0-based place by ``order`` in
    the tree) and ``n`` (its leaves); nulls come first.

    Places are added up per (range, key), so rows of a frequent key meet their numbers range by range.
    """
    keys = [F.col(key).asc_nulls_first(), *(F.col(c).asc_nulls_first() for c in order)]
    nth = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranged = cut(rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
                 .withColumn("__range", F.spark_partition_id()).withColumn("__nth", nth))
    per = cut(ranged.groupBy(F.col("__range").alias("__r"), F.col(key).alias("__k"))
              .agg(F.count(F.lit(1)).alias("__c"), F.min("__nth").alias("__first")))
    trees = with_position(per.select("__k").distinct(), ["__k"], "tree").select(F.col("__k").alias("__t"), "tree")
    same = Window.partitionBy("__k")
    before = same.orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)
    per = (per.select("__r", "__k", "__first", F.sum("__c").over(same).alias("n"), F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__before"))
           .join(trees, F.col("__k").eqNullSafe(F.col("__t"))))
    return (ranged.join(per, (F.col("__range") == F.col("__r")) & F.col(key).eqNullSafe(F.col("__k")))
            .withColumn("idx", F.col("__before") + F.col("__nth") - F.col("__first"))
            .drop("__range", "__nth", "__r", "__k", "__t", "__first", "__before"))


def write_manifest(leaves: DataFrame, path: str, key: str = "lang", order: str = "doc_id") -> Callable[[], DataFrame]:
    """Write the logs of ``leaves`` (``key``, ``order``, leaf, more columns) under ``path``; a function that gives the proofs.

    ``path/trees`` holds the log of every tree, ``path/top`` that of their roots, as rows of ``LOG``.
    The proofs are the rows of ``leaves`` with tree, idx, n, path, subroot and root.
    """
    spark = leaves.sparkSession
    placed = cut(leaves.withColumn("__place", F.monotonically_increasing_id()))
    nodes = cut(ranked(placed, key, [order, "leaf", "__place"]).drop("__place").withColumnRenamed("leaf", "digest"))
    tiers = grow(nodes, f"{path}/trees")
    subroots = cut(roots(tiers))
    n_trees = subroots.count()
    tops = subroots.select(F.lit(0).cast("long").alias("tree"), F.lit(n_trees).cast("long").alias("n"), (F.col("tree") - 1).alias("idx"),
                           F.col("root").alias("digest"), F.col("n").alias("leaves"))
    top_tiers = grow(tops, f"{path}/top")

    def proofs() -> DataFrame:
        root = roots(top_tiers).first()  # one row, or none for an empty table
        nothing = spark.createDataFrame([(0, n_trees, ([], None, root and root.root))], f"tree long, n long, up {UP}")
        over = cut(climb(tops, top_tiers, nothing).select(
            (F.col("idx") + 1).alias("tree"), F.col("leaves").alias("n"), F.col("up").withField("subroot", F.col("digest")).alias("up")))
        return climb(nodes, tiers, over).withColumnRenamed("digest", "leaf").select("*", "up.*").drop("up")

    return proofs


def siblings(path: Column) -> Column:
    """The digests of a path's siblings, from the leaf to the root, joined."""
    return F.array_join(F.transform(path, lambda p: F.substring(p, 2, 64)), "")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    def step(digest: Column, p: Column) -> Column:
        other = F.substring(p, 2, 64)
        return F.sha2(F.when(F.startswith(p, F.lit("L")), F.concat(other, digest)).otherwise(F.concat(digest, other)), 256)
    return F.aggregate(path, leaf, step)


def manifest_proofs(docs: DataFrame, key: str = "lang", order: str = "doc_id", fields: list[str] | None = None,
                    claimed: Callable[[str], Column] | None = None, path: str | None = None) -> DataFrame:
    """Build the manifest of ``docs`` and prove every row: ``key``, ``order``, leaf, claim, subroot, root, path.

    ``claimed(field)`` gives the value of a field in the copy that is to be verified (default: the same
    value); ``claim`` is its leaf.  ``path``: where the logs go (default: a new shared folder).
    """
    names = fields or FIELDS
    leaf = leaf_hash([F.col(c) for c in names])
    claim = leaf_hash([claimed(c) for c in names]) if claimed else leaf
    made = docs.select(order, key, leaf.alias("leaf"), claim.alias("claim"))
    return write_manifest(made, path or shared_folder(docs.sparkSession), key, order)()


def verified(proofs: DataFrame) -> DataFrame:
    """Proofs with proof_sha256, folded_root (from the claim) and verified."""
    return (proofs.withColumn("proof_sha256", F.sha2(siblings(F.col("path")), 256))
            .withColumn("folded_root", folded(F.col("claim"), F.col("path")))
            .withColumn("verified", F.col("folded_root") == F.col("root")))
