"""Validation (survey §2.J): constraint checks as boolean expressions.

Each check yields a rule name when it fails; a row's ``violations`` is the
sorted list of failed rules.  Rows are split into good and bad rather than
failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.tags import is_valid_node_type


def _violations(checks: dict[str, Column]) -> Column:
    arr = F.array(*[F.when(bad, F.lit(name)) for name, bad in checks.items()])
    return F.array_sort(F.filter(arr, lambda x: x.isNotNull()))


def _bbox_bad(c: str = "bbox") -> Column:
    fields = [F.col(f"{c}.{f}") for f in ("x", "y", "width", "height")]
    out = F.lit(False)
    for f in fields:
        out = out | F.coalesce(~f.between(0.0, 1.0), F.lit(True))
    return F.col(c).isNotNull() & out


def validate_nodes(nodes: DataFrame) -> DataFrame:
    """J1-J4 over ``nodes``: adds ``violations ARRAY<STRING>``.

    Row rules: ``node-type`` (one of the 14 types), ``page-index`` (>= 0),
    ``depth`` (>= 0), ``bbox-range`` (each field in [0, 1]).  Referential rules:
    ``duplicate-id`` ((doc_id, node_id) unique), ``parent-missing`` (the parent
    exists in the same document), ``multiple-roots`` (one parentless node per
    document).  The windows and the parent anti-join all key on doc_id.
    """
    ids = nodes.select("doc_id", F.col("node_id").alias("parent_id")).distinct().withColumn("_p", F.lit(True))
    x = nodes.join(ids, ["doc_id", "parent_id"], "left")
    x = x.withColumn("_dup", F.count(F.lit(1)).over(Window.partitionBy("doc_id", "node_id"))).withColumn(
        "_roots", F.sum(F.when(F.col("parent_id").isNull(), 1).otherwise(0)).over(Window.partitionBy("doc_id")))
    checks = {
        "node-type": ~F.coalesce(is_valid_node_type("node_type"), F.lit(False)),
        "page-index": F.coalesce(F.col("page_index") < 0, F.lit(True)),
        "depth": F.coalesce(F.col("depth") < 0, F.lit(True)),
        "bbox-range": _bbox_bad("bbox"),
        "duplicate-id": F.col("_dup") > 1,
        "parent-missing": F.col("parent_id").isNotNull() & F.col("_p").isNull(),
        "multiple-roots": F.col("parent_id").isNull() & (F.col("_roots") > 1),
    }
    return x.withColumn("violations", _violations(checks)).drop("_p", "_dup", "_roots")


def validate_blocks(blocks: DataFrame) -> DataFrame:
    """J2/J3 over cited text blocks: confidence and bbox in [0, 1], page and
    depth >= 0."""
    checks = {
        "confidence-range": F.coalesce(~F.col("confidence").between(0.0, 1.0), F.lit(True)),
        "page-index": F.coalesce(F.col("page_index") < 0, F.lit(True)),
        "depth": F.col("depth") < 0,
        "bbox-range": _bbox_bad("bbox"),
    }
    return blocks.withColumn("violations", _violations(checks))


def validate_docs(docs: DataFrame) -> DataFrame:
    """J3 over ``docs``: ``page-count`` (>= 1)."""
    return docs.withColumn("violations", _violations(
        {"page-count": F.coalesce(F.col("page_count") < 1, F.lit(True))}))


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows) by an empty ``violations`` array."""
    ok = F.size("violations") == 0
    return checked.filter(ok), checked.filter(~ok)
