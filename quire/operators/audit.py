"""Audit operators (survey §2.I).

The reference fixes only the record shapes (rule id, severity, page,
description, WCAG criterion or standard; findings with category and evidence);
its rules run on a server.  The rules here are ours, expressed over ``nodes``
and raw HTML, with their metadata held as literal maps (no joins).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.tags import literal_map

# Accessibility rules: rule_id -> (severity, description, WCAG criterion).
ACCESSIBILITY_RULES = {
    "heading-level-skip": ("error", "Heading level skips one or more levels", "1.3.1"),
    "empty-heading": ("error", "Heading has no text", "2.4.6"),
    "figure-no-text": ("error", "Figure has no text alternative", "1.1.1"),
    "no-headings": ("warning", "Document has no headings", "2.4.10"),
    "table-no-rows": ("warning", "Table has no rows", "1.3.1"),
    "list-no-items": ("warning", "List has no items", "1.3.1"),
}

# Standards -> the rules whose findings violate them.
STANDARD_RULES = {
    "PDF/UA-1": ["heading-level-skip", "empty-heading", "figure-no-text", "no-headings", "table-no-rows",
                 "list-no-items"],
    "WCAG-2.1-AA": ["heading-level-skip", "empty-heading", "figure-no-text", "list-no-items"],
    "PDF/A-3b": ["figure-no-text", "table-no-rows"],
}

# Forensic checks over raw HTML: category -> (pattern, severity, weight).
FORENSIC_CHECKS = {
    "javascript": (r"(?i)<script[\s>]|javascript:", "high", 0.5),
    "embedded_files": (r"(?i)<(?:iframe|object|embed)[\s>]", "high", 0.4),
    "metadata": (r"(?i)<meta[\s>]", "low", 0.1),
}


def check_accessibility(nodes: DataFrame) -> DataFrame:
    """Findings ``(doc_id, rule_id, severity, page_index, node_id,
    description, wcag_criteria)``.

    Only the node types that some rule reads enter, their text as a flag, so
    cells and paragraphs never reach the windows (all partitioned by doc_id):

    * heading level skip: the level of the previous heading in preorder is a
      running ``last(..., ignorenulls)`` over the rows before;
    * no headings: a per-document count, reported on the root row;
    * containers without items: rows and items carry their parent's id as key,
      containers their own, so one window per key tells what a container holds.
    """
    w = Window.partitionBy("doc_id").orderBy("pre")
    is_head = F.col("node_type") == "heading"
    no_text = F.col("no_text")
    child = F.col("node_type").isin("table_row", "list_item")
    read = F.col("node_type").isin("heading", "figure", "table", "list", "table_row", "list_item") | (F.col("pre") == 0)
    x = nodes.filter(read).select(
        "doc_id", "node_id", "pre", "node_type", "page_index", F.coalesce("level", F.lit(1)).alias("lvl"),
        (F.col("text_content").isNull() | (F.length("text_content") == 0)).alias("no_text"),
        F.when(child, F.col("parent_id")).otherwise(F.col("node_id")).alias("key"))
    held = Window.partitionBy("doc_id", "key")
    x = (x.withColumn("prev_level", F.last(F.when(is_head, F.col("lvl")), ignorenulls=True).over(
            w.rowsBetween(Window.unboundedPreceding, -1)))
         .withColumn("doc_heads", F.count_if(is_head).over(Window.partitionBy("doc_id")))
         .withColumn("has_row", F.max(F.col("node_type") == "table_row").over(held))
         .withColumn("has_item", F.max(F.col("node_type") == "list_item").over(held)))
    rules = F.array(
        F.when(is_head & (F.col("lvl") > F.coalesce(F.col("prev_level"), F.lit(0)) + 1), F.lit("heading-level-skip")),
        F.when(is_head & no_text, F.lit("empty-heading")),
        F.when((F.col("node_type") == "figure") & no_text, F.lit("figure-no-text")),
        F.when((F.col("pre") == 0) & (F.col("doc_heads") == 0), F.lit("no-headings")),
        F.when((F.col("node_type") == "table") & ~F.coalesce(F.col("has_row"), F.lit(False)),
               F.lit("table-no-rows")),
        F.when((F.col("node_type") == "list") & ~F.coalesce(F.col("has_item"), F.lit(False)),
               F.lit("list-no-items")))
    doc_level = F.col("rule_id") == "no-headings"
    out = x.select("doc_id", "node_id", "page_index", F.explode_outer(F.filter(rules, lambda r: r.isNotNull()))
                   .alias("rule_id")).filter(F.col("rule_id").isNotNull()).select(
        "doc_id", "rule_id", F.when(~doc_level, F.col("page_index")).alias("page_index"),
        F.when(~doc_level, F.col("node_id")).alias("node_id"))
    sev = literal_map({k: v[0] for k, v in ACCESSIBILITY_RULES.items()})
    desc = literal_map({k: v[1] for k, v in ACCESSIBILITY_RULES.items()})
    wcag = literal_map({k: v[2] for k, v in ACCESSIBILITY_RULES.items()})
    return out.select("doc_id", "rule_id", F.try_element_at(sev, F.col("rule_id")).alias("severity"),
                      "page_index", "node_id", F.try_element_at(desc, F.col("rule_id")).alias("description"),
                      F.try_element_at(wcag, F.col("rule_id")).alias("wcag_criteria"))


def accessibility_summary(findings: DataFrame, docs: DataFrame, conformance_target: str = "PDF/UA-1") -> DataFrame:
    """I1 response per document: ``conformance_target``, ``issue_count`` and ``passed``.

    The target names the rules that count (``STANDARD_RULES``); an unknown one raises.
    """
    if conformance_target not in STANDARD_RULES:
        raise ValueError(f"unknown conformance target: {conformance_target}")
    c = findings.filter(F.col("rule_id").isin(STANDARD_RULES[conformance_target])).groupBy("doc_id").agg(F.count(F.lit(1)).alias("issue_count"))
    return docs.select("doc_id").join(c, "doc_id", "left").select(
        "doc_id", F.lit(conformance_target).alias("conformance_target"),
        F.coalesce("issue_count", F.lit(0)).cast("bigint").alias("issue_count"),
        (F.coalesce("issue_count", F.lit(0)) == 0).alias("passed"))


def compliance_violations(findings: DataFrame, standards: list[str]) -> DataFrame:
    """One row per finding and requested standard that it violates."""
    unknown = [s for s in standards if s not in STANDARD_RULES]
    if unknown:
        raise ValueError(f"unknown standards: {', '.join(unknown)}")
    rules = F.create_map(*[x for r in ACCESSIBILITY_RULES for x in (
        F.lit(r), F.array(*[F.lit(s) for s in standards if r in STANDARD_RULES[s]]).cast("array<string>"))])
    return findings.select("doc_id", F.explode(F.element_at(rules, F.col("rule_id"))).alias("standard"), "rule_id", "severity",
                           "page_index", "node_id", "description")


def _checks(names: list[str] | None) -> dict:
    """The named forensic checks, all by default; an unknown name raises."""
    unknown = [c for c in names or [] if c not in FORENSIC_CHECKS]
    if unknown:
        raise ValueError(f"unknown checks: {', '.join(unknown)}")
    return {c: v for c, v in FORENSIC_CHECKS.items() if names is None or c in names}


SNIPPET_CHARS = 40  # text shown behind a match


def forensic_evidence(pages: DataFrame, checks: list[str] | None = None) -> DataFrame:
    """I3 evidence: one row per match with its place: ``(finding_id, doc_id, category, severity, match_no,
    start, stop, snippet)``.

    Places are code points from 0, ``stop`` exclusive; the snippet is the match and up to 40 characters behind it,
    not past the next match.  A match starts after all gaps and matches before it: running sums over the matches
    of one page and category, the only rows that are shuffled.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    per = F.array(*[F.struct(F.lit(c).alias("category"), F.lit(sev).alias("severity"), F.regexp_extract_all(html, F.lit(p), 0).alias("hits"),
                             F.split(html, p).alias("gaps")) for c, (p, sev, _) in _checks(checks).items()])
    x = pages.select(F.col("page_id").cast("bigint").alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.inline_outer(per))
    pieces = F.transform("hits", lambda h, i: F.struct(
        i.alias("i"), F.length(F.get("gaps", i)).alias("gap"), F.length(h).alias("n"),
        F.concat(h, F.left(F.coalesce(F.get("gaps", i + 1), F.lit("")), F.lit(SNIPPET_CHARS))).alias("snippet")))
    x = x.select("doc_id", "row", "category", "severity", pieces.alias("pieces"))
    x = x.select("doc_id", "row", "category", "severity", F.inline_outer("pieces")).filter(F.col("i").isNotNull())
    upto = Window.partitionBy("row", "category").orderBy("i")
    stop = F.sum(F.col("gap") + F.col("n")).over(upto)
    return x.select(F.concat_ws(":", F.col("doc_id").cast("string"), "category").alias("finding_id"), "doc_id", "category", "severity",
                    F.col("i").alias("match_no"), (stop - F.col("n")).cast("int").alias("start"), stop.cast("int").alias("stop"), "snippet")


def forensic_report(pages: DataFrame, checks: list[str] | None = None) -> DataFrame:
    """I3 response rows: ``finding_id`` (document and category), ``checks`` run, ``description`` and ``evidence``
    next to the columns of ``forensic_scan``.  ``checks`` names the checks to run (default: all)."""
    names = F.array(*[F.lit(c) for c in _checks(checks)])
    return forensic_scan(pages, checks).select(
        F.concat_ws(":", F.col("doc_id").cast("string"), "category").alias("finding_id"), "doc_id", "category", "severity",
        F.concat(F.col("evidence_count").cast("string"), F.lit(" markers of "), F.col("category")).alias("description"),
        F.create_map(F.lit("count"), F.col("evidence_count").cast("string")).alias("evidence"), names.alias("checks"), "risk_score")


def compliance_check(findings: DataFrame, docs: DataFrame, standards: list[str] | None = None) -> DataFrame:
    """Violations per (document, standard); ``passed`` when none.

    The standard -> rule table is a fixed literal of a few rows, so it is
    broadcast; every document appears for every requested standard.
    """
    spark = findings.sparkSession
    wanted = standards or ["PDF/A-3b"]
    unknown = [s for s in wanted if s not in STANDARD_RULES]
    if unknown:
        raise ValueError(f"unknown standards: {', '.join(unknown)}")
    rows = [(s, r) for s in wanted for r in STANDARD_RULES[s]]
    std = spark.createDataFrame(rows, "standard STRING, rule_id STRING")
    v = findings.join(F.broadcast(std), "rule_id").groupBy("doc_id", "standard").agg(
        F.count(F.lit(1)).alias("violation_count"))
    base = docs.select("doc_id", F.col("page_count").alias("pages_processed"),
                       F.explode(F.array(*[F.lit(s) for s in wanted])).alias("standard"))
    return base.join(v, ["doc_id", "standard"], "left").select(
        "doc_id", "standard", F.coalesce("violation_count", F.lit(0)).cast("bigint").alias("violation_count"),
        (F.coalesce("violation_count", F.lit(0)) == 0).alias("passed"), "pages_processed")


def forensic_scan(pages: DataFrame, checks: list[str] | None = None) -> DataFrame:
    """One finding per (document, category) with matches in the raw HTML:
    ``(doc_id, category, severity, evidence_count, risk_score)``, where
    ``risk_score = min(1, sum of the weights of the categories found)``.
    Row-at-a-time regex counts: no shuffle.
    """
    counted = F.array(*[F.struct(F.lit(c).alias("category"), F.lit(sev).alias("severity"),
                                 F.lit(float(wt)).alias("weight"),
                                 F.regexp_count(F.coalesce(F.col("html"), F.lit("")), F.lit(p)).alias("n"))
                        for c, (p, sev, wt) in _checks(checks).items()])
    found = F.filter(counted, lambda x: x["n"] > 0)
    risk = F.least(F.lit(1.0), F.aggregate(found, F.lit(0.0), lambda a, x: a + x["weight"]))
    x = pages.select(F.col("page_id").cast("bigint").alias("doc_id"), found.alias("found"), risk.alias("risk_score"))
    return x.select("doc_id", "risk_score", F.explode_outer("found").alias("f")).filter(F.col("f").isNotNull()).select(
        "doc_id", F.col("f.category").alias("category"), F.col("f.severity").alias("severity"),
        F.col("f.n").cast("bigint").alias("evidence_count"), "risk_score")


def forensic_risk(pages: DataFrame) -> DataFrame:
    """I3 response per document: ``risk_score`` and the number of findings."""
    checks = [F.regexp_count(F.coalesce(F.col("html"), F.lit("")), F.lit(p)) for p, _, _ in FORENSIC_CHECKS.values()]
    weights = [wt for _, _, wt in FORENSIC_CHECKS.values()]
    score = F.lit(0.0)
    n = F.lit(0)
    for c, wt in zip(checks, weights):
        score = score + F.when(c > 0, F.lit(float(wt))).otherwise(F.lit(0.0))
        n = n + F.when(c > 0, 1).otherwise(0)
    return pages.select(F.col("page_id").cast("bigint").alias("doc_id"),
                        F.least(F.lit(1.0), score).alias("risk_score"), n.alias("finding_count"))
