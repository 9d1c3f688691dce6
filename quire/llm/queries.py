"""Registered queries of this subpackage: ``name -> fn(spark, sf_dir) -> DataFrame``.

Each applies one operator, with production parameters, to its whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import (align, decontaminate, exact_dedup, licenses, merkle, mixing, pii, quality_rules, quotes, rule_ensemble, simhash,
                       substrings, warc)
from quire.llm.common import cut, shared_folder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def reg(fn):
        QUERIES[name] = fn
        return fn
    return reg


@query("op1_quality_rules")
def op1(spark: SparkSession, d: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, d, "documents"), table(spark, d, "labels"))
    counts = [F.col(f"stats.{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return judged.select("doc_id", *counts, "base_failed", "kept", "score")


@query("op2_simhash")
def op2(spark: SparkSession, d: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, d, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query("op4_quality_classifier")
def op4(spark: SparkSession, d: str) -> DataFrame:
    return rule_ensemble.classify(table(spark, d, "documents"), table(spark, d, "labels"))


@query("op10_substring_dedup")
def op10(spark: SparkSession, d: str) -> DataFrame:
    done = substrings.dedup_substrings(table(spark, d, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op3_mixing")
def op3(spark: SparkSession, d: str) -> DataFrame:
    sized = cut(mixing.with_size(table(spark, d, "documents")))
    plan = mixing.plan_sources(sized)
    done = mixing.taken(cut(mixing.place(sized, plan)), plan)
    return done.select("doc_id", "size", "source_size", "target", "taken")


@query("op6_decontamination")
def op6(spark: SparkSession, d: str) -> DataFrame:
    found = decontaminate.leaks(table(spark, d, "documents"), table(spark, d, "benchmark"))
    return found.select("doc_id", "item_id", "item_tokens", "covered", "coverage", F.size("tiles").alias("n_tiles"))


@query("op7_pii")
def op7(spark: SparkSession, d: str) -> DataFrame:
    return pii.report(table(spark, d, "documents"))


@query("op8_warc")
def op8(spark: SparkSession, d: str) -> DataFrame:
    path = shared_folder(spark)
    warc.write_archives(table(spark, d, "pages"), path)
    found = warc.capture_history(spark, path)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "position", "damaged")


@query("op5_quotation_linking")
def op5(spark: SparkSession, d: str) -> DataFrame:
    return quotes.reply_ordered(quotes.as_replies(table(spark, d, "conversations")))


@query("op5_quotation_links")
def op5_links(spark: SparkSession, d: str) -> DataFrame:
    return quotes.links(cut(quotes.parsed(quotes.as_replies(table(spark, d, "conversations")))))


@query("op9_license_scan")
def op9(spark: SparkSession, d: str) -> DataFrame:
    return licenses.scan(licenses.as_files(table(spark, d, "documents")))


@query("op11_token_alignment")
def op11(spark: SparkSession, d: str) -> DataFrame:
    return align.alignment(table(spark, d, "documents"))


@query("op12_exact_dedup")
def op12(spark: SparkSession, d: str) -> DataFrame:
    found = exact_dedup.duplicates(table(spark, d, "documents"), keep="largest")
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


@query("op13_merkle_manifest")
def op13(spark: SparkSession, d: str) -> DataFrame:
    def tampered(field):
        if field != "n_chars":
            return F.col(field)
        hit = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
        return F.when(hit, (F.col(field).cast("decimal(20,0)") + 1).cast("string")).otherwise(F.col(field).cast("string"))

    proofs = merkle.verified(merkle.manifest_proofs(table(spark, d, "documents"), claimed=tampered))
    return proofs.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
