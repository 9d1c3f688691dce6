"""The corpus pipeline: every stage on all its predecessor kept, against plain Python."""

import random

from pyspark.sql import functions as F

import corpus_pipeline as C
from quire.llm import pii as P
from quire.llm import queries as Q

from .conftest import SCHEMA, WORD, prose
from .test_dedup import brute_components, brute_simhash
from .test_text_ops import brute_spans


def write(spark, folder, rows, labels, items):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def test_stages(spark, tmp_path):
    rng = random.Random(6)
    items = [(k, prose(rng, 30)) for k in range(4)]
    rows, labels = [], []
    for k in range(500):
        text = prose(rng, rng.randrange(60, 200))
        if k % 8 == 0:
            text = text.replace(" ", "### ")
        elif k % 50 == 1:
            text += " " + items[k % 4][1]
        elif k % 25 == 2:
            text += " call +1 (203) 555-1234 or a.b@mail.example.com"
        elif k % 20 == 3:
            text = rows[-1][1]  # a copy
        rows.append((k, text, "en", f"s{k % 3}", len(text)))
        labels.append((k, int(k % 8 > 0), 0))
    write(spark, str(tmp_path), rows, labels, items)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    steps = {}
    for name, stage in C.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/out-{name}")
        docs = steps[name] = spark.read.parquet(f"{tmp_path}/out-{name}")
    texts = {r[0]: r[1] for r in rows}
    after = {n: {r.doc_id: r.text for r in df.collect()} for n, df in steps.items() if n != "mixture"}
    good = {k for k in texts if k % 8}
    assert len(after["quality"].keys() ^ good) <= 5 and all(texts[k] == t for k, t in after["quality"].items())
    ids = sorted(after["quality"])
    roots = brute_components([brute_simhash(texts[k]) for k in ids], 2)
    assert set(after["near_duplicates"]) == {ids[r] for r in roots}
    leaky = {k for k, t in after["near_duplicates"].items() if any(i in t for _, i in items)}
    assert leaky and set(after["decontamination"]) == set(after["near_duplicates"]) - leaky
    assert set(after["personal_data"]) == set(after["decontamination"])
    for k, t in after["personal_data"].items():
        assert not [s for s in brute_spans(t)] and (t == texts[k] or brute_spans(texts[k]) or P.KINDS)
        if not brute_spans(texts[k]):
            assert t == texts[k]
    assert all(df.columns == SCHEMA.replace(" long", "").replace(" string", "").split(", ") for n, df in steps.items() if n != "mixture")
    mixed = steps["mixture"].select(F.explode("doc_ids").alias("d")).distinct().collect()
    assert {r.d for r in mixed} <= set(after["personal_data"])
    total = sum(len(WORD.findall(t)) for t in after["personal_data"].values())
    assert abs(steps["mixture"].agg(F.sum("n_words")).first()[0] - total) <= 0.1 * total
    run = C.run(spark, str(tmp_path))
    assert run.columns == steps["mixture"].columns and run.count() == steps["mixture"].count()


def test_empty_tables(spark, tmp_path):
    write(spark, str(tmp_path), [], [], [])
    assert C.run(spark, str(tmp_path)).count() == 0


def test_every_operator_has_its_query():
    """One query per operator; op 5 has a second one, the links of all levels."""
    assert sorted(Q.QUERIES, key=lambda n: int(n[2:].split("_")[0])) == [
        "op1_quality_rules", "op2_simhash", "op3_mixing", "op4_quality_classifier", "op5_quotation_linking", "op5_quotation_links",
        "op6_decontamination", "op7_pii", "op8_warc", "op9_license_scan", "op10_substring_dedup", "op11_token_alignment",
        "op12_exact_dedup", "op13_merkle_manifest"]
