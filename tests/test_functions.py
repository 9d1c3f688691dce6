import hashlib

from pyspark.sql import functions as F

from quire.functions import text as T
from tests.conftest import rows


def one(spark, expr, value, schema="v STRING"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_py_strip_unicode_whitespace(spark):
    assert one(spark, T.py_strip("v"), "  \tpara　 ") == "para"
    assert one(spark, T.py_strip("v"), "​ x") == "​ x"  # zero-width space is not whitespace


def test_ws_set_matches_python():
    every = "".join(chr(c) for c in range(0x3001))
    assert set(T.PY_WS) == {ch for ch in every if ch.isspace()}


def test_split_paragraphs(spark):
    assert one(spark, T.split_paragraphs("v"), "a\n\n  \n\nb\n\n") == ["a", "b"]
    assert one(spark, T.split_paragraphs("v"), "   ") == []
    assert one(spark, T.split_paragraphs("v"), None) == []
    assert one(spark, T.split_paragraphs("v", "\n"), "x\n y \n\n") == ["x", "y"]


def test_hashes(spark):
    s = "é" * 3000
    want = hashlib.sha256(s.encode()[:4096]).hexdigest()
    assert one(spark, T.source_hash_of_text("v"), s) == want
    assert one(spark, T.content_hash("v"), "abc") == hashlib.sha256(b"abc").hexdigest()[:16]
    assert one(spark, T.content_hash("v"), None) == hashlib.sha256(b"").hexdigest()[:16]


def test_prefix_collision_same_source_hash(spark):
    a, b = "x" * 4096 + "tail-a", "x" * 4096 + "tail-b"
    df = spark.createDataFrame([(a,), (b,)], "v STRING").select(
        T.source_hash_of_text("v").alias("s"), T.full_hash_of_text("v").alias("f")).collect()
    assert df[0]["s"] == df[1]["s"] and df[0]["f"] != df[1]["f"]


def test_tokens(spark):
    df = spark.createDataFrame([("",), ("ab",), ("x" * 40,), (None,)], "v STRING")
    assert [r["t"] for r in df.select(T.est_tokens("v").alias("t")).collect()] == [0, 1, 10, 0]


def test_preview(spark):
    assert one(spark, T.preview("v"), "y" * 130) == "y" * 120
    assert one(spark, T.preview("v"), None) is None
    assert one(spark, T.preview("v"), "") is None


def test_percent_half_even(spark):
    assert one(spark, T.percent("v"), 0.125, "v DOUBLE") == "12%"
    assert one(spark, T.percent("v"), 0.5, "v DOUBLE") == "50%"
    assert one(spark, T.percent("v"), 1.0, "v DOUBLE") == "100%"
    assert one(spark, T.percent("v"), 0.135, "v DOUBLE") == f"{0.135:.0%}"


def test_csv_row_matches_python_writer(spark):
    import csv
    import io
    cells = ["a,b", 'c"d', "", "e\nf", " g"]
    buf = io.StringIO()
    csv.writer(buf).writerow(cells)
    got = spark.createDataFrame([(cells,)], "v ARRAY<STRING>").select(T.csv_row("v").alias("r")).first()["r"]
    assert got == buf.getvalue() == '"a,b","c""d",,"e\nf", g\r\n'
    buf = io.StringIO()
    csv.writer(buf).writerow([""])
    got = spark.createDataFrame([([None],)], "v ARRAY<STRING>").select(T.csv_row("v").alias("r")).first()["r"]
    assert got == buf.getvalue()


def test_node_id(spark):
    df = spark.createDataFrame([("abcdef0123", 3, 7)], "h STRING, p INT, s INT")
    assert rows(df.select(T.node_id("h", "p", "s").alias("i")))[0]["i"] == "ast:abcdef:3:7"
    assert df.select(F.lit(1)).count() == 1
