import random
import re

import pytest

WORD = re.compile("[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n, vocab=4000):
    return " ".join(f"w{rng.randrange(vocab)}" + rng.choice(["", "", "", ".", ","]) for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, ties, repeated rows and clashing extra columns."""
    rng = random.Random(5)
    long = prose(rng, 30_000)
    rows = [(1, None, "en", "a", 0), (2, "", "en", None, 0), (3, " \n\t ", None, "a", 4), (4, long, "en", "b", len(long)),
            (5, long, "en", "b", len(long)), (5, long, "en", "b", len(long)), (None, "some words here", "en", "b", 15),
            (None, None, None, None, None), (7, "é" * 300, "fr", "", 300), (8, "x " * 200, "en", "a", 400)]
    rows += [(10 + k, prose(rng, 80), "en", "ab"[k % 2], 0) for k in range(20)]
    df = spark.createDataFrame(rows, SCHEMA)
    for clash in ("stats", "score", "kept", "fp", "component_id", "u", "v", "key", "label", "size", "target", "row", "kind", "start",
                  "stop", "spans", "block", "text_hash", "seed", "item_id", "path", "count", "n", "__id"):
        df = df.selectExpr("*", f"'clash' AS `{clash}`")
    return df


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
