"""Licence scan: TF-IDF cosine to templates, then inheritance by directory, in DataFrame functions only.

A file's terms are read across lines, without stopwords; an SPDX tag with its
(first) identifier is one term.  Units of comparison are spans and whole licence
files.  A span is as many consecutive terms as a notice has (or the whole text, if
shorter) and is compared with that notice if both share two different terms, or
all of a notice of one term; so a notice is found inside a longer line or
paragraph, and broken over lines.  The whole text of a licence file is compared
with the licence texts.  Terms weigh (1 + ln tf) * idf, with idf over notices and
texts; a term that none of them has weighs as much as one of no template.

Only texts that hold a term of a notice are cut into terms, long texts into pieces
that overlap by the longest notice, and only spans around two neighbouring terms
of notices leave a piece, so nothing grows with the text but its own terms.

A file's own licence is its best unit of at least ``MIN_COSINE``.  A file
without one inherits from the nearest directory above it that holds a licence
file: directories (not files) are expanded to their ancestors and joined.

Defined results: texts that are null or without terms have no licence; a null path is an empty
one, in the root directory; rows that repeat a path and text count once per row;
of licence files in one directory the best score counts, ties by name of the
licence; empty tables give an empty result; without templates nothing is found.
Extra columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import cut

MIN_COSINE = 0.6
LICENCE_FILES = r"(?i)^(?:licen[cs]e|copying|notice)(?:[.-].*)?$"
_WORD = r"[a-z0-9]+(?:[.+-][a-z0-9]+)*"
SPDX = "spdx-license-identifier:"
TERM = rf"{SPDX}{_WORD}|{_WORD}"
JAVA_TERM = rf"{SPDX}{_WORD}+|{_WORD}+"  # possessive: else Java's matcher recurses for every part of a long chain
PIECE = 512  # terms of a long text that are looked at together
STOPWORDS = ["a", "an", "and", "any", "are", "as", "at", "be", "by", "for", "in", "is", "it", "may", "not", "of", "on", "or", "the",
             "this", "to", "under", "with", "you"]

# Notices by licence; several wordings of one licence are several templates.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("MPL-2.0", "Subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
]

TEMPLATES += [(name, f"SPDX-License-Identifier: {name}{form}") for name in sorted({n for n, _ in TEMPLATES})
              for form in (["", "-only", "-or-later"] if "GPL" in name else [""])]

# Fixed texts: whole licences.
TEXTS = [
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use,
copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software
is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included
in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO
EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT,
TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE
AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO
EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION
WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
]


def terms_of(text: str) -> list[str]:
    """Terms of a template, in order."""
    return [t for t in re.findall(TERM, re.sub(rf"({SPDX})[ \t]+", r"\1", text.lower())) if t not in STOPWORDS]


def template_weights(templates: list[tuple[str, str]]) -> tuple[list[tuple], dict[str, float], float]:
    """Templates (licence, terms, weight over length by term), idf by term, idf of other terms."""
    counts = [Counter(terms_of(text)) for _, text in templates]
    n = len(templates)
    df = Counter(t for c in counts for t in c)
    idf = {t: math.log((n + 1) / (d + 1)) + 1 for t, d in df.items()}
    weighed = []
    for (name, text), c in zip(templates, counts):
        w = {t: (1 + math.log(x)) * idf[t] for t, x in c.items()}
        length = math.sqrt(sum(x * x for x in w.values()))
        weighed.append((name, terms_of(text), {t: x / length for t, x in sorted(w.items())}))
    return weighed, idf, math.log(n + 1) + 1


def _terms(text: Column) -> Column:
    """Terms of a lower-case text that are no stopwords."""
    tagged = F.regexp_replace(text, rf"({SPDX})[\x20\t]+", "$1")
    return F.filter(F.regexp_extract_all(tagged, F.lit(JAVA_TERM), F.lit(0)), lambda t: ~t.isin(STOPWORDS))


def _map(weights: dict[str, float]) -> Column:
    return F.create_map(*[F.lit(x) for e in sorted(weights.items()) for x in e])


def _cosine(terms: Column, weights: Column, idf: dict[str, float], other: float) -> Column:
    """Cosine of an array of terms to a template's ``weights``: one pass over the sorted terms."""
    def closed(run: Column) -> Column:
        tf = 1 + F.log(run["n"])
        w = tf * F.coalesce(F.element_at(_map(idf), run["term"]), F.lit(other))
        return F.when(run["n"] > 0, F.struct((run["sq"] + w * w).alias("sq"), (run["dot"] + w * F.coalesce(
            F.element_at(weights, run["term"]), F.lit(0.0))).alias("dot"))).otherwise(F.struct(run["sq"].alias("sq"), run["dot"].alias("dot")))

    def step(run: Column, term: Column) -> Column:
        same, done = run["term"] == term, closed(run)
        return F.when(same, F.struct(run["term"].alias("term"), (run["n"] + 1).alias("n"), run["sq"].alias("sq"), run["dot"].alias("dot"))
                      ).otherwise(F.struct(term.alias("term"), F.lit(1).alias("n"), done["sq"].alias("sq"), done["dot"].alias("dot")))

    start = F.struct(F.lit("").alias("term"), F.lit(0).alias("n"), F.lit(0.0).alias("sq"), F.lit(0.0).alias("dot"))
    return F.aggregate(F.array_sort(terms), start, step, lambda run: F.round(closed(run)["dot"] / F.sqrt(closed(run)["sq"]), 9))


def own_licences(files: DataFrame, templates=None, min_cosine: float = MIN_COSINE, texts=None) -> DataFrame:
    """(path, text_hash, licence, score, n_units) for every distinct file (path, text) with
    a licence of its own; ``n_units`` counts the places where any licence is named."""
    given = TEMPLATES if templates is None else templates
    weighed, idf, other = template_weights([*given, *(TEXTS if texts is None else texts)])
    notices, whole_texts = weighed[:len(given)], weighed[len(given):]
    vocabulary = sorted({t for _, terms, _ in notices for t in terms})
    alone = sorted({terms[0] for _, terms, _ in notices if len(set(terms)) == 1})
    longest = max((len(terms) for _, terms, _ in notices), default=1)
    # a word of a notice, not part of a longer one
    heads = sorted({SPDX if t.startswith(SPDX) else t for t in vocabulary})
    holds = rf"(?<![a-z0-9])(?:{'|'.join(re.escape(t) for t in heads) or '(?!)'})(?![a-z0-9])|{re.escape(SPDX)}"
    is_licence_file = _file_name(F.col("path")).rlike(LICENCE_FILES)
    some = files.select("path", F.xxhash64("text").alias("text_hash"), F.lower("text").alias("text")).filter(
        F.col("text").rlike(holds) | is_licence_file)
    termed = some.select("path", "text_hash", _terms(F.col("text")).alias("terms"))
    kind = "array<struct<at:int,words:array<string>>>"
    pieces = F.when(F.size("terms") > 0, F.transform(F.sequence(F.lit(0), F.greatest(F.size("terms") - 1, F.lit(0)), F.lit(PIECE)), lambda at: F.struct(
        at.alias("at"), F.slice("terms", at + 1, PIECE + longest - 1).alias("words"))))
    # a file without terms has no length to divide by, and no licence
    whole = F.when(is_licence_file & (F.size("terms") > 0) & F.lit(bool(whole_texts)), F.array(F.struct(F.lit(-1).alias("at"), F.col("terms").alias("words"))))
    cut_up = (termed.select("path", "text_hash", F.explode_outer(F.concat(
        F.coalesce(pieces.cast(kind), F.array().cast(kind)), F.coalesce(whole.cast(kind), F.array().cast(kind)))).alias("p")).select("path", "text_hash", "p.*"))
    # spans with two terms of notices hold two neighbouring ones
    placed = F.transform("words", lambda t, i: F.when(t.isin(vocabulary), i)) if vocabulary else F.array().cast("array<int>")
    found = cut_up.withColumn("hits", F.when(F.col("at") >= 0, F.array_compact(placed)).otherwise(F.array().cast("array<int>")))
    single = F.filter("hits", lambda i: F.get("words", i).isin(alone)) if alone else F.array().cast("array<int>")
    near = F.filter(F.zip_with("hits", F.slice("hits", 2, F.size("hits")), lambda x, y: F.struct(x.alias("x"), y.alias("y"))),
                    lambda h: h["y"] - h["x"] < longest)
    starts = F.flatten(F.transform(near, lambda h: F.sequence(F.greatest(h["y"] - (longest - 1), F.lit(0)), h["x"])))
    begins = F.filter(F.array_distinct(F.concat(starts, single)), lambda i: i < PIECE)
    spans = (found.select("path", "text_hash", "at", "words", F.explode_outer(F.when(F.col("at") < 0, F.array(F.lit(0))).otherwise(begins)).alias("i"))
             .filter("i IS NOT NULL").select("path", "text_hash", F.when(F.col("at") < 0, -1).otherwise(F.col("at") + F.col("i")).alias("unit"),
                     F.when(F.col("at") < 0, F.col("words")).otherwise(F.slice("words", F.col("i") + 1, longest)).alias("next")))

    # one literal holds all templates, so that the expression does not grow with them
    listed = [F.struct(F.lit(name).alias("licence"), F.lit(k >= len(given)).alias("is_text"), F.lit(len(terms)).alias("n"), _map(weights).alias("weights"))
              for k, (name, terms, weights) in enumerate(weighed) if terms]
    if not listed:
        return spans.sparkSession.createDataFrame([], "path string, text_hash long, licence string, score double, n_units long")

    def span(t: Column) -> Column:
        return F.when(t["is_text"], F.col("next")).otherwise(F.slice("next", 1, t["n"]))

    def compared(t: Column) -> Column:
        own = F.map_keys(t["weights"])
        enough = F.size(F.array_intersect(span(t), own)) >= F.least(F.lit(2), F.size(own))
        return F.when(F.col("unit") < 0, t["is_text"]).otherwise(~t["is_text"] & enough & ((F.size(span(t)) == t["n"]) | (F.col("unit") == 0)))

    scores = F.transform(F.filter(F.array(*listed), compared), lambda t: F.struct(
        t["licence"].alias("licence"), _cosine(span(t), t["weights"], idf, other).alias("score")))
    scored = (spans.select("path", "text_hash", "unit", F.explode_outer(scores).alias("s")).select("path", "text_hash", "unit", "s.*")
              .filter(F.col("score") >= min_cosine))
    return (scored.groupBy("path", "text_hash").agg(
        F.min_by(F.struct("licence", "score"), F.struct(-F.col("score"), "licence")).alias("best"),
        F.countDistinct("unit").alias("n_units")).select("path", "text_hash", "best.licence", "best.score", "n_units"))


def _file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def _directory(path: Column) -> Column:
    return F.when(path.contains("/"), F.regexp_replace(path, "/[^/]*$", "")).otherwise("")


def _ancestors(directory: Column) -> Column:
    """The directory and all above it, the root (empty) last."""
    parts = F.split(directory, "/")
    up = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    return F.when(directory == "", F.array(F.lit(""))).otherwise(up)


def inherited(files: DataFrame, own: DataFrame) -> DataFrame:
    """(directory, licence, from_directory) for every directory of ``files`` at or
    below one with a licence file that names a licence."""
    grants = (own.filter(_file_name(F.col("path")).rlike(LICENCE_FILES)).withColumn("granted", _directory(F.col("path")))
              .groupBy("granted").agg(F.min_by("licence", F.struct(-F.col("score"), "licence")).alias("licence")))
    above = (files.select(_directory(F.col("path")).alias("directory")).distinct()
             .select("directory", F.explode(F.array_distinct(_ancestors(F.col("directory")))).alias("granted")))
    return (above.join(grants, "granted").groupBy("directory")
            .agg(F.max_by(F.struct("licence", "granted"), F.length("granted")).alias("nearest"))
            .select("directory", "nearest.licence", F.col("nearest.granted").alias("from_directory")))


def scan(files: DataFrame, templates=None, min_cosine: float = MIN_COSINE, texts=None) -> DataFrame:
    """(doc_id, path, own_licence, score, n_units, licence, from_directory) for every row of ``files``
    (doc_id, path, text): ``licence`` is the file's own or the inherited one."""
    plain = files.select("doc_id", F.coalesce("path", F.lit("")).alias("path"), "text")
    own = cut(own_licences(plain.select("path", "text"), templates, min_cosine, texts))
    narrow = plain.select("doc_id", "path", F.xxhash64("text").alias("text_hash"), _directory(F.col("path")).alias("directory"))
    named = own.select("path", "text_hash", F.col("licence").alias("own_licence"), "score", "n_units")
    passed = inherited(plain, own).select("directory", F.col("licence").alias("passed"), "from_directory")
    joined = narrow.join(named, ["path", "text_hash"], "left").join(passed, "directory", "left")
    alone = F.col("own_licence").isNull()
    return joined.select("doc_id", "path", "own_licence", "score", F.coalesce("n_units", F.lit(0)).alias("n_units"),
                         F.coalesce("own_licence", "passed").alias("licence"), F.when(alone, F.col("from_directory")).alias("from_directory"))


def as_files(documents: DataFrame) -> DataFrame:
    """Documents as a source tree: source / language / folder of 256 ids; every 16th
    document is the licence file of its source, its language or its folder in turn."""
    i = F.coalesce(F.col("doc_id"), F.lit(0))
    folder = F.concat_ws("/", F.coalesce("source", F.lit("unknown")), F.coalesce("lang", F.lit("xx")), F.floor(i / 256).cast("string"))
    upper = F.concat_ws("/", F.coalesce("source", F.lit("unknown")), F.coalesce("lang", F.lit("xx")))
    name = F.concat(F.lit("LICENSE-"), i.cast("string"))
    path = (F.when(i % 48 == 0, F.concat_ws("/", F.coalesce("source", F.lit("unknown")), name))
            .when(i % 48 == 16, F.concat_ws("/", upper, name)).when(i % 48 == 32, F.concat_ws("/", folder, name))
            .otherwise(F.concat(folder, F.lit("/"), i.cast("string"), F.lit(".txt"))))
    return documents.select("doc_id", path.alias("path"), "text")
