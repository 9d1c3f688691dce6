"""Rule statistics of one text, and their ratios as Spark columns."""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import as_bytes, byte_words, small_batches

SYMBOLS = b"#*$%&|<>"
UTF8_TAILS = bytes(range(0x80, 0xC0))  # a code point has one byte outside this range

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper_words",
          "n_adjacent", "n_marked_words", "n_bangs", "n_stops", "n_digits", "n_distinct"]

STATS_TYPE = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS])


def _delete(data: bytes, chars: bytes) -> int:
    return len(data) - len(data.translate(None, chars))


def repeat_words(words: list[bytes], width: int = 3) -> int:
    """Words that lie in a ``width``-word window found twice or more in the text."""
    grams = list(zip(*(words[i:] for i in range(width))))
    counts = Counter(grams)
    if len(counts) == len(grams):
        return 0
    total, covered = 0, 0  # covered: end of the last covered word
    for i, g in enumerate(grams):
        if counts[g] > 1:
            total += i + width - max(i, covered)
            covered = i + width
    return total


def text_stats(data: bytes | None) -> tuple[int, ...]:
    """The counts of ``COUNTS`` for one UTF-8 text (None: all zero).

    A line counts if it holds a word; it is a duplicate if it equals an
    earlier line.  Marked words end in a symbol or are one (``word###``).
    """
    data = data or b""
    words = byte_words(data)
    seen: set[bytes] = set()
    lines = dup = 0
    for line in data.split(b"\n"):
        if line and not line.isspace():
            lines += 1
            dup += line in seen
            seen.add(line)
    chars = sum(map(len, words)) - _delete(data, UTF8_TAILS)
    return (len(words), chars, _delete(data, SYMBOLS), dup, repeat_words(words), lines,
            sum(w.isupper() for w in words), sum(a == b for a, b in zip(words, words[1:])),
            sum(w[-1] in SYMBOLS for w in words), _delete(data, b"!"), _delete(data, b".?,;"),
            _delete(data, b"0123456789"), len(set(words)))


def with_stats(docs: DataFrame, text: str = "text", name: str = "stats") -> DataFrame:
    """``docs`` with a struct column ``name`` of the counts of its whole texts."""
    @F.arrow_udf(STATS_TYPE)
    def stats(texts: pa.Array) -> pa.Array:
        rows = [text_stats(x) for x in as_bytes(texts)]
        columns = list(zip(*rows)) if rows else [[] for _ in COUNTS]
        return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names=COUNTS)

    return small_batches(docs).withColumn(name, stats(F.col(text)))


def ratios(stats: str = "stats") -> dict[str, Column]:
    """Scale-free statistics as columns over the counts; empty texts give zeros."""
    c = {n: F.col(f"{stats}.{n}").cast("double") for n in COUNTS}

    def per(a: str, b: str) -> Column:
        return F.coalesce(F.try_divide(c[a], c[b]), F.lit(0.0))

    return {
        "word_length": per("word_chars", "n_words"),
        "symbols_per_word": per("n_symbols", "n_words"),
        "dup_line_share": per("n_dup_lines", "n_lines"),
        "repeat_share": per("n_repeat_words", "n_words"),
        "upper_share": per("n_upper_words", "n_words"),
        "adjacent_share": per("n_adjacent", "n_words"),
        "marked_share": per("n_marked_words", "n_words"),
        "bangs_per_word": per("n_bangs", "n_words"),
        "stops_per_word": per("n_stops", "n_words"),
        "digits_per_word": per("n_digits", "n_words"),
        "distinct_share": per("n_distinct", "n_words"),
        "words_per_line": F.log1p(per("n_words", "n_lines")),
        "length": F.log1p(c["n_words"]),
    }
