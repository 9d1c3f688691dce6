"""Quality rules: an isolation forest over rule statistics.

Documents that fail a base rule are rejected.  The others are scored by an
isolation forest: random axis-parallel splits isolate unusual statistics in
few steps, so a short mean path means an anomaly.  Labelled rows calibrate it
twice: each statistic enters as its distance from the range that good rows
span (so that harmless variety inside it attracts no splits), and the score
above which a document is rejected is the one that best parts the labels.

Defined results: a null or empty text has zero words and fails the base rule;
rows with equal ids or texts are judged alike, row by row; an empty table gives
an empty result; without labelled rows (or without both labels) only the base
rules reject; labels that are null or other than 0/1 are ignored, repeated
labels of one id count once (the smallest).  Extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import cut, hash_sample
from quire.llm.textstats import ratios, with_stats

MIN_WORDS = 50           # fewer words fail
MAX_REPEAT_PERCENT = 50  # more repeated words fail
FEATURES = ["word_length", "symbols_per_word", "dup_line_share", "repeat_share", "upper_share", "adjacent_share",
            "marked_share", "bangs_per_word", "stops_per_word"]
N_TREES = 128
SUBSAMPLE = 256          # rows that one tree isolates
FIT_ROWS = 20_000        # labelled rows kept for drawing the trees' subsamples
CONTAMINATION = 0.01     # share of bad rows that the forest is grown on: anomalies must be few to be isolated
EDGE = 0.001             # good rows beyond either end of a statistic's normal range
FALSE_REJECTS = 0.002    # share of rows labelled good that the forest may reject
SCORE_BINS = 2_000       # resolution of the calibrated threshold


def _path_norm(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search among ``n`` rows."""
    n = np.maximum(np.asarray(n, float), 0)
    full = 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649015329) - 2 * (n - 1) / np.maximum(n, 1)
    return np.where(n > 2, full, np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    """Trees as arrays: split feature (-1 at leaves), split value, left child
    (right is left + 1) and the path length that ends at a leaf."""

    feature: np.ndarray
    value: np.ndarray
    left: np.ndarray
    path: np.ndarray
    depth: int
    norm: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Anomaly score in (0, 1): 2 ** -(mean path / expected path)."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for f, v, left, path in zip(self.feature, self.value, self.left, self.path):
            node = np.zeros(len(x), np.int32)
            for _ in range(self.depth):
                at = f[node]
                inner = at >= 0
                step = left[node] + (x[rows, np.maximum(at, 0)] >= v[node])
                node = np.where(inner, step, node)
            total += path[node]
        return np.exp2(-total / (len(self.feature) * self.norm))


def fit_forest(x: np.ndarray, n_trees: int = N_TREES, subsample: int = SUBSAMPLE, seed: int = 7) -> Forest:
    """Grow ``n_trees`` random isolation trees over subsamples of the rows of ``x``."""
    rng = np.random.default_rng(seed)
    size = min(subsample, len(x))
    depth = max(1, int(np.ceil(np.log2(max(size, 2)))))
    trees = []
    for _ in range(n_trees):
        feature, value, left, path = [-1], [0.0], [0], [0.0]
        open_nodes = [(0, x[rng.choice(len(x), size, replace=False)], 0)]
        while open_nodes:
            node, part, d = open_nodes.pop()
            low, high = (part.min(0), part.max(0)) if len(part) else (np.zeros(x.shape[1]),) * 2
            usable = np.flatnonzero(high > low)
            if d == depth or not len(usable):
                path[node] = d + float(_path_norm(len(part)))
                continue
            f = int(rng.choice(usable))
            v = float(rng.uniform(low[f], high[f]))
            feature[node], value[node], left[node] = f, v, len(feature)
            right = part[:, f] >= v
            for child in (part[~right], part[right]):
                open_nodes.append((len(feature), child, d + 1))
                feature.append(-1), value.append(0.0), left.append(0), path.append(0.0)
        trees.append([np.array(feature, np.int32), np.array(value), np.array(left, np.int32), np.array(path)])
    return Forest(*map(list, zip(*trees)), depth=depth, norm=max(float(_path_norm(size)), 1e-9))


@dataclass
class Rules:
    """Normal range of every statistic among good rows, and the forest on top."""

    low: np.ndarray
    high: np.ndarray
    forest: Forest | None = None

    def excess(self, x: np.ndarray) -> np.ndarray:
        """Distance outside the normal range, in ranges; square roots spread small ones."""
        span = np.maximum(self.high - self.low, 1e-3)
        return np.sqrt(np.maximum(np.maximum(self.low - x, x - self.high), 0) / span)

    def score(self, x: np.ndarray) -> np.ndarray:
        return self.forest.score(self.excess(x))


def fit_rules(x: np.ndarray, good: np.ndarray, edge: float = EDGE) -> Rules:
    """Ranges from the good rows of a labelled sample, the forest from these and a few bad ones."""
    normal = x[good] if good.any() else x
    rules = Rules(np.quantile(normal, edge, axis=0), np.quantile(normal, 1 - edge, axis=0))
    bad = np.random.default_rng(3).permutation(x[~good])[:max(1, int(CONTAMINATION * len(normal)))]
    rules.forest = fit_forest(rules.excess(np.concatenate([normal, bad])))
    return rules


def with_score(stats: DataFrame, model: Rules, name: str) -> DataFrame:
    """Add the anomaly score of the columns ``FEATURES`` of ``ratios``."""

    @F.arrow_udf("double")
    def score(*columns: pa.Array) -> pa.Array:
        return pa.array(model.score(np.column_stack([c.to_numpy(zero_copy_only=False) for c in columns])))

    r = ratios()
    return stats.withColumn(name, score(*[r[f] for f in FEATURES]))


def clean_labels(labels: DataFrame, target: str) -> DataFrame:
    """One row (label_id, label) per labelled id; null and other values are ignored."""
    return (labels.select(F.col("doc_id").alias("label_id"), F.col(target).cast("int").alias("label"))
            .filter("label_id IS NOT NULL AND label IN (0, 1)")
            .groupBy("label_id").agg(F.min("label").alias("label")))


def calibrate(scored: DataFrame, score: str, false_rejects: float = FALSE_REJECTS) -> float:
    """The score from which on rows are rejected: where the rejected shares of bad
    and good rows differ most, with at most ``false_rejects`` of the good ones.

    Counts per score bin and label (at most 2 * SCORE_BINS rows) come from all
    labelled rows.  Infinite without rows of both labels.
    """
    bins = (scored.groupBy(F.floor(F.col(score) * SCORE_BINS).cast("int").alias("bin"), "label").count().collect())
    good, bad = np.zeros(SCORE_BINS + 2), np.zeros(SCORE_BINS + 2)
    for r in bins:
        (good if r["label"] == 1 else bad)[r["bin"]] += r["count"]
    if not good.sum() or not bad.sum():
        return float("inf")
    lost = good[::-1].cumsum()[::-1] / good.sum()  # good rows in this bin or above
    gain = np.where(lost <= false_rejects, bad[::-1].cumsum()[::-1] / bad.sum() - lost, -1)
    best = len(gain) - 1 - int(gain[::-1].argmax())  # the highest of equal ones
    return best / SCORE_BINS if gain[best] > 0 else float("inf")


def base_failed(stats: str = "stats") -> Column:
    s = F.col(stats)
    return (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > MAX_REPEAT_PERCENT * s["n_words"])


def judge(docs: DataFrame, labels: DataFrame, target: str = "quality") -> DataFrame:
    """(doc_id, stats, base_failed, score, threshold, kept) for every row of ``docs``.

    Statistics are computed once and written to the shared folder without the
    texts; fitting, calibration and judging read that narrow table.
    """
    stats = cut(with_stats(docs.select("doc_id", "text")).select("doc_id", "stats"))
    r = ratios()
    known = stats.join(clean_labels(labels, target), F.col("doc_id") == F.col("label_id")).filter(~base_failed())
    sample = hash_sample(known.select("doc_id", "label", *[r[f].alias(f) for f in FEATURES]), "doc_id", FIT_ROWS,
                         ["label", *FEATURES]).toPandas()
    if len(sample):
        model = fit_rules(sample[FEATURES].to_numpy(float), sample["label"].to_numpy() == 1)
        threshold = calibrate(with_score(known, model, "score"), "score")
        scored = with_score(stats, model, "score")
    else:
        threshold, scored = float("inf"), stats.withColumn("score", F.lit(0.0))
    return scored.select("doc_id", "stats", base_failed().alias("base_failed"), "score", F.lit(threshold).alias("threshold"),
                         (~base_failed() & (F.col("score") < threshold)).alias("kept"))
