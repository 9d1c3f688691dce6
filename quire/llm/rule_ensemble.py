"""Quality classifier: a sparse rule ensemble over text statistics.

Boosted shallow trees on labelled rows give candidate rules (every path from a
root is a conjunction of threshold tests); an L1-penalised logistic regression
over the rules keeps the few that matter; these compile into one Spark column
expression, so scoring runs wherever the statistics are.

Fitting sees at most ``FIT_ROWS`` labelled rows (the smallest by a hash of the
id), never a held-out row, and no column but the statistics.

Defined results: null and empty texts have zero statistics and are scored like
any text; repeated rows score alike; an empty table gives an empty result;
labels that are null or other than 0/1 are ignored and repeated labels of one
id count once; without usable labels every score is 1, with one label only the
score is its smoothed share.  Extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import cut, hash_sample
from quire.llm.quality_rules import clean_labels
from quire.llm.textstats import ratios, with_stats

FIT_ROWS = 20_000
HELD_OUT = 2            # crc32(doc_id as text) mod 4 of rows never learned from
KEEP_FROM = 0.7         # score from which a document is predicted good
FEATURES = ["word_length", "symbols_per_word", "dup_line_share", "repeat_share", "upper_share", "adjacent_share",
            "marked_share", "bangs_per_word", "stops_per_word", "digits_per_word", "distinct_share", "words_per_line",
            "length"]


@dataclass
class Rule:
    """A conjunction of (feature, is_at_least, threshold) tests."""

    tests: tuple[tuple[int, bool, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for f, at_least, t in self.tests:
            out &= (x[:, f] >= t) == at_least
        return out

    def column(self, features: list[Column]) -> Column:
        out = None
        for f, at_least, t in self.tests:
            c = features[f] >= F.lit(float(t)) if at_least else features[f] < F.lit(float(t))
            out = c if out is None else out & c
        return out


@dataclass
class RuleEnsemble:
    """Logistic model over rules: score = sigmoid(intercept + sum of weights of the rules that hold)."""

    intercept: float
    rules: list[Rule] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)

    def predict(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.intercept)
        for rule, w in zip(self.rules, self.weights):
            z += w * rule.holds(x)
        return 1 / (1 + np.exp(-z))

    def column(self, features: list[Column]) -> Column:
        z = F.lit(float(self.intercept))
        for rule, w in zip(self.rules, self.weights):
            z = z + F.when(rule.column(features), F.lit(float(w))).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def _grow(bins: np.ndarray, edges: list[np.ndarray], grad: np.ndarray, hess: np.ndarray, rows: np.ndarray, depth: int,
          min_rows: int, tests: tuple, rules: list[Rule], update: np.ndarray) -> None:
    """Grow one tree node on binned features, record its path as a rule."""
    if tests:
        rules.append(Rule(tests))
    g, h = grad[rows].sum(), hess[rows].sum()
    best = (1e-6, None, None)
    if depth and len(rows) >= 2 * min_rows:
        for f, e in enumerate(edges):
            if not len(e):
                continue
            b = bins[rows, f]
            n = len(e) + 1
            gs, hs, ns = (np.bincount(b, w, n)[::-1].cumsum()[::-1][1:] for w in (grad[rows], hess[rows], None))
            gain = gs ** 2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g ** 2 / (h + 1)
            gain[(ns < min_rows) | (len(rows) - ns < min_rows)] = 0
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (gain[k], f, k)
    if best[1] is None:
        update[rows] = g / (h + 1)
        return
    _, f, k = best
    high = bins[rows, f] > k
    for part, at_least in ((rows[~high], False), (rows[high], True)):
        _grow(bins, edges, grad, hess, part, depth - 1, min_rows, (*tests, (f, at_least, float(edges[f][k]))), rules, update)


def extract_rules(x: np.ndarray, y: np.ndarray, n_trees: int = 40, depth: int = 3, share: float = 0.5, rate: float = 0.3,
                  n_bins: int = 64, seed: int = 11) -> list[Rule]:
    """Distinct root paths of boosted trees, each grown on a random ``share`` of the rows."""
    rng = np.random.default_rng(seed)
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, n_bins + 1)[1:-1])) for c in x.T]
    edges = [e[e > c.min()] for e, c in zip(edges, x.T)]
    bins = np.column_stack([np.searchsorted(e, c, side="right") for e, c in zip(edges, x.T)])
    z = np.full(len(y), np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    min_rows = max(5, len(y) // 500)
    rules: list[Rule] = []
    for _ in range(n_trees):
        p = 1 / (1 + np.exp(-z))
        rows = np.flatnonzero(rng.random(len(y)) < share)
        update = np.zeros(len(y))
        new: list[Rule] = []
        _grow(bins, edges, y - p, np.maximum(p * (1 - p), 1e-6), rows, depth, min_rows, (), new, update)
        # rows outside the sample take the step of the leaf they fall into
        step = np.zeros(len(y))
        for rule in new:
            inside = rule.holds(x)
            known = inside & (update != 0)
            if known.any():
                step[inside] = update[known].mean()
        z += rate * step
        rules += new
    return list({r.tests: r for r in rules}.values())


def lasso_logistic(a: np.ndarray, y: np.ndarray, penalty: float, steps: int = 300) -> tuple[float, np.ndarray]:
    """L1-penalised logistic regression by accelerated proximal gradient steps; the
    intercept is free.  Centres the columns of ``a`` in place."""
    n, m = a.shape
    center = a.mean(0, dtype=float)
    a -= center.astype(a.dtype)
    bound = 0.25 * (float(np.linalg.eigvalsh((a.T @ a).astype(float) / n)[-1]) + 1)
    b = vb = float(np.log((y.sum() + 1) / (n - y.sum() + 1)))
    w, vw, t = np.zeros(m), np.zeros(m), 1.0
    for _ in range(steps):
        r = 1 / (1 + np.exp(-(a @ vw.astype(a.dtype) + vb))) - y
        nw = vw - (a.T @ r.astype(a.dtype)) / n / bound
        nw = np.sign(nw) * np.maximum(np.abs(nw) - penalty / bound, 0)
        nb = vb - r.mean() / bound
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        vw, vb = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    return float(b - center @ w), w


def fit(x: np.ndarray, y: np.ndarray, penalty: float = 0.002) -> RuleEnsemble:
    """Fit the ensemble on statistics ``x`` and labels ``y`` (0 or 1)."""
    y = np.asarray(y, float)
    if not len(y):
        return RuleEnsemble(40.0)
    if y.min() == y.max():
        return RuleEnsemble(float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))))
    rules = extract_rules(x, y)
    if not rules:
        return RuleEnsemble(float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))))
    distinct = {np.packbits(r.holds(x)).tobytes(): r for r in reversed(rules)}  # rules alike on all rows enter once
    rules = [r for r in rules if distinct[np.packbits(r.holds(x)).tobytes()] is r]
    holds = np.empty((len(x), len(rules)), np.float32)
    for k, r in enumerate(rules):
        holds[:, k] = r.holds(x)
    intercept, w = lasso_logistic(holds, y, penalty)
    return RuleEnsemble(intercept, [r for r, v in zip(rules, w) if v], [float(v) for v in w if v])


def is_held_out(doc_id: Column | str = "doc_id") -> Column:
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(4)) == HELD_OUT, F.lit(False))


def learn(stats: DataFrame, labels: DataFrame, target: str = "quality", fit_rows: int = FIT_ROWS) -> RuleEnsemble:
    """Fit on a bounded sample of the labelled rows of ``stats`` that are not held out."""
    r = ratios()
    known = stats.join(clean_labels(labels, target), F.col("doc_id") == F.col("label_id")).filter(~is_held_out())
    known = cut(known.select("doc_id", "label", *[r[f].alias(f) for f in FEATURES]))
    sample = hash_sample(known, "doc_id", fit_rows, ["label", *FEATURES]).toPandas()
    return fit(sample[FEATURES].to_numpy(float), sample["label"].to_numpy(float))


def with_quality(docs: DataFrame, model: RuleEnsemble, score: str, text: str = "text") -> DataFrame:
    """``docs`` with a column ``score``; statistics are computed in the same pass."""
    own = "__quality_stats"
    r = ratios(own)
    return with_stats(docs, text, own).withColumn(score, model.column([r[f] for f in FEATURES])).drop(own)


def classify(docs: DataFrame, labels: DataFrame, target: str = "quality") -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``; texts are read once."""
    stats = cut(with_stats(docs.select("doc_id", "text")).select("doc_id", "stats"))
    r = ratios()
    score = learn(stats, labels, target).column([r[f] for f in FEATURES])
    return (stats.select("doc_id", is_held_out().alias("held_out"), score.alias("score"))
            .withColumn("predicted", (F.col("score") >= KEEP_FROM).cast("int")))


def keep_good(docs: DataFrame, labels: DataFrame, target: str = "quality") -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, unchanged.

    Two passes over the texts: the first yields the narrow statistics that the
    model is fitted on, the second scores and filters in place, so no text is
    shuffled.
    """
    stats = with_stats(docs.select("doc_id", "text")).select("doc_id", "stats")
    model = learn(stats, labels, target)
    score = "__quality_score"
    return with_quality(docs, model, score).filter(F.col(score) >= KEEP_FROM).drop(score)
