"""Sparse rule ensemble over text statistics: boosted trees give rules, a lasso picks a few, columns apply them.

The fit sees a bounded sample of labelled rows; scoring is one Spark expression over every row.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _share(text: Column, pattern: str) -> Column:
    """Share of characters that match."""
    return F.length(F.regexp_replace(text, pattern, "")) / F.greatest(F.length(text), F.lit(1))


STATISTICS = ["pieces", "chars_a_piece", "distinct_pieces", "capitals", "digits", "stops", "marks", "bars", "lines"]


def _let(value: Column, use) -> Column:
    """An expression that uses a value many times and has it computed once, whatever the optimiser moves."""
    return F.get(F.transform(F.array(value), use), 0)


def statistics(text: Column) -> Column:
    """Struct of the statistics of a text; a null text counts as empty."""

    def of(t: Column, pieces: Column) -> Column:
        size = F.greatest(F.size(pieces), F.lit(1))
        values = [
            F.size(pieces),
            F.length(t) / size,
            F.size(F.array_distinct(pieces)) / size,
            _share(t, r"[^\p{Lu}]+"),
            _share(t, r"[^0-9]+"),
            _share(t, r"[^.,]+"),
            _share(t, r"[\p{L}0-9.,\s]+"),
            _share(t, r"[^|]+"),
            _share(t, r"[^\n]+"),
        ]
        return F.struct(*(v.cast("double").alias(n) for v, n in zip(values, STATISTICS, strict=True)))

    return _let(F.coalesce(text, F.lit("")), lambda t: _let(F.split(t, r"[ \t-\r]+"), lambda p: of(t, p)))


@dataclass(frozen=True)
class Rule:
    """All of the conditions (statistic, is it greater, threshold)."""

    conditions: tuple[tuple[int, bool, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        result = np.ones(len(x), bool)
        for at, greater, limit in self.conditions:
            result &= (x[:, at] > limit) == greater
        return result

    def column(self, row: Column) -> Column:
        result = F.lit(True)
        for at, greater, limit in self.conditions:
            value = row[STATISTICS[at]]
            result = result & (value > limit if greater else value <= limit)
        return result


def _grow(x: np.ndarray, gradient: np.ndarray, depth: int, least: int, cuts: list[np.ndarray], path=()):
    """Regression tree on the gradient. Yields (rule path, value) of the leaves and the paths of inner nodes."""
    value = gradient.mean() if len(gradient) else 0.0
    best = (0.0, None, None)
    if depth and len(x) >= 2 * least:
        for at, limits in enumerate(cuts):
            bins = np.searchsorted(limits, x[:, at], "left")
            count = np.cumsum(np.bincount(bins, minlength=len(limits) + 1))[:-1]
            total = np.cumsum(np.bincount(bins, gradient, minlength=len(limits) + 1))[:-1]
            fits = (count >= least) & (len(x) - count >= least)
            if fits.any():
                rest = len(x) - count
                gain = np.where(fits, total**2 / np.maximum(count, 1) + (gradient.sum() - total) ** 2 / np.maximum(rest, 1)
                                - gradient.sum() ** 2 / len(x), 0)
                k = int(gain.argmax())
                if gain[k] > best[0] + 1e-9:
                    best = (gain[k], at, limits[k])
    _, at, limit = best
    yield path, value, at is None
    if at is not None:
        for greater in (False, True):
            side = (x[:, at] > limit) == greater
            yield from _grow(x[side], gradient[side], depth - 1, least, cuts, (*path, (at, greater, float(limit))))


def tree_rules(x: np.ndarray, y: np.ndarray, trees: int, depth: int, rate: float, least: int, seed: int) -> list[Rule]:
    """Every path of boosted trees, each grown on a random half of the rows, as a rule."""
    random = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(column, np.linspace(0.01, 0.99, 64))) for column in x.T]
    base = min(max(y.mean(), 1e-3), 1 - 1e-3)
    margin, rules = np.full(len(y), math.log(base / (1 - base))), {}
    for _ in range(trees):
        half = random.random(len(y)) < 0.5
        gradient = y - 1 / (1 + np.exp(-margin))
        for path, value, leaf in _grow(x[half], gradient[half], depth, least, cuts):
            if path:
                rule = Rule(path)
                rules[rule] = None
                if leaf:
                    margin[rule.holds(x)] += rate * 4 * value
    return list(rules)


def lasso_logistic(x: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 400) -> tuple[float, np.ndarray]:
    """Intercept and weights of L1-penalised logistic regression, by accelerated proximal steps."""
    n, (bias, w) = len(y), (0.0, np.zeros(x.shape[1]))
    step = 4 / (1 + np.linalg.norm(x, 2) ** 2 / n) if x.size else 1.0
    look_bias, look, t = bias, w, 1.0
    for _ in range(rounds):
        residual = 1 / (1 + np.exp(-(x @ look + look_bias))) - y
        next_bias = look_bias - step * residual.mean()
        moved = look - step * (x.T @ residual / n)
        next_w = np.sign(moved) * np.maximum(np.abs(moved) - step * penalty, 0)
        t_next = (1 + math.sqrt(1 + 4 * t * t)) / 2
        look_bias = next_bias + (t - 1) / t_next * (next_bias - bias)
        look = next_w + (t - 1) / t_next * (next_w - w)
        bias, w, t = next_bias, next_w, t_next
    return bias, w


@dataclass(frozen=True)
class RuleModel:
    bias: float
    weighted: list[tuple[Rule, float]]

    def score(self, text: Column) -> Column:
        def of(row: Column) -> Column:
            total = F.lit(float(self.bias))
            for rule, weight in self.weighted:
                total = total + F.when(rule.column(row), F.lit(float(weight))).otherwise(F.lit(0.0))
            return 1 / (1 + F.exp(-total))

        return _let(statistics(text), of)


def fit_rules(sample: DataFrame, trees: int = 40, depth: int = 3, rate: float = 0.3, least: int = 10,
              penalty: float = 0.002, seed: int = 5) -> RuleModel:
    """Fit to columns text and label, on the driver. The sample must be bounded: its statistics and labels come here."""
    rows = sample.select(statistics(F.col("text")).alias("s"), "label").collect()
    data = np.array(sorted((*r["s"], r["label"]) for r in rows), float).reshape(-1, len(STATISTICS) + 1)
    x, y = data[:, :-1], data[:, -1]
    if len(np.unique(y)) < 2:
        share = float(y.mean()) if len(y) else 0.5
        share = min(max(share, 1e-3), 1 - 1e-3)
        return RuleModel(math.log(share / (1 - share)), [])
    rules = tree_rules(x, y, trees, depth, rate, least, seed)
    matrix = np.stack([r.holds(x) for r in rules], axis=1).astype(float) if rules else np.zeros((len(y), 0))
    bias, weights = lasso_logistic(matrix, y, penalty)
    return RuleModel(bias, [(r, w) for r, w in zip(rules, weights, strict=True) if abs(w) > 1e-6])


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, max_rows: int, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Text and label of at most `max_rows` labelled documents, picked by a hash of the id. Null labels and ids go.

    The picked labels are bounded, so they are sent to the documents and no text is shuffled.
    """
    picked = labels.select(F.col(id_col).alias("label_id"), F.col(label_col).cast("int").alias("label")).dropna()
    picked = picked.orderBy(F.xxhash64("label_id"), "label_id", "label").limit(max_rows)
    return docs.select(F.col(id_col).alias("label_id"), F.col(text_col).alias("text")).join(
        F.broadcast(picked), "label_id").select("text", "label")


def quality_scores(docs: DataFrame, labels: DataFrame, label_col: str = "quality", max_rows: int = 20_000,
                   id_col: str = "doc_id", text_col: str = "text", **fit) -> DataFrame:
    """Score of every text by a rule ensemble fitted to the labelled rows in `labels`.

    Returns one row per input row: doc_id and score, from 0 to 1. The rules see statistics of the whole text only. A
    null text counts as empty, and an empty text has all statistics 0. Without labels of both kinds the score is the
    share of label 1, kept off 0 and 1, or 0.5 without any. Labels that are null or have a null id are left out; labels
    repeated for one id all count. Repeated rows and null ids are scored like others; other columns are ignored.
    """
    model = fit_rules(labelled_sample(docs, labels, label_col, max_rows, id_col, text_col), **fit)
    return docs.select(F.col(id_col).alias("doc_id"), model.score(F.col(text_col)).alias("score"))


def accepted(docs: DataFrame, labels: DataFrame, least: float, label_col: str = "quality", max_rows: int = 20_000,
             id_col: str = "doc_id", text_col: str = "text", **fit) -> DataFrame:
    """Rows of docs whose score, as in `quality_scores`, is at least `least`, with all their columns."""
    model = fit_rules(labelled_sample(docs, labels, label_col, max_rows, id_col, text_col), **fit)
    return docs.filter(model.score(F.col(text_col)) >= least)
