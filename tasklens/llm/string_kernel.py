"""Toxicity by a support vector machine with a gapped-subsequence string kernel and Nyström landmarks.

The kernel of two words counts common subsequences of three characters, each weighted by `decay` to the length that it
spans in either word, so inserted or changed characters cost little. It is normalised, raised to `power`, which leaves
only close likeness, and summed over the words of a sentence. A sentence's kernel values with fixed landmark words are
its features; the machine is linear in them. Training labels belong to documents, so the sentence of a toxic document
that scores highest stands for it, and the machine is fitted again.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasklens.llm.rules import labelled_sample
from tasklens.llm.staging import received, send

SYMBOLS = 40  # 0 filling, 1-26 letters, 27 digits, 28 other ASCII, 29-39 the rest, dealt by code point
_ASCII = np.full(128, 28, np.int64)
_ASCII[97:123] = np.arange(1, 27)
_ASCII[48:58] = 27


def encode(words: list[str], length: int) -> np.ndarray:
    """Symbols of words of one length."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), length).astype(np.int64)
    return np.where(points < 128, _ASCII[np.minimum(points, 127)], 29 + points % 11)


def pieces(word: str, size: int = 12) -> list[str]:
    """The word, or overlapping pieces that cover a long one."""
    if len(word) <= size:
        return [word]
    return [word[i: i + size] for i in range(0, len(word) - size // 2, size // 2)]


def _triples(length: int, decay: float) -> tuple[np.ndarray, np.ndarray]:
    at = np.array(list(combinations(range(length), 3)), np.int64).reshape(-1, 3)
    return at, (decay ** (at[:, 2] - at[:, 0] + 1)).astype(np.float32)


def subsequences(words: list[str], length: int, decay: float):
    """Code of every three-character subsequence of each word, its weight, and the norm of each word."""
    symbols = encode(words, length)
    at, weight = _triples(length, decay)
    codes = (symbols[:, at[:, 0]] * SYMBOLS + symbols[:, at[:, 1]]) * SYMBOLS + symbols[:, at[:, 2]]
    turn = np.argsort(codes, axis=1)
    sorted_codes, weights = np.take_along_axis(codes, turn, 1), weight[turn]
    head = np.ones(codes.shape, bool)
    head[:, 1:] = sorted_codes[:, 1:] != sorted_codes[:, :-1]
    sums = np.add.reduceat(weights.ravel(), np.flatnonzero(head.ravel()))
    norm = np.sqrt(np.bincount(np.nonzero(head)[0], sums**2, minlength=len(words)))
    return codes, weight, norm


@dataclass(frozen=True)
class Landmarks:
    """Words to compare with; `table` has a row for each subsequence code with its normalised weight in each landmark."""

    table: np.ndarray
    decay: float
    power: int

    @staticmethod
    def of(words: list[str], decay: float, power: int) -> Landmarks:
        table = np.zeros((SYMBOLS**3, len(words)), np.float32)
        for j, word in enumerate(words):
            codes, weight, norm = subsequences([word], len(word), decay)
            np.add.at(table[:, j], codes[0], weight / norm[0])
        return Landmarks(table, decay, power)

    def kernel(self, words: list[str]) -> np.ndarray:
        """Kernel of each word with each landmark; that of a long word is the largest of its pieces'."""
        result = np.zeros((len(words), self.table.shape[1]), np.float32)
        whole: dict[int, list[tuple[int, str]]] = {}
        split: dict[int, list[tuple[int, str]]] = {}
        for row, word in enumerate(words):
            parts = pieces(word)
            by_length = whole if len(parts) == 1 else split
            for piece in parts:
                if len(piece) >= 3:
                    by_length.setdefault(len(piece), []).append((row, piece))
        for length, found in [*whole.items(), *split.items()]:
            for i in range(0, len(found), 512):
                rows, part = zip(*found[i: i + 512], strict=True)
                codes, weight, norm = subsequences(list(part), length, self.decay)
                value = np.zeros((len(part), self.table.shape[1]), np.float32)
                for t in range(codes.shape[1]):
                    value += weight[t] * self.table[codes[:, t]]
                value /= norm[:, None]
                if found is whole.get(length):
                    result[list(rows)] = value
                else:
                    np.maximum.at(result, np.array(rows), value)
        return np.power(result, self.power, out=result)


_EDGES = ".,!?;:\"'()[]{}*#$%&|"


@dataclass(frozen=True)
class Sentences:
    """Words of texts: `code` numbers `vocabulary`, `sentence` counts on over the texts, `owner` has each sentence's text."""

    vocabulary: list[str]
    code: np.ndarray
    sentence: np.ndarray
    owner: np.ndarray

    @staticmethod
    def of(texts: list[str | None]) -> Sentences:
        """A sentence ends with a word that ends in . ! or ? and with its text. Three or more single letters in a row
        also make a word; a word that follows itself counts once."""
        tokens = [(t or "").lower().split() for t in texts]
        text = np.repeat(np.arange(len(texts)), [len(t) for t in tokens])
        raw, seen = pd.factorize(np.array([w for t in tokens for w in t], object))
        clean, vocabulary = pd.factorize(np.array([w.strip(_EDGES) for w in seen], object))
        ends = np.array([w[-1] in ".!?" for w in seen], bool)[raw]
        single = np.array([len(w) == 1 for w in vocabulary], bool)
        code = clean[raw] if len(raw) else np.empty(0, np.int64)
        new = np.ones(len(code), bool)
        new[1:] = ends[:-1] | (text[1:] != text[:-1])
        sentence = np.cumsum(new) - 1
        owner, vocabulary = text[new], list(vocabulary)
        spelt_code, spelt_sentence = Sentences._spelt(code, text, sentence, single, vocabulary)
        again = np.zeros(len(code), bool)
        again[1:] = (code[1:] == code[:-1]) & ~new[1:]
        code = np.concatenate([code[~again], spelt_code])
        sentence = np.concatenate([sentence[~again], spelt_sentence])
        turn = np.argsort(sentence, kind="stable") if len(spelt_code) else slice(None)
        return Sentences(vocabulary, code[turn], sentence[turn], owner)

    @staticmethod
    def _spelt(code, text, sentence, single, vocabulary) -> tuple[np.ndarray, np.ndarray]:
        """Words put together from single letters; they are added to the vocabulary."""
        alone = single[code] if len(code) else np.empty(0, bool)
        first, last = alone.copy(), alone.copy()
        first[1:] &= ~alone[:-1] | (text[1:] != text[:-1])
        last[:-1] &= ~alone[1:] | (text[1:] != text[:-1])
        runs = [(a, b) for a, b in zip(np.flatnonzero(first), np.flatnonzero(last), strict=True) if b - a >= 2]
        known = {}
        for a, b in runs:
            known.setdefault("".join(vocabulary[c] for c in code[a: b + 1]), len(vocabulary) + len(known))
        codes = [known["".join(vocabulary[c] for c in code[a: b + 1])] for a, b in runs]
        vocabulary.extend(known)
        return np.array(codes, np.int64), sentence[[b for _, b in runs]] if runs else np.empty(0, np.int64)


def squared_hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float, rounds: int = 30):
    """Weights and intercept of an L2 support vector machine, by Newton steps. y is -1 or 1."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    w, active = np.zeros(x.shape[1]), None
    for _ in range(rounds):
        inside = y * (x @ w) < 1
        if active is not None and (inside == active).all():
            break
        active = inside
        z = x[inside] * weight[inside, None]
        w = np.linalg.solve(z.T @ x[inside] + np.diag(penalty), z.T @ y[inside])
    return w[:-1], w[-1]


def _platt(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset that make a margin a probability, with both labels of equal weight in all."""
    x = np.stack([margin, np.ones(len(margin))], axis=1)
    weight = len(y) / 2 / np.where(y > 0, max(1, (y > 0).sum()), max(1, (y <= 0).sum()))
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + 0.01 * w
        w -= np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(2), gradient)
    return float(w[0]), float(w[1])


@dataclass(frozen=True)
class ToxicityModel:
    landmarks: Landmarks | None
    weights: np.ndarray | None
    bias: float
    slope: float
    offset: float
    known: dict[str, float] = field(default_factory=dict, compare=False)

    def margins(self, texts: list[str | None]) -> np.ndarray:
        """Largest sentence margin of each text; that of no words where it has none."""
        found = Sentences.of(texts)
        result = np.full(len(texts), self.bias)
        if len(found.owner):
            value = self.values(found.vocabulary)
            sums = np.bincount(found.sentence, value[found.code], minlength=len(found.owner))
            np.maximum.at(result, found.owner, self.bias + sums)
        return result

    def values(self, words: list[str]) -> np.ndarray:
        """What each word adds to a margin; remembered, up to a bound, for the next texts of this worker."""
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > 600_000:
            self.known.clear()
            new = words
        self.known.update(zip(new, (self.landmarks.kernel(new) @ self.weights).tolist(), strict=True))
        return np.fromiter(map(self.known.__getitem__, words), float, len(words))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        margin = self.margins(texts) if self.landmarks else np.zeros(len(texts))
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30)))


def _choose(found: Sentences, labels: np.ndarray, count: int, decay: float) -> list[str]:
    """Landmark words: two thirds from those most tied to label 1, spread out by the kernel, the rest from common words."""
    once = np.unique(found.owner[found.sentence] * len(found.vocabulary) + found.code)
    text, code = np.divmod(once, len(found.vocabulary))
    in_toxic = np.bincount(code, labels[text], minlength=len(found.vocabulary))
    in_clean = np.bincount(code, minlength=len(found.vocabulary)) - in_toxic
    size = np.maximum(1, [(labels == 0).sum(), (labels == 1).sum()])
    tie = in_toxic * np.log(((in_toxic + 0.5) / size[1]) / ((in_clean + 0.5) / size[0]))
    usable = np.array([3 <= len(w) <= 12 for w in found.vocabulary], bool)
    pool = [i for i in np.lexsort([found.vocabulary, -tie]) if usable[i] and tie[i] > 0][:200]
    chosen: list[int] = []
    if pool:
        words = [found.vocabulary[i] for i in pool]
        like, strength = Landmarks.of(words, decay, 1).kernel(words), tie[pool]
        nearest = np.zeros(len(pool))
        while len(chosen) < min(len(pool), 2 * count // 3):
            k = int((strength * np.maximum(0, 1 - nearest**4)).argmax())
            chosen.append(pool[k])
            nearest, strength[k] = np.maximum(nearest, like[k]), -1.0
    common = [i for i in np.lexsort([found.vocabulary, -in_clean]) if usable[i] and i not in set(chosen)]
    return [found.vocabulary[i] for i in chosen + common[: count - len(chosen)]]


def fit_toxicity(rows: list[tuple[str | None, int]], landmarks: int = 96, decay: float = 0.75, power: int = 3,
                 ridge: float = 1.0, rounds: int = 4, sentences_a_text: int = 20) -> ToxicityModel:
    """Fit on labelled texts. A text of label 0 gives up to `sentences_a_text` evenly spaced sentences to the fit."""
    labels = np.array([label for _, label in rows], np.int64)
    share = min(max(labels.mean() if len(labels) else 0.5, 1e-3), 1 - 1e-3)
    constant = ToxicityModel(None, None, 0.0, 0.0, math.log(share / (1 - share)))
    if len(np.unique(labels)) < 2:
        return constant
    found = Sentences.of([t for t, _ in rows])
    words = _choose(found, labels, landmarks, decay)
    if not words:
        return constant
    marks = Landmarks.of(words, decay, power)
    values = marks.kernel(found.vocabulary)
    starts = np.append(np.flatnonzero(np.diff(found.sentence, prepend=-1)), len(found.code))
    place = np.arange(len(found.owner)) - np.searchsorted(found.owner, found.owner)
    total = np.bincount(found.owner, minlength=len(rows))[found.owner]
    picked = (labels[found.owner] == 1) | (place * sentences_a_text % total < sentences_a_text)
    owner = found.owner[picked]
    x = np.stack([values[found.code[starts[i]: starts[i + 1]]].sum(axis=0) for i in np.flatnonzero(picked)])
    toxic = labels[owner] == 1
    # Nyström: features times the inverse root of the landmarks' own kernel are plain coordinates.
    value, vector = np.linalg.eigh((marks.table.T @ marks.table).astype(float) ** power)
    root = vector @ np.diag(1 / np.sqrt(np.maximum(value, 1e-3))) @ vector.T
    z = x.astype(float) @ root
    direction = z[toxic].mean(axis=0) - z[~toxic].mean(axis=0)
    for _ in range(rounds):
        best = pd.Series((z @ direction)[toxic]).groupby(owner[toxic]).idxmax().to_numpy()
        rows_in = np.concatenate([np.flatnonzero(toxic)[best], np.flatnonzero(~toxic)])
        y = np.where(toxic[rows_in], 1.0, -1.0)
        weight = np.where(y > 0, min(10.0, (y < 0).sum() / (y > 0).sum()), 1.0)
        direction, bias = squared_hinge(z[rows_in], y, weight, ridge)
    del values, x, z
    model = ToxicityModel(marks, root @ direction, float(bias), 1.0, 0.0)
    margins = [model.margins([t for t, _ in rows[i: i + 500]]) for i in range(0, len(rows), 500)]
    slope, offset = _platt(np.concatenate(margins), labels)
    return ToxicityModel(marks, model.weights, model.bias, slope, offset)


def toxicity_scores(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", max_rows: int = 3_000,
                    id_col: str = "doc_id", text_col: str = "text", **fit) -> DataFrame:
    """Score of every text by a string-kernel machine fitted to the labelled rows in `labels`.

    At most `max_rows` labelled rows, picked by a hash of the id, are fitted on the driver. Returns one row per input
    row: doc_id and score, from 0 to 1. Whole texts are scored, sentence by sentence. A null, empty or wordless text has
    the score of a sentence without words. Without labels of both kinds the score is the share of label 1, kept off 0
    and 1, or 0.5 without any. Labels that are null or have a null id are left out. Repeated rows and null ids are
    scored like others; other columns are ignored; a table without rows gives none.
    """
    spark = docs.sparkSession
    rows = labelled_sample(docs, labels, label_col, max_rows, id_col, text_col)
    model = send(
        spark, fit_toxicity(sorted(((r.text, int(r.label > 0)) for r in rows.collect()), key=lambda r: (r[0] or "", r[1])), **fit))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = received(model)
        for batch in batches:
            scores = [held.scores(batch.column("text").slice(i, 4000).to_pylist())
                      for i in range(0, batch.num_rows, 4000)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.concatenate([np.empty(0), *scores]))], ["doc_id", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        task, "doc_id long, score double")
