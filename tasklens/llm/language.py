"""Language identification by words first, then by ever shorter character n-grams.

A word that training has seen often scores by its log frequency in each language. Any other word is read from left to
right: at each place the longest known n-gram scores. Words and n-grams are counted over all training documents. The
counts stay in Spark; tasks hold the most frequent words and n-grams, and any other word of a text is joined to the counts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasklens.llm.hashing import MULTIPLIER, mix
from tasklens.llm.phrase_trie import slot_filter
from tasklens.llm.staging import materialize, received, send

_LETTERS = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"


def words_of(text: str | None) -> list[str]:
    return _LETTERS.findall(text.lower()) if text else []


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: dict[str, Counter] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
            counts.setdefault(lang, Counter()).update(words_of(text.as_py()))
        for lang, found in counts.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(found), pa.string()), pa.array(list(found), pa.string()),
                 pa.array(list(found.values()), pa.int64())], ["lang", "word", "n"])


def _frequent(counts: DataFrame, most: int) -> Column:
    """Whether n is at least a limit that leaves `most` rows or fewer. The limit comes from a histogram of fixed size."""
    level = F.floor(F.log2("n") * 8)
    found = sorted(counts.groupBy(level.alias("level")).count().collect(), key=lambda r: -r["level"])
    total, least = 0, None
    for row in found:
        total += row["count"]
        if total > most:
            break
        least = row["level"]
    return F.lit(False) if least is None else level >= least


def _gram_hashes(points: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k code points from each place."""
    count = max(0, len(points) - k + 1)
    total = np.full(count, k, np.uint64)
    for j in range(k):
        total = total * MULTIPLIER + points[j: j + count]
    return mix(total)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)


@dataclass(frozen=True)
class _Spelling:
    """Words one after the other, with marks at their ends, and the places of their n-grams."""

    text: str
    points: np.ndarray
    word: np.ndarray  # which word a place belongs to

    @classmethod
    def of(cls, words: list[str]) -> _Spelling:
        text = "".join(f"^{w}$\0" for w in words)
        return cls(text, _points(text), np.repeat(np.arange(len(words)), [len(w) + 3 for w in words]))

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places where k code points of one word begin, and the hashes of these."""
        n = max(0, len(self.points) - k + 1)
        one_word = self.word[:n] == self.word[k - 1: k - 1 + n]
        place = np.flatnonzero(one_word & (self.points[k - 1: k - 1 + n] != 0))
        return place, _gram_hashes(self.points, k)[place]


def _count_grams(langs: int, longest: int):
    """Every n-gram of a batch of words, with its counts by language."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spelling = _Spelling.of(batch.column("word").to_pylist())
            counts = batch.column("counts").flatten().to_numpy().reshape(-1, langs)
            for k in range(1, longest + 1):
                place, hashes = spelling.grams(k)
                _, first, code = np.unique(hashes, return_index=True, return_inverse=True)
                grams = [spelling.text[i: i + k] for i in place[first]]
                of = counts[spelling.word[place]]
                sums = np.stack([np.bincount(code, of[:, j], minlength=len(grams)) for j in range(langs)], axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(grams, pa.string()), _lists(sums.astype(np.int64))], ["gram", "counts"])

    return task


def _lists(values: np.ndarray) -> pa.Array:
    """Rows of a matrix as lists."""
    rows, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * width), pa.array(values.ravel()))


def _word_keys(words: list[str]) -> np.ndarray:
    """64-bit hash of each word, as Spark's xxhash64 gives it."""
    return np.fromiter((xxhash.xxh64_intdigest(w.encode(), 42) for w in words), np.uint64, len(words))


@dataclass(frozen=True)
class HeldModel:
    """What tasks hold: hashes of words and n-grams, in order, and their log frequencies by language. A bit of `outside`
    is set for each known word that isn't held. `whole` says whether all n-grams are."""

    word_keys: np.ndarray
    word_values: np.ndarray
    gram_keys: np.ndarray
    gram_values: np.ndarray
    longest: int
    outside: np.ndarray
    whole: bool
    base: np.ndarray  # log frequency of a word that a language doesn't have

    def find(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log likelihood of each word in each language, and whether it is final. Others have the base."""
        keys = _word_keys(words)
        at, here = _look_up(self.word_keys, keys)
        values = np.tile(self.base, (len(words), 1))
        values[here] = self.word_values[at[here]]
        slot = keys & np.uint64(8 * len(self.outside) - 1)
        maybe = (self.outside[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1
        unseen = ~here & ~maybe if self.whole else np.zeros(len(words), bool)
        values[unseen] = self.spelt([words[i] for i in np.flatnonzero(unseen)])
        return values, here | unseen

    def spelt(self, words: list[str]) -> np.ndarray:
        """Mean over the places of each word of the longest known n-gram there, all words at once."""
        spelling = _Spelling.of(words)
        found = np.full(len(spelling.points), -1)
        for k in range(self.longest, 0, -1):
            place, hashes = spelling.grams(k)
            open_ = found[place] < 0
            at, here = _look_up(self.gram_keys, hashes[open_])
            found[place[open_][here]] = at[here]
        hit = np.flatnonzero(found >= 0)
        times = np.maximum(1, np.bincount(spelling.word[hit], minlength=len(words)))
        values = self.gram_values[found[hit]]
        sums = [np.bincount(spelling.word[hit], values[:, j], minlength=len(words)) for j in range(values.shape[1])]
        return np.stack(sums, axis=1) / times[:, None]


def _look_up(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the wanted among keys in order, and whether they are there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


@dataclass(frozen=True)
class LanguageModel:
    """Known words and n-grams, each with a row of log frequencies by language."""

    langs: list[str]
    words: list[str]
    word_values: np.ndarray
    grams: list[str]
    gram_values: np.ndarray
    longest: int

    def held(self, outside: np.ndarray, whole: bool, base: np.ndarray) -> HeldModel:
        words, grams = _word_keys(self.words), np.array([_gram_hashes(_points(g), len(g))[0] for g in self.grams], np.uint64)
        by_word, by_gram = np.argsort(words), np.argsort(grams)
        return HeldModel(words[by_word], self.word_values[by_word], grams[by_gram], self.gram_values[by_gram], self.longest,
                         outside, whole, base)

    @cached_property
    def _held(self) -> HeldModel:
        return self.held(np.zeros(1, np.uint8), True, np.zeros(len(self.langs)))

    def likelihoods(self, words: list[str]) -> np.ndarray:
        """Log likelihood of each word in each language."""
        return self._held.find(words)[0]


@dataclass(frozen=True)
class LanguageCounts:
    """Counts of all words and n-grams of the training texts, in columns word or gram, counts (by language, in order)
    and n, their sum."""

    langs: list[str]
    words: DataFrame
    grams: DataFrame
    in_words: np.ndarray  # sums by language
    in_grams: np.ndarray

    def _of(self, key: str) -> tuple[DataFrame, np.ndarray]:
        return (self.words, self.in_words) if key == "word" else (self.grams, self.in_grams)

    def base(self, key: str) -> np.ndarray:
        """Log frequency, by language, of what the language doesn't have."""
        return np.log(0.1 / np.maximum(self._of(key)[1], 1))

    def held(self, key: str, most: int) -> Column:
        """Whether a word or n-gram is one of the most frequent, of `most` numbers in all."""
        return _frequent(self._of(key)[0], most // max(1, len(self.langs)))

    def frequent(self, key: str, held: Column) -> tuple[list[str], np.ndarray]:
        """Words or n-grams that are held, and their log frequencies."""
        found = self._of(key)[0].filter(held).select(key, "counts").toArrow()
        parts = [c.flatten().to_numpy() for c in found["counts"].chunks]
        counts = np.concatenate([np.empty(0), *parts]).reshape(-1, len(self.langs))
        return found[key].to_pylist(), np.log(np.where(counts > 0, counts, 0.1) / np.maximum(self._of(key)[1], 1))


def _summed(counted: DataFrame, key: str, langs: int) -> DataFrame:
    sums = counted.groupBy(key).agg(*(F.sum(F.col("counts")[j]).alias(f"n_{j}") for j in range(langs)))
    each = [F.col(f"n_{j}") for j in range(langs)]
    return materialize(sums.select(key, F.array(*each).alias("counts"), sum(each, F.lit(0)).cast("long").alias("n")))


def count_languages(training: DataFrame, lang_col: str = "lang", text_col: str = "text", longest: int = 4) -> LanguageCounts:
    """Count the words and n-grams of all training rows."""
    rows = training.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).dropna()
    langs = sorted(r["lang"] for r in rows.select("lang").distinct().collect())
    by_lang = F.array(*(F.when(F.col("lang") == g, F.col("n")).otherwise(0) for g in langs))
    counted = rows.mapInArrow(_count_words, "lang string, word string, n long")
    if not langs:
        none = np.empty(0)
        return LanguageCounts([], counted, counted, none, none)
    words = _summed(counted.select("word", by_lang.alias("counts")), "word", len(langs))
    grams = _summed(words.select("word", "counts").mapInArrow(_count_grams(len(langs), longest), "gram string, counts array<long>"),
                    "gram", len(langs))
    totals = [np.array(c.agg(*(F.coalesce(F.sum(F.col("counts")[j]), F.lit(0)) for j in range(len(langs)))).first(), float)
              for c in (words, grams)]
    return LanguageCounts(langs, words, grams, *totals)


def fit_languages(training: DataFrame, lang_col: str = "lang", text_col: str = "text", longest: int = 4,
                  max_words: int = 2_000_000, max_grams: int = 1_000_000) -> LanguageModel:
    """A model in memory, of the most frequent words and n-grams: `max_words` and `max_grams`, each divided by the number
    of languages."""
    counts = count_languages(training, lang_col, text_col, longest)
    if not counts.langs:
        return LanguageModel([], [], np.empty((0, 0)), [], np.empty((0, 0)), longest)
    found = (counts.frequent(key, counts.held(key, most)) for key, most in (("word", max_words), ("gram", max_grams)))
    return LanguageModel(counts.langs, *(part for pair in found for part in pair), longest)


def _excess(counts: LanguageCounts, key: str) -> Column:
    """Log frequency, by language, less that of what the language doesn't have. Zero for most, so it shuffles well."""
    total, base = counts._of(key)[1], counts.base(key)
    one = [F.when(F.col("counts")[j] > 0, F.log(F.col("counts")[j] / float(max(total[j], 1))) - float(base[j])).otherwise(0.0)
           for j in range(len(base))]
    return F.array(*one)


def _spelt_excess(words: DataFrame, counts: LanguageCounts, longest: int) -> DataFrame:
    """Mean over the places of each word, of column `word`, of the longest known n-gram there, less the base of words. A
    word without one has log frequency 0."""
    marked = F.concat(F.lit("^"), F.col("word"), F.lit("$"))
    at = F.sequence(F.lit(1), F.length(marked))

    def of(k: int) -> Column:
        return F.transform(at, lambda i: F.struct(i.alias("at"), F.lit(k).alias("k"), F.substring(marked, i, F.lit(k)).alias("gram")))

    cuts = map(of, range(1, longest + 1))
    places = words.select("word", F.explode(F.concat(*cuts)).alias("c")).select("word", "c.*").filter(F.length("gram") == F.col("k"))
    known = counts.grams.select("gram", _excess(counts, "gram").alias("values"))
    best = places.join(known, "gram").groupBy("word", "at").agg(F.max_by("values", "k").alias("values"))
    bases = list(zip(counts.base("gram"), counts.base("word"), strict=True))
    found = best.groupBy("word").agg(
        F.array(*(F.avg(F.col("values")[j]) + float(of_gram - of_word) for j, (of_gram, of_word) in enumerate(bases))).alias("values"))
    nothing = F.array(*(F.lit(float(-of_word)) for _, of_word in bases))
    return words.join(found, "word", "left").select("word", F.coalesce("values", nothing).alias("values"))


def _spell(model):
    """Fill in the values of words that training hasn't seen."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = received(model)
        for batch in batches:
            code, vocabulary = pd.factorize(batch.column("word").to_numpy(zero_copy_only=False))
            values = held.spelt(list(vocabulary)) - held.base
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("n"), _lists(values[code])], ["row", "n", "values"])

    return task


def _slices(batch: pa.RecordBatch, most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about `most` bytes of text, or one longer text, so that a task holds the words of few texts."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    edges = np.flatnonzero(np.diff(np.cumsum(sizes, dtype=np.int64) // most, prepend=-1))
    for begin, end in zip(edges, [*edges, len(sizes)][1:], strict=True):
        yield batch.slice(begin, end - begin)


def _sum_known(model):
    """A row for every text, without a word, with the sums over its words, and one for each word whose value isn't known
    here, which counts with the base in the sums."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = received(model)
        for batch in (part for whole in batches for part in _slices(whole)):
            texts = [[w for w in words_of(t) if any(map(str.isalpha, w))] for t in batch.column("text").to_pylist()]
            code, vocabulary = pd.factorize(np.array([w for words in texts for w in words], object))
            owner = np.repeat(np.arange(len(texts)), [len(words) for words in texts])
            values, final = held.find(list(vocabulary))
            sums = np.stack([np.bincount(owner, values[code, j], minlength=len(texts)) for j in range(len(held.base))], axis=1)
            row = batch.column("row")
            yield pa.RecordBatch.from_arrays(
                [row, batch.column("doc_id"), pa.nulls(len(texts), pa.string()),
                 pa.array(np.bincount(owner, minlength=len(texts)).astype(np.int64)), _lists(sums)],
                ["row", "doc_id", "word", "n", "sums"])
            far = ~final[code]
            keys, times = np.unique(owner[far] * max(1, len(vocabulary)) + code[far], return_counts=True)
            owners, codes = np.divmod(keys, max(1, len(vocabulary)))
            yield pa.RecordBatch.from_arrays(
                [row.take(pa.array(owners)), pa.nulls(len(keys), pa.int64()), pa.array(vocabulary[codes], pa.string()),
                 pa.array(times.astype(np.int64)), pa.nulls(len(keys), pa.list_(pa.float64()))],
                ["row", "doc_id", "word", "n", "sums"])

    return task


def identify_languages(docs: DataFrame, training: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       lang_col: str = "lang", longest: int = 4, max_words: int = 2_000_000, max_grams: int = 1_000_000,
                       filter_bits: int = 1 << 26) -> DataFrame:
    """Language of every text, learnt from the texts and languages of `training`.

    Returns one row per input row: doc_id, lang_pred and score, the share of the likelihood that the language has. A
    text that is null or has no letter is `und` with score 0, and so is every text if nothing can be learnt. Training
    rows with a null text or language are left out. Ties go to the first language by name. Repeated rows and null ids
    are treated like others; other columns are ignored; no rows give no rows.

    All words and n-grams of the training texts are used. `max_words` and `max_grams`, each divided by the number of
    languages, are how many of them, the most frequent, the tasks hold, with a filter of `filter_bits` (a power of 2,
    2^15 at least) for known words that they don't hold. These decide where a word is looked up, not its value. Held words and n-grams
    are told apart by 64-bit hashes.
    """
    counts = count_languages(training, lang_col, text_col, longest)
    langs = counts.langs
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).alias("text"))
    if not langs:
        return rows.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    held_word, held_gram = counts.held("word", max_words), counts.held("gram", max_grams)
    outside = counts.words.filter(~held_word)
    whole = counts.grams.filter(~held_gram).isEmpty()
    held = LanguageModel(langs, *counts.frequent("word", held_word), *counts.frequent("gram", held_gram), longest).held(
        slot_filter(outside.select(F.xxhash64("word").bitwiseAND(filter_bits - 1).alias("slot")), filter_bits), whole,
        counts.base("word"))
    model = send(docs.sparkSession, held)
    found = materialize(rows.mapInArrow(_sum_known(model), "row long, doc_id long, word string, n long, sums array<double>"))

    other = found.filter("word is not null").select("row", "word", "n")
    looked = other.join(outside.select("word", _excess(counts, "word").alias("values")), "word", "left")
    unseen = F.col("values").isNull()
    if whole:
        spelt = looked.filter(unseen).mapInArrow(_spell(model), "row long, n long, values array<double>")
    else:
        looked = materialize(looked)
        words = _spelt_excess(looked.filter(unseen).select("word").distinct(), counts, longest)
        spelt = looked.filter(unseen).drop("values").join(words, "word").select("row", "n", "values")
    valued = looked.filter(~unseen).select("row", "n", "values").unionByName(spelt)
    more = valued.groupBy("row").agg(*(F.sum(F.col("n") * F.col("values")[j]).alias(f"more_{j}") for j in range(len(langs))))
    total = F.array(*(F.col("sums")[j] + F.coalesce(F.col(f"more_{j}"), F.lit(0.0)) for j in range(len(langs))))
    scored = found.filter("word is null").join(more, "row", "left").withColumn("total", total)
    best = F.array_max("total")
    name = F.element_at(F.array(*map(F.lit, langs)), F.array_position("total", best).cast("int"))
    share = 1 / F.aggregate("total", F.lit(0.0), lambda s, x: s + F.exp(x - best))
    return scored.select("doc_id", F.when(F.col("n") > 0, name).otherwise(F.lit(UNKNOWN)).alias("lang_pred"),
                         F.when(F.col("n") > 0, share).otherwise(0.0).alias("score"))
