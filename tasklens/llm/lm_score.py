"""Cross-entropy difference of two matched bigram models with one vocabulary.

The target model is counted over the documents marked as target, the background model over all others. Both know the
same words, interpolate pairs with single words by the same weight, and differ only in their counts.

Counts of all words and pairs stay in Spark. Texts are dealt out to batches. A batch sends each of its keys once to the
shard that holds the key's range, and the shard answers with the counts alone, in the order of the keys.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasklens.llm.hashing import run_hashes, word_hashes

_NONE = np.empty(0, np.uint64)


def _coded(texts: pa.Table) -> list[np.ndarray]:
    """Hashes of the words of each text."""
    return [word_hashes(t.lower().split()) if t else _NONE for t in texts["text"].cast(pa.binary()).to_pylist()]


def _pairs(words: np.ndarray) -> np.ndarray:
    return run_hashes(words, 2)


def packed(numbers: np.ndarray) -> bytes:
    """Unsigned 64-bit numbers in as many bytes each as the largest needs, lowest bytes first."""
    width = max(1, (int(numbers.max(initial=0)).bit_length() + 7) // 8)
    return numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unpacked(body: bytes, count: int) -> np.ndarray:
    out = np.zeros((count, 8), np.uint8)
    out[:, : len(body) // count] = np.frombuffer(body, np.uint8).reshape(-1, count).T
    return out.view("<u8").ravel()


_RUN = "shard int, pair boolean, size int, gaps binary, n binary, n_target binary, batch long"


def _runs(keys: list[np.ndarray], target: np.ndarray, pair: bool, shards: int) -> pa.RecordBatch:
    """Distinct keys of a batch with their counts, in all documents and in target documents: a run of ascending keys for
    each of the ranges that the shards hold. Keys that ascend are near each other, so gaps need fewer bytes."""
    distinct, n = np.unique(np.concatenate([_NONE, *(k.view(np.uint64) for k in keys)]), return_counts=True)
    inside = np.zeros(len(distinct), np.int64)
    of_target = np.concatenate([_NONE, *(k.view(np.uint64) for k, t in zip(keys, target, strict=True) if t)])
    found, times = np.unique(of_target, return_counts=True)
    inside[np.searchsorted(distinct, found)] = times
    starts = np.array([(i << 64) // shards for i in range(shards)], np.uint64)
    edges = [*np.searchsorted(distinct, starts).tolist(), len(distinct)]
    full = [(i, a, b) for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False)) if a < b]
    gaps = [np.diff(distinct[a:b], prepend=np.uint64(0)) for _, a, b in full]
    return pa.RecordBatch.from_arrays(
        [pa.array([i for i, _, _ in full], pa.int32()), pa.array([pair] * len(full), pa.bool_()),
         pa.array([b - a for _, a, b in full], pa.int32()), pa.array([g[:1].tobytes() + packed(g[1:]) for g in gaps], pa.binary()),
         pa.array([packed(n[a:b]) for _, a, b in full], pa.binary()), pa.array([packed(inside[a:b]) for _, a, b in full], pa.binary())],
        ["shard", "pair", "size", "gaps", "n", "n_target"])


def _count(shards: int):
    """Counts of the words and of the pairs of a batch. Every shard gets a run of words, if need be an empty one: it is
    asked for its sums as well."""

    def runs(key: tuple[pa.Scalar, ...], texts: pa.Table) -> pa.Table:
        words, target = _coded(texts), texts["target"].to_numpy()
        of_words, of_pairs = _runs(words, target, False, shards), _runs([_pairs(w) for w in words], target, True, shards)
        left = np.setdiff1d(np.arange(shards, dtype=np.int32), of_words["shard"].to_numpy())
        k, empty = len(left), pa.array([b""] * len(left), pa.binary())
        no_words = pa.RecordBatch.from_arrays(
            [pa.array(left), pa.array([False] * k, pa.bool_()), pa.array([0] * k, pa.int32()), empty, empty, empty], of_words.schema.names)
        found = pa.Table.from_batches([of_words, no_words, of_pairs])
        return found.append_column("batch", pa.array([key[0].as_py()] * len(found), pa.int64()))

    return runs


def _keys_of(gaps: bytes, size: int) -> np.ndarray:
    rest = unpacked(gaps[8:], size - 1) if size > 1 else np.empty(0, np.uint64)
    return np.cumsum(np.concatenate([np.frombuffer(gaps[:8], np.uint64), rest]), dtype=np.uint64)


def _merged(runs: pa.Table) -> pa.Table:
    """Counts of a shard's words, and of its pairs that were seen more than once."""
    found = []
    for pair in (False, True):
        rows = runs.filter(pa.array([p == pair for p in runs["pair"].to_pylist()], pa.bool_())).to_pylist()
        if not rows:
            continue
        keys = np.concatenate([_keys_of(r["gaps"], r["size"]) for r in rows])
        order = np.argsort(keys, kind="stable")  # of runs in order
        keys = keys[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        n, inside = (np.add.reduceat(np.concatenate([unpacked(r[c], r["size"]) for r in rows])[order].astype(np.int64), first)
                     for c in ("n", "n_target"))
        kept = (n > 1) | (not pair)
        found.append([np.full(int(kept.sum()), pair), keys[first][kept].view(np.int64), n[kept], inside[kept]])
    columns = zip(*found, strict=True) if found else [[np.empty(0, kind)] for kind in (bool, np.int64, np.int64, np.int64)]
    return pa.Table.from_arrays([pa.array(np.concatenate(c)) for c in columns], ["pair", "key", "n", "n_target"])


_ANSWER = "batch long, shard int, pair boolean, size int, n binary, n_target binary, distinct long, said long, said_target long"


def _answered(runs: pa.Table) -> pa.Table:
    """For each run of a shard the counts of its keys, in their order, 0 for a pair seen once; and the number of the shard's
    distinct words, of their occurrences and of those in target documents."""
    counts = _merged(runs.filter(pc.greater(runs["size"], 0)))
    known = {}
    for pair in (False, True):
        part = counts.filter(pc.equal(counts["pair"], pair))
        # One more key, of no count, is greater than any that is asked for.
        known[pair] = [np.append(part[c].to_numpy(), rest) for c, rest in (("key", -1), ("n", 0), ("n_target", 0))]
    words = counts.filter(pc.invert(counts["pair"]))
    sums = len(words), *(pc.coalesce(pc.sum(words[c]), 0).as_py() for c in ("n", "n_target"))
    found = []
    for run in runs.select(["pair", "size", "gaps"]).to_pylist():
        asked, (keys, *each) = _keys_of(run["gaps"], run["size"]) if run["size"] else _NONE, known[run["pair"]]
        at = np.searchsorted(keys.view(np.uint64), asked)
        found.append([packed(np.where(keys[at].view(np.uint64) == asked, n[at], 0)) for n in each])
    return pa.Table.from_arrays(
        [*(runs[c] for c in ("batch", "shard", "pair", "size")), *(pa.array(list(n), pa.binary()) for n in zip(*found, strict=True)),
         *(pa.array(np.full(len(found), s, np.int64)) for s in sums)], [c.split()[0] for c in _ANSWER.split(", ")])


@dataclass(frozen=True)
class PairModel:
    """Counts of a batch's distinct words and pairs, in the order of their hashes, in the target and in the background model,
    and what is said of all words."""

    words: np.ndarray
    pairs: np.ndarray
    distinct: int  # words, one more for those never seen
    total: np.ndarray  # of the words of each model
    weight: float

    @classmethod
    def of(cls, words: int, pairs: int, answers: pa.Table, weight: float) -> PairModel:
        """The answers of all shards to a batch with so many distinct words and pairs."""
        rows = sorted(answers.to_pylist(), key=lambda r: r["shard"])
        counts = []
        for pair, size in ((False, words), (True, pairs)):
            runs = [r for r in rows if r["pair"] == pair and r["size"]]
            n, inside = (np.concatenate([_NONE, *(unpacked(r[c], r["size"]) for r in runs)]).astype(np.int64) for c in ("n", "n_target"))
            if len(n) != size:
                raise ValueError("the texts of a batch aren't those that were counted: the input changes from read to read")
            counts.append(np.stack([inside, n - inside]))
        known, said, inside = (sum(r[c] for r in rows if not r["pair"]) for c in ("distinct", "said", "said_target"))
        return cls(*counts, known + 1, np.array([[inside], [said - inside]], float), weight)

    def losses(self, words: np.ndarray, pairs: np.ndarray, target: bool) -> np.ndarray:
        """Sum of the losses of a text's words under each model, in nats. Words and pairs are given by their places among
        the distinct ones. The text's own counts are taken out of the model that it was counted for, so no text is judged
        by itself."""
        if not len(words):
            return np.zeros(2)
        own = np.array([[1], [0]] if target else [[0], [1]])
        distinct, code, times = np.unique(words, return_inverse=True, return_counts=True)
        singles = (self.words[:, distinct] - own * times).astype(float)[:, code]
        chance = (singles + 0.5) / (self.total - own * len(words) + 0.5 * self.distinct)
        first = singles[:, :-1]
        chance[:, 1:] *= np.where(first > 0, 1 - self.weight, 1)
        loss = -np.log(chance).sum(axis=1)
        # A known pair adds weight * pair / first to the chance of its second word.
        factor = np.where(first > 0, self.weight / np.maximum(first, 1) / chance[:, 1:], 0)
        distinct, code, times = np.unique(pairs, return_inverse=True, return_counts=True)
        others = np.maximum(self.pairs[:, distinct] - own * times, 0)  # a pair seen once is in this text alone
        return loss - np.log1p(factor * others[:, code]).sum(axis=1)


def _places(keys: list[np.ndarray]) -> tuple[int, list[np.ndarray]]:
    """How many distinct keys the texts have, and for each text the places of its keys among them, in order."""
    distinct, place = np.unique(np.concatenate([_NONE, *keys]), return_inverse=True)
    return len(distinct), np.split(place, np.cumsum([len(k) for k in keys])[:-1])


_SCORE = "doc_id long, n_tokens long, target_loss double, background_loss double, score double"


def _score(weight: float):
    """A row for every text of a batch, from the answers that the batch got."""

    def scores(texts: pa.Table, answers: pa.Table) -> pa.Table:
        keys = _coded(texts)
        n = np.array([len(k) for k in keys], np.int64)
        (n_words, words), (n_pairs, pairs) = _places(keys), _places([_pairs(k) for k in keys])
        model = PairModel.of(n_words, n_pairs, answers, weight)
        loss = np.array([model.losses(*text) for text in zip(words, pairs, texts["target"].to_pylist(), strict=True)])
        target, background = (loss / np.maximum(n, 1)[:, None]).T
        return pa.Table.from_arrays(
            [texts["doc_id"], *map(pa.array, (n, target, background, background - target))], [c.split()[0] for c in _SCORE.split(", ")])

    return scores


def cross_entropy_difference(docs: DataFrame, target_col: str, id_col: str = "doc_id", text_col: str = "text",
                             max_words: int = 2_000_000, max_pairs: int = 2_000_000, weight: float = 0.7,
                             filter_bits: int = 1 << 27, shard_bytes: int = 8 << 20) -> DataFrame:
    """Loss of every text under the target and the background model, and their difference.

    Returns one row per input row: doc_id, n_tokens, target_loss, background_loss (nats a word) and score, the second
    less the first: higher is more like the target. Each text is left out of the counts it is judged by. Words are runs of
    anything but ASCII whitespace, with A-Z lower-cased. A null, empty or wordless text has no words and losses and score 0. A null mark is no target. Without
    target documents the target model is even over the vocabulary, and so is the background model without others.
    Repeated rows count each time; null ids are scored like others; other columns are ignored; no rows give no rows.

    All words and pairs are counted and used; they are told apart by 64-bit hashes. `weight`, of the pairs, is below 1. Counts
    are added up in shards, ranges of hashes, one for every `shard_bytes` of text. Texts are dealt out, by a hash of the row
    and of the partition it is read in, to as many batches, or as many as shuffles have partitions if these are more. A batch
    sends a shard each key once, and gets back counts in the order of the keys, so keys travel one way. Texts are shuffled
    once, for counting and scoring. No task holds a model of the corpus: `max_words`, `max_pairs` and `filter_bits`, which set
    what tasks held, are taken for the sake of callers and change nothing.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.coalesce(F.col(target_col), F.lit(False)).alias("target"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = 1 + size // shard_bytes
    batches = max(shards, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    row = F.xxhash64("doc_id", "text", "target", F.spark_partition_id())
    dealt = rows.withColumn("batch", F.pmod(row, F.lit(batches).cast("long")))
    runs = dealt.groupBy("batch").applyInArrow(_count(shards), _RUN)
    answers = runs.groupBy("shard").applyInArrow(_answered, _ANSWER)
    return dealt.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(_score(weight), _SCORE)
