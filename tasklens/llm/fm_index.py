"""Benchmark decontamination with one FM-index per shard of training text.

A shard is a run of whole documents inside one task. Its words are coded by a vocabulary of its own, every document ends
with a separator of its own, and the Burrows-Wheeler transform of the whole is kept in a wavelet matrix. All test
windows are searched backwards together; occurrences are located by walking to the nearest sampled suffix position.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasklens.llm.hashing import word_hashes
from tasklens.llm.staging import received, send

# Lower-case A-Z; keep a-z, 0-9 and every byte above 127; the rest separates words.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_WORD_BYTES).split() if text else []


class BitVector:
    """Bits with counts of ones before any place."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.blocks = np.zeros(len(bits) // 64 + 1, np.uint64)
        self.blocks.view(np.uint8)[: len(packed)] = packed
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.blocks), dtype=np.int64)])

    def ones(self, place: np.ndarray) -> np.ndarray:
        block, rest = place >> 6, (place & 63).astype(np.uint64)
        low = self.blocks[block] & ((np.uint64(1) << rest) - np.uint64(1))
        return self.before[block] + np.bitwise_count(low)

    def get(self, place: np.ndarray) -> np.ndarray:
        return (self.blocks[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) == 1


class WaveletMatrix:
    def __init__(self, symbols: np.ndarray, largest: int):
        self.levels = []
        for bit in range(max(1, int(largest).bit_length()) - 1, -1, -1):
            ones = (symbols & np.int32(1 << bit)) != 0
            vector = BitVector(ones)
            zeros = len(symbols) - int(vector.before[-1])
            self.levels.append((bit, vector, zeros))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often the symbol stands before the place."""
        first = np.zeros_like(place)
        for bit, vector, zeros in self.levels:
            one = (symbol >> bit) & 1 == 1
            first, place = (self._step(vector, zeros, one, x) for x in (first, place))
        return place - first

    def symbol_and_rank(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at the place, and how often it stands before."""
        first, symbol = np.zeros_like(place), np.zeros_like(place)
        for bit, vector, zeros in self.levels:
            one = vector.get(place)
            symbol |= one.astype(np.int64) << bit
            first, place = (self._step(vector, zeros, one, x) for x in (first, place))
        return symbol, place - first

    @staticmethod
    def _step(vector: BitVector, zeros: int, one: np.ndarray, place: np.ndarray) -> np.ndarray:
        ones = vector.ones(place)
        return np.where(one, zeros + ones, place - ones)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes by prefix doubling. Every document in the text must end with a symbol of its own."""
    n, top = len(text), int(text.max()) + 2
    after = np.concatenate([text[1:] + 1, [0]])
    key, known = text * top + after, 2
    if top ** 3 < 2 ** 63:
        key, known = key * top + np.concatenate([after[1:], [0]]), 3
    order = np.argsort(key)
    sorted_key = key[order]
    head = np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    open_slots = np.flatnonzero(~(head & np.concatenate([head[1:], [True]])))
    while len(open_slots):
        suffix = order[open_slots]
        key = rank[suffix] * n + rank[suffix + known]
        turn = np.argsort(key)
        suffix, key = suffix[turn], key[turn]
        order[open_slots] = suffix
        head = np.concatenate([[True], key[1:] != key[:-1]])
        rank[suffix] = np.maximum.accumulate(np.where(head, open_slots, 0))
        open_slots = open_slots[~(head & np.concatenate([head[1:], [True]]))]
        known *= 2
    return order


class FMIndex:
    """Backward search over the documents of a shard, each given as the hashes of its words."""

    def __init__(self, docs: list[np.ndarray], sample: int = 8):
        lengths = np.array([len(d) for d in docs])
        self.starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]]).astype(np.int64)
        ends = self.starts + lengths
        codes, self.vocabulary = pd.factorize(np.concatenate(docs))
        self.size = int(lengths.sum()) + len(docs)
        text = np.empty(self.size, np.int64)
        is_word = np.ones(self.size, bool)
        is_word[ends] = False
        text[ends] = np.arange(len(docs))
        text[is_word] = codes + len(docs)
        order = suffix_array(text)
        symbols = np.where(is_word, text - len(docs) + 1, 0)  # for the index, all separators are symbol 0
        self.before = np.cumsum(np.bincount(symbols, minlength=len(self.vocabulary) + 1))
        self.before = np.concatenate([[0], self.before])  # symbols smaller than the symbol
        self.wavelet = WaveletMatrix(symbols.astype(np.int32)[order - 1], len(self.vocabulary))
        sampled = np.zeros(self.size, bool)
        sampled[::sample] = True
        sampled[self.starts] = True  # so a walk never crosses a separator
        self.sampled = BitVector(sampled[order])
        self.positions = order[sampled[order]]

    def codes(self, words: np.ndarray) -> np.ndarray:
        """Symbols of word hashes; 0 for words that the shard hasn't."""
        return pd.Index(self.vocabulary).get_indexer(words) + 1

    def count(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of phrases, given as rows of symbols, each filled up to the left with -1."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.size, np.int64)
        width = phrases.shape[1]
        high[((phrases == 0).any(axis=1)) | (lengths == 0)] = 0
        for column in range(width - 1, -1, -1):
            live = np.flatnonzero((low < high) & (lengths >= width - column))
            if not len(live):
                continue
            symbol = phrases[live, column]
            both = self.wavelet.rank(np.concatenate([symbol, symbol]), np.concatenate([low[live], high[live]]))
            low[live], high[live] = np.split(np.tile(self.before[symbol], 2) + both, 2)
        return low, np.maximum(low, high)

    def locate(self, slots: np.ndarray) -> np.ndarray:
        """Text positions of suffixes."""
        result, walking, steps = np.empty(len(slots), np.int64), np.arange(len(slots)), 0
        slots = slots.copy()
        while len(walking):
            found = self.sampled.get(slots)
            result[walking[found]] = self.positions[self.sampled.ones(slots[found])] + steps
            walking, slots = walking[~found], slots[~found]
            symbol, rank = self.wavelet.symbol_and_rank(slots)
            slots = self.before[symbol] + rank
            steps += 1
        return result


class Windows:
    """Distinct windows of test items, and the items of each."""

    def __init__(self, items: list[tuple[str, bytes | None]], length: int):
        number: dict[tuple, int] = {}
        pairs: set[tuple[int, int]] = set()
        self.names: list[str] = []
        for name, text in items:
            coded = word_hashes(words_of(text)).tolist()
            if not coded:
                continue
            self.names.append(name)
            for i in range(max(1, len(coded) - length + 1)):
                window = tuple(coded[i: i + length])
                pairs.add((number.setdefault(window, len(number)), len(self.names) - 1))
        self.lengths = np.array([len(w) for w in number], np.int64)
        flat = np.array([h for w in number for h in w], np.uint64)
        self.words, self.word_of = np.unique(flat, return_inverse=True)
        self.rows = np.full((len(number), length), -1, np.int64)
        column = np.arange(length)
        self.rows[column >= length - self.lengths[:, None]] = self.word_of
        pairs_of = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        self.items_from = np.searchsorted(pairs_of[:, 0], np.arange(len(number) + 1))
        self.items = pairs_of[:, 1]

    def search(self, docs: list[np.ndarray], sample: int) -> tuple[list[list[list[int]]], list[list[str]]]:
        """Per document: merged ranges of words inside an occurrence, and sorted names of the items found."""
        spans, names = [[] for _ in docs], [[] for _ in docs]
        if not len(self.lengths) or not sum(map(len, docs)):
            return spans, names
        index = FMIndex(docs, sample)
        symbol = np.append(index.codes(self.words), -1)  # the last stands for no word
        low, high = index.count(symbol[self.rows], self.lengths)
        found = np.flatnonzero(low < high)
        if not len(found):
            return spans, names
        times = (high - low)[found]
        window = np.repeat(found, times)
        slots = np.repeat(low[found], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        place = index.locate(slots)
        edges = np.zeros(index.size + 1, np.int64)
        np.add.at(edges, place, 1)
        np.add.at(edges, place + self.lengths[window], -1)
        turns = np.flatnonzero(np.diff(np.concatenate([[0], (np.cumsum(edges[:-1]) > 0).view(np.int8), [0]])))
        for first, last in zip(turns[::2], turns[1::2], strict=True):
            doc = int(np.searchsorted(index.starts, first, "right")) - 1
            spans[doc].append([int(first - index.starts[doc]), int(last - index.starts[doc])])
        doc = np.searchsorted(index.starts, place, "right") - 1
        hits = np.unique(np.stack([doc, window], axis=1), axis=0)
        for d, w in hits.tolist():
            names[d].extend(self.names[i] for i in self.items[self.items_from[w]: self.items_from[w + 1]])
        return spans, [sorted(set(n)) for n in names]


def _merge(spans: list[list[int]]) -> list[list[int]]:
    merged: list[list[int]] = []
    for first, last in sorted(spans):
        if merged and first <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], last)
        else:
            merged.append([first, last])
    return merged


_COLUMNS = "doc_id long, text string, n_words long, items array<string>, spans array<struct<start:int,end:int>>"


def _search(windows, shard_words: int, sample: int, keep_text: bool):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = received(windows)
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

        def flush(rows):
            spans, names = search.search([r[2] for r in rows], sample)
            out = [(i, t if keep_text else None, len(h), sorted({*old_items, *n}),
                    [{"start": a, "end": b} for a, b in _merge(s + old)])
                   for (i, t, h, old_items, old), s, n in zip(rows, spans, names, strict=True)]
            ids, texts, counts, items, ranges = zip(*out, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64()),
                 pa.array(items, pa.list_(pa.string())), pa.array(ranges, span)],
                ["doc_id", "text", "n_words", "items", "spans"])

        rows, size = [], 0
        for batch in batches:
            columns = [batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(),
                       batch.column("items").to_pylist(), batch.column("spans").to_pylist()]
            for doc_id, text, items, spans in zip(*columns, strict=True):
                words = words_of(text)
                rows.append((doc_id, text, word_hashes(words), items, [[s["start"], s["end"]] for s in spans]))
                size += len(words)
                if size >= shard_words:
                    yield flush(rows)
                    rows, size = [], 0
        if rows:
            yield flush(rows)

    return task


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple[str, bytes]]]:
    """Test items in blocks of bounded size; only one block is on the driver at a time."""
    block, size = [], 0
    for name, text in items.toLocalIterator():
        text = text.encode()
        if block and size + len(text) > block_bytes:
            yield block
            block, size = [], 0
        block.append((name, text))
        size += len(text)
    if block:
        yield block


def find_contamination(docs: DataFrame, items: DataFrame, length: int = 10, id_col: str = "doc_id",
                       text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
                       shard_words: int = 1_000_000, sample: int = 8, block_bytes: int = 4_000_000) -> DataFrame:
    """Words of documents that lie inside a window of a test item.

    A window is `length` consecutive words of an item; an item of fewer words, but not none, is one window. Words are
    runs of letters, digits and non-ASCII characters, with A-Z lower-cased. Returns one row per input row: doc_id,
    n_words, items (ids of the items found, sorted as strings) and spans (word ranges to remove, merged, end exclusive).

    A null or empty text has no words and no hits. Items with a null id or null text are left out; items that share an
    id count once. Repeated rows and null ids are returned as they come; other columns are ignored; without documents
    there are no rows, without items no hits. Shards hold whole documents, at least one, of about `shard_words` words.
    Test items go to the tasks in blocks of at most `block_bytes` of text, one pass over the documents each.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
        F.array().cast("array<string>").alias("items"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    tests = items.select(F.col(item_id_col).cast("string").alias("name"), F.col(item_text_col).alias("t")).dropna()
    blocks = [send(spark, Windows(block, length)) for block in _blocks(tests, block_bytes)]
    blocks = blocks or [send(spark, Windows([], length))]
    for block in blocks:
        rows = rows.select("doc_id", "text", "items", "spans").mapInArrow(
            _search(block, shard_words, sample, block is not blocks[-1]), _COLUMNS)
    return rows.select("doc_id", "n_words", "items", "spans")


_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"


def cut_words(text: Column, spans: Column) -> Column:
    """The text without the words in the spans and without what stands before each of them; empty if no word is left."""
    pieces = F.regexp_extract_all(text, F.lit(_GAP + "*+" + _WORD), F.lit(0))
    kept = F.filter(pieces, lambda piece, i: ~F.exists(spans, lambda s: (s["start"] <= i) & (i < s["end"])))
    tail = F.regexp_extract(text, _GAP + "*$", 0)
    return F.when(F.size(kept) == 0, F.lit("")).otherwise(F.concat(F.array_join(kept, ""), tail))
