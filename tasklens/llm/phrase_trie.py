"""Collocations: phrases counted in burst tries over word numbers, merged by prefix, and scored by their weakest cut.

A task counts the phrases that start at each of its words in a HAT-trie: inner nodes go from one word number to the next,
leaves are hash containers that burst into nodes when they grow. A trie over its budget gives up whole subtrees as
sorted runs, dealt by the first words of a phrase; the runs of one prefix are merged in one place and counted there.

Only phrases that occur often matter, and every part of such a phrase occurs as often. So words are counted first, then
pairs of frequent words, then longer phrases all of whose pairs are frequent.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tasklens.llm.hashing import MULTIPLIER, mix
from tasklens.llm.staging import materialize

LONGEST = 5
# What ends a piece. In a byte that UTF-8 never uses, it's a word of its own.
_STOP = b"\xff"
_TO_STOP = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", _STOP * 10)
_HASHED = 1 << 63


def tokens(text: bytes) -> list[bytes]:
    """Words in order, with a stop between pieces. Only A-Z are lower-cased."""
    return text.lower().translate(_TO_STOP).replace(_STOP, b" \xff ").split()


def word_hash(lang: str, word: bytes) -> int:
    """Number of a word that is in no dictionary."""
    return xxhash.xxh3_64_intdigest(lang.encode() + b"\0" + word) | _HASHED


def count_words(docs: DataFrame, budget: int) -> DataFrame:
    """Occurrences of every word of (lang, text): lang, word, n. The row of a lang without a word has the sum."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_lang: dict[str, Counter] = {}
        held = 0

        def rows() -> Iterator[pa.RecordBatch]:
            for lang, counter in by_lang.items():
                total = sum(counter.values())
                yield pa.record_batch({
                    "lang": pa.array([lang] * (len(counter) + 1), pa.string()),
                    "word": pa.array([*counter, None], pa.binary()),
                    "n": pa.array([*counter.values(), total], pa.int64())})
            by_lang.clear()

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                counter = by_lang.setdefault(lang, Counter())
                held -= len(counter)
                counter.update(tokens(text))
                counter.pop(_STOP, None)
                held += len(counter)
                if held > budget:
                    yield from rows()
                    held = 0
        yield from rows()

    found = docs.mapInArrow(counted, "lang string, word binary, n long")
    return found.groupBy("lang", "word").agg(F.sum("n").alias("n"))


class HatTrie:
    """Counts of phrases, each given as the bytes of its word numbers, most significant byte first.

    `root` and the nodes below it are dictionaries from one word number to a child; a child is another node or a
    container, a dictionary from the rest of the phrase to its count. A container of over `burst` phrases becomes a node.
    """

    def __init__(self, width: int, burst: int = 8192):
        self.width, self.burst, self.root, self.size = width, burst, {}, 0

    class Container(dict):
        """Leaf."""

    def add(self, keys: list[bytes], times: list[int]) -> None:
        width, root, burst, leaf = self.width, self.root, self.burst, self.Container
        for key, n in zip(keys, times, strict=True):
            node, at = root, width
            child = node.get(key[:width])
            while type(child) is dict:
                node, at = child, at + width
                child = node.get(key[at - width: at])
            if child is None:
                child = node[key[at - width: at]] = leaf()
            rest = key[at:]
            before = child.get(rest)
            if before is None:
                child[rest] = n
                self.size += 1
                if len(child) > burst:
                    self._burst(node, key[at - width: at])
            else:
                child[rest] = before + n

    def _burst(self, node: dict, name: bytes) -> None:
        old, width = node[name], self.width
        if not any(old):  # nothing left to tell them apart by
            return
        node[name] = new = {}
        for rest, n in old.items():
            new.setdefault(rest[:width], self.Container())[rest[width:]] = n

    @classmethod
    def _count(cls, child: dict) -> int:
        return len(child) if type(child) is cls.Container else sum(map(cls._count, child.values()))

    @classmethod
    def _walk(cls, child: dict, prefix: bytes) -> Iterator[tuple[bytes, int]]:
        if type(child) is cls.Container:
            for rest in sorted(child):
                yield prefix + rest, child[rest]
        else:
            for name in sorted(child):
                yield from cls._walk(child[name], prefix + name)

    def spill(self, keep: int = 0) -> Iterator[tuple[bytes, int]]:
        """Take out whole subtrees, the largest first, until at most `keep` phrases are left; sorted by phrase."""
        sizes = {name: self._count(child) for name, child in self.root.items()}
        gone = []
        for name in sorted(sizes, key=sizes.get, reverse=True):
            if self.size <= keep:
                break
            gone.append(name)
            self.size -= sizes[name]
        for name in sorted(gone):
            yield from self._walk(self.root.pop(name), name)


def numbers(words: list[bytes], lang: str, known: dict[bytes, int], hashed: bool) -> np.ndarray:
    """Word numbers; 0 for stops, and for words outside the dictionary unless those are hashed."""
    ids = np.fromiter(map(known.get, words, repeat(0)), np.uint64, len(words))
    if hashed:
        for i in np.flatnonzero(ids == 0).tolist():
            if words[i] != _STOP:
                ids[i] = word_hash(lang, words[i])
    return ids


def _hash(columns: list[np.ndarray]) -> np.ndarray:
    total = np.zeros(len(columns[0]), np.uint64)
    for column in columns:
        total = total * MULTIPLIER + mix(column.astype(np.uint64))
    return mix(total)


def _slots(first: np.ndarray, second: np.ndarray, bits: int) -> np.ndarray:
    return _hash([first, second]) % np.uint64(bits)


def phrases_from(ids: np.ndarray, shortest: int, longest: int, frequent: np.ndarray | None) -> np.ndarray:
    """One row for each place where a phrase of `shortest` words starts: its word numbers up to `longest`, the piece's
    end, or a pair that isn't in the filter; 0 after that."""
    n = len(ids) - 1
    if n < 1:
        return np.zeros((0, longest), np.uint64)
    joined = (ids[:-1] != 0) & (ids[1:] != 0)
    if frequent is not None:
        at = np.flatnonzero(joined)
        slot = _slots(ids[at], ids[at + 1], len(frequent) * 8)
        joined[at] = (frequent[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1
    goes_on, out = ids[:-1] != 0, np.zeros((n, longest), np.uint64)
    out[:, 0], starts = ids[:-1], goes_on
    for k in range(1, longest):
        goes_on, left = goes_on.copy(), max(0, n - k + 1)
        goes_on[:left] &= joined[k - 1:]
        goes_on[left:] = False
        here = np.flatnonzero(goes_on)
        out[here, k] = ids[here + k]
        if k == shortest - 1:
            starts = goes_on
    return out[starts]


def _rows_as_keys(rows: np.ndarray, width: int) -> np.ndarray:
    """Each row as one byte string that sorts like the row."""
    return np.ascontiguousarray(rows.astype(f">u{width}")).view(f"S{width * rows.shape[1]}").ravel()


def _sorted_counts(rows: np.ndarray, times: np.ndarray | None, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows in order, with the sum of their times (1 each without)."""
    if rows.shape[1] == 2 and width == 4:
        key = (rows[:, 0] << np.uint64(32)) | rows[:, 1]
        order = np.argsort(key, kind="stable")
    else:
        order = np.argsort(_rows_as_keys(rows, width), kind="stable")
    rows = rows[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]).any(axis=1)
    starts = np.flatnonzero(new)
    if times is None:
        return rows[starts], np.diff(np.append(starts, len(rows)))
    return rows[starts], np.add.reduceat(times[order], starts) if len(starts) else times[:0]


def _packed(rows: np.ndarray, times: np.ndarray, width: int) -> bytes:
    """A run as bytes: columns by planes of bytes, compressed."""
    columns = [*rows.T.astype(f"<u{width}"), times.astype("<u8")]
    planes = (np.ascontiguousarray(c).view(np.uint8).reshape(len(c), -1).T.tobytes() for c in columns)
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def _unpacked(body: bytes, n: int, width: int, longest: int) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(body), np.uint8)
    ids = raw[: n * width * longest].reshape(longest, width, n).transpose(2, 0, 1)
    times = raw[n * width * longest:].reshape(8, n).T
    return (np.ascontiguousarray(ids).view(f"<u{width}").reshape(n, longest).astype(np.uint64),
            np.ascontiguousarray(times).view("<u8").ravel().astype(np.int64))


def _merged(runs: list[tuple[np.ndarray, np.ndarray]], shortest: int, longest: int, least: int, width: int,
            whole: Callable[[np.ndarray], np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Phrases of each length with their counts out of sorted runs. Those below `least` go where counts are whole."""
    rows, times = _sorted_counts(np.concatenate([r for r, _ in runs]), np.concatenate([t for _, t in runs]), width)
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, : shortest - 1] != rows[:-1, : shortest - 1]).any(axis=1)
    for length in range(shortest, longest + 1):
        new[1:] |= rows[1:, length - 1] != rows[:-1, length - 1]
        starts = np.flatnonzero(new)
        sums, found = np.add.reduceat(times, starts), rows[starts]
        kept = (found[:, length - 1] != 0) & ((sums >= least) | ~whole(found))
        yield found[kept, :length], sums[kept]


def count_phrases(docs: DataFrame, dictionary, hashed: bool, shortest: int, longest: int, least: int, parts: int,
                  budget: int, frequent: np.ndarray | None = None, hot: np.ndarray | None = None,
                  bits: int = 8) -> DataFrame:
    """Phrases of `shortest` to `longest` words that occur `least` times: ids, n, and the slot of their first pair.

    Runs are dealt by the first two words of a phrase; those in `hot`, by the first four, and their counts are added up
    at the end. `frequent` is a filter of pairs; its false hits cost room and change nothing.
    """
    spark, width = docs.sparkSession, 8 if hashed else 4
    words = spark.sparkContext.broadcast(dictionary)
    filtered = None if frequent is None else spark.sparkContext.broadcast(frequent)
    few = np.zeros(0, np.uint64) if hot is None else np.sort(hot)
    a_batch, a_run = 1_000_000, 250_000

    def is_hot(rows: np.ndarray) -> np.ndarray:
        return np.isin(_hash([rows[:, 0], rows[:, 1]]), few) if len(few) else np.zeros(len(rows), bool)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, known = HatTrie(width), words.value
        pairs = None if filtered is None else filtered.value
        waiting, held = [], 0

        def runs(keep: int) -> Iterator[pa.RecordBatch]:
            out = list(trie.spill(keep))
            for at in range(0, len(out), a_run):
                piece = out[at: at + a_run]
                keys = np.array([k for k, _ in piece], f"S{width * longest}")
                rows = keys.view(f">u{width}").reshape(len(piece), longest).astype(np.uint64)
                times = np.fromiter((n for _, n in piece), np.int64, len(piece))
                place = _hash([rows[:, 0], rows[:, 1]])
                if len(few):
                    deep = np.flatnonzero(is_hot(rows))
                    place[deep] = _hash(list(rows[deep, : min(4, longest)].T))
                part = (place % np.uint64(parts)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                found, starts = np.unique(part[order], return_index=True)
                groups = np.split(order, starts[1:])
                yield pa.record_batch({
                    "part": pa.array(found, pa.int64()), "n": pa.array([len(g) for g in groups], pa.int32()),
                    "body": pa.array([_packed(rows[g], times[g], width) for g in groups], pa.binary())})

        def insert() -> None:
            rows = phrases_from(np.concatenate(waiting), shortest, longest, pairs)
            if len(rows):
                rows, times = _sorted_counts(rows, None, width)
                trie.add(_rows_as_keys(rows, width).tolist(), times.tolist())

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = numbers(tokens(text), lang, known.get(lang, {}), hashed)
                waiting += [ids, np.zeros(1, np.uint64)]
                held += len(ids) + 1
                if held >= a_batch:
                    insert()
                    waiting, held = [], 0
                    if trie.size > budget:
                        yield from runs(budget // 4)
        if waiting:
            insert()
        yield from runs(0)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, gathered = None, []

        def result() -> Iterator[pa.RecordBatch]:
            for rows, sums in _merged(gathered, shortest, longest, least, width, lambda r: ~is_hot(r)):
                if len(rows):
                    ends = np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32)
                    ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.ravel().view(np.int64)))
                    slot = _slots(rows[:, 0], rows[:, 1], bits).astype(np.int64)
                    yield pa.record_batch({"ids": ids, "n": pa.array(sums, pa.int64()), "slot": pa.array(slot, pa.int64())})

        for batch in batches:
            for part, n, body in zip(*(batch.column(c).to_pylist() for c in ("part", "n", "body")), strict=True):
                if part != now and gathered:
                    yield from result()
                    gathered = []
                now = part
                gathered.append(_unpacked(body, n, width, longest))
        if gathered:
            yield from result()

    runs = docs.mapInArrow(counted, "part long, n int, body binary")
    dealt = runs.repartition(parts, "part").sortWithinPartitions("part")
    found = dealt.mapInArrow(merged, "ids array<long>, n long, slot long")
    if not len(few):
        return found
    return found.groupBy("ids", "slot").agg(F.sum("n").alias("n")).filter(F.col("n") >= least).select("ids", "n", "slot")


def slot_filter(pairs: DataFrame, bits: int) -> np.ndarray:
    """All numbers in column `slot`, from 0, as one bit each. Its size is fixed by `bits`."""
    slot = F.col("slot") + 1  # Spark's first bucket starts at 1
    found = pairs.groupBy(F.bitmap_bucket_number(slot).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("body")).collect()
    out = np.zeros(bits // 8, np.uint8)
    for row in found:
        body = np.frombuffer(row["body"], np.uint8)
        at = (row["bucket"] - 1) * len(body)
        out[at: at + len(body)] = body[: len(out) - at]
    return out


def vocabulary(words: DataFrame, max_words: int) -> tuple[dict[str, dict[bytes, int]], DataFrame, bool]:
    """Numbers for frequent words of (lang, word, n): a dictionary of the most frequent ones for the tasks, a table of
    all (id, lang, word, n), and whether words outside the dictionary are numbered by hash.

    Words whose hashes clash go to the dictionary, so numbers tell words apart.
    """
    spark = words.sparkSession
    few = words.count() <= max_words
    top = words if few else words.orderBy(F.desc("n"), "lang", "word").limit(max_words)
    rows = _rows(top)
    if not few:
        def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                pairs = zip(batch.column("lang").to_pylist(), batch.column("word").to_pylist(), strict=True)
                ids = np.array([word_hash(lang, word) for lang, word in pairs], np.uint64).view(np.int64)
                yield pa.record_batch({**{c: batch.column(c) for c in ("lang", "word", "n")}, "id": pa.array(ids, pa.int64())})

        taken = _table(spark, rows).select("lang", "word")
        rest = materialize(words.join(taken, ["lang", "word"], "left_anti").select("lang", "word", "n").mapInArrow(
            hashed, "lang string, word binary, n long, id long"))
        clashing = rest.join(rest.groupBy("id").count().filter("count > 1"), "id", "left_semi")
        rows += _rows(clashing)
    rows.sort(key=lambda r: (-r[2], r[0], r[1]))
    dictionary: dict[str, dict[bytes, int]] = {}
    for i, (lang, word, _) in enumerate(rows, start=1):
        dictionary.setdefault(lang, {})[word] = i
    table = _table(spark, rows)
    if not few:
        table = table.unionByName(rest.join(clashing.select("id").distinct(), "id", "left_anti").select(table.columns))
    return dictionary, table, not few


def _rows(words: DataFrame) -> list[tuple[str, bytes, int]]:
    found = words.select("lang", "word", "n").toArrow()
    return list(zip(*(found.column(c).to_pylist() for c in ("lang", "word", "n")), strict=True))


def _table(spark, rows: list[tuple[str, bytes, int]]) -> DataFrame:
    columns = list(zip(*rows, strict=True)) or [[], [], []]
    return spark.createDataFrame(pa.table({
        "id": pa.array(range(1, len(rows) + 1), pa.int64()), "lang": pa.array(columns[0], pa.string()),
        "word": pa.array(columns[1], pa.binary()), "n": pa.array(columns[2], pa.int64())}))


def _score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 * a * n / (left * right)), exact beyond 64 bits."""
    wide = lambda c, digits: c.cast(f"decimal({digits},0)")
    return F.call_function("div", wide(F.lit(1000), 4) * wide(a, 16) * wide(n, 16), wide(left, 18) * wide(right, 18))


def collocations(docs: DataFrame, least: int = 100, top: int = 2000, text_col: str = "text", lang_col: str = "lang",
                 max_words: int = 500_000, filter_bits: int = 1 << 26, part_rows: int = 4_000_000,
                 budget: int = 1_000_000, salts: int = 64) -> DataFrame:
    """Best collocations of each language: lang, rank, phrase, a, l, r, n, score.

    A candidate is a phrase of 2 to 5 words within a piece of text that occurs `least` times (a). Its score is the least,
    over its cuts into a first part and a rest, of floor(1000 * a * n / (l * r)), with n all words of the language and
    l and r the occurrences of the parts; of equal cuts the first counts. Candidates that lie inside a longer one that
    occurs as often are dropped. The first `top` by score, a (both descending) and phrase (by bytes) are returned.

    A null or empty text has no words; a null language is `und`. Repeated rows count again; very long texts are counted
    in batches of words. Other columns are ignored; no rows, or no candidates, give no rows.

    max_words bounds the dictionary that tasks hold; frequent words beyond it are numbered by hash. filter_bits is the
    size of the filter of frequent pairs. budget is the number of phrases a task holds before it writes runs, part_rows
    the number of words of the corpus for each prefix partition. None of them changes the result.
    """
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                        F.col(text_col).cast("binary").alias("text")).filter("text is not null")
    words = materialize(count_words(texts, budget).filter(F.col("word").isNull() | (F.col("n") >= least)))
    totals = words.filter("word is null").select("lang", F.col("n").alias("total"))
    dictionary, known, hashed = vocabulary(words.filter("word is not null"), max_words)
    parts = lambda rows: max(1, min(100_000, -(-rows // part_rows)))
    size = totals.agg(F.sum("total")).first()[0] or 0
    pairs = materialize(count_phrases(texts, dictionary, hashed, 2, 2, least, parts(size), budget, bits=filter_bits))
    often = pairs.agg(F.sum("n")).first()[0] or 0
    # A pair above one part in 20,000 is dealt by more words: at most 20,000 of them.
    hot = pairs.filter(F.col("n") > max(part_rows, often // 20_000)).select("ids").collect()
    hot = np.array([r["ids"] for r in hot], np.int64).reshape(-1, 2).view(np.uint64)
    longer = materialize(count_phrases(texts, dictionary, hashed, 3, LONGEST, least, parts(often), budget,
                                       slot_filter(pairs, filter_bits), _hash(list(hot.T))))
    found = pairs.unionByName(longer).select("ids", "n")
    return best_phrases(_scored(found, known, totals), known, top, salts)


def _scored(found: DataFrame, known: DataFrame, totals: DataFrame) -> DataFrame:
    """Candidates that stay, with the cut that counts: ids, lang, a, l, r, total, score."""
    times = found.unionByName(known.select(F.array("id").alias("ids"), "n"))
    size = F.size("ids")
    cuts = found.withColumnRenamed("n", "a").withColumn("k", F.explode(F.sequence(F.lit(1), size - 1))).select(
        "ids", "a", "k", F.slice("ids", 1, F.col("k")).alias("left"), F.slice("ids", F.col("k") + 1, size - F.col("k")).alias("right"))
    cuts = cuts.join(times.select(F.col("ids").alias("left"), F.col("n").alias("l")), "left")
    cuts = cuts.join(times.select(F.col("ids").alias("right"), F.col("n").alias("r")), "right")
    cuts = cuts.join(known.select(F.col("id").alias("first"), "lang"), F.get("ids", F.lit(0)) == F.col("first")).join(totals, "lang")
    cut = F.struct(_score(F.col("a"), F.col("total"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r")
    weakest = cuts.groupBy("ids", "lang", "a", "total").agg(F.min(cut).alias("cut"))
    inner = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda m: F.transform(
        F.sequence(F.lit(1), size - m + 1), lambda at: F.slice("ids", at, m))))
    inside = found.filter(size > 2).select(F.explode(inner).alias("ids"), "n").groupBy("ids").agg(F.max("n").alias("outer"))
    stays = weakest.join(inside, "ids", "left").filter(F.col("outer").isNull() | (F.col("outer") < F.col("a")))
    return stays.select("ids", "lang", "a", "total", "cut.l", "cut.r", "cut.score")


def best_phrases(scored: DataFrame, known: DataFrame, top: int, salts: int) -> DataFrame:
    """The first `top` of each language, with their words. Each of `salts` parts of a language is cut to `top` before."""
    parts = scored.select("*", F.posexplode("ids").alias("at", "id")).join(known.select("id", "word"), "id")
    spelled = parts.groupBy("ids", "lang", "a", "total", "l", "r", "score").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda p: p["word"].cast("string")), " ").alias("phrase"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = spelled.withColumn("salt", F.pmod(F.xxhash64("ids"), F.lit(salts)))
    place = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    few = salted.withColumn("rank", place("lang", "salt")).filter(F.col("rank") <= top)
    ranked = few.withColumn("rank", place("lang")).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
                         F.col("total").alias("n"), "score")
