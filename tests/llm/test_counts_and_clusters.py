"""Exact dedup, collocations and clusters against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tasklens.llm import phrase_trie
from tasklens.llm.chunk_recipes import chunks, clashing, chunk_store, exact_duplicates, normalized
from tasklens.llm.phrase_trie import HatTrie, collocations
from tasklens.llm.sharded_kmeans import _distances, blocks_of, cluster, quantized
from tests.llm import brute
from tests.llm.conftest import LONG
from tests.llm.test_native import no_python


def rows_of(df, columns=None):
    return Counter(tuple(r) for r in (df.select(*columns) if columns else df).collect())


SPACED = ["", None, " ", "\n\t ", "a b", "a\t\n b", " a b", "a  b ", LONG, LONG.replace(" ", "\n ", 5), LONG + " x", "é b", "a b"]
GROUP = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


@pytest.mark.parametrize("bits", [64, 2])
def test_exact_duplicates(frame, bits):
    """With 2 bits nearly all chunk hashes clash, and recipes need the places of chunks."""
    r = random.Random(1)
    prose = [" ".join(r.choice(["tasty", "bread", "and", "fine", "cake.", "déjà", "vu"]) for _ in range(r.randrange(400))) for _ in range(30)]
    texts = SPACED + prose + [p.replace(" ", "  ") for p in prose[:9]] + prose[:3]
    rows = [(i * 7 % 101, t) for i, t in enumerate(texts)] + [(None, "a b"), (None, "only null"), (None, "only null"), (3, "a b"), (3, "a b")]
    got = exact_duplicates(frame(rows), bits=bits, salts=4, shortest=64, longest=200)
    assert rows_of(got, GROUP) == Counter(brute.exact_groups(rows))
    assert no_python(got)
    assert rows_of(exact_duplicates(frame([]), bits=bits)) == Counter()


def test_chunks_are_the_text_and_edits_move_few(frame):
    r = random.Random(2)
    word = lambda: "".join(r.choice("abcdefghiklmnorstuvy") for _ in range(r.randrange(1, 9)))
    text = " ".join(word() for _ in range(20_000))
    edited = text[:30_000] + "one more thing " + text[30_000:]
    cjk = "吾輩は猫である。名前はまだ無い。" * 200
    cut = frame([(0, text), (1, edited), (2, cjk), (3, "x" * 20_000)]).select("doc_id", chunks(F.col("text")).alias("c"))
    got = {r.doc_id: r.c for r in cut.collect()}
    assert ["".join(got[i]) for i in range(4)] == [text, edited, cjk, "x" * 20_000]
    assert all(len(c) >= 512 for i in range(3) for c in got[i][:-1]) and max(map(len, got[3])) == 8192
    assert max(map(len, got[0])) < 1200 and max(map(len, got[2])) < 600
    assert len(set(got[1]) - set(got[0])) < 8


def test_clashing_chunks_are_told_apart(frame):
    texts = frame([(i, f"text {i}") for i in range(20)]).select(normalized(F.col("text")).alias("text"))
    assert clashing(chunk_store(texts)).isEmpty()
    found = clashing(chunk_store(texts, bits=1)).collect()
    assert len({(r.hash, r.place) for r in found}) == len({r.chunk for r in found}) == 20


def prose(seed: int, n: int) -> list:
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["New", "York", "new", "déjà", "vu"]
    rows = []
    for i in range(n):
        words = [r.choice(vocabulary[: 6 + r.randrange(39)]) for _ in range(r.randrange(60))]
        for k in range(len(words)):
            if r.random() < 0.15:
                words[k] = r.choice(["New York City hall", "new york", "déjà vu", "a b a b a b a b", "x, y; z", "q\tq\x0bq"])
        rows.append((r.choice(["en", "fr", None, "und"]), " ".join(words)))
    return [*rows, ("en", None), ("en", ""), ("xx", " \n.,"), ("xx", "one \x1c word"), ("long", LONG), ("long", "a b " * 20_000)]


@pytest.fixture(scope="module")
def spoken(spark):
    def make(rows):
        df = spark.createDataFrame(rows, "lang string, text string")
        for name in ("n", "ids", "word", "rank", "phrase", "a", "l", "r", "score", "total", "id", "part", "body", "slot"):
            df = df.withColumn(name, F.lit("x"))
        return df

    return make


@pytest.mark.parametrize("limits", [
    {}, {"max_words": 0}, {"max_words": 7, "filter_bits": 1 << 15}, {"budget": 50, "part_rows": 500, "salts": 3}])
def test_collocations(spoken, limits):
    """No dictionary, a small one, a filter that lets nearly all pass, many spills and partitions with hot pairs."""
    rows, (least, top) = prose(4, 400), (20, 2000) if len(limits) < 2 else (6, 15)
    got = collocations(spoken(rows), least=least, top=top, **limits)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = brute.collocations(rows, least, top)
    assert len(want) > 20 and any(len(w[2].split()) == 5 for w in want)
    assert rows_of(got) == Counter(want)


def test_collocations_of_clashing_words(spoken, monkeypatch):
    monkeypatch.setattr(phrase_trie, "word_hash", lambda lang, word: (1 << 63) | (len(word) % 2))
    rows = prose(5, 100)
    assert rows_of(collocations(spoken(rows), least=5, max_words=3)) == Counter(brute.collocations(rows, 5, 2000))


def test_collocations_of_nothing(spoken):
    assert collocations(spoken([])).count() == 0
    assert collocations(spoken([("en", None), (None, "a b")])).count() == 0


def test_scores_are_exact(spark):
    big = [(10**13 + 1, 10**13 + 7, 10**12 + 3, 10**12 + 9), (3, 7, 4, 6), (100, 10**13, 100, 100)]
    df = spark.createDataFrame(big, "a long, n long, l long, r long")
    got = df.select(phrase_trie._score(*(F.col(c) for c in "anlr"))).collect()
    assert [g[0] for g in got] == [1000 * a * n // (left * right) for a, n, left, right in big]


def test_trie_bursts_and_spills_whole_subtrees():
    r = random.Random(3)
    want, trie = Counter(), HatTrie(4, burst=20)
    for _ in range(5000):
        ids = [r.randrange(1, 4) * 256 for _ in range(r.randrange(2, 6))] + [0, 0, 0]
        (key,) = np.array([ids[:5]], ">u4").view("S20").ravel().tolist()
        trie.add([key], [2])
        want[key] += 2
    assert type(trie.root[b"\0\0\1\0"]) is dict and trie.size == len(want)
    first = list(trie.spill(trie.size - 1))
    rest = list(trie.spill())
    assert len({k[:4] for k, _ in first}) == 1 and trie.size == 0
    assert [k for k, _ in first] == sorted(k for k, _ in first)
    assert Counter(dict(first)) + Counter(dict(rest)) == want and not {k[:4] for k, _ in first} & {k[:4] for k, _ in rest}


def vectors(seed: int, n: int, dims: int = 64) -> list:
    r = random.Random(seed)
    rows = [(i, [r.gauss(i % 5, 0.6) for _ in range(dims)]) for i in range(n)]
    same = rows[7][1]
    odd = [(9001, None), (9002, []), (9003, [1.0] * (dims - 1)), (9004, [None] + [1.0] * (dims - 1)),
           (9005, [float("nan")] * dims), (9006, [float("inf")] * dims), (9007, [-0.0001] * dims), (None, [0.5] * dims), (5, [0.25] * dims)]
    return rows + [(1000 + i, same) for i in range(n // 3)] + odd


@pytest.fixture(scope="module")
def embedded(spark):
    def make(rows, kind="double"):
        df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(3)
        for name in ("cluster", "distance", "chunk", "block", "ids", "body", "n", "width", "inertia", "v", "vector"):
            df = df.withColumn(name, F.lit("x"))
        return df

    return make


@pytest.mark.parametrize("block_dims, rows_a_chunk", [(16, 16_384), (64, 10), (7, 50)])
def test_clusters(embedded, block_dims, rows_a_chunk):
    rows = vectors(6, 200)
    got = cluster(embedded(rows), rounds=4, block_dims=block_dims, rows_a_chunk=rows_a_chunk)
    assert rows_of(got) == Counter(brute.lloyd(rows, 8, 4, 64))


def test_clusters_of_few_or_odd_vectors(embedded):
    for rows in ([], [(1, None)], vectors(1, 9)[:3], [(None, [1.0] * 64), (None, [2.0] * 64)], [(i, [1.0] * 64) for i in range(20)]):
        assert rows_of(cluster(embedded(rows), rounds=2)) == Counter(brute.lloyd(rows, 8, 2, 64))
    huge = [(1, [1e300] * 64), (2, [-1e300] * 64), (3, [0.0] * 64)]
    got = {r.vec_id: r for r in cluster(embedded(huge), clusters=1, rounds=0).collect()}
    assert max(r.distance for r in got.values()) in (64 * 2**56, 64 * 2**54)


def test_blocks_stay_where_they_are(embedded):
    """Only distances and assignments are shuffled; blocks of one chunk meet with their assignments without a shuffle."""
    rows = quantized(embedded(vectors(2, 100)), 64, 1024, "vec_id", "embedding")
    blocks, _ = blocks_of(rows, 64, 16, 20)
    shards = blocks.rdd.map(lambda r: ((r["chunk"], r["block"]), (bytes(r["body"]), r["width"], r["n"]))).partitionBy(4)
    slices = [np.zeros((2, 16), np.int64) for _ in range(4)]
    back = _distances(shards, slices, 2).flatMap(lambda p: [((p[0], b), p[1]) for b in range(4)]).partitionBy(4)
    shuffles = shards.join(back, 4).toDebugString().decode().count("ShuffledRDD")
    assert shuffles == shards.toDebugString().decode().count("ShuffledRDD") * 2 + 2  # through the distances and directly
