"""Near-dedup, substring dedup and decontamination against brute force."""

import random

import numpy as np
import pytest

from tasklens.llm.components import connected_components
from tasklens.llm.fm_index import FMIndex, cut_words, find_contamination, suffix_array
from tasklens.llm.hashing import word_hashes
from tasklens.llm.near_dedup import linked_parts, near_duplicates
from tasklens.llm.substring_dedup import remove_repeats
from tests.llm import brute
from tests.llm.conftest import LONG
from pyspark.sql import functions as F


def near_copies(seed: int = 1) -> list:
    """Groups of edited copies, chains of edits, exact copies, and odd texts."""
    r = random.Random(seed)
    word = lambda: r.choice("abcdefgh") + r.choice("aeiou") + r.choice("xyzw") + str(r.randrange(40))
    rows, line = [], " ".join(word() for _ in range(9))
    for group in range(12):
        text = [word() for _ in range(r.randrange(40, 160))]
        for _ in range(r.randrange(1, 9)):
            rows.append(f"{line} {' '.join(text)}" if group % 2 else " ".join(text))
            text = list(text)
            for _ in range(r.randrange(0, 4)):
                text[r.randrange(len(text))] = word()
    rows += ["", None, " \t\n ", "One", "one", "one two three four", "ONE two  three\tfour", LONG, LONG + " end", rows[0]]
    return [(i * 7 % 1009, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("node_docs", [4096, 6])
def test_near_duplicates_equal_brute_force(frame, node_docs):
    rows = near_copies()
    got = near_duplicates(frame(rows), node_docs=node_docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == brute.near_dedup(rows)
    assert len(got) == len(rows)


def test_near_duplicates_of_odd_rows(frame):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (None, "a b c d e f"), (3, "A b c d e f"), (9, None), (None, None)]
    got = sorted(near_duplicates(frame(rows)).collect(), key=str)
    assert [tuple(r) for r in got] == sorted(
        [(5, 2, 3, False), (5, 2, 3, False), (None, 2, None, False), (3, 2, 3, True), (9, 0, 9, True), (None, 0, None, False)],
        key=lambda t: str(next(r for r in got if tuple(r) == t)))
    assert near_duplicates(frame([])).count() == 0


def test_linked_parts_are_exact():
    r = np.random.default_rng(3)
    base = np.sort(r.choice(2**62, 100, replace=False).astype(np.uint64))
    sets = [np.sort(np.concatenate([base[k:], np.arange(k, dtype=np.uint64) + np.uint64(10**6 * k)])) for k in range(0, 40, 4)]
    label = linked_parts(sets, 85)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            both = len(np.intersect1d(a, b))
            if 100 * both >= 85 * (len(a) + len(b) - both):
                assert label[i] == label[j]
    assert len(set(label.tolist())) > 1


def test_components_of_chain_star_and_nothing(spark):
    links = [(i, i + 1) for i in range(1, 30)] + [(100, 200 + i) for i in range(50)] + [(7, 7), (None, 3), (100, 200)]
    got = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {i: 1 for i in range(2, 31)} | {200 + i: 100 for i in range(50)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def repeats() -> list:
    r = random.Random(5)
    words = lambda n: " ".join(f"{r.choice('abcdef')}{r.randrange(300)}" for _ in range(n))
    passage, short = words(50), words(34)
    texts = [f"{words(20)} {passage} {words(9)}", f"{passage}\n{words(40)}", f"{words(3)}  {short} {words(5)}", short,
             f"{passage} {passage}", words(35), "x " * 120, None, "", " ", LONG, "é ñ " * 40]
    return [(i, t) for i, t in enumerate(texts)] + [(40, texts[5]), (41, texts[5] + " more")]


def test_repeated_windows_equal_brute_force(frame):
    rows = repeats()
    got = remove_repeats(frame(rows)).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got) == sorted(brute.substring_dedup(rows))
    for r in got:
        assert sum(s.end - s.start for s in r.repeats) == r.n_removed
    digests = {r.doc_id: r.kept for r in remove_repeats(frame(rows), digest=True).collect()}
    assert digests == {r.doc_id: brute.sha(r.kept) for r in got}


def test_an_id_with_several_texts_is_one_node(frame):
    x, y, z = ("one two three four five six", "tell me more of all that", "nothing like the other ones")
    rows = [(1, x), (2, x), (2, y), (3, y), (4, z), (4, None), (5, z), (5, y + " x"), (6, None), (6, ""), (7, z)]
    got = sorted((r.doc_id, r.component_id, r.kept) for r in near_duplicates(frame(rows)).collect())
    want = {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6, 7: 4}
    assert got == sorted((i, want[i], want[i] == i) for i, _ in rows)


def test_rows_without_ids_are_told_apart(frame):
    """Texts without an id whose 32-bit hashes clash."""
    passage = " ".join(f"p{i}" for i in range(40))
    df = frame([]).sparkSession.range(400_000).selectExpr("id", "hash(concat('start ', id, ' %s')) as h" % passage)
    twice = df.groupBy("h").agg(F.min("id").alias("a"), F.max("id").alias("b"), F.count("*").alias("n")).filter("n > 1")
    clash = twice.first()
    rows = [(None, f"start {clash.a} {passage}"), (None, f"start {clash.b} {passage}"), (None, f"start {clash.a} {passage} {passage}")]
    got = sorted((r.n_words, r.n_removed, r.kept) for r in remove_repeats(frame(rows)).collect())
    assert got == sorted((n, gone, kept) for _, n, gone, kept in brute.substring_dedup(rows))


def test_repeated_windows_of_odd_rows(frame):
    text = " ".join(map(str, range(40)))
    rows = [(1, text), (1, text), (2, " ".join(map(str, range(100, 150)))), (None, "a " * 40), (2, "other words")]
    got = sorted((str(r.doc_id), r.n_words, r.n_removed) for r in remove_repeats(frame(rows)).collect())
    assert got == [("1", 40, 40), ("1", 40, 40), ("2", 2, 0), ("2", 50, 0), ("None", 40, 40)]
    assert remove_repeats(frame([])).count() == 0


def items() -> list:
    r = random.Random(9)
    words = lambda n: " ".join(f"{r.choice('ghijk')}{r.randrange(50)}é" for _ in range(n))
    return [(1, words(30)), (2, words(10)), (3, "short item"), (10, words(12)), (11, None), (12, "..."), (13, "Same, same same"),
            (None, words(15)), (3, "Second text of item three")]


@pytest.mark.parametrize("options", [{}, {"shard_words": 50, "sample": 3}, {"block_bytes": 60}])
def test_contamination_equals_brute_force(spark, frame, options):
    tests = items()
    rows = [(1, "intro " + tests[0][1][60:200] + " end"), (2, tests[1][1].upper().replace("É", "é")), (3, "a SHORT-item; here short item"),
            (4, "same same same same"), (5, None), (6, ""), (7, LONG), (8, tests[3][1] + " " + tests[3][1]), (8, "short"),
            (None, "second text of item three"), (9, tests[0][1] + " " + tests[1][1])]
    item_df = spark.createDataFrame(tests, "item_id long, text string").withColumn("doc_id", F.lit(1))
    got = find_contamination(frame(rows), item_df, **options).collect()
    want = brute.contamination(rows, [t for t in tests if t[0] is not None])
    flat = lambda spans: {i for s in spans for i in range(s.start, s.end)}
    key = lambda x: str((x[0], x[1], sorted(x[2]), x[3]))
    assert sorted([(r.doc_id, r.n_words, flat(r.spans), r["items"]) for r in got], key=key) == sorted(want, key=key)
    assert find_contamination(frame([]), item_df, **options).count() == 0
    assert find_contamination(frame(rows), item_df.limit(0), **options).filter(F.size("spans") > 0).count() == 0


def test_fm_index_counts_and_locates_every_run():
    r = np.random.default_rng(2)
    docs = [word_hashes([bytes([97 + c]) for c in r.integers(0, 3, n)]) for n in (40, 0, 17, 1, 40)] * 2
    index = FMIndex(docs, sample=4)
    for doc in docs[:4]:
        for size in (1, 2, 5):
            for i in range(len(doc) - size + 1):
                phrase = doc[i: i + size]
                low, high = index.count(index.codes(phrase)[None], np.array([size]))
                want = {int(s) + j for s, d in zip(index.starts, docs) for j in range(len(d) - size + 1)
                        if (d[j: j + size] == phrase).all()}
                assert set(index.locate(np.arange(low[0], high[0])).tolist()) == want


def test_suffix_array_sorts_suffixes():
    text = np.array([5, 4, 5, 4, 5, 0, 5, 4, 5, 4, 5, 1, 4, 4, 4, 2])
    assert suffix_array(text).tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())


def test_cut_words_keeps_the_rest(spark):
    df = spark.createDataFrame([("A b-c, d e!", [(1, 3)]), ("one two", [(0, 2)]), ("é x y", [(0, 1), (2, 3)])],
                               "text string, spans array<struct<start:int,end:int>>")
    assert [r[0] for r in df.select(cut_words(F.col("text"), F.col("spans"))).collect()] == ["A, d e!", "", " x"]
