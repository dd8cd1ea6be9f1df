"""Language identification, toxicity, quality rules and language-model scores: held-out accuracy and odd rows."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tasklens.llm.language import fit_languages, identify_languages
from tasklens.llm.lm_score import PairModel, _answered, _count, _merged, _runs, cross_entropy_difference, unpacked
from tasklens.llm.rules import accepted, lasso_logistic, quality_scores
from tasklens.llm.string_kernel import Landmarks, Sentences, fit_toxicity, toxicity_scores
from tests.llm.conftest import LONG

ODD = [(900, None), (901, ""), (902, "..."), (903, "12 34"), (904, LONG), (None, "Some words."), (905, "Some words."), (905, "Some words.")]


def labels_of(spark, rows, name):
    return spark.createDataFrame(rows + [(None, 1), (3, None)], f"doc_id long, {name} int").withColumn("text", F.lit("x"))


def check_odd(scored, count):
    rows = scored.collect()
    assert len(rows) == count
    assert all(0 <= r.score <= 1 for r in rows)
    same = [r.score for r in rows if r.doc_id in (905, None)]
    assert len(same) == 3 and len(set(same)) == 1


@pytest.fixture(scope="module")
def prose():
    r = random.Random(4)
    word = lambda: "".join(r.choice(["ba", "ne", "ti", "ro", "lu", "sa", "mi"]) for _ in range(r.randrange(2, 5)))

    def text(extra=()):
        words = [word() + ("." if r.random() < 0.1 else "") for _ in range(r.randrange(20, 60))]
        for e in extra:
            words[r.randrange(len(words))] = e
        return " ".join(words)

    return r, text


def test_toxicity_finds_gapped_insults(spark, frame, prose):
    r, text = prose
    insults = ["grumbleknox", "vexwortig"]
    train = [(i, text([r.choice(insults)] if i % 4 == 0 else [])) for i in range(240)]
    bent = ["grum-bleknox", "grumbl3eknox", "vexxwortig", "v.exwortig", "grumbleknoxes"]
    held = [(300 + i, text([bent[i % 5]] if i % 2 == 0 else [])) for i in range(40)]
    labels = labels_of(spark, [(i, int(i % 4 == 0)) for i, _ in train], "toxic")
    scored = toxicity_scores(frame(train + held + ODD), labels)
    got = {row.doc_id: row.score for row in scored.filter("doc_id between 300 and 399").collect()}
    assert np.mean([(got[300 + i] >= 0.5) == (i % 2 == 0) for i in range(40)]) >= 0.95
    check_odd(scored.filter("doc_id is null or doc_id >= 900"), len(ODD))
    assert toxicity_scores(frame([]), labels).count() == 0
    assert {x.score for x in toxicity_scores(frame(train[:3]), labels.limit(0)).collect()} == {0.5}


def test_kernel_is_the_sum_over_common_subsequences():
    def plain(a, b, decay):
        def weights(w):
            found = {}
            for i in range(len(w)):
                for j in range(i + 1, len(w)):
                    for k in range(j + 1, len(w)):
                        key = w[i] + w[j] + w[k]
                        found[key] = found.get(key, 0) + decay ** (k - i + 1)
            return found

        x, y = weights(a), weights(b)
        dot = sum(v * y.get(k, 0) for k, v in x.items())
        return dot / (sum(v * v for v in x.values()) * sum(v * v for v in y.values())) ** 0.5

    marks = ["scum", "pathetic", "banana"]
    words = ["scum", "sc-um", "pathetically", "bananas", "ab"]
    got = Landmarks.of(marks, 0.6, 2).kernel(words)
    for i, w in enumerate(words[:4]):
        for j, m in enumerate(marks):
            assert got[i, j] == pytest.approx(plain(w, m, 0.6) ** 2, abs=1e-5)
    assert (got[4] == 0).all()


def test_sentences_put_spelt_words_together():
    found = Sentences.of(["You b a d one. Bad bad end", None, "", "x y"])
    parts = [[found.vocabulary[c] for c in found.code[found.sentence == s]] for s in range(len(found.owner))]
    assert [sorted(p) for p in parts] == [["a", "b", "bad", "d", "one", "you"], ["bad", "end"], ["x", "y"]]
    assert found.owner.tolist() == [0, 0, 3]


def test_toxicity_fit_without_both_labels_is_constant():
    assert set(fit_toxicity([("a b", 0), (None, 0)]).scores(["c", None]).round(6)) == {0.001}


def test_quality_rules_separate_and_filter(spark, frame, prose):
    r, text = prose
    rows = [(i, text() if i % 3 else text().upper().replace(" ", "!! ")) for i in range(300)]
    labels = labels_of(spark, [(i, int(i % 3 > 0)) for i in range(0, 300, 2)], "quality")
    scored = quality_scores(frame(rows + ODD), labels)
    got = {x.doc_id: x.score for x in scored.filter("doc_id < 300").collect()}
    assert np.mean([(got[i] >= 0.3) == (i % 3 > 0) for i in range(1, 300, 2)]) >= 0.97
    check_odd(scored.filter("doc_id is null or doc_id >= 900"), len(ODD))
    kept = accepted(frame(rows), labels, least=0.3)
    assert kept.columns == frame(rows).columns
    assert {x.doc_id for x in kept.collect()} == {i for i, s in got.items() if s >= 0.3}
    assert quality_scores(frame([]), labels).count() == 0
    assert {x.score for x in quality_scores(frame(rows[:2]), labels.limit(0)).collect()} == {0.5}


def test_lasso_drops_what_does_not_matter():
    r = np.random.default_rng(0)
    x = r.integers(0, 2, (2000, 6)).astype(float)
    y = (r.random(2000) < np.where(x[:, 0] > 0, 0.9, 0.1)).astype(float)
    _, w = lasso_logistic(x, y, 0.02)
    assert w[0] > 1 and (np.abs(w[1:]) < 1e-6).all()


def test_languages_of_unseen_words_and_odd_rows(spark, frame):
    r = random.Random(8)
    ends = {"aa": ["heit", "ung", "lich"], "bb": ["tion", "ment", "eau"], "cc": ["dor", "mente", "cion"]}
    word = lambda g: "".join(r.choice("bdfgklmn") + r.choice("aeiou") for _ in range(2)) + r.choice(ends[g])
    rows = [(i, " ".join(word("abc"[i % 3] * 2) for _ in range(12))) for i in range(240)]
    training = spark.createDataFrame([(t, "abc"[i % 3] * 2) for i, t in rows[:120]] + [(None, "aa"), ("zz", None)],
                                     "text string, lang string")
    found = identify_languages(frame(rows + ODD), training)
    got = {x.doc_id: x.lang_pred for x in found.collect()}
    assert np.mean([got[i] == "abc"[i % 3] * 2 for i in range(120, 240)]) >= 0.97
    assert {got[900], got[901], got[902], got[903]} == {"und"} and got[905] != "und"
    check_odd(found.filter("doc_id is null or doc_id >= 900"), len(ODD))
    assert identify_languages(frame([]), training).count() == 0
    assert {x.lang_pred for x in identify_languages(frame(rows[:2]), training.limit(0)).collect()} == {"und"}


def test_unseen_words_fall_back_to_shorter_grams(spark):
    model = fit_languages(spark.createDataFrame([("abcd abce", "x"), ("zzzz zzzy", "y")], "text string, lang string"))
    assert model.langs == ["x", "y"]
    assert (model.likelihoods(["abcd"])[0] == model.word_values[model.words.index("abcd")]).all()
    for word, best in (("abcf", 0), ("zq", 1), ("qqa", 0)):
        assert word not in model.words and model.likelihoods([word])[0].argmax() == best
    table, words = dict(zip(model.grams, model.gram_values, strict=True)), ["abcf", "zqzz", "é", "bcdabcdzz"]
    for word, got in zip(words, model.likelihoods(words), strict=True):
        marked, rows = f"^{word}$", []
        for i in range(len(marked)):
            known = [marked[i: i + k] for k in (4, 3, 2, 1) if i + k <= len(marked) and marked[i: i + k] in table]
            rows += [table[known[0]]] if known else []
        assert got == pytest.approx(sum(rows) / len(rows))


def test_cross_entropy_difference_equals_plain_models(spark, frame):
    rows = [(1, "a b a b"), (2, "A b c"), (3, "c d c d d"), (4, "b"), (5, None), (6, " "), (None, "d c zz")]
    docs = frame(rows).withColumn("target", F.when(F.col("doc_id") == 6, None).otherwise(F.col("doc_id") <= 2))
    got = {x.doc_id: x for x in cross_entropy_difference(docs, "target", max_pairs=1000).collect()}
    words = {i: (t or "").lower().split() for i, t in rows}
    inside = [[w for i, w in words.items() if i in (1, 2)], [w for i, w in words.items() if i not in (1, 2)]]
    vocabulary = {w for t in words.values() for w in t}

    def loss(model, text):
        single = [w for t in model for w in t]
        pairs = [p for t in model for p in zip(t, t[1:], strict=False)]
        chance = lambda w: (single.count(w) + 0.5) / (len(single) + 0.5 * (len(vocabulary) + 1))
        total = 0
        for i, w in enumerate(text):
            p = chance(w)
            if i:
                first = single.count(text[i - 1])
                p = 0.7 * (pairs.count((text[i - 1], w)) / first if first else p) + 0.3 * p
            total -= np.log(p)
        return total / len(text)

    for i, text in words.items():
        assert got[i].n_tokens == len(text)
        others = [[t for t in m if t is not text] for m in inside]
        want = [loss(m, text) for m in others] if text else [0, 0]
        assert [got[i].target_loss, got[i].background_loss] == pytest.approx(want)
        assert got[i].score == pytest.approx(want[1] - want[0])
    assert got[1].score > 0 > got[3].score
    empty = frame([]).withColumn("target", F.lit(True))
    assert cross_entropy_difference(empty, "target").count() == 0


def test_losses_do_not_depend_on_what_is_in_memory(frame):
    r = random.Random(3)
    rows = [(i, " ".join(r.choice("abcdefgh") * r.randrange(1, 4) for _ in range(r.randrange(1, 40)))) for i in range(60)]
    docs = frame([*rows, rows[0], (None, rows[1][1]), (70, None), (71, "once only")]).withColumn("target", F.col("doc_id") % 3 == 0)
    want = sorted(map(tuple, cross_entropy_difference(docs, "target").collect()), key=str)
    assert len(want) == 64
    for words, pairs, bits in ((0, 0, 1 << 26), (5, 20, 1 << 15), (0, 1000, 1 << 15)):
        found = cross_entropy_difference(docs, "target", max_words=words, max_pairs=pairs, filter_bits=bits,
                                         shard_bytes=bits >> 7).collect()
        for a, b in zip(sorted(map(tuple, found), key=str), want, strict=True):
            assert a[:2] == b[:2] and a[2:] == pytest.approx(b[2:])


def test_runs_of_keys_give_the_counts_back():
    r = np.random.default_rng(5)
    for shards in (1, 7, 64):
        batches = [[r.integers(-(2 ** 63), 2 ** 63, 40) for _ in range(5)] + [np.array([3, 3, -1, 2 ** 63 - 1, -(2 ** 63)])] for _ in range(3)]
        target = np.array([True, False, False, True, False, True])
        runs = pa.Table.from_batches([_runs(b, target, p, shards) for b in batches for p in (False, True)])
        for shard in set(runs["shard"].to_pylist()):
            part = _merged(runs.filter(pa.array([x == shard for x in runs["shard"].to_pylist()])))
            for pair, key, n, inside in zip(*(part[c].to_pylist() for c in ("pair", "key", "n", "n_target")), strict=True):
                want = [sum(int((d == key).sum()) for b in batches for d, t in zip(b, target, strict=True) if t or every) for every in (1, 0)]
                assert [n, inside] == want and (n > 1 or not pair) and (key % 2 ** 64) * shards >> 64 == shard
        assert runs.num_rows <= 6 * shards


def test_scoring_shuffles_texts_once_and_no_row_for_a_pair(frame):
    r = random.Random(8)
    rows = [(i, " ".join(r.choice("abcdefghijkl") for _ in range(30))) for i in range(40)]
    docs = frame(rows).withColumn("target", F.col("doc_id") % 3 == 0)
    scored = cross_entropy_difference(docs, "target", max_words=0, max_pairs=0, shard_bytes=128)
    assert len(scored.collect()) == 40
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("ReusedExchange") == 1


def test_answers_are_counts_in_the_order_of_a_batch_s_keys():
    r = random.Random(6)
    batches = [pa.table({"text": [" ".join(r.choice("abcdefghij") for _ in range(r.randrange(9))) for _ in range(n)] + [None, "X x"],
                         "target": [r.random() < 0.5 for _ in range(n + 2)]}) for n in (0, 3, 20)]
    shards = 7
    runs = pa.concat_tables(_count(shards)((pa.scalar(i),), b) for i, b in enumerate(batches))
    at = lambda table, c, v: table.filter(pa.array([x == v for x in table[c].to_pylist()]))
    answers = pa.concat_tables(_answered(at(runs, "shard", i)) for i in range(shards))
    texts = [((t or "").lower().split(), m) for b in batches for t, m in zip(b["text"].to_pylist(), b["target"].to_pylist(), strict=True)]
    for pair in (False, True):
        keys = [(k, m) for w, m in texts for k in (zip(w, w[1:], strict=False) if pair else w)]
        n, inside = Counter(k for k, _ in keys), Counter(k for k, m in keys if m)
        for i, b in enumerate(batches):
            own = {k for t in b["text"].to_pylist() for w in [(t or "").lower().split()] for k in (zip(w, w[1:], strict=False) if pair else w)}
            found = [a for a in at(answers, "batch", i).to_pylist() if a["pair"] == pair and a["size"]]
            got = [(int(x), int(y)) for a in found for x, y in zip(unpacked(a["n"], a["size"]), unpacked(a["n_target"], a["size"]), strict=True)]
            seen = [(0, 0) if pair and n[k] == 1 else (n[k], inside[k]) for k in own]
            assert sorted(got) == sorted(seen) and sum(len(a["n"]) + len(a["n_target"]) for a in found) == 2 * len(own)
    words = Counter(w for t, _ in texts for w in t)
    for i, b in enumerate(batches):
        own, mine = {w for t in b["text"].to_pylist() for w in (t or "").lower().split()}, at(answers, "batch", i)
        pairs = sum(a["size"] for a in mine.to_pylist() if a["pair"])
        model = PairModel.of(len(own), pairs, mine, 0.7)
        inside = sum(len(t) for t, m in texts if m)
        assert [model.distinct, *model.total.ravel()] == [len(words) + 1, inside, words.total() - inside]
        with pytest.raises(ValueError, match="changes"):
            PairModel.of(len(own) + 1, pairs, mine, 0.7)


def test_languages_do_not_depend_on_what_is_in_memory(spark, frame):
    r = random.Random(9)
    word = lambda a: "".join(r.choice(a) for _ in range(r.randrange(2, 7)))
    rows = [(i, " ".join(word("abcdef" if i % 9 else "defghi") for _ in range(6))) for i in range(90)] + [(None, "😀 é ²")]
    training = spark.createDataFrame([(t, "x" if i % 9 else "y") for i, t in rows[:45]], "text string, lang string")
    model = fit_languages(training)
    totals = {t: model.likelihoods(t.split()).sum(axis=0) for _, t in rows[:90]}
    for most, grams, bits in ((0, 1000, 1 << 26), (20, 1000, 1 << 15), (20, 0, 1 << 15), (200_000, 30, 1 << 15)):
        found = {x.doc_id: x for x in identify_languages(frame(rows), training, max_words=most, max_grams=grams,
                                                         filter_bits=bits).collect()}
        assert len(found) == 91
        for i, t in rows[:90]:
            best = totals[t].argmax()
            assert found[i].lang_pred == "xy"[best]
            assert found[i].score == pytest.approx(1 / np.exp(totals[t] - totals[t][best]).sum())
