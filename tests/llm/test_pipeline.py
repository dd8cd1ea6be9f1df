"""The pipeline stage by stage, and what each registered query returns."""

import subprocess
import sys

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tasklens.llm.queries import ORACLES, QUERIES
from tests.compare import connect, difference
from tests.llm import brute
from tests.llm.conftest import LONG

SMALL = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_lm_scoring": ["doc_id", "n_tokens", "target_loss", "background_loss", "score"],
    "op2_packing": ["doc_id", "n_tokens", "bucket", "padded_to", "batch"],
    "op3_near_dedup": ["doc_id", "n_shingles", "component_id", "kept"],
    "op4_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    "op5_merkle_fingerprints": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    "op6_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op7_quality_rules": ["doc_id", "held_out", "score", "predicted"],
    "op8_benchmark_decontamination": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op9_substring_dedup": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op10_secret_scan": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op11_exact_dedup": ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
}
OTHERS = {"op12_collocations", "op13_centroid_clusters"}


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_queries_return_a_row_for_every_document(spark, documents, name):
    assert set(QUERIES) == set(COLUMNS) | OTHERS and set(ORACLES) <= set(QUERIES)
    df = QUERIES[name](spark, SMALL)
    assert df.columns == COLUMNS[name]
    rows = df.collect()
    texts = {r.doc_id: r.text for r in documents.collect()}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    if name == "op3_near_dedup":
        assert {r.doc_id: tuple(r)[1:] for r in rows} == brute.near_dedup(texts.items())
    if name == "op9_substring_dedup":
        want = {i: (n, gone, brute.sha(kept)) for i, n, gone, kept in brute.substring_dedup(texts.items())}
        assert {r.doc_id: tuple(r)[1:] for r in rows} == want


def test_stages_keep_columns_and_take_effect(spark, documents):
    docs, items = documents, [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r for r in docs.collect()}
        docs = corpus_pipeline.materialize(stage(spark, docs, SMALL))
        after = {r.doc_id: r for r in docs.collect()}
        assert set(after) <= set(before) and after
        if k < 4:
            assert docs.columns == documents.columns
        if name == "near_dedup":
            assert set(after) == {i for i, x in brute.near_dedup([(i, r.text) for i, r in before.items()]).items() if x[2]}
            assert len({r.text for r in after.values()}) == len(after)
        if name == "decontaminate":
            hit = {i for i, _, words, _ in brute.contamination([(i, r.text) for i, r in before.items()], items) if words}
            assert {i for i in before if i not in after or after[i].text != before[i].text} == hit
            assert not any(words for _, _, words, _ in brute.contamination([(i, r.text) for i, r in after.items()], items))
        if name == "mask_secrets":
            assert set(after) == set(before) and not any(brute.base_secrets(r.text) for r in after.values())
        if k < 4:
            assert all(r.n_chars == len(r.text) for i, r in after.items() if r.text != before[i].text)


def test_stages_of_odd_documents(spark, documents):
    """Nulls, empty and very long texts, repeated rows, names that clash with those of the stages, missing columns, no rows."""
    item = spark.read.parquet(f"{SMALL}/benchmark.parquet").filter("length(text) > 80").first().text
    clean = [r.text for r in documents.limit(3).collect()]
    rows = [(1, ""), (2, None), (None, None), (None, "x y"), (3, clean[0]), (3, clean[0]), (4, LONG), (5, item),
            (6, f"password = {'a1B2' * 6} and more"), (7, clean[1] + " " + item), (8, clean[2])]
    odd = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("key", "Found", "new", "spans", "score", "kept", "__found", "__text", "__row_key"):
        odd = odd.withColumn(name, F.lit("mine"))
    hit = {5, 7}
    for docs in (odd, odd.withColumn("n_chars", F.length("text").cast("long"))):
        for name, stage in corpus_pipeline.STAGES[1:4]:
            out = stage(spark, docs, SMALL)
            assert out.columns == docs.columns and stage(spark, docs.limit(0), SMALL).count() == 0
            got = out.collect()
            assert all(r.key == r.Found == r["__found"] == "mine" for r in got)
            if name == "decontaminate":
                assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in rows if i != 5)
                assert {r.doc_id for r in got if (r.doc_id, r.text) not in rows} == hit - {5}
            else:
                assert len(got) == len(rows)
            if "n_chars" in docs.columns:
                assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in got)
    assert corpus_pipeline.packing(spark, odd, SMALL).count() == len(rows)
    assert corpus_pipeline.quality(spark, odd, SMALL).columns == odd.columns


def test_broadcast_models_carry_their_classes(spark):
    """Opened where this package can't be imported."""
    from tasklens.llm.staging import send
    from tasklens.llm.fm_index import Windows

    sent = send(spark, Windows([], 10)).value
    code = "import pickle, sys; x = pickle.loads(sys.stdin.buffer.read()); print(type(x).__name__, 'tasklens' in sys.modules)"
    done = subprocess.run([sys.executable, "-I", "-c", code], input=sent, capture_output=True, cwd="/", check=False)
    assert done.stdout.split() == [b"Windows", b"False"], done.stderr


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, name):
    assert difference(QUERIES[name](spark, SMALL), connect(SMALL), ORACLES[name]) is None
