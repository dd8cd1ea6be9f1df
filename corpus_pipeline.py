"""From raw documents to packed training batches, in five stages.

Each stage takes (spark, docs, sf_dir) and all that the one before has kept. All but the last return the columns that
they were given, whatever else they are called. Rows that share an id and a text stand or fall together; rows with a null
id are never near-duplicates. Null and empty texts pass every stage but the quality classifier, which scores them as it
does others. No documents give none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tasklens.llm.fm_index import cut_words, find_contamination
from tasklens.llm.near_dedup import near_duplicates
from tasklens.llm.packing import pack
from tasklens.llm.queries import bucket_of
from tasklens.llm.rules import accepted
from tasklens.llm.secret_scan import masked, scan_secrets
from tasklens.llm.staging import materialize, table

def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble, fitted to the labels of these documents, scores at 0.3 or more."""
    labels = table(spark, sf_dir, "labels", "doc_id", "quality").filter(bucket_of("doc_id", 5) != 0)
    return accepted(docs, labels, least=0.3)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    gone = near_duplicates(docs).filter("doc_id is not null and not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words that lie in a window of a benchmark item. A text of which no word is left goes; one that
    was null or empty before stays."""
    items = table(spark, sf_dir, "benchmark", "item_id", "text")
    key, found = _fresh(docs, "key"), _fresh(docs, "found")
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    hits = find_contamination(keyed, items, id_col=key).filter(F.size("spans") > 0)
    cut = _with_found(keyed, hits, key, found)
    return _retexted(cut, docs, found, cut_words).filter(F.col(found).isNull() | (F.col("text") != "")).select(docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with every secret replaced by a mark. All documents stay."""
    key, found = _fresh(docs, "key"), _fresh(docs, "found")
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    hits = scan_secrets(keyed, id_col=key).filter(F.size("spans") > 0)
    return _retexted(_with_found(keyed, hits, key, found), docs, found, masked).select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bucket and batch of every document."""
    return pack(docs)


def _fresh(docs: DataFrame, name: str) -> str:
    """A column name that the documents don't have, in any case of letters."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def _with_found(keyed: DataFrame, hits: DataFrame, key: str, found: str) -> DataFrame:
    """Add the spans found in each row, null without any. Rows with one id and one text have one key."""
    spans = hits.select(F.col("doc_id").alias(key), F.col("spans").alias(found))
    return keyed.join(spans.dropDuplicates([key]), key, "left")


def _retexted(rows: DataFrame, docs: DataFrame, found: str, changed) -> DataFrame:
    """Rows with spans get the changed text; n_chars, if there is one, follows where the text changes."""
    hit = F.col(found).isNotNull()
    new = _fresh(rows, "new")
    out = rows.withColumn(new, F.when(hit, changed(F.col("text"), F.col(found))).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        same = F.col(new).eqNullSafe(F.col("text"))
        out = out.withColumn("n_chars", F.when(same, F.col("n_chars")).otherwise(F.length(new).cast("long")))
    return out.withColumn("text", F.col(new))


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mask_secrets", mask_secrets),
    ("packing", packing),
]

# The rule ensemble is fitted, and packing needs dynamic programming: SQL can't say either. The tests hold the stages
# against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder before the next."""
    docs = table(spark, sf_dir, "documents", "*")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
