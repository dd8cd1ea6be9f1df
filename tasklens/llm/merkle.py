"""Merkle fingerprints of texts, in built-in functions only.

A text is cut into sections at blank lines, a section into paragraphs at line ends, a paragraph into leaves at sentence
ends or after `LEAF` characters. Nothing is dropped, so the leaves in order are the text. Each leaf has a hash, each
node the hash of its children's, and the root that of the sections': equal roots mean equal texts, and branches that
differ show where.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEAF = 64
_LEAVES = r"[^.!?\n]{1,%d}[.!?\n]*+|[.!?\n]+" % LEAF


def _node(children: Column) -> Column:
    return F.sha2(F.array_join(children, ","), 256)


def tree(text: Column) -> Column:
    """Sections of paragraphs of leaf hashes."""
    leaves = lambda p: F.transform(F.regexp_extract_all(p, F.lit(_LEAVES), F.lit(0)),
                                   lambda leaf: F.sha2(leaf, 256))
    paragraphs = lambda s: F.transform(F.split(s, r"(?<=\n)"), leaves)
    cut = F.transform(F.split(text, r"(?<=\n\n)(?!\n)"), paragraphs)
    return F.when(text == "", F.array().cast("array<array<array<string>>>")).otherwise(cut)


def _hashes(sections: Column) -> Column:
    """Hash of each section with the hashes of its paragraphs."""
    hashed = F.transform(sections, lambda s: F.transform(s, _node))
    return F.transform(hashed, lambda p: F.struct(_node(p).alias("hash"), p.alias("paragraphs")))


def root(sections: Column) -> Column:
    return _node(F.transform(sections, lambda s: _node(F.transform(s, _node))))


def written(sections: Column) -> Column:
    """The fingerprint as text: root, then for each section its leaves, by paragraph. Only here leaves are shortened, to
    8 digits; the root is made of whole ones."""
    body = F.array_join(F.transform(sections, lambda s: F.array_join(
        F.transform(s, lambda p: F.array_join(F.transform(p, lambda leaf: F.left(leaf, F.lit(8))), "")), ",")), ";")
    return F.concat(root(sections), F.lit(":"), body)


def likeness(a: Column, b: Column) -> Column:
    """Shared distinct leaves of two trees over their mean number, 0 to 1; 1 for two trees without leaves."""
    flat = [F.array_distinct(F.flatten(F.flatten(x))) for x in (a, b)]
    size = F.size(flat[0]) + F.size(flat[1])
    return F.when(size == 0, F.lit(1.0)).otherwise(2.0 * F.size(F.array_intersect(*flat)) / size)


def differing(a: Column, b: Column) -> Column:
    """Where two trees differ, from the top: (section, paragraph) numbers from 0; equal branches aren't entered."""
    left, right = _hashes(a), _hashes(b)
    at = lambda x, i: F.get(x, i)
    numbers = lambda x, y: F.sequence(F.lit(0), F.greatest(F.size(x), F.size(y), F.lit(1)) - 1)

    def inside(i):
        p, q = at(left, i)["paragraphs"], at(right, i)["paragraphs"]
        changed = F.filter(numbers(F.coalesce(p, F.array()), F.coalesce(q, F.array())),
                           lambda j: ~at(p, j).eqNullSafe(at(q, j)))
        return F.transform(changed, lambda j: F.struct(i.alias("section"), j.alias("paragraph")))

    changed = F.filter(numbers(left, right), lambda i: ~at(left, i)["hash"].eqNullSafe(at(right, i)["hash"]))
    return F.flatten(F.transform(changed, inside))


def with_next(rows: DataFrame, rows_a_bucket: int = 3_000, max_buckets: int = 20_000) -> DataFrame:
    """Add `next_text`: the text of the following row by descending doc_id, after the last the first.

    Rows with null ids come last, rows that share an id by the hash of their texts. Rows go to buckets of near ids, cut
    at approximate quantiles; a copy of each bucket's first row closes the bucket before it, so one shuffle is enough.
    """
    count = rows.count()
    if not count:
        return rows.withColumn("next_text", F.lit(None).cast("string"))
    buckets = max(1, min(max_buckets, count // rows_a_bucket))
    cuts = rows.approxQuantile("doc_id", [i / buckets for i in range(1, buckets)], 0.25 / buckets) if buckets > 1 else []
    placed = rows.withColumn("_id", F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf"))))
    if cuts:
        splits = [float("-inf"), *sorted(set(cuts)), float("inf")]
        placed = Bucketizer(splits=splits, inputCol="_id", outputCol="_bucket").transform(placed)
    else:
        placed = placed.withColumn("_bucket", F.lit(0.0))
    placed = placed.drop("_id").withColumn("_tie", F.xxhash64("text"))

    order = F.struct(F.col("doc_id").isNotNull().alias("known"), F.col("doc_id"), F.col("_tie"))
    firsts = placed.groupBy("_bucket").agg(F.max(order).alias("first")).orderBy(F.desc("_bucket")).collect()
    ghosts = [(f["first"]["doc_id"], f["first"]["_tie"], firsts[i - 1]["_bucket"]) for i, f in enumerate(firsts)]
    ghosts = rows.sparkSession.createDataFrame(ghosts, "g_id long, g_tie long, g_bucket double")
    copies = placed.join(F.broadcast(ghosts), F.col("doc_id").eqNullSafe(F.col("g_id")) & (F.col("_tie") == F.col("g_tie")))
    copies = copies.withColumn("_bucket", F.col("g_bucket")).drop("g_id", "g_tie", "g_bucket")
    both = placed.withColumn("_copy", F.lit(False)).unionByName(copies.withColumn("_copy", F.lit(True)))
    line = Window.partitionBy("_bucket").orderBy("_copy", F.desc_nulls_last("doc_id"), F.desc("_tie"))
    return both.withColumn("next_text", F.lead("text").over(line)).filter(~F.col("_copy")).drop("_bucket", "_tie", "_copy")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint of every text, of an edited copy of it, and how like they and the next text's are.

    The edited copy has its last third (rounded down, in code points) replaced by the first as many code points of the
    next document by descending id. Returns one row per input row: doc_id, text, edited, sections, edited_sections (the
    trees), fingerprint, edited_fingerprint, near_edited, near_next.

    A null text counts as empty; an empty text has no leaves, is like another empty one (1) and unlike any other (0).
    A single row follows itself. Other columns are ignored; no rows give no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.left("text", n - third), F.left("next_text", third))
    cut = with_next(rows).select("doc_id", "text", edited.alias("edited"), tree(F.col("next_text")).alias("_next"))
    cut = cut.select("*", tree(F.col("text")).alias("sections"), tree(F.col("edited")).alias("edited_sections"))
    return cut.select(
        "doc_id", "text", "edited", "sections", "edited_sections", written(F.col("sections")).alias("fingerprint"),
        written(F.col("edited_sections")).alias("edited_fingerprint"),
        likeness(F.col("sections"), F.col("edited_sections")).alias("near_edited"),
        likeness(F.col("sections"), F.col("_next")).alias("near_next"))
