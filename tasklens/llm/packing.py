"""Packing into length buckets whose boundaries waste the least padding, then into batches of a token budget."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tasklens.llm.staging import materialize


def best_boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper ends of at most `buckets` runs of a histogram of ascending lengths that minimise the padded total.

    least[j] is the least total for the first j lengths. With one more bucket it is the least over i < j of least[i] plus
    lengths[j - 1] for each of the documents between: lines in lengths[j - 1], whose slopes fall as i grows, so the lower
    hull of the lines seen so far is walked once. Whole numbers; time and memory are buckets times lengths.
    """
    ends, upto = [int(n) for n in lengths], [0, *np.cumsum(counts).tolist()]
    least, choices = [0, *(None for _ in ends)], []
    for _ in range(min(buckets, len(ends))):
        hull, at, totals, choice = [], 0, [0], []
        for j, end in enumerate(ends, 1):
            if least[j - 1] is not None:
                line = (-upto[j - 1], least[j - 1], j - 1)
                while len(hull) > 1 and _never_lowest(hull[-2], hull[-1], line):
                    hull.pop()
                hull.append(line)
            at = min(at, len(hull) - 1)
            while at + 1 < len(hull) and hull[at + 1][0] * end + hull[at + 1][1] <= hull[at][0] * end + hull[at][1]:
                at += 1
            slope, start, i = hull[at]
            totals.append(start + (slope + upto[j]) * end)
            choice.append(i)
        least = totals
        choices.append(choice)
    cuts, j = [], len(ends)
    for choice in reversed(choices):
        if j == 0:
            break
        cuts.append(ends[j - 1])
        j = choice[j - 1]
    return cuts[::-1]


def _never_lowest(a: tuple, b: tuple, c: tuple) -> bool:
    """Whether line b, whose slope is between those of a and c, is nowhere below both."""
    return (c[1] - a[1]) * (a[0] - b[0]) <= (b[1] - a[1]) * (a[0] - c[0])


def pack(docs: DataFrame, buckets: int = 8, token_budget: int = 65_536, rows_a_shard: int = 100_000,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Bucket and batch of every text, by its number of words.

    Boundaries minimise the padding of all documents over the global length histogram. A bucket's documents are padded
    to its boundary; a batch has as many of them as fit into `token_budget`, at least one, so a text above the budget is
    a batch of its own. Returns one row per input row: doc_id, n_tokens, bucket (from 0), padded_to, batch (from 0 in
    the bucket). Within a bucket, rows follow a hash of id and text, so repeated rows fall together.

    The driver sees the exact histogram. Documents of d different lengths have at least d * d / 2 words, so it has at
    most the square root of twice the corpus's words: 7 million lengths for 100 TB.

    A null, empty or wordless text has no tokens and a null bucket, padded_to and batch. Null ids are packed like
    others; other columns are ignored; no rows give no rows.
    """
    words = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(r"[^ \t-\r]+"))
    lengths = materialize(docs.select(F.col(id_col).alias("doc_id"), words.cast("long").alias("n_tokens"),
                                      F.xxhash64(id_col, text_col).alias("h")))
    full = lengths.filter("n_tokens > 0")
    found = full.groupBy("n_tokens").count().toArrow().sort_by("n_tokens")
    counts = found["count"].to_numpy()
    cuts = best_boundaries(found["n_tokens"].to_numpy(), counts, buckets)
    none = lengths.filter("n_tokens = 0").select(
        "doc_id", "n_tokens", *(F.lit(None).cast(t).alias(n) for n, t in (("bucket", "int"), ("padded_to", "long"), ("batch", "long"))))
    if not cuts:
        return none
    ends = F.array(*(F.lit(c).cast("long") for c in cuts))
    bucket = F.size(F.filter(ends, lambda end: end < F.col("n_tokens")))
    shards = max(1, int(counts.sum()) // rows_a_shard)
    placed = full.select("doc_id", "n_tokens", bucket.alias("bucket"), "h").withColumn(
        "shard", F.pmod("h", F.lit(shards)))
    sizes = placed.groupBy("bucket", "shard").count()
    before = sizes.select("bucket", "shard", (F.sum("count").over(
        Window.partitionBy("bucket").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)) - F.col("count")).alias("before"))
    line = Window.partitionBy("bucket", "shard").orderBy("h", "doc_id", "n_tokens")
    padded = F.element_at(ends, F.col("bucket") + 1)
    place = F.col("before") + F.row_number().over(line) - 1
    batch = F.floor(place / F.greatest(F.floor(F.lit(token_budget) / padded), F.lit(1)))
    packed = placed.join(before, ["bucket", "shard"]).select(
        "doc_id", "n_tokens", "bucket", padded.alias("padded_to"), batch.cast("long").alias("batch"))
    return packed.unionByName(none)
