"""Exact dedup by recipes of content-defined chunks, in built-in functions only.

A normalised text is cut where its own letters say so. Every distinct chunk gets an identifier that is verified against
the chunk's content; the ordered identifiers of a text are its recipe. Texts are equal when their recipes are, so only
distinct chunks and short lists are shuffled, and a long text is never moved whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tasklens.llm.staging import materialize

# A chunk ends after `SHORTEST` characters or more, at the first space that follows one of some characters and precedes
# one of others, or at a full stop of a script without spaces; where there is none, after `LONGEST`. Which places can end
# a chunk depends on the characters beside them alone, so an edit moves the cuts near it only.
SHORTEST, LONGEST = 512, 8192
_CUT = r"(?:(?<=[.,;:!?aeknrty\x80-\x{10FFFF}] )(?=[a-hA-H\d\x80-\x{10FFFF}])|(?<=[。、！？]))"
_CHUNKS = r"(?s).{%d,%d}?" + _CUT + r"|.{1,%d}"

# Runs of white space other than a single space; those already are what they become.
_SPACE = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normalized(text: Column) -> Column:
    """The text with every run of white space made one space; a null text is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _SPACE, " ")


def chunks(text: Column, shortest: int = SHORTEST, longest: int = LONGEST) -> Column:
    """The chunks of a text in order; together they are the text. An empty text has none."""
    return F.regexp_extract_all(text, F.lit(_CHUNKS % (shortest, longest, longest)), F.lit(0))


def chunk_hash(chunk: Column, bits: int = 64) -> Column:
    """Hash of a chunk; fewer bits make clashes likely, for tests."""
    return F.xxhash64(chunk) if bits == 64 else F.xxhash64(chunk).bitwiseAND(F.lit((1 << bits) - 1))


def chunk_store(texts: DataFrame, bits: int = 64, **limits: int) -> DataFrame:
    """Distinct chunks of the column `text`: hash, chunk. Equal chunks meet before the shuffle and after it."""
    every = texts.select(F.explode(chunks(F.col("text"), **limits)).alias("chunk"))
    return every.select(chunk_hash(F.col("chunk"), bits).alias("hash"), "chunk").distinct()


def clashing(store: DataFrame) -> DataFrame:
    """Chunks whose hash belongs to several contents, with the place of each among them: hash, chunk, place.

    The hashes are found first; only if there are any, chunks are moved again.
    """
    several = materialize(store.groupBy("hash").count().filter("count > 1").select("hash"))
    line = Window.partitionBy("hash").orderBy("chunk")
    if several.isEmpty():
        return store.limit(0).withColumn("place", F.lit(0))
    return store.join(several, "hash", "left_semi").withColumn("place", F.row_number().over(line) - 1)


def recipes(texts: DataFrame, bits: int = 64, **limits: int) -> DataFrame:
    """Rows of (doc_id, text) with their recipes: doc_id, n_chars, text_sha256, hashes, places.

    A chunk's identifier is its hash and its place among the contents of that hash. Places are 0 unless hashes clash, so
    they are listed only then; else the list is empty. The texts themselves are not kept.
    """
    known = [F.col("doc_id"), F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("text_sha256")]
    no_places = F.array().cast("array<int>").alias("places")
    clashes = clashing(chunk_store(texts, bits, **limits))
    if clashes.isEmpty():
        hashed = F.transform(chunks(F.col("text"), **limits), lambda c: chunk_hash(c, bits))
        return texts.select(*known, hashed.alias("hashes"), no_places)
    clashes = materialize(clashes)
    cut = texts.select(F.monotonically_increasing_id().alias("row"), *known, chunks(F.col("text"), **limits).alias("cut"))
    each = cut.select("row", "doc_id", "n_chars", "text_sha256", F.posexplode_outer("cut").alias("at", "chunk"))
    each = each.withColumn("hash", chunk_hash(F.col("chunk"), bits)).join(clashes, ["hash", "chunk"], "left")
    part = F.struct("at", "hash", F.coalesce("place", F.lit(0)).alias("place"))
    whole = each.groupBy("row", "doc_id", "n_chars", "text_sha256").agg(
        F.array_sort(F.collect_list(F.when(F.col("at").isNotNull(), part))).alias("parts"))
    places = F.when(F.exists("parts", lambda p: p["place"] > 0), F.col("parts.place")).otherwise(no_places)
    return whole.select("doc_id", "n_chars", "text_sha256", F.col("parts.hash").alias("hashes"), places.alias("places"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 256,
                     bits: int = 64, shortest: int = SHORTEST, longest: int = LONGEST) -> DataFrame:
    """Groups of texts that are equal but for the amount and kind of white space.

    Returns one row per input row: doc_id, keep_id (the smallest id of the group), group_size, kept (doc_id is keep_id),
    text_sha256 (of the normalised text), n_chars, n_chunks.

    Rows of a group are counted by recipe and one of `salts` parts of the ids, then over the parts, and looked up by
    recipe and part; so a group that holds a third of all rows is spread over all parts.

    A null text counts as empty, and all empty texts are equal. Leading and trailing white space stays, as one space.
    Null ids belong to groups but are kept only in a group without other ids, whose keep_id is null. Rows that repeat an
    id and a text stand or fall together. Other columns are ignored; no rows give no rows.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), normalized(F.col(text_col)).alias("text"))
    part = F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int").alias("part")
    rows = materialize(recipes(texts, bits, shortest=shortest, longest=longest).select("*", part))
    recipe = ["hashes", "places"]
    parts = rows.groupBy(*recipe, "part").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    group = Window.partitionBy(*recipe)  # `salts` rows at most
    groups = parts.select(*recipe, "part", F.min("first").over(group).alias("keep_id"),
                          F.sum("n").over(group).alias("group_size"))
    return rows.join(groups, [*recipe, "part"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256",
        "n_chars", F.size("hashes").cast("long").alias("n_chunks"))
