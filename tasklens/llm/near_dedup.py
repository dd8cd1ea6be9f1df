"""MinHash near-dedup by chosen paths.

Every distinct shingle set carries `coordinates` minwise tokens. A tree starts with all sets; a node is split by a few
chosen tokens, so a set goes to one child for each chosen token, and sets that share the token share the child. A node
of bounded size is compared exhaustively, first by tokens and then on the full sets; a larger one is split again. Small
nodes keep the chance of a missed pair low, and independent trees multiply it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasklens.llm.components import connected_components
from tasklens.llm.hashing import mix, run_hashes, word_hashes
from tasklens.llm.staging import materialize


def shingle_set(text: bytes | None, words: int) -> np.ndarray:
    """Sorted hashes of the distinct word shingles; of all words as one, if there are fewer; empty without words."""
    coded = word_hashes(text.lower().split()) if text else np.empty(0, np.uint64)
    if 0 < len(coded) < words:
        return run_hashes(coded, len(coded)) ^ np.uint64(len(coded))
    return np.unique(run_hashes(coded, words))


class MinHasher:
    def __init__(self, coordinates: int):
        random = np.random.default_rng(11)
        self.factor = random.integers(0, 2**32, (coordinates, 1), dtype=np.uint32) | np.uint32(1)
        self.mask = random.integers(0, 2**32, (coordinates, 1), dtype=np.uint32)

    def tokens(self, shingles: np.ndarray) -> np.ndarray:
        short = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
        blocks = [((short[i: i + 2048] ^ self.mask) * self.factor).min(axis=1) for i in range(0, len(short), 2048)]
        return np.min(blocks, axis=0)


_SIGNED = "doc_id long, n_shingles long, low long, high long, tokens binary"


def _sign(words: int, coordinates: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = MinHasher(coordinates)
        for batch in batches:
            size, low, high, tokens = [], [], [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                found = shingle_set(text, words)
                size.append(len(found))
                low.append(mix(found + np.uint64(1)).sum(dtype=np.uint64))
                high.append(mix(found ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))
                tokens.append(hasher.tokens(found).tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(np.array(low, np.uint64).view(np.int64)),
                pa.array(np.array(high, np.uint64).view(np.int64)), pa.array(tokens, pa.binary()),
            ], ["doc_id", "n_shingles", "low", "high", "tokens"])

    return task


_NODES = "node long, doc_id long, n_shingles long"


def _branch(coordinates: int, trees: int, branches: int):
    """Children of every row: of the node in column `node`, or of the root of each tree."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            tokens = np.frombuffer(b"".join(batch.column("tokens").to_pylist()), np.uint32)
            tokens = tokens.reshape(batch.num_rows, coordinates).astype(np.uint64)
            if "node" in batch.schema.names:
                paths = [batch.column("node").to_numpy().view(np.uint64)]
            else:
                paths = [np.full(batch.num_rows, tree, np.uint64) for tree in range(trees)]
            row = np.arange(batch.num_rows)
            for path in paths:
                chosen = mix(path * np.uint64(2) + np.uint64(1))
                first, step = chosen % np.uint64(coordinates), (chosen >> np.uint64(32)) | np.uint64(1)
                for i in range(branches):  # odd steps through a power of two never repeat a coordinate
                    at = (first + np.uint64(i) * step) % np.uint64(coordinates)
                    child = mix(path + mix(at * np.uint64(0x9E3779B1) + (tokens[row, at.astype(np.int64)] << np.uint64(16))))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(child.view(np.int64)), batch.column("doc_id"), batch.column("n_shingles")],
                        ["node", "doc_id", "n_shingles"])

    return task


def _labels(linked: np.ndarray) -> np.ndarray:
    """Smallest member of each part of a small symmetric link matrix."""
    label = np.arange(len(linked))
    while True:
        nearest = np.minimum(label, np.where(linked, label, len(linked)).min(axis=1))
        if (nearest == label).all():
            return label
        label = nearest[nearest]


def _likely(coordinates: int, agree: int):
    """Parts of each node whose members may be linked, by the number of equal tokens."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for members in batch.column("members").to_pylist():
                members.sort(key=lambda m: m["doc_id"])
                tokens = np.frombuffer(b"".join(m["tokens"] for m in members), np.uint32).reshape(-1, coordinates)
                linked = np.concatenate([
                    (tokens[i: i + 64, None] == tokens[None]).sum(axis=2) >= agree for i in range(0, len(tokens), 64)])
                label = _labels(linked)
                parts: dict[int, list[int]] = {}
                for m, part in zip(members, label.tolist(), strict=True):
                    parts.setdefault(part, []).append(m["doc_id"])
                found.extend(p for p in parts.values() if len(p) > 1)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int64()))], ["members"])

    return task


def _near_hub(agree: int):
    """Pairs of a hub and a set with enough equal tokens."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(batch.num_rows, -1)
                    for c in ("tokens", "hub_tokens"))
            near = (a == b).sum(axis=1) >= agree
            ids = np.stack([batch.column("hub").to_numpy()[near], batch.column("doc_id").to_numpy()[near]], axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(list(ids), pa.list_(pa.int64()))], ["members"])

    return task


def linked_parts(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Smallest member of each part of the sets, where pairs of at least this similarity are linked. Exact."""
    label, sizes = np.arange(len(sets)), np.array([len(s) for s in sets])
    if len(sets) == 2:
        both = len(np.intersect1d(*sets, assume_unique=True))
        return label * (100 * both < percent * (sizes.sum() - both))
    _, code = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(label, sizes)[np.argsort(code, kind="stable")]
    times = np.bincount(code)
    begin = np.cumsum(times) - times
    for i, codes in enumerate(np.split(code, np.cumsum(sizes)[:-1])):
        n = times[codes]
        at = np.repeat(begin[codes] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        both = np.bincount(owner[at], minlength=len(sets))
        near = label[100 * both >= percent * (sizes + sizes[i] - both)]
        if (near != near[0]).any():
            label[np.isin(label, near)] = near.min()
        if not label.any():
            break
    return label


def _confirm(words: int, percent: int):
    """Links of each candidate part, confirmed on full sets: every member points at the smallest one it is tied to."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(ids, sets):
            order = np.argsort(ids, kind="stable")
            ids = np.array(ids)[order]
            label = linked_parts([sets[i] for i in order], percent)
            tied = label != np.arange(len(label))
            return pa.RecordBatch.from_arrays([pa.array(ids[tied]), pa.array(ids[label[tied]])], ["a", "b"])

        part, ids, sets = None, [], []
        for batch in batches:
            rows = zip(batch.column("part").to_pylist(), batch.column("doc_id").to_pylist(),
                       batch.column("text").cast(pa.binary()).to_pylist(), strict=True)
            for now, doc_id, text in rows:
                if now != part:
                    if len(ids) > 1:
                        yield links(ids, sets)
                    part, ids, sets = now, [], []
                ids.append(doc_id)
                sets.append(shingle_set(text, words))
        if len(ids) > 1:
            yield links(ids, sets)

    return task


def near_duplicates(docs: DataFrame, percent: int = 85, words: int = 5, trees: int = 4, branches: int = 2,
                    coordinates: int = 64, node_docs: int = 4096, node_shingles: int = 4_000_000,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Groups of documents tied by links of at least `percent` Jaccard similarity of their word shingles.

    Returns one row per input row: doc_id, n_shingles, component_id (the smallest id that links lead to, itself
    included) and kept (it is that id). Words are runs of anything but ASCII whitespace, with A-Z lower-cased; a text of
    fewer than `words` words is one shingle.

    Texts that are null, empty or without words have no shingles and are linked with nothing. Equal sets are one set
    from the start, so copies cost one row each. Rows that repeat an id are the same node of the link graph. A row with
    a null id has a null component and is not kept. Other columns are ignored; a table without rows gives none.

    Two linked sets are compared unless they part in every tree: with the defaults, at the threshold, less than once in
    a million in a node split once, and about once in a million in one split many times. Equal tokens of at least
    `coordinates` times `percent`, less five standard deviations, make a pair worth its full comparison. A node has at
    most `node_docs` sets and `node_shingles` shingles, or two sets. In a larger one all sets are compared with one of
    them, first by tokens; a node whose sets are all tied to it is done, and any other is split again.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed = materialize(rows.mapInArrow(_sign(words, coordinates), _SIGNED))
    classes = materialize(
        signed.filter("n_shingles > 0 and doc_id is not null").groupBy("low", "high", "n_shingles")
        .agg(F.min("doc_id").alias("set_id"), F.first("tokens").alias("tokens")))
    sets = classes.select(F.col("set_id").alias("doc_id"), "n_shingles", "tokens")
    share = percent / 100
    agree = int(coordinates * share - 5 * (coordinates * share * (1 - share)) ** 0.5)

    split = _branch(coordinates, trees, branches)
    nodes = materialize(sets.mapInArrow(split, _NODES))
    parts, links = [], []
    while True:
        sizes = nodes.groupBy("node").agg(F.count("*").alias("docs"), F.sum("n_shingles").alias("shingles"),
                                          F.min("doc_id").alias("hub")).filter("docs > 1")
        sized = materialize(nodes.join(sizes, "node"))
        small = (F.col("docs") == 2) | (F.col("docs") <= node_docs) & (F.col("shingles") <= node_shingles)
        parts.append(materialize(
            sized.filter(small).join(sets.select("doc_id", "tokens"), "doc_id").groupBy("node")
            .agg(F.collect_list(F.struct("doc_id", "tokens")).alias("members")).select("members")
            .mapInArrow(_likely(coordinates, agree), "members array<long>").distinct()))
        large = sized.filter(~small)
        if large.isEmpty():
            break
        stars = large.filter("doc_id <> hub").select("hub", "doc_id").distinct()
        close = stars.join(sets.select("doc_id", "tokens"), "doc_id").join(
            sets.select(F.col("doc_id").alias("hub"), F.col("tokens").alias("hub_tokens")), "hub")
        close = materialize(close.mapInArrow(_near_hub(agree), "members array<long>"))
        tied = materialize(_links(rows, close, words, percent))
        links.append(tied)
        loose = large.filter("doc_id <> hub").join(
            tied.select(F.col("a").alias("doc_id"), F.col("b").alias("hub")), ["doc_id", "hub"], "left_anti")
        large = large.join(loose.select("node").distinct(), "node", "left_semi")
        nodes = materialize(large.select("node", "doc_id").join(sets, "doc_id").select(
            "node", "doc_id", "n_shingles", "tokens").mapInArrow(split, _NODES))

    everything = parts[0]
    for more in parts[1:]:
        everything = everything.unionByName(more)
    # These parts grow with the documents, so their texts are shuffled at every size.
    confirmed = _links(rows, materialize(everything.distinct()).hint("merge"), words, percent)
    for more in links:
        confirmed = confirmed.unionByName(more)
    set_of = classes.select("low", "high", "n_shingles", "set_id")
    placed = signed.drop("tokens").join(set_of, ["low", "high", "n_shingles"], "left").withColumn(
        "set_id", F.coalesce("set_id", "doc_id"))
    # An id with several texts ties the sets of all of them.
    twice = materialize(signed.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id"))
    if not twice.isEmpty():
        same = placed.join(twice, "doc_id", "left_semi").select(F.col("doc_id").alias("a"), F.col("set_id").alias("b"))
        confirmed = confirmed.unionByName(same.distinct())
    components = connected_components(confirmed)
    out = placed.join(components, F.col("set_id") == F.col("node"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "set_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))


def _links(rows: DataFrame, parts: DataFrame, words: int, percent: int) -> DataFrame:
    members = parts.select(F.xxhash64("members").alias("part"), F.explode("members").alias("doc_id"))
    texts = members.join(rows, "doc_id").select("part", "doc_id", "text")
    return texts.repartition("part").sortWithinPartitions("part").mapInArrow(_confirm(words, percent), "a long, b long")
