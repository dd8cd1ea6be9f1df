"""Substring dedup: documents meet on winnowed anchors, matches grow around them, repeated windows go.

A window is `length` consecutive words. Each has one anchor, the smallest hash among its runs of `seed` words, so two
equal windows have equal anchors at equal places. Only anchors found more than once are extended: every window around
such an anchor, from the one that ends with it to the one that starts with it, is matched against the windows of the
other places with that anchor. Those that are found once only are struck out; that costs one shuffle, as a group of one
says where it stands. A maximal repeat is a union of overlapping repeated windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasklens.llm.hashing import run_hashes, word_hashes
from tasklens.llm.staging import materialize


def _window_anchors(hashes: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchor position of every window, and the hash of every seed. The leftmost smallest seed is the anchor."""
    seeds = run_hashes(hashes, seed)
    width = length - seed + 1
    if len(seeds) < width:
        return np.empty(0, np.int64), seeds
    views = np.lib.stride_tricks.sliding_window_view(seeds, width)
    return np.arange(len(views)) + views.argmin(axis=1), seeds


def _find_anchors(length: int, seed: int):
    """Places and hashes of the anchors of every document that has a window."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, places, anchors, ends = [], [], [], [0]
            for row, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
                words = text.split() if text else []
                if len(words) >= length:
                    at, seeds = _window_anchors(word_hashes(words), length, seed)
                    at = at[np.concatenate([[True], at[1:] != at[:-1]])]
                    rows.append(row)
                    places.append(at.astype(np.int32))
                    anchors.append(seeds[at].view(np.int64))
                    ends.append(ends[-1] + len(at))
            if rows:
                of, stops = pa.array(rows), pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(c).take(of) for c in _KEY),
                    pa.ListArray.from_arrays(stops, pa.array(np.concatenate(places))),
                    pa.ListArray.from_arrays(stops, pa.array(np.concatenate(anchors))),
                ], [*_KEY, "places", "anchors"])

    return task


def _remove(words: list[bytes], starts: np.ndarray, length: int) -> tuple[list[bytes], list[dict]]:
    """Words outside the windows, and the maximal repeats as [first, last + 1) word numbers."""
    edges = np.zeros(len(words) + 1, np.int32)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + length, -1)
    gone = np.cumsum(edges)[:-1] > 0
    turns = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
    kept = [words[i] for i in np.flatnonzero(~gone)]
    return kept, [{"start": int(a), "end": int(b)} for a, b in zip(turns[::2], turns[1::2], strict=True)]


def _final(words: list[bytes], digest: bool) -> str:
    text = b" ".join(words)
    return hashlib.sha256(text).hexdigest() if digest else text.decode()


# What tells rows with one id, or none, apart: 96 bits of hash of the text.
_KEY = ("doc_id", "text_hash", "text_check")
_ANCHORS = "doc_id long, text_hash long, text_check int, places array<int>, anchors array<long>"
_EXTENDED = "doc_id long, n_words long, kept string, text string, runs array<struct<first:int,last:int>>"
_RUNS = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))


def _starts(runs: pa.Scalar) -> np.ndarray:
    """Word numbers at which windows start, out of runs of them, last one included."""
    firsts, lasts = (runs.values.field(c).to_numpy() for c in ("first", "last"))
    sizes = lasts - firsts + 1
    return np.repeat(firsts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def _extend(length: int, seed: int, digest: bool):
    """Documents without a shared anchor are done. The others give the runs of windows around their shared anchors."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, kept, texts, runs = [], [], [], []
            columns = zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("places"), strict=True)
            for text, places in columns:
                words = text.split() if text else []
                n_words.append(len(words))
                if not places.is_valid:
                    kept.append(_final(words, digest))
                    texts.append(None)
                    runs.append([])
                    continue
                at, _ = _window_anchors(word_hashes(words), length, seed)
                shared = np.zeros(len(words), bool)
                shared[places.values.to_numpy()] = True
                turns = np.flatnonzero(np.diff(np.concatenate([[0], shared[at].view(np.int8), [0]])))
                kept.append(None)
                texts.append(text)
                runs.append([{"first": int(a), "last": int(b) - 1} for a, b in zip(turns[::2], turns[1::2], strict=True)])
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(kept, pa.string()),
                pa.array(texts, pa.binary()).cast(pa.string()), pa.array(runs, _RUNS),
            ], ["doc_id", "n_words", "kept", "text", "runs"])

    return task


def _windows(length: int):
    """Hash and place of every window in the runs."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, starts, hashes = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            columns = zip(batch.column("row").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(),
                          batch.column("runs"), strict=True)
            for row, text, runs in columns:
                at = _starts(runs)
                rows.append(np.full(len(at), row))
                starts.append(at)
                hashes.append(run_hashes(word_hashes(text.split()), length)[at].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(rows)), pa.array(np.concatenate(starts).astype(np.int32)), pa.array(np.concatenate(hashes))],
                ["row", "start", "hash"])

    return task


_RESULT = "doc_id long, n_words long, n_removed long, kept string, repeats array<struct<start:int,end:int>>"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _finish(length: int, digest: bool):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, removed, kept, repeats = [], [], [], []
            columns = zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("runs"),
                          batch.column("alone"), strict=True)
            for text, runs, alone in columns:
                words = text.split()
                at = _starts(runs)
                if alone.is_valid:
                    at = at[~np.isin(at, alone.values.to_numpy())]
                rest, spans = _remove(words, at, length)
                n_words.append(len(words))
                removed.append(len(words) - len(rest))
                kept.append(_final(rest, digest))
                repeats.append(spans)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(removed, pa.int64()),
                pa.array(kept, pa.string()), pa.array(repeats, _SPANS),
            ], ["doc_id", "n_words", "n_removed", "kept", "repeats"])

    return task


def remove_repeats(docs: DataFrame, length: int = 35, seed: int = 8, id_col: str = "doc_id", text_col: str = "text",
                   digest: bool = False) -> DataFrame:
    """Remove every word inside a window of `length` words that also starts anywhere else, the same text included.

    Returns one row per input row: doc_id, n_words, n_removed, kept (the words left, joined by one space; with `digest`
    the SHA-256 of that) and repeats (maximal repeats as word ranges, end exclusive). Words are runs of anything but
    ASCII whitespace. Windows are judged on the input.

    A null or empty text has no words and stays as it is; a text shorter than `length` loses nothing. Repeated rows are
    copies of each other, so all their windows go. An id on rows with different texts, and a null id, are kept apart by
    96 bits of hash of the text. Other columns are ignored. A table without rows gives none. Windows are told apart by 64 bits of
    hash.
    """
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"),
                       F.xxhash64(text).alias("text_hash"), F.hash(text).alias("text_check"))
    # Written once, so the numbers of rows stay as they are.
    found = materialize(rows.mapInArrow(_find_anchors(length, seed), _ANCHORS).select(
        F.monotonically_increasing_id().alias("row"), "*"))
    anchors = found.select("row", F.explode(F.arrays_zip("places", "anchors")).alias("a")).select(
        "row", F.col("a.places").alias("place"), F.col("a.anchors").alias("anchor"))
    # Written first, so both sides of the join come from a shuffle and adaptive execution can split a hot anchor.
    shared = materialize(anchors.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor"))
    places = anchors.join(shared, "anchor", "left_semi").groupBy("row").agg(F.collect_set("place").alias("places"))
    places = places.join(found.select("row", *_KEY), "row").select(*_KEY, "places").dropDuplicates(_KEY)

    extended = materialize(
        _by_document(rows, places).select("doc_id", "text", "places").mapInArrow(_extend(length, seed, digest), _EXTENDED)
        .select(F.monotonically_increasing_id().alias("row"), "*"))
    affected = extended.filter("text is not null").select("row", "doc_id", "text", "runs")
    # Hashed where they are shuffled: written, they would take more room than the texts.
    windows = affected.select("row", "text", "runs").mapInArrow(_windows(length), "row long, start int, hash long")
    # Of a window that is found once, the exclusive or over its group is its own row and start.
    single = windows.groupBy("hash").agg(
        F.count("*").alias("n"), F.bit_xor("row").alias("row"), F.bit_xor("start").alias("start")).filter("n = 1")
    alone = single.groupBy("row").agg(F.collect_list("start").alias("alone"))
    finished = affected.join(alone, "row", "left").select("doc_id", "text", "runs", "alone").mapInArrow(_finish(length, digest), _RESULT)
    done = extended.filter("text is null").select(
        "doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), "kept",
        F.array().cast("array<struct<start:int,end:int>>").alias("repeats"))
    return done.unionByName(finished)


def _by_document(rows: DataFrame, found: DataFrame) -> DataFrame:
    found = found.withColumnsRenamed({c: f"found_{c}" for c in _KEY})
    same = F.lit(True)
    for c in _KEY:
        same = same & F.col(c).eqNullSafe(F.col(f"found_{c}"))
    return rows.join(found, same, "left").drop(*(f"found_{c}" for c in _KEY))
