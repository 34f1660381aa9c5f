"""Substring deduplication by Relative Lempel-Ziv parsing.

Every document is parsed against all documents with a smaller id. Blocks chosen by content (sequences of
``BLOCK`` words that are least within their neighbourhood, so equal passages choose equal blocks) are
indexed; around a block that an earlier document has too, each window of ``window`` words is looked up
in the index of windows, which also checks the borders between factors. Windows that follow one another
in document and reference join greedily into factors; the words of factors are duplicate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.bitmap import bitmap, held
from tradewind.llm.common import steps, stored
from tradewind.llm.words import AS_IS, grams, hashed_words

#: Words of a block; a window of fifty words holds at least one whole chosen block.
BLOCK = 24


def sliding(values: np.ndarray, width: int, largest: bool = False) -> np.ndarray:
    """Least (or largest) value of each run of ``width``, by doubling."""
    pick = np.maximum if largest else np.minimum
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = pick(out[:-step], out[step:])
        have += step
    return out


def chosen_blocks(words: np.ndarray, window: int, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the blocks that are least among all blocks of some window."""
    span = window - block + 1
    blocks = grams(words, block)
    if len(blocks) < span:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    least = sliding(blocks, span)
    padded = np.concatenate([np.zeros(span - 1, np.uint64), least, np.zeros(span - 1, np.uint64)])
    at = np.flatnonzero(blocks == sliding(padded, span, largest=True))
    return at, blocks[at]


def windows_near(words: np.ndarray, at: np.ndarray, window: int, block: int) -> np.ndarray:
    """Starts of the windows that hold one of the blocks at ``at`` whole."""
    n = len(words) - window + 1
    marks = np.zeros(n + 1, np.int64)
    np.add.at(marks, np.clip(at - (window - block), 0, n), 1)
    np.add.at(marks, np.clip(at + 1, 0, n), -1)
    return np.flatnonzero(np.cumsum(marks[:n]) > 0)


def rows_of_words(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray]]:
    """Row, doc_id and hashed words of the rows with an id."""
    words, borders = hashed_words(batch.column(1), AS_IS)
    for row, doc_id in enumerate(batch.column(0).to_pylist()):
        if doc_id is not None:
            yield row, doc_id, words[borders[row] : borders[row + 1]]


def index_blocks(docs: DataFrame, window: int, block: int) -> DataFrame:
    """Hashes of the chosen blocks that documents of different ids share."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            hashes, ids = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for _, doc_id, words in rows_of_words(batch):
                found = np.unique(chosen_blocks(words, window, block)[1])
                hashes.append(found)
                ids.append(np.full(len(found), doc_id))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate(hashes).view(np.int64)), pa.array(np.concatenate(ids)),
            ], names=["block", "doc_id"])

    held_by = docs.mapInArrow(choose, "block long, doc_id long").groupBy("block").agg(
        F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")
    )
    return held_by.filter("first_id < last_id").select("block")


def window_rows(
    docs: DataFrame, blocks: Broadcast, repeated: Broadcast, window: int, block: int, wanted: Broadcast | None = None
) -> DataFrame:
    """``hash, doc_id, tag, start`` of every window around a shared block, or of the ``wanted`` ones of them.

    ``tag`` tells the texts of one repeated id apart; it is 0 where the id is not repeated.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            tags = np.where(held(repeated.value, batch.column(3).to_numpy()), batch.column(2).to_numpy(), 0)
            hashes, ids, own, starts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
            for row, doc_id, words in rows_of_words(batch):
                at, found = chosen_blocks(words, window, block)
                near = windows_near(words, at[held(blocks.value, found.view(np.int64))], window, block) if len(at) else at
                values = grams(words, window)[near]
                if wanted is not None and len(near):
                    some = held(wanted.value, values.view(np.int64))
                    near, values = near[some], values[some]
                if len(near):
                    hashes.append(values)
                    ids.append(np.full(len(near), doc_id))
                    own.append(np.full(len(near), tags[row]))
                    starts.append(near.astype(np.int32))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate(hashes).view(np.int64)), pa.array(np.concatenate(ids)),
                pa.array(np.concatenate(own)), pa.array(np.concatenate(starts)),
            ], names=["hash", "doc_id", "tag", "start"])

    return docs.mapInArrow(emit, "hash long, doc_id long, tag long, start int")


def factors(docs: DataFrame, window: int = 50, block: int = BLOCK) -> DataFrame:
    """The factors of every document with any: ``doc_id, tag, starts, lengths, sources``, one row each.

    A factor is a run of ``length`` words from ``start`` on whose windows all stand in ``source``, the
    smallest id that has them; factors of one document may overlap by less than a window.
    """
    ids = docs.groupBy("id_hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("id_hash")
    repeated = bitmap(stored(ids, "repeated"), "id_hash")
    blocks = bitmap(stored(index_blocks(docs, window, block), "blocks"), "block")
    # The texts are read again rather than all their windows kept: those would exceed the texts.
    index = window_rows(docs, blocks, repeated, window, block).groupBy("hash").agg(
        F.min("doc_id").alias("source"), F.max("doc_id").alias("last")
    ).filter("source < last").select(F.col("hash").alias("window_hash"), "source")
    index = stored(index, "windows")
    rows = window_rows(docs, blocks, repeated, window, block, bitmap(index, "window_hash"))
    found = rows.join(index, rows["hash"] == index["window_hash"]).filter("source < doc_id")
    # The windows of one document, never more than its words.
    gathered = found.groupBy("doc_id", "tag").agg(F.sort_array(F.collect_set(F.struct("start", "source"))).alias("windows"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], []]
            for windows in batch.column(2):
                at = np.array(windows.values.field("start"), np.int64)
                source = np.array(windows.values.field("source"), np.int64)
                new = np.append(True, (np.diff(at) != 1) | (np.diff(source) != 0))
                begin = np.flatnonzero(new)
                end = np.append(begin[1:], len(at)) - 1
                out[0].append(at[begin].tolist())
                out[1].append((at[end] - at[begin] + window).tolist())
                out[2].append(source[begin].tolist())
            lists = [pa.array(x, pa.list_(pa.int64())) for x in out]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *lists], names=["doc_id", "tag", "starts", "lengths", "sources"])

    return gathered.mapInArrow(join, "doc_id long, tag long, starts array<long>, lengths array<long>, sources array<long>")


def deduplicate(docs: DataFrame, window: int = 50, block: int = BLOCK) -> DataFrame:
    """Per row: ``doc_id, n_words, n_removed, kept`` (the kept words joined by one space).

    Uses ``doc_id`` and ``text`` alone, so other columns may have any name. A null or empty text has no words.
    A row without ``doc_id`` is neither reduced nor a reference. Rows that share a ``doc_id`` don't reduce one
    another; each is reduced against smaller ids. An empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tag"), F.xxhash64("doc_id").alias("id_hash"))
    spans = factors(rows, window, block).select(F.col("doc_id").alias("__id"), F.col("tag").alias("__tag"), "starts", "lengths")
    joined = rows.join(spans, (F.col("doc_id") == F.col("__id")) & ((F.col("__tag") == 0) | (F.col("tag") == F.col("__tag"))), "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            counts, removed, kept = [], [], []
            for text, starts, lengths in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                words = (text or "").encode().split()
                counts.append(len(words))
                if starts:
                    marks = np.zeros(len(words) + 1, np.int64)
                    np.add.at(marks, starts, 1)
                    np.add.at(marks, np.add(starts, lengths), -1)
                    drop = np.cumsum(marks[:-1]) > 0
                    words = [w for w, d in zip(words, drop.tolist(), strict=True) if not d]
                removed.append(counts[-1] - len(words))
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string()),
            ], names=["doc_id", "n_words", "n_removed", "kept"])

    return joined.select("doc_id", "text", "starts", "lengths").mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept string")
