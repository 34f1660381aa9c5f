"""Packing by cutting-stock column generation.

Every document is encoded once; what exceeds the sequence length is cut into full sequences, and the
rest falls into a class of lengths. The driver sees only the histogram of classes (at most
``length / grain`` numbers): a linear program over patterns is solved by column generation, where a
knapsack by dynamic programming prices new patterns; rounded patterns and a best-fit packing of what
rounding leaves give every class ranges of ranks, and Spark assigns the ranked documents to them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.common import steps, stored
from tradewind.llm.tokens import STEP, WordEncoder, encoder, tokenizer_path

PIECES = """doc_id long, start long, length long, ids_crc32 long, doc_tokens long, class int, part int,
local_rank long, ids binary"""
#: Class of pieces that fill a sequence alone.
FULL = 0


@dataclass(frozen=True)
class Pattern:
    """``times`` sequences, each with ``counts[i]`` pieces of class ``i + 1``."""

    times: int
    counts: dict[int, int]


def price(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable filling of ``capacity`` by any number of items each; sizes ascend."""
    best = np.zeros(capacity + 1)
    taken = np.full(capacity + 1, -1)
    fitting = np.searchsorted(sizes, np.arange(capacity + 1), "right")
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        n = fitting[room]
        if n:
            offers = best[room - sizes[:n]] + values[:n]
            i = int(offers.argmax())
            if offers[i] > best[room]:
                best[room], taken[room] = offers[i], i
    column, room = np.zeros(len(sizes)), capacity
    while room:
        if taken[room] < 0:
            room -= 1
        else:
            column[taken[room]] += 1
            room -= sizes[taken[room]]
    return float(best[capacity]), column


def solve(sizes: np.ndarray, demand: np.ndarray, capacity: int, gap: float = 3e-3) -> list[tuple[np.ndarray, float]]:
    """Patterns and how often to use each, within ``gap`` of the linear program's least number of sequences."""
    n = len(sizes)
    columns = np.diag(capacity // sizes).astype(float)
    inverse = np.diag(1.0 / (capacity // sizes))
    use = demand * np.diag(inverse)
    for _ in range(24 * n + 100):  # enough for any histogram seen; fewer rounds cost padding only
        duals = inverse.sum(axis=0)
        value, column = price(duals, sizes, capacity)
        if value <= 1 + gap:  # the optimum is at least the present number divided by value
            break
        step = inverse @ column
        rising = step > 1e-9
        if not rising.any():
            break
        ratio = np.where(rising, use / np.where(rising, step, 1), np.inf)
        leaves = int(ratio.argmin())
        amount = ratio[leaves]
        use = np.maximum(use - amount * step, 0)
        use[leaves] = amount
        columns[:, leaves] = column
        pivot = inverse[leaves] / step[leaves]
        inverse -= np.outer(step, pivot)
        inverse[leaves] = pivot
    return [(columns[:, i], use[i]) for i in range(n)]


def best_fit(sizes: np.ndarray, left: np.ndarray, capacity: int) -> list[dict[int, int]]:
    """Sequences for what rounding left over, longest pieces first, each where least room remains."""
    rooms, fills = np.zeros(0, np.int64), []
    for i in np.argsort(-sizes, kind="stable").tolist():
        size, rest = int(sizes[i]), int(left[i])
        for b in np.argsort(rooms, kind="stable").tolist():
            if not rest:
                break
            k = min(rest, int(rooms[b]) // size)
            if k:
                fills[b][i] = fills[b].get(i, 0) + k
                rooms[b] -= k * size
                rest -= k
        while rest:
            k = min(rest, capacity // size)
            fills.append({i: k})
            rooms = np.append(rooms, capacity - k * size)
            rest -= k
    return fills


def cut_stock(histogram: dict[int, int], grain: int, length: int) -> list[Pattern]:
    """Patterns that together hold every piece of the histogram exactly once."""
    classes = np.array(sorted(c for c, n in histogram.items() if c != FULL and n), np.int64)
    if not len(classes):
        return []
    capacity = length // grain
    demand = np.array([histogram[c] for c in classes.tolist()], np.int64)
    left, patterns = demand.copy(), []
    for column, use in sorted(solve(classes, demand.astype(float), capacity), key=lambda x: -x[1]):
        counts = column.astype(np.int64)
        held = counts > 0
        times = int(min(np.floor(use + 1e-6), (left[held] // counts[held]).min()))
        if times > 0:
            left -= times * counts
            patterns.append(Pattern(times, {int(classes[i]): int(counts[i]) for i in np.flatnonzero(held)}))
    patterns += [Pattern(1, {int(classes[i]): k for i, k in fill.items()}) for fill in best_fit(classes, left, capacity)]
    return patterns


def encode_pieces(docs: DataFrame, length: int, grain: int, end_id: int, tokenizer: str | None) -> DataFrame:
    """Every document's pieces with their ids, class and rank among the class's pieces of the same task."""
    path = tokenizer or tokenizer_path()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with encoder(path) as words:
            yield from placed(batches, words)

    def placed(batches: Iterator[pa.RecordBatch], words: WordEncoder) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        width = "<u2" if words.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        ranks = np.zeros(length // grain + 1, np.int64).tolist()
        end = np.array([end_id], "<u4").tobytes()
        for batch in steps(batches, size=STEP):
            rows = []
            for doc_id, raw in zip(batch.column(0).to_pylist(), words.encode(batch.column(1)), strict=True):
                raw += end
                total = len(raw) // 4
                for start in range(0, total, length):
                    piece = raw[4 * start : 4 * (start + length)]
                    n = len(piece) // 4
                    kind = FULL if n == length else -(-n // grain)
                    ids = np.frombuffer(piece, "<u4").astype(width).tobytes()
                    rows.append((doc_id, start, n, zlib.crc32(piece), total, kind, part, ranks[kind], ids))
                    ranks[kind] += 1
            types = (pa.int64(),) * 5 + (pa.int32(),) * 2 + (pa.int64(), pa.binary())
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "class", "part", "local_rank", "ids"]
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(encode, PIECES)


def pack(
    docs: DataFrame, length: int = 2048, grain: int = 8, end_id: int = 1, tokenizer: str | None = None,
    keep_ids: bool = True,
) -> DataFrame:
    """Places of all pieces: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` and ``ids``.

    Uses ``doc_id`` and ``text`` alone, so other columns may have any name. A null or empty text is the
    end id alone; repeated rows and rows without ``doc_id`` are packed each on its own; an empty table
    gives no rows. ``grain`` is the width of a class of lengths: each piece counts as up to ``grain - 1``
    tokens more than it has. Two runs over the same files give the same places.
    """
    pieces = stored(encode_pieces(docs, length, grain, end_id, tokenizer), "pieces")
    counts = pieces.groupBy("part", "class").agg(F.count(F.lit(1)).alias("n"))
    # One row per task and class: the first rank of a task's pieces in their class.
    earlier = Window.partitionBy("class").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = stored(counts.withColumn("first", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "ranks")
    histogram = {r["class"]: r["n"] for r in firsts.groupBy("class").agg(F.sum("n").alias("n")).collect()}
    patterns = cut_stock(histogram, grain, length)
    ranges: dict[int, list[tuple[int, int, int]]] = {}
    used, next_rank = 0, dict.fromkeys(histogram, 0)
    for pattern in patterns:
        for kind, each in pattern.counts.items():
            ranges.setdefault(kind, []).append((next_rank[kind], each, used))
            next_rank[kind] += each * pattern.times
        used += pattern.times
    table = {kind: tuple(np.array(x, np.int64) for x in zip(*rows, strict=True)) for kind, rows in ranges.items()}
    table[FULL] = (np.zeros(1, np.int64), np.ones(1, np.int64), np.array([used]))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = batch.column(batch.schema.get_field_index("class")).to_numpy(zero_copy_only=False)
            ranks = batch.column(batch.schema.get_field_index("rank")).to_numpy(zero_copy_only=False)
            sequences, places = np.zeros(len(kinds), np.int64), np.zeros(len(kinds), np.int64)
            for kind in np.unique(kinds).tolist():
                rows = np.flatnonzero(kinds == kind)
                lows, each, bases = table[kind]
                at = np.searchsorted(lows, ranks[rows], "right") - 1
                past = ranks[rows] - lows[at]
                sequences[rows] = bases[at] + past // each[at]
                places[rows] = past % each[at]
            yield batch.append_column("sequence_id", pa.array(sequences)).append_column("place", pa.array(places))

    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *(["ids"] if keep_ids else [])]
    ranked = pieces.select(*columns, "class", "part", "local_rank").join(firsts.drop("n"), ["part", "class"]).select(
        *columns, "class", (F.col("first") + F.col("local_rank")).alias("rank")
    )
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema)
    placed = ranked.mapInArrow(assign, f"{schema}, sequence_id long, place long")
    # At most ``length`` pieces per sequence.
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("class"), "place").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(inside), F.lit(0)).cast("long")
    return placed.withColumn("offset", offset).drop("class", "rank", "place")


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence: its ids as stored, and its length without padding."""
    pieces = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"), F.concat(F.lit(b""), F.aggregate(
            pieces, F.lit(b""), lambda raw, piece: F.concat(raw, piece["ids"])
        )).alias("ids"),
    )
