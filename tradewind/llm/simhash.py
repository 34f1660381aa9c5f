"""Near duplicates by SimHash, with pivot distance tables.

A text's fingerprint is the bitwise majority of the hashes of its word shingles. Equal fingerprints become one
node. Two nodes that differ in at most ``bits`` bits agree on three of ``bits + 3`` segments, so every
choice of three segments deals the nodes into bands. In a band, the Hamming distances of its members to many
reference fingerprints are tabulated once; by the triangle inequality a pair whose tables differ by more than
``bits`` anywhere is discarded, and what survives is verified. A band gives a spanning star of what it links,
so its output is never longer than the band.

A band with more than ``dense`` members is not paired at all: its members meet at half-way fingerprints. Two that
differ in at most ``bits`` bits both lie within half as many of some third one, and all that lie that near to one
are mutually linked, so the work is in proportion to the members, whatever their similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import discard, steps, stored
from tradewind.llm.links import components
from tradewind.llm.words import mixed

SEED = 42
#: Shingles whose bits are counted at once.
COUNTED = 1 << 17
#: Reference fingerprints: bit patterns about 32 bits apart from each other.
PIVOTS = mixed(np.arange(1, 25, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
#: Members of a band from which on half-way fingerprints (2081 a member at four bits) cost less than pairs.
DENSE = 256
#: Rows of a band table that one step of a task holds, beyond the band that is being read.
HELD = 1 << 16


def hashes(text: str | None, size: int) -> np.ndarray:
    """XXH64 of every shingle of a text, repeats included; none without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: max(len(words) - size + 1, 1)]
    one = xxhash.xxh64_intdigest
    found = (one(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends[min(size, len(words)) - 1 :].tolist(), strict=True))
    return np.fromiter(found, np.uint64, len(starts))


def fingerprint(h: np.ndarray) -> int:
    """Bits that more than half of the hashes have."""
    counts = np.zeros(64, np.int64)
    for first in range(0, len(h), COUNTED):
        part = h[first : first + COUNTED]
        counts += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = 5) -> DataFrame:
    """Per row: ``doc_id, fp``, the fingerprint as a signed long; 0 for a text without words (or null).

    Words stand between ASCII white space, A-Z in lower case; fewer than ``size`` make one shingle.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            found = np.array([fingerprint(hashes(t, size)) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    return rows.mapInArrow(compute, "doc_id long, fp long")


def segments(n: int) -> list[int]:
    """Masks of ``n`` runs of bits that make up 64."""
    borders = [64 * i // n for i in range(n + 1)]
    return [(1 << b) - (1 << a) for a, b in zip(borders[:-1], borders[1:], strict=True)]


def banded(nodes: DataFrame, bits: int) -> DataFrame:
    """``band, key, fp``: each node under every choice of three segments."""
    masks = np.array([sum(three) for three in combinations(segments(bits + 3), 3)], np.uint64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            for first in range(0, len(fps), HELD // len(masks)):
                part = fps[first : first + HELD // len(masks)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.tile(np.arange(len(masks), dtype=np.int32), len(part))),
                    pa.array((part[:, None] & masks[None, :]).ravel().view(np.int64)),
                    pa.array(np.repeat(part, len(masks)).view(np.int64)),
                ], names=["band", "key", "fp"])

    return nodes.select("fp").mapInArrow(deal, "band int, key long, fp long")


def linked(fps: np.ndarray, band: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among members of the same band: each linked member with the first one it reaches.

    ``band`` numbers the bands in order, so members of one stand together.
    """
    table = np.bitwise_count(fps[:, None] ^ PIVOTS[None, :]).astype(np.int8)
    lefts, rights = [], []
    left = np.arange(len(fps) - 1)
    step = 1
    while len(left := left[left + step < len(fps)]):
        left = left[band[left] == band[left + step]]
        near = left
        for pivot in range(len(PIVOTS)):
            near = near[np.abs(table[near, pivot] - table[near + step, pivot]) <= bits]
        near = near[np.bitwise_count(fps[near] ^ fps[near + step]) <= bits]
        lefts.append(near)
        rights.append(near + step)
        step += 1
    a, b = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (lefts, rights))
    root = np.arange(len(fps))
    while True:
        least = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, least)
        np.minimum.at(root, b, least)
        root = root[root]
        if (root == before).all():
            break
    member = np.flatnonzero(root != np.arange(len(fps)))
    return fps[member], fps[root[member]]


def band_links(nodes: DataFrame, bits: int, dense: int) -> DataFrame:
    """``a, b``: links found in bands; ``b`` is null for members of bands with more than ``dense``."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(a: np.ndarray, b: np.ndarray | None) -> pa.RecordBatch:
            other = pa.nulls(len(a), pa.int64()) if b is None else pa.array(b.view(np.int64))
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), other], names=["a", "b"])

        def solve(keys: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
            """Whole bands; the first one may be one whose beginning has been given as dense already."""
            starts = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)])) if len(keys) else np.zeros(0, np.int64)
            sizes = np.diff(np.append(starts, len(keys)))
            number = np.repeat(np.arange(len(sizes)), sizes)
            big = sizes > dense
            if len(keys) and open_key is not None and (keys[0] == open_key).all():
                big[0] = True
            if big.any():
                yield rows(fps[big[number]], None)
            some = (sizes > 1) & ~big
            kept = some[number]
            if kept.any():
                yield rows(*linked(fps[kept], number[kept], bits))

        keys, fps = np.zeros((0, 2), np.int64), np.zeros(0, np.uint64)
        open_key = None  # key of a band that has been found dense before its end
        for batch in batches:
            new = np.stack([batch.column(0).to_numpy().astype(np.int64), batch.column(1).to_numpy()], axis=1)
            keys, fps = np.concatenate([keys, new]), np.concatenate([fps, batch.column(2).to_numpy().view(np.uint64)])
            if len(keys) < HELD:
                continue
            differ = np.flatnonzero((keys != keys[-1]).any(axis=1))
            cut = int(differ[-1]) + 1 if len(differ) else 0
            yield from solve(keys[:cut], fps[:cut])
            last = keys[-1]
            keys, fps = keys[cut:], fps[cut:]
            if len(keys) > dense:
                yield rows(fps, None)
                open_key, keys, fps = last, keys[:0], fps[:0]
        yield from solve(keys, fps)

    dealt = banded(nodes, bits).repartition("band", "key").sortWithinPartitions("band", "key")
    return dealt.mapInArrow(scan, "a long, b long").distinct()


def half_way_links(nodes: DataFrame, bits: int) -> DataFrame:
    """``a, b``: links enough to connect all ``fp`` of ``nodes`` that differ in at most ``bits`` bits (an even number)."""
    flips = np.array([sum(1 << i for i in some) for k in range(bits // 2 + 1) for some in combinations(range(64), k)], np.uint64)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for fp in batch.column(0).to_numpy().view(np.uint64):
                yield pa.RecordBatch.from_arrays([
                    pa.array((flips ^ fp).view(np.int64)), pa.array(np.full(len(flips), fp).view(np.int64)),
                ], names=["middle", "fp"])

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        middle, fps = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            middle, fps = np.append(middle[-1:], batch.column(0).to_numpy()), np.append(fps[-1:], batch.column(1).to_numpy())
            same = np.flatnonzero(middle[1:] == middle[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(fps[same + 1]), pa.array(fps[same])], names=["a", "b"])

    met = nodes.select("fp").mapInArrow(spread, "middle long, fp long").repartition("middle").sortWithinPartitions("middle", "fp")
    return met.mapInArrow(chain, "a long, b long").distinct()


def simhash_duplicates(docs: DataFrame, size: int = 5, bits: int = 4, dense: int = DENSE) -> DataFrame:
    """Per row: ``doc_id, fp, component_id``, the smallest doc_id that links of at most ``bits`` (an even number) bits reach.

    Uses ``doc_id`` and ``text`` alone, so other columns may have any name. Null, empty and blank texts have
    fingerprint 0 and are linked like any other. Repeated rows are each given; rows without ``doc_id`` link
    others, and have component null if none linked has an id. An empty table gives no rows.
    """
    rows = stored(fingerprints(docs, size), "simhash")
    nodes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-nodes")
    found = stored(band_links(nodes, bits, dense), "simhash-bands")
    crowded = stored(found.filter("b is null").select(F.col("a").alias("fp")).distinct(), "simhash-dense")
    links = stored(found.filter("b is not null").union(half_way_links(crowded, bits)), "simhash-links")
    discard(found, crowded)
    rooted = stored(components(links), "simhash-roots")
    named = nodes.join(rooted, nodes["fp"] == rooted["node"], "left").select("fp", "first_id", "root")
    least = named.filter("root is not null").groupBy("root").agg(F.min("first_id").alias("least_id"))
    places = stored(
        named.join(least, "root", "left").select(F.col("fp").alias("of"), F.when(F.col("root").isNull(), F.col("first_id")).otherwise(F.col("least_id")).alias("component_id")),
        "simhash-places",
    )
    discard(nodes, links, rooted)
    return rows.join(places, rows["fp"] == places["of"]).select("doc_id", "fp", "component_id")
