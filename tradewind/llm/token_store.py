"""Token-ID output: raw id payloads in shard files with a minimal perfect hash index.

A shard file holds, one after another: a fixed header, the payload (token ids of its documents as
little-endian unsigned integers of the smallest width that holds the vocabulary), the sorted keys, where
each document starts, the levels of the perfect hash, and per slot a fingerprint and the document's
number. A lookup hashes the key to a slot, compares the stored fingerprint and seeks to the ids.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradewind.llm.common import steps, stored, work_path
from tradewind.llm.tokens import STEP, WordEncoder, encoder, tokenizer_path

MAGIC = b"TWIDS\x00\x00\x01"
#: magic, bytes per id, documents, distinct keys, ids, levels, bits in all levels.
HEADER = struct.Struct("<8sQQQQQQ")
#: Bits per key in each level of the perfect hash.
SPREAD = 2
MAX_LEVELS = 64
#: Payload bytes after which a task begins another shard.
SHARD_BYTES = 64 << 20
#: The key that stands for a null one.
NULL_KEY = -(1 << 63)

SCHEMA = "part int, seq int, file string, n_docs long, n_ids long, min_key long, max_key long"
READ_SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary"


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """64 well-mixed bits per key and seed."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.int64).view(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Maps n distinct keys to 0..n-1: a key sits in the first level where no other key shares its bit."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray) -> None:
        self.sizes, self.bits = sizes, bits  # bits: one byte each, level after level
        self.starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        self.ranks = np.concatenate([[0], np.cumsum(bits, dtype=np.int64)])

    @classmethod
    def build(cls, keys: np.ndarray) -> "PerfectHash":
        sizes, levels, rest = [], [], keys
        while len(rest):
            if len(sizes) == MAX_LEVELS:
                raise ValueError("keys are not distinct")
            size = max(len(rest) * SPREAD, 8)
            places = (mix(rest, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(places, minlength=size) == 1
            sizes.append(size)
            levels.append(alone.astype(np.uint8))
            rest = rest[~alone[places]]
        return cls(np.array(sizes, np.int64), np.concatenate(levels) if levels else np.zeros(0, np.uint8))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 where no level has its bit."""
        found = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            places = self.starts[level] + (mix(keys[left], level) % np.uint64(size)).astype(np.int64)
            here = self.bits[places] == 1
            found[left[here]] = self.ranks[places[here]]
            left = left[~here]
        return found


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mix(keys, 1 << 20) >> np.uint64(32)).astype("<u4")


class Shard:
    """One shard file, read back."""

    def __init__(self, raw: bytes) -> None:
        magic, self.width, self.n_docs, n_keys, self.n_ids, n_levels, n_bits = HEADER.unpack_from(raw)
        if magic != MAGIC:
            raise ValueError("not a shard of token ids")
        at = HEADER.size
        self.ids = np.frombuffer(raw, f"<u{self.width}", self.n_ids, at)
        at += self.n_ids * self.width
        self.keys = np.frombuffer(raw, "<i8", self.n_docs, at)
        self.starts = np.frombuffer(raw, "<i8", self.n_docs + 1, at + 8 * self.n_docs)
        at += 16 * self.n_docs + 8
        sizes = np.frombuffer(raw, "<i8", n_levels, at)
        at += 8 * n_levels
        packed = np.frombuffer(raw, np.uint8, -(-n_bits // 8), at)
        self.hash = PerfectHash(sizes, np.unpackbits(packed, count=n_bits))
        at += len(packed)
        self.marks = np.frombuffer(raw, "<u4", n_keys, at)
        self.numbers = np.frombuffer(raw, "<u4", n_keys, at + 4 * n_keys)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Number of the first document with each key, -1 where the shard has none."""
        slots = self.hash.slots(keys)
        held = slots >= 0
        held[held] = self.marks[slots[held]] == fingerprint(keys[held])
        found = np.full(len(keys), -1, np.int64)
        found[held] = self.numbers[slots[held]]
        return found

    def document(self, number: int) -> np.ndarray:
        return self.ids[self.starts[number] : self.starts[number + 1]]


def shard_bytes(keys: np.ndarray, ids: list[np.ndarray], width: int) -> bytes:
    """The whole file of documents with ascending ``keys``; equal keys stand together, the index names the first."""
    distinct, first = np.unique(keys, return_index=True)
    hashed = PerfectHash.build(distinct)
    slots = hashed.slots(distinct)
    marks, numbers = np.zeros(len(distinct), "<u4"), np.zeros(len(distinct), "<u4")
    marks[slots], numbers[slots] = fingerprint(distinct), first
    starts = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype("<i8")
    head = HEADER.pack(MAGIC, width, len(keys), len(distinct), int(starts[-1]), len(hashed.sizes), len(hashed.bits))
    payload = [x.astype(f"<u{width}").tobytes() for x in ids]
    index = [keys.astype("<i8"), starts, hashed.sizes.astype("<i8"), np.packbits(hashed.bits), marks, numbers]
    return b"".join([head, *payload, *(x.tobytes() for x in index)])


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def write_store(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = 0) -> DataFrame:
    """Encode ``docs`` in ascending ``doc_id`` order into shard files under ``folder``; returns the manifest.

    Uses ``doc_id`` and ``text`` alone, so other columns may have any name. A null or empty text is the
    end id alone. Rows without ``doc_id`` come first. Rows that share a ``doc_id`` are all stored, ordered
    by a hash of their text, and a lookup gives the first. An empty table has an empty manifest.
    Each attempt of a task writes files of its own; the manifest, saved by Spark's committer, names
    those that count, so a lost executor or a second attempt leaves no wrong file in force.
    """
    path = tokenizer or tokenizer_path()
    ordered = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), F.xxhash64("text").alias("tie")
    ).repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with encoder(path) as words:
            yield from written(batches, words)

    def written(batches: Iterator[pa.RecordBatch], words: WordEncoder) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        width = 2 if words.tokenizer.get_vocab_size() <= 1 << 16 else 4
        store, base = open_folder(folder)
        store.create_dir(base, recursive=True)
        keys: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        held, seq = 0, 0
        end = np.array([end_id], "<u4")

        def flush() -> dict:
            every = np.concatenate(keys)
            name = f"part-{part:05d}-{seq:04d}-{uuid.uuid4().hex}.ids"
            with store.open_output_stream(f"{base}/{name}") as out:
                out.write(shard_bytes(every, ids, width))
            return {
                "part": part, "seq": seq, "file": name, "n_docs": len(every), "n_ids": sum(map(len, ids)),
                "min_key": int(every[0]), "max_key": int(every[-1]),
            }

        rows = []
        for batch in steps(batches, size=STEP):
            keys.append(batch.column(0).fill_null(NULL_KEY).to_numpy(zero_copy_only=False).astype(np.int64))
            for raw in words.encode(batch.column(1)):
                ids.append(np.concatenate([np.frombuffer(raw, "<u4"), end]).astype(f"<u{width}"))
                held += len(ids[-1]) * width
            if held >= SHARD_BYTES:
                rows.append(flush())
                keys, ids, held, seq = [], [], 0, seq + 1
        if keys:
            rows.append(flush())
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([
            ("part", pa.int32()), ("seq", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()),
            ("n_ids", pa.int64()), ("min_key", pa.int64()), ("max_key", pa.int64()),
        ]))

    return stored(ordered.mapInArrow(write, SCHEMA), "manifest")


def read_store(manifest: DataFrame, folder: str, with_ids: bool = True) -> DataFrame:
    """Every document of the files that ``manifest`` names, found through their index, with its ids."""
    shards = max(manifest.count(), 1)
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)  # a row per shard
    placed = manifest.select("file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_folder(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_stream(f"{root}/{row['file']}") as source:
                    shard = Shard(source.read())
                numbers = shard.find(shard.keys)
                repeats = np.arange(shard.n_docs) - np.searchsorted(shard.keys, shard.keys)
                for some in np.array_split(numbers + repeats, max(1, int(shard.n_ids) // 500_000)):
                    raw = [shard.document(n) for n in some.tolist()]
                    crc = [zlib.crc32(x.astype("<u4").tobytes()) for x in raw]
                    keys = shard.keys[some]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(keys, pa.int64(), mask=keys == NULL_KEY),
                        pa.array(shard.starts[some] + row["base"], pa.int64()),
                        pa.array(shard.starts[some + 1] - shard.starts[some], pa.int64()),
                        pa.array(crc, pa.int64()),
                        pa.array([x.tobytes() if with_ids else None for x in raw], pa.binary()),
                    ], names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"])

    return placed.repartition(shards).mapInArrow(read, READ_SCHEMA)


def lookup(manifest: DataFrame, folder: str, doc_id: int) -> list[int] | None:
    """Ids of one document: its shard by the manifest's key ranges, its place by the shard's index."""
    near = manifest.filter((F.col("min_key") <= doc_id) & (F.col("max_key") >= doc_id)).orderBy("part", "seq")
    store, root = open_folder(folder)
    for row in near.toLocalIterator():
        with store.open_input_stream(f"{root}/{row['file']}") as source:
            shard = Shard(source.read())
        (number,) = shard.find(np.array([doc_id]))
        if number >= 0 and shard.keys[number] == doc_id:
            return shard.document(int(number)).tolist()
    return None


def token_store(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Write ``docs`` to a new folder of the shared place and read it back."""
    folder = work_path(spark, "ids")
    return read_store(write_store(docs, folder), folder, with_ids=False)
