"""Tables of hashed keys in shards: equal ranges of the keys, of which a task holds one at a time.

What one task sends another of a shard is one row of packed numbers, not a row per key. The number of shards
follows the number of keys, so that a shard stays as small however large the table is.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.bitmap import bitmap, held
from tradewind.llm.common import freed_shuffles, read_all, steps, stored

#: Keys of a shard.
SHARD_KEYS = 1 << 20
#: Keys that a task gathers before it sends them.
GATHERED = 1 << 21
#: Texts are looked up in so many parts one after the other, each of which frees its shuffles.
TEXT_PARTS = 3


def shards_of(n: int) -> int:
    return -(-max(n, 1) // SHARD_KEYS)


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each key; it grows with the key."""
    return ((keys.view(np.uint64) >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


def packed(numbers: np.ndarray) -> bytes:
    """Numbers byte by byte, all lowest bytes first: high bytes are zeros that the codec of a shuffle takes away."""
    return np.ascontiguousarray(numbers.view(np.uint8).reshape(len(numbers), numbers.itemsize).T).tobytes()


def unpacked(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def ascending(keys: np.ndarray) -> bytes:
    """Ascending keys by their differences."""
    return packed(np.diff(keys.view(np.uint64), prepend=np.uint64(0)))


def from_ascending(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data, np.uint64), dtype=np.uint64)


def whole(numbers: np.ndarray) -> bytes:
    """Signed numbers, small ones of either sign with high bytes of zero."""
    return packed((numbers << 1) ^ (numbers >> 63))


def from_whole(data: bytes) -> np.ndarray:
    numbers = unpacked(data, np.int64)
    return (numbers >> 1 & np.int64((1 << 63) - 1)) ^ -(numbers & 1)


def runs(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs in any column from the row before."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


#: What is sent: parts of the table and the keys that texts ask for, by shard, and the texts themselves, by block.
SENT = {"shard": "int", "kind": "int", "block": "long"} | dict.fromkeys(
    ("keys", "parts", "texts", "text", "times", "rows", "known", "n"), "binary")
TABLE, ASKED, TEXTS = 0, 1, 2
ANSWER = ["block", "rows", "known", "n", "text", "parts"]


def row(**values: object) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([values.get(c)], kinds[t]) for c, t in SENT.items()], names=list(SENT))


def table_rows(table: DataFrame, shards: int) -> DataFrame:
    """The shards of ``table`` (key, parts), each in several rows."""

    def cut(keys: np.ndarray, parts: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.argsort(keys.view(np.uint64))
        keys, parts = keys[order], parts[order]
        of = shard_of(keys, shards)
        at = runs(of)
        for first, last in zip(at, np.append(at[1:], len(keys)), strict=True):
            yield row(shard=int(of[first]), kind=TABLE, keys=ascending(keys[first:last]), parts=whole(parts[first:last]))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, n = [], 0
        for batch in batches:
            gathered.append([np.asarray(batch.column(c)) for c in (0, 1)])
            n += batch.num_rows
            if n >= GATHERED:
                yield from cut(*map(np.concatenate, zip(*gathered, strict=True)))
                gathered, n = [], 0
        if n:
            yield from cut(*map(np.concatenate, zip(*gathered, strict=True)))

    return table.select("key", "parts").mapInArrow(send, ", ".join(f"{c} {t}" for c, t in SENT.items()))


def asked_rows(texts: DataFrame, keys_of: Callable, known: Callable, listed: Broadcast, shards: int) -> DataFrame:
    """Blocks of rows of ``texts``, and for each shard the keys of it that a block has, of those in the filter ``listed`` that ``known``
    doesn't know. A block is numbered by its task's part of the input, so that a repeated task gives the same ones."""

    def cut(block: int, rows: list, total: list, n: list, asked: list) -> Iterator[pa.RecordBatch]:
        yield row(shard=block % shards, kind=TEXTS, block=block, rows=in_bytes(rows), known=whole(np.concatenate(total)), n=packed(np.concatenate(n)))
        keys, text, times = map(np.concatenate, zip(*asked, strict=True))
        order = np.argsort(keys, kind="stable")  # a key's texts go on ascending
        keys, text, times = keys[order], text[order], times[order]
        borders = np.searchsorted(shard_of(keys, shards), np.arange(shards + 1, dtype=np.uint64))
        for shard, (first, last) in enumerate(zip(borders[:-1], borders[1:], strict=True)):
            at = runs(keys[first:last])
            if len(at):
                yield row(
                    shard=shard, kind=ASKED, block=block, keys=ascending(keys[first:last][at]),
                    texts=packed(np.diff(np.append(at, last - first)).astype(np.uint32)),
                    text=packed(text[first:last].astype(np.uint32)), times=packed(times[first:last].astype(np.uint32)))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, n_texts, n_keys = TaskContext.get().partitionId() << 32, 0, 0
        gathered: tuple[list, ...] = ([], [], [], [])
        for batch in steps(batches):
            at_text = batch.schema.get_field_index("text")
            keys, rows, n = keys_of(batch.column(at_text))
            order = np.argsort(keys, kind="stable")
            keys, rows = keys[order], rows[order]
            at = runs(keys)
            here, parts = known(keys[at])
            times = np.diff(np.append(at, len(keys)))
            total = np.bincount(rows, np.repeat(parts, times), batch.num_rows).astype(np.int64)
            more = np.repeat(~here & held(listed.value, keys[at].view(np.int64)), times)
            keys, rows = keys[more], rows[more]
            at = runs(keys, rows)
            asked = (keys[at], rows[at] + n_texts, np.diff(np.append(at, len(keys))))
            for to, x in zip(gathered, (batch.remove_column(at_text), total, n, asked), strict=True):
                to.append(x)
            n_texts, n_keys = n_texts + batch.num_rows, n_keys + len(at)
            if max(n_keys, n_texts) >= GATHERED:
                yield from cut(block, *gathered)
                block, n_texts, n_keys, gathered = block + 1, 0, 0, ([], [], [], [])
        if n_texts:
            yield from cut(block, *gathered)

    return texts.mapInArrow(send, ", ".join(f"{c} {t}" for c, t in SENT.items()))


def in_bytes(batches: list[pa.RecordBatch]) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batches[0].schema) as stream:
        for batch in batches:
            stream.write_batch(batch)
    return out.getvalue().to_pybytes()


def answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the keys of each shard add to the texts of the blocks that ask for them; rows come shard by shard, first its table."""
    shard, gathered, table = None, [], None
    for batch in batches:
        for i in range(batch.num_rows):
            r = {c: batch.column(k)[i].as_py() for k, c in enumerate(SENT)}
            if r["shard"] != shard:
                shard, gathered, table = r["shard"], [], None
            if r["kind"] == TABLE:
                gathered.append((from_ascending(r["keys"]), from_whole(r["parts"])))
                continue
            if r["kind"] == ASKED:
                if table is None:
                    keys, parts = map(np.concatenate, zip((np.zeros(0, np.uint64), np.zeros(0, np.int64)), *gathered, strict=True))
                    order = np.argsort(keys)
                    table, gathered = (keys[order], parts[order]), []
                _, parts = looked_up(*table, from_ascending(r["keys"]))
                text = unpacked(r["text"], np.uint32)
                given = np.bincount(text, np.repeat(parts, unpacked(r["texts"], np.uint32)) * unpacked(r["times"], np.uint32))
                at = np.flatnonzero(given)
                r |= {"text": packed(at.astype(np.uint32)), "parts": whole(given[at].astype(np.int64))}
            kinds = [pa.int64(), *[pa.binary()] * (len(ANSWER) - 1)]
            yield pa.RecordBatch.from_arrays([pa.array([r[c]], t) for c, t in zip(ANSWER, kinds, strict=True)], names=ANSWER)


def met(table: pa.Table) -> pa.Table:
    """The rows of a block with their sums and numbers of words."""
    more = []
    for r in table.to_pylist():
        if r["rows"] is not None:
            rows = pa.ipc.open_stream(r["rows"]).read_all()
            total, n = from_whole(r["known"]), unpacked(r["n"], np.int64)
        else:
            more.append((unpacked(r["text"], np.uint32), from_whole(r["parts"])))
    for text, parts in more:
        total[text] += parts
    return rows.append_column("parts", pa.array(total)).append_column("n", pa.array(n))


def looked_up(keys: np.ndarray, parts: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the keys ``wanted`` the sorted ``keys`` have, and their parts, 0 for others."""
    if not len(keys):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    here = keys[at] == wanted
    return here, np.where(here, parts[at], 0)


def sums(texts: DataFrame, keys_of: Callable, known: Callable, table: DataFrame) -> DataFrame:
    """``texts`` with ``parts`` and ``n`` in place of ``text``: the sum over a text's keys, repeats included, of those that ``known`` knows
    and those of ``table`` (key, parts), and the number of its words.

    ``keys_of`` gives a column's keys, their rows and each row's number of words, ``known`` which keys it knows and their
    parts. Parts are whole numbers, so that sums don't depend on the order of the rows.
    """
    with freed_shuffles(table.sparkSession):
        shards, listed = shards_of(table.count()), bitmap(table, "key")
    names = texts.drop("text").columns
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in texts.drop("text").schema)
    found = []
    for part in range(TEXT_PARTS):
        mine = texts.filter(F.pmod(F.xxhash64(*names), F.lit(TEXT_PARTS)) == part)
        sent = table_rows(table, shards).unionByName(asked_rows(mine, keys_of, known, listed, shards))
        dealt = sent.repartition(shards, "shard").sortWithinPartitions("shard", "kind")
        answered = dealt.mapInArrow(answers, ", ".join(f"{c} {SENT[c]}" for c in ANSWER))
        found.append(stored(answered.groupBy("block").applyInArrow(met, f"{kept}, parts long, n long"), "sums"))
    return read_all(found)
