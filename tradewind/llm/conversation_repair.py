"""Repair of conversation structure as a lightest derivation.

What is proved is an item (rows, state): the last ``rows`` rows of a conversation can be edited so that, read from
``state``, they end well. An edit of the row before, or an inserted one, deduces an item from an item. Every
deduction adds to the cost and puts its initial before the audit, so a lighter premise never gives a
heavier conclusion; and it adds a row or a cost, so no conclusion is popped before its premise. The
agenda hence finalises each item with its lightest (cost, audit) and stops at the goal.

Rows are sorted over all tasks, and a conversation that lies whole within a task and is not very long is solved there.
The others, cut by a border between tasks or longer than ``LONG``, are dealt into blocks. A block is solved from
every state to every state; blocks are chained in order, which is exact, since of two audits of the same rows and the same cost
neither begins the other.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from heapq import heappop, heappush
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.common import discard, stored

#: States: nothing yet, after a system row, after a user row, after an assistant row. Where each letter leads.
STEPS = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: States a conversation may end in.
ENDS = (0, 3)
INTO = [[(p, letter) for p in range(4) for letter, to in STEPS[p].items() if to == q] for q in range(4)]
FULL = {"u": "user", "a": "assistant"}
RETYPE, DELETE, INSERT, UNFINISHED = 1, 2, 5, 5
WHITE = " \t\n\v\f\r"
#: Rows and characters from which on a conversation is dealt into blocks, and rows of a block.
LONG, LONG_CHARS, BLOCK, BLOCK_CHARS = 1024, 4 << 20, 256, 1 << 20
NO_TEXT = sha256(b"").hexdigest()
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long"
RESULT = f"{COUNTS}, cost long, audit string, repaired_sha256 string"

Item = tuple[int, int]
Weight = tuple[int, str]


def derive(rows: str, ends: tuple[int, ...], goal: int | None = None) -> dict[Item, Weight]:
    """Lightest (cost, audit) of the items over ``rows``, which has two characters a row: initial and fault.

    The axioms are the empty ends in ``ends``; with a ``goal`` the agenda stops as soon as all rows from that state are proved.
    """
    total = len(rows) // 2
    agenda: list[tuple[int, int, str, int]] = [(0, 0, "", q) for q in ends]
    final: dict[Item, Weight] = {}
    while agenda:
        cost, done, audit, q = heappop(agenda)
        if (done, q) in final:
            continue
        final[done, q] = (cost, audit)
        if done == total and q == goal:
            break
        for p, letter in INTO[q]:
            if letter in FULL:
                heappush(agenda, (cost + INSERT, done, "I" + audit, p))
        if done == total:
            continue
        initial, fault = rows[2 * (total - done) - 2 : 2 * (total - done)]
        heappush(agenda, (cost + DELETE, done + 1, "D" + audit, q))
        if fault == "x":
            continue
        kept = cost + (UNFINISHED if fault == "t" else 0)
        for p, letter in INTO[q]:
            if letter == initial:
                heappush(agenda, (kept, done + 1, "K" + audit, p))
            if letter in FULL:
                heappush(agenda, (kept + RETYPE, done + 1, "R" + audit, p))
    return final


def solve(rows: str) -> Weight:
    return derive(rows, ENDS, 0)[len(rows) // 2, 0]


#: Short conversations repeat; at most 65,536 of them, of at most 32 rows, are remembered.
solve_short = lru_cache(1 << 16)(solve)


def initial_of(role: str) -> str:
    return role[:1] if role[:1] in ("s", "u", "a") else "-"


def fault_of(role: str, text: str, again: bool) -> str:
    """The first fault: ``b`` blank, ``d`` seen earlier, ``t`` truncated, else a point."""
    end = text.rstrip(WHITE)
    return "b" if not end else "d" if again else "." if end[-1] in ".!?" else "t"


def coded(roles: list[str], faults: list[str]) -> str:
    return "".join(initial_of(r) + (f if f in ".t" else "x") for r, f in zip(roles, faults, strict=True))


def illegal_pairs(initials: list[str]) -> int:
    return sum(pair not in LEGAL for pair in zip(initials[:-1], initials[1:], strict=True))


def replay(audit: str, roles: list[str], texts: list[str], state: int) -> tuple[list[str], int]:
    """The rows ``role:text`` after the edits, and the state reached."""
    lines, row = [], 0
    for edit in audit:
        if edit == "D":
            row += 1
            continue
        letter = initial_of(roles[row]) if edit == "K" else "a" if state == 2 else "u"
        role = roles[row] if edit == "K" else FULL[letter]
        lines.append(f"{role}:{'' if edit == 'I' else texts[row]}")
        row += edit != "I"
        state = STEPS[state][letter]
    return lines, state


def whole(rows: list[tuple]) -> tuple:
    """The result columns of one conversation from its rows (turn, role, text) in order."""
    if not rows:
        return 0, 0, 0, 0, 0, 0, "", NO_TEXT
    roles, texts = [r[1] for r in rows], [r[2] for r in rows]
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    seen, faults = set(), []
    for row in zip(roles, texts, strict=True):
        faults.append(fault_of(*row, row in seen))
        seen.add(row)
    code = coded(roles, faults)
    cost, audit = (solve_short if len(rows) <= 32 else solve)(code)
    lines, _ = replay(audit, roles, texts, 0)
    digest = sha256("\n".join(lines).encode()).hexdigest()
    return gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal_pairs([r[:1] for r in roles]), cost, audit, digest


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)


def batched(rows: Iterator[tuple], schema: pa.Schema, size: int = 2048) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``size`` rows or about 4 MB of strings."""
    held: list[tuple] = []
    weight = 0
    for row in rows:
        held.append(row)
        weight += sum(len(x) for x in row if isinstance(x, str)) + sum(len(y) for x in row if isinstance(x, list) for y in x if isinstance(y, str))
        if len(held) >= size or weight >= 4 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def arrow_schema(spec: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split(" ") for field in spec.split(", "))])


SOLVED = f"conv_id long, whole boolean, {RESULT}, turn long, role string, text string, present boolean"
BLOCKS = (
    "conv_id long, block long, n long, blank long, duplicate long, truncated long, illegal long, first string, last string, "
    "first_turn long, last_turn long, low long, high long, turns long, costs array<long>, audits array<string>, roles array<string>, texts array<string>"
)
PIECES = f"block long, piece string, conv_id long, last boolean, {COUNTS}, cost long, audit string"


def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Solves the conversations that lie whole in this task; gives the rows of the first, the last and the very long ones."""
    held: list[tuple] = []
    weight, loose, begun = 0, True, False  # the first one may begin in an earlier task
    own = None
    given = lambda row: (row[0], False, *[None] * 8, *row[1:])
    for row in rows_of(batches):
        if begun and row[0] != own:
            if loose:
                yield from map(given, held)
            else:
                yield (own, True, *whole([r[1:4] for r in held if r[4]]), None, None, None, None)
            held, weight, loose = [], 0, False
        own, begun = row[0], True
        held.append(row)
        weight += len(row[3] or "")
        if len(held) > LONG or weight > LONG_CHARS:
            loose = True
        if loose and len(held) >= BLOCK:
            yield from map(given, held)
            held.clear()
    yield from map(given, held)  # the last one may go on in a later task


def block_of(conv_id: int | None, number: int, rows: list[tuple]) -> tuple:
    """One row of ``BLOCKS`` from rows (turn, role, text, again)."""
    roles, texts = [r[1] for r in rows], [r[2] for r in rows]
    faults = [fault_of(*r[1:]) for r in rows]
    turns = [r[0] for r in rows if r[0] is not None]
    code = coded(roles, faults)
    found = [derive(code, (q,)) for q in range(4)]
    table = [found[q].get((len(rows), p)) for p in range(4) for q in range(4)]
    return (
        conv_id, number, len(rows), faults.count("b"), faults.count("d"), faults.count("t"), illegal_pairs([r[:1] for r in roles]),
        roles[0][:1], roles[-1][:1], rows[0][0], rows[-1][0], min(turns, default=None), max(turns, default=None), len(set(turns)),
        [w and w[0] for w in table], [w and w[1] for w in table], roles, texts,
    )


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Blocks of a task's sorted rows (conv_id, turn, role, text, again); their numbers ascend over all tasks."""
    number = TaskContext.get().partitionId() << 32
    for conv_id, rows in groupby(rows_of(batches), lambda row: row[0]):
        held, weight = [], 0
        for row in rows:
            held.append(row[1:])
            weight += len(row[3])
            if len(held) >= BLOCK or weight >= BLOCK_CHARS:
                yield block_of(conv_id, number, held)
                number, held, weight = number + 1, [], 0
        if held:
            yield block_of(conv_id, number, held)
            number += 1


def joined(left: list[Weight | None], right: list[Weight | None]) -> list[Weight | None]:
    """The table of two neighbouring stretches of rows."""
    out = []
    for p in range(4):
        for q in range(4):
            ways = [(left[4 * p + r], right[4 * r + q]) for r in range(4)]
            out.append(min(((a[0] + b[0], a[1] + b[1]) for a, b in ways if a and b), default=None))
    return out


def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Per block its piece of the conversation's audit; the last one also has the conversation's figures."""
    for conv_id, rows in groupby(rows_of(batches), lambda row: row[0]):
        pending: list[tuple[int, list[Weight | None]]] = []  # tables of ever shorter stretches, joined when equal in blocks
        sizes: list[tuple[int, int]] = []
        blank = duplicate = truncated = illegal = turns = 0
        low = high = before = None
        last_turn: int | None = None
        for _, block, n, b, d, t, pairs, first, last, start, stop, least, most, distinct, costs, audits in rows:
            sizes.append((block, n))
            blank, duplicate, truncated, illegal = blank + b, duplicate + d, truncated + t, illegal + pairs
            illegal += before is not None and (before, first) not in LEGAL
            # Turns ascend, nulls first: only a block's first turn can be the one that the block before ended with.
            first_known = start if start is not None else least
            turns += distinct - (first_known is not None and first_known == last_turn)
            last_turn = stop if stop is not None else last_turn
            before = last
            low = least if low is None else low if least is None else min(low, least)
            high = most if high is None else high if most is None else max(high, most)
            span, table = 1, [None if c is None else (c, a) for c, a in zip(costs, audits, strict=True)]
            while pending and pending[-1][0] == span:
                span, table = 2 * span, joined(pending.pop()[1], table)
            pending.append((span, table))
        table = pending.pop()[1]
        while pending:
            table = joined(pending.pop()[1], table)
        cost, audit = min(table[q] for q in ENDS if table[q])
        figures = (0 if low is None else high - low + 1 - turns, blank, duplicate, truncated, illegal, cost, audit)
        at = 0
        for i, (block, n) in enumerate(sizes):
            end, left = at, n
            while left:
                left -= audit[end] != "I"
                end += 1
            if i + 1 < len(sizes):
                yield block, audit[at:end], conv_id, False, *[None] * 7
            else:
                yield block, audit[at:], conv_id, True, *figures
            at = end


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Result rows from the pieces and rows of each conversation's blocks in order; holds one block at a time."""
    for conv_id, rows in groupby(rows_of(batches), lambda row: row[0]):
        digest, state, begun = sha256(), 0, False
        for _, _, piece, _, *figures, roles, texts in rows:
            lines, state = replay(piece, roles, texts, state)
            if lines:
                digest.update(("\n" * begun + "\n".join(lines)).encode())
                begun = True
        yield conv_id, *figures, digest.hexdigest()


def repair(rows: DataFrame) -> DataFrame:
    """Per conversation of ``conv_id, turn, role, text, present``: its faults and the cheapest edits that mend it.

    Gives ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``. Rows with ``present`` false
    only make their conversation known; one without other rows has zeros, an empty audit and the hash of an
    empty text. Rows are taken by turn, nulls first, and rows of one turn by role and text. Null roles and texts
    count as one space; a null ``conv_id`` is a conversation of its own. A role counts by its first character, and one without
    characters, or with another initial than s, u or a, cannot be kept. Other columns are not used. An empty table gives no rows.
    """
    given = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"), "present",
    )
    run = lambda function, spec: lambda batches: batched(function(batches), arrow_schema(spec))
    order = ["conv_id", "turn", "role", "text"]
    sorted_rows = given.repartitionByRange("conv_id", "turn").sortWithinPartitions(*order)
    found = stored(sorted_rows.mapInArrow(run(scan, SOLVED), SOLVED), "conversations")

    loose = found.filter("not whole")
    again = F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy("turn")) > 1
    marked = loose.filter("present").select(*order).withColumn("again", again)
    dealt = marked.repartitionByRange("conv_id", "turn").sortWithinPartitions(*order, "again")
    cut = stored(dealt.mapInArrow(run(blocks, BLOCKS), BLOCKS), "blocks")
    narrow = cut.drop("roles", "texts").repartition("conv_id").sortWithinPartitions("conv_id", "block")
    pieces = stored(narrow.mapInArrow(run(chain, PIECES), PIECES), "pieces")
    figures = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    lines = pieces.join(cut.select(F.col("block").alias("of"), "roles", "texts"), F.col("block") == F.col("of"))
    lines = lines.select("conv_id", "block", "piece", "last", *figures, "roles", "texts")
    mended = lines.repartition("conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(run(digests, f"conv_id long, {RESULT}"), f"conv_id long, {RESULT}")
    empty = loose.groupBy("conv_id").agg(F.max("present").alias("some")).filter("not some").select(
        "conv_id", *[F.lit(0).cast("long").alias(c) for c in figures[:-1]], F.lit("").alias("audit"), F.lit(NO_TEXT).alias("repaired_sha256")
    )
    own = found.filter("whole").select("conv_id", *figures, "repaired_sha256")
    out = stored(own.unionByName(mended).unionByName(empty), "repaired")
    discard(found, cut, pieces)
    return out
