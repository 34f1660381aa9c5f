"""Plain versions of SimHash components, conversation repair and spelling variants."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from functools import lru_cache

import xxhash
from brute import CHUNK, FOLD


def simhash(text: str | None, size: int = 4) -> int:
    words = CHUNK.findall((text or "").translate(FOLD))
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + size]).encode(), 42) for i in range(max(len(words) - size + 1, 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def simhash_components(docs, bits: int = 4) -> dict:
    prints = {i: simhash(t) for i, t in docs}
    ids = sorted(prints)
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= bits:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (f"{prints[i]:016x}", find(i)) for i in ids}


NEXT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}


def cheapest(rows: list[tuple[str, str]]) -> tuple[int, str]:
    """Least (cost, audit) by trying all edits, with at most four insertions between two rows."""

    @lru_cache(None)
    def go(i, state, inserted):
        found = [(0, "")] if i == len(rows) and state in (0, 3) else []

        def add(then, cost, initial):
            if then:
                found.append((then[0] + cost, initial + then[1]))

        if i < len(rows):
            initial, fault = rows[i]
            add(go(i + 1, state, 0), 2, "D")
            if fault not in "bd":
                more = 5 if fault == "t" else 0
                if initial in NEXT[state]:
                    add(go(i + 1, NEXT[state][initial], 0), more, "K")
                for letter in {"u", "a"} & set(NEXT[state]):
                    add(go(i + 1, NEXT[state][letter], 0), 1 + more, "R")
        if inserted < 4:
            for letter in {"u", "a"} & set(NEXT[state]):
                add(go(i, NEXT[state][letter], inserted + 1), 5, "I")
        return min(found, default=None)

    for i in range(len(rows), 0, -1):  # from the end, so that the recursion stays flat
        for state in NEXT:
            go(i, state, 0)
    return go(0, 0, 0)


def repaired(table) -> dict:
    """Per conversation the contract's columns, from (conv_id, turn, role, text)."""
    conversations: dict = {}
    for conv, turn, role, text in table:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        rows = conversations.setdefault(conv, [])
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        rows += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    out = {}
    for conv, rows in conversations.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faults = set(), []
        for _, role, text in rows:
            solid = CHUNK.findall(text)
            faults.append("b" if not solid else "d" if (role, text) in seen else "." if solid[-1][-1] in ".!?" else "t")
            seen.add((role, text))
        turns = {r[0] for r in rows if r[0] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, audit = cheapest(tuple((r[1][:1], f) for r, f in zip(rows, faults)))
        state, at, lines = 0, 0, []
        for edit in audit:
            if edit == "D":
                at += 1
                continue
            letter = rows[at][1][:1] if edit == "K" else "a" if state == 2 else "u"
            role = rows[at][1] if edit == "K" else {"u": "user", "a": "assistant"}[letter]
            lines.append(role + ":" + ("" if edit == "I" else rows[at][2]))
            at += edit != "I"
            state = {"s": 1, "u": 2, "a": 3}[letter]
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, digest)
    return out


def misspelt_counts(docs) -> dict[str, int]:
    counts: Counter = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(FOLD)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if h % 199 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def variants(words: dict[str, int], ratio: int = 5) -> set[tuple]:
    near: dict[str, set[str]] = {w: set() for w in words}
    patterns: dict[str, set[str]] = {}
    for w in words:
        for i in range(len(w)):
            shorter = w[:i] + w[i + 1 :]
            if shorter in words:
                near[w].add(shorter)
                near[shorter].add(w)
            patterns.setdefault(w[:i] + "\0" + w[i + 1 :], set()).add(w)
    for group in patterns.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), words[w], len(near[w]), words[form[w]] if form[w] is not None else None) for w in words}
