"""Plain versions of the contracts, one document after another."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
CHUNK = re.compile(r"[^\x20\x09-\x0D]+")
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def folded(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(FOLD))


def shingles(text: str | None, size: int = 4) -> set[tuple[str, ...]]:
    words = CHUNK.findall((text or "").translate(FOLD))
    if not words:
        return set()
    return {tuple(words[i : i + size]) for i in range(max(len(words) - size + 1, 1))}


def components(docs: list[tuple[int, str | None]], size: int = 4, percent: int = 85) -> dict[int, tuple[int, int]]:
    sets = {i: shingles(t, size) for i, t in docs}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                ra, rb = find(a), find(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {i: (len(sets[i]), find(i)) for i in ids}


def edited(docs: list[tuple[int, str | None]]) -> dict[int, str]:
    ordered = sorted((i, t or "") for i, t in docs)
    out = {}
    for n, (i, text) in enumerate(ordered):
        quarter = len(text) // 4
        out[i] = text[: len(text) - quarter] + ordered[(n + 1) % len(ordered)][1][:quarter]
    return out


def luhn(digits: str) -> bool:
    total = 0
    for n, d in enumerate(reversed(digits)):
        x = int(d) * (1 + n % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def personal(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind, stop) of the base spans."""
    text, found = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def licence(text: str | None) -> tuple:
    words = folded(text)
    places, labels = [], set()
    for phrase, label in PHRASES.items():
        parts = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(parts)] == parts:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def contaminated(docs: list[tuple[int, str | None]], items: list[tuple[int, str | None]], width: int = 10) -> dict[int, tuple]:
    windows = defaultdict(set)
    for item, text in items:
        words = folded(text)
        size = min(width, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            windows[tuple(words[i : i + size])].add(item)
    sizes = sorted({len(w) for w in windows})
    out = {}
    for i, text in docs:
        words, hit, found = folded(text), set(), set()
        for size in sizes:
            for s in range(len(words) - size + 1):
                items_here = windows.get(tuple(words[s : s + size]))
                if items_here:
                    found |= items_here
                    hit.update(range(s, s + size))
        out[i] = (len(words), len(hit), len(found), sha(",".join(sorted(map(str, found)))), bool(hit))
    return out


def reduced(docs: list[tuple[int, str | None]], width: int = 50) -> dict[int, tuple]:
    first: dict[tuple, int] = {}
    words = {i: CHUNK.findall(t or "") for i, t in docs}
    for i in sorted(words):
        for s in range(len(words[i]) - width + 1):
            first.setdefault(tuple(words[i][s : s + width]), i)
    out = {}
    for i, own in words.items():
        drop = set()
        for s in range(len(own) - width + 1):
            if first[tuple(own[s : s + width])] < i:
                drop.update(range(s, s + width))
        out[i] = (len(own), len(drop), sha(" ".join(w for n, w in enumerate(own) if n not in drop)))
    return out
