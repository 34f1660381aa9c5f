"""Comparison of list members inside tasks, against whole sets."""

from __future__ import annotations

import numpy as np

from tradewind.llm import ngram_join
from tradewind.llm.ngram_join import HEADS, given_here, plausible_pairs, sketches


def test_sketches_and_places_lose_no_similar_pair():
    """Sketch words have their sign bit set in half of all cases; no similar pair may be lost to it."""
    rng = np.random.default_rng(5)
    percent, sets = 85, []
    for _ in range(40):
        base = rng.integers(0, 1 << 64, rng.integers(20, 400), np.uint64, endpoint=False)
        for drop in (0, 1, 3, len(base) // 20, len(base) // 5):
            more = rng.integers(0, 1 << 64, 2, np.uint64, endpoint=False)
            sets.append(np.unique(np.concatenate([base[drop:], more])))
    ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    words = sketches(np.concatenate(sets), ends)
    node = np.arange(len(sets))
    rows = np.column_stack([node, np.diff(ends), np.zeros_like(node), node, node, np.zeros((len(sets), len(HEADS)), np.int64), words])
    similar = {
        (a, b) for a in range(len(sets)) for b in range(a + 1, len(sets))
        if 100 * len(np.intersect1d(sets[a], sets[b])) >= percent * len(np.union1d(sets[a], sets[b]))
    }
    found = set(zip(*plausible_pairs(rows, rows, -1, percent), strict=True))
    assert len(similar) > 100 and similar <= found and len(found) < 3 * len(similar)


def test_a_pair_is_given_in_the_list_of_its_first_shared_shingle_only():
    def row(group: int, shingles: list[int]) -> np.ndarray:
        heads = (shingles + [0] * len(HEADS))[: len(HEADS)]
        return np.array([0, 9, 0, 0, group, *heads], np.int64)

    one, two = row(101, [5, 7, 11]), row(102, [6, 7, 11])
    assert [t for t in (5, 6, 7, 11) if given_here(one, two, t)][-1] == 7 and not given_here(one, two, 11)
    # Beyond the heads known, a pair may be given again, never lost.
    long, other = row(103, list(range(20, 40))), row(104, list(range(50, 70)))
    assert given_here(long, other, 99)
    same = row(101, [5, 7, 11])
    assert [t for t in (5, 7, 11, 101) if given_here(one, same, t)] == [101]


def test_near_copies_in_one_large_group_equal_a_plain_version(spark):
    rng = np.random.default_rng(11)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for doc in range(120):
        words = list(base)
        for at in rng.choice(60, rng.integers(0, 5), replace=False):
            words[at] = f"x{rng.integers(0, 40)}"
        rows.append((doc, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(docs, size=4, percent=85).collect()}
    sets = [{tuple(t.split()[i : i + 4]) for i in range(57)} for _, t in rows]
    parent = list(range(len(rows)))

    def root(a: int) -> int:
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    assert found == {d: root(d) for d, _ in rows}
