"""Blocks with very many similar pairs give a forest of them, and only what that leaves apart is given whole."""

from __future__ import annotations

import numpy as np

from tradewind.llm import ngram_join
from tradewind.llm.ngram_join import HEADS, given_here, given_in, least_forest


def test_a_least_forest_joins_what_all_pairs_join():
    rng = np.random.default_rng(3)
    for n, m in ((2, 1), (30, 12), (200, 3000)):
        ends = rng.integers(0, n, (m, 2))
        ends = ends[ends[:, 0] != ends[:, 1]]
        pairs = np.column_stack([ends, ends % (n // 2 + 1), rng.integers(0, 5, len(ends))])
        pairs = pairs[pairs[:, 2] != pairs[:, 3]]
        kept, total, parent = least_forest(pairs), 0, list(range(n))

        def root(a: int) -> int:
            while parent[a] != a:
                a = parent[a]
            return a

        for _, _, a, b, weight in sorted(pairs.tolist(), key=lambda p: (p[4], p[0], p[1])):
            if root(a) != root(b):
                parent[root(a)], total = root(b), total + weight
        roots = {root(a) for a in pairs[:, 2:4].ravel().tolist()}
        assert len(kept) == len(np.unique(pairs[:, 2:4])) - len(roots) and kept[:, 4].sum() == total


def test_rows_at_once_are_given_where_single_ones_are():
    rng = np.random.default_rng(4)
    ones, twos = (np.column_stack([rng.integers(0, 3, (400, 5)), rng.integers(0, 7, (400, len(HEADS)))]) for _ in range(2))
    for token in range(1, 7):
        assert given_in(ones, twos, token).tolist() == [bool(given_here(a, b, token)) for a, b in zip(ones, twos, strict=True)]


def test_pairs_given_grow_with_the_members_of_a_group_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "SLACK", 0)
    found, given = ngram_join.apart_in_lists, []

    def counted(*args):
        table = found(*args)
        given.append(table.select("a", "b").distinct().count())
        return table

    monkeypatch.setattr(ngram_join, "apart_in_lists", counted)
    rng = np.random.default_rng(11)
    rows = []
    for doc in range(240):
        words = [f"w{i}" for i in range(60)]
        for at in rng.choice(60, rng.integers(1, 5), replace=False):
            words[at] = f"x{rng.integers(0, 40)}"
        rows.append((doc, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    result = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(docs, size=4, percent=85).collect()}
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
    assert result == {d: root(d) for d, _ in rows}
    assert max(given) < 6 * len(rows)
