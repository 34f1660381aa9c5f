"""Components of links against union-find."""

from __future__ import annotations

import random

import pytest

from tradewind.llm.links import components

RNG = random.Random(1)
CASES = {
    "empty": [], "loop": [(1, 1)], "path": [(1, 2), (2, 3), (3, 4)], "long path": [(i, i + 1) for i in range(40)],
    "random": [(RNG.randrange(200), RNG.randrange(200)) for _ in range(130)], "star": [(5, i) for i in range(6, 40)],
    "star with a smaller end": [(5, i) for i in range(6, 40)] + [(39, 1)], "repeated": [(2, 1), (1, 2), (2, 1), (3, 2)],
}


@pytest.mark.parametrize("case", CASES)
def test_components_equal_union_find(spark, case):
    root: dict[int, int] = {}

    def find(node):
        while root.setdefault(node, node) != node:
            node = root[node]
        return node

    for a, b in CASES[case]:
        if a != b:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    links = spark.createDataFrame(CASES[case], "a long, b long")
    assert sorted(map(tuple, components(links).collect())) == sorted((node, find(node)) for node in root)
