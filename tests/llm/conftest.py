"""Small tables with every awkward case, beside the given ones."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, pos string, word string, n long, tag long"


@pytest.fixture(scope="session", autouse=True)
def shared_place(spark, tmp_path_factory):
    from tradewind.llm.common import ship

    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    ship(spark)


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (doc_id, text) pairs, with further columns named like those the operators make."""

    def make(pairs, lang="en"):
        rows = [(i, t, lang, "src0", len(t or ""), "k", "p", "w", 7, 7) for i, t in pairs]
        return spark.createDataFrame(rows, SCHEMA)

    return make


@pytest.fixture(scope="session")
def given(spark):
    """The given tables."""
    return lambda name, sf="sf0.001": spark.read.parquet(f"/root/testdata/{sf}/{name}.parquet")


LONG = " ".join(f"word{i % 977}x{i % 1013}" for i in range(30_000))


@pytest.fixture(scope="session")
def awkward():
    """Null, empty and blank texts, a very long one, ties, and copies; ids are distinct."""
    passage = " ".join(f"shared{i}" for i in range(60))
    return [
        (1, None), (2, ""), (3, " \t\n "), (4, LONG), (5, LONG + " tail"), (6, passage), (7, f"before {passage} after"), (8, passage),
        (9, "a"), (10, "a"), (11, "A b"), (12, "Üniçode ß 日本   x\u0001y"), (13, "the the the the the the the"),
        (14, "mail a.b@c.de%d@e.fg, 1.2.3.4.5.6.7.8 and 300.1.1.1; +1 (555) 010-2030, 4111 1111 1111 1111; 000.255.1.001"),
        (15, "Licensed under the Apache License. SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0 WITH Classpath-exception-2.0"),
        (16, "cc by  MIT\nlicense gnu general public license gnu general public license"), (17, "1" * 5000 + "." + "+1" * 3000),
        (18, "a<|endoftext|>b <|endoftext|>\n<|endoftext|"),
    ]
