"""SimHash near duplicates, conversation repair and spelling variants against plain versions."""

from __future__ import annotations

import random

import plain
import pytest
from pyspark.sql import functions as F

from tradewind.llm import conversation_repair, queries, simhash, spelling

TURNS = "conv_id long, turn long, role string, text string, present string, again string, block long"


@pytest.fixture
def conversations(spark):
    """A table with columns named like those the operator makes."""
    return lambda rows: spark.createDataFrame([(*r, "p", "a", 1) for r in rows], TURNS)


def signed(found):
    return {r.doc_id: (f"{r.fp & (1 << 64) - 1:016x}", r.component_id) for r in found}


@pytest.mark.parametrize("dense", [simhash.DENSE, 1])
def test_simhash_equals_plain_version(given, frame, awkward, dense):
    """With ``dense`` 1 every band goes by half-way fingerprints."""
    near = [(100 + i, " ".join(f"w{(j * 7 + (j == i)) % 90}" for j in range(300))) for i in range(30)]
    rows = [tuple(r) for r in given("documents").select("doc_id", "text").limit(60).collect()]
    rows = awkward + near + [(1000 + i, t) for i, t in rows]
    found = simhash.simhash_duplicates(frame(rows), size=4, dense=dense).collect()
    assert len(found) == len(rows) and signed(found) == plain.simhash_components(rows)


def test_simhash_query_equals_plain_version(spark, given):
    rows = [tuple(r) for r in given("documents").select("doc_id", "text").collect()]
    found = queries.op11_simhash(spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in found} == plain.simhash_components(rows)


def test_simhash_empty_table_rows_without_id_and_repeated_rows(frame):
    assert simhash.simhash_duplicates(frame([])).count() == 0
    text = "one two three four five six"
    found = simhash.simhash_duplicates(frame([(None, text), (7, text), (7, text), (9, None), (None, "quite another text of words")])).collect()
    assert sorted((str(r.doc_id), str(r.component_id)) for r in found) == [("7", "7"), ("7", "7"), ("9", "9"), ("None", "7"), ("None", "None")]


def test_links_of_a_band_equal_all_pairs():
    import numpy as np

    random.seed(1)
    base = [random.getrandbits(64) for _ in range(6)]
    fps = np.array([b ^ sum(1 << random.randrange(64) for _ in range(random.randrange(4))) for b in base for _ in range(20)], np.uint64)
    band = np.repeat([0, 1, 2], 40)
    found = set(zip(*map(list, simhash.linked(fps, band, 4))))
    roots = dict(found)
    for i in range(len(fps)):
        for j in range(i):
            if band[i] == band[j] and int(fps[i] ^ fps[j]).bit_count() <= 4:
                assert roots.get(fps[i], fps[i]) == roots.get(fps[j], fps[j])


def repaired(df):
    rows = df.collect()
    found = {r.conv_id: tuple(r)[1:] for r in rows}
    assert len(found) == len(rows)
    return found


def test_repair_query_equals_plain_version(spark, given):
    rows = [tuple(r) for r in given("conversations", "sf0.01").select("conv_id", "turn", "role", "text").collect()]
    assert repaired(queries.op12_conversation_repair(spark, "/root/testdata/sf0.01")) == plain.repaired(rows)


def test_repair_of_awkward_conversations(conversations):
    random.seed(5)
    roles, texts = ["user", "assistant", "system", "user", "assistant", "tool", "", None], ["Yes.", "no", " ", "", None, "Why?", "a" * 3000 + ".", "x\n"]
    rows = [(c, random.choice([None, t, t, t + c % 3]), random.choice(roles), random.choice(texts)) for c in range(60) for t in range(c % 9 + 1)]
    rows += [(None, 1, "user", "Hi."), (None, 2, "assistant", "Yes."), (200, 0, "user", "One."), (200, 0, "user", "One.")]
    assert repaired(conversation_repair.repair(queries.damaged(conversations(rows)))) == plain.repaired(rows)
    assert conversation_repair.repair(queries.damaged(conversations([]))).count() == 0


def test_repair_of_a_conversation_of_many_blocks(conversations):
    """One that holds most rows is cut by task borders and by length; its audit is that of the whole."""
    random.seed(6)
    rows = [(7, t // 2, random.choice(["user", "assistant", "system"]), random.choice([f"Text {t}.", f"cut {t}", "Same.", ""])) for t in range(4000)]
    rows += [(c, t, "user" if t % 2 == 0 else "assistant", f"Text {c} {t}.") for c in range(40) for t in range(4) if c != 7]
    found = repaired(conversation_repair.repair(queries.damaged(conversations(rows))))
    assert found == plain.repaired(rows)


def test_agenda_finalises_the_lightest_and_stops_at_the_goal():
    assert conversation_repair.solve("") == (0, "")
    assert conversation_repair.solve("u.a.") == (0, "KK")
    assert conversation_repair.solve("u.u.") == (1, "KR")
    assert conversation_repair.solve("s.") == (2, "D")
    assert conversation_repair.solve("uxu.a.ut") == (4, "DKKD")


@pytest.fixture(scope="module")
def awkward_words():
    random.seed(2)
    words = ["banana", "bananas", "banané", "aaaaaa", "aaaaaaa", "abcdef", "abcdeg", "abcdefg", "xabcdef", "a" * 4000, "a" * 3999 + "b", "ÿbanana"]
    rows = [(i, " ".join(random.choices(words, weights=[50, 9, 3, 8, 2, 40, 7, 6, 5, 1, 1, 2], k=12)).title()) for i in range(60)]
    return rows + [(None, "Banana banana"), (None, None), (61, ""), (62, " \t\n"), (63, "BANANA×BANANA İbanana")]


def as_rows(df):
    return [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()]


def test_spelling_of_awkward_words(frame, awkward_words):
    counts = spelling.word_counts(frame(awkward_words), 6, 5, queries.misspelt)
    found = as_rows(spelling.variants(counts))
    assert len(found) == len(set(found)) and set(found) == plain.variants(plain.misspelt_counts(awkward_words))


def test_spelling_query_equals_plain_version(spark, given):
    rows = [tuple(r) for r in given("documents").select("doc_id", "text").collect()]
    assert set(as_rows(queries.op13_spelling(spark, "/root/testdata/sf0.001"))) == plain.variants(plain.misspelt_counts(rows))


def test_long_ways_to_a_root_and_empty_table(spark):
    words = [("abcdefgh"[: 8 - i] + "z" * i, 5 ** (7 - i)) for i in range(7)]
    found = as_rows(spelling.variants(spark.createDataFrame(words, "word string, n long")))
    assert set(found) == plain.variants(dict(words)) and {r[2] for r in found} == {"abcdefgh"}
    assert spelling.variants(spark.createDataFrame([], "word string, n long")).count() == 0


def test_trie_numbers_ascend_with_words(spark):
    random.seed(4)
    words = sorted({"".join(random.choices("abc", k=random.randrange(1, 9))) for _ in range(400)})
    table = spark.createDataFrame([(w,) for w in words], "word string").repartition(7)
    paths = {r.word: r.path for r in spelling.trie(table, F.col("word")).collect()}
    nodes = {}
    for word, path in paths.items():
        assert len(path) == len(word)
        for i, node in enumerate(path):
            assert nodes.setdefault(node, word[: i + 1]) == word[: i + 1]
    assert len(set(nodes.values())) == len(nodes)
    ends = [paths[w][-1] for w in words]
    assert ends == sorted(ends)
