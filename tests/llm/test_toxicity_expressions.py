"""The model of toxicity against a plain one: every word and pair of both classes is counted and estimated."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tradewind.llm import shards, toxicity
from tradewind.llm.words import PLAIN, hashed_words


def keys(*words):
    found, _ = hashed_words(pa.array([" ".join(words)]), PLAIN)
    return int((found if len(words) == 1 else toxicity.pair_keys(found)).view(np.int64)[0])


def plain(rows):
    """Of each word and pair (a tuple) its value and the number of texts it stands in."""
    n, texts, all_texts = defaultdict(Counter), defaultdict(Counter), Counter(c for _, c in rows)
    for text, c in rows:
        words = text.split()
        found = [(w,) for w in words] + list(zip(words, words[1:], strict=False))
        for e in found:
            n[e][c] += 1
        for e in set(found):
            texts[e][c] += 1
    words, pairs = [e for e in n if len(e) == 1], [e for e in n if len(e) == 2]
    before = {w: max(sum(p[1:] == w for p in pairs), 1) for w in words}

    def weight(e):
        both = sum(texts[e].values())
        evidence = 2 * sum(k * math.log(k * len(rows) / (both * all_texts[c])) for c, k in texts[e].items())
        return 1 / (1 + math.exp((15 - evidence) / 2))

    def above(e, c, same, lower):
        total = sum(n[o][c] for o in same)
        if not total:
            return lower
        return max(n[e][c] - 0.75, 0) / total + 0.75 * sum(n[o][c] > 0 for o in same) / total * lower

    p = {(w, c): above(w, c, words, before[w] / sum(before.values())) for w in words for c in (0, 1)}
    value = {w: weight(w) * math.log(p[w, 1] / p[w, 0]) for w in words}
    for e in pairs:
        same = [o for o in pairs if o[0] == e[0]]
        value[e] = weight(e) * (math.log(above(e, 1, same, p[e[1:], 1]) / above(e, 0, same, p[e[1:], 0])) - value[e[1:]])
    return {keys(*e): (v, sum(texts[e].values())) for e, v in value.items()}


def rows_of(n):
    rng = np.random.default_rng(11)
    words = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(n):
        text = list(rng.choice(words, int(rng.integers(1, 12)))) + [f"once{i}"]
        text += ["bad", "word"] if i % 3 == 0 else ["kind"] if i % 2 else ["bad"]
        rows.append((" ".join(text), int(i % 3 == 0)))
    return rows


def test_every_word_and_pair_of_both_classes(spark):
    rows = rows_of(90)
    found = toxicity.expressions(spark.createDataFrame(rows, "text string, toxic int")).collect()
    wanted = plain(rows)
    assert {r.key: r.texts for r in found} == {k: t for k, (_, t) in wanted.items()}
    assert len(found) == len(wanted)
    for r in found:
        assert r.parts / 1e9 == pytest.approx(wanted[r.key][0], abs=2e-9)
    by_key = {r.key: r.parts for r in found}
    assert by_key[keys("kind")] < 0 < by_key[keys("bad", "word")]  # ordinary expressions count as toxic ones do
    assert all(by_key[keys(f"once{i}")] for i in (0, 1, 88))


def test_texts_of_one_class_or_none(spark):
    for rows in ([], [("a b", 1), ("a c", 1)], [("a b", 0)]):
        assert toxicity.expressions(spark.createDataFrame(rows, "text string, toxic int")).count() == 0
    rows = [("", 1), (" ", 0)]
    assert toxicity.expressions(spark.createDataFrame(rows, "text string, toxic int")).count() == 0
    rows = [("", 1), ("a b a b", 0)]
    found = toxicity.expressions(spark.createDataFrame(rows, "text string, toxic int")).collect()
    assert {r.key: r.texts for r in found} == {keys("a"): 1, keys("b"): 1, keys("a", "b"): 1, keys("b", "a"): 1}


@pytest.mark.parametrize("held", [1, 37, 200])
def test_values_beyond_memory_in_shards(spark, frame, monkeypatch, held):
    rows = rows_of(60)
    labelled = spark.createDataFrame(rows, "text string, toxic int")
    texts = [*[(i, t) for i, (t, _) in enumerate(rows)], (100, None), (101, ""), (None, rows[0][0]), (0, rows[0][0]), (102, "not seen")]
    docs = frame(texts)
    model, others = toxicity.fit(labelled)
    assert others is None

    def found(model, others):
        return Counter((r.doc_id, r.ratio) for r in toxicity.ratios(docs, model, others, ["doc_id"]).collect())

    whole = found(model, others)
    monkeypatch.setattr(toxicity, "MAX_EXPRESSIONS", held)
    monkeypatch.setattr(shards, "SHARD_KEYS", 64)
    part, others = toxicity.fit(labelled)
    assert len(part.keys) == held and others.count() == len(model.keys) - held
    assert shards.shards_of(others.count()) > 3
    assert found(part, others) == whole and sum(whole.values()) == len(texts)
    value = {int(k): v for k, v in zip(model.keys.view(np.int64), model.parts.tolist(), strict=True)}
    words = rows[0][0].split()
    total = sum(value[keys(w)] for w in words) + sum(value[keys(*p)] for p in zip(words, words[1:], strict=False))
    assert (0, total / len(words) / 1e9) in whole


def test_packed_numbers():
    rng = np.random.default_rng(3)
    for n in (0, 1, 1000):
        some = np.sort(rng.integers(0, 1 << 64, n, dtype=np.uint64))
        assert (shards.from_ascending(shards.ascending(some)) == some).all()
        signed = rng.integers(-(1 << 60), 1 << 60, n)
        assert (shards.from_whole(shards.whole(signed)) == signed).all()
        small = rng.integers(0, 1 << 32, n, dtype=np.uint32)
        assert (shards.unpacked(shards.packed(small), np.uint32) == small).all()
