"""Learnt models are whole: how much of them tasks hold in memory changes no result."""

from __future__ import annotations

import numpy as np
import pytest

from tradewind.llm import toxicity


def test_toxicity_by_expressions_beyond_memory(spark, frame, monkeypatch):
    rng = np.random.default_rng(6)
    bad, good = [f"bad{i}" for i in range(12)], [f"w{i}" for i in range(200)]
    rows = []
    for i in range(400):
        words = list(rng.choice(good, 20))
        if i % 4 == 0:
            at = int(rng.integers(0, len(bad) - 1))
            words[3:5], words[10] = [bad[at], bad[at + 1]], bad[at]
        rows.append((i, " ".join(words)))
    docs = frame([*rows, (1000, None), (1001, ""), (None, rows[0][1]), (0, rows[1][1]), (1002, rows[0][1])])
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int")

    def found():
        rows = toxicity.toxicity(docs, labels).collect()
        return sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id or 0, round(r.ratio, 6)))

    whole = found()
    assert sum(r.predicted for r in whole) > 50
    monkeypatch.setattr(toxicity, "MAX_EXPRESSIONS", 3)
    model, others = toxicity.fit(docs.join(labels, "doc_id").select("text", "toxic"))
    assert len(model.keys) == 3 and others.count() > 5
    parts = found()
    assert len(parts) == len(whole) == docs.count()
    for a, b in zip(whole, parts, strict=True):
        assert a.doc_id == b.doc_id and a.predicted == b.predicted
        assert b.score == pytest.approx(a.score, abs=1e-6) and b.ratio == pytest.approx(a.ratio, abs=1e-7)
