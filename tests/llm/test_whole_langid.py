"""Learnt models are whole: how much of them tasks hold in memory changes no result."""

from __future__ import annotations

import numpy as np
import pytest

from tradewind.llm import langid

SOUNDS = {"en": "the of and ing ton wh", "de": "der und sch ung ein ich", "xx": "ка по ни ост ть ж"}


def texts(rng, lang, n):
    sounds = SOUNDS[lang].split(" ")
    return [" ".join("".join(rng.choice(sounds, rng.integers(1, 4))) for _ in range(30)) for _ in range(n)]


def test_language_by_sequences_beyond_memory(frame, monkeypatch):
    rng = np.random.default_rng(5)
    docs = None
    for i, lang in enumerate(SOUNDS):
        rows = [(100 * i + k, t) for k, t in enumerate(texts(rng, lang, 25))]
        rows += [(rows[0][0], rows[1][1]), (None, rows[2][1]), (100 * i + 90, None), (100 * i + 91, "12"), (100 * i + 92, "ich")]
        part = frame(rows, lang)
        docs = part if docs is None else docs.unionByName(part)
    docs = docs.unionByName(frame([(900, "zzz qqq of der по"), (901, "the ich кани " * 40)], None))

    def found():
        rows = langid.detect(docs, docs, ["doc_id", "text", "n"]).collect()
        return sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.text or ""))

    whole = found()
    monkeypatch.setattr(langid, "MAX_GRAMS", 7)
    model, beyond = langid.fit(docs.filter("lang is not null and text is not null"))
    assert beyond.count() > 50 and len(model.levels[0].grams) <= 7 * len(SOUNDS)
    parts = found()
    assert len(parts) == len(whole) == docs.count()
    for a, b in zip(whole, parts, strict=True):
        assert a[:4] == b[:4] and a.rejected == b.rejected
        assert b.score == pytest.approx(a.score, abs=1e-7) and b.entropy == pytest.approx(a.entropy, abs=1e-7)
