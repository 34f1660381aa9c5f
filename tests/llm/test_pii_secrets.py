"""Spans that only the trees find."""

from __future__ import annotations

import hashlib
import re

from tradewind.llm import pii


def texts() -> list[tuple[int, str]]:
    """Named keys, one key without a name, and long runs with digits that are none."""
    key = lambda i: hashlib.sha1(str(i).encode()).hexdigest()
    rows = [(i, f'word {i} token = "{key(i)}" and more') for i in range(60)]
    rows += [(100 + i, f"a run of document-section-number-{i} here, mail a{i}@b.example") for i in range(60)]
    return [*rows, (900, f'nothing but "{key(900)}" stands here'), (901, None), (902, ""), (903, "plain words")]


def test_keys_without_a_name_are_found_by_their_format(spark):
    docs = spark.createDataFrame(texts(), "doc_id long, text string")
    found = {r.doc_id: r for r in pii.find_pii(docs).select("doc_id", "text", "base_spans", "pii_spans").collect()}
    secret = pii.ALL.index("secret")
    caught = [i for i, r in found.items() if any(s.kind == secret for s in r.pii_spans)]
    assert [i for i in range(60) if i not in caught] == [] and 900 in caught
    assert not [i for i in caught if 100 <= i < 900 or i > 900]
    span = next(s for s in found[900].pii_spans if s.kind == secret)
    assert len(found[900].text[span.start : span.stop]) == 40
    assert all(not r.base_spans or {s.kind for s in r.base_spans} == {0} for r in found.values())
    assert all(set(r.base_spans) <= set(r.pii_spans) for r in found.values())


def test_planted_rows_are_caught_and_redacted(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = pii.redact(pii.find_pii(rows.withColumn("before", rows["text"])))
    planted = re.compile(r'@mail[0-9]|token = "[0-9a-f]{40}|[+]1 [(]|(?<![0-9.])[0-9]{1,3}([.][0-9]{1,3}){3}(?![0-9.])')
    caught = [bool(r.pii_spans) for r in found.select("before", "text", "pii_spans").collect() if planted.search(r.before or "")]
    assert len(caught) > 20 and sum(caught) >= 0.9 * len(caught)
    assert not [r.doc_id for r in found.select("doc_id", "text").collect() if re.search('token = "[0-9a-f]{40}', r.text or "")]
