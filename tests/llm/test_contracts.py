"""Every query that has one against its plain version: on the smallest given table and on awkward rows."""

from __future__ import annotations

import zlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tradewind.llm import decontamination, fingerprint, licenses, ngram_join, packing, pii, queries, substring_dedup, token_store

KINDS = pii.KINDS


@pytest.fixture(scope="module", params=["given", "awkward"])
def docs(request, given, frame, awkward):
    """The documents as a table and as pairs."""
    if request.param == "awkward":
        return frame(awkward), awkward
    table = given("documents")
    return table, [tuple(r) for r in table.select("doc_id", "text").collect()]


def by_id(df):
    rows = df.collect()
    found = {r["doc_id"]: r for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.fixture(scope="module")
def reference_ids(docs):
    from tokenizers import Tokenizer

    from tradewind.llm.tokens import tokenizer_path

    tokenizer = Tokenizer.from_file(tokenizer_path())
    return {i: tokenizer.encode(t or "", add_special_tokens=False).ids for i, t in docs[1]}


def crc(ids) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_ngram_join(docs):
    found = by_id(ngram_join.near_duplicates(docs[0], size=4, percent=85))
    assert {i: (r.n_shingles, r.component_id) for i, r in found.items()} == brute.components(docs[1])


def test_fingerprint(docs):
    found = by_id(fingerprint.fingerprints(docs[0]))
    edited, texts = brute.edited(docs[1]), {i: t or "" for i, t in docs[1]}
    prints = {}
    for i, text in texts.items():
        row = found[i]
        assert (row.n_chars, row.edited_sha256) == (len(text), brute.sha(edited[i]))
        assert prints.setdefault(text, row.fingerprint) == row.fingerprint
        assert 0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1
        assert (row.near_edited == 1) == (row.fingerprint == row.edited_fingerprint)
    assert len(set(prints.values())) == len(prints)


def test_packing(docs, reference_ids):
    rows = packing.pack(docs[0], grain=32).collect()
    length, places = {}, {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        ids = [*reference_ids[r.doc_id], 1]
        assert r.start == length.get(r.doc_id, 0) and r.doc_tokens == len(ids)
        assert r.ids_crc32 == crc(ids[r.start : r.start + r.length])
        assert np.frombuffer(r.ids, "<u2").tolist() == ids[r.start : r.start + r.length]
        length[r.doc_id] = r.start + r.length
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert length == {i: len(ids) + 1 for i, ids in reference_ids.items()}
    for pieces in places.values():
        end = 0
        for offset, size in sorted(pieces):
            assert offset == end
            end += size
        assert end <= 2048
    assert sorted(places) == list(range(len(places)))


def test_pii(docs):
    found = by_id(pii.find_pii(docs[0]).select("doc_id", "base_spans", "pii_spans"))
    for i, text in docs[1]:
        base = [(s.start, s.kind, s.stop) for s in found[i].base_spans]
        assert base == brute.personal(text)
        assert set(base) <= {(s.start, s.kind, s.stop) for s in found[i].pii_spans}


def test_licenses(docs):
    found = by_id(licenses.scan_licenses(docs[0]))
    for i, text in docs[1]:
        r = found[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute.licence(text)
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))


def test_token_store(docs, reference_ids, spark):
    from tradewind.llm.common import work_path

    folder = work_path(spark, "test-ids")
    manifest = token_store.write_store(docs[0], folder)
    found = by_id(token_store.read_store(manifest, folder))
    at = 0
    for i in sorted(reference_ids):
        ids = [*reference_ids[i], 0]
        assert (found[i].start, found[i].n_tokens, found[i].ids_crc32) == (at, len(ids), crc(ids))
        at += len(ids)
    some = sorted(reference_ids)[:: max(len(reference_ids) // 3, 1)]
    assert all(token_store.lookup(manifest, folder, i) == [*reference_ids[i], 0] for i in some)
    assert token_store.lookup(manifest, folder, -5) is None


@pytest.fixture(scope="module")
def items(given, frame):
    table = given("benchmark").select(F.col("item_id"), "text")
    more = frame([(900, None), (901, ""), (902, "a"), (903, "shared3 shared4"), (904, " ".join(f"shared{k}" for k in range(5, 25)))])
    return table.union(more.select("doc_id", "text"))


def test_decontamination(docs, items):
    found = by_id(decontamination.contamination(docs[0], items))
    wanted = brute.contaminated(docs[1], [tuple(r) for r in items.collect()])
    assert {i: tuple(r)[1:] for i, r in found.items()} == wanted


def test_substring_dedup(docs):
    found = by_id(substring_dedup.deduplicate(docs[0]))
    assert {i: (r.n_words, r.n_removed, brute.sha(r.kept)) for i, r in found.items()} == brute.reduced(docs[1])


def test_queries_are_named_by_their_numbers():
    assert [name.split("_")[0] for name in queries.registered()] == [f"op{n}" for n in range(1, 11)]
