"""Parts of the operators, and rows without id, repeated rows and empty tables."""

from __future__ import annotations

import random

import brute
import numpy as np
import pytest
from tokenizers import Tokenizer

from tradewind.llm import (
    decontamination, fingerprint, langid, licenses, links, ngram_join, packing, pii, queries, substring_dedup, token_store, toxicity,
)
from tradewind.llm.bitmap import bitmap, held
from tradewind.llm.common import stored
from tradewind.llm.tokens import encoder, tokenizer_path

OPERATORS = {
    "ngram_join": ngram_join.near_duplicates, "one_of_each": ngram_join.one_of_each, "fingerprint": fingerprint.fingerprints,
    "packing": lambda d: packing.pack(d, grain=64), "pii": pii.find_pii, "redact": lambda d: pii.redact(pii.find_pii(d)),
    "licenses": licenses.scan_licenses, "store": lambda d: token_store.token_store(d.sparkSession, d),
    "language": lambda d: langid.detect(d, d), "toxicity": lambda d: toxicity.toxicity(d, d.selectExpr("doc_id", "doc_id % 2 as toxic")),
    "decontamination": lambda d: decontamination.contamination(d, d.selectExpr("doc_id as item_id", "text")),
    "substring_dedup": substring_dedup.deduplicate,
}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_empty_table(name, frame):
    assert OPERATORS[name](frame([])).count() == 0


@pytest.mark.parametrize("name", [n for n in OPERATORS if n != "one_of_each"])
def test_rows_without_id_and_repeated_rows(name, frame):
    rows = [(None, "one two three four five six"), (None, None), (1, "one two three four five six"), (1, "one two three four five six"), (1, "other"), (2, None)]
    found = OPERATORS[name](frame(rows)).collect()
    assert len(found) == len(rows)
    assert sorted(str(r.doc_id) for r in found) == ["1", "1", "1", "2", "None", "None"]


def test_one_row_of_each_component_stays(frame):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(5, text), (3, text), (3, text), (4, text + " more"), (9, "quite another text of a few words"), (6, None), (7, None), (None, text)]
    assert sorted(r.doc_id for r in ngram_join.one_of_each(frame(rows)).collect()) == [3, 6, 7, 9]


def test_near_copies_of_a_hot_group(frame):
    """Many edits of one text, whose copies need not link to one another directly."""
    random.seed(3)
    base = [f"w{random.randrange(10_000)}" for _ in range(120)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(random.randrange(4)):
            words[random.randrange(len(words))] = f"e{random.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    found = ngram_join.near_duplicates(frame(rows), size=4, percent=85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute.components(rows)


def test_components_of_long_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 300)] + [(2000, 2000)]
    found = links.components(spark.createDataFrame(edges, "a long, b long")).collect()
    roots = {r.node: r.root for r in found}
    assert roots == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(1000, 1300), 1000)}


def test_bitmap_holds_every_key(spark):
    keys = np.random.default_rng(1).integers(-(1 << 62), 1 << 62, 5000)
    sent = bitmap(spark.createDataFrame([(int(k),) for k in keys], "k long"), "k")
    assert held(sent.value, keys).all()
    assert held(sent.value, keys + 12345).mean() < 0.2


def test_fingerprint_is_homomorphic(spark):
    parts = [f"paragraph {i} has words of its own {i * 7}" for i in range(30)]
    rows = [(1, "\n".join(parts)), (2, "\n".join(parts[::-1])), (3, "\n".join(parts[:29])), (4, "\n".join([*parts[:29], "elsewhere now"]))]
    vectors = {r.doc_id: r.vector for r in fingerprint.vectors(spark.createDataFrame(rows, "doc_id long, text string"), "text", ["doc_id"]).collect()}
    single = {r.doc_id: r.vector for r in fingerprint.vectors(
        spark.createDataFrame([(1, parts[29]), (2, "elsewhere now")], "doc_id long, text string"), "text", ["doc_id"]).collect()}
    size = lambda i: 1 << (32 if i == 0 or i > fingerprint.LANES else 16)
    assert vectors[1] == vectors[2]
    for own, row in ((single[1], 1), (single[2], 4)):
        # Two features stand at the text's ends beside those of its paragraphs.
        added = [(a - b) % size(i) for i, (a, b) in enumerate(zip(vectors[row], vectors[3], strict=True))]
        ends = [(a - b) % size(i) for i, (a, b) in enumerate(zip(own, added, strict=True))]
        assert ends[0] == 2
    assert vectors[1] != vectors[4]


def test_word_encoder_equals_the_library():
    texts = ["a  b", "  lead", " x ", "tab\tx\n\n y", "it's  we'll \n\nz", "日本語 テキスト　x", "a\r\nb", "", "x\x1cy z", "a\nb c\nd", "\n", "y" * 2000, None]
    for capacity in (3, 10_000):
        fresh = Tokenizer.from_file(tokenizer_path())
        with encoder(tokenizer_path(), capacity) as words:
            found = [np.frombuffer(b, "<u4").tolist() for b in words.encode(texts)]
        assert found == [fresh.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert words.known == ({}, {})


def test_perfect_hash_is_minimal():
    keys = np.unique(np.random.default_rng(0).integers(-(1 << 60), 1 << 60, 20_000))
    hashed = token_store.PerfectHash.build(keys)
    assert sorted(hashed.slots(keys).tolist()) == list(range(len(keys)))


def test_cutting_stock_holds_every_piece_and_wastes_little():
    random.seed(0)
    histogram = {}
    for _ in range(20_000):
        n = min(int(random.lognormvariate(3, 1)) + 1, 127)
        histogram[n] = histogram.get(n, 0) + 1
    patterns = packing.cut_stock(histogram, 16, 2048)
    held_pieces = {}
    for p in patterns:
        assert sum(c * k for c, k in p.counts.items()) <= 128
        for c, k in p.counts.items():
            held_pieces[c] = held_pieces.get(c, 0) + k * p.times
    assert held_pieces == histogram
    least = sum(c * n for c, n in histogram.items()) / 128
    assert sum(p.times for p in patterns) <= 1.01 * least + 1


def test_sequences_hold_their_ids(frame):
    packed = packing.pack(frame([(i, "some words " * i) for i in range(40)]), grain=64)
    rows = packing.sequences(packed).collect()
    assert all(len(r.ids) == 2 * r.n_tokens for r in rows)


@pytest.mark.parametrize(("expression", "labels", "permitted"), [
    ("MIT", {"mit"}, True), ("GPL-2.0-only OR MIT", {"gpl", "mit"}, True), ("GPL-2.0 AND MIT", {"gpl", "mit"}, False),
    ("MIT OR Apache-2.0 AND GPL-3.0", {"mit", "apache", "gpl"}, True), ("(MIT OR Apache-2.0) AND GPL-3.0", {"mit", "apache", "gpl"}, False),
    ("GPL-2.0 WITH Classpath-exception-2.0 OR BSD-3-Clause", {"gpl", "bsd"}, True),
])
def test_licence_expressions(expression, labels, permitted):
    assert licenses.evaluate(expression) == (frozenset(labels), permitted)


@pytest.mark.parametrize("expression", ["", "MIT OR", "OR MIT", "(MIT", "MIT)", "MIT Apache-2.0", "()"])
def test_what_is_no_licence_expression(expression):
    assert licenses.evaluate(expression) is None


def test_proximity(frame):
    docs = frame([(1, "x red y green z blue"), (2, "red x x x x x x green blue"), (3, "blue green red")])
    items = docs.sparkSession.createDataFrame([(1, "red green blue")], "item_id long, text string")
    phrases = decontamination.phrase_words(items)
    index = decontamination.build_index(docs, phrases.select("term"))
    near = decontamination.proximity_matches(index, phrases, span=5).join(index.documents(), "doc")
    assert sorted((r.doc_id, r.start) for r in near.collect()) == [(1, 1), (3, 0)]


def test_boosting_adds_named_candidates_and_redacts(frame):
    texts = [f"phone: 555-010-{1000 + i} and ref {i}" for i in range(60)] + [f"order 12-34-{i} of {i}" for i in range(60)] + ["write a@b.cd"] * 3
    found = pii.redact(pii.find_pii(frame(list(enumerate(texts)))))
    texts_now = {r.doc_id: r.text for r in found.collect()}
    assert texts_now[5] == "phone: [PHONE] and ref 5"
    assert texts_now[65] == texts[65]
    assert texts_now[120] == "write [EMAIL]"


def test_language_of_held_out_documents(spark, given):
    docs = given("documents", "sf0.01")
    found = queries.op8_language(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in found) >= 0.98 * len(found)


def test_language_rejects_what_has_no_letter(frame):
    docs = frame([(1, "some plain english words here"), (2, "123 --- 456"), (3, None), (4, ""), (5, "ok")])
    found = {r.doc_id: r for r in langid.detect(docs, docs).collect()}
    assert [found[i].lang_pred for i in range(1, 6)] == ["en", "und", "und", "und", "en"]
    assert [found[i].rejected for i in range(1, 6)] == [False, True, True, True, False]


def test_toxicity_of_held_out_documents(spark, given):
    labels = given("labels", "sf0.1")
    found = queries.op6_toxicity(spark, "/root/testdata/sf0.1").join(labels, "doc_id").filter("held_out").toPandas()
    ranks, toxic = found.score.rank(), found.toxic == 1
    auc = (ranks[toxic].sum() - toxic.sum() * (toxic.sum() + 1) / 2) / (toxic.sum() * (~toxic).sum())
    assert auc > 0.93
    assert ((found.score >= 0.5) == (found.predicted == 1)).all()
    assert (found.predicted == found.toxic).mean() > 0.96


def test_pipeline_decisions(spark, given, frame, tmp_path):
    import corpus_pipeline

    folder = str(tmp_path)
    passage = given("benchmark").first().text
    clean = [(i, f"{t} ending") for i, t in enumerate(r.text for r in given("documents").limit(12).collect())]
    rows = [*clean, (100, clean[0][1]), (101, "12 34"), (102, f"with {passage} inside"), (103, "reach me at a.b@c.de today my friend")]
    frame(rows).select(*corpus_pipeline.COLUMNS).write.parquet(f"{folder}/documents.parquet")
    given("benchmark").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, folder), "stage")
        assert docs.columns == corpus_pipeline.COLUMNS
        kept.append({r.doc_id: r for r in docs.collect()})
    assert 101 not in kept[0] and len(kept[0]) == len(rows) - 1
    wanted = brute.components([(i, r.text) for i, r in kept[0].items()], size=5, percent=80)
    assert set(kept[1]) == {i for i, (n, c) in wanted.items() if n == 0 or i == c}
    hits = brute.contaminated([(i, r.text) for i, r in kept[1].items()], [tuple(r) for r in given("benchmark").collect()])
    assert set(kept[2]) == {i for i in kept[1] if not hits[i][4]} and 102 not in kept[2]
    assert kept[3][103].text == "reach me at [EMAIL] today my friend" and kept[3][103].n_chars == len(kept[3][103].text)
    packed = corpus_pipeline.run(spark, folder)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(kept[3])
