"""Class-conditional Kneser-Ney word models of toxic and ordinary texts.

Every word and pair of words of both classes is counted and estimated. Both classes share their backoff: what discounting
takes from a word pair goes to its last word, what it takes from words to the continuation distribution, after how many
different words a word stands in either class. Rare expressions differ between classes by chance, so the log-ratio of an expression
counts by the probability that its share of toxic texts is not that of all texts. A text's score is the sum of
these per word; a logistic curve fitted on texts left out of the counts turns that into a probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm import shards
from tradewind.llm.bitmap import bitmap, held
from tradewind.llm.common import discard, read_all, steps, stored
from tradewind.llm.rest import PARTS
from tradewind.llm.words import PLAIN, grams, hashed_words, mixed, row_of

#: Expressions (words and pairs) of the model that tasks hold in memory, those in most texts; the others are looked up in shards.
MAX_EXPRESSIONS = 1 << 21
#: Likelihood-ratio statistic of an expression's numbers of texts per class at which it is as likely to differ between
#: the classes as not: twice the log of the odds against it beforehand.
EVEN_EVIDENCE = 15.0
DISCOUNT = 0.75
#: One fold of the training texts in so many fits the logistic curve and is not counted.
FOLDS, CALIBRATION_FOLD = 5, 1
SALT = np.uint64(0x5DEECE66D1CE4E5B)
#: Pairs of a word that stands more often than this are dealt by both words.
OFTEN = 1 << 18
#: The joins of all pairs are made for one of so many parts after the other, each of which frees its shuffles.
JOIN_PARTS = 3

CLASSES = ("ordinary", "toxic")
COUNTS = (*CLASSES, *(f"{c}_texts" for c in CLASSES))


@dataclass(frozen=True)
class Model:
    """What each expression adds to a text's log-ratio toxic to ordinary, as sorted keys with whole parts."""

    keys: np.ndarray
    parts: np.ndarray

    def known(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return shards.looked_up(self.keys, self.parts, keys)


def all_keys(words: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each word and pair, and its row; pairs come after all words."""
    row = row_of(borders)
    inner = np.flatnonzero(row[1:] == row[:-1])
    return np.concatenate([words, pair_keys(words)[inner]]), np.concatenate([row, row[inner]])


def pair_keys(words: np.ndarray) -> np.ndarray:
    return mixed(grams(words, 2) ^ SALT)


def pair_key(contexts: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The keys that :func:`pair_keys` gives to pairs."""
    both = np.stack([contexts, words], axis=1).ravel()
    return pair_keys(both)[::2]


def tally(keys: np.ndarray, rows: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each key first stands, by key, and its COUNTS; ``rows`` ascend, ``toxic`` is by row."""
    order = np.argsort(keys, kind="stable")  # a key's rows go on ascending
    keys, rows = keys[order], rows[order]
    at, kind = shards.runs(keys), toxic[rows]
    once = np.zeros(len(keys), np.int64)
    once[shards.runs(keys, rows)] = 1
    counts = np.zeros((len(COUNTS), len(at)), np.int64)
    if len(at):
        counts[:] = [np.add.reduceat(x, at) for x in (1 - kind, kind, once * (1 - kind), once * kind)]
    return order[at], counts


def word_counts(labelled: DataFrame) -> DataFrame:
    """COUNTS of every word: how often it stands in texts of either class, and in how many of them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            words, borders = hashed_words(batch.column(0), PLAIN)
            toxic = np.asarray(batch.column(1)).astype(np.int64)
            at, counts = tally(words, row_of(borders), toxic)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (words[at].view(np.int64), *counts)], names=["word", *COUNTS])

    found = labelled.select("text", "toxic").mapInArrow(count, ", ".join(f"{c} long" for c in ("word", *COUNTS)))
    return found.groupBy("word").agg(*[F.sum(c).alias(c) for c in COUNTS])


def pair_counts(labelled: DataFrame, words: DataFrame) -> DataFrame:
    """COUNTS of every pair: ``word`` right after ``context`` in a text.

    Pairs go to their shard by the context, so that it is sent once for all its pairs of a task, those of frequent contexts by both words.
    """
    often = words.filter(F.col(CLASSES[0]) + F.col(CLASSES[1]) > OFTEN).select("word").toArrow().column(0).to_numpy()
    n_shards = shards.shards_of(words.agg(F.sum(F.col(CLASSES[0]) + F.col(CLASSES[1]))).first()[0] or 0)

    def cut(contexts: np.ndarray, words: np.ndarray, *counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        of = shards.shard_of(np.where(np.isin(contexts, often.view(np.uint64)), pair_key(contexts, words), contexts), n_shards)
        order = np.lexsort((words, contexts, of))
        of, contexts, words, counts = of[order], contexts[order], words[order], [c[order] for c in counts]
        at = shards.runs(of, contexts, words)
        of, contexts, words, counts = of[at], contexts[at], words[at], [np.add.reduceat(c, at) for c in counts]
        borders = shards.runs(of)
        for first, last in zip(borders, np.append(borders[1:], len(of)), strict=True):
            at = shards.runs(contexts[first:last])
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (
                int(of[first]), shards.ascending(contexts[first:last][at]),
                shards.packed(np.diff(np.append(at, last - first)).astype(np.uint32)), words[first:last].tobytes(),
                *(shards.packed(c[first:last].astype(np.uint32)) for c in counts),
            )], names=[f.split()[0] for f in sent])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, n = [], 0
        for batch in steps(batches):
            words, borders = hashed_words(batch.column(0), PLAIN)
            toxic = np.asarray(batch.column(1)).astype(np.int64)
            row = row_of(borders)
            inner = np.flatnonzero(row[1:] == row[:-1])
            at, counts = tally(pair_keys(words)[inner], row[inner], toxic)
            gathered.append((words[inner[at]], words[inner[at] + 1], *counts.astype(np.uint32)))
            n += len(at)
            if n >= shards.GATHERED:
                yield from cut(*map(np.concatenate, zip(*gathered, strict=True)))
                gathered, n = [], 0
        if n:
            yield from cut(*map(np.concatenate, zip(*gathered, strict=True)))

    def meet(table: pa.Table) -> pa.Table:
        parts = []
        for batch in table.to_batches():
            for i in range(batch.num_rows):
                _, contexts, n, words, *counts = (c[i].as_py() for c in batch.columns)
                parts.append((
                    np.repeat(shards.from_ascending(contexts), shards.unpacked(n, np.uint32)), np.frombuffer(words, np.uint64),
                    *(shards.unpacked(c, np.uint32) for c in counts),
                ))
        contexts, words, *counts = map(np.concatenate, zip(*parts, strict=True))
        order = np.lexsort((words, contexts))
        contexts, words = contexts[order], words[order]
        at = shards.runs(contexts, words)
        found = pa.table([contexts[at].view(np.int64), words[at].view(np.int64), *(
            np.add.reduceat(c[order].astype(np.int64), at) for c in counts)], names=["context", "word", *COUNTS])
        return pa.Table.from_batches(found.to_batches(max_chunksize=1 << 16), found.schema)

    sent = ["shard long", "contexts binary", "pairs binary", "words binary", *(f"{c} binary" for c in COUNTS)]
    found = labelled.select("text", "toxic").mapInArrow(count, ", ".join(sent))
    return found.groupBy("shard").applyInArrow(meet, ", ".join(f"{c} long" for c in ("context", "word", *COUNTS)))


def weight(texts: dict[str, int]) -> Column:
    """The probability that an expression differs between the classes, by its numbers of texts; ``texts`` holds all."""
    every = sum(texts.values())
    n = {c: F.col(f"{c}_texts") for c in CLASSES}
    sides = [F.when(n[c] > 0, n[c] * F.ln(n[c] / ((n[CLASSES[0]] + n[CLASSES[1]]) * F.lit(texts[c] / every)))).otherwise(0.0) for c in CLASSES]
    return 1 / (1 + F.exp(F.lit(EVEN_EVIDENCE / 2) - sides[0] - sides[1]))


def discounted(n: Column, total: Column) -> Column:
    return F.when(total > 0, F.greatest(n - DISCOUNT, F.lit(0.0)) / total).otherwise(0.0)


def backoff(kinds: Column, total: Column) -> Column:
    """What discounting takes from ``kinds`` expressions, as a share of ``total``; all of it where there are none."""
    return F.when(total > 0, F.lit(DISCOUNT) * kinds / total).otherwise(1.0)


def whole(value: Column) -> Column:
    return F.round(value * PARTS).cast("long").alias("parts")


def expressions(labelled: DataFrame, spent: tuple[DataFrame, ...] = ()) -> DataFrame:
    """Estimate both classes from ``labelled`` (text, toxic 0/1): ``key, parts, texts`` of every word and pair in any text.

    A pair's value is what it adds to that of its last word. Texts of one class alone tell no expression from another, so there
    are none then. Tables ``spent`` are discarded once the texts are counted.
    """
    texts = dict.fromkeys(CLASSES, 0) | {CLASSES[r.toxic]: r.n for r in labelled.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not all(texts.values()):
        discard(*spent)
        return labelled.sparkSession.createDataFrame([], "key long, parts long, texts long")
    words = stored(word_counts(labelled), "words")
    pairs = stored(pair_counts(labelled, words), "pairs")
    discard(*spent)

    # Of words: the discounted counts of the class, above the share of all different pairs that end in the word.
    contexts = pairs.groupBy(F.col("context").alias("word")).agg(
        *[F.sum(c).alias(f"{c}_total") for c in CLASSES], *[F.sum((F.col(c) > 0).cast("long")).alias(f"{c}_kinds") for c in CLASSES])
    before = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("before"))
    vocabulary = stored(words.join(before, "word", "left").join(contexts, "word", "left").fillna(0).withColumn(
        "before", F.greatest("before", F.lit(1))), "vocabulary")
    discard(words)
    of_all = vocabulary.agg(
        F.sum("before").alias("before"), *[F.sum(c).alias(c) for c in CLASSES],
        *[F.sum((F.col(c) > 0).cast("long")).alias(f"{c}_kinds") for c in CLASSES]).first()
    p = {c: discounted(F.col(c), F.lit(of_all[c])) + backoff(F.lit(of_all[f"{c}_kinds"]), F.lit(of_all[c])) * F.col("before") / of_all["before"]
         for c in CLASSES} if of_all["before"] else dict.fromkeys(CLASSES, F.lit(1.0))
    value = weight(texts) * (F.ln(p["toxic"]) - F.ln(p["ordinary"]))
    n_texts = (F.col(COUNTS[2]) + F.col(COUNTS[3])).alias("texts")
    lower = vocabulary.select("word", value.alias("value"), *[p[c].alias(f"{c}_p") for c in CLASSES])
    kinds = vocabulary.select(F.col("word").alias("context"), *[f"{c}_{n}" for c in CLASSES for n in ("total", "kinds")])

    # Of pairs: the discounted counts of the class after the context, above the probability of the last word.
    above = {c: discounted(F.col(c), F.col(f"{c}_total")) + backoff(F.col(f"{c}_kinds"), F.col(f"{c}_total")) * F.col(f"{c}_p") for c in CLASSES}
    added = weight(texts) * (F.ln(above["toxic"]) - F.ln(above["ordinary"]) - F.col("value"))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = pair_key(*(np.asarray(batch.column(c)).view(np.uint64) for c in (0, 1)))
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), *batch.columns[2:]], names=["key", "parts", "texts"])

    found = [stored(vocabulary.select(F.col("word").alias("key"), whole(value), n_texts), "expressions")]
    for part in range(JOIN_PARTS):
        mine = lambda c: F.pmod(F.xxhash64(c), F.lit(JOIN_PARTS)) == part
        joined = pairs.filter(mine("context")).join(kinds.filter(mine("context")), "context").join(lower, "word")
        joined = joined.select("context", "word", whole(added), n_texts)
        found.append(stored(joined.mapInArrow(keyed, "key long, parts long, texts long"), "expressions"))
    discard(vocabulary, pairs)
    return read_all(found)


def most_common(every: DataFrame, n: int) -> Column | None:
    """Which ``n`` expressions stand in most texts, of those in equally many the ones with the least keys; None if there are no more."""
    tiers = sorted(every.groupBy("texts").agg(F.count(F.lit(1)).alias("n")).collect(), key=lambda r: -r.texts)
    left = n
    for tier in tiers:
        if tier.n > left:
            break
        left -= tier.n
    else:
        return None
    same = every.filter(F.col("texts") == tier.texts)
    for piece in sorted(same.groupBy(F.shiftright("key", 48).alias("at")).agg(F.count(F.lit(1)).alias("n")).collect()):
        if piece.n > left:
            break
        left -= piece.n
    keys = same.filter(F.shiftright("key", 48) == piece["at"]).select("key").toArrow().column(0).to_numpy()
    first_out = int(np.sort(keys)[left])
    return (F.col("texts") > tier.texts) | ((F.col("texts") == tier.texts) & (F.col("key") < first_out))


def fit(labelled: DataFrame, spent: tuple[DataFrame, ...] = ()) -> tuple[Model, DataFrame | None]:
    """The expressions that tasks hold, and all others (key, parts) if there are any; ``spent`` as in :func:`expressions`."""
    every = expressions(labelled, spent)
    common = most_common(every, MAX_EXPRESSIONS)
    top = (every if common is None else every.filter(common)).select("key", "parts").toArrow()
    key = top.column("key").to_numpy().view(np.uint64)
    order = np.argsort(key)
    model = Model(key[order], top.column("parts").to_numpy()[order])
    if common is None:
        discard(*getattr(every, "tables", ()))
        return model, None
    others = every.filter(~common).select("key", "parts")
    others.tables = every.tables
    return model, others


def ratios(docs: DataFrame, model: Model, others: DataFrame | None, keep: list[str]) -> DataFrame:
    """``keep`` and each text's mean log-ratio per word, 0 without words."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    chosen = docs.select(*keep, "text")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in chosen.drop("text").schema)

    def keys_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        words, borders = hashed_words(texts, PLAIN)
        return *all_keys(words, borders), np.diff(borders)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            at = batch.schema.get_field_index("text")
            keys, rows, n = keys_of(batch.column(at))
            total = np.bincount(rows, sent.value.known(keys)[1], len(n)).astype(np.int64)
            yield batch.remove_column(at).append_column("parts", pa.array(total)).append_column("n", pa.array(n))

    if others is None:
        scored = chosen.mapInArrow(score, f"{schema}, parts long, n long")
    else:
        scored = shards.sums(chosen, keys_of, lambda keys: sent.value.known(keys), others)
    return scored.select(*keep, (F.col("parts") / F.greatest("n", F.lit(1)) / PARTS).alias("ratio"))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and intercept by Newton steps with a weak pull of the slope to 0."""
    if not len(x) or not weight[y == 1].sum() or not weight[y == 0].sum():
        return 1.0, -2.0
    scale = max(float(np.sqrt(np.average((x - np.average(x, weights=weight)) ** 2, weights=weight))), 1e-9)
    design = np.stack([x / scale, np.ones(len(x))], axis=1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (weight * (y - p)) - np.array([1e-3, 0]) * beta
        hessian = design.T @ (design * (weight * p * (1 - p))[:, None]) + np.diag([1e-3, 1e-9])
        step = np.linalg.solve(hessian, gradient)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0] / scale), float(beta[1])


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, score, predicted, ratio`` of every text; ``labels`` holds the training rows (doc_id, toxic).

    Uses ``doc_id`` and ``text`` of ``docs`` alone, so other columns may have any name. A null or empty
    text has ratio 0. A label of null or of a missing document is left out, one other than 0 counts as 1;
    of repeated labels of a document the largest counts. Without labels every score is that of the prior.
    """
    wanted = labels.filter("toxic is not null and doc_id is not null").groupBy(
        F.col("doc_id").cast("long").alias("doc_id")
    ).agg(F.max((F.col("toxic") != 0).cast("int")).alias("toxic"))
    wanted = stored(wanted, "labels")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    sent = bitmap(wanted.select(F.xxhash64("doc_id").alias("h")), "h")

    def labelled_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(held(sent.value, batch.column(2).to_numpy()))).remove_column(2)

    near = texts.withColumn("h", F.xxhash64("doc_id")).mapInArrow(labelled_only, "doc_id long, text string")
    training = stored(near.join(wanted, "doc_id"), "labelled")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS
    model, others = fit(training.filter(fold != CALIBRATION_FOLD), (training,))
    scored = stored(ratios(texts, model, others, ["doc_id"]), "ratios")
    discard(*getattr(others, "tables", ()))
    # Ratios in thousandths: a bounded histogram, as nearly all lie between -1 and 1.
    held_out = scored.join(wanted.filter(fold == CALIBRATION_FOLD), "doc_id")
    step = F.round(F.greatest(F.least("ratio", F.lit(20.0)), F.lit(-20.0)), 3)
    histogram = held_out.groupBy(step.alias("ratio"), "toxic").agg(F.count(F.lit(1)).alias("n")).orderBy("ratio", "toxic").toArrow()
    slope, intercept = logistic(*(histogram.column(c).to_numpy().astype(float) for c in ("ratio", "toxic", "n")))
    score = 1 / (1 + F.exp(F.greatest(F.least(-(F.col("ratio") * slope + intercept), F.lit(40.0)), F.lit(-40.0))))
    return scored.withColumn("score", score).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
