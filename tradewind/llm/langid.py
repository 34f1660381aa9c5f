"""Language ID: interpolated Kneser-Ney character models, one per language.

Texts count as lower-case letters with single spaces between runs of them. Four-character sequences are
counted by Spark; lower orders use continuation counts, so the model follows from those counts alone. Each
order is a sorted array of packed sequences with one log-probability per language. The language of least
cross-entropy per character wins. Tasks hold the most frequent sequences of four; what the others add to a
text's sums is joined to it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm import rest
from tradewind.llm.common import steps, stored

ORDER = 4
DISCOUNT = 0.75
#: Sequences per language that tasks hold in memory, the most frequent ones; the others are joined.
MAX_GRAMS = 200_000
#: Bytes of text that one step works on; its arrays take some hundred times as much.
STEP = 1 << 20
UNKNOWN = "und"
#: Sharpness of the score: natural units of cross-entropy per character are multiplied by it.
SHARPNESS = 8.0
#: Letters beyond the basic plane count as one.
OTHER_LETTER = 0xFFFF
SPACE = 0x20
SHIFT = 16

_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Which code points are letters; built once per worker."""
    if not _letters:
        _letters.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _letters[0]


def characters(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normalised characters of all texts, where each begins, and whether it has a letter."""
    raw = [(t or "").lower() for t in texts]
    points = np.frombuffer("".join(raw).encode("utf-32-le", "surrogatepass"), np.uint32)
    borders = np.concatenate([[0], np.cumsum([len(t) for t in raw])])
    is_letter = letters()[points]
    row = np.repeat(np.arange(len(raw)), np.diff(borders))
    has = np.bincount(row[is_letter], minlength=len(raw)) > 0
    kept = is_letter.copy()
    if len(points) > 1:  # one space after each run of letters that goes on in the same text
        kept[1:] |= ~is_letter[1:] & is_letter[:-1] & (row[1:] == row[:-1])
    out = np.where(is_letter, np.minimum(points, OTHER_LETTER), SPACE).astype(np.uint64)[kept]
    # Each text begins with a space of its own.
    sizes = np.bincount(row[kept], minlength=len(raw))
    begins = np.concatenate([[0], np.cumsum(sizes + 1)])
    full = np.full(begins[-1], SPACE, np.uint64)
    full[np.arange(len(out)) + np.repeat(np.arange(len(raw)), sizes) + 1] = out
    return full, begins, has


def sequences(points: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each run of four characters within one text, packed in 64 bits, and its text."""
    if len(points) < ORDER:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    packed = points[: len(points) - ORDER + 1].copy()
    for k in range(1, ORDER):
        packed = (packed << np.uint64(SHIFT)) | points[k : len(points) - ORDER + 1 + k]
    row = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
    inside = row[: len(packed)] == row[ORDER - 1 :]
    return packed[inside], row[: len(packed)][inside]


def count_sequences(labelled: DataFrame) -> DataFrame:
    """Occurrences of each sequence per language of ``labelled`` (text, lang)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, size=STEP):
            langs = batch.column(batch.schema.get_field_index("lang")).to_pylist()
            packed, row = sequences(*characters(batch.column(batch.schema.get_field_index("text")).to_pylist())[:2])
            names, kinds = np.unique(np.array(langs, object), return_inverse=True)
            for i, name in enumerate(names.tolist()):
                grams, n = np.unique(packed[kinds[row] == i], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(n)],
                    names=["lang", "gram", "n"],
                )

    counted = labelled.select("text", "lang").mapInArrow(count, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Level:
    """One order: sorted sequences with log-probabilities, sorted contexts with log backoff weights."""

    grams: np.ndarray
    logs: np.ndarray
    contexts: np.ndarray
    backoff: np.ndarray


@dataclass(frozen=True)
class Model:
    langs: tuple[str, ...]
    levels: tuple[Level, ...]  # longest first
    floor: np.ndarray  # log-probability of a character never seen

    def logs_of(self, packed: np.ndarray, level: int = 0) -> np.ndarray:
        """Log-probability of the last character of each sequence, by language."""
        if level == len(self.levels):
            return np.broadcast_to(self.floor, (len(packed), len(self.langs)))
        here = self.levels[level]
        wanted = packed & np.uint64((1 << SHIFT * (ORDER - level)) - 1)
        at = np.minimum(np.searchsorted(here.grams, wanted), len(here.grams) - 1)
        out = here.logs[at]
        missing = np.flatnonzero(here.grams[at] != wanted)
        if len(missing):
            lower = self.logs_of(wanted[missing], level + 1)
            context = wanted[missing] >> np.uint64(SHIFT)
            place = np.minimum(np.searchsorted(here.contexts, context), len(here.contexts) - 1)
            weight = np.where((here.contexts[place] == context)[:, None], here.backoff[place], 0.0)
            out[missing] = lower + weight
        return out

    def totals(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sum of log-probabilities by text and language, their number, and whether a text has a letter."""
        points, begins, has = characters(texts)
        packed, row = sequences(points, begins)
        total = np.zeros((len(texts), len(self.langs)))
        n = np.bincount(row, minlength=len(texts))
        distinct, which = np.unique(packed, return_inverse=True)
        logs = self.logs_of(distinct)
        for i in range(len(self.langs)):
            total[:, i] = np.bincount(row, logs[which, i], len(texts))
        short = np.flatnonzero(has & (n == 0))  # fewer than four characters: the last ones by lower orders
        for t in short.tolist():
            own = points[begins[t] : begins[t + 1]]
            for k in range(1, len(own)):
                value = sum(int(c) << SHIFT * (k - j) for j, c in enumerate(own[: k + 1].tolist()))
                total[t] += self.logs_of(np.array([value], np.uint64), ORDER - 1 - k)[0]
            n[t] = len(own) - 1
        return total, n, has


@dataclass(frozen=True)
class Whole:
    """One language's counts over all its sequences of four, where tables hold some of them only."""

    shorter: tuple[np.ndarray, np.ndarray]  # sorted sequences of three, and in how many contexts each stands
    contexts: tuple[np.ndarray, np.ndarray, np.ndarray]  # sorted contexts, their occurrences and distinct sequences


def estimate(langs: list[str], tables: list[tuple[np.ndarray, np.ndarray]], whole: list[Whole] | None = None) -> Model:
    """Kneser-Ney models from each language's sorted sequences and counts."""
    levels: list[Level] = []
    sizes = range(ORDER, 0, -1)
    counts = {}
    for i, (grams, n) in enumerate(tables):
        counts[i, ORDER] = grams, n.astype(float)
        for size in range(ORDER - 1, 0, -1):  # in how many contexts each shorter sequence stands
            shorter = counts[i, size + 1][0] & np.uint64((1 << SHIFT * size) - 1)
            grams_below, n_below = whole[i].shorter if whole and size == ORDER - 1 else np.unique(shorter, return_counts=True)
            counts[i, size] = grams_below, n_below.astype(float)
    floor = np.array([-np.log(max(len(counts[i, 1][0]), 1) + 1.0) for i in range(len(langs))])
    for size in reversed(sizes):
        grams = np.unique(np.concatenate([counts[i, size][0] for i in range(len(langs))]))
        beyond = [w.contexts[0] for w in whole or [] if size == ORDER]
        contexts = np.unique(np.concatenate([grams >> np.uint64(SHIFT), *beyond]))
        below = Model(tuple(langs), tuple(levels), floor)
        logs, backoff = np.zeros((len(grams), len(langs))), np.zeros((len(contexts), len(langs)))
        lower = _shifted(below, grams, size)
        for i in range(len(langs)):
            own, n = counts[i, size]
            context = np.searchsorted(contexts, own >> np.uint64(SHIFT))
            total = np.bincount(context, n, len(contexts))
            kinds = np.bincount(context, minlength=len(contexts))
            if beyond:
                at, (_, all_n, all_kinds) = np.searchsorted(contexts, beyond[i]), whole[i].contexts
                total, kinds = np.zeros(len(contexts)), np.zeros(len(contexts))
                total[at], kinds[at] = all_n, all_kinds
            weight = np.where(total > 0, DISCOUNT * kinds / np.maximum(total, 1), 1.0)
            backoff[:, i] = np.log(weight)
            kept = np.zeros(len(grams))
            kept[np.searchsorted(grams, own)] = np.maximum(n - DISCOUNT, 0) / total[context]
            logs[:, i] = np.log(kept + weight[np.searchsorted(contexts, grams >> np.uint64(SHIFT))] * np.exp(lower[:, i]))
        levels.insert(0, Level(grams, logs, contexts, backoff))
    return Model(tuple(langs), tuple(levels), floor)


def _shifted(below: Model, grams: np.ndarray, size: int) -> np.ndarray:
    """Log-probabilities by the shorter orders, whose levels begin at index 0 of ``below``."""
    if not below.levels:
        return np.broadcast_to(below.floor, (len(grams), len(below.langs)))
    full = Model(below.langs, (None,) * (ORDER - size + 1) + below.levels, below.floor)  # type: ignore[arg-type]
    return full.logs_of(grams & np.uint64((1 << SHIFT * (size - 1)) - 1), ORDER - size + 1)


def sorted_table(df: DataFrame, key: str, *columns: str) -> tuple[np.ndarray, ...]:
    found = df.select(key, *columns).toArrow()
    keys = found.column(0).to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return keys[order], *(found.column(c).to_numpy()[order] for c in columns)


def others(counted: DataFrame, langs: list[str], model: Model, whole: list[Whole], held: DataFrame) -> DataFrame:
    """Sequences that ``model`` does not hold: ``key``, and ``value``, what each adds by language to what the backoff gives it."""
    totals = np.zeros((len(model.levels[0].contexts), len(langs)))
    for i, w in enumerate(whole):
        totals[np.searchsorted(model.levels[0].contexts, w.contexts[0]), i] = w.contexts[1]
    sent = counted.sparkSession.sparkContext.broadcast((model, totals))

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, totals = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            grams = batch.column(0).to_numpy().view(np.uint64)
            n = batch.column(1).flatten().to_numpy().reshape(len(grams), -1)
            at = np.searchsorted(model.levels[0].contexts, grams >> np.uint64(SHIFT))
            kept = np.maximum(n - DISCOUNT, 0) / np.maximum(totals[at], 1)
            backoff = model.logs_of(grams)
            value = np.log(kept + np.exp(backoff)) - backoff
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(list(value), pa.list_(pa.float64()))], names=["key", "value"])

    by_lang = [F.sum(F.when(F.col("lang") == lang, F.col("n")).otherwise(0)) for lang in langs]
    rows = counted.join(F.broadcast(held), "gram", "left_anti").groupBy("gram").agg(F.array(*by_lang).alias("n"))
    return stored(rows.mapInArrow(values, "key long, value array<double>"), "others")


def fit(labelled: DataFrame) -> tuple[Model | None, DataFrame | None]:
    """The model of all rows of ``labelled`` (text, lang not null), None without any sequence; and the sequences beyond
    what it holds, with values to add, if there are any. Those of up to three characters are held whole."""
    counted = stored(count_sequences(labelled), "grams")
    sizes = {r["lang"]: r["count"] for r in counted.groupBy("lang").count().collect()}
    langs = sorted(sizes)
    if not langs:
        return None, None
    of = [counted.filter(F.col("lang") == lang) for lang in langs]
    top = [c.orderBy(F.desc("n"), "gram").limit(MAX_GRAMS) for c in of]
    tables = [sorted_table(t, "gram", "n") for t in top]
    if max(sizes.values()) <= MAX_GRAMS:
        return estimate(langs, tables), None
    # A sequence is held for all languages or for none.
    grams = np.unique(np.concatenate([t[0] for t in tables]))
    held = counted.sparkSession.createDataFrame(pa.table({"gram": grams.view(np.int64)}))
    tables = [sorted_table(c.join(F.broadcast(held), "gram", "left_semi"), "gram", "n") for c in of]
    low = F.col("gram").bitwiseAND(F.lit((1 << SHIFT * (ORDER - 1)) - 1))
    whole = [Whole(
        sorted_table(c.groupBy(low.alias("gram")).agg(F.count(F.lit(1)).alias("n")), "gram", "n"),
        sorted_table(c.groupBy(F.shiftrightunsigned("gram", SHIFT).alias("gram")).agg(
            F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds")), "gram", "n", "kinds"),
    ) for c in of]
    model = estimate(langs, tables, whole)
    return model, others(counted, langs, model, whole, held)


def detect(docs: DataFrame, training: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of ``docs`` with ``lang_pred, score, entropy, rejected``.

    ``training`` holds ``text`` and ``lang``; rows without either do not count. A text that is null or has no
    letter is ``und`` with score 0 and rejected, and so is every text if nothing could be learnt. The score
    is the winner's share of ``exp(-SHARPNESS * cross-entropy)``; of equal languages the first by name wins.
    A text is rejected besides where its cross-entropy is above the worst of all training texts under their
    own language: nothing that is like any training text is rejected. Repeated rows get equal results;
    an empty table gives no rows.
    """
    keep = keep or ["doc_id"]
    training = training.filter("lang is not null and text is not null").select("text", "lang")
    model, beyond = fit(training)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def results(total: np.ndarray, n: np.ndarray, has: np.ndarray, own: list[str] | None = None) -> tuple[list, np.ndarray, np.ndarray]:
        if sent.value is None:
            return [UNKNOWN] * len(n), np.zeros(len(n)), np.zeros(len(n))
        entropy = -total / np.maximum(n, 1)[:, None]
        if own is not None:
            at = np.searchsorted(np.array(sent.value.langs), own)
            return [], np.zeros(0), np.where(has, entropy[np.arange(len(n)), at], 0.0)
        best = entropy.argmin(axis=1)
        least = entropy[np.arange(len(n)), best]
        share = 1 / np.exp(-SHARPNESS * (entropy - least[:, None])).sum(axis=1)
        names = [sent.value.langs[b] if h else UNKNOWN for b, h in zip(best.tolist(), has.tolist(), strict=True)]
        return names, np.where(has, share, 0.0), np.where(has, least, 0.0)

    def totals(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if sent.value is None:
            return np.zeros((len(texts), 0)), np.zeros(len(texts)), np.zeros(len(texts), bool)
        return sent.value.totals(texts.to_pylist())

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each row with the sums of the sequences that tasks hold, in place of its text."""
        for batch in steps(batches, "__text", STEP):
            at = batch.schema.get_field_index("__text")
            total, n, has = totals(batch.column(at))
            yield batch.remove_column(at).append_column(
                "__total", pa.array(list(total), pa.list_(pa.float64()))).append_column(
                "__n", pa.array(n.astype(np.int64))).append_column("__has", pa.array(has))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, tuple]]:
        """Rows as they are, and their sums: from the text, or from those of all sequences."""
        if beyond_schema is None:
            for batch in steps(batches, "__text", STEP):
                at = batch.schema.get_field_index("__text")
                yield batch.remove_column(at), totals(batch.column(at))
        else:
            for batch in batches:
                total, n, has = (batch.column(batch.schema.get_field_index(c)) for c in ("__total", "__n", "__has"))
                total = total.flatten().to_numpy().reshape(batch.num_rows, -1)
                yield batch.select(list(range(batch.num_columns - 3))), (total, n.to_numpy(), np.asarray(has))

    def worst(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sums in measured(batches):
            _, _, least = results(*sums, batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([least.max() if len(least) else 0.0])], names=["entropy"])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sums in measured(batches):
            names, score, least = results(*sums)
            yield batch.append_column("lang_pred", pa.array(names, pa.string())).append_column(
                "score", pa.array(score)).append_column("entropy", pa.array(least))

    beyond_schema = None if beyond is None else "__total array<double>, __n long, __has boolean"

    def with_sums(rows: DataFrame) -> DataFrame:
        """``rows`` with their text, or with the sums over all sequences in its place."""
        if beyond is None:
            return rows
        kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.drop("__text").schema)
        keys = ", ".join(f"{c} long" for c in rest.TEXT_KEY)
        found = rows.select("*", *rest.text_key(F.col("__text"))).select(
            *rows.drop("__text").columns, *rest.TEXT_KEY, "__text").mapInArrow(summed, f"{kept}, {keys}, {beyond_schema}")
        keys_of = lambda texts: sequences(*characters(texts.to_pylist())[:2])
        more = rest.sums(rows.select(F.col("__text").alias("text")), keys_of, beyond, len(model.langs), STEP)
        added = F.zip_with("__total", "__more", lambda a, b: a + b / rest.PARTS)
        return found.join(more, rest.TEXT_KEY, "left").withColumn(
            "__total", F.when(F.col("__more").isNull(), F.col("__total")).otherwise(added)).select(
            *rows.drop("__text").columns, "__total", "__n", "__has")

    limit = 0.0
    if model is not None:
        own = with_sums(training.select("lang", F.col("text").alias("__text")))
        limit = own.mapInArrow(worst, "entropy double").agg(F.max("entropy")).first()[0] or 0.0
    found = with_sums(docs.select(*keep, F.col("text").alias("__text"))).mapInArrow(
        predict, f"{schema}, lang_pred string, score double, entropy double"
    )
    return found.withColumn("rejected", (F.col("lang_pred") == UNKNOWN) | (F.col("entropy") > limit))
