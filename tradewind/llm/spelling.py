"""Spelling variants by a dictionary of pairs of trie nodes.

The nodes of a trie of all words, and of one of all reversed words, are numbered. A word is then a row of pairs: at
each position the node of what stands before it and the node of what stands after it, once with the code point
there skipped and once with nothing skipped. Two words that share a pair with a code point skipped in both
differ by a replacement; one with a skip that meets one without is longer by an insertion. Node numbers stand for
whole prefixes and suffixes, so what meets is exact.

A pair has at most one word without a skip (pair and word determine each other) and one per letter of the
alphabet with one, so its members are few, whatever the words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import takewhile

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import discard, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between words, after A-Z went to lower case.
BETWEEN = "[^a-zÀ-ÿ]+"
#: How a pair was made: nothing skipped, a code point that its follower repeats, any other code point.
WHOLE, REPEATED, SKIPPED = 0, 1, 2


def word_counts(docs: DataFrame, shortest: int, fewest: int, change: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """``word, n`` of the words with ``shortest`` or more code points and ``fewest`` or more occurrences.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, with A-Z in lower case. ``change`` makes another word
    of an occurrence, given doc_id and word; it must not make it longer. Null texts have no words.
    """
    rows = docs.select("doc_id", F.explode(F.split(F.translate("text", UPPER, LOWER), BETWEEN)).alias("word"))
    rows = rows.filter(F.char_length("word") >= shortest)
    if change is not None:
        rows = rows.select(change(F.col("doc_id"), F.col("word")).alias("word")).filter(F.char_length("word") >= shortest)
    return rows.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= fewest)


def shared_start(a: str, b: str) -> int:
    return sum(1 for _ in takewhile(lambda pair: pair[0] == pair[1], zip(a, b, strict=False)))


def trie(words: DataFrame, spelt: Column) -> DataFrame:
    """``word, path``: the numbers of the nodes on the way of each word through the trie of ``spelt``; the root, 0, is left out.

    Words are sorted over all tasks. Each task numbers what its words add to those before them; what its first word shares
    with the last one before the task is put right by a table of one row per task. Numbers of whole words ascend
    with the words.
    """

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        before, path, used = "", [], 0
        for batch in batches:
            paths = []
            for text in batch.column(1).to_pylist():
                shared = shared_start(before, text)
                path = path[:shared] + list(range(used + 1, used + 1 + len(text) - shared))
                used += len(text) - shared
                before = text
                paths.append(path)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([part] * len(paths), pa.int32()), pa.array(paths, pa.list_(pa.int64())),
                pa.array([used] * len(paths), pa.int64()),
            ], names=["word", "spelt", "part", "path", "used"])

    ordered = words.select("word", spelt.alias("spelt")).repartitionByRange("spelt").sortWithinPartitions("spelt")
    numbered = stored(ordered.mapInArrow(number, "word string, spelt string, part int, path array<long>, used long"), "trie")
    ends = numbered.groupBy("part").agg(
        F.min("spelt").alias("first"), F.max("spelt").alias("last"), F.max_by("path", "spelt").alias("path"), F.max("used").alias("used")
    )
    shifts, offset, before, path = [], 0, "", []
    for end in sorted(ends.collect()):  # one row per task of the sort
        shared = path[: shared_start(before, end["first"])]
        shifts.append((end["part"], offset, shared))
        path = [shared[x - 1] if x <= len(shared) else x + offset for x in end["path"]]
        before, offset = end["last"], offset + end["used"]
    moved = words.sparkSession.createDataFrame(shifts, "of int, offset long, shared array<long>")
    right = lambda x: F.coalesce(F.get("shared", (x - 1).cast("int")), x + F.col("offset"))
    joined = numbered.join(F.broadcast(moved), F.col("part") == F.col("of"))
    out = joined.select("word", F.transform("path", right).alias("path"))
    out.stored_at = numbered.stored_at
    return out


def neighbours(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Words with numbers (``id, word, n``), and per number with near words ``id, n_near, best_n, best_id``.

    Near are words that differ by one inserted, deleted or replaced code point. The best has the largest ``n``, and of those
    the smallest ``id``, that is the first in code-point order. A code point that its follower repeats is skipped
    for replacements only, so every near word is met once.
    """
    forward, backward = trie(words, F.col("word")), trie(words, F.reverse("word"))
    both = words.join(forward, "word").join(backward.select(F.col("word").alias("same"), F.col("path").alias("back")), F.col("word") == F.col("same"))
    root = F.array(F.lit(0).cast("long"))
    placed = stored(both.select(
        F.element_at("path", -1).alias("id"), "word", "n", F.concat(root, "path").alias("path"), F.concat(root, "back").alias("back")
    ), "spellings")
    discard(forward, backward)
    size = F.size("path") - 1
    letters = F.split("word", "")
    skipped = F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.struct(
        F.get("path", i).alias("head"), F.get("back", size - 1 - i).alias("tail"),
        F.when((i < size - 1) & (F.get("letters", i) == F.get("letters", i + 1)), REPEATED).otherwise(SKIPPED).alias("kind"),
    ))
    whole = F.transform(F.sequence(F.lit(0), size), lambda i: F.struct(
        F.get("path", i).alias("head"), F.get("back", size - i).alias("tail"), F.lit(WHOLE).alias("kind")
    ))
    entries = placed.withColumn("letters", letters).select("id", "n", F.explode(F.concat(skipped, whole)).alias("pair"))
    member = F.struct("n", (-F.col("id")).alias("minus"), F.col("pair.kind").alias("kind"))
    met = entries.groupBy("pair.head", "pair.tail").agg(F.collect_list(member).alias("members")).filter(F.size("members") > 1)

    def near(own: Column) -> Column:
        return F.filter("members", lambda x: (x["minus"] != own["minus"]) & (
            ((own["kind"] != WHOLE) & (x["kind"] != WHOLE)) | ((own["kind"] == SKIPPED) & (x["kind"] == WHOLE)) | ((own["kind"] == WHOLE) & (x["kind"] == SKIPPED))
        ))

    told = met.select(F.explode(F.transform("members", lambda own: F.struct((-own["minus"]).alias("id"), near(own).alias("near")))).alias("one"))
    counted = told.filter(F.size("one.near") > 0).groupBy(F.col("one.id").alias("id")).agg(
        F.sum(F.size("one.near")).cast("long").alias("n_near"), F.max(F.array_max("one.near")).alias("best")
    )
    return placed, counted.select("id", "n_near", F.col("best.n").alias("best_n"), (-F.col("best.minus")).alias("best_id"))


def roots(forms: DataFrame) -> DataFrame:
    """``id, root``: the end of the way from each ``id`` over ``form_id``; ways double in length with every round."""
    ways = stored(forms.select("id", F.col("form_id").alias("root")), "ways")
    while True:
        on = ways.select(F.col("id").alias("via"), F.col("root").alias("further"))
        longer = stored(ways.join(on, ways["root"] == on["via"], "left").select("id", F.coalesce("further", "root").alias("root"), F.col("via").isNotNull().alias("moved")), "ways")
        discard(ways)
        ways = longer
        if ways.filter("moved").isEmpty():
            return ways


def variants(words: DataFrame, ratio: int = 5) -> DataFrame:
    """Per word of ``word, n`` (distinct words, not empty): ``word, form, root, n, n_near, form_n``.

    The form is the near word of largest ``n`` (ties: first in code-point order) if that is ``ratio`` times the word's own
    or more, else null; the root ends the way over forms and is the word itself if there is none. Other columns
    are not used. An empty table gives no rows.
    """
    given = stored(words.select("word", "n"), "words")
    placed, near = neighbours(given)
    judged = stored(placed.select("id", "word", "n").join(near, "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(F.col("best_n") >= ratio * F.col("n"), F.col("best_id")).alias("form_id"),
    ), "judged")
    discard(given, placed)
    ends = roots(judged.filter("form_id is not null"))
    names = judged.select(F.col("id").alias("name_id"), F.col("word").alias("name"), F.col("n").alias("name_n"))
    some = judged.filter("form_id is not null").join(ends.select("id", "root"), "id")
    some = some.join(names, F.col("form_id") == F.col("name_id")).select("id", "root", F.col("name").alias("form"), F.col("name_n").alias("form_n"))
    some = some.join(names, F.col("root") == F.col("name_id")).select("id", "form", "form_n", F.col("name").alias("root"))
    return judged.join(some, "id", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
