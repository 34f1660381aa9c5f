"""Benchmark decontamination through a positional inverted index of the training words.

The index is a stored table of postings (term, document, position), each file sorted by term, so a term's
postings are found by the Parquet statistics. It holds the postings of the benchmark's vocabulary; a
last posting per document, of the empty term, tells its number of words. Each phrase starts from its two
rarest terms: their lists, adjusted by their offsets in the phrase, are intersected, and what remains is
checked against the lists of all its terms. DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.common import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The term whose position is the number of words; no word is empty.
END = ""


def words_of(text: Column) -> Column:
    """Words after A-Z went to lower case; null has none."""
    whole = F.coalesce(text, F.lit(""))
    # All ASCII: the built-in lower case does the same, faster.
    ascii_only = F.octet_length(whole) == F.char_length(whole)
    folded = F.when(ascii_only, F.lower(whole)).otherwise(F.translate(whole, UPPER, LOWER))
    return F.regexp_extract_all(folded, F.lit(WORD), F.lit(0))


@dataclass(frozen=True)
class Index:
    """``terms`` (term, term_id), ``postings`` (term_id, doc, pos, doc_id) and the id of the end term."""

    terms: DataFrame
    postings: DataFrame
    end_id: int

    def documents(self) -> DataFrame:
        return self.postings.filter(F.col("term_id") == self.end_id).select("doc", "doc_id", F.col("pos").alias("n_words"))

    def frequencies(self) -> DataFrame:
        return self.postings.filter(F.col("term_id") != self.end_id).groupBy("term_id").agg(F.count(F.lit(1)).alias("n_postings"))


def phrase_words(items: DataFrame) -> DataFrame:
    """One row per word of each item: ``item`` (a number of its row), ``item_id``, ``n`` words, ``at``, ``term``."""
    rows = items.select("item_id", words_of(F.col("text")).alias("words")).withColumn("item", F.monotonically_increasing_id())
    return stored(rows.select("item", "item_id", F.size("words").cast("long").alias("n"), F.posexplode("words").alias("at", "term")), "items")


def build_index(docs: DataFrame, vocabulary: DataFrame) -> Index:
    """Postings of ``vocabulary`` (column ``term``) in every text of ``docs`` (doc_id, text).

    The vocabulary is joined without a broadcast hint: Spark broadcasts it while it is under the
    session's threshold, and shuffles postings by term beyond.
    """
    spark = docs.sparkSession
    end = spark.range(1).select(F.lit(END).alias("term"))
    terms = stored(vocabulary.select("term").distinct().union(end).withColumn("term_id", F.monotonically_increasing_id()), "terms")
    end_id = terms.filter(F.col("term") == END).first()["term_id"]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), words_of(F.col("text")).alias("words")).withColumn(
        "doc", F.monotonically_increasing_id()
    )
    spread = rows.select("doc", "doc_id", F.posexplode(F.concat("words", F.array(F.lit(END)))).alias("pos", "term"))
    postings = spread.join(terms, "term").select(
        "term_id", "doc", F.col("pos").cast("long").alias("pos"),
        F.when(F.col("term_id") == end_id, F.col("doc_id")).alias("doc_id"),
    )
    return Index(terms, stored(postings.sortWithinPartitions("term_id", "doc", "pos"), "postings"), end_id)


def phrase_matches(index: Index, phrases: DataFrame, width: int) -> DataFrame:
    """Exact places of every run of ``width`` words of an item (the whole item if shorter).

    ``phrases`` comes from :func:`phrase_words`; returns ``doc, item, item_id, start, size``, a row per run.
    """
    size = F.least(F.col("n"), F.lit(width))
    counted = phrases.join(index.terms, "term").join(index.frequencies(), "term_id", "left").withColumn("size", size)
    first = F.greatest(F.col("at") - F.col("size") + 1, F.lit(0))
    last = F.least(F.col("at"), F.col("n") - F.col("size"))
    runs = counted.select(
        "item", "item_id", "size", F.col("at").cast("long").alias("at"), "term_id", F.coalesce("n_postings", F.lit(0)).alias("postings"),
        F.explode(F.sequence(first, last)).alias("run"),
    )
    # A run is bounded by its width, and so is the window over it.
    by_rarity = Window.partitionBy("item", "run").orderBy("postings", "at")
    ranked = runs.withColumn("rank", F.row_number().over(by_rarity)).withColumn(
        "least", F.min("postings").over(Window.partitionBy("item", "run"))
    ).filter("least > 0")
    ranked = stored(ranked.drop("least", "postings"), "runs")
    rare = stored(ranked.filter("rank <= 2"), "rare")
    lists = index.postings.select("term_id", "doc", "pos")
    seeds = lists.join(rare, "term_id").groupBy("doc", "item", "run", (F.col("pos") - F.col("at")).alias("start")).agg(
        F.count(F.lit(1)).alias("held"), F.first("size").alias("size")
    ).filter(F.col("held") == F.least(F.col("size"), F.lit(2))).select("doc", "item", "run", F.col("start").alias("shift"))
    expected = stored(seeds.join(ranked, ["item", "run"]).select(
        "doc", "item", "item_id", "run", "size", "shift", "term_id", (F.col("shift") + F.col("at")).alias("pos")
    ), "expected")
    matched = lists.join(expected, ["doc", "term_id", "pos"]).groupBy("doc", "item", "run", "shift").agg(
        F.count(F.lit(1)).alias("held"), F.first("size").alias("size"), F.first("item_id").alias("item_id")
    )
    return matched.filter("held = size").select("doc", "item", "item_id", (F.col("shift") + F.col("run")).alias("start"), "size")


def proximity_matches(index: Index, phrases: DataFrame, span: int) -> DataFrame:
    """Places where all distinct words of an item stand within ``span`` words, in any order: ``doc, item, start``."""
    own = phrases.select("item", "term").distinct().join(index.terms, "term").select("item", "term_id")
    needed = phrases.groupBy("item").agg(F.countDistinct("term").alias("needed"))
    rarest = own.join(index.frequencies(), "term_id").groupBy("item").agg(F.min_by("term_id", "n_postings").alias("term_id"))
    lists = index.postings.select("term_id", "doc", "pos")
    anchors = stored(lists.join(rarest, "term_id").select("doc", "item", F.col("pos").alias("anchor")), "anchors")
    near = lists.join(own, "term_id").join(anchors, ["doc", "item"]).filter(F.abs(F.col("pos") - F.col("anchor")) < span)
    near = stored(near.select("doc", "item", "anchor", "pos", "term_id"), "near")
    starts = near.select("doc", "item", "anchor", F.col("pos").alias("start")).filter("start <= anchor")
    inside = near.join(starts, ["doc", "item", "anchor"]).filter((F.col("pos") >= F.col("start")) & (F.col("pos") < F.col("start") + span))
    counted = inside.groupBy("doc", "item", "start").agg(F.countDistinct("term_id").alias("seen"))
    return counted.join(needed, "item").filter("seen = needed").select("doc", "item", "start")


def contamination(docs: DataFrame, items: DataFrame, width: int = 10) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``.

    Uses ``doc_id`` and ``text``, ``item_id`` and ``text`` alone, so other columns may have any name. A null or
    empty text has no words: such a document has no hits, such an item no runs. Repeated rows are judged
    each on its own, repeated items count each; empty tables give no rows and no hits.
    """
    phrases = phrase_words(items)
    index = build_index(docs, phrases.select("term"))
    runs = stored(phrase_matches(index, phrases, width), "matches")
    hits = runs.select("doc", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("size") - 1)).alias("pos")).distinct()
    hit = hits.groupBy("doc").agg(F.count(F.lit(1)).alias("n_hit"))
    found = runs.select("doc", "item", "item_id").distinct().groupBy("doc").agg(
        F.count(F.lit(1)).alias("n_items"), F.array_sort(F.collect_list(F.col("item_id").cast("string"))).alias("ids")
    )
    joined = index.documents().join(hit, "doc", "left").join(found, "doc", "left")
    n_hit = F.coalesce("n_hit", F.lit(0))
    return joined.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.sha2(F.concat_ws(",", F.coalesce("ids", F.array().cast("array<string>"))), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
