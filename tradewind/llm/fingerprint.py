"""Document fingerprints: a homomorphic multiset hash of paragraphs.

A paragraph's vector sums what its pairs of neighbouring words (line borders included) and the paragraph as
a whole are hashed to; a document's vector sums those of its paragraphs. All sums are modulo powers of
two, so the order of paragraphs doesn't matter, and a paragraph is inserted or deleted by adding or
subtracting its vector. Sixteen-bit lanes count set bits of the hashes and are close for texts that share much;
thirty-two-bit lanes sum scrambled hashes and decide equality. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.common import stored

#: Counters, two to a sum of longs; each is a lane modulo 2 ** 16 of the fingerprint.
LANES = 64
#: Lanes modulo 2 ** 32 that decide equality, two to a scrambled hash.
EXACT = 8
PAIR = 0x0000000100000001
LOW = 0xFFFFFFFF


def features(text: Column) -> Column:
    """Hashes of the pairs of neighbouring words and of the paragraphs of a text."""
    words = F.split(F.replace(F.concat(F.lit("\n"), text, F.lit("\n")), F.lit("\n"), F.lit(" \n ")), " ")
    n = F.size(words) - 1
    pairs = F.zip_with(F.slice(words, F.lit(1), n), F.slice(words, F.lit(2), n), lambda a, b: F.xxhash64(a, b))
    whole = F.transform(F.split(text, "\n"), lambda p: F.xxhash64(F.lit("paragraph"), p))
    return F.concat(pairs, whole)


def sums(h: Column) -> list[Column]:
    """The sums that make the vector of all features in a group."""
    counters = [F.sum(F.shiftrightunsigned(h, i).bitwiseAND(F.lit(PAIR))).alias(f"c{i}") for i in range(LANES // 2)]
    exact = []
    for k in range(EXACT // 2):
        scrambled = F.xxhash64(h, F.lit(k))
        exact += [F.sum(scrambled.bitwiseAND(F.lit(LOW))).alias(f"e{2 * k}"), F.sum(F.shiftrightunsigned(scrambled, 32)).alias(f"e{2 * k + 1}")]
    return [F.count(h).alias("n"), *counters, *exact]


def vector() -> Column:
    """The sums as one array: number of features, lanes modulo 2 ** 16, exact lanes modulo 2 ** 32."""
    low = [F.col(f"c{i}").bitwiseAND(F.lit(0xFFFF)) for i in range(LANES // 2)]
    high = [F.shiftrightunsigned(F.col(f"c{i}"), 32).bitwiseAND(F.lit(0xFFFF)) for i in range(LANES // 2)]
    exact = [F.col(f"e{i}").bitwiseAND(F.lit(LOW)) for i in range(EXACT)]
    return F.array(F.col("n").bitwiseAND(F.lit(LOW)), *low, *high, *exact)


def text_of(vector: Column) -> Column:
    """Lower-case hex of a vector, of fixed width."""
    sized = F.transform(vector, lambda x, i: F.lpad(F.hex(x), F.when((i == 0) | (i > LANES), 8).otherwise(4), F.lit("0")))
    return F.lower(F.array_join(sized, ""))


def packed(vector: Column) -> Column:
    """A vector as bytes of fixed width, the form in which it is stored and moved."""
    return F.unhex(text_of(vector))


def counters(packed: Column) -> Column:
    """The number of features and the counters of a packed vector."""
    digits = F.hex(packed)
    number = lambda start, width: F.conv(F.substr(digits, start, F.lit(width)), 16, 10).cast("long")
    return F.concat(F.array(number(F.lit(1), 8)), F.transform(F.sequence(F.lit(0), F.lit(LANES - 1)), lambda i: number(9 + 4 * i, 4)))


def centred(vector: Column) -> Column:
    """The counters of a vector about their mean, whose distance from it is far below 2 ** 15."""
    mean = F.shiftright(vector[0], 1)
    wrapped = lambda x: F.pmod(x - mean + F.lit(1 << 15), F.lit(1 << 16)) - F.lit(1 << 15)
    return F.transform(F.slice(vector, 2, LANES), lambda x: wrapped(x).cast("double"))


def likeness(a: Column, b: Column) -> Column:
    """Cosine of two vectors' counters about their means, cut off at 0; 1 for equal vectors."""
    xs, ys = centred(a), centred(b)
    product = lambda p, q: F.aggregate(F.zip_with(p, q, lambda x, y: x * y), F.lit(0.0), lambda t, x: t + x)
    size = F.sqrt(product(xs, xs)) * F.sqrt(product(ys, ys))
    cosine = F.when(size > 0, F.greatest(F.least(product(xs, ys) / size, F.lit(1.0)), F.lit(0.0))).otherwise(0.0)
    return F.when(a == b, 1.0).otherwise(cosine)


def vectors(rows: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """``keys`` and the ``vector`` of each group of rows with those keys."""
    spread = rows.select(*keys, F.explode(features(F.coalesce(F.col(text), F.lit("")))).alias("h"))
    return spread.groupBy(*keys).agg(*sums(F.col("h"))).select(*keys, vector().alias("vector"))


def successors(docs: DataFrame) -> DataFrame:
    """Each distinct doc_id with the next larger one (the smallest after the last) and its longest text's size."""
    sizes = docs.filter("doc_id is not null").groupBy("doc_id").agg(F.max(F.char_length("text")).alias("longest"))
    ordered = stored(sizes.repartitionByRange("doc_id").withColumn("part", F.spark_partition_id()), "order")
    # One row per partition: where each one and the whole begins.
    begins = ordered.groupBy("part").agg(F.min("doc_id").alias("first_id"))
    after = F.lead("first_id").over(Window.orderBy("part"))
    lowest = F.min("first_id").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    borders = begins.select("part", F.coalesce(after, lowest).alias("after_part"))
    within = F.lead("doc_id").over(Window.partitionBy("part").orderBy("doc_id"))
    follow = ordered.withColumn("within", within).join(borders, "part")
    return stored(follow.select("doc_id", F.coalesce("within", "after_part").alias("next_id"), "longest"), "next")


def with_edits(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with ``doc_id`` and rows without, as ``doc_id, text, next_id, n_chars, edited``: the last quarter replaced by the
    head of the next document.

    A document that shares its ``doc_id`` with others is followed by the next larger ``doc_id``; of the
    texts there the first in byte order counts. Without ``doc_id`` the last quarter is cut off.

    Texts are dealt by ``doc_id`` once: the heads are taken from that exchange and join it, so only heads, no more
    than a quarter of the texts, move again. What has a ``doc_id`` stays dealt by it.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    known = rows.filter("doc_id is not null").repartition("doc_id")
    order = successors(rows)
    sent = order.select(F.col("next_id").alias("of"), F.col("doc_id").alias("before_id"), F.floor(F.col("longest") / 4).cast("int").alias("size"))
    heads = known.join(sent, known["doc_id"] == sent["of"]).groupBy("before_id").agg(F.min(F.left("text", F.col("size"))).alias("head"))
    follow = order.select(F.col("doc_id").alias("own_id"), "next_id")
    joined = known.join(heads, known["doc_id"] == heads["before_id"], "left").join(follow, F.col("doc_id") == F.col("own_id"))
    alone = rows.filter("doc_id is null").withColumns({"next_id": F.lit(None).cast("long"), "head": F.lit(None).cast("string")})
    return edited(joined), edited(alone)


def edited(rows: DataFrame) -> DataFrame:
    """``doc_id, text, next_id, n_chars, edited`` from rows with ``head``."""
    n = F.char_length("text")
    quarter = F.floor(n / 4).cast("int")
    text = F.concat(F.left("text", n - quarter), F.left(F.coalesce("head", F.lit("")), quarter))
    return rows.select("doc_id", "text", "next_id", n.cast("long").alias("n_chars"), text.alias("edited"))


def both_vectors(rows: DataFrame) -> DataFrame:
    """``doc_id, next_id, n_chars, edited_hash, own, edit, near_edited``: the packed vectors of the texts of :func:`edited` rows.

    Rows that are dealt by ``doc_id`` stay so: their features are summed where they are.
    """
    both = rows.withColumn("row", F.monotonically_increasing_id()).select(
        "doc_id", "row", "next_id", "n_chars", F.unhex(F.sha2("edited", 256)).alias("edited_hash"),
        F.explode(F.array(F.struct(F.lit(False).alias("is_edit"), "text"), F.struct(F.lit(True).alias("is_edit"), F.col("edited").alias("text")))).alias("one"),
    ).select("*", "one.is_edit", "one.text").drop("one")
    keys = ["doc_id", "row", "next_id", "n_chars", "edited_hash"]
    found = vectors(both, "text", [*keys, "is_edit"]).groupBy(*keys).agg(
        F.max(F.when(~F.col("is_edit"), F.col("vector"))).alias("v"), F.max(F.when(F.col("is_edit"), F.col("vector"))).alias("w")
    )
    return found.select(
        "doc_id", "next_id", "n_chars", "edited_hash", packed(F.col("v")).alias("own"), packed(F.col("w")).alias("edit"),
        likeness(F.col("v"), F.col("w")).alias("near_edited"),
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    Uses ``doc_id`` and ``text`` alone, so other columns may have any name. A null text counts as empty, and
    two empty texts have likeness 1. The next document is that of :func:`with_edits`; a row without one
    has ``near_next`` 0. An empty table gives no rows.
    """
    dealt, alone = with_edits(docs)
    # Stored apart: in one plan with the others, the exchange of texts is made twice.
    held = stored(both_vectors(dealt), "vectors").unionByName(stored(both_vectors(alone), "vectors"))
    following = held.filter("doc_id is not null").groupBy(F.col("doc_id").alias("next_id")).agg(F.min("own").alias("next_own"))
    hexed = lambda name: F.lower(F.hex(name))
    near_next = F.when(F.col("own") == F.col("next_own"), 1.0).otherwise(likeness(F.col("x"), F.col("y")))
    both = held.join(following, "next_id", "left").withColumns({"x": counters(F.col("own")), "y": counters(F.col("next_own"))})
    return both.select(
        "doc_id", "n_chars", hexed("edited_hash").alias("edited_sha256"), hexed("own").alias("fingerprint"), hexed("edit").alias("edited_fingerprint"),
        "near_edited", F.coalesce(near_next, F.lit(0.0)).alias("near_next"),
    )
