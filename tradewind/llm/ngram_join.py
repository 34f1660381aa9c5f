"""N-gram Jaccard join by grouped prefixes.

A document is its set of word shingles. Under one order of all shingles, common ones last, two sets that
are similar enough share a shingle of their prefixes. Equal sets become one node, and nodes of the same
prefix and size one group; pairs of groups that share a prefix shingle are filtered by size and by the places of
that shingle, then expanded, and their members are verified on whole sets. Links are only needed to find the
components, so the groups of a shingle are first paired with one of them. Members that then still lie in different
components are compared by sketches of parities inside tasks, in blocks, and only what these leave is verified.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.bitmap import bitmap, held
from tradewind.llm.common import discard, steps, stored
from tradewind.llm.links import components
from tradewind.llm.words import FOLDED, grams, hashed_words, mixed

#: Shingles whose frequency decides their place in the order; it moves work, not results.
MAX_COMMON = 1 << 18
#: Different sets of one task that make a shingle count as common, and counts a task holds before it drops the lowest.
COMMON_IN_TASK, HELD = 4, 1 << 21
#: Bytes of text of one step; a step's arrays are some hundred times as large.
STEP = 1 << 20
SETS = "tag long, n long, s1 long, s2 long"
#: Words of 64 bits in a sketch: the parity of the shingles hashed to each bit.
SKETCH = [f"p{i}" for i in range(32)]
#: Members of a block of a list, and its first shared shingles that tell in which of several lists a pair is given.
BLOCK, HEADS = 4096, [f"h{i}" for i in range(4)]
#: Pairs of sets that a task compares at once; pairs for each member, and so many members more, beyond which a block gives a forest of them first.
AT_ONCE, DENSE, SLACK = 1 << 16, 4, 256


def shingle_sets(batch: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of each row's ``text``, and the borders between rows."""
    words, borders = hashed_words(batch.column(batch.schema.get_field_index("text")), FOLDED)
    parts = []
    all_grams = grams(words, size)
    for first, last in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True):
        if last - first >= size:
            parts.append(np.unique(all_grams[first : last - size + 1]))
        else:
            own = words[first:last]
            parts.append(grams(own, len(own)) + np.uint64(len(own)) if len(own) else own)
    ends = np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)]).astype(np.int64)
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), ends


def sums_between(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum modulo 2 ** 64 of each row's values."""
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
        return total[ends[1:]] - total[ends[:-1]]


def signatures(sets: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size and two independent sums of each set; equal sets have equal ones."""
    return np.diff(ends), sums_between(sets, ends), sums_between(mixed(sets ^ np.uint64(0xA5A5A5A55A5A5A5A)), ends)


def sketches(sets: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One row of ``SKETCH`` words per set. Two sketches differ in no more bits than their sets in shingles."""
    h = mixed(sets ^ np.uint64(0x5BD1E9955BD1E995))
    row = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    words = np.zeros((len(ends) - 1) * len(SKETCH), np.uint64)
    place = row * len(SKETCH) + (h >> np.uint64(6)).astype(np.int64) % len(SKETCH)
    np.bitwise_xor.at(words, place, np.uint64(1) << (h & np.uint64(63)))
    return words.reshape(-1, len(SKETCH)).view(np.int64)


def common_shingles(docs: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The most common shingles, sorted, with counts; at most ``MAX_COMMON``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        pending: list[np.ndarray] = []
        told: set[tuple[int, int]] = set()

        def merge() -> None:
            nonlocal tokens, counts
            shingles, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *pending]), return_counts=True)
            pending.clear()
            tokens, place = np.unique(np.concatenate([tokens, shingles]), return_inverse=True)
            counts = np.bincount(place, np.concatenate([counts, n]), len(tokens)).astype(np.int64)
            floor = 0
            while len(tokens) > HELD:
                floor += 1
                tokens, counts = tokens[counts > floor], counts[counts > floor]

        for batch in steps(batches, size=STEP):
            sets, ends = shingle_sets(batch, size)
            _, s1, s2 = signatures(sets, ends)
            new = np.zeros(len(s1), bool)
            for i, key in enumerate(zip(s1.tolist(), s2.tolist(), strict=True)):
                new[i] = key not in told
                told.add(key)
            pending.append(sets[np.repeat(new, np.diff(ends))])
            if sum(map(len, pending)) > HELD:
                merge()
        merge()
        often = counts >= COMMON_IN_TASK
        yield pa.RecordBatch.from_arrays([pa.array(tokens[often].view(np.int64)), pa.array(counts[often])], names=["token", "n"])

    counted = docs.select("text").mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    top = counted.orderBy(F.desc("n"), "token").limit(MAX_COMMON).toArrow()
    tokens = top.column("token").to_numpy().view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], top.column("n").to_numpy()[order]


def prefixes(docs: DataFrame, sent: Broadcast, size: int, percent: int) -> DataFrame:
    """Per row: signature, group and prefix; the prefix is null where this step has told it already. ``sent`` holds the common shingles."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, counts = sent.value
        for batch in steps(batches, size=STEP):
            sets, ends = shingle_sets(batch, size)
            n, s1, s2 = signatures(sets, ends)
            bits = sketches(sets, ends)
            rank = np.zeros(len(sets), np.int64)
            if len(tokens):
                at = np.minimum(np.searchsorted(tokens, sets), len(tokens) - 1)
                rank = np.where(tokens[at] == sets, counts[at], 0)
            row = np.repeat(np.arange(len(n)), n)
            ordered = sets[np.lexsort((sets, rank, row))]
            lengths = np.where(n > 0, n - -(-percent * n // 100) + 1, 0)
            kept = np.repeat(ends[:-1], lengths) + np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            prefix = ordered[kept]
            borders = np.concatenate([[0], np.cumsum(lengths)])
            groups = mixed(sums_between(mixed(prefix ^ np.uint64(0x3C3C3C3CC3C3C3C3)), borders) ^ mixed(n.astype(np.uint64)))
            told: set[int] = set()
            lists: list[list[int] | None] = []
            raw = prefix.view(np.int64)
            for i, group in enumerate(groups.tolist()):
                new = lengths[i] > 0 and group not in told
                told.add(group)
                lists.append(raw[borders[i] : borders[i + 1]] if new else None)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(2), pa.array(n), pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64)),
                pa.array(groups.view(np.int64)), pa.array(lists, pa.list_(pa.int64())),
                *[pa.array(np.ascontiguousarray(bits[:, i])) for i in range(len(SKETCH))],
            ], names=["doc_id", "tag", "n", "s1", "s2", "grp", "prefix", *SKETCH])

    parity = ", ".join(f"{p} long" for p in SKETCH)
    return docs.mapInArrow(cut, f"doc_id long, {SETS}, grp long, prefix array<long>, {parity}")


def whole_sets(docs: DataFrame, nodes: DataFrame, sent: Broadcast, size: int) -> DataFrame:
    """``node, shingles`` of ``nodes`` (node, tag, n, s1, s2), from the texts once more; ``sent`` is a bitmap of their tags."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, size=STEP):
            batch = batch.filter(pa.array(held(sent.value, batch.column(2).to_numpy())))
            if not batch.num_rows:
                continue
            sets, ends = shingle_sets(batch, size)
            n, s1, s2 = signatures(sets, ends)
            yield pa.RecordBatch.from_arrays([
                batch.column(2), pa.array(n), pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64)),
                pa.LargeListArray.from_arrays(pa.array(ends), pa.array(sets.view(np.int64))).cast(pa.list_(pa.int64())),
            ], names=["tag", "n", "s1", "s2", "shingles"])

    found = docs.mapInArrow(emit, f"{SETS}, shingles array<long>")
    return found.join(nodes, ["tag", "n", "s1", "s2"]).select("node", "shingles")


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    both = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("x", "y"))
    union = F.size("x") + F.size("y") - shared
    return both.filter(100 * shared >= percent * union).select("a", "b")


def plausible(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sketches allow the similarity; an exact bound, so no link is lost.

    Linked sets x, y have 100 |x ^ y| <= (100 - percent) |x u y|, and |x u y| = (|x| + |y| + |x ^ y|) / 2.
    """
    sides = [
        nodes.select(F.col("node").alias(name), F.col("n").alias(f"n_{name}"), *[F.col(p).alias(f"{p}_{name}") for p in SKETCH])
        for name in ("a", "b")
    ]
    both = pairs.join(sides[0], "a").join(sides[1], "b")
    apart = sum((F.bit_count(F.col(f"{p}_a").bitwiseXOR(F.col(f"{p}_b"))) for p in SKETCH), F.lit(0))
    return both.filter((100 + percent) * apart <= (100 - percent) * (F.col("n_a") + F.col("n_b"))).select("a", "b")


def mixed_lists(lists: DataFrame) -> DataFrame:
    """The lists (``token, grp, node, n, place, root``) with members of several components, with the largest one and the numbers of blocks."""
    sizes = lists.groupBy("token", "root").agg(F.count(F.lit(1)).alias("m"))
    parts = stored(sizes.groupBy("token").agg(
        F.max_by("root", F.struct("m", "root")).alias("main"), F.max("m").alias("most"), F.sum("m").alias("members"), F.count(F.lit(1)).alias("parts")
    ).filter("parts > 1").select(
        F.col("token").alias("of"), "main", F.ceil(F.col("members") / BLOCK).cast("int").alias("wide"),
        F.ceil((F.col("members") - F.col("most")) / BLOCK).cast("int").alias("high"),
    ), "parts")
    mixed = stored(lists.join(parts, F.col("token") == F.col("of")).drop("of"), "mixed")
    discard(parts)
    return mixed


def first_shingles(apart: DataFrame) -> DataFrame:
    """The first shared shingles of each group, null beyond them.

    A shingle that two sets of different components share has a list in ``apart``, so these suffice to find the first one.
    """
    first = F.slice(F.array_sort(F.collect_set(F.struct("place", "token"))), 1, len(HEADS))["token"]
    heads = apart.filter("token <> grp").groupBy(F.col("grp").alias("of_grp")).agg(first.alias("first"))
    return stored(heads.select("of_grp", *[F.get("first", F.lit(i)).alias(h) for i, h in enumerate(HEADS)]), "heads")


def apart_in_lists(mixed: DataFrame, heads: DataFrame, nodes: DataFrame, percent: int, dense: int | None) -> DataFrame:
    """Pairs (a, b) of members of a list that lie in different components and whose sketches allow the similarity.

    Members outside of a list's largest component are compared with all of the list, in blocks of bounded size that are dealt over tasks; only
    pairs that pass leave a task, and in one list: that of their first shared shingle, or of their group. A block with more than ``dense`` such
    pairs for each member gives instead a least forest of them, the most alike first, which joins the same components; ``token`` then names
    its list, which is to be read again when the links among these are known, and is null elsewhere.
    """
    sketch = nodes.select(F.col("node").alias("own"), *SKETCH)
    values = ["node", "n", "place", "root", "grp", *HEADS, *SKETCH]
    members = mixed.join(heads, F.col("grp") == F.col("of_grp"), "left").join(sketch, F.col("node") == F.col("own"))
    members = members.withColumns({h: F.coalesce(h, F.lit(0)) for h in HEADS})
    few = F.col("root") != F.col("main")
    row, column = F.pmod("node", "high").cast("int"), F.pmod("node", "wide").cast("int")
    ranges = lambda n: F.sequence(F.lit(0), n - 1)
    every = F.transform(ranges(F.col("high")), lambda i: F.struct(i.alias("i"), column.alias("j"), F.lit(False).alias("few")))
    some = F.when(few, F.transform(ranges(F.col("wide")), lambda j: F.struct(row.alias("i"), j.alias("j"), F.lit(True).alias("few"))))
    blocks = F.explode(F.concat(every, F.coalesce(some, F.array().cast("array<struct<i:int,j:int,few:boolean>>")))).alias("at")
    dealt = members.select("token", "main", *values, blocks).select("token", "at.i", "at.j", (~F.col("at.few")).alias("other"), "main", *values)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, few_rows, met = None, np.zeros((0, len(values)), np.int64), 0
        given, forest, n_pairs, much = [], np.zeros((0, 5), np.int64), 0, False

        def told() -> pa.RecordBatch:
            ends = forest[:, :2] if much else np.concatenate([np.zeros((0, 2), np.int64), *given])
            token = pa.array(np.full(len(ends), key[0]), pa.int64(), mask=np.full(len(ends), not much))
            return pa.RecordBatch.from_arrays([token, pa.array(ends.min(axis=1)), pa.array(ends.max(axis=1))], names=["token", "a", "b"])

        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(3)], axis=1)
            other, main = batch.column(3).to_numpy(zero_copy_only=False), batch.column(4).to_numpy()
            rows = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(5, batch.num_columns)], axis=1)
            starts = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)]))
            for first, last in zip(starts.tolist(), [*starts[1:].tolist(), len(keys)], strict=True):
                if key is None or (keys[first] != key).any():
                    if n_pairs:
                        yield told()
                    key, few_rows, met = keys[first], few_rows[:0], 0
                    given, forest, n_pairs, much = [], forest[:0], 0, False
                block, late = rows[first:last], other[first:last]
                few_rows = np.concatenate([few_rows, block[~late]])
                block, met = block[late], met + len(block)
                high = max(1, AT_ONCE // max(1, len(block)))
                for begin in range(0, len(few_rows) if len(block) else 0, high):
                    some = few_rows[begin : begin + high]
                    i, j, apart = alike(some, block, main[first], percent)
                    if not len(i):
                        continue
                    n_pairs += len(i)
                    if dense is not None:
                        unlike = (apart << 32) // (some[i, 1] + block[j, 1])
                        forest = least_forest(np.concatenate([forest, np.stack([some[i, 0], block[j, 0], some[i, 3], block[j, 3], unlike], axis=1)]))
                        much = much or n_pairs > dense * (met + SLACK)
                    if much:
                        given = []
                    else:
                        here = given_in(some[i], block[j], key[0])
                        given.append(np.stack([some[i[here], 0], block[j[here], 0]], axis=1))
        if n_pairs:
            yield told()

    grouped = dealt.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j", "other")
    return stored(grouped.mapInArrow(compare, "token long, a long, b long"), "apart")


def least_forest(pairs: np.ndarray) -> np.ndarray:
    """Of pairs (a, b, root of a, root of b, unlikeness) those of a least spanning forest of the roots."""
    pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0], pairs[:, 4]))]
    roots, ends = np.unique(pairs[:, 2:4], return_inverse=True)
    ends, part, chosen = ends.reshape(-1, 2), np.arange(len(roots)), []
    left = np.arange(len(pairs))
    while True:
        sides = part[ends[left]]
        left, sides = left[sides[:, 0] != sides[:, 1]], sides[sides[:, 0] != sides[:, 1]]
        if not len(left):
            return pairs[np.sort(np.concatenate([np.zeros(0, np.int64), *chosen]))]
        # Each part takes its first pair. As no two pairs rank alike, parts can only be in a circle by two.
        first = np.full(len(roots), len(pairs))
        np.minimum.at(first, sides.T.ravel(), np.tile(left, 2))
        own = np.flatnonzero(first < len(pairs))
        chosen.append(np.unique(first[own]))
        met = part[ends[first[own]]]
        up = np.arange(len(roots))
        up[own] = np.where(met[:, 0] == own, met[:, 1], met[:, 0])
        back = (up[up] == np.arange(len(roots))) & (up > np.arange(len(roots)))
        up[back] = np.flatnonzero(back)
        while (up != up[up]).any():
            up = up[up]
        part = up[part]


def given_here(one: np.ndarray, two: np.ndarray, token: int) -> bool:
    """Whether no list before that of ``token`` is known to hold both rows."""
    if one[4] == two[4]:
        return token == one[4]
    before = []
    for row in (one, two):
        heads = row[5 : 5 + len(HEADS)].tolist()
        before.append(set(heads[: heads.index(token)] if token in heads else heads) - {0})
    return before[0].isdisjoint(before[1])


def given_in(ones: np.ndarray, twos: np.ndarray, token: int) -> np.ndarray:
    """:func:`given_here` of each two rows."""
    heads = [rows[:, 5 : 5 + len(HEADS)] for rows in (ones, twos)]
    before = [(np.cumsum(h == token, axis=1) == 0) & (h != 0) for h in heads]
    shared = (heads[0][:, :, None] == heads[1][:, None, :]) & before[0][:, :, None] & before[1][:, None, :]
    return np.where(ones[:, 4] == twos[:, 4], ones[:, 4] == token, ~shared.any(axis=(1, 2)))


def plausible_pairs(few: np.ndarray, block: np.ndarray, main: int, percent: int) -> tuple[list[int], list[int]]:
    """The places that :func:`alike` finds."""
    i, j, _ = alike(few, block, main, percent)
    return i.tolist(), j.tolist()


def alike(few: np.ndarray, block: np.ndarray, main: int, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of rows (node, n, place, root, group, first shingles, sketch words) of different components that may be similar, and bits that differ.

    Sizes, places of the shared shingle (what both sets have after it bounds what they share, where it is the first one shared) and sketches
    are exact bounds. Two rows of ``few`` also meet the other way round and are given once; rows of ``main`` are in ``block`` alone.
    """
    node, n, place, root = few[:, :4].T[:, :, None]
    both = n + block[:, 1]
    left = np.minimum(n - place, block[:, 1] - block[:, 2])
    fit = (root != block[:, 3]) & ((block[:, 3] == main) | (node < block[:, 0]))
    fit &= (100 * np.minimum(n, block[:, 1]) >= percent * np.maximum(n, block[:, 1])) & ((100 + percent) * left >= percent * both)
    i, j = np.nonzero(fit)
    both, apart = both[i, j], np.zeros(len(i), np.int64)
    first = 5 + len(HEADS)
    for words in (slice(first, first + 8), slice(first + 8, first + len(SKETCH))):
        # Of signed numbers, NumPy would count the bits of the absolute value.
        apart += np.bitwise_count((few[i, words] ^ block[j, words]).view(np.uint64)).sum(axis=1, dtype=np.int64)
        kept = (100 + percent) * apart <= (100 - percent) * both
        i, j, both, apart = i[kept], j[kept], both[kept], apart[kept]
    return i, j, apart


def fits(a: str, b: str, percent: int) -> Column:
    """Sizes close enough for similarity."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Per row: ``doc_id, n_shingles, component_id, tag, stays``; component is the smallest doc_id linked to it.

    ``tag`` is a hash of id and text; ``stays`` marks the rows of one tag in each component, that of the
    smallest id, and all rows without words.

    Words are what stands between ASCII white space, A-Z in lower case; a text of fewer than ``size`` words is
    one shingle, one without words (or null) has none and no link. Sets link from ``percent`` of their union
    on. Uses ``doc_id`` and ``text`` alone, so other columns may have any name. Repeated rows are each
    given; rows without ``doc_id`` link others, and have component null if none linked has an id; rows
    that share an id are linked only if their texts are. An empty table gives no rows.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("doc_id", "text").alias("tag")
    )
    sent = rows.sparkSession.sparkContext.broadcast(common_shingles(rows, size))
    table = stored(prefixes(rows, sent, size, percent), "prefixes")
    sent.destroy()
    key = ["n", "s1", "s2"]
    nodes = stored(
        table.filter("n > 0").groupBy(*key).agg(
            F.min("doc_id").alias("first_id"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "tag"))["tag"].alias("tag"), F.min("grp").alias("grp"),
            *[F.min(p).alias(p) for p in SKETCH],
        )
        .withColumn("node", F.monotonically_increasing_id()), "nodes",
    )

    # Prefix shingles that more than one group has.
    spread = table.filter("prefix is not null").select("grp", F.explode("prefix").alias("token"))
    both = spread.groupBy("token").agg(F.min("grp").alias("low"), F.max("grp").alias("high")).filter("low < high")
    shared = stored(both.select("token"), "shared")
    sent = bitmap(shared, "token")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            tokens = lists.flatten().to_numpy()
            rows_of = pc.list_parent_indices(lists)
            sizes = np.asarray(pc.list_value_length(lists))
            place = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            some = held(sent.value, tokens)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows_of.filter(pa.array(some))), pa.array(tokens[some]), pa.array(place[some].astype(np.int32))], names=["grp", "token", "place"]
            )

    postings = table.filter("prefix is not null").select("grp", "prefix").mapInArrow(near, "grp long, token long, place int").distinct()
    groups = stored(nodes.groupBy("grp").agg(F.min("node").alias("first"), F.min("n").alias("n"), F.count(F.lit(1)).alias("members")), "groups")
    lists = stored(postings.join(shared, "token").join(groups, "grp").select("token", "grp", "place", "n", "first"), "lists")
    signed = stored(table.select("doc_id", "tag", *key), "signed")
    discard(table, shared)
    sent.destroy()

    def checked(left: DataFrame, label: str) -> DataFrame:
        """The links among pairs, from whole sets."""
        wanted = left.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        some = stored(nodes.join(wanted, "node").select("node", "tag", *key), "wanted")
        tags = bitmap(some, "tag")
        sets = stored(whole_sets(rows, some, tags, size), "sets")
        tags.destroy()
        links = stored(verify(left, sets, percent), label)
        discard(sets, some)
        return links

    def compared(left: DataFrame, label: str) -> DataFrame:
        """Links among the pairs, which the sketches allow: all that are needed for the components; ``left`` goes.

        A node's set is first compared with one partner's; then all pairs which that leaves apart are.
        """
        one = stored(left.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "one")
        begun = checked(one, label)
        roots = stored(components(begun), "begun")
        sides = [roots.select(F.col("node").alias(name), F.col("root").alias(f"root_{name}")) for name in ("a", "b")]
        others = left.join(one, ["a", "b"], "left_anti").join(sides[0], "a", "left").join(sides[1], "b", "left")
        others = others.filter(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")
        others = stored(others, "others")
        discard(left, one, roots)
        ended = checked(others, label)
        discard(others)
        links = stored(begun.union(ended), label)
        discard(begun, ended)
        return links

    # Pairs of groups: the first one of each list and the others that fit, expanded to a member of the one and all of the other.
    heads = lists.groupBy(F.col("token").alias("of")).agg(F.min(F.struct("first", "n", "place", "grp")).alias("head"))
    left = F.least(F.col("n") - F.col("place"), F.col("head.n") - F.col("head.place"))
    stars = lists.join(heads, F.col("token") == F.col("of")).filter("grp <> head.grp").filter(fits("n", "head.n", percent))
    stars = stars.filter((100 + percent) * left >= percent * (F.col("n") + F.col("head.n")))
    stars = stars.select(F.col("head.first").alias("a"), "grp").union(groups.filter("members > 1").select(F.col("first").alias("a"), "grp")).distinct()
    members = nodes.select(F.col("grp").alias("of_grp"), F.col("node").alias("b"))
    pairs = stored(stars.join(members, F.col("grp") == F.col("of_grp")).filter("a <> b").select("a", "b"), "pairs")
    links = compared(stored(plausible(pairs, nodes, percent), "plausible"), "links")
    rooted = stored(components(links), "roots")

    # What is still apart: members of each list, and of each group, that lie in different components.
    expanded = lists.select("token", "grp", "place").union(groups.filter("members > 1").select(F.col("grp").alias("token"), "grp", F.lit(0).alias("place")))
    expanded = expanded.join(nodes.select(F.col("grp").alias("of_grp"), "node", "n"), F.col("grp") == F.col("of_grp"))
    root = rooted.select(F.col("node").alias("named"), "root")
    placed = stored(expanded.join(root, F.col("node") == F.col("named"), "left").select("token", "grp", "node", "n", "place", F.coalesce("root", "node").alias("root")), "placed")
    discard(lists, groups)
    mixed = mixed_lists(placed)
    discard(placed)
    heads = first_shingles(mixed)
    apart = apart_in_lists(mixed, heads, nodes, percent, DENSE)
    discard(rooted)
    rest = stored(apart.select("a", "b").distinct().join(pairs, ["a", "b"], "left_anti"), "rest")
    more = compared(rest, "more")
    crowded = stored(apart.filter("token is not null").select(F.col("token").alias("of")).distinct(), "crowded")
    if not crowded.isEmpty():
        # Most of these lists' members are now in one component. Only pairs of what is left are compared again, and all of them are given.
        rooted = stored(components(links.union(more)), "roots")
        root = rooted.select(F.col("node").alias("named"), "root")
        again = mixed.select("token", "grp", "node", "n", "place").join(crowded, F.col("token") == F.col("of"))
        again = again.join(root, F.col("node") == F.col("named"), "left").select("token", "grp", "node", "n", "place", F.coalesce("root", "node").alias("root"))
        again = mixed_lists(again)
        left = apart_in_lists(again, heads, nodes, percent, None)
        known = pairs.union(apart.select("a", "b"))
        rest = stored(left.select("a", "b").distinct().join(known, ["a", "b"], "left_anti"), "rest")
        begun, ended = more, compared(rest, "more")
        more = stored(begun.union(ended), "more")
        discard(rooted, again, left, begun, ended)
    discard(mixed, heads, apart, crowded)
    final = stored(components(links.union(more)), "components")
    discard(pairs, links, more)

    named = nodes.join(final, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = stored(named.groupBy("root").agg(
        F.min("first_id").alias("component_id"), F.min(F.struct(F.col("first_id").isNull(), "first_id", "tag"))["tag"].alias("first_tag")
    ), "least")
    by_node = stored(named.select(*key, "root").join(least, "root").select(*[F.col(k).alias(f"of_{k}") for k in key], "component_id", "first_tag"), "named")
    discard(nodes, final, least)
    on = [F.col(k) == F.col(f"of_{k}") for k in key]
    result = signed.join(by_node, on, "left")
    return result.select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        "tag", ((F.col("n") == 0) | (F.col("tag") == F.col("first_tag"))).alias("stays"),
    )


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without near duplicates: one row of each component, and all rows without words."""
    tagged = docs.withColumn("__tag", F.xxhash64("doc_id", "text"))
    stay = near_duplicates(docs, size, percent).filter("stays").select(F.col("tag").alias("__stays"), "n_shingles").distinct()
    held_rows = tagged.join(stored(stay, "stay"), F.col("__tag") == F.col("__stays"))
    again = F.row_number().over(Window.partitionBy("__tag").orderBy("__tag"))
    return held_rows.withColumn("__again", again).filter("__again = 1 or n_shingles = 0").select(*[F.col(f"`{c}`") for c in docs.columns])
