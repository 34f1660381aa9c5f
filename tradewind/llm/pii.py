"""Personal data by candidate gradient boosting.

High-recall patterns propose spans, which may overlap. Boosted trees, grown over the counts of all
candidates by format and context, score them; a threshold per kind, calibrated for precision on texts the trees
have not seen, decides what is added to the spans that the strict patterns find. Secrets (keys, tokens, passwords)
have no strict pattern: the names before them are labels only, so the trees judge one without a name by its format. DataFrame functions only: the trees are one
expression of built-in functions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds in the order of the contract.
KINDS = ("email", "ip", "card", "phone")
#: All kinds of spans; those beyond the contract's are found by the trees alone.
ALL = (*KINDS, "secret")
#: Fixed patterns of the contract, written so that Java's matcher neither backtracks nor recurses on long runs.
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Generators of further candidates.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]{1,63}+(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]{1,63}+){1,5}",
    "ip": r"(?<![0-9A-Za-z.:])[0-9A-Fa-f]{1,4}+(?:[.:][0-9A-Fa-f]{1,4}+){3,7}+(?![0-9A-Za-z.:])",
    "card": r"(?<![0-9A-Za-z])[0-9]{4}(?:[ .-]?[0-9]{2,6}){2,4}(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z.+-])(?:\+|00)?\(?[0-9]{1,4}\)?(?:[ ./-]{1,2}\(?[0-9]{2,5}\)?){1,5}(?![0-9A-Za-z])",
    "secret": r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*+[0-9])(?=[0-9_-]*+[A-Za-z])[A-Za-z0-9_-]{16,}+",
}
#: Words before a span that name its kind.
NAMED = {
    "email": r"(?i)(?:e-?mail|mail|contact|write to)[ :=]{1,3}$",
    "ip": r"(?i)(?:ip|host|server|address|addr)[ :=]{1,3}$",
    "card": r"(?i)(?:card|visa|mastercard|amex|credit)(?: number| no\.?)?[ :=]{1,3}$",
    "phone": r"(?i)(?:phone|tel|telephone|call|mobile|fax|cell)(?: number| no\.?)?[ .:=]{1,3}$",
    "secret": r"(?i)(?:key|token|secret|password|passwd|pwd|credentials?)[\"']? {0,2}[:=] {0,2}[\"']?$",
}
OCTET = "^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"
CONTEXT = 32
MARK, OTHER_MARK = "\u0001", "\u0002"
#: Digits are counted up to this many in the features; no base rule asks for more.
MOST_DIGITS, MOST_GROUPS = 20, 6
#: Lengths of secrets are told apart up to this many steps of four.
MOST_STEPS = 16
#: One of so many texts is held out of the trees and calibrates their thresholds; copies of a text fall together.
FOLDS = 3
TREES, RATE = 40, 0.3
PRECISION = 0.98
SPANS = "array<struct<start:int,stop:int,value:string,before:string>>"
FEATURES = ("kind", "digits", "groups", "plus", "paren", "checksum", "octets", "named", "at", "colon", "length", "classes", "quoted")


def spans(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches with their borders in code points and the text right before them."""
    pieces = F.split(F.regexp_replace(text, pattern, f"{MARK}$0{MARK}"), MARK)
    start = F.struct(F.lit(0).alias("at"), F.lit(False).alias("inside"), F.lit("").alias("before"), F.array().cast(SPANS).alias("out"))

    def step(held: Column, piece: Column) -> Column:
        stop = held["at"] + F.char_length(piece)
        found = F.struct(held["at"].alias("start"), stop.alias("stop"), piece.alias("value"), F.right(held["before"], F.lit(CONTEXT)).alias("before"))
        out = F.when(held["inside"], F.array_append(held["out"], found)).otherwise(held["out"])
        return F.struct(stop.alias("at"), (~held["inside"]).alias("inside"), piece.alias("before"), out.alias("out"))

    return F.aggregate(pieces, start, step, lambda held: held["out"])


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def octets_fit(value: Column) -> Column:
    return F.forall(F.split(value, "\\."), lambda part: part.rlike(OCTET))


def valid(kind: str, value: Column) -> Column:
    """Whether a strict match counts."""
    digits = F.length(digits_of(value))
    return {
        "email": F.lit(True),
        "ip": octets_fit(value),
        "card": digits.between(12, 19) & F.call_function("luhn_check", digits_of(value)),
        "phone": digits.between(9, 15),
    }[kind]


def may_hold(text: Column, kind: str) -> Column:
    """Cheap tests that a text without any candidate fails."""
    if kind == "email":
        return F.contains(text, F.lit("@")) | F.contains(text, F.lit("at)")) | F.contains(text, F.lit("at]"))
    return text.rlike("[0-9]")


def guarded(text: Column) -> Column:
    """The text with the mark replaced by another control character; none of the patterns knows either."""
    whole = F.coalesce(text, F.lit(""))
    return F.when(F.contains(whole, F.lit(MARK)), F.translate(whole, MARK, OTHER_MARK)).otherwise(whole)


def with_matches(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__text`` and, for texts that may hold any, ``__base`` and ``__more``: structs of kind, span and context."""
    text = F.col("__text")

    def matches(patterns: dict[str, str], strict: bool) -> Column:
        lists = []
        for i, kind in enumerate(KINDS if strict else ALL):
            found = spans(text, patterns[kind])
            if strict:
                found = F.filter(found, lambda s: valid(kind, s["value"]))
            found = F.when(may_hold(text, kind), found).otherwise(F.array().cast(SPANS))
            lists.append(F.transform(found, lambda s: F.struct(
                s["start"].alias("start"), F.lit(i).alias("kind"), s["stop"].alias("stop"), s["value"].alias("value"), s["before"].alias("before"),
            )))
        return F.array_sort(F.concat(*lists))

    return docs.withColumn("__text", guarded(F.col("text"))).withColumn("__base", matches(STRICT, True)).withColumn("__more", matches(LOOSE, False))


def features(c: Column) -> dict[str, Column]:
    """Small whole numbers, so that all candidates fall into a bounded number of cells."""
    value, kind = c["value"], c["kind"]
    secret = kind == ALL.index("secret")
    digits = digits_of(value)
    flag = lambda x: x.cast("int")
    named = reduce(lambda a, b: a | b, [(kind == i) & c["before"].rlike(NAMED[k]) for i, k in enumerate(KINDS)])
    return {
        "kind": kind,
        "digits": F.least(F.length(digits), F.lit(MOST_DIGITS)),
        "groups": F.least(F.size(F.split(value, "[^0-9A-Za-z]+")), F.lit(MOST_GROUPS)),
        "plus": flag(F.startswith(value, F.lit("+"))),
        "paren": flag(F.contains(value, F.lit("("))),
        "checksum": flag(F.length(digits).between(12, 19) & F.call_function("luhn_check", digits)),
        "octets": flag(F.regexp_like(value, F.lit(r"^[0-9]+(?:\.[0-9]+){3}$")) & octets_fit(value)),
        "named": flag(named),
        "length": F.when(secret, F.least(F.floor(F.char_length(value) / 4), F.lit(MOST_STEPS))).otherwise(0).cast("int"),
        "classes": F.when(secret, sum((flag(value.rlike(c)) for c in ("[a-z]", "[A-Z]", "[0-9]", "[_-]")), F.lit(0))).otherwise(0),
        "quoted": F.when(secret, flag(c["before"].rlike("[\"']$"))).otherwise(0),
        "at": flag(F.contains(value, F.lit("@"))),
        "colon": flag(F.contains(value, F.lit(":"))),
    }


def fits_named(c: Column, f: dict[str, Column]) -> Column:
    """A named candidate of a plausible size."""
    sizes = {"email": (0, MOST_DIGITS), "ip": (4, MOST_DIGITS), "card": (12, 19), "phone": (7, 15)}
    fitting = [(c["kind"] == i) & f["digits"].between(*sizes[k]) for i, k in enumerate(KINDS)]
    return (f["named"] == 1) & reduce(lambda a, b: a | b, fitting)


def cells(matched: DataFrame) -> list[dict]:
    """Candidates counted by features, fold and weak label.

    The label is 1 for a strict match, for one that is named and of its kind's size, and for a named secret.
    """
    marked = F.transform("__more", lambda c: F.struct(
        c.alias("c"), F.exists("__base", lambda b: (b["kind"] == c["kind"]) & (b["start"] <= c["start"]) & (b["stop"] >= c["stop"])).alias("strict"),
    ))
    held = (F.pmod(F.xxhash64("__text"), F.lit(FOLDS)) == 0).cast("int").alias("held")
    rows = matched.filter(F.size("__more") > 0).select(held, F.explode(marked).alias("m"))
    f = features(F.col("m.c"))
    secret = (F.col("m.c.kind") == ALL.index("secret")) & F.col("m.c.before").rlike(NAMED["secret"])
    label = (F.col("m.strict") | fits_named(F.col("m.c"), f) | secret).cast("int")
    named = rows.select("held", *[f[x].alias(x) for x in FEATURES], label.alias("label"))
    # At most levels of all features times folds and labels, however large the input.
    return [r.asDict() for r in named.groupBy("held", *FEATURES, "label").agg(F.count(F.lit(1)).alias("n")).collect()]


@dataclass(frozen=True)
class Split:
    """A leaf value, or a test ``feature <= border`` with the trees of both answers."""

    value: float = 0.0
    feature: str = ""
    border: int = 0
    yes: "Split | None" = None
    no: "Split | None" = None

    def score(self, row: dict) -> float:
        if not self.feature:
            return self.value
        return (self.yes if row[self.feature] <= self.border else self.no).score(row)

    def column(self, f: dict[str, Column]) -> Column:
        if not self.feature:
            return F.lit(self.value)
        return F.when(f[self.feature] <= self.border, self.yes.column(f)).otherwise(self.no.column(f))


def grow(rows: list[dict], depth: int) -> Split:
    """A regression tree on gradients ``g`` and curvatures ``h`` of the rows."""
    gain_of = lambda g, h: g * g / (h + 1.0)
    g, h = sum(r["g"] for r in rows), sum(r["h"] for r in rows)
    best = (1e-6, "", 0)
    if depth:
        for feature in FEATURES:
            left_g = left_h = 0.0
            ordered = sorted(rows, key=lambda r: r[feature])
            for i, row in enumerate(ordered[:-1]):
                left_g, left_h = left_g + row["g"], left_h + row["h"]
                if row[feature] != ordered[i + 1][feature]:
                    gain = gain_of(left_g, left_h) + gain_of(g - left_g, h - left_h) - gain_of(g, h)
                    best = max(best, (gain, feature, row[feature]))
    _, feature, border = best
    if not feature:
        return Split(RATE * g / (h + 1.0))
    yes, no = [r for r in rows if r[feature] <= border], [r for r in rows if r[feature] > border]
    return Split(0.0, feature, border, grow(yes, depth - 1), grow(no, depth - 1))


@dataclass(frozen=True)
class Model:
    trees: tuple[Split, ...]
    bias: float
    thresholds: tuple[float, ...]  # log-odds by kind; infinite where nothing is to be added

    def column(self, f: dict[str, Column]) -> Column:
        return reduce(lambda a, b: a + b, [t.column(f) for t in self.trees], F.lit(self.bias))


def boost(cells: list[dict]) -> Model:
    """Logistic gradient boosting over weighted cells, and the lowest threshold of each kind with the wanted precision on the texts held out.

    Without positives and negatives to grow on, or without any held-out candidate of a kind, nothing of it is added.
    """
    ordered = sorted(cells, key=lambda r: tuple(r[x] for x in (*FEATURES, "label")))
    rows, held = [r for r in ordered if not r["held"]], [r for r in ordered if r["held"]]
    positive, total = sum(r["n"] for r in rows if r["label"]), sum(r["n"] for r in rows)
    if not rows or positive in (0, total):
        return Model((), 0.0, (math.inf,) * len(ALL))
    bias = math.log(positive / (total - positive))
    rows, held = [r | {"f": bias} for r in rows], [r | {"f": bias} for r in held]
    trees = []
    for _ in range(TREES):
        for r in rows:
            p = 1 / (1 + math.exp(-max(min(r["f"], 30), -30)))
            r["g"], r["h"] = r["n"] * (r["label"] - p), r["n"] * p * (1 - p)
        tree = grow(rows, 3)
        trees.append(tree)
        for r in (*rows, *held):
            r["f"] += tree.score(r)
    thresholds = []
    for kind in range(len(ALL)):
        own = sorted((r for r in held if r["kind"] == kind), key=lambda r: -r["f"])
        best, right, seen = math.inf, 0, 0
        for i, r in enumerate(own):
            right, seen = right + r["n"] * r["label"], seen + r["n"]
            if (i + 1 == len(own) or own[i + 1]["f"] < r["f"] - 1e-9) and right >= PRECISION * seen:
                best = r["f"] - 1e-9
        thresholds.append(best)
    return Model(tuple(trees), bias, tuple(thresholds))


def chosen(model: Model) -> Column:
    """Base spans and, free of overlap with them and with one another, the candidates over their threshold, by start."""
    short = lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["stop"].alias("stop"))
    base = F.transform("__base", short)
    if all(math.isinf(t) for t in model.thresholds):
        return base

    # A candidate inside or across a base span is none: those are found by their strict borders already.
    free = F.filter("__more", lambda c: ~F.exists("__base", lambda b: (b["start"] < c["stop"]) & (c["start"] < b["stop"])))
    # Features and score are bound once a candidate; the trees are many references to them.
    told = F.transform(free, lambda c: F.struct(c.alias("c"), F.struct(*[f.alias(x) for x, f in features(c).items()]).alias("f")))
    scored = F.transform(told, lambda t: F.struct(t["c"].alias("c"), model.column({x: t["f"][x] for x in FEATURES}).alias("score")))
    thresholds = F.array(*[F.lit(t) for t in model.thresholds])
    free = F.transform(F.filter(scored, lambda t: t["score"] >= thresholds[t["c"]["kind"]]), lambda t: t["c"])
    none = F.array().cast("array<struct<start:int,kind:int,stop:int>>")
    # By start, then kind: the first of overlapping candidates stays.
    apart = F.aggregate(free, none, lambda kept, c: F.when(
        F.coalesce(F.try_element_at(kept, F.lit(-1))["stop"] > c["start"], F.lit(False)), kept
    ).otherwise(F.array_append(kept, short(c))))
    return F.array_sort(F.concat(base, apart))


def listed(found: Column) -> Column:
    names = F.array(*[F.lit(k) for k in ALL])
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["stop"])), ",")


def find_pii(docs: DataFrame) -> DataFrame:
    """``docs`` with ``base_spans`` and ``pii_spans``: arrays of (start, kind, stop), in code points, by start and kind.

    Uses ``text`` alone. A null or empty text has no spans; each row is judged on its own, so repeated rows
    get equal spans; the trees are fitted on the candidates of ``docs`` itself, and without candidates of
    both labels nothing is added. Columns named ``base_spans`` or ``pii_spans`` are replaced.
    """
    matched = with_matches(docs)
    model = boost(cells(matched))
    short = F.transform("__base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["stop"].alias("stop")))
    return matched.withColumns({"base_spans": short, "pii_spans": chosen(model)}).drop("__text", "__base", "__more")


def redact(found: DataFrame) -> DataFrame:
    """``text`` with each span replaced by the upper-case name of its kind in brackets; overlapping spans become one."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in ALL])
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(held: Column, span: Column) -> Column:
        between = F.substring(F.col("text"), held["at"] + 1, span["start"] - held["at"])
        grown = F.concat(held["out"], between, names[span["kind"]])
        apart = span["start"] >= held["at"]
        return F.struct(F.greatest(held["at"], span["stop"]).alias("at"), F.when(apart, grown).otherwise(held["out"]).alias("out"))

    def finish(held: Column) -> Column:
        return F.concat(held["out"], F.substring(F.col("text"), held["at"] + 1, F.char_length("text")))

    replaced = F.aggregate("pii_spans", start, step, finish)
    return found.withColumn("text", F.when(F.size("pii_spans") > 0, replaced).otherwise(F.col("text")))
