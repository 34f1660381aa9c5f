"""License scans: an Aho-Corasick automaton over words, and SPDX expressions read by a shunting-yard parser."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import steps
from tradewind.llm.words import PLAIN

#: Fixed values of the contract: phrase and label.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Further notice phrases and their labels.
NOTICES = {
    "gnu lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "bsd 2 clause": "bsd",
    "bsd 3 clause": "bsd",
    "isc license": "isc",
    "boost software license": "bsl",
    "creative commons attribution": "cc-by",
    "dedicated to the public domain": "public-domain",
}
TAG = "spdx license identifier"
TAG_LINE = re.compile(r"spdx[-_ ]license[-_ ]identifier[ \t]*:[ \t]*([^\r\n]*)", re.IGNORECASE)
TOKEN = re.compile(r"[()]|[A-Za-z0-9.+:-]+")
#: Binding strength of the operators; WITH joins a licence and its exception.
STRENGTH = {"or": 1, "and": 2, "with": 3}
#: Licence families by the beginning of their identifiers, longest beginning first in the search.
FAMILIES = {
    "agpl": "agpl", "apache": "apache", "bsd": "bsd", "bsl": "bsl", "cc-by": "cc-by", "cc0": "public-domain",
    "epl": "epl", "gpl": "gpl", "isc": "isc", "lgpl": "lgpl", "mit": "mit", "mpl": "mpl", "unlicense": "public-domain",
}
PERMISSIVE = frozenset({"apache", "bsd", "bsl", "isc", "mit", "public-domain", "cc-by"})

SCHEMA = """doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string,
labels string, score double, permitted boolean, expressions array<string>"""


def family(identifier: str) -> str:
    name = identifier.lower().rstrip("+")
    fitting = [k for k in FAMILIES if name == k or name.startswith(f"{k}-")]
    return FAMILIES[max(fitting, key=len)] if fitting else name


def postfix(expression: str) -> list[str] | None:
    """Shunting-yard: the expression's tokens, operators after their operands; None if it is no expression."""
    out: list[str] = []
    held: list[str] = []
    operand_next = True
    for token in TOKEN.findall(expression):
        word = token.lower()
        if word in STRENGTH:
            if operand_next:
                return None
            while held and held[-1] != "(" and STRENGTH[held[-1]] >= STRENGTH[word]:
                out.append(held.pop())
            held.append(word)
            operand_next = True
        elif token == "(":
            if not operand_next:
                return None
            held.append(token)
        elif token == ")":
            if operand_next:
                return None
            while held and held[-1] != "(":
                out.append(held.pop())
            if not held:
                return None
            held.pop()
        else:
            if not operand_next:
                return None
            out.append(token)
            operand_next = False
    if operand_next or "(" in held:
        return None
    return out + held[::-1]


def evaluate(expression: str, allowed: frozenset[str] = PERMISSIVE) -> tuple[frozenset[str], bool] | None:
    """Labels named in the expression, and whether allowed licences alone can satisfy it."""
    order = postfix(expression)
    if order is None:
        return None
    labels: set[str] = set()
    stack: list[tuple[bool, bool]] = []  # satisfied, is an exception's name
    names: list[str] = []
    exceptions = {i - 1 for i, t in enumerate(order) if t.lower() == "with"}
    for i, token in enumerate(order):
        word = token.lower()
        if word not in STRENGTH:
            if i not in exceptions:
                names.append(family(token))
                labels.add(names[-1])
            stack.append((i in exceptions or names[-1] in allowed, i in exceptions))
        else:
            (right, _), (left, _) = stack.pop(), stack.pop()
            stack.append((left if word == "with" else (left and right) if word == "and" else (left or right), False))
    return frozenset(labels), stack[0][0]


@dataclass
class Found:
    n_words: int
    places: list[tuple[int, str]]  # first word and label of each base phrase
    others: list[str]
    expressions: list[str]


class Scanner:
    def __init__(self) -> None:
        import ahocorasick

        self.table = bytes(b or 0x20 for b in PLAIN)
        self.automaton = ahocorasick.Automaton()
        phrases = {**{p: ("notice", x) for p, x in NOTICES.items()}, TAG: ("tag", ""), **{p: ("base", x) for p, x in BASE.items()}}
        for phrase, (kind, label) in phrases.items():
            self.automaton.add_word(f" {phrase} ", (kind, label, phrase.count(" ") + 1))
        self.automaton.make_automaton()

    def scan(self, text: str | None) -> Found:
        words = (text or "").encode("utf-8", "replace").translate(self.table).split(b" ")
        words = [w for w in words if w]
        line = f" {b' '.join(words).decode('utf-8', 'replace')} "
        found = Found(len(words), [], [], [])
        passed, at, tagged = 0, 0, False
        for end, (kind, label, size) in self.automaton.iter(line):
            passed += line.count(" ", at, end)  # word borders before the last one of this phrase
            at = end
            if kind == "base":
                found.places.append((passed - size, label))
            elif kind == "notice":
                found.others.append(label)
            else:
                tagged = True
        if tagged:
            found.expressions = [m.strip() for m in TAG_LINE.findall(text or "")]
        return found


def scan_licenses(docs: DataFrame) -> DataFrame:
    """Phrases, labels and SPDX expressions of every text.

    Uses ``doc_id`` and ``text`` alone, so other columns may have any name. A null or empty text has no
    words and no labels; repeated rows give repeated results; an empty table gives no rows. ``permitted``
    is null without an expression, else whether permissive licences alone satisfy all of them.
    ``score`` is 1 - 2 ** -(places and tags found).
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for batch in steps(batches):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = scanner.scan(text)
                base = {label for _, label in found.places}
                read = [x for x in map(evaluate, found.expressions) if x is not None]
                labels = base.union(found.others, *(names for names, _ in read))
                starts = [first for first, _ in found.places]
                evidence = len(found.places) + len(found.others) + len(read)
                rows.append({
                    "doc_id": doc_id, "n_words": found.n_words, "n_base": len(starts),
                    "first_word": min(starts, default=None), "last_word": max(starts, default=None),
                    "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(labels)),
                    "score": 1 - 0.5 ** evidence, "permitted": all(ok for _, ok in read) if read else None,
                    "expressions": found.expressions,
                })
            yield pa.RecordBatch.from_pylist(rows, schema=ARROW)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, SCHEMA)


ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
    ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
    ("permitted", pa.bool_()), ("expressions", pa.list_(pa.string())),
])
