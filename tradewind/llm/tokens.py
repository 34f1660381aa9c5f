"""Token ids of texts from the ``tokenizers`` library, each distinct word encoded once per worker."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: A border no byte-level pre-token crosses: before one space or line break between two other characters.
BORDER = re.compile(r"(?<=\S)(?=[ \n]\S)")
#: Texts that hold more than words with single spaces or line breaks between them.
ODD = r"^[ \n]|[ \n]$|[ \n][ \n]|[\t\x0b-\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: Latin, Greek and Cyrillic letters, digits and marks whose runs are the pre-tokens of a word; the apostrophe begins pre-tokens of its own.
LETTERS, DIGITS, MARKS = "A-Za-zÀ-ÖØ-öø-ʯΆΈ-ΊΌΎ-ΡΣ-ώЀ-ҁҊ-ӿ", "0-9", r"!-&(-/:-@\[-`{-~"
RUNS, OF_RUNS = re.compile(f"[{LETTERS}]+|[{DIGITS}]+|[{MARKS}]+"), f"^[{LETTERS}{DIGITS}{MARKS}]+$"
DEFAULT_FILE = "byte_bpe_50k.json"
#: Words, or runs of words, that go to the tokenizer as one text.
LINES = 100
#: Characters of a word beyond which it goes to the tokenizer alone.
WIDE = 500
#: Such texts that are with the tokenizer at once; an encoding is some hundred times as large as its ids.
GROUPS = 32
#: Bytes of text that one step encodes.
STEP = 4 << 20
#: Bytes of a cached word beside its letters and ids.
ENTRY = 16

_encoders: dict[tuple[str, int], "WordEncoder"] = {}


def tokenizer_path(name: str = DEFAULT_FILE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@contextmanager
def encoder(path: str, capacity: int = 48 << 20) -> Iterator["WordEncoder"]:
    """This worker's encoder, for one task: the vocabulary stays with the worker, the cache goes with the task.

    A task has one core, so the library starts no threads beside it unless the environment says otherwise.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if (path, capacity) not in _encoders:
        _encoders[path, capacity] = WordEncoder(path, capacity)
    try:
        yield _encoders[path, capacity]
    finally:
        _encoders[path, capacity].forget()


class WordEncoder:
    """Encodes texts word by word.

    A byte-level vocabulary merges within pre-tokens only, and a single space or line break between
    two other characters begins one. So ids of words, each with the space before it, stand together
    as the ids of the text. Words repeat, hence a cache in two generations: ``capacity`` bounds its bytes, not the
    result. When the young one is half of it, it becomes the old one, whose words come back when they are seen again; those
    that were not, such as keys and hashes, go with it and are encoded again. A text with other white space is
    cut only where the same holds, and its pieces are encoded as they are. A text that holds an added token of
    the vocabulary, such as its end mark, is encoded whole, as the library finds these before anything else.
    Known words and their ids are columns, not Python objects, which take several times the room and time.

    Where the vocabulary's own pre-tokens are runs of letters, digits or marks, words are cut into these here and the library
    only merges them, which spares it the search for them. Words with other characters are left to it whole.
    """

    def __init__(self, path: str, capacity: int) -> None:
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import Split

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = Tokenizer(self.tokenizer.model) if self._cuts_runs() else None
        if self.merges:
            self.merges.pre_tokenizer = Split(visible("\n"), "isolated")
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.capacity = capacity
        self.forget()
        (self.line_break,) = self._ids(["\n"])[0].tolist()

    def _cuts_runs(self) -> bool:
        """Whether the vocabulary's pre-tokens of every character in question are the runs of :data:`RUNS`."""
        every = [chr(c) for c in range(0x500) if re.match(OF_RUNS, chr(c))]
        words = [f"{c}{c}a{c}1{c}.{c}" for c in every]
        if self.tokenizer.normalizer or self.tokenizer.post_processor or not self.tokenizer.pre_tokenizer:
            return False
        wanted = [visible(run) for run in RUNS.findall(words[0])]
        for word in words[1:]:
            first, *others = RUNS.findall(word)
            wanted += map(visible, [" " + first, *others])
        return [run for run, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(" ".join(words))] == wanted

    def forget(self) -> None:
        self.known, self.older = ({}, {}), ({}, {})  # at line starts, after a space
        self.size = 0

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4") for e in found]

    def _learn(self, words: list[str], before: str) -> "Coded":
        """The ids of words after ``before``: of their runs where these are known to be pre-tokens, else of many words as lines of a text."""
        every = pa.array(words, pa.large_string())
        wide = np.asarray(pc.greater(pc.utf8_length(every), WIDE))
        whole = np.asarray(pc.match_substring_regex(every, OF_RUNS)) & ~wide if self.merges else np.zeros(len(every), bool)
        alone, lines = every.filter(pa.array(wide)), every.filter(pa.array(~wide & ~whole))
        ids = self._ids([before + w for w in strings(alone)])
        learnt = [
            Coded(alone, flat(ids), np.fromiter(map(len, ids), np.int32, len(ids))),
            Coded(lines, *self._lines(self.tokenizer, lines, before)),
        ]
        every = every.filter(pa.array(whole))
        if len(every):
            parted = pc.utf8_rtrim(pc.replace_substring_regex(every, f"([{LETTERS}]+|[{DIGITS}]+|[{MARKS}]+)", "\\1\n"), "\n")
            cut = pc.split_pattern(begun(before, parted), "\n")
            runs = cut.flatten().dictionary_encode()
            ids, sizes = self._of_runs(runs.dictionary, before)
            ids, ends = joined(ids, sizes, runs.indices.to_numpy())
            learnt.append(Coded(every, ids, np.diff(ends[cut.offsets.to_numpy()]).astype(np.int32)))
        return together(learnt)

    def _of_runs(self, runs: pa.LargeStringArray, before: str) -> tuple[np.ndarray, np.ndarray]:
        """The ids of runs, of which those that begin with ``before`` may be known as words."""
        known = self.known[bool(before)] or NOTHING
        at = pc.index_in(begun(before, known.words), value_set=runs)
        places = np.asarray(pc.is_valid(at))
        at = at.drop_null().to_numpy()
        fresh = np.ones(len(runs), bool)
        fresh[at] = False
        own = taken(known.ids, known.sizes, np.flatnonzero(places))
        ids, sizes = self._lines(self.merges, runs.filter(pa.array(fresh)), "", visible)
        every = np.empty(len(runs), np.int64)
        every[at], every[fresh] = np.arange(len(at)), len(at) + np.arange(len(sizes))
        return taken(np.concatenate([own[0], ids]), np.concatenate([own[1], sizes]), every)

    def _lines(self, tokenizer, words: pa.LargeStringArray, before: str, shown: Callable[[str], str] = str) -> tuple[np.ndarray, np.ndarray]:
        """The ids of many words as lines of a text: a line break is a token of its own between two words."""
        out = []
        for begin in range(0, len(words), LINES * GROUPS):
            some = begun(before, words.slice(begin, LINES * GROUPS))
            borders = [*range(0, len(some), LINES), len(some)]
            groups = pc.binary_join(pa.ListArray.from_arrays(pa.array(borders, pa.int32()), some), pa.scalar("\n", some.type))
            texts = [shown(g + "\n") for g in strings(groups)]
            for encoding in tokenizer.encode_batch_fast(texts, add_special_tokens=False):
                out.append(np.array(encoding.ids, "<u4"))
        every = flat(out)
        breaks = every == self.line_break
        return every[~breaks], np.diff(np.flatnonzero(breaks), prepend=-1).astype(np.int32) - 1

    def encode(self, texts: list[str | None] | pa.Array) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text; null and empty texts have none."""
        texts = (pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())).fill_null("")
        odd = pc.match_substring_regex(texts, ODD)
        marked = pa.array(np.zeros(len(texts), bool))
        for token in self.added:
            marked = pc.or_(marked, pc.match_substring(texts, token))
        some = pc.and_not(pc.not_equal(texts, ""), pc.or_(odd, marked))
        out = [b""] * len(texts)
        for i in np.flatnonzero(pc.or_(odd, marked)).tolist():
            text = texts[i].as_py()
            out[i] = flat(self._ids([text] if marked[i].as_py() else BORDER.split(text))).tobytes()
        for i, raw in zip(np.flatnonzero(some).tolist(), self._of_words(texts.filter(some)), strict=True):
            out[i] = raw
        return out

    def _of_words(self, texts: pa.LargeStringArray) -> Iterator[bytes]:
        """The ids of texts of words with single spaces or line breaks between them.

        A word after a line break stands with it, and each text is read as if it began with one.
        """
        if not len(texts):
            return
        lines = pc.replace_substring(texts, "\n", " \n")
        cut = pc.split_pattern(begun("\n", lines), " ")
        coded = cut.flatten().dictionary_encode()
        words = coded.dictionary
        after_break = np.asarray(pc.starts_with(words, "\n"))
        first, rest = (words.filter(pa.array(some)) for some in (after_break, ~after_break))
        first, rest = self._look_up(0, pc.utf8_slice_codeunits(first, 1), ""), self._look_up(1, rest, " ")
        # The line break goes before each first word.
        ids = np.concatenate([np.insert(first[0], np.cumsum(first[1]) - first[1], self.line_break), rest[0]])
        places = np.empty(len(words), np.int64)
        places[after_break], places[~after_break] = np.arange(len(first[1])), len(first[1]) + np.arange(len(rest[1]))
        ids, ends = joined(ids, np.concatenate([first[1] + 1, rest[1]]), places[coded.indices.to_numpy()])
        borders = ends[cut.offsets.to_numpy()].tolist()
        for begin, end in zip(borders, borders[1:]):
            yield ids[begin + 1 : end].tobytes()
        if self.size > self.capacity // 2:
            self.known, self.older, self.size = ({}, {}), self.known, 0

    def _look_up(self, kind: int, words: pa.LargeStringArray, before: str) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct words, which are known from now on."""
        known, older = self.known[kind] or NOTHING, self.older[kind] or NOTHING
        at = pc.index_in(words, value_set=known.words)
        fresh = words.filter(pc.is_null(at))
        at = at.fill_null(-1).to_numpy().copy()
        if len(fresh):
            back = older.some(np.flatnonzero(pc.is_in(older.words, value_set=fresh)))
            new = fresh.filter(pc.invert(pc.is_in(fresh, value_set=back.words)))
            learnt = together([back, self._learn(strings(new), before)] if len(new) else [back])
            at[at < 0] = len(known) + pc.index_in(fresh, value_set=learnt.words).to_numpy()
            known = together([known, learnt])
            self.known = (known, self.known[1]) if kind == 0 else (self.known[0], known)
            self.size += learnt.words.nbytes + learnt.ids.nbytes + ENTRY * len(learnt)
        return taken(known.ids, known.sizes, at)


@dataclass
class Coded:
    """Distinct words, their ids one after another, and the number of ids of each."""

    words: pa.LargeStringArray
    ids: np.ndarray
    sizes: np.ndarray

    def __len__(self) -> int:
        return len(self.words)

    def some(self, places: np.ndarray) -> "Coded":
        return Coded(self.words.take(pa.array(places)), *taken(self.ids, self.sizes, places))


NOTHING = Coded(pa.array([], pa.large_string()), np.zeros(0, "<u4"), np.zeros(0, np.int32))


def together(parts: list[Coded]) -> Coded:
    parts = [p for p in parts if len(p)] or [NOTHING]
    if len(parts) == 1:
        return parts[0]
    return Coded(pa.concat_arrays([p.words for p in parts]), *(np.concatenate([getattr(p, x) for p in parts]) for x in ("ids", "sizes")))


def begun(before: str, texts: pa.LargeStringArray) -> pa.LargeStringArray:
    """Each text after ``before``."""
    return pc.binary_join_element_wise(pa.scalar(before, texts.type), texts, pa.scalar("", texts.type)) if before else texts


def flat(ids: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(ids) if ids else np.zeros(0, "<u4")


def joined(ids: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the entries that ``which`` numbers, one after another, and their borders."""
    of, ends = sizes[which], np.zeros(len(which) + 1, np.int64)
    np.cumsum(of, out=ends[1:])
    kind = np.int32 if max(len(ids), ends[-1]) < 1 << 31 else np.int64
    starts = np.cumsum(sizes, dtype=np.int64) - sizes
    places = np.repeat((starts[which] - ends[:-1]).astype(kind), of)
    places += np.arange(ends[-1], dtype=kind)
    return ids[places], ends


def taken(ids: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids and sizes of the entries that ``which`` numbers."""
    return joined(ids, sizes, which)[0], sizes[which]


def strings(texts: pa.Array) -> list[str]:
    """The column as Python strings, without a scalar of Arrow's for each."""
    return texts.to_numpy(zero_copy_only=False).tolist()


def _byte_letters() -> np.ndarray:
    """The character by which byte-level vocabularies write each byte."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return np.array([b if b in shown else next(others) for b in range(256)], "<u2")


BYTES = _byte_letters()


def visible(text: str) -> str:
    """A text's bytes in the characters of a byte-level vocabulary."""
    return BYTES[np.frombuffer(text.encode(), np.uint8)].tobytes().decode("utf-16-le")
