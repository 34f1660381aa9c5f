"""Words are cut into the vocabulary's pre-tokens here; the library merges these alone."""

from __future__ import annotations

import random

from tradewind.llm import tokens


def raw(ids: list[int]) -> bytes:
    return b"".join(n.to_bytes(4, "little") for n in ids)


def test_words_of_letters_digits_and_marks_skip_the_search_for_pre_tokens():
    words = tokens.WordEncoder(tokens.tokenizer_path(), 48 << 20)
    text = "Plain words, été №1 and\nЖук (abc123) end."
    whole, inner, sought = words.tokenizer.encode(text, add_special_tokens=False).ids, words.tokenizer, []

    class Counted:
        def encode_batch_fast(self, texts, **options):
            sought.extend(texts)
            return inner.encode_batch_fast(texts, **options)

    words.tokenizer = Counted()
    assert words.encode([text]) == [raw(whole)]
    # The number sign is no character that is known to be cut alike.
    assert sought == [" №1\n"]


def test_any_characters_give_the_ids_of_whole_texts():
    words = tokens.WordEncoder(tokens.tokenizer_path(), 4_000)
    rng = random.Random(7)
    letters = list("abAZéÿßʯЖжӿΩά09.,-_!'`~[]{}|^$\"\\½²ªº×÷的あ́😀\x00\x85 ")
    texts = ["".join(rng.choice([*letters, *"   \n"]) for _ in range(rng.randrange(40))) for _ in range(3000)]
    texts += ["can't l'été 'tis we've", "<|endoftext|>", "a <|endoftext|> b", "x" * 1200 + ", y", ""]
    for begin in range(0, len(texts), 100):
        some = texts[begin : begin + 100]
        assert words.encode(some) == [raw(words.tokenizer.encode(t, add_special_tokens=False).ids) for t in some]


def test_encodings_of_runs_are_held_in_bounded_number():
    words = tokens.WordEncoder(tokens.tokenizer_path(), 48 << 20)
    sizes, inner = [], words.merges

    class Counted:
        def encode_batch_fast(self, texts, **options):
            sizes.append(len(texts))
            return inner.encode_batch_fast(texts, **options)

    words.merges = Counted()
    words.encode([" ".join(f"w{i}" for i in range(tokens.LINES * 100))])
    assert 1 < len(sizes) and max(sizes) <= tokens.GROUPS
