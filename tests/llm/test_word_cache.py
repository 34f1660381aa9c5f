"""The cache of words: those that come again stay, and the tokenizer never holds many encodings at once."""

from __future__ import annotations

import tracemalloc

import pyarrow as pa

from tradewind.llm import tokens


def test_words_that_come_again_are_not_encoded_again():
    words = tokens.WordEncoder(tokens.tokenizer_path(), 40_000)
    learn, learnt = words._learn, []

    def counted(some, before):
        learnt.extend(some)
        return learn(some, before)

    words._learn = counted
    for i in range(40):
        text = "the usual words stand here " + " ".join(f"k{i}x{j}" for j in range(30))
        whole = words.tokenizer.encode(text, add_special_tokens=False).ids
        assert words.encode([text])[0] == b"".join(n.to_bytes(4, "little") for n in whole)
    assert learnt.count("usual") == 1 and learnt.count("the") == 1
    assert words.size <= words.capacity and len(words.known[1]) + len(words.older[1]) < 40 * 30


def test_encodings_are_held_in_bounded_number():
    words = tokens.WordEncoder(tokens.tokenizer_path(), 48 << 20)
    sizes, inner = [], words.tokenizer

    class Counted:
        def encode_batch_fast(self, texts, **options):
            sizes.append(len(texts))
            return inner.encode_batch_fast(texts, **options)

    words.tokenizer = Counted()
    words.encode([" ".join(f"w{i}" for i in range(tokens.LINES * 100))])
    assert max(sizes) <= 32


def test_texts_of_any_white_space_are_encoded_as_whole_ones():
    words = tokens.WordEncoder(tokens.tokenizer_path(), 48 << 20)
    texts = ["one", "one two", "one\ntwo three", " one", "one ", "one  two", "one\n\ntwo", "one\ttwo", "one two", "\n", " ", "one \ntwo", "a\r\nb", ""]
    for _ in range(2):
        for text, raw in zip(texts, words.encode(texts), strict=True):
            whole = words.tokenizer.encode(text, add_special_tokens=False).ids
            assert raw == b"".join(n.to_bytes(4, "little") for n in whole)


def test_cached_words_take_little_more_than_their_letters_and_ids():
    words = tokens.WordEncoder(tokens.tokenizer_path(), 48 << 20)
    letters = "abcdefghijklmnopqrst"
    many = ["".join(letters[i // 20**k % 20] for k in range(4)) for i in range(40_000)]
    texts = pa.array([" ".join(many[:20_000]), " ".join(many[20_000:])], pa.large_string())
    arrow = pa.total_allocated_bytes()
    tracemalloc.start()
    words.encode(texts)
    held = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - arrow
    tracemalloc.stop()
    assert len(words.known[1]) >= 39_998 and held < 80 * len(many)
