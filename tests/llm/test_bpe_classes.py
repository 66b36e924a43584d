"""Code points beside contractions, blanks and numbers, long words, and the table against plain merging."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from voxloom.llm import bpe


@pytest.fixture(scope="module")
def pair():
    tk = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return bpe.Codec(), lambda t: list(map(str, tk.encode(t, add_special_tokens=False).ids))


def test_code_points_are_cut_as_the_library_cuts(pair):
    codec, _ = pair
    # Step 1 in range passes too, in 80 seconds.
    points = [*range(0x3100), *(c for c in range(0x3100, 0x110000, 23) if not 0xD800 <= c < 0xE000)]
    for k in range(0, len(points), 4000):
        text = "".join("X{0}'s  {0}1!{0}\n\n{0} b".format(chr(c)) for c in points[k:k + 4000])
        want = [text[a:b] for _, (a, b) in codec.classes.pieces(text)]
        assert codec._words(text) == want, hex(points[k])


@pytest.mark.parametrize("code", [0x558, 0x85, 0xA0, 0x1C, 0xB2, 0xC0, 0x378, 0x200B, 0x2160, 0x3000, 0xFEFF, 0x1F600, 0x31350, 0x10FFFF])
def test_ids_around_rare_characters(pair, code):
    codec, library = pair
    text = "X{0}'s a   {0}1 {0}!{0}{0}\n\n{0} b\t{0}".format(chr(code))
    assert codec.encode(text) == library(text)


def test_long_words(pair):
    codec, library = pair
    draw = random.Random(7)
    for letters in ("a", "ab", "etaoinshrdlu", "=", "-=", "abcdefghijklmnopqrstuvwxyz"):
        word = "".join(draw.choice(letters) for _ in range(100_000))
        assert codec.encode(word) == library(word)
        assert codec.decode(codec.encode(word)) == word


def test_a_full_table_is_started_anew(pair, monkeypatch):
    codec, library = pair
    monkeypatch.setattr(bpe, "STATES", 50)
    draw = random.Random(8)
    for _ in range(200):
        word = "".join(draw.choice("abcdestr") for _ in range(draw.randint(1, 60)))
        assert ",".join(codec.encode(word)) == ",".join(library(word))
    assert len(codec.automaton.rows) <= 51


def merged(word, ranks):
    """The definition: the pair of least rank is merged, leftmost first, until none is left."""
    parts = [bytes([b]) for b in word]
    while True:
        best = min(((ranks[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in ranks), default=None)
        if best is None:
            return parts
        i = best[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


def test_gadgets_equal_plain_merging_on_small_alphabets():
    draw = random.Random(9)
    for _ in range(60):
        known, merges = [b"a", b"b", b"c"], []
        for _ in range(draw.randint(1, 12)):
            a, b = draw.choice(known), draw.choice(known)
            if (a, b) not in merges and a + b not in known:
                merges.append((a, b))
                known.append(a + b)
        ids = {bytes([b]): b for b in range(256)} | {a + b: 256 + k for k, (a, b) in enumerate(merges)}
        automaton, ranks = bpe.Automaton(merges, ids), {m: k for k, m in enumerate(merges)}
        for _ in range(60):
            word = bytes(draw.choice(b"abc") for _ in range(draw.randint(0, 14)))
            assert automaton.path(word) == [ids[x] for x in merged(word, ranks)]
