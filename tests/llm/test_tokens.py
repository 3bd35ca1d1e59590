import random

import pytest

from lognorm.llm import tokens
from lognorm.llm.sentencepiece_codec import MODEL

LETTERS = ["a", "b", "the", "'s", " ", "  ", "\n", "\t", "▁", "é", "漢", "😀", "1", "!!", "<|endoftext|>", "<s>", "\x00", "　", "x" * 20]


def random_texts(seed=1, n=3000):
    rng = random.Random(seed)
    return ["", " ", " " * 9000, "a" + "\n" * 7000 + "b"] + ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 30))) for _ in range(n)]


@pytest.mark.parametrize("plain", [True, False])
def test_ids_equal_the_library(plain):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokens.BYTE_BPE)
    library.encode_special_tokens = plain
    given = random_texts()
    assert tokens.byte_level(plain=plain)(given) == [library.encode(t, add_special_tokens=False).ids for t in given]


def test_every_character_is_split_alike():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokens.BYTE_BPE)
    step = 40
    chars = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    given = ["".join(f" a{c}b 1{c}2 !{c}? {c} {c}{c}x" for c in chars[i:i + step]) for i in range(0, len(chars), step)]
    assert tokens.byte_level(plain=False)(given) == [e.ids for e in library.encode_batch_fast(given, add_special_tokens=False)]


def test_bytes_give_the_text_back():
    names, pieces = tokens.byte_level_bytes(), tokens.piece_bytes(MODEL)
    given = [t for t in random_texts(2) if t]
    for t, a, b in zip(given, tokens.byte_level(plain=True)(given), tokens.sentence_pieces(MODEL)(given), strict=True):
        assert b"".join(names[i] for i in a) == t.encode()
        assert b"".join(pieces[i] for i in b) == (" " + t).replace("▁", " ").encode()
