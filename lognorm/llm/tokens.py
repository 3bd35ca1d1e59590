"""Ids and bytes of whole texts by the public tokenizers.

Byte-level files whose ids are their merge order are run by ``tiktoken``, which gives the ids of
``tokenizers`` at a quarter of its time (tests compare them over every character). Other files,
and texts with very long runs of white space, are run by ``tokenizers`` itself.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from functools import lru_cache
from itertools import chain

import numpy as np

from lognorm.llm.sentencepiece_codec import MARK, model_path

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
# Fixed value: how byte-level BPE of this family splits a text before it merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space runs of this length would overflow the stack of ``tiktoken``'s pattern engine.
LONG_SPACE = re.compile(r"\s{5000}")

Encode = Callable[[list[str]], list[list[int]]]


def flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """(all ids in a row, number of ids of each text)."""
    sizes = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter(chain.from_iterable(ids), np.int64, int(sizes.sum())), sizes


def _byte_names() -> dict[str, int]:
    """Printable characters stand for their byte; the other bytes are numbered from 256 on in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


def byte_level_bytes(path: str = BYTE_BPE) -> list[bytes]:
    """The bytes of every id of a byte-level file; special tokens have those of their name."""
    from tokenizers import Tokenizer

    library, byte = Tokenizer.from_file(model_path(path)), _byte_names()
    names = [library.id_to_token(i) for i in range(library.get_vocab_size(with_added_tokens=True))]
    return [bytes(byte[c] for c in name) if all(c in byte for c in name) else name.encode() for name in names]


@lru_cache(maxsize=4)
def byte_level(path: str = BYTE_BPE, plain: bool = False) -> Encode:
    """Ids as of ``encode(text, add_special_tokens=False)``; ``plain``: strings of special tokens in
    texts are ordinary text."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(model_path(path))
    library.encode_special_tokens = plain

    def slowly(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)]

    with open(model_path(path), encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ids = {name: i for name, i in spec["model"]["vocab"].items() if name not in special}
    merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    in_order = all(ids.get(a + b) == 256 + n for n, (a, b) in enumerate(merges)) and len(ids) == 256 + len(merges)
    splits = spec["pre_tokenizer"]
    if not in_order or spec["normalizer"] or splits["type"] != "ByteLevel" or splits["add_prefix_space"] or not splits["use_regex"]:
        return slowly
    import tiktoken

    byte = _byte_names()
    ranks = {bytes(byte[c] for c in name): i for name, i in ids.items()}
    quick = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={} if plain else special)
    one = quick.encode_ordinary if plain else lambda t: quick.encode(t, allowed_special="all")

    def quickly(texts: list[str]) -> list[list[int]]:
        return [slowly([t])[0] if len(t) >= 5000 and LONG_SPACE.search(t) else one(t) for t in texts]

    return quickly


@lru_cache(maxsize=4)
def sentence_pieces(path: str) -> Encode:
    """A sentence piece model; it adds a space before each text if the model says so."""
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=model_path(path))
    return lambda texts: library.encode(texts, num_threads=1)


def piece_bytes(path: str) -> list[bytes]:
    """The bytes of every id of a sentence piece model; a space mark is a space, <0xHH> its byte."""
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=model_path(path))
    return [bytes([int(library.id_to_piece(i)[3:5], 16)]) if library.is_byte(i) else library.id_to_piece(i).replace(MARK, " ").encode()
            for i in range(library.get_piece_size())]
