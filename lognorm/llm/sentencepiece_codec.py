"""SentencePiece encoding and decoding by a Viterbi pass over a trie of distinct marked words.

A marked word is a run of space marks with the word after it; no piece has a mark after another
character, so words are encoded on their own. The distinct words of a slice are sorted, which
is depth-first order of their trie: the forward states of the prefix a word shares with the one
before it are kept, only its own suffix is computed.

The forward score of a prefix is the best over the pieces ending there of the score before the
piece, plus the piece's score, plus a transition score. For a unigram model transitions cost
nothing. For a BPE model a transition is 0 where the two pieces, joined and merged anew, come
out as the same two pieces, and minus infinity otherwise: a segmentation is the one that merging
gives exactly when every neighbouring pair has that property, so the single path of finite score
is the library's own segmentation, and results equal ``SentencePieceProcessor.encode``.

Characters no piece holds become byte pieces (or the unknown id). The space mark itself in a
text reads as a space, as in the library; everything else comes back exactly from ``decode``.
Null and empty texts give no ids and the empty text. A word without spaces may be as long as
the text: the walk is iterative, and its state is linear in the word's length.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lognorm.llm.common import column_of, map_slices, text_or_empty, texts_of

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
_WORDS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
UNIGRAM, BPE = 1, 2
ONE = (1,)
#: Text of one slice: a worker holds its words, ids and decoded texts at once.
SLICE = 1 << 20
#: Larger than any id or character number, to make one number of two.
SPAN = 1 << 32
#: Words and their characters remembered by a task, pairs of pieces by a worker; beyond that it starts anew. A worker
#: outlives its tasks, so what it remembers stays with the executor while later stages run.
REMEMBER_WORDS, REMEMBER_CHARS, REMEMBER_PAIRS = 100_000, 1 << 20, 400_000


@dataclass
class Pieces:
    """A vocabulary: what a model file holds, as far as encoding needs it."""

    ids: dict[str, int]  # ordinary pieces
    score: dict[int, float]  # by id
    texts: list[str]
    bytes_: dict[int, int]  # byte value -> id
    unknown: int
    control: frozenset
    kind: int
    dummy_prefix: bool
    pairs: dict[int, bool] = field(default_factory=dict)

    def __post_init__(self):
        self.byte_of = {i: b for b, i in self.bytes_.items()}
        self.unseen = min(self.score.values(), default=0.0) - 10.0
        bad = [p for p in self.ids if MARK in p.lstrip(MARK)]
        if bad:
            raise ValueError(f"pieces with a space mark inside are not supported: {bad[:3]}")
        #: Lengths of the pieces that end with two characters (or are one), shortest first; 1 is always tried.
        ending: dict[str, set[int]] = {}
        for p in self.ids:
            ending.setdefault(p[-2:], {1}).add(len(p))
        self.ending = {k: tuple(sorted(n)) for k, n in ending.items()}

    def merged(self, text: str) -> list[str]:
        """The text merged pair by pair, the best-scored piece first, leftmost among equals."""
        parts, ids, score = list(text), self.ids, self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = ids.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or score[s] > best):
                    best, at = score[s], i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, a: int, b: int) -> bool:
        """Transition score 0 (true) or minus infinity (false) of piece ``b`` after ``a``; ``a`` 0: at the start.

        A negative number is the complement of a character that no piece holds.
        """
        if len(self.pairs) > REMEMBER_PAIRS:
            self.pairs.clear()
        one, two = (chr(~x) if x < 0 else self.texts[x] for x in (a, b))
        out = self.merged(two) == [two] if a == 0 else self.merged(one + two) == [one, two]
        self.pairs[a * SPAN + b] = out
        return out

    def fallback(self, char: str) -> list[int]:
        return [self.bytes_[b] for b in char.encode()] if self.bytes_ else [self.unknown]


@lru_cache(maxsize=4)
def load_pieces(path: str) -> Pieces:
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    normal, trainer = model.normalizer_spec, model.trainer_spec
    if normal.precompiled_charsmap or normal.remove_extra_whitespaces or trainer.treat_whitespace_as_suffix:
        raise ValueError("only models whose normaliser is the identity are supported")
    if trainer.model_type not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models are supported")
    kind = pb.ModelProto.SentencePiece
    ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kind.NORMAL}
    if any(p.type in (kind.USER_DEFINED, kind.UNUSED) for p in model.pieces):
        raise ValueError("models with user-defined or unused pieces are not supported")
    return Pieces(
        ids, {i: p.score for i, p in enumerate(model.pieces) if p.type == kind.NORMAL}, [p.piece for p in model.pieces],
        {int(p.piece[1:-1], 16): i for i, p in enumerate(model.pieces) if p.type == kind.BYTE},
        next((i for i, p in enumerate(model.pieces) if p.type == kind.UNKNOWN), 0),
        frozenset(i for i, p in enumerate(model.pieces) if p.type == kind.CONTROL),
        trainer.model_type, normal.add_dummy_prefix)


def marked_words(text: str, dummy_prefix: bool = True) -> list[str]:
    if not text:
        return []
    return _WORDS.findall((MARK if dummy_prefix else "") + text.replace(" ", MARK))


def viterbi_sorted(words: list[str], v: Pieces) -> list[list[int]]:
    """Ids of each of the sorted distinct words: one depth-first walk of their trie."""
    ids, score, ending, pairs, bpe = v.ids, v.score, v.ending, v.pairs, v.kind == BPE
    # Forward states along the current path, by prefix length: score, id of the last piece, its length.
    best: list[float] = [0.0]
    last: list[int] = [0]
    size: list[int] = [0]
    out, before = [], ""
    for word in words:
        shared = 0
        for x, y in zip(word, before):
            if x != y:
                break
            shared += 1
        del best[shared + 1:], last[shared + 1:], size[shared + 1:]
        for end in range(shared + 1, len(word) + 1):
            top, piece, width = None, 0, 1
            for n in ending.get(word[end - 2:end] if end > 1 else word[0], ONE):
                if n > end:
                    break
                start = end - n
                i = ids.get(word[start:end])
                if i is None:
                    if n > 1:
                        continue
                    i, value = ~ord(word[start]), best[start] + v.unseen  # byte pieces or the unknown piece
                else:
                    value = best[start] + score[i]
                if top is not None and value <= top:
                    continue
                if bpe:
                    key = last[start] * SPAN + i
                    fits = pairs.get(key)
                    if fits is None:
                        fits = v.fits(last[start], i)
                    if not fits:
                        continue
                    top, piece, width = value, i, n
                    break  # the one finite path
                top, piece, width = value, i, n
            best.append(top)
            last.append(piece)
            size.append(width)
        pieces, at = [], len(word)
        while at:
            pieces.append(last[at])
            at -= size[at]
        if min(pieces) < 0:
            pieces = [i for p in pieces for i in ((p,) if p >= 0 else v.fallback(chr(~p))[::-1])]
        pieces.reverse()
        out.append(pieces)
        before = word
    return out


class Encoder:
    """Encodes slices of texts; remembers words of earlier slices up to a bound."""

    def __init__(self, v: Pieces):
        self.v = v
        self.reset()

    def reset(self):
        self.code: dict[str, int] = {}
        self.chars = 0
        self.flat, self.starts, self.lengths = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids in a row, number of ids of each text)."""
        words, counts = [], []
        for t in texts:
            own = marked_words(t, self.v.dummy_prefix)
            counts.append(len(own))
            words += own
        if len(self.code) > REMEMBER_WORDS or self.chars > REMEMBER_CHARS:
            self.reset()
        new = sorted(set(words) - self.code.keys())
        if new:
            ids = viterbi_sorted(new, self.v)
            lengths = np.fromiter(map(len, ids), np.int64, len(ids))
            starts = np.cumsum(lengths) - lengths + len(self.flat)
            self.chars += sum(map(len, new))
            self.code.update(zip(new, range(len(self.code), len(self.code) + len(new)), strict=True))
            self.flat = np.concatenate([self.flat, np.fromiter((i for x in ids for i in x), np.int32, int(lengths.sum()))])
            self.starts, self.lengths = np.concatenate([self.starts, starts]), np.concatenate([self.lengths, lengths])
        codes = np.fromiter(map(self.code.__getitem__, words), np.int64, len(words))
        size = self.lengths[codes]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.repeat(self.starts[codes] - (ends - size), size) + np.arange(total)]
        word_ends = np.cumsum(np.array(counts, dtype=np.int64))
        reached = np.concatenate([[0], ends])[word_ends] if len(counts) else np.zeros(0, np.int64)
        return ids, np.diff(np.concatenate([[0], reached]))


class Decoder:
    def __init__(self, v: Pieces):
        self.v = v
        self.table = [
            bytes([v.byte_of[i]]) if i in v.byte_of else b"" if i in v.control
            else " ⁇ ".encode() if i == v.unknown else p.replace(MARK, " ").encode()
            for i, p in enumerate(v.texts)]

    def decode(self, ids) -> str:
        """The text of the ids; bytes that are no UTF-8 read as U+FFFD."""
        text = b"".join(map(self.table.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.v.dummy_prefix and text.startswith(" ") else text


def model_path(path: str) -> str:
    """On executors a file shipped with ``spark.sparkContext.addFile`` is preferred to the path."""
    import os

    shipped = SparkFiles.get(os.path.basename(path)) if SparkFiles._root_directory else ""
    return shipped if shipped and os.path.exists(shipped) else path


def encoded(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", model: str = MODEL,
            check: bool = False, decode: bool = False) -> DataFrame:
    """(doc_id, ids, n_tokens) of every text; with ``decode`` also ``decoded``, the text that the ids
    give; with ``check`` also ``round_trip``: whether that is the text (the mark read as a space)."""
    source = text_or_empty(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")))
    docs.sparkSession.sparkContext.addFile(model)

    def make():
        encoder = Encoder(load_pieces(model_path(model)))
        decoder = Decoder(encoder.v)

        def work(piece: pa.RecordBatch) -> pa.RecordBatch:
            texts = [t.decode("utf-8", "replace") for t in texts_of(piece)]
            ids, sizes = encoder.encode(texts)
            offsets = np.concatenate([[0], np.cumsum(sizes)])
            out = {"doc_id": column_of(piece, "doc_id"), "n_tokens": pa.array(sizes),
                   "ids": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids))}
            if check or decode:
                listed = ids.tolist()
                back = [decoder.decode(listed[a:b]) for a, b in zip(offsets.tolist(), offsets[1:].tolist())]
                out["decoded"] = pa.array(back, pa.string())
                out["round_trip"] = pa.array([x == t.replace(MARK, " ") for x, t in zip(back, texts, strict=True)], pa.bool_())
            return pa.RecordBatch.from_arrays([out[n] for n in names], names)

        return work

    kind = source.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, ids array<int>, n_tokens long" + ", round_trip boolean" * check + ", decoded string" * decode
    names = ["doc_id", "ids", "n_tokens"] + ["round_trip"] * check + ["decoded"] * decode
    return map_slices(source, make, schema, limit=SLICE)


def decoded(rows: DataFrame, doc_id: str = "doc_id", ids: str = "ids", model: str = MODEL) -> DataFrame:
    """(doc_id, text) of rows of ids; null ids give the empty text."""
    source = rows.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(ids).cast("array<int>"), F.array().cast("array<int>")).alias("ids"))
    rows.sparkSession.sparkContext.addFile(model)

    def run(batches):
        decoder = Decoder(load_pieces(model_path(model)))
        for piece in batches:
            texts = [decoder.decode(x) for x in column_of(piece, "ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([column_of(piece, "doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, text string")
