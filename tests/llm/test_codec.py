import random

import numpy as np
import pytest

from lognorm.llm import sentencepiece_codec as sp

ODD = ["", " ", "   ", "a", " leading", "trailing  ", "tab\tline\nbreak\r\n", "▁ mark ▁▁", "漢字かな", "😀 emoji", "\x00nul",
       "<s> </s> <unk> <0x0A>", "x" * 3000, "the" * 1500, "é̂ combining", "a  b   c    d"]


def texts(seed=3, n=400):
    rng = random.Random(seed)
    letters = " \n\t▁aàÉ😀zqethingon.,漢字\x00<s>0x0A"
    return ODD + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=sp.MODEL)


def split(ids, sizes):
    return [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]


def test_ids_equal_the_library(library):
    given = texts()
    encoder = sp.Encoder(sp.load_pieces(sp.MODEL))
    assert split(*encoder.encode(given)) == library.encode(given)
    assert split(*encoder.encode(given[::-1])) == library.encode(given[::-1])  # with words remembered


def test_decoding_equals_the_library_and_gives_the_text_back(library):
    v = sp.load_pieces(sp.MODEL)
    decoder = sp.Decoder(v)
    for t in texts(5):
        ids = library.encode(t)
        assert decoder.decode(ids) == library.decode(ids) == t.replace("▁", " ")


def test_remembered_words_are_bounded(library, monkeypatch):
    monkeypatch.setattr(sp, "REMEMBER_WORDS", 20)
    monkeypatch.setattr(sp, "REMEMBER_PAIRS", 50)
    v = sp.load_pieces(sp.MODEL)
    v.pairs.clear()
    encoder = sp.Encoder(v)
    for t in texts(7, 60):
        assert split(*encoder.encode([t]))[0] == library.encode(t)


def test_unigram_model_takes_the_best_sum():
    """Against all segmentations of short words."""
    scores = {"▁": -3.0, "a": -2.0, "b": -2.5, "ab": -3.0, "ba": -2.2, "▁a": -2.1, "aba": -6.0, "bb": -9.0}
    names = list(scores)
    v = sp.Pieces({p: i for i, p in enumerate(names)}, dict(enumerate(scores.values())), names, {}, 99, frozenset(), sp.UNIGRAM, True)

    def all_ways(w):
        if not w:
            yield 0.0, ()
        for n in range(1, len(w) + 1):
            if w[:n] in scores:
                for s, rest in all_ways(w[n:]):
                    yield s + scores[w[:n]], (w[:n], *rest)

    words = sorted({"▁" + "".join(x) for n in range(1, 7) for x in __import__("itertools").product("ab", repeat=n)})
    for w, ids in zip(words, sp.viterbi_sorted(words, v), strict=True):
        assert sum(scores[names[i]] for i in ids) == pytest.approx(max(s for s, _ in all_ways(w)))


def test_frames(spark, documents, library):
    rows = [(1, "the thing"), (1, "the thing"), (None, "null id"), (2, None), (3, ""), (4, "w" * 100_000)]
    out = sp.encoded(documents(rows), check=True, decode=True).collect()
    assert sorted((r.doc_id or -1, r.n_tokens) for r in out) == sorted((i or -1, len(library.encode(t or ""))) for i, t in rows)
    assert all(r.round_trip and len(r.ids) == r.n_tokens for r in out)
    back = sp.decoded(sp.encoded(documents(rows)))
    assert sorted((r.doc_id or -1, r.text) for r in back.collect()) == sorted((i or -1, t or "") for i, t in rows)
    assert sp.encoded(documents([]), check=True).count() == 0
    assert sp.decoded(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")).collect()[0].text == ""


def test_remembered_words_are_bounded_in_characters(library):
    encoder = sp.Encoder(sp.load_pieces(sp.MODEL))
    for i in range(9):
        word = "x" * (150_000 + i)
        assert split(*encoder.encode([word])) == library.encode([word])
    assert sum(map(len, encoder.code)) < 1_300_000
