import hashlib
import random
from collections import Counter, defaultdict

import pytest

from lognorm.llm import alignment
from lognorm.llm.sentencepiece_codec import MODEL
from lognorm.llm.tokens import BYTE_BPE, byte_level_bytes, piece_bytes

WORDS = ["the", "and", "Zürich", "naïve", "漢字かな", "😀😀", "antidisestablishment", "x1y2", "don't", "3.14", "foo_bar", "\n", "  ", "\t", "<s>", "<|endoftext|>", "<0x0A>"]


def texts(seed=4, n=60):
    rng = random.Random(seed)
    return ["", None, " ", "a", "▁ mark", " leading", "end ", "ab" * 3000, "the the the"] + [
        rng.choice([" ", "", " "]).join(rng.choice(WORDS) for _ in range(rng.randint(1, 40))) for _ in range(n)]


def plain_version(given):
    """From the libraries' ids and byte spans of all pairs of tokens; no windows, nothing remembered."""
    import sentencepiece
    from tokenizers import Tokenizer

    library, pieces = Tokenizer.from_file(BYTE_BPE), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    library.encode_special_tokens = True
    bytes_a, bytes_b = byte_level_bytes(), piece_bytes(MODEL)
    docs = []
    for t in given:
        t = t or ""
        a = library.encode(" " + t, add_special_tokens=False).ids if t else []
        b = pieces.encode(t)
        if not b"".join(bytes_a[i] for i in a) == (" " + t).encode() == b"".join(bytes_b[i] for i in b):
            a, b = [], []
        spans = []
        for ids, table in ((a, bytes_a), (b, bytes_b)):
            at, own = 0, []
            for i in ids:
                own.append((at, at + len(table[i]), i))
                at += len(table[i])
            spans.append(own)
        links = [(x, y) for s, e, x in spans[0] for u, v, y in spans[1] if s < v and u < e]
        shared = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups = [tuple([i for s, e, i in own if low <= s and e <= high] for own in spans) for low, high in zip([0, *shared], shared)]
        docs.append((a, b, groups, links))
    counts = Counter(p for d in docs for p in set(d[3]))
    most = defaultdict(int)
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    for a, b, groups, links in docs:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        yield (len(a), len(b), len(groups), len(links), sum(counts[p] == most[p[0]] for p in links), sum(counts[p] for p in links),
               hashlib.sha256(text.encode()).hexdigest() if a else "", text)


@pytest.mark.parametrize("most", [alignment.COMMON_PAIRS, 40, 0])
def test_against_a_plain_version(documents, most):
    given = [t for t in texts() if t is None or len(t) < 2000]
    rows = [(i % 50, t) for i, t in enumerate(given)] + [(None, "the end"), (3, "the the the")]
    got = [tuple(r) for r in alignment.aligned(documents(rows), most=most).collect()]
    want = [(i, *x[:-1]) for (i, _), x in zip(rows, plain_version([t for _, t in rows]), strict=True)]
    assert Counter(got) == Counter(want)


def test_groups_and_long_texts(documents):
    given = texts(9, 10)
    rows = list(enumerate(given))
    got = {r["doc_id"]: r["groups"] for r in alignment.alignments(documents(rows)).collect()}
    short = [i for i, t in rows if t is None or len(t) < 2000]
    assert [got[i] for i in short] == [x[-1] for x in plain_version([given[i] for i in short])]
    row = alignment.aligned(documents([(1, "ab" * 3000)])).head()
    assert row["n_groups"] > 0 and row["n_links"] >= max(row["n_a"], row["n_b"])


def test_memory_of_windows_is_bounded(monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBER_WINDOWS", 10)
    small, whole = alignment.Aligner(BYTE_BPE, MODEL), alignment.Aligner(BYTE_BPE, MODEL)
    given = [(t or "").encode() for t in texts(11)]
    want = whole.texts(*whole.windows(given)[:2])
    assert [small.texts(*small.windows([t])[:2])[0] for t in given] == want


def test_empty_table(documents):
    assert alignment.aligned(documents([])).collect() == []
