import random
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pytest

from lognorm.llm import packing


@lru_cache(maxsize=None)
def fewest(lengths: tuple, capacity: int) -> int:
    """The least number of sequences, by trying all sets with the longest piece."""
    if not lengths:
        return 0
    first, rest = lengths[0], lengths[1:]
    best = len(lengths)
    seen = set()

    def choose(at, room, left):
        nonlocal best
        if left not in seen:
            seen.add(left)
            best = min(best, 1 + fewest(left, capacity))
        for n in range(at, len(left)):
            if left[n] <= room:
                choose(n, room - left[n], left[:n] + left[n + 1:])

    choose(0, capacity - first, rest)
    return best


def pieces_of(patterns, capacity):
    total = Counter()
    for p in patterns:
        assert p.count > 0 and sum(s * n for s, n in p.lengths) <= capacity
        for s, n in p.lengths:
            total[s] += n * p.count
    return total


def test_reduction_keeps_an_optimal_packing():
    rng = random.Random(2)
    fixed = 0
    for _ in range(400):
        capacity = rng.choice([10, 12, 20])
        lengths = tuple(sorted((rng.randint(1, capacity) for _ in range(rng.randint(1, 8))), reverse=True))
        if rng.random() < 0.5:
            lengths = tuple(sorted((rng.randint(3, capacity) for _ in range(8)), reverse=True))
        patterns, left = packing.reduced(Counter(lengths), capacity)
        rest = tuple(sorted((s for s, n in left.items() for _ in range(n)), reverse=True))
        assert pieces_of(patterns, capacity) + Counter(rest) == Counter(lengths)
        assert sum(p.count for p in patterns) + fewest(rest, capacity) == fewest(lengths, capacity)
        fixed += len(patterns)
    assert fixed > 400


def test_triples_are_fixed():
    """No four pieces fit, no pair fills a sequence, but the longest that fit dominate."""
    patterns, left = packing.reduced({9: 1, 6: 2, 4: 3}, 20)
    assert left == {} and [p.lengths for p in patterns] == [((9, 1), (6, 1), (4, 1)), ((6, 1), (4, 2))]


def test_best_fit_equals_one_piece_at_a_time():
    rng = random.Random(3)
    for _ in range(200):
        counts = {rng.randint(1, 30): rng.randint(1, 9) for _ in range(rng.randint(1, 8))}
        rooms = []
        for s in sorted(counts, reverse=True):
            for _ in range(counts[s]):
                fits = [r for r in rooms if r >= s]
                if fits:
                    rooms[rooms.index(min(fits))] -= s
                else:
                    rooms.append(30 - s)
        got = packing.best_fit(counts, 30)
        assert pieces_of(got, 30) == Counter(counts)
        assert Counter({30 - sum(s * n for s, n in p.lengths): 0 for p in got}).keys() == Counter(rooms).keys()
        assert sum(p.count for p in got) == len(rooms)


def test_close_to_the_bound():
    rng = np.random.default_rng(5)
    x = np.clip(np.exp(rng.normal(5.5, 1.3, 200_000)).astype(int), 1, 1024)
    counts = Counter(x.tolist())
    got = packing.packed_counts(counts)
    assert pieces_of(got, 1024) == counts
    assert sum(p.count for p in got) <= -(-int(x.sum()) // 1024) * 1.001
    assert len(packing.ranges(got)) < 20_000


ROWS = [(i, "word " * n) for i, n in enumerate([0, 1, 5, 900, 1022, 1023, 1024, 2047, 5000, 3, 3, 3, 250, 512])] + [
    (None, None), (3, "twice"), (3, "twice"), (77, "x" * 9000), (78, "<|endoftext|> and after"), (79, "\n" * 6000)]


def check(rows, got, capacity=packing.CAPACITY):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(packing.BYTE_BPE)
    want = []
    for doc, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [packing.END]
        cuts = sorted({0, *range(len(ids), 0, -capacity)})
        want += [(doc, n, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for n, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert Counter(tuple(r)[:5] for r in got) == Counter(want)
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for members in sequences.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), -(-sum(w[3] for w in want) // capacity)


def test_packed_documents(documents):
    used, least = check(ROWS, packing.packed(documents(ROWS)).collect())
    assert used <= least + 1


def test_numbers_over_tasks_and_blocks(documents, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 2)
    rows = [(i, "a b c" if i % 3 else "word " * (i % 40)) for i in range(500)]
    used, least = check(rows, packing.packed(documents(rows).repartition(7)).collect())
    assert used <= least + 1


@pytest.mark.parametrize("rows", [[], [(1, None)]])
def test_small_tables(documents, rows):
    check(rows, packing.packed(documents(rows)).collect())
