import itertools
import random
import time

import numpy as np
import pytest

from lognorm.llm import near_copies as nc


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """doc_id -> smallest doc_id of its component, by comparing all pairs."""
    parent = {d: d for d, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = {d: shingles(t) for d, t in rows}
    for a, b in itertools.combinations(sorted(sets), 2):
        p, q = sets[a], sets[b]
        if p == q or 5 * len(p & q) >= 4 * len(p | q):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {d: find(d) for d in parent}


def corpus():
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(3000)}"
    lines = [" ".join(word() for _ in range(12)) for _ in range(4)]
    texts = [None, "", "  ", "One two", "one TWO", "one two three"]
    for _ in range(40):
        base = [word() for _ in range(rng.randint(5, 150))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 4)):  # near copies around the threshold, and copies of copies
            base = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 45))):
                base[rng.randrange(len(base))] = word()
            texts.append(" ".join(base))
    texts += [rng.choice(lines) + " " + " ".join(word() for _ in range(rng.randint(1, 8))) for _ in range(60)]
    return list(enumerate(texts))


@pytest.mark.parametrize("common", [False, True])
def test_components_are_those_of_all_pairs(spark, documents, monkeypatch, common):
    if common:
        monkeypatch.setattr(nc, "SAMPLE", 1)
    rows = corpus()
    got = {r.doc_id: r.component_id for r in nc.near_copies(documents(rows)).collect()}
    want = brute(rows)
    assert got == want and len(set(want.values())) < len(rows) - 60


def test_one_row_stays_of_copies_that_differ_in_many_bits(spark, documents):
    rng = random.Random(3)
    base = [f"w{rng.randrange(5000)}" for _ in range(100)]
    other = base[:50] + ["changed"] + base[51:70] + ["again"] + base[71:]  # Jaccard 86 / 106 = 0.81
    docs = documents([(1, " ".join(base)), (2, " ".join(other)), (3, " ".join(reversed(base)))])
    assert sorted(r.doc_id for r in nc.deduplicated(docs).collect()) == [1, 3]
    from lognorm.llm import simhash as sh
    assert bin(sh.fingerprint(sh.shingle_hashes(" ".join(base).encode())) ^ sh.fingerprint(sh.shingle_hashes(" ".join(other).encode()))).count("1") > sh.RADIUS


def test_repeated_and_missing_ids(spark, documents):
    text = " ".join(f"w{i}" for i in range(40))
    other = " ".join(f"v{i}" for i in range(30))
    rows = [(7, text), (7, text), (7, other), (None, text), (None, None), (3, text + " end"), (9, ""), (9, None), (4, other)]
    got = sorted((str(r.doc_id), str(r.component_id)) for r in nc.near_copies(documents(rows)).collect())
    assert got == sorted([("7", "3"), ("7", "3"), ("7", "4"), ("None", "3"), ("None", "9"), ("3", "3"), ("9", "9"), ("9", "9"), ("4", "4")])
    assert nc.near_copies(documents([])).collect() == []


def test_texts_of_many_thousand_words(spark, documents):
    rng = random.Random(4)
    long = [f"w{rng.randrange(50_000)}" for _ in range(30_000)]
    near, far = list(long), list(long)
    for i in range(0, 30_000, 100):
        near[i] = "x"  # 5 of 100 shingles change: Jaccard 0.9
    for i in range(0, 30_000, 30):
        far[i] = "y"  # 5 of 30: 0.71
    got = {r.doc_id: r.component_id for r in nc.near_copies(documents([(1, " ".join(long)), (2, " ".join(near)), (3, " ".join(far))])).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


@pytest.mark.parametrize("own", [150, 215])
def test_shared_passages_make_few_pairs(spark, documents, monkeypatch, own):
    """Texts of 1,000 common words and some of their own stay under 0.8: 0.77 and 0.70."""
    joined = []
    possible = nc._possible

    def counted(pairs, sets):
        joined.append(pairs.count())
        return possible(pairs, sets)

    monkeypatch.setattr(nc, "_possible", counted)
    monkeypatch.setattr(nc, "SAMPLE", 1)
    common = " ".join(f"b{i}" for i in range(1000))
    rows = [(i, common + " " + " ".join(f"o{i}x{k}" for k in range(own))) for i in range(120)]
    got = {r.doc_id: r.component_id for r in nc.near_copies(documents(rows)).collect()}
    assert got == {i: i for i in range(120)} and sum(joined) <= 120


def test_simhash_joins_what_it_finds_before_prefixes_are_compared(spark, documents, monkeypatch):
    rng = random.Random(8)
    base = [f"w{rng.randrange(50_000)}" for _ in range(3000)]
    rows = [(i, " ".join([*base[:100 * i], "changed", *base[100 * i + 1:]])) for i in range(1, 9)]
    left = []
    possible = nc._possible

    def counted(pairs, sets):
        left.append(pairs.count())
        return possible(pairs, sets)

    monkeypatch.setattr(nc, "_possible", counted)
    got = {r.doc_id: r.component_id for r in nc.near_copies(documents(rows)).collect()}
    assert got == {i: 1 for i in range(1, 9)} and left == [0, 0, 0]


def test_a_set_does_not_pay_for_all_common_shingles():
    """30 ms a text with 50,000 common shingles before: the list grows with the table, up to MOST_COMMON."""
    rng = np.random.default_rng(1)
    common = np.unique(rng.integers(0, 2**63, nc.MOST_COMMON, dtype=np.uint64))
    sets = [np.unique(np.concatenate([rng.integers(0, 2**63, 400, dtype=np.uint64), rng.choice(common, 100)])) for _ in range(200)]
    began = time.process_time()
    got = [nc.ordered_prefix(s, common) for s in sets]
    assert time.process_time() - began < 2
    known = set(common.tolist())
    for s, (head, inner, rare) in zip(sets, got):
        order = sorted(s.tolist(), key=lambda x: (x in known, x))
        assert head.tolist() == order[:len(s) - -(-4 * len(s) // 5) + 1] and rare == sum(x not in known for x in order)


def test_sketches_never_part_near_copies():
    rng = random.Random(6)
    bits = lambda p, q: sum(bin(int(x)).count("1") for x in (nc.sketch(p) ^ nc.sketch(q)).view(np.uint64))
    for _ in range(300):
        n = rng.choice([1, 2, 5, 30, 200, 3000])
        both = [rng.getrandbits(64) for _ in range(n)]
        p, q = (np.unique(np.array(both[:rng.randint(max(1, n * 8 // 10), n)] + [rng.getrandbits(64) for _ in range(rng.randint(0, n // 5))], dtype=np.uint64)) for _ in range(2))
        shared = len(np.intersect1d(p, q))
        assert bits(p, q) <= len(p) + len(q) - 2 * shared
        if shared * 5 >= 4 * (len(p) + len(q) - shared):
            assert bits(p, q) * 9 <= len(p) + len(q)


def test_a_family_just_under_the_threshold_makes_few_pairs(spark, documents, monkeypatch):
    """Copies of one text, each changed in places of its own: they share most shingles, and all stay under 0.8."""
    left = []
    possible = nc._possible

    def counted(pairs, sets):
        left.append(pairs.count())
        return possible(pairs, sets)

    monkeypatch.setattr(nc, "_possible", counted)
    rng = random.Random(9)
    base = [f"w{rng.randrange(50_000)}" for _ in range(200)]
    rows = []
    for i in range(60):
        words = list(base)
        for at in range(i % 10, 200, 28):
            words[at] = f"own{i}x{at}"
        rows.append((i, " ".join(words)))
    got = {r.doc_id: r.component_id for r in nc.near_copies(documents(rows)).collect()}
    assert got == brute(rows) == {i: i for i in range(60)}
    assert left[2] <= 60
