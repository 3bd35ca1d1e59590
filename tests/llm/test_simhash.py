import itertools
import random

import numpy as np
import pytest
import xxhash

from lognorm.llm import simhash as sh
from lognorm.llm.components import components


def plain(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    parts = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hs = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute(fps):
    """(doc_id, fp) -> smallest doc_id of the linked rows, by comparing all pairs."""
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (i, (_, a)), (j, (_, b)) in itertools.combinations(enumerate(fps), 2):
        if bin((a ^ b) & (1 << 64) - 1).count("1") <= sh.RADIUS:
            parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(fps):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [least.get(find(i)) for i in range(len(fps))]


def test_fingerprint_follows_the_definition():
    rng = random.Random(1)
    for t in ["", "   \n", "one", "One two", "a b c d", "A\tb\x0bc d e", "É é É é ß"] + [
            " ".join(rng.choice(["x", "yy", "Zed", "é"]) for _ in range(rng.randint(1, 40))) for _ in range(50)]:
        assert sh.fingerprint(sh.shingle_hashes(t.encode())) == plain(t)


@pytest.mark.parametrize("level", [0, 1, 7])
def test_every_pair_within_the_radius_meets_in_some_table(level):
    masks = sh.covering_masks(level)
    assert len(masks) == 31
    rng = random.Random(level)
    for _ in range(3000):
        bits = sum(1 << b for b in rng.sample(range(64), sh.RADIUS))
        assert any(bits & m == 0 for m in masks)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_components_of_dense_balls_and_chains(spark, monkeypatch):
    """Small buckets force the splitting of large ones; the classes stay those of all pairs."""
    rng = random.Random(4)
    centre = rng.getrandbits(64)
    fps = {centre}
    for _ in range(150):
        fps.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4))))
    at = rng.getrandbits(64)
    for _ in range(12):  # a chain: each 4 bits from the one before
        fps.add(at)
        at ^= sum(1 << b for b in rng.sample(range(64), 4))
    low = rng.getrandbits(64) & ~15
    fps |= {low | x for x in range(16)}  # all within 4 open bits: a star
    fps |= {rng.getrandbits(64) for _ in range(60)}
    rows = [(i, signed(f)) for i, f in enumerate(sorted(fps))]
    want = brute(rows)
    for bucket in (64, 3):
        found = sh.classes(spark.createDataFrame(rows, "doc_id long, fp long")) if bucket == 64 else None
        links = sh.links(spark.createDataFrame(rows, "doc_id long, fp long").select("fp"), bucket=bucket)
        assert all(bin((r.a ^ r.b) & (1 << 64) - 1).count("1") <= 4 for r in links.collect())
        if found is not None:
            got = {r.fp: r.component_id for r in found.collect()}
            assert [got[f] for _, f in rows] == want
        else:
            roots = {r.node: r.root for r in components(links).collect()}
            classes = {}
            for (d, f), w in zip(rows, want, strict=True):
                classes.setdefault(roots.get(f, f), set()).add(w)
            assert all(len(v) == 1 for v in classes.values()) and len(classes) == len(set(want))


def test_components_of_paths_and_hubs(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 160), 100)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


LONG = " ".join(f"w{i % 997}x{i % 13}" for i in range(30_000))
ROWS = [(1, "the quick brown fox jumps over it"), (5, "The QUICK brown fox jumps over it"), (2, ""), (3, None), (9, "  "),
        (4, LONG), (6, LONG + " more"), (7, "one"), (7, "one"), (8, "quite different words stand here now"), (None, "no id at all here"),
        (None, None), (8, "the quick brown fox jumps over it")]


def test_rows_and_classes(documents):
    got = sorted(((r.doc_id is None, r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in sh.near_duplicates(documents(ROWS)).collect()), key=str)
    fps = [(d, plain(t)) for d, t in ROWS]
    want = sorted(((d is None, d, f, c) for (d, f), c in zip(fps, brute(fps), strict=True)), key=str)
    assert got == want
    assert sh.near_duplicates(documents([])).count() == 0


def test_one_row_of_each_component_stays(documents):
    docs = documents(ROWS)
    kept = sh.deduplicated(docs)
    assert kept.columns == docs.columns
    rows = kept.select("doc_id", "text").collect()
    fps = [(d, plain(t)) for d, t in ROWS]
    roots = brute([(i, f) for i, (_, f) in enumerate(fps)])
    assert len(rows) == len(set(roots))
    best = {}
    for root, (d, _), (_, t) in zip(roots, fps, ROWS, strict=True):
        best.setdefault(root, []).append(d)
    want = sorted(str(min((x for x in ds if x is not None), default=None)) for ds in best.values())
    assert sorted(str(r.doc_id) for r in rows) == want
    assert sh.deduplicated(documents([])).count() == 0
    assert sh.deduplicated(documents([(2, "a b c d e"), (1, "a b c d e")])).select("doc_id").collect() == [(1,)]


def test_hashes_of_long_texts_in_parts():
    hs = np.arange(200_000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    want = sum(1 << b for b in range(64) if 2 * int((hs >> np.uint64(b) & np.uint64(1)).sum()) > len(hs))
    assert sh.fingerprint(hs) == want


def test_rounds_of_few_links_run_in_few_tasks(spark, monkeypatch):
    from lognorm.llm import components as module

    tasks, saved = [], module.saved

    def counted(df):
        out = saved(df)
        tasks.append(out.rdd.getNumPartitions())
        return out

    monkeypatch.setattr(module, "saved", counted)
    links = spark.createDataFrame([(i, i + 1) for i in range(40) if i % 10], "a long, b long")
    merged = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merged, "false")
    try:
        for most, few in ((50_000, True), (5, False)):
            monkeypatch.setattr(module, "LINKS", most, raising=False)
            tasks.clear()
            got = {r.node: r.root for r in module.components(links).collect()}
            assert got == {i: (i - 1) // 10 * 10 + 1 for i in range(1, 41)}
            assert (max(tasks[1:]) == 1) == few
    finally:
        spark.conf.unset(merged)
