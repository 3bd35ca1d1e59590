import numpy as np
import pytest

from lognorm.llm import nearest as nn


def frame(spark, rows):
    return spark.createDataFrame([(i, v, None, None) for i, v in rows], "vec_id long, embedding array<float>, cell int, vec string").repartition(3)


def brute(rows, k=5, every=50):
    """Of every row with a query id, in order of rows: its nearest other rows of its length."""
    fine = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in rows
            if v is not None and None not in v and np.isfinite(v).all() and any(v)]
    out = {}
    for q, (i, x) in enumerate(fine):
        if i is not None and i % every == 0:
            scores = [(-(x * y).sum() / (np.sqrt((x * x).sum()) * np.sqrt((y * y).sum())), 1 << 62 if j is None else j)
                      for n, (j, y) in enumerate(fine) if n != q and len(y) == len(x)]
            out.setdefault(i, []).append([(j, -s) for s, j in sorted(scores)[:k]])
    return {i: v[0] for i, v in out.items()} if all(len(v) == 1 for v in out.values()) else out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def clustered(n=3000, length=24, seed=2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(20, length))
    return [(i, [float(np.float32(x)) for x in centres[rng.integers(20)] + 0.5 * rng.normal(size=length)]) for i in range(n)]


@pytest.mark.parametrize("block, part", [(nn.BLOCK, nn.QUERY_BLOCK), (100, 13)])
def test_recall_and_scores(spark, monkeypatch, block, part):
    monkeypatch.setattr(nn, "BLOCK", block)
    monkeypatch.setattr(nn, "QUERY_BLOCK", part)
    rows = clustered()
    got, want = found(nn.nearest(frame(spark, rows), "vec_id % 50 = 0")), brute(rows)
    assert got.keys() == want.keys() and all(len(v) == 5 for v in got.values())
    hits = sum(len({a for a, _ in got[q]} & {a for a, _ in want[q]}) for q in want)
    assert hits >= 0.95 * 5 * len(want)
    for q in want:
        exact = dict(want[q])
        assert all(abs(s - exact[a]) < 1e-12 for a, s in got[q] if a in exact)


def test_copies_ties_and_hot_vectors(spark):
    rng = np.random.default_rng(3)
    one = [1.0, 2.0, 3.0, 4.0]
    rows = [(i, one) for i in range(0, 400)] + [(400 + i, [float(np.float32(x)) for x in rng.normal(size=4)]) for i in range(300)]
    got, want = found(nn.nearest(frame(spark, rows), "vec_id % 50 = 0")), brute(rows)
    for q in (0, 50, 350):
        assert [a for a, _ in got[q]] == [a for a, _ in want[q]] == [i for i in range(6) if i != q][:5]


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, None), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [1.0, None]), (6, [1.0, 1.0]), (7, [1.0, 1.0, 1.0]),
            (None, [1.0, 0.5]), (8, [0.5, 0.1]), (8, [0.5, 0.1]), (50, []), (100, [-1.0, 0.25]), (9, [1e30, 1e30])]
    got = found(nn.nearest(frame(spark, rows), "vec_id % 50 = 0"))
    assert {q: [a for a, _ in v] for q, v in got.items()} == {0: [8, 8, None, 6, 9], 100: [6, 9, None, 8, 8]}
    assert nn.nearest(frame(spark, []), "vec_id % 50 = 0").count() == 0
    assert nn.nearest(frame(spark, [(0, [1.0])]), "vec_id % 50 = 0").count() == 0
    assert nn.nearest(frame(spark, [(1, [1.0]), (2, [2.0])]), "vec_id % 50 = 0").count() == 0


def test_chi_square():
    assert nn.chi_square_quantile(0.99, 8) == pytest.approx(20.0902, abs=1e-3)
    rng = np.random.default_rng(1)
    v = rng.normal(size=(4000, 40))
    p = nn.projected(v)
    far = ((p[:2000] - p[2000:]) ** 2).sum(axis=1)
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    true = ((u[:2000] - u[2000:]) ** 2).sum(axis=1)
    assert 0.975 < np.mean(far <= nn.STOP * true) < 1.0


def test_repeated_ids_and_mixed_lengths(spark):
    """Every row is a candidate; a query in two rows is asked twice; lengths do not mix."""
    rng = np.random.default_rng(9)
    number = lambda: float(np.float32(rng.normal()))
    rows = [(int(rng.integers(0, 200)), [number() for _ in range(3 + n % 3)]) for n in range(900)] + [(7, [1.0, 0.0, 0.0]), (7, [0.0, 1.0, 0.0]), (1000, [1.0, 0.01, 0.0])]
    got = nn.nearest(frame(spark, rows), "vec_id % 50 = 0").collect()
    want = brute(rows)
    have = sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in got)
    full = sorted((q, n + 1, j, round(s, 9)) for q, lists in want.items() for found in lists for n, (j, s) in enumerate(found))
    assert len(have) == len(full) and len(set(have) & set(full)) >= 0.99 * len(set(full))
    assert (1000, 1, 7) in {h[:3] for h in have}
