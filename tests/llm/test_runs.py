import hashlib
import random
import zlib

from lognorm.llm import runs


def brute(w):
    """Every period of every document, one after the other."""
    n, out = len(w), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q) and (i, length) not in out:
                if not any(all(w[k] == w[k + p] for k in range(i, i + length - p)) for p in range(1, q)):
                    out[i, length] = q
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda x: (x[0], x[2]))


def repetitive(rng):
    k = rng.choice([1, 2, 2, 3, 8])
    w = [rng.randrange(k) for _ in range(rng.choice([0, 1, 5, 6, 7, 20, 60, 120]))]
    if rng.random() < 0.6:
        unit = [rng.randrange(3) for _ in range(rng.randint(1, 6))]
        w[len(w) // 2:len(w) // 2] = unit * rng.randint(2, 9) + unit[:1]
    return w * rng.randint(1, 5) if rng.random() < 0.3 else w


def test_all_runs_of_many_documents():
    rng = random.Random(5)
    for _ in range(40):
        docs = [repetitive(rng) for _ in range(40)]
        assert runs.runs(docs) == [brute(d) for d in docs]


def test_long_documents():
    assert runs.runs([[0] * 50_000]) == [[(0, 50_000, 1)]]
    unit = list(range(700))
    assert runs.runs([unit * 41 + unit[:5]]) == [[(0, 700 * 41 + 5, 700)]]
    assert runs.runs([list(range(20_000))]) == [[]]


def test_positions_keep_order(monkeypatch):
    monkeypatch.setattr(runs.Positions, "BLOCK", 4)
    rng = random.Random(1)
    numbers = rng.sample(range(1000), 300)
    found, have = runs.Positions(numbers[0]), [numbers[0]]
    for x in numbers[1:]:
        have = sorted([*have, x])
        at = have.index(x)
        assert found.add(x) == (have[at - 1] if at else -1, have[at + 1] if at + 1 < len(have) else -1)
        assert list(found) == have


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(doc_id, text):
    w = [x for x in (text or "").replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if x]
    h, n = zlib.crc32(b"" if doc_id is None else str(doc_id).encode()), len(w)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute(w)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = max(found, key=lambda x: (x[1], -x[0], -x[2])) if found else (None, None, None)
    return (doc_id, len(found), *best, best[1] * 1000 // best[2] if found else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def rows(rng):
    out = [(None, None), (1, ""), (2, " \t\n"), (3, "a a a a a a"), (3, "a a a a a a"), (4, "A a A a A a A a"), (5, "x x x x"), (None, "q " * 9)]
    for i in range(6, 160):
        out.append((i, rng.choice([" ", "\n", " \t "]).join(f"w{x}" for x in repetitive(rng))))
    return out


def test_documents_against_brute_force(documents):
    given = rows(random.Random(8))
    got = sorted((tuple(r) for r in runs.summaries(documents(given), plant=True).collect()), key=str)
    assert got == sorted((expected(*r) for r in given), key=str)
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in given if i)


def test_runs_and_collapsed_text(documents):
    got = runs.periodic_runs(documents([(1, "go a b a b a b a b stop"), (2, None)])).orderBy("doc_id").collect()
    assert [tuple(x) for x in got[0]["runs"]] == [(1, 8, 2)] and got[0]["collapsed"] == "go a b stop"
    assert got[1]["runs"] == [] and got[1]["collapsed"] == ""


def test_empty_table(documents):
    assert runs.summaries(documents([]), plant=True).collect() == []
