import random

from lognorm.llm import decontaminate as dc


def brute(docs, items):
    tok = lambda t: (t or "").encode().lower().split()
    out = []
    for d, text in docs:
        w = tok(text)
        for i, item in items:
            q = tok(item)
            n = min(5, len(q))
            if not n:
                continue
            own = {tuple(q[k:k + n]) for k in range(len(q) - n + 1)}
            have = {tuple(w[k:k + n]) for k in range(len(w) - n + 1)}
            if len(own & have) >= 0.8 * len(own) - 1e-9:
                out.append((d, i, len(own & have), len(own), len(own & have) / len(own)))
    return sorted(out, key=str)


def corpus():
    rng = random.Random(11)
    word = lambda: rng.choice("abcdefghijklmnopqrstuvwxyz") + rng.choice("abcd") + rng.choice("xyz")
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(i, text(rng.choice([1, 2, 3, 4, 5, 6, 9, 20, 70, 200]))) for i in range(40)]
    items += [(40, ""), (41, None), (42, items[7][1]), (7, items[7][1]), (43, "Aax BBX ccx ddx eex ffx " * 3)]
    docs = []
    for i in range(120):
        body = text(rng.randint(0, 300)).split()
        for _ in range(rng.randint(0, 2)):
            words = (rng.choice(items)[1] or "").split()
            for _ in range(rng.choice([0, 0, 1, 3])):  # damage some words
                if words:
                    words[rng.randrange(len(words))] = word()
            at = rng.randint(0, len(body))
            body[at:at] = [w.upper() if rng.random() < 0.3 else w for w in words]
        docs.append((i, "\n".join(body) if i % 2 else "  ".join(body)))
    docs += [(200, None), (201, ""), (3, docs[3][1]), (202, text(40_000) + " " + items[9][1])]
    return docs, items


def test_pairs_equal_brute_force(spark, documents):
    docs, items = corpus()
    frame = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((tuple(r) for r in dc.contained_items(documents(docs), frame).collect()), key=str)
    assert got == brute(docs, items) and len(got) > 20
    hit = {d for d, *_ in got}
    kept = dc.decontaminated(documents(docs), frame)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, _ in docs if d not in hit)


def test_item_blocks_change_nothing(spark, documents, monkeypatch):
    docs, items = corpus()
    frame = spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(map(tuple, dc.contained_items(documents(docs), frame).collect()))
    monkeypatch.setattr(dc.item_blocks, "__defaults__", (400,))
    assert len(list(dc.item_blocks(frame, "item_id", "text"))) > 3
    assert sorted(map(tuple, dc.contained_items(documents(docs), frame).collect())) == whole


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    assert dc.contained_items(documents([(1, "a b c d e")]), none).count() == 0
    assert dc.decontaminated(documents([(1, "a b c d e")]), none).count() == 1
    items = spark.createDataFrame([(1, "a b c d e")], "item_id long, text string")
    assert dc.contained_items(documents([]), items).count() == 0
