"""The pipeline against a plain version of its decisions, and every query on empty and odd tables."""

import random

import pytest
from test_decontaminate import brute as contained
from test_models import prose
from test_near_copies import brute as components

import corpus_pipeline as cp
from lognorm.llm import secret_scan as ss
from lognorm.llm import sentencepiece_codec as sp
from lognorm.llm import toxicity as tx
from lognorm.llm.queries import REGISTRY, SQL

SCHEMAS = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long, fp int, score string",
    "labels": "doc_id long, quality int, toxic int, text string",
    "benchmark": "item_id long, text string, doc_id string",
    "pages": "page_id long, url string, html string, keys int",
    "embeddings": "vec_id long, embedding array<float>, label int, cell string",
}


def written(spark, folder, **tables):
    for name, schema in SCHEMAS.items():
        width = schema.count(",") + 1
        rows = [(*r, *[None] * (width - len(r))) for r in tables.get(name, [])]
        spark.createDataFrame(rows, schema).repartition(2).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def corpus():
    rng = random.Random(21)
    docs, labels = [], []
    for i in range(400):
        toxic = int(rng.random() < 0.3)
        t = prose(rng, rng.randint(60, 160), 0.06 * toxic)
        docs.append((i, t, "en", "s", len(t)))
        labels.append((i, 1, toxic))
    items = [(k, prose(rng, n)) for k, n in enumerate([8, 20, 60])]
    clean = [d for d in docs if not labels[d[0]][2]]
    extra = [(1000, clean[0][1]), (1001, clean[1][1] + " end"), (1002, " ".join(clean[2][1].split()[:40]) + " " + items[1][1]), (1003, items[2][1].upper()),
             (1004, 'x token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" y'), (1005, None), (1006, ""), (1007, "w" * 60_000), (1008, "one two")]
    for n, d in enumerate(clean[10:40]):  # near copies around the threshold
        words = d[1].split()
        for _ in range(n // 10 * 2 + 1):
            words[rng.randrange(len(words))] = f"other{n}"
        extra.append((2000 + n, " ".join(words)))
    docs += [(i, t, None, None, len(t or "")) for i, t in extra]
    return docs, labels, items


def test_pipeline_against_a_plain_version(spark, tmp_path):
    docs, labels, items = corpus()
    sf = written(spark, tmp_path / "sf", documents=docs, labels=labels, benchmark=items)
    rows = {r.doc_id: r for r in cp.run(spark, sf).collect()}

    texts = {d[0]: d[1] for d in docs}
    score = tx.fit([(i, texts[i] or "", y) for i, _, y in labels]).scorer().score
    left = [(i, t) for i, t in texts.items() if score((t or "").encode()) < 0.5]
    assert len(left) < len(texts) - 80
    roots = components(left)
    near = sum(roots[i] < 2000 for i, _ in left if i >= 2000)
    assert 5 < near < 30
    left = [(i, t) for i, t in left if i == roots[i]]
    assert 1000 not in dict(left) and 1006 not in dict(left)  # a copy, and a second text without words
    leaks = {d for d, *_ in contained(left, items)}
    assert leaks == {1002, 1003}
    left = [(i, t) for i, t in left if i not in leaks]
    assert rows.keys() == {i for i, _ in left}
    assert rows[1004].decoded == "x [SECRET] y" or rows[1004].decoded == 'x [SECRET]" y'
    for i, t in left:
        if i != 1004:
            assert rows[i].decoded == (t or "")
    encoder = sp.Encoder(sp.load_pieces(sp.MODEL))
    assert all(r.ids == encoder.encode([r.decoded])[0].tolist() for r in rows.values())


def test_every_stage_keeps_columns_and_takes_odd_tables(spark, tmp_path):
    odd = [(None, None), (None, None), (3, ""), (3, ""), (4, "a b c d e f g"), (4, "other words than before are here"), (5, "  \n ")]
    full = written(spark, tmp_path / "odd", documents=odd, labels=[(3, 0, 1), (3, None, None), (None, 1, 0)], benchmark=[(None, None), (1, "")])
    empty = written(spark, tmp_path / "empty")
    for sf, least in ((full, 2), (empty, 0)):
        docs = spark.read.parquet(f"{sf}/documents.parquet")
        for name, stage in cp.STAGES:
            out = stage(spark, docs, sf)
            if name != cp.STAGES[-1][0]:
                assert out.schema.names == docs.schema.names, name
            out.write.parquet(f"{sf}/out-{name}")
            docs = spark.read.parquet(f"{sf}/out-{name}")
        assert docs.count() >= least


def test_counts_of_characters_follow_redaction(spark, tmp_path):
    secret = "AKIA" + "ABCDEFGH12345678"
    sf = written(spark, tmp_path / "sf", documents=[(1, f"key {secret} end", "en", "s", 28), (2, "[SECRETS]", "en", "s", 9), (3, "plain", None, None, None)])
    got = {r.doc_id: (r.text, r.n_chars) for r in cp.secrets(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf).collect()}
    assert got == {1: (f"key {ss.REPLACEMENT} end", 4 + len(ss.REPLACEMENT) + 4), 2: ("[SECRETS]", 9), 3: ("plain", None)}


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_queries_on_empty_and_odd_tables(spark, tmp_path, name):
    empty = written(spark, tmp_path / "empty")
    found = REGISTRY[name](spark, empty)
    assert found.count() == 0
    sf = written(
        spark, tmp_path / "odd", documents=[(None, None), (1, None), (1, None), (2, ""), (50, "a b c d e f"), (51, "A B C D E F")],
        labels=[(1, None, None), (2, 1, 1), (50, 0, 0)], benchmark=[(None, None), (1, "b c d e f")],
        pages=[(None, None, None), (1, "", ""), (1, "", ""), (2, "http://x.org/", "<p>a")],
        embeddings=[(None, None), (0, None), (50, [1.0, 2.0]), (51, [2.0, 4.0]), (51, [2.0, 4.0])])
    rows = REGISTRY[name](spark, sf)
    assert rows.columns == found.columns and rows.dtypes == found.dtypes
    expected = {"op2": 2, "op3": 4, "op5": 8, "op10": 2}.get(name.split("_")[0], 6)
    assert rows.count() == expected


def test_twins_belong_to_queries():
    assert SQL.keys() <= REGISTRY.keys()
