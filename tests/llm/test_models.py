"""Toxicity, quality and the language model: accuracy on texts they did not see, and plain versions."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lognorm.llm import language_model as lm
from lognorm.llm import quality, toxicity
from lognorm.llm.common import fold, fold_of

RUDE = ["idiot", "moron", "worthless", "pathetic", "scumbag"]
SYLLABLES = ["th", "er", "on", "an", "re", "ti", "es", "ou", "ing", "ly"]


def word(rng):
    return "".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4)))


def prose(rng, n, rude=0.0):
    return " ".join(rng.choice(RUDE) + rng.choice(["", ",", "!"]) if rng.random() < rude else word(rng) for _ in range(n))


@pytest.fixture(scope="module")
def labelled():
    rng = random.Random(8)
    rows = []
    for i in range(900):
        toxic = int(rng.random() < 0.3)
        rows.append((i, prose(rng, rng.randint(60, 250), 0.06 * toxic), toxic))
    return rows


@pytest.fixture(scope="module")
def model(labelled):
    return toxicity.fit([r for r in labelled if fold_of(r[0], 5) != 0])


def test_toxicity_on_held_out_texts(labelled, model):
    score = model.scorer().score
    held = [(score(t.encode()), y) for i, t, y in labelled if fold_of(i, 5) == 0]
    assert np.mean([(s >= 0.5) == y for s, y in held]) > 0.95
    assert all(0 <= s <= 1 for s, _ in held)


def test_toxicity_fit_is_repeatable_and_blind_to_order(labelled, model):
    rows = [r for r in labelled if fold_of(r[0], 5) != 0]
    again = toxicity.fit(rows[::-1])
    assert (again.toxic, again.ratios, again.weights) == (model.toxic, model.ratios, model.weights)


def test_toxicity_scores_are_of_each_text_alone(labelled, model, monkeypatch):
    texts = [t.encode() for _, t, _ in labelled[:40]]
    one = [model.scorer().score(t) for t in texts]
    monkeypatch.setattr(toxicity, "REMEMBER", 5)
    scorer = model.scorer()
    assert [scorer.score(t) for t in texts[::-1]][::-1] == one


@pytest.mark.parametrize("rows", [[], [(1, "a b", 1)], [(1, "a b", 0), (2, None, 0)], [(1, "a", 0), (2, "b", 1)], [(1, "", None)]])
def test_toxicity_without_enough_labels_is_constant(rows):
    m = toxicity.fit(rows)
    assert 0 < m.scorer().score(b"") == m.scorer().score(b"anything at all") < 1


def test_toxicity_frames(spark, documents, labelled, model):
    rows = [(1, labelled[0][1]), (1, labelled[0][1]), (None, "x"), (2, None), (3, ""), (4, "z" * 200_000), (5, "é ñ 漢字 " * 5_000)]
    got = toxicity.scored(documents(rows), model).collect()
    score = model.scorer().score
    assert sorted((r.doc_id or -1, r.score) for r in got) == sorted((i or -1, score((t or "").encode())) for i, t in rows)
    kept = toxicity.without_toxic(documents(rows), model)
    assert kept.columns == documents(rows).columns
    assert kept.count() == sum(score((t or "").encode()) < 0.5 for _, t in rows)
    assert toxicity.scored(documents([]), model).count() == 0


def test_sample_keeps_to_folds_bounds_and_known_labels(spark, documents):
    docs = documents([(i, "t" * (20 + i)) for i in range(100)] + [(100, "y" * 20_000), (7, None)])
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(101)] + [(3, None, None), (5, 7, None), (6, 0, None)], "doc_id long, toxic int, text string")
    got = toxicity.sample(docs, labels, "toxic", rows=10)
    assert len(got) == 20 and Counter(y for *_, y in got) == {0: 10, 1: 10}
    assert all(fold_of(i, 5) != 0 and y == i % 2 and i < 100 for i, _, y in got)
    assert got != [] and sorted(got) == sorted(toxicity.sample(docs, labels, "toxic", rows=10))
    everything = toxicity.sample(docs, labels, "toxic", held_out=None)
    assert {i for i, *_ in everything} == set(range(100))


def test_fold_in_spark_and_in_tasks(spark):
    rows = spark.range(50).select("id", fold(F.col("id"), 7).alias("f")).collect()
    assert all(r.f == fold_of(r.id, 7) for r in rows)
    assert spark.sql("SELECT CAST(NULL AS BIGINT) AS id").select(fold(F.col("id"), 7).alias("f")).collect()[0].f == fold_of(None, 7)


def shouted(rng, n):
    return " ".join(word(rng).upper() + "!!" if rng.random() < 0.9 else word(rng) for _ in range(n))


@pytest.fixture(scope="module")
def judged():
    rng = random.Random(9)
    return [(i, shouted(rng, rng.randint(30, 200)) if i % 4 == 0 else prose(rng, rng.randint(30, 200)) + ".", int(i % 4 != 0)) for i in range(400)]


def test_quality_on_held_out_texts(spark, judged):
    docs = spark.createDataFrame([(i, t) for i, t, _ in judged], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in judged], "doc_id long, quality int")
    model = quality.train(docs, labels)
    assert model.rules and len(model.rules) < 100  # sparse
    label = {i: y for i, _, y in judged}
    rows = quality.scored(docs, model).collect()
    assert np.mean([r.predicted == label[r.doc_id] for r in rows if fold_of(r.doc_id, 5) == 0]) > 0.97
    # The compiled expression says what the rules say.
    x = np.array([[r[s] for s in quality.STATISTICS] for r in rows])
    assert np.allclose(model.score(x), [r.score for r in rows])
    assert all(r.predicted == (r.score >= 0.3) for r in rows)


def test_quality_frames(spark, documents):
    model = quality.fit(np.zeros((0, len(quality.STATISTICS))), np.zeros(0))
    rows = [(1, "a a\na a"), (1, "a a\na a"), (None, "x"), (2, None), (3, ""), (4, "z" * 300_000), (5, " \n\t ")]
    got = quality.scored(documents(rows), model).collect()
    assert len(got) == len(rows) and {r.score for r in got} == {0.5}
    empty = [r for r in got if r.doc_id in (2, 3, 5)]
    assert all(r[s] == 0 for r in empty for s in quality.STATISTICS)
    assert quality.scored(documents([]), model).count() == 0
    one = next(r for r in got if r.doc_id == 1)
    assert one.repeated_lines == 0.5 and one.distinct_words == 0.25 and one.top_word == 1


def test_lasso_drops_noise():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2, size=(600, 30)).astype(float)
    y = (rng.random(600) < 1 / (1 + np.exp(-(4 * x[:, 3] - 2)))).astype(float)
    _, w = quality.lasso_logistic(x, y, 0.02)
    assert w[3] > 1 and (w != 0).sum() < 8


ROWS = [(i, prose(random.Random(i), 40)) for i in range(60)] + [(7, "The THE the"), (7, "The THE the"), (None, "no id"), (70, None), (71, ""), (72, "é\x0bÉ x"), (73, "wort " * 30_000)]


def plain_base(rows, training):
    counts = Counter()
    for i, t in rows:
        if training(i):
            counts.update([*(t or "").encode().lower().split(), None])
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, t in rows:
        tokens = [*(t or "").encode().lower().split(), None]
        out.append((i if i is not None else -1, len(tokens), sum(counts[w] > 0 for w in tokens), n,
                    round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens), 6)))
    return sorted(out)


@pytest.mark.parametrize("hot, counted", [(lm.HOT, lm.COUNTED), (5, 10)])
def test_unigram_sums(documents, monkeypatch, hot, counted):
    """With few hot words nearly all go through the join; the sums stay the same."""
    monkeypatch.setattr(lm.vocabulary, "__defaults__", (3, hot))
    monkeypatch.setattr(lm, "COUNTED", counted)
    got = lm.score_corpus(documents(ROWS), fold(F.col("doc_id"), 7) != 2).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == \
        plain_base(ROWS, lambda i: fold_of(i, 7) != 2)
    assert all(r.score < 0 for r in got)


def test_model_is_normalised_over_all_words(spark, documents):
    docs = documents([(i, prose(random.Random(i), 60)) for i in range(80)])
    counts = lm.count_words(docs).cache()
    v = lm.vocabulary(counts, classes=20)
    model = lm.trained(docs, v)
    scorer = lm.Scorer(model)
    everything = np.arange(lm.END, v.size)
    for h1, h2 in [(lm.START, lm.START), (lm.FIRST, lm.START), (lm.OTHER, lm.FIRST + 2)]:
        logs = scorer.log10(everything, np.full(len(everything), h1), np.full(len(everything), h2))
        assert (10**logs).sum() == pytest.approx(1, abs=1e-4)
    # A text's score is the sum over its tokens, worked out one by one.
    c = {r.word: r.c for r in counts.where("word IS NOT NULL").collect()}
    text = " ".join([*list(c)[:6], "neverseenword"])
    known = {w: i + lm.FIRST for w, i in v.hot.items() if i < v.classes}
    path, want = [lm.START, lm.START], 0.0
    for w in [*text.encode().split(), None]:
        k = lm.END if w is None else known.get(w, lm.OTHER)
        want += scorer.log10(np.array([k]), np.array(path[-1:]), np.array(path[-2:-1]))[0]
        want += math.log10(c.get(w.decode(), 0) + 1) - v.other if k == lm.OTHER else 0.0
        path.append(k)
    assert lm.scored(documents([(0, text)]), counts, model).collect()[0].score == pytest.approx(want, abs=1e-4)
    # Within class "other": the shares of its words and of one unseen word add up to 1.
    rest = [w for w in c if v.hot.get(w.encode(), 10**9) >= v.classes]
    assert (sum(c[w] + 1 for w in rest) + 1) / 10**v.other == pytest.approx(1)


def test_training_learns_what_follows_what(documents):
    rng = random.Random(3)
    texts = [" ".join("a b c d".split()[(k + j) % 4] for j in range(40)) for k in (rng.randint(0, 3) for _ in range(300))]
    docs = documents(list(enumerate(texts)))
    counts = lm.count_words(docs).cache()
    model = lm.trained(docs.unionAll(docs), lm.vocabulary(counts))
    rows = {r.doc_id: r for r in lm.scored(documents([(1, "a b c d a b c d"), (2, "d a c b b d a c")]), counts, model).collect()}
    assert rows[1].score > rows[2].score + 1 and rows[1].score > rows[1].base_score


def test_language_model_edges(documents):
    assert lm.score_corpus(documents([]), F.lit(True)).count() == 0
    r = lm.score_corpus(documents([(1, "only held out")]), F.lit(False)).collect()[0]
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (4, 0, 0, 0.0) and r.score < 0
