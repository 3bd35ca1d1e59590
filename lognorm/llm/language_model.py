"""Log-bilinear language model, trained with noise-contrastive estimation, and corpus unigram scores.

Tokens are words (A-Z lower-cased, split at ASCII white space) and one end a text. The model
predicts classes: the ``CLASSES`` commonest hot words, the end, and "other". The vectors of the two
classes before, each times its own matrix, add up to a prediction whose product with every
class's target vector, plus a bias, is the class's score. A word of class "other" shares that
class's probability in proportion to its count plus one, with one share left for unseen words,
so log-probabilities are normalised over the whole vocabulary.

Word counts cover all training texts: tasks count, Spark adds up. The commonest words, ``HOT`` at
most, and their counts go to every task (a documented bound, about 5 MB); the words of a text beyond
them meet the whole count table in a join, so counts are exact for every word.

Training reads all training texts: every task runs noise-contrastive estimation (numpy,
``NOISE`` shared noise classes a minibatch, drawn by unigram frequency) over its own texts from
common start values, and Spark averages the parameters, weighted by tokens; only the average
reaches the driver. Scoring multiplies batches of contexts with all targets; a context's
normaliser is computed once a worker.

A null text is empty: one token, the end. Repeated rows are scored each. Without training texts
all counts are 0 and the model is uniform.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lognorm.llm.common import column_of, map_slices, saved, slices, text_or_empty, texts_of, words_of

CLASSES = 1024
WIDTH = 16
HOT = 200_000
NOISE = 16
MINIBATCH = 4096
RATE = 0.1
#: Distinct words a task counts before it passes them on.
COUNTED = 300_000
START, END, OTHER, FIRST = 0, 1, 2, 3
LN10 = float(np.log(10))


@dataclass
class Vocabulary:
    hot: dict[bytes, int]  # word -> place by count; places below ``classes`` are classes of their own
    counts: np.ndarray  # of hot words
    classes: int
    texts: int  # training texts: the end's count
    tokens: int  # N
    distinct: int  # V

    @property
    def size(self) -> int:
        return FIRST + self.classes

    @property
    def other(self) -> float:
        """log10 of the shares that class "other" divides: its tokens, its words, and one for the unseen."""
        own = int(self.counts[: self.classes].sum())
        words = self.tokens - self.texts - own
        kinds = self.distinct - (self.texts > 0) - self.classes
        return float(np.log10(words + kinds + 1))

    def unigram(self) -> np.ndarray:
        """Share of each class, with one more count each; START has none."""
        own = self.counts[: self.classes].astype(float)
        n = np.concatenate([[0.0, self.texts + 1.0, self.tokens - self.texts - own.sum() + 1.0], own + 1.0])
        return n / n.sum()


@dataclass
class Parameters:
    context: np.ndarray  # size x WIDTH
    target: np.ndarray  # size x WIDTH
    first: np.ndarray  # WIDTH x WIDTH, of the class just before
    second: np.ndarray
    bias: np.ndarray

    @staticmethod
    def start(unigram: np.ndarray, seed: int = 3) -> Parameters:
        rng, n = np.random.default_rng(seed), len(unigram)
        draw = lambda *shape: rng.normal(scale=0.1, size=shape).astype(np.float32)
        bias = np.log(np.maximum(unigram, 1e-12)).astype(np.float32)
        return Parameters(draw(n, WIDTH), draw(n, WIDTH), draw(WIDTH, WIDTH) + np.eye(WIDTH, dtype=np.float32), draw(WIDTH, WIDTH), bias)

    def arrays(self) -> list[np.ndarray]:
        return [self.context, self.target, self.first, self.second, self.bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([a.ravel() for a in self.arrays()])

    def like(self, values: np.ndarray) -> Parameters:
        out, at = [], 0
        for a in self.arrays():
            out.append(values[at:at + a.size].reshape(a.shape).astype(np.float32))
            at += a.size
        return Parameters(*out)


def _add_rows(shape: tuple[int, int], rows: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of the values by row number."""
    flat = (rows[:, None] * shape[1] + np.arange(shape[1])).ravel()
    return np.bincount(flat, weights=values.ravel(), minlength=shape[0] * shape[1]).reshape(shape).astype(np.float32)


class Trainer:
    """Noise-contrastive estimation with Adagrad steps."""

    def __init__(self, start: Parameters, unigram: np.ndarray, seed: int):
        self.p = start.like(start.flat())
        self.rng = np.random.default_rng(seed)
        self.cumulative = np.cumsum(unigram)
        self.log_noise = np.log(NOISE * np.maximum(unigram, 1e-12)).astype(np.float32)
        self.squares = [np.full(a.shape, 1e-4, dtype=np.float32) for a in start.arrays()]

    def step(self, w: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> None:
        p, n = self.p, len(w)
        noise = np.minimum(np.searchsorted(self.cumulative, self.rng.random(NOISE)), len(self.cumulative) - 1)
        r1, r2 = p.context[h1], p.context[h2]
        q = r1 @ p.first + r2 @ p.second
        t, tn = p.target[w], p.target[noise]
        true = (q * t).sum(axis=1) + p.bias[w] - self.log_noise[w]
        false = q @ tn.T + p.bias[noise] - self.log_noise[noise]
        g = 1 / (1 + np.exp(np.clip(true, -30, 30)))  # ascent on log sigma(true) + sum log sigma(-false)
        gn = -1 / (1 + np.exp(-np.clip(false, -30, 30)))
        gq = g[:, None] * t + gn @ tn
        one, two = gq @ p.first.T, gq @ p.second.T
        shape = p.context.shape
        gradients = [
            _add_rows(shape, h1, one) + _add_rows(shape, h2, two),
            _add_rows(shape, w, g[:, None] * q) + _add_rows(shape, noise, gn.T @ q),
            r1.T @ gq, r2.T @ gq,
            (np.bincount(w, weights=g, minlength=shape[0]) + np.bincount(noise, weights=gn.sum(axis=0), minlength=shape[0])).astype(np.float32)]
        for a, s, d in zip(p.arrays(), self.squares, gradients, strict=True):
            d = d / n
            s += d * d
            a += RATE * d / np.sqrt(s)

    def learn(self, w: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> None:
        for i in range(0, len(w), MINIBATCH):
            self.step(w[i:i + MINIBATCH], h1[i:i + MINIBATCH], h2[i:i + MINIBATCH])


def contexts(classes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classes one and two places before each token; START before a text's first."""
    starts = np.cumsum(lengths) - lengths
    h1 = np.concatenate([[START], classes[:-1]]) if len(classes) else classes
    h2 = np.concatenate([[START, START], classes[:-2]])[: len(classes)]
    h1[starts] = START
    h2[starts] = START
    h2[(starts + 1)[lengths > 1]] = START
    return h1, h2


@dataclass
class LogBilinear:
    vocabulary: Vocabulary
    p: Parameters

    def normalisers(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """log of the sum over all classes, for a batch of contexts."""
        out = np.empty(len(h1), dtype=np.float32)
        for i in range(0, len(h1), 2048):
            q = self.p.context[h1[i:i + 2048]] @ self.p.first + self.p.context[h2[i:i + 2048]] @ self.p.second
            s = q @ self.p.target[1:].T + self.p.bias[1:]
            top = s.max(axis=1)
            out[i:i + 2048] = top + np.log(np.exp(s - top[:, None]).sum(axis=1))
        return out


class Scorer:
    """log10 probabilities of classes; remembers normalisers of contexts."""

    def __init__(self, model: LogBilinear):
        self.model, p = model, model.p
        self.after1 = p.context @ p.first @ p.target.T + p.bias  # size x size
        self.after2 = p.context @ p.second @ p.target.T
        self.z = np.full(self.after1.shape, np.nan, dtype=np.float32)

    def log10(self, w: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        missing = np.isnan(self.z[h1, h2])
        if missing.any():
            n = len(self.z)
            new = np.unique(h1[missing] * n + h2[missing])
            self.z[new // n, new % n] = self.model.normalisers(new // n, new % n)
        return (self.after1[h1, w].astype(np.float64) + self.after2[h2, w] - self.z[h1, h2]) / LN10


def count_words(texts: DataFrame, text: str = "text") -> DataFrame:
    """(word, c) over all texts; a null word counts the texts themselves (ends)."""
    source = text_or_empty(texts.select(F.col(text).alias("text")))

    def out(counts: Counter, ends: int) -> pa.RecordBatch:
        words = [w.decode("utf-8", "replace") for w in counts]
        return pa.RecordBatch.from_arrays([
            pa.array([*words, None], pa.string()), pa.array([*counts.values(), ends], pa.int64())], ["word", "c"])

    def run(batches):
        counts, ends = Counter(), 0
        for batch in batches:
            for t in texts_of(batch):
                ends += 1
                counts.update(words_of(t))
                if len(counts) > COUNTED:
                    yield out(counts, ends)
                    counts, ends = Counter(), 0
        yield out(counts, ends)

    return source.mapInArrow(run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c")).where("c > 0")


def vocabulary(counts: DataFrame, classes: int = CLASSES, hot: int = HOT) -> Vocabulary:
    """From a saved count table."""
    n = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*"), F.coalesce(F.sum(F.when(F.col("word").isNull(), F.col("c"))), F.lit(0))).head()
    words = counts.where("word IS NOT NULL").withColumn("step", F.floor(F.log2("c") * 16))
    # Whole steps of the count's logarithm from the top, as long as they hold ``hot`` words at most: nothing is sorted.
    least, held = None, 0
    for r in sorted(words.groupBy("step").count().collect(), reverse=True):
        held += r["count"]
        if held > hot:
            break
        least = r["step"]
    found = words.where(F.col("step") >= least).select("word", "c").collect() if least is not None else []
    top = sorted(found, key=lambda r: (-r["c"], r["word"]))
    return Vocabulary(
        {r["word"].encode(): i for i, r in enumerate(top)}, np.array([r["c"] for r in top], dtype=np.int64),
        min(classes, len(top)), int(n[2]), int(n[0]), int(n[1]))


def _classes(lists: list[list[bytes]], known: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """(class of every token with each text's end, tokens of each text)."""
    get = known.get
    lengths = np.array([len(x) + 1 for x in lists], dtype=np.int64)
    out = np.full(int(lengths.sum()), END, dtype=np.int64)
    mask = np.ones(len(out), dtype=bool)
    mask[np.cumsum(lengths) - 1] = False
    out[mask] = np.fromiter((get(w, OTHER) for x in lists for w in x), np.int64, int(mask.sum()))
    return out, lengths


def trained(texts: DataFrame, v: Vocabulary, text: str = "text") -> LogBilinear:
    """One pass of noise-contrastive estimation over all texts, averaged over tasks."""
    unigram = v.unigram()
    start = Parameters.start(unigram)
    known = {w: i + FIRST for w, i in v.hot.items() if i < v.classes}
    shared = texts.sparkSession.sparkContext.broadcast((start, unigram, known))
    source = text_or_empty(texts.select(F.col(text).alias("text")))

    def run(batches):
        begin, noise, classes = shared.value
        trainer, seen = Trainer(begin, noise, TaskContext.get().partitionId()), 0
        for piece in slices(batches, "text"):
            w, lengths = _classes([words_of(t) for t in texts_of(piece)], classes)
            trainer.learn(w, *contexts(w, lengths))
            seen += len(w)
        if seen:
            values = trainer.p.flat().astype(np.float64) * seen
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(-1, len(values)), pa.int32()), pa.array(np.concatenate([[float(seen)], values]))], ["i", "x"])

    total = {r["i"]: r["x"] for r in source.mapInArrow(run, "i int, x double").groupBy("i").agg(F.sum("x").alias("x")).collect()}
    weight = total.pop(-1, 0.0)
    if not weight:
        return LogBilinear(v, start)
    values = np.array([total[i] for i in range(len(total))]) / weight
    return LogBilinear(v, start.like(values))


def _partial(docs: DataFrame, model: LogBilinear, doc_id: str, text: str) -> DataFrame:
    """A text's sums over its hot tokens, and the words it has beyond them."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    source = text_or_empty(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")))
    tail_type = pa.list_(pa.struct([("word", pa.string()), ("n", pa.int64())]))

    def make():
        m = shared.value
        v, scorer = m.vocabulary, Scorer(m)
        log_count = np.log10(v.counts.astype(float) + 1)
        end = float(np.log10(v.texts + 1.0))

        def work(piece: pa.RecordBatch) -> pa.RecordBatch:
            lists = [words_of(t) for t in texts_of(piece)]
            n = sum(map(len, lists))
            get = v.hot.get
            place = np.fromiter((get(w, -1) for x in lists for w in x), np.int64, n)
            lengths = np.array([len(x) + 1 for x in lists], dtype=np.int64)
            ends = np.cumsum(lengths) - 1
            at = np.ones(n + len(lists), dtype=bool)
            at[ends] = False
            classes = np.full(len(at), END, dtype=np.int64)
            own = (place >= 0) & (place < v.classes)
            classes[at] = np.where(own, place + FIRST, OTHER)
            logp = scorer.log10(classes, *contexts(classes, lengths))
            hot = place >= 0
            base = np.full(len(at), end)
            base[at] = np.where(hot, log_count[np.maximum(place, 0)] if len(log_count) else 0.0, 0.0)
            inside = np.zeros(len(at))  # log10 of a word's share of class "other", but for the common divisor
            inside[at] = np.where(own, 0.0, base[at])
            others = (classes == OTHER).astype(float)
            known = np.full(len(at), int(v.texts > 0))
            known[at] = hot
            starts = ends - lengths + 1
            total = lambda x: np.add.reduceat(x, starts) if len(starts) else np.zeros(0)
            tails, done = [], 0
            for x in lists:
                cold = np.flatnonzero(~hot[done:done + len(x)])
                done += len(x)
                tails.append([{"word": w.decode("utf-8", "replace"), "n": k} for w, k in Counter([x[i] for i in cold.tolist()]).items()])
            return pa.RecordBatch.from_arrays([
                column_of(piece, "doc_id"), pa.array(lengths), pa.array(total(known).astype(np.int64)), pa.array(total(base)),
                pa.array(total(logp + inside - others * v.other)), pa.array(tails, tail_type)],
                ["doc_id", "n_tokens", "n_known", "base", "score", "tail"])

        return work

    kind = source.schema["doc_id"].dataType.simpleString()
    return map_slices(source, make, f"doc_id {kind}, n_tokens long, n_known long, base double, score double, tail array<struct<word:string,n:long>>")


def scored(docs: DataFrame, counts: DataFrame, model: LogBilinear, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    v = model.vocabulary
    part = saved(_partial(docs, model, doc_id, text).withColumn("_row", F.monotonically_increasing_id()))
    tail = part.select("_row", F.explode("tail").alias("t")).select("_row", "t.word", "t.n")
    met = tail.join(counts.where("word IS NOT NULL"), "word", "left")
    sums = met.groupBy("_row").agg(
        F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("k"),
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + F.lit(1.0))).alias("s"))
    joined = part.drop("tail").join(sums, "_row", "left")
    more = F.coalesce("s", F.lit(0.0))
    each = float(np.log10(v.tokens + v.distinct + 1.0))
    return joined.select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("k", F.lit(0))).cast("long").alias("n_known"),
        F.lit(v.tokens).cast("long").alias("train_tokens"), (F.col("base") + more - F.col("n_tokens") * each).alias("base_score"),
        (F.col("score") + more).alias("score"))


def score_corpus(docs: DataFrame, training: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts, trains on the rows where ``training`` holds, and scores every row."""
    own = docs.where(training)
    counts = saved(count_words(own, text))
    return scored(docs, counts, trained(own, vocabulary(counts), text), doc_id, text)
