"""Toxicity by compression distance: zstandard dictionaries of toxic and of ordinary text.

A window is a word (a run of letters) with its boundaries, written three times so that its frame is long enough
for zstandard to compress at all. Two dictionaries share one base, trained on ordinary text, so
that ordinary windows cost the same under both; one adds a part trained on toxic text, the
other an equally large part trained on ordinary text. What a window's two compressed lengths
say is calibrated on labelled documents that the dictionaries did not see: each pair of lengths
gets a log-likelihood ratio (its lower confidence limit; thresholds are where it turns
positive), and a logistic model turns a document's ratios into a score from 0 to 1.

Toxic text for its dictionary: windows that occur in at least ``LEAST_SHARE`` of the toxic
sample and ``LEAST_LIFT`` times as often as in the ordinary one, each as often as documents have
it. Near copies in the sample (equal MinHash of word pairs) count once.

Fitting reads a bounded sample: at most ``SAMPLE`` labelled documents of each class, the first
by hash of their id, none longer than ``SAMPLE_CHARS``. Scoring covers every whole text, in one
pass without shuffle; the model is some 100 kB. Labels come from folds other than the held-out
one; conflicting labels of a document count each. Without labels of both classes the score is
the share of toxic labels (none: 0.5 taken as half a vote for each). A null or empty text has no window and
gets the logistic model's score for no evidence. Repeated rows are scored each.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lognorm.llm.common import column_of, fold, fold_of, keep_rows, map_slices, text_or_empty, texts_of, words_of

LEVEL = 19
REPEATS = 3
BASE_BYTES, PART_BYTES = 65_536, 2048
LEAST_SHARE, LEAST_LIFT = 0.02, 10.0
SAMPLE, SAMPLE_CHARS = 3_000, 16_000
FOLDS, HELD_OUT = 5, 0
#: Windows longer than this are cut into pieces of it.
WINDOW_BYTES = 64
REMEMBER = 300_000


#: ASCII signs and digits part words here: a sign stuck to a word must not hide it.
_PARTED = bytes(c if chr(c).isalpha() or c > 127 else 32 for c in range(256))


def windows(text: bytes) -> list[bytes]:
    out = []
    for w in text.lower().translate(_PARTED).split():
        if len(w) <= WINDOW_BYTES:
            out.append(w)
        else:
            out += [w[i:i + WINDOW_BYTES] for i in range(0, len(w), WINDOW_BYTES)]
    return out


def trained(samples: list[bytes], size: int, **how) -> bytes:
    """A zstandard dictionary of the samples; their own last bytes where they are too few to train on."""
    if sum(map(len, samples)) >= 8 * size and len(samples) >= 16:
        try:
            return zstandard.train_dictionary(size, samples, level=LEVEL, **how).as_bytes()
        except zstandard.ZstdError:
            pass
    return b"".join(samples)[-size:]


def _sentences(words: list[bytes], n: int) -> list[bytes]:
    return [b" " + b"  ".join(words[i:i + n]) + b" " for i in range(0, len(words), n)]


@dataclass
class ToxicModel:
    ordinary: bytes = b""
    toxic: bytes = b""
    ratios: dict[tuple[int, int], float] = field(default_factory=dict)
    weights: tuple[float, ...] = (0.0, 0.0, 0.0, 0.0)

    def compressors(self):
        return tuple(self._compressor(d) for d in (self.ordinary, self.toxic))

    @staticmethod
    def _compressor(content: bytes):
        shared = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_AUTO)
        shared.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(
            dict_data=shared, level=LEVEL, write_checksum=False, write_content_size=False, write_dict_id=False)

    def scorer(self) -> Scorer:
        return Scorer(self)


class Scorer:
    """Scores texts; remembers windows up to a bound."""

    def __init__(self, model: ToxicModel):
        self.model = model
        self.known: dict[bytes, float] = {}
        if model.ratios:
            self.by_ordinary, self.by_toxic = (c.compress for c in model.compressors())
            self.longest = max(t for _, t in model.ratios)

    def lengths(self, window: bytes) -> tuple[int, int]:
        data = (b" " + window + b" ") * REPEATS
        return len(self.by_ordinary(data)), len(self.by_toxic(data))

    def ratio(self, window: bytes) -> float:
        data = (b" " + window + b" ") * REPEATS
        toxic = len(self.by_toxic(data))
        if toxic > self.longest:  # no calibrated pair has it
            return 0.0
        return self.model.ratios.get((len(self.by_ordinary(data)), toxic), 0.0)

    def features(self, text: bytes) -> tuple[float, float, float]:
        """Of the positive ratios: sum over windows, logarithm of the sum, largest."""
        own = windows(text)
        if not own or not self.model.ratios:
            return 0.0, 0.0, 0.0
        known = self.known
        if len(known) > REMEMBER:
            known.clear()
        total = most = 0.0
        for w in own:
            r = known.get(w)
            if r is None:
                r = known[w] = self.ratio(w)
            if r:
                total += r
                most = max(most, r)
        return total / len(own), float(np.log1p(total)), most

    def score(self, text: bytes) -> float:
        return float(_sigmoid(np.dot(self.model.weights, (1.0, *self.features(text)))))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Newton's method; the first column is the intercept and isn't penalised."""
    w, penalty = np.zeros(x.shape[1]), np.diag([0.0] + [ridge] * (x.shape[1] - 1))
    for _ in range(rounds):
        p = _sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def _distinct(docs: list[tuple[bytes, int]]) -> list[tuple[bytes, int]]:
    """One document of each group with the same MinHash of word pairs and the same label."""
    seen, out = set(), []
    for text, label in docs:
        w = words_of(text)
        mark = (label, min(map(fingerprint_of, zip(w, w[1:])), default=hash(text)))
        if mark not in seen:
            seen.add(mark)
            out.append((text, label))
    return out


def fingerprint_of(pair: tuple[bytes, bytes]) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(pair[0] + b" " + pair[1])


def fit(docs: Iterable[tuple[int, str, int]], seed: int = 7) -> ToxicModel:
    """From (doc_id, text, toxic): dictionaries from one half by hash, calibration from the other."""
    rows = sorted(((fold_of(d, 1 << 20), (t or "").encode(), int(y)) for d, t, y in docs if y is not None), key=lambda r: (r[0], r[1], r[2]))
    labels = np.array([y for *_, y in rows], dtype=float)
    prior = (labels.sum() + 0.5) / (len(labels) + 1)
    constant = ToxicModel(weights=(float(np.log(prior / (1 - prior))), 0.0, 0.0, 0.0))
    if len(set(labels.tolist())) < 2:
        return constant
    unique = _distinct([(t, y) for _, t, y in rows])
    first, second = unique[::2], unique[1::2]
    rng = np.random.default_rng(seed)
    held: tuple[Counter, Counter] = (Counter(), Counter())
    for text, y in first:
        held[y].update(set(windows(text)))
    sizes = [sum(y == k for _, y in first) for k in (0, 1)]
    if min(sizes) == 0:
        return constant
    marked = {w for w, n in held[1].items() if n >= max(3, LEAST_SHARE * sizes[1])
              and n / sizes[1] >= LEAST_LIFT * (held[0][w] + 0.5) / (sizes[0] + 1)}
    lists: tuple[list, list] = ([], [])
    running: list[bytes] = []
    for text, y in first:
        own = windows(text)
        distinct = sorted(set(own))
        lists[y].extend([w for w in distinct if w in marked] if y else distinct)
        if not y:
            running += own
    for x in lists:
        rng.shuffle(x)
    if not lists[1] or not lists[0]:
        return constant
    base = trained(_sentences(running, 8), BASE_BYTES)
    how = {"k": 32, "d": 6}
    part = max(256, min(PART_BYTES, sum(map(len, lists[1]))))
    toxic = trained(_sentences(lists[1], 4), part, **how)
    ordinary = trained(_sentences(lists[0][:4 * len(lists[1]) + 64], 4), part, **how)
    model = ToxicModel(base + ordinary, base + toxic, {(0, 1 << 30): 0.0})
    scorer = Scorer(model)
    known: dict[bytes, tuple[int, int]] = {}
    seen: tuple[Counter, Counter] = (Counter(), Counter())
    for text, y in second:
        for w in set(windows(text)):
            if w not in known:
                known[w] = scorer.lengths(w)
            seen[y][known[w]] += 1
    totals = [max(1, sum(c.values())) for c in seen]
    model.ratios = {}
    for pair, n in seen[1].items():
        if pair[0] > pair[1]:
            a, b = n + 0.5, seen[0][pair] + 0.5
            low = np.log(a / totals[1]) - np.log(b / totals[0]) - 2 * np.sqrt(1 / a + 1 / b)
            if low > 0:
                model.ratios[pair] = float(low)
    if not model.ratios:
        return constant
    scorer = Scorer(model)
    x = np.array([(1.0, *scorer.features(t)) for t, _ in second])
    model.weights = tuple(logistic(x, np.array([y for _, y in second], dtype=float)).tolist())
    return model


def sample(docs: DataFrame, labels: DataFrame, label: str, doc_id: str = "doc_id", text: str = "text",
           folds: int = FOLDS, held_out: int | None = HELD_OUT, rows: int = SAMPLE, chars: int = SAMPLE_CHARS) -> list[tuple[int, str, int]]:
    """At most ``rows`` labelled documents of each class, the first by hash, whole texts; see the module."""
    known = labels.where(F.col(label).isin(0, 1)).select(F.col(doc_id).alias("_i"), F.col(label).cast("int").alias("_y"))
    if held_out is not None:
        known = known.where(fold(F.col("_i"), folds) != held_out)
    source = docs.select(F.col(doc_id).alias("_d"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_t"))
    ids = source.where(F.length("_t") <= chars).select("_d").join(known, F.col("_d") == F.col("_i")).select("_i", "_y").distinct()
    place = F.pmod(F.xxhash64("_i"), F.lit(2**40))
    sizes = {r["_y"]: r["count"] for r in ids.groupBy("_y").count().collect()}
    # Slightly more than ``rows`` of a class by hash, then exactly the first: no sort in Spark.
    limit = F.lit(0)
    for y, n in sizes.items():
        limit = F.when(F.col("_y") == y, min(2**40, int(2**40 * (1.1 * rows + 200) / n))).otherwise(limit)
    near = sorted((r["p"], r["_i"], r["_y"]) for r in ids.select(place.alias("p"), "_i", "_y").where(F.col("p") < limit).collect())
    chosen = [x for y in (0, 1) for x in [(i, z) for _, i, z in near if z == y][:rows]]
    picked = docs.sparkSession.createDataFrame(chosen, "_i long, _y int")
    found = source.where(F.length("_t") <= chars).join(F.broadcast(picked), F.col("_d") == F.col("_i"))  # at most 2 x rows ids
    return [(r["_i"], r["_t"], r["_y"]) for r in found.select("_i", "_t", "_y").dropDuplicates(["_i", "_y"]).collect()]


def train(docs: DataFrame, labels: DataFrame, held_out: int | None = HELD_OUT) -> ToxicModel:
    return fit(sample(docs, labels, "toxic", held_out=held_out))


def scored(docs: DataFrame, model: ToxicModel, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.5) -> DataFrame:
    """(doc_id, score, predicted) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    source = text_or_empty(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")))

    def make():
        scorer = shared.value.scorer()

        def work(piece: pa.RecordBatch) -> pa.RecordBatch:
            scores = np.array([scorer.score(t) for t in texts_of(piece)], dtype=np.float64)
            return pa.RecordBatch.from_arrays(
                [column_of(piece, "doc_id"), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

        return work

    kind = source.schema["doc_id"].dataType.simpleString()
    return map_slices(source, make, f"doc_id {kind}, score double, predicted int")


def without_toxic(docs: DataFrame, model: ToxicModel, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows that score below the threshold, with all their columns; a model without evidence rejects none."""
    if not model.ratios:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        scorer = shared.value.scorer()
        return lambda texts: np.array([scorer.score(t) < threshold for t in texts], dtype=bool)

    return keep_rows(docs, make, text)
