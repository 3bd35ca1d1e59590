"""Quality by a sparse rule ensemble compiled into Spark column expressions.

Statistics of each whole text (shares of letter kinds, word and line shapes, repetition) feed
gradient-boosted shallow trees; every path from a root is a conjunctive rule. A lasso logistic
model over the rules (and the clipped statistics) keeps few of them. What is kept is compiled
into one Spark expression over the statistics' columns: a sum of weights of rules that hold.

Statistics come from one pass over Arrow buffers, in tasks, a slice of text at a time; no
shuffle. Fitting reads a bounded sample of labelled documents (``sample`` of the toxicity
module: at most 3,000 of each class, none longer than 16,000 characters). An empty or null text
has statistics of zero. Without labels of both classes the score is the share of label 1, with
half a vote for each class. Repeated rows are scored each.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lognorm.llm.common import column_of, fold_of, map_slices, text_or_empty, texts_of
from lognorm.llm.toxicity import sample

STATISTICS = (
    "log_words", "word_length", "upper", "digit", "sign", "exclaim", "non_ascii", "distinct_words", "top_word",
    "stuck_signs", "log_lines", "repeated_lines", "line_words", "sentence_ends", "long_words", "short_words",
)
TREES, DEPTH, RATE, LEAST_LEAF = 60, 3, 0.3, 8
LASSO, MOST_RULES = 0.004, 400
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3

_KIND = np.zeros(256, dtype=np.uint8)
_KIND[65:91] = 1  # A-Z
_KIND[97:123] = 2  # a-z
_KIND[48:58] = 3  # 0-9
_KIND[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 4  # signs
_KIND[[9, 10, 11, 12, 13, 32]] = 5  # white space
_KIND[128:] = 6


def statistics(text: bytes) -> tuple[float, ...]:
    words = text.split()
    n = len(words)
    if n == 0:
        return (0.0,) * len(STATISTICS)
    data = np.frombuffer(text, dtype=np.uint8)
    counts = np.bincount(_KIND[data], minlength=7)
    lengths = np.fromiter(map(len, words), np.int64, n)
    ends = np.frombuffer(b"".join([w[-1:] for w in words]), dtype=np.uint8)
    seen: dict[bytes, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    lines = [x for x in text.split(b"\n") if x.strip()]
    letters = max(1, int(counts[1] + counts[2] + counts[6]))
    visible = max(1, len(data) - int(counts[5]))
    stuck = int((_KIND[ends] == 4).sum()) - int(np.isin(ends, (44, 46)).sum())
    return (
        float(np.log1p(n)), float(lengths.mean()), counts[1] / letters, counts[3] / visible, counts[4] / visible,
        text.count(b"!") / n, counts[6] / visible, len(seen) / n, max(seen.values()) / n, stuck / n,
        float(np.log1p(len(lines))), 1 - len(set(lines)) / len(lines), n / len(lines),
        float((ends == 46).sum()) / n, float((lengths > 15).mean()), float((lengths < 3).mean()))


def with_statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ``STATISTICS``) of every row."""
    source = text_or_empty(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")))

    def make():
        def work(piece: pa.RecordBatch) -> pa.RecordBatch:
            table = np.array([statistics(t) for t in texts_of(piece)], dtype=np.float64).reshape(-1, len(STATISTICS))
            return pa.RecordBatch.from_arrays(
                [column_of(piece, "doc_id"), *[pa.array(np.ascontiguousarray(c)) for c in table.T]], ["doc_id", *STATISTICS])

        return work

    kind = source.schema["doc_id"].dataType.simpleString()
    return map_slices(source, make, ", ".join([f"doc_id {kind}", *[f"{s} double" for s in STATISTICS]]))


Condition = tuple[int, bool, float]  # statistic, above (true) or not above, bound
Rule = tuple[Condition, ...]


@dataclass
class RuleModel:
    intercept: float
    rules: list[tuple[Rule, float]]
    #: (statistic, low, high, weight): the statistic clipped to its usual range.
    linear: list[tuple[int, float, float, float]]

    def column(self) -> Column:
        """The score as a Spark expression over the statistics."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            holds = F.lit(True)
            for s, above, bound in rule:
                holds = holds & ((F.col(STATISTICS[s]) > bound) if above else (F.col(STATISTICS[s]) <= bound))
            total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        for s, low, high, weight in self.linear:
            total = total + F.least(F.greatest(F.col(STATISTICS[s]), F.lit(low)), F.lit(high)) * F.lit(weight)
        return 1 / (1 + F.exp(-total))

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for rule, weight in self.rules:
            total += weight * holds(rule, x)
        for s, low, high, weight in self.linear:
            total += weight * np.clip(x[:, s], low, high)
        return 1 / (1 + np.exp(-total))


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), dtype=bool)
    for s, above, bound in rule:
        out &= (x[:, s] > bound) if above else (x[:, s] <= bound)
    return out


def _split(x: np.ndarray, gradient: np.ndarray, weight: np.ndarray) -> tuple[float, int, float] | None:
    """Best (gain, statistic, bound) by the second-order gain of a Newton step."""
    best, n = None, len(x)
    total_g, total_w = gradient.sum(), weight.sum()
    for s in range(x.shape[1]):
        order = np.argsort(x[:, s], kind="stable")
        values = x[order, s]
        g, w = np.cumsum(gradient[order])[:-1], np.cumsum(weight[order])[:-1]
        ok = values[1:] > values[:-1]
        ok[:LEAST_LEAF - 1] = False
        ok[n - LEAST_LEAF:] = False
        if not ok.any():
            continue
        gain = np.where(ok, g**2 / (w + 1) + (total_g - g) ** 2 / (total_w - w + 1) - total_g**2 / (total_w + 1), -np.inf)
        k = int(np.argmax(gain))
        if gain[k] > 1e-6 and (best is None or gain[k] > best[0]):
            best = (float(gain[k]), s, float((values[k] + values[k + 1]) / 2))
    return best


def _grow(x, gradient, weight, rows, rule: Rule, depth: int, out: list[tuple[Rule, float]], step: np.ndarray) -> None:
    """Grows a tree below ``rule``; writes leaf steps and collects every path."""
    found = _split(x[rows], gradient[rows], weight[rows]) if depth and len(rows) >= 2 * LEAST_LEAF else None
    if rule:
        out.append((rule, 0.0))
    if found is None:
        step[rows] = gradient[rows].sum() / (weight[rows].sum() + 1)
        return
    _, s, bound = found
    above = x[rows, s] > bound
    for side in (False, True):
        _grow(x, gradient, weight, rows[above == side], (*rule, (s, side, bound)), depth - 1, out, step)


def tree_rules(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, seed: int = 5) -> list[Rule]:
    """Paths of boosted trees, each on half of the rows; distinct, in the order found."""
    rng = np.random.default_rng(seed)
    margin = np.full(len(y), np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    found: dict[Rule, None] = {}
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        paths, step = [], np.zeros(len(y))
        half = np.sort(rng.permutation(len(y))[: max(len(y) // 2, min(len(y), 4 * LEAST_LEAF))])
        _grow(x, y - p, p * (1 - p), half, (), depth, paths, step)
        for rule, _ in paths:
            found[rule] = None
        leaf = [r for r, _ in paths if not any(o != r and o[: len(r)] == r for o, _ in paths)]
        for rule in leaf:
            inside = holds(rule, x)
            margin[inside] += RATE * (y - p)[inside].sum() / ((p * (1 - p))[inside].sum() + 1)
    return list(found)


def lasso_logistic(x: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 400) -> tuple[float, np.ndarray]:
    """Accelerated proximal gradient descent; the intercept isn't penalised."""
    n, k = x.shape
    scale = 4.0 / max(np.linalg.norm(x, 2) ** 2 / n + 1, 1e-9)
    w, b = np.zeros(k), float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    vw, vb, t = w.copy(), b, 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ vw + vb, -30, 30)))
        nw = vw - scale * (x.T @ (p - y)) / n
        nw = np.sign(nw) * np.maximum(np.abs(nw) - scale * penalty, 0)
        nb = vb - scale * float((p - y).mean())
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        vw, vb = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        if np.abs(nw - w).max(initial=0) + abs(nb - b) < 1e-7:
            w, b = nw, nb
            break
        w, b, t = nw, nb, nt
    return b, w


def fit(x: np.ndarray, y: np.ndarray, penalty: float = LASSO) -> RuleModel:
    """Trees on all rows, lasso weights over their rules; constant without both classes."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    constant = RuleModel(float(np.log(share / (1 - share))), [], [])
    if len(y) < 2 * LEAST_LEAF or len(set(y.tolist())) < 2:
        return constant
    rules = tree_rules(x, y)[:MOST_RULES]
    low, high = np.quantile(x, 0.025, axis=0), np.quantile(x, 0.975, axis=0)
    spread = np.where(high > low, high - low, 1.0)
    columns = [holds(r, x).astype(float) for r in rules]
    features = np.column_stack([*columns, (np.clip(x, low, high) - low) / spread * 0.4])
    b, w = lasso_logistic(features, y, penalty)
    k = len(rules)
    linear = [(s, float(low[s]), float(high[s]), float(w[k + s] * 0.4 / spread[s])) for s in range(x.shape[1]) if w[k + s]]
    intercept = b - sum(lo * weight for _, lo, _, weight in linear)
    return RuleModel(float(intercept), [(r, float(v)) for r, v in zip(rules, w[:k], strict=True) if v], linear)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", held_out: int | None = HELD_OUT) -> RuleModel:
    rows = sorted(sample(docs, labels, label, held_out=held_out), key=lambda r: (fold_of(r[0], 1 << 30), r[1], r[2]))
    x = np.array([statistics(t.encode()) for _, t, _ in rows]).reshape(-1, len(STATISTICS))
    return fit(x, np.array([y for *_, y in rows], dtype=float))


def scored(docs: DataFrame, model: RuleModel, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, predicted, ``STATISTICS``) of every row."""
    found = with_statistics(docs, doc_id, text).withColumn("score", model.column())
    return found.select("doc_id", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), *STATISTICS)
