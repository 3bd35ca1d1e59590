"""Secret scans: fixed patterns plus a battery of randomness tests with false-discovery control.

Candidates are maximal runs of token characters, less what the fixed patterns found, cut after
``=``; words that ``/``, ``-`` or ``_`` join to their ends are cut off, and each part between such
signs is tested too. The encoding of each is inferred (hex, lower or
upper alphanumeric, base64), and three statistics are compared with what ordinary text of that
length gives: the chi-squared distance from a uniform alphabet, the number of runs of character
kinds, and the serial correlation of neighbouring characters. The moments of ordinary text come
from the character and character-pair counts of all documents. Stouffer's sum of the three
one-sided scores gives a p-value against "ordinary text"; a string that also fails the same
battery against "uniformly random" (repeats, counters) is no candidate. The discoveries are
those that Benjamini-Hochberg admits within their length class, over all documents, so that
many short strings don't drown the long ones, and short ones need stronger evidence.

Memory: one slice of text a task; the driver sees only pair counts (at most 65,536 rows) and a
histogram of p-values (classes x bins). A null text is empty and has no spans. Spans are code
points, end exclusive. Repeated rows are scanned each. Empty table: empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from dataclasses import dataclass
from itertools import islice, takewhile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lognorm.llm.common import column_of, map_slices, saved, summed, text_or_empty, texts_of

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
#: A run is cut after ``=``, which stays with what it pads; parts lie between the signs that join names.
SEGMENT = re.compile(r"[^=]+=*")
SIGNS = "/_-="
PART = re.compile(r"[^/_-]+")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
HINTS = (b"passw", b"secret", b"token", b"api")
REPLACEMENT = "[SECRET]"
FDR = 0.01
#: A candidate must not look structured: the least p-value against uniform randomness.
RANDOM_ALPHA = 1e-4
#: Lower ends of the length classes.
LENGTHS = (20, 24, 32, 48, 96)
#: Histogram of -log10 p: bins of 1/BIN up to TOP.
BIN, TOP = 20, 60

ALPHABETS = {
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "lower": "0123456789abcdefghijklmnopqrstuvwxyz",
    "upper": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_",
}
#: Letters in base64 dialects: two of the four signs never occur in one string.
SIZE = {"hex": 16, "HEX": 16, "lower": 36, "upper": 36, "base64": 64}
_KIND = np.full(256, 3)
for _k, _chars in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789")):
    _KIND[list(_chars.encode())] = _k

Span = tuple[int, int, str]


def base_spans(text: str, raw: bytes) -> list[Span]:
    """Matches of the fixed patterns, leftmost and non-overlapping for each kind."""
    spans = []
    low = raw.lower()
    if any(h in low for h in HINTS):
        spans += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if b"AKIA" in raw:
        spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


@dataclass
class Null:
    """Moments of ordinary text within one alphabet: sums of powers of letter shares, change rate, correlation."""

    s2: float
    s3: float
    change: float
    correlation: float
    random_change: float


def nulls(pairs: np.ndarray) -> dict[str, Null]:
    """From counts of neighbouring bytes in all documents (256 x 256)."""
    out = {}
    for name, letters in ALPHABETS.items():
        at = np.frombuffer(letters.encode(), dtype=np.uint8)
        own = pairs[np.ix_(at, at)].astype(float) + 1e-3
        first, second = own.sum(1), own.sum(0)
        share = (first + second) / (first + second).sum()
        kinds = _KIND[at]
        change = own[kinds[:, None] != kinds[None, :]].sum() / own.sum()
        x = np.arange(len(at), dtype=float)
        mx, my = (first @ x) / first.sum(), (second @ x) / second.sum()
        vx, vy = first @ (x - mx) ** 2 / first.sum(), second @ (x - my) ** 2 / second.sum()
        cov = (x - mx) @ own @ (x - my) / own.sum()
        uniform = np.bincount(kinds, minlength=4) / len(at)
        out[name] = Null(
            float((share**2).sum()), float((share**3).sum()), float(min(max(change, 1e-3), 1 - 1e-3)),
            float(cov / math.sqrt(vx * vy)) if vx * vy > 0 else 0.0, float(1 - (uniform**2).sum()))
    return out


def encoding(token: str) -> str | None:
    """The smallest alphabet that holds the token and fits its letters; digits or letters alone are none."""
    chars = set(token)
    if not any(c.isdigit() for c in chars) or not any(c.isalpha() for c in chars):
        return None
    return next((name for name, letters in ALPHABETS.items() if chars <= set(letters)), None)


def _upper(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def p_value(token: str, null: dict[str, Null]) -> tuple[float, float] | None:
    """(p against ordinary text, p against uniformly random), or None where no encoding fits."""
    token = token.strip("=")
    name = encoding(token)
    n = len(token)
    if name is None or n < 8:
        return None
    h, k = null[name], SIZE[name]
    counts = Counter(token)
    chi = k / n * sum(c * c for c in counts.values()) - n
    pairs = n * (n - 1)
    mean = k * (1 + (n - 1) * h.s2) - n
    spread = (k / n) * math.sqrt(max(2 * pairs * (h.s2 + 2 * (n - 2) * h.s3 - (2 * n - 3) * h.s2**2), 1e-9))
    z_chi = (mean - chi) / spread
    kinds = _KIND[np.frombuffer(token.encode(), dtype=np.uint8)]
    runs = int((kinds[1:] != kinds[:-1]).sum())
    z_runs = (runs - (n - 1) * h.change) / math.sqrt((n - 1) * h.change * (1 - h.change))
    letters = ALPHABETS[name]
    x = np.array([letters.index(c) for c in token], dtype=float)
    a, b = x[:-1] - x[:-1].mean(), x[1:] - x[1:].mean()
    norm = math.sqrt((a @ a) * (b @ b))
    r = float(a @ b) / norm if norm else 1.0
    z_serial = (abs(h.correlation) - abs(r)) * math.sqrt(n)
    text = _upper((z_chi + min(z_runs, 8.0) + z_serial) / math.sqrt(3))
    q = h.random_change
    random_z = (
        (chi - (k - 1)) / math.sqrt(2 * (k - 1)),  # uniform from above only: too even is rare and harmless
        abs(runs - (n - 1) * q) / math.sqrt((n - 1) * q * (1 - q)),
        abs(r) * math.sqrt(n),
    )
    return text, min(1.0, 6 * _upper(max(random_z)))


def bin_of(p: float) -> int:
    return min(int(-math.log10(max(p, 1e-300)) * BIN), TOP * BIN)


def length_class(n: int) -> int:
    return sum(n >= x for x in LENGTHS) - 1


def left_over(text: str, start: int, end: int, base: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What sorted spans leave of a run, less a sign that joined it to one of them."""
    out, at = [], start
    for s, e in [*base, (end, end)]:
        if s > at:
            out.append((at + (at > start and text[at] in SIGNS), s - (s < end and text[s - 1] in SIGNS)))
        at = max(at, e)
    return out


def options(segment: str) -> list[tuple[int, int]]:
    """Spans of a segment to test: without words joined to its ends, and its parts; all long enough."""
    parts = [m.span() for m in PART.finditer(segment)]
    words = [e - s >= 3 and WORD.fullmatch(segment, s, e) is not None for s, e in parts]
    first = next((i for i, w in enumerate(words) if not w), 0)
    last = len(parts) - next((i for i, w in enumerate(reversed(words)) if not w), 0)
    core = (parts[first][0] if first else 0, parts[last - 1][1] if last < len(parts) else len(segment)) if parts else (0, 0)
    if core[1] - core[0] < LENGTHS[0]:
        core = (0, len(segment))
    return [core, *(x for x in parts if x[1] - x[0] >= LENGTHS[0] and x != core)]


def candidates(text: str, base: list[Span], null: dict[str, Null]) -> list[tuple[int, int, int]]:
    """(start, end, bin of p) of what the base spans leave of token runs and passes as random.

    Of a segment and its parts the more significant go; p counts the tests made on the segment.
    """
    out, k = [], 0
    ends = sorted((s, e) for s, e, _ in base)
    for m in CANDIDATE.finditer(text):
        while k < len(ends) and ends[k][1] <= m.start():
            k += 1
        for s, e in left_over(text, m.start(), m.end(), list(takewhile(lambda x: x[0] < m.end(), islice(ends, k, None)))):
            for x in SEGMENT.finditer(text, s, e):
                if x.end() - x.start() < LENGTHS[0]:
                    continue
                spans = options(x[0])
                tested = [(p[0], *span) for span in spans if (p := p_value(x[0][slice(*span)], null)) and p[1] >= RANDOM_ALPHA]
                best = max(tested, key=lambda x: bin_of(x[0]), default=None)  # of equals the whole
                for p, a, b in tested:
                    if (p, a, b) == best or best[1:] != spans[0] and (a, b) != spans[0]:
                        out.append((x.start() + a, x.start() + b, bin_of(min(1.0, p * len(spans)))))
    return out


def pair_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Counts of neighbouring bytes over all documents."""
    source = text_or_empty(docs.select(F.col(text).alias("text")))

    def run(batches):
        total = np.zeros(65536, dtype=np.int64)
        for piece in batches:
            for t in texts_of(piece):
                b = np.frombuffer(t, dtype=np.uint8)
                for i in range(0, max(len(b) - 1, 0), 1 << 22):
                    part = b[i:i + (1 << 22) + 1].astype(np.int32)
                    total += np.bincount(part[:-1] << 8 | part[1:], minlength=65536)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], ["pair", "n"])

    pairs = np.zeros(65536, dtype=np.int64)
    for row in summed(source.mapInArrow(run, "pair int, n long"), ["pair"], "n").collect():
        pairs[row["pair"]] = row["n"]
    return pairs.reshape(256, 256)


def thresholds(histogram: dict[tuple[int, int], int], fdr: float = FDR) -> dict[int, int]:
    """Least bin that Benjamini-Hochberg admits, by length class; a class without discoveries has none.

    A bin counts with its largest p-value, so binning can only make the control stricter.
    """
    out = {}
    for length in {c for c, _ in histogram}:
        bins = sorted(((b, n) for (c, b), n in histogram.items() if c == length), reverse=True)
        total, seen = sum(n for _, n in bins), 0
        for b, n in bins:
            seen += n
            if 10 ** (-b / BIN) <= fdr * seen / total and b > 0:
                out[length] = b
    return out


def scan_rows(docs: DataFrame, doc_id: str, text: str, null: dict[str, Null]) -> DataFrame:
    """(doc_id, base spans, candidates) of every document."""
    source = text_or_empty(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")))
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))
    open_span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("bin", pa.int32())]))

    def make():
        def work(piece: pa.RecordBatch) -> pa.RecordBatch:
            bases, opens = [], []
            for raw in texts_of(piece):
                t = raw.decode("utf-8", "replace")
                base = base_spans(t, raw)
                bases.append([dict(zip(("start", "end", "kind"), s, strict=True)) for s in base])
                opens.append([dict(zip(("start", "end", "bin"), s, strict=True)) for s in candidates(t, base, null)])
            return pa.RecordBatch.from_arrays(
                [column_of(piece, "doc_id"), pa.array(bases, span), pa.array(opens, open_span)], ["doc_id", "base", "open"])

        return work

    kind = source.schema["doc_id"].dataType.simpleString()
    return map_slices(source, make, f"doc_id {kind}, base array<struct<start:long,end:long,kind:string>>, "
                                    "open array<struct<start:long,end:long,bin:int>>")


def histogram_of(scanned: DataFrame) -> dict[tuple[int, int], int]:
    length = sum((F.col("x.end") - F.col("x.start") >= n).cast("int") for n in LENGTHS) - 1
    rows = scanned.select(F.explode("open").alias("x")).groupBy(length.alias("c"), F.col("x.bin").alias("b")).count().collect()
    return {(r["c"], r["b"]): r["count"] for r in rows}


def spans_sha256(spans: list[tuple[int, int, str]]) -> str:
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, e, k in spans).encode()).hexdigest()


def find_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", fdr: float = FDR) -> DataFrame:
    """(doc_id, base, secrets): spans of the fixed patterns, and all spans with the method's own."""
    scanned = saved(scan_rows(docs, doc_id, text, nulls(pair_counts(docs, text))))
    least = thresholds(histogram_of(scanned), fdr)
    length = lambda x: sum((x["end"] - x["start"] >= n).cast("int") for n in LENGTHS) - 1
    admitted = F.lit(False)
    added = F.array().cast("array<struct<start:long,end:long,kind:string>>")
    if least:
        def admits(x):
            out = admitted
            for c, b in least.items():
                out = out | ((length(x) == c) & (x["bin"] >= b))
            return out

        added = F.transform(F.filter("open", admits), lambda x: F.struct(
            x["start"].alias("start"), x["end"].alias("end"), F.lit("random").alias("kind")))
    rank = lambda k: F.array_position(F.array(*map(F.lit, KINDS)), k)
    ordered = F.array_sort(F.transform(F.concat("base", added), lambda x: F.struct(
        x["start"].alias("start"), rank(x["kind"]).alias("rank"), x["end"].alias("end"), x["kind"].alias("kind"))))
    secrets = F.transform(ordered, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind")))
    return scanned.select("doc_id", "base", secrets.alias("secrets"))


def redacted(docs: DataFrame, text: str = "text", fdr: float = FDR, replacement: str = REPLACEMENT) -> DataFrame:
    """The documents with every found span replaced; texts without one, null ones too, stay as they are."""
    null = nulls(pair_counts(docs, text))
    keyed = docs.select(F.lit(0).alias("k"), F.col(text).alias("text"))
    least = thresholds(histogram_of(scan_rows(keyed, "k", "text", null)), fdr)

    def make():
        def work(piece: pa.RecordBatch) -> pa.RecordBatch:
            at = piece.schema.get_field_index(text)
            out = []
            for raw, given in zip(texts_of(piece, text), column_of(piece, text).is_null().to_pylist(), strict=True):
                t = raw.decode("utf-8", "replace")
                base = base_spans(t, raw)
                spans = [(s, e) for s, e, _ in base] + [
                    (s, e) for s, e, b in candidates(t, base, null) if b >= least.get(length_class(e - s), TOP * BIN + 1)]
                done, parts = 0, []
                for s, e in sorted(spans):
                    if s >= done:
                        parts += [t[done:s], replacement]
                    done = max(done, e)
                out.append(None if given else "".join([*parts, t[done:]]) if spans else t)
            return pa.RecordBatch.from_arrays(
                [pa.array(out, pa.string()) if i == at else c for i, c in enumerate(piece.columns)], piece.schema.names)

        return work

    return map_slices(docs, make, docs.schema, text)
