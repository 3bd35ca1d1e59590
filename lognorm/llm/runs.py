"""Periodic runs of words by Kruskal's order on longest common prefixes.

A run is a maximal stretch of words with smallest period q that is at least ``TIMES`` * q and at
least ``LEAST`` words long. Suffixes of a document are sorted; neighbours in that order have a
longest common prefix (LCP). The neighbours are united by decreasing LCP with union-find, and
each class keeps its positions in order. When two classes meet at LCP l, positions i < j that
become neighbours within the class share exactly l words, so words i to j + l have period
d = j - i. No position of the class lies between them, so no smaller period holds there. Where
l >= (TIMES - 1) * d that is a seed, and it is a run from i to j + l if the word before i differs
from that before j. Every run gives such a seed once: its first word and the word a period later.

Only positions whose next ``LEAST`` - 1 words occur twice in the document can seed a run, as LCPs
of runs are at least that long; the others take no part. Suffixes of all documents in a slice are sorted
together by doubling; words of different documents never count as equal.

Words: runs of characters that are not ASCII white space, case kept. Null texts have none. In a
document whose hash of the doc_id (null: the empty text) is divisible by 10, the words may be made
periodic first (``planted``). Repeated rows give a row each; an empty table an empty result; only the
named columns are read. One document's work is one task's, with memory linear in its length.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lognorm.llm.common import column_of, map_slices, text_or_empty, texts_of

TIMES, LEAST = 4, 6
PLANTED = 10
SLICE = 1 << 20

Run = tuple[int, int, int]  # start, length, period


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """One document in ``PLANTED`` repeats its tail with a period that its doc_id gives."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    n, g = len(words), h // PLANTED
    if h % PLANTED or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    head, unit = words[:a], words[a:a + p]
    return head + (unit * (-(-(n - a) // p)))[:n - a]


class Positions:
    """An ordered set of numbers in blocks, so that one insertion moves few of them."""

    BLOCK = 1024

    def __init__(self, first: int):
        self.blocks, self.heads, self.size = [[first]], [first], 1

    def add(self, x: int) -> tuple[int, int]:
        """Inserts x; its neighbours before and after it, -1 if there is none."""
        at = max(bisect_right(self.heads, x) - 1, 0)
        block = self.blocks[at]
        where = bisect_left(block, x)
        before = block[where - 1] if where else self.blocks[at - 1][-1] if at else -1
        after = block[where] if where < len(block) else self.blocks[at + 1][0] if at + 1 < len(self.blocks) else -1
        block.insert(where, x)
        self.size += 1
        if not where:
            self.heads[at] = x
        if len(block) > self.BLOCK:
            half = len(block) // 2
            self.blocks.insert(at + 1, block[half:])
            self.heads.insert(at + 1, block[half])
            del block[half:]
        return before, after

    def __iter__(self):
        for block in self.blocks:
            yield from block


def _ranks(keys: np.ndarray) -> np.ndarray:
    """Numbers with the order of the keys: where each key's group starts in sorted order."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]]) if len(keys) else np.zeros(0, bool)
    out = np.empty(len(keys), np.int64)
    out[order] = np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))
    return out


def _pairs(first: np.ndarray, rank: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One number for (first, rank at ``at``); behind the end comes before everything."""
    n = len(rank)
    second = np.where(at < n, rank[np.minimum(at, n - 1)] + 1, 0)
    return first * (n + 2) + second


def repeated_suffixes(words: np.ndarray) -> np.ndarray:
    """The positions whose next LEAST - 1 words occur elsewhere too, in the order of their suffixes.

    ``words`` are numbers; a number that occurs once ends every document.
    """
    n, width = len(words), LEAST - 1
    if not n:
        return np.zeros(0, np.int64)
    places = np.arange(n)
    rank, have = _ranks(words), 1
    while have < width:  # overlapping halves are as good as joined ones
        step = min(have, width - have)
        rank, have = _ranks(_pairs(rank, rank, places + step)), have + step
    counts = np.bincount(rank, minlength=n)
    active = np.flatnonzero(counts[rank] > 1)
    open_ = active
    while len(open_):
        keys = _pairs(rank[open_], rank, open_ + have)
        order = np.argsort(keys, kind="stable")
        ordered, old = keys[order], rank[open_][order]
        place = np.arange(len(order))
        group = np.maximum.accumulate(np.where(np.concatenate([[True], old[1:] != old[:-1]]), place, 0))
        new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        start = np.maximum.accumulate(np.where(new, place, 0))
        rank[open_[order]] = old + start - group  # a rank is where the group starts among all
        alone = new & np.append(new[1:], True)
        open_ = np.sort(open_[order[~alone]])
        have *= 2
    return active[np.argsort(rank[active], kind="stable")]


def common_prefixes(words: list[int], order: list[int]) -> list[int]:
    """LCP of each suffix with the one before it in ``order`` (0 for the first), in text order."""
    place = {p: n for n, p in enumerate(order)}
    out, have, last = [0] * len(order), 0, -2
    for p in sorted(order):
        have = have - 1 if p == last + 1 and have >= LEAST else 0  # what is left is known of positions that take part
        n = place[p]
        if n:
            q = order[n - 1]
            while words[p + have] == words[q + have]:  # single numbers end documents
                have += 1
            out[n] = have
        else:
            have = 0
        last = p
    return out


def seeds(order: list[int], prefixes: list[int]) -> list[Run]:
    """(i, d, l): positions i and i + d became neighbours at LCP l >= (TIMES - 1) * d, l + d >= LEAST."""
    parent = list(range(len(order)))
    sets: list[Positions | None] = [Positions(p) for p in order]
    found = []

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for n in sorted((n for n, l in enumerate(prefixes) if l >= LEAST - 1), key=lambda n: -prefixes[n]):
        l, a, b = prefixes[n], root(n - 1), root(n)
        if sets[a].size < sets[b].size:
            a, b = b, a
        large, small = sets[a], sets[b]
        last, waiting = -1, None  # of the small set: the one before, and its pair with the one after it
        for p in small:
            before, after = large.add(p)
            if waiting and waiting[1] < p:
                found.append((waiting[0], waiting[1] - waiting[0], l))
            if before >= 0 and before != last and (p - before) * (TIMES - 1) <= l:
                found.append((before, p - before, l))
            last, waiting = p, (p, after) if after >= 0 and (after - p) * (TIMES - 1) <= l else None
        if waiting:
            found.append((waiting[0], waiting[1] - waiting[0], l))
        parent[b], sets[b] = a, None
    return found


def runs(documents: list[list[int]]) -> list[list[Run]]:
    """The runs of each document of word numbers >= 0, by start, then period."""
    ends = np.cumsum([len(d) + 1 for d in documents])
    flat = np.concatenate([np.array([*d, -1], np.int64) for d in documents]) if documents else np.zeros(0, np.int64)
    doc = np.repeat(np.arange(len(documents)), [len(d) + 1 for d in documents])
    span = int(flat.max(initial=0)) + 2
    keys = doc * span + flat + 1  # equal words of different documents differ; the end of each occurs once
    order = repeated_suffixes(keys)
    words, order = keys.tolist(), order.tolist()
    out: list[list[Run]] = [[] for _ in documents]
    starts = ends - np.array([len(d) + 1 for d in documents], np.int64) if documents else ends
    for i, d, l in seeds(order, common_prefixes(words, order)):
        n = int(doc[i])
        if d + l >= LEAST and (i == starts[n] or words[i - 1] != words[i + d - 1]):
            out[n].append((int(i - starts[n]), l + d, d))
    return [sorted(r, key=lambda x: (x[0], x[2])) for r in out]


def collapsed(words: list[bytes], found: list[Run]) -> list[bytes]:
    """Without the words that a run contains after its first period."""
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        gone[start + period] += 1
        gone[start + length] -= 1
    return [w for w, k in zip(words, np.cumsum(gone).tolist()) if not k]


OUT = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def _map(docs: DataFrame, doc_id: str, text: str, plant: bool, columns, schema: str) -> DataFrame:
    source = text_or_empty(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")))

    def make():
        def work(piece: pa.RecordBatch) -> pa.RecordBatch:
            ids = column_of(piece, "doc_id")
            texts = [t.split() for t in texts_of(piece)]
            if plant:
                texts = [planted(w, i) for w, i in zip(texts, ids.to_pylist())]
            number: dict[bytes, int] = {}
            found = runs([[number.setdefault(w, len(number)) for w in words] for words in texts])
            made = columns(texts, found)
            return pa.RecordBatch.from_arrays([ids, *made.values()], ["doc_id", *made])

        return work

    return map_slices(source, make, schema, limit=SLICE)


def _digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def summaries(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", plant: bool = False) -> DataFrame:
    """``OUT`` of every document: its longest run (ties: first start, then smallest period) and digests."""

    def columns(texts, found):
        best = [min(r, key=lambda x: (-x[1], x[0], x[2])) if r else (None,) * 3 for r in found]
        lines = ["".join(f"{s},{n},{p}\n" for s, n, p in r) for r in found]
        number = lambda values: pa.array(list(values), pa.int64())
        return {
            "n_runs": number(map(len, found)), "start": number(b[0] for b in best), "length": number(b[1] for b in best),
            "period": number(b[2] for b in best), "exponent_milli": number(b[1] * 1000 // b[2] if b[1] else None for b in best),
            "runs_sha256": pa.array([_digest(x.encode()) for x in lines]),
            "collapsed_sha256": pa.array([_digest(b" ".join(collapsed(w, r))) for w, r in zip(texts, found)])}

    return _map(docs, doc_id, text, plant, columns, OUT)


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", plant: bool = False) -> DataFrame:
    """(doc_id, runs, collapsed): all runs of every document, and its text without their repetitions."""

    def columns(texts, found):
        entries = [[{"start": s, "length": n, "period": p} for s, n, p in r] for r in found]
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        rest = [b" ".join(collapsed(w, r)).decode("utf-8", "replace") for w, r in zip(texts, found)]
        return {"runs": pa.array(entries, kind), "collapsed": pa.array(rest, pa.string())}

    return _map(docs, doc_id, text, plant, columns,
                "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
