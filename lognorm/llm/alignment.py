"""Alignment of two tokenizers' tokens by whitespace-token anchors.

A text is tokenised as a whole by both: A, a byte-level BPE, on a space and the text; B, a
sentence piece model, on the text, to which it adds the space. If the bytes of all A tokens, and
those of all B tokens, are the space and the text, byte offsets where tokens of both end are
shared ends. A shared end is an anchor where the next token of A and the next of B both begin
with a space, and at the end of the text. Anchors cut a document into windows of token ids; what
a window holds follows from its ids alone, so each distinct window is aligned once and remembered
by its ids, up to a bound.

In a window the shared ends close groups, and tokens of A and B whose bytes overlap are linked.
A pair's count is the number of documents that hold it linked; a link is best if its count is the
highest of its A id. Each document's distinct pairs are stored once; they are counted with partial
sums in the tasks. The counts of the commonest pairs (``COMMON_PAIRS`` at most) then go to every
task; links of other pairs, all of them rarer, meet their counts in a join.

A text that is null or empty, or whose tokens do not give back its bytes, has no tokens: numbers
are 0 and the hash is ''. A long text is one window's work at a time, so memory is linear in it.
Repeated rows of a doc_id, and null doc_ids, are documents of their own. An empty table gives an
empty result. Only the two named columns of the input are read.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lognorm.llm.common import column_of, map_slices, saved, text_or_empty, texts_of
from lognorm.llm.sentencepiece_codec import MODEL
from lognorm.llm.tokens import BYTE_BPE, byte_level, byte_level_bytes, flat, piece_bytes, sentence_pieces

#: Pairs whose counts go to every task (17 bytes each).
COMMON_PAIRS = 1 << 20
#: Windows, and links in windows, that a task remembers.
REMEMBER_WINDOWS, REMEMBER_LINKS = 400_000, 4_000_000
#: A pair is one number: A's id times this and B's id.
PAIR = 1 << 20
SLICE = 1 << 20
_NONE = np.zeros(0, np.int64)


class Aligner:
    """Aligns slices of texts; ``tokenizer`` is A's file, ``model`` B's."""

    def __init__(self, tokenizer: str, model: str):
        self.encode_a, self.encode_b = byte_level(tokenizer, plain=True), sentence_pieces(model)
        self.bytes_a, self.bytes_b = byte_level_bytes(tokenizer), piece_bytes(model)
        self.sizes_a, self.sizes_b = (np.array(list(map(len, t))) for t in (self.bytes_a, self.bytes_b))
        self.vocabulary = max(len(self.bytes_a), len(self.bytes_b))
        self.written = [f"{i}{mark}" for mark in ",|;" for i in range(self.vocabulary)]  # an id, then what follows it
        self.space_a, self.space_b = (np.array([x[:1] == b" " for x in t]) for t in (self.bytes_a, self.bytes_b))
        self._reset()

    def _reset(self):
        self.code: dict[bytes, int] = {}
        self.groups: list[str] = []
        self.n_groups, self.starts, self.lengths, self.links = _NONE, _NONE, _NONE, _NONE

    def _learn(self, windows: list[bytes]):
        """Aligns new windows, all in one sweep: within each, A's and B's tokens hold the same bytes."""
        ids = np.frombuffer(b"".join(windows), np.int32)
        lengths = np.fromiter(map(len, windows), np.int64, len(windows)) // ids.itemsize
        of_b = ids < 0  # B's ids come second, as complements
        a, b = ids[~of_b].astype(np.int64), ~ids[of_b].astype(np.int64)
        window = np.repeat(np.arange(len(windows)), lengths)[~of_b]
        ends_a, ends_b = np.cumsum(self.sizes_a[a]), np.cumsum(self.sizes_b[b])
        first = np.searchsorted(ends_b, ends_a - self.sizes_a[a], side="right")
        overlaps = np.searchsorted(ends_b - self.sizes_b[b], ends_a) - first
        before = np.cumsum(overlaps) - overlaps
        links = np.repeat(a * PAIR, overlaps) + b[np.repeat(first - before, overlaps) + np.arange(int(overlaps.sum()))]
        at = np.searchsorted(ends_b, ends_a)
        closes_a = ends_b[at] == ends_a
        closes_b = np.zeros(len(b), bool)
        closes_b[at[closes_a]] = True
        group_a, group_b = np.cumsum(closes_a) - closes_a, np.cumsum(closes_b) - closes_b
        in_a, in_b = np.bincount(group_a), np.bincount(group_b)
        written = np.empty(len(ids), np.int64)
        written[np.arange(len(a)) + (np.cumsum(in_b) - in_b)[group_a]] = np.where(closes_a, 1, 0) * self.vocabulary + a
        written[np.arange(len(b)) + np.cumsum(in_a)[group_b]] = np.where(closes_b, 2, 0) * self.vocabulary + b
        parts, ends = list(map(self.written.__getitem__, written.tolist())), np.cumsum(lengths).tolist()
        sizes = np.zeros(len(windows), np.int64)
        np.add.at(sizes, window, overlaps)
        self.code.update(zip(windows, range(len(self.code), len(self.code) + len(windows)), strict=True))
        self.groups += ["".join(parts[x:y])[:-1] for x, y in zip([0, *ends], ends)]
        self.n_groups = np.concatenate([self.n_groups, np.bincount(window[closes_a], minlength=len(windows))])
        self.starts = np.concatenate([self.starts, np.cumsum(sizes) - sizes + len(self.links)])
        self.lengths = np.concatenate([self.lengths, sizes])
        self.links = np.concatenate([self.links, links])

    def tokens(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(A's ids, number of them a text, B's ids, number); none where the bytes do not come back."""
        texts = [t.decode("utf-8", "replace") for t in raw]
        a = self.encode_a([" " + t if t else "" for t in texts])
        b = self.encode_b(texts)
        for n, t in enumerate(raw):
            if t and not b"".join(map(self.bytes_a.__getitem__, a[n])) == b" " + t == b"".join(map(self.bytes_b.__getitem__, b[n])):
                a[n], b[n] = [], []
        return *flat(a), *flat(b)

    def windows(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(code of every window, number of windows, of A's tokens, of B's tokens a text)."""
        a, n_a, b, n_b = self.tokens(raw)
        if len(self.code) > REMEMBER_WINDOWS or len(self.links) > REMEMBER_LINKS:
            self._reset()
        ends_a, ends_b = np.cumsum(self.sizes_a[a]), np.cumsum(self.sizes_b[b])
        at = np.searchsorted(ends_b, ends_a)
        shared = np.flatnonzero(ends_b[at] == ends_a) if len(a) else _NONE
        # The first token of a text has a space before it, so ends of texts are among these.
        next_a = np.append(self.space_a[a], True)[shared + 1]
        next_b = np.append(self.space_b[b], True)[at[shared] + 1]
        cut_a = shared[next_a & next_b] + 1
        cut_b = at[cut_a - 1] + 1
        from_a, from_b = np.concatenate([[0], cut_a[:-1]]), np.concatenate([[0], cut_b[:-1]])
        both = np.empty(len(a) + len(b), np.int32)
        both[np.arange(len(a)) + np.repeat(from_b, cut_a - from_a) if len(cut_a) else _NONE] = a
        both[np.arange(len(b)) + np.repeat(cut_a, cut_b - from_b) if len(cut_a) else _NONE] = ~b
        buffer, cuts = both.tobytes(), (4 * (cut_a + cut_b)).tolist()
        keys = [buffer[x:y] for x, y in zip([0, *cuts], cuts)]
        new = sorted(set(keys) - self.code.keys())
        if new:
            self._learn(new)
        count = np.diff(np.concatenate([[0], np.searchsorted(cut_a, np.cumsum(n_a), side="right")]))
        return np.fromiter(map(self.code.__getitem__, keys), np.int64, len(keys)), count, n_a, n_b

    def texts(self, codes: np.ndarray, count: np.ndarray) -> list[str]:
        """The groups of every text."""
        groups, ends = list(map(self.groups.__getitem__, codes.tolist())), np.cumsum(count).tolist()
        return [";".join(groups[x:y]) for x, y in zip([0, *ends], ends)]

    def pairs(self, codes: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text number, pair, how often linked there), by text and pair; ``count``: windows a text."""
        sizes = self.lengths[codes]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        links = self.links[np.repeat(self.starts[codes] - (ends - sizes), sizes) + np.arange(total)]
        doc = np.repeat(np.repeat(np.arange(len(count)), count), sizes)
        found, times = np.unique(doc * (PAIR * PAIR) + links, return_counts=True)
        return found // (PAIR * PAIR), found % (PAIR * PAIR), times


@lru_cache(maxsize=2)
def aligner_for(tokenizer: str, model: str) -> Aligner:
    """One for each Python worker, so that tasks after the first find frequent windows known."""
    return Aligner(tokenizer, model)


ROW = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
       "links array<struct<pair: long, times: int>>")


def _linked(source: DataFrame, tokenizer: str, model: str) -> DataFrame:
    """``ROW`` of every document: its pairs, each once with how often it is linked. ``row`` tells documents apart."""

    def make():
        aligner = aligner_for(tokenizer, model)
        task, seen = TaskContext.get().partitionId(), 0

        def work(piece: pa.RecordBatch) -> pa.RecordBatch:
            nonlocal seen
            codes, count, n_a, n_b = aligner.windows(texts_of(piece))
            doc, pair, times = aligner.pairs(codes, count)
            window_doc = np.repeat(np.arange(piece.num_rows), count)
            n_groups, n_links = np.zeros((2, piece.num_rows), np.int64)
            np.add.at(n_groups, window_doc, aligner.n_groups[codes])
            np.add.at(n_links, doc, times)
            groups = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in aligner.texts(codes, count)]
            links = pa.StructArray.from_arrays([pa.array(pair), pa.array(times, pa.int32())], ["pair", "times"])
            offsets = pa.array(np.searchsorted(doc, np.arange(piece.num_rows + 1)), pa.int32())
            rows = (task << 33) + seen + np.arange(piece.num_rows)
            seen += piece.num_rows
            return pa.RecordBatch.from_arrays(
                [pa.array(rows), column_of(piece, "doc_id"), *map(pa.array, (n_a, n_b, n_groups, n_links)),
                 pa.array(groups, pa.string()), pa.ListArray.from_arrays(offsets, links)],
                ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"])

        return work

    return map_slices(source, make, ROW, limit=SLICE)


def with_best(counts: DataFrame) -> DataFrame:
    """(pair, n, best): whether no pair of the same A id has a higher count."""
    a = F.expr(f"pair div {PAIR}")
    most = counts.groupBy(a.alias("a")).agg(F.max("n").alias("most"))
    return counts.withColumn("a", a).join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def common_pairs(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pair, n, best) sorted by pair: all pairs above the least power of two that leaves ``most`` at most."""
    steps = counts.groupBy(F.floor(F.log2("n")).alias("step")).count().orderBy(F.desc("step")).collect()  # 64 rows at most
    total, least = 0, None
    for row in steps:
        total += row["count"]
        if total > most:
            break
        least = row["step"]
    if least is None:
        return _NONE, _NONE, np.zeros(0, bool)
    rows = counts.where(F.floor(F.log2("n")) >= least).toPandas().sort_values("pair")
    return rows["pair"].to_numpy(), rows["n"].to_numpy(), rows["best"].to_numpy()


COUNTED = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
           "groups_sha256 string, rest array<struct<pair: long, times: int>>")


def _counted(rows: DataFrame, common) -> DataFrame:
    """``COUNTED``: the result of every document as far as common pairs go; ``rest``: its other pairs."""

    def run(batches):
        known, n, best = common.value
        for b in batches:
            links = column_of(b, "links")
            pair, times = (links.flatten().field(k).to_numpy() for k in (0, 1))
            doc = np.repeat(np.arange(b.num_rows), np.diff(links.offsets.to_numpy()))
            at = np.minimum(np.searchsorted(known, pair), max(len(known) - 1, 0))
            hit = known[at] == pair if len(known) else np.zeros(len(pair), bool)
            n_best, count_sum = np.zeros((2, b.num_rows), np.int64)
            np.add.at(n_best, doc[hit], times[hit] * best[at[hit]])
            np.add.at(count_sum, doc[hit], times[hit] * n[at[hit]])
            offsets = pa.array(np.searchsorted(doc[~hit], np.arange(b.num_rows + 1)), pa.int32())
            rest = pa.ListArray.from_arrays(offsets, links.flatten().filter(pa.array(~hit)))
            new = {"n_best": pa.array(n_best), "count_sum": pa.array(count_sum), "rest": rest}
            names = [f.split()[0] for f in COUNTED.split(", ", 9)]
            yield pa.RecordBatch.from_arrays([new[x] if x in new else column_of(b, x) for x in names], names)

    return rows.mapInArrow(run, COUNTED)


def aligned(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str = BYTE_BPE, model: str = MODEL,
            most: int = COMMON_PAIRS) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document."""
    rows = saved(_linked(_source(docs, doc_id, text, tokenizer, model), tokenizer, model))
    counts = saved(with_best(saved(rows.select(F.explode("links.pair").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")))))
    common = docs.sparkSession.sparkContext.broadcast(common_pairs(counts, most))
    counted = saved(_counted(rows, common))
    links = counted.select("row", F.explode("rest").alias("x")).select("row", "x.pair", "x.times").join(counts, "pair")
    more = links.groupBy("row").agg(F.sum(F.col("times") * F.col("best").cast("long")).alias("more_best"),
                                    F.sum(F.col("times") * F.col("n")).alias("more_sum"))
    rest = counted.where(F.size("rest") > 0).join(more, "row").withColumns(
        {"n_best": F.col("n_best") + F.col("more_best"), "count_sum": F.col("count_sum") + F.col("more_sum")})
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return counted.where(F.size("rest") == 0).select(names).unionAll(rest.select(names))


def alignments(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str = BYTE_BPE, model: str = MODEL) -> DataFrame:
    """(doc_id, groups): the groups of every document as text, ``a1,a2|b1;a3|b2,b3`` in ids."""

    def make():
        aligner = aligner_for(tokenizer, model)

        def work(piece: pa.RecordBatch) -> pa.RecordBatch:
            codes, count, _, _ = aligner.windows(texts_of(piece))
            return pa.RecordBatch.from_arrays(
                [column_of(piece, "doc_id"), pa.array(aligner.texts(codes, count), pa.string())], ["doc_id", "groups"])

        return work

    return map_slices(_source(docs, doc_id, text, tokenizer, model), make, "doc_id long, groups string", limit=SLICE)


def _source(docs: DataFrame, doc_id: str, text: str, *files: str) -> DataFrame:
    for path in files:
        docs.sparkSession.sparkContext.addFile(path)
    return text_or_empty(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")))
