"""Packing of tokenised documents into sequences: dominance reduction, then best fit.

Documents are their ids and an end id; only those longer than a sequence are cut, into full
pieces with a shorter one in front. How many pieces there are of each length is all that decides
a packing, so the packing problem is solved on these counts (one for each length up to
``CAPACITY``, whatever the size of the corpus) and the pieces are then dealt to it in parallel.

Reduction (Martello and Toth). Take the longest length j that has pieces left. A set of pieces
with j is fixed for good if it dominates every other set with j that fits, that is, if any other
such set could be swapped for it without opening a sequence:

* j alone, if nothing else fits;
* j and k, k the longest that fits, if k fills the sequence, or no two pieces fit beside j, or any
  two and more that fit together are no longer than k;
* j, k and the longest l that fits beside them, if no three pieces fit beside j and l is at least
  the shorter of any two that do.

A fixed set is taken as often as its counts allow (fewer pieces left only means fewer
alternatives), and the rest is reduced again until nothing more can be fixed. What remains goes,
longest first, each piece to the fullest sequence that has room. Equal sequences are kept as
one pattern with a number, so work depends on the number of lengths, not of pieces.

A pattern gives each length in it a range of piece numbers. Pieces are numbered within their
task while they are tokenised; the numbers before a task come from prefix sums over tasks, in
blocks, so no length's pieces are ever gathered.

Null texts count as empty: one end id. Repeated rows and null doc_ids are packed like any other.
An empty table gives an empty result. Two columns of the input are read, others do no harm.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lognorm.llm.common import column_of, map_slices, saved, text_or_empty, texts_of
from lognorm.llm.tokens import BYTE_BPE, byte_level, flat

CAPACITY = 1024
END = 2
#: Tasks whose counts one window partition adds up.
BLOCK = 1024
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, number long"


@dataclass(frozen=True)
class Pattern:
    """``count`` sequences, each of ``lengths`` (length, how often), in this order."""

    count: int
    lengths: tuple[tuple[int, int], ...]


def _grouped(lengths: list[int]) -> tuple[tuple[int, int], ...]:
    return tuple((s, lengths.count(s)) for s in sorted(set(lengths), reverse=True))


def _sums_of_two_or_more(sizes: list[int], room: int) -> int:
    """Bit s is set if two or more pieces of the sizes, each as often as wanted, may add up to s <= room."""
    mask = (1 << (room + 1)) - 1
    one = sum(1 << s for s in sizes)
    some = one & mask
    out = 0
    while True:
        more = 0
        for s in sizes:
            more |= (some << s) & mask
        if more | out == out:
            return out
        out |= more
        some |= more


def _shorter_of_two(sizes: list[int], left: dict[int, int], room: int) -> int:
    """The longest piece that is the shorter of two that fit in the room; 0 if no two fit."""
    for y in reversed(sizes[:bisect_left(sizes, room // 2 + 1)]):
        at = sizes.index(y)
        x = y if left[y] > 1 else sizes[at + 1] if at + 1 < len(sizes) else None
        if x is not None and x + y <= room:
            return y
    return 0


def dominating(counts: dict[int, int], j: int, capacity: int = CAPACITY) -> list[int] | None:
    """A set with a piece of length j that dominates all others with one, or None if none is proven."""
    left = {s: n for s, n in counts.items() if n > 0}
    left[j] -= 1
    room = capacity - j
    sizes = sorted(s for s, n in left.items() if n and s <= room)
    if not sizes:
        return [j]
    k = sizes[-1]
    least = sizes[0]
    two = 2 * least if left[least] > 1 else least + sizes[1] if len(sizes) > 1 else None
    if k == room or two is None or two > room:
        return [j, k]
    if not _sums_of_two_or_more(sizes, room) >> (k + 1):
        return [j, k]
    smallest = [s for s in sizes[:3] for _ in range(min(left[s], 3))][:3]
    if len(smallest) < 3 or sum(smallest) > room:
        left[k] -= 1
        rest = [s for s in sizes if left[s] and s <= room - k]
        left[k] += 1
        if rest and rest[-1] >= _shorter_of_two(sizes, left, room):
            return [j, k, rest[-1]]
    return None


def reduced(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[Pattern], dict[int, int]]:
    """(patterns that an optimal packing may contain, what is left)."""
    left = {s: n for s, n in counts.items() if n > 0}
    patterns, changed = [], True
    while changed:
        changed = False
        for j in sorted(left, reverse=True):
            while left.get(j, 0) and (chosen := dominating(left, j, capacity)):
                lengths = _grouped(chosen)
                times = min(left[s] // n for s, n in lengths)
                patterns.append(Pattern(times, lengths))
                for s, n in lengths:
                    left[s] -= n * times
                changed = True
    return patterns, {s: n for s, n in left.items() if n > 0}


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Longest first, each piece to the fullest sequence with room, a new one if there is none."""
    by_room: dict[int, list[Pattern]] = {}
    rooms: list[int] = []

    def put(p: Pattern, room: int):
        if p.count:
            if room not in by_room:
                by_room[room] = []
                insort(rooms, room)
            by_room[room].append(p)

    for s in sorted(counts, reverse=True):
        n = counts[s]
        while n:
            at = bisect_left(rooms, s)
            if at < len(rooms):
                room = rooms[at]
                p = by_room[room].pop()
                if not by_room[room]:
                    del by_room[room], rooms[at]
            else:
                room, p = capacity, Pattern(n, ())
            each = room // s
            full = min(p.count, n // each)
            put(Pattern(full, (*p.lengths, (s, each))), room - each * s)
            n -= full * each
            more = min(n, each) if full < p.count else 0
            if more:
                put(Pattern(1, (*p.lengths, (s, more))), room - more * s)
                n -= more
            if p.lengths:
                put(Pattern(p.count - full - (more > 0), p.lengths), room)
    return [p for group in by_room.values() for p in group]


def packed_counts(counts: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    patterns, left = reduced(counts, capacity)
    return patterns + best_fit(left, capacity)


def ranges(patterns: list[Pattern]) -> np.ndarray:
    """Rows (length, first piece number, pieces a sequence, first sequence, offset), sorted."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for p in patterns:
        offset = 0
        for s, each in p.lengths:
            first = used.get(s, 0)
            rows.append((s, first, each, sequence, offset))
            used[s] = first + p.count * each
            offset += s * each
        sequence += p.count
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str = BYTE_BPE, end: int = END,
           capacity: int = CAPACITY) -> DataFrame:
    """``PIECES``: every piece of every document, numbered within its task and length."""
    source = text_or_empty(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")))
    docs.sparkSession.sparkContext.addFile(tokenizer)

    def make():
        encode = byte_level(tokenizer)
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids, sizes = flat([[*x, end] for x in encode([t.decode("utf-8", "replace") for t in texts_of(batch)])])
            parts = -(-sizes // capacity)
            doc = np.repeat(np.arange(len(sizes)), parts)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
            short = sizes - (parts - 1) * capacity  # the first piece
            start = np.where(piece == 0, 0, short[doc] + (piece - 1) * capacity)
            length = np.where(piece == 0, short[doc], capacity)
            raw = memoryview(ids.astype("<u4").tobytes())
            at = (np.cumsum(sizes) - sizes)[doc] + start
            crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(at.tolist(), (at + length).tolist())]
            order = np.argsort(length, kind="stable")
            ordered = length[order]
            first = np.searchsorted(ordered, ordered)
            number = np.empty(len(order), np.int64)
            number[order] = np.arange(len(order)) - first + seen[ordered]
            np.add.at(seen, length, 1)
            return pa.RecordBatch.from_arrays(
                [column_of(batch, "doc_id").take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length),
                 pa.array(crc, pa.int64()), pa.array(np.full(len(doc), task), pa.int32()), pa.array(number)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "task", "number"])

        return work

    return map_slices(source, make, PIECES)


def numbered_before(rows: DataFrame) -> DataFrame:
    """(task, length, before): pieces of the length in earlier tasks; two levels of prefix sums."""
    counts = saved(rows.groupBy("task", "length").agg(F.count("*").alias("n")).withColumn("block", F.expr(f"task div {BLOCK}")))
    earlier = lambda *keys: Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    blocks = counts.groupBy("length", "block").agg(F.sum("n").alias("n")).select(
        "length", "block", F.coalesce(F.sum("n").over(earlier("length").orderBy("block")), F.lit(0)).alias("blocks"))
    inside = counts.select("task", "length", "block", F.coalesce(
        F.sum("n").over(earlier("length", "block").orderBy("task")), F.lit(0)).alias("tasks"))
    return inside.join(blocks, ["length", "block"]).select("task", "length", (F.col("blocks") + F.col("tasks")).alias("before"))


def packed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str = BYTE_BPE, end: int = END,
           capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece."""
    rows = saved(pieces(docs, doc_id, text, tokenizer, end, capacity))
    counts = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    table = rows.sparkSession.sparkContext.broadcast(ranges(packed_counts(counts, capacity)))

    def deal(batches):
        lengths, firsts, each, sequences, offsets = table.value.T
        most = int(firsts.max(initial=0)) + 1
        keys = lengths * most + firsts
        for b in batches:
            length = column_of(b, "length").to_numpy()
            number = column_of(b, "number").to_numpy() + column_of(b, "before").to_numpy()
            r = np.searchsorted(keys, length * most + np.minimum(number, most - 1), side="right") - 1
            inside = number - firsts[r]
            out = [column_of(b, n) for n in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*out, pa.array(sequences[r] + inside // each[r]), pa.array(offsets[r] + inside % each[r] * length)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return rows.join(numbered_before(rows), ["task", "length"]).mapInArrow(
        deal, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
