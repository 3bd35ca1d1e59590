"""Benchmark decontamination: size-partitioned MinHash containment search with an exact check.

A short item inside a long document has a tiny Jaccard similarity, so the sketch is one-sided.
Items fall into partitions by the number of their distinct shingles. An item's sketch is its
bottom-m MinHash values, and m follows from the partition's largest size u: to be contained at
the threshold t at most floor((1-t)u) of its shingles may be missing, so any floor((1-t)u)+1 of
them hold one that a containing document has. The search therefore loses no pair; candidates
are then checked by exact containment of shingle sets.

Items are read to the driver in blocks of a bounded number of shingles (``BLOCK_SHINGLES``),
each block is broadcast and meets every document in place: no shuffle of document text at all,
and no key that could be hot.

Words: A-Z lower-cased, split at ASCII white space. An item of fewer words than a shingle has
one shingle, its whole word sequence; an item without words matches nothing. Null texts are
empty. Repeated documents or items give a pair each. No item or no document: no pairs.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lognorm.llm.common import column_of, keep_rows, map_slices, text_or_empty, texts_of, words_of

SHINGLE_WORDS = 5
THRESHOLD = 0.8
#: Shingles of one broadcast block of items: about 100 bytes each, so 50 MB at most.
BLOCK_SHINGLES = 500_000
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_MASK = (1 << 64) - 1


@dataclass
class Item:
    item_id: int
    words: int  # of a shingle: SHINGLE_WORDS, or fewer for a shorter item
    shingles: frozenset  # of word-number tuples


class ItemIndex:
    """Items by partition of size, with the bottom-m MinHash values of each."""

    def __init__(self, items: list[tuple[int, bytes]], width: int = SHINGLE_WORDS, threshold: float = THRESHOLD):
        self.threshold = threshold
        self.number: dict[bytes, int] = {}
        self.items: list[Item] = []
        for item_id, text in items:
            words = [self.number.setdefault(w, len(self.number) + 1) for w in words_of(text)]
            if words:
                n = min(width, len(words))
                self.items.append(Item(item_id, n, frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1))))
        partitions = defaultdict(list)
        for k, item in enumerate(self.items):
            partitions[item.words, len(item.shingles).bit_length()].append(k)
        #: By shingle width: minhash value -> items whose sketch holds it.
        self.sketches: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        for (n, _), members in partitions.items():
            largest = max(len(self.items[k].shingles) for k in members)
            m = math.floor((1 - threshold) * largest + 1e-9) + 1
            for k in members:
                values = np.sort(hashed(np.array(list(self.items[k].shingles), dtype=np.uint64)))[:m]
                for v in values.tolist():
                    self.sketches[n][v].append(k)
        self.probes = {n: np.array(sorted(s), dtype=np.uint64) for n, s in self.sketches.items()}
        self.sketches = {n: dict(s) for n, s in self.sketches.items()}

    def matches(self, text: bytes) -> list[tuple[int, int, int]]:
        """(item, shared shingles, item's shingles) for every item that the text contains."""
        get = self.number.get
        words = np.array([get(w, 0) for w in words_of(text)], dtype=np.uint64)
        found = []
        for n, probe in self.probes.items():
            if len(words) < n:
                continue
            rows = np.lib.stride_tricks.sliding_window_view(words, n)
            rows = rows[rows.all(axis=1)]  # a shingle with a word that no item has is in no item
            if not len(rows):
                continue
            values = hashed(rows)
            at = np.minimum(np.searchsorted(probe, values), len(probe) - 1)
            hits = np.unique(values[probe[at] == values])
            candidates = {k for v in hits.tolist() for k in self.sketches[n][v]}
            if not candidates:
                continue
            have = set(map(tuple, rows.tolist()))
            for k in sorted(candidates):
                own = self.items[k].shingles
                shared = len(own & have)
                if shared >= self.threshold * len(own) - 1e-9:
                    found.append((self.items[k].item_id, shared, len(own)))
        return found


def hashed(rows: np.ndarray) -> np.ndarray:
    """MinHash value of each row of word numbers: a 64-bit mix, the same in every task."""
    value = np.zeros(len(rows), dtype=np.uint64)
    for column in rows.T:
        value = (value ^ column) * np.uint64(_MIX[0])
        value = (value ^ (value >> np.uint64(29))) * np.uint64(_MIX[1])
        value ^= value >> np.uint64(32)
    return value


def item_blocks(items: DataFrame, item_id: str, text: str, limit: int = BLOCK_SHINGLES) -> Iterator[list[tuple[int, bytes]]]:
    """The benchmark in blocks of at most ``limit`` words (or one item), read partition by partition."""
    block, held = [], 0
    rows = text_or_empty(items.select(item_id, text), text)
    for row in rows.toLocalIterator():
        data = row[1].encode()
        size = len(data.split())
        if block and held + size > limit:
            yield block
            block, held = [], 0
        block.append((row[0], data))
        held += size
    if block:
        yield block


def contained_items(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", width: int = SHINGLE_WORDS, threshold: float = THRESHOLD,
) -> DataFrame:
    """(doc_id, item_id, shared, shingles, containment) for every document that holds an item."""
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, shared long, shingles long, containment double"
    out = spark.createDataFrame([], schema)
    source = text_or_empty(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")))
    for k, block in enumerate(item_blocks(items, item_id, item_text)):
        shared_block = spark.sparkContext.broadcast(block)

        def make(shared_block=shared_block):
            index = ItemIndex(shared_block.value, width, threshold)

            def work(piece: pa.RecordBatch) -> pa.RecordBatch:
                ids, rows = column_of(piece, "doc_id").to_pylist(), []
                for d, t in zip(ids, texts_of(piece), strict=True):
                    rows += [(d, *m, m[1] / m[2]) for m in index.matches(t)]
                columns = list(zip(*rows, strict=True)) or [()] * 5
                kinds = [pa.int64()] * 4 + [pa.float64()]
                names = ["doc_id", "item_id", "shared", "shingles", "containment"]
                return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

            return work

        pairs = map_slices(source, make, schema)
        out = pairs if k == 0 else out.unionAll(pairs)
    return out


def decontaminated(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    width: int = SHINGLE_WORDS, threshold: float = THRESHOLD,
) -> DataFrame:
    """The documents that hold no item, with all their columns."""
    spark = docs.sparkSession
    for block in item_blocks(items, item_id, item_text):
        shared_block = spark.sparkContext.broadcast(block)

        def make(shared_block=shared_block):
            index = ItemIndex(shared_block.value, width, threshold)
            return lambda texts: np.array([not index.matches(t) for t in texts], dtype=bool)

        docs = keep_rows(docs, make, text)
    return docs
