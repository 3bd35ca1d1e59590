"""SimHash near-dedup with covering locality-sensitive hashing.

A fingerprint bit is set where over half of a text's shingle hashes (XXH64, seed 42) have it
set. Fingerprints link at ``RADIUS`` or fewer differing bits, and documents of linked
fingerprints are one component.

Covering masks: every bit position i gets a vector m(i) of r+1 bits, every non-zero vector v of
r+1 bits a table that keeps the positions with an odd number of common ones in m(i) and v. Any
r differing positions give r linear conditions, so some v is orthogonal to all of them: in that
table the pair collides. 31 tables thus find every pair within 4 bits, none is missed.

Documents are first grouped by fingerprint, so copies cost one row. A bucket is compared pair by
pair only while it is small. A larger one is split by covering masks over the positions the
bucket leaves open, again and again; where at most ``RADIUS`` positions are open all members
link, and a star of n-1 links says so. Work per task is bounded and no pair is lost.

Words: A-Z lower-cased, split at ASCII white space; a text of fewer words than a shingle has one
shingle, its whole sequence; a text without words (or null) has fingerprint 0, linked like any
other. Repeated rows of one doc_id give a row each. An empty table gives an empty result.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lognorm.llm.common import column_of, map_slices, saved, text_or_empty, texts_of
from lognorm.llm.components import components

SHINGLE_WORDS = 4
RADIUS = 4
BITS = 64
SEED = 42
#: Members of a bucket that are compared pair by pair.
BUCKET = 64


def shingle_hashes(text: bytes, width: int = SHINGLE_WORDS) -> np.ndarray:
    """XXH64 of every shingle, repeats included."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(words)
    ends = np.append(np.flatnonzero(np.frombuffer(joined, np.uint8) == 32), len(joined))  # no word holds a space
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(len(words) - width + 1, 1)
    last = ends[min(width, len(words)) - 1:]
    digest, seed = xxhash.xxh64_intdigest, SEED
    return np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts[:n].tolist(), last.tolist())), np.uint64, n)


def fingerprint(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes; none: 0."""
    counts = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = np.ascontiguousarray(hashes[i:i + (1 << 16)]).view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp long: the 64 bits)."""
    source = text_or_empty(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")))

    def make():
        def work(piece: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([column_of(piece, "doc_id"), pa.array(prints_of(texts_of(piece)))], ["doc_id", "fp"])

        return work

    return map_slices(source, make, "doc_id long, fp long")


@functools.cache
def covering_masks(level: int, radius: int = RADIUS) -> tuple[int, ...]:
    """The masks of all 2^(r+1)-1 tables; another assignment of vectors to positions at each level."""
    count = (1 << (radius + 1)) - 1
    vectors = np.random.default_rng(level).permutation(BITS) % count + 1  # every vector equally often
    return tuple(
        sum(1 << i for i in range(BITS) if bin(int(vectors[i]) & v).count("1") & 1) for v in range(1, count + 1))


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _tables(rows: DataFrame, level: int) -> DataFrame:
    """(bucket, fp) in every table of a level. Two buckets of one hash only add comparisons."""
    masks = F.array(*[F.lit(_signed(m)) for m in covering_masks(level)])
    spread = rows.select("bucket", "fp", F.posexplode(masks).alias("t", "mask"))
    return spread.select(F.xxhash64("bucket", "t", F.col("fp").bitwiseAND(F.col("mask"))).alias("bucket"), "fp")


def links(fps: DataFrame, bucket: int = BUCKET, most_levels: int = 40) -> DataFrame:
    """(a, b) links of distinct fingerprints ``fp``: all pairs within the radius, but of buckets whose
    members all link only a star."""
    found = []
    rows = fps.select(F.lit(0).cast("long").alias("bucket"), "fp")
    for level in range(most_levels):
        spread = _tables(rows, level)
        facts = spread.groupBy("bucket").agg(
            F.count("*").alias("n"), F.min("fp").alias("low"), F.expr("bit_count(bit_or(fp) ^ bit_and(fp))").alias("open")).where("n > 1")
        members = saved(spread.join(facts, "bucket"))
        star = members.where(f"open <= {RADIUS} AND fp <> low").select(F.col("fp").alias("a"), F.col("low").alias("b"))
        small = members.where(f"open > {RADIUS} AND n <= {bucket}").groupBy("bucket").agg(F.array_sort(F.collect_list("fp")).alias("all"))
        one = small.select("all", F.posexplode("all").alias("i", "a"))
        pair = one.select("a", F.explode(F.filter(
            F.expr("slice(all, i + 2, size(all))"), lambda x: F.bit_count(F.col("a").bitwiseXOR(x)) <= RADIUS)).alias("b"))
        found.append(saved(star.unionAll(pair).distinct()))
        rows = members.where(f"open > {RADIUS} AND n > {bucket}").select("bucket", "fp")
        if rows.isEmpty():
            out = found[0]
            for more in found[1:]:
                out = out.unionAll(more)
            return out.distinct()
    raise RuntimeError(f"buckets stayed large over {most_levels} levels")


def classes(prints: DataFrame) -> DataFrame:
    """(fp, root, component_id) of a (doc_id, fp) table: smallest fingerprint and smallest doc_id reachable."""
    heads = saved(prints.groupBy("fp").agg(F.min("doc_id").alias("head")))
    roots = components(links(heads.select("fp")))
    rooted = saved(heads.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "head", F.coalesce("root", "fp").alias("root")))
    least = rooted.groupBy("root").agg(F.min("head").alias("component_id"))
    return rooted.join(least, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp, root, component_id) of every row; without any doc_id in a component its id is null."""
    prints = saved(fingerprints(docs, doc_id, text))
    return prints.join(classes(prints), "fp").select("doc_id", "fp", "root", "component_id")


def prints_of(texts: list[bytes]) -> np.ndarray:
    return np.array([fingerprint(shingle_hashes(t)) for t in texts], dtype=np.uint64).view(np.int64)


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component stays, with all its columns: that of the smallest doc_id."""
    return one_of_each(docs, saved(near_duplicates(docs, doc_id, text)), prints_of, doc_id, text)


def one_of_each(docs: DataFrame, rows: DataFrame, prints, doc_id: str, text: str) -> DataFrame:
    """One row of each component stays; ``rows`` are those of ``near_duplicates``, ``prints`` gives fp of texts.

    Rows that share a doc_id, or have none, are told apart by fingerprint, then by a hash of all
    columns; of wholly equal rows one stays. Such rows take a path of their own; the others meet
    the decisions by doc_id alone, and only the doc_ids that go are joined.
    """
    repeated = saved(rows.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").select(F.col("doc_id").alias("_r")))
    gone = rows.where("doc_id <> component_id").select(F.col("doc_id").alias("_r")).unionAll(repeated).distinct()
    key = F.col(doc_id).cast("long")
    kept = docs.where(key.isNotNull()).join(gone, key == F.col("_r"), "left_anti")
    if repeated.isEmpty():
        return kept
    keepers = rows.where("doc_id <=> component_id").groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").alias("k"), "fp")).alias("x")).select("x.k", "x.fp")
    return kept.unionAll(_keeper_rows(docs, key, text, prints, keepers.join(repeated, F.col("k").eqNullSafe(F.col("_r")), "left_semi")))


def _keeper_rows(docs: DataFrame, key, text: str, prints, keepers: DataFrame) -> DataFrame:
    """The rows that keepers (k, fp) name, one for each."""
    names = iter(f"_{x}{'_' * len(max(docs.columns, key=len))}" for x in ("k", "fp", "h"))  # longer than any column's name
    k, fp, h = names
    ids = keepers.select(F.col("k").alias(k)).distinct()
    clash = docs.withColumn(k, key).join(ids.withColumnRenamed(k, "_r"), F.col(k).eqNullSafe(F.col("_r")), "left_semi").dropDuplicates()

    def make():
        def work(piece: pa.RecordBatch) -> pa.RecordBatch:
            return piece.append_column(fp, pa.array(prints(texts_of(piece, text))))

        return work

    schema = T.StructType([*clash.schema.fields, T.StructField(fp, T.LongType())])
    marked = map_slices(clash, make, schema, text).withColumn(h, F.xxhash64(*docs.columns))
    first = marked.groupBy(k, fp).agg(F.min(h).alias(h))
    wanted = keepers.select(F.col("k").alias(k), F.col("fp").alias(fp)).join(
        first.select(F.col(k).alias("_r"), F.col(fp).alias("_f"), F.col(h).alias("_h")),
        F.col(k).eqNullSafe(F.col("_r")) & (F.col(fp) == F.col("_f"))).select("_r", "_f", "_h")
    return marked.join(wanted, marked[k].eqNullSafe(wanted["_r"]) & (marked[fp] == wanted["_f"]) & (marked[h] == wanted["_h"]),
                       "left_semi").select(*docs.columns)
