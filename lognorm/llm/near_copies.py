"""Near copies by SimHash, completed by exact similarity: Jaccard of the sets of word shingles at a threshold or more.

Every pair is found. A global order sorts the sets. Of two sets of Jaccard 0.8 or more the larger
holds the first shingle they share among its first n - ceil(0.8 n) + 1, the smaller even among its
first n - ceil(8/9 n) + 1, because the overlap is at least 8/9 of the smaller set. Only documents
that meet so are compared: documents that share a text of nearly nine tenths do, those that share
less meet by their own shingles alone. The order is by hash, but shingles that a sample shows in
many documents come last; the sample changes the work, never the result. Shingles shared within
the two prefixes, and what is left of the set whose prefix ends first, bound the overlap; so does a
sketch of each set: ``SKETCH`` bits, each the parity of the shingles that fall on it. Two sketches differ
in no more bits than shingles are in one set alone. Pairs whose bound is too low need no check. A check
reads the texts of the documents concerned again, and counts the shingles two sets share.

Documents are first grouped by a hash of their set, so copies cost one row. SimHash comes first:
fingerprints of the sets that covering masks find within ``simhash.RADIUS`` bits are checked, and
those that are near copies are joined. It misses near copies whose fingerprints differ in more bits;
the exact completion finds them all, and compares only what SimHash has not joined. For every shingle
and class of sizes the smallest member is the hub of the others; documents are checked against the
hubs of their shingles, and once more against members of the shingles' commonest components. Then only
pairs whose components still differ are compared: of a shingle's documents, those outside its
commonest component with all of it, by size and sketch at once, so that what is far apart makes no row.
A family of n copies thus costs about n checks a shingle.

Words and shingles are those of ``simhash``, but five words long. Sets are told apart by 64-bit
hashes (XXH64). A text without words (or null) has the empty set, equal to no other. Repeated rows
of one doc_id, with equal or other texts, and null doc_ids give a row each. Ties go to the smaller
doc_id. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lognorm.llm.common import column_of, map_slices, saved, text_or_empty, texts_of
from lognorm.llm.components import components
from lognorm.llm.simhash import SEED, fingerprint, one_of_each, shingle_hashes
from lognorm.llm.simhash import links as simhash_links

SHINGLE_WORDS = 5
#: Jaccard as a fraction.
UP, DOWN = 4, 5
#: Text of one slice: a worker's memory is a multiple of it.
SLICE = 1 << 20
#: One document of so many is counted to find common shingles; seen so often there one is common.
SAMPLE, COMMON = 32, 4
#: Common shingles that go to every task; beyond that the threshold rises.
MOST_COMMON = 200_000
#: So many documents are broadcast to pick the texts to check; for more the texts are shuffled.
FEW = 500_000
#: Bits of a set's sketch, a power of two; sets of up to about twice as many shingles are told apart.
SKETCH = 512
#: Sizes of one class differ by less than this factor, so that any two may be near copies.
CLASS = DOWN / UP


def shingle_set(text: bytes) -> np.ndarray:
    hashes = np.sort(shingle_hashes(text, SHINGLE_WORDS))
    return hashes[np.diff(hashes, prepend=~hashes[:1]) != 0]


def key_of(shingles: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(shingles.tobytes(), SEED)


def keys_of(texts: list[bytes]) -> np.ndarray:
    return np.array([key_of(shingle_set(t)) for t in texts], dtype=np.uint64).view(np.int64)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """``SKETCH`` bits as longs: of how many shingles each is the last bits' number, odd or even."""
    counts = np.bincount((shingles & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH)
    return np.packbits(counts & 1, bitorder="little").view(np.int64)


def among(shingles: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Which shingles are in the sorted ``common``, by binary search: ``np.isin`` sorts all of ``common`` at each call."""
    at = np.searchsorted(common, shingles)
    at[at == len(common)] = 0
    return common[at] == shingles


def ordered_prefix(shingles: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, int, int]:
    """The first n - ceil(n UP / DOWN) + 1 shingles, the sorted ``common`` ones last; how many a smaller set shows; how many shingles are rare."""
    n = len(shingles)
    rare = n
    if len(common):
        last = among(shingles, common)
        shingles, rare = np.concatenate([shingles[~last], shingles[last]]), n - int(last.sum())
    size = n + (-n * UP) // DOWN + 1 if n else 0
    inner = n + (-n * 2 * UP) // (UP + DOWN) + 1 if n else 0
    return shingles[:size], inner, rare


def _prefixes(source: DataFrame, common: np.ndarray) -> DataFrame:
    """(doc_id, key, n, rare, inner, tokens, fp, sketch) of every row; ``source`` has doc_id and text, fp is the set's SimHash."""

    def make():
        def work(piece: pa.RecordBatch) -> pa.RecordBatch:
            sets = [shingle_set(t) for t in texts_of(piece)]
            keys = np.array([key_of(s) for s in sets], dtype=np.uint64).view(np.int64)
            heads = [ordered_prefix(s, common) for s in sets]
            # shifted, so that signed numbers have the order of the hashes
            tokens = pa.array([(h ^ np.uint64(1 << 63)).view(np.int64) for h, _, _ in heads], pa.list_(pa.int64()))
            number = lambda values: pa.array(list(values), pa.int32())
            return pa.RecordBatch.from_arrays(
                [column_of(piece, "doc_id"), pa.array(keys), number(map(len, sets)), number(r for _, _, r in heads),
                 number(i for _, i, _ in heads), tokens, pa.array(np.array([fingerprint(s) for s in sets], dtype=np.uint64).view(np.int64)),
                 pa.array([sketch(s) for s in sets], pa.list_(pa.int64()))],
                ["doc_id", "key", "n", "rare", "inner", "tokens", "fp", "sketch"])

        return work

    return map_slices(source, make, "doc_id long, key long, n int, rare int, inner int, tokens array<long>, fp long, sketch array<long>", limit=SLICE)


def common_shingles(source: DataFrame) -> np.ndarray:
    """Shingles of many sampled texts; which documents are sampled follows from their text."""

    def make():
        def work(piece: pa.RecordBatch) -> pa.RecordBatch:
            sets = [shingle_set(t) for t in texts_of(piece)]
            # copies count once
            keys = pa.array(np.repeat(np.array([key_of(s) for s in sets], dtype=np.uint64), [len(s) for s in sets]).view(np.int64))
            return pa.RecordBatch.from_arrays([keys, pa.array(np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64))], ["key", "token"])

        return work

    sampled = source.where(F.pmod(F.xxhash64("text"), F.lit(SAMPLE)) == 0).select("text")
    counted = saved(map_slices(sampled, make, "key long, token long", limit=SLICE).distinct().groupBy("token").count().where(f"count >= {COMMON}"))
    steps = counted.groupBy(F.floor(F.log2("count")).alias("step")).count().orderBy(F.desc("step")).collect()
    total, least = 0, None
    for row in steps:
        total += row["count"]
        if total > MOST_COMMON:
            break
        least = row["step"]
    if least is None:
        return np.zeros(0, dtype=np.uint64)
    rows = counted.where(F.floor(F.log2("count")) >= least).select("token").collect()
    return np.sort(np.array([r["token"] for r in rows], dtype=np.int64).view(np.uint64))


def _alike(x: str, y: str, n: str, m: str) -> str:
    """Whether sets of n and m shingles with sketches x and y can be near copies: a near copy has few shingles the other lacks."""
    bits = " + ".join(f"bit_count({x}[{i}] ^ {y}[{i}])" for i in range(SKETCH // 64))
    return f"({bits}) * {UP + DOWN} <= ({n} + {m}) * {DOWN - UP}"


def _possible(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, c) of ``pairs``, a row for each shared shingle of a's prefix and b's inner prefix: those
    whose sets can overlap enough; ``c`` counts the rows. Sets: (key, n, rare, inner, size, last, inner_last, sketch)."""
    counted = pairs.groupBy("a", "b").agg(F.count("*").alias("c"))
    x, y = sets.select([F.col(c).alias(f"x_{c}") for c in sets.columns]), sets.select([F.col(c).alias(f"y_{c}") for c in sets.columns])
    both = counted.join(x, F.col("a") == F.col("x_key")).join(y, F.col("b") == F.col("y_key"))
    # what ends first in the order: a common shingle comes after a rare one
    y_first = "struct(y_inner > y_rare, y_inner_last) <= struct(x_size > x_rare, x_last)"
    left = f"IF({y_first}, y_n - y_inner, x_n - x_size)"
    return both.where(f"(c + {left}) * {UP + DOWN} >= (x_n + y_n) * {UP} AND {_alike('x_sketch', 'y_sketch', 'x_n', 'y_n')}").select("a", "b", "c")


def _sets_of(keys: DataFrame, prefixes: DataFrame, source: DataFrame) -> DataFrame:
    """(key, shingles) of the keys, from the texts of one document each."""
    heads = prefixes.join(keys, "key", "left_semi").groupBy("key").agg(F.min("doc_id").alias("doc_id"))
    wanted = saved(heads)
    ids = wanted.select("doc_id").distinct()
    if wanted.count() <= FEW:
        wanted, ids = F.broadcast(wanted), F.broadcast(ids)
    texts = source.alias("t").join(ids.alias("i"), F.expr("t.doc_id <=> i.doc_id"), "left_semi").select("text")

    def make():
        def work(piece: pa.RecordBatch) -> pa.RecordBatch:
            sets = [shingle_set(t) for t in texts_of(piece)]
            keys = np.array([key_of(s) for s in sets], dtype=np.uint64).view(np.int64)
            offsets = np.cumsum([0, *map(len, sets)])
            values = np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))], ["key", "shingles"])

        return work

    # documents with the same doc_id but other texts have other keys
    return saved(map_slices(texts, make, "key long, shingles array<long>", limit=SLICE).join(wanted.select("key"), "key", "left_semi")).dropDuplicates(["key"])


def _checked(pairs: DataFrame, prefixes: DataFrame, source: DataFrame) -> DataFrame:
    """The (a, b) pairs of keys whose sets are near copies."""
    pairs = saved(pairs.select("a", "b"))
    keys = pairs.select(F.col("a").alias("key")).unionAll(pairs.select(F.col("b").alias("key"))).distinct()
    sets = _sets_of(keys, prefixes, source)
    both = pairs.join(sets.select(F.col("key").alias("a"), F.col("shingles").alias("p")), "a").join(
        sets.select(F.col("key").alias("b"), F.col("shingles").alias("q")), "b")
    shared = both.select("a", "b", F.size(F.array_intersect("p", "q")).alias("shared"), (F.size("p") + F.size("q")).alias("both"))
    return saved(shared.where(f"shared * {DOWN} >= (both - shared) * {UP}").select("a", "b"))


def _by_simhash(prints: DataFrame) -> DataFrame:
    """(a, b) keys whose SimHash fingerprints link by covering masks; of keys with one print each with the smallest."""
    heads = saved(prints.groupBy("fp").agg(F.min("key").alias("key")))
    same = prints.join(heads.withColumnRenamed("key", "b"), "fp").where("key <> b").select(F.col("key").alias("a"), "b")
    of = lambda name: heads.select(F.col("fp").alias(f"_{name}"), F.col("key").alias(name))
    linked = simhash_links(heads.select("fp")).toDF("_a", "_b").join(of("a"), "_a").join(of("b"), "_b").select("a", "b")
    return same.unionAll(linked)


def _apart(pairs: DataFrame, near: DataFrame) -> DataFrame:
    """The (a, b) pairs that ``near`` does not join yet."""
    roots = components(near)
    of = lambda name: roots.select(F.col("node").alias(name), F.col("root").alias(f"_{name}"))
    met = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
    return met.where("coalesce(_a, a) <> coalesce(_b, b)").select("a", "b")


def _mixed(members: DataFrame, near: DataFrame) -> DataFrame:
    """``members`` of shingles that several components share, with ``root`` and the shingle's commonest, ``main``."""
    roots = components(near).withColumnRenamed("node", "key")
    rooted = saved(members.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key")))
    sizes = rooted.groupBy("token", "root").agg(F.count("*").alias("m")).groupBy("token").agg(
        F.max(F.struct("m", "root")).alias("most"), F.count("*").alias("roots")).where("roots > 1").select("token", F.col("most.root").alias("main"))
    return saved(rooted.join(sizes, "token"))


def links(prefixes: DataFrame, source: DataFrame) -> DataFrame:
    """(a, b) near copies that join every component; ``prefixes`` as of ``_prefixes``."""
    one = prefixes.where("n > 0").dropDuplicates(["key"])
    tokens = one.select("key", "n", "inner", F.posexplode("tokens").alias("at", "token")).select(
        "token", "key", "n", F.expr("at < inner").alias("inside"))
    # a shingle without a member inside, or with one member, is no use
    shared = tokens.groupBy("token").agg(F.count("*").alias("m"), F.max("inside").alias("inside")).where("m > 1 AND inside").select("token")
    members = saved(tokens.join(shared, "token", "left_semi"))
    sets = saved(one.select("key", "n", "rare", "inner", F.size("tokens").alias("size"), F.element_at("tokens", -1).alias("last"),
                            F.expr("element_at(tokens, inner)").alias("inner_last"), "sketch").join(members.select("key").distinct(), "key", "left_semi"))

    members = members.withColumn("step", F.floor(F.log("n") / F.log(F.lit(CLASS))))
    hubs = members.where("inside").groupBy("token", "step").agg(F.min(F.struct("n", "key")).alias("hub"))
    first = members.join(hubs, ["token", "step"]).where("struct(n, key) > hub").select(F.col("key").alias("a"), F.col("hub.key").alias("b"))
    alike = _checked(_by_simhash(saved(one.select("key", "fp"))), prefixes, source)
    near = saved(alike.unionAll(_checked(_possible(_apart(first, alike), sets), prefixes, source)))
    mixed = _mixed(members, near)
    # Those left over meet another member of the commonest component for each of their shingles.
    hubs = mixed.where("inside AND root = main").groupBy("token", "step").agg(F.min(F.struct(F.xxhash64("key").alias("h"), "n", "key")).alias("hub"))
    again = mixed.where("root <> main").join(hubs, ["token", "step"])
    larger = F.expr("struct(n, key) > struct(hub.n, hub.key)")
    again = again.where(larger | F.col("inside")).select(
        F.when(larger, F.col("key")).otherwise(F.col("hub.key")).alias("a"), F.when(larger, F.col("hub.key")).otherwise(F.col("key")).alias("b"))
    near = saved(near.unionAll(_checked(_possible(again, sets), prefixes, source)))
    mixed = saved(_mixed(members, near).join(sets.select("key", "sketch"), "key"))
    other = mixed.select("token", F.col("key").alias("k"), F.col("n").alias("m"), F.col("inside").alias("within"), F.col("root").alias("r"),
                         (F.col("root") != F.col("main")).alias("minor"), F.col("sketch").alias("bits"))
    ahead = "struct(m, k) < struct(n, key)"  # the other one is the smaller set
    pairs = mixed.where("root <> main").join(other, "token").where(
        f"root <> r AND least(n, m) * {DOWN} >= greatest(n, m) * {UP} AND IF({ahead}, within, inside) AND (NOT minor OR key < k) AND {_alike('sketch', 'bits', 'n', 'm')}")
    larger = F.expr(ahead)
    crossing = pairs.select(F.when(larger, F.col("key")).otherwise(F.col("k")).alias("a"), F.when(larger, F.col("k")).otherwise(F.col("key")).alias("b"))
    return near.unionAll(_checked(_possible(crossing, sets), prefixes, source))


def near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp: hash of the set, root, component_id) of every row, as ``simhash.near_duplicates``."""
    source = text_or_empty(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")))
    prefixes = saved(_prefixes(source, common_shingles(source)))
    heads = saved(prefixes.groupBy("key").agg(F.min("doc_id").alias("head")))
    roots = components(links(prefixes, source))
    rooted = saved(heads.join(roots.withColumnRenamed("node", "key"), "key", "left").select("key", "head", F.coalesce("root", "key").alias("root")))
    least = rooted.groupBy("root").agg(F.min("head").alias("component_id"))
    return prefixes.select("doc_id", "key").join(rooted.join(least, "root").select("key", "root", "component_id"), "key").select(
        "doc_id", F.col("key").alias("fp"), "root", "component_id")


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component of near copies stays, chosen as by ``simhash.deduplicated``."""
    return one_of_each(docs, saved(near_copies(docs, doc_id, text)), keys_of, doc_id, text)
