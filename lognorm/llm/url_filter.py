"""URL filters: allow and block rules and host lists, answered by Bloom filter cascades.

Keys are rule strings (host suffix plus path prefix) and listed hosts. The universe of a corpus
is every key that one of its urls could hit: few next to the urls, found by a distinct that
aggregates before it shuffles. A cascade encodes a set of keys exactly over that universe:
level 0 holds the listed keys, level 1 the others that level 0 lets through, level 2 the
listed ones that level 1 lets through, and so on until a level lets none through. Membership is
the parity of the first level that says no, so urls need no join and nothing is approximate.

Filters are bit sets that tasks build by partial ``bit_or``; only the bits reach the driver,
about 10 for each listed key. A cascade over ``SHARD_KEYS`` listed keys is cut into shards by
key hash, and urls pass them one after another, so no broadcast exceeds about 10 MB.

A url's host lies between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, with A-Z
lower-cased; its path runs on to ``?``, ``#`` or the end. A null url, or one without ``://``, has
an empty host and path, fits no rule and is allowed. Of fitting rules the longest wins, of
equally long ones that with the longer host; a key in both lists is blocked. A listed host
covers its subdomains. Repeated urls are judged each; empty tables give empty results.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lognorm.llm.common import column_of, saved

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Share of foreign keys that one level lets through, and its cost.
FALSE_POSITIVES = 0.01
BITS_PER_KEY, PROBES = 9.6, 7
SHARD_KEYS = 8_000_000
LEAST_BITS = 64
MOST_LEVELS = 64

Rule = tuple[str, str, str]  # allow or block, host, path
RULES: list[Rule] = [
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"),
]
#: A host with one of these as a part of a label is on the block list of the registered query.
LISTED_PARTS = ("adult", "bets", "casino", "gambling", "porn")


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1), "^[^?#]*", 0)


def _after_scheme(url: Column) -> Column:
    text = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(text, "://")
    return F.when(at > 0, F.substr(text, at + 3)).otherwise(F.lit(""))


def suffixes(host: Column) -> Column:
    """The host and its parent domains, longest first; an empty host has none."""
    labels = F.split(host, "[.]")
    each = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(each)


def rule_keys(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Every rule string that could fit: host suffixes and path prefixes of the lengths that rules have."""
    shapes = sorted({(h.count(".") + 1, len(p)) for _, h, p in rules}, reverse=True)
    labels = F.split(host, "[.]")
    keys = []
    for n, length in shapes:
        suffix = F.array_join(F.slice(labels, F.size(labels) - n + 1, F.lit(n)), ".")
        fits = (host != "") & (F.size(labels) >= n) & (F.length(path) >= length)
        keys.append(F.when(fits, F.concat(suffix, F.substring(path, 1, length)) if length else suffix))
    ordered = F.array_sort(F.transform(F.array_compact(F.array(*keys)), lambda k: F.struct(
        (-F.length(k)).alias("n"), (-F.length(F.substring_index(k, "/", 1))).alias("h"), k.alias("k"))))
    return F.transform(ordered, lambda x: x["k"]) if keys else F.array().cast("array<string>")


@dataclass
class Level:
    bits: int
    words: np.ndarray


def _positions(h1: np.ndarray, h2: np.ndarray, level: int, bits: int, probe: int) -> np.ndarray:
    """The same arithmetic as ``_position``, on unsigned 64-bit numbers."""
    x = h1 + np.uint64(probe) * (h2 | np.uint64(1)) + np.uint64(level * 0x9E3779B97F4A7C15 % (1 << 64)) * h2
    x = x ^ (x >> np.uint64(31))
    return (x & np.uint64((1 << 62) - 1)) % np.uint64(bits)


def _bit_words(h1: np.ndarray, h2: np.ndarray, level: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(word, bits set in it) of a batch of keys."""
    at = np.unique(np.concatenate([_positions(h1, h2, level, bits, p) for p in range(PROBES)]))
    words, start = np.unique(at >> np.uint64(6), return_index=True)
    return words, np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), start) if len(at) else at


def contains(level: Level, number: int, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    out = np.ones(len(h1), dtype=bool)
    for p in range(PROBES):
        at = _positions(h1, h2, number, level.bits, p)
        out &= (level.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
    return out


def member(levels: list[Level], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Exact for keys of the universe: the first level that says no is odd."""
    out = np.full(len(h1), len(levels) % 2 == 1)
    open_ = np.ones(len(h1), dtype=bool)
    for k, level in enumerate(levels):
        no = open_ & ~contains(level, k, h1, h2)
        out[no] = k % 2 == 1
        open_ &= ~no
    return out


def _unsigned(array: pa.Array) -> np.ndarray:
    return array.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def build_level(keys: DataFrame, number: int, count: int) -> Level:
    """The filter of all (h1, h2) keys; tasks send words of bits, and ``bit_or`` joins them."""
    bits = max(LEAST_BITS, math.ceil(count * BITS_PER_KEY))

    def run(batches):
        for b in batches:
            words, set_ = _bit_words(_unsigned(column_of(b, "h1")), _unsigned(column_of(b, "h2")), number, bits)
            yield pa.RecordBatch.from_arrays([pa.array(words.astype(np.int64)), pa.array(set_.view(np.int64))], ["word", "set"])

    found = keys.select("h1", "h2").mapInArrow(run, "word long, set long").groupBy("word").agg(F.bit_or("set").alias("set"))
    words = np.zeros(bits // 64 + 1, dtype=np.int64)
    for row in found.collect():  # at most bits / 64 rows
        words[row["word"]] = row["set"]
    return Level(bits, words.view(np.uint64))


def _passing(keys: DataFrame, level: Level, number: int) -> DataFrame:
    shared = keys.sparkSession.sparkContext.broadcast(level)

    def run(batches):
        for b in batches:
            yes = contains(shared.value, number, _unsigned(column_of(b, "h1")), _unsigned(column_of(b, "h2")))
            yield b.filter(pa.array(yes))

    return keys.mapInArrow(run, keys.schema)


def hashes(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(key), F.xxhash64(key, F.lit(1))


def build_cascade(universe: DataFrame, listed: Column | str = "listed") -> list[Level]:
    """Levels for the (h1, h2) keys of a universe whose ``listed`` is true."""
    keys = universe.select("h1", "h2", F.expr(listed).alias("listed") if isinstance(listed, str) else listed.alias("listed"))
    holds, others = keys.where("listed"), keys.where("NOT listed")
    levels: list[Level] = []
    for number in range(MOST_LEVELS):
        count = holds.count()
        if count == 0:
            return levels
        levels.append(build_level(holds, number, count))
        holds, others = saved(_passing(others, levels[-1], number)), holds
    raise RuntimeError("two keys share their hashes")


def build_cascades(universe: DataFrame, listed: str) -> list[list[Level]]:
    """One cascade a shard of at most about SHARD_KEYS listed keys, chosen by the key's hash."""
    shards = max(1, math.ceil(universe.where(listed).count() / SHARD_KEYS))
    return [build_cascade(universe.where(F.pmod("h2", F.lit(shards)) == s) if shards > 1 else universe, listed) for s in range(shards)]


def with_membership(rows: DataFrame, keys: str, cascades: list[list[Level]], out: str) -> DataFrame:
    """``rows`` with ``out``: for each key of the array ``keys`` whether it is listed. No join."""
    spark = rows.sparkSession
    h1, h2 = F.transform(keys, lambda k: hashes(k)[0]), F.transform(keys, lambda k: hashes(k)[1])
    rows = rows.withColumn("_h1", h1).withColumn("_h2", h2).withColumn(out, F.transform(keys, lambda _: F.lit(False)))
    for s, levels in enumerate(cascades):
        shared = spark.sparkContext.broadcast(levels)
        rows = _probe(rows, shared, s, len(cascades), out)
        if len(cascades) > 1:
            rows = saved(rows)  # one shard's filters in memory at a time
    return rows.drop("_h1", "_h2")


def _probe(rows: DataFrame, shared: Broadcast, shard: int, shards: int, out: str) -> DataFrame:
    def run(batches):
        for b in batches:
            one, two, was = column_of(b, "_h1"), column_of(b, "_h2"), column_of(b, out)
            h1, h2 = _unsigned(one.flatten()), _unsigned(two.flatten())
            yes = member(shared.value, h1, h2)
            if shards > 1:
                yes &= np.mod(h2.view(np.int64), shards) == shard
            yes |= was.flatten().to_numpy(zero_copy_only=False).astype(bool)
            offsets = np.concatenate([[0], np.cumsum(one.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int32)
            new = pa.ListArray.from_arrays(pa.array(offsets), pa.array(yes))
            at = b.schema.get_field_index(out)
            yield pa.RecordBatch.from_arrays([new if i == at else c for i, c in enumerate(b.columns)], b.schema.names)

    return rows.mapInArrow(run, rows.schema)


def judge(
    pages: DataFrame, listed_hosts: DataFrame, rules: list[Rule] = RULES, page_id: str = "page_id", url: str = "url",
) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every url. ``listed_hosts`` has one column, hosts to block."""
    spark: SparkSession = pages.sparkSession
    parts = pages.select(F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    # "/" ends the host in every rule's string; a listed host is marked apart from a rule without a path.
    parts = parts.withColumn("rules", rule_keys(F.col("host"), F.col("path"), rules)).withColumn(
        "keys", F.concat("rules", F.transform(suffixes(F.col("host")), lambda s: F.concat(F.lit("host:"), s))))
    named = spark.createDataFrame([(k == "block", h + p) for k, h, p in rules], "block boolean, key string")
    listed = named.unionAll(listed_hosts.select(F.lit(True), F.concat(F.lit("host:"), F.translate(
        listed_hosts[listed_hosts.columns[0]].cast("string"), UPPER, LOWER))).where(F.col(listed_hosts.columns[0]).isNotNull()))
    kinds = listed.groupBy("key").agg(F.max("block").alias("block"))
    keys = parts.select(F.explode("keys").alias("key")).distinct()
    one, two = hashes(F.col("key"))
    universe = saved(keys.join(kinds, "key", "left").select(
        one.alias("h1"), two.alias("h2"), F.coalesce("block", F.lit(False)).alias("block"),
        F.coalesce(~F.col("block"), F.lit(False)).alias("allow")))
    marked = with_membership(parts, "keys", build_cascades(universe, "block"), "blocked")
    marked = with_membership(marked, "keys", build_cascades(universe, "allow"), "allowed")
    both = F.arrays_zip("keys", "blocked", "allowed")
    hit = F.get(F.filter(F.slice(both, 1, F.size("rules")), lambda x: x["blocked"] | x["allowed"]), F.lit(0))
    any_host = F.exists(F.slice(both, F.size("rules") + 1, F.size("keys")), lambda x: x["blocked"])
    return marked.withColumn("hit", hit).select(
        "page_id", "host", "path", F.col("hit.keys").alias("rule"),
        F.when(F.when(F.col("hit").isNull(), any_host).otherwise(F.col("hit.blocked")), "block").otherwise("allow").alias("verdict"))


def hosts_with_parts(pages: DataFrame, parts: tuple[str, ...] = LISTED_PARTS, url: str = "url") -> DataFrame:
    """The corpus's hosts with a label that has one of the parts between its hyphens."""
    hosts = pages.select(host_of(F.col(url)).alias("host")).distinct()
    return hosts.where(F.arrays_overlap(F.split("host", "[.-]"), F.array(*map(F.lit, parts))))
