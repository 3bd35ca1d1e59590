"""Approximate nearest neighbours by stable projections, a kd-tree and a chi-square stopping test.

Unit vectors are projected on ``PROJECTED`` Gaussian directions. Their squared projected
distance, over the true one, is chi-square with that many degrees of freedom; so once the next
projected distance r and the k-th true distance found so far d have F(r^2 / d^2) >= CONFIDENCE, a
nearer vector is still unseen with probability 1 - CONFIDENCE at most, and the search stops.

The kd-tree over the projections is fitted on a bounded sample (about ``SAMPLE`` rows, by hash of the vector);
every row is then indexed in one of its cells, whose number follows the rows up to ``CELLS``;
a cell of more than ``BLOCK`` rows is cut into blocks. A query first meets its own cell, in order
of projected distance, until the test holds. The bound it found then goes to the cells whose
box the test does not exclude, and to no others; the results are merged. Only cell boxes and
split planes reach the driver (at most ``CELLS`` of each).

Nearness is the cosine, in double precision, ties to the smaller id. Vectors that are null, zero
or hold null or non-finite components take no part. A cosine needs two vectors of one length: each
length has cells of its own, and a query meets the vectors of its length. Every row is a candidate
of every other row, those with the same vec_id and a null vec_id (last in ties) included; a query
that stands in several rows is asked once for each. Equal vectors are indexed k + 1 times at most,
with the smallest ids, which no answer can miss. An empty table, or one without queries, gives no
rows; a lone vector finds none.

A block and the queries sent to it meet in one task. Where more than ``QUERY_BLOCK`` queries come to
a block, they are dealt to several copies of it; other blocks are not copied.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lognorm.llm.common import column_of, saved

PROJECTED = 8
CONFIDENCE = 0.99
SAMPLE = 100_000
CELL_ROWS, CELLS = 512, 32_768
#: A cell's number is its vectors' length times this and its place in the tree.
LENGTH = 1 << 24
BLOCK = 16_384
QUERY_BLOCK = 20_000
BATCH = 64
#: Stands for a null vec_id within the search, where it is the largest.
NO_ID = (1 << 63) - 1
P = [f"p{i}" for i in range(PROJECTED)]


def chi_square_cdf(x: float, degrees: int) -> float:
    """For an even number of degrees."""
    term = total = math.exp(-x / 2)
    for i in range(1, degrees // 2):
        term *= x / 2 / i
        total += term
    return 1 - total


def chi_square_quantile(p: float, degrees: int) -> float:
    low, high = 0.0, 1.0
    while chi_square_cdf(high, degrees) < p:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_cdf(middle, degrees) < p else (low, middle)
    return high


#: The search stops where r^2 exceeds this many times d^2.
STOP = chi_square_quantile(CONFIDENCE, PROJECTED)


def directions(length: int) -> np.ndarray:
    return np.random.default_rng(20140901).normal(size=(length, PROJECTED))


def projected(vectors: np.ndarray) -> np.ndarray:
    norms = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    return (vectors / norms) @ directions(vectors.shape[1])


@dataclass
class Cells:
    """A kd-tree by levels: node i of a level splits at ``planes``; leaves are cells."""

    planes: list[tuple[np.ndarray, np.ndarray]]  # per level: dimension and bound of each node

    @staticmethod
    def fit(points: np.ndarray, cells: int) -> Cells:
        depth = max(0, math.ceil(math.log2(max(1, cells))))
        planes, members = [], [np.arange(len(points))]
        for _ in range(depth):
            dims, bounds, below = [], [], []
            for rows in members:
                own = points[rows]
                d = int(np.argmax(own.max(axis=0) - own.min(axis=0))) if len(rows) else 0
                b = float(np.median(own[:, d])) if len(rows) else 0.0
                dims.append(d)
                bounds.append(b)
                low = own[:, d] <= b if len(rows) else np.zeros(0, bool)
                below += [rows[low], rows[~low]]
            planes.append((np.array(dims), np.array(bounds)))
            members = below
        return Cells(planes)

    def of(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), dtype=np.int64)
        at = np.arange(len(points))
        for dims, bounds in self.planes:
            node = 2 * node + (points[at, dims[node]] > bounds[node])
        return node


def valid(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(row, vec_id, embedding array<double>) of the vectors that take part; ``row`` tells rows apart."""
    e = F.col(embedding).cast("array<double>")
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    rows = vectors.select(F.monotonically_increasing_id().alias("row"), F.coalesce(F.col(vec_id).cast("long"), F.lit(NO_ID)).alias("vec_id"), e.alias("embedding"))
    return rows.where("embedding IS NOT NULL").where(fine & some)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _placed(rows: DataFrame, cells: Cells | None) -> DataFrame:
    """(row, vec_id, vec: the doubles as bytes, p0.., cell)."""
    shared = rows.sparkSession.sparkContext.broadcast(cells)

    def run(batches):
        for whole in batches:
            lengths = column_of(whole, "embedding").value_lengths().to_numpy()
            for n in np.unique(lengths):
                b = whole.filter(pa.array(lengths == n))
                v = _matrix(column_of(b, "embedding"))
                p = projected(v)
                cell = n * LENGTH + (shared.value.of(p) if shared.value else np.zeros(len(p), np.int64))
                packed = pa.array([x.tobytes() for x in v], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [column_of(b, "row"), column_of(b, "vec_id"), packed, *[pa.array(np.ascontiguousarray(c)) for c in p.T], pa.array(cell)],
                    ["row", "vec_id", "vec", *P, "cell"])

    return rows.mapInArrow(run, "row long, vec_id long, vec binary, " + ", ".join(f"{p} double" for p in P) + ", cell long")


def _unpack(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    v = np.frombuffer(b"".join(frame["vec"]), dtype=np.float64).reshape(len(frame), -1)
    return v, np.sqrt((v * v).sum(axis=1)), frame[P].to_numpy()


def search_block(index: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """The best k of a block for each query; ``bound`` is the squared distance found elsewhere."""
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    if len(index) and len(queries):
        v, norm, p = _unpack(index)
        rows = index["row"].to_numpy()
        ids = index["vec_id"].to_numpy()
        qv, qnorm, qp = _unpack(queries)
        for q, own in enumerate(queries["query"].to_numpy()):
            far = ((p - qp[q]) ** 2).sum(axis=1)
            bound = float(queries["bound"].iat[q])
            order = np.flatnonzero((far <= STOP * bound) & (rows != own))
            order = order[np.argsort(far[order], kind="stable")]
            best_id, best = np.zeros(0, np.int64), np.zeros(0)
            for start in range(0, len(order), BATCH):
                if far[order[start]] > STOP * bound:
                    break
                some = order[start:start + BATCH]
                # Row by row in one order of summation, so equal vectors have equal scores.
                score = (v[some] * qv[q]).sum(axis=1) / (norm[some] * qnorm[q])
                best_id, best = np.concatenate([best_id, ids[some]]), np.concatenate([best, score])
                keep = np.lexsort((best_id, -best))[:k]
                best_id, best = best_id[keep], best[keep]
                if len(best) == k:
                    # Equal vectors have projected distance 0: a bound of 0 still lets all of them in.
                    bound = min(bound, max(2 - 2 * float(best[-1]), 1e-12))
            out.append((np.full(len(best), own), best_id, best))
    joined = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
    return pd.DataFrame({"query": joined[0].astype("int64"), "vec_id": joined[1].astype("int64"), "score": joined[2].astype("float64")})


def _searched(index: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``queries`` (query, bound, vec, p.., cell) against all blocks of the cells they name.

    Cells that get many queries are copied; how many copies each needs is counted first."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return search_block(left, right, k)

    queries = saved(queries)
    parts = queries.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(QUERY_BLOCK)).cast("int").alias("parts"))
    parts = F.broadcast(saved(parts))  # a row for each cell at most
    copies = index.join(parts, "cell").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts", "blocks")
    blocks = F.broadcast(saved(index.select("cell", "blocks").distinct()))
    sent = queries.join(parts, "cell").withColumn("part", F.pmod(F.xxhash64("query"), "parts").cast("int")).drop("parts").join(
        blocks, "cell").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    keys = ["cell", "block", "part"]
    return copies.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInPandas(run, "query long, vec_id long, score double")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(
    vectors: DataFrame, is_query: Column | str, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest; ``is_query`` is a condition on vec_id."""
    spark = vectors.sparkSession
    rows = saved(valid(vectors, vec_id, embedding))
    copies = Window.partitionBy("embedding").orderBy("vec_id", "row")
    kept = rows.withColumn("_n", F.row_number().over(copies)).where(F.col("_n") <= k + 1).drop("_n")
    total = rows.count()
    # About SAMPLE rows by hash, without a sort; equal vectors are all in it or none.
    share = min(2**40, math.ceil(2**40 * SAMPLE / max(total, 1)))
    first = kept.where(F.pmod(F.xxhash64("embedding"), F.lit(2**40)) < share)
    points = np.array([[r[p] for p in P] for r in _placed(first, None).select(*P).collect()]).reshape(-1, PROJECTED)
    cells = Cells.fit(points, min(CELLS, math.ceil(total / CELL_ROWS)))
    placed = saved(_placed(kept, cells))
    boxes = placed.groupBy("cell").agg(
        F.count("*").alias("n"), *[F.min(p).alias(f"low_{p}") for p in P], *[F.max(p).alias(f"high_{p}") for p in P]).collect()
    of_cell = spark.createDataFrame([(int(r["cell"]), math.ceil(r["n"] / BLOCK)) for r in boxes], "cell long, blocks int")
    index = saved(placed.join(F.broadcast(of_cell), "cell").withColumn("block", F.pmod(F.xxhash64("row"), "blocks").cast("int")))

    shared = spark.sparkContext.broadcast((
        np.array([r["cell"] for r in boxes], dtype=np.int64), np.array([[r[f"low_{p}"] for p in P] for r in boxes]).reshape(-1, PROJECTED),
        np.array([[r[f"high_{p}"] for p in P] for r in boxes]).reshape(-1, PROJECTED)))
    asked = saved(_placed(rows.where(F.col("vec_id") != NO_ID).where(is_query), cells).withColumnRenamed("row", "query"))
    names = asked.select("query", F.col("vec_id").alias("query_id"))
    queries = asked.drop("vec_id")

    near = saved(_best(_searched(index, queries.withColumn("bound", F.lit(float("inf"))), k), k))
    bound = near.groupBy("query").agg(F.max("rank").alias("n"), F.min("score").alias("score")).select(
        "query", F.when(F.col("n") == k, F.greatest(2 - 2 * F.col("score"), F.lit(1e-12))).alias("bound"))
    open_ = queries.join(bound, "query", "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))

    def route(batches):
        number, low, high = shared.value
        for b in batches:
            p = np.column_stack([column_of(b, x).to_numpy() for x in P]) if b.num_rows else np.zeros((0, PROJECTED))
            own, limit = column_of(b, "cell").to_numpy(), column_of(b, "bound").to_numpy() * STOP
            for i in range(len(p)):
                gap = np.maximum(np.maximum(low - p[i], p[i] - high), 0)
                go = number[((gap**2).sum(axis=1) <= limit[i]) & (number != own[i]) & (number // LENGTH == own[i] // LENGTH)]
                if len(go):
                    row = b.slice(i, 1).take(pa.array(np.zeros(len(go), np.int64)))
                    at = row.schema.get_field_index("cell")
                    yield pa.RecordBatch.from_arrays([pa.array(go) if c == at else x for c, x in enumerate(row.columns)], row.schema.names)

    more = _searched(index, open_.mapInArrow(route, open_.schema), k)
    found = _best(near.select("query", "vec_id", "score").unionAll(more), k)
    return found.join(names, "query").select("query_id", "rank", F.nullif("vec_id", F.lit(NO_ID)).alias("vec_id"), "score")
