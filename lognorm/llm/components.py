"""Connected components of a link table by alternating large and small stars.

Every round relinks neighbours to the smallest known node and halves distances, so rounds grow
with the logarithm of a component's length. A node's neighbours are never gathered: their
minimum is a partial aggregate, and links meet it in a join that Spark may split where a hub has
many. Each round is written to the shared checkpoint folder. Rounds of few links run in few tasks: a
task costs its executor pages of memory and three files a shuffle, however few links it has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lognorm.llm.common import saved

#: A round's tasks hold so many links each, or fewer.
LINKS = 50_000


def _signature(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).head()
    return tuple(row)


def _large_star(links: DataFrame, tasks: int) -> DataFrame:
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    moved = both.where("b > a").join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.coalesce(tasks).distinct().coalesce(tasks)


def _small_star(links: DataFrame, tasks: int) -> DataFrame:
    """``links`` lead from the larger to the smaller node."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).coalesce(tasks).distinct().coalesce(tasks)


def components(links: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node reachable, for every node that has a link to another."""
    first, second = F.col(a), F.col(b)
    now = saved(links.where(first != second).select(F.greatest(first, second).alias("a"), F.least(first, second).alias("b")).distinct())
    before = None
    for _ in range(most_rounds):
        mark = _signature(now)
        if mark == before or mark[0] == 0:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before, tasks = mark, 1 + mark[0] // LINKS
        now = saved(_small_star(saved(_large_star(now.coalesce(tasks), tasks)), tasks))
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
