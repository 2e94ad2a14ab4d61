"""Connected components of links, by joins and aggregates only.

Each round is a large-star and a small-star step (Kiveris et al., "Connected Components in MapReduce and Beyond", 2014): every
node hands its neighbours its smallest one.  Rounds are written to the shared folder, so lineage stays short and lost
executors cost one round at most, and go once the next is written.  Hot nodes: smallest neighbours are found by partially
aggregated minima, and are handed out in ``SALTS`` copies to as many parts of a node's links, so no task gets all links of a hub.
No link or component reaches the driver; only a count and sums do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import forgotten, written

ROUNDS, SALTS = 40, 16


def _handed(rows: DataFrame, least: DataFrame, key: str, other: str) -> DataFrame:
    """``rows`` with what ``least`` (key, m) says of their key; a key's rows are split by their other end."""
    copies = least.withColumn("salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
    return rows.withColumn("salt", F.pmod(F.xxhash64(other), F.lit(SALTS)).cast("int")).join(copies, [key, "salt"])


def _star(links: DataFrame, large: bool) -> DataFrame:
    """(a, b) with a > b -> the links after one star step."""
    if large:
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        return _handed(both.where("v > u"), least, "u", "v").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    handed = _handed(links, least, "a", "b").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return handed.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(a long, b long) links, in any direction, with repeats and loops -> (node, root): root is the least node reachable.

    Nodes that stand in no link between two different nodes are left out.  Null ends are dropped.
    """
    links = links.where("a is not null and b is not null and a <> b")
    links = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    said = None
    for _ in range(ROUNDS):
        before, links = links, written(_star(_star(links, True), False), "links")
        forgotten(before)
        now = links.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("b").cast("decimal(38,0)")).alias("s"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if now == said:
            break
        said = now
    else:
        raise RuntimeError(f"components have not settled after {ROUNDS} rounds")
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
