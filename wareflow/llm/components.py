"""Connected components by alternating large-star and small-star steps, all in joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch

#: Rounds at most; the number needed grows with the logarithm of the vertices, so more means a fault.
ROUNDS = 100
#: Edges that a file of a round holds at most: small rounds don't become many tiny files.
FILE = 200_000


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step on (u, v): the larger neighbours (or all the others) of a vertex go to its least.

    The least is an aggregate, joined back, so that no task holds all neighbours of a hub.
    """
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = both.join(least, "u")
    if large:
        return joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
    up = joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return up.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def components(edges: DataFrame, kept: Scratch | None = None, rounds: int = ROUNDS) -> DataFrame:
    """(id, component_id) for every vertex of (u, v): the least id that its links reach.

    Loops and repeated edges don't matter; an empty table gives an empty one. Each round is written
    to the shared folder, replaces the one before, and the loop ends when a round changes nothing. A loop that doesn't end is
    an error, so that no half-joined component is ever returned. `kept` owns the table behind the result.
    """
    kept = kept or Scratch()
    now, seen = kept.save(edges.select("u", "v").filter("u <> v").distinct(), "cc"), None
    files = -(-2 * now.count() // FILE) or 1  # a round has an edge a vertex and an edge an edge at most
    for _ in range(rounds):
        later = kept.save(_star(_star(now, True), False).coalesce(files), "cc")
        mark = later.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        kept.drop(now)
        now = later
        if tuple(mark) == seen:
            break
        seen = tuple(mark)
    else:
        raise RuntimeError(f"components: not done after {rounds} rounds")
    roots = now.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct()
    return now.select(F.col("u").alias("id"), F.col("v").alias("component_id")).unionByName(roots)
