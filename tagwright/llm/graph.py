"""Connected components of a link table, entirely as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..sources.scratch import materialize


def _stars(edges: DataFrame, keep) -> DataFrame:
    """Each neighbour of a node linked to the node's smallest neighbour (or itself)."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return edges.join(least, "u").where(keep)


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(id, component) of every id in a link; ``edges`` has columns a and b, both long.

    Alternating large and small stars: after a few rounds every id is linked to the smallest
    id of its component and nothing else.  A round is a written table, so a lost executor
    re-reads files.  Links with a null end are ignored; an id linked only with itself is its
    own component."""
    loops = edges.where(F.col("a") == F.col("b")).select(F.col("a").alias("id")).distinct()
    now = materialize(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name,
    )
    state = None
    while True:
        both = now.union(now.select("v", "u"))
        large = _stars(both, F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        now = materialize(
            small.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v"))).distinct(), name,
        )
        new = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if new == state:
            break
        state = new
    roots = now.select(F.col("v").alias("id")).distinct()
    found = now.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots.select("id", F.col("id").alias("component")))
    return found.union(loops.join(found, "id", "left_anti").select("id", F.col("id").alias("component")))
