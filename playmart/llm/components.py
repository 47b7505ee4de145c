"""Connected components by alternating large-star and small-star steps.

Edges are rows; every step is a partial aggregate and an equi-join, so no
component, hub or neighbour list ever has to fit into one task. The edges of
each round are written to the shared folder, which cuts the lineage; those of
the round before are removed then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmart.llm.common import discard, materialize


def _print(edges: DataFrame) -> tuple:
    """Order-free fingerprint of an edge set, for the test of convergence."""
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) with the smallest node reachable, for every node that is
    not its own root. ``edges`` has two long columns; loops and nulls are
    ignored, and directions and repetitions do not matter."""
    a, b = (F.col(c).cast("long") for c in edges.columns[:2])
    now = edges.where(a.isNotNull() & b.isNotNull() & (a != b))
    now = materialize(now.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    seen = _print(now)
    while seen[0]:
        # large star: larger neighbours move to the smallest neighbour
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("x")).agg(F.min("v").alias("m"))
        least = least.select("x", F.least("x", "m").alias("m"))
        large = now.join(least, now.v == least.x).select("u", F.col("m").alias("v")).distinct()
        # small star: smaller neighbours and the node move to the smallest of them
        target = large.groupBy(F.col("u").alias("x")).agg(F.min("v").alias("m"))
        small = large.join(target, large.u == target.x).select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")
        )
        last, now = now, materialize(small.select("e.u", "e.v").where("u <> v").distinct(), "edges")
        discard(last)
        found = _print(now)
        if found == seen:
            break
        seen = found
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def stars(shared: DataFrame, bucket: str, member: str) -> DataFrame:
    """(member, head) edges from the members of each bucket to its smallest.
    The smallest is found by partial aggregates, and the members of a large
    bucket are joined in parts, so none of it is a single task's."""
    heads = (
        shared.groupBy(bucket).agg(F.min(member).alias("head"), F.max(member).alias("last")).where("head < last").select(bucket, "head")
    )
    return shared.join(heads, bucket).where(F.col(member) != F.col("head")).select(member, "head")
