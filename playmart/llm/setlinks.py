"""Exact Jaccard links among the members of candidate components.

The input says which sets may be linked: only members of one candidate
component. Listing their pairs would grow with the square of a component, so
the links that decide connectivity are found from differences to a pivot set
P of the component. With D(A) the symmetric difference of A and P, the
distance of two members is |D(A)| + |D(B)| - 2 |D(A) n D(B)|:

* members linked to P are connected through it;
* any other link has a member A that is not linked to P. Then D(A) and D(B)
  must share at least t elements, t following from the sizes, and a prefix
  join on the elements of D, rare ones first, with size and position filters
  finds every such pair. Each is verified.

Where many members are far from their pivot, this goes in rounds: first a few
of them, by hash, with all their partners, then more. What the links found so
far connect needs no pair, so near copies that miss the pivot are not paired
with one another.

The links returned connect exactly the members that all links connect.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playmart.llm import components
from playmart.llm.common import discard, materialize

# Members of 64 whose partners are sought by the end of each round, by the
# listed elements of far members from which on these rounds are taken.
ROUNDS = {0: (64,), 1_000_000: (4, 64), 16_000_000: (1, 8, 64)}
# Elements that the pairs verified together carry, about, or as many as there are.
CARRIED = 1 << 25


def prefixes(delta: DataFrame, num: int, den: int) -> DataFrame:
    """(comp, id, class, n, k, far, i, e): for each difference the elements ``e`` of
    its prefix that others of the component have too, with their places ``i``.

    The order is by how often an element occurs in the component's
    differences. Elements of one difference alone come first and need not be
    listed; each difference meets its own recurring elements only.
    """
    elements = delta.select("comp", "id", F.explode("d").alias("e"))
    counts = elements.groupBy("comp", "e").agg(F.count("*").alias("c")).where("c > 1")
    recurring = elements.join(counts, ["comp", "e"]).groupBy("id").agg(F.sort_array(F.collect_list(F.struct("c", "e"))).alias("r"))
    # a partner has at most n * den / num elements, so at most n * less / num
    # differ and at least this many are shared
    shared = F.greatest(F.lit(1), F.expr(f"k - floor(n * {den - num} / {num})"))
    alone = F.col("k") - F.size("r")
    listed = delta.select("comp", "id", "class", "n", "k", "far").join(recurring, "id").select(
        "comp", "id", "class", "n", "k", "far", "r", alone.alias("alone"), (F.col("k") - shared + 1 - alone).cast("int").alias("take")
    )
    return (
        listed.where("take > 0")
        .select("comp", "id", "class", "n", "k", "far", "alone", F.posexplode(F.slice("r", F.lit(1), F.col("take"))).alias("i", "r"))
        .select("comp", "id", "class", "n", "k", "far", (F.col("alone") + F.col("i")).alias("i"), "r.e")
    )


def spread(prefix: DataFrame) -> DataFrame:
    """The rows of the elements that members of several classes list."""
    mixed = (
        prefix.groupBy(F.col("comp").alias("m_comp"), F.col("e").alias("m_e"))
        .agg(F.min("class").alias("least"), F.max("class").alias("most"), F.bool_or("far").alias("open"))
        .where("open AND least < most")
    )
    return prefix.join(mixed, F.expr("comp = m_comp AND e = m_e"), "left_semi")


def pairs_of(prefix: DataFrame, num: int, den: int, ends: tuple[int, ...], now: int) -> DataFrame:
    """(a_id, b_id) of the members of different classes that may be linked, at
    least one of them far and of round ``now``, the other of no earlier one."""
    less, more = den - num, den + num
    of_64 = F.pmod(F.xxhash64("id"), F.lit(ends[-1]))
    turn = sum([(of_64 >= end).cast("int") for end in ends[:-1]], F.lit(0))
    rows = prefix.withColumn("turn", turn).select("comp", "id", "class", "n", "k", "i", "e", "far", "turn")
    a = rows.where(f"far AND turn = {now}").select(*[F.col(c).alias(f"a_{c}") for c in rows.columns if c not in ("far", "turn")])
    b = rows.where(f"NOT far OR turn >= {now}").select(*[F.col(c).alias(f"b_{c}") for c in rows.columns])
    need = f"ceil((a_k + b_k - (a_n + b_n) * {less} / {more}) / 2)"
    return (
        a.join(
            b,
            F.expr(
                f"a_comp = b_comp AND a_e = b_e AND a_class <> b_class AND (a_id < b_id OR NOT b_far OR b_turn > {now}) "
                f"AND a_n * {num} <= b_n * {den} AND b_n * {num} <= a_n * {den} "
                f"AND least(a_k - a_i, b_k - b_i) >= {need}"
            ),
        )
        .select("a_id", "b_id")
        .distinct()
    )


def verified(pairs: DataFrame, delta: DataFrame, num: int, den: int) -> list[DataFrame]:
    """Tables of the pairs (a, b) that are linked. Each pair carries the
    difference of its first member, so they go in parts."""
    less, more = den - num, den + num
    size = delta.agg(F.sum("k").alias("all"), F.avg(F.when(F.col("far"), F.col("k"))).alias("each")).first()
    parts = max(1, math.ceil(pairs.count() * (size["each"] or 0) / max(CARRIED, size["all"] or 0)))
    left = delta.select(F.col("id").alias("a_id"), F.col("n").alias("a_n"), F.col("k").alias("a_k"), F.col("d").alias("a_d"))
    right = delta.select(F.col("id").alias("b_id"), F.col("n").alias("b_n"), F.col("k").alias("b_k"), F.col("d").alias("b_d"))
    differing = F.expr("a_k + b_k - 2 * size(array_intersect(a_d, b_d))")
    part = F.pmod(F.xxhash64("a_id"), F.lit(parts))
    return [
        materialize(
            pairs.where(part == p)
            .join(left.where(part == p), "a_id")
            .join(right, "b_id")
            .where(differing * more <= (F.col("a_n") + F.col("b_n")) * less)
            .select(F.col("a_id").alias("a"), F.col("b_id").alias("b")),
            "links",
        )
        for p in range(parts)
    ]


def links(members: DataFrame, num: int, den: int, set_of: Callable[[Column], Column] = lambda c: c) -> DataFrame:
    """(a, b) edges for ``members`` (comp, id, elements): the ids of distinct
    sets of Jaccard similarity at least ``num / den``. ``set_of`` makes a set,
    an array of distinct longs, of what stands in ``elements``, which may be
    shorter; the joins carry that."""
    # |A| + |B| = s and symmetric difference h: similar iff s (den - num) >= h (den + num)
    less, more = den - num, den + num
    pivots = members.groupBy("comp").agg(F.min("id").alias("pivot"))
    pivots = pivots.join(members.drop("comp"), F.col("pivot") == F.col("id")).select(
        F.col("comp").alias("p_comp"), "pivot", F.col("elements").alias("p_elements")
    )
    # the pivot itself differs in nothing and needs no row
    sets = members.join(pivots, F.col("comp") == F.col("p_comp")).where("id <> pivot").select(
        "comp", "id", "pivot", set_of(F.col("elements")).alias("elements"), set_of(F.col("p_elements")).alias("p_elements")
    )
    delta = sets.select(
        "comp",
        "id",
        "pivot",
        F.size("elements").cast("long").alias("n"),
        F.size("p_elements").cast("long").alias("p_n"),
        F.concat(F.array_except("elements", "p_elements"), F.array_except("p_elements", "elements")).alias("d"),
    )
    delta = materialize(
        delta.select("*", F.size("d").cast("long").alias("k")).withColumn(
            "far", F.col("k") * more > (F.col("n") + F.col("p_n")) * less
        ),
        "deltas",
    )
    to_pivot = delta.where("not far").select(F.col("id").alias("a"), F.col("pivot").alias("b"))

    open_comps = delta.where("far").select(F.col("comp").alias("o_comp")).distinct()
    opened = delta.join(open_comps, F.col("comp") == F.col("o_comp"), "left_semi").where("k > 0")
    opened = opened.withColumn("class", F.when(F.col("far"), F.col("id")).otherwise(F.col("pivot")))
    # both sides of the join read the prefixes, and each step's files go before the next one's
    prefix = materialize(prefixes(opened, num, den), "prefixes")
    found = materialize(to_pivot, "links")
    listed = prefix.where("far").count()
    ends = ROUNDS[max(least for least in ROUNDS if least <= listed)]
    for now in range(len(ends)):
        if now:
            rooted = components.components(found)
            known = prefix.join(rooted, F.col("id") == F.col("node"), "left").withColumn("class", F.coalesce("root", "id"))
            last, prefix = prefix, materialize(spread(known.select(*prefix.columns)), "prefixes")
            discard(last)
            discard(rooted)
        pairs = materialize(pairs_of(prefix, num, den, ends, now), "pairs")
        for table in verified(pairs, delta, num, den):
            found = found.unionByName(table)
        discard(pairs)
    discard(prefix)
    discard(delta)
    return found
