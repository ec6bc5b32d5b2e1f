"""Connected components of links, and the components of records that share keys."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import staged


#: Links that one task may join up; more of them take rounds of joins.
FEW_LINKS = 200_000


def _joined_up(batches):
    """(id, comp) of some links, by trees whose roots are their smallest ids."""
    up: dict = {}

    def root(x):
        top = x
        while (above := up.setdefault(top, top)) != top:
            top = above
        while up[x] != top:
            up[x], x = top, up[x]
        return top

    for pdf in batches:
        for a, b in zip(pdf["a"].tolist(), pdf["b"].tolist(), strict=True):
            a, b = root(a), root(b)
            up[max(a, b)] = min(a, b)
    ids = list(up)
    yield pd.DataFrame({"id": ids, "comp": [root(x) for x in ids]}, dtype="int64")


def components(links: DataFrame) -> DataFrame:
    """(id, comp) for every id in ``links`` (a, b); comp is the smallest id that it reaches.

    Up to ``FEW_LINKS`` links are joined up by one task, which holds no more than these. For more, each round takes the smallest label among the neighbours and then the label of that label, so the rounds grow with
    the logarithm of a component's width. Every round is a written table; only a count comes back. Hubs are joined,
    never gathered: the sums are partial before the shuffle and Spark splits a skewed side of a join."""
    both = staged(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct(), "links")
    if both.count() <= 2 * FEW_LINKS:
        return staged(both.filter("a < b").coalesce(1).mapInPandas(_joined_up, "id long, comp long"), "labels")
    labels = staged(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("comp")), "labels")
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), "comp"), "b").groupBy("a").agg(F.min("comp").alias("m"))
        met = labels.join(near, labels["id"] == near["a"]).select("id", F.col("comp").alias("old"), F.least("comp", "m").alias("comp"))
        jump = labels.select(F.col("id").alias("comp"), F.col("comp").alias("further"))
        labels = staged(met.join(jump, "comp").select("id", F.least("comp", "further").alias("comp"), (F.least("comp", "further") < F.col("old")).alias("moved")), "labels")
        if labels.filter("moved").isEmpty():
            return labels.select("id", "comp")
        labels = labels.select("id", "comp")


def merged(rows: DataFrame) -> DataFrame:
    """``rows`` as a side of a join that is sorted and merged, and never sent to all tasks by way of the driver. Spark takes rows that Python made
    for as many as it was given, and a written table for as small as its compressed files: fifty keys for each record, or long runs of
    one key, are then far more in memory than it thinks."""
    return rows.hint("merge")


#: Buckets of fewer records are compared pair by pair: a bounded number of pairs each. It and the number of rounds of stars only
#: decide how links are found, not which.
BIG, ROUNDS = 16, 8


def linked(keys: DataFrame, near: Column, verify: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(id, comp) of the ids that are linked, directly or over others, among those that share a key in ``keys`` (key, id, ...).

    ``verify`` takes candidate pairs (a, b) and returns those that are links; ``near`` is a cheap test over the columns of two
    records (id_a, id_b, ...) that every link passes. In a small bucket all pairs are candidates. In a big one each id is held
    against the smallest; ids linked so far are one component, and a link inside a component changes nothing. Where a big bucket
    still holds two components, its ids are held against one that a hash picks, and another in the next round, for as long as that
    links something; what is left is compared pair by pair between components. No link between components is lost, and a big
    bucket of alike records costs as many comparisons as it has records, a few times over."""
    columns = [c for c in keys.columns if c != "key"]
    side = lambda df, s, more=(): df.select("key", *[F.col(c).alias(f"{c}_{s}") for c in (*columns, *more)])
    spans = keys.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count(F.lit(1)).alias("n")).filter("first < last")
    shared = staged(merged(keys).join(merged(spans.select("key", "first", "n")), "key"), "buckets")
    small, big = shared.filter(F.col("n") < BIG), shared.filter(F.col("n") >= BIG)
    pairs = merged(side(small, "a")).join(merged(side(small, "b")), "key").filter((F.col("id_a") < F.col("id_b")) & near).select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))
    stars = big.filter("id <> first").select(F.col("id").alias("a"), F.col("first").alias("b"))
    found = components(verify(pairs.union(stars).distinct()))

    def mixed(found: DataFrame, name: str) -> DataFrame:
        rest = staged(merged(big.select("key", *columns)).join(merged(found), "id", "left").withColumn("comp", F.coalesce("comp", "id")), "rest")
        keys = rest.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low < high").select("key")
        return staged(merged(rest).join(merged(keys), "key"), name)

    rest = mixed(found, "mixed")
    for k in range(ROUNDS):
        if rest.isEmpty():
            return found
        pivots = rest.groupBy("key").agg(F.min_by(F.struct(*columns, "comp"), F.xxhash64("id", F.lit(k))).alias("p"))
        pivots = pivots.select("key", *[F.col(f"p.{c}").alias(f"{c}_b") for c in (*columns, "comp")])
        tries = merged(side(rest, "a", ("comp",))).join(merged(pivots), "key").filter((F.col("comp_a") != F.col("comp_b")) & near)
        links = staged(verify(tries.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct()), "star-links")
        if links.isEmpty():
            break
        found = components(found.select(F.col("id").alias("a"), F.col("comp").alias("b")).union(links.select("a", "b")))
        rest = mixed(found, f"mixed-{k}")
    x, y = side(rest, "a", ("comp",)), side(rest, "b", ("comp",))
    links = staged(verify(merged(x).join(merged(y), "key").filter((F.col("comp_a") < F.col("comp_b")) & near).select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct()), "more-links")
    return components(found.select(F.col("id").alias("a"), F.col("comp").alias("b")).union(links.select("a", "b")))


def linked_throughout(ids: DataFrame, keys: DataFrame, near: Column, verify: Callable[[DataFrame], DataFrame], thorough: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(id, comp) of the ``ids`` (id) that are linked, directly or over others, whether they share a key in ``keys`` or not.

    The keys only save work: in each bucket every id is held against the smallest, and what ``near`` and ``verify`` let through
    is one component. ``thorough`` then gets all ids with their component (id, comp) and returns every link between different
    components, so no link is lost by its keys, by ``near`` or by the size of a bucket."""
    columns = [c for c in keys.columns if c != "key"]
    first = F.first(F.struct(*columns)).over(W.partitionBy("key").orderBy("id").rowsBetween(W.unboundedPreceding, 0))
    stars = keys.select(*[F.col(c).alias(f"{c}_a") for c in columns], first.alias("first")).select("*", *[F.col(f"first.{c}").alias(f"{c}_b") for c in columns])
    found = components(verify(stars.filter((F.col("id_a") != F.col("id_b")) & near).select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct()))
    members = staged(ids.join(found, "id", "left").select("id", F.coalesce("comp", "id").alias("comp")), "members")
    links = staged(thorough(members), "more-links")
    return components(found.select(F.col("id").alias("a"), F.col("comp").alias("b")).union(links.select("a", "b")))
