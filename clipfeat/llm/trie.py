"""Prefix trie of conversations, by partition refinement.

All conversations begin in one class, the root. A round splits each class that still holds different sequences by its next
turn; the parts are the nodes of that depth. A class of one sequence is retired: the rest of it is a chain of nodes with one
child each, which needs no more rounds. Sums over subtrees are folded back from the deepest round to the root.

Equal sequences count as one with a number of copies from the beginning, so a conversation that comes very often is one row in
every round, and the rounds end when the different sequences are apart. A round works only on what is still shared, through
sums that are partial before the shuffle and joins that Spark can split. Turns are placed by ranges of (conv_id, turn) and
sums over the ranges before, so that a conversation of any length is many tasks; texts are shuffled once, for that.

Cases: a null role or text is empty; a null turn comes first; ties of turn are ordered by role and text, and repeated rows are
turns of their own; rows without a conv_id belong to no conversation and take no part; a conversation whose turns are all
replaced by those of an absent one has none and is a member of the root alone; an empty table gives no rows, not even a
root; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import staged, table

NOTHING = hashlib.sha256(b"").hexdigest()


def numbered_turns(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, part, place, key, chars) of every turn, and (conv_id, part, first, offset, n_own) of every range of a conversation:
    the number of a turn, from 1, is place - first + offset + 1. ``key`` tells role and text from all others."""
    rows = rows.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    # rows that are equal in all columns are told apart, so that no number of them is one range
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("row")]
    key = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    turns = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", key.alias("key"), F.length("text").cast("long").alias("chars"), F.monotonically_increasing_id().alias("place"))
    turns = staged(turns, "trie-places").withColumn("part", F.shiftright("place", 33))
    parts = turns.groupBy("conv_id", "part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    ahead = W.partitionBy("conv_id").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.withColumn("offset", F.coalesce(F.sum("n").over(ahead), F.lit(0))).withColumn("n_own", F.sum("n").over(W.partitionBy("conv_id")))
    return turns, staged(parts.drop("n"), "trie-parts")


def _number() -> Column:
    return F.col("place") - F.col("first") + F.col("offset") + 1


def rebuilt_conversations(rows: DataFrame, block: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """(conv_id, n_turns) and (conv_id, depth, key, chars) of the conversations whose first turns come from the first one of
    their block of ``block`` ids. How many do is a checksum of conv_id, below ``most``."""
    turns, parts = numbered_turns(rows)
    own = parts.select("conv_id", "n_own").distinct()
    convs = own.select("conv_id", "n_own", (F.col("conv_id") - F.col("conv_id") % block).alias("base"), (F.crc32(F.col("conv_id").cast("string")) % most).alias("h"))
    convs = convs.join(own.select(F.col("conv_id").alias("base"), F.col("n_own").alias("n_base")), "base", "left")
    taken = F.least("h", F.coalesce("n_base", F.lit(0)))
    convs = convs.select("conv_id", "base", "h", taken.alias("taken"), (taken + F.greatest(F.lit(0), F.col("n_own") - F.col("h"))).alias("n_turns"))
    convs = staged(convs, "trie-conversations")
    rest = turns.join(parts.join(convs, "conv_id"), ["conv_id", "part"]).filter(_number() > F.col("h"))
    rest = rest.select("conv_id", (_number() - F.col("h") + F.col("taken")).alias("depth"), "key", "chars")
    # the first turns of one conversation in a block: fewer than ``most`` for each of the ``block`` that take them
    first = turns.filter(F.col("conv_id") % block == 0).join(parts, ["conv_id", "part"]).filter(_number() < most)
    first = first.select(F.col("conv_id").alias("base"), _number().alias("depth"), "key", "chars")
    heads = convs.filter("taken > 0").join(first, "base").filter("depth <= taken").select("conv_id", "depth", "key", "chars")
    return convs.select("conv_id", "n_turns"), staged(rest.unionByName(heads), "trie-rebuilt")


def _blocks(batches):
    """Runs of ids with the same sequence as one row each: the first id, how many, and their decimals with commas."""
    names = ["d1", "d2", "n_turns", "first", "n", "ids"]
    for batch in batches:
        d1, d2, n, ids = (batch.column(k).to_numpy() for k in range(4))
        if not len(ids):
            continue
        starts = np.flatnonzero(np.concatenate([[True], (d1[1:] != d1[:-1]) | (d2[1:] != d2[:-1]) | (n[1:] != n[:-1])]))
        ends = np.append(starts[1:], len(ids))
        text = [",".join(map(str, ids[a:b].tolist())) for a, b in zip(starts, ends, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(d1[starts]), pa.array(d2[starts]), pa.array(n[starts]), pa.array(ids[starts]), pa.array(ends - starts), pa.array(text)], names)


def _sums(batches):
    """SHA-256 over the rows of each sequence as they come; a row at a time is held."""
    held, sha, out = None, None, []

    def frame():
        columns = list(zip(*out, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.string())], ["rep", "n_turns", "copies", "ends"])

    for batch in batches:
        d1, d2, n, first, count, ids = (batch.column(k) for k in range(6))
        for k in range(batch.num_rows):
            key = (d1[k].as_py(), d2[k].as_py(), n[k].as_py())
            if held and held[0] == key:
                sha.update(b"," + ids[k].as_py().encode())
                held[2] += count[k].as_py()
                continue
            if held:
                out.append((held[1], held[0][2], held[2], sha.hexdigest()))
            held, sha = [key, first[k].as_py(), count[k].as_py()], hashlib.sha256(ids[k].as_py().encode())
        if len(out) > 5000:
            yield frame()
            out.clear()
    if held:
        out.append((held[1], held[0][2], held[2], sha.hexdigest()))
        yield frame()


def distinct_sequences(convs: DataFrame, rebuilt: DataFrame) -> DataFrame:
    """(rep, n_turns, copies, ends): the different sequences of turns, by the smallest conv_id that has one, how many have it, and
    the SHA-256 of all their ids in order. The ids go through ranges first, where those of a sequence become long rows, so that
    the one task that a SHA-256 must run in streams few of them."""
    element = F.md5(F.concat(F.encode(F.col("depth").cast("string"), "utf-8"), F.col("key")))
    number = lambda at: F.conv(F.substring(element, at, 15), 16, 10).cast("long")
    sums = rebuilt.groupBy("conv_id").agg(F.bit_xor(number(1)).alias("d1"), F.bit_xor(number(16)).alias("d2"))
    known = convs.join(sums, "conv_id", "left").select(F.coalesce("d1", F.lit(0)).alias("d1"), F.coalesce("d2", F.lit(0)).alias("d2"), F.col("n_turns").cast("long").alias("n_turns"), "conv_id")
    order = ["d1", "d2", "n_turns", "conv_id"]
    blocks = known.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_blocks, "d1 long, d2 long, n_turns long, first long, n long, ids string")
    same = blocks.repartition("d1", "d2", "n_turns").sortWithinPartitions("d1", "d2", "n_turns", "first")
    return staged(same.mapInArrow(_sums, "rep long, n_turns long, copies long, ends string"), "trie-sequences")


NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "chars", "n_seqs", "ends"]


def refined(seqs: DataFrame, turns: DataFrame) -> list[DataFrame]:
    """The nodes that are split off in each round, the root first: ``NODE``, with the number of different sequences in the class."""
    ended = lambda d: F.max(F.when(F.col("n_turns") == d, F.col("ends"))).alias("ends")
    sums = [F.sum("copies").alias("n_convs"), F.count(F.lit(1)).alias("n_seqs")]
    root = seqs.agg(F.min("rep").alias("conv_id"), *sums, ended(0)).filter("n_seqs > 0")
    root = root.withColumns({"depth": F.lit(0), "parent_conv_id": F.lit(None).cast("long"), "chars": F.lit(0).cast("long")}).select(*NODE)
    rounds = [staged(root, "trie-round-0")]
    top = rounds[0].first()  # one row
    active = seqs.filter(F.col("n_turns") > 0).withColumn("class", F.lit(top["conv_id"] if top else None).cast("long")).filter(F.lit(bool(top and top["n_seqs"] > 1)))
    d = 0
    while not active.isEmpty():
        d += 1
        split = active.join(turns.filter(F.col("depth") == d).drop("depth"), "rep")
        classes = split.groupBy("class", "key").agg(F.min("rep").alias("conv_id"), *sums, F.first("chars").alias("chars"), ended(d))
        classes = staged(classes, f"trie-round-{d}")
        rounds.append(classes.select("conv_id", F.lit(d).alias("depth"), F.col("class").alias("parent_conv_id"), "n_convs", "chars", "n_seqs", "ends"))
        more = classes.filter("n_seqs > 1").select("class", "key", F.col("conv_id").alias("next"))
        active = split.filter(F.col("n_turns") > d).join(more, ["class", "key"]).select("rep", "n_turns", "copies", "ends", F.col("next").alias("class"))
        active = staged(active, f"trie-active-{d}")
    return rounds


def chains(rounds: list[DataFrame], seqs: DataFrame, turns: DataFrame, block: int = 1000) -> DataFrame:
    """What follows the last split of each sequence, with its sums: (conv_id, depth, n_convs, n_turns, ends, saved, begins).

    Only sequences with copies have sums other than zero; those are made in blocks of ``block`` turns and over the blocks."""
    retired = rounds[0]
    for r in rounds[1:]:
        retired = retired.unionByName(r)
    retired = retired.filter("n_seqs = 1").select(F.col("conv_id").alias("rep"), F.col("depth").alias("begins")).join(seqs, "rep").filter("n_turns > begins")
    tail = turns.drop("key").join(retired, "rep").filter("depth > begins").withColumn("own", (F.col("copies") - 1) * F.col("chars")).withColumn("block", F.floor(F.col("depth") / block))
    tail = staged(tail, "trie-tails")
    sums = tail.filter("copies > 1").groupBy("rep", "block").agg(F.sum("own").alias("n"))
    beyond = W.partitionBy("rep").orderBy("block").rowsBetween(1, W.unboundedFollowing)
    sums = sums.select("rep", "block", F.coalesce(F.sum("n").over(beyond), F.lit(0)).alias("beyond"))
    inner = W.partitionBy("rep", "block").orderBy("depth").rowsBetween(0, W.unboundedFollowing)
    several = tail.filter("copies > 1").join(sums, ["rep", "block"]).withColumn("saved", F.col("beyond") + F.sum("own").over(inner))
    columns = [F.col("rep").alias("conv_id"), "depth", F.col("copies").alias("n_convs"), "n_turns", "ends", "saved", "begins"]
    return staged(several.select(*columns).unionByName(tail.filter("copies = 1").withColumn("saved", F.lit(0).cast("long")).select(*columns)), "trie-chains")


def prefix_trie(rows: DataFrame, block: int = 100, most: int = 6, chain_block: int = 1000) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256): one row per node."""
    convs, rebuilt = rebuilt_conversations(rows, block, most)
    seqs = distinct_sequences(convs, rebuilt)
    turns = staged(rebuilt.withColumnRenamed("conv_id", "rep").join(seqs.select("rep"), "rep", "left_semi"), "trie-turns")
    rounds = refined(seqs, turns)
    tails = chains(rounds, seqs, turns, chain_block)
    ends = F.coalesce("ends", F.lit(NOTHING)).alias("ends_sha256")
    last = F.col("depth") == F.col("n_turns")
    out = tails.select(
        "conv_id", F.col("depth").cast("long").alias("depth"), F.col("conv_id").alias("parent_conv_id"), "n_convs", F.when(last, 0).otherwise(1).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.when(last, F.col("ends")).otherwise(NOTHING).alias("ends_sha256"),
    )
    tops = tails.filter("depth = begins + 1").select("conv_id", F.col("begins").alias("depth"), F.col("saved").alias("tail"))
    below = None
    for d in reversed(range(len(rounds))):
        level = rounds[d].join(tops.filter(F.col("depth") == d).drop("depth"), "conv_id", "left")
        if below is not None:
            level = level.join(below, "conv_id", "left")
        of_below = lambda name: F.coalesce(F.col(name), F.lit(0)) if below is not None else F.lit(0)  # noqa: B023, E731
        children = of_below("b_children") + F.col("tail").isNotNull().cast("long")
        level = level.withColumns({
            "n_children": children,
            "n_leaves": F.when(children == 0, 1).otherwise(of_below("b_leaves") + F.col("tail").isNotNull().cast("long")).cast("long"),
            "saved_tokens": (F.col("n_convs") - 1) * F.col("chars") + of_below("b_saved") + F.coalesce("tail", F.lit(0)),
        })
        level = level.select("conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", F.col("n_children").cast("long").alias("n_children"), "n_leaves", "saved_tokens", ends)
        level = staged(level, f"trie-level-{d}")
        below = level.groupBy(F.col("parent_conv_id").alias("conv_id")).agg(F.count(F.lit(1)).alias("b_children"), F.sum("n_leaves").alias("b_leaves"), F.sum("saved_tokens").alias("b_saved"))
        out = out.unionByName(level)
    return out


def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, rebuilt so that those of a block share their beginnings."""
    return prefix_trie(table(spark, sf_dir, "conversations"))


SQL = r"""
WITH RECURSIVE turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, count(*) AS n_own FROM turns GROUP BY conv_id),
convs AS (
  SELECT o.conv_id, o.conv_id - o.conv_id % 100 AS base, o.n_own,
    CAST(xor(list_reduce([CAST(4294967295 AS UBIGINT)] || list_transform(range(length(CAST(o.conv_id AS VARCHAR))), lambda i: CAST(ascii(substr(CAST(o.conv_id AS VARCHAR), i + 1, 1)) AS UBIGINT)),
      lambda c, b: list_reduce([xor(c, b)] || list_transform(range(8), lambda k: CAST(0 AS UBIGINT)), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, CAST(3988292384 AS UBIGINT)) ELSE x >> 1 END)), CAST(4294967295 AS UBIGINT)) % 6 AS BIGINT) AS h
  FROM own o),
taken AS (SELECT c.*, least(c.h, coalesce(b.n_own, 0)) AS n_taken FROM convs c LEFT JOIN own b ON b.conv_id = c.base),
rebuilt AS (
  SELECT c.conv_id, t.k AS depth, t.role, t.text FROM taken c JOIN turns t ON t.conv_id = c.base AND t.k <= c.h
  UNION ALL SELECT c.conv_id, t.k - c.h + c.n_taken, t.role, t.text FROM taken c JOIN turns t ON t.conv_id = c.conv_id AND t.k > c.h),
prefixes AS (
  SELECT conv_id, depth, text, sha256(string_agg(length(role) || ':' || length(text) || ':' || role || text, '' ORDER BY depth) OVER (PARTITION BY conv_id ORDER BY depth)) AS node FROM rebuilt
  UNION ALL SELECT conv_id, 0, '', '' FROM convs),
linked AS (SELECT *, lag(node) OVER w AS parent, count(*) OVER (PARTITION BY conv_id) - 1 AS n_turns FROM prefixes WINDOW w AS (PARTITION BY conv_id ORDER BY depth)),
nodes AS (
  SELECT node, depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * length(any_value(text)) AS own_saved,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n_turns = depth), '')) AS ends_sha256
  FROM linked GROUP BY node, depth),
families AS (SELECT parent, count(*) AS n_children FROM nodes GROUP BY parent),
whole AS (SELECT n.*, p.conv_id AS parent_conv_id, coalesce(f.n_children, 0) AS n_children FROM nodes n LEFT JOIN nodes p ON p.node = n.parent LEFT JOIN families f ON f.parent = n.node),
sums AS (
  SELECT a.node, count(*) FILTER (b.n_children = 0) AS n_leaves, sum(b.own_saved) AS saved_tokens
  FROM whole b JOIN linked a ON a.conv_id = b.conv_id AND a.depth <= b.depth GROUP BY a.node)
SELECT conv_id, CAST(depth AS BIGINT) AS depth, parent_conv_id, n_convs, n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256 FROM whole JOIN sums USING (node)
"""
