"""Prefix trie of conversations, with totals of every subtree.

Conversations are rebuilt first: each takes its opening turns from the
conversation whose id is the multiple of `every` at or before its own (towards
0), as many as crc32 of its id says, and goes on with its own turns after as
many.  A node is a distinct sequence of first turns; it is known by 128 bits
that are combined from hashes of (place, role, text), so a prefix's key follows
from running combinations along the sorted turns, with one row carried over
each partition border.

Subtree totals are found by time-forward processing (``timeforward``).  A shard
is a subtree that at most sqrt(turns) conversations reach, as large as can be;
all shards are worked on in parallel, each by reverse level order.  What shard
roots have found is added up by parent and passed on across the nodes above
them; of these there are fewer than sqrt(turns), as each has more members than
that, and one task takes them in reverse level order.

Turns are in the order of `turn`, null first; rows of one turn by role, the
first 256 characters of the text and a hash, repeated rows each being a turn.
Null role or text is empty.  Rows without a conversation id belong to none.
An empty table has no node, not even a root.  Other columns don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, id_bound, trimmed, word_count
from .mixing import ranked
from .timeforward import IN_MEMORY, subtree_totals

#: At most so many nodes above the shards are broadcast (50 bytes each); beyond, a shuffle join is used.
BROADCAST_NODES = 300_000
#: Characters of ids that are hashed together.
CHUNK = 4096
KEY = ["depth", "ka", "kb"]


def rebuilt(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, every: int, most: int) -> DataFrame:
    """conv_id, depth, a, b (hashes of the turn), words and length (turns in all) of every rebuilt turn, and a row of depth 0 for each conversation."""
    role, text = F.coalesce(F.col(role_col).cast("string"), F.lit("")), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    t = rows.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), role.alias("role"), F.substring(text, 1, 256).alias("head"),
        F.xxhash64(role, text).alias("a"), F.xxhash64(F.lit(1), role, text).alias("b"), word_count(text).alias("words"),
    )
    ties = t.groupBy("conv_id", "turn").agg(F.count("*").alias("c")).where("c > 1").limit(1).count() > 0
    named = ["conv_id", "turn", *(["role", "head"] if ties else []), "a", "b"]  # without ties the texts needn't be moved
    order = ranked(t.select(*named, "words"), "conv_id", F.col("turn").asc_nulls_first(), *named[2:]).select("conv_id", "rank", "a", "b", "words")
    convs = durable(order.groupBy("conv_id").agg(F.min("rank").alias("start"), F.count("*").alias("len")))
    place = (F.col("rank") - F.col("start") + 1).alias("pos")
    heads = (
        order.where(F.col("conv_id") % every == 0).join(convs.where(F.col("conv_id") % every == 0), "conv_id").select(F.col("conv_id").alias("base"), place, "a", "b", "words")
        .where(F.col("pos") < most).groupBy("base").agg(F.sort_array(F.collect_list(F.struct("pos", "a", "b", "words"))).alias("head"))
    )
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    convs = convs.withColumns({"h": taken.cast("int"), "base": F.col("conv_id") - F.col("conv_id") % every}).join(heads, "base", "left")
    convs = convs.withColumn("head", F.coalesce(F.slice("head", 1, F.col("h")), F.expr("cast(array() as array<struct<pos: long, a: long, b: long, words: long>>)")))
    convs = durable(convs.select("conv_id", "start", "h", "head", (F.size("head") + F.greatest(F.col("len") - F.col("h"), F.lit(0))).alias("length")))
    own = order.join(convs.select("conv_id", "start", "h", F.size("head").alias("m"), "length"), "conv_id").withColumn("pos", place).where(F.col("pos") > F.col("h"))
    own = own.select("conv_id", (F.col("pos") - F.col("h") + F.col("m")).alias("depth"), "a", "b", "words", "length")
    opening = convs.select("conv_id", F.explode("head").alias("x"), "length").select("conv_id", F.col("x.pos").alias("depth"), "x.a", "x.b", "x.words", "length")
    root = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"), F.lit(0).cast("long").alias("words"), "length")
    return own.unionByName(opening).unionByName(root)


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Running exclusive-or of x and of y within each conversation of a sorted partition, and that of the row before."""
    part = TaskContext.get().partitionId()
    last, carry = None, (np.int64(0), np.int64(0))
    for b in batches:
        if not b.num_rows:
            continue
        conv = b.column("conv_id").to_numpy()
        begins = np.flatnonzero(np.concatenate(([True], conv[1:] != conv[:-1])))
        size = np.diff(np.concatenate((begins, [len(conv)])))
        keys, ups = [], []
        for name, c in zip("xy", carry):
            x = b.column(name).to_numpy()
            run = np.bitwise_xor.accumulate(x)
            off = run[begins] ^ x[begins]  # what lies before each conversation
            if conv[0] == last:
                off[0] ^= c
            keys.append(run ^ np.repeat(off, size))
            ups.append(keys[-1] ^ x)
        last, carry = conv[-1], (keys[0][-1], keys[1][-1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(conv), part), pa.int32()), *(b.column(c) for c in ("conv_id", "depth", "words", "length")), *map(pa.array, (*keys, *ups))],
            names=["part", "conv_id", "depth", "words", "length", "ka", "kb", "pa", "pb"],
        )


def keyed(turns: DataFrame) -> DataFrame:
    """conv_id, depth, words, length, ka, kb (the node's key beside its depth) and pa, pb (its parent's) of every row of `rebuilt`."""
    spark = turns.sparkSession
    hashed = turns.select("conv_id", "depth", "words", "length", F.xxhash64("depth", "a", "b").alias("x"), F.xxhash64(F.lit(1), "depth", "a", "b").alias("y"))
    at = durable(
        hashed.orderBy("conv_id", "depth").mapInArrow(_running, "part int, conv_id long, depth long, words long, length long, ka long, kb long, pa long, pb long")
    )
    # what the last conversation of a partition hands on to the next partition: a row for each partition
    ends = at.groupBy("part").agg(F.min("conv_id"), F.max("conv_id"), F.max_by(F.struct("ka", "kb"), F.struct("conv_id", "depth"))).collect()
    carry, last = [], (None, 0, 0)
    for part, first, end, x in sorted(ends):
        a, b = last[1:] if last[0] == first else (0, 0)
        carry.append((part, first, a, b))
        last = (end, x.ka ^ a, x.kb ^ b) if first == end else (end, x.ka, x.kb)
    carry = spark.createDataFrame(carry, "part int, conv_id long, ca long, cb long")
    with_carry = lambda k, c: F.col(k).bitwiseXOR(F.coalesce(c, F.lit(0))).alias(k)
    return at.join(F.broadcast(carry), ["part", "conv_id"], "left").select(
        "conv_id", "depth", "words", "length", with_carry("ka", "ca"), with_carry("kb", "cb"), with_carry("pa", "ca"), with_carry("pb", "cb")
    )


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids that end at a node, sorted, joined in pieces: (key, first id, ids)."""
    node, first, ids, size = None, None, [], 0
    schema = pa.schema([("depth", pa.int64()), ("ka", pa.int64()), ("kb", pa.int64()), ("first", pa.int64()), ("ids", pa.string())])
    for b in batches:
        out = []
        for *key, conv in zip(*(b.column(c).to_pylist() for c in (*KEY, "conv_id"))):
            if key != node or size > CHUNK:
                if ids:
                    out.append((*node, first, ",".join(ids)))
                node, first, ids, size = key, conv, [], 0
            ids.append(str(conv))
            size += len(ids[-1]) + 1
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out) if out else [[]] * 5, schema)], schema=schema)
    if ids:
        yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((*node, first, ",".join(ids)), schema)], schema=schema)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the pieces of each node, which follow each other."""
    node, digest = None, None
    schema = pa.schema([("depth", pa.int64()), ("ka", pa.int64()), ("kb", pa.int64()), ("ends_sha256", pa.string())])
    for b in batches:
        out = []
        for *key, ids in zip(*(b.column(c).to_pylist() for c in (*KEY, "ids"))):
            if key != node:
                if node is not None:
                    out.append((*node, digest.hexdigest()))
                node, digest = key, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out) if out else [[]] * 4, schema)], schema=schema)
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((*node, digest.hexdigest()), schema)], schema=schema)


def _bound(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if id_bound(df, BROADCAST_NODES) else df


def _totals(nodes: DataFrame, limit: int) -> DataFrame:
    return nodes.sortWithinPartitions(F.desc("depth"), "ka", "kb").mapInArrow(
        trimmed(subtree_totals(limit)),
        "depth long, ka long, kb long, pa long, pb long, conv_id long, n long, top boolean, n_children long, n_leaves long, saved long",
    )


def prefix_trie(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    every: int = 20, most: int = 4, shard: int | None = None, in_memory: int = IN_MEMORY,
) -> DataFrame:
    """Per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256.

    shard: members of a shard's root at most (default: the root of the number of
    turns); in_memory: messages of a queue before it spills.
    """
    turns = keyed(rebuilt(rows, conv_col, turn_col, role_col, text_col, every, most))
    nodes = durable(
        turns.groupBy(*KEY).agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id"), F.first("pa").alias("pa"), F.first("pb").alias("pb"), F.first("words").alias("words"))
    )
    none = lambda *names: {x: F.lit(0).cast("long") for x in names}
    nodes = nodes.withColumn("gain", (F.col("n") - 1) * F.col("words")).drop("words")
    shard = shard or max(1, isqrt(nodes.agg(F.sum("n")).first()[0] or 0))

    upper = durable(nodes.where(F.col("n") > shard))  # fewer than turns / shard
    # a conversation's highest node that isn't above the shards is the root of the shard of all nodes it is the smallest member of
    roots = turns.join(_bound(upper.select(KEY)), KEY, "left_anti").groupBy("conv_id").agg(F.min(F.struct(*KEY)).alias("root"))
    inner = nodes.where(F.col("n") <= shard).join(roots, "conv_id").withColumns(none("children", "leaves", "saved"))
    inner = inner.withColumn("top", F.col("root.depth") == F.col("depth"))
    lower = durable(_totals(inner.repartition("root"), in_memory))

    sent = (
        lower.where("top and depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("pa").alias("ka"), F.col("pb").alias("kb"))
        .agg(F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved").alias("saved"))
    )
    above = upper.join(sent, KEY, "left").na.fill(0, ["children", "leaves", "saved"]).withColumn("top", F.col("depth") == 0)
    above = durable(_totals(above.repartition(1), in_memory))  # fewer than turns / shard rows, in a stream

    ends = turns.where("depth = length").select(*KEY, "conv_id").orderBy(*KEY, "conv_id").mapInArrow(_chunks, "depth long, ka long, kb long, first long, ids string")
    ends = ends.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(_digests, "depth long, ka long, kb long, ends_sha256 string")

    up = lambda df: df.select((F.col("depth") + 1).alias("depth"), F.col("ka").alias("pa"), F.col("kb").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    under = above.unionByName(lower.where("top")).join(_bound(up(upper)), ["depth", "pa", "pb"], "left")  # children of nodes above the shards, and the root
    within = lower.where("not top").join(up(lower), ["depth", "pa", "pb"])  # a parent in a shard has at most `shard` children
    return under.unionByName(within).join(ends, KEY, "left").select(
        "conv_id", "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
