"""Trie of conversation prefixes by a van Emde Boas recursion.

Sequences are cut at half the depth. A cut prefix is named by its top's name and the
name of the block of turns up to the cut; equal names are one cut node. The upper trie is then built
from one representative of each cut prefix (with the number of sequences that it
stands for), the lower forests from what follows the cut, below the cut node as their top; both
go on in the same jobs, so a trie of depth D takes log2 D rounds. Names of blocks of
2, 4, 8 ... turns are made beforehand from the names of their halves. Every depth is cut
exactly once: an odd depth last, a multiple of 2 ** k in round k.

Totals are grafted upward the same way: the total of a lower forest is handed to the cut
node and from it to the top of its interval, smallest intervals first; what a
cut node has been handed holds for the whole stretch of nodes above it, and is then dealt out
to the halves of that stretch, largest first. Each step is an aggregation over nodes and
one equi-join, so work is in proportion to the nodes.

Names are MD5 values of the names they are made from: equal sequences, and in practice no others, share one.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablexport.llm.common import cut, forget

ROOT = bytes(16)  # the root's name
SEGMENT = 4096  # numbers joined to one text before they are hashed in order
NO_MEMBER_ENDS = hashlib.sha256(b"").hexdigest()
_SHIFT = 33  # monotonically_increasing_id: partition above, row below


def _digest(*parts: Column) -> Column:
    """16 bytes for a tuple of binaries; each is preceded by its length."""
    sized = [x for p in parts for x in (F.lpad(F.hex(F.octet_length(p)), 8, "0").cast("binary"), p)]
    return F.unhex(F.md5(F.concat(*sized)))


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, at (from 0), key (16 bytes for role and text), size (code points of the text).

    Turns are ordered by turn, null first, equal ones by role and text; null roles and
    texts are empty; rows without a conv_id belong to no conversation and are left out; repeated rows
    are turns of their own. The place in a conversation comes from one range-partitioned sort, so
    a conversation may be longer than a task can hold."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", text("role").alias("role"), text("text").alias("text"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = cut(rows.select("conv_id", _digest(F.col("role").cast("binary"), F.col("text").cast("binary")).alias("key"),
                           F.length("text").cast("long").alias("size"), F.monotonically_increasing_id().alias("row")))
    part = F.shiftright("row", _SHIFT)
    before, offsets = 0, [F.lit(-1), F.lit(0).cast("long")]
    for r in rows.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect():  # a row for each partition
        offsets += [F.lit(int(r["part"])), F.lit(before).cast("long")]
        before += r["n"]
    place = F.element_at(F.create_map(*offsets), part.cast("int")) + F.col("row").bitwiseAND(F.lit((1 << _SHIFT) - 1))
    rows = rows.select("conv_id", "key", "size", place.alias("place"))
    first = rows.groupBy("conv_id").agg(F.min("place").alias("first"))
    return rows.join(first, "conv_id").select("conv_id", (F.col("place") - F.col("first")).alias("at"), "key", "size")


def with_shared_heads(turns: DataFrame, every: int = 100, heads: int = 6) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations) rebuilt: conversation c gets the first h turns of c - c % every, then its own after its first h.

    h is the CRC-32 of the decimal c modulo ``heads``. conversations: conv_id, length (0 too)."""
    turns = cut(turns)
    h = F.expr(f"crc32(cast(cast(conv_id as string) as binary)) % {heads}")
    base = F.expr(f"conv_id - conv_id % {every}")
    head = turns.where((F.col("at") < heads - 1) & (F.col("conv_id") % every == 0))
    there = head.groupBy(F.col("conv_id").alias("base")).agg(F.count("*").alias("there"))
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("n")).select("conv_id", "n", h.alias("h"), base.alias("base")).join(there, "base", "left")
    convs = convs.withColumn("given", F.least("h", F.coalesce("there", F.lit(0)))).select(
        "conv_id", "base", "h", "given", (F.col("given") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))
    convs = cut(convs)
    own = turns.join(convs.select("conv_id", "h", "given"), "conv_id").where(F.col("at") >= F.col("h")).select(
        "conv_id", (F.col("at") - F.col("h") + F.col("given")).alias("at"), "key", "size")
    given = convs.select("conv_id", "base", "given").join(head.withColumnRenamed("conv_id", "base"), "base").where(F.col("at") < F.col("given")).select(
        "conv_id", "at", "key", "size")
    return cut(own.union(given)), convs.select("conv_id", "length")


def _blocks(turns: DataFrame, levels: int) -> list[DataFrame]:
    """For k = 0, 1, ...: conv_id, block, name of the whole blocks of 2 ** k turns."""
    out = [turns.select("conv_id", F.col("at").alias("block"), F.col("key").alias("name"))]
    for _ in range(1, levels):
        low = out[-1].where("block % 2 = 0").select("conv_id", F.shiftright("block", 1).alias("block"), F.col("name").alias("a"))
        high = out[-1].where("block % 2 = 1").select("conv_id", F.shiftright("block", 1).alias("block"), F.col("name").alias("b"))
        out.append(cut(low.join(high, ["conv_id", "block"]).select("conv_id", "block", _digest(F.col("a"), F.col("b")).alias("name"))))
    return out


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _shape(turns: DataFrame, convs: DataFrame, levels: int):
    """(nodes, splits, ends) of each round k, by descending k in the recursion.

    nodes[k]: name, depth, top (the node 2 ** k above), conv_id (smallest member), n (members);
    splits[k]: bottom, name (the node 2 ** k above it); ends: name, conv_id of the conversations that end there."""
    blocks = _blocks(turns, levels)
    root = F.lit(ROOT)
    rows = convs.where("length > 0").select(F.lit(0).cast("long").alias("lo"), root.alias("top"), "conv_id", F.lit(1).cast("long").alias("n"),
                                            F.col("length").alias("left"), F.lit(None).cast("binary").alias("bottom"))
    nodes, splits, ends, done = [None] * levels, [None] * levels, [convs.where("length = 0").select(root.alias("name"), "conv_id")], []
    for k in reversed(range(levels)):
        half = 1 << k
        block = blocks[k].select("conv_id", F.col("block").alias("at"), F.col("name").alias("block"))
        long = rows.where(F.col("left") >= half).withColumn("at", F.shiftright("lo", k)).join(block, ["conv_id", "at"])
        named = cut(long.select("lo", "top", "conv_id", "n", "left", "bottom", _digest(F.col("top"), F.col("block")).alias("name")))
        nodes[k] = cut(named.groupBy("name", "lo", "top").agg(F.min("conv_id").alias("conv_id"), F.sum("n").alias("n")).select(
            "name", (F.col("lo") + half).alias("depth"), "top", "conv_id", "n"))
        ends.append(named.where(F.col("left") == half).select("name", "conv_id"))
        splits[k] = named.where("bottom is not null").select("bottom", "name")
        upper = nodes[k].select((F.col("depth") - half).alias("lo"), "top", "conv_id", "n", F.lit(half).cast("long").alias("left"), F.col("name").alias("bottom"))
        lower = named.where(F.col("left") > half).select((F.col("lo") + half).alias("lo"), F.col("name").alias("top"), "conv_id", "n", (F.col("left") - half).alias("left"), "bottom")
        done.append(rows := cut(_union([rows.where(F.col("left") < half), upper, lower])))
    forget(*done, *blocks[1:])
    return nodes, splits, _union(ends)


def _totals(own: list[DataFrame], nodes: list[DataFrame], splits: list[DataFrame], values: list[str]) -> DataFrame:
    """name, values summed over the subtree of each node; own[k]: name, values of the nodes of round k."""
    sums = [F.sum(v).alias(v) for v in values]
    handed, grafted, old = None, [], []
    for k, node in enumerate(nodes):
        half = 1 << k
        mine = own[k] if handed is None else _union([own[k], handed.where(F.col("depth").bitwiseAND(F.lit(2 * half - 1)) == half).select("name", *values)])
        grafted.append(cut(node.select("name", "depth", "top").join(mine.groupBy("name").agg(*sums), "name")))
        up = grafted[k].select(F.col("top").alias("name"), (F.col("depth") - half).alias("depth"), *values)
        rest = [] if handed is None else [handed.where(F.col("depth").bitwiseAND(F.lit(2 * half - 1)) != half)]
        handed = cut(_union([up, *rest]).groupBy("name", "depth").agg(*sums))
        old.append(handed)
    dealt = None
    for k in reversed(range(len(nodes))):
        parts = [grafted[k].select("name", *values)]
        if dealt is not None:
            parts += [dealt, splits[k].join(dealt.withColumnRenamed("name", "bottom"), "bottom").select("name", *values)]
        dealt = cut(_union(parts).groupBy("name").agg(*sums))
        old.append(dealt)
    out = cut(dealt.union(handed.where("depth = 0").select("name", *values)))
    forget(*old, *grafted)
    return out


def _segments(batches):
    """Sorted (name, conv_id): SEGMENT numbers of one name at a time as text."""
    name, held = None, []
    for batch in batches:
        rows = []
        for n, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if held and (n != name or len(held) == SEGMENT):
                rows.append((name, held[0], ",".join(map(str, held))))
                held = []
            name = n
            held.append(c)
        if rows:
            yield _batch(rows, pa.int64())
    if held:
        yield _batch([(name, held[0], ",".join(map(str, held)))], pa.int64())


def _batch(rows, kind):
    a, b, c = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, kind), pa.array(c, pa.string())], ["name", "first", "text"])


def _hashed(batches):
    """Sorted (name, first, text): the SHA-256 of each name's texts, comma-joined; nothing but the hash's state is held."""
    name, state = None, None
    out = lambda: pa.RecordBatch.from_arrays([pa.array([name], pa.binary()), pa.array([state.hexdigest()])], ["name", "ends_sha256"])
    for batch in batches:
        for n, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if n != name:
                if state:
                    yield out()
                name, state = n, hashlib.sha256()
            else:
                state.update(b",")
            state.update(text.encode())
    if state:
        yield out()


def ends_digests(ends: DataFrame) -> DataFrame:
    """name, ends_sha256: of the ascending decimal conv_ids of each name.

    A node at which a third of all conversations end is sorted in many range partitions and reaches
    the task that hashes it as a few long texts."""
    ends = ends.repartitionByRange("name", "conv_id").sortWithinPartitions("name", "conv_id")
    parts = ends.mapInArrow(_segments, "name binary, first long, text string")
    return parts.repartition("name").sortWithinPartitions("name", "first").mapInArrow(_hashed, "name binary, ends_sha256 string")


def trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """A row for each distinct sequence of first turns, the empty one included.

    ``turns`` (conv_id, at from 0 without gaps, key, size) and ``convs`` (conv_id, length, turnless ones
    too). Columns, long: conv_id (smallest member: conversations that start with the sequence), depth,
    parent_conv_id (null for the root), n_convs, n_children, n_leaves and saved_tokens (summed over the subtree:
    childless nodes; members but one times size of the last turn), and ends_sha256
    (of the members that end there). No conversations: no rows, not even a root."""
    turns, convs = cut(turns), cut(convs)
    whole = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n"), F.max("length").alias("deep")).first()
    if not whole["n"]:
        return convs.sparkSession.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    levels = int(whole["deep"] or 0).bit_length()
    top = convs.sparkSession.range(1).select(F.lit(ROOT).alias("name"), F.lit(0).cast("long").alias("depth"),
                                             F.lit(whole["conv_id"]).cast("long").alias("conv_id"), F.lit(whole["n"]).cast("long").alias("n"))
    nodes, splits, ends = _shape(turns, convs, levels)
    parents = [nodes[0].select("name", F.col("top").alias("parent")), splits[0].select(F.col("bottom").alias("name"), F.col("name").alias("parent"))] if levels else []
    parents = cut(_union(parents)) if levels else top.select("name", F.lit(None).cast("binary").alias("parent")).where("false")
    children = cut(parents.groupBy(F.col("parent").alias("name")).agg(F.count("*").alias("n_children")))
    own = []
    for node in nodes:
        last = turns.select("conv_id", (F.col("at") + 1).alias("depth"), "size")
        own.append(cut(node.join(last, ["conv_id", "depth"]).join(children, "name", "left").select(
            "name", F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("n_leaves"), ((F.col("n") - 1) * F.col("size")).alias("saved_tokens"))))
    if levels:
        totals = _totals(own, nodes, splits, ["n_leaves", "saved_tokens"])
        handed = totals
    else:
        handed = top.select("name", F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"))
    every = cut(_union([top, *[x.select("name", "depth", "conv_id", "n") for x in nodes]]))
    above = every.select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    above = parents.join(above, "parent").select("name", "parent_conv_id")
    out = every.join(handed, "name").join(above, "name", "left").join(children, "name", "left").join(ends_digests(ends), "name", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return out.select("conv_id", "depth", "parent_conv_id", F.col("n").alias("n_convs"), zero("n_children"), "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", F.lit(NO_MEMBER_ENDS)).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame, every: int = 100, heads: int = 6) -> DataFrame:
    """``trie`` of ``conversations`` (conv_id, turn, role, text) with shared heads; other columns are not read."""
    return trie(*with_shared_heads(ordered_turns(conversations), every, heads))


def oracle_sql(table: str = "conversations", every: int = 100, heads: int = 6) -> str:
    """DuckDB SQL of ``conversation_trie``: prefixes as lists, descendants by comparing lists."""
    return f"""
WITH crc AS (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b::BIGINT, range(8)),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END)) AS tab),
o AS (SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS l
    FROM {table} WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT conv_id, l, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(strlen(conv_id::VARCHAR)), lambda i: ascii(substr(conv_id::VARCHAR, i + 1, 1))::BIGINT)),
    lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295) % {heads} AS h FROM o, crc),
s AS (SELECT h.conv_id, list_concat(coalesce(b.l[1:h.h], []), h.l[h.h + 1:]) AS l FROM h LEFT JOIN o b ON b.conv_id = h.conv_id - h.conv_id % {every}),
p AS (SELECT conv_id, d, l[1:d] AS path, len(l) = d AS ends FROM (SELECT conv_id, l, unnest(range(len(l) + 1)) AS d FROM s)),
n AS (SELECT path, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends FROM p GROUP BY path, d),
c AS (SELECT path[1:depth - 1] AS path, depth - 1 AS depth, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1, 2),
f AS (SELECT n.*, coalesce(n_children, 0) AS n_children, CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * length(path[depth].t) END AS saved
    FROM n LEFT JOIN c USING (path, depth)),
t AS (SELECT x.path, x.depth, sum((y.n_children = 0)::BIGINT) AS n_leaves, sum(y.saved) AS saved FROM f x JOIN f y ON y.depth >= x.depth AND y.path[1:x.depth] = x.path GROUP BY 1, 2)
SELECT f.conv_id, f.depth, q.conv_id AS parent_conv_id, f.n_convs, f.n_children, t.n_leaves::BIGINT AS n_leaves, t.saved::BIGINT AS saved_tokens, f.ends AS ends_sha256
FROM f JOIN t USING (path, depth) LEFT JOIN f q ON f.depth > 0 AND q.depth = f.depth - 1 AND q.path = f.path[1:f.depth - 1]"""
