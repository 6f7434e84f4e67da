"""SimHash near-duplicates linked with the help of pivot distance tables.

Every distinct fingerprint gets a table row: its Hamming distances to PIVOTS
reference fingerprints. By the triangle inequality two fingerprints within k
bits have no coordinate that differs by more than k, so pairs with a larger
maximum coordinate difference are thrown out and only survivors are verified.

Which pairs are looked at: fingerprints are brought together by an exact
pigeonhole. With the 64 bits in m blocks, two that differ in at most k bits
agree on some m - k whole blocks. Each choice of blocks is a key; a group
of equal keys meets in one run of a sorted partition, never as a join of all its pairs:
inside, components are grown from a frontier against what isn't linked yet, and
only a spanning forest leaves the task.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablexport.llm.common import components, cut

SEED = 42
BITS = 64
PIVOTS = tuple(xxhash.xxh64_intdigest(f"pivot {i}".encode(), SEED) for i in range(16))
SLICE = 1 << 18  # shingles hashed at a time


def fingerprint(text: str | None, length: int = 4) -> int:
    """The unsigned fingerprint of a whole text; no words: 0."""
    raw = (text or "").encode("utf-8", "surrogatepass").lower()  # bytes: A-Z alone
    words = raw.split()  # bytes: ASCII white space alone
    if not words:
        return 0
    if len(words) <= length:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:len(words) - length + 1].tolist()
    ends = ends[length - 1:].tolist()
    ones, n = np.zeros(BITS, np.int64), len(starts)
    for k in range(0, n, SLICE):
        h = np.array([digest(joined[s:e], SEED) for s, e in zip(starts[k:k + SLICE], ends[k:k + SLICE])], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > n, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(text: Column, length: int = 4) -> Column:
    """Signed 64-bit fingerprints of whole texts; null and empty texts: 0."""
    def batch(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, length) for t in texts], np.uint64).view(np.int64))

    batch.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return F.pandas_udf(batch, "long")(text)


def masks(n: int, k: int) -> list:
    """Bit masks such that two fingerprints within k bits are equal under one of them at least.

    The number of blocks follows the number of fingerprints, so that a key has
    about as many bits as it takes to tell them apart; any number is exact."""
    for m in range(k + 1, 17):
        edges = [BITS * i // m for i in range(m + 1)]
        blocks = [(1 << edges[i + 1]) - (1 << edges[i]) for i in range(m)]
        if 2 ** (BITS * (m - k) // m) >= n or m == k + 4:
            break
    return [sum(c) for c in combinations(blocks, m - k)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _packed_distances(fp: str) -> list:
    """Two longs that hold the distances to the pivots, a byte each."""
    return ["|".join(f"shiftleft(cast(bit_count({fp} ^ {_signed(p)}L) as bigint), {8 * i})" for i, p in enumerate(PIVOTS[h:h + 8]))
            for h in (0, 8)]


def _grow(fp: np.ndarray, table: np.ndarray, k: int):
    """Spanning forest of the links within one group: (from, to) positions.

    A frontier row is held against the rows that no component has yet: first
    by the pivot table, coordinate by coordinate, then by the bits."""
    left = np.arange(len(fp))
    while len(left) > 1:
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            x = frontier.pop()
            near = left
            for c in range(table.shape[1]):
                near = near[np.abs(table[near, c] - table[x, c]) <= k]
                if not len(near):
                    break
            near = near[np.bitwise_count(fp[near] ^ fp[x]) <= k]
            if len(near):
                for y in near:
                    yield x, y
                frontier += near.tolist()
                left = np.setdiff1d(left, near, assume_unique=True)


def _link_runs(batches, k: int):
    """Sorted rows (mask, key, fp, d0, d1): the links inside each run of equal (mask, key).

    A run that a batch cuts is carried over; runs of one row cost nothing."""
    names = ("mask", "key", "fp", "d0", "d1")
    held = None
    for batch in _and_end(batches):
        if batch is not None:
            got = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            held = got if held is None else [np.concatenate(x) for x in zip(held, got)]
        if held is None or not len(held[0]):
            continue
        mask, key = held[0], held[1]
        new = np.flatnonzero((mask[1:] != mask[:-1]) | (key[1:] != key[:-1])) + 1
        starts = np.concatenate(([0], new))
        ends = np.concatenate((new, [len(mask)]))
        if batch is not None:  # the last run may go on
            cut_at = starts[-1]
            starts, ends = starts[:-1], ends[:-1]
        else:
            cut_at = len(mask)
        fp = held[2].view(np.uint64)
        table = np.ascontiguousarray(np.stack(held[3:5], axis=1)).view(np.uint8).reshape(len(fp), 16).astype(np.int16)
        a, b = [], []
        for s, e in zip(starts[ends - starts > 1], ends[ends - starts > 1]):
            for x, y in _grow(fp[s:e], table[s:e], k):
                a.append(held[2][s + x])
                b.append(held[2][s + y])
        held = [x[cut_at:] for x in held]
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    del names


def _and_end(batches):
    yield from batches
    yield None


def link(fps: DataFrame, k: int) -> DataFrame:
    """Links (a, b) that join every two distinct fingerprints ``fp`` within ``k`` bits, directly or over others."""
    n = fps.count()
    keys = masks(n, k)
    spark = fps.sparkSession
    d0, d1 = _packed_distances("fp")
    table = fps.selectExpr("fp", f"{d0} as d0", f"{d1} as d1")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n * len(keys) // 2_000_000)
    rows = (table.select(F.posexplode(F.array(*[F.expr(f"fp & {_signed(m)}L") for m in keys])).alias("mask", "key"), "fp", "d0", "d1")
            .repartition(parts, "mask", "key").sortWithinPartitions("mask", "key"))
    return rows.mapInArrow(lambda batches: _link_runs(batches, k), "a long, b long")


def near_duplicates(docs: DataFrame, length: int = 4, k: int = 4) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, fingerprint (16 hex digits), component_id.

    component_id is the smallest doc_id among all rows that links of at most
    ``k`` bits reach. Null and empty texts have fingerprint zero and link like
    any other; null ids get rows but are never the smallest (a component of null ids
    alone has a null id); repeated rows are each returned. Other columns of
    ``docs`` are not read."""
    prints = cut(docs.select("doc_id", fingerprints(F.col("text"), length).alias("fp")))
    own = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    found = components(link(own.select("fp"), k))
    least = own.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component"))
    lowest = least.groupBy("component").agg(F.min("first").alias("component_id"))
    named = least.join(lowest, "component").select("fp", "component_id")
    return prints.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, length: int = 4, k: int = 4) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their component, same columns.

    Rows without an id stay: nothing smaller can be named for them, and they replace no one."""
    gone = (near_duplicates(docs, length, k).where("doc_id is not null and component_id <> doc_id")
            .select("doc_id").distinct())
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
