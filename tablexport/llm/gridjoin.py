"""Embedding near-duplicates by an epsilon grid order join.

Vectors of length one have a cosine of c exactly if they are eps = sqrt(2 - 2c) apart. They are
turned on to the principal axes of the corpus, given grid cells of side eps on the leading
ones, and sorted by label and cells: the epsilon grid order. The sequence is cut into tiles of TILE vectors, and
intervals of tiles are joined recursively: two intervals whose boxes (leading coordinates, and the norm of
the rest) lie more than eps apart hold no link and are skipped, others are split FAN ways.
Two tiles that remain are joined by the same recursion inside a task, down to LEAF vectors, where cosines of
the original vectors decide.

Equal vectors of a label count as one with a weight. A task puts out how many vectors each of its vectors links with
and a spanning forest of the links, never the pairs; so a group of copies costs time in proportion to
the pairs of its distinct vectors, but rows in proportion to those alone. Tile pairs are dealt out in parts of PARTNERS, so no label is one task's.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablexport.llm.common import components, cut, forget

LEADING = 8  # principal dimensions that make cells and boxes
TILE = 1024
LEAF = 128
FAN = 16
PARTNERS = 8  # tiles that a task's tile meets
SLACK = 1e-9  # boxes, and cosines by matrix product, are this far from exact at most; closer ones are computed again
_SHIFT = 33


def usable(vector: Column) -> Column:
    """Neither null nor empty nor zero, every component there and finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as float64."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that no square overflows or vanishes."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _same_length(batches):
    """(length, record batch): a batch's rows by the length of their vectors."""
    for batch in batches:
        n = batch.column("vector").value_lengths().to_numpy(zero_copy_only=False)
        for length in np.unique(n):
            yield int(length), batch.filter(pa.array(n == length))


def principal_axes(vectors: DataFrame, dims: int) -> np.ndarray:
    """The leading eigenvectors (columns) of the covariance of all unit vectors of ``dims`` components.

    A task sums outer products; their sum, dims * dims numbers whatever the number of rows, comes to the driver."""
    def sums(batches):
        total, mean, n = np.zeros((dims, dims)), np.zeros(dims), 0
        for length, batch in _same_length(batches):
            if length == dims:
                x = unit(_matrix(batch.column("vector")))
                total, mean, n = total + x.T @ x, mean + x.sum(axis=0), n + len(x)
        if n:
            for i in range(dims):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(dims, i)), pa.array(np.arange(dims)), pa.array(total[i]), pa.array(np.full(dims, mean[i])), pa.array(np.full(dims, n))], ["i", "j", "product", "total", "n"])

    parts = vectors.select("vector").mapInArrow(sums, "i long, j long, product double, total double, n long")
    got = parts.groupBy("i", "j").agg(F.sum("product").alias("product"), F.sum("total").alias("total"), F.sum("n").alias("n")).orderBy("i", "j").toArrow()
    product, total, n = got["product"].to_numpy().reshape(dims, dims), got["total"].to_numpy().reshape(dims, dims)[:, 0], got["n"].to_numpy()[0]
    mean = total / n
    return np.linalg.eigh(product / n - np.outer(mean, mean))[1][:, ::-1][:, :LEADING]


def _placed(vectors: DataFrame, axes: dict, eps: float) -> DataFrame:
    """``vectors`` with dims, lead (leading coordinates and the norm of the rest) and cells (their grid cells)."""
    names = [f.name for f in vectors.schema]

    def batches(parts):
        for length, part in _same_length(parts):
            x = unit(_matrix(part.column("vector")))
            lead = x @ axes[length]
            rest = np.sqrt(np.maximum(0, 1 - np.einsum("ij,ij->i", lead, lead)))
            lead = np.column_stack([lead, rest])
            lists = lambda v, kind: pa.FixedSizeListArray.from_arrays(pa.array(v.ravel(), kind), v.shape[1]).cast(pa.list_(kind))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.full(len(x), length, np.int32)), lists(lead, pa.float64()),
                                              lists(np.floor(lead / eps).astype(np.int32), pa.int32())], [*names, "dims", "lead", "cells"])

    return vectors.mapInArrow(batches, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vectors.schema) + ", dims int, lead array<double>, cells array<int>")


def _sequence(placed: DataFrame) -> DataFrame:
    """``placed`` in epsilon grid order, with tile (consecutive numbers) and at (place in the tile)."""
    order = ["dims", "label", "cells", "id"]
    rows = cut(placed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("row", F.monotonically_increasing_id()))
    part, at = F.shiftright("row", _SHIFT), F.col("row").bitwiseAND(F.lit((1 << _SHIFT) - 1))
    before, offsets = 0, [F.lit(-1), F.lit(0).cast("long")]
    for r in rows.groupBy(part.alias("part")).agg(F.max(at).alias("last")).orderBy("part").collect():  # a row for each partition
        offsets += [F.lit(int(r["part"])), F.lit(before).cast("long")]
        before += r["last"] // TILE + 1
    tile = F.element_at(F.create_map(*offsets), part.cast("int")) + F.expr(f"shiftright(row & {(1 << _SHIFT) - 1}L, {TILE.bit_length() - 1})")
    return rows.withColumn("tile", tile).withColumn("at", at.bitwiseAND(F.lit(TILE - 1)).cast("int")).drop("row", "cells")


def tile_pairs(rows: DataFrame, eps: float) -> DataFrame:
    """dims, label, a, b (a <= b): the pairs of tiles that the boxes don't rule out, by recursion from intervals of many tiles.

    A tile in which two labels meet counts as a tile of each."""
    lead = [F.get("lead", F.lit(i)) for i in range(LEADING + 1)]
    boxes = cut(rows.groupBy("dims", "label", "tile").agg(*[F.min(x).alias(f"lo{i}") for i, x in enumerate(lead)], *[F.max(x).alias(f"hi{i}") for i, x in enumerate(lead)]))
    most = boxes.agg(F.max("tile")).first()[0] or 0
    height = 0
    while most >> (height * (FAN.bit_length() - 1)):
        height += 1
    # the smallest gap between two boxes; coordinates that vectors of fewer dimensions lack are null in both
    gap = " + ".join(f"coalesce(pow(greatest(0D, a.lo{i} - b.hi{i}, b.lo{i} - a.hi{i}), 2), 0D)" for i in range(LEADING + 1))
    pairs = boxes.select("dims", "label").distinct().select("dims", "label", F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))
    step = FAN.bit_length() - 1
    for level in reversed(range(height)):
        at = F.shiftright("tile", level * step)
        box = boxes.groupBy("dims", "label", at.alias("tile")).agg(*[f(f"{c}{i}").alias(f"{c}{i}") for i in range(LEADING + 1) for c, f in (("lo", F.min), ("hi", F.max))])
        box = box.withColumn("up", F.shiftright("tile", step))
        near = (F.col("a.tile") <= F.col("b.tile")) & F.expr(f"{gap} <= {eps * eps + SLACK!r}D")
        same = lambda x, y: (F.col(f"{x}.dims") == F.col(f"{y}.dims")) & F.col(f"{x}.label").eqNullSafe(F.col(f"{y}.label"))
        pairs = (pairs.alias("p").join(box.alias("a"), same("p", "a") & (F.col("p.a") == F.col("a.up")))
                 .join(box.alias("b"), same("p", "b") & (F.col("p.b") == F.col("b.up")) & near)
                 .select("p.dims", "p.label", F.col("a.tile").alias("a"), F.col("b.tile").alias("b")))
        pairs = cut(pairs)
    return pairs


# ------------------------------------------------------------------ inside a task
class _Links:
    """How much each row of a part links with, and a forest of the links (rows are numbered as they come)."""

    def __init__(self):
        self.count = np.zeros(0, np.int64)
        self.parent = np.zeros(0, np.int64)
        self.forest = []

    def grow(self, n: int) -> int:
        start = len(self.parent)
        self.count = np.concatenate([self.count, np.zeros(n, np.int64)])
        self.parent = np.concatenate([self.parent, np.arange(start, start + n)])
        return start

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def joined(self, hits: np.ndarray, a: np.ndarray, b: np.ndarray):
        """Join row a[i] with the rows b[hits[i]]: of each row one link, and of what they tie together the rest."""
        for i in np.flatnonzero(hits.any(axis=1)):
            own = self.root(a[i])
            others = b[hits[i]]
            for x in others[self.parent[others] != own]:
                r = self.root(x)
                if r != own:
                    self.forest.append((a[i], x))
                    self.parent[r] = own
                self.parent[x] = own


def _gap(lo_a, hi_a, lo_b, hi_b) -> float:
    d = np.maximum(0, np.maximum(lo_a - hi_b, lo_b - hi_a))
    return float(d @ d)


def _hits(x: np.ndarray, y: np.ndarray, least: float) -> np.ndarray:
    """Which rows of unit vectors have a cosine of ``least`` or more; those at the border are computed one by one."""
    cos = x @ y.T
    out = cos >= least
    for i, j in zip(*np.nonzero(np.abs(cos - least) <= SLACK)):
        out[i, j] = float(np.sum(x[i] * y[j], dtype=np.longdouble)) >= least
    return out


def join_tiles(a: tuple, b: tuple, least: float, eps: float, links: _Links, same: bool) -> int:
    """Link the rows of two tiles (vectors, lead, weights, numbers in ``links``); how many pairs were looked at."""
    (xa, la, wa, na), (xb, lb, wb, nb) = a, b
    looked, todo = 0, [(0, len(xa), 0, len(xb))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        if a1 <= a0 or b1 <= b0 or same and b1 <= a0:
            continue
        if _gap(la[a0:a1].min(axis=0), la[a0:a1].max(axis=0), lb[b0:b1].min(axis=0), lb[b0:b1].max(axis=0)) > eps * eps + SLACK:
            continue
        if a1 - a0 > LEAF or b1 - b0 > LEAF:  # the same halves of both, so that a tile with itself meets each two parts once
            am, bm = (a0 + a1) // 2, (b0 + b1) // 2
            todo += [(a0, am, b0, bm), (a0, am, bm, b1), (am, a1, bm, b1)]
            if not same or b0 >= a1:
                todo.append((am, a1, b0, bm))
            continue
        hits = _hits(xa[a0:a1], xb[b0:b1], least)
        looked += hits.size
        if same and a0 == b0:
            hits = np.triu(hits, 1)
        if hits.any():
            np.add.at(links.count, na[a0:a1], hits @ wb[b0:b1])
            np.add.at(links.count, nb[b0:b1], wa[a0:a1] @ hits)
            links.joined(hits, na[a0:a1], nb[b0:b1])
    return looked


def _part(batches, least: float, eps: float):
    """Rows sorted by (label, a, part, b, at): tile a comes first, then each tile that it meets."""
    def tiles():
        key, held = None, []
        for batch in batches:
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("group", "b")]
            new = np.flatnonzero((columns[0][1:] != columns[0][:-1]) | (columns[1][1:] != columns[1][:-1])) + 1
            for s, e in zip([0, *new], [*new, batch.num_rows]):
                if e <= s:
                    continue
                this = (columns[0][s], columns[1][s])
                if this != key and held:
                    yield key, pa.Table.from_batches(held)
                    held = []
                key = this
                held.append(batch.slice(s, e - s))
        if held:
            yield key, pa.Table.from_batches(held)

    def out(ids, links):
        n = len(ids)
        a = ids[[x for x, _ in links.forest]] if links.forest else np.zeros(0, np.int64)
        b = ids[[y for _, y in links.forest]] if links.forest else np.zeros(0, np.int64)
        some = np.flatnonzero(links.count[:n])
        yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.nulls(len(some), pa.int64()), pa.array(links.count[some])], ["id", "other", "n_links"])
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.nulls(len(a), pa.int64())], ["id", "other", "n_links"])

    group, own, links, ids = None, None, None, None
    for (this, _), rows in tiles():
        rows = rows.combine_chunks()
        x = unit(_matrix(rows["vector"].chunk(0)))
        lead, w, new = _matrix(rows["lead"].chunk(0)), rows["w"].to_numpy(), rows["id"].to_numpy()
        if this != group:
            if links is not None:
                yield from out(ids, links)
            group, links, ids = this, _Links(), new
            start = links.grow(len(new))
            own = (x, lead, w, np.arange(start, start + len(new)))
            if rows["a"][0].as_py() == rows["b"][0].as_py() and rows["part"][0].as_py() == 0:
                join_tiles(own, own, least, eps, links, True)
            continue
        start = links.grow(len(new))
        ids = np.concatenate([ids, new])
        join_tiles(own, (x, lead, w, np.arange(start, start + len(new))), least, eps, links, False)
    if links is not None:
        yield from out(ids, links)


def link(vectors: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """((id, n_links), (a, b)): of distinct usable ``vectors`` (id, label, w, vector) the weight that each links with, and links that join all that are linked."""
    eps = float(np.sqrt(max(0.0, 2 - 2 * least)))
    sizes = [r["n"] for r in vectors.select(F.size("vector").alias("n")).distinct().collect()]  # lengths of vectors, as a rule one
    axes = {n: principal_axes(vectors, n) for n in sizes}
    rows = cut(_sequence(_placed(vectors, axes, max(eps, 1e-6))))
    pairs = tile_pairs(rows, eps)
    # each part of a tile's partners brings the tile itself first
    part = F.floor((F.col("b") - F.col("a")) / PARTNERS).cast("long")
    pairs = pairs.withColumn("part", part)
    units = pairs.select("dims", "label", "a", "part").distinct()
    pairs = pairs.where("a <> b").select("dims", "label", "a", "part", "b").unionByName(units.withColumn("b", F.col("a")))
    pairs = pairs.withColumn("group", F.xxhash64("dims", "label", "a", "part"))
    tiles = rows.select(F.col("dims").alias("d"), F.col("label").alias("l"), F.col("tile").alias("t"), "id", "w", "vector", "lead", "at")
    dealt = pairs.join(tiles, (F.col("dims") == F.col("d")) & F.col("label").eqNullSafe(F.col("l")) & (F.col("b") == F.col("t")))
    dealt = dealt.select("group", "a", "part", "b", "at", "id", "w", "vector", "lead").repartition("group").sortWithinPartitions("group", "b", "at")
    got = cut(dealt.mapInArrow(lambda x: _part(x, least, eps), "id long, other long, n_links long"))
    forget(rows)
    return got.where("n_links is not null").groupBy("id").agg(F.sum("n_links").alias("n_links")), got.where("other is not null").select(F.col("id").alias("a"), F.col("other").alias("b"))


def near_duplicates(rows: DataFrame, least: float = 0.98) -> DataFrame:
    """One row per row of ``rows`` (vec_id, embedding, label): vec_id, n_links, component_id, kept.

    Two vectors of one label, not null, link if their cosine in double precision is ``least`` or more.
    n_links: the other rows that a row links with directly; component_id: the smallest vec_id that it
    reaches, its own included; kept: vec_id = component_id. Vectors that are null, empty or zero, that hold a null or
    non-finite component, or whose label is null link with nothing; vectors of different lengths don't link. Repeated
    rows are vectors of their own. A null vec_id links like any other, but is never the smallest: its component_id is null, and it is
    kept, if it reaches no vector with an id. Other columns are not read."""
    rows = cut(rows.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").alias("vector"),
                           (usable(F.col("embedding")) & F.col("label").isNotNull()).alias("fits")))
    vector = F.col("vector").cast("array<double>")
    key = F.struct("label", F.md5(F.concat_ws(",", F.transform(vector, lambda x: F.hex(x.cast("string").cast("binary")))).cast("binary")).alias("digest"))
    one = rows.where("fits").withColumn("key", key)
    distinct = one.groupBy("key").agg(F.min("vec_id").alias("first"), F.count("*").alias("w"), F.first("vector").alias("vector"))
    distinct = cut(distinct.withColumn("id", F.monotonically_increasing_id()))
    counts, edges = link(distinct.select("id", F.col("key.label").alias("label"), "w", vector.alias("vector")), least)
    parts = components(edges).withColumnRenamed("node", "id")
    named = distinct.select("id", "key", "first", "w").join(parts, "id", "left").withColumn("component", F.coalesce("component", "id"))
    lowest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    named = cut(named.join(lowest, "component").join(counts, "id", "left").select(
        "key", "component_id", (F.coalesce("n_links", F.lit(0)) + F.col("w") - 1).alias("n_links")))
    linked = one.join(named, "key").select("vec_id", "n_links", "component_id")
    alone = rows.where(~F.col("fits")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def oracle_sql(table: str = "embeddings", least: float = 0.98) -> str:
    """DuckDB SQL of ``near_duplicates`` where vec_id is unique and not null: every pair of a label."""
    return f"""
WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM {table}),
u AS (SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS n FROM v WHERE label IS NOT NULL AND e IS NOT NULL
    AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    WHERE list_dot_product(a.e, b.e) / (a.n * b.n) >= {least}),
r AS (SELECT vec_id AS x, vec_id AS y FROM v UNION SELECT r.x, l.b FROM r JOIN l ON r.y = l.a),
c AS (SELECT x, min(y) AS component_id FROM r GROUP BY x), n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept FROM v JOIN c ON vec_id = x LEFT JOIN n ON vec_id = a"""
