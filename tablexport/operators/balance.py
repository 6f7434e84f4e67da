"""Weight-balanced chunks (re-aimed from storage extents to any ordered key).

Given a table, an order key and a per-row weight (default: 1 per row),
keys are grouped into at most ``n`` contiguous key ranges of about equal
weight:

    cum(k)  = running sum of weight over keys <= k   (key order)
    grp(k)  = trunc((cum(k) - 0.01) / (total / n))

computed exactly with integers as ``(cum*100 - 1) * n div (total*100)``.
Per group: lo = first key, hi = last key, weight = sum. With a partition
column the whole computation restarts per partition value, partitions
taken in descending order, and chunk ids run on.

Scale: few keys move. One scan makes a mergeable sketch of the keys' quantiles, whose
about ``8 n`` cut points are bounds of coarse buckets (any bounds give the right answer). A second
gives weight, first and last key of each bucket with map-side aggregation: that many rows
per partition value. Only keys of buckets in which a group ends, at most n per partition value and
broadcast as such, are then aggregated one by one; the others lie in one group as a whole
and their keys are never shuffled. The group table has at most n rows per partition value, so assigning
rows is a range lookup: a log-depth CASE tree for few groups, for many a
join with each partition value's sorted bounds and a binary search in them.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import local_df

ACCURACY = 20_000  # of the quantile sketch: a rank is off by one part of so many at most
CASE_GROUPS = 2_000  # groups that are still told apart by a CASE expression
BROADCAST_ROWS = 100_000  # of cut buckets, of a few numbers each
WIDE = "decimal(38,0)"  # products beyond 64 bits stay whole numbers


def part_columns(part) -> list[str]:
    """Partition columns, outermost first, of one name, several or none."""
    return [part] if isinstance(part, str) else list(part or [])


def _part(part) -> Column:
    cols = [F.col(f"`{c}`") for c in part_columns(part)]
    return F.lit(0) if not cols else cols[0] if len(cols) == 1 else F.struct(*cols)


def key_weights(df: DataFrame, key: str, weight: str | None = None, part=None) -> DataFrame:
    w = F.col(f"`{weight}`").cast("long") if weight else F.lit(1).cast("long")
    return df.filter(F.col(f"`{key}`").isNotNull()).select(_part(part).alias("part"), F.col(f"`{key}`").alias("k"), w.alias("w"))


def _number(rows: DataFrame) -> Column | None:
    """The key as a double that never falls where the key rises, or None; keys that are one double share a bucket."""
    kind, k = rows.schema["k"].dataType, F.col("k")
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return k.cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(k).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(k.cast("timestamp")).cast("double") if isinstance(kind, T.TimestampType) else F.datediff(k, F.lit("1970-01-01")).cast("double")
    if isinstance(kind, (T.StringType, T.BinaryType)):  # six bytes after those that all keys begin with
        ends = rows.agg(F.min("k").cast("binary").alias("lo"), F.max("k").cast("binary").alias("hi")).first()
        lo, hi = bytes(ends["lo"] or b""), bytes(ends["hi"] or b"")
        same = next((i for i, (a, b) in enumerate(zip(lo, hi)) if a != b), min(len(lo), len(hi)))
        return F.conv(F.rpad(F.hex(F.substring(k.cast("binary"), same + 1, 6)), 12, "0"), 16, 10).cast("double")
    return None


def _bucketed(rows: DataFrame, n: int) -> DataFrame:
    """``rows`` with ``bucket``: contiguous ranges of the key, in its order."""
    number = _number(rows)
    bounds = []
    if number is not None:
        rows = rows.withColumn("_number", number)
        cuts = [i / n for i in range(1, n)]
        got = rows.where("not isnan(_number)").agg(F.percentile_approx("_number", cuts, ACCURACY).alias("q")).first()["q"] if cuts else None
        bounds = sorted({x for x in got or () if abs(x) != float("inf")})
    if not bounds:  # no keys, or nothing to tell them apart by
        return rows.withColumn("bucket", F.lit(0).cast("long")).drop("_number")
    from pyspark.ml.feature import Bucketizer

    out = Bucketizer(splits=[float("-inf"), *bounds, float("inf")], inputCol="_number", outputCol="bucket", handleInvalid="keep").transform(rows)
    return out.withColumn("bucket", F.col("bucket").cast("long")).drop("_number")


def _group(cum: Column, total: Column, n: int) -> Column:
    wide = lambda c: c.cast(WIDE)
    num = wide(wide(wide(cum) * wide(F.lit(100)) - wide(F.lit(1))) * wide(F.lit(n)))
    return F.call_function("div", num, wide(F.greatest(wide(total), wide(F.lit(1))) * wide(F.lit(100)))).cast("long")


def balanced_groups(df: DataFrame, key: str, n: int = 256, weight: str | None = None, part=None,
                    weights: DataFrame | None = None) -> DataFrame:
    """``[part,] grp, lo, hi, weight`` — one row per non-empty group.

    ``part`` names a partition column, or several from the outside in (partition and
    sub-partition); with several ``part`` is a struct of their values and groups restart in each combination.
    ``weights`` (``[part,] k, w``) may be given when the source computed them.
    Rows with a null key are in no group; null
    partition values are one partition. Weights must not be negative."""
    part = part_columns(part)
    rows = weights.where("k is not null") if weights is not None else key_weights(df, key, weight, part)
    if "part" not in rows.columns:
        rows = rows.withColumn("part", F.lit(0))
    rows = _bucketed(rows, 8 * n)
    coarse = rows.groupBy("part", "bucket").agg(F.sum("w").alias("w"), F.min("w").alias("least"), F.min("k").alias("lo"), F.max("k").alias("hi"))
    by_part = Window.partitionBy("part")
    coarse = (coarse.withColumn("total", F.sum("w").over(by_part))
              .withColumn("before", F.sum("w").over(by_part.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("w")))
    # a group can end inside a bucket unless its first and its last weight fall into one
    first, last = _group(F.col("before") + F.least("least", F.lit(1)), F.col("total"), n), _group(F.col("before") + F.col("w"), F.col("total"), n)
    coarse = coarse.withColumn("grp", F.when((F.col("w") > 0) & (first == last) | (F.col("lo") == F.col("hi")), last)).persist()
    whole = coarse.where("grp is not null").select("part", "grp", "lo", "hi", "w")
    cut = coarse.where("grp is null").select(F.col("part").alias("p"), F.col("bucket").alias("b"), "before", "total")
    if cut.count() <= BROADCAST_ROWS:
        cut = F.broadcast(cut)
    keys = (rows.join(cut, rows["part"].eqNullSafe(cut["p"]) & (rows["bucket"] == cut["b"]))
            .groupBy("part", "bucket", "k", "before", "total").agg(F.sum("w").alias("w")))
    inside = F.sum("w").over(Window.partitionBy("part", "bucket").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    keys = keys.withColumn("grp", _group(F.col("before") + inside, F.col("total"), n)).select("part", "grp", F.col("k").alias("lo"), F.col("k").alias("hi"), "w")
    out = whole.unionByName(keys).groupBy("part", "grp").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("w").cast("long").alias("weight"))
    return out.select(*(["part"] if part else []), "grp", "lo", "hi", "weight")


def _tree(k: Column, bounds: list, ids: list[int]) -> Column:
    """Log-depth CASE: index i such that bounds[i] <= k < bounds[i+1] -> ids[i]."""
    if len(ids) == 1:
        return F.lit(ids[0]).cast("long")
    mid = len(ids) // 2
    return F.when(k < F.lit(bounds[mid]), _tree(k, bounds[:mid], ids[:mid])).otherwise(_tree(k, bounds[mid:], ids[mid:]))


def _falling(p) -> tuple:
    """Sorts partition values, and tuples of them, from the largest down; null last."""
    return tuple(_Falling(x) for x in (p if isinstance(p, tuple) else (p,)))


class _Falling:
    def __init__(self, value):
        self.value = value

    def __eq__(self, other):
        return self.value == other.value

    def __lt__(self, other):
        if self.value is None or other.value is None:
            return other.value is None and self.value is not None
        return self.value > other.value


def balanced_chunk_table(groups: DataFrame, part: bool = False) -> list[tuple]:
    """Driver-side chunk list: (chunk_no, part, grp, lo, hi, weight).

    At most n groups per partition value; ids run on over the partitions in descending order, and over the
    sub-partitions of each in descending order (``part`` is a tuple then)."""
    rows = [((tuple(r["part"]) if isinstance(r["part"], tuple) else r["part"]) if part else None, r["grp"], r["lo"], r["hi"], r["weight"]) for r in groups.collect()]
    rows.sort(key=lambda r: (_falling(r[0]), r[1]))
    return [(i + 1, *r) for i, r in enumerate(rows)]


def _looked_up(df: DataFrame, key: str, chunks: list[tuple], part: list[str], chunk_col: str) -> DataFrame:
    """``chunk_col`` by a join with the sorted bounds of each partition value and a binary search in them."""
    spark, kind = df.sparkSession, df.schema[key].dataType
    zoned = isinstance(kind, T.TimestampType)  # collected in the process's time zone
    value = lambda v: v.astimezone() if zoned and isinstance(v, _dt.datetime) and v.tzinfo is None else v
    by_part: dict = {}
    for no, p, _, lo, hi, _ in chunks:
        by_part.setdefault(p if isinstance(p, tuple) else (p,) if part else (), []).append((value(lo), no, value(hi)))
    rows = []
    for p, groups in by_part.items():
        groups.sort(key=lambda g: g[0])
        rows.append((*p, [g[0] for g in groups], [g[1] for g in groups], max(g[2] for g in groups)))
    names = [f"_tx_p{i}" for i in range(len(part))]
    schema = T.StructType([*[T.StructField(c, df.schema[x].dataType) for c, x in zip(names, part)], T.StructField("_tx_lo", T.ArrayType(kind)),
                           T.StructField("_tx_no", T.ArrayType(T.LongType())), T.StructField("_tx_end", kind)])
    bounds = local_df(spark, rows, schema)
    if len(rows) <= BROADCAST_ROWS:
        bounds = F.broadcast(bounds)
    on = F.lit(True)
    for c, x in zip(names, part):
        on = on & F.col(f"`{x}`").eqNullSafe(F.col(c))
    steps = max(len(r[-2]) for r in rows).bit_length()
    found = (f"aggregate(sequence(1, {steps}), named_struct('l', 0, 'r', size(_tx_lo)), (s, x) -> if(s.l < s.r, if(_tx_lo[(s.l + s.r) div 2] <= `{key}`, "
             "named_struct('l', cast((s.l + s.r) div 2 + 1 as int), 'r', s.r), named_struct('l', s.l, 'r', cast((s.l + s.r) div 2 as int))), s), s -> s.l)")
    inside = F.col(f"`{key}`").between(F.get("_tx_lo", F.lit(0)), F.col("_tx_end"))
    out = df.join(bounds, on, "left").withColumn(chunk_col, F.when(inside, F.element_at("_tx_no", F.expr(found))))
    return out.drop(*names, "_tx_lo", "_tx_no", "_tx_end")


def assign_balanced(df: DataFrame, key: str, chunks: list[tuple], part=None,
                    chunk_col: str = "chunk_no", residual: int | None = None) -> DataFrame:
    """Add ``chunk_col`` from the balanced chunk list; no row is shuffled unless the list is too long to broadcast.

    Rows with a NULL key (or a key outside every group) get ``residual``."""
    part = part_columns(part)
    if len(chunks) > CASE_GROUPS:
        out = _looked_up(df, key, chunks, part, chunk_col)
        expr = F.col(chunk_col)
    else:
        k = F.col(f"`{key}`")
        by_part: dict = {}
        for no, p, grp, lo, hi, w in chunks:
            by_part.setdefault(p, []).append((lo, no, hi))
        expr = None
        for p, lst in by_part.items():
            lst.sort()
            bounds = [lo for lo, _, _ in lst]
            ids = [no for _, no, _ in lst]
            lo_all, hi_all = lst[0][0], max(h for _, _, h in lst)
            t = F.when(k.between(F.lit(lo_all), F.lit(hi_all)), _tree(k, bounds, ids))
            if not part:
                expr = t
                continue
            cond = F.lit(True)
            for c, v in zip(part, p if isinstance(p, tuple) else (p,)):
                cond = cond & (F.col(f"`{c}`").isNull() if v is None else (F.col(f"`{c}`") == F.lit(v)))
            expr = F.when(cond, t) if expr is None else expr.when(cond, t)
        expr = F.lit(None).cast("long") if expr is None else expr
        out = df
    if residual is not None:
        expr = F.coalesce(expr, F.lit(residual).cast("long"))
    out = out.withColumn(chunk_col, expr.cast("long"))
    return out if residual is not None else out.filter(F.col(chunk_col).isNotNull())


def balanced_predicates(chunks: list[tuple], key: str, part, dialect,
                        residual: int | None = None) -> list[tuple[int, str]]:
    """One SQL predicate per balanced chunk (key range [and partition values]);
    the residual takes NULL keys and keys outside every range (NULL-safe)."""
    k, part = dialect.ident(key), part_columns(part)
    out = []
    for no, p, grp, lo, hi, w in chunks:
        terms = [f"{dialect.ident(c)} IS NULL" if v is None else f"{dialect.ident(c)} = {dialect.literal(v)}"
                 for c, v in zip(part, p if isinstance(p, tuple) else (p,))]
        out.append((no, " AND ".join([*terms, f"{k} BETWEEN {dialect.literal(lo)} AND {dialect.literal(hi)}"])))
    if residual is not None:
        cover = " OR ".join(f"({c})" for _, c in out) or "1 = 0"
        out.append((residual, f"(CASE WHEN ({cover}) THEN 1 ELSE 0 END) = 0"))
    return out
