"""Split strategies -> chunk plans -> one-pass chunk assignment.

A ``TablePlan`` holds the resolved strategies of one table. Each strategy
numbers its chunks 1..n; ids run on across strategies (``offset``).

Assignment never scans the table once per chunk:

* number ``between`` and date ``range`` chunks are arithmetic on the key
  (windows are integer ranges: a fractional key between two is in none);
* ``like`` chunks (number prefixes, first characters, distinct values used
  as prefixes) compare the leading characters of the key with a small
  lookup table — one broadcast hash join per distinct prefix length, all
  pipelined in the same stage. A split with many prefix lengths: exactly once, the nested
  prefixes are flattened into disjoint ranges of text, each with its first chunk, and a row's range is found by
  binary search in one broadcast array (a lookup too big for that: over the distinct values); as
  written, the candidates are exploded into one join;
* distinct-combination chunks are one null-safe equi-join.

Modes:

* ``exactly_once=True`` (default): each row lands in its first matching
  chunk; rows that match none (NULL keys, keys outside the range, prefixes
  skipped by the increment) go to a trailing *residual* chunk; the first
  ``between`` window is clamped to the end bound.
* ``exactly_once=False`` mirrors the original chunk lists: a row matching
  several chunks appears once per chunk, unmatched rows are not exported.

A lookup is broadcast when its measured bytes are at most ``BROADCAST_BYTES``;
beyond that Spark decides.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.numbering import global_row_number
from ..session import local_df, session_wall_clock
from .split_spec import KeyType, Operation, SplitSpec, SplitSpecError

WIDE_LENGTHS = 2  # with more distinct prefix lengths: one join over exploded prefixes instead of one per length
BROADCAST_BYTES = 32 << 20  # of a lookup's rows, measured when the chunks are planned
ROW_BYTES = 40  # what a row of a lookup takes beside its text
# The single-digit catch-all chunk of number prefixes.
DIGITS = ("0", "1", "2", "3", "4", "5", "6", "7", "8", "9")


def q(name: str) -> Column:
    return F.col(f"`{name}`")


def _trunc_div(a: int, b: int) -> int:
    """Integer division rounding toward zero (as in Java / SQL)."""
    r = abs(a) // abs(b)
    return r if (a >= 0) == (b >= 0) else -r


def _sql_div(c: Column, d: int) -> Column:
    return F.call_function("div", c.cast("long"), F.lit(int(d)).cast("long"))


# ---------------------------------------------------------------- nested prefixes
def successor(prefix: str) -> str | None:
    """The smallest text beyond all that start with ``prefix`` (None: there is none), in code-point order."""
    while prefix:
        last = ord(prefix[-1])
        if last < 0x10FFFF:
            return prefix[:-1] + chr(0xE000 if last == 0xD7FF else last + 1)
        prefix = prefix[:-1]
    return None


def flatten_prefixes(numbered: list[tuple[str, int]]) -> list[tuple[str, int | None]]:
    """(from, chunk): from each text on, up to the next, the smallest number among the prefixes that a text has, or None.

    One sweep in text order over the prefixes that are open at a point, innermost last."""
    out: list[tuple[str, int | None]] = []
    open_: list[tuple[str | None, int]] = []  # (end, smallest number of this prefix and those around it)

    def mark(at: str | None, chunk: int | None):
        if at is None:
            return
        if out and out[-1][0] == at:
            out[-1] = (at, chunk)
        elif not out or out[-1][1] != chunk:
            out.append((at, chunk))

    def close(upto: str | None):
        while open_ and (upto is None or open_[-1][0] is not None and open_[-1][0] <= upto):
            end, _ = open_.pop()
            mark(end, open_[-1][1] if open_ else None)

    best: dict[str, int] = {}
    for key, no in numbered:
        best[key] = min(no, best.get(key, no))
    for key in sorted(best):
        close(key)
        chunk = min(best[key], open_[-1][1]) if open_ else best[key]
        mark(key, chunk)
        open_.append((successor(key), chunk))
    close(None)
    return out


# ---------------------------------------------------------------- strategies
@dataclass
class Strategy:
    spec: SplitSpec
    strategy_no: int
    n_chunks: int = 0
    offset: int = 0
    kind: str = ""

    # overridden -------------------------------------------------------------
    def match_columns(self, df: DataFrame, exactly_once: bool) -> tuple[DataFrame, list[Column], list[str]]:
        """Return (df with helper columns, global chunk number columns, helper names)."""
        raise NotImplementedError

    def chunk_rows(self, spark: SparkSession) -> DataFrame:
        """(local_no long, label string) for every chunk of this strategy."""
        raise NotImplementedError

    def params(self) -> dict:
        return {}

    def describe(self) -> str:
        """JSON text: the strategy string, its kind, chunk ids and the parameters resolved by planning."""
        import json
        d = {"strategy": self.spec.text, "kind": self.kind, "first_chunk": self.offset + 1 if self.n_chunks else None,
             "chunks": self.n_chunks}
        d.update(self.params())
        return json.dumps(d, default=str)

    def coverage(self) -> Column | None:
        """A pushdown-friendly filter true for every row some chunk of this strategy
        takes (None when it cannot be stated simply)."""
        return None


@dataclass
class BetweenStrategy(Strategy):
    start: int = 0
    end: int = 0
    increment: int = 0
    exactly_once: bool = True
    kind: str = "between"

    def __post_init__(self):
        s, e, inc = self.start, self.end, self.increment
        self.n_chunks = 1 if e < s else (e - s) // (inc + 1) + 1

    @property
    def cover_hi(self) -> int:
        if self.exactly_once:
            return self.end
        return max(self.start + self.increment, self.end)

    def window(self, i: int) -> tuple[int, int]:
        s, e, inc = self.start, self.end, self.increment
        lo = s + (i - 1) * (inc + 1)
        hi = s + inc if i == 1 else min(lo + inc, e)
        if i == 1 and self.exactly_once:
            hi = min(hi, e)
        return lo, hi

    def match_columns(self, df, exactly_once):
        k = q(self.spec.column)
        s, inc = self.start, self.increment
        idx = _sql_div(k - F.lit(s), inc + 1)
        cond = k.between(F.lit(s), F.lit(self.cover_hi))
        dtype = df.schema[self.spec.column].dataType if self.spec.column in df.columns else None
        if isinstance(dtype, (T.DoubleType, T.FloatType, T.DecimalType)):
            # windows are integer ranges [lo, lo + inc]: a fractional key between two windows is in none
            cond = cond & (k - F.lit(s) - idx * F.lit(inc + 1) <= F.lit(inc))
        return df, [F.when(cond, idx + F.lit(1 + self.offset))], []

    def coverage(self):
        if self.n_chunks == 0:
            return F.lit(False)
        return q(self.spec.column).between(F.lit(self.start), F.lit(self.cover_hi))

    def chunk_rows(self, spark):
        s, e, inc = self.start, self.end, self.increment
        i = F.col("id") + 1
        lo = F.lit(s) + (i - 1) * F.lit(inc + 1)
        first_hi = min(s + inc, e) if self.exactly_once else s + inc
        hi = F.when(i == 1, F.lit(first_hi)).otherwise(F.least(lo + F.lit(inc), F.lit(e)))
        return spark.range(self.n_chunks).select(
            i.alias("local_no"), F.concat(F.lit("["), lo.cast("string"), F.lit(","), hi.cast("string"), F.lit("]")).alias("label"))

    def params(self):
        return {"start": self.start, "end": self.end, "increment": self.increment}


@dataclass
class PrefixStrategy(Strategy):
    """Chunks are literal text prefixes of a key's text (number ``like``,
    string ``like`` by first character, ``query`` + sub-operation ``like``)."""

    column: str = ""
    lookup: DataFrame | None = None  # key string, local_no long (prefix chunks only)
    lengths: tuple[int, ...] = ()
    n_prefix: int = 0
    lookup_bytes: int = 0
    not_like_prefix: str | None = None  # extra chunk: key text does not start with this
    digits_chunk: bool = False  # extra chunk: key text is one digit
    cast_text: bool = True
    kind: str = "like"

    def __post_init__(self):
        self.n_chunks = self.n_prefix + (1 if self.not_like_prefix is not None else 0) + (1 if self.digits_chunk else 0)

    def params(self):
        sp = self.spec
        d = {"column": self.column}
        if sp.start is not None:
            d.update(start=sp.start, end=sp.end, increment=sp.increment)
        if self.not_like_prefix is not None:
            d["prefix"] = self.not_like_prefix
        return d

    def _text(self) -> Column:
        c = q(self.column)
        return c.cast("string") if self.cast_text else c

    @property
    def wide(self) -> bool:
        """More prefix lengths than are joined one by one."""
        return len(self.lengths) > WIDE_LENGTHS

    def exploded_matches(self, df: DataFrame, chunk_col: str) -> DataFrame:
        """As written, in one join: each row's candidate keys (one prefix per length, plus
        sentinel keys for the catch-all chunks it falls in) exploded and equi-joined with
        the lookup — one output row per matching chunk."""
        text = self._text()
        cands = [F.when(F.length(text) >= L, F.substring(text, 1, L)) for L in self.lengths]
        extra = []
        nxt = self.n_prefix + 1
        if self.not_like_prefix is not None:
            cands.append(F.when(~text.startswith(F.lit(self.not_like_prefix)), F.lit("\x00not_like")))
            extra.append(("\x00not_like", nxt))
            nxt += 1
        if self.digits_chunk:
            cands.append(F.when(text.isin(*DIGITS), F.lit("\x00digits")))
            extra.append(("\x00digits", nxt))
        right = self.lookup.select("key", "local_no")
        if extra:
            right = right.unionByName(local_df(df.sparkSession, extra, "key string, local_no long"))
        right = right.select(F.col("key").alias("_tx_key"), (F.col("local_no") + F.lit(self.offset)).alias(chunk_col))
        right = _sized(right, self.lookup_bytes)
        ex = df.withColumn("_tx_cand", F.explode(F.filter(F.array(*cands), lambda x: x.isNotNull())))
        return ex.join(right, F.col("_tx_cand") == F.col("_tx_key"), "inner").drop("_tx_cand", "_tx_key")

    def match_columns(self, df, exactly_once):
        text = self._text()
        cols: list[Column] = []
        helpers: list[str] = []
        lookup = self.lookup
        if exactly_once and self.wide and self.lookup_bytes <= BROADCAST_BYTES:
            ranges = flatten_prefixes([(r["key"], r["local_no"]) for r in lookup.select("key", "local_no").collect()])
            at, nos = f"_tx_r{self.strategy_no}", f"_tx_n{self.strategy_no}"
            table = local_df(df.sparkSession, [([a for a, _ in ranges], [n for _, n in ranges])], f"{at} array<string>, {nos} array<long>")
            own = f"_tx_c{self.strategy_no}"
            df = df.withColumn(own, text).join(F.broadcast(table), F.lit(True), "left")  # one row
            steps = max(1, len(ranges)).bit_length()
            found = (f"aggregate(sequence(1, {steps}), named_struct('l', 0, 'r', size({at})), (s, x) -> if(s.l < s.r, if({at}[(s.l + s.r) div 2] <= {own}, "
                     "named_struct('l', cast((s.l + s.r) div 2 + 1 as int), 'r', s.r), named_struct('l', s.l, 'r', cast((s.l + s.r) div 2 as int))), s), s -> s.l)")
            cols.append(F.when(F.col(own) >= F.get(at, F.lit(0)), F.element_at(nos, F.expr(found))) + F.lit(self.offset))
            helpers += [own, at, nos]
        elif exactly_once and self.wide:
            # every distinct value once: the first chunk among its prefixes; then one join of the rows on the value
            val, hit = f"_tx_v{self.strategy_no}", f"_tx_m{self.strategy_no}"
            values = df.select(text.alias(val)).where(F.col(val).isNotNull()).distinct()
            cands = F.array(*[F.when(F.length(val) >= L, F.substring(val, 1, L)) for L in self.lengths])
            first = (values.select(val, F.explode(F.filter(cands, lambda x: x.isNotNull())).alias("key"))
                     .join(_sized(lookup.select("key", "local_no"), self.lookup_bytes), "key").groupBy(val).agg(F.min("local_no").alias(hit)))
            own = f"_tx_c{self.strategy_no}"
            df = df.withColumn(own, text)
            df = df.join(first, df[own] == first[val], "left")
            cols.append(F.col(hit) + F.lit(self.offset))
            helpers += [own, val, hit]
        for L in () if helpers else self.lengths:
            cand, hit, key = f"_tx_c{self.strategy_no}_{L}", f"_tx_m{self.strategy_no}_{L}", f"_tx_k{self.strategy_no}_{L}"
            right = lookup.filter(F.length("key") == L).select(F.col("key").alias(key), F.col("local_no").alias(hit))
            right = _sized(right, self.lookup_bytes)
            df = df.withColumn(cand, F.when(F.length(text) >= L, F.substring(text, 1, L)))
            df = df.join(right, F.col(cand) == F.col(key), "left")
            cols.append(F.col(hit) + F.lit(self.offset))
            helpers += [cand, hit, key]
        nxt = self.n_prefix + 1
        if self.not_like_prefix is not None:
            cols.append(F.when(~text.startswith(F.lit(self.not_like_prefix)), F.lit(nxt + self.offset)))
            nxt += 1
        if self.digits_chunk:
            cols.append(F.when(text.isin(*DIGITS), F.lit(nxt + self.offset)))
        return df, cols, helpers

    def chunk_rows(self, spark):
        rows = self.lookup.select("local_no", F.concat(F.col("key"), F.lit("%")).alias("label"))
        extra = []
        nxt = self.n_prefix + 1
        if self.not_like_prefix is not None:
            extra.append((nxt, f"NOT {self.not_like_prefix}%"))
            nxt += 1
        if self.digits_chunk:
            extra.append((nxt, "digits"))
        if extra:
            rows = rows.unionByName(local_df(spark, extra, "local_no long, label string"))
        return rows


@dataclass
class DateStrategy(Strategy):
    start: _dt.datetime | None = None
    end: _dt.datetime | None = None
    increment: int = 12
    kind: str = "date"

    def __post_init__(self):
        if self.start is None or self.end is None:
            self.n_chunks = 0
            return
        self.n_chunks = self.k + 1

    @property
    def yearly(self) -> bool:
        return self.increment % 12 == 0

    @property
    def step(self) -> int:
        return self.increment // 12 if self.yearly else self.increment

    def _index(self, d) -> int:
        return d.year if self.yearly else d.year * 12 + d.month - 1

    @property
    def k(self) -> int:
        return max(0, (self._index(self.end) - self._index(self.start)) // self.step)

    def boundary(self, i: int) -> _dt.datetime:
        """Start of window i (i = 1..k): the first boundary after the first window."""
        v = self._index(self.start) + i * self.step
        if self.yearly:
            return _dt.datetime(v, 1, 1)
        return _dt.datetime(v // 12, v % 12 + 1, 1)

    def match_columns(self, df, exactly_once):
        if self.n_chunks == 0:
            return df, [], []
        d = q(self.spec.column)
        v = F.year(d) if self.yearly else F.year(d) * 12 + F.month(d) - 1
        rel = v.cast("long") - F.lit(self._index(self.start))
        idx = F.least(F.greatest(_sql_div(rel, self.step), F.lit(0)), F.lit(self.k))
        # negative offsets truncate toward zero, clamped to the first window anyway;
        # greatest/least skip NULLs, so a NULL key must be kept out explicitly
        return df, [F.when(d.isNotNull(), idx + F.lit(1 + self.offset))], []

    def coverage(self):
        return q(self.spec.column).isNotNull() if self.n_chunks else F.lit(False)

    def labels(self) -> list[tuple[int, str]]:
        if self.n_chunks == 0:
            return []
        fmt = lambda x: x.strftime("%Y-%m-%d %H:%M:%S")
        if self.k == 0:
            return [(1, "all")]
        out = [(1, f"< {fmt(self.boundary(1))}")]
        for i in range(1, self.k):
            out.append((i + 1, f">= {fmt(self.boundary(i))} and < {fmt(self.boundary(i + 1))}"))
        out.append((self.k + 1, f">= {fmt(self.boundary(self.k))}"))
        return out

    def chunk_rows(self, spark):
        return local_df(spark, self.labels(), "local_no long, label string")

    def params(self):
        return {"start": str(self.start), "end": str(self.end), "increment": self.increment}


@dataclass
class CombosStrategy(Strategy):
    """One chunk per distinct combination of the key columns."""

    combos: DataFrame | None = None  # key columns..., local_no
    lookup_bytes: int = 0
    kind: str = "combos"

    def match_columns(self, df, exactly_once):
        cols = list(self.spec.columns)
        ren = {c: f"_tx_q{self.strategy_no}_{i}" for i, c in enumerate(cols)}
        hit = f"_tx_q{self.strategy_no}_no"
        right = self.combos.select(*[q(c).alias(ren[c]) for c in cols], F.col("local_no").alias(hit))
        right = _sized(right, self.lookup_bytes)
        cond = None
        for c in cols:
            e = q(c).eqNullSafe(F.col(ren[c]))
            cond = e if cond is None else cond & e
        df = df.join(right, cond, "left")
        return df, [F.col(hit) + F.lit(self.offset)], list(ren.values()) + [hit]

    def params(self):
        return {"columns": list(self.spec.columns)}

    def chunk_rows(self, spark):
        parts = [F.coalesce(q(c).cast("string"), F.lit("NULL")) for c in self.spec.columns]
        return self.combos.select("local_no", F.concat_ws(",", *parts).alias("label"))


# ------------------------------------------------------------------- planning
@dataclass
class TablePlan:
    table: str
    strategies: list[Strategy] = field(default_factory=list)
    exactly_once: bool = True

    @property
    def n_chunks(self) -> int:
        n = sum(s.n_chunks for s in self.strategies)
        return n + (1 if self.exactly_once else 0)

    @property
    def residual_no(self) -> int | None:
        return self.n_chunks if self.exactly_once else None

    def coverage(self) -> Column | None:
        """OR of the strategies' coverage filters, or None when one has none."""
        out = None
        for st in self.strategies:
            c = st.coverage()
            if c is None:
                return None
            out = c if out is None else (out | c)
        return out

    def assign(self, df: DataFrame, chunk_col: str = "chunk_no") -> DataFrame:
        """Add ``chunk_col`` (global, 1-based) in one pass over ``df``.

        exactly-once: one output row per input row; otherwise one per match.
        As written, rows outside every chunk are dropped by a plain filter
        first, so range bounds reach the scan (row-group skipping)."""
        helpers: list[str] = []
        matches: list[Column] = []
        cur = df
        cov = None if self.exactly_once else self.coverage()
        if cov is not None:
            cur = cur.filter(cov)
        if (not self.exactly_once and len(self.strategies) == 1 and isinstance(self.strategies[0], PrefixStrategy)
                and self.strategies[0].wide):
            return self.strategies[0].exploded_matches(cur, chunk_col).withColumn(chunk_col, F.col(chunk_col).cast("long"))
        for st in self.strategies:
            cur, cols, h = st.match_columns(cur, self.exactly_once)
            matches += [c.cast("long") for c in cols]
            helpers += h
        if not matches:
            chunk = F.lit(self.residual_no).cast("long") if self.exactly_once else None
            if chunk is None:
                return cur.withColumn(chunk_col, F.lit(None).cast("long")).filter(F.lit(False))
            return cur.withColumn(chunk_col, chunk)
        if len(matches) == 1 and self.exactly_once:
            out = cur.withColumn(chunk_col, F.coalesce(matches[0], F.lit(self.residual_no).cast("long")))
        elif len(matches) == 1:
            out = cur.withColumn(chunk_col, matches[0]).filter(F.col(chunk_col).isNotNull())
        else:
            arr = F.filter(F.array(*matches), lambda x: x.isNotNull())
            if self.exactly_once:
                out = cur.withColumn(chunk_col, F.coalesce(F.array_min(arr), F.lit(self.residual_no).cast("long")))
            else:
                out = cur.withColumn(chunk_col, F.explode(arr))
        return out.drop(*helpers)

    def match_times(self, df: DataFrame, col: str = "times") -> DataFrame:
        """Add ``col``: how many chunks of the list (as written) match each row."""
        helpers: list[str] = []
        matches: list[Column] = []
        cur = df
        for st in self.strategies:
            cur, cols, h = st.match_columns(cur, False)
            matches += [c.cast("long") for c in cols]
            helpers += h
        if not matches:
            return cur.withColumn(col, F.lit(0).cast("long"))
        arr = F.filter(F.array(*matches), lambda x: x.isNotNull())
        return cur.withColumn(col, F.size(arr).cast("long")).drop(*helpers)

    def chunk_table(self, spark: SparkSession) -> DataFrame:
        """strategy_no int, chunk_no long (global), label string — for every chunk."""
        parts = []
        for st in self.strategies:
            if st.n_chunks == 0:
                continue
            parts.append(st.chunk_rows(spark).select(
                F.lit(st.strategy_no).cast("int").alias("strategy_no"),
                (F.col("local_no") + F.lit(st.offset)).cast("long").alias("chunk_no"),
                F.col("label")))
        if self.exactly_once:
            parts.append(local_df(spark, [(0, self.residual_no, "residual")],
                                               "strategy_no int, chunk_no long, label string"))
        if not parts:
            return local_df(spark, [], "strategy_no int, chunk_no long, label string")
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def summary(self, df: DataFrame, *aggs: Column, chunk_col: str = "chunk_no") -> DataFrame:
        """Every planned chunk with its row count ``n`` (0 when empty) and extra aggregates."""
        counts = self.assign(df, chunk_col).groupBy(chunk_col).agg(F.count(F.lit(1)).alias("n"), *aggs)
        chunks = self.chunk_table(df.sparkSession)
        return chunks.join(counts, chunk_col, "left").withColumn("n", F.coalesce(F.col("n"), F.lit(0).cast("long")))


def _sized(lookup: DataFrame, n_bytes: int) -> DataFrame:
    return F.broadcast(lookup) if n_bytes <= BROADCAST_BYTES else lookup


def _number_bounds(df: DataFrame, columns: list[str]) -> dict[str, tuple]:
    if not columns:
        return {}
    aggs = []
    for i, c in enumerate(columns):
        aggs += [F.min(q(c)).alias(f"lo{i}"), F.max(q(c)).alias(f"hi{i}")]
    row = df.agg(*aggs).collect()[0]
    spark = df.sparkSession
    types = {f.name: f.dataType for f in df.schema.fields}
    return {c: (session_wall_clock(spark, row[f"lo{i}"], types.get(c)),
                session_wall_clock(spark, row[f"hi{i}"], types.get(c))) for i, c in enumerate(columns)}


def plan_table(df: DataFrame | None, specs: list[SplitSpec], *, table: str = "", exactly_once: bool = True,
               increment_factor: int = 50,
               num_partitions: int | None = None, bounds_fn=None, distinct_fn=None,
               spark: SparkSession | None = None) -> TablePlan:
    """Resolve every strategy of one table against its DataFrame.

    Bounds that are not given are read with ONE aggregation over the table
    (MIN/MAX of every key that needs them). A source that can answer these
    itself (a database) passes ``bounds_fn(columns) -> {col: (min, max)}`` and
    ``distinct_fn(columns) -> DataFrame`` so nothing is computed over a
    single-partition read of the whole table (``df`` may then be None)."""
    spark = spark or df.sparkSession
    need = []
    for s in specs:
        if s.operation is Operation.between and s.key_type is KeyType.number and (s.start is None or s.end is None):
            need.append(s.column)
        if s.key_type is KeyType.date and (s.start is None or s.end is None):
            need.append(s.column)
    need = sorted(set(need))
    bounds = (bounds_fn(need) if bounds_fn else _number_bounds(df, need)) if need else {}

    plan = TablePlan(table=table, exactly_once=exactly_once)
    offset = 0
    for no, s in enumerate(specs, start=1):
        st = _plan_one(spark, df, s, no, bounds, exactly_once, increment_factor, num_partitions,
                       distinct_fn)
        st.offset = offset
        offset += st.n_chunks
        plan.strategies.append(st)
    return plan


def _plan_one(spark, df, s: SplitSpec, no, bounds, exactly_once, factor, nparts, distinct_fn=None) -> Strategy:
    if s.operation is Operation.query:
        if s.sub_operation is Operation.like:
            return _plan_query_like(df, s, no, nparts, distinct_fn)
        return _plan_combos(df, s, no, nparts, distinct_fn)
    kt = s.key_type
    if kt is KeyType.number and s.operation is Operation.between:
        lo, hi = (s.start, s.end) if s.start is not None else bounds[s.column]
        if lo is None or hi is None:  # empty table: no chunk
            st = BetweenStrategy(spec=s, strategy_no=no, start=0, end=0, increment=0, exactly_once=exactly_once)
            st.n_chunks = 0
            return st
        lo, hi = int(lo), int(hi)
        inc = s.increment if s.increment is not None else _trunc_div(hi - lo, factor)
        if inc < 0:
            raise SplitSpecError("resolved increment is negative (end before start)")
        return BetweenStrategy(spec=s, strategy_no=no, start=lo, end=hi, increment=inc, exactly_once=exactly_once)
    if kt is KeyType.number and s.operation is Operation.like:
        start, end, inc = s.start, s.end, s.increment
        n = 1 if end < start else (end - start) // inc + 1
        prefix = s.prefix or ""
        last = start + (n - 1) * inc
        width = max(len(str(start)), len(str(last)))
        lengths = tuple(range(len(prefix) + 1, len(prefix) + width + 1))
        lookup = spark.range(n).select(
            F.concat(F.lit(prefix), (F.lit(start) + F.col("id") * F.lit(inc)).cast("string")).alias("key"),
            (F.col("id") + 1).alias("local_no"))
        return PrefixStrategy(spec=s, strategy_no=no, column=s.column, lookup=lookup, lengths=lengths, n_prefix=n, lookup_bytes=n * (lengths[-1] + ROW_BYTES),
                              not_like_prefix=(s.prefix if s.prefix is not None else None),
                              digits_chunk=start >= 10)
    if kt is KeyType.string and s.operation is Operation.like:
        a, b = ord(str(s.start)[0]), ord(str(s.end)[0])
        chars = [chr(c) for c in range(a, b + 1)][:: s.increment]
        lookup = local_df(spark, [(ch, i + 1) for i, ch in enumerate(chars)], "key string, local_no long")
        return PrefixStrategy(spec=s, strategy_no=no, column=s.column, lookup=lookup, lengths=(1,),
                              n_prefix=len(chars), lookup_bytes=len(chars) * ROW_BYTES, kind="string_like")
    if kt is KeyType.date:
        lo, hi = (s.start, s.end) if s.start is not None else bounds[s.column]
        return DateStrategy(spec=s, strategy_no=no, start=lo, end=hi, increment=s.increment)
    raise SplitSpecError(f"unsupported split {s.text!r}")


def _plan_combos(df, s: SplitSpec, no, nparts, distinct_fn=None) -> CombosStrategy:
    cols = list(s.columns)
    distinct = distinct_fn(cols) if distinct_fn else df.select(*[q(c) for c in cols]).distinct()
    numbered = global_row_number(distinct, [q(c).asc_nulls_first() for c in cols], "local_no", nparts)
    texts = [F.coalesce(F.octet_length(q(c)), F.lit(0)) for c in cols if isinstance(numbered.schema[c].dataType, (T.StringType, T.BinaryType))]
    size = numbered.agg(F.count(F.lit(1)).alias("n"), F.sum(sum(texts, F.lit(0))).alias("text")).first()
    n = size["n"]
    return CombosStrategy(spec=s, strategy_no=no, combos=numbered, n_chunks=n,
                          lookup_bytes=int(size["text"] or 0) + n * (ROW_BYTES + 16 * len(cols)))


def _plan_query_like(df, s: SplitSpec, no, nparts, distinct_fn=None) -> PrefixStrategy:
    first = s.columns[0]
    src = distinct_fn([first]) if distinct_fn else df
    vals = src.select(q(first).cast("string").alias("key")).filter(F.col("key").isNotNull()).distinct()
    numbered = global_row_number(vals, [F.col("key").asc()], "local_no", nparts)
    stats = numbered.agg(F.count(F.lit(1)).alias("n"), F.collect_set(F.length("key")).alias("lens"), F.sum(F.octet_length("key")).alias("text")).collect()[0]
    lengths = tuple(sorted(int(x) for x in (stats["lens"] or [])))
    return PrefixStrategy(spec=s, strategy_no=no, column=s.sub_column, lookup=numbered, lengths=lengths,
                          n_prefix=int(stats["n"]), lookup_bytes=int(stats["text"] or 0) + ROW_BYTES * int(stats["n"]),
                          kind="query_like")
