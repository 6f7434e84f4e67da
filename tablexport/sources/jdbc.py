"""Chunked reads: JDBC predicates (one partition per chunk) or one pass over files.

For a JDBC source every chunk becomes one SQL predicate; Spark's JDBC
reader runs one task (one connection, one query) per predicate, with the
fetch size of the job (``JdbcCatalog.read_chunks``). Identifier quoting and literals follow the
dialect (SQL Server ``[x]``, Oracle/ANSI ``"x"``). Prefix chunks escape
``%``, ``_`` and the escape character so a prefix is matched literally.

For a file-based source the same plan is applied as a column in one scan
(``TablePlan.assign``) — N predicates over files would be N full scans.
"""

from __future__ import annotations

import bisect
import datetime as _dt
import decimal
import unicodedata
from dataclasses import dataclass

from pyspark.sql import SparkSession

from ..plans.chunks import (BetweenStrategy, CombosStrategy, DateStrategy, DIGITS, PrefixStrategy, TablePlan)


class Dialect:
    def __init__(self, name: str = "ansi"):
        if name not in ("sqlserver", "oracle", "ansi"):  # ansi: double quotes, CAST .. AS VARCHAR
            raise ValueError("dialect must be sqlserver, oracle or ansi")
        self.name = name

    def ident(self, name: str) -> str:
        if self.name == "sqlserver":
            return "[" + name.replace("]", "]]") + "]"
        return '"' + name.replace('"', '""') + '"'

    def text(self, col: str) -> str:
        """The column as text (number keys are matched by their decimal text)."""
        c = self.ident(col)
        if self.name == "sqlserver":
            return f"CAST({c} AS NVARCHAR(MAX))"
        if self.name == "oracle":
            return f"TO_CHAR({c})"
        return f"CAST({c} AS VARCHAR)"

    def string(self, v: str) -> str:
        """A text literal; SQL Server needs the N for characters outside its code page."""
        return ("N'" if self.name == "sqlserver" else "'") + str(v).replace("'", "''") + "'"

    def timestamp(self, d: _dt.datetime) -> str:
        """A date-time literal with all of the value's microseconds."""
        s = d.strftime("%Y-%m-%d %H:%M:%S") + (f".{d.microsecond:06d}" if d.microsecond else "")
        if self.name == "sqlserver":
            return f"CAST('{s.replace(' ', 'T')}' AS DATETIME2(7))"
        return f"TIMESTAMP '{s}'"

    def date(self, d: _dt.date) -> str:
        return f"CAST('{d.isoformat()}' AS DATE)" if self.name == "sqlserver" else f"DATE '{d.isoformat()}'"

    def binary(self, v) -> str:
        text = bytes(v).hex().upper()
        if self.name == "sqlserver":
            return f"0x{text}"
        return f"HEXTORAW('{text}')" if self.name == "oracle" else f"UNHEX('{text}')"

    def count(self) -> str:
        """Rows of a group as a 64-bit number."""
        return "COUNT_BIG(*)" if self.name == "sqlserver" else "COUNT(*)"

    def whole_part(self, a: str, b: str) -> str:
        """The quotient of two whole numbers without its fraction."""
        if self.name == "sqlserver":  # of whole numbers it has none
            return f"({a}) / ({b})"
        return f"TRUNC(({a}) / ({b}))" if self.name == "oracle" else f"(({a}) - MOD({a}, {b})) / ({b})"

    def starts_with(self, col_text: str, prefix: str) -> str:
        esc = prefix.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
        if self.name == "sqlserver":
            esc = esc.replace("[", "\\[")
        return f"{col_text} LIKE {self.string(esc + '%')} ESCAPE '\\'"

    def literal(self, v) -> str:
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return "1" if v else "0"
        if isinstance(v, (int, float)):
            return repr(v)
        if isinstance(v, _dt.datetime):
            return self.timestamp(v)
        if isinstance(v, _dt.date):
            return self.date(v)
        if isinstance(v, decimal.Decimal):
            return format(v, "f")
        if isinstance(v, (bytes, bytearray)):
            return self.binary(v)
        return self.string(v)


@dataclass(frozen=True)
class Scoped:
    """A chunk of one storage partition: ``scope`` stands behind the table's name, None is the whole of it."""

    scope: str
    predicate: str | None

    def __str__(self) -> str:
        return f"{self.scope.strip()}: {self.predicate or ''}"


def scope_of(chunk) -> tuple[str, str]:
    """(text behind the table's name, predicate) of a chunk."""
    if isinstance(chunk, Scoped):
        return chunk.scope, chunk.predicate or "1 = 1"
    return "", chunk


def stored_chunks(stored: list, groups: dict, key: str, dialect: Dialect, exactly_once: bool) -> list[tuple]:
    """``(chunk_no, Scoped or predicate, label)`` of every storage partition's key ranges; ids run on.

    As written: each range by its bounds. Exactly once: the ranges of a partition meet, the first one takes what
    lies before it and NULL keys and the last one what lies behind, so a partition is whole with no residual."""
    k = dialect.ident(key)
    out = []
    for i, part in enumerate(stored):
        ranges = groups.get(i, [])
        lows = [dialect.literal(lo) for lo, _, _ in ranges]
        if not exactly_once:
            preds = [f"{k} BETWEEN {lo} AND {dialect.literal(r[1])}" for lo, r in zip(lows, ranges)]
        elif len(ranges) < 2:
            preds = [None]
        else:
            preds = [_not(f"{k} >= {lows[1]}"), *[f"{k} >= {a} AND {k} < {b}" for a, b in zip(lows[1:], lows[2:])], f"{k} >= {lows[-1]}"]
        for n, p in enumerate(preds):
            label = part.label + (f" [{ranges[n][0]},{ranges[n][1]}] weight {ranges[n][2]}" if ranges else "")
            text = " AND ".join(x if x == part.condition else f"({x})" for x in (part.condition, p) if x) or None
            out.append((len(out) + 1, Scoped(part.scope, text) if part.scope else text or "1 = 1", label))
    return out


def _between_predicates(st: BetweenStrategy, d: Dialect) -> list[tuple[int, str]]:
    c = d.ident(st.spec.column)
    return [(st.offset + i, f"{c} BETWEEN {lo} AND {hi}")
            for i in range(1, st.n_chunks + 1) for lo, hi in [st.window(i)]]


def _date_predicates(st: DateStrategy, d: Dialect) -> list[tuple[int, str]]:
    c = d.ident(st.spec.column)
    if st.n_chunks == 0:
        return []
    if st.k == 0:
        return [(st.offset + 1, f"{c} IS NOT NULL")]
    out = [(st.offset + 1, f"{c} < {d.timestamp(st.boundary(1))}")]
    for i in range(1, st.k):
        out.append((st.offset + i + 1,
                    f"{c} >= {d.timestamp(st.boundary(i))} AND {c} < {d.timestamp(st.boundary(i + 1))}"))
    out.append((st.offset + st.k + 1, f"{c} >= {d.timestamp(st.boundary(st.k))}"))
    return out


def _not(cov: str) -> str:
    """NULL-safe negation: true when ``cov`` is false or unknown."""
    return f"(CASE WHEN ({cov}) THEN 1 ELSE 0 END) = 0"


def _any(preds) -> str:
    return " OR ".join(f"({p})" for p in preds) or "1 = 0"


def _minimal(keys: list[str]) -> list[str]:
    """Prefixes not extended from a shorter prefix of the same set."""
    out: list[str] = []
    for k in sorted(keys):
        if not out or not k.startswith(out[-1]):
            out.append(k)
    return out


def folded(text: str) -> str:
    """``text`` without case, accents and compatibility forms: texts that a collation may hold equal are equal here."""
    plain = "".join(c for c in unicodedata.normalize("NFKD", text.casefold()) if not unicodedata.combining(c))
    return unicodedata.normalize("NFKD", plain.casefold()).rstrip(" ")


def _earlier_overlaps(rows: list[tuple[int, str]]) -> dict[int, list[str]]:
    """For each numbered prefix the earlier ones that some text may begin with as well, under any collation."""
    at: dict[str, list[tuple[int, str]]] = {}
    for no, key in rows:
        at.setdefault(folded(key), []).append((no, key))
    names = sorted(at)
    out: dict[int, list[str]] = {}
    for no, key in rows:
        own = folded(key)
        near = [x for n in range(len(own)) if own[:n] in at for x in at[own[:n]]]
        for name in names[bisect.bisect_left(names, own):]:
            if not name.startswith(own):
                break
            near += at[name]
        out[no] = [k for m, k in near if m < no]
    return out


def _prefix_predicates(st: PrefixStrategy, d: Dialect, exactly_once: bool):
    """(chunk predicates, coverage predicate) of a prefix strategy.

    Which rows begin with a prefix is the database's to say: under a collation that
    ignores case or accents more do than here. Exactly once, a chunk therefore leaves out what the earlier prefixes
    take that could overlap under any collation, by the same LIKE that those use."""
    text = d.text(st.column)
    rows = sorted((int(r["local_no"]), r["key"]) for r in st.lookup.collect())
    out = []
    if exactly_once:
        overlaps = _earlier_overlaps(rows)
        for no, key in rows:
            earlier = overlaps[no]
            if any(key.startswith(k) for k in earlier):  # an earlier chunk takes every row of this one
                out.append((st.offset + no, "1 = 0"))
                continue
            p = d.starts_with(text, key)
            if earlier:
                p = f"{p} AND " + _not(" OR ".join(d.starts_with(text, k) for k in _minimal(earlier)))
            out.append((st.offset + no, p))
    else:
        out = [(st.offset + no, d.starts_with(text, key)) for no, key in rows]
    minimal = _minimal([k for _, k in rows])
    cov_terms = [d.starts_with(text, k) for k in minimal]
    nxt = st.n_prefix + 1
    if st.not_like_prefix is not None:
        p = f"NOT ({d.starts_with(text, st.not_like_prefix)})"
        out.append((st.offset + nxt, p))  # disjoint from prefix chunks: those all start with the prefix
        cov_terms.append(p)
        nxt += 1
    if st.digits_chunk:
        p = f"{text} IN ({', '.join(d.string(x) for x in DIGITS)})"
        if exactly_once and len(cov_terms) > 0:
            p = f"{p} AND " + _not(" OR ".join(cov_terms))
        out.append((st.offset + nxt, p))
        cov_terms.append(f"{text} IN ({', '.join(d.string(x) for x in DIGITS)})")
    return out, " OR ".join(cov_terms) if cov_terms else "1 = 0"


def _combo_predicates(st: CombosStrategy, d: Dialect):
    cols = list(st.spec.columns)
    out = []
    for r in st.combos.collect():
        terms = [f"{d.ident(c)} IS NULL" if r[c] is None else f"{d.ident(c)} = {d.literal(r[c])}" for c in cols]
        out.append((st.offset + int(r["local_no"]), " AND ".join(terms)))
    # a combination that appears after planning, or a value no literal can name, is left to the residual
    return sorted(out), _any(p for _, p in out)


def predicates(plan: TablePlan, dialect: str = "ansi") -> list[tuple[int, str]]:
    """``(chunk_no, predicate)`` for every chunk of the plan.

    As written: the original chunk lists (overlaps and gaps included).
    Exactly once: between windows are clamped, a prefix chunk leaves out
    rows an earlier overlapping chunk takes, a later strategy leaves out rows
    an earlier strategy covers, and a residual predicate takes every row no
    chunk matches (NULL keys included). All exclusions are NULL-safe."""
    d = Dialect(dialect)
    eo = plan.exactly_once
    out: list[tuple[int, str]] = []
    covers: list[str] = []
    for st in plan.strategies:
        if isinstance(st, BetweenStrategy):
            preds = _between_predicates(st, d)
            cov = _any(p for _, p in preds)  # not one range: a fractional key between two windows is in none
        elif isinstance(st, DateStrategy):
            preds = _date_predicates(st, d)
            cov = f"{d.ident(st.spec.column)} IS NOT NULL" if st.n_chunks else "1 = 0"
        elif isinstance(st, PrefixStrategy):
            preds, cov = _prefix_predicates(st, d, eo)
        elif isinstance(st, CombosStrategy):
            preds, cov = _combo_predicates(st, d)
        else:
            raise TypeError(type(st))
        if eo and covers:
            earlier = _not(" OR ".join(f"({c})" for c in covers))
            preds = [(no, f"({p}) AND {earlier}") for no, p in preds]
        out += preds
        covers.append(cov)
    if eo:
        out.append((plan.residual_no, _not(" OR ".join(f"({c})" for c in covers)) if covers else "1 = 1"))
    return out


def check_connection(spark: SparkSession, url: str, properties: dict | None = None, attempts: int = 1,
                     wait_seconds: float = 5.0, flavor: str = "ansi") -> None:
    """Fail fast when the database does not answer a one-row query (polled ``attempts`` times)."""
    import time
    last = None
    for i in range(max(1, attempts)):
        try:
            (spark.read.format("jdbc").option("url", url).option("query", "SELECT 1 AS ok" + (" FROM DUAL" if flavor == "oracle" else ""))
             .options(**dict(properties or {})).load().collect())
            return
        except Exception as e:  # noqa: BLE001
            last = e
            if i + 1 < attempts:
                time.sleep(wait_seconds)
    raise ConnectionError(f"database at {url} is not reachable: {last}")
