"""Column expressions used by the export (all built-in, codegen-friendly)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Chunk ids are zero-padded to 7 digits; the name placeholders.
CHUNK_ID_WIDTH = 7
PLACEHOLDER_CATALOG = "%{CATALOG}"
PLACEHOLDER_SCHEMA = "%{SCHEMA}"
PLACEHOLDER_TABLE = "%{TABLE}"
PLACEHOLDER_PART = "%{PART}"

_TIDY = re.compile(r"[^a-zA-Z0-9]")


# ----------------------------------------------------------------- date-times
# A zone-less (timestamp_ntz) value is formatted from its own text, never through
# the session time zone (a DST gap would move it); a zoned timestamp is shown in
# the session time zone, as the export tool shows it in its JVM's zone.
def _ntz_parts(c: Column) -> tuple[Column, Column]:
    """(yyyy-MM-ddTHH:mm:ss, fraction digits padded to 6 or '') of a timestamp_ntz."""
    s = c.cast("string")  # 'yyyy-MM-dd HH:mm:ss[.f]' with trailing zeros of the fraction dropped
    base = F.concat(F.substring(s, 1, 10), F.lit("T"), F.substring(s, 12, 8))
    frac = F.when(F.length(s) > 19, F.rpad(F.substring(s, 21, 6), 6, "0")).otherwise(F.lit(""))
    return base, frac


def datetime_text_seconds(c: Column, ntz: bool = False) -> Column:
    """ISO-8601 text with whole seconds (the Oracle ``DATE`` conversion)."""
    if ntz:
        return _ntz_parts(c)[0]
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")


def datetime_text_126(c: Column, ntz: bool = False) -> Column:
    """ISO-8601 text like SQL Server style 126: fraction only when non-zero.

    The fraction is printed with microsecond scale (6 digits)."""
    if ntz:
        base, frac = _ntz_parts(c)
        return F.concat(base, F.when(frac == F.lit(""), F.lit("")).otherwise(F.concat(F.lit("."), frac)))
    frac = F.date_format(c, "SSSSSS")
    return F.concat(
        F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(frac == F.lit("000000"), F.lit("")).otherwise(F.concat(F.lit("."), frac)),
    )


def is_datetime_type(dt: T.DataType) -> bool:
    return isinstance(dt, (T.TimestampType, T.TimestampNTZType))


def convert_datetimes(df: DataFrame, flavor: str, suffix: str, columns=None) -> DataFrame:
    """Replace date-time columns by their text form, renamed ``name+suffix``.

    ``columns`` limits which columns convert (default: every timestamp
    column; a DATE column is never converted, as in the original)."""
    fmt = datetime_text_seconds if flavor == "oracle" else datetime_text_126
    out = []
    for f in df.schema.fields:
        conv = is_datetime_type(f.dataType) and (columns is None or f.name in columns)
        if conv:
            ntz = isinstance(f.dataType, T.TimestampNTZType)
            out.append(fmt(F.col(f"`{f.name}`"), ntz=ntz).alias(f.name + suffix))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)


# ---------------------------------------------------------------------- names
def tidy_name(name: str | None) -> str | None:
    """Every character outside [a-zA-Z0-9] becomes '_', then lower case."""
    if name is None:
        return None
    return _TIDY.sub("_", name).lower()


def tidy_name_col(c: Column) -> Column:
    return F.lower(F.regexp_replace(c, "[^a-zA-Z0-9]", "_"))


def tidy_columns(df: DataFrame) -> DataFrame:
    """Rename every column with ``tidy_name``; two columns may not collide."""
    names = [tidy_name(n) for n in df.columns]
    seen: dict[str, str] = {}
    for orig, new in zip(df.columns, names):
        if new in seen:
            raise ValueError(f"columns {seen[new]!r} and {orig!r} both tidy to {new!r}")
        seen[new] = orig
    return df.toDF(*names)


def chunk_id_col(n: Column) -> Column:
    """7-digit zero-padded id; longer numbers are kept whole, never cut."""
    return F.format_string(f"%0{CHUNK_ID_WIDTH}d", n.cast("long"))


def chunk_id_text(n: int) -> str:
    return f"{n:0{CHUNK_ID_WIDTH}d}"


def expand_pattern(pattern: str, catalog, schema, table, chunk_id=None, part=None, tidy=True) -> str:
    """Expand the file-name pattern for one chunk (driver/task side)."""
    t = tidy_name if tidy else (lambda x: x)
    out = pattern.replace(PLACEHOLDER_CATALOG, "catalog" if catalog is None else t(catalog))
    out = out.replace(PLACEHOLDER_SCHEMA, "schema" if schema is None else t(schema))
    out = out.replace(PLACEHOLDER_TABLE, t(table) + ("" if not chunk_id else "-" + chunk_id))
    if part is not None:
        out = out.replace(PLACEHOLDER_PART, part)
    return out


def pattern_col(pattern: str, catalog, schema, table: str, chunk_id: Column, tidy=True) -> Column:
    """Same as ``expand_pattern`` as a column over a chunk table."""
    t = tidy_name if tidy else (lambda x: x)
    head, _, tail = pattern.partition(PLACEHOLDER_TABLE)

    def fixed(s):
        s = s.replace(PLACEHOLDER_CATALOG, "catalog" if catalog is None else t(catalog))
        return s.replace(PLACEHOLDER_SCHEMA, "schema" if schema is None else t(schema))

    if not _:
        return F.lit(fixed(pattern))
    return F.concat(F.lit(fixed(head) + t(table) + "-"), chunk_id, F.lit(fixed(tail)))
