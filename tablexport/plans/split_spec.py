"""Split strategy strings -> validated ``SplitSpec`` objects.

Grammar (field order as the export tool reads it):

    table, operation, column(s) [, subOperation, subColumn], keyType, increment, start, end, prefix

* commas inside double quotes do not split a field;
* ``query`` takes ``"c1;c2"`` (quotes stripped, ``;``-separated) and an
  optional ``subOperation, subColumn`` pair right after the columns;
* everything after the column(s) is optional, but ``start`` must come with
  ``end``.

Inputs that the original tool accepted but then looped on forever, lost
rows for, or crashed on are rejected here with a clear message.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field
from enum import Enum


class Operation(str, Enum):
    like = "like"
    between = "between"
    range = "range"
    query = "query"


class KeyType(str, Enum):
    number = "number"
    string = "string"
    date = "date"


class SplitSpecError(ValueError):
    pass


def split_fields(text: str) -> list[str]:
    """Split on commas that are outside double-quoted stretches."""
    fields, buf, quoted = [], [], False
    for ch in text:
        if ch == '"':
            quoted = not quoted
            buf.append(ch)
        elif ch == "," and not quoted:
            fields.append("".join(buf))
            buf = []
        else:
            buf.append(ch)
    fields.append("".join(buf))
    return fields


def _parse_date(text: str) -> _dt.datetime:
    text = text.strip()
    for fmt in ("%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d", "%Y-%m"):
        try:
            return _dt.datetime.strptime(text, fmt)
        except ValueError:
            pass
    raise SplitSpecError(f"cannot read date bound {text!r}")


@dataclass(frozen=True)
class SplitSpec:
    table: str
    operation: Operation
    column: str | None = None
    columns: tuple[str, ...] = ()
    sub_operation: Operation | None = None
    sub_column: str | None = None
    key_type: KeyType | None = None
    increment: int | None = None
    start: object = None  # int for number keys, str for string keys, datetime for dates
    end: object = None
    prefix: str | None = None
    text: str = field(default="", compare=False)

    # ------------------------------------------------------------------ parse
    @classmethod
    def parse(cls, text: str) -> "SplitSpec":
        data = [f.strip() for f in split_fields(text)]
        if len(data) < 3:
            raise SplitSpecError(f"split strategy needs at least table, operation, column: {text!r}")
        try:
            op = Operation(data[1])
        except ValueError:
            raise SplitSpecError(
                f"second field must be one of like/between/range/query, got {data[1]!r} in {text!r}"
            ) from None
        kw: dict = {"table": data[0], "operation": op, "text": text}
        i = 2
        if op is Operation.query:
            cols = tuple(c.strip() for c in data[2].replace('"', "").split(";") if c.strip())
            if not cols:
                raise SplitSpecError(f"query split needs columns: {text!r}")
            kw["columns"] = cols
            if len(data) > i + 2:
                try:
                    kw["sub_operation"] = Operation(data[3])
                except ValueError:
                    raise SplitSpecError(f"unknown sub-operation {data[3]!r}") from None
                if kw["sub_operation"] is not Operation.like:
                    raise SplitSpecError("only 'like' is a valid sub-operation of query")
                kw["sub_column"] = data[4]
                i = 4
        else:
            kw["column"] = data[2]
        rest = data[i + 1:]
        if rest:
            try:
                kt = KeyType(rest[0])
            except ValueError:
                raise SplitSpecError(f"unknown key type {rest[0]!r} in {text!r}") from None
            kw["key_type"] = kt
            if len(rest) > 1:
                try:
                    kw["increment"] = int(rest[1])
                except ValueError:
                    raise SplitSpecError(f"increment must be an integer: {rest[1]!r}") from None
            if len(rest) == 3:
                raise SplitSpecError(f"a start bound needs an end bound: {text!r}")
            if len(rest) >= 4:
                lo, hi = rest[2], rest[3]
                if kt is KeyType.number:
                    try:
                        kw["start"], kw["end"] = int(lo), int(hi)
                    except ValueError:
                        raise SplitSpecError(f"number bounds must be integers: {lo!r}, {hi!r}") from None
                elif kt is KeyType.date:
                    kw["start"], kw["end"] = _parse_date(lo), _parse_date(hi)
                else:
                    kw["start"], kw["end"] = lo, hi
            if len(rest) >= 5:
                kw["prefix"] = rest[4]
            if len(rest) > 5:
                raise SplitSpecError(f"too many fields in {text!r}")
        spec = cls(**kw)
        spec.validate()
        return spec

    # --------------------------------------------------------------- validate
    def validate(self) -> None:
        op, kt = self.operation, self.key_type
        if op is Operation.query:
            return
        if kt is None:
            raise SplitSpecError(f"{op.value} split needs a key type: {self.text!r}")
        if self.increment is not None and self.increment < 0:
            raise SplitSpecError("increment must not be negative")
        if kt is KeyType.number:
            if op is Operation.range:
                raise SplitSpecError("number keys support 'between' and 'like', not 'range'")
            if op is Operation.like and (self.start is None or self.increment is None):
                raise SplitSpecError("number 'like' needs increment, start and end")
            if op is Operation.like and self.increment == 0:
                raise SplitSpecError("number 'like' needs a positive increment")
        elif kt is KeyType.string:
            if op is not Operation.like:
                raise SplitSpecError("string keys support only 'like'")
            if self.start in (None, "") or self.end in (None, "") or not self.increment:
                raise SplitSpecError("string 'like' needs a positive increment, a start and an end character")
        elif kt is KeyType.date:
            if op is not Operation.range:
                raise SplitSpecError("date keys support only 'range'")
            if not self.increment:
                raise SplitSpecError("date 'range' needs a positive month increment")

    # ---------------------------------------------------------------- helpers
    def matches_table(self, schema: str | None, table: str) -> bool:
        """Case-insensitive table match; the schema must match too when given."""
        name = self.table
        if "." in name:
            sch, tab = name.split(".", 1)
            if schema is not None and sch.lower() != schema.lower():
                return False
            return tab.lower() == table.lower()
        return name.lower() == table.lower()

    @property
    def key_columns(self) -> tuple[str, ...]:
        return self.columns if self.operation is Operation.query else (self.column,)
