"""``UNION`` batches of chunk queries (the Oracle ``unionize`` option).

Consecutive chunks are put into batches of ``batch`` (100 by default); a
batch is one output unit, and because the batch is a SQL ``UNION`` (not
``UNION ALL``) duplicate rows inside a batch collapse to one. Rows of
different batches are never compared.

Spark: ``batch_no = (chunk_no - 1) div batch + 1`` then
``dropDuplicates(batch_no + columns)`` — one shuffle hashed on the whole
row, so a batch holding a third of the table still spreads over all tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_batches(assigned: DataFrame, columns: list[str], chunk_col: str = "chunk_no", batch: int = 100,
                  batch_col: str = "batch_no") -> DataFrame:
    if batch <= 0:
        raise ValueError("batch size must be positive")
    b = F.call_function("div", F.col(chunk_col) - 1, F.lit(batch).cast("long")) + 1
    out = assigned.select(b.cast("long").alias(batch_col), *[F.col(f"`{c}`") for c in columns])
    return out.dropDuplicates([batch_col] + list(columns))
