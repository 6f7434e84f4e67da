"""Distributed global numbering (no single-task window).

``Window.orderBy(...)`` without ``partitionBy`` pulls every row into one
task. Instead:

1. range-partition on the order key and sort inside each partition;
2. checkpoint (reliable, in the shared checkpoint folder) so partition ids
   and in-partition order are fixed on recompute / executor loss;
3. collect one small total per partition (P rows), turn them into offsets;
4. add the offsets back with a literal map keyed by partition id.

``monotonically_increasing_id`` encodes the partition id and the position,
so all of it is JVM-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir

_PID_SHIFT = 33


def range_sorted_checkpoint(df: DataFrame, order: list[Column], num_partitions: int | None = None) -> DataFrame:
    """Range-partition + sort within partitions, then a reliable checkpoint.

    Without an explicit count the shuffle uses the session's partitions and
    AQE may coalesce neighbouring ranges (order is kept); the checkpoint then
    fixes whatever layout ran, so partition ids are stable afterwards."""
    checkpoint_dir(df.sparkSession)
    ranged = df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order).checkpoint(eager=True)


def _offset_map(totals: list[tuple[int, int]]) -> Column:
    """Literal map pid -> exclusive prefix sum of the per-partition totals."""
    running, pairs = 0, []
    for pid, tot in sorted(totals):
        pairs += [F.lit(int(pid)), F.lit(int(running)).cast("long")]
        running += int(tot)
    if not pairs:
        return F.create_map(F.lit(0), F.lit(0).cast("long"))
    return F.create_map(*pairs)


def global_row_number(df: DataFrame, order: list[Column], name: str = "row_no",
                      num_partitions: int | None = None) -> DataFrame:
    """1-based row number in ``order`` across the whole DataFrame."""
    ck = range_sorted_checkpoint(df, order, num_partitions)
    tagged = ck.withColumn("_tx_mid", F.monotonically_increasing_id())
    pid = F.shiftright(F.col("_tx_mid"), _PID_SHIFT)
    totals = [(r["pid"], r["n"]) for r in tagged.groupBy(pid.alias("pid")).agg(F.count(F.lit(1)).alias("n")).collect()]
    offsets = _offset_map(totals)
    pos = F.col("_tx_mid").bitwiseAND(F.lit((1 << _PID_SHIFT) - 1))
    return tagged.withColumn(name, F.element_at(offsets, pid.cast("int")) + pos + F.lit(1)).drop("_tx_mid")
