"""Global order operators that never pull all rows into one task.

A window with ``orderBy`` but no ``partitionBy`` runs in a single task, and a
window partitioned by a hot key runs that key in a single task.  Row numbers and
running sums here range-partition the rows on a total order (Spark samples the
bounds, so a hot key is split across slices) and add per-slice offsets from a
table with one row per slice.

The sampled bounds depend on the plan, so planning the same range shuffle twice
can give two different cuts.  The ranged rows are therefore written once to the
shared checkpoint folder with their slice and position, and slices and offsets
are both read from there.  These two operators run a job when called.

The order columns must form a total order (add a unique tie-breaker) when the
result depends on the position of tied rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.session import stored

_PART = "_lr_part"


def _num_parts(df: DataFrame, num_parts: int | None) -> int:
    if num_parts:
        return num_parts
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _sort_cols(order: Sequence) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


_POS_BITS = 33   # monotonically_increasing_id = (partition index << 33) + position


def _slices(df: DataFrame, cols: Sequence[Column], num_parts: int | None) -> DataFrame:
    """The rows, written in range-partitioned order, with their slice in
    ``_lr_part`` and their position in the slice (from 0) in ``_lr_pos``."""
    ranged = (df.repartitionByRange(_num_parts(df, num_parts), *cols).sortWithinPartitions(*cols)
                .withColumn("_lr_id", F.monotonically_increasing_id()))
    part = F.shiftright("_lr_id", _POS_BITS)
    pos = F.col("_lr_id") - F.shiftleft(part, _POS_BITS)
    return (stored(ranged, "ordered").withColumn(_PART, part.cast("int"))
            .withColumn("_lr_pos", pos).drop("_lr_id"))


def _slice_offsets(sliced: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Per slice: the totals of all *earlier* slices (exclusive prefix)."""
    totals = sliced.groupBy(_PART).agg(*[e.alias(k) for k, e in sums.items()])
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        _PART, *[F.coalesce(F.sum(k).over(before), F.lit(0)).alias(f"_off_{k}") for k in sums])


def with_row_number(df: DataFrame, order: Sequence, name: str = "rn",
                    num_parts: int | None = None) -> DataFrame:
    """Add a 1-based global row number over ``order`` (one range shuffle)."""
    sliced = _slices(df, _sort_cols(order), num_parts)
    offsets = _slice_offsets(sliced, {"n": F.count(F.lit(1))})
    return (sliced.join(F.broadcast(offsets), _PART)      # one row per slice
                  .withColumn(name, F.col("_off_n") + F.col("_lr_pos") + 1)
                  .drop(_PART, "_off_n", "_lr_pos"))


def with_running_sums(df: DataFrame, order: Sequence, sum_cols: Sequence[str],
                      prefix: str = "cum_", num_parts: int | None = None) -> DataFrame:
    """Add inclusive running sums of ``sum_cols`` over ``order`` (ROWS frame)."""
    sliced = _slices(df, _sort_cols(order), num_parts)
    offsets = _slice_offsets(sliced, {c: F.sum(c) for c in sum_cols})
    local = Window.partitionBy(_PART).orderBy("_lr_pos").rowsBetween(Window.unboundedPreceding, 0)
    out = sliced.join(F.broadcast(offsets), _PART)        # one row per slice
    for c in sum_cols:
        out = out.withColumn(f"{prefix}{c}", F.col(f"_off_{c}") + F.sum(c).over(local))
    return out.drop(_PART, "_lr_pos", *[f"_off_{c}" for c in sum_cols])


def next_in_group(df: DataFrame, group: str, order: Sequence[str], value: str,
                  coarse: Column, name: str = "next_value") -> DataFrame:
    """``lead(value) over (partition by group order by order)`` for every row,
    keeping only rows that have a successor in their group.

    ``coarse`` must never decrease along ``order`` (a month of a date, a rounded
    number): the lead is taken inside each (group, coarse) piece, so a hot group
    is spread over its pieces, and the last row of a piece takes the first row
    of the group's next piece from a table with one row per piece.  Nothing here
    depends on sampled bounds, so the plan is lazy.
    """
    rows = df.select(*dict.fromkeys([group, *order, value]), coarse.alias("_lr_c"))
    w = Window.partitionBy(group, "_lr_c").orderBy(*order)
    within = rows.withColumn("_lr_next", F.lead(F.struct(F.col(value).alias("v"))).over(w))
    first = F.min_by(F.struct(F.col(value).alias("v")), F.struct(*order))
    firsts = rows.groupBy(group, "_lr_c").agg(first.alias("_lr_first"))
    bridge = firsts.select(F.col(group).alias("_lr_g"), F.col("_lr_c").alias("_lr_b"), F.lead("_lr_first").over(
        Window.partitionBy(group).orderBy("_lr_c")).alias("_lr_first"))
    same = F.col(group).eqNullSafe(F.col("_lr_g")) & F.col("_lr_c").eqNullSafe(F.col("_lr_b"))
    out = within.join(bridge, same, "left").withColumn("_lr_next", F.coalesce("_lr_next", "_lr_first"))
    kept = [c for c in dict.fromkeys([group, *order, value])]
    return out.where(F.col("_lr_next").isNotNull()).select(*kept, F.col("_lr_next.v").alias(name))
