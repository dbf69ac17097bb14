"""Exact order statistics by bracketed selection, without ordering all rows.

One wide pass of mergeable sketches (``percentile_approx``) brackets every wanted
rank; a second pass counts the values below each bracket and keeps only those
inside it, per distinct value.  Both passes read the rows as they are: no value
is exploded and no row is ordered.  The counts prove that a bracket holds its
ranks (a bracket that does not is widened and the second pass repeated); inside,
the values are ranked exactly.  A bracket with too many distinct values is
narrowed on the kept values alone, by exact counts between sketched cut points,
so no task ever orders more than ``most`` rows, and a value held by many rows is
one row.

Brackets and counts (a few numbers per wanted rank) pass through the driver.
The functions run jobs when called.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.session import stored

#: Distinct values of one bracket that one task may order.
MOST = 500_000
#: Relative rank accuracy of the sketches, and the cut points of a narrowing round.
ACCURACY, CUTS = 1000, 256


@dataclass
class Wanted:
    """Ranks ``first`` and ``last`` (from 0, nulls not counted, NaN largest; last
    is first or the next) of a column, and the bracket that should hold both."""

    column: str
    first: int
    last: int
    low: float | int = -np.inf
    high: float | int = np.inf


def _sketch(df: DataFrame, column: str, points: Sequence[float], accuracy: int) -> Column:
    """Approximate quantiles at ``points`` (outside of 0 to 1: the ends)."""
    x = F.col(f"`{column}`")
    if dict(df.dtypes)[column] in ("double", "float"):
        x = F.nanvl(x, F.lit(float("inf")))      # NaN is the largest value
    return F.percentile_approx(x, [min(max(p, 0.0), 1.0) for p in points], accuracy)


def _bracket(w: Wanted, low: float, high: float, at: Sequence | None) -> None:
    """Set ``w``'s bracket from the sketched values at the points ``low`` and ``high``."""
    if at is not None:
        w.low, w.high = (at[0] if low > 0 else -np.inf), (at[1] if high < 1 else np.inf)


def _sketched(df: DataFrame, wanted: list[Wanted], counts: dict[str, int], accuracy: int) -> None:
    """Set the brackets of ``wanted`` from one wide pass of sketches."""
    margin = 3.0 / accuracy
    points = [(w.first / counts[w.column] - margin, w.last / counts[w.column] + margin) for w in wanted]
    row = df.agg(*[_sketch(df, w.column, p, accuracy).alias(f"q{j}") for j, (w, p) in enumerate(zip(wanted, points, strict=True))]).first()
    for w, p, at in zip(wanted, points, row, strict=True):
        _bracket(w, *p, at)


def _bracketed(df: DataFrame, wanted: list[Wanted]) -> DataFrame:
    """j (index in ``wanted``), value, n: the values inside bracket j and how often
    they occur; the row with the null value counts the values below it.  One pass;
    partial counts per batch, so a hot value collapses where it is read."""
    cols = list(dict.fromkeys(w.column for w in wanted))
    types = dict(df.dtypes)
    kind = "double" if any(types[c] in ("double", "float") for c in cols) else "long"
    plan = [(cols.index(w.column), w.low, w.high) for w in wanted]

    def run(batches):
        import pyarrow as pa

        below = np.zeros(len(plan), np.int64)
        for rows in batches:
            values = [c.drop_null().to_numpy(zero_copy_only=False) for c in rows.columns]
            j, v, n = [], [], []
            for i, (c, low, high) in enumerate(plan):
                x = values[c]
                below[i] += np.count_nonzero(x < low)
                there = (x >= low) & (x <= high)
                held, times = np.unique(x[there | (x != x)] if high == np.inf else x[there], return_counts=True)
                j.append(np.full(len(held), i))
                v.append(held)
                n.append(times)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(j)), pa.array(np.concatenate(v)), pa.array(np.concatenate(n))], names=["j", "value", "n"])
        value = pa.nulls(len(plan), pa.float64() if kind == "double" else pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(plan))), value, pa.array(below)], names=["j", "value", "n"])

    slim = df.select(*[F.col(f"`{c}`").cast(kind) for c in cols])
    found = slim.mapInArrow(run, f"j long, value {kind}, n long")
    return found.groupBy("j", "value").agg(F.sum("n").alias("n"))


def _narrowed(inside: DataFrame, sizes: dict[int, int], offsets: dict[int, int], wanted: list[Wanted], cuts: int) -> DataFrame:
    """``inside`` with the brackets ``sizes`` cut down to the sketched intervals
    that hold their ranks; ``offsets`` (values below a bracket) move along."""
    big = inside.where(F.col("j").isin(list(sizes)))
    value = F.nanvl(F.col("value").cast("double"), F.lit(None).cast("double"))
    at = big.groupBy("j").agg(F.percentile_approx(value, [(k + 1) / cuts for k in range(cuts - 1)], 10 * cuts).alias("cuts"))
    marked = big.join(F.broadcast(at), "j")     # one row per bracket
    counted = marked.groupBy("j", F.expr("size(filter(cuts, c -> c < value))").alias("part")).agg(
        F.sum("n").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")).collect()  # at most cuts rows per bracket
    for j in sizes:
        before, bounds = offsets[j], []
        for r in sorted((r for r in counted if r.j == j), key=lambda r: r.part):
            if before + r.n > wanted[j].first and before <= wanted[j].last:
                bounds.append((before, r.low, r.high))
            before += r.n
        offsets[j], wanted[j].low, wanted[j].high = bounds[0][0], bounds[0][1], bounds[-1][2]
    keep = ~F.col("j").isin(list(sizes))
    for j in sizes:
        keep = keep | ((F.col("j") == j) & F.col("value").between(wanted[j].low, wanted[j].high))
    return inside.where(keep)


def order_statistics(df: DataFrame, wanted: list[Wanted], counts: dict[str, int], accuracy: int = ACCURACY, most: int = MOST, cuts: int = CUTS,
                     sketched: bool = False) -> DataFrame:
    """j, v_first, v_last: the values at the ranks of ``wanted[j]`` (doubles, or longs
    where all columns are whole numbers).  ``counts``: values per column that are
    not null; ranks beyond them are left out.  ``sketched``: the brackets are set."""
    live = [j for j, w in enumerate(wanted) if 0 <= w.first and w.last < counts[w.column]]
    if not live:
        return df.sparkSession.createDataFrame([], "j long, v_first double, v_last double")
    asked, numbers = [wanted[j] for j in live], {k: j for k, j in enumerate(live)}
    if not sketched:
        _sketched(df, asked, counts, accuracy)
    while True:
        held = stored(_bracketed(df, asked), "brackets")
        facts = held.groupBy("j").agg(F.sum(F.when(F.col("value").isNull(), F.col("n"))).alias("below"), F.sum("n").alias("upto"),
                                      F.count("value").alias("values")).collect()  # one row per wanted rank
        missed = [asked[r.j] for r in facts if not (r.below <= asked[r.j].first and asked[r.j].last < r.upto)]
        if not missed:
            break
        for w in missed:    # the sketch was off: take everything on both sides
            w.low, w.high = -np.inf, np.inf
    offsets = {r.j: r.below for r in facts}
    inside, sizes = held.where(F.col("value").isNotNull()), {r.j: r["values"] for r in facts}
    while over := {j: n for j, n in sizes.items() if n > most}:
        inside = stored(_narrowed(inside, over, offsets, asked, cuts), "brackets")
        left = {r.j: r["count"] for r in inside.groupBy("j").count().collect()}  # one row per wanted rank
        if all(left[j] == n for j, n in over.items()):
            break
        sizes = left
    facts = df.sparkSession.createDataFrame([(k, numbers[k], asked[k].first - offsets[k], asked[k].last - offsets[k]) for k in numbers],
                                            "j long, number long, first long, last long")
    upto = F.sum("n").over(Window.partitionBy("j").orderBy("value"))     # at most ``most`` rows each
    ranked = inside.select("j", "value", (upto - F.col("n")).alias("start"), upto.alias("end")).join(F.broadcast(facts), "j")

    def at(rank):
        return F.max(F.when((F.col("start") <= F.col(rank)) & (F.col(rank) < F.col("end")), F.col("value")))

    return ranked.groupBy(F.col("number").alias("j")).agg(at("first").alias("v_first"), at("last").alias("v_last"))


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], accuracy: int = ACCURACY, **options) -> DataFrame:
    """column, p, value: linear-interpolation quantiles (as ``percentile`` /
    ``quantile_cont``) of every numeric column, exact; columns without values are
    absent.  Values are taken as doubles; counts and sketches are one pass."""
    spark, margin = df.sparkSession, 3.0 / accuracy
    slim = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    points = [x for p in probs for x in (p - margin, p + margin)]
    row = slim.agg(*[F.struct(F.count(c).alias("n"), _sketch(slim, c, points, accuracy).alias("at")).alias(c) for c in slim.columns]).first()
    wanted, keys, counts = [], [], {c: row[c].n for c in slim.columns}
    for c, name in zip(slim.columns, cols, strict=True):
        for k, p in enumerate(probs):
            rank = p * (counts[c] - 1)
            wanted.append(Wanted(c, int(np.floor(rank)), int(np.ceil(rank))))
            _bracket(wanted[-1], p - margin, p + margin, row[c].at and row[c].at[2 * k:2 * k + 2])
            keys.append((len(keys), name, float(p), float(rank - np.floor(rank))))
    found = order_statistics(slim, wanted, counts, accuracy, sketched=True, **options)
    named = spark.createDataFrame(keys, "j long, column string, p double, frac double")
    value = F.col("v_first") + F.when(F.col("frac") == 0, 0.0).otherwise((F.col("v_last") - F.col("v_first")) * F.col("frac"))
    return named.join(F.broadcast(found), "j").select("column", "p", value.alias("value"))
