"""Table profiling: null counts, feature summaries, box-plot numbers,
correlations and equal-width histograms - all over every row (no samples).

Exact quantiles avoid the ``percentile`` aggregate, which keeps every distinct
value of a group in one task: bracketed selection (``operators.selection``) finds
them in two wide passes over the rows as they are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.rules import bin_index
from ledgerlens.operators import selection
from ledgerlens.operators.ordering import with_running_sums
from ledgerlens.session import stored


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """bin, bin_lo, bin_hi, count over equal-width bins of [min, max].

    Values are first counted per distinct value (one shuffle; repeated values
    collapse map-side) and that table is written once.  Both the min/max scalar
    subquery and the bin counts read it, so the input is computed once; the
    maximum lands in the last bin; empty bins are kept with count 0.
    """
    x = df.select(F.col(col).cast("double").alias("x")).where(F.col("x").isNotNull())
    per_value = stored(x.groupBy("x").agg(F.count(F.lit(1)).alias("n")), "values")
    stats = per_value.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi")).alias("s")).scalar()

    def with_range(d):   # attach the subquery once; lo / width by reference
        return (d.withColumn("_h", stats)
                 .withColumn("_lo", F.col("_h.lo"))
                 .withColumn("_w", (F.col("_h.hi") - F.col("_h.lo")) / F.lit(float(bins))))

    counts = (with_range(per_value).select(bin_index("x", "_lo", "_w", bins).alias("bin"), "n")
                                   .groupBy("bin").agg(F.sum("n").alias("count")))
    frame = with_range(df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")))
    lo, width = F.col("_lo"), F.col("_w")
    return (frame.join(F.broadcast(counts), "bin", "left")      # <= bins rows
                 .select("bin",
                         F.round(lo + F.col("bin") * width, 6).alias("bin_lo"),
                         F.round(lo + (F.col("bin") + 1) * width, 6).alias("bin_hi"),
                         F.coalesce("count", F.lit(0)).alias("count")))


def null_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """dataset, total_rows, null_count (SQL nulls summed over all columns).

    One aggregation pass per table."""
    parts = []
    for name, df in tables.items():
        nulls = [F.count_if(F.col(f"`{c}`").isNull()) for c in df.columns]
        total_nulls = nulls[0]
        for n in nulls[1:]:
            total_nulls = total_nulls + n
        parts.append(df.agg(F.count(F.lit(1)).alias("total_rows"), total_nulls.alias("null_count"))
                       .select(F.lit(name).alias("dataset"), "total_rows", "null_count"))
    return _union(parts)


def null_columns(tables: Mapping[str, DataFrame]) -> DataFrame:
    """dataset, column, nulls: the per-column breakdown of ``null_profile``."""
    parts = []
    for name, df in tables.items():
        row = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}")
                       for i, c in enumerate(df.columns)])
        pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("nulls"))
                          for i, c in enumerate(df.columns)])
        parts.append(row.select(F.lit(name).alias("dataset"), F.inline(pairs)))
    return _union(parts)


def long_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value) for every non-null value of the named numeric columns."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
                      for c in cols])
    return df.select(F.inline(pairs)).where(F.col("value").isNotNull())


def exact_quantiles(long: DataFrame, probs: Sequence[float]) -> DataFrame:
    """column, p, value: linear-interpolation quantiles (as ``percentile`` /
    ``quantile_cont``) of values that come as (column, value) rows, computed without
    collecting a column into one task (wide tables: ``selection.quantiles``).

    Values are first counted per (column, value) - map-side partial
    aggregation, so a value repeated in a third of the rows collapses to one
    row - then cumulated over the distinct values in range-sliced order.  Each
    distinct value covers positions [start, end) of its column; the two
    positions around each quantile are looked up by an equi-join on the column
    with the (#columns x #quantiles x 2)-row target table.
    """
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("cnt"))
    cum = stored(with_running_sums(counts, ["column", "value"], ["cnt"]), "cumulated")   # global cum_cnt
    per_col = cum.groupBy("column").agg(F.min(F.col("cum_cnt") - F.col("cnt")).alias("base"),
                                        F.sum("cnt").alias("n"))
    # one row per column: safe to broadcast
    spans = (cum.join(F.broadcast(per_col), "column")
                .select("column", "value",
                        (F.col("cum_cnt") - F.col("base") - F.col("cnt")).alias("pos_from"),
                        (F.col("cum_cnt") - F.col("base")).alias("pos_to")))
    pos = F.lit(0.0) + F.col("p") * (F.col("n") - 1)
    targets = (per_col.select("column", "n",
                              F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("p"))
                      .select("column", "p", F.floor(pos).alias("lo"), F.ceil(pos).alias("hi"),
                              (pos - F.floor(pos)).alias("frac")))
    needed = targets.select(
        "column", "p", "frac",
        F.explode(F.array(F.struct(F.lit("lo").alias("side"), F.col("lo").alias("at")),
                          F.struct(F.lit("hi").alias("side"), F.col("hi").alias("at"))))
         .alias("t")).select("column", "p", "frac", "t.side", "t.at")
    # needed has (#columns x #probs x 2) rows: safe to broadcast
    picked = spans.join(F.broadcast(needed),
                        (spans["column"] == needed["column"]) & (needed["at"] >= spans["pos_from"])
                        & (needed["at"] < spans["pos_to"])).select(
        spans["column"], "p", "frac", "side", "value")
    both = picked.groupBy("column", "p").agg(
        F.max(F.when(F.col("side") == "lo", F.col("value"))).alias("v_lo"),
        F.max(F.when(F.col("side") == "hi", F.col("value"))).alias("v_hi"),
        F.first("frac").alias("frac"))
    return both.select("column", "p",
                       (F.col("v_lo") + (F.col("v_hi") - F.col("v_lo")) * F.col("frac"))
                       .alias("value"))


#: The quantiles of both profile tables.
QUARTILES = (0.25, 0.5, 0.75)


def quartiles(df: DataFrame, cols: Sequence[str], accuracy: int | None = None) -> DataFrame:
    """column, p25, p50, p75 of every column with values: exact, or with
    ``accuracy`` approximate (one pass of bounded sketches, relative rank error
    about 1/accuracy).  ``feature_summary`` and ``box_stats`` both take the result,
    so a report selects once."""
    if accuracy:
        row = df.agg(*[F.percentile_approx(F.col(f"`{c}`").cast("double"), list(QUARTILES), accuracy).alias(f"q{i}") for i, c in enumerate(cols)])
        cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"q{i}").alias("q")) for i, c in enumerate(cols)])
        return row.select(F.inline(cells)).where("q is not null").select("column", *[F.col("q")[i].alias(n) for i, n in enumerate(("p25", "p50", "p75"))])
    q = selection.quantiles(df, cols, QUARTILES)
    return q.groupBy("column").agg(*[F.max(F.when(F.col("p") == p, F.col("value"))).alias(n) for p, n in zip(QUARTILES, ("p25", "p50", "p75"), strict=True)])


def feature_summary(df: DataFrame, cols: Sequence[str], accuracy: int | None = None, q: DataFrame | None = None) -> DataFrame:
    """column, count, min, p25, p50, p75, max, mean, stddev (sample); 6 d.p.

    Exact quartiles by default (``df.summary`` would give approximate ones);
    ``accuracy`` opts into ``percentile_approx``.  ``q``: ``quartiles`` of the same
    columns, if at hand."""
    # moments: one wide aggregation over the rows as they are, no exploded values
    x = [F.col(c).cast("double") for c in cols]
    wide = df.agg(*[F.struct(F.count(v).alias("count"), F.min(v).alias("min"), F.max(v).alias("max"),
                             F.round(F.avg(v), 6).alias("mean"), F.round(F.stddev_samp(v), 6).alias("stddev")).alias(f"m{i}")
                    for i, v in enumerate(x)])
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("m")) for i, c in enumerate(cols)])
    moments = wide.select(F.inline(cells)).select("column", "m.*").where(F.col("count") > 0)
    q = quartiles(df, cols, accuracy) if q is None else q
    out = moments.join(q, "column")   # both have one row per column
    return out.select("column", "count", "min",
                      *[F.round(c, 6).alias(c) for c in ("p25", "p50", "p75")],
                      "max", "mean", "stddev")


def box_stats(df: DataFrame, cols: Sequence[str], whisker: float = 1.5,
              accuracy: int | None = None, q: DataFrame | None = None) -> DataFrame:
    """column, q1, median, q3, iqr, whisker_low, whisker_high, outliers.

    Whiskers are the most extreme values inside [q1 - 1.5 iqr, q3 + 1.5 iqr];
    outliers are the values outside it (box-plot convention).  ``q``: ``quartiles``
    of the same columns, if at hand."""
    q = quartiles(df, cols, accuracy) if q is None else q
    q = q.select("column", F.col("p25").alias("q1"), F.col("p50").alias("median"), F.col("p75").alias("q3"), (F.col("p75") - F.col("p25")).alias("iqr"))
    q = q.withColumn("lo_fence", F.col("q1") - whisker * F.col("iqr")) \
         .withColumn("hi_fence", F.col("q3") + whisker * F.col("iqr"))
    # the fences, one row per column, become one map that a single wide pass reads
    fences = q.agg(F.map_from_entries(F.collect_list(F.struct("column", F.struct("lo_fence", "hi_fence")))).alias("f")).scalar()
    marked = df.select(*[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(cols)]).withColumn("_f", fences)
    inside = [(F.col(f"v{i}") >= F.try_element_at("_f", F.lit(c))["lo_fence"]) & (F.col(f"v{i}") <= F.try_element_at("_f", F.lit(c))["hi_fence"])
              for i, c in enumerate(cols)]
    wide = marked.agg(*[F.struct(F.min(F.when(ok, F.col(f"v{i}"))).alias("whisker_low"), F.max(F.when(ok, F.col(f"v{i}"))).alias("whisker_high"),
                                 F.count_if(~ok).alias("outliers")).alias(f"m{i}") for i, ok in enumerate(inside)])
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("m")) for i, c in enumerate(cols)])
    agg = wide.select(F.inline(cells)).select("column", "m.*")
    return (q.join(agg, "column")
             .select("column", *[F.round(c, 6).alias(c) for c in ("q1", "median", "q3", "iqr")],
                     F.round("whisker_low", 6).alias("whisker_low"),
                     F.round("whisker_high", 6).alias("whisker_high"), "outliers"))


def correlation_matrix(df: DataFrame, cols: Sequence[str], digits: int = 6,
                       method: str = "pairwise") -> DataFrame:
    """a, b, r: Pearson correlation of every ordered pair of columns.

    ``method`` decides which rows a pair uses, whatever the number of columns:
    ``"pairwise"`` (default) takes each pair's own rows without null or NaN,
    ``"complete"`` the rows without any.  One pass adds up, per task, the matrix
    products of centred values and presence masks (4 d x d sums), so hundreds of
    columns need no expression per pair.  The result is d x d, bounded by the
    columns; r is null where a side has no variance.  Runs two jobs when called.
    """
    if method not in ("pairwise", "complete"):
        raise ValueError(f"unknown method {method!r}")
    x = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(f"x{i}") for i, c in enumerate(cols)])
    if method == "complete":
        x = x.dropna()
    centre = np.array([m or 0.0 for m in x.agg(*[F.avg(c) for c in x.columns]).first()])
    sums = np.zeros((4, len(cols), len(cols)))
    for row in x.mapInArrow(_cross_sums(centre), "k long, v double").groupBy("k").agg(F.sum("v")).collect():
        sums.ravel()[row[0]] = row[1]       # 4 d x d numbers
    n, s, q, p = sums                       # s[i, j]: sum of x_i over the rows of pair (i, j)
    with np.errstate(all="ignore"):
        var = n * q - s * s
        r = (n * p - s * s.T) / np.sqrt(np.where(var > 1e-12 * n * q, var, np.nan) * np.where(var > 1e-12 * n * q, var, np.nan).T)
    rows = [(a, b, None if np.isnan(r[i, j]) else round(float(r[i, j]), digits))
            for i, a in enumerate(cols) for j, b in enumerate(cols)]
    return df.sparkSession.createDataFrame(rows, "a string, b string, r double")


def _cross_sums(centre: np.ndarray):
    def run(batches):
        import pyarrow as pa
        d = len(centre)
        total = np.zeros((4, d, d))
        for rows in batches:
            v = np.column_stack([c.to_numpy(zero_copy_only=False) for c in rows.columns]).astype(float)
            there = ~np.isnan(v)
            m, v = there.astype(float), np.where(there, v - centre, 0.0)
            total += np.array([m.T @ m, v.T @ m, (v * v).T @ m, v.T @ v])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["k", "v"])

    return run


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
