"""Time-step operators: step assignment, per-step class counts, cumulative and
rolling statistics, rolling rates and bursts.

The per-step table has one row per time step (49 in the data model), so the
cumulative / rolling windows over it are safe without a partition key.  The
fallback step assignment selects the ids at its cuts and orders no row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.operators.selection import Wanted, order_statistics
from ledgerlens.sources.schemas import ILLICIT, LICIT, N_TIME_STEPS, UNKNOWN


def tx_time_steps(features: DataFrame, time_col: str = "time_step") -> DataFrame:
    """txId (bigint), time_step (int) from a feature table."""
    return features.select(F.col("txId").cast("bigint").alias("txId"),
                           F.col(f"`{time_col}`").cast("int").alias("time_step"))


def synthetic_steps(classes: DataFrame, steps: int = N_TIME_STEPS, **options) -> DataFrame:
    """Fallback when no feature table exists: cut the transactions, ordered by
    id, into ``steps`` equal runs of max(1, n // steps) rows (the rest in the
    last step).  Returns txId, time_step.

    Only the ids at the cuts are selected (``order_statistics``, at most steps - 1
    ids, run when called); the step is then a comparison with them, so no row is
    ordered or shuffled.  Rows with equal ids share a step; null ids come first and
    are in step 1."""
    ids = classes.select("txId")
    n, there = ids.agg(F.count(F.lit(1)), F.count("txId")).first()
    run = max(1, n // steps)
    ranks = [run * k - (n - there) for k in range(1, steps) if run * k < n]
    first = sum(r < 0 for r in ranks)        # cuts among the null ids
    at = order_statistics(ids, [Wanted("txId", r, r) for r in ranks[first:]], {"txId": there}, **options)
    cuts = [r.v_first for r in at.collect()]     # at most steps - 1
    step = F.lit(1)
    for cut in sorted(cuts):
        step = step + (F.col("txId") >= F.lit(cut)).cast("int")
    return ids.select("txId", F.coalesce(step + first, F.lit(1)).cast("int").alias("time_step"))


def tx_time(steps: DataFrame, classes: DataFrame) -> DataFrame:
    """txId, time_step, class (inner join on txId)."""
    return steps.join(classes.select("txId", "class"), "txId")


def step_class_counts(tx_time_df: DataFrame) -> DataFrame:
    """time_step, illicit, licit, unknown, total (null/other classes only in total)."""
    c = F.col("class")
    return (tx_time_df.groupBy("time_step")
                      .agg(F.count_if(c == ILLICIT).alias("illicit"),
                           F.count_if(c == LICIT).alias("licit"),
                           F.count_if(c == UNKNOWN).alias("unknown"),
                           F.count(F.lit(1)).alias("total"))
                      .orderBy("time_step"))


def wallet_step_counts(addr_tx: DataFrame, tx_time_df: DataFrame) -> DataFrame:
    """address, time_step, illicit, total: the transactions that a wallet puts in, per
    step (only steps with any; a transaction named twice counts twice).

    Joined on the transaction, added up before the shuffle by wallet: a hot wallet has
    one row per step after it."""
    joined = addr_tx.join(tx_time_df, "txId")
    return joined.groupBy(F.col("input_address").alias("address"), "time_step").agg(
        F.count_if(F.col("class") == ILLICIT).alias("illicit"), F.count(F.lit(1)).alias("total"))


def _steps(frame_lo, frame_hi, by=()):
    # one row per time step (and group): a window here orders <= #steps rows
    order = Window.partitionBy(*by).orderBy("time_step") if by else Window.orderBy("time_step")
    return order.rowsBetween(frame_lo, frame_hi)


def temporal_distribution(counts: DataFrame) -> DataFrame:
    """Adds cum_illicit, cum_total, illicit_rate_pct (cumulative, 3 d.p., unknown
    in the denominator) and rolling_3step (mean illicit count of this and the
    two previous steps, 2 d.p.)."""
    cum = _steps(Window.unboundedPreceding, Window.currentRow)
    return (counts.withColumn("cum_illicit", F.sum("illicit").over(cum))
                  .withColumn("cum_total", F.sum("total").over(cum))
                  .withColumn("illicit_rate_pct",
                              F.round(F.col("cum_illicit") / F.col("cum_total") * 100, 3))
                  .withColumn("rolling_3step", F.round(F.avg("illicit").over(_steps(-2, 0)), 2))
                  .orderBy("time_step"))


def rolling_illicit_rate(counts: DataFrame, width: int = 3) -> DataFrame:
    """time_step, illicit, total, rolling_illicit, rolling_total,
    rolling_rate_pct: illicit share of the last ``width`` steps (3 d.p.)."""
    w = _steps(-(width - 1), 0)
    return (counts.select("time_step", "illicit", "total",
                          F.sum("illicit").over(w).alias("rolling_illicit"),
                          F.sum("total").over(w).alias("rolling_total"))
                  .withColumn("rolling_rate_pct",
                              F.round(F.try_divide(F.col("rolling_illicit") * 100.0,
                                                   F.col("rolling_total")), 3))
                  .orderBy("time_step"))


def fraud_bursts(counts: DataFrame, factor: float = 1.5, lookback: int = 3, by: tuple[str, ...] = ()) -> DataFrame:
    """Steps whose illicit count exceeds ``factor`` x the mean of the previous
    ``lookback`` steps: time_step, illicit, prev_mean (2 d.p.), burst_ratio (3 d.p.;
    null after steps with no illicit transactions, where any illicit count is a
    burst).  The first step has no history and is never a burst.

    With ``by`` each group of these columns has a history of its own, of the steps that
    it has rows for; the columns come first, and the rows are not sorted."""
    prev = F.avg("illicit").over(_steps(-lookback, -1, by))
    out = (counts.select(*by, "time_step", "illicit", prev.alias("prev_mean"))
                 .where(F.col("illicit") > factor * F.col("prev_mean"))
                 .select(*by, "time_step", "illicit", F.round("prev_mean", 2).alias("prev_mean"),
                         F.round(F.try_divide(F.col("illicit"), F.col("prev_mean")), 3)
                          .alias("burst_ratio")))
    return out if by else out.orderBy("time_step")
