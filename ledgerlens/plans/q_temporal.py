"""Queries: time steps, per-step counts, cumulative/rolling stats, bursts."""

from __future__ import annotations

from ledgerlens.operators import temporal
from ledgerlens.plans.oracle import with_fixtures
from ledgerlens.plans.queries import register

_COUNTS_SQL = """
tx_time as (select s.txId, s.time_step, c.class from tx_steps s join tx_classes c using (txId)),
counts as (
  select time_step,
         count(*) filter (where class = 1) as illicit,
         count(*) filter (where class = 2) as licit,
         count(*) filter (where class = 3) as unknown,
         count(*) as total
  from tx_time group by time_step)"""

_T = ("tx_steps", "tx_classes")


def _counts(t):
    return temporal.step_class_counts(temporal.tx_time(t.tx_steps, t.tx_classes))


@register("tx_time_steps", with_fixtures("select txId, time_step from tx_steps", "tx_steps"))
def tx_time_steps(t):
    return temporal.tx_time_steps(t.tx_steps)


@register("synthetic_time_steps", with_fixtures("""
with n as (select count(*) as n from tx_classes),
r as (select txId, row_number() over (order by txId) as rn from tx_classes)
select txId, cast(least(49, floor((rn - 1) / greatest(1, n // 49)) + 1) as integer) as time_step
from r, n""", "tx_classes"))
def synthetic_time_steps(t):
    return temporal.synthetic_steps(t.tx_classes)


@register("tx_time_classes", with_fixtures(
    "select s.txId, s.time_step, c.class from tx_steps s join tx_classes c using (txId)", *_T))
def tx_time_classes(t):
    return temporal.tx_time(t.tx_steps, t.tx_classes)


@register("step_class_counts", with_fixtures(
    f"with {_COUNTS_SQL} select * from counts order by time_step", *_T))
def step_class_counts(t):
    return _counts(t)


@register("temporal_distribution", with_fixtures(f"""
with {_COUNTS_SQL},
cum as (
  select *, sum(illicit) over w as s_ill, sum(total) over w as s_tot,
         round(avg(illicit) over (order by time_step rows between 2 preceding and current row), 2)
           as rolling_3step
  from counts
  window w as (order by time_step rows between unbounded preceding and current row))
select time_step, illicit, licit, unknown, total,
       cast(s_ill as bigint) as cum_illicit, cast(s_tot as bigint) as cum_total,
       round(s_ill / s_tot * 100, 3) as illicit_rate_pct, rolling_3step
from cum order by time_step""", *_T))
def temporal_distribution(t):
    return temporal.temporal_distribution(_counts(t))


@register("rolling_illicit_rate", with_fixtures(f"""
with {_COUNTS_SQL},
r as (
  select time_step, illicit, total, sum(illicit) over w as ri, sum(total) over w as rt
  from counts window w as (order by time_step rows between 2 preceding and current row))
select time_step, illicit, total, cast(ri as bigint) as rolling_illicit,
       cast(rt as bigint) as rolling_total, round(ri * 100.0 / rt, 3) as rolling_rate_pct
from r order by time_step""", *_T))
def rolling_illicit_rate(t):
    return temporal.rolling_illicit_rate(_counts(t))


# illicit count over this many times the mean of the three steps before: over all
# wallets, and of a wallet
BURST_FACTOR = 1.1
WALLET_BURST_FACTOR = 1.5


@register("fraud_bursts", with_fixtures(f"""
with {_COUNTS_SQL},
p as (
  select time_step, illicit,
         avg(illicit) over (order by time_step rows between 3 preceding and 1 preceding) as pm
  from counts)
select time_step, illicit, round(pm, 2) as prev_mean,
       case when pm <> 0 then round(illicit / pm, 3) end as burst_ratio
from p where illicit > {BURST_FACTOR} * pm order by time_step""", *_T))
def fraud_bursts(t):
    return temporal.fraud_bursts(_counts(t), factor=BURST_FACTOR)


# A wallet's steps vary however evenly the orders of all wallets are spread.
@register("wallet_bursts", with_fixtures(f"""
with n as (
  select a.input_address as address, s.time_step, count(*) filter (where c.class = 1) as illicit
  from addr_tx a join tx_steps s using (txId) join tx_classes c using (txId) group by all),
p as (
  select *, avg(illicit) over (partition by address order by time_step
                               rows between 3 preceding and 1 preceding) as pm
  from n)
select address, time_step, illicit, round(pm, 2) as prev_mean,
       case when pm <> 0 then round(illicit / pm, 3) end as burst_ratio
from p where illicit > {WALLET_BURST_FACTOR} * pm""", "addr_tx", *_T))
def wallet_bursts(t):
    counts = temporal.wallet_step_counts(t.addr_tx, temporal.tx_time(t.tx_steps, t.tx_classes))
    return temporal.fraud_bursts(counts, factor=WALLET_BURST_FACTOR, by=("address",))
