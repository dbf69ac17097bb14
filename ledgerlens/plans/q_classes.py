"""Queries: class labels, counts, imbalance, distribution."""

from __future__ import annotations

from ledgerlens.operators import classes
from ledgerlens.plans.oracle import LABEL_SQL, with_fixtures
from ledgerlens.plans.queries import register


@register("labelled_transactions", with_fixtures(f"""
select txId, class, {LABEL_SQL.format(c='class')} as label from tx_classes""", "tx_classes"))
def labelled_transactions(t):
    return classes.labelled(t.tx_classes)


@register("tx_class_counts", with_fixtures(f"""
select {LABEL_SQL.format(c='class')} as label, count(*) as count
from tx_classes group by 1 order by count desc""", "tx_classes"))
def tx_class_counts(t):
    return classes.class_counts(t.tx_classes)


@register("wallet_class_counts", with_fixtures(f"""
select {LABEL_SQL.format(c='class')} as label, count(*) as count
from wallet_classes group by 1 order by count desc""", "wallet_classes"))
def wallet_class_counts(t):
    return classes.class_counts(t.wallet_classes)


@register("class_imbalance", with_fixtures("""
with c as (
  select cast(count(*) filter (where class = 1) as bigint) as illicit,
         cast(count(*) filter (where class = 2) as bigint) as licit
  from tx_classes)
select illicit, licit,
       round(case when illicit + licit > 0 then illicit * 100.0 / (illicit + licit) end, 2)
         as illicit_pct,
       round(licit / greatest(illicit, 1), 1) as licit_to_illicit
from c""", "tx_classes"))
def class_imbalance(t):
    return classes.class_imbalance(t.tx_classes)


@register("class_distribution", with_fixtures(f"""
with tx as (
  select {LABEL_SQL.format(c='class')} as class, count(*) as n from tx_classes group by 1),
     w as (
  select {LABEL_SQL.format(c='class')} as class, count(*) as n from wallet_classes group by 1),
     label_frame(class) as (values ('illicit'), ('licit'), ('unknown'))
select l.class,
       coalesce(tx.n, 0) as tx_count,
       coalesce(round(tx.n * 100.0 / (select sum(n) from tx), 2), 0.0) as tx_pct,
       coalesce(w.n, 0) as wallet_count,
       coalesce(round(w.n * 100.0 / (select sum(n) from w), 2), 0.0) as wallet_pct
from label_frame l left join tx using (class) left join w using (class)
order by l.class""", "tx_classes", "wallet_classes"))
def class_distribution(t):
    return classes.class_distribution(t.tx_classes, t.wallet_classes)
