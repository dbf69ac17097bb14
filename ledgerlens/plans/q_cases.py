"""Queries: neighbourhood case analysis (flagship)."""

from __future__ import annotations

from ledgerlens.operators import cases
from ledgerlens.plans.oracle import with_fixtures
from ledgerlens.plans.queries import register

_CASES_SQL = """
cases as (
  select e.txId1,
         count(e.txId2) as total_nb,
         cast(count(*) filter (where c2.class = 1) as bigint) as illicit_nb,
         cast(count(*) filter (where c2.class = 2) as bigint) as licit_nb
  from tx_edges e
  left join tx_classes c2 on e.txId2 = c2.txId
  where e.txId1 in (select txId from tx_classes where class = 1)
  group by e.txId1),
graded as (
  select *, round(illicit_nb / total_nb, 4) as illicit_ratio
  from cases),
typed as (
  select *, case when illicit_ratio = 1.0 then 'EASY'
                 when illicit_ratio = 0.0 then 'HARD' else 'AVERAGE' end as case_type
  from graded)
"""


@register("fraud_cases", with_fixtures(f"with {_CASES_SQL} select * from typed",
                                       "tx_classes", "tx_edges"))
def fraud_cases(t):
    return cases.fraud_cases(t.tx_edges, t.tx_classes)


@register("case_summary", with_fixtures(f"""
with {_CASES_SQL}
select case_type, count(*) as count,
       round(avg(total_nb), 2) as avg_neighbours,
       round(avg(illicit_ratio), 4) as avg_illicit_ratio
from typed group by case_type order by count desc, case_type""", "tx_classes", "tx_edges"))
def case_summary(t):
    return cases.case_summary(cases.fraud_cases(t.tx_edges, t.tx_classes))
