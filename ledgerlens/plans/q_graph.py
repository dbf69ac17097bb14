"""Queries: transaction-graph degrees, hubs and neighbour profiles."""

from __future__ import annotations

from ledgerlens.operators import graph
from ledgerlens.operators.class_bitmap import class_bitmap
from ledgerlens.plans.oracle import LABEL_SQL, with_fixtures
from ledgerlens.plans.queries import register


TOTAL_DEGREE_SQL = """
total_degree as (
  select txId, count(*) as degree from (
    select txId1 as txId from tx_edges union all select txId2 from tx_edges) u
  group by txId)"""

PROFILE_SQL = """
profile as (
  select e.txId1, c1.class as c1, count(e.txId2) as total_nb,
         cast(count(*) filter (where c2.class = 1) as bigint) as illicit_nb,
         round(count(*) filter (where c2.class = 1) / count(e.txId2), 4) as illicit_nb_ratio
  from tx_edges e
  left join tx_classes c2 on e.txId2 = c2.txId
  left join tx_classes c1 on e.txId1 = c1.txId
  group by e.txId1, c1.class)"""


def histogram_sql(src: str, col: str, bins: int) -> str:
    """DuckDB twin of ``operators.profile.histogram`` (as CTEs + final select)."""
    return f"""
vals as (select cast({col} as double) as x from {src} where {col} is not null),
s as (select min(x) as lo, max(x) as hi, (max(x) - min(x)) / {float(bins)} as w from vals),
c as (select cast(least({bins - 1}, case when s.w > 0 then floor((x - s.lo) / s.w) else 0 end)
                  as integer) as bin, count(*) as n
      from vals, s group by 1),
b as (select cast(range as integer) as bin from range({bins}))
select b.bin, round(s.lo + b.bin * s.w, 6) as bin_lo, round(s.lo + (b.bin + 1) * s.w, 6) as bin_hi,
       coalesce(c.n, 0) as count
from b cross join s left join c using (bin)"""


@register("tx_out_degree", with_fixtures("""
select txId1 as txId, count(*) as out_degree from tx_edges group by txId1""", "tx_edges"))
def tx_out_degree(t):
    return graph.out_degree(t.tx_edges)


@register("tx_in_degree", with_fixtures("""
select txId2 as txId, count(*) as in_degree from tx_edges group by txId2""", "tx_edges"))
def tx_in_degree(t):
    return graph.in_degree(t.tx_edges)


@register("tx_total_degree", with_fixtures(f"with {TOTAL_DEGREE_SQL} select * from total_degree",
                                           "tx_edges"))
def tx_total_degree(t):
    return graph.total_degree(t.tx_edges)


@register("degree_stats", with_fixtures(f"""
with {TOTAL_DEGREE_SQL}
select count(*) as nodes, max(degree) as max_degree, round(avg(degree), 6) as mean_degree,
       round(stddev_pop(degree), 6) as stdev_degree
from total_degree""", "tx_edges"))
def degree_stats(t):
    return graph.degree_stats(graph.total_degree(t.tx_edges))


# The query's sample size: below the node count already at sf0.01, so that the
# cut is tested (the operator's default is 50,000).
SAMPLE_NODES = 5000


@register("degree_sample", with_fixtures(f"""
with {TOTAL_DEGREE_SQL}
select * from total_degree order by md5(cast(txId as varchar)), txId limit {SAMPLE_NODES}""", "tx_edges"))
def degree_sample(t):
    return graph.degree_sample(graph.total_degree(t.tx_edges), SAMPLE_NODES)


@register("degree_histogram", with_fixtures(
    f"with {TOTAL_DEGREE_SQL}, {histogram_sql('total_degree', 'degree', 60)}", "tx_edges"))
def degree_histogram(t):
    return graph.degree_histogram(graph.total_degree(t.tx_edges), 60)


@register("degree_distribution", with_fixtures("""
select 'out' as direction, degree, count(*) as nodes
from (select count(*) as degree from tx_edges group by txId1) o group by degree
union all
select 'in' as direction, degree, count(*) as nodes
from (select count(*) as degree from tx_edges group by txId2) i group by degree""", "tx_edges"))
def degree_distribution(t):
    return graph.degree_distribution(t.tx_edges)


@register("top_hubs", with_fixtures(f"""
with {TOTAL_DEGREE_SQL}
select * from total_degree order by degree desc, txId limit 20""", "tx_edges"))
def top_hubs(t):
    return graph.top_hubs(graph.total_degree(t.tx_edges), 20)


_HUBS_SQL = f"""
{TOTAL_DEGREE_SQL},
hubs as (select * from total_degree order by degree desc, txId limit 20),
labelled as (
  select h.txId, h.degree, {LABEL_SQL.format(c='c.class')} as label
  from hubs h left join tx_classes c on h.txId = c.txId)"""


@register("labelled_hubs", with_fixtures(
    f"with {_HUBS_SQL} select * from labelled order by degree desc, txId",
    "tx_edges", "tx_classes"))
def labelled_hubs(t):
    hubs = graph.top_hubs(graph.total_degree(t.tx_edges), 20)
    return graph.label_hubs(hubs, t.tx_classes)


@register("hub_class_share", with_fixtures(f"""
with {_HUBS_SQL}
select label, count(*) as hubs, cast(sum(count(*)) over () as bigint) as total
from labelled group by label""", "tx_edges", "tx_classes"))
def hub_class_share(t):
    hubs = graph.top_hubs(graph.total_degree(t.tx_edges), 20)
    return graph.hub_class_share(graph.label_hubs(hubs, t.tx_classes))


@register("tx_edges_with_classes", with_fixtures("""
select e.txId1, e.txId2, c1.class as c1, c2.class as c2
from tx_edges e left join tx_classes c1 on e.txId1 = c1.txId
left join tx_classes c2 on e.txId2 = c2.txId""", "tx_edges", "tx_classes"))
def tx_edges_with_classes(t):
    return graph.edges_with_classes(t.tx_edges, t.tx_classes)


@register("tx_edges_with_classes_bitmap", with_fixtures("""
select e.txId1, e.txId2, c1.class as c1, c2.class as c2
from tx_edges e left join tx_classes c1 on e.txId1 = c1.txId
left join tx_classes c2 on e.txId2 = c2.txId""", "tx_edges", "tx_classes"))
def tx_edges_with_classes_bitmap(t):
    """The same rows by the class bitmap (by joins where the classes fit none)."""
    return graph.edges_with_classes(t.tx_edges, t.tx_classes, class_bitmap(t.tx_classes))


@register("neighbour_illicit_ratio", with_fixtures(f"with {PROFILE_SQL} select * from profile",
                                                   "tx_edges", "tx_classes"))
def neighbour_illicit_ratio(t):
    return graph.neighbour_profile(t.tx_edges, t.tx_classes)


@register("top_neighbour_ratio", with_fixtures(f"""
with {PROFILE_SQL}
select * from profile where c1 = 1 order by illicit_nb_ratio desc, txId1 limit 500""",
                                               "tx_edges", "tx_classes"))
def top_neighbour_ratio(t):
    return graph.top_neighbour_ratio(graph.neighbour_profile(t.tx_edges, t.tx_classes), 500)


@register("neighbour_ratio_histogram", with_fixtures(f"""
with {PROFILE_SQL}, illicit_profile as (select * from profile where c1 = 1),
{histogram_sql('illicit_profile', 'illicit_nb_ratio', 30)}""", "tx_edges", "tx_classes"))
def neighbour_ratio_histogram(t):
    return graph.neighbour_ratio_histogram(graph.neighbour_profile(t.tx_edges, t.tx_classes), 30)
