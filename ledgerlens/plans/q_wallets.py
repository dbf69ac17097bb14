"""Queries: wallet network flow, senders, transfers, behaviour, cluster profiles."""

from __future__ import annotations

from ledgerlens.operators import wallets
from ledgerlens.plans.oracle import LABEL_SQL, with_fixtures
from ledgerlens.plans.queries import register


_FLOW_SQL = f"""
flow as (
  select {LABEL_SQL.format(c='wi.class')} as from_class,
         {LABEL_SQL.format(c='wo.class')} as to_class,
         count(*) as edge_count
  from addr_addr e
  left join wallet_classes wi on e.input_address = wi.address
  left join wallet_classes wo on e.output_address = wo.address
  group by 1, 2)"""

_FEATURES_SQL = """
o as (select input_address as address, count(output_address) as out_degree,
             count(distinct output_address) as unique_out from addr_addr group by 1),
i as (select output_address as address, count(input_address) as in_degree,
             count(distinct input_address) as unique_in from addr_addr group by 1),
s as (select input_address as address, count(distinct txId) as txs_sent from addr_tx group by 1),
r as (select output_address as address, count(distinct txId) as txs_received
      from tx_addr group by 1),
wf as (
  select address,
         coalesce(out_degree, 0) as out_degree, coalesce(in_degree, 0) as in_degree,
         coalesce(unique_out, 0) as unique_out, coalesce(unique_in, 0) as unique_in,
         coalesce(txs_sent, 0) as txs_sent, coalesce(txs_received, 0) as txs_received,
         coalesce(w.class, 0) as class
  from o full outer join i using (address) full outer join s using (address)
       full outer join r using (address) left join wallet_classes w using (address))"""

_RULE_SQL = """
clustered as (
  select *, cast(case when out_degree > 50 then 0 when in_degree > 0 then 1 else 2 end as integer)
              as prediction
  from wf),
profile as (
  select prediction, count(*) as wallet_count,
         round(avg(out_degree), 2) as avg_out_deg, round(avg(in_degree), 2) as avg_in_deg,
         round(avg(txs_sent), 2) as avg_txs_sent, round(avg(txs_received), 2) as avg_txs_rcvd,
         count(*) filter (where class = 1) as illicit_count,
         count(*) filter (where class = 2) as licit_count
  from clustered group by prediction)"""

_WALLET_TABLES = ("addr_addr", "wallet_classes")
_ALL_WALLET_TABLES = ("addr_addr", "addr_tx", "tx_addr", "wallet_classes")


@register("edge_flow_by_class", with_fixtures(
    f"with {_FLOW_SQL} select * from flow order by edge_count desc", *_WALLET_TABLES))
def edge_flow_by_class(t):
    return wallets.edge_flow(t.addr_addr, t.wallet_classes)


@register("edge_flow_matrix", with_fixtures(f"""
with {_FLOW_SQL}
select from_class,
       cast(coalesce(sum(edge_count) filter (where to_class = 'illicit'), 0) as bigint) as illicit,
       cast(coalesce(sum(edge_count) filter (where to_class = 'licit'), 0) as bigint) as licit,
       cast(coalesce(sum(edge_count) filter (where to_class = 'unknown'), 0) as bigint) as unknown
from flow group by from_class order by from_class""", *_WALLET_TABLES))
def edge_flow_matrix(t):
    return wallets.edge_flow_matrix(wallets.edge_flow(t.addr_addr, t.wallet_classes))


@register("top_illicit_wallets", with_fixtures("""
select e.input_address, count(e.output_address) as out_degree,
       count(distinct e.output_address) as unique_targets
from addr_addr e join wallet_classes w on e.input_address = w.address and w.class = 1
group by e.input_address order by out_degree desc, e.input_address limit 15""", *_WALLET_TABLES))
def top_illicit_wallets(t):
    return wallets.top_illicit_senders(t.addr_addr, t.wallet_classes, 15)


@register("illicit_to_licit_transfers", with_fixtures("""
select e.input_address as illicit_wallet, e.output_address as licit_wallet, count(*) as transfers
from addr_addr e
join wallet_classes wi on e.input_address = wi.address and wi.class = 1
join wallet_classes wo on e.output_address = wo.address and wo.class = 2
group by 1, 2 order by transfers desc, illicit_wallet, licit_wallet limit 15""", *_WALLET_TABLES))
def illicit_to_licit_transfers(t):
    return wallets.illicit_to_licit(t.addr_addr, t.wallet_classes, 15)


@register("wallet_out_degree", with_fixtures("""
select input_address as address, count(output_address) as out_degree,
       count(distinct output_address) as unique_out from addr_addr group by 1""", "addr_addr"))
def wallet_out_degree(t):
    return wallets.wallet_out(t.addr_addr)


@register("wallet_in_degree", with_fixtures("""
select output_address as address, count(input_address) as in_degree,
       count(distinct input_address) as unique_in from addr_addr group by 1""", "addr_addr"))
def wallet_in_degree(t):
    return wallets.wallet_in(t.addr_addr)


@register("wallet_txs_sent", with_fixtures("""
select input_address as address, count(distinct txId) as txs_sent from addr_tx group by 1""",
                                           "addr_tx"))
def wallet_txs_sent(t):
    return wallets.txs_sent(t.addr_tx)


@register("wallet_txs_received", with_fixtures("""
select output_address as address, count(distinct txId) as txs_received from tx_addr group by 1""",
                                               "tx_addr"))
def wallet_txs_received(t):
    return wallets.txs_received(t.tx_addr)


@register("wallet_features", with_fixtures(f"with {_FEATURES_SQL} select * from wf",
                                           *_ALL_WALLET_TABLES))
def wallet_features(t):
    return wallets.wallet_features(t.addr_addr, t.addr_tx, t.tx_addr, t.wallet_classes)


@register("cluster_profile_rule", with_fixtures(
    f"with {_FEATURES_SQL}, {_RULE_SQL} select * from profile order by prediction",
    *_ALL_WALLET_TABLES))
def cluster_profile_rule(t):
    wf = wallets.wallet_features(t.addr_addr, t.addr_tx, t.tx_addr, t.wallet_classes)
    return wallets.cluster_profile(wallets.rule_clusters(wf))


@register("cluster_types", with_fixtures(f"""
with {_FEATURES_SQL}, {_RULE_SQL}
select *, case when avg_out_deg > 50 then 'High Activity Hub'
               when avg_in_deg > avg_out_deg then 'Receiver Wallet'
               when avg_out_deg > avg_in_deg then 'Sender Wallet'
               else 'Low Activity' end as cluster_type
from profile order by prediction""", *_ALL_WALLET_TABLES))
def cluster_types(t):
    wf = wallets.wallet_features(t.addr_addr, t.addr_tx, t.tx_addr, t.wallet_classes)
    return wallets.cluster_types(wallets.cluster_profile(wallets.rule_clusters(wf)))
