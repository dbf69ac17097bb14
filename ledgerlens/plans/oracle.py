"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each oracle is independent SQL over the pre-registered test tables; the
derived reference-shaped tables are inlined as CTEs (``with_fixtures``).
Column names equal the Spark query's columns; counts and integer sums are cast
to BIGINT, doubles are rounded like the Spark side.
"""

from __future__ import annotations

# DuckDB definitions of the derived tables (twins of sources/fixtures.py).
FIXTURE_CTES = {
    "tx_classes": """
        select o_orderkey as txId,
               cast(case o_orderstatus when 'F' then 1 when 'O' then 2 else 3 end as integer) as class
        from orders""",
    "tx_edges": """
        select distinct a as txId1, b as txId2 from (
          select l_orderkey a,
                 lead(l_orderkey) over (partition by l_partkey
                                        order by l_shipdate, l_orderkey, l_linenumber) b
          from lineitem) z
        where b is not null and a <> b""",
    "tx_steps": """
        select o_orderkey as txId,
               cast(1 + floor(datediff('day', timestamp '1995-01-01', o_orderdate) * 49 / 2405)
                    as integer) as time_step
        from orders""",
    "wallet_classes": """
        select 'W' || cast(c_custkey as varchar) as address,
               cast(case when c_mktsegment = 'BUILDING' then 1
                         when c_mktsegment in ('AUTOMOBILE','FURNITURE') then 2 else 3 end
                    as integer) as class
        from customer""",
    "addr_tx": """
        select 'W' || cast(o_custkey as varchar) as input_address, o_orderkey as txId from orders""",
    "tx_addr": """
        select l_orderkey as txId,
               (case when l_suppkey % 4 = 0 then 'S' else 'W' end) || cast(l_suppkey as varchar)
                 as output_address
        from lineitem""",
    "addr_addr": """
        select input_address, output_address from addr_tx join tx_addr using (txId)""",
    "doc_features": r"""
        select d.doc_id as txId,
               cast(1 + d.doc_id % 49 as integer) as time_step,
               cast(case when l.quality = 0 then 1 when l.quality = 1 then 2 else 3 end as integer)
                 as class,
               cast(d.n_chars as double) as f_chars,
               cast(len(string_split(d.text, ' ')) as double) as f_words,
               round(length(regexp_replace(d.text, '[^0-9]', '', 'g')) / d.n_chars, 6)
                 as f_digit_ratio,
               round(length(regexp_replace(d.text, '[^!-/:-@\[-`{-~]', '', 'g')) / d.n_chars, 6)
                 as f_punct_ratio,
               round(len(list_distinct(string_split(d.text, ' ')))
                     / len(string_split(d.text, ' ')), 6) as f_distinct_ratio
        from documents d left join (select doc_id, quality from labels) l using (doc_id)""",
}

# DuckDB twin of functions.rules.class_label
LABEL_SQL = "case {c} when 1 then 'illicit' when 2 then 'licit' else 'unknown' end"

_DEPENDS = {"addr_addr": ["addr_tx", "tx_addr"]}


def with_fixtures(body: str, *names: str) -> str:
    """Prefix ``body`` with the CTEs of the named derived tables (and their inputs)."""
    ordered: list[str] = []

    def add(n):
        for d in _DEPENDS.get(n, []):
            add(d)
        if n not in ordered:
            ordered.append(n)

    for n in names:
        add(n)
    ctes = ",\n".join(f"{n} as ({FIXTURE_CTES[n]})" for n in ordered)
    body = body.strip()
    if body.lower().startswith("with "):
        return f"with {ctes},\n{body[5:]}"
    return f"with {ctes}\n{body}"
