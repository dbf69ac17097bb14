"""Registered queries against their SQL, and the pipeline against brute force."""

from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import components, leaks, simhash

SF = "/root/testdata/sf0.001"
TABLES = ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.mark.parametrize("name", ["op1_benchmark_decontamination", "op2_substring_dedup", "op3_extendible_sharding", "op6_mix_sources", "op7_chat_formatting",
                                  "op9_line_dedup", "op10_topk_search", "op11_quality_rules", "op12_centroid_clustering"])
def test_query_equals_sql(spark, name):
    from ledgerlens.llm.queries import ORACLES, REGISTRY
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = REGISTRY[name](spark, SF).toPandas(), con.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    rows = lambda d: sorted(repr(tuple(round(x, 6) if isinstance(x, float) else x for x in r)) for r in d[sorted(d.columns)].astype(object).itertuples(index=False))
    assert rows(got) == rows(want) and len(got)


def test_every_operator_is_registered():
    import __spark_entry__
    names = __spark_entry__.queries()
    assert [n for k in range(1, 14) for n in names if n.startswith(f"op{k}_")].__len__() == 13 and "pipeline" in names


def test_spelling_variants_of_a_table(spark):
    """The registered query's rows by the definition, over a whole test table."""
    from ledgerlens.llm.queries import REGISTRY
    from tests.llm.test_rules_centroids_spelling import got_spelling, spelling_rows
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = got_spelling(REGISTRY["op13_spelling_variants"](spark, SF))
    assert got == spelling_rows(rows) and any(r[1] for r in got)


def test_native_operators_run_no_python(spark):
    """The main paths marked native hold no Python, pandas or Arrow node."""
    from ledgerlens.llm.queries import REGISTRY
    for name in ("op1_benchmark_decontamination", "op3_extendible_sharding", "op6_mix_sources", "op7_chat_formatting", "op9_line_dedup"):
        plan = REGISTRY[name](spark, SF)._jdf.queryExecution().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop")), name


def test_pipeline_stage_by_stage(spark):
    """Each stage on its own input, against brute force over its rows."""
    import corpus_pipeline as P
    from ledgerlens.llm.quality import scored
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    stages, cols = dict(P.STAGES), docs.columns
    assert list(stages) == ["quality", "near_dedup", "decontaminate", "mix", "shard"]
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    one = stages["quality"](spark, docs, SF).cache()
    assert ids(one) == ids(scored(docs, labels).where("predicted = 1")) and one.columns == cols
    two = stages["near_dedup"](spark, one, SF).cache()
    fps = {r.doc_id: simhash(r.text) for r in one.collect()}
    group = components(set(fps.values()), lambda a, b: bin(a ^ b).count("1") <= 3)
    assert ids(two) == sorted({min(i for i, f in fps.items() if f in g) for g in group.values()}) and two.columns == cols
    three = stages["decontaminate"](spark, two, SF).cache()
    bad = {d for d, *_ in leaks([(r.doc_id, r.text) for r in two.collect()], items)}
    assert ids(three) == [i for i in ids(two) if i not in bad] and three.columns == cols
    four = stages["mix"](spark, three, SF).cache()
    n = Counter(ids(four))
    assert set(n) <= set(ids(three)) and max(n.values()) <= 3 and four.columns == cols
    five = stages["shard"](spark, four, SF)
    assert ids(five) == ids(four) and {"shard", "shard_bytes"} <= set(five.columns)
    assert Counter(map(str, P.run(spark, SF).collect())) == Counter(map(str, five.collect()))


def test_pipeline_on_odd_rows(spark, tmp_path):
    """Nulls, empty and long texts, repeated rows and further columns pass all stages; so does an empty table."""
    import corpus_pipeline as P
    from tests.llm.helpers import docs_frame, edge_rows
    for rows in (edge_rows(), []):
        docs = docs_frame(spark, rows, clashing=True).withColumn("n", F.lit(1))
        for _, stage in P.STAGES:
            out = stage(spark, docs, SF)
            assert set(docs.columns) <= set(out.columns)
            docs = out
        texts = {t for _, t, _ in rows}
        assert {r.text for r in docs.collect()} <= texts  # their rows are held by test_pipeline_rows_on_odd_rows
