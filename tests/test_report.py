"""The dataset's CSV layout loads with explicit schemas and the full report
runs on it, giving the same tables as the operators on the original data."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import cases
from ledgerlens.plans.report import write_report
from ledgerlens.plans.tables import Tables
from ledgerlens.sources.reference_csv import FILES, CsvTables

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def csv_dir(spark):
    t = Tables(spark, SF_SMALL)
    d = tempfile.mkdtemp(prefix="ll-ref-csv-")
    frames = {"tx_classes": t.tx_classes, "tx_edges": t.tx_edges,
              "wallet_classes": t.wallet_classes, "addr_addr": t.addr_addr,
              "addr_tx": t.addr_tx, "tx_addr": t.tx_addr,
              "txs_features": t.txs_features.withColumnRenamed("time_step", "Time step")}
    for key, df in frames.items():
        df.coalesce(1).write.option("header", True).csv(os.path.join(d, FILES[key]))
    return d


def test_csv_layout_loads_typed(spark, csv_dir):
    ct = CsvTables(spark, csv_dir)
    assert dict(ct.txs_features.dtypes)["time_step"] == "int"
    assert dict(ct.txs_features.dtypes)["f_chars"] == "double"
    assert dict(ct.tx_classes.dtypes) == {"txId": "bigint", "class": "int"}
    t = Tables(spark, SF_SMALL)
    assert sorted(ct.tx_edges.collect()) == sorted(t.tx_edges.collect())


def test_report_runs_on_the_csv_layout(spark, csv_dir):
    ct = CsvTables(spark, csv_dir)
    out = tempfile.mkdtemp(prefix="ll-report-")
    names = write_report(ct, out, models_too=True, cross_validation=False)
    for n in ("case_summary", "edge_flow_by_class", "temporal_distribution", "model_comparison",
              "cluster_profiles", "roc_curve", "feature_summary", "k_selection"):
        assert n in names and os.path.isdir(os.path.join(out, n))
    back = spark.read.option("header", True).option("inferSchema", True).csv(
        os.path.join(out, "case_summary"))
    t = Tables(spark, SF_SMALL)
    direct = cases.case_summary(cases.fraud_cases(t.tx_edges, t.tx_classes))
    assert sorted((r.case_type, r["count"]) for r in back.collect()) == \
        sorted((r.case_type, r["count"]) for r in direct.collect())
    mc = spark.read.option("header", True).csv(os.path.join(out, "model_comparison"))
    assert mc.count() == 2 and mc.where(F.col("model") == "Random Forest").count() == 1


def test_report_without_feature_file_uses_synthetic_steps(spark, csv_dir):
    import shutil
    d = tempfile.mkdtemp(prefix="ll-ref-nofeat-")
    for key, fname in FILES.items():
        if key != "txs_features" and os.path.isdir(os.path.join(csv_dir, fname)):
            shutil.copytree(os.path.join(csv_dir, fname), os.path.join(d, fname))
    ct = CsvTables(spark, d)
    assert ct.txs_features is None and ct.tx_steps is None
    from ledgerlens.plans.report import report_tables
    out = report_tables(ct, models_too=False)
    assert "feature_summary" not in out and "model_comparison" not in out
    steps = out["temporal_distribution"].collect()
    assert len(steps) == 49 and steps[-1].cum_total == ct.tx_classes.count()


def test_report_releases_what_it_persists(spark, csv_dir):
    ct = CsvTables(spark, csv_dir)
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    write_report(ct, tempfile.mkdtemp(prefix="ll-report2-"), models_too=False)
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == before
