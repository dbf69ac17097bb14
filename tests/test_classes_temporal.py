"""Class rules, counts, imbalance guards and temporal windows on hand-made tables."""

from datetime import datetime, timedelta

import duckdb
from pyspark.sql import functions as F

from ledgerlens.operators import classes, temporal
from ledgerlens.plans.compare import compare
from ledgerlens.plans.queries import oracle_sql, queries


def test_label_rule_nulls_and_other_codes(spark):
    df = spark.createDataFrame([(1, 1), (2, 2), (3, 3), (4, None), (5, 9)], "txId long, class int")
    got = {r.txId: r.label for r in classes.labelled(df).collect()}
    assert got == {1: "illicit", 2: "licit", 3: "unknown", 4: "unknown", 5: "unknown"}
    counts = {r.label: r["count"] for r in classes.class_counts(df).collect()}
    assert counts == {"illicit": 1, "licit": 1, "unknown": 3}


def test_imbalance_without_labels_does_not_divide_by_zero(spark):
    df = spark.createDataFrame([(1, 3), (2, None)], "txId long, class int")
    r = classes.class_imbalance(df).first()
    assert r.illicit == 0 and r.licit == 0 and r.illicit_pct is None and r.licit_to_illicit == 0.0


def test_distribution_absent_class_gives_zero_row(spark):
    tx = spark.createDataFrame([(1, 2), (2, 2)], "txId long, class int")
    w = spark.createDataFrame([("a", 1)], "address string, class int")
    rows = {r["class"]: r for r in classes.class_distribution(tx, w).collect()}
    assert rows["illicit"].tx_count == 0 and rows["licit"].tx_pct == 100.0
    assert rows["unknown"].wallet_count == 0 and rows["illicit"].wallet_pct == 100.0


def _counts(spark, rows):
    return spark.createDataFrame(rows, "time_step int, illicit long, licit long, unknown long, "
                                       "total long")


def test_rolling_window_start_and_cumulative(spark):
    c = _counts(spark, [(1, 3, 1, 0, 4), (2, 6, 0, 0, 6), (3, 0, 2, 2, 4), (4, 3, 1, 0, 4)])
    out = {r.time_step: r for r in temporal.temporal_distribution(c).collect()}
    assert out[1].rolling_3step == 3.0 and out[2].rolling_3step == 4.5
    assert out[3].rolling_3step == 3.0 and out[4].rolling_3step == 3.0
    assert out[4].cum_illicit == 12 and out[4].cum_total == 18
    assert out[4].illicit_rate_pct == round(12 / 18 * 100, 3)


def test_single_step(spark):
    c = _counts(spark, [(1, 1, 1, 1, 3)])
    r = temporal.rolling_illicit_rate(c).first()
    assert r.rolling_rate_pct == round(100 / 3, 3)
    assert temporal.fraud_bursts(c).count() == 0


def test_bursts(spark):
    c = _counts(spark, [(1, 10, 0, 0, 10), (2, 10, 0, 0, 10), (3, 10, 0, 0, 10),
                        (4, 16, 0, 0, 16), (5, 14, 0, 0, 14)])
    got = [(r.time_step, r.burst_ratio) for r in temporal.fraud_bursts(c).collect()]
    assert got == [(4, 1.6)]
    quiet = _counts(spark, [(1, 0, 1, 0, 1), (2, 0, 1, 0, 1), (3, 2, 0, 0, 2)])
    assert [(r.time_step, r.burst_ratio) for r in temporal.fraud_bursts(quiet).collect()] == \
        [(3, None)]


def test_fraud_bursts_query_returns_every_burst_over_its_factor(spark, tmp_path):
    """Query and SQL on orders whose illicit counts vary: the rise of 1.2 is a burst as well
    as the one of 1.64; those of 1.03 and 1.02 are none."""
    illicit = [10, 10, 10, 12, 11, 18, 14]
    day = [datetime(1995, 1, 1) + timedelta(days=1 + k * 2405 // 49) for k in range(len(illicit))]
    rows = [(status, day[k]) for k, n in enumerate(illicit) for status in "F" * n + "OOP"]
    orders = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "o_orderkey long, o_orderstatus string, o_orderdate timestamp")
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    df = queries()["fraud_bursts"](spark, str(tmp_path))
    assert [tuple(r) for r in df.collect()] == [(4, 12, 10.0, 1.2), (6, 18, 11.0, 1.636)]
    con = duckdb.connect()
    con.execute(f"create view orders as select * from '{tmp_path}/orders.parquet/*.parquet'")
    res = compare(df, con, oracle_sql()["fraud_bursts"])
    assert res["ok"] and res["spark_rows"] == 2, res


def test_bursts_of_each_wallet(spark):
    """Each wallet has its own history; a null address is a group like any other."""
    c = spark.createDataFrame([("a", 1, 2), ("a", 2, 2), ("a", 5, 4), ("b", 1, 9), ("b", 2, 9), (None, 3, 0), (None, 4, 1), ("c", 7, 5)],
                              "address string, time_step int, illicit long")
    got = {(r.address, r.time_step): (r.prev_mean, r.burst_ratio) for r in temporal.fraud_bursts(c, by=("address",)).collect()}
    assert got == {("a", 5): (2.0, 2.0), (None, 4): (0.0, None)}


def test_wallet_step_counts(spark):
    sent = spark.createDataFrame([("a", 1), ("a", 2), ("a", 2), ("b", 3), ("b", 9), (None, 1)], "input_address string, txId long")
    tx = spark.createDataFrame([(1, 4, 1), (2, 4, None), (3, 5, 2)], "txId long, time_step int, class int")
    got = {(r.address, r.time_step): (r.illicit, r.total) for r in temporal.wallet_step_counts(sent, tx).collect()}
    assert got == {("a", 4): (1, 3), ("b", 5): (0, 1), (None, 4): (1, 1)}


def test_step_counts_null_class_only_in_total(spark):
    df = spark.createDataFrame([(1, 1, 1), (2, 1, None), (3, 1, 3), (4, 2, 2)],
                               "txId long, time_step int, class int")
    out = {r.time_step: r for r in temporal.step_class_counts(df).collect()}
    assert out[1].total == 3 and out[1].illicit + out[1].licit + out[1].unknown == 2


def test_synthetic_steps_even_runs(spark):
    df = spark.range(100).select(F.col("id").alias("txId"), F.lit(3).alias("class"))
    steps = {r.txId: r.time_step for r in temporal.synthetic_steps(df, steps=10).collect()}
    assert steps[0] == 1 and steps[9] == 1 and steps[10] == 2 and steps[99] == 10
    df2 = spark.range(5).select(F.col("id").alias("txId"), F.lit(3).alias("class"))
    assert sorted(r.time_step for r in temporal.synthetic_steps(df2, 49).collect()) == [1, 2, 3, 4, 5]
