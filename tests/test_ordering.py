"""Range-sliced global order helpers equal single-task windows, also with a hot key."""

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlens.operators.ordering import next_in_group, with_row_number, with_running_sums


def _skewed(spark, n=3000):
    # key 7 holds a third of the rows
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50).alias("g"),
        ((F.col("id") * 7919) % 1000).alias("t"), F.col("id"),
        (F.col("id") % 5).alias("v"))


def test_row_number_matches_window(spark):
    df = _skewed(spark)
    got = with_row_number(df, ["g", "t", "id"], "rn", num_parts=6).select("id", "rn")
    ref = df.select("id", F.row_number().over(Window.orderBy("g", "t", "id")).alias("rn"))
    assert sorted(got.collect()) == sorted(ref.collect())


def test_row_number_descending(spark):
    df = spark.range(100).select(F.col("id"))
    got = {r.id: r.rn for r in with_row_number(df, [F.col("id").desc()], "rn", 4).collect()}
    assert got[99] == 1 and got[0] == 100


def test_running_sums_match_window(spark):
    df = _skewed(spark)
    got = with_running_sums(df, ["g", "id"], ["v"], num_parts=5).select("id", "cum_v")
    w = Window.orderBy("g", "id").rowsBetween(Window.unboundedPreceding, 0)
    ref = df.select("id", F.sum("v").over(w).alias("cum_v"))
    assert sorted(got.collect()) == sorted(ref.collect())


def test_next_in_group_matches_lead(spark):
    df = _skewed(spark)
    got = next_in_group(df, "g", ["t", "id"], "id", F.floor(F.col("t") / 3), "nxt").select("id", "nxt")
    pdf = df.toPandas().sort_values(["g", "t", "id"])
    pdf["nxt"] = pdf.groupby("g")["id"].shift(-1)
    ref = pdf.dropna(subset=["nxt"])
    expect = sorted((int(a), int(b)) for a, b in zip(ref["id"], ref["nxt"]))
    assert sorted((r.id, r.nxt) for r in got.collect()) == expect


def test_empty_input(spark):
    df = spark.range(0).select(F.col("id"))
    assert with_row_number(df, ["id"], "rn", 3).count() == 0
    assert isinstance(pd.DataFrame(), pd.DataFrame)


def test_exact_quantiles_with_a_hot_value(spark):
    import numpy as np
    from ledgerlens.operators.profile import exact_quantiles, long_values
    n = 3001
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0.0)).otherwise((F.col("id") * 37 % 101).cast("double"))
        .alias("a"),
        (F.col("id") % 17).cast("double").alias("b"))
    got = {(r.column, r.p): r.value for r in
           exact_quantiles(long_values(df, ["a", "b"]), [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]).collect()}
    pdf = df.toPandas()
    for c in ("a", "b"):
        for p in (0.0, 0.1, 0.25, 0.5, 0.9, 1.0):
            assert abs(got[(c, p)] - float(np.quantile(pdf[c], p))) < 1e-9, (c, p)


def test_next_in_group_over_pieces(spark):
    # one row per piece, several pieces per group, and pieces of several groups
    df = spark.createDataFrame([(g, t, g * 100 + t) for g in (1, 2) for t in range(5)],
                               "g long, t long, v long")
    got = sorted((r.v, r.nxt) for r in next_in_group(df, "g", ["t"], "v", F.col("t"), "nxt").collect())
    assert got == [(100, 101), (101, 102), (102, 103), (103, 104),
                   (200, 201), (201, 202), (202, 203), (203, 204)]


def test_row_numbers_and_running_sums_with_empty_slices(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(20)], "id long, v long")
    rn = sorted((r.id, r.rn) for r in with_row_number(df, ["id"], "rn", 64).collect())
    assert rn == [(i, i + 1) for i in range(20)]
    cs = sorted((r.id, r.cum_v) for r in with_running_sums(df, ["id"], ["v"], num_parts=64).collect())
    running, expect = 0, []
    for i in range(20):
        running += i % 3
        expect.append((i, running))
    assert cs == expect


def test_next_in_group_keeps_each_column_once(spark, tmp_path):
    df = spark.createDataFrame([(1, t) for t in range(6)], "g long, t long")
    out = next_in_group(df, "g", ["t"], "t", F.floor(F.col("t") / 4), "nxt")
    assert out.columns == ["g", "t", "nxt"]
    out.write.parquet(str(tmp_path / "out"))
    assert sorted((r.t, r.nxt) for r in out.collect()) == [(t, t + 1) for t in range(5)]


# -- at a size where range bounds are sampled: 2M rows over 8 partitions --
N = 2_000_000


@pytest.fixture(scope="module", params=["plain", "cached"])
def large(spark, request, tmp_path_factory):
    """id is a permutation; wide extra columns make plans of different columns."""
    path = str(tmp_path_factory.mktemp("large") / "t")
    spark.range(N, numPartitions=8).select(
        ((F.col("id") * 1_000_003) % N).alias("id"), (F.col("id") % 7).alias("v"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000).alias("g"),
        F.md5(F.col("id").cast("string")).alias("extra")).write.parquet(path)
    df = spark.read.parquet(path)
    if request.param == "cached":
        df = df.persist()
    yield df
    df.unpersist()


def test_row_numbers_are_exact_at_size(large):
    got = with_row_number(large, ["id"], "rn", 8)
    row = got.agg(F.count("*").alias("n"), F.count_if(F.col("rn") == F.col("id") + 1).alias("right")).first()
    assert (row.n, row.right) == (N, N)


def test_running_sums_are_exact_at_size(large):
    got = with_running_sums(large, ["g", "id"], ["v"], num_parts=8)
    last = got.agg(F.max("cum_v"), F.sum("v"), F.count("*")).first()
    assert last[0] == last[1] and last[2] == N
    # per prefix of whole groups the running sum must equal the plain sum
    want = dict(large.groupBy("g").agg(F.sum("v")).collect())
    ends = sorted(got.groupBy("g").agg(F.max("cum_v")).collect())
    total = 0
    for g, end in ends:
        total += want[g]
        assert end == total


def test_degree_sample_is_exact_at_size(large):
    from ledgerlens.operators.graph import degree_sample
    deg = large.select(F.col("id").alias("txId"), F.col("v").alias("degree"), "extra")
    got = degree_sample(deg, 5000).select("txId")
    want = deg.select("txId").orderBy(F.md5(F.col("txId").cast("string")), "txId").limit(5000)
    assert got.count() == 5000 and got.exceptAll(want).count() == 0


def test_curve_areas_equal_the_evaluator_at_size(large):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from ledgerlens.operators import metrics
    scored = large.select("*", (F.pmod(F.xxhash64("id"), F.lit(900_001)) / 900_001.0).alias("score")).withColumn(
        "label", (F.rand(3) < F.col("score")).cast("int")).select("score", "label", "extra")
    scored = scored.persist()
    areas = metrics.curve_areas(scored).first()
    for metric, mine in (("areaUnderROC", areas.auc_roc), ("areaUnderPR", areas.auc_pr)):
        ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", metricName=metric, numBins=0)
        assert abs(ev.evaluate(scored) - mine) < 2e-6
    top = metrics.roc_curve(scored).agg(F.max("tp"), F.max("fp")).first()
    assert tuple(top) == (scored.where("label = 1").count(), scored.where("label = 0").count())
    scored.unpersist()
