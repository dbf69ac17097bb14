"""Bracketed selection against numpy: quantiles, ranks, hot values, narrow brackets."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import profile, selection, temporal
from ledgerlens.operators.graph import degree_sample


@pytest.fixture(scope="module")
def frame(spark):
    """60,000 rows: a continuous, a hot (a third one value), a two-valued, an all-equal, an all-null and an odd column."""
    r = np.random.default_rng(11)
    n = 60_000
    hot = np.where(r.random(n) < 1 / 3, 5.0, r.normal(5, 3, n))
    rows = [(float(a), float(b), float(c), 7.0, None, None if k % 5 == 0 else float("nan") if k % 11 == 0 else float("inf") if k % 13 == 0 else float(k % 97))
            for k, (a, b, c) in enumerate(zip(r.normal(0, 1e6, n), hot, r.integers(0, 2, n), strict=True))]
    return spark.createDataFrame(rows, "smooth double, hot double, two double, same double, none double, odd double").repartition(9).cache()


def expected(frame, cols, probs):
    out = {}
    for c in cols:
        v = np.sort(np.array([r[0] for r in frame.select(c).where(F.col(c).isNotNull()).collect()]))
        for p in probs if len(v) else []:
            at = p * (len(v) - 1)
            lo, hi = v[int(np.floor(at))], v[int(np.ceil(at))]
            out[c, p] = lo if at == np.floor(at) else lo + (hi - lo) * (at - np.floor(at))
    return out


@pytest.mark.parametrize("options", [{}, {"most": 50, "cuts": 7}, {"accuracy": 10}, {"accuracy": 100_000}])
def test_quantiles_are_exact(frame, options):
    """Also with brackets that must be narrowed again and again, and with rough and with fine sketches."""
    probs = [0.0, 0.001, 0.25, 0.5, 0.77, 1.0]
    got = {(r.column, r.p): r.value for r in selection.quantiles(frame, frame.columns, probs, **options).collect()}
    want = expected(frame, frame.columns, probs)
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert got[k] == v or (np.isnan(v) and np.isnan(got[k])) or got[k] == pytest.approx(v, rel=1e-12), k


def test_wrong_brackets_are_widened(frame):
    """Counts prove a bracket; one that does not hold its ranks is replaced."""
    n = frame.count()
    wanted = [selection.Wanted("smooth", 100, 101, 1e9, 2e9), selection.Wanted("smooth", n - 1, n - 1, -5.0, 5.0)]
    v = np.sort([r[0] for r in frame.select("smooth").collect()])
    got = {r.j: (r.v_first, r.v_last) for r in selection.order_statistics(frame.select("smooth"), wanted, {"smooth": n}, sketched=True).collect()}
    assert got == {0: (v[100], v[101]), 1: (v[n - 1], v[n - 1])}


def test_ranks_of_large_ids_keep_all_digits(spark):
    """Neighbouring ids beyond 2^53 are the same double; the counts are taken on the longs."""
    base = (1 << 62) + 1
    df = spark.range(20_000).select((F.lit(base) + F.col("id")).alias("k")).repartition(5)
    wanted = [selection.Wanted("k", r, r) for r in (0, 1, 777, 19_999)]
    for options in ({}, {"most": 30, "cuts": 5}):
        got = {r.j: r.v_first for r in selection.order_statistics(df, wanted, {"k": 20_000}, **options).collect()}
        assert got == {0: base, 1: base + 1, 2: base + 777, 3: base + 19_999}


def test_184_columns_in_two_wide_passes(spark):
    """No value is exploded or range-sorted, whatever the width; both profile tables share one selection."""
    r = np.random.default_rng(3)
    data = r.normal(size=(400, 184)).round(3)
    df = spark.createDataFrame([tuple(map(float, x)) for x in data], ", ".join(f"f{i} double" for i in range(184)))
    q = profile.quartiles(df, df.columns)
    rows = {x.column: x for x in profile.feature_summary(df, df.columns, q=q).collect()}
    assert len(rows) == 184
    for i in (0, 17, 183):
        assert [rows[f"f{i}"][k] for k in ("p25", "p50", "p75")] == pytest.approx(np.quantile(data[:, i], [0.25, 0.5, 0.75]), abs=1e-6)
    box = {x.column: x for x in profile.box_stats(df, df.columns, q=q).collect()}
    assert box["f17"].median == rows["f17"].p50 and box["f17"].q3 == rows["f17"].p75
    plan = profile.feature_summary(df, df.columns, q=q)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan


def test_selection_of_empty_tables(spark):
    df = spark.createDataFrame([], "a double, b long")
    assert selection.quantiles(df, ["a", "b"], [0.5]).count() == 0
    assert profile.feature_summary(df, ["a", "b"]).count() == 0 and profile.box_stats(df, ["a"]).count() == 0
    assert temporal.synthetic_steps(df.select(F.col("b").alias("txId"))).count() == 0


def test_steps_equal_numbered_runs(spark):
    """The cuts give the steps that numbering all rows gives, without ordering them."""
    ids = np.random.default_rng(2).permutation(np.arange(10_007)) * 3 - 5000
    df = spark.createDataFrame([(int(i),) for i in ids], "txId long").repartition(6)
    want = {int(x): min(49, k // (10_007 // 49) + 1) for k, x in enumerate(np.sort(ids))}
    for options in ({}, {"most": 20, "cuts": 4}):
        steps = temporal.synthetic_steps(df, 49, **options)
        assert {r.txId: r.time_step for r in steps.collect()} == want
        plan = steps._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" not in plan and "Window" not in plan
    with_nulls = df.union(spark.createDataFrame([(None,)] * 500, "txId long"))
    got = {r.txId: r.time_step for r in temporal.synthetic_steps(with_nulls, 49).collect()}
    assert got[None] == 1 and all(got[int(x)] == min(49, (k + 500) // (10_507 // 49) + 1) for k, x in enumerate(np.sort(ids)))


@pytest.mark.parametrize("options", [{}, {"digits": 1, "most": 3}, {"digits": 2, "most": 10 ** 9}])
def test_bottom_n_by_hash_histogram(spark, options):
    import hashlib
    df = spark.range(5000).select(F.col("id").alias("txId"), (F.col("id") % 7).alias("degree"))
    order = sorted(range(5000), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
    for n in (1, 50, 1234, 5000, 9000):
        got = degree_sample(df, n, **options)
        assert sorted(r.txId for r in got.collect()) == sorted(order[:n]) and got.columns == df.columns
        assert "rangepartitioning" not in got._jdf.queryExecution().executedPlan().toString()
