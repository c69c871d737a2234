"""Scores and report tables."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from scenecast.operators import evaluate as ev
from scenecast.operators import reports as rp


def test_scores_fixture(spark):
    df = spark.createDataFrame([("m", 1.0, 1.0), ("m", 2.0, 2.0), ("m", 3.0, 4.0)],
                               "model string, label double, prediction double")
    r = ev.score(df).first()
    assert r["rmse"] == pytest.approx(math.sqrt(1 / 3)) and r["r2"] == pytest.approx(0.5)
    assert ev.score(df.filter("false")).count() == 0
    const = spark.createDataFrame([("m", 1.0, 1.0), ("m", 1.0, 2.0)], df.schema)
    assert ev.score(const).first()["r2"] is None


def test_scores_equal_evaluator(spark):
    rows = [("m", float(i % 7), float(i % 5) * 1.3) for i in range(200)]
    df = spark.createDataFrame(rows, "model string, label double, prediction double")
    r = ev.score(df).first()
    for metric in ("rmse", "r2"):
        e = RegressionEvaluator(labelCol="label", predictionCol="prediction", metricName=metric)
        assert r[metric] == pytest.approx(e.evaluate(df), rel=1e-12)


def test_stack_and_compare(spark):
    df = spark.createDataFrame([(1, 1.0, 1.0, 2.0), (2, 2.0, 2.5, 2.0)],
                               "t int, label double, a double, b double")
    long = ev.stack_predictions(df, {"A": "a", "B": "b"}, ["t"])
    assert long.count() == 4
    cmp = {r["model"]: r["rank"] for r in ev.compare_models(ev.score(long)).collect()}
    assert cmp == {"A": 1, "B": 2}


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (4.0,)], "x double")
    h = {r["bin"]: r["count"] for r in rp.histogram(df, "x", 4).collect()}
    assert h == {1: 1, 2: 1, 3: 1, 4: 1}          # x = max lands in the last bin
    eq = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    h2 = rp.histogram(eq, "x", 5).orderBy("bin").collect()
    assert sum(r["count"] for r in h2) == 2 and len(h2) == 5
    assert h2[0]["bin_lo"] == 2.5 and h2[-1]["bin_hi"] == 3.5
    assert [r["count"] for r in h2] == [0, 0, 2, 0, 0]


def test_histogram_sums_to_n_grouped(spark):
    rows = [("a" if i % 3 else "b", float(i * i % 17)) for i in range(100)]
    df = spark.createDataFrame(rows, "model string, x double")
    h = rp.histogram(df, "x", 7, ["model"]).groupBy("model").agg(F.sum("count").alias("n"))
    assert {r["model"]: r["n"] for r in h.collect()} == {"a": 66, "b": 34}


def test_correlation_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.1, 5.0), (3.0, 5.9, 5.0)],
                               "a double, b double, c double")
    got = {(r["f1"], r["f2"]): r["corr"] for r in rp.correlation(df, ["a", "b", "c"]).collect()}
    assert got[("a", "c")] is None and got[("c", "c")] is None
    assert got[("a", "b")] == pytest.approx(got[("b", "a")]) and got[("a", "a")] == pytest.approx(1.0)
    assert len(got) == 9


def test_top_n_more_than_rows(spark):
    t0 = dt.datetime(2021, 6, 1)
    df = spark.createDataFrame([("m", t0 + dt.timedelta(hours=i), 1.0, float(i)) for i in range(3)],
                               "model string, timestamp timestamp_ntz, label double, prediction double")
    assert rp.top_errors(df, 20).count() == 3
    per = rp.top_errors(df, 2, ["model"]).collect()
    # abs errors are 1, 0, 1: the tie goes to the earlier time
    assert [r["time_label"] for r in sorted(per, key=lambda r: r["rank"])] == \
        ["06-01 00:00", "06-01 02:00"]
    assert rp.top_errors(df, 1).first()["time_label"] == "06-01 00:00"


def test_overlay_and_range(spark):
    t0 = dt.datetime(2021, 6, 1)
    df = spark.createDataFrame([("a", t0, 1.0, 2.0), ("b", t0, 1.0, 0.5)],
                               "model string, timestamp timestamp_ntz, label double, prediction double")
    o = rp.overlay(df, ["a", "b"]).first()
    assert (o["label"], o["a"], o["b"]) == (1.0, 2.0, 0.5)
    r = rp.value_range(df).first()
    assert (r["range_min"], r["range_max"]) == (0.5, 2.0)


def test_histogram_matches_numpy(spark):
    import numpy as np
    rnd = np.random.default_rng(9)
    for n, bins in [(500, 40), (1000, 60), (37, 7)]:
        x = rnd.normal(3.0, 2.0, n).round(4)
        df = spark.createDataFrame([(float(v),) for v in x], "x double")
        got = [r["count"] for r in rp.histogram(df, "x", bins).orderBy("bin").collect()]
        want, edges = np.histogram(x, bins=bins)
        assert got == [int(c) for c in want]
        lo = rp.histogram(df, "x", bins).orderBy("bin").first()["bin_lo"]
        assert lo == pytest.approx(edges[0])


def test_correlation_matches_pandas_pairwise(spark):
    import numpy as np
    import pandas as pd
    rnd = np.random.default_rng(4)
    n = 300
    a = rnd.normal(size=n)
    b = a * 0.5 + rnd.normal(size=n)
    c = rnd.normal(size=n)
    a[rnd.choice(n, 30, replace=False)] = np.nan          # missing values
    c[rnd.choice(n, 50, replace=False)] = np.nan
    pdf = pd.DataFrame({"a": a, "b": b, "c": c, "k": 2.0})
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) for r in pdf.to_numpy()]
    df = spark.createDataFrame(rows, "a double, b double, c double, k double")
    got = {(r["f1"], r["f2"]): r["corr"] for r in rp.correlation(df, ["a", "b", "c", "k"]).collect()}
    want = pdf.corr()
    for (f1, f2), v in got.items():
        w = want.loc[f1, f2]
        if np.isnan(w):
            assert v is None, (f1, f2)
        else:
            assert v == pytest.approx(w, abs=1e-12), (f1, f2)


def test_correlation_of_hard_columns(spark):
    # far from zero with a small spread, constant only where its partner is present, no rows at all
    rows = [(1e9 + i, float(i * i), 5.0 if i % 2 else float(i), None if i % 2 == 0 else float(i), None)
            for i in range(50)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double")
    names = list("abcde")
    got = {(r["f1"], r["f2"]): r["corr"] for r in rp.correlation(df, names).collect()}
    assert len(got) == 25
    import numpy as np
    want = np.corrcoef(np.arange(50.0), np.arange(50.0) ** 2)[0, 1]
    assert got["a", "b"] == pytest.approx(want, abs=1e-9) == got["b", "a"]
    assert got["c", "d"] is None and got["d", "d"] == pytest.approx(1.0)
    assert all(got["e", n] is None for n in names)
    empty = {r["corr"] for r in rp.correlation(df.filter("a < 0"), names).collect()}
    assert empty == {None}


def test_correlation_leaves_out_nan(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.5), (nan, 1.0), (4.0, nan),
                                (None, 9.0)], "a double, b double")
    got = {(r["f1"], r["f2"]): r["corr"] for r in rp.correlation(df, ["a", "b"]).collect()}
    assert got["a", "b"] == pytest.approx(0.9979487, abs=1e-6) and got["a", "a"] == pytest.approx(1)


def test_correlation_when_the_first_rows_are_not_typical(spark):
    rng = np.random.default_rng(6)
    n, start = 4_000, 1_700_000_000_000.0
    ms = start + np.sort(rng.integers(0, 60_000, n)).astype(float)
    y = (ms - start) / 1e4 + rng.normal(size=n)
    rows = [(None, 0.0, None, 5.0)] * 1_500        # no value of the large column in front
    rows += [(float(a), float(b), None, 5.0) for a, b in zip(ms, y)]
    # w lies far from its mean wherever u is there
    rows += [(None, None, -1e12, None)] * 50 + [(None, float(i), 1e12 + i, None) for i in range(50)]
    df = spark.createDataFrame(rows, "ms double, y double, w double, k double").coalesce(1)
    got = {(r["f1"], r["f2"]): r["corr"]
           for r in rp.correlation(df, ["ms", "y", "w", "k"]).collect()}
    assert got["ms", "y"] == pytest.approx(np.corrcoef(ms - start, y)[0, 1], abs=1e-9)
    assert got["ms", "ms"] == pytest.approx(1.0) and got["y", "w"] == pytest.approx(1.0, abs=1e-9)
    assert got["ms", "w"] is None and got["k", "y"] is None and got["k", "k"] is None
