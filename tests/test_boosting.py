"""Second-order boosting: against plain numpy, sampling, persistence, odd frames."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from scenecast.operators import models as mdl
from scenecast.operators.boosting import SecondOrderBoosting
from scenecast.session import shared_dir

FEATS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(11)
    x = rng.uniform(0, 10, (600, 3))
    y = 3 * x[:, 0] + 5 * (x[:, 1] > 4) * (x[:, 2] < 6) + rng.normal(0, 0.1, 600)
    return spark.createDataFrame([(int(i), *map(float, r), float(v)) for i, (r, v) in enumerate(
        zip(x, y))], "k long, a double, b double, c double, label double").cache()


def plain_boost(x, y, edges, rounds, depth, eta, l2):
    """Exhaustive second-order boosting of the squared loss."""
    margin = np.full(len(y), y.mean())
    for _ in range(rounds):
        node = np.zeros(len(y), dtype=int)
        for _ in range(depth):
            nxt = node.copy()
            for k in np.unique(node):
                own = node == k
                g = (margin - y)[own]
                best = (1e-9, None)
                for j, es in enumerate(edges):
                    for e in es:
                        left = x[own, j] < e
                        if 0 < left.sum() < len(left):
                            gain = (g[left].sum() ** 2 / (left.sum() + l2) + g[~left].sum() ** 2
                                    / ((~left).sum() + l2) - g.sum() ** 2 / (len(g) + l2))
                            if gain > best[0]:
                                best = gain, (j, e)
                right = x[own, best[1][0]] >= best[1][1] if best[1] else np.zeros(own.sum(), bool)
                nxt[own] = 2 * k + 1 + right
            node = nxt
        for k in np.unique(node):
            own = node == k
            margin[own] -= eta * (margin - y)[own].sum() / (own.sum() + l2)
    return margin


def test_equals_plain_numpy(frame):
    rows = frame.orderBy("k").toPandas()
    x, y = rows[FEATS].to_numpy(), rows["label"].to_numpy()
    edges = [[2.0, 4.0, 6.0, 8.0], [1.0, 4.0, 7.0], [3.0, 6.0]]
    model = mdl.boosted_l2_pipeline(FEATS, rounds=4, depth=3, eta=0.4, l2=2.5, subsample=1.0,
                                    colsample=1.0, edges=edges, checkpointEvery=2).fit(frame)
    got = model.transform(frame).orderBy("k").toPandas()["prediction"].to_numpy()
    assert np.allclose(got, plain_boost(x, y, edges, 4, 3, 0.4, 2.5), atol=1e-9)
    assert model.stages[-1].numTrees == 4
    shares = model.stages[-1].featureImportances.toArray()
    assert shares.sum() == pytest.approx(1) and shares[0] == max(shares)


def test_quantile_cuts_sampling_and_saving(spark, frame):
    def fit(seed):
        return mdl.boosted_l2_pipeline(FEATS, rounds=12, depth=3, eta=0.3, bins=32, seed=seed
                                       ).fit(frame)
    model = fit(1)
    pred = model.transform(frame).select("k", "label", "prediction").orderBy("k").toPandas()
    r2 = 1 - ((pred.label - pred.prediction) ** 2).sum() / ((pred.label - pred.label.mean()) ** 2).sum()
    assert r2 > 0.95
    path = shared_dir(spark, "boosted")
    model.write().overwrite().save(path)
    again = PipelineModel.load(path).transform(frame).orderBy("k").toPandas()["prediction"]
    assert np.array_equal(again, pred["prediction"])
    last = model.stages[-1]
    trees = np.array(last.getOrDefault(last.splits)).reshape(12, -1)
    assert all(len(set(t)) <= 3 for t in trees)
    other = fit(2).transform(frame).orderBy("k").toPandas()["prediction"]
    assert not np.allclose(other, pred["prediction"])


def test_features_of_a_tree_are_drawn_per_tree(frame):
    model = mdl.boosted_l2_pipeline(FEATS, rounds=6, depth=2, colsample=0.34, subsample=1.0,
                                    bins=8).fit(frame)
    last = model.stages[-1]
    used = [set(np.array(t)[np.isfinite(c)]) for t, c in zip(
        np.array(last.getOrDefault(last.splits)).reshape(6, -1),
        np.array(last.getOrDefault(last.cuts)).reshape(6, -1))]
    assert all(len(u) == 1 for u in used) and len(set().union(*used)) > 1


def test_odd_frames(spark, frame):
    one = mdl.boosted_l2_pipeline(FEATS, rounds=2, depth=2).fit(frame.limit(1))
    assert one.transform(frame.limit(1)).first()["prediction"] == pytest.approx(
        frame.limit(1).first()["label"])
    same = frame.withColumns({"a": F.lit(1.0), "b": F.lit(2.0), "c": F.lit(3.0)})
    flat = mdl.boosted_l2_pipeline(FEATS, rounds=2, depth=2, subsample=1.0).fit(same)
    mean = same.agg(F.avg("label")).first()[0]
    assert {round(r["prediction"], 9) for r in flat.transform(same).collect()} == {round(mean, 9)}
    assert not flat.stages[-1].featureImportances.toArray().any()
    none = mdl.boosted_l2_pipeline(FEATS, rounds=2, depth=2).fit(frame.limit(0))
    assert none.stages[-1].numTrees == 0
    assert none.transform(frame).agg(F.max("prediction")).first()[0] == 0.0
    nulls = frame.withColumn("label", F.when(F.col("k") % 2 == 0, F.col("label")))
    half = mdl.boosted_l2_pipeline(FEATS, rounds=1, depth=1, subsample=1.0, bins=8).fit(nulls)
    last = half.stages[-1]
    assert last.getOrDefault(last.base) == pytest.approx(
        frame.filter("k % 2 = 0").agg(F.avg("label")).first()[0])


def test_level_aggregate_combines_before_the_shuffle(frame):
    binned, cuts, mean = SecondOrderBoosting(bins=8)._binned(mdl.assembler(FEATS).transform(frame))
    assert binned.columns == ["id", "y", "margin", "bins"] and len(cuts) == 3
    assert all(len(c) <= 7 for c in cuts)


def test_fixed_cuts_write_the_bins_alone(frame, monkeypatch):
    from scenecast.operators import boosting
    calls, plain = [], boosting.materialize
    monkeypatch.setattr(boosting, "materialize", lambda df: calls.append(df) or plain(df))
    mdl.boosted_l2_pipeline(FEATS, rounds=2, depth=2, edges=[[5.0]] * 3, checkpointEvery=2
                            ).fit(frame)
    # the margins after the last tree are not written: nothing reads them
    assert [df.columns for df in calls] == [["id", "y", "margin", "bins"]]


def _trees(model):
    last = model.stages[-1]
    return [np.array(last.getOrDefault(p)) for p in (last.splits, last.cuts, last.leaves, last.gains)]


def test_cells_are_boosted_like_their_rows(frame, monkeypatch):
    from scenecast.operators import boosting
    make = mdl.boosted_l2_pipeline(FEATS, rounds=3, depth=3, eta=0.4, subsample=1.0, colsample=0.7,
                                   edges=[[2.0, 4.0, 6.0, 8.0], [1.0, 4.0, 7.0], [3.0, 6.0]])
    calls, plain = [], boosting.materialize
    monkeypatch.setattr(boosting, "materialize", lambda df: calls.append(df) or plain(df))
    cells = _trees(make.fit(frame))
    assert not calls
    monkeypatch.setattr(boosting, "CELLS", 9)          # there are more of them
    rows = _trees(make.fit(frame))
    assert len(calls) == 1
    for a, b in zip(cells, rows):
        assert np.allclose(a[np.isfinite(a)], b[np.isfinite(b)], atol=1e-9) and a.shape == b.shape


def test_scores_looked_up_equal_the_walked(spark, frame, monkeypatch):
    from scenecast.operators import boosting
    fitted = mdl.boosted_l2_pipeline(FEATS, rounds=5, depth=4, edges=[[2.0, 5.0], [4.0], [3.0, 6.0]]
                                     ).fit(frame).stages[-1]
    odd = [float("nan"), float("inf"), float("-inf"), 0.0, 2.0, 4.0, 5.0, 6.0, 7.5]
    rows = [(a, b, c) for a in odd for b in odd for c in odd]
    keep = mdl.assembler(FEATS).setHandleInvalid("keep")
    x = keep.transform(spark.createDataFrame(rows, "a double, b double, c double").coalesce(1))

    def scores():
        return [r["prediction"] for r in fitted.transform(x).collect()]
    looked = scores()
    monkeypatch.setattr(boosting, "TABLE_CELLS", 1)
    walked = scores()
    assert looked == walked and len(set(walked)) > 4


def test_equal_splits_go_to_the_first_feature(frame):
    # the same rows on either side, summed in another order
    twins = frame.withColumns({"b": 10 - F.col("a"), "c": F.col("a") * 3})
    edges = [[2.0, 4.0, 7.0], [3.0, 6.0, 8.0], [6.0, 12.0, 21.0]]
    model = mdl.boosted_l2_pipeline(FEATS, rounds=30, depth=3, subsample=1.0, colsample=1.0, edges=edges
                                    ).fit(twins)
    splits, cuts, _, _ = _trees(model)
    assert not splits[np.isfinite(cuts)].any() and np.isfinite(cuts).any()


def test_query_fits_the_published_trees_and_equals_its_sql(spark, tmp_path, monkeypatch):
    import datetime as dt
    import random

    import duckdb
    from scenecast.plans import catalog
    from scenecast.schemas import FEATURE_COLS
    rnd = random.Random(3)
    rows = [(s, dt.datetime(y, 1, 1) + dt.timedelta(days=d), v) for s in (1, 2, None)
            for y in (1999, 2000, 2001) for d in rnd.sample(range(365), 70) for v in rnd.sample(
                [rnd.uniform(900, 105000), rnd.uniform(900, 105000), -1.0, None], 2)]
    spark.createDataFrame(rows * 2, "l_suppkey long, l_shipdate timestamp_ntz, l_extendedprice double"
                          ).write.parquet(str(tmp_path / "lineitem.parquet"))
    fits, plain = [], mdl.fit_models
    monkeypatch.setattr(mdl, "fit_models", lambda *a: fits.append(plain(*a)) or fits[-1])
    got = [tuple(r) for r in catalog.QUERIES["boosted_l2"](spark, str(tmp_path)).collect()]
    first, model = fits[0]["boosted_trees"].stages
    assert first.getInputCols() == FEATURE_COLS
    assert {k: model.numTrees if k == "rounds" else model.getOrDefault(k)
            for k in ("rounds", "depth", "eta")} == {"rounds": 600, "depth": 6, "eta": 0.05}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{tmp_path}/lineitem.parquet/*.parquet')")
    assert con.sql(catalog.ORACLE["boosted_l2"]).fetchall() == got and got[0][1] > 100
