"""Gains over blocks of bins against Spark's own fit."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import functions as F

from riskloom.operators import gains, train

FEATURES = ["a", "b", "c", "d", "e"]


def table(spark, n, parts):
    """Ties, zeros, negative numbers, a constant and a useless feature."""
    rng = np.random.default_rng(n)
    x = np.stack([rng.normal(size=n), rng.integers(-3, 4, n), rng.exponential(size=n), np.full(n, 2.0), rng.normal(size=n)], axis=1)
    y = (x[:, 0] + 0.3 * x[:, 1] + 0.5 * np.sin(3 * x[:, 2]) + 0.5 * rng.normal(size=n) > 0.4).astype(int)
    rows = [(*map(float, v), int(t)) for v, t in zip(x, y)]
    return spark.createDataFrame(rows, "a double, b double, c double, d double, e double, y int").repartition(parts).cache()


def spark_fit(rows, rounds, depth):
    return GBTClassifier(labelCol="y", maxIter=rounds, maxDepth=depth, stepSize=0.1, seed=42).fit(rows)


def splits(found):
    return [(s.tree, s.feature, s.threshold, s.rows) for s in found]


@pytest.mark.parametrize("n, parts", [(20, 1), (700, 3), (15_000, 4)])
def test_splits_are_those_of_spark(spark, n, parts):
    """The last size is above the rows that thresholds are looked for in, so they come from a sample."""
    rows = train.assembled(table(spark, n, parts), FEATURES, ["y"])
    model = spark_fit(rows, 12, 4)
    nodes = train.node_table(model).where("left >= 0").collect()
    want = sorted((r["tree"], r["feature_index"], r["threshold"], r["n_rows"], r["gain"]) for r in nodes)
    found = sorted((s.tree, s.feature, s.threshold, s.rows, s.gain) for s in gains.gbt_splits(rows, "y", 5, 12, 4, 0.1, 42))
    real = [w for w in want if w[4] > 1e-12]
    assert len(real) > 20 and [f[:4] for f in found if f[4] > 1e-12] == [w[:4] for w in real]
    assert [f[4] for f in found if f[4] > 1e-12] == pytest.approx([w[4] for w in real], rel=1e-6)
    got = gains.gbt_importance(rows, "y", 5, 12, 4, 0.1, 42)
    assert got == pytest.approx(list(model.featureImportances.toArray()), rel=1e-6, abs=1e-12)


def test_many_tasks_give_the_splits_of_one(spark, monkeypatch):
    rows = train.assembled(table(spark, 3000, 5), FEATURES, ["y"])
    one = gains.gbt_splits(rows, "y", 5, 12, 4, 0.1, 42)
    monkeypatch.setattr(gains, "TASK_CELLS", 0)
    monkeypatch.setattr(gains, "BLOCK_CELLS", 5 * 170)
    monkeypatch.setattr(gains, "WRITTEN_ROUNDS", 4)
    before = set(spark.sparkContext._jsc.getPersistentRDDs())
    many = gains.gbt_splits(rows, "y", 5, 12, 4, 0.1, 42)
    assert splits(many) == splits(one) and [s.gain for s in many] == [s.gain for s in one]
    # what the jobs keep goes with them, and Spark may add up the tasks' sums
    assert set(spark.sparkContext._jsc.getPersistentRDDs()) <= before
    monkeypatch.setattr(gains, "DRIVER_CELLS", 0)
    assert splits(gains.gbt_splits(rows, "y", 5, 3, 4, 0.1, 42)) == [s for s in splits(one) if s[0] < 3]


def test_a_level_adds_up_the_smaller_children(spark, monkeypatch):
    rows = train.assembled(table(spark, 3000, 5), FEATURES, ["y"])
    monkeypatch.setattr(gains, "TASK_CELLS", 0)
    asked = []
    tree = gains._Fit.tree

    def noted(self, number, totals):
        def counted(level, grown, nodes):
            found = totals(level, grown, nodes)
            asked.append((number, level, int(found[1, :, 0].sum())))
            return found

        return tree(self, number, counted)

    monkeypatch.setattr(gains._Fit, "tree", noted)
    gains.gbt_splits(rows, "y", 5, 3, 4, 0.1, 42)
    assert [n for _, level, n in asked if not level] == [3000] * 3
    assert len(asked) == 12 and all(n <= 1500 for _, level, n in asked if level)


def test_odd_rows(spark):
    df = table(spark, 40, 1)
    one_class = train.assembled(df.withColumn("y", F.lit(1)), FEATURES, ["y"])
    assert gains.gbt_importance(one_class, "y", 5, 3, 4, 0.1, 42) == [0.0] * 5
    assert list(spark_fit(one_class, 3, 4).featureImportances.toArray()) == [0.0] * 5
    for bad in (df.limit(0), df.withColumn("y", F.lit(2)), df.withColumn("y", F.when(F.col("a") > 0, 1))):
        with pytest.raises(ValueError):
            gains.gbt_splits(train.assembled(bad, FEATURES, ["y"]), "y", 5, 2, 4, 0.1, 42)
    for value in (float("inf"), float("nan"), None):
        with pytest.raises(Exception):
            wrong = df.withColumn("a", F.when(F.col("b") > 0, F.lit(value).cast("double")).otherwise(F.col("a")))
            gains.gbt_splits(train.assembled(wrong, FEATURES, ["y"]), "y", 5, 2, 4, 0.1, 42)


def test_selection_is_that_of_sparks_fit(spark):
    df = table(spark, 2000, 3)
    got = {r.feature: r for r in train.select_by_importance(df, FEATURES, "y", rounds=10).collect()}
    want = dict(zip(FEATURES, spark_fit(train.assembled(df, FEATURES, ["y"]), 10, 4).featureImportances.toArray()))
    assert {f: r.importance for f, r in got.items()} == pytest.approx(want, rel=1e-6, abs=1e-12)
    cut = sorted(want.values())[2]
    assert {f for f, r in got.items() if r.kept} == {f for f in FEATURES if want[f] >= cut}


def fitted(spark, monkeypatch, cells, **params):
    """A model over blocks where ``cells`` is 0, else Spark's own."""
    monkeypatch.setattr(train, "SPARK_CELLS", cells)
    monkeypatch.setattr(gains, "BLOCK_CELLS", 5 * 300)
    df = table(spark, 3000, 4)
    return df, train.train_gbt(df, FEATURES, "y", train.TreeParams(rounds=8, max_depth=3, **params))


def test_a_large_fit_without_draws_is_sparks(spark, monkeypatch):
    """The trees over blocks, as a model: scores, importances and what is stored of it."""
    df, want = fitted(spark, monkeypatch, 1 << 30, subsample=1.0, colsample=1.0)
    monkeypatch.setattr(GBTClassifier, "_fit", None)
    df, got = fitted(spark, monkeypatch, 0, subsample=1.0, colsample=1.0)
    assert got.treeWeights == want.treeWeights and got.numFeatures == want.numFeatures and got.getLabelCol() == "y"
    scores = [train.score_table(m, df, FEATURES, ["y", "a", "b"]).orderBy("a", "b").toPandas() for m in (got, want)]
    assert np.allclose(scores[0]["p"], scores[1]["p"], rtol=1e-6)
    assert got.featureImportances.toArray() == pytest.approx(want.featureImportances.toArray(), rel=1e-6, abs=1e-12)
    names = ["tree", "node", "feature_index", "threshold", "left", "right", "n_rows", "weight"]
    nodes = [train.node_table(m).select(*names).orderBy("tree", "node").collect() for m in (got, want)]
    assert nodes[0] == nodes[1]
    losses = [[r.loss for r in train.loss_curve(m, df, FEATURES, "y").orderBy("round").collect()] for m in (got, want)]
    assert losses[0] == pytest.approx(losses[1], rel=1e-6)
    short = [train.first_trees(m, 3).featureImportances.toArray() for m in (got, want)]
    assert short[0] == pytest.approx(short[1], rel=1e-6, abs=1e-12)


def test_a_large_fit_draws_rows_and_features(spark, monkeypatch):
    df, model = fitted(spark, monkeypatch, 0, subsample=0.6, colsample=0.4, min_child_rows=40)
    nodes = train.node_table(model).collect()
    roots = [r.n_rows for r in nodes if r.node == 0]
    assert len(set(roots)) == 8 and all(1650 < n < 1950 for n in roots)
    assert min(r.n_rows for r in nodes) >= 40
    # two of five features for a node, so the strongest one cannot be at every root
    assert len({r.feature_index for r in nodes if r.node == 0}) > 1
    again = fitted(spark, monkeypatch, 0, subsample=0.6, colsample=0.4, min_child_rows=40)[1]
    assert again.toDebugString.split("\n")[1:] == model.toDebugString.split("\n")[1:]
    curve = train.learning_curve(model, {"train": df}, FEATURES, "y").orderBy("round").collect()
    assert curve[-1].auc > curve[0].auc > 0.6
    whole = fitted(spark, monkeypatch, 1 << 30, subsample=0.6, colsample=0.4, min_child_rows=40)[1]
    other = train.learning_curve(whole, {"train": df}, FEATURES, "y").orderBy("round").collect()
    assert abs(curve[-1].auc - other[-1].auc) < 0.03
