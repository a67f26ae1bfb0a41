import inspect

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import attribution, calibrate, importance, metrics, train
from riskloom.plans import queries

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def sets(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(1500, 3))
    y = (x[:, 0] + 0.5 * x[:, 1] ** 2 + 0.3 * rng.normal(size=1500) > 0.4).astype(int)
    rows = [(f"r{i}", *map(float, v), int(t)) for i, (v, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id string, a double, b double, c double, y int").cache()
    return df.where("substr(id, 2) % 3 > 0"), df.where("substr(id, 2) % 3 = 0")


@pytest.fixture(scope="module")
def model(sets):
    return train.train_gbt(sets[0], FEATURES, "y", train.TreeParams(rounds=6, max_depth=3), sets[1])


def test_learns_a_planted_signal(sets, model):
    scored = train.score_table(model, sets[1], FEATURES, ["y"])
    assert metrics.roc_auc(scored, "y", "p").first().roc_auc > 0.85
    again = train.train_gbt(sets[0], FEATURES, "y", train.TreeParams(rounds=6, max_depth=3), sets[1])
    assert again.toDebugString.splitlines()[1:] == model.toDebugString.splitlines()[1:]
    shares = train.model_importance(model, FEATURES).collect()
    assert shares[0].feature == "a" and sum(r.relative_importance for r in shares) == pytest.approx(100)


def test_patience():
    assert train.best_round([3.0, 2.0, 2.5, 1.0], 50) == 4
    assert train.best_round([3.0, 2.0, 2.5, 2.4, 1.0], 2) == 2
    assert train.best_round([1.0, 2.0], 1) == 1


def test_contributions_add_up_to_the_margin(sets, model):
    rows = sets[1].limit(60)
    table = attribution.shap_table(model, rows, FEATURES, "id")
    total = table.groupBy("id").agg((F.sum("contribution") + F.first("base")).alias("margin"))
    raw = model.transform(train.assembled(rows, FEATURES, ["id"]))
    from pyspark.ml.functions import vector_to_array

    want = {r.id: r.m for r in raw.select("id", vector_to_array("rawPrediction")[1].alias("m")).collect()}
    got = {r.id: r.margin for r in total.collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)
    assert importance.shap_summary(table).where("rank = 1").first().feature == "a"


def test_contributions_against_all_subsets():
    """Shapley values of one small tree from the definition."""
    from itertools import combinations
    from math import factorial

    inf = np.inf
    # x0 <= 0: 1 (0.6), else x1 <= 2: 5 (0.4 * 0.25), else 9 (0.4 * 0.75)
    leaves = [
        (1.0, [(0, -inf, 0.0, 0.6)]),
        (5.0, [(0, 0.0, inf, 0.4), (1, -inf, 2.0, 0.25)]),
        (9.0, [(0, 0.0, inf, 0.4), (1, 2.0, inf, 0.75)]),
    ]

    def expected(x, known):
        out = 0.0
        for value, path in leaves:
            share = 1.0
            for f, low, high, part in path:
                share *= float(low < x[f] <= high) if f in known else part
            out += value * share
        return out

    x = np.array([[1.0, 3.0, 0.0], [-1.0, 1.0, 0.0]])
    phi = attribution.contributions(x, leaves)
    for row, got in zip(x, phi):
        for f in range(3):
            others = [g for g in range(3) if g != f]
            want = sum(
                factorial(len(s)) * factorial(2 - len(s)) / 6 * (expected(row, {*s, f}) - expected(row, set(s)))
                for n in range(3)
                for s in combinations(others, n)
            )
            assert got[f] == pytest.approx(want)
        assert got[3] == pytest.approx(expected(row, set()))


def test_search_ranks_trials(sets):
    found = train.hyperparam_search(*sets, FEATURES, "y", n_trials=2, base=train.TreeParams(rounds=2))
    rows = found.orderBy("rank").collect()
    assert [r["rank"] for r in rows] == [1, 2] and rows[0].score >= rows[1].score
    assert 0.01 <= train.best_params(found).learning_rate <= 0.3
    with pytest.raises(ValueError):
        train.hyperparam_search(*sets, FEATURES, "y", metric="loss")


def test_learning_curve_ends_at_the_model(sets, model):
    curve = train.learning_curve(model, {"val": sets[1]}, FEATURES, "y").orderBy("round").collect()
    scored = train.score_table(model, sets[1], FEATURES, ["y"])
    assert len(curve) == len(model.treeWeights)
    assert curve[-1].auc == pytest.approx(metrics.roc_auc(scored, "y", "p").first().roc_auc)


def test_learning_curve_is_exact_in_cells(sets, model, spark, monkeypatch):
    """Every round against the metric over all rows, with few cells or many; rows are not multiplied by the rounds."""
    from pyspark.ml.functions import vector_to_array

    raw = train.assembled(sets[1], FEATURES, ["y"])
    want, names = [], []
    for i in range(len(model.treeWeights)):
        short = train.first_trees(model, i + 1)
        scored = short.transform(raw).select("y", vector_to_array("rawPrediction")[1].alias("m"))
        want.append(metrics.roc_auc(scored, "y", "m").first().roc_auc)
    both = {"val": sets[1], "none": sets[1].where("y = 0"), "unlabelled": sets[1].withColumn("y", F.lit(None).cast("int"))}
    for bits in (0, 5, 30):
        monkeypatch.setattr(train, "CELL_BITS", bits)
        curve = train.learning_curve(model, both, FEATURES, "y").orderBy("data", "round").collect()
        assert [(r.data, r["round"]) for r in curve] == [(n, i + 1) for n in ("none", "val") for i in range(len(want))]
        assert [r.auc for r in curve] == pytest.approx([None] * len(want) + want, abs=1e-12)
    plan = train.learning_curve(model, both, FEATURES, "y")._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan


def test_isotonic_is_the_pooled_fit(spark):
    df = spark.createDataFrame(
        [(0.1, 0), (0.2, 1), (0.2, 0), (0.3, 0), (0.6, 1), (0.7, 0), (0.8, 1), (0.9, 1)], "p double, y int"
    )
    fitted = calibrate.fit_isotonic(df, "y", "p")
    asked = spark.createDataFrame([(v,) for v in (0.0, 0.1, 0.2, 0.3, 0.45, 0.6, 0.7, 0.8, 1.0)], "p double")
    got = [r.calibrated for r in fitted.transform(asked, "p").collect()]
    third = 1 / 3
    assert got == pytest.approx([0, 0, third, third, (third + 0.5) / 2, 0.5, 0.5, 1, 1])


def test_sigmoid_matches_newton(spark):
    rng = np.random.default_rng(5)
    p = rng.random(400)
    y = (rng.random(400) < 1 / (1 + np.exp(-(4 * p - 1)))).astype(int)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(p, y)], "p double, y int")
    target = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    w, design = np.zeros(2), np.column_stack([p, np.ones_like(p)])
    for _ in range(50):
        q = 1 / (1 + np.exp(-design @ w))
        w += np.linalg.solve((design * (q * (1 - q))[:, None]).T @ design, design.T @ (target - q))
    out = calibrate.fit_sigmoid(df, "y", "p").transform(df, "p").collect()
    want = 1 / (1 + np.exp(-design @ w))
    assert np.allclose(sorted(r.calibrated for r in out), sorted(want), atol=1e-4)


def test_the_search_query_runs_in_full(spark, sets, monkeypatch):
    asked = inspect.signature(train.hyperparam_search)
    monkeypatch.setattr(queries, "learning_sets", lambda *_: {"train": sets[0], "val": sets[1]})
    monkeypatch.setattr(train, "hyperparam_search", lambda *a, **k: asked.bind(*a, **k))
    call = queries.hyperparam_search(spark, "")
    call.apply_defaults()
    assert call.arguments["n_trials"] == 50
    assert (call.arguments["base"].rounds, call.arguments["base"].patience) == (10_000, 50)


def test_first_trees_are_those_of_a_shorter_fit(sets, model):
    whole = train.train_gbt(sets[0], FEATURES, "y", train.TreeParams(rounds=5, max_depth=3))
    short = train.train_gbt(sets[0], FEATURES, "y", train.TreeParams(rounds=2, max_depth=3))
    cut = train.first_trees(whole, 2)
    assert cut.toDebugString.splitlines()[1:] == short.toDebugString.splitlines()[1:]
    rows = [[r.p for r in train.score_table(m, sets[1], FEATURES, ["id"]).orderBy("id").collect()] for m in (cut, short)]
    assert rows[0] == rows[1]
    assert cut.featureImportances == short.featureImportances


def test_exchanging_a_useless_column_changes_nothing(spark, sets, model):
    """Against the same exchange in plain loops; ``d`` is planted and unknown to the score."""
    import hashlib

    names = ["a", "b", "d"]
    rows = sets[1].select("id", "a", "b", F.col("c").alias("d"), "y").limit(40).collect()
    df = spark.createDataFrame(rows)

    def scored(table, keep):
        return table.select(*keep, (1 / (1 + F.exp(-2 * F.col("a") - F.col("b")))).alias("p"))

    buckets = {}
    for r in rows:
        h = hashlib.md5(f"42|{r.id}".encode()).hexdigest()
        buckets.setdefault(int(h[:7], 16) % 4, []).append((h, r))
    losses = {None: [], "a": [], "b": [], "d": []}
    for members in buckets.values():
        members = [r for _, r in sorted(members)]
        n = len(members)
        for i, r in enumerate(members):
            for c, found in losses.items():
                v = r.asDict()
                if c is not None and n > 1:
                    v[c] = members[(i + 1 + names.index(c) % (n - 1)) % n][c]
                p = 1 / (1 + np.exp(-2 * v["a"] - v["b"]))
                found.append(-np.log(p if r.y else 1 - p))
    want = {c: max(0.0, np.mean(losses[c]) - np.mean(losses[None])) for c in names}
    got = {r.feature: r.importance for r in importance.permutation_importance(df, names, "y", ["id"], scored, 42, 10).collect()}
    assert got == pytest.approx(want) and got["d"] == 0 and got["a"] > got["b"]
    empty = importance.permutation_importance(df.limit(0), names, "y", ["id"], scored).collect()
    assert [(r.feature, r.importance) for r in empty] == [(c, 0.0) for c in names]
    one = importance.permutation_importance(df.limit(1), names, "y", ["id"], scored).collect()
    assert [r.importance for r in one] == [0.0, 0.0, 0.0]

    def trees(table, keep):
        return train.score_table(model, table, FEATURES, keep)

    found = importance.permutation_importance(sets[1], FEATURES, "y", ["id"], trees).collect()
    assert found[0].feature == "a"
