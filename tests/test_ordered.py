import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import curves, drift, impute, metrics, ordered, preprocess, scale, split


@pytest.fixture(scope="module")
def four(spark):
    return spark.createDataFrame([(0.1, 0), (0.4, 0), (0.35, 1), (0.8, 1)], "p double, y int")


def test_known_small_case(four):
    row = metrics.ranking_metrics(four, "y", "p").first()
    assert row.roc_auc == pytest.approx(0.75) and row.avg_precision == pytest.approx(0.8333333333)
    points = {(r.fpr, r.tpr) for r in curves.roc_curve(four, "y", "p").collect()}
    assert points == {(0.0, 0.0), (0.0, 0.5), (0.5, 0.5), (0.5, 1.0), (1.0, 1.0)}


def test_ties_count_half(spark):
    df = spark.createDataFrame([(0.5, 0), (0.5, 1), (0.5, 0), (0.9, 1)], "p double, y int")
    assert metrics.roc_auc(df, "y", "p").first().roc_auc == pytest.approx(0.75)


def test_one_class(spark):
    df = spark.createDataFrame([(0.5, 0), (0.2, 0)], "p double, y int")
    assert metrics.roc_auc(df, "y", "p").first().roc_auc is None
    basic = metrics.basic_metrics(df, "y", "p").first()
    assert (basic.precision, basic.recall, basic.f1) == (0.0, 0.0, 0.0)


def test_roc_drops_points_on_a_line(spark):
    # equal steps: one positive per score going down
    df = spark.createDataFrame([(s / 10, 1) for s in range(9, 4, -1)] + [(0.1, 0)], "p double, y int")
    every = curves.roc_curve(df, "y", "p").count()
    kept = curves.roc_curve(df, "y", "p", drop_intermediate=True).collect()
    assert every == 7 and sorted((r.fpr, round(r.tpr, 6)) for r in kept) == [(0, 0), (0, 0.2), (0, 1), (1, 1)]


def test_any_partitioning_gives_the_same(spark):
    rng = np.random.default_rng(1)
    rows = [(round(float(p), 2), int(rng.random() < p)) for p in rng.random(3000)]
    p, y = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    pos, neg = p[y == 1], p[y == 0]
    want = ((pos[:, None] > neg).mean() + (pos[:, None] == neg).mean() / 2)
    for n in (1, 8, 64):
        df = spark.createDataFrame(rows, "p double, y int").repartition(n)
        assert metrics.roc_auc(df, "y", "p").first().roc_auc == pytest.approx(want, abs=1e-12)


def test_quantiles_with_a_hot_value(spark):
    x = np.concatenate([np.zeros(4000), np.random.default_rng(2).lognormal(size=6000)])
    df = spark.createDataFrame([(float(v), float(-v)) for v in x], "a double, b double")
    probabilities = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    found = ordered.quantile_dict(df, ["a", "b"], probabilities)
    for q in probabilities:
        assert found["a"][q] == pytest.approx(np.quantile(x, q), abs=1e-12)
        assert found["b"][q] == pytest.approx(np.quantile(-x, q), abs=1e-12)


def test_distances(spark):
    rng = np.random.default_rng(4)
    a, b = np.round(rng.normal(size=700), 1), np.round(rng.normal(0.5, 2, size=400), 1)
    ref = spark.createDataFrame([(float(v),) for v in a] + [(None,)], "x double")
    cur = spark.createDataFrame([(float(v),) for v in b], "x double")
    grid = np.sort(np.unique(np.concatenate([a, b])))
    fa = np.searchsorted(np.sort(a), grid, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), grid, side="right") / len(b)
    row = drift.distribution_distances(ref, cur).first()
    assert row.ks == pytest.approx(np.abs(fa - fb).max())
    assert row.wasserstein == pytest.approx((np.abs(fa - fb)[:-1] * np.diff(grid)).sum())
    same = drift.distribution_distances(ref, ref).first()
    assert same.ks == 0 and same.wasserstein == 0


def test_drift_edges(spark):
    ref = spark.createDataFrame([(1.0, "a", 1, 2.0), (2.0, "b", 2, 2.0)], "n double, c string, t int, gone double")
    cur = spark.createDataFrame([(None, "z", "1")], "n double, c string, t string")
    scores = {r.feature: (r.kind, r.drift_score, r.drifted) for r in drift.feature_drift(ref, cur).collect()}
    assert scores == {"n": ("numeric", 0.0, False), "c": ("categorical", 1.0, True), "t": ("type", 1.0, True)}
    ref_m = spark.createDataFrame([("auc", 0.0), ("f1", 0.5)], "metric string, value double")
    cur_m = spark.createDataFrame([("auc", -0.3), ("f1", 0.4)], "metric string, value double")
    assert drift.concept_drift(ref_m, cur_m).first() == (0.3, True)
    assert drift.concept_drift(ref_m, None).first() == (0.0, False)
    left = spark.createDataFrame([("a", 100.0)], "feature string, relative_importance double")
    right = spark.createDataFrame([("b", 100.0)], "feature string, relative_importance double")
    moved = {r.feature: (r.absolute_change, r.relative_change) for r in drift.importance_drift(left, right).collect()}
    assert moved == {"a": (-100.0, -1.0), "b": (100.0, 1000.0)}


def test_split_sizes_and_repeatability(spark):
    df = spark.range(997).selectExpr("CAST(id AS STRING) AS id", "IF(id % 3 = 0, NULL, CAST(id % 3 AS STRING)) AS g")
    once = {r.id: r.split for r in split.split_rows(df, ["id"]).collect()}
    again = {r.id: r.split for r in split.split_rows(df.repartition(13), ["id"]).collect()}
    assert once == again and len(once) == 997
    sizes = {s: sum(v == s for v in once.values()) for s in ("train", "val", "test")}
    assert sizes == split.expected_sizes(997, 0.2, 0.25)
    assert split.split_rows(df, ["id"], seed=7).where("split = 'test'").count() == sizes["test"]
    parts = split.split_rows(df, ["id"], stratum="g").groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in parts} == sizes
    every = split.split_rows(df, ["id"], test_size=1.0, val_size=0.0)
    assert {r.split for r in every.collect()} == {"test"}
    assert [r.id for r in split.sample_rows(df, ["id"], 10).collect()] == [
        r.id for r in split.sample_rows(df.repartition(5), ["id"], 10).collect()
    ]


def test_no_window_sees_all_rows(spark, four):
    """Windows without a partition key only run over bucket totals."""
    df = metrics.score_frequencies(four, "y", "p")
    plan = df._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        if "Window [" in line and "score" in line.split("windowspecdefinition")[-1]:
            assert "bucket" in line


def test_buckets_are_the_cuts_below(spark):
    """Found by whole steps first, for any number of partitions; values at and beyond the cuts included."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions in (8, 9, 50, 200):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            df = spark.range(700).select((F.col("id") % 3).alias("g"), (F.col("id") * F.col("id") % 641).cast("double").alias("v"))
            placed = ordered._bucketed(df, ["g"], "v")
            assert sorted(placed.columns) == ["bucket", "g", "v"]
            sketch = F.percentile_approx("v", [i / partitions for i in range(1, partitions)], 10 * partitions)
            cuts = {r.g: r.cuts for r in df.groupBy("g").agg(sketch.alias("cuts")).collect()}
            assert all(r.bucket == sum(c < r.v for c in cuts[r.g]) for r in placed.collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_quantiles_order_only_the_buckets_that_hold_them(spark, monkeypatch):
    df = spark.range(2000).select(
        F.col("id").cast("double").alias("a"), F.when(F.col("id") % 5 != 0, F.col("id") % 7).alias("b")
    )
    seen, real = [], ordered.bucketed_long
    monkeypatch.setattr(ordered, "bucketed_long", lambda *a, **k: seen.append(real(*a, **k)) or seen[-1])
    got = ordered.quantile_dict(df, ["a", "b"], [0.25, 0.5, 0.75])
    assert got == {"a": {0.25: 499.75, 0.5: 999.5, 0.75: 1499.25}, "b": {0.25: 1.0, 0.5: 3.0, 0.75: 5.0}}
    assert len(seen) == 2 and seen[1].where("feature = 'a'").count() < 0.8 * seen[0].where("feature = 'a'").count()


def test_columns_without_gaps_are_scaled_by_their_first_quantiles(spark, monkeypatch):
    df = spark.range(300).select(
        "id", (F.col("id") % 11).alias("whole"), F.when(F.col("id") % 4 != 0, F.col("id") * 1.0).otherwise(float("nan")).alias("gaps"),
        F.concat(F.lit("g"), F.col("id") % 3).alias("grade"),
    )
    medians = impute.fit_median(df, ["whole", "gaps"])
    want = scale.fit_robust(impute.fill(df, medians, ["whole", "gaps"]), ["whole", "gaps"])
    ordered_again, real = [], scale.fit_robust
    monkeypatch.setattr(scale, "fit_robust", lambda rows, names: ordered_again.append(list(names)) or real(rows, names))
    fitted = preprocess.Preprocessor("id", "median", "robust").fit(df)
    assert ordered_again == [["gaps"]]
    assert fitted.fitted["fill"] == medians and fitted.fitted["scale"] == want and fitted.numeric == ["whole", "gaps"]


def test_shifted_scores_are_worked_out_once(spark, monkeypatch):
    """The rows behind the monitored metrics are computed once, not for every name in the shift and the metrics."""
    from riskloom.plans import queries

    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def score(i):
        seen.add(1)
        return i % 10 / 10

    df = spark.range(0, 100, 1, 2).select((F.col("id") % 2).cast("int").alias("loan_status"), "id")
    df = df.select("loan_status", F.when(F.col("id") < 50, "ref").otherwise("cur").alias("side"), score("id").alias("p"))
    monkeypatch.setattr(queries, "scored_loans", lambda *a: df)
    ref, cur = queries._metrics_of_sides(spark, "")
    assert ref.count() == cur.count() == 5 and seen.value == 100
