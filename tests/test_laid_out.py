"""Distances from a laid-out reference against those from all rows."""

import numpy as np
import pytest

from riskloom.operators import drift, laid_out


def table(spark, columns):
    names = list(columns)
    return spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"`{c}` double" for c in names))


@pytest.fixture(scope="module")
def reference(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=600), 2)
    hot = np.where(rng.random(600) < 0.5, 3.0, np.round(rng.normal(size=600), 1))
    return table(spark, {"x": x.tolist(), "hot": hot.tolist(), "one": [7.0] * 600, "odd name": (x * 2).tolist()})


CURRENT = {
    "inside": lambda rng: rng.normal(size=50),
    "one value": lambda rng: np.array([0.123]),
    "below all": lambda rng: rng.normal(-100, 1, size=40),
    "above all": lambda rng: rng.normal(100, 1, size=40),
    "both ends": lambda rng: np.array([-50.0, 50.0, 50.0]),
    "same values": lambda rng: np.round(rng.normal(size=300), 1),
}


@pytest.fixture(scope="module", params=[19, 1000])
def grouped(request, reference):
    return drift.group_reference(reference, request.param)


@pytest.mark.parametrize("case", CURRENT)
def test_same_distances_as_from_all_rows(spark, reference, grouped, case):
    rng = np.random.default_rng(6)
    current = table(spark, {c: CURRENT[case](rng).tolist() for c in reference.columns})
    found = {r.feature: r for r in laid_out.distances(grouped.numbers, current, reference.columns).collect()}
    want = {r.feature: r for r in drift.distribution_distances(reference, current).collect()}
    assert set(found) == set(want)
    for c, row in want.items():
        assert found[c].ks == pytest.approx(row.ks, abs=1e-12), c
        assert found[c].wasserstein == pytest.approx(row.wasserstein, abs=1e-9), c


def test_missing_values_and_empty_tables(spark, reference):
    nothing = reference.limit(0)
    nan = spark.createDataFrame([(float("nan"),) * 4, (None,) * 4], reference.schema)
    old = drift.group_reference(reference, 100)
    for grouped, current in ((old, nothing), (old, nan), (drift.group_reference(nothing), reference)):
        found = {r.feature: r.drift_score for r in drift.grouped_feature_drift(grouped, current).collect()}
        assert found == dict.fromkeys(reference.columns, 0.0)


def test_few_parts_are_opened(spark):
    """What a batch reads does not grow with the reference: a part for each value and one for each crossing."""
    for n in (500, 2_000):
        ref = spark.range(n).selectExpr("CAST(id AS DOUBLE) / 1000 AS x")
        numbers = drift.group_reference(ref, 50).numbers
        counted = laid_out._placed(numbers, table(spark, {"x": [0.1, 0.1, 0.4]}), ["x"])
        states = laid_out.part_states(numbers, counted, ["x"])
        assert states.count() == n // 50 and states.where("opened").count() <= 5
        opened = [r.part for r in states.where("opened").collect()]
        read = numbers.values.where(numbers.values.part.isin(opened))
        assert len(read.inputFiles()) == n // 50  # the whole listing; the scan takes the folders of its filter
        assert "PartitionFilters: [part" in read._jdf.queryExecution().executedPlan().toString()
        assert read.count() == 50 * len(opened)
