import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from riskloom.operators import knn
from riskloom.operators import preprocess as preprocessing
from riskloom.operators.preprocess import preprocess


def brute(x, keys, k):
    """All pairs, in numpy."""
    out = x.copy()
    order = np.argsort(keys, kind="stable")
    for i in range(len(x)):
        for j in np.flatnonzero(np.isnan(x[i])):
            found = []
            for o in order:
                if np.isnan(x[o, j]):
                    continue
                both = ~np.isnan(x[i]) & ~np.isnan(x[o])
                if both.any():
                    found.append((((x[i, both] - x[o, both]) ** 2).sum() * x.shape[1] / both.sum(), keys[o], x[o, j]))
            found.sort(key=lambda t: (t[0], t[1]))
            near = [v for *_, v in found[:k]]
            out[i, j] = np.mean(near) if near else np.nanmean(x[:, j])
    return out


def frame(spark, x):
    names = [f"c{j}" for j in range(x.shape[1])]
    pdf = pd.DataFrame(x, columns=names)
    pdf.insert(0, "id", [f"r{i:04d}" for i in range(len(x))])
    return spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None).values.tolist(),
                                 "id string, " + ", ".join(f"{n} double" for n in names)), pdf["id"].to_numpy(), names


@pytest.mark.parametrize(("leaf_rows", "parts"), [(1000, 4), (8, 2)])
def test_matches_all_pairs(spark, monkeypatch, leaf_rows, parts):
    monkeypatch.setattr(knn, "LEAF_ROWS", leaf_rows)
    monkeypatch.setattr(knn, "SPLIT_PARTS", parts)
    monkeypatch.setattr(knn, "SPLIT_COLUMNS", 2)
    monkeypatch.setattr(knn, "ASKING_ROWS", 10)
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(300, 5)) * [100, 30, 10, 1, 0.1], 3)
    x[:100, 0] = 7.0  # a hot value
    x[:40] = x[0]  # copies
    x[rng.random(x.shape) < 0.15] = np.nan
    x[5] = np.nan  # nothing to compare by
    df, keys, names = frame(spark, x)
    got = knn.impute_knn(df, names, "id").toPandas().sort_values("id")[names].to_numpy(dtype=float)
    assert np.allclose(got, brute(x, keys, 5), rtol=1e-9, atol=1e-9)


def test_drops_empty_column_and_uses_means(spark):
    x = np.array([[1.0, np.nan, np.nan], [np.nan, 4.0, np.nan], [3.0, np.nan, np.nan]])
    df, _, names = frame(spark, x)
    got = knn.impute_knn(df, names, "id").toPandas().sort_values("id")
    assert list(got.columns) == ["id", "c0", "c1"]
    assert got["c0"].tolist() == [1.0, 2.0, 3.0] and got["c1"].tolist() == [4.0, 4.0, 4.0]


def test_fit_on_other_rows(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(120, 3))
    x[rng.random(x.shape) < 0.2] = np.nan
    df, keys, names = frame(spark, x)
    fit_on = df.where("id < 'r0080'")
    got = knn.impute_knn(df, names, "id", fit_on=fit_on).toPandas().sort_values("id")[names].to_numpy(dtype=float)
    want = x.copy()
    means = np.nanmean(x[:80], axis=0)
    for i in range(80, 120):
        rows = np.vstack([x[:80], x[i]])
        want[i] = brute(rows, np.append(keys[:80], keys[i]), 5)[-1]
        want[i] = np.where(np.isnan(x[i]) & np.isnan(want[i]), means, want[i])
    assert np.allclose(got[80:], want[80:], equal_nan=True)


def test_leaves_stay_small_and_nodes_nest(spark, monkeypatch):
    """Hot values and far outliers included, every donor is in one small leaf inside the boxes above it."""
    monkeypatch.setattr(knn, "LEAF_ROWS", 20)
    monkeypatch.setattr(knn, "SPLIT_PARTS", 2)
    monkeypatch.setattr(knn, "SPLIT_COLUMNS", 2)
    rng = np.random.default_rng(11)
    x = rng.normal(size=(1200, 3)).round(2)
    x[:700, 0], x[:500, 1] = 3.0, -1.0
    x[700:710, 2] = 10.0 ** np.arange(10)
    df, keys, names = frame(spark, x)
    xs = ["x0", "x1", "x2"]
    placed, levels = knn._tree(knn._vector(df, names, "id"), xs, 5)
    rows = placed.toPandas()
    assert sorted(rows["key"]) == sorted(keys)
    assert rows.groupby("cell").size().max() <= 20 and len(levels) > 3
    nodes = pd.concat([level.toPandas() for level in levels]).set_index("node")
    assert nodes.index.is_unique and nodes[nodes.leaf].n.sum() == 1200
    for node, row in nodes[nodes.parent != ""].iterrows():
        above = nodes.loc[row.parent]
        assert all(above[f"low_{c}"] <= row[f"low_{c}"] and row[f"high_{c}"] <= above[f"high_{c}"] for c in xs)


def test_default_preprocessing_is_neighbours_then_robust_scaling(spark):
    rng = np.random.default_rng(17)
    x = np.round(rng.normal(size=(150, 4)) * [50, 20, 5, 1], 3)
    x[rng.random(x.shape) < 0.2] = np.nan
    df, keys, names = frame(spark, x)
    got = preprocess(df, "id").toPandas().sort_values("id")[names].to_numpy(dtype=float)
    filled = brute(x, keys, 5)
    low, mid, high = np.percentile(filled, [25, 50, 75], axis=0)
    assert np.allclose(got, (filled - mid) / (high - low), rtol=1e-9, atol=1e-9)


def test_neighbours_are_searched_once_for_the_rows_of_the_fit(spark, monkeypatch):
    """Fitting and transforming the same rows gives the rows of doing so one after the other, by one search."""
    rng = np.random.default_rng(19)
    x = np.round(rng.normal(size=(90, 3)) * [50, 20, 5], 3)
    x[rng.random(x.shape) < 0.2] = np.nan
    df, _, names = frame(spark, x)
    df = df.withColumn("grade", F.expr("substr('ABC', 1 + cast(substr(id, 2) as int) % 3, 1)"))
    # a key twice and a missing one
    df = df.unionByName(df.limit(1)).unionByName(df.limit(1).withColumn("id", F.lit(None).cast("string")))
    searches = []
    monkeypatch.setattr(preprocessing.knn, "impute_knn", lambda *a, _f=knn.impute_knn, **k: searches.append(1) or _f(*a, **k))
    once = preprocess(df, "id")
    assert len(searches) == 1
    twice = preprocessing.Preprocessor("id").fit(df).transform(df)
    assert once.columns == twice.columns
    order = lambda t: sorted(t.collect(), key=lambda r: (r.id or "", r[1]))
    got, want = order(once), order(twice)
    assert [r[0] for r in got] == [r[0] for r in want] and len(got) == 92
    assert np.allclose(np.array([r[1:] for r in got], float), np.array([r[1:] for r in want], float))


def test_a_leaf_compares_few_pairs_exactly(monkeypatch):
    """In a large leaf most donors are passed over; far values, ties and overflow change no result."""
    monkeypatch.setattr(knn, "TILE_DONORS", 16)
    rng = np.random.default_rng(23)
    y = np.round(rng.normal(size=(4000, 3)) * [1000, 300, 1], 1)
    y[:30] = y[30]  # more ties than neighbours
    y[40], y[41] = 1e160, 1e9
    x = np.vstack([y[28:45], np.round(rng.normal(size=(40, 3)) * [1000, 300, 1], 1)])
    with np.errstate(all="ignore"):
        d = sum((x[:, [f]] - y[None, :, f]) ** 2 for f in range(3))
        i, j, got = knn._Leaf(y).nearest(x, np.arange(3), np.full(len(x), np.inf), 5)
    for r in range(len(x)):
        want = [o for o in np.argsort(d[r], kind="stable") if np.isfinite(d[r, o])][:5]
        assert j[i == r].tolist() == want and got[i == r].tolist() == d[r, want].tolist()
    compared = []
    monkeypatch.setattr(np, "partition", lambda a, *r, _f=np.partition, **k: compared.append(a.size) or _f(a, *r, **k))
    near = np.round(rng.normal(size=(64, 3)) * [20, 20, 1], 1)
    knn._Leaf(y[50:]).nearest(near, np.arange(3), np.full(64, np.inf), 5)
    assert 0 < sum(compared) < 64 * 3950 / 5


def test_more_leaves_than_a_table_to_send(spark, monkeypatch):
    """Beyond that the leaves are met by joins, with the same estimates."""
    monkeypatch.setattr(knn, "LEAF_ROWS", 8)
    monkeypatch.setattr(knn, "SPLIT_PARTS", 2)
    monkeypatch.setattr(knn, "BROADCAST_ROWS", 3)
    rng = np.random.default_rng(29)
    x = np.round(rng.normal(size=(120, 3)) * [100, 30, 1], 2)
    x[rng.random(x.shape) < 0.15] = np.nan
    df, keys, names = frame(spark, x)
    got = knn.impute_knn(df, names, "id").toPandas().sort_values("id")[names].to_numpy(dtype=float)
    assert np.allclose(got, brute(x, keys, 5), rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("first", [True, False])
def test_requests_measure_few_leaves(monkeypatch, first):
    """Each request gets the leaves that all of them would give it, but most are ruled out for many requests at once."""
    rng = np.random.default_rng(31)
    xs, k = ["x0", "x1", "x2"], 5
    corners = np.stack(np.meshgrid(*[np.arange(0, 100, 10.0)] * 3), axis=-1).reshape(-1, 3)
    low, high = corners.copy(), corners + rng.uniform(2, 10, size=corners.shape)
    low[::7, 2] = high[::7, 2] = np.nan  # leaves of rows without the last column
    n = rng.integers(3, 200, len(low))
    leaves = [Row(node=f"n{i}", n=int(n[i]), **{f"{s}_{x}": None if np.isnan(v[i, j]) else float(v[i, j])
              for s, v in (("low", low), ("high", high)) for j, x in enumerate(xs)}) for i in range(len(low))]
    x = rng.uniform(-5, 105, size=(640, 3)).round(2)
    x[:100] = x[0]
    column = rng.integers(0, 3, len(x))
    x[np.arange(len(x)), column] = np.nan
    x[100] = np.nan  # nothing to compare by
    x[101] = [1e200, np.nan, 1.0]
    column[101] = 1
    limit = rng.uniform(0, 300, len(x))
    limit[200:203] = np.inf
    batch = pa.RecordBatch.from_pydict(
        {"key": [f"r{i}" for i in range(len(x))], "column": pa.array(column, pa.int32()), "limit": limit}
        | {c: pa.array(x[:, j], from_pandas=True) for j, c in enumerate(xs)}
    )
    measured = []
    monkeypatch.setattr(np, "fmax", lambda a, *r, _f=np.fmax, **kw: measured.append(np.size(a)) or _f(a, *r, **kw))
    out = list(knn._reached(leaves, xs, k, first)(iter([batch])))
    monkeypatch.undo()
    got = sorted((key, cell) for b in out for key, cell in zip(b.column("key").to_pylist(), b.column("cell").to_pylist()))
    want = []
    for i in range(len(x)):
        with np.errstate(all="ignore"):
            side = np.nan_to_num(np.fmax(np.fmax(low - x[i], x[i] - high), 0))
            far = np.nan_to_num(np.fmax(x[i] - low, high - x[i]))
            shared = (~np.isnan(low) & ~np.isnan(x[i])).sum(axis=1)
            near, far = ((v[:, 0] ** 2 + v[:, 1] ** 2 + v[:, 2] ** 2) * 3 / shared for v in (side, far))
        held = ~np.isnan(low[:, column[i]]) & (shared > 0)
        if not first:
            want += [(f"r{i}", f"n{j}") for j in np.flatnonzero(held & (near <= limit[i]) & np.isfinite(near))]
            continue
        hoped = np.where(held & (n >= k), near + far * (k / n) ** (2 / 3), np.inf)
        if np.isfinite(hoped).any():
            want.append((f"r{i}", f"n{hoped.argmin()}"))
    assert got == sorted(want) and len(got) > 500
    assert sum(measured) < len(x) * len(leaves) * (5 if first else 2)
