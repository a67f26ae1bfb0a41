"""Searches and near duplicates of vectors against all pairs."""

from collections import Counter

import numpy as np
import pytest

from riskloom.llm import neighbours, topk

SCHEMA = "vec_id long, embedding array<double>, label int, score string, node int, vector int, rank int, able int"
EXTRA = ("s", 1, 2, 3, 4)
NAN, INF = float("nan"), float("inf")

ODD = [
    (1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1), (5, [1.0, NAN], 1), (6, [INF, 1.0], 1),
    (50, [0.5, -0.25, 1.0], 1), (50, [0.5, -0.25, 1.0], 1), (51, [0.5, -0.25, 1.0], 1), (52, [0.5, -0.25, 1.0], None),
    (100, [1.0], 2), (101, [2.0], 2), (None, [3.0], 2), (102, [-1.0], 2), (150, [1e200, 1.0], 3), (151, [2e200, 2.0], 3),
]


def frame(spark, rows):
    return spark.createDataFrame([r + EXTRA for r in rows], SCHEMA).repartition(3)


def usable(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v)


def brute_top(rows, k=5):
    whole = {(i, tuple(int(256 * x // 1) for x in v)) for i, v, _ in rows if i is not None and i % 50 == 0 and usable(v)}
    offered = [(i, [int(256 * x // 1) for x in v]) for i, v, _ in rows if i is not None and usable(v)]
    out = Counter()
    for query_id, q in whole:
        scores = sorted((-sum(a * b for a, b in zip(q, c)), i) for i, c in offered if i != query_id)[:k]
        for rank, (score, i) in enumerate(scores, 1):
            out[query_id, rank, i, min(max(-score, -(1 << 63)), (1 << 63) - 1)] += 1
    return out


def test_top_of_odd_rows(spark):
    got = topk.top_products(frame(spark, ODD)).collect()
    assert Counter(tuple(r) for r in got) == brute_top(ODD)
    assert topk.top_products(frame(spark, ODD).limit(0)).count() == 0


def test_top_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 70)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 20)).round(2)
    x[100:140] = x[100]  # ties
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    got = topk.top_products(frame(spark, rows)).collect()
    assert Counter(tuple(r) for r in got) == brute_top(rows)


def brute_links(rows, cosine=0.98):
    def unit(v):
        v = np.array(v, float) / max(map(abs, v))
        return v / np.sqrt((v**2).sum())

    able = [label is not None and usable(v) and any(v or []) for _, v, label in rows]
    width = max(len(v or []) for _, v, _ in rows)
    units = [np.pad(unit(v), (0, width - len(v))) if a else None for a, (_, v, _) in zip(able, rows)]
    n, parent = len(rows), list(range(len(rows)))

    def root(i):
        return i if parent[i] == i else root(parent[i])

    links = [0] * n
    for i in range(n):
        for j in range(i):
            if able[i] and able[j] and rows[i][2] == rows[j][2] and units[i] @ units[j] >= cosine:
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    ids = {}
    for i, r in enumerate(rows):
        ids.setdefault(root(i), []).append(r[0])
    out = Counter()
    for i, r in enumerate(rows):
        known = [x for x in ids[root(i)] if x is not None]
        least = min(known) if known else None
        out[r[0], links[i], least, r[0] == least] += 1
    return out


def test_links_of_odd_rows(spark):
    got = neighbours.near_vectors(frame(spark, ODD)).collect()
    assert Counter(tuple(r) for r in got) == brute_links(ODD)
    assert neighbours.near_vectors(frame(spark, ODD).limit(0)).count() == 0


@pytest.mark.parametrize("window", [16, 1024])
def test_links_of_groups(spark, window):
    """Groups of near copies, one far larger than a small window; nothing false, and nothing lost but by chance."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(20, 24))
    x = np.concatenate([rng.normal(size=(300, 24)), centres[0] + rng.normal(size=(150, 24)) * 0.05]
                       + [c + rng.normal(size=(5, 24)) * 0.1 for c in centres[1:]])
    rows = [(i, v.tolist(), int(i % 3 > 1)) for i, v in enumerate(x)]
    want = {r[0]: r for r in brute_links(rows)}
    got = {r.vec_id: r for r in neighbours.near_vectors(frame(spark, rows), window=window).collect()}
    assert sorted(got) == sorted(want)
    assert all(got[i].n_links <= want[i][1] for i in want)
    assert sum(r.n_links for r in got.values()) >= 0.97 * sum(r[1] for r in want.values())
    same = np.mean([got[i].component_id == want[i][2] for i in want])
    assert same == 1 if window == 1024 else same > 0.97


@pytest.mark.parametrize("n, window, mean", [(6_000, 64, 0.9), (6_000, 64, 0.7)])
def test_links_of_a_shared_direction(spark, n, window, mean):
    """Planted pairs just above the limit, among vectors of one label whose mean cosine is high."""
    rng = np.random.default_rng(7)

    def unit(x):
        return x / np.linalg.norm(x, axis=1)[:, None]

    centre = np.eye(64)[:1]
    x = unit(mean**0.5 * centre + (1 - mean) ** 0.5 * unit(rng.normal(size=(n, 64))))
    planted = 300
    other = rng.normal(size=(planted, 64))
    other = unit(other - (other * x[:planted]).sum(axis=1)[:, None] * x[:planted])
    x[n - planted :] = 0.981 * x[:planted] + (1 - 0.981**2) ** 0.5 * other
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    got = {r.vec_id: r for r in neighbours.near_vectors(frame(spark, rows), window=window).collect()}
    found = sum(got[i].component_id == got[n - planted + i].component_id for i in range(planted))
    assert found >= 0.98 * planted


def test_crowded_keys_take_more_passes():
    assert neighbours.crowded_passes([], 99) == 3
    assert neighbours.crowded_passes([1.0, 0.1], 99) < neighbours.crowded_passes([1.0, 0.9, 0.8, 0.4], 99) < 99
    assert neighbours.crowded_passes([1.0] * 33, 99) == float("inf")
