"""Per-row feature contributions of a boosted-tree model.

Path-dependent Shapley values (Lundberg et al., "Consistent individualized feature attribution for tree
ensembles"), evaluated leaf by leaf: for one leaf a row matters only through which of the features on its path it
satisfies, so a leaf's share is a polynomial over at most ``depth`` features. It is built once a leaf, and one feature's
factor is divided out of it again, so the work of a leaf is the square of its depth. Rows stream through in Arrow batches;
the trees, whose size does not depend on the data, travel with the task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import factorial

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.train import node_table

# a leaf: (value, [(feature, smallest, largest, share of rows)…]) with x in (smallest, largest]
Leaf = tuple[float, list[tuple[int, float, float, float]]]

SAMPLE_ROWS = 1000


def _leaves(model: GBTClassificationModel) -> list[Leaf]:
    """Every leaf of every tree, the splits on one feature merged into one interval."""
    trees: dict[int, dict[int, object]] = {}
    for row in node_table(model).collect():
        trees.setdefault(row["tree"], {})[row["node"]] = row
    leaves: list[Leaf] = []
    for nodes in trees.values():
        stack = [(0, {})]
        while stack:
            at, path = stack.pop()
            node = nodes[at]
            if node["left"] < 0:
                leaves.append((node["prediction"] * node["weight"], [(f, *v) for f, v in path.items()]))
                continue
            f, cut = node["feature_index"], node["threshold"]
            for child, lower in ((node["left"], False), (node["right"], True)):
                low, high, share = path.get(f, (-np.inf, np.inf, 1.0))
                low, high = (max(low, cut), high) if lower else (low, min(high, cut))
                share *= nodes[child]["n_rows"] / node["n_rows"]
                stack.append((child, {**path, f: (low, high, share)}))
    return leaves


def _leaf_shares(leaf: Leaf, x: np.ndarray, out: np.ndarray) -> None:
    """Add one leaf's contributions for all rows of ``x`` to ``out`` (rows x features, last column the base)."""
    value, path = leaf
    m = len(path)
    met = [((x[:, f] > low) & (x[:, f] <= high)).astype(float) for f, low, high, _ in path]
    shares = [share for *_, share in path]
    out[:, -1] += value * np.prod(shares)
    weights = [factorial(k) * factorial(m - 1 - k) / factorial(m) for k in range(m)]
    # coefficient k of the product over the path: k of its features known, the rest averaged out
    whole = np.zeros((m + 1, len(x)))
    whole[0] = 1.0
    for j in range(m):
        whole[1 : j + 2] = whole[1 : j + 2] * shares[j] + whole[: j + 1] * met[j]
        whole[0] *= shares[j]
    for i, (f, *_rest) in enumerate(path):
        # the product without feature i: its factor is share + z where the row satisfies it, else share alone
        known = met[i] > 0
        rest = whole[m]
        total = np.zeros(len(x))
        for k in range(m - 1, -1, -1):
            total += weights[k] * np.where(known, rest, whole[k] / shares[i])
            rest = whole[k] - shares[i] * rest
        out[:, f] += value * (met[i] - shares[i]) * total


def contributions(x: np.ndarray, leaves: list[Leaf]) -> np.ndarray:
    out = np.zeros((len(x), x.shape[1] + 1))
    for leaf in leaves:
        _leaf_shares(leaf, x, out)
    return out


def shap_table(model: GBTClassificationModel, df: DataFrame, features: Sequence[str], key: str) -> DataFrame:
    """``(key, feature, value, contribution, base)`` in margin units, for every row of ``df``: contributions and base
    add up to the model's margin. Reports usually pass ``sample_rows(df, …, SAMPLE_ROWS)``."""
    leaves = _leaves(model)
    names = list(features)

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = batch[names].to_numpy(dtype=float)
            phi = contributions(x, leaves)
            yield pd.DataFrame(
                {
                    "id": np.repeat(batch["id"].to_numpy(), len(names)),
                    "feature": names * len(batch),
                    "value": x.ravel(),
                    "contribution": phi[:, :-1].ravel(),
                    "base": np.repeat(phi[:, -1], len(names)),
                }
            )

    rows = df.select(F.col(key).cast("string").alias("id"), *[F.col(c).cast("double").alias(c) for c in names])
    return rows.mapInPandas(
        explain, "id string, feature string, value double, contribution double, base double"
    )
