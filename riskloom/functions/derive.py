"""Derived credit features as column expressions, each listed with the columns it needs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: columns the derived features are built from
SQUARED = ["dti", "revol_util", "int_rate"]
RISK_COLUMNS = ["dti", "delinq_2yrs", "revol_util", "pub_rec"]


def _over(top: Column, bottom: str) -> Column:
    return F.try_divide(top.cast("double"), F.col(bottom).cast("double") + F.lit(1.0))


def _ratio_table() -> dict[str, tuple[tuple[str, str], Column]]:
    c = F.col
    return {
        "loan_to_income": (("loan_amnt", "annual_inc"), _over(c("loan_amnt"), "annual_inc")),
        "installment_to_income": (("installment", "annual_inc"), _over(c("installment") * F.lit(12), "annual_inc")),
        "revol_bal_to_income": (("revol_bal", "annual_inc"), _over(c("revol_bal"), "annual_inc")),
        "debt_to_credit_lines": (("revol_bal", "total_acc"), _over(c("revol_bal"), "total_acc")),
        "util_per_account": (("revol_util", "open_acc"), _over(c("revol_util"), "open_acc")),
        "payment_to_loan": (("installment", "loan_amnt"), _over(c("installment"), "loan_amnt")),
    }


def ratios(present: Iterable[str]) -> dict[str, Column]:
    have = set(present)
    return {name: expr for name, (needs, expr) in _ratio_table().items() if have.issuperset(needs)}


def interactions(present: Iterable[str]) -> dict[str, Column]:
    have = set(present)
    pairs = [("dti", "int_rate"), ("loan_amnt", "term"), ("revol_util", "total_acc")]
    return {f"{a}_x_{b}": F.col(a) * F.col(b) for a, b in pairs if a in have and b in have}


def squares(present: Iterable[str]) -> dict[str, Column]:
    have = set(present)
    return {f"{c}_squared": F.col(c) * F.col(c) for c in SQUARED if c in have}


def min_max_unit(name: str, low: float | None, high: float | None) -> Column:
    """``(x - low) / (high - low)``; a constant column keeps ``x - low``; nothing fitted gives null."""
    if low is None or high is None:
        return F.lit(None).cast("double")
    shifted = F.col(name).cast("double") - F.lit(float(low))
    return shifted / F.lit(float(high) - float(low)) if high > low else shifted


def risk_score(bounds: dict[str, tuple[float | None, float | None]]) -> Column | None:
    """Mean of the min-max scaled risk columns; needs at least two of them."""
    used = [c for c in RISK_COLUMNS if c in bounds]
    if len(used) < 2:
        return None
    total = min_max_unit(used[0], *bounds[used[0]])
    for c in used[1:]:
        total = total + min_max_unit(c, *bounds[c])
    return total / F.lit(float(len(used)))
