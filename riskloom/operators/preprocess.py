"""The fitted preprocessing of a feature table: numeric, ordinal and one-hot blocks, then what is left.

Everything a fit learns is a handful of numbers, category tables and, for nearest neighbours, the numeric columns of the
rows it may look at. All of it can be stored and loaded, so new rows are treated by the fit and by nothing of their own.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators import encode, impute, knn, scale
from riskloom.operators.ordered import finite, quantile_dict
from riskloom.schema import ORDINAL_COLUMNS, TARGET, numeric_columns, string_columns
from riskloom.session import written
from riskloom.sources import tables

_SETTINGS = ("key", "imputation", "scaling", "target", "keep", "given", "numeric", "ordinal", "nominal", "fitted")


@dataclass
class Preprocessor:
    """``fit`` then ``transform``; ``keep`` names columns to pass through untouched; any other imputation name means the
    mean, any other scaling name standardising."""

    key: str
    imputation: str = "knn"
    scaling: str = "robust"
    target: str = TARGET
    keep: tuple[str, ...] = ()
    given: list[str] = field(default_factory=list)
    numeric: list[str] = field(default_factory=list)
    ordinal: list[str] = field(default_factory=list)
    nominal: list[str] = field(default_factory=list)
    fitted: dict = field(default_factory=dict)
    codes: DataFrame | None = None
    donors: DataFrame | None = None

    def fit(self, df: DataFrame) -> "Preprocessor":
        self._fit(df)
        return self

    def fit_transform(self, df: DataFrame) -> DataFrame:
        """What ``fit`` and ``transform`` give for the same rows, with their neighbours searched once."""
        if self.imputation != "knn":
            return self.fit(df).transform(df)
        return self._finish(df, self._fit(df, whole=True))

    def _fit(self, df: DataFrame, whole: bool = False) -> DataFrame | None:
        """Fit on ``df``; the filled rows, with key and numbers or ``whole``, unless quantiles alone fill them."""
        skip = {self.key, self.target, *self.keep}
        strings = [c for c in string_columns(df) if c not in skip]
        self.given = [c for c in numeric_columns(df) if c not in skip]
        self.fitted["mode"] = impute.fit_mode(df, strings)
        # a string column without any value cannot be encoded
        self.ordinal = [c for c in strings if c in ORDINAL_COLUMNS and c in self.fitted["mode"]]
        self.nominal = [c for c in strings if c not in ORDINAL_COLUMNS and c in self.fitted["mode"]]

        if self.imputation == "knn":
            self.donors = written(df.select(self.key, *map(F.col, map(encode.quoted, self.given))), "donors")
        elif self.imputation == "median" and self.scaling == "robust" and self.given:
            self._fit_strings(df, self._fit_quantiles(df))
            return None
        elif self.imputation == "median":
            self.fitted["fill"] = impute.fit_median(df, self.given)
        else:
            self.fitted["fill"] = impute.fit_mean(df, self.given)
        # filled once: the scales below read it several times
        rows = filled = written(self._impute(df if whole else df.select(self.key, *self.given)), "filled")
        self.numeric = [c for c in self.given if c in filled.columns]
        if self.scaling == "yeo-johnson":
            self.fitted["powers"] = scale.fit_yeo_johnson(filled, self.numeric)
            filled = filled.withColumns(self._powers())
            self.fitted["scale"] = scale.fit_standard(filled, self.numeric)
        else:
            fits = {"robust": scale.fit_robust, "minmax": scale.fit_minmax}
            self.fitted["scale"] = fits.get(self.scaling, scale.fit_standard)(filled, self.numeric)
        self._fit_strings(df, self.fitted["scale"])
        return rows

    def _fit_quantiles(self, df: DataFrame) -> scale.Scales:
        """Medians to fill with, and the scales of the filled columns: a column without gaps has the quantiles that it
        had before, so only the others are filled and ordered again."""
        found = quantile_dict(df, self.given, [0.25, 0.5, 0.75])
        self.fitted["fill"] = {c: q[0.5] for c, q in found.items() if q}
        self.numeric = [c for c in self.given if c in self.fitted["fill"]]
        gaps = [F.count_if(finite(encode.quoted(c)).isNull()).alias(f"n{i}") for i, c in enumerate(self.numeric)]
        counts = df.agg(F.count(F.lit(1)), *gaps).first()
        holed = [c for c, n in zip(self.numeric, counts[1:]) if n]
        scales = {c: scale.robust(found[c]) for c in self.numeric if c not in holed}
        if holed:
            filled = written(impute.fill(df.select(*map(encode.quoted, holed)), self.fitted["fill"], holed), "filled")
            scales |= scale.fit_robust(filled, holed)
        return scales

    def _fit_strings(self, df: DataFrame, scales: scale.Scales) -> None:
        self.fitted["scale"] = scales
        encoded = [*self.ordinal, *self.nominal]
        modes = impute.fill(df.select(*encoded), self.fitted["mode"], encoded) if encoded else df
        self.fitted["onehot"] = encode.fit_onehot(modes, self.nominal)
        self.codes = written(encode.fit_codes(modes, self.ordinal), "codes")

    def _impute(self, df: DataFrame) -> DataFrame:
        if self.imputation == "knn":
            return knn.impute_knn(df, self.given, self.key, fit_on=self.donors)
        return impute.fill(df, self.fitted["fill"], self.given)

    def _powers(self) -> dict:
        return {
            c: scale.yeo_johnson(F.col(c).cast("double"), F.lit(p)) for c, p in self.fitted.get("powers", {}).items()
        }

    def transform(self, df: DataFrame) -> DataFrame:
        """Key, numeric, ordinal, one-hot and passed-through columns, in that order. Nothing is fitted on ``df``."""
        return self._finish(df, self._impute(df))

    def _finish(self, df: DataFrame, out: DataFrame) -> DataFrame:
        """``out``, the rows of ``df`` with their numbers filled, scaled and encoded."""
        powers = self._powers()
        out = scale.apply_scales(out.withColumns(powers) if powers else out, self.fitted["scale"])
        strings = [*self.ordinal, *self.nominal]
        out = impute.fill(out, self.fitted["mode"], strings) if strings else out
        out = encode.apply_codes(out, self.ordinal, self.codes)
        before = set(out.columns)
        out = encode.apply_onehot(out, self.fitted["onehot"])
        shown = [c for c in out.columns if c not in before]
        first = [self.key, *self.numeric, *self.ordinal, *shown]
        dropped = {c for c in string_columns(df) if c not in {self.key, self.target, *self.keep}}
        rest = [c for c in out.columns if c not in first and c not in dropped]
        return out.select(*map(encode.quoted, [*first, *rest]))

    def save(self, base: str, name: str) -> None:
        """Store the fit as versioned tables below ``base``: settings and numbers, codes, and donors if it has any."""
        spark = self.codes.sparkSession
        state = json.dumps({k: getattr(self, k) for k in _SETTINGS})
        tables.sink_table(self.codes, base, f"{name}_codes")
        if self.donors is not None:
            tables.sink_table(self.donors, base, f"{name}_donors")
        # last, so that a state that can be read is whole
        tables.sink_table(spark.createDataFrame([(state,)], "state string"), base, f"{name}_state")

    @classmethod
    def load(cls, spark: SparkSession, base: str, name: str) -> "Preprocessor":
        state = json.loads(tables.scan_table(spark, base, f"{name}_state").first()[0])
        state["keep"] = tuple(state["keep"])
        fitted = cls(**state, codes=tables.scan_table(spark, base, f"{name}_codes"))
        fitted.fitted["scale"] = {c: tuple(v) for c, v in fitted.fitted["scale"].items()}
        if fitted.imputation == "knn":
            fitted.donors = tables.scan_table(spark, base, f"{name}_donors")
        return fitted


def preprocess(
    df: DataFrame,
    key: str,
    imputation: str = "knn",
    scaling: str = "robust",
    fit_on: DataFrame | None = None,
    target: str = TARGET,
) -> DataFrame:
    fitted = Preprocessor(key, imputation, scaling, target)
    return fitted.fit_transform(df) if fit_on is None else fitted.fit(fit_on).transform(df)

