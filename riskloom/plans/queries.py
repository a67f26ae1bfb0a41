"""One query per operator over the loan view of the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators import (
    attribution,
    calibrate,
    curves,
    drift,
    encode,
    gates,
    generate,
    importance,
    impute,
    knn,
    metrics,
    scale,
    select,
    snapshot,
    split,
    stats,
    train,
)
from riskloom.operators import clean as C
from riskloom.operators import preprocess as prep
from riskloom.session import work_path, written
from riskloom.sources import loan_csv, tables
from riskloom.sources.loan_view import loans, scored_loans
from riskloom.streaming import drift_stream

AS_OF = "2005-01-01"
SEED = 42
KEY = ["id"]
NUMERIC = [
    "loan_amnt", "term", "int_rate", "installment", "emp_length", "annual_inc", "dti", "delinq_2yrs",
    "revol_util", "open_acc", "pub_rec", "revol_bal", "total_acc",
]
CATEGORICAL = ["grade", "home_ownership", "purpose", "addr_state"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Fractions rounded, since sums of doubles depend on their order."""
    doubles = {f.name for f in df.schema.fields if f.dataType.typeName() == "double"}
    return df.select(*[F.round(c, digits).alias(c) if c in doubles else F.col(c) for c in df.columns])


def cleaned(spark: SparkSession, d: str, columns: list[str], extra: list[str] | None = None) -> DataFrame:
    """Cleaned loans with the label and ``columns``; only what is asked for is read."""
    raw = loans(spark, d, list(dict.fromkeys([*(extra or []), "loan_status", "loan_amnt", *columns])))
    return C.clean(raw, AS_OF).select(*(extra or []), "loan_status", *columns)


def staged(spark: SparkSession, d: str, columns: list[str], extra: list[str] | None = None) -> DataFrame:
    """Cleaned loans as a written table, for operators that read their input more than once."""
    return written(cleaned(spark, d, columns, extra), "clean")


def sides(spark: SparkSession, d: str, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """The reference and the current loans."""
    df = staged(spark, d, columns, ["side"])
    return tuple(df.where(F.col("side") == s).select(*columns) for s in ("ref", "cur"))


# --- sources and sinks -------------------------------------------------------------------------


def _loan_files(spark: SparkSession, d: str) -> str:
    path = work_path(spark, "loan-files")
    raw = loans(spark, d)
    notes = raw.agg(F.concat(F.lit("Total rows in the file: "), F.count(F.lit(1)).cast("string")))
    loan_csv.write_loan_files(raw, path, notes)
    return path


@query
def scan_loan_csv(spark: SparkSession, d: str) -> DataFrame:
    rows = loan_csv.scan_loan_csv(spark, _loan_files(spark, d))
    return rows.select("id", "term", "int_rate", "grade", "issue_d", "loan_status", "settlement_term")


@query
def drop_note_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = loan_csv.drop_note_rows(loan_csv.scan_loan_csv(spark, _loan_files(spark, d)))
    return rows.select("id", "grade", F.col("loan_amnt").try_cast("double").alias("loan_amnt"))


@query
def scan_table(spark: SparkSession, d: str) -> DataFrame:
    base = work_path(spark, "tables")
    tables.sink_table(loans(spark, d, ["id", "grade", "loan_amnt", "dti"]), base, "loans")
    return tables.scan_table(spark, base, "loans", columns=["id", "loan_amnt"])


@query
def sink_table(spark: SparkSession, d: str) -> DataFrame:
    base = work_path(spark, "tables")
    df = loans(spark, d, ["id", "grade", "loan_amnt"])
    written = [tables.sink_table(df, base, "loans", keep=1) for _ in range(2)]
    rows = tables.scan_table(spark, base, "loans").agg(F.count(F.lit(1)).alias("n_rows"))
    kept = tables.versions(spark, base, "loans")
    return rows.withColumns({"last_version": F.lit(written[-1]), "n_versions": F.lit(len(kept))})


@query
def sink_report(spark: SparkSession, d: str) -> DataFrame:
    base = work_path(spark, "reports")
    report = stats.categorical_stats(cleaned(spark, d, CATEGORICAL).select(*CATEGORICAL))
    tables.sink_report(report, base, "categories", "json")
    tables.sink_report(report, base, "categories_text", "csv")
    back = tables.scan_table(spark, base, "categories", fmt="json", schema=report.schema)
    text = tables.scan_table(spark, base, "categories_text", fmt="csv")
    return back.join(text.select("feature", F.col("top_categories").alias("as_text")), "feature").select(
        "feature", "unique_count", F.size(F.from_json("as_text", "map<string,double>")).alias("n_top")
    )


# --- filters and projections -------------------------------------------------------------------


@query
def drop_null_target(spark: SparkSession, d: str) -> DataFrame:
    return C.drop_null_target(loans(spark, d, ["id", "loan_status"]))


@query
def binary_target(spark: SparkSession, d: str) -> DataFrame:
    return C.binary_target(loans(spark, d, ["id", "loan_status"]))


@query
def amount_range(spark: SparkSession, d: str) -> DataFrame:
    return C.amount_range(loans(spark, d, ["id", "loan_amnt"]))


@query
def row_drop_audit(spark: SparkSession, d: str) -> DataFrame:
    return C.row_drop_audit(loans(spark, d, ["loan_status", "loan_amnt"]))


@query
def split_xy(spark: SparkSession, d: str) -> DataFrame:
    x, y = C.split_xy(cleaned(spark, d, ["grade", "dti"], ["id"]))
    labels = y.groupBy("loan_status").agg(F.count(F.lit(1)).alias("n_rows"))
    rows = x.agg(F.count(F.lit(1))).scalar()
    return labels.select("loan_status", "n_rows", rows.alias("x_rows"), F.lit(len(x.columns)).alias("x_columns"))


# --- scalar functions --------------------------------------------------------------------------


@query
def parse_percent(spark: SparkSession, d: str) -> DataFrame:
    return C.parse_percent(loans(spark, d, ["id", "int_rate", "revol_util"]))


@query
def parse_term(spark: SparkSession, d: str) -> DataFrame:
    return C.parse_term(loans(spark, d, ["id", "term"]))


@query
def map_emp_length(spark: SparkSession, d: str) -> DataFrame:
    return C.map_emp_length(loans(spark, d, ["id", "emp_length"]))


@query
def parse_dates(spark: SparkSession, d: str) -> DataFrame:
    df = C.parse_dates(loans(spark, d, ["id", "issue_d", "earliest_cr_line"]))
    shown = [F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("issue_d", "earliest_cr_line")]
    return df.select("id", *shown)


@query
def issue_parts(spark: SparkSession, d: str) -> DataFrame:
    return C.issue_parts(C.parse_dates(loans(spark, d, ["id", "issue_d"]))).drop("issue_d")


@query
def credit_history_years(spark: SparkSession, d: str) -> DataFrame:
    df = C.parse_dates(loans(spark, d, ["id", "earliest_cr_line"]))
    return C.credit_history_years(df, AS_OF).drop("earliest_cr_line")


# --- derived features --------------------------------------------------------------------------

RATIO_INPUTS = ["loan_amnt", "annual_inc", "installment", "revol_bal", "total_acc", "revol_util", "open_acc"]


@query
def ratio_features(spark: SparkSession, d: str) -> DataFrame:
    df = cleaned(spark, d, RATIO_INPUTS, ["id"])
    return generate.ratio_features(df).drop("loan_status", *RATIO_INPUTS)


@query
def interaction_features(spark: SparkSession, d: str) -> DataFrame:
    inputs = ["dti", "int_rate", "loan_amnt", "term", "revol_util", "total_acc"]
    return generate.interaction_features(cleaned(spark, d, inputs, ["id"])).drop("loan_status", *inputs)


@query
def squared_features(spark: SparkSession, d: str) -> DataFrame:
    inputs = ["dti", "int_rate", "revol_util"]
    return generate.squared_features(cleaned(spark, d, inputs, ["id"])).drop("loan_status", *inputs)


@query
def composite_risk_score(spark: SparkSession, d: str) -> DataFrame:
    inputs = ["dti", "delinq_2yrs", "revol_util", "pub_rec"]
    return generate.composite_risk_score(cleaned(spark, d, inputs, ["id"])).drop("loan_status", *inputs)


# --- imputation, scaling, encoding -------------------------------------------------------------

GAPS = ["annual_inc", "dti", "revol_util"]  # the columns with gaps
SCALED = NUMERIC


@query
def impute_mean(spark: SparkSession, d: str) -> DataFrame:
    return rounded(impute.impute_mean(staged(spark, d, GAPS, ["id"]), GAPS).drop("loan_status"))


@query
def impute_median(spark: SparkSession, d: str) -> DataFrame:
    return rounded(impute.impute_median(staged(spark, d, GAPS, ["id"]), GAPS).drop("loan_status"))


@query
def impute_mode(spark: SparkSession, d: str) -> DataFrame:
    df = loans(spark, d, ["id", "loan_status", "grade", "revol_util"])
    return impute.impute_mode(df, ["loan_status", "grade", "revol_util"])


def _scaled(spark: SparkSession, d: str, scaler) -> DataFrame:
    return rounded(scaler(staged(spark, d, SCALED, ["id"]), SCALED).drop("loan_status"))


@query
def scale_robust(spark: SparkSession, d: str) -> DataFrame:
    return _scaled(spark, d, scale.scale_robust)


@query
def scale_minmax(spark: SparkSession, d: str) -> DataFrame:
    return _scaled(spark, d, scale.scale_minmax)


@query
def scale_standard(spark: SparkSession, d: str) -> DataFrame:
    return _scaled(spark, d, scale.scale_standard)


@query
def scale_yeo_johnson(spark: SparkSession, d: str) -> DataFrame:
    return rounded(scale.scale_yeo_johnson(staged(spark, d, NUMERIC, ["id"]), NUMERIC).drop("loan_status"))


@query
def encode_ordinal(spark: SparkSession, d: str) -> DataFrame:
    df = staged(spark, d, ["grade", "addr_state"], ["id", "side"])
    fit_on = df.where((F.col("side") == "ref") & (F.col("grade") != "D"))
    return encode.encode_ordinal(df, ["grade", "addr_state"], fit_on).drop("loan_status", "side")


@query
def encode_onehot(spark: SparkSession, d: str) -> DataFrame:
    df = staged(spark, d, ["grade", "home_ownership"], ["id", "side"])
    fit_on = df.where(F.col("grade") != "D")
    return encode.encode_onehot(df, ["grade", "home_ownership", "side"], fit_on).drop("loan_status")


# --- selection ---------------------------------------------------------------------------------


@query
def variance_threshold(spark: SparkSession, d: str) -> DataFrame:
    return rounded(select.variance_threshold(cleaned(spark, d, NUMERIC), NUMERIC), 3)


@query
def feature_counts(spark: SparkSession, d: str) -> DataFrame:
    df = cleaned(spark, d, NUMERIC)
    return select.feature_counts(df, generate.FeatureGenerator().fit(df).transform(df), "loan_status")


# --- splits and samples ------------------------------------------------------------------------


@query
def split_random(spark: SparkSession, d: str) -> DataFrame:
    return split.split_rows(staged(spark, d, [], ["id"]), KEY, SEED).select("id", "split")


@query
def split_stratified(spark: SparkSession, d: str) -> DataFrame:
    df = staged(spark, d, ["grade"], ["id"])
    return split.split_rows(df, KEY, SEED, stratum="grade").select("id", "grade", "split")


@query
def split_trainval(spark: SparkSession, d: str) -> DataFrame:
    return split.split_trainval(split.split_rows(staged(spark, d, [], ["id"]), KEY, SEED)).select("id")


@query
def split_report(spark: SparkSession, d: str) -> DataFrame:
    parts = split.split_rows(staged(spark, d, ["grade"], ["id"]), KEY, SEED, stratum="grade")
    return rounded(split.split_report(parts, "loan_status"))


@query
def sample_rows(spark: SparkSession, d: str) -> DataFrame:
    return split.sample_rows(cleaned(spark, d, ["grade"], ["id"]), KEY, 1000, SEED).select("id", "grade")


# --- metrics and curves ------------------------------------------------------------------------


@query
def objective_metric(spark: SparkSession, d: str) -> DataFrame:
    return rounded(metrics.objective_metrics(scored_loans(spark, d), "loan_status", "p"))


@query
def confusion_matrix(spark: SparkSession, d: str) -> DataFrame:
    return metrics.confusion_matrix(scored_loans(spark, d), "loan_status", "p")


@query
def basic_metrics(spark: SparkSession, d: str) -> DataFrame:
    return rounded(metrics.basic_metrics(scored_loans(spark, d), "loan_status", "p"), 9)


@query
def rate_metrics(spark: SparkSession, d: str) -> DataFrame:
    return rounded(metrics.rate_metrics(scored_loans(spark, d), "loan_status", "p"), 9)


@query
def roc_auc(spark: SparkSession, d: str) -> DataFrame:
    return rounded(metrics.roc_auc(scored_loans(spark, d), "loan_status", "p"), 9)


@query
def average_precision(spark: SparkSession, d: str) -> DataFrame:
    return rounded(metrics.average_precision(scored_loans(spark, d), "loan_status", "p"), 9)


@query
def classification_report(spark: SparkSession, d: str) -> DataFrame:
    return rounded(metrics.classification_report(scored_loans(spark, d), "loan_status", "p"), 9)


@query
def roc_curve(spark: SparkSession, d: str) -> DataFrame:
    return rounded(curves.roc_curve(scored_loans(spark, d), "loan_status", "p"), 9)


@query
def pr_curve(spark: SparkSession, d: str) -> DataFrame:
    return rounded(curves.pr_curve(scored_loans(spark, d), "loan_status", "p"), 9)


@query
def calibration_curve(spark: SparkSession, d: str) -> DataFrame:
    return rounded(curves.calibration_curve(scored_loans(spark, d), "loan_status", "p"), 9)


@query
def score_histogram(spark: SparkSession, d: str) -> DataFrame:
    return rounded(curves.score_histogram(scored_loans(spark, d), "loan_status", "p", 30), 9)


@query
def threshold_sweep(spark: SparkSession, d: str) -> DataFrame:
    return rounded(curves.threshold_sweep(scored_loans(spark, d), "loan_status", "p"), 9)


@query
def promotion_gate(spark: SparkSession, d: str) -> DataFrame:
    return rounded(gates.promotion_gate(metrics.roc_auc(scored_loans(spark, d), "loan_status", "p")), 9)


# --- column statistics -------------------------------------------------------------------------


@query
def numeric_stats(spark: SparkSession, d: str) -> DataFrame:
    return rounded(stats.numeric_stats(staged(spark, d, NUMERIC), NUMERIC), 5)


@query
def categorical_stats(spark: SparkSession, d: str) -> DataFrame:
    listed = stats.categorical_stats(loans(spark, d, [*CATEGORICAL, "loan_status"]))
    return rounded(
        listed.select(
            "feature", "dtype", "unique_count", "missing", F.explode("top_categories").alias("category", "freq")
        ),
        9,
    )


@query
def missing_report(spark: SparkSession, d: str) -> DataFrame:
    return rounded(stats.missing_report(loans(spark, d)))


@query
def describe(spark: SparkSession, d: str) -> DataFrame:
    return rounded(stats.describe(staged(spark, d, NUMERIC), NUMERIC), 5)


@query
def schema_report(spark: SparkSession, d: str) -> DataFrame:
    return stats.schema_report(loans(spark, d))


@query
def table_profile(spark: SparkSession, d: str) -> DataFrame:
    return rounded(stats.table_profile(staged(spark, d, NUMERIC + CATEGORICAL)))


@query
def value_counts(spark: SparkSession, d: str) -> DataFrame:
    return rounded(stats.value_counts(loans(spark, d, ["loan_status"]), "loan_status"))


@query
def histogram(spark: SparkSession, d: str) -> DataFrame:
    df = cleaned(spark, d, ["loan_amnt", "int_rate", "installment", "annual_inc", "dti", "revol_util"])
    names = [c for c in df.columns if c != "loan_status"]
    return rounded(curves.histogram(df, names, 30, by="loan_status"))


@query
def histogram_auto(spark: SparkSession, d: str) -> DataFrame:
    return rounded(curves.histogram(staged(spark, d, NUMERIC), NUMERIC))


# --- drift -------------------------------------------------------------------------------------


def correlation_importance(df: DataFrame, columns: list[str], label: str = "loan_status") -> DataFrame:
    """Importance scores that follow from the table alone: the absolute correlation with the label."""
    row = df.agg(*[F.abs(F.corr(F.col(c).cast("double"), F.col(label).cast("double"))).alias(c) for c in columns])
    scores = row.unpivot([], columns, "feature", "importance").where(~F.isnan("importance"))
    return importance.feature_importance(scores, columns)


def _importance_of_sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    df = cleaned(spark, d, NUMERIC, ["side"])
    label = F.col("loan_status").cast("double")
    strength = [F.abs(F.corr(F.col(c).cast("double"), label)).alias(c) for c in NUMERIC]
    scores = df.groupBy("side").agg(*strength).unpivot(["side"], NUMERIC, "feature", "importance")
    scores = written(scores.where(~F.isnan("importance")), "importance")  # a row per feature and side
    return tuple(
        importance.feature_importance(scores.where(F.col("side") == s).drop("side"), NUMERIC) for s in ("ref", "cur")
    )


def _metrics_of_sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    # written, as the shift and the metrics name the columns several times and would work each of them out as often
    df = written(scored_loans(spark, d, ["side"]), "scored")
    # current scores err more: a fifth of the label signal is gone
    shifted = F.when(F.col("side") == "cur", F.col("p") - F.col("loan_status") * 0.06).otherwise(F.col("p"))
    found = metrics.monitored_metrics(df.withColumn("p", shifted), "loan_status", "p", groups=["side"])
    return tuple(found.where(F.col("side") == s).drop("side") for s in ("ref", "cur"))


def _shifted_sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Reference and current loans, the current amounts raised by 30 % so that something has drifted."""
    ref, cur = sides(spark, d, NUMERIC + CATEGORICAL)
    cur = cur.withColumns({"loan_amnt": F.col("loan_amnt") * 1.3, "open_acc": F.col("open_acc").cast("string")})
    return ref, cur


@query
def feature_importance(spark: SparkSession, d: str) -> DataFrame:
    return rounded(correlation_importance(cleaned(spark, d, NUMERIC), NUMERIC))


@query
def topk_importance(spark: SparkSession, d: str) -> DataFrame:
    found = correlation_importance(cleaned(spark, d, NUMERIC), NUMERIC)
    return rounded(importance.topk_importance(found, 5))


@query
def shap_summary(spark: SparkSession, d: str) -> DataFrame:
    return rounded(importance.shap_summary(_linear_contributions(spark, d)))


@query
def shap_dependence(spark: SparkSession, d: str) -> DataFrame:
    return rounded(importance.shap_dependence(written(_linear_contributions(spark, d), "contributions")))


def _linear_contributions(spark: SparkSession, d: str) -> DataFrame:
    """Contributions of a linear score: the correlation with the label times the standardised value.

    The instalment is a multiple of the amount, so only one of them is ranked.
    """
    names = [c for c in NUMERIC if c != "installment"]
    df = cleaned(spark, d, names, ["id"])
    weights = df.agg(
        *[
            F.struct(
                F.corr(F.col(c).cast("double"), F.col("loan_status").cast("double")).alias("w"),
                F.avg(c).alias("m"),
                F.stddev_pop(c).alias("s"),
            ).alias(c)
            for c in names
        ]
    ).first()
    cells = []
    for c in names:
        w, m, s = weights[c]
        value = F.col(c).cast("double")
        score = (value - F.lit(m)) / F.lit(s) * F.lit(w) if s else F.lit(0.0)
        cells.append(F.struct(F.lit(c).alias("feature"), value.alias("value"), score.alias("contribution")))
    return df.select("id", F.inline(F.array(*cells)))


@query
def ks_statistic(spark: SparkSession, d: str) -> DataFrame:
    return rounded(drift.ks_statistic(*sides(spark, d, NUMERIC)), 9)


@query
def wasserstein(spark: SparkSession, d: str) -> DataFrame:
    return rounded(drift.wasserstein(*sides(spark, d, NUMERIC)))


@query
def numeric_drift(spark: SparkSession, d: str) -> DataFrame:
    ref, cur = _shifted_sides(spark, d)
    return rounded(drift.numeric_drift(ref, cur))


@query
def moment_drift(spark: SparkSession, d: str) -> DataFrame:
    ref, cur = _shifted_sides(spark, d)
    # a feature that the current loans have no value of
    cur = cur.withColumn("revol_util", F.lit(None).cast("double"))
    return rounded(drift.moment_drift(ref, cur))


@query
def categorical_drift(spark: SparkSession, d: str) -> DataFrame:
    return rounded(drift.categorical_drift(*sides(spark, d, CATEGORICAL)), 9)


@query
def type_mismatch_drift(spark: SparkSession, d: str) -> DataFrame:
    scores = drift.type_mismatch_drift(*_shifted_sides(spark, d))
    drifted = F.col("drift_score") > drift.DRIFT_THRESHOLD
    return scores.select("feature", F.lit("type").alias("kind"), "drift_score", drifted.alias("drifted"))


@query
def feature_drift(spark: SparkSession, d: str) -> DataFrame:
    return rounded(drift.feature_drift(*_shifted_sides(spark, d)))


@query
def overall_drift(spark: SparkSession, d: str) -> DataFrame:
    scores = drift.feature_drift(*_shifted_sides(spark, d))
    return rounded(drift.overall_drift(scores, correlation_importance(cleaned(spark, d, NUMERIC), NUMERIC)))


@query
def concept_drift(spark: SparkSession, d: str) -> DataFrame:
    return rounded(drift.concept_drift(*_metrics_of_sides(spark, d)), 9)


@query
def importance_drift(spark: SparkSession, d: str) -> DataFrame:
    return rounded(drift.importance_drift(*_importance_of_sides(spark, d)), 5)


@query
def topk_drift(spark: SparkSession, d: str) -> DataFrame:
    return rounded(drift.topk_drifted(drift.feature_drift(*_shifted_sides(spark, d), threshold=0.01)))


@query
def topk_importance_drift(spark: SparkSession, d: str) -> DataFrame:
    return rounded(drift.topk_changed(drift.importance_drift(*_importance_of_sides(spark, d))), 5)


@query
def category_compare(spark: SparkSession, d: str) -> DataFrame:
    return rounded(drift.category_compare(*sides(spark, d, CATEGORICAL)), 9)


@query
def metric_compare(spark: SparkSession, d: str) -> DataFrame:
    return rounded(drift.metric_compare(*_metrics_of_sides(spark, d)), 9)


@query
def metric_changes(spark: SparkSession, d: str) -> DataFrame:
    return rounded(drift.metric_changes(*_metrics_of_sides(spark, d)), 9)


@query
def kl_drift(spark: SparkSession, d: str) -> DataFrame:
    ref, cur = sides(spark, d, NUMERIC)
    return rounded(drift.kl_drift(ref, cur.withColumn("loan_amnt", F.col("loan_amnt") * 1.3)))


@query
def drift_alert(spark: SparkSession, d: str) -> DataFrame:
    alert = drift.drift_alert(
        drift.feature_drift(*_shifted_sides(spark, d)),
        drift.concept_drift(*_metrics_of_sides(spark, d)),
        drift.importance_drift(*_importance_of_sides(spark, d)),
    )
    text = {c: F.array_join(c, ",") for c in ("drifted_features", "changed_features")}
    return rounded(alert.withColumns(text))


@query
def default_rate_by_grade(spark: SparkSession, d: str) -> DataFrame:
    """The flagship: cleaning and ratios, then default rate and mean ratios per grade."""
    df = generate.ratio_features(cleaned(spark, d, ["grade", "int_rate", *RATIO_INPUTS]))
    means = ["int_rate", "loan_to_income", "installment_to_income", "revol_bal_to_income", "payment_to_loan"]
    return rounded(
        df.groupBy("grade").agg(
            F.count(F.lit(1)).alias("n_loans"),
            F.avg(F.col("loan_status").cast("double")).alias("default_rate"),
            *[F.avg(c).alias(f"mean_{c}") for c in means],
        )
    )




# --- learning ----------------------------------------------------------------------------------

LEARNED = [*NUMERIC, "p"]
ROUNDS = 100


def learning_sets(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """Train, validation and test rows: the cleaned loans with gaps filled from the training rows, and the
    label-bearing score ``p`` as one more feature."""
    df = cleaned(spark, d, [*NUMERIC, "score_milli"], ["id"])
    df = df.withColumn("p", (F.col("score_milli") * 7 + F.col("loan_status") * 3000) / F.lit(10000.0))
    df = df.drop("score_milli").persist()  # read by every pass of the split; its rows stay where they are
    try:
        parts = split.split_rows(df, KEY, SEED)
        means = impute.fit_mean(parts.where(F.col("split") == "train"), NUMERIC)
        filled = written(impute.fill(parts, means, NUMERIC), "learning")
    finally:
        df.unpersist()
    return {s: filled.where(F.col("split") == s) for s in ("train", "val", "test")}


def _model(sets: dict[str, DataFrame]):
    params = train.TreeParams(rounds=ROUNDS, max_depth=4, seed=SEED)
    return train.train_gbt(sets["train"], LEARNED, "loan_status", params, sets["val"])


@query
def train_gbt(spark: SparkSession, d: str) -> DataFrame:
    sets = learning_sets(spark, d)
    model = _model(sets)
    scored = train.score_table(model, sets["test"], LEARNED, ["loan_status"])
    found = metrics.all_metrics(scored, "loan_status", "p")
    return found.withColumn("n_trees", F.lit(len(model.treeWeights)))


@query
def score_table(spark: SparkSession, d: str) -> DataFrame:
    sets = learning_sets(spark, d)
    return train.score_table(_model(sets), sets["test"], LEARNED, ["id", "loan_status"])


@query
def hyperparam_search(spark: SparkSession, d: str) -> DataFrame:
    sets = learning_sets(spark, d)
    base = train.TreeParams(rounds=train.MOST_ROUNDS, seed=SEED)
    return train.hyperparam_search(sets["train"], sets["val"], LEARNED, "loan_status", base=base)


@query
def learning_curve(spark: SparkSession, d: str) -> DataFrame:
    sets = learning_sets(spark, d)
    return train.learning_curve(
        _model(sets), {"train": sets["train"], "val": sets["val"]}, LEARNED, "loan_status"
    )


@query
def select_by_importance(spark: SparkSession, d: str) -> DataFrame:
    return train.select_by_importance(learning_sets(spark, d)["train"], LEARNED, "loan_status", rounds=ROUNDS)


@query
def model_importance(spark: SparkSession, d: str) -> DataFrame:
    return train.model_importance(_model(learning_sets(spark, d)), LEARNED)


EXCHANGED = ["int_rate", "dti", "annual_inc", "total_acc"]


def _fixed_score(rows: DataFrame, keep: list[str]) -> DataFrame:
    """A logistic score with given weights, which leaves ``total_acc`` out."""
    rate = (F.coalesce("int_rate", F.lit(12.0)) - 12.0) * 0.15
    debt = (F.coalesce("dti", F.lit(15.0)) - 15.0) * 0.03
    income = F.coalesce("annual_inc", F.lit(60000.0)) / 100000.0
    return rows.select(*keep, (1.0 / (1.0 + F.exp(1.0 + income - rate - debt))).alias("p"))


@query
def permutation_importance(spark: SparkSession, d: str) -> DataFrame:
    df = cleaned(spark, d, EXCHANGED, ["id"])
    return rounded(importance.permutation_importance(df, EXCHANGED, "loan_status", KEY, _fixed_score, SEED))


@query
def model_importance_drift(spark: SparkSession, d: str) -> DataFrame:
    """Trees fitted on the reference loans; their permutation importance on reference loans held out from the fit and on
    the current ones, whose score says less about the label."""
    df = cleaned(spark, d, [*NUMERIC, "score_milli"], ["id", "side"])
    signal = F.when(F.col("side") == "ref", 3000).otherwise(1500)
    df = df.withColumn("p", (F.col("score_milli") * 7 + F.col("loan_status") * signal) / F.lit(10000.0))
    df = written(df.drop("score_milli"), "sides")
    means = impute.fit_mean(df.where(F.col("side") == "ref"), NUMERIC)
    ref, cur = (impute.fill(df.where(F.col("side") == s), means, NUMERIC) for s in ("ref", "cur"))
    ref = written(split.split_rows(ref, KEY, SEED), "split")
    sets = {s: ref.where(F.col("split") == s) for s in ("train", "val", "test")}
    model = _model(sets)

    def score(rows: DataFrame, keep: list[str]) -> DataFrame:
        return train.score_table(model, rows, LEARNED, keep)

    found = [importance.permutation_importance(side, LEARNED, "loan_status", KEY, score, SEED) for side in (sets["test"], cur)]
    return drift.importance_drift(*found)


@query
def model_shap_summary(spark: SparkSession, d: str) -> DataFrame:
    """The summary of the trees' own contributions, over the sampled rows of ``shap_table``."""
    return importance.shap_summary(shap_table(spark, d))


@query
def calibrate_isotonic(spark: SparkSession, d: str) -> DataFrame:
    df = scored_loans(spark, d)
    fitted = calibrate.fit_isotonic(df, "loan_status", "p")
    scores = df.groupBy(F.col("p").alias("score")).agg(F.count(F.lit(1)).alias("n_rows"))
    return rounded(fitted.transform(scores, "score").select("score", "calibrated", "n_rows"), 9)


@query
def calibrate_sigmoid(spark: SparkSession, d: str) -> DataFrame:
    df = scored_loans(spark, d)
    fitted = calibrate.fit_sigmoid(df, "loan_status", "p")
    scores = df.groupBy(F.col("p").alias("score")).agg(F.count(F.lit(1)).alias("n_rows"))
    return rounded(fitted.transform(scores, "score").select("score", "calibrated", "n_rows"), 4)


@query
def shap_table(spark: SparkSession, d: str) -> DataFrame:
    sets = learning_sets(spark, d)
    sample = split.sample_rows(sets["train"], KEY, attribution.SAMPLE_ROWS, SEED)
    # a limit leaves one partition, and the attribution is the expensive part
    sample = sample.repartition(spark.sparkContext.defaultParallelism, *KEY)
    return attribution.shap_table(_model(sets), sample, LEARNED, "id")


# --- nearest neighbours, preprocessing, stored references, arriving batches ---------------------


@query
def impute_knn(spark: SparkSession, d: str) -> DataFrame:
    return knn.impute_knn(staged(spark, d, NUMERIC, ["id"]), NUMERIC, "id").drop("loan_status")


@query
def preprocess_new_rows(spark: SparkSession, d: str) -> DataFrame:
    """Fit on the reference loans, store, load, and apply to the current ones."""
    df = staged(spark, d, NUMERIC + CATEGORICAL, ["id", "side"])
    fitted = prep.Preprocessor("id", "median", "robust").fit(df.where(F.col("side") == "ref").drop("side"))
    base = work_path(spark, "fitted")
    fitted.save(base, "preprocessor")
    loaded = prep.Preprocessor.load(spark, base, "preprocessor")
    return rounded(loaded.transform(df.where(F.col("side") == "cur").drop("side")))


@query
def preprocess(spark: SparkSession, d: str) -> DataFrame:
    df = staged(spark, d, NUMERIC + CATEGORICAL, ["id"])
    return rounded(prep.preprocess(df, "id", imputation="median", scaling="robust"))


@query
def preprocess_default(spark: SparkSession, d: str) -> DataFrame:
    """Nearest neighbours, robust scaling and both encodings over the whole table."""
    return rounded(prep.preprocess(staged(spark, d, NUMERIC + CATEGORICAL, ["id"]), "id"))


@query
def scan_zip_csv(spark: SparkSession, d: str) -> DataFrame:
    rows = loan_csv.scan_zip_csv(spark, _zip_files(spark, d))
    return loan_csv.drop_note_rows(rows).select("id", "term", "grade", "loan_status")


def _zip_files(spark: SparkSession, d: str) -> str:
    """The raw files, each packed into an archive of its own by the tasks that read them."""
    path = work_path(spark, "zip-files")
    packed = loan_csv.pack_files(spark, _loan_files(spark, d), path)
    packed.write.format("noop").mode("overwrite").save()
    return path


@query
def reference_snapshot(spark: SparkSession, d: str) -> DataFrame:
    base = work_path(spark, "snapshot")
    ref, _ = sides(spark, d, NUMERIC + CATEGORICAL)
    found, _ = _importance_of_sides(spark, d)
    measured, _ = _metrics_of_sides(spark, d)
    snapshot.save_snapshot(base, ref, found, measured)
    parts = snapshot.load_snapshot(spark, base)
    data = parts["data"].agg(*[F.count(c).cast("double").alias(c) for c in parts["data"].columns])
    items = [data.unpivot([], data.columns, "feature", "value").withColumn("item", F.lit("data:non_null"))]
    shown = {
        "numeric_stats": ["mean", "std", "min", "max"],
        "categorical_stats": ["unique_count", "missing"],
        "importance": ["importance", "relative_importance"],
    }
    for part, names in shown.items():
        cells = parts[part].select("feature", *[F.col(c).cast("double").alias(f"{part}:{c}") for c in names])
        items.append(cells.unpivot(["feature"], [f"{part}:{c}" for c in names], "item", "value"))
    items.append(parts["metrics"].select(F.col("metric").alias("feature"), F.lit("metrics").alias("item"), "value"))
    out = items[0]
    for more in items[1:]:
        out = out.unionByName(more)
    return rounded(out)


@query
def stream_drift(spark: SparkSession, d: str) -> DataFrame:
    """The current loans arrive in two batches, by the last digit of the key; the stream ends and goes on in between."""
    names = [*NUMERIC, *CATEGORICAL]
    df = staged(spark, d, names, ["id", "side"])
    reference = drift.group_reference(df.where(F.col("side") == "ref").select(*names))
    current = df.where(F.col("side") == "cur")
    half = F.substring("id", -1, 1).cast("int") % 2
    base = work_path(spark, "stream")
    for i in range(2):
        current.where(half == i).select(*names).write.mode("append").parquet(f"{base}/in")
        arriving = spark.readStream.schema(current.select(*names).schema).parquet(f"{base}/in")
        drift_stream.stream_drift(reference, arriving, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return rounded(drift_stream.drift_history(spark, f"{base}/out"))
