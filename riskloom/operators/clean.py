"""Row filters and typed projections of the raw loan table.

Every rule looks at ``df.columns`` first: a column that is not there skips its rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import parse
from riskloom.schema import (
    DATE_NAME_PARTS,
    EXTRA_DATE_COLUMNS,
    MAX_LOAN_AMOUNT,
    MIN_LOAN_AMOUNT,
    PERCENT_COLUMNS,
    TARGET,
    is_string,
    is_timestamp,
    numeric_columns,
    string_columns,
)


def drop_null_target(df: DataFrame, target: str = TARGET) -> DataFrame:
    return df.na.drop(subset=[target]) if target in df.columns else df


def binary_target(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Status text -> 1 / 0; rows with any other status are dropped."""
    if target not in df.columns:
        return df
    return df.withColumn(target, parse.default_flag(F.col(target))).na.drop(subset=[target])


def amount_range(
    df: DataFrame, low: float = MIN_LOAN_AMOUNT, high: float = MAX_LOAN_AMOUNT, column: str = "loan_amnt"
) -> DataFrame:
    """Both ends belong to the range; a null amount is dropped."""
    return df.where(F.col(column).between(low, high)) if column in df.columns else df


def row_drop_audit(
    df: DataFrame,
    low: float = MIN_LOAN_AMOUNT,
    high: float = MAX_LOAN_AMOUNT,
    target: str = TARGET,
    amount: str = "loan_amnt",
) -> DataFrame:
    """Rows each filter removes, in rule order, counted in one pass over the table."""
    status = F.col(target)
    flag = parse.default_flag(status)
    in_range = F.coalesce(F.col(amount).between(low, high), F.lit(False))
    counts = df.agg(
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(status.isNull()).alias("null_target"),
        F.count_if(status.isNotNull() & flag.isNull()).alias("unmapped_target"),
        F.count_if(flag.isNotNull() & ~in_range).alias("amount_out_of_range"),
        F.count_if(flag.isNotNull() & in_range).alias("output_rows"),
    )
    return counts.unpivot([], counts.columns, "rule", "n_rows")


def parse_failures(df: DataFrame) -> DataFrame:
    """Values that are present as text but that the typed rules cannot read, per column."""
    rules: dict[str, Column] = {c: parse.percent(F.col(c)) for c in PERCENT_COLUMNS if is_string(df, c)}
    if is_string(df, "term"):
        rules["term"] = parse.term_months(F.col("term"))
    for c in date_columns(df):
        rules[c] = parse.any_date(F.col(c))
    if not rules:
        return df.sparkSession.createDataFrame([], "column string, n_unreadable bigint")
    counts = df.agg(*[F.count_if(F.col(c).isNotNull() & e.isNull()).alias(c) for c, e in rules.items()])
    return counts.unpivot([], list(rules), "column", "n_unreadable")


def _replace(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    return df.withColumns(rules) if rules else df


def parse_percent(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    names = PERCENT_COLUMNS if columns is None else columns
    return _replace(df, {c: parse.percent(F.col(c)) for c in names if is_string(df, c)})


def parse_term(df: DataFrame, column: str = "term") -> DataFrame:
    return _replace(df, {column: parse.term_months(F.col(column))} if is_string(df, column) else {})


def map_emp_length(df: DataFrame, column: str = "emp_length") -> DataFrame:
    return _replace(df, {column: parse.employment_years(F.col(column))} if is_string(df, column) else {})


def date_columns(df: DataFrame) -> list[str]:
    """String columns that hold dates, by name."""
    named = [c for c in string_columns(df) if any(part in c.lower() for part in DATE_NAME_PARTS)]
    return named + [c for c in EXTRA_DATE_COLUMNS if is_string(df, c) and c not in named]


def parse_dates(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    names = date_columns(df) if columns is None else [c for c in columns if is_string(df, c)]
    return _replace(df, {c: parse.any_date(F.col(c)) for c in names})


def issue_parts(df: DataFrame, column: str = "issue_d") -> DataFrame:
    if not is_timestamp(df, column):
        return df
    return df.withColumns({"issue_year": F.year(column), "issue_month": F.month(column)})


def credit_history_years(df: DataFrame, as_of: str, column: str = "earliest_cr_line") -> DataFrame:
    """``as_of`` is an argument, so that the same input always gives the same table."""
    if not is_timestamp(df, column):
        return df
    return df.withColumn("credit_history_years", parse.years_before(as_of, F.col(column)))


def clean(
    df: DataFrame, as_of: str, low: float = MIN_LOAN_AMOUNT, high: float = MAX_LOAN_AMOUNT, target: str = TARGET
) -> DataFrame:
    """All cleaning rules in order; Catalyst fuses them into one filter and one projection."""
    return clean_features(amount_range(binary_target(drop_null_target(df, target), target), low, high), as_of)


def clean_features(df: DataFrame, as_of: str) -> DataFrame:
    """The rules for columns alone: every row stays, and a label is not needed."""
    df = map_emp_length(parse_term(parse_percent(df)))
    return credit_history_years(issue_parts(parse_dates(df)), as_of)


def split_xy(df: DataFrame, target: str = TARGET) -> tuple[DataFrame, DataFrame]:
    """Features and label as two projections of the same rows."""
    return df.drop(target), df.select(target)


def select_by_type(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Which columns count as numeric and which as string; the target is left out of the numeric ones."""
    rows = [(i, c, "numeric") for i, c in enumerate(c for c in numeric_columns(df) if c != target)]
    rows += [(i, c, "categorical") for i, c in enumerate(string_columns(df))]
    return df.sparkSession.createDataFrame(rows, "position int, column string, kind string")
