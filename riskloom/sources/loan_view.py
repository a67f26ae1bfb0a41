"""The flat loan table over the order tables: one loan per line item."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import spread

# column -> the table it needs beside lineitem
_NEEDS = {
    "home_ownership": "customer",
    "annual_inc": "customer",
    "earliest_cr_line": "orders",
    "revol_bal": "orders",
    "purpose": "part",
    "addr_state": "nation",
}


def _columns() -> dict[str, Column]:
    c = F.col
    amount = c("l_extendedprice") * F.lit(0.45)
    status = F.concat("l_returnflag", "l_linestatus")
    quantity = c("l_quantity").cast("int") % 4
    key = F.concat_ws("-", *[c(k).cast("string") for k in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])
    return {
        "id": key,
        "loan_amnt": amount,
        "term": F.when(c("l_linenumber") <= 4, " 36 months").otherwise(" 60 months"),
        "int_rate": F.concat(F.round((c("l_discount") + 0.05) * 100).cast("int").cast("string"), F.lit(".5%")),
        "installment": amount / 36 * 1.1,
        "grade": F.substring(F.lit("ABCDEFG"), (c("l_partkey") % 7).cast("int") + 1, F.lit(1)),
        "emp_length": F.when(quantity == 0, "< 1 year")
        .when(quantity == 1, "5 years")
        .when(quantity == 2, "10+ years")
        .otherwise("n/a"),
        "home_ownership": c("c_mktsegment"),
        "annual_inc": F.when(c("c_acctbal") >= -500, c("c_acctbal") * 10 + 20000),
        "issue_d": c("l_shipdate").cast("date").cast("string"),
        "earliest_cr_line": c("o_orderdate").cast("date").cast("string"),
        "loan_status": F.when(status == "RF", "Charged Off")
        .when(status == "RO", "Late (31-120 days)")
        .when(status == "AF", "Fully Paid")
        .when(status == "AO", "Current")
        .when(status == "NO", "In Grace Period"),
        "purpose": c("p_type"),
        "addr_state": c("n_name"),
        "dti": F.when(c("l_quantity") != 13, c("l_quantity") * 0.8),
        "delinq_2yrs": c("l_suppkey") % 4,
        "revol_util": F.when(
            c("l_suppkey") % 9 != 0, F.concat(F.round(c("l_tax") * 1000).cast("int").cast("string"), F.lit(".0%"))
        ),
        "open_acc": c("l_linenumber") + 2,
        "pub_rec": F.when(c("l_partkey") % 10 == 0, 1).otherwise(0),
        "revol_bal": c("o_totalprice") / 10,
        "total_acc": c("l_linenumber") + 10 + c("l_suppkey") % 20,
        "side": F.when(c("l_shipdate").cast("date") < F.lit("1998-07-01").cast("date"), "ref").otherwise("cur"),
        "score_milli": (c("l_partkey") * 7919 + c("l_orderkey") * 104729 + c("l_linenumber") * 31) % 1000,
    }


def loans(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    """The loan table, or some columns of it.

    A line item belongs to exactly one order, customer, nation and part, so a table is joined only when one of
    its columns is asked for. Which join runs (broadcast or shuffled) is left to the optimizer and AQE.
    """
    exprs = _columns()
    wanted = list(exprs) if columns is None else columns
    needs = {_NEEDS[c] for c in wanted if c in _NEEDS}
    if "nation" in needs:
        needs.add("customer")
    if "customer" in needs:
        needs.add("orders")

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    df = spread(table("lineitem"))
    if "orders" in needs:
        df = df.join(table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    if "customer" in needs:
        df = df.join(table("customer"), F.col("o_custkey") == F.col("c_custkey"))
    if "nation" in needs:
        df = df.join(table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    if "part" in needs:
        df = df.join(table("part"), F.col("l_partkey") == F.col("p_partkey"))
    return df.select(*[exprs[c].alias(c) for c in wanted])


def scored_loans(spark: SparkSession, sf_dir: str, extra: list[str] | None = None) -> DataFrame:
    """Cleaned loans with the label and a score ``p`` that follows from the keys and the label, with many ties."""
    from riskloom.operators import clean

    keep = ["loan_status", *(extra or [])]
    raw = loans(spark, sf_dir, list(dict.fromkeys([*keep, "loan_amnt", "score_milli"])))
    df = clean.amount_range(clean.binary_target(raw))
    p = (F.col("score_milli") * 7 + F.col("loan_status") * 3000) / F.lit(10000.0)
    return df.select(*keep, p.alias("p"))
