"""Column names, fixed values and type dispatch of the loan table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# --- fixed values: the domain's own labels, formats and column names ---------------------------

TARGET = "loan_status"

BAD_STATUS = [
    "Charged Off",
    "Default",
    "Late (31-120 days)",
    "Late (16-30 days)",
    "Does not meet the credit policy. Status:Charged Off",
]
GOOD_STATUS = [
    "Fully Paid",
    "Current",
    "Does not meet the credit policy. Status:Fully Paid",
]

EMP_LENGTH_YEARS = {
    "< 1 year": 0,
    "1 year": 1,
    "2 years": 2,
    "3 years": 3,
    "4 years": 4,
    "5 years": 5,
    "6 years": 6,
    "7 years": 7,
    "8 years": 8,
    "9 years": 9,
    "10+ years": 10,
}

PERCENT_COLUMNS = ["int_rate", "revol_util"]
DATE_FORMATS = ["MMM-yyyy", "yyyy-MM-dd", "MM/dd/yyyy", "dd-MMM-yyyy"]
DATE_NAME_PARTS = ["date", "time"]
EXTRA_DATE_COLUMNS = ["issue_d", "earliest_cr_line"]

MIN_LOAN_AMOUNT = 1000.0
MAX_LOAN_AMOUNT = 40000.0

ORDINAL_COLUMNS = ["grade", "sub_grade", "addr_state", "zip_code"]

LOAN_COLUMNS = """
id member_id loan_amnt funded_amnt funded_amnt_inv term int_rate installment grade sub_grade emp_title
emp_length home_ownership annual_inc verification_status issue_d loan_status pymnt_plan url desc purpose
title zip_code addr_state dti delinq_2yrs earliest_cr_line inq_last_6mths mths_since_last_delinq
mths_since_last_record open_acc pub_rec revol_bal revol_util total_acc initial_list_status out_prncp
out_prncp_inv total_pymnt total_pymnt_inv total_rec_prncp total_rec_int total_rec_late_fee recoveries
collection_recovery_fee last_pymnt_d last_pymnt_amnt next_pymnt_d last_credit_pull_d
collections_12_mths_ex_med mths_since_last_major_derog policy_code application_type annual_inc_joint
dti_joint verification_status_joint acc_now_delinq tot_coll_amt tot_cur_bal open_acc_6m open_act_il
open_il_12m open_il_24m mths_since_rcnt_il total_bal_il il_util open_rv_12m open_rv_24m max_bal_bc
all_util total_rev_hi_lim inq_fi total_cu_tl inq_last_12m acc_open_past_24mths avg_cur_bal
bc_open_to_buy bc_util chargeoff_within_12_mths delinq_amnt mo_sin_old_il_acct mo_sin_old_rev_tl_op
mo_sin_rcnt_rev_tl_op mo_sin_rcnt_tl mort_acc mths_since_recent_bc mths_since_recent_bc_dlq
mths_since_recent_inq mths_since_recent_revol_delinq num_accts_ever_120_pd num_actv_bc_tl
num_actv_rev_tl num_bc_sats num_bc_tl num_il_tl num_op_rev_tl num_rev_accts num_rev_tl_bal_gt_0
num_sats num_tl_120dpd_2m num_tl_30dpd num_tl_90g_dpd_24m num_tl_op_past_12m pct_tl_nvr_dlq
percent_bc_gt_75 pub_rec_bankruptcies tax_liens tot_hi_cred_lim total_bal_ex_mort total_bc_limit
total_il_high_credit_limit revol_bal_joint sec_app_earliest_cr_line sec_app_inq_last_6mths
sec_app_mort_acc sec_app_open_acc sec_app_revol_util sec_app_open_act_il sec_app_num_rev_accts
sec_app_chargeoff_within_12_mths sec_app_collections_12_mths_ex_med
sec_app_mths_since_last_major_derog hardship_flag hardship_type hardship_reason hardship_status
deferral_term hardship_amount hardship_start_date hardship_end_date payment_plan_start_date
hardship_length hardship_dpd hardship_loan_status orig_projected_additional_accrued_interest
hardship_payoff_balance_amount hardship_last_payment_amount debt_settlement_flag
debt_settlement_flag_date settlement_status settlement_date settlement_amount settlement_percentage
settlement_term
""".split()

# --- end of fixed values -----------------------------------------------------------------------


def string_schema(names: list[str]) -> T.StructType:
    """Raw files are read as strings; typed columns come from the cleaning rules."""
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.CharType, T.VarcharType))]


def is_string(df: DataFrame, name: str) -> bool:
    return name in df.columns and name in string_columns(df)


def is_timestamp(df: DataFrame, name: str) -> bool:
    return name in df.columns and isinstance(
        df.schema[name].dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)
    )
