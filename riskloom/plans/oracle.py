"""The same queries as plain SQL over the same tables, for an independent engine."""

from __future__ import annotations

AS_OF = "2005-01-01"
SEED = 42
LOW, HIGH = 1000, 40000
NUMERIC = [
    "loan_amnt", "term", "int_rate", "installment", "emp_length", "annual_inc", "dti", "delinq_2yrs",
    "revol_util", "open_acc", "pub_rec", "revol_bal", "total_acc",
]
CATEGORICAL = ["grade", "home_ownership", "purpose", "addr_state"]

RAW = """
SELECT concat(cast(l_orderkey AS string),'-',cast(l_linenumber AS string),'-',
              cast(l_partkey AS string),'-',cast(l_suppkey AS string))          AS id,
       l_extendedprice*0.45                                                     AS loan_amnt,
       CASE WHEN l_linenumber<=4 THEN ' 36 months' ELSE ' 60 months' END        AS term,
       concat(cast(cast(round((l_discount+0.05)*100) AS int) AS string),'.5%')  AS int_rate,
       l_extendedprice*0.45/36*1.1                                              AS installment,
       substr('ABCDEFG',cast(l_partkey%7 AS int)+1,1)                           AS grade,
       CASE cast(l_quantity AS int)%4 WHEN 0 THEN '< 1 year' WHEN 1 THEN '5 years'
            WHEN 2 THEN '10+ years' ELSE 'n/a' END                              AS emp_length,
       c_mktsegment                                                             AS home_ownership,
       CASE WHEN c_acctbal>=-500 THEN c_acctbal*10+20000 END                    AS annual_inc,
       cast(cast(l_shipdate AS date) AS string)                                 AS issue_d,
       cast(cast(o_orderdate AS date) AS string)                                AS earliest_cr_line,
       CASE concat(l_returnflag,l_linestatus) WHEN 'RF' THEN 'Charged Off'
            WHEN 'RO' THEN 'Late (31-120 days)' WHEN 'AF' THEN 'Fully Paid'
            WHEN 'AO' THEN 'Current' WHEN 'NO' THEN 'In Grace Period' END       AS loan_status,
       p_type                                                                   AS purpose,
       n_name                                                                   AS addr_state,
       CASE WHEN l_quantity<>13 THEN l_quantity*0.8 END                         AS dti,
       l_suppkey%4                                                              AS delinq_2yrs,
       CASE WHEN l_suppkey%9<>0 THEN
            concat(cast(cast(round(l_tax*1000) AS int) AS string),'.0%') END    AS revol_util,
       l_linenumber+2                                                           AS open_acc,
       CASE WHEN l_partkey%10=0 THEN 1 ELSE 0 END                               AS pub_rec,
       o_totalprice/10                                                          AS revol_bal,
       l_linenumber+10+l_suppkey%20                                             AS total_acc,
       CASE WHEN l_shipdate < TIMESTAMP '1998-07-01 00:00:00' THEN 'ref' ELSE 'cur' END AS side,
       (l_partkey*7919+l_orderkey*104729+l_linenumber*31)%1000                  AS score_milli
FROM lineitem JOIN orders ON l_orderkey=o_orderkey JOIN customer ON o_custkey=c_custkey
     JOIN part ON l_partkey=p_partkey JOIN nation ON c_nationkey=n_nationkey
"""

FLAG = """CASE WHEN loan_status IN ('Charged Off','Default','Late (31-120 days)','Late (16-30 days)',
  'Does not meet the credit policy. Status:Charged Off') THEN 1
  WHEN loan_status IN ('Fully Paid','Current','Does not meet the credit policy. Status:Fully Paid') THEN 0 END"""

YEARS = """CASE emp_length WHEN '< 1 year' THEN 0 WHEN '1 year' THEN 1 WHEN '2 years' THEN 2 WHEN '3 years' THEN 3
  WHEN '4 years' THEN 4 WHEN '5 years' THEN 5 WHEN '6 years' THEN 6 WHEN '7 years' THEN 7 WHEN '8 years' THEN 8
  WHEN '9 years' THEN 9 WHEN '10+ years' THEN 10 END"""


def _date(c: str) -> str:
    formats = ["%b-%Y", "%Y-%m-%d", "%m/%d/%Y", "%d-%b-%Y"]
    return "coalesce(" + ", ".join(f"try_strptime({c},'{f}')" for f in formats) + ")"


def _percent(c: str) -> str:
    return f"try_cast(rtrim({c},'%') AS DOUBLE)/100::DOUBLE"


TERM = "try_cast(replace(trim(term),' months','') AS INT)"

CLEAN = f"""
SELECT id, {FLAG} AS loan_status, loan_amnt, {TERM} AS term, {_percent('int_rate')} AS int_rate, installment, grade,
       {YEARS} AS emp_length, home_ownership, annual_inc, purpose, addr_state, dti, delinq_2yrs,
       {_percent('revol_util')} AS revol_util, open_acc, pub_rec, revol_bal, total_acc, side, score_milli
FROM raw WHERE {FLAG} IS NOT NULL AND loan_amnt BETWEEN {LOW} AND {HIGH}
"""

BASE = f"WITH raw AS ({RAW}), clean AS ({CLEAN})"
SCORED = f"""{BASE}, scored AS (
  SELECT loan_status AS y, side, (score_milli*7 + loan_status*3000)::DOUBLE/10000::DOUBLE AS p FROM clean)"""


def _raw(select: str) -> str:
    return f"WITH raw AS ({RAW}) {select}"


def _clean(select: str) -> str:
    return f"{BASE} {select}"


def _scored(select: str) -> str:
    return f"{SCORED} {select}"


def _long(columns: list[str], source: str = "clean", keep: str = "", casts: str = "DOUBLE") -> str:
    cells = ", ".join(f"CAST({c} AS {casts}) AS {c}" for c in columns)
    names = ", ".join(columns)
    return f"""(SELECT * FROM (SELECT {keep + ', ' if keep else ''}{cells} FROM {source})
      UNPIVOT INCLUDE NULLS (value FOR feature IN ({names})))"""


def _r(expr: str, name: str, digits: int = 6) -> str:
    return f"round({expr}, {digits}) AS {name}"


# --- confusion cells and ranking --------------------------------------------------------------

CELLS = """cells AS (SELECT count(*) FILTER (y=0 AND p<0.5::DOUBLE) AS tn, count(*) FILTER (y=0 AND p>=0.5::DOUBLE) AS fp,
  count(*) FILTER (y=1 AND p<0.5::DOUBLE) AS fn, count(*) FILTER (y=1 AND p>=0.5::DOUBLE) AS tp FROM scored)"""


def _div(a: str, b: str) -> str:
    return f"coalesce(({a})::DOUBLE / nullif(({b})::DOUBLE, 0), 0)"


ACCURACY, PRECISION = _div("tp+tn", "tp+tn+fp+fn"), _div("tp", "tp+fp")
RECALL, F1 = _div("tp", "tp+fn"), _div("2*tp", "2*tp+fp+fn")

RANKED = """freq AS (SELECT p, count(*) FILTER (y=1) AS pos, count(*) FILTER (y=0) AS neg FROM scored GROUP BY p),
 ranked AS (SELECT *, sum(pos) OVER (ORDER BY p DESC)::DOUBLE AS tp, sum(neg) OVER (ORDER BY p DESC)::DOUBLE AS fp,
   sum(pos) OVER ()::DOUBLE AS np, sum(neg) OVER ()::DOUBLE AS nn FROM freq)"""
AUC = "sum(pos*((nn-fp) + neg/2::DOUBLE))/(max(np)*max(nn))"
AP = "sum(pos/np * tp/(tp+fp))"


def _side_metrics(alias: str) -> str:
    """Long metrics of both sides, the current scores shifted as in the Spark query."""
    return f"""{BASE}, scored AS (SELECT side, loan_status AS y,
      (score_milli*7 + loan_status*3000)::DOUBLE/10000::DOUBLE
        - CASE WHEN side='cur' THEN loan_status*0.06::DOUBLE ELSE 0::DOUBLE END AS p FROM clean),
    cells AS (SELECT side, count(*) FILTER (y=0 AND p<0.5::DOUBLE) AS tn, count(*) FILTER (y=0 AND p>=0.5::DOUBLE) AS fp,
      count(*) FILTER (y=1 AND p<0.5::DOUBLE) AS fn, count(*) FILTER (y=1 AND p>=0.5::DOUBLE) AS tp FROM scored GROUP BY side),
    freq AS (SELECT side, p, count(*) FILTER (y=1) AS pos, count(*) FILTER (y=0) AS neg FROM scored GROUP BY side, p),
    ranked AS (SELECT *, sum(neg) OVER (PARTITION BY side ORDER BY p DESC)::DOUBLE AS fp,
      sum(pos) OVER (PARTITION BY side)::DOUBLE AS np, sum(neg) OVER (PARTITION BY side)::DOUBLE AS nn FROM freq),
    aucs AS (SELECT side, {AUC} AS auc FROM ranked GROUP BY side),
    wide AS (SELECT side, {ACCURACY} AS accuracy, {PRECISION} AS "precision", {RECALL} AS recall, {F1} AS f1, auc
      FROM cells JOIN aucs USING (side)),
    {alias} AS (SELECT * FROM wide UNPIVOT (value FOR metric IN (accuracy, "precision", recall, f1, auc))),
    pairs AS (SELECT r.metric, r.value AS reference, c.value AS current, c.value-r.value AS difference
      FROM {alias} r JOIN {alias} c ON r.metric=c.metric AND r.side='ref' AND c.side='cur')"""


# --- importance --------------------------------------------------------------------------------


def _importance(source: str, name: str) -> str:
    cells = ", ".join(f"abs(corr({c}::DOUBLE, loan_status::DOUBLE)) AS {c}" for c in NUMERIC)
    return f"""{name}_wide AS (SELECT {cells} FROM {source}),
    {name}_long AS (SELECT feature, CASE WHEN isnan(importance) THEN 0 ELSE coalesce(importance,0) END AS importance
      FROM (SELECT * FROM {name}_wide UNPIVOT INCLUDE NULLS (importance FOR feature IN ({', '.join(NUMERIC)})))),
    {name} AS (SELECT feature, importance, importance / sum(importance) OVER () * 100 AS relative_importance
      FROM {name}_long)"""


# --- drift -------------------------------------------------------------------------------------

SHIFTED = "(SELECT * REPLACE (CASE WHEN side='cur' THEN loan_amnt*1.3::DOUBLE ELSE loan_amnt END AS loan_amnt) FROM clean)"
NO_CURRENT_UTIL = f"(SELECT * REPLACE (CASE WHEN side='ref' THEN revol_util END AS revol_util) FROM {SHIFTED})"
SHIFTED_NUMERIC = [c for c in NUMERIC if c != "open_acc"]


def _distances(columns: list[str], source: str = "clean") -> str:
    return f"""long AS (SELECT * FROM {_long(columns, source, 'side')} WHERE value IS NOT NULL),
    freq AS (SELECT feature, value, count(*) FILTER (side='ref') AS r, count(*) FILTER (side='cur') AS c
      FROM long GROUP BY feature, value),
    cdf AS (SELECT feature, value, r,
      sum(r) OVER w / sum(r) OVER (PARTITION BY feature)::DOUBLE AS fr,
      sum(c) OVER w / sum(c) OVER (PARTITION BY feature)::DOUBLE AS fc,
      lead(value) OVER (PARTITION BY feature ORDER BY value) AS nxt
      FROM freq WINDOW w AS (PARTITION BY feature ORDER BY value)),
    dist AS (SELECT feature, max(abs(fr-fc)) AS ks, coalesce(sum(abs(fr-fc)*(nxt-value)), 0) AS w,
      max(value) FILTER (r>0) - min(value) FILTER (r>0) AS rng FROM cdf GROUP BY feature),
    norm AS (SELECT feature, ks, w, CASE WHEN rng>0 THEN w/rng ELSE 0 END AS wn FROM dist)"""


def _top(columns: list[str], source: str = "clean") -> str:
    return f"""cats AS (SELECT * FROM {_long(columns, source, 'side', 'VARCHAR')} WHERE value IS NOT NULL),
    catn AS (SELECT side, feature, value, count(*) AS n FROM cats GROUP BY ALL),
    catf AS (SELECT *, n / sum(n) OVER (PARTITION BY side, feature)::DOUBLE AS f,
      row_number() OVER (PARTITION BY side, feature ORDER BY n DESC, value) AS rn FROM catn),
    catp AS (SELECT coalesce(a.feature, b.feature) AS feature, coalesce(a.value, b.value) AS value,
      coalesce(a.f, 0) AS rf, coalesce(b.f, 0) AS cf
      FROM (SELECT * FROM catf WHERE side='ref' AND rn<=10) a
      FULL OUTER JOIN (SELECT * FROM catf WHERE side='cur' AND rn<=10) b
        ON a.feature=b.feature AND a.value=b.value),
    catd AS (SELECT feature, least(sum(abs(rf-cf))/2, 1) AS drift_score FROM catp GROUP BY feature)"""


def _feature_drift(threshold: float = 0.1) -> str:
    return f"""{_distances(SHIFTED_NUMERIC, SHIFTED)}, {_top(CATEGORICAL)},
    scores AS (
      SELECT feature, 'numeric' AS kind, least(0.4::DOUBLE*wn + 0.6::DOUBLE*ks, 1) AS drift_score FROM norm
      UNION ALL SELECT feature, 'categorical', drift_score FROM catd
      UNION ALL SELECT 'open_acc', 'type', 1::DOUBLE),
    drift AS (SELECT *, drift_score > {threshold}::DOUBLE AS drifted FROM scores)"""


def _split(stratum: str) -> str:
    """Exact split by row number over the hash, with largest-remainder quotas per stratum."""

    def quota(n: str, share: float, out: str, source: str) -> str:
        return f"""{out}_a AS (SELECT stratum, {n} AS n, {n}::DOUBLE / sum({n}) OVER ()
            * ceil(sum({n}) OVER ()::DOUBLE * {share}::DOUBLE) AS exact,
            ceil(sum({n}) OVER ()::DOUBLE * {share}::DOUBLE) AS target FROM {source}),
          {out}_b AS (SELECT *, floor(exact) AS low, row_number() OVER (ORDER BY exact-floor(exact) DESC, stratum) AS rn,
            target - sum(floor(exact)) OVER () AS short FROM {out}_a),
          {out} AS (SELECT stratum, n, (low + CASE WHEN rn<=short THEN 1 ELSE 0 END)::BIGINT AS k FROM {out}_b)"""

    return f"""hashed AS (SELECT *, {stratum} AS stratum, md5(concat('{SEED}','|',id)) AS h FROM clean),
    sizes AS (SELECT stratum, count(*) AS n FROM hashed GROUP BY stratum),
    {quota('n', 0.2, 'qt', 'sizes')},
    rest AS (SELECT stratum, n-k AS m FROM qt),
    {quota('m', 0.25, 'qv', 'rest')},
    numbered AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY h) AS place FROM hashed),
    parts AS (SELECT x.*, CASE WHEN place<=qt.k THEN 'test' WHEN place<=qt.k+qv.k THEN 'val' ELSE 'train' END AS split
      FROM numbered x JOIN qt ON x.stratum=qt.stratum JOIN qv ON x.stratum=qv.stratum)"""


def _scaled(columns: list[str], centre: str, width: str) -> str:
    fitted = ", ".join(f"{centre.format(c)} AS {c}_a, {width.format(c)} AS {c}_b" for c in columns)
    cells = ", ".join(
        _r(f"({c}::DOUBLE - {c}_a) / CASE WHEN {c}_b=0 THEN 1 ELSE {c}_b END", c) for c in columns
    )
    return _clean(f", fitted AS (SELECT {fitted} FROM clean) SELECT id, {cells} FROM clean, fitted")


def _power_transform(value: str, power: str) -> str:
    return (
        f"CASE WHEN {value} >= 0 THEN CASE WHEN {power} = 0 THEN ln(1 + {value}) ELSE (pow({value} + 1, {power}) - 1) / {power} END "
        f"ELSE CASE WHEN {power} = 2 THEN -ln(1 - {value}) ELSE -(pow(1 - {value}, 2 - {power}) - 1) / (2 - {power}) END END"
    )


def _likeliest_powers(columns: list[str]) -> str:
    """The best power in thousandths per column, from three grids that narrow: (-32, 32), then 32 cells around the best."""
    vals = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {c}::DOUBLE AS value, count(*)::DOUBLE AS n FROM clean WHERE {c} IS NOT NULL GROUP BY 2"
        for c in columns
    )
    out = f"""
    , vals AS MATERIALIZED ({vals}),
    sums AS MATERIALIZED (SELECT feature, sum(n) AS total, sum(n * value) / sum(n) AS mean,
        sum(n * sign(value) * ln(1 + abs(value))) AS log_sum FROM vals GROUP BY 1),
    best0 AS (SELECT feature, 0 AS step FROM sums)"""
    for i, (low, high, width) in enumerate([(-32000, 32000, 250), (-256, 256, 16), (-16, 16, 1)]):
        shifted = f"({_power_transform('value', 'power')}) - ({_power_transform('mean', 'power')})"
        out += f""",
    grid{i} AS (SELECT feature, step + g.range AS step, (step + g.range) / 1000.0::DOUBLE AS power
        FROM best{i}, range({low}, {high + 1}, {width}) g),
    tried{i} AS (SELECT feature, step, power, total, log_sum, n, {shifted} AS t
        FROM grid{i} JOIN sums USING (feature) JOIN vals USING (feature)),
    scored{i} AS (SELECT feature, step, any_value(power) AS power, any_value(total) AS total, any_value(log_sum) AS log_sum,
        (sum(n * t * t) - sum(n * t) * sum(n * t) / any_value(total)) / any_value(total) AS var FROM tried{i} GROUP BY 1, 2),
    best{i + 1} AS MATERIALIZED (SELECT feature, arg_max(step, -total / 2 * ln(var) + (power - 1) * log_sum) AS step
        FROM scored{i} WHERE var > 0 AND isfinite(var) GROUP BY 1)"""
    return out


def _build() -> dict[str, str]:
    out: dict[str, str] = {}
    scaled = NUMERIC
    gaps = ["annual_inc", "dti", "revol_util"]

    # sources
    out["scan_loan_csv"] = _raw(
        """SELECT id, term, int_rate, grade, issue_d, loan_status, NULL::VARCHAR AS settlement_term FROM raw
        UNION ALL SELECT 'Total rows in the file: ' || count(*)::VARCHAR, NULL, NULL, NULL, NULL, NULL, NULL FROM raw"""
    )
    out["drop_note_rows"] = _raw("SELECT id, grade, loan_amnt FROM raw")
    out["scan_table"] = _raw("SELECT id, loan_amnt FROM raw")
    out["sink_table"] = _raw("SELECT count(*) AS n_rows, 2 AS last_version, 1 AS n_versions FROM raw")

    # filters
    out["drop_null_target"] = _raw("SELECT id, loan_status FROM raw WHERE loan_status IS NOT NULL")
    out["binary_target"] = _raw(f"SELECT id, {FLAG} AS loan_status FROM raw WHERE {FLAG} IS NOT NULL")
    out["amount_range"] = _raw(f"SELECT id, loan_amnt FROM raw WHERE loan_amnt >= {LOW} AND loan_amnt <= {HIGH}")
    inside = f"coalesce(loan_amnt BETWEEN {LOW} AND {HIGH}, false)"
    out["row_drop_audit"] = _raw(
        f""", flagged AS (SELECT loan_status, loan_amnt, {FLAG} AS y FROM raw),
        n AS (SELECT count(*) AS input_rows, count(*) FILTER (loan_status IS NULL) AS null_target,
          count(*) FILTER (loan_status IS NOT NULL AND y IS NULL) AS unmapped_target,
          count(*) FILTER (y IS NOT NULL AND NOT {inside}) AS amount_out_of_range,
          count(*) FILTER (y IS NOT NULL AND {inside}) AS output_rows FROM flagged)
        SELECT * FROM n UNPIVOT (n_rows FOR rule IN
          (input_rows, null_target, unmapped_target, amount_out_of_range, output_rows))"""
    )
    out["split_xy"] = _clean(
        """SELECT loan_status, count(*) AS n_rows, (SELECT count(*) FROM clean) AS x_rows, 3 AS x_columns
        FROM clean GROUP BY loan_status"""
    )

    # scalar functions
    out["parse_percent"] = _raw(
        f"SELECT id, {_percent('int_rate')} AS int_rate, {_percent('revol_util')} AS revol_util FROM raw"
    )
    out["parse_term"] = _raw(f"SELECT id, {TERM} AS term FROM raw")
    out["map_emp_length"] = _raw(f"SELECT id, {YEARS} AS emp_length FROM raw")
    shown = ", ".join(f"strftime({_date(c)}, '%Y-%m-%d %H:%M:%S') AS {c}" for c in ("issue_d", "earliest_cr_line"))
    out["parse_dates"] = _raw(f"SELECT id, {shown} FROM raw")
    out["issue_parts"] = _raw(
        f"SELECT id, year({_date('issue_d')})::INT AS issue_year, month({_date('issue_d')})::INT AS issue_month FROM raw"
    )
    out["credit_history_years"] = _raw(
        f"""SELECT id, (DATE '{AS_OF}' - {_date('earliest_cr_line')}::DATE)::DOUBLE/365.25::DOUBLE
        AS credit_history_years FROM raw"""
    )

    # derived features
    out["ratio_features"] = _clean(
        """SELECT id, loan_amnt/nullif(annual_inc+1,0) AS loan_to_income,
          installment*12/nullif(annual_inc+1,0) AS installment_to_income,
          revol_bal/nullif(annual_inc+1,0) AS revol_bal_to_income,
          revol_bal/nullif(total_acc+1,0)::DOUBLE AS debt_to_credit_lines,
          revol_util/nullif(open_acc+1,0)::DOUBLE AS util_per_account,
          installment/nullif(loan_amnt+1,0) AS payment_to_loan FROM clean"""
    )
    out["interaction_features"] = _clean(
        """SELECT id, dti*int_rate AS dti_x_int_rate, loan_amnt*term AS loan_amnt_x_term,
          revol_util*total_acc AS revol_util_x_total_acc FROM clean"""
    )
    out["squared_features"] = _clean(
        "SELECT id, dti*dti AS dti_squared, revol_util*revol_util AS revol_util_squared, "
        "int_rate*int_rate AS int_rate_squared FROM clean"
    )
    risk = ["dti", "delinq_2yrs", "revol_util", "pub_rec"]
    bounds = ", ".join(f"min({c})::DOUBLE AS {c}_a, max({c})::DOUBLE AS {c}_b" for c in risk)
    terms = " + ".join(
        f"({c}::DOUBLE-{c}_a)/CASE WHEN {c}_b>{c}_a THEN {c}_b-{c}_a ELSE 1 END" for c in risk
    )
    out["composite_risk_score"] = _clean(
        f", b AS (SELECT {bounds} FROM clean) SELECT id, ({terms})/4::DOUBLE AS composite_risk_score FROM clean, b"
    )

    # imputation, scaling, encoding
    chosen = ", ".join(f"max(step) FILTER (feature = '{c}') / 1000.0::DOUBLE AS {c}_p" for c in NUMERIC)
    moved = ", ".join(f"{_power_transform(c + '::DOUBLE', c + '_p')} AS {c}" for c in NUMERIC)
    fits = ", ".join(f"avg({c}) AS {c}_a, stddev_pop({c}) AS {c}_b" for c in NUMERIC)
    cells = ", ".join(_r(f"({c} - {c}_a) / CASE WHEN {c}_b=0 THEN 1 ELSE {c}_b END", c) for c in NUMERIC)
    out["scale_yeo_johnson"] = _clean(
        f"""{_likeliest_powers(NUMERIC)}, chosen AS (SELECT {chosen} FROM best3),
        moved AS MATERIALIZED (SELECT id, {moved} FROM clean, chosen), fits AS (SELECT {fits} FROM moved)
        SELECT id, {cells} FROM moved, fits"""
    )
    for name, fit in (("impute_mean", "avg({0})"), ("impute_median", "quantile_cont({0}, 0.5)")):
        fitted = ", ".join(f"{fit.format(c)} AS {c}_f" for c in gaps)
        cells = ", ".join(_r(f"coalesce({c}, {c}_f)", c) for c in gaps)
        out[name] = _clean(f", f AS (SELECT {fitted} FROM clean) SELECT id, {cells} FROM clean, f")
    modes = ["loan_status", "grade", "revol_util"]
    picks = ", ".join(
        f"(SELECT {c} FROM raw WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS {c}_f"
        for c in modes
    )
    cells = ", ".join(f"coalesce({c}, {c}_f) AS {c}" for c in modes)
    out["impute_mode"] = _raw(f", f AS (SELECT {picks}) SELECT id, {cells} FROM raw, f")
    out["scale_robust"] = _scaled(
        scaled, "quantile_cont({0}::DOUBLE, 0.5)", "(quantile_cont({0}::DOUBLE,0.75)-quantile_cont({0}::DOUBLE,0.25))"
    )
    out["scale_minmax"] = _scaled(scaled, "min({0}::DOUBLE)", "(max({0})-min({0}))::DOUBLE")
    out["scale_standard"] = _scaled(scaled, "avg({0}::DOUBLE)", "stddev_pop({0}::DOUBLE)")
    codes = "".join(
        f""", {c}_codes AS (SELECT v, row_number() OVER (ORDER BY v)-1 AS code FROM
          (SELECT DISTINCT {c} AS v FROM clean WHERE side='ref' AND grade<>'D' AND {c} IS NOT NULL))"""
        for c in ("grade", "addr_state")
    )
    out["encode_ordinal"] = _clean(
        f"""{codes} SELECT id, coalesce(a.code, -1)::INT AS grade, coalesce(b.code, -1)::INT AS addr_state
        FROM clean LEFT JOIN grade_codes a ON grade=a.v LEFT JOIN addr_state_codes b ON addr_state=b.v"""
    )
    flags = ", ".join(f"CASE WHEN grade='{g}' THEN 1::DOUBLE ELSE 0 END AS grade_{g}" for g in "ABCEFG")
    segments = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    flags += ", " + ", ".join(
        f"CASE WHEN home_ownership='{s}' THEN 1::DOUBLE ELSE 0 END AS home_ownership_{s}" for s in segments
    )
    out["encode_onehot"] = _clean(
        f"SELECT id, {flags}, CASE WHEN side='ref' THEN 1::DOUBLE ELSE 0 END AS side_ref FROM clean"
    )

    # selection
    out["variance_threshold"] = _clean(
        f"""SELECT feature, {_r('var_pop(value)', 'variance', 3)}, var_pop(value) > 0.01::DOUBLE AS kept
        FROM {_long(NUMERIC)} GROUP BY feature"""
    )
    out["feature_counts"] = _clean(
        "SELECT 13 AS n_input_features, 26 AS n_engineered_features, count(*) AS n_samples FROM clean"
    )

    # splits
    out["split_random"] = _clean(f", {_split(chr(39) + 'all' + chr(39))} SELECT id, split FROM parts")
    out["split_stratified"] = _clean(f", {_split('grade')} SELECT id, grade, split FROM parts")
    out["split_trainval"] = _clean(
        f", {_split(chr(39) + 'all' + chr(39))} SELECT id FROM parts WHERE split IN ('train','val')"
    )
    out["split_report"] = _clean(
        f""", {_split('grade')}, lined AS (SELECT split, loan_status FROM parts
          UNION ALL SELECT 'trainval', loan_status FROM parts WHERE split<>'test'
          UNION ALL SELECT 'total', loan_status FROM parts)
        SELECT split, count(*) AS n_rows, {_r('count(*)::DOUBLE/(SELECT count(*) FROM parts)*100', 'percentage')},
          {_r('avg(loan_status)', 'label_mean')} FROM lined GROUP BY split"""
    )
    out["sample_rows"] = _clean(
        f"SELECT id, grade FROM clean ORDER BY md5(concat('{SEED}','|',id)), id LIMIT 1000"
    )

    # metrics
    strict = """strict AS (SELECT count(*) FILTER (y=0 AND p<=0.5::DOUBLE) AS tn, count(*) FILTER (y=0 AND p>0.5::DOUBLE) AS fp,
      count(*) FILTER (y=1 AND p<=0.5::DOUBLE) AS fn, count(*) FILTER (y=1 AND p>0.5::DOUBLE) AS tp FROM scored)"""
    out["objective_metric"] = _scored(
        f""", {strict}, {RANKED} SELECT 'auc' AS metric, {_r(AUC, 'value')} FROM ranked
        UNION ALL SELECT 'f1', {_r(F1, 'value')} FROM strict
        UNION ALL SELECT 'precision', {_r(PRECISION, 'value')} FROM strict
        UNION ALL SELECT 'recall', {_r(RECALL, 'value')} FROM strict
        UNION ALL SELECT 'accuracy', {_r(ACCURACY, 'value')} FROM strict"""
    )
    out["confusion_matrix"] = _scored(f", {CELLS} SELECT * FROM cells")
    out["basic_metrics"] = _scored(
        f""", {CELLS} SELECT {_r(ACCURACY, 'accuracy', 9)}, {_r(PRECISION, '"precision"', 9)},
        {_r(RECALL, 'recall', 9)}, {_r(F1, 'f1', 9)} FROM cells"""
    )
    out["rate_metrics"] = _scored(
        f""", {CELLS} SELECT {_r(_div('tn', 'tn+fp'), 'specificity', 9)}, {_r(_div('tn', 'tn+fn'), 'npv', 9)},
        {_r(_div('fp', 'tn+fp'), 'fpr', 9)}, {_r(_div('fn', 'fn+tp'), 'fnr', 9)} FROM cells"""
    )
    out["roc_auc"] = _scored(f", {RANKED} SELECT {_r(AUC, 'roc_auc', 9)} FROM ranked")
    out["average_precision"] = _scored(f", {RANKED} SELECT {_r(AP, 'avg_precision', 9)} FROM ranked")

    def line(label: str, p: str, r: str, f: str, s: str) -> str:
        return f"""SELECT '{label}' AS label, {_r(p, '"precision"', 9)}, {_r(r, 'recall', 9)},
          {_r(f, 'f1_score', 9)}, {_r(s, 'support', 9)} FROM classes"""

    classes = f"""classes AS (SELECT {_div('tn', 'tn+fn')} AS p0, {_div('tn', 'tn+fp')} AS r0,
      {_div('2*tn', '2*tn+fn+fp')} AS f0, (tn+fp)::DOUBLE AS s0, {PRECISION} AS p1, {RECALL} AS r1, {F1} AS f1,
      (tp+fn)::DOUBLE AS s1, {ACCURACY} AS acc FROM cells)"""
    macro = [f"({k}0+{k}1)/2" for k in "prf"]
    weighted = [f"({k}0*s0+{k}1*s1)/(s0+s1)" for k in "prf"]
    out["classification_report"] = _scored(
        f", {CELLS}, {classes} "
        + " UNION ALL ".join(
            [
                line("0", "p0", "r0", "f0", "s0"),
                line("1", "p1", "r1", "f1", "s1"),
                line("accuracy", "acc", "acc", "acc", "acc"),
                line("macro avg", *macro, "s0+s1"),
                line("weighted avg", *weighted, "s0+s1"),
            ]
        )
    )

    # curves
    out["roc_curve"] = _scored(
        f""", {RANKED} SELECT {_r('fp/nn', 'fpr', 9)}, {_r('tp/np', 'tpr', 9)}, {_r('p', 'threshold', 9)} FROM ranked
        UNION ALL SELECT 0, 0, 'inf'::DOUBLE"""
    )
    out["pr_curve"] = _scored(
        f""", {RANKED} SELECT {_r('tp/(tp+fp)', '"precision"', 9)}, {_r('tp/np', 'recall', 9)},
        {_r('p', 'threshold', 9)}, {_r('np/(np+nn)', 'baseline', 9)} FROM ranked
        UNION ALL SELECT 1, 0, NULL, {_r('max(np)/(max(np)+max(nn))', 'baseline', 9)} FROM ranked"""
    )
    edges = " + ".join(f"(p > {i}*0.1::DOUBLE)::INT" for i in range(1, 10))
    out["calibration_curve"] = _scored(
        f"""SELECT {edges} AS bin, {_r('avg(p)', 'mean_predicted', 9)}, {_r('avg(y)', 'fraction_positive', 9)},
        count(*) AS n_rows FROM scored GROUP BY 1"""
    )

    def binned(bins: int) -> str:
        return (
            f"CASE WHEN hi>lo THEN least(floor((value-lo)*{bins}::DOUBLE/(hi-lo))::INT, {bins - 1}) "
            f"ELSE {bins // 2} END"
        )

    out["score_histogram"] = _scored(
        f""", b AS (SELECT y, min(p) AS lo, max(p) AS hi FROM scored GROUP BY y),
        n AS (SELECT y, lo, hi, {binned(30)} AS bin, count(*) AS n_rows
          FROM (SELECT y, p AS value, lo, hi FROM scored JOIN b USING (y)) GROUP BY ALL)
        SELECT y AS loan_status, bin, {_r('lo+bin*((hi-lo)/30::DOUBLE)', 'low_edge', 9)},
          {_r('lo+(bin+1)*((hi-lo)/30::DOUBLE)', 'high_edge', 9)}, n_rows,
          {_r('n_rows/sum(n_rows) OVER (PARTITION BY y)', 'share', 9)} FROM n"""
    )
    out["threshold_sweep"] = _scored(
        f""", t AS (SELECT 0.01::DOUBLE + i*0.02::DOUBLE AS threshold FROM range(50) r(i)),
        cells AS (SELECT threshold, count(*) FILTER (y=0 AND p<threshold) AS tn, count(*) FILTER (y=0 AND p>=threshold) AS fp,
          count(*) FILTER (y=1 AND p<threshold) AS fn, count(*) FILTER (y=1 AND p>=threshold) AS tp
          FROM scored, t GROUP BY threshold)
        SELECT {_r('threshold', 'threshold', 9)}, {_r(PRECISION, '"precision"', 9)}, {_r(RECALL, 'recall', 9)},
          {_r(F1, 'f1', 9)}, {_r(ACCURACY, 'accuracy', 9)} FROM cells"""
    )
    out["promotion_gate"] = _scored(
        f""", {RANKED} SELECT {_r(AUC, 'roc_auc', 9)}, 0.8::DOUBLE AS minimum, {AUC} >= 0.8::DOUBLE AS promote FROM ranked"""
    )

    # statistics
    types = {
        "term": "int", "emp_length": "int", "delinq_2yrs": "bigint", "open_acc": "int", "pub_rec": "int",
        "total_acc": "bigint",
    }
    dtype = "CASE feature " + " ".join(f"WHEN '{c}' THEN '{t}'" for c, t in types.items()) + " ELSE 'double' END AS dtype"
    percentiles = ", ".join(
        _r(f"quantile_cont(value, {p / 100})", f"p{p}", 5) for p in (1, 5, 25, 50, 75, 95, 99)
    )
    out["numeric_stats"] = _clean(
        f"""SELECT feature, {dtype}, {_r('avg(value)', 'mean', 5)}, {_r('quantile_cont(value,0.5)', 'median', 5)},
        {_r('stddev_samp(value)', 'std', 5)}, {_r('min(value)', 'min', 5)}, {_r('max(value)', 'max', 5)},
        {_r('count(*) FILTER (value IS NULL)/count(*)::DOUBLE', 'missing', 5)}, {percentiles}
        FROM {_long(NUMERIC)} GROUP BY feature"""
    )
    out["describe"] = _clean(
        f"""SELECT feature, count(value) AS "count", {_r('avg(value)', 'mean', 5)}, {_r('stddev_samp(value)', 'std', 5)},
        {_r('min(value)', 'min', 5)}, {_r('quantile_cont(value,0.25)', 'p25', 5)},
        {_r('quantile_cont(value,0.5)', 'p50', 5)}, {_r('quantile_cont(value,0.75)', 'p75', 5)},
        {_r('max(value)', 'max', 5)} FROM {_long(NUMERIC)} GROUP BY feature"""
    )
    listed = [*CATEGORICAL, "loan_status"]
    out["categorical_stats"] = _raw(
        f""", l AS {_long(listed, 'raw', '', 'VARCHAR')},
        m AS (SELECT feature, count(*) FILTER (value IS NULL)/count(*)::DOUBLE AS missing FROM l GROUP BY feature),
        n AS (SELECT feature, value, count(*) AS n FROM l WHERE value IS NOT NULL GROUP BY ALL),
        f AS (SELECT feature, value, n/sum(n) OVER (PARTITION BY feature) AS freq,
          count(*) OVER (PARTITION BY feature) AS unique_count,
          row_number() OVER (PARTITION BY feature ORDER BY n DESC, value) AS rn FROM n)
        SELECT feature, 'string' AS dtype, unique_count, {_r('missing', 'missing', 9)}, value AS category,
          {_r('freq', 'freq', 9)} FROM f JOIN m USING (feature) WHERE rn<=10"""
    )
    every = [
        "id", "loan_amnt", "term", "int_rate", "installment", "grade", "emp_length", "home_ownership", "annual_inc",
        "issue_d", "earliest_cr_line", "loan_status", "purpose", "addr_state", "dti", "delinq_2yrs", "revol_util",
        "open_acc", "pub_rec", "revol_bal", "total_acc", "side", "score_milli",
    ]
    out["missing_report"] = _raw(
        f"""SELECT * FROM (SELECT feature, count(*) FILTER (value IS NULL) AS missing_values,
          {_r('count(*) FILTER (value IS NULL)/count(*)::DOUBLE*100', 'percentage')}
          FROM {_long(every, 'raw', '', 'VARCHAR')} GROUP BY feature) WHERE missing_values>0"""
    )
    out["value_counts"] = _raw(
        f"""SELECT loan_status AS value, count(*) AS n_rows, {_r('count(*)/(SELECT count(loan_status) FROM raw)::DOUBLE*100', 'percentage')}
        FROM raw WHERE loan_status IS NOT NULL GROUP BY 1"""
    )
    shown = ["loan_amnt", "int_rate", "installment", "annual_inc", "dti", "revol_util"]
    out["histogram"] = _clean(
        f""", l AS (SELECT * FROM {_long(shown, keep='loan_status')} WHERE value IS NOT NULL),
        b AS (SELECT feature, min(value) AS lo, max(value) AS hi FROM l GROUP BY feature),
        n AS (SELECT feature, loan_status, lo, hi, {binned(30)} AS bin, count(*) AS n_rows FROM l JOIN b USING (feature) GROUP BY ALL)
        SELECT feature, loan_status, bin, {_r('lo+bin*((hi-lo)/30::DOUBLE)', 'low_edge')},
          {_r('lo+(bin+1)*((hi-lo)/30::DOUBLE)', 'high_edge')}, n_rows,
          {_r('n_rows/sum(n_rows) OVER (PARTITION BY feature, loan_status)', 'share')} FROM n"""
    )

    out["histogram_auto"] = _clean(
        f""", l AS (SELECT * FROM {_long(NUMERIC)} WHERE value IS NOT NULL),
        q AS (SELECT feature, min(value) AS lo, max(value) AS hi, max(value)-min(value) AS rng, count(*) AS n,
          quantile_cont(value, 0.75)-quantile_cont(value, 0.25) AS iqr FROM l GROUP BY feature),
        w AS (SELECT *, rng/(log2(n)+1) AS sturges, 2*iqr/pow(n, 1/3::DOUBLE) AS narrow FROM q),
        b AS (SELECT *, CASE WHEN rng>0 THEN ceil(rng/CASE WHEN iqr>0 THEN least(narrow, sturges) ELSE sturges END)::INT ELSE 1 END
          AS bins FROM w),
        n AS (SELECT feature, bins, lo, hi, CASE WHEN hi>lo THEN least(floor((value-lo)*bins::DOUBLE/(hi-lo))::INT, bins-1)
          ELSE bins//2 END AS bin, count(*) AS n_rows FROM l JOIN b USING (feature) GROUP BY ALL),
        e AS (SELECT feature, bin, bins, n_rows, CASE WHEN hi=lo THEN lo-0.5::DOUBLE ELSE lo END AS lo,
          CASE WHEN hi=lo THEN hi+0.5::DOUBLE ELSE hi END AS hi FROM n)
        SELECT feature, bin, {_r('lo+bin*((hi-lo)/bins::DOUBLE)', 'low_edge')},
          {_r('lo+(bin+1)*((hi-lo)/bins::DOUBLE)', 'high_edge')}, n_rows,
          {_r('n_rows/sum(n_rows) OVER (PARTITION BY feature)', 'share')} FROM e"""
    )

    # importance
    ranked = _importance("clean", "imp")
    exchanged = ["int_rate", "dti", "annual_inc", "total_acc"]
    partners = " ".join(
        f"""JOIN placed o{j} ON o{j}.b=p.b
        AND o{j}.i=(p.i + CASE WHEN p.n=1 THEN 0 ELSE 1 + {j} % (p.n-1) END) % p.n"""
        for j in range(len(exchanged))
    )
    cells = ", ".join(f"p.{c}, o{j}.{c} AS other_{c}" for j, c in enumerate(exchanged))

    def mean_loss(version: str, moved: str | None) -> str:
        v = {c: f"{'other_' if c == moved else ''}{c}::DOUBLE" for c in exchanged}
        margin = f"""1 + coalesce({v['annual_inc']},60000)/100000 - (coalesce({v['int_rate']},12)-12)*0.15::DOUBLE
          - (coalesce({v['dti']},15)-15)*0.03::DOUBLE"""
        p = f"greatest(1e-15::DOUBLE, least(1-1e-15::DOUBLE, 1/(1+exp({margin}))))"
        return f"SELECT '{version}' AS feature, avg(-CASE WHEN y=1 THEN ln({p}) ELSE ln(1-{p}) END) AS loss FROM swapped"

    out["permutation_importance"] = _clean(
        f""", hashed AS (SELECT *, loan_status AS y, md5(concat('{SEED}','|',id)) AS h FROM clean),
        dealt AS (SELECT *, ('0x'||substr(h,1,7))::BIGINT % (SELECT greatest(1, ceil(count(*)/1000::DOUBLE))::BIGINT FROM clean) AS b
          FROM hashed),
        placed AS (SELECT *, row_number() OVER (PARTITION BY b ORDER BY h) - 1 AS i, count(*) OVER (PARTITION BY b) AS n FROM dealt),
        swapped AS (SELECT p.y, {cells} FROM placed p {partners}),
        losses AS ({" UNION ALL ".join([mean_loss("", None), *[mean_loss(c, c) for c in exchanged]])}),
        rises AS (SELECT feature, greatest(loss - (SELECT loss FROM losses WHERE feature=''), 0) AS importance
          FROM losses WHERE feature<>'')
        SELECT feature, {_r('importance', 'importance')},
        {_r('importance/nullif(sum(importance) OVER (),0)*100', 'relative_importance')} FROM rises"""
    )
    out["feature_importance"] = _clean(
        f""", {ranked} SELECT feature, {_r('importance', 'importance')},
        {_r('relative_importance', 'relative_importance')} FROM imp"""
    )
    out["topk_importance"] = _clean(
        f""", {ranked} SELECT feature, {_r('importance', 'importance')},
        {_r('relative_importance', 'relative_importance')} FROM (SELECT * FROM imp ORDER BY importance DESC, feature LIMIT 5)"""
    )
    weighed = [c for c in NUMERIC if c != "installment"]
    fits = ", ".join(
        f"corr({c}::DOUBLE, loan_status::DOUBLE) AS {c}_w, avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_s" for c in weighed
    )
    shares = ", ".join(
        f"CASE WHEN {c}_s<>0 THEN ({c}-{c}_m)/{c}_s*{c}_w ELSE 0 END AS {c}" for c in weighed
    )
    out["shap_summary"] = _clean(
        f""", f AS (SELECT {fits} FROM clean), s AS (SELECT {shares} FROM clean, f),
        a AS (SELECT feature, avg(abs(value)) AS mean_abs FROM {_long(weighed, 's')} GROUP BY feature)
        SELECT feature, {_r('mean_abs', 'mean_abs')}, row_number() OVER (ORDER BY mean_abs DESC, feature)::INT AS rank FROM a"""
    )

    pairs = " UNION ALL ".join(
        f"SELECT id, '{c}' AS feature, {c}::DOUBLE AS value, CASE WHEN {c}_s<>0 THEN ({c}-{c}_m)/{c}_s*{c}_w ELSE 0 END AS c FROM clean, f"
        for c in weighed
    )
    out["shap_dependence"] = _clean(
        f""", f AS (SELECT {fits} FROM clean), s AS ({pairs}),
        a AS (SELECT feature, row_number() OVER (ORDER BY avg(abs(c)) DESC, feature)::INT AS rank FROM s GROUP BY feature)
        SELECT id, feature, rank, {_r('value', 'value')}, {_r('c', 'contribution')} FROM s JOIN a USING (feature) WHERE rank<=5"""
    )

    # drift
    out["ks_statistic"] = _clean(f", {_distances(NUMERIC)} SELECT feature, {_r('ks', 'ks', 9)} FROM norm")
    out["wasserstein"] = _clean(
        f", {_distances(NUMERIC)} SELECT feature, {_r('w', 'wasserstein')}, {_r('wn', 'wasserstein_norm')} FROM norm"
    )
    out["numeric_drift"] = _clean(
        f""", {_distances(SHIFTED_NUMERIC, SHIFTED)}
        SELECT feature, {_r('least(0.4::DOUBLE*wn+0.6::DOUBLE*ks, 1)', 'drift_score')} FROM norm"""
    )
    out["moment_drift"] = _clean(
        f""", m AS (SELECT feature, avg(value) FILTER (side='ref') AS rm, stddev_samp(value) FILTER (side='ref') AS rs,
          avg(value) FILTER (side='cur') AS cm, stddev_samp(value) FILTER (side='cur') AS cs
          FROM {_long(SHIFTED_NUMERIC, NO_CURRENT_UTIL, 'side')} GROUP BY feature)
        SELECT feature, {_r("least(coalesce(0.7::DOUBLE*abs(cm-rm)/CASE WHEN rs>0 THEN rs ELSE 1 END + 0.3::DOUBLE*abs(cs-rs)/CASE WHEN rs>0 THEN rs ELSE 1 END, 0), 1)", 'drift_score')} FROM m"""
    )
    out["categorical_drift"] = _clean(f", {_top(CATEGORICAL)} SELECT feature, {_r('drift_score', 'drift_score', 9)} FROM catd")
    out["type_mismatch_drift"] = _clean(
        f", {_feature_drift()} SELECT feature, kind, drift_score, drifted FROM drift WHERE kind='type'"
    )
    out["feature_drift"] = _clean(
        f", {_feature_drift()} SELECT feature, kind, {_r('drift_score', 'drift_score')}, drifted FROM drift"
    )
    out["overall_drift"] = _clean(
        f""", {_feature_drift()}, {ranked}
        SELECT bool_or(drifted) AS has_drift, {_r('sum(drift_score*coalesce(relative_importance,0))/sum(coalesce(relative_importance,0))', 'drift_score')},
          count(*) FILTER (drifted) AS n_drifted, count(*) AS n_features FROM drift LEFT JOIN imp USING (feature)"""
    )
    change = """greatest(max(CASE WHEN metric='auc' THEN
      -(CASE WHEN reference<>0 THEN difference/abs(reference) ELSE current END) END), 0)"""
    out["concept_drift"] = (
        f"{_side_metrics('m')} SELECT {_r(change, 'drift_score', 9)}, {change} > 0.1::DOUBLE AS has_drift FROM pairs"
    )
    out["metric_compare"] = (
        f"""{_side_metrics('m')} SELECT metric, {_r('reference', 'reference', 9)}, {_r('current', 'current', 9)},
        {_r('difference', 'difference', 9)} FROM pairs"""
    )
    relative = "CASE WHEN reference<>0 THEN difference/abs(reference) ELSE current END"
    out["metric_changes"] = (
        f"""{_side_metrics('m')} SELECT metric, {_r('reference', 'reference', 9)}, {_r('current', 'current', 9)},
        {_r('difference', 'difference', 9)}, {_r(relative, 'relative_change', 9)} FROM pairs"""
    )
    moved = f"""{_importance("(SELECT * FROM clean WHERE side='ref')", 'r')}, {_importance("(SELECT * FROM clean WHERE side='cur')", 'c')},
      moved AS (SELECT feature, coalesce(r.relative_importance,0) AS a, coalesce(c.relative_importance,0) AS b,
        coalesce(c.relative_importance,0)-coalesce(r.relative_importance,0) AS d FROM r FULL OUTER JOIN c USING (feature)),
      changes AS (SELECT feature, a, b, d, d/greatest(a, 0.1::DOUBLE) AS rel FROM moved)"""
    columns = f"""feature, {_r('a', 'relative_importance_ref', 5)}, {_r('b', 'relative_importance_cur', 5)},
      {_r('d', 'absolute_change', 5)}, {_r('rel', 'relative_change', 5)}, abs(rel) > 0.2::DOUBLE AS changed"""
    out["importance_drift"] = _clean(f", {moved} SELECT {columns} FROM changes")
    out["topk_importance_drift"] = _clean(
        f", {moved} SELECT {columns} FROM (SELECT * FROM changes ORDER BY abs(d) DESC, feature LIMIT 10)"
    )
    out["topk_drift"] = _clean(
        f""", {_feature_drift(0.01)} SELECT feature, kind, {_r('drift_score', 'drift_score')}, drifted
        FROM (SELECT * FROM drift WHERE drifted ORDER BY drift_score DESC, feature LIMIT 5)"""
    )
    out["category_compare"] = _clean(
        f""", {_top(CATEGORICAL)},
        allp AS (SELECT feature, value, coalesce(max(f) FILTER (side='ref'),0) AS rf, coalesce(max(f) FILTER (side='cur'),0) AS cf,
          min(rn) AS best, count(*) OVER (PARTITION BY feature) AS n_values FROM catf GROUP BY feature, value)
        SELECT feature, value, {_r('rf', 'ref_freq', 9)}, {_r('cf', 'cur_freq', 9)} FROM allp WHERE n_values<=10 OR best<=10"""
    )
    out["kl_drift"] = _clean(
        f""", l AS (SELECT * FROM {_long(NUMERIC, SHIFTED, 'side')} WHERE value IS NOT NULL),
        b AS (SELECT feature, min(value) AS lo, max(value) AS hi FROM l GROUP BY feature),
        n AS (SELECT feature, {binned(20)} AS bin, count(*) FILTER (side='ref') AS r, count(*) FILTER (side='cur') AS c
          FROM l JOIN b USING (feature) GROUP BY ALL),
        s AS (SELECT feature, c/sum(c) OVER (PARTITION BY feature)::DOUBLE + 1e-6::DOUBLE AS p,
          r/sum(r) OVER (PARTITION BY feature)::DOUBLE + 1e-6::DOUBLE AS q FROM n)
        SELECT feature, {_r('sum(p*ln(p/q))', 'kl')}, sum(p*ln(p/q)) > 0.2::DOUBLE AS drifted FROM s GROUP BY feature"""
    )
    # the alert joins the three reports: features by drift, the metrics' loss, the importance changes
    metric_parts = _side_metrics("m")[len(BASE):]
    metric_parts = metric_parts.replace("scored", "mscored").replace("freq", "mfreq").replace("ranked", "mranked")
    out["drift_alert"] = _clean(
        f""", {_feature_drift()}, {moved}{metric_parts},
        data AS (SELECT bool_or(drifted) AS any, string_agg(feature, ',' ORDER BY feature) FILTER (drifted) AS names FROM drift),
        con AS (SELECT {change} AS s FROM pairs),
        imps AS (SELECT bool_or(abs(rel) > 0.2::DOUBLE) AS any,
          string_agg(feature, ',' ORDER BY feature) FILTER (abs(rel) > 0.2::DOUBLE) AS names FROM changes)
        SELECT data.any OR s > 0.1::DOUBLE OR imps.any AS alert, data.any AS data_drift, coalesce(data.names, '') AS drifted_features,
          s > 0.1::DOUBLE AS concept_drift, {_r('s', 'concept_drift_score')}, imps.any AS importance_drift,
          coalesce(imps.names, '') AS changed_features FROM data, con, imps"""
    )

    # tables about tables
    view_types = types | {"score_milli": "bigint"}
    texts = ["id", "term", "int_rate", "grade", "emp_length", "home_ownership", "issue_d", "earliest_cr_line",
             "loan_status", "purpose", "addr_state", "revol_util", "side"]
    places = "CASE feature " + " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(every)) + " END AS position"
    kinds = {c: "string" if c in texts else view_types.get(c, "double") for c in every}
    kind = "CASE feature " + " ".join(f"WHEN '{c}' THEN '{t}'" for c, t in kinds.items()) + " END AS dtype"
    out["schema_report"] = _raw(
        f"""SELECT {places}, feature, {kind}, count(value) AS non_null, count(*) AS n_rows, 23 AS n_columns
        FROM {_long(every, 'raw', '', 'VARCHAR')} GROUP BY feature"""
    )
    out["sink_report"] = _clean(
        f"""SELECT feature, count(DISTINCT value) AS unique_count, least(count(DISTINCT value), 10) AS n_top
        FROM {_long(CATEGORICAL, 'clean', '', 'VARCHAR')} GROUP BY feature"""
    )
    out["scan_zip_csv"] = _raw("SELECT id, term, grade, loan_status FROM raw")
    stored = [*NUMERIC, *CATEGORICAL]
    numbers = {"mean": "avg(value)", "std": "stddev_samp(value)", "min": "min(value)", "max": "max(value)"}
    items = [f"SELECT feature, 'data:non_null' AS item, count(value)::DOUBLE AS value FROM {_long(stored, 'ref', '', 'VARCHAR')} GROUP BY feature"]
    items += [
        f"SELECT feature, 'numeric_stats:{n}', {_r(e, 'value')} FROM {_long(NUMERIC, 'ref')} GROUP BY feature"
        for n, e in numbers.items()
    ]
    strings = {"unique_count": "count(DISTINCT value)::DOUBLE", "missing": "count(*) FILTER (value IS NULL)/count(*)::DOUBLE"}
    items += [
        f"SELECT feature, 'categorical_stats:{n}', {_r(e, 'value')} FROM {_long(CATEGORICAL, 'ref', '', 'VARCHAR')} GROUP BY feature"
        for n, e in strings.items()
    ]
    items += [f"SELECT feature, 'importance:{n}', {_r(n, 'value')} FROM imp" for n in ("importance", "relative_importance")]
    items.append(f"SELECT metric, 'metrics', {_r('reference', 'value')} FROM pairs")
    found = _importance("ref", "imp")
    out["reference_snapshot"] = (
        f"{_side_metrics('m')}, ref AS (SELECT * FROM clean WHERE side='ref'), {found} " + " UNION ALL ".join(items)
    )
    halves = [
        f"""SELECT {i}::BIGINT AS batch_id, * FROM (WITH
        half AS (SELECT * FROM clean WHERE side='ref' OR right(id, 1)::INT % 2 = {i}),
        {_distances(NUMERIC, 'half')}, {_top(CATEGORICAL, 'half')},
        scores AS (SELECT feature, 'numeric' AS kind, least(0.4::DOUBLE*wn + 0.6::DOUBLE*ks, 1) AS s FROM norm
          UNION ALL SELECT feature, 'categorical', drift_score FROM catd)
        SELECT feature, kind, {_r('s', 'drift_score')}, s > 0.1::DOUBLE AS drifted FROM scores)"""
        for i in range(2)
    ]
    out["stream_drift"] = _clean(" UNION ALL ".join(halves))
    profiled = ["loan_status", *NUMERIC]
    positions = ["loan_status", *NUMERIC, *CATEGORICAL]
    place = "CASE feature " + " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(positions)) + " END AS position"
    profile_types = {"loan_status": "int", **types, **{c: "string" for c in CATEGORICAL}}
    profile_kind = (
        "CASE feature " + " ".join(f"WHEN '{c}' THEN '{t}'" for c, t in profile_types.items()) + " ELSE 'double' END AS dtype"
    )
    out["table_profile"] = _clean(
        f""", l AS {_long(positions, 'clean', '', 'VARCHAR')},
        a AS (SELECT feature, count(value) AS non_null, count(*) AS n_rows, count(DISTINCT value) AS n_distinct FROM l GROUP BY feature),
        t AS (SELECT feature, value, count(*) AS n FROM l WHERE value IS NOT NULL GROUP BY ALL),
        m AS (SELECT feature, max(n) AS n_most_frequent FROM t GROUP BY feature),
        x AS (SELECT feature, count(*) FILTER (value=0) AS n_zeros, count(*) FILTER (value<0) AS n_negative,
          {_r('avg(value)', 'mean')}, {_r('stddev_samp(value)', 'std')}, {_r('min(value)', 'min')}, {_r('max(value)', 'max')}
          FROM {_long(profiled)} GROUP BY feature)
        SELECT {place}, feature, {profile_kind}, non_null, n_rows, 18 AS n_columns, n_distinct, n_most_frequent,
          n_zeros, n_negative, "mean", "std", "min", "max" FROM a JOIN m USING (feature) LEFT JOIN x USING (feature)"""
    )
    # median fill, then median and quartiles of the filled column; every one-hot column from its sorted values
    filled = ", ".join(f"coalesce({c}::DOUBLE, (SELECT quantile_cont({c}::DOUBLE, 0.5) FROM clean)) AS {c}" for c in NUMERIC)
    fitted = ", ".join(
        f"quantile_cont({c}, 0.5) AS {c}_a, quantile_cont({c}, 0.75)-quantile_cont({c}, 0.25) AS {c}_b" for c in NUMERIC
    )
    cells = ", ".join(_r(f"({c}-{c}_a)/CASE WHEN {c}_b=0 THEN 1 ELSE {c}_b END", c) for c in NUMERIC)
    kinds_of = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
    hot = [f"CASE WHEN home_ownership='{v}' THEN 1::DOUBLE ELSE 0 END AS home_ownership_{v}" for v in segments]
    hot += [f"CASE WHEN purpose='{v}' THEN 1::DOUBLE ELSE 0 END AS purpose_{v}" for v in kinds_of]
    out["preprocess"] = _clean(
        f""", filled AS (SELECT id, loan_status, grade, addr_state, home_ownership, purpose, {filled} FROM clean),
        f AS (SELECT {fitted} FROM filled)
        SELECT id, loan_status, {cells}, (dense_rank() OVER (ORDER BY grade) - 1)::INT AS grade,
          (dense_rank() OVER (ORDER BY addr_state) - 1)::INT AS addr_state, {', '.join(hot)} FROM filled, f"""
    )
    of_ref = filled.replace("FROM clean", "FROM clean WHERE side='ref'")
    ranks = ", ".join(
        f"""coalesce((SELECT k FROM (SELECT v, row_number() OVER (ORDER BY v) - 1 AS k FROM (SELECT DISTINCT {c} AS v
        FROM clean WHERE side='ref')) WHERE v={c}), -1)::INT AS {c}"""
        for c in ("grade", "addr_state")
    )
    out["preprocess_new_rows"] = _clean(
        f""", filled AS (SELECT id, side, loan_status, grade, addr_state, home_ownership, purpose, {of_ref} FROM clean),
        f AS (SELECT {fitted} FROM filled WHERE side='ref')
        SELECT id, loan_status, {cells}, {ranks}, {', '.join(hot)} FROM filled, f WHERE side='cur'"""
    )
    # the isotonic fit at a score: the largest, over starts at or before it, of the smallest mean up to an end at or
    # after it
    out["calibrate_isotonic"] = _scored(
        f""", g AS (SELECT p, sum(y) AS s, count(*) AS n FROM scored GROUP BY p),
        c AS (SELECT p, n, row_number() OVER (ORDER BY p) AS i, sum(s) OVER (ORDER BY p) AS cs, sum(n) OVER (ORDER BY p) AS cn FROM g),
        pairs AS (SELECT a.i AS a, b.i AS b, (b.cs-coalesce(z.cs,0))::DOUBLE/(b.cn-coalesce(z.cn,0)) AS m
          FROM c a JOIN c b ON b.i>=a.i LEFT JOIN c z ON z.i=a.i-1),
        lows AS (SELECT a, b AS i, min(m) OVER (PARTITION BY a ORDER BY b DESC) AS low FROM pairs),
        fit AS (SELECT i, max(low) AS v FROM lows GROUP BY i)
        SELECT {_r('p', 'score', 9)}, {_r('v', 'calibrated', 9)}, n AS n_rows FROM c JOIN fit USING (i)"""
    )

    # Newton steps on the logistic loss of the smoothed targets, from (0, 0)
    steps = ["s0 AS (SELECT 0::DOUBLE AS a, 0::DOUBLE AS b)"]
    for i in range(12):
        steps.append(
            f"""g{i} AS (SELECT any_value(a) AS a, any_value(b) AS b, sum((q-t)*n*p) AS ga, sum((q-t)*n) AS gb,
            sum(n*q*(1-q)*p*p) AS haa, sum(n*q*(1-q)*p) AS hab, sum(n*q*(1-q)) AS hbb
            FROM (SELECT w.*, a, b, 1/(1+exp(-(a*p+b))) AS q FROM w, s{i})),
          s{i + 1} AS (SELECT a-(hbb*ga-hab*gb)/(haa*hbb-hab*hab) AS a, b-(haa*gb-hab*ga)/(haa*hbb-hab*hab) AS b FROM g{i})"""
        )
    out["calibrate_sigmoid"] = _scored(
        f""", k AS (SELECT count(*) FILTER (y=1)::DOUBLE AS pos, count(*) FILTER (y=0)::DOUBLE AS neg FROM scored),
        w AS (SELECT p, count(*)::DOUBLE AS n,
          (count(*) FILTER (y=1)*(any_value(pos)+1)/(any_value(pos)+2) + count(*) FILTER (y=0)/(any_value(neg)+2))/count(*) AS t
          FROM scored, k GROUP BY p), {', '.join(steps)}
        SELECT {_r('p', 'score', 4)}, {_r('1/(1+exp(-(a*p+b)))', 'calibrated', 4)}, n::BIGINT AS n_rows FROM w, s12"""
    )

    out["default_rate_by_grade"] = _clean(
        f"""SELECT grade, count(*) AS n_loans, {_r('avg(loan_status)', 'default_rate')},
        {_r('avg(int_rate)', 'mean_int_rate')}, {_r('avg(loan_amnt/(annual_inc+1))', 'mean_loan_to_income')},
        {_r('avg(installment*12/(annual_inc+1))', 'mean_installment_to_income')},
        {_r('avg(revol_bal/(annual_inc+1))', 'mean_revol_bal_to_income')},
        {_r('avg(installment/(loan_amnt+1))', 'mean_payment_to_loan')} FROM clean GROUP BY grade"""
    )
    return out


ORACLE = _build()
