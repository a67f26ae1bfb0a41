import json

import pytest

from riskloom.operators import clean, encode, generate, impute, scale, select, stats
from riskloom.sources import loan_csv, tables


def test_scalar_rules_on_hard_values(spark):
    df = spark.createDataFrame(
        [
            ("13.56%", " 36 months", "10+ years", "Dec-2018", "Fully Paid"),
            (" 7%%", "60 months", "< 1 year", "2018-12-01", "Default"),
            ("junk", None, "n/a", "12/01/2018", "In Grace Period"),
            (None, "soon", None, "01-Dec-2018", None),
        ],
        "int_rate string, term string, emp_length string, hire_date string, loan_status string",
    )
    out = clean.map_emp_length(clean.parse_term(clean.parse_percent(clean.parse_dates(df)))).collect()
    assert [r.int_rate for r in out] == [pytest.approx(0.1356), pytest.approx(0.07), None, None]
    assert [r.term for r in out] == [36, 60, None, None]
    assert [r.emp_length for r in out] == [10, 0, None, None]
    assert {str(r.hire_date) for r in out} == {"2018-12-01 00:00:00"}
    assert [r.loan_status for r in clean.binary_target(df).collect()] == [0, 1]
    failed = {r["column"]: r["n_unreadable"] for r in clean.parse_failures(df).collect()}
    assert failed == {"int_rate": 1, "term": 1, "hire_date": 0}


def test_missing_columns_skip_their_rules(spark):
    df = spark.createDataFrame([(1,)], "x int")
    assert clean.clean(df, "2020-01-01").columns == ["x"]
    assert generate.composite_risk_score(df).columns == ["x"]


def test_note_rows(spark, tmp_path):
    header = ["id", "member_id", "loan_amnt", "term"]
    text = "a banner\n" + ",".join(header) + "\n,,1000, 36 months\n,,2500, 60 months\nTotal 1: 3500,,,\nTotal 2: 0,,,\n"
    (tmp_path / "a.csv").write_text(text)
    (tmp_path / "b.csv").write_text(text)
    df = loan_csv.scan_loan_csv(spark, str(tmp_path))
    assert df.columns == header and df.count() == 8
    assert loan_csv.drop_note_rows(df).count() == 4
    literal = loan_csv.drop_note_rows(df, "literal")
    assert {r.id for r in literal.collect()} == {"Total 1: 3500", "Total 2: 0"}
    assert clean.amount_range(loan_csv.drop_note_rows(df), 1000, 2000).count() == 2


def test_zip_without_csv_is_an_error(spark, tmp_path):
    import zipfile

    with zipfile.ZipFile(tmp_path / "x.zip", "w") as z:
        z.writestr("readme.txt", "no table here")
    with pytest.raises(Exception, match="no CSV file"):
        loan_csv.scan_zip_csv(spark, str(tmp_path)).collect()


def test_versions_and_reports(spark, tmp_path):
    base = f"file:{tmp_path}"
    for n in range(4):
        tables.sink_table(spark.range(n + 1), base, "t", keep=2)
    assert tables.versions(spark, base, "t") == [3, 4]
    assert tables.scan_table(spark, base, "t").count() == 4
    df = spark.sql("SELECT 'a' AS f, map('x', 0.5D) AS m")
    tables.sink_report(df, base, "r", "csv")
    assert json.loads(tables.scan_table(spark, base, "r", fmt="csv").first()["m"]) == {"x": 0.5}
    with pytest.raises(FileNotFoundError):
        tables.scan_table(spark, base, "none")


def test_feature_generator_survives_saving(spark, tmp_path):
    df = spark.createDataFrame(
        [(10.0, 0.1, 0, 0.5), (30.0, 0.2, 0, 0.1)], "dti double, int_rate double, pub_rec int, revol_util double"
    )
    model = generate.FeatureGenerator(enableRatios=False).fit(df)
    model.write().overwrite().save(f"file:{tmp_path}/m")
    again = generate.FeatureGeneratorModel.load(f"file:{tmp_path}/m")
    want = model.transform(df).collect()
    assert again.transform(df).collect() == want
    # dti 0, constant pub_rec 0, revol_util 1 -> mean of three
    assert want[0].composite_risk_score == pytest.approx(1 / 3)
    assert want[0].dti_x_int_rate == pytest.approx(1.0)


def test_fill_scale_encode_edges(spark):
    df = spark.createDataFrame(
        [(1.0, None, "b", 5.0), (2.0, None, "a", 5.0), (None, None, None, 5.0), (9.0, None, "zz", 5.0)],
        "a double, empty double, c string, flat double",
    )
    assert impute.impute_mean(df, ["a", "empty"]).columns == ["a", "c", "flat"]
    assert impute.fit_median(df, ["a"]) == {"a": 2.0}
    assert impute.fit_mode(df, ["c"]) == {"c": "a"}
    for fit in (scale.fit_standard, scale.fit_minmax, scale.fit_robust):
        assert {r.flat for r in scale.apply_scales(df, fit(df, ["flat"])).collect()} == {0.0}
    known = df.where("c <> 'zz'")
    assert [r.c for r in encode.encode_ordinal(df.select("c"), ["c"], known).collect()] == [1, 0, -1, -1]
    one = encode.encode_onehot(df.select("c"), ["c"], known)
    assert one.columns == ["c_b"] and [r.c_b for r in one.collect()] == [1.0, 0.0, 0.0, 0.0]
    kept = {r.feature: r.kept for r in select.variance_threshold(df, ["a", "flat", "empty"]).collect()}
    assert kept == {"a": True, "flat": False, "empty": False}


def test_wide_categories_stay_whole(spark):
    df = spark.range(50).selectExpr("concat('v', id) AS c")
    codes = encode.fit_categories(df, "c", max_collected=10)
    found = {r.c: r.code for r in codes.collect()}
    assert [found[v] for v in sorted(found)] == list(range(50))
    wide = encode.encode_onehot(df, ["c"])
    assert len(wide.columns) == 50 and wide.distinct().count() == 50
    with pytest.raises(ValueError):
        encode.encode_onehot(df, ["c"], most=10)


def test_onehot_names_never_clash_or_need_quoting(spark):
    rows = [("b_c", "c", "x.y"), ("b", "d", "x`y"), ("e", "e", "100%")]
    df = spark.createDataFrame(rows, "a string, a_b string, `t.u` string")
    out = encode.encode_onehot(df, ["a", "a_b", "t.u"])
    assert len(set(out.columns)) == 9
    assert sorted(sum(r) for r in out.collect()) == [3.0, 3.0, 3.0]
    unseen = spark.createDataFrame([("zz", None, "x.y")], df.schema)
    found = encode.encode_onehot(unseen, ["a", "a_b", "t.u"], df).first()
    assert sum(found) == 1.0


def test_missing_moments_are_no_drift(spark):
    from riskloom.operators import drift

    ref = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0)], "a double, b double")
    cur = spark.createDataFrame([(None, 9.0)], "a double, b double")
    assert {r.feature: r.drift_score for r in drift.moment_drift(ref, cur).collect()} == {"a": 0.0, "b": 0.0}


def test_stored_preprocessing_of_odd_new_rows(spark, tmp_path):
    from riskloom.operators.preprocess import Preprocessor

    rows = [(f"r{i}", float(i % 5) if i % 4 else None, f"v.{i}", "AB"[i % 2], i % 2) for i in range(201)]
    fit_on = spark.createDataFrame(rows, "id string, x double, title string, grade string, loan_status int")
    new = spark.createDataFrame([("n1", None, "unseen", "Z"), ("n2", 2.0, None, None)], "id string, x double, title string, grade string")
    for how in ("median", "knn"):
        fitted = Preprocessor("id", how, "robust").fit(fit_on)
        fitted.save(f"file:{tmp_path}", how)
        out = Preprocessor.load(spark, f"file:{tmp_path}", how).transform(new)
        got = {r.id: r for r in out.collect()}
        assert len(out.columns) == 3 + 201 and got["n1"].grade == -1 and got["n2"].grade == 0
        assert sum(got["n1"][3:]) == 0 and sum(got["n2"][3:]) == 1
        assert got["n1"].x is not None and out.columns == fitted.transform(new).columns


def test_scope_leaves_the_work_folder_empty(spark):
    import os

    import __spark_entry__ as entry_points
    from riskloom import session

    folder = f"{session.work_root(spark)}/riskloom"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    for name in ("preprocess_new_rows", "split_stratified", "stream_drift", "reference_snapshot"):
        with session.scope(spark):
            entry_points.queries()[name](spark, "/root/testdata/sf0.001").collect()
    assert set(os.listdir(folder)) == before


def test_yeo_johnson_power(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    x = np.concatenate([rng.lognormal(size=400), -rng.random(50)])

    def transform(lam):
        up = np.where(x >= 0, x, 0)
        down = np.where(x < 0, x, 0)
        return np.where(x >= 0, ((up + 1) ** lam - 1) / lam, -((1 - down) ** (2 - lam) - 1) / (2 - lam))

    def likelihood(lam):
        return -len(x) / 2 * np.log(transform(lam).var()) + (lam - 1) * (np.sign(x) * np.log1p(np.abs(x))).sum()

    grid = np.arange(-1.99995, 1.99, 0.0003)
    best = grid[np.argmax([likelihood(g) for g in grid])]
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    power = scale.fit_yeo_johnson(df, ["x"])["x"]
    assert power == pytest.approx(best, abs=1e-3)
    out = np.array([r.x for r in scale.scale_yeo_johnson(df, ["x"]).collect()])
    assert out.mean() == pytest.approx(0, abs=1e-9) and out.std() == pytest.approx(1, abs=1e-9)


def test_approximate_percentiles_are_close(spark):
    df = spark.range(1001).selectExpr("CAST(id AS DOUBLE) AS x")
    exact = stats.numeric_stats(df).first()
    near = stats.numeric_stats(df, approximate=True).first()
    assert exact.median == 500.0 and abs(near.median - 500.0) <= 1.0
