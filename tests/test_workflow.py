from dataclasses import replace

from pyspark.sql import functions as F

from riskloom.operators.train import TreeParams
from riskloom.plans import workflow
from riskloom.sources import tables
from riskloom.sources.loan_view import loans


def test_whole_run_and_monitoring(spark, tmp_path):
    base = f"file:{tmp_path}"
    # a column that carries the label, so that there is something to learn
    signal = F.col("score_milli") * 7 + F.when(F.col("loan_status").isin("Charged Off", "Late (31-120 days)"), 3000).otherwise(0)
    raw = loans(spark, "/root/testdata/sf0.001").withColumn("signal", signal.cast("double")).drop("side", "score_milli")
    s = workflow.Settings(
        as_of="2005-01-01", imputation="median", select=False, params=TreeParams(rounds=4, max_depth=3)
    )
    built = workflow.build(raw, base, s)
    assert "signal" in built.features and "loan_to_income" in built.features
    found = built.reports["metrics"].first()
    assert found.roc_auc > 0.75
    assert built.reports["gate"].first().promote == (found.roc_auc >= 0.8)
    assert tables.versions(spark, base, "report_metrics") == [1]

    ready = tables.scan_table(spark, base, "features")
    same = workflow.monitor(built, base, ready.where("split = 'train'"), s)
    assert same["overall"].first().has_drift is False and same["concept"].first().has_drift is False
    moved = ready.where("split = 'test'").withColumn("signal", F.col("signal") + 2)
    # a stored model scores raw loans without a label, and treats labelled ones as the build did
    loaded = workflow.load_built(spark, base)
    new = raw.drop("loan_status").limit(200)
    scored = workflow.score_new(loaded, new, s).collect()
    assert len(scored) == 200 and all(0 <= r.probability <= 1 for r in scored)
    stored = {r.id: r.raw for r in tables.scan_table(spark, base, "scores").collect()}
    uncalibrated = workflow.score_new(replace(loaded, calibrator=None), new, s).collect()
    known = [r for r in uncalibrated if r.id in stored]
    assert known and all(abs(r.probability - stored[r.id]) < 1e-9 for r in known)
    monitored = workflow.monitor(loaded, base, workflow.ready(loaded, raw, s), s)
    assert monitored["overall"].first().has_drift is False and monitored["changes"].count() == 5
    alert = workflow.monitor(built, base, moved, s)["alert"].first()
    assert alert.alert and "signal" in alert.drifted_features
