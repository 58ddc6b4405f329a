"""The end-to-end job with its sinks: report (partitioned, overwrite of the
batch's partition), side output only when non-empty, audit rows for SUCCESS
and FAIL."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from shortfall.plans import catalogue as CAT
from shortfall.plans import fixtures as X
from shortfall.plans.job import run_job


def test_run_job_writes_sinks(spark):
    out = tempfile.mkdtemp(prefix="shortfall-job-")
    res = run_job(CAT.inputs(spark, SF_SMALL), CAT.PARAMS, process_frequency="weekly", out_dir=out, source_file_path=None)
    assert res["status"] == "SUCCESS"
    report = spark.read.parquet(os.path.join(out, "report"))
    assert [r.snapshot_date.isoformat() for r in report.select("snapshot_date").distinct().collect()] == ["1998-06-15"]
    n = report.count()
    assert n == CAT.QUERIES["final_report"](spark, SF_SMALL).count()
    assert res["side_output"] == os.path.isdir(os.path.join(out, "uom_inconsistency"))
    audit = spark.read.parquet(os.path.join(out, "run_audit")).collect()
    assert len(audit) == 1 and audit[0].task_status == "SUCCESS" and audit[0].source_file_path == ""
    assert res["output_rows"] == n and (res["side_rows"] > 0) == res["side_output"]
    # a rerun replaces the batch's partition instead of appending to it
    run_job(CAT.inputs(spark, SF_SMALL), CAT.PARAMS, process_frequency="weekly", out_dir=out)
    assert spark.read.parquet(os.path.join(out, "report")).count() == n
    assert spark.read.parquet(os.path.join(out, "run_audit")).count() == 2


def test_run_job_failure_is_audited(spark):
    out = tempfile.mkdtemp(prefix="shortfall-job-fail-")
    data = CAT.inputs(spark, SF_SMALL)
    data["feed"] = data["feed"].withColumn("duration", F.lit("not a number"))
    with pytest.raises(Exception):
        run_job(data, CAT.PARAMS, process_frequency="weekly", out_dir=out)
    audit = spark.read.parquet(os.path.join(out, "run_audit")).collect()
    assert len(audit) == 1 and audit[0].task_status == "FAIL" and "duration" in audit[0].error
    assert audit[0].row_count == 0          # failed while reading the feed


def test_late_failure_keeps_feed_row_count(spark):
    out = tempfile.mkdtemp(prefix="shortfall-job-fail2-")
    data = CAT.inputs(spark, SF_SMALL)
    data["feed"] = data["feed"].withColumn(
        "est_delivery_date", F.when(F.col("customer_material_number") == "3", F.lit("soon"))
        .otherwise(F.col("est_delivery_date")))
    with pytest.raises(Exception):
        run_job(data, CAT.PARAMS, process_frequency="weekly", out_dir=out)
    audit = spark.read.parquet(os.path.join(out, "run_audit")).collect()
    assert audit[0].task_status == "FAIL" and audit[0].row_count == X.load(spark, SF_SMALL, "fx_feed").count()


def test_run_job_releases_pins(spark):
    import glob
    from shortfall.session import ensure_checkpoint_dir
    base = ensure_checkpoint_dir(spark).replace("file:", "").rstrip("/") + "/pins"
    before = set(glob.glob(base + "/*"))
    run_job(CAT.inputs(spark, SF_SMALL), CAT.PARAMS, process_frequency="weekly", out_dir=tempfile.mkdtemp(prefix="shortfall-job-rel-"))
    assert set(glob.glob(base + "/*")) == before


def test_empty_rerun_replaces_report_and_side_output(spark):
    out = tempfile.mkdtemp(prefix="shortfall-job-empty-rerun-")
    run_job(CAT.inputs(spark, SF_SMALL), CAT.PARAMS, out, process_frequency="weekly")
    data = CAT.inputs(spark, SF_SMALL)
    data["feed"], data["inventory"] = data["feed"].limit(0), data["inventory"].limit(0)
    res = run_job(data, CAT.PARAMS, out, process_frequency="weekly")
    assert res["output_rows"] == 0 and res["side_output"] is False
    assert spark.read.parquet(os.path.join(out, "report")).count() == 0
    assert not os.path.isdir(os.path.join(out, "uom_inconsistency", "snapshot_date=1998-06-15"))
    audit = spark.read.parquet(os.path.join(out, "run_audit")).orderBy("last_run_time").collect()
    assert [r.row_count for r in audit][1] == 0


def test_missing_column_is_refused_and_audited(spark):
    out = tempfile.mkdtemp(prefix="shortfall-job-columns-")
    data = CAT.inputs(spark, SF_SMALL)
    data["feed"] = data["feed"].drop("duration", "parent_item")
    with pytest.raises(ValueError, match="duration, parent_item"):
        run_job(data, CAT.PARAMS, out, process_frequency="weekly")
    assert spark.read.parquet(os.path.join(out, "run_audit")).first().task_status == "FAIL"


@pytest.mark.parametrize("fails", [False, True])
def test_maintenance_runs_after_success_and_failure(spark, fails):
    from datetime import datetime
    from shortfall.plans.job import monthly_maintenance
    out, done = tempfile.mkdtemp(prefix="shortfall-job-upkeep-"), []
    run_job(CAT.inputs(spark, SF_SMALL), CAT.PARAMS, out, process_frequency="weekly")
    rows = spark.read.parquet(os.path.join(out, "report")).count()
    data = CAT.inputs(spark, SF_SMALL)
    if fails:
        data["feed"] = data["feed"].withColumn("duration", F.lit("not a number"))
    upkeep = monthly_maintenance(spark, out, datetime(1998, 7, 5), (3, 10), done)
    try:
        run_job(data, CAT.PARAMS, out, process_frequency="weekly", maintenance=upkeep)
        assert not fails
    except Exception:
        assert fails
    assert done[0]["gate"] == "open" and done[0]["archive"] == {"archived": rows, "active": 0}
    assert done[0]["purge"] == {"removed": 0, "kept": 2}
    assert spark.read.parquet(os.path.join(out, "report_archive")).count() == rows
    closed = []
    monthly_maintenance(spark, out, datetime(1998, 7, 15), (3, 10), closed)()
    assert closed == [{"gate": "closed"}]


def test_run_latest_arrival_picks_the_file_or_raises(spark):
    from datetime import datetime
    from shortfall.plans.job import run_latest_arrival
    arrivals = spark.createDataFrame(
        [(i, "f", "weekly view", "inbox", "file", f"shortage_{i}.xlsx", datetime(2026, 3, 17, 10 + i), 0) for i in range(2)],
        "message_id long, feed string, subject string, folder string, attachment_type string, file_name string, received_at timestamp_ntz, attachment_pos int")
    data, seen = CAT.inputs(spark, SF_SMALL), []
    feed = data.pop("feed")

    def load(name):
        seen.append(name)
        return feed.limit(0)

    kwargs = dict(as_of=datetime(2026, 3, 18), keyword="view", prefix="shortage", process_frequency="weekly")
    out = tempfile.mkdtemp(prefix="shortfall-job-arrival-")
    assert run_latest_arrival(arrivals, "f", load, data, CAT.PARAMS, out, **kwargs)["status"] == "SUCCESS" and seen == ["shortage_1.xlsx"]
    assert spark.read.parquet(os.path.join(out, "run_audit")).first().source_file_path == "shortage_1.xlsx"
    with pytest.raises(FileNotFoundError):
        run_latest_arrival(arrivals, "other", load, data, CAT.PARAMS, out, **kwargs)


def test_null_key_report(spark):
    from shortfall.operators.coverage import null_key_report
    st = CAT.stages(spark, SF_SMALL)
    r = null_key_report(st["feed"], st["enriched_inventory"]).collect()[0]
    assert r.feed_null_keys == st["feed"].filter("vendor_item IS NULL").count()
    assert r.null_key_pairs == r.feed_null_keys * r.inventory_null_keys


def test_stored_counters_match_aggregates(spark):
    out = tempfile.mkdtemp(prefix="shortfall-job-obs-")
    run_job(CAT.inputs(spark, SF_SMALL), CAT.PARAMS, process_frequency="weekly", out_dir=out)
    audit = spark.read.parquet(os.path.join(out, "run_audit")).collect()[0]
    assert audit.row_count == X.load(spark, SF_SMALL, "fx_feed").distinct().count()


def test_empty_feed_runs(spark):
    out = tempfile.mkdtemp(prefix="shortfall-job-empty-")
    data = CAT.inputs(spark, SF_SMALL)
    data["feed"] = data["feed"].limit(0)
    res = run_job(data, CAT.PARAMS, process_frequency="weekly", out_dir=out)
    assert res["status"] == "SUCCESS"
    audit = spark.read.parquet(os.path.join(out, "run_audit")).collect()[0]
    assert audit.row_count == 0


def test_feed_without_packaging_runs(spark):
    data = CAT.inputs(spark, SF_SMALL)
    data["feed"] = data["feed"].withColumn("packaging_string", F.lit(None).cast("string"))
    st = CAT.build_stages(data, CAT.PARAMS)
    assert st["conversions"].count() == 0
    rep = st["report"]
    assert rep.count() == st["full"].count()
    assert rep.filter("alt_uom_group IS NOT NULL").count() == 0


def test_timeout_is_audited(spark):
    out = tempfile.mkdtemp(prefix="shortfall-job-timeout-")
    with pytest.raises(Exception):
        run_job(CAT.inputs(spark, SF_SMALL), CAT.PARAMS, process_frequency="weekly", out_dir=out, timeout_s=0.5)
    audit = spark.read.parquet(os.path.join(out, "run_audit")).collect()
    assert len(audit) == 1 and audit[0].task_status == "TIMEOUT"
    # the session is usable afterwards
    assert CAT.QUERIES["item_description"](spark, SF_SMALL).count() > 0
