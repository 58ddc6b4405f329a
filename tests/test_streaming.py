"""Feed arrivals through the incremental file source: each new file is
processed once, every file of a batch has its run, a rerun finds nothing new."""

import os
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from shortfall.plans import catalogue as CAT
from shortfall.plans import fixtures as X
from shortfall.sources import FEED_COLUMNS
from shortfall.streaming import default_checkpoint, ledger, run_on_arrivals


def _inputs(spark):
    data = CAT.inputs(spark, SF_SMALL)
    data.pop("feed")
    return data


def test_arrivals_processed_once(spark):
    root = tempfile.mkdtemp(prefix="shortfall-stream-")
    landing = os.path.join(root, "landing")
    feed = X.load(spark, SF_SMALL, "fx_feed").select(*FEED_COLUMNS)
    older = feed.filter(F.col("branch") == "F")
    newer = feed
    older.coalesce(1).write.option("header", True).csv(os.path.join(landing, "a"))
    time.sleep(1.2)
    newer.coalesce(1).write.option("header", True).csv(os.path.join(landing, "b"))
    ckpt = os.path.join(root, "ckpt")
    res = run_on_arrivals(spark, landing + "/*", _inputs, CAT.PARAMS, os.path.join(root, "out"), ckpt, process_frequency="weekly")
    assert [r["status"] for r in res] == ["SUCCESS"] * 2 and {r["batch_id"] for r in res} == {0}
    assert ["/a/" in res[0]["source_file"], "/b/" in res[1]["source_file"]] == [True, True]     # oldest first, none is lost
    for r, lines in zip(res, (older, newer)):
        report = spark.read.parquet(os.path.join(r["out_dir"], "report"))
        assert report.select("row_id").distinct().count() == lines.count()
        audit = spark.read.parquet(os.path.join(r["out_dir"], "run_audit")).collect()
        assert audit[0].task_status == "SUCCESS" and audit[0].row_count == lines.count()
    again = run_on_arrivals(spark, landing + "/*", _inputs, CAT.PARAMS, os.path.join(root, "out"), ckpt, process_frequency="weekly")
    assert again == []


def test_each_file_in_its_own_batch(spark):
    root = tempfile.mkdtemp(prefix="shortfall-stream2-")
    landing = os.path.join(root, "landing")
    feed = X.load(spark, SF_SMALL, "fx_feed").select(*FEED_COLUMNS)
    feed.filter(F.col("branch") == "F").coalesce(1).write.option("header", True).csv(os.path.join(landing, "a"))
    feed.filter(F.col("branch") == "O").coalesce(1).write.option("header", True).csv(os.path.join(landing, "b"))
    res = run_on_arrivals(spark, landing + "/*", _inputs, CAT.PARAMS, os.path.join(root, "out"),
                          os.path.join(root, "ckpt"), max_files_per_trigger=1, process_frequency="weekly")
    assert len(res) == 2 and all(r["status"] == "SUCCESS" for r in res)
    assert {os.path.basename(os.path.dirname(r["source_file"])) for r in res} == {"a", "b"}


def _land(feed, folder, drop=()):
    feed.drop(*drop).coalesce(1).write.option("header", True).csv(folder)
    time.sleep(1.2)                                             # modification times order the files


def _audits(spark, r):
    return spark.read.parquet(os.path.join(r["out_dir"], "run_audit")).collect()


def test_polling_ends_after_the_poll_that_passes_the_time_limit(spark):
    root = tempfile.mkdtemp(prefix="shortfall-stream3-")
    landing = os.path.join(root, "landing")
    feed = X.load(spark, SF_SMALL, "fx_feed").select(*FEED_COLUMNS)
    _land(feed, os.path.join(landing, "a"))
    res = run_on_arrivals(spark, landing + "/*", _inputs, CAT.PARAMS, os.path.join(root, "out"),
                          every="1 second", timeout_s=0.5, process_frequency="weekly")
    assert [r["status"] for r in res] == ["SUCCESS"]           # the poll that had begun was finished
    assert len(_audits(spark, res[0])) == 1
    again = run_on_arrivals(spark, landing + "/*", _inputs, CAT.PARAMS, os.path.join(root, "out"),
                            every="1 second", timeout_s=2.5, process_frequency="weekly")
    assert again == [] and len(_audits(spark, res[0])) == 1


def test_a_bad_file_does_not_hold_up_or_repeat_the_others(spark):
    root = tempfile.mkdtemp(prefix="shortfall-stream4-")
    landing, out = os.path.join(root, "landing"), os.path.join(root, "out")
    feed = X.load(spark, SF_SMALL, "fx_feed").select(*FEED_COLUMNS)
    _land(feed, os.path.join(landing, "a"))
    _land(feed, os.path.join(landing, "b"), drop=("vendor_item",))
    _land(feed, os.path.join(landing, "c"))
    res = run_on_arrivals(spark, landing + "/*", _inputs, CAT.PARAMS, out, attempts=2, process_frequency="weekly")
    assert [r["status"] for r in res] == ["SUCCESS", "FAIL", "SUCCESS"] and "vendor_item" in res[1]["error"]
    again = run_on_arrivals(spark, landing + "/*", _inputs, CAT.PARAMS, out, attempts=2, process_frequency="weekly")
    assert [(r["status"], r["source_file"]) for r in again] == [("FAIL", res[1]["source_file"])]          # its second and last run
    assert run_on_arrivals(spark, landing + "/*", _inputs, CAT.PARAMS, out, attempts=2, process_frequency="weekly") == []
    assert [len(_audits(spark, res[0])), len(_audits(spark, res[2]))] == [1, 1]
    assert sorted(r["status"] for r in ledger(spark, out).collect()) == ["FAIL", "FAIL", "SUCCESS", "SUCCESS"]


def test_a_replayed_batch_runs_only_what_was_not_finished(spark, monkeypatch):
    import shortfall.streaming as ST

    root = tempfile.mkdtemp(prefix="shortfall-stream5-")
    landing, out = os.path.join(root, "landing"), os.path.join(root, "out")
    feed = X.load(spark, SF_SMALL, "fx_feed").select(*FEED_COLUMNS)
    _land(feed, os.path.join(landing, "a"))
    _land(feed, os.path.join(landing, "b"))
    real, runs = ST._record, []

    def crash_in_second(spark_, out_dir, path, batch_id, out_, *rest):
        runs.append(out_)
        if len(runs) == 2:
            raise RuntimeError("the driver dies before the run is recorded")
        real(spark_, out_dir, path, batch_id, out_, *rest)

    monkeypatch.setattr(ST, "_record", crash_in_second)
    with pytest.raises(Exception, match="dies"):
        run_on_arrivals(spark, landing + "/*", _inputs, CAT.PARAMS, out, process_frequency="weekly")
    monkeypatch.setattr(ST, "_record", real)
    res = run_on_arrivals(spark, landing + "/*", _inputs, CAT.PARAMS, out, process_frequency="weekly")
    assert [r["source_file"].split("/")[-2] for r in res] == ["b"]
    for out_dir in runs:
        assert len(_audits(spark, {"out_dir": out_dir})) == 1


def test_each_run_has_its_own_time_limit(spark):
    root = tempfile.mkdtemp(prefix="shortfall-stream6-")
    landing, out = os.path.join(root, "landing"), os.path.join(root, "out")
    _land(X.load(spark, SF_SMALL, "fx_feed").select(*FEED_COLUMNS), os.path.join(landing, "a"))
    res = run_on_arrivals(spark, landing + "/*", _inputs, CAT.PARAMS, out, run_timeout_s=0.2, process_frequency="weekly")
    assert [r["status"] for r in res] == ["TIMEOUT"]
    assert [a.task_status for a in _audits(spark, res[0])] == ["TIMEOUT"]


def test_checkpoints_of_landing_folders_are_apart():
    assert default_checkpoint("/in/a", "/out") != default_checkpoint("/in/b", "/out") != default_checkpoint("/in/b", "/other")
