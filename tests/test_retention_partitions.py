"""Partitions move as they are; nothing else is touched, and a run that stopped is finished."""

import glob
import os
from datetime import date, datetime

import pytest
from shortfall.operators import retention as RT

OPEN, CLOSED = datetime(2026, 3, 5), datetime(2026, 3, 20)


def files(path):
    return {os.path.relpath(f, path): os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/*=*/*.parquet")}


def table(spark, path, mode="overwrite", days=((2026, 1, 30), (2026, 2, 27), (2026, 3, 1), None)):
    rows = [(i, date(*d) if d else None) for i, d in enumerate(days)]
    spark.createDataFrame(rows, "k int, d date").coalesce(1).write.mode(mode).partitionBy("d").parquet(path)


def test_old_partitions_move_and_the_others_keep_their_files(spark, tmp_path):
    act, arch = f"{tmp_path}/act", f"{tmp_path}/arch"
    table(spark, act)
    before = files(act)
    assert RT.move_partitions(spark, act, arch, "d", CLOSED, (3, 10)) == {"archived": 0, "active": 4} and files(act) == before
    assert RT.move_partitions(spark, act, arch, "d", OPEN, (3, 10)) == {"archived": 2, "active": 2}
    assert {**files(act), **files(arch)} == before and len(files(arch)) == 2       # no file was written again
    assert RT.move_partitions(spark, act, arch, "d", OPEN, (3, 10)) == {"archived": 0, "active": 2}
    assert {**files(act), **files(arch)} == before
    table(spark, act, "append", days=((2026, 1, 30),))                             # late rows of an archived day
    assert RT.move_partitions(spark, act, arch, "d", OPEN, (3, 10)) == {"archived": 1, "active": 2}
    assert spark.read.parquet(arch).count() == 3 and set(before.items()) <= set({**files(act), **files(arch)}.items())


def test_a_run_that_stopped_is_finished_by_the_next(spark, tmp_path, monkeypatch):
    act, arch = f"{tmp_path}/act", f"{tmp_path}/arch"
    table(spark, act)
    real, moved = RT.move_folder, []

    def stop_at_second(spark_, source, target):
        if moved:
            raise OSError("lost")
        moved.append(source)
        real(spark_, source, target)

    monkeypatch.setattr(RT, "move_folder", stop_at_second)
    with pytest.raises(OSError):
        RT.move_partitions(spark, act, arch, "d", OPEN, (3, 10))
    monkeypatch.setattr(RT, "move_folder", real)
    assert spark.read.parquet(act).count() + spark.read.parquet(arch).count() == 4
    assert RT.move_partitions(spark, act, arch, "d", CLOSED, (3, 10)) == {"archived": 1, "active": 2}      # whatever its own gate
    assert spark.read.parquet(arch).count() == 2 and not os.path.exists(f"{arch}/_moving")


def test_a_table_is_rewritten_only_if_a_row_goes(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.createDataFrame([(1, datetime(2026, 3, 2)), (2, None)], "k int, ts timestamp").coalesce(1).write.parquet(path)
    before = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/*.parquet")}
    assert RT.purge_rows(spark.read.parquet(path), "ts", OPEN, (3, 10), path) == {"removed": 0, "kept": 2}
    assert RT.archive_rows(spark.read.parquet(path), "ts", OPEN, (3, 10), f"{tmp_path}/arch", path) == {"archived": 0, "active": 2}
    assert {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/*.parquet")} == before
    assert RT.purge_rows(spark.read.parquet(path), "ts", datetime(2026, 4, 4), (3, 10), path) == {"removed": 1, "kept": 1}
