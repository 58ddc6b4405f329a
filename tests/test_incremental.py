"""Maintained state equals the full computation, slice after slice."""

import random
import tempfile
from datetime import datetime, timedelta

import pytest
from conftest import SF_SMALL, rows
from shortfall import sources as S
from shortfall.operators import incremental as INC
from shortfall.operators.ordinal import latest_per_key
from shortfall.plans import catalogue as CAT
from shortfall.plans import fixtures as X

SCHEMA = "location string, item string, report_stamp timestamp, tie int, qty double"
HOW = (["location", "item"], "report_stamp", ("tie", "qty"))


def some_rows(rng, day, n=60):
    stamps = [None] + [datetime(2026, 1, 1) + timedelta(days=day - late) for late in (0, 0, 0, 1, 3)]       # late rows, and none
    return [(rng.choice("AB"), rng.choice([None, *"wxyz"]), rng.choice(stamps), rng.randrange(3), float(rng.randrange(9))) for _ in range(n)]


def test_five_days_merged_equal_the_full_scan(spark):
    rng = random.Random(1)
    days = [some_rows(rng, d, 40 if d else 1) for d in range(5)]
    state = None
    for day in days:
        state = INC.merge_latest(state, spark.createDataFrame(day, SCHEMA), *HOW)
    whole = spark.createDataFrame(sum(days, []), SCHEMA)
    assert rows(state) == rows(latest_per_key(whole, HOW[0], [HOW[1], *HOW[2]]))


def test_no_sort_before_the_first_exchange(spark):
    p = CAT.QUERIES["latest_inventory_merged"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString().splitlines()
    partial = [i for i, line in enumerate(p) if "HashAggregate" in line and "partial_max" in line]
    assert partial and not any("SortAggregate" in line for line in p)
    for i in partial:
        scan = next(k for k in range(i, len(p)) if "Scan parquet" in p[k])
        assert not any(" Sort " in line or "WindowGroupLimit" in line for line in p[i:scan])


def test_state_kept_from_a_growing_folder(spark):
    rng, root = random.Random(4), tempfile.mkdtemp(prefix="shortfall-state-")
    seen = []
    for day in range(4):
        new = some_rows(rng, day)
        seen += new
        spark.createDataFrame(new, SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/history")
        history = spark.readStream.schema(SCHEMA).parquet(f"{root}/history")
        state = INC.maintain_latest(history, f"{root}/state", *HOW, prepare=lambda batch: batch.where("location = 'A'"))
        whole = spark.createDataFrame(seen, SCHEMA).where("location = 'A'")
        assert rows(state) == rows(latest_per_key(whole, HOW[0], [HOW[1], *HOW[2]]))
    assert len(INC._versions(spark, f"{root}/state")) == 2
    again = INC.maintain_latest(spark.readStream.schema(SCHEMA).parquet(f"{root}/history"), f"{root}/state", *HOW)
    assert rows(again) == rows(state)                          # nothing new: nothing merged


AS_OF = [datetime(2024, 1, 25), datetime(2024, 1, 20, 13, 45), datetime(2024, 1, 31, 23, 59, 59)]


@pytest.mark.parametrize("window", [14, 0])
def test_rolling_usage_equals_the_direct_query(spark, window):
    usage = X.load(spark, SF_SMALL, "fx_usage")
    days = INC.daily_usage(S.located_usage(usage, CAT.PARAMS.locations))
    for as_of in AS_OF:
        direct = S.avg_daily_issue(usage, CAT.PARAMS.locations, as_of, window, 365)
        assert rows(INC.usage_from_days(days, S.located_usage(usage, CAT.PARAMS.locations), as_of, window, 365)) == rows(direct)


def test_daily_sums_kept_from_a_growing_folder(spark):
    root = tempfile.mkdtemp(prefix="shortfall-days-")
    schema = "location string, item string, qty double, trx_date timestamp"
    rng, seen = random.Random(8), []
    for run in range(3):
        new = [(rng.choice("AB"), rng.choice("xyz"), rng.choice([None, 1.0, 5.0]), datetime(2026, 1, 1) + timedelta(hours=rng.randrange(24 * (3 + run)))) for _ in range(50)]
        seen += new
        spark.createDataFrame(new, schema).coalesce(1).write.mode("append").parquet(f"{root}/usage")
        days = INC.maintain_daily_usage(spark.readStream.schema(schema).parquet(f"{root}/usage"), f"{root}/state")
        usage, as_of = spark.createDataFrame(seen, schema), datetime(2026, 1, 3 + run, 7)
        got = INC.usage_from_days(days, usage, as_of, 2)
        assert rows(got) == rows(S.avg_daily_issue(usage, ["A", "B"], as_of, 2))
    plan = days.where("day = DATE'2026-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
