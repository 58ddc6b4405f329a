"""C10 -- the end-to-end coverage job as a DataFrame graph.

``build_stages`` returns a ``Stages`` object that builds each named stage on
first use; stages read by several plans (or costly to recompute) are written
once as Parquet when first requested, the rest stay lazy. ``run_job``
materialises the sinks: the report (K1), the UOM-inconsistency side output
(K2) and the audit row (K3). A failure still appends a FAIL (or TIMEOUT)
audit row, then re-raises.
"""

from __future__ import annotations

import logging
import threading
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shortfall import sources as S
from shortfall.operators import audit as A
from shortfall.operators import coverage as C
from shortfall.operators import demand as D
from shortfall.operators import enrich as E
from shortfall.operators import groups as G
from shortfall.operators import itemside as IS
from shortfall.operators import recommend as R
from shortfall.operators import reconcile as RC
from shortfall.operators import report as RP
from shortfall.operators import retention as RT
from shortfall.operators import uom as U
from shortfall.session import drop_folder, pin, pin_folder

log = logging.getLogger("shortfall.job")


@dataclass(frozen=True)
class Params:
    coverage_as_of: datetime
    usage_as_of: datetime
    freshness_as_of: datetime
    locations: Sequence[str] = ("A", "B")
    secondary_location: str = "B"
    usage_window_days: int = 366
    usage_divisor: int = 365
    freshness_days: int = 10
    # Production defaults of the business rules.
    excluded_stages: Sequence[str] = ("Deleted", "Completed", "Pending Item Number")
    risk_levels: Sequence[str] = ("High", "Severe")
    duration_threshold: float = 3.0
    review_threshold: float = -10.0
    inventory_tie_break: Sequence[str] = ()
    row_order: Sequence[str] = ("customer_material_number",)
    # write multi-use intermediates once (see ``shortfall.session.pin``)
    pin_stages: bool = True
    # NULL join keys (J4-J10) match nothing ("drop") or each other ("match")
    null_keys: str = "drop"
    # leave out what the feed cannot reach ahead of the report's aggregates (see ``operators.demand``)
    reduce_to_feed: bool = True
    # e.g. "UTF8_LCASE" when the source database compares locations case-insensitively
    location_collation: str | None = None


def prepare_feed(raw_feed: DataFrame, p: Params, folder: str | None = None) -> DataFrame:
    """S1/D1 dedup, P1 selection, W2 row ids.

    Row ids follow ``row_order``, then a digest of the whole line: the lines are
    distinct after the dedup, so the order is total (stable ids), a hot or
    NULL order key still spreads over the range partitions, and the range
    keys that Spark samples stay narrow."""
    feed = S.dedup_feed(raw_feed)
    feed = C.risk_selection(feed, p.risk_levels, p.duration_threshold)
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\u0001")) for c in feed.columns]
    feed = feed.withColumn("_line", F.md5(F.concat_ws("\u0002", *parts)))
    return C.assign_row_ids(feed, [*[F.col(c).asc_nulls_first() for c in p.row_order], F.col("_line").asc()], folder=folder).drop("_line")


class Stages:
    """The job graph with every stage built on first use (memoised), so a
    caller asking for one table plans only what that table needs."""

    def __init__(self, inputs: dict[str, DataFrame], p: Params, feed: DataFrame | None = None):
        self.inputs = inputs
        self.p = p
        self._cache: dict[str, DataFrame] = {}
        self._pins: str | None = None
        self._replaced: set[str] = set()
        if feed is not None:
            self._cache["feed"] = feed

    # Stages written once (``pin``): read by several plans, or expensive to
    # recompute (the snapshot history and usage scans behind them). Small
    # stages read once per plan (reconciled inventory, conversion map) stay
    # lazy; Spark reuses their exchanges within a plan.
    PINNED = ("latest_inventory", "reconciled_usage", "feed_filter", "demand_latest", "demand_usage", "demand_reconciled",
              "linked", "conversion_tuples")
    # Replaced by a caller, these are taken as they are: nothing is reduced beside them.
    UNREDUCED = ("avg_daily_issue", "reconciled_inventory", "reconciled_usage", "reconciled_secondary_items", "enriched_inventory", "substitutes")
    # The stages of ``null_keys="match"``, where the feed is joined to one table after another.
    PINNED_IF_MATCHING = ("feed_with_substitutes", "full")
    # What the item side adds to a row beyond the substitutes.
    GROUP_COLUMNS = (*IS.GROUP_METRICS, "coverage_gap_ig", "review_flag_ig")

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            df = getattr(self, f"_build_{name}")()
            if self.p.pin_stages and (name in self.PINNED or self._matching and name in self.PINNED_IF_MATCHING):
                df = pin(df, name, self.pin_folder())
            self._cache[name] = df
        return self._cache[name]

    @property
    def _matching(self) -> bool:
        return self.p.null_keys == "match"

    def set(self, name: str, df: DataFrame) -> None:
        """Replace a stage before anything downstream is built from it."""
        self._cache[name] = df
        self._replaced.add(name)

    @property
    def _reducing(self) -> bool:
        """The filter is read by two pinned stages only, so that no later plan carries it."""
        return self.p.reduce_to_feed and self.p.pin_stages and not self._matching and not self._replaced & set(self.UNREDUCED)

    def pin_folder(self) -> str:
        """This run's folder for pinned stages (created on first use)."""
        if self._pins is None:
            self._pins = pin_folder(next(iter(self.inputs.values())).sparkSession)
        return self._pins

    def release(self) -> None:
        """Delete this run's pinned stages (call after the last action)."""
        if self._pins is not None:
            drop_folder(next(iter(self.inputs.values())).sparkSession, self._pins)
            self._pins = None
            self._cache.clear()

    def _reconciled(self) -> dict[str, DataFrame]:
        if "_rec" not in self.__dict__:
            self._rec = RC.reconcile_locations(self["latest_inventory"], self["avg_daily_issue"],
                                               self["group_usage"], self.p.secondary_location)
        return self._rec

    def _build_feed(self):
        return prepare_feed(self.inputs["feed"], self.p, folder=self.pin_folder())

    def _build_latest_inventory(self):
        return S.latest_inventory(self.inputs["inventory"], self.p.locations, self.p.inventory_tie_break,
                                  columns=S.JOB_INVENTORY_COLUMNS, collation=self.p.location_collation)

    def _build_avg_daily_issue(self):
        p = self.p
        return S.avg_daily_issue(self.inputs["usage"], p.locations, p.usage_as_of,
                                 p.usage_window_days, p.usage_divisor, p.location_collation)

    def _build_group_usage(self):
        return S.group_usage(self.inputs["group_usage"], self.p.locations, self.p.location_collation)

    def _build_reconciled_inventory(self):
        return self._reconciled()["inventory"]

    def _build_reconciled_usage(self):
        return self._reconciled()["usage"]

    def _build_reconciled_group_usage(self):
        return self._reconciled()["group_usage"]

    def _build_reconciled_uom_inconsistency(self):
        return self._reconciled()["uom_inconsistency"]

    def _build_reconciled_secondary_items(self):
        return self._reconciled()["secondary_items"]

    def _build_descriptions(self):
        return S.item_descriptions(self.inputs["descriptions"])

    def _build_enriched_inventory(self):
        return E.enrich_inventory(self["reconciled_inventory"], self["reconciled_usage"], self["descriptions"],
                                  self["reconciled_secondary_items"], self.p.null_keys)

    def _build_active_links(self):
        return S.active_links(self.inputs["links"], self.p.excluded_stages)

    def _build_substitutes(self):
        return E.build_substitutes(self["active_links"], self["reconciled_inventory"],
                                   self["reconciled_usage"], self["descriptions"], self.p.null_keys)

    def _build_coverage(self):
        matched = C.match_inventory(self["feed"], self["enriched_inventory"], self.p.null_keys)
        return C.coverage_metrics(matched, self.p.coverage_as_of, self.p.review_threshold)

    def _build_feed_filter(self):
        return D.bloom_filter(D.needed_items(self["feed"], self["latest_inventory"], self["active_links"]))

    def _build_demand_latest(self):
        return D.keep_needed(self["latest_inventory"], self["feed_filter"])

    def _demand(self) -> dict[str, DataFrame]:
        """C1 over the items that the feed can reach (the side output K2 takes the whole tables)."""
        if "_dem" not in self.__dict__:
            p = self.p
            usage = S.avg_daily_issue(D.keep_needed(self.inputs["usage"], self["feed_filter"]), p.locations, p.usage_as_of,
                                      p.usage_window_days, p.usage_divisor, p.location_collation)
            self._dem = RC.reconcile_locations(self["demand_latest"], usage, self["group_usage"], p.secondary_location)
        return self._dem

    def _build_demand_usage(self):
        return self._demand()["usage"]

    def _build_demand_reconciled(self):
        return self._demand()["inventory"]

    def _build_demand_inventory(self):
        return E.enrich_inventory(self["demand_reconciled"], self["demand_usage"], self["descriptions"], self._demand()["secondary_items"], self.p.null_keys)

    def _build_demand_substitutes(self):
        return E.build_substitutes(self["active_links"], self["demand_reconciled"], self["demand_usage"], self["descriptions"], self.p.null_keys)

    def _build_feed_items(self):
        return IS.feed_items(self["feed"], self["demand_inventory" if self._reducing else "enriched_inventory"])

    @property
    def _links(self) -> DataFrame:
        """Substitutes for the item side: links of items that the feed cannot reach may lack their replacement's values."""
        return self["demand_substitutes" if self._reducing else "substitutes"]

    def _build_linked(self):
        """The feed's items with their substitutes, read by the group quantities, the metrics and the alternatives."""
        return IS.linked_items(self["feed_items"], self._links)

    def _build_item_side(self):
        return IS.item_side(self["linked"], self["reconciled_group_usage"], self["conversions"])

    def _build_covered(self):
        """Feed lines joined once to the nested item side; alternatives as arrays."""
        return IS.join_feed(self["feed"], self["item_side"], self.p.coverage_as_of, self.p.review_threshold)

    def _build_feed_with_substitutes(self):
        if self._matching:
            return C.merge_substitutes(self["coverage"], self["substitutes"], self.p.null_keys)
        return self["covered"].drop("alts", *self.GROUP_COLUMNS)

    def _build_group_quantities(self):
        members = self["feed_with_substitutes"] if self._matching else self["linked"]
        return G.group_quantities(members, self["reconciled_group_usage"])

    def _build_group_coverage(self):
        return G.group_coverage(self["feed_with_substitutes"], self["group_quantities"], self.p.review_threshold)

    def _build_full(self):
        if self._matching:
            return G.full_dataset(self["feed_with_substitutes"], self["group_quantities"], self.p.review_threshold)
        return self["covered"].drop("alts")

    def _build_review(self):
        return R.review_recommendations(self["full"], self.p.review_threshold)

    def _build_packaging(self):
        return U.parse_packaging(self["feed"], carry=["row_id"])

    def _build_conversion_tuples(self):
        # many lines of an item have one packaging: each is parsed once
        return U.conversion_tuples(U.parse_packaging(self["feed"].select("vendor_item", "packaging_string").distinct()))

    def _build_conversions(self):
        return U.build_conversions(tuples=self["conversion_tuples"])

    def _build_unresolved_uom(self):
        return U.unresolved_uom(self["review"], self["conversions"])

    def _build_uom_alternatives(self):
        if self._matching:
            return U.uom_alternatives(self["review"], self["conversions"])
        review = R.review_recommendations(self["covered"], self.p.review_threshold, carry=("alts",))
        return U.unfold_alternatives(review).select(*U.REVIEW_ALT_COLUMNS)

    def _build_freshness(self):
        # same value as S.inventory_freshness on the raw history (see
        # freshness_from_latest), read from the small pinned snapshot
        return S.freshness_from_latest(self["latest_inventory"], self.p.freshness_as_of, self.p.freshness_days)

    def _build_report(self):
        return assemble_report(self, self.p)


def build_stages(inputs: dict[str, DataFrame], p: Params, feed: DataFrame | None = None) -> Stages:
    """Wire the whole job lazily. ``inputs`` keys: feed, inventory, usage,
    descriptions, links, group_usage. ``feed`` may be a prepared feed."""
    return Stages(inputs, p, feed)


def assemble_report(st: Stages, p: Params) -> DataFrame:
    """Recommendations and alternatives on review rows, secondary-location
    flag, freshness stamp, fixed column order and display columns."""
    review = F.col("review_flag") == "Review"
    if p.null_keys == "match":
        full = R.with_recommendations(st["full"], p.review_threshold)
        out = U.attach_alternatives(full, U.alternative_table(st["review"], st["conversions"]), condition=review)
    else:
        out = U.unfold_alternatives(R.with_recommendations(st["covered"], p.review_threshold), condition=review)
    # set per item on the inventory side; unmatched feed rows have no item -> 'No'
    out = out.withColumn("in_secondary_location", F.coalesce(F.col("in_secondary_location"), F.lit("No")))
    out = RP.attach_stamp(out, st["freshness"])
    out = RP.coerce_report_types(RP.reorder_columns(out))
    return RP.display_columns(out, p.review_threshold)


def run_job(inputs: dict[str, DataFrame], p: Params, out_dir: str, *, process_name: str = "shortfall",
            process_id: str = "1", source_file_path: str = "", package_path: str = "",
            log_file_path: str = "", process_frequency: str,
            timeout_s: float | None = None, maintenance: Callable[[], dict] | None = None) -> dict:
    """Materialise report, side output and audit row under ``out_dir``.

    The feed must have every raw report column. ``maintenance`` (see
    :func:`monthly_maintenance`) runs last, after success and failure alike.

    With ``timeout_s`` the run's Spark jobs form one job group that is
    cancelled when the time is up; the audit row then says TIMEOUT.
    """
    start = datetime.now()
    t0 = time.monotonic()
    st = None
    pinned_feed = None
    spark = inputs["feed"].sparkSession
    timer, timed_out, finished = None, threading.Event(), threading.Event()
    group_keys = ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel")
    caller = {}
    if timeout_s is not None:
        caller = {k: spark.sparkContext.getLocalProperty(k) for k in group_keys}
        group = f"shortfall-{uuid.uuid4().hex}"
        spark.sparkContext.setJobGroup(group, f"{process_name} run", interruptOnCancel=True)

        def _watch():
            if finished.wait(timeout_s):
                return
            timed_out.set()
            # cancelling only stops running jobs: keep cancelling the group
            # so that jobs the driver starts later fail too
            while not finished.is_set():
                spark.sparkContext.cancelJobGroup(group)
                finished.wait(0.1)

        timer = threading.Thread(target=_watch, daemon=True)
        timer.start()
    try:
        S.validate_columns(inputs["feed"], "report")
        st = build_stages(inputs, p)
        pinned_feed = st["feed"]
        snapshot = p.coverage_as_of.date()
        output_rows = RP.write_report(RP.sort_report(st["report"]), f"{out_dir}/report", snapshot)
        side_rows = RP.write_inconsistency(RC.sort_inconsistency_rows(st["reconciled_uom_inconsistency"]),
                                           f"{out_dir}/uom_inconsistency", snapshot)
        counts = {**A.feed_counters(pinned_feed), "output_rows": output_rows}
        counters = A.counters_frame(spark, counts)
        row = A.audit_row(counters, process_name=process_name, process_id=process_id,
                          source_file_path=source_file_path, last_run_time=start, task_status="SUCCESS",
                          duration_seconds=time.monotonic() - t0, package_path=package_path,
                          log_file_path=log_file_path, process_frequency=process_frequency)
        A.append_audit(row, f"{out_dir}/run_audit")
        return {"status": "SUCCESS", "side_output": bool(side_rows), "side_rows": side_rows, **counts}
    except Exception as exc:
        if timer is not None:
            finished.set()
            timer.join()
            spark.sparkContext.setJobGroup("shortfall-audit", "audit", interruptOnCancel=False)
        status = "TIMEOUT" if timed_out.is_set() else "FAIL"
        rows = 0
        if pinned_feed is not None:          # the feed was read: report its size
            try:
                rows = pinned_feed.count()
            except Exception:  # noqa: BLE001 - the audit row must still be written
                rows = 0
        counters = spark.range(1).select(F.lit(rows).cast("bigint").alias("feed_rows"))
        row = A.audit_row(counters, process_name=process_name, process_id=process_id,
                          source_file_path=source_file_path, last_run_time=start, task_status=status,
                          duration_seconds=time.monotonic() - t0, package_path=package_path,
                          log_file_path=log_file_path, process_frequency=process_frequency,
                          error=str(exc))
        A.append_audit(row, f"{out_dir}/run_audit")
        exc.timed_out = status == "TIMEOUT"
        raise
    finally:
        if timer is not None:
            finished.set()
            timer.join()
            for key, value in caller.items():
                spark.sparkContext.setLocalProperty(key, value)   # leave the thread as it was
        if st is not None:
            st.release()
        if maintenance is not None:
            try:
                maintenance()
            except Exception:  # noqa: BLE001 - must not hide the run's outcome
                log.exception("maintenance failed")


def monthly_maintenance(spark: SparkSession, out_dir: str, as_of: datetime,
                        day_range: tuple[int, int], results: list | None = None) -> Callable[[], dict]:
    """The upkeep of a run's own outputs: purge ``run_audit`` and move old snapshots of ``report``
    to ``report_archive``. Pass it as ``run_job(maintenance=...)``; ``results`` collects the outcome."""
    def upkeep() -> dict:
        if not RT.gate_open(as_of, day_range):
            done: dict = {"gate": "closed"}
        else:
            done = {"gate": "open"}
            tasks = {
                "purge": lambda: RT.purge_rows(spark.read.parquet(f"{out_dir}/run_audit"), "last_run_time", as_of, day_range, f"{out_dir}/run_audit"),
                "archive": lambda: RT.move_partitions(spark, f"{out_dir}/report", f"{out_dir}/report_archive", "snapshot_date", as_of, day_range),
            }
            for name, task in tasks.items():
                try:
                    done[name] = task()
                except Exception as exc:  # noqa: BLE001 - one task failing does not stop the other
                    log.exception("maintenance task %s failed", name)
                    done[name] = f"failed: {exc}"
        if results is not None:
            results.append(done)
        return done

    return upkeep


def run_latest_arrival(arrivals: DataFrame, feed: str, load: Callable[[str], DataFrame], inputs: dict[str, DataFrame],
                       p: Params, out_dir: str, *, as_of: datetime, keyword: str, prefix: str,
                       pick: dict | None = None, **job_kwargs) -> dict:
    """The scheduled run: pick the newest feed file of ``feed`` among the arrivals (raise when there
    is none), load it by name and run the job on it."""
    chosen = S.require_arrival(S.latest_arrival(arrivals, as_of, keyword, prefix, **(pick or {})), feed).first()
    return run_job({**inputs, "feed": load(chosen["file_name"])}, p, out_dir, source_file_path=chosen["file_name"], **job_kwargs)
