"""shortfall -- supply-shortage coverage analytics on Spark.

Composable DataFrame -> DataFrame operators that find the items which run out
before the vendor recovers and recommend what to order instead:

* ``shortfall.sources``    scans of the feed and inventory-side tables
* ``shortfall.operators``  reconciliation, coverage, substitutes, groups,
                           recommendations, units of measure, report, audit,
                           retention and the order-dependent helpers
* ``shortfall.functions``  shared column expressions (NULL / NaN / inf rules)
* ``shortfall.plans``      the end-to-end job, test fixtures, query catalogue
* ``shortfall.streaming``  feed arrivals as an incremental file source
"""

from shortfall.plans.job import Params, Stages, build_stages, run_job

__all__ = ["Params", "Stages", "build_stages", "run_job"]
