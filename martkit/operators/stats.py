"""Size estimates from Catalyst's plan statistics (metadata only, no job)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate for ``df``, or None if it is unknown (no job).

    The statistic is read as a number from the optimised plan. It is unknown
    exactly where a leaf of the plan has Spark's default size (in-memory or
    RDD-backed frames); a product of known sizes, however large, is an
    estimate. Used only to decline work, such as a broadcast probe that could
    not succeed. It never grants a broadcast. A session that does not run in this
    process (Spark Connect) gives no estimate.
    """
    try:
        plan = df._jdf.queryExecution().optimizedPlan()
    except AttributeError:
        return None
    unknown = df.sparkSession._jsparkSession.sessionState().conf().defaultSizeInBytes()
    leaves = plan.collectLeaves()
    for i in range(leaves.size()):
        if int(str(leaves.apply(i).stats().sizeInBytes())) == unknown:
            return None
    return int(str(plan.stats().sizeInBytes()))
