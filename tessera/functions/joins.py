"""Join helpers with an explicit size check before broadcasting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest row count we broadcast on our own; beyond it the join shuffles (and
# AQE may still pick a broadcast from measured stage sizes).
BROADCAST_MAX_ROWS = 200_000


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                      bound: int | None = None) -> DataFrame:
    """``F.broadcast(df)`` where ``bound``, a number of rows that the caller can
    prove from the plan (a ``limit``, a fixed label set), is at most ``max_rows``.

    Without a bound ``df`` stays as it is: AQE measures the side as it is
    shuffled and broadcasts it below ``spark.sql.autoBroadcastJoinThreshold``
    bytes.  Nothing is counted or kept while the plan is built.
    """
    return F.broadcast(df) if bound is not None and bound <= max_rows else df
