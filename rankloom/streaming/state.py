"""Running totals kept in stream state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

SLICES = 16


def running_totals(events: DataFrame, idle_ms: int | None = None, slices: int = SLICES) -> DataFrame:
    """Count and sum per (user, slice) since the start, emitted on change.

    Slices spread a busy user over tasks; readers add up the latest row of each
    slice. State of a slice without rows for ``idle_ms`` is dropped; without a
    limit it is kept for ever.
    """

    def add(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        n, total = state.get if state.exists else (0, 0.0)
        for batch in batches:
            n += len(batch)
            total += float(batch["value"].sum())
        state.update((n, total))
        if idle_ms is not None:
            state.setTimeoutDuration(idle_ms)
        yield pd.DataFrame({"user_id": [key[0]], "slice": [key[1]], "n": [n], "total": [total]})

    sliced = events.select("user_id", "value", F.pmod(F.xxhash64("event_id"), F.lit(slices)).alias("slice"))
    return sliced.groupBy("user_id", "slice").applyInPandasWithState(
        add,
        "user_id bigint, slice bigint, n bigint, total double",
        "n bigint, total double",
        "update",
        GroupStateTimeout.NoTimeout if idle_ms is None else GroupStateTimeout.ProcessingTimeTimeout,
    )


def latest_totals(emitted: DataFrame) -> DataFrame:
    """Per user: the last totals of each slice added up; counts only grow, so the largest is the last."""
    last = emitted.groupBy("user_id", "slice").agg(F.max(F.struct("n", "total")).alias("_t"))
    return last.groupBy("user_id").agg(F.sum("_t.n").alias("n"), F.sum("_t.total").alias("total"))
