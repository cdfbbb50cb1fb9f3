"""An alarm when a key falls silent: keyed state with event-time timers.

No window tells "nothing has come for so long" while it is still true; here each key holds its runs of events without
a silence between them, as first and last event, and a timer is set for the moment when silence is certain. A key that
has raised its alarm holds nothing until its next event.

A call into the state store costs far more than an event, so keys share a state: each slice of keys has one, and one timer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from rankloom.streaming.windows import LATE

#: Keyed state with timers needs this store.
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
#: Slices of keys if none are named; and how many events of a whole stream a slice should have.
SLICES, SLICE_EVENTS = 64, 10_000
#: The slice of rows without a key or a time.
NOBODY = -1


def merged(keys: np.ndarray, first: np.ndarray, last: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, first, last) of the runs that pieces of runs make up: pieces of a key at most ``gap`` apart are one run."""
    codes = pd.factorize(keys)[0]
    order = np.lexsort((first, codes))
    keys, codes, first, last = keys[order], codes[order], first[order], last[order]
    reach = pd.Series(last).groupby(codes).cummax().to_numpy()
    opens = np.ones(len(keys), bool)
    opens[1:] = (codes[1:] != codes[:-1]) | (first[1:] - reach[:-1] > gap)
    at = np.flatnonzero(opens)
    return keys[at], first[at], np.maximum.reduceat(last, at)


class Silence(StatefulProcessor):
    """(key, last event) for every event after which its key stays silent for ``gap`` microseconds; a group is a slice of keys."""

    def __init__(self, key: str, kind: str, gap: int):
        self.key, self.kind, self.gap = key, kind, gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        runs = f"keys array<{self.kind}>, firsts array<bigint>, lasts array<bigint>, due bigint"
        self.runs = handle.getValueState("runs", runs)

    def _settled(self, rows: Iterator[pd.DataFrame], watermark: int) -> Iterator[pd.DataFrame]:
        """Runs that the watermark has left behind by the gap are over: what could follow was late and isn't among the rows."""
        held = self.runs.get()
        known, firsts, lasts, due = held if held is not None else ([], [], [], None)
        # keys stay objects: an array of numbers would change them
        keys, first, last = _objects(known), np.array(firsts, np.int64), np.array(lasts, np.int64)
        came = False
        for batch in rows:
            came, us = True, batch["us"].to_numpy(np.int64)
            keys = np.concatenate((keys, _objects(batch[self.key].tolist())))
            keys, first, last = merged(keys, np.concatenate((first, us)), np.concatenate((last, us)), self.gap)
        over = last + self.gap <= watermark
        if not came and not over.any():
            return
        silent = pd.DataFrame({self.key: keys[over], "last_us": last[over]})
        keys, first, last = keys[~over], first[~over], last[~over]
        then = -(-(int(last.min()) + self.gap) // 1000) if len(keys) else None
        if due is not None and due != then:
            self.handle.deleteTimer(due)
        if then is None:
            self.runs.clear()
        else:
            if due != then:
                self.handle.registerTimer(then)
            self.runs.update((keys.tolist(), first.tolist(), last.tolist(), then))
        if len(silent):
            yield silent

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if key[0] == NOBODY:  # such rows move the watermark, no more
            return
        yield from self._settled(rows, timerValues.getCurrentWatermarkInMs() * 1000)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._settled(iter(()), timerValues.getCurrentWatermarkInMs() * 1000)

    def close(self) -> None:
        pass


def _objects(values: list) -> np.ndarray:
    out = np.empty(len(values), object)
    out[:] = values
    return out


def silent_keys(events: DataFrame, key: str, gap_seconds: int, ts: str = "ts", late: str = LATE, slices: int = SLICES) -> DataFrame:
    """A stream (key, last_seen, alarmed_at) of a stream of events. Rows without a key count for the watermark only.

    They aren't filtered out here, since Spark moves such a filter below the watermark, which then doesn't see them.
    ``slices`` must stay the same over restarts; with some ``SLICE_EVENTS`` events each, a slice's state stays small.
    """
    kind = events.schema[key].dataType.simpleString()
    usable = F.col(key).isNotNull() & F.col(ts).isNotNull()
    if kind in ("float", "double"):
        usable &= ~F.isnan(key)
    named = events.withWatermark(ts, late).select(
        F.when(usable, F.pmod(F.xxhash64(key), F.lit(slices))).otherwise(F.lit(NOBODY)).alias("slice"),
        # pandas makes whole numbers with a null among them inexact, and such rows aren't looked at
        F.coalesce(F.col(key), F.expr(f"try_cast('0' as {kind})")).alias(key),
        ts,
        F.coalesce(F.unix_micros(ts), F.lit(0)).alias("us"),
    )
    found = named.groupBy("slice").transformWithStateInPandas(
        statefulProcessor=Silence(key, kind, gap_seconds * 1_000_000),
        outputStructType=f"{key} {kind}, last_us bigint",
        outputMode="Append",
        timeMode="EventTime",
    )
    seen = F.timestamp_micros("last_us")
    return found.select(key, seen.alias("last_seen"), (seen + F.expr(f"INTERVAL {gap_seconds} SECONDS")).alias("alarmed_at"))
