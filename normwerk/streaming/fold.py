"""Folding event streams: the state of each run in a batch, and the same kept up to date by a stream."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

STATE = "run_id bigint, n_events bigint, first_seq bigint, last_seq bigint, status string, total double"


def fold(events: DataFrame) -> DataFrame:
    """events(run_id, seq, kind, value) -> one row a run: counts, the last kind and the sum; repeated (run_id, seq) count once."""
    once = events.groupBy("run_id", "seq").agg(F.max(F.struct("kind", "value")).alias("e"))
    return once.groupBy("run_id").agg(F.count(F.lit(1)).alias("n_events"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"), F.max_by("e.kind", "seq").alias("status"), F.coalesce(F.sum("e.value"), F.lit(0.0)).alias("total"))


def _merge(runs: list[tuple[int, int]], seqs: list[int]) -> tuple[list[tuple[int, int]], list[int]]:
    """Sorted runs of consecutive numbers with more numbers added, and those of them that are new."""
    known, new = dict(runs), []
    starts = [a for a, _ in runs]
    for s in sorted(set(seqs)):
        k = bisect_right(starts, s) - 1
        if k < 0 or s > known[starts[k]]:
            new.append(s)
    out: list[tuple[int, int]] = []
    for a, b in sorted([*runs, *((s, s) for s in new)]):
        if out and a == out[-1][1] + 1:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out, new


def _update(forget_ms: int | None):
    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        n, first, last, status, total, starts, ends = state.get if state.exists else (0, None, None, None, 0.0, [], [])
        runs = list(zip(starts, ends))
        for rows in batches:
            rows = rows.sort_values(["seq", "kind", "value"], kind="stable").drop_duplicates("seq", keep="last")
            runs, new = _merge(runs, [int(s) for s in rows["seq"]])
            rows = rows[rows["seq"].isin(new)]  # what came again was counted
            if len(rows):
                n += len(rows)
                low, high = int(rows["seq"].iloc[0]), int(rows["seq"].iloc[-1])
                first = low if first is None else min(first, low)
                if last is None or high > last:
                    last, status = high, rows["kind"].iloc[-1]
                total += float(rows["value"].fillna(0).sum())
        state.update((n, first, last, status, total, [a for a, _ in runs], [b for _, b in runs]))
        if forget_ms is not None:
            state.setTimeoutDuration(forget_ms)
        yield pd.DataFrame({"run_id": [key[0]], "n_events": [n], "first_seq": [first], "last_seq": [last], "status": [status], "total": [total]})

    return update


def fold_stream(events: DataFrame, forget_ms: int | None = None) -> DataFrame:
    """The same over a stream, in whatever order the events come; write it in update mode.

    The state of a run is its counts and the numbers seen, as runs of consecutive ones: one run if none is missing. A run
    without events for ``forget_ms`` is forgotten; without that, never.
    """
    kept = "n_events long, first_seq long, last_seq long, status string, total double, starts array<long>, ends array<long>"
    timeout = GroupStateTimeout.NoTimeout if forget_ms is None else GroupStateTimeout.ProcessingTimeTimeout
    return events.groupBy("run_id").applyInPandasWithState(_update(forget_ms), STATE, kept, "update", timeout)


def windows(events: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Counts and sums by window and kind. Over a stream, rows later than the watermark are left out; over the stored events, a
    batch, none is, so that a window's late rows are counted by running it again on those."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "kind").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), "kind", "n", "total")


def ingest(packages: DataFrame, known: DataFrame) -> DataFrame:
    """Packages not seen with the same hash and extractor version: a resumed load takes up where it ended."""
    return packages.join(known.select("path", "sha256", "version").distinct(), ["path", "sha256", "version"], "left_anti")
