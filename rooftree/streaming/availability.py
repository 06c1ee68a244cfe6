"""Availability, confirmations and run gates as event-time state that ends.

All three hold back only what late rows may still change, the time between the watermark and the newest row.  What the
watermark has passed is folded into a few numbers, so a key's state does not grow with its history.
"""
from __future__ import annotations

from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from rooftree.operators.skew import micros_of

STATE_SCHEMA = "ok_us long, ok_id long, checked_us long, folded long"
OPEN = "at_us long, event_id long, code int"
OUTPUT = "listing_id long, last_checked_us long, last_seen_us long, missing long, status string"
NEVER = -1  # before every check
FORGOTTEN = "forgotten"
MISSES = [404, 410]


def _one_timer(handle: StatefulProcessorHandle, at_ms: int | None) -> None:
    """The key's only timer; none for None."""
    for old in list(handle.listTimers()):
        handle.deleteTimer(old)
    if at_ms is not None:
        handle.registerTimer(at_ms)


def _taken(state) -> dict[tuple[int, int], int]:
    """The open checks of a key by time and id; a check that came twice counts once, as it came last."""
    return {(at, event): code for at, event, code in state.get()} if state.exists() else {}


def _keep(state, checks: dict[tuple[int, int], int]) -> None:
    """One call for all open checks of a key: a call for each of them costs more than the checks themselves."""
    if checks:
        state.put([(at, event, code) for (at, event), code in checks.items()])
    else:
        state.clear()


def _ms(us: int) -> int:
    """The first millisecond that is not before ``us``: a timer there fires once the watermark has passed ``us``."""
    return -(-us // 1000)


class AvailabilityProcessor(StatefulProcessor):
    """State per listing: newest success, newest check, misses by time that may still change, and the number of the final ones.

    A miss is final when the watermark has passed it: no success before it can arrive any more, so only its number counts,
    until a later success resets it.  Frames of a group are folded as they arrive; late rows find their place because open
    misses are kept by their own time.  A listing without a check for ``forget_us`` is dropped with all of its state; should
    it come back, it starts anew.
    """

    def __init__(self, threshold: int = 2, forget_us: int | None = None):
        self.threshold, self.forget_us = threshold, forget_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.latest = handle.getValueState("latest", STATE_SCHEMA)
        self.misses = handle.getListState("misses", OPEN)

    def _state(self) -> tuple:
        return tuple(self.latest.get()) if self.latest.exists() else (NEVER, NEVER, NEVER, 0)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        ok_us, ok_id, checked, folded = self._state()
        before, had = (ok_us, ok_id), _taken(self.misses)
        open_ = dict(had)
        for pdf in rows:
            checked = max(checked, int(pdf["at_us"].max()))
            good = pdf[pdf["http_status"].between(200, 399)].sort_values(["at_us", "event_id"])
            if len(good):
                ok_us, ok_id = max((ok_us, ok_id), (int(good["at_us"].iloc[-1]), int(good["event_id"].iloc[-1])))
            bad = pdf[pdf["http_status"].isin(MISSES)]
            open_.update(zip(zip(bad["at_us"].tolist(), bad["event_id"].tolist()), bad["http_status"].tolist()))
        open_ = {k: code for k, code in open_.items() if k > (ok_us, ok_id)}
        if (ok_us, ok_id) != before:
            folded = 0  # every final miss is older than a row that was let in
        if open_ != had:
            _keep(self.misses, open_)
        missing = folded + len(open_)
        self.latest.update((ok_us, ok_id, checked, folded))
        self._wake(checked, open_)
        yield self._row(key, ok_us, checked, missing, "inactive" if missing >= self.threshold else "active")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        ok_us, ok_id, checked, folded = self._state()
        had = _taken(self.misses)
        open_ = {k: code for k, code in had.items() if k[0] > passed}
        folded += len(had) - len(open_)
        if self.forget_us is not None and checked + self.forget_us <= passed:
            missing = folded + len(open_)
            self.latest.clear()
            self.misses.clear()
            _one_timer(self.handle, None)
            yield self._row(key, ok_us, checked, missing, FORGOTTEN)
            return
        if len(open_) < len(had):
            _keep(self.misses, open_)
        self.latest.update((ok_us, ok_id, checked, folded))
        self._wake(checked, open_)

    def _wake(self, checked: int, open_: dict[tuple[int, int], int]) -> None:
        ends = ([min(open_)[0]] if open_ else []) + ([checked + self.forget_us] if self.forget_us is not None else [])
        _one_timer(self.handle, _ms(min(ends)) if ends else None)

    def _row(self, key, ok_us: int, checked: int, missing: int, status: str) -> pd.DataFrame:
        return pd.DataFrame({"listing_id": [key[0]], "last_checked_us": [checked], "last_seen_us": [ok_us if ok_us >= 0 else None],
                             "missing": [missing], "status": [status]}).astype({"last_seen_us": "Int64"})

    def close(self) -> None:
        pass


def _micros(interval: str | None) -> int | None:
    return None if interval is None else int(pd.Timedelta(interval).value // 1000)


def _timed(checks: DataFrame, delay: str) -> DataFrame:
    """listing_id, event_id, http_status, at_us, and checked_at as the watermarked event time."""
    return checks.select(F.col("listing_id").cast("long").alias("listing_id"), F.col("event_id").cast("long").alias("event_id"),
                         F.expr(micros_of(checks, "checked_at")).alias("at_us"), F.coalesce("http_status", F.lit(0)).cast("int").alias("http_status"),
                         F.col("checked_at").cast("timestamp").alias("checked_at")).withWatermark("checked_at", delay)


def availability_stream(checks: DataFrame, threshold: int = 2, delay: str = "7 days", forget: str | None = None) -> DataFrame:
    """Streaming checks (listing_id, event_id, checked_at, http_status) to state updates per listing.

    Equal to ``operators.state.availability_state`` for rows that are late by ``delay`` at most; later ones are dropped.
    With ``forget`` a listing that long unchecked is dropped, and a last row with the status ``forgotten`` says so.
    Needs the RocksDB state store (``rooftree.session.ROCKSDB``).  The trigger size bounds a group's rows.
    """
    return _timed(checks, delay).groupBy("listing_id").transformWithStateInPandas(
        statefulProcessor=AvailabilityProcessor(threshold, _micros(forget)), outputStructType=OUTPUT, outputMode="Update", timeMode="EventTime")


# --- confirmations -------------------------------------------------------------------------------------------------------------

CONFIRMED = "listing_id long, event_id long, confirmed_us long, reason string"


class ConfirmProcessor(StatefulProcessor):
    """Emits the check that first completes ``threshold`` misses in a row, once and for good.

    Checks wait until the watermark has passed them, then they are taken in order of time.  State: the length of the open
    run of misses, whether the listing is confirmed, and the waiting checks; a confirmed listing keeps one flag.
    """

    def __init__(self, threshold: int = 2):
        self.threshold = threshold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.run = handle.getValueState("run", "length int, confirmed boolean")
        self.waiting = handle.getListState("waiting", OPEN)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if key[0] is None or (self.run.exists() and self.run.get()[1]):
            return iter(())
        fresh = []
        for pdf in rows:
            decisive = pdf[pdf["http_status"].between(200, 399) | pdf["http_status"].isin(MISSES)]
            fresh += zip(decisive["at_us"].tolist(), decisive["event_id"].tolist(), decisive["http_status"].tolist())
        if fresh:
            self.waiting.appendList(fresh)
            wake, set_ = _ms(min(fresh)[0]), list(self.handle.listTimers())  # the timer stands at the first waiting check
            if not set_ or wake < min(set_):
                _one_timer(self.handle, wake)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        length, confirmed = tuple(self.run.get()) if self.run.exists() else (0, False)
        waiting, found = _taken(self.waiting), []
        for at, event in sorted(k for k in waiting if k[0] <= passed):
            code = waiting.pop((at, event))
            length = length + 1 if code in MISSES else 0
            if length >= self.threshold:
                found, confirmed, waiting = [(key[0], event, at, f"http_{code}_confirmed")], True, {}
                break
        _keep(self.waiting, waiting)
        self.run.update((0 if confirmed else length, confirmed))
        _one_timer(self.handle, _ms(min(waiting)[0]) if waiting else None)
        if found:
            yield pd.DataFrame(found, columns=["listing_id", "event_id", "confirmed_us", "reason"])

    def close(self) -> None:
        pass


def confirmed_stream(checks: DataFrame, threshold: int = 2, delay: str = "7 days") -> DataFrame:
    """The one check per listing that first completes ``threshold`` misses in a row (``operators.state.confirmed_once``).

    Repeated deliveries of a check within the watermark are let through once; a confirmation comes out when the watermark has
    passed its check.  Rows without a listing only move the watermark on: send one after the end of a stream.
    """
    once = _timed(checks, delay).dropDuplicatesWithinWatermark(["listing_id", "event_id"])
    return once.groupBy("listing_id").transformWithStateInPandas(
        statefulProcessor=ConfirmProcessor(threshold), outputStructType=CONFIRMED, outputMode="Append", timeMode="EventTime")


def confirmed_events(transitions: DataFrame, key: str = "listing_id", ts: str = "confirmed_at", delay: str = "7 days") -> DataFrame:
    """Let each confirmation through once; the watermark bounds the remembered keys."""
    return transitions.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


# --- run gate ------------------------------------------------------------------------------------------------------------------

def run_gate(sightings: DataFrame, completions: DataFrame, scope: str = "operation", key: str = "listing_id", seen_at: str = "seen_at",
             completed_at: str = "completed_at", delay: str = "1 day", longest_run: str = "2 days") -> DataFrame:
    """Sightings (scope, run_id, key, seen_at) let through once their run is complete; those of incomplete runs never are.

    Completions (scope, run_id, completed_at) come from the collector, one per complete run.  A run lasts ``longest_run`` at
    most, so a sighting is held for that time and ``delay`` and then dropped: the state has an end whether or not the run does.
    """
    seen = sightings.select(scope, "run_id", key, F.col(seen_at).cast("timestamp").alias("seen_at")).withWatermark("seen_at", delay)
    done = completions.select(F.col(scope).alias("__scope"), F.col("run_id").alias("__run"), F.col(completed_at).cast("timestamp").alias("completed_at"))
    done = done.withWatermark("completed_at", delay)
    within = F.expr(f"completed_at >= seen_at AND completed_at <= seen_at + INTERVAL {longest_run}")
    return seen.join(done, (F.col(scope) == F.col("__scope")) & (F.col("run_id") == F.col("__run")) & within).select(scope, "run_id", key, "seen_at", "completed_at")
