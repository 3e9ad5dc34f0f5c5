"""Keyed state for streams (T1, T2-T4, T5, T6, T7) as ``StatefulProcessor``s.

Used with ``groupBy(key).transformWithStateInPandas(...)``: Spark shuffles
the stream by key, keeps one small value per key in the state store
(RocksDB on clusters) and hands each key's new rows of a micro-batch to
``handleInputRows`` as Arrow-backed pandas frames. Within a batch the rows
of a key are put in event order (time, then tie-breaker) before the rule is
applied, so a batch behaves like the same rows arriving one by one.

Each processor implements the same rule as its batch twin in
``martflow.operators.state``; tests replay identical rows through both.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle


def _frame(rows: Iterator[pd.DataFrame], order: list[str]) -> pd.DataFrame:
    pdf = pd.concat(list(rows), ignore_index=True)
    return pdf.sort_values(order, kind="mergesort").reset_index(drop=True)


def _day(ts: pd.Series) -> pd.Series:
    return pd.to_datetime(ts).dt.strftime("%Y-%m-%d")


class FirstOfDay(StatefulProcessor):
    """Daily first-event rule per key.

    State: the last date seen (text). A row is a first visit when its date
    differs from the previous row's date (or from the stored date). With
    ``emit='flag'`` every row is emitted with ``out`` = 0/1 (T2, T3); with
    ``emit='first'`` only the first rows are emitted (T4).
    ``ttl_ms`` gives the state a processing-time TTL (the original used one
    day; needs ``timeMode='ProcessingTime'``).
    """

    def __init__(self, ts: str, ties: list[str], emit: str = "flag", out: str = "uv_ct",
                 ttl_ms: int | None = None):
        self.ts, self.ties, self.emit, self.out, self.ttl_ms = ts, list(ties), emit, out, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last_date", "d string", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _frame(rows, [self.ts, *self.ties])
        days = _day(pdf[self.ts])
        prev = days.shift(1)
        if self.last.exists():
            prev.iloc[0] = self.last.get()[0]
        first = (days != prev) | prev.isna()
        self.last.update((days.iloc[-1],))
        if self.emit == "first":
            yield pdf[first.values]
        else:
            yield pdf.assign(**{self.out: first.astype("int64")})

    def close(self) -> None:
        pass


class RepairIsNew(StatefulProcessor):
    """New-visitor repair. State: the reference date d0 fixed by a key's
    first record (its date if ``is_new='1'``, else the day before)."""

    def __init__(self, ts: str, ties: list[str], flag: str = "is_new", ttl_ms: int | None = None):
        self.ts, self.ties, self.flag, self.ttl_ms = ts, list(ties), flag, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.d0 = handle.getValueState("first_date", "d string", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _frame(rows, [self.ts, *self.ties])
        days = _day(pdf[self.ts])
        if self.d0.exists():
            d0 = self.d0.get()[0]
        else:
            t0 = pd.to_datetime(pdf[self.ts].iloc[0])
            d0 = days.iloc[0] if pdf[self.flag].iloc[0] == "1" else \
                (t0.normalize() - pd.Timedelta(days=1)).strftime("%Y-%m-%d")
            self.d0.update((d0,))
        fix = (pdf[self.flag] == "1") & (days != d0)
        pdf.loc[fix.values, self.flag] = "0"
        yield pdf

    def close(self) -> None:
        pass


class LoginFlags(StatefulProcessor):
    """T5: per user, the first login of each day emits ``uu_ct = 1`` and
    ``back_ct = 1`` when the previous login day is ``back_days`` or more
    days earlier. State: the last login date."""

    def __init__(self, ts: str, ties: list[str], back_days: int = 8, ttl_ms: int | None = None):
        self.ts, self.ties, self.back_days, self.ttl_ms = ts, list(ties), back_days, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last_login", "d string", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _frame(rows, [self.ts, *self.ties])
        days = _day(pdf[self.ts])
        prev = days.shift(1)
        if self.last.exists():
            prev.iloc[0] = self.last.get()[0]
        first = ((days != prev) | prev.isna()).values
        out = pdf[first].copy()
        d, p = pd.to_datetime(days[first]), pd.to_datetime(prev[first])
        gap = (d - p).dt.days
        out["back_ct"] = ((gap >= self.back_days) & p.notna()).astype("int64").values
        out["uu_ct"] = 1
        out["uu_ct"] = out["uu_ct"].astype("int64")
        self.last.update((days.iloc[-1],))
        yield out

    def close(self) -> None:
        pass


class RetractDuplicates(StatefulProcessor):
    """Retraction dedup. State: the key's last record (typed, schema
    ``state_schema`` = DDL of ``columns``). Each new record is emitted with
    ``sign = 1``; when it replaces an earlier record, that record is emitted
    again first with its measures negated and ``sign = -1`` (Q12: numeric
    negation, null stays null)."""

    def __init__(self, columns: list[str], order: list[str], measures: list[str], state_schema: str,
                 ttl_ms: int | None = None):
        self.columns, self.order, self.measures = list(columns), list(order), list(measures)
        self.state_schema, self.ttl_ms = state_schema, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.prev = handle.getValueState("last_record", self.state_schema, self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _frame(rows, self.order)[self.columns]
        before = pdf.iloc[:-1]
        if self.prev.exists():
            old = pd.DataFrame([tuple(self.prev.get())], columns=self.columns).astype(pdf.dtypes.to_dict())
            before = pd.concat([old, before], ignore_index=True)
        neg = before.copy()
        for m in self.measures:
            neg[m] = -neg[m].where(neg[m].notna(), 0)
            neg[m] = neg[m].where(before[m].notna(), None)
        self.prev.update(tuple(pdf.iloc[-1].tolist()))
        yield pd.concat([neg.assign(sign=-1), pdf.assign(sign=1)], ignore_index=True)

    def close(self) -> None:
        pass


class KeepLatest(StatefulProcessor):
    """Delayed keep-latest per key ("state + timer"): hold the newest
    record (newer or equal order wins) and emit it once ``delay_ms`` of
    processing time has passed since the key's first held record. Needs
    ``timeMode='ProcessingTime'``."""

    def __init__(self, columns: list[str], order: list[str], state_schema: str, delay_ms: int = 5000,
                 ttl_ms: int | None = None):
        self.columns, self.order, self.state_schema, self.delay_ms = list(columns), list(order), state_schema, delay_ms
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", self.state_schema, self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _frame(rows, self.order)[self.columns]
        if self.held.exists():
            old = pd.DataFrame([tuple(self.held.get())], columns=self.columns).astype(pdf.dtypes.to_dict())
            pdf = pd.concat([old, pdf], ignore_index=True) \
                    .sort_values(self.order, kind="mergesort").reset_index(drop=True)
        else:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.delay_ms)
        self.held.update(tuple(pdf.iloc[-1].tolist()))
        yield pdf.iloc[0:0]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.held.exists():
            out = pd.DataFrame([tuple(self.held.get())], columns=self.columns)
            self.held.clear()
            yield out

    def close(self) -> None:
        pass


class ConfigRouter(StatefulProcessor):
    """Routing by a config that is a stream of its own.

    Rows of two kinds share a key (the source table, or table and op): config
    changes (``kind = 'config'``) set, replace or delete the key's config, records
    (``kind = 'record'``) get the ``columns`` of the config that holds for them and
    are dropped without one. A record meets the config changes of earlier
    batches and those of its own batch that aren't newer than it. A preloaded
    config comes as initial state, so a record whose key no change has touched
    falls back to it; a delete removes it too. A change older than the one in
    force is ignored. State: the config and its time.
    """

    def __init__(self, columns: list[str]):
        self.columns = list(columns)

    def init(self, handle: StatefulProcessorHandle) -> None:
        cols = ", ".join(f"{c} string" for c in self.columns)
        self.config = handle.getValueState("config", f"ts long, live boolean, {cols}")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        row = initialState.sort_values("ts_ms", kind="mergesort").iloc[-1]
        self.config.update((int(row["ts_ms"]), True, *(row[c] for c in self.columns)))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows), ignore_index=True)
        pdf = pdf.assign(_k=(pdf["kind"] != "config").astype(int)).sort_values(["ts_ms", "_k", "pos"], kind="mergesort").reset_index(drop=True)
        now = tuple(self.config.get()) if self.config.exists() else None
        before, last = now, 0
        cut = [*pdf.index[pdf["kind"] == "config"], len(pdf)]
        for i in cut:
            if now is not None and now[1] and i > last:
                yield pdf.iloc[last:i].drop(columns=["_k"]).assign(**dict(zip(self.columns, now[2:])))
            if i < len(pdf):
                row = pdf.iloc[i]
                if now is None or int(row["ts_ms"]) >= now[0]:
                    now = (int(row["ts_ms"]), row["op"] != "d", *(row[c] for c in self.columns))
            last = i + 1
        if now is not None and now != before:
            self.config.update(now)

    def close(self) -> None:
        pass


class IdleJoin(StatefulProcessor):
    """Inner join of two streams whose rows wait for partners as
    long as they are in use: a row leaves the state ``idle_ms`` after it came or
    (``renew``) last found a partner. There is no bound between the times of the
    two sides.

    Rows are ``side`` ('l' or 'r'), ``body`` (text) and ``at`` (ms). The clock is
    the rows' ``at`` with event time, the time of the batch with processing time.
    State: each side's rows with the time of their last use; a key's rows are
    held while it is worked on, which suits keys of few rows such as orders.
    """

    def __init__(self, idle_ms: int, event_time: bool, renew: bool = True):
        self.idle_ms, self.event_time, self.renew = idle_ms, event_time, renew

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = {s: handle.getListState(s, "body string, used long") for s in ("l", "r")}

    def _load(self) -> dict[str, list]:
        return {s: [[b, u] for b, u in st.get()] if st.exists() else [] for s, st in self.rows.items()}

    def _store(self, held: dict[str, list], now: int) -> None:
        for s, st in self.rows.items():
            alive = [(b, u) for b, u in held[s] if u + self.idle_ms > now]
            if alive:
                st.put(alive)
            elif st.exists():
                st.clear()
        if used := [u for side in held.values() for _, u in side if u + self.idle_ms > now]:
            self.handle.registerTimer(max(used) + self.idle_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _frame(rows, ["at", "side", "body"])
        held, out = self._load(), []
        now = 0
        for side, body, at in zip(pdf["side"], pdf["body"], pdf["at"]):
            now = int(at) if self.event_time else timerValues.getCurrentProcessingTimeInMs()
            for row in held["r" if side == "l" else "l"]:
                if row[1] + self.idle_ms > now:
                    out.append((body, row[0]) if side == "l" else (row[0], body))
                    if self.renew:
                        row[1] = max(row[1], now)
            held[side].append([body, now])
        self._store(held, timerValues.getCurrentWatermarkInMs() if self.event_time else now)
        yield pd.DataFrame(out, columns=["l", "r"], dtype=object)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._store(self._load(), expiredTimerInfo.getExpiryTimeInMs())
        yield pd.DataFrame([], columns=["l", "r"], dtype=object)

    def close(self) -> None:
        pass
