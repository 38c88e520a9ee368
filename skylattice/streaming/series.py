"""Gap fills and lags on unbounded input.

Rows of a series come late and out of order, so a row's predecessor is only
known when the watermark has passed it. Until then rows wait in keyed state; a
timer at the watermark lets the rows before it go, in order, and keeps what
the rows behind them need: the last values and how many rows ago they were.
The rows that come out are those of the batch operators.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


class OrderedSeries(StatefulProcessor):
    """Keeps the rows of a series until the watermark has passed them."""

    def __init__(self, ts: str, order: list[str], value: str, limit: int, lag: int, waiting: T.StructType, names: list[str]):
        self.ts, self.order, self.value, self.limit, self.lag = ts, order, value, limit, lag
        self.waiting, self.names = waiting, names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # rows by arrival, and of those gone the values of the last rows, oldest first
        self.rows = handle.getListState("rows", self.waiting)
        last = T.StructType([T.StructField("value", self.waiting[self.value].dataType)])
        self.gone = handle.getListState("gone", last)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        first = None
        for batch in rows:
            for row in batch[self.names].itertuples(index=False, name=None):
                self.rows.appendValue(tuple(_plain(v) for v in row))
            low = batch[self.ts].min()
            first = low if first is None else min(first, low)
        if first is not None:
            # just behind the earliest row; a timer that is there already stays
            self.handle.registerTimer(int(first.timestamp() * 1000) + 1)
        return iter([])

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        held = [tuple(r) for r in self.rows.get()] if self.rows.exists() else []
        at = self.names.index(self.ts)
        stamp = lambda r: r[at].timestamp() * 1000
        places = [self.names.index(c) for c in (self.ts, *self.order)]
        ready = sorted((r for r in held if stamp(r) < mark), key=lambda r: [(r[p] is not None, r[p]) for p in places])
        rest = [r for r in held if stamp(r) >= mark]
        if rest:
            self.rows.put(rest)
            self.handle.registerTimer(int(min(map(stamp, rest))) + 1)
        else:
            self.rows.clear()
        if not ready:
            return iter([])
        return iter([self._filled(ready)])

    def _filled(self, ready: list[tuple]) -> pd.DataFrame:
        at, reach = self.names.index(self.value), max(self.limit, self.lag)
        before = [r[0] for r in self.gone.get()] if self.gone.exists() else []
        values = [*before, *(r[at] for r in ready)]
        filled, lagged = [], []
        for i in range(len(before), len(values)):
            near = (v for v in reversed(values[max(0, i - self.limit) : i + 1]) if v is not None)
            filled.append(next(near, None))
            lagged.append(values[i - self.lag] if i >= self.lag else None)
        self.gone.put([(v,) for v in values[-reach:]])
        out = pd.DataFrame(ready, columns=self.names)
        kept = pd.DataFrame({"filled": pd.Series(filled, dtype="object"), "lagged": pd.Series(lagged, dtype="object")})
        return pd.concat([out, kept], axis=1)

    def close(self) -> None:
        pass


def _plain(v: Any) -> Any:
    """A cell as state keeps it: pandas' missing values are null."""
    if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
        return None
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime()
    return v.item() if hasattr(v, "item") else v


def filled_and_lagged(
    df: DataFrame, key: str, ts: str, order: Sequence[str], value: str, limit: int, lag: int, lateness: str
) -> DataFrame:
    """The rows with ``filled`` (the last value, at most ``limit`` rows old)
    and ``lagged`` (the value ``lag`` rows before), as the batch operators
    ``fill_forward`` and ``lagged`` give them along (``ts``, ``order``).

    A row comes out when the watermark, ``lateness`` behind the latest time,
    has passed it. Rows later than that are left out, as are rows without a
    time. State holds the rows the watermark has not passed, and
    ``max(limit, lag)`` values per series. Needs the RocksDB state store.
    """
    if limit < 0 or lag < 1:
        raise ValueError("a limit of 0 rows or more and a lag of 1 row or more are needed")
    kind = df.schema[value].dataType
    result = T.StructType([*df.schema.fields, T.StructField("filled", kind), T.StructField("lagged", kind)])
    rows = df.where(df[ts].isNotNull()).withWatermark(ts, lateness)
    series = OrderedSeries(ts, list(order), value, limit, lag, df.schema, df.columns)
    return rows.groupBy(key).transformWithStateInPandas(statefulProcessor=series, outputStructType=result, outputMode="append", timeMode="eventTime")
