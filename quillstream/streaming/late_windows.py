"""Stateful per-device tumbling windows with a late-data side output.

Spark's native ``groupBy(window)`` drops late rows with only a metric, and
filters them with the previous batch's watermark. The window job needs each
late reading as a dead letter, so windows are kept in a ``MapState`` per
device inside ``transformWithStateInPandas``:

* a reading is late iff its window end is at or below the watermark in force
  for its micro-batch (its window has already fired);
* otherwise it is folded into its window's accumulator (count, sums, min, max)
  and an event-time timer is set at the window end;
* the timer fires once the watermark reaches the window end and emits the
  aggregate row; rejected readings pass through as ``reject`` rows.

Each chunk of a device's micro-batch is folded as it arrives into one partial
per window, and its rejects and late rows leave at once, so what is held is
bounded by the open windows. At the end each touched window is read and written
once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

WINDOW_MS = 60_000

# One output schema for all tagged rows.
OUTPUT = T.StructType([
    T.StructField("kind", T.StringType()),            # agg | late | reject
    T.StructField("device_id", T.StringType()),
    T.StructField("window_start_ms", T.LongType()),
    T.StructField("window_end_ms", T.LongType()),
    T.StructField("reading_count", T.LongType()),
    T.StructField("avg_temperature_c", T.DoubleType()),
    T.StructField("min_temperature_c", T.DoubleType()),
    T.StructField("max_temperature_c", T.DoubleType()),
    T.StructField("avg_humidity_pct", T.DoubleType()),
    T.StructField("avg_pressure_hpa", T.DoubleType()),
    T.StructField("event_ts", T.LongType()),
    T.StructField("stage", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("payload_len", T.LongType()),
])
_COLS = OUTPUT.fieldNames()

_KEY = T.StructType([T.StructField("window_start_ms", T.LongType())])
_ACC = T.StructType([
    T.StructField("n", T.LongType()),
    T.StructField("t_sum", T.DoubleType()), T.StructField("t_min", T.DoubleType()), T.StructField("t_max", T.DoubleType()),
    T.StructField("h_sum", T.DoubleType()), T.StructField("p_sum", T.DoubleType()),
])


def _merged(a: tuple | None, b: tuple) -> tuple:
    """Two accumulators of one window as one."""
    if a is None:
        return b
    return (a[0] + b[0], a[1] + b[1], min(a[2], b[2]), max(a[3], b[3]), a[4] + b[4], a[5] + b[5])


_DTYPES = {f.name: ("Int64" if isinstance(f.dataType, T.LongType) else
                    "float64" if isinstance(f.dataType, T.DoubleType) else "object") for f in OUTPUT.fields}


def _typed(pdf: pd.DataFrame) -> pd.DataFrame:
    """Output frame with every column present and one dtype per column."""
    pdf = pdf.reindex(columns=_COLS)
    for c, t in _DTYPES.items():
        col = pdf[c]
        if t == "object":
            pdf[c] = col.astype(object).where(col.notna(), None)
        else:
            pdf[c] = col.astype(t)
    return pdf


def _empty() -> pd.DataFrame:
    return _typed(pd.DataFrame(columns=_COLS))


class LateAwareWindows(StatefulProcessor):
    """Input columns: device_id, event_ms, stage, reject_reason, payload_len,
    temperature_c, humidity_pct, pressure_hpa (stage NULL = plausible reading)."""

    def __init__(self, window_ms: int = WINDOW_MS):
        self.window_ms = window_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.windows = handle.getMapState("windows", _KEY, _ACC)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        wm = timerValues.getCurrentWatermarkInMs()
        partial: dict[int, tuple] = {}
        sent = False
        for pdf in rows:
            out = []
            rejected = pdf["stage"].notna().to_numpy()
            rej, ok = pdf[rejected], pdf[~rejected]
            if len(rej):
                out.append(pd.DataFrame({"kind": "reject", "device_id": rej["device_id"], "event_ts": rej["event_ms"],
                                         "stage": rej["stage"], "reason": rej["reject_reason"],
                                         "payload_len": rej["payload_len"]}))
            if len(ok):
                ts = ok["event_ms"].astype("int64")
                start = ts - np.mod(ts, self.window_ms)
                late = ((start + self.window_ms) <= (wm or 0)).to_numpy()
                if late.any():
                    out.append(pd.DataFrame({"kind": "late", "device_id": key[0], "event_ts": ts[late]}))
                if not late.all():
                    self._fold(ok[~late], start[~late], partial)
            if out:
                sent = True
                yield _typed(pd.concat([_typed(o) for o in out], ignore_index=True))
        for begin, acc in partial.items():
            held = self.windows.getValue((begin,)) if self.windows.containsKey((begin,)) else None
            if held is None:
                self.handle.registerTimer(begin + self.window_ms)
            self.windows.updateValue((begin,), _merged(held, acc))
        if not sent:
            yield _empty()

    @staticmethod
    def _fold(on: pd.DataFrame, start: pd.Series, partial: dict[int, tuple]) -> None:
        """Add one chunk's on-time readings to the partial of each window."""
        g = on.groupby(start.to_numpy()).agg(
            n=("temperature_c", "size"), t_sum=("temperature_c", "sum"), t_min=("temperature_c", "min"),
            t_max=("temperature_c", "max"), h_sum=("humidity_pct", "sum"), p_sum=("pressure_hpa", "sum"))
        for begin, acc in zip(g.index.tolist(), g.itertuples(index=False)):
            partial[int(begin)] = _merged(partial.get(int(begin)), (int(acc.n), *(float(x) for x in acc[1:])))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        end = expiredTimerInfo.getExpiryTimeInMs()
        k = (end - self.window_ms,)
        acc = self.windows.getValue(k)
        if acc is None:
            yield _empty()
            return
        n, t_sum, t_min, t_max, h_sum, p_sum = acc
        self.windows.removeKey(k)
        yield pd.DataFrame([{
            "kind": "agg", "device_id": key[0], "window_start_ms": k[0], "window_end_ms": end,
            "reading_count": n, "avg_temperature_c": t_sum / n, "min_temperature_c": t_min,
            "max_temperature_c": t_max, "avg_humidity_pct": h_sum / n, "avg_pressure_hpa": p_sum / n}]).pipe(_typed)

    def close(self) -> None:
        pass
