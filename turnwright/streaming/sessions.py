"""Sessions whose limits depend on what they hold already (W1 and W2 on a stream), independent of the order in which events arrive.

Each key keeps a list of events that the watermark hasn't passed and the session that is open. A timer at the earliest waiting event fires when the watermark
passes it; what it has passed is then put in order and folded into the session, and nothing that may still come belongs before it. A session goes out when a
later event closes it, or when the watermark shows that none can join it.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

#: What the session needs to be set to, as timers and lists of state are kept in it.
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
SESSION = "start double, end double, speaker string, text string, n long"


class Sessions(StatefulProcessor):
    """The sessions of one key after the other: a new one at a change of speaker, after `gap`, once it lasts `cap`, or once it has `most` characters and ends a sentence."""

    def __init__(self, gap: float, cap: float, most: int | None):
        self.gap, self.cap, self.most = gap, cap, most

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "t double, speaker string, text string")
        self.open = handle.getValueState("open", SESSION)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        new = [tuple(r) for part in rows for r in part[["t", "who", "said"]].itertuples(index=False)]
        self.waiting.appendList([(float(t), speaker, text) for t, speaker, text in new])
        self._wake(min(t for t, *_ in new))
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() / 1000
        waiting = [tuple(x) for x in self.waiting.get()]
        ready = sorted((x for x in waiting if x[0] <= passed), key=lambda x: (x[0], x[1] or "", x[2] or ""))
        rest = [x for x in waiting if x[0] > passed]
        if ready:
            self.waiting.put(rest) if rest else self.waiting.clear()
        held = tuple(self.open.get()) if self.open.exists() else None
        closed = []
        for t, speaker, text in ready:
            if held is not None and self._ends(held, t, speaker):
                closed.append(held)
                held = None
            start, _, speaker, before, n = held or (t, t, speaker, "", 0)
            held = (start, t, speaker, f"{before} {text or ''}".strip(), n + 1)
        if held is not None and held[1] + self.gap < passed:
            closed.append(held)
            held = None
        self.open.update(held) if held is not None else self.open.clear()
        if rest:
            self._wake(min(t for t, *_ in rest))
        if held is not None:
            self._wake(held[1] + self.gap)
        if closed:
            yield pd.DataFrame([(key[0], *x) for x in closed], columns=["key", "start", "end", "speaker", "text", "n"])

    def close(self) -> None:
        pass

    def _ends(self, held: tuple, t: float, speaker: str | None) -> bool:
        start, end, of, text, _ = held
        return speaker != of or round(t - end, 6) > self.gap or round(end - start, 6) >= self.cap or self.most is not None and len(text) >= self.most and text[-1:] in tuple(".!?")

    def _wake(self, t: float) -> None:
        self.handle.registerTimer(ceil(t * 1000) + 1)


def capped_sessions(events: DataFrame, key: str, gap: float, cap: float, ts: str = "ts", late: str = "1 hour", speaker: str | None = None, text: str | None = None, most: int | None = None) -> DataFrame:
    """T6 with limits (W1, W2 on a stream): (key, start, end, speaker, text, n) of sessions, in seconds of the epoch.

    events: a stream with a key (long) and a time, perhaps with a speaker and a text; of events at one time the order is by speaker and text. Events later than `late`
    behind the latest are dropped, as with any watermark; all others give the same sessions in whatever order and batches they come.
    """
    spark = events.sparkSession
    if spark.conf.get(*STATE_STORE[:1], "") != STATE_STORE[1]:
        spark.conf.set(*STATE_STORE)
    at = F.col(ts).cast("timestamp")
    none = F.lit(None).cast("string")
    df = events.select(F.col(key).cast("long").alias("key"), at.alias("at"), (F.unix_micros(at) / 1_000_000).alias("t"), (F.col(speaker) if speaker else none).alias("who"), (F.col(text) if text else none).alias("said"))
    return df.withWatermark("at", late).groupBy("key").transformWithStateInPandas(Sessions(gap, cap, most), f"key long, {SESSION}", "Append", "EventTime")
