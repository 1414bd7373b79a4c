"""Threads of entries in event time: entries that come late are put in order, and a thread closes when it has been quiet."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..arrow import ship

#: The keyed state's store; the default one has no lists and timers.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def split_threads(entries: list[tuple], gap: int) -> list[list[tuple]]:
    """Entries (time in microseconds, id, ...), each id once, ordered by time and id and parted where more than gap lies between."""
    out: list[list[tuple]] = []
    for e in sorted({e[1]: e for e in reversed(entries)}.values(), key=lambda e: e[:2]):
        if out and e[0] - out[-1][-1][0] <= gap:
            out[-1].append(e)
        else:
            out.append([e])
    return out


class _Threads(StatefulProcessor):
    """Open entries as a list, and one timer a key: when its earliest thread could close."""

    def __init__(self, gap: int) -> None:
        self.gap = gap

    def init(self, handle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", "us long, id string, payload string")
        self.timer = handle.getValueState("timer", "ms long")

    def closing(self, us: int) -> int:
        """The first millisecond of the watermark at which nothing within the gap can come."""
        return (us + self.gap) // 1000 + 1

    def wait(self, ms: int) -> None:
        held = self.timer.get()[0] if self.timer.exists() else None
        if held is None or ms < held:
            if held is not None:
                self.handle.deleteTimer(held)
            self.handle.registerTimer(ms)
            self.timer.update((ms,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for t in rows:
            us = t["us"].tolist()
            self.open.appendList(list(zip(us, t["id"].tolist(), t["payload"].tolist())))
            first = min([*us, *([] if first is None else [first])])
        if first is not None:
            self.wait(self.closing(first))
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        self.timer.clear()
        left: list[tuple] = []
        out: list[tuple] = []
        for thread in split_threads([tuple(e) for e in self.open.get()], self.gap):
            if self.closing(thread[-1][0]) <= now:
                out += [(key[0], thread[0][0], thread[-1][0], i, us, payload) for i, (us, _, payload) in enumerate(thread)]
            else:
                left += thread
        if left:
            self.open.put(left)
            self.wait(min(self.closing(t[-1][0]) for t in split_threads(left, self.gap)))
        else:
            self.open.clear()
        yield pd.DataFrame(out, columns=["key", "start", "end", "position", "us", "payload"])


def instant(df: DataFrame, time: str) -> Column:
    """A column of times as TIMESTAMP; times without a zone are taken as UTC, whatever the session's."""
    c = F.col(time)
    return F.concat(c.cast("string"), F.lit("Z")).cast("timestamp") if df.schema[time].dataType.simpleString() == "timestamp_ntz" else c.cast("timestamp")


def closed_threads(stream: DataFrame, key: str, time: str, entry: str, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """A row per entry of every thread that has closed: the columns of `stream`, _start, _end, and _position from 0.

    An entry belongs to the thread of its key whose last entry is at most `gap` earlier; entries are ordered by time,
    then by `entry`, their identifier as text. A thread closes when the watermark, `late` behind the newest entry, is
    past its end by more than the gap; an entry that is later than that is left out. An identifier that comes twice
    while its thread is open counts once. Rows without time, key or identifier are left out. The session must keep its
    state in RocksDB (`STORE`); the open entries of one key must fit in a task, closed ones leave the state.
    Times come back as TIMESTAMP.
    """
    ship(stream.sparkSession)
    gap_us = int(stream.sparkSession.sql(f"SELECT CAST(INTERVAL {gap} AS INTERVAL SECOND) AS g").first().g.total_seconds() * 1_000_000)
    rest = [c for c in stream.columns if c not in (key, time)]
    kind = stream.schema[key].dataType.simpleString()
    rows = stream.filter(F.col(time).isNotNull() & F.col(key).isNotNull() & F.col(entry).isNotNull()).withColumn(time, instant(stream, time)).withWatermark(time, late)
    rows = rows.select(F.col(key).alias("key"), F.col(time).alias("time"), F.unix_micros(time).alias("us"), F.col(entry).cast("string").alias("id"), F.to_json(F.struct(*rest), _TIMES).alias("payload"))
    out = rows.groupBy("key").transformWithStateInPandas(_Threads(gap_us), f"key {kind}, start long, end long, position int, us long, payload string", "Append", "EventTime")
    of = F.from_json("payload", stream.select(*rest).schema, _TIMES)
    return out.withColumn("_r", of).select(F.col("key").alias(key), F.timestamp_micros("us").alias(time), "_r.*", F.timestamp_micros("start").alias("_start"), F.timestamp_micros("end").alias("_end"), F.col("position").alias("_position"))
