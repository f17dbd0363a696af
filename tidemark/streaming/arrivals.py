"""Every post of a stream to exactly one place: posts, repeats, late ones and untimed ones.

A watermark alone loses rows: what comes too late is dropped inside Spark, and a post without a time
cannot be placed at all. Here a state processor sees every row and names its ``arrival``:

- ``post``: the first row of its id within the delay;
- ``repeat``: the id is still known;
- ``late``: the post's time lies more than the delay behind the newest time of the batches before;
- ``untimed``: no usable time (none, or outside ``YEARS``), first row of its id.

A post's id is known until the newest time has passed the post's own by the delay, when a later row of
it is late by itself; an untimed one's until the newest time has moved on by the delay. State is one
number per known id, dropped by event-time timers. A post without an id is known by its whole row.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import StringType, StructType

from tidemark.functions.dates import to_event_time
from tidemark.sinks.lake import has_id

ARRIVALS = ("post", "repeat", "late", "untimed")
#: Posts dated outside these years count as untimed: one wild date must not push the watermark on.
YEARS = (1900, 2100)
#: The clock column runs this far ahead and its watermark as far behind, so Spark itself never finds a
#: row of ``YEARS`` late, and the watermark is the newest time seen.
AHEAD_DAYS = 73_050
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Arrivals(StatefulProcessor):
    """Per known id: the instant (ms) up to which it stays known; 0 while no time has been seen yet."""

    def __init__(self, delay_ms: int, columns: list[str]):
        self.delay, self.columns = delay_ms, columns

    def init(self, handle) -> None:
        self.handle = handle
        self.until = handle.getValueState("until", "until long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        newest = timerValues.getCurrentWatermarkInMs()
        known = self.until.exists()
        for row in rows:
            at = row["_at"]
            if at is not None and at < newest - self.delay:
                arrival = "late"
            elif known:
                arrival = "repeat"
            else:
                arrival, known = ("untimed" if at is None else "post"), True
                until = at + self.delay if at is not None else (newest + self.delay if newest else 0)
                self.until.update((until,))
                self.handle.registerTimer(max(until, 1))
            yield Row(**{c: row[c] for c in self.columns}, arrival=arrival)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = self.until.get() if self.until.exists() else None
        if held is not None and held[0] == 0:
            until = timerValues.getCurrentWatermarkInMs() + self.delay
            self.until.update((until,))
            self.handle.registerTimer(until)
        elif held is not None:
            self.until.clear()
        return iter(())

    def close(self) -> None:
        pass


def arrivals(posts: DataFrame, delay_days: int) -> DataFrame:
    """All rows of a stream of enriched posts with their ``arrival``; ``created_ts`` is dropped.

    Needs the RocksDB state store; ``land_arrivals`` sets it.
    """
    columns = [c for c in posts.columns if c != "created_ts"]
    usable = F.year("created_ts").between(YEARS[0], YEARS[1] - 1)
    instant = F.when(usable, to_event_time(F.col("created_ts")))
    known_by = F.when(has_id(), F.concat(F.lit("i"), "id")).otherwise(F.sha2(F.to_json(F.struct(*columns)), 256))
    keyed = posts.select(
        *columns, F.unix_millis(instant).alias("_at"), (instant + F.make_dt_interval(F.lit(AHEAD_DAYS))).alias("_clock"), known_by.alias("_known_by")
    ).withWatermark("_clock", f"{AHEAD_DAYS} days")
    schema = StructType([*[f for f in posts.schema if f.name in columns]]).add("arrival", StringType())
    return keyed.groupBy("_known_by").transformWithState(Arrivals(delay_days * 86_400_000, columns), schema, "append", "EventTime")
