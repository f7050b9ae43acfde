"""Closed months from a stream.

The detector is a batch rule over closed months, so a stream has to say which
months have closed.  :func:`closed_months` keeps state by month, with a timer at the
end of the month and the days that rows may be late: when the watermark passes it,
the month is announced, once.  Rows that come still later are not dropped but
reported, with the month to run again.  :func:`run_closed_months` hands both to a
batch run (to maintained daily totals and the detector, for one).

A month may hold a large part of all rows: its rows are dealt over several keys, and
only month and key are exchanged.  All keys of a month share its timer, so they
announce it in the same micro-batch, where they are put together.

:func:`daily_totals` hands over the sums of final days themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidewatch.functions.scalar import month_code

#: Keys that the rows of a month are dealt over.
SHARDS = 16
EVENTS = "codmes int, evento string, n_filas long"
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def daily_totals(events: DataFrame, time: str, value: str, keys: tuple[str, ...], late: str = "3 days") -> DataFrame:
    """Sum and count by key and day of a stream; days are final once ``late`` has passed."""
    days = events.withWatermark(time, late).groupBy(F.window(time, "1 day").alias("_day"), *keys)
    return days.agg(F.sum(value).alias("cantidad_dia"), F.count(F.lit(1)).alias("n")).select(*keys, F.to_date(F.col("_day.start")).alias("fecha_dt"), "cantidad_dia", "n")


def for_each_closed_batch(totals: DataFrame, run: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Calls ``run(finished days, batch number)`` once for each micro-batch of final days."""
    return totals.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(run).trigger(availableNow=True).start()


def end_of_month(codmes: int) -> int:
    """The first moment after a month (UTC), in milliseconds."""
    year, month = divmod(codmes, 100)
    return int(datetime(year + month // 12, month % 12 + 1, 1, tzinfo=timezone.utc).timestamp() * 1000)


class MonthState(StatefulProcessor):
    """State of one key of a month: the rows seen, and whether the month has been announced."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "n long, announced boolean")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        n, (before, announced) = sum(1 for _ in rows), self.seen.get() if self.seen.exists() else (0, False)
        end = end_of_month(key[0])
        if announced or timerValues.getCurrentWatermarkInMs() >= end:
            self.seen.update((before + n, True))
            yield Row(codmes=key[0], evento="late", n_filas=n)
            return
        if not before:
            self.handle.registerTimer(end)
        self.seen.update((before + n, False))

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        n, _ = self.seen.get()
        self.seen.update((n, True))
        yield Row(codmes=key[0], evento="closed", n_filas=n)

    def close(self) -> None:
        pass


def closed_months(events: DataFrame, time: str, late: str = "3 days", shards: int = SHARDS) -> DataFrame:
    """A stream of codmes, evento (closed or late) and n_filas, one row for each key of a month; rows without a time are left out.

    The session keeps state in RocksDB, which timers need.
    """
    spark: SparkSession = events.sparkSession
    spark.conf.set(_STORE, _ROCKS)
    # the month is no event time itself, so late rows reach the state
    own = events.where(F.col(time).isNotNull()).withWatermark(time, late).select(month_code(time).alias("codmes"), F.pmod(F.xxhash64(*events.columns), F.lit(shards)).cast("int").alias("clave"))
    return own.groupBy("codmes", "clave").transformWithState(statefulProcessor=MonthState(), outputStructType=EVENTS, outputMode="Append", timeMode="EventTime")


def run_closed_months(announced: DataFrame, run: Callable[[list[int], list[int], int], None], checkpoint: str) -> StreamingQuery:
    """Calls ``run(closed months, months to run again, batch number)`` for each micro-batch that has any."""

    def hand_over(batch: DataFrame, number: int) -> None:
        # a row per month and event
        found = batch.groupBy("codmes", "evento").agg(F.sum("n_filas").alias("n")).collect()
        closed, again = (sorted(r.codmes for r in found if r.evento == e) for e in ("closed", "late"))
        if found:
            run(closed, [m for m in again if m not in closed], number)

    return announced.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(hand_over).trigger(availableNow=True).start()
