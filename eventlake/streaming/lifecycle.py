"""The life of accounts as a keyed state machine over a stream of identity and account events."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from eventlake.operators.history import account_state

#: Keyed state with timers needs this state store.
PROVIDER = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
EVENT = "at_us long, event_kind string, is_active boolean, status string, sets string"
STRETCH = "actor_did string, state string, from_us long, to_us long, seconds double"


def order(event: Row) -> tuple:
    """Nulls first, as SQL sorts."""
    return (event.at_us, event.event_kind, event.is_active is not None, bool(event.is_active), event.status is not None, event.status or "")


class Lifecycle(StatefulProcessor):
    """Holds an account's events until the watermark has passed them, then takes them in the order of their time.

    State of a key: its state and since when, and the events of the last ``delay``.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", EVENT)
        self.now = handle.getValueState("now", "state string, since_us long, sets string")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        for row in rows:
            self.held.appendValue((row.at_us, row.event_kind, row.is_active, row.status, row.sets))
            self.handle.registerTimer(row.at_us // 1000 + 1)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        events = sorted((Row(at_us=e[0], event_kind=e[1], is_active=e[2], status=e[3], sets=e[4]) for e in self.held.get()), key=order)
        ready, later = [e for e in events if e.at_us < passed], [e for e in events if e.at_us >= passed]
        if not ready:
            return
        state, since, known = tuple(self.now.get()) if self.now.exists() else (None, None, None)
        for k, event in enumerate(ready):
            known = event.sets or known
            if k + 1 < len(ready) and ready[k + 1].at_us == event.at_us:
                continue
            new = known or "active"
            if new != state:
                if state is not None:
                    yield Row(actor_did=key[0], state=state, from_us=since, to_us=event.at_us, seconds=(event.at_us - since) / 1e6)
                state, since = new, event.at_us
        self.now.update((state, since, known))
        self.held.clear()
        for e in later:
            self.held.appendValue((e.at_us, e.event_kind, e.is_active, e.status, e.sets))

    def close(self) -> None:
        pass


def prepare(spark: SparkSession) -> None:
    """The settings of a session that runs ``stretches``."""
    for k, v in PROVIDER.items():
        spark.conf.set(k, v)


def stretches(changes: DataFrame, delay: str) -> DataFrame:
    """actor_did, state, from_us, to_us, seconds of each stretch that has ended, from a stream of ``history.actor_changes``; later events than ``delay`` are left out."""
    rows = changes.where("actor_did IS NOT NULL AND at_us IS NOT NULL").withColumns({"sets": account_state(), "at": F.timestamp_micros("at_us")}).withWatermark("at", delay)
    return rows.groupBy("actor_did").transformWithState(statefulProcessor=Lifecycle(), outputStructType=STRETCH, outputMode="Append", timeMode="EventTime")
