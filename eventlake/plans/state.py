"""Refresh windows and the state they are derived from."""

from __future__ import annotations

import json
import os
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta
from pathlib import Path

from pyspark.sql import SparkSession

from eventlake.tables import LoadSet

DEFAULT_LOOKBACK = timedelta(hours=2)
BEGINNING = datetime.min.replace(tzinfo=UTC)


def _aware(value: datetime, name: str) -> datetime:
    if value.tzinfo is None:
        raise ValueError(f"{name} has no time zone")
    return value.astimezone(UTC)


@dataclass(frozen=True)
class RefreshWindow:
    """[start, end) of receipt times to work on; the very beginning of time if there was no run before."""

    start: datetime
    end: datetime
    lookback: timedelta

    @property
    def bootstrap(self) -> bool:
        return self.start == BEGINNING

    def bounds(self) -> tuple[datetime | None, datetime]:
        """Naive UTC bounds for filters; no lower one in a first run."""
        return (None if self.bootstrap else self.start.replace(tzinfo=None)), self.end.replace(tzinfo=None)


def lookback_of(env: Mapping[str, str] = os.environ) -> timedelta:
    """EVENTLAKE_LOOKBACK_MINUTES, else EVENTLAKE_LOOKBACK_HOURS, else two hours."""
    if env.get("EVENTLAKE_LOOKBACK_MINUTES"):
        return timedelta(minutes=float(env["EVENTLAKE_LOOKBACK_MINUTES"]))
    if env.get("EVENTLAKE_LOOKBACK_HOURS"):
        return timedelta(hours=float(env["EVENTLAKE_LOOKBACK_HOURS"]))
    return DEFAULT_LOOKBACK


def refresh_window(last: datetime | None, now: datetime, lookback: timedelta = DEFAULT_LOOKBACK) -> RefreshWindow:
    if lookback < timedelta(0):
        raise ValueError("a lookback can't be negative")
    end = _aware(now, "now")
    start = BEGINNING if last is None else _aware(last, "last run") - lookback
    if start > end:
        raise ValueError("the window starts after its end")
    return RefreshWindow(start, end, lookback)


class StateStore:
    """One JSON file a job, replaced atomically: the end of its last good window, and the loads of each table that it has had.

    Without a session it lives on the driver's disk; with one it is on any file system that Spark reaches, so another driver goes on from there.
    """

    def __init__(self, folder: str | Path, spark: SparkSession | None = None) -> None:
        self.spark, self.folder = spark, folder if spark else Path(folder)
        if spark:
            self.fs = self._at().getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, *below: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([str(self.folder).rstrip("/"), *below]))

    def _get(self, job: str) -> dict:
        if not self.spark:
            path = self.folder / f"{job}.json"
            return json.loads(path.read_text()) if path.exists() else {}
        for name in (f"{job}.json", f"{job}.json.new"):  # a write that was cut off left the new one alone
            if self.fs.exists(self._at(name)):
                stream = self.fs.open(self._at(name))
                try:
                    return json.loads(bytes(stream.readAllBytes()).decode())
                finally:
                    stream.close()
        return {}

    def _put(self, job: str, value: dict) -> None:
        if not self.spark:
            self.folder.mkdir(parents=True, exist_ok=True)
            part = self.folder / f".{job}.{os.getpid()}.part"
            part.write_text(json.dumps(value))
            part.replace(self.folder / f"{job}.json")
            return
        part, new, at = self._at(f".{job}.part"), self._at(f"{job}.json.new"), self._at(f"{job}.json")
        stream = self.fs.create(part, True)
        try:
            stream.write(bytearray(json.dumps(value).encode()))
        finally:
            stream.close()
        self.fs.delete(new, False)
        self.fs.rename(part, new)
        self.fs.delete(at, False)
        if not self.fs.rename(new, at):
            raise OSError(f"{at} could not be written")

    def read(self, job: str) -> datetime | None:
        value = self._get(job).get("last_successful_run_at")
        return None if value is None else _aware(datetime.fromisoformat(value), "stored time")

    def write(self, job: str, at: datetime, loads: Mapping[str, LoadSet] | None = None) -> None:
        """The end of a good run, and the loads it has had if given; else those stay as they were."""
        had = {k: v.stored() for k, v in loads.items()} if loads is not None else self._get(job).get("loads", {})
        self._put(job, {"last_successful_run_at": _aware(at, "run time").isoformat(), "loads": had})

    def loads(self, job: str, table: str) -> LoadSet:
        return LoadSet(self._get(job).get("loads", {}).get(table))

    def jobs(self) -> list[str]:
        if not self.spark:
            return sorted(f.stem for f in self.folder.glob("*.json"))
        names = [s.getPath().getName() for s in self.fs.listStatus(self._at())] if self.fs.exists(self._at()) else []
        return sorted({n.split(".json")[0] for n in names if not n.startswith(".")})

    def clear(self) -> list[str]:
        jobs = self.jobs()
        if self.spark:
            self.fs.delete(self._at(), True)
        for job in [] if self.spark else jobs:
            (self.folder / f"{job}.json").unlink()
        return jobs
