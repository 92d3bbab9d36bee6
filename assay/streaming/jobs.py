"""One job at a time for each key: what comes while a job runs waits in order, a job that takes too long is given up.

A keyed stateful stream. State of a key: the running job, since when, what it works on, what waits. Time is that of the events,
and a timer in event time fires for a key to which nothing more comes. Before each event the time up to it is played through, so
the outcome is the same however the events are cut into micro-batches, if they come in the order of their time; one that comes
late counts as of the latest time seen for its key.

A micro-batch's events of one key are sorted in one task: bound the micro-batch at the source (maxFilesPerTrigger,
maxBytesPerTrigger). State of a key grows with the distinct folders that wait.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions._columns import Text, col
from ..functions.checks import is_merged
from ..operations import retried
from .incremental import _files

STATE = "job long, since long, folders array<string>, waiting array<string>, clock long"
ACTIONS = "key string, job long, at timestamp, action string, folders array<string>"
TIMEOUT = 3600


class Flight:
    """The jobs of one key; `said` are (job, time, action, folders)."""

    def __init__(self, timeout: int, job: int = 0, since: int | None = None, folders: list[str] = (), waiting: list[str] = (), clock: int | None = None):
        self.timeout, self.job, self.since, self.folders, self.waiting, self.clock = timeout, job, since, list(folders), list(waiting), clock
        self.said: list[tuple[int, int, str, list[str]]] = []

    def _say(self, at: int, action: str, folders: list[str], job: int | None = None) -> None:
        self.said.append((self.job if job is None else job, at, action, list(folders)))

    def _start(self, at: int, folders: list[str]) -> None:
        self.job, self.since, self.folders, self.waiting = self.job + 1, at, list(folders), []
        self._say(at, "started", self.folders)

    def _end(self, at: int, action: str) -> None:
        self._say(at, action, self.folders)
        self.since, self.folders = None, []
        if self.waiting:
            self._start(at, self.waiting)

    def until(self, now: int) -> None:
        """Gives up the jobs whose time is over before `now`; the next one starts at that moment."""
        while self.since is not None and now - self.since > self.timeout:
            self._end(self.since + self.timeout, "timed_out")

    def event(self, at: int, kind: str | None, folders: list[str], job: int | None) -> None:
        at = at if self.clock is None else max(at, self.clock)
        self.clock = at
        self.until(at)
        folders = list(dict.fromkeys(f for f in folders if f is not None))
        if kind == "done" and self.since is not None and job in (None, self.job):
            self._end(at, "finished")
        elif kind != "new" or not folders:
            self._say(at, "ignored", folders, self.job if job is None else job)
        elif self.since is None:
            self._start(at, folders)
        else:
            fresh = [f for f in folders if f not in self.waiting]
            self.waiting += fresh
            self._say(at, "queued", fresh)


def single_flight(events: DataFrame, timeout: int = TIMEOUT, late: str = "0 seconds") -> DataFrame:
    """(key, job, at, action, folders) of a stream of events (key, ts, kind, folders, job), in append mode.

    kind "new": folders to work on; they start a job, or wait, each once, behind what waits. kind "done": the job of that number
    has ended, without a number the one that runs; all that waits is the next job. Actions are started, queued (the folders that
    did not wait yet), finished, timed_out after more than `timeout` seconds, and ignored: no folders, a kind that is not known,
    the end of a job that does not run. Jobs of a key are numbered from 1. Events without key or time are dropped. At one time
    ends come first, then others by their folders.
    """
    span = int(timeout * 1000)
    wanted = events.withColumn("ts", F.col("ts").cast("timestamp")).where("key IS NOT NULL AND ts IS NOT NULL").withWatermark("ts", late)
    rows = wanted.select(F.col("key").cast("string").alias("key"), "ts", F.unix_millis("ts").alias("at"), F.col("kind").cast("string").alias("kind"), F.coalesce("folders", F.array().cast("array<string>")).alias("folders"), F.col("job").cast("long").alias("job"))

    def run(key: tuple[str], batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        flight = Flight(span, *state.get) if state.exists else Flight(span)
        if state.hasTimedOut:
            flight.until(state.getCurrentWatermarkMs())
        else:
            new = pd.concat(list(batches))
            jobs = [None if pd.isna(j) else int(j) for j in new["job"]]
            found = zip(map(int, new["at"]), new["kind"], [[*f] for f in new["folders"]], jobs, strict=True)
            for event in sorted(found, key=lambda e: (e[0], e[1] != "done", [f or "" for f in e[2]], -1 if e[3] is None else e[3])):
                flight.event(*event)
        state.update((flight.job, flight.since, flight.folders, flight.waiting, flight.clock))
        if flight.since is not None:
            state.setTimeoutTimestamp(max(flight.since + span, state.getCurrentWatermarkMs() + 1))
        if flight.said:
            said = pd.DataFrame(flight.said, columns=["job", "at", "action", "folders"])
            said.insert(0, "key", key[0])
            yield said

    acts = rows.groupBy("key").applyInPandasWithState(run, ACTIONS.replace("timestamp", "long"), STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return acts.select("key", "job", F.timestamp_millis("at").alias("at"), "action", "folders")


def merge_events(payloads: DataFrame, key: Text, ts: Text, payload: Text, folders: Text) -> DataFrame:
    """(key, ts, kind, folders, job) of a repository's events: merged changes are new folders, all others are not passed on."""
    merged = payloads.where(is_merged(payload))
    return merged.select(col(key).alias("key"), col(ts).alias("ts"), F.lit("new").alias("kind"), col(folders).alias("folders"), F.lit(None).cast("long").alias("job"))


def folder_files(spark: SparkSession, root: str, folders: list[str], schema: str, tries: int = 3, pause: float = 10.0) -> DataFrame:
    """The JSON rows below data/<folder> of some folders only, with folder and path; the listing is tried again when it fails.

    Folders that are not there give no rows. The names are those of one job, not of the whole store.
    """
    rows = spark.createDataFrame([], f"{schema}, folder string, path string")
    at = [p for f in dict.fromkeys(folders) if _there(spark, p := f"{root.rstrip('/')}/data/{f}")]
    if not at:
        return rows
    read = lambda: spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(at)
    return retried(read, tries, pause).select("*", F.regexp_extract("_metadata.file_path", r".*/data/([^/]+)/", 1).alias("folder"), F.col("_metadata.file_path").alias("path"))


def existing_keys(spark: SparkSession, root: str) -> DataFrame:
    """(key): the stems of the JSON files directly below a folder, read from the listing alone."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(root)
    return files.select(file_stem("path").alias("key")).distinct()


def file_stem(path: Text) -> Column:
    return F.regexp_replace(F.element_at(F.split(col(path), "/"), -1), r"\.json$", "")


def _there(spark: SparkSession, path: str) -> bool:
    files, at = _files(spark, path)
    return files.exists(at)
