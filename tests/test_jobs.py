"""One job at a time: queue, order, timeouts and late ends, in one micro-batch and in several, against a plain list of rules."""

from __future__ import annotations

import datetime as dt
import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from assay import catalog
from assay.streaming.jobs import existing_keys, folder_files, merge_events, single_flight

EVENTS = "key string, ts timestamp, kind string, folders array<string>, job long"
ZERO = dt.datetime(2024, 1, 1)


def at(seconds):
    return ZERO + dt.timedelta(seconds=seconds)


def run(spark, tmp_path, batches, timeout=100):
    """The actions by key, each a list of (job, seconds, action, folders) in the order of time."""
    source = tmp_path / "source"
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(f"file://{source}/batch={i:03d}")
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"file://{source}")
    out = f"file://{tmp_path}/out"
    query = single_flight(stream, timeout).writeStream.format("parquet").option("path", out).option("checkpointLocation", f"file://{tmp_path}/checkpoint").trigger(availableNow=True).start()
    assert query.awaitTermination(120)
    got = {}
    for r in spark.read.parquet(out).collect():
        got.setdefault(r.key, []).append((r.job, (r.at - ZERO) // dt.timedelta(seconds=1), r.action, list(r.folders)))
    order = {"finished": 0, "timed_out": 0, "started": 1}
    return {k: sorted(v, key=lambda e: (e[1], e[0], order.get(e[2], 2), e[3])) for k, v in got.items()}


def plain(events, timeout, end):
    """The rules for one key, moment by moment."""
    out, running, since, waiting, n = [], None, None, [], 0

    def start(t, what):
        nonlocal running, since, waiting, n
        n, running, since, waiting = n + 1, list(what), t, []
        out.append((n, t, "started", running))

    def stop(t, action):
        nonlocal running
        out.append((n, t, action, running))
        running = None
        if waiting:
            start(t, waiting)

    for t in sorted({e[0] for e in events} | {end}):
        while running is not None and t - since > timeout:
            stop(since + timeout, "timed_out")
        for _, kind, folders, job in sorted((e for e in events if e[0] == t), key=lambda e: (e[1] != "done", e[2])):
            if kind == "done" and running is not None and job in (None, n):
                stop(t, "finished")
            elif kind != "new" or not folders:
                out.append((n if job is None else job, t, "ignored", folders))
            elif running is None:
                start(t, folders)
            else:
                fresh = [f for f in folders if f not in waiting]
                waiting += fresh
                out.append((n, t, "queued", fresh))
    order = {"finished": 0, "timed_out": 0, "started": 1}
    return sorted(out, key=lambda e: (e[1], e[0], order.get(e[2], 2), e[3]))


def test_queue_timeout_and_late_end(spark, tmp_path):
    rows = [
        [("a", at(0), "new", ["x", "x", None], None), ("a", at(10), "new", ["z", "y"], None), (None, at(1), "new", ["x"], None), ("a", None, "new", ["x"], None)],
        [("a", at(20), "new", ["w", "z"], None), ("a", at(30), "done", None, 1), ("a", at(40), "new", None, None)],
        [("a", at(150), "new", ["v"], None), ("a", at(151), "done", None, 2), ("a", at(152), None, ["q"], None)],
        [("b", at(1000), "done", None, None)],
    ]
    got = run(spark, tmp_path, rows)
    assert got["a"] == [
        (1, 0.0, "started", ["x"]), (1, 10.0, "queued", ["z", "y"]), (1, 20.0, "queued", ["w"]), (1, 30.0, "finished", ["x"]), (2, 30.0, "started", ["z", "y", "w"]),
        (2, 40.0, "ignored", []), (2, 130.0, "timed_out", ["z", "y", "w"]), (3, 150.0, "started", ["v"]), (2, 151.0, "ignored", []), (3, 152.0, "ignored", ["q"]), (3, 250.0, "timed_out", ["v"]),
    ]
    assert got["b"] == [(0, 1000.0, "ignored", [])]


@pytest.mark.parametrize("cuts", [1, 5])
def test_equals_plain_rules_however_cut(spark, tmp_path, cuts):
    rng = random.Random(3)
    events = {k: [] for k in ("p", "q", "r")}
    for k, own in events.items():
        for t in sorted(rng.sample(range(600), 60)):
            own.append((t, "done", [], rng.choice([None, None, 1, 2, 3])) if rng.random() < 0.4 else (t, "new", sorted(rng.sample("abcdef", rng.randint(0, 3))), None))
    events["last"] = [(2000, "done", [], None)]
    rows = sorted(((t, k, kind, folders, job) for k, own in events.items() for t, kind, folders, job in own), key=lambda e: e[:2])
    size = -(-len(rows) // cuts)
    batches = [[(k, at(t), kind, folders, job) for t, k, kind, folders, job in rows[i : i + size]] for i in range(0, len(rows), size)]
    assert run(spark, tmp_path, batches, 45) == {k: plain(own, 45, 2000) for k, own in events.items()}


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="no test tables")
def test_query_equals_plain_rules(spark):
    sf = "/root/testdata/sf0.001"
    ms = lambda t: (t - ZERO) // dt.timedelta(milliseconds=1)
    kinds = {"purchase": "new", "click": "new", "signup": "done"}
    events = {}
    for r in catalog.read(spark, sf, "events").collect():
        kind = kinds.get(r.event_type)
        events.setdefault(f"u{r.user_id}", []).append((ms(r.ts), kind or "", [f"f{r.event_id % 7}"] if kind == "new" else [], None))
    end = max(e[0] for own in events.values() for e in own)
    want = sorted((k, *e[:3], tuple(e[3])) for k, own in events.items() for e in plain(own, 3_600_000, end))
    got = sorted((r.key, r.job, ms(r.at), r.action, tuple(r.folders)) for r in catalog.QUERIES["q2_single_flight"](spark, sf).collect())
    assert got == want
    assert {"started", "queued", "finished", "timed_out", "ignored"} == {e[3] for e in got}


def test_payloads_and_folders(spark, tmp_path):
    payload = lambda status, pull: json.dumps({"discussion": {"status": status, "isPullRequest": pull}})
    rows = spark.createDataFrame([("r", at(1), payload("merged", True), ["a"]), ("r", at(2), payload("open", True), ["b"]), ("r", at(3), payload("merged", False), ["c"]), ("r", at(4), None, ["d"])], "repo string, ts timestamp, body string, folders array<string>")
    assert [(r.key, r.kind, r.folders, r.job) for r in merge_events(rows, "repo", "ts", "body", "folders").collect()] == [("r", "new", ["a"], None)]
    for name in ("a/m1/one.json", "a/two.json", "b/three.json", "a/four.txt"):
        path = tmp_path / "data" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text('{"v": 1}')
    root = f"file://{tmp_path}"
    got = folder_files(spark, root, ["a", "missing", "a"], "v int").select("folder", "v", F.element_at(F.split("path", "/"), -1).alias("file")).collect()
    assert sorted(map(tuple, got)) == [("a", 1, "one.json"), ("a", 1, "two.json")]
    assert folder_files(spark, root, ["missing"], "v int").count() == 0
    assert [r.key for r in existing_keys(spark, f"{root}/data/b").collect()] == ["three"]
