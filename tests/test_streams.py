"""Streams in shuffled micro-batches against what a batch gives."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tests import plain
from turnwright.streaming import sessions

EPOCH = 1_704_067_200


def files(folder, batches):
    """One file a batch, in order."""
    folder.mkdir()
    for k, rows in enumerate(batches):
        (folder / f"{k}.json").write_text("\n".join(json.dumps(r) for r in rows))
        os.utime(folder / f"{k}.json", (1_700_000_000 + 100 * k,) * 2)


def event(key, t, speaker="A", text="some words"):
    return {"key": key, "ts": f"{__import__('datetime').datetime.fromtimestamp(EPOCH + t, __import__('datetime').timezone.utc):%Y-%m-%dT%H:%M:%S.%fZ}", "speaker": speaker, "text": text}


def run(spark, path, name, gap, cap, most=None, late="60 seconds", **columns):
    stream = spark.readStream.schema("key long, ts timestamp, speaker string, text string").option("maxFilesPerTrigger", 1).json(f"{path}/in")
    out = sessions.capped_sessions(stream, "key", gap, cap, late=late, most=most, **columns)
    q = out.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", f"{path}/ck").trigger(availableNow=True).start()
    q.awaitTermination()
    return sorted((r.key, round(r.start - EPOCH, 3), round(r.end - EPOCH, 3), r.speaker, r.text, r.n) for r in spark.table(name).collect())


@pytest.fixture(autouse=True)
def store(spark):
    before = spark.conf.get(sessions.STATE_STORE[0])
    yield
    spark.conf.set(sessions.STATE_STORE[0], before)


def test_order_of_arrival_changes_nothing(spark, tmp_path):
    """Events of sessions of a second's gap, dealt to batches up to 50 seconds out of order; the last event moves the watermark past all."""
    r = random.Random(3)
    rows, at = [], 0.0
    for _ in range(160):
        at = round(at + r.choice([0.2, 0.5, 1.0, 1.2, 1.3, 4.0]), 1)
        rows.append((r.randrange(2), at, r.choice("AAB"), r.choice(["we go", "Stop.", "x" * 30])))
    want = []
    for key in (0, 1):
        turns = [{"pos": t, "start": t, "end": t, "speaker": s, "text": x} for k, t, s, x in rows if k == key]
        want += [(key, b["start"], b["end"], b["speaker"], b["text"], b["n"]) for b in plain.chunk_turns(turns, gap=1.2, cap=6.0, most=60)]
    moved = sorted(rows, key=lambda x: x[1] + r.uniform(0, 50))
    done = [event(k, 100_000) for k in (0, 1)]
    for n, order in enumerate((rows, moved)):
        path = tmp_path / str(n)
        path.mkdir()
        files(path / "in", [[event(*x) for x in order[k : k + 23]] for k in range(0, len(order), 23)] + [done])
        assert run(spark, path, f"sessions{n}", 1.2, 6.0, 60, speaker="speaker", text="text") == sorted(want)


def test_two_events_far_apart_in_either_order(spark, tmp_path):
    for n, times in enumerate(((100.0, 200.0), (200.0, 100.0))):
        path = tmp_path / str(n)
        path.mkdir()
        files(path / "in", [[event(1, t)] for t in times] + [[event(1, 9_000.0)]])
        assert [x[:3] + x[5:] for x in run(spark, path, f"far{n}", 10, 1e9, late="10 minutes")] == [(1, 100, 100, 1), (1, 200, 200, 1)]


def test_cap_is_met_exactly_and_late_events_are_dropped(spark, tmp_path):
    files(tmp_path / "in", [[event(1, t) for t in (0, 1, 2, 3, 4)], [event(1, 500)], [event(1, 600)], [event(1, 2.5)], [event(1, 900)]])
    got = [x[:3] + x[5:] for x in run(spark, tmp_path, "capped", 1, 2)]
    assert got == [(1, 0, 2, 3), (1, 3, 4, 2), (1, 500, 500, 1), (1, 600, 600, 1)]
