"""Publishing by partition and behind a gate: failed, refused and concurrent writers, and what readers see meanwhile."""

import json
import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from turnwright.sinks import gate, parts, publish
from turnwright.streaming import review as streams


def shown(spark, path, number=None):
    return sorted(map(tuple, parts.read(spark, path, number).select("id", "v", "p").collect()))


def rows(spark, *values):
    return spark.createDataFrame(values, "id long, v string, p string")


def test_only_partitions_with_rows_are_replaced(spark, tmp_path):
    path = str(tmp_path)
    assert parts.read(spark, path) is None
    parts.replace(rows(spark, (1, "a", "x"), (2, "b", "y"), (3, "c", None), (4, "d", "w z/=%")), path, ["p"])
    before = parts.read(spark, path)
    parts.replace(rows(spark, (5, "e", "y"), (6, "f", "new")), path, ["p"])
    parts.replace(rows(spark).limit(0), path, ["p"])
    assert shown(spark, path) == sorted([(1, "a", "x"), (5, "e", "y"), (6, "f", "new"), (3, "c", None), (4, "d", "w z/=%")])
    assert sorted(r.id for r in before.collect()) == [1, 2, 3, 4]  # a reader that began before
    assert [r[0] for r in shown(spark, path, 1)] == [1, 2, 3, 4]
    with pytest.raises(ValueError, match="dealt by"):
        parts.replace(rows(spark, (1, "a", "x")), path, ["v"])


def test_a_failed_writer_leaves_all_as_it_was(spark, tmp_path):
    path = str(tmp_path)
    parts.replace(rows(spark, (1, "a", "x")), path, ["p"])
    with pytest.raises(Exception, match="writer failed"):
        parts.replace(rows(spark, (2, "b", "x")).withColumn("v", F.raise_error(F.lit("writer failed")).cast("string")), path, ["p"])
    assert shown(spark, path) == [(1, "a", "x")]


def test_writers_at_once_lose_nothing(spark, tmp_path):
    path, failed = str(tmp_path), []

    def write(k):
        try:
            parts.replace(rows(spark, (k, "a", f"p{k}"), (k, "shared", "s")), path, ["p"])
        except Exception as e:
            failed.append(e)

    threads = [threading.Thread(target=write, args=(k,)) for k in range(5)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    got = shown(spark, path)
    assert not failed and [r for r in got if r[1] == "a"] == [(k, "a", f"p{k}") for k in range(5)] and len(got) == 6
    assert parts.latest(spark, path)[0] == 5


def test_a_manifest_is_never_overwritten(spark, tmp_path):
    path = str(tmp_path)
    parts.replace(rows(spark, (1, "a", "x")), path, ["p"])
    assert not parts._add(spark, path, 1, {"parts": {}})
    assert shown(spark, path) == [(1, "a", "x")]


def test_vacuum_drops_only_what_is_old_and_unused(spark, tmp_path):
    path = str(tmp_path)
    for v in "abc":
        parts.replace(rows(spark, (1, v, "x"), (2, v, v)), path, ["p"])
    (tmp_path / "data" / "other").mkdir()
    assert parts.vacuum(spark, path) == 0
    time.sleep(0.1)
    assert parts.vacuum(spark, path, hours=0) == 0  # each version still holds a partition
    parts.replace(rows(spark, (2, "d", "a")), path, ["p"])
    time.sleep(0.1)
    assert parts.vacuum(spark, path, hours=0) == 1 and (tmp_path / "data" / "other").exists()
    assert shown(spark, path) == [(1, "c", "x"), (2, "b", "b"), (2, "c", "c"), (2, "d", "a")]


def test_foreign_folders_and_other_writers_versions_stay(spark, tmp_path):
    path = str(tmp_path)
    for name in ("checkpoint", "v-other", "log"):
        (tmp_path / name).mkdir()
    for n in range(3):
        publish.atomic(spark.range(n + 1).toDF("id"), path)
    assert {"checkpoint", "v-other", "log"} <= {f.name for f in tmp_path.iterdir()} and len(list(tmp_path.glob("v-*"))) == 4
    time.sleep(0.1)
    publish.atomic(spark.range(9).toDF("id"), path, hours=0)
    assert (tmp_path / "checkpoint").exists() and len(list(tmp_path.glob("v-*"))) == 2


@pytest.mark.parametrize(("bad", "rule"), [((None, "a", "x"), "id is missing"), ((2, "", "x"), "v is missing"), ((2, "long", "x"), "v is long")])
def test_the_gate_refuses_what_breaks_a_rule(spark, tmp_path, bad, rule):
    rules = lambda: gate.Gate(gate.required(["id", "v"]) | {"v is long": F.length("v") > 3})
    whole, split = str(tmp_path / "whole"), str(tmp_path / "split")
    old = publish.atomic(rows(spark, (1, "a", "x")), whole, gate=rules())
    parts.replace(rows(spark, (1, "a", "x")), split, ["p"], rules())
    wrong = rows(spark, (3, "c", "y"), bad)
    for write in (lambda: publish.atomic(wrong, whole, gate=rules()), lambda: parts.replace(wrong, split, ["p"], rules())):
        with pytest.raises(gate.RefusedError) as e:
            write()
        assert e.value.counts == {rule: 1}
    assert publish.current(spark, whole) == old and len(list((tmp_path / "whole").glob("v-*"))) == 1
    assert shown(spark, split) == [(1, "a", "x")] and len(list((tmp_path / "split" / "data").iterdir())) == 1
    with pytest.raises(gate.RefusedError, match="no rows"):
        publish.atomic(wrong.limit(0), whole, gate=rules())


def site(**changes):
    meeting = {"meeting_id": "m1", "meeting_date": "2026-01-06", "title": "T", "meeting_type": "council", "source_video_url": "u", "transcript_url": "t/m1.html", "transcript_turns_js": "docs/js/m1.js"}
    files = dict.fromkeys(gate.SITE_ASSETS, "x") | {"meetings/m1.json": meeting, "docs/t/m1.html": "<html>", "docs/js/m1.js": "const  TRANSCRIPT_TURNS = [{}];"} | changes
    return [(p, json.dumps(c) if isinstance(c, dict) else c) for p, c in files.items() if c is not None], meeting


@pytest.mark.parametrize(
    ("change", "want"),
    [
        ({}, []),
        ({"docs/js/search.js": None}, [("docs/js/search.js", "missing asset", True)]),
        ({"meetings/m1.json": None}, [("meetings", "no meeting metadata", True)]),
        ({"docs/js/m1.js": "let TURNS = []"}, [("docs/js/m1.js", "does not define TRANSCRIPT_TURNS", True)]),
        ({"docs/t/m1.html": None}, [("meetings/m1.json", "not published yet", False)]),
        ({"docs/js/m1.js": None}, [("meetings/m1.json", "not published yet", False)]),
        *(({"field": c}, [("meetings/m1.json", f"missing required field {c}", True)]) for c in gate.SITE_FIELDS),
        ({"meetings/m2.json": site()[1]}, [("meetings/m2.json", "filename stem must equal meeting_id", True)]),
        ({"meetings/sub/m3.json": "{}"}, []),
    ],
)
def test_each_check_of_a_site(spark, change, want):
    if "field" in change:
        change = {"meetings/m1.json": site()[1] | {change["field"]: ""}}
    files = spark.createDataFrame(site(**change)[0], "path string, content string")
    assert [tuple(r) for r in gate.site_violations(files).collect()] == want


def decision(meeting, turn, at, **more):
    return {"meeting_id": meeting, "turn_id": turn, "at": at, "reviewer_action": "approve", "speaker_public_override": "", "text_override": "", "suppress": False, "evidence_note": ""} | more


def test_only_touched_meetings_are_published_again(spark, tmp_path):
    turns = spark.createDataFrame([(m, f"t{k}", k, "A", f"{m} {k}", True, None) for m in ("m1", "m2", "m3") for k in range(4)], "meeting_id string, turn_id string, pos long, speaker_public string, text string, needs_review boolean, review_reason string")
    keys, fields, path, state = ["meeting_id", "turn_id"], ["turn_id", "speaker_public", "text", "needs_review", "review_reason"], str(tmp_path / "docs"), str(tmp_path / "state")
    parts.replace(streams.documents(turns, None, keys, ["at"], fields), path, ["meeting_id"])
    bytes_of = lambda: {str(f.relative_to(tmp_path)): (f.read_bytes(), f.stat().st_mtime_ns) for f in (tmp_path / "docs").rglob("*.parquet")}
    before = bytes_of()
    source = tmp_path / "in"
    source.mkdir()
    batches = [[decision("m1", "t1", 1, text_override="one")], [decision("m2", "t0", 2, suppress=True), decision("m1", "t1", 3, text_override="two"), decision("m9", "t1", 3)]]
    for k, batch in enumerate(batches):
        (source / f"{k}.json").write_text("\n".join(map(json.dumps, batch)))
        os.utime(source / f"{k}.json", (1_700_000_000 + 100 * k,) * 2)
    schema = "meeting_id string, turn_id string, at long, reviewer_action string, speaker_public_override string, text_override string, suppress boolean, evidence_note string"

    def run(check):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(source))
        streams.republish(stream, turns, state, path, str(tmp_path / check), keys, ["at"], fields).awaitTermination()
        return {r.meeting_id: r.content for r in parts.read(spark, path).collect()}

    got = run("a")
    whole = streams.documents(turns, spark.read.schema(schema).json(str(source)), keys, ["at"], fields)
    assert got == {r.meeting_id: r.content for r in whole.collect()}
    texts = {m: [t["text"] for t in json.loads(c)["turns"]] for m, c in got.items()}
    assert texts == {"m1": ["m1 0", "two", "m1 2", "m1 3"], "m2": ["[REDACTED]", "m2 1", "m2 2", "m2 3"], "m3": [f"m3 {k}" for k in range(4)]}
    versions = parts.latest(spark, path)[1]["parts"]
    assert len({*versions.values()}) == 2 and before.items() <= bytes_of().items()
    first = parts._manifest(spark, path, 1)["parts"]
    assert versions["meeting_id=m3"] == first["meeting_id=m3"] and versions["meeting_id=m1"] != first["meeting_id=m1"]
    assert run("b") == got  # all batches once more


def test_repeated_decisions_go_once_within_the_watermark(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()

    def run(k, *events):
        (source / f"{k}.json").write_text("\n".join(json.dumps({"id": i, "ts": f"2024-01-01T{t}:00Z"}) for i, t in events))
        os.utime(source / f"{k}.json", (1_700_000_000 + 100 * k,) * 2)
        stream = spark.readStream.schema("id long, ts timestamp").json(str(source))
        q = streams.once(stream, ["id"], "ts", "10 minutes").writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
        q.awaitTermination()  # each call starts the query again from its checkpoint
        return sorted(r.id for r in spark.read.schema("id long, ts timestamp").parquet(str(tmp_path / "out")).collect())

    assert run(0, (1, "10:00"), (1, "10:01"), (2, "10:02")) == [1, 2]
    assert run(1, (1, "10:05"), (3, "10:06")) == [1, 2, 3]
    run(2, (4, "12:00"))
    assert run(3, (5, "10:00")) == [1, 2, 3, 4]  # too late
    run(4, (6, "12:01"))
    assert run(5, (1, "12:02")) == [1, 1, 2, 3, 4, 6]  # forgotten, as a repeat comes no longer
