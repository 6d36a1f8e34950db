"""Sources, sinks and streams on small files."""

import json
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from turnwright.functions import text as t
from turnwright.operators import graph, resolve, review, sequence, temporal, vectors
from turnwright.sinks import publish
from turnwright.sources import scans
from turnwright.streaming import review as streams


def test_webvtt_marks_headers_and_watermarks(spark):
    vtt = "﻿WEBVTT\n\n1\n00:00:01.000 --> 00:00:02.500\n>> Hello\nthere\n\nNOTE x\n\n00:00:03.000 --> 00:00:04.000 align:left\n<v Ada>and on\n\n00:00:05.000 --> 00:00:06.000\nwww.caption.example\n"
    got = scans.webvtt(spark.createDataFrame([(1, vtt)], "id int, text string"), "id").orderBy("start_ms").collect()
    assert [(r.start_ms, r.end_ms, r.new_speaker, r.text) for r in got] == [(1000, 2500, True, "Hello there"), (3000, 4000, False, "and on")]


def test_files_round_trip(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"meeting_id": "m1", "meeting_date": "2026-01-06", "sections": [{"start_seconds": 0, "label": "Open"}]}))
    (tmp_path / "b.json").write_text(json.dumps({"meeting_id": "m2", "meeting_date": "2026-02-06"}))
    (tmp_path / "c.json").write_text("{broken")
    assert [r.meeting_id for r in scans.meetings(spark, str(tmp_path)).collect()][:2] == ["m2", "m1"]
    rows = spark.createDataFrame([(1, 'a "b", c'), (2, "d")], "id int, x string")
    publish.csv(rows, str(tmp_path / "csv"))
    assert sorted(r.x for r in spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "csv")).collect()) == ['a "b", c', "d"]
    publish.search_index(rows.withColumn("meeting_date", F.lit("2026-01-06").cast("date")), str(tmp_path / "index"))
    assert spark.read.parquet(str(tmp_path / "index")).where("meeting_date = DATE '2026-01-06'").count() == 2
    publish.append_state(rows, str(tmp_path / "log"))
    publish.append_state(rows, str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).count() == 4
    (tmp_path / "reg.json").write_text(json.dumps({"speakers": [{"speaker_key": "a", "display_name": "Old"}, {"speaker_key": "a", "display_name": "Ada Moss"}, {"speaker_key": " "}]}))
    assert [r.display_name for r in scans.registry(spark, str(tmp_path / "reg.json")).collect()] == ["Ada Moss"]


def test_js_with_trailing_comma(spark):
    js = 'const TURNS = [{"turnId": "1", "text": "a; b",},\n{"turnId": "2"},];\nif (typeof module) {}'
    df = spark.createDataFrame([(js,)], "s string").select(F.explode(scans.js_array(F.col("s"), "TURNS", "array<struct<turnId:string,text:string>>")).alias("t"))
    assert [(r.t.turnId, r.t.text) for r in df.collect()] == [("1", "a; b"), ("2", None)]


def test_token_join(spark):
    cases = {("Hello", ",", "you", "'s", "!", "?", "!x"): "Hello, you's!? !x", (".5", "and", ":", "so"): ".5 and: so", (): ""}
    for words, joined in cases.items():
        assert spark.createDataFrame([(list(words),)], "w array<string>").select(t.join_tokens(F.col("w"))).first()[0] == joined


def test_ties_of_the_stabbing_join(spark):
    iv = spark.createDataFrame([(1, 0, 10, "B"), (1, 0, 10, "A"), (1, 2, 5, "C"), (1, 4, 30, "D")], "k int, start int, end int, speaker string")
    p = spark.createDataFrame([(1, 1, 3), (1, 2, 10), (1, 3, 40), (1, 4, 5)], "k int, id int, t int")
    got = {r.id: r.speaker for r in temporal.longest_active(p, iv, ["k"], "id").collect()}
    assert got == {1: "A", 2: "D", 3: "UNKNOWN", 4: "D"}
    assert {r.id: r.speaker for r in temporal.first_active(p, iv, ["k"], "id").collect()}[4] == "A"


def test_small_blocks_at_the_share(spark):
    rows = [(1, 1, 0.0, 0.6, "A"), (1, 2, 1.0, 1.4, "UNKNOWN"), (1, 3, 2.0, 9.0, "B"), (1, 4, 9.0, 9.5, "UNKNOWN")]
    df = spark.createDataFrame(rows, "m int, pos int, start double, end double, speaker string")
    got = sorted((r.start, r.end, r.speaker, r.action) for r in sequence.small_blocks(df, ["m"], ["pos"], 1.5, 0.6 - 1e-9).collect())
    assert got == [(0.0, 1.4, "A", "microblock_cleanup"), (2.0, 9.0, "B", "keep"), (9.0, 9.5, "UNKNOWN", "microblock_deferred")]


def test_decisions_applied_twice_are_as_once(spark):
    turns = spark.createDataFrame([("m", "1", "A", "x", True, None), ("m", "2", "B", "y", True, None)], "meeting_id string, turn_id string, speaker_public string, text string, needs_review boolean, review_reason string")
    d = spark.createDataFrame([("m", "1", 1, "approve", "Z", "", False, ""), ("m", "1", 2, "approve", "", "w", False, "sure"), ("m", "9", 1, "suppress", "", "", True, "")], "meeting_id string, turn_id string, at int, reviewer_action string, speaker_public_override string, text_override string, suppress boolean, evidence_note string")
    once = review.apply(turns, d, ["meeting_id", "turn_id"], ["at"])
    twice = review.apply(once, d, ["meeting_id", "turn_id"], ["at"])
    assert sorted(once.collect()) == sorted(twice.collect()) == [("m", "1", "A", "w", False, "reviewed:approve | sure"), ("m", "2", "B", "y", True, None)]


def test_fuzzy_roster():
    roster = {"ada moss": "Ada Moss", "ben ito": "Ben Ito"}
    assert [resolve.closest(h, roster) for h in ("Ada Moss", "ada mos", "itto", "zzz", "")] == ["Ada Moss", "Ada Moss", "Ben Ito", "", ""]


def test_streams(spark, tmp_path):
    schema = "key long, t double, ts timestamp_ntz, v string"
    for k, rows in enumerate(([(1, 0.0, "2024-01-01T00:00:00", "a"), (2, 0.0, "2024-01-01T00:00:00", "b")], [(1, 5.0, "2024-01-01T03:00:00", "c"), (1, 100.0, "2024-01-02T00:00:00", "d")])):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{k}.json").write_text("\n".join(json.dumps(dict(zip(("key", "t", "ts", "v"), r, strict=True))) for r in rows))
        os.utime(tmp_path / "in" / f"{k}.json", (1_700_000_000 + 100 * k,) * 2)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    q = streams.latest_decisions(stream, str(tmp_path / "state"), str(tmp_path / "ck"), ["key"], ["t"])
    q.awaitTermination()
    state = lambda: sorted((r.key, r.v) for r in streams.decisions(spark, str(tmp_path / "state"), ["key"], ["t"]).collect())
    assert state() == [(1, "d"), (2, "b")]
    assert streams.sessions(spark.read.schema(schema).json(str(tmp_path / "in")), ["key"]).count() == 3


def test_published_table_outlives_a_failed_writer(spark, tmp_path):
    path = str(tmp_path / "t")
    assert publish.current(spark, path) is None
    old = publish.atomic(spark.range(3).toDF("id"), path)
    broken = spark.range(5).select(F.raise_error(F.lit("writer failed")).alias("id"))
    with pytest.raises(Exception, match="writer failed"):
        publish.atomic(broken, path)
    assert publish.current(spark, path) == old and spark.read.parquet(old).count() == 3
    new = publish.atomic(spark.range(7).toDF("id"), path)
    assert publish.current(spark, path) == new and spark.read.parquet(new).count() == 7
    publish.atomic(spark.read.parquet(new).limit(6), path)
    assert spark.read.parquet(publish.current(spark, path)).count() == 6


def test_decision_log_with_snapshots_and_a_batch_that_runs_twice(spark, tmp_path):
    source, path = tmp_path / "in", str(tmp_path / "state")
    source.mkdir()

    def run(check):
        stream = spark.readStream.schema("key long, t long, v string").option("maxFilesPerTrigger", 1).json(str(source))
        streams.latest_decisions(stream, path, str(tmp_path / check), ["key"], ["t"], snapshot=2).awaitTermination()
        return sorted((r.key, r.v) for r in streams.decisions(spark, path, ["key"], ["t"]).collect())

    for k in range(5):
        (source / f"{k}.json").write_text(f'{{"key": {k % 2}, "t": {k}, "v": "{k}"}}')
        os.utime(source / f"{k}.json", (1_700_000_000 + 100 * k,) * 2)
    assert streams.decisions(spark, path, ["key"], ["t"]) is None
    assert run("a") == [(0, "4"), (1, "3")]
    assert run("b") == [(0, "4"), (1, "3")]  # all batches once more, as after a crash that lost the checkpoint
    assert sorted(f.name for f in (tmp_path / "state").glob("upto=*")) == ["upto=1", "upto=3"]


def test_search_document(spark):
    m = spark.createDataFrame([("a", "A"), ("b", "B")], "meeting_id string, title string")
    s = spark.createDataFrame([("a", 2, "Y", "two"), ("a", 1, "X", "one")], "meeting_id string, pos int, speaker string, text string")
    got = {r.meeting_id: json.loads(r.content) for r in publish.search_document(m, s, "now").collect()}
    assert got["a"] == {"generated_at": "now", "meetings": [{"meeting_id": "a", "title": "A"}], "segments": [{"pos": 1, "speaker": "X", "text": "one"}, {"pos": 2, "speaker": "Y", "text": "two"}], "speakers": ["X", "Y"]}
    assert got["b"]["segments"] == [] and got["b"]["speakers"] == []


def test_containment_is_by_substring(spark):
    texts = spark.createDataFrame([(1, "We conCATenate lists", "x"), (2, "nothing here", "y"), (3, None, "z"), (4, "wow ... !?", "u"), (4, "a dog", "v")], "id int, text string, found string").drop("found")
    phrases = spark.createDataFrame([("Cat", 2), ("lists", 5), ("...", 1), ("dog", 9), ("aten", 3), (None, 0), ("!?", 0)], "p string, o int")
    want = [(1, "Cat"), (2, None), (3, None), (4, "!?"), (4, "dog")]
    assert sorted((r.id, r.found) for r in temporal.containment(texts, phrases, "id", "text", "p", "o").collect()) == sorted(want, key=str)
    by_key = {r.id: r.found for r in temporal.containment(texts.where("text is null or text <> 'a dog'"), phrases, "id", "text", "p", "o", limit=6).collect()}
    assert by_key == {1: "Cat", 2: None, 3: None, 4: "!?"}
    every = phrases.union(spark.createDataFrame([("", 4)], "p string, o int"))
    assert {(r.id, r.found) for r in temporal.containment(texts, every, "id", "text", "p", "o").collect()} == {(1, "Cat"), (2, ""), (3, None), (4, "!?"), (4, "")}
    assert temporal.containment(texts, phrases.where("o > 99"), "id", "text", "p", "o").where("found is not null").isEmpty()


def test_components_and_places(spark):
    draw = random.Random(2)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(220)] + [(7, 7), (1000, None)]
    df = spark.createDataFrame(edges, "a long, b long")
    root = {n: n for e in edges for n in e if n is not None}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        if b is not None:
            x, y = top(a), top(b)
            root[max(x, y)] = min(x, y)
    want = {(n, top(n)) for a, b in edges if b is not None and a != b for n in (a, b)}
    for one_task in (1 << 20, 0):
        assert {tuple(r) for r in graph.components(df, one_task=one_task).collect()} == want
    assert graph.components(df.where("a < 0")).isEmpty()
    rows = sequence.places(spark.range(1000).selectExpr("id", "id % 7 AS k").repartition(9), [F.col("k").desc(), "id"])
    got = sorted((r.place, -r.k, r.id) for r in rows.collect())
    assert [p for p, *_ in got] == list(range(1, 1001)) and [g[1:] for g in got] == sorted(g[1:] for g in got)


def test_matches_in_blocks(spark):
    draw = np.random.default_rng(4)
    v = {k: draw.integers(-9, 9, 6).astype(float).tolist() for k in range(70)} | {70: [0.0] * 6}
    df = spark.createDataFrame([(k, x, k % 3) for k, x in v.items()], "id long, e array<double>, g long")
    cos = lambda a, b: float(np.dot(a, b) / (np.linalg.norm(a) * np.linalg.norm(b))) if any(a) and any(b) else 0.0
    got = vectors.similar_pairs(df, "id", "e", "g", 0.4, size=9).collect()
    assert {(r.a, r.b) for r in got} == {(a, b) for a in v for b in v if a < b and a % 3 != b % 3 and cos(v[a], v[b]) >= 0.4}
    top = vectors.top_matches(df.where("id % 5 = 0"), df, "id", "e", 4, size=9).collect()
    for q in range(0, 70, 5):
        mine = sorted((r.place, r.score) for r in top if r.query == q)
        assert np.allclose([s for _, s in mine], sorted((cos(v[q], v[b]) for b in v if b != q), reverse=True)[:4])
