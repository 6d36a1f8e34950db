"""Queries that SQL can't express, against plain models on whole tables."""

import json
import math

import numpy as np
import pytest

from tests import plain
from turnwright.operators import folds
from turnwright.plans import registry, sequences

SF = "/root/testdata/sf0.001"


def distance(a, b):
    """Words to change, add or drop, by the table of distances."""
    if not a or not b:
        return max(len(a), len(b))
    number = {w: k for k, w in enumerate(dict.fromkeys(a + b))}
    b = np.array([number[w] for w in b])
    row, steps = np.arange(len(b) + 1), np.arange(len(b) + 1)
    for k, w in enumerate(a, 1):
        new = np.concatenate([[k], np.minimum(row[1:] + 1, row[:-1] + (b != number[w]))])
        row = np.minimum.accumulate(new - steps) + steps
    return int(row[-1])


@pytest.fixture(scope="module")
def rates(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = {}
    for d, r in docs.items():
        if d + 1 in docs:
            a, b = ((docs[k].text or "").lower().split() for k in (d, d + 1))
            out[d] = (r.lang, distance(a, b) / len(a) if a else float(bool(b)))
    return out


def test_word_error_rate(spark, rates):
    got = {r.doc_id: r.wer for r in registry.queries()["f41_word_error_rate"](spark, SF).collect()}
    assert got.keys() == rates.keys() and all(math.isclose(got[d], rates[d][1]) for d in got)


def test_macro_rate(spark, rates):
    by_lang = {}
    for lang, rate in rates.values():
        by_lang.setdefault(lang, []).append(rate)
    got = {r.lang: (r.wer, r.n) for r in registry.queries()["a16_macro_wer"](spark, SF).collect()}
    assert {k: n for k, (_, n) in got.items()} == {k: len(v) for k, v in by_lang.items()}
    assert all(abs(got[k][0] - np.mean(v)) <= 0.5001e-4 for k, v in by_lang.items())


def test_average_linkage(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    got = {r.vec_id: r.cluster for r in registry.queries()["g3_average_linkage"](spark, SF).collect()}
    for label in {r.label for r in rows}:
        own = sorted((r for r in rows if r.label == label), key=lambda r: r.vec_id)
        x = np.array([r.embedding for r in own], float)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        sim, clusters = x @ x.T, [[k] for k in range(len(own))]
        while len(clusters) > 1:
            mean, i, j = max((np.mean(sim[np.ix_(a, b)]), -i, -j) for i, a in enumerate(clusters) for j, b in enumerate(clusters) if i < j)
            if mean < 0.3:
                break
            clusters[-i] += clusters.pop(-j)
        want = {frozenset(own[k].vec_id for k in c) for c in clusters}
        found = {}
        for r in own:
            found.setdefault(got[r.vec_id], set()).add(r.vec_id)
        assert {frozenset(c) for c in found.values()} == want


@pytest.fixture(scope="module")
def recorded(spark):
    """Entry point A in plain steps: words get the longest interval around their middle, then chunks, names, runs, and the folds."""
    by_user = {}
    for r in spark.read.parquet(f"{SF}/events.parquet").selectExpr("user_id", "event_id", "ts", "event_type", "value", "props", "floor(timestampdiff(MICROSECOND, TIMESTAMP_NTZ '2024-01-01', ts) / 1000000) AS s").orderBy("user_id", "ts", "event_id").collect():
        by_user.setdefault(r.user_id, []).append(r)
    out = {}
    for user, rows in by_user.items():
        marks = [(r.s / 3600, (r.s + math.floor(r.value * 100 + 0.5) * 36) / 3600, r.event_type) for r in rows if r.event_type in ("view", "purchase")]
        words = []
        for pos, r in enumerate(rows, 1):
            if r.event_type not in ("view", "purchase"):
                at = r.s / 3600
                over = [(a - b, who) for a, b, who in marks if a <= at + 0.25 < b]
                words.append({"pos": pos, "start": at, "end": at + 0.5, "text": f"{r.event_type} {r.props}", "speaker": min(over)[1] if over else "UNKNOWN"})
        runs = []
        for c in plain.chunk_turns(sorted(words, key=lambda w: (w["start"], w["pos"])), 24.0, 168.0):
            if runs and runs[-1]["raw"] == c["speaker"]:
                runs[-1] |= {"end": max(runs[-1]["end"], c["end"]), "text": f"{runs[-1]['text']} {c['text']}"}
            else:
                named = c["speaker"] == "view"
                status = "approved" if named else "unknown" if c["speaker"] == "UNKNOWN" else "unresolved"
                runs.append({"meeting_id": user, "pos": len(runs) + 1, "start": c["start"], "end": c["end"], "speaker": "Ada Moss" if named else "Unknown Speaker", "raw": c["speaker"], "status": status, "text": c["text"], "handoff_applied": False, "self_intro_applied": False})
        out[user] = folds.repair_fragments(folds.chain_merge(folds.hand_offs(runs)))
    return {k: v for k, v in out.items() if v}


FIELDS = ("speaker", "start", "end", "text", "status")


def test_recording_to_turns(spark, recorded):
    got = {}
    for r in registry.queries()["x1_recording_to_turns"](spark, SF).orderBy("meeting_id", "pos").collect():
        got.setdefault(r.meeting_id, []).append(r)
    assert got.keys() == recorded.keys()
    for user, rows in recorded.items():
        assert [(r.pos, r.raw, *(r[c] for c in FIELDS if isinstance(r[c], str))) for r in got[user]] == [(r["pos"], r["raw"], *(r[c] for c in FIELDS if isinstance(r[c], str))) for r in rows]
        assert np.allclose([(r.start, r.end) for r in got[user]], [(r["start"], r["end"]) for r in rows])


def test_published_documents(spark, recorded):
    got = {r.meeting_id: json.loads(r.content) for r in registry.queries()["x1_publish"](spark, SF).collect()}
    assert got.keys() == recorded.keys()
    for user, rows in recorded.items():
        assert got[user]["schema"] == "structured_transcript.v1" and got[user]["meeting_id"] == user
        assert [(t["speaker"], t["text"], t["status"]) for t in got[user]["turns"]] == [(r["speaker"], r["text"], r["status"]) for r in rows]


def test_folds_without_sql(spark):
    """W8 and W14 over the whole table, meeting by meeting."""
    meetings = {}
    for r in sequences._turns_for_folds(spark, SF).orderBy("meeting_id", "pos").collect():
        meetings.setdefault(r.meeting_id, []).append(r.asDict())
    for name, work in (("w8_chain_merge", folds.chain_merge), ("w14_stray_tokens", folds.stray_tokens)):
        df = registry.queries()[name](spark, SF)
        want = sorted(tuple(r[c] for c in df.columns) for rows in meetings.values() for r in work([dict(x) for x in rows]))
        assert sorted(map(tuple, df.collect())) == want
