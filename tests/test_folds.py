"""Folds on hand-made turns: limits met exactly, and what must hold for any turns."""

import random

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests import plain
from turnwright.operators import folds, sequence


def turn(start, end, speaker, text="some words", raw=None, status="approved", **more):
    return {"pos": start, "start": start, "end": end, "speaker": speaker, "raw": raw or speaker, "status": status, "text": text, **more}


def who(rows):
    return [(r["speaker"], r["start"], r["end"]) for r in rows]


def test_chunks_close_by_gap_cap_and_length():
    assert len(plain.chunk_turns([turn(0, 1, "A"), turn(2.2, 3, "A")])) == 1 and len(plain.chunk_turns([turn(0, 1, "A"), turn(2.3, 3, "A")])) == 2
    assert len(plain.chunk_turns([turn(0, 35, "A"), turn(35, 36, "A")])) == 2 and len(plain.chunk_turns([turn(0, 34.9, "A"), turn(35, 36, "A")])) == 1
    assert len(plain.chunk_turns([turn(0, 1, "A", "x" * 649 + "."), turn(1, 2, "A")])) == 2 and len(plain.chunk_turns([turn(0, 1, "A", "x" * 650), turn(1, 2, "A")])) == 1


def test_cues_carry_hints_until_a_new_speaker():
    cue = lambda t, text, new=False, hint="": {"pos": t, "start": t, "end": t + 1, "text": text, "new_speaker": new, "speaker_hint": hint}
    got = plain.chunk_cues([cue(0, "a", hint="Ada"), cue(1, "b"), cue(2, "", hint="Ben"), cue(3, "c"), cue(4, "d", new=True), cue(60, "e")])
    assert [(r["speaker"], r["text"]) for r in got] == [("Ada", "a b"), ("Ben", "c"), ("", "d e")]


def test_capped_merge_keeps_the_span():
    assert len(plain.capped_merge([turn(0, 60, "A"), turn(61, 120, "A")])) == 1 and len(plain.capped_merge([turn(0, 60, "A"), turn(61, 121, "A")])) == 2
    assert len(plain.capped_merge([turn(0, 1, "A"), turn(3, 4, "A")])) == 2


def unknown(start, end, **more):
    return turn(start, end, "Unknown Speaker", raw="UNKNOWN", status="unknown", **more)


def test_chain_absorbs_unknown_turns():
    assert who(folds.chain_merge([turn(0, 1, "A"), unknown(2, 3), turn(4, 5, "A")])) == [("A", 0, 5)]
    assert len(folds.chain_merge([turn(0, 1, "A"), unknown(5, 6)])) == 2
    many = [turn(0, 1, "A")] + [turn(k, k + 0.5, "Unknown Speaker", raw="UNKNOWN", status="unknown") for k in range(2, 15)]
    assert folds.chain_merge(many)[0]["n"] == 13
    between = [turn(0, 1, "Unknown Speaker", raw="S1"), unknown(1.5, 2), unknown(2.5, 3), turn(3.5, 4, "Unknown Speaker", raw="S1")]
    assert who(folds.chain_merge(between)) == [("Unknown Speaker", 0, 4)]
    apart = [turn(0, 1, "Unknown Speaker", raw="S1"), unknown(1.5, 2), turn(3.5, 4, "Unknown Speaker", raw="S2")]
    assert len(folds.chain_merge(apart)) == 3


def test_handed_over_turns_keep_to_themselves():
    rows = [turn(0, 1, "A", handoff_applied=True, status="heuristic"), turn(2, 3, "A", raw="x", status="caption")]
    assert len(folds.chain_merge(rows)) == 2
    rows[1]["status"] = "approved"
    assert folds.chain_merge(rows)[0]["status"] == "approved"


def test_fragments_join_across_speakers():
    rows = [turn(0, 1, "A", "we should look at"), turn(2, 3, "B", "the budget of"), turn(4, 5, "C", "Parks now."), turn(6, 7, "D", "and more")]
    assert [r["text"] for r in folds.repair_fragments(rows)] == ["we should look at the budget of Parks now.", "and more"]
    assert len(folds.repair_fragments([turn(0, 1, "A", "done."), turn(1, 2, "A", "and so")])) == 2
    assert len(folds.repair_fragments([turn(0, 1, "Unknown Speaker", "we look at"), turn(1, 2, "A", "the")])) == 2


def test_hand_offs():
    rows = [turn(0, 1, "Janet"), turn(1, 2, "Chair", "I turn it over to Ben Ito"), turn(6, 9, "S3", "Thank you, Jen"), turn(20, 21, "S4")]
    got = folds.hand_offs(rows, {"janet": "jen"})
    assert got[2]["speaker"] == "Ben Ito" and got[2]["handoff_applied"]
    assert folds.hand_offs(rows)[2]["speaker"] == "S3"
    rows[1]["text"] = "turn it over to the City Manager"
    assert folds.hand_offs(rows, {"janet": "jen"})[2]["speaker"] == "S3"


def test_stray_tokens_and_skips():
    assert [r["text"] for r in folds.stray_tokens([turn(0, 1, "A", "Yes. So."), turn(1, 2, "A", "Really now."), turn(2, 3, "A", "I"), turn(4, 5, "A", "Think it is late")])] == ["Yes. So.", "Really now.", "I Think it is late"]
    assert [r["start"] for r in folds.skip_after([turn(t, t + 1, "A", hit=h) for t, h in ((0, True), (30, True), (60, True), (61, False), (130, True))])] == [0, 60, 130]


rows_of = st.lists(st.tuples(st.integers(0, 6), st.integers(0, 8), st.sampled_from(["A", "B", "Unknown Speaker"]), st.sampled_from(["we go", "Stop.", "I", "and on", "the", "turn it over to Ben"])), max_size=12)


@given(rows_of)
def test_merging_keeps_words_in_order_and_spans(drawn):
    rows, at = [], 0.0
    for gap, size, speaker, text in drawn:
        at += gap
        rows.append(turn(at, at + size, speaker, text, raw="UNKNOWN" if speaker == "Unknown Speaker" else speaker, status="unknown" if speaker == "Unknown Speaker" else "approved"))
        at += size
    words = " ".join(r["text"] for r in rows)
    for work in (plain.chunk_turns, plain.capped_merge, folds.chain_merge, folds.repair_fragments, folds.stray_tokens):
        got = work([dict(r) for r in rows])
        assert " ".join(r["text"] for r in got) == words and sum(r["n"] for r in got) == len(rows)
        assert not rows or (got[0]["start"], max(r["end"] for r in got)) == (rows[0]["start"], max(r["end"] for r in rows))


SPLIT = "m long, pos long, start double, end double, speaker string, raw string, status string, text string, new_speaker boolean, speaker_hint string"
TEXTS = ("we go", "Stop.", "I", "and on", "the", "turn it over to Ben Ito", "Thank you, Ada", "Thank you, Jen.", "so it is", "x" * 640 + ".", " ", "Please rise. ", "Yes")


def meetings(seed, n, size):
    r = random.Random(seed)
    out = {}
    for m in range(n):
        rows, at = [], 0.0
        for k in range(r.randrange(size)):
            at = round(at + r.choice([0, 0.3, 1.2, 1.3, 2.9, 3, 3.9, 4, 5, 14, 16, 61]), 3)
            who = r.choice(["Ada", "Ben", "Unknown Speaker", "Janet"])
            raw = r.choice(["UNKNOWN", "S1", "S2"]) if who == "Unknown Speaker" else who
            length = r.choice([0.2, 2, 36])
            rows.append({"m": m, "pos": k, "start": at, "end": round(at + length, 3), "speaker": who, "raw": raw, "status": r.choice(["approved", "heuristic", "unknown", "chair"]), "text": r.choice(TEXTS), "new_speaker": r.random() < 0.2, "speaker_hint": r.choice(["", "", "Ada", "Ben"])})
            at += length if r.random() < 0.8 else length / 2
        out[m] = rows
    return out


@pytest.fixture(scope="module")
def drawn(spark):
    """Meetings of random turns; one of them is large, and ranges cut it."""
    rows = meetings(1, 120, 25) | {900: [{**r, "m": 900} for r in meetings(2, 1, 2)[0]]}
    big = next(x for k in range(3, 60) for x in meetings(k, 1, 2500).values() if len(x) > 1500)
    rows[901] = [{**r, "m": 901} for r in big]
    df = spark.createDataFrame([tuple(r.values()) for x in rows.values() for r in x], SPLIT).repartition(7)
    return rows, df


KEPT = "m long, pos long, start double, end double, speaker string, status string, text string, n long"


@pytest.mark.parametrize(
    ("spread", "whole"),
    [
        (lambda t: folds.chunk_turns(t, ["m"], ["pos"]), plain.chunk_turns),
        (lambda t: folds.capped_merge(t, ["m"], ["pos"]), plain.capped_merge),
        (lambda t: folds.chunk_cues(t, ["m"], ["pos"]), plain.chunk_cues),
        (lambda t: folds.chained(t, ["m"], ["pos"], KEPT), folds.chain_merge),
        (lambda t: folds.repaired(t, ["m"], ["pos"], KEPT), folds.repair_fragments),
        (lambda t: folds.handed_off(t, ["m"], ["pos"], KEPT.rsplit(",", 1)[0], {"janet": "jen"}), lambda rows: folds.hand_offs(rows, {"janet": "jen"})),
        (lambda t: folds.carry_speakers(t, ["m"], ["pos"]), plain.carry_speakers),
        (lambda t: folds.without_strays(t, ["m"], ["pos"], KEPT), folds.stray_tokens),
        (lambda t: folds.skipped_after(t.where("status = 'chair'"), ["m"], ["pos"], KEPT.rsplit(",", 1)[0], 60.0), lambda rows: folds.skip_after([{**r, "hit": True} for r in rows if r["status"] == "chair"])),
        (lambda t: folds.merged(t.withColumn("self_intro_applied", F.lit(False)), ["m"], ["pos"], KEPT), lambda rows: folds.repair_fragments(folds.chain_merge(folds.hand_offs(rows)))),
    ],
    ids=["w2", "w4c", "w3", "w8", "w9", "w10", "w12", "w14", "w19", "merged"],
)
def test_pieces_give_what_whole_meetings_do(spark, drawn, spread, whole):
    rows, df = drawn
    names = ["m", "pos", "start", "end", "speaker", "status", "text"]
    said = lambda r: tuple(r[c].strip() if c == "text" else r[c] for c in names) + ((r["n"],) if "n" in r else ())
    want = sorted(said(r) for x in rows.values() for r in whole([dict(r) for r in x]))
    got = spread(df)
    assert sorted(said(r.asDict()) for r in got.select(*names, *(["n"] if "n" in got.columns else [])).collect()) == want


def test_a_long_meeting_is_in_many_tasks(spark):
    """200,000 turns of one meeting: ranges and pieces leave no task with a third of them."""
    t = spark.range(200_000).selectExpr("1L AS m", "id AS pos", "id * 2.0D AS start", "id * 2.0D + if(id % 50 = 0, 0.5, 1.5) AS end", "concat('S', id % 3) AS speaker", "concat('S', id % 3) AS raw", "'approved' AS status", "'we go on' AS text").repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cut = sequence.pieces(t, ["m"], ["pos"], ["end"], folds._apart(1.0))
        ranges = [r["n"] for r in cut.groupBy("row.part").agg(F.count(F.lit(1)).alias("n")).collect()]
        assert len(ranges) >= 12 and max(ranges) < 30_000
        sizes = [r["n"] for r in cut.groupBy("piece").agg(F.count(F.lit(1)).alias("n")).collect()]
        assert sorted(sizes) == [1, 49, *[50] * 3999]
        dealt = [r["n"] for r in folds.fold(cut, lambda rows: [{**rows[0], "n": len(rows)}], "m long, pos long, n long").groupBy(F.spark_partition_id()).agg(F.sum("n").alias("n")).collect()]
        assert len(dealt) >= 12 and max(dealt) < 40_000 and sum(dealt) == 200_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])
