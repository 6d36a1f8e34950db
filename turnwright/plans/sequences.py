"""Sequence operators (W) over events as turns of a meeting per user; a gap of hours stands for one of seconds."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from turnwright.operators import folds, sequence
from turnwright.plans.base import TURNS_SQL, Plans, table, turns
from turnwright.plans.scalars import INTRO_SQL, introduced

plans = Plans()
KEYS, ORDER = ["meeting_id"], ["pos"]
HOUR = 3600
_RUN = "CASE WHEN lag(speaker) OVER w = speaker THEN 0 ELSE 1 END"


@plans.add("w4_gap_merge", f"""WITH {TURNS_SQL}, a AS (SELECT *, sum(x) OVER (PARTITION BY meeting_id ORDER BY pos) AS k FROM (SELECT *, {_RUN} AS x FROM turns WINDOW w AS (PARTITION BY meeting_id ORDER BY pos))),
 b AS (SELECT *, max("end") OVER (PARTITION BY meeting_id, k ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS e FROM a), c AS (SELECT *, sum(CASE WHEN e IS NULL OR start - e > 7200 THEN 1 ELSE 0 END) OVER (PARTITION BY meeting_id ORDER BY pos) AS r FROM b)
 SELECT meeting_id, speaker, min(start) AS start, max("end") AS "end", count(*) AS n FROM c GROUP BY meeting_id, r, speaker""")
def w4(spark, sf):
    return sequence.runs(turns(spark, sf), KEYS, ORDER, "speaker", gap=2 * HOUR).drop("run_id")


@plans.add("w5_run_merge", f"""WITH {TURNS_SQL}, a AS (SELECT *, sum(x) OVER (PARTITION BY meeting_id ORDER BY pos) AS k FROM (SELECT *, {_RUN} AS x FROM turns WINDOW w AS (PARTITION BY meeting_id ORDER BY pos)))
 SELECT meeting_id, k::BIGINT AS run_id, speaker, min(start) AS start, max("end") AS "end", count(*) AS n, string_agg(text, ' ' ORDER BY pos) AS text FROM a GROUP BY ALL""")
def w5(spark, sf):
    return sequence.runs(turns(spark, sf), KEYS, ORDER, "speaker", "text")


@plans.add("w6_small_blocks", f"""WITH {TURNS_SQL}, d AS (SELECT *, "end" - start AS d, "end" - start < 90000 AS short FROM (SELECT meeting_id, pos, start, "end", CASE WHEN speaker IN ('error', 'signup') THEN 'UNKNOWN' ELSE speaker END AS speaker FROM turns)),
 r AS (SELECT *, sum(CASE WHEN p IS NOT NULL AND p = short THEN 0 ELSE 1 END) OVER (PARTITION BY meeting_id ORDER BY pos) AS run FROM (SELECT *, lag(short) OVER (PARTITION BY meeting_id ORDER BY pos) AS p FROM d)),
 k AS (SELECT meeting_id, run, speaker, sum(d) AS n, min(pos) AS f FROM r WHERE short AND speaker <> 'UNKNOWN' GROUP BY ALL), b AS (SELECT *, row_number() OVER (PARTITION BY meeting_id, run ORDER BY n DESC, f) AS q FROM k),
 t AS (SELECT meeting_id, run, sum(d) AS total FROM r WHERE short GROUP BY ALL),
 m AS (SELECT r.*, total, b.speaker AS who, n, short AND total > 0 AND n / total >= 0.6 AS merged, short AND (b.speaker IS NULL OR total = 0) AS deferred FROM r LEFT JOIN b ON r.meeting_id = b.meeting_id AND r.run = b.run AND q = 1 LEFT JOIN t ON r.meeting_id = t.meeting_id AND r.run = t.run)
 SELECT meeting_id, min(start) AS start, max("end") AS "end", first(CASE WHEN merged THEN who ELSE speaker END) AS speaker, first(CASE WHEN merged THEN 'microblock_cleanup' WHEN deferred THEN 'microblock_deferred' ELSE 'keep' END) AS action, count(*) AS n FROM m GROUP BY meeting_id, coalesce(merged, false), CASE WHEN merged THEN run ELSE pos END""")
def w6(spark, sf):
    df = turns(spark, sf).withColumn("speaker", F.when(F.col("speaker").isin("error", "signup"), "UNKNOWN").otherwise(F.col("speaker")))
    return sequence.small_blocks(df, KEYS, ORDER, 25 * HOUR).drop("confidence")


@plans.add("w7_sandwich", f"""WITH {TURNS_SQL}, d AS (SELECT meeting_id, event_id, pos, "end" - start AS d, CASE WHEN speaker = 'error' THEN 'UNKNOWN' WHEN speaker IN ('view', 'click') THEN 'A' ELSE 'B' END AS s FROM turns),
 n AS (SELECT *, lag(s) OVER w AS a, lead(s) OVER w AS b, lag(d) OVER w AS da, lead(d) OVER w AS db FROM d WINDOW w AS (PARTITION BY meeting_id ORDER BY pos))
 SELECT event_id, coalesce(s = 'UNKNOWN' AND d < 180000 AND a = b AND a <> 'UNKNOWN' AND da >= 36000 AND db >= 36000, false) AS attached, CASE WHEN s = 'UNKNOWN' AND d < 180000 AND a = b AND a <> 'UNKNOWN' AND da >= 36000 AND db >= 36000 THEN a ELSE s END AS speaker FROM n""")
def w7(spark, sf):
    who = F.when(F.col("speaker") == "error", "UNKNOWN").when(F.col("speaker").isin("view", "click"), "A").otherwise("B")
    df = turns(spark, sf).withColumn("speaker", who).withColumn("text", F.lit("well then"))
    return sequence.sandwich(df, KEYS, ORDER, 10 * HOUR, 50 * HOUR).select("event_id", "attached", "speaker")


@plans.add("w12_carry_forward", f"WITH {TURNS_SQL} SELECT event_id, last_value(CASE WHEN speaker IN ('purchase', 'signup') THEN speaker END IGNORE NULLS) OVER (PARTITION BY meeting_id ORDER BY pos) AS known FROM turns")
def w12(spark, sf):
    df = turns(spark, sf).withColumn("named", F.when(F.col("speaker").isin("purchase", "signup"), F.col("speaker")))
    return sequence.carry(df, KEYS, ORDER, "named", "known").select("event_id", "known")


@plans.add("w13_hint_inheritance", f"WITH {TURNS_SQL}, g AS (SELECT *, sum(CASE WHEN speaker = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY meeting_id ORDER BY pos) AS k FROM turns) SELECT event_id, coalesce(last_value(CASE WHEN speaker = 'view' THEN text END IGNORE NULLS) OVER (PARTITION BY meeting_id, k ORDER BY pos), '') AS hint FROM g")
def w13(spark, sf):
    grouped = sequence.islands(turns(spark, sf), KEYS, ORDER, F.col("speaker") == "error", "k")
    df = grouped.withColumn("own", F.when(F.col("speaker") == "view", F.col("text")))
    first = df.withColumn("k", F.col("k") - F.first("k").over(W.partitionBy("meeting_id").orderBy("pos")))
    return sequence.carry(first, ["meeting_id", "k"], ORDER, "own", "hint").select("event_id", F.coalesce("hint", F.lit("")).alias("hint"))


@plans.add("w15_context", f"WITH {TURNS_SQL} SELECT event_id, array_to_string(list(speaker) OVER (PARTITION BY meeting_id ORDER BY pos ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING), ',') AS around FROM turns")
def w15(spark, sf):
    df = sequence.context(turns(spark, sf), KEYS, ORDER, ["speaker", "event_id"], 2)
    return df.select("event_id", F.array_join(F.transform("context", lambda x: x["speaker"]), ",").alias("around"))


@plans.add("w17_position_index", f"WITH {TURNS_SQL} SELECT event_id, pos - 1 AS turn_index, printf('turn_%06d', pos) AS turn_id FROM turns")
def w17(spark, sf):
    return turns(spark, sf).select("event_id", (F.col("pos") - 1).alias("turn_index"), F.format_string("turn_%06d", "pos").alias("turn_id"))


plans.queries["p5_ordinal_ids"], plans.sql["p5_ordinal_ids"] = plans.queries["w17_position_index"], plans.sql["w17_position_index"]


@plans.add("w18_assignment_clusters", f"""WITH {TURNS_SQL}, u AS (SELECT *, row_number() OVER (PARTITION BY meeting_id ORDER BY pos) AS p FROM turns WHERE value < 60), a AS (SELECT *, sum(x) OVER (PARTITION BY meeting_id ORDER BY p) AS k FROM (SELECT *, CASE WHEN lag(speaker) OVER w = speaker AND lag(value) OVER w >= 10 AND value >= 10 THEN 0 ELSE 1 END AS x FROM u WINDOW w AS (PARTITION BY meeting_id ORDER BY p)))
 SELECT meeting_id, k::BIGINT AS run_id, speaker, count(*) AS n, array_to_string(list(event_id ORDER BY p), ',') AS turns, floor(avg(value) * 1000 + 0.5) / 1000 AS confidence FROM a WHERE value >= 10 GROUP BY ALL""")
def w18(spark, sf):
    u = turns(spark, sf).where("value < 60")
    w = W.partitionBy("meeting_id").orderBy("pos")
    same = (F.lag("speaker").over(w) == F.col("speaker")) & (F.lag("value").over(w) >= 10) & (F.col("value") >= 10)
    df = sequence.islands(u.withColumn("__same", F.coalesce(same, F.lit(False))), KEYS, ORDER, ~F.col("__same")).where("value >= 10")
    rows = F.array_sort(F.collect_list(F.struct("pos", "event_id")))
    out = df.groupBy("meeting_id", "run_id", "speaker").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.transform(rows, lambda r: r["event_id"].cast("string")), ",").alias("turns"), (F.floor(F.avg("value") * 1000 + 0.5) / 1000).alias("confidence"))
    return out


@plans.add("w20_running_offset", "SELECT l_orderkey, l_linenumber, CAST(coalesce(sum(q) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, q ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT) AS q FROM lineitem)")
def w20(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("long").alias("q"))
    return sequence.running(df, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "q"], "q", "start").select("l_orderkey", "l_linenumber", "start")


@plans.add("w21_change_header", f"WITH {TURNS_SQL}, k AS (SELECT * FROM turns WHERE speaker <> 'error') SELECT event_id, coalesce(lag(speaker) OVER (PARTITION BY meeting_id ORDER BY pos) <> speaker, true) AS header FROM k")
def w21(spark, sf):
    k = turns(spark, sf).where("speaker <> 'error'")
    return k.select("event_id", F.coalesce(sequence.before("speaker", KEYS, ORDER) != F.col("speaker"), F.lit(True)).alias("header"))


@plans.add("w22_first_seen", f"WITH {TURNS_SQL}, f AS (SELECT meeting_id, speaker, row_number() OVER (PARTITION BY meeting_id ORDER BY min(pos), speaker) AS n FROM turns GROUP BY meeting_id, speaker) SELECT event_id, printf('Speaker %02d', n) AS label FROM turns JOIN f USING (meeting_id, speaker)")
def w22(spark, sf):
    return sequence.first_seen(turns(spark, sf), KEYS, "speaker", "pos").select("event_id", F.format_string("Speaker %02d", "number").alias("label"))


@plans.add("w23_cyclic_navigation", f"WITH {TURNS_SQL}, m AS (SELECT *, row_number() OVER (PARTITION BY meeting_id ORDER BY pos) - 1 AS i, count(*) OVER (PARTITION BY meeting_id) AS n FROM turns WHERE speaker = 'view') SELECT a.event_id, b.event_id AS next_id FROM m a JOIN m b ON a.meeting_id = b.meeting_id AND b.i = (a.i + 1) % a.n")
def w23(spark, sf):
    w = W.partitionBy("meeting_id")
    m = turns(spark, sf).where("speaker = 'view'").select("meeting_id", "event_id", (F.row_number().over(w.orderBy("pos")) - 1).alias("i"), F.count(F.lit(1)).over(w).alias("n"))
    to = m.select("meeting_id", F.col("i").alias("j"), F.col("event_id").alias("next_id"))
    return m.withColumn("j", F.pmod(F.col("i") + 1, "n").cast("int")).join(to, ["meeting_id", "j"]).select("event_id", "next_id")


@plans.add("w24_active_count", f"WITH {TURNS_SQL}, s AS (SELECT meeting_id, event_id, start AS t, 1 AS d FROM turns UNION ALL SELECT meeting_id, NULL, \"end\", -1 FROM turns), c AS (SELECT *, sum(d) OVER (PARTITION BY meeting_id ORDER BY t RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n FROM s) SELECT event_id, CAST(n AS BIGINT) AS active FROM c WHERE event_id IS NOT NULL")
def w24(spark, sf):
    t = turns(spark, sf)
    marks = t.select("meeting_id", "event_id", F.col("start").alias("t"), F.lit(1).alias("d")).union(t.select("meeting_id", F.lit(None).cast("long"), "end", F.lit(-1)))
    w = W.partitionBy("meeting_id").orderBy("t").rangeBetween(W.unboundedPreceding, 0)
    return marks.withColumn("active", F.sum("d").over(w)).where("event_id is not null").select("event_id", "active")


@plans.add("w25_upcoming", f"WITH {TURNS_SQL} SELECT event_id, CASE WHEN speaker = 'signup' THEN lead(speaker) OVER (PARTITION BY meeting_id ORDER BY pos) END AS upcoming FROM turns")
def w25(spark, sf):
    w = W.partitionBy("meeting_id").orderBy("pos")
    return turns(spark, sf).select("event_id", F.when(F.rlike("text", F.lit("(?i)^signup")), F.lead("speaker").over(w)).alias("upcoming"))


# folds: tests hold them against plain models
@plans.add("w1_capped_blocks", f"""WITH RECURSIVE {TURNS_SQL}, f AS (SELECT meeting_id, pos, speaker, start AS s, "end" AS e, 1 AS b FROM turns WHERE pos = 1
 UNION ALL SELECT t.meeting_id, t.pos, t.speaker, CASE WHEN f.speaker = t.speaker AND t.start - p."end" <= 86400 AND f.e - f.s < 604800 THEN f.s ELSE t.start END, CASE WHEN f.speaker = t.speaker AND t.start - p."end" <= 86400 AND f.e - f.s < 604800 THEN greatest(f.e, t."end") ELSE t."end" END,
 CASE WHEN f.speaker = t.speaker AND t.start - p."end" <= 86400 AND f.e - f.s < 604800 THEN f.b ELSE f.b + 1 END FROM f JOIN turns t ON t.meeting_id = f.meeting_id AND t.pos = f.pos + 1 JOIN turns p ON p.meeting_id = f.meeting_id AND p.pos = f.pos)
 SELECT f.meeting_id, f.speaker, min(t.start) AS start, max(t."end") AS "end", count(*) AS n FROM f JOIN turns t USING (meeting_id, pos) GROUP BY f.meeting_id, f.b, f.speaker""")
def w1(spark, sf):
    return folds.capped_blocks(turns(spark, sf), KEYS, ORDER, 24 * HOUR, 168 * HOUR).select("meeting_id", "speaker", "start", "end", F.col("n").cast("long").alias("n"))


def _turns_for_folds(spark, sf):
    who = F.when(F.col("speaker") == "error", "Unknown Speaker").otherwise(F.col("speaker"))
    raw = F.when(F.col("speaker") == "error", "UNKNOWN").otherwise(F.col("speaker"))
    status = F.when(F.col("speaker") == "view", "approved").when(F.col("speaker") == "purchase", "chair").otherwise("heuristic")
    says = F.element_at(F.array(*(F.lit(x) for x in ("I", "and we turn it over to Ben", "Thank you, Ada", "the budget is", "Please rise. ", "so it goes on"))), (F.col("pos") % 6 + 1).cast("int"))
    t = turns(spark, sf)
    return t.select("meeting_id", "pos", (F.col("start") / HOUR).alias("start"), (F.col("end") / HOUR).alias("end"), who.alias("speaker"), raw.alias("raw"), status.alias("status"), says.alias("text"))


FOLDED = "meeting_id long, pos long, start double, end double, speaker string, status string, text string"
for _name, _work in {
    "w2_turn_chunks": lambda t: folds.chunk_turns(t, KEYS, ORDER),
    "w4c_capped_merge": lambda t: folds.capped_merge(t, KEYS, ORDER),
    "w8_chain_merge": lambda t: folds.chained(t, KEYS, ORDER, FOLDED),
    "w9_fragment_repair": lambda t: folds.repaired(t, KEYS, ORDER, FOLDED),
    "w10_hand_offs": lambda t: folds.handed_off(t, KEYS, ORDER, FOLDED),
    "w12b_chair_carry": lambda t: folds.carry_speakers(t, KEYS, ORDER),
    "w14_stray_tokens": lambda t: folds.without_strays(t, KEYS, ORDER, FOLDED),
}.items():
    plans.queries[_name] = lambda spark, sf, work=_work: work(_turns_for_folds(spark, sf)).select(*(c.split()[0] for c in FOLDED.split(", ")))

# the same in SQL: rows one by one, each with what was gathered before it
FT = f"""{TURNS_SQL}, ft AS (SELECT meeting_id, pos, start / 3600 AS start, "end" / 3600 AS "end", CASE WHEN speaker = 'error' THEN 'Unknown Speaker' ELSE speaker END AS speaker,
 CASE speaker WHEN 'view' THEN 'approved' WHEN 'purchase' THEN 'chair' ELSE 'heuristic' END AS status, (['I', 'and we turn it over to Ben', 'Thank you, Ada', 'the budget is', 'Please rise. ', 'so it goes on'])[pos % 6 + 1] AS text FROM turns)"""
_STEP = "SELECT f.*, r.pos AS rpos, r.start AS rs, r.\"end\" AS re, r.speaker AS rsp, r.status AS rst, r.text AS rt FROM f JOIN ft r ON r.meeting_id = f.meeting_id AND r.pos = f.pos + 1"
_LAST = "QUALIFY row_number() OVER (PARTITION BY meeting_id, p0 ORDER BY pos DESC) = 1"


def _chunks(test: str, end: str, text: str) -> str:
    return f"""WITH RECURSIVE {FT}, f AS (SELECT meeting_id, pos, pos AS p0, start, "end", speaker, status, text FROM ft WHERE pos = 1 UNION ALL
 SELECT meeting_id, rpos, CASE WHEN j THEN p0 ELSE rpos END, CASE WHEN j THEN start ELSE rs END, CASE WHEN j THEN {end} ELSE re END, CASE WHEN j THEN speaker ELSE rsp END, CASE WHEN j THEN status ELSE rst END, CASE WHEN j THEN {text} ELSE rt END
 FROM (SELECT *, {test} AS j FROM ({_STEP}) x) y) SELECT meeting_id, p0 AS pos, start, "end", speaker, status, text FROM f {_LAST}"""


plans.sql["w2_turn_chunks"] = _chunks("""speaker = rsp AND round(rs - "end", 3) <= 1.2 AND round("end" - start, 3) < 35 AND NOT (length(text) >= 650 AND right(text, 1) IN ('.', '!', '?'))""", 'greatest("end", re)', "trim(text || ' ' || rt)")
plans.sql["w4c_capped_merge"] = _chunks("""speaker = rsp AND status = rst AND rs - "end" < 2 AND re - start <= 120""", 'greatest("end", re)', "trim(text || ' ' || rt)")
_FIRST = "split_part(trim(rt), ' ', 1)"
_STARTS = ", ".join(f"'{w}'" for w in sorted(folds.CONTINUATION_STARTS))
_NOT = ", ".join("'" + w.replace("'", "''") + "'" for w in sorted(folds.NOT_FRAGMENTS))
plans.sql["w9_fragment_repair"] = _chunks(f"""speaker NOT IN ('', 'Unknown Speaker') AND rs - "end" <= 3 AND length(trim(text)) BETWEEN 5 AND 600 AND right(trim(text), 1) NOT IN ('.', '!', '?', '"') AND ({_FIRST} IN ({_STARTS}) OR length(trim(rt)) < 80 AND left({_FIRST}, 1) BETWEEN 'A' AND 'Z' AND lower({_FIRST}) NOT IN ({_NOT}))""", "re", "trim(text) || ' ' || trim(rt)")
plans.sql["w10_hand_offs"] = f"""WITH {FT}, l AS (SELECT *, lag(text) OVER w = 'and we turn it over to Ben' AND start - lag("end") OVER w < 3 AS called FROM ft WINDOW w AS (PARTITION BY meeting_id ORDER BY pos))
 SELECT meeting_id, pos, start, "end", CASE WHEN called THEN 'Ben' ELSE speaker END AS speaker, CASE WHEN called THEN 'heuristic' ELSE status END AS status, text FROM l"""
_GOES_ON = " OR ".join(f"contains(lower(left(text, 100)), '{p}')" for p in ("i ", "we ", "the ", "this ", "our ", "to the", "ask ", "please ", "will now"))
plans.sql["w12b_chair_carry"] = f"""WITH {FT}, l AS (SELECT *, last_value(CASE WHEN status = 'chair' THEN speaker WHEN speaker NOT IN ('', 'Unknown Speaker') THEN '' END IGNORE NULLS) OVER (PARTITION BY meeting_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS chair FROM ft),
 m AS (SELECT *, status <> 'chair' AND speaker IN ('', 'Unknown Speaker') AND coalesce(chair, '') <> '' AND ({_GOES_ON}) AS carried FROM l) SELECT meeting_id, pos, start, "end", CASE WHEN carried THEN chair ELSE speaker END AS speaker, CASE WHEN carried THEN 'heuristic' ELSE status END AS status, text FROM m"""


@plans.add("w3_cue_chunks", f"""WITH RECURSIVE {FT}, f AS (SELECT meeting_id, pos, pos AS p0, start, "end", CASE WHEN status = 'approved' THEN speaker ELSE '' END AS speaker, CASE WHEN status = 'approved' THEN speaker ELSE '' END AS hint, trim(text) AS text, 1 AS n FROM ft WHERE pos = 1 UNION ALL
 SELECT meeting_id, rpos, CASE WHEN j THEN p0 ELSE rpos END, CASE WHEN j THEN start ELSE rs END, re, CASE WHEN j THEN speaker ELSE now END, now, CASE WHEN j THEN trim(text || ' ' || trim(rt)) ELSE trim(rt) END, CASE WHEN j THEN n + 1 ELSE 1 END
 FROM (SELECT *, rst <> 'chair' AND now = speaker AND "end" - start < 30 AND NOT (length(text) >= 650 AND right(text, 1) IN ('.', '!', '?')) AS j FROM (SELECT *, CASE WHEN rst = 'approved' THEN rsp WHEN rst = 'chair' THEN '' ELSE hint END AS now FROM ({_STEP}) x) y) z)
 SELECT meeting_id, p0 AS pos, start, "end", speaker, n::BIGINT AS n, text FROM f {_LAST}""")
def w3(spark, sf):
    df = _turns_for_folds(spark, sf).withColumns({"new_speaker": F.col("status") == "chair", "speaker_hint": F.when(F.col("status") == "approved", F.col("speaker")).otherwise("")})
    return folds.chunk_cues(df, KEYS, ORDER).select("meeting_id", "pos", "start", "end", "speaker", "n", "text")


@plans.add("w11_self_intro", f"WITH {INTRO_SQL} SELECT p_partkey, coalesce(heard, p_brand) AS speaker, heard IS NOT NULL AS self_intro_applied FROM i")
def w11(spark, sf):
    from turnwright.functions.text import self_intro

    name = self_intro(F.col("text"))
    return introduced(spark, sf).select("p_partkey", F.coalesce(name, "p_brand").alias("speaker"), F.coalesce(name != F.col("p_brand"), F.lit(False)).alias("self_intro_applied"))


@plans.add("w19_roll_call_skip", f"""WITH RECURSIVE {FT}, h AS (SELECT *, row_number() OVER (PARTITION BY meeting_id ORDER BY pos) AS k FROM ft WHERE status = 'chair'), f AS (SELECT meeting_id, k, pos, start, speaker, start AS taken, true AS hit FROM h WHERE k = 1
 UNION ALL SELECT h.meeting_id, h.k, h.pos, h.start, h.speaker, CASE WHEN h.start - f.taken >= 60 THEN h.start ELSE f.taken END, h.start - f.taken >= 60 FROM f JOIN h ON h.meeting_id = f.meeting_id AND h.k = f.k + 1) SELECT meeting_id, pos, start, speaker FROM f WHERE hit""")
def w19(spark, sf):
    return folds.skipped_after(_turns_for_folds(spark, sf).where("status = 'chair'"), KEYS, ORDER, "meeting_id long, pos long, start double, speaker string")
