"""Whole chains (X1, E1-E5's input, R6): recordings to published turns, captions to labelled turns, decisions to documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnwright.functions import text as t
from turnwright.operators import folds, labels, sequence, temporal
from turnwright.operators.resolve import weighted_vote
from turnwright.plans.base import Plans, table, turns
from turnwright.sinks import publish

plans = Plans()
HOUR = 3600
ROW = "meeting_id long, pos long, start double, end double, speaker string, raw string, status string, text string, handoff_applied boolean, self_intro_applied boolean"


def structured(words: DataFrame, intervals: DataFrame, approvals: DataFrame, gap: float = 1.2, cap: float = 35.0, roster: dict[str, str] | None = None, chair: str | None = None) -> DataFrame:
    """Entry point A: words (meeting_id, pos, start, end, text) and speaker intervals to structured turns.

    J1 tags words, W2 makes turns, approvals name them (J11, P22), W5 joins neighbours of one raw id, W11 takes self-introductions,
    F30 the text's own hints at who of the roster speaks, W10 hand-offs, W8 merges chains and W9 repairs fragments, all three in one pass over pieces of meetings.
    """
    tagged = temporal.longest_active(words.withColumn("t", F.when(F.col("end") > F.col("start"), (F.col("start") + F.col("end")) / 2).otherwise(F.col("start"))), intervals, ["meeting_id"], "pos")
    chunked = folds.chunk_turns(tagged.select("meeting_id", "pos", "start", "end", "speaker", "text"), ["meeting_id"], ["start", "pos"], gap, cap)
    named = chunked.join(approvals.select("meeting_id", F.col("speaker_raw").alias("speaker"), "name"), ["meeting_id", "speaker"], "left")
    runs = sequence.runs(named.withColumn("raw", F.regexp_replace("speaker", "_spk?$", "")), ["meeting_id"], ["start", "pos"], "raw", "text")
    names = named.select("meeting_id", F.regexp_replace("speaker", "_spk?$", "").alias("raw"), "name").groupBy("meeting_id", "raw").agg(F.max("name").alias("name"))
    df = runs.join(names, ["meeting_id", "raw"], "left")
    intro = t.self_intro(F.col("text"))
    df = df.withColumn("heard", F.lit(None).cast("string"))
    if roster and chair:
        df = labels.label_from_text(df.drop("heard"), ["meeting_id"], ["run_id"], "text", roster, chair, "heard", F.coalesce(intro, "name"))
    label = F.coalesce(intro, "name", "heard", F.lit("Unknown Speaker"))
    status = F.when(intro.isNotNull() | (F.col("name").isNull() & F.col("heard").isNotNull()), "heuristic").when(F.col("name").isNotNull(), "approved").when(F.col("raw") == "UNKNOWN", "unknown").otherwise("unresolved")
    df = df.select("meeting_id", F.col("run_id").alias("pos"), F.col("start").cast("double").alias("start"), F.col("end").cast("double").alias("end"), label.alias("speaker"), "raw", status.alias("status"), "text", F.lit(False).alias("handoff_applied"), intro.isNotNull().alias("self_intro_applied"))

    return folds.merged(df, ["meeting_id"], ["pos"], ROW)


def _words(spark, sf):
    w = turns(spark, sf).where("speaker NOT IN ('view', 'purchase')")
    return w.select("meeting_id", "pos", (F.col("start") / HOUR).alias("start"), (F.col("start") / HOUR + 0.5).alias("end"), "text")


def _intervals(spark, sf):
    i = turns(spark, sf).where("speaker IN ('view', 'purchase')")
    return i.select("meeting_id", (F.col("start") / HOUR).alias("start"), (F.col("end") / HOUR).alias("end"), "speaker")


def _approvals(spark, sf):
    return table(spark, sf, "events").select(F.col("user_id").alias("meeting_id"), F.lit("view").alias("speaker_raw"), F.lit("Ada Moss").alias("name")).distinct()


@plans.add("x1_recording_to_turns")
def recording(spark, sf):
    return structured(_words(spark, sf), _intervals(spark, sf), _approvals(spark, sf), 24.0, 168.0, {"Ada Moss": "Mayor", "Ben Ito": "Member"}, "Ada Moss")


@plans.add("x1_publish")
def published(spark, sf):
    return publish.json_document(recording(spark, sf), ["speaker", "start", "end", "text", "status"])


@plans.add("x1_captions_vote", "WITH c AS (SELECT conv_id, turn, role, CASE WHEN turn % 3 = 0 THEN 3 WHEN turn % 3 = 1 THEN 2 ELSE 1 END AS w FROM conversations WHERE length(text) >= 40), e AS (SELECT conv_id, role, sum(w) AS n FROM c GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY n DESC, role) AS k FROM e), g AS (SELECT conv_id, max(CASE WHEN k = 1 THEN role END) AS role, max(n) AS best, coalesce(max(CASE WHEN k = 2 THEN n END), 0) AS second, sum(n) AS total FROM r GROUP BY conv_id) SELECT conv_id, turn, CASE WHEN best >= 5 AND best <> second AND best >= 0.5 * total THEN g.role ELSE 'Unknown Speaker' END AS speaker FROM conversations JOIN g USING (conv_id)")
def captions(spark, sf):
    """Entry point C: hints vote for a speaker, and turns of groups with an accepted one get it."""
    c = table(spark, sf, "conversations")
    hints = c.where(F.length("text") >= 40).withColumn("w", F.when(F.col("turn") % 3 == 0, 3).when(F.col("turn") % 3 == 1, 2).otherwise(1))
    vote = weighted_vote(hints, ["conv_id"], "role", "w", 5, 0.5).select("conv_id", F.when(F.col("accepted"), F.col("role")).otherwise("Unknown Speaker").alias("speaker"))
    return c.select("conv_id", "turn").join(vote, "conv_id")


@plans.add("r6_vote_save", "SELECT o_custkey, '{\"votes\":[' || string_agg('{\"item\":' || o_orderkey || ',\"result\":\"' || o_orderstatus || '\"}', ',' ORDER BY o_orderkey) || ']}' AS document FROM orders GROUP BY o_custkey")
def vote_save(spark, sf):
    rows = F.array_sort(F.collect_list(F.struct(F.col("o_orderkey").alias("item"), F.col("o_orderstatus").alias("result"))))
    return table(spark, sf, "orders").groupBy("o_custkey").agg(F.to_json(F.struct(rows.alias("votes"))).alias("document"))
