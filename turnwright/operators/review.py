"""Review queues, decisions and votes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnwright.functions.text import any_of, review_reason
from turnwright.operators.resolve import latest
from turnwright.operators.sequence import context

SUSPICIOUS = ("even more oh", "has the name", ". i")
OPEN_STATUS = ("unknown", "unresolved", "mixed", "public_comment_unverified")


def words_in(text: Column) -> Column:
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: w != ""))


def needs_queue(text: str = "text", status: str = "speaker_status", flag: str = "needs_review") -> Column:
    """Whether a turn is put up for review."""
    short = words_in(F.col(text)) <= 3
    return F.coalesce(F.col(flag), F.lit(False)) | (F.col(status).isin(*OPEN_STATUS) & short) | short | F.coalesce(any_of(F.lower(text), SUSPICIOUS), F.lit(False))


def queue(turns: DataFrame, keys: list[str], order: list[str], around: int = 2) -> DataFrame:
    """Turns to review, with their word count and the turns around them."""
    df = context(turns, keys, order, ["turn_id", "speaker", "text"], around)
    return df.where(needs_queue()).withColumn("word_count", words_in(F.col("text")).cast("long"))


def template(items: DataFrame) -> DataFrame:
    """R2: a pending decision for each item."""
    empty = F.lit("")
    return items.select("meeting_id", "turn_id", F.lit("pending").alias("reviewer_action"), empty.alias("speaker_public_override"), empty.alias("text_override"), F.lit(False).alias("suppress"), empty.alias("evidence_note"))


def audit(decisions: DataFrame, batch: str, exported_at: str) -> DataFrame:
    """Decisions with batch and time of export."""
    return decisions.withColumns({"export_batch_id": F.lit(batch), "exported_at": F.lit(exported_at).cast("timestamp_ntz"), "decision_id": F.sha2(F.concat_ws("|", "meeting_id", "turn_id", "reviewer_action"), 256)})


def apply(turns: DataFrame, decisions: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Turns with the last decision of each applied; suppressed ones are redacted; empty overrides change nothing; applying twice is as once."""
    d = latest(decisions, keys, order).select(*keys, "reviewer_action", "speaker_public_override", "text_override", F.coalesce("suppress", F.lit(False)).alias("suppress"), "evidence_note", F.lit(True).alias("__decided"))
    out = turns.join(d, keys, "left")
    decided = F.coalesce("__decided", F.lit(False))
    gone = F.coalesce("suppress", F.lit(False))
    new = {
        "speaker_public": F.when(gone, "REDACTED").otherwise(F.coalesce(F.nullif("speaker_public_override", F.lit("")), "speaker_public")),
        "text": F.when(gone, "[REDACTED]").otherwise(F.coalesce(F.nullif("text_override", F.lit("")), "text")),
        "needs_review": F.when(decided, F.lit(False)).otherwise(F.col("needs_review")),
        "review_reason": F.when(decided, review_reason(F.col("reviewer_action"), F.coalesce("evidence_note", F.lit("")))).otherwise(F.col("review_reason")),
    }
    return out.withColumns(new).select(turns.columns)


def apply_edge(turns: DataFrame, decisions: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The other form: writes speaker; keep_unknown marks the text once; other actions than the four are ignored."""
    d = latest(decisions, keys, order).select(*keys, F.col("reviewer_action").alias("__a"), F.col("speaker_name").alias("__s"))
    out = turns.join(d, keys, "left")
    marker = " [unknown]"
    return out.withColumns({
        "speaker": F.when(F.col("__a").isin("approve", "override"), F.coalesce(F.nullif("__s", F.lit("")), "speaker")).when(F.col("__a") == "suppress", "SUPPRESSED").otherwise(F.col("speaker")),
        "text": F.when((F.col("__a") == "keep_unknown") & ~F.endswith("text", F.lit(marker)), F.concat("text", F.lit(marker))).otherwise(F.col("text")),
    }).select(turns.columns)


def vote_summary(votes: DataFrame) -> DataFrame:
    """Votes with unanimous flag, badge and time code."""
    against = F.coalesce(F.size("opposed"), F.lit(0))
    return votes.withColumns({"unanimous": (F.col("result") == "PASSED") & (against == 0), "badge": F.when(F.col("result") == "PASSED", F.when(against == 0, "passed unanimously").otherwise("passed")).when(F.col("result") == "FAILED", "failed").otherwise("no action")})
