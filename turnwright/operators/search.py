"""Full-text search over segments: filter, relevance, order, facets and results by meeting."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from turnwright.functions.text import relevance


@dataclass(frozen=True)
class Request:
    query: str
    speaker: str = ""
    section: str = ""
    kind: str = ""
    since: str = ""
    until: str = ""
    per_meeting: int = 200


def matches(text: Column, query: str) -> Column:
    """The phrase, or each of at least two words of at least two letters; queries under two letters match nothing."""
    q = query.strip().lower()
    words = q.split()
    if len(q) < 2:
        return F.lit(False)
    t = F.lower(text)
    hit = F.contains(t, F.lit(q))
    if len(words) >= 2 and all(len(w) >= 2 for w in words):
        hit = hit | F.forall(F.array(*(F.lit(w) for w in words)), lambda w: F.contains(t, w))
    return hit


def search(segments: DataFrame, r: Request, text: str = "text", meeting: str = "meeting_id", date: str = "meeting_date", start: str = "start") -> DataFrame:
    """Matching segments with score and rank, at most per_meeting for each meeting. Equality and date filters reach the scan."""
    df = segments
    for column, value in (("speaker", r.speaker), ("section", r.section), ("meeting_type", r.kind)):
        if value:
            df = df.where(F.col(column) == value)
    if r.since:
        df = df.where(F.col(date) >= F.lit(r.since).cast("date"))
    if r.until:
        df = df.where(F.col(date) <= F.lit(r.until).cast("date"))
    df = df.where(matches(F.col(text), r.query)).withColumn("score", relevance(F.col(text), r.query))
    order = [F.col("score").desc(), F.col(date).desc(), F.col(start), F.col(text)]
    return df.withColumn("rank", F.row_number().over(W.partitionBy(meeting).orderBy(*order))).where(F.col("rank") <= r.per_meeting)


def grouped(hits: DataFrame, meeting: str = "meeting_id", fields: tuple[str, ...] = ("start", "score")) -> DataFrame:
    """Hits of each meeting in rank order."""
    rows = F.array_sort(F.collect_list(F.struct("rank", *fields)))
    return hits.groupBy(meeting).agg(F.count(F.lit(1)).alias("n"), F.max("score").alias("best"), rows.alias("hits"))


def facets(segments: DataFrame, columns: list[str]) -> DataFrame:
    """A4: (facet, value, n) of each column, in one pass."""
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value")) for c in columns)))
    return segments.select(each.alias("f")).groupBy("f.facet", "f.value").agg(F.count(F.lit(1)).alias("n"))


def page_filter(turns: DataFrame, speaker: str = "", section: str = "", phrase: str = "", hide_unlabelled: bool = False) -> DataFrame:
    """The turns that a page's filters leave."""
    df = turns
    if speaker:
        df = df.where(F.col("speaker") == speaker)
    if section:
        df = df.where(F.col("section") == section)
    if phrase:
        df = df.where(F.contains(F.lower("text"), F.lit(phrase.lower())))
    return df.where(F.col("speaker") != "Unknown Speaker") if hide_unlabelled else df
