"""Checks before something is published (K12): rules counted in the pass that writes it, and the state of a site's files."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# What a site of meetings must hold.
SITE_FIELDS = ("meeting_id", "meeting_date", "title", "meeting_type", "source_video_url", "transcript_url", "transcript_turns_js")
SITE_ASSETS = ("docs/index.html", "docs/js/search.js", "docs/js/search-index.js", "docs/js/meetings.js", "docs/js/transcript-page.js", "docs/css/transcript-page.css")
TURNS_CONSTANT = r"const\s+TRANSCRIPT_TURNS\s*=\s*\["


class RefusedError(ValueError):
    """Rows broke a rule, so nothing was published; counts says how many by rule."""

    def __init__(self, counts: dict[str, int]):
        super().__init__("not published: " + ", ".join(f"{name} ({n} rows)" for name, n in counts.items()))
        self.counts = counts


def required(fields: Iterable[str]) -> dict[str, Column]:
    """Rules that no field is null or empty."""
    return {f"{c} is missing": F.coalesce(F.col(c).cast("string"), F.lit("")) == "" for c in fields}


class Gate:
    """Rules by name, each a condition that a bad row meets, counted while rows pass; some: whether there must be a row at all."""

    def __init__(self, rules: dict[str, Column], some: bool = True):
        self.rules, self.some = rules, some

    def watch(self, df: DataFrame) -> DataFrame:
        """df, whose next action counts its rows and what breaks a rule."""
        self.seen = Observation()
        return df.observe(self.seen, F.count(F.lit(1)).alias("rows"), *(F.count_if(F.coalesce(bad, F.lit(True))).alias(name) for name, bad in self.rules.items()))

    def verdict(self) -> None:
        """Raise an error if a row broke a rule. To be called after the action."""
        found = dict(self.seen.get)
        rows = found.pop("rows")
        broken = {name: n for name, n in found.items() if n}
        if self.some and not rows:
            broken["no rows"] = 0
        if broken:
            raise RefusedError(broken)


def site_violations(files: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """(path, rule, fatal) of what is wrong with a site's files, told by their paths below its root.

    Meetings (meetings/*.json) need all SITE_FIELDS and a name that is their id; what they publish must define the turns; those that are not published yet are
    told without being fatal. All SITE_ASSETS must be there, and one meeting at least.
    """
    rows = files.select(F.col(path).alias("path"), F.col(content).alias("content"))
    is_meeting = F.col("path").rlike(r"^meetings/[^/]+\.json$")
    parsed = rows.where(is_meeting).select("path", F.from_json("content", ", ".join(f"{c} string" for c in SITE_FIELDS)).alias("m"))
    stem = F.regexp_extract("path", r"([^/]+)\.json$", 1)
    empty = lambda c: F.coalesce(F.col(f"m.{c}"), F.lit("")) == ""
    broken = [F.when(empty(c), F.lit(f"missing required field {c}")) for c in SITE_FIELDS]
    broken.append(F.when(~empty("meeting_id") & (stem != F.col("m.meeting_id")), F.lit("filename stem must equal meeting_id")))
    own = parsed.select("path", F.explode(F.array_compact(F.array(*broken))).alias("rule")).withColumn("fatal", F.lit(True))
    docs = rows.where(~is_meeting)
    pages = docs.select(F.col("path").alias("html"))
    scripts = docs.select(F.col("path").alias("js"), F.col("content").rlike(TURNS_CONSTANT).alias("defined"))
    shown = parsed.where(~empty("transcript_url") & ~empty("transcript_turns_js")).select("path", F.concat(F.lit("docs/"), "m.transcript_url").alias("html"), F.col("m.transcript_turns_js").alias("js"))
    shown = shown.join(pages.withColumn("there", F.lit(True)), "html", "left").join(scripts, "js", "left")
    absent = F.col("there").isNull() | F.col("defined").isNull()
    state = shown.withColumn("rule", F.when(absent, "not published yet").when(~F.col("defined"), "does not define TRANSCRIPT_TURNS")).where("rule IS NOT NULL").select(F.when(absent, F.col("path")).otherwise(F.col("js")).alias("path"), "rule", (~absent).alias("fatal"))
    spark = files.sparkSession
    assets = spark.createDataFrame([(a,) for a in SITE_ASSETS], "path string").join(rows.select("path"), "path", "left_anti").select("path", F.lit("missing asset").alias("rule"), F.lit(True).alias("fatal"))
    none = parsed.agg(F.count(F.lit(1)).alias("n")).where("n = 0").select(F.lit("meetings").alias("path"), F.lit("no meeting metadata").alias("rule"), F.lit(True).alias("fatal"))
    return own.unionByName(state).unionByName(assets).unionByName(none)
