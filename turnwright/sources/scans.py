"""Scans: landed files of meetings, words, intervals, captions, pages and reviews as typed rows.

Readers take fixed schemas, so nothing is inferred; rows that don't parse are left out, as fields are cast with try_cast. Parsers take a column of
whole texts, so they run on any table as well as on files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnwright.functions.text import collapse, duration, slug, strip_tags, unescape, vtt_millis
from turnwright.operators.headers import Council, spoken_by

WORD = "struct<start:string,end:string,word:string,text:string,speaker_id:string,type:string>"
SEGMENT = "struct<start:string,end:string,text:string,speaker:string>"
MEETING = "meeting_id string, meeting_date string, display_date string, title string, meeting_type string, city string, source_url string, turns_path string, duration_seconds long, sections array<struct<start_seconds:long,label:string>>"
REGISTRY = "speakers array<struct<speaker_key:string,display_name:string,role:string,aliases:array<string>,diarization_speaker_ids:array<string>>>"


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One document a file, with the path it came from; broken files give nulls."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").json(path).withColumn("path", F.input_file_name())


def meetings(spark: SparkSession, path: str) -> DataFrame:
    """Meetings, newest first."""
    return read_json(spark, path, MEETING).withColumn("meeting_date", F.expr("try_to_date(meeting_date)")).orderBy(F.col("meeting_date").desc(), F.col("meeting_id").desc())


def asr_units(df: DataFrame, key: str, document: str = "document") -> DataFrame:
    """(key, pos, start, end, text, unit) of the first list of word_segments, words and segments that has rows; blank and broken rows are left out."""
    parsed = F.from_json(document, f"word_segments array<{WORD}>, words array<{WORD}>, segments array<{WORD}>")
    some = lambda c: F.when(F.size(c) > 0, c)
    d = df.select(key, parsed.alias("d"))
    first = F.coalesce(some(F.col("d.word_segments")), some(F.col("d.words")), some(F.col("d.segments")))
    unit = F.when(F.size("d.word_segments") > 0, "word").when(F.size("d.words") > 0, "word").otherwise("segment")
    rows = d.select(key, unit.alias("unit"), F.posexplode(first).alias("pos", "r"))
    rows = rows.select(key, "pos", F.col("r.start").try_cast("double").alias("start"), F.col("r.end").try_cast("double").alias("end"), F.trim(F.coalesce("r.word", "r.text")).alias("text"), "unit")
    return rows.where("start is not null and end is not null and text <> '' and (unit = 'word' or end > start)")


def diarization(df: DataFrame, key: str, document: str = "document") -> DataFrame:
    """S3: (key, start, end, speaker) of segments with a speaker and some length."""
    rows = df.select(key, F.explode(F.from_json(document, f"segments array<{SEGMENT}>")["segments"]).alias("r"))
    rows = rows.select(key, F.col("r.start").try_cast("double").alias("start"), F.col("r.end").try_cast("double").alias("end"), F.trim("r.speaker").alias("speaker"))
    return rows.where("speaker <> '' and end > start")


def word_speakers(df: DataFrame, key: str, document: str = "document") -> DataFrame:
    """Words with a speaker id, of type word only."""
    rows = df.select(key, F.explode(F.from_json(document, f"words array<{WORD}>")["words"]).alias("r")).where("r.type = 'word' and r.speaker_id is not null")
    return rows.select(key, F.col("r.start").try_cast("double").alias("start"), F.col("r.end").try_cast("double").alias("end"), F.col("r.speaker_id").alias("speaker"))


STAMP = r"(\d{2}:\d{2}:\d{2}\.\d{3})"
TIMING = rf"{STAMP}\s*-->\s*{STAMP}[^\n]*\n?"
# Fixed value: what marks a vendor's own cue.
WATERMARK = r"(?i)aberdeen\s+captioning|www\.|\b\d{3}-\d{3}-\d{4}\b"


def _cues(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, cue, start_ms, end_ms, body) of whole WebVTT texts: blocks between blank lines that hold a timing."""
    clean = F.regexp_replace(F.regexp_replace(text, "\r\n?", "\n"), "^﻿", "")
    blocks = df.select(key, F.posexplode(F.split(clean, r"\n\s*\n")).alias("cue", "b")).where(F.rlike("b", F.lit(TIMING)))
    return blocks.select(key, "cue", vtt_millis(F.regexp_extract("b", TIMING, 1)).alias("start_ms"), vtt_millis(F.regexp_extract("b", TIMING, 2)).alias("end_ms"), F.regexp_replace("b", rf"(?s)^.*?{TIMING}", "").alias("body"))


def webvtt(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Cues (key, cue, start_ms, end_ms, new_speaker, text) of whole WebVTT texts."""
    cues = _cues(df, key, text)
    body = F.col("body")
    out = cues.select(key, "cue", "start_ms", "end_ms", F.rlike(body, F.lit(r"^\s*(>>|&gt;&gt;)")).alias("new_speaker"), collapse(F.regexp_replace(F.regexp_replace(body, r"^\s*(>>|&gt;&gt;)\s*", ""), r"</?[vc][^>]*>", "")).alias("text"))
    return out.where(~F.rlike("text", F.lit(r"(?i)www\.|captioning")))


def captions(df: DataFrame, key: str, council: Council, text: str = "text") -> DataFrame:
    """Cues as webvtt() gives them, with speaker_hint and speaker_hint_strength; what says who speaks is no text. Cues without either are left out, as are a vendor's own."""
    cues = _cues(df, key, text)
    told = spoken_by(cues.withColumn("lines", F.split(F.regexp_replace("body", "&gt;", ">"), "\n")).drop("body"), "lines", council).drop("lines")
    return told.where(~F.rlike("text", F.lit(WATERMARK)) & ((F.col("text") != "") | ((F.col("speaker_hint") != "") & F.col("new_speaker"))))


def js_array(script: Column, constant: str, schema: str) -> Column:
    """The array of structs that a script assigns to a constant; trailing commas are allowed."""
    body = F.regexp_extract(script, rf"(?s){constant}\s*=\s*(\[.*?\])\s*;?\s*(?:\n\s*(?:if|module|window)|$)", 1)
    return F.from_json(F.regexp_replace(body, r",\s*([\]}])", "$1"), schema)


def html_links(df: DataFrame, key: str, html: str = "html") -> DataFrame:
    """(key, pos, href, label) of the items of a page's lists that link somewhere."""
    items = F.regexp_extract_all(html, F.lit(r'<li><a href="([^"]*)">(.*?)</a></li>'), 0)
    rows = df.select(key, F.posexplode(items).alias("pos", "item"))
    return rows.select(key, "pos", F.regexp_extract("item", r'href="([^"]*)"', 1).alias("href"), strip_tags(F.col("item")).alias("label"))


def html_elements(df: DataFrame, key: str, tag: str, html: str = "html") -> DataFrame:
    """(key, pos, label) of a page's elements of one name."""
    rows = df.select(key, F.posexplode(F.regexp_extract_all(html, F.lit(rf"(?s)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>"), 1)).alias("pos", "item"))
    return rows.select(key, "pos", strip_tags(F.col("item")).alias("label"))


def html_rows(html: Column, begin: str, end: str, mark: str) -> Column:
    """The table rows between two marks of a page that hold a pattern; none where a mark is missing."""
    section = F.regexp_extract(html, rf"(?s)\Q{begin}\E(.*?)\Q{end}\E", 1)
    return F.filter(F.regexp_extract_all(section, F.lit(r"(?is)<tr\b.*?</tr>"), 0), lambda r: F.rlike(r, F.lit(mark)))


def meeting_table(df: DataFrame, key: str, begin: str, end: str, site: str, name: str = "Meeting", view: str = "1", html: str = "html") -> DataFrame:
    """(key and 13 columns) of a page's table of recorded meetings between two marks, one row for each with a clip, newest first."""
    cell = lambda pattern: collapse(unescape(F.regexp_replace(F.regexp_extract("r", pattern, 1), r"<[^>]+>", "")))
    link = lambda pattern, scheme="": F.concat(F.lit(scheme), F.nullif(F.regexp_extract("r", rf'href="({pattern})"', 1), F.lit("")))
    rows = df.select(key, F.explode(html_rows(F.col(html), begin, end, r"clip_id=\d")).alias("r"))
    rows = rows.select(key, F.regexp_extract("r", r"clip_id=(\d+)", 1).cast("long").alias("clip_id"), F.coalesce(F.nullif(cell(r"&nbsp;([^<\r\n]+)"), F.lit("")), F.lit(name)).alias("name"), cell(r"(?i)<td[^>]*nowrap[^>]*>\s*([^<]+)\s*</td>").alias("date_label"), cell(r'(?is)<td[^>]*headers="Duration.*?">(.*?)</td>').alias("duration_label"), link(r"//[^\"]+/AgendaViewer\.php[^\"]+", "https:").alias("agenda_url"), link(r"//[^\"]+/MinutesViewer\.php[^\"]+", "https:").alias("minutes_url"), link(r"https://[^\"]+\.mp3").alias("mp3_url"), link(r"https://[^\"]+\.mp4").alias("mp4_url"))
    date = F.expr("try_to_date(date_label, 'MMM d, yyyy')")
    clip = F.col("clip_id").cast("string")
    out = rows.select(key, "clip_id", "name", "date_label", date.alias("date"), "duration_label", duration(F.col("duration_label")).alias("duration_seconds"), "agenda_url", "minutes_url", "mp3_url", "mp4_url", F.concat(F.lit(f"{site}/player/clip/"), clip).alias("player_url"), F.concat(F.lit(f"{site}/MediaPlayer.php?view_id={view}&clip_id="), clip).alias("media_player_url"), slug(date).alias("meeting_id_suggested"))
    return out.orderBy(F.col("date").desc_nulls_last(), F.col("clip_id").desc())


def html_points(df: DataFrame, key: str, tag: str = "div", token: str = "index-point", attribute: str = "time", html: str = "html") -> DataFrame:
    """(key, start_seconds, label) of elements whose class has a token and whose attribute is a number, in any order of attributes; the next end tag ends them."""
    opening = rf"<{tag}\b(?=[^>]*\sclass=[\"'][^\"'>]*{token})(?=[^>]*\s{attribute}=[\"'](\d+)[\"'])[^>]*>"
    rows = df.select(key, F.posexplode(F.regexp_extract_all(html, F.lit(rf"(?is){opening}.*?</{tag}>"), 0)).alias("pos", "e"))
    rows = rows.select(key, "pos", F.regexp_extract("e", rf"(?is){opening}", 1).cast("long").alias("start_seconds"), strip_tags(F.col("e")).alias("label"))
    return rows.where("label <> ''")


def registry(spark: SparkSession, path: str) -> DataFrame:
    """Speakers by key, last entry of a key; their raw ids exploded by J12."""
    rows = read_json(spark, path, REGISTRY).select(F.posexplode("speakers").alias("pos", "s")).select("pos", "s.*").where("trim(speaker_key) <> ''")
    return rows.groupBy("speaker_key").agg(F.max_by(F.struct("display_name", "role", "aliases", "diarization_speaker_ids"), "pos").alias("s")).select("speaker_key", "s.*")


def approvals(df: DataFrame, key: str, document: str = "document") -> DataFrame:
    """(key, speaker_raw, status, name, speaker_key) of maps that stand by themselves or under approvals."""
    entry = "map<string,struct<status:string,name:string,speaker_key:string>>"
    wrapped = F.from_json(document, f"approvals {entry}")["approvals"]
    bare = F.from_json(document, entry)
    return df.select(key, F.explode(F.coalesce(wrapped, bare)).alias("speaker_raw", "a")).where("a is not null").select(key, "speaker_raw", "a.*")


def embeddings(listed: DataFrame, files: DataFrame) -> DataFrame:
    """Vectors given in a list, else found by path."""
    out = listed.join(files.select(F.col("embedding_path"), F.col("embedding").alias("__e")), "embedding_path", "left")
    return out.withColumn("embedding", F.coalesce("embedding", "__e")).drop("__e").where("embedding is not null")


def review_sheet(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A sheet of reviews, CSV or JSON by its suffix."""
    reader = spark.read.schema(schema)
    return reader.option("header", True).option("escape", '"').csv(path) if path.endswith(".csv") else reader.option("multiLine", True).json(path)


def gold(df: DataFrame, key: str, document: str = "document") -> DataFrame:
    """Gold turns with their excerpt."""
    turn = "struct<turn_id:string,start:double,end:double,speaker_name:string,text:string>"
    rows = df.select(key, F.explode(F.from_json(document, f"excerpts array<struct<excerpt_id:string,start:double,end:double,turns:array<{turn}>>>")["excerpts"]).alias("e"))
    return rows.select(key, "e.excerpt_id", F.explode("e.turns").alias("t")).select(key, "excerpt_id", "t.*")


def votes(meeting_rows: DataFrame, documents: DataFrame, key: str = "meeting_id", document: str = "document") -> DataFrame:
    """Votes of meetings that have a document; the others are left without any."""
    vote = "struct<item:string,title:string,result:string,vote_count:string,opposed:array<string>,timestamp_seconds:long>"
    rows = meeting_rows.select(key).join(documents, key, "left").select(key, F.explode_outer(F.from_json(document, f"votes array<{vote}>")["votes"]).alias("v"))
    return rows.select(key, "v.*")


def external(spark: SparkSession, path: str) -> DataFrame:
    """What services, models and media tools have landed, one file a row with its text; the tools themselves run elsewhere."""
    return spark.read.option("wholetext", True).text(path).withColumn("path", F.input_file_name())
