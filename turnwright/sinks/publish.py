"""Sinks: documents, pages, captions and tables made from turns, and checks before they go out.

The text forms give one row per meeting with the file's content, which any writer of text, JSON or tables then stores; atomic() writes a
table so that readers see the old one or the new one.
"""

from __future__ import annotations

import time
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from turnwright.functions.text import escape, hms, vtt_time
from turnwright.sinks.gate import Gate, RefusedError


def _gathered(turns: DataFrame, line: Column, separator: str, key: str, order: str) -> DataFrame:
    rows = F.array_sort(F.collect_list(F.struct(order, line.alias("line"))))
    return turns.groupBy(key).agg(F.array_join(F.transform(rows, lambda r: r["line"]), separator).alias("content"))


def json_document(turns: DataFrame, fields: list[str], key: str = "meeting_id", order: str = "pos", schema: str = "structured_transcript.v1") -> DataFrame:
    """K1: one document a meeting, turns in order."""
    rows = F.array_sort(F.collect_list(F.struct(order, *fields)))
    body = F.struct(F.lit(schema).alias("schema"), F.col(key), F.transform("__rows", lambda r: F.struct(*(r[f].alias(f) for f in fields))).alias("turns"))
    return turns.groupBy(key).agg(rows.alias("__rows")).select(key, F.to_json(body).alias("content"))


def js_file(documents: DataFrame, constant: str = "TRANSCRIPT_TURNS", content: str = "content") -> DataFrame:
    """K2: a script that assigns a document's turns to a constant."""
    turns = F.get_json_object(content, "$.turns")
    return documents.withColumn(content, F.concat(F.lit(f"const {constant} = "), turns, F.lit(f";\nif (typeof module !== 'undefined') module.exports = {{ {constant} }};\n")))


def html_page(turns: DataFrame, key: str = "meeting_id", order: str = "pos", colours: int = 8) -> DataFrame:
    """K3: a page a meeting; speakers are coloured by their place in order of name."""
    shade = F.pmod(F.dense_rank().over(W.partitionBy(key).orderBy("speaker")) - 1, F.lit(colours))
    df = turns.withColumn("__c", shade)
    line = F.concat(F.lit('<p class="c'), F.col("__c").cast("string"), F.lit('"><b>'), escape(F.col("speaker")), F.lit("</b> "), escape(F.col("text")), F.lit("</p>"))
    return _gathered(df, line, "\n", key, order).withColumn("content", F.concat(F.lit("<!DOCTYPE html><html><body>\n"), "content", F.lit("\n</body></html>\n")))


def markdown(turns: DataFrame, key: str = "meeting_id", order: str = "pos") -> DataFrame:
    """Text with a header where the speaker changes; unknown ones never make a header."""
    named = F.when(F.col("speaker") != "Unknown Speaker", F.col("speaker"))
    before = F.last(named, ignorenulls=True).over(W.partitionBy(key).orderBy(order).rowsBetween(W.unboundedPreceding, -1))
    header = F.when(named.isNotNull() & ~named.eqNullSafe(before), F.concat(F.lit("## "), named, F.lit("\n\n"))).otherwise("")
    return _gathered(turns.withColumn("__h", header), F.concat("__h", "text"), "\n\n", key, order)


def webvtt(turns: DataFrame, key: str = "meeting_id", order: str = "pos") -> DataFrame:
    """K7: cues with voice spans; start and end are seconds."""
    millis = lambda c: F.floor(F.col(c) * 1000).cast("long")
    line = F.concat(vtt_time(millis("start")), F.lit(" --> "), vtt_time(millis("end")), F.lit("\n<v "), "speaker", F.lit(">"), "text")
    return _gathered(turns, line, "\n\n", key, order).withColumn("content", F.concat(F.lit("WEBVTT\n\n"), "content", F.lit("\n")))


def plain_text(turns: DataFrame, key: str = "meeting_id", order: str = "pos") -> DataFrame:
    """K8: [hh:mm:ss] text."""
    return _gathered(turns, F.concat(F.lit("["), hms(F.col("start")), F.lit("] "), "text"), "\n", key, order)


def violations(df: DataFrame, key: str, required: list[str]) -> DataFrame:
    """(key, field) of required fields that are null or empty; publish only if there is none."""
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("field"), (F.coalesce(F.col(c).cast("string"), F.lit("")) == "").alias("bad")) for c in required)))
    return df.select(key, each.alias("x")).where("x.bad").select(key, "x.field")


def csv(df: DataFrame, path: str) -> None:
    """K5: CSV with a header."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def search_document(meetings: DataFrame, segments: DataFrame, generated_at: str, key: str = "meeting_id") -> DataFrame:
    """K4: one row a meeting with its JSON envelope {generated_at, meetings, segments, speakers}; segments in order, speakers by name. What one
    file holds is one meeting's; envelope() is the small one of all meetings, without segments."""
    fields = [c for c in segments.columns if c != key]
    own = segments.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("segments"), F.array_sort(F.collect_set("speaker")).alias("speakers"))
    row = F.struct(*meetings.columns)
    body = F.struct(F.lit(generated_at).alias("generated_at"), F.array(row).alias("meetings"), F.coalesce("segments", F.array().cast(own.schema["segments"].dataType)).alias("segments"), F.coalesce("speakers", F.array().cast("array<string>")).alias("speakers"))
    return meetings.join(own, key, "left").select(key, F.to_json(body).alias("content"))


def search_index(segments: DataFrame, path: str, date: str = "meeting_date") -> None:
    """K4: segments by date, so that date filters prune files."""
    segments.repartition(date).write.mode("overwrite").partitionBy(date).parquet(path)


def _pointer(spark: SparkSession, path: str, text: str | None = None) -> str | None:
    """The version that a pointer file names; or, given a text, that version put in its place by one rename."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    file = jvm.org.apache.hadoop.fs.Path(f"{path}/_current")
    fs = file.getFileSystem(conf)
    if text is None:
        if not fs.exists(file):
            return None
        source = fs.open(file)
        try:
            return jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
        finally:
            source.close()
    new = jvm.org.apache.hadoop.fs.Path(f"{path}/_current.{uuid4().hex}")
    out = fs.create(new)
    out.write(bytearray(text.encode()))
    out.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(file.toUri(), conf).rename(new, file, options)
    return text


def current(spark: SparkSession, path: str) -> str | None:
    """K9: the folder of the version that atomic() published last."""
    name = _pointer(spark, path)
    return name and f"{path}/{name}"


#: What folders of versions are called.
VERSIONS = ("v-", "upto=")


def atomic(df: DataFrame, path: str, version: str | None = None, gate: Gate | None = None, hours: float = 24) -> str:
    """K9: df in place of what was published at a path; returns its folder.

    The rows go to a folder of their own; only when all are written, and none broke a rule of the gate, does the pointer file change, by one rename. A writer that fails leaves
    the old version as it was. Versions before the last one go once they are so many hours old, for readers and writers that still have them open; nothing else under the path is touched.
    """
    spark = df.sparkSession
    before, name = _pointer(spark, path), version or f"v-{uuid4().hex}"
    if name == before:
        raise ValueError(f"{name} is what readers see now")
    if not name.startswith(VERSIONS):
        raise ValueError(f"a version's name begins with {' or '.join(VERSIONS)}")
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = place(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    (gate.watch(df) if gate else df).write.mode("overwrite").parquet(f"{path}/{name}")
    if gate:
        try:
            gate.verdict()
        except RefusedError:
            fs.delete(place(f"{path}/{name}"), True)
            raise
    _pointer(spark, path, name)
    old = (time.time() - hours * 3600) * 1000
    for f in fs.listStatus(place(path)):
        own = f.getPath().getName()
        if f.isDirectory() and own.startswith(VERSIONS) and own not in (name, before) and f.getModificationTime() < old:
            fs.delete(f.getPath(), True)
    return f"{path}/{name}"


def append_state(df: DataFrame, path: str) -> None:
    """Rows added to an append-only log; resolve.latest() gives the state."""
    df.write.mode("append").parquet(path)


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
