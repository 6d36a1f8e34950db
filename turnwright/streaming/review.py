"""Structured Streaming: decision logs to latest state, sessions by gap, and churn by window."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from turnwright.operators.resolve import latest
from turnwright.operators.review import apply
from turnwright.sinks import parts
from turnwright.sinks.publish import atomic, current, json_document


#: Batches of a decision log between snapshots.
SNAPSHOT = 20


def _upto(folder: str | None) -> int:
    return int(folder.rsplit("upto=", 1)[1]) if folder else -1


def decisions(spark: SparkSession, table_path: str, keys: list[str], order: list[str]) -> DataFrame | None:
    """T5: the last decision of each key: what the snapshot holds and the log adds since; None before the first batch."""
    base = current(spark, table_path)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{table_path}/log/batch=*/_SUCCESS")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [f.getPath().getParent().getName() for f in fs.globStatus(folder) or []]
    paths = [f"{table_path}/log/{n}" for n in names if int(n.split("=")[1]) > _upto(base)]
    logs = [spark.read.parquet(p) for p in ([base] if base else []) + paths]
    return latest(reduce(lambda a, b: a.unionByName(b), logs), keys, order) if logs else None


def _keep(batch: DataFrame, number: int, table_path: str, keys: list[str], order: list[str], snapshot: int) -> None:
    """Add a batch to the log; now and then write the state anew and drop the log up to there."""
    spark = batch.sparkSession
    if number <= _upto(current(spark, table_path)):
        return  # ran before, and its rows are in the snapshot
    latest(batch, keys, order).write.mode("overwrite").parquet(f"{table_path}/log/batch={number}")
    if number % snapshot == snapshot - 1:
        atomic(decisions(spark, table_path, keys, order), table_path, f"upto={number}")
        log = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{table_path}/log")
        fs = log.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for f in fs.listStatus(log):
            if int(f.getPath().getName().split("=")[1]) <= number - snapshot:
                fs.delete(f.getPath(), True)


def latest_decisions(stream: DataFrame, table_path: str, checkpoint: str, keys: list[str], order: list[str], snapshot: int = SNAPSHOT) -> StreamingQuery:
    """T4, T5: a stream of decisions kept as a log, one folder a batch with the last of each key in it; decisions() reads the state.

    A batch writes its own rows only; a batch that runs twice writes the same folder. Each `snapshot` batches the state is written anew
    and published by one rename, and the log up to there is dropped.
    """
    append = lambda batch, number: _keep(batch, number, table_path, keys, order, snapshot)
    return stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def once(stream: DataFrame, keys: list[str], ts: str, late: str = "1 hour") -> DataFrame:
    """T4: the first row of each key, as long as repeats come within `late` of it; keys older than that are forgotten, so state is bounded."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def documents(turns: DataFrame, decided: DataFrame | None, keys: list[str], order: list[str], fields: list[str]) -> DataFrame:
    """The documents of meetings (the first of keys), with what was decided applied."""
    applied = turns if decided is None else apply(turns, decided, keys, order)
    return json_document(applied, fields, key=keys[0])


def republish(stream: DataFrame, turns: DataFrame, table_path: str, path: str, checkpoint: str, keys: list[str], order: list[str], fields: list[str], snapshot: int = SNAPSHOT) -> StreamingQuery:
    """T5: a stream of decisions, after each batch of which the documents of the meetings it touched are made again, and no others.

    keys: a meeting and a turn. The batch goes to the log of decisions first; then all decisions on its meetings are applied to their turns, and their documents, a partition
    each, replace those that were published at path. A batch that runs twice gives the same documents.
    """

    def work(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            _keep(batch, number, table_path, keys, order, snapshot)
            touched = batch.select(keys[0]).distinct()
            if not touched.isEmpty():
                state = decisions(spark, table_path, keys, order).join(touched, keys[0], "left_semi")
                parts.replace(documents(turns.join(touched, keys[0], "left_semi"), state, keys, order, fields), path, [keys[0]])
        finally:
            batch.unpersist()

    return stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def sessions(events: DataFrame, keys: list[str], gap: str = "6 hours", late: str = "1 hour", ts: str = "ts") -> DataFrame:
    """Sessions by gap, in batch and stream alike: start, end and number of rows."""
    df = events.withWatermark(ts, late) if events.isStreaming else events
    w = F.session_window(ts, gap)
    return df.groupBy(*keys, w.alias("w")).agg(F.count(F.lit(1)).alias("n"), F.max(ts).alias("last")).select(*keys, F.col("w.start").alias("start"), "last", "n")


def churn(events: DataFrame, label: str, width: str = "1 day", late: str = "1 hour", ts: str = "ts", exact: bool | None = None) -> DataFrame:
    """Labels by window; exact in batch, by sketch in a stream."""
    df = events.withWatermark(ts, late) if events.isStreaming else events
    exact = not events.isStreaming if exact is None else exact
    n = F.count_distinct(label) if exact else F.approx_count_distinct(label, 0.01)
    return df.groupBy(F.window(ts, width).alias("w")).agg(n.alias("labels"), F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), "labels", "n")


def unseen(new: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What was not done yet."""
    return new.join(done.select(key), key, "left_anti")
