"""What plans share: tables, and the relations that stand for transcripts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
EPOCH = "TIMESTAMP_NTZ '2024-01-01 00:00:00'"


class Plans:
    """Queries by name, and their SQL where there is one."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def keep(query: Query) -> Query:
            self.queries[name] = query
            if sql:
                self.sql[name] = sql
            return query

        return keep

    def columns(self, name: str, table_name: str, key: str, spark_columns: dict, sql_columns: dict[str, str]) -> None:
        """A query of one table's key and some expressions."""
        self.queries[name] = lambda spark, sf: table(spark, sf, table_name).select(key, *(make(F.col).alias(c) for c, make in spark_columns.items()))
        self.sql[name] = f"SELECT {key}, {', '.join(f'{x} AS {c}' for c, x in sql_columns.items())} FROM {table_name}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def seconds(ts: str = "ts"):
    """Whole seconds of a timestamp without zone since the epoch of the data, whatever the session's zone."""
    return F.floor(F.expr(f"timestampdiff(MICROSECOND, {EPOCH}, {ts})") / 1_000_000).cast("long")


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as turns of a meeting per user: speaker, start and end in seconds (value hours long), text, and place."""
    e = table(spark, sf_dir, "events")
    start = seconds()
    df = e.select(F.col("user_id").alias("meeting_id"), "event_id", start.alias("start"), (start + F.floor(F.col("value") * 100 + 0.5).cast("long") * 36).alias("end"), F.col("event_type").alias("speaker"), F.concat_ws(" ", "event_type", "props").alias("text"), "ts", "value")
    return df.withColumn("pos", F.row_number().over(W.partitionBy("meeting_id").orderBy("ts", "event_id")).cast("long"))


SECONDS_SQL = "CAST(floor((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) / 1000000) AS BIGINT)"
TURNS_SQL = f"""turns AS (SELECT user_id AS meeting_id, event_id, {SECONDS_SQL} AS start, {SECONDS_SQL} + CAST(floor(value * 100 + 0.5) AS BIGINT) * 36 AS "end",
 event_type AS speaker, event_type || ' ' || props AS text, ts, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos FROM events)"""
