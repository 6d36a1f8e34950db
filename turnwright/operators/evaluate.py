"""Evaluation of speakers and words against a gold set."""

from __future__ import annotations

import zlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def edits(a: list[str], b: list[str]) -> int:
    """Words to change, add or drop."""
    if not a or not b:
        return max(len(a), len(b))
    if len(a) < len(b):
        a, b = b, a  # a step for each word of the shorter one, over bits of the longer one
    # a column of the table of distances as two bit vectors: where it rises, and where it falls, by one word; what passes the last bit never comes back
    full, falls, places = (1 << len(a)) - 1, 0, dict.fromkeys(b, 0)
    rises = full
    for k, w in enumerate(a):
        if w in places:
            places[w] |= 1 << k
    for w in b:
        if same := places[w]:
            across = (((same & rises) + rises) ^ rises) | same | falls
            up = (falls | (full ^ (across | rises))) << 1 | 1
            rises, falls = ((rises & across) << 1 | (full ^ (across | up))) & full, up & across
        else:  # the same with across = falls: a rise moves on by one word, and ends where it meets a fall
            moved = rises << 1
            met = moved & falls
            rises, falls = (moved ^ met) & full, falls ^ met
    return len(b) + rises.bit_count() - (falls & full).bit_count()


def with_next(df: DataFrame, number: str, text: str, name: str, block: int = 64) -> DataFrame:
    """Rows that have a next one, by their whole numbers, with its text. Rows are dealt by blocks of numbers, so each travels once, and only the first of a block twice; numbers don't repeat.

    Blocks go to several tasks a core, and to as many as the session's shuffles have: pairs of long texts take so long that a few large tasks would leave cores idle.
    """
    spark = df.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    own = F.floor(F.col(number) / block)
    dealt = df.withColumn("__block", F.explode(F.when(F.col(number) % block == 0, F.array(own, own - 1)).otherwise(F.array(own))))
    after = F.lead(F.struct(number, text)).over(W.partitionBy("__block").orderBy(number))
    return dealt.repartition(parts, "__block").withColumn("__after", after).where((F.col(f"__after.{number}") == F.col(number) + 1) & (own == F.col("__block"))).withColumn(name, F.col(f"__after.{text}")).drop("__block", "__after")


def packed(text: str) -> Column:
    """A text as compressed bytes, for those that travel far; wer reads them as well."""

    def work(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else zlib.compress(x.encode(), 1))

    work.__annotations__ = {"s": pd.Series, "return": pd.Series}
    return F.pandas_udf(work, "binary")(text)


def _words(x: str | bytes | None) -> list[str]:
    return (zlib.decompress(x).decode() if isinstance(x, bytes) else x or "").lower().split()


def wer(reference: str, hypothesis: str) -> Column:
    """word error rate of two texts, or packed ones; of an empty reference 0 if the other is empty too, else 1."""

    def work(r: pd.Series, h: pd.Series) -> pd.Series:
        pairs = ((_words(x), _words(y)) for x, y in zip(r, h, strict=True))
        return pd.Series([edits(a, b) / len(a) if a else float(bool(b)) for a, b in pairs], dtype="float64")

    work.__annotations__ = {"r": pd.Series, "h": pd.Series, "return": pd.Series}
    return F.pandas_udf(work, "double")(reference, hypothesis)


#: How each evaluator counts: whether a name missed also is wrong, and whether a name given to an unknown counts.
EVALUATORS = {"E2": (False, "ignore"), "E3": (True, "ignore"), "E4": (False, "ignore"), "E5": (False, "missed")}


def outcomes(pairs: DataFrame, gold: str = "gold", found: str = "found", unknown: str = "Unknown Speaker") -> DataFrame:
    """pairs with outcome: match, wrong, missed (unknown though named), named (named though unknown), unknown, none."""
    g, f = F.coalesce(gold, F.lit(unknown)), F.coalesce(found, F.lit(unknown))
    what = F.when(F.col(found).isNull(), "none").when((g == unknown) & (f == unknown), "unknown").when(g == unknown, "named").when(f == unknown, "missed").when(g == f, "match").otherwise("wrong")
    return pairs.withColumn("outcome", what)


def report(pairs: DataFrame, group: str, evaluator: str = "E2") -> DataFrame:
    """Counts and match rate of each group and of all (group null), by the evaluator's rules."""
    also_wrong, named = EVALUATORS[evaluator]
    o = F.col("outcome")
    missed = (o == "missed") | ((o == "named") if named == "missed" else F.lit(False))
    wrong = (o == "wrong") | (missed if also_wrong else F.lit(False))
    out = pairs.rollup(group).agg(F.count(F.lit(1)).alias("n"), F.count_if(o == "match").alias("matches"), F.count_if(wrong).alias("wrong"), F.count_if(missed).alias("missed"))
    whole = F.col("matches") + F.col("wrong") + (F.lit(0) if also_wrong else F.col("missed"))
    return out.withColumn("rate", F.when(whole > 0, F.col("matches") / whole))


def verdict(before: Column, after: Column, rate_before: Column, rate_after: Column) -> Column:
    """READY if fewer are wrong and the rate isn't lower."""
    return F.when((after < before) & (rate_after >= rate_before), "READY").otherwise("NOT_READY")
