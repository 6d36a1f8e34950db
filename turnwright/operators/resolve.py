"""Who is it: evidence, votes, priorities, rosters, and joins that apply them."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Patterns of evidence with reason and weight.
EVIDENCE = ((r"\bmy name is ([A-Z][a-z]+(?: [A-Z][a-z]+){1,3})\b", "self_intro", 5), (r"\bthis is ([A-Z][a-z]+(?: [A-Z][a-z]+){1,3})\b", "self_intro", 4), (r"\bGood evening, ([A-Z][a-z]+(?: [A-Z][a-z]+){1,3})(?:,|\b)", "opening_intro", 3))
RESIDENCE = r"\b\d{3,5}\s+[A-Z][a-zA-Z]+|\bI (?i:live|have lived|am here)\b"


def evidence(df: DataFrame, text: str) -> DataFrame:
    """df with a row for each name that its text gives, with reason and weight; signs of residence raise openings by one."""
    clean = F.trim(F.regexp_replace(text, r"\s+", " "))

    def named(pattern: str, reason: str, weight: int) -> Column:
        return F.transform(F.regexp_extract_all(clean, F.lit(pattern), 1), lambda n: F.struct(n.alias("name"), F.lit(reason).alias("reason"), F.lit(weight).alias("weight")))

    found = [named(*e) for e in EVIDENCE]
    out = df.withColumn("__near", F.rlike(clean, F.lit(RESIDENCE))).withColumn("__e", F.explode(F.concat(*found)))
    up = F.col("__near") & (F.col("__e.reason") == "opening_intro")
    return out.withColumns({"name": F.col("__e.name"), "reason": F.when(up, "opening_intro_with_context").otherwise(F.col("__e.reason")), "weight": F.col("__e.weight") + up.cast("int")}).drop("__e", "__near")


def weighted_vote(votes: DataFrame, keys: list[str], label: str, weight: str, least: float = 5, share: float = 0.7) -> DataFrame:
    """Of each group the label with most weight, accepted if it has `least` weight, no rival of the same, and the share of all."""
    each = votes.groupBy(*keys, label).agg(F.sum(weight).alias("n"))
    w = W.partitionBy(*keys).orderBy(F.col("n").desc(), label)
    ranked = each.withColumn("__r", F.row_number().over(w))
    out = ranked.groupBy(*keys).agg(F.max(F.when(F.col("__r") == 1, F.col(label))).alias(label), F.max("n").alias("best"), F.coalesce(F.max(F.when(F.col("__r") == 2, F.col("n"))), F.lit(0)).alias("second"), F.sum("n").alias("total"))
    return out.withColumn("accepted", (F.col("best") >= least) & (F.col("best") != F.col("second")) & (F.col("best") >= share * F.col("total")))


def priority_union(first: DataFrame, second: DataFrame, key: str, value: str) -> DataFrame:
    """Keys of both, with the first's value where it has one."""
    both = first.select(key, value, F.lit(0).alias("__p")).unionByName(second.select(key, value, F.lit(1).alias("__p")))
    return both.groupBy(key).agg(F.min_by(value, F.struct("__p", value)).alias(value))


def latest(log: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """U4: the last row of each key of an append-only log."""
    rows = F.max_by(F.struct(*log.columns), F.struct(*order)).alias("__row")
    return log.groupBy(*(F.col(k).alias(f"__{k}") for k in keys)).agg(rows).select("__row.*")


def lookup(df: DataFrame, dimension: DataFrame, on: str, value: str, default: str) -> DataFrame:
    """Df with the dimension's value, or the default. The join picks its own way by the dimension's size."""
    return df.join(dimension.select(on, value), on, "left").withColumn(value, F.coalesce(value, F.lit(default)))


def unique_ids(new: DataFrame, taken: DataFrame, base: str, clip: str) -> DataFrame:
    """P20: base id if it is free or the same clip's, else base-clip."""
    old = taken.select(F.col(base).alias("__id"), F.col(clip).alias("__clip"))
    out = new.join(old, new[base] == old["__id"], "left")
    return out.withColumn("id", F.when(F.col("__id").isNull() | (F.col("__clip") == F.col(clip)), F.col(base)).otherwise(F.concat_ws("-", base, F.col(clip).cast("string")))).drop("__id", "__clip")


def closest(heard: str, roster: dict[str, str]) -> str:
    """the roster's name for what was heard: equal, else alike by ratio, else the only one with its first letter; empty if none."""
    key = " ".join((heard or "").lower().split())
    if not key or not roster:
        return ""
    if key in roster:
        return roster[key]
    forms = {form: name for full, name in roster.items() for form in (full, full.split()[-1])}
    best: dict[str, float] = {}
    for form, name in forms.items():
        best[name] = max(best.get(name, 0.0), SequenceMatcher(None, key, form).ratio())
    ranked = sorted(best.items(), key=lambda x: -x[1])
    lead = ranked[0][1] - (ranked[1][1] if len(ranked) > 1 else 0)
    if ranked[0][1] >= 0.66 or ranked[0][1] >= 0.58 and lead >= 0.12:
        return ranked[0][0]
    same = [name for name in best if name.split()[-1][:1].lower() == key[:1]]
    return same[0] if len(same) == 1 else ""


def _over_distinct(heard: pd.Series, work) -> pd.Series:
    """work on each distinct value once."""
    return heard.map({h: work(h) for h in heard.dropna().unique()}).fillna("")


def fuzzy_roster(heard: str, roster: dict[str, str]) -> Column:
    """F24 as a column; Arrow batches, distinct values once."""
    return F.pandas_udf(lambda s: _over_distinct(s, lambda h: closest(h, roster)), "string")(heard)
