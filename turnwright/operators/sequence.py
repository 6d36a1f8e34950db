"""Sequence operators on ordered rows of a group: runs told by neighbours (gaps and islands), frames, carries and numbering."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from turnwright.session import cut


def islands(df: DataFrame, keys: list[str], order: list[str], new: Column, name: str = "run_id") -> DataFrame:
    """df with the number of each row's run; a run begins where `new` is true or null. new may use lag over the same window."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.coalesce(new, F.lit(True)).cast("long")).withColumn(name, F.sum(name).over(w.rowsBetween(W.unboundedPreceding, 0)))


def before(column: str, keys: list[str], order: list[str], by: int = 1) -> Column:
    return F.lag(column, by).over(W.partitionBy(*keys).orderBy(*order))


def runs(df: DataFrame, keys: list[str], order: list[str], same: str, text: str | None = None, gap: float | None = None) -> DataFrame:
    """Runs of equal `same`, and of gaps up to `gap` after the latest end so far: one row each with start, end, n and the joined texts."""
    runs_of = islands(df, keys, order, before(same, keys, order) != F.col(same), "__same")
    if gap is not None:
        w = W.partitionBy(*keys, "__same").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
        runs_of = runs_of.withColumn("__end", F.max("end").over(w))
        runs_of = islands(runs_of, keys, order, F.col("__end").isNull() | (F.col("start") - F.col("__end") > gap), "__same")
    joined = [F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, text))), lambda x: x[text]), " ").alias(text)] if text else []
    return runs_of.groupBy(*keys, F.col("__same").alias("run_id"), same).agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count(F.lit(1)).alias("n"), *joined)


def dominant_share(df: DataFrame, keys: list[str], order: list[str], unknown: str = "UNKNOWN") -> DataFrame:
    """Of each group of blocks the known speaker with most seconds (best: speaker, n; ties to the first), total seconds, rows, and the speaker's share of the total."""
    df = df.withColumn("__d", F.col("end") - F.col("start"))
    known = df.where(F.col("speaker") != unknown).groupBy(*keys, "speaker").agg(F.sum("__d").alias("n"), F.min(F.struct(*order)).alias("first"))
    best = known.groupBy(*keys).agg(F.min_by(F.struct("speaker", "n"), F.struct((-F.col("n")).alias("n"), "first")).alias("best"))
    total = df.groupBy(*keys).agg(F.sum("__d").alias("total"), F.count(F.lit(1)).alias("rows"))
    return total.join(best, keys, "left").withColumn("share", F.when(F.col("total") > 0, F.col("best.n") / F.col("total")))


def small_blocks(df: DataFrame, keys: list[str], order: list[str], short: float, dominance: float = 0.6, unknown: str = "UNKNOWN") -> DataFrame:
    """Runs of blocks under `short`: merged into one of the main speaker's if that has the share, else kept and, without any known speaker, deferred.

    Gives run_id, speaker, start, end, n, confidence and action (keep, microblock_cleanup, microblock_deferred).
    """
    df = df.withColumn("__d", F.col("end") - F.col("start"))
    df = df.withColumn("__short", F.col("__d") < short)
    df = islands(df, keys, order, before("__short", keys, order) != F.col("__short"), "__run")
    runs_of = dominant_share(df.where("__short"), [*keys, "__run"], order, unknown)
    df = df.join(runs_of, [*keys, "__run"], "left")
    merge = F.col("__short") & (F.col("share") >= dominance)
    defer = F.col("__short") & (F.col("best").isNull() | (F.col("total") == 0))
    df = df.withColumn("__group", F.when(merge, F.struct(F.lit(0).alias("m"), F.col("__run").alias("g"))).otherwise(F.struct(F.lit(1).alias("m"), F.col("pos").alias("g"))))
    df = df.withColumn("__who", F.when(merge, F.col("best.speaker")).otherwise(F.col("speaker"))).withColumn("__what", F.when(merge, "microblock_cleanup").when(defer, "microblock_deferred").otherwise("keep"))
    out = df.groupBy(*keys, "__group").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.first("__who").alias("speaker"), F.first("__what").alias("action"), F.count(F.lit(1)).alias("n"), F.max(F.when(merge, F.col("share"))).alias("confidence"))
    return out.drop("__group")


def sandwich(df: DataFrame, keys: list[str], order: list[str], long: float, short: float | None = None, most_words: int = 5, unknown: str = "UNKNOWN") -> DataFrame:
    """An unknown block under `short` (as `long` if not given) between two of one known speaker, each of `long` at least, becomes theirs."""
    short = long if short is None else short
    w = W.partitionBy(*keys).orderBy(*order)
    d = F.col("end") - F.col("start")
    a, b = F.lag("speaker").over(w), F.lead("speaker").over(w)
    long_both = (F.lag(d).over(w) >= long) & (F.lead(d).over(w) >= long)
    small = (F.size(F.split(F.trim("text"), r"\s+")) <= most_words) & ~F.rlike(F.rtrim("text"), F.lit(r'[.!?:,"]$'))
    hit = F.coalesce((F.col("speaker") == unknown) & (d < short) & (a == b) & (a != unknown) & long_both & small, F.lit(False))
    return df.withColumn("attached", hit).withColumn("speaker", F.when(hit, a).otherwise(F.col("speaker")))


def carry(df: DataFrame, keys: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """The last value that isn't null, up to the row."""
    return df.withColumn(name, F.last(value, ignorenulls=True).over(W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)))


def context(df: DataFrame, keys: list[str], order: list[str], fields: list[str], k: int, name: str = "context") -> DataFrame:
    """Up to k rows before and after each row, in order, as structs with is_target."""
    w = W.partitionBy(*keys).orderBy(*order)
    df = df.withColumn("__n", F.row_number().over(w))
    frame = F.collect_list(F.struct(F.col("__n").alias("__n"), *fields)).over(w.rowsBetween(-k, k))
    return df.withColumn(name, F.transform(frame, lambda x: F.struct(*(x[f].alias(f) for f in fields), (x["__n"] == F.col("__n")).alias("is_target")))).drop("__n")


def top_two(scores: DataFrame, keys: list[str], label: str, score: str) -> DataFrame:
    """Of each group, the best label and score, the runner-up's score (null if none) and the margin."""
    w = W.partitionBy(*keys).orderBy(F.col(score).desc(), label)
    best = scores.withColumn("__n", F.row_number().over(w)).where("__n <= 2").groupBy(*keys).agg(F.max(F.when(F.col("__n") == 1, F.col(label))).alias("best"), F.max(F.when(F.col("__n") == 1, F.col(score))).alias("best_score"), F.max(F.when(F.col("__n") == 2, F.col(score))).alias("second_score"))
    return best.withColumn("margin", F.col("best_score") - F.coalesce("second_score", F.lit(0)))


def first_seen(df: DataFrame, keys: list[str], label: str, order: str, name: str = "number") -> DataFrame:
    """Labels numbered by their first place in each group."""
    first = df.groupBy(*keys, label).agg(F.min(order).alias("__first"))
    numbered = first.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy("__first", label))).drop("__first")
    return df.join(numbered, [*keys, label])


def running(df: DataFrame, keys: list[str], order: list[str], value: str, name: str = "offset") -> DataFrame:
    """The sum of the values before each row."""
    return df.withColumn(name, F.coalesce(F.sum(value).over(W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))


def places(df: DataFrame, order: list, name: str = "place") -> DataFrame:
    """Df with each row's place in an order, from 1 on, without any row left out.

    Rows are sorted by ranges in parallel; what is added up in one place are the partitions' sizes. The sorted table is checkpointed, as
    its ranges are drawn by samples.
    """
    mine = F.monotonically_increasing_id()
    ranged = cut(df.orderBy(*order).withColumns({"__part": F.shiftright(mine, 33).cast("int"), "__row": mine.bitwiseAND((1 << 33) - 1)}))
    sizes = ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1))
    offsets = sizes.select("__part", F.coalesce(before, F.lit(0)).alias("__before"))  # one row a partition
    return ranged.join(F.broadcast(offsets), "__part").withColumn(name, F.col("__before") + F.col("__row") + 1).drop("__part", "__row", "__before")


def pieces(df: DataFrame, keys: list[str], order: list[str], seen: list[str], new: Callable[[Callable[[int, str], Column]], Column], high: str | None = None, depth: int = 1, tell: dict[str, tuple[int, str]] | None = None) -> DataFrame:
    """df with piece (a struct that names a stretch of one group's rows) and row (its place in its part): a piece begins with the group, and where `new` is true.

    new is made of before(i, field): a field of `seen`, i rows earlier in the same group (up to depth; the field there is 1 if there is a row), and of the column __high, the greatest `high` before the row. tell: columns to add, each such a field. Rows are
    sorted by ranges, which cut large groups anywhere, so a group is never in one place; windows run over the parts, and what a part needs of those before it (their last rows, the last piece that
    began) is one row a part.
    """
    mine = F.monotonically_increasing_id()
    ranged = cut(df.orderBy(*keys, *order).withColumns({"__part": F.shiftright(mine, 33).cast("int"), "row": mine.bitwiseAND((1 << 33) - 1)}))
    part, parts = W.partitionBy("__part").orderBy("row"), W.orderBy("__part")
    upto, earlier = (W.unboundedPreceding, 0), (W.unboundedPreceding, -1)
    own = W.partitionBy("__part", *keys).orderBy("row")
    highest = lambda frame: F.max(high).over(own.rowsBetween(*frame)) if high else F.lit(None)
    one = F.struct(F.struct(*keys).alias("key"), F.lit(1).alias("there"), *seen)
    last = ranged.withColumns({"__back": F.collect_list(one).over(part.rowsBetween(1 - depth, 0)), "__top": highest(upto)}).groupBy("__part").agg(F.max_by(F.struct("__back", "__top"), "row").alias("l"))
    last = last.select("__part", "l.__back", F.element_at("l.__back", -1)["key"].alias("__key"), "l.__top")
    last = last.withColumn("__top", F.max("__top").over(W.partitionBy("__key").orderBy("__part").rowsBetween(*upto)))
    # a part may have fewer rows than depth, so those of as many parts are looked at
    carried = last.select("__part", F.flatten(F.collect_list("__back").over(parts.rowsBetween(-depth, -1))).alias("__carried"), F.lag(F.struct("__key", "__top")).over(parts).alias("__prior"))
    back = F.concat("__carried", F.collect_list(one).over(part.rowsBetween(-depth, -1)))
    rows = ranged.join(F.broadcast(carried), "__part").withColumn("__back", back)
    mine_too = lambda key: F.struct(*keys).eqNullSafe(key)

    def before(i: int, field: str) -> Column:
        found = F.try_element_at("__back", F.lit(-i))
        return F.when(mine_too(found["key"]), found[field])

    above = F.when(mine_too(F.col("__prior.__key")), F.col("__prior.__top")) if high else F.lit(None)
    rows = rows.withColumn("__high", F.greatest(highest(earlier), above) if high else above)
    begins = ~F.coalesce(mine_too(F.try_element_at("__back", F.lit(-1))["key"]), F.lit(False)) | F.coalesce(new(before), F.lit(True))
    rows = rows.withColumn("__begins", begins.cast("long")).withColumn("__count", F.sum("__begins").over(part.rowsBetween(*upto)))
    more = {name: before(*what) for name, what in (tell or {}).items()}
    rows = rows.withColumns(more).select(*df.columns, *more, "__part", "row", "__count")
    count = rows.groupBy("__part").agg(F.max("__count").alias("n"))
    opened = count.select("__part", F.last(F.when(F.col("n") > 0, F.struct(F.col("__part").alias("part"), F.col("n").alias("number"))), ignorenulls=True).over(parts.rowsBetween(*earlier)).alias("__opened"))
    named = F.when(F.col("__count") > 0, F.struct(F.col("__part").alias("part"), F.col("__count").alias("number"))).otherwise(F.col("__opened"))
    return rows.join(F.broadcast(opened), "__part").select(*df.columns, *more, named.alias("piece"), F.struct(F.col("__part").alias("part"), "row").alias("row"))
