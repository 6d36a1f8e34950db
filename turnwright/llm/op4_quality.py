"""Quality rules: hashed n-gram log-likelihood ratio between a trusted target and the raw corpus, in built-in functions only.

Words and word pairs are hashed into 2**BITS bins. Over all documents, one aggregation counts each bin in the raw corpus
and in the trusted part of it; documents are trusted by plain rules on themselves (TRUSTED). A document's score is
the mean over its n-grams of log P(bin | trusted) - log P(bin | raw), both add-one smoothed, so length doesn't matter, and
a document is kept if it passes the base rules and its score is at least THRESHOLD. The bins' weights are 2**BITS rows,
however large the corpus, so they are broadcast to the scoring pass, whose n-grams are summed before any shuffle.

Defined results: a null or empty text has no words, all counts 0, score 0 and fails the base rules; a document is judged by its
text alone, so repeated rows get the same verdict each; an empty table gives an empty result; other columns pass through, whatever they are called, but for those that the operator adds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnwright.llm.clusterio import cut, table

BITS = 18
THRESHOLD = -0.12
SPACE = r"[\x20\x09-\x0D]"
WINDOW = 8
#: A trusted document has so many words at least; and per word, so few symbols, words in capitals, and words equal to the one before.
TRUSTED = {"words": 20, "symbols": 0.02, "capitals": 0.1, "stutters": 0.1}


def _next(h: Column, by: int) -> Column:
    """h without its first elements."""
    return F.slice(h, F.lit(by + 1), F.greatest(F.size(h) - F.lit(by), F.lit(0)))


def _paired(h: Column, by: int) -> Column:
    """A hash of each element with the one so many places on."""
    both = F.zip_with(F.slice(h, F.lit(1), F.greatest(F.size(h) - F.lit(by), F.lit(0))), _next(h, by), lambda a, b: F.xxhash64(a, b))
    return both


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")


def hashed(df: DataFrame, text: str) -> DataFrame:
    """df with words, their hashes h1, and the hashes h2 of word pairs."""
    return (
        df.withColumn("words", words(F.col(text)))
        .withColumn("h1", F.transform("words", lambda w: F.xxhash64(w)))
        .withColumn("h2", _paired(F.col("h1"), 1))
    )


def bin_of(h: str) -> Column:
    """The bin of an n-gram's hash; told once the n-grams are rows, where generated code does it."""
    return F.col(h).bitwiseAND(F.lit((1 << BITS) - 1).cast("long"))


def symbols(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[#*$%&|<>]")).cast("long")


def trusted(text: Column) -> Column:
    n = F.size("words")
    capitals = F.regexp_count(F.coalesce(text, F.lit("")), F.lit(rf"(?<!\S)\p{{Lu}}[^\x20\x09-\x0D\p{{Ll}}]+"))
    stutters = F.size(F.filter(F.zip_with(F.slice("h1", F.lit(1), F.greatest(n - 1, F.lit(0))), _next(F.col("h1"), 1), lambda a, b: a == b), lambda same: same))
    return (n >= TRUSTED["words"]) & (symbols(text) <= n * TRUSTED["symbols"]) & (capitals <= n * TRUSTED["capitals"]) & (stutters <= n * TRUSTED["stutters"])


def weights(corpus: DataFrame, text: str = "text", is_trusted: Column | None = None) -> DataFrame:
    """Of each of the 2**BITS bins, the log-likelihood ratio between the trusted documents of the corpus and all of them."""
    sides = hashed(corpus.select(F.col(text).alias("text"), *([is_trusted.alias("given")] if is_trusted is not None else [])), "text")
    sides = sides.select((F.col("given") if is_trusted is not None else trusted(F.col("text"))).cast("int").alias("good"), F.concat("h1", "h2").alias("grams"))
    # the outer form, as for the inner one the optimiser would ask first whether there are any, and split and hash each text several times for it
    counts = sides.select("good", F.explode_outer("grams").alias("gram")).where("gram is not null").select("good", bin_of("gram").alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("raw"), F.sum("good").alias("target"))
    every = cut(corpus.sparkSession.range(1 << BITS).select(F.col("id").alias("bin")).join(counts, "bin", "left").na.fill(0))
    raw, target = (every.agg(F.sum(side) + float(1 << BITS)).scalar() for side in ("raw", "target"))
    return every.select("bin", (F.log((F.col("target") + 1.0) / target) - F.log((F.col("raw") + 1.0) / raw)).alias("weight"))


def base(df: DataFrame, text: str) -> DataFrame:
    """df with the counts of the base rules, and h1 and h2."""
    t = F.coalesce(F.col(text), F.lit(""))
    df = hashed(df, text).withColumn("h4", _paired(F.col("h2"), 2)).withColumn("h8", _paired(F.col("h4"), 4))
    lines = F.filter(F.split(t, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    df = df.withColumn("lines", lines).withColumn("n_words", F.size("words").cast("long"))
    df = df.withColumn("word_chars", F.length(F.array_join("words", "")).cast("long")).withColumn("n_symbols", symbols(t))
    df = df.withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")).drop("lines", "words")
    # windows by hash and place; those beside an equal one are repeated; each covers WINDOW words, or as many as there are up to the next
    df = df.withColumn("places", F.when(F.size(F.array_distinct("h8")) < F.size("h8"), F.array_sort(F.transform("h8", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    last = F.lit(None).cast("struct<h:bigint,i:int>")
    before = F.concat(F.array(last), F.slice("places", F.lit(1), F.size("places") - 1))
    after = F.concat(_next(F.col("places"), 1), F.array(last))
    twice = F.filter(F.zip_with(F.zip_with(F.col("places"), before, lambda a, b: F.struct(a["i"].alias("i"), a["h"].alias("h"), (a["h"].eqNullSafe(b["h"])).alias("same"))), after, lambda a, b: F.when(a["same"] | a["h"].eqNullSafe(b["h"]), a["i"])), lambda i: i.isNotNull())
    df = df.withColumn("twice", F.when(F.col("places").isNotNull(), F.array_sort(twice)))
    gaps = F.zip_with(F.col("twice"), _next(F.col("twice"), 1), lambda a, b: F.when(b.isNull(), F.lit(WINDOW)).otherwise(F.least(b - a, F.lit(WINDOW))))
    covered = F.aggregate(gaps, F.lit(0), lambda acc, g: acc + g)
    return df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("h4", "h8", "places", "twice")


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge(docs: DataFrame, learned: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """docs without their text, with the counts of the base rules, base_failed, llr and kept, which replace namesakes. learned: what weights() gives."""
    others = [c for c in docs.columns if c not in (text, *COUNTS, "base_failed", "llr", "kept")]
    carried = docs.select(F.struct(*(F.col(f"`{c}`") for c in others), F.lit(0).alias("__none")).alias("doc"), F.col(f"`{text}`").cast("string").alias("text"))
    df = base(carried, "text").select("doc", *COUNTS, F.concat("h1", "h2").alias("grams"), F.monotonically_increasing_id().alias("row"))
    keys = ["row", "doc", *COUNTS]
    each = df.select(*keys, F.explode_outer("grams").alias("gram")).select(*keys, bin_of("gram").alias("bin")).join(F.broadcast(learned), "bin", "left")
    df = each.groupBy(*keys).agg(F.coalesce(F.avg("weight"), F.lit(0.0)).alias("llr"))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return df.select(*(F.col(f"doc.`{c}`") for c in others), *COUNTS, "llr", failed.alias("base_failed"), (~failed & (F.col("llr") >= threshold)).alias("kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge(docs, weights(docs)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "llr")
