"""Aggregations (A), filters over relations (P), orders (O), sets (U), vectors and graphs (G), evaluation (E), search and review (R)."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from turnwright.functions import text as t
from turnwright.operators import attribution, evaluate, graph, review, search, sequence, vectors
from turnwright.plans.base import TURNS_SQL, Plans, table, turns

plans = Plans()
add = plans.add


@add("a1_speaker_stats", f"WITH {TURNS_SQL} SELECT speaker, CAST(sum(\"end\" - start) AS BIGINT) AS total, count(*) AS n, floor(sum(\"end\" - start) / count(*) * 100 + 0.5) / 100 AS mean, floor(sum(\"end\" - start) * 10000 / sum(sum(\"end\" - start)) OVER () + 0.5) / 10000 AS share FROM turns GROUP BY speaker")
def a1(spark, sf):
    d = turns(spark, sf).withColumn("d", F.col("end") - F.col("start"))
    each = d.groupBy("speaker").agg(F.sum("d").alias("total"), F.count(F.lit(1)).alias("n"))
    whole = d.agg(F.sum("d")).scalar()
    return each.select("speaker", "total", "n", t.rounded(F.col("total") / F.col("n"), 2).alias("mean"), t.rounded(F.col("total") / whole, 4).alias("share"))


@add("a2_word_volume", "SELECT lang, CAST(sum(len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> ''))) AS BIGINT) AS words FROM documents GROUP BY lang ORDER BY words DESC")
def a2(spark, sf):
    return table(spark, sf, "documents").groupBy("lang").agg(F.sum(review.words_in(F.col("text"))).alias("words")).orderBy(F.col("words").desc(), "lang")


@add("a3_turns_per_speaker", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def a3(spark, sf):
    return table(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "event_type")


@add("a4_facets", "SELECT 'lang' AS facet, lang AS value, count(*) AS n FROM documents GROUP BY lang UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY source")
def a4(spark, sf):
    return search.facets(table(spark, sf, "documents"), ["lang", "source"])


@add("a5_conditional_counts", "SELECT user_id, count(*) FILTER (event_type = 'error') AS errors, count(*) FILTER (value < 10) AS small, count(DISTINCT event_type) AS kinds, floor(count(*) FILTER (event_type = 'error') * 10000 / count(*) + 0.5) / 10000 AS rate FROM events GROUP BY user_id")
def a5(spark, sf):
    error = F.count_if(F.col("event_type") == "error")
    return table(spark, sf, "events").groupBy("user_id").agg(error.alias("errors"), F.count_if(F.col("value") < 10).alias("small"), F.count_distinct("event_type").alias("kinds"), t.rounded(error / F.count(F.lit(1)), 4).alias("rate"))


@add("a7_vector_mean", "WITH x AS (SELECT label, unnest(range(len(embedding))) AS k, unnest(embedding)::DOUBLE AS m FROM embeddings) SELECT label, CAST(k AS INTEGER) AS k, floor(avg(m) * 1000000 + 0.5) AS micro FROM x GROUP BY label, k")
def a7(spark, sf):
    m = vectors.mean_vector(table(spark, sf, "embeddings"), ["label"], "embedding")
    return m.select("label", F.posexplode("embedding").alias("k", "m")).select("label", "k", F.floor(F.col("m") * 1000000 + 0.5).cast("double").alias("micro"))


def cut_texts(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "source", t.tokens(F.col("text")).alias("terms"))


def tokens(spark, sf):
    # the outer form, as for the inner one the optimiser would ask first whether there are any tokens, and cut each text twice
    each = F.explode_outer(t.tokens(F.col("text"))).alias("term")
    return table(spark, sf, "documents").select("doc_id", "source", each).where("term is not null")


_STOP = ", ".join(f"'{w}'" for w in t.STOP_WORDS)
TOKENS_SQL = f"tok AS (SELECT doc_id, source, unnest(list_filter(string_split(trim(regexp_replace(regexp_replace(lower(text), '[^a-z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g')), ' '), lambda w: length(w) > 2 AND w NOT IN ({_STOP}))) AS term FROM documents)"
TFIDF_SQL = f"{TOKENS_SQL}, c AS (SELECT doc_id, source, term, count(*) AS c FROM tok GROUP BY ALL), m AS (SELECT doc_id, count(*) AS m FROM c GROUP BY doc_id), df AS (SELECT term, count(*) AS df FROM c GROUP BY term), n AS (SELECT count(DISTINCT doc_id) AS n FROM tok), w AS (SELECT c.doc_id, source, c.term, c / m * (ln((n + 1.0) / (df + 1.0)) + 1.0) AS weight FROM c JOIN m USING (doc_id) JOIN df USING (term), n)"


@add("a8_sparse_mean", f"WITH {TFIDF_SQL}, k AS (SELECT source, count(DISTINCT doc_id) AS k FROM w GROUP BY source) SELECT source, term, floor(sum(weight) / any_value(k) * 1000000 + 0.5) AS micro FROM w JOIN k USING (source) GROUP BY source, term")
def a8(spark, sf):
    m = vectors.sparse_means(vectors.tf_idf(cut_texts(spark, sf), ["doc_id", "source"], "terms"), "source", "doc_id")
    return m.select("source", "term", F.floor(F.col("m") * 1000000 + 0.5).cast("double").alias("micro"))


@add("a10_majority", "WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) AS k, sum(n) OVER (PARTITION BY user_id) AS t FROM c) SELECT user_id, event_type, floor(n * 1000 / t + 0.5) / 1000 AS confidence FROM r WHERE k = 1")
def a10(spark, sf):
    c = table(spark, sf, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    best = c.groupBy("user_id").agg(F.min_by(F.struct("event_type", "n"), F.struct((-F.col("n")).alias("n"), "event_type")).alias("b"), F.sum("n").alias("t"))
    return best.select("user_id", "b.event_type", (F.floor(F.col("b.n") * 1000 / F.col("t") + 0.5) / 1000).alias("confidence"))


@add("a11_rollup", "SELECT lang, source, count(*) AS n, CAST(sum(quality) AS BIGINT) AS good FROM documents JOIN labels USING (doc_id) GROUP BY ROLLUP (lang, source)")
def a11(spark, sf):
    return table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").rollup("lang", "source").agg(F.count(F.lit(1)).alias("n"), F.sum("quality").alias("good"))


@add("a12_span", f"WITH {TURNS_SQL} SELECT meeting_id, max(\"end\") - min(start) AS span FROM turns GROUP BY meeting_id")
def a12(spark, sf):
    return turns(spark, sf).groupBy("meeting_id").agg((F.max("end") - F.min("start")).alias("span"))


@add("a13_document_frequency", f"WITH {TOKENS_SQL} SELECT term, count(DISTINCT doc_id) AS df FROM tok GROUP BY term HAVING count(DISTINCT doc_id) >= 2")
def a13(spark, sf):
    d = table(spark, sf, "documents").where("doc_id is not null")
    once = d.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
    # the outer form, as for the inner one the optimiser would ask first whether there are any terms, and cut each text twice
    each = d.select("doc_id", F.explode_outer(F.array_distinct(t.tokens(F.col("text")))).alias("term")).where("term is not null")
    each = each if once else each.distinct()
    return each.groupBy("term").agg(F.count(F.lit(1)).alias("df")).where("df >= 2")


@add("a14_group_arrays", "SELECT user_id, array_to_string(list(event_id ORDER BY value DESC, event_id), ',') AS ids FROM events GROUP BY user_id")
def a14(spark, sf):
    rows = F.array_sort(F.collect_list(F.struct((-F.col("value")).alias("v"), "event_id")))
    return table(spark, sf, "events").groupBy("user_id").agg(F.array_join(F.transform(rows, lambda r: r["event_id"].cast("string")), ",").alias("ids"))


@add("a15_argmax_row", "SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY value DESC, event_id) AS n FROM events) WHERE n = 1")
def a15(spark, sf):
    best = F.min_by(F.struct("event_id", "value"), F.struct((-F.col("value")).alias("v"), "event_id")).alias("b")
    return table(spark, sf, "events").groupBy("user_id", "event_type").agg(best).select("user_id", "event_type", "b.*")


@add("a16_macro_wer")
def a16(spark, sf):
    d = evaluate.with_next(table(spark, sf, "documents").select("doc_id", "lang", evaluate.packed("text").alias("ref")), "doc_id", "ref", "hyp")
    return d.groupBy("lang").agg(t.rounded(F.avg(evaluate.wer("ref", "hyp")), 4).alias("wer"), F.count(F.lit(1)).alias("n"))


@add("a17_duration", f"WITH {TURNS_SQL} SELECT meeting_id, greatest(arg_max(\"end\", pos), 2000000) AS duration FROM turns GROUP BY meeting_id")
def a17(spark, sf):
    return turns(spark, sf).groupBy("meeting_id").agg(F.greatest(F.max_by("end", "pos"), F.lit(2_000_000)).alias("duration"))


@add("a18_support", "WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL), b AS (SELECT user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) AS k FROM c) WHERE k = 1) SELECT user_id, count(*) AS support FROM events JOIN b USING (user_id, event_type) GROUP BY user_id")
def a18(spark, sf):
    c = table(spark, sf, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    best = c.groupBy("user_id").agg(F.min_by("event_type", F.struct((-F.col("n")).alias("n"), "event_type")).alias("event_type"))
    return table(spark, sf, "events").join(best, ["user_id", "event_type"]).groupBy("user_id").agg(F.count(F.lit(1)).alias("support"))


@add("a19_ordered_strings", "SELECT conv_id, string_agg(text, chr(10) || chr(10) ORDER BY turn) AS text FROM conversations GROUP BY conv_id")
def a19(spark, sf):
    rows = F.array_sort(F.collect_list(F.struct("turn", "text")))
    return table(spark, sf, "conversations").groupBy("conv_id").agg(F.array_join(F.transform(rows, lambda r: r["text"]), "\n\n").alias("text"))


_CENT = "v AS (SELECT label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings), x AS (SELECT label, unnest(range(len(e))) AS k, unnest(e) AS m FROM v), y AS (SELECT label, k, avg(m) AS m FROM x GROUP BY label, k), c AS (SELECT label, list(m ORDER BY k) AS e FROM y GROUP BY label)"
_COS = "list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e)))"


@add("a20_pairwise_matrix", f"WITH {_CENT} SELECT a.label AS a, b.label AS b, floor({_COS} * 1000000 + 0.5) / 1000000 AS sim FROM c a JOIN c b ON a.label < b.label")
def a20(spark, sf):
    c = vectors.mean_vector(table(spark, sf, "embeddings"), ["label"], "embedding").select("label", "embedding", F.col("label").alias("own"))
    return vectors.similar_pairs(c, "label", "embedding", "own", -2.0).select("a", "b", t.rounded(F.col("sim"), 6).alias("sim"))


@add("a21_speakers_per_window", f"WITH {TURNS_SQL}, w AS (SELECT meeting_id, unnest(range(start // 86400, \"end\" // 86400 + 1)) AS day, speaker FROM turns) SELECT meeting_id, day, count(DISTINCT speaker) AS speakers FROM w GROUP BY ALL HAVING count(DISTINCT speaker) >= 3")
def a21(spark, sf):
    day = F.explode(F.sequence(F.floor(F.col("start") / 86400), F.floor(F.col("end") / 86400)))
    return turns(spark, sf).select("meeting_id", day.alias("day"), "speaker").groupBy("meeting_id", "day").agg(F.count_distinct("speaker").alias("speakers")).where("speakers >= 3")


@add("a22_corpus_stats", "SELECT conv_id, arg_max(role, turn) AS last_role, CAST(sum(length(text)) AS BIGINT) AS n_chars, string_agg(text, ' ' ORDER BY turn) AS text FROM conversations GROUP BY conv_id")
def a22(spark, sf):
    """Parts of one recording put together: the last role, the whole size, and all texts in order."""
    rows = F.array_sort(F.collect_list(F.struct("turn", "text")))
    return table(spark, sf, "conversations").groupBy("conv_id").agg(F.max_by("role", "turn").alias("last_role"), F.sum(F.length("text")).cast("long").alias("n_chars"), F.array_join(F.transform(rows, lambda r: r["text"]), " ").alias("text"))


# filters
@add("p10_batch_eligibility", "SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F' AND o_totalprice > 1000 AND regexp_matches(strftime(o_orderdate, '%Y-%m-%d'), '^\\d{4}-\\d{2}-\\d{2}$')")
def p10(spark, sf):
    iso = F.rlike(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(r"^\d{4}-\d{2}-\d{2}$"))
    return table(spark, sf, "orders").where((F.col("o_orderstatus") != "F") & (F.col("o_totalprice") > 1000) & iso).select("o_orderkey")


@add("p12_vote_evidence", "SELECT event_id FROM events WHERE event_type IN ('view', 'click', 'purchase', 'signup') AND value >= 2.0 AND length(props) >= 8 AND NOT regexp_full_match(lower(event_type), 'aye|nay|no|yes')")
def p12(spark, sf):
    e = table(spark, sf, "events")
    return e.where(F.col("event_type").isin("view", "click", "purchase", "signup") & (F.col("value") >= 2.0) & (F.length("props") >= 8) & ~F.rlike(F.lower("event_type"), F.lit("^(aye|nay|no|yes)$"))).select("event_id")


@add("p13_half_open", "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-02' AND ts < TIMESTAMP '2024-01-09'")
def p13(spark, sf):
    return table(spark, sf, "events").where("ts >= TIMESTAMP_NTZ '2024-01-02 00:00:00' AND ts < TIMESTAMP_NTZ '2024-01-09 00:00:00'").select("event_id")


@add("p14_min_duration", f"WITH {TURNS_SQL} SELECT speaker, CAST(sum(\"end\" - start) AS BIGINT) AS total, count(*) FILTER (\"end\" - start >= 90000) AS long FROM turns GROUP BY speaker")
def p14(spark, sf):
    d = F.col("end") - F.col("start")
    return turns(spark, sf).groupBy("speaker").agg(F.sum(d).alias("total"), F.count_if(d >= 90000).alias("long"))


@add("p15_search", "SELECT doc_id, CASE WHEN contains(lower(text), 'the and') THEN 500 + greatest(0, 200 - least(200, CAST(strpos(lower(text), 'the and') AS INTEGER) - 1)) ELSE 0 END + 80 AS score FROM documents WHERE lang = 'en' AND (contains(lower(text), 'the and') OR (contains(lower(text), 'the') AND contains(lower(text), 'and')))")
def p15(spark, sf):
    d = table(spark, sf, "documents").withColumns({"speaker": F.col("lang"), "meeting_date": F.lit("2024-01-01").cast("date"), "start": F.col("doc_id")})
    return search.search(d, search.Request("the and", speaker="en", per_meeting=10**9), meeting="source").select("doc_id", "score")


@add("o2_o6_search_grouped", "WITH h AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY CASE WHEN contains(lower(text), 'ing') THEN 540 + greatest(0, 200 - least(200, CAST(strpos(lower(text), 'ing') AS INTEGER) - 1)) ELSE 0 END DESC, doc_id, text) AS n FROM documents WHERE contains(lower(text), 'ing')) SELECT source, count(*) AS n, array_to_string(list(doc_id ORDER BY n), ',') AS docs FROM h WHERE n <= 3 GROUP BY source")
def o2(spark, sf):
    d = table(spark, sf, "documents").withColumns({"meeting_date": F.lit("2024-01-01").cast("date"), "start": F.col("doc_id")})
    hits = search.search(d, search.Request("ing", per_meeting=3), meeting="source")
    return search.grouped(hits, "source", ("start",)).select("source", "n", F.array_join(F.transform("hits", lambda h: h["start"].cast("string")), ",").alias("docs"))


@add("p16_page_filter", "SELECT doc_id FROM documents WHERE lang = 'fr' AND source = 'src1' AND contains(lower(text), 'le') AND lang <> 'Unknown Speaker'")
def p16(spark, sf):
    d = table(spark, sf, "documents").withColumns({"speaker": F.col("lang"), "section": F.col("source")})
    return search.page_filter(d, "fr", "src1", "LE", True).select("doc_id")


@add("p21_required_fields", "SELECT c_custkey, 'c_name' AS field FROM customer WHERE c_name IS NULL OR c_name = '' UNION ALL SELECT c_custkey, 'c_mktsegment' FROM customer WHERE c_mktsegment IS NULL OR c_mktsegment IN ('', 'BUILDING')")
def p21(spark, sf):
    from turnwright.sinks.publish import violations

    c = table(spark, sf, "customer").withColumn("c_mktsegment", F.nullif("c_mktsegment", F.lit("BUILDING")))
    return violations(c, "c_custkey", ["c_name", "c_mktsegment"])


@add("p23_fusion_priority", "SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'Approved' WHEN contains(text, 'view') THEN 'Chair' WHEN contains(text, 'k\": 1') THEN 'Staff' ELSE text END AS label FROM (SELECT event_id, event_type || ' ' || props AS text FROM events)")
def p23(spark, sf):
    e = turns(spark, sf)
    return e.select("event_id", F.coalesce(F.when(F.col("event_id") % 7 == 0, "Approved"), F.when(F.contains("text", F.lit("view")), "Chair"), F.when(F.contains("text", F.lit('k": 1')), "Staff"), "text").alias("label"))


@add("p24_verified_label", f"WITH {TURNS_SQL}, f AS (SELECT meeting_id, speaker, row_number() OVER (PARTITION BY meeting_id ORDER BY min(pos), speaker) AS n FROM turns WHERE speaker NOT IN ('view', 'error') GROUP BY meeting_id, speaker) SELECT event_id, CASE WHEN speaker = 'view' THEN 'Ada Moss' WHEN speaker = 'error' THEN 'UNKNOWN' ELSE printf('Speaker %02d', n) END AS label FROM turns LEFT JOIN f USING (meeting_id, speaker)")
def p24(spark, sf):
    from turnwright.operators.sequence import first_seen

    e = turns(spark, sf)
    fixed = e.where("speaker IN ('view', 'error')").select("event_id", F.when(F.col("speaker") == "view", "Ada Moss").otherwise("UNKNOWN").alias("label"))
    rest = first_seen(e.where("speaker NOT IN ('view', 'error')"), ["meeting_id"], "speaker", "pos")
    return fixed.union(rest.select("event_id", F.format_string("Speaker %02d", "number").alias("label")))


@add("p25_named_rate", "SELECT user_id, floor(avg(CASE WHEN event_type NOT IN ('error', 'view') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 10000 + 0.5) / 10000 AS rate FROM events GROUP BY user_id")
def p25(spark, sf):
    return table(spark, sf, "events").groupBy("user_id").agg(t.rounded(F.avg(F.when(F.col("event_type").isin("error", "view"), 0.0).otherwise(1.0)), 4).alias("rate"))


@add("p27_metadata_defaults", "SELECT o_orderkey, 'm' || o_orderkey AS meeting_id, coalesce(nullif(o_orderpriority, '1-URGENT'), 'regular') AS meeting_type, 'transcripts/m' || o_orderkey || '.json' AS turns_path FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_orderkey)")
def p27(spark, sf):
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    new = o.join(c, o["o_orderkey"] == c["c_custkey"], "left_anti")
    return new.select("o_orderkey", F.concat(F.lit("m"), "o_orderkey").alias("meeting_id"), F.coalesce(F.nullif("o_orderpriority", F.lit("1-URGENT")), F.lit("regular")).alias("meeting_type"), F.concat(F.lit("transcripts/m"), "o_orderkey", F.lit(".json")).alias("turns_path"))


@add("p28_hybrid_priority", "SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN c_name WHEN c_custkey % 3 = 0 THEN 'Ada Moss' ELSE 'Unknown' END AS speaker FROM customer ORDER BY c_custkey")
def p28(spark, sf):
    says = F.when(F.col("c_custkey") % 3 == 0, "my name is Ada Moss").otherwise("hello")
    return table(spark, sf, "customer").select("c_custkey", F.coalesce(F.when(F.col("c_custkey") % 5 == 0, F.col("c_name")), t.self_intro(says), F.lit("Unknown")).alias("speaker")).orderBy("c_custkey")


# orders and limits
@add("o1_newest_first", "SELECT o_orderkey, o_orderdate, row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey DESC) AS place FROM orders")
def o1(spark, sf):
    return sequence.places(table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])


@add("o3_top_talkers", f"WITH {TURNS_SQL} SELECT meeting_id, CAST(sum(\"end\" - start) AS BIGINT) AS total FROM turns GROUP BY meeting_id ORDER BY total DESC, meeting_id LIMIT 12")
def o3(spark, sf):
    return turns(spark, sf).groupBy("meeting_id").agg(F.sum(F.col("end") - F.col("start")).alias("total")).orderBy(F.col("total").desc(), "meeting_id").limit(12)


@add("o4_longest_clips", f"WITH {TURNS_SQL} SELECT meeting_id, event_id FROM turns QUALIFY row_number() OVER (PARTITION BY meeting_id ORDER BY \"end\" - start DESC, event_id) <= 4")
def o4(spark, sf):
    w = W.partitionBy("meeting_id").orderBy((F.col("end") - F.col("start")).desc(), "event_id")
    return turns(spark, sf).withColumn("n", F.row_number().over(w)).where("n <= 4").select("meeting_id", "event_id")


@add("o5_best_matches", "WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings), s AS (SELECT a.vec_id AS query, b.vec_id, list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) AS s FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id) SELECT query, vec_id, row_number() OVER (PARTITION BY query ORDER BY s DESC, vec_id) AS place FROM s QUALIFY place <= 10")
def o5(spark, sf):
    """The ten best of all vectors for each one whose id is divisible by 50."""
    e = table(spark, sf, "embeddings").select("vec_id", "embedding")
    return vectors.top_matches(e.where("vec_id % 50 = 0"), e, "vec_id", "embedding", 10).select("query", "vec_id", F.col("place").cast("long").alias("place"))


@add("o7_composite_order", "SELECT event_id, row_number() OVER (ORDER BY event_type, value DESC, ts, event_id) AS place FROM events")
def o7(spark, sf):
    order = ["event_type", F.col("value").desc(), "ts", "event_id"]
    return sequence.places(table(spark, sf, "events").select("event_id", "event_type", "value", "ts"), order).select("event_id", "place")


# sets
@add("u2_union_distinct", "SELECT n_name AS name FROM nation UNION SELECT r_name FROM region")
def u2(spark, sf):
    return table(spark, sf, "nation").select(F.col("n_name").alias("name")).union(table(spark, sf, "region").select("r_name")).distinct()


@add("u3_intersection", "SELECT o_custkey AS k FROM orders INTERSECT SELECT c_custkey FROM customer WHERE c_nationkey < 10")
def u3(spark, sf):
    return table(spark, sf, "orders").select(F.col("o_custkey").alias("k")).intersect(table(spark, sf, "customer").where("c_nationkey < 10").select("c_custkey"))


@add("u5_difference", "SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders")
def u5(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("k")).subtract(table(spark, sf, "orders").select("o_custkey"))


@add("u6_union_all", "SELECT n_nationkey AS id, n_name AS name FROM nation UNION ALL SELECT r_regionkey, r_name FROM region")
def u6(spark, sf):
    n = table(spark, sf, "nation").select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name"))
    return n.unionByName(table(spark, sf, "region").select(F.col("r_regionkey").cast("long").alias("id"), F.col("r_name").alias("name")))


# vectors and graphs
@add("f39_tf_idf", f"WITH {TFIDF_SQL} SELECT doc_id, term, floor(weight * 1000000 + 0.5) AS micro FROM w")
def f39(spark, sf):
    return vectors.tf_idf(cut_texts(spark, sf), ["doc_id"], "terms").select("doc_id", "term", F.floor(F.col("weight") * 1000000 + 0.5).cast("double").alias("micro"))


@add("f40_cosine", "WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings) SELECT a.vec_id, floor(list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) * 1000000 + 0.5) AS micro FROM v a JOIN v b ON b.vec_id = a.vec_id + 1")
def f40(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", "embedding")
    nxt = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return e.join(nxt, "vec_id").select("vec_id", F.floor(vectors.cosine("embedding", "other") * 1000000 + 0.5).cast("double").alias("micro"))


_EDGES = "v AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings), ed AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id < b.vec_id AND a.label <> b.label WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.38), bth AS (SELECT a, b FROM ed UNION SELECT b, a FROM ed)"


def edges(spark, sf, forest=False):
    return vectors.similar_pairs(table(spark, sf, "embeddings"), "vec_id", "embedding", "label", 0.38, forest=forest)


@add("g1_similarity_graph", f"WITH {_EDGES} SELECT a, b FROM bth")
def g1(spark, sf):
    either = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    return edges(spark, sf).select(F.inline(either))


@add("g2_components", f"WITH RECURSIVE {_EDGES}, r AS (SELECT a AS node, a AS root FROM bth UNION SELECT bth.b, r.root FROM r JOIN bth ON bth.a = r.node) SELECT node, min(root) AS root FROM r GROUP BY node")
def g2(spark, sf):
    return graph.components(edges(spark, sf, forest=True)).select("node", "root")


@add("g4_cluster_count", "SELECT user_id, CASE WHEN count(*) <= 9 THEN count(*) ELSE least(count(*), greatest(9, CAST(ceil(count(*) / 2) AS BIGINT))) END AS k FROM events GROUP BY user_id")
def g4(spark, sf):
    return table(spark, sf, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).select("user_id", vectors.cluster_count(F.col("n")).alias("k"))


@add("g5_speech_features", f"WITH {TURNS_SQL} SELECT speaker, array_to_string([CAST(sum(\"end\" - start) AS BIGINT), count(*), max(\"end\" - start), min(\"end\" - start)], ',') AS features FROM turns GROUP BY speaker")
def g5(spark, sf):
    d = F.col("end") - F.col("start")
    return turns(spark, sf).groupBy("speaker").agg(F.array_join(F.array(F.sum(d), F.count(F.lit(1)), F.max(d), F.min(d)).cast("array<string>"), ",").alias("features"))


@add("g3_average_linkage")
def g3(spark, sf):
    return vectors.linkage(table(spark, sf, "embeddings"), "vec_id", "embedding", "label", 0.3)


@add("g6_component_assign", f"WITH RECURSIVE {_EDGES}, r AS (SELECT a AS node, a AS root FROM bth UNION SELECT bth.b, r.root FROM r JOIN bth ON bth.a = r.node), c AS (SELECT node, min(root) AS root FROM r GROUP BY node), k AS (SELECT root FROM c GROUP BY root HAVING count(*) >= 3) SELECT vec_id, CASE WHEN k.root IS NULL THEN 'SINGLE_' || vec_id ELSE 'CLUSTER_' || k.root END AS cluster FROM embeddings LEFT JOIN c ON vec_id = node LEFT JOIN k ON c.root = k.root")
def g6(spark, sf):
    c = graph.components(edges(spark, sf, forest=True))
    big = c.groupBy("root").agg(F.count(F.lit(1)).alias("n")).where("n >= 3").select("root")
    named = c.join(big, "root").select(F.col("node").alias("vec_id"), F.concat(F.lit("CLUSTER_"), "root").alias("cluster"))
    return table(spark, sf, "embeddings").select("vec_id").join(named, "vec_id", "left").select("vec_id", F.coalesce("cluster", F.concat(F.lit("SINGLE_"), "vec_id")).alias("cluster"))


@add("g7_cluster_remap", f"WITH RECURSIVE {_EDGES}, r AS (SELECT a AS node, a AS root FROM bth UNION SELECT bth.b, r.root FROM r JOIN bth ON bth.a = r.node), c AS (SELECT node, min(root) AS root FROM r GROUP BY node), l AS (SELECT root, label, count(*) AS n FROM c JOIN embeddings ON node = vec_id GROUP BY ALL), d AS (SELECT root, label FROM l QUALIFY row_number() OVER (PARTITION BY root ORDER BY n DESC, label) = 1) SELECT vec_id, coalesce(d.label, e.label) AS label FROM embeddings e LEFT JOIN c ON vec_id = node LEFT JOIN d ON c.root = d.root")
def g7(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", "label")
    c = graph.components(edges(spark, sf, forest=True)).withColumnRenamed("node", "vec_id")
    main = c.join(e, "vec_id").groupBy("root", "label").agg(F.count(F.lit(1)).alias("n")).groupBy("root").agg(F.min_by("label", F.struct((-F.col("n")).alias("n"), "label")).alias("main"))
    return e.join(c.join(main, "root"), "vec_id", "left").select("vec_id", F.coalesce("main", "label").alias("label"))


@add("g8_attribution", f"WITH {TFIDF_SQL}, k AS (SELECT source, count(DISTINCT doc_id) AS k FROM w GROUP BY source), ce AS (SELECT source, term, sum(weight) / any_value(k) AS m FROM w JOIN k USING (source) GROUP BY source, term), cn AS (SELECT source, sqrt(sum(m * m)) AS n FROM ce GROUP BY source), dn AS (SELECT doc_id, sqrt(sum(weight * weight)) AS n FROM w GROUP BY doc_id), s AS (SELECT w.doc_id, ce.source, sum(weight * ce.m) / any_value(cn.n) / any_value(dn.n) AS s FROM w JOIN ce USING (term) JOIN cn ON ce.source = cn.source JOIN dn ON dn.doc_id = w.doc_id GROUP BY w.doc_id, ce.source) SELECT doc_id, source AS best FROM s QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY floor(s * 1000000000), source DESC) = count(*) OVER (PARTITION BY doc_id)")
def g8(spark, sf):
    """Documents attributed to the source whose mean TF-IDF vector is most alike."""
    best = attribution.attributed(table(spark, sf, "documents"), "doc_id", "source", "text", 1_000_000_000)
    return best.select("doc_id", F.col("source").alias("best"))


# evaluation
def pairs(spark, sf):
    d = table(spark, sf, "documents")
    found = F.when(d["doc_id"] % 11 == 0, "Unknown Speaker").when(d["doc_id"] % 13 == 0, F.lit(None).cast("string")).when(d["doc_id"] % 3 == 0, "xx").otherwise(F.col("lang"))
    gold = F.when(d["doc_id"] % 17 == 0, "Unknown Speaker").otherwise(F.col("lang"))
    return evaluate.outcomes(d.select("source", gold.alias("gold"), found.alias("found")))


_OUT = "o AS (SELECT source, CASE WHEN f IS NULL THEN 'none' WHEN g = 'Unknown Speaker' AND f = 'Unknown Speaker' THEN 'unknown' WHEN g = 'Unknown Speaker' THEN 'named' WHEN f = 'Unknown Speaker' THEN 'missed' WHEN g = f THEN 'match' ELSE 'wrong' END AS o FROM (SELECT source, CASE WHEN doc_id % 17 = 0 THEN 'Unknown Speaker' ELSE lang END AS g, CASE WHEN doc_id % 11 = 0 THEN 'Unknown Speaker' WHEN doc_id % 13 = 0 THEN NULL WHEN doc_id % 3 = 0 THEN 'xx' ELSE lang END AS f FROM documents))"
for _name, _wrong, _missed in (("E2", "o = 'wrong'", "o = 'missed'"), ("E3", "o IN ('wrong', 'missed')", "o = 'missed'"), ("E4", "o = 'wrong'", "o = 'missed'"), ("E5", "o = 'wrong'", "o IN ('missed', 'named')")):
    _whole = "matches + wrong" + ("" if _name == "E3" else " + missed")
    plans.sql[f"{_name.lower()}_evaluation"] = f"WITH {_OUT}, r AS (SELECT source, count(*) AS n, count(*) FILTER (o = 'match') AS matches, count(*) FILTER ({_wrong}) AS wrong, count(*) FILTER ({_missed}) AS missed FROM o GROUP BY ROLLUP (source)) SELECT *, CASE WHEN {_whole} > 0 THEN matches / ({_whole}) END AS rate FROM r"
    plans.queries[f"{_name.lower()}_evaluation"] = lambda spark, sf, kind=_name: evaluate.report(pairs(spark, sf), "source", kind)


@add("e1_gold_creation", f"WITH {TURNS_SQL}, x AS (SELECT n_nationkey AS excerpt_id, n_nationkey * 86400 AS a, n_nationkey * 86400 + 43200 AS b FROM nation) SELECT excerpt_id, count(*) AS n_turns, array_to_string(list(event_id ORDER BY start, event_id), ',') AS turns FROM turns JOIN x ON start >= a AND start < b GROUP BY excerpt_id")
def e1(spark, sf):
    from turnwright.operators.temporal import stab

    x = table(spark, sf, "nation").select(F.col("n_nationkey").alias("excerpt_id"), (F.col("n_nationkey") * 86400).alias("start"), (F.col("n_nationkey") * 86400 + 43200).alias("end"), F.lit(1).alias("k"))
    p = turns(spark, sf).select("event_id", F.col("start").alias("t"), F.lit(1).alias("k"))
    rows = F.array_sort(F.collect_list(F.struct("t", "event_id")))
    return stab(p, x, ["k"], width=43200).groupBy("excerpt_id").agg(F.count(F.lit(1)).alias("n_turns"), F.array_join(F.transform(rows, lambda r: r["event_id"].cast("string")), ",").alias("turns"))


@add("e6_verdict", "SELECT event_id, CASE WHEN event_id % 5 < event_id % 7 AND value >= 30 THEN 'READY' ELSE 'NOT_READY' END AS verdict FROM events")
def e6(spark, sf):
    return table(spark, sf, "events").select("event_id", evaluate.verdict(F.col("event_id") % 7, F.col("event_id") % 5, F.lit(30.0), F.col("value")).alias("verdict"))


@add("e7_parameter_sweep", f"WITH {TURNS_SQL}, g AS (SELECT unnest([3600, 14400, 86400]) AS gap), b AS (SELECT gap, CASE WHEN lag(speaker) OVER w = speaker AND start - lag(\"end\") OVER w <= gap THEN 0 ELSE 1 END AS new FROM turns, g WINDOW w AS (PARTITION BY gap, meeting_id ORDER BY pos)) SELECT gap, CAST(sum(new) AS BIGINT) AS blocks FROM b GROUP BY gap")
def e7(spark, sf):
    w = W.partitionBy("gap", "meeting_id").orderBy("pos")
    df = turns(spark, sf).withColumn("gap", F.explode(F.array(*(F.lit(g) for g in (3600, 14400, 86400)))))
    same = (F.lag("speaker").over(w) == F.col("speaker")) & (F.col("start") - F.lag("end").over(w) <= F.col("gap"))
    return df.select("gap", F.when(same, 0).otherwise(1).alias("new")).groupBy("gap").agg(F.sum("new").alias("blocks"))


# review
def reviewed(spark, sf):
    e = turns(spark, sf)
    return e.select("meeting_id", F.format_string("turn_%06d", "pos").alias("turn_id"), "pos", F.col("speaker"), F.col("speaker").alias("speaker_public"), F.when(F.col("speaker") == "error", "unknown").otherwise("approved").alias("speaker_status"), F.when(F.col("value") < 5, F.lit(True)).alias("needs_review"), F.lit(None).cast("string").alias("review_reason"), F.concat_ws(" ", "text", F.when(F.col("event_id") % 3 == 0, "some more words")).alias("text"), "event_id", "value")


_REV = f"{TURNS_SQL}, r AS (SELECT meeting_id, event_id, pos, printf('turn_%06d', pos) AS turn_id, speaker, value, CASE WHEN speaker = 'error' THEN 'unknown' ELSE 'approved' END AS status, text || CASE WHEN event_id % 3 = 0 THEN ' some more words' ELSE '' END AS text FROM turns)"


@add("r1_review_queue", f"WITH {_REV}, c AS (SELECT *, array_to_string(list(turn_id) OVER (PARTITION BY meeting_id ORDER BY pos ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING), ',') AS around, len(string_split(text, ' ')) AS n FROM r) SELECT event_id, CAST(n AS BIGINT) AS word_count, around FROM c WHERE value < 5 OR n <= 3")
def r1(spark, sf):
    q = review.queue(reviewed(spark, sf), ["meeting_id"], ["pos"])
    return q.select("event_id", "word_count", F.array_join(F.transform("context", lambda x: x["turn_id"]), ",").alias("around"))


@add("r2_template", f"WITH {_REV} SELECT meeting_id, turn_id, 'pending' AS reviewer_action, '' AS speaker_public_override, '' AS text_override, false AS suppress, '' AS evidence_note FROM r WHERE value < 5")
def r2(spark, sf):
    return review.template(reviewed(spark, sf).where("value < 5"))


def decisions(spark, sf):
    e = reviewed(spark, sf).where("event_id % 4 = 0")
    act = F.when(F.col("event_id") % 8 == 0, "suppress").when(F.col("speaker") == "view", "keep_unknown").otherwise("approve")
    return e.select("meeting_id", "turn_id", "event_id", act.alias("reviewer_action"), F.when(F.col("speaker") == "click", "Ben Ito").otherwise("").alias("speaker_public_override"), F.when(F.col("speaker") == "click", "Ben Ito").otherwise("").alias("speaker_name"), F.lit("").alias("text_override"), (F.col("event_id") % 8 == 0).alias("suppress"), F.lit("seen").alias("evidence_note"))


_ACT = "CASE WHEN event_id % 8 = 0 THEN 'suppress' WHEN speaker = 'view' THEN 'keep_unknown' ELSE 'approve' END"


@add("r3_audit", f"WITH {_REV} SELECT turn_id, meeting_id, 'b1' AS export_batch_id, sha256(meeting_id || '|' || turn_id || '|' || {_ACT}) AS decision_id FROM r WHERE event_id % 4 = 0")
def r3(spark, sf):
    return review.audit(decisions(spark, sf), "b1", "2024-02-01 00:00:00").select("turn_id", "meeting_id", "export_batch_id", "decision_id")


@add("r4_apply_decisions", f"WITH {_REV} SELECT event_id, CASE WHEN event_id % 8 = 0 THEN 'REDACTED' WHEN event_id % 4 = 0 AND speaker = 'click' THEN 'Ben Ito' ELSE speaker END AS speaker_public, CASE WHEN event_id % 8 = 0 THEN '[REDACTED]' ELSE text END AS text, CASE WHEN event_id % 4 = 0 THEN 'reviewed:' || {_ACT} || ' | seen' END AS review_reason FROM r")
def r4(spark, sf):
    d = decisions(spark, sf)
    once = review.apply(reviewed(spark, sf), d, ["meeting_id", "turn_id"], ["event_id"])
    return once.select("event_id", "speaker_public", "text", "review_reason")


@add("r5_apply_edge", f"WITH {_REV} SELECT event_id, CASE WHEN event_id % 8 = 0 THEN 'SUPPRESSED' WHEN event_id % 4 = 0 AND speaker = 'click' THEN 'Ben Ito' ELSE speaker END AS speaker, text || CASE WHEN event_id % 8 = 4 AND speaker = 'view' THEN ' [unknown]' ELSE '' END AS text FROM r")
def r5(spark, sf):
    return review.apply_edge(reviewed(spark, sf), decisions(spark, sf), ["meeting_id", "turn_id"], ["event_id"]).select("event_id", "speaker", "text")


@add("r7_vote_summary", "SELECT o_orderkey, o_orderstatus = 'F' AND o_custkey % 3 = 0 AS unanimous, CASE o_orderstatus WHEN 'F' THEN CASE WHEN o_custkey % 3 = 0 THEN 'passed unanimously' ELSE 'passed' END WHEN 'O' THEN 'failed' ELSE 'no action' END AS badge FROM orders")
def r7(spark, sf):
    result = F.when(F.col("o_orderstatus") == "F", "PASSED").when(F.col("o_orderstatus") == "O", "FAILED").otherwise("NO_ACTION")
    against = F.when(F.col("o_custkey") % 3 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("Ben Ito")))
    return review.vote_summary(table(spark, sf, "orders").select("o_orderkey", result.alias("result"), against.alias("opposed"))).select("o_orderkey", "unanimous", "badge")


@add("r8_highlights", "WITH t AS (SELECT user_id, event_type, count(*) % 2 AS odd, min(event_id) AS first FROM events GROUP BY ALL) SELECT user_id, event_type, first FROM t WHERE odd = 1")
def r8(spark, sf):
    """Highlights toggled by id: on after an odd number of toggles; sorted by their place."""
    e = table(spark, sf, "events").groupBy("user_id", "event_type").agg((F.count(F.lit(1)) % 2).alias("odd"), F.min("event_id").alias("first"))
    return e.where("odd = 1").select("user_id", "event_type", "first").orderBy("first")
