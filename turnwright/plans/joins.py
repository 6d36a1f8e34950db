"""Joins (J), resolving (A6, U1, U4, W16) and overrides, over events as points and intervals."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnwright.operators import resolve, temporal
from turnwright.operators.vectors import cosine, mean_vector
from turnwright.plans.base import SECONDS_SQL, TURNS_SQL, Plans, seconds, table, turns

plans = Plans()
INTERVAL = ("view", "purchase")
END_SQL = f'{SECONDS_SQL} + CAST(floor(value * 100 + 0.5) AS BIGINT) * 36'
BASE_SQL = f"""p AS (SELECT event_id, user_id, {SECONDS_SQL} AS t FROM events WHERE event_type NOT IN ('view', 'purchase')),
 i AS (SELECT user_id, event_id AS pos, {SECONDS_SQL} AS s, {END_SQL} AS e, event_type AS speaker FROM events WHERE event_type IN ('view', 'purchase')),
 g AS (SELECT user_id, event_id, {SECONDS_SQL} AS gs, {END_SQL} AS ge FROM events WHERE event_type NOT IN ('view', 'purchase'))"""


def points(spark, sf):
    return table(spark, sf, "events").where(~F.col("event_type").isin(*INTERVAL)).select("event_id", "user_id", seconds().alias("t"))


def intervals(spark, sf):
    t = turns(spark, sf).where(F.col("speaker").isin(*INTERVAL))
    return t.select(F.col("meeting_id").alias("user_id"), F.col("event_id").alias("pos"), "start", "end", "speaker")


def gold(spark, sf):
    t = turns(spark, sf).where(~F.col("speaker").isin(*INTERVAL))
    return t.select(F.col("meeting_id").alias("user_id"), "event_id", F.col("start").alias("a_start"), F.col("end").alias("a_end"))


def found(spark, sf):
    return intervals(spark, sf).select("user_id", F.col("pos").alias("b_pos"), F.col("start").alias("b_start"), F.col("end").alias("b_end"), "speaker")


DAY = 86_400


@plans.add("j1_stab_join", f"WITH {BASE_SQL}, h AS (SELECT p.event_id, i.speaker, row_number() OVER (PARTITION BY p.event_id ORDER BY e - s DESC, s, e, i.speaker) AS n FROM p JOIN i ON p.user_id = i.user_id AND s <= t AND t < e) SELECT p.event_id, p.user_id, p.t, coalesce(h.speaker, 'UNKNOWN') AS speaker FROM p LEFT JOIN h ON p.event_id = h.event_id AND n = 1")
def j1(spark, sf):
    return temporal.longest_active(points(spark, sf), intervals(spark, sf), ["user_id"], "event_id", width=DAY).select("event_id", "user_id", "t", "speaker")


@plans.add("j1b_first_active", f"WITH {BASE_SQL}, h AS (SELECT p.event_id, i.speaker, row_number() OVER (PARTITION BY p.event_id ORDER BY s, e, i.speaker) AS n FROM p JOIN i ON p.user_id = i.user_id AND s <= t AND t < e) SELECT p.event_id, p.user_id, p.t, coalesce(h.speaker, 'UNKNOWN') AS speaker FROM p LEFT JOIN h ON p.event_id = h.event_id AND n = 1")
def j1b(spark, sf):
    return temporal.first_active(points(spark, sf), intervals(spark, sf), ["user_id"], "event_id", width=DAY).select("event_id", "user_id", "t", "speaker")


@plans.add("j2_overlap_text", f"WITH {BASE_SQL}, h AS (SELECT event_id, string_agg(speaker, ' ' ORDER BY pos) AS text, min(s) AS first, max(e) AS last FROM g JOIN i ON g.user_id = i.user_id AND gs < e AND ge > s GROUP BY event_id) SELECT g.event_id, coalesce(text, '') AS text, first, last FROM g LEFT JOIN h ON g.event_id = h.event_id")
def j2(spark, sf):
    words = found(spark, sf).select("user_id", F.col("b_pos").alias("pos"), "b_start", "b_end", F.col("speaker").alias("word"))
    return temporal.words_of(gold(spark, sf), words, ["user_id"], "event_id", width=DAY).select("event_id", "text", "first", "last")


@plans.add("j3_dominant_time", f"WITH {BASE_SQL}, e1 AS (SELECT event_id, speaker, sum(greatest(0, least(ge, e) - greatest(gs, s))) AS n, min(s) AS f FROM g JOIN i ON g.user_id = i.user_id AND gs < e AND ge > s GROUP BY event_id, speaker), b AS (SELECT event_id, speaker, n, row_number() OVER (PARTITION BY event_id ORDER BY n DESC, f, speaker) AS r FROM e1) SELECT g.event_id, coalesce(speaker, '') AS speaker, CAST(coalesce(n, 0) AS BIGINT) AS shared FROM g LEFT JOIN b ON g.event_id = b.event_id AND r = 1")
def j3(spark, sf):
    return temporal.dominant(gold(spark, sf), found(spark, sf), ["user_id"], "event_id", width=DAY).select("event_id", "speaker", F.col("shared").cast("long").alias("shared"))


@plans.add("j4_dominant_count", f"WITH {BASE_SQL}, pp AS (SELECT user_id, {SECONDS_SQL} AS t, event_type AS speaker FROM events), e1 AS (SELECT pos, pp.speaker, count(*) AS n FROM i JOIN pp ON i.user_id = pp.user_id AND t >= s AND t <= e GROUP BY pos, pp.speaker), b AS (SELECT *, row_number() OVER (PARTITION BY pos ORDER BY n DESC, speaker) AS r FROM e1) SELECT i.pos, coalesce(b.speaker, '') AS speaker FROM i LEFT JOIN b ON i.pos = b.pos AND r = 1")
def j4(spark, sf):
    said = table(spark, sf, "events").select("user_id", seconds().alias("t"), F.col("event_type").alias("speaker"))
    return temporal.dominant_count(intervals(spark, sf).drop("speaker"), said, ["user_id"], "pos", width=DAY).select("pos", "speaker")


@plans.add("j5_as_of_backward", f"WITH {BASE_SQL} SELECT p.event_id, p.t, (SELECT max(pos) FROM i WHERE i.user_id = p.user_id AND s = (SELECT max(s) FROM i WHERE i.user_id = p.user_id AND s <= p.t)) AS pos FROM p")
def j5(spark, sf):
    marks = intervals(spark, sf).select("user_id", F.col("start").alias("t"), "pos")
    return temporal.as_of(points(spark, sf), marks, ["user_id"], value="pos").select("event_id", "t", "pos")


@plans.add("j6_as_of_forward", f"WITH {BASE_SQL} SELECT p.event_id, p.t, (SELECT max(pos) FROM i WHERE i.user_id = p.user_id AND s = (SELECT min(s) FROM i WHERE i.user_id = p.user_id AND s >= p.t)) AS pos FROM p")
def j6(spark, sf):
    marks = intervals(spark, sf).select("user_id", F.col("start").alias("t"), "pos")
    return temporal.as_of(points(spark, sf), marks, ["user_id"], value="pos", forward=True).select("event_id", "t", "pos")


@plans.add("j7_tolerance_join", f"WITH {BASE_SQL}, h AS (SELECT event_id, min(pos) AS pos FROM p JOIN i ON p.user_id = i.user_id AND (abs(s - t) <= 3600 OR (s <= t AND t < e)) GROUP BY event_id) SELECT p.event_id, i.speaker FROM p LEFT JOIN h ON p.event_id = h.event_id LEFT JOIN i ON h.pos = i.pos")
def j7(spark, sf):
    return temporal.nearest(points(spark, sf), intervals(spark, sf), ["user_id"], "event_id", 3600).select("event_id", "speaker")


@plans.add("j8_best_overlap", f"WITH {BASE_SQL}, h AS (SELECT event_id, pos, row_number() OVER (PARTITION BY event_id ORDER BY least(ge, e) - greatest(gs, s) DESC, pos) AS n FROM g JOIN i ON g.user_id = i.user_id AND gs < e AND ge > s) SELECT g.event_id, h.pos AS b_pos FROM g LEFT JOIN h ON g.event_id = h.event_id AND n = 1")
def j8(spark, sf):
    return temporal.best_overlap(gold(spark, sf), found(spark, sf), ["user_id"], "event_id", width=DAY).select("event_id", "b_pos")


@plans.add("j9_first_overlap", f"WITH {BASE_SQL}, h AS (SELECT event_id, min(pos) AS pos FROM g JOIN i ON g.user_id = i.user_id AND gs < e AND ge > s GROUP BY event_id) SELECT g.event_id, h.pos AS b_pos FROM g LEFT JOIN h ON g.event_id = h.event_id")
def j9(spark, sf):
    return temporal.best_overlap(gold(spark, sf), found(spark, sf), ["user_id"], "event_id", first=True, width=DAY).select("event_id", "b_pos")


@plans.add("j10_zip", "WITH a AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events WHERE event_type = 'view'), b AS (SELECT user_id, event_id AS other, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events WHERE event_type = 'click') SELECT user_id, n, event_id, other FROM a JOIN b USING (user_id, n)")
def j10(spark, sf):
    from pyspark.sql import Window as W

    n = F.row_number().over(W.partitionBy("user_id").orderBy("event_id")).cast("long")
    e = table(spark, sf, "events")
    a, b = (e.where(F.col("event_type") == k).select("user_id", "event_id", n.alias("n")) for k in ("view", "click"))
    return a.join(b.withColumnRenamed("event_id", "other"), ["user_id", "n"]).select("user_id", "n", "event_id", "other")


@plans.add("j11_dimension_lookup", "SELECT c_custkey, coalesce(n_name, 'nowhere') AS n_name FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 3) ON c_nationkey = n_nationkey")
def j11(spark, sf):
    nation = table(spark, sf, "nation").where("n_regionkey < 3").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return resolve.lookup(table(spark, sf, "customer"), nation, "c_nationkey", "n_name", "nowhere").select("c_custkey", "n_name")


@plans.add("j12_array_lookup", "WITH r AS (SELECT n_regionkey AS k, n_name, unnest([n_nationkey, n_nationkey + 10]) AS id FROM nation), one AS (SELECT id, min(n_name) AS n_name FROM r GROUP BY id) SELECT c_custkey, n_name FROM customer LEFT JOIN one ON c_nationkey = id")
def j12(spark, sf):
    ids = table(spark, sf, "nation").select("n_name", F.explode(F.array("n_nationkey", F.col("n_nationkey") + 10)).alias("id")).groupBy("id").agg(F.min("n_name").alias("n_name"))
    return table(spark, sf, "customer").join(ids, F.col("c_nationkey") == F.col("id"), "left").select("c_custkey", "n_name")


@plans.add("j13_update_join", "WITH d AS (SELECT user_id, event_type, value, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) SELECT c_custkey, CASE WHEN event_type = 'error' THEN 'REDACTED' WHEN event_type IS NULL OR event_type = 'view' THEN c_name ELSE event_type END AS name, event_type IS NOT NULL AS decided FROM customer LEFT JOIN d ON c_custkey = user_id AND n = 1")
def j13(spark, sf):
    last = resolve.latest(table(spark, sf, "events"), ["user_id"], ["ts", "event_id"]).select(F.col("user_id").alias("c_custkey"), "event_type")
    out = table(spark, sf, "customer").join(last, "c_custkey", "left")
    override = F.nullif(F.col("event_type"), F.lit("view"))
    return out.select("c_custkey", F.when(F.col("event_type") == "error", "REDACTED").otherwise(F.coalesce(override, "c_name")).alias("name"), F.col("event_type").isNotNull().alias("decided"))


@plans.add("j14_equi_lookup", "SELECT o_orderkey, c_name, n_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey")
def j14(spark, sf):
    o, c, n = (table(spark, sf, x) for x in ("orders", "customer", "nation"))
    return o.join(c, o["o_custkey"] == c["c_custkey"]).join(n, c["c_nationkey"] == n["n_nationkey"]).select("o_orderkey", "c_name", "n_name")


_VEC = "v AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings)"
_COS = "list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e)))"


@plans.add("j15_similar_pairs", f"WITH {_VEC} SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id < b.vec_id AND a.label <> b.label WHERE {_COS} >= 0.38")
def j15(spark, sf):
    from turnwright.operators.vectors import similar_pairs

    return similar_pairs(table(spark, sf, "embeddings"), "vec_id", "embedding", "label", 0.38).select("a", "b")


_CENT = f"{_VEC}, x AS (SELECT label, unnest(range(len(e))) AS k, unnest(e) AS m FROM v), y AS (SELECT label, k, avg(m) AS m FROM x GROUP BY label, k), c AS (SELECT label, list(m ORDER BY k) AS e FROM y GROUP BY label)"


def best(spark, sf, k):
    """Every candidate against every reference (one a label), in blocks."""
    from turnwright.operators.vectors import top_matches

    e = table(spark, sf, "embeddings").select("vec_id", "label", "embedding")
    references = mean_vector(e, ["label"], "embedding").withColumnRenamed("label", "reference")
    return top_matches(e, references, "vec_id", "embedding", k, "reference").withColumnRenamed("query", "vec_id")


@plans.add("j16_cross_score", f"WITH {_CENT}, s AS (SELECT a.vec_id, b.label AS reference, {_COS} AS score FROM v a, c b), r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, reference) AS n FROM s) SELECT vec_id, reference AS best, floor(score * 1000000 + 0.5) / 1000000 AS best_score FROM r WHERE n = 1")
def j16(spark, sf):
    return best(spark, sf, 1).select("vec_id", F.col("reference").alias("best"), (F.floor(F.col("score") * 1000000 + 0.5) / 1000000).alias("best_score"))


@plans.add("w16_top_two", f"WITH {_CENT}, s AS (SELECT a.vec_id, b.label AS reference, {_COS} AS score FROM v a, c b), r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, reference) AS n FROM s), t AS (SELECT vec_id, max(CASE WHEN n = 1 THEN reference END) AS best, max(CASE WHEN n = 1 THEN score END) AS one, max(CASE WHEN n = 2 THEN score END) AS two FROM r GROUP BY vec_id) SELECT vec_id, best, CASE WHEN one >= 0.4 AND one - two >= 0.03 THEN 'accepted' WHEN one >= 0.3 THEN 'review' ELSE 'unknown' END AS decision FROM t")
def w16(spark, sf):
    from turnwright.operators.sequence import top_two

    two = top_two(best(spark, sf, 2), ["vec_id"], "reference", "score")
    return two.select("vec_id", "best", F.when((F.col("best_score") >= 0.4) & (F.col("margin") >= 0.03), "accepted").when(F.col("best_score") >= 0.3, "review").otherwise("unknown").alias("decision"))


@plans.add("j17_containment", "WITH h AS (SELECT doc_id, min(item_id) AS i FROM documents d JOIN benchmark b ON contains(lower(d.text), lower(b.text)) GROUP BY doc_id) SELECT doc_id, b.text AS found FROM documents LEFT JOIN h USING (doc_id) LEFT JOIN benchmark b ON h.i = b.item_id")
def j17(spark, sf):
    out = temporal.containment(table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "benchmark").withColumnRenamed("text", "phrase"), "doc_id", "text", "phrase", "item_id")
    return out.select("doc_id", "found")


@plans.add("j18_semi_join", "SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def j18(spark, sf):
    c, o = table(spark, sf, "customer"), table(spark, sf, "orders")
    return c.join(o, c["c_custkey"] == o["o_custkey"], "left_semi").select("c_custkey", "c_name")


@plans.add("j19_anti_join", "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def j19(spark, sf):
    """Customers without an order."""
    c, o = table(spark, sf, "customer"), table(spark, sf, "orders")
    return c.join(o, c["c_custkey"] == o["o_custkey"], "left_anti").select("c_custkey", "c_name")


@plans.add("j20_expand_clusters", "WITH k AS (SELECT user_id, event_type, unnest(list(event_id)) AS event_id FROM events GROUP BY user_id, event_type), d AS (SELECT event_id, 'd' || event_id AS decision FROM events WHERE event_id % 3 = 0) SELECT k.event_id, user_id, coalesce(decision, 'new') AS decision FROM k LEFT JOIN d ON k.event_id = d.event_id")
def j20(spark, sf):
    e = table(spark, sf, "events")
    each = e.groupBy("user_id", "event_type").agg(F.collect_list("event_id").alias("turns")).select("user_id", F.explode("turns").alias("event_id"))
    old = e.where("event_id % 3 = 0").select("event_id", F.concat(F.lit("d"), "event_id").alias("decision"))
    return each.join(old, "event_id", "left").select("event_id", "user_id", F.coalesce("decision", F.lit("new")).alias("decision"))


@plans.add("j21_window_override", f"WITH {TURNS_SQL}, w AS (SELECT meeting_id, start AS a, \"end\" AS b, 'view' AS o, 'Chair' AS n FROM turns WHERE speaker = 'purchase'), h AS (SELECT DISTINCT event_id FROM turns t JOIN w ON t.meeting_id = w.meeting_id AND t.start >= a AND t.start <= b AND t.speaker = o) SELECT t.event_id, CASE WHEN h.event_id IS NULL THEN speaker ELSE 'Chair' END AS speaker FROM turns t LEFT JOIN h ON t.event_id = h.event_id")
def j21(spark, sf):
    t = turns(spark, sf)
    windows = t.where("speaker = 'purchase'").select("meeting_id", F.col("start").alias("window_start"), F.col("end").alias("window_end"), F.lit("view").alias("original_speaker"), F.lit("Chair").alias("override_speaker"))
    return temporal.overrides(t, windows, ["meeting_id"], "event_id").select("event_id", "speaker")


@plans.add("j22_composite_lookup", "WITH a AS (SELECT event_id, user_id, CAST(floor(value) AS BIGINT) AS v FROM events WHERE event_type = 'view'), b AS (SELECT user_id, CAST(floor(value) AS BIGINT) AS v, min(event_id) AS other FROM events WHERE event_type = 'click' GROUP BY ALL) SELECT event_id, other FROM a LEFT JOIN b USING (user_id, v)")
def j22(spark, sf):
    e = table(spark, sf, "events").withColumn("v", F.floor("value").cast("long"))
    b = e.where("event_type = 'click'").groupBy("user_id", "v").agg(F.min("event_id").alias("other"))
    return e.where("event_type = 'view'").join(b, ["user_id", "v"], "left").select("event_id", "other")


@plans.add("j23_section_label", "SELECT event_id, n_name AS label FROM events LEFT JOIN nation ON CAST(floor(value) AS BIGINT) = n_nationkey")
def j23(spark, sf):
    n = table(spark, sf, "nation")
    return table(spark, sf, "events").join(n, F.floor("value").cast("long") == n["n_nationkey"], "left").select("event_id", F.col("n_name").alias("label"))


@plans.add("a6_weighted_vote", "WITH e AS (SELECT l_partkey, l_returnflag, sum(CASE WHEN l_linenumber = 1 THEN 3 WHEN l_linenumber < 4 THEN 2 ELSE 1 END) AS n FROM lineitem GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY n DESC, l_returnflag) AS k FROM e), t AS (SELECT l_partkey, max(CASE WHEN k = 1 THEN l_returnflag END) AS l_returnflag, max(n) AS best, coalesce(max(CASE WHEN k = 2 THEN n END), 0) AS second, sum(n) AS total FROM r GROUP BY l_partkey) SELECT l_partkey, l_returnflag, CAST(best AS BIGINT) AS best, best >= 5 AND best <> second AND best >= 0.7 * total AS accepted FROM t")
def a6(spark, sf):
    votes = table(spark, sf, "lineitem").withColumn("w", F.when(F.col("l_linenumber") == 1, 3).when(F.col("l_linenumber") < 4, 2).otherwise(1))
    return resolve.weighted_vote(votes, ["l_partkey"], "l_returnflag", "w").select("l_partkey", "l_returnflag", "best", "accepted")


@plans.add("u1_priority_union", "SELECT n_nationkey AS id, CASE WHEN n_nationkey % 2 = 0 THEN 'fixed' ELSE n_name END AS name FROM nation")
def u1(spark, sf):
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    return resolve.priority_union(n.where("id % 2 = 0").withColumn("name", F.lit("fixed")), n, "id", "name")


@plans.add("u4_latest", "SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1")
def u4(spark, sf):
    return resolve.latest(table(spark, sf, "events"), ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id", "value")


@plans.add("p20_unique_ids", "SELECT o_orderkey, CASE WHEN c_custkey IS NULL OR c_nationkey = o_orderkey THEN 'm' || o_custkey ELSE 'm' || o_custkey || '-' || o_orderkey END AS id FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_nationkey < 12) ON o_custkey = c_custkey")
def p20(spark, sf):
    new = table(spark, sf, "orders").select("o_orderkey", F.concat(F.lit("m"), "o_custkey").alias("base"), F.col("o_orderkey").alias("clip"))
    taken = table(spark, sf, "customer").where("c_nationkey < 12").select(F.concat(F.lit("m"), "c_custkey").alias("base"), F.col("c_nationkey").alias("clip"))
    return resolve.unique_ids(new, taken, "base", "clip").select("o_orderkey", "id")


@plans.add("minimum_slice", f"WITH {BASE_SQL}, h AS (SELECT p.event_id, i.speaker, row_number() OVER (PARTITION BY p.event_id ORDER BY e - s DESC, s, e, i.speaker) AS n FROM p JOIN i ON p.user_id = i.user_id AND s <= t AND t < e), l AS (SELECT p.event_id, p.user_id, p.t, coalesce(h.speaker, 'UNKNOWN') AS speaker FROM p LEFT JOIN h ON p.event_id = h.event_id AND n = 1), b AS (SELECT *, CASE WHEN lag(speaker) OVER (PARTITION BY user_id ORDER BY t, event_id) = speaker THEN 0 ELSE 1 END AS new FROM l), r AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY t, event_id) AS run_id FROM b), k AS (SELECT user_id, run_id, speaker, min(t) AS s, max(t) AS e, count(*) AS n FROM r GROUP BY ALL) SELECT speaker, count(*) AS runs, CAST(sum(n) AS BIGINT) AS points, CAST(sum(e - s) AS BIGINT) AS seconds FROM k GROUP BY speaker")
def minimum_slice(spark, sf):
    """Points attributed to intervals, folded into runs of one speaker, and summed up."""
    from turnwright.operators.sequence import runs

    tagged = temporal.longest_active(points(spark, sf), intervals(spark, sf), ["user_id"], "event_id", width=DAY)
    tagged = tagged.withColumns({"start": F.col("t"), "end": F.col("t")})
    return runs(tagged, ["user_id"], ["t", "event_id"], "speaker").groupBy("speaker").agg(F.count(F.lit(1)).alias("runs"), F.sum("n").alias("points"), F.sum(F.col("end") - F.col("start")).alias("seconds"))
