"""Sources (S), sinks (K) and streaming (T) over the driver tables: what a sink writes, a source reads back."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnwright.operators import resolve, sequence
from turnwright.plans.base import TURNS_SQL, Plans, table, turns
from turnwright.session import scratch
from turnwright.sinks import gate, parts, publish
from turnwright.sources import scans, tables
from turnwright.streaming import review as streams

plans = Plans()
add = plans.add


def spoken(spark, sf):
    c = table(spark, sf, "conversations")
    return c.select(F.col("conv_id").alias("meeting_id"), F.col("turn").alias("pos"), (F.col("turn") * 10).alias("start"), (F.col("turn") * 10 + 7).alias("end"), F.col("role").alias("speaker"), F.regexp_replace("text", r"\s+", " ").alias("text"))


CLEAN = "trim(regexp_replace(text, '\\s+', ' ', 'g'))"


@add("s5_k7_webvtt", f"SELECT conv_id AS meeting_id, turn * 10000 AS start_ms, turn * 10000 + 7000 AS end_ms, {CLEAN} AS text FROM conversations")
def webvtt(spark, sf):
    cues = scans.webvtt(publish.webvtt(spoken(spark, sf)), "meeting_id", "content")
    return cues.select("meeting_id", "start_ms", "end_ms", "text")


@add("s6_k1_k2_js", "SELECT conv_id AS meeting_id, role AS speaker, turn * 10 AS start, regexp_replace(text, '\\s+', ' ', 'g') AS text FROM conversations")
def js(spark, sf):
    files = publish.js_file(publish.json_document(spoken(spark, sf), ["speaker", "start", "text"]))
    rows = files.select("meeting_id", F.explode(scans.js_array(F.col("content"), "TRANSCRIPT_TURNS", "array<struct<speaker:string,start:long,text:string>>")).alias("t"))
    return rows.select("meeting_id", "t.*")


@add("s2_asr_units", "SELECT conv_id AS meeting_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER) AS pos, turn::DOUBLE AS start, role AS text FROM conversations")
def asr(spark, sf):
    rows = F.array_sort(F.collect_list(F.struct("turn", "role")))
    docs = table(spark, sf, "conversations").groupBy("conv_id").agg(rows.alias("r")).select(F.col("conv_id").alias("meeting_id"), F.to_json(F.struct(F.array().cast("array<string>").alias("word_segments"), F.transform("r", lambda x: F.struct(x["turn"].alias("start"), x["turn"].alias("end"), x["role"].alias("word"))).alias("words"))).alias("document"))
    return scans.asr_units(docs, "meeting_id").select("meeting_id", "pos", "start", "text")


@add("s3_diarization", f"WITH {TURNS_SQL} SELECT meeting_id, start::DOUBLE AS start, \"end\"::DOUBLE AS \"end\", speaker FROM turns WHERE speaker <> 'error' AND \"end\" > start")
def diarization(spark, sf):
    t = turns(spark, sf).withColumn("speaker", F.when(F.col("speaker") == "error", " ").otherwise(F.col("speaker")))
    docs = t.groupBy("meeting_id").agg(F.to_json(F.struct(F.collect_list(F.struct("start", "end", "speaker")).alias("segments"))).alias("document"))
    return scans.diarization(docs, "meeting_id")


@add("s4_word_speakers", "SELECT conv_id AS meeting_id, turn::DOUBLE AS start, role AS speaker FROM conversations WHERE role <> 'system'")
def word_speakers(spark, sf):
    kind = F.when(F.col("role") == "system", "spacing").otherwise("word")
    docs = table(spark, sf, "conversations").groupBy("conv_id").agg(F.to_json(F.struct(F.collect_list(F.struct(F.col("turn").alias("start"), F.col("turn").alias("end"), kind.alias("type"), F.col("role").alias("speaker_id"))).alias("words"))).alias("document"))
    return scans.word_speakers(docs.withColumnRenamed("conv_id", "meeting_id"), "meeting_id").select("meeting_id", "start", "speaker")


@add("s7_html_links", "WITH i AS (SELECT page_id, unnest(regexp_extract_all(html, '<li><a href=\"([^\"]*)\">(.*?)</a></li>', 1)) AS href FROM pages) SELECT page_id, href FROM i")
def links(spark, sf):
    return scans.html_links(table(spark, sf, "pages"), "page_id").select("page_id", "href")


@add("s8_html_elements", "SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(replace(regexp_extract(html, '<h1>(.*?)</h1>', 1), '&lt;', '<'), '&gt;', '>'), '&quot;', chr(34)), '&#39;', chr(39)), '&amp;', '&'), '\\s+', ' ', 'g')) AS label FROM pages")
def elements(spark, sf):
    return scans.html_elements(table(spark, sf, "pages"), "page_id", "h1").select("page_id", "label")


@add("s10_approvals", "SELECT DISTINCT user_id, event_type AS speaker_raw, 'approved' AS status, 'N' || event_type AS name FROM events")
def approvals(spark, sf):
    each = table(spark, sf, "events").select("user_id", "event_type").distinct()
    entry = F.struct(F.lit("approved").alias("status"), F.concat(F.lit("N"), "event_type").alias("name"))
    maps = each.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", entry.alias("v")))).alias("m"))
    docs = maps.select("user_id", F.when(F.col("user_id") % 2 == 0, F.to_json("m")).otherwise(F.to_json(F.struct(F.col("m").alias("approvals")))).alias("document"))
    return scans.approvals(docs, "user_id").select("user_id", "speaker_raw", "status", "name")


@add("s12_embedding_list", "SELECT vec_id, len(embedding) AS dim FROM embeddings")
def embedding_list(spark, sf):
    e = table(spark, sf, "embeddings").withColumn("embedding_path", F.concat(F.lit("e/"), "vec_id"))
    listed = e.withColumn("embedding", F.when(F.col("vec_id") % 2 == 0, F.col("embedding")))
    return scans.embeddings(listed, e).select("vec_id", F.size("embedding").cast("long").alias("dim"))


@add("s14_gold", "SELECT conv_id, 'ex_' || conv_id AS excerpt_id, 't' || turn AS turn_id, role AS speaker_name FROM conversations")
def gold(spark, sf):
    t = F.struct(F.concat(F.lit("t"), "turn").alias("turn_id"), F.col("role").alias("speaker_name"))
    ex = table(spark, sf, "conversations").groupBy("conv_id").agg(F.collect_list(t).alias("turns"))
    docs = ex.select("conv_id", F.to_json(F.struct(F.array(F.struct(F.concat(F.lit("ex_"), "conv_id").alias("excerpt_id"), "turns")).alias("excerpts"))).alias("document"))
    return scans.gold(docs, "conv_id").select("conv_id", "excerpt_id", "turn_id", "speaker_name")


@add("s15_votes", "SELECT c_custkey AS meeting_id, o_orderstatus AS result FROM customer LEFT JOIN orders ON o_custkey = c_custkey")
def votes(spark, sf):
    docs = table(spark, sf, "orders").groupBy("o_custkey").agg(F.to_json(F.struct(F.collect_list(F.struct(F.col("o_orderstatus").alias("result"))).alias("votes"))).alias("document"))
    return scans.votes(table(spark, sf, "customer").select(F.col("c_custkey").alias("meeting_id")), docs.withColumnRenamed("o_custkey", "meeting_id")).select("meeting_id", "result")


@add("k3_html_page", "WITH c AS (SELECT *, dense_rank() OVER (PARTITION BY conv_id ORDER BY role) - 1 AS c FROM conversations) SELECT conv_id AS meeting_id, '<!DOCTYPE html><html><body>' || chr(10) || string_agg('<p class=\"c' || c || '\"><b>' || role || '</b> ' || replace(replace(replace(replace(replace(regexp_replace(text, '\\s+', ' ', 'g'), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#39;') || '</p>', chr(10) ORDER BY turn) || chr(10) || '</body></html>' || chr(10) AS content FROM c GROUP BY conv_id")
def html_page(spark, sf):
    return publish.html_page(spoken(spark, sf))


@add("k6_markdown", "WITH c AS (SELECT *, coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn) <> role, true) AS h FROM conversations) SELECT conv_id AS meeting_id, string_agg(CASE WHEN h THEN '## ' || role || chr(10) || chr(10) ELSE '' END || regexp_replace(text, '\\s+', ' ', 'g'), chr(10) || chr(10) ORDER BY turn) AS content FROM c GROUP BY conv_id")
def markdown(spark, sf):
    return publish.markdown(spoken(spark, sf))


@add("k8_plain_text", "SELECT conv_id AS meeting_id, string_agg(printf('[%02d:%02d:%02d] ', turn * 10 // 3600, turn * 10 // 60 % 60, turn * 10 % 60) || regexp_replace(text, '\\s+', ' ', 'g'), chr(10) ORDER BY turn) AS content FROM conversations GROUP BY conv_id")
def plain(spark, sf):
    return publish.plain_text(spoken(spark, sf))


_SITE = "c AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 7 = 0 THEN 'x' ELSE 'm' END || c_custkey AS stem FROM customer)"


@add("k12_validation", f"WITH {_SITE} SELECT 'meetings/' || stem || '.json' AS path, 'missing required field title' AS rule, true AS fatal FROM c WHERE k % 5 = 0 UNION ALL SELECT 'meetings/' || stem || '.json', 'filename stem must equal meeting_id', true FROM c WHERE k % 7 = 0 UNION ALL SELECT 'meetings/' || stem || '.json', 'not published yet', false FROM c WHERE k % 3 = 0 UNION ALL SELECT 'docs/js/m' || k || '.js', 'does not define TRANSCRIPT_TURNS', true FROM c WHERE k % 3 <> 0 AND k % 11 = 0 UNION ALL SELECT 'docs/js/search.js', 'missing asset', true")
def validation(spark, sf):
    """The files of a site with a meeting a customer, in which some titles, names, pages and scripts are amiss."""
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), "c_name")
    own = F.concat(F.lit("m"), "k")
    meeting = F.to_json(F.struct(own.alias("meeting_id"), F.lit("2026-01-06").alias("meeting_date"), F.when(F.col("k") % 5 == 0, "").otherwise(F.col("c_name")).alias("title"), F.lit("council").alias("meeting_type"), F.lit("u").alias("source_video_url"), F.concat(F.lit("t/"), own, F.lit(".html")).alias("transcript_url"), F.concat(F.lit("docs/js/"), own, F.lit(".js")).alias("transcript_turns_js")))
    meetings = c.select(F.concat(F.lit("meetings/"), F.when(F.col("k") % 7 == 0, "x").otherwise("m"), "k", F.lit(".json")).alias("path"), meeting.alias("content"))
    pages = c.where("k % 3 <> 0").select(F.concat(F.lit("docs/t/"), own, F.lit(".html")).alias("path"), F.col("c_name").alias("content"))
    scripts = c.select(F.concat(F.lit("docs/js/"), own, F.lit(".js")).alias("path"), F.when(F.col("k") % 11 == 0, "let x = []").otherwise("const TRANSCRIPT_TURNS = [{}];").alias("content"))
    assets = c.select(F.explode(F.array(*map(F.lit, gate.SITE_ASSETS))).alias("path"), F.lit("x").alias("content")).where("path <> 'docs/js/search.js'").distinct()
    return gate.site_violations(publish.union_all([meetings, pages, scripts, assets]))


@add("k12_gate", "SELECT 'o_clerk is missing' AS rule, count(*) FILTER (o_orderkey % 100 = 0) AS refused, count(*) FILTER (o_orderkey % 100 <> 0) AS published FROM orders UNION ALL SELECT 'price is low', count(*) FILTER (o_totalprice < 5000), count(*) FILTER (o_orderkey % 100 <> 0) FROM orders")
def gated(spark, sf):
    """orders without what breaks a rule are published, all of them are refused: rows that broke each rule, and what readers see."""
    path = scratch(spark)
    rows = table(spark, sf, "orders").withColumn("o_clerk", F.when(F.col("o_orderkey") % 100 != 0, "clerk").otherwise(""))
    publish.atomic(rows.where("o_clerk <> ''"), path, gate=gate.Gate(gate.required(["o_clerk"])))
    refused = {}
    try:
        publish.atomic(rows, path, gate=gate.Gate(gate.required(["o_clerk"]) | {"price is low": F.col("o_totalprice") < 5000}))
    except gate.RefusedError as e:
        refused = e.counts
    seen = spark.read.parquet(publish.current(spark, path)).agg(F.count(F.lit(1)).alias("published"))
    rules = spark.createDataFrame([(r, refused.get(r, 0)) for r in ("o_clerk is missing", "price is low")], "rule string, refused long")
    return rules.withColumn("published", seen.scalar())


@add("t2_resume", "SELECT event_id FROM events WHERE event_id % 3 <> 0")
def resume(spark, sf):
    e = table(spark, sf, "events").select("event_id")
    return streams.unseen(e, e.where("event_id % 3 = 0"), "event_id")


@add("t6_sessions", "WITH a AS (SELECT *, CASE WHEN ts - lag(ts) OVER w < INTERVAL 6 HOURS THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), b AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM a) SELECT user_id, min(ts) AS start, max(ts) AS last, count(*) AS n FROM b GROUP BY user_id, k")
def sessions(spark, sf):
    return streams.sessions(table(spark, sf, "events"), ["user_id"])


@add("t7_churn", "SELECT date_trunc('day', ts)::TIMESTAMP AS start, count(DISTINCT event_type) AS labels, count(*) AS n FROM events GROUP BY 1")
def churn(spark, sf):
    return streams.churn(table(spark, sf, "events"), "event_type")


@add("s1_meetings", "SELECT n_name AS meeting_id, DATE '2026-01-01' + CAST(n_nationkey AS INTEGER) AS meeting_date, n_regionkey AS duration_seconds, 1 AS sections FROM nation")
def meeting_files(spark, sf):
    """A file a meeting, read again."""
    path = scratch(spark)
    section = F.struct(F.lit(5).alias("start_seconds"), F.col("n_name").alias("label"))
    doc = F.to_json(F.struct(F.col("n_name").alias("meeting_id"), F.expr("date_add(DATE '2026-01-01', cast(n_nationkey AS int))").cast("string").alias("meeting_date"), F.col("n_regionkey").alias("duration_seconds"), F.array(section).alias("sections")))
    table(spark, sf, "nation").select("n_nationkey", doc.alias("value")).write.partitionBy("n_nationkey").text(path)
    return scans.meetings(spark, f"{path}/*").select("meeting_id", "meeting_date", "duration_seconds", F.size("sections").alias("sections"))


@add("s7_html_table", "SELECT s_nationkey AS page_id, s_suppkey AS clip_id, s_name AS name, strftime(DATE '2020-01-01' + CAST(s_suppkey AS INTEGER), '%b %d, %Y') AS date_label, DATE '2020-01-01' + CAST(s_suppkey AS INTEGER) AS date, printf('%02dh %02dm', s_suppkey % 5, s_suppkey % 60) AS duration_label, s_suppkey % 5 * 3600 + s_suppkey % 60 * 60 AS duration_seconds, 'https://m.example/AgendaViewer.php?id=' || s_suppkey AS agenda_url, CASE WHEN s_suppkey % 3 = 0 THEN 'https://m.example/MinutesViewer.php?id=' || s_suppkey END AS minutes_url, 'https://v.example/' || s_suppkey || '.mp3' AS mp3_url, NULL::VARCHAR AS mp4_url, 'https://m.example/player/clip/' || s_suppkey AS player_url, 'https://m.example/MediaPlayer.php?view_id=1&clip_id=' || s_suppkey AS media_player_url, lower(strftime(DATE '2020-01-01' + CAST(s_suppkey AS INTEGER), '%b-%d-%Y')) AS meeting_id_suggested FROM supplier WHERE s_suppkey % 4 <> 0")
def html_table(spark, sf):
    day = F.expr("date_add(DATE '2020-01-01', cast(s_suppkey AS int))")
    key = F.col("s_suppkey")
    clip = F.when(key % 4 != 0, F.concat(F.lit("<a href='/x?clip_id="), key, F.lit("'>play</a>"))).otherwise("")
    minutes = F.when(key % 3 == 0, F.concat(F.lit('<a href="//m.example/MinutesViewer.php?id='), key, F.lit('">m</a>'))).otherwise("")
    row = F.concat(F.lit("<TR class='x'>\n<td>&nbsp;"), "s_name", F.lit("</td><td nowrap> "), F.date_format(day, "MMM dd, yyyy"), F.lit(' </td><td class="d" headers="Duration a"><b>'), F.format_string("%02dh %02dm", key % 5, key % 60), F.lit('</b></td><td><a href="//m.example/AgendaViewer.php?id='), key, F.lit('">a</a>'), minutes, F.lit('<a href="https://v.example/'), key, F.lit('.mp3">s</a>'), clip, F.lit("</td></tr>"))
    pages = table(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("page_id")).agg(F.concat(F.lit("<table><tr><td>clip_id=1</td></tr><!-- Meetings -->"), F.array_join(F.collect_list(row), "\n"), F.lit("<!-- End -->")).alias("html"))
    return scans.meeting_table(pages, "page_id", "<!-- Meetings -->", "<!-- End -->", "https://m.example")


@add("s8_html_points", "SELECT conv_id, turn * 60 AS start_seconds, role AS label FROM conversations WHERE turn % 3 <> 0")
def html_points(spark, sf):
    time = F.when(F.col("turn") % 3 != 0, (F.col("turn") * 60).cast("string")).otherwise("soon")
    point = F.concat(F.lit("<div id='p' time='"), time, F.lit('\' class="item index-point">\n <b>'), "role", F.lit("</b>  </div>"))
    pages = table(spark, sf, "conversations").groupBy("conv_id").agg(F.concat(F.lit("<div class='outer'>"), F.array_join(F.collect_list(point), ""), F.lit("</div>")).alias("html"))
    return scans.html_points(pages, "conv_id").select("conv_id", "start_seconds", "label")


@add("s7_links_lateral", plans.sql["s7_html_links"])
def links_lateral(spark, sf):
    """The pages' links by a table function in SQL, with other quotes, attributes and cases than patterns would take."""
    tables.register(spark)
    html = F.regexp_replace("html", r'<li><a href="([^"]*)">', r"""<LI class=x><a title="a > b" HREF='$1'>""")
    return spark.sql("SELECT page_id, l.href FROM {pages}, LATERAL list_links(html) l", pages=table(spark, sf, "pages").select("page_id", html.alias("html")))


@add("s8_points_lateral", plans.sql["s8_html_points"])
def points_lateral(spark, sf):
    """Points of an index with attributes in another order, and an element within them."""
    time = F.when(F.col("turn") % 3 != 0, (F.col("turn") * 60).cast("string")).otherwise("soon")
    point = F.concat(F.lit("<DIV time="), time, F.lit(" id='p' class='item index-point'>\n <b>"), "role", F.lit("</b> <br></DIV>"))
    pages = table(spark, sf, "conversations").groupBy("conv_id").agg(F.concat(F.lit("<div class='outer'>"), F.array_join(F.collect_list(point), ""), F.lit("</div>")).alias("html"))
    return tables.points(pages).select("conv_id", "start_seconds", "label")


@add("s5_cues_lateral", plans.sql["s5_k7_webvtt"])
def cues_lateral(spark, sf):
    cues = tables.cues(publish.webvtt(spoken(spark, sf)), "content")
    return cues.select("meeting_id", "start_ms", "end_ms", F.regexp_replace(F.array_join("lines", " "), r"</?v[^>]*>", "").alias("text"))


@add("s9_registry", "SELECT 'k' || n_nationkey AS speaker_key, n_name AS display_name, 2 AS aliases FROM nation WHERE n_nationkey > 0")
def registry_file(spark, sf):
    """One file of speakers, where an entry comes twice and one has no key."""
    path = scratch(spark)
    key = F.when(F.col("n_nationkey") > 0, F.concat(F.lit("k"), "n_nationkey")).otherwise(" ")
    entry = lambda name, at: F.struct(F.lit(at).alias("at"), key.alias("speaker_key"), name.alias("display_name"), F.array(F.lit("x"), F.col("n_name")).alias("aliases"))
    n = table(spark, sf, "nation").select(F.explode(F.array(entry(F.lit("old"), 0), entry(F.col("n_name"), 1))).alias("s"))
    n.agg(F.to_json(F.struct(F.sort_array(F.collect_list("s")).alias("speakers"))).alias("value")).coalesce(1).write.text(path)  # one row for each nation
    return scans.registry(spark, path).select("speaker_key", "display_name", F.size("aliases").alias("aliases"))


@add("s11_approval_file", "SELECT DISTINCT o_custkey, o_orderstatus AS speaker_raw, 'approved' AS status FROM orders WHERE o_orderstatus <> 'F'")
def approval_file(spark, sf):
    """Approvals under their own key, beside other ones; entries that are null are left out."""
    entry = F.when(F.col("o_orderstatus") != "F", F.struct(F.lit("approved").alias("status")))
    maps = table(spark, sf, "orders").select("o_custkey", "o_orderstatus").distinct().groupBy("o_custkey").agg(F.map_from_entries(F.collect_list(F.struct("o_orderstatus", entry.alias("v")))).alias("m"))
    docs = maps.select("o_custkey", F.to_json(F.struct(F.lit("v1").alias("schema"), F.col("m").alias("approvals")), {"ignoreNullFields": "false"}).alias("document"))
    return scans.approvals(docs, "o_custkey").select("o_custkey", "speaker_raw", "status")


@add("s13_k5_review_sheet", "SELECT s_suppkey, s_name, 'say \"hi\", ' || s_nationkey AS note FROM supplier")
def review_sheet(spark, sf):
    path = f"{scratch(spark)}/sheet.csv"
    publish.csv(table(spark, sf, "supplier").select("s_suppkey", "s_name", F.concat(F.lit('say "hi", '), "s_nationkey").alias("note")), path)
    return scans.review_sheet(spark, path, "s_suppkey long, s_name string, note string")


@add("k4_search_index", "SELECT conv_id AS meeting_id, 'now' AS generated_at, count(*) AS segments, arg_min(role, turn) AS first_speaker, count(DISTINCT role) AS speakers FROM conversations GROUP BY conv_id")
def search_index(spark, sf):
    segments = spoken(spark, sf).select("meeting_id", "pos", "speaker", "text")
    docs = publish.search_document(segments.select("meeting_id").distinct(), segments, "now")
    read = F.from_json("content", "generated_at string, meetings array<struct<meeting_id:long>>, segments array<struct<pos:long,speaker:string,text:string>>, speakers array<string>")
    d = docs.select(read.alias("d"))
    return d.select(F.col("d.meetings")[0]["meeting_id"].alias("meeting_id"), "d.generated_at", F.size("d.segments").cast("long").alias("segments"), F.col("d.segments")[0]["speaker"].alias("first_speaker"), F.size("d.speakers").cast("long").alias("speakers"))


@add("k4_index_by_date", "SELECT o_orderkey, o_custkey FROM orders WHERE date_trunc('month', o_orderdate) = DATE '1995-06-01'")
def index_by_date(spark, sf):
    path = scratch(spark)
    publish.search_index(table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.trunc(F.col("o_orderdate").cast("date"), "month").alias("meeting_date")), path)
    return spark.read.parquet(path).where("meeting_date = DATE '1995-06-01'").select("o_orderkey", "o_custkey")


@add("k9_atomic", "SELECT c_custkey, c_name FROM customer")
def replaced(spark, sf):
    path, c = scratch(spark), table(spark, sf, "customer").select("c_custkey", "c_name")
    publish.atomic(c.where("c_custkey % 2 = 0"), path)
    publish.atomic(c, path)
    return spark.read.parquet(publish.current(spark, path))


@add("k9_partitions", "SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN 'second' ELSE 'first' END AS version FROM orders WHERE o_orderstatus <> 'F' OR o_orderkey % 2 = 0")
def replaced_partitions(spark, sf):
    """All orders by status, then other rows for one status."""
    path, o = scratch(spark), table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    parts.replace(o.withColumn("version", F.lit("first")), path, ["o_orderstatus"])
    parts.replace(o.where("o_orderstatus = 'F' AND o_orderkey % 2 = 0").withColumn("version", F.lit("second")), path, ["o_orderstatus"])
    return parts.read(spark, path)


@add("k11_append_state", "SELECT user_id, arg_max(event_id, event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id")
def appended(spark, sf):
    path, e = scratch(spark), table(spark, sf, "events").select("user_id", "event_id", "event_type")
    publish.append_state(e.where("event_id % 2 = 0"), path)
    publish.append_state(e.where("event_id % 2 = 1"), path)
    return resolve.latest(spark.read.parquet(path), ["user_id"], ["event_id"])


@add("a9_dominance", f"WITH {TURNS_SQL}, d AS (SELECT meeting_id, speaker, sum(\"end\" - start) AS n, min(pos) AS first FROM turns WHERE speaker <> 'error' GROUP BY ALL), b AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY meeting_id ORDER BY n DESC, first) = 1), t AS (SELECT meeting_id, sum(\"end\" - start) AS total FROM turns GROUP BY meeting_id) SELECT t.meeting_id, b.speaker, CASE WHEN total > 0 THEN floor(b.n * 1000000 / total) END AS share FROM t LEFT JOIN b USING (meeting_id)")
def dominance(spark, sf):
    d = sequence.dominant_share(turns(spark, sf), ["meeting_id"], ["pos"], "error")
    return d.select("meeting_id", F.col("best.speaker").alias("speaker"), F.when(F.col("total") > 0, F.floor(F.col("best.n") * 1000000 / F.col("total")).cast("double")).alias("share"))


@add("t4_t5_decisions", "SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id")
def decision_stream(spark, sf):
    """events as a stream of decisions, of which the last of each user stays; read back from the log."""
    path, e = scratch(spark), table(spark, sf, "events")
    e.select("user_id", "event_id", "event_type").write.parquet(f"{path}/in")
    stream = spark.readStream.schema("user_id long, event_id long, event_type string").parquet(f"{path}/in")
    streams.latest_decisions(stream, f"{path}/state", f"{path}/checkpoint", ["user_id"], ["event_id"]).awaitTermination()
    return streams.decisions(spark, f"{path}/state", ["user_id"], ["event_id"])


@add("t4_once", "SELECT user_id, event_type FROM events GROUP BY ALL")
def once(spark, sf):
    """events as a stream, of which one of each user and type goes on."""
    path, e = scratch(spark), table(spark, sf, "events")
    e.select("user_id", "event_type", F.col("ts").cast("timestamp").alias("ts")).write.parquet(f"{path}/in")
    stream = spark.readStream.schema("user_id long, event_type string, ts timestamp").parquet(f"{path}/in")
    out = streams.once(stream, ["user_id", "event_type"], "ts").writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/checkpoint")
    out.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("user_id long, event_type string").parquet(f"{path}/out")


_NATIONS = "t AS (SELECT c_nationkey AS m, c_custkey AS k, c_name AS name FROM customer), d AS (SELECT DISTINCT m FROM t WHERE k % 40 = 0)"


@add("t5_republish", f"WITH {_NATIONS} SELECT m AS meeting_id, count(*) AS turns, count(*) FILTER (k % 40 = 0) AS redacted, any_value(CASE WHEN d.m IS NULL THEN 1 ELSE 2 END) AS version FROM t LEFT JOIN d USING (m) GROUP BY m")
def republished(spark, sf):
    """Customers as turns of their nation; those that a stream of decisions touches are published again: turns, redacted ones, and by which write each document stands."""
    path, keys = scratch(spark), ["meeting_id", "turn_id"]
    c = table(spark, sf, "customer")
    turns = c.select(F.col("c_nationkey").alias("meeting_id"), F.format_string("t%d", "c_custkey").alias("turn_id"), F.col("c_custkey").alias("pos"), F.col("c_name").alias("text"), F.lit("A").alias("speaker_public"), F.lit(True).alias("needs_review"), F.lit(None).cast("string").alias("review_reason"))
    fields = ["turn_id", "text"]
    first = parts.replace(streams.documents(turns, None, keys, ["at"], fields), f"{path}/docs", ["meeting_id"])
    empty = F.lit("")
    decided = turns.where("pos % 40 = 0").select(*keys, F.col("pos").alias("at"), F.lit("suppress").alias("reviewer_action"), empty.alias("speaker_public_override"), empty.alias("text_override"), F.lit(True).alias("suppress"), empty.alias("evidence_note"))
    decided.write.parquet(f"{path}/in")
    stream = spark.readStream.schema(decided.schema).parquet(f"{path}/in")
    streams.republish(stream, turns, f"{path}/state", f"{path}/docs", f"{path}/checkpoint", keys, ["at"], fields).awaitTermination()
    old = parts.read(spark, f"{path}/docs", first).select("meeting_id", F.col("content").alias("old"))
    read = F.from_json("content", "turns array<struct<turn_id: string, text: string>>").alias("d")
    docs = parts.read(spark, f"{path}/docs").join(old, "meeting_id").select("meeting_id", read, F.when(F.col("content") == F.col("old"), 1).otherwise(2).alias("version"))
    return docs.select("meeting_id", F.size("d.turns").cast("long").alias("turns"), F.size(F.filter("d.turns", lambda t: t["text"] == "[REDACTED]")).cast("long").alias("redacted"), "version")


@add("c4_lineage", "SELECT o_custkey, array_to_string(list_sort(flatten(list([o_orderkey, -o_orderkey]))), ',') AS ids FROM orders GROUP BY o_custkey")
def lineage(spark, sf):
    """The lists of ids of rows that were merged, as one list."""
    ids = F.flatten(F.collect_list(F.array("o_orderkey", -F.col("o_orderkey"))))
    return table(spark, sf, "orders").groupBy("o_custkey").agg(F.array_join(F.array_sort(ids).cast("array<string>"), ",").alias("ids"))


@add("c7_map_increment", "SELECT user_id, coalesce(sum(value) FILTER (event_type = 'view'), 0) AS views, count(DISTINCT event_type) AS kinds FROM (SELECT user_id, event_type, floor(value) AS value FROM events) GROUP BY user_id")
def increments(spark, sf):
    """A map of scores by key for each user."""
    each = table(spark, sf, "events").groupBy("user_id", "event_type").agg(F.sum(F.floor("value")).cast("double").alias("n"))
    scores = each.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("m"))
    return scores.select("user_id", F.coalesce(F.try_element_at("m", F.lit("view")), F.lit(0.0)).alias("views"), F.size("m").cast("long").alias("kinds"))
