"""Scalar functions (F), projections and predicates (P), and array, map and JSON functions (C)."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnwright.functions import text as t
from turnwright.operators import labels
from turnwright.operators.headers import Council, hint_of, marker_of, split_header
from turnwright.plans.base import Plans, table

plans = Plans()
c = plans.columns

c("f1_collapse_space", "documents", "doc_id", {"x": lambda k: t.collapse(k("text"))}, {"x": "trim(regexp_replace(text, '\\s+', ' ', 'g'))"})
HMS = "printf('%02d:%02d:%02d', s // 3600, s // 60 % 60, s % 60)"
c("f2_hms", "events", "event_id", {"x": lambda k: t.hms(k("value") * 37)}, {"x": HMS.replace("s //", "CAST(floor(value * 37) AS BIGINT) //").replace("s %", "CAST(floor(value * 37) AS BIGINT) %")})
_S = "CAST(floor(value * 37) AS BIGINT)"
c("f3_short_hms", "events", "event_id", {"x": lambda k: t.short_hms(k("value") * 37), "y": lambda k: t.minutes(k("value") * 37)}, {"x": f"CASE WHEN value * 37 >= 3600 THEN {HMS.replace('s //', _S + ' //').replace('s %', _S + ' %')} ELSE printf('%02d:%02d', {_S} // 60 % 60, {_S} % 60) END", "y": f"printf('%d:%02d', {_S} // 60, {_S} % 60)"})
_MS = "CAST(floor(value * 1000) AS BIGINT)"
_VTT = f"printf('%02d:%02d:%02d.%03d', {_MS} // 3600000, {_MS} // 60000 % 60, {_MS} // 1000 % 60, {_MS} % 1000)"
c("f4_vtt_time", "events", "event_id", {"x": lambda k: t.vtt_time(F.floor(k("value") * 1000).cast("long"))}, {"x": _VTT})
c("f5_vtt_millis", "events", "event_id", {"x": lambda k: t.vtt_millis(t.vtt_time(F.floor(k("value") * 1000).cast("long")))}, {"x": _MS})
c("f6_flexible_millis", "events", "event_id", {"x": lambda k: t.flexible_millis(t.hms(k("value") * 37)), "y": lambda k: t.flexible_millis(F.concat(t.minutes(k("value") * 37), F.lit(",5")))}, {"x": f"{_S} * 1000", "y": f"{_S} * 1000"})
c("f7_duration", "orders", "o_orderkey", {"x": lambda k: t.duration(F.format_string("%02dh %02dm", k("o_orderkey") % 20, k("o_custkey") % 60)), "y": lambda k: t.duration(F.format_string("%dm", k("o_custkey") % 60))}, {"x": "CAST(o_orderkey % 20 * 3600 + o_custkey % 60 * 60 AS BIGINT)", "y": "CAST(o_custkey % 60 * 60 AS BIGINT)"})
c("f8_label_date", "orders", "o_orderkey", {"x": lambda k: t.label_date(F.date_format("o_orderdate", "MMM dd, yyyy"))}, {"x": "CAST(o_orderdate AS DATE)"})
c("f9_slug", "orders", "o_orderkey", {"x": lambda k: t.slug(k("o_orderdate"))}, {"x": "lower(strftime(o_orderdate, '%b-%d-%Y'))"})
c("f10_clip", "documents", "doc_id", {"x": lambda k: t.clip(k("text")), "y": lambda k: t.clip(k("text"), 80)}, {n: f"CASE WHEN length(text) > {m} THEN rtrim(left(text, {m - 1}), ' ') || '…' ELSE text END" for n, m in (("x", 220), ("y", 80))})
c("f12_fragment_join", "documents", "doc_id", {"x": lambda k: t.join_fragments(F.split(k("text"), "\n"))}, {"x": "trim(regexp_replace(array_to_string(list_filter(string_split(text, chr(10)), lambda p: trim(p) <> ''), ' '), '\\s+', ' ', 'g'))"})
c("f13_capitalise", "benchmark", "item_id", {"x": lambda k: t.capitalise(F.lower(k("text")))}, {"x": "upper(left(lower(text), 1)) || substr(lower(text), 2)"})
c("f14_capitalise_letter", "benchmark", "item_id", {"x": lambda k: t.capitalise_letter(F.concat(F.lit("\"12 "), F.lower(k("text"))))}, {"x": "'\"12 ' || upper(left(lower(text), 1)) || substr(lower(text), 2)"})
c("f15_title_name", "customer", "c_custkey", {"x": lambda k: t.title_name(F.regexp_replace(k("c_name"), "#", "-o'"))}, {"x": "replace(upper(left(c_name, 1)) || lower(substr(c_name, 2)), '#', '-O''')"})
c("f16_search_key", "documents", "doc_id", {"x": lambda k: t.search_key(k("text"))}, {"x": "trim(regexp_replace(regexp_replace(lower(text), '[^a-z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"})
c("f17_speaker_key", "documents", "doc_id", {"x": lambda k: t.speaker_key(k("text"))}, {"x": "regexp_replace(lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))), '[\\s\\-'']', '', 'g')"})
c("f18_safe_name", "documents", "doc_id", {"x": lambda k: t.safe_name(k("text"))}, {"x": "left(regexp_replace(regexp_replace(text, '[<>:\"/\\\\|?*]', '', 'g'), '\\s+', '_', 'g'), 100)"})
_UN = "s"
for _name, _char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&middot;", "·"), ("&copy;", "©"), ("&amp;", "&")):
    _UN = f"replace({_UN}, '{_name}', '{_char}')"
c("f19_strip_tags", "pages", "page_id", {"x": lambda k: t.strip_tags(k("html"))}, {"x": "trim(regexp_replace(" + _UN.replace("(s,", "(regexp_replace(html, '<[^>]+>', ' ', 'g'),") + ", '\\s+', ' ', 'g'))"})
c("f19_escape", "pages", "page_id", {"x": lambda k: t.escape(k("html"))}, {"x": "replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#39;')"})
c("f20_clip_id", "pages", "page_id", {"x": lambda k: t.clip_id(F.concat(F.lit("https://m.example/clip/"), k("page_id"))), "y": lambda k: t.clip_id(F.concat(F.lit("https://m.example/p?x=1&clip_id="), k("page_id"))), "z": lambda k: t.clip_id(k("url"))}, {"x": "page_id", "y": "page_id", "z": "CAST(NULL AS BIGINT)"})
c("f21_deep_link", "events", "event_id", {"x": lambda k: t.deep_link(k("event_type"), k("value"), F.lit("a b&c"))}, {"x": "'transcripts/' || event_type || '.html?q=a+b%26c#t=' || CAST(floor(value) AS BIGINT)"})
c("f22_citation", "documents", "doc_id", {"x": lambda k: t.citation(k("source"), F.lit("January 6, 2026"), k("lang"), k("n_chars"), k("text"), F.lit("https://m.example"))}, {"x": """source || chr(10) || 'Date: January 6, 2026' || chr(10) || 'Speaker: ' || lang || chr(10) || 'Time: ' || CASE WHEN n_chars >= 3600 THEN printf('%02d:', n_chars // 3600) ELSE '' END || printf('%02d:%02d', n_chars // 60 % 60, n_chars % 60)
 || chr(10) || '"' || CASE WHEN length(trim(regexp_replace(text, '\\s+', ' ', 'g'))) > 400 THEN rtrim(left(trim(regexp_replace(text, '\\s+', ' ', 'g')), 399)) || '…' ELSE trim(regexp_replace(text, '\\s+', ' ', 'g')) END || '"' || chr(10) || 'https://m.example'"""})
c("f23_hint_key", "documents", "doc_id", {"x": lambda k: t.hint_key(k("text"))}, {"x": "trim(regexp_replace(regexp_replace(lower(text), '[^a-z\\-'' ]', ' ', 'g'), ' +', ' ', 'g'))"})
c("f27_label_only", "customer", "c_custkey", {"x": lambda k: t.label_only(F.concat(F.lit("Mayor "), F.translate(k("c_name"), "#0123456789", ""), F.when(k("c_custkey") % 2 == 0, " speaks up loudly").otherwise(".")))}, {"x": "c_custkey % 2 <> 0"})
c("f29_hint_strength", "events", "event_id", {"x": lambda k: t.hint_strength(k("event_id") % 3 == 0, k("event_id") % 5 == 0, k("event_id") % 7 == 0, k("event_id") % 11 == 0)}, {"x": "CASE WHEN event_id % 5 = 0 THEN 'explicit' WHEN event_id % 3 = 0 THEN 'marker' WHEN event_id % 7 = 0 THEN 'inline' WHEN event_id % 11 = 0 THEN 'inline_loose' ELSE '' END"})
c("f32_handoff_thanks", "customer", "c_custkey", {"x": lambda k: t.handed_to(F.concat(F.lit("I will turn it over to Ms "), F.regexp_replace(k("c_name"), "#.*", ""), F.lit(", please"))), "y": lambda k: t.thanked(F.concat(F.lit("Thank you, "), k("c_name")))}, {"x": "regexp_replace(c_name, '#.*', '')", "y": "regexp_replace(c_name, '#.*', '')"})
c("f33_keyword_score", "documents", "doc_id", {"x": lambda k: t.count_of(F.lower(k("text")), ("and", "the ", "edthe", "le ", "zzz"))}, {"x": " + ".join(f"CAST(contains(lower(text), '{w}') AS INTEGER)" for w in ("and", "the ", "edthe", "le ", "zzz"))})
c("f34_self_id", "customer", "c_custkey", {"x": lambda k: t.self_id(F.concat(F.lit("Now Councilmember Ben Ito of "), k("c_name"))), "y": lambda k: t.self_id(k("c_name"))}, {"x": "'Ben Ito'", "y": "''"})
c("f36_titled", "nation", "n_nationkey", {"x": lambda k: t.titled(k("n_name"), F.when(k("n_regionkey") == 1, "Mayor").otherwise("Member"))}, {"x": "CASE WHEN n_regionkey = 1 THEN 'Mayor ' || n_name ELSE n_name END"})
c("f37_agenda_item", "orders", "o_orderkey", {"x": lambda k: t.agenda_item(F.concat(F.lit("Item number "), k("o_custkey"))), "y": lambda k: t.agenda_item(F.when(k("o_custkey") % 2 == 0, "A Public Hearing").otherwise("none"))}, {"x": "CAST(o_custkey AS VARCHAR)", "y": "CASE WHEN o_custkey % 2 = 0 THEN 'public hearing' END"})
_STOP = ", ".join(f"'{w}'" for w in t.STOP_WORDS)
_KEY = "trim(regexp_replace(regexp_replace(lower(text), '[^a-z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"
c("f38_tokens", "documents", "doc_id", {"x": lambda k: F.array_join(t.tokens(k("text")), " ")}, {"x": f"array_to_string(list_filter(string_split({_KEY}, ' '), lambda w: length(w) > 2 AND w NOT IN ({_STOP})), ' ')"})
c("f42_relevance", "documents", "doc_id", {"x": lambda k: t.relevance(k("text"), "of the")}, {"x": "CASE WHEN contains(lower(text), 'of the') THEN 500 + greatest(0, 200 - least(200, CAST(strpos(lower(text), 'of the') AS INTEGER) - 1)) ELSE 0 END + CASE WHEN contains(lower(text), 'of') THEN 40 ELSE 0 END + CASE WHEN contains(lower(text), 'the') THEN 40 ELSE 0 END"})
c("f43_highlight", "documents", "doc_id", {"x": lambda k: t.highlight(k("text"), "the")}, {"x": "regexp_replace(text, '(the)', '<mark>\\1</mark>', 'gi')"})
c("f45_continues", "documents", "doc_id", {"x": lambda k: t.continues(k("text"))}, {"x": "regexp_matches(text, '^\\s*\\p{Ll}') OR lower(regexp_extract(text, '^\\s*(\\S+)', 1)) IN ('and', 'but', 'so', 'or', 'nor')"})
c("f46_unit", "events", "event_id", {"x": lambda k: t.seconds_of(k("value"), k("event_id"), F.lit(100)) }, {"x": "CASE WHEN event_id > 1000 THEN value / 1000 ELSE value END"})
c("f47_review_reason", "events", "event_id", {"x": lambda k: t.review_reason(k("event_type"), F.when(k("event_id") % 2 == 0, k("props")).otherwise(" "))}, {"x": "'reviewed:' || event_type || CASE WHEN event_id % 2 = 0 THEN ' | ' || props ELSE '' END"})
c("f48_csv_field", "events", "event_id", {"x": lambda k: t.csv_field(k("props")), "y": lambda k: t.csv_field(k("event_type"))}, {"x": "'\"' || replace(props, '\"', '\"\"') || '\"'", "y": "event_type"})
c("f49_base64_json", "events", "event_id", {"x": lambda k: F.base64(k("props").cast("binary")), "y": lambda k: F.get_json_object(F.unbase64(F.base64(k("props").cast("binary"))).cast("string"), "$.k").cast("int")}, {"x": "base64(encode(props))", "y": "CAST(json_extract_string(props, '$.k') AS INTEGER)"})
c("f50_stable_id", "events", "event_id", {"x": lambda k: t.stable_id(k("user_id").cast("string"), k("event_type"))}, {"x": "left(sha256(user_id || '|' || event_type), 16)"})
c("f53_long_date", "orders", "o_orderkey", {"x": lambda k: t.long_date(k("o_orderdate"))}, {"x": "strftime(o_orderdate, '%B %-d, %Y')"})
c("f54_rebase", "pages", "page_id", {"x": lambda k: t.rebase(k("url"), "https://", "/data/"), }, {"x": "CASE WHEN starts_with(url, 'https://') THEN '/data/' || substr(url, 9) ELSE url END"})
c("f55_rounded", "lineitem", "l_orderkey", {"l_linenumber": lambda k: k("l_linenumber"), "x": lambda k: t.rounded(k("l_extendedprice") * k("l_discount"), 2)}, {"l_linenumber": "l_linenumber", "x": "floor(l_extendedprice * l_discount * 100 + 0.5) / 100"})

# projections and predicates
c("p1_block_turn", "events", "event_id", {n: lambda k, n=n: labels.block_turn(F.nullif(k("event_type"), F.lit("view")), k("value") < 10)[n] for n in ("speaker_public", "speaker_status", "needs_review")}, {"speaker_public": "coalesce(nullif(event_type, 'view'), 'Unknown Speaker')", "speaker_status": "CASE WHEN value < 10 THEN 'unresolved' ELSE 'approved' END", "needs_review": "value < 10"})
c("p2_utterance_turn", "events", "event_id", {n: lambda k, n=n: labels.utterance_turn(F.when(k("event_id") % 2 == 0, F.concat(F.lit("Unknown "), k("event_type"))).otherwise(k("event_type")))[n] for n in ("status", "confidence")}, {"status": "CASE WHEN event_id % 2 = 0 THEN 'unresolved' ELSE 'approved' END", "confidence": "CASE WHEN event_id % 2 = 0 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END"})
c("p3_publish", "events", "event_id", {"speaker": lambda k: labels.effective_speaker(F.when(k("event_id") % 3 == 0, "").otherwise(k("event_type")), F.when(k("event_id") % 2 == 0, "Public").otherwise(""))}, {"speaker": "CASE WHEN event_id % 3 <> 0 THEN event_type WHEN event_id % 2 = 0 THEN 'Public' ELSE 'Unknown Speaker' END"})
_STRENGTH = {"view": "explicit", "click": "inline_loose", "error": "marker", "purchase": "diarization"}
c("p4_provenance", "events", "event_id", {n: lambda k, n=n: labels.provenance(F.when(k("event_id") % 5 == 0, " ").otherwise(k("props")), F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in _STRENGTH.items() for x in kv)), k("event_type")), F.lit("")))[n] for n in ("speaker_source", "speaker_source_detail")}, {"speaker_source": "CASE WHEN event_id % 5 = 0 THEN 'unknown' WHEN event_type IN ('view', 'click') THEN 'captions' WHEN event_type = 'purchase' THEN 'diarization' ELSE 'unknown' END", "speaker_source_detail": "CASE event_type WHEN 'view' THEN 'Captions (explicit speaker tag)' WHEN 'click' THEN 'Captions (inline header, loose)' WHEN 'error' THEN 'Captions (standalone marker cue)' WHEN 'purchase' THEN 'Diarization (mapped from caption tags)' ELSE '' END"})
c("p6_needs_review", "events", "event_id", {"x": lambda k: labels.needs_review(k("value") < 5, k("event_type") == "error", k("value") / 490)}, {"x": "value < 5 OR event_type = 'error' OR value / 490 < 0.85"})
c("p8_known_unknown", "events", "event_id", {"unknown": lambda k: labels.is_unknown(F.when(k("event_type") == "error", "unknown").otherwise("approved"), F.when(k("event_type") == "signup", "Unknown").otherwise("S1")), "confirmed": lambda k: labels.is_confirmed(F.when(k("event_type") == "view", "approved").when(k("event_type") == "click", "mixed").otherwise("unresolved"), F.when(k("event_id") % 3 == 0, "").otherwise(k("props")))}, {"unknown": "event_type IN ('error', 'signup')", "confirmed": "event_type IN ('view', 'click') AND event_id % 3 <> 0"})
c("p9_top_level", "orders", "o_orderkey", {"x": lambda k: labels.top_level(F.concat(F.when(k("o_orderkey") % 2 == 0, F.concat(k("o_custkey"), F.lit(". "))).otherwise("a. "), k("o_orderpriority")))}, {"x": "o_orderkey % 2 = 0"})
c("p11_watermark", "pages", "page_id", {"x": lambda k: labels.watermark(k("url"))}, {"x": "regexp_matches(url, '(?i)www\\.|captioning|\\(\\d{3}\\)\\s*\\d{3}-\\d{4}|\\d{3}-\\d{3}-\\d{4}')"})
c("p17_speaker_norm", "events", "event_id", {"x": lambda k: labels.normal_speaker(F.when(k("event_type") == "error", " Unknown").when(k("event_type") == "view", "SPEAKER").when(k("event_id") % 7 == 0, F.lit(None)).otherwise(k("event_type")))}, {"x": "CASE WHEN event_type IN ('error', 'view') OR event_id % 7 = 0 THEN 'Unknown Speaker' ELSE event_type END"})
c("p18_role_class", "part", "p_partkey", {"x": lambda k: labels.role_class(F.concat(F.when(F.contains(k("p_type"), F.lit("STEEL")), "Mayor ").when(F.contains(k("p_type"), F.lit("BRASS")), "Council ").when(F.contains(k("p_type"), F.lit("TIN")), "City Manager ").otherwise(""), k("p_type")))}, {"x": "CASE WHEN contains(p_type, 'STEEL') THEN 'mayor' WHEN contains(p_type, 'BRASS') THEN 'council' WHEN contains(p_type, 'TIN') THEN 'manager' ELSE 'public' END"})
c("p19_meeting_type", "part", "p_partkey", {"x": lambda k: labels.meeting_type(F.concat(k("p_type"), F.when(F.contains(k("p_type"), F.lit("PROMO")), " Work Session").when(F.contains(k("p_type"), F.lit("ECONOMY")), " Special Meeting").when(F.contains(k("p_type"), F.lit("SMALL")), " Public Hearing").when(F.contains(k("p_type"), F.lit("LARGE")), " Retreat").otherwise(" Meeting")))}, {"x": "CASE WHEN contains(p_type, 'PROMO') THEN 'work_session' WHEN contains(p_type, 'ECONOMY') THEN 'special' WHEN contains(p_type, 'SMALL') THEN 'public_hearing' WHEN contains(p_type, 'LARGE') THEN 'other' ELSE 'regular' END"})
_P22 = lambda k: labels.label_priority(F.when(k("event_id") % 7 == 0, "approved").when(k("event_id") % 5 == 0, "public_comment").when(k("event_id") % 3 == 0, "rejected_audio").otherwise(""), F.lit("Ada Moss"), F.when(k("event_type") == "view", "Caption"), F.lit("inline"), F.when(k("value") > 100, "Heuristic"), F.when(k("event_type") == "error", "UNKNOWN").otherwise("S1"))
c("p22_label_priority", "events", "event_id", {n: lambda k, n=n: _P22(k)[n] for n in ("label", "status", "review", "reason")}, {"label": "CASE WHEN event_id % 7 = 0 OR event_id % 5 = 0 THEN 'Ada Moss' WHEN event_id % 3 = 0 THEN 'Unknown Speaker' WHEN event_type = 'view' THEN 'Caption' WHEN value > 100 THEN 'Heuristic' ELSE 'Unknown Speaker' END", "status": "CASE WHEN event_id % 7 = 0 THEN 'approved' WHEN event_id % 5 = 0 THEN 'public_comment' WHEN event_id % 3 = 0 THEN 'mixed' WHEN event_type = 'view' THEN 'caption_override' WHEN value > 100 THEN 'heuristic' WHEN event_type = 'error' THEN 'unknown' ELSE 'unresolved' END", "review": "CASE WHEN event_id % 7 = 0 OR event_id % 5 = 0 THEN false WHEN event_id % 3 = 0 THEN true ELSE NOT (event_type = 'view' OR value > 100) END", "reason": "CASE WHEN event_id % 7 = 0 THEN '' WHEN event_id % 5 = 0 THEN 'public_comment' WHEN event_id % 3 = 0 THEN 'mixed_or_rejected_audio' WHEN event_type = 'view' THEN 'caption:inline' WHEN value > 100 THEN 'text_heuristic' WHEN event_type = 'error' THEN 'no_diarization' ELSE 'unresolved_identity' END"})
_KIND = lambda k: F.when(k("event_type") == "view", "council").when(k("event_type") == "click", "staff").when(k("event_type") == "error", "public_comment").when(k("event_type") == "signup", "unknown").otherwise("")
c("p26_modal_decision", "events", "event_id", {n: lambda k, n=n: labels.modal_decision(_KIND(k), F.when(k("event_id") % 2 == 0, "Ada Moss").otherwise(""))[n] for n in ("reviewer_action", "speaker_type", "speaker_public_override", "speaker_status_override")}, {"reviewer_action": "CASE WHEN event_type IN ('view', 'click') THEN 'approve_named_official' WHEN event_type = 'error' THEN 'mark_public_comment' ELSE 'keep_unknown' END", "speaker_type": "CASE event_type WHEN 'view' THEN 'council' WHEN 'click' THEN 'staff' WHEN 'error' THEN 'public_comment' WHEN 'signup' THEN 'unknown' ELSE '' END", "speaker_public_override": "CASE WHEN event_type IN ('view', 'click') AND event_id % 2 = 0 THEN 'Ada Moss' WHEN event_type = 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'Ada Moss' ELSE 'Public Comment Speaker' END ELSE '' END", "speaker_status_override": "CASE WHEN event_type IN ('view', 'click', 'error') THEN 'approved' ELSE '' END"})

# arrays, maps, JSON
_LINES = "list_filter(string_split(text, chr(10)), lambda p: p <> '')"
c("c2_slice", "documents", "doc_id", {"x": lambda k: F.array_join(F.slice(F.split(k("text"), " "), 1, 3), "/")}, {"x": "array_to_string(string_split(text, ' ')[1:3], '/')"})
c("c3_any_all", "documents", "doc_id", {"x": lambda k: F.exists(F.split(k("text"), " "), lambda w: w == "the"), "y": lambda k: F.forall(F.split(k("text"), " "), lambda w: F.length(w) < 12)}, {"x": "list_contains(string_split(text, ' '), 'the')", "y": "len(list_filter(string_split(text, ' '), lambda w: length(w) >= 12)) = 0"})
c("c5_array_sort", "documents", "doc_id", {"x": lambda k: F.array_join(F.slice(F.array_sort(F.transform(F.array_distinct(F.split(F.lower(k("text")), r"[^a-z]+")), lambda w: F.struct((-F.length(w)).alias("n"), w.alias("w")))).getField("w"), 1, 3), " ")}, {"x": "array_to_string(list_transform(list_sort(list_transform(list_distinct(regexp_split_to_array(lower(text), '[^a-z]+')), lambda w: {'n': -length(w), 'w': w}))[1:3], lambda s: s.w), ' ')"})
c("c6_map_lookup", "events", "event_id", {"x": lambda k: F.coalesce(F.element_at(F.create_map(*(F.lit(v) for v in ("view", "v", "click", "c"))), k("event_type")), F.lit("?"))}, {"x": "CASE event_type WHEN 'view' THEN 'v' WHEN 'click' THEN 'c' ELSE '?' END"})
c("c8_json", "events", "event_id", {"x": lambda k: F.from_json(k("props"), "k int").getField("k"), "y": lambda k: F.to_json(F.struct(k("user_id").alias("u"), k("event_type").alias("t")))}, {"x": "CAST(json_extract_string(props, '$.k') AS INTEGER)", "y": "'{\"u\":' || user_id || ',\"t\":\"' || event_type || '\"}'"})
c("c9_json_default", "events", "event_id", {"x": lambda k: F.coalesce(F.get_json_object(k("props"), "$.z"), F.get_json_object(k("props"), "$.k"), F.lit("-"))}, {"x": "coalesce(json_extract_string(props, '$.z'), json_extract_string(props, '$.k'), '-')"})
c("c10_split_field", "documents", "doc_id", {"x": lambda k: F.array_join(F.transform(F.split(k("text"), ","), lambda p: F.trim(p)), ";")}, {"x": "array_to_string(list_transform(string_split(text, ','), lambda p: trim(p, ' ')), ';')"})
c("c11_struct_merge", "nation", "n_nationkey", {"x": lambda k: F.to_json(F.struct(k("n_name").alias("name"), k("n_regionkey").alias("region")).withField("extra", F.lit(1)))}, {"x": "'{\"name\":\"' || n_name || '\",\"region\":' || n_regionkey || ',\"extra\":1}'"})


@plans.add("c1_explode", "SELECT doc_id, CAST(i AS INTEGER) AS pos, word FROM (SELECT doc_id, unnest(range(len(w))) AS i, unnest(w) AS word FROM (SELECT doc_id, string_split(text, ' ') AS w FROM documents))")
def explode(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", " ")).alias("pos", "word"))


@plans.add("f11_token_join", "SELECT doc_id, array_to_string(list_transform(w, lambda t, i: CASE WHEN i = 1 OR left(t, 1) IN (chr(39), '.', ',') OR t IN ('!', '?', ':', ';') THEN t ELSE ' ' || t END), '') AS x FROM (SELECT doc_id, regexp_split_to_array(regexp_replace(text, '([.,!?:;])(\\s|$)', ' \\1\\2', 'g'), '\\s+') AS w FROM documents)")
def token_join(spark, sf):
    apart = F.regexp_replace("text", r"([.,!?:;])(\s|$)", " $1$2")
    return table(spark, sf, "documents").select("doc_id", t.join_tokens(F.split(apart, r"\s+")).alias("x"))


# names and sentences made of a part's own columns; the SQL builds the sentence likewise and takes it apart by plain patterns
_NAME = "array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || w[2:]), ' ')"
_INTRO = f"CASE p_partkey % 5 WHEN 0 THEN 'Good evening. My name is ' || {_NAME} || ', part ' || p_partkey WHEN 1 THEN 'I''m going; i am ' || {_NAME} || ' the first' WHEN 2 THEN 'this is ' || {_NAME} || '. ' || p_size WHEN 3 THEN 'my name is ' || p_name ELSE 'This is the ' || {_NAME} END"
INTRO_SQL = f"i AS (SELECT p_partkey, p_brand, nullif(rtrim(regexp_extract({_INTRO}, '(?:[Mm]y name is|i am|this is) ((?:[A-Z][a-z]+ ?)+)', 1)), '') AS heard FROM part)"


def _chosen(*forms):
    """By a part's key, one form or the other."""
    return F.element_at(F.array(*forms), (F.col("p_partkey") % len(forms) + 1).cast("int"))


def introduced(spark, sf):
    """Parts with a sentence in which some say who they are."""
    name = F.initcap("p_name")
    says = _chosen(F.concat(F.lit("Good evening. My name is "), name, F.lit(", part "), "p_partkey"), F.concat(F.lit("I'm going; i am "), name, F.lit(" the first")), F.concat(F.lit("this is "), name, F.lit(". "), "p_size"), F.concat(F.lit("my name is "), "p_name"), F.concat(F.lit("This is the "), name))
    return table(spark, sf, "part").withColumn("text", says)


@plans.add("f31_self_intro", f"WITH {INTRO_SQL} SELECT p_partkey, heard AS x FROM i")
def self_intro(spark, sf):
    return introduced(spark, sf).select("p_partkey", t.self_intro(F.col("text")).alias("x"))


@plans.add("f35_evidence", f"WITH n AS (SELECT p_partkey, p_partkey % 4 AS k, {_NAME} AS name FROM part), e AS (SELECT p_partkey, name, 'self_intro' AS reason, 5 AS weight FROM n WHERE k = 0 UNION ALL SELECT p_partkey, name, 'self_intro', 4 FROM n WHERE k = 1 UNION ALL SELECT p_partkey, name || ' Dole', 'opening_intro_with_context', 4 FROM n WHERE k = 2 UNION ALL SELECT p_partkey, name || ' Dole', 'opening_intro', 3 FROM n WHERE k = 3) SELECT * FROM e")
def evidence(spark, sf):
    from turnwright.operators.resolve import evidence as find

    name = F.initcap("p_name")
    says = _chosen(F.concat(F.lit("well my name is "), name, F.lit(" and part "), "p_partkey"), F.concat(F.lit("now this is "), name, F.lit(" ok")), F.concat(F.lit("Good evening, "), name, F.lit(" Dole, I live here")), F.concat(F.lit("Good evening, "), name, F.lit(" Dole, part "), "p_partkey"))
    return find(table(spark, sf, "part").select("p_partkey", says.alias("text")), "text").select("p_partkey", "name", "reason", "weight")


_VERBS = "v AS (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'So I Think that ' || p_name || ' I Am I Think ' || p_type WHEN 1 THEN p_name || '. I Know ' || p_type || ' and I Know it' ELSE p_type || ' I Know ' || p_name || '. I Think so' END AS t FROM part)"


@plans.add("f44_small_verbs", f"WITH {_VERBS} SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN regexp_replace(regexp_replace(t, 'I Think ', 'I think '), 'I Am ', 'I am ') ELSE regexp_replace(t, '([^.!?\" ] +I) Know ', '\\1 know ') END AS x FROM v WHERE p_partkey % 3 <> 1 UNION ALL SELECT p_partkey, t FROM v WHERE p_partkey % 3 = 1")
def small_verbs(spark, sf):
    says = _chosen(F.concat(F.lit("So I Think that "), "p_name", F.lit(" I Am I Think "), "p_type"), F.concat("p_name", F.lit(". I Know "), "p_type", F.lit(" and I Know it")), F.concat("p_type", F.lit(" I Know "), "p_name", F.lit(". I Think so")))
    return table(spark, sf, "part").select("p_partkey", t.small_verbs(says).alias("x"))


_CALL = f"c AS (SELECT p_partkey, 'Council Member ' || split_part({_NAME}, ' ', 1) || '? ' || (['Aye', 'nay', 'No'])[p_partkey % 3 + 1] || '. Council Ms. ' || {_NAME} || ': No. ' || (['The motion passed ' || p_size || ' to ' || p_size % 7, 'It was adopted by ' || p_size || ' 2', 'All were Unanimous', 'A tie vote', 'On to ' || p_name])[p_partkey % 5 + 1] AS t FROM part)"


@plans.add("f51_f52_roll_call", f"WITH {_CALL} SELECT p_partkey, CAST(len(regexp_extract_all(t, '(Member|Ms\\.) [A-Za-z ]+[?:] (Aye|No)\\b')) AS INTEGER) AS n, regexp_extract(t, '(?:Member|Ms\\.) ([A-Za-z ]+)[?:] (?:Aye|No)\\b', 1) AS first_name, nullif(regexp_extract(t, 'motion passed [0-9]+ to [0-9]+|adopted by [0-9]+ 2|Unanimous|tie vote'), '') AS outcome FROM c")
def roll_call(spark, sf):
    name = F.initcap("p_name")
    size = F.col("p_size").cast("string")
    ends = _chosen(F.concat(F.lit("The motion passed "), size, F.lit(" to "), (F.col("p_size") % 7).cast("string")), F.concat(F.lit("It was adopted by "), size, F.lit(" 2")), F.lit("All were Unanimous"), F.lit("A tie vote"), F.concat(F.lit("On to "), "p_name"))
    says = F.concat(F.lit("Council Member "), F.substring_index(name, " ", 1), F.lit("? "), _chosen(F.lit("Aye"), F.lit("nay"), F.lit("No")), F.lit(". Council Ms. "), name, F.lit(": No. "), ends)
    names = F.regexp_extract_all(says, F.lit(t.ROLL_CALL), 2)
    return table(spark, sf, "part").select("p_partkey", F.size(names).alias("n"), F.get(names, F.lit(0)).alias("first_name"), t.outcome(says).alias("outcome"))


@plans.add("f41_word_error_rate")
def word_error_rate(spark, sf):
    from turnwright.operators.evaluate import packed, wer, with_next

    return with_next(table(spark, sf, "documents").select("doc_id", packed("text").alias("ref")), "doc_id", "ref", "hyp").select("doc_id", wer("ref", "hyp").alias("wer"))


COUNCIL = Council({"anders": "Ann Anders", "holt": "Sy Holt", "hart-collins": "Sy Hart-Collins", "pryor": "Tim Pryor"}, ("moss", "Ada Moss"), ("dole", "Cy Dole"))
_TITLES = ("Councilmember", "Council member", "councilwoman", "Mayor", "City Manager")
_HEARD = ("Holt", "HOL", "Hart Collins", "Zzz", "Moss", "pern", "Dole")
#: What each heard name is, said after a member's title.
_MEMBERS = {"Holt": "Sy Holt", "HOL": "Sy Holt", "Hart Collins": "Sy Hart-Collins", "pern": "Tim Pryor"}
_STOPS = (". ", ": ", ", ", " ")
_LIST = lambda values: "[" + ", ".join(f"'{v}'" for v in values) + "]"
_SAID = f"c AS (SELECT c_custkey, c_name, ({_LIST(_TITLES)})[c_custkey % 5 + 1] AS title, ({_LIST(_HEARD)})[c_custkey // 5 % 7 + 1] AS heard, ({_LIST(_STOPS)})[c_custkey // 35 % 4 + 1] AS stop FROM customer)"
_MEMBER_SQL = "CASE heard " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _MEMBERS.items()) + " ELSE '' END"


def _said(spark, sf):
    """Customers with a title, a name as heard and what stands between these and the rest, in all combinations."""
    pick = lambda values, by: F.element_at(F.array(*map(F.lit, values)), (F.floor(F.col("c_custkey") / by) % len(values) + 1).cast("int"))
    return table(spark, sf, "customer").select("c_custkey", "c_name", pick(_TITLES, 1).alias("title"), pick(_HEARD, 5).alias("heard"), pick(_STOPS, 35).alias("stop"))


@plans.add("f24_f28_roster_match", f"""WITH {_SAID}, k AS (SELECT *, {_MEMBER_SQL} AS member FROM c), l AS (SELECT *, CASE WHEN heard = 'Hart Collins' THEN 'Sy Hart-Collins' WHEN heard = 'Dole' THEN '' ELSE member END AS match,
 CASE WHEN title = 'Mayor' THEN CASE WHEN heard = 'Moss' THEN 'Mayor Ada Moss' ELSE '' END WHEN title = 'City Manager' THEN CASE WHEN heard = 'Dole' THEN 'City Manager Cy Dole' ELSE '' END WHEN member <> '' AND heard <> 'Hart Collins' THEN 'Councilmember ' || member ELSE '' END AS label FROM k)
 SELECT c_custkey, match, label AS hint, CASE WHEN title <> 'City Manager' AND c_custkey % 2 = 0 THEN label ELSE '' END AS marker FROM l""")
def roster_match(spark, sf):
    """Names matched with a roster, labels that lines begin with, and labels that lines are: every other line goes on."""
    from turnwright.operators.resolve import fuzzy_roster

    line = F.concat_ws(" ", "title", F.col("heard"), F.when(F.col("c_custkey") % 2 == 1, F.concat(F.lit("of "), "c_name")))
    df = _said(spark, sf).select("c_custkey", F.lower(F.regexp_replace("heard", " ", "-")).alias("heard"), line.alias("line"))
    return df.select("c_custkey", fuzzy_roster("heard", COUNCIL.members).alias("match"), hint_of(COUNCIL, "line").alias("hint"), marker_of(COUNCIL, "line").alias("marker"))


@plans.add("f25_f26_inline_header", f"""WITH {_SAID}, k AS (SELECT *, title || ' ' || heard || stop || CASE WHEN stop = ' ' THEN 'yes ' || substr(c_name, 10) ELSE c_name END AS line, {_MEMBER_SQL} AS member FROM c),
 l AS (SELECT *, CASE WHEN title = 'Mayor' AND heard = 'Moss' AND stop <> ' ' THEN 'Mayor Ada Moss' WHEN title IN ('Councilmember', 'Council member', 'councilwoman') AND member <> '' AND (stop IN ('. ', ': ') OR stop = ' ' AND title <> 'councilwoman') THEN 'Councilmember ' || member ELSE '' END AS label FROM k)
 SELECT c_custkey, label, CASE WHEN label = '' THEN line WHEN stop = ' ' THEN CASE WHEN heard = 'Hart Collins' THEN 'yes ' ELSE '' END || substr(c_name, 10) WHEN title = 'councilwoman' THEN trim(regexp_replace(lower(c_name), '[^a-z0-9]', ' ', 'g')) ELSE c_name END AS rest, CASE WHEN label = '' THEN '' WHEN stop = ' ' THEN 'inline_loose' ELSE 'inline' END AS strength FROM l""")
def inline_header(spark, sf):
    line = F.concat("title", F.lit(" "), "heard", "stop", F.when(F.col("stop") == " ", F.concat(F.lit("yes "), F.substr("c_name", F.lit(10)))).otherwise(F.col("c_name")))
    return split_header(_said(spark, sf).withColumn("line", line), "line", COUNCIL, "label").select("c_custkey", "label", "rest", "strength")


@plans.add("p7_queue_predicate", "SELECT doc_id, doc_id % 11 = 0 OR len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')) <= 3 OR contains(lower(text), 'even more oh') OR contains(lower(text), 'has the name') OR contains(lower(text), '. i') AS x FROM documents")
def queue_predicate(spark, sf):
    from turnwright.operators.review import needs_queue

    status = F.when(F.col("lang") == "de", "unresolved").otherwise("approved")
    d = table(spark, sf, "documents").select("doc_id", "text", status.alias("speaker_status"), F.when(F.col("doc_id") % 11 == 0, True).alias("needs_review"))
    return d.select("doc_id", needs_queue().alias("x"))


@plans.add("p29_coercion", "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, coalesce(TRY_CAST(props AS DOUBLE), 0.5) AS half, coalesce(CASE WHEN event_id % 3 = 0 THEN CAST(user_id AS VARCHAR) END, 'none') AS word FROM events WHERE event_id % 13 <> 0")
def coercion(spark, sf):
    e = table(spark, sf, "events").select(F.when(F.col("event_id") % 13 == 0, "x").otherwise(F.col("event_id").cast("string")).alias("event_id"), F.get_json_object("props", "$.k").alias("k"), F.col("props").alias("half"), F.when(F.col("event_id") % 3 == 0, F.col("user_id")).alias("word"))
    return labels.coerced(e, {"event_id": ("long", None), "k": ("long", None), "half": ("double", 0.5), "word": ("string", "none")}, ["event_id"])


ROSTER = {"Ada Moss": "Mayor", "Ben Ito": "Member", "Cy Dole": "City Manager"}
SAYS = ("Good evening, ada moss here", "As mayor I ask", "council member ben said it", "then thank you, Cy", "We call the meeting", "we go on with it", "Nobody knows", "")


@plans.add("f30_speaker_from_text", f"WITH s AS (SELECT o_custkey, o_orderkey, o_orderkey % {len(SAYS)} AS k FROM orders), o AS (SELECT *, CASE k WHEN 0 THEN 'Mayor Ada Moss' WHEN 1 THEN 'Mayor Ada Moss' WHEN 2 THEN 'Ben Ito' WHEN 3 THEN 'Cy Dole' WHEN 4 THEN 'Mayor Ada Moss' END AS own FROM s), b AS (SELECT *, last_value(CASE WHEN k <> 5 THEN coalesce(own, '') END IGNORE NULLS) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior FROM o) SELECT o_orderkey, CASE WHEN k = 5 AND prior = 'Mayor Ada Moss' THEN prior ELSE own END AS speaker FROM b")
def from_text(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", F.element_at(F.array(*(F.lit(x) for x in SAYS)), (F.col("o_orderkey") % len(SAYS) + 1).cast("int")).alias("text"))
    return labels.label_from_text(o, ["o_custkey"], ["o_orderkey"], "text", ROSTER, "Ada Moss", "speaker").select("o_orderkey", "speaker")
