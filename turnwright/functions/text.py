"""Text, time and format functions of transcripts, all in built-in Column expressions.

Each works on null as Spark's built-ins do: null in, null out, unless said otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Word lists that decide results.
STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself it its itself "
    "they them their theirs themselves what which who whom this that these those am is are was were be been being have has had having "
    "do does did doing a an the and but if or because as until while of at by for with about against between into through during before after "
    "above below to from up down in out on off over under again further then once here there when where why how all each few more most other some such "
    "no nor not only own same so than too very s t can will just don should now d ll m o re ve y ain aren couldn didn doesn hadn hasn haven isn ma mightn "
    "mustn needn shan shouldn wasn weren won wouldn"
).split()
AUXILIARIES = "going to be get have do will would could should need want know think see say tell ask help make let just also really not never always ever still yet now here trying planning glad sorry".split()
NOT_NAMES = "the a an this that it what such".split()
SMALL_VERBS = "Am Think Want Know See Hope Believe Feel Guess Assume Remember Understand Recalled".split()
CONJUNCTIONS = ("and", "but", "so", "or", "nor")
CHAIR_PHRASES = ("good evening", "call to order", " work session", " work session.", "first item", "recognize ", " motion ", " seconded", "roll call", "public comment", "close ", "city council", "council chambers", "parliamentary", "rezoning", "ordinance")
STAFF_PHRASES = ("director", "manager", "chief ", "presenting", "presentation", "budget", "parks", "recreation", "special events", "police", "finance", "planning", "city manager", "assistant city manager")
HANDOFF = r"(?i)(?:turn\s+it\s+over\s+to\s+(?:(?:miss|mr|mrs|ms|dr)\s+)?|hand\s+(?:it\s+)?over\s+to\s+(?:(?:miss|mr|mrs|ms|dr)\s+)?|pass\s+(?:it\s+)?to\s+(?:(?:miss|mr|mrs|ms|dr)\s+)?|=>>\s*)\s*([A-Z][a-z]+(?:\s+[A-Z][a-z]+)?)"
THANKS = r"(?i)(?:thank\s+you[.,!?\s]*|thanks[.,!?\s]*)([A-Z][a-z]+)"
ROLL_CALL = r"(?i)Council\s*(Member|Mr\.|Ms\.)\s+(\w+(?:\s+\w+)?)\s*[?:]\s*(Aye|No|I)\b"
OUTCOMES = (r"(?i)(?:passed|approved|adopted)\s+(?:unanimously|by\s+\d+[\s-]+\d+)", r"(?i)motion\s+(?:passed|failed|fails?)\s*(?:\d+\s+to\s+\d+|\d+\s+-\s+\d+)", r"(?i)unanimous(?:ly)?", r"(?i)tie\s+vote", r"(?i)(?:\d+)\s+to\s+(?:\d+)")


def any_of(text: Column, phrases) -> Column:
    """Whether text contains one of the phrases."""
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(p)) for p in phrases])


def count_of(text: Column, phrases) -> Column:
    """how many of the phrases text contains."""
    return reduce(lambda a, b: a + b, [F.contains(text, F.lit(p)).cast("int") for p in phrases])


def collapse(x: Column) -> Column:
    """white space runs as one space, trimmed."""
    return F.trim(F.regexp_replace(x, r"\s+", " "))


def hms(seconds: Column) -> Column:
    """HH:MM:SS, floored, not below 0."""
    s = F.greatest(F.floor(seconds), F.lit(0)).cast("long")
    return F.format_string("%02d:%02d:%02d", F.floor(s / 3600).cast("long"), F.pmod(F.floor(s / 60).cast("long"), F.lit(60)), F.pmod(s, F.lit(60)))


def short_hms(seconds: Column) -> Column:
    """MM:SS, with hours in front only from one hour on."""
    full = hms(seconds)
    return F.when(seconds >= 3600, full).otherwise(F.substring(full, 4, 5))


def minutes(seconds: Column) -> Column:
    """F3, another form: M:SS."""
    s = F.floor(seconds).cast("long")
    return F.format_string("%d:%02d", F.floor(s / 60).cast("long"), F.pmod(s, F.lit(60)))


def vtt_time(millis: Column) -> Column:
    """HH:MM:SS.mmm of whole milliseconds."""
    return F.concat(hms(millis / 1000), F.lit("."), F.lpad(F.pmod(millis, F.lit(1000)).cast("string"), 3, "0"))


def vtt_millis(stamp: Column) -> Column:
    """milliseconds of HH:MM:SS.mmm; null where it isn't one."""
    p = [F.regexp_extract(stamp, r"^(\d+):(\d{2}):(\d{2})\.(\d{3})$", k).try_cast("long") for k in (1, 2, 3, 4)]
    return ((p[0] * 60 + p[1]) * 60 + p[2]) * 1000 + p[3]


def flexible_millis(stamp: Column) -> Column:
    """milliseconds of [HH:]MM:SS, what follows a comma cut off; null where parts aren't numbers."""
    p = F.split(F.split(stamp, ",")[0], ":")
    n = F.transform(p, lambda x: x.try_cast("double"))
    return F.when(F.size(p) == 3, (n[0] * 3600 + n[1] * 60 + F.get(n, F.lit(2))) * 1000).when(F.size(p) == 2, (n[0] * 60 + n[1]) * 1000).cast("long")


def duration(label: Column) -> Column:
    """seconds of a label such as 02h 47m."""
    part = lambda u: F.coalesce(F.regexp_extract(label, rf"(\d+)\s*{u}", 1).try_cast("long"), F.lit(0))
    return part("h") * 3600 + part("m") * 60


def label_date(label: Column) -> Column:
    """F8: the date of a label such as Jan 06, 2026."""
    return F.to_date(label, "MMM d, yyyy")


def slug(date: Column) -> Column:
    """jan-06-2026."""
    return F.lower(F.date_format(date, "MMM-dd-yyyy"))


def clip(x: Column, n: int = 220) -> Column:
    """at most n characters, the last an ellipsis if any were cut."""
    return F.when(F.length(x) > n, F.concat(F.rtrim(F.substring(x, 1, n - 1)), F.lit("…"))).otherwise(x)


def attach(joined: Column) -> Column:
    """tokens joined by spaces, with punctuation moved to the token before."""
    return F.regexp_replace(F.regexp_replace(joined, r" ([!?:;])(?= |$)", "$1"), r" (?=['.,])", "")


def join_tokens(tokens: Column) -> Column:
    """F11 of an array of tokens."""
    return attach(F.array_join(tokens, " "))


def join_fragments(parts: Column) -> Column:
    """an array of fragments, blank ones left out, joined by one space."""
    return collapse(F.array_join(F.filter(parts, lambda p: F.trim(p) != ""), " "))


def capitalise(x: Column) -> Column:
    """first character in upper case."""
    return F.concat(F.upper(F.substring(x, 1, 1)), x.substr(F.lit(2), F.length(x)))


def capitalise_letter(x: Column) -> Column:
    """first letter in upper case, whatever stands before it."""
    lead = F.regexp_extract(x, r"^([^\p{L}]*)", 1)
    n = F.length(lead)
    return F.concat(lead, F.upper(x.substr(n + 1, F.lit(1))), x.substr(n + 2, F.length(x)))


def title_name(x: Column) -> Column:
    """words and their parts beside hyphens and apostrophes with a capital."""
    def parts(s: Column, sep: str) -> Column:
        return F.array_join(F.transform(F.split(s, sep), lambda p: F.concat(F.upper(F.substring(p, 1, 1)), p.substr(F.lit(2), F.length(p)))), sep)

    return F.array_join(F.transform(F.split(F.lower(x), " "), lambda w: parts(parts(w, "-"), "'")), " ")


def search_key(x: Column) -> Column:
    """F16: lower case, other than letters and digits of ASCII as space, collapsed."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(x), r"[^a-z0-9\s]", " "), r"\s+", " "))


def speaker_key(x: Column) -> Column:
    """lower case without spaces, hyphens and apostrophes."""
    return F.regexp_replace(F.lower(collapse(x)), r"[\s\-']", "")


def safe_name(x: Column) -> Column:
    """a file name of at most 100 characters."""
    return F.substring(F.regexp_replace(F.regexp_replace(x, r'[<>:"/\\|?*]', ""), r"\s+", "_"), 1, 100)


def unescape(x: Column) -> Column:
    """the common character references decoded; ampersands last."""
    for name, c in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&middot;", "·"), ("&copy;", "©"), ("&amp;", "&")):
        x = F.replace(x, F.lit(name), F.lit(c))
    return x


def escape(x: Column) -> Column:
    """F19, the other way."""
    for c, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        x = F.replace(x, F.lit(c), F.lit(name))
    return x


def strip_tags(x: Column) -> Column:
    """text of markup, collapsed."""
    return collapse(unescape(F.regexp_replace(x, r"<[^>]+>", " ")))


def clip_id(url: Column) -> Column:
    """the number of a clip in a path or a query; null if none."""
    return F.coalesce(*(F.regexp_extract(url, p, 1).try_cast("long") for p in (r"/clip/(\d+)", r"[?&]clip_id=(\d+)")))


def deep_link(meeting: Column, seconds: Column, query: Column) -> Column:
    """a page's address with a time and what was searched."""
    return F.concat(F.lit("transcripts/"), meeting, F.lit(".html?q="), F.url_encode(query), F.lit("#t="), F.floor(seconds).cast("string"))


def citation(title: Column, date: Column, speaker: Column, seconds: Column, quote: Column, url: Column) -> Column:
    """six lines to cite a turn by."""
    return F.concat_ws("\n", title, F.concat(F.lit("Date: "), date), F.concat(F.lit("Speaker: "), speaker), F.concat(F.lit("Time: "), short_hms(seconds)), F.concat(F.lit('"'), clip(collapse(quote), 400), F.lit('"')), url)


def hint_key(x: Column) -> Column:
    """lower case letters, hyphens and apostrophes, collapsed."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(x), r"[^a-z\-' ]", " "), " +", " "))


def label_only(x: Column) -> Column:
    """whether a text is but a title and a name."""
    return F.rlike(F.trim(x), F.lit(r"(?i)^(mayor|vice mayor|council\s*(?:member|man|woman)|city manager|chair)\s+[\p{L}\-']+(\s+[\p{L}\-']+)?[.:]?$"))


def hint_strength(marker: Column, explicit: Column, inline: Column, loose: Column) -> Column:
    """the strongest kind of hint there is; empty if none."""
    return F.when(explicit, "explicit").when(marker, "marker").when(inline, "inline").when(loose, "inline_loose").otherwise("")


def self_intro(text: Column) -> Column:
    """the name that a text introduces itself by; null if none."""
    t = F.trim(text)

    def after(prefix: str, banned) -> Column:
        at = F.instr(F.lower(t), prefix)
        rest = F.filter(F.split(F.trim(t.substr(at + len(prefix), F.length(t))), r"\s+"), lambda w: w != "")
        words = F.transform(F.slice(rest, 1, 3), lambda w: F.regexp_replace(w, r"^[.,!?;:']+|[.,!?;:']+$", ""))
        fine = F.transform(words, lambda w: F.rlike(w, F.lit(r"^\p{Lu}\p{L}+$")))
        bad = F.coalesce(F.array_position(fine, False), F.lit(0))
        name = F.array_join(F.slice(words, F.lit(1), F.when(bad == 0, F.size(words)).otherwise(bad - 1).cast("int")), " ")
        ok = (at > 0) & (F.size(rest) > 0) & ~F.coalesce(F.lower(F.get(rest, F.lit(0))).isin(list(banned)), F.lit(False))
        return F.when(ok & (name != ""), name)

    return F.coalesce(after("my name is ", ()), after("i am ", AUXILIARIES), after("i'm ", AUXILIARIES), after("this is ", NOT_NAMES))


def handed_to(text: Column) -> Column:
    """F32: who a text hands over to; empty if none."""
    return F.regexp_extract(text, HANDOFF, 1)


def thanked(text: Column) -> Column:
    """F32: who a text thanks; empty if none."""
    return F.regexp_extract(text, THANKS, 1)


def self_id(text: Column, title: str = "Councilmember") -> Column:
    """the name after a title; empty if none."""
    return F.regexp_extract(text, rf"\b{title}\s+([A-Z][a-z]+(?:\s+[A-Z][a-z]+)?)\b", 1)


def titled(name: Column, title: Column) -> Column:
    """name with its title where that is put in front."""
    return F.when(title.isin("Mayor", "City Manager"), F.concat_ws(" ", title, name)).otherwise(name)


def agenda_item(text: Column) -> Column:
    """the agenda pattern that a text opens; null if none."""
    t = F.lower(text)
    return F.when(F.rlike(t, F.lit(r"item\s+(?:number\s+)?\d+")), F.regexp_extract(t, r"item\s+(?:number\s+)?(\d+)", 1)).when(F.contains(t, F.lit("public hearing")), "public hearing").when(F.contains(t, F.lit("consent agenda")), "consent agenda")


def tokens(text: Column) -> Column:
    """words of over two letters and digits that aren't stop words."""
    return F.filter(F.split(search_key(text), " "), lambda w: (F.length(w) > 2) & ~w.isin(STOP_WORDS))


def relevance(text: Column, query: str) -> Column:
    """500 for the phrase, up to 200 for an early place of it, and 40 for each word of it."""
    t, words = F.lower(text), [w for w in query.lower().split() if len(w) >= 2]
    at = F.instr(t, query.lower())
    phrase = F.when(at > 0, 500 + F.greatest(F.lit(0), 200 - F.least(F.lit(200), at - 1))).otherwise(0)
    return reduce(lambda a, w: a + F.when(F.contains(t, F.lit(w)), 40).otherwise(0), words, phrase)


def highlight(text: Column, query: str) -> Column:
    """the phrase, in any case, between marks."""
    return F.regexp_replace(text, rf"(?i)\Q{query}\E", "<mark>$0</mark>")


def small_verbs(text: Column) -> Column:
    """`I Think ` and the like in the middle of a sentence with a small verb, first place of each."""
    def step(t: Column, verb: Column) -> Column:
        needle = F.concat(F.lit("I "), verb, F.lit(" "))
        at = F.position(needle, t)
        before = F.rtrim(t.substr(F.lit(1), at - 1))
        mid = (at > 0) & ~F.rlike(before, F.lit(r'[.!?"]$'))
        return F.when(mid, F.concat(t.substr(F.lit(1), at - 1), F.lit("I "), F.lower(verb), F.lit(" "), t.substr(at + F.length(needle), F.length(t)))).otherwise(t)

    return F.aggregate(F.array(*(F.lit(v) for v in SMALL_VERBS)), text, step)


def continues(text: Column) -> Column:
    """whether a text goes on with a sentence."""
    first = F.regexp_extract(text, r"^\s*(\S+)", 1)
    return F.rlike(first, F.lit(r"^\p{Ll}")) | F.lower(first).isin(*CONJUNCTIONS)


def seconds_of(value: Column, last_end: Column, length: Column) -> Column:
    """seconds, whichever unit a file has: milliseconds iff its last end is over ten times its length."""
    return F.when(last_end > 10 * length, value / 1000).otherwise(value)


def review_reason(action: Column, note: Column) -> Column:
    """reviewed:<action> | <note>."""
    return F.concat_ws(" | ", F.concat(F.lit("reviewed:"), action), F.when(F.trim(note) != "", F.trim(note)))


def csv_field(x: Column) -> Column:
    """quoted if need be."""
    return F.when(F.rlike(x, F.lit('[",\n\r]')), F.concat(F.lit('"'), F.replace(x, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(x)


def stable_id(*keys: Column) -> Column:
    """an id that follows from its keys."""
    return F.substring(F.sha2(F.concat_ws("|", *keys), 256), 1, 16)


def outcome(text: Column) -> Column:
    """the first outcome of a vote that the ordered patterns find; null if none."""
    return F.coalesce(*(F.nullif(F.regexp_extract(text, p, 0), F.lit("")) for p in OUTCOMES))


def long_date(date: Column) -> Column:
    """January 6, 2026."""
    return F.date_format(date, "MMMM d, yyyy")


def rebase(path: Column, old: str, new: str) -> Column:
    """a path with another prefix."""
    return F.when(F.startswith(path, F.lit(old)), F.concat(F.lit(new), path.substr(F.lit(len(old) + 1), F.length(path)))).otherwise(path)


def rounded(x: Column, places: int) -> Column:
    """half up, in the same way in every engine."""
    return F.floor(x * 10**places + 0.5) / 10**places
