"""Sequence operators whose next step depends on what was gathered so far.

Caps on what is gathered (length, duration) need its start, so they can't be told by neighbours. But neighbours tell where nothing goes on: a change that no rule crosses, or a gap over the
largest limit. There the rows of a meeting are cut into pieces, which are folded apart, in the JVM (W1-W4) or by plain functions of a piece's rows (the others); `cuts` are the conditions for these.
A meeting may so be in many tasks; what a task holds is one piece.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnwright.functions import text as t
from turnwright.functions.text import any_of
from turnwright.operators.sequence import carry, pieces

# Words and limits that decide results.
CONTINUATION_STARTS = frozenset("and but so or the a an it they we you i this that to of in for on with at is are was were have has had be been being do does did will would could should can my your our their his her".split())
NOT_FRAGMENTS = frozenset(("i", "i'm", "i'll", "i've", "a", "an", "the"))
STATUS_RANK = {"approved": 5, "heuristic": 4, "caption": 3, "caption_override": 3, "unresolved": 2, "unknown": 1}
CONTINUES = ("i ", "we ", "the ", "this ", "our ", "to the", "ask ", "please ", "will now")
ROLE_STARTS = ("our ", "the ", "your ", "this ", "my ", "city ", "assistant ", "mayor ", "councilmember ", "council member", "mr. ", "ms. ", "mrs. ", "dr. ", "hon. ")


def _seconds(a: Column, b: Column) -> Column:
    """From a to b, to the millisecond, so that limits are met exactly."""
    return F.round(b - a, 3)


def _stripped(text: Column) -> Column:
    return F.btrim(text, F.lit(" \t\n\r\x0b\x0c"))


def _ends_sentence(text: Column) -> Column:
    return F.right(text, F.lit(1)).isin(*".!?")


def _grouped(rows: DataFrame, keys: list[str], full: Callable[[Column, Column], Column], grow: Callable[[Column, Column], dict[str, Column]], fields: list[str]) -> DataFrame:
    """The rows of each piece folded in the JVM: a row joins the one before it as `grow` says unless that is `full`. Rows that are done are copied only as another one closes."""
    inside = [c for c in rows.columns if c not in (*keys, "piece", "row")]
    held = rows.groupBy(*keys, "piece").agg(F.array_sort(F.collect_list(F.struct("row", *inside))).alias("rows"))
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    one = lambda x: F.struct(*(x[c].cast(kinds[c]).alias(c) for c in inside), F.lit(1).cast("long").alias("n"))
    start = F.struct(F.array().cast(T.ArrayType(T.StructType([*(T.StructField(c, kinds[c]) for c in inside), T.StructField("n", T.LongType())]))).alias("done"), one(F.col("rows")[0]).alias("now"))

    def step(state: Column, x: Column) -> Column:
        now = state["now"]
        more = grow(now, x)
        grown = F.struct(*((more[c] if c in more else now[c]).cast(kinds[c]).alias(c) for c in inside), (now["n"] + 1).alias("n"))
        shut = full(now, x)
        return F.struct(F.when(shut, F.concat(state["done"], F.array(now))).otherwise(state["done"]).alias("done"), F.when(shut, one(x)).otherwise(grown).alias("now"))

    folded = F.aggregate(F.slice("rows", 2, F.size("rows")), start, step, lambda s: F.concat(s["done"], F.array(s["now"])))
    return held.select(*keys, F.explode(folded).alias("b")).select(*keys, *(f"b.{c}" for c in fields))


def capped_blocks(words: DataFrame, keys: list[str], order: list[str], gap: float, cap: float) -> DataFrame:
    """Blocks of words of one speaker without a gap over `gap`; a block that lasts `cap` already takes no further word.

    Gives (keys, speaker, start, end, n, text). Words are cut where the speaker changes or a gap is too long; what is between is folded in the JVM.
    """
    rows = pieces(words.select(*dict.fromkeys([*keys, *order, "start", "end", "speaker", "text"])), keys, order, ["speaker", "end"], lambda before: ~F.col("speaker").eqNullSafe(before(1, "speaker")) | (F.col("start") - before(1, "end") > gap))
    grow = lambda now, x: {"end": F.greatest(now["end"], x["end"]), "text": F.concat_ws(" ", now["text"], x["text"])}
    return _grouped(rows, keys, lambda now, x: now["end"] - now["start"] >= cap, grow, ["speaker", "start", "end", "n", "text"])


def chunk_turns(turns: DataFrame, keys: list[str], order: list[str], gap: float = 1.2, cap: float = 35.0, most: int = 650) -> DataFrame:
    """As W1 (gaps are from the latest end so far), and a chunk of `most` characters that ends a sentence takes no more either. Other columns are the first turn's."""
    rows = pieces(turns, keys, order, ["speaker"], lambda before: ~F.col("speaker").eqNullSafe(before(1, "speaker")) | (_seconds(F.col("__high"), F.col("start")) > gap), "end")
    full = lambda now, x: (_seconds(now["end"], x["start"]) > gap) | (_seconds(now["start"], now["end"]) >= cap) | ((F.length(now["text"]) >= most) & _ends_sentence(now["text"]))
    grow = lambda now, x: {"end": F.greatest(now["end"], x["end"]), "text": _stripped(F.concat_ws(" ", now["text"], x["text"]))}
    return _grouped(rows, keys, full, grow, [c for c in turns.columns if c not in keys] + ["n"])


def chunk_cues(cues: DataFrame, keys: list[str], order: list[str], cap: float = 30.0, most: int = 650) -> DataFrame:
    """Cues in chunks, closed by a new speaker, a change of the hint in force, or a chunk that is long enough; empty cues only change the hint. speaker is the hint in force."""
    said = cues.withColumn("text", _stripped(F.coalesce("text", F.lit("")))).withColumn("new_speaker", F.coalesce("new_speaker", F.lit(False)))
    # a hint holds until another one, or a new speaker without one
    hint = F.when(F.coalesce("speaker_hint", F.lit("")) != "", F.col("speaker_hint")).when(F.col("new_speaker"), F.lit(""))
    told = carry(pieces(said.withColumn("__hint", hint), keys, order, order[:1], lambda before: F.col("__hint").isNotNull()), [*keys, "piece"], ["row"], "__hint", "speaker")
    told = told.withColumn("speaker", F.coalesce("speaker", F.lit(""))).drop("__hint", "piece", "row")
    rows = pieces(told, keys, order, ["speaker"], lambda before: F.col("new_speaker") | (F.col("speaker") != before(1, "speaker"))).where("text <> ''")
    full = lambda now, x: (now["end"] - now["start"] >= cap) | ((F.length(now["text"]) >= most) & _ends_sentence(now["text"]))
    grow = lambda now, x: {"end": x["end"], "text": _stripped(F.concat_ws(" ", now["text"], x["text"]))}
    return _grouped(rows, keys, full, grow, [c for c in told.columns if c not in keys] + ["n"])


def capped_merge(turns: DataFrame, keys: list[str], order: list[str], gap: float = 2.0, span: float = 120.0) -> DataFrame:
    """W4, third form: neighbours of one speaker and status with a gap under `gap` merge while the whole lasts `span` at most."""
    rows = pieces(turns, keys, order, ["speaker", "status"], lambda before: ~F.col("speaker").eqNullSafe(before(1, "speaker")) | ~F.col("status").eqNullSafe(before(1, "status")) | (F.col("start") - F.col("__high") >= gap), "end")
    full = lambda now, x: (x["start"] - now["end"] >= gap) | (x["end"] - now["start"] > span)
    grow = lambda now, x: {"end": F.greatest(now["end"], x["end"]), "text": _stripped(F.concat_ws(" ", now["text"], x["text"]))}
    return _grouped(rows, keys, full, grow, [c for c in turns.columns if c not in keys] + ["n"])


def fold(rows: DataFrame, work: Callable[[list[dict]], list[dict]], schema: str) -> DataFrame:
    """The rows that work makes of each piece's rows, in order. Pieces are dealt by hash, and a task holds one of them at a time."""
    names = [f.split()[0] for f in schema.split(", ")]
    flat = rows.select(*[c for c in rows.columns if c not in ("piece", "row")], F.col("piece.part").alias("__p"), F.col("piece.number").alias("__c"), F.col("row.part").alias("__q"), F.col("row.row").alias("__r"))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[dict] = []
        for part in parts:
            out: list[dict] = []
            for r in part.to_dict("records"):
                if held and (held[-1]["__p"], held[-1]["__c"]) != (r["__p"], r["__c"]):
                    out += work(held)
                    held = []
                held.append(r)
            yield pd.DataFrame(out, columns=names)
        if held:
            yield pd.DataFrame(work(held), columns=names)

    return flat.repartition("__p", "__c").sortWithinPartitions("__p", "__c", "__q", "__r").mapInPandas(run, schema)


def _joined(a: str, b: str) -> str:
    return f"{a} {b}".strip()


def _named(speaker: str) -> bool:
    return speaker not in ("", "Unknown Speaker")


def chain_merge(rows: list[dict], gap: float = 4.0, most: int = 12) -> list[dict]:
    """Turns of one speaker, or one raw id, merge; unknown stretches are absorbed into the speaker before them, or between two turns of one raw id."""
    out: list[dict] = []
    absorbed, k = 0, 0

    def take(into: dict, r: dict) -> None:
        into |= {"end": r["end"], "text": _joined(into["text"], r["text"]), "n": into["n"] + 1}

    while k < len(rows):
        r = rows[k]
        last = out[-1] if out else None
        k += 1
        if last is None:
            out.append({**r, "n": 1})
            continue
        near = r["start"] - last["end"]
        plain = not last.get("handoff_applied") and not last.get("self_intro_applied")
        upgraded = r["status"] == "approved" and last["status"] == "heuristic" and bool(last.get("handoff_applied"))
        guard = plain or upgraded or bool(last.get("self_intro_applied")) or last["status"] == r["status"] == "approved"
        if near < gap and (_named(r["speaker"]) and r["speaker"] == last["speaker"] and guard or r["raw"] == last["raw"]):
            take(last, r)
            if STATUS_RANK.get(r["status"], 0) > STATUS_RANK.get(last["status"], 0):
                last["status"] = r["status"]
            absorbed = 0
            continue
        if r["raw"] == "UNKNOWN" and last["raw"] != "UNKNOWN" and near < gap and absorbed < most:
            if last["speaker"] != "Unknown Speaker":
                take(last, r)
                absorbed += 1
                continue
            total, ahead = near, k
            while ahead < len(rows) and rows[ahead]["raw"] == "UNKNOWN":
                total += rows[ahead]["start"] - rows[ahead - 1]["end"]
                if total >= gap:
                    break
                ahead += 1
            if ahead < len(rows) and rows[ahead]["raw"] == last["raw"] and total < gap:
                for x in rows[k - 1 : ahead]:
                    take(last, x)
                    absorbed += 1
                k = ahead
                continue
        out.append({**r, "n": 1})
        absorbed = 0
    return out


def repair_fragments(rows: list[dict], gap: float = 3.0, least: int = 5, most: int = 600) -> list[dict]:
    """A named turn that stops within a sentence takes the next one on if that goes on with it, or is short and begins with a capital."""
    out: list[dict] = []
    for r in rows:
        last = out[-1] if out else None
        if last and _named(last["speaker"]) and r["start"] - last["end"] <= gap:
            a, b = last["text"].strip(), r["text"].strip()
            first = b.split()[0] if b.split() else ""
            goes_on = first.islower() and first in CONTINUATION_STARTS
            short = len(b) < 80 and first[:1].isupper() and first.lower() not in NOT_FRAGMENTS
            if least <= len(a) <= most and a[-1] not in '.!?"' and (goes_on or short):
                last |= {"end": r["end"], "text": f"{a} {b}", "n": last["n"] + 1}
                continue
        out.append({**r, "n": 1})
    return out


def hand_offs(rows: list[dict], nicknames: dict[str, str] | None = None, within: float = 5.0, sure: float = 3.0) -> list[dict]:
    """Who is called on speaks next, if that turn thanks the speaker before, or follows at once. The first row's before_1 and before_2 are the speakers before it, if there are any."""
    handoff, thanks, nick = re.compile(t.HANDOFF), re.compile(t.THANKS), nicknames or {}
    out = [{**r, "handoff_applied": False} for r in rows]
    ahead = [rows[0].get("before_2") or "", rows[0].get("before_1") or ""] if rows else []
    for k in range(len(out) - 1):
        m = handoff.search(out[k]["text"] or "")
        near = out[k + 1]["start"] - out[k]["end"]
        if not m or m[1].strip().lower().startswith(ROLE_STARTS) or near > within:
            continue
        earlier = [*ahead, *(r["speaker"] for r in out[max(k - 2, 0) : k])][-2:]
        prior = next((x for x in reversed(earlier) if _named(x)), "")
        last = (prior.lower().split() or [""])[-1]
        said = thanks.search(out[k + 1]["text"] or "")
        if said and last and said[1].lower() in (nick.get(last, last), last) or near < sure:
            out[k + 1] |= {"speaker": m[1].strip(), "status": "heuristic", "handoff_applied": True}
    return out


def carry_speakers(turns: DataFrame, keys: list[str], order: list[str], lead: int = 100, phrases: tuple[str, ...] = CONTINUES) -> DataFrame:
    """The chair goes on speaking where an unnamed turn begins like a continuation."""
    named = ~F.coalesce("speaker", F.lit("")).isin("", "Unknown Speaker")
    in_chair = F.coalesce(F.col("status") == "chair", F.lit(False))
    told = turns.withColumn("__chair", F.when(in_chair, F.col("speaker")).when(named, F.lit("")))
    told = carry(pieces(told, keys, order, order[:1], lambda before: F.col("__chair").isNotNull()), [*keys, "piece"], ["row"], "__chair", "__chair")
    goes_on = any_of(F.lower(F.left("text", F.lit(lead))), phrases)
    carried = F.coalesce(~in_chair & ~named & (F.col("__chair") != "") & goes_on, F.lit(False))
    return told.withColumns({"speaker": F.when(carried, F.col("__chair")).otherwise(F.col("speaker")), "status": F.when(carried, "heuristic").otherwise(F.col("status"))}).select(turns.columns)


def stray_tokens(rows: list[dict]) -> list[dict]:
    """A lone `I` joins the same speaker's next turn, an orphan at the start likewise; then short continuations join the turn before. place: a turn's number in its meeting, from 0 on."""
    out: list[dict] = []
    k = 0
    while k < len(rows):
        r = dict(rows[k], n=1)
        after = rows[k + 1] if k + 1 < len(rows) else None
        if after and after["speaker"] == r["speaker"] and len(after["text"]) > 5:
            near = after["start"] - r["end"]
            if r["text"].strip() == "I" and near < 10 or r.get("place", k) < 2 and len(r["text"].split()) == 1 and near < 15:
                r = {**after, "start": r["start"], "text": _joined(r["text"].strip(), after["text"]), "n": 2}
                k += 1
        k += 1
        last = out[-1] if out else None
        first = (r["text"].split() or [""])[0]
        if last and last["speaker"] == r["speaker"] and r["start"] - last["end"] < 3 and len(r["text"]) < 120 and (first[:1].islower() or first.lower() in ("and", "but", "so", "or", "nor")):
            last |= {"end": r["end"], "text": _joined(last["text"], r["text"]), "n": last["n"] + r["n"]}
        else:
            out.append(r)
    return out


def skip_after(rows: list[dict], flag: str = "hit", within: float = 60.0) -> list[dict]:
    """Hits that don't start within so many seconds after one that was taken."""
    out: list[dict] = []
    for r in rows:
        if r[flag] and (not out or r["start"] - out[-1]["start"] >= within):
            out.append(dict(r))
    return out


def _apart(limit: float, strictly: bool = True) -> Callable:
    """Cuts where the row before ended so long ago."""
    return lambda before: (F.col("start") - before(1, "end") > limit) if strictly else (F.col("start") - before(1, "end") >= limit)


def _calls(text: Column) -> Column:
    return F.coalesce(F.rlike(text, F.lit(t.HANDOFF)), F.lit(False))


def _unknown_ahead(before: Callable) -> Column:
    """Whether an unknown stretch may be looked through, from the row before on: W8 does, whatever the time until the turn after it."""
    return (before(1, "raw") == "UNKNOWN") & (F.col("raw") != "UNKNOWN")


def chained(turns: DataFrame, keys: list[str], order: list[str], schema: str, gap: float = 4.0) -> DataFrame:
    """W8, by pieces: chain_merge."""
    rows = pieces(turns, keys, order, ["end", "raw"], lambda before: _apart(gap, False)(before) & ~_unknown_ahead(before))
    return fold(rows, lambda own: chain_merge(own, gap), schema)


def repaired(turns: DataFrame, keys: list[str], order: list[str], schema: str, gap: float = 3.0) -> DataFrame:
    """W9, by pieces: repair_fragments."""
    return fold(pieces(turns, keys, order, ["end"], _apart(gap)), lambda own: repair_fragments(own, gap), schema)


def with_speakers_before(turns: DataFrame, keys: list[str], order: list[str], also: Callable[[Callable], Column], seen: list[str]) -> DataFrame:
    """Pieces for hand_offs: cut where none of the last three turns calls on anybody, so that the two before are as they were; their speakers are before_1 and before_2."""
    called = turns.withColumn("__calls", _calls(F.col("text")))
    quiet = lambda before: ~F.coalesce(before(1, "__calls") | F.coalesce(before(2, "__calls"), F.lit(False)) | F.coalesce(before(3, "__calls"), F.lit(False)), F.lit(False))
    told = pieces(called, keys, order, ["__calls", "speaker", *seen], lambda before: quiet(before) & also(before), depth=3, tell={"before_1": (1, "speaker"), "before_2": (2, "speaker")})
    return told.drop("__calls")


def handed_off(turns: DataFrame, keys: list[str], order: list[str], schema: str, nicknames: dict[str, str] | None = None) -> DataFrame:
    """W10, by pieces: hand_offs."""
    return fold(with_speakers_before(turns, keys, order, lambda before: F.lit(True), []), lambda own: hand_offs(own, nicknames), schema)


def merged(turns: DataFrame, keys: list[str], order: list[str], schema: str, nicknames: dict[str, str] | None = None) -> DataFrame:
    """W10, W8 and W9 one after the other, by pieces that all three allow."""
    rows = with_speakers_before(turns, keys, order, lambda before: _apart(4.0, False)(before) & ~_unknown_ahead(before), ["end", "raw"])
    return fold(rows, lambda own: repair_fragments(chain_merge(hand_offs(own, nicknames))), schema)


def without_strays(turns: DataFrame, keys: list[str], order: list[str], schema: str) -> DataFrame:
    """W14, by pieces: stray_tokens."""
    rows = pieces(turns, keys, order, ["speaker", "end"], lambda before: ~F.col("speaker").eqNullSafe(before(1, "speaker")) | _apart(15, False)(before), depth=2, tell={"one": (1, "there"), "two": (2, "there")})
    place = F.when(F.col("one").isNull(), 0).when(F.col("two").isNull(), 1).otherwise(2)  # only the first two are told apart
    return fold(rows.withColumn("place", place).drop("one", "two"), stray_tokens, schema)


def skipped_after(hits: DataFrame, keys: list[str], order: list[str], schema: str, within: float = 60.0) -> DataFrame:
    """W19, by pieces: skip_after, of rows that are all hits."""
    rows = pieces(hits.withColumn("hit", F.lit(True)), keys, order, ["start"], lambda before: F.col("start") - before(1, "start") >= within)
    return fold(rows, lambda own: skip_after(own, "hit", within), schema)
