"""Projections and labels of turns (P1-P4, P6, P8, P9, P11, P17-P19, P22, P26, P29, F30), as Column expressions.

Names, titles, vendors and ladders are parameters; the defaults are the values that decide results elsewhere. Null counts as empty.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from turnwright.functions.text import any_of

UNKNOWN = "Unknown Speaker"
# What hint strengths say of a label's source and its detail, words for nobody, kinds of meetings, and phrases that tell a speaker.
SOURCES = {"explicit": "captions", "inline": "captions", "inline_loose": "captions", "diarization": "diarization"}
DETAILS = {"explicit": "Captions (explicit speaker tag)", "marker": "Captions (standalone marker cue)", "inline": "Captions (inline header)", "inline_loose": "Captions (inline header, loose)", "diarization": "Diarization (mapped from caption tags)"}
NOBODY = ("", "speaker", "unknown")
ROLES = (("Mayor", "mayor"), ("Council", "council"), ("Manager", "manager"))
MEETING_TYPES = (("work session", "work_session"), ("special", "special"), ("public hearing", "public_hearing"), ("retreat", "other"))
DECISIONS = {"unknown": "keep_unknown", "public_comment": "mark_public_comment", "council": "approve_named_official", "staff": "approve_named_official"}
CHAIR_SAYS = ("as mayor", "this is your mayor", "i'm the mayor", "i am mayor")
OPENINGS = ("call the", "regular meeting", "to order", "pledge of allegiance", "i pledge", "will now ask", "please rise")
CONTINUATIONS = ("i ", "we ", "the ", "this ", "our ", "to the", "pledge", "allegiance", "ask ", "please ", "will now")
TITLED = ("Mayor", "City Manager")


def filled(x: Column) -> Column:
    """x, null where it is empty."""
    return F.nullif(x, F.lit(""))


def _ladder(pairs: Sequence[tuple[Column, str]], otherwise: Column) -> Column:
    for test, value in reversed(pairs):
        otherwise = F.when(test, F.lit(value)).otherwise(otherwise)
    return otherwise


def block_turn(name: Column, flag: Column) -> dict[str, Column]:
    """A block as a turn: its public name, its status (unresolved only if flagged), and the flag, which holds where it is missing."""
    return {"speaker_public": F.coalesce(name, F.lit(UNKNOWN)), "speaker_status": F.when(flag, "unresolved").otherwise("approved"), "needs_review": F.coalesce(flag, F.lit(True))}


def utterance_turn(label: Column) -> dict[str, Column]:
    """A service's utterance as a turn: labels that begin with Unknown are unresolved, with confidence 0."""
    unknown = F.coalesce(F.startswith(label, F.lit("Unknown")), F.lit(False))
    return {"status": F.when(unknown, "unresolved").otherwise("approved"), "confidence": F.when(unknown, 0.0).otherwise(1.0)}


def effective_speaker(speaker: Column, public: Column, default: str = UNKNOWN) -> Column:
    """The speaker, else the public name, else the default; empty ones fall through."""
    return F.coalesce(filled(speaker), filled(public), F.lit(default))


def provenance(hint: Column, strength: Column) -> dict[str, Column]:
    """Where a label comes from, and in words. A lone marker gives no source, yet its words."""
    named = filled(F.trim(hint)).isNotNull()
    return {
        "speaker_source": F.when(named, _ladder([(strength == s, v) for s, v in SOURCES.items()], F.lit("unknown"))).otherwise("unknown"),
        "speaker_source_detail": _ladder([(strength == s, v) for s, v in DETAILS.items()], F.lit("")),
    }


def needs_review(flag: Column, unknown: Column, confidence: Column, least: float = 0.85) -> Column:
    """Flagged, of unknown name, or too unsure."""
    return flag | unknown | (confidence < least)


def is_unknown(status: Column, raw: Column) -> Column:
    """Turns that nobody is known for."""
    return F.coalesce(status == "unknown", F.lit(False)) | F.coalesce(F.upper(raw) == "UNKNOWN", F.lit(False))


def is_confirmed(status: Column, name: Column) -> Column:
    """Turns of a confirmed speaker."""
    return F.coalesce(status.isin("approved", "mixed"), F.lit(False)) & filled(name).isNotNull()


def top_level(label: Column) -> Column:
    """Whether an agenda label is an item of its own: digits and a dot."""
    return F.rlike(label, F.lit(r"^\d+\."))


def watermark(text: Column, vendor: str = "captioning") -> Column:
    """Whether a caption is its vendor's: the name (a pattern), an address or a telephone number."""
    return F.rlike(text, F.lit(rf"(?i)www\.|{vendor}|\(\d{{3}}\)\s*\d{{3}}-\d{{4}}|\d{{3}}-\d{{3}}-\d{{4}}"))


def normal_speaker(speaker: Column, nobody: Sequence[str] = NOBODY) -> Column:
    """The speaker; blank ones and words for nobody are unknown."""
    return F.when(F.lower(F.trim(F.coalesce(speaker, F.lit("")))).isin(*nobody), UNKNOWN).otherwise(speaker)


def role_class(name: Column, roles: Sequence[tuple[str, str]] = ROLES, otherwise: str = "public") -> Column:
    """The first role that a name contains."""
    return _ladder([(F.contains(name, F.lit(word)), role) for word, role in roles], F.lit(otherwise))


def meeting_type(title: Column, types: Sequence[tuple[str, str]] = MEETING_TYPES, otherwise: str = "regular") -> Column:
    """The first type whose words a title contains, whatever their case."""
    return _ladder([(F.contains(F.lower(title), F.lit(word)), kind) for word, kind in types], F.lit(otherwise))


def label_priority(status: Column, name: Column, hint: Column, strength: Column, heuristic: Column, raw: Column) -> Column:
    """Struct (label, status, review, reason): an approved name, public comment, rejected or mixed, a caption hint, the text, else nobody."""

    def row(label: Column | str, kind: Column | str, review: bool, reason: Column | str) -> Column:
        return F.struct(*((x if isinstance(x, Column) else F.lit(x)).alias(n) for x, n in ((label, "label"), (kind, "status"), (review, "review"), (reason, "reason"))))

    named, caption = filled(name).isNotNull(), filled(hint).isNotNull() & strength.isin("explicit", "inline", "marker")
    lost = raw == "UNKNOWN"
    return F.coalesce(
        F.when((status == "approved") & named, row(name, "approved", False, "")),
        F.when((status == "public_comment") & named, row(name, "public_comment", False, "public_comment")),
        F.when(F.startswith(status, F.lit("rejected")) | (status == "mixed"), row(UNKNOWN, "mixed", True, "mixed_or_rejected_audio")),
        F.when(caption, row(hint, F.when(lost, "caption").otherwise("caption_override"), False, F.concat(F.lit("caption:"), strength))),
        F.when(filled(heuristic).isNotNull(), row(heuristic, "heuristic", False, "text_heuristic")),
        F.when(lost, row(UNKNOWN, "unknown", True, "no_diarization")),
        row(UNKNOWN, "unresolved", True, "unresolved_identity"),
    )


def modal_decision(kind: Column, name: Column) -> dict[str, Column]:
    """A reviewer's choice of type (unknown, public_comment, council, staff, or none) as a decision."""
    public = F.when(kind == "public_comment", F.coalesce(filled(name), F.lit("Public Comment Speaker"))).when(kind.isin("council", "staff"), name).otherwise("")
    return {
        "reviewer_action": _ladder([(kind == k, v) for k, v in DECISIONS.items()], F.lit("keep_unknown")),
        "speaker_type": F.when(kind.isin(*DECISIONS), kind).otherwise(""),
        "speaker_public_override": F.coalesce(public, F.lit("")),
        "speaker_status_override": F.when(kind.isin("public_comment", "council", "staff"), "approved").otherwise(""),
    }


def coerced(df: DataFrame, fields: dict[str, tuple[str, object]], required: Sequence[str] = ()) -> DataFrame:
    """Columns by name as (type, default), where the cast fails or nothing is given; rows without a required one are left out."""
    cast = {c: F.col(c).try_cast(kind) for c, (kind, _) in fields.items()}
    df = df.select(*(cast[c].alias(c) for c in fields)).dropna(subset=list(required)) if required else df.select(*(cast[c].alias(c) for c in fields))
    return df.select(*((F.col(c) if default is None else F.coalesce(c, F.lit(default).cast(kind))).alias(c) for c, (kind, default) in fields.items()))


def labelled(name: str, title: str | None) -> str:
    """a name with a title that is spoken."""
    return f"{title} {name}" if title in TITLED else name


def speaker_from_text(text: Column, roster: dict[str, str], chair: str, rules: Sequence[tuple[Sequence[str], str]] = (), later: Sequence[tuple[Sequence[str], str]] = (), openings: Sequence[str] = OPENINGS) -> Column:
    """F30 without continuation: who a text tells to be speaking; null if none.

    In order: a name of the roster (name -> title), phrases of the chair, `rules` (all phrases -> label), `councilmember X` and `thank you, X` by
    the first name, `later` rules, and phrases that open a meeting, which are the chair's.
    """
    low, head = F.lower(text), F.lit(labelled(chair, roster.get(chair)))

    def by_first_name(x: Column) -> Column:
        written = F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substring(x, 2, 1 << 30)))
        return _ladder([((x != "") & F.startswith(F.lit(n), written), n) for n in roster], F.lit(None).cast("string"))

    def every(phrases: Sequence[str]) -> Column:
        return reduce(lambda a, b: a & b, [F.contains(low, F.lit(p)) for p in phrases])

    return F.coalesce(
        _ladder([(F.contains(low, F.lit(n.lower())), labelled(n, t)) for n, t in roster.items()], F.lit(None).cast("string")),
        F.when(any_of(low, CHAIR_SAYS), head),
        *(F.when(every(p), F.lit(label)) for p, label in rules),
        by_first_name(F.regexp_extract(low, r"council\s*(?:member|woman|man)\s+([a-z][a-z\-']+)", 1)),
        by_first_name(F.regexp_extract(text, r"thank you[,\s]+([A-Z][a-z]+)", 1)),
        *(F.when(every(p), F.lit(label)) for p, label in later),
        F.when(any_of(low, openings), head),
    )


def label_from_text(turns: DataFrame, keys: list[str], order: list[str], text: str, roster: dict[str, str], chair: str, name: str = "heuristic", known: Column | None = None, **more) -> DataFrame:
    """turns with the speaker that their text tells. One that tells nobody, yet goes on as the chair does (CONTINUATIONS in its first 100
    characters), is the chair's if the last turn that doesn't just go on is. known: labels that stand already, which count as said."""
    head = labelled(chair, roster.get(chair))
    own = speaker_from_text(F.col(text), roster, chair, **more)
    own = own if known is None else F.coalesce(known, own)
    df = turns.withColumn("__own", own).withColumn("__on", F.col("__own").isNull() & F.coalesce(any_of(F.substring(F.lower(text), 1, 100), CONTINUATIONS), F.lit(False)))
    before = F.last(F.when(~F.col("__on"), F.coalesce("__own", F.lit(""))), ignorenulls=True).over(W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1))
    return df.withColumn(name, F.when(F.col("__on") & before.isin(head, chair), F.lit(head)).otherwise(F.col("__own"))).drop("__own", "__on")
