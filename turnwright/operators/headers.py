"""Caption headers (F25-F28): titles and names at a line's start that say who speaks, what they leave of the line, and how far they can be trusted.

What a line says is taken apart by built-in functions into a title, a name as it was heard, a rest and a form; only heard names are matched with the roster in
Python, each distinct one of an Arrow batch once. Forms are tried in order: a member's name before a period or colon, a member's name before a word that begins a
speech, and the chair's name before a comma, period or colon. A form that applies decides, also where its name is nobody's.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnwright.functions.text import collapse, hint_key
from turnwright.operators.resolve import closest

# Titles, words that begin a speech, what is no speech, and how alike a chair's or manager's name must be.
MEMBER = r"council\s*member|councilmember|councilman|councilwoman"
MEMBER_AS_WRITTEN = r"Council\s*member|Councilmember|Councilman|Councilwoman"
STARTERS = ("thank", "thanks", "uh", "um", "i", "yes", "no", "hi", "good", "okay", "so", "well")
NO_SPEECH = "members of council"
SURE = 0.7

NAME = r"[a-z][a-z\-']+"
_TWO = r"([a-z\-']+)(?:\s+([a-z\-']+))?"
_TWO_AS_WRITTEN = r"[A-Za-z\-']+(?:\s+[A-Za-z\-']+)?"


@dataclass(frozen=True)
class Council:
    """Who may speak: members by last name (lower case), and the last and full names of the mayor and the city manager."""

    members: dict[str, str]
    mayor: tuple[str, str] = ("", "")
    manager: tuple[str, str] = ("", "")

    def label(self, heard: str) -> str:
        """the canonical label of `kind name`; empty if the name is nobody's. Members by the likest name, the two others only if surely alike."""
        kind, _, name = (heard or "").partition(" ")
        if not name:
            return ""
        if kind == "member":
            full = closest(name, self.members)
            return f"Councilmember {full}" if full else ""
        title, (last, full) = ("Mayor", self.mayor) if kind == "mayor" else ("City Manager", self.manager)
        return f"{title} {full}" if last and SequenceMatcher(None, name, last).ratio() >= SURE else ""

    def labels(self, heard: Column) -> Column:
        """The labels of an array of `kind name`."""

        def work(lists: pd.Series) -> pd.Series:
            known = {h: self.label(h) for h in {h for x in lists if x is not None for h in x}}
            return lists.map(lambda x: None if x is None else [known[h] for h in x])

        return F.pandas_udf(work, "array<string>")(heard)


def header_key(x: Column) -> Column:
    """F23, second form: lower case letters, digits, hyphens, apostrophes and , . : with single spaces."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(x), r"[^a-z0-9\-' ,.:]", " "), " +", " "))


def _part(x: Column, pattern: str, k: int) -> Column:
    return F.regexp_extract(x, pattern, k)


def _has(x: Column, pattern: str) -> Column:
    return F.rlike(x, F.lit(pattern))


def heard(line: Column, whole: bool = False) -> Column:
    """`kind name` of the title and name that a line begins with (whole: that it is); empty if none."""
    key, end = hint_key(line), "$" if whole else ""
    kinds = {"member": MEMBER, "mayor": "mayor"} | ({} if whole else {"manager": r"city\s+manager"})
    out = F.lit("")
    for kind, title in reversed(kinds.items()):
        pattern = rf"^(?:{title})\s+({NAME}){end}"
        out = F.when(_has(key, pattern), F.concat(F.lit(f"{kind} "), _part(key, pattern, 1))).otherwise(out)
    return F.coalesce(out, F.lit(""))


def label_line(line: Column) -> Column:
    """whether a line begins like a label."""
    return F.coalesce(_has(hint_key(line), rf"^({MEMBER}|mayor)\b"), F.lit(False))


def inline(line: Column) -> Column:
    """what a line's inline header is: struct of heard (`kind name`, or empty), rest and strength. Whether the name is anybody's is not looked at."""
    line = F.trim(line)
    key, plain = header_key(line), hint_key(line)

    def name(x: Column, pattern: str) -> Column:
        one, two = _part(x, pattern, 1), _part(x, pattern, 2)
        both = F.when(two != "", F.concat_ws("-", one, two)).otherwise(one)
        return F.when(_has(both, f"^{NAME}"), F.concat(F.lit("member "), _part(both, f"^({NAME})", 1))).otherwise("")

    def rest(written: str, otherwise: Column) -> Column:
        """The rest as it was written, if the title is written as usual."""
        return F.trim(F.when(_has(line, written), _part(line, written, 1)).otherwise(otherwise))

    def said(heard: Column, rest: Column, strength: str) -> Column:
        return F.struct(heard.alias("heard"), rest.alias("rest"), F.lit(strength).alias("strength"))

    none = said(F.lit(""), line, "")
    listed = lambda x: _has(F.trim(x), "^(council|mayor)")
    # a member's name and a period or colon
    stop = rf"^(?:{MEMBER})\s+{_TWO}\s*[:.]\s*(.*)$"
    stopped = F.when(listed(_part(key, stop, 3)), none).otherwise(said(name(key, stop), F.when(F.trim(_part(key, stop, 3)) == "", "").otherwise(rest(rf"^(?:{MEMBER_AS_WRITTEN})\s+{_TWO_AS_WRITTEN}\s*[:.]\s*(.*)$", _part(key, stop, 3))), "inline"))
    # a member's name and a word that begins a speech; with a comma it is an address
    begin = rf"^(?:{MEMBER})\s+{_TWO}\s+([a-z]+)\b(.*)$"
    written = rf"^(?:{MEMBER_AS_WRITTEN})\s+{_TWO_AS_WRITTEN}\s+(.*)$"
    begins = ~_has(line, rf"^(?:{MEMBER_AS_WRITTEN})\s+{_TWO_AS_WRITTEN}\s*,") & _part(plain, begin, 3).isin(*STARTERS) & _has(line, written) & ~F.startswith(F.lower(F.trim(_part(line, written, 1))), F.lit(NO_SPEECH))
    # the chair's name and a comma, period or colon
    chair = r"^mayor\s+([a-z\-']+)\s*[,.:]\s*(.*)$"
    chaired = F.when(listed(_part(key, chair, 2)), none).otherwise(said(F.when(_has(_part(key, chair, 1), f"^{NAME}"), F.concat(F.lit("mayor "), _part(_part(key, chair, 1), f"^({NAME})", 1))).otherwise(""), rest(r"^Mayor\s+[A-Za-z\-']+\s*[,.:]\s*(.*)$", _part(key, chair, 2)), "inline"))
    return F.when(_has(key, stop), stopped).when(begins, said(name(plain, begin), F.trim(_part(line, written, 1)), "inline_loose")).when(_has(key, chair), chaired).otherwise(none)


def split_header(df: DataFrame, text: str, council: Council, hint: str = "speaker_hint", rest: str = "rest", strength: str = "strength") -> DataFrame:
    """df with the label of a text's inline header, the text without it, and the header's strength; without a header, or a known name, the text as it is and two empty ones."""
    found = df.withColumn("__in", inline(F.col(text)))
    found = found.withColumn("__label", F.get(council.labels(F.array("__in.heard")), F.lit(0)))
    known = F.coalesce(F.col("__label") != "", F.lit(False))
    return found.withColumns({hint: F.coalesce("__label", F.lit("")), rest: F.when(known, F.col("__in.rest")).otherwise(F.trim(text)), strength: F.when(known, F.col("__in.strength")).otherwise("")}).drop("__in", "__label")


def hint_of(council: Council, text: str) -> Column:
    """the label that a line begins with; empty if none."""
    return F.get(council.labels(F.array(heard(F.col(text)))), F.lit(0))


def marker_of(council: Council, text: str) -> Column:
    """the label that a whole line is; empty if none."""
    return F.get(council.labels(F.array(heard(F.col(text), whole=True))), F.lit(0))


def spoken_by(cues: DataFrame, lines: str, council: Council, clean: Callable[[Column], Column] = collapse) -> DataFrame:
    """Cues with new_speaker, speaker_hint, speaker_hint_strength and text, from an array of each cue's lines.

    `>>` begins a new speaker, named by what follows (explicit). Else the first line may bring an inline header, which is a roll call and no header if it is all of that line and the next one
    begins like a label too; else the first line may be but a title and a name (marker), and isn't text then.
    """
    mark = r"^>>\s*"
    all_lines = F.transform(F.filter(lines, lambda x: F.trim(x) != ""), lambda x: F.trim(x))
    df = cues.withColumn("__lines", all_lines)
    stripped = F.transform("__lines", lambda x: F.regexp_replace(x, mark, ""))
    df = df.withColumn("__marked", F.transform("__lines", lambda x: _has(x, "^>>"))).withColumn("__lines", stripped)
    first = F.coalesce(F.get("__lines", F.lit(0)), F.lit(""))
    df = df.withColumn("__in", inline(first))
    heard_in = F.zip_with("__lines", "__marked", lambda x, marked: F.when(marked, heard(x)).otherwise(""))
    df = df.withColumn("__labels", council.labels(F.concat(heard_in, F.array("__in.heard", heard(first, whole=True)))))
    n = F.size("__lines")
    explicit, marker = F.slice("__labels", F.lit(1), n), F.coalesce(F.get("__labels", n + 1), F.lit(""))
    own = F.coalesce(F.get(explicit, F.lit(0)), F.lit(""))
    header = F.coalesce(F.get("__labels", n), F.lit(""))
    roll_call = (F.col("__in.rest") == "") & label_line(F.coalesce(F.get("__lines", F.lit(1)), F.lit("")))
    headed = (own == "") & (header != "") & ~roll_call
    later = F.coalesce(F.get(F.filter(explicit, lambda x: x != ""), F.lit(0)), F.lit(""))
    told = F.when(own != "", F.struct(own.alias("hint"), F.lit("explicit").alias("strength"))).when(headed, F.struct(header.alias("hint"), F.col("__in.strength").alias("strength"))).when(later != "", F.struct(later.alias("hint"), F.lit("explicit").alias("strength"))).when(marker != "", F.struct(marker.alias("hint"), F.lit("marker").alias("strength"))).otherwise(F.struct(F.lit("").alias("hint"), F.lit("").alias("strength")))
    df = df.withColumn("__told", told)
    rest = F.slice("__lines", F.lit(2), F.greatest(n, F.lit(1)))
    kept = F.when(headed, F.concat(F.array("__in.rest"), rest)).when(F.col("__told.strength") == "marker", rest).otherwise(F.col("__lines"))
    new = F.exists("__marked", lambda x: x) | F.coalesce(headed, F.lit(False)) | (F.col("__told.strength") == "marker")
    return df.withColumns({"new_speaker": new, "speaker_hint": F.col("__told.hint"), "speaker_hint_strength": F.col("__told.strength"), "text": clean(F.array_join(kept, " "))}).drop("__lines", "__marked", "__in", "__labels", "__told")
