"""Caption headers, a case for each form and each way out of it."""

import pytest
from pyspark.sql import functions as F

from turnwright.operators import headers
from turnwright.sources import scans

COUNCIL = headers.Council({"anders": "Ann Anders", "byrne": "Bo Byrne", "holt": "Sy Holt", "hart-collins": "Sy Hart-Collins", "pryor": "Tim Pryor"}, ("moss", "Ada Moss"), ("dole", "Cy Dole"))
HOLT, MAYOR, HART, TIM = "Councilmember Sy Holt", "Mayor Ada Moss", "Councilmember Sy Hart-Collins", "Councilmember Tim Pryor"


def asked(spark, column, lines):
    df = spark.createDataFrame(list(enumerate(lines)), "k int, s string")
    return [r.x for r in df.select("k", column.alias("x")).orderBy("k").collect()]


def test_titles_and_names(spark):
    cases = {
        "Councilmember Holt": HOLT,
        "council  member HOLT, thank you": HOLT,
        "Councilwoman hol": HOLT,
        "councilman aye": "Councilmember Ann Anders",  # the only first letter
        "councilmember pern": TIM,
        "councilmember zzz": "",
        "Councilmember h": "",  # a letter is no name
        "councilmember hx": "",  # two begin so
        "Mayor Moss": MAYOR,
        "mayor mos": MAYOR,
        "Mayor Smith": "",
        "City  Manager dole": "City Manager Cy Dole",
        "city manager dx": "",
        "Well the councilmember Holt": "",
        "": "",
        None: "",
    }
    assert asked(spark, headers.hint_of(COUNCIL, "s"), cases) == list(cases.values())
    markers = {"Councilmember Holt.": HOLT, "Mayor Moss": MAYOR, "Councilmember Holt thank you": "", "Well the councilmember Holt": "", "City Manager Dole": "", "councilmember zzz": "", None: ""}
    assert asked(spark, headers.marker_of(COUNCIL, "s"), markers) == list(markers.values())


def test_inline_headers(spark):
    cases = [
        ("Councilmember Holt. Thank you, all", HOLT, "Thank you, all", "inline"),
        ("Council member Hart Collins: I move", HART, "I move", "inline"),
        ("councilmember holt. Thank YOU!", HOLT, "thank you", "inline"),  # only usual titles keep the rest as written
        ("Councilmember Holt.", HOLT, "", "inline"),
        ("Councilmember Holt. Councilmember Byrne.", "", None, ""),  # a list
        ("Councilmember Holt: mayor, if I may", "", None, ""),
        ("Councilmember Zzz. Thank you", "", None, ""),
        ("Councilmember Zzz. yes Mayor Moss, so", "", None, ""),  # the first form decides
        ("Councilmember Pryor yes", TIM, "yes", "inline_loose"),
        ("Council member Hart Collins Thank you all", HART, "Thank you all", "inline_loose"),
        ("Councilmember Holt moves it", "", None, ""),  # no word that begins a speech
        ("Councilmember Holt, thank you", "", None, ""),  # an address
        ("councilmember pryor yes", "", None, ""),  # this form needs the title as usual
        ("Mayor Moss, members of council, good evening", MAYOR, "members of council, good evening", "inline"),
        ("mayor moss: Good evening", MAYOR, "good evening", "inline"),
        ("Mayor Moss. council is called", "", None, ""),
        ("Mayor Smith, hello", "", None, ""),
        ("Mayor Moss hello", "", None, ""),
        ("nothing here", "", None, ""),
        ("", "", None, ""),
    ]
    df = spark.createDataFrame([(k, c[0]) for k, c in enumerate(cases)], "k int, s string")
    got = headers.split_header(df, "s", COUNCIL).orderBy("k").collect()
    assert [(r.s, r.speaker_hint, r.rest, r.strength) for r in got] == [(s, h, s if rest is None else rest, x) for s, h, rest, x in cases]
    assert headers.split_header(spark.createDataFrame([(None,)], "s string"), "s", COUNCIL).first().speaker_hint == ""


@pytest.mark.parametrize(
    ("cue", "want"),
    [
        (">> Councilmember Holt\nI move", (True, HOLT, "explicit", "Councilmember Holt I move")),
        (">> hello", (True, "", "", "hello")),
        ("so it was\n>> Mayor Moss", (True, MAYOR, "explicit", "so it was Mayor Moss")),
        ("Councilmember Holt. I move\nthat we do", (True, HOLT, "inline", "I move that we do")),
        ("Councilmember Pryor yes", (True, TIM, "inline_loose", "yes")),
        ("and seconded by\nCouncilmember Anders. Very well", (False, "", "", "and seconded by Councilmember Anders. Very well")),  # only at a cue's start
        ("Councilmember Holt.\nCouncilmember Anders.", (True, HOLT, "marker", "Councilmember Anders.")),  # a roll call is no header, but its first line may be a marker
        ("Councilmember Holt.\nI move it", (True, HOLT, "inline", "I move it")),
        ("Mayor Moss", (True, MAYOR, "marker", "")),
        (">> Mayor Smith, Councilmember Holt", (True, "", "", "Mayor Smith, Councilmember Holt")),
        ("Councilmember Zzz", (False, "", "", "Councilmember Zzz")),
    ],
)
def test_cues(spark, cue, want):
    cues = spark.createDataFrame([(cue.split("\n"),)], "lines array<string>")
    [r] = headers.spoken_by(cues, "lines", COUNCIL).collect()
    assert (r.new_speaker, r.speaker_hint, r.speaker_hint_strength, r.text) == want


def test_captions_of_whole_texts(spark):
    vtt = "﻿WEBVTT\n\n7\n00:00:01.000 --> 00:00:02.500\n>> Mayor Moss\nwe begin\n\n00:00:03.000-->00:00:04.000 align:left\nCouncilmember Holt: yes\n\n00:00:05.000 --> 00:00:06.000\ncall 703-555-0100\n\n00:00:07.000 --> 00:00:08.000\nMayor Moss\n\n00:00:09.000 --> 00:00:10.000\n \n\nNOTE x"
    got = scans.captions(spark.createDataFrame([(1, vtt)], "id int, text string"), "id", COUNCIL).orderBy("start_ms").collect()
    assert [(r.start_ms, r.end_ms, r.new_speaker, r.speaker_hint, r.speaker_hint_strength, r.text) for r in got] == [(1000, 2500, True, MAYOR, "explicit", "Mayor Moss we begin"), (3000, 4000, True, HOLT, "inline", "yes"), (7000, 8000, True, MAYOR, "marker", "")]
    assert scans.captions(spark.createDataFrame([(1, None), (2, "")], "id int, text string"), "id", COUNCIL).where(F.lit(True)).count() == 0
