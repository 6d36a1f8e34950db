"""Licence scans by sentence rules, in built-in functions only.

A text is cut in sentences at blank lines, after list marks and after full stops, question and exclamation marks; a sentence is normalised to
lower-case letters and digits with single spaces. A line end may, but need not, end a sentence: a known one is found wherever it is a run of whole
lines, however it is wrapped and whatever signs of a comment its lines begin with. Known licence sentences have identifiers; the identifiers of a text's known sentences, in order, are matched against
rules in order, each a run of identifiers that names a licence. A rule takes the runs that it matches away, so that a later, more general rule
doesn't see them; what no rule takes is reported as unruled. All is done row by row, without any shuffle.

A sentence that names several licences (an SPDX expression, or a choice between two) counts as one for each.

Defined results: a null or empty text, and one without known sentences, has no licences and no identifiers; each rule reports its licence once
however often it matches; repeated rows get equal results; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnwright.llm.clusterio import table

# What public licences and notices say, normalised, by identifier.
SENTENCES: dict[str, tuple[str, ...]] = {
    "ApacheName": ("licensed under the apache license version 2 0", "licensed under the apache license version 2 0 the license", "released under the apache license version 2 0", "this project is licensed under the apache license version 2 0", "spdx license identifier apache 2 0"),
    "ApacheUse": ("you may not use this file except in compliance with the license",),
    "ApacheCopy": ("you may obtain a copy of the license at",),
    "ApacheAsIs": ("unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",),
    "MitName": ("released under the mit license", "licensed under the mit license", "this project is licensed under the mit license", "this work is licensed under the mit license", "spdx license identifier mit"),
    "MitGrant": ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",),
    "MitNotice": ("the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",),
    "MitAsIs": ("the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",),
    "IscGrant": ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",),
    "BsdGrant": ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",),
    "BsdSource": ("redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",),
    "BsdBinary": ("redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",),
    "BsdEndorse": ("neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",),
    "BsdName": ("licensed under the bsd license", "released under the bsd license", "spdx license identifier bsd 3 clause", "spdx license identifier bsd 2 clause"),
    "MplName": ("this source code form is subject to the terms of the mozilla public license v 2 0", "licensed under the mozilla public license version 2 0", "spdx license identifier mpl 2 0"),
    "PublicDomain": ("this is free and unencumbered software released into the public domain", "this work is in the public domain", "released into the public domain", "this work is dedicated to the public domain"),
    "AllRights": ("all rights reserved",),
    "ApacheBody": ("apache license version 2 0 january 2004",),
    "MitLiability": ("in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",),
    "IscAsIs": ("the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",),
    "BsdAsIs": ("this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",),
    "ZlibAsIs": ("this software is provided as is without any express or implied warranty",),
    "ZlibGrant": ("permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",),
    "ZlibName": ("licensed under the zlib license", "released under the zlib license", "spdx license identifier zlib"),
    "UnlicenseFree": ("anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means",),
    "UnlicenseName": ("spdx license identifier unlicense", "released under the unlicense", "licensed under the unlicense"),
    "MplTitle": ("mozilla public license version 2 0",),
    "MplCopy": ("if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0", "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0"),
    "Epl20Name": ("this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0", "this program and the accompanying materials are made available under the terms of the eclipse public license v 2 0 which is available at https www eclipse org legal epl 2 0", "licensed under the eclipse public license version 2 0", "released under the eclipse public license version 2 0", "spdx license identifier epl 2 0", "eclipse public license v 2 0"),
    "Epl10Name": ("this program and the accompanying materials are made available under the terms of the eclipse public license v1 0 which accompanies this distribution and is available at http www eclipse org legal epl v10 html", "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0", "licensed under the eclipse public license version 1 0", "released under the eclipse public license version 1 0", "spdx license identifier epl 1 0", "eclipse public license v 1 0"),
    "Gpl2Body": ("gnu general public license version 2 june 1991",),
    "Gpl3Body": ("gnu general public license version 3 29 june 2007",),
    "Lgpl21Body": ("gnu lesser general public license version 2 1 february 1999",),
    "Lgpl3Body": ("gnu lesser general public license version 3 29 june 2007",),
    "Agpl3Body": ("gnu affero general public license version 3 19 november 2007",),
    "FsfVerbatim": ("everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed",),
    "GnuWarranty": tuple(f"this {w} is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose" for w in ("program", "library")),
}
_GNU = {"Gpl": "gnu general public license", "Lgpl": "gnu lesser general public license", "Agpl": "gnu affero general public license"}
_VERSIONS = {"Gpl": ("2", "3"), "Lgpl": ("2 1", "3"), "Agpl": ("3",)}
_CC = ("by", "by sa", "by nd", "by nc", "by nc sa", "by nc nd")
_CC_VERSIONS = ("2 0", "2 5", "3 0", "4 0")
for _kind, _name in _GNU.items():
    for _v in _VERSIONS[_kind]:
        _starts = ("this work is licensed under the", "licensed under the", "released under the", "this program is licensed under the")
        _short = [f"{s} {n} {w}{_v}" for s in _starts for n in (_name, f"gnu {_kind.lower()}", _kind.lower()) for w in ("version ", "v ", "v")]
        _only = [f"this {w} is free software you can redistribute it and or modify it under the terms of the {_name} version {_v} as published by the free software foundation" for w in ("program", "library")]
        SENTENCES[f"{_kind}{_v.replace(' ', '')}Name"] = (*_short, *_only, f"spdx license identifier {_kind.lower()} {_v.split()[0]} {(_v.split() + ['0'])[1]} only")
        SENTENCES[f"{_kind}{_v.replace(' ', '')}Later"] = tuple(f"this {w} is free software you can redistribute it and or modify it under the terms of the {_name} as published by the free software foundation either version {_v} of the license or at your option any later version" for w in ("program", "library"))
for _terms in _CC:
    for _v in _CC_VERSIONS:
        _starts = ("licensed under", "released under", "this work is licensed under", "published under")
        SENTENCES[f"Cc{_terms.title().replace(' ', '')}{_v.replace(' ', '')}"] = (*(f"{s} {cc} {_terms} {_v}" for s in _starts for cc in ("cc", "creative commons")), f"spdx license identifier cc {_terms} {_v}")

#: More forms of the same identifiers, made by rule.
MORE: dict[str, tuple[str, ...]] = {
    f"{kind}{v.replace(' ', '')}Later": (f"spdx license identifier {kind.lower()} {(v + ' 0')[:3]} or later",) for kind in _GNU for v in _VERSIONS[kind]
}
_LONG = {"by": "attribution", "sa": "sharealike", "nd": "noderivatives", "nc": "noncommercial"}
_SCOPE = {"2 0": "generic", "2 5": "generic", "3 0": "unported", "4 0": "international"}
for _terms in _CC:
    for _v in _CC_VERSIONS:
        _long = " ".join(_LONG[x] for x in _terms.split())
        _names = [f"creative commons {x} {_v}{scope}{end}" for x in dict.fromkeys((_long, _long.replace("noderivatives", "noderivs"))) for scope in ("", f" {_SCOPE[_v]}") for end in ("", " license", " public license")]
        _starts = ("", *(f"{s} {a}" for s in ("licensed under", "released under", "this work is licensed under", "published under") for a in ("", "a ", "the ")))
        MORE[f"Cc{_terms.title().replace(' ', '')}{_v.replace(' ', '')}"] = tuple(dict.fromkeys(s + n for s in _starts for n in _names))

# What licences are called for short, and what stands before it.
_TITLES = {
    "MitName": ("mit license", "mit"),
    "ApacheName": ("apache license version 2 0", "apache license 2 0", "apache 2 0 license", "apache 2 0"),
    "BsdName": ("bsd license", "new bsd license", "simplified bsd license", "bsd 3 clause license", "bsd 2 clause license", "bsd 3 clause", "bsd 2 clause"),
    "MplName": ("mozilla public license version 2 0", "mozilla public license 2 0", "mpl 2 0"),
    "ZlibName": ("zlib license", "zlib"),
    "UnlicenseName": ("unlicense",),
    "Epl20Name": ("eclipse public license version 2 0", "eclipse public license 2 0", "epl 2 0"),
    "Epl10Name": ("eclipse public license version 1 0", "eclipse public license 1 0", "epl 1 0"),
}
def _more(name: str, titles: tuple[str, ...]) -> None:
    forms = [f"{start} {title}" for title in titles for start in ("licensed under the", "released under the", "licensed under", "released under", "license", "licence", "spdx license identifier")]
    MORE[name] = tuple(dict.fromkeys((*MORE.get(name, ()), *(f for f in forms if f not in SENTENCES.get(name, ())))))


for _name, _titles in _TITLES.items():
    _more(_name, _titles)
for _kind, _name in _GNU.items():
    for _v in _VERSIONS[_kind]:
        _own = tuple(f"{n} {w}{_v}" for n in (_name, f"gnu {_kind.lower()}", _kind.lower()) for w in ("version ", "v ", "v"))
        _more(f"{_kind}{_v.replace(' ', '')}Name", _own)
        _more(f"{_kind}{_v.replace(' ', '')}Later", tuple(f"{x} or {end}" for x in _own for end in ("later", "any later version", "at your option any later version")))
for _terms in _CC:
    for _v in _CC_VERSIONS:
        _id = f"Cc{_terms.title().replace(' ', '')}{_v.replace(' ', '')}"
        MORE[_id] = tuple(dict.fromkeys((*MORE[_id], *(f"{start}cc {_terms} {_v}" for start in ("", "license ", "licence ")))))

#: Ways to say that something is under a licence, at a sentence's start, which are all written as one.
_THIS = "this (?:project|software|program|library|package|code|file|work) is "
_UNDER = f"(?:(?:{_THIS})?(?:(?:distributed|available|made available|provided) under the(?: terms of the)?|(?:licensed|released) under the terms of the)|{_THIS}(?:licensed|released) under the) "
#: What names several licences is written as so many sentences: the parts of an SPDX expression, and what one may choose between; what follows WITH is left out.
_SPDX = "spdx license identifier"
_SEVERAL = (
    (rf"(?<![^\n\x01]){_UNDER.replace(' ', '[ \n]')}", "licensed under the "),
    (rf"({_SPDX}[a-z0-9 ]*?) with [a-z0-9 ]*?exception(?: [0-9]+)*", "$1"),
    *[(rf"({_SPDX} [a-z0-9 ]*?) (?:or|and) (?!later)", f"$1\x01{_SPDX} ")] * 3,
    (r"licensed[ \n]under[ \n]either[ \n]of[ \n](?:the[ \n])?([a-z0-9 \n]*?)[ \n]or[ \n](?:the[ \n])?([a-z0-9 \n]*?)(?:[ \n]at[ \n]your[ \n]option)?(?=\x01|$)", "licensed under the $1\x01licensed under the $2"),
)

#: Licences with the runs of identifiers that name them, the more specific first.
RULES: list[tuple[str, tuple[str, ...]]] = [
    ("Apache-2.0", ("ApacheName", "ApacheUse", "ApacheCopy", "ApacheAsIs")),
    ("Apache-2.0", ("ApacheName", "ApacheUse")),
    ("Apache-2.0", ("ApacheBody",)),
    ("BSD-3-Clause", ("BsdGrant", "BsdSource", "BsdBinary", "BsdEndorse", "BsdAsIs")),
    ("BSD-3-Clause", ("BsdGrant", "BsdSource", "BsdBinary", "BsdEndorse")),
    ("BSD-2-Clause", ("BsdGrant", "BsdSource", "BsdBinary", "BsdAsIs")),
    ("BSD-2-Clause", ("BsdGrant", "BsdSource", "BsdBinary")),
    ("MIT", ("MitGrant", "MitNotice", "MitAsIs", "MitLiability")),
    ("MIT", ("MitGrant", "MitNotice", "MitAsIs")),
    ("MIT", ("MitGrant", "MitNotice")),
    ("ISC", ("IscGrant", "IscAsIs")),
    ("ISC", ("IscGrant", "MitAsIs")),
    ("ISC", ("IscGrant",)),
    ("Apache-2.0", ("ApacheName",)),
    ("MIT", ("MitName",)),
    ("BSD", ("BsdName",)),
    ("Zlib", ("ZlibAsIs", "ZlibGrant")),
    ("Zlib", ("ZlibGrant",)),
    ("Zlib", ("ZlibName",)),
    ("MPL-2.0", ("MplTitle", "MplName", "MplCopy")),
    ("MPL-2.0", ("MplName", "MplCopy")),
    ("MPL-2.0", ("MplName",)),
    ("MPL-2.0", ("MplCopy",)),
    ("MPL-2.0", ("MplTitle",)),
    ("EPL-2.0", ("Epl20Name",)),
    ("EPL-1.0", ("Epl10Name",)),
    ("Unlicense", ("PublicDomain", "UnlicenseFree")),
    ("Unlicense", ("UnlicenseFree",)),
    ("Unlicense", ("UnlicenseName",)),
    *((f"{kind.upper()}-{(v.replace(' ', '.') + '.0')[:3]}", run) for kind in _GNU for v in _VERSIONS[kind] for run in ((f"{kind}{v.replace(' ', '')}Body", "FsfVerbatim"), (f"{kind}{v.replace(' ', '')}Body",))),
    *((f"{kind.upper()}-{v.replace(' ', '.')}-or-later", (f"{kind}{v.replace(' ', '')}Later", "GnuWarranty")) for kind in _GNU for v in _VERSIONS[kind]),
    *((f"{kind.upper()}-{v.replace(' ', '.')}-or-later", (f"{kind}{v.replace(' ', '')}Later",)) for kind in _GNU for v in _VERSIONS[kind]),
    *((f"{kind.upper()}-{(v.replace(' ', '.') + '.0')[:3]}", (f"{kind}{v.replace(' ', '')}Name", "GnuWarranty")) for kind in _GNU for v in _VERSIONS[kind]),
    *((f"{kind.upper()}-{(v.replace(' ', '.') + '.0')[:3]}", (f"{kind}{v.replace(' ', '')}Name",)) for kind in _GNU for v in _VERSIONS[kind]),
    *((f"CC-{t.upper().replace(' ', '-')}-{v.replace(' ', '.')}", (f"Cc{t.title().replace(' ', '')}{v.replace(' ', '')}",)) for t in _CC for v in _CC_VERSIONS),
    ("Public-Domain", ("PublicDomain",)),
    ("Proprietary", ("AllRights",)),
]
#: Every known sentence matches this, so a text that does not has none.
_ANCHOR = r"licen|permission|redistribution|copyright|neither\W+the\W+name|public\W+domain|rights\W+reserved|provided\W+as\W+is|under\W+cc\W|creative\W+commons|required\W+by\W+applicable|free\W+to\W+copy|in\W+the\W+hope|copy\W+of\W+the\W+mpl|gpl|\bcc\W+by\W|under\W+(?:the\W+)?(?:terms\W+of\W+the\W+)?(?:mit|apache|(?:new\W+|simplified\W+)?bsd|mpl|zlib|epl|eclipse|gnu)\b"


def _pattern(sentences: list[str]) -> str:
    """A regular expression of all the sentences, longer ones first, where each space may be a line end."""
    tree: dict = {}
    for s in sentences:
        node = tree
        for w in s.split():
            node = node.setdefault(w, {})
        node[""] = {}

    def rest(node: dict) -> str:
        ways = [f"[ \n]{w}{rest(n)}" for w, n in node.items() if w] + [r"(?![^\n\x01])"] * ("" in node)
        return ways[0] if len(ways) == 1 else f"(?:{'|'.join(ways)})"

    return rf"(?<![^\n\x01])(?:{'|'.join(w + rest(n) for w, n in tree.items())})"


def identifiers(text: Column) -> Column:
    """The identifiers of a text's known sentences, in order; none where the text has no anchor."""
    known = {s: name for more in (SENTENCES, MORE) for name, forms in more.items() for s in forms}
    names = F.create_map(*(F.lit(x) for pair in known.items() for x in pair))
    # \x01 ends a sentence, and a line end that is left is one within a paragraph
    plain = F.translate(F.lower(text), "\x01", " ")
    for old, new in (
        (r"\bv\.(?=[^a-z0-9.!?]+[0-9])", "v"),
        (r"[.!?]+(?=\s|$)", "\x01"),
        (r"(?<![^\n])[^a-z0-9\n\x01]*+[a-z0-9]{1,2}\)(?=\s)", "\x01"),
        (r"[^a-z0-9\n\x01]+", " "),
        (r"[ \n\x01]*(?:\x01|\n ?\n)[ \n\x01]*", "\x01"),
        (r" ?\n ?", "\n"),
        *_SEVERAL,
    ):
        plain = F.regexp_replace(plain, old, new)
    met = F.regexp_extract_all(F.trim(plain), F.lit(_pattern(list(known))), F.lit(0))
    found = F.transform(met, lambda s: F.element_at(names, F.translate(s, "\n", " ")))
    return F.when(F.lower(text).rlike(_ANCHOR), found).otherwise(F.array().cast("array<string>"))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, sentences, licenses, unruled): identifiers found, licences by rule, and identifiers that no rule took."""
    df = docs.select("doc_id", F.coalesce(identifiers(F.col(text)), F.array().cast("array<string>")).alias("sentences"))
    df = df.withColumn("left", F.concat(F.lit("|"), F.array_join("sentences", "||"), F.lit("|")))
    step = F.struct(F.col("left").alias("left"), F.array().cast("array<string>").alias("licenses"))
    rules = F.array(*(F.struct(F.lit(name).alias("name"), F.lit("".join(f"|{s}|" for s in run)).alias("run")) for name, run in RULES))

    def apply(state: Column, rule: Column) -> Column:
        hit = F.contains(state["left"], rule["run"])
        return F.struct(
            F.when(hit, F.replace(state["left"], rule["run"], F.lit(" "))).otherwise(state["left"]).alias("left"),
            F.when(hit, F.array_union(state["licenses"], F.array(rule["name"]))).otherwise(state["licenses"]).alias("licenses"),
        )

    done = F.when(F.size("sentences") > 0, F.aggregate(rules, step, apply))
    df = df.withColumn("done", done)
    empty = F.array().cast("array<string>")
    unruled = F.filter(F.split("done.left", "[| ]+"), lambda s: s != "")
    return df.select("doc_id", "sentences", F.coalesce("done.licenses", empty).alias("licenses"), F.coalesce(unruled, empty).alias("unruled"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scan(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.size("sentences").cast("long").alias("n_sentences"), F.array_join("sentences", ",").alias("sentences"), F.array_join("licenses", ",").alias("licenses"), F.size("unruled").cast("long").alias("n_unruled"))


def _oracle() -> str:
    """The same, sentence by sentence, for texts whose known sentences aren't wrapped."""
    known = ", ".join(f"('{s}', '{name}')" for more in (SENTENCES, MORE) for name, forms in more.items() for s in forms)
    steps = ["SELECT doc_id, ids, '|' || array_to_string(ids, '||') || '|' AS l0 FROM found"]
    for k, (_, run) in enumerate(RULES):
        key = "".join(f"|{s}|" for s in run)
        steps.append(f"SELECT *, replace(l{k}, '{key}', ' ') AS l{k + 1} FROM s{k}")
    chain = ", ".join(f"s{k} AS ({s})" for k, s in enumerate(steps))
    hits = ", ".join(f"CASE WHEN l{k} <> l{k + 1} THEN '{name}' END" for k, (name, _) in enumerate(RULES))
    n = len(RULES)
    spdx = f"list_transform(regexp_split_to_array(replace(regexp_replace(s, ' with [a-z0-9 ]*?exception( [0-9]+)*', '', 'g'), ' or later', ' orlater'), ' (or|and) '), lambda x, i: replace(CASE WHEN i = 1 THEN x ELSE '{_SPDX} ' || x END, ' orlater', ' or later'))"
    either = "list_transform(regexp_split_to_array(regexp_replace(regexp_replace(s, '^licensed under either of (the )?', ''), ' at your option$', ''), ' or (the )?'), lambda x: 'licensed under the ' || x)"
    several = f"CASE WHEN s LIKE '{_SPDX} %' THEN {spdx} WHEN s LIKE 'licensed under either of % or %' THEN {either} ELSE [s] END"
    return f"""WITH known(s, id) AS (VALUES {known}), k AS MATERIALIZED (SELECT map(list(s), list(id)) AS m FROM known),
    cut AS (SELECT doc_id, list_transform(regexp_split_to_array(regexp_replace(lower(coalesce(text, '')), '[.!?]+(\\s|$)', chr(10) || '\\1', 'g'), '\\n'), lambda s: trim(regexp_replace(s, '[^a-z0-9]+', ' ', 'g'))) AS parts FROM documents),
    each AS (SELECT doc_id, flatten(list_transform(list_transform(parts, lambda s: regexp_replace(s, '^{_UNDER}', 'licensed under the ')), lambda s: {several})) AS parts FROM cut),
    found AS (SELECT doc_id, list_filter(list_transform(parts, lambda s: m[s]), lambda i: i IS NOT NULL) AS ids FROM each, k), {chain},
    named AS (SELECT doc_id, ids, l{n} AS rest, list_filter([{hits}], lambda h: h IS NOT NULL) AS hits FROM s{n})
    SELECT doc_id, len(ids)::BIGINT AS n_sentences, coalesce(array_to_string(ids, ','), '') AS sentences,
      coalesce(array_to_string(list_filter(hits, lambda h, i: list_position(hits, h) = i), ','), '') AS licenses,
      len(list_filter(regexp_split_to_array(rest, '[| ]+'), lambda x: x <> ''))::BIGINT AS n_unruled FROM named"""


ORACLE_SQL = _oracle()
