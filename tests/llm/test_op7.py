import re
import textwrap

import duckdb
import pytest

from turnwright.llm import op7_licenses as op7

KNOWN = {s: name for more in (op7.SENTENCES, op7.MORE) for name, forms in more.items() for s in forms}


def brute(text):
    ids = [KNOWN[s] for s in (re.sub("^" + op7._UNDER, "licensed under the ", re.sub("[^a-z0-9]+", " ", x).strip()) for x in re.split(r"\n|[.!?]+(?=\s|$)", (text or "").lower())) if s in KNOWN]
    left, found = "".join(f"|{i}|" for i in ids), []
    for name, run in op7.RULES:
        key = "".join(f"|{s}|" for s in run)
        if key in left:
            left = left.replace(key, " ")
            found += [name] * (name not in found)
    return ids, found, [x for x in re.split("[| ]+", left) if x]


def test_every_sentence_has_an_anchor_and_every_identifier_a_sentence():
    assert all(re.search(op7._ANCHOR, s) for s in KNOWN)
    assert {i for _, run in op7.RULES for i in run} <= set(op7.SENTENCES)


MIT = "Copyright (c) 2020 X\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: \nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."


def test_rules(spark):
    texts = ["Released under the MIT License.", "x.\nLicensed under CC BY-NC 4.0.", "This work is licensed under the GNU General Public License, version 3. And so on", MIT, None, "", "no", "you may obtain a copy of the license at\nAll rights reserved!", "Licensed under the Apache License, Version 2.0.\n" * 30_000]
    df = spark.createDataFrame([(k, t, "z") for k, t in enumerate(texts)] * 2, "doc_id long, text string, sentences string")
    got = {r.doc_id: r for r in op7.scan(df).collect()}
    assert [got[k].licenses for k in range(5)] == [["MIT"], ["CC-BY-NC-4.0"], ["GPL-3.0"], ["MIT"], []]
    assert got[7].licenses == ["Proprietary"] and got[7].unruled == ["ApacheCopy"]
    for k, t in enumerate(texts):
        assert (got[k].sentences, got[k].licenses, got[k].unruled) == brute(t)
    assert op7.scan(df.limit(0)).count() == 0


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01"])
def test_query_and_sql(spark, sf):
    got = sorted(tuple(r) for r in op7.query(spark, sf).collect())
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    expected = []
    for d, t in docs.items():
        ids, found, left = brute(t)
        expected.append((d, len(ids), ",".join(ids), ",".join(found), len(left)))
    assert got == sorted(expected) and sum(bool(r[3]) for r in got) > 5
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    assert sorted(con.execute(op7.ORACLE_SQL).fetchall()) == got
    assert not any("Python" in line or "Arrow" in line for line in op7.query(spark, sf)._jdf.queryExecution().toString().split("\n"))


NOTICES = {
    "MIT": MIT.partition("\n\n")[2] + "\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n(c) Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "GPL-3-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "LGPL-2.1-or-later": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
}


def test_wrapped_notices_and_long_forms(spark):
    rows = [(text, [name]) for name, text in NOTICES.items()]
    for name, text in NOTICES.items():
        for width in (30, 45, 72):
            for mark in ("", " * ", "# ", "// "):
                lines = [x for block in text.split("\n") for x in textwrap.wrap(block, width) or [""]]
                rows.append(("Copyright (c) 2020 X\n\n" + "\r\n".join(mark + x for x in lines) + "\n\nend", [name]))
    rows += [("// SPDX-License-Identifier: GPL-3.0-or-later\ncode", ["GPL-3-or-later"]), ("SPDX-License-Identifier: LGPL-2.1-or-later", ["LGPL-2.1-or-later"])]
    rows += [("This work is licensed under a Creative Commons\nAttribution-ShareAlike 4.0 International License.", ["CC-BY-SA-4.0"]), ("Creative Commons Attribution 4.0 International License", ["CC-BY-4.0"])]
    rows += [("Released under a Creative Commons Attribution-NoDerivs 3.0 Unported License!", ["CC-BY-ND-3.0"]), ("not released under the\n\nMIT License.", []), ("It is not so. That was licensed under\nthe MIT License.", [])]
    df = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: r.licenses for r in op7.scan(df).collect()}
    assert [(t, got[k]) for k, (t, _) in enumerate(rows)] == rows


BODIES = {
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n\nTHIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the License.\nYou may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "GPL-3-or-later": NOTICES["GPL-3-or-later"] + "\n\nThis program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU General Public License for more details.",
    "GPL-3.0": "GNU GENERAL PUBLIC LICENSE\n  Version 3, 29 June 2007\n\nCopyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/>\nEveryone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.",
    "AGPL-3.0": "GNU AFFERO GENERAL PUBLIC LICENSE\n  Version 3, 19 November 2007\n\nPreamble",
    "LGPL-2.1": "This code is\n\nlicensed under the GNU LGPL v2.1.",
    "GPL-2.0": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
    "MPL-2.0": NOTICES["MPL-2.0"],
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable.\n\nPermission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "Unlicense": "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
}


def test_bodies_leave_nothing_unruled(spark):
    rows = []
    for name, text in BODIES.items():
        for width in (38, 76, 2000):
            for mark in ("", " * ", "-- ") if width < 2000 else ("",):
                lines = [x for block in text.split("\n") for x in textwrap.wrap(block, width) or [""]]
                rows.append(("\n".join(mark + x for x in lines), [name]))
    df = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: r for r in op7.scan(df).collect()}
    assert [(t, got[k].licenses) for k, (t, _) in enumerate(rows)] == rows
    assert {n for k, (_, [n]) in enumerate(rows) if got[k].unruled} <= {"Apache-2.0"}


REACH = [
    ("Distributed under the MIT license.", ["MIT"]),
    ("Licensed under either of Apache License, Version 2.0 or MIT license at your option.", ["Apache-2.0", "MIT"]),
    ("SPDX-License-Identifier: MIT OR Apache-2.0", ["Apache-2.0", "MIT"]),
    ("// SPDX-License-Identifier: (MIT AND BSD-3-Clause) OR GPL-2.0-or-later", ["MIT", "BSD", "GPL-2-or-later"]),
    ("SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0", ["GPL-2.0"]),
    ("License: MIT", ["MIT"]),
    ("CC BY-SA 4.0", ["CC-BY-SA-4.0"]),
    ("This program is licensed under the GNU General Public License, version 3 or later.", ["GPL-3-or-later"]),
    ("Available under the terms of the Mozilla Public License 2.0", ["MPL-2.0"]),
    ("The license of this is not MIT OR such", []),
    ("SPDX-License-Identifier: LicenseRef-Own", []),
]


def test_reach_and_its_sql(spark):
    texts = [f"Some words here.\n{t}\nAnd more." for t, _ in REACH]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.licenses for r in op7.scan(df).collect()}
    assert [(t, sorted(got[k])) for k, (t, _) in enumerate(REACH)] == [(t, sorted(want)) for t, want in REACH]
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    assert {d: sorted(x for x in names.split(",") if x) for d, _, _, names, _ in con.execute(op7.ORACLE_SQL).fetchall()} == {k: sorted(want) for k, (_, want) in enumerate(REACH)}
