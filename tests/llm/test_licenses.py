import duckdb
import pytest

from sieveworks.llm import licenses
from sieveworks.llm.queries import ORACLES, op6_license_templates


def accepts(template, text):
    words = licenses.re.findall(licenses.WORD, text.lower().encode())
    a = licenses.Automaton(licenses.parse(template))
    return any(a.match(words, i) is not None for i in range(len(words) + 1))


def test_query_against_sql(spark, sf):
    got = sorted(map(tuple, op6_license_templates(spark, sf).collect()), key=str)
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    assert got == sorted(db.sql(ORACLES["op6_license_templates"]).fetchall(), key=str)


@pytest.mark.parametrize(
    "text, want",
    [("Licensed under the Apache License, Version 2.0.", True), ("licensed under the apache license 2.0", True), ("licensed under the Apache public License 2.0", False), ("licensed under the apache license version 2", False)],
)
def test_optional(text, want):
    assert accepts("licensed under the apache license<<beginOptional>>, version<<endOptional>> 2.0", text) is want


def test_replaceable_and_nested():
    t = "copyright <<beginOptional>>(c) <<beginOptional>>year<<endOptional>><<endOptional>> <<var;words=1..3>> all rights reserved"
    assert accepts(t, "Copyright (c) 2024 Ann, all rights reserved")
    assert accepts(t, "x copyright c year Ann B C All Rights Reserved y")
    assert not accepts(t, "copyright all rights reserved")
    assert not accepts(t, "copyright one two three four all rights reserved")


@pytest.mark.parametrize("bad", ["a <<endOptional>>", "<<beginOptional>> a", "a <<other>>"])
def test_bad_markup(bad):
    with pytest.raises(ValueError):
        licenses.parse(bad)


def test_template_needs_mandatory_words():
    with pytest.raises(ValueError):
        licenses.Scanner(templates=(("x", "<<beginOptional>>a<<endOptional>>"),))


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "CC BY cc-by, c cby"), (None, "all rights\nreserved"), (4, "Ünder the MIT License released under the mit license"), (4, "x"), (5, "gnu general, public license " * 3000), (6, "all rights reservedé")]
    df = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, N_WORDS int")
    got = {(r.doc_id, r.n_words): (r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) for r in licenses.scan(df).collect()}
    assert got[1, 0] == got[2, 0] == (0, None, None, "", "", 0.0)
    assert got[3, 6] == (2, 0, 2, "cc-by", "cc-by", 0.5)
    assert got[None, 3] == (1, 0, 0, "reserved", "reserved", 0.5)
    assert got[4, 9] == (0, None, None, "", "mit", 1.0)
    assert got[5, 12000] == (3000, 1, 11997, "gpl", "gpl", 0.5)
    assert got[6, 3][0] == 0 and got[4, 1][0] == 0
    assert licenses.scan(df.limit(0)).count() == 0


def test_whole_texts_and_notices():
    """Whole licence texts with their replaceable parts filled in, the usual notices, and texts with a mandatory word changed."""
    scanner = licenses.Scanner()
    labels = lambda text: set(scanner(text.encode())[5].split(","))
    mit = """MIT License

    Copyright (c) 2020 Foo Bar <foo@bar.org>

    Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal
    in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
    copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

    The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

    THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
    FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
    LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN
    THE SOFTWARE."""
    assert labels(mit) >= {"mit", "mit-text"}
    assert "mit-text" not in labels(mit.replace("tort", "court").replace("TORT", "COURT")) and "mit" in labels(mit.replace("TORT", "COURT"))
    assert labels("MIT License\nCopyright (c) 2020 Foo") == {"mit"}
    assert labels("// SPDX-License-Identifier: MIT\nint x;") == {"mit"} and "gpl-3.0" in labels("SPDX-License-Identifier: GPL-3.0-or-later")
    assert labels("subject to the Mozilla Public License, v. 2.0") == labels("Mozilla Public License Version 2.0") == {"mpl-2.0"}
    gpl = "it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    assert labels(gpl) == {"gpl", "gpl-3.0"} and "gpl-3.0" not in labels(gpl.replace("version 3", "version 4"))
    bsd = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
    1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
    2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation
    and/or other materials provided with the distribution.
    3. Neither the name of the University nor the names of its contributors may be used to endorse or promote products derived from this software without
    specific prior written permission."""
    assert labels(bsd) == {"bsd", "bsd-3-clause"} == labels(bsd.replace("1.", "*").replace("2.", "*").replace("3.", "-"))
    assert labels("a text about the permission to copy a license") == {""}
