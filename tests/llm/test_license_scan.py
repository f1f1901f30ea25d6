import re
import string

import pytest

from pulsegrain.llm import license_scan

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def by_hand(doc, text):
    tokens = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    places = sorted((i, label) for p, label in license_scan.BASE_PHRASES.items() for i in range(len(tokens))
                    if tokens[i:i + len(p.split())] == p.split())
    starts = [p for p, _ in places]
    return doc, len(tokens), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({b for _, b in places}))


# The full wording of public licences.
NOTICE = "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
    "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
    "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
    "subject to the following conditions: " + NOTICE + "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR "
    "IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
    "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
    "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
    "the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS "
    "ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE "
    "AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA "
    "OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
    "PERFORMANCE OF THIS SOFTWARE.")
_CLAUSES = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
    "are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution. ")
_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT "
    "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT "
    "HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT "
    "LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY "
    "THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
    "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
BSD2 = _CLAUSES + _DISCLAIMER
BSD3 = _CLAUSES + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products " \
    "derived from this software without specific prior written permission. " + _DISCLAIMER

BASE = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"]


def test_base_columns_match_by_hand(odd, rows):
    assert rows(license_scan.scan(odd), *BASE) == sorted((by_hand(r.doc_id, r.text) for r in odd.collect()), key=repr)


def test_base_columns_of_documents(spark, sf_dir, rows):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    got = license_scan.op10_license_scan(spark, sf_dir)
    assert rows(got, *BASE) == sorted((by_hand(r.doc_id, r.text) for r in docs), key=repr)
    assert got.where("base_labels <> '' AND NOT (labels LIKE '%notice%')").count() < got.where("base_labels <> ''").count()


@pytest.mark.parametrize("text, label", [
    ("x Released under the MIT License. y", "mit-notice"),
    ("Licensed under the Apache License, Version 2.0", "apache-2.0-notice"),
    ("Licensed under Apache License 2.0", "apache-2.0-notice"),
    ("is licensed under the GNU General Public License, version 3.", "gpl-3.0-notice"),
    (MIT, "mit"), (MIT.replace("permission notice", "permission notice (including the next paragraph)").replace("AUTHORS OR COPYRIGHT HOLDERS", "X CONSORTIUM"), "mit"),
    (ISC, "isc"), (ISC.replace("and/or", "and"), "isc"), (BSD2, "bsd-2-clause"), (BSD3, "bsd-3-clause"),
    ("Copyright (c) 2024 Ann Onymous. All rights reserved. " + BSD2, "bsd-2-clause"),
])
def test_templates_accept(text, label):
    made = license_scan.compile_template(label, license_scan.TEMPLATES[label])
    assert made.accepts(license_scan.words(text))


@pytest.mark.parametrize("text, label", [
    ("Licensed under the Apache Software License, Version 2.0", "apache-2.0-notice"),
    ("Licensed under the Apache License, Version 1.1", "apache-2.0-notice"),
    ("licensed under the GNU Lesser General Public License, version 3", "gpl-3.0-notice"),
    ("", "mit"),
    (MIT.split("and to permit")[0], "mit"),
    (MIT.split("and to permit")[0] + "but never on Tuesdays and only for Good, not Evil", "mit"),
    (MIT.replace("THE SOFTWARE IS PROVIDED", "The Software shall be used for Good, not Evil. THE SOFTWARE IS PROVIDED"), "mit"),
    (MIT.replace(NOTICE, ""), "mit"), (MIT.replace("ANY CLAIM", "SOME CLAIM"), "mit"),
    (ISC.split("THE SOFTWARE")[0], "isc"), (ISC.replace("NEGLIGENCE ", ""), "isc"),
    (BSD2.split("THIS SOFTWARE")[0] + "THIS SOFTWARE IS PROVIDED BY", "bsd-2-clause"), (BSD3, "bsd-2-clause"), (BSD2, "bsd-3-clause"),
    (BSD3.replace("EVEN IF ADVISED", "IF ADVISED"), "bsd-3-clause"),
])
def test_changed_mandatory_wording_is_refused(text, label):
    assert not license_scan.compile_template(label, license_scan.TEMPLATES[label]).accepts(license_scan.words(text))


def test_regions_match_a_pattern_of_the_same_markup():
    import itertools

    made = license_scan.compile_template("t", "a <<beginOptional>>b <<beginOptional>>c<<endOptional>><<endOptional>> <<var;name=v;words=1-2>> d")
    pattern = re.compile(r"a( b( c)?)?( [abcd]){1,2} d")
    for n in range(1, 7):
        for text in itertools.product("abcd", repeat=n):
            line = " ".join(text)
            assert made.accepts(license_scan.words(line)) == bool(pattern.search(line)), line


def test_empty_table(nothing):
    assert license_scan.scan(nothing).count() == 0
