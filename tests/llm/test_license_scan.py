from matchlake.llm import license_scan as S


def hits(spark, rows):
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, license string, digest string")
    return sorted(tuple(r) for r in S.scan(docs).collect())


def test_whole_documents_paragraphs_and_lines(spark):
    mit = "Copyright (c) 2020-2021 Some One\n\n" + S._MIT.replace("copy of", "copy\nof").upper()
    rows = [(1, mit), (2, "Intro words.\n\n" + S._MIT), (3, "prose\nReleased under the MIT License.\nmore prose"),
            (4, "This work is licensed under the GNU General Public License, version 3."),
            (5, "Released under the MIT licence"), (6, "He spoke of the MIT License today."),
            (7, "Licensed under Creative Commons Attribution-NonCommercial 4.0"), (8, "Licensed under CC BY-NC 4.0."),
            (9, "SPDX-License-Identifier: Apache-2.0\nint main;"), (10, "Distributed under the GNU GPL v3")]
    assert hits(spark, rows) == [
        (1, "MIT", "document"), (3, "MIT", "part"), (4, "GPL-3.0", "document"), (5, "MIT", "document"),
        (7, "CC-BY-NC-4.0", "document"), (8, "CC-BY-NC-4.0", "document"), (9, "Apache-2.0", "part"),
        (10, "GPL-3.0", "document")]


def test_a_paragraph_that_is_a_whole_licence(spark):
    apache = "Licensed under the Apache License, Version 2.0"
    assert hits(spark, [(1, f"one\n\n{apache}\n\nthree"), (1, f"one\n\n{apache}\n\nthree")]) == [(1, "Apache-2.0", "part")]


def test_copyright_lines_do_not_count(spark):
    text = S._ISC.replace("\n\n", "\n\nCopyright (C) 1999 Foo\n\n")
    assert hits(spark, [(1, "© 2020 A\n" + text + "\nAll rights reserved."), (2, "Copyright (c) 2020")]) == [
        (1, "ISC", "document")]


def test_edge_cases(edge_docs, no_docs, spark):
    assert S.scan(edge_docs).collect() == [] and S.scan(no_docs).collect() == []
    got = S.scan(spark.createDataFrame([(None, "Released under the MIT License."), (2, "x " * 300_000 + "\nReleased under MIT")],
                                       "doc_id long, text string")).collect()
    assert {(r.doc_id, r.license, r.scope) for r in got} == {(None, "MIT", "document"), (2, "MIT", "part")}


def test_digests_name_one_licence(spark):
    known = spark.createDataFrame(S.known_texts(), "license string, known string").select(
        "license", S.canonical_spelling(S._one_line(S.canonical_lines(S.F.lower("known")))).alias("c")).distinct()
    assert known.groupBy("c").count().where("count > 1").collect() == []
    assert known.where(~S.telling(S.F.col("c"))).collect() == []       # the words looked for first lose no hit


BSD3 = """BSD 3-Clause License

Copyright (c) 2021, Some One
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
GPL3 = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.

    You should have received a copy of the GNU General Public License
    along with this program.  If not, see <https://www.gnu.org/licenses/>.
"""


def test_short_licences_and_usual_notices(spark):
    third = BSD3.index("3. Neither"), BSD3.index("THIS SOFTWARE")
    two = BSD3.replace("3-", "2-")[:third[0]] + BSD3[third[1]:]
    lgpl = GPL3.replace("General", "Lesser General").replace("version 3", "version 2.1").replace("program", "library")
    mpl = ("This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not "
           "distributed with this\nfile, You can obtain one at https://mozilla.org/MPL/2.0/.")
    rows = [(1, BSD3), (2, two), (3, S._ZLIB.format("acknowledgment")), (4, "Copyright Foo 2003\n\n" + S._BSL),
            (5, S._UNLICENSE + "\n\nFor more information, please refer to <https://unlicense.org>"), (6, GPL3), (7, lgpl),
            (8, GPL3.replace("General", "Affero General")), (9, f"prose\n\n{GPL3}\nint main;"), (10, f"{mpl}\n\nx = 1"),
            (11, BSD3 + "\nMore words.")]
    assert hits(spark, rows) == [
        (1, "BSD-3-Clause", "document"), (2, "BSD-2-Clause", "document"), (3, "Zlib", "document"), (4, "BSL-1.0", "document"),
        (5, "Unlicense", "document"), (6, "GPL-3.0", "document"), (6, "GPL-3.0", "part"), (7, "LGPL-2.1", "document"),
        (7, "LGPL-2.1", "part"), (8, "AGPL-3.0", "document"), (8, "AGPL-3.0", "part"), (9, "GPL-3.0", "part"),
        (10, "MPL-2.0", "part")]


def test_known_texts_of_the_caller(spark):
    known = spark.createDataFrame([("X", "Do what\nyou like."), ("Y", "Nothing, at all"), ("Z", " - ")], "license string, known string")
    docs = spark.createDataFrame([(1, "do WHAT you like"), (2, "a\n\nNothing at all!\n\nb"), (3, "Released under MIT"), (4, ""),
                                  (5, "a\n\nb")], "doc_id long, text string")
    assert sorted(tuple(r) for r in S.scan(docs, known=known).collect()) == [(1, "X", "document"), (2, "Y", "part")]
