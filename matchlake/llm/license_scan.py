"""License scans by canonical digest.

A text's canonical form has lower-case letters and digits only, single spaces,
no copyright lines, and one spelling for equivalent words.  The digests of
whole documents, of their paragraphs (set apart by blank lines) and of their
lines are joined to the digests of known licence texts and notices: a hit
means that the entire document, paragraph or line is that licence.

The known texts are a fixed list of about 1,300 rows, or a table given by
the caller; up to a million rows are broadcast.  Fixed are the full texts of MIT,
ISC, BSD-2-Clause, BSD-3-Clause, Zlib, BSL-1.0 and Unlicense, the usual notices of
Apache-2.0, MPL-2.0, BSL-1.0 and the GNU licences, and one-line notices of all.

Edge cases: a null or blank text has no hits; a copyright line alone has none.
A licence that a document holds several times is reported once for each scope,
and so are rows that share a doc_id (null is an id like any other).  Texts of
any length are scanned whole.  Only ``doc_id`` and the text are read.  An empty
table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, known_small

MOST_KNOWN = 1_000_000     # known texts that are broadcast

#: SPDX ids and the names that notices use for them.
NAMES = {
    "MIT": ("MIT License", "MIT"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0"),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU GPL v2"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU GPL v3"),
    "LGPL-2.1": ("GNU Lesser General Public License, version 2.1", "GNU LGPL v2.1"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "GNU LGPL v3"),
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "GNU AGPL v3"),
    "BSD-2-Clause": ("BSD 2-Clause License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "Modified BSD License"),
    "ISC": ("ISC License",),
    "MPL-2.0": ("Mozilla Public License, version 2.0", "MPL 2.0"),
    "EPL-2.0": ("Eclipse Public License, version 2.0", "EPL 2.0"),
    "BSL-1.0": ("Boost Software License, Version 1.0",),
    "Zlib": ("zlib License",),
    "Unlicense": ("Unlicense",),
    "CC0-1.0": ("CC0 1.0", "Creative Commons Zero 1.0"),
    **{f"CC-{kind}-{v}": (f"CC {kind} {v}", f"Creative Commons {long} {v}")
       for v in ("3.0", "4.0") for kind, long in (
           ("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"),
           ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
           ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"))},
}
NOTICES = ("Licensed under {}", "Licensed under the {}", "Released under {}", "Released under the {}",
           "Distributed under the {}", "This work is licensed under the {}", "This work is licensed under {}",
           "This work is licensed under a {}", "This file is licensed under the {}", "SPDX-License-Identifier: {id}")
_AS_IS = ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
          "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
          "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN "
          "AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE "
          "OR OTHER DEALINGS IN THE SOFTWARE.")
_MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.\n\n" + _AS_IS)
_ISC = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n"
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
        "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, "
        "DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.")
_APACHE = ("Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
           "compliance with the License. You may obtain a copy of the License at\n\n"
           "http://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, "
           "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
           "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
           "permissions and limitations under the License.")
_BSD_LIABLE = (
    "DISCLAIMED. IN NO EVENT SHALL THE {liable} OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
    "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
    "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
    "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:\n\n"
    "{1}Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer.\n\n"
    "{2}Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
    "following disclaimer in the documentation and/or other materials provided with the distribution.\n\n"
    "{third}THIS SOFTWARE IS PROVIDED BY THE {by} AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    + _BSD_LIABLE)
_BSD_THIRD = ("Neither the name of the {name} nor the names of its contributors may be used to endorse or promote products "
              "derived from this software without specific prior written permission.\n\n")
_ZLIB = (
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
    "liable for any damages arising from the use of this software.\n\n"
    "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to "
    "alter it and redistribute it freely, subject to the following restrictions:\n\n"
    "1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. "
    "If you use this software in a product, an {} in the product documentation would be appreciated but is not "
    "required.\n\n"
    "2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original "
    "software.\n\n"
    "3. This notice may not be removed or altered from any source distribution.")
_BSL = (
    "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
    "accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, "
    "execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to "
    "whom the Software is furnished to do so, all subject to the following:\n\n"
    "The copyright notices in the Software and this entire statement, including the above license grant, this "
    "restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and "
    "all derivative works of the Software, unless such copies or derivative works are solely in the form of "
    "machine-executable object code generated by a source language processor.\n\n"
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL "
    "THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN "
    "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN "
    "THE SOFTWARE.")
_UNLICENSE = (
    "This is free and unencumbered software released into the public domain.\n\n"
    "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form "
    "or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.\n\n"
    "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all "
    "copyright interest in the software to the public domain. We make this dedication for the benefit of the public at "
    "large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of "
    "relinquishment in perpetuity of all present and future rights to this software under copyright law.\n\n"
    + _AS_IS.replace("AUTHORS OR COPYRIGHT HOLDERS", "AUTHORS"))
_BOOST_NOTICE = ("Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at "
                 "{}://www.boost.org/LICENSE_1_0.txt)")
_MPL = ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at {}://mozilla.org/MPL/2.0/.")
_GNU_TERMS = ("under the terms of the {name} as published by the Free Software Foundation, either version {v} of the License, "
              "or (at your option) any later version.",
              "under the terms of the {name} as published by the Free Software Foundation, version {v} of the License.",
              "under the terms of the {name} version {v} as published by the Free Software Foundation.")
_GNU_WARRANTY = ("This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
                 "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details.")
_GNU_COPY = "You should have received a copy of the {name} along with this {what}. If not, "
_GNU_URLS = ("see <http://www.gnu.org/licenses/>.", "see <https://www.gnu.org/licenses/>.")
_FSF = "write to the Free Software Foundation, Inc., "
_GNU_PLACES = (_FSF + "51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA.",
               _FSF + "51 Franklin St, Fifth Floor, Boston, MA 02110-1301 USA.",
               _FSF + "59 Temple Place, Suite 330, Boston, MA 02111-1307 USA.",
               _FSF + "675 Mass Ave, Cambridge, MA 02139, USA.")


def _bsd_texts() -> list[tuple[str, str]]:
    """BSD texts with numbered or marked conditions and the usual holders."""
    out = []
    for by, liable, name in (("COPYRIGHT HOLDERS", "COPYRIGHT HOLDER", "copyright holder"),
                             ("COPYRIGHT HOLDERS", "COPYRIGHT OWNER", "copyright holder"),
                             ("COPYRIGHT HOLDERS", "COPYRIGHT HOLDERS", "copyright holder"),
                             ("REGENTS", "REGENTS", "University")):
        for marks in (("1. ", "2. ", "3. "), ("* ", "* ", "* ")):
            for i, third in (("BSD-2-Clause", ""), ("BSD-3-Clause", marks[2] + _BSD_THIRD.format(name=name))):
                body = _BSD.format(None, *marks[:2], third=third, by=by, liable=liable)
                titles = [*NAMES[i], f"The {NAMES[i][0]}"]
                out += [(i, body)] + [(i, f"{t}\n\n{body}") for t in titles]
    return out


def _gnu_texts() -> list[tuple[str, str]]:
    """The notices that files under a GNU licence carry: the paragraph that names
    the licence, and the notice of two or three paragraphs."""
    out = []
    for i, name, v in (("GPL-2.0", "GNU General Public License", "2"), ("GPL-3.0", "GNU General Public License", "3"),
                       ("LGPL-2.1", "GNU Lesser General Public License", "2.1"),
                       ("LGPL-3.0", "GNU Lesser General Public License", "3"),
                       ("AGPL-3.0", "GNU Affero General Public License", "3")):
        for what in ("program", "library", "software"):
            copies = ["", *(_GNU_COPY + x for x in _GNU_URLS + (_GNU_PLACES if v < "3" else ()))]
            for terms in _GNU_TERMS:
                first = f"This {what} is free software: you can redistribute it and/or modify it {terms}"
                for text in [first] + [f"{first}\n\n{_GNU_WARRANTY}\n\n{c}" for c in copies]:
                    out.append((i, text.format(name=name, v=v, what=what).strip()))
    return out


#: Full texts without their titles and copyright lines, and notices of several lines.
TEXTS = (("MIT", _MIT), ("MIT", "MIT License\n\n" + _MIT), ("MIT", "The MIT License (MIT)\n\n" + _MIT),
         ("ISC", _ISC), ("ISC", "ISC License\n\n" + _ISC), ("Apache-2.0", _APACHE),
         *_bsd_texts(),
         *(("Zlib", t + _ZLIB.format(x)) for x in ("acknowledgment", "acknowledgement")
           for t in ("", "zlib License\n\n", "The zlib License\n\n", "zlib/libpng License\n\n", "The zlib/libpng License\n\n")),
         *(("BSL-1.0", t + _BSL) for t in ("", "Boost Software License - Version 1.0 - August 17th, 2003\n\n")),
         *(("Unlicense", t + _UNLICENSE + x) for t in ("", "The Unlicense\n\n", "Unlicense\n\n")
           for x in ("", *(f"\n\nFor more information, please refer to <{h}://unlicense.org/>" for h in ("http", "https")))),
         *((i, t.format(h)) for i, t in (("BSL-1.0", _BOOST_NOTICE), ("MPL-2.0", _MPL)) for h in ("http", "https")),
         *_gnu_texts())

#: Spellings that mean the same, in canonical form.
EQUIVALENT = (("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sub license", "sublicense"),
              ("non infringement", "noninfringement"), ("merchantibility", "merchantability"),
              ("gnu gpl v", "gnu general public license version "), ("gnu lgpl v", "gnu lesser general public license version "),
              ("gnu agpl v", "gnu affero general public license version "), ("creative commons attribution", "cc by"),
              ("noncommercial", "nc"), ("non commercial", "nc"), ("sharealike", "sa"), ("share alike", "sa"),
              ("noderivatives", "nd"), ("no derivatives", "nd"), ("creative commons zero", "cc0"))

COPYRIGHT_LINE = r"(?m)^[^a-z0-9\n]*(?:copyright[^\n]*(?:[0-9]{4}|\(c\)|©)|\(c\) |© |all rights reserved)[^\n]*$"


#: Every known text holds one of these in its canonical form; a text without
#: any of them has no hits and need not be rewritten.
TELLING = ("licen", "permission", "under", "redistribution")


def telling(text: Column) -> Column:
    return reduce(Column.__or__, (F.contains(text, F.lit(word)) for word in TELLING))


def canonical_lines(low: Column) -> Column:
    """Letters, digits and line breaks of a lower-case text, each line padded by spaces."""
    low = F.regexp_replace(low, COPYRIGHT_LINE, "")
    out = F.regexp_replace(F.concat(F.lit(" "), low, F.lit(" ")), r"[^a-z0-9\n]+", " ")
    return F.regexp_replace(F.replace(out, F.lit("\n"), F.lit(" \n ")), " +", " ")


def canonical_spelling(part: Column) -> Column:
    """One spelling for equivalent words of a canonical line or paragraph."""
    out = F.concat(F.lit(" "), part, F.lit(" "))
    for old, new in EQUIVALENT:
        # names of versions ("gnu gpl v") run on into the number
        a, b = (f" {old}", f" {new}") if new.endswith(" ") else (f" {old} ", f" {new} ")
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.trim(out)


def _one_line(canon: Column) -> Column:
    return F.trim(F.regexp_replace(F.replace(canon, F.lit("\n"), F.lit(" ")), " +", " "))


def known_texts() -> list[tuple[str, str]]:
    """(license, text) of full texts and of notices made from names and wordings."""
    return list(TEXTS) + [(i, t.format(n, id=i)) for i, names in NAMES.items() for t in NOTICES
                          for n in ([i] if "{id}" in t else [x for n in names for x in (n, f"{n} License")])]


def _digests(known: DataFrame) -> DataFrame:
    return known.select(
        "license", canonical_spelling(_one_line(canonical_lines(F.lower("known")))).alias("part")).where("part <> ''").select(
        "license", F.sha2("part", 256).alias("digest")).distinct()


def scan(docs: DataFrame, text: str = "text", known: DataFrame | None = None) -> DataFrame:
    """(doc_id, license, scope): one row for each licence found in a document;
    scope is ``document`` if it is the whole of it, else ``part``.  Rows
    (license, known) in ``known`` take the place of the fixed texts."""
    if known is None:
        told = F.broadcast(_digests(docs.sparkSession.createDataFrame(known_texts(), "license string, known string")))
        may_hold = telling
    else:                     # any text may be known, with or without the telling words
        told = known_small(cut(_digests(known), "license-known"), MOST_KNOWN)
        may_hold = lambda part: part != ""
    # each explode also keeps the columns under it from being computed once per use
    low = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.explode(F.array(F.lower(text))).alias("low"))
    canon = low.where(may_hold(F.col("low"))).select("doc_id", F.explode(F.array(canonical_lines(F.col("low")))).alias("c"))
    wholes = canon.select("doc_id", "c", F.explode(F.array(_one_line(F.col("c")))).alias("whole"))
    paragraphs = F.transform(F.split("c", r"\n(?: *\n)+"), _one_line)
    lines = F.transform(F.split("c", "\n"), lambda x: F.trim(x))
    parts = wholes.select("doc_id", "whole", F.explode(F.array_distinct(
        F.concat(F.array("whole"), paragraphs, lines))).alias("part")).where(may_hold(F.col("part")))
    units = parts.select("doc_id", F.sha2(canonical_spelling(F.col("part")), 256).alias("digest"),
                         F.when(F.col("part") == F.col("whole"), "document").otherwise("part").alias("scope"))
    return units.join(told, "digest").select("doc_id", "license", "scope").distinct()
