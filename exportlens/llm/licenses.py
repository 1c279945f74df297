"""Licence scan: digests of normalised texts, joined to those of known licences. DataFrame expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""

BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""

BSD_NAME = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""

BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""

UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>"""

# Known texts: whole licences, file headers and one-line notices, with their SPDX identifiers.
KNOWN = [
    ("MIT", MIT),
    ("ISC", ISC),
    ("BSD-2-Clause", f"{BSD_HEAD}\n\n{BSD_TAIL}"),
    ("BSD-3-Clause", f"{BSD_HEAD}\n\n{BSD_NAME}\n\n{BSD_TAIL}"),
    ("Zlib", ZLIB),
    ("Unlicense", UNLICENSE),
    ("Apache-2.0", APACHE_HEADER),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
]
# Long licences by the length and the SHA-256 of their normalised texts.
KNOWN_DIGESTS: list[tuple[str, int, str]] = [
    ("Apache-2.0", 9886, "04e64e0427d80fdde16fa8415931bf2c09bc943f13ec322a09df188bf23a3543"),
    ("CC0-1.0", 6691, "cccf7894e1b9f4ba9f97728bf0c5baf9e07bc2ac93da7a51556451b1fb2b868e"),
    ("GFDL-1.2-only", 19578, "15f6a8d360ffdecc988c29279c00f23e20de17f14f2a06572ab0d41de6e98b7b"),
    ("GFDL-1.3-only", 22013, "2d36daeff2ad303badb6dee8149748be25e22974dd468e1e8a55cf40f16fc01d"),
    ("GPL-1.0-only", 11765, "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224"),
    ("GPL-2.0-only", 17117, "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821"),
    ("GPL-3.0-only", 33406, "eaab5d82fdcca441d83a1913bbf07e4de3a739e190578c0bffde24f84e93bb2a"),
    ("LGPL-2.0-only", 24130, "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908"),
    ("LGPL-2.1-only", 25217, "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-3.0-only", 7104, "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", 22431, "af9120248ffd9feada62cb62d18d7104970bad23f2d265fd77eb0cd3c265583b"),
    ("MPL-2.0", 14342, "6fedd8db6adb0e102fc0f69b9e1501d2edaf25940e34910831cab46f9f5d4e4d"),
]
MOST_KNOWN = 10_000  # rows of the table of known digests, which is broadcast

# Spellings that count as equal (public matching guidelines for licence texts).
EQUIVALENT = [
    ("licence", "license"), ("sub license", "sublicense"), ("non commercial", "noncommercial"),
    ("non infringement", "noninfringement"), ("copyright owner", "copyright holder"),
    ("organisation", "organization"), ("favour", "favor"), ("https", "http"), ("and or", "and/or"),
    ("per cent", "percent"), ("merchantibility", "merchantability"), ("acknowledgement", "acknowledgment"),
]
# Lines that state a copyright: the word or sign with a year, a sign or a holder after it; by themselves "copyright notice" or
# "copyright holders", as they come up in the sentences of licences, state none.
COPYRIGHT = (r"^[^a-z0-9©]*(portions )?(copyright|©|\(c\))[^a-z0-9©(]*(\(c\)|©|by\b|[0-9]{4}|<|\[)"
             r"|^[^a-z0-9©]*(©|\(c\)).*\b(19|20)[0-9]{2}\b"
             r"|^[^a-z0-9]*all rights reserved[^a-z0-9]*$")
COPYRIGHT_NAME = r"^[^A-Za-z0-9]*(Portions )?Copyright[ \t]+[A-Z]"
# Titles that people put above a licence, in normalised form; a line that is one doesn't count.
TITLES = [
    "mit license", "the mit license", "mit license mit", "the mit license mit", "mit license expat", "isc license", "the isc license", "isc license isc",
    "bsd license", "the bsd license", "new bsd license", "simplified bsd license", "bsd 2 clause license", "the 2 clause bsd license", "bsd 3 clause license",
    "the 3 clause bsd license", "bsd 3 clause new or revised license", "bsd 2 clause simplified license", "zlib license", "the zlib license", "the unlicense", "unlicense",
    "license",
]


def _flat(text: Column) -> Column:
    """In lower case, punctuation and white space as single spaces."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def canonical(line: Column) -> Column:
    """A text flattened, with equivalent spellings as one."""
    flat = _flat(line)
    for old, new in EQUIVALENT:
        flat = F.replace(flat, F.lit(old), F.lit(new.replace("/", " ")))
    return flat


def _units(text: Column) -> Column:
    """array of (line, text): the whole text as line 0, then each line from 1 on.

    Copyright lines and titles are left out of both. What is left of the whole text is joined before it is normalised,
    so it doesn't matter where its lines are broken.
    """
    states = lambda x: F.lower(x).rlike(COPYRIGHT) | x.rlike(COPYRIGHT_NAME)
    kept = F.filter(F.transform(F.split(text, "\n"), lambda x, i: F.struct((i + 1).alias("line"), x.alias("raw"), canonical(x).alias("text"))),
                    lambda x: (x["text"] != "") & ~states(x["raw"]) & ~x["text"].isin(TITLES))
    whole = lambda lines: F.struct(F.lit(0).alias("line"), canonical(F.array_join(F.transform(lines, lambda x: x["raw"]), " ")).alias("text"))
    return F.flatten(F.transform(F.array(kept), lambda lines: F.concat(
        F.array(whole(lines)), F.transform(lines, lambda x: F.struct(x["line"].alias("line"), x["text"].alias("text"))))))


def known_digests(spark, known=None) -> DataFrame:
    """(digest, length, license) of each distinct normalised text of ``known``; ``MOST_KNOWN`` at most.

    Without ``known`` these are the texts of ``KNOWN`` and the digests of ``KNOWN_DIGESTS``.
    """
    digests = KNOWN_DIGESTS if known is None else []
    known = KNOWN if known is None else known
    if len(known) > MOST_KNOWN:
        raise ValueError(f"more than {MOST_KNOWN} known texts")
    df = spark.createDataFrame([(b, a) for a, b in known], "text string, license string")
    df = df.select("license", _units(F.col("text"))[0]["text"].alias("text")).where("text <> ''")
    df = df.select(F.sha2("text", 256).alias("digest"), F.length("text").alias("length"), "license")
    df = df.unionByName(spark.createDataFrame([(d, n, name) for name, n, d in digests], df.schema))
    return df.groupBy("digest", "length").agg(F.min("license").alias("license"))


def license_matches(docs: DataFrame, known=None) -> DataFrame:
    """(doc_id, line, license) per whole text (line 0) or line (from 1) that equals a known text.

    Both sides are normalised: copyright lines and titles go, case, punctuation, white space, line breaks and
    equivalent spellings don't count; then the SHA-256 digests are joined. Only texts as long as a known one are
    hashed. The known digests are broadcast, checked to be few; documents are never shuffled.

    A null or empty text matches nothing; a text of one line matches both as line 0 and as line 1;
    repeated rows give repeated matches; no rows give no rows; other columns are ignored.
    """
    table = known_digests(docs.sparkSession, known)
    lengths = [row["length"] for row in table.select("length").distinct().collect()]  # MOST_KNOWN at most
    units = docs.select("doc_id", F.explode(_units(F.coalesce("text", F.lit("")))).alias("u")).select("doc_id", "u.line", "u.text")
    units = units.where(F.length("text").isin(lengths)) if lengths else units.where("false")
    digests = units.select("doc_id", "line", F.sha2("text", 256).alias("digest"))
    return digests.join(F.broadcast(table.select("digest", "license")), "digest").select("doc_id", "line", "license")
