"""Licence scan by canonical digests: whole texts, blocks and lines are looked up among known digests."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let

# Spellings that licence texts use for the same word.
SPELLINGS = {"licence": "license", "licences": "licenses", "licenced": "licensed", "organisation": "organization", "authorisation": "authorization", "favour": "favor", "merchantibility": "merchantability", "noncommercial": "non commercial", "sub licence": "sublicense", "sub license": "sublicense", "per cent": "percent"}

# Publicly known licence texts and notices, by SPDX name.
KNOWN = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "MIT License\n\nCopyright (c) <year> <copyright holders>\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at\n\nhttp://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License v3.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("all-rights-reserved", "All rights reserved."),
]

# SHA-256 of the canonical form of whole licence texts as they are published, by SPDX name.
DIGESTS = [
    ("Apache-2.0", "e87dea5078ce2faaea46d3475af18d30a5c0ac0f09425b60b3e0c6569f72f8d2"),
    ("Apache-2.0", "37599287c15c2f2ec060c3c3b55bdf69e3bc7a8aeeb9cd57e18800088789538a"),
    ("Apache-2.0", "f45538b138cf9aea39fa205de037a0bede8305e68281650e7ab809a8b3ebb2f0"),
    ("Artistic-1.0", "e963bc30f4d3c45f45030c34409ee37315564625649c1394e32bb5ddd99e01b2"),
    ("BSD-2-Clause", "eda2ad636e738f6a26a2fea902bb734ee48c789a5b40035b8db3659bd951e5bc"),
    ("BSD-2-Clause", "957c3854a3d72e069e7f5e48857ad9ab76135f14c70d60fa9ec6ef9a928d45dd"),
    ("BSD-2-Clause", "9c47a682ef64c4e02c50c208384916c7f80087d4e4395b2b06e65a4c4b08b152"),
    ("BSD-3-Clause", "3d151449461c0c776e892a4dc41cac0d251eb00c9fc49d2d48802d9bed818fe9"),
    ("BSD-3-Clause", "eabe215ff5a2cf5b1c090915b7cabdf511f70fc79fb8fde85247ebe3038a9658"),
    ("BSD-3-Clause", "cf77ee3d20f4076cecdb58fc53aa7204c9f5c0651621abbc85e028f5b2ffa6b4"),
    ("BSD-3-Clause", "b6093f80a67d752fa17301d7c8f20fe906e6f11169f3a64f9a5816d148eb738f"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("EPL-2.0", "f05772ab171c9e3e35b719fee07157d541fd8e2b3217f4cf7a1087fe8f1c5b72"),
    ("GFDL-1.2", "5379e6f33e826ba185b23fd11a414555c2161fda481478babd1e73a3ae098a71"),
    ("GFDL-1.3", "93d6108daecdddc5f284cf8f2512fb0d72f6e9ee12381feb9704ba194b00c3e6"),
    ("GPL-1.0", "ec8a6b7d70e9f225b63d3962ed5b4721373f5535d7b967a06722b0d621f6892a"),
    ("GPL-2.0", "331b500eb3c5ee796906547305df82fff4a35b3aa03c1d3ea84d32078292b2e6"),
    ("GPL-3.0", "a8cd54d6683aa630f0b8d05d56184ad91dc486756da2df61c94d3e4e8d5ecb68"),
    ("ISC", "217da0747cec63a2e734185db11cbaa819bcd9e5b83cd12f812128fffe66e26a"),
    ("LGPL-2.0", "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908"),
    ("LGPL-2.1", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "3f0343dd4f3b064be36e0c6584737c9b7bb5c322721694563f9009e088ce96d1"),
    ("MPL-2.0", "f82071285728ca3ec7685ee9bc4acdae0b8267142a4d20b8f1805eabedb4a98a"),
]

#: A line that states who holds the copyright and since when: it begins with the word and has a year or the sign, or
#: begins with the sign. Lines of a text that only happen to begin with the word stay.
COPYRIGHT_LINE = r"(?im)^[^\n0-9A-Za-z]*(copyright\b[^\n]*(\(c\)|©|\b(19|20)\d\d\b|<year>|[\[{]yyyy[\]}])|\(c\)[ \t]*((19|20)\d\d|<year>)|©)[^\n]*$"


def spelled(text: Column) -> Column:
    """One spelling of each word; words are parted by single spaces."""
    text = F.concat(F.lit(" "), text, F.lit(" "))
    for given, used in SPELLINGS.items():
        text = F.replace(text, F.lit(f" {given} "), F.lit(f" {used} "))
    return F.trim(text)


def canonical_units(text: Column) -> Column:
    """The canonical forms of a text: (whole, units), units being its different blocks and lines; empty ones are none.

    Copyright lines go, letters become small, punctuation becomes spaces, one spelling and single spaces stay. All that
    but the spelling is done once for each line (only line feeds end one); blocks and the whole are put together from the
    lines.
    """
    gap = F.lit("\n")

    def plain(line: Column) -> Column:
        words = F.regexp_replace(F.lower(F.regexp_replace(line, f"(?d){COPYRIGHT_LINE}", " ")), r"[\x00-\x2F\x3A-\x60\x7B-\xBF]+", " ")
        return F.when(line.rlike(r"^[ \t\r]*$"), gap).otherwise(F.trim(words))

    def put_together(lines: Column) -> Column:
        said = F.filter(lines, lambda x: (x != "") & (x != gap))
        blocks = F.filter(F.transform(F.split(F.array_join(lines, " "), "\n"), lambda b: F.trim(F.regexp_replace(b, " +", " "))), lambda b: b != "")
        return F.struct(spelled(F.array_join(said, " ")).alias("whole"), F.array_distinct(F.transform(F.array_distinct(F.concat(said, blocks)), spelled)).alias("units"))

    return let(F.transform(F.split(text, "\n"), plain), put_together)


def canonical_text(text: str) -> str:
    """The canonical form of one whole text, for the known ones."""
    text = re.sub(COPYRIGHT_LINE, " ", text).lower()
    text = " " + re.sub(r"[\x00-\x2F\x3A-\x60\x7B-\xBF]+", " ", text) + " "
    for given, used in SPELLINGS.items():
        text = text.replace(f" {given} ", f" {used} ")
    return re.sub(" +", " ", text).strip(" ")


def listed_digests(known: list[tuple[str, str]], digests: list[tuple[str, str]]) -> dict[str, str]:
    """digest -> licence; of licences with equal digests the first by name."""
    names: dict[str, str] = {}
    for name, digest in [*((name, hashlib.sha256(canonical_text(text).encode()).hexdigest()) for name, text in known), *digests]:
        names[digest] = min(name, names.get(digest, name))
    names.pop(hashlib.sha256(b"").hexdigest(), None)
    return names


def scan(docs: DataFrame, known: list[tuple[str, str]] | None = None, digests: list[tuple[str, str]] | None = None) -> DataFrame:
    """A row for each row of docs: doc_id, digest, licence, notices, n_notices.

    `digest` is the SHA-256 of the whole canonical text and `licence` the known licence with that digest (null if
    none); `notices` are the sorted licences of its blocks (between blank lines) and lines, of any length. `known` gives
    licences by text, `digests` by the digest of their canonical text. Null texts count as empty; empty texts match
    nothing; repeated rows keep their own results, and so do rows without a doc_id; an empty table gives an empty
    result; other columns are ignored.
    """
    spark = docs.sparkSession
    names = listed_digests(KNOWN if known is None else known, DIGESTS if digests is None else digests)
    listed = F.broadcast(spark.createDataFrame(sorted(names.items()), "digest string, name string"))  # a fixed list
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select("doc_id", text.alias("text"), F.xxhash64("doc_id", text).alias("key"))

    def marked(c: Column) -> Column:
        return F.concat(F.array(F.struct(F.lit(True).alias("whole"), c["whole"].alias("said"))), F.transform(c["units"], lambda u: F.struct(F.lit(False).alias("whole"), u.alias("said"))))

    units = base.select("doc_id", "key", F.explode(let(canonical_units(F.col("text")), marked)).alias("unit"))
    looked_up = units.select("doc_id", "key", "unit.whole", F.sha2(F.col("unit.said").cast("binary"), 256).alias("digest")).join(listed, "digest", "left").filter("whole or name is not null")
    told = looked_up.groupBy("doc_id", "key").agg(
        F.max(F.when(F.col("whole"), F.col("digest"))).alias("digest"), F.max(F.when(F.col("whole"), F.col("name"))).alias("licence"),
        F.sort_array(F.collect_set(F.when(~F.col("whole"), F.col("name")))).alias("notices"), F.count(F.when(F.col("whole"), 1)).alias("rows"),
    ).withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))  # equal rows were looked up together
    return told.select("doc_id", "digest", "licence", F.array_join("notices", ",").alias("notices"), F.array_size("notices").cast("long").alias("n_notices"))
