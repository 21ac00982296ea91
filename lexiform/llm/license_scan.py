"""Licence scans with DataFrame functions only.

Sentences of files are compared with those of licence texts and headers by the cosine of sparse TF-IDF vectors. A file is
read in two ways: by its lines, and unwrapped, with comment signs at line starts gone and the lines of a paragraph joined. Terms
are weighed by how many files have them; terms that no template has weigh as much as one that a single file has. A sentence can
only be similar enough if it has one of a template's cue terms: without them, even all its other terms stay below the threshold.
It is compared with the templates whose cues it has, which loses none.

A file is a licence file if its name says so or similar sentences are most of it. Licence files are compared whole, too: the
licence text with the largest cosine gives the licence where it is above the threshold, else the best sentence does. Every
directory takes its licence file's licence, else that of its nearest ancestor with one; a file without a licence of its own
takes its directory's. Directories are resolved once each, however many files they hold.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiform.llm import scratch

THRESHOLD = 0.70
#: A file whose similar sentences have so large a share of its terms is a licence file.
FILE_SHARE = 0.8
FILE_NAME = r"(?i)(^|/)(licen[cs]e|copying|notice)(\.[a-z]+)?$"
_AS_IS = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'
_BSD = 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. '
_BSD_OFF = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
_GPL = 'This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0}General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0}General Public License for more details. You should have received a copy of the GNU {0}General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.'
#: Licences whose text, or whose notice for files, is compared sentence by sentence and whole.
TEXTS = [
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. ' + _AS_IS),
    ("BSD-2-Clause", _BSD + _BSD_OFF),
    ("BSD-3-Clause", _BSD + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. " + _BSD_OFF),
    ("ISC", 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("GPL-3.0", _GPL.format("")),
    ("LGPL-3.0", _GPL.format("Lesser ")),
    ("AGPL-3.0", _GPL.format("Affero ")),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
]
#: Licence, further sentence by which files say that they are under it.
SAYINGS = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("Proprietary", "All rights reserved."),
]
#: A part of a licence text with fewer terms says nothing alone.
LEAST_TERMS = 5
TERM = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"


def terms(text: str) -> list[str]:
    return re.findall(TERM, text.lower())


def _terms(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(TERM), F.lit(0))


def sentences(c: Column) -> Column:
    """Parts of a text between line ends, and after marks that a blank follows."""
    return F.split(F.regexp_replace(c, r"([.!?:;])[ \t]+", "$1\n"), "\n")


def unwrapped(c: Column) -> Column:
    """The text without comment signs at line starts and with the lines of a paragraph in one."""
    bare = F.regexp_replace(c, r"(?m)^[ \t]*(?:#+|//+|/?\*+/?|;+|--+|%+|<!--)[ \t]*", "")
    return F.regexp_replace(bare, r"[ \t\r]*\n[ \t]*(?=\S)(?<!\n[ \t]{0,8}\n)", " ")


def _parts(text: str) -> list[str]:
    return [p for p in re.split(r"(?<=[.!?:;])[ \t]+", text) if len(terms(p)) >= LEAST_TERMS]


#: Licence and sentence, once each: those of the texts, then the sayings as they are.
TEMPLATES = list(dict.fromkeys([(name, p) for name, text in TEXTS for p in _parts(text)] + [(name, p) for name, saying in SAYINGS for p in (re.split(r"(?<=[.!?:;])[ \t]+", saying) if saying.count(" ") > 8 else [saying]) if len(terms(p)) >= 3]))
VOCABULARY = sorted({t for _, s in TEMPLATES + TEXTS for t in terms(s)})


def frequencies(files: DataFrame) -> tuple[dict[str, int], int]:
    """(files that have each term of the templates, files): the vocabulary is fixed, so both are small."""
    have = F.array_intersect(_terms(F.col("text")), F.array(*[F.lit(t) for t in VOCABULARY]))
    rows = files.select(F.explode_outer(have).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n")).collect()
    return {r["term"]: r["n"] for r in rows if r["term"] is not None}, files.count()


def weights(found: dict[str, int], n: int) -> tuple[dict[str, float], float]:
    """(weight of each template term, weight of any other): logarithms of inverse shares of files."""
    idf = lambda k: math.log((1 + n) / (1 + k)) + 1.0
    return {t: idf(found.get(t, 0)) for t in VOCABULARY}, idf(1)


def template_vectors(idf: dict[str, float], templates: list[tuple[str, str]] | None = None) -> list[tuple[str, dict[str, float]]]:
    """(licence, unit vector) of each template."""
    out = []
    for name, sentence in TEMPLATES if templates is None else templates:
        ts = terms(sentence)
        v = {t: ts.count(t) * idf[t] for t in set(ts)}
        norm = math.sqrt(sum(x * x for x in v.values()))
        out.append((name, {t: x / norm for t, x in v.items()}))
    return out


def cues(vectors: list[tuple[str, dict[str, float]]]) -> dict[str, list[int]]:
    """The fewest heaviest terms of each template without which a cosine stays below the threshold, and whose they are."""
    out: dict[str, list[int]] = {}
    for k, (_, v) in enumerate(vectors):
        left = 1.0
        for t, w in sorted(v.items(), key=lambda x: (-x[1], x[0])):
            if math.sqrt(max(left, 0.0)) < THRESHOLD:
                break
            out.setdefault(t, []).append(k)
            left -= w * w
    return out


def _map(entries: dict) -> Column:
    return F.create_map(*[x for t, w in sorted(entries.items()) for x in (F.lit(t), w if isinstance(w, Column) else F.lit(w))])


def matches(files: DataFrame, weighed: tuple[dict[str, float], float] | None = None) -> DataFrame:
    """path, licence, similarity, share: of each file with a sentence above the threshold the licence that most of its terms are
    similar to, the best similarity, and the largest share of the file's terms in sentences of one licence; by lines or
    unwrapped, whichever says more. Ties go to the licence that comes first by name."""
    idf, other = weighed or weights(*frequencies(files))
    vectors = template_vectors(idf)
    owners = cues(vectors)
    pattern = f"(?i)(?<![a-z0-9])(?:{'|'.join(re.escape(t) for t in sorted(owners))})(?![a-z0-9])"
    table = _map(idf)
    hit = files.filter(F.col("text").rlike(pattern)).withColumn("plain", unwrapped(F.col("text")))
    ways = F.array(F.struct(F.lit(0).alias("way"), sentences(F.col("text")).alias("p")), F.when(F.col("plain") != F.col("text"), F.struct(F.lit(1).alias("way"), sentences(F.col("plain")).alias("p"))))
    read = hit.select("path", F.size(_terms(F.col("text"))).alias("file_terms"), F.inline(F.filter(ways, lambda x: x.isNotNull())))
    parts = read.select("path", "file_terms", "way", F.explode("p").alias("s")).filter(F.col("s").rlike(pattern))
    rows = parts.withColumn("t", _terms(F.col("s")))
    count = lambda t: F.size(F.filter("t", lambda x: x == t)).cast("double")
    rows = rows.withColumn("v", F.transform(F.array_distinct("t"), lambda t: F.struct(t.alias("t"), (count(t) * F.coalesce(F.try_element_at(table, t), F.lit(other))).alias("w"))))
    owned = _map({t: F.array(*[F.lit(k + 1) for k in ks]) for t, ks in owners.items()})
    mine = F.filter(F.transform(F.array_distinct("t"), lambda t: F.try_element_at(owned, t)), lambda x: x.isNotNull())
    rows = rows.withColumns({"ids": F.array_distinct(F.flatten(mine)), "norm": F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.w * x.w))})
    all_vectors, names = F.array(*[_map(v) for _, v in vectors]), F.array(*[F.lit(n) for n, _ in vectors])
    dot = lambda k: F.aggregate("v", F.lit(0.0), lambda a, x: a + x.w * F.coalesce(F.try_element_at(F.element_at(all_vectors, k), x.t), F.lit(0.0)))
    alike = F.filter(F.transform("ids", lambda k: F.struct(F.element_at(names, k).alias("licence"), F.round(dot(k) / F.col("norm"), 6).alias("similarity"))), lambda x: x.similarity >= THRESHOLD)
    # of each licence the sentence's best template
    alike = F.transform(F.array_distinct(F.transform(alike, lambda x: x.licence)), lambda n: F.array_max(F.filter(alike, lambda x: x.licence == n)))
    rows = rows.select("path", "way", "file_terms", F.size("t").alias("n"), F.inline(alike))
    by = rows.groupBy("path", "way", "licence").agg(F.sum(F.col("n") * F.col("similarity")).alias("said"), F.max("similarity").alias("similarity"), (F.sum("n") / F.max("file_terms")).alias("share"))
    first = F.struct((-F.round("said", 6)).alias("less"), "licence", "similarity")
    g = by.groupBy("path").agg(F.min(first).alias("best"), F.max("share").alias("share"))
    return g.select("path", "best.licence", "best.similarity", F.least("share", F.lit(1.0)).alias("share"))


def whole_texts(files: DataFrame, idf: dict[str, float], other: float) -> DataFrame:
    """path, licence, similarity: the licence text with the largest cosine to the whole of a file, if above the threshold."""
    vectors = template_vectors(idf, TEXTS)
    counts = files.select("path", F.explode(_terms(F.col("text"))).alias("t")).groupBy("path", "t").agg(F.count(F.lit(1)).alias("n"))
    rows = counts.withColumn("w", F.col("n") * F.coalesce(F.try_element_at(_map(idf), F.col("t")), F.lit(other)))
    dots = [F.sum(F.col("w") * F.coalesce(F.try_element_at(_map(v), F.col("t")), F.lit(0.0))).alias(f"d{k}") for k, (_, v) in enumerate(vectors)]
    g = rows.groupBy("path").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"), *dots)
    best = F.array_min(F.array(*[F.struct((-F.round(F.col(f"d{k}") / F.col("norm"), 6)).alias("less"), F.lit(n).alias("licence")) for k, (n, _) in enumerate(vectors)]))
    return g.withColumn("best", best).filter(F.col("best.less") <= -THRESHOLD).select("path", F.col("best.licence").alias("whole"), (-F.col("best.less")).alias("whole_similarity"))


def directory(path: Column) -> Column:
    """What stands before the last slash; '' at the top."""
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def inherited(dirs: DataFrame, licences: DataFrame) -> DataFrame:
    """(dir, from_dir, licence): of each directory of ``dirs`` the nearest one, itself or an ancestor, that ``licences`` (dir,
    licence) knows; directories without one are left out."""
    up = dirs.select("dir", F.explode(F.expr("transform(sequence(0, size(split(dir, '/'))), n -> concat_ws('/', slice(split(dir, '/'), 1, n)))")).alias("from_dir")).distinct()
    near = up.join(licences.withColumnRenamed("dir", "from_dir"), "from_dir")
    return near.groupBy("dir").agg(F.max_by(F.struct("from_dir", "licence"), F.length("from_dir")).alias("x")).select("dir", "x.*")


def scan(files: DataFrame) -> DataFrame:
    """path, licence, similarity, how (header, file, inherited or none), from_dir: a row for each row of ``files`` (path, text).

    Null texts count as empty and have no licence of their own. Of several licence files of a directory the most similar
    counts, then the first path. Rows that repeat a path get the same result each; null paths stay without inheritance.
    """
    base = files.select("path", F.coalesce("text", F.lit("")).alias("text"))
    idf, other = weights(*frequencies(base))
    is_file = F.col("path").rlike(FILE_NAME) | (F.col("share") >= FILE_SHARE)
    said = scratch.save(matches(base, (idf, other)), "licence-sentences")
    # licence files are few; rows that repeat a path have one text each, the first of which counts
    texts = base.join(said.filter(is_file).select("path"), "path", "left_semi").groupBy("path").agg(F.min("text").alias("text"))
    own = said.join(whole_texts(texts, idf, other), "path", "left")
    own = scratch.save(own.select("path", F.coalesce("whole", "licence").alias("licence"), F.coalesce("whole_similarity", "similarity").alias("similarity"), "share"), "licence-matches")
    known = own.filter(is_file).select(directory(F.col("path")).alias("dir"), "licence", "similarity", "path")
    # the first by similarity of each directory, by an aggregation that combines before it shuffles
    first = known.groupBy("dir").agg(F.min(F.struct((-F.col("similarity")).alias("s"), F.col("path").alias("p"), F.col("licence").alias("l"))).alias("x")).select("dir", F.col("x.l").alias("licence"))
    dirs = base.select(directory(F.col("path")).alias("dir")).filter("dir is not null").distinct()
    above = scratch.save(inherited(dirs, first), "licence-dirs").select("dir", "from_dir", F.col("licence").alias("dir_licence"))
    rows = base.select("path", directory(F.col("path")).alias("dir")).join(own.withColumn("is_file", is_file), "path", "left").join(above, "dir", "left")
    mine = F.col("licence").isNotNull()
    how = F.when(mine & F.col("is_file"), "file").when(mine, "header").when(F.col("dir_licence").isNotNull(), "inherited").otherwise("none")
    return rows.select("path", F.coalesce("licence", "dir_licence").alias("licence"), "similarity", how.alias("how"), F.when(~mine, F.col("from_dir")).alias("from_dir"))


def document_paths(docs: DataFrame) -> DataFrame:
    """(path, text, doc_id): documents as files source/language/hundred/doc_id."""
    named = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none")), F.floor(F.col("doc_id") / 100).cast("string"), F.col("doc_id").cast("string"))
    return docs.select(named.alias("path"), "text", "doc_id")
