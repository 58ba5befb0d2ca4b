"""Licence scans: sparse TF-IDF cosine to templates, then inheritance from ancestor directories."""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierstone.llm.common import scratch

#: Names of public licences and their customary notices.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "The MIT License (MIT)"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("GPL-2.0", "GNU General Public License, version 2"),
    ("LGPL-3.0", "GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "GNU Affero General Public License, version 3"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC0-1.0", "CC0 1.0 Universal public domain dedication"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "Copyright. All rights reserved."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License"),
    ("LGPL-2.1", "GNU Lesser General Public License, version 2.1"),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("EPL-2.0", "Eclipse Public License v 2.0"),
    ("BSL-1.0", "Boost Software License Version 1.0"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("Artistic-2.0", "The Artistic License 2.0"),
    ("Zlib", "The zlib License"),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"),
    ("CC-BY-NC-ND-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
)
#: A line with none of these cannot be a notice.
TRIGGER = r"(?i)licen[cs]|copyright|spdx|rights reserved|permission|redistribution|public domain|creative commons"
#: The same for a word and the one before it, however the text is wrapped.
TRIGGER_WORD = r"licen[cs]|copyright|spdx|permission|redistribution"
TRIGGER_PAIRS = (("rights", "reserved"), ("public", "domain"), ("creative", "commons"))
#: Titles of licence texts that no template above is close to; compared with windows only, by the same weights.
TITLES = (("MPL-2.0", "Mozilla Public License Version 2.0"), ("MPL-2.0", "Mozilla Public License, v. 2.0"))
SPDX = r"(?i)SPDX-License-Identifier:[ \t]*([A-Za-z0-9.+() \t-]*)"
WORDS = r"[^0-9a-z]+"
THRESHOLD = 0.5
#: Names of licence files, and the share of a file's words that its notices must make up otherwise.
LICENCE_FILE = r"(?i)(^|/)(licen[cs]es?|copying|notice|unlicense)([.-][^/]*)?$"
NOTICE_SHARE = 0.25
#: Public licence texts that are short enough to be compared whole.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following
conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS
IN THE SOFTWARE."""
_BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions
are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation
and/or other materials provided with the distribution."""
_BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from
this software without specific prior written permission."""
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF
SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT,
STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF
SUCH DAMAGE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the
above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD
TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT,
OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER
TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BOOST = """Boost Software License - Version 1.0 - August 17th, 2003. Permission is hereby granted, free of charge, to any person or organization
obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute,
and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all
subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the
following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or
derivative works are solely in the form of machine-executable object code generated by a source language processor. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT
WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND
NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN
CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages
arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter
it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you
wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed
or altered from any source distribution."""
WHOLE_TEXTS = (
    ("MIT", _MIT), ("BSD-2-Clause", f"{_BSD_2} {_BSD_END}"), ("BSD-3-Clause", f"{_BSD_2} {_BSD_NAMES} {_BSD_END}"), ("ISC", _ISC), ("BSL-1.0", _BOOST), ("Zlib", _ZLIB),
)
#: From this cosine on a licence file, as one vector, is one of these texts, whatever its single lines are close to.
WHOLE_THRESHOLD = 0.8


def words_of(line: str) -> list[str]:
    return [w for w in re.split(WORDS, line.lower()) if w]


def template_vectors(templates: tuple[tuple[str, str], ...] = TEMPLATES) -> tuple[list[tuple[str, str, float]], float]:
    """(template number|licence, word, weight / norm) of all templates, and the weight of a word in none."""
    bags = [Counter(words_of(text)) for _, text in templates]
    weight_of = dict(word_weights(templates))
    rows = []
    for n, ((licence, _), bag) in enumerate(zip(templates, bags)):
        weights = {w: c * weight_of[w] for w, c in bag.items()}
        norm = math.sqrt(sum(v * v for v in weights.values()))
        rows += [(f"{n:02d}|{licence}", w, v / norm) for w, v in sorted(weights.items())]
    return rows, idf(0, len(templates))


def idf(df: int, templates: int = len(TEMPLATES)) -> float:
    return math.log((1 + templates) / (1 + df)) + 1


def word_weights(templates: tuple[tuple[str, str], ...] = TEMPLATES) -> list[tuple[str, float]]:
    df = Counter(w for _, text in templates for w in set(words_of(text)))
    return sorted((w, idf(n, len(templates))) for w, n in df.items())


def tokens_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), WORDS), lambda w: w != "")


def total_words(text: Column) -> Column:
    return F.size(tokens_of(text))


def numbered_lines(text: Column) -> Column:
    return F.transform(F.split(text, "\n"), lambda line, i: F.struct(i.alias("line"), line.alias("content")))


def triggered(words: Column, w: Column, i: Column) -> Column:
    """Whether the word at a place (from 0), or that with the one before it, is a trigger."""
    before = F.when(i > 0, F.element_at(words, F.greatest(i, F.lit(1))))
    pairs = [(w == second) & before.eqNullSafe(F.lit(first)) for first, second in TRIGGER_PAIRS]
    found = w.rlike(TRIGGER_WORD)
    for pair in pairs:
        found = found | pair
    return found


def headers(files: DataFrame) -> DataFrame:
    """Stored: file (a row number), key, path, n_words, lines, snippets, whole and stated; no texts.

    lines: (line, content) that may be notices. snippets: one per trigger word, (at, the place of
    its first word; of, the trigger's place in it; words, line_of) with the words that a
    window around the trigger can reach, across lines. whole: all words of a file named
    like a licence file. stated: expressions of SPDX tags. Only n_words of files with a trigger
    is set.
    """
    spread = "|".join([TRIGGER, *[f"(?i){a}[^0-9a-z]+{b}" for a, b in TRIGGER_PAIRS]])
    may = F.col("text").rlike(spread)
    numbered = files.select("key", "path", "text", F.when(may, numbered_lines(F.col("text"))).alias("all_lines"), F.when(may, tokens_of(F.col("text"))).alias("words"))
    line_of = F.flatten(F.transform("all_lines", lambda x: F.transform(tokens_of(x["content"]), lambda _: x["line"])))
    places = F.filter(F.transform("words", lambda w, i: F.when(triggered(F.col("words"), w, i), i)), lambda i: i.isNotNull())
    wide = numbered.select("*", line_of.alias("line_of"), places.alias("places"))
    reach = window_words() - 1

    def snippet(i: Column) -> Column:
        start = F.greatest(i - reach, F.lit(0))
        length = i - start + 1 + reach
        return F.struct(start.alias("at"), (i - start).alias("of"), F.slice("words", start + 1, length).alias("words"), F.slice("line_of", start + 1, length).alias("line_of"))

    found = wide.select(
        "key",
        "path",
        F.when(F.col("words").isNotNull(), F.size("words")).alias("n_words"),
        F.filter("all_lines", lambda x: x["content"].rlike(TRIGGER)).alias("lines"),
        F.transform("places", snippet).alias("snippets"),
        F.when(F.col("path").rlike(LICENCE_FILE), F.col("words")).alias("whole"),
        F.when(F.col("words").isNotNull(), F.regexp_extract_all("text", F.lit(SPDX), 1)).alias("stated"),
    )
    return scratch(found.withColumn("file", F.monotonically_increasing_id()), "licence-headers")


def window_words() -> int:
    return max(len(words_of(text)) for _, text in (*TEMPLATES, *TITLES))


def weight_table() -> tuple[list[str], list[float], list[list[float]]]:
    """Words; their weights after that of other words; per template or title, normed weights alike and its number."""
    weights = dict(word_weights())
    vocabulary = sorted(weights)
    rows = []
    for number, (_, text) in enumerate((*TEMPLATES, *TITLES)):
        bag = Counter(words_of(text))
        own = {w: c * weights[w] for w, c in bag.items()}
        norm = math.sqrt(sum(v * v for v in own.values()))
        rows.append([0.0, *[own.get(w, 0.0) / norm for w in vocabulary], float(number)])
    return vocabulary, [idf(0)] + [weights[w] for w in vocabulary], rows


def rows_by_length() -> dict[int, list[list[float]]]:
    """Template and title rows by number of words."""
    out: dict[int, list[list[float]]] = {}
    for row, (_, text) in zip(weight_table()[2], (*TEMPLATES, *TITLES)):
        out.setdefault(len(words_of(text)), []).append(row)
    return out


def licence_at(number: Column) -> Column:
    return F.element_at(F.lit([n for n, _ in (*TEMPLATES, *TITLES)]), number.cast("int") + 1)


def best_of(words: Column, ids: Column, rows: Column) -> Column:
    """(minus, number) of the template among `rows` closest to a bag of words, by arrays alone."""
    weight = F.lit(weight_table()[1])
    of = lambda i: F.element_at(weight, i + 1)
    times = F.transform(words, lambda w: F.size(F.filter(words, lambda x: x == w)))
    squares = F.zip_with(ids, times, lambda i, n: of(i) * of(i) * n)
    norm = F.sqrt(F.aggregate(squares, F.lit(0.0), lambda a, x: a + x))

    def pair(row: Column) -> Column:
        product = F.aggregate(ids, F.lit(0.0), lambda a, i: a + of(i) * F.element_at(row, i + 1))
        return F.struct((-F.round(product / norm, 6)).alias("minus"), F.element_at(row, -1).alias("number"))

    return F.array_min(F.transform(rows, pair))


def numbers_of(words: Column) -> Column:
    """Places of words in the vocabulary, 0 for others."""
    vocabulary = F.lit(weight_table()[0])
    return F.transform(words, lambda w: F.array_position(vocabulary, w).cast("int"))


def windows(stored: DataFrame) -> DataFrame:
    """(file, trigger, licence, score, first, line_of): the best window around each trigger word, if it is a notice.

    Each template is compared with the windows of as many words, across lines, that hold the
    trigger; a shorter file is one window. Equal ones: the template listed first, then the
    earlier. Only a file's own row is read, so nothing is shuffled but the best.
    """
    by_length = rows_by_length()
    lengths = sorted(by_length)
    each = stored.filter(F.size("snippets") > 0).select("file", F.explode("snippets").alias("s")).select("file", "s.*")
    each = each.withColumn("ids", numbers_of(F.col("words")))

    def cut(n: int, group: int) -> Column:
        starts = F.sequence(F.greatest(F.col("of") - n + 1, F.lit(0)), F.least(F.col("of"), F.greatest(F.size("words") - n, F.lit(0))))
        part = lambda c, s: F.slice(c, s + 1, F.lit(n)).alias(c)
        return F.transform(starts, lambda s: F.struct((F.col("at") + s).alias("first"), F.lit(group).alias("group"), part("words", s), part("ids", s), part("line_of", s)))

    spans = F.concat(*[cut(n, k) for k, n in enumerate(lengths, 1)])
    one = each.select("file", (F.col("at") + F.col("of")).alias("trigger"), F.explode(spans).alias("w")).select("file", "trigger", "w.*")
    rows = F.element_at(F.lit([by_length[n] for n in lengths]), F.col("group"))
    scored = one.withColumn("best", best_of(F.col("words"), F.col("ids"), rows)).filter(-F.col("best.minus") >= THRESHOLD)
    best = scored.groupBy("file", "trigger").agg(F.min(F.struct("best.minus", "best.number", "first", "line_of")).alias("b"))
    return best.select("file", "trigger", licence_at(F.col("b.number")).alias("licence"), (-F.col("b.minus")).alias("score"), "b.first", "b.line_of")


def wholes(stored: DataFrame) -> DataFrame:
    """(file, licence, score): files named like licence files whose whole text, as one vector, is close to one of WHOLE_TEXTS."""
    words = stored.filter(F.size("whole") > 0).select("file", F.explode("whole").alias("word"))
    bags = words.groupBy("file", "word").agg(F.count("*").alias("tf"))
    best = closest(bags, ["file"], WHOLE_TEXTS).filter(-F.col("best.minus") >= WHOLE_THRESHOLD)
    return best.select("file", F.substring_index("best.template", "|", -1).alias("licence"), (-F.col("best.minus")).alias("score"))


def closest(bags: DataFrame, keys: list[str], templates: tuple[tuple[str, str], ...]) -> DataFrame:
    """keys, best (minus, template), n_words: the template with the highest cosine to each bag (keys, word, tf).

    Sparse vectors: one row per distinct word, joined to the templates' words. Words of no template weigh
    in the bag's norm. Equal cosines, at six decimals, go to the template listed first.
    """
    spark: SparkSession = bags.sparkSession
    vectors, unknown = template_vectors(templates)
    known = F.broadcast(spark.createDataFrame(vectors, "template string, word string, weight double"))  # fixed table
    idfs = F.broadcast(spark.createDataFrame(word_weights(templates), "word string, idf double"))  # fixed table
    weighed = bags.join(idfs, "word", "left").withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(unknown)))
    norms = weighed.groupBy(*keys).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"), F.sum("tf").alias("n_words"))
    products = weighed.join(known, "word").groupBy(*keys, "template").agg(F.sum(F.col("w") * F.col("weight")).alias("product"))
    ranked = F.struct((-F.round(F.col("product") / F.col("norm"), 6)).alias("minus"), "template")
    return products.join(norms, keys).groupBy(*keys).agg(F.min(ranked).alias("best"), F.first("n_words").alias("n_words"))


def stated(stored: DataFrame) -> DataFrame:
    """(file, licence, score 1): licences that SPDX tags name; several in an expression count each."""
    each = stored.filter(F.size("stated") > 0).select("file", F.explode("stated").alias("expression"))
    parts = each.select("file", F.split("expression", r"[() \t]+").alias("parts"))
    named = parts.select("file", "parts", F.posexplode("parts").alias("n", "id"))
    after_with = (F.col("n") > 0) & (F.upper(F.element_at("parts", F.greatest("n", F.lit(1)))) == "WITH")
    named = named.filter(~after_with & (F.col("id") != "") & ~F.upper("id").isin("AND", "OR", "WITH"))
    plain = F.regexp_replace("id", r"(?i)(-only|-or-later|\+)$", "")
    known = F.create_map(*[F.lit(x) for name in sorted({n for n, _ in TEMPLATES}) for x in (name.lower(), name)])
    return named.select("file", F.coalesce(F.try_element_at(known, F.lower(plain)), plain).alias("licence"), F.lit(1.0).alias("score")).distinct()


def notices(stored: DataFrame) -> DataFrame:
    """(file, line, licence, score, line_words): lines whose best cosine to a template is `THRESHOLD` or more."""
    lines = stored.filter(F.size("lines") > 0).select("file", F.explode("lines").alias("l")).select("file", "l.line", "l.content")
    words = lines.select("file", "line", F.explode(F.split(F.lower("content"), WORDS)).alias("word")).filter("word <> ''")
    best = closest(words.groupBy("file", "line", "word").agg(F.count("*").alias("tf")), ["file", "line"], TEMPLATES)
    scored = best.select("file", "line", F.substring_index("best.template", "|", -1).alias("licence"), (-F.col("best.minus")).alias("score"), F.col("n_words").alias("line_words"))
    return scored.filter(F.col("score") >= THRESHOLD)


def ancestors(directory: Column) -> Column:
    """The directory and all above it, with their depths; the root is ''."""
    parts = F.split(directory, "/")
    return F.transform(F.sequence(F.lit(0), F.size(parts)), lambda d: F.struct(d.alias("depth"), F.array_join(F.slice(parts, F.lit(1), d), "/").alias("directory")))


def scan(files: DataFrame) -> DataFrame:
    """key, path, licence, score, found ('own', 'inherited' or null), licence_dir, per file.

    `files` has key, path and text. A file's own licence is what an SPDX tag says, or a licence file's whole text, compared
    as one vector with whole licence texts; else that of its best notice: a line, or a window of words around
    a trigger word across lines. A
    licence file is named like one, or its notices make up `NOTICE_SHARE` of its words; files
    without a licence of their own take that of the nearest ancestor directory that holds a
    licence file. Several such files in a directory: highest score, then the licence that
    sorts first.

    Null path: no inheritance. Null or empty text: no own licence. Texts are read whole, of any length; of equal scores the
    licence that sorts first is taken. Repeated rows stay; other columns are ignored; empty tables are fine. Distinct directories, not files, are joined
    with their ancestors, so a directory with a third of all files is one row of that join.
    """
    stored = headers(files)
    by_line = scratch(notices(stored), "licence-lines")
    by_window = scratch(windows(stored), "licence-windows")
    # words of notices: those of noted lines, and others of windows that are closer than each noted line they touch
    lines = by_line.select("file", "line", "line_words")
    touched = by_window.select("file", "trigger", "score", F.explode(F.array_distinct("line_of")).alias("line"))
    beaten = touched.join(by_line.select("file", "line", F.col("score").alias("of_line")), ["file", "line"]).filter("score <= of_line")
    closer = by_window.join(beaten.select("file", "trigger").distinct(), ["file", "trigger"], "left_anti")
    places = closer.select("file", F.explode(F.arrays_zip(F.sequence(F.col("first"), F.col("first") + F.size("line_of") - 1).alias("place"), F.col("line_of").alias("line"))).alias("p"))
    apart = places.select("file", "p.place", "p.line").distinct().join(lines, ["file", "line"], "left_anti")
    counted = lines.select("file", "line_words").unionByName(apart.select("file", F.lit(1).cast("long").alias("line_words")))
    counted = counted.groupBy("file").agg(F.sum("line_words").alias("notice_words"))
    votes = [x.select(F.lit(n).alias("rank"), "file", "licence", "score") for n, x in ((0, stated(stored)), (0, wholes(stored)), (1, by_line), (1, by_window))]
    found = reduce(DataFrame.unionByName, votes).groupBy("file").agg(F.min(F.struct("rank", (-F.col("score")).alias("minus"), F.col("licence"))).alias("b"))
    own = found.join(counted, "file", "left").select("file", F.col("b.licence").alias("own"), (-F.col("b.minus")).alias("own_score"), "notice_words")
    own = scratch(own, "own-licences")
    placed = stored.select("file", "key", "path", "n_words", F.regexp_replace("path", "/?[^/]*$", "").alias("directory"))
    named = F.col("path").rlike(LICENCE_FILE) | (F.col("notice_words") >= NOTICE_SHARE * F.col("n_words"))
    declared = placed.join(own, "file").filter(named & F.col("directory").isNotNull())
    declared = declared.groupBy("directory").agg(F.min(F.struct((-F.col("own_score")).alias("minus"), F.col("own").alias("licence"))).alias("d"))
    declared = scratch(declared.select(F.col("directory").alias("above"), F.col("d.licence").alias("licence"), (-F.col("d.minus")).alias("score")), "declared")
    directories = placed.filter("directory is not null").select("directory").distinct()
    up = directories.select("directory", F.explode(ancestors(F.col("directory"))).alias("a")).select("directory", "a.depth", F.col("a.directory").alias("above"))
    nearest = up.join(declared, "above").groupBy("directory").agg(F.max(F.struct("depth", "above", "licence", "score")).alias("n"))
    nearest = scratch(nearest.select("directory", F.col("n.above").alias("above"), F.col("n.licence").alias("from_above"), F.col("n.score").alias("score_above")), "inherited")
    out = placed.join(own, "file", "left").join(nearest, "directory", "left")
    has_own = F.col("own").isNotNull()
    return out.select(
        "key",
        "path",
        F.coalesce("own", "from_above").alias("licence"),
        F.coalesce("own_score", "score_above").alias("score"),
        F.when(has_own, "own").when(F.col("from_above").isNotNull(), "inherited").alias("found"),
        F.when(~has_own, F.col("above")).alias("licence_dir"),
    )
