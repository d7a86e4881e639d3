"""Licences of files: statements by sparse TF-IDF cosine, the rest from the nearest directory.

Templates are notices, standard file headers, whole short licences, titles and identifiers. A
file is one sequence of words over all its lines, and every stretch of it as long as a template
is held against that template: so a notice is found within a longer line, a header over
several lines, and a licence file as a whole. Only stretches near a word that statements have
are looked at, and only for templates whose words near it could reach the threshold at all.

Terms are those of the templates; a term's document frequency is counted over all lines of all
files. Other words weigh like a term that no line has, so prose that happens to hold a few
terms stays far from every template. The table of frequencies has one row for each template
term, whatever the corpus, and goes to the executors with the scoring function: files are
scored where they are, without a shuffle.

A file's own licence is its best template at or above the threshold. A licence file speaks
for its directory: a file with a licence whose name is one of the known names, or that has at
most `short` words. Directories take over the licence of the nearest ancestor that has one;
files without a statement take over that of their directory. Directories, not files, meet
their ancestors, so a large directory costs no more than a small one.

Defined cases: null and empty texts have no statement and may inherit. Null paths neither give
nor inherit. Of several licence files of a directory the best score counts, then the smallest
path; of equal scores of a file the smaller licence name. Repeated rows each get a row. An
empty table gives an empty one. Only the named columns are read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmeter.llm.common import written

THRESHOLD = 0.7
SHORT = 60
LICENCE_NAMES = ("license", "licence", "copying", "unlicense", "notice")
# Notices, headers and licences as they stand in files.
IDENTIFIERS = (
    "Apache-2.0",
    "BSD-2-Clause",
    "BSD-3-Clause",
    "CC-BY-4.0",
    "CC-BY-NC-4.0",
    "CC-BY-SA-4.0",
    "CC0-1.0",
    "GPL-2.0",
    "GPL-3.0",
    "ISC",
    "LGPL-3.0",
    "MIT",
    "MPL-2.0",
    "Unlicense",
)
GNU = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {kind}General Public License "
    "as published by the Free Software Foundation, either version {n} of the License, or (at your option) any later version. "
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
    "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind}General Public License for more details."
)
AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE "
    "FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
    "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
    '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
    "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
    "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
    "substantial portions of the Software."
)
BSD_GRANT = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
    "are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution."
)
BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
    "this software without specific prior written permission."
)
BSD_AS_IS = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT '
    "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."
)
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to "
        'in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY '
        "KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-2-Clause", f"{BSD_GRANT} {BSD_AS_IS}"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", f"{BSD_GRANT} {BSD_NAMES} {BSD_AS_IS}"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-2.0", GNU.format(kind="", n=2)),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-3.0", GNU.format(kind="", n=3)),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
        "that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-3.0", GNU.format(kind="Lesser ", n=3)),
    ("MIT", "Released under the MIT License."),
    ("MIT", MIT_GRANT),
    ("MIT", f"{MIT_GRANT} {AS_IS}"),
    ("MPL-2.0", "This file is subject to the terms of the Mozilla Public License, version 2.0."),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
        "this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, "
        "sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or "
        "non-commercial, and by any means.",
    ),
    *((name, f"SPDX-License-Identifier: {name}") for name in IDENTIFIERS),
    *((name, f"SPDX-License-Identifier: {name}-{suffix}") for name in ("GPL-2.0", "GPL-3.0", "LGPL-3.0") for suffix in ("only", "or-later")),
)
#: Every template has one of these words.
MARKS = frozenset(("license", "licensed", "licenses", "spdx", "permission", "redistribution", "redistribute", "unencumbered", "domain"))


TERM = regex.compile(r"[\p{L}\p{N}]+(?:\.\p{N}+)*")
FOUND = "doc_id long, path string, n_words long, licence string, score double"
LINES = ""  # stands for the number of lines among the counts of terms


def terms(line: str) -> list[str]:
    """Lower-case runs of letters and digits, with numbers behind inner dots."""
    return TERM.findall(line.lower())


VOCABULARY = frozenset(t for _, text in TEMPLATES for t in terms(text))
MARKED = regex.compile("|".join(sorted(MARKS, reverse=True)), regex.IGNORECASE)


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many lines of the batch each template term is."""
    for batch in batches:
        counts: Counter[str] = Counter()
        for text in batch.column(0).to_pylist():
            for line in text.split("\n") if text else ():
                counts[LINES] += 1
                counts.update(VOCABULARY.intersection(terms(line)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["term", "n"]
        )


class Scorer:
    """Cosine of stretches of words and the templates, by document frequencies of the template terms."""

    def __init__(self, counts: dict[str, int], threshold: float = 0.0):
        n = counts.get(LINES, 0)
        self.idf = {t: math.log((1 + n) / (1 + counts.get(t, 0))) + 1 for t in VOCABULARY}
        self.rest = math.log(1 + n) + 1
        self.threshold = threshold
        self.templates = []
        for licence, text in sorted(TEMPLATES):
            words = terms(text)
            weights = {t: k * self.idf[t] for t, k in Counter(words).items()}
            length = math.sqrt(math.fsum(w * w for w in weights.values()))
            self.templates.append((licence, len(words), {t: w / length for t, w in weights.items()}))
        self.longest = max(size for _, size, _ in self.templates)

    def best(self, text: str) -> tuple[float, str]:
        """The best score of a stretch near a mark and its licence, the smaller name of equals.

        Templates that cannot reach the threshold are left out, so a score below it may be too low.
        """
        if not MARKED.search(text):
            return 0.0, ""
        words = terms(text)
        best = (0.0, "")
        for low, high in self._near(words):
            part = words[low:high]
            held = set(part)
            for licence, size, template in self.templates:
                most = math.sqrt(math.fsum(w * w for t, w in template.items() if t in held))
                if most >= max(self.threshold, -best[0]):
                    best = min(best, (-round(self._slid(part, size, template), 6), licence))
        return -best[0], best[1]

    def _near(self, words: list[str]) -> Iterator[tuple[int, int]]:
        """Stretches of words that hold every stretch of a template's length with a mark in it."""
        low = high = -1
        for i, word in enumerate(words):
            if word in MARKS:
                if i - self.longest > high:
                    if high >= 0:
                        yield max(low, 0), high
                    low = i - self.longest
                high = i + self.longest
        if high >= 0:
            yield max(low, 0), high

    def _slid(self, words: list[str], size: int, template: dict[str, float]) -> float:
        """The best cosine of `size` words in a row, told from word to word."""
        idf, strange = self.idf, self.rest**2
        counts: dict[str, int] = {}
        dot = square = best = 0.0
        for i, word in enumerate(words):
            weight = idf.get(word)
            if weight is None:
                square += strange
            else:
                k = counts.get(word, 0)
                counts[word] = k + 1
                square += (2 * k + 1) * weight * weight
                dot += weight * template.get(word, 0.0)
            if i >= size:
                gone = words[i - size]
                weight = idf.get(gone)
                if weight is None:
                    square -= strange
                else:
                    k = counts[gone]
                    counts[gone] = k - 1
                    square -= (2 * k - 1) * weight * weight
                    dot -= weight * template.get(gone, 0.0)
            if square > 0 and dot > best * math.sqrt(square):
                best = dot / math.sqrt(square)
        return min(best, 1.0)


def _own_licences(counts: dict[str, int], threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(counts, threshold)
        for batch in batches:
            words, licences, scores = [], [], []
            for text in batch.column("text").to_pylist():
                score, licence = scorer.best(text) if text else (0.0, "")
                hit = score >= threshold
                words.append(len(text.split()) if text else 0)
                licences.append(licence if hit else None)
                scores.append(score if hit else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("path"), pa.array(words, pa.int64()), pa.array(licences, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "path", "n_words", "licence", "score"],
            )

    return run


def directory(path: Column) -> Column:
    return F.regexp_replace(path, "/[^/]*$", "")


def scanned(files: DataFrame, path: str = "path", text: str = "text", ids: str = "doc_id", threshold: float = THRESHOLD, short: int = SHORT) -> DataFrame:
    """doc_id, path, licence, score, how (own, inherited, none) and the directory it comes from."""
    read = files.select(F.col(ids).cast("long").alias("doc_id"), F.col(path).cast("string").alias("path"), F.col(text).cast("string").alias("text"))
    counted = read.select("text").mapInArrow(_term_counts, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
    counts = {r["term"]: r["n"] for r in counted.collect()}  # a row for each template term
    rows = read.mapInArrow(_own_licences(counts, threshold), FOUND)
    rows = written(rows.withColumn("directory", directory(F.col("path"))), "licence-files")
    name = F.lower(F.regexp_extract("path", r"([^/.]*)[^/]*$", 1))
    speaks = F.col("licence").isNotNull() & F.col("directory").isNotNull() & (name.isin(*LICENCE_NAMES) | (F.col("n_words") <= short))
    given = rows.where(speaks).groupBy("directory").agg(
        F.min(F.struct((-F.col("score")).alias("order"), "path", "licence")).alias("best")
    )
    given = written(given.select("directory", "best.licence"), "licence-directories")
    parts = F.split("directory", "/")
    above = rows.select("directory").where("directory is not null").distinct().select(
        "directory", F.explode(F.sequence(F.lit(1), F.size(parts))).alias("depth"), parts.alias("parts")
    )
    above = above.select("directory", "depth", F.array_join(F.slice("parts", F.lit(1), F.col("depth")), "/").alias("ancestor"))
    near = above.join(given.withColumnRenamed("directory", "ancestor"), "ancestor").groupBy("directory").agg(
        F.max(F.struct("depth", "ancestor", "licence")).alias("near")
    )
    rows = rows.join(near, "directory", "left")
    is_own = F.col("licence").isNotNull()
    how = F.when(is_own, "own").when(F.col("near").isNotNull(), "inherited").otherwise("none")
    return rows.select(
        "doc_id",
        "path",
        F.coalesce("licence", "near.licence").alias("licence"),
        "score",
        how.alias("how"),
        F.when(~is_own, F.col("near.ancestor")).alias("origin"),
    )
