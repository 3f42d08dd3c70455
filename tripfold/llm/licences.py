"""Licence scan: TF-IDF cosine to templates, then directory inheritance (operator 3).

Blocks of a file (each line, each paragraph, the whole text) are sparse TF-IDF
vectors and are compared with the templates. Document frequencies are those of
all lines of all files; only the templates' terms need counting, which keeps
the table bounded. A word outside the templates weighs as one that no line has,
so a block with much other text is no licence notice. The best template of
the best block is the file's own licence if the cosine reaches ``COSINE``.

A file that is named as one (``LICENSE``, ``COPYING``) and has a licence is a
licence file of its directory; the title of a licence text is a template, so long
texts are known by it. So is a file without an ending whose whole text is a
notice. A source file with a notice at its head passes nothing on. A file
without an own licence inherits that of the nearest directory above it (its own
included): distinct directories are joined with licence directories by their
ancestors, and the answer goes back to the files by a salted join, so neither a
root directory nor one huge directory meets in one task.

Defined cases: null or empty text has no licence of its own, a null path is a
file at the root. Among equal scores the licence whose text holds the other's
holds, else the first by name, among licence files of a directory the best score, then the smallest path. Repeated
rows are judged one by one. Empty tables give empty results. Other columns are
carried in ``doc``.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripfold.llm import arrays as A
from tripfold.llm.shared import named, prepare, salted_join, stored

COSINE = 0.6
SALTS = 16
_FOLD = A.alphanumeric_words()

# Titles of licence texts, and licence notices as they are commonly written.
TEMPLATES = (
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("Artistic-1.0", "The \"Artistic License\""),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSD-3-Clause", "Neither the name of the University nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("CC0-1.0", "CC0 1.0 Universal"),
    ("GFDL-1.2", "GNU Free Documentation License Version 1.2, November 2002"),
    ("GFDL-1.3", "GNU Free Documentation License Version 1.3, 3 November 2008"),
    ("GPL-1.0", "GNU GENERAL PUBLIC LICENSE Version 1, February 1989"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-2.0", "GNU LIBRARY GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("LGPL-2.0", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Library General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("MPL-1.1", "MOZILLA PUBLIC LICENSE Version 1.1"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has dedicated all copyright and related rights to the public domain under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 3 of the License, or any later version."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
)


#: Licences whose text holds another one's whole text.
HOLDS = {"BSD-3-Clause": "BSD-2-Clause"}


def preferred(a: str, b: str) -> bool:
    """Whether ``a`` comes before ``b`` at the same score: a text that holds the other one, else by name."""
    return HOLDS.get(a) == b or (HOLDS.get(b) != a and a < b)


def terms(text: str) -> list[str]:
    part = next(A.slices(pa.array([text])))
    w = A.words(part, _FOLD)
    low = _FOLD[part.data].astype(np.uint8).tobytes()
    return [low[a:b].decode() for a, b in zip(w.start, w.end, strict=True)]


class Vocabulary:
    """The templates' terms by hash; with document frequencies also the templates' unit vectors."""

    def __init__(self, templates=TEMPLATES, lines: int = 0, frequency: dict[str, int] | None = None) -> None:
        self.names = [n for n, _ in templates]
        bags = [Counter(terms(t)) for _, t in templates]
        self.words = sorted({w for b in bags for w in b})
        hashes = []
        for part in A.slices(pa.array([" ".join(self.words)])):
            hashes = A.words(part, _FOLD).hash
        self.order = np.argsort(hashes)
        self.hashes = np.asarray(hashes)[self.order]
        self.seen = np.zeros(1 << 16, bool)
        self.seen[(self.hashes >> A.U(48)).astype(np.int64)] = True
        frequency = frequency or {}
        self.idf = np.array([math.log((1 + lines) / (1 + frequency.get(w, 0))) for w in self.words]) if lines else np.ones(len(self.words))
        self.other = math.log(1 + lines) if lines else 1.0
        at = {w: i for i, w in enumerate(self.words)}
        self.vectors = np.zeros((len(bags), len(self.words)))
        for row, bag in enumerate(bags):
            for w, n in bag.items():
                self.vectors[row, at[w]] = n * self.idf[at[w]]
        norm = np.linalg.norm(self.vectors, axis=1, keepdims=True)
        self.vectors /= np.where(norm > 0, norm, 1)

    def index(self, hashes: np.ndarray) -> np.ndarray:
        """Term number of every word, -1 for other words."""
        out = np.full(len(hashes), -1, np.int64)
        maybe = np.flatnonzero(self.seen[(hashes >> A.U(48)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.hashes, hashes[maybe]), len(self.hashes) - 1)
        hit = self.hashes[at] == hashes[maybe]
        out[maybe[hit]] = self.order[at[hit]]
        return out


def _line_of(part: A.Texts, w: A.Words) -> np.ndarray:
    """Line number of every word within the slice; lines of different rows differ."""
    breaks = np.concatenate(([0], np.cumsum(part.data == 10)))
    return breaks[w.start] + w.row


def _frequencies(vocabulary: Vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines, counts = 0, np.zeros(len(vocabulary.words), np.int64)
        for batch in batches:
            for part in A.slices(batch.column("text")):
                w = A.words(part, _FOLD)
                line = _line_of(part, w)
                lines += len(np.unique(line))
                term = vocabulary.index(w.hash)
                known = term >= 0
                pairs = np.unique(line[known] * len(counts) + term[known])
                counts += np.bincount(pairs % len(counts), minlength=len(counts))
        yield pa.RecordBatch.from_arrays([pa.array(["", *vocabulary.words]), pa.array([lines, *counts.tolist()], pa.int64())], names=["term", "n"])
    return run


def best(vocabulary: Vocabulary, group: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Groups that have a template term, ascending, with their best template and cosine. ``group``: ascending group of each word."""
    known = term >= 0
    if not known.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    size = len(vocabulary.words)
    groups, place = np.unique(group[known], return_inverse=True)
    words = np.searchsorted(group, groups, side="right") - np.searchsorted(group, groups)
    cells, n = np.unique(place * size + term[known], return_counts=True)
    row, column = cells // size, cells % size
    value = n * vocabulary.idf[column]
    inside = np.bincount(row, value**2, len(groups))
    outside = (words - np.bincount(place, minlength=len(groups))) * vocabulary.other**2
    norm = np.sqrt(inside + outside)
    # cosine <= |part inside the vocabulary| / norm, so most groups are out before any product
    able = np.flatnonzero(np.sqrt(inside) >= COSINE * norm * (1 - 1e-9))
    dots = np.zeros((len(able), len(vocabulary.vectors)))
    slot = np.full(len(groups), -1)
    slot[able] = np.arange(len(able))
    use = slot[row] >= 0
    np.add.at(dots, slot[row[use]], value[use, None] * vocabulary.vectors[:, column[use]].T)
    cosine = dots / np.where(norm[able] > 0, norm[able], 1)[:, None]
    which = cosine.argmax(axis=1) if len(able) else np.zeros(0, np.int64)
    return groups[able], which, cosine[np.arange(len(able)), which]


def _scan(vocabulary: Vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            score, name, whole = np.zeros(rows), np.full(rows, -1), np.zeros(rows)
            for part in A.slices(batch.column("text")):
                w = A.words(part, _FOLD)
                term = vocabulary.index(w.hash)
                line = _line_of(part, w)
                gap = np.diff(line, prepend=-1)
                paragraph = np.cumsum((gap > 1) | (np.diff(w.row, prepend=-1) > 0))
                for group, is_whole in ((line, False), (paragraph, False), (w.row, True)):
                    groups, which, cosine = best(vocabulary, group, term)
                    owner = w.row[np.searchsorted(group, groups)] + part.first
                    for at, k, c in zip(owner.tolist(), which.tolist(), cosine.tolist(), strict=True):
                        if is_whole:
                            whole[at] = c
                        if c > score[at] + 1e-12 or (abs(c - score[at]) <= 1e-12 and (name[at] < 0 or preferred(vocabulary.names[k], vocabulary.names[name[at]]))):
                            score[at], name[at] = c, k
            found = [vocabulary.names[k] if k >= 0 and s >= COSINE else None for k, s in zip(name, score, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("path"), pa.array(found, pa.string()), pa.array([float(s) if f else None for f, s in zip(found, score, strict=True)], pa.float64()),
                 pa.array([bool(f) and c >= COSINE for f, c in zip(found, whole, strict=True)], pa.bool_())], names=["doc", "path", "own", "score", "is_licence_file"])
    return run


#: Names of licence files, and endings of files that hold something else, whatever notice they begin with.
LICENCE_NAME = r"(?i)^(.*[-._])?(un)?licen[cs]es?([-._].*)?$|^copying([-._].*)?$|^copyright([-._].*)?$"
SOURCE_NAME = r"\.[A-Za-z][A-Za-z0-9+]{0,9}$"


def may_pass_on(path: Column, own: Column, whole: Column) -> Column:
    """Whether a file's licence holds for the files beside and below it: a file named as a licence that holds one, or a file
    without an ending whose whole text is a notice (``whole``)."""
    name = F.regexp_extract(F.coalesce(path, F.lit("")), r"(?s)([^/]*)$", 1)
    by_name = name.rlike(LICENCE_NAME)
    return own.isNotNull() & (by_name | (whole & ~name.rlike(SOURCE_NAME)))


def directory(path: Column) -> Column:
    """All before the last ``/``, else the empty root."""
    return F.regexp_extract(F.coalesce(path, F.lit("")), r"(?s)^(.*)/[^/]*$", 1)


def scanned(files: DataFrame, keep: list[str], path: Column, text: str = "text", templates=TEMPLATES) -> DataFrame:
    """doc, path, licence, score, origin (``own``, ``inherited`` or null) and licence_path of every file."""
    prepare(files.sparkSession)
    source = files.select(F.struct(*[named(c) for c in keep]).alias("doc"), path.cast("string").alias("path"), F.col(text).alias("text"))
    counted = source.select("text").mapInArrow(_frequencies(Vocabulary(templates)), "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
    frequency = {r["term"]: r["n"] for r in counted.collect()}  # the templates' terms and one total
    vocabulary = Vocabulary(templates, frequency.pop("", 0) or 0, frequency)
    fields = T.StructType([source.schema["doc"], T.StructField("path", T.StringType()), *T.StructType.fromDDL("own string, score double, is_licence_file boolean").fields])
    own = stored(source.mapInArrow(_scan(vocabulary), fields), "licences").withColumn("dir", directory(F.col("path")))
    held = own.where(may_pass_on(F.col("path"), F.col("own"), F.col("is_licence_file"))).groupBy(F.col("dir").alias("above")).agg(F.min(F.struct((-F.col("score")).alias("less"), F.coalesce("path", F.lit("")).alias("path"), "own")).alias("x"))
    held = held.select("above", F.col("x.own").alias("inherited"), F.col("x.path").alias("from"))
    # a/b/c → a/b/c, a/b, a and the root
    parts = F.split("dir", "/")
    dirs = own.where("own IS NULL").select("dir").distinct()
    above = dirs.select("dir", F.explode(F.sequence(F.lit(0), F.size(parts))).alias("depth")).withColumn("above", F.array_join(F.slice(F.split("dir", "/"), F.lit(1), F.col("depth")), "/"))
    nearest = salted_join(above, held, "above", SALTS, "inner").groupBy("dir").agg(F.max(F.struct("depth", "inherited", "from")).alias("x")).select("dir", "x.inherited", "x.from")
    out = salted_join(own, nearest, "dir", SALTS)
    own_ = F.col("own").isNotNull()
    return out.select("doc", "path", F.coalesce("own", "inherited").alias("licence"), "score",
                      F.when(own_, "own").when(F.col("inherited").isNotNull(), "inherited").alias("origin"), F.when(own_, F.col("path")).otherwise(F.col("from")).alias("licence_path"))


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc.doc_id", "path", "licence", "score", "origin", "licence_path")
