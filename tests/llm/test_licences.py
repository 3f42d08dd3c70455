import math
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tripfold.llm import licences

MIT = licences.TEMPLATES[-2][1]
FILES = [("a/LICENSE", MIT), ("a/b/code.py", "import os"), ("a/b/c/deep.py", "x = 1\n"), ("z/code.py", "y = 2"), ("a/d/other.c", "# Licensed under the Apache License, Version 2.0.\nint main() {}"),
         ("a/d/LICENSE", "Licensed under CC BY-NC 4.0."), ("a/d/e/f.txt", "text"), ("top.txt", "nothing here"), ("a/b/LICENCE.md", ""), (None, None), ("a/d/LICENSE", "Licensed under CC BY-NC 4.0."), ("q/long.txt", "word " * 30000 + "\nReleased under the MIT License.\n" + "more " * 30000)]


@pytest.fixture(scope="module")
def files(spark):
    return spark.createDataFrame([(*f, "x", 1.0) for f in FILES], "path string, text string, licence string, score double").repartition(3)


def test_own_and_inherited(files):
    got = {r.path: (r.licence, r.origin, r.licence_path) for r in licences.scanned(files, ["path"], F.col("path")).collect()}
    assert got == {
        "a/LICENSE": ("MIT", "own", "a/LICENSE"), "a/b/code.py": ("MIT", "inherited", "a/LICENSE"), "a/b/c/deep.py": ("MIT", "inherited", "a/LICENSE"), "z/code.py": (None, None, None),
        "a/d/other.c": ("Apache-2.0", "own", "a/d/other.c"), "a/d/LICENSE": ("CC-BY-NC-4.0", "own", "a/d/LICENSE"), "a/d/e/f.txt": ("CC-BY-NC-4.0", "inherited", "a/d/LICENSE"), "top.txt": (None, None, None),
        "a/b/LICENCE.md": ("MIT", "inherited", "a/LICENSE"), None: (None, None, None), "q/long.txt": ("MIT", "own", "q/long.txt")}


COMMON = "/usr/share/common-licenses"
NAMES = {"Apache-2.0": "Apache-2.0", "Artistic": "Artistic-1.0", "BSD": "BSD-3-Clause", "CC0-1.0": "CC0-1.0", "GFDL-1.2": "GFDL-1.2", "GFDL-1.3": "GFDL-1.3", "GPL-1": "GPL-1.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0",
         "LGPL-2": "LGPL-2.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-1.1": "MPL-1.1", "MPL-2.0": "MPL-2.0"}


@pytest.mark.skipif(not os.path.isdir(COMMON), reason="no licence texts on this machine")
def test_whole_licence_texts_are_named_and_inherited(spark):
    rows = []
    for i, (file, want) in enumerate(sorted(NAMES.items())):
        if os.path.exists(f"{COMMON}/{file}"):
            with open(f"{COMMON}/{file}", encoding="utf-8", errors="replace") as f:
                rows += [(f"p{i}/{['LICENSE', 'COPYING', 'LICENCE.txt', 'license.md'][i % 4]}", f.read(), want), (f"p{i}/src/code.py", "x = 1", want)]
    assert len(rows) > 10
    files = spark.createDataFrame(rows, "path string, text string, want string").repartition(3)
    got = licences.scanned(files, ["want"], F.col("path")).collect()
    assert {r.path: r.licence for r in got} == {p: want for p, _, want in rows}
    assert {r.origin for r in got if r.path.endswith(".py")} == {"inherited"}


def test_notices_of_several_versions(spark):
    program = "# This program is free software; you can redistribute it and/or modify it\n# under the terms of the GNU General Public License as published by the\n# Free Software Foundation; either version %s of the License, or\n# (at your option) any later version.\n\nint main() {}"
    library = "/* This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version %s of the License, or (at your option) any later version. */"
    two = ("Copyright (c) 2020 A. Writer\n\nRedistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n1. Redistributions of source code must retain the above copyright notice, "
           "this list of conditions and the following disclaimer.\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n")
    three = two + "\nNeither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n"
    want = {"a/x.c": (program % 2, "GPL-2.0"), "a/y.c": (program % 3, "GPL-3.0"), "b/x.h": (library % "2.1", "LGPL-2.1"), "b/y.h": (library % 3, "LGPL-3.0"), "c/LICENSE": (two, "BSD-2-Clause"), "d/LICENSE": (three, "BSD-3-Clause")}
    files = spark.createDataFrame([(p, t) for p, (t, _) in want.items()], "path string, text string")
    assert {r.path: r.licence for r in licences.scanned(files, ["path"], F.col("path")).collect()} == {p: w for p, (_, w) in want.items()}


def test_a_source_file_passes_nothing_on(spark):
    notice = "Released under the MIT License."
    files = spark.createDataFrame([("a/main.c", notice), ("a/other.c", "int x;"), ("b/7", notice), ("b/8", "text"), ("c/LICENSE", "nothing that is known"), ("c/x", "text"), ("d/MIT-LICENSE.txt", notice), ("d/x.py", "pass")], "path string, text string")
    got = {r.path: r.licence for r in licences.scanned(files, ["path"], F.col("path")).collect()}
    assert got == {"a/main.c": "MIT", "a/other.c": None, "b/7": "MIT", "b/8": "MIT", "c/LICENSE": None, "c/x": None, "d/MIT-LICENSE.txt": "MIT", "d/x.py": "MIT"}


def test_a_licence_at_the_root_holds_for_all(spark):
    files = spark.createDataFrame([("LICENSE", MIT), ("x/y/z.py", "pass"), ("w.py", "")], "path string, text string")
    assert {r.licence for r in licences.scanned(files, ["path"], F.col("path")).collect()} == {"MIT"}


def test_scores_match_brute_force(files):
    lines = [x for _, t in FILES for x in (t or "").split("\n") if licences.terms(x)]
    vocabulary = {w for _, t in licences.TEMPLATES for w in licences.terms(t)}
    df = Counter(w for x in lines for w in set(licences.terms(x)))
    idf = lambda w: math.log((1 + len(lines)) / (1 + df[w])) if w in vocabulary else math.log(1 + len(lines))

    def cosine(block, template):
        a, b = Counter(licences.terms(block)), Counter(licences.terms(template))
        inside = sum((n * idf(w)) ** 2 for w, n in a.items() if w in vocabulary) + sum(n * idf(w) ** 2 for w, n in a.items() if w not in vocabulary)
        length = math.sqrt(inside * sum((n * idf(w)) ** 2 for w, n in b.items()))
        return sum(n * b[w] * idf(w) ** 2 for w, n in a.items()) / length if length else 0.0

    for r in licences.scanned(files, ["text"], F.col("path")).where("origin = 'own'").collect():
        blocks = [*r.doc.text.split("\n"), r.doc.text]
        assert math.isclose(r.score, max(cosine(b, t) for b in blocks for _, t in licences.TEMPLATES), rel_tol=1e-9)


def test_empty_table(files):
    assert licences.scanned(files.where("false"), ["path"], F.col("path")).count() == 0
