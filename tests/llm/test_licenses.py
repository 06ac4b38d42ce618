"""License scans: the alignment's parts against plain versions, finds in odd texts."""

import random
from itertools import combinations

import pytest

from shelfwise.llm import licenses

APACHE, MIT = licenses.TEMPLATES["Apache-2.0"], licenses.TEMPLATES["MIT"]


def test_increasing_is_longest():
    r = random.Random(2)
    for _ in range(60):
        b = r.sample(range(30), r.randint(0, 9))
        pairs = list(enumerate(b))
        got = licenses.increasing(pairs)
        assert all(x < y for (x, _), (y, _) in zip(got, got[1:])) and all(x < y for (_, x), (_, y) in zip(got, got[1:]))
        best = max((n for n in range(len(b) + 1) for c in combinations(b, n) if list(c) == sorted(c)), default=0)
        assert len(got) == best


def lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def test_alignment_is_common_and_ascending():
    r = random.Random(4)
    for _ in range(100):
        a, b = ([r.randint(0, 12) for _ in range(r.randint(0, 25))] for _ in range(2))
        m = licenses.align(a, b)
        assert all(a[i] == b[j] for i, j in m) and all(p < q and s < t for (p, s), (q, t) in zip(m, m[1:]))
        assert len(m) <= lcs(a, b)
    a = list(range(40))
    b = a[:10] + [99, 98] + a[12:30] + a[33:]
    assert len(licenses.align(a, b)) == lcs(a, b) == 35


def test_tables(spark):
    mit_text = licenses.TEMPLATES["MIT-text"]
    near = mit_text.replace("free of charge", "at no cost").replace("persons", "people")
    rows = [(0, "word " * 30 + APACHE + " end", [("Apache-2.0", 30)]), (1, f"{MIT}.\n" * 3, [("MIT", 0), ("MIT", 5), ("MIT", 10)]), (2, None, []), (3, "", []),
            (4, "the license of the work is under version of public general", []), (5, near.upper(), [("MIT-text", 0)]), (6, "x " * 20_000 + MIT, [("MIT", 20_000)]),
            (6, "x " * 20_000 + MIT, [("MIT", 20_000)]), (None, "All rights reserved", [("all-rights-reserved", 0)]), (8, "released license the mit under", []),
            (9, "license " * 5000, []), (10, "Released under the\tMIT\n\nLicense; é", [("MIT", 0)]), (11, "Released under MIT License", [("MIT", 0)])]
    df = spark.createDataFrame([(i, t, k) for k, (i, t, _) in enumerate(rows)], "doc_id long, text string, coverage int")
    out = licenses.scan(df)
    assert out.columns == [*df.columns, "licenses"]
    for r in out.collect():
        assert [(f["license"], f["start_word"]) for f in r["licenses"]] == rows[r["coverage"]][2], r
        assert all(0.8 <= f["coverage"] <= 1 for f in r["licenses"])
    assert licenses.scan(df.limit(0)).count() == 0
    two = licenses.scan(df.where("doc_id = 1"), {"a": MIT, "b": MIT}).first()["licenses"]
    assert sorted(f["license"] for f in two) == ["a"] * 3 + ["b"] * 3
    with pytest.raises(ValueError):
        licenses.scan(df, {"none": "..."})


NOTICE = ("This {} is free software{} you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published "
          "by the Free Software Foundation{} either version {} of the License, or (at your option) any later version. This {} is distributed in the "
          "hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY.")


def test_siblings_are_named_apart(spark):
    full = {k: v for k, v in licenses.TEMPLATES.items() if k.endswith("-full")}
    assert {"0BSD-full", "BSD-2-Clause-full", "BSD-3-Clause-full", "ISC-full", "MIT-0-full", "MIT-full"} <= set(full)
    assert all("WARRANTIES" in v.upper() or "WARRANTY" in v.upper() for v in full.values())
    rows = [(k, f"some words before Copyright (c) 2020 A Holder {v} and after") for k, v in full.items()]
    rows += [(k, licenses.TEMPLATES[k]) for k in ("BSD-2-Clause", "BSD-3-Clause", "ISC", "MIT-text", "Apache-2.0", "Apache-2.0-header", "MPL-2.0")]
    rows += [(name, NOTICE.format(what, *(";", lic, ";") if v[0] in "12" else (":", lic, ","), v, what)) for name, what, lic, v in (
        ("GPL-2.0-or-later", "program", "", "2"), ("GPL-3.0-or-later", "program", "", "3"), ("AGPL-3.0-or-later", "program", "Affero ", "3"),
        ("LGPL-2.0-or-later", "library", "Library ", "2"), ("LGPL-2.1-or-later", "library", "Lesser ", "2.1"), ("LGPL-3.0-or-later", "library", "Lesser ", "3"))]
    rows += [(f"{lic}-{v}.0-only", f"This work is licensed under the GNU {say}General Public License, version {v}.") for lic, say, v in (
        ("GPL", "", 2), ("GPL", "", 3), ("LGPL", "Lesser ", 3), ("AGPL", "Affero ", 3))]
    rows += [("MIT", f"{MIT}. {MIT}"), (None, "no license here"), (None, None)]
    out = licenses.scan(spark.createDataFrame(rows, "want string, text string"), best="best").collect()
    assert len(out) == len(rows)
    for r in out:
        assert (r["best"] and r["best"]["license"]) == r["want"], r
    assert all(r["best"] in r["licenses"] for r in out if r["best"])


def test_name_takes_most_matched_of_overlapping():
    short, long_, far = ("a", 1.0, 6, 3, 9), ("b", 0.9, 40, 0, 44), ("c", 0.95, 8, 60, 68)
    assert licenses.name([short, long_]) == long_
    assert licenses.name([short, long_, far]) == far              # apart from each other, the best coverage names the text
    assert licenses.name([short, ("d", 1.0, 6, 20, 26)]) == short
    assert licenses.name([]) is None
