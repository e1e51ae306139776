"""Licence scans against a scan of every stretch."""

import re
from collections import Counter

import corpus
import pytest

from regionscore.llm import licenses
from regionscore.llm.queries import QUERIES, table

SMALL = {"A": ("one two three four five six",), "B": ("one two three nine ten", "red green blue"), "C": ("blue red",)}


def brute(text, templates, percent):
    """Best coefficient of any stretch, by (template name)."""
    words = re.findall(r"[a-z0-9\x80-\U0010ffff]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    pairs, best = list(zip(words, words[1:])), {}
    for name, wordings in templates.items():
        for w in wordings:
            own = re.findall(r"[a-z0-9]+", w.lower())
            t = Counter(zip(own, own[1:]))
            m = sum(t.values())
            for i in range(len(pairs)):
                for j in range(i + 1, min(len(pairs), i + 2 * m) + 1):
                    both = sum((Counter(pairs[i:j]) & t).values())
                    x = 2 * both / (j - i + m)
                    if 200 * both >= percent * (j - i + m) and x > best.get(name, 0):
                        best[name] = x
    return max(best.values(), default=0.0)


TEXTS = ["one two three four five six", "x one two three four FIVE, six y", "one two three four five seven", "red\ngreen; blue red", "one two three nine ten one two three four five six",
         "two one three", "", None, "one two one two three nine ten ten", "blue red blue red", "one two three four x five six"]


@pytest.mark.parametrize("percent", [60, 80, 100])
def test_best_of_all_stretches(spark, percent):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    for r in licenses.scan(df, SMALL, percent).collect():
        assert abs(r["score"] - brute(TEXTS[r["doc_id"]], SMALL, percent)) < 1e-12, TEXTS[r["doc_id"]]
        assert (r["license"] is None) == (r["score"] == 0) == (not r["spans"])


def test_spans_are_bytes_and_disjoint(spark):
    text = "é Released under the MIT License. Then.\nLicensed under the Apache License, Version 2.0."
    r = licenses.scan(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert [(s["license"], text.encode()[s["start"]:s["end"]].decode()) for s in r["spans"]] == [
        ("MIT", "Released under the MIT License"), ("Apache-2.0", "Licensed under the Apache License, Version 2.0")]


def test_every_wording_is_found_alone_and_in_a_text(spark):
    rows = [(w, name) for name, wordings in licenses.TEMPLATES.items() for w in wordings]
    df = spark.createDataFrame([(i, corpus.sentence(i, 30) + "\n" + w + "\n" + corpus.sentence(i + 99, 30)) for i, (w, _) in enumerate(rows)], "doc_id bigint, text string")
    got = {r["doc_id"]: (r["license"], r["score"]) for r in licenses.scan(df).collect()}
    assert got == {i: (name, 1.0) for i, (_, name) in enumerate(rows)}


def test_odd_rows_and_empty_table(spark):
    got = licenses.scan(corpus.frame(spark))
    assert got.count() == len(corpus.rows()) and got.filter("license is not null").count() == 0
    assert licenses.scan(corpus.empty(spark)).count() == 0
    assert licenses.scan(corpus.frame(spark), {}).filter("score > 0").count() == 0


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    lines = {"Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
             "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Released under the MIT License.": "MIT"}
    docs = table(spark, sf, "documents").collect()
    want = {d["doc_id"]: {name for line, name in lines.items() if line in (d["text"] or "")} for d in docs}
    got = {r["doc_id"]: r["license"] for r in QUERIES["op6_license_scan"](spark, sf).collect()}
    assert len(got) == len(docs) and all((got[k] in names) if names else got[k] is None for k, names in want.items())


#: Notices as they stand in files, with names filled in; most were named after a sibling or missed.
SIBLINGS = {
    "AGPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "LGPL-2.1": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "LGPL-2.0": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Library General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "GPL-2.0": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL": "This work is licensed under the GNU General Public License.",
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0.", "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.", "CC-BY-SA-3.0": "Licensed under CC BY-SA 3.0.",
    "CC-BY-NC-ND-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    "CC-BY-NC-SA": "Licensed under CC BY-NC-SA, see the site.", "CC0-1.0": "Licensed under CC0 1.0.", "EPL-2.0": "Licensed under the Eclipse Public License, Version 2.0.",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0.", "Apache-1.1": "Licensed under the Apache License, Version 1.1.", "Zlib": "Licensed under the zlib License.",
}


def test_siblings_are_told_apart(spark):
    bsd = {n: licenses.TEMPLATES[f"BSD-{n}-Clause"][2] for n in (2, 3, 4)}
    rows = [*SIBLINGS.items(), ("BSD-2-Clause", bsd[2]), ("BSD-2-Clause", licenses.TEMPLATES["BSD-2-Clause"][1]), ("MIT", licenses.TEMPLATES["MIT"][2]), ("MIT-0", licenses.TEMPLATES["MIT-0"][1]),
            ("BSD-3-Clause", bsd[3].replace("the copyright holder nor", "Example Widgets Incorporated nor")), ("BSD-4-Clause", bsd[4].replace("the organization", "the University of Somewhere"))]
    df = spark.createDataFrame([(i, corpus.sentence(i, 20) + "\n" + w + "\n" + corpus.sentence(i + 99, 20)) for i, (_, w) in enumerate(rows)], "doc_id bigint, text string")
    got = {r["doc_id"]: r["license"] for r in licenses.scan(df).collect()}
    assert got == {i: name for i, (name, _) in enumerate(rows)}


def test_every_wording_covers_its_whole_text(spark):
    """The warranty of a whole text belongs to the stretch that is named."""
    text = licenses.TEMPLATES["MIT"][2]
    r = licenses.scan(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert [(s["license"], s["start"], s["end"]) for s in r["spans"]] == [("MIT", 0, len(text) - 1)]
