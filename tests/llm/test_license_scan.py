"""The licence scan against a plain search with every rule at every text."""

from __future__ import annotations

import re

import numpy as np
import pytest

from contrail.llm import license_scan as scan
from contrail.llm.license_rules import NO_LICENCE, all_rules
from contrail.llm.queries import op12_license_rules

RULES = [(r, re.compile(f" (?:{r.pattern})(?= )")) for r in all_rules()]
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def brute(text):
    """No keywords, all pairs of detections, words counted by splitting."""
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    base = []
    for phrase, label in PHRASES.items():
        n = len(phrase.split())
        base += [(k, label) for k in range(len(words)) if words[k : k + n] == phrase.split()]
    whole = f" {' '.join(words)} "
    found = set()
    for k, (r, pattern) in enumerate(RULES):
        for m in pattern.finditer(whole):
            start = whole[: m.start() + 1].count(" ") - 1
            found.add((start, start + len(m[0].split()), r.priority, k, r.label, r.weight))

    def inside(a, b):
        if not (b[0] <= a[0] and a[1] <= b[1] and b[2] >= a[2]):
            return False
        return b[:2] != a[:2] or b[2] > a[2] or b[3] < a[3]

    kept = [a for a in found if a[4] != NO_LICENCE and not any(inside(a, b) for b in found)]
    best = {label: 0.99 for _, label in base}
    for a in kept:
        best[a[4]] = max(best.get(a[4], 0), a[5])
    starts = [k for k, _ in base]
    return (
        len(words), len(base), min(starts, default=None), max(starts, default=None),
        ",".join(sorted({x for _, x in base})), ",".join(sorted(best)),
        pytest.approx(1 - np.prod([1 - w for w in best.values()]) if best else 0, abs=1e-12),
    )


PIECES = [
    "Released under the MIT License.", "licensed under", "the GNU General Public License", "version 2", ", v3",
    "or any later version", "Apache License, Version 2.0", "Apache License", "CC BY-NC", "CC-BY-NC-SA 4.0", "-SA",
    "SPDX-License-Identifier: MIT", "SPDX-License-Identifier:", "GPL-3.0-or-later", "LGPL 2.1", "BSD 3-Clause",
    "not", "License: ", "Creative Commons Attribution-NonCommercial 4.0 International", "all rights reserved",
    "Artistic License in", "the", "mit", "license", "under", "\n", "é漢字", "x" * 30, "public domain", "is in the",
    "This work", "https://www.gnu.org/licenses/gpl-3.0.html", "https://creativecommons.org/licenses/by-nc/4.0/",
    "Non-commercial use only", "0BSD", "Python Software Foundation License", "PSF license", "OpenRAIL-M", "open rail",
    "without prior written permission of the publisher", "AGPLv3", "GNU Affero General Public License",
    "Permission is hereby granted, free of charge, to any person obtaining a copy", "İK", "\xa0", "_", "cc by nc cc by nc",
]


def test_against_brute_force():
    rng = np.random.default_rng(8)
    texts = [" ".join(rng.choice(PIECES, rng.integers(0, 14))) for _ in range(1500)]
    for text in [None, "", " \n", *PIECES, *texts]:
        assert scan.scan(text)[:7] == brute(text), text


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("This work is licensed under the GNU General Public License, version 3.", "gpl-3"),
        ("under the GNU Lesser General Public License v2.1 or later", "lgpl-2.1"),
        ("SPDX-License-Identifier: BSD-3-Clause", "bsd-3-clause"),
        ("Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International", "cc-by-nc-sa"),
        ("CC BY-NC-SA 4.0", "cc-by-nc,cc-by-nc-sa"),
        ("It is not licensed under the Mozilla Public License 2.0.", ""),
        ("either version 3 of the License, or (at your option) any later version", ""),
        ("I lost my driver's license on a mission to permit", ""),
        ("Dual licensed: MIT License, Apache-2.0", "apache-2,dual,mit"),
    ],
)
def test_labels(text, labels):
    assert scan.scan(text)[5] == labels


def test_rules_are_many_and_their_keywords_are_necessary():
    """Every rule admits its own examples: what it matches holds its keywords."""
    rules = scan.rule_set()
    assert len({r.pattern for r in rules.rules}) > 500
    rng = np.random.default_rng(9)
    for _ in range(300):
        text = f" {b' '.join(scan.normal_words(' '.join(rng.choice(PIECES, 12)))).decode('latin-1')} "
        admitted = set(rules.admitted(text))
        matching = {k for k, (_, pattern) in enumerate(RULES) if pattern.search(text)}
        assert matching <= admitted


def test_containment_is_linear_and_agrees_with_all_pairs():
    rng = np.random.default_rng(10)
    for _ in range(200):
        found = [
            scan.Detection(str(k), int(s), int(s + rng.integers(1, 9)), int(rng.integers(0, 3)), 0.5)
            for k, s in enumerate(rng.integers(0, 20, 25))
        ]
        order = {d: k for k, d in enumerate(found)}

        def yields(a, b):
            inside = b.start <= a.start and a.end <= b.end and b.priority >= a.priority
            same = (a.start, a.end, a.priority) == (b.start, b.end, b.priority)
            return a != b and inside and (not same or order[b] < order[a])

        kept = {a for a in found if not any(yields(a, b) for b in found)}
        assert set(scan.resolved(found)) == kept


def test_on_spark(spark):
    long = "word " * 200_000 + "under the MIT license " * 3000
    texts = [None, "", long, "CC BY-NC", "CC BY-NC", "plain words"]
    rows = [(None if k == 4 else k, t, "clash", 1.0) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, licenses string, score double").repartition(3)
    result = scan.license_scan(docs)
    assert result.columns == [*docs.columns, "licenses_"]
    found = sorted(((r["doc_id"], *r["licenses_"][:7]) for r in result.collect()), key=repr)
    assert found == sorted(((d, *brute(t)) for d, t, *_ in rows), key=repr)
    assert scan.license_scan(docs.limit(0)).count() == 0


def test_query(spark):
    sf_dir = "/root/testdata/sf0.01"
    found = {r["doc_id"]: tuple(r)[1:8] for r in op12_license_rules(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(found) == len(docs)
    assert all(found[r["doc_id"]] == brute(r["text"]) for r in docs)
