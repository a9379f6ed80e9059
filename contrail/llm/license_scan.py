"""Licence scan: ordered signature rules behind a keyword filter.

A rule is a regex over the words of a text. It runs only on texts that hold all its keywords, which one
automaton finds for all rules at once. A detection inside another one gives way to it if the other has
the same priority or a higher one; detections that merely overlap both stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from contrail.llm.common import fresh, small_batches
from contrail.llm.license_rules import NO_LICENCE, Rule, all_rules

# Phrases that always count, and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
_BASE_WEIGHT = 0.99

RESULT = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, detections array<struct<label:string,start:long,end:long,priority:int>>"
)

# A word is a run of digits, letters and bytes from 128 on.
_KEEP = [*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]
_NORMAL = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b if b in _KEEP else 0x20 for b in range(256))


class Detection(NamedTuple):
    label: str
    start: int
    end: int
    priority: int
    weight: float


def normal_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_NORMAL).split()


class RuleSet:
    """Compiled rules; a rule is compiled when a text first needs it."""

    def __init__(self, rules: list[Rule]) -> None:
        self.rules = rules
        self._compiled: dict[int, re.Pattern] = {}
        self._automaton = ahocorasick.Automaton()
        words = {w for r in rules for w in r.keywords}
        # Only the beginning must be that of a word: keyword gpl also admits gplv3.
        for w in words:
            self._automaton.add_word(f" {w}", w)
        self._automaton.make_automaton()
        self._waiting = {w: [k for k, r in enumerate(rules) if r.keywords[0] == w] for w in words}

    def admitted(self, text: str) -> list[int]:
        """The rules whose keywords all occur in a normalised text."""
        seen = {w for _, w in self._automaton.iter(text)}
        return sorted(k for w in seen for k in self._waiting[w] if seen.issuperset(self.rules[k].keywords))

    def pattern(self, k: int) -> re.Pattern:
        if k not in self._compiled:
            self._compiled[k] = re.compile(f" (?:{self.rules[k].pattern})(?= )")
        return self._compiled[k]

    def detect(self, text: str) -> Iterator[tuple[int, int, int]]:
        """Rule, and the characters of a normalised text from the space before to the one after."""
        for k in self.admitted(text):
            for found in self.pattern(k).finditer(text):
                yield k, found.start(), found.end()


@cache
def rule_set() -> RuleSet:
    return RuleSet(all_rules())


def resolved(found: list[Detection]) -> list[Detection]:
    """The detections that lie in no other of their priority or a higher one; of equal intervals the
    higher priority stays, then the first rule. Whatever holds a detection sorts before it."""
    kept, reach = [], {}
    for d in sorted(found, key=lambda d: (d.start, -d.end, -d.priority)):
        if not any(end >= d.end for priority, end in reach.items() if priority >= d.priority):
            kept.append(d)
        reach[d.priority] = max(reach.get(d.priority, 0), d.end)
    return kept


def scan(text: str | None) -> tuple:
    """The fields of :data:`RESULT` for one text."""
    words = normal_words(text)
    # Every byte is a character: rules speak of a-z and digits, other bytes only fill words.
    whole = f" {b' '.join(words).decode('latin-1')} "
    rules = rule_set()
    base = [(at, phrase) for phrase in PHRASES for at in _places(whole, f" {phrase} ")]
    hits = list(rules.detect(whole))
    if not base and not hits:
        return len(words), 0, None, None, "", "", 0.0, []
    spaces = np.flatnonzero(np.frombuffer(whole.encode("latin-1"), np.uint8) == 0x20)
    found = [
        Detection(rules.rules[k].label, *np.searchsorted(spaces, (low, high)).tolist(),
                  rules.rules[k].priority, rules.rules[k].weight)
        for k, low, high in hits
    ]
    kept = [d for d in resolved(found) if d.label != NO_LICENCE]
    starts = np.searchsorted(spaces, [at for at, _ in base])
    base_labels = {PHRASES[phrase] for _, phrase in base}
    weights = dict.fromkeys(base_labels, _BASE_WEIGHT)
    for d in kept:
        weights[d.label] = max(d.weight, weights.get(d.label, 0.0))
    doubt = 1.0
    for label in sorted(weights):
        doubt *= 1 - weights[label]
    return (
        len(words), len(base), int(starts.min()) if base else None, int(starts.max()) if base else None,
        ",".join(sorted(base_labels)), ",".join(sorted(weights)), 1 - doubt,
        [{"label": d.label, "start": d.start, "end": d.end, "priority": d.priority} for d in kept],
    )


def _places(text: str, phrase: str) -> Iterator[int]:
    at = text.find(phrase)
    while at >= 0:
        yield at
        at = text.find(phrase, at + 1)


def license_scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with a struct column ``licenses`` (longer if the table has one): words, places of the
    fixed phrases, their labels, the labels of phrases and rules together, a score and the detections
    that stand, by words from 0, end exclusive.

    Score: 0 without a label, else 1 minus the product of what each label leaves open; a label counts
    with its surest detection. A null or empty text has no words and score 0. Rows are judged one by
    one, so ties, repeated rows and null ids need no rule, and an empty table gives no rows; other
    columns, of any name, go through. A text costs time in proportion to its length times the rules
    its keywords admit, and a few times its size in memory.
    """
    small_batches(docs.sparkSession)
    names = [field.split()[0] for field in RESULT.split(", ")]

    @pandas_udf(RESULT)
    def judge(texts: pd.Series) -> pd.DataFrame:
        found = pd.DataFrame([scan(t) for t in texts], columns=names)
        return found.astype({"first_word": "Int64", "last_word": "Int64"})

    return docs.withColumn(fresh(docs, "licenses"), judge(F.col(text)))
