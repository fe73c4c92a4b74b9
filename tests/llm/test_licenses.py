import random
import re
import time

import pytest

from pagegraph.llm import licenses
from tests.llm.conftest import values

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def base_by_hand(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    places = []
    for phrase, label in licenses.BASE_PHRASES.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({label for _, label in places}))


CASES = [
    "Released under the GNU General Public License, version 3 - see there. MIT License; MIT-License!",
    "SPDX-License-Identifier: Apache-2.0\nLicensed under the Apache License, Version 2.0",
    "CC BY 4.0, cc-by cc by; not accby nor cc byx",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "a text about mitten and the license of doubt",
    "émit license, mit licenseé mit  license",
    "GNU Lesser General Public License v2.1",
]


@pytest.fixture(scope="module")
def told(spark):
    cases = spark.createDataFrame(list(enumerate(CASES)), "doc_id long, text string")
    return {r.doc_id: r for r in licenses.scan(cases).collect()}


def test_base_columns_against_brute_force(told, odd, odd_rows):
    for i, text in enumerate(CASES):
        r = told[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base_by_hand(text)
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))
    columns = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert values(licenses.scan(odd), *columns) == sorted(((r[0], *base_by_hand(r[1])) for r in odd_rows), key=repr)


def test_labels_of_rules(told):
    assert "gpl-3.0" in told[0].labels and "apache-2.0" in told[1].labels
    assert told[3].labels == "mit" and told[3].score == 1.0
    assert told[4].labels == "" and told[4].score == 0.0 and told[4].spans == []
    assert told[6].labels == "lgpl-2.1"


def test_gates_never_hide_a_match():
    """A rule finds the same with its keywords as without."""
    scanner = licenses.Scanner()
    samples = [scanner.reduce(c.encode())[0] for c in CASES]
    for label, name, shorts in licenses.NAMES:
        plain = re.sub(r"\(\?:|\)\?|\)|\[|\]|\?", " ", name).replace("|", " ")
        samples.append(" ".join(f"licensed under the {plain} spdx license identifier {shorts.split('|')[0]}".split()).encode())
    for sample in samples:
        gated = {(d.start, d.end, d.rule.name) for d in scanner.found(sample)}
        bare = {(sample.count(b" ", 0, m.start()), r.name) for r, p in zip(scanner.rules, scanner.patterns) for m in p.finditer(sample)}
        assert {(start, name) for start, _, name in gated} == bare


def test_resolution_by_priority_and_containment():
    rule = lambda name, priority: licenses.Rule(name, name, "x", (), priority, 0.5)
    d = licenses.Detection
    high, low = rule("high", 5), rule("low", 1)
    kept = licenses.Scanner.resolve([d(0, 4, high), d(1, 3, low), d(3, 6, low), d(6, 8, low), d(6, 7, low), d(6, 8, high)])
    assert [(k.start, k.end, k.rule.name) for k in kept] == [(0, 4, "high"), (6, 8, "high")]


def test_hundreds_of_rules_empty_and_clashing(none, clashing, odd):
    assert len(licenses.rules()) >= 300
    assert licenses.scan(none).count() == 0
    assert values(licenses.scan(clashing), "doc_id", "n_words") == values(licenses.scan(odd), "doc_id", "n_words")


def by_definition(found):
    """Each detection against all kept ones."""
    kept = []
    for d in sorted(found, key=lambda d: (-d.rule.priority, d.start - d.end, d.start)):
        inside = any(k.start <= d.start and d.end <= k.end for k in kept)
        cut = any(k.start < d.end and d.start < k.end and k.rule.priority > d.rule.priority for k in kept)
        if not inside and not cut:
            kept.append(d)
    return sorted(kept, key=lambda d: (d.start, d.end))


def test_resolution_against_brute_force():
    draw = random.Random(1)
    rules = [licenses.Rule(f"r{i}", f"r{i}", "x", (), i % 4, 0.5) for i in range(8)]
    for _ in range(500):
        found = []
        for _ in range(draw.randrange(25)):
            start = draw.randrange(30)
            found.append(licenses.Detection(start, start + draw.randrange(1, 9), draw.choice(rules)))
        assert licenses.Scanner.resolve(found) == by_definition(found)


def test_labels_against_brute_force(spark):
    """Labels, score and spans of texts mixed from pieces of rules: every rule run without its gate, each pair compared."""
    draw = random.Random(2)
    scanner = licenses.Scanner()
    pieces = [c for c in CASES] + [re.sub(r"\(\?[:=]|\)\??|[\[\]?\\]|\.\{.*?\}", " ", r.pattern).replace("|", " ") for r in scanner.rules]
    texts = [" ".join(draw.choice(pieces) if draw.random() < 0.7 else "plain words here" for _ in range(draw.randrange(12))) for _ in range(60)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in licenses.scan(rows).collect():
        reduced, _ = scanner.reduce(texts[r.doc_id].encode())
        found = []
        for rule, pattern in zip(scanner.rules, scanner.patterns):
            for m in pattern.finditer(reduced):
                start = reduced.count(b" ", 0, m.start())
                found.append(licenses.Detection(start, start + m.group().count(b" ") + 1, rule))
        stays = by_definition(found)
        base = [d for d in found if d.rule.base]
        assert r.labels == ",".join(sorted({d.rule.label for d in (*base, *stays)}))
        assert r.score == max((d.rule.confidence for d in (*base, *stays)), default=0.0)
        assert [(s.start, s.end, s.rule) for s in r.spans] == [(d.start, d.end, d.rule.name) for d in stays]


def test_long_text_of_license_lines():
    """Two megabytes of detections take seconds; four times the text no more than some four times the time."""
    scanner = licenses.Scanner()
    took = {}
    for times in (25_000, 100_000):
        reduced, _ = scanner.reduce(b"the mit license text\n" * times)
        start = time.perf_counter()
        stays = scanner.resolve(list(scanner.found(reduced)))
        took[times] = time.perf_counter() - start
        assert len(stays) == times
    assert took[100_000] < 10 * took[25_000]


def test_every_rule_has_a_gate():
    assert all(r.keywords and all(r.keywords) for r in licenses.rules())
