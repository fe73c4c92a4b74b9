"""License scans by ordered signature rules.

A text is reduced to its words (ASCII letters and digits in lower case and all
non-ASCII characters), one blank between. An Aho-Corasick pass finds which keywords
it has; only the rules whose keywords are all there run their expression. What they
find overlaps, and is resolved in order: a detection goes if a kept one of no lower
priority contains it, or if one of higher priority cuts into it.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from pagegraph.llm.common import Scorer, append_columns, documents, raw_texts

# Lower-case A to Z; digits, letters and bytes from 0x80 stay, all others separate words.
_STAYS = {b: b for b in (*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100))} | {b: b + 32 for b in range(0x41, 0x5B)}
TO_WORDS = bytes(_STAYS.get(b, 0x20) for b in range(256))


@dataclass(frozen=True)
class Rule:
    """``pattern`` matches whole words of the reduced text; all of one of the ``keywords`` must be in it first."""

    name: str
    label: str
    pattern: str
    keywords: tuple[tuple[str, ...], ...]
    priority: int
    confidence: float
    base: bool = False


# Phrases whose every place counts, whatever else is found there.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Label, the license's full name as an expression over words, its short names.
NAMES = (
    ("gpl", r"gnu general public licen[sc]es?", "gpl"),
    ("gpl-1.0", r"gnu general public licen[sc]e (?:as published by the free software foundation )?(?:version|v) ?1(?: 0)?", "gpl 1 0|gplv1"),
    ("gpl-2.0", r"gnu general public licen[sc]e (?:as published by the free software foundation )?(?:either )?(?:version|v) ?2(?: 0)?", "gpl 2 0|gplv2|gpl2"),
    ("gpl-3.0", r"gnu general public licen[sc]e (?:as published by the free software foundation )?(?:either )?(?:version|v) ?3(?: 0)?", "gpl 3 0|gplv3|gpl3"),
    ("lgpl", r"gnu (?:lesser|library) general public licen[sc]e", "lgpl"),
    ("lgpl-2.0", r"gnu library general public licen[sc]e (?:version|v) ?2(?: 0)?", "lgpl 2 0|lgplv2"),
    ("lgpl-2.1", r"gnu lesser general public licen[sc]e (?:version|v) ?2 1", "lgpl 2 1|lgplv2 1"),
    ("lgpl-3.0", r"gnu lesser general public licen[sc]e (?:version|v) ?3(?: 0)?", "lgpl 3 0|lgplv3"),
    ("agpl", r"gnu affero general public licen[sc]e", "agpl"),
    ("agpl-3.0", r"gnu affero general public licen[sc]e (?:version|v) ?3(?: 0)?", "agpl 3 0|agplv3"),
    ("gfdl", r"gnu free documentation licen[sc]e", "gfdl"),
    ("apache", r"apache (?:software )?licen[sc]e", "apache"),
    ("apache-1.0", r"apache (?:software )?licen[sc]e (?:version|v)? ?1 0", "apache 1 0"),
    ("apache-1.1", r"apache (?:software )?licen[sc]e (?:version|v)? ?1 1", "apache 1 1"),
    ("apache-2.0", r"apache (?:software )?licen[sc]e (?:version|v)? ?2(?: 0)?", "apache 2 0|apache2"),
    ("mit", r"(?:the )?(?:mit|expat|x11) licen[sc]e", "mit"),
    ("mit-0", r"mit no attribution(?: licen[sc]e)?", "mit 0"),
    ("bsd", r"(?:berkeley software distribution|bsd)(?: style)? licen[sc]e", "bsd"),
    ("bsd-2-clause", r"(?:simplified|freebsd|two clause|2 clause) bsd licen[sc]e|bsd (?:two|2) clause(?: licen[sc]e)?", "bsd 2 clause"),
    ("bsd-3-clause", r"(?:new|modified|revised|three clause|3 clause) bsd licen[sc]e|bsd (?:three|3) clause(?: licen[sc]e)?", "bsd 3 clause"),
    ("bsd-4-clause", r"(?:original|old|four clause|4 clause) bsd licen[sc]e|bsd (?:four|4) clause(?: licen[sc]e)?", "bsd 4 clause"),
    ("0bsd", r"(?:bsd zero clause|zero clause bsd) licen[sc]e", "0bsd"),
    ("isc", r"isc licen[sc]e", "isc"),
    ("mpl", r"mozilla public licen[sc]e", "mpl"),
    ("mpl-1.1", r"mozilla public licen[sc]e (?:version|v)? ?1 1", "mpl 1 1"),
    ("mpl-2.0", r"mozilla public licen[sc]e (?:version|v)? ?2(?: 0)?", "mpl 2 0"),
    ("epl-1.0", r"eclipse public licen[sc]e (?:version|v)? ?1(?: 0)?", "epl 1 0"),
    ("epl-2.0", r"eclipse public licen[sc]e (?:version|v)? ?2(?: 0)?", "epl 2 0"),
    ("cddl-1.0", r"common development and distribution licen[sc]e", "cddl|cddl 1 0"),
    ("eupl-1.2", r"european union public licen[sc]e", "eupl|eupl 1 2"),
    ("artistic-2.0", r"artistic licen[sc]e(?: (?:version|v)? ?2(?: 0)?)?", "artistic 2 0"),
    ("bsl-1.0", r"boost software licen[sc]e", "bsl 1 0"),
    ("busl-1.1", r"business source licen[sc]e", "busl 1 1"),
    ("zlib", r"zlib(?: libpng)? licen[sc]e", "zlib"),
    ("unlicense", r"the unlicen[sc]e", "unlicense"),
    ("wtfpl", r"do what the fuck you want to public licen[sc]e", "wtfpl"),
    ("python-2.0", r"python software foundation licen[sc]e", "psf|psf 2 0|python 2 0"),
    ("php-3.01", r"php licen[sc]e", "php 3 01"),
    ("ruby", r"ruby licen[sc]e", "ruby"),
    ("ofl-1.1", r"sil open font licen[sc]e", "ofl|ofl 1 1"),
    ("odbl-1.0", r"open (?:data commons open )?database licen[sc]e", "odbl|odbl 1 0"),
    ("postgresql", r"postgresql licen[sc]e", "postgresql"),
    ("openssl", r"openssl licen[sc]e", "openssl"),
    ("ms-pl", r"microsoft public licen[sc]e", "ms pl"),
    ("ms-rl", r"microsoft reciprocal licen[sc]e", "ms rl"),
    ("afl-3.0", r"academic free licen[sc]e", "afl 3 0"),
    ("osl-3.0", r"open software licen[sc]e", "osl 3 0"),
    ("ecl-2.0", r"educational community licen[sc]e", "ecl 2 0"),
    ("ncsa", r"university of illinois ncsa open source licen[sc]e", "ncsa"),
    ("upl-1.0", r"universal permissive licen[sc]e", "upl 1 0"),
    ("vim", r"vim licen[sc]e", "vim"),
    ("cc0", r"cc0(?: 1 0)?(?: universal)?|creative commons zero(?: 1 0)?(?: universal)?", "cc0 1 0"),
    ("cc-by", r"creative commons attribution(?: licen[sc]e)?|cc by", "cc by"),
    ("cc-by-sa", r"creative commons attribution share ?alike|cc by sa", "cc by sa"),
    ("cc-by-nd", r"creative commons attribution no ?deriv(?:ative)?s?(?: works)?|cc by nd", "cc by nd"),
    ("cc-by-nc", r"creative commons attribution non ?commercial|cc by nc", "cc by nc"),
    ("cc-by-nc-sa", r"creative commons attribution non ?commercial share ?alike|cc by nc sa", "cc by nc sa"),
    ("cc-by-nc-nd", r"creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?|cc by nc nd", "cc by nc nd"),
)

# Label, an expression over words that only this license's text or notice has.
SENTENCES = (
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("bsd", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", r"neither the name of .{1,80}? nor the names of its contributors may be used to endorse or promote"),
    ("bsd-4-clause", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("isc", r"permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted"),
    ("gpl", r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public licen[sc]e"),
    ("gpl", r"everyone is permitted to copy and distribute verbatim copies of this licen[sc]e document"),
    ("lgpl", r"this library is free software you can redistribute it and or modify it"),
    ("agpl", r"if your software can interact with users remotely through a computer network"),
    ("apache-2.0", r"you may not use this file except in compliance with the licen[sc]e"),
    ("apache-2.0", r"unless required by applicable law or agreed to in writing software distributed under the licen[sc]e is distributed on an as is basis"),
    ("apache-2.0", r"terms and conditions for use reproduction and distribution"),
    ("mpl-2.0", r"this source code form is subject to the terms of the mozilla public licen[sc]e"),
    ("epl-2.0", r"this program and the accompanying materials are made available under the terms of the eclipse public licen[sc]e"),
    ("bsl-1.0", r"to use reproduce display distribute execute and transmit the software and to prepare derivative works"),
    ("zlib", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("unlicense", r"this is free and unencumbered software released into the public domain"),
    ("public-domain", r"(?:dedicated|released|placed|hereby put) (?:in|into|to) the public domain"),
    ("proprietary", r"all rights reserved (?:unauthori[sz]ed|no part)"),
    ("proprietary", r"confidential and proprietary|proprietary and confidential"),
    ("ofl-1.1", r"this font software is licen[sc]ed under the sil open font licen[sc]e"),
    ("cc-by", r"this work is licen[sc]ed under (?:a|the) creative commons attribution"),
)

# Words of the addresses that licenses are read at.
ADDRESSES = (
    ("gpl", r"(?:www )?gnu org (?:copyleft|licenses) (?:old licenses )?gpl"),
    ("lgpl", r"(?:www )?gnu org (?:copyleft|licenses) (?:old licenses )?lgpl"),
    ("agpl", r"(?:www )?gnu org licenses agpl"),
    ("apache-2.0", r"(?:www )?apache org licenses license 2 0"),
    ("mit", r"(?:www )?opensource org licenses? mit"),
    ("bsd", r"(?:www )?opensource org licenses? bsd"),
    ("mpl-2.0", r"(?:www )?mozilla org mpl 2 0"),
    ("epl-2.0", r"(?:www )?eclipse org legal epl (?:v20|2 0)"),
    ("cc0", r"creativecommons org publicdomain zero"),
    ("cc-by", r"creativecommons org licenses by(?= \d)"),
    ("cc-by-sa", r"creativecommons org licenses by sa"),
    ("cc-by-nc", r"creativecommons org licenses by nc(?= \d)"),
    ("cc-by-nc-sa", r"creativecommons org licenses by nc sa"),
    ("cc-by-nd", r"creativecommons org licenses by nd"),
    ("cc-by-nc-nd", r"creativecommons org licenses by nc nd"),
)


def _alternatives(pattern: str) -> list[str]:
    """The parts of a pattern between bars that stand in no group."""
    parts, depth = [""], 0
    for c in pattern:
        depth += (c == "(") - (c == ")")
        if c == "|" and not depth:
            parts.append("")
        else:
            parts[-1] += c
    return parts


def _keywords(pattern: str) -> tuple[tuple[str, ...], ...]:
    """For each alternative, words that every match has: the long ones outside of groups, or else all."""
    found = []
    for plain in _alternatives(pattern):
        plain = re.sub(r"licen\[sc\]e[sd]?\??", "licen", plain)
        while re.search(r"\([^()]*\)\??", plain):
            plain = re.sub(r"\([^()]*\)\??", " ", plain)
        plain = re.sub(r"\S*[\[\]?*+{}\\]\S*", " ", plain)
        words = tuple(dict.fromkeys(plain.split()))
        found.append(tuple(w for w in words if len(w) >= 4) or words)
    return tuple(found)


def rules() -> tuple[Rule, ...]:
    """All rules: base phrases (which count wherever they stand, so others may cover them), sentences, identifiers, notices, names, addresses, short names."""
    made = [Rule(f"base:{label}", label, phrase, ((phrase,),), 1, 0.9, True) for phrase, label in BASE_PHRASES.items()]
    made += [Rule(f"sentence:{label}:{i}", label, p, _keywords(p), 8, 1.0) for i, (label, p) in enumerate(SENTENCES)]
    for label, name, shorts in NAMES:
        for short in shorts.split("|"):
            ids = rf"spdx license identifier {short}(?: only| or later)?"
            made.append(Rule(f"spdx:{short}", label, ids, (("spdx",),), 7, 1.0))
            made.append(Rule(f"tag:{short}", label, rf"license {short}(?: only| or later)?", (("license",),), 3, 0.6))
        notice = rf"(?:licen[sc]ed|released|distributed|available|published) under (?:a |an |the )?(?:terms of (?:a |an |the )?)?(?:{name})"
        made.append(Rule(f"notice:{label}", label, notice, (("under",),), 6, 0.95))
        made.append(Rule(f"terms:{label}", label, rf"(?:subject to|terms of) (?:the )?(?:{name})", (("subject",), ("terms",)), 5, 0.9))
        made.append(Rule(f"name:{label}", label, name, _keywords(name), 4, 0.8))
    made += [Rule(f"address:{label}:{i}", label, p, _keywords(p), 5, 0.9) for i, (label, p) in enumerate(ADDRESSES)]
    return tuple(made)


class Detection(NamedTuple):
    """Words ``start`` to ``end`` (behind the last) by one rule."""

    start: int
    end: int
    rule: Rule


class Scanner:
    """The compiled rules of a task."""

    def __init__(self, order: tuple[Rule, ...] | None = None):
        self.rules = order or rules()
        self.patterns = [re.compile(rf"(?<![^ ])(?:{r.pattern})(?![^ ])".encode()) for r in self.rules]
        self.gates = [[frozenset(words) for words in r.keywords] for r in self.rules]
        self.automaton = ahocorasick.Automaton()
        for word in {w for r in self.rules for words in r.keywords for w in words}:
            self.automaton.add_word(word, word)
        self.automaton.make_automaton()

    def reduce(self, raw: bytes) -> tuple[bytes, int]:
        """The words of a text with one blank between, and their number."""
        words = raw.translate(TO_WORDS).split()
        return b" ".join(words), len(words)

    def found(self, reduced: bytes) -> Iterator[Detection]:
        """Every match of every rule whose keywords the text has."""
        present = {word for _, word in self.automaton.iter(reduced.decode("latin-1"))}
        if not present:
            return
        blanks = np.flatnonzero(np.frombuffer(reduced, np.uint8) == 0x20)
        for rule, gates, pattern in zip(self.rules, self.gates, self.patterns):
            if any(gate <= present for gate in gates):
                spans = [match.span() for match in pattern.finditer(reduced)]
                # A word's number is that of the blanks before it.
                words = np.searchsorted(blanks, np.array(spans, np.int64).reshape(-1, 2)).tolist()
                yield from (Detection(start, end + 1, rule) for start, end in words)

    @staticmethod
    def resolve(found: list[Detection]) -> list[Detection]:
        """What stays, in the order of the text: by priority, then length, then place and rule order.

        Of what stays none contains another: kept detections in order of their starts are
        in order of their ends too, so the last one that starts in time tells.
        """
        kept, starts = [], []  # all kept so far, by start
        above, above_starts = [], []  # those of a higher priority than the present one
        priority = None
        for d in sorted(found, key=lambda d: (-d.rule.priority, d.start - d.end, d.start)):
            if d.rule.priority != priority:
                above, above_starts = list(kept), list(starts)
                priority = d.rule.priority
            at = bisect_right(starts, d.start)
            if at and kept[at - 1].end >= d.end:
                continue
            cut = bisect_left(above_starts, d.end)
            if cut and above[cut - 1].end > d.start:
                continue
            kept.insert(at, d)
            starts.insert(at, d.start)
        return kept


def scan(rows: DataFrame, text_col: str = "text") -> DataFrame:
    """``rows`` without the text, with the words' number and what the scan found.

    ``n_words``, ``n_base`` (all places of base phrases), ``first_word``, ``last_word``
    (smallest and largest start of those, else null), ``base_labels`` and ``labels``
    (distinct, sorted, joined by comma; empty if none), ``score`` (the largest
    confidence of a detection that stays, else 0), ``spans`` (start, end, label, rule
    of what stays). A null or empty text has no words and no labels. Repeated rows
    count each, other columns stay but those named like a new one. An empty table gives
    an empty one. Of a long text the time grows with its length and its detections.
    """
    spans = T.ArrayType(T.StructType().add("start", "long").add("end", "long").add("label", "string").add("rule", "string"))
    new = T.StructType().add("n_words", "long").add("n_base", "long").add("first_word", "long").add("last_word", "long")
    new = new.add("base_labels", "string").add("labels", "string").add("score", "double").add("spans", spans)

    def scorer() -> Scorer:
        scanner = Scanner()

        def one(raw: bytes) -> tuple:
            reduced, n_words = scanner.reduce(raw)
            found = list(scanner.found(reduced))
            base = [d for d in found if d.rule.base]
            stays = scanner.resolve(found)
            starts = [d.start for d in base]
            base_labels = {d.rule.label for d in base}
            labels = base_labels | {d.rule.label for d in stays}
            score = max((d.rule.confidence for d in [*base, *stays]), default=0.0)
            shown = [{"start": d.start, "end": d.end, "label": d.rule.label, "rule": d.rule.name} for d in stays]
            return n_words, len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted(base_labels)), ",".join(sorted(labels)), score, shown

        def score(column: pa.Array) -> list[list]:
            return [list(values) for values in zip(*map(one, raw_texts(column)))]

        return score

    return append_columns(rows, text_col, new, scorer)


def op5_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir).select("doc_id", "text")).drop("spans")
