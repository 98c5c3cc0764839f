"""License scans: ordered signature rules over the words of each text.

Every text is lower-cased (A-Z) and reduced to its words; rules are regular expressions over those
words, so punctuation and line breaks never hide a license. A rule runs only where its keyword
occurs (prefilter). Detections that lie inside the interval of a detection of higher priority, or
of equal priority and greater length, are suppressed, whichever license they name; so a license without its
version gives way to the mention with it. Base rules (three fixed phrases) have the highest priority and are never
suppressed.

All of it is one map over whole texts: no shuffle, and a task holds a few MB of text at a time.

Defined results: null or empty text: no words, zero places, null word positions, empty label
strings, score 0. Repeated rows give repeated results; an empty table gives an empty one.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tijara.llm.common import read_documents, slices, texts_of, utf8

# fixed values: the base phrases and their labels
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# a word is a run of digits, letters and bytes over 127 (every byte of a non-ASCII character)
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32
                   for c in range(256))

# what may stand between a public license's name and the word license
PORT = "(?: [1-4] [05])?(?: international| unported| generic)?"
# license families: label, its full name in words, its short names, keywords of which any mention has one.
# `{v}` stands for the versions, given after the keyword, `{port}` for PORT.
FAMILIES = [
    ("mit", "mit", "mit|x11|expat", "mit|x11|expat", ""),
    ("mit-0", "mit no attribution", "mit 0|mit zero", "mit", ""),
    ("apache-{v}", "apache(?: software)?", "apache(?: license)? {v}(?: 0)?|asl {v}", "apache|asl", "1 2"),
    ("gpl-{v}", "gnu general public", "(?:gnu )?gpl ?v?{v}(?: 0)?|gplv{v}", "gnu|gpl", "1 2 3"),
    ("lgpl-{v}", "gnu (?:lesser|library) general public", "(?:gnu )?lgpl ?v?{v}(?: [01])?|lgplv{v}", "gnu|lgpl", "2 3"),
    ("agpl-{v}", "gnu affero general public", "(?:gnu )?agpl ?v?{v}(?: 0)?|agplv{v}", "gnu|agpl", "1 3"),
    ("gfdl-{v}", "gnu free documentation", "gfdl ?v?{v}(?: [0-3])?", "gnu|gfdl", "1"),
    ("mpl-{v}", "mozilla public", "mpl ?v?{v}(?: [01])?", "mozilla|mpl", "1 2"),
    ("epl-{v}", "eclipse public", "epl ?v?{v}(?: 0)?", "eclipse|epl", "1 2"),
    ("eupl-{v}", "european union public", "eupl ?v?{v}(?: [0-2])?", "european|eupl", "1"),
    ("cddl-{v}", "common development and distribution", "cddl ?v?{v}(?: [01])?", "common development|cddl", "1"),
    ("cpl-{v}", "common public", "cpl {v} 0", "common public|cpl", "1"),
    ("ipl-{v}", "ibm public", "ipl {v} 0", "ibm|ipl", "1"),
    ("artistic-{v}", "artistic", "artistic ?{v}(?: 0)?", "artistic", "1 2"),
    ("afl-{v}", "academic free", "afl {v}(?: [01])?", "academic|afl", "1 2 3"),
    ("osl-{v}", "open software", "osl {v}(?: [01])?", "open software|osl", "1 2 3"),
    ("cecill-{v}", "cecill(?: free software)?", "cecill {v}(?: [01])?", "cecill", "1 2"),
    ("bsd-2-clause", "(?:bsd 2 clause|simplified bsd|freebsd)", "bsd 2(?: clause)?", "bsd", ""),
    ("bsd-3-clause", "(?:bsd 3 clause|new bsd|modified bsd|revised bsd)", "bsd 3(?: clause)?", "bsd", ""),
    ("bsd-4-clause", "(?:bsd 4 clause|original bsd)", "bsd 4(?: clause)?", "bsd", ""),
    ("0bsd", "zero clause bsd", "0bsd", "bsd", ""),
    ("isc", "isc", "isc", "isc", ""),
    ("zlib", "zlib(?: libpng)?", "zlib", "zlib", ""),
    ("libpng", "libpng", "libpng", "libpng", ""),
    ("bsl-1", "boost software", "bsl 1 0", "boost|bsl", ""),
    ("busl-1", "business source", "busl 1 1", "business|busl", ""),
    ("unlicense", "unlicense", "unlicense|the unlicense", "unlicense", ""),
    ("wtfpl", "do what the fuck you want to public", "wtfpl", "do what|wtfpl", ""),
    ("ofl-1", "sil open font", "ofl 1 [01]", "open font|ofl", ""),
    ("psf-2", "python software foundation", "psf 2(?: 0)?", "python|psf", ""),
    ("ruby", "ruby", "ruby", "ruby", ""),
    ("php-3", "php", "php 3(?: 01)?", "php", ""),
    ("openssl", "openssl", "openssl", "openssl", ""),
    ("ncsa", "university of illinois ncsa open source", "ncsa", "ncsa", ""),
    ("postgresql", "postgresql", "postgresql", "postgresql", ""),
    ("upl-1", "universal permissive", "upl 1 0", "upl|universal", ""),
    ("ms-pl", "microsoft public", "ms pl", "microsoft|ms pl", ""),
    ("ms-rl", "microsoft reciprocal", "ms rl", "microsoft|ms rl", ""),
    ("sspl-1", "server side public", "sspl(?: 1)?", "server side|sspl", ""),
    ("elastic-{v}", "elastic", "elastic {v}(?: 0)?", "elastic", "1 2"),
    ("mulan-psl-{v}", "mulan permissive software", "mulanpsl {v} 0|mulan psl v{v}", "mulan", "1 2"),
    ("odbl-1", "open database", "odbl(?: 1 0)?", "open database|odbl", ""),
    ("odc-by-1", "open data commons attribution", "odc by(?: 1 0)?", "open data|odc by", ""),
    ("pddl-1", "public domain dedication and", "pddl(?: 1 0)?", "domain dedication|pddl", ""),
    ("cc0-1", "(?:cc0|creative commons zero)", "cc0(?: 1 0)?|cc zero", "cc0|cc zero|creative commons zero", ""),
    ("cc-by", "creative commons attribution{port}", "cc by(?! nc| sa| nd)", "cc by|creative commons", ""),
    ("cc-by-sa", "creative commons attribution share ?alike{port}", "cc by sa", "cc by|creative commons", ""),
    ("cc-by-nd", "creative commons attribution no ?deriv(?:s|atives){port}", "cc by nd", "cc by|creative commons", ""),
    ("cc-by-nc", "creative commons attribution non ?commercial{port}", "cc by nc(?! sa| nd)", "cc by|creative commons", ""),
    ("cc-by-nc-sa", "creative commons attribution non ?commercial share ?alike{port}", "cc by nc sa", "cc by|creative commons", ""),
    ("cc-by-nc-nd", "creative commons attribution non ?commercial no ?deriv(?:s|atives){port}", "cc by nc nd",
     "cc by|creative commons", ""),
    # mentions without a version; the forms with one are longer and win
    ("apache", "apache(?: software)?", "apache", "apache", ""),
    ("gpl", "(?:gnu )?general public", "(?:gnu )?gpl|gnu public", "gnu|gpl|general public", ""),
    ("lgpl", "(?:gnu )?(?:lesser|library) general public", "(?:gnu )?lgpl", "general public|lgpl", ""),
    ("agpl", "(?:gnu )?affero general public", "(?:gnu )?agpl", "general public|agpl", ""),
    ("gfdl", "(?:gnu )?free documentation", "(?:gnu )?gfdl", "free documentation|gfdl", ""),
    ("mpl", "mozilla public", "mpl", "mozilla|mpl", ""),
    ("epl", "eclipse public", "epl", "eclipse|epl", ""),
    ("eupl", "european union public", "eupl", "european|eupl", ""),
    ("cddl", "common development and distribution", "cddl", "common development|cddl", ""),
    ("bsd", "bsd(?: style)?", "bsd", "bsd", ""),
]
# how a license is mentioned: priority, confidence, form. {n}: full name, {s}: short names, {v}: version
FORMS = [
    (80, 0.99, "spdx license identifier (?:{s})"),
    (70, 0.95, "(?:licensed|released|distributed|available|published|redistributed) under (?:the )?(?:terms of )?"
               "(?:the |an? )?{n} licen[sc]e{w}"),
    (70, 0.95, "(?:licensed|released|distributed|available|published|redistributed) under (?:the )?(?:terms of )?"
               "(?:the |an? )?(?:{s})"),
    (60, 0.9, "(?:terms|conditions|version|copy) of the {n} licen[sc]e{w}"),
    (50, 0.9, "(?:licen[sc]e|licenses) (?:is |are )?(?:{s})"),
    (40, 0.8, "{n} licen[sc]e{w}"),
    (30, 0.6, "(?:{s}) licen[sc]e[ds]?"),
]
# signatures of license texts and notices that name no family: label, keyword, words
TEXTS = [
    ("mit", "permission", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("isc", "permission", "permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("zlib", "provided", "this software is provided as is without any express or implied warranty in no event will the authors"),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("gpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("apache-2", "apache", "licensed under the apache license version 2 0 the license you may not use this file except in "
                           "compliance with the license"),
    ("apache", "applicable", "unless required by applicable law or agreed to in writing software distributed under the license "
                             "is distributed on an as is basis"),
    ("mit", "notice", "the above copyright notice and this permission notice shall be included in all copies or substantial "
                      "portions of the software"),
    ("gpl", "free software", "this (?:program|library|software|file) is free software you can redistribute it and or modify it"),
    ("gpl-2", "version 2", "gnu general public license as published by the free software foundation either version 2 of the license"),
    ("gpl-3", "version 3", "gnu general public license as published by the free software foundation either version 3 of the license"),
    ("lgpl-2", "version 2", "gnu (?:lesser|library) general public license as published by the free software foundation either "
                            "version 2(?: 1)? of the license"),
    ("lgpl-3", "version 3", "gnu lesser general public license as published by the free software foundation either version 3 "
                            "of the license"),
    ("agpl-3", "affero", "gnu affero general public license as published by the free software foundation either version 3 "
                         "of the license"),
    ("gpl", "verbatim", "everyone is permitted to copy and distribute verbatim copies of this license document but changing it "
                        "is not allowed"),
    ("wtfpl", "verbatim", "everyone is permitted to copy and distribute verbatim or modified copies of this license document"),
    ("mpl-2", "mozilla", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-1", "mozilla", "the contents of this file are subject to the mozilla public license version 1(?: 1)?"),
    ("epl", "eclipse", "this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("cddl-1", "common development", "the contents of this file are subject to the terms of the common development and distribution "
                                     "license"),
    ("bsd-3-clause", "endorse", "neither the name of (?:the )?(?:copyright holder|author|university|organization) nor the names of "
                                "(?:its|any) contributors may be used to endorse or promote products"),
    ("bsd-4-clause", "advertising", "all advertising materials mentioning features or use of this software must display the following "
                                    "acknowledge?ment"),
    ("bsl-1", "organization", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software"),
    ("zlib", "misrepresented", "the origin of this software must not be misrepresented you must not claim that you wrote the "
                               "original software"),
    ("ofl-1", "font", "this font software is licensed under the sil open font license"),
    ("artistic-1", "artistic", "under the (?:same )?terms (?:of either|as perl itself either) the gnu general public license or the "
                               "artistic license"),
    ("unlicense", "anyone is free", "anyone is free to copy modify publish use compile sell or distribute this software"),
    ("cc0-1", "waived", "to the extent possible under law the (?:author|person who associated cc0 with this work) has waived all "
                        "copyright and related or neighboring rights"),
    ("cc-by", "cc by", "cc by [1-4] [05]"),
    ("cc-by-sa", "cc by", "cc by sa [1-4] [05]"),
    ("cc-by-nd", "cc by", "cc by nd [1-4] [05]"),
    ("cc-by-nc", "cc by", "cc by nc [1-4] [05]"),
    ("cc-by-nc-sa", "cc by", "cc by nc sa(?: [1-4] [05])?"),
    ("cc-by-nc-nd", "cc by", "cc by nc nd(?: [1-4] [05])?"),
    ("cc0-1", "cc0", "cc0(?: 1 0)?"),
    ("public-domain", "copyright", "no known copyright restrictions"),
    ("proprietary", "reproduced", "no part of this (?:publication|book|document|work) may be reproduced"),
    ("public-domain", "domain", "(?:released|placed|dedicated) (?:in|into|to) the public domain"),
    ("public-domain", "domain", "(?:is|are) (?:in )?(?:the )?public domain"),
    ("proprietary", "rights", "all rights reserved"),
    ("proprietary", "proprietary", "(?:confidential and proprietary|proprietary and confidential)"),
    ("proprietary", "permission", "(?:without|no) (?:the )?(?:prior )?(?:express )?(?:written )?permission"),
]


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    confidence: float
    keywords: tuple[bytes, ...]
    pattern: re.Pattern


def _rule(label: str, priority: int, confidence: float, keyword: str, words: str) -> Rule:
    """A rule over words between single spaces; it begins and ends at whole words."""
    return Rule(label, priority, confidence, tuple(k.encode() for k in keyword.split("|")),
                re.compile(rf"(?<= )(?:{words})(?= )".encode()))


@cache
def rules() -> tuple[Rule, ...]:
    """All signature rules, highest priority first."""
    out = [_rule(label, 100, 1.0, words, words) for words, label in BASE.items()]
    for label, name, short, keyword, versions in FAMILIES:
        for v in versions.split() or [""]:
            w = f" (?:version |v ?)?{v}(?: [0-9])?" if v else ""
            for priority, confidence, form in FORMS:
                out.append(_rule(label.replace("{v}", v), priority, confidence, keyword,
                                 form.format(n=name.replace("{port}", PORT), s=short.replace("{v}", v), v=v, w=w)))
    out += [_rule(label, 90 if len(words) > 60 else 20, 0.9 if len(words) > 60 else 0.5, keyword, words)
            for label, keyword, words in TEXTS]
    return tuple(sorted(out, key=lambda r: -r.priority))


@cache
def _keywords() -> frozenset[bytes]:
    return frozenset(k for r in rules() for k in r.keywords)


# a text that holds none of these can match no rule
GATE = tuple(k.encode() for k in (
    "licen", "released under", "distributed under", "available under", "published under", "public domain",
    "permission", "rights reserved", "proprietary", "redistribution and use", "unencumbered", "provided as is", "cc by", "cc0",
    "applicable law", "is free software", "advertising materials", "endorse or promote", "misrepresented", "anyone is free to copy",
    "neighboring rights", "copyright restrictions", "may be reproduced", "artistic", "general public", *BASE))


def detections(line: bytes) -> list[tuple[int, int, Rule]]:
    """(start, end, rule) of the detections that remain; ``line``: words, each after a space, and a last space."""
    if not any(k in line for k in GATE):
        return []
    present = {k for k in _keywords() if k in line}
    found = []
    for rule in rules():
        if not present.isdisjoint(rule.keywords):
            found += [(m.start(), m.end(), rule) for m in rule.pattern.finditer(line)]
    found.sort(key=lambda d: (-d[2].priority, d[0] - d[1], d[0], d[2].label))
    return _uncontained(found)


def _uncontained(found: list[tuple[int, int, Rule]]) -> list[tuple[int, int, Rule]]:
    """Drops detections inside a stronger one of another label. ``found``: strongest first.

    Stronger intervals are kept sorted by start with the largest end so far, so a text with very
    many detections costs n log n, not n squared.
    """
    kept: list[tuple[int, int, Rule]] = []
    starts: list[int] = []
    ends: list[int] = []  # of intervals none of which contains another, both lists ascending
    for start, end, rule in found:
        i = bisect.bisect_right(starts, start) - 1
        if i >= 0 and ends[i] >= end and rule.priority < 100:
            continue
        kept.append((start, end, rule))
        if i >= 0 and ends[i] >= end:
            continue
        j = bisect.bisect_left(starts, start)
        while j < len(starts) and ends[j] <= end:
            del starts[j], ends[j]
        starts.insert(j, start)
        ends.insert(j, end)
    return kept


def scan(text: bytes) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score, detections of one text."""
    words = text.translate(WORD_BYTES).split()
    line = b" " + b" ".join(words) + b" "
    found = detections(line)
    base = [d for d in found if d[2].priority == 100]
    at = {start: line.count(b" ", 0, start) - 1 for start, _, _ in found}
    places = sorted(at[d[0]] for d in base)
    missed = 1.0
    for label in {d[2].label for d in found}:
        missed *= 1 - max(d[2].confidence for d in found if d[2].label == label)
    spans = ",".join(f"{r.label}:{at[s]}:{at[s] + line.count(b' ', s, e) + 1}" for s, e, r in sorted(found, key=lambda d: d[:2]))
    return (len(words), len(base), places[0] if places else None, places[-1] if places else None,
            ",".join(sorted({d[2].label for d in base})), ",".join(sorted({d[2].label for d in found})),
            round(1 - missed, 6), spans)


SCHEMA = ("doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
          "labels string, score double, detections string")


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in SCHEMA.split(", ")[1:]]
    types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.string()]
    for batch in slices(batches):
        rows = [scan(t) for t in utf8(batch)]
        cols = zip(*rows, strict=True) if rows else [[] for _ in names]
        yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id")} | {
            n: pa.array(c, t) for n, c, t in zip(names, cols, types, strict=True)})


def license_scan(docs: DataFrame) -> DataFrame:
    """One row per document: word count, base places, labels, score (0 to 1) and the remaining
    detections as ``label:first word:end word``."""
    return texts_of(docs).mapInArrow(_scan_batches, SCHEMA)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(read_documents(spark, sf_dir))
