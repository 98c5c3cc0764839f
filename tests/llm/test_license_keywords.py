"""Keywords of the license rules."""

from __future__ import annotations

import itertools
from re import _constants as c
from re import _parser

import pytest

from tijara.llm import license_scan


def expanded(pattern) -> list[str]:
    """All texts that a parsed pattern matches, without what its assertions ask for."""
    parts = []
    for op, arg in pattern:
        if op is c.LITERAL:
            parts.append([chr(arg)])
        elif op is c.IN:
            parts.append([chr(x) for kind, a in arg for x in ([a] if kind is c.LITERAL else range(a[0], a[1] + 1))])
        elif op is c.SUBPATTERN:
            parts.append(expanded(arg[-1]))
        elif op is c.BRANCH:
            parts.append([t for branch in arg[1] for t in expanded(branch)])
        elif op is c.MAX_REPEAT:
            assert arg[:2] == (0, 1)
            parts.append(["", *expanded(arg[2])])
        else:
            assert op in (c.ASSERT, c.ASSERT_NOT), op
    return ["".join(p) for p in itertools.product(*parts)]


def test_every_alternative_has_a_keyword():
    for r in license_scan.rules():
        keys = [k.decode() for k in r.keywords]
        missed = [t for t in expanded(_parser.parse(r.pattern.pattern.decode())) if not any(k in t for k in keys)]
        assert not missed, (r.label, keys, missed[:3])


@pytest.mark.parametrize("text, labels", [
    ("Released under the Expat license", "mit"),
    ("licensed under the X11 license", "mit"),
    ("licensed under ASL 2.0", "apache-2"),
    ("licensed under CC Zero", "cc0-1"),
    ("Universal Permissive License", "upl-1"),
])
def test_mentions_without_the_usual_keyword(text, labels):
    assert license_scan.scan(text.encode())[5] == labels


@pytest.mark.parametrize("text, labels", [
    ("released under the GNU General Public License", "gpl"),
    ("licensed under the GPL", "gpl"),
    ("licensed under the GPL v2", "gpl-2"),
    ("GNU General Public License, version 3", "gpl-3"),
    ("released under the GNU Lesser General Public License", "lgpl"),
    ("BSD license", "bsd"),
    ("BSD 3-Clause License", "bsd-3-clause"),
    ("the Apache License", "apache"),
    ("licensed under the Apache License, 2.0", "apache-2"),
    ("CC BY 4.0", "cc-by"),
    ("CC BY-SA 3.0", "cc-by-sa"),
    ("Creative Commons Attribution 4.0 International License", "cc-by"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "cc-by-sa"),
    ("Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License", "cc-by-nc-nd"),
    ("Eclipse Public License - v 2.0", "epl-2"),
    ("under the terms of the Eclipse Public License", "epl"),
    ("Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
     "\"AS IS\" BASIS", "apache"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
     "License as published by the Free Software Foundation, either version 3 of the License", "gpl,gpl-3"),
    ("The origin of this software must not be misrepresented; you must not claim that you wrote the original software.", "zlib"),
    ("the general public likes free software and artistic work, open data and the open software movement", ""),
    ("A driving license for the public, common in Europe", ""),
])
def test_mentions(text, labels):
    assert license_scan.scan(text.encode())[5] == labels


def test_suppression_has_no_regard_to_labels():
    """Of equal priority the longer one stays; one inside it goes, of the same label too; overlapping ones both stay."""
    assert license_scan.scan(b"licensed under the gpl v2")[7] == "gpl-2:0:5"
    assert license_scan.scan(b"licensed under the gpl v2 license")[7] == "gpl-2:0:5,gpl-2:3:6"
    assert license_scan.scan(b"licensed under the gnu general public license")[7] == "gpl:0:7"


def test_prefilter_leaves_few_rules():
    """No keyword is shorter than three letters, and a text that mentions one license reaches few rules."""
    assert min(len(k) for r in license_scan.rules() for k in r.keywords) >= 3
    text = (" the committee of the city may grant a license to open a shop in the european market under the terms of its "
            "charter and every member of the public has the right to see it it is released under the bsd license ")
    reached = [r for r in license_scan.rules() if any(k.decode() in text for k in r.keywords)]
    assert len(license_scan.rules()) > 500 and len(reached) < 70
