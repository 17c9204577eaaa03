"""License detection by ordered signature rules.

A rule is a regex over the words of a text, a keyword without which it cannot match, a label, a priority and a
confidence. One automaton finds the keywords of all rules; only their rules run. Of overlapping detections, one that
lies within another of at least its priority is suppressed.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyriver.llm.text import byte_texts, renamed

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")

# The phrases that always give a label, by their words.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}


class Rule(NamedTuple):
    label: str
    pattern: str
    keyword: str
    priority: int
    confidence: float


# Rules as (label, pattern over words, keyword, priority). ``{v}`` runs over the versions of the family.
VERSIONED = {
    ("gpl", ("1.0", "2.0", "3.0")): [
        ("{f}-{v}-or-later", r"gnu general public license version {w} or(?: at your option)? any later version", "gnu", 9),
        ("{f}-{v}-or-later", r"either version {w} of the(?: gnu general public)? license or at your option any later version", "later", 8),
        ("{f}-{v}-only", r"gnu general public license version {w} only", "gnu", 9),
        ("{f}-{v}-only", r"(?:terms|version {w}) of the gnu general public license version {w} as published", "gnu", 8),
        ("{f}-{v}", r"gnu general public license(?: as published by the free software foundation)?(?: either)?(?: the)? v(?:ersion)? ?{w}", "gnu", 7),
        ("{f}-{v}", r"gnu gpl v(?:ersion)? ?{w}", "gpl", 6),
        ("{f}-{v}", r"gpl ?v?(?:ersion )?{w}(?: only| or later)?", "gpl", 5),
        ("{f}-{v}-or-later", r"spdx license identifier gpl {w} or later", "spdx", 10),
        ("{f}-{v}-only", r"spdx license identifier gpl {w}(?: only)?", "spdx", 10),
        ("{f}-{v}", r"www gnu org licenses(?: old licenses)? gpl {w}(?: (?:html|txt))?", "gnu", 6),
    ],
    ("lgpl", ("2.0", "2.1", "3.0")): [
        ("{f}-{v}-or-later", r"gnu (?:lesser|library) general public license version {w} or(?: at your option)? any later version", "gnu", 9),
        ("{f}-{v}", r"gnu (?:lesser|library) general public license(?: as published by the free software foundation)?(?: either)? v(?:ersion)? ?{w}", "gnu", 8),
        ("{f}-{v}", r"gnu lgpl v(?:ersion)? ?{w}", "lgpl", 6),
        ("{f}-{v}", r"lgpl ?v?(?:ersion )?{w}(?: only| or later)?", "lgpl", 5),
        ("{f}-{v}-or-later", r"spdx license identifier lgpl {w} or later", "spdx", 10),
        ("{f}-{v}-only", r"spdx license identifier lgpl {w}(?: only)?", "spdx", 10),
        ("{f}-{v}", r"www gnu org licenses(?: old licenses)? lgpl {w}(?: (?:html|txt))?", "gnu", 6),
    ],
    ("agpl", ("1.0", "3.0")): [
        ("{f}-{v}-or-later", r"gnu affero general public license version {w} or(?: at your option)? any later version", "affero", 9),
        ("{f}-{v}", r"affero general public license(?: as published by the free software foundation)?(?: either)? v(?:ersion)? ?{w}", "affero", 8),
        ("{f}-{v}", r"agpl ?v?(?:ersion )?{w}(?: only| or later)?", "agpl", 5),
        ("{f}-{v}-or-later", r"spdx license identifier agpl {w} or later", "spdx", 10),
        ("{f}-{v}-only", r"spdx license identifier agpl {w}(?: only)?", "spdx", 10),
    ],
    ("gfdl", ("1.1", "1.2", "1.3")): [
        ("{f}-{v}", r"gnu free documentation license version {w}", "gnu", 8),
        ("{f}-{v}", r"gfdl(?: v(?:ersion)?)? ?{w}", "gfdl", 5),
        ("{f}-{v}", r"spdx license identifier gfdl {w}(?: only| or later)?", "spdx", 10),
    ],
    ("apache", ("1.0", "1.1", "2.0")): [
        ("{f}-{v}", r"licensed under the apache license version {w}", "apache", 9),
        ("{f}-{v}", r"apache(?: software)? license v(?:ersion)? ?{w}", "apache", 8),
        ("{f}-{v}", r"apache license {w}", "apache", 7),
        ("{f}-{v}", r"apache {w} license", "apache", 7),
        ("{f}-{v}", r"spdx license identifier apache {w}", "spdx", 10),
        ("{f}-{v}", r"www apache org licenses license {w}", "apache", 8),
        ("{f}-{v}", r"asl ?v?{w}", "asl", 4),
    ],
    ("mpl", ("1.0", "1.1", "2.0")): [
        ("{f}-{v}", r"mozilla public license(?: v(?:ersion)?)? ?{w}", "mozilla", 8),
        ("{f}-{v}", r"subject to the terms of the mozilla public license v ?{w}", "mozilla", 9),
        ("{f}-{v}", r"mpl ?v?(?:ersion )?{w}", "mpl", 5),
        ("{f}-{v}", r"spdx license identifier mpl {w}", "spdx", 10),
        ("{f}-{v}", r"mozilla org mpl {w}", "mozilla", 7),
    ],
    ("epl", ("1.0", "2.0")): [
        ("{f}-{v}", r"eclipse public license(?: v(?:ersion)?)? ?{w}", "eclipse", 8),
        ("{f}-{v}", r"epl ?v?(?:ersion )?{w}", "epl", 5),
        ("{f}-{v}", r"spdx license identifier epl {w}", "spdx", 10),
        ("{f}-{v}", r"www eclipse org legal epl (?:v{w}|{w})", "eclipse", 7),
    ],
    ("eupl", ("1.0", "1.1", "1.2")): [
        ("{f}-{v}", r"european union public licen[cs]e(?: v(?:ersion)?)? ?{w}", "european", 8),
        ("{f}-{v}", r"eupl(?: v(?:ersion)?)? ?{w}", "eupl", 5),
        ("{f}-{v}", r"spdx license identifier eupl {w}", "spdx", 10),
    ],
    ("cddl", ("1.0", "1.1")): [
        ("{f}-{v}", r"common development and distribution license(?: cddl)?(?: v(?:ersion)?)? ?{w}", "distribution", 8),
        ("{f}-{v}", r"cddl(?: v(?:ersion)?)? ?{w}", "cddl", 5),
        ("{f}-{v}", r"spdx license identifier cddl {w}", "spdx", 10),
    ],
    ("artistic", ("1.0", "2.0")): [
        ("{f}-{v}", r"artistic license(?: v(?:ersion)?)? ?{w}", "artistic", 8),
        ("{f}-{v}", r"spdx license identifier artistic {w}", "spdx", 10),
    ],
    ("bsl", ("1.0",)): [
        ("{f}-{v}", r"boost software license(?: v(?:ersion)?)? ?{w}", "boost", 8),
        ("{f}-{v}", r"spdx license identifier bsl {w}", "spdx", 10),
        ("{f}-{v}", r"www boost org license {w}(?: txt)?", "boost", 7),
    ],
    ("busl", ("1.0", "1.1")): [
        ("{f}-{v}", r"business source license(?: v(?:ersion)?)? ?{w}", "business", 8),
        ("{f}-{v}", r"spdx license identifier busl {w}", "spdx", 10),
    ],
    ("osl", ("1.0", "2.0", "2.1", "3.0")): [
        ("{f}-{v}", r"open software license(?: osl)?(?: v(?:ersion)?)? ?{w}", "software", 8),
        ("{f}-{v}", r"spdx license identifier osl {w}", "spdx", 10),
    ],
    ("afl", ("1.1", "2.0", "2.1", "3.0")): [
        ("{f}-{v}", r"academic free license(?: v(?:ersion)?)? ?{w}", "academic", 8),
        ("{f}-{v}", r"spdx license identifier afl {w}", "spdx", 10),
    ],
    ("cecill", ("1.0", "2.0", "2.1")): [
        ("{f}-{v}", r"cecill(?: free software license agreement)?(?: v(?:ersion)?)? ?{w}", "cecill", 7),
        ("{f}-{v}", r"spdx license identifier cecill {w}", "spdx", 10),
    ],
    ("php", ("3.0", "3.01")): [
        ("{f}-{v}", r"(?:the )?php license(?: v(?:ersion)?)? ?{w}", "php", 8),
        ("{f}-{v}", r"spdx license identifier php {w}", "spdx", 10),
    ],
    ("ofl", ("1.0", "1.1")): [
        ("{f}-{v}", r"sil open font license(?: v(?:ersion)?)? ?{w}", "font", 8),
        ("{f}-{v}", r"spdx license identifier ofl {w}", "spdx", 10),
    ],
    ("odbl", ("1.0",)): [
        ("{f}-{v}", r"open database license(?: v(?:ersion)?)? ?{w}", "database", 8),
        ("{f}-{v}", r"spdx license identifier odbl {w}", "spdx", 10),
    ],
    ("cc-by", ("1.0", "2.0", "2.5", "3.0", "4.0")): [
        ("cc-by-nc-nd-{v}", r"cc by nc nd {w}", "cc", 9),
        ("cc-by-nc-sa-{v}", r"cc by nc sa {w}", "cc", 9),
        ("cc-by-nc-{v}", r"cc by nc {w}", "cc", 8),
        ("cc-by-nd-{v}", r"cc by nd {w}", "cc", 8),
        ("cc-by-sa-{v}", r"cc by sa {w}", "cc", 8),
        ("cc-by-{v}", r"cc by {w}", "cc", 8),
        ("cc-by-nc-nd-{v}", r"creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)? {w}", "commons", 9),
        ("cc-by-nc-sa-{v}", r"creative commons attribution non ?commercial share ?alike {w}", "commons", 9),
        ("cc-by-nc-{v}", r"creative commons attribution non ?commercial {w}", "commons", 8),
        ("cc-by-nd-{v}", r"creative commons attribution no ?deriv(?:ative)?s?(?: works)? {w}", "commons", 8),
        ("cc-by-sa-{v}", r"creative commons attribution share ?alike {w}", "commons", 8),
        ("cc-by-{v}", r"creative commons attribution {w}", "commons", 8),
        ("cc-by-nc-sa-{v}", r"creativecommons org licenses by nc sa {w}", "creativecommons", 9),
        ("cc-by-nc-nd-{v}", r"creativecommons org licenses by nc nd {w}", "creativecommons", 9),
        ("cc-by-nc-{v}", r"creativecommons org licenses by nc {w}", "creativecommons", 8),
        ("cc-by-sa-{v}", r"creativecommons org licenses by sa {w}", "creativecommons", 8),
        ("cc-by-nd-{v}", r"creativecommons org licenses by nd {w}", "creativecommons", 8),
        ("cc-by-{v}", r"creativecommons org licenses by {w}", "creativecommons", 8),
    ],
}

# Rules of licenses without versions.
PLAIN = [
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "hereby", 9),
    ("mit", r"(?:released|licensed|distributed|available) under the(?: terms of the)? mit license", "mit", 8),
    ("mit", r"the mit license(?: mit)?", "mit", 6),
    ("mit", r"spdx license identifier mit", "spdx", 10),
    ("mit", r"mit license", "mit", 3),
    ("mit-0", r"mit no attribution", "mit", 8),
    ("x11", r"x11 license", "x11", 7),
    ("isc", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "hereby", 9),
    ("isc", r"isc license", "isc", 7),
    ("isc", r"spdx license identifier isc", "spdx", 10),
    ("bsd-2-clause", r"(?:simplified|freebsd|2 clause|two clause) bsd license", "bsd", 8),
    ("bsd-2-clause", r"bsd 2 clause(?: license)?", "bsd", 7),
    ("bsd-3-clause", r"(?:new|modified|revised|3 clause|three clause) bsd license", "bsd", 8),
    ("bsd-3-clause", r"bsd 3 clause(?: license)?", "bsd", 7),
    ("bsd-4-clause", r"(?:original|old|4 clause|four clause) bsd license", "bsd", 8),
    ("bsd-4-clause", r"bsd 4 clause(?: license)?", "bsd", 7),
    ("bsd", r"redistribution and use in source and binary forms with or without modification are permitted", "redistribution", 8),
    ("bsd", r"bsd style license", "bsd", 6),
    ("bsd", r"bsd licensed?", "bsd", 4),
    ("unlicense", r"free and unencumbered software released into the public domain", "unencumbered", 9),
    ("unlicense", r"(?:the|under the) unlicense", "unlicense", 7),
    ("cc0-1.0", r"cc0(?: 1 0)?(?: universal)?", "cc0", 7),
    ("cc0-1.0", r"creativecommons org publicdomain zero 1 0", "creativecommons", 8),
    ("public-domain", r"(?:placed|released|dedicated) (?:in|into|to) the public domain", "domain", 7),
    ("wtfpl", r"do what the fuck you want to public license", "public", 9),
    ("wtfpl", r"wtfpl", "wtfpl", 6),
    ("zlib", r"zlib license", "zlib", 7),
    ("zlib", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable", "warranty", 8),
    ("beerware", r"the beer ?ware license", "license", 8),
    ("postgresql", r"postgresql licen[cs]e", "postgresql", 7),
    ("python-2.0", r"python software foundation license(?: version 2)?", "python", 8),
    ("openssl", r"openssl license", "openssl", 7),
    ("ms-pl", r"microsoft public license(?: ms pl)?", "microsoft", 8),
    ("ms-rl", r"microsoft reciprocal license(?: ms rl)?", "microsoft", 8),
    ("ncsa", r"university of illinois ncsa open source license", "ncsa", 8),
    ("json", r"the software shall be used for good not evil", "evil", 9),
    ("gpl", r"gnu general public license", "gnu", 3),
    ("gpl", r"gnu gpl", "gpl", 3),
    ("lgpl", r"gnu (?:lesser|library) general public license", "gnu", 4),
    ("agpl", r"affero general public license", "affero", 4),
    ("gfdl", r"gnu free documentation license", "gnu", 4),
    ("apache", r"apache(?: software)? license", "apache", 3),
    ("mpl", r"mozilla public license", "mozilla", 3),
    ("epl", r"eclipse public license", "eclipse", 3),
    ("cddl", r"common development and distribution license", "distribution", 3),
    ("cc-by-nc-nd", r"cc by nc nd", "cc", 5),
    ("cc-by-nc-sa", r"cc by nc sa", "cc", 5),
    ("cc-by-nc", r"cc by nc", "cc", 4),
    ("cc-by-nd", r"cc by nd", "cc", 4),
    ("cc-by-sa", r"cc by sa", "cc", 4),
    ("cc-by", r"cc by", "cc", 3),
    ("cc-by", r"creative commons attribution", "commons", 3),
    ("cc", r"creative commons license", "commons", 2),
    ("cc-by-nc-sa", r"creativecommons org licenses by nc sa", "creativecommons", 7),
    ("cc-by-nc-nd", r"creativecommons org licenses by nc nd", "creativecommons", 7),
    ("cc-by-nc", r"creativecommons org licenses by nc", "creativecommons", 6),
    ("cc-by-sa", r"creativecommons org licenses by sa", "creativecommons", 6),
    ("cc-by-nd", r"creativecommons org licenses by nd", "creativecommons", 6),
    ("cc-by", r"creativecommons org licenses by", "creativecommons", 5),
    ("cc0-1.0", r"spdx license identifier cc0 1 0", "spdx", 10),
    ("bsd-2-clause", r"spdx license identifier bsd 2 clause", "spdx", 10),
    ("bsd-3-clause", r"spdx license identifier bsd 3 clause", "spdx", 10),
    ("bsd-4-clause", r"spdx license identifier bsd 4 clause", "spdx", 10),
    ("bsd-3-clause-clear", r"spdx license identifier bsd 3 clause clear", "spdx", 11),
    ("bsd-2-clause-patent", r"spdx license identifier bsd 2 clause patent", "spdx", 11),
    ("0bsd", r"spdx license identifier 0bsd", "spdx", 10),
    ("0bsd", r"(?:zero clause|0 clause) bsd(?: license)?", "bsd", 8),
    ("bsd", r"neither the name of (?:the )?(?:[^ ]+ ){1,8}nor the names of its contributors may be used to endorse or promote", "endorse", 8),
    ("zlib", r"spdx license identifier zlib", "spdx", 10),
    ("zlib", r"the origin of this software must not be misrepresented", "misrepresented", 8),
    ("unlicense", r"spdx license identifier unlicense", "spdx", 10),
    ("unlicense", r"unlicense org", "unlicense", 6),
    ("postgresql", r"spdx license identifier postgresql", "spdx", 10),
    ("wtfpl", r"spdx license identifier wtfpl", "spdx", 10),
    ("x11", r"spdx license identifier x11", "spdx", 10),
    ("mit-0", r"spdx license identifier mit 0", "spdx", 11),
    ("ncsa", r"spdx license identifier ncsa", "spdx", 10),
    ("openssl", r"spdx license identifier openssl", "spdx", 10),
    ("python-2.0", r"spdx license identifier (?:python 2 0|psf 2 0)", "spdx", 10),
    ("ms-pl", r"spdx license identifier ms pl", "spdx", 10),
    ("ms-rl", r"spdx license identifier ms rl", "spdx", 10),
    ("bsl", r"boost software license", "boost", 3),
    ("busl", r"business source license", "business", 3),
    ("busl", r"the change date the change license", "change", 5),
    ("sspl-1.0", r"server side public license(?: v(?:ersion)? ?1)?", "server", 8),
    ("sspl-1.0", r"spdx license identifier sspl 1 0", "spdx", 10),
    ("elastic-2.0", r"elastic license(?: v(?:ersion)?)? ?2(?: 0)?", "elastic", 8),
    ("elastic", r"elastic license", "elastic", 3),
    ("elastic-2.0", r"spdx license identifier elastic 2 0", "spdx", 10),
    ("commons-clause", r"commons clause(?: license condition)?(?: v(?:ersion)? ?1 0)?", "clause", 7),
    ("polyform-noncommercial-1.0.0", r"polyform noncommercial license(?: 1 0 0)?", "polyform", 8),
    ("polyform-small-business-1.0.0", r"polyform small business license(?: 1 0 0)?", "polyform", 8),
    ("polyform-shield-1.0.0", r"polyform shield license(?: 1 0 0)?", "polyform", 8),
    ("blueoak-1.0.0", r"blue oak model license(?: version)?(?: 1 0 0)?", "oak", 8),
    ("upl-1.0", r"universal permissive license(?: v(?:ersion)? ?1 0)?", "permissive", 8),
    ("ecl-2.0", r"educational community license(?: version 2 0)?", "educational", 8),
    ("efl-2.0", r"eiffel forum license(?: version 2)?", "eiffel", 8),
    ("ipl-1.0", r"ibm public license(?: version 1 0)?", "ibm", 8),
    ("cpl-1.0", r"common public license(?: version 1 0)?", "public", 7),
    ("cpal-1.0", r"common public attribution license(?: version 1 0)?", "attribution", 8),
    ("apsl-2.0", r"apple public source license(?: version)? 2(?: 0)?", "apple", 8),
    ("apsl", r"apple public source license", "apple", 4),
    ("lppl", r"latex project public license", "latex", 8),
    ("ftl", r"freetype (?:project )?license", "freetype", 8),
    ("ijg", r"independent jpeg group s? ?(?:software|license)", "jpeg", 7),
    ("libpng", r"libpng license", "libpng", 8),
    ("libtiff", r"libtiff license", "libtiff", 8),
    ("curl", r"curl license", "curl", 7),
    ("icu", r"icu license", "icu", 8),
    ("unicode-dfs-2016", r"unicode(?: inc)? license agreement data files and software", "unicode", 8),
    ("info-zip", r"info zip license", "zip", 8),
    ("imagemagick", r"imagemagick license", "imagemagick", 8),
    ("hpnd", r"historical permission notice and disclaimer", "historical", 8),
    ("nasa-1.3", r"nasa open source agreement(?: version)? 1 3", "nasa", 8),
    ("npl", r"netscape public license", "netscape", 8),
    ("qpl-1.0", r"q public license(?: version 1 0)?", "public", 7),
    ("rpl-1.5", r"reciprocal public license(?: version)?(?: 1 5)?", "reciprocal", 8),
    ("ruby", r"(?:the )?ruby(?: s)? license", "ruby", 7),
    ("sleepycat", r"sleepycat license", "sleepycat", 8),
    ("sgi-b-2.0", r"sgi free software license b(?: version 2 0)?", "sgi", 8),
    ("tcl", r"tcl tk license", "tcl", 8),
    ("vim", r"vim license", "vim", 8),
    ("w3c", r"w3c software(?: notice)? and(?: document)? license", "w3c", 8),
    ("xfree86", r"xfree86 license", "xfree86", 8),
    ("zpl", r"zope public license", "zope", 8),
    ("mulanpsl-2.0", r"mulan permissive software license(?: v(?:ersion)?)? ?2", "mulan", 8),
    ("pddl-1.0", r"(?:odc )?public domain dedication and licen[cs]e", "dedication", 8),
    ("odc-by-1.0", r"open data commons attribution licen[cs]e", "commons", 8),
    ("ogl-uk", r"open government licen[cs]e", "government", 7),
    ("cdla-permissive", r"community data license agreement permissive", "data", 8),
    ("cdla-sharing", r"community data license agreement sharing", "data", 8),
    ("openrail", r"(?:creativeml |bigscience )?open ?rail(?: m)?(?: license)?", "rail", 6),
    ("hippocratic", r"hippocratic license", "hippocratic", 8),
    ("anti-996", r"anti 996 license", "996", 8),
    ("osl", r"open software license", "software", 3),
    ("afl", r"academic free license", "academic", 3),
    ("eupl", r"european union public licen[cs]e", "european", 3),
    ("artistic", r"(?:perl )?artistic license", "artistic", 3),
    ("ofl", r"(?:sil )?open font license", "font", 3),
    ("odbl", r"open database license", "database", 3),
    ("php", r"php license", "php", 3),
    ("cecill", r"cecill license", "cecill", 3),
    ("proprietary", r"all rights reserved", "reserved", 2),
    ("proprietary", r"proprietary and confidential", "proprietary", 4),
    ("proprietary", r"unauthorized copying of this file via any medium is strictly prohibited", "prohibited", 6),
    ("unknown", r"licensed under the (?:terms|following)", "licensed", 1),
]


def build_rules() -> list[Rule]:
    """All rules, the families' once for each version; a version's minor zero may be left out in the text."""
    rules = []
    for (family, versions), templates in VERSIONED.items():
        for version in versions:
            major, minor = version.split(".")
            words = f"(?:{major} {minor}|{major}{minor})" if minor != "0" else f"(?:{major} 0|{major})"
            for label, pattern, keyword, priority in templates:
                made = pattern.replace("{w}", words)
                rules.append(Rule(label.format(f=family, v=version), made, keyword, priority, priority / 10))
    rules += [Rule(label, pattern, keyword, priority, priority / 10) for label, pattern, keyword, priority in PLAIN]
    return sorted(rules, key=lambda r: -r.priority)


class Scanner:
    """Compiled rules and the automaton of their keywords; one for each task."""

    def __init__(self):
        self.rules = build_rules()
        # a match starts and ends at word borders; words are separated by single spaces
        self.patterns = [re.compile(rf"(?<![^ ]){r.pattern}(?![^ ])".encode()) for r in self.rules]
        self.base = [(re.compile(rf"(?<![^ ]){p}(?![^ ])".encode()), label) for p, label in BASE_PHRASES.items()]
        self.keywords = ahocorasick.Automaton()
        gates: dict[str, list[int]] = {}
        for i, rule in enumerate(self.rules):
            gates.setdefault(rule.keyword, []).append(i)
        for phrase in BASE_PHRASES:
            gates.setdefault(phrase.split()[0], [])
        for keyword, numbers in gates.items():
            self.keywords.add_word(keyword, tuple(numbers))
        self.keywords.make_automaton()

    def scan(self, text: bytes | None) -> tuple[int, list[tuple[int, int, str]], list[tuple[int, int, str, float]]]:
        """Number of words, base places and kept detections; places in words, ends exclusive."""
        lowered = (text or b"").lower()
        found = WORD.findall(lowered)
        gates = {rules for _, rules in self.keywords.iter(lowered.decode("latin-1"))}
        if not gates:
            return len(found), [], []
        line = b" ".join(found)

        blanks = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)

        def place(match: re.Match) -> tuple[int, int]:
            start = int(np.searchsorted(blanks, match.start()))
            return start, start + match.group().count(b" ") + 1

        base = sorted((*place(m), label) for pattern, label in self.base for m in pattern.finditer(line))
        kept: list[tuple[int, int, Rule]] = []
        hits = [
            (*place(m), self.rules[i])
            for i in sorted({i for rules in gates for i in rules})
            for m in self.patterns[i].finditer(line)
        ]
        hits.sort(key=lambda h: (-h[2].priority, h[0] - h[1], h[0], h[2].label))
        inside = _Cover()
        for start, end, rule in hits:
            if not inside.holds(start, end):
                kept.append((start, end, rule))
                inside.add(start, end)
        kept.sort(key=lambda h: (h[0], h[1], h[2].label))
        return len(found), base, [(s, e, r.label, r.confidence) for s, e, r in kept]


class _Cover:
    """Intervals of which none lies within another, so that starts and ends rise together."""

    def __init__(self):
        self.starts: list[int] = []
        self.ends: list[int] = []

    def holds(self, start: int, end: int) -> bool:
        i = bisect.bisect_right(self.starts, start) - 1
        return i >= 0 and self.ends[i] >= end

    def add(self, start: int, end: int) -> None:
        i = bisect.bisect_left(self.starts, start)
        j = i
        while j < len(self.starts) and self.ends[j] <= end:
            j += 1
        self.starts[i:j], self.ends[i:j] = [start], [end]


DETECTIONS = "array<struct<start: bigint, end: bigint, label: string, confidence: double>>"


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's ``doc_id``, ``n_words``, ``base`` (places of the base phrases) and ``detections``.

    Both are arrays of (start, end, label[, confidence]) in words from 0, ends exclusive, ordered by start. Words are
    runs of digits, letters a-z (A-Z in lower case) and characters beyond ASCII. Defined cases: a null or empty text
    has no words; ids come back as they are, as often as they occur; further columns are ignored; an empty table
    gives an empty result. Detections that tie in priority and interval are kept once, by label.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        base_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string())]))
        found_type = pa.list_(
            pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("confidence", pa.float64())])
        )
        for batch in batches:
            counts, bases, detections = [], [], []
            for text in byte_texts(batch.column("text")):
                n, base, found = scanner.scan(text)
                counts.append(n)
                bases.append([dict(zip(("start", "end", "label"), b)) for b in base])
                detections.append([dict(zip(("start", "end", "label", "confidence"), d)) for d in found])
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(bases, base_type),
                 pa.array(detections, found_type)],
                names=["doc_id", "n_words", "base", "detections"],
            )

    source = renamed(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    base = "array<struct<start: bigint, end: bigint, label: string>>"
    return source.mapInArrow(run, f"doc_id bigint, n_words bigint, base {base}, detections {DETECTIONS}")


def license_labels(scanned: DataFrame) -> DataFrame:
    """Label lists, first and last base place, and the confidence of the surest detection, of ``scan_licenses``."""
    names = F.transform("base", lambda b: b["label"])
    found = F.transform("detections", lambda d: d["label"])
    surest = F.array_max(F.transform("detections", lambda d: d["confidence"]))
    return scanned.select(
        "doc_id",
        "n_words",
        F.size("base").cast("bigint").alias("n_base"),
        F.array_min(F.transform("base", lambda b: b["start"])).alias("first_word"),
        F.array_max(F.transform("base", lambda b: b["start"])).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(names)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(names, found))), ",").alias("labels"),
        F.coalesce(surest, F.lit(0.0)).alias("score"),
    )
