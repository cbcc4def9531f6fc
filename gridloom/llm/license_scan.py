"""License scan: ordered signature rules over the word stream of a text.

A text is lower-cased (A-Z only) and reduced to its words, joined by one space.
Every rule is a regex over that stream with a keyword that must occur before the
regex is tried: one Aho-Corasick pass finds the keywords, so a text without any
costs no regex at all. Rules are signatures from the licenses' own texts, and frames
of words in which licenses are named, around every license's names. Detections are taken in order of priority, then length,
then position; one whose word interval lies inside an already taken interval of
at least its priority is suppressed. Base phrases are exempt from suppression.

Defined results: null text counts as empty (0 words, no detection, score 0);
repeated rows each give a row; an empty table gives an empty table; columns other
than the id and the text are ignored, whatever their names.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import map_texts

FIELDS = {
    "n_words": pa.int64(),
    "score": pa.float64(),
    "detections": pa.list_(
        pa.struct(
            [
                ("label", pa.string()),
                ("rule", pa.string()),
                ("base", pa.bool_()),
                ("priority", pa.int32()),
                ("first_word", pa.int64()),
                ("end_word", pa.int64()),
            ]
        )
    ),
}

# Phrases and labels of the base rules.
BASE_PHRASES = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)

# Label, name regex over words, keyword of the name, regex of its versions.
FAMILIES = (
    ("apache", r"apache(?: software)?(?: foundation)?", "apache", r"[12](?: [01])?"),
    ("mit", r"(?:mit|x11|expat)", "mit|x11|expat", r""),
    ("bsd", r"(?:bsd|berkeley software distribution)", "bsd|berkeley", r"[0-4](?: clause)?"),
    ("gpl", r"(?:gnu )?(?:gpl|general public)", "gpl|general", r"[123](?: 0)?"),
    ("lgpl", r"(?:gnu )?(?:lgpl|(?:lesser|library) general public)", "lgpl|lesser|library", r"[23](?: [01])?"),
    ("agpl", r"(?:gnu )?(?:agpl|affero general public)", "agpl|affero", r"[13](?: 0)?"),
    ("gfdl", r"(?:gnu )?(?:gfdl|free documentation)", "gfdl|documentation", r"1(?: [1-3])?"),
    ("mpl", r"(?:mpl|mozilla public)", "mpl|mozilla", r"[12](?: [01])?"),
    ("epl", r"(?:epl|eclipse public)", "epl|eclipse", r"[12](?: 0)?"),
    ("eupl", r"(?:eupl|european union public)", "eupl|european", r"1(?: [12])?"),
    ("cddl", r"(?:cddl|common development and distribution)", "cddl|distribution", r"1(?: [01])?"),
    ("cpl", r"(?:cpl|common public)", "cpl|common", r"1(?: 0)?"),
    ("isc", r"(?:isc|internet systems consortium)", "isc|consortium", r""),
    ("zlib", r"(?:zlib(?: libpng)?|libpng)", "zlib|libpng", r""),
    ("boost", r"(?:bsl|boost(?: software)?)", "bsl|boost", r"1(?: 0)?"),
    ("artistic", r"(?:perl )?artistic", "artistic", r"[12](?: 0)?"),
    ("psf", r"(?:psf|python(?: software foundation)?)", "psf|python", r"2(?: 0)?"),
    ("unlicense", r"unlicense", "unlicense", r""),
    ("wtfpl", r"(?:wtfpl|do what the f\w* you want to public)", "wtfpl|want", r"2(?: 0)?"),
    ("ofl", r"(?:ofl|(?:sil )?open font)", "ofl|font", r"1(?: [01])?"),
    ("odbl", r"(?:odbl|open (?:data commons )?(?:open )?database)", "odbl|database", r"1(?: 0)?"),
    ("ms-pl", r"(?:ms pl|microsoft public)", "ms|microsoft", r""),
    ("upl", r"(?:upl|universal permissive)", "upl|permissive", r"1(?: 0)?"),
    ("vim", r"vim", "vim", r""),
    ("cc-by", r"(?:cc by|creative commons attribution)", "cc|creative", r"[1-4](?: [05])?"),
    ("cc-by-sa", r"(?:cc by sa|creative commons attribution share ?alike)", "cc|creative", r"[1-4](?: [05])?"),
    ("cc-by-nc", r"(?:cc by nc|creative commons attribution non ?commercial)", "cc|creative", r"[1-4](?: [05])?"),
    ("cc-by-nd", r"(?:cc by nd|creative commons attribution no ?deriv\w*)", "cc|creative", r"[1-4](?: [05])?"),
    ("cc-by-nc-sa", r"(?:cc by nc sa|creative commons attribution non ?commercial share ?alike)", "cc|creative", r"[1-4](?: [05])?"),
    ("cc-by-nc-nd", r"(?:cc by nc nd|creative commons attribution non ?commercial no ?deriv\w*)", "cc|creative", r"[1-4](?: [05])?"),
    ("cc0", r"(?:cc0|creative commons zero)", "cc0|creative", r"1(?: 0)?"),
)

# Name, regex around a family's name {n} and version {v}, priority, confidence.
FRAMES = (
    ("spdx", r"spdx license identifier {n}(?: {v})?(?: (?:only|or later))?", 90, 1.0),
    ("granted", r"(?:licen[sc]ed|released|distributed|available|published|covered|provided|shared) (?:\w+ )?(?:under|by|with)(?: the)?(?: terms(?: and conditions)? of)?(?: the| an?)? {n}(?: licen[sc]e)?(?: (?:version |v)?{v})?", 80, 0.95),
    ("subject", r"subject to(?: the)?(?: terms(?: and conditions)? of)?(?: the)? {n}(?: licen[sc]e)?(?: (?:version |v)?{v})?", 75, 0.9),
    ("versioned", r"{n}(?: licen[sc]e)? (?:version |v)?{v}", 60, 0.85),
    ("titled", r"(?:the )?{n} licen[sc]e(?: agreement)?", 50, 0.8),
    ("declared", r"licen[sc]e(?: type| name| id)? (?:is )?(?:the )?{n}", 45, 0.75),
    ("linked", r"(?:https? )?(?:www )?(?:opensource|spdx|gnu|apache|mozilla|creativecommons|choosealicense) (?:org|com) licen[sc]es?(?: \w+)? {n}(?: {v})?", 70, 0.9),
)

# By license, signatures of its own text, each with keywords, priority and confidence.
SIGNATURES = {
    "mit": (
        (r"permission is hereby granted free of charge to any person obtaining a copy", "hereby", 85, 1.0),
        (r"to deal in the software without restriction including without limitation the rights to use", "restriction", 84, 0.95),
        (r"the above copyright notice and this permission notice shall be included in all copies", "notice", 83, 0.9),
        (r"mit x11", "x11", 55, 0.8),
        (r"the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement", "noninfringement", 84, 0.9),
    ),
    "isc": (
        (r"permission to use copy modify and or distribute this software for any purpose", "permission", 85, 0.95),
        (r"the author disclaims all warranties with regard to this software", "disclaims", 80, 0.85),
        (r"with or without fee is hereby granted provided that the above copyright notice", "fee", 78, 0.8),
    ),
    "bsd": (
        (r"redistribution and use in source and binary forms with or without modification", "redistribution", 85, 1.0),
        (r"redistributions of source code must retain the above copyright notice", "redistributions", 84, 0.95),
        (r"redistributions in binary form must reproduce the above copyright notice", "redistributions", 84, 0.95),
        (r"neither the names? of (?:the )?(?:\w+ ){1,6}nor the names of its contributors may be used to endorse", "neither", 86, 1.0),
        (r"all advertising materials mentioning features or use of this software must display", "advertising", 86, 1.0),
        (r"this software is provided by the copyright holders and contributors as is", "holders", 82, 0.9),
        (r"(?:new|simplified|modified|revised) bsd", "bsd", 60, 0.85),
    ),
    "zlib": (
        (r"this software is provided as is without any express or implied warranty in no event", "warranty", 82, 0.8),
        (r"the origin of this software must not be misrepresented", "misrepresented", 85, 1.0),
        (r"altered source versions must be plainly marked as such", "altered", 85, 1.0),
    ),
    "boost": (
        (r"boost software license version 1 0", "boost", 85, 1.0),
        (r"permission is hereby granted free of charge to any person or organization obtaining a copy", "organization", 86, 1.0),
        (r"machine executable object code generated by a source language processor", "machine", 85, 1.0),
    ),
    "gpl": (
        (r"free software foundation either version [123](?: 0)? of the license", "foundation", 85, 0.95),
        (r"under the terms of the gnu general public license", "gnu", 85, 1.0),
        (r"you should have received a copy of the gnu general public license", "received", 85, 1.0),
        (r"this program is distributed in the hope that it will be useful", "hope", 75, 0.7),
        (r"the licenses for most software are designed to take away your freedom", "freedom", 86, 1.0),
        (r"the gnu general public license is a free copyleft license for software", "copyleft", 87, 1.0),
        (r"gplv[123]", "gplv1|gplv2|gplv3", 60, 0.9),
    ),
    "lgpl": (
        (r"under the terms of the gnu lesser general public license", "gnu", 86, 1.0),
        (r"under the terms of the gnu library general public license", "gnu", 86, 1.0),
        (r"you should have received a copy of the gnu lesser general public license", "received", 86, 1.0),
        (r"work that uses the library", "library", 60, 0.6),
        (r"lgplv[23]", "lgplv2|lgplv3", 60, 0.9),
    ),
    "agpl": (
        (r"under the terms of the gnu affero general public license", "gnu", 86, 1.0),
        (r"you should have received a copy of the gnu affero general public license", "received", 86, 1.0),
        (r"remote network interaction use with the gnu general public license", "remote", 86, 1.0),
        (r"agplv3", "agplv3", 60, 0.9),
    ),
    "gfdl": (
        (r"permission is granted to copy distribute and or modify this document", "document", 85, 0.95),
        (r"no invariant sections no front cover texts and no back cover texts", "invariant", 86, 1.0),
        (r"with the invariant sections being list their titles", "invariant", 86, 1.0),
    ),
    "apache": (
        (r"you may not use this file except in compliance with the license", "compliance", 85, 0.9),
        (r"www apache org licenses license 2 0", "apache", 85, 1.0),
        (r"unless required by applicable law or agreed to in writing software distributed under the license", "applicable", 84, 0.9),
        (r"licensed to the apache software foundation asf under one or more contributor license agreements", "asf", 87, 1.0),
        (r"grant of patent license subject to the terms and conditions of this license each contributor", "patent", 86, 1.0),
        (r"this product includes software developed (?:at|by) the apache (?:software foundation|group)", "apache", 80, 0.85),
    ),
    "mpl": (
        (r"this source code form is subject to the terms of the mozilla public license", "mozilla", 86, 1.0),
        (r"the contents of this file are subject to the mozilla public license", "mozilla", 86, 1.0),
        (r"incompatible with secondary licenses", "incompatible", 80, 0.9),
        (r"mozilla org mpl", "mpl", 70, 0.9),
    ),
    "epl": (
        (r"this program and the accompanying materials are made available under the terms of the eclipse public license", "eclipse", 86, 1.0),
        (r"the accompanying program is provided under the terms of this eclipse public license", "eclipse", 86, 1.0),
        (r"eclipse org legal epl", "epl", 75, 0.95),
    ),
    "eupl": (
        (r"licensed under the eupl", "eupl", 85, 1.0),
        (r"as soon as they will be approved by the european commission", "commission", 85, 1.0),
    ),
    "cddl": (
        (r"the contents of this file are subject to the terms of the common development and distribution license", "distribution", 86, 1.0),
        (r"you can obtain a copy of the license at usr src opensolaris license", "opensolaris", 86, 1.0),
    ),
    "cpl": ((r"the accompanying program is provided under the terms of this common public license", "common", 86, 1.0),),
    "artistic": (
        (r"the intent of this document is to state the conditions under which a package may be copied", "package", 86, 1.0),
        (r"under the same terms as perl(?: itself)?", "perl", 75, 0.85),
        (r"everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed", "verbatim", 70, 0.5),
    ),
    "psf": (
        (r"this license agreement is between the python software foundation", "python", 86, 1.0),
        (r"psf is making python available to licensee on an as is basis", "licensee", 86, 1.0),
    ),
    "unlicense": (
        (r"this is free and unencumbered software released into the public domain", "unencumbered", 86, 1.0),
        (r"anyone is free to copy modify publish use compile sell or distribute this software", "anyone", 85, 1.0),
        (r"unlicense org", "unlicense", 75, 0.95),
    ),
    "wtfpl": (
        (r"you just do what the f\w* you want to", "want", 85, 1.0),
        (r"wtfpl net", "wtfpl", 75, 0.95),
    ),
    "ofl": (
        (r"this font software is licensed under the sil open font license", "sil", 86, 1.0),
        (r"with reserved font name", "font", 70, 0.85),
        (r"scripts sil org ofl", "ofl", 75, 0.95),
    ),
    "odbl": (
        (r"this data is made available under the open database license", "database", 86, 1.0),
        (r"opendatacommons org licenses odbl", "odbl", 85, 1.0),
        (r"any rights in individual contents of the database are licensed under the database contents license", "database", 86, 1.0),
    ),
    "pddl": (
        (r"open data commons public domain dedication(?: and| amp)? licen[sc]e", "commons", 84, 1.0),
        (r"opendatacommons org licenses pddl", "pddl", 85, 1.0),
    ),
    "ms-pl": (
        (r"this license governs use of the accompanying software if you use the software you accept this license", "governs", 85, 0.95),
        (r"microsoft reciprocal license", "reciprocal", 80, 0.9),
    ),
    "upl": ((r"the larger work to which the software is contributed by such licensors", "licensors", 85, 1.0),),
    "vim": ((r"vim is charityware you can use and copy it as much as you like", "charityware", 86, 1.0),),
    "openssl": (
        (r"this product includes software developed by the openssl project", "openssl", 84, 1.0),
        (r"this product includes cryptographic software written by eric young", "cryptographic", 84, 1.0),
    ),
    "postgresql": ((r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement", "agreement", 86, 1.0),),
    "beerware": ((r"(?:the )?beer ?ware license", "beerware|beer", 75, 0.95), (r"you can buy me a beer in return", "beer", 80, 1.0)),
    "json": ((r"the software shall be used for good not evil", "evil", 86, 1.0),),
    "sspl": ((r"server side public license", "server", 80, 1.0), (r"offering the program as a service", "offering", 75, 0.85)),
    "busl": ((r"business source license(?: 1 1)?", "business", 75, 0.95), (r"change license means|the change date", "change", 55, 0.5)),
    "elastic": ((r"elastic license(?: (?:version |v)?2(?: 0)?)?", "elastic", 75, 0.95),),
    "openrail": ((r"(?:creativeml |bigscience )?open ?rail(?: [mds])?(?: licen[sc]e)?", "openrail|rail", 75, 0.95), (r"use based restrictions as referenced in paragraph", "restrictions", 75, 0.9)),
    "llama": ((r"llama [234](?: [0-9])? community license", "llama", 80, 1.0),),
    "cc-by": (
        (r"creativecommons org licenses by [1-4] [05]", "creativecommons", 86, 1.0),
        (r"cc by [1-4] [05]", "cc", 62, 0.95),
        (r"creative commons attribution(?: [1-4] [05])?(?: international| unported| generic)?(?: public)? licen[sc]e", "creative", 82, 0.95),
        (r"you must give appropriate credit provide a link to the license and indicate if changes were made", "credit", 82, 0.9),
    ),
    "cc-by-sa": (
        (r"creativecommons org licenses by sa [1-4] [05]", "creativecommons", 87, 1.0),
        (r"creative commons attribution share ?alike", "creative", 83, 0.95),
        (r"if you remix transform or build upon the material you must distribute your contributions under the same license", "remix", 84, 0.95),
    ),
    "cc-by-nc": (
        (r"creativecommons org licenses by nc [1-4] [05]", "creativecommons", 87, 1.0),
        (r"you may not use the material for commercial purposes", "commercial", 82, 0.9),
        (r"for non ?commercial (?:use|purposes) only", "commercial|noncommercial", 55, 0.6),
    ),
    "cc-by-nd": (
        (r"creativecommons org licenses by nd [1-4] [05]", "creativecommons", 87, 1.0),
        (r"if you remix transform or build upon the material you may not distribute the modified material", "remix", 84, 0.95),
    ),
    "cc-by-nc-sa": ((r"creativecommons org licenses by nc sa [1-4] [05]", "creativecommons", 88, 1.0),),
    "cc-by-nc-nd": ((r"creativecommons org licenses by nc nd [1-4] [05]", "creativecommons", 88, 1.0),),
    "cc0": (
        (r"creativecommons org publicdomain zero 1 0", "publicdomain", 87, 1.0),
        (r"the person who associated a work with this deed has dedicated the work to the public domain", "deed", 86, 1.0),
        (r"no copyright reserved", "reserved", 55, 0.6),
    ),
    "public-domain": (
        (r"(?:released|placed|dedicated|donated)(?: \w+)? (?:in|into|to) the public domain", "domain", 70, 0.9),
        (r"(?:is|are) in the public domain", "domain", 60, 0.7),
        (r"creativecommons org publicdomain mark 1 0", "publicdomain", 87, 1.0),
        (r"project gutenberg license", "gutenberg", 80, 0.9),
        (r"no known copyright restrictions", "restrictions", 65, 0.7),
    ),
    "copyright": (
        (r"copyright (?:c )?(?:19|20)\d\d(?: (?:19|20)\d\d)?", "copyright", 40, 0.6),
        (r"(?:c )?copyright (?:by )?(?:the )?(?:authors?|contributors?|owners?)", "copyright", 40, 0.5),
        (r"protected by copyright(?: laws?)?", "copyright", 45, 0.6),
    ),
    "reserved": (
        (r"all rights (?:are )?reserved", "reserved", 40, 0.7),
        (r"no part of this (?:publication|book|work|document) may be reproduced", "reproduced", 60, 0.9),
        (r"alle rechte vorbehalten", "vorbehalten", 60, 0.9),
        (r"tous droits r\w+serv\w+s", "droits", 60, 0.9),
        (r"todos los derechos reservados", "reservados", 60, 0.9),
        (r"(?:some|certain) rights reserved", "reserved", 45, 0.6),
        (r"without (?:the )?prior written (?:permission|consent)", "written", 50, 0.7),
        (r"may not be (?:published|broadcast|rewritten|redistributed)(?: (?:published|broadcast|rewritten|or|redistributed)){0,4}", "published|broadcast|rewritten|redistributed", 60, 0.85),
    ),
    "proprietary": (
        (r"(?:proprietary and confidential|confidential and proprietary)", "proprietary", 60, 0.85),
        (r"unauthorized (?:copying|use|distribution|reproduction) (?:of this file )?(?:\w+ ){0,4}prohibited", "unauthorized", 60, 0.85),
        (r"trade secrets? of", "trade|secret|secrets", 45, 0.5),
        (r"end user licen[sc]e agreement", "user", 60, 0.8),
        (r"for internal use only", "internal", 45, 0.6),
        (r"terms of (?:use|service) apply", "terms", 40, 0.4),
    ),
    "dual": ((r"(?:dual|multi) licen[sc]ed(?: under)?", "dual|multi", 65, 0.8), (r"at your option any later version", "option", 50, 0.6), (r"at your option (?:either|any) of", "option", 55, 0.7)),
    "warranty": (
        (r"without warranty of any kind(?: express or implied)?", "warranty", 30, 0.4),
        (r"without warranties or conditions of any kind", "warranties", 30, 0.4),
        (r"implied warranty of merchantability or fitness for a particular purpose", "merchantability", 30, 0.4),
        (r"in no event shall the (?:authors?|copyright (?:holders?|owners?))(?: or \w+)? be liable", "liable", 30, 0.4),
        (r"use at your own risk", "risk", 25, 0.3),
    ),
}


@dataclass(frozen=True)
class Rule:
    name: str
    label: str
    pattern: re.Pattern
    keywords: tuple[str, ...]
    priority: int
    confidence: float
    base: bool = False


def compile_rule(name: str, label: str, body: str, keywords: str, priority: int, confidence: float, base: bool = False) -> Rule:
    """A rule over whole words of a stream with a space on both sides."""
    return Rule(name, label, re.compile(rf" ({body})(?= )"), tuple(keywords.split("|")), priority, confidence, base)


@cache
def default_rules() -> tuple[Rule, ...]:
    """Base rules, the signatures, and every frame around every family."""
    rules = [compile_rule(f"base:{label}", label, phrase, phrase.split(" ")[-1], 100, 0.9, base=True) for phrase, label in BASE_PHRASES]
    rules += [compile_rule(f"text:{label}:{i}", label, *row) for label, rows in SIGNATURES.items() for i, row in enumerate(rows)]
    for label, name, kw, version in FAMILIES:
        for frame, body, priority, confidence in FRAMES:
            if version or frame != "versioned":
                full = body.replace("{n}", name).replace("{v}", f"(?:{version})" if version else r"\d+")
                rules.append(compile_rule(f"{frame}:{label}", label, full, kw, priority, confidence))
    return tuple(rules)


class Scanner:
    """The compiled rules of one Python worker."""

    #: A-Z to a-z; every other ASCII character that isn't of a word to a space.
    TO_WORDS = bytes(
        c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
    )

    def __init__(self, rules: tuple[Rule, ...]) -> None:
        import ahocorasick

        self.rules = rules
        self.by_keyword: dict[str, list[int]] = {}
        for k, rule in enumerate(rules):
            for word in rule.keywords:
                self.by_keyword.setdefault(word, []).append(k)
        self.automaton = ahocorasick.Automaton()
        for word in self.by_keyword:
            self.automaton.add_word(f" {word} ", word)
        self.automaton.make_automaton()

    def detections(self, stream: str) -> Iterator[tuple[Rule, int, int]]:
        """Every place of every rule whose keyword occurs, overlapping ones too, as positions in the stream."""
        found = {word for _, word in self.automaton.iter(stream)}
        for k in sorted({k for word in found for k in self.by_keyword[word]}):
            rule, search = self.rules[k], self.rules[k].pattern.search
            m = search(stream)
            while m:
                yield rule, m.start(1), m.end(1)
                m = search(stream, m.start() + 1)

    def scan(self, text: str | None) -> tuple[int, float, list[dict]]:
        words = (text or "").encode().translate(self.TO_WORDS).split()
        stream = f" {b' '.join(words).decode()} "
        raw = list(self.detections(stream))
        starts: list[int] = []  # where words begin
        if raw:
            starts = [m.end() for m in SPACE(stream)]
        raw = [(rule, bisect_left(starts, a), bisect_left(starts, b)) for rule, a, b in raw]
        kept, rest, taken = [], 1.0, Taken()
        for rule, first, end in sorted(raw, key=lambda d: (-d[0].priority, d[1] - d[2], d[1], d[0].name)):
            if taken.add(first, end) or rule.base:
                kept.append((rule, first, end))
                rest *= 1 - rule.confidence
        kept.sort(key=lambda d: (d[1], d[2], d[0].name))
        rows = [
            {"label": r.label, "rule": r.name, "base": r.base, "priority": r.priority, "first_word": a, "end_word": b}
            for r, a, b in kept
        ]
        return len(words), 1.0 - rest, rows


SPACE = re.compile(" ").finditer


class Taken:
    """Intervals, of which those inside others are left out: so the ends rise with the starts, and only the last one
    that begins at or before another can hold it."""

    def __init__(self) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []

    def add(self, first: int, end: int) -> bool:
        """Adds an interval unless one holds it, and says whether it did."""
        at = bisect_right(self.starts, first)
        if at and self.ends[at - 1] >= end:
            return False
        low = at - 1 if at and self.starts[at - 1] == first else at
        high = bisect_right(self.ends, end, at)
        self.starts[low:high], self.ends[low:high] = [first], [end]
        return True


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] | None = None) -> DataFrame:
    """Per row: the id, ``n_words``, ``score`` in 0..1, and the kept ``detections`` in text order.

    One map stage without a shuffle; a row's memory is bounded by its own text.
    """
    chosen = rules or default_rules()

    def worker() -> Callable[[list], dict[str, list]]:
        scanner = Scanner(chosen)

        def kernel(texts: list) -> dict[str, list]:
            rows = [scanner.scan(text) for text in texts]
            return {name: [row[i] for row in rows] for i, name in enumerate(FIELDS)}

        return kernel

    return map_texts(docs, [id_col], text_col, FIELDS, worker)


def license_digest(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The flat columns of a scan: base places, their first and last word, and the labels."""
    base = F.filter("detections", lambda d: d["base"])
    starts = F.transform(base, lambda d: d["first_word"])
    names = lambda found: F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda d: d["label"]))), ",")
    return scanned.select(
        id_col,
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        names(base).alias("base_labels"),
        names(F.col("detections")).alias("labels"),
        "score",
    )
