"""The signature rules of the license scan.

Patterns are written over normalised words (ASCII letters lower-cased, words joined by one
space).  ``LICENSES`` holds, per label, a priority, name patterns, and patterns of sentences
from the license's own text.  ``RULES`` pairs every name with the ways in which texts cite a
license, which gives several hundred rules; each has the words without which it cannot match
(its prefilter keywords).

Priority: a more specific name outranks the name inside it, so that the containment rule
keeps "lesser general public license" and drops "general public license".
"""

from __future__ import annotations

import re
from dataclasses import dataclass

_V = "(?:version )?(?:v )?"

#: label, priority, name patterns, sentence patterns
LICENSES: list[tuple[str, int, list[str], list[str]]] = [
    ("mit", 50, ["(?:expat )?mit", "expat"], ["permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"]),
    ("mit-0", 55, ["mit no attribution", "mit 0"], []),
    ("x11", 50, ["x11", "mit x11", "x consortium"], ["except as contained in this notice the name of the x consortium shall not be used"]),
    ("isc", 50, ["isc", "internet systems consortium"], ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"]),
    ("apache-2", 55, [f"apache (?:software )?(?:license )?{_V}2(?: 0)?", "asl 2 0"], [f"apache (?:software )?licen[cs]e {_V}2(?: 0)?", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"]),
    ("apache-1.1", 55, [f"apache (?:software )?(?:license )?{_V}1 1"], [f"apache (?:software )?licen[cs]e {_V}1 1", "this product includes software developed by the apache software foundation"]),
    ("apache", 40, ["apache(?: software)?"], []),
    ("bsd-0-clause", 55, ["bsd 0 clause", "zero clause bsd", "0bsd"], ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided as is"]),
    ("bsd-2-clause", 55, ["bsd 2 clause", "2 clause bsd", "two clause bsd", "simplified bsd", "freebsd"], ["redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"]),
    ("bsd-3-clause", 56, ["bsd 3 clause", "3 clause bsd", "three clause bsd", "new bsd", "modified bsd", "revised bsd"], ["neither the name of (?:[^ ]+ ){1,12}nor the names of its contributors may be used to endorse or promote products"]),
    ("bsd-4-clause", 56, ["bsd 4 clause", "4 clause bsd", "four clause bsd", "original bsd"], ["all advertising materials mentioning features or use of this software must display the following acknowledge?ment"]),
    ("bsd", 40, ["bsd", "berkeley software distribution"], []),
    ("gpl-1", 60, [f"(?:gnu )?gpl {_V}1(?: 0)?", f"(?:gnu )?general public licen[cs]e {_V}1(?: 0)?"], []),
    ("gpl-2", 60, [f"(?:gnu )?gpl {_V}2(?: 0)?", "gpl2", f"(?:gnu )?general public licen[cs]e {_V}2(?: 0)?", "gplv2"], ["either version 2 of the license or at your option any later version"]),
    ("gpl-3", 60, [f"(?:gnu )?gpl {_V}3(?: 0)?", "gpl3", f"(?:gnu )?general public licen[cs]e {_V}3(?: 0)?", "gplv3"], ["either version 3 of the license or at your option any later version"]),
    ("gpl", 45, ["(?:gnu )?gpl", "gnu general public", "gnu public"], ["this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"]),
    ("lgpl-2", 65, [f"(?:gnu )?lgpl {_V}2(?: 0)?", f"(?:gnu )?library general public licen[cs]e {_V}2(?: 0)?"], []),
    ("lgpl-2.1", 66, [f"(?:gnu )?lgpl {_V}2 1", f"(?:gnu )?lesser general public licen[cs]e {_V}2 1", "lgplv2 1"], ["either version 2 1 of the license or at your option any later version"]),
    ("lgpl-3", 65, [f"(?:gnu )?lgpl {_V}3(?: 0)?", f"(?:gnu )?lesser general public licen[cs]e {_V}3(?: 0)?", "lgplv3"], []),
    ("lgpl", 55, ["(?:gnu )?lgpl", "(?:gnu )?lesser general public", "(?:gnu )?library general public"], ["this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license"]),
    ("agpl-3", 65, [f"(?:gnu )?agpl {_V}3(?: 0)?", f"(?:gnu )?affero general public licen[cs]e {_V}3(?: 0)?", "agplv3"], []),
    ("agpl", 55, ["(?:gnu )?agpl", "(?:gnu )?affero general public"], ["if you modify the program your modified version must prominently offer all users interacting with it remotely"]),
    ("gfdl", 55, ["(?:gnu )?free documentation", "(?:gnu )?gfdl"], ["permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"]),
    ("mpl-1.1", 60, [f"mozilla public licen[cs]e {_V}1 1", f"mpl {_V}1 1"], ["the contents of this file are subject to the mozilla public license version 1 1"]),
    ("mpl-2", 60, [f"mozilla public licen[cs]e {_V}2(?: 0)?", f"mpl {_V}2(?: 0)?"], ["this source code form is subject to the terms of the mozilla public license v 2 0"]),
    ("mpl", 45, ["mozilla public", "mpl"], []),
    ("epl-1", 60, [f"eclipse public licen[cs]e {_V}1(?: 0)?", f"epl {_V}1(?: 0)?"], []),
    ("epl-2", 60, [f"eclipse public licen[cs]e {_V}2(?: 0)?", f"epl {_V}2(?: 0)?"], ["this program and the accompanying materials are made available under the terms of the eclipse public license"]),
    ("epl", 45, ["eclipse public"], []),
    ("cddl-1", 60, ["common development and distribution", "cddl(?: 1 [01])?"], ["the contents of this file are subject to the terms of the common development and distribution license"]),
    ("cpl-1", 55, ["common public", "cpl 1 0"], []),
    ("eupl-1.2", 60, [f"european union public licen[cs]e {_V}1 2", f"eupl {_V}1 2"], []),
    ("eupl", 50, ["european union public", "eupl"], []),
    ("ms-pl", 55, ["microsoft public", "ms pl"], []),
    ("ms-rl", 55, ["microsoft reciprocal", "ms rl"], []),
    ("artistic-1", 60, [f"artistic licen[cs]e {_V}1(?: 0)?"], []),
    ("artistic-2", 60, [f"artistic licen[cs]e {_V}2(?: 0)?"], ["everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed the artistic license"]),
    ("artistic", 45, ["artistic"], []),
    ("zlib", 50, ["zlib(?: libpng)?"], ["this software is provided as is without any express or implied warranty in no event will the authors be held liable"]),
    ("libpng", 50, ["libpng"], []),
    ("bsl-1", 55, ["boost software", "boost"], ["permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation"]),
    ("busl-1.1", 56, ["business source", "busl 1 1"], ["change date change license additional use grant"]),
    ("psf-2", 55, ["python software foundation", "psf"], ["psf is making python available to licensee on an as is basis"]),
    ("openssl", 50, ["openssl"], ["this product includes software developed by the openssl project"]),
    ("postgresql", 50, ["postgresql"], []),
    ("unicode", 50, ["unicode(?: data files and software)?"], []),
    ("curl", 50, ["curl"], []),
    ("ofl-1.1", 55, ["(?:sil )?open font", "ofl 1 1"], ["this font software is licensed under the sil open font license"]),
    ("wtfpl", 55, ["wtfpl", "do what the fuck you want to public"], ["everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed"]),
    ("unlicense", 55, ["unlicense"], ["this is free and unencumbered software released into the public domain"]),
    ("cc0", 65, ["(?:creative commons )?cc0(?: 1 0)?", "(?:creative commons )?cc 0(?: 1 0)?", "creative commons zero", "cc zero"], ["to the extent possible under law (?:[^ ]+ ){1,12}waived all copyright"]),
    ("cc-by", 50, ["(?:creative commons )?cc by(?: [1-4] [05])?", "creative commons attribution(?: [1-4] [05])?"], []),
    ("cc-by-sa", 60, ["cc by sa(?: [1-4] [05])?", "creative commons attribution share ?alike(?: [1-4] [05])?"], []),
    ("cc-by-nd", 60, ["cc by nd(?: [1-4] [05])?", "creative commons attribution no ?deriv(?:ative)?s(?: [1-4] [05])?"], []),
    ("cc-by-nc", 60, ["cc by nc(?: [1-4] [05])?", "creative commons attribution non ?commercial(?: [1-4] [05])?"], []),
    ("cc-by-nc-sa", 70, ["cc by nc sa(?: [1-4] [05])?", "creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?"], []),
    ("cc-by-nc-nd", 70, ["cc by nc nd(?: [1-4] [05])?", "creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: [1-4] [05])?"], []),
    ("odbl", 55, ["open database", "odbl"], []),
    ("odc-by", 55, ["open data commons attribution", "odc by"], []),
    ("pddl", 55, ["public domain dedication and", "pddl"], []),
    ("ogl-uk-3", 55, [f"open government licen[cs]e {_V}3(?: 0)?"], []),
    ("ogl", 45, ["open government"], []),
    ("etalab-2", 55, ["licence ouverte", "etalab 2 0"], []),
    ("cecill", 50, ["cecill(?: [bc2])?"], []),
    ("afl-3", 50, ["academic free"], []),
    ("osl-3", 50, ["open software"], []),
    ("ecl-2", 50, ["educational community"], []),
    ("upl-1", 50, ["universal permissive"], []),
    ("ncsa", 50, ["university of illinois ncsa", "ncsa open source"], []),
    ("qpl-1", 50, ["q public"], []),
    ("sleepycat", 50, ["sleepycat"], []),
    ("vim", 50, ["vim"], []),
    ("beerware", 50, ["beerware", "beer ware"], ["as long as you retain this notice you can do whatever you want with this stuff"]),
    ("json", 50, ["json"], ["the software shall be used for good not evil"]),
    ("sspl-1", 60, ["server side public", "sspl"], []),
    ("elastic-2", 55, ["elastic"], []),
    ("polyform-nc", 60, ["polyform noncommercial"], []),
    ("openrail", 55, ["(?:bigscience )?openrail(?: m)?", "(?:bigscience )?open rail(?: m)?", "creativeml openrail m"], []),
    ("llama", 50, ["llama(?: [23])? community"], []),
    ("public-domain", 30, ["public domain"], ["(?:released|placed|dedicated) (?:in ?to|to|in) the public domain", "this work is in the public domain"]),
    ("proprietary", 30, ["proprietary", "commercial"], ["proprietary and confidential", "unauthorized copying of this file via any medium is strictly prohibited"]),
    ("all-rights-reserved", 20, [], ["all rights reserved", "tous droits réservés", "alle rechte vorbehalten", "todos los derechos reservados"]),
]

#: How texts cite a license: kind, confidence, what stands around the name, keywords beside the name's own.
CITATIONS: list[tuple[str, float, str, tuple[str, ...]]] = [
    ("tag", 0.99, r"spdx license identifier {name}(?: only| or later)?", ("spdx", "identifier")),
    ("notice", 0.95, r"(?:licensed|released|distributed|published|available|provided|shared|used|redistributed|covered) (?:under|by|with) (?:the |a |an )?(?:terms (?:and conditions )?of (?:the |a |an )?)?{name}(?: international| unported)?(?: licen[cs]e)?(?: {version})?", ()),
    ("under", 0.9, r"(?:under|subject to) (?:the |a )?(?:terms of (?:the )?)?{name} licen[cs]e(?: {version})?", ()),
    ("name", 0.8, r"{name} (?:international |unported )?(?:public )?licen[cs]e(?: {version})?", ()),
    ("field", 0.85, r"licen[cs]e (?:is |type |name )?{name}", ()),
]
VERSION = r"(?:version |v )?[0-9](?: [0-9])?"
TEXT_CONFIDENCE = 1.0


@dataclass(frozen=True)
class Rule:
    label: str
    kind: str
    priority: int
    confidence: float
    keywords: frozenset[str]
    pattern: re.Pattern


_GROUP = re.compile(r"\(\?:([^()]*)\)(\?|\{1,12\})?")


def _needed(pattern: str) -> frozenset[str]:
    """Words that every match holds: plain words of the pattern outside of its groups and options.

    A group whose every branch ends (or begins) in a space is a gap between words; any other
    group, and an optional space, may join what stands beside it, so those words don't count.
    """

    def gap(m: re.Match) -> str:
        branches = m[1].split("|")
        return " " if all(x.endswith(" ") for x in branches) or all(x.startswith(" ") for x in branches) else "\0"

    flat = pattern.replace(" ?", "\0")
    while (less := _GROUP.sub(gap, flat)) != flat:
        flat = less
    return frozenset(w for w in flat.split(" ") if w and not re.search(r"[\[\]?*+{}()|\\\0]", w))


def _rules() -> list[Rule]:
    out = []

    def add(label: str, kind: str, priority: int, confidence: float, pattern: str, more: tuple[str, ...] = ()) -> None:
        whole = re.compile(f"(?<![^ ])(?:{pattern})(?![^ ])")
        out.append(Rule(label, kind, priority, confidence, _needed(pattern) | set(more), whole))

    for label, priority, names, sentences in LICENSES:
        for sentence in sentences:
            add(label, "text", priority + 30, TEXT_CONFIDENCE, sentence)
        for name in names:
            for i, (kind, confidence, form, more) in enumerate(CITATIONS):
                add(label, kind, priority + len(CITATIONS) - i, confidence, form.format(name=name, version=VERSION), more)
    return out


RULES = sorted(_rules(), key=lambda r: (-r.priority, r.label, r.kind, r.pattern.pattern))
