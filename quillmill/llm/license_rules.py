"""Signature rules for licences: ordered, each with an anchor word, a keyword and a regex.

Rules read lower-case words joined by single spaces.  A signature begins with a plain word, its anchor;
its keyword is the longest stretch of it that every match holds, and is looked for before the regex.
"""

from __future__ import annotations

import re
import re._parser as parser
from dataclasses import dataclass

#: Priorities: a declared identifier, wording of the licence or its notice, a statement that something
#: is under it, its name, and words that only hint at it.
SPDX, WORDING, STATEMENT, NAME, HINT = 100, 90, 80, 60, 40
BY = "(?:version |v )?"
# Signatures by licence.  Identifiers stand after "spdx license identifier", names also
# after "under".
SIGNATURES: list[tuple[str, int, list[str]]] = [
    ("0bsd", SPDX, ["0bsd"]),
    ("0bsd", NAME, ["zero clause bsd license", "bsd zero clause license"]),
    ("afl-3", SPDX, ["afl 3 0"]),
    ("afl-3", NAME, [f"academic free license {BY}3(?: 0)?"]),
    ("agpl-1", SPDX, ["agpl 1 0(?: only| or later)?"]),
    ("agpl-3", SPDX, ["agpl 3 0(?: only| or later)?"]),
    ("agpl-3", WORDING, ["affero general public license as published by the free software foundation either version 3", "copy of the gnu affero general public license along with this program"]),
    ("agpl-3", NAME, ["gnu affero general public license(?: version 3| v3| 3)?(?: 0)?", "affero general public license(?: version 3| v3| 3)?(?: 0)?", "gnu agpl(?: version 3| v3| 3)?(?: 0)?", "agplv3", "agpl v3", "agpl 3(?: 0)?"]),
    ("apache-1", SPDX, ["apache 1 [01]"]),
    ("apache-1", NAME, [f"apache (?:software )?license {BY}1(?: [01])?"]),
    ("apache-1", WORDING, ["product includes software developed by the apache software foundation http www apache org"]),
    ("apache-2", SPDX, ["apache 2 0"]),
    ("apache-2", WORDING, ["licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis", "licensed to the apache software foundation asf under one or more contributor license agreements", "asf licenses this file to you under the apache license version 2 0", "apache org licenses license 2 0(?: txt| html)?", "apache license version 2 0 january 2004 http www apache org licenses"]),
    ("apache-2", NAME, [f"apache (?:software )?license {BY}2(?: 0)?", "apache (?:software )?licence 2(?: 0)?", "apache license v2(?: 0)?", "apache 2(?: 0)? licen[cs]ed?", "apache 2 0", "asl 2 0"]),
    ("apache", HINT, ["apache software license", "apache license", "apache licensed"]),
    ("apsl-2", SPDX, ["apsl 2 0"]),
    ("apsl-2", NAME, [f"apple public source license(?: {BY}2 0)?"]),
    ("artistic-1", SPDX, ["artistic 1 0(?: perl| cl8)?"]),
    ("artistic-1", NAME, [f"artistic license {BY}1(?: 0)?", "clarified artistic license"]),
    ("artistic-2", SPDX, ["artistic 2 0"]),
    ("artistic-2", NAME, [f"artistic license {BY}2(?: 0)?"]),
    ("artistic", WORDING, ["either the gnu general public license or the artistic license", "redistribute it and or modify it under the same terms as perl itself"]),
    ("artistic", HINT, ["artistic license"]),
    ("beerware", SPDX, ["beerware"]),
    ("beerware", NAME, ["beer ware license", "beerware license"]),
    ("blueoak-1", SPDX, ["blueoak 1 0 0"]),
    ("blueoak-1", NAME, ["blue oak model license(?: 1 0 0)?"]),
    ("bsd-1", SPDX, ["bsd 1 clause"]),
    ("bsd-2", SPDX, ["bsd 2 clause(?: patent| views)?"]),
    ("bsd-2", NAME, ["simplified bsd licen[cs]e", "bsd 2 clause(?: licen[cs]e)?", "2 clause bsd(?: licen[cs]e)?", "two clause bsd(?: licen[cs]e)?", "freebsd licen[cs]e", "bsd licence 2 clause", "bsd 2 licen[cs]e"]),
    ("bsd-3", SPDX, ["bsd 3 clause(?: clear| lbnl| attribution)?"]),
    ("bsd-3", WORDING, ["neither the names? of (?:[^ ]+ ){1,12}nor the names of (?:its|their|other|any) contributors may be used to endorse or promote products", "neither the name of (?:[^ ]+ ){1,12}may be used to endorse or promote products derived from this software without specific prior written permission", "name of the author may not be used to endorse or promote products derived from this software"]),
    ("bsd-3", NAME, ["modified bsd licen[cs]e", "new bsd licen[cs]e", "revised bsd licen[cs]e", "bsd 3 clause(?: licen[cs]e)?", "3 clause bsd(?: licen[cs]e)?", "three clause bsd(?: licen[cs]e)?", "bsd 3 licen[cs]e", "bsd style license that can be found in the license file"]),
    ("bsd-4", SPDX, ["bsd 4 clause(?: uc| shortened)?"]),
    ("bsd-4", WORDING, ["advertising materials mentioning features or use of this software must display the following acknowledge?ment"]),
    ("bsd-4", NAME, ["original bsd licen[cs]e", "bsd 4 clause(?: licen[cs]e)?", "4 clause bsd(?: licen[cs]e)?", "four clause bsd(?: licen[cs]e)?", "old bsd licen[cs]e"]),
    ("bsd", WORDING, ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistributions of source code must retain the above copyright notice this list of conditions", "redistributions in binary form must reproduce the above copyright notice this list of conditions", "provided by the copyright holders and contributors as is and any express or implied warranties", "provided by the (?:regents|author|authors) and contributors as is and any express or implied warranties"]),
    ("bsd", HINT, ["bsd licen[cs]ed?", "bsd style licen[cs]e", "bsd type licen[cs]e", "berkeley software distribution licen[cs]e"]),
    ("bsl-1", SPDX, ["bsl 1 0"]),
    ("bsl-1", WORDING, ["granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license", "boost org license 1 0(?: txt)?"]),
    ("bsl-1", NAME, [f"boost software license(?: {BY}1(?: 0)?)?", "boost license"]),
    ("busl-1", SPDX, ["busl 1 1"]),
    ("busl-1", NAME, [f"business source license(?: {BY}1 1)?"]),
    ("cc0-1", SPDX, ["cc0 1 0"]),
    ("cc0-1", WORDING, ["associated a work with this deed has dedicated the work to the public domain", "creativecommons org publicdomain zero 1 0", "waived all copyright and related or neighboring rights to"]),
    ("cc0-1", NAME, ["cc0(?: 1 0)?(?: universal)?(?: licen[cs]e)?", "creative commons zero(?: v1 0)?(?: universal)?", "creative commons cc0", "cc zero"]),
    ("cc-by", SPDX, ["cc by [1-4] [05]"]),
    ("cc-by", WORDING, ["creativecommons org licenses by [1-4] [05]"]),
    ("cc-by", NAME, ["creative commons attribution(?: [1-4] [05])?(?: international| unported| generic)?(?: licen[cs]e)?", "cc by(?: [1-4] [05])?(?: licen[cs]e)?"]),
    ("cc-by-nc", SPDX, ["cc by nc [1-4] [05]"]),
    ("cc-by-nc", WORDING, ["creativecommons org licenses by nc [1-4] [05]"]),
    ("cc-by-nc", NAME, ["creative commons attribution non ?commercial(?: [1-4] [05])?(?: international| unported| generic)?(?: licen[cs]e)?", "cc by nc(?: [1-4] [05])?(?: licen[cs]e)?"]),
    ("cc-by-nc-nd", SPDX, ["cc by nc nd [1-4] [05]"]),
    ("cc-by-nc-nd", WORDING, ["creativecommons org licenses by nc nd [1-4] [05]"]),
    ("cc-by-nc-nd", NAME, ["creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?(?: [1-4] [05])?(?: international| unported| generic)?(?: licen[cs]e)?", "cc by nc nd(?: [1-4] [05])?(?: licen[cs]e)?"]),
    ("cc-by-nc-sa", SPDX, ["cc by nc sa [1-4] [05]"]),
    ("cc-by-nc-sa", WORDING, ["creativecommons org licenses by nc sa [1-4] [05]"]),
    ("cc-by-nc-sa", NAME, ["creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?(?: international| unported| generic)?(?: licen[cs]e)?", "cc by nc sa(?: [1-4] [05])?(?: licen[cs]e)?"]),
    ("cc-by-nd", SPDX, ["cc by nd [1-4] [05]"]),
    ("cc-by-nd", WORDING, ["creativecommons org licenses by nd [1-4] [05]"]),
    ("cc-by-nd", NAME, ["creative commons attribution no ?deriv(?:ative)?s?(?: works)?(?: [1-4] [05])?(?: international| unported| generic)?(?: licen[cs]e)?", "cc by nd(?: [1-4] [05])?(?: licen[cs]e)?"]),
    ("cc-by-sa", SPDX, ["cc by sa [1-4] [05]"]),
    ("cc-by-sa", WORDING, ["creativecommons org licenses by sa [1-4] [05]"]),
    ("cc-by-sa", NAME, ["creative commons attribution share ?alike(?: [1-4] [05])?(?: international| unported| generic)?(?: licen[cs]e)?", "cc by sa(?: [1-4] [05])?(?: licen[cs]e)?"]),
    ("cc", HINT, ["creative commons licen[cs]e", "creative commons licensed"]),
    ("cddl-1", SPDX, ["cddl 1 [01]"]),
    ("cddl-1", WORDING, ["contents of this file are subject to the terms of the common development and distribution license"]),
    ("cddl-1", NAME, [f"common development and distribution license(?: cddl)?(?: {BY}1 [01])?", "cddl licen[cs]e", "cddl 1 [01]"]),
    ("cecill", SPDX, ["cecill (?:1|2) [01]", "cecill b", "cecill c"]),
    ("cecill", NAME, ["cecill(?: b| c)?(?: free software)? licen[cs]e(?: agreement)?", "cecill 2 [01]"]),
    ("cpal-1", SPDX, ["cpal 1 0"]),
    ("cpal-1", NAME, [f"common public attribution license(?: {BY}1 0)?"]),
    ("cpl-1", SPDX, ["cpl 1 0"]),
    ("cpl-1", NAME, [f"common public license(?: {BY}1 0)?"]),
    ("ecl-2", SPDX, ["ecl 2 0"]),
    ("ecl-2", NAME, [f"educational community license(?: {BY}2 0)?"]),
    ("elastic-2", SPDX, ["elastic 2 0"]),
    ("elastic-2", NAME, ["elastic license(?: 2 0)?"]),
    ("epl-1", SPDX, ["epl 1 0"]),
    ("epl-1", WORDING, ["made available under the terms of the eclipse public license v1 0 which accompanies this distribution"]),
    ("epl-1", NAME, [f"eclipse public license {BY}1(?: 0)?", "eclipse public license v1(?: 0)?", "epl v1 0", "epl 1 0"]),
    ("epl-2", SPDX, ["epl 2 0"]),
    ("epl-2", WORDING, ["made available under the terms of the eclipse public license 2 0 which is available at", "eclipse org legal epl 2 0"]),
    ("epl-2", NAME, [f"eclipse public license {BY}2(?: 0)?", "eclipse public license v2(?: 0)?", "epl v2 0", "epl 2 0"]),
    ("epl", HINT, ["eclipse public license"]),
    ("edl-1", NAME, [f"eclipse distribution license(?: {BY}1 0)?"]),
    ("eupl-1", SPDX, ["eupl 1 [0-2]"]),
    ("eupl-1", NAME, [f"european union public licen[cs]e(?: {BY}1 [0-2])?", "eupl licen[cs]e", "eupl v1 [0-2]"]),
    ("gfdl", SPDX, ["gfdl 1 [1-3](?: only| or later| invariants only| no invariants only)?"]),
    ("gfdl", WORDING, ["granted to copy distribute and or modify this document under the terms of the gnu free documentation license"]),
    ("gfdl", NAME, [f"gnu free documentation license(?: {BY}1 [1-3])?"]),
    ("gpl-1", SPDX, ["gpl 1 0(?: only| or later)?"]),
    ("gpl-1", WORDING, ["gnu general public license as published by the free software foundation either version 1"]),
    ("gpl-1", NAME, [f"gnu general public license {BY}1(?: 0)?", "gplv1", "gpl v1"]),
    ("gpl-2", SPDX, ["gpl 2 0(?: only| or later| with classpath exception| with gcc exception)?"]),
    ("gpl-2", WORDING, ["gnu general public license(?: gpl)? as published by the free software foundation either version 2", "gnu general public license(?: gpl)? version 2 as published by the free software foundation", "gnu org licenses (?:old licenses )?gpl 2 0(?: html| txt)?"]),
    ("gpl-2", NAME, [f"gnu general public license(?: gpl)? {BY}2(?: 0)?", "gnu general public license v2(?: 0)?", f"gnu gpl {BY}2(?: 0)?", "gnu gpl v2", "gnu gplv2", "gplv2", "gpl v2(?: 0)?", "gpl version 2(?: 0)?", "gpl 2(?: 0)?"]),
    ("gpl-3", SPDX, ["gpl 3 0(?: only| or later| with gcc exception)?"]),
    ("gpl-3", WORDING, ["gnu general public license(?: gpl)? as published by the free software foundation either version 3", "gnu general public license(?: gpl)? version 3 as published by the free software foundation", "gnu org licenses gpl 3 0(?: html| txt)?"]),
    ("gpl-3", NAME, [f"gnu general public license(?: gpl)? {BY}3(?: 0)?", "gnu general public license v3(?: 0)?", f"gnu gpl {BY}3(?: 0)?", "gnu gpl v3", "gnu gplv3", "gplv3", "gpl v3(?: 0)?", "gpl version 3(?: 0)?", "gpl 3(?: 0)?"]),
    ("gpl", SPDX, ["gpl"]),
    ("gpl", WORDING, ["program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "received a copy of the gnu general public license along with this program"]),
    ("gpl", HINT, ["gnu general public license", "gnu gpl", "gnu public license", "gpl licen[cs]ed?", "gpl compatible"]),
    ("hpnd", SPDX, ["hpnd(?: sell variant)?"]),
    ("hpnd", WORDING, ["permission to use copy modify and distribute this software and its documentation for any purpose and without fee is hereby granted", "permission to use copy modify distribute and sell this software and its documentation for any purpose is hereby granted without fee"]),
    ("icu", SPDX, ["icu"]),
    ("icu", NAME, ["icu license", "unicode license agreement", "unicode inc license agreement"]),
    ("ijg", SPDX, ["ijg"]),
    ("ijg", WORDING, ["software is based in part on the work of the independent jpeg group"]),
    ("ipl-1", SPDX, ["ipl 1 0"]),
    ("ipl-1", NAME, [f"ibm public license(?: {BY}1 0)?"]),
    ("isc", SPDX, ["isc(?: veillard)?"]),
    ("isc", WORDING, ["permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted", "author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness"]),
    ("isc", NAME, ["isc licen[cs]ed?", "internet software consortium licen[cs]e", "openbsd licen[cs]e"]),
    ("lgpl-2", SPDX, ["lgpl 2 [01](?: only| or later)?"]),
    ("lgpl-2", WORDING, ["gnu (?:lesser|library) general public license as published by the free software foundation either version 2(?: 1)?", "gnu org licenses (?:old licenses )?lgpl 2 1(?: html| txt)?"]),
    ("lgpl-2", NAME, [f"gnu (?:lesser|library) general public license {BY}2(?: [01])?", "gnu (?:lesser|library) general public license v2(?: [01])?", f"gnu lgpl {BY}2(?: [01])?", "lgplv2(?: 1)?", "lgpl v2(?: 1)?", "lgpl version 2(?: 1)?", "lgpl 2(?: [01])?"]),
    ("lgpl-3", SPDX, ["lgpl 3 0(?: only| or later)?"]),
    ("lgpl-3", WORDING, ["gnu lesser general public license as published by the free software foundation either version 3", "gnu org licenses lgpl 3 0(?: html| txt)?"]),
    ("lgpl-3", NAME, [f"gnu lesser general public license {BY}3(?: 0)?", "gnu lesser general public license v3(?: 0)?", f"gnu lgpl {BY}3(?: 0)?", "lgplv3", "lgpl v3(?: 0)?", "lgpl version 3(?: 0)?", "lgpl 3(?: 0)?"]),
    ("lgpl", WORDING, ["library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license"]),
    ("lgpl", HINT, ["gnu lesser general public license", "gnu library general public license", "lesser general public license", "gnu lgpl", "lgpl licen[cs]ed?"]),
    ("lppl-1", SPDX, ["lppl 1 [0-3][abc]?"]),
    ("lppl-1", WORDING, ["work may be distributed and or modified under the conditions of the latex project public license"]),
    ("lppl-1", NAME, [f"latex project public license(?: {BY}1 [0-3][abc]?)?"]),
    ("mit-0", SPDX, ["mit 0"]),
    ("mit-0", NAME, ["mit no attribution(?: licen[cs]e)?", "mit 0 licen[cs]e"]),
    ("mit", SPDX, ["mit"]),
    ("mit", WORDING, ["permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies", "above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability", "opensource org licenses mit(?: license)?(?: php)?"]),
    ("mit", NAME, ["mit licen[cs]ed?", "mit x11 licen[cs]e", "mit expat licen[cs]e", "expat licen[cs]e", "x11 licen[cs]e", "massachusetts institute of technology licen[cs]e"]),
    ("mit", HINT, ["mit style licen[cs]e", "mit type licen[cs]e"]),
    ("mpl-1", SPDX, ["mpl 1 [01]"]),
    ("mpl-1", WORDING, ["contents of this file are subject to the mozilla public license version 1 [01]"]),
    ("mpl-1", NAME, [f"mozilla public license {BY}1(?: [01])?", "mpl 1 [01]"]),
    ("mpl-2", SPDX, ["mpl 2 0(?: no copyleft exception)?"]),
    ("mpl-2", WORDING, ["source code form is subject to the terms of the mozilla public license v 2 0", "copy of the mpl was not distributed with this file you can obtain one at", "mozilla org mpl 2 0"]),
    ("mpl-2", NAME, [f"mozilla public license {BY}2(?: 0)?", "mozilla public license v2(?: 0)?", "mpl v2(?: 0)?", "mpl 2 0"]),
    ("mpl", HINT, ["mozilla public license", "mpl licen[cs]ed?"]),
    ("ms-pl", SPDX, ["ms pl"]),
    ("ms-pl", NAME, ["microsoft public license", "ms pl license"]),
    ("ms-rl", SPDX, ["ms rl"]),
    ("ms-rl", NAME, ["microsoft reciprocal license"]),
    ("mulan-2", SPDX, ["mulanpsl (?:1|2) 0"]),
    ("mulan-2", NAME, ["mulan psl(?: v2| v1)?", "mulan permissive software license(?: version 2| v2)?"]),
    ("ncsa", SPDX, ["ncsa"]),
    ("ncsa", WORDING, ["permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal with the software"]),
    ("ncsa", NAME, ["university of illinois(?: ncsa)? open source license", "illinois open source license"]),
    ("npl-1", SPDX, ["npl 1 [01]"]),
    ("npl-1", NAME, [f"netscape public license(?: {BY}1 [01])?"]),
    ("odbl-1", SPDX, ["odbl 1 0"]),
    ("odbl-1", NAME, ["open data commons open database licen[cs]e(?: v1 0)?", "open database licen[cs]e(?: v1 0| 1 0)?", "opendatacommons org licenses odbl"]),
    ("odc-by-1", SPDX, ["odc by 1 0"]),
    ("odc-by-1", NAME, ["open data commons attribution licen[cs]e(?: v1 0)?", "opendatacommons org licenses by"]),
    ("ofl-1", SPDX, ["ofl 1 [01](?: rfn| no rfn)?"]),
    ("ofl-1", WORDING, ["font software is licensed under the sil open font license version 1 [01]"]),
    ("ofl-1", NAME, [f"sil open font license(?: {BY}1 [01])?", "sil ofl 1 [01]", "ofl license"]),
    ("openssl", SPDX, ["openssl"]),
    ("openssl", WORDING, ["software developed by the openssl project for use in the openssl toolkit"]),
    ("openssl", NAME, ["openssl license", "ssleay license"]),
    ("osl-3", SPDX, ["osl (?:1|2|3) [01]"]),
    ("osl-3", NAME, [f"open software license(?: {BY}(?:1|2|3) [01])?"]),
    ("pddl-1", SPDX, ["pddl 1 0"]),
    ("pddl-1", NAME, ["open data commons public domain dedication(?: and licen[cs]e)?"]),
    ("php-3", SPDX, ["php 3 0(?:1)?"]),
    ("php-3", WORDING, ["source file is subject to version 3 01 of the php license"]),
    ("php-3", NAME, [f"php license(?: {BY}3 0(?:1)?)?"]),
    ("postgresql", SPDX, ["postgresql"]),
    ("postgresql", NAME, ["postgresql licen[cs]e"]),
    ("public-domain", WORDING, ["hereby placed in the public domain", "released into the public domain by its author", "author disclaims copyright to this source code"]),
    ("public-domain", HINT, ["public domain dedication", "public domain software"]),
    ("python-2", SPDX, ["python 2 0(?: 1)?", "psf 2 0"]),
    ("python-2", NAME, [f"python software foundation license(?: {BY}2)?", "psf license(?: agreement)?(?: for python)?", "python license(?: 2 0)?"]),
    ("qpl-1", SPDX, ["qpl 1 0"]),
    ("qpl-1", NAME, [f"q public license(?: {BY}1 0)?"]),
    ("ruby", SPDX, ["ruby"]),
    ("ruby", NAME, ["ruby license"]),
    ("sleepycat", SPDX, ["sleepycat"]),
    ("sleepycat", NAME, ["sleepycat license", "sleepycat public license"]),
    ("sspl-1", SPDX, ["sspl 1 0"]),
    ("sspl-1", NAME, [f"server side public license(?: {BY}1)?", "sspl license"]),
    ("unlicense", SPDX, ["unlicense"]),
    ("unlicense", WORDING, ["free and unencumbered software released into the public domain", "anyone is free to copy modify publish use compile sell or distribute this software", "unlicense org"]),
    ("unlicense", NAME, ["unlicense license", "unlicense"]),
    ("upl-1", SPDX, ["upl 1 0"]),
    ("upl-1", NAME, [f"universal permissive license(?: {BY}1 0| v1 0)?"]),
    ("vim", SPDX, ["vim"]),
    ("vim", NAME, ["vim license"]),
    ("w3c", SPDX, ["w3c(?: 20150513)?"]),
    ("w3c", NAME, ["w3c software(?: notice)? and license", "w3c software license", "w3c license"]),
    ("wtfpl", SPDX, ["wtfpl"]),
    ("wtfpl", WORDING, ["everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed"]),
    ("wtfpl", NAME, ["do what the fuck you want to public license", "wtfpl(?: licen[cs]e)?"]),
    ("zlib", SPDX, ["zlib(?: acknowledgement)?"]),
    ("zlib", WORDING, ["provided as is without any express or implied warranty in no event will the authors be held liable", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software", "origin of this software must not be misrepresented you must not claim that you wrote the original software"]),
    ("zlib", NAME, ["zlib licen[cs]e", "zlib libpng licen[cs]e", "libpng licen[cs]e"]),
    ("zpl-2", SPDX, ["zpl 2 [01]"]),
    ("zpl-2", NAME, [f"zope public license(?: zpl)?(?: {BY}2 [01])?"]),
]
#: The base phrases and their labels.
BASE_PHRASES = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]


@dataclass(frozen=True)
class Rule:
    anchor: str
    keyword: str
    pattern: str
    label: str
    priority: int


def keyword_of(signature: str) -> str:
    """The longest stretch of plain characters that every match of a signature holds."""
    runs, held = [], ""
    for kind, value in parser.parse(signature):
        if str(kind) == "LITERAL":
            held += chr(value)
        else:
            runs.append(held)
            held = ""
    return max([*runs, held], key=len).strip()


def most_words(signature: str) -> int:
    """Words of a signature's longest match."""

    def spaces(parsed) -> int:
        total = 0
        for kind, value in parsed:
            name = str(kind)
            if name == "LITERAL":
                total += value == 32
            elif name == "SUBPATTERN":
                total += spaces(value[3])
            elif name == "BRANCH":
                total += max(spaces(x) for x in value[1])
            elif name == "MAX_REPEAT":
                inside = spaces(value[2])
                total += inside * int(value[1]) if inside else 0
        return total

    return spaces(parser.parse(signature)) + 1


def build_rules() -> list[Rule]:
    """All rules, in order of priority, then as they stand above."""
    signatures: list[tuple[int, str, str]] = []
    for label, priority, each in SIGNATURES:
        for signature in each:
            if priority == SPDX:
                signatures.append((SPDX, label, f"spdx license identifier {signature}"))
                continue
            signatures.append((priority, label, signature))
            if priority == NAME:
                signatures.append((STATEMENT, label, f"under (?:an? |the )?(?:terms of (?:an? |the )?)?{signature}"))
    signatures.sort(key=lambda x: -x[0])
    return [Rule(re.match("[a-z0-9]+", s)[0], keyword_of(s), f"^{s}(?= |$)", label, priority) for priority, label, s in signatures]


#: Words of the longest signature: what follows an anchor is looked at so far.
WINDOW = max(most_words(r.pattern[1:].removesuffix("(?= |$)")) for r in build_rules())
