"""License signatures over plain words: lower-case, one space between words, punctuation gone ("4.0" is "4 0").

A rule is (label, keyword, priority, pattern). A pattern is tried only where
its keyword stands in the text. Priorities: 4 an SPDX tag or a sentence of the
license text, 3 a grant ("licensed under ..."), 2 a full name, 1 a short name.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

TEXT, GRANT, NAME, SHORT = 4, 3, 2, 1


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: bytes
    priority: int
    pattern: re.Pattern


# Words between the parts of a name.
V = r"(?: version| ?v)? ?"
GIVEN = (
    r"(?:licensed|released|distributed|available|published|provided|covered|redistribute(?: it)?|used?|made available)"
    r"(?: \S+){0,3}? (?:under|by|with)(?: the)?(?: terms of(?: the)?)?"
)

# Families with versions: label, keyword, full name, short name, versions. "{v}" takes the version, "{w}" the whole of it
# where its first number alone would say too little.
VERSIONED = [
    ("GPL-{v}", "general public license", r"(?:gnu )?general public license{v}", r"(?:gnu )?gpl{v}", "1.0 2.0 3.0"),
    ("LGPL-{v}", "lesser general public", r"(?:gnu )?(?:lesser|library) general public license{v}", r"(?:gnu )?lgpl{v}", "2.0 2.1 3.0"),
    ("AGPL-{v}", "affero", r"(?:gnu )?affero general public license{v}", r"(?:gnu )?agpl{v}", "1.0 3.0"),
    ("GFDL-{v}", "free documentation", r"(?:gnu )?free documentation license{v}", r"(?:gnu )?gfdl{v}", "1.1 1.2 1.3"),
    ("Apache-{v}", "apache", r"apache (?:software )?license{v}", r"apache{w}", "1.0 1.1 2.0"),
    ("MPL-{v}", "mozilla public", r"mozilla public license{v}", r"mpl{v}", "1.0 1.1 2.0"),
    ("EPL-{v}", "eclipse public", r"eclipse public license{v}", r"epl{v}", "1.0 2.0"),
    ("EUPL-{v}", "european union public", r"european union public licen[cs]e{v}", r"eupl{v}", "1.0 1.1 1.2"),
    ("CDDL-{v}", "common development", r"common development and distribution license{v}", r"cddl{v}", "1.0 1.1"),
    ("CPL-{v}", "common public license", r"common public license{v}", r"cpl{v}", "1.0"),
    ("AFL-{v}", "academic free", r"academic free license{v}", r"afl{v}", "1.1 1.2 2.0 2.1 3.0"),
    ("OSL-{v}", "open software license", r"open software license{v}", r"osl{v}", "1.0 1.1 2.0 2.1 3.0"),
    ("OFL-{v}", "open font", r"(?:sil )?open font license{v}", r"(?:sil )?ofl{v}", "1.0 1.1"),
    ("Artistic-{v}", "artistic", r"(?:perl )?artistic license{v}", r"artistic{w}", "1.0 2.0"),
    ("PHP-{v}", "php license", r"php license{v}", r"php license{v}", "3.0 3.01"),
    ("ZPL-{v}", "zope public", r"zope public license{v}", r"zpl{v}", "1.1 2.0 2.1"),
    ("LPPL-{v}", "project public", r"latex project public license{v}", r"lppl{v}", "1.0 1.1 1.2 1.3"),
    ("BSL-{v}", "boost software", r"boost software license{v}", r"boost license{v}", "1.0"),
    ("MulanPSL-{v}", "mulan", r"mulan permissive software license{v}", r"mulan psl{v}", "1.0 2.0"),
    ("ODbL-{v}", "open database", r"(?:open data commons )?open database license{v}", r"odbl{v}", "1.0"),
    ("ODC-By-{v}", "open data commons", r"open data commons attribution license{v}", r"odc by{v}", "1.0"),
    ("CC-BY-{v}", "attribution", r"creative commons attribution{v}", r"cc by{v}", "1.0 2.0 2.5 3.0 4.0"),
    ("CC-BY-SA-{v}", "attribution", r"creative commons attribution share ?alike{v}", r"cc by sa{v}", "1.0 2.0 2.5 3.0 4.0"),
    ("CC-BY-NC-{v}", "attribution", r"creative commons attribution non ?commercial{v}", r"cc by nc{v}", "1.0 2.0 2.5 3.0 4.0"),
    ("CC-BY-ND-{v}", "attribution", r"creative commons attribution no ?deriv\w*(?: works)?{v}", r"cc by nd{v}", "1.0 2.0 2.5 3.0 4.0"),
    ("CC-BY-NC-SA-{v}", "attribution", r"creative commons attribution non ?commercial share ?alike{v}", r"cc by nc sa{v}", "1.0 2.0 2.5 3.0 4.0"),
    ("CC-BY-NC-ND-{v}", "attribution", r"creative commons attribution non ?commercial no ?deriv\w*(?: works)?{v}", r"cc by nc nd{v}", "1.0 2.0 2.5 3.0 4.0"),
    ("CC0-{v}", "cc0", r"(?:creative commons )?cc0{v}(?: universal)?", r"cc0{v}", "1.0"),
]

# The word each family's short name holds.
SHORT_KEYWORDS = {
    "Apache": "apache", "Artistic": "artistic", "PHP": "php license", "BSL": "boost license", "MulanPSL": "mulan psl",
    "ODC-By": "odc by", "CC-BY": "cc by", "CC-BY-SA": "cc by sa", "CC-BY-NC": "cc by nc", "CC-BY-ND": "cc by nd",
    "CC-BY-NC-SA": "cc by nc sa", "CC-BY-NC-ND": "cc by nc nd",
}

# Licenses without versions, and sentences: label, keyword, priority, pattern.
PLAIN_RULES = [
    ("MIT", "mit license", NAME, r"(?:the )?mit license"),
    ("MIT", "mit licensed", NAME, r"mit licensed"),
    ("MIT", "license mit", SHORT, r"license mit"),
    ("MIT", "under", GRANT, r"(?:licensed|released|distributed|available|published|provided)(?: \S+){0,3}? under(?: the)?(?: terms of(?: the)?)? mit(?: license)?"),
    ("MIT", "under the mit", SHORT, r"under the mit"),
    ("MIT", "expat", NAME, r"expat license"),
    ("MIT", "permission is hereby granted", TEXT, r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("ISC", "isc license", NAME, r"isc license"),
    ("ISC", "permission to use copy modify", TEXT, r"permission to use copy modify and or distribute this software"),
    ("BSD-2-Clause", "bsd", NAME, r"(?:simplified bsd|freebsd|bsd 2 clause|2 clause bsd|two clause bsd)(?: license)?"),
    ("BSD-3-Clause", "bsd", NAME, r"(?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd|three clause bsd)(?: license)?"),
    ("BSD-4-Clause", "bsd", NAME, r"(?:original bsd|bsd 4 clause|4 clause bsd|four clause bsd)(?: license)?"),
    ("BSD", "bsd", SHORT, r"bsd(?: style)? license"),
    ("BSD", "redistribution and use", TEXT, r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("BSD-3-Clause", "neither the name", TEXT, r"neither the name of \S+(?: \S+){0,8} nor the names of its contributors"),
    ("BSD-4-Clause", "advertising materials", TEXT, r"all advertising materials mentioning features or use of this software"),
    ("Zlib", "zlib", NAME, r"zlib(?: libpng)? license"),
    ("Zlib", "altered source versions", TEXT, r"altered source versions must be plainly marked"),
    ("Unlicense", "unlicense", NAME, r"(?:the )?unlicense"),
    ("Unlicense", "public domain", TEXT, r"free and unencumbered software released into the public domain"),
    ("public-domain", "public domain", NAME, r"(?:in|into|to) the public domain"),
    ("public-domain", "gemeinfrei", NAME, r"gemeinfrei\w*"),
    ("public-domain", "domaine public", NAME, r"domaine public"),
    ("public-domain", "dominio p", NAME, r"dominio público"),
    ("WTFPL", "what the fuck", NAME, r"do what the fuck you want to public license"),
    ("WTFPL", "wtfpl", SHORT, r"wtfpl"),
    ("Beerware", "beerware", NAME, r"beerware license"),
    ("JSON", "not evil", TEXT, r"shall be used for good not evil"),
    ("OpenSSL", "openssl", NAME, r"openssl license"),
    ("Python-2.0", "python software foundation", NAME, r"python software foundation license(?: version 2)?"),
    ("Ruby", "ruby license", NAME, r"ruby license"),
    ("W3C", "w3c software", NAME, r"w3c software (?:notice and )?license"),
    ("NCSA", "illinois ncsa", NAME, r"university of illinois ncsa open source license"),
    ("MS-PL", "microsoft public", NAME, r"microsoft public license"),
    ("MS-RL", "microsoft reciprocal", NAME, r"microsoft reciprocal license"),
    ("Vim", "vim license", NAME, r"vim license"),
    ("FTL", "freetype", NAME, r"freetype (?:project )?license"),
    ("IJG", "independent jpeg", NAME, r"independent jpeg group(?: s)? license"),
    ("libtiff", "libtiff", NAME, r"libtiff license"),
    ("curl", "curl license", NAME, r"curl license"),
    ("PostgreSQL", "postgresql license", NAME, r"postgresql license"),
    ("BlueOak-1.0.0", "blue oak", NAME, r"blue oak model license"),
    ("SSPL-1.0", "server side public", NAME, r"server side public license"),
    ("BUSL-1.1", "business source", NAME, r"business source license"),
    ("Elastic-2.0", "elastic license", NAME, r"elastic license"),
    ("OGL-UK", "open government", NAME, r"open government licen[cs]e"),
    ("Etalab-2.0", "licence ouverte", NAME, r"licence ouverte"),
    ("DL-DE-BY-2.0", "datenlizenz", NAME, r"datenlizenz deutschland namensnennung"),
    ("GPL", "gpl", SHORT, r"(?:gnu )?gpl"),
    ("GPL", "general public license", NAME, r"gnu general public license"),
    ("LGPL", "lgpl", SHORT, r"(?:gnu )?lgpl"),
    ("LGPL", "lesser general public", NAME, r"(?:gnu )?lesser general public license"),
    ("AGPL", "agpl", SHORT, r"(?:gnu )?agpl"),
    ("AGPL", "affero", NAME, r"(?:gnu )?affero general public license"),
    ("GPL", "free software foundation", TEXT, r"as published by the free software foundation either version \S+(?: \S+){0,3} (?:or )?(?:at your option )?any later version"),
    ("Apache", "apache license", NAME, r"apache license"),
    ("CC-BY", "cc by", SHORT, r"cc by"),
    ("CC-BY-SA", "cc by sa", SHORT, r"cc by sa"),
    ("CC-BY-NC", "cc by nc", SHORT, r"cc by nc"),
    ("CC-BY-ND", "cc by nd", SHORT, r"cc by nd"),
    ("CC-BY-NC-SA", "cc by nc sa", SHORT, r"cc by nc sa"),
    ("CC-BY-NC-ND", "cc by nc nd", SHORT, r"cc by nc nd"),
    ("CC0", "cc0", SHORT, r"cc0"),
    ("CC", "creative commons", NAME, r"creative commons(?: licen[cs]e)?"),
    ("all-rights-reserved", "all rights reserved", NAME, r"all rights reserved"),
    ("all-rights-reserved", "alle rechte vorbehalten", NAME, r"alle rechte vorbehalten"),
    ("all-rights-reserved", "tous droits", NAME, r"tous droits réservés"),
    ("all-rights-reserved", "todos los derechos", NAME, r"todos los derechos reservados"),
    ("some-rights-reserved", "some rights reserved", NAME, r"some rights reserved"),
    ("no-rights-reserved", "no rights reserved", NAME, r"no rights reserved"),
    ("copyright", "copyright", SHORT, r"copyright (?:c )?(?:19|20)\d\d(?: (?:19|20)\d\d)*"),
    ("copyright", "©", SHORT, r"© (?:19|20)\d\d(?: (?:19|20)\d\d)*"),
    ("proprietary", "proprietary", NAME, r"proprietary and confidential"),
    ("proprietary", "without", TEXT, r"may not be (?:reproduced|copied|distributed)(?: \S+){0,12} without(?: \S+){0,4} (?:written )?permission"),
    ("warranty-disclaimer", "warrant", TEXT, r"provided as is without (?:any )?warrant(?:y|ies) of any kind"),
    ("warranty-disclaimer", "merchantability", TEXT, r"without even the implied warranty of merchantability or fitness for a particular purpose"),
]


def compiled(label: str, keyword: str, priority: int, pattern: str) -> Rule:
    return Rule(label, keyword.encode(), priority, re.compile(rb"(?<![^ ])(?:" + pattern.encode() + rb")(?![^ ])"))


# Labels of plain rules that are no names of licenses.
NO_LICENSE = {
    "public-domain", "all-rights-reserved", "some-rights-reserved", "no-rights-reserved", "copyright", "proprietary", "warranty-disclaimer",
}
TAG = "spdx license identifier"


def tag(label: str, more: str = "") -> Rule:
    """The rule of a license's machine-readable tag."""
    spelled = label.lower().replace("-", " ").replace(".", " ").replace("+", " ")
    return compiled(label, TAG, TEXT, f"{TAG} {re.escape(spelled)}{more}")


def build_rules() -> list[Rule]:
    """Every plain rule and its tag; of a versioned family, for each version: its full and short name, a grant, a tag."""
    rules = [compiled(*r) for r in PLAIN_RULES]
    rules += [tag(label) for label in sorted({r[0] for r in PLAIN_RULES} - NO_LICENSE)]
    for label, keyword, full, short, versions in VERSIONED:
        family = label.removesuffix("-{v}")
        for v in versions.split():
            # "2.0" stands as "2 0" or "2"; other versions only in full.
            number = V + v.replace(".0", "(?: 0)?").replace(".", " ")
            name = label.format(v=v)
            named = [p.replace("{v}", number).replace("{w}", V + v.replace(".", " ")) for p in (full, short)]
            both = "|".join(named)
            short_keyword = SHORT_KEYWORDS.get(family, family.lower())
            rules += [
                compiled(name, keyword, NAME, named[0]),
                compiled(name, short_keyword, SHORT, named[1]),
                compiled(name, keyword, GRANT, f"{GIVEN} (?:{both})"),
                compiled(name, short_keyword, GRANT, f"{GIVEN} (?:{both})"),
                tag(name, "(?: only)?"),
            ]
            if "GPL" in family:
                # With the grant before it, so that it holds all that a rule without "or later" finds there.
                later = r" (?:or|and)(?: \S+){0,3} (?:later|newer)(?: version)?"
                rules += [
                    compiled(f"{name}-or-later", word, GRANT, f"(?:{GIVEN} )?(?:{both}){later}") for word in (keyword, short_keyword)
                ]
                rules.append(tag(f"{name}-or-later"))
    return rules
