"""Rules that recognise licences in normalised text: lower case, words divided by single spaces.

A licence is a label, words that its names all hold, the names as one regex, and its SPDX identifier.
Every name becomes one rule per form (grant, header, bare title, refusal), every identifier one per
place where identifiers stand; the texts of licences have signatures of their own.
"""

from __future__ import annotations

from typing import NamedTuple

NO_LICENCE = ""  # the label of rules that only suppress others

LIC = "licen[cs]e"


def version(major: str, minor: str = "") -> str:
    """A version after a name: ``version 2 0``, ``v2``, ``2``; a minor number only if given."""
    return rf"(?: (?:version|ver|v|release))? v?{major}" + (rf" {minor}" if minor else "(?: 0)?")


def gnu_long(kind: str, number: str = "") -> str:
    """The long name of a GNU licence, with its version if given."""
    long = rf"(?:gnu )?{kind}general public {LIC}"
    return rf"(?:{long}(?: [al]?gpl)?(?: ?(?:version|ver|v))? ?v?{number}|version {number} of the {long})" if number else long


def gnu_short(short: str, number: str = "") -> str:
    if not number:
        return rf"(?:gnu {short}|{short} {LIC})"
    return rf"(?:gnu )?{short}(?: {LIC})?(?: ?(?:version|ver|v))? ?v?{number}"


def creative(long: str) -> str:
    return rf"creative commons {long}(?: {LIC})?(?: [1-4] [05])?(?: (?:international|unported|generic))?"


# label, word that must occur, names, words of the SPDX identifier
LICENCES = [
    ("mit", "mit", rf"(?:the )?(?:expat )?mit {LIC}", "mit"),
    ("mit", "expat", rf"expat {LIC}", ""),
    ("mit-0", "mit", rf"mit no attribution(?: {LIC})?", "mit 0"),
    ("x11", "x11", rf"(?:mit )?x11 {LIC}", "x11"),
    ("isc", "isc", rf"isc {LIC}", "isc"),
    ("0bsd", "bsd", rf"(?:zero clause bsd|bsd zero clause)(?: {LIC})?", "0bsd"),
    ("0bsd", "0bsd", rf"0bsd(?: {LIC})?", ""),
    ("bsd", "bsd", rf"(?:berkeley software distribution|bsd(?: style)?) {LIC}", ""),
    ("bsd-2-clause", "bsd", rf"(?:(?:simplified|freebsd) bsd|bsd (?:2|two) clause|(?:2|two) clause bsd)(?: {LIC})?", "bsd 2 clause"),
    ("bsd-3-clause", "bsd", rf"(?:(?:new|modified|revised) bsd|bsd (?:3|three) clause|(?:3|three) clause bsd)(?: {LIC})?", "bsd 3 clause"),
    ("bsd-4-clause", "bsd", rf"(?:(?:original|old) bsd|bsd (?:4|four) clause|(?:4|four) clause bsd)(?: {LIC})?", "bsd 4 clause"),
    ("bsd-2-clause-patent", "bsd", rf"bsd (?:2 clause )?(?:plus )?patent(?: {LIC})?", "bsd 2 clause patent"),
    ("bsd-3-clause-clear", "bsd", rf"(?:clear bsd|bsd 3 clause clear)(?: {LIC})?", "bsd 3 clause clear"),
    ("apache", "apache", rf"apache(?: software)? {LIC}", ""),
    ("apache-1", "apache", rf"apache(?: software)? {LIC}{version('1')}", "apache 1 0"),
    ("apache-1.1", "apache", rf"apache(?: software)? {LIC}{version('1', '1')}", "apache 1 1"),
    ("apache-2", "apache", rf"(?:apache(?: software)? {LIC}{version('2')}|apache 2(?: 0)?(?: {LIC})?)", "apache 2 0"),
    ("gpl", "gpl", gnu_short("gpl"), ""),
    ("gpl", "general", gnu_long(""), ""),
    ("gpl-1", "gpl", gnu_short("gpl", "1(?: 0)?"), "gpl 1 0(?: only| or later)?"),
    ("gpl-1", "general", gnu_long("", "1(?: 0)?"), ""),
    ("gpl-2", "gpl", gnu_short("gpl", "2(?: 0)?"), "gpl 2 0(?: only)?"),
    ("gpl-2", "general", gnu_long("", "2(?: 0)?"), ""),
    ("gpl-2-or-later", "gpl", gnu_short("gpl", "2(?: 0)?") + " or(?: any)? later(?: version)?", "gpl 2 0 or later"),
    ("gpl-2-or-later", "general", gnu_long("", "2(?: 0)?") + " or(?: at your option)?(?: any)? later(?: version)?", ""),
    ("gpl-3", "gpl", gnu_short("gpl", "3(?: 0)?"), "gpl 3 0(?: only)?"),
    ("gpl-3", "general", gnu_long("", "3(?: 0)?"), ""),
    ("gpl-3-or-later", "gpl", gnu_short("gpl", "3(?: 0)?") + " or(?: any)? later(?: version)?", "gpl 3 0 or later"),
    ("gpl-3-or-later", "general", gnu_long("", "3(?: 0)?") + " or(?: at your option)?(?: any)? later(?: version)?", ""),
    ("lgpl", "lgpl", gnu_short("lgpl"), ""),
    ("lgpl", "general", gnu_long("(?:lesser|library) "), ""),
    ("lgpl-2", "lgpl", gnu_short("lgpl", "2(?: 0)?"), "lgpl 2 0(?: only| or later)?"),
    ("lgpl-2", "general", gnu_long("(?:lesser|library) ", "2(?: 0)?"), ""),
    ("lgpl-2.1", "lgpl", gnu_short("lgpl", "2 1"), "lgpl 2 1(?: only| or later)?"),
    ("lgpl-2.1", "general", gnu_long("(?:lesser|library) ", "2 1"), ""),
    ("lgpl-3", "lgpl", gnu_short("lgpl", "3(?: 0)?"), "lgpl 3 0(?: only| or later)?"),
    ("lgpl-3", "general", gnu_long("(?:lesser|library) ", "3(?: 0)?"), ""),
    ("agpl", "agpl", gnu_short("agpl"), ""),
    ("agpl", "affero", rf"(?:gnu )?affero (?:general public )?{LIC}", ""),
    ("agpl-1", "affero", rf"affero general public {LIC}{version('1')}", "agpl 1 0(?: only| or later)?"),
    ("agpl-3", "agpl", gnu_short("agpl", "3(?: 0)?"), "agpl 3 0(?: only| or later)?"),
    ("agpl-3", "affero", gnu_long("affero ", "3(?: 0)?"), ""),
    ("gfdl", "documentation", rf"(?:gnu )?free documentation {LIC}", ""),
    ("gfdl-1.1", "documentation", rf"(?:gnu )?free documentation {LIC}{version('1', '1')}", "gfdl 1 1(?: only| or later)?"),
    ("gfdl-1.2", "documentation", rf"(?:gnu )?free documentation {LIC}{version('1', '2')}", "gfdl 1 2(?: only| or later)?"),
    ("gfdl-1.3", "documentation", rf"(?:gnu )?free documentation {LIC}{version('1', '3')}", "gfdl 1 3(?: only| or later)?"),
    ("mpl", "mozilla", rf"mozilla public {LIC}", ""),
    ("mpl-1", "mozilla", rf"mozilla public {LIC}{version('1')}", "mpl 1 0"),
    ("mpl-1.1", "mozilla", rf"mozilla public {LIC}{version('1', '1')}", "mpl 1 1"),
    ("mpl-2", "mozilla", rf"mozilla public {LIC}{version('2')}", "mpl 2 0"),
    ("epl", "eclipse", rf"eclipse public {LIC}", ""),
    ("epl-1", "eclipse", rf"eclipse public {LIC}{version('1')}", "epl 1 0"),
    ("epl-2", "eclipse", rf"eclipse public {LIC}{version('2')}", "epl 2 0"),
    ("edl-1", "eclipse", rf"eclipse distribution {LIC}(?:{version('1')})?", ""),
    ("cpl-1", "common", rf"common public {LIC}(?:{version('1')})?", "cpl 1 0"),
    ("cpal-1", "attribution", rf"common public attribution {LIC}(?:{version('1')})?", "cpal 1 0"),
    ("cddl-1", "development", rf"common development and distribution {LIC}(?:{version('1')})?", "cddl 1 0"),
    ("cddl-1.1", "development", rf"common development and distribution {LIC}{version('1', '1')}", "cddl 1 1"),
    ("ipl-1", "ibm", rf"ibm public {LIC}(?:{version('1')})?", "ipl 1 0"),
    ("spl-1", "sun", rf"sun public {LIC}(?:{version('1')})?", "spl 1 0"),
    ("sissl", "sun", rf"sun industry standards source {LIC}", "sissl"),
    ("npl-1.1", "netscape", rf"netscape public {LIC}(?:{version('1', '1')})?", "npl 1 1"),
    ("eupl", "european", rf"european union public {LIC}", ""),
    ("eupl-1.1", "european", rf"european union public {LIC}{version('1', '1')}", "eupl 1 1"),
    ("eupl-1.2", "european", rf"european union public {LIC}{version('1', '2')}", "eupl 1 2"),
    ("osl-3", "open", rf"open software {LIC}(?:{version('3')})?", "osl 3 0"),
    ("afl-3", "academic", rf"academic free {LIC}(?:{version('3')})?", "afl 3 0"),
    ("ecl-2", "educational", rf"educational community {LIC}(?:{version('2')})?", "ecl 2 0"),
    ("artistic-1", "artistic", rf"artistic {LIC}(?:{version('1')})?", "artistic 1 0"),
    ("artistic-2", "artistic", rf"artistic {LIC}{version('2')}", "artistic 2 0"),
    ("bsl-1", "boost", rf"boost software {LIC}(?:{version('1')})?", "bsl 1 0"),
    ("busl-1.1", "business", rf"business source {LIC}(?:{version('1', '1')})?", "busl 1 1"),
    ("sspl-1", "side", rf"server side public {LIC}(?:{version('1')})?", "sspl 1 0"),
    ("elastic-2", "elastic", rf"elastic {LIC}(?:{version('2')})?", "elastic 2 0"),
    ("polyform-nc-1", "polyform", rf"polyform noncommercial {LIC}(?:{version('1')})?", "polyform noncommercial 1 0 0"),
    ("polyform-sb-1", "polyform", rf"polyform small business {LIC}(?:{version('1')})?", "polyform small business 1 0 0"),
    ("zlib", "zlib", rf"zlib(?: libpng)? {LIC}", "zlib"),
    ("libpng", "libpng", rf"libpng {LIC}(?:{version('2')})?", "libpng(?: 2 0)?"),
    ("openssl", "openssl", rf"openssl {LIC}", "openssl"),
    ("curl", "curl", rf"curl {LIC}", "curl"),
    ("ncsa", "ncsa", rf"(?:university of illinois )?ncsa(?: open source)? {LIC}", "ncsa"),
    ("psf-2", "python", rf"python(?: software foundation)? {LIC}(?:{version('2')})?", "(?:psf|python) 2 0"),
    ("psf-2", "psf", rf"psf {LIC}(?:{version('2')})?", ""),
    ("php-3", "php", rf"php {LIC}(?:{version('3')})?", "php 3 0"),
    ("php-3.01", "php", rf"php {LIC}{version('3', '01')}", "php 3 01"),
    ("ruby", "ruby", rf"(?:the )?ruby {LIC}", "ruby"),
    ("postgresql", "postgresql", rf"postgresql {LIC}", "postgresql"),
    ("unlicense", "unlicense", r"the unlicense", "unlicense"),
    ("wtfpl", "wtfpl", rf"wtfpl(?: {LIC})?", "wtfpl"),
    ("upl-1", "universal", rf"universal permissive {LIC}(?:{version('1')})?", "upl 1 0"),
    ("ofl-1.1", "sil", rf"sil open font {LIC}(?:{version('1', '1')})?", "ofl 1 1"),
    ("ofl-1.1", "font", rf"open font {LIC}(?:{version('1', '1')})?", ""),
    ("bitstream-vera", "vera", rf"bitstream vera(?: fonts)? {LIC}", "bitstream vera"),
    ("lppl-1.3", "latex", rf"latex project public {LIC}(?:{version('1', '3[ac]?')})?", "lppl 1 3[ac]"),
    ("ms-pl", "microsoft", rf"microsoft public {LIC}", "ms pl"),
    ("ms-rl", "microsoft", rf"microsoft reciprocal {LIC}", "ms rl"),
    ("cecill", "cecill", rf"cecill(?: free software)? {LIC}(?: agreement)?", "cecill [12](?: [01])?"),
    ("cecill-b", "cecill", rf"cecill b(?: {LIC})?", "cecill b"),
    ("cecill-c", "cecill", rf"cecill c(?: {LIC})?", "cecill c"),
    ("qpl-1", "public", rf"q public {LIC}(?:{version('1')})?", "qpl 1 0"),
    ("vim", "vim", rf"vim {LIC}", "vim"),
    ("imagemagick", "imagemagick", rf"imagemagick {LIC}", "imagemagick"),
    ("ijg", "jpeg", rf"independent jpeg group {LIC}", "ijg"),
    ("unicode", "unicode", rf"unicode(?: inc)? {LIC}(?: agreement)?", "unicode(?: dfs 201[56]| 3 0| tou)?"),
    ("w3c", "w3c", rf"w3c(?: software(?: notice and)?)? {LIC}", "w3c"),
    ("json", "json", rf"json {LIC}", "json"),
    ("beerware", "beerware", rf"beerware {LIC}", "beerware"),
    ("mulan-2", "mulan", rf"mulan (?:psl|permissive software {LIC})(?:{version('2')})?", "mulanpsl 2 0"),
    ("odbl-1", "database", rf"(?:odc )?open database {LIC}(?:{version('1')})?", "odbl 1 0"),
    ("odc-by-1", "data", rf"open data commons attribution {LIC}(?:{version('1')})?", "odc by 1 0"),
    ("pddl-1", "domain", rf"(?:open data commons )?public domain dedication and {LIC}(?:{version('1')})?", "pddl 1 0"),
    ("cdla-permissive-2", "data", rf"community data {LIC} agreement permissive(?:{version('2')})?", "cdla permissive 2 0"),
    ("cdla-sharing-1", "data", rf"community data {LIC} agreement sharing(?:{version('1')})?", "cdla sharing 1 0"),
    ("ogl-uk-3", "government", rf"open government {LIC}(?:{version('3')})?", "ogl uk 3 0"),
    ("openrail", "open", rf"(?:creativeml |bigscience )?open ?rail(?: m| s)?(?: {LIC})?", "openrail"),
    ("rail", "responsible", rf"responsible ai {LIC}", ""),
    ("cc0", "cc0", r"cc0(?: 1 0)?(?: universal)?", "cc0 1 0"),
    ("cc0", "zero", r"creative commons zero(?: v?1 0)?(?: universal)?", ""),
    ("cc-by", "by", r"cc by(?: [1-4] [05])?", "cc by [1-4] [05]"),
    ("cc-by", "commons", creative("attribution"), ""),
    ("cc-by-sa", "sa", r"cc by sa(?: [1-4] [05])?", "cc by sa [1-4] [05]"),
    ("cc-by-sa", "commons", creative("attribution share ?alike"), ""),
    ("cc-by-nd", "nd", r"cc by nd(?: [1-4] [05])?", "cc by nd [1-4] [05]"),
    ("cc-by-nd", "commons", creative("attribution no ?deriv(?:ative)?s?"), ""),
    ("cc-by-nc", "nc", r"cc by nc(?: [1-4] [05])?", "cc by nc [1-4] [05]"),
    ("cc-by-nc", "commons", creative("attribution non ?commercial"), ""),
    ("cc-by-nc-sa", "sa", r"cc by nc sa(?: [1-4] [05])?", "cc by nc sa [1-4] [05]"),
    ("cc-by-nc-sa", "commons", creative("attribution non ?commercial share ?alike"), ""),
    ("cc-by-nc-nd", "nd", r"cc by nc nd(?: [1-4] [05])?", "cc by nc nd [1-4] [05]"),
    ("cc-by-nc-nd", "commons", creative("attribution non ?commercial no ?deriv(?:ative)?s?"), ""),
    ("cc", "commons", rf"creative commons(?: public)? {LIC}", ""),
]

# label, word that must occur, a passage of the licence's own text or of its customary notice
SIGNATURES = [
    ("mit", "hereby", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "substantial", r"shall be included in all copies or substantial portions of the software"),
    ("isc", "hereby", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd-3-clause", "endorse", r"may be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", "advertising", r"all advertising materials mentioning features or use of this software must display"),
    ("bsd", "redistribution", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "redistributions", r"redistributions of source code must retain the above copyright notice"),
    ("apache-2", "compliance", r"you may not use this file except in compliance with the license"),
    ("apache-2", "apache", r"www apache org licenses license 2 0"),
    ("gpl", "redistribute", r"you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl-2-or-later", "either", r"(?:gnu )?general public license as published by the free software foundation either version 2 of the license or(?: at your option)? any later version"),
    ("gpl-3-or-later", "either", r"(?:gnu )?general public license as published by the free software foundation either version 3 of the license or(?: at your option)? any later version"),
    ("lgpl", "redistribute", r"modify it under the terms of the gnu (?:lesser|library) general public license"),
    ("lgpl-2.1", "either", r"(?:gnu )?(?:lesser|library) general public license as published by the free software foundation either version 2 1 of the license"),
    ("lgpl-3", "either", r"(?:gnu )?(?:lesser|library) general public license as published by the free software foundation either version 3 of the license"),
    ("agpl", "redistribute", r"modify it under the terms of the gnu affero general public license"),
    ("agpl-3", "either", r"(?:gnu )?affero general public license as published by the free software foundation either version 3 of the license"),
    ("gpl", "gnu", r"(?:www )?gnu org licenses gpl(?: [23] 0)?"),
    ("lgpl", "gnu", r"(?:www )?gnu org licenses lgpl(?: [23] [01])?"),
    ("agpl", "gnu", r"(?:www )?gnu org licenses agpl(?: 3 0)?"),
    ("gfdl", "invariant", r"with no invariant sections no front cover texts and no back cover texts"),
    ("mpl-1.1", "mozilla", r"(?:www )?mozilla org mpl(?: mpl)? 1 1"),
    ("mpl-2", "mozilla", r"(?:this source code form is subject to the terms of the mozilla public license v 2 0|mozilla org mpl 2 0)"),
    ("epl-1", "eclipse", r"(?:www )?eclipse org legal epl v10"),
    ("epl-2", "eclipse", r"(?:www )?eclipse org legal epl (?:v20|2 0)"),
    ("cddl-1", "cddl", r"cddl(?:gf)? ?(?:v ?)?1 0"),
    ("bsl-1", "boost", r"(?:www )?boost org license 1 0"),
    ("zlib", "implied", r"provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("wtfpl", "want", r"do what the fuck you want to public licen[cs]e"),
    ("beerware", "beer", r"you can buy me a beer in return"),
    ("json", "evil", r"the software shall be used for good not evil"),
    ("ofl-1.1", "sil", r"scripts sil org ofl"),
    ("public-domain", "domain", r"(?:is|are|been) (?:hereby )?(?:released|placed|dedicated|put) (?:in|into|to) the public domain"),
    ("public-domain", "domain", r"this (?:work|file|program|text|code) is in the public domain"),
    ("cc0", "zero", r"creativecommons org publicdomain zero 1 0"),
    ("public-domain", "mark", r"creativecommons org publicdomain mark 1 0"),
    ("cc-by", "creativecommons", r"creativecommons org licen[cs]es by(?: [1-4] [05])?"),
    ("cc-by-sa", "creativecommons", r"creativecommons org licen[cs]es by sa(?: [1-4] [05])?"),
    ("cc-by-nd", "creativecommons", r"creativecommons org licen[cs]es by nd(?: [1-4] [05])?"),
    ("cc-by-nc", "creativecommons", r"creativecommons org licen[cs]es by nc(?: [1-4] [05])?"),
    ("cc-by-nc-sa", "creativecommons", r"creativecommons org licen[cs]es by nc sa(?: [1-4] [05])?"),
    ("cc-by-nc-nd", "creativecommons", r"creativecommons org licen[cs]es by nc nd(?: [1-4] [05])?"),
    ("proprietary", "confidential", r"(?:confidential and proprietary|proprietary and confidential)"),
    ("proprietary", "unauthorized", r"unauthorized (?:copying|reproduction|use|distribution)(?: of this file)?(?: via any medium)? is strictly prohibited"),
    ("proprietary", "without", r"without (?:the )?(?:express |prior |written )*(?:permission|consent) (?:of|from) the (?:publisher|copyright (?:holder|owner)|author)"),
    ("all-rights-reserved", "reserved", r"all rights (?:are )?reserved"),
    ("non-commercial", "non", r"(?:for|free for) non ?commercial (?:use|purposes)(?: only)?"),
    ("no-ai-training", "training", r"(?:may|must|shall) not be used (?:for|in) (?:the )?training (?:of )?(?:any )?(?:ai|artificial intelligence|machine learning|language) (?:models?|systems?)"),
    ("eula", "user", r"end user licen[cs]e agreement"),
    ("source-available", "available", r"source available licen[cs]e"),
    ("dual", "dual", r"dual licensed"),
    ("copyleft", "copyleft", r"copyleft(?:ed)? licen[cs]e"),
    (NO_LICENCE, "driv", r"driving licen[cs]e|drivers? licen[cs]e"),
    (NO_LICENCE, "poetic", r"poetic licen[cs]e"),
    (NO_LICENCE, "artistic", r"artistic licen[cs]e (?:in|of|with|to)"),
]

GIVEN = (
    r"(?:licensed|licenced|released|distributed|published|available|provided|shared|covered|governed|issued|"
    r"offered|redistributed)(?: for free| freely)? (?:under|by|with|according to) (?:the )?(?:terms of )?(?:the |a |an )?"
)
REFUSED = rf"(?:not|never|no longer) (?:be )?(?:{GIVEN})"
HEADER = rf"(?:project |code |content |software |data )?{LIC}(?: type)?(?: is)? (?:the )?"
PLACES = {"spdx": r"spdx licen[cs]e identifier {}", "org": r"(?:spdx|opensource) org licen[cs]es {}", "classifier": r"osi approved {}"}


class Rule(NamedTuple):
    """``priority``: 4 refusals and exceptions, 3 identifiers, 2 grants and texts, 1 headers, 0 names."""

    label: str
    keywords: tuple[str, ...]
    pattern: str
    priority: int
    weight: float


def all_rules() -> list[Rule]:
    rules = []
    for label, word, name, identifier in LICENCES:
        for place, form in PLACES.items():
            if identifier and place != "classifier":
                rules.append(Rule(label, (place,), form.format(f"(?:{identifier})"), 3, 0.99))
        rules += [
            Rule(NO_LICENCE, (word,), REFUSED + name, 4, 0.0),
            Rule(label, (word,), PLACES["classifier"].format(name), 3, 0.97),
            Rule(label, (word,), GIVEN + name, 2, 0.95),
            Rule(label, (word,), HEADER + name, 1, 0.8),
            Rule(label, (word,), name, 0, 0.6),
        ]
    for label, word, passage in SIGNATURES:
        priority = 2 if label else 4
        rules.append(Rule(label, (word,), passage, priority, 0.9 if label else 0.0))
    return rules
