"""Signature rules for license texts: hand-written patterns over plain words.

Patterns see a text as lower-case words joined by one space (digits, a-z and letters beyond
ASCII are words; all else is a gap), so `v2.0` reads `v2 0` and `apache-2.0` reads
`apache 2 0`. A rule is (label, priority, keyword, pattern): the pattern is tried only in
texts that hold the keyword. Rules are in order; with equal priority the earlier one wins.

Fixed values: names, identifiers and phrases of public licenses.
"""

from __future__ import annotations

#: label, names, versions. Each name gives a title rule, each version its own rules.
FAMILIES: list[tuple[str, tuple[str, ...], tuple[str, ...]]] = [
    ("agpl", (r"gnu affero general public licen[cs]e", r"affero general public licen[cs]e", r"agpl"), ("1.0", "3.0")),
    ("lgpl", (r"gnu lesser general public licen[cs]e", r"gnu library general public licen[cs]e", r"lgpl"), ("2.0", "2.1", "3.0")),
    ("gpl", (r"gnu general public licen[cs]e", r"general public licen[cs]e", r"gpl"), ("1.0", "2.0", "3.0")),
    ("gfdl", (r"gnu free documentation licen[cs]e", r"gfdl"), ("1.1", "1.2", "1.3")),
    ("apache", (r"apache software licen[cs]e", r"apache licen[cs]e"), ("1.0", "1.1", "2.0")),
    ("mpl", (r"mozilla public licen[cs]e", r"mpl"), ("1.0", "1.1", "2.0")),
    ("epl", (r"eclipse public licen[cs]e", r"epl"), ("1.0", "2.0")),
    ("cddl", (r"common development and distribution licen[cs]e", r"cddl"), ("1.0", "1.1")),
    ("cpl", (r"common public licen[cs]e", r"cpl"), ("1.0",)),
    ("eupl", (r"european union public licen[cs]e", r"eupl"), ("1.0", "1.1", "1.2")),
    ("artistic", (r"artistic licen[cs]e",), ("1.0", "2.0")),
    ("afl", (r"academic free licen[cs]e", r"afl"), ("1.1", "1.2", "2.0", "2.1", "3.0")),
    ("osl", (r"open software licen[cs]e", r"osl"), ("1.0", "1.1", "2.0", "2.1", "3.0")),
    ("bsl", (r"boost software licen[cs]e",), ("1.0",)),
    ("busl", (r"business source licen[cs]e", r"busl"), ("1.0", "1.1")),
    ("sspl", (r"server side public licen[cs]e", r"sspl"), ("1.0",)),
    ("ofl", (r"sil open font licen[cs]e", r"open font licen[cs]e"), ("1.0", "1.1")),
    ("odbl", (r"open database licen[cs]e", r"odbl"), ("1.0",)),
    ("python", (r"python software foundation licen[cs]e", r"psf licen[cs]e"), ("2.0",)),
    ("php", (r"php licen[cs]e",), ("3.0", "3.01")),
    ("zpl", (r"zope public licen[cs]e", r"zpl"), ("2.0", "2.1")),
    ("ms-pl", (r"microsoft public licen[cs]e",), ()),
    ("ms-rl", (r"microsoft reciprocal licen[cs]e",), ()),
    ("cecill", (r"cecill free software licen[cs]e", r"cecill"), ("1.0", "1.1", "2.0", "2.1")),
    ("lppl", (r"latex project public licen[cs]e", r"lppl"), ("1.0", "1.1", "1.2", "1.3")),
    ("openssl", (r"openssl licen[cs]e",), ()),
    ("unlicense", (r"the unlicen[cs]e",), ()),
    ("wtfpl", (r"do what the fuck you want to public licen[cs]e", r"wtfpl"), ("1.0", "2.0")),
    ("zlib", (r"zlib licen[cs]e", r"zlib libpng licen[cs]e"), ()),
    ("isc", (r"isc licen[cs]e", r"internet systems consortium licen[cs]e"), ()),
    ("mit", (r"mit licen[cs]e", r"expat licen[cs]e", r"x11 licen[cs]e"), ()),
    ("bsd", (r"bsd licen[cs]e", r"berkeley software distribution licen[cs]e"), ()),
    ("ncsa", (r"university of illinois ncsa open source licen[cs]e", r"ncsa open source licen[cs]e"), ()),
    ("upl", (r"universal permissive licen[cs]e",), ("1.0",)),
    ("vim", (r"vim licen[cs]e",), ()),
    ("ruby", (r"ruby licen[cs]e",), ()),
    ("postgresql", (r"postgresql licen[cs]e",), ()),
    ("mulan", (r"mulan permissive software licen[cs]e", r"mulan psl"), ("1", "2")),
    ("elastic", (r"elastic licen[cs]e",), ("1.0", "2.0")),
    ("commons-clause", (r"commons clause",), ("1.0",)),
    ("polyform", (r"polyform noncommercial licen[cs]e", r"polyform small business licen[cs]e"), ("1.0",)),
    ("rail", (r"bigscience rail licen[cs]e", r"responsible ai licen[cs]e", r"open rail"), ("1.0",)),
    ("beerware", (r"beer ware licen[cs]e", r"beerware licen[cs]e"), ()),
    ("fair", (r"fair licen[cs]e",), ()),
    ("intel", (r"intel open source licen[cs]e",), ()),
    ("ibm-pl", (r"ibm public licen[cs]e",), ("1.0",)),
    ("qpl", (r"q public licen[cs]e",), ("1.0",)),
    ("npl", (r"netscape public licen[cs]e",), ("1.0", "1.1")),
    ("spl", (r"sun public licen[cs]e",), ("1.0",)),
    ("rpl", (r"reciprocal public licen[cs]e",), ("1.1", "1.5")),
    ("apsl", (r"apple public source licen[cs]e",), ("1.0", "1.1", "1.2", "2.0")),
    ("ecl", (r"educational community licen[cs]e",), ("1.0", "2.0")),
    ("efl", (r"eiffel forum licen[cs]e",), ("1", "2")),
    ("w3c", (r"w3c software notice and licen[cs]e", r"w3c licen[cs]e"), ()),
    ("oclc", (r"oclc research public licen[cs]e",), ("2.0",)),
    ("cua", (r"cua office public licen[cs]e",), ("1.0",)),
    ("nasa", (r"nasa open source agreement",), ("1.3",)),
    ("nokia", (r"nokia open source licen[cs]e",), ()),
    ("sleepycat", (r"sleepycat licen[cs]e",), ()),
    ("condor", (r"condor public licen[cs]e",), ("1.1",)),
    ("simpl", (r"simple public licen[cs]e",), ("2.0",)),
]

#: Parts of Creative Commons names, as words and as letters.
CC_PARTS = {
    "by": r"attribution",
    "by-sa": r"attribution share ?alike",
    "by-nd": r"attribution no ?deriv(?:ative)?s?(?: works)?",
    "by-nc": r"attribution non ?commercial",
    "by-nc-sa": r"attribution non ?commercial share ?alike",
    "by-nc-nd": r"attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?",
}
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")

#: Phrases that tell a license or a notice without its name.
PHRASES: list[tuple[str, int, str, str]] = [
    ("mit", 60, "permission is hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", 50, "the above copyright notice and this permission notice", r"the above copyright notice and this permission notice shall be included"),
    ("mit", 40, "provided as is", r"the software is provided as is without warranty of any kind"),
    ("bsd", 60, "redistributions of source code", r"redistributions of source code must retain the above copyright notice"),
    ("bsd", 60, "redistributions in binary form", r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsd", 55, "redistribution and use in source", r"redistribution and use in source and binary forms with or without modification"),
    ("bsd", 50, "neither the name", r"neither the name of .{1,80}? nor the names of its contributors may be used"),
    ("isc", 60, "permission to use copy modify", r"permission to use copy modify and or distribute this software for any purpose"),
    ("apache", 60, "licensed under the apache", r"licensed under the apache licen[cs]e"),
    ("apache", 50, "unless required by applicable law", r"unless required by applicable law or agreed to in writing software"),
    ("gpl", 60, "free software you can redistribute", r"this program is free software you can redistribute it and or modify it"),
    ("gpl", 50, "free software foundation", r"under the terms of the gnu .{1,40}? as published by the free software foundation"),
    ("gpl", 40, "you should have received a copy", r"you should have received a copy of the gnu general public licen[cs]e"),
    ("mpl", 60, "subject to the terms of the mozilla", r"this source code form is subject to the terms of the mozilla public licen[cs]e"),
    ("unlicense", 60, "free and unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("zlib", 60, "altered source versions", r"altered source versions must be plainly marked as such"),
    ("zlib", 50, "origin of this software", r"the origin of this software must not be misrepresented"),
    ("ofl", 60, "reserved font name", r"with reserved font name"),
    ("public-domain", 40, "public domain", r"(?:released|placed|dedicated) (?:in|into|to) the public domain"),
    ("public-domain", 30, "public domain", r"(?:this work|this text) is in the public domain"),
    ("cc0", 60, "cc0", r"cc0(?: 1 0)?(?: universal)?"),
    ("cc0", 50, "no rights reserved", r"no rights reserved"),
    ("cc", 30, "creative commons", r"(?:under|by) (?:a|the) creative commons licen[cs]e"),
    ("proprietary", 50, "proprietary", r"proprietary and confidential"),
    ("proprietary", 45, "unauthori", r"unauthori[sz]ed (?:copying|reproduction|distribution|use) .{0,60}?(?:is )?(?:strictly )?prohibited"),
    ("proprietary", 40, "reproduced", r"may not be reproduced .{0,60}?without .{0,40}?permission"),
    ("proprietary", 40, "redistributed", r"may not be published broadcast rewritten or redistributed"),
    ("reserved", 35, "some rights reserved", r"some rights reserved"),
    ("copyright", 20, "copyright", r"copyright (?:c |© ?)?(?:19|20)\d\d"),
    ("copyright", 15, "copyright", r"copyright (?:holders?|owners?|notice)"),
    ("license", 10, "licensed under", r"licensed under(?: the terms of)? the \w+(?: \w+){0,3}? licen[cs]e"),
    ("license", 5, "terms of use", r"terms of use"),
]

#: Sentences of full license texts and of the notices that go with them.
FULL_TEXTS: list[tuple[str, int, str, str]] = [
    ("gpl-2.0", 78, "designed to take away your freedom", r"the licen[cs]es for most software are designed to take away your freedom to share and change it"),
    ("gpl-3.0", 78, "free copyleft licen", r"the gnu general public licen[cs]e is a free copyleft licen[cs]e for software and other kinds of works"),
    ("agpl-3.0", 79, "cooperation with the community", r"specifically designed to ensure cooperation with the community in the case of network server software"),
    ("agpl-3.0", 78, "remote network interaction", r"remote network interaction use with the gnu general public licen[cs]e"),
    ("lgpl-2.1", 78, "first released version of the lesser", r"this is the first released version of the lesser gpl"),
    ("lgpl-2.0", 78, "first released version of the library", r"this is the first released version of the library gpl"),
    ("lgpl-3.0", 78, "incorporates the terms and conditions", r"this version of the gnu lesser general public licen[cs]e incorporates the terms and conditions of version 3"),
    ("gpl", 55, "terms and conditions for copying", r"terms and conditions for copying distribution and modification"),
    ("gpl", 30, "any later version", r"or at your option any later version"),
    ("gpl", 45, "without any warranty", r"will be useful but without any warranty without even the implied warranty of merchantability"),
    ("gfdl", 60, "copy distribute and or modify this document", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation"),
    ("gfdl", 50, "no invariant sections", r"with no invariant sections"),
    ("fsf-all-permissive", 60, "permitted in any medium", r"copying and distribution of this file with or without modification are permitted in any medium without royalty"),
    ("apache-2.0", 60, "terms and conditions for use reproduction", r"terms and conditions for use reproduction and distribution"),
    ("apache-2.0", 78, "hereby grants to you a perpetual", r"each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable"),
    ("apache-1.1", 70, "apache software foundation", r"this product includes software developed by the apache software foundation"),
    ("mpl-2.0", 78, "covered software is provided", r"covered software is provided under this licen[cs]e on an as is basis"),
    ("mpl", 60, "contents of this file are subject", r"the contents of this file are subject to the mozilla public licen[cs]e"),
    ("cddl", 60, "contents of this file are subject", r"the contents of this file are subject to the terms of the common development and distribution licen[cs]e"),
    ("epl", 60, "accompanying", r"(?:the|this) accompanying (?:program is|materials are) (?:provided|made available) under the terms of (?:this|the) eclipse public licen[cs]e"),
    ("cpl", 60, "accompanying program", r"the accompanying program is provided under the terms of this common public licen[cs]e"),
    ("eupl", 50, "applies to the work", r"this european union public licen[cs]e .{0,40}?applies to the work"),
    ("bsd-4-clause", 78, "advertising materials", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("bsd", 45, "in no event shall the", r"in no event shall the (?:copyright (?:holders?|owner)|regents|authors?) (?:or contributors )?be liable for any direct indirect incidental"),
    ("mit", 45, "in no event shall the authors", r"in no event shall the authors or copyright holders be liable for any claim damages or other liability"),
    ("mit", 55, "without limitation the rights to use", r"without limitation the rights to use copy modify merge publish distribute sublicen[cs]e and or sell copies"),
    ("bsl-1.0", 78, "to any person or organization", r"free of charge to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("ncsa", 70, "deal with the software without restriction", r"to deal with the software without restriction"),
    ("isc", 55, "disclaims all warranties", r"the author disclaims all warranties with regard to this software"),
    ("0bsd", 60, "for any purpose with or without fee", r"distribute this software for any purpose with or without fee is hereby granted"),
    ("hpnd", 60, "hereby granted without fee", r"for any purpose is hereby granted without fee"),
    ("postgresql", 70, "without a written agreement", r"without fee and without a written agreement is hereby granted"),
    ("zlib", 55, "held liable", r"in no event will the authors? be held liable for any damages arising from the use of this software"),
    ("unlicense", 60, "anyone is free to copy", r"anyone is free to copy modify publish use compile sell or distribute this software"),
    ("json", 70, "used for good not evil", r"the software shall be used for good not evil"),
    ("beerware", 60, "whatever you want with this stuff", r"you can do whatever you want with this stuff"),
    ("wtfpl", 60, "you just do what the fuck", r"you just do what the fuck you want to"),
    ("artistic", 60, "intent of this document", r"the intent of this document is to state the conditions under which a package may be copied"),
    ("artistic-2.0", 70, "standard version", r"you are permitted to use the standard version and create and use modified versions"),
    ("python", 60, "psf is making python available", r"psf is making python available to licensee on an as is basis"),
    ("openssl", 60, "openssl project", r"this product includes software developed by the openssl project"),
    ("php", 60, "php software", r"this product includes php software freely available from"),
    ("ofl", 60, "goals of the open font", r"the goals of the open font licen[cs]e"),
    ("unicode", 60, "unicode", r"unicode inc licen[cs]e agreement(?: data files and software)?"),
    ("curl", 60, "curl", r"curl and libcurl are licen[cs]ed under"),
    ("busl", 70, "non production use", r"create derivative works redistribute and make non production use of the licen[cs]ed work"),
    ("sspl", 70, "available to third parties as a service", r"make the functionality of the program or a modified version available to third parties as a service"),
    ("elastic-2.0", 70, "hosted or managed service", r"you may not provide the software to third parties as a hosted or managed service"),
    ("commons-clause", 70, "the right to sell the software", r"does not grant to you the right to sell the software"),
    ("rail", 55, "use based restrictions", r"use based restrictions"),
    ("llama", 70, "llama", r"llama (?:2|3|3 1|3 2|3 3|4) community licen[cs]e(?: agreement)?"),
    ("gemma", 65, "gemma terms of use", r"gemma terms of use"),
    ("cc0", 60, "associated a work with this deed", r"the person who associated a work with this deed has dedicated the work to the public domain"),
    ("cc", 45, "redistribute the material in any medium", r"copy and redistribute the material in any medium or format"),
    ("cc", 45, "you must give appropriate credit", r"you must give appropriate credit provide a link to the licen[cs]e"),
    ("cc-nc", 45, "the material for commercial purposes", r"you may not use the material for commercial purposes"),
    ("cc-sa", 45, "remix transform or build upon", r"if you remix transform or build upon the material you must distribute your contributions under the same licen[cs]e"),
    ("cc-nd", 45, "remix transform or build upon", r"if you remix transform or build upon the material you may not distribute the modified material"),
    ("public-domain", 45, "public domain mark", r"public domain mark(?: 1 0)?"),
    ("ogl", 65, "open government licen", r"open government licen[cs]e(?: v?(?:1|2|3)(?: 0)?)?"),
    ("etalab", 60, "etalab", r"etalab (?:open )?licen[cs]e(?: 2 0)?"),
    ("odc-by", 65, "open data commons attribution", r"open data commons attribution licen[cs]e"),
    ("odbl", 66, "open data commons open database", r"open data commons open database licen[cs]e"),
    ("pddl", 65, "public domain dedication and licen", r"public domain dedication and licen[cs]e"),
    ("cdla-permissive", 65, "community data licen", r"community data licen[cs]e agreement permissive(?: version)?(?: (?:1|2) 0)?"),
    ("cdla-sharing", 65, "community data licen", r"community data licen[cs]e agreement sharing(?: version)?(?: 1 0)?"),
    ("free-art", 65, "free art licen", r"free art licen[cs]e(?: 1 3)?"),
    ("gutenberg", 65, "project gutenberg", r"project gutenberg (?:tm )?licen[cs]e"),
    ("crown", 40, "crown copyright", r"crown copyright"),
]

#: What keeps a text from being used freely, or says on what terms a page may be read.
TERMS: list[tuple[str, int, str, str]] = [
    ("proprietary", 50, "remains the property of", r"all information contained herein is and remains the property of"),
    ("proprietary", 45, "licensed not sold", r"(?:is|are) licensed not sold"),
    ("proprietary", 45, "reverse engineer", r"(?:may|shall|must) not (?:modify )?reverse engineer(?:ed)? decompile(?:d)? (?:or )?disassemble(?:d)?"),
    ("proprietary", 40, "trade secret", r"(?:contains|constitutes?) (?:valuable )?trade secrets?"),
    ("proprietary", 40, "internal use only", r"for internal use only"),
    ("proprietary", 40, "may be reproduced", r"no part of this (?:publication|book|document|work|website|site|article) may be reproduced"),
    ("proprietary", 35, "written", r"without (?:the )?(?:prior |express |explicit )?(?:prior )?written (?:permission|consent) of"),
    ("proprietary", 35, "do not", r"(?:please )?do not (?:copy|redistribute|reproduce|repost) without permission"),
    ("permission", 30, "permission", r"(?:used|reprinted|reproduced|republished|reposted) with (?:the )?permission"),
    ("permission", 30, "by permission", r"(?:used|reprinted|reproduced) by permission"),
    ("non-commercial", 35, "commercial use only", r"(?:personal |private )?(?:and |or )?non ?commercial use only"),
    ("non-commercial", 35, "commercial use", r"not for commercial use"),
    ("non-commercial", 35, "personal use only", r"for (?:your )?personal use only"),
    ("non-commercial", 30, "only", r"for (?:research|educational) (?:and (?:research|educational) )?(?:use|purposes) only"),
    ("no-derivatives", 30, "derivative works", r"(?:may|must|shall) not create derivative works"),
    ("attribution", 25, "attribution", r"attribution (?:is )?required"),
    ("share-alike", 25, "share", r"share alike"),
    ("terms", 10, "terms of service", r"(?:agree to|subject to|accept) (?:our|the|these) terms of service"),
    ("terms", 10, "terms and conditions", r"(?:agree to|subject to|accept) (?:our|the|these) terms and conditions"),
    ("trademark", 10, "trademarks", r"(?:all )?(?:other )?trademarks (?:and .{1,40}? )?are (?:the )?property of their respective owners"),
    ("copyright", 25, "copyrighted", r"(?:this|the) (?:work|text|material|content|article|page) is copyrighted"),
    ("copyright", 25, "protected by", r"protected by (?:international )?copyright"),
    ("fair-use", 20, "fair use", r"(?:under|as|constitutes?) fair use"),
    ("royalty-free", 20, "royalty free", r"royalty free licen[cs]e"),
]

#: How the number of clauses of a BSD license is written.
BSD_CLAUSES: list[tuple[str, int, str, str]] = [
    ("bsd-4-clause", 80, "clause", r"(?:bsd )?(?:4|four) clause bsd(?: licen[cs]e)?"),
    ("bsd-4-clause", 80, "bsd", r"bsd (?:4|four) clause(?: licen[cs]e)?"),
    ("bsd-4-clause", 75, "bsd", r"(?:original|old) bsd licen[cs]e"),
    ("bsd-3-clause", 80, "clause", r"(?:3|three) clause bsd(?: licen[cs]e)?"),
    ("bsd-3-clause", 80, "bsd", r"bsd (?:3|three) clause(?: licen[cs]e)?"),
    ("bsd-3-clause", 75, "bsd", r"(?:new|modified|revised) bsd(?: licen[cs]e)?"),
    ("bsd-2-clause", 80, "clause", r"(?:2|two) clause bsd(?: licen[cs]e)?"),
    ("bsd-2-clause", 80, "bsd", r"bsd (?:2|two) clause(?: licen[cs]e)?"),
    ("bsd-2-clause", 75, "bsd", r"simplified bsd(?: licen[cs]e)?"),
    ("bsd-2-clause", 75, "freebsd licen", r"freebsd licen[cs]e"),
    ("bsd-1-clause", 80, "bsd", r"bsd (?:1|one) clause(?: licen[cs]e)?"),
    ("0bsd", 80, "0bsd", r"0bsd"),
    ("0bsd", 80, "bsd", r"(?:bsd zero clause|zero clause bsd)(?: licen[cs]e)?"),
]

#: Short names that mean a license wherever they stand, and their versions.
SHORT = {
    "agpl": ("1.0", "3.0"),
    "lgpl": ("2.0", "2.1", "3.0"),
    "gpl": ("1.0", "2.0", "3.0"),
    "gfdl": ("1.1", "1.2", "1.3"),
    "cddl": ("1.0", "1.1"),
    "eupl": ("1.0", "1.1", "1.2"),
    "cecill": ("1.0", "2.0", "2.1"),
    "wtfpl": ("2.0",),
    "odbl": ("1.0",),
    "sspl": ("1.0",),
    "busl": ("1.1",),
    "lppl": ("1.3",),
}

#: Short names that are other words too: they count beside `licensed` or `license` alone.
BESIDE_LICENSE: list[tuple[str, str]] = [
    ("mit", "mit"), ("mit", "expat"), ("mit", "x11"), ("isc", "isc"), ("bsd", "bsd"), ("apache", "apache"),
    ("apache", "asl"), ("zlib", "zlib"), ("artistic", "artistic"), ("bsl", "boost"), ("python", "psf"),
    ("ncsa", "ncsa"), ("upl", "upl"), ("mpl", "mpl"), ("epl", "epl"), ("cpl", "cpl"), ("afl", "afl"),
    ("osl", "osl"), ("zpl", "zpl"), ("ofl", "ofl"), ("unlicense", "unlicense"), ("cc0", "cc0"),
]

#: Versions of such names that tell the license by themselves.
VERSIONED: list[tuple[str, int, str, str]] = [
    ("apache-2.0", 70, "apache", r"apache v?2 0"),
    ("apache-2.0", 72, "apache", r"apache v?2(?: 0)? licen[cs]ed?"),
    ("apache-2.0", 70, "apache2 licen", r"apache2 licen[cs]ed?"),
    ("apache-2.0", 70, "asl", r"asl ?v?2(?: 0)?"),
    ("apache-2.0", 70, "alv2", r"alv2"),
    ("mpl-2.0", 70, "mplv2", r"mplv2(?: 0)?"),
    ("mpl-1.1", 70, "mplv1", r"mplv1 1"),
    ("epl-2.0", 70, "eplv2", r"eplv2(?: 0)?"),
    ("epl-1.0", 70, "eplv1", r"eplv1(?: 0)?"),
    ("mit-0", 75, "mit", r"mit (?:0|no attribution|zero)"),
]

GRANTED = r"(?:(?:dual |re)?licen[cs]ed|released|distributed|published|available|provided|open sourced)"


def version_words(version: str) -> str:
    """How a version reads as words; a closing zero may be missing."""
    major, _, minor = version.partition(".")
    if not minor:
        return rf"v?{major}"
    return rf"v?{major}(?: {minor})?" if minor == "0" else rf"v?{major} {minor}"


def anchor(name: str) -> str:
    """The longest plain run of a pattern: what must be in a text for it to match."""
    runs, run, depth = [], "", 0
    for c in name.replace("licen[cs]e", "licen"):
        if c in "([":
            depth += 1
        if depth or c in "?*+.{}|\\":
            run = run[:-1] if c == "?" else run
            runs.append(run)
            run = ""
        else:
            run += c
        if c in ")]":
            depth -= 1
    return max([*runs, run], key=len).strip()


def build() -> list[tuple[str, int, str, str]]:
    """All rules in order, the special ones before the general ones."""
    rules = [*PHRASES, *FULL_TEXTS, *TERMS, *BSD_CLAUSES, *VERSIONED]
    for name, versions in SHORT.items():
        rules.append((name, 45, name, rf"(?:gnu )?{name}"))
        rules += [(f"{name}-{v}", 76, name, rf"{name}{version_words(v)}") for v in versions]
    for label, name in BESIDE_LICENSE:
        rules.append((label, 58, f"under {name}", rf"{GRANTED} under {name}"))
        rules.append((label, 58, f"the {name}", rf"{GRANTED} under (?:the terms of )?the {name}"))
        rules.append((label, 56, f"{name} licen", rf"{name} licen[cs]ed"))
        rules.append((label, 54, f"license {name}", rf"license {name}"))
        rules.append((f"{label}-like", 52, name, rf"{name} (?:style|like|type) licen[cs]e"))
    for parts, words in CC_PARTS.items():
        short = parts.replace("-", " ")
        for v in CC_VERSIONS:
            rules.append((f"cc-{parts}-{v}", 90, "cc", rf"cc {short} {version_words(v)}"))
            rules.append((f"cc-{parts}-{v}", 85, "creative commons", rf"creative commons {words} {version_words(v)}"))
        rules.append((f"cc-{parts}", 75, "cc", rf"cc {short}"))
        rules.append((f"cc-{parts}", 70, "creative commons", rf"creative commons {words}"))
    for label, names, versions in FAMILIES:
        for name in names:
            for v in versions:
                rules.append((f"{label}-{v}", 80, anchor(name), rf"{name}(?: version)? {version_words(v)}"))
            if " " in name:
                rules.append((label, 65, anchor(name), rf"(?:the )?{name}"))
                rules += [
                    (f"{label}-{v}", 82, anchor(name), rf"version {version_words(v)} of the {name}") for v in versions
                ]
        for v in versions:
            tag = f"{label} {version_words(v)}(?: only| or later)?"
            rules.append((f"{label}-{v}", 95, "spdx license identifier", rf"spdx license identifier {tag}"))
        rules.append((label, 93, "spdx license identifier", rf"spdx license identifier {label.replace('-', ' ')}"))
    return rules
