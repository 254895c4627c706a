"""License scans (operator 10), with DataFrame functions only.

A text is lower-cased (A-Z) and its words joined by single spaces. Ordered signature rules (regular expressions over
that form, matching whole words) run only on texts that hold one of the rule's keywords. A detection is a range of words.
One that lies inside another's is suppressed when the other has the higher priority, or the same priority and is
longer, or has the same range and comes first. Every step takes time in proportion to the text's length.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The base phrases of the contract and their labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))


@dataclass(frozen=True)
class Signature:
    """A text that ``pattern`` matches holds one of ``keywords`` at the start of a word; more of ``priority`` wins."""

    label: str
    keywords: tuple[str, ...]
    pattern: str
    priority: int
    confidence: float


# What licenses, notices and warranty lines say, in the words that the scan sees: label, keyword, pattern.
GRANTS = """
gpl-2-or-later | free software you can | is free software you can redistribute it and or modify it under the terms of the gnu general public licen[sc]e as published by the free software foundation either version 2 of the licen[sc]e or at your option any later version
gpl-3-or-later | free software you can | is free software you can redistribute it and or modify it under the terms of the gnu general public licen[sc]e as published by the free software foundation either version 3 of the licen[sc]e or at your option any later version
gpl-2-only | free software you can | is free software you can redistribute it and or modify it under the terms of the gnu general public licen[sc]e version 2(?: only)? as published by the free software foundation
gpl-3-only | free software you can | is free software you can redistribute it and or modify it under the terms of the gnu general public licen[sc]e version 3(?: only)? as published by the free software foundation
gpl | free software you can | is free software you can redistribute it and or modify it under the terms of the gnu general public licen[sc]e
lgpl-2-or-later | free software you can | is free software you can redistribute it and or modify it under the terms of the gnu library general public licen[sc]e as published by the free software foundation either version 2 of the licen[sc]e or at your option any later version
lgpl-2.1-or-later | free software you can | is free software you can redistribute it and or modify it under the terms of the gnu lesser general public licen[sc]e as published by the free software foundation either version 2 1 of the licen[sc]e or at your option any later version
lgpl-3-or-later | free software you can | is free software you can redistribute it and or modify it under the terms of the gnu lesser general public licen[sc]e as published by the free software foundation either version 3 of the licen[sc]e or at your option any later version
lgpl | free software you can | is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public licen[sc]e
agpl-3-or-later | free software you can | is free software you can redistribute it and or modify it under the terms of the gnu affero general public licen[sc]e as published by the free software foundation either version 3 of the licen[sc]e or at your option any later version
agpl | free software you can | is free software you can redistribute it and or modify it under the terms of the gnu affero general public licen[sc]e
gfdl | permission is granted to copy | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[sc]e
gfdl | with no invariant | with no invariant sections no front cover texts and no back cover texts
gpl-2-exception-autoconf | as a special exception to | as a special exception to the gnu general public licen[sc]e if you distribute this file as part of a program that contains a configuration script generated by autoconf
gpl-2-exception-bison | as a special exception you | as a special exception you may create a larger work that contains part or all of the bison parser skeleton
gpl-2-exception-classpath | as a special exception the | as a special exception the copyright holders of this library give you permission to link this library with independent modules to produce an executable
apache-2 | licensed under the apache | licensed under the apache licen[sc]e version 2 0 the licen[sc]e you may not use this file except in compliance with the licen[sc]e
apache-2 | you may obtain a copy | you may obtain a copy of the licen[sc]e at (?:http|https) www apache org licen[sc]es licen[sc]e 2 0
apache-2 | licenses this file;licences this file | licen[sc]es this file to you under the apache licen[sc]e version 2 0
apache-2 | licensed to the apache | licensed to the apache software foundation asf under one or more contributor licen[sc]e agreements
apache-2 | each contributor hereby | subject to the terms and conditions of this licen[sc]e each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable except as stated in this section patent licen[sc]e
apache-2 | grant of copyright | grant of copyright licen[sc]e subject to the terms and conditions of this licen[sc]e each contributor hereby grants to you
apache-1.1 | this product includes software | this product includes software developed by the apache software foundation
apache-1.1 | the names apache | the names apache and apache software foundation must not be used to endorse or promote products derived from this software
mit | permission is hereby granted | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction
mit | the above copyright | the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
mit-0 | permission is hereby granted | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so the software is provided as is
mit-modern | permission is hereby granted | permission is hereby granted without written agreement and without licen[sc]e or royalty fees to use copy modify and distribute this software
x11 | except as contained | except as contained in this notice the name of the x consortium shall not be used in advertising
isc | permission to use | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies
0bsd | permission to use | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
hpnd | permission to use | permission to use copy modify and distribute this software and its documentation for any purpose and without fee is hereby granted
bsd | redistribution and use | redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
bsd | redistributions of source | redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
bsd | redistributions in binary | redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation
bsd-3-clause | neither the name | neither the names? of .{1,80}? nor the names of its contributors may be used to endorse or promote products derived from this software
bsd-3-clause | the name of the author | the name of the author may not be used to endorse or promote products derived from this software without specific prior written permission
bsd-4-clause | all advertising materials | all advertising materials mentioning features or use of this software must display the following acknowledge?ment
bsd-3-clause-clear | no express or implied licenses | no express or implied licenses to any party s patent rights are granted by this licen[sc]e
mpl-2 | subject to the terms of the mozilla | this source code form is subject to the terms of the mozilla public licen[sc]e v 2 0
mpl-2 | if a copy of the mpl | if a copy of the mpl was not distributed with this file you can obtain one at
mpl-2 | incompatible with secondary | this source code form is incompatible with secondary licen[sc]es as defined by the mozilla public licen[sc]e v 2 0
mpl-1.1 | the contents of this file | the contents of this file are subject to the mozilla public licen[sc]e version 1 1
mpl-1 | the contents of this file | the contents of this file are subject to the mozilla public licen[sc]e version 1 0
npl-1.1 | the contents of this file | the contents of this file are subject to the netscape public licen[sc]e version 1 1
cddl-1 | the contents of this file | the contents of this file are subject to the terms of the common development and distribution licen[sc]e
epl-1 | this program and the accompanying | this program and the accompanying materials are made available under the terms of the eclipse public licen[sc]e v ?1 0
epl-2 | this program and the accompanying | this program and the accompanying materials are made available under the terms of the eclipse public licen[sc]e v ?2 0
cpl-1 | the accompanying program | the accompanying program is provided under the terms of this common public licen[sc]e
ipl-1 | the accompanying program | the accompanying program is provided under the terms of this ibm public licen[sc]e
eupl-1.2 | licensed under the eupl | licensed under the eupl version 1 2 or as soon they will be approved by the european commission
eupl-1.1 | licensed under the eupl | licensed under the eupl version 1 1 or as soon they will be approved by the european commission
bsl-1 | distributed under the boost | distributed under the boost software licen[sc]e version 1 0
bsl-1 | permission is hereby granted | permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this licen[sc]e
artistic-2 | everyone is permitted | everyone is permitted to copy and distribute verbatim copies of this licen[sc]e document but changing it is not allowed preamble this licen[sc]e establishes the terms under which a given free software package
artistic-1-perl | under the same terms as perl | (?:may|can) (?:redistribute|distribute) it and or modify it under the same terms as perl(?: itself)?
perl | under the same terms as perl | under the same terms as perl(?: itself)?
gnu-document | everyone is permitted | everyone is permitted to copy and distribute verbatim copies of this licen[sc]e document but changing it is not allowed
wtfpl-2 | everyone is permitted | everyone is permitted to copy and distribute verbatim or modified copies of this licen[sc]e document and changing it is allowed as long as the name is changed
wtfpl-2 | you just do what | you just do what the fuck you want to
zlib | altered source versions | altered source versions must be plainly marked as such and must not be misrepresented as being the original software
zlib | this software is provided as is | this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software
zlib | the origin of this software | the origin of this software must not be misrepresented you must not claim that you wrote the original software
libpng | this copy of the libpng | this copy of the libpng notices is provided for your convenience
unlicense | free and unencumbered | this is free and unencumbered software released into the public domain
unlicense | anyone is free to copy | anyone is free to copy modify publish use compile sell or distribute this software
cc0-1 | to the extent possible | to the extent possible under law .{1,80}? has waived all copyright and related or neighbou?ring rights
cc0-1 | waives all copyright | waives all copyright and related or neighbou?ring rights
public-domain | has been put in the public;hereby placed in the public;placed in the public | (?:has been put|is hereby placed|was placed|placed) in the public domain
public-domain | this work is in the public;this file is in the public | this (?:work|file) is in the public domain
public-domain | no copyright is claimed | no copyright is claimed in the united states
public-domain | not subject to copyright | not subject to copyright protection
ofl-1.1 | this font software is licensed | this font software is licensed under the sil open font licen[sc]e version 1 1
ofl-1.1 | reserved font name | with reserved font names?
odbl-1 | made available under the open database | made available under the open database licen[sc]e
odc-by-1 | open data commons attribution | open data commons attribution licen[sc]e
pddl-1 | public domain dedication | open data commons public domain dedication and licen[sc]e
psf-2 | python software foundation | 1 this licen[sc]e agreement is between the python software foundation
psf-2 | psf hereby grants | psf hereby grants licensee a nonexclusive royalty free world wide licen[sc]e
ruby | under the terms of ruby | under the terms of ruby s licen[sc]e
php-3.01 | this source file is subject | this source file is subject to version 3 01 of the php licen[sc]e
php-3 | this source file is subject | this source file is subject to version 3 0 of the php licen[sc]e
w3c | by obtaining using and or copying | by obtaining using and or copying this work you the licensee agree that you have read understood and will comply
ijg | the independent jpeg | this software is based in part on the work of the independent jpeg group
openssl | developed by the openssl | this product includes software developed by the openssl project for use in the openssl toolkit
ssleay | cryptographic software written | this product includes cryptographic software written by eric young
icu | unicode inc licen;unicode license;unicode licence | unicode (?:inc )?licen[sc]e agreement
curl | permission to use | permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice
ms-pl | this license governs;this licence governs | this licen[sc]e governs use of the accompanying software if you use the software you accept this licen[sc]e
beerware | as long as you retain | as long as you retain this notice you can do whatever you want with this stuff
json | shall be used for good | the software shall be used for good not evil
vim | vim is charityware | vim is charityware
sspl-1 | server side public | server side public licen[sc]e(?: version 1)?
busl-1.1 | business source license;business source licence | business source licen[sc]e(?: 1 1)?
elastic-2 | elastic license;elastic licence | elastic licen[sc]e(?: 2 0)?
commons-clause | commons clause | commons clause licen[sc]e condition
polyform | polyform | polyform (?:noncommercial|small business|shield|strict|internal use) licen[sc]e
cecill-2 | cecill | governed by the cecill licen[sc]e under french law
cecill-b | cecill | governed by the cecill b licen[sc]e under french law
cecill-c | cecill | governed by the cecill c licen[sc]e under french law
upl-1 | universal permissive | universal permissive licen[sc]e(?: v ?1 0)?
ncsa | university of illinois | university of illinois ncsa open source licen[sc]e
ecl-2 | educational community | educational community licen[sc]e version 2 0
qpl-1 | q public license;q public licence | q public licen[sc]e(?: version 1 0)?
sleepycat | redistributions in any form | redistributions in any form must be accompanied by information on how to obtain complete source code
cc-by-4.0 | attribution 4 0 | creative commons attribution 4 0 international public licen[sc]e
cc-by-sa-4.0 | attribution sharealike 4;attribution share alike 4 | creative commons attribution share ?alike 4 0 international public licen[sc]e
cc-by | this work is licensed under;this article is licensed under | this (?:work|article) is licensed under a creative commons attribution
cc-by | distributed under the terms | open access article distributed under the terms (?:and conditions )?of the creative commons attribution
cc-by-nc | non commercial use | permits non commercial use distribution and reproduction in any medium
cc-by | unrestricted use | permits unrestricted use distribution and reproduction in any medium provided the original work is properly cited
free-art | free art license;free art licence | free art licen[sc]e(?: 1 3)?
llama | llama 2 community;llama 3 community | llama [23] community licen[sc]e agreement
openrail | openrail | (?:creativeml |bigscience )?openrail m(?: licen[sc]e)?
"""
# The same for lines that tell less: copyright notices, reservations, disclaimers, confidentiality.
NOTICES = """
copyright | copyright | copyright c? ?(?:19|20)[0-9][0-9]
copyright | copyright | copyright c (?:by )?the authors?
copyright | the copyright | the copyright (?:holder|holders|owner|owners)
reserved | some rights | some rights reserved
reserved | all rights | all rights are reserved
reserved | tous droits | tous droits r[eé]serv[eé]s
reserved | alle rechte | alle rechte vorbehalten
reserved | todos los derechos | todos los derechos reservados
no-copying | no part of this | no part of this (?:publication|document|work|book) may be reproduced
no-copying | may not be reproduced | may not be reproduced in any form without
no-copying | without the prior written | without the prior written (?:permission|consent) of
no-copying | reproduction in whole | reproduction in whole or in part (?:without|is prohibited)
proprietary | proprietary | proprietary and confidential
proprietary | trade secrets | (?:contains|contain) trade secrets
proprietary | unauthorized copying;unauthorised copying | unauthori[sz]ed copying of this (?:file|software|document)
proprietary | strictly prohibited | via any medium is strictly prohibited
proprietary | this software is the confidential | this software is the confidential and proprietary information of
proprietary | for internal use | for internal use only
eula | end user | end user licen[sc]e agreement
eula | by installing | by installing (?:or using )?(?:the|this) software you (?:agree|accept)
terms | terms of service | (?:subject to|accept) (?:the|our) terms of service
terms | terms of use | (?:subject to|accept) (?:the|our) terms of use
disclaimer-mit | the software is provided | the software is provided as is without warranty of any kind express or implied
disclaimer-mit | in no event shall the authors | in no event shall the authors or copyright holders be liable for any claim damages or other liability
disclaimer-bsd | this software is provided by | this software is provided by .{1,80}? as is and any express or implied warranties
disclaimer-bsd | in no event shall | in no event shall .{1,80}? be liable for any direct indirect incidental special exemplary or consequential damages
disclaimer-gpl | without any warranty | in the hope that it will be useful but without any warranty
disclaimer-gpl | merchantability or fitness | without even the implied warranty of merchantability or fitness for a particular purpose
disclaimer-gpl | you should have received | you should have received a copy of the gnu (?:lesser |library |affero )?general public licen[sc]e
disclaimer-gpl | there is no warranty | there is no warranty for the program to the extent permitted by applicable law
disclaimer-apache | unless required by | unless required by applicable law or agreed to in writing software distributed under the licen[sc]e is distributed on an as is basis
disclaimer-apache | without warranties or | without warranties or conditions of any kind either express or implied
disclaimer | as is without | as is without (?:any )?(?:express or implied )?warrant(?:y|ies)
disclaimer | no warranty | (?:with|comes with) (?:absolutely )?no warranty
disclaimer | use at your own | use at your own risk
see-license | see the license;see the licence | see the licen[sc]e file
see-license | see license;see licence;see copying | see (?:licen[sc]e|copying)(?: txt| md)? for (?:details|more information)
dual | dual licensed;dual licenced | dual licen[sc]ed under
dual | at your option | (?:or|and) at your option
choice | licensed under either | licensed under either of
free-use | free for;free to use | free (?:for|to use for) (?:personal|academic|non ?commercial|educational) use
free-use | may be freely | may be freely (?:used|copied|distributed|redistributed)
"""


# License families: label, names (words as the scan sees them), versions, keyword of the prefilter.
# Each text that a rule matches holds one of its keywords at the start of a word; versions may be joined to a name ("mplv2").
FAMILIES = (
    ("gpl", "gnu gpl|gpl|gnu general public licen[sc]e|general public licen[sc]e", "1 2 3", "gpl;general public"),
    ("lgpl", "gnu lgpl|lgpl|gnu (?:lesser|library) general public licen[sc]e|(?:lesser|library) general public licen[sc]e", "2 2.1 3", "lgpl;general public"),
    ("agpl", "gnu agpl|agpl|gnu affero general public licen[sc]e|affero general public licen[sc]e", "1 3", "agpl;affero"),
    ("gfdl", "gfdl|gnu free documentation licen[sc]e", "1.1 1.2 1.3", "gfdl;free documentation"),
    ("apache", "apache licen[sc]e|apache software licen[sc]e|asl|apache", "1 1.1 2", "apache;asl"),
    ("mpl", "mpl|mozilla public licen[sc]e", "1 1.1 2", "mpl;mozilla"),
    ("epl", "epl|eclipse public licen[sc]e", "1 2", "epl;eclipse"),
    ("cddl", "cddl|common development and distribution licen[sc]e", "1 1.1", "cddl;common development"),
    ("eupl", "eupl|european union public licen[sc]e", "1 1.1 1.2", "eupl;european union"),
    ("artistic", "artistic licen[sc]e|artistic", "1 2", "artistic"),
    ("osl", "osl|open software licen[sc]e", "1 2 2.1 3", "osl;open software"),
    ("afl", "afl|academic free licen[sc]e", "1.1 1.2 2 2.1 3", "afl;academic free"),
    ("bsl", "boost software licen[sc]e|bsl", "1", "boost;bsl"),
    ("zpl", "zpl|zope public licen[sc]e", "1.1 2 2.1", "zpl;zope"),
    ("php", "php licen[sc]e", "3 3.01", "php"),
    ("psf", "python software foundation licen[sc]e|psf licen[sc]e", "2", "python software;psf "),
    ("ofl", "sil open font licen[sc]e|open font licen[sc]e|ofl", "1 1.1", "open font;ofl"),
    ("odbl", "open database licen[sc]e|odbl", "1", "open database;odbl"),
    ("cecill", "cecill", "1 1.1 2 2.1", "cecill"),
    ("mulan", "mulan psl|mulan permissive software licen[sc]e", "1 2", "mulan"),
    ("ms-pl", "microsoft public licen[sc]e|ms pl", "", "microsoft public;ms pl"),
    ("ms-rl", "microsoft reciprocal licen[sc]e|ms rl", "", "microsoft reciprocal;ms rl"),
    ("mit", "mit licen[sc]e|expat licen[sc]e|mit x11 licen[sc]e|x11 licen[sc]e", "", "mit licen;expat;x11"),
    ("isc", "isc licen[sc]e", "", "isc licen"),
    ("zlib", "zlib licen[sc]e|zlib libpng licen[sc]e", "", "zlib"),
    ("unlicense", "the unlicen[sc]e|unlicen[sc]e", "", "unlicen"),
    ("wtfpl", "wtfpl|do what the fuck you want to public licen[sc]e", "", "wtfpl;you want to public"),
    ("cc0", "cc0|creative commons zero", "1", "cc0;commons zero"),
    ("public-domain", "public domain|dedicated to the public domain", "", "public domain"),
    ("proprietary", "proprietary and confidential|unauthori[sz]ed copying", "", "proprietary;copying"),
    ("copyright", "copyright c|copyright", "", "copyright"),
    ("licensed", "licensed under|released under|distributed under the terms", "", "licensed under;released under;distributed under"),
)
_BSD = (("0", "zero clause|0 clause"), ("2", "simplified|two clause|2 clause|freebsd"), ("3", "new|revised|modified|three clause|3 clause"), ("4", "original|four clause|4 clause"))
_EXCEPTIONS = (("classpath", "classpath"), ("gcc", "gcc(?: runtime library)?"), ("font", "font"), ("linking", "linking"))
_GNU_LINKS = {"gpl": "gpl", "lgpl": "lgpl", "agpl": "agpl", "gfdl": "fdl"}
_CC_PARTS = (("by", "by|attribution"), ("nc", "nc|non ?commercial"), ("nd", "nd|no ?derivs|no ?derivatives"), ("sa", "sa|share ?alike"))
_CC_KINDS = (("by",), ("by", "sa"), ("by", "nd"), ("by", "nc"), ("by", "nc", "sa"), ("by", "nc", "nd"))
_CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")


def _number(version: str) -> str:
    parts = version.split(".")
    return " ".join(parts) + ("(?: 0)?" if len(parts) == 1 else "")


def signatures() -> tuple[Signature, ...]:
    """All rules in order: the written ones, then names of families with their versions, "or later" forms, BSD and CC kinds, links, tags."""
    out: list[Signature] = []

    def add(label: str, keywords: str, pattern: str, priority: int, confidence: float) -> None:
        out.append(Signature(label, tuple(keywords.split(";")), f"(?<= )(?:{pattern})(?= )", priority, confidence))

    for table, priority, confidence in ((GRANTS, 20, 0.98), (NOTICES, 1, 0.5)):
        for line in table.strip().splitlines():
            label, keywords, pattern = (part.strip() for part in line.split(" | "))
            add(label, keywords, pattern, priority, confidence)
    for label, names, versions, keywords in FAMILIES:
        weak = label in ("copyright", "licensed", "proprietary", "artistic")
        if label not in ("artistic", "apache"):
            add(label, keywords, f"(?:{names})", 1 if weak else 2, 0.4 if weak else 0.8)
        else:
            add(label, keywords, f"{label} (?:software )?licen[sc]e", 2, 0.8)
        for version in versions.split():
            # Names and numbers: "license version 2 0", "gpl v2", "gplv2", "apache 2 0".
            numbered = f"(?:{names})(?: licen[sc]e)?(?: version| ver| v)? ?v?{_number(version)}"
            add(f"{label}-{version}", keywords, numbered, 3, 0.95)
            if "gpl" in label or label == "gfdl":
                add(f"{label}-{version}-only", keywords, f"{numbered} only", 4, 0.95)
                for exception, names_of in _EXCEPTIONS if label == "gpl" else ():
                    add(f"{label}-{version}-with-{exception}", keywords, f"{numbered}(?: or later| only)? with (?:the )?(?:{names_of}) exception", 5, 0.95)
                later = r"(?: or later| or at your option any later version| or any later version)"
                add(f"{label}-{version}-or-later", keywords, numbered + later, 4, 0.95)
    for clauses, names in _BSD:
        add(f"bsd-{clauses}-clause", "bsd", f"(?:{names}) bsd(?: licen[sc]e)?|bsd (?:{names})(?: licen[sc]e)?", 3, 0.95)
    add("bsd", "bsd", "bsd licen[sc]e|bsd style licen[sc]e", 2, 0.7)
    for parts in _CC_KINDS:
        body = " ".join(f"(?:{dict(_CC_PARTS)[p]})" for p in parts)
        name = "cc-" + "-".join(parts)
        add(name, "cc by;cc attribution;creative commons", f"(?:cc|creative commons) {body}", 2 + len(parts), 0.8)
        for version in _CC_VERSIONS:
            number = version.replace(".", " ").replace(" 0", "(?: 0)?")
            add(f"{name}-{version}", "cc by;cc attribution;creative commons", f"(?:cc|creative commons) {body}(?: licen[sc]e)?(?: version| v)? {number}(?: international| unported| generic)?", 6 + len(parts), 0.95)
        add(f"{name}-link", "creativecommons org", f"creativecommons org licen[sc]es {' '.join(parts)}", 2 + len(parts), 0.9)
        for version in _CC_VERSIONS:
            add(f"{name}-{version}", "creativecommons org", f"creativecommons org licen[sc]es {' '.join(parts)} {version.replace('.', ' ')}", 6 + len(parts), 0.95)
    for label, _, versions, _ in FAMILIES:
        if label in _GNU_LINKS:
            add(f"{label}-link", "gnu org", f"gnu org licen[sc]es {_GNU_LINKS[label]}", 2, 0.9)
            for version in versions.split():
                add(f"{label}-{version}", "gnu org", f"gnu org licen[sc]es (?:old licen[sc]es )?{_GNU_LINKS[label]} {_number(version)}", 3, 0.95)
        elif label not in ("copyright", "licensed", "proprietary", "public-domain"):
            add(f"{label}-link", "opensource org", f"opensource org licen[sc]es? {label.replace('-', ' ')}", 2, 0.9)
    add("apache-2", "apache org", "apache org licen[sc]es licen[sc]e 2 0", 3, 0.95)
    add("spdx", "spdx license identifier", "spdx license identifier [a-z0-9]+", 2, 1.0)
    return tuple(out)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _let(value: str, name: str, body: str) -> str:
    """SQL: ``body`` with ``name`` standing for ``value``, which is evaluated once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _any_prefix(words: list[str]) -> str:
    """A regular expression that matches where one of the strings begins; shared beginnings are tried once."""
    if "" in words:
        return ""
    branches = [re.escape(first) + _any_prefix([w[1:] for w in words if w[0] == first]) for first in sorted({w[0] for w in words})]
    return branches[0] if len(branches) == 1 else f"(?:{'|'.join(branches)})"


def _base_places() -> str:
    """SQL: (label, word) of the base phrases in ``form``."""
    cases = []
    for phrase, label in BASE:
        first, *rest = phrase.split()
        cases.append(f"when w = '{first}' and " + " and ".join(f"get(ws, i + {j + 1}) = '{x}'" for j, x in enumerate(rest)) + f" then named_struct('label', '{label}', 'word', cast(i as bigint))")
    return _let("split(trim(form), ' ')", "ws", f"filter(transform(ws, (w, i) -> case {' '.join(cases)} end), x -> x is not null)")


def _matched(rules: tuple[Signature, ...]) -> str:
    """SQL: the rules that match ``form``. Each expression is a literal, compiled once; those that share keywords share a gate."""
    gates: dict[tuple[str, ...], list[str]] = {}
    for rank, r in enumerate(rules):
        value = f"named_struct('pattern', {_quoted(r.pattern)}, 'order', -{r.priority}, 'rank', {rank}, 'label', {_quoted(r.label)}, 'confidence', {r.confidence}D)"
        gates.setdefault(r.keywords, []).append(f"case when form rlike {_quoted(r.pattern)} then {value} end")
    kind = "array<struct<pattern:string,order:int,rank:int,label:string,confidence:double>>"
    parts = [
        f"case when {' or '.join(f'contains(form, {_quoted(chr(32) + k)})' for k in keywords)} then array_compact(array({', '.join(cases)})) else cast(array() as {kind}) end"
        for keywords, cases in gates.items()
    ]
    return f"concat({', '.join(parts)})"


def _detections() -> str:
    """SQL: the detections of the rules in ``hits``, sorted so that what can suppress one stands before it.

    A match's first and last word are marked in the text, so that its place in words can be read off.
    """
    places = _let(
        "split(trim(regexp_replace(form, r.pattern, concat(char(1), '$0', char(2)))), ' ')",
        "ws",
        "arrays_zip(filter(transform(ws, (w, i) -> case when startswith(w, char(1)) then i end), x -> x is not null),"
        " filter(transform(ws, (w, i) -> case when endswith(w, char(2)) then i + 1 end), x -> x is not null))",
    )
    one = "named_struct('start', p.`0`, 'back', -p.`1`, 'order', r.order, 'rank', r.rank, 'label', r.label, 'confidence', r.confidence)"
    return f"array_sort(flatten(transform(hits, r -> transform({places}, p -> {one}))))"


def _surviving() -> str:
    """SQL: the detections of ``raw`` that no earlier one suppresses.

    One that contains another starts at most the longest range before it. ``n`` is a number of predecessors, the same for
    all detections, that reaches back so far; so the work is n for each detection, with n small unless matches crowd.
    """
    reaches = "not exists(transform(raw, (d, i) -> i >= {0} and get(raw, i - {0}).start >= d.start - far), x -> x)"
    n = "case " + " ".join(f"when {reaches.format(k)} then {k}" for k in (4, 16, 64, 256, 1024)) + " else size(raw) end"
    stays = "case when exists(slice(raw, greatest(1, i + 1 - n), least(i, n)), e -> e.back <= d.back and e.order <= d.order) then null else d end"
    found = _let("array_max(transform(raw, d -> -d.back - d.start))", "far", _let(n, "n", f"filter(transform(raw, (d, i) -> {stays}), x -> x is not null)"))
    return f"transform({found}, d -> named_struct('label', d.label, 'priority', -d.order, 'confidence', d.confidence, 'start', d.start, 'finish', -d.back, 'rank', d.rank))"


def scan(docs: DataFrame, rules: tuple[Signature, ...] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's id, ``n_words``, ``base`` (places of the base phrases), ``found`` (surviving detections) and ``confidence``.

    ``base`` is an array of (label, word), the place's first word counted from 0; ``found`` an array of (label,
    priority, confidence, start, finish, rank) with words counted from 0, ``finish`` exclusive. ``confidence`` is the
    largest of the detections' and 0.7 for a base place, 0 without any. Base places are never suppressed.

    Null, empty and wordless texts have 0 words and no detection; a null id stays null; repeated rows are scanned
    each; long texts are scanned whole; other columns are left out; an empty table gives an empty table. Time grows
    with the length of a text, as tests on each rule's worst text show, but for one case: where more than 1,024
    detections stand within the range of one, each is compared with all before it.
    """
    rules = signatures() if rules is None else rules
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    plain = F.regexp_replace(F.translate(text, upper, lower), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")
    rows = docs.select(F.col(id_col).alias("id"), F.concat(F.lit(" "), F.trim(plain), F.lit(" ")).alias("form"))
    n_words = F.when(F.col("form") == "  ", F.lit(0)).otherwise(F.length("form") - F.length(F.replace("form", F.lit(" "))) - 1)
    # The prefilter: one look for any keyword at the start of a word.
    any_rule = F.col("form").rlike(" " + _any_prefix(sorted({k for r in rules for k in r.keywords})))
    any_base = reduce(lambda a, b: a | b, [F.contains("form", F.lit(f" {phrase} ")) for phrase, _ in BASE])
    rows = rows.select("id", "form", n_words.cast("long").alias("n_words"), any_base.alias("has_base"), any_rule.alias("has_rule"))

    no_base = "cast(array() as array<struct<label:string,word:bigint>>)"
    no_found = "cast(array() as array<struct<label:string,priority:int,confidence:double,start:int,finish:int,rank:int>>)"
    step = rows.selectExpr("id", "n_words", "form", f"case when has_base then {_base_places()} else {no_base} end as base", f"case when has_rule then {_matched(rules)} end as hits")
    step = step.selectExpr("id", "n_words", "base", f"case when size(hits) > 0 then {_detections()} end as raw")
    step = step.selectExpr("id", "n_words", "base", f"case when size(raw) > 0 then {_surviving()} else {no_found} end as found")
    best = "greatest(case when size(base) > 0 then 0.7D else 0.0D end, coalesce(array_max(transform(found, f -> f.confidence)), 0.0D))"
    return step.selectExpr("id", "n_words", "base", "found", f"{best} as confidence").withColumnRenamed("id", id_col)
