"""License texts and notices, found by ordered signature rules, with DataFrame functions only.

A text is first tested for any rule's keyword; only texts that have one go on. Their words are joined
by single spaces, and each rule whose own keyword is there is matched as a regular expression over
them. Of detections that touch each other the best by priority among those that lie in no longer one
stays and what overlaps it is dropped, until all are judged.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The word pattern, and the base phrases with their labels.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BASE = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``pattern`` is matched over words joined by spaces; each match contains ``keyword``, from the start of a word on."""

    label: str
    keyword: str
    pattern: str
    priority: int
    confidence: float


# Names of licenses as they stand in running text, most specific first: label, keyword, pattern.
NAMES = (
    ("agpl-3.0", "affero", r"(?:gnu )?affero general public licen[cs]e (?:version |v)?3(?: 0)?"),
    ("agpl", "affero", r"(?:gnu )?affero general public licen[cs]e"),
    ("lgpl-3.0", "lesser", r"(?:gnu )?lesser general public licen[cs]e (?:version |v)?3(?: 0)?"),
    ("lgpl-2.1", "lesser", r"(?:gnu )?lesser general public licen[cs]e (?:version |v)?2 1"),
    ("lgpl", "lesser", r"(?:gnu )?lesser general public licen[cs]e"),
    ("lgpl-2.0", "library general", r"(?:gnu )?library general public licen[cs]e (?:version |v)?2(?: 0)?"),
    ("gpl-3.0", "general public", r"(?:gnu )?general public licen[cs]e (?:version |v)?3(?: 0)?"),
    ("gpl-2.0", "general public", r"(?:gnu )?general public licen[cs]e (?:version |v)?2(?: 0)?"),
    ("gpl-1.0", "general public", r"(?:gnu )?general public licen[cs]e (?:version |v)?1(?: 0)?"),
    ("gpl", "general public", r"gnu general public licen[cs]e"),
    ("gfdl-1.3", "free documentation", r"(?:gnu )?free documentation licen[cs]e (?:version |v)?1 3"),
    ("gfdl-1.2", "free documentation", r"(?:gnu )?free documentation licen[cs]e (?:version |v)?1 2"),
    ("gfdl", "free documentation", r"(?:gnu )?free documentation licen[cs]e"),
    ("apache-2.0", "apache", r"apache (?:software )?licen[cs]e (?:version |v)?2(?: 0)?"),
    ("apache-1.1", "apache", r"apache (?:software )?licen[cs]e (?:version |v)?1 1"),
    ("apache-1.0", "apache", r"apache (?:software )?licen[cs]e (?:version |v)?1 0"),
    ("apache", "apache", r"apache (?:software )?licen[cs]e"),
    ("mit-0", "mit no att", r"mit no attribution(?: licen[cs]e)?"),
    ("mit", "mit licen", r"mit licen[cs]e"),
    ("bsd-4-clause", "bsd", r"bsd 4 clause(?: licen[cs]e)?"),
    ("bsd-3-clause", "bsd", r"(?:(?:new|modified|revised) bsd|bsd 3 clause)(?: licen[cs]e)?"),
    ("bsd-2-clause", "bsd", r"(?:simplified bsd|bsd 2 clause)(?: licen[cs]e)?"),
    ("bsd-2-clause", "freebsd", r"freebsd(?: licen[cs]e)?"),
    ("bsd-0-clause", "bsd", r"(?:zero clause bsd|bsd zero clause)(?: licen[cs]e)?"),
    ("bsd-0-clause", "0bsd", r"0bsd(?: licen[cs]e)?"),
    ("bsd", "bsd", r"bsd (?:style )?licen[cs]e"),
    ("mpl-2.0", "mozilla", r"mozilla public licen[cs]e (?:version |v)?2(?: 0)?"),
    ("mpl-1.1", "mozilla", r"mozilla public licen[cs]e (?:version |v)?1 1"),
    ("mpl", "mozilla", r"mozilla public licen[cs]e"),
    ("epl-2.0", "eclipse", r"eclipse public licen[cs]e (?:version |v)?2(?: 0)?"),
    ("epl-1.0", "eclipse", r"eclipse public licen[cs]e (?:version |v)?1(?: 0)?"),
    ("epl", "eclipse", r"eclipse public licen[cs]e"),
    ("eupl-1.2", "european union", r"european union public licen[cs]e (?:version |v)?1 2"),
    ("eupl", "european union", r"european union public licen[cs]e"),
    ("cddl-1.1", "common development", r"common development and distribution licen[cs]e (?:version |v)?1 1"),
    ("cddl", "common development", r"common development and distribution licen[cs]e"),
    ("cpl-1.0", "common public", r"common public licen[cs]e(?: (?:version |v)?1(?: 0)?)?"),
    ("artistic-2.0", "artistic licen", r"artistic licen[cs]e (?:version |v)?2(?: 0)?"),
    ("artistic-1.0", "artistic licen", r"artistic licen[cs]e(?: (?:version |v)?1(?: 0)?)?"),
    ("isc", "isc licen", r"isc licen[cs]e"),
    ("zlib", "zlib", r"zlib(?: libpng)? licen[cs]e"),
    ("boost-1.0", "boost", r"boost software licen[cs]e(?: (?:version |v)?1(?: 0)?)?"),
    ("unlicense", "unlicense", r"unlicense"),
    ("wtfpl", "wtfpl", r"wtfpl"),
    ("wtfpl", "do what the", r"do what the fuck you want to public licen[cs]e"),
    ("python-2.0", "python software", r"python software foundation licen[cs]e(?: (?:version |v)?2(?: 0)?)?"),
    ("php-3.01", "php licen", r"php licen[cs]e(?: (?:version |v)?3 0?1)?"),
    ("ruby", "ruby licen", r"ruby licen[cs]e"),
    ("openssl", "openssl licen", r"openssl licen[cs]e"),
    ("postgresql", "postgresql licen", r"postgresql licen[cs]e"),
    ("ofl-1.1", "open font", r"(?:sil )?open font licen[cs]e(?: (?:version |v)?1 1)?"),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa(?: open source)? licen[cs]e"),
    ("ms-pl", "microsoft public", r"microsoft public licen[cs]e"),
    ("ms-rl", "microsoft reciprocal", r"microsoft reciprocal licen[cs]e"),
    ("afl-3.0", "academic free", r"academic free licen[cs]e(?: (?:version |v)?3(?: 0)?)?"),
    ("osl-3.0", "open software", r"open software licen[cs]e(?: (?:version |v)?3(?: 0)?)?"),
    ("odbl-1.0", "open database", r"open database licen[cs]e(?: (?:version |v)?1(?: 0)?)?"),
    ("cecill", "cecill", r"cecill(?: [abc])?(?: (?:version |v)?2 [01])?(?: licen[cs]e)?"),
    ("busl-1.1", "business source", r"business source licen[cs]e(?: (?:version |v)?1 1)?"),
    ("sspl-1.0", "server side", r"server side public licen[cs]e(?: (?:version |v)?1(?: 0)?)?"),
    ("elastic-2.0", "elastic licen", r"elastic licen[cs]e(?: (?:version |v)?2(?: 0)?)?"),
    ("cc0-1.0", "cc0", r"cc0(?: 1 0)?(?: universal)?"),
    ("cc-by-nc-sa-4.0", "cc by", r"cc by nc sa 4 0"),
    ("cc-by-nc-nd-4.0", "cc by", r"cc by nc nd 4 0"),
    ("cc-by-nc-4.0", "cc by", r"cc by nc 4 0"),
    ("cc-by-sa-4.0", "cc by", r"cc by sa 4 0"),
    ("cc-by-nd-4.0", "cc by", r"cc by nd 4 0"),
    ("cc-by-4.0", "cc by", r"cc by 4 0"),
    ("cc-by-nc-sa", "cc by", r"cc by nc sa(?: [123] [05])?"),
    ("cc-by-nc-nd", "cc by", r"cc by nc nd(?: [123] [05])?"),
    ("cc-by-nc", "cc by", r"cc by nc(?: [123] [05])?"),
    ("cc-by-sa", "cc by", r"cc by sa(?: [123] [05])?"),
    ("cc-by-nd", "cc by", r"cc by nd(?: [123] [05])?"),
    ("cc-by", "cc by", r"cc by(?: [123] [05])?"),
    ("cc-by-nc-sa", "creative commons", r"creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?"),
    ("cc-by-nc-nd", "creative commons", r"creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: [1-4] [05])?"),
    ("cc-by-nc", "creative commons", r"creative commons attribution non ?commercial(?: [1-4] [05])?"),
    ("cc-by-sa", "creative commons", r"creative commons attribution share ?alike(?: [1-4] [05])?"),
    ("cc-by-nd", "creative commons", r"creative commons attribution no ?deriv(?:ative)?s(?: [1-4] [05])?"),
    ("cc-by", "creative commons", r"creative commons attribution(?: [1-4] [05])?"),
    ("public-domain", "public domain", r"(?:dedicated|released|placed) (?:to|into|in) the public domain"),
)
# Ways to name a license: what stands before the name, level of priority, confidence.
FORMS = (
    (r"(?:licensed|released|distributed|available|published|provided) under (?:the )?(?:terms (?:and conditions )?of )?(?:the )?", 3, 0.95),
    (r"(?:this|the) (?:work|software|program|file|code|library|document) is (?:licensed|released|distributed|covered) (?:under|by) (?:the )?", 4, 0.97),
    (r"", 1, 0.8),
)
# Identifiers, addresses and sentences that stand for a license by themselves: label, keyword, pattern.
SIGNS = (
    ("mit", "permission is hereby", r"permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("isc", "permission to use", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", "redistribution and", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("gpl", "free software", r"this program is free software you can redistribute it and or modify it"),
    ("lgpl", "free software", r"this library is free software you can redistribute it and or modify it"),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("zlib", "this software is provided", r"this software is provided as is without any express or implied warranty in no event"),
    ("boost-1.0", "boost", r"distributed under the boost software license version 1 0"),
    ("apache-2.0", "apache", r"(?:www )?apache org licenses license 2 0"),
    ("mit", "opensource org", r"opensource org licenses mit"),
    ("bsd-3-clause", "opensource", r"opensource org licenses bsd 3 clause"),
    ("bsd-2-clause", "opensource", r"opensource org licenses bsd 2 clause"),
    ("gpl-3.0", "gnu org", r"(?:www )?gnu org licenses gpl 3 0"),
    ("gpl", "gnu org", r"(?:www )?gnu org licenses(?: gpl)?"),
    ("mpl-2.0", "mozilla", r"mozilla org mpl 2 0"),
    ("cc-by-sa", "creativecommons", r"creativecommons org licenses by sa [1-4] 0"),
    ("cc-by-nc", "creativecommons", r"creativecommons org licenses by nc [1-4] 0"),
    ("cc-by", "creativecommons", r"creativecommons org licenses by [1-4] 0"),
    ("cc0-1.0", "creativecommons", r"creativecommons org publicdomain zero 1 0"),
    ("all-rights-reserved", "all rights", r"all rights reserved"),
    ("proprietary", "proprietary and", r"proprietary and confidential"),
    # Sentences of license texts and notices.
    ("mit", "the above copyright notice", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", "the software is provided", r"the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability"),
    ("x11", "except as contained", r"except as contained in this notice the names? of the x consortium shall not be used"),
    ("isc", "the software is provided", r"the software is provided as is and the author disclaims all warranties with regard to this software"),
    ("hpnd", "permission to use", r"permission to use copy modify and distribute this software and its documentation for any purpose and without fee is hereby granted"),
    ("ntp", "permission to use", r"permission to use copy modify and distribute this software and its documentation for any purpose with or without fee is hereby granted"),
    ("bsd-2-clause", "redistributions of source", r"redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd-2-clause", "redistributions in binary", r"redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation"),
    ("bsd-3-clause", "neither the name", r"neither the names? of (?:the copyright holders?|the author|the university|the organization|the company) nor the names of its contributors may be used to endorse or promote products"),
    ("bsd-3-clause-clear", "no express or implied", r"no express or implied licenses to any party s patent rights are granted by this license"),
    ("bsd-4-clause", "all advertising materials", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("bsd", "this software is provided", r"this software is provided by the (?:copyright holders and contributors|regents and contributors|author) as is and any express or implied warranties"),
    ("apache-1.1", "the end user", r"the end user documentation included with the redistribution if any must include the following acknowledge?ment this product includes software developed by the apache software foundation"),
    ("apache-1.0", "this product includes", r"this product includes software developed by the apache group"),
    ("apache-2.0", "you may not use this file", r"you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("apache-2.0", "unless required by applicable", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("apache-2.0", "grant of patent license", r"grant of patent license subject to the terms and conditions of this license each contributor hereby grants to you a perpetual worldwide"),
    ("apache-2.0", "licensed to the apache", r"licensed to the apache software foundation asf under one or more contributor license agreements"),
    ("gpl-2.0", "either version", r"as published by the free software foundation either version 2 of the license or at your option any later version"),
    ("gpl-3.0", "either version", r"as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("lgpl-2.1", "either version", r"as published by the free software foundation either version 2 1 of the license or at your option any later version"),
    ("gpl-2.0", "version 2 as published", r"under the terms of the gnu general public license version 2 as published by the free software foundation"),
    ("gpl", "this program is distributed", r"this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability"),
    ("lgpl", "this library is distributed", r"this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability"),
    ("gpl", "you should have received", r"you should have received a copy of the gnu general public license along with this (?:program|file|package)"),
    ("lgpl", "you should have received", r"you should have received a copy of the gnu (?:lesser|library) general public license along with this (?:library|program)"),
    ("agpl-3.0", "you should have received", r"you should have received a copy of the gnu affero general public license along with this program"),
    ("gpl-2.0", "the licenses for most", r"the licenses for most software are designed to take away your freedom to share and change it by contrast"),
    ("gpl-3.0", "the gnu general public", r"the gnu general public license is a free copyleft license for software and other kinds of works"),
    ("agpl-3.0", "the gnu affero general", r"the gnu affero general public license is a free copyleft license for software and other kinds of works specifically designed to ensure cooperation"),
    ("agpl-3.0", "remote network interaction", r"remote network interaction use with the gnu general public license"),
    ("lgpl-2.1", "this is the first released", r"this is the first released version of the lesser gpl"),
    ("lgpl-3.0", "this version of the gnu lesser", r"this version of the gnu lesser general public license incorporates the terms and conditions of version 3 of the gnu general public license"),
    ("gpl-2.0-classpath", "as a special exception", r"as a special exception the copyright holders of this library give you permission to link this library with independent modules"),
    ("gpl-3.0-gcc", "gcc runtime library", r"gcc runtime library exception(?: version)? 3 1"),
    ("gpl-autoconf", "as a special exception", r"as a special exception the free software foundation gives unlimited permission to copy distribute and modify the configure scripts"),
    ("gpl-bison", "as a special exception", r"as a special exception you may create a larger work that contains part or all of the bison parser skeleton"),
    ("gfdl", "permission is granted", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("gfdl", "the purpose of this license", r"the purpose of this license is to make a manual textbook or other functional and useful document free in the sense of freedom"),
    ("all-permissive", "copying and distribution", r"copying and distribution of this file with or without modification are permitted in any medium without royalty"),
    ("mpl-2.0", "this source code form", r"this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-2.0", "if a copy of the mpl", r"if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("mpl-2.0", "incompatible with secondary", r"this source code form is incompatible with secondary licenses as defined by the mozilla public license v 2 0"),
    ("mpl-1.1", "the contents of this file", r"the contents of this file are subject to the mozilla public license version 1 1 the license you may not use this file except in compliance with the license"),
    ("mpl-1.0", "the contents of this file", r"the contents of this file are subject to the mozilla public license version 1 0 the license"),
    ("npl-1.1", "the contents of this file", r"the contents of this file are subject to the netscape public license version 1 1"),
    ("cddl-1.0", "the contents of this file", r"the contents of this file are subject to the terms of the common development and distribution license"),
    ("cpl-1.0", "the accompanying program", r"the accompanying program is provided under the terms of this common public license"),
    ("epl-1.0", "the accompanying program", r"the accompanying program is provided under the terms of this eclipse public license agreement"),
    ("epl-1.0", "this program and the accompanying", r"this program and the accompanying materials are made available under the terms of the eclipse public license v1 0"),
    ("epl-2.0", "this program and the accompanying", r"this program and the accompanying materials are made available under the terms of the eclipse public license(?: v)? ?2 0"),
    ("epl-2.0", "this source code may also", r"this source code may also be made available under the following secondary licenses when the conditions for such availability"),
    ("eupl-1.1", "european union public", r"european union public licen[cs]e v ?1 1 eupl copyright"),
    ("eupl-1.2", "licensed under the eupl", r"licensed under the eupl version 1 2 or as soon they will be approved by the european commission subsequent versions of the eupl"),
    ("eupl-1.2", "european union public", r"european union public licen[cs]e v ?1 2 eupl"),
    ("artistic-1.0", "the intent of this document", r"the intent of this document is to state the conditions under which a package may be copied such that the copyright holder maintains some semblance of artistic control"),
    ("artistic-2.0", "this license establishes", r"this license establishes the terms under which a given free software package may be copied modified distributed and or redistributed"),
    ("perl", "this library is free", r"this library is free software you can redistribute it and or modify it under the same terms as perl itself"),
    ("ofl-1.1", "this font software", r"this font software is licensed under the sil open font license version 1 1"),
    ("ofl-1.1", "the goals of the open", r"the goals of the open font license ofl are to stimulate worldwide development of collaborative font projects"),
    ("ubuntu-font-1.0", "this licence allows", r"this licence allows the licensed fonts to be used studied modified and redistributed freely"),
    ("bitstream-vera", "bitstream vera", r"bitstream vera is a trademark of bitstream inc"),
    ("cc-by-4.0", "by exercising the licensed", r"by exercising the licensed rights defined below you accept and agree to be bound by the terms and conditions of this creative commons attribution 4 0 international public license"),
    ("cc-by-sa-4.0", "by exercising the licensed", r"by exercising the licensed rights defined below you accept and agree to be bound by the terms and conditions of this creative commons attribution sharealike 4 0 international public license"),
    ("cc-by-nc-4.0", "by exercising the licensed", r"by exercising the licensed rights defined below you accept and agree to be bound by the terms and conditions of this creative commons attribution noncommercial 4 0 international public license"),
    ("cc", "the work as defined", r"the work as defined below is provided under the terms of this creative commons public license ccpl or license"),
    ("cc0-1.0", "to the extent possible", r"to the extent possible under law (?:the (?:author|person who associated cc0 with this work)(?: s)?) (?:has|have) waived all copyright and related or neighboring rights to this work"),
    ("cc0-1.0", "the laws of most", r"the laws of most jurisdictions throughout the world automatically confer exclusive copyright and related rights"),
    ("public-domain", "the author hereby", r"the author hereby disclaims copyright to this source code"),
    ("public-domain", "no copyright is claimed", r"no copyright is claimed in the united states"),
    ("blessing", "may you do good", r"may you do good and not evil may you find forgiveness for yourself and forgive others"),
    ("unlicense", "anyone is free", r"anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary"),
    ("wtfpl", "everyone is permitted", r"everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed"),
    ("gpl", "everyone is permitted", r"everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed"),
    ("beerware", "as long as you retain", r"as long as you retain this notice you can do whatever you want with this stuff"),
    ("zlib", "the origin of this", r"the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("zlib", "altered source versions", r"altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("libpng", "this copy of the libpng", r"this copy of the libpng notices is provided for your convenience"),
    ("ijg", "this software is based", r"this software is based in part on the work of the independent jpeg group"),
    ("curl", "except as contained", r"except as contained in this notice the name of a copyright holder shall not be used in advertising or otherwise to promote the sale"),
    ("boost-1.0", "permission is hereby", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("openssl", "this product includes", r"this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("ssleay", "this product includes", r"this product includes cryptographic software written by eric young"),
    ("php-3.01", "this product includes php", r"this product includes php software freely available from"),
    ("python-2.0", "this license agreement", r"this license agreement is between the python software foundation psf and the individual or organization licensee"),
    ("zope-2.1", "this software consists", r"this software consists of voluntary contributions made by zope corporation and many individuals on behalf of zope"),
    ("ruby", "you may make and give", r"you may make and give away verbatim copies of the source form of the software without restriction provided that you duplicate all of the original copyright notices"),
    ("tcl", "the authors hereby grant", r"the authors hereby grant permission to use copy modify distribute and license this software and its documentation for any purpose"),
    ("postgresql", "permission to use", r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("unicode", "permission is hereby", r"permission is hereby granted free of charge to any person obtaining a copy of the unicode data files and any associated documentation"),
    ("icu", "provided that the above", r"provided that the above copyright notice(?: s)? and this permission notice appear in all copies of the software and that both the above copyright notice"),
    ("ncsa", "redistributions of source", r"redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimers"),
    ("w3c", "permission to copy", r"permission to copy modify and distribute this (?:software and its documentation|work) with or without modification for any purpose and without fee or royalty is hereby granted"),
    ("afl-3.0", "licensed under the academic", r"licensed under the academic free license version 3 0"),
    ("osl-3.0", "licensed under the open", r"licensed under the open software license version 3 0"),
    ("ms-pl", "this license governs", r"this license governs use of the accompanying software if you use the software you accept this license"),
    ("jsr", "the software shall be used", r"the software shall be used for good not evil"),
    ("odbl-1.0", "open database license", r"this database is made available under the open database license"),
    ("pddl-1.0", "public domain dedication", r"this database is made available under the public domain dedication and license"),
    ("sspl-1.0", "server side public", r"server side public license(?: version)? 1"),
    ("busl-1.1", "business source license", r"business source license(?: version)? 1 1"),
    ("elastic-2.0", "you may not provide", r"you may not provide the software to third parties as a hosted or managed service"),
    ("commons-clause", "the software is provided to you", r"the software is provided to you by the licensor under the license as defined below subject to the following condition"),
    ("polyform-nc", "polyform noncommercial", r"polyform noncommercial license(?: 1 0 0)?"),
    ("llama", "community license agreement", r"llama [1-4](?: [1-4])? community license agreement"),
    ("openrail-m", "responsible ai", r"(?:bigscience|creativeml) (?:open )?responsible ai license"),
    ("openrail-m", "openrail", r"(?:bigscience|creativeml) (?:open )?openrail(?: m)? license"),
    ("gutenberg", "this ebook is for the use", r"this ebook is for the use of anyone anywhere (?:in the united states and most other parts of the world )?at no cost and with almost no restrictions"),
    ("fair-use-notice", "no part of this", r"no part of this (?:publication|book) may be reproduced(?: distributed)?(?: stored in a retrieval system)? or transmitted in any form or by any means"),
    ("proprietary", "copying of this file", r"unauthori[sz]ed copying of this file via any medium is strictly prohibited"),
    ("proprietary", "this software contains", r"this software contains (?:confidential|proprietary) (?:and (?:confidential|proprietary|trade secret) )?information of"),
)
# SPDX identifiers, as words, that are not the words of their label.
TAGS = (("bsd-0-clause", "0bsd"), ("boost-1.0", "bsl 1 0"), ("python-2.0", "psf 2 0"))


def _identifiers() -> list[Rule]:
    """SPDX tags: ``spdx license identifier`` and the label's words, for every label, or the identifier's own."""
    labels = dict.fromkeys([n[0] for n in NAMES] + [s[0] for s in SIGNS])
    tags = [(label, label.replace("-", " ").replace(".", " ")) for label in labels] + list(TAGS)
    return [Rule(label, "spdx", f"spdx licen[cs]e identifier {words}(?: only| or later)?", 9000, 0.99) for label, words in tags]


def rules() -> list[Rule]:
    """All rules; tags come before sentences and addresses, those before names, and fuller forms of a name before the bare one.

    A name's later entries are less specific, so their priority is lower.
    """
    found = _identifiers() + [Rule(label, keyword, pattern, 8000, 0.9) for label, keyword, pattern in SIGNS]
    for place, (label, keyword, pattern) in enumerate(NAMES):
        found += [Rule(label, keyword, f"{before}(?:{pattern})", 1000 * level - place, confidence) for before, level, confidence in FORMS]
    return found


def _lowered(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def _places(joined: str, pattern: str) -> str:
    """SQL: start and end (in words) of every match of ``pattern`` in ``joined``, which has a space around each word.

    The text between matches and the matches themselves are gone through in order; spaces count words.
    """
    whole = f"concat('(?<= )(?:', {pattern}, ')(?= )')"
    spaces = "length({0}) - length(replace({0}, ' ', ''))"
    return f"""aggregate(
        zip_with(split({joined}, {whole}, -1), regexp_extract_all({joined}, {whole}, 0), (g, h) -> struct(g AS gap, h AS hit)),
        struct(-1 AS words, cast(array() AS array<struct<start:int,end:int>>) AS found),
        (state, x) -> CASE WHEN x.hit IS NULL THEN state ELSE struct(
          state.words + {spaces.format('x.gap')} + {spaces.format('x.hit')} AS words,
          concat(state.found, array(struct(state.words + {spaces.format('x.gap')} AS start,
            state.words + {spaces.format('x.gap')} + {spaces.format('x.hit')} + 1 AS end))) AS found) END,
        state -> state.found)"""


def _rule_table(known: list[Rule]) -> Column:
    """All rules as one constant array."""
    return F.array(*[F.struct(F.lit(r.label).alias("label"), F.lit(f" {r.keyword}").alias("keyword"), F.lit(r.pattern).alias("pattern"),
                              F.lit(r.priority).alias("priority"), F.lit(r.confidence).alias("confidence")) for r in known])


def _gate(known: list[Rule]) -> str:
    """One pattern that every text with a rule's keyword matches, in either case and with any separators.

    Keywords are sorted by their first letter and only tried where a word may start.
    """
    words = {r.keyword for r in known} | {p for p, _ in BASE}
    needed = [k for k in sorted(words) if not any(k != other and k.startswith(other) for other in words)]
    first: dict[str, list[str]] = {}
    for k in needed:
        first.setdefault(k[0], []).append("[^0-9A-Za-z]+".join(k[1:].split(" ")))
    return "(?i)(?<![0-9A-Za-z])(?:" + "|".join(f"{letter}(?:{'|'.join(rest)})" for letter, rest in first.items()) + ")"


_HIT = "struct<start:int,end:int,priority:int,label:string,confidence:double>"
_BETTER = """(a, b) -> CASE
      WHEN a.priority <> b.priority THEN b.priority - a.priority
      WHEN a.end - a.start <> b.end - b.start THEN (b.end - b.start) - (a.end - a.start)
      WHEN a.start <> b.start THEN a.start - b.start
      WHEN a.label < b.label THEN -1 WHEN a.label > b.label THEN 1 ELSE 0 END"""
# Of detections that touch each other: the best of those that lie in no longer one stays, what overlaps
# it goes, and what is left is judged anew.
_JUDGE = f"""aggregate(sequence(1, size(group)), struct(group AS left, cast(array() AS array<{_HIT}>) AS kept),
    (state, i) -> CASE WHEN size(state.left) = 0 THEN state ELSE element_at(transform(array(element_at(array_sort(
        filter(state.left, x -> NOT exists(state.left, y -> y.start <= x.start AND x.end <= y.end AND y.end - y.start > x.end - x.start)),
        {_BETTER}), 1)), best -> struct(
          filter(state.left, x -> x.start >= best.end OR x.end <= best.start) AS left, concat(state.kept, array(best)) AS kept)), 1) END,
    state -> state.kept)"""
_RESOLVE = f"""array_sort(flatten(transform(aggregate(
    array_sort(_all, (a, b) -> CASE WHEN a.start <> b.start THEN a.start - b.start ELSE b.end - a.end END),
    struct(0 AS reach, cast(array() AS array<{_HIT}>) AS open, cast(array() AS array<array<{_HIT}>>) AS done),
    (state, x) -> CASE WHEN x.start >= state.reach
      THEN struct(x.end AS reach, array(x) AS open, CASE WHEN size(state.open) = 0 THEN state.done ELSE concat(state.done, array(state.open)) END AS done)
      ELSE struct(greatest(state.reach, x.end) AS reach, concat(state.open, array(x)) AS open, state.done AS done) END,
    state -> CASE WHEN size(state.open) = 0 THEN state.done ELSE concat(state.done, array(state.open)) END),
    group -> CASE WHEN size(group) = 1 THEN group ELSE {_JUDGE} END)))"""


def scan_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", known: list[Rule] | None = None) -> DataFrame:
    """Per document ``n_words``, the places of base phrases and the resolved detections of the rules.

    ``base``: array of (label, start), ``detections``: array of (start, end, priority, label,
    confidence), both in words from 0. One row per row; null and empty texts have no words, and both
    arrays are empty where nothing is found. No shuffle, and no Python on the executors.
    """
    known = rules() if known is None else known
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), whole.alias("_text")).select(
        "doc_id", F.regexp_count("_text", F.lit(WORD)).cast("long").alias("n_words"),
        F.when(F.col("_text").rlike(_gate(known)), F.col("_text")).alias("_gated"))
    none_base = "cast(array() AS array<struct<label:string,start:int>>)"
    none = "cast(array() AS array<struct<start:int,end:int,priority:int,label:string,confidence:double>>)"
    joined = F.concat(F.lit(" "), F.array_join(F.regexp_extract_all(_lowered(F.col("_gated")), F.lit(WORD), F.lit(0)), " "), F.lit(" "))
    rows = rows.withColumn("_joined", joined)
    base = ", ".join(f"transform({_places('_joined', repr(p))}, x -> struct('{label}' AS label, x.start AS start))" for p, label in BASE)
    rows = rows.withColumn("base", F.expr(f"CASE WHEN _gated IS NULL THEN {none_base} ELSE concat({base}) END"))
    rows = rows.withColumn("_rules", F.when(F.col("_gated").isNotNull(), _rule_table(known)))
    hits = f"""flatten(transform(
        filter(_rules, r -> contains(_joined, r.keyword) AND _joined RLIKE concat('(?<= )(?:', r.pattern, ')(?= )')),
        r -> transform({_places('_joined', 'r.pattern')}, x -> struct(x.start AS start, x.end AS end, r.priority AS priority,
          r.label AS label, r.confidence AS confidence))))"""
    rows = rows.withColumn("_all", F.expr(f"CASE WHEN _gated IS NULL THEN {none} ELSE {hits} END"))
    return rows.select("doc_id", "n_words", "base", F.expr(_RESOLVE).alias("detections"))
