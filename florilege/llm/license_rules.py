"""Signature rules of the license scan, in order of priority.

Patterns are matched against a text's plain words, lower-case, with one space
before each and one after the last; ``2.0`` is thus ``2 0``.  Kinds, best
first: full texts and tags, license lines with a name, bare names with a
version, bare names.  A rule's keyword is a literal that each of its matches
holds; only texts with the keyword meet the pattern.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

#: label: (what may stand before the name, the name's forms).  The literal that a form begins with is its keyword.
FAMILIES: dict[str, tuple[str, tuple[str, ...]]] = {
    "gpl": ("(?:gnu )?", ("general public licen[cs]e", "gpl")),
    "lgpl": ("(?:gnu )?", ("lesser general public licen[cs]e", "library general public licen[cs]e", "lgpl")),
    "agpl": ("(?:gnu )?", ("affero general public licen[cs]e", "agpl")),
    "gfdl": ("(?:gnu )?", ("free documentation licen[cs]e", "gfdl")),
    "apache": ("", ("apache(?: software)? licen[cs]e", "apache(?= (?:v|version )?[12]\\b)")),
    "mpl": ("", ("mozilla public licen[cs]e", "mpl")),
    "epl": ("", ("eclipse public licen[cs]e", "epl")),
    "cddl": ("", ("common development and distribution licen[cs]e", "cddl")),
    "cpl": ("", ("common public licen[cs]e",)),
    "eupl": ("", ("european union public licen[cs]e", "eupl")),
    "osl": ("", ("open software licen[cs]e",)),
    "afl": ("", ("academic free licen[cs]e",)),
    "apsl": ("", ("apple public source licen[cs]e", "apsl")),
    "artistic": ("", ("artistic licen[cs]e",)),
    "bsl": ("", ("boost software licen[cs]e", "boost licen[cs]e")),
    "busl": ("", ("business source licen[cs]e", "busl")),
    "cecill": ("", ("cecill(?: licen[cs]e)?",)),
    "ofl": ("(?:sil )?", ("open font licen[cs]e",)),
    "psf": ("", ("python software foundation licen[cs]e", "psf licen[cs]e")),
    "zpl": ("", ("zope public licen[cs]e",)),
    "php": ("", ("php licen[cs]e",)),
    "ruby": ("", ("ruby licen[cs]e",)),
    "ms-pl": ("", ("microsoft public licen[cs]e",)),
    "ms-rl": ("", ("microsoft reciprocal licen[cs]e",)),
    "odbl": ("", ("open database licen[cs]e", "odbl")),
    "odc-by": ("", ("open data commons attribution licen[cs]e",)),
    "pddl": ("", ("public domain dedication and licen[cs]e", "pddl")),
    "unlicense": ("", ("unlicense",)),
    "wtfpl": ("", ("wtfpl", "do what the fuck you want to public licen[cs]e")),
    "zlib": ("", ("zlib(?: libpng)? licen[cs]e",)),
    "isc": ("", ("isc licen[cs]e",)),
    "mit": ("", ("mit licen[cs]e", "expat licen[cs]e", "x11 licen[cs]e")),
    "mit-0": ("", ("mit no attribution(?: licen[cs]e)?",)),
    "bsd": ("", ("bsd(?: style)? licen[cs]e",)),
    "bsd-2-clause": ("", ("bsd (?:2|two) clause", "(?:2|two) clause bsd", "simplified bsd licen[cs]e", "freebsd licen[cs]e")),
    "bsd-3-clause": ("", ("bsd (?:3|three) clause", "(?:3|three) clause bsd", "new bsd licen[cs]e", "modified bsd licen[cs]e", "revised bsd licen[cs]e")),
    "bsd-4-clause": ("", ("bsd (?:4|four) clause", "(?:4|four) clause bsd", "original bsd licen[cs]e", "old bsd licen[cs]e")),
    "0bsd": ("", ("0bsd", "zero clause bsd", "bsd zero clause")),
    "ncsa": ("", ("university of illinois ncsa(?: open source)? licen[cs]e", "ncsa(?: open source)? licen[cs]e")),
    "openssl": ("", ("openssl licen[cs]e",)),
    "postgresql": ("", ("postgresql licen[cs]e",)),
    "vim": ("", ("vim licen[cs]e",)),
    "upl": ("", ("universal permissive licen[cs]e",)),
    "blueoak": ("", ("blue oak model licen[cs]e",)),
    "mulan": ("", ("mulan psl", "mulan permissive software licen[cs]e")),
    "sspl": ("", ("server side public licen[cs]e", "sspl")),
    "elastic": ("", ("elastic licen[cs]e",)),
    "openrail": ("", ("openrail(?: m)?", "responsible ai licen[cs]e", "rail licen[cs]e")),
    "cc0": ("", ("cc0", "cc zero", "creative commons zero")),
    "cc-by": ("", ("cc by", "creative commons attribution")),
    "cc-by-sa": ("", ("cc by sa", "creative commons attribution share ?alike")),
    "cc-by-nd": ("", ("cc by nd", "creative commons attribution no ?deriv(?:s|atives|ative works)")),
    "cc-by-nc": ("", ("cc by nc", "creative commons attribution non ?commercial")),
    "cc-by-nc-sa": ("", ("cc by nc sa", "creative commons attribution non ?commercial share ?alike")),
    "cc-by-nc-nd": ("", ("cc by nc nd", "creative commons attribution non ?commercial no ?deriv(?:s|atives|ative works)")),
}
#: Versions that families are known in, as they are written with dots.
VERSIONS: dict[str, tuple[str, ...]] = {
    "gpl": ("1", "2", "3"), "lgpl": ("2", "2.1", "3"), "agpl": ("1", "3"), "gfdl": ("1.1", "1.2", "1.3"), "apache": ("1.0", "1.1", "2.0"),
    "mpl": ("1.0", "1.1", "2.0"), "epl": ("1.0", "2.0"), "cddl": ("1.0", "1.1"), "eupl": ("1.0", "1.1", "1.2"), "osl": ("1.0", "2.0", "2.1", "3.0"),
    "afl": ("1.1", "2.0", "2.1", "3.0"), "apsl": ("1.0", "1.1", "2.0"), "artistic": ("1.0", "2.0"), "bsl": ("1.0",), "busl": ("1.1",), "cecill": ("1.0", "2.0", "2.1"),
    "ofl": ("1.0", "1.1"), "zpl": ("2.0", "2.1"), "php": ("3.0", "3.01"), "odbl": ("1.0",), "odc-by": ("1.0",), "upl": ("1.0",), "mulan": ("1", "2"), "elastic": ("1", "2.0"), "cc0": ("1.0",),
    **dict.fromkeys(("cc-by", "cc-by-sa", "cc-by-nd", "cc-by-nc", "cc-by-nc-sa", "cc-by-nc-nd"), ("1.0", "2.0", "2.5", "3.0", "4.0")),
}
#: Phrases of license texts and notices: label, keyword, pattern, weight.
TEXTS: tuple[tuple[str, str, str, float], ...] = (
    ("mit", "permission is hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy of this software(?: and associated documentation files)?", 1.0),
    ("mit", "permission notice shall", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", 1.0),
    ("isc", "use copy modify", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", 1.0),
    ("bsd", "source and binary forms", r"redistribution and use in source and binary forms with or without modification are permitted", 1.0),
    ("bsd-3-clause", "endorse or promote", r"neither the names? of (?:[^ ]+ ){1,12}?may be used to endorse or promote products derived from this software", 1.0),
    ("bsd-4-clause", "advertising materials", r"all advertising materials mentioning features or use of this software must display the following acknowledgement", 1.0),
    ("apache-2.0", "apache org licenses", r"(?:http |https )?(?:www )?apache org licenses license 2 0", 1.0),
    ("apache-2.0", "may not use this file", r"you may not use this file except in compliance with the license", 0.9),
    ("gpl", "free software foundation", r"you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", 1.0),
    ("lgpl", "free software foundation", r"under the terms of the gnu (?:lesser|library) general public license as published by the free software foundation", 1.0),
    ("agpl", "free software foundation", r"under the terms of the gnu affero general public license as published by the free software foundation", 1.0),
    ("gpl-3.0", "gnu org licenses", r"gnu org licenses gpl 3 0", 1.0),
    ("gpl-2.0", "gnu org licenses", r"gnu org licenses (?:old licenses )?gpl 2 0", 1.0),
    ("lgpl-2.1", "gnu org licenses", r"gnu org licenses (?:old licenses )?lgpl 2 1", 1.0),
    ("lgpl-3.0", "gnu org licenses", r"gnu org licenses lgpl 3 0", 1.0),
    ("agpl-3.0", "gnu org licenses", r"gnu org licenses agpl 3 0", 1.0),
    ("mpl-2.0", "mozilla org mpl", r"mozilla org mpl 2 0", 1.0),
    ("mpl-2.0", "mozilla public license", r"subject to the terms of the mozilla public license v 2 0", 1.0),
    ("unlicense", "released into the public domain", r"this is free and unencumbered software released into the public domain", 1.0),
    ("public-domain", "public domain", r"(?:released into|placed in|dedicated to|is in) the public domain", 0.8),
    ("cc0-1.0", "publicdomain zero", r"creativecommons org publicdomain zero 1 0", 1.0),
    ("zlib", "as is", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable", 1.0),
    ("bsl-1.0", "boost org", r"boost org license 1 0 txt", 1.0),
    ("ofl-1.1", "scripts sil org", r"scripts sil org ofl", 1.0),
    ("wtfpl", "do what the fuck", r"you just do what the fuck you want to", 1.0),
    ("proprietary", "all rights reserved", r"all rights reserved", 0.4),
    ("proprietary", "confidential and proprietary", r"confidential and proprietary", 0.6),
    ("proprietary", "without the prior written permission", r"may not be (?:reproduced|copied|distributed) (?:[^ ]+ ){0,8}?without the prior written permission", 0.7),
    ("copyright", "copyright", r"copyright (?:c )?(?:19|20)[0-9][0-9](?: (?:19|20)[0-9][0-9]){0,40}", 0.3),
)
#: More of them, in order of priority, one a line: weight, label, pattern.  The keyword is the pattern's longest literal.
WRITTEN = """
1.0 mit | the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability
1.0 mit | to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies
0.9 mit | to permit persons to whom the software is furnished to do so
0.9 mit | in no event shall the authors or copyright holders be liable for any claim damages or other liability
1.0 mit | opensource org licenses mit
0.8 mit | choosealicense com licenses mit
0.9 mit-modern-variant | the copyright notice and this permission notice appear in all copies
1.0 mit-0 | opensource org licenses mit 0
1.0 isc | the software is provided as is and the author disclaims all warranties with regard to this software
0.9 isc | in no event shall the author be liable for any special direct indirect or consequential damages
1.0 isc | opensource org licenses isc
1.0 hpnd | permission to use copy modify and distribute this software and its documentation for any purpose and without fee is hereby granted
0.9 hpnd | provided that the above copyright notice appear in all copies and that both that copyright notice and this permission notice appear in supporting documentation
1.0 bsd | redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
1.0 bsd | redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer
0.9 bsd | this software is provided by the copyright holders and contributors as is
0.9 bsd | this software is provided by the (?:author|authors|regents and contributors) as is
0.9 bsd | the implied warranties of merchantability and fitness for a particular purpose are disclaimed
0.8 bsd | in no event shall the copyright (?:holder|owner) or contributors be liable
0.8 bsd | use of this source code is governed by a bsd style license
1.0 bsd-2-clause | opensource org licenses bsd 2 clause
1.0 bsd-3-clause | opensource org licenses bsd 3 clause
1.0 bsd-3-clause | the name of the (?:author|company|copyright holder|university) may not be used to endorse or promote products
1.0 bsd-3-clause-clear | no express or implied licenses to any party s patent rights are granted by this license
1.0 bsd-4-clause | this product includes software developed by the university of california berkeley
0.8 bsd-4-clause | this product includes software developed by
1.0 bsd-2-clause-patent | subject to the terms and conditions of this license each copyright holder and contributor hereby grants to those receiving rights under this license a perpetual
1.0 0bsd | opensource org licenses 0bsd
1.0 apache-2.0 | unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
1.0 apache-2.0 | licensed to the apache software foundation asf under one or more contributor license agreements
0.9 apache-2.0 | see the notice file distributed with this work for additional information regarding copyright ownership
0.9 apache-2.0 | see the license for the specific language governing permissions and limitations under the license
1.0 apache-2.0 | opensource org licenses apache 2 0
0.9 apache-2.0 | this product includes software developed at the apache software foundation
1.0 apache-1.1 | this product includes software developed by the apache software foundation
1.0 gpl | this program is free software you can redistribute it and or modify
1.0 gpl | this program is distributed in the hope that it will be useful but without any warranty
0.9 gpl | without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license
1.0 gpl | you should have received a copy of the gnu general public license along with this program
1.0 gpl | either version (?:2|3) of the license or at your option any later version
0.9 gpl | if not write to the free software foundation inc
1.0 gpl | the gnu general public license is a free copyleft license for software and other kinds of works
0.9 gpl | the licenses for most software are designed to take away your freedom to share and change it
1.0 gpl-3.0 | opensource org licenses gpl 3 0
1.0 gpl-2.0 | opensource org licenses gpl 2 0
1.0 gpl-2.0 | gnu general public license version 2 june 1991
1.0 gpl-3.0 | gnu general public license version 3 29 june 2007
1.0 gpl-2.0-with-classpath-exception | linking this library statically or dynamically with other modules is making a combined work based on this library
1.0 gpl-3.0-with-gcc-exception | gcc runtime library exception
0.9 gpl-2.0-with-linux-syscall-note | this copyright does not cover user programs that use kernel services by normal system calls
1.0 lgpl | this library is free software you can redistribute it and or modify
1.0 lgpl | this library is distributed in the hope that it will be useful but without any warranty
1.0 lgpl | you should have received a copy of the gnu (?:lesser|library) general public license along with this library
1.0 lgpl-2.1 | gnu lesser general public license version 2 1 february 1999
1.0 lgpl-3.0 | gnu lesser general public license version 3 29 june 2007
1.0 lgpl-2.0 | gnu library general public license version 2 june 1991
1.0 lgpl-2.1 | opensource org licenses lgpl 2 1
1.0 lgpl-3.0 | opensource org licenses lgpl 3 0
1.0 agpl | you should have received a copy of the gnu affero general public license along with this program
1.0 agpl-3.0 | gnu affero general public license version 3 19 november 2007
1.0 agpl-3.0 | opensource org licenses agpl 3 0
1.0 gfdl | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
0.9 gfdl | with no invariant sections no front cover texts and no back cover texts
1.0 gfdl-1.3 | gnu org licenses fdl 1 3
1.0 mpl-2.0 | this source code form is subject to the terms of the mozilla public license
1.0 mpl-2.0 | if a copy of the mpl was not distributed with this file
1.0 mpl-2.0 | this source code form is incompatible with secondary licenses
1.0 mpl-1.1 | the contents of this file are subject to the mozilla public license version 1 1
0.9 mpl-1.1 | alternatively the contents of this file may be used under the terms of either the gnu general public license
1.0 mpl-2.0 | opensource org licenses mpl 2 0
1.0 epl-1.0 | this program and the accompanying materials are made available under the terms of the eclipse public license v1 0
1.0 epl-2.0 | this program and the accompanying materials are made available under the terms of the eclipse public license 2 0
1.0 epl-2.0 | www eclipse org legal epl 2 0
1.0 epl-1.0 | www eclipse org legal epl v10
1.0 edl-1.0 | www eclipse org org documents edl v10
1.0 cddl | the contents of this file are subject to the terms of the common development and distribution license
0.9 cddl | you can obtain a copy of the license at usr src opensolaris license
1.0 cddl-1.0 | opensource org licenses cddl 1 0
1.0 cpl-1.0 | opensource org licenses cpl1 0
1.0 eupl-1.2 | joinup ec europa eu software page eupl
1.0 eupl | licensed under the eupl
1.0 cecill | this software is governed by the cecill license under french law
1.0 artistic-2.0 | opensource org licenses artistic license 2 0
1.0 artistic-1.0 | the intent of this document is to state the conditions under which a package may be copied
1.0 perl | under the same terms as perl itself
1.0 bsl-1.0 | distributed under the boost software license version 1 0
0.9 bsl-1.0 | permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license
1.0 busl-1.1 | the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work
1.0 sspl-1.0 | if you make the functionality of the program or a modified version available to third parties as a service
1.0 elastic-2.0 | you may not provide the software to third parties as a hosted or managed service
1.0 commons-clause | without limiting other conditions in the license the grant of rights under the license will not include and the license does not grant to you the right to sell the software
0.8 commons-clause | commons clause license condition
1.0 polyform-noncommercial | polyform noncommercial license
1.0 polyform-small-business | polyform small business license
1.0 unlicense | anyone is free to copy modify publish use compile sell or distribute this software
0.9 unlicense | we make this dedication for the benefit of the public at large and to the detriment of our heirs and successors
1.0 unlicense | unlicense org
1.0 wtfpl | everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed
1.0 beerware | the beer ware license
0.9 beerware | if we meet some day and you think this stuff is worth it you can buy me a beer in return
1.0 zlib | permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely
0.9 zlib | the origin of this software must not be misrepresented you must not claim that you wrote the original software
0.9 zlib | altered source versions must be plainly marked as such and must not be misrepresented as being the original software
1.0 libpng | the png reference library is supplied as is
1.0 ijg | this software is based in part on the work of the independent jpeg group
1.0 ftl | portions of this software are copyright [0-9]{4} the freetype project
1.0 openssl | this product includes software developed by the openssl project for use in the openssl toolkit
1.0 ssleay | this product includes cryptographic software written by eric young
1.0 curl | except as contained in this notice the name of a copyright holder shall not be used in advertising or otherwise to promote the sale
1.0 x11 | except as contained in this notice the name of the x consortium shall not be used in advertising
1.0 ncsa | to deal with the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies
1.0 postgresql | permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted
1.0 psf-2.0 | psf hereby grants licensee a nonexclusive royalty free world wide license
0.9 python-cnri | cnri hereby grants licensee a nonexclusive royalty free world wide license
1.0 php-3.01 | this product includes php software freely available from
1.0 php-3.01 | this source file is subject to version 3 01 of the php license
1.0 ruby | you can redistribute it and or modify it under either the terms of the 2 clause bsdl
1.0 vim | vim is charityware
1.0 unicode | unicode org copyright html
1.0 unicode | permission is hereby granted free of charge to any person obtaining a copy of the unicode data files
1.0 w3c | www w3 org consortium legal
1.0 w3c | this work is being provided by the copyright holders under the following license
1.0 icu | icu license icu 1 8 1 and later
1.0 ofl-1.1 | this font software is licensed under the sil open font license
0.9 ofl-1.1 | the fonts including any derivative works can be bundled embedded redistributed and or sold with any software
1.0 ubuntu-font | ubuntu font licen[cs]e
1.0 bitstream-vera | fonts are a trademark of bitstream
1.0 ms-pl | microsoft com opensource licenses mspx
1.0 ms-eula | microsoft software license terms
0.9 ms-eula | end user license agreement
1.0 apsl-2.0 | www opensource apple com apsl
1.0 odbl-1.0 | opendatacommons org licenses odbl
1.0 odc-by-1.0 | opendatacommons org licenses by
1.0 pddl-1.0 | opendatacommons org licenses pddl
1.0 cdla-permissive | community data license agreement permissive
1.0 cdla-sharing | community data license agreement sharing
1.0 ogl-uk | open government licen[cs]e
1.0 ogl-uk | contains public sector information licensed under
1.0 etalab | licence ouverte
1.0 dl-de-by | datenlizenz deutschland namensnennung
1.0 dl-de-zero | datenlizenz deutschland zero
1.0 cc0-1.0 | to the extent possible under law the author s have dedicated all copyright and related and neighboring rights to this software to the public domain
0.9 cc0-1.0 | has waived all copyright and related or neighboring rights
1.0 cc-pdm | creativecommons org publicdomain mark 1 0
0.8 cc-by | except where otherwise noted content on this site is licensed under a creative commons attribution
0.7 creative-commons | some rights reserved
0.7 creative-commons | creative commons licen[cs]e
0.7 creative-commons | licensed under a creative commons
0.8 cc-by-nc | for non commercial use only
0.7 cc-by-nd | no derivative works
0.8 public-domain | this work is in the public domain
0.8 public-domain | this file is in the public domain
0.8 public-domain | no copyright is claimed
0.8 us-government-work | this is a work of the united states government
0.8 us-government-work | not subject to copyright protection in the united states
1.0 llama | llama (?:2|3|3 1|3 2|3 3|4) community license
1.0 llama | meta llama is licensed under the llama
1.0 gemma | gemma terms of use
1.0 bigscience-openrail | bigscience rail license
0.8 openrail | use based restrictions as referenced in paragraph 5
1.0 ai2-impact | ai2 impact license
1.0 nvidia-eula | nvidia software license agreement
1.0 oracle-bcl | oracle binary code license agreement
1.0 oracle-nftc | oracle no fee terms and conditions
1.0 intel-simplified | intel simplified software license
1.0 jsr-spec | specification license agreement
1.0 json | the software shall be used for good not evil
1.0 hippocratic | hippocratic license
1.0 anti-996 | anti 996 license
1.0 ecl-2.0 | educational community license
1.0 efl-2.0 | eiffel forum license
1.0 lppl | latex project public license
1.0 lppl | this work may be distributed and or modified under the conditions of the latex project public license
1.0 sleepycat | oracle com technology software products berkeley db htdocs oslicense
1.0 qpl | q public license
1.0 rpl | reciprocal public license
1.0 nposl | non profit open software license
1.0 simpl | simple public license
1.0 sissl | sun industry standards source license
1.0 spl | sun public license
1.0 npl | netscape public license
1.0 ipl | ibm public license
1.0 lpl | lucent public license
1.0 nasa | nasa open source agreement
1.0 cua-opl | cua office public license
1.0 catosl | computer associates trusted open source license
1.0 motosoto | motosoto open source license
1.0 nokia | nokia open source license
1.0 oclc | oclc research public license
1.0 wxwindows | wxwindows library licen[cs]e
1.0 xnet | x net license
1.0 entessa | entessa public license
1.0 frameworx | frameworx open license
1.0 watcom | sybase open watcom public license
1.0 opl | open publication license
1.0 oset-pl | oset public license
1.0 ncgl | non commercial government licence
0.9 proprietary | this software is the confidential and proprietary information of
0.9 proprietary | unauthorized copying of this file via any medium is strictly prohibited
0.8 proprietary | no part of this (?:publication|book|work|document) may be reproduced
0.8 proprietary | unpublished rights reserved under the copyright laws
0.8 proprietary | no license express or implied is granted
0.7 proprietary | for internal use only not for redistribution under license
0.7 proprietary | this software is licensed not sold
0.7 proprietary | reproduction in whole or in part without (?:written )?permission is prohibited
0.6 license-reference | see the license file
0.6 license-reference | see license txt
0.6 license-reference | see license md
0.6 license-reference | see the copying file for copyright
0.5 license-reference | this project is licensed under the terms of the
0.5 license-reference | governed by the license that can be found in the license file
0.4 license-reference | terms and conditions of the license
"""
#: A text with a match of any rule holds one of these literals, or one of these words (see ``gate``).
GATES = (
    "licen", "gpl", "gfdl", "spdx", "copyright", "apache", "creative", "publicdomain", "bsd", "permission", "rights", "confidential", "mozilla", "clause", "endorse", "cecill", "warrant", "boost", "redistribut", "openrail", "mulan",
    "software", "domain", "trademark", "advertising", "commercial", "gemma", "beer", "parties", "liable", "reproduced", "derivative", "agreement", "copied", "misrepresented", "government", "unauthorized", "restrictions", "charityware",
    "detriment", "invariant", "oracle", "fuck", "combined", "runtime", "perl", "copying", "datenlizenz",
)
GATE_WORDS = ("ofl", "edl", "w3", "evil", "png", "mpl", "epl", "cddl", "eupl", "apsl", "busl", "odbl", "pddl", "wtfpl", "sspl", "cc0", "cc[^0-9a-z]+(?:by|zero)", "mit[^0-9a-z]+no")

#: Words that lead from a verb to the license's name.
GRANT = r"(?:licensed|released|distributed|published|available|provided|made available|redistributed|shared) (?:under|subject to)(?: an?| the)?(?: terms of)?(?: the)?"


@dataclass(frozen=True)
class Rule:
    rule: int
    label: str
    keyword: str
    pattern: str
    weight: float


def _name(label: str, version: str | None) -> str:
    return label if version is None else f"{label}-{version}.0" if label in ("gpl", "lgpl", "agpl") and "." not in version else f"{label}-{version}"


def _version(version: str) -> str:
    major, _, minor = version.partition(".")
    tail = f"(?: {minor})?" if minor == "0" else f" {minor}" if minor else "(?: 0)?"
    return rf"(?: licen[cs]e)?(?: international| generic| unported| public licen[cs]e)?(?: version| v)? v?{major}{tail}(?: international| generic| unported)?(?: or later| or newer| or any later version| only)?"


def build() -> list[Rule]:
    """All rules; a lower number has priority."""
    found: list[tuple[str, str, str, float]] = list(TEXTS)
    for line in WRITTEN.strip().splitlines():
        (weight, label), pattern = line.split(" | ")[0].split(), line.split(" | ")[1]
        found.append((label, keyword_of(pattern), pattern, float(weight)))
    forms = [(label, None) for label in FAMILIES] + [(label, v) for label, vs in VERSIONS.items() for v in vs]
    for label, version in forms:
        identifier = label.replace("-", " ") + (" " + version.replace(".", "(?: )") if version else "")
        if version and "." not in version:
            identifier += "(?: 0)?"
        found.append((_name(label, version), "spdx", rf"spdx licen[cs]e identifier {identifier}(?: only| or later)?", 1.0))
    for label in (x for x in VERSIONS if x.startswith("cc-by")):
        path = label.removeprefix("cc-").replace("-", " ")
        found += [(f"{label}-{v}", "creativecommons org", rf"creativecommons org licenses {path} {v.replace('.', ' ')}", 1.0) for v in VERSIONS[label]]
    grants = [(label, v) for label, v in forms if v] + [(label, None) for label in FAMILIES]
    for weight, lead in ((0.9, GRANT + " "), (0.6, "")):
        for label, version in grants:
            before, forms_ = FAMILIES[label]
            for form in forms_:
                pattern = f"{lead}{before}{form}{_version(version) if version else ''}"
                found.append((_name(label, version), keyword_of(form), pattern, weight if version else weight - 0.1))
    return [Rule(i, label, keyword, f" (?:{pattern})(?= )", weight) for i, (label, keyword, pattern, weight) in enumerate(found)]


def keyword_of(form: str) -> str:
    """The longest literal of a form that each of its matches holds: what stands outside groups, classes and options."""
    plain = re.sub(r".\?", "|", re.sub(r"\(\?.*?\)\??|\[.*?\](?:\{\d+\})?", "|", form))
    return max(plain.split("|"), key=len)
