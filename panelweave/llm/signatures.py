"""Signatures written for the texts of licenses: headers, grants, clauses, disclaimers, copyright lines, manifest entries.

One line a rule: label; words without white space, one of which stands in every match; pattern, in which a blank
is any white space, _ stands for one to eight words, and ' for any quotation mark. Texts are lower-cased. Fixed values.
"""

from __future__ import annotations

SIGNATURES = r"""
mit; hereby; permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
mit; notice; the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
mit; merchantability; the software is provided 'as is', without warranty of any kind, express or implied, including but not limited to the warranties of merchantability
mit; liable; in no event shall the (?:authors|copyright holders|authors or copyright holders) be liable for any claim, damages or other liability
mit; osi; licen[cs]e :: osi approved :: mit licen[cs]e
x11; advertising; except as contained in this notice, the names? of _ shall not be used in advertising or otherwise to promote the sale, use or other dealings
isc; fee; permission to use, copy, modify,? and(?:/or)? distribute this software for any purpose with or without fee is hereby granted
isc; disclaims; the software is provided 'as is' and the author disclaims all warranties with regard to this software
isc; osi; licen[cs]e :: osi approved :: isc licen[cs]e
bsd; redistribution; redistribution and use in source and binary forms,? with or without modification,? are permitted
bsd; redistributions; redistributions of source code must retain the above copyright notice
bsd; redistributions; redistributions in binary form must reproduce the above copyright notice
bsd; exemplary; be liable for any direct, indirect, incidental, special, exemplary, or consequential damages
bsd; regents; copyright _ the regents of the university of california
bsd; bsd-style; (?:governed by|licen[cs]ed under|under) a bsd-style licen[cs]e
bsd; osi; licen[cs]e :: osi approved :: bsd licen[cs]e
bsd-3-clause; endorse; neither the names? of _ nor the names of (?:its|their|the) contributors may be used to endorse or promote products
bsd-3-clause; endorse; the name of the author may not be used to endorse or promote products derived from this software
bsd-4-clause; advertising; all advertising materials mentioning features or use of this software must display the following acknowledge?ment
bsd-2-clause; freebsd; (?:should not be interpreted as representing|representing) official policies, either expressed or implied, of the freebsd project
gpl; redistribute; this (?:program|file|package) is free software[:;,] you can redistribute it and/or modify it under the terms of the gnu general public licen[cs]e
gpl; received; you should have received a copy of the gnu general public licen[cs]e
gpl; hope; distributed in the hope that it will be useful, but without any warranty
gpl; foundation; free software foundation, inc\., (?:59 temple place|51 franklin st)
gpl; osi; licen[cs]e :: osi approved :: gnu general public licen[cs]e
gpl; module_license; module_license ?\( ?'(?:dual )?(?:bsd/|mit/)?gpl
gpl-2.0; freedom; the licen[cs]es for most software are designed to take away your freedom to share and change it
gpl-2.0; activities; activities other than copying, distribution and modification are not covered by this licen[cs]e
gpl-3.0; copyleft; the gnu general public licen[cs]e is a free, copyleft licen[cs]e for software and other kinds of works
gpl-3.0; convey; you may convey verbatim copies of the program's? source code as you receive it
gpl-3.0; osi; licen[cs]e :: osi approved :: gnu general public licen[cs]e v3
lgpl; redistribute; this (?:library|program) is free software[:;,] you can redistribute it and/or modify it under the terms of the gnu (?:lesser|library) general public licen[cs]e
lgpl; received; you should have received a copy of the gnu (?:lesser|library) general public licen[cs]e
lgpl; osi; licen[cs]e :: osi approved :: gnu (?:lesser|library) (?:or library )?general public licen[cs]e
lgpl-2.1; successor lesser; (?:this is the first released version of the lesser gpl|it also counts as the successor of the gnu library public licen[cs]e)
lgpl-3.0; incorporates; this version of the gnu lesser general public licen[cs]e incorporates the terms and conditions of version 3
agpl; received; you should have received a copy of the gnu affero general public licen[cs]e
agpl-3.0; affero; the gnu affero general public licen[cs]e is a free, copyleft licen[cs]e for software and other kinds of works
agpl-3.0; remotely; all users interacting with it remotely through a computer network
copyleft-text; verbatim; everyone is permitted to copy and distribute verbatim copies of this licen[cs]e document
gfdl; granted; permission is granted to copy, distribute and/or modify this document under the terms of the gnu free documentation licen[cs]e
gfdl; invariant; with no invariant sections,? (?:with )?no front-cover texts
apache-2.0; compliance; you may not use this file except in compliance with the licen[cs]e
apache-2.0; applicable; unless required by applicable law or agreed to in writing, software distributed under the licen[cs]e is distributed on an 'as is' basis
apache-2.0; contributor; licen[cs]ed to the apache software foundation \(asf\) under one or more contributor licen[cs]e agreements
apache-2.0; additional; see the notice file distributed with this work for additional information regarding copyright ownership
apache-2.0; prominent; you must cause any modified files to carry prominent notices stating that you changed the files
apache; apache; this product includes software developed (?:by|at) the apache (?:software foundation|group)
apache; osi; licen[cs]e :: osi approved :: apache software licen[cs]e
mpl-2.0; mozilla; this source code form is subject to the terms of the mozilla public licen[cs]e
mpl-2.0; mpl; if a copy of the mpl was not distributed with this file
mpl-2.0; secondary; incompatible with secondary licen[cs]es
mpl-1.1; contents; the contents of this file are subject to the mozilla public licen[cs]e version
mpl-1.1; alternatively; alternatively, the contents of this file may be used under the terms of
mpl; osi; licen[cs]e :: osi approved :: mozilla public licen[cs]e
epl; accompanying; this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e
epl; accompanying; the accompanying program is provided under the terms of this eclipse public licen[cs]e
cpl-1.0; accompanying; the accompanying program is provided under the terms of this common public licen[cs]e
cddl; contents; the contents of this file are subject to the terms of the common development and distribution licen[cs]e
cddl-1.0; opensolaris.license opensolaris.org; usr/src/opensolaris\.license|opensolaris\.org/os/licensing
bsl-1.0; accompanying; to any person or organization obtaining a copy of the software and accompanying documentation covered by this licen[cs]e
bsl-1.0; accompanying; boost software licen[cs]e,? version 1\.0\.? \(see accompanying file
zlib; misrepresented; the origin of this software must not be misrepresented
zlib; plainly; altered source versions must be plainly marked as such
zlib; freely; permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely
libpng; png; the png reference library is supplied 'as is'
unlicense; unencumbered; this is free and unencumbered software released into the public domain
unlicense; publish; anyone is free to copy, modify, publish, use, compile, sell, or distribute this software
wtfpl; fuck; do what the fuck you want to
cc0-1.0; waived; to the extent possible under law, _ (?:has|have) waived all copyright and related or neighbou?ring rights
cc0-1.0; deed; the person who associated a work with this deed has dedicated the work to the public domain
cc; creative; (?:this|the) (?:work|article|document|text|content) is licen[cs]ed under (?:a|the) creative commons
cc; creative; except where otherwise noted, _ (?:is|are) licen[cs]ed under (?:a|the) creative commons
cc; creativecommons.org; to view a copy of this licen[cs]e, visit https?://creativecommons\.org
cc; creative; creative commons, (?:po box 1866, mountain view|171 second street|543 howard street|559 nathan abbott way)
cc-by-nc; commercial; you may not use (?:this work|the material) for commercial purposes
cc-by-sa; transform; if you (?:alter, transform, or build upon this work|remix, transform, or build upon the material), you (?:may|must) distribute
cc-by-nd; alter; you may not alter, transform, or build upon this work
artistic; perl; (?:under|on) the same terms as (?:the )?perl(?: 5)?(?: programming language)?(?: system)? itself
artistic-1.0; verbatim; you may make and give away verbatim copies of the source form of the standard version of this package
artistic-2.0; standard; you are permitted to use the standard version and create and use modified versions for any purpose
python-2.0; psf; this licen[cs]e agreement is between the python software foundation \('psf'\)
python-2.0; osi; licen[cs]e :: osi approved :: python software foundation licen[cs]e
openssl; openssl; this product includes software developed by the openssl project
openssl; cryptographic; this product includes cryptographic software written by eric young
php; php; this product includes php(?: software)?, freely available from
postgresql; agreement; for any purpose, without fee, and without a written agreement is hereby granted
ncsa; deal; to deal with the software without restriction, including without limitation the rights
ofl-1.1; font; this font software is licen[cs]ed under the sil open font licen[cs]e
ofl-1.1; font; neither the font software nor any of its individual components, in original or modified versions, may be sold by itself
ofl; reserved; with reserved font names?
hpnd; publicity; not be used in advertising or publicity pertaining to distribution of the software without specific, written prior permission
hpnd; fee; permission to use, copy, modify,? and distribute this software and its documentation for any purpose and without fee is hereby granted
ms-pl; accompanying; this licen[cs]e governs use of the accompanying software\. if you use the software, you accept this licen[cs]e
lppl; latex; this work may be distributed and/or modified under the conditions of the latex project public licen[cs]e
lppl; maintenance; this work has the lppl maintenance status
eupl; eupl; licen[cs]ed under the eupl
cecill; cecill; this software is governed by the cecill(?:-[abc])? licen[cs]e under french law
sspl-1.0; functionality; if you make the functionality of the program or a modified version available to third parties as a service
busl-1.1; non-production; the licensor hereby grants you the right to copy, modify, create derivative works, redistribute, and make non-production use
elastic-2.0; hosted; you may not provide the software to third parties as a hosted or managed service
ijg; jpeg; this software is based in part on the work of the independent jpeg group
ftl; freetype; portions of this software are copyright _ the freetype project
unicode-dfs; unicode; free of charge, to any person obtaining a copy of the unicode data files
w3c; obtaining; by obtaining, using and/or copying this work, you \(the licensee\) agree that you have read, understood, and will comply
json; evil; the software shall be used for good, not evil
blessing; evil; may you do good and not evil
beerware; beer-ware beer; (?:the beer-ware licen[cs]e|you can buy me a beer in return)
odbl-1.0; odbl database; made available (?:here )?under the (?:open database licen[cs]e|odbl)
ogl-uk-3.0; sector; contains public sector information licen[cs]ed under the open government licen[cs]e
public-domain; disclaim; the authors? (?:hereby )?disclaims? copyright to this source code
public-domain; domain; (?:placed|put) (?:in|into) the public domain
public-domain; reserved; no rights reserved
public-domain; government; this is a work of the (?:u\.s\.|united states) government
proprietary; reserved; all rights reserved
proprietary; proprietary; (?:contains|is) (?:confidential and )?proprietary(?: and confidential)? information
proprietary; unauthorized unauthorised; unauthori[zs]ed (?:copying|reproduction|use|distribution|disclosure) of this _ (?:is|are) (?:strictly )?prohibited
proprietary; reproduced; no part of this (?:publication|book|document|work|software) may be reproduced
proprietary; copied; may not be copied, (?:reproduced|modified|published|distributed),? _ without _ (?:permission|consent)
proprietary; internal; for internal use only
eula; sold; (?:the|this) software is licen[cs]ed, not sold
eula; disassemble; (?:may|shall) not reverse[ -]engineer, (?:decompile,? )?(?:or )?disassemble
eula; end-user end; end[ -]user licen[cs]e agreement
eula; non-transferable nontransferable; non-?exclusive, non-?transferable,?(?: limited| revocable)* licen[cs]e
eula; installing downloading; by (?:installing|downloading) _ you (?:agree|accept|consent)
"""

QUOTE = "[\"'‘’“”`]{1,2}"
WORDS = r"\S+(?:\s+\S+){0,7}"


def signatures() -> list[tuple[str, frozenset[str], str]]:
    """(label, words of which one is needed, pattern) of every rule, in the order above."""
    out = []
    for line in SIGNATURES.strip().split("\n"):
        label, words, pattern = line.split("; ", 2)
        blank = r"\s+"
        pattern = pattern.replace("'", QUOTE).replace("[ -]", r"[\s-]").replace(" ?", r"\s*").replace(" _", f" {WORDS}").replace(" ", blank)
        out.append((label, frozenset(words.split()), pattern))
    return out
