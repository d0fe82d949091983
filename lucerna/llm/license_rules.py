"""Signature rules for licence notices, in order of priority.

A rule reads `label: pattern`.  Patterns are regular expressions over words in lower case with one blank between them; punctuation is gone,
so `version 2.0` reads `version 2 0`.  The word in braces is the rule's keyword: only where it stands is the rule tried, and what is before
and after it in the pattern must match the words before and after it.
"""

from __future__ import annotations

#: Lead-ins that make a mention a notice.
UNDER = "(?:(?:licensed|released|distributed|available|published|provided|covered) (?:under|by) )?(?:the )?(?:terms of the )?"

RULES = r"""
apache-1.0: (?:the )?{apache} (?:software )?licen[sc]e (?:version |v)?1 0
apache-1.1: (?:the )?{apache} (?:software )?licen[sc]e (?:version |v)?1 1
apache-2.0: (?:the )?{apache} (?:software )?licen[sc]e (?:version |v)?2(?: 0)?
apache-2.0: {apache} 2(?: 0)?(?: licen[sc]e)?
apache-2.0: http www {apache} org licenses license 2 0
apache: (?:the )?{apache} (?:software )?licen[sc]e
mit: (?:the )?{mit} (?:x11 )?(?:style )?licen[sc]e
mit: (?:the )?{expat} licen[sc]e
mit: permission is hereby {granted} free of charge to any person obtaining a copy of this software and associated documentation files
mit-0: (?:the )?{mit} no attribution licen[sc]e
x11: (?:the )?{x11} licen[sc]e
isc: (?:the )?{isc} licen[sc]e
isc: permission to use copy modify and or distribute this software for any purpose with or without fee is hereby {granted}
zlib: (?:the )?{zlib}(?: libpng)? licen[sc]e
boost-1.0: (?:the )?{boost} software licen[sc]e(?: version)? 1 0
boost-1.0: {bsl} 1 0
unlicense: (?:the )?{unlicense}
unlicense: free and {unencumbered} software released into the public domain
wtfpl: (?:the )?{wtfpl}
wtfpl: do what the {fuck} you want to public license
0bsd: (?:the )?(?:zero clause|0) {bsd} licen[sc]e
bsd-1-clause: (?:the )?(?:1|one) clause {bsd} licen[sc]e
bsd-2-clause: (?:the )?(?:2|two) clause {bsd} licen[sc]e
bsd-2-clause: (?:the )?simplified {bsd} licen[sc]e
bsd-2-clause: (?:the )?freebsd {licen[sc]e}
bsd-2-clause: {bsd} 2 clause
bsd-3-clause: (?:the )?(?:3|three) clause {bsd} licen[sc]e
bsd-3-clause: (?:the )?(?:new|modified|revised) {bsd} licen[sc]e
bsd-3-clause: {bsd} 3 clause
bsd-4-clause: (?:the )?(?:4|four) clause {bsd} licen[sc]e
bsd-4-clause: (?:the )?(?:original|old) {bsd} licen[sc]e
bsd: {redistribution} and use in source and binary forms with or without modification are permitted
bsd: (?:the )?{bsd} (?:style )?licen[sc]e
agpl-3.0-or-later: (?:gnu )?{affero} general public licen[sc]e (?:version |v)?3(?: 0)? or (?:any )?later
agpl-3.0: (?:gnu )?{affero} general public licen[sc]e (?:version |v)?3(?: 0)?
agpl: (?:gnu )?{affero} general public licen[sc]e
agpl-3.0: (?:gnu )?{agpl} (?:version |v)?3(?: 0)?
agpl-3.0: (?:gnu )?{agplv3}
agpl: (?:gnu )?{agpl}
lgpl-2.0: (?:gnu )?{library} general public licen[sc]e (?:version |v)?2(?: 0)?
lgpl: (?:gnu )?{library} general public licen[sc]e
lgpl-2.1-or-later: (?:gnu )?{lesser} general public licen[sc]e (?:version |v)?2 1 or (?:any )?later
lgpl-2.1: (?:gnu )?{lesser} general public licen[sc]e (?:version |v)?2 1
lgpl-3.0-or-later: (?:gnu )?{lesser} general public licen[sc]e (?:version |v)?3(?: 0)? or (?:any )?later
lgpl-3.0: (?:gnu )?{lesser} general public licen[sc]e (?:version |v)?3(?: 0)?
lgpl: (?:gnu )?{lesser} general public licen[sc]e
lgpl-2.1: (?:gnu )?{lgpl} (?:version |v)?2 1
lgpl-3.0: (?:gnu )?{lgpl} (?:version |v)?3(?: 0)?
lgpl-3.0: (?:gnu )?{lgplv3}
lgpl: (?:gnu )?{lgpl}
gpl-1.0: (?:gnu )?{general} public licen[sc]e (?:version |v)1(?: 0)?
gpl-2.0-or-later: (?:gnu )?{general} public licen[sc]e (?:version |v)?2(?: 0)? or (?:at your option )?(?:any )?later
gpl-2.0: (?:gnu )?{general} public licen[sc]e (?:version |v)?2(?: 0)?
gpl-3.0-or-later: (?:gnu )?{general} public licen[sc]e (?:version |v)?3(?: 0)? or (?:at your option )?(?:any )?later
gpl-3.0: (?:gnu )?{general} public licen[sc]e (?:version |v)?3(?: 0)?
gpl: gnu {general} public licen[sc]e
gpl-2.0: (?:gnu )?{gpl} (?:version |v)?2(?: 0)?
gpl-3.0: (?:gnu )?{gpl} (?:version |v)?3(?: 0)?
gpl-2.0: (?:gnu )?{gplv2}
gpl-3.0: (?:gnu )?{gplv3}
gpl: gnu {gpl}
gpl: {gpl} licen[sc]ed?
gpl-exception: with (?:the )?{classpath} exception
gfdl-1.1: (?:gnu )?free {documentation} licen[sc]e (?:version |v)?1 1
gfdl-1.2: (?:gnu )?free {documentation} licen[sc]e (?:version |v)?1 2
gfdl-1.3: (?:gnu )?free {documentation} licen[sc]e (?:version |v)?1 3
gfdl: (?:gnu )?free {documentation} licen[sc]e
gfdl: {gfdl}
mpl-1.0: (?:the )?{mozilla} public licen[sc]e (?:version |v)?1 0
mpl-1.1: (?:the )?{mozilla} public licen[sc]e (?:version |v)?1 1
mpl-2.0: (?:the )?{mozilla} public licen[sc]e (?:version |v)?2(?: 0)?
mpl: (?:the )?{mozilla} public licen[sc]e
mpl-2.0: {mpl} 2 0
epl-1.0: (?:the )?{eclipse} public licen[sc]e (?:version |v)?1 0
epl-2.0: (?:the )?{eclipse} public licen[sc]e (?:version |v)?2 0
epl: (?:the )?{eclipse} public licen[sc]e
edl-1.0: (?:the )?{eclipse} distribution licen[sc]e(?: (?:version |v)?1 0)?
cpl-1.0: (?:the )?{common} public licen[sc]e(?: (?:version |v)?1 0)?
cpal-1.0: {common} public attribution licen[sc]e
cddl-1.0: {common} development and distribution licen[sc]e(?: (?:version |v)?1 0)?
cddl-1.1: {common} development and distribution licen[sc]e (?:version |v)?1 1
cddl: {cddl}
eupl-1.0: {european} union public licen[sc]e (?:version |v)?1 0
eupl-1.1: {european} union public licen[sc]e (?:version |v)?1 1
eupl-1.2: {european} union public licen[sc]e (?:version |v)?1 2
eupl: {european} union public licen[sc]e
eupl: {eupl}
osl-3.0: {open} software licen[sc]e(?: (?:version |v)?3 0)?
afl-3.0: {academic} free licen[sc]e(?: (?:version |v)?3 0)?
ecl-2.0: {educational} community licen[sc]e(?: (?:version |v)?2 0)?
artistic-1.0: (?:the )?{artistic} licen[sc]e (?:version |v)?1 0
artistic-2.0: (?:the )?{artistic} licen[sc]e (?:version |v)?2 0
artistic: (?:the )?{artistic} licen[sc]e
perl: same terms as {perl} itself
psf-2.0: {python} software foundation licen[sc]e(?: (?:version )?2)?
python-2.0: {python} licen[sc]e(?: (?:version )?2)?
php-3.0: (?:the )?{php} licen[sc]e(?: (?:version )?3 0)?
php-3.01: (?:the )?{php} licen[sc]e (?:version )?3 01
ruby: (?:the )?{ruby} licen[sc]e
openssl: (?:the )?{openssl} licen[sc]e
curl: (?:the )?{curl} licen[sc]e
postgresql: (?:the )?{postgresql} licen[sc]e
ncsa: university of {illinois}(?: ncsa)? open source licen[sc]e
ms-pl: {microsoft} public licen[sc]e
ms-rl: {microsoft} reciprocal licen[sc]e
ms-lpl: {microsoft} limited public licen[sc]e
ipl-1.0: {ibm} public licen[sc]e(?: (?:version )?1 0)?
apsl-2.0: {apple} public source licen[sc]e(?: (?:version )?2 0)?
npl-1.1: {netscape} public licen[sc]e(?: (?:version )?1 1)?
sspl-1.0: {server} side public licen[sc]e
busl-1.1: {business} source licen[sc]e(?: (?:version )?1 1)?
elastic-2.0: {elastic} licen[sc]e(?: (?:version )?2 0)?
commons-clause: {commons} clause
polyform: {polyform} (?:noncommercial|small business|shield|perimeter|strict) licen[sc]e
hippocratic: {hippocratic} licen[sc]e
ofl-1.1: {sil} open font licen[sc]e(?: (?:version )?1 1)?
ofl-1.1: {open} font licen[sc]e(?: (?:version )?1 1)?
odbl-1.0: {open} database licen[sc]e
odc-by-1.0: {open} data commons attribution licen[sc]e
pddl-1.0: {public} domain dedication and licen[sc]e
cdla-permissive: {community} data licen[sc]e agreement permissive
cdla-sharing: {community} data licen[sc]e agreement sharing
ogl-3.0: {open} government licen[sc]e (?:version |v)?3 0
ogl: {open} government licen[sc]e
openrail: {openrail}(?: m)?
llama: {llama} (?:2 |3 )?community licen[sc]e(?: agreement)?
cc0-1.0: {cc0} 1 0
cc0-1.0: (?:creative commons )?{cc0}(?: universal)?
cc0-1.0: creative {commons} zero
cc-pdm: {public} domain mark
public-domain: (?:in|into|to) the {public} domain
public-domain: {public} domain
cc: creative {commons} licen[sc]e
cc: creative {commons}
spdx: {spdx} license identifier
reserved: {all} rights (?:are )?reserved
reserved: {tous} droits réservés
reserved: {alle} rechte vorbehalten
reserved: {todos} los derechos reservados
some-reserved: {some} rights reserved
copyright: {copyright} (?:c )?(?:19|20)\d\d
copyright: {copyright} (?:by|holder|holders|owner|notice)
copyright: (?:protected|covered) by {copyright}
copyleft: {copyleft}
no-redistribution: no part of this \w+ may be {reproduced}
no-commercial: for {noncommercial} use only
no-commercial: for non {commercial} use only
permission: {reproduced} (?:with|by) (?:kind )?permission
permission: used (?:with|by) {permission}
no-warranty: without {warranty} of any kind
no-warranty: provided as is without any {warranty}
proprietary: {proprietary} and confidential
eula: end user {licen[sc]e} agreement
licence-file: see (?:the )?(?:file )?{licen[sc]e} (?:file|txt|md|for details)
notice: (?:this \w+ is )?{licensed} under
"""

#: Clauses of the Creative Commons licences: short form, long form.
CLAUSES = {
    "by": "attribution",
    "by sa": "attribution share ?alike",
    "by nc": "attribution non ?commercial",
    "by nd": "attribution no ?deriv(?:ative)?s?",
    "by nc sa": "attribution non ?commercial share ?alike",
    "by nc nd": "attribution non ?commercial no ?deriv(?:ative)?s?",
}
VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")


def _commons():
    """Creative Commons licences: every set of clauses in every version, then without one."""
    for short, long in reversed(CLAUSES.items()):
        name = "cc-" + short.replace(" ", "-")
        for v in (*VERSIONS, ""):
            label = name + ("-" + v.replace(" ", ".") if v else "")
            tail = r" (?:licen[sc]e )?(?:version |v)?(?:international )?" + v if v else ""
            yield label, f"{{cc}} {short}{tail}"
            yield label, f"creative {{commons}} {long}{tail}"


def rules() -> list[tuple[str, str, str, str]]:
    """(keyword, pattern before it, pattern after it, label), by priority; keywords with alternatives stand once for each."""
    out = []
    listed = [tuple(line.split(": ", 1)) for line in RULES.strip().splitlines()]
    for label, pattern in (*_commons(), *listed):
        before, rest = pattern.split("{", 1)
        key, after = rest.split("}", 1)
        keys = ("license", "licence") if "[sc]" in key else (key,)
        out += [(k, f"(?:^| )({UNDER}{before})$", f"^({after})(?: |$)", label) for k in keys]
    return out
