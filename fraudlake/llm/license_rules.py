"""The ordered signature rules of the license scan.

Rules match on a text's words, lower-cased and with one space between them, so that "GPL-2.0" reads
"gpl 2 0". Versioned families give four kinds of rules, by how much they say; single licenses and
notices are written out. A smaller priority wins.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

# Label, name as a pattern, keyword of the name, short form, keyword of it, versions.
FAMILIES = """
gpl       | (?:gnu )?general public licen[sc]e | general public licen | gpl | gpl | 1.0 2.0 3.0
lgpl      | (?:gnu )?(?:lesser|library) general public licen[sc]e | general public licen | lgpl | lgpl | 2.0 2.1 3.0
agpl      | (?:gnu )?affero general public licen[sc]e | affero | agpl | agpl | 1.0 3.0
gfdl      | (?:gnu )?free documentation licen[sc]e | free documentation | gfdl | gfdl | 1.1 1.2 1.3
apache    | apache(?: software)? licen[sc]e | apache | apache | apache | 1.0 1.1 2.0
mpl       | mozilla public licen[sc]e | mozilla public | mpl | mpl | 1.0 1.1 2.0
npl       | netscape public licen[sc]e | netscape public | npl | npl | 1.0 1.1
epl       | eclipse public licen[sc]e | eclipse public | epl | epl | 1.0 2.0
cpl       | common public licen[sc]e | common public | cpl | cpl | 1.0
ipl       | ibm public licen[sc]e | ibm public | ipl | ipl | 1.0
spl       | sun public licen[sc]e | sun public | sun spl | sun spl | 1.0
cddl      | common development and distribution licen[sc]e | common development | cddl | cddl | 1.0 1.1
eupl      | european union public licen[sc]e | european union public | eupl | eupl | 1.0 1.1 1.2
afl       | academic free licen[sc]e | academic free | afl | afl | 1.1 1.2 2.0 2.1 3.0
osl       | open software licen[sc]e | open software | osl | osl | 1.0 1.1 2.0 2.1 3.0
artistic  | artistic licen[sc]e | artistic | artistic | artistic | 1.0 2.0
bsl       | boost software licen[sc]e | boost software | bsl | bsl | 1.0
ofl       | (?:sil )?open font licen[sc]e | open font | ofl | ofl | 1.0 1.1
zpl       | zope public licen[sc]e | zope public | zpl | zpl | 1.1 2.0 2.1
lppl      | latex project public licen[sc]e | latex project | lppl | lppl | 1.0 1.1 1.2 1.3
php       | php licen[sc]e | php licen | php | php | 3.0 3.01
python    | python(?: software foundation)? licen[sc]e | python | psf | psf | 2.0
cecill    | cecill(?: free software)? licen[sc]e | cecill | cecill | cecill | 1.0 1.1 2.0 2.1
ecl       | educational community licen[sc]e | educational community | ecl | ecl | 1.0 2.0
apsl      | apple public source licen[sc]e | apple public | apsl | apsl | 1.0 1.1 1.2 2.0
odbl      | open database licen[sc]e | open database | odbl | odbl | 1.0
upl       | universal permissive licen[sc]e | universal permissive | upl | upl | 1.0
sspl      | server side public licen[sc]e | server side public | sspl | sspl | 1.0
busl      | business source licen[sc]e | business source | busl | busl | 1.1
cc-by     | creative commons attribution | creative commons | cc by | cc by | 1.0 2.0 2.5 3.0 4.0
cc-by-sa  | creative commons attribution share ?alike | creative commons | cc by sa | cc by | 1.0 2.0 2.5 3.0 4.0
cc-by-nd  | creative commons attribution no ?deriv(?:ative)?s | creative commons | cc by nd | cc by | 1.0 2.0 2.5 3.0 4.0
cc-by-nc  | creative commons attribution non ?commercial | creative commons | cc by nc | cc by | 1.0 2.0 2.5 3.0 4.0
cc-by-nc-sa | creative commons attribution non ?commercial share ?alike | creative commons | cc by nc sa | cc by | 1.0 2.0 2.5 3.0 4.0
cc-by-nc-nd | creative commons attribution non ?commercial no ?deriv(?:ative)?s | creative commons | cc by nc nd | cc by | 1.0 2.0 2.5 3.0 4.0
cc0       | creative commons zero | creative commons | cc0 | cc0 | 1.0
"""

# Label, confidence, keyword, pattern.
SINGLES = """
mit       | 1.0 | mit licen | (?:licensed|released|distributed|available) under (?:the )?mit licen[sc]e
mit       | 0.8 | mit licen | (?:the )?mit licen[sc]e
mit       | 1.0 | identifier | spdx license identifier mit
mit       | 0.9 | hereby granted | permission is hereby granted free of charge to any person obtaining a copy
bsd       | 0.9 | redistribution | redistribution and use in source and binary forms with or without modification are permitted
bsd       | 0.8 | bsd licen | (?:the )?(?:new |modified |simplified |revised )?bsd licen[sc]e
bsd-0     | 1.0 | clause bsd | (?:0|zero) clause bsd(?: licen[sc]e)?
bsd-2     | 1.0 | bsd 2 | bsd 2 clause(?: licen[sc]e)?
bsd-2     | 1.0 | clause bsd | (?:2|two) clause bsd(?: licen[sc]e)?
bsd-3     | 1.0 | bsd 3 | bsd 3 clause(?: licen[sc]e)?
bsd-3     | 1.0 | clause bsd | (?:3|three) clause bsd(?: licen[sc]e)?
bsd-4     | 1.0 | bsd 4 | bsd 4 clause(?: licen[sc]e)?
bsd-4     | 1.0 | clause bsd | (?:4|four) clause bsd(?: licen[sc]e)?
isc       | 0.9 | isc licen | (?:the )?isc licen[sc]e
isc       | 0.9 | permission to use | permission to use copy modify and or distribute this software
zlib      | 0.9 | zlib | (?:the )?zlib(?: libpng)? licen[sc]e
unlicense | 0.9 | unlicense | (?:the )?unlicense
wtfpl     | 0.9 | wtfpl | wtfpl
wtfpl     | 0.9 | do what the | do what the fuck you want to public licen[sc]e
public-domain | 0.7 | public domain | (?:released|placed|dedicated) (?:in|into|to) the public domain
public-domain | 0.6 | public domain | public domain
openssl   | 0.8 | openssl | openssl licen[sc]e
ncsa      | 0.8 | ncsa | (?:university of illinois )?ncsa(?: open source)? licen[sc]e
vim       | 0.8 | vim licen | vim licen[sc]e
ruby      | 0.8 | ruby licen | ruby licen[sc]e
ms-pl     | 0.9 | microsoft public | microsoft public licen[sc]e
ms-rl     | 0.9 | microsoft reciprocal | microsoft reciprocal licen[sc]e
proprietary | 0.7 | proprietary | proprietary and confidential
proprietary | 0.7 | reproduc | may not be reproduced without (?:prior )?(?:written )?permission
reserved  | 0.6 | all rights reserved | all rights reserved
copyright | 0.5 | copyright | copyright (?:c )?(?:19|20)[0-9]{2}(?: (?:19|20)[0-9]{2})?
"""

UNDER = "(?:licensed|released|distributed|available) under (?:the )?(?:terms of (?:the )?)?"
LATER = "(?: only| or (?:any )?later(?: version)?)?"


@dataclass(frozen=True)
class Rule:
    keyword: str
    label: str
    priority: int
    confidence: float
    pattern: str


def _split(line: str, n: int) -> list[str]:
    """n fields; fields stand apart by ' | ', patterns have no spaces around their bars."""
    fields = [f.strip() for f in line.split(" | ")]
    if len(fields) != n:
        raise ValueError(f"{n} fields wanted: {line}")
    return fields


def _version(version: str) -> str:
    major, minor = version.split(".")
    return f"{major}(?: 0)?" if minor == "0" else f"{major} {minor}"


def rules() -> list[Rule]:
    """All rules, the more telling kinds first."""
    out = []
    for line in FAMILIES.strip().splitlines():
        label, name, word, short, short_word, versions = _split(line, 6)
        for version in versions.split():
            number = f"(?:v ?|version )?{_version(version)}"
            tail = "(?: international| unported| generic)?(?: licen[sc]e)?" if label.startswith("cc") else LATER
            out.append(Rule(word, f"{label}-{version}", 1, 1.0, f"(?:{UNDER})?(?:the )?{name} {number}{tail}"))
            out.append(Rule(short_word, f"{label}-{version}", 2, 0.95, f"(?:{UNDER})?(?:the )?{short} ?{number}{tail}"))
        out.append(Rule(word, label, 3, 0.9, f"{UNDER}(?:the )?{name}"))
        out.append(Rule(word, label, 4, 0.8, name))
    for line in SINGLES.strip().splitlines():
        label, confidence, word, pattern = _split(line, 4)
        out.append(Rule(word, label, 2 if float(confidence) >= 0.9 else 4, float(confidence), pattern))
    return out


def grouped_json(all_rules: list[Rule]) -> str:
    """Rules by keyword, for from_json; each pattern stands between two spaces."""
    groups: dict[str, list[dict]] = {}
    for rule in all_rules:
        fields = asdict(rule) | {"pattern": f"(?<= )(?:{rule.pattern})(?= )"}
        groups.setdefault(fields.pop("keyword"), []).append(fields)
    return json.dumps([{"keyword": k, "rules": v} for k, v in groups.items()])
