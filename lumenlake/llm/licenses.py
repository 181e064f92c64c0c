"""License scans by sentence rules; DataFrame functions only.

A text is cut into sentences.  Each is normalised (A-Z lower-cased, all but
letters and digits to single spaces) and looked up among known license
sentences.  One that is not known as a whole is cut further, after each colon
and before the opening words of long known sentences (so joined lines, titles
and copyright lines part from the license), and its pieces are looked up; a
piece that is not known either is looked up line by line.
What is left is the sequence of identifiers in text order, with a bar for each
unknown stretch.  Ordered rules then claim runs of identifiers: a rule matches
its identifiers side by side, each claims what it matches, and later, less
specific rules see only the rest.

Names that a text may hold (holders in endorsement clauses) are replaced before
the cut.  BSD-2-Clause is reported only if no endorsement clause follows.

Documents without any word that all license sentences draw on cannot match
and are passed over before they are cut; that spares work, not documents.

Defined results: null, empty and unlicensed texts give no licenses; a license
that occurs twice is reported twice, in text order; identifiers no rule claims
are counted in ``n_unclaimed``; texts are read whole; repeated rows are alike.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from lumenlake.llm.common import lower_ascii, text_or_empty

# Licenses recognised by their SPDX line, besides those with an identifier of their own.
SPDX = {
    "Gpl2Only": "GPL-2.0-only", "Gpl2Later": "GPL-2.0-or-later", "Gpl3Later": "GPL-3.0-or-later",
    "Lgpl21Only": "LGPL-2.1-only", "Lgpl21Later": "LGPL-2.1-or-later", "Lgpl3Only": "LGPL-3.0-only",
    "Lgpl3Later": "LGPL-3.0-or-later", "Agpl3Only": "AGPL-3.0-only", "Agpl3Later": "AGPL-3.0-or-later",
    "Bsd2": "BSD-2-Clause", "Isc": "ISC", "Mpl2": "MPL-2.0",
}

# Wording of well-known license texts and notices, by identifier.
SENTENCES = {
    "ApacheRef": ["Licensed under the Apache License, Version 2.0"],
    "ApacheRefLicense": ['Licensed under the Apache License, Version 2.0 (the "License")'],
    "ApacheComply": ["you may not use this file except in compliance with the License"],
    "ApacheCopy": ["You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"],
    "ApacheCopyAt": ["You may obtain a copy of the License at"],
    "ApacheUrl": ["http://www.apache.org/licenses/LICENSE-2.0", "https://www.apache.org/licenses/LICENSE-2.0"],
    "ApacheAsIs": [
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied',
    ],
    "ApacheSee": ["See the License for the specific language governing permissions and limitations under the License"],
    "MitRef": ["Released under the MIT License", "Licensed under the MIT License", "This project is licensed under the MIT License"],
    "MitGrant": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    ],
    "MitNotice": [
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the Software",
    ],
    "MitAsIs": [
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED '
        "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    ],
    "MitLiability": [
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER "
        "IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE "
        "OR OTHER DEALINGS IN THE SOFTWARE",
    ],
    "BsdGrant": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
    ],
    "BsdSource": [
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer",
    ],
    "BsdBinary": [
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution",
    ],
    "BsdEndorse": [
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission",
    ],
    "BsdAdvert": [
        "All advertising materials mentioning features or use of this software must display the following acknowledgement",
    ],
    "BsdProduct": ["This product includes software developed by the copyright holder"],
    "IscGrant": [
        f"Permission to use, copy, modify, {also} distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies"
        for also in ("and/or", "and")
    ],
    "IscAsIs": [
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING '
        "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS",
        'THE SOFTWARE IS PROVIDED "AS IS" AND ISC DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING '
        "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS",
    ],
    "IscLiability": [
        f"IN NO EVENT SHALL {who} BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
        "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER "
        "TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE"
        for who in ("THE AUTHOR", "ISC")
    ],
    "IscRef": ["Released under the ISC License", "Licensed under the ISC License"],
    "Gpl2Ref": ["This work is licensed under the GNU General Public License, version 2"],
    "Gpl3Ref": [
        "This work is licensed under the GNU General Public License, version 3",
        "Licensed under the GNU General Public License, version 3",
    ],
    "GplMay": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
        "Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    ],
    "GplHope": [
        f"This {work} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY"
        for work in ("program", "library", "software")
    ],
    "GplImplied": ["without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE"],
    "GplSee": [f"See the GNU {kind}General Public License for more details" for kind in ("", "Lesser ", "Affero ")],
    "GplCopy": [
        f"You should have received a copy of the GNU {kind}General Public License along with this {work}"
        for kind in ("", "Lesser ", "Affero ") for work in ("program", "library", "software")
    ],
    **{
        f"{name}Terms": [
            f"you can redistribute it and/or modify it under the terms of the GNU {kind}General Public License as published "
            "by the Free Software Foundation",
        ]
        for name, kind in (("Gpl", ""), ("Lgpl", "Lesser "), ("Agpl", "Affero "))
    },
    **{
        f"Later{version.replace('.', '')}": [f"either version {version} of the License, or (at your option) any later version"]
        for version in ("2", "2.1", "3")
    },
    **{f"Only{version.replace('.', '')}": [f"version {version} of the License"] for version in ("2", "2.1", "3")},
    "CcByNcRef": ["Licensed under CC BY-NC 4.0", "This work is licensed under CC BY-NC 4.0"],
    "CcByRef": ["Licensed under CC BY 4.0", "This work is licensed under CC BY 4.0"],
    "CcBySaRef": ["Licensed under CC BY-SA 4.0", "This work is licensed under CC BY-SA 4.0"],
    "MplRef": ["This Source Code Form is subject to the terms of the Mozilla Public License, v"],
    "SpdxMit": ["SPDX-License-Identifier: MIT"],
    "SpdxApache": ["SPDX-License-Identifier: Apache-2.0"],
    "SpdxBsd3": ["SPDX-License-Identifier: BSD-3-Clause"],
    "SpdxGpl3": ["SPDX-License-Identifier: GPL-3.0-only"],
    **{f"Spdx{name}": [f"SPDX-License-Identifier: {license}"] for name, license in SPDX.items()},
}

_TAILS = [["GplHope", "GplImplied", "GplSee", "GplCopy"], ["GplHope", "GplImplied", "GplSee"], ["GplHope", "GplCopy"], []]
_HEADS = [("GPL-3.0-or-later", ["GplMay"])] + [
    (f"{family.upper()}-{version if '.' in version else version + '.0'}-{scope}", [f"{family}Terms", f"{part}{version.replace('.', '')}"])
    for family, versions in (("Gpl", "2 3"), ("Lgpl", "2.1 3"), ("Agpl", "3"))
    for version in versions.split()
    for scope, part in (("or-later", "Later"), ("only", "Only"))
]

# Rules in order, the longer first.
RULES = [
    ("Apache-2.0", ["ApacheRefLicense", "ApacheComply", "ApacheCopy", "ApacheAsIs", "ApacheSee"]),
    ("Apache-2.0", ["ApacheRefLicense", "ApacheComply", "ApacheCopyAt", "ApacheUrl", "ApacheAsIs", "ApacheSee"]),
    ("MIT", ["MitGrant", "MitNotice", "MitAsIs", "MitLiability"]),
    ("ISC", ["IscGrant", "IscAsIs", "IscLiability"]),
    ("BSD-4-Clause", ["BsdGrant", "BsdSource", "BsdBinary", "BsdAdvert", "BsdProduct", "BsdEndorse"]),
    ("BSD-3-Clause", ["BsdGrant", "BsdSource", "BsdBinary", "BsdEndorse"]),
    ("BSD-2-Clause", ["BsdGrant", "BsdSource", "BsdBinary"]),
    *((license, head + tail) for tail in _TAILS for license, head in _HEADS),
    ("Apache-2.0", ["ApacheRefLicense", "ApacheComply"]),
    ("Apache-2.0", ["ApacheRef"]),
    ("MIT", ["MitRef"]),
    ("GPL-2.0-only", ["Gpl2Ref"]),
    ("GPL-3.0-only", ["Gpl3Ref"]),
    ("CC-BY-NC-4.0", ["CcByNcRef"]),
    ("CC-BY-4.0", ["CcByRef"]),
    ("CC-BY-SA-4.0", ["CcBySaRef"]),
    ("MPL-2.0", ["MplRef"]),
    ("MIT", ["SpdxMit"]),
    ("Apache-2.0", ["SpdxApache"]),
    ("BSD-3-Clause", ["SpdxBsd3"]),
    ("GPL-3.0-only", ["SpdxGpl3"]),
    ("ISC", ["IscRef"]),
    *((license, [f"Spdx{name}"]) for name, license in SPDX.items()),
]

# A rule claims nothing if one of these follows, with nothing but unknown stretches between.
NOT_BEFORE = {"BSD-2-Clause": ["BsdEndorse", "BsdAdvert"]}


def _words(text: str) -> str:
    return text.replace(" ", "[^A-Za-z0-9]+")


# Names a license text may hold, with what stands around them; a name can hold a full stop.
NAMES = [
    (
        _words("neither the names? of ") + ".{1,200}?" + _words(" nor ") + ".{1,120}?" + _words(" may be used to endorse"),
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse",
    ),
    (
        _words("the names? of ") + ".{1,200}?" + _words(" may not be used to endorse"),
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse",
    ),
    (
        _words("following acknowledge?ments? this product includes software developed by ")
        + r".{1,300}?(?=[^A-Za-z0-9]*\b4[.)]\s|" + _words(" neither the names? ") + ")",
        "following acknowledgement:\nThis product includes software developed by the copyright holder.\n",
    ),
]

UNKNOWN = "|"
CUT = "\x01"
SENTENCE_END = r"([.!?;])[\x20\x09-\x0D]+|:[\x20\x09\x0D]*\n|\n[\x20\x09\x0D]*\n"
OPENING_WORDS, LEAST_WORDS = 6, 10  # of sentences under twice that, all words
MARKER = r"^[^A-Za-z0-9]*\(?[0-9a-z]{1,2}\)\s"  # of a list, (a) or 1)
ANCHORS = r"(?i)licen[sc]e|permi|redistribut|conditions|warrant|software"


def normal(sentence: str) -> str:
    return re.sub("[^a-z0-9]+", " ", sentence.lower()).strip()


def normalised(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(lower_ascii(sentence), "[^a-z0-9]+", " "))


def known_sentences() -> dict[str, str]:
    """Normalised sentence, as the scan cuts it, to identifier."""
    return {normal(text): name for name, texts in SENTENCES.items() for text in texts}


def opening(words: list[str]) -> list[str]:
    """The first words of a long known sentence: as many as do not also stand inside another, if that is possible."""
    least = OPENING_WORDS if len(words) >= 2 * OPENING_WORDS else len(words)
    inside = lambda n: any(f" {' '.join(words[:n])} " in f"{known} " for known in known_sentences())
    return words[: next((n for n in range(least, len(words) + 1) if not inside(n)), least)]


def inner_cuts() -> str:
    """Where a sentence that is not known is cut: after colons and before openings of long known sentences."""
    long = [words for words in (known.split() for known in known_sentences()) if len(words) >= LEAST_WORDS]
    openings = sorted({"[^A-Za-z0-9]+".join(opening(words)) for words in long})
    return rf"(?i)(?<!SPDX-License-Identifier):\s+|(?<![A-Za-z0-9])(?=(?:{'|'.join(openings)})(?![A-Za-z0-9]))"


def identifiers(text: Column) -> Column:
    """The sequence of identifiers and bars of a text."""
    known = F.create_map(*(F.lit(x) for pair in known_sentences().items() for x in pair))
    named = lambda s: F.try_element_at(known, normalised(s))
    for around, name in NAMES:
        text = F.regexp_replace(text, f"(?is){around}", name)
    sentences = F.split(F.regexp_replace(text, SENTENCE_END, f"$1{CUT}"), CUT)
    by_line = lambda s: F.transform(
        F.filter(F.split(s, "\n"), lambda line: F.length(normalised(line)) > 2),
        lambda line: F.coalesce(named(line), F.lit(UNKNOWN)),
    )
    whole_or = lambda other: lambda s: F.when(named(s).isNotNull(), F.array(named(s))).otherwise(other(s))
    pieces = lambda s: F.transform(F.split(s, inner_cuts()), lambda p: F.regexp_replace(p, MARKER, ""))
    endorses = lambda s: F.contains(normalised(s), F.lit(" endorse or promote products derived from "))
    by_name = lambda s: F.when(endorses(s), F.array(F.lit("BsdEndorse"))).otherwise(by_line(s))
    by_piece = lambda s: F.flatten(F.transform(pieces(s), whole_or(by_name)))
    return F.flatten(F.transform(sentences, whole_or(by_piece)))


def scan(docs: DataFrame) -> DataFrame:
    """(row, sentences, licenses, n_unclaimed): identifiers found and licenses recognised, both in text order."""
    none = F.array().cast("array<string>")
    text = text_or_empty()
    rows = docs.select(F.struct("*").alias("row"), F.when(text.rlike(ANCHORS), identifiers(text)).otherwise(none).alias("found"))
    # Each identifier stands between two spaces, so runs are matched whole.
    left = F.concat(F.lit(" "), F.array_join("found", "  "), F.lit(" "))
    for name, run in RULES:
        claimed = f" {'  '.join(run)} "
        if name in NOT_BEFORE and len(run) > 1:
            left = F.regexp_replace(left, rf"{claimed}(?!(?: \| )* (?:{'|'.join(NOT_BEFORE[name])}) )", f" ={name} ")
        else:
            left = F.replace(left, F.lit(claimed), F.lit(f" ={name} "))
    found = rows.select("row", F.filter("found", lambda x: x != UNKNOWN).alias("sentences"), left.alias("left"))
    return found.select(
        "row",
        "sentences",
        F.regexp_extract_all("left", F.lit(r"=(\S+)"), F.lit(1)).alias("licenses"),
        F.size(F.regexp_extract_all("left", F.lit(r"\s([A-Z]\w*)\s"), F.lit(1))).cast("long").alias("n_unclaimed"),
    )
