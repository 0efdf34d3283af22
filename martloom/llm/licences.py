"""Licence scans by sentence rules.

A text is brought to a form of lower-case words with marks: a full stop, semicolon,
colon, question or exclamation mark before a blank ends a sentence, and so does an
empty line; a single line break may end one or may wrap it. ``SENTENCES`` maps the
normalised sentences of licences to identifiers, ``RULES`` maps ordered sequences of
identifiers to licences. The identifiers of a text, in text order and without those in
``IGNORED``, are matched against the rules from left to right; at one place the longest
rule wins, then the earlier one.

All steps are SQL functions on one row: no shuffle, no Python, whole texts. Regular
expressions start at a mark, repeat within fixed bounds and use no look-around, so that
they take linear time and also run in other SQL engines (``sql``).

Outputs, which replace input columns of these names: ``sentences`` (identifiers,
repeats kept), ``licenses`` (SPDX-style names in text order, repeats kept) and
``n_other`` (licence phrases outside the known sentences: something to look at by
hand). A null or empty text has empty arrays and 0. Repeated rows repeat their result;
an empty table gives an empty one.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.frames import clear, unused

OUTPUTS = ("sentences", "licenses", "n_other")
_BLANK = r"\x20\x09-\x0D"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_SIGNS = "".join(chr(c) for c in range(1, 128) if not chr(c).isalnum() and chr(c) not in "|/")

# (pattern, replacement) in order; ``{1}`` stands for the first group. Between the two
# lists all other ASCII signs become blanks, which costs less than a pattern that has to
# replace the blank after each word.
ENDS = (
    (rf"[.;:!?][.;:!?\x22\x27)\]]*([{_BLANK}]|\z)", "|{1}"),  # of sentences
    (r"\r?\n|\r", "/"),
)
MARKS = (
    (r"[^\x01-\x7F]+", " "),
    (r"  +", " "),
    (r" ?/ ?/[ /]*", "|"),  # an empty line
    (r"[ /]*\|[ /|]*", " | | "),  # doubled, so that neighbours need not share a mark
    (r" ?/ ?", " / / "),
)


def _names() -> dict[str, str]:
    """Licence → pattern of its name in normalised words."""
    names = {
        "Apache-2.0": "apache(?: software)?(?: license)?(?: version)? v?2(?: 0)?",
        "MIT": "mit|mit license|mit x11 license|expat license",
        "ISC": "isc|isc license",
        "BSD-2-Clause": "bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd",
        "BSD-3-Clause": "bsd 3 clause|3 clause bsd|three clause bsd|(?:new|modified|revised) bsd",
        "MPL-2.0": "(?:mozilla public license|mpl)(?: version)? (?:v ; )?v?2 0",
        "Unlicense": "unlicense",
        "CC0-1.0": "(?:cc0|creative commons zero|cc zero)(?: v?1 0)?(?: universal)?",
    }
    families = {"GPL": ("", ("2", "3")), "LGPL": ("lesser ", ("2 1", "3")), "AGPL": ("affero ", ("3",))}
    for short, (word, versions) in families.items():
        for version in versions:
            low = short.lower()
            own = f"(?:(?:gnu )?{word}general public license(?: {low})?|(?:gnu )?{low})(?: version)? v?{version}(?: 0)?|{low}v?{version}"
            spdx = f"{short}-{version.replace(' ', '.') if ' ' in version else version + '.0'}"
            names[f"{spdx}-or-later"] = f"(?:{own}) (?:or|and) (?:at your option )?(?:any )?later(?: version)?"
            names[f"{spdx}-only"] = f"(?:{own})(?: only)?"
    words = {"by": "attribution", "nc": "non ?commercial", "nd": "no ?derivatives", "sa": "share ?alike"}
    for parts in (("by",), ("by", "sa"), ("by", "nc"), ("by", "nd"), ("by", "nc", "sa"), ("by", "nc", "nd")):
        for version in ("3 0", "4 0"):
            named = f"cc {' '.join(parts)}|creative commons {' '.join(words[p] for p in parts)}"
            names[f"CC-{'-'.join(parts).upper()}-{version.replace(' ', '.')}"] = f"(?:{named})(?: license)?(?: version)? v?{version}(?: international| unported)?"
    return names


NAMES = _names()
_THING = "(?:work|software|program|project|file|code|source code|document|documentation|text|library|package|content|material)"
_GRANT = (
    f"(?:(?:this|the|all) {_THING} (?:is|are) )?(?:also )?(?:dual )?(?:licensed|released|distributed|published|provided|available|made available)"
    " (?:to you )?under (?:the )?(?:terms of )?(?:the )?(?:conditions of the )?(?:{name})(?: license)?(?: the license)?"
)
_TITLE = "(?:the )?(?:{name})(?: license)?"
_BSD_END = "(?:the copyright holders? (?:and|or) contributors|the authors?(?: and contributors)?|the regents and contributors|\\*)"


def _gnu() -> dict[str, str]:
    """What follows ``_GNU`` in the headers: the family, then its version (or the version first)."""
    out, published = {}, "as published by the free software foundation"
    for key, family, version in (
        ("2", "", "2"), ("3", "", "3"), ("lesser-2.1", "lesser ", "2 1"), ("lesser-3", "lesser ", "3"), ("library-2", "(?:library|lesser) ", "2"),
        ("affero-3", "affero ", "3"),
    ):
        name, number = f"{family}general public license", f"version {version}(?: of the license)?"
        out[f"gnu-{key}-later"] = f"{name} {published} ; (?:either )?{number} or (?:at your option )?any later version"
        out[f"gnu-{key}"] = f"{name} (?:{published} ; (?:either )?{number}|version {version} (?:only )?{published})"
    return out


_GNU = "(?:this (?:program|library) is free software )?you can redistribute it and or modify it under the terms of the gnu "
_GNU_FORMS = _gnu()
_GNU_NAMES = {"2": "GPL-2.0", "3": "GPL-3.0", "lesser-2.1": "LGPL-2.1", "lesser-3": "LGPL-3.0", "library-2": "LGPL-2.0", "affero-3": "AGPL-3.0"}

# Sentences of public licence texts as they read once normalised; * is a
# run of up to 16 words, and at a semicolon between blanks the text may have an end of a
# sentence (``Foundation; either version 2``, ``v. 2.0``). Names and grants of every
# licence come from NAMES.
SENTENCES: dict[str, str] = {
    "copyright": "(?:portions )?copyright \\*",
    "rights": "all rights reserved",
    "spdx": "spdx license identifier",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation"
    " files the software to deal in the software without restriction including without limitation the rights to use copy modify merge"
    " publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so"
    " subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "as-is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of"
    " merchantability fitness for a particular purpose and noninfringement",
    "no-liability": "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action"
    " of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided"
    " that the above copyright notice and this permission notice appear in all copies",
    "isc-as-is": "the software is provided as is and the author disclaims all warranties with regard to this software including all implied"
    " warranties of merchantability and fitness",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following"
    " conditions are met",
    "bsd-source": "(?:1 )?redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "(?:2 )?redistributions in binary form must reproduce the above copyright notice this list of conditions and the following"
    " disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-names": "(?:3 )?neither the name of \\* nor the names of its contributors may be used to endorse or promote products derived from this"
    " software without specific prior written permission",
    "bsd-as-is": f"this software is provided by {_BSD_END} as is and any express or implied warranties including but not limited to the implied"
    " warranties of merchantability and fitness for a particular purpose are disclaimed",
    "apache-compliance": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at(?: \\*)?",
    "apache-as-is": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is"
    " basis without warranties or conditions of any kind either express or implied",
    "apache-limits": "see the license for the specific language governing permissions and limitations under the license",
    **{k: _GNU + v for k, v in _GNU_FORMS.items()},
    "gnu-free": "this (?:program|library) is free software",
    "gnu-hope": "this (?:program|library) is distributed in the hope that it will be useful but without any warranty",
    "mpl-grant": f"this source code form is subject to the terms of the {NAMES['MPL-2.0']}",
    "public-domain": "this is free and unencumbered software released into the public domain",
    **{f"grant:{k}": _GRANT.replace("{name}", v) for k, v in NAMES.items()},
    **{f"title:{k}": _TITLE.replace("{name}", v) for k, v in NAMES.items()},
}
IGNORED = frozenset({"copyright", "rights", "apache-copy", "gnu-free", "gnu-hope", "mit-notice", "bsd-as-is", "isc-as-is", "no-liability"})
RULES: list[tuple[tuple[str, ...], str]] = [
    (("bsd-grant", "bsd-source", "bsd-binary", "bsd-names"), "BSD-3-Clause"),
    (("bsd-grant", "bsd-source", "bsd-binary"), "BSD-2-Clause"),
    (("title:MIT", "mit-grant", "as-is"), "MIT"),
    (("mit-grant", "as-is"), "MIT"),
    (("mit-grant",), "MIT"),
    (("title:ISC", "isc-grant"), "ISC"),
    (("isc-grant",), "ISC"),
    (("grant:Apache-2.0", "apache-compliance", "apache-as-is", "apache-limits"), "Apache-2.0"),
    (("grant:Apache-2.0", "apache-compliance"), "Apache-2.0"),
    *(((f"gnu-{k}-later",), f"{v}-or-later") for k, v in _GNU_NAMES.items()),
    *(((f"gnu-{k}",), f"{v}-only") for k, v in _GNU_NAMES.items()),
    (("mpl-grant",), "MPL-2.0"),
    (("public-domain",), "Unlicense"),
    *((("spdx", f"title:{k}"), k) for k in NAMES),
    *(((f"grant:{k}",), k) for k in NAMES),
]
OTHER = "licen[sc]e[ds]? under|under the terms of|all rights reserved|licen[sc]e agreement|permission is (?:hereby )?granted"


def _pattern(words: str) -> str:
    """A sentence with a wrapped line allowed at each blank."""
    gap = "(?: / /)? "
    words = words.replace(" ; ", ";")
    words = re.sub(r" (\??)", lambda m: f"(?:{gap})?" if m[1] else gap, words)
    words = words.replace(";", r"(?: / /| \| \|)? ")
    return words.replace("\\*", f"[a-z0-9]+(?:{gap}[a-z0-9]+){{0,15}}?").replace("licens", "licen[sc]")


PATTERNS = {k: _pattern(v) for k, v in SENTENCES.items()}
# To find them, the licences share one grant and one title, and the GNU headers their start; else each mark would try every licence's own.
_ANY = "|".join(f"(?:{v})" for v in NAMES.values())
_FOUND = [v for k, v in PATTERNS.items() if ":" not in k and k not in _GNU_FORMS]
_FOUND += [_pattern(_GNU + "(?:" + "|".join(_GNU_FORMS.values()) + ")")]
_FOUND += [_pattern(_GRANT.replace("{name}", _ANY)), _pattern(_TITLE.replace("{name}", _ANY))]
KNOWN = "[|/] (?:" + "|".join(f"(?:{p})" for p in _FOUND) + ") [|/]"
WHOLE = {k: rf"\A[|/] (?:{p}) [|/]\z" for k, p in PATTERNS.items()}
SPELT = {"".join(f"<{k}>" for k in ids): name for ids, name in sorted(RULES, key=lambda r: -len(r[0]))}
SEQUENCE = "|".join(SPELT).replace(".", r"\.")


def _identified(sentence: Column) -> Column:
    name = F
    for key, pattern in WHOLE.items():
        name = name.when(sentence.rlike(pattern), F.lit(key))
    return name


def licensed(docs: DataFrame, text: str = "text", columns: list[str] | None = None) -> DataFrame:
    """``columns`` of the documents (all by default) with ``sentences``, ``licenses`` and ``n_other``."""
    form = F.translate(F.coalesce(F.col(f"`{text}`"), F.lit("")), _UPPER + "|/", _LOWER + "  ")
    form = F.concat(F.lit("|"), form, F.lit("|"))
    for pattern, into in ENDS:
        form = F.regexp_replace(form, pattern, into.replace("{1}", "$1"))
    form = F.translate(form, _SIGNS, " " * len(_SIGNS))
    for pattern, into in MARKS:
        form = F.regexp_replace(form, pattern, into)
    kept = docs if columns is None else docs.select(*(F.col(f"`{c}`") for c in columns))
    kept = [F.col(f"`{c}`") for c in clear(kept, *OUTPUTS).columns]
    every, part = F.lit(KNOWN), F.lit(0)
    spare = unused(docs, "_form")
    rows = docs.select(*kept, form.alias(spare))
    rows = rows.select(
        *kept,
        F.transform(F.regexp_extract_all(spare, every, part), _identified).alias("sentences"),
        F.size(F.regexp_extract_all(F.regexp_replace(spare, every, F.lit(" ")), F.lit(OTHER), part)).cast("long").alias("n_other"),
    )
    told = F.filter("sentences", lambda k: ~k.isin(*IGNORED))
    spelt = F.array_join(F.transform(told, lambda k: F.concat(F.lit("<"), k, F.lit(">"))), "")
    licence = F.create_map(*(F.lit(x) for pair in SPELT.items() for x in pair))
    found = F.transform(F.regexp_extract_all(spelt, F.lit(SEQUENCE), part), lambda s: licence[s])
    return rows.select(*kept, "sentences", found.alias("licenses"), "n_other")


def sql(source: str, key: str = "doc_id", text: str = "text") -> str:
    """The same result in DuckDB's SQL, as the body of a WITH clause that ends in ``scanned``."""
    form = f"'|' || translate(coalesce({text}, ''), '{_UPPER}|/', '{_LOWER}  ') || '|'"
    for pattern, into in ENDS:
        form = f"regexp_replace({form}, '{pattern}', '{into.replace('{1}', chr(92) + '1')}', 'g')"
    signs = _SIGNS.replace("'", "''")
    form = f"translate({form}, '{signs}', '{' ' * len(_SIGNS)}')"
    for pattern, into in MARKS:
        form = f"regexp_replace({form}, '{pattern}', '{into}', 'g')"
    cases = " ".join(f"WHEN regexp_matches(s, '{p}') THEN '{k}'" for k, p in WHOLE.items())
    names = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SPELT.items())
    ignored = ", ".join(f"'{k}'" for k in sorted(IGNORED))
    return f"""
    formed AS (SELECT {key}, {form} AS f FROM {source}),
    identified AS (SELECT {key}, list_transform(regexp_extract_all(f, '{KNOWN}'), lambda s: CASE {cases} END) AS sentences,
                          CAST(len(regexp_extract_all(regexp_replace(f, '{KNOWN}', ' ', 'g'), '{OTHER}')) AS BIGINT) AS n_other FROM formed),
    spelt AS (SELECT *, array_to_string(list_transform(list_filter(sentences, lambda k: k NOT IN ({ignored})),
                        lambda k: '<' || k || '>'), '') AS w FROM identified),
    scanned AS (SELECT {key}, sentences, list_transform(regexp_extract_all(w, '{SEQUENCE}'), lambda s: CASE s {names} END) AS licenses, n_other
                FROM spelt)"""
