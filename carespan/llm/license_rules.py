"""Operator 9: license notices by ordered signature rules.

A rule is a regex over the text's words (lower-cased, joined by one space), keywords of which one stands in
all that it matches, a label and a priority. Rules run only where a keyword of theirs occurs. Detections are
taken by priority, then length; one that lies inside a taken detection is suppressed. An identifier line may
name several licenses; what follows its first one is read on as an expression.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from dataclasses import dataclass

from pyspark.sql import DataFrame

from carespan.llm.common import map_texts, table

# Base phrases and labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

_LIC = "licen[cs]es?"
_V = "(?: version| v)?"

# Label -> (keyword, name pattern, name with its version or title). Written by hand, one line per license.
LICENSES = {
    "0bsd": ("bsd", f"(?:0bsd|zero clause bsd|bsd zero clause)(?: {_LIC})?"),
    "afl-3.0": ("academic free", f"academic free {_LIC}{_V} ?3(?: 0)?"),
    "agpl-3.0": ("affero", f"gnu affero general public {_LIC}{_V} ?3(?: 0)?"),
    "agpl": ("affero", f"(?:gnu )?affero general public {_LIC}"),
    "apache-1.1": ("apache", f"apache(?: software)? {_LIC}{_V} ?1(?: 1)"),
    "apache-2": ("apache", f"apache(?: software)? {_LIC}{_V} ?2(?: 0)?"),
    "artistic-2.0": ("artistic", f"artistic {_LIC}{_V} ?2(?: 0)?"),
    "blueoak-1.0.0": ("blue oak", f"blue oak model {_LIC}"),
    "bsd-2-clause": ("bsd", f"(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)(?: {_LIC})?"),
    "bsd-3-clause": ("bsd", f"(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)(?: {_LIC})?"),
    "bsd-4-clause": ("bsd", f"(?:bsd 4 clause|4 clause bsd|original bsd)(?: {_LIC})?"),
    "bsd": ("bsd", f"bsd(?: style)? {_LIC}"),
    "bsl-1.0": ("boost", f"boost software {_LIC}{_V}(?: ?1(?: 0)?)?"),
    "busl-1.1": ("business source", f"business source {_LIC}(?:{_V} ?1(?: 1)?)?"),
    "cc-by": ("attribution", f"creative commons attribution(?: [234] [05])?(?: international| unported)?(?: {_LIC})?"),
    "cc-by-sa": ("sharealike", "creative commons attribution sharealike(?: [234] [05])?(?: international| unported)?"),
    "cc-by-nc": ("noncommercial", "creative commons attribution noncommercial(?: [234] [05])?(?: international| unported)?"),
    "cc-by-nc-sa": ("noncommercial sharealike", "creative commons attribution noncommercial sharealike(?: [234] [05])?"),
    "cc-by-nc-nd": ("noncommercial noderiv", "creative commons attribution noncommercial noderiv(?:ative)?s?(?: [234] [05])?"),
    "cc-by-nd": ("noderiv", "creative commons attribution noderiv(?:ative)?s?(?: [234] [05])?"),
    "cc0": ("cc0", "cc0(?: 1 0)?(?: universal)?"),
    "cddl-1.0": ("common development and distribution", f"common development and distribution {_LIC}(?:{_V} ?1(?: [01])?)?"),
    "cecill": ("cecill", f"cecill(?: [abc])?(?: {_LIC})?(?: 2 [01])?"),
    "ecl-2.0": ("educational community", f"educational community {_LIC}(?:{_V} ?2(?: 0)?)?"),
    "elastic-2.0": ("elastic", f"elastic {_LIC}(?: 2 0)?"),
    "epl-1.0": ("eclipse public", f"eclipse public {_LIC}{_V} ?1(?: 0)?"),
    "epl-2.0": ("eclipse public", f"eclipse public {_LIC}{_V} ?2(?: 0)?"),
    "eupl": ("european union public", f"european union public {_LIC}(?:{_V} ?1(?: [12])?)?"),
    "gfdl": ("free documentation", f"gnu free documentation {_LIC}"),
    "gpl-2.0": ("general public", f"(?:gnu )?general public {_LIC}{_V} ?2(?: 0)?"),
    "gpl-3.0": ("general public", f"(?:gnu )?general public {_LIC}{_V} ?3(?: 0)?"),
    "gpl": ("general public", f"gnu general public {_LIC}"),
    "isc": ("isc", f"isc {_LIC}"),
    "lgpl-2.1": ("lesser general public", f"(?:gnu )?lesser general public {_LIC}{_V} ?2 1"),
    "lgpl-3.0": ("lesser general public", f"(?:gnu )?lesser general public {_LIC}{_V} ?3(?: 0)?"),
    "lgpl": ("general public", f"(?:gnu )?(?:lesser|library) general public {_LIC}"),
    "mit": ("mit|expat|x11", f"(?:mit|expat|x11|mit x11|x11 mit) {_LIC}"),
    "mpl-1.1": ("mozilla public", f"mozilla public {_LIC}{_V} ?1(?: 1)"),
    "mpl-2.0": ("mozilla public", f"mozilla public {_LIC}{_V} ?2(?: 0)?"),
    "ms-pl": ("microsoft public", f"microsoft public {_LIC}"),
    "ncsa": ("ncsa", f"(?:university of illinois )?ncsa(?: open source)? {_LIC}"),
    "odbl": ("open database|open data commons", f"open (?:data commons )?(?:open )?database {_LIC}"),
    "ofl-1.1": ("open font", f"(?:sil )?open font {_LIC}(?:{_V} ?1(?: 1)?)?"),
    "osl-3.0": ("open software", f"open software {_LIC}{_V} ?3(?: 0)?"),
    "php": ("php", f"php {_LIC}"),
    "postgresql": ("postgresql", f"postgresql {_LIC}"),
    "psf-2.0": ("python software|psf", f"(?:python software foundation|psf) {_LIC}"),
    "sspl-1.0": ("server side public", f"server side public {_LIC}"),
    "unlicense": ("unlicense", "unlicense"),
    "upl-1.0": ("universal permissive", f"universal permissive {_LIC}"),
    "w3c": ("w3c", f"w3c(?: software)?(?: notice and)? {_LIC}"),
    "wtfpl": ("what the fuck you want", f"do what the fuck you want to public {_LIC}"),
    "zlib": ("zlib", f"zlib(?: libpng)? {_LIC}"),
    "zpl-2.1": ("zope public", f"zope public {_LIC}(?:{_V} ?2(?: [01])?)?"),
}

_FAMILY = "(?: (?:only|or later))?"

# Short names as people write them, label -> (keywords, pattern). Names that are words of other kinds, too,
# count with a version or the word license only.
SHORT = {
    "agpl-3.0": ("agpl", f"agpl ?v?3(?: 0)?{_FAMILY}"),
    "agpl": ("agpl", "(?:gnu )?agpl"),
    "gpl-2.0": ("gpl", f"(?:gnu )?gpl ?v?2(?: 0)?{_FAMILY}"),
    "gpl-3.0": ("gpl", f"(?:gnu )?gpl ?v?3(?: 0)?{_FAMILY}"),
    "gpl": ("gpl", "(?:gnu )?gpl"),
    "lgpl-2.1": ("lgpl", f"(?:gnu )?lgpl ?v?2 1{_FAMILY}"),
    "lgpl-3.0": ("lgpl", f"(?:gnu )?lgpl ?v?3(?: 0)?{_FAMILY}"),
    "lgpl": ("lgpl", "(?:gnu )?lgpl"),
    "gfdl": ("gfdl", "(?:gnu )?gfdl"),
    "apache-1.1": ("apache", "apache v?1 1"),
    "apache-2": ("apache|asl", "(?:apache v?2(?: 0)?|asl ?v?2(?: 0)?|apache2)"),
    "mpl-1.1": ("mpl", "mpl ?v?1 1"),
    "mpl-2.0": ("mpl", "mpl ?v?2(?: 0)?"),
    "epl-1.0": ("epl", "epl ?v?1 0"),
    "epl-2.0": ("epl", "epl ?v?2 0"),
    "eupl": ("eupl", "eupl(?: ?v?1 [12])?"),
    "cddl-1.0": ("cddl", "cddl(?: ?v?1 [01])?"),
    "bsl-1.0": ("bsl|boost", "(?:bsl|boost) ?v?1 0"),
    "busl-1.1": ("busl|bsl", "(?:busl ?v?1 1|bsl 1 1)"),
    "osl-3.0": ("osl", "osl ?v?3 0"),
    "afl-3.0": ("afl", "afl ?v?3 0"),
    "ofl-1.1": ("ofl", "(?:sil )?ofl(?: ?v?1 1| license)"),
    "odbl": ("odbl", "odbl(?: ?v?1 0)?"),
    "sspl-1.0": ("sspl", "sspl(?: ?v?1(?: 0)?)?"),
    "wtfpl": ("wtfpl", "wtfpl"),
    "bsd-2-clause": ("bsd", "bsd ?2"),
    "bsd-3-clause": ("bsd", "bsd ?3"),
}

# Notices by the words of their texts, label -> (keywords, pattern).
NOTICES = [
    ("mit", "permission is hereby granted free of charge", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("bsl-1.0", "permission is hereby granted free of charge", "permission is hereby granted free of charge to any person or organization obtaining a copy"),
    ("bsd", "redistribution and use", "redistribution and use in source and binary forms with or without modification"),
    ("bsd-3-clause", "neither the name of", "neither the name of (?:[^ ]+ ){1,12}nor the names of its contributors may be used to endorse"),
    ("bsd-4-clause", "all advertising materials", "all advertising materials mentioning features or use of this software must display"),
    ("isc", "permission to use copy modify", "permission to use copy modify and or distribute this software for any purpose"),
    ("zlib", "any express or implied warranty", "provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("unlicense", "free and unencumbered", "this is free and unencumbered software released into the public domain"),
    ("apache-2", "except in compliance with the license", "you may not use this (?:file|work|software) except in compliance with the license"),
    ("apache-2", "www apache org licenses", "www apache org licenses license 2 0"),
    ("mpl-2.0", "source code form is subject", "this source code form is subject to the terms of the mozilla public license v ?2 0"),
    ("mpl-2.0", "mozilla org mpl", "mozilla org mpl 2 0"),
    ("epl-2.0", "www eclipse org legal epl", "www eclipse org legal epl (?:v20|2 0)"),
    ("epl-1.0", "www eclipse org legal epl", "www eclipse org legal epl v10"),
    ("gpl-3.0", "general public license as published", "gnu general public license as published by the free software foundation either version 3"),
    ("gpl-2.0", "general public license as published", "gnu general public license as published by the free software foundation either version 2"),
    ("lgpl-3.0", "lesser general public license as published", "gnu lesser general public license as published by the free software foundation either version 3"),
    ("lgpl-2.1", "lesser general public license as published", "gnu lesser general public license as published by the free software foundation either version 2 1"),
    ("agpl-3.0", "affero general public license as published", "gnu affero general public license as published by the free software foundation either version 3"),
    ("wtfpl", "permitted to copy and distribute verbatim", "everyone is permitted to copy and distribute verbatim or modified copies"),
    ("cc-by", "creativecommons org licenses by", "creativecommons org licenses by(?= [1-4] [05])"),
    ("cc-by-sa", "creativecommons org licenses by sa", "creativecommons org licenses by sa"),
    ("cc-by-nc", "creativecommons org licenses by nc", "creativecommons org licenses by nc(?= [1-4] [05])"),
    ("cc-by-nc-sa", "creativecommons org licenses by nc sa", "creativecommons org licenses by nc sa"),
    ("cc-by-nc-nd", "creativecommons org licenses by nc nd", "creativecommons org licenses by nc nd"),
    ("cc-by-nd", "creativecommons org licenses by nd", "creativecommons org licenses by nd"),
    ("cc0", "creativecommons org publicdomain zero", "creativecommons org publicdomain zero 1 0"),
    ("ofl-1.1", "scripts sil org ofl", "scripts sil org ofl"),
    ("unlicense", "unlicense org", "unlicense org"),
    ("public-domain", "public domain", "(?:in|into|to) the public domain"),
    ("all-rights-reserved", "all rights reserved", "all rights reserved"),
    ("proprietary", "proprietary", "proprietary and confidential"),
]


def identifier(label: str) -> str:
    """How a license is named in an identifier line or field: the words of its label, with a version.

    A label that others continue with a version of theirs takes none itself.
    """
    words = " ".join(re.findall(r"[a-z0-9]+", label))
    if label == "apache-2":
        return f"{words}(?: 0)?"
    versioned = any(re.match(rf"{label}-[0-9]", other) for other in LICENSES)
    return words + _FAMILY if versioned or label[-1].isdigit() else f"{words}(?: [0-9]+){{0,2}}{_FAMILY}"


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    score: float
    keywords: tuple
    pattern: str


# How a name may stand, in order of priority: (score, keyword before the name, pattern around it).
_FORMS = (
    (1.0, "spdx", "spdx {lic} identifier {id}"),
    (0.95, "", "(?:licensed|released|distributed|published|available|provided|offered|covered) under (?:the )?(?:terms (?:and conditions )?of )?(?:the )?{name}"),
    (0.9, "", "(?:subject to|see|terms of|conditions of|governed by|accordance with) (?:the )?(?:terms (?:and conditions )?of )?(?:the )?{name}"),
    (0.85, "", "under (?:the )?{name}"),
    (0.6, "", "{name}"),
)


_CREATIVE = ("cc-by-nc-nd", "cc-by-nc-sa", "cc-by-nc", "cc-by-nd", "cc-by-sa", "cc-by")


def rules() -> list[Rule]:
    """All rules: the names of the licenses in every form, short names, fields, notices."""
    made = []
    for priority, (score, word, form) in enumerate(_FORMS):
        for label, (keywords, name) in LICENSES.items():
            pattern = form.format(lic=_LIC, id=identifier(label), name=f"(?:{name})")
            made.append(Rule(label, priority, score, tuple((word or keywords).split("|")), pattern))
        if "{name}" in form:
            for label in _CREATIVE:
                name = label.replace("-", " ") + "(?: [1234] 0)?"
                made.append(Rule(label, priority, score, ("cc by",), form.format(lic=_LIC, id="", name=name)))
            for label, (keywords, name) in SHORT.items():
                made.append(Rule(label, priority, score, tuple(keywords.split("|")), form.format(lic=_LIC, id="", name=f"(?:{name})")))
    for label in (*LICENSES, *_CREATIVE):
        made.append(Rule(label, 2, 0.9, ("licen",), f"{_LIC} {identifier(label)}"))  # a field: license, then its identifier
    for label, keywords, pattern in NOTICES:
        made.append(Rule(label, 2, 0.9, tuple(keywords.split("|")), pattern))
    return made


# Bytes that stand in words; A-Z count as a-z.
_IN_WORD = bytes([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
_SPLIT = bytes(b if b in _IN_WORD else 0x20 for b in range(256))


def words_of(raw: bytes) -> list[bytes]:
    return raw.lower().translate(_SPLIT).split()  # bytes.lower touches A-Z only


def base_places(joined: str) -> list[tuple[int, str]]:
    """(character place, label) of every base phrase in words joined by one space, with one at each end."""
    found = []
    for phrase, label in BASE.items():
        at = joined.find(f" {phrase} ")
        while at >= 0:
            found.append((at, label))
            at = joined.find(f" {phrase} ", at + 1)
    return found


def compiled(made: list[Rule]) -> dict[tuple, list[tuple[re.Pattern, Rule]]]:
    """Rules by keywords. A keyword stands anywhere in the words, the pattern at whole words."""
    by: dict[tuple, list] = {}
    for rule in made:
        by.setdefault(rule.keywords, []).append((re.compile(f"(?<= )(?:{rule.pattern})(?= )"), rule))
    return by


_NEXT = {label: re.compile(f" (?:and|or) {identifier(label)}(?= )") for label in (*LICENSES, *_CREATIVE)}


def _expression(joined: str, end: int, rule: Rule) -> list[tuple[int, int, Rule]]:
    """The licenses that follow the first one of an identifier line, joined by and or or."""
    found = []
    while True:
        hits = [(m.end(), label) for label, pattern in _NEXT.items() if (m := pattern.match(joined, end))]
        if not hits:
            return found
        best = max(hits)
        found.append((end + 1, best[0], Rule(best[1], rule.priority, rule.score, rule.keywords, rule.pattern)))
        end = best[0]


def detections(joined: str, by_keyword: dict) -> list[tuple[int, int, Rule]]:
    """Detections that stay: by priority, then length, place and label; contained ones are suppressed."""
    found = []
    for keywords, group in by_keyword.items():
        if any(k in joined for k in keywords):
            for pattern, rule in group:
                hits = [(m.start(), m.end(), rule) for m in pattern.finditer(joined)]
                found += hits
                if rule.priority == 0:
                    for _, end, _ in hits:
                        found += _expression(joined, end, rule)
    found.sort(key=lambda d: (d[2].priority, d[0] - d[1], d[0], d[2].label))
    kept: list[tuple[int, int, Rule]] = []
    starts: list[int] = []  # of kept intervals that no other holds; with them, ends rise as well
    ends: list[int] = []
    for a, b, rule in found:
        at = bisect_right(starts, a)
        if at and ends[at - 1] >= b:
            continue
        kept.append((a, b, rule))
        low = bisect_left(starts, a)
        high = bisect_right(ends, b, low)
        starts[low:high], ends[low:high] = [a], [b]
    return kept


def _scan():
    by_keyword = compiled(rules())
    phrases = tuple(BASE)

    def one(raw: bytes):
        words = words_of(raw)
        joined = f" {b' '.join(words).decode()} "
        places = base_places(joined) if any(p in joined for p in phrases) else []
        ends = [f([at for at, _ in places]) for f in (min, max)] if places else []
        first, last = [joined.count(" ", 0, at) for at in ends] or (None, None)
        kept = detections(joined, by_keyword)
        base = sorted({label for _, label in places})
        labels = sorted({*base, *(rule.label for _, _, rule in kept)})
        score = max([rule.score for _, _, rule in kept] + [0.8] * bool(base), default=0.0)
        return (
            len(words), len(places), first, last,
            ",".join(base), ",".join(labels), score, len(kept),
        )

    return lambda texts: [one(t) for t in texts]


FOUND = (
    "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string,"
    " score double, n_detections bigint"
)


def license_scan(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Words, base places, labels and score (that of the best detection kept; 0 without) of every row.

    A null or empty text has no words, null places, empty labels and score 0. Repeated rows each get
    their row, an empty table gives none, other columns are ignored.
    """
    return map_texts(docs, _scan, FOUND, (id_column,), text)


def op9_license_scan(spark, sf_dir) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


QUERIES = {"op9_license_scan": op9_license_scan}
SQL: dict[str, str] = {}
