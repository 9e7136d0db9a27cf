"""License detection: ordered signature rules over normalised words.

A text becomes its words: ASCII letters lower-cased, everything ASCII that is neither letter nor digit taken for a space. Every
rule is a regular expression over these words with a few literal keywords; one automaton finds all keywords of a text,
and only rules with a keyword in the text are tried. Where finds overlap, one that lies inside another of the same
or higher priority is suppressed: the licence text wins over the notice in it, the notice over the name in it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import map_rows

#: Kinds of rules in falling priority, with the certainty of a find.
KINDS = {"text": 1.0, "tag": 0.95, "notice": 0.9, "link": 0.8, "name": 0.7, "reservation": 0.5}
_PRIORITY = {kind: k for k, kind in enumerate(KINDS)}


@dataclass(frozen=True)
class Rule:
    """A signature. ``label`` may quote groups of the pattern; ``base`` finds count even where others contain them."""

    label: str
    kind: str
    pattern: str
    keywords: tuple[str, ...]
    base: bool = False


# Phrases whose every place counts, with their labels.
BASE = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

#: What may stand before a version number, a blank included.
_V = r"(?: version| ver| v)? v?"

# Licences by name: label, pattern of the name in words, keywords of which one is in every find, identifier of tags.
_NAMED = (
    ("mit", r"mit(?: x11| expat)?", ("mit li",), "mit"),
    ("mit-0", r"mit no attribution", ("mit no attribution",), "mit 0"),
    ("x11", r"x11", ("x11 li",), "x11"),
    ("isc", r"isc", ("isc li",), "isc"),
    ("apache-1.1", rf"apache(?: software)?(?: license)?{_V}1 1", ("apache",), "apache 1 1"),
    ("apache-2", rf"apache(?: software)?(?: license)?{_V}2(?: 0)?", ("apache",), "apache 2 0"),
    ("apache", r"apache(?: software)?", ("apache li", "apache software li"), "apache"),
    ("bsd-2-clause", r"(?:bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd)", ("bsd",), "bsd 2 clause"),
    ("bsd-3-clause", r"(?:bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd|revised bsd)", ("bsd",), "bsd 3 clause"),
    ("bsd-4-clause", r"(?:bsd 4 clause|4 clause bsd|four clause bsd|original bsd)", ("bsd",), "bsd 4 clause"),
    ("0bsd", r"(?:zero clause bsd|bsd zero clause|0bsd)", ("bsd",), "0bsd"),
    ("bsd", r"bsd(?: style)?", ("bsd li", "bsd style li"), "bsd"),
    ("gpl-1", rf"(?:gnu )?(?:general public license|gpl)s?{_V}1(?: 0)?", ("general public", "gpl"), "gpl 1 0"),
    ("gpl-2", rf"(?:gnu )?(?:general public license|gpl)s?{_V}2(?: 0)?", ("general public", "gpl"), "gpl 2 0"),
    ("gpl-3", rf"(?:gnu )?(?:general public license|gpl)s?{_V}3(?: 0)?", ("general public", "gpl"), "gpl 3 0"),
    ("gpl", r"gnu (?:general public|gpl)", ("gnu g",), "gpl"),
    ("lgpl-2", rf"(?:gnu )?(?:(?:lesser|library) general public license|lgpl){_V}2(?: 0)?", ("general public", "lgpl"), "lgpl 2 0"),
    ("lgpl-2.1", rf"(?:gnu )?(?:(?:lesser|library) general public license|lgpl){_V}2 1", ("general public", "lgpl"), "lgpl 2 1"),
    ("lgpl-3", rf"(?:gnu )?(?:(?:lesser|library) general public license|lgpl){_V}3(?: 0)?", ("general public", "lgpl"), "lgpl 3 0"),
    ("lgpl", r"gnu (?:(?:lesser|library) general public|lgpl)", ("gnu l",), "lgpl"),
    ("agpl-3", rf"(?:gnu )?(?:affero general public license|agpl){_V}3(?: 0)?", ("affero", "agpl"), "agpl 3 0"),
    ("agpl", r"(?:gnu )?(?:affero general public|agpl)", ("affero", "agpl"), "agpl"),
    ("gfdl", r"(?:gnu free documentation|gfdl)", ("gnu free documentation", "gfdl"), "gfdl 1 3"),
    ("mpl-1.1", rf"(?:mozilla public license|mpl){_V}1 1", ("mozilla", "mpl"), "mpl 1 1"),
    ("mpl-2", rf"(?:mozilla public license|mpl){_V}2(?: 0)?", ("mozilla", "mpl"), "mpl 2 0"),
    ("mpl", r"mozilla public", ("mozilla",), "mpl"),
    ("epl-1", rf"(?:eclipse public license|epl){_V}1(?: 0)?", ("eclipse", "epl"), "epl 1 0"),
    ("epl-2", rf"(?:eclipse public license|epl){_V}2(?: 0)?", ("eclipse", "epl"), "epl 2 0"),
    ("cddl-1", rf"(?:common development and distribution license|cddl){_V}1(?: [01])?", ("common development", "cddl"), "cddl 1 0"),
    ("cpl-1", rf"common public license{_V}1(?: 0)?", ("common public",), "cpl 1 0"),
    ("eupl-1.2", rf"(?:european union public licen[cs]e|eupl){_V}1 2", ("european union", "eupl"), "eupl 1 2"),
    ("eupl", r"(?:european union public|eupl)", ("european union public", "eupl"), "eupl"),
    ("artistic-2", rf"artistic(?: license)?{_V}2(?: 0)?", ("artistic",), "artistic 2 0"),
    ("artistic", r"(?:perl )?artistic", ("artistic li",), "artistic 1 0"),
    ("bsl-1", rf"boost software license{_V}1(?: 0)?", ("boost",), "bsl 1 0"),
    ("busl-1.1", rf"(?:business source license|busl|bsl){_V}1 1", ("business source", "busl", "bsl"), "busl 1 1"),
    ("elastic-2", rf"elastic(?: license)?{_V}2(?: 0)?", ("elastic",), "elastic 2 0"),
    ("sspl-1", rf"(?:server side public license|sspl){_V}1(?: 0)?", ("server side public", "sspl"), "sspl 1 0"),
    ("unlicense", r"(?:the )?unlicense", ("unlicense",), "unlicense"),
    ("wtfpl", r"(?:do what the fuck you want to public|wtfpl)", ("what the fuck", "wtfpl"), "wtfpl"),
    ("zlib", r"zlib(?: libpng)?", ("zlib li", "zlib libpng"), "zlib"),
    ("libpng", r"libpng", ("libpng li",), "libpng 2 0"),
    ("openssl", r"openssl", ("openssl li",), "openssl"),
    ("postgresql", r"postgresql", ("postgresql li",), "postgresql"),
    ("python-2", rf"(?:python software foundation|psf)(?: license)?{_V}2(?: 0)?", ("python", "psf"), "python 2 0"),
    ("psf", r"(?:python software foundation|psf)", ("python software", "psf li"), "psf 2 0"),
    ("php-3", rf"php license{_V}3(?: 01?)?", ("php",), "php 3 01"),
    ("ruby", r"ruby", ("ruby li",), "ruby"),
    ("vim", r"vim", ("vim li",), "vim"),
    ("ofl-1.1", rf"(?:sil )?open font license{_V}1 [01]", ("open font",), "ofl 1 1"),
    ("ms-pl", r"microsoft public", ("microsoft public",), "ms pl"),
    ("ms-rl", r"microsoft reciprocal", ("microsoft reciprocal",), "ms rl"),
    ("osl-3", rf"(?:open software license|osl){_V}3(?: 0)?", ("open software", "osl"), "osl 3 0"),
    ("ecl-2", rf"educational community license{_V}2(?: 0)?", ("educational community",), "ecl 2 0"),
    ("upl-1", rf"universal permissive license{_V}1(?: 0)?", ("universal permissive",), "upl 1 0"),
    ("mulan-2", rf"mulan psl{_V}2", ("mulan",), "mulanpsl 2 0"),
    ("odbl", r"(?:open database|odbl)", ("open database", "odbl"), "odbl 1 0"),
    ("odc-by", r"open data commons attribution", ("open data commons",), "odc by 1 0"),
    ("pddl", r"(?:open data commons )?public domain dedication and", ("public domain dedication and",), "pddl 1 0"),
    ("openrail", r"(?:bigscience |creativeml )?open ?rail(?: m| s)?", ("open rail", "openrail"), "openrail"),
    ("llama", r"llama [234](?: \d)? community", ("llama",), "llama"),
)

# Creative Commons: conditions in their order, spelled and short.
_CONDITIONS = {
    "by": "attribution",
    "by-sa": "attribution share ?alike",
    "by-nd": "attribution no ?deriv(?:ative|ative work|ative)s?",
    "by-nc": "attribution non ?commercial",
    "by-nc-sa": "attribution non ?commercial share ?alike",
    "by-nc-nd": "attribution non ?commercial no ?deriv(?:ative|ative work|ative)s?",
}
_CC_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")

# Sentences of the licences' own texts, and other wordings that stand for one licence.
_TEXTS = (
    ("mit", "text", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ("permission is hereby granted free of charge",)),
    ("isc", "text", r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted", ("permission to use copy modify and",)),
    ("bsd", "text", r"redistribution and use in source and binary forms with or without modification are permitted", ("redistribution and use in source",)),
    ("bsd-3-clause", "text", r"neither the names? of (?:\S+ ){1,12}may be used to endorse or promote products derived from this software", ("neither the name",)),
    ("bsd-4-clause", "text", r"all advertising materials mentioning features or use of this software must display", ("all advertising materials mentioning",)),
    ("apache-2", "text", r"you may not use this (?:file|software|work) except in compliance with the license", ("except in compliance with the license",)),
    ("gpl", "text", r"you can redistribute it and or modify it under the terms of the gnu general public license", ("terms of the gnu general public",)),
    ("gpl-2", "text", r"terms of the gnu general public license as published by the free software foundation either version 2", ("terms of the gnu general public",)),
    ("gpl-3", "text", r"terms of the gnu general public license as published by the free software foundation either version 3", ("terms of the gnu general public",)),
    ("lgpl-2.1", "text", r"terms of the gnu lesser general public license as published by the free software foundation either version 2 1", ("terms of the gnu lesser",)),
    ("lgpl-3", "text", r"terms of the gnu lesser general public license as published by the free software foundation either version 3", ("terms of the gnu lesser",)),
    ("lgpl", "text", r"under the terms of the gnu (?:lesser|library) general public license", ("terms of the gnu l",)),
    ("agpl-3", "text", r"terms of the gnu affero general public license as published by the free software foundation either version 3", ("terms of the gnu affero",)),
    ("mpl-2", "text", r"this source code form is subject to the terms of the mozilla public license v 2 0", ("this source code form is subject",)),
    ("epl-2", "text", r"made available under the terms of the eclipse public license v?(?:ersion)? ?2 0", ("terms of the eclipse public",)),
    ("unlicense", "text", r"this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
    ("bsl-1", "text", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software", ("any person or organization obtaining",)),
    ("zlib", "text", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable", ("in no event will the authors be held liable",)),
    ("wtfpl", "text", r"you just do what the fuck you want to", ("you just do what the fuck",)),
    ("ofl-1.1", "text", r"this font software is licensed under the sil open font license", ("font software is licensed",)),
    ("cc0-1.0", "text", r"to the extent possible under law (?:\S+ ){1,20}waived all copyright and related", ("waived all copyright",)),
    ("artistic", "text", r"under the same terms as perl itself", ("same terms as perl",)),
    ("postgresql", "text", r"permission to use copy modify and distribute this software and its documentation for any purpose without fee", ("software and its documentation for any purpose",)),
    ("openssl", "text", r"this product includes software developed by the openssl project", ("developed by the openssl project",)),
    ("public-domain", "notice", r"(?:released|dedicated|placed|donated) (?:in|in ?to|to) the public domain", ("public domain",)),
    ("public-domain", "notice", r"(?:this work|this file|this software|it) is in the public domain", ("public domain",)),
    ("proprietary", "notice", r"(?:proprietary and confidential|confidential and proprietary)", ("proprietary",)),
    ("proprietary", "notice", r"may not be (?:copied|reproduced|distributed|redistributed)(?: (?:or|and) \S+){0,3} without (?:the )?(?:prior |express |written )+(?:permission|consent)", ("may not be",)),
    ("proprietary", "notice", r"unauthorized (?:copying|reproduction|distribution)(?: (?:or|and) \S+)? of this (?:file|work|software|document)", ("unauthorized",)),
    ("all-rights-reserved", "reservation", r"all rights reserved", ("all rights reserved",)),
    ("all-rights-reserved", "reservation", r"alle rechte vorbehalten", ("alle rechte vorbehalten",)),
    ("all-rights-reserved", "reservation", r"tous droits r\S+serv\S+s", ("tous droits r",)),
    ("all-rights-reserved", "reservation", r"todos los derechos reservados", ("todos los derechos reservados",)),
)

# Addresses, as their words.
_LINKS = (
    ("mit", "opensource org licenses? mit"), ("isc", "opensource org licenses? isc"),
    ("apache-2", "apache org licenses? license 2 0"), ("apache-2", "opensource org licenses? apache 2 0"),
    ("bsd-2-clause", "opensource org licenses? bsd 2 clause"), ("bsd-3-clause", "opensource org licenses? bsd 3 clause"),
    ("gpl-2", "gnu org licenses? (?:old licenses )?gpl 2 0"), ("gpl-3", "gnu org licenses? gpl 3 0"),
    ("gpl", "gnu org licenses? gpl"), ("lgpl-2.1", "gnu org licenses? (?:old licenses )?lgpl 2 1"),
    ("lgpl-3", "gnu org licenses? lgpl 3 0"), ("lgpl", "gnu org licenses? lgpl"), ("agpl-3", "gnu org licenses? agpl 3 0"),
    ("agpl", "gnu org licenses? agpl"), ("gfdl", "gnu org licenses? fdl"), ("mpl-2", "mozilla org (?:en us )?mpl 2 0"),
    ("epl-2", "eclipse org legal epl 2 0"), ("epl-1", "eclipse org legal epl v10"), ("bsl-1", "boost org license 1 0"),
    ("unlicense", "unlicense org"), ("wtfpl", "wtfpl net"), ("ofl-1.1", "scripts sil org ofl"),
    ("cc0-1.0", "creativecommons org publicdomain zero 1 0"), ("public-domain", "creativecommons org publicdomain mark 1 0"),
)

_UNDER = r"(?:licensed|released|distributed|published|available|provided|covered|redistribute\S*|use\S*|offered|shared|governed)(?: \S+){0,3}? (?:under|by)(?: the)?(?: terms(?: and conditions)? of)?(?: the)?(?: an?)?"


def _named_rules() -> list[Rule]:
    """From each named licence: its identifier tag, a notice that grants it, and its name with the word licence."""
    rules = []
    for label, name, keywords, tag in _NAMED:
        licence = r"(?: public)?(?: licen[cs]es?)?"
        rules += [
            Rule(label, "tag", rf"spdx license identifier {tag}(?: only| or later)?", ("spdx license identifier",)),
            Rule(label, "tag", rf"licen[cs]e (?:type |name |id )?{tag}(?= )(?! licen)", (f"license {tag}", f"licence {tag}")),
            Rule(label, "notice", rf"{_UNDER} {name}{licence}", keywords),
            Rule(label, "name", rf"{name} licen[cs]es?" if "license" not in name else name, keywords),
        ]
    return rules


def _creative_commons_rules() -> list[Rule]:
    """Each set of conditions by short name, spelled name and address, with and without version."""
    rules = []
    for short, spelled in _CONDITIONS.items():
        words = short.replace("-", " ")
        ends = "" if short.endswith("nd") or short.endswith("sa") else "(?! nc)(?! nd)(?! sa)"
        for version in _CC_VERSIONS:
            label = f"cc-{short}-{version.replace(' ', '.')}"
            rules += [
                Rule(label, "notice", rf"(?:cc|creative commons) {words} {version}", ("cc by", "creative commons by")),
                Rule(label, "notice", rf"creative commons {spelled}(?: \d+)?(?: (?:international|unported|generic|public|license|licence|v|version)){{0,4}} {version}", ("creative commons attribution",)),
                Rule(label, "link", rf"creativecommons org licenses {words} {version}", ("creativecommons org",)),
            ]
        label = f"cc-{short}"
        rules += [
            Rule(label, "name", rf"cc {words}{ends}", ("cc by",)),
            Rule(label, "name", rf"creative commons {spelled}", ("creative commons attribution",)),
        ]
    return [
        *rules,
        Rule("cc0-1.0", "notice", r"cc0(?: 1 0)?(?: universal)?", ("cc0",)),
        Rule("cc0-1.0", "notice", r"creative commons zero(?: v?1 0)?", ("creative commons zero",)),
        Rule("cc0-1.0", "tag", r"spdx license identifier cc0 1 0", ("spdx license identifier",)),
        Rule("cc", "name", r"creative commons licen[cs]e", ("creative commons li",)),
    ]


@cache
def rules() -> tuple[Rule, ...]:
    """All rules in falling priority; of one priority in the order they are written."""
    found = [Rule(label, "notice", phrase, (phrase,), base=True) for phrase, label in BASE]
    found += [Rule(label, kind, pattern, keywords) for label, kind, pattern, keywords in _TEXTS]
    found += [Rule(label, "link", address, (address.split(" licenses?")[0].split(" (?:")[0],)) for label, address in _LINKS]
    found += _named_rules() + _creative_commons_rules()
    return tuple(sorted(found, key=lambda r: _PRIORITY[r.kind]))


#: ASCII but letters and digits to spaces, capitals to small letters; bytes of other characters stay.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def folded(text: str | None) -> tuple[str, int]:
    """The words of a text with one space before, between and after them, and their number. One character for each byte."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()
    return f" {b' '.join(words).decode('latin-1')} ", len(words)


class Scanner:
    """Compiled rules with their keyword automaton; one for each worker task."""

    def __init__(self, chosen: Iterable[Rule] | None = None):
        self.rules = tuple(rules() if chosen is None else chosen)
        # Rules stand between word boundaries: the space before is looked at, the one after too.
        self.patterns = [re.compile(rf"(?<= )(?:{r.pattern})(?= )") for r in self.rules]
        self.automaton = ahocorasick.Automaton()
        by_word: dict[str, list[int]] = {}
        for k, rule in enumerate(self.rules):
            for word in rule.keywords:
                by_word.setdefault(f" {word}", []).append(k)
        for word, ids in by_word.items():
            self.automaton.add_word(word, ids)
        self.automaton.make_automaton()

    def candidates(self, words: str) -> list[int]:
        """Rules of which a keyword is in the text, in order of priority."""
        hits = {id(ids): ids for _, ids in self.automaton.iter(words)}
        return sorted({k for ids in hits.values() for k in ids})

    def scan(self, words: str) -> list[tuple[int, int, int, bool]]:
        """(rule, first word, word after the last, kept) of every find, by place; not kept are suppressed ones."""
        found = [
            (m.start(), m.end(), k) for k in self.candidates(words) for m in self.patterns[k].finditer(words)
        ]
        found.sort(key=lambda f: (f[0], -f[1], f[2]))
        kept = self._unsuppressed(found)
        out, at, seen = [], 0, 0
        for (start, end, k), keep in zip(found, kept, strict=True):
            seen += words.count(" ", at, start)
            at = start
            out.append((k, seen - 1, seen + words.count(" ", start, end), keep))
        return out

    def _unsuppressed(self, found: list[tuple[int, int, int]]) -> list[bool]:
        """A find inside another one of the same or a higher priority goes; of equal stretches the first rule stays.

        Finds come by start, the longer first, so what contains a find is before it. Of each priority only the
        reach so far matters: whatever reaches to a find's end began no later.
        """
        reach = [-1] * len(KINDS)
        # A shorter find of a higher priority never contains a longer one, so one pass by place is enough.
        kept = []
        for _, end, k in found:
            priority = _PRIORITY[self.rules[k].kind]
            kept.append(all(reach[p] < end for p in range(priority + 1)))
            if not self.rules[k].base:
                reach[priority] = max(reach[priority], end)
        return kept


FOUND = "rule int, license string, kind string, base boolean, first_word long, end_word long, kept boolean"


def scanned(df: DataFrame, text: str = "text", key: str = "doc_id", chosen: Iterable[Rule] | None = None) -> DataFrame:
    """Every row as (key, n_words, finds, score): one row per row, whatever the text.

    ``finds`` lists all finds by place with the rule's number, licence, kind, words covered, and whether it stands or lies in
    another find. ``score`` is the certainty of the surest find that stands, 0 without one. NULL and empty texts have no
    words and no finds; whole texts are scanned, however long; repeated rows and keys stay rows of their own. Equal
    stretches fall to the rule of higher priority, then the earlier rule. Other columns are not carried along.
    """
    chosen = None if chosen is None else tuple(chosen)
    kind = df.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, n_words long, finds array<struct<{FOUND.replace(' ', ':').replace(',:', ',')}>>, score double"

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        scanner = Scanner(chosen)
        finds_type = pa.list_(
            pa.struct(
                [("rule", pa.int32()), ("license", pa.string()), ("kind", pa.string()), ("base", pa.bool_()),
                 ("first_word", pa.int64()), ("end_word", pa.int64()), ("kept", pa.bool_())]
            )
        )

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts, finds, scores = [], [], []
            for value in batch.column(1):
                words, n = folded(value.as_py())
                found = scanner.scan(words)
                own = [scanner.rules[f[0]] for f in found]
                counts.append(n)
                finds.append(
                    [
                        {"rule": k, "license": r.label, "kind": r.kind, "base": r.base, "first_word": a, "end_word": b, "kept": kept}
                        for (k, a, b, kept), r in zip(found, own, strict=True)
                    ]
                )
                scores.append(max((KINDS[r.kind] for r, f in zip(own, found, strict=True) if f[3] or r.base), default=0.0))
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(finds, finds_type), pa.array(scores, pa.float64())]
            return pa.RecordBatch.from_arrays(columns, names=[key, "n_words", "finds", "score"])

        return work

    return map_rows(df.select(key, text), make, schema)


def labels_of(finds: str, condition: Callable[[Column], Column]) -> Column:
    """Distinct licences of the finds that meet the condition, sorted, joined by commas; empty for none."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(F.filter(finds, condition), lambda f: f["license"]))), ",")
