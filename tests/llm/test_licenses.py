import random
import re

import pytest

from tests.llm.helpers import prose
from tierline.llm import licenses
from tierline.llm.licenses import BASE, KINDS, Scanner, folded, rules, scanned

PLANTED = {
    "This work is licensed under the GNU General Public License, version 3.": {"gpl-3"},
    "Released under the MIT License.": {"mit"},
    "Licensed under the Apache License,\nVersion 2.0.": {"apache-2"},
    "Licensed under CC BY-NC 4.0.": {"cc-by-nc", "cc-by-nc-4.0"},
    "All rights reserved.": {"all-rights-reserved"},
    "SPDX-License-Identifier: LGPL-2.1-or-later": {"lgpl-2.1"},
    "See https://creativecommons.org/licenses/by-sa/3.0/ for terms": {"cc-by-sa-3.0"},
    "the BSD 3-Clause License": {"bsd-3-clause"},
    "It may be used under the terms of the Mozilla Public License v2.0": {"mpl-2"},
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files": {"mit"},
    "This is free and unencumbered software released into the public domain.": {"unlicense"},
    "GNU Lesser General Public License v2.1": {"lgpl-2.1"},
    "mit Lizenz, apache helicopter, the gnu grazes; mitlicense": set(),
}


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def base_places(text):
    words = words_of(text)
    found = []
    for phrase, label in BASE:
        wanted = phrase.split()
        found += [(k, label) for k in range(len(words)) if words[k : k + len(wanted)] == wanted]
    return sorted(found)


def scanned_by_hand(text):
    """Every rule on every text, suppression by comparing all pairs."""
    joined = " " + " ".join(words_of(text)) + " "
    found = []
    for k, rule in enumerate(rules()):
        for m in re.finditer(rf"(?<= )(?:{rule.pattern})(?= )", joined):
            found.append((joined[: m.start()].count(" ") - 1, joined[: m.end()].count(" "), k))
    kept = []
    rank = list(KINDS).index
    for a, b, k in found:
        own = rank(rules()[k].kind)
        inside = [
            (c, d, j) for c, d, j in found
            if not rules()[j].base and c <= a and b <= d and rank(rules()[j].kind) <= own and ((c, d) != (a, b) or j < k)
        ]
        kept.append(not inside)
    return sorted((a, b, k, keep) for (a, b, k), keep in zip(found, kept, strict=True))


def mixed_texts(count):
    rng = random.Random(4)
    lines = list(PLANTED)
    return ["\n".join(rng.choice([prose(rng.random(), 12), rng.choice(lines), "über MIT License"]) for _ in range(6)) for _ in range(count)]


def test_planted_licences_are_labelled():
    scanner = Scanner()
    for text, expected in PLANTED.items():
        words, _ = folded(f"Before it: {text} And after.")
        assert {scanner.rules[k].label for k, _, _, kept in scanner.scan(words) if kept or scanner.rules[k].base} == expected, text


def test_scan_is_that_of_all_rules_and_all_pairs(spark, documents):
    texts = [*mixed_texts(60), *PLANTED, " ".join(PLANTED) * 3]
    got = {r["doc_id"]: r for r in scanned(documents(texts)).collect()}
    for k, text in enumerate(texts):
        finds = got[k]["finds"]
        assert sorted((f["first_word"], f["end_word"], f["rule"], f["kept"]) for f in finds) == scanned_by_hand(text)
        assert got[k]["n_words"] == len(words_of(text))
        assert sorted((f["first_word"], f["license"]) for f in finds if f["base"]) == base_places(text)


def test_every_rule_has_a_keyword_in_whatever_it_finds():
    for rule in rules():
        assert rule.keywords and all(w == w.lower() and re.fullmatch(r"[a-z0-9 ]+", w) for w in rule.keywords), rule
    assert len(rules()) > 300 and [r.kind for r in rules()] == sorted((r.kind for r in rules()), key=list(KINDS).index)


def test_query_columns(spark, tmp_path):
    from tierline.llm.queries import op12_licenses

    texts = [*mixed_texts(25), None, "", "under the mit license " * 700, "ÉCC BY NC", "cc\x7fby\x00nc", *PLANTED]
    rows = [(k, t) for k, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for r in op12_licenses(spark, str(tmp_path)).collect():
        places = base_places(texts[r["doc_id"]])
        assert r["n_base"] == len(places) and r["n_words"] == len(words_of(texts[r["doc_id"]]))
        assert (r["first_word"], r["last_word"]) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert r["base_labels"] == ",".join(sorted({label for _, label in places}))
        own = {rules()[k].label for _, _, k, keep in scanned_by_hand(texts[r["doc_id"]]) if keep or rules()[k].base}
        assert r["labels"] == ",".join(sorted(own)) and 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(own)


def test_awkward_rows(spark, awkward, documents):
    found = scanned(awkward).collect()
    assert len(found) == awkward.count() and all(f["finds"] == [] and f["score"] == 0 for f in found)
    assert scanned(documents([])).collect() == []
    assert sorted(r["n_words"] for r in found)[:3] == [0, 0, 0]


@pytest.mark.parametrize("longer", [True, False])
def test_containment(longer):
    chosen = [licenses.Rule("whole", "name", "a b c", ("a",)), licenses.Rule("part", "name" if longer else "text", "b", ("b",))]
    finds = Scanner(chosen).scan(" a b c b ")
    # A part of the same kind goes, one of a higher kind stays; outside the longer find it stands anyway.
    assert finds == [(0, 0, 3, True), (1, 1, 2, not longer), (1, 3, 4, True)]
