import re

import pytest

from tallymark.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TEXTS = [
    None, "", "nothing of the kind here", "Released under the MIT License.", "mit license MIT-License mit\nlicense", "MIT  éLicense", "apache license and General Public License, mit license",
    "x " * 20_000 + "Licensed under CC BY-NC 4.0.", "licensed under cc by 4.0", "cc by and nc 4 0", "GNU Lesser General Public License: licensed under the GNU lesser general public license",
    "Redistribution and use in source and binary forms, with or without modification, are permitted", "the of and to in is this software", "MITLICENSE", "4.0 0.4 by by by cc",
]


def base(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORD.findall(lowered)
    starts, labels = [], set()
    for phrase, label in licenses.BASE_PHRASES.items():
        parts = phrase.split()
        found = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
        starts += found
        labels |= {label} if found else set()
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


@pytest.fixture
def scanned(docs_of):
    docs = docs_of([*enumerate(TEXTS), (3, TEXTS[3])])
    rows = licenses.scan_documents(docs, licenses.fit(docs)).collect()
    assert len(rows) == len(TEXTS) + 1
    return rows


def test_base_places_against_brute_force(scanned):
    for r in scanned:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(TEXTS[r.doc_id]), TEXTS[r.doc_id]
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_templates_are_found_and_ordinary_words_are_not(scanned):
    labels = {r.doc_id: r.labels for r in scanned}
    assert labels[3] == "mit" and labels[7] == "cc-by-nc" and labels[8] == "cc-by" and labels[11] == "bsd"
    assert labels[10] == "gpl,lgpl" or labels[10] == "lgpl"
    assert [labels[i] for i in (0, 1, 2, 9, 12, 13, 14)] == [""] * 7


def test_every_template_finds_itself():
    index = licenses.Index.build(0, {})
    for label, notice, _ in licenses.TEMPLATES:
        found = index.places(licenses.words_of(f"Some file. {notice.title()}! End".encode()))
        assert (label, 2, 1.0) in found


def test_no_documents(docs_of):
    empty = docs_of([])
    assert licenses.scan_documents(empty, licenses.fit(empty)).count() == 0
