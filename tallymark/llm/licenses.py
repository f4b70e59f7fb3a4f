"""Licence scans by a positional index of rare template words.

The rarity of every template word is counted over all documents.  Each template is
known by its rarest words; the index lists, for a word, the templates and positions
where it stands.  A file's own rare words, rarest first, vote for (template, where it
would begin), and a place with votes of enough different words is accepted once the
template's key phrases stand where they must.  Fixed phrases give labels on their own.

Words are maximal runs of letters, digits and non-ASCII characters, with A-Z lowered.

Defined cases: a null text is empty and has no words; without documents the words are
ranked by name.  A phrase that occurs many times counts at each place.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import col, doc_bytes, slices, values

# Phrases that give a label wherever they stand.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Fixed values: (label, notice, key phrases that must stand at their place in it).
TEMPLATES = [
    ("mit", "released under the mit license", ["mit license"]),
    ("mit", "licensed under the mit license", ["mit license"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", ["hereby granted free of charge"]),
    ("apache", "licensed under the apache license version 2 0", ["apache license"]),
    ("apache", "you may not use this file except in compliance with the license", ["except in compliance with the license"]),
    ("gpl", "licensed under the gnu general public license version 3", ["general public license"]),
    ("gpl", "under the terms of the gnu general public license as published by the free software foundation", ["gnu general public license"]),
    ("lgpl", "licensed under the gnu lesser general public license", ["lesser general public license"]),
    ("agpl", "licensed under the gnu affero general public license", ["affero general public license"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ["source and binary forms"]),
    ("mpl", "subject to the terms of the mozilla public license", ["mozilla public license"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ["for any purpose with or without fee"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["unencumbered software"]),
    ("cc0", "released under cc0 1 0 universal", ["cc0 1 0"]),
    ("cc-by", "licensed under cc by 4 0", ["cc by 4 0"]),
    ("cc-by-sa", "licensed under cc by sa 4 0", ["cc by sa"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by-nd", "licensed under cc by nd 4 0", ["cc by nd"]),
    ("cc-by-nc-sa", "licensed under cc by nc sa 4 0", ["cc by nc sa"]),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", ["creative commons attribution"]),
]

#: A template is known by so many of its rarest words, of which so many must agree on its place.
RARE_WORDS, AGREEING = 4, 2
#: Share of a template's words that must stand at their place.
MATCHED = 0.7
#: Score of a document that has a base phrase and no accepted template.
PHRASE_SCORE = 0.5

_NOT_WORD = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.lower().translate(_NOT_WORD).split()


def _find(words: list[bytes], phrase: list[bytes], low: int = 0, high: int | None = None) -> list[int]:
    """Starts of a phrase between two places."""
    found, at, end = [], low, len(words) if high is None else high
    while True:
        try:
            at = words.index(phrase[0], at, end)
        except ValueError:
            return found
        if words[at : at + len(phrase)] == phrase:
            found.append(at)
        at += 1


@dataclass
class Index:
    """Postings of rare words, and the templates with the places of their key phrases."""

    postings: dict[bytes, list[tuple[int, int]]]
    order: dict[bytes, int]
    templates: list[tuple[str, list[bytes], list[tuple[int, list[bytes]]], int]]

    @staticmethod
    def build(documents: int, with_word: dict[str, int], templates=TEMPLATES) -> Index:
        rarity = lambda w: (-math.log((documents + 1) / (with_word.get(w, 0) + 1)), w)
        postings: dict[bytes, list[tuple[int, int]]] = {}
        known = []
        for number, (label, notice, keys) in enumerate(templates):
            words = notice.split()
            rare = sorted(set(words), key=rarity)[:RARE_WORDS]
            for at, word in enumerate(words):
                if word in rare:
                    postings.setdefault(word.encode(), []).append((number, at))
            as_bytes = [w.encode() for w in words]
            placed = [(_find(as_bytes, k.encode().split())[0], k.encode().split()) for k in keys]
            known.append((label, as_bytes, placed, min(AGREEING, len(rare))))
        order = {w.encode(): i for i, w in enumerate(sorted((x.decode() for x in postings), key=rarity))}
        return Index(postings, order, known)

    def places(self, words: list[bytes]) -> list[tuple[str, int, float]]:
        """(label, start, matched share) of every accepted template."""
        rare = sorted(set(self.postings).intersection(words), key=self.order.__getitem__)
        if len(rare) < AGREEING:
            return []
        votes: dict[tuple[int, int], int] = {}
        for word in rare:
            for at in _find(words, [word]):
                for number, where in self.postings[word]:
                    votes[number, at - where] = votes.get((number, at - where), 0) + 1
        found = []
        for (number, start), n in votes.items():
            label, template, keys, enough = self.templates[number]
            if n < enough or start < 0:
                continue
            if any(words[start + at : start + at + len(key)] != key for at, key in keys):
                continue
            share = sum(a == b for a, b in zip(template, words[start : start + len(template)], strict=False)) / len(template)
            if share >= MATCHED:
                found.append((label, start, share))
        return found


def scan(words: list[bytes], index: Index) -> tuple:
    """(n_words, n_base, first, last, base labels, all labels, score) of one text."""
    base, starts = set(), []
    for phrase, label in BASE_PHRASES.items():
        found = _find(words, phrase.encode().split())
        starts += found
        if found:
            base.add(label)
    places = index.places(words)
    labels = base | {label for label, _, _ in places}
    score = max([share for _, _, share in places] + [PHRASE_SCORE if base else 0.0])
    first, last = (min(starts), max(starts)) if starts else (None, None)
    return len(words), len(starts), first, last, ",".join(sorted(base)), ",".join(sorted(labels)), score


def fit(docs: DataFrame, text_col: str = "text", templates=TEMPLATES) -> Index:
    """Count in how many documents each template word occurs, and index the rarest."""
    wanted = {w.encode() for _, notice, _ in templates for w in notice.split()}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, int] = {}
        rows = 0
        for batch in slices(batches, 1000):
            rows += batch.num_rows
            for text in doc_bytes(batch, text_col):
                for w in wanted.intersection(words_of(text)):
                    seen[w] = seen.get(w, 0) + 1
        names = [None, *(w.decode() for w in seen)]
        yield pa.RecordBatch.from_pydict({"word": pa.array(names, pa.string()), "n": pa.array([rows, *seen.values()], pa.int64())})

    # One row per template word at most.
    sums = docs.select(col(text_col)).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    found = {r["word"]: r["n"] for r in sums}
    return Index.build(found.pop(None, 0), found, templates)


def scan_documents(docs: DataFrame, index: Index, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, places, labels and score of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1000):
            found = [scan(words_of(t), index) for t in doc_bytes(batch, text_col)]
            columns = [values(batch, id_col), *map(list, zip(*found, strict=True))]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    ddl = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    return docs.select(col(id_col).cast("long").alias(id_col), col(text_col)).mapInArrow(run, ddl)
