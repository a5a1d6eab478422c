"""Licence scans by a positional index of rare template words.

The corpus gives each licence word its document frequency. The index holds the positions, in
every template, of the template's words of highest IDF. A file looks up its words of highest
IDF, which are those that the index holds: however many templates a file quotes, none of its
rare words is passed over. Each place of such a word and each posting of it give a place where
the template would begin. Where enough different words agree on that place, up to a small
shift for words put in between, the template is a candidate, and it is accepted if its
mandatory phrases stand in the aligned part of the file.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import BLOCK_BYTES, batch_of, text_of, utf8_values

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")  # on UTF-8 bytes; a code point above 7F is all of these
_BREAK = re.compile(rb"[^0-9a-z\x80-\xff]")

# Phrases that count by themselves, and the labels they give.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Label, words of the licence notice, and the phrases that must be present.
TEMPLATES = (
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this"
     " software and associated documentation files the software to deal in the software without"
     " restriction including without limitation the rights to use copy modify merge publish"
     " distribute sublicense and or sell copies of the software", ("permission is hereby granted",
     "deal in the software without restriction")),
    ("apache", "licensed under the apache license version 2 0", ("apache license",)),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this"
     " file except in compliance with the license you may obtain a copy of the license at",
     ("apache license", "in compliance with the license")),
    ("gpl", "this work is licensed under the gnu general public license version 3",
     ("gnu general public license",)),
    ("gpl", "this program is free software you can redistribute it and or modify it under the"
     " terms of the gnu general public license as published by the free software foundation",
     ("gnu general public license", "free software foundation")),
    ("lgpl", "under the terms of the gnu lesser general public license",
     ("gnu lesser general public license",)),
    ("agpl", "under the terms of the gnu affero general public license",
     ("gnu affero general public license",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are"
     " permitted provided that the following conditions are met",
     ("redistribution and use in source and binary forms", "following conditions are met")),
    ("bsd", "released under the bsd license", ("bsd license",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with"
     " or without fee is hereby granted", ("permission to use copy modify", "hereby granted")),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0",
     ("mozilla public license",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international"
     " license", ("creative commons attribution noncommercial",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    ("cc-by", "licensed under cc by 4 0", ("cc by 4",)),
    ("cc0", "released under cc0 1 0 universal public domain dedication", ("cc0 1 0",)),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     ("free and unencumbered software",)),
)

INDEX_WORDS = 4  # words of each template in the index, by falling IDF
SHIFT = 6  # words that may have been put in or left out


def scan_words(data: bytes) -> list[bytes]:
    """Words of digits, letters and non-ASCII characters, A-Z lower-cased."""
    return _WORD.findall(data.lower())


def _blocks(data: bytes) -> Iterator[list[bytes]]:
    """The words in lists of bounded length."""
    start = 0
    lowered = data.lower()
    while start < len(lowered):
        gap = _BREAK.search(lowered, start + BLOCK_BYTES) if len(lowered) - start > BLOCK_BYTES else None
        end = gap.start() if gap else len(lowered)
        yield _WORD.findall(lowered, start, end)
        start = end


class Scanner:
    """Templates, their index, and how one file is scanned."""

    def __init__(self, frequencies: dict[str, int], documents: int,
                 templates=TEMPLATES, phrases=PHRASES):
        def idf(word: str) -> float:
            return math.log((documents + 1) / (frequencies.get(word, 0) + 1))

        self.templates = [
            (label, notice.encode().split(), [p.encode().split() for p in musts])
            for label, notice, musts in templates
        ]
        self.phrases = [(p.encode().split(), label) for p, label in phrases.items()]
        self.last_words = {p[-1] for p, _ in self.phrases}
        self.postings: dict[bytes, list[tuple[int, int]]] = {}
        for number, (_, words, _) in enumerate(self.templates):
            rare = sorted(set(words), key=lambda w: (-idf(w.decode()), w))[:INDEX_WORDS]
            for word in rare:
                for place, w in enumerate(words):
                    if w == word:
                        self.postings.setdefault(word, []).append((number, place))
        self.indexed = [len({w for w in words if (n, words.index(w)) in self.postings.get(w, ())})
                        for n, (_, words, _) in enumerate(self.templates)]

    def scan(self, data: bytes) -> tuple:
        """(n_words, n_base, first, last, base labels, labels, score) of a file."""
        total, places, labels, found, score = 0, [], set(), set(), 0.0
        carry: list[bytes] = []
        reach = 2 * max(len(t[1]) + SHIFT for t in self.templates)
        for block in _blocks(data):
            words = carry + block
            base = total - len(carry)
            for place, label, size in self._phrases(words):
                if place + base + size > total:  # not seen with the block before
                    places.append(place + base)
                    labels.add(label)
            for label, share in self._templates(words):
                found.add(label)
                score = max(score, share)
            total += len(block)
            carry = words[-reach:]
        if labels and score == 0.0:
            score = 0.5  # a bare phrase, aligned with no template
        return (
            total,
            len(places),
            min(places) if places else None,
            max(places) if places else None,
            ",".join(sorted(labels)),
            ",".join(sorted(labels | found)),
            score,
        )

    def _phrases(self, words: list[bytes]) -> Iterator[tuple[int, str, int]]:
        if self.last_words.isdisjoint(words):
            return
        for n, word in enumerate(words):
            if word in self.last_words:
                for phrase, label in self.phrases:
                    start = n - len(phrase) + 1
                    if start >= 0 and words[start : n + 1] == phrase:
                        yield start, label, len(phrase)

    def _templates(self, words: list[bytes]) -> Iterator[tuple[str, float]]:
        """Accepted templates and the share of their words in place."""
        if self.postings.keys().isdisjoint(words):
            return
        starts: dict[int, list[tuple[int, bytes]]] = {}
        for n, word in enumerate(words):
            for number, place in self.postings.get(word, ()):
                starts.setdefault(number, []).append((n - place, word))
        for number, votes in starts.items():
            label, notice, musts = self.templates[number]
            needed = min(2, self.indexed[number])
            best = 0.0
            for start in self._agreed(votes, needed):
                low = max(0, start - SHIFT)
                part = words[low : start + len(notice) + 2 * SHIFT]
                if all(_holds(part, must) for must in musts):
                    best = max(best, self._aligned(notice, part))
            if best:
                yield label, best

    @staticmethod
    def _agreed(votes: list[tuple[int, bytes]], needed: int) -> Iterator[int]:
        """Places, at least a shift apart, on which ``needed`` different words agree."""
        votes.sort()
        low, last = 0, None
        inside: Counter = Counter()
        for start, word in votes:
            inside[word] += 1
            while votes[low][0] < start - SHIFT:
                inside[votes[low][1]] -= 1
                if not inside[votes[low][1]]:
                    del inside[votes[low][1]]
                low += 1
            if len(inside) >= needed and (last is None or start > last + SHIFT):
                last = votes[low][0]
                yield last

    @staticmethod
    def _aligned(notice: list[bytes], part: list[bytes]) -> float:
        """Share of the template's words that stand in order in the part of the file."""
        place = {}
        for n, word in enumerate(part):
            place.setdefault(word, []).append(n)
        at, held = -1, 0
        for word in notice:
            following = next((n for n in place.get(word, ()) if n > at), None)
            if following is not None and (held == 0 or following - at <= SHIFT + 1):
                at, held = following, held + 1
        return held / len(notice)


def _holds(words: list[bytes], phrase: list[bytes]) -> bool:
    size = len(phrase)
    return any(
        words[n] == phrase[0] and words[n : n + size] == phrase
        for n in range(len(words) - size + 1)
    )


def licence_words(templates=TEMPLATES) -> list[str]:
    return sorted({w for _, notice, _ in templates for w in notice.split()})


def document_frequencies(
    docs: DataFrame, words: list[str], text_col: str = "text"
) -> tuple[dict[str, int], int]:
    """How many documents hold each of these words, and the number of documents.

    Counted over all documents; one row per word and task is shuffled, one per word returned.
    """
    wanted = {w.encode() for w in words}

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        rows = 0
        for batch in batches:
            for data in utf8_values(batch.column(0)):
                present: set[bytes] = set()
                for block in _blocks(data):
                    present |= wanted.intersection(block)
                counts.update(present)
                rows += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([None, *(w.decode() for w in counts)], pa.string()),
             pa.array([rows, *counts.values()], pa.int64())], names=["word", "n"]
        )

    found = (
        docs.select(text_of(text_col).alias("text"))
        .mapInArrow(kernel, "word string, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    counts = {r.word: r.n for r in found}
    return counts, counts.pop(None, 0)


def scan_licenses(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    templates=TEMPLATES, phrases=PHRASES,
) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score) per row.

    ``n_base`` counts the places of the fixed phrases, ``first_word`` and ``last_word`` are
    their smallest and largest start in words from 0, NULL without any. ``labels`` adds those
    of accepted templates. ``score`` is the largest share of an accepted template's words found
    in place, 0.5 for a phrase that no template holds, else 0. NULL texts are empty and have
    no labels. Documents are read twice, nothing but word counts is shuffled.
    """
    frequencies, documents = document_frequencies(docs, licence_words(templates), text_col)
    fields = [("id", pa.int64())]
    fields += [(n, pa.int64()) for n in ("n_words", "n_base", "first_word", "last_word")]
    fields += [("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())]
    schema = pa.schema(fields)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(frequencies, documents, templates, phrases)
        for batch in batches:
            rows = [scanner.scan(data) for data in utf8_values(batch.column(1))]
            yield batch_of(schema, [batch.column(0), *map(list, zip(*rows, strict=True))] if rows
                           else [[] for _ in schema])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(
        kernel,
        "id long, n_words long, n_base long, first_word long, last_word long,"
        " base_labels string, labels string, score double",
    ).withColumnRenamed("id", id_col)
