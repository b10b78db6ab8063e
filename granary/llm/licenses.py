"""License notices found with spelling errors.

A text becomes its words, joined by one space. A notice of n letters may differ in ``n // 10``
edits; cut into one piece more than that, at least one piece of it stands unchanged wherever it occurs
(pigeonhole principle). Exact searches for the pieces give candidate windows, each no longer than the notice and its
edits, and the regex library's bounded-error matching verifies the edits in each window by itself and reports
the span. Two matches in one window overlap, so none is hidden by a better one elsewhere, and time is in line with the text.
The places of the plain phrases are the notices' matches without an edit.

Defined cases: a null text, an empty one and one without a word have no place, no label and score 0.
Repeated rows and null ids are kept row by row; a very long text is searched whole. Overlapping matches of
different labels are all reported; of one label the best of overlapping matches. Columns other than the text
pass through, but for those named like the new ones, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from granary.llm.common import WORD_TABLE, encoded, extended, numbered, rounds

#: Phrases whose words in a row name a license.
PHRASES = (
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
)
#: Short notices of common licenses, as their words.
NOTICES = (
    ("agpl", "gnu affero general public license"),
    ("apache", "apache license"),
    ("apache", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by", "creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "creative commons attribution sharealike 4 0 international license"),
    ("gpl", "gnu general public license"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose"),
    ("lgpl", "gnu lesser general public license"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("reserved", "all rights reserved"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)
#: Letters of a notice for one edit.
LETTERS_PER_EDIT = 10


class Notice:
    def __init__(self, label: str, text: str):
        self.label, self.text = label, text.encode()
        self.edits = len(text) // LETTERS_PER_EDIT
        count, size = self.edits + 1, len(text)
        cuts = [size * i // count for i in range(count + 1)]
        self.pieces = [(cuts[i], self.text[cuts[i] : cuts[i + 1]]) for i in range(count)]
        self.match = regex.compile(rb"(?b)(?<= )(?:%b){e<=%d}(?= )" % (self.text, self.edits)).search

    def windows(self, text: bytes) -> list[int]:
        """Where windows begin: around every piece's place, as if the piece were the notice's."""
        found = set()
        for offset, piece in self.pieces:
            at = text.find(piece)
            while at >= 0:
                found.add(at - offset - self.edits - 1)
                at = text.find(piece, at + 1)
        return sorted(found)

    def matches(self, text: bytes) -> list[tuple[int, int, int]]:
        """``(begin, end, edits)`` in bytes of the joined words."""
        out, size = set(), len(self.text) + 2 * self.edits + 2
        for begin in self.windows(text):
            m = self.match(text, max(0, begin), min(begin + size, len(text)))
            if m:
                out.add((m.start(), m.end(), sum(m.fuzzy_counts)))
        return sorted(out)


class Scanner:
    def __init__(self):
        self.notices = [Notice(*x) for x in NOTICES]
        self.phrases = [(label, f" {text} ".encode()) for label, text in PHRASES]

    def __call__(self, text: bytes) -> tuple[int, list[tuple[str, int]], list[tuple[str, int, int, int, float]]]:
        """Number of words, places of the plain phrases, and notices as ``(label, begin, end, edits, score)`` in words."""
        words = text.translate(WORD_TABLE).split()
        joined = b" " + b" ".join(words) + b" "
        spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
        places = []
        for label, phrase in self.phrases:
            at = joined.find(phrase)
            while at >= 0:
                places.append((label, int(np.searchsorted(spaces, at))))
                at = joined.find(phrase, at + 1)
        found = []
        for notice in self.notices:
            for begin, end, edits in notice.matches(joined):
                first, last = np.searchsorted(spaces, (begin, end)).tolist()
                found.append((notice.label, first - 1, last, edits, 1 - edits / len(notice.text)))
        return len(words), places, self._best(found)

    @staticmethod
    def _best(found: list[tuple[str, int, int, int, float]]) -> list[tuple[str, int, int, int, float]]:
        """Without those that overlap a better one, or an equally good longer one, of their label."""
        out: list[tuple[str, int, int, int, float]] = []
        last: dict[str, tuple[str, int, int, int, float]] = {}
        for one in sorted(found, key=lambda m: (m[0], m[1], -m[2])):
            before = last.get(one[0])
            if before and one[1] < before[2]:
                if (one[4], one[2] - one[1]) <= (before[4], before[2] - before[1]):
                    continue
                out.pop()  # the one before, as labels stand together
            out.append(one)
            last[one[0]] = one
        return sorted(out, key=lambda m: (m[1], m[2], m[0]))


NEW = """n_words long, places array<struct<label:string,word:long>>,
notices array<struct<label:string,begin:long,end:long,edits:long,score:double>>"""
NAMES = ("label", "begin", "end", "edits", "score")
PLACE = pa.struct([("label", pa.string()), ("word", pa.int64())])
NOTICE = pa.struct([("label", pa.string()), ("begin", pa.int64()), ("end", pa.int64()), ("edits", pa.int64()), ("score", pa.float64())])


def scan(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """The rows with ``n_words``, ``places`` of plain phrases and ``notices`` with their spans of words."""
    kept, schema = extended(docs, NEW)
    where, names = kept.columns.index(text_column), schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for whole in batches:
            for batch in rounds([numbered(whole)], str(where)):
                found = [scanner(t) for t in encoded(batch.column(where))]
                places = [[{"label": x[0], "word": x[1]} for x in own] for _, own, _ in found]
                notices = [[dict(zip(NAMES, x, strict=True)) for x in own] for *_, own in found]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array([n for n, *_ in found], pa.int64()), pa.array(places, pa.list_(PLACE)),
                     pa.array(notices, pa.list_(NOTICE))], names,
                )

    return kept.mapInArrow(run, schema)
