"""License scans with a positional rare-token index.

License notices are templates of words. Their words form a small index: word
-> (template, position). A first pass counts, over all documents, in how many
each index word stands; the fewer, the higher its IDF. The second pass looks
up, for every template, the ``RARE`` highest-IDF words that a document shares
with it and intersects their postings by relative position: a word at p in the
document and at q in the template votes for the offset p - q. An offset with
``LEAST_VOTES`` different words is aligned in whole: the share of template
words found in their place must reach ``LEAST_SHARE``, and every mandatory key
phrase must stand within ``SLACK`` words of the aligned stretch.

Fixed phrases (``PHRASES``) give base labels wherever their words stand
consecutively; the templates add labels of their own.

Defined results: a NULL text is empty; without any label, ``labels`` is the
empty string and ``score`` 0. A base phrase scores 1, a template the largest
share over its offsets; ``score`` is the largest of all. IDF ties go to the
smaller word. Rows that share a doc_id, or have none, are rows of their own.
Texts are read whole, a slice of about a megabyte at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.shipping import ship_package

#: Words whose places are counted, and the label they give.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

#: Short notices of public licenses, in words; a label, the
#: notice, and the key phrases without which it doesn't count.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this "
            "software and associated documentation files the software to deal in the software "
            "without restriction including without limitation the rights to use copy modify merge "
            "publish distribute sublicense and or sell copies of the software",
     ("permission is hereby granted free of charge", "deal in the software without restriction")),
    ("mit", "released under the mit license", ("the mit license",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with "
            "or without fee is hereby granted provided that the above copyright notice and this "
            "permission notice appear in all copies",
     ("with or without fee is hereby granted",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are "
            "permitted provided that the following conditions are met",
     ("in source and binary forms", "following conditions are met")),
    ("bsd-3-clause", "neither the name of the copyright holder nor the names of its contributors "
                     "may be used to endorse or promote products derived from this software "
                     "without specific prior written permission",
     ("endorse or promote products derived from this software",)),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this "
                 "file except in compliance with the license you may obtain a copy of the license "
                 "at http www apache org licenses license 2 0",
     ("the apache license version 2", "except in compliance with the license")),
    ("apache-2", "licensed under the apache license version 2 0", ("apache license version 2",)),
    ("gpl", "this program is free software you can redistribute it and or modify it under the "
            "terms of the gnu general public license as published by the free software foundation",
     ("free software you can redistribute it", "gnu general public license")),
    ("gpl-3", "this work is licensed under the gnu general public license version 3",
     ("gnu general public license version 3",)),
    ("gpl-2", "this work is licensed under the gnu general public license version 2",
     ("gnu general public license version 2",)),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the "
             "terms of the gnu lesser general public license as published by the free software "
             "foundation",
     ("gnu lesser general public license",)),
    ("agpl-3", "licensed under the gnu affero general public license version 3",
     ("gnu affero general public license",)),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0 "
              "if a copy of the mpl was not distributed with this file you can obtain one at http "
              "mozilla org mpl 2 0",
     ("mozilla public license v 2",)),
    ("cc-by", "this work is licensed under the creative commons attribution 4 0 international "
              "license",
     ("creative commons attribution 4",)),
    ("cc-by-sa", "this work is licensed under the creative commons attribution sharealike 4 0 "
                 "international license",
     ("creative commons attribution sharealike",)),
    ("cc-by-nc", "this work is licensed under the creative commons attribution noncommercial 4 0 "
                 "international license",
     ("creative commons attribution noncommercial",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or "
            "neighboring rights to this work",
     ("waived all copyright and related or neighboring rights",)),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     ("free and unencumbered software",)),
    ("zlib", "this software is provided as is without any express or implied warranty in no event "
             "will the authors be held liable for any damages arising from the use of this "
             "software",
     ("provided as is without any express or implied warranty", "will the authors be held liable")),
)

#: Rare words looked up of each template, votes of an offset, share of template
#: words in their place, and words that a key phrase may stand aside.
RARE, LEAST_VOTES, LEAST_SHARE, SLACK = 8, 3, 0.6, 8

_SLICE = 1 << 20
#: Bytes of a text in lower case where they belong to words, else a space.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128
               else 32 for b in range(256))
RESULT = ("n_words long, n_base long, first_word long, last_word long, base_labels string, "
          "labels string, score double")


@dataclass
class _Template:
    label: str
    words: list[bytes]
    phrases: list[list[bytes]]
    places: dict[bytes, np.ndarray] = field(default_factory=dict)
    must: frozenset = frozenset()

    def __post_init__(self):
        own = np.array(self.words)
        self.places = {w: np.flatnonzero(own == w) for w in set(self.words)}
        self.must = frozenset(w for p in self.phrases for w in p)


@dataclass
class LicenseIndex:
    """The templates and phrases, and after ``with_frequencies`` the number of
    documents that hold each index word."""

    templates: list[_Template]
    phrases: list[tuple[list[bytes], str]]
    vocabulary: frozenset
    frequency: dict[bytes, int] = field(default_factory=dict)

    def with_frequencies(self, counts: dict[str, int]) -> "LicenseIndex":
        return LicenseIndex(self.templates, self.phrases, self.vocabulary,
                            {w.encode(): n for w, n in counts.items()})

    def scan(self, text: bytes) -> tuple:
        n_words, present = 0, set()
        for _, ws in _word_slices(text):
            n_words += len(ws)
            present |= self.vocabulary.intersection(ws)
        phrases = [p for p in self.phrases if present.issuperset(p[0])]
        templates = [t for t in self.templates if present >= t.must]
        at = _places(text, {w for p, _ in phrases for w in p}
                     | {w for t in templates for w in t.words if w in present})
        starts = [(label, _starts(p, at)) for p, label in phrases]
        starts = [(label, s) for label, s in starts if len(s)]
        found = np.concatenate([np.zeros(0, np.int64), *(s for _, s in starts)])
        base = {label for label, _ in starts}
        labels, score = set(base), float(bool(base))
        for t in templates:
            share = self._share(t, at)
            if share:
                labels.add(t.label)
                score = max(score, share)
        return (n_words, len(found), int(found.min()) if len(found) else None,
                int(found.max()) if len(found) else None, ",".join(sorted(base)),
                ",".join(sorted(labels)), score)

    def _share(self, t: _Template, at: dict[bytes, np.ndarray]) -> float:
        """The largest share of an offset that meets all conditions, else 0."""
        shared = sorted((w for w in t.places if w in at),
                        key=lambda w: (self.frequency.get(w, 0), w))
        votes = [_offsets(at[w], t.places[w]) for w in shared[:RARE]]
        offset, n = np.unique(np.concatenate(votes), return_counts=True)
        offset = offset[n >= LEAST_VOTES]
        if not len(offset):
            return 0.0
        hits = np.zeros(len(offset), np.int64)
        for w in shared:  # words of the template that stand in their place
            for q in t.places[w]:
                hits += np.isin(offset + q, at[w])
        ok = hits >= LEAST_SHARE * len(t.words)
        for phrase in t.phrases:
            start = _starts(phrase, at)
            first = np.searchsorted(start, offset - SLACK)
            last = np.searchsorted(start, offset + len(t.words) + SLACK - len(phrase), "right")
            ok &= last > first
        return float(hits[ok].max()) / len(t.words) if ok.any() else 0.0


def license_index(templates=TEMPLATES, phrases=PHRASES) -> LicenseIndex:
    made = [_Template(label, text.encode().split(), [p.encode().split() for p in keys])
            for label, text, keys in templates]
    fixed = [(p.encode().split(), label) for p, label in phrases]
    words = frozenset(w for t in made for w in t.words) | {w for p, _ in fixed for w in p} \
        | {w for t in made for w in t.must}
    return LicenseIndex(made, fixed, words)


def _word_slices(text: bytes) -> Iterator[tuple[int, list[bytes]]]:
    """(number of the first word, words) of slices that end between words."""
    start, number = 0, 0
    while start < len(text):
        end = min(start + _SLICE, len(text))
        while end < len(text) and _TABLE[text[end]] != 32:
            end += 1
        ws = text[start:end].translate(_TABLE).split()
        yield number, ws
        start, number = end, number + len(ws)


def _places(text: bytes, wanted: set) -> dict[bytes, np.ndarray]:
    """Ascending places of the wanted words."""
    found: dict[bytes, list[int]] = {w: [] for w in wanted}
    if wanted:
        for number, ws in _word_slices(text):
            for k, w in enumerate(ws, number):
                if w in found:
                    found[w].append(k)
    return {w: np.array(p, np.int64) for w, p in found.items()}


def _starts(phrase: list[bytes], at: dict[bytes, np.ndarray]) -> np.ndarray:
    """Ascending places where the phrase's words stand consecutively."""
    out = at.get(phrase[0], np.zeros(0, np.int64))
    for k, w in enumerate(phrase[1:], 1):
        out = out[np.isin(out + k, at.get(w, np.zeros(0, np.int64)))]
    return out


def _offsets(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """The offsets that one word votes for, each once."""
    return np.unique(np.concatenate([p - k for k in q]))


def document_frequencies(docs: DataFrame, index: LicenseIndex,
                         text_col: str = "text") -> dict[str, int]:
    """Documents that hold each index word, over all documents. The result is
    bounded by the index; a task adds up its own before the shuffle."""
    vocabulary = index.vocabulary

    def count(batches):
        seen: dict[bytes, int] = {}
        for b in batches:
            for text in b.column(0):
                own = set()
                for _, ws in _word_slices(text.as_py() or b""):
                    own |= vocabulary.intersection(ws)
                for w in own:
                    seen[w] = seen.get(w, 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in seen], pa.string()),
                                          pa.array(list(seen.values()), pa.int64())],
                                         ["word", "n"])

    ship_package(docs.sparkSession)
    rows = docs.select(F.col(text_col).cast("binary").alias("text")).mapInArrow(
        count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {r.word: r.n for r in rows.collect()}


def scan_licenses(docs: DataFrame, index: LicenseIndex | None = None, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id`` and the columns of ``RESULT``."""
    index = index or license_index()
    index = index.with_frequencies(document_frequencies(docs, index, text_col))
    names = [f.split() for f in RESULT.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}

    def scan(batches):
        for b in batches:
            rows = [index.scan(t.as_py() or b"") for t in b.column(1)]
            columns = zip(*rows) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, kinds[k]) for c, (_, k) in zip(columns, names))],
                ["doc_id", *(n for n, _ in names)])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("binary").alias("text")).mapInArrow(
        scan, f"doc_id long, {RESULT}")
