"""License texts in documents: winnowed fingerprints pick candidates, banded alignment measures them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from dormouse.llm.bytetext import LETTERS, Texts, slices, windows
from dormouse.llm.spread import in_tasks, named, quoted, undotted

# A fingerprint is a hash of so many words; of so many neighbours the least is kept. Any stretch of
# GRAM + NEIGHBOURS - 1 words that a document shares with a template then shares a fingerprint.
GRAM, NEIGHBOURS = 3, 2
# Words that alignment may drift from the diagonal of the fingerprints it starts from.
BAND = 12
# Of a template's words, the share that has to be matched in order.
MIN_COVERAGE = 0.75

# Notices by which texts and programs state their license.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License."
    ),
    "BSD-redistribution": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met"
    ),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "CC0-1.0": (
        "To the extent possible under law, the author has waived all copyright and related or "
        "neighboring rights to this work"
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either version 3 "
        "of the License, or (at your option) any later version."
    ),
    "LGPL-header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of "
        "the GNU Lesser General Public License as published by the Free Software Foundation"
    ),
    "MIT": "Released under the MIT License",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files (the \"Software\"), to deal in the Software without "
        "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions"
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy "
        "of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/"
    ),
}


def winnowed(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Of the hashes of consecutive grams, the places of those that are least among neighbours.

    Ties go to the last. A text with fewer grams than neighbours keeps its least one.
    """
    count = len(hashes)
    if not count:
        return np.zeros(0, np.int64)
    chosen = np.zeros(count, bool)
    least, size = np.arange(count), np.ones(count, np.int64)
    for step in range(1, NEIGHBOURS):
        at = np.arange(count - step) if step < count else np.zeros(0, np.int64)
        at = at[owner[at] == owner[at + step]]
        better = hashes[at + step] <= hashes[least[at]]
        least[at[better]] = (at + step)[better]
        size[at] += 1
    first = np.ones(count, bool)
    first[1:] = owner[1:] != owner[:-1]
    chosen[least[(size == NEIGHBOURS) | first]] = True
    return np.flatnonzero(chosen)


def _grams(texts: Texts) -> tuple[np.ndarray, ...]:
    starts, ends = texts.runs(LETTERS)
    words = texts.hashes(starts, ends, lower=True)
    owner = texts.of_positions(starts)
    grams = windows(words, GRAM)
    at = np.flatnonzero(owner[: len(grams)] == owner[GRAM - 1 :]) if len(grams) else np.zeros(0, np.int64)
    kept = at[winnowed(grams[at], owner[at])]
    return starts, ends, words, owner, grams[kept], kept


@dataclass
class Index:
    """Templates as word hashes, and their fingerprints in order, with template and place of each."""

    names: list[str]
    words: list[np.ndarray]
    prints: np.ndarray
    template: np.ndarray
    place: np.ndarray

    @classmethod
    def of(cls, templates: dict[str, str]) -> Index:
        names = sorted(templates)
        texts = Texts.of(pa.array([templates[n] for n in names], pa.string()))
        _, _, words, owner, prints, at = _grams(texts)
        bounds = np.searchsorted(owner, np.arange(len(names) + 1))
        order = np.argsort(prints, kind="stable")
        template = owner[at]
        return cls(
            names,
            [words[b:e] for b, e in zip(bounds[:-1], bounds[1:])],
            prints[order],
            template[order],
            (at - bounds[template])[order],
        )


def align(template: np.ndarray, words: np.ndarray, shift: int, band: int = BAND) -> tuple[int, int, int]:
    """Most template words matched in order within the band, and the words' first and last match.

    Word j of the document is held against word i of the template only if j - i is within ``band``
    of ``shift``. Of alignments with as many matches the one with the shortest span counts, then the first.
    """
    width = 2 * band + 1
    # best[d]: (matches, first matched word, -last matched word) with j - i = shift - band + d
    none = (0, 0, 1)
    best = [none] * (width + 1)
    for i, word in enumerate(template.tolist()):
        now = [none] * (width + 1)
        for d in range(width):
            j = i + shift - band + d
            # leave out the document's word, the template's word, or match both
            choice = max(now[d - 1] if d else none, best[d + 1] if d + 1 <= width else none)
            if 0 <= j < len(words) and int(words[j]) == word:
                count, first, _ = best[d]
                choice = max(choice, (count + 1, first if count else j, -j))
            now[d] = choice
        now[width] = none
        best = now
    count, first, last = max(best, key=lambda m: (m[0], m[1] + m[2], -m[1]))
    return count, first, 1 - last


def find(texts: Texts, index: Index, min_coverage: float = MIN_COVERAGE) -> dict[int, list[dict]]:
    starts, ends, words, owner, prints, at = _grams(texts)
    low = np.searchsorted(index.prints, prints)
    high = np.searchsorted(index.prints, prints, "right")
    found: dict[tuple[int, int], set[int]] = {}
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    for k in np.flatnonzero(high > low).tolist():
        text = int(owner[at[k]])
        for e in range(int(low[k]), int(high[k])):
            # the diagonal: where the template's first word would stand in the text
            found.setdefault((text, int(index.template[e])), set()).add(
                int(at[k]) - int(bounds[text]) - int(index.place[e])
            )
    out: dict[int, list[dict]] = {}
    for (text, template), shifts in found.items():
        own = words[bounds[text] : bounds[text + 1]]
        body = index.words[template]
        spans: dict[tuple[int, int], int] = {}
        done = 0
        for shift in sorted(shifts):
            # With all words, and without those of matches before: of spans that overlap, one is chosen
            # later. Words of an alignment that is no match stay free.
            for low_at in sorted({max(0, shift - BAND), max(0, done, shift - BAND)}):
                part = own[low_at : max(low_at, shift + len(body) + BAND)]
                matched, first, end = align(body, part, shift - low_at)
                if matched >= min_coverage * len(body):
                    key = (low_at + first, low_at + end)
                    spans[key] = max(spans.get(key, 0), matched)
                    done = max(done, low_at + end)
        base, begin = int(bounds[text]), int(texts.offsets[text])
        for (first, end), matched in spans.items():
            lead = (texts.data[begin : ends[base + end - 1]] & 0xC0) != 0x80
            out.setdefault(text, []).append(
                {
                    "license": index.names[template],
                    "begin": int(np.count_nonzero(lead[: starts[base + first] - begin])),
                    "end": int(np.count_nonzero(lead)),
                    "matched": matched,
                    "words": len(body),
                }
            )
    return {text: _best(own) for text, own in out.items()}


def _best(spans: list[dict]) -> list[dict]:
    """Of spans that overlap, the one with most words matched, then the fewest missing."""
    chosen: list[dict] = []
    for span in sorted(spans, key=lambda s: (-s["matched"], s["words"], s["begin"], s["license"])):
        if all(span["end"] <= c["begin"] or c["end"] <= span["begin"] for c in chosen):
            chosen.append(span)
    return sorted(chosen, key=lambda s: s["begin"])


_SPAN = [
    ("license", pa.string(), "string"),
    ("begin", pa.int32(), "int"),
    ("end", pa.int32(), "int"),
    ("matched", pa.int32(), "int"),
    ("words", pa.int32(), "int"),
]


def scanned(
    documents: DataFrame,
    text: str,
    result: str,
    templates: dict[str, str] | None = None,
    min_coverage: float = MIN_COVERAGE,
) -> DataFrame:
    """All columns, and ``result``: an array of matched templates, in order of where they begin.

    Each has the ``license``, its span in code points, and how many of the template's ``words`` were
    ``matched`` in order. Where matches overlap, the one with most words counts. The templates are a parameter and broadcast. A template that has fewer
    words than a fingerprint finds nothing. A null or empty text has no matches; a column named
    like ``result`` is replaced.
    """
    rows, plain = undotted(documents.drop(result))
    text = plain[text]
    index = documents.sparkSession.sparkContext.broadcast(Index.of(templates or TEMPLATES))
    kind = pa.list_(pa.struct([(name, arrow) for name, arrow, _ in _SPAN]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                texts = Texts.of(part.column(text))
                found = find(texts, index.value, min_coverage)
                spans = pa.array([found.get(i, []) for i in range(len(texts))], kind)
                yield pa.RecordBatch.from_arrays([*part.columns, spans], names=[*part.schema.names, result])

    fields = ",".join(f"{name}:{sql}" for name, _, sql in _SPAN)
    return in_tasks(rows, scan, f"{named(rows)}, {quoted(result)} array<struct<{fields}>>").toDF(*plain, result)
