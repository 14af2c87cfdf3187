"""License scan: fixed phrases, and an exact set-similarity join of text blocks with license templates.

Blocks of a text are its lines, cut into overlapping pieces where long, and, as notices are often wrapped, every run of
as many consecutive words as the template has, line feeds or not. A template is contained if at least the threshold's
share of its distinct words is in a block. (Longer runs over line feeds do not count: words of neighbouring lines would
add up to short templates.)

Template words are ordered by their frequency over all documents, rarest first. With c words needed of n, one of the
n-c+1 rarest (the prefix) must be in the block, so an index from prefix words to templates gives the pairs to look at,
around such words only. Of these, blocks with fewer than c words are passed over (length filter), and so are those whose
first shared word in this order leaves fewer than c words behind it, in the template or in the block (positional
filter). What remains is counted; in runs of words the count slides along.

The templates are on every executor: they are a parameter, bounded by TEMPLATE_BYTES.

Defined results. Null text: as empty, no words, score 0. Repeated rows and null doc_ids are scanned like any other. Extra
columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import LETTERS, Vocabulary, Words, binary, chunks

THRESHOLD = 0.8
#: Words of a block of a line, and after how many the next one starts.
BLOCK, STRIDE = 80, 40
#: Bytes of all templates at most.
TEMPLATE_BYTES = 8 << 20
# Phrase and label.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Label and texts of notices and licenses; letters, digits and single spaces only, in lower case.
TEMPLATES = {
    "gpl": (
        "this work is licensed under the gnu general public license version 3",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"
        " either version 3 of the license or at your option any later version this program is distributed in the hope that it will be useful but without any warranty"
        " without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details",
    ),
    "lgpl": ("this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license",),
    "apache": (
        "licensed under the apache license version 2 0",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at"
        " http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"
        " without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license",
    ),
    "mit": (
        "released under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"
        " including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished"
        " to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"
        " the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"
        " in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise"
        " arising from out of or in connection with the software or the use or other dealings in the software",
    ),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce"
        " the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    ),
    "isc": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    ),
    "cc-by": ("this work is licensed under a creative commons attribution license", "licensed under cc by 4 0"),
    "mpl": ("this source code form is subject to the terms of the mozilla public license v 2 0",),
}


def frequencies(documents: DataFrame, vocabulary: Vocabulary) -> list[int]:
    """How often each word of the vocabulary stands in all documents."""

    def run(batches):
        counts = np.zeros(len(vocabulary.words), np.int64)
        for batch in chunks(batches, "text"):
            numbers = vocabulary.of(Words(*binary(batch.column("text")), LETTERS))
            counts += np.bincount(numbers[numbers >= 0], minlength=len(counts))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(counts), dtype=np.int32)), pa.array(counts)], names=["word", "n"])

    rows = documents.select("text").mapInArrow(run, "word int, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()  # a row a word
    out = [0] * len(vocabulary.words)
    for r in rows:
        out[r["word"]] = r["n"]
    return out


class Matcher:
    """Finds phrases and templates in a chunk of texts. rank: each vocabulary word's place, rarest first."""

    def __init__(self, vocabulary: Vocabulary, counts: list[int], phrases: dict[str, str], templates: list[tuple[str, str]], threshold: float):
        self.vocabulary = vocabulary
        order = sorted(range(len(counts)), key=lambda k: (counts[k], vocabulary.words[k]))
        self.rank = np.empty(len(counts), np.int32)
        self.rank[order] = np.arange(len(counts))
        self.phrases = [([vocabulary.number[w] for w in p.split()], label) for p, label in phrases.items()]
        self.templates = []
        self.prefix = np.zeros(len(counts), bool)
        #: The templates that a prefix word begins.
        self.begun: dict[int, list[int]] = {}
        for k, (label, text) in enumerate(templates):
            own = sorted({int(self.rank[vocabulary.number[w]]) for w in text.split()})
            need = math.ceil(threshold * len(own) - 1e-9)
            self.templates.append((label, own, need, len(text.split()), frozenset(own)))
            for r in own[: len(own) - need + 1]:
                self.prefix[r] = True
                self.begun.setdefault(r, []).append(k)

    def places(self, numbers: np.ndarray, text_of: np.ndarray) -> list[tuple[int, str]]:
        out = []
        for words, label in self.phrases:
            at = np.flatnonzero(numbers == words[0])
            at = at[at + len(words) <= len(numbers)]
            for k, w in enumerate(words[1:], 1):
                at = at[numbers[at + k] == w]
            at = at[text_of[at] == text_of[at + len(words) - 1]]
            out += [(p, label) for p in at.tolist()]
        return sorted(out)

    def blocks(self, first: int, last: int, breaks: np.ndarray, hits: np.ndarray):
        """Word ranges of a text's blocks that hold a prefix word. breaks: indexes of words that start a line."""
        lines = np.r_[first, breaks[(breaks > first) & (breaks < last)], last]
        own = np.unique(np.searchsorted(lines, hits, "right") - 1)
        for k in own.tolist():
            a, b = int(lines[k]), int(lines[k + 1])
            for s in range(a, max(a + 1, b - (BLOCK - STRIDE)), STRIDE):
                e = min(s + BLOCK, b)
                if np.searchsorted(hits, s) < np.searchsorted(hits, e):
                    yield s, e

    def contained(self, ranks: np.ndarray, words: int) -> list[tuple[str, float]]:
        """Templates that a block with these ranks (-1: none) and so many words contains, with their share."""
        have = np.unique(ranks[ranks >= 0]).tolist()
        found, place = set(have), {r: k for k, r in enumerate(have)}
        out = []
        for k in sorted({k for r in have for k in self.begun.get(r, ())}):
            label, own, need, _, every = self.templates[k]
            if words < need:
                continue
            at = next(j for j, r in enumerate(own) if r in found)
            if len(own) - at < need or len(have) - place[own[at]] < need:
                continue
            shared = len(every & found)
            if shared >= need:
                out.append((label, shared / len(own)))
        return out

    def wrapped(self, ranks: np.ndarray, first: int, last: int, hits: np.ndarray):
        """Templates, with their share, that a text's runs of consecutive words around its prefix words contain."""
        around: dict[int, list[int]] = {}
        for h in hits.tolist():
            for k in self.begun[int(ranks[h])]:
                around.setdefault(k, []).append(h)
        for k, places in around.items():
            label, own, need, most, every = self.templates[k]
            best = 0
            ends = [j for j in range(1, len(places)) if places[j] - places[j - 1] >= 2 * most]
            for i, j in zip([0, *ends], [*ends, len(places)], strict=True):  # stretches of places whose runs overlap
                low, high = max(first, places[i] - most + 1), min(last, places[j - 1] + most)
                held: deque[int] = deque()
                counts: dict[int, int] = {}
                for at, r in enumerate(ranks[low:high].tolist()):
                    if r not in every:
                        continue
                    while held and held[0] <= at - most:
                        gone = ranks[low + held.popleft()]
                        counts[gone] -= 1
                        if not counts[gone]:
                            del counts[gone]
                    held.append(at)
                    counts[r] = counts.get(r, 0) + 1
                    best = max(best, len(counts))
            if best >= need:
                yield label, best / len(own)


def license_scan(
    documents: DataFrame,
    phrases: dict[str, str] = PHRASES,
    templates: dict[str, tuple[str, ...]] = TEMPLATES,
    threshold: float = THRESHOLD
) -> DataFrame:
    """Per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score (the largest share of a contained template, 0 if none)."""
    flat = [(label, t) for label, texts in templates.items() for t in texts]
    if sum(len(t) for _, t in flat) > TEMPLATE_BYTES:
        raise ValueError(f"templates of more than {TEMPLATE_BYTES} bytes")
    vocabulary = Vocabulary({w for t in [*phrases, *[t for _, t in flat]] for w in t.split()})
    matcher = Matcher(vocabulary, frequencies(documents, vocabulary), phrases, flat, threshold)

    def run(batches):
        for batch in chunks(batches, "text"):
            data, offsets = binary(batch.column("text"))
            words = Words(data, offsets, LETTERS)
            numbers = vocabulary.of(words)
            text_of = np.repeat(np.arange(batch.num_rows), np.diff(words.first))
            places: dict[int, list] = {}
            for p, label in matcher.places(numbers, text_of):
                places.setdefault(int(text_of[p]), []).append((p - int(words.first[text_of[p]]), label))
            ranks = np.where(numbers >= 0, matcher.rank[numbers], -1)
            hits = np.flatnonzero((ranks >= 0) & matcher.prefix[ranks])
            breaks = np.searchsorted(words.start, np.flatnonzero(data == 10))
            found: dict[int, list] = {}
            for d in np.unique(text_of[hits]).tolist():
                a, b = int(words.first[d]), int(words.first[d + 1])
                own = hits[np.searchsorted(hits, a) : np.searchsorted(hits, b)]
                lines = breaks[np.searchsorted(breaks, a) : np.searchsorted(breaks, b)]
                for s, e in matcher.blocks(a, b, lines, own):
                    found.setdefault(d, []).extend(matcher.contained(ranks[s:e], e - s))
                found.setdefault(d, []).extend(matcher.wrapped(ranks, a, b, own))
            rows = range(batch.num_rows)
            base = [sorted({label for _, label in places.get(d, [])}) for d in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.diff(words.first).astype(np.int64)),
                    pa.array([len(places.get(d, [])) for d in rows], pa.int64()),
                    pa.array([places[d][0][0] if d in places else None for d in rows], pa.int64()),
                    pa.array([places[d][-1][0] if d in places else None for d in rows], pa.int64()),
                    pa.array([",".join(b) for b in base], pa.string()),
                    pa.array([",".join(sorted({*base[d], *[label for label, _ in found.get(d, [])]})) for d in rows], pa.string()),
                    pa.array([max([x for _, x in found.get(d, [])], default=0.0) for d in rows], pa.float64()),
                ],
                names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
            )

    return documents.select("doc_id", "text").mapInArrow(
        run,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    )
