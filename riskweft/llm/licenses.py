"""License scans: a generalised suffix automaton of licence templates, matching statistics, chained spans.

The automaton holds the word sequences of all templates. A document's words run through it: at each word it knows the longest
stretch ending there that occurs in some template. Stretches that can't grow are matches; matches of one template that follow
each other within ``max_gap`` words chain to a span, and the share of the template's words that a span covers is its score. A
template counts from a share of ``min_share`` on, with at least ``min_words`` words in a row.

Short phrases are templates too: they count at every place where the whole phrase stands.

Words that no template has end every match, so only runs of template words enter the automaton, which is built on the driver
from the templates (a few thousand states) and sent to the tasks. The scan is one map without a shuffle.

Nulls and ties: a null text is empty, without words, labels or spans, and has score 0; repeated documents are scanned one by
one; an empty table gives no rows; only the id and the text are read, so other columns don't matter.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweft.llm.common import alnum_words, slices

# Phrases that count wherever they stand, and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Notices that licences ask to be put into files, and openings of licence texts.
TEMPLATES = [
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("mit", "Released under the MIT License."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License."),
    ("all-rights-reserved", "All rights reserved."),
]

SPAN = "array<struct<label:string,first:bigint,end:bigint,share:double>>"


@dataclass
class Automaton:
    """Generalised suffix automaton over word numbers; 0 is a word that no template has."""

    vocabulary: dict[bytes, int] = field(default_factory=dict)
    labels: list[str] = field(default_factory=list)
    sizes: list[int] = field(default_factory=list)
    phrases: int = 0
    step: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    length: list[int] = field(default_factory=lambda: [0])
    members: list[frozenset[int]] = field(default_factory=list)
    whole: list[list[tuple[int, int]]] = field(default_factory=list)

    @staticmethod
    def of(phrases: dict[str, str], templates: list[tuple[str, str]]) -> Automaton:
        auto, ends, texts = Automaton(phrases=len(phrases)), defaultdict(set), []
        for label, text in [*((b, a) for a, b in phrases.items()), *templates]:
            words = alnum_words(text.encode())
            texts.append([auto.vocabulary.setdefault(w, len(auto.vocabulary) + 1) for w in words])
            auto.labels.append(label)
            auto.sizes.append(len(words))
        for number, codes in enumerate(texts):
            last = 0
            for code in codes:
                last = auto._extend(last, code)
        # A state stands for stretches with the same ends; a template belongs to every state on the suffix path of its prefixes.
        for number, codes in enumerate(texts):
            state = 0
            for code in codes:
                state = auto.step[state][code]
                at = state
                while at > 0 and number not in ends[at]:
                    ends[at].add(number)
                    at = auto.link[at]
        auto.members = [frozenset(ends[s]) for s in range(len(auto.step))]
        # Phrases that end where a state ends, by their length.
        auto.whole = [[] for _ in auto.step]
        for number in range(auto.phrases):
            state = 0
            for code in texts[number]:
                state = auto.step[state][code]
            auto.whole[state].append((number, auto.sizes[number]))
        for s in sorted(range(1, len(auto.step)), key=auto.length.__getitem__):
            auto.whole[s] = auto.whole[s] + auto.whole[auto.link[s]]
        return auto

    def _new(self, length: int, step: dict[int, int], link: int) -> int:
        self.step.append(step)
        self.length.append(length)
        self.link.append(link)
        return len(self.step) - 1

    def _split(self, p: int, q: int, code: int) -> int:
        """The state for the stretches of q that end p's own, made anew where q also has longer ones."""
        if self.length[p] + 1 == self.length[q]:
            return q
        clone = self._new(self.length[p] + 1, dict(self.step[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.step[p].get(code) == q:
            self.step[p][code] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, code: int) -> int:
        if code in self.step[last]:
            return self._split(last, self.step[last][code], code)
        own, p = self._new(self.length[last] + 1, {}, 0), last
        while p >= 0 and code not in self.step[p]:
            self.step[p][code] = own
            p = self.link[p]
        self.link[own] = 0 if p < 0 else self._split(p, self.step[p][code], code)
        return own

    def statistics(self, codes: list[int]) -> Iterator[tuple[int, int]]:
        """For each word: the state and the length of the longest stretch ending there that a template has."""
        state = size = 0
        for code in codes:
            while state and code not in self.step[state]:
                state = self.link[state]
                size = self.length[state]
            if code in self.step[state]:
                state, size = self.step[state][code], size + 1
            yield state, size


def _chain(matches: list[tuple[int, int]], max_gap: int) -> Iterator[tuple[int, int, int]]:
    """(first, end, words covered) of matches (first, end) that follow one another; the matches come in order of their ends."""
    first = end = words = None
    for a, b in matches:
        if first is None or a - end > max_gap:
            if first is not None:
                yield first, end, words
            first, end, words = a, b, b - a
        else:
            words += b - max(a, end)
            end = b
    if first is not None:
        yield first, end, words


def _scan(shared, min_words: int, min_share: float, max_gap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto: Automaton = shared.value
        lookup = auto.vocabulary.get
        # A template shorter than min_words counts when it stands whole.
        least = [min(min_words, n) for n in auto.sizes]
        shortest = min(auto.sizes)
        for batch in batches:
            counts, places, spans = [], [], []
            for _, run_of in slices(batch.column("text")):
                codes, starts = [], []
                for text in run_of:
                    starts.append(len(codes))
                    codes.extend([lookup(w, 0) for w in alnum_words(text)])
                    codes.append(0)
                starts.append(len(codes))
                known = np.concatenate(([0], np.array(codes, np.int32) != 0, [0])).astype(np.int8)
                edges = np.flatnonzero(np.diff(known))
                firsts, ends = edges[::2], edges[1::2]
                long = ends - firsts >= shortest
                firsts, ends = firsts[long], ends[long]
                owner = np.searchsorted(np.array(starts), firsts, side="right") - 1
                found: dict[int, dict[int, list]] = defaultdict(lambda: defaultdict(list))
                whole: dict[int, list[tuple[int, int]]] = defaultdict(list)
                for k, a, b in zip(owner.tolist(), firsts.tolist(), ends.tolist()):
                    a0, before = a - starts[k], None
                    for i, (state, size) in enumerate(auto.statistics(codes[a:b]), a0):
                        for number, n in auto.whole[state]:
                            if size >= n:
                                whole[k].append((number, i - n + 1))
                        if before and size <= before[1]:
                            for number in auto.members[before[0]]:
                                if number >= auto.phrases and before[1] >= least[number]:
                                    found[k][number].append((i - before[1], i))
                        before = (state, size) if size else None
                    if before:
                        for number in auto.members[before[0]]:
                            if number >= auto.phrases and before[1] >= least[number]:
                                found[k][number].append((b - starts[k] - before[1], b - starts[k]))
                for k in range(len(run_of)):
                    counts.append(starts[k + 1] - starts[k] - 1)
                    places.append([{"label": auto.labels[n], "word": w} for n, w in whole[k]] if k in whole else [])
                    own = []
                    for number, matches in found[k].items() if k in found else ():
                        for first, end, words in _chain(matches, max_gap):
                            share = min(1.0, words / auto.sizes[number])
                            if share >= min_share:
                                own.append({"label": auto.labels[number], "first": first, "end": end, "share": share})
                    spans.append(sorted(own, key=lambda s: (s["first"], s["end"], s["label"])))
            place = pa.struct([("label", pa.string()), ("word", pa.int64())])
            span = pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64()), ("share", pa.float64())])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(places, pa.list_(place)), pa.array(spans, pa.list_(span))],
                ["doc_id", "n_words", "places", "spans"],
            )

    return run


def scan(
    documents: DataFrame,
    phrases: dict[str, str] | None = None,
    templates: list[tuple[str, str]] | None = None,
    min_words: int = 6,
    min_share: float = 0.6,
    max_gap: int = 4,
) -> DataFrame:
    """Each document with n_words, places (label and word of each phrase) and spans (label, first, end, share of the template)."""
    auto = Automaton.of(PHRASES if phrases is None else phrases, TEMPLATES if templates is None else templates)
    kind = documents.schema["doc_id"].dataType.simpleString()
    source = documents.select("doc_id", F.col("text").cast("binary").alias("text"))
    return source.mapInArrow(
        _scan(documents.sparkSession.sparkContext.broadcast(auto), min_words, min_share, max_gap),
        f"doc_id {kind}, n_words bigint, places array<struct<label:string,word:bigint>>, spans {SPAN}",
    )


def digest(scanned: DataFrame) -> DataFrame:
    base, chained = F.col("places.label"), F.col("spans.label")
    return scanned.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places.word").alias("first_word"),
        F.array_max("places.word").alias("last_word"),
        F.concat_ws(",", F.array_sort(F.array_distinct(base))).alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.array_distinct(F.concat(base, chained)))).alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max("spans.share"), F.lit(0.0))).alias("score"),
    )
