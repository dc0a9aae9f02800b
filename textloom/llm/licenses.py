"""License notices in whole texts: an exact set-similarity join of text blocks with templates.

A template stands for the set of its words. For a template of w words, blocks are 2s words long
and start every s words, s being the power of two not below w, so each run of s words lies whole
in a block. A block matches where it contains at least THRESHOLD of the template's words.

Words are ordered by the number of rows they occur in, counted over the whole table, rarest first.
A block that contains enough of a template of m words, a = ceil(THRESHOLD * m) of them, has one of
the template's m - a + 1 rarest words (prefix), holds at least a words that any template knows
(length), and behind the first word they share both have enough words left (position). What passes
is verified by counting. So texts without any rare template word, nearly all, are left at once, no
match is missed and nothing is shuffled but the word counts. Templates are sent to the tasks in
passes of at most PASS, so any number of them can be scanned for.

Beside the templates, short phrases are found word for word.

Defined cases: null and empty texts have no words. Bytes that are not valid UTF-8 count as parts of
words. Long texts are scanned whole, block by block. Rows that repeat are rows of their own. An
empty table gives an empty result; an empty template is refused. Other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import add_columns

THRESHOLD = Fraction(4, 5)
#: Templates sent to the tasks at once.
PASS = 2000

# -- fixed values --------------------------------------------------------------
#: Phrases found word for word, with their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
#: Public license notices, as their licenses ask them to be put into works.
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     "associated documentation files (the Software), to deal in the Software without restriction, including without "
     "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
     "Software, and to permit persons to whom the Software is furnished to do so"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
     "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
     "distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the "
     "License for the specific language governing permissions and limitations under the License"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
     "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
     "any later version"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
     "General Public License as published by the Free Software Foundation"),
    ("agpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
     "General Public License as published by the Free Software Foundation"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
     "that the following conditions are met: Redistributions of source code must retain the above copyright notice, this "
     "list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright "
     "notice, this list of conditions and the following disclaimer in the documentation"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
     "hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
     "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/"),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, "
     "modify, publish, use, compile, sell, or distribute this software"),
    ("zlib", "This software is provided as-is, without any express or implied warranty. In no event will the authors be "
     "held liable for any damages arising from the use of this software. Permission is granted to anyone to use this "
     "software for any purpose, including commercial applications, and to alter it and redistribute it freely"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
     "this work. CC0 1.0 Universal"),
    ("reserved", "All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any "
     "form or by any means without the prior written permission of the publisher"),
)
# -- end of fixed values -------------------------------------------------------

#: Bytes of words: digits, a-z and all beyond ASCII stay, A-Z are lower-cased, all others separate.
_FOLD = bytes(
    b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_FOLD).split()


def stride(n_words: int) -> int:
    """Words from the start of one block to the next, for templates of `n_words`."""
    return 1 << (n_words - 1).bit_length()


def needed(n_distinct: int) -> int:
    return math.ceil(THRESHOLD * n_distinct)


def rows_with_words(docs: DataFrame, text: str, vocabulary: set[bytes]) -> dict[bytes, int]:
    """How many rows each word of a vocabulary is in; the result has at most as many entries as that."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()
        for batch in batches:
            for value in batch.column(0):
                found.update(vocabulary.intersection(words_of(value.as_py())))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], ["word", "n"]
        )

    counts = docs.select(F.col(text).cast("binary").alias("text")).mapInArrow(count, "word binary, n long")
    return {bytes(r.word): r.n for r in counts.groupBy("word").agg(F.sum("n").alias("n")).collect()}


class Templates:
    """Templates as word numbers in the global order, with an index of their prefixes."""

    def __init__(self, templates: list[tuple[str, str]], frequency: dict[bytes, int]):
        split = [(label, words_of(text.encode())) for label, text in templates]
        if not all(words for _, words in split):
            raise ValueError("a template needs a word")
        every = {w for _, words in split for w in words}
        self.number = {w: i for i, w in enumerate(sorted(every, key=lambda w: (frequency.get(w, 0), w)))}
        self.labels = [label for label, _ in split]
        self.ranked = [sorted({self.number[w] for w in words}) for _, words in split]
        self.least = [needed(len(r)) for r in self.ranked]
        self.sets = [frozenset(r) for r in self.ranked]
        #: stride -> word number -> (template, place in the template's order)
        self.index: dict[int, dict[int, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
        #: stride -> the fewest words of templates that a block must hold to match any
        self.shortest: dict[int, int] = {}
        for t, (_, words) in enumerate(split):
            s = stride(len(words))
            self.shortest[s] = min(self.shortest.get(s, self.least[t]), self.least[t])
            for place, word in enumerate(self.ranked[t][: len(self.ranked[t]) - self.least[t] + 1]):
                self.index[s][word].append((t, place))
        self.index = {s: dict(found) for s, found in self.index.items()}
        rare = {word for found in self.index.values() for word in found}
        self.rare = frozenset(w for w, i in self.number.items() if i in rare)

    def blocks(self, words: list[bytes]) -> list[tuple[int, int, int, int]]:
        """(template, shared words, first word, last word) of every match, in order of stride, block and template."""
        if self.rare.isdisjoint(words):
            return []
        known = [(i, self.number[w]) for i, w in enumerate(words) if w in self.number]
        out = []
        for s, index in sorted(self.index.items()):
            held: dict[int, set[int]] = defaultdict(set)
            for at, word in known:
                held[at // s].add(word)
                if at >= s:
                    held[at // s - 1].add(word)
            for block in sorted(held):
                if len(held[block]) < self.shortest[s]:
                    continue
                for t in self._matches(held[block], index):
                    shared = len(held[block] & self.sets[t])
                    out.append((t, shared, block * s, min(block * s + 2 * s, len(words)) - 1))
        return out

    def _matches(self, held: set[int], index: dict[int, list[tuple[int, int]]]) -> list[int]:
        seen, found = set(), []
        ordered = sorted(held)
        for j, word in enumerate(ordered):
            for t, i in index.get(word, ()):
                if t in seen:
                    continue
                seen.add(t)
                # this is the first word that template and block share
                least = self.least[t]
                if 1 + min(len(self.ranked[t]) - i - 1, len(ordered) - j - 1) < least:
                    continue
                if len(held & self.sets[t]) >= least:
                    found.append(t)
        return sorted(found)


def phrase_places(words: list[bytes], phrase: list[bytes]) -> list[int]:
    """Places (of words) where the phrase stands, overlapping ones too."""
    joined, wanted = b" " + b" ".join(words) + b" ", b" " + b" ".join(phrase) + b" "
    out, at, seen, place = [], joined.find(wanted), 0, 0
    while at >= 0:
        place += joined.count(b" ", seen, at)
        seen = at
        out.append(place)
        at = joined.find(wanted, at + 1)
    return out


def scan(
    docs: DataFrame,
    keep: list[str],
    text: str = "text",
    templates: list[tuple[str, str]] = list(TEMPLATES),
    phrases: list[tuple[str, str]] = list(PHRASES),
) -> DataFrame:
    """`keep` with `n_words`, `phrases` (label, start) and `blocks` (label, containment, first, last)."""
    phrase_words = [(label, words_of(p.encode())) for p, label in phrases]

    def make_phrases() -> Callable[..., list[tuple]]:
        # a text without a phrase's longest word has no place to look at
        marks = [max(words, key=len) for _, words in phrase_words]

        def find(texts: list[bytes | None]) -> list[tuple]:
            rows = []
            for value in texts:
                words = words_of(value)
                held = set(words)
                rows.append((len(words), [
                    (label, at) for (label, phrase), mark in zip(phrase_words, marks) if mark in held
                    for at in phrase_places(words, phrase)
                ], []))
            return rows

        return find

    block = "array<struct<label:string,containment:double,first:long,last:long>>"
    raw = F.col(text).cast("binary")
    found = add_columns(
        docs, [raw], [*[F.col(c) for c in keep], raw.alias("__bytes")],
        f"n_words long, phrases array<struct<label:string,start:long>>, blocks {block}", make_phrases,
    )
    frequency = rows_with_words(docs, text, {w for _, t in templates for w in words_of(t.encode())}) if templates else {}
    for at in range(0, len(templates), PASS):
        some = docs.sparkSession.sparkContext.broadcast(Templates(templates[at : at + PASS], frequency))

        def make_blocks(some=some) -> Callable[..., list[tuple]]:
            def find(texts: list[bytes | None]) -> list[tuple]:
                t = some.value
                return [
                    ([(t.labels[i], n / len(t.ranked[i]), a, b) for i, n, a, b in t.blocks(words_of(value))],)
                    for value in texts
                ]

            return find

        kept = [*keep, "__bytes", "n_words", "phrases"]
        more = add_columns(
            found, [F.col("__bytes")], [*[F.col(c) for c in kept], F.col("blocks").alias("__blocks")],
            f"more {block}", make_blocks,
        )
        found = more.select(*kept, F.concat("__blocks", "more").alias("blocks"))
    return found.drop("__bytes")


def licensed(
    docs: DataFrame,
    keep: list[str],
    text: str = "text",
    templates: list[tuple[str, str]] = list(TEMPLATES),
    phrases: list[tuple[str, str]] = list(PHRASES),
) -> DataFrame:
    """`keep` with counts, `first_word`, `last_word`, `base_labels`, `labels` and `score`.

    The score is 1 where a phrase stands, else the largest containment of a matching block, else 0.
    """
    found = scan(docs, keep, text, templates, phrases)
    starts, labels = F.col("phrases.start"), F.col("phrases.label")
    listed = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    return found.select(
        *keep,
        "n_words",
        F.size("phrases").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        listed(labels).alias("base_labels"),
        listed(F.concat(labels, F.col("blocks.label"))).alias("labels"),
        F.when(F.size("phrases") > 0, 1.0).otherwise(F.coalesce(F.array_max("blocks.containment"), F.lit(0.0))).alias("score"),
    )
