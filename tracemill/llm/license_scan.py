"""License scans: MinHash bands retrieve templates, exact shingle containment confirms them.

Texts and templates are folded to words of ASCII letters and digits in lower case. A template of n words is looked for in
overlapping windows whose lengths are those of the templates (rounded up to powers of two): windows start every quarter of
their length. A window's signature is cut into bands; a template and a window that share a band meet. Templates longer than
SHORT words are cut into passages of at most that many first, so every window has about its passage's length.

A window has five quarters of the length that is looked for and one starts every quarter, so one holds the whole passage. A
passage has over half of that length: with 3-word shingles its similarity to the window is at least 0.4 when it is verbatim
(5 words: 3 of 7 shingles, 9 words: 7 of 17), and at least 0.31 when 0.8 of its shingles are there. With 40 bands of one row
each the probability of a miss is then below 0.6 ** 40 = 1e-9 and 0.69 ** 40 = 4e-7; more rows a band would cost recall that
nothing buys back, as templates are few. Whatever the bands
retrieve is confirmed by the share of the passage's shingles that the window holds (CONTAINED), and a template counts when its
passages do. Passages with fewer words than one shingle are found by their words alone.

Defined results: null and empty texts have no license; whole texts are scanned, however long; matches of a template are counted
once per stretch of windows that confirm it; other columns are left alone; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracemill.session import ship

SHINGLE = 3
BANDS = 40
SHORT = 64
CONTAINED = 0.8
_WORDS = re.compile(rb"[a-z0-9]+(?:\.[0-9]+)?").findall
_MIX = np.uint64(0x9E3779B97F4A7C15)
_FACTORS = np.random.default_rng(7).integers(1, 2**63, BANDS, dtype=np.uint64) | np.uint64(1)

#: Notices by which works are put under a license. Public wording, each an independent template.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the MIT License",
        "Permission is hereby granted, free of charge, "
        "to any person obtaining a copy of this software "
        "and associated documentation files (the Software), "
        "to deal in the Software without restriction, "
        "including without limitation the rights "
        "to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "GPL-2.0": ("it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version.",),
    "LGPL": ("under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",),
    "AGPL-3.0": ("under the terms of the GNU Affero General Public License as published by the Free Software Foundation",),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "licensed under a Creative Commons Attribution 4.0 International License"),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    "BSD": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "ISC": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
    "proprietary": ("All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form or by any means",),
}


def fold(text: str) -> list[bytes]:
    return _WORDS(text.encode().lower())


def shingles(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of all windows of SHINGLE words, in order; of all words when there are fewer."""
    n = len(words)
    if n == 0:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    return roll(hashes)


def roll(hashes: np.ndarray) -> np.ndarray:
    size = min(SHINGLE, len(hashes))
    count = len(hashes) - size + 1
    out = np.full(count, np.uint64(size), np.uint64)
    for i in range(size):
        out = (out ^ hashes[i : i + count]) * _MIX
        out ^= out >> np.uint64(29)
    return out


class Passage:
    def __init__(self, name: str, template: int, part: int, parts: int, words: list[bytes]):
        self.name, self.template, self.part, self.parts, self.words = name, template, part, parts, words
        self.shingles = np.unique(shingles(words))
        self.window = 1 << max(2, (len(words) - 1).bit_length())


class Templates:
    """The templates' passages, and for each window length their bands."""

    def __init__(self, templates: dict[str, tuple[str, ...]] | None = None):
        self.passages: list[Passage] = []
        number = 0
        for name, bodies in (TEMPLATES if templates is None else templates).items():
            for body in bodies:
                words = fold(body)
                parts = [words[i : i + SHORT] for i in range(0, len(words), SHORT)]
                if len(parts) > 1 and len(parts[-1]) < SHORT // 4:
                    parts[-2:] = [parts[-2] + parts[-1]]
                self.passages += [Passage(name, number, i, len(parts), p) for i, p in enumerate(parts)]
                number += 1
        self.bands: dict[int, dict[tuple[int, int], list[int]]] = defaultdict(lambda: defaultdict(list))
        for i, p in enumerate(self.passages):
            if len(p.shingles):
                for band, value in enumerate((p.shingles[:, None] * _FACTORS).min(0).tolist()):
                    self.bands[p.window][band, value].append(i)
        self.values = {w: [np.array(sorted(v for b, v in table if b == band), np.uint64) for band in range(BANDS)] for w, table in self.bands.items()}
        self.known = np.unique(np.concatenate([p.shingles for p in self.passages]))

    def matches(self, text: str) -> list[tuple[str, int, float, int, int]]:
        """(license, template, containment, first word, last word exclusive), each stretch once."""
        found = shingles(fold(text))
        n = len(found)
        if n == 0:
            return []
        # a band's least value can only be a template's where a shingle is: windows without any known shingle share no band
        where = np.flatnonzero(np.isin(found, self.known))
        if not len(where):
            return []
        hits: dict[int, list[tuple[int, int, float]]] = defaultdict(list)
        for width, table in self.bands.items():
            step = max(1, width // 4)
            length = max(1, width + step - SHINGLE)
            starts = np.unique(np.clip(((where[:, None] // step - np.arange(length // step + 1)) * step), 0, None))
            for start in starts.tolist():
                window = found[start : start + length]
                least = (window[:, None] * _FACTORS).min(0)
                retrieved = {i for band, value in enumerate(least.tolist()) if (band, value) in table for i in table[band, value]}
                if not retrieved:
                    continue
                inside = np.unique(window)
                for i in retrieved:
                    passage = self.passages[i]
                    share = float(np.isin(passage.shingles, inside).mean())
                    if share >= CONTAINED:
                        own = np.flatnonzero(np.isin(window, passage.shingles))
                        hits[i].append((start + int(own[0]), start + int(own[-1]) + SHINGLE, share))
        return self._whole(hits)

    def _whole(self, hits: dict[int, list[tuple[int, int, float]]]) -> list[tuple[str, int, float, int, int]]:
        by_template: dict[int, dict[int, list]] = defaultdict(dict)
        for i, spans in hits.items():
            merged: list[list] = []
            for start, end, share in sorted(spans):
                if merged and start < merged[-1][1]:
                    merged[-1][1], merged[-1][2] = max(end, merged[-1][1]), max(share, merged[-1][2])
                else:
                    merged.append([start, end, share])
            p = self.passages[i]
            by_template[p.template][p.part] = [p, merged]
        out = []
        for template, parts in by_template.items():
            first = next(iter(parts.values()))[0]
            if len(parts) * 2 <= first.parts:  # a long template counts when most of its passages are there
                continue
            if first.parts == 1:
                out += [(first.name, template, share, start, end) for start, end, share in parts[0][1]]
            else:
                spans = [s for _, merged in parts.values() for s in merged]
                out.append((first.name, template, float(np.mean([max(s[2] for s in merged) for _, merged in parts.values()])), min(s[0] for s in spans), max(s[1] for s in spans)))
        return sorted(out, key=lambda m: (m[3], m[1]))


_templates: list[Templates] = []


def own_templates() -> Templates:
    if not _templates:
        _templates.append(Templates())
    return _templates[0]


def scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per document: doc_id, n_matches, licenses (sorted distinct names), matches (license, template, containment, word span)."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = own_templates()
        kind = pa.list_(pa.struct([("license", pa.string()), ("template", pa.int32()), ("containment", pa.float64()), ("first_word", pa.int64()), ("end_word", pa.int64())]))
        for batch in batches:
            rows = [templates.matches(v.as_py() or "") for v in batch.column(1)]
            matches = [[dict(zip(("license", "template", "containment", "first_word", "end_word"), m, strict=True)) for m in r] for r in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(r) for r in rows], pa.int64()), pa.array([sorted({m[0] for m in r}) for r in rows], pa.list_(pa.string())), pa.array(matches, kind)],
                ["doc_id", "n_matches", "licenses", "matches"],
            )

    rows = docs.select(docs[doc_id].cast("bigint").alias("doc_id"), F.coalesce(docs[text], F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n_matches bigint, licenses array<string>, matches array<struct<license:string,template:int,containment:double,first_word:bigint,end_word:bigint>>")
