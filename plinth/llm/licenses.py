"""License scan: MinHash bands over overlapping windows retrieve templates, exact shingle containment verifies them.

Templates longer than ``MAX_WINDOW`` shingles fall into overlapping parts. A text is scanned with windows of each part's
length that begin every quarter of it. Windows that hold fewer than half of the template shingles needed to verify any
part of their length are passed over without hashing. The others are given MinHash signatures; ``BANDS`` bands of
``ROWS`` coordinates retrieve a window of Jaccard similarity s with a part with probability
1 - (1 - s ** ROWS) ** BANDS, above 0.99 from s = 0.4 on (``collision_probability``); a template that stands in one
piece, a fifth of its shingles changed, has a window of 0.5 or so. A retrieved place is verified exactly: the share of
the template's distinct shingles around it must reach ``CONTAINMENT``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from plinth.llm.words import Words, mix, ranges, slices, tokenise

SHINGLE = 2
BANDS, ROWS = 28, 2
MAX_WINDOW = 32
CONTAINMENT = 0.8
_GOLD = np.uint64(0x9E3779B97F4A7C15)

#: (license, text): notices as they stand in files and the openings of license texts.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("proprietary", "All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form or by any means without the prior written permission of the publisher."),
)


def collision_probability(similarity: float, bands: int = BANDS, rows: int = ROWS) -> float:
    """Chance that two windows of this Jaccard similarity share a band."""
    return 1 - (1 - similarity**rows) ** bands


def word_shingles(words: Words, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The hash of the shingle that begins at each word, and whether it lies within its row."""
    hashes = words.hashes()
    n = len(hashes)
    whole = words.first[1:][words.row] - np.arange(n) >= width
    out = hashes.copy()
    for k in range(1, width):
        out *= _GOLD
        out[: n - k] += hashes[k:]
    return mix(out), whole


@lru_cache(maxsize=2)
def _seeds(count: int) -> tuple[np.ndarray, np.ndarray]:
    at = mix(np.arange(1, 2 * count + 1, dtype=np.uint64) * _GOLD)
    return (at[:count] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (at[count:] >> np.uint64(32)).astype(np.uint32)


class Index:
    """Templates, their parts by length, and the parts' band keys."""

    def __init__(self, templates: tuple[tuple[str, str], ...], bands: int = BANDS, rows: int = ROWS, shingle: int = SHINGLE) -> None:
        self.bands, self.rows, self.shingle = bands, rows, shingle
        self.sets: list[np.ndarray] = []
        self.length: list[int] = []
        parts: dict[int, list[tuple[int, np.ndarray]]] = {}
        for t, (_, text) in enumerate(templates):
            words = tokenise(pa.array([text]), signs=True, lower=True)
            if len(words.start) < shingle:
                raise ValueError(f"template {t} is shorter than a shingle")
            value, whole = word_shingles(words, shingle)
            value = value[whole]
            self.sets.append(np.unique(value))
            self.length.append(len(value))
            size = min(len(value), MAX_WINDOW)
            for s in sorted({*range(0, len(value) - size, size // 2), len(value) - size}):
                parts.setdefault(size, []).append((t, np.unique(value[s : s + size])))
        self.all = np.unique(np.concatenate(self.sets))
        self.may = np.zeros(1 << 16, bool)
        self.may[(self.all & np.uint64(0xFFFF)).astype(np.int64)] = True
        #: By window length: the fewest hits that can be verified, and sorted band keys with their templates.
        self.by_length: dict[int, tuple[int, np.ndarray, np.ndarray]] = {}
        for size, found in parts.items():
            keys = np.concatenate([self.keys(own, np.array([0]))[:, 0] for _, own in found])
            template = np.repeat([t for t, _ in found], bands)
            order = np.argsort(keys, kind="stable")
            least = min(int(np.ceil(CONTAINMENT * len(own))) for _, own in found)
            self.by_length[size] = max(1, least // 2), keys[order], template[order]

    def keys(self, shingles: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Band keys (bands, windows) of windows that lie one after another and begin at ``begin``."""
        a, b = _seeds(self.bands * self.rows)
        low = shingles.astype(np.uint32)
        out = np.empty((self.bands, len(begin)), np.uint64)
        for band in range(self.bands):
            key = np.full(len(begin), band, np.uint64)
            for k in range(band * self.rows, (band + 1) * self.rows):
                key = mix(key * _GOLD + np.minimum.reduceat(low * a[k] + b[k], begin))
            out[band] = key
        return out

    def member(self, shingles: np.ndarray) -> np.ndarray:
        out = self.may[(shingles & np.uint64(0xFFFF)).astype(np.int64)]
        some = np.flatnonzero(out)
        place = np.minimum(np.searchsorted(self.all, shingles[some]), len(self.all) - 1)
        out[some] = self.all[place] == shingles[some]
        return out


@lru_cache(maxsize=4)
def index(templates: tuple[tuple[str, str], ...]) -> Index:
    return Index(templates)


def _candidates(value: np.ndarray, hit: np.ndarray, words: Words, ix: Index) -> set[tuple[int, int, int]]:
    """(template, first word, row) of windows that share a band with a part of the template."""
    sums = np.concatenate([[0], np.cumsum(hit)])
    busy = np.flatnonzero(sums[words.first[1:]] > sums[words.first[:-1]])
    found: set[tuple[int, int, int]] = set()
    for size, (least, keys, template) in ix.by_length.items():
        stride = max(1, size // 4)
        count = np.maximum(words.first[busy + 1] - words.first[busy] - ix.shingle + 1, 0)
        number = -(-count // stride)
        row = np.repeat(busy, number)
        begin = words.first[row] + ranges(number) * stride
        end = np.minimum(begin + size, words.first[row + 1] - ix.shingle + 1)
        some = sums[end] - sums[begin] >= least
        row, begin, end = row[some], begin[some], end[some]
        if not len(begin):
            continue
        length = end - begin
        for a in range(0, len(begin), 65536):
            part = slice(a, a + 65536)
            flat = np.repeat(begin[part], length[part]) + ranges(length[part])
            key = ix.keys(value[flat], np.cumsum(length[part]) - length[part]).ravel()
            window = np.tile(np.arange(len(begin))[part], ix.bands)
            low, high = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
            times = high - low
            at, one = np.repeat(low, times) + ranges(times), np.repeat(window, times)
            found |= set(zip(template[at].tolist(), begin[one].tolist(), row[one].tolist(), strict=True))
    return found


def scan_batch(column: pa.Array, ix: Index) -> list[tuple[int, int, int, float]]:
    """(row, template, first word, containment) of the best place of each verified template in each row."""
    words = tokenise(column, signs=True, lower=True)
    if not len(words.start):
        return []
    value, whole = word_shingles(words, ix.shingle)
    hit = ix.member(value) & whole
    best: dict[tuple[int, int], tuple[float, int]] = {}
    for t, begin, row in _candidates(value, hit, words, ix):
        reach = ix.length[t]
        low, high = max(words.first[row], begin - reach), min(words.first[row + 1] - ix.shingle + 1, begin + 2 * reach)
        inside = np.flatnonzero(np.isin(value[low:high], ix.sets[t]))
        share = len(np.unique(value[low:high][inside])) / len(ix.sets[t])
        if share >= CONTAINMENT:
            first = int(low + inside[0] - words.first[row])
            old = best.get((row, t))
            if old is None or (-share, first) < (-old[0], old[1]):
                best[row, t] = share, first
    return [(r, t, first, share) for (r, t), (share, first) in sorted(best.items())]


def _scan(batches: Iterator[pa.RecordBatch], templates: tuple[tuple[str, str], ...]) -> Iterator[pa.RecordBatch]:
    ix = index(templates)
    for batch in slices(batches, "text"):
        found = scan_batch(batch.column("text"), ix)
        if found:
            row, template, first, share = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row)), pa.array([templates[t][0] for t in template]), pa.array(template, pa.int32()), pa.array(first, pa.int32()), pa.array(share, pa.float64())],
                names=["doc_id", "license", "template", "first_word", "containment"],
            )


def license_scan(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, license, template, first_word, containment): the templates that a document holds, each at its best place.

    Words are runs of letters and digits, ASCII case folded; ``first_word`` counts from 0. Of equally good places the
    first is given. Null and empty texts hold nothing; equal rows are scanned and reported each; an empty table gives an
    empty result; other columns are ignored. No shuffle: the templates go with the task.
    """
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text")).mapInArrow(
        partial(_scan, templates=tuple(templates)), "doc_id long, license string, template int, first_word int, containment double"
    )
