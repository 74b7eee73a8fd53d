"""License scan: MinHash bands over overlapping text windows retrieve templates, exact shingle containment verifies them.

A template of at most L words (L a power of two, and more than half of it used) lies whole inside one of the windows of 2 L
words that begin every L words. Its shingles are then at least about a fifth of the window's, so with BANDS bands of one
minimum each the two collide in some band with a probability of at least 1 - (1 - J) ** BANDS, over 0.999999. The minima of
long windows are minima of those of short blocks, so every word is hashed once for all lengths. Retrieved pairs are
verified: the share of the template's shingles that stand in the window must reach ``contain``.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, only, text_or_empty
from .minhash import ADD, MULTIPLY, WordHashes, mix

SHINGLE, BANDS, SHORT = 3, 64, 8
#: Most words of all templates together: they are broadcast.
MOST_WORDS = 500_000
WORD = re.compile(r"\w+")
HASHES = WordHashes()

# fixed values: standard notices
NOTICES = {
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "MIT notice": "Released under the MIT License.",
    "MIT permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "BSD conditions": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "MPL-2.0 header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0 notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0 notice": "Licensed under CC BY-SA 4.0.",
    "CC0 notice": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
}


def shingles(words: list[str]) -> np.ndarray:
    """Hash of the SHINGLE words from each place on; of a shorter list, of all its words."""
    k = min(SHINGLE, len(words))
    h = np.fromiter(map(HASHES.__getitem__, words), np.uint64, len(words))
    out = np.full(len(words) - k + 1 if words else 0, k, np.uint64)
    for i in range(k):
        out = mix(out * np.uint64(0xD1B54A32D192ED03) + h[i : i + len(out)])
    return out


def minima(found: np.ndarray) -> np.ndarray:
    """(blocks, BANDS) minima over blocks of SHORT shingles."""
    part = (found >> np.uint64(32)).astype(np.uint32)
    out = []
    for at in range(0, len(part), SHORT * 512):
        piece = part[at : at + SHORT * 512]
        values = piece * MULTIPLY[:BANDS] + ADD[:BANDS]
        out.append(np.minimum.reduceat(values, np.arange(0, len(piece), SHORT), axis=1).T)
    return np.concatenate(out)


class Templates:
    """Compiled notices: their shingle sets and minima, by the number of words that their windows step."""

    def __init__(self, notices: Mapping[str, str]):
        self.by_step: dict[int, list[tuple[str, np.ndarray, np.ndarray]]] = {}
        for name, text in notices.items():
            words = WORD.findall(text.lower())
            if len(words) < SHINGLE:
                raise ValueError(f"template {name!r} has fewer than {SHINGLE} words")
            step = max(SHORT, 1 << (len(words) - 1).bit_length())
            found = np.unique(shingles(words))
            self.by_step.setdefault(step, []).append((name, found, minima(found).min(axis=0)))

    def search(self, text: str, contain: float) -> list[tuple[str, int, int, float]]:
        """(name, start, end, share of the template found), one for each group of overlapping windows with the same template."""
        words = WORD.findall(text.lower())
        if len(words) < SHINGLE:
            return []
        found = shingles(words)
        blocks, width, hits = minima(found), SHORT, []
        for step in sorted(self.by_step):
            while width < step:
                blocks = np.minimum(blocks[::2], np.vstack([blocks[1::2], blocks[-1:]])[: len(blocks[::2])])
                width *= 2
            windows = np.minimum(blocks, np.vstack([blocks[1:], blocks[-1:]]))
            for name, own, least in self.by_step[step]:
                for w in np.flatnonzero((windows == least).any(axis=1)).tolist():
                    at = w * step
                    inside = np.flatnonzero(np.isin(found[at : at + 2 * step], own)) + at
                    share = len(np.unique(found[inside])) / len(own)
                    if share >= contain:
                        hits.append((name, int(inside[0]), int(inside[-1]) + SHINGLE, share))
        if not hits:
            return []
        spots = [m.span() for m in WORD.finditer(text.lower())]
        if len(text.lower()) != len(text):  # a letter whose lower case is longer: places come from the text as it is
            spots = [m.span() for m in WORD.finditer(text)]
            if len(spots) != len(words):
                spots = [(0, len(text))] * len(words)
        merged: list[list] = []
        for name, a, b, share in sorted(hits):
            if merged and merged[-1][0] == name and a < merged[-1][2]:
                merged[-1][2:] = [max(b, merged[-1][2]), max(share, merged[-1][3])]
            else:
                merged.append([name, a, b, share])
        return [(name, spots[a][0], spots[min(b, len(spots)) - 1][1], share) for name, a, b, share in merged]


def scan(docs: DataFrame, notices: Mapping[str, str] = NOTICES, contain: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, matches), one row per input row: array of (license, start, end, share) in code points, by license and place.

    Null, empty and very short texts have no matches; a template without words is an error; equal templates under two names
    both match. Ids may be null or repeat; other columns are not read. Templates of over MOST_WORDS words together are
    refused, as they are sent to every task.
    """
    if sum(len(WORD.findall(t)) for t in notices.values()) > MOST_WORDS:
        raise ValueError(f"the templates have over {MOST_WORDS} words")
    shipped = docs.sparkSession.sparkContext.broadcast(dict(notices))
    made: list[Templates] = []
    match = pa.struct([("license", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("share", pa.float64())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        only("licenses", HASHES.clear)
        if not made:
            made.append(Templates(shipped.value))
        hits = [[dict(zip(("license", "start", "end", "share"), h)) for h in made[0].search(x.as_py(), contain)] for x in batch.column(1)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(hits, pa.list_(match))], ["id", "matches"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = map_rows(docs.select(F.col(id_col), text_or_empty(text_col)), run, f"id {kind}, matches array<struct<license:string,start:int,end:int,share:double>>")
    return out.withColumnRenamed("id", id_col)
