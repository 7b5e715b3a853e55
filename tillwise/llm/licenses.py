"""License scans: MinHash bands over overlapping windows retrieve templates, exact shingle
containment verifies them.

A text's word shingles are cut into blocks; each two neighbouring blocks are a window, so every run
of up to a block's length lies whole in some window. Templates are cut into segments of one block.
A window retrieves a template when a band (a MinHash value of both) agrees. A window holds at most
two blocks of shingles, so one that holds a whole segment of m shingles agrees in a band with
probability m / (2 BLOCK) at least: ``collision_probability`` gives what the bands make of that.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import SLICE_ROWS

SHINGLE_WORDS = 5
#: Shingles in a block; windows are two blocks and overlap by one.
BLOCK = 8
#: Bands of one MinHash value each.
BANDS = 160
CONTAINMENT = 0.8
WORD = re.compile(r"\w+")
#: Bytes after which a task starts its table of words anew, by estimate, and those of an entry beside its word.
MEMO_BYTES, ENTRY_BYTES = 32 << 20, 150

#: License notices as they are printed.
TEMPLATES = {
    "mit-notice": "Released under the MIT License",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0",
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be "
        "included in all copies or substantial portions of the Software."
    ),
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied."
    ),
    "gpl-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version. This program is distributed in the hope that it will be useful, "
        "but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        "PARTICULAR PURPOSE."
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer."
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "mit-warranty": (
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
        "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER "
        "IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR "
        "THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "bsd-binary": (
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution."
    ),
    "bsd-3-clause": (
        "may be used to endorse or promote products derived from this software without specific prior written permission."
    ),
    "bsd-warranty": (
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED."
    ),
    "isc-warranty": (
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."
    ),
    "zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
        "held liable for any damages arising from the use of this software. Permission is granted to anyone to use "
        "this software for any purpose, including commercial applications, and to alter it and redistribute it "
        "freely, subject to the following restrictions:"
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
        "binary, for any purpose, commercial or non-commercial, and by any means."
    ),
    "bsl-1.0": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software "
        "and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, "
        "distribute, execute, and transmit the Software, and to prepare derivative works of the Software"
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "gpl-2.0": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version."
    ),
    "lgpl-2.1": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
        "(at your option) any later version."
    ),
    "lgpl-3.0": (
        "it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version."
    ),
    "agpl-3.0": (
        "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version."
    ),
    "epl-2.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"
    ),
    "cc0-1.0": (
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring "
        "rights to this software to the public domain worldwide. This software is distributed without any warranty."
    ),
    "cc-by-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-sa-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
}


def collision_probability(similarity: float, bands: int = BANDS, rows: int = 1) -> float:
    """Chance that sets of this Jaccard likeness agree in at least one band."""
    return 1 - (1 - similarity**rows) ** bands


_RANDOM = np.random.default_rng(7)
#: Multipliers (odd) and offsets of the hash of each band.
MULTIPLIERS = _RANDOM.integers(0, 2**63, BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
OFFSETS = _RANDOM.integers(0, 2**63, BANDS, dtype=np.uint64)


def shingle_hashes(hashes: np.ndarray, words: int = SHINGLE_WORDS) -> np.ndarray:
    """Hashes of the runs of ``words`` words; of the whole sequence if it is shorter."""
    if not len(hashes):
        return hashes
    span = min(words, len(hashes))
    total = np.zeros(len(hashes) - span + 1, dtype=np.uint64)
    for i in range(span):
        total = total * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + len(total)]
    return total ^ (total >> np.uint64(29))


def minhashes(shingles: np.ndarray, size: int) -> np.ndarray:
    """MinHash values (bands x blocks) of the blocks of ``size`` shingles."""
    starts = np.arange(0, len(shingles), size)
    out = np.empty((BANDS, len(starts)), dtype=np.uint64)
    for band in range(BANDS):
        out[band] = np.minimum.reduceat(shingles * MULTIPLIERS[band] + OFFSETS[band], starts)
    return out


class Scanner:
    """Templates indexed by band, and the scan of one text."""

    def __init__(self, templates: dict[str, str], containment: float = CONTAINMENT) -> None:
        self.containment = containment
        self.memo: dict[str, int] = {}
        self.held = 0
        self.names: list[str] = []
        self.sets: list[np.ndarray] = []
        self.lengths: list[int] = []
        values: list[list[np.ndarray]] = []
        owners: list[int] = []
        for name, text in sorted(templates.items()):
            shingles = shingle_hashes(self.hashes(text))
            if not len(shingles):
                continue
            owner = len(self.names)
            self.names.append(name)
            self.sets.append(np.unique(shingles))
            self.lengths.append(len(shingles))
            segments = minhashes(shingles, BLOCK)
            values.append(segments)
            owners += [owner] * segments.shape[1]
        self.owners = np.array(owners, dtype=np.int64)
        table = np.hstack(values) if values else np.empty((BANDS, 0), dtype=np.uint64)
        self.order = table.argsort(axis=1)
        self.sorted = np.take_along_axis(table, self.order, axis=1)

    def hashes(self, text: str | None) -> np.ndarray:
        """Word hashes of ``text``."""
        words = WORD.findall((text or "").lower())
        if self.held > MEMO_BYTES:
            self.memo, self.held = {}, 0
        memo = self.memo
        for word in set(words):
            if word not in memo:
                self.held += 4 * len(word) + ENTRY_BYTES
                memo[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return np.fromiter(map(memo.__getitem__, words), dtype=np.uint64, count=len(words))

    def candidates(self, shingles: list[np.ndarray]) -> dict[int, list[tuple[int, int]]]:
        """text -> (template, block) such that the window from the block on agrees with the template
        in a band. Texts are hashed together; no window crosses from one into another."""
        found: dict[int, list[tuple[int, int]]] = {}
        sizes = np.array([len(x) for x in shingles], dtype=np.int64)
        if not self.sorted.shape[1] or not sizes.sum():
            return found
        together = np.concatenate(shingles)
        counts = -(-sizes // BLOCK)
        text_of = np.repeat(np.arange(len(sizes)), counts)
        block_of = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        starts = np.repeat(np.cumsum(sizes) - sizes, counts) + block_of * BLOCK
        after = np.flatnonzero(text_of[1:] == text_of[:-1])  # blocks with a neighbour in their text
        seen = set()
        for band in range(BANDS):
            blocks = np.minimum.reduceat(together * MULTIPLIERS[band] + OFFSETS[band], starts)
            windows = blocks.copy()
            windows[after] = np.minimum(blocks[after], blocks[after + 1])
            row = self.sorted[band]
            place = np.searchsorted(row, windows)
            for w in np.flatnonzero(row[np.minimum(place, len(row) - 1)] == windows).tolist():
                p = int(place[w])
                while p < len(row) and row[p] == windows[w]:
                    seen.add((int(text_of[w]), int(self.owners[self.order[band, p]]), int(block_of[w])))
                    p += 1
        for text, owner, block in sorted(seen):
            found.setdefault(text, []).append((owner, block))
        return found

    def scan(self, texts: list[str | None]) -> list[list[tuple[str, float, int]]]:
        """(template, containment, start) of each template that each text holds, where it is fullest."""
        shingles = [shingle_hashes(self.hashes(text)) for text in texts]
        out: list[list[tuple[str, float, int]]] = [[] for _ in texts]
        for at, windows in self.candidates(shingles).items():
            best: dict[int, tuple[float, int]] = {}
            for owner, block in windows:
                length = self.lengths[owner]
                low = max(0, block * BLOCK - length)
                region = shingles[at][low : block * BLOCK + 2 * BLOCK + length]
                inside = np.isin(region, self.sets[owner])
                share = len(np.unique(region[inside])) / len(self.sets[owner])
                if share >= self.containment and share > best.get(owner, (0.0, 0))[0]:
                    best[owner] = (share, low + int(inside.argmax()))
            if best:
                starts = [m.start() for m in WORD.finditer((texts[at] or "").lower())]
                out[at] = [(self.names[o], share, starts[word]) for o, (share, word) in sorted(best.items())]
        return out


def scan_documents(docs: DataFrame, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """(doc_id, license, containment, start), one row per row of ``docs`` and template it holds.

    A text holds a template if some stretch of it contains at least 0.8 of the template's distinct
    5-word shingles (words are lower-cased runs of letters, digits and underscores). A stretch is a window of
    two blocks with the template's length in words before and after it; the fullest one, of equals the
    first, gives the row, so a template that a text holds twice is one row. ``start`` is the place, in
    code points of the lower-cased text, of the first such shingle there. Null and empty texts hold
    nothing; repeated rows give their rows again; other columns are ignored.
    """

    def run(batches):
        scanner = Scanner(templates)
        for batch in batches:
            for begin in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(begin, SLICE_ROWS)
                found = scanner.scan(part.column(1).to_pylist())
                rows = [(i, *hit) for i, hits in zip(part.column(0).to_pylist(), found, strict=True) for hit in hits]
                if rows:
                    kinds = (pa.int64(), pa.string(), pa.float64(), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(c), type=t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)],
                        names=["doc_id", "license", "containment", "start"],
                    )

    return docs.select("doc_id", F.col("text")).mapInArrow(
        run, "doc_id bigint, license string, containment double, start bigint"
    )
