"""License scans: MinHash bands over overlapping text windows retrieve templates, exact
shingle containment verifies them.

Templates are put in classes of similar length.  A class lays windows a little longer
than its templates over the text, so near that every occurrence lies whole in one of
them.  A window and a template share a band with probability ``1 - (1 - J) ** bands``
or more, where J is the smallest Jaccard similarity that an occurrence above the
containment threshold can have; the number of bands is set so that this misses at most
``MISS``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .shared import with_defaults
from .textbytes import LOWER, Rolling, buffers, chunks, mix, word_spans

#: (license, kind, notice) of well-known public licenses.
TEMPLATES = (
    ("MIT", "permissive", "Released under the MIT License."),
    ("MIT", "permissive", "Licensed under the MIT License."),
    ("MIT", "permissive", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("Apache-2.0", "permissive", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "permissive", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-3-Clause", "permissive", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("ISC", "permissive", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("MPL-2.0", "weak copyleft", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("LGPL-3.0", "weak copyleft", "licensed under the GNU Lesser General Public License, version 3."),
    ("GPL-2.0", "copyleft", "licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "copyleft", "licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "copyleft", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("AGPL-3.0", "copyleft", "licensed under the GNU Affero General Public License, version 3."),
    ("CC-BY-4.0", "attribution", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "share alike", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "non-commercial", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "no derivatives", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "non-commercial", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0", "non-commercial", "Licensed under CC BY-NC-ND 4.0."),
    ("CC0-1.0", "public domain", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
)
SHINGLE_WORDS = 3
CONTAINMENT = 0.8
#: Largest probability that bands miss a window with an occurrence.
MISS = 1e-4


def bands_needed(jaccard: float, miss: float = MISS) -> int:
    """Bands of one MinHash row so that a pair this similar is missed with at most ``miss``."""
    return 1 if jaccard >= 1 else ceil(log(miss) / log(1 - jaccard))


@dataclass
class Window:
    """A class of templates: windows of ``width`` shingles every ``stride``, ``bands`` bands."""

    width: int
    stride: int
    bands: int
    members: list[int]


class Templates:
    """Shingle sets of all templates, their classes and their bands."""

    def __init__(self, templates=TEMPLATES, words: int = SHINGLE_WORDS, containment: float = CONTAINMENT, miss: float = MISS):
        self.words, self.containment = words, containment
        self.names = [(t[0], t[1]) for t in templates]
        self.sets = [frozenset(x for x, _, _ in self._shingles(t[2])) for t in templates]
        short = [t for t, s in zip(templates, self.sets, strict=True) if not s]
        if short:
            raise ValueError(f"templates need {words} words: {short}")
        spans = [len(self._shingles(t[2])) for t in templates]
        self.classes: list[Window] = []
        for k in sorted(range(len(templates)), key=lambda k: spans[k]):
            last = self.classes[-1] if self.classes else None
            if last and spans[k] <= 1.25 * spans[last.members[0]]:
                last.members.append(k)
            else:
                self.classes.append(Window(0, 0, 0, [k]))
        for c in self.classes:
            longest, fewest = max(spans[k] for k in c.members), min(len(self.sets[k]) for k in c.members)
            c.width = longest + max(1, longest // 4)
            c.stride = c.width - longest + 1
            shared = ceil(containment * fewest - 1e-9)
            c.bands = bands_needed(shared / (fewest + c.width - shared), miss)
        self.seeds = mix(np.arange(1, 1 + max((c.bands for c in self.classes), default=0), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        hashes = [self._hash(t[2]) for t in templates]
        self.lookup: list[list[dict[int, list[int]]]] = []
        self.keys: list[list[np.ndarray]] = []
        for c in self.classes:
            rows: list[dict[int, list[int]]] = []
            for band in range(c.bands):
                at: dict[int, list[int]] = {}
                for k in c.members:
                    at.setdefault(int(self.permuted(hashes[k], band).min()), []).append(k)
                rows.append(at)
            self.lookup.append(rows)
            self.keys.append([np.array(sorted(r), np.uint32) for r in rows])

    def permuted(self, h: np.ndarray, band: int) -> np.ndarray:
        """The hashes in the order of one MinHash permutation (top 32 bits, salted)."""
        x = (h ^ self.seeds[band]) * np.uint64(0xD6E8FEB86659FD93)
        return ((x ^ (x >> np.uint64(32))) * np.uint64(0xA0761D6478BD642F) >> np.uint64(32)).astype(np.uint32)

    def _shingles(self, text: str) -> list[tuple[bytes, int, int]]:
        data = LOWER[np.frombuffer(text.encode(), np.uint8)]
        starts, ends, _ = word_spans(data, np.array([0, len(data)]))
        w = [data[s:e].tobytes() for s, e in zip(starts, ends, strict=True)]
        n = self.words
        return [(b" ".join(w[k : k + n]), int(starts[k]), int(ends[k + n - 1])) for k in range(len(w) - n + 1)]

    def _hash(self, text: str) -> np.ndarray:
        data = LOWER[np.frombuffer(text.encode(), np.uint8)]
        starts, ends, _ = word_spans(data, np.array([0, len(data)]))
        at = np.arange(len(starts) - self.words + 1)
        return Rolling(Rolling(data).spans(starts, ends)).spans(at, at + self.words)

    def find(self, data: np.ndarray, offsets: np.ndarray) -> dict[tuple[int, str], tuple[float, int, int, str]]:
        """(row, license) -> (containment, start, end, kind) of the best match."""
        data = LOWER[data]
        starts, ends, rows = word_spans(data, offsets)
        n = self.words
        if len(starts) < n:
            return {}
        at = np.arange(len(starts) - n + 1)
        h = Rolling(Rolling(data).spans(starts, ends)).spans(at, at + n)
        whole = rows[at] == rows[at + n - 1]
        seen: set[tuple[int, str, float, int, int, str]] = set()
        checked: set[tuple[int, int]] = set()
        for band in range(len(self.seeds)):
            base = self.permuted(h, band)
            base[~whole] = 0xFFFFFFFF  # a shingle across two rows is none
            for c, keys, lookup in zip(self.classes, self.keys, self.lookup, strict=True):
                if band >= c.bands:
                    continue
                lows = _window_minima(base, c.width)[:: c.stride]
                for w in np.flatnonzero(np.isin(lows, keys[band])).tolist():
                    for k in lookup[band][int(lows[w])]:
                        if (w * c.stride, k) not in checked:
                            checked.add((w * c.stride, k))
                            self._verify(data, starts, ends, rows, whole, w * c.stride, c.width, k, seen)
        return self._strongest(seen)

    @staticmethod
    def _strongest(seen: set) -> dict:
        """The best occurrence of each license in each row, of those that no stronger one
        overlaps: notices that differ in a word or a version contain most of each other's
        shingles."""
        best: dict = {}
        by_row: dict[int, list] = {}
        for row, name, share, start, end, kind in sorted(seen, key=lambda m: (-m[2], *m)):
            if not any(o[0] > share and o[1] < end and start < o[2] for o in by_row.get(row, ())):
                by_row.setdefault(row, []).append((share, start, end))
                best.setdefault((row, name), (share, start, end, kind))
        return best

    def _verify(self, data, starts, ends, rows, whole, first: int, width: int, k: int, seen: set) -> None:
        n, hits = self.words, {}
        for s in range(first, min(first + width, len(whole))):
            if whole[s]:
                key = b" ".join(data[a:b].tobytes() for a, b in zip(starts[s : s + n], ends[s : s + n], strict=True))
                if key in self.sets[k]:
                    hits.setdefault(int(rows[s]), []).append((s, key))
        for row, found in hits.items():
            kinds = len({key for _, key in found})
            share = kinds / len(self.sets[k])
            if share >= self.containment - 1e-9:
                for lo, hi in _tight(found, kinds):
                    name, kind = self.names[k]
                    seen.add((row, name, share, int(starts[lo]), int(ends[hi + n - 1]), kind))


def _tight(found: list[tuple[int, bytes]], kinds: int) -> Iterator[tuple[int, int]]:
    """First and last position of each shortest run of ``found`` with this many keys."""
    held: dict[bytes, int] = {}
    lo, last = 0, -1
    for s, key in found:
        held[key] = held.get(key, 0) + 1
        whole = len(held) == kinds
        while held[found[lo][1]] > 1:
            held[found[lo][1]] -= 1
            lo += 1
        if whole and lo != last:
            yield found[lo][0], s
            last = lo


def _window_minima(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values; the runs at the end are cut short."""
    pad = np.concatenate([x, np.full(width - 1, 0xFFFFFFFF, x.dtype)])
    size, low = 1, pad
    while size < width:
        step = min(size, width - size)
        low = np.minimum(low[: len(low) - step], low[step:])
        size += step
    return low


def scan_licenses(docs: DataFrame, templates=TEMPLATES, words: int = SHINGLE_WORDS, containment: float = CONTAINMENT, miss: float = MISS) -> DataFrame:
    """``(doc_id, license, kind, containment, start, end)``: the best match of each
    license in each row of ``docs(doc_id, text)``.

    ``containment`` is the share of a template's distinct word shingles that lie in one
    window; an occurrence that overlaps a stronger one is left out, others of its license
    are not;
    ``start`` and ``end`` are UTF-8 byte offsets (end exclusive).  Rows without a
    match, null and empty texts give nothing; repeated rows give repeated matches; an
    empty table gives none.  Windows are laid over whole texts.  A match's shingles must
    lie within a template's length; one pass, no shuffle.
    """
    templates = tuple(tuple(t) for t in templates)
    Templates(templates, words, containment, miss)  # refuse bad templates here, not in a task
    held = docs.sparkSession.sparkContext.broadcast((templates, words, containment, miss))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Templates(*held.value)
        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            for lo, hi in chunks(offsets):
                edges = offsets[lo : hi + 1] - offsets[lo]
                found = sorted(known.find(data[offsets[lo] : offsets[hi]], edges).items())
                if found:
                    rows = [k[0] for k, _ in found]
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("doc_id").slice(lo, hi - lo).take(pa.array(rows, pa.int64())),
                            pa.array([k[1] for k, _ in found]),
                            pa.array([v[3] for _, v in found]),
                            pa.array([v[0] for _, v in found], pa.float64()),
                            pa.array([v[1] - int(edges[r]) for r, (_, v) in zip(rows, found, strict=True)], pa.int64()),
                            pa.array([v[2] - int(edges[r]) for r, (_, v) in zip(rows, found, strict=True)], pa.int64()),
                        ],
                        ["doc_id", "license", "kind", "containment", "start", "end"],
                    )

    return with_defaults(docs, doc_id="long", text="string").mapInArrow(run, "doc_id long, license string, kind string, containment double, start long, end long")


def op1_license_scan(spark, sf_dir: str) -> DataFrame:
    """License notices in all documents."""
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))
