"""Licence scan: passages against licence templates by the Dice coefficient over word bigrams.

A document's passages are its paragraphs, lines and sentences. Passage and template are normalised to
lower-case words without punctuation and compared as sets of neighbouring words: twice the common
bigrams over the sum of both sizes. A template can reach the threshold t only with a size between
t / (2 - t) and (2 - t) / t times the passage's, so templates are kept by size and only that range
is looked at; most passages share no bigram with any template and end there.

The templates are a parameter of fixed size, so each document is scanned where it is: no shuffle.
A notice that is wrapped over lines, or lies inside a longer line, is no passage of its own. ``licence_windows``
compares with every window of words of the whole text instead, wherever lines and sentences end; each passage
is such a window, so it finds all that the passages do, with the same coefficient or a higher one.

Null and empty texts, and passages of one word, match nothing. Of equal coefficients the smaller
template id counts as the best. Repeated rows are scanned each; an empty table gives an empty result.
Other columns aren't read.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import terms

THRESHOLD = 0.8

# Short notices and opening paragraphs of common licences.
TEMPLATES = {
    "agpl-3.0": "This program is licensed under the GNU Affero General Public License, version 3.",
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at"
    ),
    "bsd-3-clause": "Licensed under the BSD 3-Clause License.",
    "bsd-conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met"
    ),
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "cc0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "gpl-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
        "is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "lgpl-2.1": "This library is licensed under the GNU Lesser General Public License, version 2.1.",
    "mit": "Released under the MIT License.",
    "mit-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the Software), to deal in the Software without restriction"
    ),
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "public-domain": "This work is in the public domain.",
}

# Titles that name a licence.
TITLES = {
    "0bsd": ("BSD Zero Clause License", "Zero-Clause BSD"),
    "agpl-3.0": ("GNU Affero General Public License Version 3",),
    "apache-2.0": ("Apache License Version 2.0",),
    "artistic-1.0": ("The Artistic License",),
    "bsd-2-clause": ("BSD 2-Clause License",),
    "bsd-3-clause": ("BSD 3-Clause License",),
    "cc-by-4.0": ("Creative Commons Attribution 4.0 International",),
    "cc-by-nc-4.0": ("Creative Commons Attribution-NonCommercial 4.0 International",),
    "cc-by-sa-4.0": ("Creative Commons Attribution-ShareAlike 4.0 International",),
    "cc0-1.0": ("CC0 1.0 Universal",),
    "gfdl-1.2": ("GNU Free Documentation License Version 1.2",),
    "gfdl-1.3": ("GNU Free Documentation License Version 1.3",),
    "gpl-1.0": ("GNU General Public License Version 1",),
    "gpl-2.0": ("GNU General Public License Version 2",),
    "gpl-3.0": ("GNU General Public License Version 3",),
    "isc": ("ISC License",),
    "lgpl-2.0": ("GNU Library General Public License Version 2",),
    "lgpl-2.1": ("GNU Lesser General Public License Version 2.1",),
    "lgpl-3.0": ("GNU Lesser General Public License Version 3",),
    "mit": ("MIT License",),
    "mpl-1.1": ("Mozilla Public License Version 1.1",),
    "mpl-2.0": ("Mozilla Public License Version 2.0",),
    "unlicense": ("The Unlicense",),
}
#: Shorter paragraphs of a licence's text are headings such as "Terms and conditions", which name no licence.
LEAST_PARAGRAPH = 8

_PARAGRAPH = re.compile(r"\n[ \t\r]*\n")
_SENTENCE = re.compile(r"[.!?][ \t]+")


def passages(text: str | None) -> list[str]:
    """Paragraphs, lines and sentences; each kind only where it cuts further than the one before."""
    found = []
    for paragraph in _PARAGRAPH.split(text or ""):
        found.append(paragraph)
        lines = paragraph.split("\n")
        found += lines if len(lines) > 1 else []
        for line in lines:
            sentences = _SENTENCE.split(line)
            found += sentences if len(sentences) > 1 else []
    return found


def bigrams(text: str) -> set[tuple[bytes, bytes]]:
    words = terms(text)
    return set(zip(words, words[1:], strict=False))


def licence_texts() -> dict[str, str]:
    """Every paragraph of the licences' texts, their titles and the notices, as ``licence/part``."""
    parts = {f"{name}/notice": text for name, text in TEMPLATES.items()}
    for name, titles in TITLES.items():
        parts |= {f"{name}/title-{k}": title for k, title in enumerate(titles)}
    for path in sorted((Path(__file__).parent / "licences").glob("*.txt")):
        for k, paragraph in enumerate(_PARAGRAPH.split(path.read_text(encoding="utf-8").replace("\f", "\n\n"))):
            if len(bigrams(paragraph)) >= LEAST_PARAGRAPH:
                parts[f"{path.stem}/{k:03d}"] = paragraph
    return parts


class Scanner:
    def __init__(self, templates: dict[str, str], threshold: float):
        self.threshold = threshold
        sized = sorted((len(b), name, b) for name, b in ((n, bigrams(t)) for n, t in templates.items()) if b)
        self.sizes = [x[0] for x in sized]
        self.names = [x[1] for x in sized]
        self.sets = [x[2] for x in sized]
        self.known = set().union(*self.sets) if sized else set()

    def passage(self, text: str) -> list[tuple[float, str]]:
        """Coefficient and name of the templates that a passage matches."""
        words = terms(text)
        if self.known.isdisjoint(zip(words, words[1:], strict=False)):
            return []
        mine = set(zip(words, words[1:], strict=False))
        t = self.threshold
        first = bisect_left(self.sizes, len(mine) * t / (2 - t) - 1e-9)
        last = bisect_right(self.sizes, len(mine) * (2 - t) / t + 1e-9)
        found = []
        for k in range(first, last):
            dice = 2 * len(mine & self.sets[k]) / (len(mine) + self.sizes[k])
            if dice >= t:
                found.append((dice, self.names[k]))
        return found

    def document(self, text: str | None) -> dict[str, float]:
        """The best coefficient of each template that occurs."""
        best: dict[str, float] = {}
        for p in passages(text):
            for dice, name in self.passage(p):
                best[name] = max(dice, best.get(name, 0.0))
        return best


class WindowScanner:
    """The best window of words for each template.

    A best window can be chosen so that it begins and ends with common bigrams, and that the first one
    doesn't come again in it. One begun at a common bigram is left as soon as so many distinct bigrams
    aren't common that even the rest of the template couldn't make up for them.
    """

    def __init__(self, templates: dict[str, str], threshold: float):
        self.threshold = threshold
        sets = ((name, bigrams(t)) for name, t in sorted(templates.items()))
        self.templates = [(name, b) for name, b in sets if b]
        self.sizes = np.array([len(b) for _, b in self.templates], dtype=np.int64)
        # Bigrams that aren't in the template can only lower the coefficient.
        self.least = self.sizes * threshold / (2 - threshold) - 1e-9
        holders: dict[tuple[bytes, bytes], list[int]] = {}
        for k, (_, b) in enumerate(self.templates):
            for x in b:
                holders.setdefault(x, []).append(k)
        self.holders = {x: np.array(k, dtype=np.int64) for x, k in holders.items()}
        self.known = frozenset(holders)

    def document(self, text: str | None) -> dict[str, float]:
        """The best coefficient of each template that occurs."""
        words = terms(text)
        shared = self.known.intersection(zip(words, words[1:], strict=False))
        if not shared:
            return {}
        common = np.bincount(np.concatenate([self.holders[x] for x in shared]), minlength=len(self.sizes))
        candidates = np.flatnonzero((common >= self.least) & (common > 0)).tolist()
        if not candidates:
            return {}
        grams = list(zip(words, words[1:], strict=False))
        places: dict[tuple[bytes, bytes], list[int]] = {}
        for i, x in enumerate(grams):
            if x in shared:
                places.setdefault(x, []).append(i)
        best = {}
        for k in candidates:
            name, template = self.templates[k]
            dice = self._best(grams, template, [i for x in template if x in places for i in places[x]])
            if dice >= self.threshold:
                best[name] = dice
        return best

    def _best(self, grams: list, template: set, starts: list[int]) -> float:
        size, many, best = len(template), len(grams), 0.0
        for start in starts:
            goal = max(best, self.threshold)
            spare = 2 * size / goal - 2 * size + 1e-9
            first = grams[start]
            mine = {first}
            common, other = 1, 0
            best = max(best, 2 / (1 + size))
            for i in range(start + 1, many):
                x = grams[i]
                if x in mine:
                    if x == first:
                        break
                    continue
                mine.add(x)
                if x in template:
                    common += 1
                    best = max(best, 2 * common / (common + other + size))
                else:
                    other += 1
                    if other > spare:
                        break
            if best == 1.0:
                break
        return best


def _scan(templates: dict[str, str], threshold: float, kind: type = Scanner):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = kind(templates, threshold)
        for batch in batches:
            found = [scanner.document(t) for t in batch.column(1).to_pylist()]
            top = [min(((-d, n) for n, d in f.items()), default=(0.0, None)) for f in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([",".join(sorted(f)) for f in found], pa.string()),
                    pa.array([len(f) for f in found], pa.int64()),
                    pa.array([n for _, n in top], pa.string()),
                    pa.array([abs(d) for d, _ in top], pa.float64()),
                ],
                ["doc_id", "licences", "n_licences", "best", "best_dice"],
            )

    return run


def _matches(documents: DataFrame, templates: dict[str, str] | None, threshold: float, kind: type) -> DataFrame:
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, licences string, n_licences long, best string, best_dice double"
    return docs.mapInArrow(_scan(TEMPLATES if templates is None else templates, threshold, kind), schema)


def licence_matches(
    documents: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD
) -> DataFrame:
    """Per document the licences that occur, how many, and the best with its coefficient."""
    return _matches(documents, templates, threshold, Scanner)


def licence_windows(
    documents: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD
) -> DataFrame:
    """The same over all windows of words, however lines and sentences are cut."""
    return _matches(documents, templates, threshold, WindowScanner)


def op6_license_scan(documents: DataFrame) -> DataFrame:
    return licence_matches(documents)


def op6_license_windows(documents: DataFrame) -> DataFrame:
    """Per document the licences of which any part occurs, those parts, and the best part's coefficient."""
    found = licence_windows(documents, licence_texts())
    parts = F.filter(F.split("licences", ","), lambda x: x != "")
    names = F.array_sort(F.array_distinct(F.transform(parts, lambda x: F.substring_index(x, "/", 1))))
    return found.select(
        "doc_id",
        F.array_join(names, ",").alias("licences"),
        F.size(names).cast("long").alias("n_licences"),
        F.col("licences").alias("parts"),
        F.col("n_licences").alias("n_parts"),
        "best",
        "best_dice",
    )
