"""License notices in texts, by Dice coefficient over word bigrams.

A notice is compared with stretches of the normalised text (lower-case words of letters and digits),
as a notice is usually one passage of a longer document. The coefficient is that of multisets,
2 |A and B| / (|A| + |B|). Two size bounds prune: a stretch that reaches the coefficient t has
between m t / (2 - t) and m (2 - t) / t bigrams for a template of m, and a document with fewer than
m t / (2 - t) bigrams of a template holds no such stretch.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sipnote.llm.common import settings, whole
from sipnote.session import written

THRESHOLD = 0.8
WORD = re.compile(r"[a-z0-9]+")

# Customary notices by which the licences are named in texts.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files, to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies "
        "of the Software"
    ),
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation"
    ),
    "LGPL-3.0": "This library is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0": "Licensed under the GNU Affero General Public License, version 3.",
    "BSD-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met"
    ),
    "BSD": "Released under the three clause BSD License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
        "is hereby granted"
    ),
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC0-1.0": "Dedicated to the public domain under CC0 1.0 Universal.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def pairs_of(words: list[str]) -> list[tuple[str, str]]:
    return list(zip(words, words[1:]))


def dice(a: list, b: list) -> float:
    shared = sum((Counter(a) & Counter(b)).values())
    return 2 * shared / (len(a) + len(b)) if a or b else 0.0


@dataclass
class Template:
    name: str
    pairs: Counter
    size: int
    least: int
    most: int


class Matcher:
    """Finds the best stretches of each template; one per task, built from the templates."""

    def __init__(self, templates: dict[str, str], threshold: float) -> None:
        self.threshold = threshold
        self.templates, self.holders = [], {}
        for name, text in templates.items():
            pairs = pairs_of(words_of(text))
            if pairs:
                m, t = len(pairs), threshold
                bounds = (math.ceil(m * t / (2 - t) - 1e-9), math.floor(m * (2 - t) / t + 1e-9))
                self.templates.append(Template(name, Counter(pairs), m, *bounds))
        for i, t in enumerate(self.templates):
            for pair in t.pairs:
                self.holders.setdefault(pair, []).append(i)
        self.firsts = {a for a, _ in self.holders}

    def _best(self, template: Template, hits: list[tuple[int, tuple]]) -> list[tuple[float, int, int, str]]:
        """For every hit, the best stretch that begins there, if it reaches the threshold."""
        found = []
        for i, (start, _) in enumerate(hits):
            left, shared, best = dict(template.pairs), 0, None
            for j in range(i, len(hits)):
                at, pair = hits[j]
                length = at - start + 1
                if length > template.most:
                    break
                if left[pair]:
                    left[pair] -= 1
                    shared += 1
                    value = 2 * shared / (template.size + length)
                    if value >= self.threshold and (best is None or value > best[0]):
                        best = (value, start, at + 2, template.name)
            if best:
                found.append(best)
        return found

    def find(self, text: str) -> list[tuple[float, int, int, str]]:
        """(coefficient, first word, word after the last, name), best first where they overlap."""
        words = words_of(text)
        firsts, holders = self.firsts, self.holders
        hits: dict[int, list] = {}
        for i, w in enumerate(words):
            if w in firsts and (held := holders.get(tuple(words[i : i + 2]))):
                for t in held:
                    hits.setdefault(t, []).append((i, (w, words[i + 1])))
        found = []
        for t, own in hits.items():
            if len(own) >= self.templates[t].least:
                found += self._best(self.templates[t], own)
        # Stretches taken lie apart, so in their order only the neighbours of another can overlap it.
        taken: list[tuple[float, int, int, str]] = []
        for x in sorted(found, key=lambda x: (-x[0], x[1] - x[2], x[1], x[3])):
            at = bisect_left(taken, x[1], key=lambda y: y[1])
            if (at == 0 or taken[at - 1][2] <= x[1]) and (at == len(taken) or x[2] <= taken[at][1]):
                taken.insert(at, x)
        return taken


def find_licenses(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id and ``notices`` (name, dice, start, end), in order.

    ``start`` and ``end`` are words of the normalised text, end exclusive. Of overlapping stretches
    the one with the higher coefficient stays, then the longer, the earlier, the first name. Null
    and empty texts and texts of one word have none; a template of one word is never found. Repeated
    and null ids are searched row by row. An empty table gives an empty result; other columns are
    ignored, whatever their names.
    """
    given = TEMPLATES if templates is None else templates

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(given, threshold)
        kind = pa.list_(
            pa.struct([("name", pa.string()), ("dice", pa.float64()), ("start", pa.int32()), ("end", pa.int32())])
        )
        for batch in batches:
            notices = [
                [{"name": n, "dice": d, "start": s, "end": e} for d, s, e, n in matcher.find(text)]
                for text in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(notices, kind)], ["doc_id", "notices"])

    rows = docs.select(F.col(id_col).alias("doc_id"), whole(text_col).alias("text"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, "
    schema += "notices array<struct<name:string,dice:double,start:int,end:int>>"
    with settings(docs.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": "512"}):
        return written(rows.mapInArrow(run, schema), "license-notices")


def license_summary(found: DataFrame) -> DataFrame:
    """One row per document: its best notice, how many it holds, and where."""
    best = F.array_max(F.transform("notices", lambda n: F.struct(n["dice"], -n["start"], n["name"])))
    spot = lambda n: F.concat_ws(":", n["name"], n["start"], n["end"])
    return found.select(
        "doc_id",
        best["name"].alias("license"),
        best["dice"].alias("dice"),
        F.size("notices").cast("long").alias("n_notices"),
        F.array_join(F.transform("notices", spot), ",").alias("notices"),
    )
