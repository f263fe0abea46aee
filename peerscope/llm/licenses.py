"""Licence scan: TF-IDF cosine to templates, then inheritance from the nearest directory (operator 5).

Texts are compared with licence templates in three ways:

- every whole text of about a licence's length with the whole texts of the licences (``license_texts/``);
- every line with the statements and titles of ``TEMPLATES``;
- every window of as many words as a template has with that template, so that statements wrapped over
  lines, behind comment marks or inside a longer line are found.  A window is placed where it fits best
  and must be closer than a line (``WINDOW_THRESHOLD``); a line that has a licence is judged as a whole,
  so no window cuts through it.

A known name behind ``SPDX-License-Identifier:`` counts as similarity 1.

Terms weigh by their inverse document frequency over all texts; a term that no template has weighs like
a term of no document, so only the templates' own terms are counted over the corpus.  A line or window
can reach the threshold t only if it has one of a template's leading terms: the heaviest ones, down to
where the rest weighs less than t of the template.  Texts without a leading term of any template are
not looked at closer.  Windows and whole texts are first held against an upper bound of their cosine
(a term's square weighs at least its occurrences) that comes from sums over all of them at once.

A file without a licence of its own takes that of its nearest directory upwards that has one.  A
directory has the licence of its first licence file (by name).  Paths join by distinct directories:
ancestors are listed once per directory and not once per file.

Defined results: null and empty texts have no licence; a null path has no directory and inherits
nothing; a whole text of a licence goes before its lines and windows, which may name other licences;
equal similarities go to the template first in alphabetical order, as do several names behind one SPDX
mark; repeated paths each get their row.
"""

from __future__ import annotations

import math
import pkgutil
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerscope.llm.common import Rolling, Shared, column_arrays, ranges_concat, row_chunks, trimming, word_bounds
from peerscope.llm.decontaminate import fold_table, word_table

THRESHOLD = 0.7
#: Least similarity of a window.
WINDOW_THRESHOLD = 0.9

# Statements by which public licences are applied to a work, and their titles (fixed values).
TEMPLATES = [
    ("AGPL-3.0", "GNU Affero General Public License, Version 3, 19 November 2007"),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("Apache-2.0", "Apache License, Version 2.0, January 2004"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International Public License"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International Public License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("GPL-2.0", "GNU General Public License, Version 2, June 1991"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "GNU General Public License, Version 3, 29 June 2007"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "GNU Lesser General Public License, Version 2.1, February 1999"),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "GNU Lesser General Public License, Version 3, 29 June 2007"),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
#: Licences whose whole texts lie in ``license_texts``.
WHOLE_TEXTS = ("Apache-2.0", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-2.0", "Unlicense")
SPDX = re.compile(rb"SPDX-License-Identifier:[ \t]*([^\r\n]*)", re.IGNORECASE)


def license_texts() -> list[tuple[str, str]]:
    """(licence, whole text)"""
    return [(name, pkgutil.get_data(__package__, f"license_texts/{name}.txt").decode()) for name in WHOLE_TEXTS]


class Terms:
    """Word hashes of blocks of texts with the places of the words; one per task."""

    def __init__(self) -> None:
        self.rolling, self.fold, self.is_word = Rolling(), fold_table(), word_table()

    def of(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low = self.fold[data]
        starts, ends = word_bounds(self.is_word[low], offsets)
        return self.rolling.ranges(self.rolling.prefix(low), starts, ends), starts

    def of_text(self, text: bytes) -> list[int]:
        data = np.frombuffer(text, np.uint8)
        return self.of(data, np.array([0, len(data)]))[0].tolist()


class Matcher:
    """Template vectors; ``df`` and ``n`` are document counts of the templates' terms and of all texts."""

    def __init__(self, templates, df: dict[int, int], n: int, threshold: float, whole=()) -> None:
        terms = Terms()
        self.df, self.n, self.threshold = df, n, threshold
        self.window_threshold = max(threshold, WINDOW_THRESHOLD)
        self.names = [name for name, _ in templates]
        self.vectors, self.sizes, leading = [], [], set(terms.of_text(b"spdx"))
        for _, text in templates:
            words = terms.of_text(text.encode())
            self.sizes.append(len(words))
            self.vectors.append(self.vector(words))
            rest = 1.0
            for t, w in sorted(self.vectors[-1].items(), key=lambda x: -x[1]):
                if math.sqrt(max(rest, 0.0)) < threshold - 1e-9:
                    break
                leading.add(t)
                rest -= w * w
        self.leading = np.array(sorted(leading), np.uint64)
        self.spdx = {name.lower(): name for name, _ in [*templates, *whole]}
        self.terms, self.weights, self.columns = self.dense(self.vectors)
        self.whole_names = [name for name, _ in whole]
        words = [terms.of_text(text.encode()) for _, text in whole]
        self.whole_sizes = np.array([len(w) for w in words])
        self.whole_vectors = [self.vector(w) for w in words]
        self.whole_terms, self.whole_weights, self.whole_columns = self.dense(self.whole_vectors)

    def vector(self, terms: list[int]) -> dict[int, float]:
        """Term weights of length 1."""
        v = {t: k * self.weight(t) for t, k in Counter(terms).items()}
        norm = math.sqrt(sum(w * w for w in v.values()))
        return {t: w / norm for t, w in v.items()}

    def dense(self, vectors: list[dict[int, float]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(sorted terms of the vectors, weight of an occurrence, that times the vectors' weights); each
        with one row more for all other terms."""
        own = sorted({t for v in vectors for t in v})
        weights = np.array([*map(self.weight, own), self.weight(-1)])
        columns = np.array([[v.get(t, 0.0) for v in vectors] for t in [*own, -1]]).reshape(len(weights), len(vectors))
        return np.array(own, np.uint64), weights, columns * weights[:, None]

    @staticmethod
    def places(own: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Place of each term in ``own``; its length for all others."""
        at = np.minimum(np.searchsorted(own, h), len(own) - 1)
        return np.where(own[at] == h, at, len(own))

    def cosine(self, terms: list[int], vector: dict[int, float]) -> float:
        return min(1.0, sum(w * vector.get(t, 0.0) for t, w in self.vector(terms).items()))

    def windows(self, h: np.ndarray, inside: np.ndarray) -> list[tuple[float, str]]:
        """(similarity, licence) of the windows of a text's terms that reach the threshold; none begins
        or ends at a place that is ``inside`` a line with a licence."""
        at, found = self.places(self.terms, h), []
        square = np.concatenate(([0.0], np.cumsum(self.weights[at] ** 2)))
        first = np.arange(len(h))
        for j, size in enumerate(self.sizes):
            last = np.minimum(first + size, len(h))
            dot = np.concatenate(([0.0], np.cumsum(self.columns[at, j])))
            bound = (dot[last] - dot[first]) / np.sqrt(square[last] - square[first])
            some = np.flatnonzero((bound >= self.window_threshold - 1e-6) & ~inside[first] & ~inside[last])
            score = max((self.cosine(h[i : i + size].tolist(), self.vectors[j]) for i in some), default=0.0)
            if score >= self.window_threshold:
                found.append((score, self.names[j]))
        return found

    def whole(self, h: np.ndarray, bounds: np.ndarray) -> dict[int, tuple[float, str]]:
        """Text -> (minus the similarity, licence) of the nearest whole licence text.  A text's length
        must be within half and twice the licence's; ``bounds`` are the places where texts begin and end."""
        found: dict[int, tuple[float, str]] = {}
        if not len(self.whole_sizes):
            return found
        n = np.diff(bounds)
        able = np.flatnonzero((2 * n >= self.whole_sizes.min()) & (n <= 2 * self.whole_sizes.max()))
        width = len(self.whole_terms) + 1
        for lo in range(0, len(able), 64):
            rows = able[lo : lo + 64]
            at = self.places(self.whole_terms, h[ranges_concat(bounds[rows], bounds[rows + 1])])
            counts = np.bincount(np.repeat(np.arange(len(rows)), n[rows]) * width + at, minlength=len(rows) * width).reshape(-1, width)
            square = (counts[:, :-1] * self.whole_weights[:-1]) ** 2
            norm = np.sqrt(square.sum(axis=1) + counts[:, -1] * self.whole_weights[-1] ** 2)
            size = n[rows, None]
            near = (counts @ self.whole_columns >= (self.threshold - 1e-6) * norm[:, None]) & (
                (2 * size >= self.whole_sizes) & (size <= 2 * self.whole_sizes)
            )
            for i, k in zip(*np.nonzero(near), strict=True):
                row = int(rows[i])
                score = self.cosine(h[bounds[row] : bounds[row + 1]].tolist(), self.whole_vectors[k])
                if score >= self.threshold:
                    found[row] = min(found.get(row, (0.0, "")), (-round(score, 12), self.whole_names[k]))
        return found

    def named(self, text: bytes) -> list[tuple[float, str]]:
        """(1, licence) of the SPDX marks of a text."""
        out = []
        for mark in SPDX.findall(text):
            ids = re.findall(r"[\w.+-]+", mark.decode(errors="replace").lower())
            names = [self.spdx.get(re.sub(r"(-only|-or-later|\+)$", "", x)) for x in ids]
            out += [(1.0, x) for x in names if x]
        return out

    def weight(self, term: int) -> float:
        return math.log((self.n + 1) / (self.df.get(term, 0) + 1)) + 1.0

    def best(self, terms: list[int]) -> tuple[float, str | None]:
        """The largest cosine of a line's terms to a template, and its licence."""
        v = self.vector(terms)
        found = [(sum(w * t.get(x, 0.0) for x, w in v.items()), name) for t, name in zip(self.vectors, self.names, strict=True)]
        score, name = min(found, key=lambda f: (-round(f[0], 12), f[1]))
        return min(score, 1.0), name


def template_frequencies(files: DataFrame, text: str, templates=TEMPLATES) -> tuple[dict[int, int], int]:
    """(document frequency of each template term, number of texts); as many rows as templates have terms."""
    counted, seen = Terms(), [*templates, *license_texts()]
    own = np.array(sorted({t for _, s in seen for t in counted.of_text(s.encode())}), np.uint64)

    def count(batches):
        terms, total, rows = Terms(), np.zeros(len(own), np.int64), 0
        for batch in batches:
            data, offsets = column_arrays(batch, "text")
            rows += batch.num_rows
            for a, b in row_chunks(offsets):
                o = offsets[a : b + 1] - offsets[a]
                h, starts = terms.of(data[offsets[a] : offsets[b]], o)
                at = np.minimum(np.searchsorted(own, h), len(own) - 1)
                mine = own[at] == h
                doc = np.searchsorted(o, starts[mine], side="right") - 1
                total += np.bincount(np.unique(doc * len(own) + at[mine]) % len(own), minlength=len(own))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(-1, len(own))), pa.array(np.concatenate(([rows], total)))], names=["term", "n"]
        )

    rows = files.select(F.col(text).alias("text")).mapInArrow(trimming(count), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    got = {r["term"]: r["n"] for r in rows.collect()}
    return {int(own[i]): got.get(i, 0) for i in range(len(own))}, got.get(-1, 0)


def own_licenses(files: DataFrame, text: str = "text", threshold: float = THRESHOLD, templates=TEMPLATES) -> DataFrame:
    """``files`` with the column ``own`` (struct of licence, similarity and ``whole``: the file is a whole licence
    text; null without a match)."""
    df, n = template_frequencies(files, text, templates)
    matcher = Shared(files.sparkSession, Matcher(templates, df, n, threshold, license_texts()))

    @F.arrow_udf("struct<license:string,similarity:double,whole:boolean>")
    def match(texts: pa.Array) -> pa.Array:
        m, terms = matcher.value, Terms()
        best: dict[int, tuple[float, str]] = {}  # row -> (minus the similarity, licence), the least one
        wholes: set[int] = set()
        data, offsets = column_arrays(pa.RecordBatch.from_arrays([texts], names=["text"]), "text")
        for a, b in row_chunks(offsets):
            part, o = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            h, starts = terms.of(part, o)
            bounds = np.searchsorted(starts, o)  # first word of each text
            whole = m.whole(h, bounds)
            at = np.minimum(np.searchsorted(m.leading, h), len(m.leading) - 1)
            hits = starts[m.leading[at] == h]
            # lines of the block: cut at every line feed and at every text's end
            cuts = np.unique(np.concatenate((o, np.flatnonzero(part == 10) + 1)))
            inside = np.zeros(len(h) + 1, bool)  # places between the words of a line that has a licence
            for line in np.unique(np.searchsorted(cuts, hits, side="right") - 1):
                lo, hi = cuts[line], cuts[line + 1]
                w = np.searchsorted(starts, [lo, hi])
                score, name = m.best(h[w[0] : w[1]].tolist())
                row = a + int(np.searchsorted(o, lo, side="right")) - 1
                if score >= m.threshold:
                    inside[w[0] + 1 : w[1]] = True
                    best[row] = min(best.get(row, (0.0, "")), (-round(score, 12), name))
            for i in np.unique(np.searchsorted(o, hits, side="right") - 1).tolist():
                if i in whole:
                    continue
                lo, hi = bounds[i], bounds[i + 1]
                for score, name in m.windows(h[lo:hi], inside[lo : hi + 1]) + m.named(part[o[i] : o[i + 1]].tobytes()):
                    best[a + i] = min(best.get(a + i, (0.0, "")), (-round(score, 12), name))
            best |= {a + i: found for i, found in whole.items()}
            wholes |= {a + i for i in whole}
        names = [best[i][1] if i in best else None for i in range(len(texts))]
        scores = [-best[i][0] if i in best else None for i in range(len(texts))]
        return pa.StructArray.from_arrays(
            [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array([i in wholes for i in range(len(texts))])],
            names=["license", "similarity", "whole"],
            mask=pa.array([x is None for x in names]),
        )

    return files.withColumn("own", match(F.col(text)))


#: File names that stand for a licence file.
LICENSE_FILE = r"(?i)^(licen[cs]e|copying|unlicense|notice)([._-].*)?$"


def directory_of(path: Column) -> Column:
    """Everything before the last slash; empty for a file at the top."""
    return F.when(path.isNotNull(), F.regexp_replace(path, "/?[^/]*$", ""))


def inherited(found: DataFrame, path: str = "path", is_license_file: Column | None = None) -> DataFrame:
    """``found`` (with ``own``) with ``license``, ``similarity``, ``license_path`` (the file it comes from).

    ``is_license_file`` says which files with a licence speak for their directory (default: whole licence texts and
    files named as licence files are); a header speaks for its own file alone."""
    if is_license_file is None:
        named = F.regexp_extract(F.col(path), "[^/]*$", 0).rlike(LICENSE_FILE)
        is_license_file = F.coalesce(F.col("own.whole"), F.lit(False)) | F.coalesce(named, F.lit(False))
    rows = found.withColumn("_dir", directory_of(F.col(path)))
    speaks = F.col("own").isNotNull() & is_license_file
    given = rows.where(speaks & F.col("_dir").isNotNull()).groupBy("_dir").agg(
        F.min(F.struct(F.col(path).alias("p"), F.col("own.license").alias("l"))).alias("_given")
    )
    dirs = rows.where("_dir IS NOT NULL").select("_dir").distinct()
    pieces = F.split("_dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(pieces)), lambda k: F.array_join(F.slice(pieces, F.lit(1), k), "/"))
    up = dirs.select("_dir", F.explode(F.array_distinct(above)).alias("_up"))
    nearest = up.join(given.withColumnRenamed("_dir", "_up"), "_up").groupBy("_dir").agg(
        F.max_by("_given", F.length("_up")).alias("_near")
    )
    joined = rows.join(nearest, "_dir", "left")
    return joined.select(
        *[F.col(c) for c in found.columns if c not in ("own", "license", "similarity", "license_path")],
        F.coalesce("own.license", "_near.l").alias("license"),
        F.col("own.similarity").alias("similarity"),
        F.when(F.col("own").isNotNull(), F.col(path)).otherwise(F.col("_near.p")).alias("license_path"),
    )
