"""License scans: sparse TF-IDF cosine of headers and license files to templates, and inheritance from the nearest directory above.

Every unit of a text is compared with every template: each run of as many words as the template has, wherever it starts (so a notice
may be wrapped over lines or stand inside a long one), each line, each paragraph (blank lines end it), and the whole text. A vector
weighs a word by its count times log((1 + n) / (1 + df)) + 1. Words of templates have their own document frequency over all n documents;
all others are counted in ``BUCKETS`` buckets of their hash, so that the table has one size whatever the corpus (a crowded bucket makes
its words weigh less). Units that can't reach the least cosine are passed over by two bounds that hold for every unit: one without any of a
template's heaviest words lacks too much of its weight, and a vector is at least as long as if its words were all different.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollmill.functions.session import checkpointed, ship
from rollmill.llm.text import NOT_ALNUM, Piece, pieces

# Names of the licenses.
NAMES = {
    "AGPL-3.0": ["GNU Affero General Public License, version 3", "GNU Affero General Public License v3.0", "GNU AGPL v3"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache 2.0 License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "New BSD License", "Modified BSD License"],
    "BSL-1.0": ["Boost Software License - Version 1.0"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0 International"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International"],
    "CC-BY-ND-4.0": ["CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International"],
    "CC0-1.0": ["CC0 1.0 Universal", "CC0 Public Domain Dedication"],
    "EPL-2.0": ["Eclipse Public License - v 2.0"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU General Public License v2.0", "GNU GPL v2"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU General Public License v3.0", "GNU GPL v3"],
    "ISC": ["ISC License"],
    "LGPL-2.1": ["GNU Lesser General Public License, version 2.1", "GNU LGPL v2.1"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3", "GNU LGPL v3"],
    "MIT": ["MIT License"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0"],
    "Unlicense": ["The Unlicense"],
    "Zlib": ["zlib License"],
    "Proprietary": ["All rights reserved", "Proprietary and confidential"],
}
# Titles, headers and clauses of these licenses.
TEXTS = {
    "AGPL-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 Copyright (C) 2007 Free Software Foundation, Inc. Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.",
    ],
    "Apache-2.0": [
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0',
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
    ],
    "BSD-3-Clause": ["Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."],
    "BSD-2-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ],
    "BSL-1.0": ["Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software"],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "EPL-2.0": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at http://www.eclipse.org/legal/epl-2.0"],
    "GPL-2.0": [
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc. Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.",
    ],
    "GPL-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.",
    ],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "LGPL-2.1": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."],
    "LGPL-3.0": ["GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."],
    "MIT": [
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."],
    "Unlicense": ["This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."],
    "Zlib": ["Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"],
    "Proprietary": ["Unauthorized copying of this file, via any medium, is strictly prohibited."],
}
LICENSE_FILES = r"(?i)^(un)?licen[cs]e([.\-].*)?$|^copying([.\-].*)?$"

#: Units below this cosine with a header or clause don't have its license.
LEAST_COSINE = 0.75
#: A name or tag is only its words, so a unit has to have nearly all of their weight.
NAME_COSINE = 0.98
#: A text of which license units cover this share of the words speaks for its directory.
FILE_SHARE = 0.5
#: Document frequencies of words that no template has are counted in this many buckets.
BUCKETS = 1 << 18
#: Words of candidate runs that are held at once.
HELD = 1 << 20

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def template_rows() -> list[tuple[str, list[bytes], float]]:
    """(license, words, least cosine) of each template: headers and clauses, names, and SPDX tags. What reserves all rights comes last."""
    words = lambda text: _WORD.findall(text.lower().encode())
    rows = [(name, words(x), LEAST_COSINE) for name, texts in TEXTS.items() for x in texts]
    rows += [(name, words(x), NAME_COSINE) for name, texts in NAMES.items() for x in texts]
    rows += [(name, words(f"SPDX-License-Identifier: {name}"), NAME_COSINE) for name in NAMES if name != "Proprietary"]
    return sorted(rows, key=lambda r: r[0] == "Proprietary")


def vocabulary() -> tuple[np.ndarray, np.ndarray]:
    """Sorted word hashes of all templates, and the templates' word counts (templates, words)."""
    rows = template_rows()
    texts = pa.array([b" ".join(w).decode() for _, w, _ in rows])
    found = [(p.hashes(), p.first) for p in pieces(texts, NOT_ALNUM)]
    words = np.unique(np.concatenate([h for h, _ in found]))
    counts = [np.bincount(np.searchsorted(words, h[a:b]), minlength=len(words)) for h, first in found for a, b in zip(first[:-1], first[1:], strict=True)]
    return words, np.array(counts, np.float64)


def columns_of(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The column of each word: of the vocabulary, or behind it that of its bucket."""
    at = np.minimum(np.searchsorted(words, hashes), len(words) - 1)
    return np.where(words[at] == hashes, at, len(words) + (hashes % np.uint64(BUCKETS)).astype(np.int64))


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """Documents, and for each column those that have a word of it; the sums of all tasks' counts, BUCKETS rows or a few more."""
    words, _ = vocabulary()
    size = len(words) + BUCKETS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(size, np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for piece in pieces(batch.column(0), NOT_ALNUM):
                text = np.repeat(np.arange(piece.hi - piece.lo), piece.count)
                key = np.unique(text * size + columns_of(words, piece.hashes()))
                total += np.bincount(key % size, minlength=size)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.insert(some, 0, -1)), pa.array(np.insert(total[some], 0, n))], ["k", "n"])

    ship(docs.sparkSession)
    sums = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "k bigint, n bigint").groupBy("k").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size + 1, np.int64)
    out[sums["k"].to_numpy() + 1] = sums["n"].to_numpy()
    return int(out[0]), out[1:]


@dataclass
class Model:
    """Templates as unit vectors over the vocabulary, each with the words of which a unit has to have one."""

    words: np.ndarray
    idf: np.ndarray
    vectors: np.ndarray
    anchors: np.ndarray
    lengths: np.ndarray
    least: np.ndarray
    names: list[str]


def fitted(n: int, frequency: np.ndarray) -> Model:
    words, counts = vocabulary()
    rows = template_rows()
    idf = np.log((1 + n) / (1 + frequency)) + 1
    vectors = counts * idf[: len(words)]
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    least = np.array([c for _, _, c in rows])
    anchors = np.zeros(vectors.shape, bool)
    for k, v in enumerate(vectors):  # without its anchors a template keeps too little weight for the least cosine
        order = np.argsort(-v, kind="stable")
        need = int(np.searchsorted(np.cumsum(v[order] ** 2), 1 - (least[k] - 1e-6) ** 2, "right")) + 1
        anchors[k, order[:need]] = True
    return Model(words, idf, vectors, anchors, counts.sum(1).astype(np.int64), least, [name for name, _, _ in rows])


def _runs(ids: np.ndarray, weight: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Squared lengths of the vectors of word ranges, in blocks of about HELD words."""
    out, upto, a = np.zeros(len(start)), np.cumsum(length), 0
    while a < len(start):
        b = max(a + 1, int(np.searchsorted(upto, upto[a] + HELD, "right")))
        row = np.repeat(np.arange(b - a), length[a:b])
        at = np.arange(len(row)) - np.repeat(upto[a:b] - length[a:b] - (upto[a] - length[a]), length[a:b]) + np.repeat(start[a:b], length[a:b])
        order = np.lexsort((ids[at], row))
        row, at = row[order], at[order]
        new = np.flatnonzero(np.append(True, (np.diff(row) != 0) | (np.diff(ids[at].view(np.int64)) != 0)))
        times = np.diff(np.append(new, len(row)))
        out[a:b] = np.bincount(row[new], (times * weight[at[new]]) ** 2, minlength=b - a)
        a = b
    return out


def _scan(model: Model, piece: Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each text of a piece its best template (-1: none), that one's cosine, and the share of words that license units cover."""
    size, n = piece.hi - piece.lo, len(piece.start)
    best, top, share = np.full(size, -1), np.zeros(size), np.zeros(size)
    if not n:
        return best, top, share
    ids = piece.hashes()
    col = columns_of(model.words, ids)
    weight = model.idf[col]
    squares = np.append(0.0, np.cumsum(weight**2))
    on = np.flatnonzero(col < len(model.words))
    here = col[on]
    before = np.append(0, np.cumsum(col < len(model.words)))
    text = np.repeat(np.arange(size), piece.count)
    # lines and paragraphs: both grow from text to text, so those of different texts differ
    breaks = np.flatnonzero(piece.buf == 0x0A)
    line = np.searchsorted(breaks, piece.start) + text
    blank = breaks[:-1][_blank_between(piece.buf, breaks)] if len(breaks) > 1 else breaks[:0]
    paragraph = np.searchsorted(blank, piece.start) + text
    units = [(np.append(e, n)[:-1], np.append(e[1:], n), np.cumsum(np.append(True, np.diff(x) != 0)) - 1) for x in (line, paragraph, text) for e in [np.flatnonzero(np.append(True, np.diff(x) != 0))]]
    covered = np.zeros(n + 1, np.int64)
    for k in range(len(model.names)):
        at = on[model.anchors[k][here]]
        if not len(at):
            continue
        length, last = int(model.lengths[k]), model.names[k] == "Proprietary"
        begin = np.unique((at[:, None] - np.arange(length)).ravel())
        begin = begin[(begin >= 0) & (begin + length <= n)]
        begin = begin[text[begin] == text[begin + length - 1]]
        lo, hi = [begin], [begin + length]
        for first, end, unit in units:
            some = np.unique(unit[at])
            lo.append(first[some])
            hi.append(end[some])
        lo, hi = np.concatenate(lo), np.concatenate(hi)
        dots = np.append(0.0, np.cumsum(weight[on] * model.vectors[k][here]))
        dot = dots[before[hi]] - dots[before[lo]]
        may = dot >= (model.least[k] - 1e-6) * np.sqrt(squares[hi] - squares[lo])
        lo, hi, dot = lo[may], hi[may], dot[may]
        if not len(lo):
            continue
        cosine = np.round(np.minimum(dot / np.sqrt(_runs(ids, weight, lo, hi - lo)), 1.0), 9)
        sure = cosine >= model.least[k]
        lo, hi, cosine = lo[sure], hi[sure], cosine[sure]
        np.add.at(covered, lo, 1)
        np.add.at(covered, hi, -1)
        found = np.zeros(size)
        np.maximum.at(found, text[lo], cosine)
        better = (found > top) & ((not last) | (best < 0) | np.array([model.names[b] == "Proprietary" for b in best.tolist()]))
        best[better], top[better] = k, found[better]
    inside = np.cumsum(covered)[:-1] > 0
    share = np.bincount(text, inside, minlength=size) / np.maximum(1, piece.count)
    return best, top, share


def _blank_between(buf: np.ndarray, breaks: np.ndarray) -> np.ndarray:
    """Whether only spaces stand between each line end and the next."""
    black = np.append(0, np.cumsum(buf > 0x20))
    return black[breaks[1:]] == black[breaks[:-1]]


def own_licenses(docs: DataFrame) -> DataFrame:
    """(doc_id, path, license, cosine, share) of each row of docs (doc_id, path, text); without a license it is null, at cosine 0."""
    ship(docs.sparkSession)
    model = fitted(*document_frequencies(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, cosine, share = [], [np.zeros(0)], [np.zeros(0)]
            for piece in pieces(batch.column(2), NOT_ALNUM):
                best, top, covered = _scan(model, piece)
                label += [model.names[k] if k >= 0 else None for k in best.tolist()]
                cosine.append(top)
                share.append(covered)
            columns = [batch.column(0), batch.column(1), pa.array(label, pa.string()), pa.array(np.concatenate(cosine)), pa.array(np.concatenate(share))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "path", "license", "cosine", "share"])

    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("path").cast("string").alias("path"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(run, "doc_id bigint, path string, license string, cosine double, share double")


def scan_licenses(docs: DataFrame) -> DataFrame:
    """(doc_id, path, license, cosine, origin) of each row of docs (doc_id, path, text).

    origin is own, inherited or none. Directories are split at '/'; '' is the root of them all. Of a directory's license files
    the one of the smallest path, then license, speaks for it. A null path inherits nothing; a null, empty or blank text has no license of its own.
    Equal cosines go to the first template; a license goes before the mere reservation of rights. Repeated rows get equal results; other columns aren't read.
    """
    own = checkpointed(own_licenses(docs).withColumn("row", F.monotonically_increasing_id()))
    folder = F.when(F.contains("path", F.lit("/")), F.regexp_replace("path", "/[^/]*$", "")).otherwise(F.when(F.col("path").isNotNull(), F.lit("")))
    base = F.regexp_replace("path", "^.*/", "")
    own = own.withColumn("folder", folder)
    files = own.where(F.col("license").isNotNull() & F.col("folder").isNotNull() & ((F.col("share") >= FILE_SHARE) | base.rlike(LICENSE_FILES)))
    files = files.groupBy("folder").agg(F.min(F.struct("path", "license")).alias("x")).select("folder", F.col("x.license").alias("given"))
    # the folders above: prefixes of the path's parts, with their depth
    folders = own.where("license is null and folder is not null").select("folder").distinct()
    parts = F.split("folder", "/")
    above = folders.select(F.col("folder").alias("from"), F.posexplode(F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))).alias("depth", "folder"))
    near = above.join(files, "folder").groupBy("from").agg(F.max(F.struct("depth", "given")).alias("x")).select(F.col("from").alias("folder"), F.col("x.given").alias("given"))
    lacking = own.where("license is null").join(near, "folder", "left")
    got = own.where("license is not null").select("doc_id", "path", "license", "cosine", F.lit("own").alias("origin"))
    return got.unionAll(lacking.select("doc_id", "path", "given", "cosine", F.when(F.col("given").isNotNull(), "inherited").otherwise("none")))
