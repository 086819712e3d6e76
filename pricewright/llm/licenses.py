"""License scans: TF-IDF cosine to templates, then inheritance along directories.

Templates are whole short licences, the standard headers of long ones, one-line
notices and SPDX tags. For each template, every stretch of as many words as it
has is compared by the cosine of sparse TF-IDF vectors, so a header is found
over several lines, inside a licence file or in the middle of a line. Document
frequencies of all words of the corpus are counted: those of template words one
by one, all others in a bounded hash table, whose counts are never too low.
Files without a notice take the licence of the nearest directory above them
that has a licence file.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .common import attach, shielded, stored, text_or_empty
from .textbatch import WORDLIKE, TextBatch, chunks

LEAST_COSINE = 0.75
#: Tags differ in one word, which has to be the right one.
LEAST_TAG_COSINE = 0.999
#: Counters of the document frequencies of other words; words of one counter are counted together.
FREQUENCY_BITS = 16

# Short licences, headers and notices of common licences.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software
and associated documentation files (the "Software"), to deal in the Software without restriction,
including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense,
and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
subject to the following conditions: The above copyright notice and this permission notice shall be
included in all copies or substantial portions of the Software."""),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "you may not use this file except in compliance with the Apache License"),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,
software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
CONDITIONS OF ANY KIND, either express or implied."""),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the
GNU General Public License as published by the Free Software Foundation, either version 3 of the License,
or (at your option) any later version."""),
    ("GPL-2.0", """This program is free software; you can redistribute it and/or modify it under the terms of the
GNU General Public License as published by the Free Software Foundation; either version 2 of the License,
or (at your option) any later version."""),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0", """This library is free software: you can redistribute it and/or modify it under the terms of the
GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the
License, or (at your option) any later version."""),
    ("LGPL-2.1", """This library is free software; you can redistribute it and/or modify it under the terms of the
GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the
License, or (at your option) any later version."""),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the
GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the
License, or (at your option) any later version."""),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("BSD-2-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met: 1. Redistributions of source code must retain the above
copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form
must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE
COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES"""),
    ("BSD-3-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met: 1. Redistributions of source code must retain the above
copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form
must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright
holder nor the names of its contributors may be used to endorse or promote products derived from this
software without specific prior written permission."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee
is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."""),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("EPL-2.0", """This program and the accompanying materials are made available under the terms of the Eclipse Public
License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0"""),
    ("EPL-1.0", """All rights reserved. This program and the accompanying materials are made available under the terms
of the Eclipse Public License v1.0 which accompanies this distribution"""),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    *((name, f"SPDX-License-Identifier: {name}") for name in (
        "MIT", "Apache-2.0", "GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later",
        "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0",
        "AGPL-3.0-only", "AGPL-3.0-or-later", "BSD-2-Clause", "BSD-3-Clause", "ISC", "MPL-2.0", "EPL-1.0", "EPL-2.0",
        "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "CC0-1.0", "Unlicense")),
)
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|notice|unlicense)([._-].*)?$"


def _words(texts: list[str]) -> tuple[TextBatch, np.ndarray]:
    """Words of lower-cased letters and digits, and their hashes."""
    batch = TextBatch([t.lower().encode() for t in texts], WORDLIKE)
    return batch, batch.word_hashes() if len(batch.begin) else np.zeros(0, dtype=np.uint64)


class Notices:
    """Template vectors over the sorted hashes of their terms."""

    def __init__(self, templates=TEMPLATES):
        self.names = [n for n, _ in templates]
        self.least = np.array([LEAST_TAG_COSINE if t.startswith("SPDX") else LEAST_COSINE for _, t in templates])
        batch, hashes = _words([t for _, t in templates])
        self.sizes = np.diff(batch.first)
        self.terms, column = np.unique(hashes, return_inverse=True)
        self.counts = np.zeros((len(templates), len(self.terms)))
        np.add.at(self.counts, (batch.doc, column), 1.0)

    def columns(self, hashes: np.ndarray) -> np.ndarray:
        """Index of each hash among the terms, -1 for other words."""
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return np.where(self.terms[at] == hashes, at, -1)

    def counters(self, hashes: np.ndarray) -> np.ndarray:
        """The counter of each word: one of its own for a term, a shared one otherwise."""
        at = self.columns(hashes)
        shared = (hashes >> np.uint64(64 - FREQUENCY_BITS)).astype(np.int64)
        return np.where(at >= 0, (1 << FREQUENCY_BITS) + at, shared)


def document_frequencies(docs: DataFrame, notices: Notices) -> tuple[int, np.ndarray]:
    """(documents, how many hold a word of each counter), over all rows of ``text``."""
    plain, size = vars(notices), (1 << FREQUENCY_BITS) + len(notices.terms)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Notices.__new__(Notices)
        vars(known).update(plain)
        total, n = np.zeros(size, dtype=np.int64), 0
        for part in chunks(batches):
            batch, hashes = _words(part["text"].tolist())
            pairs = np.unique(known.counters(hashes) * len(part) + batch.doc)
            total += np.bincount(pairs // len(part), minlength=size)
            n += len(part)
        full = np.flatnonzero(total)
        yield pd.DataFrame({"counter": np.r_[full, -1], "n": np.r_[total[full], n]})

    # one row per counter, however many words there are
    counts = docs.select("text").mapInPandas(count, "counter int, n long").groupBy("counter").agg(F.sum("n").alias("n"))
    out = np.zeros(size + 1, dtype=np.int64)
    for counter, n in counts.toLocalIterator():
        out[counter] = n        # -1 is the last place
    return int(out[-1]), out[:-1]


def best_notices(texts: list[str], known: Notices, idf: np.ndarray) -> list[tuple]:
    """(licence, cosine, line) of the best stretch of each text; nulls where none is close enough.

    ``idf``: weight of each counter. Of equal cosines the longest template, then the first
    template, then the first place wins.
    """
    best: list[tuple] = [(None, None, None)] * len(texts)
    batch, hashes = _words(texts)
    if not len(hashes):
        return best
    weight = idf[known.counters(hashes)]
    term_weight = idf[known.counters(known.terms)]
    vectors = known.counts * term_weight
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    at = known.columns(hashes)
    inside = np.flatnonzero(at >= 0)
    if not len(inside):
        return best
    present = np.zeros(len(known.terms), dtype=bool)
    present[at[inside]] = True
    square = np.concatenate([[0.0], np.cumsum(weight * weight)])
    stop = batch.first[batch.doc + 1]
    breaks = np.concatenate([[0], np.cumsum(batch.data == 10)])
    for t in np.argsort(-known.sizes, kind="stable").tolist():
        size = int(known.sizes[t])
        # a stretch without such a word of the template is too far from it
        needed = vectors[t] > np.sqrt(1 - known.least[t] ** 2) + 1e-9
        if not present[needed].all():
            continue
        share = np.zeros(len(hashes) + 1)
        share[inside + 1] = vectors[t, at[inside]] * weight[inside]
        np.cumsum(share, out=share)
        begin = inside[vectors[t, at[inside]] > 0]      # a best stretch begins with a word of the template
        end = np.minimum(begin + size, stop[begin])
        # repeated words make a norm longer than this one, so no stretch is left out
        bound = (share[end] - share[begin]) / np.sqrt(square[end] - square[begin])
        likely = np.flatnonzero(bound >= known.least[t] * 0.9999)
        for i, j, dot in zip(begin[likely].tolist(), end[likely].tolist(), (share[end] - share[begin])[likely].tolist()):
            _, first, times = np.unique(hashes[i:j], return_index=True, return_counts=True)
            cosine = dot / float(np.sqrt(((times * weight[i:j][first]) ** 2).sum()))
            d = int(batch.doc[i])
            if cosine >= known.least[t] and (best[d][1] is None or cosine > best[d][1] + 1e-12):
                line = int(breaks[batch.begin[i]] - breaks[batch.starts[d]])
                best[d] = (known.names[t], min(1.0, cosine), line)
    return best


def with_notice(docs: DataFrame) -> DataFrame:
    """Columns of ``docs`` but text, plus licence, similarity and line (of its first word) of the best notice.

    Null where no stretch reaches the cosine.
    """
    notices = Notices()
    n, found = document_frequencies(docs, notices)
    idf = np.log((n + 1) / (found + 1)) + 1
    sent = docs.sparkSession.sparkContext.broadcast((vars(notices), idf))
    names = [c for c in docs.columns if c not in ("licence", "similarity", "line")]
    kept = [c for c in names if c != "text"]
    schema = T.StructType(docs.select(*kept).schema.fields + T.StructType.fromDDL(
        "licence string, similarity double, line long").fields)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        plain, idf = sent.value
        known = Notices.__new__(Notices)
        vars(known).update(plain)
        for part in chunks(batches):
            out = part[kept].copy()
            out["licence"], out["similarity"], out["line"] = zip(*best_notices(part["text"].tolist(), known, idf))
            out["line"] = out["line"].astype("Int64")
            out["similarity"] = out["similarity"].astype("float64")
            yield out

    return docs.select(*names).mapInPandas(run, schema)


@shielded("dir", "files", "near", "given", "given_dir")
def scan_licences(files: DataFrame) -> DataFrame:
    """All columns of ``files`` (path, text, ...) but text, plus licence,
    own_licence, similarity, line and inherited_from.

    A file's own notice comes first; otherwise the licence file in the nearest
    directory above counts (its own directory included; of several the first
    path). Null paths inherit nothing; null texts have no notice; without
    either licence is null.
    """
    names = [c for c in files.columns if c not in ("own_licence", "inherited_from")]
    rows = files.select(*[c for c in names if c != "text"], text_or_empty().alias("text"))
    rows = rows.withColumn("dir", F.regexp_replace("path", "/?[^/]*$", ""))
    rows = stored(with_notice(rows).withColumnRenamed("licence", "own_licence"), "licences")
    name = F.regexp_extract("path", "([^/]*)$", 1)
    given = rows.where(name.rlike(LICENCE_FILE) & F.col("own_licence").isNotNull()).groupBy(
        F.col("dir").alias("given_dir")).agg(F.min_by("own_licence", "path").alias("given"))
    dirs = rows.where("dir IS NOT NULL").groupBy("dir").agg(F.count("*").alias("files"))
    parts = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda d: F.array_join(F.slice(parts, 1, d), "/"))
    nearest = dirs.select("dir", "files", F.posexplode(above).alias("depth", "given_dir")).join(given, "given_dir")
    nearest = nearest.groupBy("dir").agg(
        F.max("files").alias("files"), F.max_by(F.struct("given", "given_dir"), "depth").alias("near"))
    nearest = stored(dirs.join(nearest.drop("files"), "dir", "left"), "licence-dirs")
    out = attach(rows, nearest, ["dir"], "files", rows.count()).unionByName(
        rows.where("dir IS NULL").withColumns({"files": F.lit(1).cast("long"), "near": F.lit(None).cast(nearest.schema["near"].dataType)}))
    own = F.col("own_licence").isNotNull()
    return out.select(
        *[c for c in rows.columns if c != "dir"], F.coalesce("own_licence", "near.given").alias("licence"),
        F.when(~own, F.col("near.given_dir")).alias("inherited_from"))


def document_paths(docs: DataFrame) -> DataFrame:
    """doc_id, path, text: the table has no paths, so sources are taken as
    repositories with directories of 5,000, 500 and 25 documents. The first
    document of each is a licence file, of the largest directory it begins."""
    i = F.col("doc_id").cast("long")
    top = F.coalesce(F.col("source").cast("string"), F.lit(""))
    levels = [F.floor(i / size).cast("string") for size in (5000, 500, 25)]
    path = F.concat_ws("/", top, *levels, F.concat(i.cast("string"), F.lit(".txt")))
    for size, depth in ((25, 3), (500, 2), (5000, 1)):
        path = F.when(i % size == 0, F.concat_ws("/", top, *levels[:depth], F.lit("LICENSE"))).otherwise(path)
    return docs.select(i.alias("doc_id"), F.when(i.isNotNull(), path).alias("path"), "text")
