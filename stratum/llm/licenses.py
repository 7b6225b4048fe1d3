"""License scans: TF-IDF cosine to templates, then inheritance along paths.

Every line of a file, its whole text and every run of words as long as a
template around a word of license language are compared with templates, the
notices and the licenses' own texts, as sparse TF-IDF vectors.  So a notice
counts however it is wrapped, marked as a comment or surrounded.  Files without a notice of their own take over the
license of the nearest directory above them that holds a license file.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import stored

# Notices by SPDX identifier (fixed values, as the licenses word them)
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction.",
        "SPDX-License-Identifier: MIT",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "CC-BY-4.0": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ),
    "CC-BY-NC-4.0": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
    ),
    # close to those above in wording, so that they are not taken for them
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version.",
        "SPDX-License-Identifier: GPL-2.0-or-later",
    ),
    "LGPL-2.0": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Library "
        "General Public License as published by the Free Software Foundation; either version 2 of the License, or (at "
        "your option) any later version.",
        "SPDX-License-Identifier: LGPL-2.0-or-later",
    ),
    "LGPL-2.1": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
        "(at your option) any later version.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ),
    "LGPL-3.0": (
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version.",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
    ),
    "AGPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version.",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ),
    "MPL-1.1": (
        "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not "
        "use this file except in compliance with the License.",
        "SPDX-License-Identifier: MPL-1.1",
    ),
    "BSD-2-Clause": ("SPDX-License-Identifier: BSD-2-Clause",),
    "CC-BY-SA-4.0": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
    ),
}
_gnu = (
    "GNU {}GENERAL PUBLIC LICENSE Version {} Copyright (C) {} Free Software Foundation, Inc. {} Everyone is permitted to "
    "copy and distribute verbatim copies of this license document, but changing it is not allowed."
)
_street = "51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA"
_bsd = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
    "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
    "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution. {}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY "
    "EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS "
    "FOR A PARTICULAR PURPOSE ARE DISCLAIMED."
)
_cc = (
    "By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and conditions of "
    "this Creative Commons {} 4.0 International Public License (\"Public License\")."
)
# The licenses themselves: their openings, of short ones the conditions too
TEXTS = {
    "Apache-2.0": (
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, "
        "REPRODUCTION, AND DISTRIBUTION 1. Definitions. \"License\" shall mean the terms and conditions for use, "
        "reproduction, and distribution as defined by Sections 1 through 9 of this document.",
    ),
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
    ),
    "GPL-3.0": (_gnu.format("", "3, 29 June 2007", "2007", "https://fsf.org/"),),
    "BSD-3-Clause": (
        _bsd.format(
            "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
            "promote products derived from this software without specific prior written permission. "
        ),
    ),
    "MPL-2.0": (
        "Mozilla Public License Version 2.0 1. Definitions 1.1. \"Contributor\" means each individual or legal entity "
        "that creates, contributes to the creation of, or owns Covered Software.",
    ),
    "CC-BY-4.0": (_cc.format("Attribution"),),
    "CC-BY-NC-4.0": (_cc.format("Attribution-NonCommercial"),),
    "GPL-2.0": (_gnu.format("", "2, June 1991", "1989, 1991", _street),),
    "LGPL-2.0": (_gnu.format("LIBRARY ", "2, June 1991", "1991", _street),),
    "LGPL-2.1": (_gnu.format("LESSER ", "2.1, February 1999", "1991, 1999", _street),),
    "LGPL-3.0": (_gnu.format("LESSER ", "3, 29 June 2007", "2007", "https://fsf.org/"),),
    "AGPL-3.0": (_gnu.format("AFFERO ", "3, 19 November 2007", "2007", "https://fsf.org/"),),
    "GFDL-1.3": (
        "GNU Free Documentation License Version 1.3, 3 November 2008 Copyright (C) 2000, 2001, 2002, 2007, 2008 Free "
        "Software Foundation, Inc. https://fsf.org/ Everyone is permitted to copy and distribute verbatim copies of this "
        "license document, but changing it is not allowed.",
    ),
    "BSD-2-Clause": (_bsd.format(""),),
    "CC-BY-SA-4.0": (_cc.format("Attribution-ShareAlike"),),
}
# What tells a license from others of like wording; inside a longer text a template's must all be there
NAMES = {"apache", "mit", "gnu", "mozilla", "commons", "cc"}
MORE = {"lesser", "library", "affero", "documentation", "1.1", "1.3", "2", "2.0", "2.1", "3", "4.0", "attribution", "attribution-noncommercial"}
MORE |= {"attribution-sharealike", "by", "by-nc", "by-sa"}
STEMS = ("licen", "permi", "redistribut")
LICENSE_FILE = r"(?i)(^|/)(licen[sc]e|copying|notice)[^/]*$"
MATCHES = "doc_id long, path string, declared string, similarity double"
_token = re.compile(r"[^\W_]+(?:[-.][^\W_]+)*")
_wrapped = re.compile(r"(?<=[^\W_])-[ \t]*\n[\s#*/;%!>-]*(?=[^\W_])")  # a line that ends inside a hyphenated word
_comment = re.compile(r"^[ \t]*(?:dnl|rem)\b", re.M)  # comment marks that are words


def tokens(text: str) -> list[str]:
    return _token.findall(text.lower())


class TemplateIndex:
    """Unit TF-IDF vectors of the templates over their own words.

    A word outside the templates has the weight of a word seen in no document;
    it only lengthens a text's vector.
    """

    def __init__(
        self,
        frequency: dict[str, int],
        documents: int,
        templates: dict[str, tuple[str, ...]] = TEMPLATES,
        licenses: dict[str, tuple[str, ...]] = TEXTS,
    ):
        both = [(name, text) for named in (templates, licenses) for name, texts in named.items() for text in texts]
        self.names = [name for name, _ in both]
        listed = [tokens(text) for _, text in both]
        counts = [Counter(words) for words in listed]
        self.words = {w: i for i, w in enumerate(sorted({w for c in counts for w in c}))}
        self.idf = np.array([np.log((1 + documents) / (1 + frequency.get(w, 0))) + 1 for w in self.words])
        self.other = np.log(1 + documents) + 1
        self.matrix = np.array([[c[w] for w in self.words] for c in counts]) * self.idf
        self.matrix /= np.linalg.norm(self.matrix, axis=1, keepdims=True)
        # licenses' texts, and the notices that such texts begin with: those don't decide beside the texts
        first = sum(map(len, templates.values()))
        self.whole = np.arange(len(both)) >= first
        opening = [words == text[: len(words)] for words in listed[:first] for text in listed[first:]]
        self.opens = np.append(np.reshape(opening, (first, -1)).any(1), [False] * (len(both) - first))
        self.named = [
            set(words) if words[0].startswith("spdx") else (NAMES | MORE) & set(words) if NAMES & set(words) else set()
            for words in listed
        ]
        # a library is a program too, so that word only tells which GNU license
        self.named = [n - {"library"} if n & {"lesser"} else n for n in self.named]
        self.places: dict[str, list[tuple[int, int]]] = {}  # by word of license language: place and length of its run
        for words in listed:
            for at, word in enumerate(words):
                if self.telling(word) and (at, len(words)) not in self.places.setdefault(word, []):
                    self.places[word].append((at, len(words)))
        self.seen: dict[tuple[str, ...], np.ndarray] = {}

    @staticmethod
    def telling(text: str) -> bool:
        """Whether a text has a stem that every template has; without one it is no notice."""
        return any(stem in text for stem in STEMS)

    def cosines(self, words: Sequence[str]) -> np.ndarray:
        """Cosine of a run of words to each template."""
        found = Counter(words)
        known = [(self.words[w], n) for w, n in found.items() if w in self.words]
        outside = sum(n * n for w, n in found.items() if w not in self.words) * self.other**2
        at, weight = np.array([k for k, _ in known], int), np.array([n for _, n in known], float)
        weight = weight * self.idf[at]
        return self.matrix[:, at] @ weight / max(float(np.sqrt(weight @ weight + outside)), 1e-300)

    def runs(self, text: str) -> set[tuple[str, ...]]:
        """Runs of words as long as a template that have one of its words of license language in its place."""
        words = tokens(_wrapped.sub("-", _comment.sub("", text)))
        return {
            tuple(words[max(i - at, 0) : i - at + size])
            for i, word in enumerate(words)
            for at, size in self.places.get(word, ())
            if i - at + size > 0
        }

    def best(self, text: str) -> np.ndarray:
        """Highest cosine of a line, a run or the whole text to each template."""
        lines = text.split("\n")
        parts = [*filter(self.telling, lines), text] if len(lines) > 1 else lines
        best = np.max([self.cosines(tokens(part)) for part in parts], axis=0)
        for run in self.runs(text):
            if run not in self.seen:
                if len(self.seen) >= 20_000:
                    self.seen.clear()
                there = set(run)
                self.seen[run] = np.where([n <= there for n in self.named], self.cosines(run), 0)
            best = np.maximum(best, self.seen[run])
        return best

    def declared(self, text: str, threshold: float) -> tuple[str | None, float]:
        """The license of the most similar template, if similar enough, and the similarity; ties go to the first."""
        best = self.best(text)
        if (best[self.whole] >= threshold).any():
            best = np.where(self.opens, 0, best)
        i = int(best.argmax())
        return self.names[i] if best[i] >= threshold else None, float(best[i])


def word_frequencies(texts: DataFrame, words: set[str]) -> tuple[dict[str, int], int]:
    """Documents that have each of ``words``, over all rows, and their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str | None] = Counter()
        for batch in batches:
            for text in batch.column(0):
                total.update(words.intersection(tokens(text.as_py() or "")))
                total[None] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"]
        )

    rows = texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {r.word: r.n for r in rows if r.word is not None}, sum(r.n for r in rows if r.word is None)


def declared_licenses(files: DataFrame, threshold: float) -> DataFrame:
    """``doc_id, path, declared, similarity``: the license that a line, a run of words or the whole text declares."""
    vocabulary = {w for named in (TEMPLATES, TEXTS) for texts in named.values() for text in texts for w in tokens(text)}
    index = TemplateIndex(*word_frequencies(files.select("text"), vocabulary))

    def match(text: str) -> tuple[str | None, float]:
        text = text.lower()
        return index.declared(text, threshold) if index.telling(text) else (None, 0.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [match(t.as_py() or "") for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([m[0] for m in made], pa.string()),
                    pa.array([m[1] for m in made], pa.float64()),
                ],
                names=["doc_id", "path", "declared", "similarity"],
            )

    return files.mapInArrow(run, MATCHES)


def directory(path: Column) -> Column:
    return F.regexp_replace(path, r"/?[^/]*$", "")


def scan_licenses(
    files: DataFrame,
    *,
    path: Column | None = None,
    threshold: float = 0.75,
    license_file: str = LICENSE_FILE,
) -> DataFrame:
    """``doc_id, path, declared, similarity, license, inherited_from`` per row of ``files`` (doc_id, text, path).

    ``license`` is the declared one, else that of the nearest directory at or
    above the file's own with a license file (its name fits ``license_file``),
    whose directory is ``inherited_from``; null if there is none.  Of several
    license files in a directory the one with the highest similarity counts,
    then the least path.

    A null or empty text declares nothing; a null path is the root directory.
    Repeated rows are judged each; an empty table gives no rows; other columns
    are ignored.
    """
    where = F.coalesce((files["path"] if path is None else path).cast("string"), F.lit(""))
    rows = files.select(
        files["doc_id"].cast("long").alias("doc_id"), where.alias("path"), files["text"].cast("string").alias("text")
    )
    matched = stored(declared_licenses(rows, threshold), "licenses").withColumn("dir", directory(F.col("path")))
    of_dir = (
        matched.filter(F.col("declared").isNotNull() & F.col("path").rlike(license_file))
        .groupBy("dir")
        .agg(F.min(F.struct(-F.col("similarity"), "path", "declared")).alias("first"))
        .select("dir", F.col("first.declared").alias("of_dir"))
    )
    # each directory once: its ancestors, itself last, by depth
    parts = F.split("dir", "/")
    depths = F.sequence(F.lit(0), F.when(F.col("dir") == "", 0).otherwise(F.size(parts)))
    above = (
        matched.select("dir")
        .distinct()
        .select("dir", F.explode(depths).alias("depth"))
        .select("dir", "depth", F.array_join(F.slice(F.split("dir", "/"), 1, F.col("depth")), "/").alias("up"))
    )
    nearest = (
        above.join(of_dir.withColumnRenamed("dir", "up"), "up")
        .groupBy("dir")
        .agg(F.max(F.struct("depth", "up", "of_dir")).alias("near"))
        .select("dir", F.col("near.up").alias("up"), F.col("near.of_dir").alias("of_dir"))
    )
    joined = matched.join(stored(nearest, "license-dirs"), "dir", "left")
    return joined.select(
        "doc_id",
        "path",
        "declared",
        "similarity",
        F.coalesce("declared", "of_dir").alias("license"),
        F.when(F.col("declared").isNull(), F.col("up")).alias("inherited_from"),
    )
