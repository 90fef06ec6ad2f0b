"""Licence scan: sparse TF-IDF cosine to templates, then inheritance from the nearest ancestor directory.

A passage is a line of a text, a window of as many words as a long template has, or the
whole text; windows go over line breaks and comment signs. A passage's sparse vector over words
(term frequency times inverse document frequency, counted over all lines of all texts)
is compared with the vectors of the templates. A passage names the licence of its most
similar template (``least_cosine`` or more) whose marks it has: the words, such as
a version or "affero", that tell licences of nearly the same wording apart. A
passage that denies the licence names none. A text's own licence is that of its most similar passage.

A text that as a whole is that much like a template, or holds the full text or the heading of a
licence, is a licence file, as is a caller's choice of rows: its licence holds
for its directory. A text without a licence of its own inherits from the nearest
directory above it that has one, found by joining the ancestors of each directory,
not of each file, with the licensed directories. Directories that hold a large
part of all texts keep their rows where they are in the last join.

Only template words can add to a cosine's numerator, so just their frequencies
are gathered: a row per template word reaches the driver. Other words count in
a passage's length with the largest weight.

Defined results: null or empty texts have no licence of their own and may
inherit; a null path is the root directory; of several licence files of a
directory the most similar counts, ties go to the first name; equal cosines go
to the first licence name; repeated rows are scanned row by row; texts and
lines of any length are taken whole. Extra columns never clash with the
results.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidyspark.llm.common import append_struct, broadcast_value, fresh_name, ship_code, text_slices, worker_cached, write_stage
from tidyspark.operators.facts import lookup_spread

WORDS = re.compile(r"[a-z0-9.]*[a-z0-9]")

# Public licence notices (standard headers and usual one-line statements).
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except "
                   "in compliance with the License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are "
                     "permitted provided that the following conditions are met:"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International "
                     "License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "The author has dedicated the work to the public domain under CC0 1.0 Universal."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the "
                "License, or (at your option) any later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                 "Affero General Public License as published by the Free Software Foundation, either version 3 of the "
                 "License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation; either version 2 of the "
                "License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
                 "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of "
                 "the License, or (at your option) any later version."),
    ("LGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                 "Lesser General Public License as published by the Free Software Foundation, either version 3 of the "
                 "License, or (at your option) any later version."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("ISC", "Released under the ISC License."),
]

_AS_IS = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
          "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
          "PARTICULAR PURPOSE ARE DISCLAIMED.")
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
        "other materials provided with the distribution. ")
# What only a licence's own file holds, its full text (of short licences) or its heading.
FILE_TEMPLATES = [
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 Copyright (C) 2007 Free Software "
                 "Foundation, Inc."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR "
                   "USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions."),
    ("BSD-2-Clause", _BSD + _AS_IS),
    ("BSD-3-Clause", _BSD + "3. Neither the name of the copyright holder nor the names of its contributors may be used "
                            "to endorse or promote products derived from this software without specific prior written "
                            "permission. " + _AS_IS),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999 Copyright (C) 1991, 1999 Free Software "
                 "Foundation, Inc."),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software "
                 "Foundation, Inc."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
            "following conditions: The above copyright notice and this permission notice shall be included in all "
            "copies or substantial portions of the Software."),
    ("MPL-2.0", "Mozilla Public License Version 2.0 1. Definitions 1.1. Contributor means each individual or legal "
                "entity that creates, contributes to the creation of, or owns Covered Software."),
]
# Words that a passage naming the licence has, and words it has not.
MARKS = {
    "AGPL-3.0": ("affero 3", ""), "Apache-2.0": ("apache 2.0", ""), "BSD-2-Clause": ("", "endorse 3"),
    "CC-BY-4.0": ("4.0", "sa nc noncommercial sharealike"), "CC-BY-NC-4.0": ("4.0", "sa sharealike"),
    "CC-BY-SA-4.0": ("sa 4.0", "nc noncommercial"), "GPL-2.0": ("general 2", "affero lesser 3"),
    "GPL-3.0": ("general 3", "affero lesser 2"), "LGPL-2.1": ("lesser 2.1", "affero"),
    "LGPL-3.0": ("lesser 3", "affero 2.1"), "MPL-2.0": ("mozilla 2.0", ""),
}
# A passage that says the licence does not hold.
DENIED = re.compile(r"\b(?:not|never|isn't|aren't|no longer)(?: \w+){0,2} (?:released|licensed|distributed|available|"
                    r"covered|published|under)\b")
SHORT = 12                     # words; longer templates are also compared with windows


def words_of(passage: str) -> list[str]:
    return WORDS.findall(passage.lower())


class Comparer:
    """Cosines of passages to templates, given the number of lines and of lines with each template word."""

    def __init__(self, templates: list[tuple[str, str]], lines: int, with_word: dict[str, int]):
        self.rarest = math.log(1 + lines) + 1
        vocabulary = {w for _, t in templates for w in words_of(t)}
        self.idf = {w: math.log((1 + lines) / (1 + with_word.get(w, 0))) + 1 for w in vocabulary}
        self.vectors = []
        self.having: dict[str, list] = {}
        for k, (name, t) in enumerate(templates):
            weight = {w: n * self.idf[w] for w, n in Counter(words_of(t)).items()}
            length = math.sqrt(sum(x * x for x in weight.values()))
            self.vectors.append((name, length))
            for w, x in weight.items():
                self.having.setdefault(w, []).append((k, x))

    def best(self, passage: str) -> tuple[float, str]:
        """(cosine, licence) of the most similar template, or (0.0, '')."""
        found = self.ranked(Counter(words_of(passage)))
        return (-found[0][0], found[0][1]) if found else (0.0, "")

    def named(self, words: list[str], around: set[str]) -> tuple[float, str]:
        """(cosine, licence) of the most similar template whose marks the passage has, or (0.0, '').

        ``around``: the words of the whole text, for a clause that stands in another passage.
        """
        counts = Counter(words)
        for cosine, name in self.ranked(counts):
            needed, excluded = (set(m.split()) for m in MARKS.get(name, ("", "")))
            if name == "BSD-3-Clause" and not {"endorse", "3"} & around:
                name = "BSD-2-Clause"
            elif not needed <= counts.keys() or excluded & counts.keys():
                continue
            elif name == "BSD-2-Clause" and "endorse" in around:
                continue
            return (0.0, "") if DENIED.search(" ".join(words)) else (-cosine, name)
        return 0.0, ""

    def ranked(self, counts: Counter) -> list[tuple[float, str]]:
        """(-cosine, licence) of all templates with a word of the passage, the most similar first."""
        products: dict[int, float] = {}
        length = 0.0
        for w, n in counts.items():
            x = n * self.idf.get(w, self.rarest)
            length += x * x
            for k, y in self.having.get(w, ()):
                products[k] = products.get(k, 0.0) + x * y
        length = math.sqrt(length)
        # of equal cosines the first name
        return sorted((-round(p / (length * self.vectors[k][1]), 9), self.vectors[k][0]) for k, p in products.items())


class Windows:
    """Long templates against windows of as many words, a quarter of a window apart."""

    def __init__(self, templates: list[tuple[str, str, bool]], lines: int, with_word: dict[str, int]):
        self.of = []
        for name, text, is_file in templates:
            words = words_of(text)
            if len(words) > SHORT:
                one = Comparer([(name, text)], lines, with_word)
                weight = {w: (n * one.idf[w]) ** 2 for w, n in Counter(words).items()}
                self.of.append((len(words), one, weight, sum(weight.values()), is_file))

    def best(self, words: list[str], least: float) -> tuple[float, str, bool]:
        """(cosine, licence, only in a licence's file) of the best window, or (0.0, '', False).

        A cosine of ``least`` needs words with ``least`` squared of the template's squared length.
        """
        around, found = set(words), (0.0, "", False)
        for n, one, weight, whole, is_file in self.of:
            if sum(weight[w] for w in weight.keys() & around) < least * least * whole:
                continue
            for at in range(0, max(1, len(words) - n + n // 4), max(1, n // 4)):
                cosine, name = one.named(words[at:at + n], around)
                found = max(found, (cosine, name, is_file))
        return found


FIELDS = T.StructType([T.StructField("own", T.StringType()), T.StructField("own_score", T.DoubleType()),
                       T.StructField("whole", T.StringType()), T.StructField("whole_score", T.DoubleType())])


def _count_lines(vocabulary: frozenset):
    def run(batches):
        for whole in batches:
            for b in text_slices(whole, "text"):
                found, lines = Counter(), 0
                for t in b.column(0).to_pylist():
                    if t:
                        parts = t.lower().split("\n")
                        lines += len(parts)
                        for line in parts:
                            found.update(vocabulary.intersection(WORDS.findall(line)))
                found[""] = lines
                yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()),
                                                  pa.array(list(found.values()), pa.int64())], names=["word", "n"])
    return run


def own_licences(df: DataFrame, text: str = "text", templates: list[tuple[str, str]] = TEMPLATES,
                 least_cosine: float = 0.6, keep: list[str] | None = None,
                 file_templates: list[tuple[str, str]] = FILE_TEMPLATES) -> tuple[DataFrame, str]:
    """Append a struct: the text's own licence, and the one it is the file of, each null below the threshold."""
    spark = df.sparkSession
    ship_code(spark)
    long = [(n, t, False) for n, t in templates] + [(n, t, True) for n, t in file_templates]
    vocabulary = frozenset(w for _, t, _ in long for w in words_of(t))
    counts = dict(df.select(F.col(text).alias("text")).mapInArrow(_count_lines(vocabulary), "word string, n long")
                  .groupBy("word").agg(F.sum("n")).collect())
    lines = counts.pop("", 0)
    shared = broadcast_value(spark, (templates, long, lines, counts))
    token = uuid.uuid4().hex

    def per_texts(texts):
        short, windows = worker_cached(("licences", token), lambda: (
            Comparer(shared.value[0], *shared.value[2:]), Windows(*shared.value[1:])))
        found = []
        for t in texts:
            own, whole = (0.0, ""), (0.0, "")
            words = words_of(t) if t else []
            around = set(words)
            if not vocabulary.isdisjoint(around):
                passages = [words_of(line) for line in t.split("\n")]
                own = min(((-c, n) for c, n in (short.named(p, around) for p in passages)), default=(0.0, ""))
                own, whole = (-own[0], own[1]), short.named(words, around)
                cosine, name, is_file = windows.best(words, least_cosine)
                # a licence's own file names it better than the notices it quotes
                if cosine >= least_cosine and (is_file or cosine > own[0]):
                    own = cosine, name
                    whole = max(whole, own) if is_file else whole
            found.append([x for c, n in (own, whole) for x in ((n, c) if c >= least_cosine else (None, c))])
        return [list(column) for column in zip(*found)] if found else [[], [], [], []]

    return append_struct(df, text, FIELDS, per_texts, keep)


def directory_of(path: Column) -> Column:
    """The directory of a path, without a trailing slash; the root is the empty string."""
    return F.coalesce(F.regexp_extract(path, r"^(.*)/[^/]*$", 1), F.lit(""))


def licences(df: DataFrame, path: Column, id_col: str = "doc_id", text: str = "text",
             is_licence_file: Column | None = None, templates: list[tuple[str, str]] = TEMPLATES,
             least_cosine: float = 0.6) -> DataFrame:
    """Rows (id, licence, score, how, from_directory); how is own, inherited or none."""
    named, name = df.withColumn(fresh_name(df, "llm_dir"), directory_of(path)), fresh_name(df, "llm_dir")
    flag = fresh_name(named, "llm_file")
    named = named.withColumn(flag, F.coalesce(is_licence_file, F.lit(False)) if is_licence_file is not None
                             else F.lit(False))
    scanned, out = own_licences(named, text, templates, least_cosine, keep=[id_col, name, flag])
    rows = write_stage(scanned.select(F.col(id_col), F.col(name).alias("dir"), F.col(flag).alias("file"),
                                      F.col(f"{out}.*")), "licences")
    files = (rows.where(F.col("whole").isNotNull() | (F.col("file") & F.col("own").isNotNull()))
             .select("dir", F.coalesce("whole", "own").alias("licence"),
                     F.when(F.col("whole").isNotNull(), F.col("whole_score")).otherwise(F.col("own_score")).alias("score")))
    licensed = (files.groupBy("dir").agg(F.min(F.struct((-F.col("score")).alias("s"), "licence")).alias("best"))
                .select(F.col("dir").alias("from_directory"), F.col("best.licence").alias("inherited"),
                        (-F.col("best.s")).alias("inherited_score")))
    # ancestors of directories, nearest first: /a/b -> /a/b, /a and the root
    steps = F.split("dir", "/")
    ancestors = (rows.select("dir").distinct()
                 .withColumn("depth", F.explode(F.sequence(F.lit(1), F.size(steps))))
                 .withColumn("from_directory", F.array_join(F.slice(steps, F.lit(1), F.col("depth")), "/")))
    nearest = (ancestors.join(licensed, "from_directory").groupBy("dir")
               .agg(F.max_by(F.struct("from_directory", "inherited", "inherited_score"), "depth").alias("up"))
               .select("dir", "up.*"))
    own = F.col("own").isNotNull()
    up = nearest.select(F.col("dir").alias("of_dir"), F.struct("from_directory", "inherited", "inherited_score").alias("up"))
    # a directory may hold a large part of all texts: its rows stay where they are
    return (lookup_spread(rows, up, "dir", "of_dir", "up").select("*", "up.*")
            .select(id_col, F.coalesce("own", "inherited").alias("licence"),
                    F.when(own, F.col("own_score")).otherwise(F.col("inherited_score")).alias("score"),
                    F.when(own, "own").when(F.col("inherited").isNotNull(), "inherited").otherwise("none").alias("how"),
                    F.when(~own, F.col("from_directory")).alias("from_directory")))
