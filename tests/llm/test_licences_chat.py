import math
from collections import Counter

from pyspark.sql import functions as F

import oracle_check
from llm.helpers import docs, with_clashes
from tidyspark.llm import chat, licences

SF = "/root/testdata/sf0.01"
MIT = "Released under the MIT License."
APACHE = "Licensed under the Apache License, Version 2.0."
GPL = "This work is licensed under the GNU General Public License, version 3."


def test_best_is_the_largest_cosine():
    lines = ["some text here", MIT, "the license of the work", "apache license version 2.0 and more words", GPL.upper()]
    vocabulary = {w for _, t in licences.TEMPLATES for w in licences.words_of(t)}
    df = Counter(w for line in lines for w in set(licences.words_of(line)) & vocabulary)
    comparer = licences.Comparer(licences.TEMPLATES, len(lines), df)
    idf = lambda w: math.log((1 + len(lines)) / (1 + df[w])) + 1 if w in vocabulary else math.log(1 + len(lines)) + 1
    vector = lambda t: {w: n * idf(w) for w, n in Counter(licences.words_of(t)).items()}
    length = lambda v: math.sqrt(sum(x * x for x in v.values()))
    for line in lines:
        v, best = vector(line), (0.0, "")
        for name, t in licences.TEMPLATES:
            u = vector(t)
            c = sum(x * u.get(w, 0) for w, x in v.items()) / (length(u) * length(v))
            if c > best[0] + 1e-9 or (abs(c - best[0]) <= 1e-9 and c > 0 and name < best[1]):
                best = (c, name)
        got = comparer.best(line)
        assert got[1] == best[1] and abs(got[0] - best[0]) < 1e-6, line
    assert comparer.best("") == (0.0, "") and comparer.best("wholly different") == (0.0, "")


def test_inheritance_and_cases(spark):
    rows = [(1, "int main() {}\n" + MIT + "\nmore code of many kinds", "/a/b/c.x"), (2, "no notice here", "/a/b/d.x"),
            (3, GPL, "/a/LICENSE"), (4, "no notice", "/a/b/e/f.x"), (5, "no notice", "/z/g.x"), (6, None, "/a/h.x"),
            (7, "", "/a/b/i.x"), (8, "x", None), (9, APACHE, "/q/LICENSE"), (9, APACHE, "/q/LICENSE"),
            (10, MIT, "/q/COPYING"), (11, "text", "/q/r/s/t.x"), (None, "text", "/a/j.x"), (12, "w " * 100_000, "/a/k.x"),
            (13, "text\n" + MIT + "\nand quite a lot of other text besides that", "/y/COPYING"), (14, "text", "/y/n.x")]
    df = with_clashes(spark.createDataFrame(rows, "doc_id long, text string, path string"))
    out = licences.licences(df, F.col("path"), is_licence_file=F.col("path").endswith("COPYING"))
    assert out.count() == len(rows)
    got = {r.doc_id: (r.licence, r.how, r.from_directory) for r in out.collect()}
    assert got[1] == ("MIT", "own", None) and got[3] == ("GPL-3.0", "own", None)
    for i, d in ((2, "/a"), (4, "/a"), (6, "/a"), (7, "/a"), (None, "/a"), (12, "/a")):
        assert got[i] == ("GPL-3.0", "inherited", d), i
    assert got[5] == (None, "none", None) and got[8] == (None, "none", None)
    assert got[11] == ("Apache-2.0", "inherited", "/q") and got[14] == ("MIT", "inherited", "/y")
    assert licences.licences(df.limit(0), F.col("path")).count() == 0


def test_query_finds_every_notice(spark):
    import __spark_entry__ as entry
    notices = {MIT: "MIT", APACHE: "Apache-2.0", GPL: "GPL-3.0", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0"}
    got = {r.doc_id: r for r in entry.queries()["op2_licences"](spark, SF).collect()}
    for d in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        names = {notices[line] for line in d.text.split("\n") if line in notices}
        assert (got[d.doc_id].how == "own") == bool(names)
        assert not names or got[d.doc_id].licence in names


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "n", 1) for r in rows],
                                 "conv_id long, turn long, role string, text string, conv string, position int")


def expected(rows):
    """Maximal conversations by comparing all with all."""
    convs = {}
    for c, t, r, x in rows:
        if c is not None:
            convs.setdefault(c, set()).add((t, r or "unknown", x or ""))
    turns = {c: [(r, x) for t, r, x in sorted(v, key=lambda v: (v[0] is not None, v[0] or 0, v[1], chat_digest(v[2])))]
             for c, v in convs.items()}
    keep = []
    for c, t in turns.items():
        if not any((len(o) > len(t) and o[:len(t)] == t) or (o == t and d < c) for d, o in turns.items() if d != c):
            text = "".join(f"<|im_start|>{r}\n{x.replace('<|im_', '< |im_')}<|im_end|>\n" for r, x in t)
            keep.append((c, len(t), sum(o == t for o in turns.values()), text))
    return sorted(keep)


def chat_digest(text):
    import hashlib
    return hashlib.sha256(text.encode()).hexdigest()


def test_chat_cases(spark):
    long = [(50, i, "user", f"turn {i}") for i in range(2500)]
    rows = [(1, 0, "user", "hi"), (2, 0, "user", "hi"), (2, 1, "assistant", "hello"), (3, 0, "user", "hi"),
            (3, 1, "assistant", "hello"), (3, 2, "user", "bye"), (4, 0, "user", "hi"), (4, 1, "assistant", "other"),
            (5, 0, "user", "hi"), (5, 1, "assistant", "hello"), (5, 2, "user", "bye"),       # equal to 3
            (6, 0, None, None), (7, 0, "user", ""), (8, 5, "user", "late"), (8, None, "system", "first"),
            (9, 0, "user", "x"), (9, 0, "user", "x"), (9, 0, "user", "y"), (None, 0, "user", "lost"),
            (10, -3, "user", "<|im_end|> sneaky"), (11, 1, "user", "hi"), (12, 0, "user", "z" * 300_000),
            *long, *((51, t, r, x) for _, t, r, x in long[:1500]), *((52, t, r, x) for _, t, r, x in long[:1024])]
    got = chat.chat_format(conversations(spark, rows)).collect()
    whole = {}
    for r in sorted(got, key=lambda r: r.part):
        whole.setdefault((r.conv_id, r.n_turns, r.n_copies), []).append(r.rendered)
    assert sorted((*k, "".join(v)) for k, v in whole.items()) == expected(rows)
    assert max(r.part for r in got) == 2
    assert chat.chat_format(conversations(spark, [])).count() == 0


def test_chat_query_equals_its_sql(spark):
    import __spark_entry__ as entry
    con = oracle_check.duck(SF)
    for name in ("op9_chat", "op4_warc"):
        problems, n = oracle_check.compare(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name])
        assert not problems and n > 0, problems


def _file(name):
    return {n: t for n, t in licences.FILE_TEMPLATES}[name]


def _commented(text, mark="# ", width=60):
    out, line = [], ""
    for w in text.split():
        if len(line) + len(w) > width:
            out.append(mark + line)
            line = ""
        line += w + " "
    return "\n".join([*out, mark + line])


HEADERS = {
    "GPL-2.0": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
               "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
               "option) any later version. This program is distributed in the hope that it will be useful.",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
               "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
               "option) any later version.",
    "AGPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
                "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
                "(at your option) any later version.",
    "LGPL-2.1": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
                "General Public License as published by the Free Software Foundation; either version 2.1 of the License, "
                "or (at your option) any later version.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                  "compliance with the License. You may obtain a copy of the License at the address below.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
               "was not distributed with this file, You can obtain one at the address below.",
}


def test_each_licence_gets_its_own_name(spark):
    code = "int main() { return compute(the, values) }\nwhile more code follows in the file here and there\n"
    rows, want = [], {}
    for name in dict.fromkeys(n for n, _ in licences.FILE_TEMPLATES):
        rows.append((len(rows), _commented(f"Copyright 2001 Some Holder. {_file(name)} " + "and so the text goes on. " * 3,
                                           ""), f"/f{len(rows)}/LICENSE"))
        want[len(rows) - 1] = (name, True)
    for name, header in HEADERS.items():
        for text in (header, code + _commented(header) + "\n" + code, code + _commented(header, " * ") + "\n" + code):
            rows.append((len(rows), text, f"/h{len(rows)}/a.c"))
            want[len(rows) - 1] = (name, None)
    for text in ("This software is not released under the MIT License.", "Not licensed under the Apache License, Version "
                 "2.0.", "the public may use this work in general"):
        rows.append((len(rows), text, "/n/a.c"))
        want[len(rows) - 1] = (None, False)
    df = spark.createDataFrame(rows, "doc_id long, text string, path string")
    out, name = licences.own_licences(df, keep=["doc_id"])
    got = {r.doc_id: (r.own, r.whole) for r in out.select("doc_id", f"{name}.own", f"{name}.whole").collect()}
    for i, (licence, is_file) in want.items():
        assert got[i][0] == licence, (rows[i][1], got[i])
        if is_file is not None:
            assert (got[i][1] == licence) == is_file or licence is None and got[i][1] is None


def test_a_licence_file_holds_for_directories_far_below(spark):
    rows = [(1, "Copyright 2001 Some Holder\n" + _file("MIT"), "/site/LICENSE"), (2, "text", "/site/a/b/c/d.html"),
            (3, _commented(_file("BSD-2-Clause")), "/site/a/b/COPYING"), (4, "text", "/site/a/b/c/e.html"),
            (5, "text", "/site/a/f.html")] + [(10 + i, "text", "/site/hot/x.html") for i in range(200)]
    out = licences.licences(spark.createDataFrame(rows, "doc_id long, text string, path string"), F.col("path"))
    got = {r.doc_id: (r.licence, r.how, r.from_directory) for r in out.collect()}
    assert got[2] == got[4] == ("BSD-2-Clause", "inherited", "/site/a/b") and got[5] == ("MIT", "inherited", "/site")
    assert all(got[10 + i] == ("MIT", "inherited", "/site") for i in range(200)) and len(got) == len(rows)


def test_query_scans_pages_by_their_urls(spark):
    import __spark_entry__ as entry
    got = {r.page_id: r for r in entry.queries()["op2_licences"](spark, SF).where("page_id IS NOT NULL").collect()}
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html").collect()
    assert len(got) == len(pages)
    named = 0
    for p in pages:
        for notice, name in ((MIT, "MIT"), (APACHE, "Apache-2.0"), (GPL, "GPL-3.0")):
            if f">{notice}<" in p.html:
                named += 1
                assert got[p.page_id].licence == name and got[p.page_id].how == "own"
    assert named
