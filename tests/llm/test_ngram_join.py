import random
import re

import numpy as np
import pytest

from llm.helpers import docs, with_clashes
from tidyspark.llm import ngram_join as J
from tidyspark.llm.components import components

SF = "/root/testdata/sf0.01"


def grams(text, n=5):
    w = re.findall(r"\w+", (text or "").lower())
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def expected(rows, similarity=0.8):
    """(class id, links) per row, by comparing all pairs."""
    sets = [grams(t) for _, t, *_ in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    links = [0] * len(rows)
    for a in range(len(rows)):
        for b in range(a):
            if rows[a][0] is None or rows[b][0] is None or not sets[a] or not sets[b]:
                continue
            both = len(sets[a] & sets[b])
            if both >= similarity * (len(sets[a]) + len(sets[b]) - both) - 1e-9:
                links[a] += 1
                links[b] += 1
                parent[find(a)] = find(b)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return sorted(((r[0], least.get(find(i)), links[i]) for i, r in enumerate(rows)), key=str)


def got(df, **options):
    return sorted(map(tuple, J.classes(df, **options).collect()), key=str)


def near_copies(seed=3, groups=6):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(4))
    rows = []
    for _ in range(groups):
        base = [word() for _ in range(r.randrange(40, 120))]
        for _ in range(r.randrange(2, 12)):
            copy = list(base)
            for _ in range(r.randrange(3)):
                copy[r.randrange(len(copy))] = word()
            rows.append((len(rows), " ".join(copy), "en"))
    r.shuffle(rows)
    return rows


def test_bands_reach_the_recall():
    for s, recall in ((0.8, 0.9999), (0.9, 0.99), (0.6, 0.999)):
        bands, rows = J.choose_bands(s, recall)
        assert 1 - (1 - s ** rows) ** bands >= recall and bands * rows <= 128


def test_overlaps_are_exact():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 70, rng.integers(1, 50))).astype(np.int64) for _ in range(90)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    assert (J.overlaps(sets) == np.array(want)).all()


@pytest.mark.parametrize("options", [{}, {"bucket_pairs": 1, "block": 4}])
def test_pairs_and_blocks_find_every_link(spark, options):
    rows = near_copies()
    assert got(docs(spark, rows), **options) == expected(rows)


def test_cases(spark):
    rows = [(5, "One two three four five six", "en"), (3, "one, two three FOUR five six!", "en"), (3, "one two three four five six", "en"),
            (4, None, "en"), (6, "", "en"), (7, "?!", "en"), (8, "tiny", "en"), (9, "Tiny", "en"),
            (None, "tiny", "en"), (None, None, "en"), (10, "w " * 30_000, "en"), (11, "w w w w w", "en")]
    df = with_clashes(docs(spark, rows))
    assert got(df) == expected(rows)
    assert J.classes(docs(spark, [])).count() == 0
    kept = J.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([3, 3, 4, 6, 7, 8, 10, None, None], key=str)


def test_query_equals_all_pairs(spark):
    import __spark_entry__ as entry
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    out = entry.queries()["op6_ngram_join"](spark, SF).select("doc_id", "class_id", "n_links").collect()
    assert sorted(map(tuple, out), key=str) == expected(rows)


def test_components(spark):
    r = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    edges += [(r.randrange(300, 400), r.randrange(300, 400)) for _ in range(60)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {x.node: x.root for x in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for x in parent if find(x) != x}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_bands_for_every_similarity():
    import math
    for s in (0.99, 0.5, 0.3, 0.2, 0.1):
        bands, rows = J.choose_bands(s, 0.9, 200)
        assert 1 - (1 - s ** rows) ** bands >= 0.9 and bands * rows <= 200
    assert J.choose_bands(1.0, 0.9) == (1, 32)
    with pytest.raises(ValueError, match="needs 90 hashes"):
        J.choose_bands(0.05, 0.99, 64)
    for bad in (0.0, -1.0, 1.1, math.nan):
        with pytest.raises(ValueError):
            J.choose_bands(bad, 0.9)
