import random

from pyspark.sql import functions as F

from llm.helpers import docs, with_clashes
from tidyspark.llm import decontaminate as D


def distance(pattern, text):
    before = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        row = [i]
        for j, x in enumerate(text, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (c != x)))
        before = row
    return min(before), before.index(min(before))


def test_myers_equals_dynamic_programming():
    r = random.Random(3)
    for _ in range(600):
        p = "".join(r.choice("abé") for _ in range(r.randrange(1, 90)))
        t = "".join(r.choice("abé") for _ in range(r.randrange(60)))
        assert D.myers(D.letter_masks(p), len(p), t) == distance(p, t)


def edit(r, s, n):
    for _ in range(n):
        i, kind = r.randrange(len(s)), r.randrange(3)
        s = s[:i] + ("" if kind == 0 else r.choice("xyz")) + s[i + (kind != 1):]
    return s


def test_all_matches_within_budget_and_no_others():
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcd") for _ in range(r.randrange(2, 6)))
    items = [(i, " ".join(word() for _ in range(r.randrange(8, 40)))) for i in range(12)]
    matcher = D.Matcher(items, 20)
    for _ in range(60):
        i, t = r.choice(items)
        text = " ".join(word() for _ in range(20)) + " " + edit(r, t, r.randrange(8)) + " " + " ".join(word() for _ in range(9))
        got = {m[0]: m for m in matcher.matches(text)}
        clean = D.compared(text)
        for k, item in items:
            best = distance(item, clean)[0]
            if best <= len(item) // 20:
                assert got[k][1] == best
                _, start, end = got[k][1:]
                assert distance(item, clean[start:end])[0] == best
            else:
                assert k not in got


def test_cases(spark):
    item = "The quick brown fox jumps over the lazy dog and runs away from it"
    items = spark.createDataFrame([(1, item), (1, item), (2, None), (3, ""), (4, "  "), (5, "short one here"),
                                   (None, "an item that has no id at all")], "item_id long, text string")
    rows = [(1, "x " + item.upper().replace(" ", " \n ") + " y", "en"), (1, "x " + item + " y", "en"),
            (2, None, "en"), (3, "", "en"), (4, "nothing of the sort", "en"), (5, item.replace("quick", "quikc"), "en"),
            (None, "a Short  one here!", "en"), (6, "ab " * 100_000 + item, "en"), (7, "an item that has no id at all", "en")]
    df = with_clashes(docs(spark, rows))
    got = sorted(map(tuple, D.contamination(df, items).select("doc_id", "item_id", "distance").collect()), key=str)
    assert got == sorted([(1, 1, 0), (1, 1, 0), (5, 1, 2), (None, 5, 0), (6, 1, 0), (7, None, 0)], key=str)
    left = D.clean(df, items)
    assert left.columns == df.columns
    assert sorted(r.doc_id for r in left.collect()) == [2, 3, 4]
    assert D.contamination(docs(spark, []), items).count() == 0
    assert D.contamination(df, items.limit(0)).count() == 0 and D.clean(df, items.limit(0)).count() == len(rows)


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    items = spark.createDataFrame([(i, f"item number {i} has some text of its own") for i in range(30)],
                                  "item_id long, text string")
    whole = D.item_blocks
    monkeypatch.setattr(D, "item_blocks", lambda items: whole(items, block_bytes=200))
    df = docs(spark, [(i, f"before item number {i} has some text of its own", "en") for i in range(30)])
    assert len(list(D.item_blocks(items))) > 3
    rows = D.contamination(df, items).where("doc_id = item_id AND distance = 0").collect()
    assert len(rows) == 30 and D.clean(df, items).count() == 0


def test_query_finds_every_whole_item(spark):
    import __spark_entry__ as entry
    sf = "/root/testdata/sf0.01"
    rows = entry.queries()["op5_decontamination"](spark, sf).collect()
    items = {r.item_id: D.compared(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    found = {(r.doc_id, r.item_id) for r in rows}
    for d in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        t = D.compared(d.text)
        assert {(d.doc_id, i) for i, x in items.items() if x in t} <= found
    assert all(r.distance <= len(items[r.item_id]) // 20 for r in rows)


def test_every_copy_of_an_item_is_found():
    r = random.Random(12)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randrange(2, 6)))
    items = [(i, " ".join(word() for _ in range(r.randrange(12, 30)))) for i in range(4)]
    matcher = D.Matcher(items, 20)
    for _ in range(30):
        parts, planted = [], []
        for _ in range(r.randrange(1, 7)):
            k, t = r.choice(items)
            parts += [" ".join(word() for _ in range(r.randrange(0, 30))), edit(r, t, r.randrange(0, len(t) // 20 + 1))]
            planted.append(k)
        text = D.compared(" ".join(parts))
        got = matcher.every(text)
        assert sorted(k for k, *_ in got) == sorted(planted)
        for k, d, start, end in got:
            assert d <= len(items[k][1]) // 20 and distance(items[k][1], text[start:end])[0] == d
        for k in set(planted):
            spans = sorted((s, e) for kk, _, s, e in got if kk == k)
            assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    twice = items[0][1] + " " + items[0][1]
    assert [f[:2] for f in matcher.every(twice)] == [(0, 0), (0, 0)] and len(matcher.matches(twice)) == 1
    assert matcher.every(None) == matcher.every("") == []
