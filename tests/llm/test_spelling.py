import random

import pytest

from llm.helpers import docs, with_clashes
from tidyspark.llm import spelling as S
from tidyspark.llm.queries import misspelt


def near(a, b):
    """Exactly one inserted, deleted or replaced code point."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def expected(counts, ratio=5):
    out = {}
    for w, n in counts.items():
        others = sorted((-m, v) for v, m in counts.items() if near(w, v))
        form = others[0][1] if others and -others[0][0] >= ratio * n else None
        out[w] = [form, n, len(others), counts[form] if form else None]
    for w, r in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        r.insert(1, root)
    return {w: tuple(r) for w, r in out.items()}


def words_of(seed, n, letters="ab", lengths=(6, 10)):
    rnd = random.Random(seed)
    return {"".join(rnd.choice(letters) for _ in range(rnd.randint(*lengths))): rnd.choice([5, 5, 25, 30, 160, 900])
            for _ in range(n)}


@pytest.mark.parametrize("seed", range(3))
def test_index_finds_what_comparing_all_finds(seed):
    words = sorted(words_of(seed, 300, "abé", (3, 7)))
    for letters in range(3, 8):
        half = letters // 2
        found = {}
        # both windows of a class, over words that agree around them
        for first, last in ((0, half), (half, letters)):
            buckets = {}
            for w in words:
                if len(w) in (letters, letters + 1):
                    buckets.setdefault((w[:first], w[len(w) - letters + last:]), []).append(w)
            for b in buckets.values():
                for i, n, best in S.near_in_bucket(b, letters, first, last):
                    found[b[i]] = found.get(b[i], 0) + n
                    assert near(b[i], b[best])
        for w in words:
            if len(w) == letters:
                assert found.get(w, 0) == sum(near(w, v) for v in words if len(v) >= letters), w
            elif len(w) == letters + 1:
                assert found.get(w, 0) == sum(near(w, v) for v in words if len(v) == letters), w


@pytest.mark.parametrize("most_words", [8, S.MOST_WORDS])
def test_groups_equal_brute_force_however_buckets_are_cut(spark, most_words):
    counts = words_of(7, 250) | words_of(8, 150, "abcé", (6, 9)) | {"a" * 400: 5, "a" * 399 + "b": 25, "a" * 401: 5}
    vocabulary = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n)
           for r in S.variant_groups(vocabulary, most_words=most_words).collect()}
    assert got == expected(counts)


def test_ties_go_to_the_smallest_word_and_roots_follow_forms(spark):
    counts = {"abcdef": 5, "abcdeg": 25, "abcdeh": 25, "abcdegx": 125, "zzzzzz": 9}
    got = {r.word: r for r in S.variant_groups(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()}
    assert (got["abcdef"].form, got["abcdef"].root, got["abcdef"].n_near) == ("abcdeg", "abcdegx", 2)
    assert (got["abcdeg"].form, got["abcdegx"].form, got["abcdegx"].root) == ("abcdegx", None, "abcdegx")
    assert (got["zzzzzz"].form, got["zzzzzz"].root, got["zzzzzz"].n_near) == (None, "zzzzzz", 0)


def test_words_of_awkward_texts(spark):
    rows = [(1, "Letter ÀLETTER letter_letter9LETTER", "en"), (1, "Letter ÀLETTER letter_letter9LETTER", "en"),
            (2, None, None), (3, "", "en"), (None, "letter short", None), (4, "abcdef " * 400_000, "en")]
    got = {r.word: r.n for r in S.word_counts(with_clashes(docs(spark, rows)), least_count=1).collect()}
    assert got == {"letter": 9, "Àletter": 2, "abcdef": 400_000}
    assert S.word_counts(docs(spark, rows), least_count=5).count() == 2
    empty = S.variant_groups(S.word_counts(docs(spark, [])))
    assert empty.count() == 0 and empty.columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_misspelt_takes_out_one_letter_of_one_run_in_199():
    runs = [(str(i), "wonderful") for i in range(4000)]
    changed = [misspelt(*r) for r in runs if misspelt(*r) != r[1]]
    assert 5 < len(changed) < 40 and all(len(w) == 8 and near(w, "wonderful") for w in changed)
