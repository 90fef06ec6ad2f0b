import itertools
import math
import random

import numpy as np
import public_tokenizers as P
from pyspark.sql import functions as F

from llm.helpers import by_id, docs, with_clashes
from tidyspark.llm import langid, toxicity
from tidyspark.llm.common import Memo

SF = "/root/testdata/sf0.01"


def brute_segments(x):
    """Maximal segments by their definition: repeatedly the best (then shortest, then first), then left and right of it."""
    def best(lo, hi):
        spans = [(sum(x[a:b]), -(b - a), -a, a, b) for a in range(lo, hi) for b in range(a + 1, hi + 1)]
        return max(spans, default=None)

    def split(lo, hi):
        top = best(lo, hi)
        if top is None or top[0] <= 0:
            return []
        return split(lo, top[3]) + [(top[3], top[4], top[0])] + split(top[4], hi)
    return split(0, len(x))


def test_segments_are_all_maximal_ones():
    r = random.Random(2)
    for _ in range(400):
        x = [r.choice([-1, -1, -1, -3, 2, 4, 5, 7]) + r.random() / 97 * (r.random() < 0.5) for _ in range(r.randrange(12))]
        got = toxicity.segments(np.array(x, dtype=float), -1.0)
        want = brute_segments(x)
        assert [g[:2] for g in got] == [w[:2] for w in want], x
        assert all(math.isclose(g[2], w[2], abs_tol=1e-9) for g, w in zip(got, want))


def test_toxicity_learns_and_handles_cases(spark):
    r = random.Random(1)
    words = ["la", "mi", "no", "to", "ra", "su", "ke", "vo"]
    text = lambda bad, n=30: " ".join(r.choice(words) if not (bad and r.random() < 0.2) else "grobnix" for _ in range(n))
    rows = [(i, text(i % 4 == 0), "en") for i in range(400)]
    rows += [(1000, None, None), (1001, "", "en"), (1002, "grobnix " * 5, "en"), (1003, "la mi no", "en"),
             (1003, "la mi no", "en"), (None, "grobnix grobnix", "en"), (1004, "la mi " * 60_000, "en")]
    df = with_clashes(docs(spark, rows))
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(400)] + [(0, 1, 1), (5, 1, None), (None, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    model = toxicity.train(df, labels, F.lit(True))
    out, name = toxicity.score(df, model)
    assert out.columns[:-1] == df.columns and out.count() == len(rows)
    got = {k: v[name] for k, v in by_id(out).items()}
    assert got[1002].predicted == 1 and got[None].predicted == 1
    assert got[1000].predicted == got[1001].predicted == got[1003].predicted == got[1004].predicted == 0
    assert all(0 <= g.score <= 1 for g in got.values())
    assert got[1002].passage_start == [0] and got[1002].passage_end == [5]
    wrong = [i for i in range(400) if got[i].predicted != int(i % 4 == 0)]
    assert len(wrong) <= 4
    # one class only, and no rows at all
    for some in (labels.where("toxic = 0"), labels.limit(0)):
        one, name = toxicity.score(df, toxicity.train(df, some, F.lit(True)))
        assert {r[name].predicted for r in one.collect()} == {0}
    none = docs(spark, [])
    assert toxicity.score(none, toxicity.train(none, labels, F.lit(True)))[0].count() == 0


def test_toxicity_curve_reaches_the_optimum():
    """Also where the classes hardly overlap and full Newton steps swing."""
    r = random.Random(5)
    apart = [(0.0, 0, 25_000), (3.0, 0, 400), (11.0, 0, 4), (13.0, 4, 0), (14.0, 24, 2), (17.0, 900, 0), (60.0, 2000, 0)]
    cases = [apart, [(0.0, 0, 25_000), (6.0, 0, 300), (14.0, 3000, 0)]]
    cases += [[(k / 2, r.randrange(3000) if k > 20 else 0, r.randrange(3000) if k < 22 else 0) for k in range(60)]
              for _ in range(50)]
    for bins in cases:
        a, b = toxicity._fit_curve(bins)
        p = [1 / (1 + math.exp(-a - b * x)) for x, _, _ in bins]
        slopes = (sum(t - (t + c) * q for q, (_, t, c) in zip(p, bins)) - 1e-3 * a,
                  sum((t - (t + c) * q) * x for q, (x, t, c) in zip(p, bins)) - 1e-1 * b)
        assert max(map(abs, slopes)) < 0.01 and b > 0.5, (a, b, slopes)
    a, b = toxicity._fit_curve(apart)
    assert a + b * 11 < math.log(0.3 / 0.7) < a + b * 13


def test_toxicity_held_out(spark):
    import __spark_entry__ as entry
    out = entry.queries()["op1_toxicity"](spark, SF)
    both = out.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.toxic for r in both) >= 0.95 * len(both)


def test_forward_sums_all_segmentations():
    pieces = ["▁", "▁a", "a", "b", "ab", "ba", "bab", "▁b"]
    rng = np.random.default_rng(3)
    prob = rng.random((len(pieces), 2))
    lattice = langid.Lattice(pieces)
    words = ["".join(w) for n in range(1, 6) for w in itertools.product("abx", repeat=n)]

    def total(s, k):
        if not s:
            return 1.0
        own = sum(prob[i, k] * total(s[len(p):], k) for i, p in enumerate(pieces) if s.startswith(p))
        return own + (langid.UNKNOWN * total(s[1:], k) if s[0] == "x" else 0.0)

    got = lattice.log_words(words, langid._lifted(prob, lattice))
    want = [[math.log(total("▁" + w, k)) for k in range(2)] for w in words]
    assert np.allclose(got, want)
    long = "abxba" * 40
    assert np.allclose(lattice.log_words([long], langid._lifted(prob, lattice)),
                       lattice._log_long(long, langid._lifted(prob, lattice)))
    # expected counts: the change of the log-probability with the log of a piece's probability
    weight = np.ones((3, 2))
    counts = lattice.expected(["abab", "ba", "b"], weight, langid._lifted(prob, lattice))
    for i in range(len(pieces)):
        more = prob.copy()
        more[i] *= 1 + 1e-6
        change = (lattice.log_words(["abab", "ba", "b"], langid._lifted(more, lattice))
                  - lattice.log_words(["abab", "ba", "b"], langid._lifted(prob, lattice))).sum(axis=0) / 1e-6
        assert np.allclose(counts[i], change, atol=1e-3)


def test_long_runs_of_an_untrained_script(spark):
    scripts = "".join(map(chr, range(0x1400, 0x1400 + 50)))                  # Canadian syllabics, no pieces
    rows = [(i, f"the cat and the dog went home number {i}", "en") for i in range(30)]
    rows += [(100 + i, f"der Hund und die Katze gehen nach Hause {i}", "de") for i in range(30)]
    rows += [(200, f"the {scripts[:47]} house", "en")]                       # may be learned from
    model = langid.train(docs(spark, rows), F.lit(True), P.path("piece_bpe_32k.model"))
    assert np.isfinite(model[2]).all() and np.allclose(model[2].sum(axis=0), 1)
    text = "the cat and the dog went home"
    texts = docs(spark, [(1, text, None), (2, f"{text} {scripts}", None), (3, f"{scripts} {text} {scripts[:44]}", None)])
    out, name = langid.predict(texts, model)
    got = {r.doc_id: r[name] for r in out.collect()}
    assert all(r.lang_pred == "en" and 0.5 < r.score <= 1 for r in got.values())
    scorer = langid.Scorer(model[1], model[2])
    logs = scorer.lattice.log_words([scripts, scripts[:30]], scorer.prob)
    apart = np.log(langid.UNKNOWN) * 20                                      # 20 more unknown characters
    assert np.allclose(logs[0] - logs[1], apart)


def test_language_cases(spark):
    english, french = "the house and the water over there ", "la maison et l'eau qui est ici "
    rows = [(i, (english if i % 2 else french) * (1 + i % 3), "en" if i % 2 else "fr") for i in range(60)]
    rows += [(100, None, "en"), (101, "", "en"), (102, "123 !? ²", "fr"), (103, "the water", None),
             (104, "l'eau de la maison", None), (104, "l'eau de la maison", None), (None, "the house", "en"),
             (105, "maison " * 50_000, None), (106, "x" * 20_000, None)]
    df = with_clashes(docs(spark, rows))
    model = langid.train(df, F.col("doc_id").isNotNull(), P.path("piece_bpe_32k.model"))
    out, name = langid.predict(df, model)
    assert out.columns[:-1] == df.columns and out.count() == len(rows)
    got = {k: v[name] for k, v in by_id(out).items()}
    assert [got[i].lang_pred for i in (100, 101, 102)] == ["und"] * 3 and got[101].score == 0.0
    assert (got[103].lang_pred, got[104].lang_pred, got[105].lang_pred, got[None].lang_pred) == ("en", "fr", "fr", "en")
    assert all(0 <= g.score <= 1 for g in got.values())
    none, name = langid.predict(df, langid.train(df.where("lang = 'xx'"), F.lit(True), P.path("piece_bpe_32k.model")))
    assert {r[name].lang_pred for r in none.collect()} == {"und"}
    empty = docs(spark, [])
    assert langid.predict(empty, model)[0].count() == 0


def test_language_held_out(spark):
    import __spark_entry__ as entry
    out = entry.queries()["op3_language"](spark, SF)
    both = out.join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = both.where("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in held) >= 0.98 * len(held)


def test_memo_is_bounded():
    memo = Memo(lambda k: k * 2, 10)
    assert [memo[i % 25] for i in range(100)] == [i % 25 * 2 for i in range(100)] and len(memo) <= 10


def test_worker_objects_are_kept_by_content():
    from tidyspark.llm.common import content_key, worker_cached
    a, b = [f"piece{i}" for i in range(100)], [f"other{i}" for i in range(100)]
    assert content_key(a) != content_key(b) and content_key(["ab", "c"]) != content_key(["a", "bc"])
    assert content_key(["a"], "b") != content_key("a", ["b"]) and content_key(list(a)) == content_key(a)
    assert worker_cached(("t", content_key(a)), lambda: a) is a and worker_cached(("t", content_key(b)), lambda: b) is b


def test_languages_written_without_spaces_are_learned_from_whole_runs(spark):
    rnd = random.Random(4)

    def text(letters):
        return "".join(rnd.choice(letters) for _ in range(400))

    one, two = "あいうえおかきくけこさしすせそ", "가나다라마바사아자차카타파하"
    rows = [(i, text(one if i % 2 else two), "ja" if i % 2 else "ko") for i in range(40)]
    d = docs(spark, rows)
    model = langid.train(d, F.col("doc_id") < 30, P.path("piece_bpe_32k.model"))
    out, name = langid.predict(d, model, keep=["doc_id", "lang"])
    assert all(r.p == r.lang for r in out.where("doc_id >= 30").select("lang", F.col(f"{name}.lang_pred").alias("p")).collect())
