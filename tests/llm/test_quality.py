import numpy as np
import pytest

from llm.helpers import by_id, docs, with_clashes
from tidyspark.llm import quality as Q
from tidyspark.llm.common import crc_mod, table
from tidyspark.llm.queries import op13_quality

SF = "/root/testdata/sf0.1"


def auc(score, good):
    order = np.argsort(score, kind="stable")
    s, g = np.array(score)[order], np.array(good)[order]
    # ties get their middle rank
    ranks = np.array([(np.searchsorted(s, v, "left") + np.searchsorted(s, v, "right") + 1) / 2 for v in s])
    n1 = g.sum()
    return (ranks[g == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(g) - n1))


def test_held_out_labels(spark):
    scored = {r.doc_id: r for r in op13_quality(spark, SF).collect()}
    assert len(scored) == table(spark, SF, "documents").count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in scored.values())
    held = [(scored[r.doc_id], r.quality) for r in table(spark, SF, "labels").collect() if scored[r.doc_id].held_out]
    good = np.array([q for _, q in held])
    assert auc([s.score for s, _ in held], good) > 0.9
    assert np.mean([s.predicted == q for s, q in held]) > 0.93
    # calibrated: the mean score is the share of good documents
    assert abs(np.mean([s.score for s, _ in held]) - good.mean()) < 0.03


def test_statistics_add_up_over_pieces(monkeypatch):
    kinds = Q.kind_table()
    text = "Some words, AND more words. x\n" * 50 + "## $$ %% && end of it all here\n" * 3
    whole = Q.statistics(text, kinds)
    by_name = dict(zip(Q.STATISTICS, whole))
    assert by_name["log_chars"] == pytest.approx(np.log1p(len(text)))
    assert by_name["share_line"] == pytest.approx(53 / len(text))
    assert by_name["share_symbol"] == pytest.approx(3 * 8 / len(text))
    assert by_name["most_symbols_of_line"] == pytest.approx(8 / 30)
    assert by_name["capital_words"] == pytest.approx(50 / (50 * 6 + 3 * 9))
    assert by_name["stopped_lines"] == 0.0 and by_name["repeated_lines"] == pytest.approx(51 / 53)
    assert Q.statistics(None, kinds) == Q.statistics("", kinds) == [0.0] * len(Q.STATISTICS)
    long = Q.statistics("word " * 500_000, kinds)
    assert np.isfinite(long).all() and len(long) == len(whole)


def test_pooled_blocks_equal_the_least_squares_rising_fit():
    rnd = np.random.default_rng(2)
    n = rnd.integers(1, 5, 40).astype(float)
    good = np.array([rnd.binomial(int(m), p) for m, p in zip(n, np.linspace(0.1, 0.9, 40))], dtype=float)
    blocks = Q.pooled(np.arange(40.0), n, good)
    shares = [b[2] for b in blocks]
    assert shares == sorted(shares) and sum(b[1] for b in blocks) == n.sum()
    # the value of the fit at i is max over a <= i of min over b >= i of the mean of a..b
    mean = lambda a, b: good[a:b + 1].sum() / n[a:b + 1].sum()                                  # noqa: E731
    want = [max(min(mean(a, b) for b in range(i, 40)) for a in range(i + 1)) for i in range(40)]
    got = np.repeat(shares, 1)
    place = np.searchsorted(np.cumsum([b[1] for b in blocks]) + 1e-9, np.cumsum(n))
    assert np.allclose(got[np.minimum(place, len(got) - 1)], want)


def test_cosines_approximate_the_gaussian_kernel():
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(20, len(Q.STATISTICS)))
    z = Q.Kernel(np.zeros(x.shape[1]), np.ones(x.shape[1]), 4.0, 20_000)(x)[:, :-1]
    exact = np.exp(-((x[:, None] - x[None]) ** 2).sum(2) / (2 * 4.0 ** 2))
    assert np.abs(z @ z.T - exact).max() < 0.05


def test_task_sums_equal_one_matrix(spark):
    rnd = np.random.default_rng(4)
    x = rnd.normal(size=(60, len(Q.STATISTICS)))
    rows = [(i % 3, bool(i % 2), [float(v) for v in r]) for i, r in enumerate(x)]
    sample = spark.createDataFrame(rows, "fold int, good boolean, x array<double>").repartition(5)
    kernel = Q.Kernel(np.zeros(x.shape[1]), np.ones(x.shape[1]), 4.0, 100)
    sums = Q._matrices(sample, [kernel], 100)
    z = np.concatenate([kernel(x), np.array([[float(r[1])] for r in rows])], 1)
    assert np.allclose(sum(sums.values()), z.T @ z) and set(sums) == {(0, 0), (0, 1), (0, 2)}


def test_awkward_documents_and_labels(spark):
    rows = [(i, "fine words in a calm line of text. " * (i % 7 + 1) if i % 3 else "@@ ## $$ %% " * (i % 5 + 1), "en")
            for i in range(60)]
    extra = [(100, None, None), (101, "", "en"), (None, "fine words", None), (1, rows[1][1], "en"),
             (102, "word " * 300_000, "en")]
    d = with_clashes(docs(spark, rows + extra))
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(60)] + [(1, 1), (None, 0), (100, None)],
                                   "doc_id long, quality int")
    from pyspark.sql import functions as F
    model = Q.train(d, labels, crc_mod(F.col("doc_id"), 3) != 1, features=32)
    out, name = Q.score(d, model)
    got = out.select("doc_id", f"{name}.*", F.col("predicted").alias("was")).collect()
    assert len(got) == len(rows) + len(extra) and all(0 <= r.score <= 1 and r.was == "x" for r in got)
    same = [r.score for r in got if r.doc_id == 1]
    assert same[0] == same[1]
    empty = by_id(out.select("doc_id", f"{name}.*"))
    assert empty[100].score == empty[101].score
    for known, want in (("quality = 1", 1.0), ("false", 0.5)):
        out, name = Q.score(d, Q.train(d, labels.where(known), F.lit(True), features=32), keep=["doc_id"])
        assert {r[0] for r in out.select(f"{name}.score").collect()} == {want}
    assert Q.score(docs(spark, []), model)[0].count() == 0
