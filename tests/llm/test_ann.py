import numpy as np
from pyspark.sql import functions as F

from tidyspark.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int, score string, rank string, rep string, keys string, id string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "s", "r", "p", "k", "i") for i, v in rows], SCHEMA)


def brute(rows, is_query, k):
    out = {}
    for q, v in rows:
        if is_query(q):
            s = sorted(((-float(np.dot(np.float32(v).astype(float), np.float32(w).astype(float))), i)
                        for i, w in rows if i != q))[:k]
            out[q] = [(i, -x) for x, i in s]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def same(got, want):
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]], q
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], atol=1e-12)


def test_exact_when_all_are_reached(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.standard_normal(6) * rng.random() * 3).tolist()) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(40)]                       # copies tie, smaller ids first
    df = table(spark, rows)
    got = ann.nearest(df, F.col("vec_id") % 20 == 0, k=7, trees=3, target=1.0, chunk=11)
    same(found(got), brute(rows, lambda q: q % 20 == 0, 7))


def test_cases(spark):
    ok = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.0, -2.0]), (20, [1.0, 0.0])]
    odd = [(40, None), (3, []), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, [None, 1.0]),
           (None, [1.0, 1.0]), (60, [1.0, 2.0, 3.0]), (1, [0.5, 0.5]), (2, [-5.0, -2.0])]
    got = ann.nearest(table(spark, ok + odd), F.col("vec_id") % 20 == 0, target=1.0)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    same(found(got), brute(ok, lambda q: q % 20 == 0, 20))
    assert ann.nearest(table(spark, []), F.col("vec_id") % 20 == 0).count() == 0
    assert ann.nearest(table(spark, odd[:7]), F.col("vec_id") % 20 == 0).count() == 0
    alone = ann.nearest(table(spark, [(20, [1.0, 2.0])]), F.col("vec_id") % 20 == 0)
    assert alone.count() == 0


def test_many_copies_of_one_vector(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [0.6, 0.8, 0.0] if i % 3 else rng.standard_normal(3).tolist()) for i in range(300)]
    got = found(ann.nearest(table(spark, rows), F.col("vec_id") % 20 == 0, k=5, trees=2, target=1.0, chunk=16))
    same(got, brute([(i, np.float32(v).tolist()) for i, v in rows], lambda q: q % 20 == 0, 5))


def test_outliers_of_dense_clusters_get_all_their_rows(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((1040, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[40:] = x[:2].repeat(500, axis=0) + 0.02 * x[40:]                    # 40 outliers, two tight clusters
    rows = [(i, x[j].astype("float32").tolist()) for i, j in enumerate(rng.permutation(len(x)))]
    is_query = lambda q: q % 4 == 0
    got = found(ann.nearest(table(spark, rows), F.col("vec_id") % 4 == 0, sample_queries=6, chunk=100))
    assert len(got) == 260 and all(len(g) == 20 for g in got.values())
    want = brute(rows, is_query, 20)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 20 * len(want)


def test_no_group_holds_all_queries_of_a_prefix(spark):
    rows = spark.range(1000).selectExpr("id AS rep", "0 AS tree", "if(id < 900, 0, 1) AS prefix")
    sizes = rows.groupBy("tree", "prefix").count().withColumnRenamed("count", "n")
    dealt, asked = ann._deal(rows, rows.where("rep % 2 = 0"), sizes, ["tree", "prefix"], 50)
    group = ["tree", "prefix", "part", "query_part"]
    for side in (dealt, asked):
        assert max(r["count"] for r in side.groupBy(*group).count().collect()) <= 100
    pairs = (dealt.withColumnRenamed("rep", "c").join(asked.withColumnRenamed("rep", "q"), group)
             .select("q", "c").groupBy("q", "c").count())
    assert pairs.count() == 450 * 900 + 50 * 100 and pairs.where("count > 1").count() == 0


def test_recall_and_scores_of_the_query(spark):
    import __spark_entry__ as entry
    sf = "/root/testdata/sf0.01"
    got = found(entry.queries()["op8_nearest"](spark, sf))
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = brute(rows, lambda q: q % 20 == 0, 20)
    assert got.keys() == want.keys() and all(len(g) == 20 for g in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 20 * len(want)
    x = {i: np.array(v, dtype=float) for i, v in rows}
    assert all(abs(s - x[q] @ x[i]) < 1e-12 for q in got for i, s in got[q])


def test_prefix_length():
    a = np.array([0, 1, 1 << 47, (1 << 48) - 1])
    assert ann.prefix_length(a, np.zeros(4, np.int64)).tolist() == [48, 47, 0, 0]


def test_ties_at_the_last_place_go_to_smaller_ids(spark):
    rnd = np.random.default_rng(8)
    x = rnd.integers(-1, 2, (600, 6)).astype(float)
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x) if np.abs(r).sum()]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest(df, F.col("vec_id") % 20 == 0, k=5, target=1.0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    by_id = dict(rows)
    for q, found in got.items():
        want = sorted((-sum(a * b for a, b in zip(by_id[q], v)), i) for i, v in rows if i != q)[:5]
        assert [(i, -s) for s, i in want] == [(i, s) for _, i, s in sorted(found)], q
