"""Nearest neighbours by a hash-prefix forest.

Every tree gives a vector a long string of sign bits; a tree is the sorted array of
these strings. A query descends to the vectors that share its longest prefix
in each tree, then ascends in all trees at once, one bit at a time, until the
vectors reached (over all trees) number ``effort``. Those are scored exactly.

``effort`` is measured, not guessed: a bounded sample of queries is compared
with all vectors by brute force, and the least effort whose recall on it
reaches ``target`` is taken, together with the shortest prefix it ever needs. It
is at least ``trees * (k + 1)``, which no fewer than k + 1 vectors can fill.
Sorted arrays are dealt out by tree and that shortest prefix; the vectors of a
prefix are dealt into chunks, its queries too, and every chunk of vectors
meets every chunk of queries, so no task holds an unbounded part of either.

The sample may miss queries in sparse regions. Those that reach less than
``effort`` by the sample's shortest prefix have an effort measured on a sample of
their own (no less than the first), and go on to the longest prefix by which they
reach it, found from the sizes of all shorter prefixes; at the empty one a query
meets all vectors, once. Arrays are dealt out again by those lengths, as far as such
queries have prefixes in them.

Inner products are searched as angles: vectors are scaled by the largest norm
and get one more coordinate that makes their lengths equal; queries get zero.

Equal vectors are one entry of the forest: only their k + 1 smallest ids can be
among a query's k nearest, since ties go to the smaller id.

Defined results: null, empty or zero vectors and those with null or non-finite
components take no part, nor do rows without an id or with another length than
the most frequent; of several vectors of one id the greatest (component by
component) counts; ties go to the smaller id; a query has fewer than k rows only
if the table has fewer other vectors; an empty table gives no rows.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidyspark.llm.common import broadcast_value, ship_code, write_stage

BITS = 48


def directions(dim: int, trees: int, seed: int = 5) -> np.ndarray:
    """Unit vectors of all trees' bits, orthogonal in runs of at most ``dim``."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(trees):
        left = BITS
        while left:
            q, _ = np.linalg.qr(rng.standard_normal((dim, min(left, dim))))
            out.append(q)
            left -= q.shape[1]
    return np.concatenate(out, axis=1)


def keys_of(x: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """One string per row and tree, as an integer of BITS bits."""
    trees = planes.shape[1] // BITS
    weight = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)
    return np.stack([((x @ planes[:, t * BITS:(t + 1) * BITS]) > 0) @ weight for t in range(trees)], 1)


def prefix_length(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of strings."""
    _, exponent = np.frexp((a ^ b).astype(float))
    return BITS - exponent


def _rows(vectors, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), kind).reshape(len(vectors), -1).astype(float)


def _augmented(x: np.ndarray, largest: float, is_query: bool) -> np.ndarray:
    if is_query:
        return np.concatenate([x / np.linalg.norm(x, axis=1, keepdims=True), np.zeros((len(x), 1))], 1)
    x = x / largest
    rest = np.sqrt(np.maximum(0.0, 1.0 - (x * x).sum(axis=1)))
    return np.concatenate([x, rest[:, None]], 1)


def _empty(first: str, *lists: str) -> pd.DataFrame:
    return pd.DataFrame({first: pd.Series(dtype="int64"), **{c: pd.Series(dtype=object) for c in lists}})


def vectors_of(df: DataFrame, id_col: str, vec: str) -> tuple[DataFrame, str, int]:
    """Rows (id, vec as bytes) that take part, one per id; the number type and the length."""
    ship_code(df.sparkSession)
    value = F.col(vec)
    valid = (value.isNotNull() & (F.size(value) > 0)
             & F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
             & F.exists(value, lambda x: x != 0))
    rows = df.where(F.col(id_col).isNotNull() & valid).select(F.col(id_col).cast("long").alias("id"), value.alias("vec"))
    lengths = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    dim = lengths[0] if lengths else 1
    is_float = isinstance(df.schema[vec].dataType.elementType, T.FloatType)
    kind, width = ("<f4", 4) if is_float else ("<f8", 8)

    def pack(batches):
        for b in batches:
            flat = np.ascontiguousarray(b.column(1).flatten().to_numpy(zero_copy_only=False).astype(kind))
            offsets = np.arange(b.num_rows + 1, dtype=np.int32) * (dim * width)
            packed = pa.Array.from_buffers(pa.binary(), b.num_rows,
                                           [None, pa.py_buffer(offsets), pa.py_buffer(flat)])
            yield pa.RecordBatch.from_arrays([b.column(0), packed], names=["id", "vec"])

    one = rows.where(F.size("vec") == dim).groupBy("id").agg(F.max("vec").alias("vec"))
    return one.mapInArrow(pack, "id long, vec binary"), kind, dim


def _tune(entries: DataFrame, sample: list, kind: str, planes, k: int, target: float):
    """(effort, shortest prefix): the least effort that reaches the target recall on sample queries."""
    spark = entries.sparkSession
    q = _rows([r[1] for r in sample], kind)
    shared = broadcast_value(spark, (q, np.array([r[2] for r in sample], np.int64), [r[0] for r in sample]))

    def scan(batches):
        queries, query_keys, reps = shared.value
        trees, n = query_keys.shape[1], len(queries)
        reach = np.zeros((n, BITS + 1), np.int64)
        best = [[] for _ in range(n)]
        for frame in batches:
            x = _rows(frame["vec"], kind)
            keys = np.array(frame["keys"].tolist(), np.int64)
            scores = queries @ x.T
            own = frame["rep"].to_numpy()
            for i in range(n):
                depth = prefix_length(keys, query_keys[i][None, :])
                reach[i] += np.bincount(depth.ravel(), minlength=BITS + 1)
                scores[i, own == reps[i]] = -np.inf
                top = np.argpartition(-scores[i], min(k, len(x)) - 1)[:k]
                deepest = depth[top].max(axis=1)
                best[i] = sorted(best[i] + list(zip(scores[i, top].tolist(), deepest.tolist())), reverse=True)[:k]
        yield pd.DataFrame({"q": range(n), "reach": reach.tolist(), "score": [[s for s, _ in b] for b in best],
                            "depth": [[d for _, d in b] for b in best]})

    parts = (entries.select("rep", "vec", "keys")
             .mapInPandas(scan, "q int, reach array<long>, score array<double>, depth array<int>"))
    # tasks times sample rows would grow with the table: add up before they reach the driver
    reach = (parts.select("q", F.posexplode("reach")).groupBy("q", "pos").agg(F.sum("col").alias("n")).collect())
    w = Window.partitionBy("q").orderBy(F.desc("score"))
    best = (parts.select("q", F.explode(F.arrays_zip("score", "depth")).alias("s")).select("q", "s.*")
            .withColumn("r", F.row_number().over(w)).where(F.col("r") <= k).select("q", "depth").collect())
    counts = np.zeros((len(sample), BITS + 1), np.int64)
    for i, pos, n in reach:
        counts[i, pos] = n
    within = counts[:, ::-1].cumsum(axis=1)[:, ::-1]               # vectors with a prefix of d bits or more
    depths = [np.array([d for i, d in best if i == j]) for j in range(len(sample))]
    least = planes.shape[1] // BITS * (k + 1)                                  # a vector counts once a tree at most
    for effort in sorted({max(least, int(2 ** (e / 4))) for e in range(20, 4 * 62)}):
        stop = np.array([np.flatnonzero(c >= effort).max(initial=0) for c in within])
        found = np.concatenate([d >= s for d, s in zip(depths, stop)])
        if not len(found) or found.mean() >= target or stop.max() == 0:
            return effort, int(max(0, stop.min() - 1))


def _deal(candidates: DataFrame, queries: DataFrame, sizes: DataFrame, keys: list[str], chunk: int):
    """Candidates and queries with ``part`` and ``query_part``: chunks of about ``chunk`` rows, all pairs of a key's."""
    asked = queries.groupBy(*keys).agg(F.count(F.lit(1)).alias("asked"))
    chunks = write_stage(sizes.join(asked, keys).select(
        *keys, *[F.ceil(F.col(n) / chunk).cast("int").alias(c) for n, c in (("n", "chunks"), ("asked", "query_chunks"))]),
        "ann-chunks")

    def own(n):
        return F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")

    def each(n):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    return (candidates.join(chunks, keys).withColumn("part", own("chunks")).withColumn("query_part", each("query_chunks")),
            queries.join(chunks, keys).withColumn("part", each("chunks")).withColumn("query_part", own("query_chunks")))


def nearest(df: DataFrame, is_query: Column, id_col: str = "vec_id", vec: str = "embedding", k: int = 20,
            trees: int = 24, target: float = 0.94, sample_queries: int = 64, chunk: int = 8000) -> DataFrame:
    """Rows (query_id, rank, vec_id, score) for the rows where ``is_query`` (over ``id_col``) holds."""
    rows, kind, dim = vectors_of(df, id_col, vec)
    rows = write_stage(rows, "ann-rows")
    flagged = rows.withColumn(id_col, F.col("id")).withColumn("is_query", is_query).select("id", "vec", "is_query")
    of_vec = Window.partitionBy("vec").orderBy("id")
    members = (flagged.withColumn("r", F.row_number().over(of_vec)).where(F.col("r") <= k + 1)
               .groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids")))
    asked = flagged.groupBy("vec").agg(F.max("is_query").alias("asked"))
    planes = directions(dim + 1, trees)
    base = write_stage(members.join(asked, "vec").select(F.col("ids")[0].alias("rep"), "vec", "ids", "asked"),
                       "ann-distinct")

    def largest_norm(batches):
        for frame in batches:
            yield pd.DataFrame({"n": [float(np.sqrt((_rows(frame["vec"], kind) ** 2).sum(axis=1).max()))]})

    largest = base.select("vec").mapInPandas(largest_norm, "n double").agg(F.max("n")).first()[0] or 1.0

    def hash_all(batches):
        for frame in batches:
            x = _rows(frame["vec"], kind)
            frame["keys"] = keys_of(_augmented(x, largest, False), planes).tolist()
            frame["query_keys"] = keys_of(_augmented(x, largest, True), planes).tolist()
            yield frame

    entries = write_stage(base.mapInPandas(
        hash_all, "rep long, vec binary, ids array<long>, asked boolean, keys array<long>, query_keys array<long>"),
        "ann-entries")
    queries = entries.where("asked").select("rep", "vec", "query_keys")
    sample = queries.orderBy(F.xxhash64("rep"), "rep").limit(sample_queries).collect()
    empty = "query_id long, rank int, vec_id long, score double"
    if not sample:
        return df.sparkSession.createDataFrame([], empty)
    effort, floor = _tune(entries, sample, kind, planes, k, target)

    shift = BITS - floor
    of_tree = F.posexplode("keys").alias("tree", "key")
    candidates = entries.select("rep", "vec", of_tree).withColumn("prefix", F.shiftright("key", shift))
    sizes = write_stage(candidates.groupBy("tree", "prefix").agg(F.count(F.lit(1)).alias("n")), "ann-prefixes")
    asked_keys = (queries.select("rep", "vec", F.posexplode("query_keys").alias("tree", "key"))
                  .withColumn("prefix", F.shiftright("key", shift)))
    dealt, asked_in = _deal(candidates, asked_keys, sizes, ["tree", "prefix"], chunk)
    group = ["tree", "prefix", "part", "query_part"]
    columns = [*group, "rep", "key"]

    def count_reach(group: pd.DataFrame) -> pd.DataFrame:
        keys = np.sort(group["key"].to_numpy()[~group["is_query"].to_numpy()])
        q = group[group["is_query"]]
        if not len(q):
            return _empty("rep", "reach")
        qk = q["key"].to_numpy()
        counts = []
        for d in range(floor, BITS + 1):
            low = qk >> (BITS - d) << (BITS - d)
            counts.append(np.searchsorted(keys, low + (1 << (BITS - d))) - np.searchsorted(keys, low))
        return pd.DataFrame({"rep": q["rep"].to_numpy(), "reach": np.array(counts).T.tolist()})

    both = (dealt.select(*columns, F.lit(False).alias("is_query"))
            .union(asked_in.select(*columns, F.lit(True).alias("is_query"))))
    depths = range(BITS + 1 - floor)
    reach = (both.groupBy(*group).applyInPandas(count_reach, "rep long, reach array<long>")
             .groupBy("rep").agg(*[F.sum(F.col("reach")[i]).alias(f"r{i}") for i in depths]))
    # the deepest level with enough vectors
    stop = F.lit(None)
    for i in depths:
        stop = F.when(F.col(f"r{i}") >= effort, F.lit(floor + i)).otherwise(stop)
    reach = write_stage(reach.select("rep", stop.cast("int").alias("stop")).where("stop IS NOT NULL"), "ann-depths")

    # the other queries: the longest prefix below the floor, down to the empty one, with enough vectors
    late = queries.join(reach, "rep", "left_anti").select("rep", "vec", F.posexplode("query_keys").alias("tree", "key"))
    late = write_stage(late, "ann-late")
    sample = (queries.join(late.select("rep").distinct(), "rep", "left_semi").select("rep", "vec", "query_keys")
              .orderBy(F.xxhash64("rep"), "rep").limit(sample_queries).collect())
    late_effort = max(effort, _tune(entries, sample, kind, planes, k, target)[0]) if sample else effort
    shorter = (sizes.select("tree", "n", "prefix", F.explode(F.sequence(F.lit(0), F.lit(max(floor - 1, 0)))).alias("level"))
               .withColumn("prefix", F.expr(f"shiftright(prefix, {floor} - level)"))
               .groupBy("level", "tree", "prefix").agg(F.sum("n").alias("n")))
    shorter = write_stage(shorter, "ann-shorter")
    at_level = F.expr(f"shiftright(key, {BITS} - level)")
    enough = (late.select("rep", "tree", "key", F.explode(F.sequence(F.lit(0), F.lit(max(floor - 1, 0)))).alias("level"))
              .where("level > 0").withColumn("prefix", at_level).join(shorter, ["level", "tree", "prefix"])
              .groupBy("rep", "level").agg(F.sum("n").alias("n")).where(F.col("n") >= late_effort)
              .groupBy("rep").agg(F.max("level").alias("found")))
    # all trees are alike at the empty prefix: one will do
    late = write_stage(late.join(enough, "rep", "left").withColumn("level", F.coalesce("found", F.lit(0)))
                       .where("level > 0 OR tree = 0").withColumn("prefix", at_level)
                       .select("level", "tree", "prefix", "rep", "key", "vec"), "ann-late-levels")
    levels = sorted(r[0] for r in late.select("level").distinct().collect())           # BITS at most

    def score(group: pd.DataFrame) -> pd.DataFrame:
        is_q = group["is_query"].to_numpy()
        c, q = group[~is_q].sort_values("key"), group[is_q]
        if not len(c) or not len(q):
            return _empty("rep", "found", "score")
        x, keys, reps = _rows(c["vec"], kind), c["key"].to_numpy(), c["rep"].to_numpy()
        out = []
        for a in range(0, len(q), 256):
            part = q.iloc[a:a + 256]
            y, bits = _rows(part["vec"], kind), (BITS - part["stop"]).to_numpy()
            low = part["key"].to_numpy() >> bits << bits
            begin = np.searchsorted(keys, low)
            end = np.searchsorted(keys, low + (np.int64(1) << bits))
            products = y @ x.T
            scale = np.sqrt((y * y).sum(axis=1)) * largest
            for i, (s, e, rep) in enumerate(zip(begin, end, part["rep"])):
                if s < e:
                    some = products[i, s:e]
                    top = np.arange(s, e)
                    if e - s > k + 1:
                        # all that may equal the last place, whatever the rounding of either way to multiply
                        last = np.partition(some, e - s - k - 1)[e - s - k - 1]
                        top = s + np.flatnonzero(some >= last - 1e-9 * scale[i])
                    exact = (x[top] * y[i]).sum(axis=1)
                    first = np.lexsort((reps[top], -exact))[:k + 1]
                    out.append((rep, reps[top][first].tolist(), exact[first].tolist()))
        return pd.DataFrame(out, columns=["rep", "found", "score"]) if out else _empty("rep", "found", "score")

    def scored(dealt, asked_in, *of):
        with_vec = (dealt.select(*of, *columns, "vec", F.lit(0).alias("stop"), F.lit(False).alias("is_query"))
                    .union(asked_in.select(*of, *columns, "vec", "stop", F.lit(True).alias("is_query"))))
        return (with_vec.groupBy(*of, *group)
                .applyInPandas(score, "rep long, found array<long>, score array<double>"))

    found = scored(dealt, asked_in.join(reach, "rep"))
    if levels:
        keys = ["level", "tree", "prefix"]
        again = (entries.select("rep", "vec", of_tree)
                 .select("*", F.explode(F.array(*[F.lit(v) for v in levels])).alias("level"))
                 .where("level > 0 OR tree = 0").withColumn("prefix", at_level))
        again, late = _deal(again, late, shorter, keys, chunk)
        found = found.union(scored(again, late.withColumn("stop", F.col("level")), "level"))

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        best = dict(zip(np.concatenate(group["found"].to_list()).tolist(),
                        np.concatenate(group["score"].to_list()).tolist()))
        top = sorted(best.items(), key=lambda f: (-f[1], f[0]))[:k + 1]
        return pd.DataFrame({"query_rep": int(group["rep"].iloc[0]), "rep": [f for f, _ in top],
                             "score": [s for _, s in top]})

    merged = found.groupBy("rep").applyInPandas(merge, "query_rep long, rep long, score double")
    order = [F.desc("score"), F.asc("vec_id")]
    ids = (merged.join(entries.select("rep", "ids"), "rep")
           .select("query_rep", "score", F.explode("ids").alias("vec_id"))
           .withColumn("r", F.row_number().over(Window.partitionBy("query_rep").orderBy(*order)))
           .where(F.col("r") <= k + 1).select("query_rep", "vec_id", "score"))
    of_query = (flagged.where("is_query").select("vec", F.col("id").alias("query_id"))
                .join(entries.where("asked").select("vec", F.col("rep").alias("query_rep")), "vec")
                .select("query_rep", "query_id"))
    return (of_query.join(ids, "query_rep").where("vec_id <> query_id")
            .withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order)))
            .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
