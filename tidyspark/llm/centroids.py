"""Centroid clustering (Lloyd's rounds) with heap-ordered bounds, exact in integers.

Vectors become integers, floor(scale * x), and are packed into blocks of at most
``BLOCK`` rows, written once. In a block every cluster keeps a heap of its
vectors ordered by gap: the distance to the second nearest centroid less that
to the nearest, at the time of the last scan, plus the cluster's accumulated drift
at that time. A round moves the centroids; a cluster's drift grows by its own
centroid's move plus the largest move of another one, which is the most that a
gap can have lost. So a vector may change its cluster only if its entry is not
over the accumulated drift: those are popped from the heaps, scanned against all centroids
exactly and pushed anew. All others are neither popped nor scanned.

One round is one pass over the blocks joined with their heaps. Both tables are
bucketed by block, so the join has no exchange; a pass writes the heaps and what the moved
vectors add to and take from the clusters' sums. Tasks sum these by partition, Spark adds the
partitions, and the driver gets clusters * (components + 1) numbers. Gaps
are floating-point bounds and expire a little early; distances, ties (to the
smaller cluster), sums and floors are exact.

Defined results: a vector takes part if it has exactly ``components``
components, none null or non-finite; others get no row. Repeated rows are
clustered row by row. Fewer vectors than clusters make as many clusters
as vectors; an empty table gives an empty result. Equal first hashes (repeated
or null ids; a null id counts as empty text) go by components. An integer beyond
the range in which squared distances fit a long is an error. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidyspark.llm.common import BATCH_SETTING, drop_path, ship_code, write_stage
from tidyspark.session import scratch_path

BLOCK = 1024                       # vectors of a block
BLOCKS_A_BATCH = 32                # blocks in one Arrow batch
BLOCKS_A_BUCKET = 512              # at most about so many blocks in one task
BLOCKS = "block long, ids array<long>, data binary, width int, largest long"
HEAPS = "block long, sizes array<int>, gaps binary, rows binary, added array<long>"
EXACT_FLOAT = 1 << 53


def scaled_floor(values: np.ndarray, scale: float, components: int) -> np.ndarray:
    """Integers of a matrix of finite numbers; an error if squared distances could pass a long."""
    out = np.floor(values.astype(np.float64) * scale)
    bound = math.isqrt((1 << 62) // max(components, 1)) // 2
    if out.size and np.abs(out).max() > bound:
        raise ValueError(f"a component beyond {bound / scale:g} gives squared distances over 63 bits")
    return out.astype(np.int64)


def squared_distances(x: np.ndarray, centroids: np.ndarray, largest: int) -> np.ndarray:
    """Exact squared distances of integer rows to integer centroids."""
    largest = max(largest, int(np.abs(centroids).max(initial=0)))
    if 4 * x.shape[1] * largest * largest < EXACT_FLOAT:      # every partial sum is exact
        a, c = x.astype(np.float64), centroids.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ c.T) + (c * c).sum(1)).astype(np.int64)
    return np.stack([((x.astype(np.int64) - c) ** 2).sum(1) for c in centroids], 1)


class Round:
    """What a pass needs: the centroids and the accumulated drift of each cluster."""

    def __init__(self, centroids: np.ndarray, drift: np.ndarray):
        self.centroids, self.drift = centroids, drift

    def moved_to(self, centroids: np.ndarray) -> Round:
        moves = np.sqrt(((centroids - self.centroids).astype(np.float64) ** 2).sum(1))
        others = [max((moves[j] for j in range(len(moves)) if j != i), default=0.0) for i in range(len(moves))]
        return Round(centroids, self.drift + moves + np.array(others))


class BlockHeaps:
    """The heaps of one block: for every cluster (gap + drift at the scan, row), the next to expire on top."""

    def __init__(self, x: np.ndarray, largest: int, step: Round):
        self.x, self.largest, self.step = x, largest, step
        k = len(step.centroids)
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in range(k)]
        self.added_n = np.zeros(k, np.int64)
        self.added = np.zeros((k, x.shape[1]), np.int64)
        reach = max(largest, int(np.abs(step.centroids).max(initial=0)))
        self.early = 1e-9 * (1 + 2 * math.sqrt(x.shape[1]) * reach)      # far over the bounds' rounding errors

    def load(self, sizes, gaps: bytes, rows: bytes) -> None:
        g, r = np.frombuffer(gaps).tolist(), np.frombuffer(rows, np.int32).tolist()
        start = 0
        for c, n in enumerate(sizes):
            self.heaps[c] = list(zip(g[start:start + n], r[start:start + n]))
            start += n

    def _scan(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        d = squared_distances(self.x[rows], self.step.centroids, self.largest)
        nearest = d.argmin(1)
        if d.shape[1] == 1:
            return nearest, np.full(len(rows), np.inf)
        two = np.sqrt(np.partition(d, 1, axis=1)[:, :2].astype(np.float64))
        return nearest, two[:, 1] - two[:, 0]

    def first_scan(self) -> None:
        nearest, gap = self._scan(np.arange(len(self.x)))
        for c in range(len(self.heaps)):
            mine = np.flatnonzero(nearest == c)
            mine = mine[np.argsort(gap[mine], kind="stable")]        # a sorted list is a heap
            self.heaps[c] = list(zip((gap[mine] + self.step.drift[c]).tolist(), mine.tolist()))
            self.added_n[c], self.added[c] = len(mine), self.x[mine].sum(0, dtype=np.int64)

    def rescan(self) -> int:
        """Pop what has expired, scan it, push it anew; the number of popped vectors."""
        rows, old = [], []
        for c, heap in enumerate(self.heaps):
            limit = self.step.drift[c] + self.early
            while heap and heap[0][0] <= limit:
                rows.append(heapq.heappop(heap)[1])
                old.append(c)
        if not rows:
            return 0
        at, was = np.array(rows), np.array(old)
        now, gap = self._scan(at)
        for row, c, g in zip(rows, now.tolist(), (gap + self.step.drift[now]).tolist()):
            heapq.heappush(self.heaps[c], (g, row))
        changed = np.flatnonzero(now != was)
        for sign, clusters in ((1, now), (-1, was)):
            np.add.at(self.added_n, clusters[changed], sign)
            np.add.at(self.added, clusters[changed], sign * self.x[at[changed]].astype(np.int64))
        return len(rows)

    def assigned(self) -> np.ndarray:
        out = np.zeros(len(self.x), np.int32)
        for c, heap in enumerate(self.heaps):
            out[[row for _, row in heap]] = c
        return out

    def row(self, block: int) -> tuple:
        pairs = [p for heap in self.heaps for p in heap]
        return (block, [len(h) for h in self.heaps], np.array([p[0] for p in pairs]).tobytes(),
                np.array([p[1] for p in pairs], np.int32).tobytes(),
                np.concatenate([self.added_n, self.added.ravel()]).tolist())


def _matrix(data: bytes, width: int, components: int) -> np.ndarray:
    return np.frombuffer(data, {2: np.int16, 4: np.int32, 8: np.int64}[width]).reshape(-1, components)


def _record(rows: list[tuple], ddl_types: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(ddl_types)], names=names)


def _pack(kept: DataFrame, components: int, scale: float) -> DataFrame:
    """Blocks of integer vectors from (id, vector) rows."""
    def run(batches):
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 33
        ids, parts, held = [], [], 0

        def block(n):
            nonlocal ids, parts, held, number
            x = np.concatenate(parts) if len(parts) > 1 else parts[0]
            out, parts, held = x[:n], [x[n:]], len(x) - n
            largest = int(np.abs(out).max(initial=0))
            width = 2 if largest < 1 << 15 else 4 if largest < 1 << 31 else 8
            row = (number, ids[:n], out.astype(f"<i{width}").tobytes(), width, largest)
            ids, number = ids[n:], number + 1
            return _record([row], [pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.int32(), pa.int64()],
                           ["block", "ids", "data", "width", "largest"])

        for b in batches:
            if not b.num_rows:
                continue
            vectors = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, components)
            parts.append(scaled_floor(vectors, scale, components))
            ids += b.column(0).to_pylist()
            held += b.num_rows
            while held >= BLOCK:
                yield block(BLOCK)
        if held:
            yield block(held)

    return kept.mapInArrow(run, BLOCKS)


class _Bucketed:
    """Tables bucketed by block below the checkpoint folder; dropped, with their files, at the end."""

    def __init__(self, spark: SparkSession, buckets: int):
        self.spark, self.buckets, self.paths = spark, buckets, {}

    def write(self, df: DataFrame, label: str) -> str:
        path = scratch_path(self.spark, label)
        name = path.rsplit("/", 1)[1].replace("-", "_")
        self.paths[name] = path
        df.write.bucketBy(self.buckets, "block").option("path", path).saveAsTable(name)
        return name

    def drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        drop_path(self.spark, self.paths.pop(name))

    def drop_all(self) -> None:
        for name in list(self.paths):
            self.drop(name)


@contextmanager
def _small_batches(spark: SparkSession):
    """A row is a whole block, so an Arrow batch has few of them."""
    before = spark.conf.get(BATCH_SETTING)
    spark.conf.set(BATCH_SETTING, str(BLOCKS_A_BATCH))
    try:
        yield
    finally:
        spark.conf.set(BATCH_SETTING, before)


def _pass(blocks: DataFrame, heaps: DataFrame | None, step: Round, final: bool) -> DataFrame:
    """One assignment of all vectors; the heaps and changes of sums, or in the final pass (id, cluster, distance)."""
    components = step.centroids.shape[1]
    both = blocks if heaps is None else blocks.join(heaps.drop("added").hint("merge"), "block")

    def run(batches):
        for b in batches:
            columns = b.to_pydict()
            for i, block in enumerate(columns["block"]):
                x = _matrix(columns["data"][i], columns["width"][i], components)
                state = BlockHeaps(x, columns["largest"][i], step)
                if "sizes" in columns:
                    state.load(columns["sizes"][i], columns["gaps"][i], columns["rows"][i])
                    state.rescan()
                else:
                    state.first_scan()
                if not final:
                    yield _record([state.row(block)], [pa.int64(), pa.list_(pa.int32()), pa.binary(), pa.binary(),
                                                       pa.list_(pa.int64())],
                                  ["block", "sizes", "gaps", "rows", "added"])
                    continue
                cluster = state.assigned()
                distance = np.zeros(len(x), np.int64)
                for c in range(len(step.centroids)):
                    mine = np.flatnonzero(cluster == c)
                    distance[mine] = squared_distances(x[mine], step.centroids[c:c + 1], state.largest)[:, 0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns["ids"][i], pa.int64()), pa.array(cluster), pa.array(distance)],
                    names=["id", "cluster", "distance"])

    return both.mapInArrow(run, "id long, cluster int, distance long" if final else HEAPS)


def _changes(heaps: DataFrame, k: int, components: int) -> np.ndarray:
    """What a round added to the clusters' counts and sums: k * (components + 1) whole numbers of any size."""
    def run(batches):
        total = 0
        for b in batches:
            if b.num_rows:
                total = total + b.column(0).flatten().to_numpy().reshape(b.num_rows, -1).sum(0)
        if not isinstance(total, int):
            places = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(places, pa.int32()), pa.array(total[places], pa.int64())],
                                             names=["place", "value"])

    rows = (heaps.select("added").mapInArrow(run, "place int, value long")
            .groupBy("place").agg(F.sum(F.col("value").cast("decimal(38,0)"))).collect())
    out = np.zeros(k * (components + 1), dtype=object)
    for place, value in rows:
        out[place] = int(value)
    return out


def clusters(df: DataFrame, k: int = 8, rounds: int = 10, components: int = 64, scale: float = 1024.0,
             seed: int = 3, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Cluster the vectors of ``df``: (id, cluster, distance, cluster_inertia, inertia, centroid_sha256).

    Centroids start as the ``k`` vectors with the smallest sha256 of ``<seed>:<id>``; each
    of ``rounds`` rounds assigns all vectors and replaces every non-empty centroid by the floor of
    its vectors' mean; then vectors are assigned once more.
    """
    spark = df.sparkSession
    ship_code(spark)
    kept = (df.select(df[id_col].cast("long").alias("id"), df[vector].cast("array<double>").alias("x"))
            .where(F.size("x") == components)
            .where(F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))))
    # a bounded number of rows reach the driver: k, and later k * (components + 1) sums a round
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    chosen = [r.x for r in kept.select("x", order.alias("h")).orderBy("h", "x").limit(k).collect()]
    if not chosen:
        return spark.createDataFrame([], f"{id_col} long, cluster int, distance long, cluster_inertia long, "
                                         "inertia long, centroid_sha256 string")
    step = Round(scaled_floor(np.array(chosen), scale, components), np.zeros(len(chosen)))
    k = len(chosen)
    totals = np.zeros(k * (components + 1), dtype=object)

    packed = write_stage(_pack(kept, components, scale), "centroid-packed")
    n = packed.count()
    buckets = max(1, min(n, int(spark.conf.get("spark.sql.shuffle.partitions"))), n // BLOCKS_A_BUCKET)
    stored = _Bucketed(spark, buckets)
    try:
        with _small_batches(spark):
            blocks = spark.table(stored.write(packed.repartition(buckets, "block"), "centroid-blocks"))
            held = None
            for _ in range(rounds):
                before, held = held, stored.write(
                    _pass(blocks, spark.table(held) if held else None, step, False), "centroid-heaps")
                if before:
                    stored.drop(before)
                totals = totals + _changes(spark.table(held), k, components)
                counts, sums = totals[:k], totals[k:].reshape(k, components)
                step = step.moved_to(np.array([[int(s) // int(counts[c]) for s in sums[c]] if counts[c]
                                               else step.centroids[c] for c in range(k)], dtype=np.int64))
            out = write_stage(_pass(blocks, spark.table(held) if held else None, step, True), "centroid-rows")
    finally:
        stored.drop_all()
    inertia = dict(out.groupBy("cluster").agg(F.sum("distance")).collect())
    about = [(c, inertia[c], sum(inertia.values()), hashlib.sha256(",".join(map(str, step.centroids[c].tolist()))
                                                                   .encode()).hexdigest()) for c in sorted(inertia)]
    labels = spark.createDataFrame(about, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return (out.join(F.broadcast(labels), "cluster")            # k rows
            .select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))
