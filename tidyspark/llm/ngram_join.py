"""Similarity join on word n-grams: MinHash banding, then exact verification.

A text is the set of its runs of ``n`` words (lower case, letters and digits); a
shorter text is one run. Texts with equal sets are one node from the start, so
groups of copies never meet as pairs. Band and row counts follow from the
similarity and the recall wanted at it. Nodes are shuffled on band hashes:

* a bucket of at most ``bucket_pairs`` nodes yields its pairs, each once over
  all bands, which are verified by joining the full sets;
* nodes of a larger bucket form a supergroup (components over such buckets).
  A supergroup is dealt into blocks of about ``block`` nodes; every pair of
  blocks is one task that intersects all sets of both by a matrix product and
  returns one row per node (links, one tree edge), never the pairs.

So every link between different sets that shares a band is found and counted;
inside supergroups all links are. Classes are the connected components.

Defined results: a null or wordless text, or one without an id, is in a class
of its own and has no links (class_id is its own id); repeated rows are copies
of each other; ties in a class go to its smallest id, which names the class; an
empty table gives no rows; texts of any length are taken whole. Extra columns
are not read.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidyspark.llm.common import Memo, ship_code, text_slices, whole_chunks, worker_cached, write_stage
from tidyspark.llm.components import components

WORDS = re.compile(r"\w+")
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def choose_bands(similarity: float, recall: float, most_hashes: int = 128) -> tuple[int, int]:
    """(bands, rows): the most rows whose bands reach the recall at the similarity within the hash budget.

    An error if no number of rows does: fewer bands would lose pairs.
    """
    if not (0 < similarity <= 1 and 0 < recall < 1):
        raise ValueError("similarity must be over 0 and at most 1, recall between 0 and 1")
    best, needed = None, math.inf
    for rows in range(1, 33):
        hit = similarity ** rows
        bands = 1 if hit >= 1 else max(1, math.ceil(math.log1p(-recall) / math.log1p(-hit)))
        needed = min(needed, bands * rows)
        if bands * rows <= most_hashes:
            best = (bands, rows)
    if best is None:
        raise ValueError(f"similarity {similarity} at recall {recall} needs {needed} hashes, more than {most_hashes}")
    return best


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _word_memo() -> Memo:
    return worker_cached("ngram_words", lambda: Memo(lambda w: xxhash.xxh64_intdigest(w.encode()), 300_000))


def ngram_set(text: str | None, n: int, memo: Memo) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct word n-grams."""
    if not text:
        return np.zeros(0, np.uint64)
    words = np.concatenate([np.array(list(map(memo.__getitem__, WORDS.findall(part.lower()))), np.uint64)
                            for part in whole_chunks(text)])
    if not len(words):
        return words
    size = min(n, len(words))
    value = np.full(len(words) - size + 1, size, np.uint64)
    for i in range(size):
        value = _mix((value + words[i:len(words) - size + 1 + i]) * MULTIPLIER)
    return np.unique(value)


def band_hashes(sets: list[np.ndarray], bands: int, rows: int, seed: int = 11) -> np.ndarray:
    """One row of band hashes per non-empty set."""
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64)
    low = np.empty((len(sets), bands * rows), np.uint64)
    start = 0
    while start < len(sets):                      # runs of sets that fit a processor's cache
        stop, total = start + 1, len(sets[start])
        while stop < len(sets) and total + len(sets[stop]) <= 1 << 15:
            total += len(sets[stop])
            stop += 1
        for part in range(0, max(1, total if stop == start + 1 else 1), 1 << 20):
            x = sets[start][part:part + (1 << 20)] if stop == start + 1 else np.concatenate(sets[start:stop])
            at = np.concatenate([[0], np.cumsum([len(s) for s in sets[start:stop]])])[:-1] if stop > start + 1 else [0]
            for k in range(bands * rows):
                least = np.minimum.reduceat(x * a[k] + b[k], at)
                low[start:stop, k] = least if part == 0 else np.minimum(low[start:stop, k], least)
        start = stop
    out = np.empty((len(sets), bands), np.uint64)
    for k in range(bands):
        h = np.full(len(sets), k + 1, np.uint64)
        for r in range(rows):
            h = _mix((h + low[:, k * rows + r]) * MULTIPLIER)
        out[:, k] = h
    return out


def _digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def features(df: DataFrame, id_col: str, text: str, n: int, bands: int, rows: int) -> DataFrame:
    """Rows (id, node, size, bands): node is a digest of the set, null for an empty one."""
    ship_code(df.sparkSession)
    picked = df.select(df[id_col].cast("long").alias("id"), df[text].alias("text"))

    def run(batches):
        memo = _word_memo()
        for whole in batches:
            for b in text_slices(whole, "text"):
                ids = b.column(0)
                sets = [ngram_set(t, n, memo) for t in b.column(1).to_pylist()]
                full = [i for i, s in enumerate(sets) if len(s)]
                found = band_hashes([sets[i] for i in full], bands, rows).view(np.int64)
                offsets = np.zeros(len(sets) + 1, np.int32)
                offsets[1:] = np.cumsum([bands if len(s) else 0 for s in sets])
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
                     pa.array([len(s) for s in sets], pa.int64()),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.ravel()))],
                    names=["id", "node", "size", "bands"])

    return picked.mapInArrow(run, "id long, node binary, size long, bands array<long>")


def node_sets(df: DataFrame, id_col: str, text: str, n: int, wanted: DataFrame) -> DataFrame:
    """Rows (node, grams) for the ``wanted`` rows (node, rep): one full set for each node."""
    picked = (df.select(df[id_col].cast("long").alias("rep"), df[text].alias("text"))
              .join(wanted.select("rep").distinct(), "rep", "left_semi"))

    def run(batches):
        memo = _word_memo()
        for whole in batches:
            for b in text_slices(whole, "text"):
                sets = [ngram_set(t, n, memo) for t in b.column(1).to_pylist()]
                offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_digest(s) for s in sets], pa.binary()),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))],
                    names=["node", "grams"])

    # a repeated id may bring texts that aren't asked for
    return (picked.mapInArrow(run, "node binary, grams array<long>")
            .join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"]))


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections: common grams by matrix products, rare ones by their row pairs."""
    m = len(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    grams, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.argsort(column, kind="stable")
    owner, starts = owner[order], np.concatenate([[0], np.cumsum(count)])[:-1]
    shared = np.zeros((m, m), np.float32)
    frequent = np.flatnonzero(count > 32)
    for a in range(0, len(frequent), 2048):
        part = frequent[a:a + 2048]
        dense = np.zeros((m, len(part)), np.float32)
        sizes = count[part]
        rows = np.concatenate([owner[s:s + c] for s, c in zip(starts[part], sizes)])
        dense[rows, np.repeat(np.arange(len(part)), sizes)] = 1
        shared += dense @ dense.T
    rare = np.zeros(m * m, np.int64)
    for c in range(2, 33):
        at, (i, j) = starts[count == c], np.triu_indices(c, 1)
        step = max(1, (1 << 21) // len(i))
        for a in range(0, len(at), step):
            rows = owner[at[a:a + step, None] + np.arange(c)]      # a gram's owners ascend
            rare += np.bincount((rows[:, i] * m + rows[:, j]).ravel(), minlength=m * m)
    rare = rare.reshape(m, m)
    shared = np.rint(shared).astype(np.int64) + rare + rare.T
    np.fill_diagonal(shared, [len(s) for s in sets])
    return shared


def _tree(links: np.ndarray) -> list[int]:
    """For each node a linked node (itself for a root) such that these edges span all components."""
    m = len(links)
    parent, seen = list(range(m)), np.zeros(m, bool)
    for root in range(m):
        if seen[root]:
            continue
        seen[root] = True
        frontier = [root]
        while frontier:
            node = frontier.pop()
            new = np.flatnonzero(links[node] & ~seen)
            seen[new] = True
            for k in new.tolist():
                parent[k] = node
            frontier.extend(new.tolist())
    return parent


def _verify_blocks(similarity: float):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        sets = [np.asarray(g, dtype=np.int64) for g in group["grams"]]
        sizes = np.array([len(s) for s in sets])
        common = overlaps(sets)
        links = common >= similarity * (sizes[:, None] + sizes[None, :] - common) - 1e-9
        np.fill_diagonal(links, False)
        block = group["own"].to_numpy()
        if group["left"].iloc[0] != group["right"].iloc[0]:
            links &= block[:, None] != block[None, :]          # pairs inside a block are another task's
        parent = _tree(links)
        nodes = group["node"].tolist()
        return pd.DataFrame({"u": nodes, "v": [nodes[p] for p in parent],
                             "links": links @ group["copies"].to_numpy()})
    return run


def classes(df: DataFrame, id_col: str = "doc_id", text: str = "text", n: int = 5, similarity: float = 0.8,
            recall: float = 0.9999, bucket_pairs: int = 100, block: int = 400) -> DataFrame:
    """Rows (id, class_id, n_links): the class and the number of other rows with that similarity or more."""
    bands, rows = choose_bands(similarity, recall)
    found = write_stage(features(df, id_col, text, n, bands, rows), "ngram-features")
    taking = found.where(F.col("node").isNotNull() & F.col("id").isNotNull())
    nodes = write_stage(
        taking.groupBy("node").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"),
                                   F.first("size").alias("size"), F.first("bands").alias("bands")), "ngram-nodes")

    member = nodes.select("node", F.explode("bands").alias("bucket"))
    buckets = write_stage(member.groupBy("bucket").agg(F.count(F.lit(1)).alias("members"))
                          .where("members > 1"), "ngram-buckets")
    small = member.join(buckets.where(F.col("members") <= bucket_pairs).select("bucket"), "bucket")
    large = member.join(buckets.where(F.col("members") > bucket_pairs).select("bucket"), "bucket")

    # supergroups: nodes joined through large buckets, each hung on its bucket's smallest node
    large = write_stage(large, "ngram-large")
    first = large.groupBy("bucket").agg(F.min("node").alias("first"))
    super_of = components(large.join(first, "bucket").select(F.col("node").alias("u"), F.col("first").alias("v")))
    groups = super_of.select("node", F.col("root").alias("super"))
    groups = write_stage(groups.union(groups.select(F.col("super").alias("node"), "super")).distinct(), "ngram-super")

    of = small.join(nodes.select("node", "size"), "node").join(groups, "node", "left")
    one = of.select("bucket", F.col("node").alias("a"), F.col("size").alias("size_a"), F.col("super").alias("super_a"))
    two = of.select("bucket", F.col("node").alias("b"), F.col("size").alias("size_b"), F.col("super").alias("super_b"))
    pairs = (one.join(two, "bucket").where(
        (F.col("a") < F.col("b"))
        & (F.least("size_a", "size_b") >= F.lit(similarity) * F.greatest("size_a", "size_b") - 1e-9)
        & ~F.coalesce(F.col("super_a") == F.col("super_b"), F.lit(False)))     # those are the blocks' task
        .groupBy("a", "b").agg(F.first("size_a").alias("size_a"), F.first("size_b").alias("size_b")))
    pairs = write_stage(pairs, "ngram-pairs")

    in_pairs = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = write_stage(in_pairs.union(groups.select("node")).distinct()
                         .join(nodes.select("node", "rep", "copies"), "node"), "ngram-wanted")
    sets = write_stage(node_sets(df, id_col, text, n, wanted), "ngram-sets")

    both = (pairs.join(sets.select(F.col("node").alias("a"), F.col("grams").alias("grams_a")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("grams").alias("grams_b")), "b"))
    common = F.size(F.array_intersect("grams_a", "grams_b"))
    linked = write_stage(both.where(common >= F.lit(similarity) * (F.col("size_a") + F.col("size_b") - common) - 1e-9)
                         .select("a", "b"), "ngram-links")

    in_group = groups.join(wanted.select("node", "copies"), "node")
    counts = in_group.groupBy("super").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = (in_group.join(counts, "super").join(sets, "node").withColumn("own", own).withColumn("other", other)
             .select("super", F.least("own", "other").alias("left"), F.greatest("own", "other").alias("right"),
                     "own", "node", "copies", "grams"))
    blocks = write_stage(dealt.groupBy("super", "left", "right").applyInPandas(
        _verify_blocks(similarity), "u binary, v binary, links long"), "ngram-blocks")

    edges = (linked.select(F.col("a").alias("u"), F.col("b").alias("v"))
             .union(blocks.where("u <> v").select("u", "v")))
    root = components(edges)
    # every node's links to other nodes, counted in rows
    copies = nodes.select("node", "copies")
    ends = (linked.select(F.col("a").alias("node"), F.col("b").alias("other"))
            .union(linked.select(F.col("b").alias("node"), F.col("a").alias("other"))))
    degree = (ends.join(copies.withColumnRenamed("node", "other"), "other").select("node", F.col("copies").alias("links"))
              .union(blocks.select(F.col("u").alias("node"), "links"))
              .groupBy("node").agg(F.sum("links").alias("links")))
    rooted = root.union(root.select(F.col("root").alias("node"), "root")).distinct()
    named = rooted.join(nodes.select("node", "rep"), "node")
    least = named.groupBy("root").agg(F.min("rep").alias("class_id"))
    clustered = write_stage(named.join(least, "root").select("node", "class_id"), "ngram-classes")

    of_node = (nodes.select("node", "rep", "copies").join(clustered, "node", "left").join(degree, "node", "left")
               .select("node", F.coalesce("class_id", "rep").alias("class_id"),
                       (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    alone = found.where(F.col("node").isNull() | F.col("id").isNull())
    return (taking.select("id", "node").join(of_node, "node").select("id", "class_id", "n_links")
            .union(alone.select("id", F.col("id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))))


BROADCAST_IDS = 1_000_000         # ids of 8 bytes


def one_of_each(df: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``df`` that stay when one row of each class is kept (its smallest id), with the same columns.

    Rows without an id stay; an id of several different texts stays if it names the class of one of them.
    """
    names = (F.col("id") == F.col("class_id")).cast("int")
    by_id = write_stage(classes(df, id_col, text, **options).where("id IS NOT NULL").groupBy("id")
                        .agg(F.sum(names).alias("naming")).where("naming <> 1"), "ngram-decisions")
    gone, again = by_id.where("naming = 0").select("id"), by_id.where("naming > 1").select("id")
    if by_id.count() <= BROADCAST_IDS:
        gone, again = F.broadcast(gone), F.broadcast(again)
    left = df.join(gone, df[id_col] == gone["id"], "left_anti")
    single = left.join(again, left[id_col] == again["id"], "left_anti")
    repeated = left.join(again, left[id_col] == again["id"], "left_semi").dropDuplicates([id_col, text])
    return single.union(repeated)
