"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

A document becomes a short vector of statistics (shares of kinds of characters,
word and line shapes, repetition), summed over pieces of the text, so whole texts of any length
are read in bounded memory. Standardised statistics go through ``features`` random cosines, whose
products approximate a Gaussian kernel. Ridge weights come from normal equations that
each task sums over its rows, by fold; Spark adds the tasks' matrices. Sums of
folds give a model of all other folds, so scores of training texts come from models that never saw
them: these choose kernel width and ridge, and the isotonic curve (pool adjacent violators) is fitted on them.
The final weights use all folds.

Training uses a documented bound: at most about ``most_labels`` labelled texts, chosen
by a hash of the id, equal texts once. The driver gets features^2 numbers
a fold and kernel width, and score bins, whatever the input. Scoring covers whole texts of all documents.

Defined results: a null text counts as empty; an empty text has all statistics
zero and is scored like any; repeated rows are scored row by row; repeated
labels of an id or a text count once, good if any is; null labels teach nothing; if a
class has no example, every score is the share of good examples (0.5 if there
is none). Extra columns never clash with the results.
"""

from __future__ import annotations

import unicodedata
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidyspark.llm.common import (append_struct, broadcast_value, sampled, ship_code, whole_chunks, worker_cached,
                                  write_stage)

KINDS = ["small", "capital", "letter", "digit", "space", "line", "stop", "exclaim", "symbol", "control"]
STATISTICS = [*(f"share_{k}" for k in KINDS), "log_chars", "log_words", "log_lines", "word_mean", "word_deviation",
              "capital_words", "long_words", "single_words", "adjacent_repeats", "window_variety", "repeated_triples",
              "repeated_lines", "most_symbols_of_line", "most_capitals_of_line", "stopped_lines", "words_a_stop"]
WINDOW = 64                   # words in which variety is counted
LINE = 20                     # shortest line, in characters, whose shares are compared
TABLE_END = 0x3000            # code points from here on share one kind by their plane
FOLDS, SLICE = 5, 64
BIN = 1000                    # score bins in one unit of the raw score


def _kind(code: int) -> int:
    c = chr(code)
    if c == "\n":
        return KINDS.index("line")
    if c.isspace():
        return KINDS.index("space")
    if c.islower():
        return KINDS.index("small")
    if c.isupper():
        return KINDS.index("capital")
    group = unicodedata.category(c)[0]
    if group in "LM":
        return KINDS.index("letter")
    if group == "N":
        return KINDS.index("digit")
    if c in ".,;:'\"()-":
        return KINDS.index("stop")
    if c in "!?":
        return KINDS.index("exclaim")
    return KINDS.index("control" if group == "C" else "symbol")


def kind_table() -> np.ndarray:
    """The kind of every code point below TABLE_END, then that of all others (letters)."""
    return np.array([_kind(c) for c in range(TABLE_END)] + [KINDS.index("letter")], np.uint8)


def statistics(text: str | None, kinds: np.ndarray) -> list[float]:
    """The statistics of a whole text, added up over pieces that end between words."""
    counts = np.zeros(len(KINDS))
    words = lines = windows = triples = compared = 0
    length = length2 = capital = long = single = adjacent = variety = again = same = stopped = 0.0
    symbols = capitals = 0.0
    for part in whole_chunks(text or ""):
        if not part:
            continue
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        of = kinds[np.minimum(codes, TABLE_END)]
        counts += np.bincount(of, minlength=len(KINDS))
        ends = np.append(np.flatnonzero(of == KINDS.index("line")), len(of))
        sizes = np.diff(ends, prepend=-1) - 1
        enough = sizes >= LINE
        for k, name in enumerate(("symbol", "capital")):
            upto = np.concatenate([[0], np.cumsum(of == KINDS.index(name)), [0]])[ends]
            shares = np.diff(upto, prepend=0)[enough] / sizes[enough]
            if len(shares) and k == 0:
                symbols = max(symbols, float(shares.max()))
            elif len(shares):
                capitals = max(capitals, float(shares.max()))
        rows = [r for r in part.split("\n") if r]
        lines += len(rows)
        same += len(rows) - len(set(rows))
        stopped += sum(r.rstrip().endswith((".", "!", "?", ":")) for r in rows)
        w = part.split()
        n = len(w)
        words += n
        sizes = np.fromiter(map(len, w), float, n)
        length, length2 = length + sizes.sum(), length2 + (sizes * sizes).sum()
        long, single = long + (sizes > 20).sum(), single + (sizes == 1).sum()
        capital += sum(map(str.isupper, w))
        adjacent += sum(map(eq, w, w[1:]))
        for i in range(0, n, WINDOW):
            piece = w[i:i + WINDOW]
            variety += len(set(piece)) / len(piece)
            windows += 1
        if n > 2:
            triples += n - 2
            again += n - 2 - len(set(zip(w, w[1:], w[2:])))
    chars = counts.sum()
    per = lambda a, b: float(a / b) if b else 0.0                                              # noqa: E731
    mean = per(length, words)
    return [*(counts / max(chars, 1.0)).tolist(), float(np.log1p(chars)), float(np.log1p(words)), float(np.log1p(lines)),
            mean, float(np.sqrt(max(per(length2, words) - mean * mean, 0.0))), per(capital, words), per(long, words),
            per(single, words), per(adjacent, words), per(variety, windows), per(again, triples), per(same, lines),
            symbols, capitals, per(stopped, lines), per(counts[KINDS.index("stop")], words)]


class Kernel:
    """Random cosines whose products approximate exp(-|a - b|^2 / (2 width^2)) on standardised statistics."""

    def __init__(self, centre: np.ndarray, spread: np.ndarray, width: float, features: int, seed: int = 7):
        rnd = np.random.default_rng(seed)
        self.centre, self.spread, self.width = centre, spread, width
        self.weights = rnd.normal(size=(len(centre), features)) / width
        self.phases = rnd.uniform(0, 2 * np.pi, features)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.centre) / self.spread, -6, 6)
        cosines = np.sqrt(2 / len(self.phases)) * np.cos(z @ self.weights + self.phases)
        return np.concatenate([cosines, np.ones((len(x), 1))], 1)


class Curve:
    """A rising curve through the pooled blocks' middles; outside it goes on level."""

    def __init__(self, at: list[float], value: list[float]):
        self.at, self.value = np.array(at), np.array(value)

    def __call__(self, raw: np.ndarray) -> np.ndarray:
        p = np.interp(raw, self.at, self.value)
        # a thousandth keeps the order of raw scores inside level parts
        return np.clip(0.999 * p + 0.001 * np.clip(raw, 0, 1), 0.0, 1.0)


def pooled(at: np.ndarray, n: np.ndarray, good: np.ndarray) -> list[tuple[float, float, float]]:
    """Pool adjacent violators: (middle, rows, share of good) with rising shares; inputs in rising order of ``at``."""
    blocks: list[list[float]] = []
    for a, m, g in zip(at.tolist(), n.tolist(), good.tolist()):
        blocks.append([a * m, m, g])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [x + y for x, y in zip(blocks[-1], last)]
    return [(s / m, m, g / m) for s, m, g in blocks]


class Model:
    def __init__(self, kernel: Kernel | None, weights: np.ndarray | None, curve: Curve | None, constant: float = 0.5):
        self.kernel, self.weights, self.curve, self.constant = kernel, weights, curve, constant

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.kernel is None:
            return np.full(len(x), self.constant)
        return self.curve(self.kernel(x) @ self.weights)


def _statistics_of(docs: DataFrame, text: str, keep: list[str]) -> tuple[DataFrame, str]:
    fields = T.StructType([T.StructField("x", T.ArrayType(T.DoubleType()))])

    def per_texts(texts):
        kinds = worker_cached("quality-kinds", kind_table)
        return [[statistics(t, kinds) for t in texts]]
    return append_struct(docs, text, fields, per_texts, keep)


def _matrices(sample: DataFrame, kernels: list[Kernel], features: int) -> dict[tuple[int, int], np.ndarray]:
    """Normal equations by (kernel, fold): sums over the rows of [cosines, 1, label] times themselves."""
    shared = broadcast_value(sample.sparkSession, kernels)        # statistics * features numbers each
    size = features + 2

    def run(batches):
        total = {}
        for b in batches:
            if not b.num_rows:
                continue
            fold = b.column(0).to_numpy()
            good = b.column(1).to_numpy(zero_copy_only=False).astype(float)
            x = np.array(b.column(2).to_pylist())
            for k, kernel in enumerate(shared.value):
                z = np.concatenate([kernel(x), good[:, None]], 1)
                for f in np.unique(fold):
                    part = z[fold == f]
                    key = k, int(f)
                    total[key] = total.get(key, 0.0) + part.T @ part
        for (k, f), m in total.items():
            parts = range(0, size, SLICE)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k] * len(parts), pa.int32()), pa.array([f] * len(parts), pa.int32()),
                 pa.array(list(parts), pa.int32()), pa.array([m[i:i + SLICE].tobytes() for i in parts], pa.binary())],
                names=["kernel", "fold", "part", "sums"])

    def add(key, pdf):
        total = sum(np.frombuffer(m) for m in pdf["sums"])
        return pd.DataFrame({"kernel": [key[0]], "fold": [key[1]], "part": [key[2]], "sums": [total.tobytes()]})

    schema = "kernel int, fold int, part int, sums binary"
    rows = (sample.select("fold", "good", "x").mapInArrow(run, schema)
            .groupBy("kernel", "fold", "part").applyInPandas(add, schema).collect())
    out: dict[tuple[int, int], np.ndarray] = {}
    for r in rows:
        m = out.setdefault((r.kernel, r.fold), np.zeros((size, size)))
        m[r.part:r.part + SLICE] = np.frombuffer(r.sums).reshape(-1, size)
    return out


def _ridge(sums: np.ndarray, strength: float) -> np.ndarray:
    """Weights of the cosines and the constant; the constant is not shrunk."""
    a, b, n = sums[:-1, :-1], sums[:-1, -1], sums[-2, -2]
    shrink = np.full(len(a), strength * n)
    shrink[-1] = 1e-9 * n
    return np.linalg.solve(a + np.diag(shrink), b)


def _error(sums: np.ndarray, weights: np.ndarray) -> float:
    """Squared error of a model on the rows of a matrix."""
    v = np.append(weights, -1.0)
    return float(v @ sums @ v)


def _raw_bins(sample: DataFrame, kernel: Kernel, by_fold: dict[int, np.ndarray]) -> list:
    """(raw score bin, texts, good texts), each text scored by the model of the other folds."""
    shared = broadcast_value(sample.sparkSession, (kernel, by_fold))

    def run(batches):
        k, weights = shared.value
        for b in batches:
            if b.num_rows:
                z = k(np.array(b.column(2).to_pylist()))
                raw = np.array([row @ weights[f] for row, f in zip(z, b.column(0).to_pylist())])
                bins = np.round(np.clip(raw, -1, 2) * BIN).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(bins), b.column(1)], names=["bin", "good"])

    return sorted(sample.select("fold", "good", "x").mapInArrow(run, "bin int, good boolean").groupBy("bin")
                  .agg(F.count(F.lit(1)), F.sum(F.col("good").cast("long"))).collect())


def train(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text: str = "text",
          label: str = "quality", most_labels: int = 30_000, features: int = 256,
          widths: tuple[float, ...] = (2.0, 4.0, 8.0), ridges: tuple[float, ...] = (1e-5, 1e-4, 1e-3, 1e-2)) -> Model:
    """Learn from labelled rows of ``labels`` (a predicate ``learn`` over ``id_col``) joined to ``docs``."""
    spark = docs.sparkSession
    ship_code(spark)
    known = (labels.where(learn & F.col(label).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("label_id")).agg((F.max(label) > 0).alias("good")))
    # at most about most_labels rows of 9 bytes, so this side is broadcast
    known = F.broadcast(sampled(known, "label_id", most_labels))
    texts = (docs.join(known, docs[id_col] == known.label_id)
             .select("good", F.coalesce(docs[text], F.lit("")).alias("text")).withColumn("digest", F.xxhash64("text")))
    counted, name = _statistics_of(texts, "text", ["good", "digest"])
    sample = write_stage(counted.groupBy("digest").agg(F.max("good").alias("good"), F.any_value(f"{name}.x").alias("x"))
                         .withColumn("fold", F.pmod(F.col("digest"), F.lit(FOLDS)).cast("int")), "quality-sample")
    of = len(STATISTICS)
    sizes = dict(sample.groupBy("good").count().collect())
    if len(sizes) < 2:
        return Model(None, None, None, 0.5 if not sizes else float(next(iter(sizes))))
    moments = sample.agg(*[F.avg(F.col("x")[i]) for i in range(of)], *[F.stddev_pop(F.col("x")[i]) for i in range(of)])
    moments = np.array(moments.first(), dtype=float)
    spread = np.where(moments[of:] > 1e-9, moments[of:], 1.0)
    kernels = [Kernel(moments[:of], spread, w, features) for w in widths]
    sums = _matrices(sample, kernels, features)

    best = None
    for k in range(len(kernels)):
        folds = {f: m for (kk, f), m in sums.items() if kk == k}
        whole = sum(folds.values())
        for r in ridges:
            # one fold alone leaves no others: then it is its own model
            others = {f: _ridge(whole - m if len(folds) > 1 else whole, r) for f, m in folds.items()}
            error = sum(_error(m, others[f]) for f, m in folds.items())
            if best is None or error < best[0]:
                best = error, kernels[k], others, _ridge(whole, r)
    _, kernel, others, weights = best
    bins = np.array(_raw_bins(sample, kernel, others), dtype=float)
    blocks = pooled(bins[:, 0] / BIN, bins[:, 1], bins[:, 2])
    # half an example of either class keeps a pure block off 0 and 1
    curve = Curve([b[0] for b in blocks], [(b[2] * b[1] + 0.5) / (b[1] + 1) for b in blocks])
    curve.value = np.maximum.accumulate(curve.value)
    return Model(kernel, weights, curve)


FIELDS = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])


def score(df: DataFrame, model: Model, text: str = "text", threshold: float = 0.5,
          keep: list[str] | None = None) -> tuple[DataFrame, str]:
    """Append a struct: score (0 to 1, higher is better) and predicted."""
    shared = broadcast_value(df.sparkSession, model)       # statistics * features numbers

    def per_texts(texts):
        kinds = worker_cached("quality-kinds", kind_table)
        x = np.array([statistics(t, kinds) for t in texts]).reshape(len(texts), -1)
        scores = shared.value.scores(x) if len(texts) else np.zeros(0)
        return [scores.tolist(), (scores >= threshold).astype(int).tolist()]

    return append_struct(df, text, FIELDS, per_texts, keep)
