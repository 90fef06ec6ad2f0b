"""Toxicity by maximum-scoring segments of token log-odds.

Learning. Words of labelled texts are counted in toxic and clean texts. An
entry is a whole word or a word beginning of 4 to 6 letters; its log-odds have
an informative Dirichlet prior (its own counts in all texts, times ``prior``)
and a variance, so an entry is kept only if its log-odds over the texts that
have it are ``least_z`` standard errors and 1.0 away from zero. A word scores as the most
specific entry it has; all other words share one entry. The scores are
log-likelihood ratios, for which the scale of the extreme-value law is one.

Scoring. One linear scan over a text's word scores finds all maximal-scoring
segments (no longer or shorter neighbour scores more). A segment of score S in
a text of m words is expected by chance K*m*exp(-S) times; K is measured on
clean training texts. Segments with an expectation under ``significant`` are
the toxic passages. Their surprises, -log(expectation), add up, and a logistic
curve fitted on the training texts turns the sum into a probability.

Training uses a documented bound: at most about ``most_labels`` labelled
texts, chosen by a hash of the id, equal texts once. Scoring covers every word of every text.

Defined results: a null or empty text has no segment and gets the curve's
lowest score; repeated rows are scored row by row; repeated labels of an id
count once, toxic if any is; null labels teach nothing; if a class has no
example, every score is the share of toxic examples (0.0 if there is none).
Extra columns never clash with the results.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidyspark.llm.common import (Memo, append_struct, broadcast_value, content_key, sampled, ship_code, text_slices,
                                  whole_chunks, worker_cached, write_stage)

WORDS = re.compile(r"[^\W\d_]+")
BEGINNINGS = (6, 5, 4)
CHANCE_FLOOR = 3.0            # chance segments are counted from this score on


def words_of(text: str | None) -> list[str]:
    if not text:
        return []
    return [w for part in whole_chunks(text) for w in WORDS.findall(part.lower())]


def entries_of(word: str) -> list[str]:
    """The entries of a word, most specific first: the word, then its beginnings (marked ``-``)."""
    return [word] + [word[:k] + "-" for k in BEGINNINGS if len(word) > k]


def segments(scores: np.ndarray, usual: float) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first, last + 1, score) by one scan.

    ``usual`` is the negative score of most tokens; only the others are looked
    at one by one, the running total between them is a multiplication.
    """
    special = np.flatnonzero(scores != usual)
    if not len(special):
        return []
    totals = np.concatenate([[0.0], np.cumsum(scores)])
    found: list[list] = []       # [total before, total behind, first, last + 1, nearest earlier one with a lower total before]
    for i in special.tolist():
        if scores[i] <= 0:
            continue
        low, high, first = totals[i], totals[i + 1], i
        k = len(found) - 1
        while True:
            while k >= 0 and found[k][0] >= low:
                k = found[k][4]
            if k < 0 or found[k][1] >= high:
                break
            low, first = found[k][0], found[k][2]
            del found[k:]
            k = len(found) - 1
        found.append([low, high, first, i + 1, k])
    return [(f[2], f[3], f[1] - f[0]) for f in found]


class Model:
    def __init__(self, entries: dict[str, float], usual: float, chance: float, curve: tuple[float, float],
                 significant: float):
        self.entries, self.usual, self.chance = entries, usual, chance
        self.curve, self.significant = curve, significant

    def word_score(self, word: str) -> float:
        for e in entries_of(word):
            if e in self.entries:
                return self.entries[e]
        return self.usual

    def passages(self, text: str | None, memo: Memo) -> tuple[int, list[tuple[int, int, float]]]:
        """Number of words and the significant passages (first, last + 1, -log expectation)."""
        words = words_of(text)
        if not words or not self.entries:
            return len(words), []
        scores = np.fromiter(map(memo.__getitem__, words), float, len(words))
        base = math.log(self.chance * len(words))
        found = [(a, b, s - base) for a, b, s in segments(scores, self.usual)]
        return len(words), [f for f in found if f[2] > -math.log(self.significant)]

    def probability(self, surprise: float) -> float:
        a, b = self.curve
        return 1.0 / (1.0 + math.exp(-max(-700.0, min(700.0, a + b * surprise))))


COUNTS = "entry string, toxic long, clean long, toxic_texts long, clean_texts long"


def _count_words(classes_by_entry=None):
    """A task that counts words (or, given a classifier of words, entries) by class: in all and by text."""
    def run(batches):
        name = classes_by_entry() if classes_by_entry else None
        for whole in batches:
            for b in text_slices(whole, "text"):
                counts = [Counter() for _ in range(4)]             # clean, toxic, clean texts, toxic texts
                for toxic, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    w = words_of(t) if name is None else list(map(name, words_of(t)))
                    counts[toxic].update(w)
                    counts[2 + toxic].update(set(w))
                both = list(set(counts[0]) | set(counts[1]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(both, pa.string()),
                     *(pa.array([counts[k][w] for w in both], pa.int64()) for k in (1, 0, 3, 2))],
                    names=["entry", "toxic", "clean", "toxic_texts", "clean_texts"])
    return run


def _dirichlet(prior: float, toxic: Column, clean: Column, sum_toxic: float, sum_clean: float):
    """Log-odds of an entry and its variance; the prior is worth ``prior`` times all counts."""
    strength = prior * (sum_toxic + sum_clean)
    alpha = F.lit(prior) * (toxic + clean)
    t, c = toxic + alpha, clean + alpha
    odds = (F.log(t / (F.lit(sum_toxic + strength) - t)) - F.log(c / (F.lit(sum_clean + strength) - c)))
    return odds, 1 / t + 1 / c


def train(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text: str = "text",
          label: str = "toxic", most_labels: int = 30_000, prior: float = 0.1,
          least_z: float = 3.5, significant: float = 0.05) -> Model:
    """Learn from labelled rows of ``labels`` (a predicate ``learn`` over ``id_col``) joined to ``docs``."""
    spark = docs.sparkSession
    ship_code(spark)
    known = (labels.where(learn & F.col(label).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("label_id")).agg((F.max(label) > 0).alias("toxic")))
    # at most about most_labels rows of 9 bytes, so this side is broadcast
    known = F.broadcast(sampled(known, "label_id", most_labels))
    sample = write_stage(
        docs.join(known, docs[id_col] == known.label_id)
        .select("toxic", docs[text].alias("text")).where(F.col("text").isNotNull())
        .withColumn("digest", F.xxhash64("text")).dropDuplicates(["digest"]).drop("digest"), "toxicity-sample")
    sizes = {r[0]: r[1] for r in sample.groupBy("toxic").count().collect()}
    n_toxic, n_clean = sizes.get(True, 0), sizes.get(False, 0)
    if not (n_toxic and n_clean):
        share = 0.0 if not n_toxic else 1.0
        return Model({}, -1.0, 1.0, (700.0 if share else -700.0, 0.0), significant)

    columns = ("toxic", "clean", "toxic_texts", "clean_texts")
    words = write_stage(sample.mapInArrow(_count_words(), COUNTS)
                        .groupBy("entry").agg(*[F.sum(c).alias(c) for c in columns]), "toxicity-words")
    sums = [float(x or 0) for x in words.agg(*[F.sum(c) for c in columns]).first()]
    sum_toxic, sum_clean = sums[:2]
    word = F.col("entry")
    all_entries = F.array(word, *[F.when(F.length(word) > k, F.concat(F.substring(word, 1, k), F.lit("-")))
                                  for k in BEGINNINGS])
    counted = (words.select(F.explode(F.filter(all_entries, lambda e: e.isNotNull())).alias("entry"),
                            *columns[2:])
               .groupBy("entry").agg(*[F.sum(c).alias(c) for c in columns[2:]]))
    # evidence counts texts, so that one text's repetitions prove nothing
    odds, variance = _dirichlet(prior, F.col("toxic_texts"), F.col("clean_texts"), *sums[2:])
    chosen = [r[0] for r in counted.select("entry", odds.alias("odds"), (F.abs(odds) / F.sqrt(variance)).alias("z"))
              .where((F.col("z") >= least_z) & (F.abs("odds") >= 1.0))
              .select("entry").collect()]              # words of the bounded sample

    # the chosen entries and "the rest" divide all words: their scores are true likelihood ratios
    share_entries = broadcast_value(spark, frozenset(chosen))

    def classifier():
        kept = share_entries.value
        memo = Memo(lambda w: next((e for e in entries_of(w) if e in kept), ""))
        return memo.__getitem__

    per_entry = (sample.mapInArrow(_count_words(classifier), COUNTS)
                 .groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))
    ratio = {}
    for e, t, c in per_entry.collect():                  # a row per chosen entry
        alpha, strength = prior * (t + c), prior * (sum_toxic + sum_clean)
        ratio[e] = math.log((t + alpha) / (sum_toxic + strength)) - math.log((c + alpha) / (sum_clean + strength))
    usual = min(ratio.pop("", -1e-3), -1e-3)
    draft = Model(ratio, usual, 1.0, (0.0, 1.0), math.exp(-CHANCE_FLOOR))
    chance = _chance(sample, draft, sum_clean)
    model = Model(ratio, usual, chance, (0.0, 1.0), significant)
    model.curve = _fit_curve(_surprises(sample, model))
    return model


def _chance(sample: DataFrame, draft: Model, sum_clean: float) -> float:
    """K of the extreme-value law: segments over the floor in clean texts, with half a segment added."""
    shared = broadcast_value(sample.sparkSession, draft)

    def run(batches):
        model = shared.value
        memo = Memo(model.word_score)
        for whole in batches:
            for b in text_slices(whole, "text"):
                n = 0
                for t in b.column(0).to_pylist():
                    w = words_of(t)
                    if w and model.entries:
                        scores = np.fromiter(map(memo.__getitem__, w), float, len(w))
                        n += sum(s >= CHANCE_FLOOR for _, _, s in segments(scores, model.usual))
                yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    clean = sample.where(~F.col("toxic")).select("text")
    n = clean.mapInArrow(run, "n long").agg(F.sum("n")).first()[0] or 0
    return (n + 0.5) * math.exp(CHANCE_FLOOR) / max(sum_clean, 1.0)


BIN = 0.5


def _surprises(sample: DataFrame, model: Model) -> list[tuple[float, int, int]]:
    """(surprise, toxic texts, clean texts) in bins, no more than the sample has texts."""
    shared = broadcast_value(sample.sparkSession, model)
    fields = T.StructType([T.StructField("bin", T.IntegerType())])

    def per_texts(texts):
        m = shared.value
        memo = Memo(m.word_score)
        return [[int(sum(p[2] for p in m.passages(t, memo)[1]) / BIN) for t in texts]]

    out, name = append_struct(sample, "text", fields, per_texts, keep=["toxic"])
    rows = (out.groupBy(F.col(f"{name}.bin").alias("bin"))
            .agg(F.sum(F.col("toxic").cast("long")), F.sum((~F.col("toxic")).cast("long"))).collect())
    return [(r[0] * BIN, r[1], r[2]) for r in rows]


def _fit_curve(bins: list[tuple[float, int, int]]) -> tuple[float, float]:
    """Logistic curve by Newton steps with a small ridge on the slope.

    A step that would raise the loss is halved: full steps swing about the optimum for ever
    where the classes hardly overlap.
    """
    x = np.array([b[0] for b in bins])
    toxic, clean = (np.array([b[i] for b in bins], dtype=float) for i in (1, 2))
    weight, theta = toxic + clean, np.array([-2.0, 0.1])
    design = np.stack([np.ones_like(x), x], 1)
    ridge = np.diag([1e-3, 1e-1])

    def loss(theta):
        z = design @ theta
        return weight @ np.logaddexp(0, z) - toxic @ z + theta @ ridge @ theta / 2

    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -500, 500)))
        step = np.linalg.solve((design * (weight * p * (1 - p))[:, None]).T @ design + ridge,
                               design.T @ (toxic - weight * p) - ridge @ theta)
        here = loss(theta)
        while np.abs(step).max() > 1e-10 and not loss(theta + step) < here:
            step = step / 2
        if np.abs(step).max() <= 1e-10:
            break
        theta = theta + step
    return float(theta[0]), float(max(theta[1], 0.0))


FIELDS = T.StructType([
    T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()),
    T.StructField("n_words", T.LongType()), T.StructField("passage_start", T.ArrayType(T.LongType())),
    T.StructField("passage_end", T.ArrayType(T.LongType())),
    T.StructField("passage_surprise", T.ArrayType(T.DoubleType()))])


def score(df: DataFrame, model: Model, text: str = "text", threshold: float = 0.3,
          keep: list[str] | None = None) -> tuple[DataFrame, str]:
    """Append a struct: score, predicted, and the toxic passages as word positions with their surprise."""
    shared = broadcast_value(df.sparkSession, model)
    token = content_key(sorted(model.entries.items()), model.usual, model.chance)

    def per_texts(texts):
        m = shared.value
        memo = worker_cached(("toxicity", token), lambda: Memo(m.word_score))
        found = [m.passages(t, memo) for t in texts]
        scores = [m.probability(sum(p[2] for p in f)) for _, f in found]
        return [scores, [int(s >= threshold) for s in scores], [n for n, _ in found],
                *[[[p[k] for p in f] for _, f in found] for k in range(3)]]

    return append_struct(df, text, FIELDS, per_texts, keep)
