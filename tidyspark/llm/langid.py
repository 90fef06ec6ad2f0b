"""Language identification by segmentation-marginalised unigrams.

Every language has a probability for each piece of a fixed public vocabulary.
The probability of a word is the sum over all its segmentations into pieces,
found by the forward algorithm; a text is the product of its words, and the
language of the largest posterior (equal priors) wins. Piece probabilities
come from expectation maximisation: forward-backward gives each piece's
expected count in the training words of a language.

A training set is a documented bound: at most about ``docs_per_language``
documents of each language, chosen by a hash of the id (or of the text, where
ids may not tell documents apart), equal texts once; words over 48 letters
teach in parts. Every word of every text is scored.

Defined results: ``und`` with score 0.0 for a text that is null or has no
letter, and for every text if nothing could be learned; ties go to the
language that sorts first; repeated rows are scored row by row; rows without a
language are scored but never learned from. Extra columns never clash with the
results.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidyspark.llm.common import (append_struct, broadcast_value, content_key, ship_code, text_slices,
                                  whole_chunks, worker_cached, write_stage)

WORDS = re.compile(r"[^\W\d_]+")
START = "▁"                  # marks the beginning of a word in the vocabulary
LONGEST_TRAINED = 48         # letters of a training word
UNKNOWN = 1e-9               # probability of a character that is no piece, in every language
LIFT = 30.0                  # factor per character that keeps products near one
LEAST = 1e-200               # words with smaller products are summed with other scales


def letters(text: str | None) -> list[str]:
    if not text:
        return []
    words = [w for part in whole_chunks(text) for w in WORDS.findall(part.lower())]
    return words if any(map(str.isalpha, words)) else [w for w in words if any(map(str.isalpha, w))]


def read_pieces(model_path: str) -> list[str]:
    """The ordinary pieces of a sentencepiece vocabulary, in its order."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    return [sp.id_to_piece(i) for i in range(sp.get_piece_size())
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]


class Lattice:
    """All matches of pieces in a batch of words, ordered for a joint forward pass."""

    def __init__(self, pieces: list[str]):
        import ahocorasick
        self.length = np.array([len(p) for p in pieces] + [1])       # the last: an unknown character
        self.n = len(pieces)
        self.longest = int(self.length.max())
        self.singles = {p for p in pieces if len(p) == 1}
        self.scan = ahocorasick.Automaton()
        for i, p in enumerate(pieces):
            self.scan.add_word(p, i)
        self.scan.make_automaton()

    def matches(self, words: list[str]):
        """Per match: piece, start and end position (one position per character and word end)."""
        joined = "\n".join(START + w for w in words) + "\n"
        found = np.fromiter(chain.from_iterable(self.scan.iter(joined)), np.int64).reshape(-1, 2)
        odd = {c for c in set(joined) if c != "\n" and c not in self.singles}
        if odd:
            at = np.array([i for i, c in enumerate(joined) if c in odd], dtype=np.int64)
            found = np.concatenate([found, np.stack([at, np.full(len(at), self.n)], 1)])
            found = found[np.argsort(found[:, 0], kind="stable")]
        sizes = np.array([len(w) + 2 for w in words])
        begins = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        end, piece = found[:, 0] + 1, found[:, 1]
        start = end - self.length[piece]
        begin = np.repeat(begins, sizes)[start]
        return piece, start, end, end - begin, begins, begins + sizes - 1

    @staticmethod
    def _steps(key: np.ndarray, target: np.ndarray, sorted_by_target: bool = False):
        """Order matches by step and target; yields per step the matches and the runs of one target."""
        narrow = key.astype(np.int16) if np.abs(key).max(initial=0) < 1 << 15 else key
        order = (np.argsort(narrow, kind="stable") if sorted_by_target else np.lexsort((target, key)))
        step = key[order]
        cuts = np.flatnonzero(np.diff(step)) + 1
        for part in np.split(order, cuts):
            t = target[part]
            runs = np.concatenate([[0], np.flatnonzero(np.diff(t)) + 1])
            yield part, t[runs], runs

    def forward(self, words: list[str], prob: np.ndarray, parts=None):
        piece, start, end, local, begins, ends = parts or self.matches(words)
        size = int(ends[-1]) + 1
        alpha = np.zeros((size, prob.shape[1]))
        alpha[begins] = 1.0
        for part, targets, runs in self._steps(local, end, sorted_by_target=True):
            alpha[targets] = np.add.reduceat(alpha[start[part]] * prob[piece[part]], runs, axis=0)
        return alpha

    def log_words(self, words: list[str], prob: np.ndarray) -> np.ndarray:
        """log of the summed probability of each word, one column per language."""
        out = np.empty((len(words), prob.shape[1]))
        short = [i for i, w in enumerate(words) if len(w) <= 64]
        for a in range(0, len(short), 10_000):
            some = short[a:a + 10_000]
            chosen = [words[i] for i in some]
            parts = self.matches(chosen)
            alpha = self.forward(chosen, prob, parts)
            lift = np.array([(len(w) + 1) * math.log(LIFT) for w in chosen])[:, None]
            with np.errstate(divide="ignore"):
                out[some] = np.log(alpha[parts[5]]) - lift
            for i in np.flatnonzero(self._tiny(alpha, parts[4])):
                out[some[i]] = self._log_long(chosen[i], prob)
        for i, w in enumerate(words):
            if len(w) > 64:
                out[i] = self._log_long(w, prob)
        return out

    @staticmethod
    def _tiny(alpha: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Words whose sums come near the smallest numbers somewhere, in any language."""
        return np.minimum.reduceat(alpha, begins, axis=0).min(axis=1) < LEAST

    def _log_long(self, word: str, prob: np.ndarray) -> np.ndarray:
        """The same sum with a scale per language, for words of any length."""
        piece, start, end, local, begins, ends = self.matches([word])
        n = len(word) + 2
        window = np.zeros((self.longest + 1, prob.shape[1]))
        window[0] = 1.0
        log_scale = np.zeros(prob.shape[1])
        order = np.argsort(local, kind="stable")
        cuts = np.searchsorted(local[order], np.arange(n + 1))
        for at in range(1, n):
            part = order[cuts[at]:cuts[at + 1]]
            value = (window[(start[part]) % len(window)] * prob[piece[part]]).sum(axis=0)
            window[at % len(window)] = value
            if value.min() < 1e-100 or value.max() > 1e100:
                window /= value
                log_scale += np.log(value)
        with np.errstate(divide="ignore"):
            return np.log(window[(n - 1) % len(window)]) + log_scale - (len(word) + 1) * math.log(LIFT)

    def expected(self, words: list[str], weight: np.ndarray, prob: np.ndarray) -> np.ndarray:
        """Expected piece counts (one column per language) over weighted words."""
        parts = self.matches(words)
        alpha = self.forward(words, prob, parts)
        tiny = self._tiny(alpha, parts[4])
        if not tiny.any():
            return self._expected(parts, alpha, weight, prob)
        total, rest = np.zeros((self.n + 1, prob.shape[1])), np.flatnonzero(~tiny)
        if len(rest):
            total += self.expected([words[i] for i in rest], weight[rest], prob)
        for i in np.flatnonzero(tiny):
            # a factor per character and language that makes the word's sum one changes no share
            factor = np.exp(-self._log_long(words[i], prob) / (len(words[i]) + 1)) / LIFT
            scaled = prob * factor ** self.length[:, None]
            parts = self.matches([words[i]])
            total += self._expected(parts, self.forward([words[i]], scaled, parts), weight[i:i + 1], scaled)
        return total

    def _expected(self, parts, alpha: np.ndarray, weight: np.ndarray, prob: np.ndarray) -> np.ndarray:
        piece, start, end, local, begins, ends = parts
        beta = np.zeros_like(alpha)
        beta[ends] = 1.0
        for part, targets, runs in self._steps(-(local - self.length[piece]), start):
            beta[targets] = np.add.reduceat(beta[end[part]] * prob[piece[part]], runs, axis=0)
        word = np.searchsorted(begins, start, side="right") - 1
        share = alpha[start] * prob[piece] * beta[end] / alpha[ends][word] * weight[word]
        return np.stack([np.bincount(piece, share[:, k], self.n + 1) for k in range(prob.shape[1])], 1)


def _lifted(prob: np.ndarray, lattice: Lattice) -> np.ndarray:
    full = np.vstack([prob, np.full((1, prob.shape[1]), UNKNOWN)])
    return full * (LIFT ** lattice.length)[:, None]


def _to_learn(df: DataFrame, learn: Column, text: str, lang: str,
              id_col: str | None) -> tuple[DataFrame, dict[str, int]]:
    """Rows to learn from, and their number in each language (without ``id_col`` about that of different texts)."""
    rows = df.where(learn & F.col(lang).isNotNull() & F.col(text).isNotNull())
    number = F.count("*") if id_col else F.approx_count_distinct(F.xxhash64(text), 0.02)
    return rows, {r[0]: r[1] for r in rows.groupBy(lang).agg(number).collect()}     # a row per language


def _sample(rows: DataFrame, counts: dict[str, int], text: str, lang: str, id_col: str | None,
            docs_per_language: int) -> DataFrame:
    """About ``docs_per_language`` texts of each language, chosen by a hash of the id (without ``id_col`` of the text),
    equal texts once."""
    cut = F.create_map(*[x for k in sorted(counts) for x in (
        F.lit(k), F.lit(int(min(1.0, docs_per_language / counts[k]) * (1 << 30))))])
    return (rows.where(F.pmod(F.xxhash64(F.col(id_col or text), F.lit(3)), F.lit(1 << 30)) < cut[F.col(lang)])
            .select(F.col(lang).alias("lang"), F.col(text).alias("text"))
            .withColumn("digest", F.xxhash64("text")).dropDuplicates(["lang", "digest"]).drop("digest"))


def train(df: DataFrame, learn: Column, model_path: str, text: str = "text", lang: str = "lang",
          id_col: str | None = "doc_id", docs_per_language: int = 1500, rounds: int = 3):
    """(languages, pieces, probabilities) learned from rows where ``learn`` holds and ``lang`` is known.

    Without ``id_col`` texts are chosen by their own hash, so ids may be null or repeated.
    Sizes: a row per piece of the fixed vocabulary, a column per language.
    """
    spark = df.sparkSession
    ship_code(spark)
    rows, counts = _to_learn(df, learn, text, lang, id_col)
    languages, pieces = sorted(counts), read_pieces(model_path)
    if not languages:
        return [], pieces, np.zeros((len(pieces), 0))
    chosen = _sample(rows, counts, text, lang, id_col, docs_per_language)

    def count_words(batches):
        for whole in batches:
            for b in text_slices(whole, "text"):
                found: dict = {}
                for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    for w in letters(t):
                        for at in range(0, len(w), LONGEST_TRAINED):       # a longer run teaches piece by piece
                            piece = k, w[at:at + LONGEST_TRAINED]
                            found[piece] = found.get(piece, 0) + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k for k, _ in found], pa.string()), pa.array([w for _, w in found], pa.string()),
                     pa.array(list(found.values()), pa.int64())], names=["lang", "word", "n"])

    words = write_stage(chosen.mapInArrow(count_words, "lang string, word string, n long")
                        .groupBy("word").agg(F.array(*[
                            F.sum(F.when(F.col("lang") == k, F.col("n")).otherwise(0)).cast("double")
                            for k in languages]).alias("weight")), "langid-words")
    n, size = len(languages), len(pieces)
    prob = np.full((size, n), 1.0 / size)
    vocabulary, of_pieces = broadcast_value(spark, pieces), content_key(pieces)
    for _ in range(rounds):
        model = broadcast_value(spark, prob)

        def expect(batches):
            lattice = worker_cached(("langid_lattice", of_pieces), lambda: Lattice(vocabulary.value))
            lifted, total = _lifted(model.value, lattice), 0.0
            for b in batches:
                for a in range(0, b.num_rows, 5000):
                    part = b.slice(a, 5000)
                    weight = np.array(part.column(1).to_pylist(), dtype=float)
                    total = total + lattice.expected(part.column(0).to_pylist(), weight, lifted)
            if not isinstance(total, float):
                at = np.flatnonzero(total[:-1].sum(axis=1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at), pa.array(total[at].tolist(), pa.list_(pa.float64()))], names=["piece", "n"])

        sums = (words.mapInArrow(expect, "piece long, n array<double>").groupBy("piece")
                .agg(*[F.sum(F.col("n")[k]).alias(f"n{k}") for k in range(n)]).collect())   # a row per piece
        count = np.full((size, n), 0.05)
        for r in sums:
            count[r[0]] += r[1:]
        prob = count / count.sum(axis=0)
    return languages, pieces, prob


class Scorer:
    def __init__(self, pieces: list[str], prob: np.ndarray, most_words: int = 200_000):
        self.lattice = Lattice(pieces)
        self.prob = _lifted(prob, self.lattice)
        self.most = most_words
        self.forget()

    def forget(self):
        self.row: dict[str, int] = {}
        self.logs = np.empty((0, self.prob.shape[1]))

    def rows(self, words: list[str]) -> np.ndarray:
        new = [w for w in dict.fromkeys(words) if w not in self.row]
        if len(self.row) + len(new) > self.most and self.row:
            self.forget()
            new = list(dict.fromkeys(words))
        if new:
            known = len(self.row)
            self.row.update((w, known + i) for i, w in enumerate(new))
            self.logs = np.concatenate([self.logs, self.lattice.log_words(new, self.prob)])
        return np.fromiter(map(self.row.__getitem__, words), np.int64, len(words))

    def text_logs(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Log-probabilities per text and language, and the number of words."""
        lists = [letters(t) for t in texts]
        sizes = np.array([len(x) for x in lists])
        out = np.zeros((len(texts), self.prob.shape[1]))
        if sizes.sum():
            logs = self.rows([w for x in lists for w in x])
            starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
            full = sizes > 0
            out[full] = np.add.reduceat(self.logs[logs], starts[full], axis=0)
        return out, sizes


FIELDS = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def predict(df: DataFrame, model, text: str = "text", keep: list[str] | None = None) -> tuple[DataFrame, str]:
    """Append a struct (lang_pred, score); returns the frame and the struct's name."""
    languages, pieces, prob = model
    shared = broadcast_value(df.sparkSession, (languages, pieces, prob))
    token = content_key(languages, pieces, prob)

    def per_texts(texts):
        names, own_pieces, own_prob = shared.value
        if not names:
            return [["und"] * len(texts), [0.0] * len(texts)]
        scorer = worker_cached(("langid", token), lambda: Scorer(own_pieces, own_prob))
        logs, sizes = scorer.text_logs(texts)
        best = logs.argmax(axis=1)
        share = 1.0 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
        return [[names[k] if s else "und" for k, s in zip(best, sizes)],
                [float(p) if s else 0.0 for p, s in zip(share, sizes)]]

    return append_struct(df, text, FIELDS, per_texts, keep)


FIT_FIELDS = T.StructType([*FIELDS.fields, T.StructField("per_letter", T.DoubleType()),
                           T.StructField("distinct_words", T.LongType())])


def restricted(model, names):
    """The model with those of its languages that are in ``names``."""
    languages, pieces, prob = model
    at = [i for i, k in enumerate(languages) if k in names]
    return [languages[i] for i in at], pieces, prob[:, at]


def _text_fit(scorer: Scorer, text: str | None):
    """Per language the text's log-probability and the mean of a letter over its distinct words, and their number;
    None without words."""
    words = Counter(letters(text))
    if not words:
        return None
    at = scorer.rows(list(words))
    own = scorer.logs[at]
    return np.fromiter(words.values(), float, len(words)) @ own, own.sum(axis=0) / sum(map(len, words)), len(words)


def fits(df: DataFrame, model, text: str = "text", keep: list[str] | None = None) -> tuple[DataFrame, str]:
    """``predict`` with a measure that does not compare languages: ``per_letter``, the mean log-probability of a
    letter in the predicted language over the text's distinct words (null without words)."""
    shared = broadcast_value(df.sparkSession, model)
    token = content_key(*model)

    def per_texts(texts):
        names, pieces, prob = shared.value
        if not names:
            return [["und"] * len(texts), [0.0] * len(texts), [None] * len(texts), [0] * len(texts)]
        scorer = worker_cached(("langid", token), lambda: Scorer(pieces, prob))
        found = []
        for t in texts:
            fit = _text_fit(scorer, t)
            if fit is None:
                found.append(("und", 0.0, None, 0))
                continue
            logs, per_letter, n_words = fit
            best = int(logs.argmax())
            found.append((names[best], float(1 / np.exp(logs - logs[best]).sum()), float(per_letter[best]), n_words))
        return [list(c) for c in zip(*found)] if found else [[], [], [], []]

    return append_struct(df, text, FIT_FIELDS, per_texts, keep)


def usual_fit(df: DataFrame, learn: Column, model, text: str = "text", lang: str = "lang",
              id_col: str | None = "doc_id", docs_per_language: int = 1500) -> dict[str, float]:
    """Mean ``per_letter`` of a language's training texts that are predicted as it, or, if none is, of all of them:
    a number for each language with letters in its training texts."""
    ship_code(df.sparkSession)
    rows, counts = _to_learn(df, learn, text, lang, id_col)
    if not counts:
        return {}
    shared = broadcast_value(df.sparkSession, model)
    token = content_key(*model)

    def measure(batches):
        names, pieces, prob = shared.value
        scorer = worker_cached(("langid", token), lambda: Scorer(pieces, prob))
        column = {k: i for i, k in enumerate(names)}
        for whole in batches:
            for b in text_slices(whole, "text"):
                found = []
                for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    fit = _text_fit(scorer, t) if k in column else None
                    if fit is not None:
                        logs, per_letter, _ = fit
                        found.append((k, float(per_letter[column[k]]), int(logs.argmax()) == column[k]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f[i] for f in found], kind)
                     for i, kind in enumerate((pa.string(), pa.float64(), pa.bool_()))],
                    names=["lang", "per_letter", "as_own"])

    return dict(_sample(rows, counts, text, lang, id_col, docs_per_language)
                .mapInArrow(measure, "lang string, per_letter double, as_own boolean").groupBy("lang")
                .agg(F.coalesce(F.avg(F.when(F.col("as_own"), F.col("per_letter"))), F.avg("per_letter"))).collect())
