"""Spelling variants of a corpus's words by a bit-sliced position index.

Words. Maximal runs of letters are counted in tasks, a slice of texts at a time,
then summed by word; words of at least ``least_letters`` code points and
``least_count`` occurrences are the vocabulary. Two words are near if one
inserted, deleted or replaced code point makes one of the other.

Index. A bucket of words has one bitset for every (position, letter): bit ``i``
tells that word ``i`` has the letter there. A search reads the query's letters
once and keeps the set of words without an error so far and the set with one
error, for a replaced, a missing and an additional letter; each step is a few
and/or operations on whole bitsets, the last two with positions shifted by one.

Buckets. A near pair whose shorter word has L letters has its error in a window
of these letters and agrees before and behind it. Every word enters the class of
its own length and of one less, with the windows [0, L/2) and [L/2, L); words
of a class and window with the same letters around it share a bucket. A bucket of
over ``MOST_WORDS`` words is not searched but cut: its words enter again with both halves
of the window, so they share more letters. A window of one letter
holds no more words than there are pairs of letters, so buckets are bounded without a
word lost. A pair is reported in one bucket only: that whose window holds the
first difference. Each bucket gives one row per word, the number of near words and the best of
them, never the pairs.

Forms. A word's form is its near word with the largest count (ties: the
smallest in code-point order) if that count is at least ``ratio`` times its own. Counts
grow along forms, so following them ends; roots are found by pointer doubling.

Defined results: null and empty texts have no words; a null id counts as empty
text; repeated rows count again; a word of any length takes part; an empty table
gives an empty vocabulary; columns besides id and text are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidyspark.llm.common import ship_code, text_slices, whole_chunks, write_stage

RUNS = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
MOST_WORDS = 8192                # of a bucket; also more than a window of one letter can hold here (90 + 90 * 90)
SPREAD = 32                      # shares of the words of a hot bucket where it is told apart
KEY = ["letters", "first", "last", "head", "tail"]


def lowered(run: str) -> str:
    """Only A-Z become small."""
    return run if run.islower() else run.translate(LOWER)


def word_counts(docs: DataFrame, id_col: str = "doc_id", text: str = "text", least_letters: int = 6,
                least_count: int = 5, alter: Callable[[str, str], str] | None = None) -> DataFrame:
    """The vocabulary (word, n) of whole texts; ``alter(id as text, run)`` may replace a lower-cased run."""
    ship_code(docs.sparkSession)
    picked = docs.select(F.coalesce(docs[id_col].cast("string"), F.lit("")).alias("id"), docs[text].alias("text"))

    def run(batches):
        for whole in batches:
            for b in text_slices(whole, "text"):
                total: Counter = Counter()
                for key, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    for part in whole_chunks(t or ""):
                        for raw, n in Counter(RUNS.findall(part)).items():
                            word = lowered(raw)
                            if alter is not None:
                                word = alter(key, word)
                            if len(word) >= least_letters:
                                total[word] += n
                yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()),
                                                  pa.array(list(total.values()), pa.int64())], names=["word", "n"])

    return (picked.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= least_count))


class PositionIndex:
    """Bitsets of words by (position, letter) and by length, over the window [first, last] of positions.

    The words agree before the window and, counted from their ends, behind it; bit
    ``i`` stands for ``words[i]``.
    """

    def __init__(self, words: list[str], letters: int, first: int, last: int):
        self.letters, self.first, self.last = letters, first, last
        self.all = (1 << len(words)) - 1
        self.at: list[dict[str, int]] = [{} for _ in range(last - first + 2)]
        self.of_length = {letters: 0, letters + 1: 0}
        for i, w in enumerate(words):
            bit = 1 << i
            self.of_length[len(w)] = self.of_length.get(len(w), 0) | bit
            for column, c in zip(self.at, w[first:last + 1]):
                column[c] = column.get(c, 0) | bit

    def near(self, word: str) -> int:
        """Words one error from ``word`` whose first difference is in the window; of the two lengths one is ``letters``."""
        return self._longer_or_same(word) if len(word) == self.letters else self._shorter(word)

    def _longer_or_same(self, word: str) -> int:
        zero, replaced, added = self.all, 0, 0
        for k, c in enumerate(word[self.first:self.last]):
            here = zero & self.at[k].get(c, 0)
            replaced = (replaced & self.at[k].get(c, 0)) | (zero ^ here)
            added = (added | zero) & self.at[k + 1].get(c, 0)
            zero = here
        if self.last == self.letters:                    # the window reaches the words' ends
            return (replaced & self.of_length[self.letters]) | ((added | zero) & self.of_length[self.letters + 1])
        return ((replaced & self.of_length[self.letters]) | (added & self.of_length[self.letters + 1])) & ~zero

    def _shorter(self, word: str) -> int:
        zero, missing, before = self.all, 0, 0
        agreed = 0
        for k, c in enumerate(word[self.first:self.last + 1]):
            if k == self.last - self.first:
                agreed = zero                            # no difference inside the window
            missing = (missing & before_letter(self.at, k, c)) | zero
            zero &= self.at[k].get(c, 0)
        found = missing & self.of_length[self.letters]
        return found if self.last == self.letters else found & ~agreed


def before_letter(at: list[dict[str, int]], k: int, c: str) -> int:
    return at[k - 1].get(c, 0) if k else 0


def near_in_bucket(words: list[str], letters: int, first: int, last: int) -> Iterator[tuple[int, int, int]]:
    """(word, number of near words, first near word) as places in ``words``, for words that have any."""
    if len(words) < 2:
        return
    index = PositionIndex(words, letters, first, last)
    for i, w in enumerate(words):
        found = index.near(w)
        if found:
            yield i, found.bit_count(), (found & -found).bit_length() - 1


def _entry(letters, first, last):
    """A word's bucket in the class ``letters`` for the window [first, last)."""
    behind = letters - last
    return F.struct(letters.alias("letters"), first.alias("first"), last.alias("last"),
                    F.col("word").substr(F.lit(1), first).alias("head"),
                    F.col("word").substr(F.char_length("word") - behind + 1, behind).alias("tail"))


def _entries(vocabulary: DataFrame, least_letters: int) -> DataFrame:
    """Every word with its buckets: two classes of length, both halves of a word."""
    size = F.char_length("word")
    zero = F.lit(0)
    classes = [_entry(c, first, last) for c in (size, size - 1)
               for half in [(c / 2).cast("int")] for first, last in ((zero, half), (half, c))]
    return (vocabulary.select("word", "n", F.explode(F.array(*classes)).alias("b")).select("word", "n", "b.*")
            .where(F.col("letters") >= least_letters))


def _halves(entries: DataFrame) -> DataFrame:
    """The words of cut buckets with both halves of their windows."""
    middle = ((F.col("first") + F.col("last")) / 2).cast("int")
    parts = [_entry(F.col("letters"), first, last)
             for first, last in ((F.col("first"), middle), (middle, F.col("last")))]
    return entries.select("word", "n", F.explode(F.array(*parts)).alias("b")).select("word", "n", "b.*")


def _search(entries: DataFrame) -> DataFrame:
    """One row per word and bucket with near words: their number, the best one and its count."""
    spark = entries.sparkSession
    ship_code(spark)
    dealt = (entries.select(*KEY, "word", "n").repartition(*KEY)
             .sortWithinPartitions(*KEY, F.desc("n"), "word"))

    def run(batches):
        key, words, counts = None, [], []

        def bucket():
            rows = list(near_in_bucket(words, *key[:3])) if key else []
            return pa.RecordBatch.from_arrays(
                [pa.array([words[r[0]] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()),
                 pa.array([words[r[2]] for r in rows], pa.string()), pa.array([counts[r[2]] for r in rows], pa.int64())],
                names=["word", "n_near", "best", "best_n"]) if rows else None

        for b in batches:
            for *k, word, n in zip(*(b.column(i).to_pylist() for i in range(b.num_columns))):
                if k != key:
                    if (done := bucket()) is not None:
                        yield done
                    key, words, counts = k, [], []
                words.append(word)
                counts.append(n)
        if (done := bucket()) is not None:
            yield done

    return dealt.mapInArrow(run, "word string, n_near long, best string, best_n long")


def near_words(vocabulary: DataFrame, most_words: int = MOST_WORDS) -> DataFrame:
    """(word, n_near, best, best_n) for every word of (word, n) that has a near word."""
    least = vocabulary.agg(F.min(F.char_length("word"))).first()[0]
    entries = _entries(vocabulary, least or 0)
    parts = []
    while True:
        hot = write_stage(entries.where(F.col("last") - F.col("first") > 1).groupBy(*KEY).count()
                          .where(F.col("count") > most_words).drop("count"), "spelling-cut")
        if hot.isEmpty():
            parts.append(_search(entries))
            break
        # a hot bucket's words are dealt into shares, so that no task of the join holds them all
        shares = hot.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
        dealt = entries.withColumn("share", F.pmod(F.xxhash64("word"), F.lit(SPREAD)).cast("int"))
        parts.append(_search(dealt.join(shares, [*KEY, "share"], "left_anti").drop("share")))
        entries = write_stage(_halves(dealt.join(shares, [*KEY, "share"], "left_semi")), "spelling-halves")
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word")))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
            .select("word", "n_near", F.col("b.word").alias("best"), (-F.col("b.less")).alias("best_n")))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) by pointer doubling over (word, form)."""
    up = write_stage(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        up = write_stage(up.select("word", "root").join(further, "root", "left")
                         .select("word", F.coalesce("next", "root").alias("root"),
                                 F.col("next").isNotNull().alias("moved")), "spelling-roots")
        if up.where("moved").isEmpty():
            return up.select("word", "root")
        up = up.select("word", "root")


def variant_groups(vocabulary: DataFrame, ratio: int = 5, most_words: int = MOST_WORDS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of the vocabulary (word, n)."""
    vocabulary = write_stage(vocabulary.select("word", "n"), "spelling-words")
    is_form = F.col("best_n") >= ratio * F.col("n")
    out = write_stage(vocabulary.join(near_words(vocabulary, most_words), "word", "left")
                      .select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                              F.when(is_form, F.col("best")).alias("form"),
                              F.when(is_form, F.col("best_n")).alias("form_n")), "spelling-forms")
    roots = _roots(out.where("form IS NOT NULL"))
    return (out.join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
