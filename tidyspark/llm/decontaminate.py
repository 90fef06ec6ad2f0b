"""Benchmark decontamination by pigeonhole edit matching.

Texts and test items are compared in lower case with single spaces. An item of
m characters may differ in ``m // per_edit`` edits; it is split into one piece
more than that, so every match keeps at least one piece unchanged. One
Aho-Corasick scan of a text finds all exact pieces; around each hit, Myers'
bit-parallel algorithm finds the smallest edit distance of the whole item to
any substring of the window. Hits of one item that imply nearby places share a
window.

The test items are a stated set met by every text, in blocks of at most about
``block_bytes`` of item text, each broadcast in turn.

Defined results: null, empty or blank items match nothing, and so do null or
empty texts; items repeated with the same id and text count once; of several
matches of an item in a text all that don't overlap are returned, better ones
first to be chosen (``Matcher.matches`` gives the best only, the first of equals); a text
shorter than an item matches if its distance is within budget; repeated rows
are matched row by row. Positions count characters of the compared form.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidyspark.llm.common import append_struct, broadcast_value, worker_cached


def compared(text: str | None) -> str:
    return " ".join(text.lower().split()) if text else ""


def pieces_of(item: str, per_edit: int) -> list[tuple[int, str]]:
    """(offset, piece): edits allowed plus one pieces of nearly equal length."""
    parts = len(item) // per_edit + 1
    cuts = [len(item) * i // parts for i in range(parts + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def letter_masks(item: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def myers(masks: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """Smallest edit distance of the pattern to a substring of ``text``, and the first end where it occurs."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m              # vertical steps of +1 and -1, and the distance at the last row
    best, end = m, 0
    get = masks.get
    for j, c in enumerate(text):
        same = get(c, 0)
        vertical = same | down
        cross = (((same & up) + up) ^ up) | same
        plus = down | (full & ~(cross | up))
        minus = up & cross
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
            if score < best:
                best, end = score, j + 1
        plus, minus = plus << 1 & full, minus << 1 & full
        up = minus | (full & ~(vertical | plus))
        down = plus & vertical
    return best, end


class Matcher:
    def __init__(self, items: list[tuple[int, str]], per_edit: int):
        import ahocorasick
        self.items = [(i, compared(t)) for i, t in items]
        self.budget = [len(t) // per_edit for _, t in self.items]
        self.masks = [None] * len(self.items)
        where: dict[str, list] = {}
        for k, (_, t) in enumerate(self.items):
            for offset, piece in (pieces_of(t, per_edit) if t else []):
                where.setdefault(piece, []).append((k, offset))
        self.scan = ahocorasick.Automaton()
        for piece, places in where.items():
            self.scan.add_word(piece, (len(piece), places))
        if where:
            self.scan.make_automaton()
        self.any = bool(where)

    def matches(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item id, distance, start, end) of the best match of every item found."""
        t = compared(text)
        found = [(self.items[k][0], *best) for k, starts in self._implied(t).items() if (best := self._best(t, k, starts))]
        return sorted(found, key=lambda f: (f[0] is None, f[0] or 0, *f[1:]))

    def every(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item id, distance, start, end) of the matches of every item that don't overlap each other."""
        t = compared(text)
        found = [(self.items[k][0], *f) for k, starts in self._implied(t).items() for f in self._every(t, k, starts)]
        return sorted(found, key=lambda f: (f[0] is None, f[0] or 0, f[2], *f[1:]))

    def _implied(self, t: str) -> dict[int, list[int]]:
        """The places where an item begins if a piece of it that was hit is unchanged."""
        implied: dict[int, set[int]] = {}
        if t and self.any:
            for e, (size, places) in self.scan.iter(t):
                for k, offset in places:
                    implied.setdefault(k, set()).add(e + 1 - size - offset)
        return {k: sorted(starts) for k, starts in implied.items()}

    def _every(self, t: str, k: int, starts: list[int]) -> list[tuple[int, int, int]]:
        item, budget = self.items[k][1], self.budget[k]
        m, found, i, done = len(item), [], 0, 0
        while i < len(starts):
            low = high = starts[i]
            while i < len(starts) and starts[i] <= high + 2 * budget:
                high = starts[i]
                i += 1
            # what an earlier window has matched is not looked at again
            left, stop = max(done, low - budget), min(len(t), high + m + budget)
            gaps = []
            while (at := t.find(item, left, stop)) >= 0:
                found.append((0, at, at + m))
                gaps.append((left, at))
                left = at + m
            gaps.append((left, stop))
            while gaps and budget:
                a, b = gaps.pop()
                if b - a < m - budget:
                    continue
                hit = self._nearest(t[a:b], k)
                if hit:
                    found.append((hit[0], a + hit[1], a + hit[2]))
                    gaps += [(a, a + hit[1]), (a + hit[2], b)]
            done = max([done] + [f[2] for f in found])
        return found

    def _nearest(self, window: str, k: int) -> tuple[int, int, int] | None:
        """(distance, start, end) of the item's best match in the window, if within its budget."""
        item, budget = self.items[k][1], self.budget[k]
        if self.masks[k] is None:
            self.masks[k] = letter_masks(item)
        distance, end = myers(self.masks[k], len(item), window)
        if distance > budget:
            return None
        back = window[max(0, end - len(item) - budget):end][::-1]
        _, length = myers(letter_masks(item[::-1]), len(item), back)
        return distance, end - length, end

    def _best(self, t: str, k: int, starts: list[int]) -> tuple[int, int, int] | None:
        item, budget = self.items[k][1], self.budget[k]
        m, best, i = len(item), None, 0
        if self.masks[k] is None:
            self.masks[k] = letter_masks(item)
        while i < len(starts) and (best is None or best[0]):
            low = high = starts[i]
            while i < len(starts) and starts[i] <= high + 2 * budget:
                high = starts[i]
                i += 1
            a, b = max(0, low - budget), min(len(t), high + m + budget)
            window = t[a:b]
            at = window.find(item)
            if at >= 0:
                distance, end = 0, at + m
            else:
                distance, end = myers(self.masks[k], m, window)
            if distance <= budget and (best is None or distance < best[0]):
                back = window[max(0, end - m - budget):end][::-1]
                _, length = myers(letter_masks(item[::-1]), m, back)
                best = (distance, a + end - length, a + end)
        return best


FIELDS = T.StructType([T.StructField("items", T.ArrayType(T.LongType())),
                       T.StructField("distances", T.ArrayType(T.LongType())),
                       T.StructField("starts", T.ArrayType(T.LongType())),
                       T.StructField("ends", T.ArrayType(T.LongType()))])


def item_blocks(items: DataFrame, item_id: str = "item_id", text: str = "text",
                block_bytes: int = 8 << 20) -> list[list[tuple[int, str]]]:
    """Yield the distinct test items in blocks of bounded size."""
    rows = (items.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text"))
            .where(F.trim("text") != "").distinct())
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    for i in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == i)
        yield [tuple(r) for r in part.collect()]


def match(df: DataFrame, items: list[tuple[int, str]], text: str = "text", per_edit: int = 20,
          keep: list[str] | None = None, every: bool = False) -> tuple[DataFrame, str]:
    """Append a struct of arrays (items, distances, starts, ends) for one block of test items.

    The best match of each item, or ``every`` one.
    """
    shared, token = broadcast_value(df.sparkSession, items), uuid.uuid4().hex

    def per_texts(texts):
        matcher = worker_cached(("decontaminate", token), lambda: Matcher(shared.value, per_edit))
        found = [(matcher.every if every else matcher.matches)(t) for t in texts]
        return [[[f[k] for f in one] for one in found] for k in range(4)]

    return append_struct(df, text, FIELDS, per_texts, keep)


def contamination(df: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text",
                  per_edit: int = 20) -> DataFrame:
    """Rows (id, item_id, distance, start_char, end_char): every place where a test item is found, in every text."""
    out = None
    for block in item_blocks(items):
        matched, name = match(df, block, text, per_edit, keep=[id_col], every=True)
        rows = (matched.where(F.size(f"{name}.items") > 0)
                .select(id_col, F.explode(F.arrays_zip(*[F.col(f"{name}.{c}") for c in FIELDS.names])).alias(name))
                .select(id_col, *[F.col(f"{name}.{c}").alias(a) for c, a in
                                  zip(FIELDS.names, ("item_id", "distance", "start_char", "end_char"))]))
        out = rows if out is None else out.union(rows)
    return out


def clean(df: DataFrame, items: DataFrame, text: str = "text", per_edit: int = 20) -> DataFrame:
    """The rows of ``df`` in which no test item occurs, with the same columns."""
    columns = df.columns
    for block in item_blocks(items):
        matched, name = match(df, block, text, per_edit)
        df = matched.where(F.size(f"{name}.items") == 0).select(*columns)
    return df
