"""Byte-level BPE encoding and decoding by prefix dynamic programming.

For every prefix of a piece there is exactly one token that can end its
encoding: the token ``t`` for which the encoding of the shorter prefix ends in
a token that stays apart from ``t``. So one token per prefix holds all
encodings at once: appending bytes only adds entries, and an edit keeps the
entries before it. All tokens that end at a byte come from an Aho-Corasick
scan, longest first.

Two tokens stay apart when no merge joins symbols across their border before
those symbols are used up on their own side. The symbols at a border are the
right edge of the left token and the left edge of the right token, undone
merge by merge, latest first.

Defined results: a null or empty text has no tokens and decodes to nothing;
repeated rows are encoded row by row; texts of any length are encoded whole;
a null identifier list decodes to no bytes. Extra columns never clash with the
results. A token that merges cannot produce is used only where a whole piece
equals it, as the public library does.
"""

from __future__ import annotations

import base64
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidyspark.llm.common import (Memo, append_struct, arrow_type, broadcast_value, content_key, fresh_name,
                                  ship_code, whole_chunks, worker_cached)
from tidyspark.llm.token_counts import PLAIN, plain_pattern

BITS = 20
NEVER = 1 << 40                 # the rank at which a symbol at the top is used up


def read_ranks(path: str) -> list[bytes]:
    """Tokens by rank from a file of ``base64 rank`` lines."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    tokens = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


class Merges:
    """For each token the two symbols of its last merge; (-1, -1) for bytes, None if merges can't make it."""

    def __init__(self, tokens: list[bytes]):
        rank = {t: i for i, t in enumerate(tokens)}
        self.parts = [self._last_merge(t, rank) for t in tokens]

    @staticmethod
    def _last_merge(token: bytes, rank: dict) -> tuple[int, int] | None:
        parts = [token[i:i + 1] for i in range(len(token))]
        while len(parts) > 2:
            found = [(rank.get(parts[i] + parts[i + 1], NEVER), i) for i in range(len(parts) - 1)]
            best, i = min(found)
            if best == NEVER:
                return None
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return (-1, -1) if len(parts) < 2 else (rank[parts[0]], rank[parts[1]])


class PrefixEncoder:
    def __init__(self, tokens: list[bytes], parts: list, pattern: str):
        import ahocorasick
        import regex
        self.tokens, self.parts = tokens, parts
        self.rank = {t: i for i, t in enumerate(tokens)}
        self.joined = {}
        self.ends = ahocorasick.Automaton()
        for i, t in enumerate(tokens):
            if parts[i] is not None:
                self.ends.add_word(t.decode("latin-1"), (i, len(t)))
        self.ends.make_automaton()
        self.pattern, self.plain = regex.compile(pattern), plain_pattern(pattern)
        self.apart = Memo(self._apart, 400_000)
        self.memo = Memo(self.encode_piece, 200_000)

    def _apart(self, pair: int) -> bool:
        left, right = pair >> BITS, pair & ((1 << BITS) - 1)
        left_used = right_used = NEVER
        tokens, parts, rank = self.tokens, self.parts, self.rank
        while True:
            joined = rank.get(tokens[left] + tokens[right])
            # of equal ranks the leftmost merge comes first
            if joined is not None and joined < left_used and joined <= right_used:
                return False
            left_made = left if parts[left][0] >= 0 else -1
            right_made = right if parts[right][0] >= 0 else -1
            if left_made < 0 and right_made < 0:
                return True
            if right_made >= left_made:
                right_used, right = right, parts[right][0]
            else:
                left_used, left = left, parts[left][1]

    def last_tokens(self, data: bytes, last: list[int] | None = None) -> list[int]:
        """``last[i]``: the token that ends the encoding of ``data[:i]``. Entries given are kept."""
        last = [-1] if last is None else list(last)
        known = len(last) - 1
        # a token reaching over the known entries starts at most its own length back
        back = max(0, known - self.longest)
        last += [-1] * (len(data) - known)
        apart = self.apart
        for end, (token, size) in self.ends.iter(data[back:].decode("latin-1")):
            end += back + 1
            if end <= known or last[end] >= 0:
                continue
            start = end - size
            if start == 0 or apart[last[start] << BITS | token]:
                last[end] = token
        return last

    @property
    def longest(self) -> int:
        if "_longest" not in self.__dict__:
            self._longest = max(map(len, self.tokens))
        return self._longest

    def walk_back(self, last: list[int]) -> tuple[int, ...]:
        found, i = [], len(last) - 1
        while i:
            found.append(last[i])
            i -= len(self.tokens[last[i]])
        return tuple(reversed(found))

    def encode_piece(self, piece: str) -> tuple[int, ...]:
        data = piece.encode("utf-8")
        whole = self.rank.get(data)
        if whole is not None:
            return (whole,)
        return self.walk_back(self.last_tokens(data))

    def pieces(self, text: str) -> list[str]:
        return (self.plain if PLAIN.fullmatch(text) else self.pattern).findall(text)

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        get = self.memo.__getitem__
        return [t for part in whole_chunks(text)
                for t in chain.from_iterable(map(get, self.pieces(part)))]


class EditableEncoding:
    """An encoded text that re-encodes only near an edit; ``ids()`` equals encoding afresh."""

    def __init__(self, encoder: PrefixEncoder, text: str):
        self.encoder = encoder
        self.text = ""
        self.pieces: list[str] = []
        self.tables: list[list[int] | None] = []
        self.bytes_done = 0
        self.replace(0, 0, text)

    def _table(self, piece: str, old: str = "", table: list[int] | None = None) -> list[int] | None:
        data = piece.encode("utf-8")
        if data in self.encoder.rank:
            return None
        kept = None
        if table is not None:
            before, same = old.encode("utf-8"), 0
            while same < min(len(before), len(data)) and before[same] == data[same]:
                same += 1
            kept = table[:same + 1]
        self.bytes_done += len(data) - (len(kept) - 1 if kept else 0)
        return self.encoder.last_tokens(data, kept)

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, stop: int, new: str) -> None:
        """Put ``new`` in the place of ``text[start:stop]``."""
        self.text = self.text[:start] + new + self.text[stop:]
        shift = start + len(new) - stop
        at, first = 0, 0                       # the piece before the edit may split in another way
        while first < len(self.pieces) and at + len(self.pieces[first]) < start - 1:
            at += len(self.pieces[first])
            first += 1
        if first:
            first -= 1
            at -= len(self.pieces[first])
        old_start, position = {}, at
        for i in range(first, len(self.pieces)):
            if position >= stop:
                old_start[position + shift] = i
            position += len(self.pieces[i])
        pieces, tables, rest = [], [], len(self.pieces)
        for m in self.encoder.pattern.finditer(self.text, at):
            if m.start() > start + len(new) and m.start() in old_start:
                rest = old_start[m.start()]    # from here the old pieces hold again
                break
            i = first + len(pieces)
            old = (self.pieces[i], self.tables[i]) if i < len(self.pieces) else ("", None)
            pieces.append(m.group())
            same = old[0] == m.group()
            tables.append(old[1] if same else self._table(m.group(), *old))
        self.pieces[first:rest], self.tables[first:rest] = pieces, tables

    def ids(self) -> list[int]:
        rank = self.encoder.rank
        return [t for p, table in zip(self.pieces, self.tables)
                for t in ([rank[p.encode("utf-8")]] if table is None else self.encoder.walk_back(table))]


def encoder_of(spark, ranks_path: str, pattern: str):
    """A function for tasks that gives the worker's encoder; the vocabulary (fixed size) is broadcast."""
    tokens = read_ranks(ranks_path)
    model = broadcast_value(spark, (tokens, Merges(tokens).parts))
    key = content_key(tokens, pattern)
    return lambda: worker_cached(("byte_bpe", key), lambda: PrefixEncoder(*model.value, pattern))


FIELDS = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType()))])


def encode(df: DataFrame, ranks_path: str, pattern: str, text: str = "text",
           keep: list[str] | None = None) -> tuple[DataFrame, str]:
    """Append a struct (ids array<int>) holding the identifiers of ``text``."""
    get = encoder_of(df.sparkSession, ranks_path, pattern)

    return append_struct(df, text, FIELDS, lambda texts: [_id_lists(get(), texts)], keep)


def _id_lists(encoder: PrefixEncoder, texts: list[str | None]) -> pa.ListArray:
    ids = [np.array(encoder.encode(t), dtype=np.int32) for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
    flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _bytes_of(vocabulary: pa.Array, lists: pa.ListArray) -> pa.Array:
    """The tokens' bytes, joined row by row: taken tokens lie side by side, so only offsets change."""
    flat = vocabulary.take(lists.flatten())
    ends = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset:flat.offset + len(flat) + 1]
    rows = np.array(lists.offsets) - lists.offsets[0].as_py()
    joined = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(lists), [None, pa.py_buffer(ends[rows].copy()), flat.buffers()[2]])
    return joined.cast(arrow_type(T.BinaryType()))


def decode(df: DataFrame, ranks_path: str, ids, keep: list[str] | None = None) -> tuple[DataFrame, str]:
    """Append a binary column with the bytes of the identifiers in column ``ids``."""
    ship_code(df.sparkSession)
    ranks = read_ranks(ranks_path)
    tokens, key = broadcast_value(df.sparkSession, ranks), content_key(ranks)
    keep = list(df.columns) if keep is None else list(keep)
    out, probe = fresh_name(df, "llm_bytes"), fresh_name(df, "llm_ids")
    picked = df.select(*[df[c] for c in keep], F.coalesce(ids, F.array().cast("array<int>")).alias(probe))
    schema = T.StructType([picked.schema[c] for c in keep] + [T.StructField(out, T.BinaryType())])

    def run(batches):
        vocabulary = worker_cached(("byte_bpe_tokens", key), lambda: pa.array(tokens.value, pa.large_binary()))
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in range(len(keep))), _bytes_of(vocabulary, b.column(len(keep)))],
                names=[*keep, out])

    return picked.mapInArrow(run, schema), out


ROUND_TRIP = T.StructType([*FIELDS.fields, T.StructField("decoded", T.BinaryType())])


def round_trip(df: DataFrame, ranks_path: str, pattern: str, text: str = "text",
               keep: list[str] | None = None) -> tuple[DataFrame, str]:
    """Append a struct (ids, decoded): encode and decode in one task, so that one worker process serves both."""
    get, key = encoder_of(df.sparkSession, ranks_path, pattern), content_key(read_ranks(ranks_path))

    def per_texts(texts):
        lists = _id_lists(get(), texts)
        vocabulary = worker_cached(("byte_bpe_tokens", key), lambda: pa.array(get().tokens, pa.large_binary()))
        return [lists, _bytes_of(vocabulary, lists)]

    return append_struct(df, text, ROUND_TRIP, per_texts, keep)


def round_trip_digests(df: DataFrame, ranks_path: str, pattern: str, keep: list[str],
                       text: str = "text") -> DataFrame:
    """Encode, decode, and digest both: n_tokens, ids_sha256, decoded_sha256 beside ``keep``."""
    done, name = round_trip(df, ranks_path, pattern, text, keep)
    ids = F.col(f"{name}.ids")
    return done.select(*keep, F.size(ids).cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("ids_sha256"),
                       F.sha2(F.col(f"{name}.decoded"), 256).alias("decoded_sha256"))
