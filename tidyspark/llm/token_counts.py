"""Token counts by heap-and-linked-list byte-pair merging.

A word starts as a linked list of byte symbols. A heap holds the adjacent
pairs that a merge rule joins, keyed by (rank, position); the lowest is popped
again and again, stale entries are skipped, and a merge unlinks the right-hand
node and offers the two new pairs. The count of a word is its initial symbols
minus the merges done; token identifiers are never produced.

Defined results: a null text counts as empty (0 bytes, 0 tokens); repeated
rows are counted row by row; special strings of the vocabulary inside a text
count one token each, as the public library does by default; texts of any
length are counted whole. Extra columns never clash with the results.

The words of a text come from the normaliser and pre-tokeniser named in the
vocabulary file. Texts of plain Latin characters take an equal ``re``
pattern; any other text goes through the library's own normaliser and
pre-tokeniser, so the words are the same for every script.
"""

from __future__ import annotations

import heapq
import json
import re

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidyspark.llm.common import Memo, append_struct, broadcast_value, content_key, whole_chunks, worker_cached

END = "</w>"
BITS = 20                      # an identifier fits in so many bits
NOTHING = (1 << BITS) - 1
# characters whose normal form, case mapping and classes do not depend on a Unicode version
PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xa1-\xac\xae-įı-ȳ]*")


def plain_class(prop: str) -> str:
    """The members of a Unicode property among plain characters, as the inside of a class."""
    found = [c for c in map(chr, range(0x234)) if PLAIN.fullmatch(c) and regex.fullmatch(prop, c)]
    return "".join(map(re.escape, found))


def plain_pattern(pattern: str) -> re.Pattern:
    """The same pattern for ``re``, with properties spelled out; equal on plain texts, and faster."""
    inside = {name: plain_class(name) for name in (r"\p{L}", r"\p{N}")}

    def spelled(part: str, form: str) -> str:
        for name, members in inside.items():
            part = part.replace(name, form.format(members))
        return part

    # first the properties inside classes, then those that stand alone
    pattern = re.sub(r"\[[^\]]*\]", lambda m: spelled(m.group(), "{}"), pattern)
    pattern = spelled(pattern, "[{}]")
    return re.compile(pattern)


def byte_symbols() -> list[str]:
    """The printable stand-in of every byte in byte-level vocabularies (a public convention)."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    stand = {b: chr(b) for b in plain}
    for i, b in enumerate(b for b in range(256) if b not in stand):
        stand[b] = chr(256 + i)
    return [stand[b] for b in range(256)]


class WordCounter:
    """Tokens of a word, from the merge rules of a byte-level vocabulary with word ends."""

    def __init__(self, definition: str):
        from tokenizers import Tokenizer
        spec = json.loads(definition)
        vocab = spec["model"]["vocab"]
        self.library = Tokenizer.from_str(definition)
        symbols = byte_symbols()
        self.inner = [vocab[s] for s in symbols]
        self.last = [vocab[s + END] for s in symbols]
        self.rank_of, self.left, self.right, self.joined = {}, [], [], []
        for rank, rule in enumerate(spec["model"]["merges"]):
            left, right = rule if isinstance(rule, list) else rule.split(" ")
            self.rank_of[vocab[left] << BITS | vocab[right]] = rank
            self.left.append(vocab[left])
            self.right.append(vocab[right])
            self.joined.append(vocab[left + right])
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.word_pattern = plain_pattern(split)
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True))))
        self.memo = Memo(self.count_word, 1_000_000)

    def count_word(self, word: str) -> int:
        data = word.encode("utf-8")
        n = len(data)
        if n == 1:
            return 1
        # one node for each symbol and one behind the end that no rule joins
        node = [self.inner[b] for b in data]
        node[-1] = self.last[data[-1]]
        node.append(NOTHING)
        following = list(range(1, n + 2))
        before = list(range(-1, n))
        rank_of, pop, push = self.rank_of.get, heapq.heappop, heapq.heappush
        heap = []                              # rank * n + position
        for i in range(n - 1):
            rank = rank_of(node[i] << BITS | node[i + 1])
            if rank is not None:
                heap.append(rank * n + i)
        heapq.heapify(heap)
        merges = 0
        while heap:
            rank, i = divmod(pop(heap), n)
            j = following[i]
            if node[i] != self.left[rank] or node[j] != self.right[rank]:
                continue                       # one of the two has been merged since
            joined = node[i] = self.joined[rank]
            node[j] = NOTHING
            merges += 1
            after = following[i] = following[j]
            before[after] = i
            rank = rank_of(joined << BITS | node[after])
            if rank is not None:
                push(heap, rank * n + i)
            first = before[i]
            if first >= 0:
                rank = rank_of(node[first] << BITS | joined)
                if rank is not None:
                    push(heap, rank * n + first)
        return n - merges

    def words(self, text: str) -> list[str]:
        if PLAIN.fullmatch(text):
            return self.word_pattern.findall(text.lower())
        normal = self.library.normalizer.normalize_str(text)
        return [unbyte(w) for w, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        total, parts = 0, [text]
        if "<|" in text:
            parts = self.special.split(text)
            total = len(parts) - 1
        get = self.memo.__getitem__
        for part in parts:
            for piece in whole_chunks(part):
                total += sum(map(get, self.words(piece)))
        return total


_FROM_SYMBOL = {s: b for b, s in enumerate(byte_symbols())}


def unbyte(word: str) -> str:
    return bytes(_FROM_SYMBOL[c] for c in word).decode("utf-8")


FIELDS = T.StructType([T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()),
                       T.StructField("over_limit", T.BooleanType())])


def count_tokens(df: DataFrame, vocab_path: str, limit: int = 2048, text: str = "text",
                 keep: list[str] | None = None) -> tuple[DataFrame, str]:
    """Append a struct (n_bytes, n_tokens, over_limit); returns the frame and the struct's name.

    The vocabulary file (its size is fixed, about 2 MB) is read once on the
    driver and broadcast, so executors need no copy of it.
    """
    with open(vocab_path, encoding="utf-8") as f:
        vocabulary = f.read()
    definition = broadcast_value(df.sparkSession, vocabulary)
    key = ("token_counts", content_key(vocabulary))

    def per_texts(texts):
        counter = worker_cached(key, lambda: WordCounter(definition.value))
        n = [counter.count(t) for t in texts]
        size = [len(t.encode("utf-8")) if t else 0 for t in texts]
        return [size, n, [k > limit for k in n]]

    return append_struct(df, text, FIELDS, per_texts, keep)


def token_counts(df: DataFrame, vocab_path: str, limit: int = 2048, id_col: str = "doc_id",
                 text: str = "text") -> DataFrame:
    out, name = count_tokens(df, vocab_path, limit, text, keep=[id_col])
    return out.select(id_col, F.col(f"{name}.*"))
