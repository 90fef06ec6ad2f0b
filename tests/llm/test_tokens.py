import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from llm.helpers import by_id, docs, with_clashes
from tidyspark.llm import byte_bpe, token_counts

VOCAB, RANKS = P.path("word_bpe_49k.json"), P.path("byte_bpe_multi_50k.tiktoken")
AWKWARD = ["", "   ", "\n\n x\t", "it's we'll 'sabc ''s", "<|endoftext|>x<|startoftext|>", "ΑΣ Ω ς İstanbul ŉ ǅ",
           "é ́e ﬁ", "日本語 12३ ½²", "a" * 4000, "😀👍🏽 x\x1cy\x85z\xa0\xad", "a  b   c ", " x　y",
           "The cat\r\nsat", "naïve café ÆØÅ ß ẞ"]


def random_texts(n):
    r = random.Random(7)
    alphabets = ["abc 'ts", "aeé \nñ.,", "".join(map(chr, range(32, 600))), "日本 かな😀x"]
    return ["".join(r.choice(a) for _ in range(r.randrange(60))) for _ in range(n) for a in alphabets]


@pytest.fixture(scope="module")
def tiktoken_encoding():
    tokens = byte_bpe.read_ranks(RANKS)
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)},
                             special_tokens={})


def test_word_counts_equal_the_library():
    counter = token_counts.WordCounter(open(VOCAB, encoding="utf-8").read())
    library = Tokenizer.from_file(VOCAB)
    texts = AWKWARD + random_texts(100)
    assert [counter.count(t) for t in texts] == [
        len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_token_counts_cases(spark):
    rows = [(1, "one two", "en"), (1, "one two", "en"), (2, None, None), (3, "", "en"), (None, "x", "en"),
            (4, "word " * 3000, "en")]
    out = token_counts.token_counts(with_clashes(docs(spark, rows)), VOCAB).collect()
    assert len(out) == 6 and out[0].asDict().keys() == {"doc_id", "n_bytes", "n_tokens", "over_limit"}
    got = {r.doc_id: r for r in out}
    assert (got[2].n_bytes, got[2].n_tokens, got[3].n_tokens) == (0, 0, 0)
    assert got[4].n_tokens == 3000 and got[4].over_limit and not got[1].over_limit
    assert token_counts.token_counts(docs(spark, []), VOCAB).count() == 0


def test_encoding_equals_the_library(tiktoken_encoding):
    tokens = byte_bpe.read_ranks(RANKS)
    encoder = byte_bpe.PrefixEncoder(tokens, byte_bpe.Merges(tokens).parts, P.PATTERN)
    for t in AWKWARD + random_texts(100):
        assert encoder.encode(t) == tiktoken_encoding.encode_ordinary(t), t


def test_edits_re_encode_only_nearby(tiktoken_encoding):
    tokens = byte_bpe.read_ranks(RANKS)
    encoder = byte_bpe.PrefixEncoder(tokens, byte_bpe.Merges(tokens).parts, P.PATTERN)
    r, alphabet = random.Random(5), "ab ct'sé \n日"
    for _ in range(150):
        s = "".join(r.choice(alphabet) for _ in range(r.randrange(40)))
        edited = byte_bpe.EditableEncoding(encoder, s)
        for _ in range(4):
            i = r.randrange(len(s) + 1)
            j, new = min(len(s), i + r.randrange(3)), "".join(r.choice(alphabet) for _ in range(r.randrange(4)))
            s = s[:i] + new + s[j:]
            edited.replace(i, j, new)
            assert edited.ids() == tiktoken_encoding.encode_ordinary(s)
    long = byte_bpe.EditableEncoding(encoder, "zyxwvut " * 2000)
    long.bytes_done = 0
    long.replace(8000, 8001, "qq")
    long.append("rstuvw")
    assert long.bytes_done < 60 and long.ids() == tiktoken_encoding.encode_ordinary(long.text)


def test_round_trip_cases(spark, tiktoken_encoding):
    rows = [(i, t, "en") for i, t in enumerate([*AWKWARD, None])] + [(0, "", "en")]
    df = with_clashes(docs(spark, rows))
    out = byte_bpe.round_trip_digests(df, RANKS, P.PATTERN, ["doc_id"]).collect()
    assert len(out) == len(rows)
    got = {r.doc_id: r for r in out}
    for i, t in enumerate([*AWKWARD, None]):
        ids = tiktoken_encoding.encode_ordinary(t or "")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    assert byte_bpe.round_trip_digests(docs(spark, []), RANKS, P.PATTERN, ["doc_id"]).count() == 0
    encoded, name = byte_bpe.encode(df, RANKS, P.PATTERN)
    assert encoded.columns[:-1] == df.columns
    assert by_id(encoded)[3][name]["ids"] == tiktoken_encoding.encode_ordinary(AWKWARD[3])
