import hashlib
import random
import zlib

import corpus_pipeline
import public_tokenizers as P
import tiktoken
from pyspark.sql import functions as F

from llm.helpers import DOC_SCHEMA, docs
from tidyspark.llm import byte_bpe, decontaminate, langid

SF = "/root/testdata/sf0.01"


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    toxic = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 1").collect()}
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept[-1], SF)
        assert out.columns == docs.columns and out.schema == docs.schema
        kept.append(spark.createDataFrame(out.collect(), docs.schema))
    ids = [{r.doc_id for r in k.select("doc_id").collect()} for k in kept]
    assert all(b <= a for a, b in zip(ids, ids[1:]))
    assert len(ids[1] & toxic) <= 0.25 * len(toxic) and ids[2] == ids[1]
    items = [decontaminate.compared(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for r in kept[4].collect():
        assert not any(i in decontaminate.compared(r.text) for i in items)
    clean = {r.doc_id for r in kept[3].collect() if not any(i in decontaminate.compared(r.text) for i in items)}
    assert clean == ids[4]
    texts = [r.text for r in kept[3].collect()]
    assert len(texts) == len(set(texts))


def test_run_equals_the_library(spark):
    out = corpus_pipeline.run(spark, SF).collect()
    tokens = byte_bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    encoding = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)},
                                 special_tokens={})
    texts = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    for r in out:
        ids = encoding.encode_ordinary(texts[r.doc_id])
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.n_tokens == len(ids) and r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_awkward_rows_pass_every_stage(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "the house and the water", "en", None, None),
            (3, "the house and the water", "en", "s", 1), (3, "the house and the water", "en", "s", 1),
            (4, "la maison et le jardin " * 20_000, "fr", "s", 2), (5, "12 34", "en", "s", 3)]
    for some in (rows, rows[:0]):
        docs = spark.createDataFrame(some, DOC_SCHEMA)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF)
            docs = spark.createDataFrame(docs.collect(), DOC_SCHEMA)
        last = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
        assert sorted((r.doc_id for r in last), key=str) == ([3, 4, None] if some else [])


def test_language_stage_rejects_random_letters_and_languages_not_learned(spark):
    import random
    rnd = random.Random(9)
    d = spark.read.parquet(f"{SF}/documents.parquet").where("lang <> 'es'")
    spanish = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").where("lang = 'es' AND n_chars > 800")
               .limit(20).collect()]
    odd = [(10_000_000 + i, t, None, "odd", len(t)) for i, t in enumerate(spanish)]
    odd += [(20_000_000 + i, " ".join("".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=rnd.randint(3, 9)))
                                      for _ in range(60)), None, "odd", 1) for i in range(20)]
    both = d.unionByName(spark.createDataFrame(odd, d.schema))
    kept = {r.doc_id for r in corpus_pipeline.keep_known_languages(spark, both, SF).select("doc_id").collect()}
    assert not {o[0] for o in odd} & kept
    assert {r.doc_id for r in d.select("doc_id").collect()} <= kept


def made_texts(syllables, n, seed, n_words=60):
    """Different texts whose words are two or three of the syllables."""
    rnd = random.Random(seed)
    return [" ".join("".join(rnd.choices(syllables, k=rnd.randint(2, 3))) for _ in range(n_words)) for _ in range(n)]


ENGLISH = "the and ing her tion ver ent with all our ness ter".split()
SPANISH = "ción que los ado con mente para del las una ero ito".split()


def made_noise(seed):
    rnd = random.Random(seed)
    return [(100_000 + i, " ".join("".join(rnd.choices("bcdfghjklmnpqrstvwxz", k=6)) for _ in range(40)), None)
            for i in range(10)]


def kept_ids(spark, rows):
    out = corpus_pipeline.keep_known_languages(spark, docs(spark, rows), SF)
    return sorted(r.doc_id for r in out.select("doc_id").collect())


def test_language_stage_learns_from_documents_of_every_checksum(spark):
    third = [[i for i in range(1000) if zlib.crc32(str(i).encode()) % 3 == k] for k in range(3)]
    rows = [(i, t, "en") for i, t in zip(third[0] + third[2], made_texts(ENGLISH, 80, 1))]
    rows += [(i, t, "es") for i, t in zip(third[1], made_texts(SPANISH, 40, 2))]
    assert kept_ids(spark, rows) == sorted(r[0] for r in rows)


def test_language_stage_checks_the_fit_beside_labels_of_texts_without_letters(spark):
    noise = made_noise(3)
    bare = [(2000 + i, f"{i} 12 34", "zxx") for i in range(9)]
    rows = [(i, t, "en") for i, t in enumerate(made_texts(ENGLISH, 80, 4))]
    assert kept_ids(spark, rows + noise + bare) == [r[0] for r in rows]
    assert kept_ids(spark, noise + bare) == []


def test_language_stage_learns_where_ids_repeat_and_texts_have_copies(spark):
    fraction = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1 << 30))
    last = spark.range(40).orderBy(fraction.desc()).first().id           # the id a sample by ids takes last
    rows = [(last, t, "en") for t in made_texts(ENGLISH, 4000, 5, 12)]
    spanish = made_texts(SPANISH, 60, 6)
    rows += [(100 + i, spanish[min(i, 59)], "es") for i in range(2000)]
    assert kept_ids(spark, rows + made_noise(8)) == sorted(r[0] for r in rows)


def test_a_language_never_predicted_has_a_usual_fit(spark):
    rows = [(i, t, lang) for i, t in enumerate(made_texts(ENGLISH, 30, 7)) for lang in ("en", "en-x")]
    d, everything = docs(spark, rows), F.lit(True)
    model = langid.train(d, everything, P.path("piece_bpe_32k.model"))
    usual = langid.usual_fit(d, everything, model)
    assert sorted(usual) == ["en", "en-x"] and abs(usual["en"] - usual["en-x"]) < 1e-9
