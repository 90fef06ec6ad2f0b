"""Small awkward tables for the training-data operators."""

from pyspark.sql import functions as F

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# columns named like results or inner columns of the operators
CLASHING = ["score", "predicted", "llm_out", "llm_text", "node", "id", "rep", "bands", "words", "entry",
            "lang_pred", "n_tokens", "ids", "rank", "class_id", "items", "dir", "file", "licence", "label_id"]


def docs(spark, rows):
    return spark.createDataFrame([(i, t, la, "s", None) for i, t, la in rows], DOC_SCHEMA)


def with_clashes(df):
    for c in CLASHING:
        if c not in df.columns:
            df = df.withColumn(c, F.lit("x"))
    return df


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}
