"""Rows that every operator must take: nulls, empty and very long texts, ties, repeats, clashing extra columns."""

from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def odd_documents(spark, texts):
    """The texts with ids from 0, a repeated row, a null id, a null text, an empty one, blanks and a long one."""
    rows = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in enumerate(texts)]
    n = len(rows)
    rows += [rows[0], (None, "only here without an id at all", "en", None, None), (n, None, None, None, None),
             (n + 1, "", "fr", "src1", 0), (n + 2, " \t\n ", "de", "src1", 4), (n + 3, "long words again " * 20_000, "en", "src0", 1)]
    return spark.createDataFrame(rows, SCHEMA)


def clashing(docs, *names):
    """Extra columns that are called like results or differ from inputs in case only."""
    out = docs.select("*", *(F.lit("other").alias(n) for n in names))
    return out.toDF(*out.columns)


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
