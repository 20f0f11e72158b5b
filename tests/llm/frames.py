"""Small frames with nulls, empty and long texts, repeated rows and clashing columns."""
from pyspark.sql import types as T

DOCS = T.StructType().add("doc_id", "long").add("text", "string").add("lang", "string").add(
    "source", "string").add("n_chars", "long").add("score", "string").add("copy", "long").add("row", "string")


def docs(spark, texts, **columns):
    """One row per (doc_id, text), with columns that clash with the operators' own names."""
    rows = [(i, t, columns.get("lang", "en"), columns.get("source", "s"), len(t or ""), "x", 7, "y") for i, t in texts]
    return spark.createDataFrame(rows, DOCS)


def words(seed, n, vocabulary=4000):
    """A repeatable text of n invented words."""
    out, x = [], seed * 7919 + 17
    for _ in range(n):
        x = (x * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        out.append("w" + format((x >> 33) % vocabulary, "x"))
    return " ".join(out)
