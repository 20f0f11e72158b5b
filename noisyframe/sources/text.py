"""Label-prefixed text (S4, S5) and the class label map.

Records look like ``__label__X first line`` and may continue over several
lines; a record ends where the next ``__label__`` line starts.  Reading splits
the file on the record separator with Spark's text source, so records are
spread over tasks by file split like any text file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.ranking import MAX_GROUPS
from ..session import cut_lineage

# Fixed values of the labelled-text format.
LABEL_TOKEN = "__label__"
NEWLINE_TOKEN = " __newline__ "
_TO_ESCAPE = r"\n(\\*)" + LABEL_TOKEN
_ESCAPED = r"\n\\(\\*)" + LABEL_TOKEN


def read_labelled_text(spark: SparkSession, path: str, ids: DataFrame | None = None,
                       with_ids: bool = False) -> DataFrame:
    """``(label, text)`` per record; body lines joined by `` __newline__ ``.

    ``with_ids`` adds ``file`` (its name) and ``record`` (its place in the file, from 0), which
    don't depend on how files are split over tasks.  ``ids`` (file, record) reads only
    those records.
    """
    raw = spark.read.option("lineSep", "\n" + LABEL_TOKEN).text(path)
    if with_ids or ids is not None:
        raw = _numbered(raw)
    if ids is not None:
        raw = raw.join(ids.select("file", "record"), ["file", "record"], "left_semi")
    # the first record of each file keeps its leading token
    body = F.regexp_replace(F.col("value"), "^" + LABEL_TOKEN, "")
    body = F.regexp_replace(body, "\n+$", "")
    parts = F.split(body, " ", 2)
    text = F.regexp_replace(F.coalesce(F.element_at(parts, 2), F.lit("")), _ESCAPED, "\n$1" + LABEL_TOKEN)
    text = F.regexp_replace(F.trim(text), "\n", NEWLINE_TOKEN)
    own = [c for c in ("file", "record") if with_ids]
    return (raw.where(F.length(F.trim(F.col("value"))) > 0)
            .select(*own, F.element_at(parts, 1).alias("label"), text.alias("text")))


def _numbered(raw: DataFrame) -> DataFrame:
    """Records with file and record: places in a split, plus the records of the file's splits before it."""
    at = raw.select("value", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("_start"),
                    F.monotonically_increasing_id().alias("_at"))
    placed = cut_lineage(at)
    splits = placed.groupBy("file", "_start").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    earlier = Window.partitionBy("file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    before = splits.select("file", "_start", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return placed.join(before, ["file", "_start"]).select(
        "value", "file", (F.col("_at") - F.col("_first") + F.col("_before")).alias("record"))


def write_labelled_text(df: DataFrame, path: str, label: str = "label", text: str = "text",
                        ids: DataFrame | None = None, id_col: str = "doc_id") -> None:
    """Write records (optionally only those whose id is in ``ids``: semi join).

    A body line that starts with the label token would begin a record: it gets a
    backslash in front, as does one that starts with backslashes before the token.
    """
    if ids is not None:
        df = df.join(ids, id_col, "left_semi")
    body = F.regexp_replace(F.regexp_replace(F.col(text), "\r", ""), _TO_ESCAPE, "\n\\\\$1" + LABEL_TOKEN)
    line = F.concat(F.lit(LABEL_TOKEN), F.col(label).cast("string"), F.lit(" "), body)
    df.select(line.alias("value")).write.mode("overwrite").text(path)


def label_index(train: DataFrame, test: DataFrame, label: str = "label") -> DataFrame:
    """Class label -> integer over train and test labels, in sorted order.

    The labels are classes, ``MAX_GROUPS`` at most (else it raises), so that the final
    numbering window is tiny.
    """
    labels = cut_lineage(train.select(label).union(test.select(label)).distinct())
    if labels.limit(MAX_GROUPS + 1).count() > MAX_GROUPS:
        raise ValueError(f"more than {MAX_GROUPS} labels in {label}")
    return labels.select(label, (F.row_number().over(Window.orderBy(label)) - 1).cast("int").alias("code"))
