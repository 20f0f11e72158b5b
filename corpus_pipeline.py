"""The corpus pipeline: language ID, near-duplicates, repeated passages, benchmark
leaks, packing.

Each stage works on all that the stage before it kept, and all but the last return
the columns of documents, texts as changed so far.  Every stage's output is
written as Parquet to the shared folder and read again by the next one.

Defined cases: null or empty texts, texts without a letter, and texts in none of the
labelled languages go in the first stage (of texts of one word in a labelled language about a
fifth goes, of three words or more none: see the README); a null doc_id is kept by all other
stages, as nothing can be held against a row without identity; repeated rows count as copies,
of which one stays; one doc_id with several texts is as many documents; additional columns are carried along.  An empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noisyframe.llm import decontaminate, language_id, near_dedup, packing, substring_dedup
from noisyframe.llm.common import free_name
from noisyframe.session import cut_lineage

ORACLE_SQL = None
# Near copies have this similarity of word shingles, in hundredths (op2's query: 85).
NEAR = 80


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in which a language was found.

    Learned from the documents' own labels.  A document goes if the n-grams that it
    shares with any language are no more than false positives explain, or if it has no
    letter.  A mixed text has a low score by nature, so the score is no ground to drop
    a document.  Without a label to learn from, every text with a letter stays.
    """
    model = language_id.fit(docs.select("doc_id", "text", "lang"))
    return language_id.in_a_language(docs, model)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates, the one of the smallest doc_id.

    Documents are told apart by doc_id and text: of two texts of one doc_id only the one
    that has a copy goes.  Rows with a null doc_id stay, repeated ones too.
    """
    same = free_name(docs, "same")
    gone = near_dedup.groups(docs, link=NEAR).where(~F.col("kept")).select("doc_id", F.col("text_hash").alias(same)).distinct()
    marked = docs.withColumn(same, F.xxhash64("text"))
    left = marked.join(gone, ["doc_id", same], "left_anti")
    known = left.where("doc_id is not null").dropDuplicates(["doc_id", same])
    return known.unionByName(left.where("doc_id is null")).select(*docs.columns)


def substring_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes passages that an earlier document has; a document with nothing left goes."""
    new = substring_dedup.added(docs)[0]
    left = substring_dedup.deduplicated(docs)
    changed = left.select(*[F.col(new).alias(c) if c == "text" else F.col(c) for c in docs.columns])
    return _counted(changed.where(F.col("text").rlike(r"[^ \t-\r]")), docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes spans of benchmark items, and documents that consist of such spans."""
    return _counted(decontaminate.cleaned(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")), docs)


def _counted(changed: DataFrame, docs: DataFrame) -> DataFrame:
    """n_chars, where docs has it, in line with the changed text."""
    if "n_chars" not in docs.columns:
        return changed
    kind = docs.schema["n_chars"].dataType
    return changed.withColumn("n_chars", F.char_length("text").cast(kind)).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Placements of the kept documents in sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", language_stage),
    ("near_dedup", near_dedup_stage),
    ("substring_dedup", substring_dedup_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
