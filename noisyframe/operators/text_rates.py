"""Class probabilities of texts from token counts.

A provider of out-of-fold ``psx``: each class keeps its tokens' counts over the other folds,
and a text's log score of a class is the log share of the class plus the log rates of its
tokens, ``(n + 1) / (N + V)``, with V tokens in all.  Tokens are the runs of non-blank
characters after A-Z became a-z.

Plan: one row per (text, token) with its count, written out, so that texts are read for their
tokens once; class counts per (token, fold) by one aggregation, those of the other folds by a
window over a token's few folds; one equi-join back and one aggregation by text.  Classes and
folds are bounded, tokens are not: their rates are counted, and broadcast if they are few.

Defined cases: a null or blank text has the class shares as probabilities.  Rows without a
label learn nothing but are scored (they need a fold).  Probabilities are rounded to
``digits`` places, as sums of logarithms depend on their order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranking import settled
from ..session import cut_lineage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOKEN = r"([^\x09-\x0D\x20]+)"
DIGITS = 9


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(TOKEN))


def token_rate_psx(df: DataFrame, num_classes: int = 2, text: str = "text", label: str = "label",
                   fold: str = "fold", row_id: str = "row_id", digits: int = DIGITS) -> DataFrame:
    """df with ``psx``, from the rows of the other folds."""
    K, ks = num_classes, range(num_classes)
    said = cut_lineage(df.select(row_id, fold, label, F.explode(tokens(F.col(text))).alias("_token")).groupBy(
        row_id, fold, label, "_token").agg(F.count("*").alias("_n")))
    per_fold = cut_lineage(said.groupBy("_token", fold).agg(
        *[F.sum(F.when(F.col(label) == k, F.col("_n")).otherwise(0)).alias(f"_f{k}") for k in ks]))
    of_token = Window.partitionBy("_token")
    rates = settled(per_fold.select(
        F.col("_token"), F.col(fold), *[(F.sum(f"_f{k}").over(of_token) - F.col(f"_f{k}")).alias(f"_o{k}") for k in ks]))
    # rows of folds x classes, and the number of tokens
    sizes = per_fold.groupBy(fold).agg(*[F.sum(f"_f{k}").alias(f"_f{k}") for k in ks])
    shares = df.groupBy(fold).agg(*[F.count_if(F.col(label) == k).alias(f"_c{k}") for k in ks])
    size = per_fold.select("_token").distinct().count()
    totals = {r[fold]: r for r in shares.join(sizes, fold, "left").na.fill(0).collect()}

    def other(name: str) -> Column:
        """The sum of a column over the other folds, by the fold of the row."""
        whole = sum(r[name] for r in totals.values())
        out = F.lit(None).cast("double")
        for f, r in totals.items():
            out = F.when(F.col(fold) == f, F.lit(float(whole - r[name]))).otherwise(out)
        return out

    logs = [F.sum(F.col("_n") * (F.log(F.col(f"_o{k}") + F.lit(1.0)) - F.log(other(f"_f{k}") + F.lit(float(size))))).alias(f"_s{k}")
            for k in ks]
    scored = said.join(rates, ["_token", fold]).groupBy(row_id).agg(*logs)
    labelled = sum((other(f"_c{k}") for k in ks), F.lit(0.0))
    out = df.join(scored, row_id, "left")
    score = [F.coalesce(f"_s{k}", F.lit(0.0)) + F.log((other(f"_c{k}") + F.lit(1.0)) / (labelled + F.lit(float(K)))) for k in ks]
    out = out.withColumns({f"_s{k}": s for k, s in zip(ks, score, strict=True)})
    top = F.greatest(*[F.col(f"_s{k}") for k in ks]) if K > 1 else F.col("_s0")
    parts = [F.exp(F.col(f"_s{k}") - top) for k in ks]
    total = sum(parts, F.lit(0.0))
    return out.withColumn("psx", F.array(*[F.round(p / total, digits) for p in parts])).drop(*(f"_s{k}" for k in ks))
