"""Steps that read rows once: sample cuts from one pass, label errors from counts per (label, psx)."""

import pytest
from pyspark.sql import functions as F

from noisyframe.functions import ranking as RK
from noisyframe.functions.keys import seeded_key
from noisyframe.operators import labels as L
from noisyframe.operators import learn as LN
from noisyframe.operators import pruning as P
from noisyframe.operators import sampling as SM
from noisyframe.operators import text_rates as T
from noisyframe.operators.rates import RateClassifier


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(6000).select(
        F.col("id").alias("row_id"), (F.col("id") % 3).cast("string").alias("c_1"),
        F.when(F.col("id") % 7 == 0, 1 - (F.col("id") % 3 == 0).cast("int")).otherwise(
            (F.col("id") % 3 == 0).cast("int")).alias("label"), F.col("id").cast("double").alias("n_1")).localCheckpoint()


def _smallest(df, n: int, seed: int, purpose: str) -> list:
    keyed = df.where("row_id is not null").select("row_id", seeded_key("row_id", seed, purpose).alias("k")).collect()
    return sorted(r["row_id"] for r in sorted(keyed, key=lambda r: (r["k"], r["row_id"]))[:n])


def _passes(monkeypatch) -> list:
    """Calls of the search by rounds that a cut falls back to."""
    calls, old = [], SM.kth_smallest
    monkeypatch.setattr(SM, "kth_smallest", lambda *a, **k: calls.append(a) or old(*a, **k))
    return calls


def test_a_cut_of_known_size_takes_one_pass(spark, rows, monkeypatch):
    calls = _passes(monkeypatch)
    drawn = SM.frac_sample(rows, 0.75, 4)
    assert sorted(r["row_id"] for r in drawn.collect()) == _smallest(rows, 4500, 4, "sample")
    held = SM.holdout_split(rows, 0.3, 2).where("split = 'test'")
    assert sorted(r["row_id"] for r in held.collect()) == _smallest(rows, 1800, 2, "split")
    assert not calls and "Generate" not in drawn._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("case", ["null ids", "one id"])
def test_uneven_keys_get_the_same_rows_as_before(spark, rows, case):
    if case == "null ids":
        df = rows.withColumn("row_id", F.when(F.col("row_id") % 2 == 0, F.col("row_id")))
        assert sorted(r["row_id"] for r in SM.frac_sample(df, 0.25, 1).collect()) == _smallest(df, 1500, 1, "sample")
    else:
        df = rows.withColumn("row_id", F.lit(5).cast("bigint"))
        assert SM.frac_sample(df, 0.25, 1).count() == 6000        # copies of an id go together


def test_errors_from_counts_are_those_from_rows(spark, rows):
    psx, counts = LN.oof_counted(rows, ["n_1"], lambda: RateClassifier(catCol="c_1"), 5, 0)
    assert counts.count() <= 3 * 5 * 2 and counts.agg(F.sum(L.ROWS)).first()[0] == 6000
    assert L.per_class_thresholds(counts, 2, weight=L.ROWS) == L.per_class_thresholds(psx, 2)
    for find in (lambda **k: P.find_label_errors(psx, **k), lambda **k: P.baseline_confusion(psx, calibrate=True, **k),
                 lambda **k: P.find_label_errors(psx, budget="own", **k)):
        want = {r["row_id"]: r["is_error"] for r in find().collect()}
        assert {r["row_id"]: r["is_error"] for r in find(counts=counts).collect()} == want and any(want.values())


def test_written_folds_are_the_folds(spark, rows):
    df = rows.unionByName(rows.where("row_id < 3").withColumn("row_id", F.lit(None).cast("bigint")))
    plain, written = (sorted((r["row_id"] or -1, r["label"], r["fold"]) for r in L.stratified_folds(df, 5, 3, write=w).collect())
                      for w in (False, True))
    assert plain == written and set(L.stratified_folds(df, 5, 3, write=True).columns) == {*df.columns, "fold"}


def test_repeated_ids_are_found_in_words(spark):
    ids = spark.createDataFrame([(-65,), (-1,), (0,), (63,), (64,), (2 ** 62,), (None,), (None,)], "row_id bigint")
    assert not RK.ids_repeat(ids)
    assert RK.ids_repeat(ids.unionByName(spark.createDataFrame([(-1,)], "row_id bigint")))
    assert RK.ids_repeat(spark.createDataFrame([("a",), ("a",)], "row_id string"))


def test_texts_are_read_for_their_tokens_once(spark, monkeypatch):
    written, old = [], T.cut_lineage
    monkeypatch.setattr(T, "cut_lineage", lambda df: written.append(df.columns) or old(df))
    df = spark.createDataFrame([(1, 0, 0, "a b a"), (2, 1, 1, "b c"), (3, 0, 1, None), (4, 1, 0, "A")],
                               "row_id bigint, fold int, label int, text string")
    out = T.token_rate_psx(df)
    assert "_token" in written[0] and "regexp_extract_all" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert [sum(r["psx"]) for r in out.collect()] == pytest.approx([1.0] * 4)
