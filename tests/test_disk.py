"""What written stages and shuffles leave on disk."""
import os
import time

import pytest
from pyspark.sql import functions as F

from noisyframe import session as S
from noisyframe.plans import automl as AM
from noisyframe.session import Scratch, cut_lineage


def shuffle_files(spark) -> set:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle")}


def on_disk(since: int) -> int:
    return sum(os.path.isdir(path.removeprefix("file:")) for _, path in S._STAGES[since:])


def test_a_written_stage_leaves_no_shuffle(spark):
    before, setting = shuffle_files(spark), spark.conf.get(S.SHUFFLE_CLEANUP, "false")
    out = cut_lineage(spark.range(50000).repartition(6, "id").groupBy((F.col("id") % 999).alias("k")).count())
    end = time.time() + 20      # they are deleted in the background
    while shuffle_files(spark) - before and time.time() < end:
        time.sleep(0.2)
    assert shuffle_files(spark) - before == set() and out.count() == 999
    assert spark.conf.get(S.SHUFFLE_CLEANUP, "false") == setting


def test_scratch_deletes_what_no_kept_frame_reads(spark):
    since = len(S._STAGES)
    with Scratch() as outer:
        with Scratch() as inner:
            a = cut_lineage(spark.range(10))
            b = cut_lineage(a.withColumn("x", F.col("id") * 2))
            c = cut_lineage(a.select("id"))
            both = b.join(c, "id")
            inner.keep(both)
        assert on_disk(since) == 2 and both.count() == 10
        d = cut_lineage(both)
        outer.keep(d)
    assert on_disk(since) == 1 and d.agg(F.sum("x")).first()[0] == 90
    since = len(S._STAGES)
    with pytest.raises(ZeroDivisionError), Scratch():
        cut_lineage(spark.range(3))
        raise ZeroDivisionError
    assert on_disk(since) == 1


@pytest.mark.parametrize("refit", [True, False])
def test_the_feature_engine_keeps_only_what_is_read(spark, refit):
    i = F.col("id")
    rows = cut_lineage(spark.range(900).select(
        i.alias("row_id"), (i % 7).cast("string").alias("c_1"), (i % 300).cast("string").alias("c_2"), (i % 5).cast("double").alias("n_1"),
        F.timestamp_seconds(i * 1000).alias("t_1"), (i % 2).cast("int").alias("label")))
    since = len(S._STAGES)
    engine = AM.FeatureEngine("noisy", select=False, clean=False, combine_cats=["c_1", "c_2"], combine_nums=["n_1"], refit=refit)
    out = engine.fit_transform(rows)
    # the rows, what the gaps are joined from, the dictionary, and the lookups of the fit
    assert on_disk(since) <= 6 + len(engine.lookups) and rows.count() == 900
    assert {r["count"] for r in out.groupBy("row_id").count().collect()} == {1} and out.count() == 900
    again = engine.transform(rows)
    assert again.count() == 900 and set(again.columns) == set(out.columns)
    same = out.select(*again.columns)
    assert same.exceptAll(again).count() == 0 and again.exceptAll(same).count() == 0
