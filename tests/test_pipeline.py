"""End-to-end checks on the driver tables at sf0.001."""
import math

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from noisyframe.plans.label_errors import label_errors, lineitem_psx
from noisyframe.sources.tables import TABLES

from .conftest import SF_SMALL

ORACLE_SUBSET = ["label_errors_lineitem", "calibrated_joint", "prune_by_count", "cat_count",
                 "cat_running_count", "cat_time_gap", "block_encode", "quantile_bins",
                 "capped_sample", "class_balanced", "inject_noise", "noise_matrix"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", ORACLE_SUBSET)
def test_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, df.collect()) == _rows(dcols, cur.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["row_id", "label", "score", "pos"]
    assert df.count() > 0


def test_every_query_has_callable():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 85


def test_recovery_of_planted_flips(spark):
    """Label errors recover the flipped rows of F2 (every fifth row)."""
    res = label_errors(lineitem_psx(spark, SF_SMALL))
    marked = res.marked.select("row_id", "is_error", (F.col("label") != F.col("y_true")).alias("flip"))
    r = marked.agg(F.sum(F.when(F.col("is_error") & F.col("flip"), 1).otherwise(0)).alias("tp"),
                   F.sum(F.col("is_error").cast("int")).alias("marked"),
                   F.sum(F.col("flip").cast("int")).alias("flips")).first()
    precision, recall = r.tp / r.marked, r.tp / r.flips
    assert precision > 0.9 and recall > 0.85
