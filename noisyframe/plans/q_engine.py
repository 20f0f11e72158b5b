"""Queries of the feature engine whose columns SQL recomputes (M13, P8, P9), with the selection given."""

from __future__ import annotations

import itertools

from pyspark.sql import functions as F

from ..functions.keys import r6
from ..operators import features as FE
from ..session import Scratch, cut_lineage
from ..sources.tables import noisy_lineitem, ssl_events
from . import automl as AM
from . import sqlparts as S
from .catalog import register
from .q_features import blocks_sql, pairs_sql

PARTS = {"year": "year(t_1)", "month": "month(t_1)", "day": "day(t_1)", "hour": "hour(t_1)", "weekday": "isodow(t_1) - 1"}


def engine_sql(fit: str, rows: str, cats: list, pair_cats: list, nums: list, means: list, refit: bool) -> str:
    """The engine's columns for rows, fitted on fit; without refit counts and means are those of fit."""
    by = "r" if refit else "fit"
    code = ", ".join(f"""(SELECT CAST(code AS INT) FROM d JOIN b USING (block) WHERE b.col = {c!r} AND d.value = CAST(r.{c} AS STRING)) AS code_{c}"""
                     for c in cats)
    counts = ", ".join(f"l_{c}.n AS cnt_{c}" for c in cats)
    joins = " ".join(f"LEFT JOIN (SELECT {c}, COUNT(*) AS n{''.join(f', AVG({n}) AS m_{n}' for n in means)} FROM {by} GROUP BY {c}) l_{c} ON l_{c}.{c} = r.{c}" for c in cats)
    runs = ", ".join(f"ROW_NUMBER() OVER (PARTITION BY r.{c} ORDER BY t_1 NULLS LAST, r.row_id) - 1 AS run_{c}" for c in cats)
    parts = ", ".join(f"CASE WHEN (SELECT COUNT(DISTINCT {x}) FROM fit) > 1 THEN CAST({x} AS INT) END AS part_{p}" for p, x in PARTS.items())
    couples = list(itertools.combinations(pair_cats, 2))
    pairs = "".join(f", p_{a}_{b}.n AS pair_{a}_{b}" for a, b in couples)
    joins += " " + " ".join(f"LEFT JOIN (SELECT {a}, {b}, COUNT(*) AS n FROM {by} GROUP BY {a}, {b}) p_{a}_{b} ON p_{a}_{b}.{a} = r.{a} AND p_{a}_{b}.{b} = r.{b}" for a, b in couples)
    mean = "".join(f", ROUND(l_{c}.m_{n} + 1e-9, 6) AS mean_{c}_{n}" for c in pair_cats for n in means)
    gaps = "".join(f", ROUND((epoch_us(CAST(t_1 AS TIMESTAMP)) - epoch_us(CAST(LAG(t_1) OVER (PARTITION BY r.{c} ORDER BY t_1 NULLS LAST, r.row_id) AS TIMESTAMP))) / 1e6, 6) AS gap_{c}"
                   for c in pair_cats)
    return f"""WITH fit AS MATERIALIZED ({fit}), r AS MATERIALIZED ({rows}), b AS MATERIALIZED ({blocks_sql(cats, fit)}),
d0 AS MATERIALIZED (SELECT block, value, ROW_NUMBER() OVER (PARTITION BY block ORDER BY value) - 1 AS code
  FROM (SELECT DISTINCT block, value FROM ({pairs_sql('SELECT * FROM fit', cats)}) p JOIN b USING (col)) v),
nv AS (SELECT DISTINCT block, value FROM ({pairs_sql('SELECT * FROM r', cats)}) p JOIN b USING (col)
       WHERE NOT EXISTS (SELECT 1 FROM d0 WHERE d0.block = b.block AND d0.value = p.value)),
d1 AS (SELECT block, value, COALESCE(n, 0) + ROW_NUMBER() OVER (PARTITION BY block ORDER BY value) - 1 AS code
       FROM nv LEFT JOIN (SELECT block, COUNT(*) AS n FROM d0 GROUP BY block) s USING (block)),
d AS MATERIALIZED (SELECT * FROM d0 UNION ALL SELECT * FROM d1)
SELECT r.row_id, {code}, {', '.join(f'r.{n}' for n in nums)}, {counts}, {runs}, {parts}{pairs}{mean}{gaps} FROM r {joins}"""


def named(out, cats: list, pair_cats: list, nums: list, means: list):
    """The engine's columns under plain names."""
    def col(prefix, cls, feat):
        return F.col(f"`{FE.feat_name(prefix, cls, feat)}`")

    parts = [(col("c_", "KeyTimeDate", f"t_1:{p}").cast("int") if FE.feat_name("c_", "KeyTimeDate", f"t_1:{p}") in out.columns
              else F.lit(None).cast("int")).alias(f"part_{p}") for p in PARTS]
    return out.select(
        "row_id", *[F.col(c).alias(f"code_{c}") for c in cats], *nums, *[col("n_", "CatCnt", c).alias(f"cnt_{c}") for c in cats],
        *[col("n_", "CatCumCnt", c).alias(f"run_{c}") for c in cats], *parts,
        *[col("n_", "CatCnt2LEVEL", f"{a}_{b}_cnt").alias(f"pair_{a}_{b}") for a, b in itertools.combinations(pair_cats, 2)],
        *[r6(col("n_", "NumMean2LEVEL", f"{c}_{n}_mean") + 1e-9).alias(f"mean_{c}_{n}") for c in pair_cats for n in means],
        *[r6(col("n_", "CatTimeDiff2LEVEL", f"{c}_t_1_diff:1")).alias(f"gap_{c}") for c in pair_cats])


NOISY = (["c_1", "c_2", "c_3", "c_4", "c_5"], ["c_1", "c_3", "c_4"], ["n_1", "n_2", "n_3", "n_4"], ["n_1", "n_3"])
SSL = (["c_1", "c_2"], ["c_1", "c_2"], ["n_1"], ["n_1"])
HALF = "row_id % 3 <> 0"        # the rows of F3 that the engine is fitted on


def _engine(task: str, frame: tuple, **options) -> AM.FeatureEngine:
    return AM.FeatureEngine(task, select=False, clean=False, combine_cats=frame[1], combine_nums=frame[3], **options)


@register("engine_noisy", engine_sql(S.F2, "SELECT * FROM fit", *NOISY, True))
def engine_noisy(spark, sf_dir):
    """All columns of a noisy frame, by the fit."""
    with Scratch() as s:
        d = cut_lineage(noisy_lineitem(spark, sf_dir).drop("y_true"))
        s.keep(d)
    return named(_engine("noisy", NOISY).fit_transform(d), *NOISY)


def _ssl(spark, sf_dir, refit):
    d = cut_lineage(ssl_events(spark, sf_dir))
    engine = _engine("ssl", SSL, refit=refit)
    engine.fit_transform(d.where(HALF))
    return named(engine.transform(d.where(f"NOT ({HALF})")), *SSL)


_SSL_ROWS = (f"SELECT * FROM ({S.F3}) a WHERE {HALF}", f"SELECT * FROM ({S.F3}) a WHERE NOT ({HALF})")


@register("engine_ssl_refit", engine_sql(*_SSL_ROWS, *SSL, True))
def engine_ssl_refit(spark, sf_dir):
    """Rows the fit has not seen, counts and means of these rows."""
    return _ssl(spark, sf_dir, True)


@register("engine_ssl_saved", engine_sql(*_SSL_ROWS, *SSL, False))
def engine_ssl_saved(spark, sf_dir):
    """Rows the fit has not seen, counts and means of the fit."""
    return _ssl(spark, sf_dir, False)
