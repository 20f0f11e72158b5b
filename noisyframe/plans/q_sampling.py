"""Queries of the sampling operators."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions.keys import key_sql
from ..operators import sampling as SM
from ..sources.tables import noisy_lineitem, pu_orders, ssl_events
from . import sqlparts as S
from .catalog import register

# Fixed parameters of the sampling queries (the reference's caps and seeds).
CAP_ROWS = 30000
BALANCE_ROWS = 20000
BALANCE_SEED = 2019
FRAC = 1.5


def smallest_sql(src: str, n_expr: str, seed: int, part: str | None = None, purpose: str = "sample") -> str:
    over = f"PARTITION BY {part} " if part else ""
    return f"""SELECT * FROM (SELECT *, ROW_NUMBER() OVER ({over}ORDER BY {key_sql('row_id', seed, purpose)}, row_id) AS _rn
FROM ({src}) s0) s1 WHERE _rn <= {n_expr}"""


@register("capped_sample", f"SELECT row_id FROM ({smallest_sql(S.F2, str(CAP_ROWS), 0)}) c")
def capped_sample(spark, sf_dir):
    return SM.take_smallest(noisy_lineitem(spark, sf_dir), CAP_ROWS, 0).select("row_id")


@register("frac_sample", f"""WITH e AS ({S.F3}),
x AS ({smallest_sql('SELECT * FROM e', f'(SELECT CAST(ROUND_EVEN(({FRAC} - FLOOR({FRAC})) * COUNT(*), 0) AS BIGINT) FROM e)', 1)})
SELECT row_id, CAST(c AS INT) AS copy FROM e, range(1, {int(math.floor(FRAC))} + 1) t(c)
UNION ALL SELECT row_id, {int(math.floor(FRAC)) + 1} FROM x""")
def frac_sample(spark, sf_dir):
    s = SM.frac_sample(ssl_events(spark, sf_dir), FRAC, 1)
    return s.select("row_id", F.col("copy").cast("int").alias("copy"))


def _plan_sql(src: str, cap: int | str) -> str:
    """T5 as a table of bands over (small, large), the class sizes in order of size.

    A band holds while large is at most ``upto`` times small, and gives the smaller class one
    part in ``parts`` of the cap, at most all of it; the first band that holds counts.
    """
    return f"""WITH sizes AS (SELECT label = 1 AS positive, COUNT(*) AS n FROM ({src}) a GROUP BY 1),
c AS (SELECT COALESCE(MAX(n) FILTER (positive), 0) AS p0, COALESCE(MAX(n) FILTER (NOT positive), 0) AS n0 FROM sizes),
k AS (SELECT p0, n0, CAST(LEAST(p0, n0) AS DOUBLE) AS small, CAST(GREATEST(p0, n0) AS DOUBLE) AS large,
        (SELECT ratio FROM (VALUES (8000, 3), (7000, 3), (6000, 4), (5000, 5), (4000, 6), (3000, 7), (2000, 8), (0, 9)) steps(least_size, ratio)
         WHERE GREATEST(LEAST(p0, n0), 1000) >= least_size ORDER BY least_size DESC LIMIT 1) AS ratio FROM c),
t AS (SELECT *, LEAST(small * (ratio + 1), {cap}) AS total FROM k),
bands AS (SELECT 1 AS band, 1.0 AS upto, 1.0 AS parts UNION ALL SELECT 2, {SM.MIN_NEG_POS_RATIO}, NULL
          UNION ALL SELECT 3, NULL, {SM.MIN_NEG_POS_RATIO} + 1 UNION ALL SELECT 4, CAST('Infinity' AS DOUBLE), NULL),
chosen AS (SELECT t.*, band, COALESCE(parts, ratio + 1) AS parts FROM t JOIN bands
           ON CASE band WHEN 1 THEN small + large <= total ELSE large <= COALESCE(upto, ratio) * small END
           ORDER BY band LIMIT 1),
few AS (SELECT *, CASE band WHEN 1 THEN small WHEN 2 THEN small / (small + large) * total ELSE LEAST(small, total / parts) END AS few FROM chosen),
both_ AS (SELECT *, LEAST(few * ratio, CASE band WHEN 1 THEN large WHEN 2 THEN large / (small + large) * total ELSE total - few END) AS many FROM few)
SELECT CAST(FLOOR(CASE WHEN p0 <= n0 THEN few ELSE many END) AS BIGINT) AS pos_num,
       CAST(FLOOR(CASE WHEN p0 <= n0 THEN many ELSE few END) AS BIGINT) AS neg_num,
       CAST(p0 AS BIGINT) AS npos, CAST(n0 AS BIGINT) AS nneg FROM both_"""


@register("balance_plan", _plan_sql(S.F2, BALANCE_ROWS))
def balance_plan(spark, sf_dir):
    npos, nneg = SM.class_counts_binary(noisy_lineitem(spark, sf_dir))
    pos_num, neg_num = SM.balance_plan(npos, nneg, BALANCE_ROWS)
    return spark.createDataFrame([(pos_num, neg_num, npos, nneg)],
                                 "pos_num bigint, neg_num bigint, npos bigint, nneg bigint")


def balanced_sql(src: str, cap: str, seed: int) -> str:
    """Rows of T6 without copies (the plan never repeats a class); ``cap`` may use p0, the positives."""
    return f"""WITH f AS (SELECT *, CASE WHEN label = 1 THEN 1 ELSE 0 END AS side FROM ({src}) a),
pl AS ({_plan_sql(src, cap)}),
sz AS (SELECT 1 AS side, ROUND_EVEN((pos_num / npos) * npos, 0) AS k FROM pl
       UNION ALL SELECT 0, ROUND_EVEN((neg_num / nneg) * nneg, 0) FROM pl),
r AS (SELECT f.*, ROW_NUMBER() OVER (PARTITION BY f.side ORDER BY {key_sql('row_id', seed)}, row_id) AS rn
      FROM f)
SELECT r.* FROM r JOIN sz USING (side) WHERE rn <= k"""


@register("class_balanced", f"""SELECT row_id, label, 1 AS copy
FROM ({balanced_sql(S.F2, str(BALANCE_ROWS), BALANCE_SEED)}) b""")
def class_balanced(spark, sf_dir):
    s = SM.class_balanced(noisy_lineitem(spark, sf_dir), BALANCE_ROWS, BALANCE_SEED)
    return s.select("row_id", "label", F.col("copy").cast("int").alias("copy"))


def ssl_sql(seed: int) -> str:
    return f"""WITH e AS (SELECT * REPLACE (CASE WHEN label = -1 THEN 0 ELSE label END AS label)
                     FROM ({S.F3}) a WHERE label <> 0),
c AS (SELECT LEAST(COUNT(CASE WHEN label = 1 THEN 1 END), {SM.SSL_MAX_POSITIVES}) AS p,
             COUNT(CASE WHEN label = 0 THEN 1 END) AS n FROM e),
r AS (SELECT e.*, ROW_NUMBER() OVER (PARTITION BY label ORDER BY {key_sql('row_id', seed)}, row_id) AS rn FROM e)
SELECT r.* FROM r CROSS JOIN c WHERE (label = 1 AND rn <= p) OR (label = 0 AND rn <= LEAST(n, p))"""


@register("ssl_sample", f"SELECT row_id, label FROM ({ssl_sql(0)}) s")
def ssl_sample(spark, sf_dir):
    return SM.ssl_sample(ssl_events(spark, sf_dir), 0).select("row_id", "label")


def pu_sql(seed: int) -> str:
    return f"""WITH f AS ({S.F1}),
c AS (SELECT COUNT(CASE WHEN label = 1 THEN 1 END) AS p, COUNT(CASE WHEN label = 0 THEN 1 END) AS u FROM f),
r AS (SELECT f.*, ROW_NUMBER() OVER (PARTITION BY label ORDER BY {key_sql('row_id', seed)}, row_id) AS rn FROM f)
SELECT r.* FROM r CROSS JOIN c
WHERE label = 1 OR (label = 0 AND rn <= LEAST({SM.PU_UNLABELLED_FACTOR} * LEAST(p, u), u))"""


@register("pu_sample", f"SELECT row_id, label FROM ({pu_sql(0)}) s")
def pu_sample(spark, sf_dir):
    return SM.pu_sample(pu_orders(spark, sf_dir), 0).select("row_id", "label")


@register("equal_sample", f"""WITH f AS (SELECT row_id, label, CASE WHEN label = 1 THEN 1 ELSE 0 END AS side
                   FROM ({S.F2}) a),
c AS (SELECT LEAST(COUNT(CASE WHEN side = 1 THEN 1 END), COUNT(CASE WHEN side = 0 THEN 1 END)) AS n FROM f),
r AS (SELECT f.*, ROW_NUMBER() OVER (PARTITION BY side ORDER BY {key_sql('row_id', 0)}, row_id) AS rn FROM f)
SELECT row_id, label FROM r CROSS JOIN c WHERE rn <= n""")
def equal_sample(spark, sf_dir):
    return SM.equal_sample(noisy_lineitem(spark, sf_dir), 0).select("row_id", "label")


def ssl_pu_sql(seed: int = 0) -> str:
    return f"""WITH e AS (SELECT row_id, label FROM ({S.F3}) a),
c AS (SELECT LEAST(COUNT(CASE WHEN label = -1 THEN 1 END), COUNT(CASE WHEN label = 1 THEN 1 END)) AS n,
             COUNT(CASE WHEN label = 0 THEN 1 END) AS s0, COUNT(CASE WHEN label = -1 THEN 1 END) AS s1 FROM e),
r AS (SELECT e.*, ROW_NUMBER() OVER (PARTITION BY label ORDER BY {key_sql('row_id', seed, 'pool')}, row_id) AS pos
      FROM e WHERE label IN (0, -1)),
d AS (SELECT 0 AS cls, i AS draw, ({key_sql('i', seed, 'draw0')}) % s0 + 1 AS dpos
      FROM c, range(0, (SELECT n FROM c)) t(i) WHERE s0 > 0
      UNION ALL
      SELECT -1, i, ({key_sql('i', seed, 'draw1')}) % s1 + 1 FROM c, range(0, (SELECT n FROM c)) t(i) WHERE s1 > 0)
SELECT r.row_id, 0 AS label, d.draw FROM d JOIN r ON r.label = d.cls AND r.pos = d.dpos
UNION ALL SELECT row_id, 1, CAST(NULL AS BIGINT) FROM e WHERE label = 1"""


@register("ssl_pu_sample", ssl_pu_sql(0))
def ssl_pu_sample(spark, sf_dir):
    s = SM.ssl_pu_sample(ssl_events(spark, sf_dir), 0)
    return s.select("row_id", F.col("label").cast("int").alias("label"), "draw")


@register("entity_sample", f"""WITH e AS ({S.F3}),
ids AS (SELECT c_2, MIN(row_id) AS first FROM e WHERE c_2 IS NOT NULL GROUP BY c_2),
k AS (SELECT CASE WHEN CEIL(COUNT(*) * {SM.ENTITY_PERCENT}) > {SM.ENTITY_MAX} THEN {SM.ENTITY_MAX}
                  WHEN CEIL(COUNT(*) * {SM.ENTITY_PERCENT}) < {SM.ENTITY_MIN} THEN COUNT(*)
                  ELSE CEIL(COUNT(*) * {SM.ENTITY_PERCENT}) END AS nids FROM ids),
chosen AS (SELECT c_2 FROM (SELECT c_2, ROW_NUMBER() OVER (ORDER BY first) AS rn FROM ids) x, k WHERE rn <= nids)
SELECT row_id, c_2, label FROM e WHERE c_2 IN (SELECT c_2 FROM chosen)""")
def entity_sample(spark, sf_dir):
    return SM.entity_sample(ssl_events(spark, sf_dir), "c_2").select("row_id", "c_2", "label")


@register("holdout_split", f"""WITH f AS (SELECT row_id FROM ({S.F1}) a),
t AS ({smallest_sql('SELECT * FROM f', '(SELECT CAST(CEIL(0.2 * COUNT(*)) AS BIGINT) FROM f)', 0, purpose='split')})
SELECT row_id, CASE WHEN row_id IN (SELECT row_id FROM t) THEN 'test' ELSE 'train' END AS split FROM f""")
def holdout_split(spark, sf_dir):
    return SM.holdout_split(pu_orders(spark, sf_dir).select("row_id"), 0.2, 0).select("row_id", "split")


_HALF = "(SELECT COUNT(*) // 2 FROM f)"


@register("seed_overlap", f"""WITH f AS (SELECT row_id FROM ({S.F1}) a),
a AS ({smallest_sql('SELECT * FROM f', _HALF, 0)}), b AS ({smallest_sql('SELECT * FROM f', _HALF, 1)}),
c AS ({smallest_sql('SELECT * FROM f', _HALF, 0, purpose='split')})
SELECT (SELECT COUNT(*) FROM f) AS n, (SELECT COUNT(*) FROM a JOIN b USING (row_id)) AS two_seeds,
       (SELECT COUNT(*) FROM a JOIN c USING (row_id)) AS two_purposes""")
def seed_overlap(spark, sf_dir):
    """Half of the rows drawn with two seeds, and for two purposes: about a quarter is in both."""
    f = pu_orders(spark, sf_dir).select("row_id")
    half = f.count() // 2
    first, seed, purpose = (SM.smallest_filter(f, half, s, purpose=p) for s, p in (
        (0, "sample"), (1, "sample"), (0, "split")))
    return f.agg(F.count(F.lit(1)).alias("n"), F.count_if(first & seed).alias("two_seeds"),
                 F.count_if(first & purpose).alias("two_purposes"))
