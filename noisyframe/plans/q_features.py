"""Queries of the feature layer."""

from __future__ import annotations

import itertools

from pyspark.sql import functions as F

from ..functions.keys import r6
from ..operators import features as FE
from ..sources.tables import declared_frame, noisy_lineitem, pu_orders, ssl_events, table
from . import sqlparts as S
from .catalog import register
from .label_errors import lineitem_psx


def _f2(spark, sf_dir):
    return noisy_lineitem(spark, sf_dir)


# ------------------------------------------------------------------ S1, S6

@register("pu_frame", S.F1)
def pu_frame(spark, sf_dir):
    return pu_orders(spark, sf_dir)


@register("label_map", """SELECT label, CAST(ROW_NUMBER() OVER (ORDER BY label) - 1 AS INT) AS code
FROM (SELECT l_returnflag AS label FROM lineitem UNION SELECT l_linestatus FROM lineitem) u""")
def label_map(spark, sf_dir):
    from ..sources.text import label_index
    li = table(spark, sf_dir, "lineitem")
    return label_index(li.select(F.col("l_returnflag").alias("label")),
                       li.select(F.col("l_linestatus").alias("label")))


# ------------------------------------------------------------------ P1-P7, P10-P12

FILL_SRC = """SELECT d.doc_id AS row_id, d.lang AS c_1, CAST(l.quality AS STRING) AS c_2,
       CAST(l.toxic AS DOUBLE) AS n_1
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""


@register("fillna_roles", f"""SELECT row_id, COALESCE(c_1, '0') AS c_1, COALESCE(c_2, '0') AS c_2,
       COALESCE(n_1, -1) AS n_1 FROM ({FILL_SRC}) f""")
def fillna_roles(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    lab = table(spark, sf_dir, "labels")
    j = d.join(lab, "doc_id", "left").select(
        F.col("doc_id").alias("row_id"), F.col("lang").alias("c_1"),
        F.col("quality").cast("string").alias("c_2"), F.col("toxic").cast("double").alias("n_1"))
    return FE.fillna_roles(j)


@register("drop_time", f"SELECT row_id, c_1, c_2, c_3, c_4, n_1, n_2, label FROM ({S.F1}) f")
def drop_time(spark, sf_dir):
    return FE.drop_time(pu_orders(spark, sf_dir))


def _narrow_sql(cols):
    parts = []
    for c in cols:
        parts.append(f"""SELECT '{c}' AS col, MIN(CAST({c} AS DOUBLE)) AS min, MAX(CAST({c} AS DOUBLE)) AS max,
  COUNT(CASE WHEN CAST(CAST({c} AS FLOAT) AS DOUBLE) <> {c} THEN 1 END) AS n_lossy,
  COUNT(CASE WHEN {c} <> FLOOR({c}) THEN 1 END) AS n_frac FROM f2""")
    body = " UNION ALL ".join(parts)
    return f"""WITH f2 AS ({S.F2}), s AS ({body})
SELECT col, ROUND(min, 6) AS min, ROUND(max, 6) AS max, n_lossy,
  CASE WHEN n_frac = 0 THEN CASE WHEN min >= -128 AND max <= 127 THEN 'tinyint'
                                 WHEN min >= -32768 AND max <= 32767 THEN 'smallint'
                                 WHEN min >= -2147483648 AND max <= 2147483647 THEN 'int'
                                 ELSE 'bigint' END
       WHEN n_lossy = 0 THEN 'float' ELSE 'double' END AS type
FROM s"""


NARROW_COLS = ["row_id", "n_1", "n_2", "n_3", "n_4"]


@register("narrow_stats", _narrow_sql(NARROW_COLS))
def narrow_stats(spark, sf_dir):
    s = FE.narrow_stats(_f2(spark, sf_dir), NARROW_COLS)
    return s.select("col", r6(F.col("min")).alias("min"), r6(F.col("max")).alias("max"),
                    "n_lossy", "type")


def _narrowed_sql(lossy: bool) -> str:
    typed = _narrow_sql(NARROW_COLS)
    rows = " UNION ALL ".join(f"SELECT row_id, '{c}' AS col, CAST({c} AS DOUBLE) AS x FROM f" for c in NARROW_COLS)
    kind = "CASE WHEN type = 'double' THEN 'float' ELSE type END" if lossy else "type"
    return f"""WITH f AS ({S.F2}), t AS (SELECT col, {kind} AS type FROM ({typed}) s), r AS ({rows})
SELECT row_id, col, type, ROUND(CASE WHEN type = 'float' THEN CAST(CAST(x AS FLOAT) AS DOUBLE) ELSE x END, 6) AS value
FROM r JOIN t USING (col)"""


def _narrowed(spark, sf_dir, lossy):
    f = FE.narrow(_f2(spark, sf_dir), NARROW_COLS, lossy)
    return f.select("row_id", F.inline(F.array(*[
        F.struct(F.lit(c).alias("col"), F.typeof(c).alias("type"), F.round(F.col(c).cast("double"), 6).alias("value"))
        for c in NARROW_COLS]))).withColumn("row_id", F.col("row_id").cast("bigint"))


@register("narrow_lossless", _narrowed_sql(False))
def narrow_lossless(spark, sf_dir):
    """P4 applied: each value with the type it is cast to."""
    return _narrowed(spark, sf_dir, False)


@register("narrow_lossy", _narrowed_sql(True))
def narrow_lossy(spark, sf_dir):
    """P4 applied, with floats wherever the range allows them."""
    return _narrowed(spark, sf_dir, True)


DECLARED = {"c_mktsegment": "cat", "c_nationkey": "cat", "c_acctbal": "num"}


@register("declared_roles", """SELECT c_custkey AS row_id, c_mktsegment AS c_1, CAST(c_nationkey AS VARCHAR) AS c_2,
  CAST(c_acctbal AS DOUBLE) AS n_1 FROM customer""")
def declared_roles(spark, sf_dir):
    """Customers by a declared map; their names all start like categories."""
    return declared_frame(table(spark, sf_dir, "customer"), DECLARED, "c_custkey")


@register("pair_code", f"""WITH f AS ({S.F2})
SELECT row_id, CAST(c_3 AS BIGINT) * (SELECT MAX(CAST(c_4 AS BIGINT)) FROM f) + CAST(c_4 AS BIGINT)
       AS pair_code FROM f""")
def pair_code(spark, sf_dir):
    return FE.pair_code(_f2(spark, sf_dir), "c_3", "c_4").select("row_id", "pair_code")


@register("normalize_labels", f"""SELECT row_id, CASE WHEN label = -1 THEN 0 ELSE label END AS label
FROM ({S.F3}) e WHERE label <> 0""")
def normalize_labels(spark, sf_dir):
    from ..operators.clean import normalize_labels as norm
    return norm(ssl_events(spark, sf_dir), "ssl").select("row_id", "label")


@register("nonneg_rows", f"""SELECT row_id, label FROM (
  SELECT row_id, label FROM ({S.F3}) a
  UNION ALL SELECT -row_id - 1, label FROM ({S.F3}) b WHERE label <> 0) p WHERE row_id >= 0""")
def nonneg_rows(spark, sf_dir):
    """P7 on a padded frame: labelled rows appended again under negative indices
    (as the reference pads before transforming) are dropped, the table remains."""
    e = ssl_events(spark, sf_dir).select("row_id", "label")
    padded = e.unionByName(e.where(F.col("label") != 0).select(
        (-F.col("row_id") - 1).alias("row_id"), "label"))
    return FE.nonneg_rows(padded)


@register("psx_validate", f"""SELECT COUNT(*) AS n_rows,
  COUNT(CASE WHEN len(list_value(p0, p1)) <> 2 THEN 1 END) AS n_bad_size,
  COUNT(CASE WHEN p0 < 0 OR p0 > 1 OR p1 < 0 OR p1 > 1 THEN 1 END) AS n_out_of_range
FROM ({S.psx_lineitem()}) p""")
def psx_validate(spark, sf_dir):
    from ..operators.clean import validate_psx
    return validate_psx(lineitem_psx(spark, sf_dir, checkpoint=False), 2)


@register("date_parts", f"""WITH f AS ({S.F2}),
parts AS (SELECT row_id, 'year' AS part, CAST(year(t_1) AS INT) AS value FROM f
  UNION ALL SELECT row_id, 'month', CAST(month(t_1) AS INT) FROM f
  UNION ALL SELECT row_id, 'day', CAST(day(t_1) AS INT) FROM f
  UNION ALL SELECT row_id, 'hour', CAST(hour(t_1) AS INT) FROM f
  UNION ALL SELECT row_id, 'weekday', CAST(isodow(t_1) - 1 AS INT) FROM f),
kept AS (SELECT part FROM parts GROUP BY part HAVING COUNT(DISTINCT value) > 1)
SELECT row_id, part, value FROM parts WHERE part IN (SELECT part FROM kept)""")
def date_parts(spark, sf_dir):
    f = _f2(spark, sf_dir)
    kept = FE.date_parts_fit(f, "t_1")
    wide = FE.date_parts(f.select("row_id", "t_1"), "t_1", kept)
    if not kept:
        return wide.select("row_id", F.lit(None).cast("string").alias("part"),
                           F.lit(None).cast("int").alias("value")).limit(0)
    stack = ", ".join(f"'{p}', `{FE.feat_name('c_', 'KeyTimeDate', 't_1:' + p)}`" for p in kept)
    return wide.selectExpr("row_id", f"stack({len(kept)}, {stack}) AS (part, value)").select(
        "row_id", "part", F.col("value").cast("int").alias("value"))


@register("num_diff", f"""SELECT row_id, ROUND(n_1 - n_2, 6) AS diff_n_2, ROUND(n_1 - n_3, 6) AS diff_n_3,
       ROUND(n_1 - n_4, 6) AS diff_n_4 FROM ({S.F2}) f""")
def num_diff(spark, sf_dir):
    d = FE.num_diff(_f2(spark, sf_dir), ["n_1", "n_2", "n_3", "n_4"])
    n = lambda o: FE.feat_name("n_", "NumDiffOrder2LEVEL", f"n_1_{o}_diff")
    return d.select("row_id", *[r6(F.col(f"`{n(o)}`")).alias(f"diff_{o}") for o in ("n_2", "n_3", "n_4")])


# ------------------------------------------------------------------ A2-A7

@register("cat_cardinality", f"""SELECT COUNT(DISTINCT c_1) AS n_c_1, COUNT(DISTINCT c_2) AS n_c_2,
       COUNT(DISTINCT c_3) AS n_c_3, COUNT(DISTINCT c_4) AS n_c_4 FROM ({S.F1}) f""")
def cat_cardinality(spark, sf_dir):
    return FE.cat_cardinality(pu_orders(spark, sf_dir), ["c_1", "c_2", "c_3", "c_4"])


CATS5 = ["c_1", "c_2", "c_3", "c_4", "c_5"]


@register("cat_count", f"""WITH f AS ({S.F2})
SELECT row_id, {', '.join(f'CAST(COUNT(*) OVER (PARTITION BY {c}) AS BIGINT) AS cnt_{c}' for c in CATS5)}
FROM f""")
def cat_count(spark, sf_dir):
    d = FE.cat_count(_f2(spark, sf_dir), CATS5)
    return d.select("row_id", *[F.col(f"`{FE.feat_name('n_', 'CatCnt', c)}`").alias(f"cnt_{c}")
                                for c in CATS5])


PAIRS = list(itertools.combinations(CATS5, 2))


@register("cat_pair_count", f"""WITH f AS ({S.F2})
SELECT row_id, {', '.join(f'COUNT(*) OVER (PARTITION BY {a}, {b}) AS cnt_{a}_{b}' for a, b in PAIRS)}
FROM f""")
def cat_pair_count(spark, sf_dir):
    d = FE.cat_pair_count(_f2(spark, sf_dir), CATS5)
    return d.select("row_id", *[
        F.col(f"`{FE.feat_name('n_', 'CatCnt2LEVEL', f'{a}_{b}_cnt')}`").alias(f"cnt_{a}_{b}")
        for a, b in PAIRS])


MEAN_CATS, MEAN_NUMS = CATS5, ["n_1", "n_2", "n_3", "n_4"]


@register("num_mean_by_cat", f"""WITH f AS ({S.F2})
SELECT row_id, {', '.join(f'ROUND(AVG({n}) OVER (PARTITION BY {c}) + 1e-9, 6) AS mean_{c}_{n}'
                          for c in MEAN_CATS for n in MEAN_NUMS)}
FROM f""")
def num_mean_by_cat(spark, sf_dir):
    d = FE.num_mean_by_cat(_f2(spark, sf_dir), MEAN_CATS, MEAN_NUMS)
    return d.select("row_id", *[
        # a mean of few cents can be a tie at six places, which the engines round differently
        r6(F.col(f"`{FE.feat_name('n_', 'NumMean2LEVEL', f'{c}_{n}_mean')}`") + 1e-9).alias(f"mean_{c}_{n}")
        for c in MEAN_CATS for n in MEAN_NUMS])


@register("cat_label_rate", f"""WITH f AS ({S.F2}),
g AS (SELECT c_3, COUNT(*) AS cnt, COUNT(CASE WHEN label = 1 THEN 1 END) AS pos FROM f GROUP BY c_3)
SELECT row_id, ROUND(CASE WHEN pos > 0 THEN cnt / pos END, 6) AS rate FROM f LEFT JOIN g USING (c_3)""")
def cat_label_rate(spark, sf_dir):
    d = FE.cat_label_rate(_f2(spark, sf_dir), "c_3")
    return d.select("row_id", r6(F.col(f"`{FE.feat_name('n_', 'CatMeanLabel', 'c_3')}`")).alias("rate"))


def pairs_sql(src: str, cats: list) -> str:
    return " UNION ".join(f"SELECT '{c}' AS col, CAST({c} AS STRING) AS value FROM ({src}) p{i} "
                          f"WHERE {c} IS NOT NULL" for i, c in enumerate(cats))


def blocks_sql(cats: list, src: str = S.F2) -> str:
    cols = ", ".join(f"('{c}', {i})" for i, c in enumerate(cats))
    return f"""WITH RECURSIVE pv AS ({pairs_sql(src, cats)}),
sz AS (SELECT col, COUNT(*) AS n FROM pv GROUP BY col),
it AS (SELECT a.col AS col_a, b.col AS col_b, COUNT(*) AS n_both FROM pv a JOIN pv b
       ON a.value = b.value AND a.col < b.col GROUP BY 1, 2),
ed AS (SELECT col_a, col_b FROM it JOIN sz sa ON sa.col = col_a JOIN sz sb ON sb.col = col_b
       WHERE LEAST(sa.n, sb.n) > 1 AND n_both / LEAST(sa.n, sb.n) > {FE.BLOCK_OVERLAP}),
cols(col, idx) AS (VALUES {cols}),
und AS (SELECT col_a AS a, col_b AS b FROM ed UNION SELECT col_b, col_a FROM ed),
reach(src, dst) AS (SELECT col, col FROM cols UNION SELECT r.src, u.b FROM reach r JOIN und u ON r.dst = u.a),
root AS (SELECT src AS col, MIN(c.idx) AS r FROM reach JOIN cols c ON c.col = reach.dst GROUP BY src)
SELECT col, CAST(DENSE_RANK() OVER (ORDER BY r) AS INT) AS block FROM root"""


@register("cat_blocks", blocks_sql(CATS5))
def cat_blocks(spark, sf_dir):
    return FE.cat_blocks(_f2(spark, sf_dir), CATS5)


@register("block_values", f"""WITH b AS ({blocks_sql(CATS5)}),
pv AS ({pairs_sql(S.F2, CATS5)})
SELECT DISTINCT block, value FROM pv JOIN b USING (col)""")
def block_values(spark, sf_dir):
    f = _f2(spark, sf_dir)
    return FE.block_values(f, FE.cat_blocks(f, CATS5))


def _encode_sql() -> str:
    fit = f"SELECT * FROM ({S.F2}) a WHERE n_1 <= 25"
    return f"""WITH b AS ({blocks_sql(CATS5)}),
fitv AS (SELECT DISTINCT block, value FROM ({pairs_sql(fit, CATS5)}) p JOIN b USING (col)),
d0 AS (SELECT block, value, ROW_NUMBER() OVER (PARTITION BY block ORDER BY value) - 1 AS code FROM fitv),
allv AS (SELECT DISTINCT block, value FROM ({pairs_sql(S.F2, CATS5)}) p JOIN b USING (col)),
nv AS (SELECT block, value FROM allv WHERE NOT EXISTS
       (SELECT 1 FROM d0 WHERE d0.block = allv.block AND d0.value = allv.value)),
base AS (SELECT block, COUNT(*) AS n FROM d0 GROUP BY block),
d1 AS (SELECT block, value, COALESCE(base.n, 0) + ROW_NUMBER() OVER (PARTITION BY block ORDER BY value) - 1 AS code
       FROM nv LEFT JOIN base USING (block)),
d AS (SELECT * FROM d0 UNION ALL SELECT * FROM d1),
f AS ({S.F2})
SELECT row_id, {', '.join(f'(SELECT CAST(code AS INT) FROM d JOIN b USING (block) WHERE b.col = {c!r} AND d.value = CAST(f.{c} AS STRING)) AS {c}' for c in CATS5)}
FROM f"""


@register("block_encode", _encode_sql())
def block_encode(spark, sf_dir):
    f = _f2(spark, sf_dir)
    blocks = FE.cat_blocks(f, CATS5)
    enc = FE.BlockEncoder().fit(f.where(F.col("n_1") <= 25), blocks)
    return enc.transform(f).select("row_id", *CATS5)


def _bins_sql(src: str, c: str, name: str) -> str:
    """row_id and the quantile bin of one column."""
    return f"""WITH f AS ({src}),
v AS (SELECT {c} AS x FROM f WHERE {c} IS NOT NULL),
st AS (SELECT COUNT(*) AS n, LEAST(FLOOR(COUNT(DISTINCT x) / {FE.BIN_PER_VALUES}), {FE.BIN_MAX}) AS q FROM v),
r AS (SELECT x, ROW_NUMBER() OVER (ORDER BY x) AS rn FROM v),
pos AS (SELECT (n - 1) * (i * (1.0 / q)) AS h, n FROM st, range(0, {FE.BIN_MAX + 1}) t(i) WHERE i <= q),
ed AS (SELECT DISTINCT a.x + (h - FLOOR(h)) * (b.x - a.x) AS e FROM pos
       JOIN r a ON a.rn = FLOOR(h) + 1 JOIN r b ON b.rn = LEAST(FLOOR(h) + 2, n)),
lim AS (SELECT MIN(e) AS lo, MAX(e) AS hi FROM ed)
SELECT row_id, CASE WHEN {c} IS NULL OR {c} <= lo OR {c} > hi THEN NULL
                    ELSE CAST((SELECT COUNT(*) FROM ed WHERE e < {c}) - 1 AS INT) END AS {name}
FROM f CROSS JOIN lim"""


def _bin(c: str):
    return F.col(f"`{FE.feat_name('c_', 'NumsBucket', f'{c}_bucket')}`")


@register("quantile_bins", _bins_sql(S.F2, "n_2", "bin"))
def quantile_bins(spark, sf_dir):
    """The one column of F2 with more than 100 distinct values."""
    f = _f2(spark, sf_dir)
    return FE.NumBucketer().fit(f, ["n_2"]).transform(f).select("row_id", _bin("n_2").alias("bin"))


@register("quantile_bins_orders", f"""SELECT * FROM ({_bins_sql(S.F1, 'n_1', 'bin_n_1')}) a
JOIN ({_bins_sql(S.F1, 'n_2', 'bin_n_2')}) b USING (row_id)""")
def quantile_bins_orders(spark, sf_dir):
    """All numbers of F1."""
    f = pu_orders(spark, sf_dir)
    return FE.NumBucketer().fit(f, ["n_1", "n_2"]).transform(f).select(
        "row_id", *[_bin(c).alias(f"bin_{c}") for c in ("n_1", "n_2")])


IDX_COLS = ["n_1", "n_3", "n_4"]


@register("value_index", f"""WITH f AS ({S.F2})
SELECT row_id, {', '.join(f'CAST(DENSE_RANK() OVER (ORDER BY {c}) - 1 AS INT) AS idx_{c}' for c in IDX_COLS)}
FROM f""")
def value_index(spark, sf_dir):
    f = _f2(spark, sf_dir)
    b = FE.NumBucketer().fit(f, IDX_COLS)
    return b.transform(f).select("row_id", *[
        F.col(f"`{FE.feat_name('c_', 'NumsBucket', f'{c}_bucket')}`").alias(f"idx_{c}") for c in IDX_COLS])


# ------------------------------------------------------------------ W1, W2

RC_CATS = ["c_1", "c_2"]


@register("cat_running_count", f"""SELECT row_id, {', '.join(
    f'CASE WHEN {c} IS NOT NULL THEN ROW_NUMBER() OVER (PARTITION BY {c} ORDER BY t_1 NULLS LAST, row_id) - 1 END AS rc_{c}'
    for c in RC_CATS)} FROM ({S.F3}) e""")
def cat_running_count(spark, sf_dir):
    d = FE.cat_running_count(ssl_events(spark, sf_dir), RC_CATS, "t_1")
    return d.select("row_id", *[F.col(f"`{FE.feat_name('n_', 'CatCumCnt', c)}`").alias(f"rc_{c}")
                                for c in RC_CATS])


@register("cat_time_gap", f"""SELECT row_id, {', '.join(
    f'ROUND((epoch_us(t_1) - epoch_us(LAG(t_1) OVER (PARTITION BY {c} ORDER BY t_1 NULLS LAST, row_id))) / 1e6, 6) AS gap_{c}'
    for c in RC_CATS)} FROM ({S.F3}) e""")
def cat_time_gap(spark, sf_dir):
    d = FE.cat_time_gap(ssl_events(spark, sf_dir), RC_CATS, "t_1")
    return d.select("row_id", *[
        r6(F.col(f"`{FE.feat_name('n_', 'CatTimeDiff2LEVEL', f'{c}_t_1_diff:1')}`")).alias(f"gap_{c}")
        for c in RC_CATS])


def _hash_sql(c: str) -> str:
    return f"CAST('0x' || substr(md5({c}), 1, 15) AS BIGINT) AS {c}"


@register("hash_categories", f"""SELECT row_id, {', '.join(_hash_sql(f'c_{i}') for i in range(1, 5))},
n_1, n_2, t_1, label FROM ({S.F1}) f""")
def hash_categories(spark, sf_dir):
    return FE.hash_categories(pu_orders(spark, sf_dir))
