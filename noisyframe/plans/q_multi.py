"""Queries of multi-label errors, text probabilities and histogram gain."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.keys import r6
from ..operators import gain as G
from ..operators import labels as L
from ..operators import pruning as P
from ..operators.text_rates import token_rate_psx
from ..session import cut_lineage
from ..sources.tables import noisy_documents, noisy_lineitem
from . import sqlparts as S
from .catalog import register
from .q_labels import errors_sql
from .q_latent import boundary_sql, multi_joint_sql, multi_psx, multi_psx_sql
from .q_sampling import balanced_sql

K = 3   # classes of the multi-label frame


# ------------------------------------------------------------------ L15, T1 with label lists

def _multi_errors_sql() -> str:
    own = "CASE k " + " ".join(f"WHEN {k} THEN p{k}" for k in range(K)) + " END"
    budget = "CASE k " + " ".join(f"WHEN {k} THEN m{k}" for k in range(K)) + " END"
    counts = " OR ".join(
        f"(k = {k} AND n{k}_{j} > 0 AND RANK() OVER (PARTITION BY k ORDER BY p{j} - p{k} DESC) <= n{k}_{j})"
        for k in range(K) for j in range(K) if j != k)
    cells = ", ".join(f"MAX(CASE WHEN k_s = {k} AND k_y = {j} THEN v END) AS n{k}_{j}" for k in range(K) for j in range(K))
    sums = ", ".join(f"SUM(CASE WHEN k_s = {k} AND k_y <> {k} THEN v ELSE 0 END) AS m{k}" for k in range(K))
    agrees = " AND ".join(f"list_contains(labels, {k}) = (p{k} > (SELECT b FROM bd))" for k in range(K))
    mean = " + ".join(f"CASE WHEN list_contains(labels, {k}) THEN p{k} ELSE 0 END" for k in range(K))
    return f"""WITH p AS MATERIALIZED ({multi_psx_sql(K)}), cj AS MATERIALIZED ({multi_joint_sql(K)}),
bu AS (SELECT {cells}, {sums} FROM cj), bd AS MATERIALIZED (SELECT boundary AS b FROM ({boundary_sql(K)}) z WHERE best),
x AS (SELECT p.*, unnest(labels) AS k FROM p), xb AS (SELECT * FROM x CROSS JOIN bu),
marks AS (SELECT row_id, k, {budget} > 0 AND COUNT(*) OVER (PARTITION BY k ORDER BY {own}
            RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) <= {budget} AS by_class, {counts} AS by_count FROM xb),
rows AS (SELECT row_id, BOOL_OR(by_class) AS by_class, BOOL_OR(by_count) AS by_count FROM marks GROUP BY row_id),
m AS (SELECT p.row_id, p.labels, by_class AND by_count AND NOT ({agrees}) AS is_error, by_count AND NOT ({agrees}) AS by_rate,
        ({mean}) / len(labels) - GREATEST({', '.join(f'p{k}' for k in range(K))}) AS margin
      FROM p JOIN rows USING (row_id))"""


@register("label_errors_multi", _multi_errors_sql() + """
SELECT row_id, list_aggregate(labels, 'string_agg', ',') AS labels, is_error FROM m""")
def label_errors_multi(spark, sf_dir):
    """L15 over label lists, both methods."""
    p = cut_lineage(multi_psx(spark, sf_dir))
    return P.find_label_errors_multi(p, K).select("row_id", F.array_join("labels", ",").alias("labels"), "is_error")


@register("order_errors_multi", _multi_errors_sql() + """
SELECT row_id, ROUND(margin, 6) AS score, ROW_NUMBER() OVER (ORDER BY ROUND(margin, 9), row_id) AS pos FROM m WHERE by_rate""")
def order_errors_multi(spark, sf_dir):
    """T1 over label lists: errors by noise rate, ordered by the margin of the mean probability."""
    p = cut_lineage(multi_psx(spark, sf_dir))
    marked = P.find_label_errors_multi(p, K, method="prune_by_noise_rate")
    return P.order_label_errors_multi(marked).select("row_id", r6(F.col("score")).alias("score"), "pos")


# ------------------------------------------------------------------ M12

F4_LABELLED = f"SELECT row_id, label, text FROM ({S.F4}) f4 WHERE label IS NOT NULL"
# every ninth label turned round, for errors to find
F4_FLIPPED = f"SELECT row_id, CASE WHEN row_id % 9 = 0 THEN 1 - label ELSE label END AS label, text FROM ({F4_LABELLED}) c"
TEXT_FOLDS = 5


def _text_sql(src: str) -> str:
    """psx rows of the labelled documents: f (row_id, label, fold, p0, p1)."""
    ks = (0, 1)
    said = ", ".join(f"CAST(SUM(CASE WHEN label = {k} THEN n ELSE 0 END) AS DOUBLE) AS f{k}" for k in ks)
    rest = ", ".join(f"SUM(f{k}) OVER (PARTITION BY token) - f{k} AS o{k}" for k in ks)
    sizes = ", ".join(f"SUM(SUM(f{k})) OVER () - SUM(f{k}) AS t{k}" for k in ks)
    share = ", ".join(f"SUM(COUNT(CASE WHEN label = {k} THEN 1 END)) OVER () - COUNT(CASE WHEN label = {k} THEN 1 END) AS c{k}" for k in ks)
    logs = ", ".join(f"SUM(w.n * (LN(r.o{k} + 1.0) - LN(z.t{k} + v.v))) AS s{k}" for k in ks)
    score = ", ".join(f"COALESCE(l.s{k}, 0) + LN((h.c{k} + 1.0) / (h.c0 + h.c1 + 2.0)) AS s{k}" for k in ks)
    total = "EXP(s0 - GREATEST(s0, s1)) + EXP(s1 - GREATEST(s0, s1))"
    return f"""WITH d AS MATERIALIZED ({S.folds(src, TEXT_FOLDS)}),
w AS MATERIALIZED (SELECT row_id, fold, label, token, CAST(COUNT(*) AS DOUBLE) AS n FROM (SELECT row_id, fold, label, unnest(regexp_extract_all(
  translate(text, '{"ABCDEFGHIJKLMNOPQRSTUVWXYZ"}', '{"abcdefghijklmnopqrstuvwxyz"}'), '[^\\x09-\\x0D\\x20]+')) AS token FROM d) a GROUP BY ALL),
pf AS MATERIALIZED (SELECT token, fold, {said} FROM w GROUP BY token, fold),
r AS MATERIALIZED (SELECT token, fold, {rest} FROM pf), z AS (SELECT fold, {sizes} FROM pf GROUP BY fold),
h AS (SELECT fold, {share} FROM d GROUP BY fold), v AS (SELECT CAST(COUNT(DISTINCT token) AS DOUBLE) AS v FROM pf),
l AS (SELECT w.row_id, {logs} FROM w JOIN r USING (token, fold) JOIN z USING (fold) CROSS JOIN v GROUP BY w.row_id),
q AS (SELECT d.row_id, d.label, d.fold, {score} FROM d LEFT JOIN l USING (row_id) JOIN h USING (fold))
SELECT row_id, label, fold, {', '.join(f'ROUND(EXP(s{k} - GREATEST(s0, s1)) / ({total}), 9) AS p{k}' for k in ks)} FROM q"""


def _text_psx(spark, sf_dir, flipped: bool = False):
    d = noisy_documents(spark, sf_dir).where(F.col("label").isNotNull()).select("row_id", "label", "text")
    if flipped:
        d = d.withColumn("label", F.when(F.col("row_id") % 9 == 0, 1 - F.col("label")).otherwise(F.col("label")))
    folded = L.stratified_folds(d, TEXT_FOLDS, 0, write=True)
    return cut_lineage(token_rate_psx(folded).drop("text"))


@register("text_rate_probs", f"SELECT row_id, label, ROUND(p0, 6) AS p0, ROUND(p1, 6) AS p1 FROM ({_text_sql(F4_LABELLED)}) t")
def text_rate_probs(spark, sf_dir):
    """Out-of-fold class probabilities of the labelled documents."""
    p = _text_psx(spark, sf_dir)
    return p.select("row_id", "label", *[r6(F.element_at("psx", k + 1)).alias(f"p{k}") for k in (0, 1)])


@register("text_label_errors", f"SELECT row_id, label FROM ({errors_sql(f'SELECT * FROM ({_text_sql(F4_FLIPPED)}) t')}) e")
def text_label_errors(spark, sf_dir):
    """M12 -> L2 -> L15: likely label errors among documents with labels turned round."""
    return P.find_label_errors(_text_psx(spark, sf_dir, True)).where("is_error").select("row_id", "label")


# ------------------------------------------------------------------ M1, T2

GAIN_FEATURES = ["c_3", "c_4", "c_5", "n_1", "n_2", "n_3", "n_4"]
GAIN_SRC = f"""SELECT row_id, label, {', '.join(f'CAST({c} AS INT) AS {c}' if c[0] == 'c' else c for c in GAIN_FEATURES)} FROM ({S.F2}) f2"""
GAIN_LEVELS = 2


def _gain_frame(spark, sf_dir):
    f = noisy_lineitem(spark, sf_dir)
    return f.select("row_id", "label", *[F.col(c).cast("int").alias(c) if c[0] == "c" else F.col(c) for c in GAIN_FEATURES])


def gain_sql(src: str, features: list, levels: int, min_gain: float, top: int) -> str:
    ends = ", ".join(f'MIN(CAST("{c}" AS DOUBLE)) AS lo{i}, MAX(CAST("{c}" AS DOUBLE)) AS hi{i}' for i, c in enumerate(features))
    bins = ", ".join(f'CASE WHEN "{c}" IS NULL THEN -1 WHEN lo{i} = hi{i} THEN 0 ELSE LEAST(FLOOR((CAST("{c}" AS DOUBLE) - lo{i}) / (hi{i} - lo{i}) * {G.BINS}), {G.BINS - 1}) END AS b{i}'
                     for i, c in enumerate(features))
    parts = [f"src AS MATERIALIZED ({src})", f"ends AS (SELECT {ends} FROM src)",
             f"rows0 AS MATERIALIZED (SELECT {bins}, CASE WHEN label = 1 THEN 1 ELSE 0 END AS y, 1 AS node FROM src CROSS JOIN ends WHERE label IS NOT NULL)"]

    def impurity(n, s):
        return f"CASE WHEN {n} > 0 THEN {s} * ({n} - {s}) / ({n}) ELSE 0 END"

    for v in range(levels):
        long = " UNION ALL ".join(f"SELECT node, y, {i} AS i, '{c}' AS feature, b{i} AS bin FROM rows{v}" for i, c in enumerate(features))
        parts += [
            f"""cells{v} AS MATERIALIZED (SELECT node, i, feature, bin, CAST(COUNT(*) AS DOUBLE) AS n, CAST(SUM(y) AS DOUBLE) AS s
FROM ({long}) l GROUP BY ALL)""",
            f"""run{v} AS (SELECT node, i, feature, bin, SUM(n) OVER w AS n, SUM(s) OVER w AS s, SUM(n) OVER (PARTITION BY node, i) AS na,
SUM(s) OVER (PARTITION BY node, i) AS sa FROM cells{v} WINDOW w AS (PARTITION BY node, i ORDER BY bin))""",
            f"""best{v} AS MATERIALIZED (SELECT node, i, feature, bin, gain FROM (SELECT *, 2.0 * ({impurity('na', 'sa')} - {impurity('n', 's')}
- {impurity('(na - n)', '(sa - s)')}) AS gain FROM run{v} WHERE n < na) g
QUALIFY ROW_NUMBER() OVER (PARTITION BY node, i ORDER BY gain DESC, bin) = 1)""",
            f"""cut{v} AS MATERIALIZED (SELECT node, i, bin FROM best{v} WHERE gain > 0
QUALIFY ROW_NUMBER() OVER (PARTITION BY node ORDER BY gain DESC, feature) = 1)""",
            f"""rows{v + 1} AS MATERIALIZED (SELECT r.* REPLACE (2 * r.node + CASE WHEN (CASE c.i {' '.join(f'WHEN {i} THEN b{i}' for i in range(len(features)))} END) > c.bin
THEN 1 ELSE 0 END AS node) FROM rows{v} r JOIN cut{v} c ON c.node = r.node)"""]
    every = " UNION ALL ".join(f"SELECT feature, gain FROM best{v}" for v in range(levels))
    return f"""WITH {', '.join(parts)}
SELECT feature, ROUND(SUM(gain), 4) AS gain FROM ({every}) e GROUP BY feature HAVING SUM(gain) >= {min_gain}
ORDER BY SUM(gain) DESC, feature LIMIT {top}"""


@register("histogram_gain", gain_sql(balanced_sql(GAIN_SRC, str(G.GAIN_ROWS), 0), GAIN_FEATURES, GAIN_LEVELS, G.GAIN_FLOOR, G.TOP))
def histogram_gain(spark, sf_dir):
    """M1 + T2: gain on the class-balanced sample, with floor and top."""
    return G.balanced_gain(_gain_frame(spark, sf_dir), GAIN_FEATURES, levels=GAIN_LEVELS).select(
        "feature", F.round("gain", 4).alias("gain"))


@register("histogram_gain_top", gain_sql(GAIN_SRC, GAIN_FEATURES, 3, 0.0, 3))
def histogram_gain_top(spark, sf_dir):
    """M1 + T2: three levels on all rows, the three features of the largest gain."""
    return G.histogram_gain(cut_lineage(_gain_frame(spark, sf_dir)), GAIN_FEATURES, 0.0, 3, 3).select(
        "feature", F.round("gain", 4).alias("gain"))
