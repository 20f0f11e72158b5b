"""SQL text of the fixtures and shared steps, for the DuckDB oracle only.

Each function returns a ``WITH``-able ``SELECT`` so the oracle statements in
:mod:`noisyframe.plans.catalog` read as plain SQL.  Nothing here runs on Spark.
"""

from __future__ import annotations

from ..functions.keys import key_sql

F1 = """SELECT o_orderkey AS row_id, o_orderpriority AS c_1, c_mktsegment AS c_2,
       CAST(c_nationkey AS STRING) AS c_3, CAST(o_custkey AS STRING) AS c_4,
       o_totalprice AS n_1, c_acctbal AS n_2, o_orderdate AS t_1,
       CASE WHEN o_orderstatus = 'F' AND o_orderkey % 2 = 0 THEN 1 ELSE 0 END AS label
FROM orders JOIN customer ON o_custkey = c_custkey"""

F2 = """SELECT CAST(row_id AS BIGINT) AS row_id, l_returnflag AS c_1, l_linestatus AS c_2,
       CAST(CAST(FLOOR(l_quantity / 5) AS INT) AS STRING) AS c_3,
       CAST(l_suppkey AS STRING) AS c_4, CAST(l_partkey AS STRING) AS c_5,
       l_quantity AS n_1, l_extendedprice AS n_2, l_discount AS n_3, l_tax AS n_4,
       l_shipdate AS t_1, y_true,
       CASE WHEN row_id % 5 = 0 THEN 1 - y_true ELSE y_true END AS label
FROM (SELECT *, CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS y_true
      FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey,
                  l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                  l_returnflag, l_linestatus, l_shipdate) AS row_id FROM lineitem) r) y"""

F3 = """SELECT event_id AS row_id, event_type AS c_1, CAST(user_id AS STRING) AS c_2,
       value AS n_1, ts AS t_1,
       CASE WHEN event_id % 4 <> 0 THEN 0 WHEN value > 50 THEN 1 ELSE -1 END AS label
FROM events"""

F4 = """SELECT d.doc_id AS row_id, d.lang AS c_1, d.source AS c_2,
       CAST(d.n_chars AS DOUBLE) AS n_1, d.text, l.quality AS label, l.toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""


def folds(src: str, k: int = 5, seed: int = 0) -> str:
    return f"""SELECT *, CAST((ROW_NUMBER() OVER (PARTITION BY label
                 ORDER BY {key_sql('row_id', seed, 'fold')}, row_id) - 1) % {k} AS INT) AS fold
FROM ({src}) fsrc"""


def fold_psx(src: str, cat: str, K: int = 2) -> str:
    """``src`` must have ``fold``; adds ``p0 .. p{K-1}``."""
    counts = ", ".join(f"COUNT(CASE WHEN label = {k} THEN 1 END) AS f{k}" for k in range(K))
    loo = ", ".join(f"SUM(f{k}) OVER (PARTITION BY {cat}) - f{k} AS n{k}" for k in range(K))
    tot = " + ".join(f"lk.n{k}" for k in range(K))
    ps = ", ".join(f"CAST(lk.n{k} + 1 AS DOUBLE) / ({tot} + {K}) AS p{k}" for k in range(K))
    return f"""SELECT s.*, {ps}
FROM ({src}) s
LEFT JOIN (SELECT {cat} AS lc, fold AS lf, {loo}
           FROM (SELECT {cat}, fold, {counts} FROM ({src}) a GROUP BY {cat}, fold) pf) lk
  ON s.{cat} IS NOT DISTINCT FROM lk.lc AND s.fold = lk.lf"""


def psx_lineitem(k: int = 5, seed: int = 0, cat: str = "c_3") -> str:
    return fold_psx(folds(F2, k, seed), cat, 2)


def own_p(K: int = 2) -> str:
    return "CASE " + " ".join(f"WHEN label = {k} THEN p{k}" for k in range(K)) + " END"


def argmax(K: int = 2) -> str:
    """First index of the maximum of p0..p{K-1}."""
    mx = f"GREATEST({', '.join(f'p{k}' for k in range(K))})"
    return "CASE " + " ".join(f"WHEN p{k} = {mx} THEN {k}" for k in range(K)) + " END"


def thresholds(src: str, K: int = 2) -> str:
    return f"""SELECT label AS k, MEDIAN({own_p(K)}) AS thr FROM ({src}) t GROUP BY label"""


def confident(src: str, K: int = 2) -> str:
    """Adds y_conf using per-class medians as thresholds."""
    thr = ", ".join(f"MAX(CASE WHEN k = {k} THEN thr END) AS t{k}" for k in range(K))
    flags = [f"(p{k} >= t{k} - 1e-6)" for k in range(K)]
    nconf = " + ".join(f"CAST(COALESCE({f}, FALSE) AS INT)" for f in flags)
    first = "CASE " + " ".join(f"WHEN {f} THEN {k}" for k, f in enumerate(flags)) + " END"
    return f"""SELECT c.*, CASE WHEN {nconf} = 1 THEN {first}
                       WHEN {nconf} > 1 THEN {argmax(K)} END AS y_conf
FROM ({src}) c CROSS JOIN (SELECT {thr} FROM ({thresholds(src, K)}) th) tt"""


def grid(K: int = 2) -> str:
    return f"SELECT a.k AS k_s, b.k AS k_y FROM range({K}) a(k), range({K}) b(k)"


def cells(src: str, row: str, col: str, K: int = 2) -> str:
    return f"""SELECT CAST(g.k_s AS INT) AS k_s, CAST(g.k_y AS INT) AS k_y,
       CAST(COALESCE(x.v, 0) AS BIGINT) AS v
FROM ({grid(K)}) g LEFT JOIN (SELECT {row} AS k_s, {col} AS k_y, COUNT(*) AS v FROM ({src}) q
     WHERE {row} IS NOT NULL AND {col} IS NOT NULL GROUP BY 1, 2) x
  ON g.k_s = x.k_s AND g.k_y = x.k_y"""


def round_rows(src: str) -> str:
    """W6 on a long table (k_s, k_y, v DOUBLE)."""
    return f"""SELECT k_s, k_y, CAST(i + CASE WHEN d > 0 AND up <= d THEN 1
                              WHEN d < 0 AND dn <= -d THEN -1 ELSE 0 END AS BIGINT) AS v
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY k_s ORDER BY f - i DESC, k_y DESC) AS up,
                ROW_NUMBER() OVER (PARTITION BY k_s ORDER BY f - i ASC, k_y ASC) AS dn
      FROM (SELECT k_s, k_y, f, i,
                   ROUND_EVEN(SUM(f) OVER (PARTITION BY k_s), 0) - SUM(i) OVER (PARTITION BY k_s) AS d
            FROM (SELECT k_s, k_y, CAST(v AS DOUBLE) AS f, ROUND_EVEN(CAST(v AS DOUBLE), 0) AS i
                  FROM ({src}) r0) r1) r2) r3"""


def class_counts(src: str, K: int = 2) -> str:
    return f"""SELECT CAST(g.k AS INT) AS k_s, CAST(COALESCE(c.n, 0) AS BIGINT) AS n
FROM range({K}) g(k) LEFT JOIN (SELECT label AS k, COUNT(*) AS n FROM ({src}) q GROUP BY label) c
  ON g.k = c.k"""


def calibrate(cj: str, counts: str) -> str:
    v1 = """CASE WHEN SUM(v) OVER (PARTITION BY k_s) = 0
                 THEN CASE WHEN k_s = k_y THEN CAST(n AS DOUBLE) ELSE 0.0 END
                 ELSE v / SUM(v) OVER (PARTITION BY k_s) * n END"""
    return round_rows(f"""SELECT k_s, k_y, v1 / SUM(v1) OVER () *
              SUM(CASE WHEN k_s = k_y THEN n END) OVER () AS v
FROM (SELECT k_s, k_y, {v1} AS v1, n FROM ({cj}) j JOIN ({counts}) c USING (k_s)) z""")


def calibrated_joint_lineitem() -> str:
    src = psx_lineitem()
    return calibrate(cells(confident(src), "label", "y_conf"), class_counts(src))
